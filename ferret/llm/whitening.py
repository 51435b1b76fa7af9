"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers (floor(SCALE * entry)), so the sums of the dimensions and
the centred rows are exact. The centred table X is never multiplied with itself: each
step is one distributed pass that forms y = X q, with q made from the last right
vector, and X' y, and with them the products of y with all earlier left vectors. A left
vector has an entry for every row; it is X c for a short c, so the driver keeps c and
the tasks form the entries anew. Left vectors are reorthogonalised with these products,
right vectors against all earlier ones twice. The small bidiagonal matrix's singular
vectors and values give components and deviations, and its last row the residuals that
end the run. A run finds one component of several with equal deviation, so another run
on the complement of what was found looks for more, until it finds nothing as large.

The driver holds vectors as long as a row is wide, never one as long as the table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.llm.common import stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Entries beyond this, once scaled, make a vector unusable like one that is not finite.
LARGEST = float(1 << 40)
#: Vectors of one block, and its bytes.
BLOCK, BLOCK_BYTES = 4096, 2 << 20
#: A residual below this share of the largest singular value ends a run.
RESIDUAL = 1e-13
#: Deviations below this share of the largest are rounding, not components.
NOTHING = 1e-13
_EXACT = 1 << 62


def _whole(values: pa.Array, lengths: np.ndarray, scale: int):
    """(whole numbers, usable rows) of flat list values; null and non-finite entries."""
    v = values.cast(pa.float64())
    null = np.asarray(v.is_null())
    v = np.floor(np.asarray(v.fill_null(0.0)) * float(scale))
    wrong = null | ~(np.abs(v) <= LARGEST)  # also what is not a number
    row = np.repeat(np.arange(len(lengths)), lengths)
    bad = np.bincount(row[wrong], minlength=len(lengths)) > 0
    return np.where(wrong, 0, v).astype(np.int64), ~bad & (lengths > 0)


def _blocks(scale: int):
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            col = b.column(1)
            lengths = np.asarray(pa.compute.list_value_length(col).fill_null(0)).astype(np.int64)
            x, ok = _whole(col.flatten(), lengths, scale)  # null lists hold nothing
            start = np.cumsum(lengths) - lengths
            for d in np.unique(lengths[ok]).tolist():
                at = np.flatnonzero(ok & (lengths == d))
                step = max(1, min(BLOCK, BLOCK_BYTES // (8 * d)))
                for i in range(0, len(at), step):
                    part = at[i:i + step]
                    m = x[start[part][:, None] + np.arange(d)]
                    top = int(np.abs(m).max())
                    kind = next(t for t in ("<i2", "<i4", "<i8") if top < np.iinfo(t).max)
                    yield pa.RecordBatch.from_pydict({
                        "dim": pa.array([d], pa.int32()), "n": pa.array([len(part)], pa.int64()),
                        "ids": pa.array([b.column(0).take(pa.array(part)).to_pylist()], pa.list_(pa.int64())),
                        "kind": [kind], "top": pa.array([top], pa.int64()), "x": pa.array([m.astype(kind).tobytes()], pa.binary())})

    return run


@dataclass
class Model:
    """Components (columns) and deviations of the rows in ``blocks``."""

    blocks: DataFrame
    n: int
    dim: int
    shift: int
    sums: list  # of the dimensions, before the shift
    wide: bool  # whether centred rows need more than 64 bits
    tasks: int  # that sum the partitions' vectors
    trace: float
    components: np.ndarray
    deviations: np.ndarray


def _rows(kind, x, dim):
    return np.frombuffer(x, kind).reshape(-1, dim).astype(np.int64)


def _centred(x: np.ndarray, n: int, sums: list, wide: bool) -> np.ndarray:
    """n * x - sums, exact."""
    if wide:
        return x.astype(object) * n - np.array(sums, dtype=object)
    return x * n - np.array(sums, np.int64)


def _each(batches):
    for b in batches:
        yield from zip(*(b.column(i).to_pylist() for i in range(b.num_columns)))


def _totals(blocks: DataFrame, run, tasks: int) -> np.ndarray:
    """The sum over all partitions of the vector that ``run`` (over block rows) gives. The
    partitions' vectors are summed in ``tasks`` tasks, and theirs on the driver."""
    def vectors(batches):
        total = run(_each(batches))
        if total is not None:
            yield pa.RecordBatch.from_pydict({"v": pa.array([total.tolist()], pa.list_(pa.float64()))})

    def sums(batches):
        return vectors_of(np.array(v) for (v,) in _each(batches))

    def vectors_of(parts):
        total = None
        for v in parts:
            total = v if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_pydict({"v": pa.array([total.tolist()], pa.list_(pa.float64()))})

    got = (blocks.select("kind", "x").mapInArrow(vectors, "v array<double>").repartition(tasks)
           .mapInArrow(sums, "v array<double>").collect())
    return np.sum([r["v"] for r in got], axis=0)


def _product(model: Model):
    """Function (q, left) -> (X' y, left vectors' products with y, y' y, trace of X' X), y = X q."""
    n, dim, sums, wide = model.n, model.dim, model.sums, model.wide

    def product(q, left):
        side = np.column_stack([q, *left])

        def run(rows):
            total = None
            for kind, x in rows:
                c = (_centred(_rows(kind, x, dim), n, sums, wide) / n).astype(float)
                y = c @ side
                part = np.concatenate([c.T @ y[:, 0], y[:, 1:].T @ y[:, 0], [y[:, 0] @ y[:, 0], (c * c).sum()]])
                total = part if total is None else total + part
            return total

        got = _totals(model.blocks, run, model.tasks)
        return got[:dim], got[dim:-2], got[-2], got[-1]

    return product


def _away(w, basis):
    for _ in range(2):
        for b in basis:
            w = w - (b @ w) * b
    return w


def bidiagonalise(product, dim: int, want: int, away=(), below: float | None = None, seed: int = 1):
    """(squared singular values, right vectors, whole) of X off the orthonormal ``away``.

    The largest ``want``, falling, or fewer when the run meets an invariant subspace;
    whole: the run has seen all of the complement. With ``below`` the run also ends as
    soon as its largest value is known to lie under it.
    """
    rng = np.random.default_rng(seed)
    v = _away(rng.standard_normal(dim), away)
    v /= np.linalg.norm(v)
    right, left, back, alpha, beta, b, first = [], [], [], [], [], 0.0, 0.0
    most = dim - len(away)
    while True:
        q = v - b * left[-1] if right else v
        z, h, yy, _ = product(q, left)
        for hj, cj, zj in zip(h, left, back):
            q, z = q - hj * cj, z - hj * zj
        a = float(np.sqrt(max(yy - h @ h, 0.0)))
        first = max(first, a)
        if a <= 1e-15 * first or not a:
            a, q, z = 0.0, np.zeros(dim), np.zeros(dim)
        else:
            q, z = q / a, z / a
        right.append(v), left.append(q), back.append(z), alpha.append(a)
        w = _away(z - a * v, [*away, *right])
        b = float(np.linalg.norm(w))
        k = len(right)
        p, s, qt = np.linalg.svd(np.diag(alpha) + np.diag(beta, 1))
        residual = b * np.abs(p[-1])
        closed = not s[0] or b <= 1e-14 * s[0]
        done = k >= want and (residual[:want] <= RESIDUAL * s[0]).all()
        if below is not None:
            top, off = s[0] ** 2, s[0] * residual[0]
            done |= off <= 1e-3 * top and top + off < below
        if closed or done or k == most:
            take = k if closed else min(k, want)
            return s[:take] ** 2, (qt[:take] @ np.array(right)).reshape(take, dim), k == most
        beta.append(b)
        v = w / b


def fit(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT,
        id_col: str = "vec_id", vector_col: str = "embedding") -> Model | None:
    """Components of floor(scale * entry) + shift over all usable rows; None without any.

    A row is usable if its vector is not null or empty and no entry is null, not finite
    or beyond LARGEST once scaled. If lengths differ, the rows of the most frequent one
    are used (of equally frequent ones the longest).
    """
    blocks = stored(vectors.select(F.col(id_col).cast("long").alias("i"), F.col(vector_col).cast("array<double>").alias("v"))
                    .mapInArrow(_blocks(scale), "dim int, n long, ids array<long>, kind string, top long, x binary"))
    sizes = blocks.groupBy("dim").agg(F.sum("n").alias("n"), F.max("top").alias("top")).collect()
    if not sizes:
        return None
    size = max(sizes, key=lambda r: (r["n"], r["dim"]))
    n, dim = size["n"], size["dim"]
    blocks = blocks.where(F.col("dim") == dim)

    def sums(batches):
        total = np.zeros(dim, object)
        for kind, x in _each(batches):
            total = total + _rows(kind, x, dim).sum(0).astype(object)
        yield pa.RecordBatch.from_pydict({"p": pa.array(np.arange(dim), pa.int32()), "s": [str(t) for t in total]})

    got = (blocks.select("kind", "x").mapInArrow(sums, "p int, s string")
           .groupBy("p").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    total = [0] * dim
    for r in got:
        total[r["p"]] = int(r["s"])
    model = Model(blocks, n, dim, shift, total, 2 * n * size["top"] >= _EXACT,
                  max(1, round(blocks.rdd.getNumPartitions() ** 0.5)), 0.0, np.zeros((dim, 0)), np.zeros(0))
    product = _product(model)
    model.trace = product(np.zeros(dim), [])[3] / n
    if not model.trace:
        return model
    e, found, whole = bidiagonalise(product, dim, min(components, dim))
    while not whole and len(e) < dim:
        short = max(1, components - len(e))
        floor = None if len(e) < components else np.sort(e)[-components]
        more, others, whole = bidiagonalise(product, dim, min(short, dim - len(e)), found, floor, seed=len(e) + 2)
        if floor is not None and more[0] <= floor:
            break
        e, found = np.concatenate([e, more]), np.concatenate([found, others])
    keep = np.argsort(-e, kind="stable")[:components]
    keep = keep[e[keep] > NOTHING * e[keep[0]]]
    # the found vectors once more as one orthonormal set
    basis = np.linalg.qr(found[keep].T)[0]
    model.components, model.deviations = basis * np.sign((basis * found[keep].T).sum(0)), e[keep] / n
    return model


def identity_error(model: Model) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    n, dim, sums, wide = model.n, model.dim, model.sums, model.wide
    side, k = model.components / np.sqrt(model.deviations), len(model.deviations)

    def over(mean):
        def run(rows):
            total = None
            for kind, x in rows:
                w = (_centred(_rows(kind, x, dim), n, sums, wide) / n).astype(float) @ side
                part = w.sum(0) if mean is None else ((w - mean).T @ (w - mean)).ravel()
                total = part if total is None else total + part
            return total
        return _totals(model.blocks, run, model.tasks) / n

    covariance = over(over(None)).reshape(k, k)
    return float(np.abs(covariance - np.eye(k)).max())


def whitened(model: Model) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for
    each usable row and component. Narrow. deviation: sum over dimensions of
    (n * x - sum)^2, exact; null if it doesn't fit a long."""
    n, dim, sums, wide = model.n, model.dim, model.sums, model.wide
    k, side = len(model.deviations), model.components / np.sqrt(model.deviations)
    explained, error = model.deviations / model.trace, identity_error(model)
    number = np.arange(1, k + 1, dtype=np.int32)

    def run(batches):
        for ids, kind, x in _each(batches):
            c = _centred(_rows(kind, x, dim), n, sums, wide)
            if wide or int(np.abs(c).max()) ** 2 * dim >= _EXACT:
                dev = [v if v < 1 << 63 else None for v in (c.astype(object) ** 2).sum(1).tolist()]
            else:
                dev = (c * c).sum(1)
            w = (c / n).astype(float) @ side
            m = len(w)
            yield pa.RecordBatch.from_pydict({
                "vec_id": pa.array(ids, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                "component": pa.array(np.tile(number, m)), "n": pa.array(np.full(m * k, n, np.int64)),
                "deviation": pa.array(dev, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                "whitened": pa.array(w.ravel()), "explained": pa.array(np.tile(explained, m)),
                "identity_error": pa.array(np.full(m * k, error))})

    return model.blocks.select("ids", "kind", "x").mapInArrow(
        run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(vectors: DataFrame, components: int = COMPONENTS, **options) -> DataFrame:
    """``whitened`` of the model fitted on the same rows.

    Unusable vectors have no row (see ``fit``). Null ids and repeated rows count and get
    rows like others. Fewer components than asked come from rows of lower rank: from
    equal rows, a single row or an empty table none, so the result is empty. Other
    columns are not read.
    """
    model = fit(vectors, components, **options)
    if model is None or not len(model.deviations):
        return vectors.sparkSession.createDataFrame(
            [], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return whitened(model)
