"""MinHash near-duplicates with fast similarity sketching.

A sketch has COORDINATES bins. In round i every shingle draws a bin and a value in
[i, i + 1) from one hash, and a bin keeps its least value; after as many rounds as there
are bins, round i serves bin i - COORDINATES alone, so every bin is filled. A set stops
after the round that fills its last bin: large sets after one or two. Two sets agree in a
bin with the chance of their Jaccard similarity, and the number of agreeing bins is
concentrated around it.

Rows of equal sets are one class first. BANDS groups of bins are bucket keys; inside a
bucket, sketches (a byte a bin) that agree in AGREE bins or more, with sizes that allow
the similarity, are candidates. Classes joined by candidates form a cluster, and inside
a cluster every pair is compared on its full shingle set, unless links found before
join its ends. Buckets and clusters give spanning forests, never all pairs.

A crowded bucket or cluster is dealt over chunks, each with the group's first member.
Only where the chunks' forests leave a group in several components, its largest
component and the rest meet chunk by chunk, so every pair with an end in the rest is
compared.

Chances of a miss: two sets of similarity 0.85 share no band with 4e-7, and agree in
fewer than AGREE bins with about 1e-7; both fall steeply for larger similarities.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.llm import wordhash
from ferret.llm.common import bit_filter, bounded, checkpointed, longs, passes, slices, stored, texts_of
from ferret.llm.components import components

BANDS, ROWS = 25, 5
COORDINATES = BANDS * ROWS
#: Standard deviations below the expected agreement at which a candidate is dropped.
SPREAD = 5.6
#: Members of a chunk of a crowded bucket, and of a cluster; shingles of a cluster's chunk.
BUCKET_CHUNK, CLUSTER_CHUNK, CHUNK_SHINGLES = 2048, 512, 1 << 19
#: Links of one task that joins them before the rounds begin.
TASK_LINKS = 1 << 20
#: Groups up to this size are compared densely, many at once.
DENSE = 32
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(data, offs, shingle: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): each text's distinct word shingles, sorted, and where they begin."""
    h, first = wordhash.words(data, offs, lower=True)
    g = wordhash.windows(h, shingle)
    out, n = [], np.zeros(len(offs), np.int64)
    for i, (a, z) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if z - a >= shingle:
            s = np.sort(g[a:z - shingle + 1])
            s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        else:
            s = wordhash.windows(h[a:z], z - a) if z > a else g[:0]
        out.append(s)
        n[i + 1] = len(s)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.cumsum(n)


def sketches(sets: np.ndarray, first: np.ndarray, size: int = COORDINATES) -> np.ndarray:
    """The sketch of each set, a row of ``size`` values; an empty set's bins stay empty."""
    out = np.full((len(first) - 1) * size, _EMPTY)
    own = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for i in range(2 * size):
        if not len(sets):
            break
        h = wordhash.mix(sets + np.uint64((i + 1) * int(_STEP) & int(_EMPTY)))
        bins = ((h & np.uint64(0xFFFF)) * np.uint64(size) >> np.uint64(16)).astype(np.int64) if i < size else i - size
        at = own * size + bins
        free = out[at] == _EMPTY  # values of earlier rounds are smaller
        np.minimum.at(out, at[free], np.uint64(i) << np.uint64(48) | h[free] >> np.uint64(16))
        open_ = np.zeros(len(first) - 1, bool)
        live = np.unique(own)
        open_[live] = (out.reshape(-1, size)[live] == _EMPTY).any(1)
        keep = open_[own]
        if not keep.all():
            sets, own = sets[keep], own[keep]
    return out.reshape(-1, size)


def band_keys(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each band of ``rows`` bins."""
    part = sketch.reshape(len(sketch), -1, rows)
    key = np.zeros(part.shape[:2], np.uint64)
    for c in range(rows):
        key = wordhash.mix(key * _STEP + part[:, :, c])
    return wordhash.mix(key + np.arange(part.shape[1], dtype=np.uint64) * _STEP)


def _class_hash(sets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set: sums of two hashes of its shingles, and its size."""
    out = []
    for seed in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        run = np.zeros(len(sets) + 1, np.uint64)
        np.cumsum(wordhash.mix(sets ^ np.uint64(seed)), out=run[1:])
        out.append(wordhash.mix(run[first[1:]] - run[first[:-1]] + np.diff(first).astype(np.uint64)))
    return out[0], out[1]


def prints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, n_shingles, h1, h2, bands, codes) of every row. Narrow."""
    def run(batches):
        for b in slices(batches, 1):
            sets, first = shingle_sets(*texts_of(b.column(1)), shingle)
            sketch = sketches(sets, first)
            h1, h2 = _class_hash(sets, first)
            m = len(sketch)
            codes = (wordhash.mix(sketch) & np.uint64(255)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(np.diff(first)), longs(h1), longs(h2),
                pa.ListArray.from_arrays(pa.array(np.arange(m + 1, dtype=np.int32) * BANDS), longs(band_keys(sketch).ravel())),
                pa.array(list(map(bytes, codes)), pa.binary())],
                ["doc_id", "n_shingles", "h1", "h2", "bands", "codes"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>, codes binary")


def _sketch_near(n, data, percent):
    """(near, dense near) of the rows of a block that hold sketch bytes."""
    codes = np.frombuffer(b"".join(data), np.uint8).reshape(len(data), -1)
    s = percent / 100
    agree = int(np.floor(COORDINATES * s - SPREAD * np.sqrt(COORDINATES * s * (1 - s))))

    def near(x, others):
        ok = 100 * np.minimum(n[x], n[others]) >= percent * np.maximum(n[x], n[others])
        ok[ok] = (codes[others[ok]] == codes[x]).sum(1) >= agree
        return ok

    def dense(at):
        c, m = codes[at], n[at]
        return (((c[:, :, None] == c[:, None]).sum(3) >= agree)
                & (100 * np.minimum(m[:, :, None], m[:, None]) >= percent * np.maximum(m[:, :, None], m[:, None])))

    return near, dense


def _set_near(n, data, percent):
    """The same for rows that hold shingle sets; no dense form."""
    sets = [np.frombuffer(d, np.uint64) for d in data]
    start = np.cumsum([0, *map(len, sets)])
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
    flag = np.zeros(int(flat.max(initial=0)) + 1, np.int64)

    def near(x, others):
        ok = 100 * np.minimum(n[x], n[others]) >= percent * np.maximum(n[x], n[others])
        some = others[ok]
        if len(some):
            mine = flat[start[x]:start[x + 1]]
            flag[mine] = 1
            if 4 * len(some) > len(n):
                common = np.add.reduceat(flag[flat], start[:-1])[some]
            else:
                common = np.array([flag[flat[start[o]:start[o + 1]]].sum() for o in some])
            flag[mine] = 0
            ok[ok] = 100 * common >= percent * (n[x] + n[some] - common)
        return ok

    return near, None


def _forest(label: np.ndarray, near):
    """Pairs of rows that join the components of all links between rows of different
    ``label``; rows of one label count as joined. Skips the most frequent label: each
    pair of labels has another one at one of its ends."""
    kinds, label, count = np.unique(label, return_inverse=True, return_counts=True)
    if len(kinds) < 2:
        return
    order = np.argsort(count[label], kind="stable")
    order = order[label[order] != label[order[-1]]]
    for x in order:
        others = np.flatnonzero(label != label[x])
        if not len(others):
            return
        hits = others[near(x, others)]
        for k in np.unique(label[hits], return_index=True)[1]:
            y = hits[k]
            yield x, y
        label[np.isin(label, label[hits])] = label[x]


def _dense_forest(near: np.ndarray):
    """near: G groups of s rows. (group, member, root) of the links' components."""
    s = near.shape[1]
    label = np.broadcast_to(np.arange(s), near.shape[:2]).copy()
    while True:
        new = np.minimum(label, np.where(near, label[:, None, :], s).min(2))
        if (new == label).all():
            g, i = np.nonzero(label != np.arange(s))
            return g, i, label[g, i]
        label = new


def _link_groups(compare, percent):
    """Arrow function over rows (g, c, r, node, label, n, data) sorted by (g, c, r):
    the forest of the links of each group. A node that comes twice counts once."""
    def groups(key, node, label, n, data):
        cut = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
        start, stop = np.r_[0, cut], np.r_[cut, len(node)]
        if compare is _sketch_near:
            near, dense = compare(n, data, percent)
            size = stop - start
            small = (size <= DENSE) & (size > 1)
            for s in np.unique(size[small]):
                at = start[small & (size == s)][:, None] + np.arange(s)
                step = max(1, (1 << 23) // int(s * s * COORDINATES))
                for i in range(0, len(at), step):
                    part = at[i:i + step]
                    g, a, b = _dense_forest(dense(part) | (label[part][:, :, None] == label[part][:, None]))
                    yield node[part[g, a]], node[part[g, b]]
            for a, z in zip(start[size > DENSE].tolist(), stop[size > DENSE].tolist()):
                there = _forest(label[a:z], lambda x, others: near(x + a, others + a))
                if pairs := list(there):
                    x, y = np.array(pairs).T + a
                    yield node[x], node[y]
            return
        for a, z in zip(start.tolist(), stop.tolist()):
            at = a + np.unique(node[a:z], return_index=True)[1]
            if len(at) > 1:
                near, _ = compare(n[at], [data[i] for i in at], percent)
                if pairs := list(_forest(label[at], near)):
                    x, y = at[np.array(pairs)].T
                    yield node[x], node[y]

    def run(batches):
        key, ints, data = np.zeros((0, 3), np.int64), np.zeros((3, 0), np.int64), []

        def out(found):
            for a, b in found:
                if len(a):
                    yield pa.RecordBatch.from_arrays([longs(a), longs(b)], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            col = [np.asarray(batch.column(i)).astype(np.int64) for i in range(6)]
            key = np.concatenate([key, np.stack(col[:3], 1)])
            ints = np.concatenate([ints, np.stack(col[3:])], 1)
            data += batch.column(6).to_pylist()
            last = np.flatnonzero((key[1:] != key[:-1]).any(1))
            if len(last):  # the last group may go on in the next batch
                cut = int(last[-1]) + 1
                yield from out(groups(key[:cut], *ints[:, :cut], data[:cut]))
                key, ints, data = key[cut:], ints[:, cut:], data[cut:]
        if len(data):
            yield from out(groups(key, *ints, data))

    return run


def _forests(rows: DataFrame, compare, percent: int) -> DataFrame:
    """rows: g, c, r, node, label, n, data."""
    cols = [F.col(x).cast("long").alias(x) for x in ("g", "c", "r", "node", "label", "n")]
    return (rows.select(*cols, "data").repartition("g", "c", "r").sortWithinPartitions("g", "c", "r")
            .mapInArrow(_link_groups(compare, percent), "a long, b long"))


def _spanning(batches):
    """Arrow function: links (a, b) -> (node, its component's smallest) inside the task."""
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def forest():
        nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
        u, v = ends[:len(a)], ends[len(a):]
        root = np.arange(len(nodes))
        while True:
            low = np.minimum(root[u], root[v])
            if (root[u] == low).all() and (root[v] == low).all():
                break
            np.minimum.at(root, root[u], low)
            np.minimum.at(root, root[v], low)
            while (root[root] != root).any():
                root = root[root]
        own = np.flatnonzero(root != np.arange(len(nodes)))
        return nodes[own], nodes[root[own]]

    for batch in batches:
        a = np.concatenate([a, np.asarray(batch.column(0)).astype(np.int64)])
        b = np.concatenate([b, np.asarray(batch.column(1)).astype(np.int64)])
        if len(a) >= TASK_LINKS:
            a, b = forest()
            if 2 * len(a) >= TASK_LINKS:  # next to all links are needed: they leave as they are
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
                a, b = a[:0], b[:0]
    a, b = forest()
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def joined(links: DataFrame) -> DataFrame:
    """``components`` of stored links. Tasks of TASK_LINKS links each first keep a star for
    every component that they see, which leaves few rounds to join them."""
    tasks = max(1, -(-links.count() // TASK_LINKS))
    return components(links.repartition(tasks).mapInArrow(_spanning, "a long, b long"))


def _chunk(parts):
    return F.pmod(F.xxhash64("node"), parts).cast("int")


def group_links(rows: DataFrame, compare, percent: int, chunk: int) -> DataFrame:
    """(a, b): forests that join what all links inside the groups of ``rows`` join.

    rows: g, node, n, data and their group's ``parts`` (chunks it is dealt over) and
    ``lead`` (its first node). Stored tables only: the rows of groups of several parts
    are read again.
    """
    zero = F.lit(0)
    dealt = rows.withColumn("c", F.explode(F.when((F.col("node") == F.col("lead")) & (F.col("parts") > 1),
                                                  F.sequence(zero, F.col("parts") - 1)).otherwise(F.array(_chunk(F.col("parts"))))))
    found = checkpointed(_forests(dealt.withColumn("r", zero).withColumn("label", F.col("node")), compare, percent))
    crowded = rows.where("parts > 1")
    if crowded.isEmpty():
        return found
    label = joined(found).select("node", F.col("root").alias("label"))
    named = stored(crowded.select("g", "node").join(label, "node", "left").select("g", "node", F.coalesce("label", "node").alias("label")))
    kinds = named.groupBy("g", "label").agg(F.count(F.lit(1)).alias("m"))
    # the largest component of each group that still has several
    main = (kinds.groupBy("g").agg(F.max(F.struct("m", "label")).alias("x"), F.sum("m").alias("m"), F.count(F.lit(1)).alias("k"))
            .where("k > 1").select("g", F.col("x.label").alias("main"),
                                   F.ceil(F.col("x.m") / F.lit(chunk)).cast("int").alias("km"),
                                   F.ceil((F.col("m") - F.col("x.m")) / F.lit(chunk)).cast("int").alias("kr")))
    main = checkpointed(main)
    if main.isEmpty():
        return found
    open_ = crowded.join(bounded(main, 40), "g").join(named, ["g", "node"])
    own_m, own_r = _chunk(F.col("km")), _chunk(F.col("kr"))
    largest = open_.where("label = main").withColumn("c", own_m).withColumn("r", F.explode(F.sequence(zero, F.col("kr") - 1)))
    rest = open_.where("label != main").withColumn("own", own_r)
    across = rest.withColumn("c", F.explode(F.sequence(zero, F.col("km") - 1))).withColumn("r", F.col("own"))
    other = F.explode(F.sequence(zero, F.col("kr") - 1))
    inside = (rest.withColumn("o", other).withColumn("c", -1 - F.least("own", "o")).withColumn("r", F.greatest("own", "o")))
    cols = ["g", "c", "r", "node", "label", "n", "data"]
    tiles = largest.select(cols).unionByName(across.select(cols)).unionByName(inside.select(cols))
    return checkpointed(found.unionByName(_forests(tiles, compare, percent)))


def _candidates(reps: DataFrame, percent: int, chunk: int) -> DataFrame:
    """(a, b): forests of the classes that share a bucket and agree in enough bins."""
    cells = reps.select("node", F.explode("bands").alias("g"))
    shared = stored(cells.groupBy("g").agg(F.count(F.lit(1)).alias("m"), F.min("node").alias("lead")).where("m > 1")
                    .select("g", "lead", F.ceil(F.col("m") / F.lit(chunk)).cast("int").alias("parts")))
    met = cells.join(bounded(shared, 40), "g")
    rows = stored(met.join(reps.select("node", F.col("n_shingles").alias("n"), F.col("codes").alias("data")), "node"))
    return group_links(rows, _sketch_near, percent, chunk)


def _sets_of(docs: DataFrame, members: DataFrame, shingle: int) -> DataFrame:
    """members (g, node, least, h1, h2, ...) with the shingle sets (data) of their classes.
    Texts are chosen by a bit filter of ids in the scan, then joined exactly."""
    words = bit_filter(members.select(F.xxhash64("least").alias("k")), "k")

    def run(batches):
        seen = set()
        for b in batches:
            b = b.filter(pa.array(passes(words, np.asarray(b.column(2)).astype(np.int64).view(np.uint64))))
            for b in slices([b], 1):
                sets, first = shingle_sets(*texts_of(b.column(1)), shingle)
                h1, h2 = _class_hash(sets, first)
                new = []
                for i, key in enumerate(zip(b.column(0).to_pylist(), h1.tolist())):
                    if key not in seen:  # repeated rows; a task's memory of them stays small
                        new.append(i)
                        if len(seen) > 100_000:
                            seen.clear()
                        seen.add(key)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(pa.array(new, pa.int64())), longs(h1[new]), longs(h2[new]),
                    pa.array([sets[first[i]:first[i + 1]].tobytes() for i in new], pa.binary())], ["least", "h1", "h2", "data"])

    key = F.col("doc_id").cast("long")
    texts = (docs.select(key.alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
             .select("doc_id", "text", F.xxhash64("doc_id").alias("k")))
    return texts.mapInArrow(run, "least long, h1 long, h2 long, data binary").join(bounded(members, 80), ["least", "h1", "h2"])


def near_duplicates(docs: DataFrame, shingle: int = 3, percent: int = 85, bucket_chunk: int = BUCKET_CHUNK,
                    cluster_chunk: int = CLUSTER_CHUNK) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    Links: 100 * intersection >= percent * union of the shingle sets. component_id: the
    smallest doc_id that links reach, itself included. A text without words (null, empty,
    blank) has no shingles and links with nothing; one of fewer words than a shingle has
    one. A row with null doc_id gets its size, no component_id, and joins nothing.
    Rows that repeat a doc_id each get a row; with other texts each is linked by its own.
    An empty table gives an empty result. Other columns are not read.
    """
    every = stored(prints(docs, shingle))
    classes = (every.where("n_shingles > 0 and doc_id is not null").groupBy("h1", "h2")
               .agg(F.min("doc_id").alias("least"), F.min("n_shingles").alias("n_shingles"),
                    F.first(F.struct("bands", "codes")).alias("s")))
    reps = stored(classes.select("h1", "h2", "least", "n_shingles", "s.bands", "s.codes",
                                 F.monotonically_increasing_id().alias("node")))
    clusters = joined(_candidates(reps, percent, bucket_chunk)).withColumnRenamed("root", "g")
    members = checkpointed(clusters.join(reps.select("node", "h1", "h2", "least", F.col("n_shingles").alias("n")), "node"))
    parts = (members.groupBy("g").agg(F.min("node").alias("lead"), F.greatest(
        F.ceil(F.count(F.lit(1)) / F.lit(cluster_chunk)), F.ceil(F.sum("n") / F.lit(CHUNK_SHINGLES))).cast("int").alias("parts")))
    members = checkpointed(members.join(parts, "g"))
    sets = stored(_sets_of(docs, members, shingle).select("g", "node", "n", "lead", "parts", "data"))
    stars = joined(group_links(sets, _set_near, percent, cluster_chunk))
    rooted = (reps.select("node", "h1", "h2", "least").join(stars, "node", "left")
              .select("h1", "h2", "least", F.coalesce("root", "node").alias("root")))
    low = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(low, "root").select("h1", "h2", "component_id")
    linked = every.select("doc_id", "n_shingles", "h1", "h2").join(named, ["h1", "h2"], "left")
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return linked.select("doc_id", "n_shingles", own.alias("component_id"))
