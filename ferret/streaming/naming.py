"""Output names on a stream of sources (C5): a name given once stays taken for good.

The batch form ranks the sources of one run and reads the target's names. A stream has
no end to rank over, so each name family (the spellings of one head in one folder) keeps
its names as keyed state: in the order in which micro-batches bring them, by name inside
one, each source takes the first name that none before it holds. A source that comes
again, as after a repeated batch, gets the name it has. State is part of the stream's
checkpoint, so names stay taken after a restart.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ferret.operators.ingest import OUT_NAME, OUT_NAME_N, name_family, name_stem


def _give(key, batches, state):
    source, out = state.get if state.exists else ([], [])
    names, used = dict(zip(source, out)), set(out)
    rows = sorted({(r.name, r.head, r.label, tuple(r.held)) for b in batches for r in b.itertuples()})
    for name, head, label, held in rows:
        used.update(held)
        if name not in names:
            new, n = OUT_NAME.format(head=head, label=label), 0
            while new in used:
                n += 1
                new = OUT_NAME_N.format(head=head, label=label, n=n)
            names[name] = new
            used.add(new)
    state.update((list(names), list(names.values())))
    yield pd.DataFrame({"name": [r[0] for r in rows], "out_name": [names[r[0]] for r in rows]})


def name_stream(converted: DataFrame, name_col: str = "name", existing: DataFrame | None = None) -> DataFrame:
    """A stream (name, out_name) for a stream of converted sources (``name_col``, head, label, status).

    Only sources that write output (status success or unsure) take a name. ``existing``: a
    batch table of names that the target held before the stream (column out_name).
    ``name_col`` names a source once.
    """
    sources = (converted.filter(F.col("status").isin("success", "unsure"))
               .select(F.col(name_col).alias("name"), "head", "label", name_family(name_stem()).alias("_family")))
    if existing is None:
        sources = sources.withColumn("held", F.array().cast("array<string>"))
    else:
        family = name_family(F.regexp_replace("out_name", r"\.txt$", ""))
        held = existing.select(family.alias("_family"), "out_name").groupBy("_family").agg(F.collect_set("out_name").alias("held"))
        sources = sources.join(held, "_family", "left").withColumn("held", F.coalesce("held", F.array().cast("array<string>")))
    return sources.groupBy("_family").applyInPandasWithState(
        _give, "name string, out_name string", "source array<string>, out array<string>", "append", GroupStateTimeout.NoTimeout)


def start_naming_stream(converted: DataFrame, sink_path: str, checkpoint_location: str, name_col: str = "name",
                        existing: DataFrame | None = None, available_now: bool = False):
    """Write the names of ``name_stream`` to a Parquet sink as sources arrive."""
    w = (name_stream(converted, name_col, existing).writeStream.format("parquet").option("path", sink_path)
         .option("checkpointLocation", checkpoint_location).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def _by_value():
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_by_value()
