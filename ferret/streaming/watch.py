"""Search a folder that keeps receiving files: each new ``.txt`` file is searched
once, as it arrives (the searcher re-lists its folder for every query, so new
files show up in later searches; a stream does this incrementally).

``start_search_stream`` reads whole files (one row per file, ``wholetext``), numbers the
lines and applies the same narrow exact or fuzzy plan as the batch search. No
state is kept between micro-batches, so the output is append-only; a restart with the
same ``checkpoint_location`` resumes with the files not yet processed, also in a new
application.

``start_many_search_stream`` searches arriving files for a table of queries. It streams
the names of new files only; each micro-batch reads its files with the split-safe line
reader, so a file of any size is searched in parallel, and writes its hits into a folder
of its own, which a repeated batch replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferret.functions.text import lines_of
from ferret.operators import multi
from ferret.operators.search import search
from ferret.sources.files import plain_path, read_file_lines

#: Files of one micro-batch; their names pass the driver.
FILES_PER_TRIGGER = 1000


def stream_lines(spark: SparkSession, path: str, glob: str = "*.txt", max_files_per_trigger: int | None = None):
    r = (spark.readStream.format("text").option("wholetext", "true").option("pathGlobFilter", glob))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    # same text rules as the batch reader: bad bytes replaced, a leading BOM dropped
    texts = r.load(path).select(plain_path("_metadata.file_name").alias("file"),
                                F.regexp_replace(F.make_valid_utf8("value"), "^\uFEFF", "").alias("text"))
    return lines_of(texts, ["file"], "text")


def search_stream(spark: SparkSession, path: str, query: str, method: str = "exact",
                  cutoff: float = 0.85, glob: str = "*.txt") -> DataFrame:
    """Streaming hits with the batch schema of ``search`` (file, line_no, line, method, ...)."""
    return search(stream_lines(spark, path, glob), query, ["file"], method, cutoff)


def start_search_stream(spark: SparkSession, path: str, query: str, sink_path: str, checkpoint_location: str,
                        method: str = "exact", cutoff: float = 0.85, available_now: bool = False):
    """Start the stream into a Parquet sink. ``checkpoint_location`` is a folder of the
    stream's own on shared storage; it must be the same after a restart."""
    w = (search_stream(spark, path, query, method, cutoff).writeStream
         .format("parquet").option("path", sink_path).option("checkpointLocation", checkpoint_location)
         .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def arriving_files(spark: SparkSession, path: str, glob: str, max_files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """A stream of the files that appear in ``path``: path, name, length. No content is read."""
    files = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
             .option("pathGlobFilter", glob)
             .option("maxFilesPerTrigger", str(max_files_per_trigger)).load(path))
    name = plain_path("_metadata.file_path")
    return files.select(name.alias("path"), F.regexp_extract(name, r"([^/]*)$", 1).alias("name"), "length")


def start_many_search_stream(spark: SparkSession, path: str, queries: DataFrame, sink_path: str, checkpoint_location: str,
                             fuzzy: bool = False, cutoff: float = 0.85, glob: str = "*.txt",
                             max_files_per_trigger: int = FILES_PER_TRIGGER, available_now: bool = False):
    """Search every arriving file for all of ``queries`` (query_id, query), a batch table that each
    micro-batch reads again, so queries added to it meet the files that arrive later.

    ``sink_path`` holds Parquet folders ``batch=N`` with the rows of
    ``exact_search_many`` or ``fuzzy_search_many`` (key: file).
    """
    def each(batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in batch.select("path").collect()]  # at most max_files_per_trigger
        if not paths:
            return
        lines = read_file_lines(spark, paths).select("file", "line_no", "line")
        if fuzzy:
            hits = multi.fuzzy_search_many(lines, queries, ["file"], cutoff)
        else:
            hits = multi.exact_search_many(lines, queries, ["file"])
        hits.write.mode("overwrite").parquet(f"{sink_path}/batch={number}")

    w = (arriving_files(spark, path, glob, max_files_per_trigger).writeStream.foreachBatch(each)
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
