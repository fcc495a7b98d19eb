"""Streaming variants: watching a folder, sittings with late events, first sightings, and incremental targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marl.operators.incremental import Target, process_new


def new_files(spark: SparkSession, root: str, pattern: str = "*.jsonl") -> DataFrame:
    """A stream of the files that appear below `root`; the checkpoint remembers those seen."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)


def sittings(events: DataFrame, repo: str, ts: str, hours: int = 12, late: str = "1 day") -> DataFrame:
    """(repo, start, end, sessions): sittings as session windows; events later than `late` behind the newest are dropped, and a sitting is given out once it can grow no more."""
    windowed = events.withWatermark(ts, late).groupBy(F.session_window(ts, f"{hours} hours").alias("w"), repo)
    return windowed.agg(F.count("*").alias("sessions")).select(repo, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "sessions")


def first_seen(entries: DataFrame, keys: list[str], ts: str, late: str = "7 days") -> DataFrame:
    """Entries the first time their key comes within `late`."""
    return entries.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def follow(stream: DataFrame, target: Target, keys: list[str], spread: str, checkpoint: str) -> StreamingQuery:
    """Feed micro-batches to a target: each is one run of `process_new`, and a batch that is repeated after a failure adds nothing, for its rows' places are in the target."""
    return stream.writeStream.foreachBatch(lambda batch, _: process_new(target, batch, keys, spread)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
