"""The append-only store: raw versions, derived artifacts and decisions as Parquet tables.

Nothing is changed or deleted. A write leaves out what is there already, by content hash, so that a repeated run adds
nothing; a row counts once its file is committed. Derived rows are written before the marker that says they are done.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marl.operators.folds import latest
from marl.plans.scratch import drop, exists, keep

RAW = "content_hash string, source_kind string, source_id string, text string, fetched_at timestamp, mtime timestamp, prev string, bytes bigint"
DERIVED = "content_hash string, derived_from string, format string, text string, created_at timestamp, bytes bigint"
DECISION = "verb string, target string, at timestamp, run_id string, params string"


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self, name: str, schema: str) -> DataFrame:
        path = f"{self.path}/{name}"
        return self.spark.read.schema(schema).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def raw(self, kind: str | None = None) -> DataFrame:
        rows = self.table("raw", RAW)
        return rows if kind is None else rows.where(F.col("source_kind") == kind)

    def newest(self, kind: str | None = None) -> DataFrame:
        """The latest version of each source, of one kind if named: by fetched_at, then content_hash."""
        return latest(self.raw(kind), ["source_id"], ["fetched_at", "content_hash"])

    def ingest(self, rows: DataFrame) -> None:
        """Add raw versions (source_kind, source_id, text, fetched_at, mtime). What has been stored is left out; `prev` names the latest version before."""
        new = rows.where("text is not null").withColumn("content_hash", F.sha2("text", 256)).withColumn("bytes", F.octet_length("text").cast("bigint"))
        new = latest(new, ["content_hash"], ["fetched_at", "source_id"]).join(self.raw().select("content_hash"), "content_hash", "left_anti")
        last = self.newest().select("source_id", F.col("content_hash").alias("prev"))
        new.join(last, "source_id", "left").select(*[f.split()[0] for f in RAW.split(", ")]).write.mode("append").partitionBy("source_kind").parquet(f"{self.path}/raw")

    def put_derived(self, rows: DataFrame) -> None:
        """Add artifacts (derived_from, format, text, created_at) not yet stored."""
        new = rows.withColumn("content_hash", F.sha2("text", 256)).withColumn("bytes", F.octet_length("text").cast("bigint"))
        new = latest(new, ["content_hash", "format"], ["created_at", "derived_from"]).join(self.table("derived", DERIVED).select("content_hash", "format"), ["content_hash", "format"], "left_anti")
        new.select(*[f.split()[0] for f in DERIVED.split(", ")]).write.mode("append").partitionBy("format").parquet(f"{self.path}/derived")

    def derived(self, fmt: str | None = None) -> DataFrame:
        rows = self.table("derived", DERIVED)
        return rows if fmt is None else rows.where(F.col("format") == fmt)

    def decide(self, rows: DataFrame) -> None:
        """Add decisions or processed markers (verb, target, at, run_id, params)."""
        rows.select("verb", "target", "at", "run_id", "params").write.mode("append").parquet(f"{self.path}/decision")

    def decisions(self) -> DataFrame:
        return self.table("decision", DECISION)

    def lifecycle(self) -> DataFrame:
        """The latest decision on each target, processed markers apart."""
        return latest(self.decisions().where("verb <> 'processed'"), ["target"], ["at", "run_id", "verb"])

    def done(self, params: str) -> DataFrame:
        """(target): what has been processed under these parameters."""
        return self.decisions().where((F.col("verb") == "processed") & (F.col("params") == params)).select("target").distinct()


def run_stage(store: Store, items: DataFrame, key: str, process, fmt: str, params: str, run_id: str, at: str) -> None:
    """Process what is not done under `params`: derived rows first, markers last, so that a failure repeats and never skips.

    `process` maps items to (derived_from, text); every item gets a marker, whether it gave rows or not.
    """
    todo = items.join(store.done(params).withColumnRenamed("target", key), key, "left_anti")
    when = F.to_timestamp(F.lit(at))
    store.put_derived(process(todo).select("derived_from", F.lit(fmt).alias("format"), "text", when.alias("created_at")))
    store.decide(todo.select(F.lit("processed").alias("verb"), F.col(key).alias("target"), when.alias("at"), F.lit(run_id).alias("run_id"), F.lit(params).alias("params")).distinct())


@dataclass
class Report:
    """What a run did. `pending` is what is still not done after it, of all items and not only of those examined."""

    examined: int = 0
    processed: int = 0
    skipped: int = 0
    errored: int = 0
    outputs: int = 0
    cost_usd: float = 0.0
    stopped_on_budget: bool = False
    breaker_tripped: bool = False
    would_process: int = 0
    pending: int = 0


def run_loop(store: Store, items: DataFrame, key: str, order: list[Column], process: Callable[[DataFrame], DataFrame], fmt: str, params: str, run_id: str, at: str, limit: int | None = None, max_usd: float | None = None, breaker: int = 5, dry: bool = False, wave: int = 64) -> Report:
    """One run over the items that are not done under `params`, best first.

    The first `limit` items of the order are examined, those done are skipped, and the rest is processed in waves of `wave`
    items, each one distributed job. `process` maps a wave to (`key`, text, cost_usd, error), a row for each output, or one without text for an item that
    gave none; an item with an error gets no marker and comes again in the next run. Before a wave what was spent is held
    against `max_usd`; the run ends when the last `breaker` items in order all failed, here between waves. What is committed stays: the outputs of a wave first, its markers last.
    """
    done = store.done(params).withColumnRenamed("target", key)
    every = items.where(F.col(key).isNotNull()).dropDuplicates([key])
    pending = every.join(done, key, "left_anti").count()
    seen = every.orderBy(*order) if limit is None else every.orderBy(*order).limit(limit)
    report = Report(examined=every.count() if limit is None else min(limit, every.count()))
    todo = keep(seen.join(done, key, "left_anti"), "todo")
    total = todo.count()
    report.skipped = report.examined - total
    when, streak = F.to_timestamp(F.lit(at)), 0
    if dry:
        report.would_process, report.pending = total, pending
        return report
    ranked = keep(_ranked(todo, order, wave), "ranked")
    for w in range(-(-total // wave)):
        if max_usd is not None and report.cost_usd >= max_usd:
            report.stopped_on_budget = True
            break
        part = ranked.where(F.col("_wave") == w)
        out = keep(process(part.drop("_wave", "_rank")), "wave")
        state = part.select(key, "_rank").join(out.groupBy(key).agg(F.max(F.col("error").isNotNull()).alias("failed"), F.count("text").alias("n"), F.sum("cost_usd").alias("cost")), key, "left")
        rows = sorted(state.select("_rank", F.coalesce("failed", F.lit(True)), F.coalesce("n", F.lit(0)), F.coalesce("cost", F.lit(0.0))).collect())
        good = state.where(~F.coalesce("failed", F.lit(True))).select(key)
        store.put_derived(out.join(good, key, "left_semi").where("text is not null").select(F.col(key).cast("string").alias("derived_from"), F.lit(fmt).alias("format"), "text", when.alias("created_at")))
        store.decide(good.select(F.lit("processed").alias("verb"), F.col(key).cast("string").alias("target"), when.alias("at"), F.lit(run_id).alias("run_id"), F.lit(params).alias("params")))
        for _, failed, n, cost in rows:
            streak = streak + 1 if failed else 0
            report.errored += failed
            report.processed += not failed
            report.outputs += 0 if failed else n
            report.cost_usd += cost
        drop(out)
        if breaker and streak >= breaker:
            report.breaker_tripped = True
            break
    drop(todo, ranked)
    report.pending = pending - report.processed
    return report


def _ranked(df: DataFrame, order: list[Column], wave: int) -> DataFrame:
    """`df` with its place in the order and its wave, from a sort by range: each partition is numbered by itself and moved by the sizes of those before it."""
    rows = keep(df.orderBy(*order).withColumn("_part", F.spark_partition_id()).withColumn("_in", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "sorted")
    sizes = {p: n for p, n in rows.groupBy("_part").count().collect()}
    base, starts = 0, []
    for p in sorted(sizes):
        starts.append((p, base))
        base += sizes[p]
    moved = df.sparkSession.createDataFrame(starts or [(0, 0)], "_part int, _base bigint")
    rank = (F.col("_base") + F.col("_in")).alias("_rank")
    return rows.join(moved, "_part").select(*df.columns, rank).withColumn("_wave", F.expr(f"_rank div {wave}"))
