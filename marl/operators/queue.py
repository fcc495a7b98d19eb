"""Working queues: order, limit, what is done, budgets, breakers, and reports on scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marl.functions.scores import AGING
from marl.operators.ordered import running_total, with_previous

STRATEGIES = ("greedy", "arrival", "aging")


def priority(name: str, score: Column, age: Column, ordinal: Column) -> list[Column]:
    """Sort keys of a strategy: greedy by score, arrival by place, aging by score and 0.05 a day; ties by place."""
    if name == "greedy":
        return [score.desc_nulls_last(), ordinal]
    if name == "arrival":
        return [ordinal]
    if name == "aging":
        return [(score + AGING * age).desc_nulls_last(), ordinal]
    raise ValueError(f"unknown strategy {name!r}: one of {', '.join(STRATEGIES)}")


def examine(items: DataFrame, done: DataFrame, keys: list[str], order: list[Column], limit: int | None = None) -> DataFrame:
    """What a run works on: items in order, the first `limit` of them examined, those already done skipped.

    The limit counts items examined, done ones included, so that a run over done work ends."""
    seen = items.orderBy(*order) if limit is None else items.orderBy(*order).limit(limit)
    return seen.join(done.select(*keys).distinct(), keys, "left_anti")


def within_budget(items: DataFrame, order: Column, spread: str, cost: Column, cap: float) -> DataFrame:
    """Items begun while what was spent before them was below `cap`; the last may overshoot. Null costs are free."""
    spent = running_total(items, [], order, spread, cost, "_spent")
    return spent.where(F.col("_spent") - F.coalesce(cost, F.lit(0)) < cap).drop("_spent")


def breaker(items: DataFrame, keys: list[str], order: Column, spread: str, failed: Column, most: int) -> DataFrame:
    """(keys, longest, tripped): the longest run of failures of each key, and whether it reached `most`."""
    from marl.operators.ordered import runs

    rows = items.withColumn("_failed", F.coalesce(failed, F.lit(False)))
    rows = with_previous(rows, keys, order, spread, F.col("_failed"), "_was")
    rows = runs(rows, keys, order, spread, F.col("_was").isNull() | (F.col("_was") != F.col("_failed")), "_run")
    length = rows.groupBy(*keys, "_run").agg(F.sum(F.col("_failed").cast("bigint")).alias("n"))
    return length.groupBy(*keys).agg(F.max("n").alias("longest")).withColumn("tripped", F.col("longest") >= most)


def histogram(df: DataFrame, score: str, buckets: int = 12) -> DataFrame:
    """(bucket, low, high, n): equal bins from the least score to the greatest, the last closed; one bin if all are equal. Null scores are left out; empty bins have no row."""
    known = df.where(F.col(score).isNotNull())
    lo, hi = known.agg(F.min(score), F.max(score)).first()
    lo, hi = (0.0, 0.0) if lo is None else (float(lo), float(hi))
    n = buckets if hi > lo else 1
    width = (hi - lo) / n
    at = F.least(F.floor((F.col(score) - lo) / width), F.lit(n - 1)) if width else F.lit(0)
    return known.select(at.cast("int").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n")).select("bucket", (F.lit(lo) + F.col("bucket") * width).alias("low"), (F.lit(lo) + (F.col("bucket") + 1) * width).alias("high"), "n")


def stratified(pairs: DataFrame, stratum: Column, quotas: dict[str, int], order: list[Column]) -> DataFrame:
    """The first rows of each stratum by `order`, as many as its quota. Only the quota's rows of each stratum leave a task."""
    rows = pairs.withColumn("_stratum", stratum)
    quota = F.lit(0)
    for name, n in quotas.items():
        quota = F.when(F.col("_stratum") == name, n).otherwise(quota)
    rank = F.row_number().over(Window.partitionBy("_stratum").orderBy(*order))
    most = max(quotas.values(), default=0)
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= most).where(F.col("_rank") <= quota).drop("_rank", "_stratum")
