"""Neighbours, runs and running totals in an order, spread over tasks.

A plain window puts every row of a partition key into one task. Here `spread`, a column that never decreases in the order
(a day of a time, a bucket of a number), divides each key: neighbours are found within a division, and only one
summary row of each division meets the others of its key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _same(keys: list[str], spread: str, a: str, b: str) -> list[Column]:
    return [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in (*keys, spread)]


def with_previous(df: DataFrame, keys: list[str], order: Column, spread: str, value: Column, name: str = "previous") -> DataFrame:
    """`df` with `value` of the row just before in its key; null for the first. `order` must be unique in a key."""
    rows = df.withColumn("_value", F.struct(value.alias("v"))).withColumn("_order", order)
    rows = rows.withColumn("_before", F.lag("_value").over(Window.partitionBy(*keys, spread).orderBy("_order")))
    ends = rows.groupBy(*keys, spread).agg(F.max_by("_value", "_order").alias("_end"))
    ends = ends.withColumn("_earlier", F.lag("_end").over(Window.partitionBy(*keys).orderBy(spread))).drop("_end")
    out = rows.alias("r").join(ends.alias("e"), _same(keys, spread, "r", "e"), "left").select("r.*", "e._earlier")
    return out.withColumn(name, F.coalesce("_before", "_earlier")["v"]).drop("_value", "_order", "_before", "_earlier")


def with_last(df: DataFrame, keys: list[str], order: Column, spread: str, value: Column, name: str = "last") -> DataFrame:
    """`df` with the last `value` that is not null among the rows before this one in its key; null where there is none. `order` must be unique in a key."""
    rows = df.withColumn("_value", value).withColumn("_order", order)
    before = Window.partitionBy(*keys, spread).orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_before", F.last("_value", ignorenulls=True).over(before))
    ends = rows.groupBy(*keys, spread).agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("_order"))).alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy(spread).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_earlier", F.last("_end", ignorenulls=True).over(earlier)).drop("_end")
    out = rows.alias("r").join(ends.alias("e"), _same(keys, spread, "r", "e"), "left").select("r.*", "e._earlier")
    return out.withColumn(name, F.coalesce("_before", "_earlier")).drop("_value", "_order", "_before", "_earlier")


def running_total(df: DataFrame, keys: list[str], order: Column, spread: str, value: Column, name: str = "total") -> DataFrame:
    """`df` with the sum of `value` over the rows of its key up to and with this one; null values count 0."""
    rows = df.withColumn("_v", F.coalesce(value, F.lit(0))).withColumn("_order", order)
    inner = Window.partitionBy(*keys, spread).orderBy("_order").rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy(*keys).orderBy(spread).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*keys, spread).agg(F.sum("_v").alias("_sum")).withColumn("_base", F.coalesce(F.sum("_sum").over(outer), F.lit(0))).drop("_sum")
    rows = rows.withColumn("_part", F.sum("_v").over(inner))
    out = rows.alias("r").join(sums.alias("s"), _same(keys, spread, "r", "s")).select("r.*", "s._base")
    return out.withColumn(name, F.col("_part") + F.col("_base")).drop("_v", "_order", "_part", "_base")


def runs(df: DataFrame, keys: list[str], order: Column, spread: str, starts: Column, name: str = "run") -> DataFrame:
    """`df` with the number, from 1, of the run it belongs to; a run starts where `starts` holds."""
    return running_total(df, keys, order, spread, starts.cast("bigint"), name)
