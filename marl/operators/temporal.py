"""Sittings, recency-weighted support, and nearness in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marl.functions.scores import COALESCE_HOURS, NEAR_SECONDS, age_days, recency_weight, seconds
from marl.operators.ordered import runs, with_previous


def sittings(df: DataFrame, session: str, repo: str, ts: str, keys: list[str] = (), hours: float = COALESCE_HOURS) -> DataFrame:
    """`df` with `sitting`: sessions of one repo whose gap to the session just before is `hours` or less share one.

    A session without a repo or a time is a sitting of its own, and so is every session if `hours` is 0 or less; the
    name of a sitting is its repo and number, or the session. `df` has one row for each of `keys` and session. A repo
    of any size is spread by day.
    """
    alone = F.col(repo).isNull() | F.col(ts).isNull() | F.lit(hours <= 0)
    single = df.where(alone).withColumn("sitting", F.concat(F.lit("session:"), F.col(session).cast("string")))
    many = df.where(~alone).withColumn("_day", F.to_date(ts))
    place = F.struct(ts, session)
    many = with_previous(many, [*keys, repo], place, "_day", F.col(ts), "_last")
    new = F.col("_last").isNull() | (seconds(F.col(ts)) - seconds(F.col("_last")) > hours * 3600)
    many = runs(many, [*keys, repo], place, "_day", new, "_run")
    named = many.withColumn("sitting", F.concat(F.lit("repo:"), F.col(repo).cast("string"), F.lit(":"), F.col("_run").cast("string")))
    return single.unionByName(named.drop("_day", "_last", "_run"))


def entrenchment(df: DataFrame, claim: str, session: str, repo: str, ts: str, contra: Column, now: str, hours: float = COALESCE_HOURS) -> DataFrame:
    """(claim, support, contradictions, entrenchment): each distinct sitting for a claim adds the recency weight of its
    latest time, each against it subtracts; the two sides are grouped alike and apart. Rows of a session repeat freely;
    its latest time and least repo count. Null claims and sessions are left out."""
    rows = df.where(F.col(claim).isNotNull() & F.col(session).isNotNull()).withColumn("_contra", contra)
    rows = rows.groupBy(claim, "_contra", session).agg(F.max(ts).alias(ts), F.min(repo).alias(repo))
    sat = sittings(rows, session, repo, ts, [claim, "_contra"], hours)
    each = sat.groupBy(claim, "_contra", "sitting").agg(F.max(ts).alias("_t"))
    weight = recency_weight(F.col("_t"), now)
    signed = F.when(F.col("_contra"), -weight).otherwise(weight)
    count = lambda c: F.count(F.when(c, 1))
    return each.groupBy(claim).agg(count(~F.col("_contra")).alias("support"), count(F.col("_contra")).alias("contradictions"), F.sum(signed).alias("entrenchment"))


def near_counts(df: DataFrame, key: str, start: str, end: str, within: float = NEAR_SECONDS) -> DataFrame:
    """(key, near): with how many other intervals each one overlaps or lies within `within` seconds of.

    The pairs are never formed: of all intervals, those that end too early and those that start too late are counted,
    by running counts over the distinct days and, within a day, over its ends. Null ends take no part.
    """
    rows = df.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select(key, seconds(F.col(start)).alias("s"), seconds(F.col(end)).alias("e"))
    total = rows.count()
    early = _less_than(rows, "e", rows.select(key, (F.col("s") - within).alias("x")), key, "early")
    late = _less_than(rows.select((-F.col("s")).alias("e")), "e", rows.select(key, (-F.col("e") - within).alias("x")), key, "late")
    both = rows.select(key).join(early, key).join(late, key)
    return both.select(key, (F.lit(total) - F.col("early") - F.col("late") - 1).alias("near"))


def _less_than(values: DataFrame, value: str, asked: DataFrame, key: str, name: str) -> DataFrame:
    """(key, name): how many of `values` are less than the `x` of each asked row."""
    day = lambda c: F.floor(c / 86400)
    marks = values.select(F.col(value).alias("x"), F.lit(None).alias(key).cast(asked.schema[key].dataType), F.lit(1).alias("c"), F.lit(1).alias("o"))
    marks = marks.union(asked.select("x", key, F.lit(0), F.lit(0))).withColumn("d", day(F.col("x")))
    base = marks.groupBy("d").agg(F.sum("c").alias("in_day")).withColumn("base", F.coalesce(F.sum("in_day").over(Window.orderBy("d").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # Asked rows (o = 0) come before values of the same x, so that the count is of lesser ones.
    inside = F.coalesce(F.sum("c").over(Window.partitionBy("d").orderBy("x", "o").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = marks.withColumn("inside", inside).where("o = 0").join(base.select("d", "base"), "d")
    return counted.select(key, (F.col("inside") + F.col("base")).cast("bigint").alias(name))


def runs_since(df: DataFrame, key: str, ts: Column, runs: DataFrame, at: str) -> DataFrame:
    """(key, runs): how many of `runs` came after the time of each row, without pairing rows and runs. Null times take no part."""
    asked = df.select(key, (-seconds(ts)).alias("x")).where("x is not null")
    stamps = runs.where(F.col(at).isNotNull()).select((-seconds(F.col(at))).alias("e"))
    return _less_than(stamps, "e", asked, key, "runs")


def forgotten(df: DataFrame, key: str, ts: Column, runs: DataFrame, at: str, salience: Column, now: str, tau: int = 4, floor: float = 0.05, days: float = 7) -> DataFrame:
    """Rows that `tau` runs or more have passed over, of a salience below `floor`, and at least `days` old."""
    low = df.where((salience < floor) & (age_days(ts, now) >= days))
    passed = runs_since(low, key, ts, runs, at).where(F.col("runs") >= tau)
    return low.join(passed.select(key), key, "left_semi")


def stale(df: DataFrame, ts: Column, now: str, days: float = 270) -> DataFrame:
    """Rows whose time is more than `days` before `now`; unknown times are fresh."""
    return df.where(age_days(ts, now) > days)
