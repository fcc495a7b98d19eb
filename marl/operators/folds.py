"""Folds of append-only tables: the latest version of a key, what is still valid, what is done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marl.plans.scratch import drop, keep


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key with the greatest `order`, compared column by column; nulls come first.

    Rows with a null key are left out. Of rows that tie in `order` the one of the greatest remaining columns is kept,
    so repeated rows give one and the result does not depend on their order. One shuffle with a partial maximum before it, so
    a key with any number of versions costs one row a task. `order` must be of orderable types.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    sortable = [c for c in rest if not _has_map(df.schema[c].dataType)]
    known = df
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    best = known.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in (*order, *rest)]), F.struct(*order, *sortable)).alias("_best"))
    return best.select(*keys, "_best.*").select(*df.columns)


def _has_map(kind) -> bool:
    name = kind.simpleString()
    return "map<" in name or "variant" in name


def minus(df: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `df` whose key is not in `gone`; a null key is never in it."""
    return df.join(gone.select(*keys).distinct(), keys, "left_anti")


def valid(df: DataFrame, decisions: DataFrame, key: str, target: str, verb: Column, at: list[str]) -> DataFrame:
    """Rows of `df` unless the latest decision on their key is one of those for which `verb` holds.

    Only the latest decision counts: a later decision of another verb makes the row valid again.
    """
    last = latest(decisions, [target], at)
    return minus(df, last.where(verb).select(F.col(target).alias(key)), [key])


def facet(df: DataFrame, key: str, strong: DataFrame, weak: DataFrame, value: str, default: str) -> DataFrame:
    """`df` with `value`: of `strong` (key, value) if there, else of `weak`, else `default`, whatever their times."""
    a, b = strong.select(key, F.col(value).alias("_a")), weak.select(key, F.col(value).alias("_b"))
    return df.join(a, key, "left").join(b, key, "left").withColumn(value, F.coalesce("_a", "_b", F.lit(default))).drop("_a", "_b")


def terminal(redirects: DataFrame, source: str = "loser", target: str = "winner") -> DataFrame:
    """(source, target) with each chain of redirects followed to its end, by doubling: log(longest chain) joins.

    A null target ends a chain as dropped and stays null. A source on a cycle, or led into one, is dropped as well. Of
    several targets of one source the greatest counts. An empty table gives no rows.
    """
    now = keep(redirects.where(F.col(source).isNotNull()).groupBy(source).agg(F.max(target).alias(target)), "redirects")
    n = now.count()
    kinds, hops = now.schema, 1
    while hops <= n:
        then = now.select(F.col(source).alias(target), F.col(target).alias("_then"), F.lit(True).alias("_hit"))
        step = now.join(then, target, "left").select(source, F.when(F.col("_hit"), F.col("_then")).otherwise(F.col(target)).alias(target), F.coalesce("_hit", F.lit(False)).alias("_moved"))
        step = keep(step, "redirects")
        moved = not step.where("_moved").isEmpty()
        drop(now)
        now, hops = step.drop("_moved"), hops * 2
        now._marl_path = step._marl_path
        if not moved:
            return now
    # What still leads to a redirected source after as many hops as there are sources goes round.
    ends = now.join(now.select(F.col(source).alias(target), F.lit(True).alias("_round")), target, "left")
    out = ends.select(source, F.when(F.col("_round").isNull(), F.col(target)).alias(target))
    return out.select(*[F.col(f.name).cast(f.dataType) for f in kinds])


def lineage(derived: DataFrame, raw: DataFrame, link: str, key: str) -> DataFrame:
    """`derived` with the columns of the raw row it comes from; null where the link is broken. One raw row a key."""
    names = [c for c in raw.columns if c != key]
    return derived.join(raw.select(F.col(key).alias(link), *[F.col(c).alias(f"raw_{c}") for c in names]), link, "left")


def handle(*parts: Column) -> Column:
    """The first part that is neither null nor empty."""
    return F.coalesce(*[F.nullif(p, F.lit("")) for p in parts])
