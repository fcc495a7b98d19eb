"""Components, greedy choices and leader clusters of graphs, all of it in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marl.plans.scratch import drop, keep


def _to_least(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """One star step. `pairs` has each neighbour `v` of each `u`; every neighbour is linked to the least one."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = pairs.join(least, "u")
    if larger_only:
        out = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def _is_stars(pairs: DataFrame) -> bool:
    """Whether each `u` has one `v`, and no `v` is a `u`: then nothing is left to do."""
    ends = pairs.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(pairs.select("v", F.lit(0), F.lit(1)))
    counts = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return counts.where((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0))).isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, root) for every node of `edges`; root is the least node that links lead to.

    Null ends and loops are ignored; no edges give no rows. Alternating large and small stars end after a number of
    rounds that grows with the logarithm of the number of nodes, whatever the diameter, and no task ever holds a component: a star's centre
    is spread by the join's skew handling and its minimum is taken before the shuffle.
    """
    now = keep(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct(), "cc")
    for _ in range(rounds):
        if _is_stars(now):
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        after = keep(_to_least(_to_least(both, True), False), "cc")
        drop(now)
        now = after
    raise RuntimeError("the components did not settle")


def settle(open_: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, ok) for the texts of `open_` (id, closed) that can be decided in order: a text is accepted when it is closed
    and every earlier neighbour is rejected, and rejected when an earlier neighbour is accepted.

    `edges` has (x, y) with y earlier than x. Each round decides at least the first open text of every component; rounds
    number as many as accepted and rejected neighbours alternate in a chain.
    """
    state = keep(open_.select("id", "closed", F.lit(None).cast("boolean").alias("ok")), "state")
    while True:
        of = state.select(F.col("id").alias("y"), F.coalesce(F.col("ok").cast("int"), F.lit(-1)).alias("y_ok"))
        before = edges.join(of, "y").groupBy("x").agg(F.max(F.col("y_ok") == 1).alias("hit"), F.max(F.col("y_ok") == -1).alias("wait"))
        step = state.join(before.withColumnRenamed("x", "id"), "id", "left")
        ok = F.when(F.col("ok").isNotNull(), F.col("ok")).when(F.col("hit"), F.lit(False)).when(F.col("closed") & ~F.coalesce("wait", F.lit(False)), F.lit(True))
        new = keep(step.select("id", "closed", ok.alias("ok")), "state")
        before_n, now_n = state.where("ok is not null").count(), new.where("ok is not null").count()
        drop(state)
        state = new
        if before_n == now_n:
            return state.select("id", "ok")


def leaders(nodes: DataFrame, near: DataFrame) -> DataFrame:
    """(node, leader): each node in its order joins the first leader it is near to, or becomes a leader itself.

    `near` has the pairs (a, b), a < b, that are near enough, and the order is that of the ids. Who leads is settled in
    rounds over the pairs; nothing is walked in one task. Null nodes are left out and repeats count once.
    """
    nodes = nodes.where("node is not null").distinct()
    edges = near.select(F.col("b").alias("x"), F.col("a").alias("y")).distinct()
    ok = settle(nodes.select(F.col("node").alias("id"), F.lit(True).alias("closed")), edges)
    first = edges.join(ok.where("ok").select(F.col("id").alias("y")), "y").groupBy("x").agg(F.min("y").alias("leader"))
    return ok.join(first.withColumnRenamed("x", "id"), "id", "left").select(F.col("id").alias("node"), F.when(F.col("ok"), F.col("id")).otherwise(F.col("leader")).alias("leader"))


def group_leaders(nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """(node, leader) as of `leaders`, where two nodes are near if they share a group of `groups` (node, key).

    No pair is laid out: in each round a node that is the first of all its groups leads, and the others of these groups are
    decided. A group has one leader at most. The work of a round grows with the rows of `groups`.
    """
    nodes = nodes.where("node is not null").distinct()
    told = groups.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    whole = keep(groups.join(told, "key"), "groups")
    now, led = whole, []
    while not now.isEmpty():
        first = now.groupBy("key").agg(F.min("node").alias("first"))
        met = keep(now.join(first, "key"), "firsts")
        ok = met.groupBy("node").agg(F.min(F.col("node") == F.col("first")).alias("ok")).where("ok").select("node")
        taken = keep(met.where("node = first").join(ok, "node").select("key", F.col("node").alias("leader")), "led")
        left = keep(met.select("node", "key").join(met.join(taken.select("key"), "key").select("node").distinct(), "node", "left_anti"), "groups")
        led.append(taken)
        drop(met)
        if now is not whole:
            drop(now)
        now = left
    if not led:
        return nodes.select("node", F.col("node").alias("leader"))
    leads = led[0]
    for more in led[1:]:
        leads = leads.union(more)
    found = whole.join(leads, "key").groupBy("node").agg(F.min("leader").alias("leader"))
    return nodes.join(found, "node", "left").select("node", F.coalesce("leader", "node").alias("leader"))
