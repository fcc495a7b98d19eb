"""All pairs of similar sets, exactly, by pigeonhole partitioning.

Two sets of sizes a <= b with a Jaccard similarity of t or more differ in at most H = (1-t)/(1+t) * (a+b) members. Sizes
fall into classes; a set is indexed under the class of its own size and probes every class of sizes it can be the smaller partner in.
In a class the token universe is split into m parts by hash. A probing set spends H+1 units on its
segments, none, one or two on each: one unit asks for an equal segment, two for a segment that differs in at most one
member. Frequent members share a segment of their own, so that the others are made of rare ones. Were all asked in vain, the sets would differ in H+1 members or more; so no pair is missed. Units go where they
match least, by the number of sets that hold each member, so that segments of frequent members, or of none, ask nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marl.plans.scratch import drop, keep

SIM_MIN = 0.6
#: The sizes of one class differ by this factor at most.
CLASS_RATIO = 1.2
_EPS = 1e-9
#: A member that more than this share of the sets hold is frequent: frequent members share one segment.
FREQUENT = 0.005


def class_of(n: int) -> tuple[int, int, int]:
    """(least size, largest size, segments) of the class that holds size n."""
    low = 1
    while True:
        high = max(low, int(low * CLASS_RATIO))
        if n <= high:
            return low, high, segments(high)
        low = high + 1


def differ_most(a: int, b: int, least: float) -> int:
    return int((1 - least) / (1 + least) * (a + b) + _EPS)


def segments(high: int, least: float = SIM_MIN) -> int:
    """Enough for two units in each to cover the largest difference, and a third more to choose from."""
    return max(2, -(-(differ_most(high, high, least) + 1) * 2 // 3))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Parts:
    """The segments, in one class, of the sets that `chosen` marks, all worked out at once.

    Segment 0 holds the frequent members, the others split the rest. `total` has for each set and segment the sum of
    its mixed members, which stands for what the segment holds.
    """

    def __init__(self, owner: np.ndarray, member: np.ndarray, held: np.ndarray, chosen: np.ndarray, low: int, m: int, frequent: float):
        self.low, self.m = low, m
        self.sets = np.flatnonzero(chosen)
        row = np.cumsum(chosen) - 1
        inside = chosen[owner]
        self.row, self.held = row[owner[inside]], held[inside]
        self.mixed = _mix(member[inside] + np.uint64(m))
        light = (self.mixed % np.uint64(m)).astype(np.int64) + 1
        self.seg = np.where(self.held > frequent, 0, light)
        self.at = self.row * (m + 1) + self.seg
        self.total = np.zeros(len(self.sets) * (m + 1), np.uint64)
        np.add.at(self.total, self.at, self.mixed)

    def keys(self, total: np.ndarray, at: np.ndarray, gone: bool) -> np.ndarray:
        seg = (at % (self.m + 1)).astype(np.uint64)
        return _mix(total ^ _mix(seg * np.uint64(4) + np.uint64(self.low << 34) + np.uint64(gone))).view(np.int64)

    def set_of(self, at: np.ndarray) -> np.ndarray:
        return self.sets[at // (self.m + 1)]

    def costs(self, sets: int) -> tuple[np.ndarray, np.ndarray]:
        """About how many sets one unit, and two, on each segment of each set match, as (sets x segments)."""
        size = len(self.total)
        order = np.lexsort((self.held, self.at))
        at, held = self.at[order], self.held[order].astype(float)
        count = np.bincount(at, minlength=size)
        first = np.r_[0, np.cumsum(count)[:-1]]
        held = np.r_[held, 0.0, 0.0]
        rare = np.where(count > 0, held[first], sets)
        next_ = np.where(count > 1, held[first + 1], sets)
        empty = sets * (1 - 1 / self.m) ** self.low
        one = np.where(count > 1, rare * 0.5, np.where(count > 0, rare, empty))
        two = np.where(count > 1, rare + next_, np.where(count > 0, rare + empty, sets * 2.0))
        # A set of several frequent members is about as rare as they are together.
        share = np.maximum(self.held / sets, 0.02)
        product = np.zeros(size)
        np.add.at(product, self.at, 0.7 * np.log(share))
        zero = np.arange(size) % (self.m + 1) == 0
        together = sets * np.exp(product)
        rarest = np.maximum(rare / sets, 0.02) ** 0.7
        one = np.where(zero & (count > 0), together, one)
        two = np.where(zero & (count > 0), together / rarest + 10 * together, two)
        shape = (len(self.sets), self.m + 1)
        return one.reshape(shape), two.reshape(shape)


def _spend(units: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """How many units each segment gets, `units` of each set in all or a few more, at a low total cost."""
    half = two / 2
    early, late = np.minimum(one, half), np.maximum(two - one, half)
    both = np.concatenate([early, np.maximum(early, late)], axis=1)
    rank = np.empty(both.shape, np.int64)
    order = np.argsort(both, axis=1, kind="stable")
    np.put_along_axis(rank, order, np.broadcast_to(np.arange(both.shape[1]), both.shape), axis=1)
    taken = rank < units[:, None]
    given = taken[:, : one.shape[1]].astype(np.int64) + taken[:, one.shape[1] :]
    return np.where((given == 1) & (two < one), 2, given)


def signature_rows(owner: np.ndarray, member: np.ndarray, held: np.ndarray, n: np.ndarray, least: float, sets: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(keys, sets, asks) of a batch of sets: what is indexed of each, and what each asks for."""
    frequent = max(4.0, sets * FREQUENT)
    size, top = 1, int(n.max() / least + _EPS) if len(n) else 0
    while size <= top:
        low, high, m = class_of(size)
        size = high + 1
        own = (n >= low) & (n <= high)
        if own.any():
            p = _Parts(owner, member, held, own, low, m, frequent)
            at = np.arange(len(p.total))
            yield p.keys(p.total, at, False), p.set_of(at), False
            yield p.keys(p.total[p.at] - p.mixed, p.at, True), p.sets[p.row], False
        asks = (n <= high) & (np.floor(n / least + _EPS) >= low)
        if asks.any():
            p = _Parts(owner, member, held, asks, low, m, frequent)
            mine = n[p.sets]
            units = np.array([differ_most(int(a), min(high, int(a / least + _EPS)), least) + 1 for a in mine])
            given = _spend(units, *p.costs(sets)).ravel()
            at = np.flatnonzero(given)
            yield p.keys(p.total[at], at, False), p.set_of(at), True
            at = np.flatnonzero(given > 1)
            yield p.keys(p.total[at], at, True), p.set_of(at), True
            out = given[p.at] > 1
            yield p.keys(p.total[p.at[out]] - p.mixed[out], p.at[out], False), p.sets[p.row[out]], True


def _signatures(sets: DataFrame, least: float, total: int) -> DataFrame:
    """(key, set_id, n, bits0, bits1, probes) of `sets` (set_id, members, held), two arrays of equal length."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for start in range(0, len(whole), 1000):
                batch = whole.iloc[start : start + 1000]
                n = batch["members"].map(len).to_numpy(np.int64)
                owner = np.repeat(np.arange(len(n)), n)
                member = np.concatenate(batch["members"].tolist()).astype(np.int64).view(np.uint64)
                held = np.concatenate(batch["held"].tolist()).astype(np.int64)
                bits = np.zeros((len(n), 2), np.uint64)
                place = _mix(member + np.uint64(1)) % np.uint64(128)
                np.bitwise_or.at(bits, (owner, (place >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (place & np.uint64(63)))
                ids = batch["set_id"].to_numpy()
                for keys, rows, asks in signature_rows(owner, member, held, n, least, total):
                    yield pd.DataFrame({"key": keys, "set_id": ids[rows], "n": n[rows].astype(np.int32), "bits0": bits[rows, 0].view(np.int64), "bits1": bits[rows, 1].view(np.int64), "probes": asks})

    return sets.mapInPandas(run, "key bigint, set_id bigint, n int, bits0 bigint, bits1 bigint, probes boolean")


def similar_pairs(df: DataFrame, key: str, members: str, least: float = SIM_MIN) -> DataFrame:
    """(id_a, id_b), id_a < id_b, of all keys of `df` whose sets have a Jaccard similarity of `least` or more.

    `members` is an array of strings; nulls in it and repeats do not count. Rows with a null key, a null array or nothing
    in it take no part. Rows of one key make one set, the union of them. Keys with equal sets are compared as one set and
    all pairs of them belong to the result. An empty table gives no rows; other columns are ignored. A set is one row and is held in one
    task; a member may belong to any number of sets.
    """
    rows = df.select(F.col(key).alias("id"), F.explode(members).alias("member")).where("id is not null and member is not null")
    held = rows.select("id", F.xxhash64("member").alias("member")).distinct()
    by_id = held.groupBy("id").agg(F.array_sort(F.collect_set("member")).alias("members"))
    by_id = keep(by_id.withColumn("h1", F.xxhash64("members")).withColumn("h2", F.xxhash64(F.lit(7), "members")), "sets")
    sets = keep(by_id.groupBy("h1", "h2").agg(F.first("members").alias("members"), F.count("*").alias("copies")).withColumn("set_id", F.xxhash64("h1", "h2")), "distinct")
    tokens = sets.select("set_id", F.explode("members").alias("member"))
    counted = tokens.groupBy("member").agg(F.count("*").alias("held"))
    priced = tokens.join(counted, "member").groupBy("set_id").agg(F.collect_list(F.struct("member", "held")).alias("m"))
    priced = priced.select("set_id", F.col("m.member").alias("members"), F.col("m.held").alias("held"))
    signs = keep(_signatures(priced, least, sets.count()), "signatures")
    index = signs.where("not probes").select("key", F.col("set_id").alias("b"), F.col("n").alias("nb"), F.col("bits0").alias("b0"), F.col("bits1").alias("b1"))
    probe = signs.where("probes").select("key", F.col("set_id").alias("a"), F.col("n").alias("na"), "bits0", "bits1")
    # Each member in which two sets differ changes one bit at most.
    differ = F.bit_count(F.col("bits0").bitwiseXOR(F.col("b0"))) + F.bit_count(F.col("bits1").bitwiseXOR(F.col("b1")))
    close = differ <= F.floor((1 - least) / (1 + least) * (F.col("na") + F.col("nb")) + _EPS)
    near = probe.join(index, "key").where((F.col("na") <= F.col("nb")) & (F.col("na") >= least * F.col("nb") - _EPS) & (F.col("a") != F.col("b")) & close)
    near = keep(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")
    side = lambda c: sets.select(F.col("set_id").alias(c), F.col("members").alias(f"{c}_m"))
    both = near.join(side("a"), "a").join(side("b"), "b").withColumn("shared", F.size(F.array_intersect("a_m", "b_m")))
    good = keep(both.where(F.col("shared") / (F.size("a_m") + F.size("b_m") - F.col("shared")) >= least).select("a", "b"), "pairs")
    ids = by_id.withColumn("set_id", F.xxhash64("h1", "h2")).select("id", "set_id")
    names = lambda c: ids.select(F.col("set_id").alias(c), F.col("id").alias(f"{c}_id"))
    across = good.join(names("a"), "a").join(names("b"), "b").select("a_id", "b_id")
    several = sets.where("copies > 1").select("set_id")
    equal = ids.join(several, "set_id")
    within = equal.select("set_id", F.col("id").alias("a_id")).join(equal.select("set_id", F.col("id").alias("b_id")), "set_id").where("a_id < b_id").select("a_id", "b_id")
    out = keep(across.union(within).select(F.least("a_id", "b_id").alias("id_a"), F.greatest("a_id", "b_id").alias("id_b")), "similar")
    drop(by_id, sets, signs, near, good)
    return out


def concept_members(df: DataFrame) -> DataFrame:
    """(id, members) of concepts: files, tools and repos, each with its kind, trimmed; concepts without a file left out."""
    part = lambda name: F.transform(F.coalesce(F.col(f"facets.{name}"), F.array().cast("array<string>")), lambda x: F.regexp_replace(x, r"^[\s ]+|[\s ]+$", ""))
    named = lambda name: F.transform(F.filter(part(name), lambda x: x.isNotNull() & (x != "")), lambda x: F.concat(F.lit(f"{name}:"), x))
    return df.select("id", named("files").alias("f"), named("tools").alias("t"), named("repos").alias("r")).where(F.size("f") > 0).select("id", F.concat("f", "t", "r").alias("members"))
