"""Resolving events into claims: candidates and links in joins, the ordered fold in the small groups that can meet.

An event reads the claims that earlier events founded, so the fold is sequential; events that can never meet need not
wait for each other. Texts are linked where their similarity is high enough to matter: near the duplicate's bar if no model is
asked, where the rarest pieces of both must meet and no link is lost; the residue's bar if one is, among texts that share two
of many rare pieces or a subject (`facets`). The components of these links are folded apart. Within one an event is compared only with
the claims that two channels show it, two of its eight rarest pieces in the pool or a subject, looked up in an index that
grows with the claims.

Departures from one ordered pool: rarity is counted over the claims of the component and not over all, the devaluation of subjects
over all texts and not over the claims founded so far, and a claim that grew out of several texts is met through one of them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marl.functions.text import H_MIN, J_MAYBE, character_entropy, fold, shingles
from marl.operators.graphs import components
from marl.operators.matching import frequencies, members, rarest, shared_facets
from marl.plans.scratch import drop, keep

DUP, SHOWN, RARE, RARE_MIN, QUOTE_MIN = 0.95, 3, 8, 2, 40
#: Rare pieces of a text by which others are linked to it when a model is asked; more than RARE, for rarity is counted over all texts here.
LINK_RARE = 32
WORDS = ["w0", "w1", "w2", "w3"]
#: Texts of this similarity are folded in one group when no model is asked. It lies below DUP, for a claim grows by what it takes.
DUP_LINK = 0.8
EDGES = "event_id string, claim_id string, verb string, by string, stmt_sim double"

Adjudicator = Callable[[str, list[str]], tuple[str, int]]


def claim_id(event: str) -> str:
    return f"t-{event}"


class Pool:
    """The claims of one group, with the indexes that candidates are looked up in."""

    def __init__(self):
        self.claims: dict[str, dict] = {}
        self.by_piece: dict[str, set[str]] = {}
        self.by_facet: dict[str, set[str]] = {}

    def _index(self, cid: str, pieces, facets) -> None:
        for names, index in ((pieces, self.by_piece), (facets, self.by_facet)):
            for n in names:
                index.setdefault(n, set()).add(cid)

    def found(self, e: dict) -> str:
        cid = claim_id(e["event_id"])
        self.claims[cid] = {"title": e["summary"], "pieces": set(e["pieces"]), "entropy": e["entropy"], "thin": e["thin"], "sittings": {e["sitting"]} - {None, ""}}
        self._index(cid, e["pieces"], e["facets"])
        return cid

    def take(self, cid: str, e: dict) -> None:
        """What corroborates a claim widens it; what speaks against it does not."""
        c = self.claims[cid]
        c["pieces"] |= set(e["pieces"])
        c["entropy"] = max(c["entropy"], e["entropy"])
        c["sittings"] |= {e["sitting"]} - {None, ""}
        self._index(cid, e["pieces"], e["facets"])

    def candidates(self, e: dict) -> set[str]:
        present = sorted((len(self.by_piece[p]), p) for p in e["pieces"] if p in self.by_piece)
        hits = Counter(c for _, p in present[:RARE] for c in self.by_piece[p])
        near = {c for c, n in hits.items() if n >= RARE_MIN}
        return near.union(*(self.by_facet.get(f, set()) for f in e["facets"])) - set(e["blocked"])


def settle_event(pool: Pool, e: dict, adjudicate: Adjudicator | None) -> tuple[str, str, str, float | None]:
    """(claim, verb, by, similarity) of the next event in order; the pool is brought up to date."""
    same, near = [], []
    mine = set(e["pieces"])
    for cid in pool.candidates(e) if not e["thin"] and e["entropy"] >= H_MIN else ():
        c = pool.claims[cid]
        if c["entropy"] < H_MIN:
            continue
        both = len(mine & c["pieces"])
        sim = both / (len(mine) + len(c["pieces"]) - both) if both else 0.0
        if sim >= DUP:
            same.append((-sim, cid))
        elif sim >= J_MAYBE and not c["thin"] and e["sitting"] not in c["sittings"]:
            near.append((-sim, cid))
    verb, by, chosen = "corroborates", "seed", None
    if same:
        by, chosen = "det", min(same)
    elif near and adjudicate is not None:
        near = sorted(near)[:SHOWN]
        answer, n = adjudicate(e["summary"], [pool.claims[c]["title"] for _, c in near])
        if answer in ("same-as", "contradicts") and 1 <= n <= len(near):
            verb, by, chosen = "corroborates" if answer == "same-as" else "contradicts", "llm", near[n - 1]
    if chosen is None:
        return pool.found(e), verb, by, None
    if verb == "corroborates":
        pool.take(chosen[1], e)
    return chosen[1], verb, by, round(-chosen[0], 6)


def _maps(pieces: DataFrame) -> DataFrame:
    """(unit, n, w0..w3): how many pieces a unit has, and their parity bitmap; two sets that differ in d pieces have bitmaps that differ in d bits at most."""
    word, bit = F.pmod("member", F.lit(len(WORDS))), F.shiftrightunsigned("member", 40).bitwiseAND(63).cast("int")
    flip = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    return pieces.groupBy("unit").agg(F.count("*").cast("int").alias("n"), *[F.bit_xor(F.when(word == i, flip).otherwise(F.lit(0).cast("bigint"))).alias(w) for i, w in enumerate(WORDS)])


def _met_by_prefix(maps: DataFrame, pieces: DataFrame, bar: float) -> DataFrame:
    """(a, b) of units that share one of their first pieces, rarest first: every pair of a similarity of `bar` does. Sizes and bitmaps reject in the join, without loss."""
    held = pieces.join(frequencies(pieces).where("df > 1"), "member").groupBy("unit").agg(F.array_sort(F.collect_list(F.struct("df", "member"))).alias("_all")).join(maps, "unit")
    # Pieces that no other text holds come first of all: they are part of the prefix and meet nothing.
    left = F.col("n") - F.ceil(F.col("n") * bar - 1e-9).cast("int") + 1 - (F.col("n") - F.size("_all"))
    rows = keep(held.where(left > 0).select("unit", "n", *WORDS, F.explode(F.slice("_all", F.lit(1), left)).alias("m")).select("unit", "n", *WORDS, "m.member"), "prefix")
    side = lambda c: rows.select("member", F.col("unit").alias(c), *[F.col(w).alias(f"{c}_{w}") for w in ("n", *WORDS)])
    differ = sum(F.bit_count(F.col(f"a_{w}").bitwiseXOR(F.col(f"b_{w}"))) for w in WORDS)
    room = F.floor((1 - bar) / (1 + bar) * (F.col("a_n") + F.col("b_n")) + 1e-9)
    fits = (F.col("a_n") >= bar * F.col("b_n")) & (F.col("b_n") >= bar * F.col("a_n")) & (differ <= room)
    return side("a").join(side("b"), "member").where((F.col("a") < F.col("b")) & fits).select("a", "b").distinct()


def _links(units: DataFrame, pieces: DataFrame, facets: DataFrame, bar: float, exact: bool) -> DataFrame:
    """(a, b) of units that may meet and are similar to `bar`; sizes reject before any text is fetched."""
    maps = keep(_maps(pieces), "maps")
    if exact:
        pairs = _met_by_prefix(maps, pieces, bar)
    else:
        told = pieces.join(frequencies(pieces).where("df > 1").select("member"), "member")
        rare = rarest(told, told, "unit", LINK_RARE)
        met = rare.join(told.select("member", F.col("unit").alias("other")), "member").where("unit <> other").groupBy("unit", "other").agg(F.count("*").alias("c")).where(F.col("c") >= RARE_MIN).select("unit", "other")
        met = met.union(shared_facets(facets, facets.withColumnRenamed("unit", "other"), "unit", "other", units.count()).where("unit < other"))
        size = lambda c: maps.select(F.col("unit").alias(c), F.col("n").alias(f"{c}_n"))
        pairs = met.select(F.least("unit", "other").alias("a"), F.greatest("unit", "other").alias("b")).distinct().join(size("a"), "a").join(size("b"), "b")
        pairs = pairs.where((F.col("a_n") >= bar * F.col("b_n")) & (F.col("b_n") >= bar * F.col("a_n"))).select("a", "b")
    side = lambda c: units.select(F.col("unit").alias(c), F.col("pieces").alias(f"p{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("s", F.size(F.array_intersect("pa", "pb")))
    return both.where(F.col("s") >= bar * (F.size("pa") + F.size("pb") - F.col("s"))).select("a", "b")


def resolve(events: DataFrame, adjudicate: Adjudicator | None = None, blocked: DataFrame | None = None) -> DataFrame:
    """(event_id, claim_id, verb, by, stmt_sim): one edge an event, to the claim it founds, repeats, or speaks against.

    `events` has event_id, session_id, sitting, summary, quote, priority and, if subjects are known, facets; they are taken by
    priority, highest first, then by id. An event with a thin quote founds a claim. Otherwise, of the claims that share a subject
    or two rare pieces with it, and that `blocked` (event_id, claim_id) does not keep apart: one of a similarity of 0.95 or more
    takes it; else the three nearest of 0.12 or more, with good quotes and of other sittings, go to `adjudicate` (summary,
    titles), which answers ("same-as" | "contradicts" | "none", n from 1); without one the answer is none. A claim's
    pieces and subjects grow by those of what it takes.

    Events of one text that are not thin and not blocked are decided once, by the first of them. Rows without an id are left out, repeats
    count once, a null summary has no pieces, null facets are none. A group of linked texts is streamed through one task,
    which holds its claims.
    """
    listed = F.coalesce("facets", F.array().cast("array<string>")) if "facets" in events.columns else F.array().cast("array<string>")
    rows = events.where("event_id is not null").withColumn("facets", F.array_distinct(F.array_compact(listed))).withColumn("form", fold(F.coalesce("summary", F.lit(""))))
    rows = rows.dropDuplicates(["event_id"]).withColumn("quality", character_entropy(fold(F.coalesce("quote", F.lit("")))))
    kept = (blocked if blocked is not None else events.sparkSession.createDataFrame([], "event_id string, claim_id string")).groupBy("event_id").agg(F.collect_set("claim_id").alias("blocked"))
    rows = rows.join(kept, "event_id", "left").withColumn("blocked", F.coalesce("blocked", F.array().cast("array<string>")))
    thin = F.coalesce((F.length(F.trim("quote")) < QUOTE_MIN) | (F.col("quality") < H_MIN), F.lit(True))
    rows = rows.select("event_id", F.struct(-F.coalesce("priority", F.lit(0.0)), "event_id").alias("place"), "sitting", "summary", "form", "facets", "blocked", thin.alias("thin"), character_entropy("form").alias("entropy"))
    # The first event of a text stands for it; thin and blocked ones stand for themselves.
    own = F.when(F.col("thin") | (F.size("blocked") > 0), F.concat(F.lit("e:"), "event_id")).otherwise("")
    rows = keep(rows.withColumn("own", own), "events")
    first = rows.groupBy("form", "own").agg(F.min("place")["event_id"].alias("unit"))
    chosen = first.select(F.col("unit").alias("event_id")).join(rows, "event_id").withColumnRenamed("event_id", "unit")
    units = keep(chosen.withColumn("pieces", shingles(F.col("form"))), "units")
    able = units.where(F.col("entropy") >= H_MIN)
    # The pieces of a text are distinct as they are; hashes stand for them where texts are only linked.
    pieces = keep(able.select("unit", F.explode(F.transform("pieces", lambda p: F.xxhash64(p))).alias("member")), "pieces")
    links = _links(able, pieces, members(able, "unit", "facets"), J_MAYBE if adjudicate is not None else DUP_LINK, adjudicate is None)
    roots = components(links).withColumnRenamed("node", "unit")
    listed = ("root", "place", F.col("unit").alias("event_id"), "sitting", "summary", "thin", "entropy", "pieces", "facets", "blocked")
    met = units.join(roots, "unit").select(*listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, root = Pool(), None
        for batch in batches:
            out = []
            for e in batch.to_pylist():
                if e["root"] != root:
                    pool, root = Pool(), e["root"]
                out.append((e["event_id"], *settle_event(pool, e, adjudicate)))
            columns = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if i == 4 else pa.string()) for i, c in enumerate(columns)], ["event_id", "claim_id", "verb", "by", "stmt_sim"])

    folded = keep(met.repartition("root").sortWithinPartitions("root", "place").mapInArrow(run, EDGES), "folded")
    decided = folded.withColumnRenamed("event_id", "unit").select("unit", F.struct("claim_id", "verb", "by", "stmt_sim").alias("d"))
    by_unit = rows.select("event_id", "form", "own", "entropy").join(first.select("form", "own", "unit"), ["form", "own"])
    both = by_unit.join(decided, "unit", "left")
    # Copies of a text that founded a claim repeat it; one of low entropy founds its own.
    claim = F.coalesce("d.claim_id", F.concat(F.lit("t-"), "unit"))
    copy = (F.col("event_id") != F.col("unit")) & (F.col("entropy") >= H_MIN)
    seed = F.coalesce(F.col("d.by"), F.lit("seed")) == "seed"
    alone = F.col("entropy") < H_MIN
    out = both.select(
        "event_id",
        F.when(alone, F.concat(F.lit("t-"), "event_id")).otherwise(claim).alias("claim_id"),
        F.coalesce("d.verb", F.lit("corroborates")).alias("verb"),
        F.when(alone, "seed").when(copy & seed, "det").otherwise(F.coalesce("d.by", F.lit("seed"))).alias("by"),
        F.when(copy & seed, 1.0).otherwise(F.col("d.stmt_sim")).alias("stmt_sim"),
    )
    out = keep(out, "edges")
    drop(rows, units, pieces, folded)
    return out


def claims_of(edges: DataFrame, events: DataFrame) -> DataFrame:
    """Claims as their edges have them: support and contradiction by distinct events and sessions, highest confidence, and a fingerprint of the events that support them."""
    both = edges.join(events.select("event_id", "session_id", "confidence"), "event_id", "left")
    pro, con = F.col("verb") == "corroborates", F.col("verb") == "contradicts"
    distinct = lambda c, col: F.count_distinct(F.when(c, F.col(col)))
    per_event = F.array_join(F.array_sort(F.collect_set(F.when(pro, F.col("event_id")))), "\n")
    return both.groupBy("claim_id").agg(distinct(pro, "event_id").alias("events"), distinct(pro, "session_id").alias("sessions"), distinct(con, "event_id").alias("against"), distinct(con, "session_id").alias("against_sessions"), F.max(F.coalesce("confidence", F.lit(0.5))).alias("confidence"), F.substring(F.sha2(per_event, 256), 1, 16).alias("fingerprint"))
