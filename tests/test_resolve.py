"""The resolver against a plain cascade over one ordered pool, and its end states."""

import random

import pytest
from pyspark.sql import functions as F

from marl.functions import text
from marl.operators import claims, resolving
from marl.plans import catalog

WORDS = "struct naming loop kernel tensor gradient reload buffer socket parser commit branch rebase vector shard planner lexer mutex fence arena".split()


def pieces(t):
    form = text.normal_form(t or "")
    return {form[i : i + 4] for i in range(max(1, len(form) - 3))} if form else set()


def entropy(t):
    return text.signature(t or "")[3]


def cascade(events, adjudicate=None, blocked=()):
    """(claim, verb, by) of each event, one after the other over one pool whose rarity is counted as it grows."""
    pool, out = {}, {}
    for e in sorted(events, key=lambda e: (-(e["priority"] or 0.0), e["event_id"])):
        mine, ent = pieces(e["summary"]), entropy(e["summary"])
        thin = e["quote"] is None or len(e["quote"].strip()) < 40 or entropy(e["quote"]) < 3
        best, near = None, []
        if not thin and ent >= 3:
            df = {p: sum(p in c["pieces"] for c in pool.values()) for p in mine}
            rare = sorted((n, p) for p, n in df.items() if n)[:8]
            shown = {c for c in pool if sum(p in pool[c]["pieces"] for _, p in rare) >= 2}
            for f in e.get("facets") or []:
                held = {c for c in pool if f in pool[c]["facets"]}
                if len(held) < 2 or len(held) <= 0.5 * len(pool):
                    shown |= held
            for c in shown:
                v = pool[c]
                if v["entropy"] < 3 or (e["event_id"], c) in blocked:
                    continue
                sim = len(mine & v["pieces"]) / len(mine | v["pieces"])
                if sim >= 0.95:
                    best = min(best or (1, ""), (-sim, c))
                elif sim >= 0.12 and not v["thin"] and e["sitting"] not in v["sittings"]:
                    near.append((-sim, c))
        verb, by, to = "corroborates", "seed", None
        if best:
            by, to = "det", best[1]
        elif near and adjudicate:
            near = sorted(near)[:3]
            said, n = adjudicate(e["summary"], [pool[c]["title"] for _, c in near])
            if said != "none":
                by, to, verb = "llm", near[n - 1][1], "corroborates" if said == "same-as" else "contradicts"
        if to is None:
            to = f"t-{e['event_id']}"
            pool[to] = {"title": e["summary"], "pieces": mine, "entropy": ent, "thin": thin, "sittings": {e["sitting"]}, "facets": set(e.get("facets") or [])}
        elif verb == "corroborates":
            v = pool[to]
            v["pieces"] |= mine
            v["entropy"] = max(v["entropy"], ent)
            v["sittings"].add(e["sitting"])
            v["facets"] |= set(e.get("facets") or [])
        out[e["event_id"]] = (to, verb, by)
    return out


SCHEMA = "event_id string, session_id string, sitting string, summary string, quote string, confidence double, priority double, facets array<string>"


def frame(spark, events):
    return spark.createDataFrame([(e["event_id"], e["sitting"], e["sitting"], e["summary"], e["quote"], 0.5, e["priority"], e.get("facets")) for e in events], SCHEMA)


def made(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        if out and rng.random() < 0.5:
            words = rng.choice(out)["summary"].split()
            for _ in range(rng.choice([0, 0, 1, 4])):
                words[rng.randrange(len(words))] = rng.choice(WORDS) + str(rng.randint(0, 99))
            said = " ".join(words)
        else:
            said = " ".join(rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(rng.randint(20, 26)))
        out.append({"event_id": f"{i:03}", "sitting": f"s{rng.randint(0, 9)}", "summary": said, "quote": said if rng.random() < 0.9 else "short", "priority": rng.choice([0.1, 0.5, None])})
    return out


def got(df):
    return {r.event_id: (r.claim_id, r.verb, r.by) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_as_the_cascade(spark, seed):
    events = made(seed, 120)
    assert got(resolving.resolve(frame(spark, events))) == cascade(events)


def test_as_the_cascade_on_the_tables(spark, data):
    e = spark.read.parquet(f"{data}/resolved_event.parquet")
    rows = e.select(F.col("event_id").cast("string").alias("event_id"), "session_id", "quote", catalog.scores.salience(F.col("markers"), F.col("confidence")).alias("p")).dropDuplicates(["event_id"]).collect()
    events = [{"event_id": r.event_id, "sitting": r.session_id, "summary": r.quote, "quote": r.quote, "priority": r.p} for r in rows]
    assert got(resolving.resolve(frame(spark, events))) == cascade(events)


def test_with_a_model(spark):
    """Lessons with words of their own, each told a few times: rarity over all texts and over the pool show the same claims."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    events = []
    for g in range(10):
        own = [word() for _ in range(16)]
        for k in range(5):
            said = " ".join(rng.sample(own, 12))
            events.append({"event_id": f"{k}{g}", "sitting": f"s{rng.randint(0, 3)}", "summary": said, "quote": said, "priority": rng.choice([0.1, 0.5])})
    for answer in (lambda summary, titles: ("same-as", 1), lambda summary, titles: ("contradicts", len(titles)), lambda summary, titles: ("none", 0)):
        found = got(resolving.resolve(frame(spark, events), answer))
        assert found == cascade(events, answer)
    assert found == {e["event_id"]: (f"t-{e['event_id']}", "corroborates", "seed") for e in events}


A = "prefer the small staging table over the wide one when nightly loads collide with the reporting window"
B = "nightly loads collide with the reporting window, so write the small staging table and leave the wide one alone"


def test_end_states(spark):
    e = lambda i, s, t, f=(): {"event_id": i, "sitting": s, "summary": t, "quote": t, "priority": 0.1, "facets": list(f)}
    pair = [e("1", "s1", A, ["repo:alpha"]), e("2", "s2", B, ["repo:beta"])]
    asked = spark.sparkContext.accumulator(0)

    def yes(summary, titles):
        asked.add(1)
        return "same-as", 1

    merged = resolving.resolve(frame(spark, pair), yes)
    assert {r[0] for r in got(merged).values()} == {"t-1"} and got(merged)["2"][2] == "llm" and asked.value == 1
    # Words apart, one subject: only the subject's channel shows the claim; what is too far from it is not asked about.
    far = [e("1", "s1", A), e("2", "s2", "unrelated quartz jumped over vexing dwarves by the lake at midnight")]
    assert got(resolving.resolve(frame(spark, far), yes))["2"][2] == "seed" and asked.value == 1
    # Of one sitting: never asked.
    assert got(resolving.resolve(frame(spark, [e("1", "s", A), e("2", "s", B)]), yes))["2"][2] == "seed" and asked.value == 1
    # A contradiction leaves the claim's signature as it is.
    against = resolving.resolve(frame(spark, [*pair, e("3", "s3", B)]), lambda s, t: ("contradicts", 1))
    assert got(against)["2"][:2] == ("t-1", "contradicts")
    # A rejected merge: the pair never forms again, the event founds its own claim, and its key is a new one.
    blocked = spark.createDataFrame([("2", "t-1")], "event_id string, claim_id string")
    assert got(resolving.resolve(frame(spark, pair), yes, blocked)) == {"1": ("t-1", "corroborates", "seed"), "2": ("t-2", "corroborates", "seed")}
    assert resolving.resolve(frame(spark, pair).limit(0)).count() == 0


def test_retraction_is_as_if_never_matched(spark):
    edges = "event_id string, verb string, claim_id string, session_id string, active boolean, at int"
    events = spark.createDataFrame([("1", "s1", "alpha", ["/a"], 0.5, (0.1, 0.2, 0.3)), ("2", "s2", "beta", ["/b"], 0.9, None)], "event_id string, session_id string, repo string, files array<string>, confidence double, markers struct<surprise:double,insight:double,research:double>")
    rows = [("1", "corroborates", "c", "s1", True, 1), ("2", "corroborates", "c", "s2", True, 1)]
    both = spark.createDataFrame(rows, edges)
    before = claims.folded(claims.live_edges(both), events).first()
    assert (before.support, before.scope, before.repos, before.scope_repo, before.confidence) == (2, "cross-cutting", ["alpha", "beta"], "global", 0.9)
    gone = both.union(claims.retracted(both.where("event_id = '2'"), F.lit(2)))
    never = claims.folded(claims.live_edges(spark.createDataFrame(rows[:1], edges)), events).first()
    assert claims.folded(claims.live_edges(gone), events).first() == never and (never.support, never.scope, never.scope_repo) == (1, "local", "alpha")
    timed = claims.live_edges(both).join(events.select("event_id", "repo"), "event_id").withColumn("ts", F.to_timestamp(F.lit("2026-05-30")))
    stand = claims.standing(timed, "session_id", "repo", "ts", "2026-06-01 00:00:00").first()
    assert stand.mature and stand.active and stand.support == 2
    assert not claims.standing(timed.where("event_id = '1'"), "session_id", "repo", "ts", "2026-06-01 00:00:00").first().mature


def test_rejections_and_lifecycle(spark):
    d = spark.createDataFrame(
        [("reject-merge", None, "2026-01-02", "2|corroborates|t-1", None), ("reject-merge", "2", "2026-01-03", None, ["t-9", "t-1"]), ("reopen", "5", "2026-01-01", None, None), ("retire", "t-4", "2026-01-01", None, None), ("retire", "t-6", "2026-03-01", None, None), ("accept", "t-7", "2026-03-01", None, None)],
        "verb string, target string, at string, edge string, pair array<string>",
    )
    said = claims.rejected(d)
    assert {r.edge for r in said.edges.collect()} == {"2|corroborates|t-1"}
    assert {tuple(r) for r in said.pairs.collect()} == {("2", "t-1"), ("t-1", "t-9")}
    assert {tuple(r) for r in said.epochs.collect()} == {("2", 2)} and {tuple(r) for r in said.reopened.collect()} == {("2", "2026-01-03"), ("5", "2026-01-01")}
    keys = said.epochs.select(claims.done_key(F.col("event_id"), F.col("epoch")).alias("k"), claims.done_key(F.lit("x"), F.lit(None).cast("bigint")).alias("n")).first()
    assert tuple(keys) == ("2#e2", "x")
    edges = spark.createDataFrame([("2", "corroborates", "t-1", True, 1), ("2", "corroborates", "t-1", True, 9), ("3", "corroborates", "t-1", True, 1), ("3", "corroborates", "t-1", False, 2), ("4", "guesses", "t-1", True, 1), ("5", "contradicts", "t-1", True, 1)], "event_id string, verb string, claim_id string, active boolean, at int")
    assert [r.event_id for r in claims.live_edges(edges, said.edges).collect()] == ["5"]
    born = spark.createDataFrame([("t-4", "2026-02-01", 1), ("t-6", "2026-02-01", 1), ("t-7", "2026-02-01", 1), ("t-8", None, 1)], "claim_id string, born string, at int")
    live = claims.live_claims(born, d)
    assert {r.claim_id for r in live.collect()} == {"t-4", "t-7", "t-8"}
    stand = spark.createDataFrame([("t-7", True), ("t-4", True)], "claim_id string, mature boolean")
    assert [r.claim_id for r in claims.trusted(live, d, stand).collect()] == ["t-7"]


def test_merges(spark):
    edges = spark.createDataFrame([(e, v, c, True, 1) for e, v, c in [("1", "corroborates", "w"), ("1", "corroborates", "l"), ("2", "contradicts", "l"), ("3", "corroborates", "m"), ("2", "contradicts", "m")]], "event_id string, verb string, claim_id string, active boolean, at int")
    merges = spark.createDataFrame([("l", "w"), ("m", "l"), ("x", "x")], "loser string, winner string")
    new = claims.merged(edges, merges, F.lit(2))
    after = claims.live_edges(edges.union(new.select(edges.columns)))
    assert {(r.event_id, r.verb, r.claim_id) for r in after.collect()} == {("1", "corroborates", "w"), ("2", "contradicts", "w"), ("3", "corroborates", "w")}
    blocked = spark.createDataFrame([("l", "w")], "a string, b string")
    assert claims.merged(edges, merges.where("loser = 'l'"), F.lit(2), blocked).count() == 0
