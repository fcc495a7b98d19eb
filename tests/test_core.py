"""Operators of the core on small tables: nulls, ties, repeats, empty tables, and order."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from marl.functions import scores, seam, text
from marl.operators import facets, folds, graphs, histogram, incremental, matching, ordered, queue, rendering, resolving, temporal, transcripts
from marl.plans.scratch import fresh_path


def test_latest_ties_nulls_and_repeats(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("a", 2, "z"), (None, 9, "n"), ("b", None, "k")], "k string, t int, v string")
    assert rows(folds.latest(df, ["k"], ["t"])) == [("a", 2, "z"), ("b", None, "k")]
    assert folds.latest(df.limit(0), ["k"], ["t"]).count() == 0


def test_valid_is_by_the_latest_decision(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    d = spark.createDataFrame([("a", "retire", 1), ("a", "keep", 2), ("b", "keep", 1), ("b", "retire", 2), (None, "retire", 3)], "target string, verb string, at int")
    assert rows(folds.valid(df, d, "id", "target", F.col("verb") == "retire", ["at"])) == [("a",), ("c",)]


def test_redirects_follow_to_the_end_and_drop_cycles(spark):
    edges = [("a", "b"), ("b", "c"), ("d", None), ("e", "d"), ("x", "y"), ("y", "x"), ("z", "x"), ("s", "s")]
    got = dict(rows(folds.terminal(spark.createDataFrame(edges, "loser string, winner string"))))
    assert got == {"a": "c", "b": "c", "d": None, "e": None, "x": None, "y": None, "z": None, "s": None}
    assert folds.terminal(spark.createDataFrame([], "loser string, winner string")).count() == 0


def test_running_total_and_previous_over_divisions(spark):
    random.seed(3)
    data = [(random.choice(["a", "b", None]), i, i // 7, random.randint(0, 5)) for i in range(60)]
    df = spark.createDataFrame(data, "k string, o int, d int, v int")
    total = {r.o: r.total for r in ordered.running_total(df, ["k"], F.col("o"), "d", F.col("v")).collect()}
    before = {r.o: r.previous for r in ordered.with_previous(df, ["k"], F.col("o"), "d", F.col("v")).collect()}
    for k, o, _, _ in data:
        mine = [(p, v) for q, p, _, v in data if q == k and p <= o]
        assert total[o] == sum(v for _, v in mine)
        assert before[o] == (mine[-2][1] if len(mine) > 1 else None)


@pytest.mark.parametrize("runs", [1, 3])
def test_incremental_target(spark, runs):
    random.seed(runs)
    data = [(random.choice(["a", "b", None]), random.choice(["1", "2", None]), i, i // 6) for i in range(40)]
    df = spark.createDataFrame(data, "k string, version string, place int, span int")
    target = incremental.Target(spark, fresh_path(spark, "t"), df.drop("span").schema)
    for i in range(runs):
        part = df.where(f"place >= {40 * i // runs} and place < {40 * (i + 1) // runs}")
        incremental.process_new(target, part, ["k"], "span")
    incremental.process_new(target, df, ["k"], "span")  # a repeated run adds nothing
    want, last = set(), {}
    for k, v, p, _ in data:
        if k not in last or last[k] != v:
            want.add(p)
        last[k] = v
    assert {r.place for r in target.rows().collect()} == want
    assert target.latest() == runs + 1
    with pytest.raises(RuntimeError):
        target.publish(df.drop("span"), 0)


def test_handled_entries(spark):
    t = dt.datetime(2026, 1, 1)
    e = lambda i, h: ("f", i, "u", h)
    schema = "run_id string, datastore string, planned_at timestamp, feed_entries array<struct<feed_url:string,entry_id:string,entry_url:string,content_hash:string>>"
    plans = spark.createDataFrame([("r1", "d", t, [e("1", "x"), e(None, "x"), e("2", "x")]), ("r1", "d", t, [e("1", "x"), e(None, "x"), e("2", "x")]), ("r2", "d", t, None), ("r3", "d", t + dt.timedelta(1), [e("1", "x"), e("1", "y"), e("2", "z")])], schema)
    reports = spark.createDataFrame([("r1", "tap", t, 1, 1), ("r1", "tap", t - dt.timedelta(1), 3, 0), ("r1", "weave", t, 9, 0), ("r3", "tap", t, 2, 0)], "run_id string, stage string, written_at timestamp, processed bigint, skipped bigint")
    got = rows(incremental.changed_entries(plans, reports, fresh_path(spark, "t")))
    assert got == [("r1", "f", "1"), ("r3", "f", "1")]


def test_components_and_leaders(spark):
    random.seed(5)
    for n, m in ((30, 25), (60, 40), (12, 40)):
        edges = [(random.randrange(n), random.randrange(n)) for _ in range(m)]
        parent = list(range(n))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            parent[max(find(a), find(b))] = min(find(a), find(b))
        got = dict(rows(graphs.components(spark.createDataFrame(edges + [(None, 1)], "a int, b int"))))
        assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
        near = {(min(e), max(e)) for e in edges if e[0] != e[1]}
        lead = {}
        for x in range(n):
            lead[x] = next((y for y in range(x) if lead[y] == y and (y, x) in near), x)
        nodes = spark.createDataFrame([(x,) for x in range(n)], "node int")
        assert dict(rows(graphs.leaders(nodes, spark.createDataFrame(sorted(near), "a int, b int")))) == lead
    assert graphs.components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a int, b int")
    assert {r.root for r in graphs.components(edges).collect()} == {0}


def test_sittings(spark):
    t = dt.datetime(2026, 1, 1)
    h = lambda x: t + dt.timedelta(hours=x)
    data = [("s1", "a", h(0)), ("s2", "a", h(12)), ("s3", "a", h(24)), ("s4", "a", h(36.01)), ("s5", None, h(0)), ("s6", "a", None), ("s7", "b", h(1))]
    df = spark.createDataFrame(data, "s string, r string, t timestamp")
    got = {r.s: r.sitting for r in temporal.sittings(df, "s", "r", "t").collect()}
    assert got["s1"] == got["s2"] == got["s3"] != got["s4"]
    assert len({got[s] for s in ("s1", "s4", "s5", "s6", "s7")}) == 5
    off = temporal.sittings(df, "s", "r", "t", hours=0)
    assert off.select("sitting").distinct().count() == 7


def test_near_counts_against_pairs(spark):
    random.seed(1)
    t = dt.datetime(2026, 1, 1)
    data = [(i, t + dt.timedelta(hours=(s := random.randint(0, 900))), t + dt.timedelta(hours=s + random.randint(0, 300))) for i in range(40)] + [(99, None, t)]
    got = dict(rows(temporal.near_counts(spark.createDataFrame(data, "id int, s timestamp, e timestamp"), "id", "s", "e")))
    gap = dt.timedelta(days=7)
    want = {i: sum(i != j and s <= f + gap and r <= e + gap for j, r, f in data[:-1]) for i, s, e in data[:-1]}
    assert got == want


def test_recency(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1),), (None,), (dt.datetime(2030, 1, 1),)], "t timestamp")
    got = [r[0] for r in df.select(scores.recency_weight(F.col("t"), "2026-06-30 00:00:00")).collect()]
    assert got == [0.5, 1.0, 1.0]


def test_signature_is_that_of_its_parts():
    form, shingles, sim, bits, bands = text.signature("Prefer X — over y!")
    assert form == "prefer x over y" and len(shingles) == 12 and 2.9 < bits < 3
    assert [(sim >> s) & 0xFFFF for s in (48, 32, 16, 0)] == bands
    assert text.signature("") == ("", [], 0, 0.0, [0, 0, 0, 0])
    assert text.signature("ab")[0] == "ab" and len(text.signature("ab")[1]) == 1


def test_text_functions(spark):
    df = spark.createDataFrame([("Hello,  World_9!",), ("",), (None,), ("ß",)], "t string")
    form = text.normalize(F.col("t"))
    got = [(r[0], r[1], None if r[2] is None else round(r[2], 3)) for r in df.select(form, F.size(text.shingles(form)), text.entropy(form)).collect()]
    assert got[0] == ("hello world 9", 10, 3.027) and got[1] == ("", 0, 0.0) and got[2][0] is None
    long = "One sentence. " + "word " * 80
    row = spark.createDataFrame([(long,)], "t string").select(text.clip(F.col("t"), 40), text.truncate(F.lit("x" * 300), 100, 20), text.slugify(F.lit("  Ab--c d! ")), text.strip_region(F.lit("a<s>b<e>c<s>d"), "<s>", "<e>")).first()
    assert row[0] == ("One sentence. " + "word " * 80)[:39].rsplit(" ", 1)[0] + "…"
    assert row[1] == "x" * 100 + " …[180 chars elided]… " + "x" * 20 and row[2] == "ab-c-d" and row[3] == "ac"
    scores_ = spark.createDataFrame([("0.5",), ("nan",), ("7",), ("x",), (None,)], "v string").select(text.clean_score(F.col("v"), 0.2))
    assert [r[0] for r in scores_.collect()] == [0.5, 0.2, 1.0, 0.2, 0.2]


def test_spans_and_lines(spark):
    blob = "äb\n\ncé"
    blobs = spark.createDataFrame([("h", blob)], "cleaned_hash string, text string")
    chunks = spark.createDataFrame([("h", 0, 3), ("h", 1, 3), ("h", 3, 5), ("h", 5, 99), ("x", 0, 1), ("h", 5, 8), ("h", None, 3)], "cleaned_hash string, byte_start bigint, byte_end bigint")
    assert rows(rendering.anchored(chunks, blobs).select("byte_start", "quote")) == [(0, "äb"), (5, "cé")]
    lines = rows(rendering.numbered_lines(blobs, ["cleaned_hash"], F.col("text"), F.lit(10)).select("line", "byte_start", "byte_end", "text"))
    assert lines == [(1, 10, 13, "äb"), (2, 14, 14, ""), (3, 15, 18, "cé")]
    span = rendering.resolve_lines(F.lit(9), F.lit(1), F.array(F.struct(F.lit(0).alias("byte_start"), F.lit(3).alias("byte_end")), F.struct(F.lit(4).alias("byte_start"), F.lit(6).alias("byte_end"))))
    assert tuple(spark.range(1).select(span.alias("s")).first()[0]) == (0, 6)


def test_context_and_sources(spark):
    df = spark.createDataFrame([("aäbcdé",)], "t string").withColumn("d", F.encode("t", "UTF-8"))
    got = df.select(text.context(F.col("d"), F.lit(3), F.lit(5), 1), text.context(F.col("d"), F.lit(0), F.lit(1), 99), text.in_source(F.lit("/Home/X"), "home"), text.in_source(F.lit(None).cast("string"), "x"), text.quarantined(F.lit("/a/b"), ["q", "A/"])).first()
    assert tuple(got) == ("\ufffdbcd", "aäbcdé", True, False, True)


def test_subjects(spark):
    spans = spark.createDataFrame([(1, "s", 0, 10), (2, "s", 9000, 9010), (3, "t", 0, 5)], "id int, k string, byte_start bigint, byte_end bigint")
    writes = spark.createDataFrame([("s", 100, 120, "/a"), ("s", 50_000, 50_010, "/b")], "k string, low bigint, high bigint, path string")
    assert {r.id: r.files for r in transcripts.subjects(spans, writes, "k").collect()} == {1: ["/a"], 2: ["/a", "/b"], 3: []}


def test_document_turns_join_back(spark):
    docs = [(1, "a\n\nb\n\n\nc", "t"), (2, None, None), (3, f"x{rendering.START} -->y{rendering.END}z", "")]
    for r in rendering.document_turns(spark.createDataFrame(docs, "id int, text string, title string"), "id", "text", "title").collect():
        parts = [r.text[t.start : t.end] for t in r.turns]
        assert "\n\n".join(parts) == r.text
    assert r.text == "[document]\n\nxz"


def test_overlaps_against_pairs(spark):
    random.seed(2)
    p = [(random.choice("ab"), i, s := random.randint(0, 200), s + random.randint(0, 60)) for i in range(30)]
    q = [(random.choice("ab"), i, s := random.randint(0, 200), s + random.randint(0, 60)) for i in range(30)]
    got = matching.overlapping(spark.createDataFrame(p, "k string, i int, start int, end int"), spark.createDataFrame(q, "k string, j int, low int, high int"), ["k"], 25)
    want = sorted((a[1], b[1]) for a in p for b in q if a[0] == b[0] and a[2] < b[3] and a[3] > b[2] and a[2] < a[3] and b[2] < b[3])
    assert sorted((r.i, r.j) for r in got.collect()) == want


def test_queue(spark):
    df = spark.createDataFrame([(i, float(i % 4), i // 3) for i in range(12)], "id int, cost double, d int")
    assert {r.id for r in queue.within_budget(df, F.col("id"), "d", F.col("cost"), 6.0).collect()} == {0, 1, 2, 3}
    done = spark.createDataFrame([(11,)], "id int")
    assert [r.id for r in queue.examine(df, done, ["id"], [F.desc("id")], 2).collect()] == [10]
    tripped = queue.breaker(df.withColumn("k", F.lit("x")), ["k"], F.col("id"), "d", F.col("id").between(4, 7), 4).first()
    assert (tripped.longest, tripped.tripped) == (4, True)
    assert queue.histogram(df.limit(0), "cost").count() == 0
    with pytest.raises(ValueError):
        queue.priority("other", F.lit(1), F.lit(1), F.lit(1))


def naive_path(n, parent, logical, turn):
    seen, path, tips = set(), [], [i for i in range(n) if turn[i]]
    at = tips[-1] if tips else -1
    while at >= 0:
        seen.add(at)
        path.append(at)
        options = [t for t in (parent[at], logical[at]) if t >= 0 and t not in seen]
        back = [i for i in tips if i < at and i not in seen]
        at = options[0] if options else back[-1] if back else -1
    return path[::-1]


def test_surviving_path_against_naive():
    random.seed(4)
    for _ in range(300):
        n = random.randint(0, 14)
        pick = lambda: np.array([random.randint(-1, max(n - 1, 0)) if n else -1 for _ in range(n)], int)
        parent, logical, turn = pick(), pick(), np.array([random.random() < 0.7 for _ in range(n)], bool)
        assert transcripts.surviving(parent, logical, turn) == naive_path(n, parent, logical, turn)


def test_rendered_session(spark):
    schema = "session_id string, pos int, type string, uuid string, parentUuid string, logicalParentUuid string, isSidechain boolean, isMeta boolean, subtype string, compactMetadata struct<trigger:string,preTokens:int>, message struct<role:string,id:string,content:string>"
    m = lambda c, i=None: ("x", i, c)
    data = [
        ("s", 0, "user", "u1", None, None, False, None, None, None, m("do it")),
        ("s", 1, "assistant", "a1", "u1", None, False, None, None, None, m('[{"type":"text","text":"yes"}]', "m1")),
        ("s", 2, "assistant", "a2", "a1", None, False, None, None, None, m('[{"type":"tool_use","id":"t1","name":"Edit","input":{"file_path":"/f.py"}}]', "m1")),
        ("s", 3, "user", "r1", "a2", None, False, None, None, None, m('[{"type":"tool_result","tool_use_id":"t1","content":"done","is_error":true}]')),
        ("s", 4, "assistant", "lost", "u1", None, False, None, None, None, m("abandoned")),
        ("s", 5, "system", "c1", None, "gone", False, None, "compact_boundary", ("auto", 7), None),
        ("s", 6, "user", "u2", "c1", None, False, True, None, None, m("caveat")),
        ("s", 7, "user", "u3", "u2", None, None, None, None, None, m("next")),
        ("s", 8, "assistant", "side", "u3", None, True, None, None, None, m("hidden")),
    ]
    df = spark.createDataFrame(data, schema)
    row = transcripts.rendered(df).first()
    assert row.text == "[user]\ndo it\n\n[compact] context compacted (auto, 7 pre-tokens)\n\n[user]\nnext" or "abandoned" in row.text
    assert [t.segment for t in row.turns][-1] == 1 and all(row.text[t.start : t.end].startswith(f"[{t.kind}]") for t in row.turns)
    whole = transcripts.rendered(df.where("pos < 4")).first().text
    assert whole == "[user]\ndo it\n\n[assistant]\nyes\n→ Edit: /f.py\n  ⤷ [error] done"
    writes = transcripts.write_lines(spark.createDataFrame([("s", whole)], "session_id string, text string"), "session_id", "text")
    assert [r.path for r in writes.collect()] == ["/f.py"]


def test_resolving(spark):
    a = "The cache must be flushed before the schema migration starts in production"
    b = "Before a production schema migration starts the cache has to be flushed by hand"
    c = "Retry network calls with exponential backoff and a bounded number of attempts"
    e = [("1", "s1", a, 9.0), ("2", "s2", a, 8.0), ("3", "s3", b, 7.0), ("4", "s4", c, 6.0), ("5", "s5", "ok", 5.0), ("6", "s1", b, 4.0)]
    df = spark.createDataFrame([(i, s, s, t, t, p, None) for i, s, t, p in e], "event_id string, session_id string, sitting string, summary string, quote string, priority double, confidence double")
    got = {r.event_id: (r.claim_id, r.by) for r in resolving.resolve(df, lambda s, titles: ("same-as", 1)).collect()}
    assert got["1"] == ("t-1", "seed") and got["2"] == ("t-1", "det") and got["3"] == ("t-1", "llm") and got["4"] == ("t-4", "seed") and got["5"] == ("t-5", "seed")
    alone = {r.event_id: (r.claim_id, r.by) for r in resolving.resolve(df).collect()}
    assert alone["3"] == ("t-3", "seed") and alone["6"] == ("t-3", "det")
    views = {r.claim_id: (r.events, r.sessions) for r in resolving.claims_of(resolving.resolve(df), df).collect()}
    assert views["t-1"] == (2, 2)


def test_seam(spark):
    assert seam.json_object('```json\n{"a": 1}\n```') == {"a": 1} and seam.json_object("no") is None
    assert seam.verdict({"verdict": "same-as-2"}, 3) == ("same-as", 2) and seam.verdict({"verdict": "same-as-4"}, 3) == ("none", 0)
    assert seam.rate_limited("HTTP 429") and not seam.rate_limited("fine")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string")

    def completer(system, user):
        if user == "b":
            raise ValueError("down")
        return seam.Completion(system + user, cost_usd=0.5)

    assert rows(seam.complete(df, "id", "s", "p", completer)) == [(1, "sa", 0.5, None), (2, None, 0.0, "ValueError: down")]


def test_facet_pairs_keep_frequent_members(spark):
    table = spark.createDataFrame([(k, "all") for k in "abcd"] + [("a", "x"), ("b", "x"), ("c", "own")], "id string, member string")
    got = {(r.a, r.b): r.shared for r in matching.facet_pairs(table, "id").collect()}
    assert got == {(a, b): ["all", "x"] if a + b == "ab" else ["all"] for i, a in enumerate("abcd") for b in "abcd"[i + 1 :]}
    assert matching.facet_pairs(table.limit(0), "id").count() == 0


def test_facet_relations_count_every_kind(spark):
    day = lambda n: (dt.datetime(2026, 1, 1) + dt.timedelta(n)).isoformat() + "+00:00"
    rng = random.Random(3)
    draw = lambda names, k: rng.sample(names, rng.randint(0, k))
    data = {f"c{i:02}": (draw(["r1", "r2", "r3", "r4"], 3), draw(["f1", "f2", "f3", "f4", "f5", "f6", "f7", "f8"], 1), draw(["t1", "t2", "t3", "t4", "t5", "t6", "t7"], 7), (a := rng.randint(0, 90), a + rng.randint(0, 5)) if i % 7 else None) for i in range(40)}
    shape = "id string, facets struct<repos:array<string>,files:array<string>,tools:array<string>,time_range:array<string>>"
    listed = [(k, (r or None, [*f, None], t, w and [day(w[0]), day(w[1])])) for k, (r, f, t, w) in data.items()]
    df = spark.createDataFrame([*listed, listed[0], (None, (["r1"], ["f1"], ["t1"], None))], shape)
    edges, near, lead, first = set(), set(), {}, []
    for b in sorted(data):
        for a in sorted(data):
            if a >= b:
                continue
            (ra, fa, ta, wa), (rb, fb, tb, wb) = data[a], data[b]
            shared = {"shares-file": sorted({*fa} & {*fb}), "shares-repo": sorted({*ra} & {*rb}), "shares-tool": sorted({*ta} & {*tb})}
            close = bool(wa and wb and max(wb[0] - wa[1], wa[0] - wb[1]) <= 7)
            edges |= {(a, b, k, tuple(v)) for k, v in shared.items() if v} | ({(a, b, "temporal-proximity", ())} if close else set())
            if 3.0 * len(shared["shares-file"]) + len(shared["shares-repo"]) + 0.5 * len(shared["shares-tool"]) + 0.25 * close >= 3.0:
                near.add((a, b))
        lead[b] = next((a for a in first if (a, b) in near), b)
        if lead[b] == b:
            first.append(b)
    assert len({k for _, _, k, _ in edges}) == 4 and len(near) > len({e[:2] for e in edges if e[2] == "shares-file"})
    got = [(r.source, r.target, r.kind, tuple(r.shared)) for r in facets.edges(df).collect()]
    assert len(got) == len(edges) and set(got) == edges
    assert rows(facets.close_pairs(df)) == sorted(near)
    assert dict(rows(graphs.leaders(df.select(F.col("id").alias("node")), facets.close_pairs(df)))) == lead
    assert facets.edges(df.limit(0)).count() == 0


def test_pairs_of_equal_lists_come_once(spark, monkeypatch):
    """Concepts that hold the same members are met in lists, whose pairs come out once within a list and between two."""
    monkeypatch.setattr(facets, "_LIST", 3)
    held = {f"c{i:02}": ["t1", "t2"] if i % 3 else ["t2", "t3"] if i % 2 else ["t4"] for i in range(30)}
    shape = "id string, facets struct<repos:array<string>,files:array<string>,tools:array<string>,time_range:array<string>>"
    df = spark.createDataFrame([(k, ([], [], t, None)) for k, t in held.items()], shape)
    want = sorted((a, b, "shares-tool", "+".join(sorted({*held[a]} & {*held[b]}))) for a in held for b in held if a < b and {*held[a]} & {*held[b]})
    assert rows(facets.edges(df, lambda shared: F.array_join(shared, "+"))) == want


@pytest.mark.parametrize("choices", [2000, 3])
def test_leaders_of_groups_are_those_of_pairs(spark, monkeypatch, choices):
    """Without a pair laid out, or with some concepts paired one by one, the leaders are the same."""
    monkeypatch.setattr(facets, "_CHOICES", choices)
    rng = random.Random(11)
    draw = lambda names, k: rng.sample(names, rng.randint(0, k))
    data = {f"c{i:02}": (draw(["r1", "r2", "r3", "r4", "r5"], 4), draw([f"f{k}" for k in range(25)], 1), draw([f"t{k}" for k in range(12)], 8)) for i in range(40)}
    shape = "id string, facets struct<repos:array<string>,files:array<string>,tools:array<string>,time_range:array<string>>"
    df = spark.createDataFrame([(k, (*v, None)) for k, v in data.items()], shape)
    score = lambda a, b: sum(w * len({*data[a][k]} & {*data[b][k]}) for k, w in enumerate((1.0, 3.0, 0.5)))
    want = {(a, b) for a in data for b in data if a < b and score(a, b) >= 3.0}
    held = facets.close_groups(df).collect()
    by = {}
    for r in held:
        by.setdefault(tuple(r.key), []).append(r.node)
    assert {(a, b) for g in by.values() for a in g for b in g if a < b} == want
    lead = {}
    for b in sorted(data):
        lead[b] = next((a for a in sorted(lead) if lead[a] == a and (a, b) in want), b)
    got = graphs.group_leaders(df.select(F.col("id").alias("node")), facets.close_groups(df))
    assert dict(rows(got)) == lead and any(k != v for k, v in lead.items())
    assert rows(graphs.group_leaders(df.select(F.col("id").alias("node")), facets.close_groups(df).limit(0))) == [(k, k) for k in sorted(data)]


@pytest.mark.parametrize("hot", [0, 3, 100])
def test_counts_of_sharing_keys(spark, hot):
    """However many members count as hot, the counts are those of the pairs, members of more than half of all left out."""
    rng = random.Random(7)
    held = {f"k{i:02}": {f"m{int(rng.expovariate(0.25))}" for _ in range(rng.randint(0, 3))} | ({"all"} if i % 3 else set()) for i in range(40)}
    table = spark.createDataFrame([(k, m) for k, ms in held.items() for m in ms], "id string, member string")
    df = {m: sum(m in ms for ms in held.values()) for m in set().union(*held.values())}
    told = {m for m, n in df.items() if n < 2 or n <= 20}
    want = {k: n for k in held if (n := sum(bool(held[k] & held[o] & told) for o in held))}
    assert "all" not in told and dict(rows(matching.shared_counts(table, "id", 40, hot=hot))) == want


def test_band_counts_take_every_pair(spark):
    rng = random.Random(5)
    base = ["the cache is cleared before each run of the build", "Ünïcode 漢字 and ascii stand side by side here", "retry the upload once, then give up"]
    said = [" ".join(w for w in rng.choice(base).split() if rng.random() < 0.8) for _ in range(60)] + ["", "ab", "abc", "aaaa aaaa", None]
    data = [(i, t, f"s{i % 4}" if i % 9 else None) for i, t in enumerate(said)]
    df = spark.createDataFrame([*data, data[0]], "id bigint, t string, s string")
    grams = lambda f: {f[i : i + 4] for i in range(max(1, len(f) - 3))} if f else set()
    full = [(text.normal_form(t), s) for _, t, s in data if t is not None]
    want = {b: [0, 0, 0] for b in histogram.BANDS}
    for i, (f, s) in enumerate(full):
        for g, o in full[:i]:
            p, q = grams(f), grams(g)
            sim = len(p & q) / len(p | q) if p and q else 0
            b = histogram.BANDS[(sim >= 0.12) + (sim >= 0.55) + (sim >= 0.7)]
            same = s is not None and s == o
            want[b][0 if same else 1] += 1
            want[b][2] += (b == "residue" or (b == "high" and not same)) and min(text.signature(f)[3], text.signature(g)[3]) >= 3.0
    assert all(sum(v) for v in want.values())
    for side in (1000, 20):
        assert {r.band: [r.same, r.other, r.asked] for r in histogram.band_counts(df, "id", "t", "s", side).collect()} == want
    assert {tuple(r)[1:] for r in histogram.band_counts(df.limit(0), "id", "t", "s").collect()} == {(0, 0, 0)}


@pytest.mark.parametrize("dense", [0, 5, 10_000])
def test_similar_pairs_whatever_is_dense(monkeypatch, dense):
    """Only pairs at the bound or above leave the comparison, and the same ones whether pieces are counted in a product or along lists."""
    monkeypatch.setattr(histogram, "_DENSE", dense)
    monkeypatch.setattr(histogram, "_ROWS", 7)
    rng = random.Random(9)
    words = ["cache", "build", "Ünï", "漢字", "retry", "once", "up", "a" + chr(0x1F600), "upload"]
    forms = [" ".join(rng.sample(words, rng.randint(1, 6))) for _ in range(30)] + ["", "", "ab", "abc"]
    grams = [{f[i : i + 4] for i in range(max(1, len(f) - 3))} if f else set() for f in forms]
    sim = lambda i, j: len(grams[i] & grams[j]) / max(1, len(grams[i] | grams[j]))
    frame = pd.DataFrame({"form": forms})
    for low in (0.12, 0.55):
        got = [(int(i), int(j), v) for block in histogram._similar(frame, None, low) for i, j, v in zip(*block)]
        assert sorted(got) == [(i, j, sim(i, j)) for i in range(34) for j in range(i + 1, 34) if sim(i, j) >= low]
        got = [(int(i), int(j) + 12, v) for block in histogram._similar(frame[:12], frame[12:], low) for i, j, v in zip(*block)]
        assert sorted(got) == [(i, j, sim(i, j)) for i in range(12) for j in range(12, 34) if sim(i, j) >= low]


@pytest.mark.parametrize("known", [True, False])
def test_changed_entries_keep_runs_of_unknown_time(spark, known):
    t = dt.datetime(2026, 1, 1)
    e = lambda i, h: ("f", i, "u", h)
    schema = "run_id string, datastore string, planned_at timestamp, feed_entries array<struct<feed_url:string,entry_id:string,entry_url:string,content_hash:string>>"
    plans = [("r1", "d", None, [e("1", "x"), e("2", "x")]), ("r2", "d", None, [e("1", "x"), e("2", "y")]), ("r3", "d", t, [e("1", "x")]), ("r4", "d", t + dt.timedelta(9), [e("1", "z")])]
    plans = plans if known else plans[:2]
    reports = spark.createDataFrame([(p[0], "tap", t, len(p[3]), 0) for p in plans], "run_id string, stage string, written_at timestamp, processed bigint, skipped bigint")
    got = rows(incremental.changed_entries(spark.createDataFrame(plans, schema), reports, fresh_path(spark, "t")))
    late = [("r1", "f", "1"), ("r1", "f", "2"), ("r2", "f", "2")]
    assert got == (sorted([*late, ("r3", "f", "1"), ("r4", "f", "1")]) if known else late)
