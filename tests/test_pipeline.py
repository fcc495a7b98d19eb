"""Runs that fail, race and are repeated; the run loop; extraction through scripted models."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from marl.functions import scores, seam, text
from marl.operators import extracting, histogram, incremental, matching, ordered
from marl.plans import scratch
from marl.plans.scratch import create_once, fresh_path, listed
from marl.sources import files, store

SCHEMA = "k string, version string, place int"


def _source(spark, low, high):
    return spark.createDataFrame([(f"k{i % 3}", str(i), i, i // 4) for i in range(low, high)], SCHEMA + ", span int")


def _target(spark):
    return incremental.Target(spark, fresh_path(spark, "t"), spark.createDataFrame([], SCHEMA).schema)


def test_of_two_runs_that_race_one_is_refused(spark):
    target, outcome = _target(spark), []

    def publish():
        try:
            outcome.append(target.publish(_source(spark, 0, 5).drop("span"), 0))
        except RuntimeError:
            outcome.append(None)

    threads = [threading.Thread(target=publish) for _ in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(outcome, key=str) == [1, None, None] and target.rows().count() == 5
    assert len(listed(spark, f"{target.path}/data")) == 1  # what the others wrote is gone


def test_a_file_is_created_once(spark):
    path = fresh_path(spark, "once")
    scratch.write_bytes(spark, f"{path}/x", b"")
    assert create_once(spark, f"{path}/m", b"a") and not create_once(spark, f"{path}/m", b"b")
    assert scratch.read_bytes(spark, f"{path}/m") == b"a" and set(listed(spark, path)) == {"x", "m"}


def test_a_run_killed_before_it_publishes_leaves_nothing_to_see(spark, monkeypatch):
    target = _target(spark)
    incremental.process_new(target, _source(spark, 0, 6), ["k"], "span")
    monkeypatch.setattr(incremental, "create_once", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        incremental.process_new(target, _source(spark, 6, 12), ["k"], "span")
    monkeypatch.undo()
    assert target.latest() == 1 and target.rows().count() == 6
    assert len(target.sweep(hours=0)) == 1 and target.sweep(hours=0) == []
    incremental.process_new(target, _source(spark, 6, 12), ["k"], "span")
    assert sorted(r.place for r in target.rows().collect()) == list(range(12))


def test_snapshots_keep_the_state_small(spark, monkeypatch):
    monkeypatch.setattr(incremental, "SNAPSHOT", 3)
    target = _target(spark)
    for i in range(7):
        incremental.process_new(target, _source(spark, 0, 3 * i + 3), ["k"], "span")
    assert sorted(r.place for r in target.rows().collect()) == list(range(21))
    manifest = target.manifest(target.latest())
    assert manifest["snapshot"] and len(manifest["since"]) == 1 and len(manifest["data"]) == 7
    assert {r.k: r.p for r in target.state(target.latest()).groupBy("k").agg(F.max("place").alias("p")).collect()} == {"k0": 18, "k1": 19, "k2": 20}
    behind = incremental.late(spark.createDataFrame([("k0", "new", 1, 0), ("k0", "0", 18, 0), ("z", "a", 0, 0)], SCHEMA + ", span int"), target.rows(), ["k"])
    assert [r.version for r in behind.collect()] == ["new"]


def test_a_cluster_without_a_shared_folder_is_refused(spark):
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError):
        scratch.shared_root(Session())
    Session.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        scratch.shared_root(Session())


def _process(bad, cost=0.25):
    def run(df):
        fails = F.col("id").isin(*bad)
        return df.select("id", F.when(~fails, F.concat(F.lit("out "), "id")).alias("text"), F.lit(cost).alias("cost_usd"), F.when(fails, "down").alias("error"))

    return run


def test_run_loop(spark):
    s = store.Store(spark, fresh_path(spark, "store"))
    items = spark.createDataFrame([(f"i{n}", float(n)) for n in range(9)] + [("i1", 1.0)], "id string, score double")
    order = [F.desc("score"), F.col("id")]
    go = lambda bad=("none",), **k: store.run_loop(s, items, "id", order, _process(bad), "txt", "p1", "r", "2026-01-01", wave=2, **k)
    dry = go(dry=True)
    assert (dry.would_process, dry.processed, dry.pending) == (9, 0, 9)
    first = go(bad=("i7",), limit=4)  # i8, i7, i6, i5
    assert (first.examined, first.processed, first.errored, first.outputs, first.pending) == (4, 3, 1, 3, 6)
    second = go(limit=4)
    assert (second.examined, second.skipped, second.processed, second.pending) == (4, 3, 1, 5)
    broke = go(bad=("i4", "i3", "i2", "i1", "i0"), breaker=2)
    assert broke.breaker_tripped and broke.errored == 2 and broke.pending == 5
    spent = go(max_usd=0.4)
    assert spent.stopped_on_budget and spent.processed == 2 and spent.cost_usd == 0.5 and spent.pending == 3
    last = go()
    assert (last.skipped, last.processed, last.pending) == (6, 3, 0) and go().processed == 0
    assert s.derived("txt").count() == 9


def test_extraction(spark):
    said = {"events": [{"summary": "keep it", "lines": [2, 1], "markers": {"surprise": "0.5", "insight": True}, "confidence": 9}, {"summary": " ", "lines": [1]}, {"summary": "no lines"}, {"summary": "end", "lines": "3-9"}, "x"]}
    windows = spark.createDataFrame([("h", 10, "äb\ncd\n\nlast"), ("g", 0, "boom"), ("n", 0, "none"), ("z", 0, None)], "cleaned_hash string, byte_start bigint, text string")

    def completer(system, prompt):
        if "boom" in prompt:
            raise ValueError("down")
        return seam.Completion("```" + json.dumps(said) + "```" if "last" in prompt else "nothing", cost_usd=0.5)

    got = sorted((r.cleaned_hash, r.text and json.loads(r.text), r.cost_usd, r.error) for r in extracting.extract(windows, completer, "sys").collect() if r.cleaned_hash != "h")
    assert got == [("g", None, 0.0, "ValueError: down"), ("n", None, 0.5, None), ("z", None, 0.5, None)]
    events = [json.loads(r.text) for r in extracting.extract(windows.where("cleaned_hash = 'h'"), completer, "sys").collect()]
    data = (" " * 10 + "äb\ncd\n\nlast").encode()
    for e, quote in zip(events, ["äb\ncd", "\nlast"]):
        assert data[e["span"]["byte_start"] : e["span"]["byte_end"]].decode() == quote == e["quote"]
    assert events[0]["markers"] == {"surprise": 0.5, "insight": 0.0, "research": 0.0} and events[0]["confidence"] == 1.0
    claims = spark.createDataFrame([("c", "t", ["q", None]), ("d", "t", None)], "claim_id string, title string, quotes array<string>")
    told = {r.claim_id: (r.why, r.kind, r.error) for r in extracting.prose(claims, lambda s, p: seam.Completion('{"why": " so ", "kind": "rule"}' if '"""q"""' in p else "{}"), "sys").collect()}
    assert told == {"c": ("so", "rule", None), "d": (None, None, "ValueError: no reason in the answer")}


def test_patience():
    waits, calls = [], []

    def flaky(system, prompt):
        calls.append(1)
        if len(calls) < 4:
            raise ValueError("HTTP 429")
        return seam.Completion("ok")

    assert seam.patient(flaky, sleep=waits.append)("", "").text == "ok" and waits == [2.0, 4.0, 8.0]
    waits.clear()
    with pytest.raises(KeyError):
        seam.patient(lambda s, p: {}["x"], sleep=waits.append)("", "")
    assert waits == [2.0, 4.0]


def test_lines_of_files_in_blocks(spark, tmp_path):
    lines = [f'{{"type": "user", "uuid": "{i}"}}' for i in range(300)]
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "s.jsonl").write_bytes("\r\n".join(lines[:150]).encode() + b"\n\n" + "\n".join(lines[150:]).encode() + b"\n\xff\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        got = files.read_lines(spark, str(tmp_path)).orderBy("pos").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.line for r in got] == [*lines, "�"] and [r.pos for r in got] == [*range(150), *range(151, 302)]


def test_the_last_value_before(spark):
    data = [("a", i, i // 3, v) for i, v in enumerate(["x", None, None, None, "y", None, "z"])] + [("b", 0, 0, None), ("b", 1, 0, "q")]
    got = {(r.k, r.o): r.last for r in ordered.with_last(spark.createDataFrame(data, "k string, o int, d int, v string"), ["k"], F.col("o"), "d", F.col("v")).collect()}
    assert [got["a", i] for i in range(7)] == [None, "x", "x", "x", "x", "y", "y"] and [got["b", i] for i in (0, 1)] == [None, None]


def test_pairs_between(spark):
    said = [(1, "the staging table collides with the nightly load"), (2, "the nightly load collides with a staging table"), (3, "quartz jumps over vexing dwarves"), (4, None), (5, "aaaa"), (6, "the staging table collides with the nightly load!")]
    df = spark.createDataFrame(said, "id bigint, t string")
    want = {}
    for i, a in said:
        for j, b in said:
            if i < j and a and b and min(text.signature(a)[3], text.signature(b)[3]) >= 3:
                x, y = set(text.signature(a)[1]), set(text.signature(b)[1])
                if 0.12 <= (s := len(x & y) / len(x | y)) < 0.9:
                    want[i, j] = round(s, 9)
    for side in (2, 4000):
        assert {(r.a, r.b): round(r.sim, 9) for r in histogram.pairs_between(df, "id", "t", 0.12, 0.9, side).collect()} == want


def test_subjects_of_most_claims_say_nothing(spark):
    held = spark.createDataFrame([("e", "all"), ("e", "two"), ("f", "own")], "event string, member string")
    pool = spark.createDataFrame([(str(i), "all") for i in range(3)] + [("0", "two"), ("1", "two"), ("3", "own")], "claim string, member string")
    got = {(r.event, r.claim) for r in matching.shared_facets(held, pool, "event", "claim", 4).collect()}
    assert got == {("e", "0"), ("e", "1"), ("f", "3")}
    assert scores.CLUSTER_MIN == 3.0
