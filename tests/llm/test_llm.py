"""Each operator against a plain version on small tables: nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import json
import os
import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from marl.llm import bpe, dialogue, history, leakage, lookalike, neardup, setjoin, sketch, splitter
from marl.plans.scratch import fresh_path


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo sierra tango".split()


def texts(rng, n):
    """Statements of which many are edits or reorderings of one another."""
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            words = rng.choice(out).split()
            for _ in range(rng.randint(0, 3)):
                i = rng.randrange(len(words))
                if rng.random() < 0.5:
                    words[i] = rng.choice(WORDS)
                else:
                    words.insert(i, words.pop(rng.randrange(len(words))))
            out.append(" ".join(words) if rng.random() < 0.8 else " ".join(words).upper() + "!")
        else:
            out.append(" ".join(f"{rng.choice(WORDS)}{rng.randint(0, 99)}" for _ in range(rng.randint(8, 16))))
    return out


def linked(forms, least=0.55):
    return {(a, b): s for i, a in enumerate(forms) for b in forms[i + 1 :] if (s := sketch.stmt_sim(a, b)) >= least}


def brute_groups(rows):
    part = [(i, f) for i, t in rows if t is not None and sketch.entropy(f := sketch.normal_form(t)) >= 3]
    forms = sorted({f for _, f in part})
    root = {f: f for f in forms}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked(forms):
        root[find(a)] = find(b)
    groups = {}
    for i, f in part:
        groups.setdefault(find(f), set()).add(i)
    return sorted(((min(g), i) for g in groups.values() for i in g if i != min(g)), key=str)


@pytest.mark.parametrize("boundary", [None, 0, 70])
def test_near_duplicate_groups(spark, boundary):
    rng = random.Random(1)
    rows = list(enumerate(texts(rng, 120)))
    rows += [(900, None), (901, ""), (902, "  \n"), (903, "aaaa"), (904, rows[0][1]), (905, "long " + "x y z " * 20_000 + rows[1][1]), (906, "abcdefghijkl"), (907, "abcdefghijk!"), (None, rows[0][1])]
    df = spark.createDataFrame([(i, t, "c", "d", "e") for i, t in rows] + [(0, rows[0][1], "c", "d", "e")], "pin_id bigint, text string, form string, rep string, key string")
    if boundary == 70:  # both sides are there: the short texts enumerate, the others scan
        rows = [r for r in rows if r[1] is None or len(r[1]) < 15 or len(sketch.pieces(sketch.normal_form(r[1]))) > 12]
        df, boundary = spark.createDataFrame([(*r, 1) for r in rows], "pin_id bigint, text string, root int"), 12
    got = tuples(neardup.near_duplicate_groups(df, "pin_id", "text", boundary=boundary))
    assert got == brute_groups([r for r in rows if r[0] is not None]) and (906, 907) in got
    assert neardup.near_duplicate_groups(df.limit(0), "pin_id", "text").count() == 0


def test_light_sets_are_exact(spark):
    top = 10
    rng = random.Random(2)
    forms = sorted({"".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 10))) for _ in range(300)})
    df = spark.createDataFrame(list(enumerate(forms)), "rep bigint, form string")
    keys = {}
    for k, r in tuples(neardup.subset_keys(df, top)):
        keys.setdefault(k, set()).add(r)
    met = {(a, b) for g in keys.values() for a in g for b in g if a < b}
    for a, b in ((i, j) for i in range(len(forms)) for j in range(i + 1, len(forms))):
        if max(len(sketch.pieces(forms[a])), len(sketch.pieces(forms[b]))) <= top and sketch.stmt_sim(forms[a], forms[b]) >= 0.55:
            assert (a, b) in met


def test_boundary_is_chosen_by_cost():
    rare, common = np.full(1000, 2), np.full(1000, 5000)
    assert neardup.light_boundary(np.zeros(10, np.int64)) == 0
    assert neardup.light_boundary(rare) < neardup.light_boundary(common)


@pytest.mark.parametrize("block", [3, 4096])
def test_lists_find_every_near_pair(spark, monkeypatch, block):
    """Roots all apart, so that nothing is settled before the lists; with small blocks every list is cut."""
    rng = random.Random(4)
    forms = sorted({sketch.normal_form(t) for t in texts(rng, 150)})
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "_STEP", 50)
    monkeypatch.setattr(neardup, "_GATHER", 200)
    rooted = [(i, i if i % 3 else -1, f) for i, f in enumerate(forms)]
    h, owner, n = sketch.distinct_pieces(forms)
    import pyarrow as pa

    frames = list(_entries(rooted, block))
    table = pa.Table.from_pandas(frames[0], preserve_index=False)
    lists = neardup._Lists(table, 0, 0.55)
    found = {tuple(sorted((int(lists.rep[x]), int(lists.rep[y])))) for a, b in lists.pairs() for x, y in zip(a, b)}
    want = {(i, j) for i in range(len(forms)) for j in range(i + 1, len(forms)) if sketch.stmt_sim(forms[i], forms[j]) >= 0.55 and rooted[i][1] != rooted[j][1]}
    assert want and want <= found


def _entries(rooted, block):
    """What `list_entries` gives, run in this process."""
    import pandas as pd

    held = {}

    class Frame:
        class sparkSession:
            class sparkContext:
                @staticmethod
                def broadcast(x):
                    held["b"] = type("B", (), {"value": x})
                    return held["b"]

        def select(self, *_):
            return self

        def mapInPandas(self, run, schema):
            return run([pd.DataFrame(rooted, columns=["rep", "root", "form"])])

    h, _, _ = sketch.distinct_pieces([f for _, _, f in rooted])
    counts = np.bincount((h % np.uint64(neardup.CLASSES)).astype(np.int64), minlength=neardup.CLASSES)
    yield from neardup.list_entries(Frame(), counts, 0)


def _one_list(rng, count, apart):
    """A list of `count` entries, listed in its first places, whose texts are edits of one another: a few words or half of them changed."""
    import pandas as pd

    words = [[f"{rng.choice(WORDS)}{rng.randint(0, 99)}" for _ in range(12)] for _ in range(count // 10)]
    forms = [" ".join(f"{rng.choice(WORDS)}{rng.randint(0, 99)}" if rng.random() < rng.choice([0.05, 0.5]) else w for w in rng.choice(words)) for _ in range(count)]
    h, owner, n = sketch.distinct_pieces(forms)
    bits = sketch.bitmaps(h, owner, count).view(np.int64)
    at = np.array([rng.randint(0, int(0.45 * k)) for k in n])
    entries = {"tile": 7, "other": [apart and rng.random() < 0.5 for _ in forms], "rep": np.arange(count), "root": [0 if rng.random() < 0.3 else i for i in range(count)], "n": n.astype(np.int32), "at": at.astype(np.int32), "listed": at <= 0.29 * n}
    return pd.DataFrame(entries | {w: bits[:, i] for i, w in enumerate(sketch.WORDS)})


@pytest.mark.parametrize("apart", [False, True])
def test_a_long_list_is_compared_in_tiles(monkeypatch, apart):
    """Every pair of bitmaps that leaves room is found, and few of the others are laid out one by one."""
    import pyarrow as pa

    entries = _one_list(random.Random(9), 1500, apart)
    laid = []
    close = neardup._Lists._close
    monkeypatch.setattr(neardup._Lists, "_close", lambda self, a, b: (laid.append(len(a)), close(self, a, b))[1])
    lists = neardup._Lists(pa.Table.from_pandas(entries, preserve_index=False), 0, 0.55)
    pairs = [tuple(sorted((int(lists.rep[x]), int(lists.rep[y])))) for a, b in lists.pairs() for x, y in zip(a, b)]
    n, at, root = (entries[c].to_numpy(np.int64) for c in ("n", "at", "root"))
    bits = entries[sketch.WORDS].to_numpy(np.int64).view(np.uint64)
    order = np.lexsort((entries["rep"], n))
    want = set()
    for x, i in enumerate(order):
        later = order[x + 1 :]
        total = n[i] + n[later]
        good = (n[i] >= 0.55 * n[later]) & (root[i] != root[later]) & (np.minimum(n[i] - at[i], n[later] - at[later]) >= np.ceil(0.55 / 1.55 * total - 1e-9)) & bool(entries["listed"][i])
        good &= np.bitwise_count(bits[i] ^ bits[later]).sum(axis=1) <= sketch.room(total, 0.55)
        good &= (entries["other"][i] != entries["other"].to_numpy()[later]) | (not apart)
        want |= {tuple(sorted((int(i), int(j)))) for j in later[good]}
    assert len(want) > 100 and set(pairs) == want and len(pairs) == len(want)
    assert sum(laid) < 0.2 * 1500 * 1499 / 2


def brute_repeats(rows):
    taken, out = [], []
    for _, i, t in sorted((b, i, t) for i, b, t in rows if t is not None and b is not None):
        f = sketch.normal_form(t)
        if sketch.entropy(f) < 3:
            continue
        near = [(-s, j) for j, g in taken if (s := 1.0 if f == g else sketch.stmt_sim(f, g)) >= 0.55]
        if near:
            out.append((min(near)[1], i))
        else:
            taken.append((i, f))
    return sorted(out, key=str)


@pytest.mark.parametrize("slices, stretch", [(1, 2000), (3, 2000), (1, 3), (3, 2)])
def test_repeats_by_batch(spark, monkeypatch, slices, stretch):
    """With small stretches every component of more rows is worked off in rounds."""
    monkeypatch.setattr(history._settled, "__defaults__", (stretch,))
    monkeypatch.setattr(history, "SHARE", 2)
    rng = random.Random(3)
    rows = [(i, rng.randint(1, 6), t) for i, t in enumerate(texts(rng, 60))]
    rows += [(900, 2, None), (901, 2, " "), (902, 2, "aaaa"), (903, None, rows[0][2]), (904, 5, rows[0][2])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "event_id bigint, batch_no int, quote string, prior int, id int")
    path = fresh_path(spark, "history")
    got = history.repeats_by_batch(df, "event_id", "quote", "batch_no", slices, path=path)
    assert tuples(got) == brute_repeats(rows)
    kept = history.History(spark, path)
    assert kept.texts().count() == sum(t is not None and b is not None and sketch.entropy(sketch.normal_form(t)) >= 3 for _, b, t in rows) - got.count()


def test_small_components_are_decided_in_several_tasks(spark, monkeypatch):
    """Rows of few bytes too are spread over tasks, whole components each."""
    rng = random.Random(8)
    made = []
    for root in range(150):
        first = " ".join(f"{rng.choice(WORDS)}{rng.randint(0, 99)}" for _ in range(10)).split()
        for _ in range(rng.randint(2, 6)):
            made.append((root, len(made), rng.randint(1, 3), " ".join(w if rng.random() < 0.85 else rng.choice(WORDS) for w in first), rng.random() < 0.1))
    kept = {}
    keep = history.keep
    monkeypatch.setattr(history, "keep", lambda df, label: kept.setdefault(label, keep(df, label)))
    got = history._settled(spark.createDataFrame(made, "root bigint, id bigint, b bigint, form string, struck boolean"), 0.55)
    want, taken = [], {}
    for root, i, b, form, struck in sorted(made, key=lambda r: (r[2], r[1])):
        near = [(-s, j) for j, f in taken.setdefault(root, []) if (s := sketch.stmt_sim(form, f)) >= 0.55]
        if not near and not struck:
            taken[root].append((i, form))
        want.append((i, not near and not struck, -min(near)[0] if near else None, min(near)[1] if near else None))
    assert tuples(got) == sorted(want, key=str) and any(w[1] for w in want) and any(w[2] for w in want)
    assert len(kept["decided"].inputFiles()) > 1


@pytest.mark.parametrize("step", [1, 7, 500])
def test_a_component_may_go_on_in_the_next_batch(step):
    import pandas as pd

    made = texts(random.Random(10), 90)
    rows = pd.DataFrame({"root": np.repeat([3, 5, 6, 9], [40, 1, 45, 4]), "id": np.arange(90), "form": made, "struck": [i % 11 == 0 for i in range(90)]})
    out = pd.concat(list(history._each_decided((rows.iloc[i : i + step] for i in range(0, 90, step)), 0.55)), ignore_index=True)
    pd.testing.assert_frame_equal(out, pd.concat([history.decided(g, 0.55) for _, g in rows.groupby("root")], ignore_index=True))


def _batch(spark, rows):
    return spark.createDataFrame([(i, b, sketch.normal_form(t)) for i, b, t in rows], "id bigint, batch bigint, form string")


def test_a_batch_may_come_again_and_a_later_session_goes_on(spark):
    rng = random.Random(5)
    made = texts(rng, 40)
    rows = [(i, 1 if i < 20 else 2, t) for i, t in enumerate(made)]
    path = fresh_path(spark, "history")
    first = _batch(spark, rows[:20])
    one = tuples(history.admit(history.History(spark, path), first))
    again = tuples(history.admit(history.History(spark, path), first))
    assert one == again and history.History(spark, path).texts().count() == 20 - len(one)
    # A failure between the two tables leaves keys without texts: they match nothing and the batch can be repeated.
    broken = fresh_path(spark, "history")
    half = history.History(spark, broken)
    signs = sketch.banded(first.withColumnRenamed("id", "rep"))
    signs.select(F.explode("bands").alias("key"), F.col("rep").alias("prior")).write.insertInto(half.table("bands")._marl_name)
    assert tuples(history.admit(half, first)) == one
    # Another session knows the folder only.
    other = spark.newSession()
    for name in ("bands", "texts"):
        spark.sql(f"DROP TABLE {half.table(name)._marl_name}")
    batch = other.createDataFrame([(i, b, sketch.normal_form(t)) for i, b, t in rows[20:]], "id bigint, batch bigint, form string")
    later = tuples(history.admit(history.History(other, broken), batch))
    assert sorted([r[:2] for r in one + later], key=str) == brute_repeats(rows)
    assert history.repeats_by_batch(spark.createDataFrame([], "event_id bigint, quote string, batch_no int"), "event_id", "quote", "batch_no").count() == 0


def test_few_keys_read_few_buckets(spark):
    path = fresh_path(spark, "history")
    history.admit(history.History(spark, path), _batch(spark, [(i, 1, t) for i, t in enumerate(texts(random.Random(6), 30))]))
    kept = history.History(spark, path)
    keys = kept.table("bands").select("key").limit(2)
    # The plan names the buckets only where it keeps the buckets apart.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        plan = kept.bands(keys)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert f" out of {history.BUCKETS}" in plan and "SelectedBucketsCount" in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = keys.withColumn("x", F.lit(1)).repartition(3).join(kept.table("bands"), "key")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in joined


def test_similar_pairs(spark):
    rng = random.Random(4)
    universe = [f"m{i}" for i in range(60)] + [f"r{i}" for i in range(2000)]
    sets = {}
    for i in range(250):
        if sets and rng.random() < 0.6:
            s = set(rng.choice(list(sets.values())))
            for _ in range(rng.randint(0, 4)):
                s ^= {rng.choice(universe)}
        else:
            s = {rng.choice(universe[:60]) if rng.random() < 0.4 else rng.choice(universe[60:]) for _ in range(rng.choice([1, 2, 5, 9, 14, 20, 120]))}
        sets[f"k{i:03}"] = s
    rows = [(k, [*s, *list(s)[:1], None]) for k, s in sets.items()]
    rows += [("k000", rows[0][1]), ("n1", None), ("n2", []), ("n3", [None]), (None, ["m1"])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "id string, members array<string>, set_id string, n int")
    names = sorted(k for k in sets if sets[k])
    want = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.6]
    assert tuples(setjoin.similar_pairs(df, "id", "members")) == want
    assert setjoin.similar_pairs(df.limit(0), "id", "members").count() == 0


def test_concept_members(spark):
    f = "struct<repos:array<string>,files:array<string>,tools:array<string>>"
    df = spark.createDataFrame([("a", ([" r ", None, ""], ["x", "x "], None)), ("b", (["r"], [" "], ["t"])), ("c", None)], f"id string, facets {f}")
    assert tuples(setjoin.concept_members(df)) == [("a", ["files:x", "files:x", "repos:r"])]


def brute_sessions(rows):
    sessions = {}
    for r in sorted((r for r in rows if r["uuid"] is not None and r["session_id"] is not None), key=lambda r: (r["pos"], r["uuid"])):
        sessions.setdefault(r["session_id"], {}).setdefault(r["uuid"], r)
    out = []
    for s, recs in sessions.items():
        recs = {u: r for u, r in recs.items() if not r["isSidechain"]}
        turns = sorted((r for r in recs.values() if r["type"] in ("user", "assistant")), key=lambda r: (r["pos"], r["uuid"]))
        at, path, bad = (turns[-1] if turns else None), [], False
        while at is not None:
            if at in path:
                bad = True
                break
            path.append(at)
            ref = at["parentUuid"] if at["parentUuid"] is not None else at["logicalParentUuid"]
            if ref is None:
                break
            if ref in recs:
                at = recs[ref]
            elif at["subtype"] == "compact_boundary":
                at = next((r for r in reversed(turns) if r["pos"] < at["pos"]), None)
            else:
                bad = True
                break
        said = [r for r in reversed(path) if r["type"] in ("user", "assistant") and r["isMeta"] is not True and (c := r["message"]["content"]) is not None and c.strip() and c != "[]"]
        prompt = [r["type"] == "user" and "tool_result" not in r["message"]["content"] for r in said]
        asked = [i for i, p in enumerate(prompt) if p]
        answered = all(any(r["type"] == "assistant" for r in said[i:j]) for i, j in zip(asked, [*asked[1:], len(said)]))
        if not bad and asked and answered:
            out += [(s, i, r["uuid"]) for i, r in enumerate(said, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("wide", [1_000_000, 3])
def test_conversations(spark, wide):
    rng = random.Random(5)
    rows = []
    for s in range(60):
        names = [f"u{i}" for i in range(rng.randint(1, 12))]
        for i, u in enumerate(names):
            parent = names[i - 1] if i and rng.random() < 0.93 else rng.choice([None, None, rng.choice(names), "gone"])
            kind = ("user", "assistant")[i % 2] if rng.random() < 0.9 else rng.choice(["user", "system"])
            content = rng.choice(["hi"] * 20 + ["hi there", json.dumps([{"type": "text", "text": "tool_result"}])[:-1] + "]", '[{"type": "tool_result", "content": "x"}]', "[]", " \n", None])
            if content and "tool_result" in content and "content" not in content:
                content = "hello"
            rows.append(dict(session_id=f"s{s}", pos=i, type=kind, uuid=u if rng.random() < 0.98 else None, parentUuid=parent, logicalParentUuid=rng.choice([None, names[max(i - 2, 0)]]) if rng.random() < 0.3 else None, isSidechain=rng.choice([None] + [False] * 20 + [True]), isMeta=rng.choice([None] + [False] * 9 + [True]), subtype="compact_boundary" if kind == "system" else None, message=dict(role="x", id=None, content=content)))
            if rng.random() < 0.1:
                rows.append({**rows[-1], "pos": i + 40})
    schema = "session_id string, pos int, type string, uuid string, parentUuid string, logicalParentUuid string, isSidechain boolean, isMeta boolean, subtype string, message struct<role:string,id:string,content:string>"
    df = spark.createDataFrame(rows, schema).withColumn("flags", F.lit(1)).withColumn("turn_no", F.lit(1))
    want = brute_sessions(rows)
    assert len(want) > 20
    assert tuples(dialogue.conversations(df, wide)) == want
    assert dialogue.conversations(df.limit(0), wide).count() == 0


def brute_pieces(text, start, end, turns):
    data = text.encode()
    begins, at = [], 0
    for c in text:
        begins.append(at)
        at += len(c.encode())
    begins.append(at)
    starts = {begins[t] for t in turns if 0 <= t < len(text)}
    out, a = [], start
    while end - a > 2000:
        inside = [b for b in begins if a + 1000 < b <= a + 2000]
        kinds = [lambda b: b in starts, lambda b: data[:b].endswith(b"\n\n"), lambda b: data[:b].endswith(b"\n"), lambda b: data[:b].endswith(("。".encode(), b". ", b"! ", b"? ")), lambda b: data[:b].endswith(b" "), lambda b: True]
        b = next(max(good) for k in kinds if (good := [b for b in inside if k(b)]))
        out.append((a, b))
        a = min(x for x in begins if x >= b - 200)
    return [*out, (a, end)]


def test_split_chunks(spark, monkeypatch):
    monkeypatch.setattr(splitter, "PAGE", 1024)
    rng = random.Random(6)
    alphabets = ["ab c. d! e?\n\n", "äöü ß。 日本", "x", "🧭é \n", "word "]
    blobs, chunks, want = [], [], []
    for i in range(25):
        text = "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 9000)))
        turns = sorted(rng.sample(range(-5, 9100), rng.choice([0, 0, 3, 20])))
        n = len(text.encode())
        blobs.append((f"h{i}", text, n, [(t, t + 1) for t in turns] if i % 5 else None))
        if i % 5 == 0:
            turns = []
        places = [0]
        for c in text:
            places.append(places[-1] + len(c.encode()))
        for j in range(3):
            s, e = sorted((rng.choice(places), rng.choice(places)))
            chunks += [(f"h{i}", 0, j, s, e)] * 2
            if e - s > 2000:
                want += [(f"h{i}", 0, j, a, b) for a, b in brute_pieces(text, s, e, turns)]
        chunks += [(f"h{i}", 1, 9, 0, n + 1), (f"h{i}", 1, 9, -1, n), (f"h{i}", 1, 9, None, n)]
        inner = [p for p in range(1, n) if text.encode()[p] & 0xC0 == 0x80]
        if inner:
            chunks += [(f"h{i}", 2, 9, 0, inner[-1]), (f"h{i}", 2, 9, inner[0], n)]
    chunks.append(("none", 0, 0, 0, 5000))
    c = spark.createDataFrame([(*x, "t") for x in chunks], "cleaned_hash string, segment int, turn_start int, byte_start bigint, byte_end bigint, text string")
    b = spark.createDataFrame(blobs, "cleaned_hash string, text string, n_bytes bigint, turns array<struct<start:int,end:int>>").withColumn("page", F.lit(1))
    assert len(want) > 50
    assert tuples(splitter.split_chunks(c, b)) == sorted(set(want), key=str)
    assert splitter.split_chunks(c.limit(0), b.limit(0)).count() == 0
    for h, _, _, s, e in tuples(splitter.split_chunks(c, b, "cohesion")):
        assert 0 < e - s <= 2000


def brute_cohesion(words, side):
    from collections import Counter

    out = []
    for i in range(len(words)):
        a, b = Counter(words[max(0, i - side) : i]), Counter(words[i : i + side])
        norm = (sum(v * v for v in a.values()) * sum(v * v for v in b.values())) ** 0.5
        out.append(sum(v * b[w] for w, v in a.items()) / norm if norm else 0.0)
    return np.convolve(np.pad(out, 1, mode="edge"), np.ones(3) / 3, "valid")


def test_cohesion_curve_and_depths():
    rng = random.Random(12)
    words = [rng.choice(["a", "bb", "c", "漢", "字"]) for _ in range(200)]
    places, sims = splitter.cohesion(" ".join(words).encode())
    assert np.allclose(sims, brute_cohesion(words, splitter.SIDE)[1:]) and len(places) == 199
    curve = np.array([0.9, 0.5, 0.5, 0.7, 0.2, 0.6, 0.4])
    assert np.allclose(splitter.depths(curve), [0.0, 0.6, 0.6, 0.0, 0.9, 0.0, 0.2])
    for data in (b"", b"...", "。。".encode()):
        assert len(splitter.cohesion(data)[0]) == 0
    assert len(splitter.cohesion("日本語です".encode())[0]) == 4


def test_cohesion_cuts_where_the_topics_turn():
    """Texts of several topics, in words and in a script without spaces: every cut falls near a turn, where one lies in the window."""
    rng = random.Random(13)
    for joint, topics in ((" ", ["apple pear plum fig date", "bolt nut screw nail rivet", "sun moon star comet orbit"]), ("", ["日月火水木", "犬猫鳥魚馬", "赤青白黒緑"])):
        text, turns = "", []
        for k in range(9):
            own = topics[k % 3].split() if joint else list(topics[k % 3])
            size = rng.randint(1150, 1500)
            part = ""
            while len(part.encode()) < size:
                part += rng.choice(own) + joint
            turns.append(len(text.encode()))
            text += part
        data = text.encode()
        for a, b in splitter.cuts(data, np.zeros(0, int), "cohesion")[:-1]:
            inside = [t for t in turns if a + 1020 < t < a + 1980]
            assert 1000 < b - a <= 2000 and (not inside or min(abs(b - t) for t in inside) <= 40)
    plain = b"x" * 5000
    assert all(b - a <= 2000 for a, b in splitter.cuts(plain, np.zeros(0, int), "cohesion"))


needs_files = pytest.mark.skipif(not os.path.exists(f"{bpe.TOKENIZER_DIR}/byte_bpe_50k.tiktoken"), reason="no vocabulary files")


@needs_files
def test_encoding(spark):
    tokenizers = pytest.importorskip("tokenizers")
    whole = tokenizers.Tokenizer.from_file(f"{bpe.TOKENIZER_DIR}/byte_bpe_50k.json")
    whole.encode_special_tokens = True
    rng = random.Random(7)
    cases = ["", None, " ", "<|endoftext|>x", "it's  don't\n\n\t x", "日本語のテキスト", "🧭👩‍💻", "a" * 3000, "ab" * 3000, "é" * 50, "x1 y22 _z"]
    cases += ["".join(rng.choice("abc ABC\n'1é日🧭.,") for _ in range(rng.randint(0, 80))) for _ in range(300)]
    df = spark.createDataFrame([(i if i else None, t, 1) for i, t in enumerate(cases)], "doc_id bigint, text string, ids int")
    got = bpe.encode_texts(df, "doc_id", "text").collect()
    assert len(got) == len(cases) and sum(r.doc_id is None for r in got) == 1
    for r in got:
        if r.doc_id:
            assert r.ids == whole.encode(cases[r.doc_id] or "", add_special_tokens=False).ids
    assert bpe.encode_texts(df.limit(0), "doc_id", "text").count() == 0


def test_leaked_items(spark):
    rng = random.Random(8)
    vocabulary = [f"{w}{i}" for w in WORDS for i in range(10)]
    items = [(i, [rng.choice(vocabulary) for _ in range(rng.choice([5, 12, 30]))]) for i in range(20)]
    docs = []
    for d in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.6:
            _, item = rng.choice(items)
            run = rng.choice([11, 12, 13, 30])
            s = rng.randint(0, max(0, len(item) - run))
            at = rng.randint(0, len(words))
            words[at:at] = item[s : s + run]
        docs.append((d, words))
    want = sorted(((d, i) for d, w in docs for i, v in items if {tuple(w[x : x + 12]) for x in range(len(w) - 11)} & {tuple(v[x : x + 12]) for x in range(len(v) - 11)}), key=str)
    dressed = lambda w: "_".join(x.upper() if k % 3 else x.replace("a", "а") for k, x in enumerate(w))
    corpus = spark.createDataFrame([(d, dressed(w), 1, 2) for d, w in docs] + [(500, None, 1, 2), (501, "", 1, 2), (None, dressed(items[2][1]), 1, 2), docs and (0, dressed(docs[0][1]), 1, 2)], "doc_id bigint, text string, item_id int, words int")
    bench = spark.createDataFrame([(i, " ".join(w), 0) for i, w in items] + [(77, None, 0), (78, "", 0)], "item_id bigint, text string, doc_id int")
    got = leakage.leaked_items(corpus, "doc_id", "text", bench, "item_id", "text")
    assert len(want) > 20 and tuples(got) == want
    assert leakage.leaked_items(corpus.limit(0), "doc_id", "text", bench, "item_id", "text").count() == 0
    assert leakage.leaked_items(corpus, "doc_id", "text", bench.limit(0), "item_id", "text").count() == 0


def test_long_texts_in_stretches(spark, monkeypatch):
    """Runs that begin at every place of a long text, over stretches of a size that no block divides, in texts and in items."""
    monkeypatch.setattr(leakage, "STRETCH", 25)
    words = [f"w{i}" for i in range(400)]
    items = spark.createDataFrame([(i, " ".join(words[i : i + 12])) for i in range(0, 388, 3)] + [(1000, " ".join(words[100:200])), (1001, " ".join(words[5:16]))], "item_id bigint, text string")
    corpus = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[150:161])), (3, " ".join(["x"] * 41 + words[180:192]))], "doc_id bigint, text string")
    want = [(1, i) for i in range(0, 388, 3)] + [(1, 1000), (3, 180), (3, 1000)]
    assert tuples(leakage.leaked_items(corpus, "doc_id", "text", items, "item_id", "text")) == sorted(want, key=str)


def brute_paraphrases(docs, items, weight):
    def cut(w):
        last = max(len(w) - leakage.PASSAGE, 0)
        return [w[p : p + leakage.PASSAGE] for p in sorted({*range(0, last + 1, leakage.STEP), last})] if w else []

    out = set()
    for d, x in docs:
        for i, y in items:
            for a in cut(x):
                for b in cut(y):
                    rare = sorted({*b}, key=lambda w: (-weight[w], w))[: leakage.RAREST]
                    if np.isin(b, a).mean() >= leakage.SUBSEQUENCE and np.isin(rare, a).mean() >= leakage.ANSWER and leakage.common_subsequence(np.array(a), np.array(b)) >= leakage.SUBSEQUENCE * len(b):
                        out.add((d, i))
    return out


def test_common_subsequence():
    rng = random.Random(14)
    for _ in range(50):
        a, b = ([rng.randint(1, 4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert leakage.common_subsequence(np.array(a, np.int64), np.array(b, np.int64)) == table[-1][-1]


def test_paraphrased_items(spark):
    """Planted paraphrases: a word of five replaced, or words moved. The index finds nine of ten of what the checks accept, and nothing else."""
    rng = random.Random(15)
    vocabulary = [f"{w}{i}" for w in WORDS for i in range(40)]
    items = [(i, [rng.choice(vocabulary) for _ in range(24)]) for i in range(30)]
    docs = []
    for d in range(200):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(20, 60))]
        if d % 2:
            said = list(items[d % 30][1])
            for k in rng.sample(range(24), rng.randint(2, 5)):
                said[k] = rng.choice(vocabulary)
            at = rng.randrange(0, len(words) // leakage.STEP + 1) * leakage.STEP
            words[at:at] = said
        docs.append((d, words))
    corpus = spark.createDataFrame([(d, " ".join(w)) for d, w in docs] + [(900, None), (901, "")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(77, None)], "item_id bigint, text string")
    got = set(tuples(leakage.paraphrased_items(corpus, "doc_id", "text", bench, "item_id", "text")))
    spoken = lambda t, k: {r[0]: list(r[1]) for r in leakage.words(t, k, "text").groupBy(k).agg(F.first("words")).collect()}
    d, i = spoken(corpus, "doc_id"), spoken(bench, "item_id")
    buckets = leakage.idf(leakage.words(corpus, "doc_id", "text", leakage.PASSAGE).where(F.size("words") > 0)).astype(np.float32)
    weight = {w: buckets[w % leakage.BUCKETS] for t in (d, i) for ws in t.values() for w in ws}
    want = brute_paraphrases(d.items(), i.items(), weight)
    assert len(want) >= 50 and len(got & want) >= 0.9 * len(want) and got <= want
    assert leakage.paraphrased_items(corpus.limit(0), "doc_id", "text", bench, "item_id", "text").count() == 0


def test_consistent_form():
    same = [("ﬁn", "fin"), ("Ａｂ１", "Ab1"), ("é", "é"), ("a​b­c﻿", "abc"), ("a b　c", "a b c"), ("раураl", "paypal"), ("Οοо", "Ooo"), ("й", "й"), ("①", "1")]
    for a, b in same:
        assert lookalike.consistent(a) == lookalike.consistent(b)
    other = [("A", "a"), ("e", "é"), ("1", "2"), ("ab", "ba"), ("и", "й"), ("a\tb", "a b"), ("a\nb", "a b"), ("か", "が")]
    for a, b in other:
        assert lookalike.consistent(a) != lookalike.consistent(b)
    assert lookalike.consistent("Straße", fold=True) == "strasse"
    for a in ("Ａé​日本", "plain"):
        once = lookalike.consistent(a)
        assert lookalike.consistent(once) == once and unicodedata.is_normalized("NFC", once)


def test_lookalike_pairs(spark):
    texts_ = ["paypal", "раураl", "paypal", "ｐａｙｐａｌ", "Paypal", None, "", " ", "​", "x", "x", "x", "é", "é", "long " * 5000, "long " * 5000]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts_)] + [(0, "paypal", 1, 2), (None, "ｘ", 1, 2)], "doc_id bigint, text string, id int, f1 int")
    want = [(i, j) for i in range(len(texts_)) for j in range(i + 1, len(texts_)) if (a := texts_[i]) and (b := texts_[j]) and a != b and lookalike.consistent(a) == lookalike.consistent(b) and lookalike.consistent(a).strip()]
    assert tuples(lookalike.lookalike_pairs(df, "doc_id", "text")) == sorted(want, key=str)
    assert lookalike.lookalike_pairs(df.limit(0), "doc_id", "text").count() == 0
    alike = {}
    for a, b in want:
        alike.setdefault(a, set()).add(b)
        alike.setdefault(b, set()).add(a)
    classes = [(min({i, *alike[i], *(x for j in alike[i] for x in alike[j])}), i, len(alike[i])) for i in alike]
    assert tuples(lookalike.lookalike_classes(df, "doc_id", "text")) == sorted(classes, key=str)
    assert lookalike.lookalike_classes(df.limit(0), "doc_id", "text").count() == 0


def test_letters_of_other_alphabets():
    """Stated here once more, as pairs: what each alphabet's letters spell."""
    for drawn, plain in [("ꓮꓐꓚꓓꓰꓝ", "ABCDEF"), ("ⲤⲟⲣⲦ", "CopT"), ("Ꮪ Ꮩ Ꮃ Ꮓ", "S V W Z"), ("αιυγ", "aiuy"), ("ѕсоре", "scope"), ("ΤΟΡ", "TOP"), ("օսհ", "ouh")]:
        assert lookalike.consistent(drawn) == plain
    for seen in ("a\tb", "Éa", "ß", "ı", "日本", "б", "ж"):
        assert lookalike.consistent(seen) == seen


def test_recall_of_the_band_keys():
    """Edits around the threshold: the bands find what their design says."""
    rng = random.Random(9)
    pairs = []
    while len(pairs) < 300:
        a = " ".join(f"{rng.choice(WORDS)}{rng.randint(0, 99)}" for _ in range(14))
        words = a.split()
        for i in rng.sample(range(14), rng.randint(2, 4)):
            words[i] = f"{rng.choice(WORDS)}{rng.randint(0, 99)}"
        if 0.55 <= sketch.stmt_sim(a, b := " ".join(words)) <= 0.7:
            pairs.append((a, b))
    left, right = (sketch.band_keys(sketch.minwise([p[i] for p in pairs])) for i in (0, 1))
    assert (left == right).any(axis=1).mean() >= 0.99
