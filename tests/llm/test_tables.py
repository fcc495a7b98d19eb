"""The queries of this subpackage on the smallest tables, whole, against plain versions that share no code with them."""

import math
import os
import re
import unicodedata
from collections import Counter

import pytest

from marl.llm import queries

NORMAL = re.compile(r"[\W_]+")


def form(text):
    return NORMAL.sub(" ", text.casefold()).strip()


def pieces(f):
    return {f} if 0 < len(f) < 4 else {f[i : i + 4] for i in range(len(f) - 3)}


def entropy(f):
    return -sum(c / len(f) * math.log2(c / len(f)) for c in Counter(f).values()) if f else 0.0


def got(spark, data, name):
    return sorted(tuple(r) for r in queries.queries()[name](spark, data).collect())


def read(spark, data, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{data}/{name}.parquet").select(*columns).collect()]


def test_p2(spark, data):
    taken, want = [], []
    for _, i, q in sorted({(b, i, q) for i, b, q in read(spark, data, "resolved_event", "event_id", "batch_no", "quote") if q is not None and b is not None}):
        f = form(q)
        if entropy(f) < 3:
            continue
        near = [(-len(p & pieces(f)) / len(p | pieces(f)), j) for j, p in taken if p & pieces(f)]
        near = [x for x in near if -x[0] >= 0.55]
        if near:
            want.append((min(near)[1], i))
        else:
            taken.append((i, pieces(f)))
    assert want and got(spark, data, "p2_found") == sorted(want)


def seen(text):
    """What a reader sees, for the alphabets that the tables mix."""
    kept = "".join(" " if unicodedata.category(c) == "Zs" else c for c in text if not (unicodedata.category(c) == "Cf" or 0xFE00 <= ord(c) <= 0xFE0F or ord(c) in (0x34F, 0x115F, 0x1160, 0x3164, 0xFFA0)))
    drawn = str.maketrans("ɡɑасеіјорѕхуԁһӏԛѵԝүАВЕКМНОРСТХІЈЅΑΒΕΖΗΙΚΜΝΟΡΤΥΧοανριυγ", "gaaceijopsxydhlqvwyABEKMHOPCTXIJSABEZHIKMNOPTYXoavpiuy")
    return unicodedata.normalize("NFC", unicodedata.normalize("NFKD", kept).translate(drawn))


def test_p8(spark, data):
    words = lambda t: re.findall(r"[^\W_]+", seen(t).lower())
    runs = lambda t: {tuple(w[i : i + 12]) for w in [words(t)] for i in range(len(w) - 11)}
    items = [(i, runs(t)) for i, t in read(spark, data, "benchmark", "item_id", "text") if t]
    want = {(d, i) for d, t in read(spark, data, "documents", "doc_id", "text") if t for r in [runs(t)] for i, own in items if r & own}
    assert got(spark, data, "p8_found") == sorted(want)
    exact, reworded = want, set(got(spark, data, "p8_paraphrases"))
    assert len(exact & reworded) >= 0.5 * len(exact)  # a run of 12 words is half a passage: not every one is a paraphrase


def test_p9(spark, data):
    docs = [(d, t, seen(t)) for d, t in read(spark, data, "documents", "doc_id", "text") if t and seen(t).strip()]
    want = {(a, b) for a, s, f in docs for b, t, g in docs if a < b and f == g and s != t}
    assert got(spark, data, "p9_found") == sorted(want)
    classes = got(spark, data, "p9_classes")
    assert sum(r[2] for r in classes) == 2 * len(want) and {r[1] for r in classes} == {x for p in want for x in p}


def test_p6(spark, data):
    blobs = {h: (t, n, turns) for h, t, n, turns in read(spark, data, "cleaned_blob", "cleaned_hash", "text", "n_bytes", "turns")}
    chunks = {c for c in read(spark, data, "chunk", "cleaned_hash", "segment", "turn_start", "byte_start", "byte_end")}
    found = {}
    for name, segment, turn, low, high in got(spark, data, "p6_found"):
        found.setdefault((name, segment, turn), []).append((low, high))
    plain = {}
    for name, segment, turn, low, high in got(spark, data, "p6_cohesion"):
        plain.setdefault((name, segment, turn), []).append((low, high))
    large = set()
    for name, segment, turn, low, high in chunks:
        text, n, turns = blobs.get(name, (None, 0, None))
        if text is None or low is None or high is None or not 0 <= low < high <= n or high - low <= 2000:
            continue
        begins, at = {0}, 0
        for c in text:
            at += len(c.encode())
            begins.add(at)
        if low in begins and high in begins:
            large.add((name, segment, turn))
            for cut in (found, plain):
                mine = sorted(p for p in cut[name, segment, turn] if low <= p[0] and p[1] <= high)
                assert mine[0][0] == low and mine[-1][1] == high and all(b - a <= 2000 for a, b in mine)
                assert all(y[0] < x[1] and x[1] - y[0] <= 200 for x, y in zip(mine, mine[1:])) and all(a in begins and b in begins for a, b in mine)
    assert large and large == set(found) == set(plain)


def test_p7(spark, data):
    tokenizers = pytest.importorskip("tokenizers")
    if not os.path.exists("/opt/tokenizers/byte_bpe_50k.json"):
        pytest.skip("no vocabulary files")
    whole = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    whole.encode_special_tokens = True
    want = sorted((d, whole.encode(t or "", add_special_tokens=False).ids) for d, t in read(spark, data, "documents", "doc_id", "text"))
    assert got(spark, data, "p7_ids") == want
