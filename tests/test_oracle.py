"""Every query with SQL against DuckDB on the smallest tables, and those without against plain versions."""

import hashlib
import math
import os
import re

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return int(v) if math.isfinite(v) and v == int(v) else float(f"{v:.5g}")
    if hasattr(v, "tolist"):
        return str(v.tolist())
    return v if isinstance(v, (int, bool)) else str(v)


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for name in os.listdir(data):
        c.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{data}/{name}'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_sql(spark, data, con, name):
    got = entry.queries()[name](spark, data)
    found = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(got.columns) == sorted(names)
    order = sorted(names)
    key = lambda r: tuple(str(x) for x in r)
    mine = sorted((tuple(plain(r[c]) for c in order) for r in got.collect()), key=key)
    theirs = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in found.fetchall()), key=key)
    assert mine == theirs


def core(name):
    return not name[1:2].isdigit()


def test_every_query_of_the_core_is_compared():
    """With SQL here, or by name with a plain version: in this file, or in test_resolve for the resolver."""
    assert {n for n in set(entry.queries()) - set(entry.oracle_sql()) if core(n)} == {"statement_signatures", "rendered_sessions", "session_windows", "resolved_claims"}


def test_signatures_of_the_table(spark, data, con):
    want = []
    for pin, said in con.execute("SELECT pin_id, text FROM stmt_sig_pins WHERE text IS NOT NULL").fetchall():
        form = re.sub(r"[\W_]+", " ", said.casefold()).strip()
        grams = {form} if 0 < len(form) < 4 else {form[i : i + 4] for i in range(len(form) - 3)}
        hashes = [int.from_bytes(hashlib.blake2b(g.encode(), digest_size=8).digest(), "big") for g in grams]
        ones = [sum(h >> b & 1 for h in hashes) for b in range(64)]
        sim = sum(1 << b for b in range(64) if ones[b] > len(hashes) - ones[b])
        share = [form.count(c) / len(form) for c in set(form)]
        bits = -sum(p * math.log2(p) for p in share)
        want.append((pin, hashlib.md5(form.encode()).hexdigest(), len(grams), sim - (1 << 64) if sim >> 63 else sim, round(bits, 5), [sim >> 48, sim >> 32 & 65535, sim >> 16 & 65535, sim & 65535]))
    got = [(r.pin_id, r.form_hash, r.n, r.simhash, round(r.entropy, 5), r.lsh_bands) for r in entry.queries()["statement_signatures"](spark, data).collect()]
    key = lambda r: (r[0], str(r))
    assert [r[:4] + r[5:] for r in sorted(got, key=key)] == [r[:4] + r[5:] for r in sorted(want, key=key)]
    assert all(abs(a[4] - b[4]) < 2e-5 for a, b in zip(sorted(got, key=key), sorted(want, key=key)))


def test_windows_of_the_table_cover_its_sessions(spark, data):
    """Windows follow each other turn by turn, stay in their segment and within their size unless they hold one turn, and none could take the next turn."""
    from marl.operators import transcripts

    sessions = {r.session_id: r for r in transcripts.rendered(spark.read.parquet(f"{data}/transcript.parquet")).collect()}
    told = {r.session_id: r for r in entry.queries()["rendered_sessions"](spark, data).collect()}
    windows = {}
    for w in entry.queries()["session_windows"](spark, data).collect():
        windows.setdefault(w.session_id, []).append(w)
    assert set(told) == set(sessions) == set(windows) and len(sessions) > 5
    for s, r in sessions.items():
        parts = [r.text[t.start : t.end] for t in r.turns]
        assert "\n\n".join(parts) == r.text and all(p.startswith(f"[{t.kind}]") for p, t in zip(parts, r.turns))
        assert (told[s].cleaned_hash, told[s].chars, told[s].turns) == (hashlib.sha256(r.text.encode()).hexdigest(), len(r.text), len(r.turns))
        at = 0
        for w in sorted(windows[s], key=lambda w: w.turn_start):
            held = r.turns[w.turn_start : w.turn_end + 1]
            assert w.turn_start == at and {t.segment for t in held} == {w.segment} and (w.char_start, w.char_end) == (held[0].start, held[-1].end)
            size = sum(t.end - t.start + 2 for t in held)
            assert size <= 12_000 or len(held) == 1
            at = w.turn_end + 1
            if at < len(r.turns) and r.turns[at].segment == w.segment:
                assert size + r.turns[at].end - r.turns[at].start + 2 > 12_000
        assert at == len(r.turns)


def test_claims_of_the_table(spark, data, con):
    got = entry.queries()["resolved_claims"](spark, data).collect()
    events = con.execute("SELECT count(DISTINCT event_id) FROM resolved_event").fetchone()[0]
    assert sum(r.events for r in got) == events and len({r.claim_id for r in got}) == len(got) and all(r.against == 0 for r in got)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
