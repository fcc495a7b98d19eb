"""Files, pages, feeds, the store, the registry, regions and streams."""

import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from marl.operators.incremental import Target
from marl.plans.scratch import fresh_path
from marl.sources import files, region, registry, store, web
from marl.streaming import watch

PAGE = """<html><head><title>T</title><style>x{}</style></head><body><nav>menu</nav><h1>Head &amp; more</h1><p>Some <b>bold</b>
text <a href="https://e.org/x">link</a> and <a href="#top">up</a> <code>c()</code></p><ul><li>one</li><li>two</li></ul><pre>
  keep
    this
</pre><p>end"""


def test_html():
    want = "# Head & more\n\nSome bold text link (https://e.org/x) and up `c()`\n\n- one\n- two\n\n```\n  keep\n    this\n```\n\nend\n"
    assert web.html_text(PAGE) == want
    assert web.html_text("") == "" and web.html_text("<nav>never closed <p>x") == ""
    assert web.html_text("<pre>open") == "```\nopen\n```\n"


def test_feeds(spark):
    rss = "<rss><channel><item><guid>1</guid><link>http://a</link></item><item><link>http://b</link></item><item><guid>3</guid></item></channel></rss>"
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>x</id><link rel="self" href="http://s"/><link href="http://alt"/></entry><entry><link rel="edit" href="http://e"/></entry></feed>'
    assert web.feed_entries(rss) == [("1", "http://a"), ("http://b", "http://b")]
    assert web.feed_entries(atom) == [("x", "http://alt"), ("http://e", "http://e")]
    df = spark.createDataFrame([(rss,), ("<bad",)], "x string").select(web.parse_feed("x").alias("f"))
    got = [r.f for r in df.collect()]
    assert len(got[0].entries) == 2 and got[0].error is None and got[1].entries is None and "ParseError" in got[1].error


def test_fetch(spark):
    pages = {"http://a": ("text/html", b"<p>hi</p>"), "http://b": ("text/plain", b"raw <p>"), "http://c": ("image/png", b"")}
    df = spark.createDataFrame([(u,) for u in (*pages, "ftp://x", "http://a", None)], "url string")
    got = {r.url: (r.text, r.error) for r in web.fetch_pages(df, lambda u: pages[u]).collect()}
    assert got["http://a"] == ("hi\n", None) and got["http://b"] == ("raw <p>", None)
    assert got["http://c"][0] is None and got["ftp://x"][0] is None and len(got) == 4


def test_transcript_files(spark, tmp_path):
    for project in ("-home-me-one", "-home-me-own", "-home-me-own-sub"):
        (tmp_path / project).mkdir()
        lines = [{"type": "user", "uuid": "u", "cwd": None, "gitBranch": "b0"}, {"type": "user", "uuid": "v", "cwd": "/home/me/one", "gitBranch": "b1", "message": {"content": [{"type": "text"}]}}]
        (tmp_path / project / "s.jsonl").write_bytes(b"\n".join([json.dumps(x).encode() for x in lines] + [b"{broken", b"\xff", b""]))
    assert files.encode_project("/home/me.x") == "-home-me-x"
    found = files.discover(spark, str(tmp_path), skip_self="/home/me/own")
    assert [r.project for r in found.collect()] == ["-home-me-one"]
    assert files.unseen(found, found).count() == 0 and files.selected(found, "2000-01-01", 1).count() == 1
    records = files.parse_records(files.read_lines(spark, str(tmp_path / "-home-me-one")))
    assert records.count() == 2 and records.where("uuid = 'v'").first().message.content == '[{"type":"text"}]'
    assert rows(files.origins(records)) == [("s", "/home/me/one", "b0", 2)]
    assert spark.range(1).select(files.repo_label(F.lit("/a/b/"), F.lit("p"))).first()[0] == "b"
    (tmp_path / "d.md").write_text("ä")
    assert files.read_documents(spark, str(tmp_path / "d.md")).first().text == "ä"


def test_store(spark):
    s = store.Store(spark, fresh_path(spark, "store"))
    t = lambda d: dt.datetime(2026, 1, d)
    schema = "source_kind string, source_id string, text string, fetched_at timestamp, mtime timestamp"
    s.ingest(spark.createDataFrame([("document", "a", "one", t(1), t(1)), ("document", "a", "one", t(1), t(1)), ("transcript", "a", "other", t(2), None)], schema))
    s.ingest(spark.createDataFrame([("document", "a", "one", t(5), t(1)), ("document", "a", "two", t(3), t(1))], schema))
    assert s.raw().count() == 3 and s.newest("document").first().text == "two"
    run = lambda: store.run_stage(s, s.newest("document").select("content_hash"), "content_hash", lambda d: d.select(F.col("content_hash").alias("derived_from"), F.upper("content_hash").alias("text")), "x/1", "v1", "r1", "2026-01-04")
    run()
    run()
    assert s.derived("x/1").count() == 1 and s.done("v1").count() == 1 and s.lifecycle().count() == 0


def test_registry(tmp_path):
    path = str(tmp_path / "sources.json")
    registry.add(path, "feed", "http://f")
    with pytest.raises(ValueError):
        registry.add(path, "url", "http://f")
    registry.add(path, "file", "x.md")
    assert [e["kind"] for e in registry.load(path)] == ["feed", "file"]
    registry.remove(path, "http://f")
    with pytest.raises(ValueError):
        registry.remove(path, "http://f")
    assert len(registry.load(path)) == 1


def test_region(tmp_path):
    text = region.rules([("b", "one"), ("a", "two"), ("b", "three"), ("general", "x"), ("general", "y"), ("general", "z")])
    assert text.index("## b") < text.index("## a") < text.index("## general")
    path = str(tmp_path / "r.md")
    (tmp_path / "r.md").write_bytes(b"keep\r\nthis")
    assert region.apply(path, text) and not region.apply(path, text)
    with open(path, newline="") as f:
        assert f.read().startswith("keep\r\nthis\n\n<!-- generated START")
    with pytest.raises(ValueError):
        region.span(text + text)
    assert "+- two" in region.diff("", text)


def test_streams(spark, tmp_path):
    t = dt.datetime(2026, 1, 1)
    data = [("a", "1", i, i // 2, t) for i in range(4)] + [("a", "2", 4, 2, t)]
    schema = "k string, version string, place int, span int, ts timestamp"
    src = str(tmp_path / "src")
    spark.createDataFrame(data[:3], schema).coalesce(1).write.parquet(src)
    target = Target(spark, fresh_path(spark, "stream"), spark.createDataFrame([], schema).drop("span", "ts").schema)
    for part in (None, data[3:]):
        if part:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        watch.follow(spark.readStream.schema(schema).parquet(src), target, ["k"], "span", str(tmp_path / "cp")).awaitTermination()
    assert rows(target.rows().select("place", "version")) == [(0, "1"), (4, "2")]
    q = watch.sittings(spark.readStream.schema(schema).parquet(src), "k", "ts").writeStream.format("memory").queryName("sat").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("sat").count() == 1
    assert watch.new_files(spark, src, "*.parquet").isStreaming and watch.first_seen(spark.readStream.schema(schema).parquet(src), ["k"], "ts").isStreaming
