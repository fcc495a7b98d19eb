"""Queries of the core over the driver tables, with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marl.functions import scores, text
from marl.operators import claims, facets, folds, graphs, histogram, matching, ordered, queue, rendering, resolving, temporal, transcripts
from marl.operators.incremental import changed_entries
from marl.plans.scratch import fresh_path

#: The reference time of every age in these queries.
NOW = "2026-06-01 00:00:00"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, folder) under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("""
WITH rep AS (SELECT run_id, arg_max(struct_pack(p := processed, s := skipped), written_at) AS r FROM report WHERE stage = 'tap' GROUP BY run_id),
once AS (SELECT run_id, any_value(datastore) AS datastore, any_value(planned_at) AS planned_at, any_value(feed_entries) AS feed_entries FROM source_plan GROUP BY run_id),
cut AS (SELECT run_id, datastore, planned_at, unnest(range(1, len(feed_entries) + 1)) AS pos, unnest(feed_entries) AS e, r.p + r.s AS n FROM once JOIN rep USING (run_id) WHERE r.p + r.s IS NOT NULL),
h AS (SELECT run_id, datastore, planned_at, pos, e.feed_url AS feed_url, e.entry_id AS entry_id, e.content_hash AS content_hash FROM cut WHERE pos <= n AND e.entry_id IS NOT NULL),
l AS (SELECT *, lag(content_hash) OVER w AS prev, row_number() OVER w AS k FROM h WINDOW w AS (PARTITION BY datastore, feed_url, entry_id ORDER BY planned_at, run_id, pos))
SELECT run_id, feed_url, entry_id FROM l WHERE k = 1 OR content_hash IS DISTINCT FROM prev
""")
def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return changed_entries(table(spark, folder, "source_plan"), table(spark, folder, "report"), fresh_path(spark, "target"))


# Versioned folds


@query("SELECT user_id, event_type, ts, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def latest_by_source(spark, folder):
    """The newest event of each user and type."""
    return folds.latest(table(spark, folder, "events").select("user_id", "event_type", "ts", "event_id", "value"), ["user_id", "event_type"], ["ts", "event_id"])


@query("""
WITH last AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS verb FROM events GROUP BY user_id)
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM last WHERE verb IN ('error', 'purchase'))
""")
def lifecycle_fold(spark, folder):
    """Customers whose latest event is no invalidating one."""
    decisions = table(spark, folder, "events").select("user_id", "event_type", "ts", "event_id")
    verb = F.col("event_type").isin("error", "purchase")
    return folds.valid(table(spark, folder, "customer").select("c_custkey", "c_name"), decisions, "c_custkey", "user_id", verb, ["ts", "event_id"])


@query("""
WITH s AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS kind FROM events WHERE value > 20 GROUP BY user_id),
w AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS kind FROM events WHERE value <= 20 GROUP BY user_id)
SELECT c_custkey, coalesce(s.kind, w.kind, 'behavioral') AS kind FROM customer LEFT JOIN s ON c_custkey = s.user_id LEFT JOIN w ON c_custkey = w.user_id
""")
def facet_fold(spark, folder):
    """A facet from its strong decisions, else its weak ones, else the default."""
    e = table(spark, folder, "events").select(F.col("user_id").alias("c_custkey"), F.col("event_type").alias("kind"), "ts", "event_id", "value")
    last = lambda rows: folds.latest(rows.drop("value"), ["c_custkey"], ["ts", "event_id"])
    return folds.facet(table(spark, folder, "customer").select("c_custkey"), "c_custkey", last(e.where("value > 20")), last(e.where("value <= 20")), "kind", "behavioral")


@query("""
SELECT session_id, uuid, pos, type, ingested_at FROM (SELECT *, row_number() OVER (PARTITION BY session_id, uuid ORDER BY ingested_at DESC, pos DESC, type DESC) AS k
FROM transcript WHERE session_id IS NOT NULL AND uuid IS NOT NULL) WHERE k = 1
""")
def record_versions(spark, folder):
    """The last delivery of each record."""
    return folds.latest(table(spark, folder, "transcript").select("session_id", "uuid", "ingested_at", "pos", "type"), ["session_id", "uuid"], ["ingested_at", "pos", "type"]).select("session_id", "uuid", "pos", "type", "ingested_at")


@query("""
SELECT run_id, stage, processed, skipped, errored FROM (SELECT *, row_number() OVER (PARTITION BY run_id, stage ORDER BY written_at DESC, processed DESC, skipped DESC, errored DESC) AS k
FROM report WHERE run_id IS NOT NULL AND stage IS NOT NULL) WHERE k = 1
""")
def report_latest(spark, folder):
    """The last report of each run and stage; a null count comes after every count at one time in SQL's order and ours."""
    r = table(spark, folder, "report").select("run_id", "stage", "written_at", "processed", "skipped", "errored")
    best = folds.latest(r.withColumns({c: F.coalesce(c, F.lit(2**62)) for c in ("processed", "skipped", "errored")}), ["run_id", "stage"], ["written_at", "processed", "skipped", "errored"])
    return best.select("run_id", "stage", *[F.nullif(c, F.lit(2**62)).alias(c) for c in ("processed", "skipped", "errored")])


@query("""
WITH RECURSIVE r AS (SELECT p_partkey AS loser, CASE WHEN p_size > 45 THEN NULL ELSE p_partkey - p_size END AS winner FROM part),
walk AS (SELECT loser, winner FROM r UNION ALL SELECT w.loser, r.winner FROM walk w JOIN r ON w.winner = r.loser)
SELECT loser, winner FROM walk w WHERE winner IS NULL OR winner NOT IN (SELECT loser FROM r)
""")
def tag_redirects(spark, folder):
    """Each redirect followed to its end, in chains of any length; a dropped end is null."""
    p = table(spark, folder, "part")
    return folds.terminal(p.select(F.col("p_partkey").alias("loser"), F.expr("case when p_size > 45 then null else p_partkey - p_size end").alias("winner")))


@query("""
SELECT c.cleaned_hash, c.byte_start, c.segment, b.source_id AS raw_source_id, coalesce(nullif(b.source_kind, ''), 'unknown') AS handle
FROM chunk c LEFT JOIN (SELECT cleaned_hash, any_value(source_id) AS source_id, any_value(source_kind) AS source_kind FROM cleaned_blob GROUP BY 1) b USING (cleaned_hash)
""")
def lineage_join(spark, folder):
    """Chunks with the source of their blob; a broken link gives nulls."""
    raw = table(spark, folder, "cleaned_blob").select("cleaned_hash", "source_id", "source_kind").dropDuplicates(["cleaned_hash"])
    out = folds.lineage(table(spark, folder, "chunk").select("cleaned_hash", "byte_start", "segment"), raw, "cleaned_hash", "cleaned_hash")
    return out.select("cleaned_hash", "byte_start", "segment", "raw_source_id", folds.handle(F.col("raw_source_kind"), F.lit("unknown")).alias("handle"))


# Queues


@query("""
WITH seen AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 500)
SELECT * FROM seen WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""")
def done_skip_limit(spark, folder):
    """The 500 most valuable orders examined, those done skipped after the limit."""
    done = table(spark, folder, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    items = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return queue.examine(items, done, ["o_orderkey"], queue.priority("greedy", F.col("o_totalprice"), F.lit(0), F.col("o_orderkey")), 500)


@query(f"""
SELECT event_id, round(score + 0.05 * greatest(0, (epoch(TIMESTAMP '{NOW}') - epoch(born)) / 86400), 6) AS effective
FROM (SELECT event_id, born, coalesce(confidence, 0.5) AS score FROM resolved_event) ORDER BY score + 0.05 * greatest(0, (epoch(TIMESTAMP '{NOW}') - epoch(born)) / 86400) DESC, event_id LIMIT 200
""")
def aging_order(spark, folder):
    """The 200 events that come first when waiting counts."""
    e = table(spark, folder, "resolved_event").select("event_id", F.coalesce("confidence", F.lit(0.5)).alias("score"), scores.age_days(F.col("born"), NOW).alias("age"))
    top = e.orderBy(*queue.priority("aging", F.col("score"), F.col("age"), F.col("event_id"))).limit(200)
    return top.select("event_id", F.round(F.col("score") + scores.AGING * F.col("age"), 6).alias("effective"))


@query("""
SELECT event_id, round(s, 6) AS salience FROM (SELECT event_id, coalesce(confidence, 0.5) * (coalesce(markers.surprise, 0) + 0.7 * coalesce(markers.insight, 0) + 0.5 * coalesce(markers.research, 0) + 0.01) AS s FROM resolved_event)
ORDER BY round(s, 9) DESC, event_id LIMIT 100
""")
def salience_queue(spark, folder):
    """The 100 most salient events."""
    e = table(spark, folder, "resolved_event").select("event_id", scores.salience(F.col("markers"), F.col("confidence")).alias("s"))
    return e.orderBy(F.round("s", 9).desc(), "event_id").limit(100).select("event_id", F.round("s", 6).alias("salience"))


@query("""
SELECT run_id, stage, written_at, started_at FROM (SELECT *, sum(coalesce(cost_usd, 0)) OVER (ORDER BY written_at, run_id, stage, started_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM
(SELECT DISTINCT run_id, stage, written_at, started_at, cost_usd FROM report WHERE written_at IS NOT NULL)) WHERE coalesce(before, 0) < 25
""")
def running_budget_gate(spark, folder):
    """Reports written while less than 25 was spent before them."""
    r = table(spark, folder, "report").where("written_at is not null").select("run_id", "stage", "written_at", "started_at", "cost_usd").distinct().withColumn("day", F.to_date("written_at"))
    return queue.within_budget(r, F.struct("written_at", "run_id", "stage", "started_at"), "day", F.col("cost_usd"), 25.0).select("run_id", "stage", "written_at", "started_at")


@query("""
WITH r AS (SELECT DISTINCT stage, written_at, run_id, started_at, coalesce(errored > 0, false) AS failed FROM report WHERE written_at IS NOT NULL),
g AS (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY written_at, run_id, started_at, failed) - row_number() OVER (PARTITION BY stage, failed ORDER BY written_at, run_id, started_at) AS grp FROM r),
n AS (SELECT stage, grp, failed, sum(failed::INT) AS n FROM g GROUP BY ALL)
SELECT stage, max(n)::BIGINT AS longest, max(n) >= 3 AS tripped FROM n GROUP BY stage
""")
def breaker_trip(spark, folder):
    """The longest run of failing reports of each stage."""
    r = table(spark, folder, "report").where("written_at is not null").select("stage", "written_at", "run_id", "started_at", F.coalesce(F.col("errored") > 0, F.lit(False)).alias("failed")).distinct()
    r = r.withColumn("day", F.to_date("written_at"))
    return queue.breaker(r, ["stage"], F.struct("written_at", "run_id", "started_at", "failed"), "day", F.col("failed"), 3)


@query("""
WITH k AS (SELECT confidence AS s FROM resolved_event WHERE confidence IS NOT NULL), b AS (SELECT min(s) AS lo, max(s) AS hi FROM k),
h AS (SELECT least(floor((s - lo) / ((hi - lo) / 12)), 11)::INT AS bucket, any_value(lo) AS lo, any_value(hi) AS hi, count(*) AS n FROM k, b GROUP BY 1)
SELECT bucket, round(lo + bucket * (hi - lo) / 12, 6) AS low, round(lo + (bucket + 1) * (hi - lo) / 12, 6) AS high, n FROM h
""")
def score_histogram(spark, folder):
    """Confidence in twelve equal bins."""
    return queue.histogram(table(spark, folder, "resolved_event"), "confidence").select("bucket", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "n")


@query("""
WITH p AS (SELECT pair_id, stmt_sim, CASE WHEN stmt_sim >= 0.7 THEN 'cross' WHEN stmt_sim >= 0.55 THEN 'high' WHEN stmt_sim >= 0.12 THEN 'residue' ELSE 'non' END AS band,
least(abs(stmt_sim - 0.12), abs(stmt_sim - 0.55), abs(stmt_sim - 0.7)) AS edge FROM resolve_g4_trap)
SELECT pair_id, stmt_sim FROM (SELECT *, row_number() OVER (PARTITION BY band ORDER BY edge, pair_id) AS k FROM p) WHERE k <= CASE band WHEN 'residue' THEN 10 WHEN 'high' THEN 4 WHEN 'cross' THEN 2 ELSE 4 END
""")
def stratified_quota(spark, folder):
    """Pairs for labelling: of each band those nearest a threshold, up to its quota."""
    p = table(spark, folder, "resolve_g4_trap").select("pair_id", "stmt_sim")
    edge = F.least(*[F.abs(F.col("stmt_sim") - t) for t in (text.J_MAYBE, text.J_HIGH, text.J_CROSS)])
    return queue.stratified(p, text.band(F.col("stmt_sim")), {"residue": 10, "high": 4, "cross": 2, "non": 4}, [edge, F.col("pair_id")])


# Text and spans


@query("SELECT doc_id, sha256(text) AS content_hash, substr(sha256(source || ':' || doc_id::VARCHAR), 1, 12) AS short_id FROM documents")
def content_ids(spark, folder):
    """Content hashes and short ids of documents."""
    return table(spark, folder, "documents").select("doc_id", text.content_hash(F.col("text")).alias("content_hash"), text.short_id(12, F.col("source"), F.col("doc_id")).alias("short_id"))


@query("""
SELECT c.cleaned_hash, c.byte_start, c.byte_end, c.segment, coalesce(c.byte_start >= 0 AND c.byte_start < c.byte_end AND c.byte_end <= b.n_bytes, false) AS holds
FROM chunk c LEFT JOIN (SELECT cleaned_hash, any_value(octet_length(encode(text))) AS n_bytes FROM cleaned_blob GROUP BY 1) b USING (cleaned_hash)
""")
def byte_spans(spark, folder):
    """Whether each chunk's bytes lie in its blob."""
    b = table(spark, folder, "cleaned_blob").groupBy("cleaned_hash").agg(F.first(F.octet_length("text")).alias("n"))
    c = table(spark, folder, "chunk").join(b, "cleaned_hash", "left")
    return c.select("cleaned_hash", "byte_start", "byte_end", "segment", text.valid_span(F.col("byte_start"), F.col("byte_end"), F.col("n")).alias("holds"))


@query("""
WITH c AS (SELECT DISTINCT cleaned_hash, byte_start, byte_end, segment, turn_start FROM chunk), b AS (SELECT cleaned_hash, encode(any_value(text)) AS data FROM cleaned_blob WHERE text IS NOT NULL GROUP BY 1),
q AS (SELECT c.*, try(decode(data[byte_start + 1 : byte_end])) AS quote FROM c JOIN b USING (cleaned_hash) WHERE byte_start >= 0 AND byte_start < byte_end AND byte_end <= octet_length(data))
SELECT cleaned_hash, byte_start, byte_end, segment, turn_start, sha256(quote) AS quote_hash, length(quote)::INT AS chars FROM q WHERE quote IS NOT NULL AND NOT regexp_full_match(quote, '\\s*')
""")
def quote_reanchor(spark, folder):
    """The text each chunk points to, as its hash and length; pointers that do not hold are left out."""
    c = table(spark, folder, "chunk").select("cleaned_hash", "byte_start", "byte_end", "segment", "turn_start").distinct()
    q = rendering.anchored(c, table(spark, folder, "cleaned_blob"))
    return q.select("cleaned_hash", "byte_start", "byte_end", "segment", "turn_start", F.sha2("quote", 256).alias("quote_hash"), F.length("quote").alias("chars"))


@query("""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
e AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS line, unnest(l) AS t FROM d)
SELECT doc_id, line, byte_end - octet_length(encode(t)) AS byte_start, byte_end, length(t) AS chars FROM
(SELECT *, sum(octet_length(encode(t)) + 1) OVER (PARTITION BY doc_id ORDER BY line) - 1 AS byte_end FROM e)
""")
def numbered_lines(spark, folder):
    """Lines of documents with their byte places."""
    d = table(spark, folder, "documents").where("text is not null")
    return rendering.numbered_lines(d, ["doc_id"], F.col("text"), F.lit(0)).select("doc_id", "line", "byte_start", "byte_end", F.length("text").alias("chars"))


@query("SELECT pin_id, trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS form FROM stmt_sig_pins")
def normalize_text(spark, folder):
    """Normal forms of statements."""
    return table(spark, folder, "stmt_sig_pins").select("pin_id", text.normalize(F.col("text")).alias("form"))


_FORM = "trim(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
_GRAMS = "CASE WHEN length({0}) = 0 THEN []::VARCHAR[] WHEN length({0}) < 4 THEN [{0}] ELSE list_distinct(list_transform(range(1, length({0}) - 2), lambda i: substr({0}, i::BIGINT, 4))) END"


@query(f"WITH f AS (SELECT pin_id, {_FORM.format('text')} AS form FROM stmt_sig_pins WHERE text IS NOT NULL) SELECT pin_id, len({_GRAMS.format('form')})::INT AS n FROM f")
def shingle_counts(spark, folder):
    """How many distinct pieces each statement has."""
    f = table(spark, folder, "stmt_sig_pins").where("text is not null").select("pin_id", text.normalize(F.col("text")).alias("form"))
    return f.select("pin_id", F.size(text.shingles(F.col("form"))).alias("n"))


@query(f"""
WITH f AS (SELECT pin_id, {_FORM.format('text')} AS form FROM stmt_sig_pins WHERE text IS NOT NULL),
c AS (SELECT pin_id, any_value(length(form)) AS n, c, count(*) AS k FROM (SELECT pin_id, form, unnest(string_split(form, '')) AS c FROM f WHERE form <> '') GROUP BY pin_id, c)
SELECT pin_id, round(coalesce(e, 0), 6) AS entropy FROM f LEFT JOIN (SELECT pin_id, -sum(k / n * log2(k / n)) AS e FROM c GROUP BY pin_id) USING (pin_id)
""")
def text_entropy(spark, folder):
    """Entropy of each statement's form."""
    f = table(spark, folder, "stmt_sig_pins").where("text is not null").select("pin_id", text.normalize(F.col("text")).alias("form"))
    return f.select("pin_id", F.round(text.entropy(F.col("form")), 6).alias("entropy"))


@query()
def statement_signatures(spark, folder):
    """Persisted signatures of statements: form, shingle hashes, simhash, entropy, bands."""
    p = table(spark, folder, "stmt_sig_pins").where("text is not null")
    return p.select("pin_id", text.statement_signature("text").alias("s")).select("pin_id", F.md5("s.normalized").alias("form_hash"), F.size("s.shingles").alias("n"), F.col("s.simhash").alias("simhash"), F.round("s.entropy", 6).alias("entropy"), F.col("s.lsh_bands").alias("lsh_bands"))


_TRAP = f"""t AS (SELECT pair_id, same_lesson, {_FORM.format('quote_a')} AS fa, {_FORM.format('quote_b')} AS fb FROM resolve_g4_trap),
g AS (SELECT *, {_GRAMS.format('fa')} AS a, {_GRAMS.format('fb')} AS b FROM t),
j AS (SELECT pair_id, same_lesson, len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b))) AS sim FROM g),
v AS (SELECT *, CASE WHEN sim >= 0.7 THEN 'cross' WHEN sim >= 0.55 THEN 'high' WHEN sim >= 0.12 THEN 'residue' ELSE 'non' END AS band FROM j)"""


def _trap(spark, folder):
    t = table(spark, folder, "resolve_g4_trap")
    grams = lambda c: text.shingles(text.normalize(F.col(c)))
    return t.select("pair_id", "same_lesson", text.jaccard(grams("quote_a"), grams("quote_b")).alias("sim")).withColumn("band", text.band(F.col("sim")))


@query(f"WITH {_TRAP} SELECT pair_id, round(sim, 6) AS sim, band, CASE WHEN sim >= 0.7 THEN 'match-cross' WHEN sim >= 0.12 THEN 'possible' ELSE 'non-match' END AS verdict FROM v")
def pair_similarity(spark, folder):
    """Similarity, band and class of labelled pairs whose subjects do not overlap."""
    return _trap(spark, folder).select("pair_id", F.round("sim", 6).alias("sim"), "band", text.verdict(F.col("sim"), F.lit(0.0)).alias("verdict"))


@query(f"WITH {_TRAP} SELECT band, count(*) FILTER (same_lesson) AS same, count(*) FILTER (NOT same_lesson) AS other FROM v GROUP BY band")
def band_histogram(spark, folder):
    """Pairs in each similarity band, split by the label."""
    count = lambda c: F.count(F.when(c, 1))
    return _trap(spark, folder).groupBy("band").agg(count(F.col("same_lesson")).alias("same"), count(~F.col("same_lesson")).alias("other"))


@query(f"""
WITH f AS (SELECT DISTINCT pin_id, session_id, {_FORM.format('text')} AS form FROM stmt_sig_pins WHERE pin_id IS NOT NULL AND text IS NOT NULL),
h AS (SELECT pin_id, -sum(k / n * log2(k / n)) AS e FROM (SELECT pin_id, any_value(length(form)) AS n, c, count(*) AS k FROM (SELECT pin_id, form, unnest(string_split(form, '')) AS c FROM f WHERE form <> '') GROUP BY pin_id, c) GROUP BY pin_id),
g AS (SELECT pin_id, session_id, {_GRAMS.format('form')} AS g, coalesce(e, 0) >= 3.0 AS sure FROM f LEFT JOIN h USING (pin_id)),
j AS (SELECT coalesce(a.session_id = b.session_id, false) AS same, a.sure AND b.sure AS sure, CASE WHEN len(a.g) > 0 AND len(b.g) > 0 THEN len(list_intersect(a.g, b.g)) / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))) ELSE 0 END AS sim FROM g a JOIN g b ON a.pin_id < b.pin_id),
v AS (SELECT *, CASE WHEN sim >= 0.7 THEN 'cross' WHEN sim >= 0.55 THEN 'high' WHEN sim >= 0.12 THEN 'residue' ELSE 'non' END AS band FROM j)
SELECT band, count(*) FILTER (same) AS same, count(*) FILTER (NOT same) AS other, count(*) FILTER (sure AND (band = 'residue' OR band = 'high' AND NOT same)) AS asked
FROM (VALUES ('non'), ('residue'), ('high'), ('cross')) b(band) LEFT JOIN v USING (band) GROUP BY band
""")
def statement_bands(spark, folder):
    """All pairs of statements by similarity band, split by one session or two, and how many a model would be asked."""
    return histogram.band_counts(table(spark, folder, "stmt_sig_pins"), "pin_id", "text", "session_id")


@query(f"WITH {_TRAP} SELECT count(*) FILTER (sim >= 0.55) AS accepted, count(*) FILTER (sim >= 0.55 AND same_lesson) AS right_accepted, count(*) FILTER (same_lesson) AS labelled, count(*) FILTER (same_lesson AND sim < 0.12) AS stranded, round(avg((band = 'residue')::INT), 6) AS residue FROM v")
def gold_scoring(spark, folder):
    """How the thresholds do on the labelled pairs."""
    count = lambda c: F.count(F.when(c, 1))
    hit, same = F.col("sim") >= text.J_HIGH, F.col("same_lesson")
    return _trap(spark, folder).agg(count(hit).alias("accepted"), count(hit & same).alias("right_accepted"), count(same).alias("labelled"), count(same & (F.col("sim") < text.J_MAYBE)).alias("stranded"), F.round(F.avg((F.col("band") == "residue").cast("int")), 6).alias("residue"))


@query("""
SELECT doc_id, CASE WHEN length(text) <= 260 THEN text ELSE text[1:200] || ' …[' || (length(text) - 220)::VARCHAR || ' chars elided]… ' || right(text, 20) END AS cut,
trim(substr(trim(regexp_replace(lower(source), '[^a-z0-9]+', '-', 'g'), '-'), 1, 40), '-') AS slug,
regexp_replace(text, '(?s)\\[assistant\\].*?(?:\\[user\\]|\\z)', '', 'g') AS stripped FROM documents
""")
def text_shapes(spark, folder):
    """Truncation, slugs and marked regions."""
    d, t = table(spark, folder, "documents"), F.col("text")
    return d.select("doc_id", text.truncate(t, 200, 20).alias("cut"), text.slugify(F.col("source")).alias("slug"), text.strip_region(t, "[assistant]", "[user]").alias("stripped"))


@query("""
WITH t AS (SELECT doc_id, text, lower(text) AS low FROM documents WHERE text IS NOT NULL),
u AS (SELECT doc_id, bool_or(s <> '' AND length(s) < 240 AND list_bool_or(list_transform(['actually', 'no,', 'no ', 'don''t', 'do not', 'instead', 'wait', 'stop', 'not ', 'wrong', 'revert', 'undo', 'rather', 'that''s wrong', 'i said'], lambda c: contains(s, c)))) AS turned
FROM (SELECT doc_id, regexp_replace(string_split(p, '[assistant]')[1], '^\\s+|\\s+$', '', 'g') AS s FROM (SELECT doc_id, unnest(string_split(low, '[user]')[2:]) AS p FROM t)) GROUP BY doc_id)
SELECT doc_id, list_bool_or(list_transform(['[error]', 'traceback (most recent call last)', 'assertionerror', 'exception:', 'npm err!', ' failed', 'exit code 1', 'exited 1', 'fatal:', 'panic:', 'fail:'], lambda c: contains(low, c))) AS failed, coalesce(turned, false) AS turned,
length(text) >= 80 AND (contains(text, '[user]') OR contains(text, '[assistant]')) AS signal FROM t LEFT JOIN u USING (doc_id)
""")
def structural_cues(spark, folder):
    """Failure and redirect cues of documents, and whether they can hold a lesson."""
    d = table(spark, folder, "documents").where("text is not null").withColumn("cues", text.cues(F.col("text")))
    return d.select("doc_id", F.array_contains("cues", "failure").alias("failed"), F.array_contains("cues", "redirect").alias("turned"), text.has_signal(F.col("text"), F.lit("transcript")).alias("signal"))


@query("""
WITH p AS (SELECT doc_id, list_concat(['[document] ' || source], string_split(coalesce(text, ''), chr(10) || chr(10))) AS l FROM documents WHERE source <> ''),
e AS (SELECT doc_id, unnest(range(0, len(l))) AS i, unnest(l) AS t FROM p)
SELECT doc_id, i::INT AS index, (stop - length(t))::INT AS start, stop::INT AS stop FROM (SELECT *, sum(length(t) + 2) OVER (PARTITION BY doc_id ORDER BY i) - 2 AS stop FROM e)
""")
def document_turns(spark, folder):
    """Paragraph turns of documents with their character places."""
    d = rendering.document_turns(table(spark, folder, "documents").where("source <> ''"), "doc_id", "text", "source")
    return d.select("doc_id", F.explode("turns").alias("t")).select("doc_id", "t.index", "t.start", F.col("t.end").alias("stop"))


@query("""
WITH RECURSIVE t AS (SELECT cleaned_hash, turns, len(turns) AS n FROM cleaned_blob WHERE len(turns) > 0),
w AS (SELECT cleaned_hash, turns, n, 1 AS i, turns[1]."end" - turns[1].start + 2 AS used, 1 AS win FROM t
UNION ALL SELECT cleaned_hash, turns, n, i + 1, CASE WHEN fits THEN used + size ELSE size END, CASE WHEN fits THEN win ELSE win + 1 END FROM
(SELECT *, turns[i + 1]."end" - turns[i + 1].start + 2 AS size, turns[i + 1].segment = turns[i].segment AND used + turns[i + 1]."end" - turns[i + 1].start + 2 <= 1500 AS fits FROM w WHERE i < n))
SELECT cleaned_hash, min(turns[i]."index") AS turn_start, max(turns[i]."index") AS turn_end, min(turns[i].start) AS char_start, max(turns[i]."end") AS char_end, any_value(turns[i].segment) AS segment FROM w GROUP BY cleaned_hash, win
""")
def greedy_pack(spark, folder):
    """Turns packed into windows of 1,500 characters."""
    b = table(spark, folder, "cleaned_blob").where("size(turns) > 0")
    return b.select("cleaned_hash", F.explode(rendering.packed(F.col("turns"), 1500)).alias("w")).select("cleaned_hash", "w.turn_start", "w.turn_end", "w.char_start", "w.char_end", "w.segment")


@query("""
SELECT cleaned_hash, t."index" AS turn, octet_length(encode(substr(text, 1, t.start))) AS byte_start, octet_length(encode(substr(text, 1, t."end"))) AS byte_end
FROM (SELECT cleaned_hash, text, unnest(turns) AS t FROM cleaned_blob)
""")
def turn_bytes(spark, folder):
    """Turns of blobs in bytes."""
    b = table(spark, folder, "cleaned_blob").select("cleaned_hash", "text", F.explode("turns").alias("t"))
    return b.select("cleaned_hash", F.col("t.index").alias("turn"), text.byte_offset(F.col("text"), F.col("t.start")).alias("byte_start"), text.byte_offset(F.col("text"), F.col("t.end")).alias("byte_end"))


@query("""
WITH t AS (SELECT cleaned_hash, unnest(turns) AS t FROM cleaned_blob), c AS (SELECT DISTINCT cleaned_hash, byte_start, byte_end FROM chunk WHERE byte_start < byte_end)
SELECT c.cleaned_hash, c.byte_start, c.byte_end, count(*) AS turns, max(t.t."index") AS last_turn FROM c JOIN t ON c.cleaned_hash = t.cleaned_hash AND t.t.start < c.byte_end + 400 AND t.t."end" > c.byte_start - 400 AND t.t.start < t.t."end" GROUP BY ALL
""")
def span_window_overlap(spark, folder):
    """Turns whose places meet those of a chunk, widened by 400."""
    c = table(spark, folder, "chunk").select("cleaned_hash", "byte_start", "byte_end").where("byte_start < byte_end").distinct()
    t = table(spark, folder, "cleaned_blob").select("cleaned_hash", F.explode("turns").alias("t")).select("cleaned_hash", F.col("t.start").alias("low"), F.col("t.end").alias("high"), "t.index")
    wide = c.withColumn("start", F.col("byte_start") - 400).withColumn("end", F.col("byte_end") + 400)
    met = matching.overlapping(wide, t, ["cleaned_hash"], 4000)
    return met.groupBy("cleaned_hash", "byte_start", "byte_end").agg(F.count("*").alias("turns"), F.max("index").alias("last_turn"))


# Time


@query("""
WITH o AS (SELECT user_id, ts, event_id, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
SELECT user_id, count(*) AS sessions, sum((p IS NULL OR epoch(ts) - epoch(p) > 12 * 3600)::INT)::BIGINT AS sittings FROM o GROUP BY user_id
""")
def sitting_coalesce(spark, folder):
    """Sessions and sittings of each repository."""
    s = temporal.sittings(table(spark, folder, "events").select("event_id", "user_id", "ts"), "event_id", "user_id", "ts")
    return s.groupBy("user_id").agg(F.count("*").alias("sessions"), F.count_distinct("sitting").alias("sittings"))


@query("""
WITH o AS (SELECT event_type AS claim, value > 50 AS contra, user_id, ts, event_id, lag(ts) OVER (PARTITION BY event_type, value > 50, user_id ORDER BY ts, event_id) AS p FROM events WHERE event_type IS NOT NULL AND value IS NOT NULL),
n AS (SELECT *, sum((p IS NULL OR epoch(ts) - epoch(p) > 12 * 3600)::INT) OVER (PARTITION BY claim, contra, user_id ORDER BY ts, event_id) AS s FROM o),
w AS (SELECT claim, contra, pow(0.5, greatest(0, (epoch(TIMESTAMP '2024-06-01') - epoch(max(ts))) / 86400) / 180) AS w FROM n GROUP BY claim, contra, user_id, s)
SELECT claim, count(*) FILTER (NOT contra) AS support, count(*) FILTER (contra) AS contradictions, round(sum(CASE WHEN contra THEN -w ELSE w END), 4) AS entrenchment FROM w GROUP BY claim
""")
def net_entrenchment(spark, folder):
    """Recency-weighted support less contradiction, by sittings."""
    e = table(spark, folder, "events").where("value is not null").select(F.col("event_type").alias("claim"), "event_id", "user_id", "ts", "value")
    out = temporal.entrenchment(e, "claim", "event_id", "user_id", "ts", F.col("value") > 50, "2024-06-01 00:00:00")
    return out.withColumn("entrenchment", F.round("entrenchment", 4))


_RANGE = "SELECT id, min(facets.time_range[1]) AS s, min(facets.time_range[2]) AS e FROM concept_graph WHERE len(facets.time_range) = 2 AND id IS NOT NULL GROUP BY id"


def _ranges(spark, folder):
    c = table(spark, folder, "concept_graph").where("size(facets.time_range) = 2 and id is not null")
    r = c.groupBy("id").agg(F.min(F.expr("facets.time_range[0]")).alias("s"), F.min(F.expr("facets.time_range[1]")).alias("e"))
    return r.select("id", scores.parse_time(F.col("s")).alias("s"), scores.parse_time(F.col("e")).alias("e"))


@query(f"""
WITH r AS (SELECT id, epoch(try_cast(s AS TIMESTAMPTZ)) AS s, epoch(try_cast(e AS TIMESTAMPTZ)) AS e FROM ({_RANGE})), k AS (SELECT * FROM r WHERE s IS NOT NULL AND e IS NOT NULL)
SELECT a.id, count(*) FILTER (b.id IS NOT NULL) AS near FROM k a LEFT JOIN k b ON a.id <> b.id AND a.s <= b.e + 604800 AND b.s <= a.e + 604800 GROUP BY a.id
""")
def temporal_proximity(spark, folder):
    """With how many others each concept is near in time."""
    return temporal.near_counts(_ranges(spark, folder), "id", "s", "e")


@query(f"SELECT id FROM (SELECT id, try_cast(e AS TIMESTAMPTZ) AS e FROM ({_RANGE})) WHERE (epoch(TIMESTAMP '{NOW}') - epoch(e)) / 86400 > 100")
def staleness(spark, folder):
    """Concepts last corroborated more than 100 days ago."""
    return temporal.stale(_ranges(spark, folder), F.col("e"), NOW, 100).select("id")


@query(f"""
WITH e AS (SELECT event_id, born, coalesce(confidence, 0.5) * (coalesce(markers.surprise, 0) + 0.7 * coalesce(markers.insight, 0) + 0.5 * coalesce(markers.research, 0) + 0.01) AS s FROM resolved_event WHERE born IS NOT NULL),
r AS (SELECT DISTINCT run_id, min(started_at) AS at FROM report GROUP BY run_id)
SELECT event_id FROM e WHERE s < 0.3 AND (epoch(TIMESTAMP '{NOW}') - epoch(born)) / 86400 >= 7 AND (SELECT count(*) FROM r WHERE epoch(r.at) > epoch(e.born)) >= 4
""")
def forget_candidates(spark, folder):
    """Events of low salience that four runs or more have passed over."""
    runs = table(spark, folder, "report").groupBy("run_id").agg(F.min("started_at").alias("at"))
    e = table(spark, folder, "resolved_event")
    out = temporal.forgotten(e, "event_id", F.col("born"), runs, "at", scores.salience(F.col("markers"), F.col("confidence")), NOW, 4, 0.3)
    return out.select("event_id")


# Facets, candidates and claims


@query(f"""
WITH p AS (SELECT item_id, unnest({_GRAMS.format('form')}) AS m FROM (SELECT item_id, {_FORM.format('text')} AS form FROM benchmark WHERE text IS NOT NULL)),
e AS (SELECT event_id, unnest({_GRAMS.format('form')}) AS m FROM (SELECT event_id, {_FORM.format('quote')} AS form FROM resolved_event WHERE quote IS NOT NULL)),
d AS (SELECT m, count(*) AS df FROM p GROUP BY m), r AS (SELECT event_id, m, row_number() OVER (PARTITION BY event_id ORDER BY df, m) AS k FROM e JOIN d USING (m))
SELECT event_id, item_id, count(*) AS shared FROM r JOIN p USING (m) WHERE k <= 8 GROUP BY 1, 2 HAVING count(*) >= 2
""")
def rare_shingle_candidates(spark, folder):
    """Claims that share two of an event's eight rarest pieces."""
    # Both keys are unique and the pieces of a text are distinct: nothing is left to make once.
    grams = lambda t, key, col: t.where(f"{col} is not null").select(key, F.explode(text.shingles(text.normalize(F.col(col)))).alias("member"))
    return matching.rare_candidates(grams(table(spark, folder, "resolved_event"), "event_id", "quote"), grams(table(spark, folder, "benchmark"), "item_id", "text"), "event_id", "item_id")


@query("""
WITH m AS (SELECT DISTINCT id, unnest(facets.files) AS member FROM concept_graph WHERE id IS NOT NULL)
SELECT a.id AS a, b.id AS b, count(*)::INT AS files, array_to_string(list_sort(list(a.member)), '|') AS shared FROM m a JOIN m b ON a.member = b.member AND a.id < b.id GROUP BY 1, 2
""")
def shared_file_edges(spark, folder):
    """Edges between concepts that share a file, whoever else holds it."""
    p = matching.facet_pairs(matching.members(table(spark, folder, "concept_graph"), "id", "facets.files"), "id")
    return p.select("a", "b", F.size("shared").alias("files"), F.array_join("shared", "|").alias("shared"))


_FACETS = """m AS (SELECT DISTINCT id, kind, member FROM (SELECT id, 'shares-file' AS kind, unnest(facets.files) AS member FROM concept_graph UNION ALL SELECT id, 'shares-repo', unnest(facets.repos) FROM concept_graph
UNION ALL SELECT id, 'shares-tool', unnest(facets.tools) FROM concept_graph) WHERE id IS NOT NULL AND member IS NOT NULL),
t AS (SELECT id, min(lo) AS lo, max(hi) AS hi FROM (SELECT id, try_cast(facets.time_range[1] AS TIMESTAMPTZ) AS lo, try_cast(facets.time_range[2] AS TIMESTAMPTZ) AS hi FROM concept_graph WHERE id IS NOT NULL AND len(facets.time_range) = 2) WHERE lo IS NOT NULL AND hi IS NOT NULL GROUP BY id),
s AS (SELECT a.id AS a, b.id AS b, kind, list_sort(list(a.member)) AS shared FROM m a JOIN m b USING (kind, member) WHERE a.id < b.id GROUP BY ALL
UNION ALL SELECT a.id, b.id, 'temporal-proximity', [] FROM t a JOIN t b ON a.id < b.id AND a.lo <= b.hi + INTERVAL 168 HOUR AND b.lo <= a.hi + INTERVAL 168 HOUR),
c AS (SELECT a, b FROM s GROUP BY a, b HAVING sum(CASE kind WHEN 'shares-file' THEN 3.0 * len(shared) WHEN 'shares-repo' THEN 1.0 * len(shared) WHEN 'shares-tool' THEN 0.5 * len(shared) ELSE 0.25 END) >= 3.0)"""


@query(f"WITH {_FACETS} SELECT a AS source, b AS target, kind, array_to_string(shared, '|') AS shared FROM s")
def concept_edges(spark, folder):
    """Every facet overlap of every pair of concepts: files, repositories, tools, nearness in time."""
    return facets.edges(table(spark, folder, "concept_graph"), lambda shared: F.array_join(shared, "|"))


@query(f"""
WITH RECURSIVE {_FACETS}, n AS (SELECT id, row_number() OVER (ORDER BY id) AS k FROM (SELECT DISTINCT id FROM concept_graph WHERE id IS NOT NULL)),
w AS (SELECT 0::BIGINT AS k, []::VARCHAR[] AS leaders, NULL::VARCHAR AS id, NULL::VARCHAR AS leader
UNION ALL SELECT k, CASE WHEN found IS NULL THEN list_append(leaders, id) ELSE leaders END, id, coalesce(found, id) FROM
(SELECT n.k, w.leaders, n.id, (SELECT min(c.a) FROM c WHERE c.b = n.id AND list_contains(w.leaders, c.a)) AS found FROM w JOIN n ON n.k = w.k + 1))
SELECT id AS node, leader FROM w WHERE k > 0
""")
def concept_leaders(spark, folder):
    """Every concept by the first leader against which its facet score is CLUSTER_MIN or more."""
    c = table(spark, folder, "concept_graph")
    return graphs.group_leaders(c.select(F.col("id").alias("node")), facets.close_groups(c))


@query(f"""
WITH RECURSIVE {_FACETS}, e AS (SELECT a AS x, b AS y FROM c UNION SELECT b, a FROM c),
w AS (SELECT x AS node, x AS seen FROM e UNION SELECT w.node, e.y FROM w JOIN e ON w.seen = e.x) SELECT node, min(seen) AS root FROM w GROUP BY node
""")
def concept_components(spark, folder):
    """Components of concepts linked by a facet score of CLUSTER_MIN or more."""
    return graphs.components(facets.close_pairs(table(spark, folder, "concept_graph")), "a", "b")


@query("""
WITH q AS (SELECT session_id, event_id, quote, markers, confidence FROM resolved_event WHERE session_id IS NOT NULL)
SELECT session_id, count(DISTINCT event_id) AS events, count(DISTINCT quote) AS quotes, max(coalesce(markers.surprise, 0)) AS surprise, max(coalesce(markers.insight, 0)) AS insight, max(coalesce(markers.research, 0)) AS research, max(coalesce(confidence, 0.5)) AS confidence FROM q GROUP BY session_id
""")
def claim_fold(spark, folder):
    """Per session: events, distinct quotes, highest markers and confidence."""
    e = table(spark, folder, "resolved_event").where("session_id is not null")
    top = lambda m: F.max(F.coalesce(F.col(f"markers.{m}"), F.lit(0.0))).alias(m)
    return e.groupBy("session_id").agg(F.count_distinct("event_id").alias("events"), F.count_distinct("quote").alias("quotes"), top("surprise"), top("insight"), top("research"), F.max(F.coalesce("confidence", F.lit(0.5))).alias("confidence"))


@query("""
WITH c AS (SELECT DISTINCT id, unnest(facets.tools) AS tool, facets FROM concept_graph WHERE id IS NOT NULL),
r AS (SELECT tool, count(DISTINCT repo) AS repos, min(repo) AS repo FROM (SELECT tool, unnest(facets.repos) AS repo FROM c) WHERE tool IS NOT NULL AND repo IS NOT NULL GROUP BY tool),
f AS (SELECT tool, bool_or(n > 1) AS shared FROM (SELECT tool, file, count(DISTINCT id) AS n FROM (SELECT tool, id, unnest(facets.files) AS file FROM c) WHERE tool IS NOT NULL AND file IS NOT NULL GROUP BY ALL) GROUP BY tool)
SELECT tool, CASE WHEN repos >= 2 AND NOT coalesce(shared, false) THEN 'cross-cutting' ELSE 'local' END AS scope, CASE WHEN repos = 1 THEN repo END AS scope_repo FROM r LEFT JOIN f USING (tool)
""")
def scope_derivation(spark, folder):
    """A tool is cross-cutting if its concepts span repositories and share no file."""
    c = table(spark, folder, "concept_graph").where("id is not null").select("id", F.explode("facets.tools").alias("tool"), "facets").where("tool is not null")
    r = c.select("tool", F.explode("facets.repos").alias("repo")).where("repo is not null").distinct().groupBy("tool").agg(F.count("*").alias("repos"), F.min("repo").alias("repo"))
    f = c.select("tool", "id", F.explode("facets.files").alias("file")).where("file is not null").distinct().groupBy("tool", "file").agg(F.count("*").alias("n")).groupBy("tool").agg(F.max(F.col("n") > 1).alias("shared"))
    scope = F.when((F.col("repos") >= 2) & ~F.coalesce("shared", F.lit(False)), "cross-cutting").otherwise("local")
    return r.join(f, "tool", "left").select("tool", scope.alias("scope"), F.when(F.col("repos") == 1, F.col("repo")).alias("scope_repo"))


@query("SELECT DISTINCT id, substr(sha256(array_to_string(list_sort(list_distinct(facets.sessions)), chr(10))), 1, 16) AS fingerprint FROM concept_graph WHERE len(facets.sessions) > 0")
def edge_fingerprint(spark, folder):
    """A fingerprint of the set of sessions behind each concept."""
    c = table(spark, folder, "concept_graph").where("size(facets.sessions) > 0")
    return c.select("id", F.substring(F.sha2(F.array_join(F.array_sort(F.array_distinct(F.array_compact("facets.sessions"))), "\n"), 256), 1, 16).alias("fingerprint")).distinct()


@query("""
WITH t AS (SELECT session_id, unnest(from_json(message.content, '[{"type":"VARCHAR","name":"VARCHAR"}]')) AS b FROM transcript WHERE type = 'assistant' AND NOT coalesce(isSidechain, false) AND regexp_matches(message.content, '^\\s*\\[\\s*\\{') AND json_valid(message.content))
SELECT session_id, b.name AS tool, count(*) AS uses FROM t WHERE b.type = 'tool_use' AND session_id IS NOT NULL AND b.name IS NOT NULL GROUP BY 1, 2
""")
def session_tools(spark, folder):
    """Tools each session used."""
    t = table(spark, folder, "transcript").where("type = 'assistant' and not coalesce(isSidechain, false) and session_id is not null").where(F.col("message.content").rlike(transcripts.LISTED))
    b = t.select("session_id", F.explode(F.from_json("message.content", "array<struct<type:string,name:string>>")).alias("b"))
    return b.where("b.type = 'tool_use' and b.name is not null").groupBy("session_id", F.col("b.name").alias("tool")).agg(F.count("*").alias("uses"))


_BLOCKS = """b AS (SELECT session_id, pos, uuid, unnest(from_json(message.content, '[{"type":"VARCHAR","id":"VARCHAR","name":"VARCHAR","tool_use_id":"VARCHAR","content":"VARCHAR"}]')) AS b FROM transcript
WHERE session_id IS NOT NULL AND NOT coalesce(isSidechain, false) AND regexp_matches(message.content, '^\\s*\\[\\s*\\{') AND json_valid(message.content)),
u AS (SELECT DISTINCT session_id, b.id AS tool_id, b.name AS tool FROM b WHERE b.type = 'tool_use' AND b.id IS NOT NULL),
r AS (SELECT session_id, b.tool_use_id AS tool_id, max(pos) AS result_pos FROM b WHERE b.type = 'tool_result' AND b.tool_use_id IS NOT NULL GROUP BY 1, 2)"""


@query(f"WITH {_BLOCKS} SELECT session_id, tool_id, tool, result_pos FROM u LEFT JOIN r USING (session_id, tool_id)")
def tool_results(spark, folder):
    """Tool calls with the place of their last result, wherever in the session it stands."""
    t = table(spark, folder, "transcript").where("session_id is not null and not coalesce(isSidechain, false)").where(F.col("message.content").rlike(transcripts.LISTED))
    b = t.select("session_id", "pos", F.explode(F.from_json("message.content", "array<struct<type:string,id:string,name:string,tool_use_id:string>>")).alias("b"))
    used = b.where("b.type = 'tool_use' and b.id is not null").select("session_id", F.col("b.id").alias("tool_id"), F.col("b.name").alias("tool")).distinct()
    results = b.where("b.type = 'tool_result' and b.tool_use_id is not null").groupBy("session_id", F.col("b.tool_use_id").alias("tool_id")).agg(F.max("pos").alias("result_pos"))
    return used.join(results, ["session_id", "tool_id"], "left")


@query("""
WITH r AS (SELECT session_id, min(pos) AS pos, uuid, any_value(type) AS type, any_value(coalesce(message.id, uuid)) AS mid FROM transcript WHERE session_id IS NOT NULL AND uuid IS NOT NULL AND NOT coalesce(isSidechain, false) GROUP BY session_id, uuid),
g AS (SELECT *, lag(mid) OVER (PARTITION BY session_id ORDER BY pos, uuid) AS p, lag(type) OVER (PARTITION BY session_id ORDER BY pos, uuid) AS pt FROM r)
SELECT session_id, count(*) AS records, sum((p IS NULL OR p <> mid OR pt <> 'assistant' OR type <> 'assistant')::INT)::BIGINT AS turns FROM g GROUP BY session_id
""")
def turn_runs(spark, folder):
    """Records and turns of sessions: neighbouring assistant records of one message are one turn."""
    t = table(spark, folder, "transcript").where("session_id is not null and uuid is not null and not coalesce(isSidechain, false)")
    r = t.groupBy("session_id", "uuid").agg(F.min("pos").alias("pos"), F.first("type").alias("type"), F.first(F.coalesce("message.id", "uuid")).alias("mid")).withColumn("stretch", F.expr("pos div 1000"))
    r = ordered.with_previous(r, ["session_id"], F.struct("pos", "uuid"), "stretch", F.struct("mid", "type"), "last")
    new = F.col("last").isNull() | (F.col("last.mid") != F.col("mid")) | (F.col("last.type") != "assistant") | (F.col("type") != "assistant")
    return r.groupBy("session_id").agg(F.count("*").alias("records"), F.sum(new.cast("bigint")).alias("turns"))


@query("""
WITH w AS (SELECT item_id, unnest(list_filter(regexp_extract_all(lower(text), '[a-z0-9$_./-]+'), lambda x: length(x) > 2)) AS term FROM benchmark),
tf AS (SELECT item_id, term, count(*) AS tf FROM w GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term), n AS (SELECT count(DISTINCT item_id) AS n FROM benchmark),
r AS (SELECT item_id, term, tf * (ln((n + 1) / (df + 1)) + 1) AS w FROM tf JOIN df USING (term), n)
SELECT item_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY item_id)), 6) AS weight FROM r
""")
def tfidf_weights(spark, folder):
    """Term weights of the test items."""
    return matching.tfidf(table(spark, folder, "benchmark"), "item_id", text.terms(F.col("text"))).withColumn("weight", F.round("weight", 6))


@query("""
SELECT (SELECT count(DISTINCT session_id) FROM transcript) AS sessions, (SELECT count(DISTINCT cleaned_hash) FROM cleaned_blob) AS blobs, (SELECT count(*) FROM (SELECT DISTINCT cleaned_hash, byte_start, byte_end, segment FROM chunk)) AS chunks,
(SELECT count(DISTINCT event_id) FROM resolved_event) AS events, (SELECT count(DISTINCT id) FROM concept_graph) AS concepts, (SELECT count(DISTINCT run_id) FROM source_plan) AS runs
""")
def census(spark, folder):
    """How much of everything there is."""
    t = lambda name: table(spark, folder, name)
    parts = [t("transcript").agg(F.count_distinct("session_id").alias("sessions")), t("cleaned_blob").agg(F.count_distinct("cleaned_hash").alias("blobs")), t("chunk").select("cleaned_hash", "byte_start", "byte_end", "segment").distinct().agg(F.count("*").alias("chunks")), t("resolved_event").agg(F.count_distinct("event_id").alias("events")), t("concept_graph").agg(F.count_distinct("id").alias("concepts")), t("source_plan").agg(F.count_distinct("run_id").alias("runs"))]
    named = [p.select(F.lit(c).alias("k"), F.col(c).alias("v")) for p in parts for c in p.columns]
    one = named[0]
    for p in named[1:]:
        one = one.union(p)
    return one.groupBy().pivot("k", [c for p in parts for c in p.columns]).agg(F.first("v"))


@query("""
WITH once AS (SELECT run_id, any_value(datastore) AS datastore, any_value(planned_at) AS planned_at, any_value(feed_entries) AS feed_entries FROM source_plan GROUP BY run_id),
e AS (SELECT datastore, unnest(feed_entries) AS e, planned_at, run_id FROM once)
SELECT datastore, e.feed_url AS feed_url, e.entry_id AS entry_id, min(planned_at) AS first_seen, count(*) AS listed FROM e WHERE e.entry_id IS NOT NULL GROUP BY 1, 2, 3
""")
def feed_first_seen(spark, folder):
    """When each feed entry was first listed, and how often."""
    once = table(spark, folder, "source_plan").dropDuplicates(["run_id"])
    e = once.select("datastore", "planned_at", F.explode("feed_entries").alias("e")).where("e.entry_id is not null")
    return e.groupBy("datastore", "e.feed_url", "e.entry_id").agg(F.min("planned_at").alias("first_seen"), F.count("*").alias("listed"))


@query("""
WITH c AS (SELECT DISTINCT id, title, len(facets.sessions) AS sessions, list_sort(facets.tools)[1] AS tool FROM concept_graph WHERE id IS NOT NULL AND title IS NOT NULL)
SELECT id, coalesce(tool, 'general') AS grp, sessions::INT AS sessions FROM c WHERE sessions IS NOT NULL ORDER BY sessions DESC, id LIMIT 80
""")
def concept_digest(spark, folder):
    """The 80 concepts of most sessions, each with the group it is listed in."""
    tools = F.array_sort(F.filter("facets.tools", lambda x: x.isNotNull()))
    c = table(spark, folder, "concept_graph").where("id is not null and title is not null and facets.sessions is not null")
    c = c.select("id", F.size("facets.sessions").alias("sessions"), F.coalesce(F.try_element_at(tools, F.lit(1)), F.lit("general")).alias("grp")).distinct()
    return c.orderBy(F.desc("sessions"), "id").limit(80).select("id", "grp", "sessions")


# The life of claims


_EDGES = """v AS (SELECT l_orderkey AS event_id, CASE l_returnflag WHEN 'R' THEN 'contradicts' ELSE 'corroborates' END AS verb, l_suppkey AS claim_id, l_shipdate AS said, l_linenumber, l_linestatus = 'O' AS active, l_discount FROM lineitem),
rej AS (SELECT DISTINCT event_id, verb, claim_id FROM v WHERE l_discount >= 0.095),
live AS (SELECT event_id, verb, claim_id FROM (SELECT *, row_number() OVER (PARTITION BY event_id, verb, claim_id ORDER BY said DESC, l_linenumber DESC) AS k FROM v WHERE event_id IS NOT NULL AND claim_id IS NOT NULL)
WHERE k = 1 AND active AND (event_id, verb, claim_id) NOT IN (SELECT (event_id, verb, claim_id) FROM rej))"""


def _edge_versions(spark, folder):
    """Lines of orders as versions of edges: an order speaks for a supplier, or against it where the goods came back."""
    verb = F.when(F.col("l_returnflag") == "R", "contradicts").otherwise("corroborates")
    return table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("event_id"), verb.alias("verb"), F.col("l_suppkey").alias("claim_id"), F.struct("l_shipdate", "l_linenumber").alias("at"), (F.col("l_linestatus") == "O").alias("active"), "l_discount")


def _live_edges(spark, folder):
    v = _edge_versions(spark, folder)
    none = F.lit(None)
    rejections = v.where("l_discount >= 0.095").select(F.lit(claims.REJECT_MERGE).alias("verb"), none.cast("string").alias("target"), none.cast("timestamp").alias("at"), claims.edge_id(F.col("event_id"), F.col("verb"), F.col("claim_id")).alias("edge"), none.cast("array<string>").alias("pair"))
    return claims.live_edges(v.drop("l_discount"), claims.rejected(rejections).edges)


@query(f"WITH {_EDGES} SELECT event_id, verb, claim_id FROM live")
def live_claim_edges(spark, folder):
    """The last version of each edge where it is active and no rejection names it."""
    return _live_edges(spark, folder).select("event_id", "verb", "claim_id")


@query(f"""
WITH {_EDGES}, s AS (SELECT claim_id, verb = 'contradicts' AS contra, event_id, o_custkey AS repo, o_orderdate AS ts FROM live JOIN orders ON o_orderkey = event_id),
o AS (SELECT *, lag(ts) OVER (PARTITION BY claim_id, contra, repo ORDER BY ts, event_id) AS p FROM s),
n AS (SELECT *, sum((p IS NULL OR epoch(ts) - epoch(p) > 12 * 3600)::INT) OVER (PARTITION BY claim_id, contra, repo ORDER BY ts, event_id) AS sit FROM o),
w AS (SELECT claim_id, contra, pow(0.5, greatest(0, (epoch(TIMESTAMP '1998-09-01') - epoch(max(ts))) / 86400) / 180) AS w FROM n GROUP BY claim_id, contra, repo, sit),
e AS (SELECT claim_id, count(*) FILTER (NOT contra) AS support, count(*) FILTER (contra) AS contradictions, sum(CASE WHEN contra THEN -w ELSE w END) AS net FROM w GROUP BY claim_id),
y AS (SELECT claim_id, min(greatest(0, (epoch(TIMESTAMP '1998-09-01') - epoch(ts)) / 86400)) FILTER (NOT contra) AS youngest FROM s GROUP BY claim_id)
SELECT claim_id, support, contradictions, round(net, 4) AS entrenchment, round(youngest, 4) AS youngest, net >= 0.5 OR coalesce(youngest <= 90, false) AS active, net >= 1.5 AS mature FROM e JOIN y USING (claim_id)
""")
def claim_standing(spark, folder):
    """What each claim's live edges weigh by sittings, and whether it is active and mature."""
    o = table(spark, folder, "orders").select(F.col("o_orderkey").alias("event_id"), F.col("o_custkey").alias("repo"), F.col("o_orderdate").alias("ts"))
    e = _live_edges(spark, folder).select("event_id", "verb", "claim_id").join(o, "event_id")
    out = claims.standing(e, "event_id", "repo", "ts", "1998-09-01 00:00:00")
    return out.withColumn("entrenchment", F.round("entrenchment", 4)).withColumn("youngest", F.round("youngest", 4))


@query(f"""
WITH {_EDGES}, b AS (SELECT s_nationkey, min(s_suppkey) AS winner FROM supplier WHERE s_acctbal >= 0 GROUP BY 1), m AS (SELECT s_suppkey AS loser, winner FROM supplier JOIN b USING (s_nationkey) WHERE s_acctbal < 0),
mine AS (SELECT live.*, winner FROM live JOIN m ON claim_id = loser),
g AS (SELECT winner AS claim_id, event_id, verb, true AS active, min(claim_id) AS repointed_from FROM mine WHERE (winner, event_id, verb) NOT IN (SELECT (claim_id, event_id, verb) FROM live) GROUP BY ALL)
SELECT claim_id, event_id, verb, active, repointed_from FROM g UNION ALL SELECT claim_id, event_id, verb, false, NULL FROM mine
""")
def merged_edges(spark, folder):
    """What a merge of claims appends: the winner's new edges and the loser's retractions."""
    s = table(spark, folder, "supplier")
    best = s.where("s_acctbal >= 0").groupBy("s_nationkey").agg(F.min("s_suppkey").alias("winner"))
    merges = s.where("s_acctbal < 0").join(best, "s_nationkey").select(F.col("s_suppkey").alias("loser"), "winner")
    e = _live_edges(spark, folder).select("event_id", "verb", "claim_id", "active", F.lit(0).alias("at"))
    return claims.merged(e, merges, F.lit(1)).select("claim_id", "event_id", "verb", "active", "repointed_from")


@query("""
WITH v AS (SELECT l_suppkey AS src, CASE l_returnflag WHEN 'N' THEN 'generalizes' ELSE 'relates' END AS kind, l_partkey AS dst, l_shipdate AS said, l_orderkey, l_linenumber, l_linestatus = 'O' AS active FROM lineitem),
n AS (SELECT src, dst FROM (SELECT *, row_number() OVER (PARTITION BY src, kind, dst ORDER BY said DESC, l_orderkey DESC, l_linenumber DESC) AS k FROM v) WHERE k = 1 AND active AND kind = 'generalizes'
AND src IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) AND dst IN (SELECT p_partkey FROM part))
SELECT src, count(*)::INT AS n, array_to_string(list_sort(list(dst)), ',') AS children FROM n GROUP BY src
""")
def concept_hierarchy(spark, folder):
    """What each valid node generalizes by the last version of its asserted edges."""
    kind = F.when(F.col("l_returnflag") == "N", "generalizes").otherwise("relates")
    e = table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("src"), kind.alias("kind"), F.col("l_partkey").alias("dst"), F.struct("l_shipdate", "l_orderkey", "l_linenumber").alias("at"), (F.col("l_linestatus") == "O").alias("active"))
    valid = table(spark, folder, "supplier").where("s_acctbal >= 0").select(F.col("s_suppkey").alias("src"))
    out = claims.children(e.join(valid, "src", "left_semi"), table(spark, folder, "part").select(F.col("p_partkey").alias("id")).union(valid))
    return out.select("src", F.size("children").alias("n"), F.array_join(F.transform("children", lambda c: c.cast("string")), ",").alias("children"))


@query("""
WITH r(tag, winner) AS (VALUES ('F', 'P'), ('P', '5-LOW'), ('1-URGENT', '2-HIGH'), ('4-NOT SPECIFIED', NULL)),
n AS (SELECT o_custkey AS concept_id, [o_orderstatus, o_orderpriority] AS tags FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1),
e AS (SELECT concept_id, unnest(tags) AS tag FROM n), t AS (SELECT DISTINCT concept_id, CASE WHEN tag IN ('F', 'P') THEN '5-LOW' WHEN r.tag IS NOT NULL THEN r.winner ELSE e.tag END AS tag FROM e LEFT JOIN r USING (tag))
SELECT concept_id, coalesce(array_to_string(list_sort(list(tag) FILTER (tag IS NOT NULL)), '|'), '') AS tags FROM n LEFT JOIN t USING (concept_id) GROUP BY concept_id
""")
def tag_assignments(spark, folder):
    """The tags of each concept's latest assignment, at the end of their redirects."""
    a = table(spark, folder, "orders").select(F.col("o_custkey").alias("concept_id"), F.array("o_orderstatus", "o_orderpriority").alias("tags"), F.struct("o_orderdate", "o_orderkey").alias("at"))
    redirects = spark.createDataFrame([("F", "P"), ("P", "5-LOW"), ("1-URGENT", "2-HIGH"), ("4-NOT SPECIFIED", None)], "loser string, winner string")
    return claims.assigned_tags(a, redirects).select("concept_id", F.array_join("tags", "|").alias("tags"))


@query("""
WITH m AS (SELECT DISTINCT id, member FROM (SELECT id, 'repo:' || unnest(facets.repos) AS member FROM concept_graph UNION ALL SELECT id, 'file:' || unnest(facets.files) FROM concept_graph) WHERE id IS NOT NULL AND member IS NOT NULL),
n AS (SELECT count(DISTINCT id) AS n FROM concept_graph), d AS (SELECT member FROM m GROUP BY member HAVING count(*) < 2 OR count(*) <= 0.5 * (SELECT n FROM n)),
p AS (SELECT DISTINCT a.id, b.id AS other FROM m a JOIN d USING (member) JOIN m b USING (member))
SELECT id, count(*) AS candidates FROM p GROUP BY id
""")
def facet_devaluation(spark, folder):
    """How many claims share a subject with each one, subjects of more than half of all claims left out."""
    c = table(spark, folder, "concept_graph")
    part = lambda kind: F.transform(F.coalesce(f"facets.{kind}s", F.array().cast("array<string>")), lambda x: F.concat(F.lit(f"{kind}:"), x))
    named = F.concat(part("repo"), part("file"))
    total = c.where("id is not null").select("id").distinct().count()
    return matching.shared_counts(matching.members(c, "id", named), "id", total).select("id", F.col("shared_with").alias("candidates"))


@query(f"""
WITH f AS (SELECT pin_id, min({_FORM.format('text')}) AS form FROM stmt_sig_pins WHERE pin_id IS NOT NULL AND text IS NOT NULL GROUP BY pin_id),
h AS (SELECT pin_id, -sum(k / n * log2(k / n)) AS e FROM (SELECT pin_id, any_value(length(form)) AS n, c, count(*) AS k FROM (SELECT pin_id, form, unnest(string_split(form, '')) AS c FROM f WHERE form <> '') GROUP BY pin_id, c) GROUP BY pin_id),
g AS (SELECT pin_id, {_GRAMS.format('form')} AS g FROM f JOIN h USING (pin_id) WHERE e >= 3.0),
j AS (SELECT a.pin_id AS a, b.pin_id AS b, len(list_intersect(a.g, b.g)) AS k, len(a.g) AS na, len(b.g) AS nb FROM g a JOIN g b ON a.pin_id < b.pin_id)
SELECT a, b, round(k / (na + nb - k), 6) AS sim FROM j WHERE k / (na + nb - k) >= 0.12 AND k / (na + nb - k) < 0.55
""")
def merge_suggestions(spark, folder):
    """All pairs of statements in the band that the thresholds leave open."""
    found = histogram.pairs_between(table(spark, folder, "stmt_sig_pins"), "pin_id", "text", text.J_MAYBE, text.J_HIGH)
    return found.select("a", "b", F.round("sim", 6).alias("sim"))


@query("""
SELECT session_id, valid FROM (SELECT source_id AS session_id, cleaned_hash, n_bytes AS valid, row_number() OVER (PARTITION BY source_id ORDER BY n_bytes DESC, cleaned_hash DESC) AS k FROM cleaned_blob WHERE source_id IS NOT NULL AND source_kind IN ('transcript', 'document')) WHERE k = 1
""")
def session_valid_times(spark, folder):
    """What the latest version of each source says of it; blobs have no times, so their sizes stand for fetching and for happening."""
    b = table(spark, folder, "cleaned_blob").select("source_id", "source_kind", F.col("n_bytes").alias("fetched_at"), F.col("cleaned_hash").alias("content_hash"), F.col("n_bytes").alias("mtime"))
    return claims.valid_times(b)


# Order-dependent operators


_PATH = """r0 AS (SELECT session_id, uuid, max(struct_pack(pos := pos, turn := coalesce(type IN ('user', 'assistant'), false), side := coalesce(isSidechain, false), p := parentUuid, l := logicalParentUuid)) AS r FROM transcript WHERE session_id IS NOT NULL AND uuid IS NOT NULL AND pos IS NOT NULL GROUP BY 1, 2),
r AS (SELECT session_id, uuid, r.pos AS pos, r.turn AS turn, r.p AS p, r.l AS l FROM r0 WHERE NOT r.side),
w AS (SELECT session_id, arg_max(uuid, (pos, uuid)) AS here, [arg_max(uuid, (pos, uuid))] AS path FROM r WHERE turn GROUP BY session_id
UNION ALL SELECT session_id, too, list_append(path, too) FROM (SELECT w.session_id, w.path, coalesce(
CASE WHEN c.p IN (SELECT uuid FROM r x WHERE x.session_id = w.session_id) AND NOT list_contains(w.path, c.p) THEN c.p END,
CASE WHEN c.l IN (SELECT uuid FROM r x WHERE x.session_id = w.session_id) AND NOT list_contains(w.path, c.l) THEN c.l END,
(SELECT arg_max(t.uuid, (t.pos, t.uuid)) FROM r t WHERE t.session_id = w.session_id AND t.turn AND (t.pos, t.uuid) < (c.pos, c.uuid) AND NOT list_contains(w.path, t.uuid))) AS too FROM w JOIN r c ON c.session_id = w.session_id AND c.uuid = w.here) WHERE too IS NOT NULL),
f AS (SELECT session_id, arg_max(path, len(path)) AS path FROM w GROUP BY session_id)"""


@query(f"WITH RECURSIVE {_PATH} SELECT session_id, unnest(path) AS uuid, (len(path) - unnest(range(1, len(path) + 1)))::INT AS rank FROM f")
def active_path(spark, folder):
    """The surviving records of every session, in order."""
    return transcripts.active_path(table(spark, folder, "transcript"))


@query()
def rendered_sessions(spark, folder):
    """Every session as text: its hash, length, and number of turns and segments."""
    r = transcripts.rendered(table(spark, folder, "transcript"))
    return r.select("session_id", F.sha2("text", 256).alias("cleaned_hash"), F.length("text").alias("chars"), F.size("turns").alias("turns"), (F.array_max("turns.segment") + 1).alias("segments"))


@query()
def session_windows(spark, folder):
    """Windows of 12,000 characters over the rendered sessions."""
    r = transcripts.rendered(table(spark, folder, "transcript"))
    return r.select("session_id", F.explode(rendering.packed(F.col("turns"))).alias("w")).select("session_id", "w.turn_start", "w.turn_end", "w.char_start", "w.char_end", "w.segment")


@query()
def resolved_claims(spark, folder):
    """Events resolved into claims without a model, and what each claim rests on."""
    e = table(spark, folder, "resolved_event").select(F.col("event_id").cast("string").alias("event_id"), "session_id", F.col("session_id").alias("sitting"), F.col("quote").alias("summary"), "quote", "confidence", scores.salience(F.col("markers"), F.col("confidence")).alias("priority"))
    return resolving.claims_of(resolving.resolve(e), e.dropDuplicates(["event_id"]))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
