"""The queries of this subpackage over the driver tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marl.llm.bpe import encode_texts
from marl.llm.dialogue import conversations
from marl.llm.history import repeats_by_batch
from marl.llm.leakage import leaked_items, paraphrased_items
from marl.llm.lookalike import lookalike_classes, lookalike_pairs
from marl.llm.neardup import near_duplicate_groups
from marl.llm.setjoin import concept_members, similar_pairs
from marl.llm.splitter import split_chunks


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_groups(table(spark, folder, "stmt_sig_pins"), "pin_id", "text")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return repeats_by_batch(table(spark, folder, "resolved_event"), "event_id", "quote", "batch_no")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return similar_pairs(concept_members(table(spark, folder, "concept_graph")), "id", "members")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return conversations(table(spark, folder, "transcript"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return split_chunks(table(spark, folder, "chunk"), table(spark, folder, "cleaned_blob"))


def p6_cohesion(spark: SparkSession, folder: str) -> DataFrame:
    return split_chunks(table(spark, folder, "chunk"), table(spark, folder, "cleaned_blob"), "cohesion")


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_texts(table(spark, folder, "documents"), "doc_id", "text")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaked_items(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "benchmark"), "item_id", "text")


def p8_paraphrases(spark: SparkSession, folder: str) -> DataFrame:
    return paraphrased_items(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "benchmark"), "item_id", "text")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return lookalike_pairs(table(spark, folder, "documents"), "doc_id", "text")


def p9_classes(spark: SparkSession, folder: str) -> DataFrame:
    return lookalike_classes(table(spark, folder, "documents"), "doc_id", "text")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k[0] == "p" and k[1:2].isdigit() and callable(f)}


_FORM = "trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g'))"

P1_SQL = f"""
WITH RECURSIVE t AS (SELECT pin_id, {_FORM} AS form FROM stmt_sig_pins WHERE text IS NOT NULL),
c AS (SELECT pin_id, any_value(length(form)) AS n, c, count(*) AS k FROM (SELECT pin_id, form, unnest(string_split(form, '')) AS c FROM t WHERE form <> '') GROUP BY pin_id, c),
h AS (SELECT pin_id FROM c GROUP BY pin_id HAVING -sum(k / n * log2(k / n)) >= 3),
f AS (SELECT min(pin_id) AS rep, form FROM t JOIN h USING (pin_id) GROUP BY form),
g AS (SELECT DISTINCT rep, unnest(list_transform(range(1, greatest(length(form) - 2, 2)), lambda i: substr(form, i::BIGINT, 4))) AS piece FROM f),
n AS (SELECT rep, count(*) AS n FROM g GROUP BY rep),
p AS (SELECT a.rep AS a, b.rep AS b, count(*) AS k FROM g a JOIN g b ON a.piece = b.piece AND a.rep < b.rep GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.rep = a JOIN n y ON y.rep = b WHERE k / (x.n + y.n - k) >= 0.55),
l AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
w AS (SELECT rep AS node, rep AS seen FROM f UNION SELECT w.node, l.b FROM w JOIN l ON w.seen = l.a),
r AS (SELECT node, min(seen) AS root FROM w GROUP BY node)
SELECT root AS group_id, pin_id FROM t JOIN h USING (pin_id) JOIN f USING (form) JOIN r ON r.node = f.rep WHERE root <> pin_id
"""

P4_SQL = """
WITH m AS (SELECT DISTINCT id, m FROM (
SELECT id, 'f' AS k, 'f' || trim(unnest(facets.files)) AS m FROM concept_graph UNION ALL SELECT id, 't', 't' || trim(unnest(facets.tools)) FROM concept_graph
UNION ALL SELECT id, 'r', 'r' || trim(unnest(facets.repos)) FROM concept_graph) WHERE length(m) > 1),
s AS (SELECT * FROM m WHERE id IN (SELECT id FROM m WHERE m LIKE 'f%')), n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
p AS (SELECT a.id AS a, b.id AS b, count(*) AS k FROM s a JOIN s b ON a.m = b.m AND a.id < b.id GROUP BY 1, 2)
SELECT a AS id_a, b AS id_b FROM p JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE k / (x.n + y.n - k) >= 0.6
"""


P5_SQL = """
WITH RECURSIVE m AS (SELECT session_id, uuid, min(struct_pack(pos := pos, t := type, sub := subtype, meta := coalesce(isMeta, false), side := coalesce(isSidechain, false), ref := coalesce(parentUuid, logicalParentUuid), c := message.content)) AS r
FROM transcript WHERE session_id IS NOT NULL AND uuid IS NOT NULL AND pos IS NOT NULL GROUP BY 1, 2),
r AS (SELECT session_id, uuid, r.pos AS pos, coalesce(r.t IN ('user', 'assistant'), false) AS turn, r.t AS type, coalesce(r.sub = 'compact_boundary', false) AS bridge, r.ref AS ref,
coalesce(r.t IN ('user', 'assistant') AND NOT r.meta AND NOT regexp_full_match(r.c, '[\\s\\p{Z}]*') AND trim(r.c) <> '[]', false) AS spoken,
CASE WHEN contains(r.c, 'tool_result') AND json_valid(r.c) THEN coalesce(list_contains(list_transform(from_json(r.c, '[{"type":"VARCHAR"}]'), lambda b: b.type), 'tool_result'), false) ELSE false END AS result FROM m WHERE NOT r.side),
w AS (SELECT session_id, arg_max(uuid, (pos, uuid)) AS here, [arg_max(uuid, (pos, uuid))] AS path, false AS broken FROM r WHERE turn GROUP BY session_id
UNION ALL SELECT session_id, too, list_append(path, too), lost OR list_contains(path, too) FROM (SELECT w.session_id, w.path, CASE WHEN c.ref IS NULL THEN NULL WHEN c.ref IN (SELECT uuid FROM r x WHERE x.session_id = w.session_id) THEN c.ref
WHEN c.bridge THEN (SELECT arg_max(t.uuid, (t.pos, t.uuid)) FROM r t WHERE t.session_id = w.session_id AND t.turn AND t.pos < c.pos) ELSE '' END AS too,
c.ref IS NOT NULL AND NOT c.bridge AND c.ref NOT IN (SELECT uuid FROM r x WHERE x.session_id = w.session_id) AS lost FROM w JOIN r c ON c.session_id = w.session_id AND c.uuid = w.here WHERE NOT w.broken) WHERE too IS NOT NULL),
f AS (SELECT session_id, arg_max(path, len(path)) AS path, bool_or(broken) AS broken FROM w GROUP BY session_id),
s AS (SELECT session_id, uuid, k, type, type = 'user' AND NOT result AS prompt FROM (SELECT session_id, unnest(path) AS uuid, unnest(range(len(path))) AS k FROM f WHERE NOT broken) JOIN r USING (session_id, uuid) WHERE spoken),
a AS (SELECT *, row_number() OVER w AS turn_no, sum(prompt::INT) OVER w AS asked FROM s WINDOW w AS (PARTITION BY session_id ORDER BY k DESC)),
g AS (SELECT session_id FROM (SELECT session_id, asked, bool_or(type = 'assistant') AS answered FROM a WHERE asked > 0 GROUP BY ALL) GROUP BY session_id HAVING bool_and(answered))
SELECT session_id, turn_no::INT AS turn_no, uuid FROM a JOIN g USING (session_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1_SQL, "p4_found": P4_SQL, "p5_found": P5_SQL}
