"""Sessions as text: the surviving path of a tree of records, its turns, and their layout."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marl.functions.text import RESULT_CAP, TEXT_CAP, THINKING_CAP, TOOL_LINE_CAP, truncate
from marl.operators.rendering import laid_out
from marl.plans.streams import groups

BLOCKS = "array<struct<type:string,text:string,thinking:string,id:string,name:string,input:string,tool_use_id:string,content:string,is_error:boolean>>"
# The arguments a tool line shows, first ones first, and the tools that write files.
SHOWN = ["command", "file_path", "path", "pattern", "url", "query", "subagent_type", "description"]
WRITERS = ["Edit", "Write", "MultiEdit", "NotebookEdit"]
#: Values that JSON writes without quotes.
_BARE = r"^(-?[0-9]+([.][0-9]+)?([eE][-+]?[0-9]+)?|true|false|null|[\[{].*)$"
#: The start of a list of blocks, whatever blanks stand in it.
LISTED = r"^\s*\[\s*\{"


def surviving(parent: np.ndarray, logical: np.ndarray, turn: np.ndarray) -> list[int]:
    """Indices of the path from the oldest record to the last turn, in a session in file order.

    From a record the walk goes to its parent, else to its logical parent, else to the last turn before it, each only
    if it is there and not visited. `parent` and `logical` hold indices, -1 for none. The jump back looks at each turn
    once in all, so a walk takes time in proportion to the session.
    """
    turns = np.flatnonzero(turn)
    if not len(turns):
        return []
    seen = np.zeros(len(turn), bool)
    # For each place in `turns`, one before it with none unvisited between them.
    jump = np.arange(-1, len(turns) - 1)

    def unvisited(place: int) -> int:
        passed = []
        while place >= 0 and seen[turns[place]]:
            passed.append(place)
            place = int(jump[place])
        jump[passed] = place
        return place

    path, at = [], int(turns[-1])
    while at >= 0:
        seen[at] = True
        path.append(at)
        for to in (int(parent[at]), int(logical[at])):
            if to >= 0 and not seen[to]:
                break
        else:
            place = unvisited(int(np.searchsorted(turns, at, "left")) - 1)
            to = int(turns[place]) if place >= 0 else -1
        at = to
    return path[::-1]


def active_path(records: DataFrame) -> DataFrame:
    """(session_id, uuid, rank): the records of the surviving path, ranked from 0, oldest first.

    Rows without session, uuid or place and sidechain records are ignored; a repeated uuid counts at its last place. A
    session's links (40 bytes a record, no content) are held by one task.
    """
    last = records.where("session_id is not null and uuid is not null and pos is not null").groupBy("session_id", "uuid").agg(F.max(F.struct("pos", F.col("type").isin("user", "assistant").alias("turn"), F.coalesce("isSidechain", F.lit(False)).alias("side"), "parentUuid", "logicalParentUuid")).alias("r"))
    number = lambda c: F.coalesce(F.xxhash64(F.col(c)), F.lit(0))
    rows = last.select("session_id", "uuid", "r.*").where("not side")
    rows = rows.select("session_id", "uuid", "pos", F.coalesce("turn", F.lit(False)).alias("turn"), number("uuid").alias("own"), number("parentUuid").alias("p"), number("logicalParentUuid").alias("l"), F.col("parentUuid").isNotNull().alias("hp"), F.col("logicalParentUuid").isNotNull().alias("hl"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches):
            of = lambda c: t.column(c).to_numpy()
            own = of("own")
            order = np.argsort(own, kind="stable")

            def index(ref, there):
                at = np.minimum(np.searchsorted(own, ref, sorter=order), len(own) - 1)
                return np.where(there & (own[order[at]] == ref), order[at], -1)

            path = surviving(index(of("p"), of("hp")), index(of("l"), of("hl")), of("turn"))
            if path:
                taken = t.select(["session_id", "uuid"]).take(pa.array(path)).combine_chunks()
                yield pa.RecordBatch.from_arrays([taken.column("session_id").combine_chunks(), taken.column("uuid").combine_chunks(), pa.array(range(len(path)), pa.int32())], ["session_id", "uuid", "rank"])

    return rows.repartition("session_id").sortWithinPartitions("session_id", "pos", "uuid").mapInArrow(run, "session_id string, uuid string, rank int")


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def result_text(content: Column, is_error: Column) -> Column:
    """The text of a tool result: a string, or the text blocks of a list; errors are marked."""
    listed = F.from_json(content, "array<struct<type:string,text:string>>")
    parts = F.array_join(F.transform(F.filter(listed, lambda b: b["type"] == "text"), lambda b: F.coalesce(b["text"], F.lit(""))), "\n")
    text = F.when(content.rlike(LISTED) & listed.isNotNull(), parts).otherwise(F.coalesce(content, F.lit("")))
    return F.when(F.coalesce(is_error, F.lit(False)), F.concat(F.lit("[error] "), text)).otherwise(text)


def tool_line(name: Column, args: Column) -> Column:
    """One line for a tool call: its name and the first shown argument that is not blank, else its first four arguments as JSON.

    Arguments of one type other than text are shown as they are written."""
    named = F.from_json(args, ", ".join(f"{k} string" for k in SHOWN))
    given = F.filter(F.transform(F.array(*[named[k] for k in SHOWN]), _strip), lambda x: x.isNotNull() & (x != ""))
    every = F.from_json(args, "map<string,string>")
    quoted = lambda v: F.when(v.rlike(_BARE), v).otherwise(F.concat(F.lit('"'), F.regexp_replace(v, r'(["\\\\])', r"\\$1"), F.lit('"')))
    pairs = F.transform(F.slice(F.map_keys(every), 1, 4), lambda k: F.concat(F.lit('"'), k, F.lit('": '), F.coalesce(quoted(F.try_element_at(every, k)), F.lit("null"))))
    rest = F.when(F.size(pairs) > 0, F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}")))
    shown = F.coalesce(F.try_element_at(given, F.lit(1)), rest)
    line = F.concat(F.lit("→ "), F.coalesce(name, F.lit("tool")), F.coalesce(F.concat(F.lit(": "), shown), F.lit("")))
    return truncate(F.regexp_replace(line, "\n", " "), TOOL_LINE_CAP)


def blocks(content: Column) -> Column:
    """A message's content as blocks; plain text is one text block."""
    plain = F.array(F.from_json(F.to_json(F.struct(F.lit("text").alias("type"), content.alias("text"))), BLOCKS[len("array<") : -1]))
    return F.when(content.rlike(r"^\s*\["), F.coalesce(F.from_json(content, BLOCKS), plain)).when(content.isNotNull(), plain)


def rendered(transcript: DataFrame) -> DataFrame:
    """(session_id, text, turns) of every session with a turn to show.

    Turns are user texts, runs of assistant records of one message, and compact boundaries, which open a segment. Meta
    records and users that only return tool results are left out; results stand under their calls, wherever in the
    session they came. Long parts keep head and tail. A session's text is one row.
    """
    recs = transcript.where("session_id is not null and uuid is not null")
    heads = recs.groupBy("session_id", "uuid").agg(F.max_by(F.struct("type", "subtype", F.col("message.id").alias("message_id")), "pos").alias("r"))
    path = active_path(transcript).join(heads, ["session_id", "uuid"]).select("session_id", "uuid", "rank", "r.*")
    listed = recs.where(~F.coalesce("isSidechain", F.lit(False)) & F.col("message.content").rlike(LISTED)).select("session_id", "pos", F.explode(F.from_json("message.content", BLOCKS)).alias("b"))
    results = listed.where("b.type = 'tool_result' and b.tool_use_id is not null").groupBy("session_id", F.col("b.tool_use_id").alias("id")).agg(F.max_by("b", "pos").alias("b")).select("session_id", "id", result_text(F.col("b.content"), F.col("b.is_error")).alias("result"))
    order = Window.partitionBy("session_id").orderBy("rank")
    compact = (F.col("type") == "system") & (F.col("subtype") == "compact_boundary")
    mid = F.when(F.col("type") == "assistant", F.coalesce("message_id", "uuid"))
    rows = path.withColumn("segment", F.sum(F.coalesce(compact, F.lit(False)).cast("int")).over(order)).withColumn("mid", mid)
    new = F.col("mid").isNull() | ~F.col("mid").eqNullSafe(F.lag("mid").over(order))
    # The windows carry links and kinds only; contents come in afterwards, by record.
    content = recs.groupBy("session_id", "uuid").agg(F.max_by(F.struct("isMeta", "compactMetadata", "message"), "pos").alias("c"))
    rows = rows.withColumn("turn", F.sum(new.cast("int")).over(order)).drop("message_id").join(content, ["session_id", "uuid"])
    rows = rows.select("*", "c.*").withColumn("blocks", blocks(F.col("message.content")))
    said = rows.where("type = 'assistant'").select("session_id", "turn", "segment", "rank", F.posexplode("blocks").alias("n", "b"))
    said = said.withColumn("id", F.col("b.id")).join(results, ["session_id", "id"], "left")
    indented = F.concat(F.lit("\n  ⤷ "), F.regexp_replace(truncate(_strip(F.col("result")), *RESULT_CAP), "\n", "\n     "))
    line = (
        F.when(F.col("b.type") == "thinking", F.concat(F.lit("(thinking) "), truncate(F.nullif(_strip(F.col("b.thinking")), F.lit("")), *THINKING_CAP)))
        .when(F.col("b.type") == "text", truncate(F.nullif(_strip(F.col("b.text")), F.lit("")), *TEXT_CAP))
        .when(F.col("b.type") == "tool_use", F.concat(tool_line(F.col("b.name"), F.col("b.input")), F.coalesce(F.when(F.col("result") != "", indented), F.lit(""))))
    )
    said = said.withColumn("line", line).where("line is not null").groupBy("session_id", "turn").agg(F.max("segment").alias("segment"), F.array_sort(F.collect_list(F.struct("rank", "n", "line"))).alias("lines"))
    said = said.select("session_id", "turn", "segment", F.lit("assistant").alias("kind"), _strip(F.array_join("lines.line", "\n")).alias("body"))
    only_results = F.coalesce((F.size("blocks") > 0) & F.forall("blocks", lambda b: F.coalesce(b["type"] == "tool_result", F.lit(False))), F.lit(False))
    texts = F.array_join(F.transform(F.filter("blocks", lambda b: b["type"] == "text"), lambda b: F.coalesce(b["text"], F.lit(""))), "\n")
    asked = rows.where((F.col("type") == "user") & ~F.coalesce("isMeta", F.lit(False)) & ~only_results)
    asked = asked.select("session_id", "turn", "segment", F.lit("user").alias("kind"), truncate(_strip(texts), *TEXT_CAP).alias("body"))
    cut = rows.where(compact).select("session_id", "turn", "segment", F.lit("compact").alias("kind"), F.concat(F.lit("context compacted ("), F.coalesce("compactMetadata.trigger", F.lit("?")), F.lit(", "), F.coalesce(F.col("compactMetadata.preTokens").cast("string"), F.lit("?")), F.lit(" pre-tokens)")).alias("body"))
    turns = said.union(asked).union(cut).where("body <> ''")
    sep = F.when(F.col("kind") == "compact", " ").otherwise("\n")
    turns = turns.withColumn("body", F.concat(F.lit("["), "kind", F.lit("]"), sep, "body"))
    whole = turns.groupBy("session_id").agg(F.array_sort(F.collect_list(F.struct("turn", "kind", "segment", "body"))).alias("t"))
    spans = F.zip_with("t", laid_out(F.col("t.body")), lambda t, s: F.struct(t["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), t["segment"].cast("int").alias("segment"), s["index"].alias("index")))
    return whole.select("session_id", F.array_join("t.body", "\n\n").alias("text"), spans.alias("turns"))


def write_lines(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, low, high, path): where a rendered text says that a tool wrote a file, in bytes; shortened lines are left out."""
    from marl.operators.rendering import numbered_lines

    lines = numbered_lines(texts, [key], F.col(text), F.lit(0))
    pattern = f"^→ ({'|'.join(WRITERS)}): (.*)$"
    tool, arg = F.regexp_extract("text", pattern, 1), _strip(F.regexp_extract("text", pattern, 2))
    path = F.when(tool == "NotebookEdit", F.get_json_object(arg, "$.notebook_path")).otherwise(arg)
    return lines.where(tool != "").where(~F.contains(F.col("text"), F.lit("…["))).select(key, F.col("byte_start").alias("low"), F.col("byte_end").alias("high"), path.alias("path")).where("path <> ''")


def subjects(spans: DataFrame, writes: DataFrame, key: str, window: int = 4000) -> DataFrame:
    """`spans` (id, key, byte_start, byte_end) with `files`: those written within `window` bytes, else all that its source wrote, sorted."""
    from marl.operators.matching import overlapping

    wide = spans.select("id", key, (F.col("byte_start") - window).alias("start"), (F.col("byte_end") + window).alias("end"))
    near = overlapping(wide, writes, [key], 4 * window).groupBy("id").agg(F.array_sort(F.collect_set("path")).alias("near"))
    union = writes.groupBy(key).agg(F.array_sort(F.collect_set("path")).alias("union"))
    return spans.join(near, "id", "left").join(union, key, "left").withColumn("files", F.coalesce("near", "union", F.array().cast("array<string>"))).drop("near", "union")
