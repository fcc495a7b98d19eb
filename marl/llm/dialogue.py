"""Conversations rebuilt from message rows.

Rows become records in plain columns (one shuffle by record), and what a walk needs of each, without its content, is
partitioned by session and sorted by place. A task streams its sessions one after another: it follows the links back
from the last record and runs the spoken records of the path through a finite-state automaton.

A session larger than WIDE records is not walked in one task. Its links are doubled instead (join after join over all
records, each link twice as long as before), which ranks the records of the path in a number of joins that grows with
the logarithm of the session, and the automaton runs as running totals over stretches of the session.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marl.operators.ordered import running_total, with_last
from marl.plans.scratch import drop, keep
from marl.plans.streams import groups

#: Records of a session that one task walks, at about 40 bytes each.
WIDE = 1_000_000
SPEAKS, PROMPT, ANSWER, TIP, BRIDGE = 1, 2, 4, 8, 16
#: Places of a session that one task puts in order where sessions are too large for one task.
STRETCH = 100_000
_BLANK = r"(?U)^\s*$"


def _flags() -> Column:
    content, kind = F.col("message.content"), F.col("type")
    turn = kind.isin("user", "assistant")
    said = content.isNotNull() & ~content.rlike(_BLANK) & (F.trim(content) != "[]")
    speaks = turn & said & ~F.coalesce(F.col("isMeta"), F.lit(False))
    blocks = F.when(content.contains("tool_result"), F.from_json(content, "array<struct<type:string>>"))
    result = F.coalesce(F.exists(blocks, lambda b: F.coalesce(b["type"] == "tool_result", F.lit(False))), F.lit(False))
    bit = lambda condition, value: F.when(condition, value).otherwise(0)
    return bit(speaks, SPEAKS) + bit(speaks & (kind == "user") & ~result, PROMPT) + bit(speaks & (kind == "assistant"), ANSWER) + bit(turn, TIP) + bit(F.col("subtype") == "compact_boundary", BRIDGE)


def records(transcript: DataFrame) -> DataFrame:
    """(session_id, uuid, pos, flags, side, ref): one row a record, at its lowest place."""
    rows = transcript.where("session_id is not null and uuid is not null and pos is not null")
    row = F.struct("pos", _flags().cast("int").alias("flags"), F.coalesce("isSidechain", F.lit(False)).alias("side"), F.coalesce("parentUuid", "logicalParentUuid").alias("ref"))
    return rows.select("session_id", "uuid", row.alias("r")).groupBy("session_id", "uuid").agg(F.min("r").alias("r")).select("session_id", "uuid", "r.*").where("not side").drop("side")


def walk(pos: np.ndarray, flags: np.ndarray, own: np.ndarray, ref: np.ndarray, has_ref: np.ndarray) -> list[int]:
    """Spoken records, as indices and oldest first, of a session in order of place; none if it is dropped.

    `own` and `ref` are numbers of uuids.
    """
    turns = np.flatnonzero(flags & TIP)
    if not len(turns):
        return []
    order = np.argsort(own, kind="stable")
    at = np.minimum(np.searchsorted(own, ref, sorter=order), len(own) - 1)
    target = np.where(has_ref, np.where(own[order[at]] == ref, order[at], -2), -1)
    path, seen, i = [], bytearray(len(pos)), int(turns[-1])
    while i >= 0:
        if seen[i]:
            return []
        seen[i] = 1
        path.append(i)
        to = int(target[i])
        if to == -2:
            if not flags[i] & BRIDGE:
                return []
            before = np.searchsorted(pos[turns], pos[i], "left") - 1
            to = int(turns[before]) if before >= 0 else -1
        i = to
    spoken = [i for i in reversed(path) if flags[i] & SPEAKS]
    return spoken if sound(flags[spoken]) else []


def sound(flags) -> bool:
    """The automaton: nothing said yet, waiting for a reply, replied. A prompt while waiting, and an end while waiting or before any prompt, is unsound."""
    state = "start"
    for f in flags:
        if f & PROMPT:
            if state == "waiting":
                return False
            state = "waiting"
        elif f & ANSWER and state == "waiting":
            state = "replied"
    return state == "replied"


def _walked(rows: DataFrame) -> DataFrame:
    """(session_id, turn_no, uuid) of sessions that one task can hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("session_id", pa.string()), ("turn_no", pa.int32()), ("uuid", pa.string())])
        out: list[tuple[str, list[str]]] = []
        count = 0

        def flush() -> pa.RecordBatch:
            names = [s for s, u in out for _ in u]
            numbers = [i for _, u in out for i in range(1, len(u) + 1)]
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(numbers, pa.int32()), pa.array([x for _, u in out for x in u], pa.string())], schema=schema)

        for table in groups(batches):
            of = lambda c: table.column(c).to_numpy()
            spoken = walk(of("pos"), of("flags"), of("own"), of("target"), of("has_ref"))
            if spoken:
                out.append((table.column("session_id")[0].as_py(), table.column("uuid").take(pa.array(spoken)).to_pylist()))
                count += len(spoken)
            if count > 20_000:
                yield flush()
                out, count = [], 0
        yield flush()

    slim = rows.select("session_id", "uuid", "pos", "flags", F.xxhash64("uuid").alias("own"), F.coalesce(F.xxhash64("ref"), F.lit(0)).alias("target"), F.col("ref").isNotNull().alias("has_ref"))
    return slim.repartition("session_id").sortWithinPartitions("session_id", "pos", "uuid").mapInArrow(run, "session_id string, turn_no int, uuid string")


def _doubled(rows: DataFrame) -> DataFrame:
    """(session_id, turn_no, uuid) of sessions too large for one task."""
    place = F.struct("pos", "uuid")
    here = keep(rows.withColumn("place", place), "wide")
    known = here.select("session_id", F.col("uuid").alias("ref"), F.col("uuid").alias("to"))
    linked = here.join(known, ["session_id", "ref"], "left")
    lost = linked.where(F.col("ref").isNotNull() & F.col("to").isNull() & (F.col("flags").bitwiseAND(BRIDGE) != 0))
    # The last turn of a lower place than each lost boundary, by neighbours: turns and lost boundaries are in line, cut by their place.
    turns = here.where(F.col("flags").bitwiseAND(TIP) != 0).select("session_id", "uuid", "pos", F.lit(1).alias("side"), F.col("uuid").alias("turn"))
    line = lost.select("session_id", "uuid", "pos", F.lit(0).alias("side"), F.lit(None).cast("string").alias("turn")).union(turns).withColumn("stretch", F.expr(f"pos div {STRETCH}"))
    bridged = with_last(line, ["session_id"], F.struct("pos", "side", "uuid"), "stretch", F.col("turn"), "bridge").where("side = 0 and bridge is not null").select("session_id", "uuid", "bridge")
    linked = linked.join(bridged, ["session_id", "uuid"], "left")
    stuck = F.col("ref").isNotNull() & F.col("to").isNull() & (F.col("flags").bitwiseAND(BRIDGE) == 0)
    base = linked.select("session_id", "uuid", "flags", F.coalesce("to", "bridge").alias("next"), stuck.alias("stuck"))
    most = rows.groupBy("session_id").agg(F.count("*").alias("c")).agg(F.max("c")).first()[0] or 0
    jumps = [keep(base.select("session_id", "uuid", "next").where("next is not null"), "jump")]
    while 2 ** len(jumps) <= most:
        j = jumps[-1]
        jumps.append(keep(j.join(j.select("session_id", F.col("uuid").alias("next"), F.col("next").alias("then")), ["session_id", "next"]).select("session_id", "uuid", F.col("then").alias("next")), "jump"))
    tips = here.where(F.col("flags").bitwiseAND(TIP) != 0).groupBy("session_id").agg(F.max("place")["uuid"].alias("uuid"))
    path = tips.withColumn("rank", F.lit(0).cast("bigint"))
    # A path as long as a session has records comes back to one of them.
    for k in reversed(range(len(jumps))):
        far = path.join(jumps[k], ["session_id", "uuid"]).select("session_id", F.col("next").alias("uuid"), (F.col("rank") + 2**k).alias("rank"))
        path = keep(path.union(far), "path")
    sizes = rows.groupBy("session_id").agg(F.count("*").alias("records"))
    full = path.join(base, ["session_id", "uuid"]).join(sizes, "session_id")
    broken = full.groupBy("session_id").agg((F.max("stuck") | (F.max("rank") >= F.max("records"))).alias("broken")).where("broken").select("session_id")
    spoken = full.where(F.col("flags").bitwiseAND(SPEAKS) != 0).join(broken, "session_id", "left_anti")
    marked = spoken.withColumn("prompt", F.col("flags").bitwiseAND(PROMPT) != 0).withColumn("answer", F.col("flags").bitwiseAND(ANSWER) != 0)
    marked = marked.withColumn("place", -F.col("rank")).withColumn("stretch", F.expr(f"-(rank div {STRETCH})"))
    marked = running_total(marked, ["session_id"], F.col("place"), "stretch", F.lit(1), "turn_no").withColumn("turn_no", F.col("turn_no").cast("int"))
    marked = running_total(marked, ["session_id"], F.col("place"), "stretch", F.col("prompt").cast("int"), "asked")
    exchanges = marked.groupBy("session_id", "asked").agg(F.max("answer").alias("answered")).where("asked > 0")
    good = exchanges.groupBy("session_id").agg(F.min("answered").alias("good")).where("good").select("session_id")
    return marked.join(good, "session_id", "left_semi").select("session_id", "turn_no", "uuid")


def conversations(transcript: DataFrame, wide: int = WIDE) -> DataFrame:
    """(session_id, turn_no, uuid): the spoken records, oldest first, of every sound session.

    Rows with a null session, uuid or place are ignored, rows of one uuid are one record at their lowest place, sidechain
    records are left out; null flags mean no. A session is dropped when its path meets a record twice or a link leads
    out of the session other than at a compact boundary, when it has no prompt, or when a prompt has no reply. Records of
    one place are ordered by uuid. An empty table gives no rows; other columns are ignored.
    """
    rows = keep(records(transcript), "records")
    large = rows.groupBy("session_id").agg(F.count("*").alias("c")).where(F.col("c") > wide).select("session_id")
    if large.isEmpty():
        out = keep(_walked(rows), "turns")
    else:
        large = keep(large, "large")
        small = rows.join(F.broadcast(large) if large.count() <= 10_000 else large, "session_id", "left_anti")
        out = keep(_walked(small).union(_doubled(rows.join(large, "session_id", "left_semi"))), "turns")
    drop(rows)
    return out
