"""Turns, windows and lines: how text is laid out and pointed into."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from marl.functions.text import strip_region, valid_span

BUDGET = 12_000
START, END = "<!-- generated START", "<!-- generated END -->"


@pandas_udf(ArrayType(LongType()))
def starts_of(sizes: pd.Series, joint: pd.Series) -> pd.Series:
    """Where each part begins, given the sizes of parts that are joined by `joint`; linear in their number."""
    return pd.Series([None if s is None else np.cumsum([0, *(np.asarray(s, np.int64) + j)])[:-1] for s, j in zip(sizes, joint)])


def laid_out(parts: Column, joint: int = 2) -> Column:
    """array<struct<start, end, index>> of character places of parts that are joined by `joint` characters. Only sizes go through Python."""
    starts = starts_of(F.transform(parts, lambda p: F.length(p)), F.lit(joint))
    place = lambda s, i: F.struct(s.cast("int").alias("start"), (s + F.length(F.get(parts, i))).cast("int").alias("end"), i.cast("int").alias("index"))
    return F.transform(starts, place)


def document_turns(df: DataFrame, key: str, text: str, title: str) -> DataFrame:
    """(key, text, turns) of prose documents: a header turn, then the paragraphs of the text without its generated regions.

    Joining the turns by blank lines gives the text back. A null text counts as empty, a null title leaves the header bare.
    """
    body = strip_region(F.coalesce(F.col(text), F.lit("")), START, END)
    head = F.concat_ws(" ", F.lit("[document]"), F.nullif(F.col(title), F.lit("")))
    parts = F.concat(F.array(head), F.split(body, "\n\n", -1))
    return df.select(key, parts.alias("_parts")).select(key, F.array_join("_parts", "\n\n").alias("text"), laid_out(F.col("_parts")).alias("turns"))


def windows_of(turns: list[tuple[int | None, int]], budget: int) -> list[tuple[int, int]]:
    """(first, count) of windows over (segment, size) of turns: one ends before a turn of another segment, of none, or without room."""
    out, used, last = [], 0, object()
    for i, (segment, size) in enumerate(turns):
        if out and segment is not None and segment == last and used + size <= budget:
            out[-1][1] += 1
            used += size
        else:
            out.append([i, 1])
            used = size
        last = segment
    return [(a, n) for a, n in out]


@pandas_udf(ArrayType(StructType([StructField("first", IntegerType()), StructField("n", IntegerType())])))
def _windows(turns: pd.Series, budget: pd.Series) -> pd.Series:
    of = lambda t: [{"first": a, "n": n} for a, n in windows_of([(x["segment"], x["size"]) for x in t], b)]
    out = []
    for t, b in zip(turns, budget):
        out.append(None if t is None else of(t))
    return pd.Series(out)


def packed(turns: Column, budget: int = BUDGET) -> Column:
    """array<struct<turn_start, turn_end, char_start, char_end, segment, kinds>> of ordered turns in windows of `budget` characters.

    A window ends before a turn of another segment and before one that it has no room for; a turn above the budget
    stands alone. Each turn counts two characters more than it has. Only sizes and segments go through Python.
    """
    sized = F.transform(turns, lambda t: F.struct(t["segment"].cast("int").alias("segment"), (t["end"] - t["start"] + 2).cast("int").alias("size")))

    def window(w: Column) -> Column:
        first, last = F.get(turns, w["first"]), F.get(turns, w["first"] + w["n"] - 1)
        kinds = F.array_sort(F.array_distinct(F.transform(F.slice(turns, w["first"] + 1, w["n"]), lambda t: t["kind"])))
        return F.struct(first["index"].alias("turn_start"), last["index"].alias("turn_end"), first["start"].alias("char_start"), last["end"].alias("char_end"), first["segment"].alias("segment"), kinds.alias("kinds"))

    return F.transform(_windows(sized, F.lit(budget)), window)


def numbered_lines(df: DataFrame, keys: list[str], data: Column, start: Column) -> DataFrame:
    """(keys, line, byte_start, byte_end, text): the lines of a piece of a blob, from 1, with their byte places in the blob.

    `data` is the piece as text and `start` its byte place. A line's end leaves out its line feed.
    """
    lines = df.select(*keys, start.cast("bigint").alias("_at"), F.split(data, "\n", -1).alias("_lines"))
    lines = lines.withColumn("_starts", starts_of(F.transform("_lines", lambda p: F.octet_length(p)), F.lit(1)))
    each = lines.select(*keys, "_at", F.posexplode(F.arrays_zip("_lines", "_starts")).alias("n", "s"))
    low = F.col("_at") + F.col("s._starts")
    return each.select(*keys, (F.col("n") + 1).alias("line"), low.alias("byte_start"), (low + F.octet_length("s._lines")).alias("byte_end"), F.col("s._lines").alias("text"))


def resolve_lines(first: Column, last: Column, spans: Column) -> Column:
    """The byte span that lines `first` to `last` of `spans` cover: swapped if reversed, kept within the lines there are; null without lines or numbers."""
    n = F.size(spans)
    lo, hi = F.least(first, F.coalesce(last, first)), F.greatest(first, F.coalesce(last, first))
    inside = lambda x: F.greatest(F.lit(1), F.least(x, n)).cast("int")
    span = F.struct(F.element_at(spans, inside(lo))["byte_start"].alias("byte_start"), F.element_at(spans, inside(hi))["byte_end"].alias("byte_end"))
    return F.when((n > 0) & first.isNotNull() & (span["byte_end"] > span["byte_start"]), span)


def anchored(chunks: DataFrame, blobs: DataFrame) -> DataFrame:
    """`chunks` with `quote`, the text of the bytes they point to; rows whose blob is missing, whose places do not hold, or that split a character or are blank, are left out. Blobs are one row a hash; n_bytes is that of the text."""
    whole = blobs.groupBy("cleaned_hash").agg(F.first("text").alias("_text"))
    both = chunks.join(whole, "cleaned_hash").where(valid_span(F.col("byte_start"), F.col("byte_end"), F.octet_length("_text")))
    data = F.encode("_text", "UTF-8")
    part = F.expr("substring(_data, cast(byte_start + 1 as int), cast(byte_end - byte_start as int))")
    out = both.withColumn("_data", data).withColumn("_part", part).where(F.is_valid_utf8("_part")).withColumn("quote", F.col("_part").cast("string"))
    return out.where(~F.col("quote").rlike(r"(?U)^\s*$")).drop("_text", "_data", "_part")
