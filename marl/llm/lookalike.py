"""One consistent form for texts that look the same and differ in their characters.

The form removes default-ignorable characters, turns every kind of blank into a space (tabs and line breaks stay),
decomposes compatibly, draws look-alike letters as their Latin twin and composes again. Full case folding is a
parameter: comparisons by look keep the case.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marl.plans.scratch import drop, keep

# Letters of other alphabets, and of extended Latin, and the Latin letters they are drawn like.
LOOKALIKES = {
    # Cyrillic, small
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "ү": "y",
    # Cyrillic, capital
    "А": "A", "В": "B", "С": "C", "Е": "E", "Ԍ": "G", "Н": "H", "І": "I", "Ӏ": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ԛ": "Q", "Ѕ": "S", "Т": "T", "Ѵ": "V", "Ԝ": "W", "Х": "X", "У": "Y", "Ү": "Y",
    # Greek, small
    "ο": "o", "α": "a", "ϳ": "j", "ϲ": "c", "ι": "i", "ν": "v", "ρ": "p", "υ": "u", "γ": "y",
    # Greek, capital
    "Α": "A", "Β": "B", "Ϲ": "C", "Ε": "E", "Η": "H", "Ι": "I", "Ϳ": "J", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ζ": "Z",
    # Armenian
    "օ": "o", "ս": "u", "հ": "h", "ո": "n", "ց": "g", "յ": "j", "Օ": "O", "Տ": "S", "Լ": "L",
    # Cherokee
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꭱ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
    # Coptic
    "Ⲃ": "B", "Ⲥ": "C", "ⲥ": "c", "Ⲏ": "H", "Ⲓ": "I", "Ⲕ": "K", "Ⲙ": "M", "Ⲛ": "N", "Ⲟ": "O", "ⲟ": "o", "Ⲣ": "P", "ⲣ": "p", "Ⲧ": "T", "Ⲩ": "Y", "Ⲭ": "X", "Ⲍ": "Z",
    # Lisu
    "ꓮ": "A", "ꓐ": "B", "ꓚ": "C", "ꓓ": "D", "ꓰ": "E", "ꓝ": "F", "ꓖ": "G", "ꓧ": "H", "ꓲ": "I", "ꓙ": "J", "ꓗ": "K", "ꓡ": "L", "ꓟ": "M", "ꓠ": "N", "ꓳ": "O", "ꓑ": "P", "ꓣ": "R", "ꓢ": "S", "ꓔ": "T", "ꓴ": "U", "ꓦ": "V", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓜ": "Z",
    # Latin letters outside the basic alphabet
    "ɑ": "a", "ɡ": "g",
}
# The code points that Unicode calls default-ignorable, as ranges, with the interlinear marks.
IGNORABLE = [(0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFFB), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF)]
# The blanks of Unicode's class of spaces, and the empty Braille cell.
BLANKS = [0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000, 0x2800]

_IGNORED = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in IGNORABLE) + "]")
_BLANK = {b: " " for b in BLANKS}
_DRAWN = str.maketrans(LOOKALIKES)


def consistent(text: str, fold: bool = False) -> str:
    """The consistent form of a text; with `fold` in full case folding too."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", _IGNORED.sub("", text).translate(_BLANK)).translate(_DRAWN)
        text = unicodedata.normalize("NFC", _IGNORED.sub("", text))
    return unicodedata.normalize("NFC", text.casefold()) if fold else text


def consistent_values(values: pd.Series, fold: bool = False) -> pd.Series:
    """Forms of a column, worked out once per distinct value; null stays null."""
    codes, distinct = pd.factorize(values)
    done = np.array([consistent(v, fold) for v in distinct] + [None], dtype=object)
    return pd.Series(done[codes], index=values.index)


def _hashes(values: list[str]) -> np.ndarray:
    return np.frombuffer(b"".join(hashlib.md5(v.encode()).digest() for v in values), np.int64).reshape(-1, 2)


def _marks(df: DataFrame, key: str, text: str) -> DataFrame:
    """(id, t1, t2, f1, f2): 128-bit hashes of the text and of the form of each row with something visible."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            forms = consistent_values(batch["text"])
            seen = forms.map(lambda f: bool(f.strip())).to_numpy(bool)
            ids, texts, forms = batch["id"].to_numpy()[seen], batch["text"][seen].tolist(), forms[seen].tolist()
            t, f = _hashes(texts), _hashes(forms)
            yield pd.DataFrame({"id": ids, "t1": t[:, 0], "t2": t[:, 1], "f1": f[:, 0], "f2": f[:, 1]})

    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
    return rows.mapInPandas(run, "id bigint, t1 bigint, t2 bigint, f1 bigint, f2 bigint")


def lookalike_classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(class_id, `key`, links): every row whose text has the form of another text, the least key of its class, and with how many rows
    of other texts it looks the same. Rows of a class cost one row each, however many there are."""
    marks = keep(_marks(df, key, text).distinct(), "marks")
    each = marks.groupBy("f1", "f2", "t1", "t2").agg(F.count("*").alias("copies"), F.min("id").alias("first"))
    whole = each.groupBy("f1", "f2").agg(F.sum("copies").alias("rows"), F.min("first").alias("class_id"), F.count("*").alias("texts")).where("texts > 1")
    counted = each.join(whole, ["f1", "f2"]).select("f1", "f2", "t1", "t2", "class_id", (F.col("rows") - F.col("copies")).alias("links"))
    out = keep(marks.join(counted, ["f1", "f2", "t1", "t2"]).select("class_id", F.col("id").alias(key), "links"), "classes")
    drop(marks)
    return out


def lookalike_pairs(df: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_a, doc_b), doc_a < doc_b: rows of `df` whose texts have one form and are not equal. All pairs of a class come out, as
    the statement of the problem asks; `lookalike_classes` has a row for each member instead.

    Null texts, and texts without a visible character, take no part; nor do rows with a null key. Equal texts are no
    pair, and a class of nothing but copies is dropped before any join, however large. Only 128-bit hashes of text and
    form are shuffled. An empty table gives no rows; other columns are ignored; a repeated row of one key counts once.
    """

    marks = keep(_marks(df, key, text), "marks")
    texts = marks.select("t1", "t2", "f1", "f2").distinct()
    several = texts.groupBy("f1", "f2").agg(F.count("*").alias("c")).where("c > 1").select("f1", "f2")
    texts = keep(texts.join(several, ["f1", "f2"]), "texts")
    side = lambda c: texts.select("f1", "f2", F.col("t1").alias(f"{c}1"), F.col("t2").alias(f"{c}2"))
    pairs = side("a").join(side("b"), ["f1", "f2"]).where("a1 < b1 or (a1 = b1 and a2 < b2)")
    ids = marks.select("t1", "t2", "id").distinct()
    named = lambda c: ids.select(F.col("t1").alias(f"{c}1"), F.col("t2").alias(f"{c}2"), F.col("id").alias(f"{c}_id"))
    out = pairs.join(named("a"), ["a1", "a2"]).join(named("b"), ["b1", "b2"]).where("a_id <> b_id")
    out = keep(out.select(F.least("a_id", "b_id").alias("doc_a"), F.greatest("a_id", "b_id").alias("doc_b")).distinct(), "lookalikes")
    drop(marks, texts)
    return out
