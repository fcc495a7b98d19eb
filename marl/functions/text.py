"""Text functions as native column expressions; Arrow functions only where no built-in says it."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

# Fixed values of statement signatures and decision bands.
SHINGLE_K = 4
H_MIN, J_MAYBE, J_HIGH, J_CROSS = 3.0, 0.12, 0.55, 0.70
# Fixed values of rendering: what is kept of a long part, and the slack below which nothing is cut.
TEXT_CAP, THINKING_CAP, RESULT_CAP, TOOL_LINE_CAP, SLACK = (4000, 1000), (2000, 400), (1000, 300), 280, 40
# The words that speak of failure, and those a redirecting user turn holds.
FAILURE_CUES = ["[error]", "traceback (most recent call last)", "assertionerror", "exception:", "npm err!", " failed", "exit code 1", "exited 1", "fatal:", "panic:", "fail:"]
REDIRECT_CUES = ["actually", "no,", "no ", "don't", "do not", "instead", "wait", "stop", "not ", "wrong", "revert", "undo", "rather", "that's wrong", "i said"]


def normalize(text: Column) -> Column:
    """Lower case, every run of other characters than letters and digits one space, ends trimmed; null stays null.

    Lower-casing stands in for case folding; `fold` is exact where the two differ."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def normal_form(text: str) -> str:
    """The exact form: case-folded, runs of characters that are not alphanumeric one space, ends trimmed."""
    return " ".join("".join(c if c.isalnum() else " " for c in text.casefold()).split())


@pandas_udf(StringType())
def fold(text: pd.Series) -> pd.Series:
    """The exact form of a column; null stays null."""
    return text.map(normal_form, na_action="ignore")


def shingles(form: Column, k: int = SHINGLE_K) -> Column:
    """Distinct substrings of `k` characters of a form, the whole form if shorter, none if empty; null for null. Linear in the form: it is split into characters once."""
    every = lambda chars: F.transform(F.sequence(F.lit(0), F.size(chars) - k), lambda i: F.concat(*[F.get(chars, i + j) for j in range(k)]))
    grams = F.array_distinct(F.flatten(F.transform(F.array(F.split(form, "")), every)))
    return F.when(F.length(form) == 0, F.array().cast("array<string>")).when(F.length(form) < k, F.array(form)).otherwise(grams)


def jaccard(a: Column, b: Column) -> Column:
    """Shared members over all members of two arrays without repeats; 0 if either is empty or null."""
    both = F.size(F.array_intersect(a, b))
    return F.coalesce(F.when((F.size(a) > 0) & (F.size(b) > 0), both / (F.size(a) + F.size(b) - both)), F.lit(0.0))


@pandas_udf(DoubleType())
def character_entropy(form: pd.Series) -> pd.Series:
    """Shannon entropy in bits of the characters of a form; 0 for an empty form, null for null. All texts of a batch are counted in one sort."""
    known = form.notna().to_numpy()
    out = np.full(len(form), np.nan)
    texts = form[known].tolist()
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    cells, counts = np.unique(np.repeat(np.arange(len(texts)), lengths) << 21 | codes, return_counts=True)
    owner = cells >> 21
    share = counts / lengths[owner] if len(owner) else np.zeros(0)
    out[known] = np.bincount(owner, weights=-share * np.log2(share), minlength=len(texts)) if len(owner) else 0.0
    return pd.Series(out).astype("Float64").where(pd.Series(known), None)


def entropy(form: Column) -> Column:
    """As `character_entropy`, by name of what it measures."""
    return character_entropy(form)


def band(sim: Column) -> Column:
    """cross, high, residue or non, by the thresholds of the similarity alone."""
    return F.when(sim >= J_CROSS, "cross").when(sim >= J_HIGH, "high").when(sim >= J_MAYBE, "residue").otherwise("non")


def verdict(sim: Column, subject: Column) -> Column:
    """Match class of a pair: the bar is J_HIGH where the subjects overlap and J_CROSS where not."""
    bar = F.when(subject > 0, J_HIGH).otherwise(J_CROSS)
    return F.when(sim >= bar, F.when(subject > 0, "match").otherwise("match-cross")).when(sim >= J_MAYBE, "possible").otherwise("non-match")


def _hash64(shingle: str) -> int:
    return int.from_bytes(hashlib.blake2b(shingle.encode(), digest_size=8).digest(), "big")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def signature(text: str) -> tuple[str, list[int], int, float, list[int]]:
    """(form, sorted shingle hashes, simhash, entropy, bands) of a statement; 64-bit values in two's complement."""
    form = normal_form(text)
    grams = {form[i : i + SHINGLE_K] for i in range(max(1, len(form) - SHINGLE_K + 1))} if form else set()
    hashes = sorted(map(_hash64, grams))
    sim = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    n = len(form)
    bits = -sum(c / n * math.log2(c / n) for c in Counter(form).values()) if n else 0.0
    return form, [_signed(h) for h in hashes], _signed(sim), bits, [sim >> s & 0xFFFF for s in (48, 32, 16, 0)]


_SIGNATURE = StructType([StructField("normalized", StringType()), StructField("shingles", ArrayType(LongType())), StructField("simhash", LongType()), StructField("entropy", DoubleType()), StructField("lsh_bands", ArrayType(IntegerType()))])


@pandas_udf(_SIGNATURE)
def statement_signature(text: pd.Series) -> pd.DataFrame:
    """The persisted signature of a statement; every field null for a null text."""
    rows = [signature(t) if t is not None else (None,) * 5 for t in text]
    return pd.DataFrame(rows, columns=_SIGNATURE.names)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def lsh_bands(simhash: Column) -> Column:
    """The four 16-bit parts of a simhash, highest first."""
    return F.array(*[F.shiftrightunsigned(simhash, s).bitwiseAND(65535).cast("int") for s in (48, 32, 16, 0)])


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def short_id(length: int, *parts: Column) -> Column:
    """The first `length` hex digits of the hash of parts joined by colons; a null part gives null."""
    joined = parts[0].cast("string")
    for p in parts[1:]:
        joined = F.concat(joined, F.lit(":"), p.cast("string"))
    return F.substring(F.sha2(joined, 256), 1, length)


def truncate(text: Column, head: int, tail: int = 0) -> Column:
    """Head and tail of a text that is longer than both and the slack, with a mark that counts what was cut."""
    mark = F.concat(F.lit(" …["), (F.length(text) - head - tail).cast("string"), F.lit(" chars elided]…"))
    cut = F.concat(F.substring(text, 1, head), mark)
    if tail:
        cut = F.concat(cut, F.lit(" "), F.right(text, F.lit(tail)))
    return F.when(F.length(text) <= head + tail + SLACK, text).otherwise(cut)


def strip_region(text: Column, start: str, end: str) -> Column:
    """A text without its marked regions; one that is not closed reaches to the end."""
    quoted = lambda s: r"\Q" + s + r"\E"
    return F.regexp_replace(text, f"(?s){quoted(start)}.*?(?:{quoted(end)}|\\z)", "")


def slugify(text: Column, longest: int = 40) -> Column:
    """Lower-case letters and digits joined by hyphens, `longest` characters at most, no hyphen at an end."""
    dashed = F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), F.lit("-"))
    return F.trim(F.substring(dashed, 1, longest), F.lit("-"))


def clip(text: Column, limit: int = 280) -> Column:
    """A prose of `limit` characters at most: up to its last sentence end in the second half, else to its last word there, and an ellipsis."""
    prose = F.regexp_replace(text, r"^\s+|\s+$", "")
    head = F.substring(prose, 1, limit)
    sentence, words = F.regexp_extract(head, r"(?s)^(.*[.!?]) ", 1), F.regexp_extract(head, "(?s)^(.*) ", 1)
    cut = F.when(F.length(words) >= limit // 2, words).otherwise(F.substring(head, 1, limit - 1))
    return F.when(F.length(prose) <= limit, prose).when(F.length(sentence) > limit // 2, sentence).otherwise(F.concat(F.regexp_replace(cut, r"\s+$", ""), F.lit("…")))


def clean_score(value: Column, default: float = 0.0) -> Column:
    """A number in [0, 1] of whatever a model returned: unreadable, NaN and infinite values give `default`."""
    x = value.try_cast("double")
    good = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.when(good, F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))).otherwise(F.lit(default))


def valid_span(start: Column, end: Column, n_bytes: Column) -> Column:
    """Whether 0 <= start < end <= n_bytes; false where any is null."""
    return F.coalesce((start >= 0) & (start < end) & (end <= n_bytes), F.lit(False))


def span_text(data: Column, start: Column, end: Column) -> Column:
    """The text of a byte span, null where it is no valid UTF-8 or blank; `data` is binary."""
    part = F.substr(data, (start + 1).cast("int"), (end - start).cast("int"))
    text = F.when(F.is_valid_utf8(part), part.cast("string"))
    return F.when(F.trim(text) != "", text)


def context(data: Column, start: Column, end: Column, width: int = 160) -> Column:
    """The text of a span and `width` bytes on both sides of it; characters cut at the ends are replaced."""
    low = F.greatest(start - width, F.lit(0))
    part = F.substr(data, (low + 1).cast("int"), (end + width - low).cast("int"))
    return F.make_valid_utf8(part.cast("string"))


def in_source(handle: Column, focus: str) -> Column:
    """Whether a handle holds `focus`, case apart; an unknown handle does not."""
    return F.coalesce(F.contains(F.lower(handle), F.lit(focus.lower())), F.lit(False))


def quarantined(handle: Column, parts: list[str]) -> Column:
    """Whether a handle holds one of `parts`; an unknown handle does not, and so is kept."""
    out = F.lit(False)
    for p in parts:
        out = out | in_source(handle, p)
    return out


def byte_offset(text: Column, chars: Column) -> Column:
    """The byte place of a character place in the UTF-8 form of a text."""
    return F.octet_length(F.substr(text, F.lit(1), chars)).cast("bigint")


def thin_quote(quote: Column, least: int = 40) -> Column:
    """Whether a quote is missing, shorter than `least` characters, or of too low an entropy to stand as evidence."""
    low = (F.length(F.trim(quote)) < least) | (entropy(normalize(quote)) < H_MIN)
    return F.coalesce(low, F.lit(True))


def has_signal(text: Column, mode: Column, least: int = 80) -> Column:
    """Whether a chunk can hold a lesson: long enough, and with a speaker in it unless it is prose."""
    return F.coalesce((F.length(text) >= least) & ((mode != "transcript") | text.contains("[user]") | text.contains("[assistant]")), F.lit(False))


def cues(text: Column) -> Column:
    """Names of the structural cues of a chunk: `failure` and `redirect`."""
    low = F.lower(text)
    failed = F.exists(F.array(*map(F.lit, FAILURE_CUES)), lambda c: F.contains(low, c))
    turns = F.slice(F.split(low, r"\[user\]"), 2, 1_000_000)
    said = F.transform(turns, lambda t: F.trim(F.regexp_replace(F.split(t, r"\[assistant\]")[0], r"^\s+|\s+$", "")))
    turned = F.exists(said, lambda s: (F.length(s) > 0) & (F.length(s) < 240) & F.exists(F.array(*map(F.lit, REDIRECT_CUES)), lambda c: F.contains(s, c)))
    return F.array_compact(F.array(F.when(failed, "failure"), F.when(turned, "redirect")))


def json_object(text: Column) -> Column:
    """The outermost JSON object in a model's answer as a variant, fence or not; null where there is none."""
    return F.try_parse_json(F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit("")))


def terms(text: Column) -> Column:
    """Words of three characters or more for term weights; paths and identifiers stay whole."""
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9$_./-]+"), 0), lambda w: F.length(w) > 2)
