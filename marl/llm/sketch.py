"""Statement forms, their pieces, minwise band keys and parity bitmaps of them.

The normalised form of a text is its case-folded text with every run of characters that are neither letter nor digit
turned into one space. Its pieces are the distinct substrings of four characters (the whole form where it is shorter),
and `stmt_sim` of two texts is the Jaccard similarity of their pieces.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

PIECE = 4
SIM_MIN = 0.55
ENTROPY_MIN = 3.0
#: A band is ROWS minwise values. At a similarity of 0.55 one of BANDS bands agrees with a probability of 0.9995, at 0.6
#: of 0.99998; unrelated statements (0.04 on average) meet in one pair of 5,000.
ROWS, BANDS = 4, 80
#: Bits of a parity bitmap. Two sets that differ in d pieces have bitmaps that differ in d bits at most.
BITS = 512
#: Cells of the (pieces x functions) matrix worked on at once, so that a text of any length needs constant memory.
_BLOCK = 4096
_RUN = re.compile(r"[\W_]+")
_PAD = chr(0x10FFFF)


def normal_form(text: str) -> str:
    return _RUN.sub(" ", text.casefold()).strip()


def pieces(form: str) -> set[str]:
    if len(form) < PIECE:
        return {form} if form else set()
    return {form[i : i + PIECE] for i in range(len(form) - PIECE + 1)}


def entropy(form: str) -> float:
    """Shannon entropy, in bits, of the characters of a form; 0 for an empty one."""
    n = len(form)
    return -sum(c / n * math.log2(c / n) for c in Counter(form).values()) if n else 0.0


def stmt_sim(a: str, b: str) -> float:
    """Similarity of two forms; 0 where either is empty."""
    p, q = pieces(a), pieces(b)
    both = len(p & q)
    return both / (len(p) + len(q) - both) if both else 0.0


def forms(df: DataFrame, text: str, entropy_min: float = ENTROPY_MIN) -> DataFrame:
    """`df` without its column `text` and with `form`, rows with a null text or a form of low entropy left out."""
    kept = [f for f in df.schema.fields if f.name != text]
    names = [f.name for f in kept]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", form string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            form = batch[text].map(normal_form)
            good = form.map(entropy) >= entropy_min
            out = batch.loc[good, names]
            out["form"] = form[good]
            yield out

    return df.where(F.col(text).isNotNull()).mapInPandas(run, schema)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_RNG = np.random.default_rng(20)
_CHAR = _RNG.integers(0, 2**63, PIECE, dtype=np.uint64) | np.uint64(1)
_FLIP = _RNG.integers(0, 2**32, ROWS * BANDS, dtype=np.uint32)
_TIMES = _RNG.integers(0, 2**32, ROWS * BANDS, dtype=np.uint32) | np.uint32(1)
_JOIN = _RNG.integers(0, 2**63, ROWS, dtype=np.uint64) | np.uint64(1)
_SALT = _mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def piece_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all pieces of all texts, repeats included, and for each the number of its text."""
    padded = [t + _PAD * (PIECE - len(t)) if len(t) < PIECE else t for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, padded), np.int64, len(padded))
    h = sum(codes[i : len(codes) - PIECE + 1 + i] * _CHAR[i] for i in range(PIECE))
    owner = np.repeat(np.arange(len(padded)), lengths)
    inside = owner[: len(h)] == owner[PIECE - 1 :]
    return _mix(h[inside]), owner[: len(h)][inside]


def minwise(texts: list[str], functions: int = ROWS * BANDS) -> np.ndarray:
    """Minwise values, texts x functions."""
    h, owner = piece_hashes(texts)
    low = np.full((len(texts), functions), np.iinfo(np.uint32).max, np.uint32)
    short = (h >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(h), _BLOCK):
        part, own = short[start : start + _BLOCK], owner[start : start + _BLOCK]
        heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        values = part[:, None] ^ _FLIP[:functions]
        values *= _TIMES[:functions]
        at = own[heads]
        low[at] = np.minimum(low[at], np.minimum.reduceat(values, heads, axis=0))
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    bands = low.shape[1] // ROWS
    rows = low.reshape(len(low), bands, ROWS).astype(np.uint64)
    return _mix((rows * _JOIN).sum(axis=2, dtype=np.uint64) + _SALT[:bands]).view(np.int64)


WORDS = [f"w{i}" for i in range(BITS // 64)]


def distinct_pieces(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, owners, sizes) of the distinct pieces of each text, sorted by owner and hash."""
    h, owner = piece_hashes(texts)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    if len(h):
        new = np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])]
        h, owner = h[new], owner[new]
    return h, owner, np.bincount(owner, minlength=len(texts))


def bitmaps(h: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """Parity bitmaps (texts x words): each piece flips the bit that its hash names."""
    bits = np.zeros((count, len(WORDS)), np.uint64)
    place = h % np.uint64(BITS)
    np.bitwise_xor.at(bits, (owner, (place >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (place & np.uint64(63)))
    return bits


def folded(bits: np.ndarray) -> np.ndarray:
    """Bitmaps (words x texts) of half the bits, each the parity of two. They reject less, at half the cost, and lose nothing either."""
    half = len(bits) // 2
    return bits[:half] ^ bits[half:]


def room(sizes: np.ndarray, least: float) -> np.ndarray:
    """The largest number of pieces in which two sets of these sizes in all may differ at a similarity of `least`."""
    return np.floor((1 - least) / (1 + least) * sizes + 1e-9).astype(np.int64)


def banded(df: DataFrame, key: str = "rep", form: str = "form", bands: int = BANDS) -> DataFrame:
    """(`key`, bands): the first `bands` band keys of each row's form."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.iloc[at : at + 1000]
                yield pd.DataFrame({key: part[key].to_numpy(), "bands": list(band_keys(minwise(part[form].tolist(), bands * ROWS)))})

    return df.select(key, form).mapInPandas(run, f"{key} {kind}, bands array<bigint>")


def mapped(df: DataFrame, key: str = "rep", form: str = "form") -> DataFrame:
    """(`key`, n, words): the number of pieces of each row's form and its parity bitmap."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.iloc[at : at + 1000]
                h, owner, n = distinct_pieces(part[form].tolist())
                bits = bitmaps(h, owner, len(n)).view(np.int64)
                yield pd.DataFrame({key: part[key].to_numpy(), "n": n.astype(np.int32), **{w: bits[:, i] for i, w in enumerate(WORDS)}})

    return df.select(key, form).mapInPandas(run, f"{key} {kind}, n int, " + ", ".join(f"{w} bigint" for w in WORDS))


def leaves_room(a: str, b: str, least: float = SIM_MIN):
    """Whether the sizes and bitmaps in the columns `{a}n`, `{a}w0`.. and `{b}n`, `{b}w0`.. leave room for `least`; no pair that reaches it is rejected."""
    differ = sum(F.bit_count(F.col(f"{a}{w}").bitwiseXOR(F.col(f"{b}{w}"))) for w in WORDS)
    return differ <= F.floor((1 - least) / (1 + least) * (F.col(f"{a}n") + F.col(f"{b}n")) + 1e-9)


@pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([stmt_sim(x, y) for x, y in zip(a, b)], dtype="float64")
