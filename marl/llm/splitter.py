"""Cutting oversized chunks into overlapping pieces at natural boundaries.

Chunks point into blobs by bytes. Blobs are cut into pages of fixed size first, and a chunk joins only the pages that
it touches: a large blob with many chunks costs its size once, and no key holds more than one page.

Two ways to choose a cut within the window (start + LEAST, start + LIMIT]:
`boundaries` takes the last place of the best kind (turn, blank line, line, sentence, space, character);
`cohesion` takes the deepest valley of the similarity of the words on either side of each place between words, its depth
measured from the peaks on both sides.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, LEAST, OVERLAP = 2000, 1000, 200
PAGE = 1 << 15
#: Words on either side of a place whose cohesion is measured.
SIDE = 20
# A character of a script that is written without spaces: kana, Han, Thai, Lao, Myanmar, Khmer; a word of any other.
_ALONE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_TOKEN = re.compile(f"[{_ALONE}]|(?:(?![{_ALONE}])[^\\W_])+")
_SINGLE = re.compile(f"[{_ALONE}]")
# What may come before a cut, best kinds first; the endings of one kind serve alike.
ENDINGS = [[b"\n\n"], [b"\n"], ["。".encode(), b". ", b"! ", b"? "], [b" "]]


def _start_at(data: bytes, place: int, step: int) -> int:
    """`place`, or the next character start from it in the direction of `step`."""
    while 0 < place < len(data) and data[place] & 0xC0 == 0x80:
        place += step
    return place


def cut_at_boundary(data: bytes, start: int, turns: np.ndarray, limit: int = LIMIT, least: int = LEAST) -> int:
    """The last place of the best kind in (start + least, start + limit]."""
    low, high = start + least, start + limit
    i = np.searchsorted(turns, high, "right") - 1
    if i >= 0 and turns[i] > low:
        return int(turns[i])
    for kind in ENDINGS:
        best = max((at + len(e) for e in kind if (at := data.rfind(e, low + 1 - len(e), high)) >= 0), default=0)
        if best > low:
            return best
    return max(_start_at(data, high, -1), low + 1)


def cohesion(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(places, similarity): every place where a text may be cut by its words, as a byte place, and the cosine of the SIDE
    words before and behind it, smoothed over its neighbours.

    Words are runs of letters and digits in lower case; a character of a script that is written without spaces is a word. A
    place is the start of a word after a space, or beside such a character. The counts slide along: a step costs the same
    whatever SIDE is, and the whole curve is linear in the text.
    """
    text = data.decode("utf-8", "replace")
    found = list(_TOKEN.finditer(text))
    ids: dict[str, int] = {}
    words = [ids.setdefault(m.group().lower(), len(ids)) for m in found]
    left, right, both = Counter(), Counter(words[:SIDE]), 0
    norm_l, norm_r = 0, sum(v * v for v in right.values())
    sims = np.zeros(len(words))
    for i, w in enumerate(words):
        # The place before word i: words i-SIDE..i-1 against i..i+SIDE-1.
        sims[i] = both / (norm_l * norm_r) ** 0.5 if norm_l and norm_r else 0.0
        both -= left[w]
        norm_r -= 2 * right[w] - 1
        right[w] -= 1
        both += right[w]
        norm_l += 2 * left[w] + 1
        left[w] += 1
        if i >= SIDE:
            old = words[i - SIDE]
            both -= right[old]
            norm_l -= 2 * left[old] - 1
            left[old] -= 1
        if i + SIDE < len(words):
            new = words[i + SIDE]
            both += left[new]
            norm_r += 2 * right[new] + 1
            right[new] += 1
    starts = np.array([m.start() for m in found], np.int64)
    single = np.array([bool(_SINGLE.fullmatch(m.group())) for m in found], bool)
    spaced = np.array([m.start() > 0 and text[m.start() - 1].isspace() for m in found], bool)
    allowed = spaced | single | np.r_[False, single[:-1]] if len(found) else np.zeros(0, bool)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    widths = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
    at = np.r_[0, np.cumsum(widths)]
    smooth = np.convolve(np.pad(sims, 1, mode="edge"), np.ones(3) / 3, "valid") if len(sims) else sims
    good = allowed & (starts > 0)
    return at[starts[good]], smooth[good]


def depths(sims: np.ndarray) -> np.ndarray:
    """How deep the valley at each place is: the climb to the nearest peak before it and to the nearest behind it."""
    out = np.zeros(len(sims))
    for curve, into in ((sims, slice(None)), (sims[::-1], slice(None, None, -1))):
        peak = np.zeros(len(curve))
        for i, s in enumerate(curve):
            peak[i] = max(s, peak[i - 1]) if i and curve[i - 1] >= s else s
        out[into] += peak - curve
    return out


class Valleys:
    """Cuts at the deepest valley of the cohesion of a text; its curve is worked out once."""

    def __init__(self, data: bytes):
        self.places, sims = cohesion(data)
        self.depth = depths(sims)

    def __call__(self, data: bytes, start: int, turns: np.ndarray, limit: int = LIMIT, least: int = LEAST) -> int:
        """The place of the deepest valley in (start + least, start + limit], the last of several equal ones; in a window
        without a place, the last character start."""
        low, high = np.searchsorted(self.places, [start + least, start + limit], "right")
        if low == high:
            return max(_start_at(data, start + limit, -1), start + least + 1)
        depth = self.depth[low:high]
        return int(self.places[low + len(depth) - 1 - int(np.argmax(depth[::-1]))])


CUTS = {"boundaries": lambda data: cut_at_boundary, "cohesion": Valleys}


def cuts(data: bytes, turns: np.ndarray, how: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(start, end) of the pieces of `data`; `turns` has the sorted starts of turns in it."""
    out, a, cut = [], 0, CUTS[how](data)
    while len(data) - a > limit:
        b = cut(data, a, turns)
        out.append((a, b))
        a = _start_at(data, b - overlap, 1)
    out.append((a, len(data)))
    return out


def _pages(blobs: DataFrame) -> DataFrame:
    """(cleaned_hash, page, size, data, turns): pages of each blob, with the byte places where turns start in it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, text, starts in zip(batch["cleaned_hash"], batch["text"], batch["starts"]):
                data = text.encode()
                begins = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
                starts = np.array([s for s in (starts if starts is not None else []) if s is not None and s == s], np.int64)
                turns = np.unique(begins[starts[(starts >= 0) & (starts < len(begins))]])
                pages = range(0, max(len(data), 1), PAGE)
                yield pd.DataFrame({"cleaned_hash": name, "page": [p // PAGE for p in pages], "size": len(data), "data": [data[p : p + PAGE] for p in pages], "turns": [turns[(turns >= p) & (turns < p + PAGE)] for p in pages]})

    one = blobs.groupBy("cleaned_hash").agg(F.first("text").alias("text"), F.first("turns.start").alias("starts"))
    return one.where("text is not null").mapInPandas(run, "cleaned_hash string, page int, size bigint, data binary, turns array<bigint>")


def split_chunks(chunks: DataFrame, blobs: DataFrame, how: str = "boundaries") -> DataFrame:
    """(cleaned_hash, segment, turn_start, byte_start, byte_end) of the pieces of each chunk above LIMIT bytes.

    `chunks` has (cleaned_hash, segment, turn_start, byte_start, byte_end), `blobs` (cleaned_hash, text, n_bytes, turns).
    A chunk counts if its blob has a text, 0 <= byte_start < byte_end <= n_bytes, and neither end falls inside a character;
    others, and those with a null place, give no rows. Chunks written twice count once. A null segment or turn_start is
    kept. Turns may be null, in any order, or point outside. Empty tables give no rows; other columns are ignored.
    """
    ids = ["cleaned_hash", "segment", "turn_start", "byte_start", "byte_end"]
    large = chunks.select(*ids).where(F.col("byte_start") >= 0).where(F.col("byte_end") - F.col("byte_start") > LIMIT).distinct()
    known = blobs.groupBy("cleaned_hash").agg(F.first("n_bytes").alias("n_bytes"))
    large = large.join(known, "cleaned_hash").where("byte_end <= n_bytes").drop("n_bytes")
    wanted = large.withColumn("page", F.explode(F.sequence(F.expr(f"cast(byte_start div {PAGE} as int)"), F.expr(f"cast(byte_end div {PAGE} as int)"))))
    parts = wanted.join(_pages(blobs.join(large.select("cleaned_hash").distinct(), "cleaned_hash", "left_semi")), ["cleaned_hash", "page"])
    whole = parts.groupBy(*ids).agg(F.array_sort(F.collect_list(F.struct("page", "data", "turns", "size"))).alias("parts"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, segment, turn, start, end, parts in zip(*(batch[c] for c in (*ids, "parts"))):
                base, size = parts[0]["page"] * PAGE, parts[0]["size"]
                data = b"".join(p["data"] for p in parts)
                lo, hi = start - base, end - base
                if end > size or data[lo] & 0xC0 == 0x80 or (hi < len(data) and data[hi] & 0xC0 == 0x80):
                    continue
                turns = np.concatenate([np.asarray(p["turns"], np.int64) for p in parts]) - start
                rows += [(name, segment, turn, start + a, start + b) for a, b in cuts(data[lo:hi], turns, how)]
            out = pd.DataFrame(rows, columns=ids)
            yield out.astype({"segment": "Int32", "turn_start": "Int32"})

    return whole.mapInPandas(run, "cleaned_hash string, segment int, turn_start int, byte_start bigint, byte_end bigint")
