"""The similarity bands of all pairs of statements, exactly, in tiles of bounded size."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marl.functions import text
from marl.plans.scratch import keep

BANDS = ["non", "residue", "high", "cross"]
#: Statements of one side of a tile, at least and at most, and rows of it worked on at once.
SIDE, _MOST_SIDE, _ROWS = 4000, 24_000, 200
#: Pieces that are counted in a matrix product.
_DENSE = 256
_PAD = chr(0x10FFFF)  # stands in no form: it is neither letter nor digit


def _numbered(values: np.ndarray) -> tuple[int, np.ndarray]:
    """How many distinct values there are, none negative, and each value's number in their order."""
    if not len(values):
        return 0, values
    if (most := int(values.max())) < 1 << 26:  # a table takes a tenth of the time of sorting
        there = np.zeros(most + 1, bool)
        there[values] = True
        number = np.cumsum(there) - 1
        return int(number[-1]) + 1, number[values]
    names, at = np.unique(values, return_inverse=True)
    return len(names), at.astype(np.int64)


def _pieces(forms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(owner, piece) of the distinct pieces of all forms; pieces are numbered exactly, whatever the alphabet."""
    k = text.SHINGLE_K
    padded = [f + _PAD * (k - len(f)) if f and len(f) < k else f for f in forms]
    codes = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).astype(np.int64)
    lengths = np.fromiter(map(len, padded), np.int64, len(padded))
    owner = np.repeat(np.arange(len(padded)), lengths)
    count = max(0, len(codes) - k + 1)
    letters, codes = _numbered(codes)
    ids, span = np.zeros(count, np.int64), 1
    for i in range(k):
        if span * letters >= 1 << 62:
            span, ids = _numbered(ids)
        ids, span = ids * letters + codes[i : count + i], span * letters
    ids = _numbered(ids)[1]
    inside = owner[:count] == owner[k - 1 :] if count else np.zeros(0, bool)
    owner, ids = owner[:count][inside], ids[inside]
    both = np.sort(owner * (ids.max() + 1) + ids) if len(ids) else np.zeros(0, np.int64)
    both = both[np.diff(both, prepend=-1) > 0]  # np.unique would hash them, which takes far longer
    return (both // (ids.max() + 1), both % (ids.max() + 1)) if len(both) else (both, both)


def _similar(left: pd.DataFrame, right: pd.DataFrame | None, low: float):
    """(i, j, sim): all pairs, of a similarity of `low` or more, of rows of `left` with rows of `right`, or of `left` itself with i < j.

    What two statements share is counted for every pair: in one matrix product for the _DENSE pieces that most hold, along lists for the
    others. Sizes and quotients are taken only of pairs that share enough.
    """
    n = len(left)
    both = left if right is None else pd.concat([left, right], ignore_index=True)
    first = 0 if right is None else n
    m = len(both) - first
    owner, piece = _pieces(both["form"].tolist())
    size = np.bincount(owner, minlength=len(both))
    often = np.bincount(piece)
    place = np.full(len(often), -1)
    top = np.argsort(-often, kind="stable")[:_DENSE]
    place[top] = np.arange(len(top))
    dense = np.zeros((len(both), len(top)), np.float32)
    at_top = place[piece] >= 0
    dense[owner[at_top], place[piece[at_top]]] = 1
    owner, piece = owner[~at_top], piece[~at_top]
    at = np.searchsorted(owner, np.arange(len(both) + 1))
    mine = owner >= first
    order = np.argsort(piece[mine], kind="stable")
    held = (owner[mine] - first)[order]
    ends = np.searchsorted(piece[mine][order], np.arange(len(often) + 1))
    other = np.ascontiguousarray(dense[first:].T)
    share = low / (1 + low)
    least = (share * size[first:]).astype(np.float32) - np.float32(0.01)  # pairs near the bound are left to the exact quotient
    for start in range(0, n, _ROWS):
        rows = np.arange(start, min(start + _ROWS, n))
        since = start if right is None else 0
        shared = dense[rows] @ other[:, since:]
        for r, i in enumerate(rows):
            lists = [held[x:y] for x, y in zip(ends[piece[at[i] : at[i + 1]]].tolist(), ends[piece[at[i] : at[i + 1]] + 1].tolist()) if y > x]
            if lists:
                shared[r] += np.bincount(np.concatenate(lists), minlength=m)[since:]
        i, j = np.nonzero(shared - least[since:] >= (share * size[rows]).astype(np.float32)[:, None])
        k = shared[i, j].astype(np.int64)
        i, j = rows[i], j + since
        sim = k / np.maximum(size[i] + size[first + j] - k, 1)
        keep_ = (sim >= low) & ((right is not None) | (j > i))
        yield i[keep_], j[keep_], sim[keep_]


def tile(left: pd.DataFrame, right: pd.DataFrame | None) -> pd.DataFrame:
    """Counts by band of the pairs of two lots of statements (form, origin, sure), or of one lot with itself.

    Pairs below J_MAYBE are all pairs but the others.
    """
    n = len(left)
    both = left if right is None else pd.concat([left, right], ignore_index=True)
    first = 0 if right is None else n
    origin, sure = pd.factorize(both["origin"])[0], both["sure"].to_numpy(bool)
    of = lambda x: np.bincount(x[x >= 0], minlength=origin.max() + 1 if len(origin) else 0)
    mine, theirs = of(origin[:n]), of(origin[first:])
    same_all = int((mine * (mine - 1) // 2).sum() if right is None else (mine * theirs).sum())
    pairs = n * (n - 1) // 2 if right is None else n * len(right)
    out = np.zeros((len(BANDS), 3), np.int64)
    for i, j, sim in _similar(left, right, text.J_MAYBE):
        j = j + first
        band = 1 + (sim >= text.J_HIGH).astype(np.int8) + (sim >= text.J_CROSS)
        same = (origin[i] == origin[j]) & (origin[i] >= 0)
        asked = ((band == 1) | ((band == 2) & ~same)) & sure[i] & sure[j]
        for k in range(1, len(BANDS)):
            here = band == k
            out[k] += (int((here & same).sum()), int((here & ~same).sum()), int((here & asked).sum()))
    out[0, :2] = (same_all - out[1:, 0].sum(), pairs - same_all - out[1:, 1].sum())
    return pd.DataFrame({"band": BANDS, "same": out[:, 0], "other": out[:, 1], "asked": out[:, 2]})


def _lots_for(rows: int, side: int | None) -> int:
    """How many lots; a larger table has larger lots, for every lot is sent to as many tiles as there are lots."""
    return max(1, -(-rows // (side or min(max(SIDE, rows // 8), _MOST_SIDE))))


def _tiled(rows: DataFrame, lots: int) -> DataFrame:
    """`rows` with `lot`, in every tile (x, y) of two lots that they belong to."""
    rows = rows.withColumn("lot", F.expr(f"pmod(xxhash64(key), {lots})"))
    tiles = rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(lots - 1)))).withColumn("x", F.least("lot", "o")).withColumn("y", F.greatest("lot", "o")).drop("o")
    return tiles.repartition(min(lots * (lots + 1) // 2, 2000), "x", "y")


def _lots(pair: tuple, rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame | None]:
    x, y = map(int, pair)
    return rows[rows["lot"] == x].reset_index(drop=True), None if x == y else rows[rows["lot"] == y].reset_index(drop=True)


def pairs_between(df: DataFrame, key: str, words: str, low: float, high: float, side: int | None = None) -> DataFrame:
    """(a, b, sim), a < b: all pairs of statements of a similarity of `low` or more and below `high`, both of an entropy of H_MIN or more.

    Every pair is compared, in tiles as in `band_counts`, and only those in the range leave a task. Rows with a null key
    or text take no part; of several rows of one key the one of the least form counts. `key` is a string or a bigint.
    """
    kind = df.schema[key].dataType.simpleString()
    form = text.normalize(F.col(words))
    rows = df.where(F.col(key).isNotNull() & F.col(words).isNotNull()).select(F.col(key).alias("key"), form.alias("form")).groupBy("key").agg(F.min("form").alias("form"))
    rows = keep(rows.where(text.entropy(F.col("form")) >= text.H_MIN), "forms")
    lots = _lots_for(rows.count(), side)

    def work(pair: tuple, part: pd.DataFrame) -> pd.DataFrame:
        left, right = _lots(pair, part)
        other = left if right is None else right
        out = []
        for i, j, sim in _similar(left, right, low):
            i, j, sim = i[sim < high], j[sim < high], sim[sim < high]
            out.append(pd.DataFrame({"a": left["key"].to_numpy()[i], "b": other["key"].to_numpy()[j], "sim": sim}))
        return pd.concat(out) if out else pd.DataFrame({"a": left["key"][:0], "b": left["key"][:0], "sim": np.zeros(0)})

    found = _tiled(rows, lots).groupBy("x", "y").applyInPandas(work, f"a {kind}, b {kind}, sim double")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sim")


def band_counts(df: DataFrame, key: str, words: str, origin: str, side: int | None = None) -> DataFrame:
    """(band, same, other, asked) for the four bands: pairs of statements by similarity, split by one `origin` or two.

    Every pair counts, those that share nothing among them: no candidate search decides what is compared. A null origin is
    like no other. `asked` are the pairs that the thresholds leave open, both of an entropy of H_MIN or more. Rows
    with a null key or text take no part; repeated rows count once. The work grows as the square of the rows, in
    tiles of lots (of `side` statements, where given), so that no task holds more than two of them.
    """
    form = text.normalize(F.col(words))
    rows = df.where(F.col(key).isNotNull() & F.col(words).isNotNull()).select(key, origin, form.alias("form")).distinct()
    rows = keep(rows.select(F.col(key).alias("key"), F.col(origin).alias("origin"), "form", (text.entropy(F.col("form")) >= text.H_MIN).alias("sure")), "forms")
    lots = _lots_for(rows.count(), side)

    def work(pair: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return tile(*_lots(pair, part))

    found = _tiled(rows, lots).groupBy("x", "y").applyInPandas(work, "band string, same bigint, other bigint, asked bigint")
    none = df.sparkSession.createDataFrame([(b, 0, 0, 0) for b in BANDS], found.schema)
    return found.union(none).groupBy("band").agg(*[F.sum(c).alias(c) for c in ("same", "other", "asked")])
