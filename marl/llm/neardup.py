"""Groups of statements that repeat one another with small edits: a size-aware heavy-light similarity join, exact.

Light sets (few pieces) enumerate every fixed-size subset that a light partner must share. Heavy sets scan inverted
lists: pieces are ordered rarest first, a set is listed under the first of them only, as many as a partner cannot avoid,
and two sets that meet in a list are compared by their sizes, their places in the order and their parity bitmaps, all of
which reject without loss; the texts decide what remains. Long lists are compared in tiles, all bitmaps against all. The boundary between light and heavy is the largest size at which
enumeration costs less than scanning, by the lengths of the lists in the data and the measured cost of a row and of a comparison.

Texts that are copies with edits of one another are joined to one of them first, by a few minwise bands of which each
member is compared with the least only. Sets of one component need no comparison in any list, so a group of any share of the
rows costs its length and not its square, and what the bands miss the lists find. Long lists are cut into blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marl.llm import sketch
from marl.operators.graphs import components
from marl.plans.scratch import drop, keep

#: Bands by which edited copies are joined before the lists are scanned.
FIRST_BANDS = 20
#: Frequencies are kept for this many classes of pieces; any order of the pieces is right, a rarer-first one is fast.
CLASSES = 1 << 16
#: Entries of a list that one task compares with as many others (smaller blocks are sent out more often); pairs looked at in one step.
BLOCK, _STEP = 32768, 1 << 20
#: Entries gathered before they are compared, in whole lists.
_GATHER = 1 << 17
#: Rows and columns of a tile, and pairs from which a tile is worth laying out.
_ROWS, _COLUMNS, _TILE = 128, 4096, 4096
#: Measured nanoseconds of an enumerated row (hashed, shuffled, joined) and of a comparison in a list.
ROW_NS, COMPARE_NS = 1500.0, 30.0
_EPS = 1e-9


def enumeration_rows(n: int, least: float = sketch.SIM_MIN) -> int:
    """Subsets that a set of `n` pieces enumerates to meet every partner no lighter: one size for each larger size."""
    return sum(math.comb(n, c) for m in range(n, int(n / least) + 1) if (c := math.ceil(least * m - _EPS)) <= n)


def scan_rows(n: int, counts: np.ndarray, least: float = sketch.SIM_MIN) -> float:
    """About how many comparisons a set of `n` pieces costs in the lists, by the frequencies of pieces: the rarer pieces
    make the lists, and a list holds the sets that have its piece among their first ones."""
    c = np.sort(counts[counts > 0]).astype(float)
    if not len(c):
        return 0.0
    share = 1 - least
    rare = c[np.cumsum(c) <= max(share * c.sum(), c[0])]
    mean = float((rare**2).sum() / max(rare.sum(), 1.0)) if len(rare) else float(c[0])
    return (n - math.ceil(least * n - _EPS) + 1) * mean * share


def light_boundary(counts: np.ndarray, least: float = sketch.SIM_MIN) -> int:
    """The largest size whose enumeration costs less than its lists; 0 if none does."""
    n = 0
    while enumeration_rows(n + 1, least) * ROW_NS <= scan_rows(n + 1, counts, least) * COMPARE_NS:
        n += 1
    return n


def piece_counts(forms: DataFrame) -> np.ndarray:
    """How many sets hold the pieces of each class: CLASSES numbers, whatever the table."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(CLASSES, np.int64)
        for batch in batches:
            for at in range(0, len(batch), 1000):
                h, _, _ = sketch.distinct_pieces(batch["form"].iloc[at : at + 1000].tolist())
                total += np.bincount((h % np.uint64(CLASSES)).astype(np.int64), minlength=CLASSES)
        held = np.flatnonzero(total)
        yield pd.DataFrame({"class": held.astype(np.int32), "c": total[held]})

    counts = np.zeros(CLASSES, np.int64)
    for k, c in forms.select("form").mapInPandas(run, "class int, c bigint").groupBy("class").agg(F.sum("c")).collect():
        counts[k] = c
    return counts


def subset_keys(forms: DataFrame, top: int, least: float = sketch.SIM_MIN) -> DataFrame:
    """(key, rep) of the enumerated subsets of the sets of `top` pieces or fewer in `forms` (rep, form).

    Of a pair of sizes n <= m the share is at least `least * m`, so both enumerate subsets of that size under m.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, reps = [], []
            for rep, form in zip(batch["rep"], batch["form"]):
                if len(form) > top * sketch.PIECE and len(sketch.pieces(form)) > top:
                    continue
                mine = np.unique(sketch.piece_hashes([form])[0])
                for m in range(len(mine), min(top, int(len(mine) / least + _EPS)) + 1):
                    for chosen in combinations(mine, math.ceil(least * m - _EPS)) if len(mine) <= top else ():
                        keys.append(hash((m, *map(int, chosen))))
                        reps.append(rep)
            yield pd.DataFrame({"key": np.array(keys, np.int64), "rep": np.array(reps, np.int64)})

    return forms.select("rep", "form").mapInPandas(run, "key bigint, rep bigint")


def starred(keys: DataFrame) -> DataFrame:
    """(a, b), a < b: every set of a list of (key, rep) with the least of the list."""
    first = keys.groupBy("key").agg(F.min("rep").alias("a"), F.count("*").alias("held")).where("held > 1").select("key", "a")
    return keys.join(first, "key").where("rep > a").select("a", F.col("rep").alias("b")).distinct()


def verified(pairs: DataFrame, forms: DataFrame, least: float = sketch.SIM_MIN) -> DataFrame:
    """The pairs (a, b) whose texts have a similarity of `least` or more."""
    side = lambda c: forms.select(F.col("rep").alias(c), F.col("form").alias(f"{c}_form"))
    near = pairs.join(side("a"), "a").join(side("b"), "b")
    return near.where(sketch.similarity("a_form", "b_form") >= least).select("a", "b")


def list_entries(forms: DataFrame, counts: np.ndarray, top: int, least: float = sketch.SIM_MIN) -> DataFrame:
    """(tile, other, rep, root, n, at, listed, words): the lists of each set of `forms` (rep, root, form), rarest pieces first.

    A set of n pieces probes its first n - ceil(least n) + 1 pieces and is listed, for partners no smaller, under the
    first n - ceil(2 least / (1 + least) n) + 1 of them. A list that may be longer than two blocks is cut by set; each
    pair of blocks is a tile.
    """
    shared = forms.sparkSession.sparkContext.broadcast(counts)
    words = ", ".join(f"{w} bigint" for w in sketch.WORDS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = shared.value
        for whole in batches:
            for start in range(0, len(whole), 1000):
                batch = whole.iloc[start : start + 1000]
                h, owner, n = sketch.distinct_pieces(batch["form"].tolist())
                bits = sketch.bitmaps(h, owner, len(n)).view(np.int64)
                held = counts[(h % np.uint64(CLASSES)).astype(np.int64)]
                order = np.lexsort((h, held, owner))
                h, owner, held = h[order], owner[order], held[order]
                at = np.arange(len(h)) - np.r_[0, np.cumsum(n)[:-1]][owner]
                size = n[owner]
                probes = (at <= size - np.ceil(least * size - _EPS)) & (size >= least * (top + 1))
                h, owner, held, at, size = h[probes], owner[probes], held[probes], at[probes], size[probes]
                listed = at <= size - np.ceil(2 * least / (1 + least) * size - _EPS)
                parts = np.maximum(1, -(-held // (2 * BLOCK)))
                reps = batch["rep"].to_numpy(np.int64)
                mine = sketch._mix(reps.view(np.uint64))[owner] % parts.astype(np.uint64)
                each = np.repeat(np.arange(len(h)), parts)
                turn = (np.arange(len(each)) - np.repeat(np.cumsum(parts) - parts, parts)).astype(np.uint64)
                low, high = np.minimum(mine[each], turn), np.maximum(mine[each], turn)
                tile = sketch._mix(h[each] + sketch._mix(low * np.uint64(1 << 32) + high) * (parts[each] > 1)).view(np.int64)
                o = owner[each]
                yield pd.DataFrame({"tile": tile, "other": mine[each] != low, "rep": reps[o], "root": batch["root"].to_numpy(np.int64)[o], "n": size[each].astype(np.int32), "at": at[each].astype(np.int32), "listed": listed[each], **{w: bits[o, i] for i, w in enumerate(sketch.WORDS)}})

    return forms.select("rep", "root", "form").mapInPandas(run, f"tile bigint, other boolean, rep bigint, root bigint, n int, at int, listed boolean, {words}")


class _Lists:
    """Whole lists, laid out for comparison: sorted by list and size."""

    def __init__(self, table: pa.Table, top: int, least: float):
        of = lambda c: table.column(c).to_numpy()
        self.top, self.least = top, least
        _, group = np.unique(of("tile"), return_inverse=True)
        order = np.lexsort((of("rep"), of("n"), group))
        self.group, self.n, self.at, self.rep, self.root = group[order], of("n")[order].astype(np.int64), of("at")[order].astype(np.int64), of("rep")[order], of("root")[order]
        self.listed, self.other = of("listed").astype(bool)[order], of("other").astype(bool)[order]
        self.bits = np.stack([of(w)[order] for w in sketch.WORDS]).view(np.uint64)
        self.folded = sketch.folded(self.bits)
        both = np.bincount(group, weights=of("other").astype(float)) > 0
        self.across = both[self.group]
        self.major = self._largest()

    def _largest(self) -> np.ndarray:
        """Whether an entry belongs to the largest component of its list, of two entries or more."""
        order = np.lexsort((self.root, self.group))
        g, r = self.group[order], self.root[order]
        heads = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (r[1:] != r[:-1])])
        count = np.diff(np.r_[heads, len(g)])
        best = np.zeros(int(g[-1]) + 1, np.int64)
        np.maximum.at(best, g[heads], count)
        wins = (count == best[g[heads]]) & (count > 1)
        first = np.full(len(best), len(heads))
        np.minimum.at(first, g[heads][wins], np.flatnonzero(wins))
        major = np.zeros(len(g), bool)
        major[order] = np.repeat(first[g[heads]] == np.arange(len(heads)), count)
        return major

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(smaller, larger) entries that may reach the threshold, of different components. Pairs within the largest component of a list are never formed."""
        minor = np.flatnonzero(~self.major)
        listed_minor, listed_major = minor[self.listed[minor]], np.flatnonzero(self.major & self.listed)
        yield from self._ranges(minor, listed_minor, True)
        yield from self._ranges(minor, listed_major, True)
        yield from self._ranges(listed_minor, np.flatnonzero(self.major), False)

    def _ranges(self, asks: np.ndarray, held: np.ndarray, down: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Each of `asks` with those of `held` that come before it in order of size (down), or after it, within the sizes that can reach the threshold."""
        if not len(asks) or not len(held):
            return
        wide = np.int64(self.n.max()) + 2
        key = self.group[held] * wide + self.n[held]
        # The pieces from its place on bound a partner's size.
        most = np.floor((self.n[asks] - self.at[asks]) * (1 + self.least) / self.least - self.n[asks] + 1e-6).astype(np.int64)
        if down:
            lo = np.searchsorted(key, self.group[asks] * wide + np.ceil(self.least * self.n[asks] - _EPS).astype(np.int64), "left")
            hi = np.minimum(np.searchsorted(held, asks, "left"), np.searchsorted(key, self.group[asks] * wide + np.minimum(most, wide - 1), "right"))
        else:
            most = np.minimum(np.minimum(np.floor(self.n[asks] / self.least + _EPS).astype(np.int64), most), wide - 1)
            lo, hi = np.searchsorted(held, asks, "right"), np.searchsorted(key, self.group[asks] * wide + most, "right")
        many = np.maximum(hi - lo, 0)
        first, last, low, high = self._tiles(asks, lo, hi, many)
        apart = np.ones(len(asks), bool)
        for s, e, left, right in zip(first, last, low, high):
            apart[s:e] = False
            yield from self._tile(asks[s:e], held, lo[s:e], hi[s:e], left, right, down)
        asks, lo, many = asks[apart], lo[apart], many[apart]
        ends = np.cumsum(many)
        start = 0
        while start < len(asks):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _STEP, "right")))
            part = many[start:stop]
            for shift in range(0, int(part.max(initial=0)) if stop == start + 1 else 1, _STEP):
                take = np.minimum(part - shift, _STEP) if stop == start + 1 else part
                q = np.repeat(np.arange(start, stop), take)
                j = np.arange(len(q)) - np.repeat(np.cumsum(take) - take, take) + lo[q] + shift
                small, large = (held[j], asks[q]) if down else (asks[q], held[j])
                yield from self._close(small, large)
            start = stop

    def _tiles(self, asks: np.ndarray, lo: np.ndarray, hi: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first, last) of the stretches of `asks` that are compared as tiles, and (low, high) of what is held for each: most of such a tile are pairs to be compared."""
        group = self.group[asks]
        heads = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        nth = np.arange(len(asks)) - np.repeat(heads, np.diff(np.r_[heads, len(asks)]))
        first = np.flatnonzero(nth % _ROWS == 0)
        last = np.r_[first[1:], len(asks)]
        total = np.add.reduceat(many, first)
        low = np.minimum.reduceat(np.where(many > 0, lo, np.iinfo(np.int64).max), first)
        high = np.maximum.reduceat(np.where(many > 0, hi, 0), first)
        # A stretch without pairs has no low and no high.
        good = total >= _TILE
        good[good] = (high[good] - low[good]) * (last - first)[good] <= 4 * total[good]
        return first[good], last[good], low[good], high[good]

    def _tile(self, asks: np.ndarray, held: np.ndarray, lo: np.ndarray, hi: np.ndarray, low: int, high: int, down: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The pairs of `asks` with what is held from `low` to `high`, all bitmaps against all, folded ones first. One word at a time, without an index for each pair."""
        for start in range(low, high, _COLUMNS):
            part = held[start : min(start + _COLUMNS, high)]
            room = np.minimum(sketch.room(self.n[asks] + self.n[part].max(), self.least), 255).astype(np.uint8)
            both, differ = np.empty((len(asks), len(part)), np.uint64), np.zeros((len(asks), len(part)), np.uint8)
            for mine, theirs in zip(self.folded[:, asks], self.folded[:, part]):
                # 256 differing bits count as 0 and are looked at again.
                differ += np.bitwise_count(np.bitwise_xor(mine[:, None], theirs, out=both))
            near = np.flatnonzero(differ <= room[:, None])
            i, j = near // len(part), near % len(part) + start
            inside = (j >= lo[i]) & (j < hi[i])
            mine, theirs = asks[i[inside]], held[j[inside]]
            yield from self._close(*((theirs, mine) if down else (mine, theirs)))

    def _close(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        sizes = self.n[a] + self.n[b]
        share = np.ceil(self.least / (1 + self.least) * sizes - _EPS)
        good = (self.root[a] != self.root[b]) & (self.n[b] > self.top) & (np.minimum(self.n[a] - self.at[a], self.n[b] - self.at[b]) >= share)
        good &= ~self.across[a] | (self.other[a] != self.other[b])
        a, b, sizes = a[good], b[good], sizes[good]
        differ = np.zeros(len(a), np.int64)
        for word in self.bits:
            differ += np.bitwise_count(word[a] ^ word[b])
        near = differ <= sketch.room(sizes, self.least)
        if near.any():
            yield a[near], b[near]


def scanned(entries: DataFrame, top: int, least: float = sketch.SIM_MIN) -> DataFrame:
    """(a, b), a < b, of the sets that meet in a list and may reach the threshold; at least one of a pair is heavy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
            lists = _Lists(table, top, least)
            pairs: list[np.ndarray] = []
            count = 0
            # What is found leaves the task before it grows.
            for a, b in chain(lists.pairs(), [(None, None)]):
                if a is not None:
                    pairs.append(np.sort(np.stack([lists.rep[a], lists.rep[b]], axis=1), axis=1))
                    count += len(a)
                if pairs and (a is None or count >= _STEP):
                    both = np.unique(np.concatenate(pairs), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(both[:, 0], pa.int64()), pa.array(both[:, 1], pa.int64())], ["a", "b"])
                    pairs, count = [], 0

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            tiles = batch.column(0).to_numpy()
            # What is held ends with an unfinished list: it is compared once a new list begins in this batch.
            new = np.flatnonzero(tiles[1:] != tiles[:-1]) + 1
            starts = held and held[-1].column(0)[-1].as_py() != tiles[0]
            cut = 0 if starts else int(new[-1]) if len(new) else None
            if sum(b.num_rows for b in held) + batch.num_rows >= _GATHER and cut is not None:
                head = [*held, batch.slice(0, cut)] if cut else held
                yield from found(pa.Table.from_batches(head))
                held, batch = [], batch.slice(cut)
            held.append(batch)
        if held:
            yield from found(pa.Table.from_batches(held))

    return entries.repartition("tile").sortWithinPartitions("tile").mapInArrow(run, "a bigint, b bigint")


def near_links(forms: DataFrame, least: float = sketch.SIM_MIN, boundary: int | None = None) -> DataFrame:
    """(a, b) of near texts of `forms` (rep bigint, form; one row a form) such that their components are those of all near pairs."""
    counts = piece_counts(forms)
    top = light_boundary(counts, least) if boundary is None else boundary
    bands = sketch.banded(forms, bands=FIRST_BANDS).select(F.explode("bands").alias("key"), "rep")
    first = keep(verified(starred(bands), forms, least), "links")
    roots = components(first).withColumnRenamed("node", "rep")
    rooted = keep(forms.join(roots, "rep", "left").select("rep", "form", F.coalesce("root", "rep").alias("root")), "rooted")
    pairs = scanned(list_entries(rooted, counts, top, least), top, least)
    if top:
        light = subset_keys(forms, top, least)
        side = lambda c: light.join(rooted.select("rep", "root"), "rep").select("key", F.col("rep").alias(c), F.col("root").alias(f"r{c}"))
        pairs = pairs.union(side("a").join(side("b"), "key").where("a < b and ra <> rb").select("a", "b"))
    links = keep(first.union(verified(pairs.distinct(), forms, least)), "links")
    drop(first, rooted)
    return links


def near_duplicate_groups(df: DataFrame, key: str, text: str, least: float = sketch.SIM_MIN, entropy_min: float = sketch.ENTROPY_MIN, boundary: int | None = None) -> DataFrame:
    """(group_id, `key`) for each row of a group other than its least key.

    Rows with a null text or a form of an entropy below `entropy_min` (empty and blank ones included) take no part.
    Rows of one form are copies: their form is compared once. Repeated rows of one key count as one. An empty table
    gives no rows. Texts of any length are taken whole. Columns besides `key` and `text` are ignored, whatever their
    names. `key` is a bigint without nulls; rows with a null key take no part. `boundary` sets the size up to which sets are light.
    """
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")).where("id is not null")
    member = keep(sketch.forms(rows, "text", entropy_min).select("id", "form", F.xxhash64("form").alias("h1"), F.xxhash64(F.lit(7), "form").alias("h2")), "member")
    forms = keep(member.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.first("form").alias("form")), "forms")
    links = near_links(forms, least, boundary)
    roots = components(links)
    copies = member.select("id", "h1", "h2").join(forms.select("h1", "h2", "rep"), ["h1", "h2"])
    out = copies.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(F.coalesce("root", "rep").alias("group_id"), "id")
    out = keep(out.where("group_id <> id").distinct(), "groups")
    drop(member, forms, links)
    return out.select("group_id", F.col("id").alias(key))
