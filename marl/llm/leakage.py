"""Evaluation passages inside a corpus, found by latent semantic retrieval.

A passage is a TF-IDF vector over BUCKETS hashed words (document frequencies count all documents), projected on the range of
a randomised SVD and scaled to length one. Passages of documents and of test items meet by codes, the signs of their
latent vectors on the sides of fixed hyperplanes, so that the two sides are joined on equal codes and never multiplied with each other.
A bitmap of the items' codes, of fixed size, keeps what can meet nothing from leaving its task. Long documents are cut into
overlapping stretches first.

`leaked_items` asks for RUN equal consecutive words. Documents are cut into blocks of BLOCK words end to end, items into
all windows of BLOCK words: such a run holds a whole block of its document, the item has the same words in one of its
windows, and equal words in equal order have one vector and one code, so nothing is lost. The words around a block travel
with it, and the longest common run through the block decides.

`paraphrased_items` asks for passages in other words. Overlapping passages of PASSAGE words meet in one of several codes
by which near vectors are likely to agree, their cosine is taken, and the longest common subsequence of their words and
the answer check, the rarest words of the item's passage, decide.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BooleanType, IntegerType

from marl.llm.lookalike import consistent_values
from marl.plans.scratch import drop, keep

BLOCK, RUN = 6, 12
BUCKETS, RANK, OVERSAMPLE = 1 << 14, 24, 8
#: The SVD is fitted on about this many rows, chosen by hash; search and frequencies take all.
FIT_DOCUMENTS = 20_000
#: Words of a document that one row holds besides what it shares with the row before.
STRETCH = 4096
#: Cells of the bitmap of codes that occur in items.
CELLS = 1 << 20
#: Signs of the code of a block.
SIDES = 40
#: Passages of a paraphrase search, in words, and how far apart they begin.
PASSAGE, STEP = 24, 8
#: Codes of a passage and signs of each: a pair of a cosine of 0.9 shares one with a probability of 0.97, of 0.8 with 0.75, of 0.7 with 0.4;
#: a pair of overlapping passages has several chances.
CODES, SIGNS = 64, 14
#: Dimensions of the latent space of a paraphrase search.
WIDE_RANK = 120
#: The least cosine, the least share of the item's words in the longest common subsequence, and of its rarest words, of a paraphrase.
#: Of four rarest words one may be missing, so that one of the two rarest is there.
COSINE, SUBSEQUENCE, ANSWER, RAREST = 0.65, 0.6, 0.75, 4
_WORD = re.compile(r"[^\W_]+")


def words(df: DataFrame, key: str, text: str, overlap: int = RUN) -> DataFrame:
    """(`key`, part, words, fresh): hashes of the words of the consistent form in lower case, in stretches of STRETCH words that repeat the
    last `overlap` words of the one before; the first `fresh` words of a stretch are its own. Rows without a key or text left out."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, form in zip(batch[key], consistent_values(batch["_text"])):
                found = _WORD.findall(form.lower())
                rows += [(k, at // STRETCH, found[at : at + STRETCH + overlap], min(STRETCH, len(found) - at)) for at in range(0, len(found), STRETCH)]
            yield pd.DataFrame(rows, columns=[key, "part", "words", "fresh"]).astype({key: batch[key].dtype})

    split = df.select(F.col(key), F.col(text).alias("_text")).where(F.col("_text").isNotNull() & F.col(key).isNotNull()).mapInPandas(run, f"`{key}` {kind}, part int, words array<string>, fresh int")
    return split.select(key, "part", F.transform("words", lambda w: F.xxhash64(w)).alias("words"), "fresh")


def idf(table: DataFrame) -> np.ndarray:
    """Inverse document frequencies of the word buckets over all stretches: BUCKETS numbers, whatever the corpus."""
    each = table.select(F.explode(F.array_distinct(F.transform("words", lambda w: F.pmod(w, F.lit(BUCKETS))))).alias("b"))
    counts = np.zeros(BUCKETS)
    for b, c in each.groupBy("b").agg(F.count("*")).collect():
        counts[b] = c
    return np.log((table.count() + 1) / (counts + 1)) + 1


def blocks_of(lists: list[np.ndarray], step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(blocks, owner, place): BLOCK words each, every `step` words of each list."""
    starts = [np.arange(0, len(w) - BLOCK + 1, step) for w in lists]
    owner = np.repeat(np.arange(len(lists)), [len(s) for s in starts])
    base = np.cumsum([0, *(len(w) for w in lists[:-1])]) if lists else np.zeros(0, np.int64)
    place = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
    at = (base[owner] + place if len(owner) else place).astype(np.int64)
    return flat[at[:, None] + np.arange(BLOCK)], owner, place


def latent(blocks: np.ndarray, weight: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Unit vectors of blocks; words are added in order, so that equal blocks have equal vectors."""
    at = blocks % BUCKETS
    out = np.zeros((len(blocks), basis.shape[1]), np.float32)
    for i in range(blocks.shape[1]):
        out += basis[at[:, i]] * weight[at[:, i], None]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), np.float32(1e-30))


def _sample(table: DataFrame) -> DataFrame:
    """The words of about FIT_DOCUMENTS rows, by their hash: nothing is sorted, and no task holds the sample."""
    share = min(1.0, FIT_DOCUMENTS / max(table.count(), 1))
    return table.where(F.pmod(F.xxhash64("words"), F.lit(1 << 20)) < int(share * (1 << 20))).select("words").coalesce(8)


def latent_basis(table: DataFrame, weight: np.ndarray, seed: int = 8, rank: int = RANK) -> np.ndarray:
    """An orthonormal basis, BUCKETS x (rank + OVERSAMPLE), of the leading right singular vectors of the block matrix.

    Every partition of the fitted documents multiplies its part of A'A with the basis; the parts are added by blocks of
    rows, and what comes to the driver is one matrix of fixed size. Two such products, with a QR decomposition after each.
    """
    width = rank + OVERSAMPLE
    rng = np.random.default_rng(seed)
    random = rng.standard_normal((BUCKETS, width))
    basis = random
    fit = keep(_sample(table), "fit")
    for _ in range(2):
        q = basis

        def part(batches: Iterator[pd.DataFrame], q=q) -> Iterator[pd.DataFrame]:
            total = np.zeros((BUCKETS, width))
            for batch in batches:
                blocks, _, _ = blocks_of([np.asarray(w, np.int64) for w in batch["words"]], BLOCK)
                at = blocks % BUCKETS
                y = sum(q[at[:, i]] * weight[at[:, i], None] for i in range(BLOCK)) if len(at) else np.zeros((0, width))
                for i in range(BLOCK):
                    order = np.argsort(at[:, i], kind="stable")
                    if len(order):
                        b = at[order, i]
                        heads = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
                        total[b[heads]] += np.add.reduceat(y[order] * weight[b, None], heads, axis=0)
            size = 256
            yield pd.DataFrame({"r": range(BUCKETS // size), "v": [total[i : i + size].ravel() for i in range(0, BUCKETS, size)]})

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"r": pdf["r"].iloc[:1], "v": [np.sum(np.stack(pdf["v"].to_list()), axis=0)]})

        parts = fit.mapInPandas(part, "r int, v array<double>").groupBy("r").applyInPandas(add, "r int, v array<double>").toPandas().sort_values("r")
        product = np.concatenate([np.asarray(v) for v in parts["v"]]).reshape(BUCKETS, width) if len(parts) else np.zeros((BUCKETS, width))
        basis, _ = np.linalg.qr(product + 1e-9 * random)
    drop(fit)
    # Words that the fit did not meet get a small direction of their own.
    unseen = np.abs(product).sum(axis=1) == 0
    basis[unseen] = random[unseen] / BUCKETS**0.5
    return basis.astype(np.float32)


def _planes(width: int, count: int, seed: int = 9) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((width, count)).astype(np.float32)


def exact_codes(vectors: np.ndarray) -> np.ndarray:
    """One code of SIDES signs for each vector. The products are added in one order, number by number, so that equal vectors have equal codes whatever stands beside them."""
    planes = _planes(vectors.shape[1], SIDES)
    total = np.zeros((len(vectors), SIDES), np.float32)
    for d in range(vectors.shape[1]):
        total += vectors[:, d, None] * planes[d]
    return (total > 0).astype(np.int64) @ (np.int64(1) << np.arange(SIDES, dtype=np.int64))


def near_codes(vectors: np.ndarray) -> np.ndarray:
    """CODES codes of SIGNS signs for each vector, told apart by their number."""
    signs = ((vectors @ _planes(vectors.shape[1], CODES * SIGNS)) > 0).reshape(len(vectors), CODES, SIGNS)
    return signs.astype(np.int64) @ (np.int64(1) << np.arange(SIGNS, dtype=np.int64)) + (np.arange(CODES, dtype=np.int64) << SIGNS)


def _cell(codes: np.ndarray) -> np.ndarray:
    mixed = codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def _lists(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
    column = batch.column(batch.schema.get_field_index(name))
    return np.split(column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy())[:-1]) if batch.num_rows else []


def _bytes(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * 8
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary()) if width else pa.array([], pa.binary())


def _around(lists: list[np.ndarray], owner: np.ndarray, place: np.ndarray, side: int) -> np.ndarray:
    """BLOCK words at each place with `side` words before and behind; 0 stands outside of a text."""
    pad = np.zeros(side, np.int64)
    padded = [np.concatenate([pad, w, pad]) for w in lists]
    base = np.cumsum([0, *(len(w) for w in padded[:-1])]) if padded else np.zeros(0, np.int64)
    flat = np.concatenate(padded) if padded else np.zeros(0, np.int64)
    return flat[(base[owner] + place)[:, None] + np.arange(BLOCK + 2 * side)] if len(owner) else np.zeros((0, BLOCK + 2 * side), np.int64)


def _cells_of(codes: DataFrame) -> np.ndarray:
    """The bitmap of the cells that codes fall into: CELLS bits."""
    bits = np.zeros(CELLS, bool)
    bits[[r[0] for r in codes.select("cell").distinct().collect()]] = True
    return bits


def _coded(table: DataFrame, key: str, name: str, step: int, weight, basis, only=None) -> DataFrame:
    """(code, cell, `name`, around) of the blocks of each stretch; with `only`, a bitmap, those whose code may occur in it. A block that begins in the own words of a stretch or within a block behind them belongs to it, so that a run that begins there is seen whole."""
    kind = table.schema[key].dataType.simpleString()
    shared = table.sparkSession.sparkContext.broadcast((weight, basis, only))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, basis, only = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                lists = _lists(batch, "words")
                blocks, owner, place = blocks_of(lists, step)
                own = place < batch.column(2).to_numpy()[owner] + BLOCK if len(owner) else np.zeros(0, bool)
                blocks, owner, place = blocks[own], owner[own], place[own]
                code = exact_codes(latent(blocks, weight, basis))
                cell = _cell(code)
                if only is not None:
                    kept = only[cell]
                    code, cell, owner, place = code[kept], cell[kept], owner[kept], place[kept]
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(cell), batch.column(0).take(pa.array(owner, pa.int64())), _bytes(_around(lists, owner, place, RUN - BLOCK))], ["code", "cell", name, "around"])

    return table.select(key, "words", "fresh").mapInArrow(run, f"code bigint, cell bigint, `{name}` {kind}, around binary")


@pandas_udf(IntegerType())
def common_run(a: pd.Series, b: pd.Series) -> pd.Series:
    """Words of the common run through two blocks with the words around them; 0 where the blocks differ. Runs are counted up to the words that travel."""
    side = RUN - BLOCK
    if not len(a):
        return pd.Series([], dtype="int32")
    x = np.frombuffer(b"".join(a), np.int64).reshape(len(a), -1)
    same = (x == np.frombuffer(b"".join(b), np.int64).reshape(len(b), -1)) & (x != 0)
    before = np.cumprod(same[:, :side][:, ::-1], axis=1).sum(axis=1)
    behind = np.cumprod(same[:, side + BLOCK :], axis=1).sum(axis=1)
    return pd.Series(np.where(same[:, side : side + BLOCK].all(axis=1), before + BLOCK + behind, 0).astype(np.int32))


def _model(table: DataFrame, rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    weight = idf(table).astype(np.float32)
    return weight, latent_basis(table, weight, rank=rank)


def leaked_items(corpus: DataFrame, key: str, text: str, items: DataFrame, item: str, item_text: str) -> DataFrame:
    """(`key`, `item`) of each document and item that share RUN consecutive words.

    Texts are compared as `words` has them. Null texts, and texts or items shorter than RUN words, take no part; a row
    with a null key or item takes none. Repeated rows count once. Empty tables give no rows; other columns are ignored;
    texts are taken whole, long ones in stretches.
    """
    table = keep(words(corpus, key, text, RUN + BLOCK).where(F.size("words") >= RUN), "words")
    own = keep(words(items, item, item_text, RUN + BLOCK).where(F.size("words") >= RUN), "items")
    weight, basis = _model(table)
    asked = keep(_coded(own, item, "_item", 1, weight, basis).distinct(), "asked")
    held = _coded(table, key, "_doc", BLOCK, weight, basis, _cells_of(asked))
    met = held.select("code", "_doc", F.col("around").alias("a")).join(asked.select("code", "_item", F.col("around").alias("b")), "code")
    out = keep(met.where(common_run("a", "b") >= RUN).select(F.col("_doc").alias(key), F.col("_item").alias(item)).distinct(), "leaks")
    drop(table, own, asked)
    return out


def passages(lists: list[np.ndarray], fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, place) of the passages of PASSAGE words, STEP apart, that begin in the own words of each stretch; the last
    one of a text ends with it, and a shorter text is one passage."""
    owner, place = [], []
    for i, (w, n) in enumerate(zip(lists, fresh)):
        last = max(len(w) - PASSAGE, 0)
        at = np.unique(np.r_[np.arange(0, last + 1, STEP), last if len(w) - n < PASSAGE else 0])
        at = at[at < n]
        owner.append(np.full(len(at), i))
        place.append(at)
    return (np.concatenate(owner), np.concatenate(place)) if owner else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def passage_vectors(lists: list[np.ndarray], owner: np.ndarray, place: np.ndarray, weight: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, words) of passages; words end in zeros where a text is shorter."""
    out = np.zeros((len(owner), PASSAGE), np.int64)
    for i, (o, p) in enumerate(zip(owner, place)):
        part = lists[o][p : p + PASSAGE]
        out[i, : len(part)] = part
    at = out % BUCKETS
    mass = np.where(out != 0, weight[at], 0).astype(np.float32)
    vectors = np.zeros((len(out), basis.shape[1]), np.float32)
    for i in range(PASSAGE):
        vectors += basis[at[:, i]] * mass[:, i, None]
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), np.float32(1e-30)), out


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """The length of the longest common subsequence, one row of the table at a time."""
    row = np.zeros(len(b) + 1, np.int64)
    for x in a:
        step = np.where(b == x, row[:-1] + 1, 0)
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], step))
    return int(row[-1])


def paraphrases(a: np.ndarray, b: np.ndarray, rare: np.ndarray) -> bool:
    """Whether passage `a` of a document says what passage `b` of an item says: most of its words in order, and its answer words, `rare`."""
    a, b = a[a != 0], b[b != 0]
    if len(b) == 0 or np.isin(b, a).mean() < SUBSEQUENCE or np.isin(rare, a).mean() < ANSWER:
        return False
    return common_subsequence(a, b) >= SUBSEQUENCE * len(b)


def _centre(table: DataFrame, weight: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The mean of the passages' vectors over the sample that the SVD is fitted on: what all passages share tells none apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(basis.shape[1]), 0
        for batch in batches:
            lists = _lists(batch, "words")
            owner, place = passages(lists, np.array([len(w) for w in lists], np.int64))
            vectors, _ = passage_vectors(lists, owner, place, weight, basis)
            total, count = total + vectors.sum(axis=0), count + len(vectors)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()]), pa.array([count])], ["total", "count"])

    parts = _sample(table).mapInArrow(run, "total array<double>, count bigint").collect()
    return (sum((np.array(r[0]) for r in parts), np.zeros(basis.shape[1])) / max(sum(r[1] for r in parts), 1)).astype(np.float32)


def _centred(vectors: np.ndarray, centre: np.ndarray) -> np.ndarray:
    out = vectors - centre
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), np.float32(1e-30))


def rarest_words(words: np.ndarray, weight: np.ndarray, count: int = RAREST) -> np.ndarray:
    """The rarest distinct words of a passage, rarest first, ties by the word."""
    distinct = np.unique(words[words != 0])
    return distinct[np.argsort(-weight[distinct % BUCKETS], kind="stable")[:count]]


def paraphrased_items(corpus: DataFrame, key: str, text: str, items: DataFrame, item: str, item_text: str) -> DataFrame:
    """(`key`, `item`) of each document that holds a passage of an item whole or in changed words.

    A pair comes out when a passage of PASSAGE words of the document and one of the item meet in a code and in one of the item's two rarest
    words, have a cosine of COSINE or more, a longest common subsequence of SUBSEQUENCE of the item's words, and share ANSWER of the
    RAREST words of the item's passage. The codes are an index: a pair may be missed, with the probability that CODES states;
    the word asked for besides loses nothing, and the checks are exact. Null, empty and repeated rows are taken as by `leaked_items`;
    a text shorter than a passage is one.
    """
    spark = corpus.sparkSession
    table = keep(words(corpus, key, text, PASSAGE).where(F.size("words") > 0), "words")
    own = keep(words(items, item, item_text, PASSAGE).where(F.size("words") > 0), "items")
    weight, basis = _model(table, WIDE_RANK)
    model = spark.sparkContext.broadcast((weight, basis, _centre(table, weight, basis)))

    def coded(side: DataFrame, k: str, asks: bool, cells: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
        """(code, cell, word_cell, k, part, at): codes joined with words, the two rarest of an item's passage, or those of a document's that an item asks for."""
        kind = side.schema[k].dataType.simpleString()
        shared = spark.sparkContext.broadcast(cells)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weight, basis, centre = model.value
            for whole in batches:
                for start in range(0, whole.num_rows, 200):
                    batch = whole.slice(start, 200)
                    lists = _lists(batch, "words")
                    owner, place = passages(lists, batch.column(3).to_numpy())
                    vectors, said = passage_vectors(lists, owner, place, weight, basis)
                    if asks:
                        rare = [rarest_words(w, weight, 2) for w in said]
                        row, word = np.repeat(np.arange(len(said)), [len(r) for r in rare]), np.concatenate(rare) if rare else np.zeros(0, np.int64)
                    else:
                        row, column = np.nonzero((said != 0) & shared.value[0][_cell(said)])
                        word = said[row, column]
                    which, at = np.unique(row, return_inverse=True)
                    code = near_codes(_centred(vectors[which], centre))[at] if len(which) else np.zeros((0, CODES), np.int64)
                    code = (code + 1) * np.int64(-7046029254386353131) ^ word[:, None]
                    cell = _cell(code)
                    who, n = np.nonzero(np.ones_like(code, bool) if asks else shared.value[1][cell])
                    taken = pa.array(owner[row[who]], pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(code[who, n]), pa.array(cell[who, n]), pa.array(_cell(word)[who]), batch.column(0).take(taken), batch.column(1).take(taken), pa.array(place[row[who]].astype(np.int32))], ["code", "cell", "word_cell", "k", "part", "at"])

        return side.select(k, "part", "words", "fresh").mapInArrow(run, f"code bigint, cell bigint, word_cell bigint, k {kind}, part int, at int")

    asked = keep(coded(own, item, True), "asked")
    cells = _cells_of(asked.select(F.col("word_cell").alias("cell"))), _cells_of(asked)
    held = coded(table, key, False, cells)
    met = held.select("code", "k", "part", "at").join(asked.select("code", F.col("k").alias("ik"), F.col("part").alias("ip"), F.col("at").alias("iat")), "code").select("k", "part", "at", "ik", "ip", "iat").distinct()
    a = table.select(F.col(key).alias("k"), "part", F.col("words").alias("dw"))
    b = own.select(F.col(item).alias("ik"), F.col("part").alias("ip"), F.col("words").alias("iw"))
    cut = lambda w, at: F.slice(w, F.col(at) + 1, PASSAGE)
    both = met.join(a, ["k", "part"]).withColumn("dw", cut("dw", "at")).join(b, ["ik", "ip"]).withColumn("iw", cut("iw", "iat"))

    @pandas_udf(BooleanType())
    def good(dw: pd.Series, iw: pd.Series) -> pd.Series:
        weight, basis, centre = model.value
        left, right = [np.asarray(x, np.int64) for x in dw], [np.asarray(x, np.int64) for x in iw]
        row, zero = np.arange(len(left)), np.zeros(len(left), np.int64)
        va, wa = passage_vectors(left, row, zero, weight, basis)
        vb, wb = passage_vectors(right, row, zero, weight, basis)
        near = (_centred(va, centre) * _centred(vb, centre)).sum(axis=1) >= COSINE
        out = np.zeros(len(left), bool)
        for i in np.flatnonzero(near):
            out[i] = paraphrases(wa[i], wb[i], rarest_words(wb[i], weight))
        return pd.Series(out)

    out = keep(both.where(good("dw", "iw")).select(F.col("k").alias(key), F.col("ik").alias(item)).distinct(), "paraphrases")
    drop(table, own, asked)
    return out
