"""Encoding of texts with a public byte-level pair vocabulary.

The text is split by the vocabulary's pattern; each piece is merged on a segment tree over its byte positions whose
nodes hold the leftmost least rank of the pairs that begin at live positions. A merge reads the root and updates the
two or three positions that changed, in logarithmic time each; a piece of n bytes takes n log n steps, so that a run of
a million letters is no special case.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER_DIR = os.environ.get("MARL_TOKENIZERS", "/opt/tokenizers")
# Fixed value: the pattern that this vocabulary splits text by.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces whose ids a worker remembers, up to this length in bytes; when so many are held it begins anew.
REMEMBERED, REMEMBERED_BYTES = 100_000, 48
_NONE = 1 << 62


class PairEncoder:
    """Ids by the rank file `path`."""

    def __init__(self, path: str):
        import regex

        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
        self.longest = max(map(len, self.ranks))
        self.split = regex.compile(PATTERN).findall
        self.known: dict[str, list[int]] = {}

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; none for an empty or null one."""
        ids: list[int] = []
        known = self.known
        for piece in self.split(text or ""):
            found = known.get(piece)
            if found is None:
                data = piece.encode()
                found = self.merge(data)
                if len(data) <= REMEMBERED_BYTES:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[piece] = found
            ids += found
        return ids

    def merge(self, data: bytes) -> list[int]:
        ranks, n = self.ranks, len(data)
        if (whole := ranks.get(data)) is not None:
            return [whole]
        size = 1 << (n - 1).bit_length()
        shift = size.bit_length()
        tree = [_NONE] * (2 * size)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        for i in range(n - 1):
            if (rank := ranks.get(data[i : i + 2])) is not None:
                tree[size + i] = rank << shift | i
        for node in range(size - 1, 0, -1):
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if a < b else b
        low = size - 1

        def update(i: int, value: int) -> None:
            node = size + i
            tree[node] = value
            while node > 1:
                a, b = tree[node], tree[node ^ 1]
                node >>= 1
                least = a if a < b else b
                if tree[node] == least:
                    return
                tree[node] = least

        def pair_at(i: int) -> int:
            middle = after[i]
            if middle >= n:
                return _NONE
            end = after[middle]
            rank = ranks.get(data[i:end]) if end - i <= self.longest else None
            return _NONE if rank is None else rank << shift | i

        mask = (1 << shift) - 1
        while tree[1] != _NONE:
            i = tree[1] & mask
            gone = after[i]
            end = after[i] = after[gone]
            if end < n:
                before[end] = i
            if gone <= low:
                update(gone, _NONE)
            update(i, pair_at(i))
            if before[i] >= 0:
                update(before[i], pair_at(before[i]))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : after[i]]])
            i = after[i]
        return out


_encoders: dict[str, PairEncoder] = {}


def encoder(path: str) -> PairEncoder:
    """The worker's encoder for a rank file; the file is read once a process."""
    if path not in _encoders:
        _encoders[path] = PairEncoder(path)
    return _encoders[path]


def encode_texts(df: DataFrame, key: str, text: str, vocabulary: str = "byte_bpe_50k.tiktoken", folder: str = TOKENIZER_DIR) -> DataFrame:
    """(`key`, ids) with a row for every row of `df`: the ids of `text`, an empty list for an empty or null text.

    Names of special tokens in a text are ordinary text. No shuffle; texts are taken whole at any length; a null key
    stays null; an empty table gives no rows; other columns are ignored, whatever their names. The rank file is read from
    `folder` on each worker.
    """
    path = f"{folder}/{vocabulary}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                ids = pa.array([encode(t) for t in part.column(1).to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], [key, "ids"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key), F.col(text).alias("_text")).mapInArrow(run, f"`{key}` {kind}, ids array<int>")
