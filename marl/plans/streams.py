"""Groups out of a sorted stream of Arrow batches: one group in memory at a time, whatever the partition holds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Consecutive rows of one value in the first column, as tables; the batches of a partition must be sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = batch.column(0).dictionary_encode().indices.to_numpy()
        heads = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), batch.num_rows]
        for a, b in zip(heads, heads[1:]):
            part = batch.slice(a, b - a)
            if held and held[0].column(0)[0] != part.column(0)[0]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)
