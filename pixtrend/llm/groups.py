"""Streaming groups out of Arrow batches that are sorted by their keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Yield blocks of whole groups from batches sorted by ``keys`` (no nulls
    in them).  A block holds one or more complete groups; only the last group
    of a batch is carried over to the next."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        if held is not None:
            t = pa.concat_tables([held, t])
        cut = group_starts(t, keys)[-1]
        if cut:
            yield t.slice(0, cut).combine_chunks()
        held = t.slice(cut)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def group_starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers at which a new key begins."""
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for k in keys:
        v = t.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)
