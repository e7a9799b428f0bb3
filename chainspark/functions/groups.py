"""Arrow batches of sorted rows, put together so that no group is torn."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa


def firsts(rows: pa.Table | pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Where each group of rows with equal keys begins."""
    new = np.zeros(rows.num_rows, dtype=bool)
    new[:1] = True
    for k in keys:
        column = rows[k].combine_chunks() if isinstance(rows, pa.Table) else rows[k]
        code = column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= code[1:] != code[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of one or many whole groups, from batches that are sorted by `keys`."""
    held: list[pa.RecordBatch] = []  # of the group that may go on
    name = lambda b: [b[k][0].as_py() for k in keys]
    for b in batches:
        if not b.num_rows:
            continue
        if held and name(held[0]) != name(b):
            yield pa.Table.from_batches(held)
            held = []
        last = int(firsts(b, keys)[-1])
        if last:
            yield pa.Table.from_batches([*held, b.slice(0, last)])
            held = []
        held.append(b.slice(last))
    if held:
        yield pa.Table.from_batches(held)
