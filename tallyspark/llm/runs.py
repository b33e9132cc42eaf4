"""Streaming over rows that a partition holds in key order: groups without a group-by."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: list[str], most: int | None = None
                ) -> Iterator[tuple[pa.Table, bool]]:
    """Yield ``(rows, whole)`` for every run of two or more rows that agree in ``keys``.

    The batches of a partition have to be sorted by ``keys``.  A run that grows beyond ``most``
    rows is handed out in parts with ``whole`` False, so that memory stays bounded."""
    held, parted = None, False
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        n = table.num_rows
        if n == 0:
            held = None
            continue
        differs = np.zeros(n - 1, dtype=bool)
        for k in keys:
            col = table.column(k).to_numpy()
            differs |= col[1:] != col[:-1]
        starts = np.concatenate([[0], np.flatnonzero(differs) + 1, [n]])
        sizes = np.diff(starts)
        for j in np.flatnonzero((sizes > 1) | (np.arange(len(sizes)) == 0) & parted):
            last = j == len(sizes) - 1
            if last:
                continue
            rows = table.slice(starts[j], sizes[j])
            if j == 0 and parted:
                yield rows, False
            else:
                yield rows, most is None or sizes[j] <= most
        if len(sizes) > 1:
            parted = False
        held = table.slice(starts[-2], sizes[-1])
        if most is not None and sizes[-1] > most:
            yield held.slice(0, sizes[-1] - 1), False
            held, parted = held.slice(sizes[-1] - 1, 1), True
    if held is not None and (held.num_rows > 1 or parted):
        yield held, not parted and (most is None or held.num_rows <= most)
