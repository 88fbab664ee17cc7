"""Corpus-wide counts in bounded arrays: each task counts its rows in numpy,
the arrays are cut into blocks, and blocks are added up per (label, block).

What reaches the driver is one array of ``size`` counters per label, whatever
the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK = 1 << 14
SCHEMA = "label string, block int, counts binary"


def _rows(sums: dict[tuple[str, int], np.ndarray]) -> pa.RecordBatch:
    keys = list(sums)
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
         pa.array([sums[k].tobytes() for k in keys], pa.binary())], ["label", "block", "counts"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[str, int], np.ndarray] = {}
    for batch in batches:
        for label, block, counts in zip(*(c.to_pylist() for c in batch.columns)):
            new = np.frombuffer(counts, np.int64)
            sums[label, block] = sums[label, block] + new if (label, block) in sums else new
    yield _rows(sums)


def summed(rows: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """Add up, over all tasks, the int64 arrays per label that ``count`` makes of a task's batches."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = count(batches)
        yield _rows({(label, i // BLOCK): a[i: i + BLOCK] for label, a in whole.items() for i in range(0, len(a), BLOCK)})

    out: dict[str, dict[int, bytes]] = {}
    for r in rows.mapInArrow(task, SCHEMA).repartition("label", "block").mapInArrow(_add, SCHEMA).collect():
        out.setdefault(r["label"], {})[r["block"]] = bytes(r["counts"])
    return {label: np.concatenate([np.frombuffer(parts[i], np.int64) for i in sorted(parts)]) for label, parts in out.items()}
