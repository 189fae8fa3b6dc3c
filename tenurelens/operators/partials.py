"""Distributed sums of small numeric blocks.

Tasks turn their Arrow batches into a fixed number of sums and emit them as (slot, value)
rows; Spark adds them up. The driver only sees as many numbers as there are slots.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOT_SCHEMA = "slot int, value double"


def slot_batch(values: np.ndarray, first: int = 0) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "slot": pa.array(np.arange(first, first + len(values), dtype=np.int32)),
            "value": pa.array(np.asarray(values, dtype=np.float64)),
        }
    )


def collect_slots(partials: DataFrame, size: int) -> np.ndarray:
    out = np.zeros(size)
    sums = partials.groupBy("slot").agg(F.sum("value").alias("value")).toArrow()
    out[sums.column("slot").to_numpy()] = sums.column("value").to_numpy()
    return out


def columns_of(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """Named numeric columns as a rows x columns matrix."""
    out = np.empty((batch.num_rows, len(names)))
    for k, name in enumerate(names):
        out[:, k] = batch.column(name).to_numpy(zero_copy_only=False)
    return out


def pack_upper(matrix: np.ndarray) -> np.ndarray:
    return matrix[np.triu_indices(matrix.shape[0])]


def unpack_upper(packed: np.ndarray, p: int) -> np.ndarray:
    full = np.zeros((p, p))
    full[np.triu_indices(p)] = packed
    return full + np.triu(full, 1).T
