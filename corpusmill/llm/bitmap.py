"""Bitmaps of 64-bit keys, of bounded size: they hold back rows that no later join can use.

A bitmap lets through every key it was made of and few others, so it only saves work: what passes is still joined or grouped exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bound of a bitmap. More keys make it let through more, never less.
MAX_FILTER_BITS = 1 << 28
CHUNK = 4096


def _bits(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    k = keys.view(np.uint64)
    return (k & np.uint64(bits - 1)).astype(np.int64), ((k >> np.uint64(32)) & np.uint64(bits - 1)).astype(np.int64)


def passes(filter_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    a, b = _bits(keys, len(filter_) * 8)
    return ((filter_[a >> 3] >> (a & 7).astype(np.uint8)) & (filter_[b >> 3] >> (b & 7).astype(np.uint8)) & 1).astype(bool)


def key_filter(df: DataFrame, of_batch: Callable[[pa.RecordBatch], np.ndarray], n_keys: int) -> np.ndarray:
    """Bitmap of the keys that ``of_batch`` (record batch to int64 array) finds in ``df``: every partition makes its own, the JVM joins them."""
    bits = 1 << 20
    while bits < min(16 * n_keys, MAX_FILTER_BITS):
        bits *= 2

    def part(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(bits // 8, np.uint8)
        for rows in it:
            for x in _bits(of_batch(rows), bits):
                np.bitwise_or.at(own, x >> 3, np.uint8(1) << (x & 7).astype(np.uint8))
        own = own.reshape(-1, CHUNK)
        some = np.flatnonzero(own.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([own[i].tobytes() for i in some], pa.binary())], ["chunk", "bitmap"])

    out = np.zeros((bits // 8 // CHUNK, CHUNK), np.uint8)
    rows = df.mapInArrow(part, "chunk int, bitmap binary").groupBy("chunk").agg(F.expr("bitmap_or_agg(bitmap)").alias("bitmap")).collect()  # MAX_FILTER_BITS / 8 bytes at most
    for r in rows:
        out[r["chunk"]] = np.frombuffer(bytes(r["bitmap"]), np.uint8)
    return out.ravel()


def of_column(name: str) -> Callable[[pa.RecordBatch], np.ndarray]:
    return lambda rows: rows.column(rows.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
