"""Counts of hashes in a fixed number of counters, merged from one sketch for each task.

A task counts its own hashes, packs the counters that it touched and hands them on in chunks; the chunks of all tasks are added up
in a shuffle by chunk, one chunk in memory at a time. What reaches the driver is ``finish`` of each merged chunk, at most
``counters`` of whatever size ``finish`` gives a counter, whatever the number of rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = 1 << 16
#: Counters in which a hash counts where it is looked up again.
PLACES = 3
#: Hashes that a task holds before it packs them.
_HELD = 1 << 21


def counters_for(rows: int, per_row: int, least: int = CHUNK, most: int = 1 << 27) -> int:
    """A power of two of counters, ``per_row`` for each row at least, between the bounds."""
    return min(most, max(least, 1 << (max(1, rows * per_row) - 1).bit_length()))


def merged_counts(df: DataFrame, places: Callable[[pa.RecordBatch], np.ndarray], counters: int, finish: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """``finish`` of all counters, one after the other; ``places`` gives the counters (from 0) that the rows of a batch count in.

    ``finish`` is given the ``CHUNK`` counts of a chunk and gives bytes, as many for each chunk. An empty table gives those of zero counts.
    """
    packed = T.StructType([T.StructField("chunk", T.IntegerType()), T.StructField("at", T.BinaryType()), T.StructField("n", T.BinaryType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out(place, n):
            chunk = place // CHUNK
            cut = np.flatnonzero(np.concatenate(([True], chunk[1:] != chunk[:-1], [True])))
            at = [zlib.compress(np.diff(place[a:b] % CHUNK, prepend=0).astype("<u2").tobytes(), 1) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            many = [zlib.compress(n[a:b].astype("<u4").tobytes(), 1) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(chunk[cut[:-1]], pa.int32()), pa.array(at, pa.binary()), pa.array(many, pa.binary())], names=packed.names)

        size, total = 0, np.zeros(0, np.int64)  # few counters are added up over the whole task
        for b in batches:
            if len(found := places(b)):
                held.append(found.astype(np.int64))
                size += len(found)
            if size >= _HELD:
                if counters <= 2 * _HELD:
                    made = np.bincount(np.concatenate(held), minlength=counters)
                    total = made + total if len(total) else made
                else:
                    yield out(*np.unique(np.concatenate(held), return_counts=True))
                held, size = [], 0
        if len(total):
            if held:
                total += np.bincount(np.concatenate(held), minlength=counters)
            yield out(place := np.flatnonzero(total), total[place])
        elif held:
            yield out(*np.unique(np.concatenate(held), return_counts=True))

    merged = T.StructType([T.StructField("chunk", T.IntegerType()), T.StructField("made", T.BinaryType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, np.zeros(CHUNK, np.int64)

        def out():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([finish(sums).tobytes()], pa.binary())], names=merged.names)

        for b in batches:
            for chunk, at, n in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if chunk != now:
                    if now is not None:
                        yield out()
                    now = chunk
                    sums[:] = 0
                sums[np.cumsum(np.frombuffer(zlib.decompress(at), "<u2"), dtype=np.int64)] += np.frombuffer(zlib.decompress(n), "<u4")
        if now is not None:
            yield out()

    none = finish(np.zeros(CHUNK, np.int64))
    whole = np.tile(none, counters // CHUNK).reshape(counters // CHUNK, -1)
    dealt = df.mapInArrow(count, packed).repartition(F.col("chunk")).sortWithinPartitions("chunk")
    for row in dealt.mapInArrow(add, merged).toLocalIterator():  # at most counters / CHUNK rows of one size
        whole[row["chunk"]] = np.frombuffer(row["made"], none.dtype)
    return whole.reshape(-1)


def spread(h: np.ndarray, counters: int, places: int = PLACES) -> np.ndarray:
    """``places`` counters of each 64-bit hash, a row for each of the places."""
    h = h.astype(np.int64).view(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h[None, :] + np.arange(places, dtype=np.uint64)[:, None] * step) & np.uint64(counters - 1)).astype(np.int64)


def counted_bits(hashes: DataFrame, rows: int, times: int, per_row: int = 16, most: int = 1 << 27, places: int = PLACES) -> np.ndarray:
    """One bit for each counter: whether it counts ``times`` or more of the hashes in the only column of ``hashes``."""
    counters = counters_for(rows, per_row, most=most)
    return merged_counts(hashes, lambda b: spread(b.column(0).to_numpy(zero_copy_only=False), counters, places).reshape(-1), counters, lambda n: np.packbits(n >= times, bitorder="little"))


def may_count(h: np.ndarray, bits: np.ndarray, places: int = PLACES) -> np.ndarray:
    """False for hashes that surely came fewer times than ``counted_bits`` was asked for, with as many places."""
    at = spread(h, 8 * len(bits), places)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(axis=0)
