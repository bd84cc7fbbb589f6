"""Benchmark decontamination by greedy string tiling.

Texts and benchmark items become sequences of lower-case words. A shared run of ``MIN_MATCH`` words is a
seed; equal hashes of runs join documents with items. For each document and item whose shared seeds could cover enough of the item,
tiles are marked: Karp-Rabin hashes over prefix sums, one step for a run of any length, find the longest equal runs of unmarked words;
those that do not overlap are marked first to last, then the next shorter ones, until none of ``MIN_MATCH`` words is left. The share of
the item's words under tiles is its coverage, whatever their order in the document. The work for a pair is a few array
passes for each length of a tile, also where words repeat without end.

Items are a stated query set: they are shared with the tasks in blocks of bounded size, and documents are never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm._common import free_name, materialize, slices

MIN_MATCH = 5
MIN_COVERAGE = 0.5
#: Items in one block, and characters in one block, at most (a longer item is a block of its own).
BLOCK_ITEMS = 50_000
BLOCK_CHARS = 8_000_000

WORD = re.compile(r"[^\W_]+")
_BASE = 0x9E3779B97F4A7C15
_BACK = np.uint64(pow(_BASE, -1, 1 << 64))

Tile = tuple[int, int, int]  # start in the document, start in the item, words


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class Runs:
    """Karp-Rabin hashes, modulo 2**64, of all runs of numbers of a sequence, from one prefix sum."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        powers = np.full(n, _BASE, np.uint64)
        back = np.full(n, _BACK, np.uint64)
        powers[:1] = back[:1] = 1
        powers, self.back = np.cumprod(powers), np.cumprod(back)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * powers)))

    def of(self, at: np.ndarray, width: int) -> np.ndarray:
        """Hashes of the runs of ``width`` numbers that begin at ``at``."""
        return (self.sums[at + width] - self.sums[at]) * self.back[at]


def run_hashes(ids: np.ndarray, width: int) -> np.ndarray:
    """The hashes of all runs of ``width`` numbers."""
    return Runs(ids).of(np.arange(max(0, len(ids) - width + 1)), width)


def _open_lengths(free: np.ndarray) -> np.ndarray:
    """For each place, how many free words follow one another from it."""
    n = len(free)
    stop = np.where(free, n, np.arange(n))
    return np.minimum.accumulate(stop[::-1])[::-1] - np.arange(n)


def tiles(doc: np.ndarray, item: np.ndarray, least: int = MIN_MATCH) -> list[Tile]:
    """Greedy tiling of two sequences of numbers: longest first, of equals the first in the document, then in the item.

    Negative numbers match nothing. Each length of a tile costs a binary search over lengths, and each step of
    that two sets of hashes; runs of one length are then marked in one walk over their places.
    """
    free_d, free_i = doc >= 0, item >= 0
    hash_d, hash_i = Runs(doc), Runs(item)
    out: list[Tile] = []
    most = len(item)
    while True:
        open_d, open_i = _open_lengths(free_d), _open_lengths(free_i)

        def shared(width: int, open_d=open_d, open_i=open_i):
            """Places of open runs of this width that both have, with their hashes; none where there are none."""
            at_i = np.flatnonzero(open_i >= width)
            at_d = np.flatnonzero(open_d >= width) if len(at_i) else at_i
            if not len(at_d):
                return None
            h_i, h_d = hash_i.of(at_i, width), hash_d.of(at_d, width)
            hit = np.isin(h_d, h_i)
            return (at_d[hit], h_d[hit], at_i, h_i) if hit.any() else None

        low, high, found = least, min(most, int(open_d.max(initial=0)), int(open_i.max(initial=0))), None
        while low <= high:  # a shared run holds shorter ones, so lengths can be halved
            middle = (low + high) // 2
            if (here := shared(middle)) is None:
                high = middle - 1
            else:
                low, found, width = middle + 1, here, middle
        if found is None:
            return out
        at_d, h_d, at_i, h_i = found
        places: dict[int, list[int]] = {}
        for h, p in zip(h_i[::-1].tolist(), at_i[::-1].tolist(), strict=True):
            places.setdefault(h, []).append(p)
        free_until = 0
        for h, d in zip(h_d.tolist(), at_d.tolist(), strict=True):
            if d < free_until:
                continue
            left = places.get(h)
            while left and not free_i[left[-1] : left[-1] + width].all():
                left.pop()
            if left and np.array_equal(doc[d : d + width], item[left[-1] : left[-1] + width]):
                p = left[-1]
                free_d[d : d + width] = free_i[p : p + width] = False
                free_until = d + width
                out.append((d, p, width))
        most = width - 1


class Block:
    """Items of one block with their seeds."""

    def __init__(self, items: list[tuple[int, str]], least: int = MIN_MATCH):
        self.least = least
        self.names: dict[str, int] = {}
        self.ids, self.items = [], []
        for item_id, text in items:
            w = words(text)
            if w:
                self.ids.append(item_id)
                self.items.append(np.array([self.names.setdefault(x, len(self.names)) for x in w], np.int64))
        #: Items shorter than a seed must be found whole; by width, hash to items.
        self.seeds: dict[int, dict[int, set[int]]] = {}
        self.own: list[np.ndarray] = []
        for k, x in enumerate(self.items):
            by = self.seeds.setdefault(min(least, len(x)), {})
            self.own.append(run_hashes(x, min(least, len(x))))
            for h in self.own[-1].tolist():
                by.setdefault(h, set()).add(k)
        self.hashes = {width: np.array(sorted(by), np.uint64) for width, by in self.seeds.items()}

    def found(self, text: str | None, coverage: float = 0.0) -> Iterator[tuple[int, int, int, int, int]]:
        """``(item_id, words, covered, tiles, longest)`` for each item that shares a seed with the text and is covered enough."""
        get = self.names.get
        doc = np.array([get(w, -1) for w in words(text)], np.int64)
        open_ = _open_lengths(doc >= 0)
        places = np.flatnonzero(open_)
        if not len(places):
            return
        runs = Runs(doc)
        for width, hashes in self.hashes.items():
            at = places[open_[places] >= width]
            h = runs.of(at, width)
            ok = hashes[np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)] == h
            at, h = at[ok], h[ok]
            known = np.unique(h)
            by = self.seeds[width]
            for k in sorted(set().union(*(by[x] for x in known.tolist()))) if len(known) else ():
                item = self.items[k]
                if _covered(np.flatnonzero(np.isin(self.own[k], known)), width) < coverage * len(item):
                    continue  # its seeds in the text do not reach far enough, so no tiling does
                mine = at[np.isin(h, self.own[k])]
                near = np.cumsum(np.bincount(mine, minlength=len(doc) + 1) - np.bincount(mine + width, minlength=len(doc) + 1))
                part_at = np.flatnonzero(near[:-1])  # tiles lie within seeds, one after the other
                part = np.insert(doc[part_at], np.flatnonzero(np.diff(part_at) > 1) + 1, -1)
                made = tiles(part, item, width)
                covered = sum(n for *_, n in made)
                if made and covered >= coverage * len(item):
                    yield self.ids[k], len(item), covered, len(made), max(n for *_, n in made)


def _covered(starts: np.ndarray, width: int) -> int:
    """Places under runs of ``width`` that begin at the sorted ``starts``."""
    return int(np.minimum(np.diff(starts), width).sum()) + width if len(starts) else 0


def blocks(benchmark: DataFrame, item_id: str, text: str, most_items: int = BLOCK_ITEMS, most_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    held, size = [], 0
    for r in benchmark.select(item_id, text).where(F.col(text).isNotNull()).distinct().orderBy(item_id, text).toLocalIterator():
        if held and (len(held) >= most_items or size + len(r[1]) > most_chars):
            yield held
            held, size = [], 0
        held.append((r[0], r[1]))
        size += len(r[1])
    if held:
        yield held


def _sharing(spark, block: list[tuple[int, str]]):
    return spark.sparkContext.broadcast(block)  # bounded by the block's limits


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", least: int = MIN_MATCH, coverage: float = MIN_COVERAGE, **limits) -> DataFrame:
    """``(doc_id, item_id, n_words, n_covered, n_tiles, longest, coverage)`` for items covered enough by a document.

    ``coverage`` is the share of the item's words under tiles. Null and empty texts and items match nothing; an item
    of fewer words than ``least`` must be found whole. Very long texts are tiled whole, and only around shared seeds. Of equally long
    tiles the first in the document, then in the item, is marked. Repeated rows of documents give repeated results, repeated items count
    once. Empty tables give an empty result. Columns besides ids and texts are ignored.

    A benchmark of more than one block takes a pass over the documents for each; its results are written before the next block is
    shared, so the driver holds one block at a time.
    """
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("item_id", benchmark.schema[item_id].dataType),
        *(T.StructField(n, T.LongType()) for n in ("n_words", "n_covered", "n_tiles", "longest")),
        T.StructField("coverage", T.DoubleType()),
    ])
    slim = docs.select("doc_id", F.col(text).alias("text"))
    spark = docs.sparkSession

    def against(shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_type

            known = Block(shared.value, least)
            kinds = [to_arrow_type(f.dataType) for f in schema.fields]
            for b in slices(batches):
                rows = [(i, *m, m[2] / m[1]) for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for m in known.found(x, coverage)]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=schema.names)

        return slim.mapInArrow(run, schema)

    parts = _each_block(spark, blocks(benchmark, item_id, item_text, **limits), against, "matches")
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], schema)


def _each_block(spark, found: Iterator[list[tuple[int, str]]], against, name: str) -> list[DataFrame]:
    """``against`` of each block; a single one stays lazy, of several each is written and then let go."""
    block, parts = next(found, None), []
    while block is not None:
        following = next(found, None)
        shared = _sharing(spark, block)
        if following is None and not parts:
            return [against(shared)]
        parts.append(materialize(against(shared), name))
        shared.unpersist()
        block = following
    return parts


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", least: int = MIN_MATCH, coverage: float = MIN_COVERAGE, **limits) -> DataFrame:
    """``docs`` without the rows whose text covers an item. Rows are judged by their text alone, repeated ones each.

    A benchmark of one block filters in one pass without a shuffle. Of several blocks each gives the hashes (256 bits) of the texts that leak,
    and one anti join takes all of them away. Nulls, empty and very long texts, ties and empty tables as in ``matches``.
    """
    found = blocks(benchmark, item_id, item_text, **limits)
    block = next(found, None)
    if block is None:
        return docs
    following = next(found, None)

    def clean(b: pa.RecordBatch, known: Block) -> pa.Array:
        return pa.array([next(known.found(x, coverage), None) is None for x in b.column(text).to_pylist()], pa.bool_())

    if following is None:
        shared = _sharing(docs.sparkSession, block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Block(shared.value, least)
            for b in slices(batches):
                yield b.filter(clean(b, known))

        return docs.mapInArrow(run, docs.schema)
    key = free_name(docs, "__leak")
    slim = docs.select(F.col(text).alias("text")).where("text is not null")
    hits = [d.select(key).distinct() for d in _each_block(docs.sparkSession, _joined(block, following, found), lambda shared: _leaking(slim, shared, least, coverage, key), "leaks")]
    gone = reduce(DataFrame.union, hits).distinct()
    return docs.withColumn(key, F.sha2(F.col(text), 256)).join(gone, key, "left_anti").select(docs.columns)


def _joined(first, second, rest: Iterator) -> Iterator:
    yield first
    yield second
    yield from rest


def _leaking(slim: DataFrame, shared, least: int, coverage: float, key: str) -> DataFrame:
    """SHA-256 of each text that covers an item of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        known = Block(shared.value, least)
        for b in slices(batches):
            found = [hashlib.sha256(x.encode("utf-8")).hexdigest() for x in b.column(0).to_pylist() if next(known.found(x, coverage), None) is not None]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=[key])

    return slim.mapInArrow(run, T.StructType([T.StructField(key, T.StringType())]))
