"""Exact substring deduplication: bytes covered by a string of ``LENGTH`` bytes that starts elsewhere too.

Sharding. Every window of ``LENGTH`` bytes picks one anchor, the short substring in it with the smallest hash
(the leftmost of equals). Equal windows pick equal anchors at equal offsets, so windows of different anchors never
need to meet. Neighbouring windows with one anchor form a context; equal contexts are counted before any text
moves, and a context found twice is covered whole, however many copies there are. Only anchors with two or more different
contexts need more: their contexts, each once, go to the shard of the anchor.

A shard runs induced sorting over its contexts and computes permuted common prefixes. A window repeats if it shares
``LENGTH`` bytes with its neighbour among the windows in suffix order. Shards are cut between anchors, so memory is bounded
by ``SHARD_BYTES`` and by one anchor's contexts; an anchor with more than ``HOT_CONTEXTS`` different ones takes
another exact way, a count over hashes of its windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm._common import materialize, slices
from tidewright.llm.suffixes import permuted_common_prefixes, suffix_array

LENGTH = 200
ANCHOR = 32
SHARD_BYTES = 3_000_000
HOT_CONTEXTS = 10_000
#: Texts are read in stretches of this many bytes, which overlap by a window.
STRETCH_BYTES = 1 << 23
_POSITION = np.uint64((1 << 24) - 1)
_LETTERS = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))


def _anchor_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all substrings of ``width`` bytes (a power of two)."""
    h, size = _LETTERS[data], 1
    while size < width:
        h = (h[: len(h) - size] * _MIX[0] ^ (h[: len(h) - size] >> np.uint64(29))) + h[size:]
        size *= 2
    h ^= h >> np.uint64(31)
    h *= _MIX[1]
    return h ^ (h >> np.uint64(30))


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[: len(x) - size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def contexts(data: bytes, length: int = LENGTH, anchor: int = ANCHOR) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Anchor hashes, first window and number of windows of each context of a text, stretch by stretch."""
    for at in range(0, max(1, len(data) - length + 1), STRETCH_BYTES):
        part = np.frombuffer(data[at : at + STRETCH_BYTES + length - 1], np.uint8)
        if len(part) < length:
            return
        h = _anchor_hashes(part, anchor)
        keys = (h & ~_POSITION) | np.arange(len(h), dtype=np.uint64)
        chosen = (_sliding_least(keys, length - anchor + 1) & _POSITION).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
        count = np.diff(np.concatenate((first, [len(chosen)])))
        yield h[chosen[first]], first + at, count


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


_LONG, _INT = T.LongType(), T.IntegerType()


def _occurrences(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """``(anchor, context, k1, k2, firsts, windows)``: where each context of each row begins; ``context`` is a hash.

    A context that a row repeats (a line said again and again) is one row here, with all its places.
    """
    kinds = (("anchor", _LONG), ("context", _LONG), ("k1", _LONG), ("k2", _LONG), ("firsts", T.ArrayType(_INT)), ("windows", _INT))
    schema = T.StructType([T.StructField(n, k) for n, k in kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        for b in slices(batches):
            k1, k2 = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            rows, parts = [], []
            for i, text in enumerate(b.column(2)):
                data = text.as_buffer().to_pybytes()
                for h, first, count in contexts(data, length, anchor) if len(data) >= length else ():
                    own = np.fromiter((digest(data[a:e]) for a, e in zip(first.tolist(), (first + count + length - 1).tolist(), strict=True)), np.uint64, len(first))
                    parts.append((h, own, first, count))
                    rows += [i] * len(first)
            if parts:
                h, own, first, count = (np.concatenate(x) for x in zip(*parts, strict=True))
                row = np.array(rows)
                order = np.lexsort((first, h, own, row))
                h, own, first, count, row = h[order], own[order], first[order], count[order], row[order]
                head = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (h[1:] != h[:-1]) | (row[1:] != row[:-1]))))
                firsts = pa.ListArray.from_arrays(pa.array(np.concatenate((head, [len(h)])).astype(np.int32)), pa.array(first.astype(np.int32)))
                plain = [pa.array(x) for x in (_signed(h)[head], _signed(own)[head], k1[row[head]], k2[row[head]], count[head].astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*plain[:4], firsts, plain[4]], names=schema.names)

    return docs.mapInArrow(run, schema)


def repeated_windows(texts: list[bytes], windows: list[int], length: int) -> list[list[tuple[int, int]]]:
    """For each context, runs of windows (first, end) that some other window of the shard equals."""
    offsets = np.cumsum([0, *(len(x) + 1 for x in texts)])
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int64) + 1
    data[offsets[1:] - 1] = 0
    data = np.minimum(data, 255)  # bytes of UTF-8 end at 0xF4
    data = data.astype(np.uint8)
    sa = suffix_array(data)
    prefixes = permuted_common_prefixes(data, sa)
    valid = np.zeros(len(data), bool)
    for o, w in zip(offsets.tolist(), windows, strict=False):
        valid[o : o + w] = True
    at = np.flatnonzero(valid[sa])
    if len(at) < 2:
        return [[] for _ in texts]
    common = np.minimum.reduceat(prefixes[sa][: at[-1] + 1], at[:-1] + 1) >= length
    hit = np.zeros(len(data) + 1, bool)
    hit[sa[at[1:]][common]] = True
    hit[sa[at[:-1]][common]] = True
    step = np.diff(np.concatenate(([False], hit)).astype(np.int8))
    begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    owner = np.searchsorted(offsets, begin, "right") - 1
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    for k, a, e in zip(owner.tolist(), begin.tolist(), end.tolist(), strict=True):
        out[k].append((a - int(offsets[k]), e - int(offsets[k])))
    return out


_SPAN = T.StructType([T.StructField("anchor", _LONG), T.StructField("context", _LONG), T.StructField("a", _INT), T.StructField("e", _INT)])


def _sort_shards(found: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """``(anchor, context, a, e)``: runs of repeated windows of each context, from suffix arrays."""
    dealt = found.repartition("anchor").sortWithinPartitions("anchor", "context")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[bytes, int]] = {}
        size, last = 0, None

        def out():
            spans = repeated_windows([x for x, _ in held.values()], [w for _, w in held.values()], length)
            flat = [(*k, a, e) for k, s in zip(held, spans, strict=True) for a, e in s]
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in flat], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=_SPAN.names)

        for b in batches:
            for anchor, context, text, windows in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if size >= shard_bytes and anchor != last:
                    yield out()
                    held.clear()
                    size = 0
                if (anchor, context) not in held:  # a repeated row gives its context twice
                    held[anchor, context] = (text, windows)
                    size += len(text)
                last = anchor
        if held:
            yield out()

    return dealt.mapInArrow(run, _SPAN)


def _count_windows(found: DataFrame, length: int) -> DataFrame:
    """The same as ``_sort_shards`` for anchors with very many contexts, by counting hashes of windows."""
    schema = T.StructType([T.StructField(n, _LONG) for n in ("w1", "w2", "anchor", "context")] + [T.StructField("a", _INT)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in slices(batches, 64):
            rows = []
            for anchor, context, text, windows in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                for a in range(windows):
                    w = xxhash.xxh3_128_intdigest(text[a : a + length])
                    rows.append(((w >> 64) - (1 << 63), (w & ((1 << 64) - 1)) - (1 << 63), anchor, context, a))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int32() if i == 4 else pa.int64()) for i in range(5)], names=schema.names)

    windows = found.dropDuplicates(["anchor", "context"]).mapInArrow(run, schema)
    again = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").select("w1", "w2")
    return windows.join(again, ["w1", "w2"], "left_semi").select("anchor", "context", "a", (F.col("a") + 1).alias("e"))


COUNTS = ("n_bytes", "n_removed", "n_spans")


def cut(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left of ``data`` without the spans, and the number of maximal removed runs."""
    out, at, runs = [], 0, 0
    for a, e in sorted(spans):
        if a > at or not runs:
            out.append(data[at:a])
            runs += 1
        at = max(at, e)
    return b"".join([*out, data[at:]]), runs


def covered_spans(slim: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES, hot: int = HOT_CONTEXTS) -> DataFrame:
    """``(k1, k2, spans)`` for each row key with covered bytes, from ``(k1, k2, data)``."""
    occurrences = materialize(_occurrences(slim, length, anchor), "contexts")
    places = F.sum(F.size("firsts"))
    # written first, so that both sides of the join are plain shuffles and a hot anchor can be split
    again = materialize(occurrences.groupBy("anchor").agg(places.alias("n")).where("n > 1").select("anchor"), "repeated-anchors")
    occurrences = materialize(occurrences.join(again, "anchor", "left_semi"), "repeated-contexts")
    where = F.struct("k1", "k2", F.get("firsts", F.lit(0)).alias("first"), "windows")
    distinct = materialize(occurrences.groupBy("anchor", "context").agg(places.alias("n"), F.min(where).alias("at")), "distinct-contexts")
    several = distinct.groupBy("anchor").agg(F.count("*").alias("contexts")).where("contexts > 1")
    wanted = distinct.join(several, "anchor").select("anchor", "context", "contexts", "at.*")
    place = F.struct("anchor", "context", "contexts", "first", "windows")
    by_row = wanted.groupBy("k1", "k2").agg(F.collect_list(place).alias("places"))  # as many as one text has contexts
    schema = T.StructType([T.StructField("anchor", _LONG), T.StructField("context", _LONG), T.StructField("data", T.BinaryType()), T.StructField("windows", _INT), T.StructField("contexts", _LONG)])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for b in slices(batches, 64):
            rows = []
            for k1, k2, data, places in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if (k1, k2) != before:  # repeated rows come one after the other, and one of them is enough
                    rows += [(p["anchor"], p["context"], data[p["first"] : p["first"] + p["windows"] + length - 1], p["windows"], p["contexts"]) for p in places]
                before = (k1, k2)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()))], names=schema.names)

    found = slim.join(by_row, ["k1", "k2"]).select("k1", "k2", "data", "places").mapInArrow(extract, schema)
    found = materialize(found, "context-texts")
    spans = _sort_shards(found.where(F.col("contexts") <= hot).drop("contexts"), length, shard_bytes)
    if not found.where(F.col("contexts") > hot).isEmpty():
        spans = spans.union(_count_windows(found.where(F.col("contexts") > hot).drop("contexts"), length))
    once = distinct.where("n = 1").select("anchor", "context")
    spans = spans.join(once, ["anchor", "context"], "left_semi").union(distinct.where("n > 1").select("anchor", "context", F.lit(0), F.col("at.windows")))
    spans = spans.groupBy("anchor", "context").agg(F.collect_list(F.struct("a", "e")).alias("s"))  # one context's windows at most
    placed = occurrences.join(materialize(spans, "context-spans"), ["anchor", "context"])
    placed = placed.select("k1", "k2", "s", F.explode("firsts").alias("first")).select("k1", "k2", "first", F.explode("s").alias("s")).select("k1", "k2", "first", "s.a", "s.e")
    span = F.struct((F.col("first") + F.col("a")).alias("a"), (F.col("first") + F.col("e") + F.lit(length - 1)).alias("e"))
    return placed.groupBy("k1", "k2").agg(F.collect_set(span).alias("spans"))  # a set: repeated rows give the same spans


def _slim(docs: DataFrame, text: str) -> DataFrame:
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    # ids of any type; a null id is a key like any other, and equal ids with unequal texts are told apart by the text's hash
    return docs.select("doc_id", F.xxhash64(F.col("doc_id").cast("string")).alias("k1"), F.xxhash64(data).alias("k2"), data.alias("data"))


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, anchor: int = ANCHOR, **limits) -> DataFrame:
    """``doc_id`` and ``kept`` (binary) with ``n_bytes``, ``n_removed`` and ``n_spans`` for each row.

    Texts are UTF-8 bytes; a null text is empty. Matches never cross documents, overlaps count, and strings are judged on
    the input. Texts shorter than ``length`` stay whole, very long ones are read in overlapping stretches. Repeated rows are documents
    of their own, so all of their windows repeat. Ids may be of any type, null and tied. An empty table gives an empty result; other
    columns are ignored.
    """
    slim = _slim(docs, text)
    spans = covered_spans(slim.select("k1", "k2", "data"), length, anchor, **limits)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(n, _LONG) for n in COUNTS), T.StructField("kept", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 256):
            rows = []
            for data, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                kept, runs = cut(data, [(s["a"], s["e"]) for s in found or ()])
                rows.append((len(data), len(data) - len(kept), runs, kept))
            made = [pa.array([r[k] for r in rows], pa.int64() if k < 3 else pa.binary()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([b.column(0), *made], names=schema.names)

    return slim.join(spans, ["k1", "k2"], "left").select("doc_id", "data", "spans").mapInArrow(run, schema)


def removal_digests(docs: DataFrame, **how) -> DataFrame:
    """``remove_repeats`` with the SHA-256 of the remaining bytes in place of the bytes."""
    return remove_repeats(docs, **how).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


__all__ = ["covered_spans", "cut", "remove_repeats", "removal_digests"]
