"""Runs: stretches of words that repeat with a period, four times or more.

Periods are taken by octaves ``[P, 2P)``. A document is cut for each octave in overlapping tiles around boundaries ``P`` words apart, and a tile is solved without
the rest of the document: from each boundary a Z-function forward and one backward tell how far each period of the octave holds. What a
tile sees of a run is a fragment of it. Fragments are shuffled by document and period and stitched: pieces of one run share a
period's length of words at least, pieces of different runs less.

A run of period ``q`` in ``[P, 2P)`` and at least ``4q`` words repeats, from each boundary in it but the last ones, ``2P`` words ``q`` further on. Rolling
hashes of all blocks of ``2P`` words are compared before tiles are cut, so only boundaries where some period holds become rows of a
tile; text without repetition costs a few array comparisons. Hashes only choose boundaries: they never miss one, and what they let through is decided
by the words. In all a document takes time in proportion to its words and the number of octaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewright.llm._common import materialize, slices

LEAST_WORDS, REPEATS = 6, 4
#: Words of a tile, about, where an octave's windows are shorter.
TILE = 4096
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64)] * 2


def words_of(doc_id, text: str | None) -> list[bytes]:
    """The words of a text, without the six ASCII blanks."""
    return (text or "").encode("utf-8").split()


def _power(of: int, n: int) -> np.ndarray:
    """Powers of the base or of its inverse, modulo 2^64."""
    if len(_powers[of]) < n:
        x = np.full(max(n, 1 << 12), (_BASE, _INVERSE)[of], np.uint64)
        x[0] = 1
        _powers[of] = np.cumprod(x)
    return _powers[of][:n]


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers, equal for equal words of one text."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words))


def tiles(ids: np.ndarray) -> list[dict]:
    """``{octave, base, at, ids}``: stretches of words from ``base`` on and the boundaries ``at`` in them at which some period of the octave holds."""
    n, out = len(ids), []
    if n < LEAST_WORDS:
        return out
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) * _power(1, n)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)))
    starts = lambda c, size: (sums[c + size] - sums[c]) * _power(0, n)[c]  # hashes of stretches
    octave, known = 1, []
    while REPEATS * octave <= n:
        width = 2 * octave
        blocks = (sums[width:] - sums[:-width]) * _power(0, n - width + 1)
        at = np.arange(0, n - 3 * octave + 1, octave)
        padded = np.concatenate((blocks, np.zeros(2 * octave, np.uint64)))
        following = np.lib.stride_tricks.sliding_window_view(padded[octave:], octave)[::octave][: len(at)]
        hit = following == blocks[at][:, None]
        found, periods = at[hit.any(axis=1)], hit.argmax(axis=1)[hit.any(axis=1)] + octave
        for d in known:  # where a shorter period holds all along, those of this octave are multiples of it
            whole = np.minimum(4 * octave, n - found) - d
            fresh = starts(found, whole) != starts(found + d, whole)
            found, periods = found[fresh], periods[fresh]
        known += np.unique(periods).tolist()
        each = max(4, TILE // octave) * octave
        for part in np.split(found, np.flatnonzero(np.diff(found // each)) + 1) if len(found) else ():
            low, high = max(0, int(part[0]) - octave), min(n, int(part[-1]) + 5 * octave)
            out.append({"octave": octave, "base": low, "at": part - low, "ids": ids[low:high]})
        octave *= 2
    return out


def z_function(x: list) -> list[int]:
    """For each place how many items from it on equal those from the start on."""
    n = len(x)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        if i + k >= right:  # else the match ends inside the known stretch
            while i + k < n and x[k] == x[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def _primitive(periods: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Which periods' first stretch is no power of a shorter one, given the Z-function from its start."""
    good = np.ones(len(periods), bool)
    if not len(periods):
        return good
    done: list[int] = []
    half = periods[-1] // 2
    for d in (np.flatnonzero(z[1 : half + 1] >= np.arange(1, half + 1)) + 1).tolist():  # squares at the start: few have a primitive root
        if any(d % e == 0 and z[e] >= d - e for e in done):
            continue
        done.append(d)
        good &= (periods % d != 0) | (periods == d) | (z[d] < periods - d)
    return good


def fragments(octave: int, at: list[int], ids: list[int]) -> list[tuple[int, int, int]]:
    """``(period, start, end)`` of what the tile holds of each run with a primitive period of the octave, pieces of one run joined.

    A fragment that reaches the end of its boundary's window is followed on in the tile. Boundaries inside it that see nothing but it are passed over: two periods of
    an octave that hold for four times its length have a common divisor that holds too.
    """
    found: dict[int, list[list[int]]] = {}
    whole, n = np.array(ids, np.int32), len(ids)
    inside: list[tuple[int, int]] = []
    for c in at:
        if any(a <= c and b >= min(c + 4 * octave, n) for a, b in inside):
            continue
        ahead = ids[c : c + 5 * octave]
        z = np.array(z_function(ahead))
        low = max(0, c - octave)
        before, end = ids[low:c][::-1], min(n, c + 2 * octave)
        back = np.array(z_function([*before, -1, *ids[low:end][::-1]]))[len(before) + 1 :]
        periods = np.arange(octave, min(2 * octave, len(ahead), end - c + 1))
        forward, backward = z[periods], np.minimum(back[end - c - periods], len(before))
        holds = forward + backward >= periods
        periods, forward, backward = periods[holds], forward[holds], backward[holds]
        good = _primitive(periods, z)
        inside = []
        for q, f, b in zip(periods[good].tolist(), forward[good].tolist(), backward[good].tolist(), strict=True):
            start, stop = c - b, c + q + f
            if stop == c + len(ahead) < n:
                other = np.flatnonzero(whole[stop:] != whole[stop - q : n - q])
                stop = stop + int(other[0]) if len(other) else n
            inside.append((start, stop))
            pieces = found.setdefault(q, [])
            if pieces and start <= pieces[-1][1] - q:
                pieces[-1][1] = max(pieces[-1][1], stop)
            else:
                pieces.append([start, stop])
    return [(q, a, b) for q, pieces in found.items() for a, b in pieces]


_TILES = T.ArrayType(T.StructType([T.StructField("octave", T.IntegerType()), T.StructField("base", T.IntegerType()), T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("ids", T.ArrayType(T.IntegerType()))]))
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _solved(dealt: DataFrame) -> DataFrame:
    """Fragments ``(row, period, start, end)`` of tiles ``(row, octave, base, at, ids)``."""
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("row", "period", "start", "end")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            rows = [(row, q, base + s, base + e) for row, octave, base, at, ids in zip(*(c.to_pylist() for c in b.columns), strict=True) for q, s, e in fragments(octave, at, ids)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names=schema.names)

    return dealt.mapInArrow(run, schema)


def stitched(pieces: DataFrame) -> DataFrame:
    """Runs ``(row, start, length, period)`` of fragments: those that share a period's length or more are one; the shortest period of a stretch stands."""
    order = Window.partitionBy("row", "period").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("start") <= reach - F.col("period"), 0).otherwise(1)
    whole = pieces.withColumn("begins", begins).withColumn("run", F.sum("begins").over(order)).groupBy("row", "period", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start")
    return whole.where(length >= F.greatest(F.lit(LEAST_WORDS), REPEATS * F.col("period"))).groupBy("row", "start", "end").agg(F.min("period").alias("period")).select("row", "start", length.alias("length"), "period")


def periodic_runs(docs: DataFrame, text: str = "text", words: Callable = words_of) -> DataFrame:
    """``(doc_id, n_words, runs, text, plain_sha256)`` for each row; ``runs`` lists ``(start, length, period)`` by start, then period.

    A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are identical) and at least ``max(6, 4q)`` words that no neighbouring word extends.
    ``words`` gives the words of an id and a text. ``text`` is there only for rows that may have runs; for the others ``plain_sha256`` digests their words, joined by a space. A null or
    empty text has no words and no runs. Texts of any length are taken whole. Rows are told apart by themselves, so repeated rows and null ids stay; an empty table gives an empty result.
    """
    slim = docs.select("doc_id", F.col(text).alias("text"))
    schema = T.StructType([T.StructField("doc_id", slim.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()), T.StructField("text", T.StringType()), T.StructField("plain_sha256", T.StringType()), T.StructField("tiles", _TILES)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kind = to_arrow_type(_TILES)
        for b in slices(batches, 64):
            n, kept, plain, made = [], [], [], []
            for doc_id, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                w = words(doc_id, t)
                n.append(len(w))
                made.append(found := tiles(numbered(w)))
                kept.append(t if found else None)
                plain.append(None if found else hashlib.sha256(b" ".join(w)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(kept, pa.string()), pa.array(plain, pa.string()), pa.array(made, kind)], names=schema.names)

    found = materialize(slim.mapInArrow(cut, schema).withColumn("row", F.monotonically_increasing_id()), "tiles")  # numbers are fixed once written
    dealt = found.select("row", F.inline("tiles")).repartition("row", "octave", "base")
    runs = stitched(_solved(dealt)).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))  # those of one text
    return found.drop("tiles").join(runs, "row", "left").select("doc_id", "n_words", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"), "text", "plain_sha256")


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that some run holds after its first period."""
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    keep = np.cumsum(drop)[: len(words)] == 0
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k]


FIELDS = T.StructType([T.StructField(n, T.LongType()) for n in ("n_runs", "start", "length", "period", "exponent_milli")] + [T.StructField(n, T.StringType()) for n in ("runs_sha256", "collapsed_sha256")])


def run_digests(docs: DataFrame, text: str = "text", words: Callable = words_of) -> DataFrame:
    """``doc_id`` with the number of runs, the longest one (ties: smallest start, then period; nulls without one), and digests of all runs and of the text without repeats.

    Nulls, repeated rows, long texts and empty tables as in ``periodic_runs``; other columns are ignored.
    """
    found = periodic_runs(docs, text, words)
    schema = T.StructType([found.schema["doc_id"], *FIELDS.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            rows = []
            for doc_id, runs, t, plain in zip(*(b.column(n).to_pylist() for n in ("doc_id", "runs", "text", "plain_sha256")), strict=True):
                runs = [(r["start"], r["length"], r["period"]) for r in runs]
                top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
                listed = hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest()
                left = plain if t is None else hashlib.sha256(b" ".join(collapsed(words(doc_id, t), runs))).hexdigest()
                rows.append((len(runs), *top, 1000 * top[1] // top[2] if runs else None, listed, left))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[i] for r in rows], pa.string() if i > 4 else pa.int64()) for i in range(len(FIELDS)))], names=schema.names)

    return found.mapInArrow(run, schema)
