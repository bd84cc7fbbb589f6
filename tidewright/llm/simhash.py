"""SimHash near-duplicate groups through deletion-variant signatures.

A 64-bit fingerprint is cut into three segments. Of two fingerprints that differ in at most four
bits, one segment differs in at most one bit (4 // 3 = 1), so deleting the right bit of that segment leaves
equal values. Every segment is indexed once for each of its bits with that bit deleted, 64 entries
a fingerprint; entries with the same segment, deleted bit and value meet in an equality shuffle,
where the whole fingerprints are compared. ``take`` joins several of more, smaller segments into
one key, which makes keys longer (fewer chance meetings) for corpora of billions of texts.

Only distinct fingerprints are indexed, so a group of exact copies of any size counts once. Within an
entry a spanning forest is emitted, never all pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm._common import map_texts, materialize
from tidewright.llm.components import connected_components

BITS = 64
RADIUS = 4
SHINGLE = 4
SEED = 42
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text; zero without words."""
    import xxhash

    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z only, and the six ASCII blanks
    n = max(1, len(words) - shingle + 1)
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[-n:].tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, _CHUNK):  # a long text needs no more memory than a chunk of its shingles
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK], strict=True)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", name: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without its text column, plus the fingerprint as a signed 64-bit integer."""

    def start():
        def work(texts):
            return {name: [(f := fingerprint(x, shingle)) - ((f >> 63) << 64) for x in texts]}

        return work

    return map_texts(docs, start, T.StructType([T.StructField(name, T.LongType())]), text)


def segment_masks(segments: int, take: int, radius: int) -> list[int]:
    """Bit masks of every choice of ``take`` segments out of ``segments``.

    Raises if some way to spread ``radius`` differing bits leaves every choice with two or more.
    """
    spread = [radius // segments + (i < radius % segments) for i in range(segments)]
    if sum(sorted(spread)[:take]) > 1:
        raise ValueError("these segments do not guarantee a choice with at most one differing bit")
    cuts = [BITS * i // segments for i in range(segments + 1)]
    masks = [(1 << b) - (1 << a) for a, b in itertools.pairwise(cuts)]
    return [sum(c) for c in itertools.combinations(masks, take)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def variants(fps: DataFrame, name: str = "fp", segments: int = 3, take: int = 1, radius: int = RADIUS) -> DataFrame:
    """One row ``(variant, key, fp)`` for each deleted bit of each segment choice."""
    rows = []
    for mask in segment_masks(segments, take, radius):
        for bit in (b for b in range(BITS) if mask >> b & 1):
            rows.append(F.struct(F.lit(len(rows)).alias("variant"), F.col(name).bitwiseAND(F.lit(_signed(mask & ~(1 << bit)))).alias("key")))
    return fps.select(F.explode(F.array(*rows)).alias("v"), F.col(name).alias("fp")).select("v.variant", "v.key", "fp")


def forest(values: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Edges (root, member) that connect exactly what links within ``radius`` connect."""
    edges, left = [], values
    if values.size <= 128:
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius
        if np.count_nonzero(near) == values.size:
            return edges
    while left.size > 1:
        root, left = left[0], left[1:]
        queue = [root]
        while queue and left.size:
            near = np.bitwise_count(left ^ queue.pop()) <= radius
            if near.any():
                hit, left = left[near], left[~near]
                queue.extend(hit)
                edges.extend((int(root), int(x)) for x in hit)
    return edges


def links(fps: DataFrame, name: str = "fp", segments: int = 3, take: int = 1, radius: int = RADIUS) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints that connect all pairs within ``radius``.

    ``fps`` must hold each fingerprint once.
    """
    index = variants(fps, name, segments, take, radius)
    dealt = index.repartition(F.col("variant"), F.col("key")).sortWithinPartitions("variant", "key")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the open entry, which may go on in the next batch
        mark = None

        def out(edges):
            return pa.RecordBatch.from_arrays([pa.array([_signed(e[i]) for e in edges], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            v, k, f = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            f = f.astype(np.int64).view(np.uint64)
            if not len(f):
                continue
            cut = np.flatnonzero((np.diff(v) != 0) | (np.diff(k) != 0)) + 1
            edges: list[tuple[int, int]] = []
            begins, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(f)]))
            if mark != (v[0], k[0]):
                if held:
                    edges += forest(np.concatenate(held), radius)
                held = []
            if len(begins) == 1:
                held.append(f)
            else:
                held.append(f[: ends[0]])
                edges += forest(np.concatenate(held), radius)
                held = [f[begins[-1] :]]
                inner_b, inner_e = begins[1:-1], ends[1:-1]
                size = inner_e - inner_b
                two = inner_b[size == 2]
                near = np.bitwise_count(f[two] ^ f[two + 1]) <= radius
                edges += [(int(f[i]), int(f[i + 1])) for i in two[near]]
                for b, e in zip(inner_b[size > 2].tolist(), inner_e[size > 2].tolist(), strict=True):
                    edges += forest(f[b:e], radius)
            mark = (v[-1], k[-1])
            if edges:
                yield out(list(dict.fromkeys(edges)))
        if held and (edges := forest(np.concatenate(held), radius)):
            yield out(edges)

    return dealt.mapInArrow(run, schema).distinct()


def near_duplicate_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS, segments: int = 3, take: int = 1, shingle: int = SHINGLE
) -> DataFrame:
    """One row per row of ``docs``: its id, ``fp`` and ``component_id``.

    ``component_id`` is the smallest id reachable over links of at most ``radius`` differing bits.
    Null and empty texts and texts of blanks have fingerprint zero and link like any other. A text
    shorter than a shingle counts as one shingle. Repeated rows stay repeated. Null ids take part
    but never become a component id (null if a whole component has none). An empty table gives an empty
    result; other columns are ignored.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prints = materialize(with_fingerprints(slim, shingle=shingle), "fingerprints")
    own = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    grouped = connected_components(links(own.select("fp"), segments=segments, take=take, radius=radius))
    member = own.join(grouped.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    member = materialize(member, "members")
    lowest = member.groupBy("root").agg(F.min("low").alias("component_id"))
    by_print = member.join(lowest, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def keep_one_per_group(docs: DataFrame, **how) -> DataFrame:
    """The row of ``docs`` with the smallest id in each near-duplicate group.

    Rows without an id are kept, as nothing tells them apart. Of repeated rows with one id, one stays.
    Columns and their order are those of ``docs``.
    """
    groups = near_duplicate_groups(docs, **how)  # the id column must be named doc_id here
    first = groups.where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])  # one shuffle serves both
    return kept.select(docs.columns).unionByName(docs.where("doc_id is null"))
