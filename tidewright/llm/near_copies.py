"""Near copies by SimHash, checked exactly: word shingles of five, Jaccard similarity of 0.8 or more.

Two texts of similarity 0.8 differ in some 15 % of the bits of their fingerprints, so no radius over 64 bits finds them all without
finding much else. Fingerprints here have 192 bits over distinct shingles, cut in twelve segments of 16. Each segment is indexed
once for each of its bits with that bit deleted, and texts of which one segment differs in at most one bit meet in an equality shuffle.
There, fingerprints that differ in more than ``RADIUS`` of their first 128 bits are dropped; what is left is a candidate, and a candidate is a link
if the exact Jaccard similarity of the shingle sets reaches the threshold. Chance meetings grow with the square of the number of distinct texts
over ``2 ** (width - 1)``; wider and more segments (``width=24, segments=31`` of ``words=12``) suit billions of texts.

An entry with few candidates gives all of them. One with more gives a minimum spanning forest first. A forest's pair may fail the exact check where another
holds, so the members of such entries meet again once the groups of the first links are known: all their candidates between different groups are checked
too, and pairs inside a group can add nothing. These candidates grow with the square of a group, so they are never rows: tasks look at them in blocks of members and
give only links that join groups. Texts with equal first 128 bits count as one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm._common import map_texts, materialize, slices
from tidewright.llm.components import connected_components
from tidewright.llm.ngram_join import _Roots

SHINGLE = 5
SIMILARITY = 0.8
WIDTH, SEGMENTS, WORDS = 16, 12, 3
#: Differing bits of 128 that a candidate may have; texts of similarity 0.8 have 18 in the middle, and more than 30 in two of a thousand.
RADIUS = 30
#: Candidates of an entry up to which all are given, members up to which all pairs are compared, and up to which a forest takes all of them in.
FEW, SMALL, MANY = 10, 64, 2048
#: In larger entries members within this radius of one taken before hang on it, and the others make the forest.
CLOSE = 16
SEED = 42
#: Bits of a text's shingle set by which pairs between groups are sorted out before the exact check.
MARKS = 1024
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(29), np.uint64(32))
_CHUNK = 1 << 13
#: Rows of the index that a task looks at together, about.
_ROWS = 1 << 16
#: Sets that one is compared with together.
_AT_ONCE = 64
#: Shingles that count as one more member where members are dealt to blocks, and pairs of members that a task looks at together, about.
_WEIGHT, _PAIRS = 256, 1 << 16


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; one of the whole sequence where there are fewer words, none without words."""
    import xxhash

    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z only, and the six ASCII blanks
    if not words:
        return np.zeros(0, np.uint64)
    digest, joined = xxhash.xxh64_intdigest, b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts, ends = np.concatenate(([0], ends[:-1] + 1))[:n].tolist(), ends[-n:].tolist()
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)), np.uint64, n))


def fingerprint(hashes: np.ndarray, words: int = WORDS) -> list[int]:
    """``words`` signed 64-bit words; a bit is one if set in over half of the mixed hashes."""
    out = []
    for k in range(words):
        ones = np.zeros(64, np.int64)
        for at in range(0, len(hashes), _CHUNK):  # a long text needs no more memory than a chunk
            x = hashes[at : at + _CHUNK]
            if k:
                x = x * np.uint64((0x9E3779B97F4A7C15 + k * 0x632BE59BD9B4E018) % (1 << 64) | 1)
                x = (x ^ (x >> _MIX[2])) * _MIX[0]
                x ^= x >> _MIX[1]
            ones += np.unpackbits(x.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0]))
    return out


def _index(prints: DataFrame, width: int, segments: int) -> DataFrame:
    """``(key, f0, f1)``: one row for each deleted bit of each segment; the key holds segment, bit and what is left."""
    keys = []
    for s in range(segments):
        word, at = divmod(s * width, 64)
        value = F.shiftrightunsigned(f"f{word}", at)
        if at + width > 64:
            value = value.bitwiseOR(F.shiftleft(f"f{word + 1}", 64 - at))
        value = value.bitwiseAND(F.lit((1 << width) - 1))
        keys += [value.bitwiseAND(F.lit(~(1 << b))).bitwiseOR(F.lit((s * width + b) << width)) for b in range(width)]
    kind = "int" if (segments * width) << width < 1 << 31 else "long"
    return prints.select(F.explode(F.array(*(k.cast(kind) for k in keys))).alias("key"), "f0", "f1")


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1)


def _forest(x: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A minimum spanning forest of the pairs within ``radius``, by growing trees from the first member that is left (rows of ``x`` are prints)."""
    n, edges = len(x), []
    near, of = np.full(n, 1 << 20), np.zeros(n, np.int64)
    left = np.arange(n)
    at = 0
    while len(left):
        i = left[at]
        if near[i] <= radius:
            edges.append((int(of[i]), int(i)))
        left = np.delete(left, at)
        if not len(left):
            break
        d = _distance(x[left], x[i])
        better = d < near[left]
        near[left[better]], of[left[better]] = d[better], i
        at = int(np.argmin(near[left]))
    return edges


def candidates(x: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """A minimum spanning forest of the members of one entry within ``radius``; in a large entry one of those taken, on which the others hang."""
    if len(x) <= MANY:
        return _forest(x, radius)
    taken: list[int] = []
    edges, left = [], np.arange(len(x))
    while len(left):
        i, left = left[0], left[1:]
        taken.append(int(i))
        hang = _distance(x[left], x[i]) <= CLOSE
        edges += [(int(i), int(j)) for j in left[hang]]
        left = left[~hang]
    at = np.array(taken)
    return edges + [(taken[a], taken[b]) for a, b in _forest(x[at], radius)]


def _spanning(pairs: np.ndarray, bits: np.ndarray) -> list[int]:
    """Which pairs make a minimum spanning forest (Kruskal); ties in the order given."""
    root: dict[int, int] = {}

    def find(i):
        while (up := root.get(i, i)) != i:
            root[i] = i = root.get(up, up)
        return i

    kept = []
    for k in np.argsort(bits, kind="stable").tolist():
        a, b = find(int(pairs[k, 0])), find(int(pairs[k, 1]))
        if a != b:
            root[b] = a
            kept.append(k)
    return kept


def _first_keys(a: np.ndarray, b: np.ndarray, width: int, segments: int) -> np.ndarray:
    """The first key that each pair of prints shares, -1 if none of the segments in their first 128 bits is alike."""
    out = np.full(len(a), -1, np.int64)
    for s in reversed(range(min(segments, 128 // width))):
        word, at = divmod(s * width, 64)

        def value(x):
            v = x[:, word] >> np.uint64(at)  # noqa: B023
            return (v | x[:, word + 1] << np.uint64(64 - at) if at + width > 64 else v) & np.uint64((1 << width) - 1)  # noqa: B023

        u = value(a)
        differ = u ^ value(b)
        one = np.maximum(differ, np.uint64(1))  # equal segments share the keys of all bits, that of the lowest first
        key = (s * width + np.bitwise_count(one - np.uint64(1)).astype(np.int64) << width) | (u & ~one).astype(np.int64)
        out = np.where(np.bitwise_count(differ) <= 1, key, out)
    return out


def _first_met(x: np.ndarray, key: int, radius: int, width: int, segments: int) -> np.ndarray:
    """The members of one entry that have a candidate which they meet in no entry before this one."""
    good, some = np.zeros(len(x), bool), max(1, _PAIRS // len(x))
    for at in range(0, len(x), some):
        a, b = np.nonzero(_distance(x[at : at + some, None], x) <= radius)
        a += at
        new = (a < b) & ~(good[a] & good[b])
        a, b = a[new], b[new]
        first = _first_keys(x[a], x[b], width, segments)
        here = (first == key) | (first < 0)
        good[a[here]] = good[b[here]] = True
    return np.flatnonzero(good)


def near_pairs(key: np.ndarray, x: np.ndarray, radius: int = RADIUS, width: int = WIDTH, segments: int = SEGMENTS) -> tuple[np.ndarray, np.ndarray]:
    """Candidates ``(i, j)`` of complete entries that lie one after the other in the order of ``key``, and members of entries that gave a forest instead of all.

    Near copies share dozens of entries, so only the members are named that have a candidate which they meet here first.
    """
    head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(head, len(key)))
    small = np.flatnonzero(np.repeat(size <= SMALL, size))
    hits, bits, shift = [np.zeros((0, 2), np.int64)], [np.zeros(0, np.int64)], 1
    while len(small):  # all pairs of the small entries, by their distance in the order
        small = small[small + shift < len(key)]
        small = small[key[small] == key[small + shift]]
        d = _distance(x[small], x[small + shift])
        hits.append(np.stack([small, small + shift], axis=1)[d <= radius])
        bits.append(d[d <= radius])
        shift += 1
    hit, bit = np.concatenate(hits), np.concatenate(bits)
    order = np.argsort(key[hit[:, 0]], kind="stable")
    hit, bit = hit[order], bit[order]
    entry = np.flatnonzero(np.concatenate(([True], np.diff(key[hit[:, 0]]) != 0))) if len(hit) else np.zeros(0, np.int64)
    count = np.diff(np.append(entry, len(hit)))
    out, cut = [hit[np.repeat(count <= FEW, count)]], [np.zeros(0, np.int64)]
    for a, n in zip(entry[count > FEW].tolist(), count[count > FEW].tolist(), strict=True):
        out.append(hit[a : a + n][_spanning(hit[a : a + n], bit[a : a + n])])
    left = hit[np.repeat(count > FEW, count)]
    first = _first_keys(x[left[:, 0]], x[left[:, 1]], width, segments)
    cut.append(np.unique(left[(first == key[left[:, 0]]) | (first < 0)]))
    for k in np.flatnonzero(size > SMALL):
        if edges := candidates(x[head[k] : head[k] + size[k]], radius):
            out.append(np.array(edges) + head[k])
            own = np.arange(head[k], head[k] + size[k])
            cut.append(own[_first_met(x[own], int(key[head[k]]), radius, width, segments)] if size[k] <= MANY else own)
    return np.concatenate(out), np.concatenate(cut)


_FOUND = T.StructType([T.StructField(n, T.LongType()) for n in ("key", "a0", "a1", "b0", "b1")])


def candidate_pairs(prints: DataFrame, width: int = WIDTH, segments: int = SEGMENTS, radius: int = RADIUS) -> tuple[DataFrame, DataFrame]:
    """Distinct candidates ``(a0, a1, b0, b1)`` between fingerprints ``(f0, f1, ...)``, which must be distinct, and the members ``(key, f0, f1)`` of entries that gave a forest which have a candidate that they meet there first."""
    dealt = _index(prints, width, segments).repartition("key").sortWithinPartitions("key", "f0", "f1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []  # what waits for more rows; its last entry may go on in the next batch

        def out(key, x):
            pairs, cut = near_pairs(key, x, radius, width, segments)
            ends = np.concatenate([x[pairs[:, 0]], x[pairs[:, 1]]], axis=1).view(np.int64)
            ends = np.unique(ends, axis=0) if len(ends) else ends
            own, none = x[cut].view(np.int64), pa.nulls(len(cut), pa.int64())
            columns = [pa.concat_arrays([pa.array(ends[:, i]), pa.array(own[:, i]) if i < 2 else none]) for i in range(4)]
            keys = pa.concat_arrays([pa.nulls(len(ends), pa.int64()), pa.array(key[cut].astype(np.int64))])
            return pa.RecordBatch.from_arrays([keys, *columns], names=_FOUND.names)

        size, least = 0, _ROWS
        for b in batches:
            if not b.num_rows:
                continue
            held.append((b.column(0).to_numpy(zero_copy_only=False), np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2)], axis=1).view(np.uint64)))
            size += b.num_rows
            if size < least:
                continue
            key, x = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            last = int(np.searchsorted(key, key[-1]))
            if last:
                yield out(key[:last], x[:last])
            held, size = [(key[last:].copy(), x[last:].copy())], len(key) - last
            least = max(_ROWS, 2 * size)  # an entry that fills the buffer is not copied again for every batch
        if held:
            yield out(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))

    found = materialize(dealt.mapInArrow(run, _FOUND), "found")
    return found.where("key is null").drop("key").distinct(), found.where("key is not null").selectExpr("key", "a0 AS f0", "a1 AS f1")


_UNIT = ("key", "i", "j")


def _units(cut: DataFrame, roots: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """``(key, i, j, f0, f1, node, root, main, walks, stored)`` for entries' members ``(key, f0, f1)`` of several groups ``(node, root)``.

    In each unit the walking members meet the stored ones. The members of the group with most of them do not walk. Both sides of a large entry are dealt to blocks
    of some ``MANY`` members, fewer where their sets ``(node, n)`` are large, so that it is many tasks' work and none holds more than two blocks.
    """
    named = cut.withColumn("node", _node("f0", "f1")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = named.join(sizes, "node", "left") if sizes is not None else named.withColumn("n", F.lit(0))
    named = materialize(named, "entry-members")
    groups = named.groupBy("key", "root").agg(F.sum(1 + F.floor(F.col("n") / _WEIGHT)).alias("n"))
    entries = groups.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.sum("n").alias("n"), F.max("n").alias("most"), F.count("*").alias("groups")).where("groups > 1")
    blocks = lambda n: F.ceil(n / MANY).cast("int")
    entries = entries.select("key", "main", blocks(F.col("n")).alias("blocks"), blocks(F.col("n") - F.col("most")).alias("walking"))
    here = named.join(entries, "key")
    own, walks = ("f0", "f1", "node", "root", "main"), F.col("root") != F.col("main")
    block = lambda of: F.pmod(F.xxhash64("node"), of).cast("int")
    upto = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    one = here.where("blocks = 1").select("key", F.lit(0).alias("i"), F.lit(0).alias("j"), *own, walks.alias("walks"), F.lit(True).alias("stored"))
    many = here.where("blocks > 1")
    walking = many.where(walks).select("key", block("walking").alias("i"), upto("blocks").alias("j"), *own, F.lit(True).alias("walks"), F.lit(False).alias("stored"))
    stored = many.select("key", upto("walking").alias("i"), block("blocks").alias("j"), *own, F.lit(False).alias("walks"), F.lit(True).alias("stored"))
    return one.unionByName(walking).unionByName(stored)


class _Unit:
    """The members of one unit, each once."""

    def __init__(self, t: pa.Table):
        self.key = t["key"][0].as_py()
        self.x = np.stack([t[n].to_numpy() for n in ("f0", "f1")], axis=1).view(np.uint64)
        self.node, root = t["node"].to_pylist(), t["root"].to_pylist()
        self.comp = np.unique(np.array(root, object), return_inverse=True)[1]
        self.main = np.array([r == m for r, m in zip(root, t["main"].to_pylist(), strict=True)], bool)
        self.walks, self.stored = (t[n].to_numpy().astype(bool) for n in ("walks", "stored"))

    def pairs(self, width: int, segments: int, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Walking and stored members of different groups within the radius that meet in no entry before this one, some walking members at a time; of two that walk, one is given the other."""
        walking, stored = np.flatnonzero(self.walks), np.flatnonzero(self.stored)
        twice = self.walks & self.stored
        some = max(1, _PAIRS // max(1, len(stored)))
        for at in range(0, len(walking), some):
            w = walking[at : at + some, None]
            a, b = np.nonzero((self.comp[w] != self.comp[stored]) & ~(twice[w] & twice[stored] & (stored < w)) & (_distance(self.x[w], self.x[stored]) <= radius))
            a, b = w[a, 0], stored[b]
            first = _first_keys(self.x[a], self.x[b], width, segments)
            good = (first == self.key) | (first < 0)
            if good.any():
                yield a[good], b[good]


def _by_unit(rows: DataFrame, solve, schema: str) -> DataFrame:
    """The rows that ``solve`` makes of each unit's table of ``rows``."""
    dealt = rows.repartition(*_UNIT).sortWithinPartitions(*_UNIT, "f0", "f1", "stored")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark, held = None, []
        for b in batches:
            unit = np.stack([b.column(n).to_numpy().astype(np.int64) for n in _UNIT], axis=1)
            cuts = [0, *(np.flatnonzero((unit[1:] != unit[:-1]).any(axis=1)) + 1).tolist(), b.num_rows]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                if x < y and (now := tuple(unit[x].tolist())) != mark:
                    if held:
                        yield from solve(pa.Table.from_batches(held))
                    mark, held = now, []
                if x < y:
                    held.append(b.slice(x, y - x))
        if held:
            yield from solve(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, schema)


def pairs_between(cut: DataFrame, roots: DataFrame, width: int = WIDTH, segments: int = SEGMENTS, radius: int = RADIUS) -> DataFrame:
    """Distinct candidates ``(a0, a1, b0, b1)`` of entries' members ``(key, f0, f1)`` that lie in different groups ``(node, root)``; they grow with the square of a group.

    A pair is given where it first meets: if that entry gave all its candidates, the pair is among them.
    """

    def solve(t: pa.Table) -> Iterator[pa.RecordBatch]:
        unit = _Unit(t)
        for i, j in unit.pairs(width, segments, radius):
            a, b = unit.x[i].view(np.int64), unit.x[j].view(np.int64)
            low = ((a[:, 0] < b[:, 0]) | ((a[:, 0] == b[:, 0]) & (a[:, 1] < b[:, 1])))[:, None]
            ends = np.concatenate([np.where(low, a, b), np.where(low, b, a)], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, k]) for k in range(4)], names=["a0", "a1", "b0", "b1"])

    return _by_unit(_units(cut, roots), solve, "a0 long, a1 long, b0 long, b1 long").distinct()


def links_between(cut: DataFrame, roots: DataFrame, sets: DataFrame, similarity: float = SIMILARITY, width: int = WIDTH, segments: int = SEGMENTS, radius: int = RADIUS) -> DataFrame:
    """Links ``(a, b)`` that join all groups ``(node, root)`` which any link among the candidates of ``pairs_between`` joins.

    No list of pairs is made, as they grow with the square of a group. First each unit names the members that have a candidate which may be a link by the marked bits of both.
    Only these meet again with their whole sets, and a unit gives a link where it joins two groups, so fewer than it has members.
    """
    units = materialize(_units(cut, roots, sets.select("node", F.size("hashes").alias("n"))), "entry-units")

    def named(t: pa.Table) -> Iterator[pa.RecordBatch]:
        unit, n = _Unit(t), t["n"].to_numpy()
        marks = np.frombuffer(b"".join(t["marks"].to_pylist()), np.uint64).reshape(-1, MARKS // 64)
        good = np.zeros(len(n), bool)
        for i, j in unit.pairs(width, segments, radius):
            may = _may_link(n[i], marks[i], n[j], marks[j], similarity)
            good[i[may]] = good[j[may]] = True
        if good.any():
            yield from t.select([*_UNIT, "node"]).filter(pa.array(good)).combine_chunks().to_batches()

    def linked(t: pa.Table) -> Iterator[pa.RecordBatch]:
        unit, n = _Unit(t), t["n"].to_numpy()
        marks = np.frombuffer(b"".join(t["marks"].to_pylist()), np.uint64).reshape(-1, MARKS // 64)
        hashes = [h.values.to_numpy().view(np.uint64) for h in t["hashes"]]
        groups, out = _Roots(unit.comp.tolist()), []
        for walking, stored in unit.pairs(width, segments, radius):
            may = _may_link(n[walking], marks[walking], n[stored], marks[stored], similarity)
            walking, stored = walking[may], stored[may]
            for near in np.split(np.arange(len(walking)), np.flatnonzero(np.diff(walking)) + 1):
                while len(near):  # what is joined meanwhile needs no look
                    i = int(walking[near[0]])
                    own = groups.find(i)
                    open_ = near[[groups.find(j) != own for j in stored[near].tolist()]]
                    now, near = stored[open_[:_AT_ONCE]], open_[_AT_ONCE:]
                    shared = _overlaps(hashes[i], [hashes[j] for j in now.tolist()])
                    out += [(i, j) for j in now[shared >= similarity * (n[i] + n[now] - shared) - 1e-9].tolist() if groups.join(i, j)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([unit.node[p[k]] for p in out], pa.string()) for k in (0, 1)], names=["a", "b"])

    known = sets.withColumn("n", F.size("hashes").cast("long"))
    own = [c for c in units.columns if c not in _UNIT]
    promising = _by_unit(units.join(known.select("node", "n", "marks"), "node").select(*_UNIT, *own, "n", "marks"), named, "key long, i int, j int, node string")
    promising = materialize(promising.distinct(), "promising-members")
    few = units.join(promising, [*_UNIT, "node"], "left_semi").join(known.select("node", "n", "marks", "hashes"), "node")
    return _by_unit(few.select(*_UNIT, *own, "n", "marks", "hashes"), linked, "a string, b string")


def _node(*columns: str):
    return F.concat_ws(" ", *columns)


def near_copy_groups(docs: DataFrame, text: str = "text", similarity: float = SIMILARITY, shingle: int = SHINGLE, width: int = WIDTH, segments: int = SEGMENTS, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, component_id)`` for each row with an id: the smallest id reachable over links, itself included.

    A link is a Jaccard similarity of ``similarity`` or more between the sets of word shingles. Null and empty texts and texts of blanks are
    copies of one another. A text shorter than a shingle counts as one shingle, a very long one counts whole. Repeated rows stay repeated; rows of one id with
    different texts join their groups. Rows without an id are left out. An empty table gives an empty result; other columns are ignored.
    """
    if words < 2 or segments * width > 64 * words:
        raise ValueError("the segments must fit in the words of a fingerprint, two at least")
    slim = docs.select("doc_id", F.col(text).alias("text")).where("doc_id is not null")
    names = [f"f{i}" for i in range(words)]

    def start():
        def work(texts):
            made = [fingerprint(shingle_set(x, shingle), words) for x in texts]
            return {n: [m[i] for m in made] for i, n in enumerate(names)}

        return work

    prints = materialize(map_texts(slim, start, T.StructType([T.StructField(n, T.LongType()) for n in names])), "prints")
    own = materialize(prints.groupBy("f0", "f1").agg(F.min("doc_id").alias("low"), *(F.min(n).alias(n) for n in names[2:])), "distinct-prints")
    ends_of = lambda pairs: pairs.select(_node("a0", "a1").alias("a"), _node("b0", "b1").alias("b"))
    pairs, cut = candidate_pairs(own, width, segments, radius)
    pairs = materialize(ends_of(pairs), "candidates")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).union(cut.select(_node("f0", "f1"))).distinct()
    ids = own.withColumn("node", _node("f0", "f1")).join(ends, "node", "left_semi").select(F.col("low").alias("doc_id"), "node")
    sets = materialize(_sets(slim.join(ids, "doc_id").select("node", "text"), shingle).dropDuplicates(["node"]), "shingle-sets")
    grouped = connected_components(_checked(pairs, sets, similarity))
    links = materialize(links_between(cut, grouped, sets, similarity, width, segments, radius), "links-between")
    if not links.isEmpty():
        grouped = connected_components(grouped.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links))
    member = prints.select("doc_id", _node("f0", "f1").alias("node")).join(grouped, "node", "left").select("doc_id", F.coalesce("root", "node").alias("root"))
    # rows of one id are one document: their groups join
    member = materialize(member, "members")
    several = member.groupBy("doc_id").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("doc_id", "a")
    merged = connected_components(member.join(several, "doc_id").select("a", F.col("root").alias("b")))
    member = materialize(member.join(merged.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select("doc_id", F.coalesce("to", "root").alias("root")), "members")
    lowest = member.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return member.join(lowest, "root").select("doc_id", "component_id")


def _checked(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` whose shingle sets are similar enough."""
    side = lambda n: sets.select(F.col("node").alias(n), F.col("hashes").alias(f"h{n}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("shared", F.size(F.array_intersect("ha", "hb")))
    return both.where(F.col("shared") >= F.lit(similarity) * (F.size("ha") + F.size("hb") - F.col("shared")) - 1e-9).select("a", "b")


def _marks(hashes: np.ndarray) -> bytes:
    """Which of ``MARKS`` places the hashes fall in, as bits."""
    out = np.zeros(MARKS, bool)
    out[(hashes % np.uint64(MARKS)).astype(np.int64)] = True
    return np.packbits(out).tobytes()


def _may_link(n: np.ndarray, mark: np.ndarray, others: np.ndarray, marks: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets may be similar enough, by their sizes and marks: a place marked in one set alone is a shingle that is not shared, so none that is a link goes."""
    most = np.minimum(n - np.bitwise_count(mark & ~marks).sum(axis=1, dtype=np.int64), others - np.bitwise_count(marks & ~mark).sum(axis=1, dtype=np.int64))
    return most >= similarity * (n + others - most) - 1e-9


def _overlaps(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many hashes of the sorted set ``own`` each other set holds."""
    flat = np.concatenate([*others, np.zeros(0, np.uint64)])
    held = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat if len(own) else np.zeros(len(flat), bool)
    ends = np.cumsum([0, *map(len, others)])
    return np.diff(np.concatenate(([0], np.cumsum(held)))[ends])


def _sets(rows: DataFrame, shingle: int) -> DataFrame:
    """``(node, hashes, marks)`` of rows ``(node, text)`` whose text has that fingerprint; an id may have other texts too."""
    schema = T.StructType([T.StructField("node", T.StringType()), T.StructField("hashes", T.ArrayType(T.LongType())), T.StructField("marks", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 128):
            made = [(n, shingle_set(x, shingle)) for n, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            made = [(n, s.view(np.int64)) for n, s in made if " ".join(map(str, fingerprint(s, 2))) == n]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in made], pa.string()), pa.array([s for _, s in made], pa.list_(pa.int64())), pa.array([_marks(s.view(np.uint64)) for _, s in made], pa.binary())], names=schema.names)

    return rows.mapInArrow(run, schema)


def keep_one_per_group(docs: DataFrame, text: str = "text", **how) -> DataFrame:
    """The row of ``docs`` with the smallest id in each group of near copies.

    Rows without an id are kept, as nothing tells them apart. Of repeated rows with one id, one stays.
    Columns and their order are those of ``docs``. Defined for nulls, empty and long texts and empty tables as ``near_copy_groups``.
    """
    first = near_copy_groups(docs, text, **how).where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])  # one shuffle serves both
    return kept.select(docs.columns).unionByName(docs.where("doc_id is null"))
