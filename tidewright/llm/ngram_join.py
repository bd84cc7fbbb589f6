"""Jaccard join of word n-gram sets through prefix trees.

Sets whose similarity reaches the threshold share ``k`` shingles among the rarest of each: of ``n`` shingles the ``n - ceil(0.85 n) + k`` that one order
of all shingles puts first. Sets are dealt to groups by those, ``k`` being a tenth of ``n`` and one; sets that share fewer with all others together are out. The order is by counts over the
whole corpus, in a fixed number of counters; it decides only how large groups get. Equal sets count as one, groups with the same members too, and a set stays only in those
groups in one of which any similar set is still met.

Up to 1,024 sets have all their overlaps counted at once. The sets of a larger group are stored in a trie, the shingles that most of them hold first, so that sets of near copies share long paths. Other sets walk
down it; the overlap with a path is counted once for all sets below it, and a subtree is left as soon as the overlap so far with the lesser of what
remains of the walking set and the longest rest below cannot reach what the sizes ask for. Only links that join two components are
given, so a group of ``m`` copies gives ``m - 1`` at most.

First each set goes to its largest group only, which settles most near copies, large groups in blocks. Then the lowest set of each component stands for it in the large
groups. Last, groups that still hold several components are searched whole: the sets outside a group's largest component walk the tries of all its
sets, in blocks of bounded size. They do so first over their rarest shingles alone, as sets without a partner there need not be sent whole; what is left falls in families of
sets that meet in some group, and a family that fits in a block is searched as one, so that each of its sets is sent once. A group with one component needs no look, as every link in it is
known to be inside.

A shingle is a 64-bit hash of its words and a set a 64-bit hash of its shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm._common import materialize, slices
from tidewright.llm.components import connected_components
from tidewright.llm.sketches import counted_bits, counters_for, may_count, merged_counts

SHINGLE = 4
#: Links have ``100 * intersection >= PERCENT * union``.
PERCENT = 85
#: Shingles in a block of a group, about: what a task holds of it at once, twice.
BLOCK = 1 << 19
_WALKERS = 64
#: Sets of which all overlaps are counted at once, without a trie, at most, and pairs that are counted at a time.
_FEW = 1024
_PAIRS = 1 << 20


_BASE = 0x9E3779B97F4A7C15
#: What is left of eight bytes of a word that has so few.
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Bytes of a word that is hashed eight bytes at a time, at most.
_WORD = 256
#: Bytes of texts whose shingles are made together, about; a longer text goes alone.
_TEXTS = 1 << 18


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that follow each other in ``data``, text ``k`` from ``edges[k]`` to ``edges[k + 1]``, and how many words each text has."""
    import xxhash

    padded = np.zeros(len(data) + 8, np.uint8)
    np.add(data, (data - np.uint8(65) < 26).view(np.uint8) << np.uint8(5), out=padded[: len(data)])
    there = (data != 32) & (data - np.uint8(9) > 4)
    begin, end = there.copy(), there.copy()
    begin[1:] &= ~there[:-1]
    end[:-1] &= ~there[1:]
    full = edges[:-1] < edges[1:]
    first, last = edges[:-1][full], edges[1:][full] - 1
    begin[first], end[last] = there[first], there[last]
    starts = np.flatnonzero(begin)
    size = np.flatnonzero(end) + 1 - starts
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    h = _mix((eight[starts] & _MASK[np.minimum(size, 8)]) + size.astype(np.uint64) * np.uint64(_BASE))
    at, rest = 8, np.flatnonzero((size > 8) & (size <= _WORD))
    while len(rest):
        h[rest] = _mix(h[rest] * np.uint64(_BASE) + (eight[starts[rest] + at] & _MASK[np.minimum(size[rest] - at, 8)]))
        at += 8
        rest = rest[size[rest] > at]
    for k in np.flatnonzero(size > _WORD).tolist():
        h[k] = xxhash.xxh64_intdigest(padded[starts[k] : starts[k] + size[k]])
    return h, np.diff(np.searchsorted(starts, edges))


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word, A to Z in lower case, from eight bytes at a time of all words at once."""
    data = np.frombuffer((text or "").encode("utf-8"), np.uint8)
    return _words(data, np.array([0, len(data)]))[0]


def _shingles(h: np.ndarray, words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of ``k`` words of each text, one of the whole text where it has fewer words, and where each text's begin."""
    at, cuts = (np.concatenate(([0], np.cumsum(c))) for c in (words, np.where(words >= k, words - k + 1, words > 0)))
    out = np.empty(cuts[-1], np.uint64)
    if (words >= k).any():
        made = np.full(len(h) - k + 1, k, np.uint64)
        for j in range(k):
            made = made * np.uint64(_BASE) + h[j : len(h) - k + 1 + j]
        inside = (np.repeat(at[1:], words) - np.arange(len(h)) >= k)[: len(made)]
        out[np.repeat(words >= k, np.diff(cuts))] = made[inside]
    for n in range(1, k):
        few = np.flatnonzero(words == n)
        made = np.full(len(few), n, np.uint64)
        for j in range(n):
            made = made * np.uint64(_BASE) + h[at[few] + j]
        out[cuts[few]] = made
    return out, cuts


def shingles_of(texts: pa.Array, shingle: int = SHINGLE, distinct: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the word shingles of some texts after the other, and where each text's begin: sorted and distinct ones, or all as they come. Nulls have none."""
    texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    edges = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(edges, edges[at] + _TEXTS, "right")) - 1)
        made, cuts = _shingles(*_words(data[edges[at] : edges[to]], edges[at : to + 1] - edges[at]), shingle)
        if distinct:
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                made[a:b].sort()
            new = np.ones(len(made), bool)
            new[1:] = made[1:] != made[:-1]
            new[cuts[:-1][cuts[:-1] < cuts[1:]]] = True
            made, cuts = made[new], np.concatenate(([0], np.cumsum(new)))[cuts]
        yield made, cuts
        at = to


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; one of the whole sequence where there are fewer words, none without words."""
    return next(shingles_of(pa.array([text], pa.large_string()), shingle))[0]


def set_number(hashes: np.ndarray) -> int:
    """A signed 64-bit number of the set."""
    import xxhash

    return xxhash.xxh64_intdigest(hashes.tobytes(), len(hashes)) - (1 << 63)


def asked(n: int) -> int:
    """How many of the rarest shingles a set of ``n`` shares with a similar one of its size or more."""
    return n // 10 + 1


def prefix(hashes: np.ndarray, common: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The rarest of the sorted shingles, of which two similar sets share ``asked`` of the smaller one; ``common`` gives the order, equal ones follow their hash."""
    n = len(hashes)
    most = n + (-percent * n // 100) + asked(n)  # n - ceil(percent n / 100) + asked
    if most >= n:
        return hashes
    tier = common[(hashes & np.uint64(len(common) - 1)).astype(np.int64)]
    return hashes[np.argsort(tier, kind="stable")[:most]]


def commonness(slim: DataFrame, shingle: int = SHINGLE, most: int = 1 << 22) -> np.ndarray:
    """For each of at most ``most`` counters how often its shingles occur over all rows, in quarters of a doubling, what lies below twice the mean being equal."""
    counters = counters_for(slim.count(), 256, most=most)

    def places(b: pa.RecordBatch) -> np.ndarray:
        return np.concatenate([made & np.uint64(counters - 1) for made, _ in shingles_of(b.column(0), shingle, distinct=False)] or [np.zeros(0, np.uint64)])

    code = merged_counts(slim.select("text"), places, counters, lambda n: np.round(4 * np.log2(n + 1)).astype(np.uint8))
    mean = np.exp2(code / 4).mean()
    base = np.uint8(min(255, round(4 * np.log2(2 * mean + 1))))
    return np.maximum(code, base) - base


class _Roots:
    """Components inside a group."""

    def __init__(self, comp: list):
        first: dict = {}
        self.up = [first.setdefault(c, i) for i, c in enumerate(comp)]

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.find(i), self.find(j)
        self.up[max(a, b)] = min(a, b)
        return a != b


class _Trie:
    """Sets by the ranks of their members, those that most sets hold first; members of one set only are left out, as they are in no overlap."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, stored: list[bool]):
        _, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rank = np.empty(len(count), np.int64)
        rank[np.argsort(-count, kind="stable")] = np.arange(len(count))
        self.sizes, self.width = sizes, max(1, both := int((count > 1).sum()))
        self.ranks = [np.sort(r[r < both]) for r in np.split(rank[number], np.cumsum([len(s) for s in sets])[:-1])]
        self.order = sorted((i for i in range(len(sets)) if stored[i]), key=lambda i: self.ranks[i].astype(">u4").tobytes())
        self.shared = np.zeros(len(self.order), np.int64)  # first ranks that a set has in common with the one before it
        for k in range(1, len(self.order)):
            x, y = self.ranks[self.order[k - 1]], self.ranks[self.order[k]]
            n = min(len(x), len(y))
            differ = np.flatnonzero(x[:n] != y[:n])
            self.shared[k] = differ[0] if len(differ) else n
        self.at_once = max(1, min(_WALKERS, (1 << 22) // self.width))

    def walk(self, walkers: np.ndarray, needed) -> Iterator[tuple[np.ndarray, int]]:
        """``(walkers, set)`` for each stored set that some walkers share enough with; ``needed`` gives how much from walkers' sizes and another size, the larger the more."""
        ranks, order, shared = self.ranks, self.order, self.shared
        held = np.zeros((len(walkers), self.width), bool)
        for k, i in enumerate(walkers.tolist()):
            held[k, ranks[i]] = True
        rest = np.cumsum(held[:, ::-1], axis=1, dtype=np.int32)[:, ::-1]  # a walker's ranks from each one on
        own, below, lows = self.sizes[walkers], np.array([len(ranks[i]) for i in order]), self.sizes[order]
        todo = [(0, len(order), 0, np.arange(len(walkers)), np.zeros(len(walkers), np.int64), 0)]
        while todo:
            a, b, depth, alive, overlap, last = todo.pop()
            to = int(shared[a + 1 : b].min()) if b - a > 1 else int(below[a])
            path = ranks[order[a]][depth:to]
            if len(path):
                overlap = overlap + held[alive][:, path].sum(axis=1)
                last = int(path[-1]) + 1
            left = rest[alive, last] if last < self.width else np.zeros(len(alive), np.int32)
            good = overlap + np.minimum(left, int(below[a:b].max()) - to) >= needed(own[alive], int(lows[a:b].min()))
            if not good.any():
                continue
            alive, overlap = alive[good], overlap[good]
            if b - a == 1:
                yield walkers[alive], order[a]
                continue
            cuts = [a, *(np.flatnonzero(shared[a + 1 : b] == to) + a + 1).tolist(), b]
            todo += [(x, y, to, alive, overlap, last) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]


def _overlaps(sets: list[np.ndarray]) -> np.ndarray | None:
    """How many members each two of the sets share, or none where there are many sets or many pairs to count.

    Members of many sets are columns of a product of matrices, those of few sets are counted pair by pair.
    """
    m, flat = len(sets), np.concatenate(sets)
    if m > _FEW:
        return None
    order = np.argsort(flat)
    flat = flat[order]
    first = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
    times = np.diff(np.append(first, len(flat)))
    who = np.repeat(np.arange(m), [len(s) for s in sets])[order]
    many = times >= (2 if m <= 64 else m // 16)
    kept = np.repeat(many, times)
    held = np.zeros((m, int(many.sum())), np.float32)
    held[who[kept], np.repeat(np.cumsum(many) - 1, times)[kept]] = 1
    both = np.rint(held @ held.T).astype(np.int64)
    few = (times > 1) & ~many
    if not few.any():
        return both
    who = who[np.repeat(few, times)]
    times = times[few]
    start, each = np.repeat(np.cumsum(times) - times, times), np.repeat(times, times)
    upto = np.concatenate(([0], np.cumsum(each)))
    if upto[-1] > _PAIRS << 3:
        return None
    at = 0
    while at < len(who):
        to = max(at + 1, int(np.searchsorted(upto, upto[at] + _PAIRS, "right")) - 1)
        one = np.repeat(np.arange(at, to), each[at:to])
        other = start[one] + np.arange(upto[to] - upto[at]) - (upto[one] - upto[at])
        both += np.bincount(who[one] * m + who[other], minlength=m * m).reshape(m, m)
        at = to
    return both


def trie_links(sets: list[np.ndarray], comp: list, walks: list[bool], stored: list[bool], main: list[bool], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that join all components that links between walking and stored sets join.

    Sets that have joined the group's ``main`` component need not walk any further. Where no set is marked so and all walk, the largest
    component after the first sets have walked takes its place.
    """
    roots, m = _Roots(comp), len(sets)
    if len({roots.find(i) for i in range(m)}) < 2 or not (any(walks) and any(stored)):
        return []
    sizes = np.array([len(s) for s in sets], np.int64)
    needed = lambda own, other: -(-percent * (own + other) // (100 + percent))
    if (both := _overlaps(sets)) is not None:
        found = (both >= needed(sizes[:, None], sizes)) & np.array(walks)[:, None] & np.array(stored)
        return [(i, j) for i, j in np.argwhere(found).tolist() if i != j and roots.join(i, j)]
    trie = _Trie(sets, sizes, stored)
    out: list[tuple[int, int]] = []
    anchor = next((i for i in range(m) if main[i]), None)
    waiting = [i for i in range(m) if walks[i]]
    while waiting:
        now, waiting = np.array(waiting[: trie.at_once]), waiting[trie.at_once :]
        for found, j in trie.walk(now, needed):
            out += [(i, j) for i in found.tolist() if roots.join(i, j)]
        known = [roots.find(i) for i in range(m)]
        if anchor is None and all(walks):
            anchor = int(np.bincount(known).argmax())
        if anchor is not None:
            waiting = [i for i in waiting if known[i] != known[anchor]]
    return out


def _heads(near: np.ndarray) -> list[tuple[int, int]]:
    """Each of the sets that is near to another one, and the first set that near ones lead it to."""
    near, head = near | near.T, np.full(len(near), -1)
    for k in np.flatnonzero(near.any(axis=1)).tolist():
        now = np.array([k] if head[k] < 0 else [], int)
        head[now] = k
        while len(now):
            now = np.flatnonzero(near[now].any(axis=0) & (head < 0))
            head[now] = k
    return [(i, int(head[i])) for i in np.flatnonzero(head >= 0).tolist()]


def trie_partners(rare: list[np.ndarray], sizes: list[int], comp: list, walks: list[bool], stored: list[bool], percent: int = PERCENT) -> list[tuple[int, int]]:
    """The sets that share as many of their rarest shingles with a set of another component as similar sets do, and may be similar by their sizes; such sets have one head."""
    if not (any(walks) and any(stored)):
        return []
    size, numbers = np.array(sizes, np.int64), np.unique(np.array(comp, np.int64), return_inverse=True)[1]
    needed = lambda own, other: np.minimum(asked(own), asked(other))
    if (both := _overlaps(rare)) is not None:
        a, b = size[:, None], size
        found = (both >= needed(a, b)) & (numbers[:, None] != numbers) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b)) & np.array(walks)[:, None] & np.array(stored)
        return _heads(found)
    trie = _Trie(rare, size, stored)
    roots, good, walking = _Roots(list(range(len(rare)))), np.zeros(len(rare), bool), np.flatnonzero(walks)
    for k in range(0, len(walking), trie.at_once):
        for found, j in trie.walk(walking[k : k + trie.at_once], needed):
            other = size[found]
            found = found[(numbers[found] != numbers[j]) & (100 * np.minimum(other, size[j]) >= percent * np.maximum(other, size[j]))]
            good[found] = True
            good[j] |= len(found) > 0
            for i in found.tolist():
                roots.join(i, j)
    return [(i, roots.find(i)) for i in np.flatnonzero(good).tolist()]


#: Shingles in a range, about, and bits of a shingle that are kept inside it.
_RANGE = 1 << 20
_BITS = 40

#: Edges whose components the driver finds, at most: 4 MB.
_EDGES = 1 << 18

_UNIT = ("token", "i", "j")


def _by_unit(dealt: DataFrame, arrays: DataFrame, solve, schema: T.StructType) -> DataFrame:
    """Rows of ``solve(unit, sets, comps, walks, stored, main, sizes, hashes)`` for each unit ``(token, i, j)`` of rows ``(token, i, j, set, comp, walks, stored, main)``."""
    rows = dealt.join(arrays, "set").select(*_UNIT, "set", "comp", "walks", "stored", "main", "n", "hashes").repartition(*_UNIT).sortWithinPartitions(*_UNIT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark, held = None, []

        def out():
            made = solve(mark, *(list(c) for c in zip(*held, strict=True)))
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in made], f) for k, f in enumerate(kinds)], names=schema.names)

        kinds = [pa.int64() if isinstance(f.dataType, T.LongType) else pa.int32() for f in schema]
        for b in batches:
            hashes = b.column(9)
            cuts, flat = hashes.offsets.to_numpy(), hashes.values.to_numpy(zero_copy_only=False).view(np.uint64)
            for k, (t, i, j, *rest) in enumerate(zip(*(b.column(n).to_pylist() for n in range(9)), strict=True)):
                if (t, i, j) != mark:
                    if len(held) > 1:
                        yield out()
                    mark, held = (t, i, j), []
                held.append((*rest, flat[cuts[k] : cuts[k + 1]].copy()))
        if len(held) > 1:
            yield out()

    return rows.mapInArrow(run, schema)


def _searched(dealt: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` inside the units."""
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def solve(_, number, comp, walks, stored, main, n, hashes):
        return [(number[i], number[j]) for i, j in trie_links(hashes, comp, walks, stored, main, percent)]

    return _by_unit(dealt, sets, solve, schema)


def _promising(dealt: DataFrame, rare: DataFrame, percent: int) -> DataFrame:
    """The rows of ``dealt`` whose set has a partner in the unit by its rarest shingles, which are a sixth of a set or so; partners have one ``head``."""
    schema = T.StructType([T.StructField("token", T.LongType()), T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()), T.StructField("set", T.LongType()), T.StructField("head", T.LongType())])

    def solve(unit, number, comp, walks, stored, main, n, hashes):
        return [(*unit, number[i], number[k]) for i, k in trie_partners(hashes, n, comp, walks, stored, percent)]

    found = _by_unit(dealt, rare, solve, schema).distinct()  # no semi-join, which would be done for each part of the union apart
    return dealt.join(found, [*_UNIT, "set"])


def _blocks(total) -> F.Column:
    return F.ceil(total / BLOCK).cast("int")


def _block(of: str):
    return F.pmod(F.xxhash64("set"), F.col(of)).cast("int")


def _all():
    """All sets of a unit walk and are stored, and no component is known to be the largest."""
    return F.lit(True).alias("walks"), F.lit(True).alias("stored"), F.lit(False).alias("main")


def _first_deal(members: DataFrame) -> DataFrame:
    """Each set in its group with the most members, in blocks by hash where that is large; ``whole``: the unit has all members of the group."""
    pick = members.groupBy("set").agg(F.max_by(F.struct("token", "m", "n"), F.struct("m", "token")).alias("p")).select("set", "p.*")
    size = pick.groupBy("token").agg(F.count("*").alias("picked"), _blocks(F.sum("n")).alias("blocks"))
    placed = pick.join(size, "token").withColumn("whole", (F.col("picked") == F.col("m")) & (F.col("blocks") == 1))
    return placed.select("token", _block("blocks").alias("i"), F.lit(0).alias("j"), "set", F.col("set").alias("comp"), *_all(), "whole")


def _open_groups(members: DataFrame, roots: DataFrame, done: DataFrame) -> DataFrame:
    """Members, with their component, of groups that hold several components and have not been searched whole."""
    placed = members.join(done, "token", "left_anti").join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("comp", F.coalesce("root", "set")).drop("root")
    several = placed.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("token")
    return placed.join(several, "token", "left_semi")


def _second_deal(placed: DataFrame) -> DataFrame:
    """The lowest set of each component of a large group, in blocks by hash."""
    large = placed.groupBy("token").agg(F.sum("n").alias("all")).where(F.col("all") > BLOCK).select("token")
    low = placed.join(large, "token", "left_semi").groupBy("token", "comp").agg(F.min(F.struct("set", "n")).alias("s")).select("token", "comp", "s.*")
    size = low.groupBy("token").agg(_blocks(F.sum("n")).alias("blocks"))
    return low.join(size, "token").select("token", _block("blocks").alias("i"), F.lit(0).alias("j"), "set", "comp", *_all())


def _last_deal(placed: DataFrame) -> DataFrame:
    """Every set outside its group's largest component meets all sets of the group."""
    per = placed.groupBy("token", "comp").agg(F.sum("n").alias("all"))
    size = per.groupBy("token").agg(F.max_by("comp", F.struct("all", "comp")).alias("largest"), F.sum("all").alias("total"), F.max("all").alias("most"))
    size = size.select("token", "largest", _blocks(F.col("total")).alias("blocks"), _blocks(F.col("total") - F.col("most")).alias("walking"))
    rows = placed.join(size, "token").withColumn("walks", F.col("comp") != F.col("largest"))
    common = ["token", "set", "comp"]
    one = rows.where("blocks = 1").select("token", F.lit(0).alias("i"), F.lit(0).alias("j"), "set", "comp", "walks", F.lit(True).alias("stored"), (~F.col("walks")).alias("main"))
    many = rows.where("blocks > 1")
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    walking = many.where("walks").select(*common, _block("walking").alias("i"), upto("blocks").alias("j"), F.lit(True).alias("walks"), F.lit(False).alias("stored"), F.lit(False).alias("main"))
    stored = many.select(*common, upto("walking").alias("i"), _block("blocks").alias("j"), F.lit(False).alias("walks"), F.lit(True).alias("stored"), (~F.col("walks")).alias("main"))
    return one.unionByName(walking).unionByName(stored)


def _hashes_of(wanted: DataFrame, slim: DataFrame, shingle: int) -> DataFrame:
    """``(set, n, hashes)`` of ``wanted`` ``(set, doc_id)``; texts that are not wanted are mostly dropped where they are read, by 16 MB of bits at most."""
    bits = slim.sparkSession.sparkContext.broadcast(counted_bits(wanted.select(F.xxhash64("doc_id")), wanted.count(), 1))
    schema = T.StructType([T.StructField("set", T.LongType()), T.StructField("n", T.LongType()), T.StructField("hashes", T.ArrayType(T.LongType()))])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = b.filter(pa.array(may_count(b.column(1).to_numpy(zero_copy_only=False), bits.value)))
            for flat, cuts in shingles_of(held.column(0), shingle):
                made = [flat[x:y] for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True) if y > x]
                arrays = [pa.array([set_number(m) for m in made], pa.int64()), pa.array([len(m) for m in made], pa.int64()), pa.array([m.view(np.int64) for m in made], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    found = slim.select("text", F.xxhash64("doc_id").alias("h")).mapInArrow(near, schema)
    return found.join(wanted.select("set"), "set", "left_semi").dropDuplicates(["set"])  # an id may have other texts too


def _prints(slim: DataFrame, common, shingle: int, percent: int) -> DataFrame:
    """``(doc_id, n_shingles, set, rare)`` of each row of ``slim``; ``rare`` has the bytes of its rarest shingles."""
    schema = T.StructType([slim.schema["doc_id"], T.StructField("n_shingles", T.LongType()), T.StructField("set", T.LongType()), T.StructField("rare", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            made: list[tuple] = []
            for flat, cuts in shingles_of(b.column(1), shingle):
                for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    own = flat[x:y]
                    made.append((y - x, set_number(own) if y > x else None, prefix(own, common.value, percent).tobytes()))
            n, number, rare = zip(*made, strict=True) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(number, pa.int64()), pa.array(rare, pa.binary())], names=schema.names)

    return slim.select("doc_id", "text").mapInArrow(run, schema)


def _shared(prints: DataFrame, told: int) -> DataFrame:
    """``(set, token)`` for the rarest shingles that some other set has among its own; ``told`` is how many there are, about.

    A task packs its shingles by ranges of their hash, a set that it meets again once; each range is sorted as one, in a task of its own, so a shingle is shuffled once whatever the
    size of the table, and only those of several sets become rows. A token is the hash cut to its range and ``_BITS`` bits.
    """
    bits = min(14, max(4, (told // _RANGE).bit_length()))
    packed = T.StructType([T.StructField("range", T.IntegerType()), T.StructField("tokens", T.BinaryType()), T.StructField("sets", T.BinaryType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def out():
            h, number = (np.concatenate(c) for c in zip(*held, strict=True))
            h = _mix(h)
            part = (h >> np.uint64(64 - bits)).astype(np.uint16)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange((1 << bits) + 1))
            h, number = (h >> np.uint64(64 - bits - _BITS))[order] & np.uint64((1 << _BITS) - 1), number[order]
            low, high = h.astype("<u4"), (h >> np.uint64(32)).astype(np.uint8)
            there = np.flatnonzero(np.diff(cuts)).tolist()
            tokens = [low[cuts[r] : cuts[r + 1]].tobytes() + high[cuts[r] : cuts[r + 1]].tobytes() for r in there]
            sets = [number[cuts[r] : cuts[r + 1]].tobytes() for r in there]
            return pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(tokens, pa.binary()), pa.array(sets, pa.binary())], names=packed.names)

        for b in batches:
            if len(met) > 1 << 20:
                met.clear()
            for number, rare in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if number in met:
                    continue
                met.add(number)
                h = np.frombuffer(rare.as_buffer(), np.uint64)
                held.append((h, np.full(len(h), number, np.int64)))
                size += len(h)
                if size >= _RANGE:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    schema = T.StructType([T.StructField("set", T.LongType()), T.StructField("token", T.LongType())])

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None = None
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out():
            token, number = (np.concatenate(c) for c in zip(*held, strict=True))
            place = 64 - _BITS
            if len(token) < 1 << place:
                key = (token << np.uint64(place)) | np.arange(len(token), dtype=np.uint64)
                key.sort()
                order, token = (key & np.uint64((1 << place) - 1)).astype(np.int64), key >> np.uint64(place)
            else:
                order = np.argsort(token, kind="stable")
                token = token[order]
            same = token[1:] == token[:-1]
            kept = np.concatenate((same, [False])) | np.concatenate(([False], same))
            token, number = token[kept], number[order[kept]]
            order = np.lexsort((number, token))
            token, number = token[order], number[order]
            new = np.concatenate(([True], (token[1:] != token[:-1]) | (number[1:] != number[:-1])))[: len(token)]
            token, number = token[new], number[new]  # each set of a token once
            same = token[1:] == token[:-1]
            kept = (np.concatenate((same, [False])) | np.concatenate(([False], same)))[: len(token)]
            token, number = (token[kept] | np.uint64(now << _BITS)).view(np.int64), number[kept]
            for k in range(0, len(token), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(number[k : k + (1 << 16)]), pa.array(token[k : k + (1 << 16)])], names=schema.names)

        for b in batches:
            for part, tokens, sets in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                if part != now:
                    if held:
                        yield from out()
                    now, held = part, []
                raw, number = tokens.as_buffer(), np.frombuffer(sets.as_buffer(), np.int64)
                low, high = np.frombuffer(raw, "<u4", len(number)), np.frombuffer(raw, np.uint8, len(number), 4 * len(number))
                held.append((low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32)), number.copy()))
        if held:
            yield from out()

    dealt = prints.select("set", "rare").mapInArrow(pack, packed).repartitionById(1 << bits, "range").sortWithinPartitions("range")
    return dealt.mapInArrow(several, schema)


def _kept_groups(rows: DataFrame) -> DataFrame:
    """``(token, m, set, n)``: for rows ``(set, n, least, token)`` groups of sets that share a shingle, such that similar sets, which share ``least`` of each, still meet in one.

    Groups of the same sets count once, with a weight. In one order of all shingles, those of heavy groups first, similar sets meet before the last ``least - 1`` of each, so a set
    leaves the groups that hold only those: mostly chance meetings and the many small parts of a family.
    """
    held = rows.groupBy("token").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("set")).alias("who")).where("m > 1")
    groups = held.groupBy("m", "who").agg(F.min("token").alias("token"), F.count("*").alias("weight"))
    each = rows.join(groups.select("token", "weight"), "token")
    order = Window.partitionBy("set").orderBy(F.desc("weight"), "token").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.withColumn("upto", F.sum("weight").over(order)).withColumn("all", F.sum("weight").over(Window.partitionBy("set")))
    kept = materialize(each.where(F.col("upto") - F.col("weight") <= F.col("all") - F.col("least")).select("token", "set", "n"), "kept-members")
    return kept.join(kept.groupBy("token").agg(F.count("*").alias("m")).where("m > 1"), "token").select("token", "m", "set", "n")


def _clustered(last: DataFrame) -> DataFrame:
    """The deal by families: sets that partners lead to are sent once, to a unit of their own, unless a family is larger than a block; those keep their units."""
    edges = last.select(F.col("set").alias("a"), F.col("head").alias("b"))
    family = connected_components(edges, _EDGES).select(F.col("node").alias("set"), F.col("root").alias("family"))
    each = last.select("set", "comp", "n").distinct().join(family, "set")
    small = each.groupBy("family").agg(F.sum("n").alias("all")).where(F.col("all") <= BLOCK).select("family")
    own = each.join(small, "family").select(F.col("family").alias("token"), F.lit(0).alias("i"), F.lit(0).alias("j"), "set", "comp", *_all())
    rest = last.join(family, "set").join(small, "family", "left_anti").select(own.columns)
    return own.unionByName(rest)


def ngram_groups(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each row: the size of its set and the smallest id reachable by links, its own included.

    Two sets link at a Jaccard similarity of ``percent`` in a hundred or more. A text shorter than a shingle counts as one shingle, a very long one counts whole; null texts and texts
    without words have no set and link with nothing, so ``component_id`` is their own id. Repeated rows stay repeated, and rows of one id with different texts link by their own texts.
    Rows without an id make no links; they have the component of their set, or none. An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    slim = docs.select("doc_id", F.col(text).alias("text"))
    common = spark.sparkContext.broadcast(commonness(slim, shingle))  # 4 MB at most

    prints = materialize(_prints(slim, common, shingle, percent), "shingle-prefixes")
    there = prints.where("set is not null and doc_id is not null")
    own = materialize(there.groupBy("set").agg(F.min("doc_id").alias("low"), F.max("n_shingles").alias("n")), "distinct-sets")
    told = there.agg(F.sum(F.col("n_shingles") * (110 - percent) / 100)).first()[0] or 0
    least = F.floor(F.floor(F.col("n") * percent / 100) / 10) + 1  # of what a similar set, which may be smaller, asks for
    shared = _shared(there, int(told)).groupBy("set").agg(F.collect_list("token").alias("tokens"))
    able = materialize(shared.join(own.select("set", "n"), "set").where(F.size("tokens") >= least), "able-sets")
    rows = able.select("set", "n", least.alias("least"), F.explode("tokens").alias("token"))
    members = materialize(_kept_groups(rows), "members")
    wanted = own.join(members, "set", "left_semi").select("set", F.col("low").alias("doc_id"))
    sets = materialize(_hashes_of(wanted, slim, shingle), "sets")

    first = materialize(_first_deal(members), "first-deal")
    done = first.where("whole").select("token").distinct()
    links = materialize(_searched(first.drop("whole"), sets, percent), "links")
    roots = connected_components(links, _EDGES)
    placed = materialize(_open_groups(members, roots, done), "open-groups")
    second = materialize(_second_deal(placed), "second-deal")
    if not second.isEmpty():
        links = materialize(_searched(second, sets, percent).union(roots.select("node", "root")), "links")
        roots = connected_components(links, _EDGES)
        placed = materialize(_open_groups(members, roots, done), "open-groups")
    rare = able.join(placed.select("set").distinct(), "set", "left_semi").select("set", "n", F.col("tokens").alias("hashes"))
    last = materialize(_promising(_last_deal(placed), rare, percent).join(own.select("set", "n"), "set"), "last-deal")
    links = _searched(_clustered(last), sets, percent).union(roots.select("node", "root"))
    roots = connected_components(links, _EDGES)

    rooted = materialize(own.select("set", "low").join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set")), "roots")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    by_set = rooted.join(lowest, "root").select("set", "component_id")
    return prints.drop("rare").join(by_set, "set", "left").select("doc_id", "n_shingles", F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, CASE WHEN len(ws) > 0 THEN 2 ELSE 1 END))) AS i FROM w)),
n AS (SELECT doc_id, count(s) AS n FROM w LEFT JOIN g USING (doc_id) GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM g a JOIN g b USING (s) GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)),
r AS (SELECT doc_id, doc_id AS near FROM w UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.near)
SELECT r.doc_id, CAST(any_value(n.n) AS BIGINT) AS n_shingles, min(near) AS component_id FROM r JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""
