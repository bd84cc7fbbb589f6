"""What the n-gram join shuffles stays in proportion to the table: only shared shingles become rows, and a set goes only to groups that similar sets need."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from tidewright.llm import ngram_join
from tidewright.llm.components import connected_components


@pytest.mark.parametrize("size", [500, 1 << 20])
def test_only_shared_shingles_become_rows(spark, monkeypatch, size):
    monkeypatch.setattr(ngram_join, "_RANGE", size)
    rng = np.random.default_rng(1)
    shared = rng.integers(0, 1 << 63, 50, dtype=np.uint64)
    sets = {k: np.unique(np.concatenate((rng.integers(0, 1 << 63, 60, dtype=np.uint64), rng.choice(shared, k % 5, replace=False)))) for k in range(-60, 60)}
    rows = [(k, v.tobytes()) for k, v in sets.items()] * 2  # equal sets are one
    got = ngram_join._shared(spark.createDataFrame(rows, "set long, rare binary").repartition(3), 120 * 62).collect()
    times = Counter(t for v in sets.values() for t in v.tolist())
    want = sorted(sorted(k for k, v in sets.items() if t in v) for t, n in times.items() if n > 1)
    by: dict[int, list[int]] = {}
    for r in got:
        by.setdefault(r["token"], []).append(r["set"])
    assert want and sorted(sorted(v) for v in by.values()) == want
    assert ngram_join._shared(spark.createDataFrame([], "set long, rare binary"), 0).count() == 0


def test_similar_sets_meet_in_few_groups(spark):
    rng = random.Random(4)
    sets: dict[int, set] = {}
    for f in range(6):  # families, each member without some of the family's shingles
        family = range(1000 * f, 1000 * f + 60)
        for k in range(12):
            sets[100 * f + k] = set(rng.sample(family, rng.randrange(42, 58)))
    for k in sets:
        sets[k] |= {rng.randrange(90_000, 90_150) for _ in range(4)}  # chance meetings
    least = {k: len(v) // 2 for k, v in sets.items()}
    rows = [(k, len(v), least[k], t) for k, v in sets.items() for t in v]
    kept = ngram_join._kept_groups(spark.createDataFrame(rows, "set long, n long, least long, token long").repartition(3)).collect()
    by: dict[int, set] = {}
    for r in kept:
        by.setdefault(r["token"], set()).add(r["set"])
    met = {p for v in by.values() for p in combinations(sorted(v), 2)}
    need = {(a, b) for a, b in combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= max(least[a], least[b])}
    assert need and need <= met and all(r["m"] == len(by[r["token"]]) > 1 for r in kept)
    whole: dict[int, set] = {}
    for k, v in sets.items():
        for t in v:
            whole.setdefault(t, set()).add(k)
    all_members = sum(len(v) for v in {frozenset(v) for v in whole.values() if len(v) > 1})
    assert len(kept) < 0.6 * all_members


@pytest.mark.parametrize(("m", "pairs"), [(2, 1 << 20), (20, 1 << 20), (90, 1 << 20), (90, 5000), (300, 1 << 20)])
def test_overlaps_are_those_of_pairs(monkeypatch, m, pairs):
    monkeypatch.setattr(ngram_join, "_PAIRS", pairs)
    rng = random.Random(m)
    sets = [np.array(sorted(rng.sample(range(2000), rng.randrange(1, 60)) + rng.sample(range(9000, 9020), 9)), np.uint64) for _ in range(m)]
    got = ngram_join._overlaps(sets)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i, j in combinations(range(m), 2))


def test_shingles_of_many_texts_are_those_of_each(monkeypatch):
    monkeypatch.setattr(ngram_join, "_TEXTS", 64)
    texts = ["a", None, "A b c\td e", "", " a b c d  ", "é É e b", "a b", "a b c d a b c d a", "x" * 700, "x" * 701 + " y", "abcdefghi abcdefgh abcdefgh1 i", "a\0 a", "q\x1cr s"]
    names: dict = {}
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(["before", *texts * 5], kind).slice(1)
        got = [made[x:y] for made, cuts in ngram_join.shingles_of(column) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
        for text, made in zip(texts * 5, got, strict=True):
            w = (text or "").encode().lower().split()
            plain = frozenset(tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset()
            assert len(made) == len(plain) and names.setdefault(plain, made.tolist()) == made.tolist()
    assert len({tuple(v) for v in names.values()}) == len(names)


def test_few_edges_have_the_components_of_many(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(5, 5), (None, 3), (3, None), (777, 777)]
    df = spark.createDataFrame(edges, "a long, b long")
    want = sorted(map(tuple, connected_components(df).collect()))
    assert sorted(map(tuple, connected_components(df, 1000).collect())) == want == sorted(map(tuple, connected_components(df, 10).collect()))
    assert connected_components(df.where("a > 1000"), 10).count() == 0


@pytest.mark.parametrize("few", [1024, 1])
def test_partners_of_a_group_have_one_head(monkeypatch, few):
    monkeypatch.setattr(ngram_join, "_FEW", few)  # 1: by tries
    rng = random.Random(few)
    rare = [np.array(sorted(rng.sample(range(100 * f, 100 * f + 40), 34)), np.uint64) for f in (0, 1, 2) for _ in range(6)] + [np.array([7, 107, 207, 5000], np.uint64)]
    m = len(rare)
    got = ngram_join.trie_partners(rare, [100] * m, list(range(m)), [True] * m, [True] * m)
    assert [i for i, _ in got] == list(range(m - 1))  # the last one shares a shingle with each family, no more
    assert [h // 6 for _, h in got] == [i // 6 for i in range(m - 1)] and len({h for _, h in got}) == 3
