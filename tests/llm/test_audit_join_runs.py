"""Filter audit, n-gram join and periodic runs against SQL and plain code, on whole tables and awkward rows."""

import hashlib
import itertools
import random
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_corpus import DOCS, awkward

from tidewright.llm import filter_audit, ngram_join, periodic_runs, personal, sketches
from tidewright.llm._common import table
from tidewright.llm.queries import ORACLE_SQL, QUERIES, words_with_runs


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(awkward(), DOCS)
    return df.withColumns({c: F.lit("clash") for c in ("part", "failed", "h", "set", "rare", "row", "runs", "token", "n_words", "maybe")})


def by_sql(name, sf_dir, **tables):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    res = con.execute(ORACLE_SQL[name])
    cols = [c[0] for c in res.description]
    return {tuple(r[cols.index(c)] for c in sorted(cols)) for r in res.fetchall()}


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_ngram_join"])
def test_queries_equal_sql(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    rows = [tuple(r[c] for c in sorted(got.columns)) for r in got.collect()]
    assert set(rows) == by_sql(name, sf_dir) and len(set(rows)) == len(rows)


# --- filter audit


def plain_failures(rows):
    """Failed letters of each ``(doc_id, text)``."""
    low = {}
    for i, t in rows:
        if i is not None:
            low[t or ""] = min(i, low.get(t or "", i))
    out = []
    for i, t in rows:
        t = t or ""
        w = t.encode().split()
        bad = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), "D": any(c in "#$%&*|" for c in t), "E": i is not None and low[t] < i}
        out.append("".join(k for k, v in bad.items() if v))
    return out


@pytest.mark.parametrize("most", [1 << 16, 1 << 27])
def test_failures_of_awkward_rows(spark, odd, most):
    more = spark.createDataFrame([(20, None), (21, ""), (22, "SAME A%"), (23, "SAME A%"), (23, "SAME A%"), (22, "other"), (None, "SAME A%"), (24, "v\x0bw x"), (25, "ÄÖ" * 400_000 + "A" * 30_000)], "doc_id long, text string")
    df = odd.unionByName(more, allowMissingColumns=True)
    got = filter_audit.failures(df, most=most).collect()
    want = plain_failures([(r.doc_id, r.text) for r in df.collect()])
    letters = lambda m: "".join(k for i, k in enumerate("ABCDE") if m >> i & 1)
    assert sorted((repr(r.doc_id), letters(r.failed)) for r in got) == sorted((repr(r.doc_id), w) for r, w in zip(df.collect(), want, strict=True))
    assert {r.part for r in got} == {"", "en", "fr"}


def test_audit_of_every_order(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (6, 1, None), (7, None, 1), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    rows = odd.select("doc_id", "lang", "text").collect()
    fails = plain_failures([(r.doc_id, r.text) for r in rows])
    got = {(r.part, r.filter_order, r.step): r for r in filter_audit.audit(odd, labels).collect()}
    assert len(got) == 3 * 600
    share = {}
    for part, order in itertools.product(("", "en", "fr"), itertools.permutations("ABCDE")):
        here = [(r.doc_id, f) for r, f in zip(rows, fails, strict=True) if (r.lang or "") == part]
        for k, own in enumerate(order):
            gone = [i for i, f in here if own in f and not set(order[:k]) & set(f)]
            share[part, own] = share.get((part, own), 0) + len(gone)
            r = got[part, "".join(order), k + 1]
            assert (r.kept, r.removed, r.redundant) == (sum(not set(order[: k + 1]) & set(f) for _, f in here), len(gone), sum(own in f and bool(set(order[:k]) & set(f)) for _, f in here))
            assert (r.unique_fails, r.good_lost, r.toxic_lost) == (sum(f == own for _, f in here), sum(i in (1, 6) for i in gone), sum(i in (1, 7) for i in gone))
    assert all(r.shapley == share[part, order[step - 1]] for (part, order, step), r in got.items())
    assert filter_audit.audit(odd.limit(0), labels).count() == 0 and filter_audit.audit(odd, labels.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def test_sketches_never_clear_repeats(spark):
    rng = np.random.default_rng(5)
    hashes = np.concatenate([rng.integers(-(1 << 63), 1 << 63, 5000), np.repeat(rng.integers(-(1 << 63), 1 << 63, 40), 3)])
    df = spark.createDataFrame([(int(h),) for h in hashes], "h long").repartition(7)
    bits = sketches.counted_bits(df, len(hashes), 2)
    assert sketches.may_count(hashes[5000:], bits).all() and sketches.may_count(hashes[:5000], bits).mean() < 0.05
    assert not sketches.may_count(hashes, sketches.counted_bits(df.limit(0), 0, 1)).any()


# --- n-gram join


def components(m, edges):
    up = list(range(m))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(m)]


def similar(a, b):
    both = len(np.intersect1d(a, b))
    return 100 * both >= 85 * (len(a) + len(b) - both)


@pytest.mark.parametrize("walkers", [1, 3, 64])
def test_tries_find_what_pairs_find(monkeypatch, walkers):
    monkeypatch.setattr(ngram_join, "_WALKERS", walkers)
    rng = random.Random(walkers)
    for t in range(60):
        bases = [rng.sample(range(1000), rng.randrange(1, 60)) for _ in range(rng.randrange(1, 4))]
        sets = []
        for _ in range(rng.randrange(2, 30)):
            b = list(rng.choice(bases))
            for _ in range(rng.randrange(max(1, len(b) // 6))):
                b[rng.randrange(len(b))] = rng.randrange(100_000)
            sets.append(np.unique(np.array(b, np.uint64)))
        m = len(sets)
        links = [(i, j) for i in range(m) for j in range(i) if similar(sets[i], sets[j])]
        got = ngram_join.trie_links(sets, list(range(m)), [True] * m, [True] * m, [False] * m)
        assert {(max(e), min(e)) for e in got} <= set(links) and components(m, got) == components(m, links)
        common = np.random.default_rng(t).integers(0, 4, 256).astype(np.uint8)
        for i, j in links:
            assert set(ngram_join.prefix(sets[i], common).tolist()) & set(ngram_join.prefix(sets[j], common).tolist())


def plain_groups(rows):
    """Component of each ``(doc_id, text)`` with an id."""
    sets = [frozenset(tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))) if (w := (t or "").encode().lower().split()) else frozenset() for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    root = components(len(rows), links)
    return sorted((i, len(s), min(rows[k][0] for k in range(len(rows)) if root[k] == r)) for (i, _), s, r in zip(rows, sets, root, strict=True))


def variants(base, count, edits, rng):
    out = []
    for _ in range(count):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"own{rng.randrange(10**9)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [1 << 19, 900])
def test_groups_with_many_members(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)  # 900: groups of forty sets go in blocks, through all three deals
    rng = random.Random(2)
    base = [[f"w{rng.randrange(400)}" for _ in range(60)] for _ in range(3)]
    texts = variants(base[0], 60, 3, rng) + variants(base[1], 40, 2, rng) + variants(base[0][:30] + base[2][:30], 20, 3, rng)
    texts += [" ".join(base[2][:12] + [f"x{k}" for k in range(i, i + 25)]) for i in range(0, 600, 12)] + texts[:25] + ["a b", "A  b", "a b c d", ""]
    rows = list(enumerate(texts, 1))
    got = ngram_join.ngram_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(map(tuple, got.collect())) == plain_groups(rows)


def test_groups_of_awkward_rows(spark, odd):
    df = odd.unionByName(spark.createDataFrame([(5, "twice the same row"), (0, "TWICE the same\tROW"), (9, "w " * 300_000), (10, "w " * 200_000)], "doc_id long, text string"), allowMissingColumns=True)
    got = [tuple(r) for r in ngram_join.ngram_groups(df).collect()]
    want = {(1, 0, 1), (2, 0, 2), (3, 0, 3), (5, 1, 5), (5, 1, 0), (6, 1, 0), (0, 1, 0), (7, 1, 7), (8, 3, 8), (9, 1, 9), (10, 1, 9)}
    assert {r for r in got if r[0] is not None} == want and len(got) == df.count() and (None, 2, None) in got
    assert ngram_join.ngram_groups(odd.limit(0)).count() == 0


# --- periodic runs


def plain_runs(words):
    known, out = {}, {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], int)
    for q in range(1, len(ids) // 4 + 1):
        step = np.diff(np.concatenate(([0], (ids[:-q] == ids[q:]).astype(np.int8), [0])))
        for s, e in zip(np.flatnonzero(step == 1).tolist(), (np.flatnonzero(step == -1) + q).tolist(), strict=True):
            if e - s >= max(6, 4 * q):
                out.setdefault((s, e), q)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def plain_row(doc_id, words):
    runs = plain_runs(words)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_query(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").collect()
    got = sorted(map(tuple, QUERIES["op13_periodic_runs"](spark, sf_dir).collect()))
    assert got == sorted(plain_row(r.doc_id, words_with_runs(r.doc_id, r.text)) for r in rows) and any(r[1] > 1 for r in got)


@pytest.mark.parametrize("tile", [8, 4096])
def test_runs_of_made_up_words(spark, monkeypatch, tile):
    monkeypatch.setattr(periodic_runs, "TILE", tile)
    rng = random.Random(tile)
    rows = []
    for k in range(250):
        n, a = rng.randrange(0, 160), rng.choice([1, 2, 3, 60])
        w = [str(rng.randrange(a)) for _ in range(n)]
        for _ in range(rng.randrange(3)):
            if n > 8:
                p, s = rng.randrange(1, n // 4 + 1), rng.randrange(n)
                for i in range(s + p, min(n, s + rng.randrange(p, 8 * p + 1))):
                    w[i] = w[i - p]
        rows.append((k, " ".join(w)))
    rows.append((1000, "same " * 3000 + "a b c " * 2000))
    got = periodic_runs.run_digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, got.collect())) == sorted(plain_row(i, t.encode().split()) for i, t in rows)


def test_runs_of_awkward_rows(spark, odd):
    got = periodic_runs.run_digests(odd.unionByName(spark.createDataFrame([(7, "a a a a a a"), (7, "a a a a a"), (None, "b c " * 4)], "doc_id long, text string"), allowMissingColumns=True))
    found = sorted(((repr(r.doc_id), r.n_runs, r.length, r.period) for r in got.collect()), key=lambda r: (r[0], r[1], r[2] or 0))
    none = [(i, 0, None, None) for i in ("1", "2", "3", "5", "6", "6", "7", "8", "None")]
    assert found == sorted([*none, ("7", 1, 3000, 1), ("7", 1, 6, 1), ("None", 1, 8, 2)], key=lambda r: (r[0], r[1], r[2] or 0))
    assert periodic_runs.run_digests(odd.limit(0)).count() == 0


def test_a_very_long_text_takes_time_in_proportion():
    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(0, 50_000, 700_000), np.tile(rng.integers(0, 50_000, 40_000), 7)]).astype(np.int32)
    began = time.time()
    cut = periodic_runs.tiles(ids)
    found = {(q, t["base"] + s, t["base"] + e) for t in cut for q, s, e in periodic_runs.fragments(t["octave"], t["at"].tolist(), t["ids"].tolist()) if t["octave"] > 1000}
    assert {q for q, _, _ in found} == {40_000} and max(e for _, _, e in found) == len(ids) and min(s for _, s, _ in found) == 700_000
    assert time.time() - began < 30


# --- personal data in rows of blanks


@pytest.mark.parametrize("text", [" " * 1_000_000 + "dot", "о" + " " * 1_000_000 + "dot", "[ " * 500_000 + "dot", "a" + " " * 500_000 + "at" + " " * 500_000 + "dot", "one" + " " * 1_000_000 + "dot one"])
def test_rows_of_blanks_take_time_in_proportion(text):
    began = time.time()
    assert personal.scan(text) == ([], []) and personal.redact(text) == text
    assert time.time() - began < 10


def test_signs_in_rows_of_blanks():
    far = " " * 1000
    assert personal.redact(f"jo{far}[ at ]{far}mail{far}(dot){far}example {far}(dot) com") == "<email>"
    assert [s[2] for s in personal.scan("a [at] b [dot] c, d {at} e <dot> f")[1]] == ["email", "email"]
