"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score is ``sigmoid(b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)``. The pairwise sum is taken in linear time
as half of ``|sum v_i x_i|^2 - sum |v_i x_i|^2``. A text's features are its distinct words (each
``1 / sqrt(number of them)``), and one bucket each of several structure statistics and of the metadata column
``n_chars``, all hashed into one table of weights.

Spark computes the features in SQL; NumPy scores Arrow batches of them. The machine is fitted on a bounded sample of
labelled rows, the first by a hash of their id, each whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm._common import hash_sample, materialize, slices

WORD_SLOTS = 1 << 16
STAT_SLOTS = 1 << 10
RANK = 8
SAMPLE_DOCS = 6_000
#: Distinct words of all sample rows together, about: rows are taken in the order of a hash, each whole, until there are so many.
SAMPLE_WORDS = 4_000_000
EPOCHS = 12
RATE = 0.02
DECAY = 2e-4
CUT = 0.3

BLANK = r"[\\x20\\x09-\\x0D]+"


def features(docs: DataFrame, text: str = "text", metadata: str = "n_chars") -> DataFrame:
    """``doc_id``, ``words`` (slots of distinct lower-case words) and ``stats`` (slots of buckets).

    A null text counts as empty. Missing metadata is a bucket of its own.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    slim = docs.select("doc_id", t.alias("t"), (F.col(metadata) if metadata in docs.columns else F.lit(None)).cast("double").alias("meta"))
    count = lambda keep: F.expr(f"char_length(regexp_replace(t, '[^{keep}]+', ''))").cast("double")
    made = slim.select(
        "doc_id",
        "meta",
        F.expr(f"transform(filter(split(lower(t), '{BLANK}'), x -> x <> ''), x -> cast(pmod(xxhash64(x), {WORD_SLOTS}) AS int))").alias("all"),
        F.expr("char_length(t)").cast("double").alias("chars"),
        F.expr(f"char_length(regexp_replace(t, '{BLANK}', ''))").cast("double").alias("ink"),
        count("#*$%&|<>").alias("symbols"),
        count(r"\\p{Lu}").alias("upper"),
        count("0-9").alias("digits"),
        count(".!?").alias("stops"),
        F.expr("size(split(t, '\\n'))").cast("double").alias("lines"),
        F.expr("size(array_distinct(split(t, '\\n')))").cast("double").alias("own_lines"),
    )
    made = made.select("*", F.array_distinct("all").alias("words"), F.size("all").cast("double").alias("n"))
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    step = lambda c, width, most: F.least(F.floor(c / F.lit(width)), F.lit(most)).cast("int")
    kinds = [
        step(F.log2(F.col("chars") + 1), 1.0, 40),
        step(share(F.col("ink"), F.col("n")), 0.5, 60),
        step(share(F.col("symbols"), F.col("ink")), 0.02, 50),
        step(share(F.col("upper"), F.col("ink")), 0.04, 25),
        step(share(F.col("digits"), F.col("ink")), 0.04, 25),
        step(share(F.col("stops"), F.col("n")), 0.05, 20),
        step(share(F.size("words").cast("double"), F.col("n")), 0.05, 20),
        step(share(F.col("own_lines"), F.col("lines")), 0.05, 20),
        F.coalesce(step(F.log2(F.greatest("meta", F.lit(0.0)) + 1), 1.0, 40), F.lit(41)),
    ]
    stats = F.array(*(F.pmod(F.xxhash64(F.lit(f"stat {i}"), k), F.lit(STAT_SLOTS)).cast("int") + F.lit(WORD_SLOTS) for i, k in enumerate(kinds)))
    return made.select("doc_id", "words", stats.alias("stats"))


@dataclass
class Machine:
    bias: float
    weights: np.ndarray  # slots
    factors: np.ndarray  # slots x rank

    def score(self, slots: np.ndarray, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Probabilities of rows whose features lie one after the other; every row has one at least."""
        at = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        linear = np.add.reduceat(self.weights[slots] * x, at)
        vx = self.factors[slots] * x[:, None]
        pairs = 0.5 * ((np.add.reduceat(vx, at, axis=0) ** 2).sum(axis=1) - np.add.reduceat((vx * vx).sum(axis=1), at))
        return 1.0 / (1.0 + np.exp(-np.clip(self.bias + linear + pairs, -30, 30)))


def _rows(words, stats) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots, values and row sizes of Arrow list arrays; words and stats of a row lie together."""
    n_words = np.diff(words.offsets.to_numpy(zero_copy_only=False))
    n_stats = np.diff(stats.offsets.to_numpy(zero_copy_only=False))
    w, s = words.flatten().to_numpy(zero_copy_only=False), stats.flatten().to_numpy(zero_copy_only=False)
    sizes = n_words + n_stats
    row = np.concatenate((np.repeat(np.arange(len(sizes)), n_words), np.repeat(np.arange(len(sizes)), n_stats)))
    order = np.argsort(row, kind="stable")
    x = np.concatenate((np.repeat(1.0 / np.sqrt(np.maximum(n_words, 1)), n_words), np.ones(len(s)))).astype(np.float32)
    return np.concatenate((w, s))[order], x[order], sizes


def fit(slots: np.ndarray, x: np.ndarray, sizes: np.ndarray, y: np.ndarray, seed: int = 7) -> Machine:
    """Adam on the log loss with weight decay, over shuffled batches of 256 rows."""
    rng = np.random.default_rng(seed)
    n_slots = WORD_SLOTS + STAT_SLOTS
    share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
    machine = Machine(math.log(share / (1 - share)), np.zeros(n_slots, np.float32), rng.normal(0, 0.02, (n_slots, RANK)).astype(np.float32))
    if not len(y) or y.min() == y.max():
        return machine
    starts = np.concatenate(([0], np.cumsum(sizes)))
    params = np.concatenate((machine.weights[:, None], machine.factors), axis=1)
    m, v, bias, step = np.zeros_like(params), np.zeros_like(params), machine.bias, 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(order), 256):
            batch = order[at : at + 256]
            pick = np.concatenate([np.arange(starts[b], starts[b + 1]) for b in batch])
            s, xs, n = slots[pick], x[pick], sizes[batch]
            row = np.repeat(np.arange(len(batch)), n)
            used, inverse = np.unique(s, return_inverse=True)
            p = params[used]
            machine = Machine(bias, p[:, 0], p[:, 1:])
            error = (machine.score(inverse, xs, n) - y[batch]) / len(batch)
            vx = p[inverse, 1:] * xs[:, None]
            total = np.add.reduceat(vx, np.concatenate(([0], np.cumsum(n)[:-1])), axis=0)
            each = np.concatenate((xs[:, None], xs[:, None] * (total[row] - vx)), axis=1) * error[row][:, None]
            grad = np.stack([np.bincount(inverse, each[:, k], len(used)) for k in range(RANK + 1)], axis=1) + DECAY * p / 10
            step += 1
            bias -= RATE * float(error.sum())
            m[used] = 0.9 * m[used] + 0.1 * grad
            v[used] = 0.999 * v[used] + 0.001 * grad**2
            params[used] = p - RATE * (m[used] / (1 - 0.9 ** min(step, 200))) / (np.sqrt(v[used] / (1 - 0.999**step)) + 1e-8)
    return Machine(bias, np.ascontiguousarray(params[:, 0]), np.ascontiguousarray(params[:, 1:]))


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", most: int = SAMPLE_DOCS) -> Machine:
    """Fit on at most ``most`` rows of ``labels`` (``doc_id``, ``quality``) and their whole texts, and on ``SAMPLE_WORDS`` words in all.

    Null ids and labels teach nothing; of several labels of one document the greatest counts.
    """
    marks = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("y"))
    sample = hash_sample(marks, most, "doc_id", salt="machine")
    rows = features(docs.join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi"), text)  # ``most`` ids: bounded
    rows = materialize(rows.join(F.broadcast(sample), "doc_id").select("doc_id", "words", "stats", "y", F.xxhash64(F.col("doc_id").cast("string"), "words", "stats").alias("h")).dropDuplicates(["h"]), "machine-sample")
    sizes = rows.select("h", F.size("words").alias("n")).orderBy("h").limit(2 * most)  # numbers only
    seen, last = 0, None
    for r in sizes.collect():
        if seen >= SAMPLE_WORDS:
            break
        seen, last = seen + r["n"], r["h"]
    found = rows.where(F.col("h") <= F.lit(last)).drop("h").toArrow().combine_chunks().sort_by([("doc_id", "ascending")]).combine_chunks()
    if not found.num_rows:
        none = np.zeros(0, np.int64)
        return fit(none, none.astype(np.float32), none, none.astype(np.float32))
    words, stats = found["words"].combine_chunks(), found["stats"].combine_chunks()
    return fit(*_rows(words, stats), found["y"].to_numpy().astype(np.float32))


def classify(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """``doc_id``, ``score`` (0 to 1, higher: better) and ``predicted`` for each row.

    Null and empty texts are scored from their statistics alone. Repeated rows stay; an empty table gives an empty
    result; columns besides id, text and ``n_chars`` are ignored.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # slots x (rank + 1) floats: 2.4 MB whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, 256):
            score = m.score(*_rows(b.column("words"), b.column("stats"))).astype(np.float64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score), pa.array((score >= CUT).astype(np.int32))], names=schema.names)

    return features(docs, text).mapInArrow(run, schema)
