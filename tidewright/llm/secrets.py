"""Secret scans: fixed patterns, and character Markov models for what no pattern knows.

Two models of order one over character classes of a token alphabet, one of random strings and one of
ordinary identifiers, give a token's log-likelihood ratio for each character. A token at least
``MIN_LENGTH`` long whose mean ratio and whose total are high enough is a secret of kind ``random``; a token of letters in one case
needs more, as joined words look much like it.

Training samples are labelled: values that the fixed patterns find in the corpus, with random strings
that Spark derives from row hashes, are random; all other tokens of the corpus, as they are and in upper case, are ordinary. Tasks
count character pairs in whole texts and Spark adds the counts up, so every document counts and none leaves Spark.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm import spans as S
from tidewright.llm._common import map_texts, slices

KINDS = ("assign", "access", "hex", "random")
#: Random strings that the random model is made of, besides the values that the fixed patterns find.
RANDOM_STRINGS = 4_000
MIN_LENGTH = 16
#: Different characters that a token must have; rulers such as ``=====`` have fewer.
MIN_DISTINCT = 6
MIN_MEAN = 1.0
MIN_TOTAL = 20.0
#: The same for tokens of letters in one case.
MIN_MEAN_LETTERS = 1.3
MIN_TOTAL_LETTERS = 28.0

# Fixed patterns; letters of the keyword in either case, ASCII only.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # longest runs, so short ones may be left out at once
TOKEN = re.compile(rf"[A-Za-z0-9+/_=-]{{{MIN_LENGTH},}}")

Model = dict[str, float]


def base_spans(text: str) -> list[S.Span]:
    """Spans of the fixed patterns by start, then kind."""
    found = S.matches(ASSIGN, text, "assign", lambda m: len(m[1]) >= 8)
    if "AKIA" in text:
        found += S.matches(ACCESS, text, "access", lambda m: len(m[0]) >= 16)
    found += S.matches(HEX, text, "hex", lambda m: True)
    return sorted(found, key=S.by_start(KINDS))


def _class(c: str) -> str:
    return c if c.isascii() and c.isalnum() else "_" if c in "_-" else "+"


def ratio(token: str, model: Model) -> float:
    """Log-likelihood of the token as a random string less that as an identifier."""
    before, total = "^", 0.0
    for c in token:
        c = _class(c)
        total += model.get(before + c, 0.0)
        before = c
    return total


def extra_spans(text: str, model: Model, base: list[S.Span]) -> list[S.Span]:
    """Tokens that look random and touch no span of the fixed patterns."""
    out, known = [], None
    for m in TOKEN.finditer(text):
        token = m[0]
        letters = token.isalpha() and (token.islower() or token.isupper() or token.istitle())
        mean, least = (MIN_MEAN_LETTERS, MIN_TOTAL_LETTERS) if letters else (MIN_MEAN, MIN_TOTAL)
        total = ratio(token, model)
        if total >= least and total >= mean * len(token) and len(set(token)) >= MIN_DISTINCT:
            known = known or S.Cover(base)
            if not known.overlaps(*m.span()):
                out.append((*m.span(), "random"))
    return out


def scan(text: str | None, model: Model) -> tuple[list[S.Span], list[S.Span]]:
    """Base spans, and all spans, both by start and then kind. A null text is empty."""
    text = text or ""
    base = base_spans(text)
    return base, sorted(base + extra_spans(text, model, base), key=S.by_start(KINDS))


#: The alphabet of tokens by class; place 0 stands for what is before a token.
_CLASSES = "^" + "".join(c for c in map(chr, range(128)) if c.isalnum()) + "_+"
_SIZE = len(_CLASSES)
_CLASS_OF = np.zeros(256, np.uint16)
for _c in map(chr, range(128)):
    if _c.isalnum() or _c in "+/_=-":
        _CLASS_OF[ord(_c)] = _CLASSES.index(_class(_c))
_UPPER_OF = np.array([_CLASSES.index(c.upper()) for c in _CLASSES])


def _count(text: str) -> np.ndarray:
    """How often each class follows each in the tokens of a text, ``^`` standing before a token's first character."""
    c = _CLASS_OF[np.frombuffer(text.encode("utf-8"), np.uint8)]
    before = np.concatenate((np.zeros(1, np.uint16), c[:-1]))
    return np.bincount(before * np.uint16(_SIZE) + c, minlength=_SIZE * _SIZE)


def count_pairs(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Pair counts of the values of fixed patterns (16 characters or more), and of all else."""
    text = text or ""
    spans = base_spans(text)
    values = [text[a:e] for a, e, k in spans if k != "assign"] + [m[1] for m in ASSIGN.finditer(text)]
    secret = _count(" ".join(v for v in values if len(v) >= 16))
    out, at = [], 0
    for a, e, _ in spans:
        out.append(text[at : max(a, at)])
        at = max(at, e)
    return secret, _count(" ".join([*out, text[at:]]))


def train(docs: DataFrame, text: str = "text") -> Model:
    """The log ratio of each character pair, from every text of ``docs``.

    A task adds up its texts and gives at most ``2 * 65 * 65`` counts, so some 8,500 sums come to the driver whatever
    the size. ``RANDOM_STRINGS`` strings in hexadecimal and base64 are added to the random model. Null texts count as empty; without any
    text the ordinary model is flat.
    """
    schema = T.StructType([T.StructField("pair", T.IntegerType()), T.StructField("random", T.LongType()), T.StructField("ordinary", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, _SIZE * _SIZE), np.int64)
        for b in slices(batches):
            for x in b.column(0).to_pylist():
                sums += count_pairs(x)
        at = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums[0][at]), pa.array(sums[1][at])], names=schema.names)

    digest = F.sha2(F.concat(F.lit("random "), F.col("id").cast("string")), 256)
    random = docs.sparkSession.range(RANDOM_STRINGS).select(F.concat_ws(" ", F.base64(F.unhex(digest)), F.substring(digest, 1, 40)).alias("t"))
    made = np.zeros(_SIZE * _SIZE, np.int64)
    for r in random.collect():  # a fixed number of short strings
        made += _count(r["t"])
    counted = docs.select(F.col(text)).mapInArrow(run, schema).groupBy("pair").agg(F.sum("random").alias("random"), F.sum("ordinary").alias("ordinary")).collect()
    secret, ordinary = made, np.zeros(_SIZE * _SIZE, np.int64)
    for r in counted:
        secret[r["pair"]] += r["random"]
        ordinary[r["pair"]] = r["ordinary"]
    return model_of(secret, ordinary)


def model_of(secret: np.ndarray, ordinary: np.ndarray) -> Model:
    """Log ratios from pair counts.

    Ordinary words also count in upper case, and as joined into identifiers, a third with a capital and a third with ``_`` between.
    """
    square = ordinary.reshape(_SIZE, _SIZE).astype(float)
    np.add.at(square, (_UPPER_OF[:, None], _UPPER_OF[None, :]), square.copy())
    ends, starts = square[1:, 0], square[0, 1:]
    joined = np.outer(ends, starts) / (3 * max(1.0, starts.sum()))
    mark = _CLASSES.index("_")
    inner = square.copy()
    np.add.at(inner, (np.arange(1, _SIZE)[:, None], _UPPER_OF[None, 1:]), joined)
    inner[1:, mark] += ends / 3
    inner[mark, 1:] += starts / 3
    name = lambda i: _CLASSES[i // _SIZE] + _CLASSES[i % _SIZE]
    pairs = lambda x: [(name(i), int(n)) for i, n in enumerate(x.tolist()) if n >= 1 and i % _SIZE]
    return log_ratios(pairs(secret), pairs(inner.reshape(-1)))


def log_ratios(random: list[tuple[str, int]], ordinary: list[tuple[str, int]]) -> Model:
    """Smoothed transition probabilities of two Markov models as log ratios."""
    letters = _CLASSES[1:]

    def logs(counted):
        n = dict(counted)
        totals: dict[str, int] = {}
        for p, k in counted:
            totals[p[0]] = totals.get(p[0], 0) + k
        return {a + b: math.log((n.get(a + b, 0) + 0.5) / (totals.get(a, 0) + 0.5 * len(letters))) for a in ["^", *letters] for b in letters}

    r, o = logs(random), logs(ordinary)
    return {p: r[p] - o[p] for p in r}


FIELDS = T.StructType([T.StructField(f"n_{k}", T.LongType()) for k in KINDS] + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])


def scan_secrets(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``n_assign``, ``n_access``, ``n_hex``, ``n_random``, ``base_sha256`` and ``spans``; drops ``text``.

    ``spans`` lists all spans as ``kind:start:end`` by start; ``base_sha256`` digests those of
    the fixed patterns. Null and empty texts have none. Very long texts are scanned whole, in time linear in them but for a sort of
    the spans. Spans of one start are ordered by kind, then end. Other columns pass through except old ones of these
    names; repeated rows stay; an empty table gives an empty result.
    """

    def start():
        def work(texts):
            out: dict[str, list] = {f.name: [] for f in FIELDS}
            for x in texts:
                base, spans = scan(x, model)
                for k in KINDS:
                    out[f"n_{k}"].append(sum(s[2] == k for s in spans))
                out["base_sha256"].append(S.sha256(S.joined(base)))
                out["spans"].append(S.joined(spans))
            return out

        return work

    return map_texts(docs.drop(*FIELDS.names), start, FIELDS, text)


def redact(text: str | None, spans: list[S.Span], mark: str = "<secret>") -> str | None:
    """The text with every span replaced; overlapping spans become one mark."""
    if text is None:
        return None
    out, at = [], 0
    for start, end, _ in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
