"""Quality rules: word statistics, fixed base rules, and a learned decision list. Spark SQL only.

The list is learned by sequential covering. A rule grows one threshold at a time, each time the one with the greatest
information gain for bad documents, and is then pruned on rows held back from growing. Rows that a finished
rule covers are left out of the next one. The result is an ordered ``when`` expression over the statistics.

Thresholds are quantiles, so every growing step is one small group-by over (statistic, bin) and only its
counts come to the driver. Growing uses a bounded sample of labelled rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm._common import hash_sample, materialize

WINDOW = 8
MIN_WORDS = 20
MOST_REPEATED = 30  # per cent
#: Labelled rows used for learning, at most; the first by a hash of their id.
SAMPLE_DOCS = 20_000
BINS = 24
MOST_RULES = 8
MOST_CONDITIONS = 3
MIN_COVER = 5
MIN_PRECISION = 0.9

BLANK = r"[\\x20\\x09-\\x0D]+"  # in an SQL literal

#: Statistics that rules may test.
FEATURES = {
    "mean_word": "word_chars / n_words",
    "symbol_share": "n_symbols / word_chars",
    "dup_line_share": "n_dup_lines / n_lines",
    "repeat_share": "n_repeat_words / n_words",
    "distinct_share": "n_distinct / n_words",
    "upper_share": "n_upper / word_chars",
    "digit_share": "n_digits / word_chars",
    "mark_share": "n_marks / word_chars",
    "words": "n_words",
}


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is then computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def repeat_words_sql(words: str, window: int = WINDOW) -> str:
    """How many of the words stand in a window of ``window`` words that is found twice or more.

    Windows are compared by 64-bit hashes within one text. Texts without a repeated window end at the set test.
    """
    positions = _let(
        "sort_array(transform(h, (x, i) -> struct(x AS x, i AS i)))",
        "s",
        "sort_array(transform(filter(sequence(0, size(s) - 1), j -> coalesce(get(s, j - 1).x = get(s, j).x, false)"
        " OR coalesce(get(s, j + 1).x = get(s, j).x, false)), j -> get(s, j).i))",
    )
    covered = _let(positions, "p", f"aggregate(sequence(1, size(p) - 1), {window}, (a, k) -> a + least({window}, get(p, k) - get(p, k - 1)))")
    hashes = _let(f"transform({words}, x -> xxhash64(x))", "g", f"transform(sequence(1, size(g) - {window - 1}), i -> xxhash64(slice(g, i, {window})))")
    counted = _let(hashes, "h", f"if(size(array_distinct(h)) = size(h), 0, {covered})")
    return f"if(size({words}) < {window}, 0, {counted})"


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with counts of words, characters, symbols and repeats (long).

    A null text counts as empty and has zeros. Other columns pass through except old ones of the same names.
    """
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct"]
    t = f"coalesce(`{text}`, '')"
    count = lambda keep: F.expr(f"char_length(regexp_replace({t}, '[^{keep}]+', ''))").cast("long")
    words = f"filter(split({t}, '{BLANK}'), x -> x <> '')"
    lines = f"filter(split({t}, '\\n'), x -> x RLIKE '[^\\\\x20\\\\x09-\\\\x0D]')"
    both = docs.drop(*made).withColumns({
        "__words": F.expr(_let(words, "w", f"named_struct('n', size(w), 'own', size(array_distinct(w)), 'repeated', {repeat_words_sql('w')})")),
        "__lines": F.expr(_let(lines, "l", "named_struct('n', size(l), 'again', size(l) - size(array_distinct(l)))")),
        "word_chars": F.expr(f"char_length(regexp_replace({t}, '{BLANK}', ''))").cast("long"),
        "n_symbols": count("#*$%&|<>"),
        "n_upper": count(r"\\p{Lu}"),
        "n_digits": count("0-9"),
        "n_marks": count("!?"),
    })
    both = both.withColumns({
        "n_words": F.col("__words.n").cast("long"),
        "n_repeat_words": F.col("__words.repeated").cast("long"),
        "n_distinct": F.col("__words.own").cast("long"),
        "n_lines": F.col("__lines.n").cast("long"),
        "n_dup_lines": F.col("__lines.again").cast("long"),
    })
    return both.drop("__words", "__lines", *([text] if text not in made else []))


BASE_FAILED = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words"


def with_features(stats: DataFrame) -> DataFrame:
    """Adds the tested statistics as doubles; zero where there is nothing to divide by."""
    return stats.withColumns({f"f_{k}": F.expr(f"coalesce(try_divide(cast({(v.split(' / ') + ['1'])[0]} AS double), {(v.split(' / ') + ['1'])[1]}), 0D)") for k, v in FEATURES.items()})


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # true: value > threshold, false: value <= threshold
    threshold: float

    def column(self) -> Column:
        c, t = F.col(f"f_{self.feature}"), F.lit(self.threshold)
        return c > t if self.above else c <= t

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Ordered rules for bad documents; the first that holds decides, and none holding keeps."""

    rules: list[tuple[Condition, ...]] = field(default_factory=list)

    def column(self) -> Column:
        """Whether a row is kept, over the columns of ``with_features``."""
        out = None
        for rule in self.rules:
            hit = _all(rule)
            out = F.when(hit, F.lit(False)) if out is None else out.when(hit, F.lit(False))
        return F.lit(True) if out is None else out.otherwise(F.lit(True))

    def __str__(self) -> str:
        return "\n".join([*(f"IF {' AND '.join(map(str, r))} THEN reject" for r in self.rules), "ELSE keep"])


def _all(rule: tuple[Condition, ...]) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """Information gain of narrowing (p0, n0) to (p, n) bad and good rows."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _best(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[Condition | None, int, int]:
    """The condition with the greatest gain on ``rows``; bad and good rows it leaves."""
    bins = [F.struct(F.lit(k).alias("feature"), sum((F.col(f"f_{k}") > F.lit(c)).cast("int") for c in v).alias("bin")) for k, v in cuts.items() if v]
    if not bins:
        return None, 0, 0
    counted = rows.select("bad", F.explode(F.array(*bins)).alias("b")).groupBy("b.feature", "b.bin").agg(F.sum(F.col("bad").cast("int")).alias("p"), F.sum((~F.col("bad")).cast("int")).alias("n"))
    table: dict[str, dict[int, tuple[int, int]]] = {}
    for r in counted.collect():  # statistics times bins
        table.setdefault(r["feature"], {})[r["bin"]] = (r["p"], r["n"])
    found = (0.0, "", None, 0, 0)
    for k, by_bin in table.items():
        p0, n0 = (sum(x[i] for x in by_bin.values()) for i in (0, 1))
        p = n = 0
        for i, cut in enumerate(cuts[k]):
            a, b = by_bin.get(i, (0, 0))
            p, n = p + a, n + b
            for above, x, y in ((False, p, n), (True, p0 - p, n0 - n)):
                gain = _gain(x, y, p0, n0)
                if x >= MIN_COVER and (gain, f"{k}{above}") > found[:2] and gain > 1e-9:
                    found = (gain, f"{k}{above}", Condition(k, above, cut), x, y)
    condition, p, n = found[2:]
    if condition is not None:  # half-way between the values on either side: a stray symbol is no rule
        f = F.col(f"f_{condition.feature}")
        below, over = rows.agg(F.max(F.when(f <= condition.threshold, f)), F.min(F.when(f > condition.threshold, f))).first()
        if below is not None and over is not None:
            condition = Condition(condition.feature, condition.above, (below + over) / 2)
    return condition, p, n


def learn(labelled: DataFrame, most_rules: int = MOST_RULES) -> DecisionList:
    """A decision list from rows of statistics with a boolean ``bad``; null ``bad`` teaches nothing.

    ``labelled`` must hold ``doc_id``. At most ``SAMPLE_DOCS`` rows are used. Without rows of both kinds the
    list is empty and keeps all.
    """
    h = F.xxhash64(F.col("doc_id").cast("string"), F.lit("rules"))
    rows = with_features(labelled.where("bad is not null")).select("doc_id", "bad", h.alias("h"), *(f"f_{k}" for k in FEATURES))
    rows = materialize(hash_sample(rows, SAMPLE_DOCS, "doc_id", salt="sample").drop("doc_id").coalesce(1), "rule-sample")
    at = [i / BINS for i in range(1, BINS)]
    quantiles = rows.agg(*(F.percentile_approx(f"f_{k}", at, 1000).alias(k) for k in FEATURES)).first()
    cuts = {k: sorted(set(quantiles[k] or ())) for k in FEATURES}
    grow, held = rows.where("pmod(h, 3) <> 0"), rows.where("pmod(h, 3) = 0")
    out = DecisionList()
    for _ in range(most_rules):
        for rule in out.rules[-1:]:
            grow, held = grow.where(~_all(rule)), held.where(~_all(rule))
        rule: tuple[Condition, ...] = ()
        for _ in range(MOST_CONDITIONS):
            condition, bad, good = _best(grow.where(_all(rule)), cuts)
            if condition is None:
                break
            rule = (*rule, condition)
            if good <= 0.01 * bad:
                break
        if not rule:
            break
        sums = [F.sum((_all(rule[:k]) & (F.col("bad") == want)).cast("int")) for k in range(1, len(rule) + 1) for want in (True, False)]
        counts = [c or 0 for c in held.agg(*sums).first()]
        scored = [((p - n) / (p + n) if p + n else -1.0, -k, p, n) for k, (p, n) in enumerate(zip(counts[::2], counts[1::2], strict=True), 1)]
        _, k, p, n = max(scored)
        if p + n < MIN_COVER or p < MIN_PRECISION * (p + n):
            break
        out.rules.append(rule[:-k])
    return out


def judge(docs: DataFrame, labels: DataFrame, text: str = "text") -> tuple[DataFrame, DecisionList]:
    """Statistics, ``base_failed`` and ``kept`` for every row of ``docs``, and the list that decided.

    ``labels`` holds ``doc_id`` and ``quality`` (0: bad). Rows that fail a base rule are not kept; others as the list says.
    Null and empty texts fail the base rule on words. Repeated rows stay; rows of ``labels`` may repeat or be null.
    An empty table gives an empty result.
    """
    stats = materialize(statistics(docs.select("doc_id", F.col(text).alias("text"))), "statistics")
    stats = stats.withColumn("base_failed", F.expr(BASE_FAILED))
    marks = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg((F.max("quality") == 0).alias("bad"))
    rules = learn(stats.where("NOT base_failed").join(marks, "doc_id"))
    verdict = with_features(stats).withColumn("kept", ~F.col("base_failed") & rules.column())
    return verdict.drop(*(f"f_{k}" for k in FEATURES)), rules
