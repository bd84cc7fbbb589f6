"""What each of five filters removes, in each of their 120 orders.

Four filters look at one text. The fifth fails texts that a smaller id has too, over the whole table. A counting Bloom filter goes before
it: every text counts in three counters of a sketch, one sketch a task, merged over all; a text with a counter below two is the
only one of its kind and is cleared. Only what may be a repeat is shuffled by its whole text for the smallest id, which the aggregation
finds with map-side combining, so a group of copies of any size meets as one row a task. A row passes the fifth filter if its id is that of its own text,
a join by id that no group makes uneven. The failures of a row are five bits, and counts of equal bits are all that the orders need.

Whatever the sketch lets through is decided by whole texts, so its size (fixed by the number of rows, 2^27 counters or 16 MB of bits at most) changes
what is shuffled and not what is found.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm._common import materialize
from tidewright.llm.sketches import counted_bits, may_count

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
WORDS = 200
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text that is not null fails: few words, few distinct ones, many capitals, signs."""
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, _UPPER, ""))
    hundred = F.lit(100).cast("long")  # texts may be long
    failed = (n < WORDS, hundred * distinct < 50 * n.cast("long"), hundred * capitals > 3 * F.length(text).cast("long"), text.rlike("[#$%&*|]"))
    return sum((f.cast("int") * (1 << i) for i, f in enumerate(failed)), F.lit(0))


def failures(docs: DataFrame, text: str = "text", most: int = 1 << 27) -> DataFrame:
    """``(doc_id, part, failed)`` for each row: bit ``i`` of ``failed`` says that it fails filter ``FILTERS[i]``.

    ``part`` is ``lang``, null being empty. A null text is empty. A row fails E if some smaller id has the identical text, kept or not, its own id not
    counting: rows that repeat an id and a text all pass where it is the smallest. A row without an id never fails E and makes no other
    fail. Texts of any length are compared whole. An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    slim = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    bits = spark.sparkContext.broadcast(counted_bits(slim.select(F.xxhash64("text")), docs.count(), 2, most=most))  # 16 MB at most
    flagged = slim.select("doc_id", "part", text_failures(F.col("text")).alias("failed"), F.xxhash64("text").alias("h"), "text")
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in flagged.schema), T.StructField("maybe", T.BooleanType())])

    def clear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            maybe = pa.array(may_count(b.column(3).to_numpy(zero_copy_only=False), bits.value))
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pc.if_else(maybe, b.column(4), pa.scalar(None, b.column(4).type)), maybe], names=schema.names)

    kept = materialize(flagged.mapInArrow(clear, schema), "filter-flags")
    first = kept.where("maybe and doc_id is not null").groupBy("text").agg(F.min("doc_id").alias("doc_id")).select("doc_id", F.xxhash64("text").alias("h"), F.lit(True).alias("first"))
    marked = kept.drop("text").join(first.distinct(), ["doc_id", "h"], "left")
    repeats = F.col("maybe") & F.col("doc_id").isNotNull() & F.col("first").isNull()
    return marked.select("doc_id", "part", F.when(repeats, F.col("failed").bitwiseOR(F.lit(1 << FILTERS.index("E")))).otherwise(F.col("failed")).alias("failed"))


def mask_counts(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, failed, n, good, toxic)``: rows by part and failures, and those with a label ``quality`` 1 or ``toxic`` 1.

    Of several labels of an id each counts: an id is good if one of them says so. Rows without an id or a label are neither.
    """
    told = labels.groupBy("doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    return failed.join(told, "doc_id", "left").groupBy("part", "failed").agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """One row for each part, order of the filters and step: ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``good_lost``, ``toxic_lost``, ``shapley``.

    A row is removed at the first step whose filter it fails. ``shapley`` adds up a filter's removals over all orders: of ``k`` failed filters
    each comes first in one ``k``-th of them. Zeros are included; parts are those of the rows, so an empty table gives an empty result.
    Nulls, ties and repeated rows are as in ``failures`` and ``mask_counts``.
    """
    counts = mask_counts(failures(docs, text), labels)
    steps = counts.withColumn("filter_order", F.explode(F.array(*(F.lit(o) for o in ORDERS)))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bit = lambda at: F.expr(f"shiftleft(1, ascii(substring(filter_order, {at}, 1)) - ascii('A'))")
    earlier = sum((F.when(F.col("step") > k, bit(k)).otherwise(0) for k in range(1, len(FILTERS))), F.lit(0))
    own, before = F.col("failed").bitwiseAND(bit("step")) != 0, F.col("failed").bitwiseAND(earlier) != 0
    here = own & ~before
    total = lambda test, of="n": F.coalesce(F.sum(F.when(test, F.col(of))), F.lit(0))
    share = F.expr(f"n * {len(ORDERS)} div bit_count(failed)")
    return steps.groupBy("part", "filter_order", "step").agg(
        total(~own & ~before).alias("kept"),
        total(here).alias("removed"),
        total(own & before).alias("redundant"),
        total(F.col("failed") == bit("step")).alias("unique_fails"),
        total(here, "good").alias("good_lost"),
        total(here, "toxic").alias("toxic_lost"),
        F.coalesce(F.sum(F.when(own, share)), F.lit(0)).alias("shapley"),
    )


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, min(doc_id) OVER (PARTITION BY t) AS low FROM d),
f AS (SELECT doc_id, part, len(ws) < 200 AS a, 100 * len(list_distinct(ws)) < 50 * len(ws) AS b,
  100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d, coalesce(low < doc_id, false) AS e FROM w),
l AS (SELECT doc_id, coalesce(max(CAST(quality = 1 AS INT)), 0) AS q, coalesce(max(CAST(toxic = 1 AS INT)), 0) AS x FROM labels GROUP BY doc_id),
m AS (SELECT part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END, CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS fails,
  count(*) AS n, coalesce(sum(q), 0) AS good, coalesce(sum(x), 0) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
s AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT concat(p.x, q.x, r.x, t.x, u.x) AS filter_order FROM s p, s q, s r, s t, s u
  WHERE len(list_distinct([p.x, q.x, r.x, t.x, u.x])) = 5),
g AS (SELECT part, filter_order, step, fails, n, good, toxic, substr(filter_order, step, 1) AS own,
  (SELECT min(p) FROM (SELECT unnest(range(1, 6)) AS p) WHERE contains(fails, substr(filter_order, CAST(p AS INT), 1))) AS first
  FROM m, o, (SELECT CAST(unnest(range(1, 6)) AS INT) AS step)),
r AS (SELECT part, filter_order, step, own,
  CAST(sum(CASE WHEN first IS NULL OR first > step THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN first = step THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN first < step AND contains(fails, own) THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN fails = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN first = step THEN good ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN first = step THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost FROM g GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r
"""
