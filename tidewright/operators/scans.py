"""Running totals and neighbours over orders that no single task could sort: rows are cut in ranges, each range is scanned on its own, and what it carries over is added.

The carried part has one row for each range (and key), so it is small whatever the table. Ranges follow the order column, so a key that holds most rows is many
tasks' work.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewright.functions.scalars import cuts_below
from tidewright.sources.files import kept

#: Ranges of a scan where the session's number of shuffle partitions is less.
LEAST_RANGES = 32


def _ranges(df: DataFrame) -> int:
    return max(LEAST_RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


class Totals:
    """Rows of an order column's values counted, in ranges: works for any type that Spark can sort.

    The table is read once, to count rows for each value with map-side combining. The counts are dealt by ranges of the value and written, so that their ranges stay as they are; ``sums`` holds
    one ``(range, rows, last value)`` for each range, in order.
    """

    def __init__(self, df: DataFrame, order: str, ranges: int | None = None):
        self.order, self.kind = order, df.schema[order].dataType
        counts = df.where(F.col(order).isNotNull()).groupBy(order).agg(F.count("*").alias("__n"))
        dealt = counts.repartitionByRange(ranges or _ranges(df), order)
        self.counts = kept(dealt.withColumn("__r", F.spark_partition_id()), "counts")
        per = self.counts.groupBy("__r").agg(F.sum("__n").alias("n"), F.max(order).alias("last"))
        self.sums = sorted((r["__r"], r["n"], r["last"]) for r in per.collect())  # one row a range
        self.rows = sum(n for _, n, _ in self.sums)

    def before(self) -> list[tuple[int, int]]:
        """``(range, rows before it)``."""
        out, total = [], 0
        for r, n, _ in self.sums:
            out.append((r, total))
            total += n
        return out

    def running(self, only: int | None = None) -> DataFrame:
        """``(value, __n, __total)``: rows up to and with each value; of one range if given. Each range is sorted in a task of its own."""
        counts = self.counts if only is None else self.counts.where(F.col("__r") == only)
        shift = F.create_map(*(F.lit(x) for pair in self.before() for x in pair)) if self.sums else F.create_map(F.lit(0), F.lit(0))
        own = F.sum("__n").over(Window.partitionBy("__r").orderBy(self.order).rowsBetween(Window.unboundedPreceding, 0))
        return counts.withColumn("__total", own + shift[F.col("__r")]).drop("__r")

    def cut(self, n: int, whole: bool) -> DataFrame:
        """One row ``__cut``: the last value that a cap of ``n`` rows takes in, null if none.

        ``whole`` takes a value only with all its rows inside the cap; else a value counts that has a first row inside. Only the range that holds the cut is sorted.
        """
        spark, last, total = self.counts.sparkSession, None, 0
        for r, k, high in self.sums:
            if total + k > n or (not whole and total + k == n):
                inside = F.col("__total") <= n if whole else F.col("__total") - F.col("__n") < n
                own = self.running(r).where(inside).agg(F.max(self.order).alias("__cut"))
                return own.select(F.coalesce("__cut", F.lit(last).cast(self.kind)).alias("__cut"))
            total, last = total + k, high
        return spark.range(1).select(F.lit(last).cast(self.kind).alias("__cut"))


def numbered(df: DataFrame, order: str, name: str, ranges: int | None = None) -> tuple[DataFrame, int]:
    """``df`` with its rows numbered from 0 by a column of distinct values of any type, nulls first, and the number of rows."""
    totals = Totals(df, order, ranges)
    nulls = df.where(F.col(order).isNull()).count()
    place = totals.running().select(F.col(order).alias("__v"), (F.col("__total") - F.col("__n") + nulls).alias(name))
    return df.join(place, F.col(order) == F.col("__v"), "left").withColumn(name, F.coalesce(name, F.lit(0))).drop("__v"), totals.rows + nulls


def pieces(df: DataFrame, order: str, n: int) -> Column:
    """The number of the time range that a row falls in, of ``n`` with about as many rows each; 0 for orders that have no percentiles and for nulls."""
    kind = df.schema[order].dataType
    if n < 2 or not isinstance(kind, T.NumericType | T.DateType | T.TimestampType | T.TimestampNTZType):
        return F.lit(0)
    bounds = df.agg(F.percentile_approx(order, [i / n for i in range(1, n)], 100 * n).alias("q")).first()["q"]
    return cuts_below(F.col(order), sorted(set(bounds or ())), kind)


def with_neighbours(df: DataFrame, keys: list[str], order: list[str], asked: dict[str, tuple[str, str]], n: int = 1) -> DataFrame:
    """Adds for each ``name: (side, column)`` the nearest value of ``column`` that is not null by ``order`` among the rows of the same keys.

    ``side`` is ``previous`` or ``next`` (without the row itself), ``upto`` or ``from`` (the row's own value counts). With ``n`` ranges of the first order column
    the rows of a key are scanned in as many tasks, and the last and first values of the ranges are carried to the others; the result is the same.
    """
    ahead = lambda side: side in ("next", "from")
    take = lambda side, c: (F.first if ahead(side) else F.last)(c, ignorenulls=True)
    df = df.withColumn("__piece", pieces(df, order[0], n)) if n > 1 else df
    by = [*keys, "__piece"] if n > 1 else keys
    w = Window.partitionBy(*by).orderBy(*order)

    def near(i: int, side: str) -> Column:  # a frame up to the end would be read again for every row; lag and lead are one pass
        found = F.expr(f"{'lead' if ahead(side) else 'lag'}(__v{i}) IGNORE NULLS").over(w)
        return found if side in ("next", "previous") else F.coalesce(f"__v{i}", found)

    own = {f"__v{i}": F.col(c) for i, (_, c) in enumerate(asked.values())}
    out = df.withColumns(own).withColumns({name: near(i, side) for i, (name, (side, _)) in enumerate(asked.items())}).drop(*own)
    if n < 2:
        return out
    at = lambda c: F.when(F.col(c).isNotNull(), F.struct(*order))
    ends = {f"__e{i}": (F.min_by if ahead(side) else F.max_by)(c, at(c)) for i, (side, c) in enumerate(asked.values())}
    per = df.groupBy(*by).agg(*(e.alias(k) for k, e in ends.items()))
    over = Window.partitionBy(*keys).orderBy("__piece")  # ``n`` rows a key at most
    carried = per.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(by)), *(take(side, f"__e{i}").over(over.rowsBetween(*((1, Window.unboundedFollowing) if ahead(side) else (Window.unboundedPreceding, -1)))).alias(f"__c{i}") for i, (side, _) in enumerate(asked.values())))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(by)])
    joined = out.join(carried, same, "left")
    return joined.withColumns({name: F.coalesce(name, f"__c{i}") for i, name in enumerate(asked)}).drop("__piece", *(f"__k{i}" for i in range(len(by))), *(f"__c{i}" for i in range(len(asked))))


def running_sum(df: DataFrame, keys: list[str], order: list[str], amount: str, name: str, n: int = 1) -> DataFrame:
    """Adds the sum of ``amount`` up to and with each row among those of the same keys; with ``n`` ranges a key is many tasks' work, as in ``with_neighbours``."""
    if n < 2:
        return df.withColumn(name, F.sum(amount).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    df = df.withColumn("__piece", pieces(df, order[0], n))
    by = [*keys, "__piece"]
    own = F.sum(amount).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    per = df.groupBy(*by).agg(F.sum(amount).alias("__s"))
    earlier = F.coalesce(F.sum("__s").over(Window.partitionBy(*keys).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    carried = per.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(by)), earlier.alias("__b"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(by)])
    return df.withColumn(name, own).join(carried, same, "left").withColumn(name, F.col(name) + F.col("__b")).drop("__piece", "__b", *(f"__k{i}" for i in range(len(by))))
