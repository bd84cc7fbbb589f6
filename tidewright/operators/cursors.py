"""Incremental batches over a cursor column: bounds, watermarks, tie-safe caps, overlaps.

Bounds compare the stored column itself, so they reach the Parquet scan. Caps never sort the whole table: rows are
counted for each cursor value, the counts summed by ranges of it and then inside the one range that holds the cut, and the table is cut by a plain
comparison. Any type that Spark can sort is a cursor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.scalars import cuts_below
from tidewright.operators.cdc import content_hash
from tidewright.operators.scans import Totals


def since(df: DataFrame, cursor: str, low=None, high=None) -> DataFrame:
    """Rows with ``low < cursor <= high``; either bound may be missing."""
    if low is not None:
        df = df.where(F.col(cursor) > F.lit(low))
    return df if high is None else df.where(F.col(cursor) <= F.lit(high))


def next_watermark(df: DataFrame, cursor: str, previous=None, cap=None) -> DataFrame:
    """One row ``watermark``: the greatest cursor, at most ``cap``, never below ``previous``."""
    kind = df.schema[cursor].dataType
    newest = F.max(cursor)
    if cap is not None:
        newest = F.least(newest, F.lit(cap).cast(kind))
    return df.agg((newest if previous is None else F.greatest(newest, F.lit(previous).cast(kind))).alias("watermark"))


def with_lookback(df: DataFrame, cursor: str, low, seconds: int, high=None) -> DataFrame:
    """Rows since ``low`` less a lookback; the stored watermark stays ``low`` and is kept by ``next_watermark``."""
    floor = F.lit(low).cast(df.schema[cursor].dataType) - F.make_dt_interval(secs=F.lit(seconds))
    df = df.where(F.col(cursor) > floor)
    return df if high is None else df.where(F.col(cursor) <= F.lit(high))


def overlap_dedup(batch: DataFrame, delivered: DataFrame, keys: list[str]) -> DataFrame:
    """Batch rows of which key and whole content were not delivered before."""
    cols = batch.columns
    seen = delivered.select(*keys, content_hash(delivered.select(cols)).alias("__h")).distinct()
    return batch.withColumn("__h", content_hash(batch)).join(seen, [*keys, "__h"], "left_anti").select(cols)


def _cut(df: DataFrame, cursor: str, n: int, whole: bool) -> DataFrame:
    """One row ``__cut``: the last cursor value that a cap of ``n`` rows takes in (null: none)."""
    return Totals(df, cursor).cut(n, whole)


def soft_cap(df: DataFrame, cursor: str, n: int) -> DataFrame:
    """The first ``n`` rows by cursor and all ties of the last one; rows without a cursor are left out."""
    return df.join(F.broadcast(_cut(df, cursor, n, False)), F.col(cursor) <= F.col("__cut")).drop("__cut")  # one row


def trim_ties(df: DataFrame, cursor: str, n: int) -> DataFrame:
    """The first ``n`` rows without a tie group that the cap cuts; none if the first group is too large."""
    return df.join(F.broadcast(_cut(df, cursor, n, True)), F.col(cursor) <= F.col("__cut")).drop("__cut")  # one row


def keyset_after(df: DataFrame, cursor: str, tiebreak: str, last) -> DataFrame:
    """Rows after ``(value, key)`` in the order of cursor and tie-break; a null tie-break fails the job."""
    v, k = (F.lit(x) for x in last)
    checked = F.when(F.col(tiebreak).isNull(), F.raise_error(F.lit(f"{tiebreak} is null")).cast("boolean")).otherwise(F.col(tiebreak) > k)
    return df.where(F.col(cursor) >= v).where((F.col(cursor) > v) | checked)


def window_batch(df: DataFrame, cursor: str, low, width: str, cap: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of ``(low, low + width]`` up to a soft cap, and one row ``next``: where the next window begins.

    A drained window ends at its end; a capped one at its last row's cursor.
    """
    kind = df.schema[cursor].dataType
    start = F.lit(low).cast(kind)
    end = start + F.expr(f"INTERVAL {width}")
    inside = df.where((F.col(cursor) > start) & (F.col(cursor) <= end))
    if cap is None:
        return inside, df.sparkSession.range(1).select(end.alias("next"))
    rows = soft_cap(inside, cursor, cap)
    sizes = inside.agg(F.count("*").alias("all")).crossJoin(rows.agg(F.count("*").alias("got"), F.max(cursor).alias("last")))  # one row each
    return rows, sizes.select(F.when(F.col("all") == F.col("got"), end).otherwise(F.col("last")).alias("next"))


def compact_windows(df: DataFrame, cursor: str, width: str, n: int) -> DataFrame:
    """Consecutive windows joined until they hold ``n`` rows: ``(batch, begin, end, n)``; empty windows do not count.

    A batch takes windows while the rows before its window, counted from the table's start, stay in one step of ``n``.
    """
    per = Totals(df.select(F.date_trunc(width, cursor).cast(df.schema[cursor].dataType).alias("w")), "w").running()
    return per.withColumn("batch", F.floor((F.col("__total") - F.col("__n")) / n)).groupBy("batch").agg(F.min("w").alias("begin"), F.max("w").alias("end"), F.sum("__n").alias("n"))


def cap_at_group(df: DataFrame, group: str, n: int) -> DataFrame:
    """Whole groups in order until ``n`` rows are reached, so that rows of one group stay together."""
    return soft_cap(df, group, n)


def redrain_on_stuck_cap(df: DataFrame, cursor: str, n: int) -> DataFrame:
    """``trim_ties``, or all rows where the cap would end on the first cursor value and make no progress."""
    return df.join(F.broadcast(_cut(df, cursor, n, True)), F.coalesce(F.col(cursor) <= F.col("__cut"), F.lit(True))).drop("__cut")  # one row


def null_cursor(df: DataFrame, cursor: str, mode: str = "floor", floor_year: int = 1900) -> DataFrame:
    """``floor``: adds ``cursor_key`` with nulls at a floor (the row keeps its null); ``ignore``; ``error`` fails the job."""
    c = F.col(cursor)
    if mode == "ignore":
        return df.where(c.isNotNull()).withColumn("cursor_key", c)
    if mode == "error":
        return df.withColumn("cursor_key", F.when(c.isNull(), F.raise_error(F.lit(f"{cursor} is null")).cast(df.schema[cursor].dataType)).otherwise(c))
    if mode != "floor":
        raise ValueError(f"unknown mode {mode}")
    kind = df.schema[cursor].dataType
    timed = isinstance(kind, T.TimestampType | T.TimestampNTZType | T.DateType)
    floor = F.lit(f"{floor_year:04d}-01-01") if timed else F.lit(0) if isinstance(kind, T.NumericType) else F.lit("")
    return df.withColumn("cursor_key", F.coalesce(c, floor.cast(kind)))


def cursor_key(col: Column) -> Column:
    """A struct that orders mixed cursor texts: numbers, then ISO times by instant and fraction digits, then other text.

    Fractions of up to nine digits stay in a padded text, as timestamps hold six.
    """
    number = F.when(col.rlike(r"^\s*[+-]?[0-9]+(\.[0-9]+)?\s*$"), col.try_cast("decimal(38,9)"))
    iso = col.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?\s*(Z|[+-][0-9]{2}:?[0-9]{2})?)?$")
    whole = F.regexp_replace(col, r"\.[0-9]+", "")
    time = F.when(iso, whole.try_cast("timestamp"))
    fraction = F.when(time.isNotNull(), F.rpad(F.regexp_extract(col, r"\.([0-9]+)", 1), 9, "0"))
    family = F.when(col.isNull(), F.lit(None)).when(number.isNotNull(), 0).when(time.isNotNull(), 1).otherwise(2)
    return F.struct(family.alias("family"), number.alias("number"), time.alias("time"), fraction.alias("fraction"), col.alias("text"))


def cursor_max(df: DataFrame, cursor: str) -> DataFrame:
    """The greatest cursor text under ``cursor_key``."""
    return df.where(F.col(cursor).isNotNull()).agg(F.max_by(cursor, cursor_key(F.col(cursor))).alias("cursor"))


def oldest_cursor(df: DataFrame, cursor: str) -> DataFrame:
    return df.agg(F.min(cursor).alias("oldest"))


def has_new_data(df: DataFrame, cursor: str, last) -> DataFrame:
    """One row ``has_new``: false only where the newest cursor lies strictly below ``last`` (or there is none)."""
    return df.agg(F.coalesce(F.max(cursor) >= F.lit(last).cast(df.schema[cursor].dataType), F.lit(False)).alias("has_new"))


def since_per_group(df: DataFrame, watermarks: DataFrame, group: str, cursor: str) -> DataFrame:
    """Rows after the watermark of their own group; groups without one are read whole.

    ``watermarks`` is ``(group, watermark)``. It is joined like any table: Spark broadcasts it if it is small.
    """
    w = watermarks.select(group, F.col("watermark").alias("__w"))
    return df.join(w, group, "left").where(F.col("__w").isNull() | (F.col(cursor) > F.col("__w"))).select(df.columns)


def watermarks_by_group(df: DataFrame, group: str, cursor: str, previous: DataFrame) -> DataFrame:
    """Watermark of each group after a batch: never lower, untouched groups carried over."""
    return previous.select(group, "watermark").unionByName(df.select(group, F.col(cursor).alias("watermark"))).groupBy(group).agg(F.max("watermark").alias("watermark"))


def availability_ceiling(df: DataFrame, cursor: str, now, lag_seconds: int) -> DataFrame:
    """Rows old enough to be complete: at or before ``now`` less the publishing lag."""
    return df.where(F.col(cursor) <= F.lit(now).cast(df.schema[cursor].dataType) - F.make_dt_interval(secs=F.lit(lag_seconds)))


def late_edit_window(state: DataFrame, source: DataFrame, cursor: str, keys: list[str], watermark, days: int) -> DataFrame:
    """State after reading the last ``days`` before the watermark again and merging by key."""
    again = with_lookback(source, cursor, watermark, days * 86_400)
    return state.join(again.select(*keys).distinct(), keys, "left_anti").select(source.columns).unionByName(again)


def check_filter_honoured(df: DataFrame, cursor: str, low) -> DataFrame:
    """``df``; raises if it has rows and all of them lie at or below ``low``: the source ignored its filter."""
    newest = df.agg(F.max(cursor).alias("m")).where(F.col("m") <= F.lit(low).cast(df.schema[cursor].dataType))
    if not newest.isEmpty():
        raise ValueError(f"every row has {cursor} at or below {low}")
    return df


def children_of_changed_parents(parents: DataFrame, children: DataFrame, keys: list[str], parent_cursor: str, low, child_cursor: str, child_low) -> DataFrame:
    """Changed children of parents that changed since ``low``."""
    changed = since(parents, parent_cursor, low).select(*keys).distinct()
    return since(children, child_cursor, child_low).join(changed, keys, "left_semi")


def order_for_batch(df: DataFrame, cursor: str, *tiebreak: str) -> DataFrame:
    return df.orderBy(cursor, *tiebreak)


def time_windows(spark, start: str, end: str, width: str) -> DataFrame:
    """Contiguous windows ``(low, high]`` covering ``(start, end]``; the last one may be shorter."""
    low = F.explode(F.expr(f"filter(sequence(timestamp_ntz'{start}', timestamp_ntz'{end}', interval {width}), x -> x < timestamp_ntz'{end}')"))
    return spark.range(1).select(low.alias("low")).withColumn("high", F.least(F.col("low") + F.expr(f"interval {width}"), F.expr(f"timestamp_ntz'{end}'")))


def rows_by_window(df: DataFrame, cursor: str, windows: DataFrame) -> DataFrame:
    """Rows with the window ``(low, high]`` that holds their cursor; ``windows`` is a planned list of disjoint windows, in the driver's hands.

    The window is found by counting the window starts below the cursor, in one expression, so rows meet windows by an equal number and
    not by a range.
    """
    ordered = windows.orderBy("low").collect()  # a planned list
    kind = df.schema[cursor].dataType
    if not ordered:
        return df.crossJoin(windows)
    at = cuts_below(F.col(cursor), [w["low"] for w in ordered], kind)
    numbered = df.sparkSession.createDataFrame([(i, *w) for i, w in enumerate(ordered, 1)], T.StructType([T.StructField("__at", T.IntegerType()), *windows.schema.fields]))
    return df.withColumn("__at", at).join(numbered, "__at").where(F.col(cursor) <= F.col("high")).drop("__at")
