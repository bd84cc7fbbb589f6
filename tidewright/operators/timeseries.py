"""Time series of ``(tag, ts, value)``: retrieval, as-of values, grids, per-interval summaries, intervals with attributes.

All windows are partitioned by tag, and with ``pieces`` by ranges of time too, so that a tag or user that holds most rows is many tasks' work; the rows
are the same. A grid is bounded by its own tag's first and last point. Intervals are given in seconds
and start at multiples of the interval since 1970-01-01 UTC. Ties of a time are broken by the greatest ``id`` where one is given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewright.operators.scans import running_sum, with_neighbours

FLAGS = {"good": True, "questionable": False, "substituted": False, "annotated": False}
SUMMARIES = ("Total", "Average", "Minimum", "Maximum", "Range", "StdDev", "Count")


def recorded(series: DataFrame, low=None, high=None, most: int | None = None) -> DataFrame:
    """Raw points of ``low <= ts <= high`` with quality flags defaulted and the value numeric or null; the first ``most`` of each tag."""
    if low is not None:
        series = series.where(F.col("ts") >= F.lit(low))
    if high is not None:
        series = series.where(F.col("ts") <= F.lit(high))
    flags = {k: F.coalesce(F.col(k) if k in series.columns else F.lit(None).cast("boolean"), F.lit(v)) for k, v in FLAGS.items()}
    out = series.withColumns({**flags, "value": F.col("value").try_cast("double")})
    if most is None:
        return out
    return out.withColumn("__k", F.row_number().over(Window.partitionBy("tag").orderBy("ts"))).where(F.col("__k") <= most).drop("__k")


def resume_at_min_of_last(series: DataFrame) -> DataFrame:
    """One row ``resume``: the smallest of the tags' last times, one microsecond on, so that no tag loses points."""
    return series.groupBy("tag").agg(F.max("ts").alias("last")).agg((F.min("last") + F.expr("INTERVAL '0.000001' SECOND")).alias("resume"))


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def _time(c: Column) -> Column:
    return F.timestamp_micros(c).cast("timestamp_ntz")


def _bucket(seconds: int, c: str = "ts") -> Column:
    width = seconds * 1_000_000
    return F.expr(f"(unix_micros(cast({c} AS timestamp)) div {width}) * {width}")


def as_of(series: DataFrame, times: DataFrame, order: str | None = None, pieces: int = 1) -> DataFrame:
    """For each ``(tag, at)`` of ``times`` the last value at or before it; null if there is none.

    Points and times are merged in one sorted window a tag: one shuffle, no range join.
    """
    tie = F.col(order) if order else F.lit(0)
    points = series.select("tag", F.col("ts").alias("at"), F.struct("ts", "value").alias("p"), tie.cast("bigint").alias("o"), F.lit(0).alias("asked"))
    asked = times.select("tag", "at", F.lit(None).alias("p"), F.lit(None).cast("bigint").alias("o"), F.lit(1).alias("asked"))
    both = with_neighbours(points.unionByName(asked), ["tag"], ["at", "asked", "o"], {"l": ("upto", "p")}, pieces)
    return both.where("asked = 1").select("tag", "at", "l.ts", "l.value")


def value_at(series: DataFrame, at, order: str | None = None) -> DataFrame:
    """Value of each tag at one time: the last point at or before it, without a sort."""
    key = F.struct("ts", *([order] if order else []))
    return series.where(F.col("ts") <= F.lit(at)).groupBy("tag").agg(F.max_by(F.struct("ts", "value"), key).alias("p")).select("tag", "p.*")


def current_value(series: DataFrame, order: str | None = None) -> DataFrame:
    """The newest point of each tag."""
    key = F.struct("ts", *([order] if order else []))
    return series.groupBy("tag").agg(F.max_by(F.struct("ts", "value"), key).alias("p")).select("tag", "p.*")


def interpolated(series: DataFrame, seconds: int, pieces: int = 1) -> DataFrame:
    """A grid for each tag from its first to its last point, linear in time between neighbours; no extrapolation."""
    width = seconds * 1_000_000
    points = series.select("tag", _micros(F.col("ts")).alias("t"), "value").groupBy("tag", "t").agg(F.max("value").alias("value"))
    first, last = F.min("t"), F.max("t")
    grid = points.groupBy("tag").agg(F.ceil(first / width).alias("a"), F.floor(last / width).alias("b")).where("a <= b")
    grid = grid.select("tag", F.explode(F.sequence("a", "b")).alias("k")).select("tag", (F.col("k") * width).alias("t"))
    both = points.select("tag", "t", F.struct("t", "value").alias("p"), F.lit(False).alias("asked")).unionByName(grid.select("tag", "t", F.lit(None).alias("p"), F.lit(True).alias("asked")))
    out = with_neighbours(both, ["tag"], ["t", "asked"], {"b": ("upto", "p"), "a": ("from", "p")}, pieces).where("asked")
    line = F.col("b.value") + (F.col("a.value") - F.col("b.value")) * (F.col("t") - F.col("b.t")) / (F.col("a.t") - F.col("b.t"))
    return out.select("tag", _time(F.col("t")).alias("ts"), F.when(F.col("b.t") == F.col("t"), F.col("b.value")).otherwise(line).alias("value"))


def plot(series: DataFrame, seconds: int) -> DataFrame:
    """First, last, smallest and largest point of each interval, each once."""
    p, b = F.struct("ts", "value"), _bucket(seconds)
    keys = (("first", F.min_by(p, F.col("ts"))), ("last", F.max_by(p, F.col("ts"))), ("low", F.min_by(p, F.struct("value", "ts"))), ("high", F.max_by(p, F.struct(F.col("value"), F.col("ts")))))
    grouped = series.groupBy("tag", b.alias("b")).agg(*(e.alias(k) for k, e in keys))
    return grouped.select("tag", F.explode(F.array_distinct(F.array(*(k for k, _ in keys)))).alias("p")).select("tag", "p.ts", "p.value")


def _summaries() -> dict[str, Column]:
    v = F.col("value")
    return {"Total": F.sum(v), "Average": F.avg(v), "Minimum": F.min(v), "Maximum": F.max(v), "Range": F.max(v) - F.min(v), "StdDev": F.stddev_pop(v), "Count": F.count(v).cast("double")}


def summary(series: DataFrame, types: tuple[str, ...] = ("Total",), by: tuple[str, ...] = ("tag",)) -> DataFrame:
    """One row for each tag and summary type, event-weighted."""
    made = _summaries()
    if unknown := [t for t in types if t not in made]:
        raise ValueError(f"unknown summaries {unknown}")
    wide = series.groupBy(*by).agg(*(made[t].alias(t) for t in types))
    return wide.unpivot(list(by), list(types), "summary_type", "value")


def calculated(series: DataFrame, seconds: int, kind: str = "Average") -> DataFrame:
    """One summary of each interval with points, named by its start."""
    at = series.withColumn("b", _bucket(seconds))
    return at.groupBy("tag", "b").agg(_summaries()[kind].alias("value")).select("tag", _time(F.col("b")).alias("ts"), "value")


def time_weighted(series: DataFrame, seconds: int, pieces: int = 1) -> DataFrame:
    """Time-weighted average of each interval from a tag's first point to the end of its last interval.

    A step function runs from each point to the next and is cut at interval ends, so the value carried into an interval counts
    and the last point lasts to the end of its own. Divided by the covered time.
    """
    width = seconds * 1_000_000
    points = series.select("tag", _micros(F.col("ts")).alias("t"), "value").groupBy("tag", "t").agg(F.max("value").alias("value"))
    steps = with_neighbours(points, ["tag"], ["t"], {"e": ("next", "t")}, pieces).withColumn("e", F.coalesce("e", (F.floor(F.col("t") / width) + 1) * width))
    cuts = F.explode(F.sequence(F.floor(F.col("t") / width), F.floor((F.col("e") - 1) / width)))
    parts = steps.withColumn("k", cuts).withColumn("b", F.col("k") * width)
    dt = F.least("e", F.col("b") + width) - F.greatest("t", F.col("b"))
    total = parts.withColumn("dt", dt).groupBy("tag", "b").agg(F.sum(F.col("value") * F.col("dt")).alias("area"), F.sum("dt").alias("covered"))
    return total.select("tag", _time(F.col("b")).alias("ts"), (F.col("area") / F.col("covered")).alias("value"))


def with_session_numbers(events: DataFrame, user: str, order: list[str], gap_seconds: int, first: str, number: str, pieces: int = 1) -> DataFrame:
    """Adds whether an event is the first one of its user's session, and the session's number from 1; a gap above ``gap_seconds`` starts one."""
    timed = events.withColumn("__at", F.unix_micros(F.col(order[0]).cast("timestamp")))
    near = with_neighbours(timed, [user], order, {"__before": ("previous", "__at")}, pieces)
    marked = near.withColumn(first, F.coalesce(F.col("__at") - F.col("__before") > gap_seconds * 1_000_000, F.lit(True))).withColumn("__one", F.col(first).cast("int"))
    return running_sum(marked, [user], order, "__one", number, pieces).drop("__at", "__before", "__one")


def sessions(events: DataFrame, user: str = "user_id", ts: str = "ts", gap_seconds: int = 1800, pieces: int = 1) -> DataFrame:
    """``(user, session, start, end, events)``; a gap above ``gap_seconds`` starts a new session. One sort a user, or a piece of one."""
    numbered = with_session_numbers(events, user, [ts], gap_seconds, "__new", "session", pieces)
    return numbered.groupBy(user, "session").agg(F.min(ts).alias("start"), F.max(ts).alias("end"), F.count("*").alias("events"))


def event_frames_overlapping(frames: DataFrame, low, high, start: str = "start", end: str = "end") -> DataFrame:
    """Intervals that meet ``[low, high)``; an open end counts as going on."""
    return frames.where(F.col(start) < F.lit(high)).where(F.col(end).isNull() | (F.col(end) > F.lit(low)))


def event_frames(frames: DataFrame, attributes: str = "attributes") -> DataFrame:
    """Intervals whose attribute map has empty texts for nulls."""
    return frames.withColumn(attributes, F.transform_values(attributes, lambda _, v: F.coalesce(v, F.lit(""))))


def frame_attributes(frames: DataFrame, keys: list[str], attributes: str = "attributes") -> DataFrame:
    return frames.select(*keys, F.explode(attributes).alias("name", "value"))


def frame_elements(frames: DataFrame, keys: list[str], primary: str, references: str) -> DataFrame:
    """The primary element first, then the referenced ones except it: ``(keys, element, is_primary)``."""
    refs = F.filter(F.array_distinct(F.coalesce(F.col(references), F.array().cast(frames.schema[references].dataType))), lambda x: x != F.col(primary))
    main = frames.where(F.col(primary).isNotNull()).select(*keys, F.col(primary).alias("element"), F.lit(True).alias("is_primary"))
    return main.unionByName(frames.select(*keys, F.explode(refs).alias("element"), F.lit(False).alias("is_primary")))


def table_rows_to_map(df: DataFrame, keys: list[str], cells: list[str]) -> DataFrame:
    """Named cells as one map of texts, nulls empty."""
    entries = [x for c in cells for x in (F.lit(c), F.coalesce(F.col(c).cast("string"), F.lit("")))]
    return df.select(*keys, F.create_map(*entries).alias("cells"))
