"""Checks on tables: populated columns, empty rows, keys, field coverage, replay and partition equivalence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column_population(df: DataFrame, allowed_empty: tuple[str, ...] = ()) -> DataFrame:
    """``(column, filled, ok)``: rows with a value, and whether there is one or none is needed. One pass."""
    wide = df.agg(*(F.count(c).alias(c) for c in df.columns))
    long = wide.unpivot([], df.columns, "column", "filled")
    return long.withColumn("ok", (F.col("filled") > 0) | F.col("column").isin(*allowed_empty))


def _any_value(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        return reduce(lambda a, b: a | b, [_any_value(c[f.name], f.dataType) for f in kind], F.lit(False))
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.exists(c, lambda x: _any_value(x, kind.elementType)), F.lit(False))
    if isinstance(kind, T.MapType):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    return c.isNotNull()


def all_null_rows(df: DataFrame) -> DataFrame:
    """Rows without any value, nested ones included."""
    return df.where(~reduce(lambda a, b: a | b, [_any_value(F.col(f.name), f.dataType) for f in df.schema]))


def primary_key_check(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are null or occur more than once, with their number of rows; raises if a key is no column."""
    if missing := [k for k in keys if k not in df.columns]:
        raise ValueError(f"no such columns: {missing}")
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(null | (F.col("n") > 1))


def schema_coverage(df: DataFrame, column: str, declared: list[str]) -> DataFrame:
    """``(field, state, n)``: top-level fields of JSON text seen but not declared (``undeclared``) and the reverse (``unseen``)."""
    seen = df.select(F.explode(F.json_object_keys(column)).alias("field")).groupBy("field").agg(F.count("*").alias("n"))
    names = df.sparkSession.createDataFrame([(x,) for x in declared], "field string")
    both = seen.join(names.withColumn("declared", F.lit(True)), "field", "full_outer")
    state = F.when(F.col("declared").isNull(), "undeclared").when(F.col("n").isNull(), "unseen")
    return both.select("field", state.alias("state"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n")).where("state is not null")


def replay_equivalence(once: DataFrame, replayed: DataFrame) -> DataFrame:
    """One row: rows only in either result, both zero if a window-by-window run equals one run over all."""
    a, b = once.exceptAll(replayed.select(once.columns)), replayed.select(once.columns).exceptAll(once)
    return a.agg(F.count("*").alias("only_once")).crossJoin(b.agg(F.count("*").alias("only_replayed")))  # one row each


def partition_disjoint(df: DataFrame, parts: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows that no part holds and rows that several hold."""
    held = parts.groupBy(*keys).agg(F.count("*").alias("__n"))
    own = df.groupBy(*keys).agg(F.count("*").alias("__m"))
    both = own.join(held, keys, "full_outer").select(F.coalesce("__n", F.lit(0)).alias("n"), F.coalesce("__m", F.lit(0)).alias("m"))
    return both.agg(F.coalesce(F.sum(F.greatest(F.col("m") - F.col("n"), F.lit(0))), F.lit(0)).cast("bigint").alias("missing"), F.coalesce(F.sum(F.greatest(F.col("n") - F.col("m"), F.lit(0))), F.lit(0)).cast("bigint").alias("repeated"))
