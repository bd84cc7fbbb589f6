"""Batch sources and sinks: Parquet scans, newline JSON, CSV reports, message files, envelopes; append and clustered writes."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.scalars import cuts_below, header_to_snake

_own_dir: list[str] = []

#: Rows of a clustered file, about: what one task sorts.
RANGE_ROWS = 2_000_000


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``).

    Where none is named, a local session (one machine) gets a temporary folder that goes when Python ends; on a cluster that raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _own_dir:
            _own_dir.append(tempfile.mkdtemp(prefix="spark-tidewright-"))
            atexit.register(shutil.rmtree, _own_dir[0], ignore_errors=True)
        base = _own_dir[0]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back, so that it is computed once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def folders(spark: SparkSession, path: str, complete: bool = False) -> list[str]:
    """Names of the folders in ``path``, none where there is no such path; with ``complete`` those whose write was finished."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(place):
        return []
    found = [s.getPath() for s in store.listStatus(place) if s.isDirectory()]
    return sorted(p.getName() for p in found if not complete or store.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def remove_folder(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def scan_table(spark: SparkSession, path: str, columns: list[str] | None = None, predicate: Column | None = None) -> DataFrame:
    """A Parquet table; columns and predicate reach the scan."""
    df = spark.read.parquet(path)
    if predicate is not None:
        df = df.where(predicate)
    return df if columns is None else df.select(*columns)


def scan_partitioned(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows dealt by key into ``n`` tasks, for work that must see a key whole."""
    return df.repartition(n, key)


def scan_deletes(df: DataFrame, is_tombstone: Column, keys: list[str], cursor: str) -> DataFrame:
    """Keys and cursor of deleted rows."""
    return df.where(is_tombstone).select(*keys, cursor)


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Newline JSON, gzip by its suffix; a line that is no JSON fails the job if ``strict`` and else is kept apart (see below)."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    with_bad = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(with_bad).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the lines that could not be read."""
    return df.where("_corrupt_record is null").drop("_corrupt_record"), df.where("_corrupt_record is not null").select("_corrupt_record")


def read_json_array(spark: SparkSession, path: str, element: T.StructType, under: str | None = None) -> DataFrame:
    """Files that hold one JSON array, bare or under a field such as ``events``, ``data`` or ``records``."""
    text = spark.read.text(path, wholetext=True)
    kind = T.ArrayType(element)
    body = F.from_json("value", kind) if under is None else F.from_json("value", T.StructType([T.StructField(under, kind)]))[under]
    return text.select(F.inline(body))


def read_csv_report(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV report with a header: ``Event Time`` becomes ``event_time``, a byte-order mark goes, empty cells are null, all text.

    ``columns`` are the report's headers in order, so nothing is inferred.
    """
    schema = T.StructType([T.StructField(header_to_snake(c.lstrip("﻿")), T.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("nullValue", "").option("encoding", "UTF-8").csv(path)


def read_message_files(spark: SparkSession, path: str, glob: str = "*", recursive: bool = False, since: str | None = None, until: str | None = None) -> DataFrame:
    """Whole text files ``(value, file, modified)`` by glob, changed after ``since`` and not after ``until``; empty ones are left out."""
    df = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).text(path, wholetext=True)
    df = df.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified"), F.col("_metadata.file_size").alias("__size"))
    df = df.where("__size > 0").drop("__size")
    if since:
        df = df.where(F.col("modified") > F.lit(since).cast("timestamp"))
    return df if until is None else df.where(F.col("modified") <= F.lit(until).cast("timestamp"))


def read_message_records(spark: SparkSession, path: str, glob: str = "*", recursive: bool = False, since: str | None = None, until: str | None = None, line_end: str = "\n", start: str = "MSH") -> DataFrame:
    """``(value, file, modified)``: a row for each message of text files of any size, cut where a line begins with ``start``.

    Files are split among tasks: a reader takes the messages that begin in its part and reads the last one to its end in the next. ``line_end`` is what ends the line before a message, ``\\r`` or ``\\n`` (also
    for ``\\r\\n``); files that mix them are for ``read_message_files``. Lines before a file's first message, such as an envelope, go.
    """
    df = spark.read.option("lineSep", line_end + start).option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).text(path)
    df = df.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified"))
    if since:
        df = df.where(F.col("modified") > F.lit(since).cast("timestamp"))
    if until is not None:
        df = df.where(F.col("modified") <= F.lit(until).cast("timestamp"))
    text = F.regexp_replace("value", "^[\ufeff\\s]+", "")
    first = text.rlike("^[A-Za-z]")  # a file's first record has its own start; in the others a separator comes first
    return df.withColumn("value", F.when(first, text).otherwise(F.concat(F.lit(start), F.col("value")))).where(F.col("value").startswith(start) & (F.trim("value") != start))


def explode_envelope(df: DataFrame, raw: str, element: T.StructType, under: tuple[str, ...] = ("value", "items", "data", "results", "records")) -> DataFrame:
    """Records of response pages, bare arrays or under the first of the fields that is there."""
    kind = T.ArrayType(element)
    bare = F.when(F.trim(raw).startswith("["), F.from_json(raw, kind))
    wrapped = F.from_json(raw, T.StructType([T.StructField(u, kind) for u in under]))
    return df.select(*[c for c in df.columns if c != raw], F.inline(F.coalesce(bare, *(wrapped[u] for u in under))))


def write_append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_clustered(df: DataFrame, path: str, columns: list[str], files: int | None = None) -> None:
    """Range-partitioned and sorted by ``columns``, so that filters on them skip files and row groups.

    ``files`` is the least number of files: large tables get more, so that a task sorts about ``RANGE_ROWS`` rows. For that the rows are counted first.
    """
    _by_range(df, files, *columns).sortWithinPartitions(*columns).write.mode("overwrite").parquet(path)


def _by_range(df: DataFrame, files: int | None, *columns: str) -> DataFrame:
    needed = -(-df.count() // RANGE_ROWS)
    least = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(max(files or 1, needed), *columns) if files or needed > least else df.repartitionByRange(*columns)


def _place(df: DataFrame, column: str) -> Column:
    """A number in the order of the column: the value itself, or the first seven bytes of a text."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.NumericType):
        return F.col(column).cast("double")
    raise ValueError(f"{column} has no order to interleave: {kind.simpleString()}")


def interleaved(df: DataFrame, columns: list[str], bits: int = 8) -> Column:
    """A number of which the bits are dealt in turn to the columns' ranges, ``2 ** bits`` of each with about as many rows: rows that lie near in every column lie near in it.

    Nulls lie in the lowest range.
    """
    if not columns or bits * len(columns) > 62:
        raise ValueError("columns times bits must lie between 1 and 62")
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = df.agg(*(F.percentile_approx(_place(df, c), steps, 10_000).alias(f"q{i}") for i, c in enumerate(columns))).first()
    out = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        at = _place(df, c)
        range_ = cuts_below(at, sorted(set(cuts[i] or ())), T.DoubleType() if isinstance(df.schema[c].dataType, T.NumericType) else T.LongType())
        for b in range(bits):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(range_, b).bitwiseAND(F.lit(1)).cast("long"), b * len(columns) + len(columns) - 1 - i))
    return out


def write_interleaved(df: DataFrame, path: str, columns: list[str], files: int | None = None, bits: int = 8) -> None:
    """Clustered by several columns alike: a filter on any of them skips files and row groups, where ``write_clustered`` serves the first one best."""
    key = "__interleaved"
    marked = df.withColumn(key, interleaved(df, columns, bits))
    _by_range(marked, files, key).sortWithinPartitions(key, *columns).drop(key).write.mode("overwrite").parquet(path)
