"""Streams of changes into tables: type 1, type 2, append, deletes, windows, sessions, and a job over many tables.

Sources are file streams with a checkpoint; a run takes what is there when it starts and stops (``availableNow``). Batch size is
set by files, not by rows. A table's changes are kept in one folder for each batch, which a replayed batch overwrites, and merged when they are
read, so late and repeated batches change nothing and Spark deals the merge to as many tasks as the changes need. Neighbouring batches are folded, level
by level, so that a read takes few folders however many runs there were.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.operators import cdc
from tidewright.sources.files import folders, remove_folder, write_clustered, write_interleaved


def stream_table(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000, event_time: str | None = None) -> DataFrame:
    """An incremental read of a folder of Parquet files; ``event_time`` is cast so that it may carry a watermark."""
    df = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return df.withColumn(event_time, F.col(event_time).cast("timestamp")) if event_time else df


def run_to_completion(stream: DataFrame, checkpoint: str, each) -> None:
    """Feeds what is there now to ``each(batch, batch_id)`` and returns; later files are left for the next run."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


#: Folders of one level that are folded into one of the next.
FANOUT = 8


@dataclass
class Log:
    """A table's batches, one folder for each, ``low-high`` by their numbers, and folds of ``FANOUT`` neighbouring ones by ``fold``, and of those again.

    A read takes the widest folders, so it lists some ``FANOUT`` folders for each level, of which there are as many as the logarithm of the batches. Folders below a fold go at the
    end of the next run, so a result can be read until the run after the next one. A batch that is written again after its fold is not read, and its fold holds the same rows.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    fold: Callable[[DataFrame], DataFrame] | None = None

    def write(self, batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/{number}-{number + 1}")

    def ranges(self) -> set[tuple[int, int]]:
        """``(low, high)`` of each folder that was written whole."""
        return {(int(low), int(high)) for low, high in (name.split("-") for name in folders(self.spark, self.path, complete=True))}

    def rows(self, ranges: list[tuple[int, int]]) -> DataFrame:
        if not ranges:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{low}-{high}" for low, high in ranges))

    def read(self) -> DataFrame:
        return self.rows(_widest(self.ranges()))

    def settle(self) -> None:
        """Folds what is complete, level by level, and removes what folds of earlier runs hold."""
        there = self.ranges()
        if self.fold is None or not there:
            return
        gone = there - set(_widest(there))
        width, end = FANOUT, max(high for _, high in there)
        while width <= end:
            for low in range(0, end - width + 1, width):
                parts = [(at, at + width // FANOUT) for at in range(low, low + width, width // FANOUT)]
                if (low, low + width) not in there and not any(x <= low and low + width <= y for x, y in there) and there.issuperset(parts):
                    self.fold(self.rows(parts)).select(self.schema.names).write.mode("overwrite").parquet(f"{self.path}/{low}-{low + width}")
                    there.add((low, low + width))
            width *= FANOUT
        for low, high in gone:
            remove_folder(self.spark, f"{self.path}/{low}-{high}")


def _widest(ranges: set[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges that no other one holds, in order."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges, key=lambda r: (r[0], -r[1])):
        if not out or low >= out[-1][1]:
            out.append((low, high))
    return out


def _logged(stream: DataFrame, target: str, fold: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """All changes after a run: of the same key those that ``fold`` keeps."""
    log = Log(stream.sparkSession, f"{target}/data", stream.schema, fold)
    run_to_completion(stream, f"{target}/checkpoint", log.write)
    log.settle()
    return log.read()


def stream_append(stream: DataFrame, target: str) -> DataFrame:
    """Rows appended once: a batch owns a folder by its number, and a replay overwrites it. A run without new files adds nothing."""
    return _logged(stream, target)


def stream_scd1(stream: DataFrame, target: str, keys: list[str], sequence_by: str, is_delete: str | None = None) -> DataFrame:
    """Latest row of each key over all batches; deletes are kept among the changes, so a late upsert brings no deleted row back.

    Batches are folded to the latest change of each key, so what a run reads grows with the keys and not with their changes.
    """
    fold = lambda changes: cdc.scd1(changes, keys, sequence_by, is_delete, keep_tombstones=True)
    return cdc.scd1(_logged(stream, target, fold), keys, sequence_by, is_delete)


def stream_scd2(stream: DataFrame, target: str, keys: list[str], sequence_by: str, is_delete: str | None = None) -> DataFrame:
    """Versions of each key over all batches; late rows split versions rightly, as all changes are there.

    Folds hold one change for each key and sequence; each row is written again once a level.
    """
    fold = lambda changes: cdc.distinct_changes(changes, keys, sequence_by, is_delete)
    return cdc.scd2(_logged(stream, target, fold), keys, sequence_by, is_delete)


def stream_deletes(upserts: DataFrame, deletes: DataFrame, target: str, keys: list[str], sequence_by: str, flag: str = "is_delete") -> DataFrame:
    """Upserts and tombstones of two streams into one type 1 table; they are joined before the merge, so their order does not matter."""
    both = upserts.withColumn(flag, F.lit(False)).unionByName(deletes.withColumn(flag, F.lit(True)), allowMissingColumns=True)
    return stream_scd1(both, target, keys, sequence_by, flag)


def dedup_overlaps(stream: DataFrame, keys: list[str], event_time: str, within: str) -> DataFrame:
    """Drops rows of a re-read that came with the same key and content within the watermark's delay."""
    marked = stream.withColumn("__h", cdc.content_hash(stream)).withWatermark(event_time, within)
    return marked.dropDuplicatesWithinWatermark([*keys, "__h"]).drop("__h")


def window_counts(stream: DataFrame, event_time: str, width: str, slide: str | None = None, by: tuple[str, ...] = (), late: str | None = None) -> DataFrame:
    """Rows, sum and mean of ``value`` in tumbling or sliding windows."""
    df = stream.withWatermark(event_time, late) if late else stream
    w = F.window(event_time, width, slide) if slide else F.window(event_time, width)
    g = df.groupBy(w.alias("w"), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.avg("value").alias("average"))
    return g.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n", "total", "average")


def session_counts(stream: DataFrame, user: str, event_time: str, gap: str, late: str) -> DataFrame:
    """Closed sessions of each user: start, end and events. Append mode."""
    g = stream.withWatermark(event_time, late).groupBy(user, F.session_window(event_time, gap).alias("s")).agg(F.count("*").alias("events"), F.max(event_time).alias("last"))
    return g.select(user, F.col("s.start").alias("start"), "last", "events")


def collect_complete(result: DataFrame, target: str) -> DataFrame:
    """The final result of a stream that gives its whole result each time; each batch has a folder, the last one counts.

    A run without new files gives the result of the run before, or none.
    """
    log = Log(result.sparkSession, f"{target}/data", result.schema)
    query = result.writeStream.outputMode("complete").foreachBatch(log.write).option("checkpointLocation", f"{target}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return log.rows(sorted(log.ranges())[-1:])  # an empty last result counts too


def replay_windows(df: DataFrame, cursor: str, bounds: list[str], target: str) -> DataFrame:
    """History window by window: ``(bounds[i], bounds[i+1]]``, each one a batch with the window's number; a window run again replaces itself.

    Gives the rows of all windows so far, to be merged by ``cdc.scd1`` or ``cdc.scd2``.
    """
    kind, log = df.schema[cursor].dataType, Log(df.sparkSession, f"{target}/data", df.schema)
    for i, (low, high) in enumerate(zip(bounds, bounds[1:], strict=False)):
        log.write(df.where((F.col(cursor) > F.lit(low).cast(kind)) & (F.col(cursor) <= F.lit(high).cast(kind))), i)
    return log.read()


def _runs(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the runs that ended, empty ones too."""
    return sorted(int(name.removeprefix("__run=")) for name in folders(spark, path, complete=True))


def snapshot_history(current: DataFrame, target: str, keys: list[str]) -> DataFrame:
    """Versions of a table that comes as full snapshots: run ``n`` (from 1) closes and opens versions at ``n``.

    A run writes the versions that it closes, which no later run touches, and the open ones, in one folder that counts once it is complete; a run that
    failed is done again under its number. So a run writes as much as the snapshot holds, whatever the history. Open versions of the run before the last are removed.
    """
    spark, path = current.sparkSession, f"{target}/runs"
    kinds = T.StructType([*(T.StructField(f.name, f.dataType) for f in current.schema), T.StructField("valid_from", T.IntegerType()), T.StructField("valid_to", T.IntegerType())])
    done = _runs(spark, path)
    run = done[-1] + 1 if done else 1
    before = spark.read.schema(kinds).parquet(f"{path}/__run={run - 1}/__open=true") if run > 1 and "__open=true" in folders(spark, f"{path}/__run={run - 1}") else spark.createDataFrame([], kinds)
    made = cdc.snapshot_step(before, current, keys, run).withColumns({"valid_from": F.col("valid_from").cast("int"), "valid_to": F.col("valid_to").cast("int")})
    made.select(kinds.names).withColumn("__open", F.col("valid_to").isNull()).write.mode("overwrite").partitionBy("__open").parquet(f"{path}/__run={run}")
    for old in done[:-1]:
        if old >= run - 3:
            remove_folder(spark, f"{path}/__run={old}/__open=true")
    placed = T.StructType([*kinds.fields, T.StructField("__run", T.IntegerType()), T.StructField("__open", T.BooleanType())])
    found = spark.read.schema(placed).parquet(path).where((F.col("__run") <= run) & (~F.col("__open") | (F.col("__run") == run)))
    return found.select(*kinds.names, F.col("valid_to").isNull().alias("is_current"))


def snapshot_state(current: DataFrame, target: str, keys: list[str]) -> DataFrame:
    """The stored table after a full snapshot: each key once, null keys being equal, removed keys gone. Each run has a folder; the last two stay."""
    spark, path = current.sparkSession, f"{target}/runs"
    done = _runs(spark, path)
    run = done[-1] + 1 if done else 1
    cdc.snapshot_scd1(current.limit(0), current, keys).write.mode("overwrite").parquet(f"{path}/__run={run}")
    for old in done[:-1]:
        remove_folder(spark, f"{path}/__run={old}")
    return spark.read.schema(current.schema).parquet(f"{path}/__run={run}")


@dataclass
class Table:
    """One table of an ingestion job. Given fields win over the source's own metadata."""

    name: str
    source: str
    keys: list[str] = field(default_factory=list)
    sequence_by: str | None = None
    ingestion_type: str = "cdc"
    scd_type: str | None = None
    cluster_by: list[str] = field(default_factory=list)  # one column sorts; several are interleaved
    is_delete: str | None = None
    files_per_batch: int = 1000


KINDS = ("snapshot", "cdc", "cdc_with_deletes", "append")


def ingest(spark: SparkSession, tables: list[Table], target: str) -> dict[str, DataFrame]:
    """Runs every table to completion and returns its rows by name.

    ``SCD_TYPE_1`` is the default; ``APPEND_ONLY`` makes any table an append; ``SCD_TYPE_2`` gives versions. A snapshot
    replaces the table, or with type 2 adds versions numbered by run. An unknown ingestion or SCD type raises.
    """
    for t in tables:
        if t.ingestion_type not in KINDS:
            raise ValueError(f"{t.name}: unknown ingestion type {t.ingestion_type}")
        if t.scd_type not in (None, "SCD_TYPE_1", "SCD_TYPE_2", "APPEND_ONLY"):
            raise ValueError(f"{t.name}: unknown SCD type {t.scd_type}")
        appends = t.ingestion_type == "append" or t.scd_type == "APPEND_ONLY"
        if not appends and (not t.keys or (t.ingestion_type != "snapshot" and not t.sequence_by)):
            raise ValueError(f"{t.name}: keys and a sequence are needed")
    return {t.name: _ingest_one(spark, t, f"{target}/{t.name}") for t in tables}


def _ingest_one(spark: SparkSession, t: Table, target: str) -> DataFrame:
    schema = spark.read.parquet(t.source).schema
    stream = stream_table(spark, t.source, schema, t.files_per_batch)
    if t.ingestion_type == "append" or t.scd_type == "APPEND_ONLY":
        out = stream_append(stream, target)
    elif t.ingestion_type == "snapshot":
        merged = snapshot_history if t.scd_type == "SCD_TYPE_2" else snapshot_state
        out = merged(spark.read.parquet(t.source), target, t.keys)
    else:
        flag = t.is_delete if t.ingestion_type == "cdc_with_deletes" else None
        merged = stream_scd2 if t.scd_type == "SCD_TYPE_2" else stream_scd1
        out = merged(stream, target, t.keys, t.sequence_by, flag)
    if t.cluster_by:
        (write_clustered if len(t.cluster_by) == 1 else write_interleaved)(out, f"{target}/clustered", t.cluster_by)
        out = spark.read.parquet(f"{target}/clustered")
    return out
