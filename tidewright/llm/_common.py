"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows handled at once inside a task, so that memory follows the texts of a few rows.
SLICE_ROWS = 512

_own_dir: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session names none, a local session (one machine) gets a temporary folder that goes when Python ends; on a
    cluster that raises, as no folder of the driver's machine would do.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="spark-tidewright-"))
        atexit.register(shutil.rmtree, _own_dir[0], ignore_errors=True)
    return _own_dir[0]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage with files that survive a lost executor, and keeps work that is used twice
    from running twice.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hash_sample(df: DataFrame, most: int, *columns: str, salt: str = "") -> DataFrame:
    """At most ``most`` rows of ``df``, those with the smallest hashes of ``columns``; rows with equal hashes count once.

    A threshold on the hash, set from the number of distinct hashes (copies do not shrink the sample), leaves about twice the
    sample for the final order, so what meets there is bounded whatever the number of tasks.
    """
    range_ = 1 << 30
    h = F.pmod(F.xxhash64(F.lit(salt), *(F.col(c).cast("string") for c in columns)), F.lit(range_))
    n = df.agg(F.approx_count_distinct(h)).first()[0]
    cut = range_ if n <= 2 * most else max(1, range_ * 2 * most // n)
    near = df.withColumn("__h", h).where(F.col("__h") < cut).dropDuplicates(["__h"])
    return near.orderBy("__h").limit(most).drop("__h")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_texts(
    df: DataFrame,
    fn: Callable[[], Callable[[list], dict[str, list]]],
    added: T.StructType,
    text: str = "text",
    keep_text: bool = False,
) -> DataFrame:
    """Add columns that are computed from ``text`` alone, in Arrow batches; ``text`` goes unless kept.

    ``fn`` is called once per task and returns a function from a list of texts to one list per
    added column. The other columns of ``df`` pass through untouched (nulls and 64-bit ids
    included). ``df`` must not hold the added names.
    """
    keep = [f for f in df.schema.fields if keep_text or f.name != text]
    schema = T.StructType([*keep, *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        work = fn()
        kinds = {f.name: to_arrow_type(f.dataType) for f in added.fields}
        for batch in slices(batches):
            gc.disable()  # nothing below makes cycles, and large caches make collections slow
            made = work(batch.column(text).to_pylist())
            gc.enable()
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in keep] + [pa.array(made[f.name], type=kinds[f.name]) for f in added.fields],
                names=[f.name for f in schema.fields],
            )

    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def vocabulary_path(name: str) -> str:
    """Where a public tokenizer's file is on this machine."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))
