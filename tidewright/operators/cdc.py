"""Change-data merges: type 1, type 2, snapshots, deletes and tombstones.

Changes of a key are ordered by ``(sequence, deletes after upserts, hash of all columns)`` and the greatest wins. Rows
with a null key or sequence are left out of merges; ``rejected_changes`` returns them. Snapshots are compared by key, null keys being equal.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewright.operators.scans import with_neighbours

VERSION = ("valid_from", "valid_to", "is_current")


def content_hash(df: DataFrame, columns: list[str] | None = None) -> Column:
    """SHA-256 of the row as JSON, columns in schema order, nulls kept."""
    return F.sha2(F.to_json(F.struct(*(columns or df.columns)), {"ignoreNullFields": "false"}), 256)


def _present(keys: list[str], sequence_by: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, sequence_by]])


def change_order(df: DataFrame, sequence_by: str, is_delete: str | None = None) -> Column:
    """Sequence, deletes after upserts, then 128 bits of hash, so that changes with one sequence have the same order in every run."""
    flag = F.coalesce(F.col(is_delete), F.lit(False)) if is_delete else F.lit(False)
    told = _told(df, df.columns)
    return F.struct(F.col(sequence_by), flag, F.xxhash64(*told), F.xxhash64(F.lit(1), *told))


def rejected_changes(changes: DataFrame, keys: list[str], sequence_by: str) -> DataFrame:
    """Changes that no merge takes: a key column or the sequence is null."""
    return changes.where(~_present(keys, sequence_by))


def scd1(changes: DataFrame, keys: list[str], sequence_by: str, is_delete: str | None = None, keep_tombstones: bool = False) -> DataFrame:
    """The latest change of each key; one aggregation with map-side combining and no window.

    With ``is_delete`` a latest change that deletes takes the key away, unless tombstones are kept (as stored state
    must, or a late upsert would bring a deleted row back).
    """
    rest = [c for c in changes.columns if c not in keys]
    latest = (
        changes.where(_present(keys, sequence_by))
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), change_order(changes, sequence_by, is_delete)).alias("row"))
        .select(*keys, "row.*")
        .select(changes.columns)
    )
    return latest if keep_tombstones or not is_delete else latest.where(~F.coalesce(F.col(is_delete), F.lit(False)))


def scd1_merge(state: DataFrame, changes: DataFrame, keys: list[str], sequence_by: str, is_delete: str | None = None) -> DataFrame:
    """State after a batch; a change older than the state is ignored. State keeps tombstones."""
    return scd1(state.unionByName(changes), keys, sequence_by, is_delete, keep_tombstones=True)


def distinct_changes(changes: DataFrame, keys: list[str], sequence_by: str, is_delete: str | None = None) -> DataFrame:
    """One change for each key and sequence, the greatest; those without a key or a sequence go."""
    at = [*keys, sequence_by]
    rest = [c for c in changes.columns if c not in at]
    clean = changes.where(_present(keys, sequence_by))
    if not rest:
        return clean.distinct()
    return clean.groupBy(*at).agg(F.max_by(F.struct(*rest), change_order(changes, sequence_by, is_delete)).alias("row")).select(*at, "row.*").select(changes.columns)


def scd2(changes: DataFrame, keys: list[str], sequence_by: str, is_delete: str | None = None, pieces: int = 1) -> DataFrame:
    """One version per change with half-open ``[valid_from, valid_to)``; a delete closes and adds none.

    Of several changes of a key with one sequence the greatest stands. With ``pieces`` ranges of the sequence a key with most changes is many tasks' work.
    """
    clean = distinct_changes(changes, keys, sequence_by, is_delete)
    if pieces > 1:
        clean = with_neighbours(clean, keys, [sequence_by], {"valid_to": ("next", sequence_by)}, pieces)
    else:
        clean = clean.withColumn("valid_to", F.lead(sequence_by).over(Window.partitionBy(*keys).orderBy(sequence_by)))
    out = clean.withColumn("valid_from", F.col(sequence_by)).withColumn("is_current", F.col("valid_to").isNull()).select(*changes.columns, *VERSION)
    return out.where(~F.coalesce(F.col(is_delete), F.lit(False))) if is_delete else out


def scd2_merge(versions: DataFrame, history: DataFrame, batch: DataFrame, keys: list[str], sequence_by: str, is_delete: str | None = None) -> DataFrame:
    """Versions after a batch that may hold late rows; only touched keys are computed anew.

    ``history`` holds all changes before the batch.
    """
    touched = batch.select(*keys).distinct()
    again = scd2(history.join(touched, keys, "left_semi").unionByName(batch), keys, sequence_by, is_delete)
    return versions.join(touched, keys, "left_anti").select(again.columns).unionByName(again)


def _told(df: DataFrame, columns: list[str]) -> list[Column]:
    """What hashes of a row are made of. A hash skips nulls, so each column tells whether it is null; nested ones are taken as JSON."""
    told: list[Column] = []
    for c in columns:
        col, nested = F.col(f"`{c}`"), isinstance(df.schema[c].dataType, T.StructType | T.ArrayType | T.MapType | T.VariantType)
        told += [col.isNull(), F.to_json(F.struct(col), {"ignoreNullFields": "false"}) if nested else col]
    return told


def _paired(previous: DataFrame, current: DataFrame, keys: list[str], carry: tuple[str, ...] = ()) -> DataFrame:
    """``old`` and ``new`` row of each key with their hashes, null in the snapshot that lacks it; ``old`` has the columns ``carry`` too.

    One shuffle and no join: null keys are equal, and of rows that repeat a key the one with the greatest hash stands.
    """
    cols = current.columns
    old = previous.select(*keys, F.struct(*cols, *carry).alias("old"), content_hash(previous, cols).alias("old_hash"))
    new = current.select(*keys, F.struct(*cols).alias("new"), content_hash(current).alias("new_hash"))
    both = old.unionByName(new, allowMissingColumns=True).groupBy(*keys)
    return both.agg(F.max_by("old", "old_hash").alias("old"), F.max("old_hash").alias("old_hash"), F.max_by("new", "new_hash").alias("new"), F.max("new_hash").alias("new_hash"))


def snapshot_changes(previous: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of either snapshot that differ, tagged ``insert``, ``update`` or ``delete`` (which has the old row).

    Null keys are equal, and of rows that repeat a key one stands; an empty snapshot deletes or inserts all.
    """
    change = F.when(F.col("old_hash").isNull(), "insert").when(F.col("new_hash").isNull(), "delete").when(F.col("old_hash") != F.col("new_hash"), "update")
    pairs = _paired(previous, current, keys).withColumn("change", change).where("change is not null")
    return pairs.select("change", F.coalesce("new", "old").alias("row")).select("change", "row.*")


def snapshot_scd1(previous: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """State after a full snapshot: inserts, updates and removals leave just the snapshot, each key once."""
    return _paired(previous, current, keys).where("new_hash is not null").select("new.*")


def snapshot_scd2(history: DataFrame, current: DataFrame, keys: list[str], version) -> DataFrame:
    """History after a snapshot with number or date ``version``; a missing key closes there. Closed versions are not touched; open ones are compared in one shuffle."""
    columns = [*current.columns, "valid_from", "valid_to"]
    made = snapshot_step(history.where("valid_to is null").select(columns), current, keys, version)
    return history.where("valid_to is not null").select(columns).unionByName(made).withColumn("is_current", F.col("valid_to").isNull())


def snapshot_step(open_versions: DataFrame, current: DataFrame, keys: list[str], version) -> DataFrame:
    """What a snapshot makes of the open versions ``(columns, valid_from, valid_to)``: those still open, those that it closes and those that it opens."""
    cols, v = current.columns, F.lit(version)
    pairs = _paired(open_versions, current, keys, ("valid_from",))
    same = F.coalesce(F.col("old_hash") == F.col("new_hash"), F.lit(False))
    ends = open_versions.schema["valid_to"].dataType
    row = lambda side, start, end: F.struct(*(F.col(f"{side}.`{c}`").alias(c) for c in cols), start.alias("valid_from"), end.cast(ends).alias("valid_to"))
    before = F.when(F.col("old_hash").isNotNull(), row("old", F.col("old.valid_from"), F.when(~same, v)))
    after = F.when(F.col("new_hash").isNotNull() & ~same, row("new", v.cast(open_versions.schema["valid_from"].dataType), F.lit(None)))
    return pairs.select(F.explode(F.filter(F.array(before, after), lambda x: x.isNotNull())).alias("r")).select("r.*")


def tombstone_feed(df: DataFrame, removed: Column, order_by: str, keep: list[str], control: str = "@") -> DataFrame:
    """In-band deletes: ``_deleted``, a monotone ``_sequence``, and only ``keep`` filled on deletes.

    Columns whose name holds ``control`` go. The sequence is the source's own order column, which unlike a generated
    number means the same in a second run.
    """
    cols = [c for c in df.columns if control not in c]
    flag = F.coalesce(removed, F.lit(False))
    return df.select(*(F.col(c) if c in keep else F.when(~flag, F.col(c)).alias(c) for c in cols), flag.alias("_deleted"), F.col(order_by).alias("_sequence"))


def tombstone_keys_from_ref(df: DataFrame, ref: str, collection: str, keys: dict[str, str]) -> DataFrame:
    """Key columns out of references like ``Orders(OrderID=1,Lang='en')``; ``key_error`` says why one has none.

    A single unnamed key (``Orders(1)``) is taken where one key is asked for. ``keys`` gives each key's type.
    """
    name = F.regexp_extract(ref, r"([A-Za-z_][A-Za-z0-9_]*)\(", 1)
    inside = F.regexp_extract(ref, r"\((.*)\)$", 1)
    out = df.withColumns({"__name": name, "__in": inside})
    for k, kind in keys.items():
        named = F.regexp_extract("__in", rf"(?:^|,)\s*{k}\s*=\s*('(?:[^']|'')*'|[^,']+)", 1)
        raw = F.when(named != "", named)
        if len(keys) == 1:
            raw = F.coalesce(raw, F.when(~F.col("__in").contains("="), F.col("__in")))
        text = F.when(raw.startswith("'"), F.replace(F.regexp_replace(raw, "^'|'$", ""), F.lit("''"), F.lit("'"))).otherwise(raw)
        out = out.withColumn(k, text.try_cast(kind))
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    error = F.when(F.col("__name") != collection, F.concat(F.lit("other collection: "), F.col("__name"))).when(missing, F.lit("key not found"))
    return out.withColumn("key_error", error).drop("__name", "__in")


def deletes_from_history(log: DataFrame, ids: str, level: str = "id") -> DataFrame:
    """Distinct ids out of a log whose column ``ids`` lists the deleted records of each event."""
    return log.select(F.explode(ids).alias("d")).select(F.col(f"d.{level}").alias(level) if level else F.col("d").alias("id")).where(f"{level or 'id'} is not null").distinct()


def archived_as_deletes(df: DataFrame, archived: str, archived_at: str, cursor: str) -> DataFrame:
    """Archived rows as deletes: the archive time becomes the cursor."""
    return df.where(F.col(archived)).withColumn(cursor, F.col(archived_at)).withColumn("_deleted", F.lit(True))


def upserts_plus_deletes(upserts: DataFrame, deletes: DataFrame, flag: str = "_deleted") -> DataFrame:
    """Both in one feed with a flag; columns that deletes lack are null there."""
    return upserts.withColumn(flag, F.lit(False)).unionByName(deletes.withColumn(flag, F.lit(True)), allowMissingColumns=True)


def full_refresh_upsert(state: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Everything read again and upserted by key: rows of ``table`` win, keys only in ``state`` stay. Null keys are equal, as in snapshots."""
    told = table.select(*(F.col(k).alias(f"__{k}") for k in keys)).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return state.join(told, same, "left_anti").select(table.columns).unionByName(table)
