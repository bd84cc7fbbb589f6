"""Column functions that the shaping jobs apply; all of them are Spark expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- names


def snake_case(name: str) -> str:
    """``recordedDate`` and ``HTTPStatus`` to ``recorded_date`` and ``http_status``."""
    parts = re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z0-9]+|[^A-Za-z0-9_]+|[A-Z]", name)
    return "_".join(p.lower() for p in parts if not re.fullmatch(r"[^A-Za-z0-9]+", p)) or name.lower()


def _renamed(kind: T.DataType, rule) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(rule(f.name), _renamed(f.dataType, rule), f.nullable) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_renamed(kind.elementType, rule), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _renamed(kind.valueType, rule), kind.valueContainsNull)
    return kind


def rename(df: DataFrame, rule) -> DataFrame:
    """Columns and nested fields renamed by ``rule``; nested ones through a cast, which moves no data."""
    return df.select(*(F.col(f"`{f.name}`").cast(_renamed(f.dataType, rule)).alias(rule(f.name)) for f in df.schema))


def safe_column_name(raw: str | None, i: int) -> str:
    name = re.sub(r"[^A-Za-z0-9]+", "_", raw or "").strip("_")
    return name or f"_col{i}"


def header_to_snake(raw: str) -> str:
    return re.sub(r"\s+", "_", raw.strip().lower())


# --- nulls


def empty_to_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in columns})


def all_null_struct_to_null(c: Column, kind: T.DataType) -> Column:
    """Structs of which every field is null become null, from the inside out, in arrays too."""
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: all_null_struct_to_null(x, kind.elementType))
    if not isinstance(kind, T.StructType):
        return c
    fields = [all_null_struct_to_null(c[f.name], f.dataType).alias(f.name) for f in kind]
    any_set = reduce(lambda a, b: a | b, [f.isNotNull() for f in fields], F.lit(False))
    return F.when(any_set, F.struct(*fields))


# --- JSON and nesting


def json_text(c: Column, kind: T.DataType) -> Column:
    """Nested values as JSON, text as it is, other scalars as text."""
    return F.to_json(c) if isinstance(kind, T.StructType | T.ArrayType | T.MapType | T.VariantType) else c.cast("string")


def nested_path(c: Column, path: str) -> Column:
    """Text at a dotted path of JSON text; a missing step is null."""
    return F.get_json_object(c, "$." + path)


def hoist(df: DataFrame, column: str, paths: dict[str, str]) -> DataFrame:
    """Nested JSON fields lifted to columns; a name with dots in one step is quoted as ``['a.b']``."""
    return df.withColumns({k: F.get_json_object(column, v if v.startswith("$") else "$." + v) for k, v in paths.items()})


def build_url(*parts) -> Column:
    return F.concat_ws("/", *(p if isinstance(p, Column) else F.lit(p) for p in parts))


def string_list(c: Column, kind: T.DataType) -> Column:
    """A scalar as a list of one, items as text, null stays null."""
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: x.cast("string"))
    return F.when(c.isNotNull(), F.array(c.cast("string")))


def resource_ref(c: Column, fields: tuple[str, ...] = ("id", "name", "resourceType")) -> Column:
    """A fixed struct out of JSON text that refers to a resource; null without an id."""
    made = F.from_json(c, ", ".join(f"{f} string" for f in fields))
    return F.when(made[fields[0]].isNotNull(), made)


def association_ids(c: Column) -> Column:
    """Ids out of ``{"results": [{"id": ..}]}`` or a bare list of such objects; none gives an empty array."""
    wrapped = F.from_json(c, "results array<struct<id string>>")["results"]
    bare = F.when(F.trim(c).startswith("["), F.from_json(c, "array<struct<id string>>"))
    return F.coalesce(F.transform(F.coalesce(bare, wrapped), lambda x: x["id"]), F.array().cast("array<string>"))


def first_present(top: Column, values: Column, key: str) -> Column:
    """The record's own field or else the text entry of ``key`` in its map of answers."""
    return F.coalesce(top, F.try_element_at(values, F.lit(key))["textEntry"])


def answers_map(c: Column, metadata: list[str]) -> Column:
    """A map of JSON answers without metadata keys; a scalar answer is wrapped as its ``textEntry``."""
    kept = F.map_filter(c, lambda k, _: ~k.isin(metadata))
    shape = "choiceText string, choiceId string, textEntry string"
    wrap = lambda v: F.struct(F.lit(None).cast("string").alias("choiceText"), F.lit(None).cast("string").alias("choiceId"), F.regexp_replace(v, '^"|"$', "").alias("textEntry"))
    return F.transform_values(kept, lambda _, v: F.when(F.trim(v).startswith("{"), F.from_json(v, shape)).otherwise(wrap(v)))


def split_known_keys(c: Column, known: list[str]) -> tuple[Column, Column]:
    """Entries of a map with known keys, and the rest."""
    return F.map_filter(c, lambda k, _: k.isin(known)), F.map_filter(c, lambda k, _: ~k.isin(known))


def zip_series(df: DataFrame, dates: str, series: str, labels: str) -> DataFrame:
    """``(date, value, segment)`` out of ``[date]``, ``[[value]]`` and ``[label]``; ragged tails drop, no label is ``Totals``."""
    rows = df.select(dates, labels, F.posexplode(series).alias("__s", "__values"))
    label = F.coalesce(F.get(labels, F.col("__s")), F.lit("Totals"))
    n = F.least(F.size(dates), F.size("__values"))
    pairs = F.arrays_zip(F.slice(dates, 1, n).alias("date"), F.slice("__values", 1, n).alias("value"))
    return rows.select(label.alias("segment"), F.explode(pairs).alias("p")).select("p.date", "p.value", "segment")


def values_by_header(df: DataFrame, headers: str, values: str, columns: dict[str, str]) -> DataFrame:
    """Positional values as named typed columns; missing ones are null."""
    n = F.least(F.size(headers), F.size(values))
    m = F.map_from_arrays(F.slice(headers, 1, n), F.slice(values, 1, n))
    return df.withColumn("__m", m).withColumns({k: typed_metric(F.try_element_at("__m", F.lit(k)), t) for k, t in columns.items()}).drop("__m", headers, values)


def first_match(c: Column, condition, then=lambda x: x) -> Column:
    """The first array element that meets a condition, or null."""
    return then(F.get(F.filter(c, condition), F.lit(0)))


# --- numbers, times and words


def coerce(c: Column, kind: str) -> Column:
    return c.try_cast(kind)


def typed_metric(c: Column, kind: str) -> Column:
    """``int``, ``double`` or ``string``; failure is null. Whole numbers may be written with a point."""
    return c.try_cast("double").try_cast("bigint") if kind == "int" else c.try_cast(kind)


def lenient_bool(c: Column, default: bool) -> Column:
    t = F.lower(F.trim(c.cast("string")))
    return F.when(t.isin("true", "t", "yes", "y", "1"), True).when(t.isin("false", "f", "no", "n", "0"), False).otherwise(default)


def epoch_ms_to_ts(c: Column) -> Column:
    return F.timestamp_millis(c.try_cast("bigint"))


def epoch_s_to_ts(c: Column) -> Column:
    return F.timestamp_seconds(c.try_cast("decimal(20,6)"))


def sap_date(c: Column) -> Column:
    """``/Date(ms+offset)/`` to ISO UTC text; other text unchanged. The offset is only for display."""
    ms = F.regexp_extract(c, r"^/Date\((-?[0-9]+)([+-][0-9]+)?\)/$", 1)
    return F.when(ms != "", F.date_format(F.timestamp_millis(ms.try_cast("bigint")), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).otherwise(c)


def yyyymmdd(c: Column) -> Column:
    return F.when(c.rlike("^[0-9]{8}$"), F.try_to_date(c, "yyyyMMdd"))


def parse_ts_multi(c: Column) -> Column:
    """ISO with or without zone and fraction, or plain with slashes; UTC."""
    return F.coalesce(F.when(c.rlike(r"^\d{4}-"), c.try_cast("timestamp")), F.try_to_timestamp(c, F.lit("yyyy/MM/dd HH:mm:ss")))


def relative_time(c: Column, now: Column) -> Column:
    """``*``, ``*-10m``, ``*-2h``, ``*-1d`` against ``now``, or ISO text; anything else is ``now``."""
    n = F.regexp_extract(c, r"^\*-([0-9]+)([mhd])$", 1).try_cast("int")
    unit = F.regexp_extract(c, r"^\*-([0-9]+)([mhd])$", 2)
    zero = F.lit(0)
    back = F.make_dt_interval(F.when(unit == "d", n).otherwise(zero), F.when(unit == "h", n).otherwise(zero), F.when(unit == "m", n).otherwise(zero), zero)
    return F.when(n.isNotNull(), now - back).otherwise(F.coalesce(F.when(c.rlike(r"^\d{4}-"), c.try_cast("timestamp")), now))


def hl7_ts(c: Column) -> Column:
    """``YYYY[MM[DD[HH[MM[SS[.f]]]]]][±ZZZZ]``, parentheses dropped, to ISO UTC text; other text is null."""
    shape = r"^(\d{4})(\d{2})?(\d{2})?(\d{2})?(\d{2})?(\d{2})?(\.\d{1,6})?([+-]\d{4})?$"
    zone = lambda t: F.coalesce(F.nullif(F.regexp_extract(t, r"[+-]\d{4}", 0), F.lit("")), F.lit("+0000"))
    padded = lambda d: F.concat(d, F.substring(F.lit("00000101000000"), F.length(d) + 1, F.lit(14)))
    joined = lambda d, z: F.concat(F.substring(d, 1, 4), F.lit("-"), F.substring(d, 5, 2), F.lit("-"), F.substring(d, 7, 2), F.lit("T"), F.substring(d, 9, 2), F.lit(":"), F.substring(d, 11, 2), F.lit(":"), F.substring(d, 13, 2), F.left(z, F.lit(3)), F.lit(":"), F.right(z, F.lit(2)))
    bound = lambda c, f: F.get(F.transform(F.array(c), f), F.lit(0))  # noqa: E731 (each value is made once, however often it is used)
    # 4 to 14 digits, told apart by their places; a fraction of a second is not shown
    text = lambda t: bound(F.regexp_extract(t, r"^\d+", 0), lambda d: bound(padded(d), lambda d: bound(zone(t), lambda z: joined(d, z))))
    return bound(F.translate(c, "()", ""), lambda t: F.when(t.rlike(shape), F.date_format(text(t).try_cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")))


def dicom_value(c: Column, tag: str) -> Column:
    """The first value at a tag of tag-keyed JSON, as text; names take alphabetic, then ideographic, then phonetic."""
    vr = F.get_json_object(c, f"$.{tag}.vr")
    name = F.coalesce(*(F.get_json_object(c, f"$.{tag}.Value[0].{k}") for k in ("Alphabetic", "Ideographic", "Phonetic")))
    return F.when(vr == "PN", name).otherwise(F.get_json_object(c, f"$.{tag}.Value[0]"))


def left_text(c: Column, n: int) -> Column:
    return F.left(c, F.lit(n))


def row_key(*columns: str) -> Column:
    """Composite key as text; parts are JSON, so ``("a", "b|c")`` and ``("a|b", "c")`` differ."""
    return F.to_json(F.array(*(F.col(c).cast("string") for c in columns)))


def cuts_below(c: Column, cuts: list, kind) -> Column:
    """How many of the sorted ``cuts`` lie below the value, by halving: some fourteen steps for ten thousand cuts. Null gives zero."""
    if not cuts:
        return F.lit(0)
    all_ = F.array(*(F.lit(x).cast(kind) for x in cuts))
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))))
    return F.aggregate(steps, F.lit(0), lambda low, s: F.when(F.get(all_, low + s - 1) < c, low + s).otherwise(low))
