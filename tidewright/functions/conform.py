"""Conform raw JSON-like columns to a schema with ``try_`` casts; a bad value becomes null or an error, never a failed job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts read as booleans, and formats tried for dates and timestamps, in this order.
TRUE, FALSE = ("true", "t", "yes", "y", "1"), ("false", "f", "no", "n", "0")
DATES = ("yyyy-MM-dd", "MM/dd/yyyy", "dd-MM-yyyy", "yyyy/MM/dd")
TIMESTAMPS = ("yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss")
DATE_SHAPES = (r"^\d{4}-\d{1,2}-\d{1,2}$", r"^\d{1,2}/\d{1,2}/\d{4}$", r"^\d{1,2}-\d{1,2}-\d{4}$", r"^\d{4}/\d{1,2}/\d{1,2}$")


def _text(c: Column, kind: T.DataType) -> Column:
    return c if isinstance(kind, T.StringType) else F.to_json(c) if isinstance(kind, T.StructType | T.ArrayType | T.MapType | T.VariantType) else c.cast("string")


def _whole(c: Column, kind: T.DataType, to: T.DataType) -> Column:
    """Text with a point is cut to its whole part; booleans count as 0 and 1."""
    if not isinstance(kind, T.StringType):
        return c.try_cast(to)
    t = F.trim(c)
    plain = F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast(to))
    return F.coalesce(plain, F.when(t.rlike(r"^[+-]?[0-9]*\.?[0-9]*([eE][+-]?[0-9]+)?$") & (t != ""), t.try_cast("double").try_cast(to)))


def _boolean(c: Column, kind: T.DataType, strict: bool) -> Column:
    """Known words in either case; other non-empty text is true, or an error if ``strict``."""
    if not isinstance(kind, T.StringType):
        return c.try_cast("boolean")
    t = F.lower(F.trim(c))
    known = F.when(t.isin(*TRUE), True).when(t.isin(*FALSE), False)
    return known if strict else known.when(t != "", True)


def _date(c: Column, kind: T.DataType) -> Column:
    if not isinstance(kind, T.StringType):
        return c.try_cast("date")
    tried = [F.when(c.rlike(shape), F.try_to_date(c, f)) for f, shape in zip(DATES, DATE_SHAPES, strict=True)]
    return F.coalesce(*tried, F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}[T ]"), c.try_cast("timestamp").cast("date")))


def _timestamp(c: Column, kind: T.DataType) -> Column:
    """ISO text with ``Z`` or an offset, two plain formats, or a number of epoch seconds; UTC."""
    if isinstance(kind, T.NumericType):
        return F.timestamp_seconds(c)
    if not isinstance(kind, T.StringType):
        return c.try_cast("timestamp")
    iso = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), c.try_cast("timestamp"))
    slashed = F.when(c.rlike(r"^\d{4}/\d{2}/\d{2} "), F.try_to_timestamp(c, F.lit(TIMESTAMPS[1])))
    number = F.when(c.rlike(r"^[0-9]+(\.[0-9]+)?$"), F.timestamp_seconds(c.try_cast("decimal(20,6)")))
    return F.coalesce(iso, slashed, number)


def _binary(c: Column) -> Column:
    """Hexadecimal if all of the text is, else base64 if it is padded right, else its UTF-8 bytes.

    The order is strict: a text that is valid in the first form is read in that form.
    """
    return F.coalesce(
        F.when(c.rlike("^([0-9A-Fa-f]{2})+$"), F.try_to_binary(c, F.lit("hex"))),
        F.when(c.rlike("^([A-Za-z0-9+/]{4})*([A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$") & (F.length(c) > 0), F.try_to_binary(c, F.lit("base64"))),
        F.encode(c, "utf-8"),
    )


def conform_column(c: Column, kind: T.DataType, to: T.DataType, strict_booleans: bool = False) -> Column:
    """``c`` of type ``kind`` as type ``to``; null where it cannot be.

    A scalar where an array is declared becomes an array of one. Missing struct fields are null and extra ones go; a
    struct without any value from an empty object is null.
    """
    again = lambda x, k, t: conform_column(x, k, t, strict_booleans)
    if isinstance(to, T.StructType):
        if isinstance(kind, T.StringType):
            return F.from_json(c, to)
        if not isinstance(kind, T.StructType):
            return F.lit(None).cast(to)
        have = {f.name: f.dataType for f in kind}
        fields = [(again(c[f.name], have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in to]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(to, T.ArrayType):
        if isinstance(kind, T.ArrayType):
            return F.transform(c, lambda x: again(x, kind.elementType, to.elementType))
        if isinstance(kind, T.StringType):
            many = F.from_json(c, to)
            return F.when(c.isNull(), F.lit(None).cast(to)).when(c.startswith("["), many).otherwise(F.array(again(c, kind, to.elementType)))
        return F.when(c.isNotNull(), F.array(again(c, kind, to.elementType)))
    if isinstance(to, T.MapType):
        if isinstance(kind, T.MapType):
            keyed = F.transform_keys(c, lambda k, _: again(k, kind.keyType, to.keyType))
            return F.transform_values(keyed, lambda _, v: again(v, kind.valueType, to.valueType))
        return F.from_json(_text(c, kind), to)
    if isinstance(to, T.VariantType):
        return F.try_parse_json(_text(c, kind))
    if isinstance(kind, T.StructType | T.ArrayType | T.MapType | T.VariantType):
        return _text(c, kind) if isinstance(to, T.StringType) else F.lit(None).cast(to)
    if isinstance(to, T.StringType):
        return c.cast("string")
    if isinstance(to, T.IntegralType):
        return _whole(c, kind, to)
    if isinstance(to, T.FractionalType):
        return (F.trim(c) if isinstance(kind, T.StringType) else c).try_cast(to)
    if isinstance(to, T.BooleanType):
        return _boolean(c, kind, strict_booleans)
    if isinstance(to, T.DateType):
        return _date(c, kind)
    if isinstance(to, T.TimestampType):
        return _timestamp(c, kind)
    if isinstance(to, T.TimestampNTZType):
        return c.try_cast(to) if isinstance(kind, T.TimestampNTZType | T.DateType) else _timestamp(c, kind).cast(to)
    if isinstance(to, T.BinaryType):
        return _binary(c) if isinstance(kind, T.StringType) else c.try_cast("binary")
    raise ValueError(f"{to.simpleString()} is not supported")


def conform(df: DataFrame, schema: T.StructType, strict_booleans: bool = False) -> DataFrame:
    """Columns of ``schema``; missing ones null, extra ones dropped, bad values null."""
    have = {f.name: f.dataType for f in df.schema}
    return df.select(*((conform_column(F.col(f"`{f.name}`"), have[f.name], f.dataType, strict_booleans) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema))


def _reasons(c: Column, kind: T.DataType, to: T.DataType, path: str, nullable: bool = True) -> Column:
    """Array of texts: what in ``c`` does not fit ``to``, each with its path; elements of arrays and maps count by their container."""
    none = F.array().cast("array<string>")
    missing = [] if nullable else [F.when(c.isNull(), F.array(F.lit(f"{path}: missing"))).otherwise(none)]
    misfit = F.array(F.lit(f"{path}: not a {to.simpleString()}"))
    if isinstance(to, T.StructType) and isinstance(kind, T.StructType):
        have = {f.name: f.dataType for f in kind}
        inner = [_reasons(c[f.name], have[f.name], f.dataType, f"{path}.{f.name}", f.nullable) for f in to if f.name in have]
        inner += [F.array(F.lit(f"{path}.{f.name}: missing")) for f in to if f.name not in have and not f.nullable]
        found = F.when(c.isNotNull(), F.concat(none, *inner)).otherwise(none)
    elif isinstance(to, T.ArrayType) and isinstance(kind, T.ArrayType):
        found = F.when(c.isNotNull(), F.array_distinct(F.flatten(F.transform(c, lambda x: _reasons(x, kind.elementType, to.elementType, f"{path}[]", to.containsNull))))).otherwise(none)
    elif isinstance(to, T.MapType) and isinstance(kind, T.MapType):
        keys = F.transform(F.map_keys(c), lambda x: _reasons(x, kind.keyType, to.keyType, f"{path}.key"))
        values = F.transform(F.map_values(c), lambda x: _reasons(x, kind.valueType, to.valueType, f"{path}[]", to.valueContainsNull))
        found = F.when(c.isNotNull(), F.array_distinct(F.flatten(F.concat(keys, values)))).otherwise(none)
    elif isinstance(kind, T.StringType) and isinstance(to, T.StructType | T.ArrayType | T.MapType):
        parsed = F.try_parse_json(c)
        alone = _reasons(c, kind, to.elementType, f"{path}[]") if isinstance(to, T.ArrayType) else misfit
        shape = r"^\s*\[" if isinstance(to, T.ArrayType) else r"^\s*\{"
        loose = _loose(to)
        inner = _reasons(F.from_json(c, loose), loose, to, path)
        found = F.when(c.isNull(), none).when(~c.rlike(shape), alone).when(parsed.isNull(), misfit).otherwise(inner)
    else:
        found = F.when(c.isNotNull() & conform_column(c, kind, to, strict_booleans=True).isNull(), misfit).otherwise(none)
    return F.concat(found, *missing)


def _loose(to: T.DataType) -> T.DataType:
    """The shape of ``to`` with every scalar as text, so that JSON text can be read whole and its values tested."""
    if isinstance(to, T.StructType):
        return T.StructType([T.StructField(f.name, _loose(f.dataType)) for f in to])
    if isinstance(to, T.ArrayType):
        return T.ArrayType(_loose(to.elementType))
    return T.MapType(T.StringType(), _loose(to.valueType)) if isinstance(to, T.MapType) else T.StringType()


def conform_strict(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows as they came with ``reasons``: values that did not fit or that must not be null, at any depth.

    A reason names the path of the value, ``s.x`` for a struct's field and ``a[]`` for the elements of an array or map.
    """
    have = {f.name: f.dataType for f in df.schema}
    reasons = [_reasons(F.col(f"`{f.name}`"), have[f.name], f.dataType, f.name, f.nullable) if f.name in have else F.array(F.lit(f"{f.name}: missing")) for f in schema if f.name in have or not f.nullable]
    marked = df.withColumn("reasons", F.concat(*reasons) if reasons else F.array().cast("array<string>"))
    good = marked.where(F.size("reasons") == 0).drop("reasons")
    return conform(good, schema, strict_booleans=True), marked.where(F.size("reasons") > 0)


def project_to_schema(c: Column, schema: T.DataType) -> Column:
    """JSON text projected to a schema, recursively; a part of the wrong shape is null."""
    return F.from_json(c, schema, {"mode": "PERMISSIVE"})


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
