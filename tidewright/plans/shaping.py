"""Raw JSON records to typed tables: flattening, exploding, maps, header rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions import scalars as s


def flatten_paths(df: DataFrame, raw: str, columns: dict[str, tuple[str, str]], keep: tuple[str, ...] = ()) -> DataFrame:
    """One typed column for each JSON path: ``{name: (path, type)}``. Channels, playlists, commits and the like are such tables."""
    return df.select(*keep, *(s.nested_path(F.col(raw), path).try_cast(kind).alias(name) for name, (path, kind) in columns.items()))


def by_path(*paths: str, kind: str = "string") -> dict[str, tuple[str, str]]:
    """Columns for ``flatten_paths`` named by their paths: ``commit.author.name`` becomes ``commit_author_name``."""
    return {p.replace(".", "_"): (p, kind) for p in paths}


def osdu_flatten(df: DataFrame, raw: str, by_kind: dict[str, dict[str, tuple[str, str]]]) -> DataFrame:
    """Envelope columns, columns of a record's own kind (null for other kinds), and the ``data`` block as JSON.

    ``by_kind`` maps a part of the kind's name to its columns.
    """
    j = lambda p: F.get_json_object(raw, "$." + p)
    kind = F.lower(j("kind"))
    own = [F.when(kind.contains(k.lower()), j("data." + path).try_cast(t)).alias(name) for k, cols in by_kind.items() for name, (path, t) in cols.items()]
    return df.select(j("id").alias("id"), j("kind").alias("kind"), j("version").try_cast("bigint").alias("version"), j("createTime").try_cast("timestamp").alias("create_time"), j("modifyTime").try_cast("timestamp").alias("modify_time"), *own, j("data").alias("data_json"))


def child_events(df: DataFrame, children: str, kind_field: str, kind: str) -> DataFrame:
    """Child records of one kind; a child's own fields override its parent's of the same name."""
    fields = df.schema[children].dataType.elementType.fieldNames()
    rows = df.withColumn("__c", F.explode(children)).where(F.col(f"__c.{kind_field}") == kind)
    up = [c for c in df.columns if c != children]
    own = [F.coalesce(F.col(f"__c.{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in up]
    return rows.select(*own, *(F.col(f"__c.{f}").alias(f) for f in fields if f not in up))


def time_entries(df: DataFrame, records: str, keys: list[str]) -> DataFrame:
    """One row for each entry of a day's list, with the day's keys."""
    return df.select(*keys, F.inline(records))


def questions_and_pages(df: DataFrame, survey: str, pages: str) -> tuple[DataFrame, DataFrame]:
    """Pages with their survey and questions with survey and page, out of survey documents nested two deep."""
    p = df.select(F.col(survey).alias("survey_id"), F.explode(pages).alias("p"))
    fields = [f for f in p.schema["p"].dataType.fieldNames() if f != "questions"]
    q = p.select("survey_id", F.col("p.id").alias("page_id"), F.explode("p.questions").alias("q"))
    return p.select("survey_id", *(F.col(f"p.{f}").alias("page_id" if f == "id" else f) for f in fields)), q.select("survey_id", "page_id", "q.*")


def subform_items(df: DataFrame, parent_id: str, module: str, items: str) -> DataFrame:
    return df.select(F.col(parent_id).alias("_parent_id"), F.lit(module).alias("_parent_module"), F.explode(items).alias("i")).select("_parent_id", "_parent_module", "i.*")


def survey_responses(df: DataFrame, values: str, top: dict[str, str], metadata: list[str]) -> DataFrame:
    """Response fields with a fallback to the answers, snake-case names, and the answers without metadata.

    ``top`` maps output columns to keys of ``values`` (a map of JSON texts); the record's own column of that name comes first.
    """
    answers = s.answers_map(F.col(values), [])
    cols = [s.first_present(F.col(k) if k in df.columns else F.lit(None).cast("string"), answers, k).alias(name) for name, k in top.items()]
    return s.rename(df.select(*[c for c in df.columns if c != values and c not in top.values()], *cols, s.answers_map(F.col(values), metadata).alias("answers")), s.snake_case)


def survey_definition(df: DataFrame, raw: str, simple: list[str], nested: list[str]) -> DataFrame:
    """Simple fields as text and nested blocks as JSON text."""
    return df.select(*(F.get_json_object(raw, f"$.{c}").alias(s.snake_case(c)) for c in [*simple, *nested]))


def events_with_custom_props(df: DataFrame, props: str, known: dict[str, str]) -> DataFrame:
    """Known properties as typed columns, the rest in ``custom_properties``."""
    have, rest = s.split_known_keys(F.col(props), list(known))
    return df.withColumns({"__k": have, "custom_properties": rest}).withColumns({s.snake_case(k.lstrip("$")): F.try_element_at("__k", F.lit(k)).try_cast(t) for k, t in known.items()}).drop("__k", props)


def crm_record(df: DataFrame, raw: str, properties: dict[str, str], associations: list[str]) -> DataFrame:
    """``id``, times, a typed ``properties`` struct (empty text is null) and an array of ids for each association."""
    j = lambda p: F.get_json_object(raw, "$." + p)
    props = F.struct(*(F.nullif(j(f"properties.{k}"), F.lit("")).try_cast(t).alias(k) for k, t in properties.items()))
    return df.select(j("id").alias("id"), j("createdAt").try_cast("timestamp").alias("created_at"), j("updatedAt").try_cast("timestamp").alias("updated_at"), F.coalesce(j("archived").try_cast("boolean"), F.lit(False)).alias("archived"), props.alias("properties"), *(s.association_ids(j(f"associations.{a}")).alias(f"{a}_ids") for a in associations))


def sheet_table(df: DataFrame, cells: str, position: str, raw: bool = False) -> DataFrame:
    """A grid of rows (array of text, zero-based ``position``): the first row gives the column names, short rows are padded with ''.

    Names are made safe, repeated ones numbered. ``raw`` keeps the arrays. The header row is the only thing collected.
    """
    if raw:
        return df.select((F.col(position) + 1).alias("row_number"), cells)
    first = df.where(F.col(position) == 0).select(cells).first()
    names: list[str] = []
    for i, c in enumerate(first[0] if first else []):
        base, n = s.safe_column_name(c, i), 1
        name = base
        while name in names:
            n += 1
            name = f"{base}_{n}"
        names.append(name)
    columns = [F.coalesce(F.get(cells, F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)]
    return df.where(F.col(position) > 0).select(*columns, (F.col(position) + 1).alias("row_number"))


def work_item_revisions(df: DataFrame, raw: str, base_url: str) -> DataFrame:
    """Id, revision, hoisted fields with dots in their names, the field block as JSON, and an address."""
    out = s.hoist(df, raw, {"id": "id", "rev": "rev", "revised_date": "$.fields['System.RevisedDate']", "state": "$.fields['System.State']", "fields_json": "fields"})
    return out.withColumn("url", s.build_url(base_url, "workItems", F.col("id"), "revisions", F.col("rev"))).withColumn("rev", F.col("rev").try_cast("int")).drop(raw)


def taxonomy_flatten(df: DataFrame, raw: str) -> DataFrame:
    """Event types with their category's name lifted and a missing list of properties empty."""
    j = lambda p: F.get_json_object(raw, "$." + p)
    return df.select(j("event_type").alias("event_type"), j("category.name").alias("category_name"), F.coalesce(F.from_json(j("properties"), "array<string>"), F.array().cast("array<string>")).alias("properties"))


def custom_values_to_text(df: DataFrame, values: str) -> DataFrame:
    """``array<struct<id, value>>`` with values of any type as JSON text, text as it is."""
    element = df.schema[values].dataType.elementType
    kind = element["value"].dataType
    return df.withColumn(values, F.transform(values, lambda x: x.withField("value", s.json_text(x["value"], kind))))


def governance_records(df: DataFrame, raw: str, refs: list[str], value: str, org: str) -> DataFrame:
    """References as fixed structs, a value of any type as text, the organisation stamped."""
    j = lambda p: F.get_json_object(raw, "$." + p)
    return df.select(j("id").alias("id"), *(s.resource_ref(j(r)).alias(s.snake_case(r)) for r in refs), j(value).alias(s.snake_case(value)), F.lit(org).alias("organisation"))


def odata_clean(df: DataFrame) -> DataFrame:
    """Date texts made ISO, control fields dropped, nested structs and arrays of them alike."""

    def clean(c: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StringType):
            return s.sap_date(c)
        if isinstance(kind, T.ArrayType):
            return F.transform(c, lambda x: clean(x, kind.elementType))
        if isinstance(kind, T.StructType):
            kept = [f for f in kind if not f.name.startswith("__") and "@" not in f.name]
            return F.when(c.isNotNull(), F.struct(*(clean(c.getField(f.name), f.dataType).alias(f.name) for f in kept)))
        return c

    return df.select(*(clean(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema if not f.name.startswith("__") and "@" not in f.name))


def report_rows(df: DataFrame, dimension_headers: list[str], metric_headers: dict[str, str], dimensions: str, metrics: str) -> DataFrame:
    """Report rows with positional values to named columns; ``date`` of eight digits becomes a date, metrics are typed."""
    dims = [F.get(dimensions, F.lit(i)).alias(n) if n != "date" else s.yyyymmdd(F.get(dimensions, F.lit(i))).alias(n) for i, n in enumerate(dimension_headers)]
    mets = [s.typed_metric(F.get(metrics, F.lit(i)), t).alias(n) for i, (n, t) in enumerate(metric_headers.items())]
    return df.select(*[c for c in df.columns if c not in (dimensions, metrics)], *dims, *mets)
