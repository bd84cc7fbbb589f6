from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions import conform as conforming
from tidewright.functions import scalars as s
from tidewright.functions.conform import conform, conform_strict
from tidewright.operators.cdc import content_hash
from tidewright.queries._tables import Registry, load

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles

_WANT = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("ts", T.TimestampType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("whole", T.IntegerType()),
    T.StructField("flag", T.BooleanType()),
    T.StructField("day", T.DateType()),
    T.StructField("props", T.StructType([T.StructField("k", T.LongType()), T.StructField("missing", T.StringType())])),
    T.StructField("tags", T.ArrayType(T.StringType())),
])


def _rendered(spark, d):
    e, ts = load(spark, d, "events"), F.col("ts").cast("timestamp")
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"),
        F.col("value").cast("string").alias("value"),
        F.concat(F.col("event_id").cast("string"), F.lit(".7")).alias("whole"),
        F.when(F.col("event_id") % 2 == 0, "Yes").otherwise("n").alias("flag"),
        F.when(F.col("event_id") % 3 == 0, F.date_format(ts, "MM/dd/yyyy")).otherwise(F.date_format(ts, "yyyy-MM-dd")).alias("day"),
        "props",
        F.col("event_type").alias("tags"),
    )


_FLAT = "SELECT event_id, ts, value, event_id::INTEGER AS whole, event_id % 2 = 0 AS flag, ts::DATE AS day, (props->>'k')::BIGINT AS k, event_type AS tag FROM events"


def _flat(df):
    return df.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "value", "whole", "flag", "day", "props.k", F.col("tags")[0].alias("tag"))


@R.query(_FLAT)
def conform_types(spark, d):
    return _flat(conform(_rendered(spark, d), _WANT))


@R.query(f"{_FLAT} WHERE event_id % 5 <> 0")
def conform_strict_good(spark, d):
    raw = _rendered(spark, d).withColumn("value", F.when(F.col("event_id") % 5 == 0, "abc").otherwise(F.col("value")))
    return _flat(conform_strict(raw, _WANT)[0])


@R.query("SELECT event_id::VARCHAR AS event_id, 'value: not a double' AS reason FROM events WHERE event_id % 5 = 0")
def conform_strict_bad(spark, d):
    raw = _rendered(spark, d).withColumn("value", F.when(F.col("event_id") % 5 == 0, "abc").otherwise(F.col("value")))
    return conform_strict(raw, _WANT)[1].select("event_id", F.array_join("reasons", "; ").alias("reason"))


@R.query("SELECT n_nationkey AS nation_key, n_name AS http_name, n_regionkey AS inner_region_key FROM nation")
def snake_case_columns(spark, d):
    n = load(spark, d, "nation").select(F.col("n_nationkey").alias("nationKey"), F.col("n_name").alias("HTTPName"), F.struct(F.col("n_regionkey").alias("innerRegionKey")).alias("nestedPart"))
    return s.rename(n, s.snake_case).select("nation_key", "http_name", "nested_part.inner_region_key")


@R.query('SELECT s_suppkey AS "Supp_Key", s_name AS "_col1" FROM supplier')
def safe_column_names(spark, d):
    raw = load(spark, d, "supplier").select("s_suppkey", "s_name")
    return raw.toDF(*(s.safe_column_name(x, i) for i, x in enumerate(["Supp / Key!", " "])))


@R.query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS c_name FROM customer")
def empty_to_null(spark, d):
    c = load(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise("").alias("c_name"))
    return s.empty_to_null(c, "c_name")


@R.query("SELECT c_custkey, c_custkey % 3 <> 0 AS present FROM customer")
def empty_struct_to_null(spark, d):
    c = load(spark, d, "customer").withColumn("x", F.struct(F.struct(F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("a")).alias("b"), F.lit(None).cast("int").alias("c")))
    return c.withColumn("x", s.all_null_struct_to_null(F.col("x"), c.schema["x"].dataType)).select("c_custkey", F.col("x").isNotNull().alias("present"))


@R.query("""SELECT n_nationkey, '{"name":"' || n_name || '","region":' || n_regionkey || '}' AS nested, n_name AS plain, n_regionkey::VARCHAR AS number FROM nation""")
def json_text(spark, d):
    n = load(spark, d, "nation").withColumn("x", F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")))
    kind = lambda c: n.schema[c].dataType
    return n.select("n_nationkey", s.json_text(F.col("x"), kind("x")).alias("nested"), s.json_text(F.col("n_name"), kind("n_name")).alias("plain"), s.json_text(F.col("n_regionkey"), kind("n_regionkey")).alias("number"))


@R.query("SELECT event_id, props->>'k' AS k, NULL::VARCHAR AS missing FROM events")
def nested_path(spark, d):
    return load(spark, d, "events").select("event_id", s.nested_path(F.col("props"), "k").alias("k"), s.nested_path(F.col("props"), "a.b").alias("missing"))


@R.query("SELECT event_id, date_trunc('millisecond', ts) AS ms, date_trunc('second', ts) AS s FROM events")
def epoch_times(spark, d):
    e = load(spark, d, "events").withColumn("t", F.col("ts").cast("timestamp"))
    return e.select("event_id", s.epoch_ms_to_ts(F.unix_millis("t").cast("string")).cast("timestamp_ntz").alias("ms"), s.epoch_s_to_ts(F.unix_seconds("t").cast("string")).cast("timestamp_ntz").alias("s"))


@R.query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN strftime(date_trunc('millisecond', ts), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' ELSE 'plain' END AS at FROM events")
def sap_date(spark, d):
    e = load(spark, d, "events").withColumn("t", F.col("ts").cast("timestamp"))
    raw = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("/Date("), F.unix_millis("t").cast("string"), F.lit("+0060)/"))).otherwise("plain")
    return e.select("event_id", s.sap_date(raw).alias("at"))


@R.query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate::DATE END AS day FROM orders")
def yyyymmdd(spark, d):
    raw = F.when(F.col("o_orderkey") % 4 != 0, F.date_format("o_orderdate", "yyyyMMdd")).otherwise("2024-1")
    return load(spark, d, "orders").select("o_orderkey", s.yyyymmdd(raw).alias("day"))


@R.query("SELECT event_id, CASE WHEN event_id % 3 = 1 THEN ts ELSE date_trunc('second', ts) END AS at FROM events")
def parse_ts_multi(spark, d):
    t = F.col("ts").cast("timestamp")
    raw = F.when(F.col("event_id") % 3 == 0, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(F.col("event_id") % 3 == 1, F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSSSSS")).otherwise(F.date_format(t, "yyyy/MM/dd HH:mm:ss"))
    return load(spark, d, "events").select("event_id", s.parse_ts_multi(raw).cast("timestamp_ntz").alias("at"))


@R.query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN ts WHEN 1 THEN ts - INTERVAL 10 MINUTE WHEN 2 THEN ts - INTERVAL 2 DAY ELSE ts END AS at FROM events")
def relative_time(spark, d):
    raw = F.when(F.col("event_id") % 4 == 0, "*").when(F.col("event_id") % 4 == 1, "*-10m").when(F.col("event_id") % 4 == 2, "*-2d").otherwise("soon")
    return load(spark, d, "events").select("event_id", s.relative_time(raw, F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("at"))


@R.query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') WHEN o_orderkey % 3 = 1 THEN strftime(date_trunc('month', o_orderdate), '%Y-%m-%dT00:00:00Z') ELSE strftime(o_orderdate + INTERVAL 10 HOUR, '%Y-%m-%dT%H:%M:%SZ') END AS at FROM orders")
def hl7_ts(spark, d):
    o = F.col("o_orderdate")
    raw = F.when(F.col("o_orderkey") % 3 == 0, F.date_format(o, "yyyyMMdd")).when(F.col("o_orderkey") % 3 == 1, F.date_format(o, "yyyyMM")).otherwise(F.concat(F.date_format(o, "yyyyMMdd"), F.lit("123000+0230")))
    return load(spark, d, "orders").select("o_orderkey", s.hl7_ts(raw).alias("at"))


@R.query("SELECT p_partkey, p_size::BIGINT AS size, CASE WHEN p_partkey % 3 <> 0 THEN p_retailprice END AS price FROM part")
def coerce_numbers(spark, d):
    p = load(spark, d, "part")
    price = F.when(F.col("p_partkey") % 3 != 0, F.col("p_retailprice").cast("string")).otherwise("n/a")
    return p.select("p_partkey", s.coerce(F.col("p_size").cast("string"), "bigint").alias("size"), s.coerce(price, "double").alias("price"))


@R.query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN false ELSE true END AS flag FROM events")
def lenient_bool(spark, d):
    raw = F.when(F.col("event_id") % 4 == 0, "YES").when(F.col("event_id") % 4 == 1, "0").when(F.col("event_id") % 4 == 2, "maybe")
    return load(spark, d, "events").select("event_id", s.lenient_bool(raw, True).alias("flag"))


@R.query("SELECT n_nationkey, n_name AS item FROM nation")
def string_list(spark, d):
    n = load(spark, d, "nation")
    return n.select("n_nationkey", F.explode(s.string_list(F.col("n_name"), T.StringType())).alias("item"))


@R.query("SELECT event_id, event_type AS known, value::VARCHAR AS custom FROM events")
def split_known_keys(spark, d):
    e = load(spark, d, "events").withColumn("m", F.create_map(F.lit("type"), "event_type", F.lit("score"), F.col("value").cast("string")))
    known, rest = s.split_known_keys(F.col("m"), ["type"])
    return e.select("event_id", known["type"].alias("known"), rest["score"].alias("custom"))


@R.query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'q' || event_id END AS answer FROM events")
def first_present(spark, d):
    entry = F.struct(F.concat(F.lit("q"), F.col("event_id")).alias("textEntry"))
    e = load(spark, d, "events").withColumn("values", F.create_map(F.lit("recordedDate"), entry))
    return e.select("event_id", s.first_present(F.when(F.col("event_id") % 2 == 0, F.col("event_type")), F.col("values"), "recordedDate").alias("answer"))


@R.query("""SELECT event_id, 'QID1' AS q, event_type AS text_entry, NULL::VARCHAR AS choice FROM events UNION ALL SELECT event_id, 'QID2', NULL, value::VARCHAR FROM events""")
def answers_map(spark, d):
    obj = F.concat(F.lit('{"choiceText":"'), F.col("value").cast("string"), F.lit('"}'))
    m = F.create_map(F.lit("startDate"), F.lit('"x"'), F.lit("QID1"), F.concat(F.lit('"'), F.col("event_type"), F.lit('"')), F.lit("QID2"), obj)
    e = load(spark, d, "events").select("event_id", F.explode(s.answers_map(m, ["startDate"])).alias("q", "a"))
    return e.select("event_id", "q", F.col("a.textEntry").alias("text_entry"), F.col("a.choiceText").alias("choice"))


@R.query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_regionkey::VARCHAR END AS id, CASE WHEN n_nationkey % 2 = 0 THEN n_name END AS name FROM nation")
def resource_ref(spark, d):
    raw = F.when(F.col("n_nationkey") % 2 == 0, F.to_json(F.struct(F.col("n_regionkey").cast("string").alias("id"), F.col("n_name").alias("name")))).otherwise("{}")
    return load(spark, d, "nation").select("n_nationkey", s.resource_ref(raw).alias("r")).select("n_nationkey", "r.id", "r.name")


@R.query("SELECT o_custkey, count(*)::INTEGER AS n, sum(o_orderkey)::BIGINT AS total FROM orders GROUP BY 1")
def association_ids(spark, d):
    o = load(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct(F.col("o_orderkey").cast("string").alias("id"))).alias("results"))
    raw = F.when(F.col("o_custkey") % 2 == 0, F.to_json(F.struct("results"))).otherwise(F.to_json("results"))
    ids = o.select("o_custkey", s.association_ids(raw).alias("ids"))
    return ids.select("o_custkey", F.size("ids").alias("n"), F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint")).alias("total"))


@R.query("SELECT ts::DATE AS date, event_type AS segment, count(*) AS value FROM events GROUP BY 1, 2")
def zip_series(spark, d):
    per = load(spark, d, "events").groupBy(F.to_date("ts").alias("date"), "event_type").agg(F.count("*").alias("n"))
    typed = per.groupBy("event_type").agg(F.sort_array(F.collect_list(F.struct("date", "n"))).alias("p"))
    one = typed.agg(F.sort_array(F.collect_list(F.struct("event_type", "p"))).alias("all"))  # days times types
    raw = one.select(F.expr("all[0].p.date").alias("dates"), F.expr("transform(all, x -> x.p.n)").alias("series"), F.expr("all.event_type").alias("labels"))
    return s.zip_series(raw, "dates", "series", "labels")


@R.query("SELECT o_orderkey, o_totalprice AS price, o_custkey AS cust, NULL::VARCHAR AS absent FROM orders")
def values_by_header(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", F.array(F.lit("cust"), F.lit("price")).alias("h"), F.array(F.col("o_custkey").cast("string"), F.col("o_totalprice").cast("string")).alias("v"))
    return s.values_by_header(o, "h", "v", {"price": "double", "cust": "int", "absent": "string"})


@R.query("SELECT event_id, (props->>'k')::BIGINT AS k, NULL::BIGINT AS wrong FROM events")
def project_to_schema(spark, d):
    shape = T.StructType([T.StructField("k", T.LongType()), T.StructField("wrong", T.StructType([T.StructField("x", T.LongType())]))])
    made = conforming.project_to_schema(F.col("props"), shape)
    return load(spark, d, "events").select("event_id", made["k"].alias("k"), made["wrong"]["x"].alias("wrong"))


@R.query("SELECT event_id, props->>'k' AS k, 'https://host/items/' || event_id AS url FROM events")
def hoist_and_url(spark, d):
    return s.hoist(load(spark, d, "events"), "props", {"k": "k"}).select("event_id", "k", s.build_url("https://host", "items", F.col("event_id")).alias("url"))


@R.query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'b' || o_custkey END AS code FROM orders")
def first_coding(spark, d):
    codes = F.array(F.struct(F.lit("x").alias("system"), F.lit("a").alias("code")), F.struct(F.when(F.col("o_orderkey") % 2 == 0, "y").otherwise("z").alias("system"), F.concat(F.lit("b"), F.col("o_custkey")).alias("code")))
    return load(spark, d, "orders").select("o_orderkey", s.first_match(codes, lambda x: x["system"] == "y", lambda x: x["code"]).alias("code"))


@R.query("SELECT doc_id, left(text, 100) AS preview FROM documents")
def left_text(spark, d):
    return load(spark, d, "documents").select("doc_id", s.left_text(F.col("text"), 100).alias("preview"))


@R.query("""SELECT n_nationkey, sha256('{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}') AS h, '["' || n_nationkey || '","' || n_name || '"]' AS key FROM nation""")
def content_hash_and_key(spark, d):
    n = load(spark, d, "nation").select("n_nationkey", "n_name")
    return n.select("n_nationkey", content_hash(n).alias("h"), s.row_key("n_nationkey", "n_name").alias("key"))


@R.query("SELECT p_partkey, p_size::BIGINT AS n, p_retailprice AS x, p_name AS t, NULL::BIGINT AS bad FROM part")
def typed_metric(spark, d):
    p = load(spark, d, "part")
    return p.select("p_partkey", s.typed_metric(F.col("p_size").cast("string"), "int").alias("n"), s.typed_metric(F.col("p_retailprice").cast("string"), "double").alias("x"), s.typed_metric(F.col("p_name"), "string").alias("t"), s.typed_metric(F.col("p_name"), "int").alias("bad"))
