from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.operators import cdc
from tidewright.operators.relational import union_sources
from tidewright.queries._tables import Registry, load
from tidewright.queries.cdc import _SCD2
from tidewright.sources import files as f
from tidewright.streaming import merges as m

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles


@R.query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_shipdate >= '1996-01-01' AND l_returnflag = 'R'")
def scan_table(spark, d):
    return f.scan_table(spark, f"{d}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity"], (F.col("l_shipdate") >= "1996-01-01") & (F.col("l_returnflag") == "R"))


@R.query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1")
def scan_partitioned(spark, d):
    return f.scan_partitioned(load(spark, d, "orders"), "o_custkey", 8).groupBy("o_custkey").agg(F.count("*").alias("n"))


@R.query("SELECT event_id, ts FROM events WHERE event_type = 'error'")
def scan_deletes(spark, d):
    return f.scan_deletes(load(spark, d, "events"), F.col("event_type") == "error", ["event_id"], "ts")


_EVENT = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType())])
_E = "SELECT event_id, user_id, value FROM events"


@R.query(_E)
def read_ndjson(spark, d):
    path = f.scratch(spark, "ndjson")
    load(spark, d, "events").select(*_EVENT.names).write.option("compression", "gzip").json(path)
    return f.read_ndjson(spark, path, _EVENT)


@R.query(f"{_E} WHERE event_id % 10 <> 0")
def read_ndjson_permissive(spark, d):
    path = f.scratch(spark, "ndjson")
    line = F.to_json(F.struct(*_EVENT.names))
    load(spark, d, "events").select(F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("{broken "), line)).otherwise(line).alias("value")).write.text(path)
    return f.split_corrupt(f.read_ndjson(spark, path, _EVENT, strict=False))[0]


@R.query(_E)
def read_json_array(spark, d):
    path = f.scratch(spark, "arrays")
    e = load(spark, d, "events")
    rows = e.groupBy((F.col("event_id") % max(20, e.count() // 20_000)).alias("g")).agg(F.collect_list(F.struct(*_EVENT.names)).alias("events"))
    rows.select("g", F.to_json(F.struct("events")).alias("value")).repartition("g").write.partitionBy("g").text(path)
    return f.read_json_array(spark, f"{path}/*", _EVENT, "events")


@R.query("SELECT s_suppkey::VARCHAR AS supp_key, CASE WHEN s_suppkey % 3 <> 0 THEN s_name END AS supplier_name FROM supplier")
def read_csv_report(spark, d):
    path = f.scratch(spark, "csv")
    s = load(spark, d, "supplier").select(F.col("s_suppkey").alias("﻿Supp Key"), F.when(F.col("s_suppkey") % 3 != 0, F.col("s_name")).alias("Supplier Name"))
    s.write.option("header", True).option("nullValue", "").csv(path)
    return f.read_csv_report(spark, path, ["﻿Supp Key", "Supplier Name"])


@R.query("SELECT 'MSH|^~\\&|' || n_name AS value FROM nation")
def read_message_files(spark, d):
    path = f.scratch(spark, "messages")
    load(spark, d, "nation").select("n_nationkey", F.concat(F.lit("MSH|^~\\&|"), "n_name").alias("value")).repartition("n_nationkey").write.partitionBy("n_nationkey").text(path)
    return f.read_message_files(spark, path, "part-*", recursive=True, since="2000-01-01").select(F.regexp_replace("value", "\\n$", "").alias("value"))


@R.query("SELECT n_nationkey, n_name FROM nation")
def explode_envelope(spark, d):
    n = load(spark, d, "nation")
    rows = n.groupBy("n_regionkey").agg(F.collect_list(F.struct("n_nationkey", "n_name")).alias("r"))
    raw = F.when(F.col("n_regionkey") == 0, F.to_json("r")).when(F.col("n_regionkey") == 1, F.to_json(F.struct(F.col("r").alias("items")))).otherwise(F.to_json(F.struct(F.col("r").alias("value"))))
    return f.explode_envelope(rows.select(raw.alias("raw")), "raw", T.StructType([T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType())]))


@R.query(_E)
def write_append(spark, d):
    path, e = f.scratch(spark, "append"), load(spark, d, "events").select(*_EVENT.names)
    f.write_append(e.where("event_id % 2 = 0"), path)
    f.write_append(e.where("event_id % 2 = 1"), path)
    return spark.read.schema(e.schema).parquet(path)


@R.query("SELECT l_orderkey, l_partkey, l_shipdate FROM lineitem")
def write_clustered(spark, d):
    path, li = f.scratch(spark, "clustered"), load(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    f.write_clustered(li, path, ["l_shipdate"], 4)
    return spark.read.schema(li.schema).parquet(path)


def _landed(spark, d, columns=("event_id", "user_id", "ts", "event_type", "value"), files=3):
    """Events as a folder of a few files, as a feed would land them."""
    path = f.scratch(spark, "landed")
    e = load(spark, d, "events").select(*columns)
    e.repartition(files, "user_id").write.parquet(path)
    return path, e.schema


def _stream(spark, d, **how):
    path, schema = _landed(spark, d)
    return m.stream_table(spark, path, schema, 1, **how)


_LATEST = "SELECT event_id, user_id, ts, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1"


@R.query("SELECT count(*) AS n, sum(l_orderkey)::BIGINT AS keys, max(l_partkey) AS last FROM lineitem WHERE l_partkey BETWEEN 20 AND 40 AND l_shipdate >= '1995-01-01'")
def write_interleaved(spark, d):
    path, li = f.scratch(spark, "interleaved"), load(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate", "l_returnflag")
    f.write_interleaved(li, path, ["l_shipdate", "l_partkey", "l_returnflag"], 8)
    kept = spark.read.parquet(path).where(F.col("l_partkey").between(20, 40) & (F.col("l_shipdate") >= "1995-01-01"))
    return kept.agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"), F.max("l_partkey").alias("last"))


@R.query(_LATEST)
def stream_scd1(spark, d):
    return m.stream_scd1(_stream(spark, d), f.scratch(spark, "scd1"), ["user_id"], "ts")


@R.query(f"SELECT user_id, ts, event_type, value, valid_from, valid_to, is_current FROM ({_SCD2})")
def stream_scd2(spark, d):
    return m.stream_scd2(_stream(spark, d).drop("event_id"), f.scratch(spark, "scd2"), ["user_id"], "ts")


@R.query("SELECT event_id, user_id, ts, event_type, value FROM events")
def stream_append(spark, d):
    return m.stream_append(_stream(spark, d), f.scratch(spark, "appended"))


@R.query(f"SELECT user_id, ts, value FROM ({_LATEST}) WHERE event_type <> 'error'")
def stream_deletes(spark, d):
    s = _stream(spark, d)
    up, gone = s.where("event_type <> 'error'").select("user_id", "ts", "value"), _stream(spark, d).where("event_type = 'error'").select("user_id", "ts")
    return m.stream_deletes(up, gone, f.scratch(spark, "deletes"), ["user_id"], "ts").drop("is_delete")


@R.query("SELECT event_id, user_id, ts FROM events")
def stream_dedup_overlaps(spark, d):
    path, schema = _landed(spark, d, ("event_id", "user_id", "ts"))
    spark.read.schema(schema).parquet(path).where("event_id % 2 = 0").coalesce(1).write.mode("append").parquet(path)
    s = m.dedup_overlaps(m.stream_table(spark, path, schema, 10, event_time="ts"), ["event_id"], "ts", "40 days")
    return m.stream_append(s, f.scratch(spark, "dedup")).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@R.query("""SELECT date_trunc('day', ts)::TIMESTAMP AS start, date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY AS "end", event_type, count(*) AS n, round(sum(value), 4) AS total, round(avg(value), 6) AS average FROM events GROUP BY 1, 2, 3""")
def stream_windows(spark, d):
    w = m.window_counts(_stream(spark, d, event_time="ts"), "ts", "1 day", by=("event_type",))
    out = m.collect_complete(w, f.scratch(spark, "windows"))
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "event_type", "n", F.round("total", 4).alias("total"), F.round("average", 6).alias("average"))


@R.query("""SELECT start, start + INTERVAL 1 DAY AS "end", count(*) AS n FROM (SELECT ts, unnest([time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') - INTERVAL 6 HOUR * k FOR k IN range(4)]) AS start FROM events) GROUP BY 1, 2""")
def stream_sliding_windows(spark, d):
    w = m.window_counts(_stream(spark, d, event_time="ts"), "ts", "1 day", "6 hours")
    out = m.collect_complete(w, f.scratch(spark, "sliding"))
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")


@R.query("""WITH x AS (SELECT user_id, ts, coalesce((epoch_us(ts) - epoch_us(lag(ts) OVER w) >= 1800000000)::INT, 1) AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
 k AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM x), s AS (SELECT user_id, min(ts) AS start, max(ts) AS last, count(*) AS events FROM k GROUP BY user_id, session)
 SELECT user_id, start, last, events FROM s WHERE last + INTERVAL 30 MINUTE <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM events)""")
def stream_sessions(spark, d):
    path, schema = _landed(spark, d)
    s = m.session_counts(m.stream_table(spark, path, schema, 100, event_time="ts"), "user_id", "ts", "30 minutes", "1 hour")
    out = m.stream_append(s, f.scratch(spark, "sessions"))
    return out.withColumns({"start": F.col("start").cast("timestamp_ntz"), "last": F.col("last").cast("timestamp_ntz")})


@R.query(_LATEST)
def replay_history(spark, d):
    e = load(spark, d, "events").select("event_id", "user_id", "ts", "event_type", "value")
    rows = m.replay_windows(e, "ts", ["2023-12-31", "2024-01-10", "2024-01-20", "2024-02-28"], f.scratch(spark, "replay"))
    return cdc.scd1(rows, ["user_id"], "ts")


@R.query("""SELECT 'events' AS name, user_id AS k, max(ts) AS at, NULL::TIMESTAMP AS until FROM events GROUP BY user_id UNION ALL SELECT 'versions', user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) FROM events
 UNION ALL SELECT 'rows', event_id, ts, NULL FROM events UNION ALL SELECT 'nation', n_nationkey, NULL, NULL FROM nation""")
def ingest(spark, d):
    path, _ = _landed(spark, d)
    tables = [
        m.Table("events", path, ["user_id"], "ts", cluster_by=["ts"]),
        m.Table("versions", path, ["user_id"], "ts", scd_type="SCD_TYPE_2"),
        m.Table("rows", path, scd_type="APPEND_ONLY"),
        m.Table("nation", f"{d}/nation.parquet", ["n_nationkey"], ingestion_type="snapshot"),
    ]
    made = m.ingest(spark, tables, f.scratch(spark, "ingest"))
    none = F.lit(None).cast("timestamp_ntz")
    columns = {"events": ("user_id", F.col("ts"), none), "versions": ("user_id", F.col("ts"), F.col("valid_to")), "rows": ("event_id", F.col("ts"), none), "nation": ("n_nationkey", none, none)}
    return union_sources({n: made[n].select(F.col(k).cast("long").alias("k"), at.alias("at"), until.alias("until")) for n, (k, at, until) in columns.items()}, "name")


@R.query("""WITH a AS (SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 7 <> 0), b AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 3 <> 0)
 SELECT a.c_custkey, a.c_acctbal, 1 AS valid_from, CASE WHEN b.c_custkey IS NULL OR a.c_custkey % 5 = 0 THEN 2 END AS valid_to, b.c_custkey IS NOT NULL AND a.c_custkey % 5 <> 0 AS is_current FROM a LEFT JOIN b ON a.c_custkey = b.c_custkey
 UNION ALL SELECT b.c_custkey, b.c_acctbal, 2, NULL, true FROM b LEFT JOIN a ON a.c_custkey = b.c_custkey WHERE a.c_custkey IS NULL OR b.c_custkey % 5 = 0""")
def ingest_snapshot_history(spark, d):
    path, target, c = f.scratch(spark, "snapshots"), f.scratch(spark, "history"), load(spark, d, "customer").select("c_custkey", "c_acctbal")
    t = m.Table("customer", path, ["c_custkey"], ingestion_type="snapshot", scd_type="SCD_TYPE_2")
    c.where("c_custkey % 7 <> 0").write.parquet(path)
    m.ingest(spark, [t], target)
    later = c.where("c_custkey % 3 <> 0").withColumn("c_acctbal", F.when(F.col("c_custkey") % 5 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    later.write.mode("overwrite").parquet(path)
    return m.ingest(spark, [t], target)["customer"]


@R.query(_LATEST)
def ingest_scd1_rows(spark, d):
    path, _ = _landed(spark, d)
    return m.ingest(spark, [m.Table("events", path, ["user_id"], "ts", cluster_by=["ts"])], f.scratch(spark, "ingest"))["events"]
