"""Queries over what grows: folded logs, running sums over any cursor, keys that hold most rows, deep hierarchies, split message files."""

from pyspark.sql import functions as F

from tidewright.operators import cdc, cursors, reports, timeseries
from tidewright.operators import relational as r
from tidewright.plans import messages
from tidewright.queries._tables import Registry, load
from tidewright.queries.sources import _LATEST
from tidewright.sources import files as f
from tidewright.streaming import merges as m

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles


def _many_batches(spark, d, files=20):
    path, e = f.scratch(spark, "landed"), load(spark, d, "events").select("event_id", "user_id", "ts", "event_type", "value")
    e.repartition(files, "event_id").write.parquet(path)
    return m.stream_table(spark, path, e.schema, 1)


@R.query(_LATEST)
def stream_scd1_folded(spark, d):
    return m.stream_scd1(_many_batches(spark, d), f.scratch(spark, "folded"), ["user_id"], "ts")


@R.query("SELECT user_id, ts, event_type, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to FROM events")
def stream_scd2_folded(spark, d):
    return m.stream_scd2(_many_batches(spark, d), f.scratch(spark, "folded"), ["user_id"], "ts").select("user_id", "ts", "event_type", "valid_to")


@R.query("SELECT c_custkey, c_acctbal + 1 AS c_acctbal FROM customer WHERE c_custkey % 3 <> 0")
def ingest_snapshot_rows(spark, d):
    path, target, c = f.scratch(spark, "snapshots"), f.scratch(spark, "state"), load(spark, d, "customer").select("c_custkey", "c_acctbal")
    t = m.Table("customer", path, ["c_custkey"], ingestion_type="snapshot")
    for rows in (c.where("c_custkey % 7 <> 0"), c.where("c_custkey % 3 <> 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)):
        rows.unionByName(rows).write.mode("overwrite").parquet(path)  # keys come twice
        out = m.ingest(spark, [t], target)["customer"]
    load(spark, d, "customer").select("c_custkey", "c_acctbal").limit(0).write.mode("overwrite").parquet(path)  # the stored table stays
    return out


@R.query("SELECT c_custkey, c_acctbal, 2 AS valid_from, CASE WHEN c_custkey % 2 = 0 THEN 3 END AS valid_to, c_custkey % 2 <> 0 AS is_current FROM customer")
def ingest_empty_first_snapshot(spark, d):
    path, target, c = f.scratch(spark, "snapshots"), f.scratch(spark, "history"), load(spark, d, "customer").select("c_custkey", "c_acctbal")
    t = m.Table("customer", path, ["c_custkey"], ingestion_type="snapshot", scd_type="SCD_TYPE_2")
    for rows in (c.limit(0), c, c.where("c_custkey % 2 <> 0")):
        rows.write.mode("overwrite").parquet(path)
        out = m.ingest(spark, [t], target)["customer"]
    return out


@R.query("SELECT CASE WHEN n_nationkey > 0 THEN n_nationkey END AS k, n_name AS name FROM nation")
def full_refresh_null_keys(spark, d):
    n = load(spark, d, "nation").select(F.when(F.col("n_nationkey") > 0, F.col("n_nationkey")).alias("k"), F.col("n_name").alias("name"))
    return cdc.full_refresh_upsert(n.withColumn("name", F.lit("old")), n, ["k"])


_USERS = "SELECT *, CASE WHEN event_id % 5 <> 0 THEN user_id END AS u FROM events"


@R.query(f"""WITH x AS ({_USERS}), y AS (SELECT *, CASE WHEN u IS NOT NULL THEN coalesce((epoch_us(ts) - epoch_us(lag(ts) OVER w) > 1800000000)::INT, 1) END AS first, CASE WHEN u IS NOT NULL THEN min(ts) OVER (PARTITION BY u)::DATE END AS day FROM x WINDOW w AS (PARTITION BY u ORDER BY ts, event_id)),
 k AS (SELECT *, CASE WHEN u IS NOT NULL THEN sum(first) OVER (PARTITION BY u ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) END AS s FROM y),
 z AS (SELECT *, (max(epoch_us(ts)) OVER p - min(epoch_us(ts)) OVER p) / 1e6 >= 10 OR count(*) OVER p >= 2 AS engaged FROM k WINDOW p AS (PARTITION BY u, s))
 SELECT ts::DATE AS date, count(*) AS "eventCount", count(DISTINCT u) AS "activeUsers", count(DISTINCT u) FILTER (ts::DATE = day) AS "newUsers", count(DISTINCT (u, s)) FILTER (u IS NOT NULL) AS sessions,
 count(DISTINCT (u, s)) FILTER (u IS NOT NULL AND engaged) AS "engagedSessions" FROM z GROUP BY 1""")
def report_with_null_users(spark, d):
    e = load(spark, d, "events").withColumn("user_id", F.when(F.col("event_id") % 5 != 0, F.col("user_id")))
    return reports.report(e, ["date"], ["eventCount", "activeUsers", "newUsers", "sessions", "engagedSessions"], ordered=False)


@R.query("SELECT o_orderkey, o_comment_key FROM (SELECT o_orderkey, lpad((o_orderkey % 997)::VARCHAR, 5, '0') AS o_comment_key FROM orders) QUALIFY rank() OVER (ORDER BY o_comment_key) <= 500")
def cursor_soft_cap_text(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", F.lpad((F.col("o_orderkey") % 997).cast("string"), 5, "0").alias("o_comment_key"))
    return cursors.soft_cap(o, "o_comment_key", 500)


@R.query("SELECT c_custkey, ntile(11) OVER (ORDER BY c_name)::INTEGER AS bin FROM customer")
def contiguous_bins_text(spark, d):
    return r.contiguous_bins(load(spark, d, "customer").select("c_custkey", "c_name"), "c_name", 11).drop("c_name")


@R.query("SELECT event_id, ts, lag(ts) OVER (ORDER BY ts, event_id) AS valid_from_before, lead(ts) OVER (ORDER BY ts, event_id) AS valid_to FROM events")
def hot_key_neighbours(spark, d):
    from tidewright.operators.scans import with_neighbours

    e = load(spark, d, "events").select("event_id", "ts", F.lit("all").alias("k"))
    return with_neighbours(e, ["k"], ["ts", "event_id"], {"valid_from_before": ("previous", "ts"), "valid_to": ("next", "ts")}, 32).drop("k")


@R.query("""WITH x AS (SELECT ts, coalesce((epoch_us(ts) - epoch_us(lag(ts) OVER (ORDER BY ts)) > 60000000)::INT, 1) AS n FROM events), k AS (SELECT ts, sum(n) OVER (ORDER BY ts) AS session FROM x)
 SELECT 1 AS user_id, session::BIGINT AS session, min(ts) AS start, max(ts) AS "end", count(*) AS events FROM k GROUP BY session""")
def hot_user_sessions(spark, d):
    e = load(spark, d, "events").select(F.lit(1).alias("user_id"), "ts")
    return timeseries.sessions(e, gap_seconds=60, pieces=32)


@R.query("""SELECT 'all' AS tag, g.at, s.ts, s.value FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-25', INTERVAL 10 MINUTE)) AS at) g ASOF LEFT JOIN (SELECT ts, value FROM events) s ON g.at >= s.ts""")
def hot_tag_as_of(spark, d):
    s = load(spark, d, "events").select(F.lit("all").alias("tag"), "ts", "value", "event_id")
    times = spark.range(1).select(F.lit("all").alias("tag"), F.explode(F.expr("sequence(timestamp_ntz'2024-01-02', timestamp_ntz'2024-01-25', interval 10 minute)")).alias("at"))
    return timeseries.as_of(s, times, "event_id", pieces=32)


@R.query("SELECT count(*) AS keys, 8 AS bins, round(sum(o_totalprice), 2) AS total, true AS level FROM orders")
def level_bins(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_totalprice")
    loads = r.level_bins(o, "o_orderkey", "o_totalprice", 8).groupBy("bin").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("load"))
    total = F.sum("load")
    return loads.agg(F.sum("n").alias("keys"), F.count("*").cast("int").alias("bins"), F.round(total, 2).alias("total"), (F.max("load") <= total / 8 * (1 + 1 / 16)).alias("level"))


@R.query("SELECT c_custkey AS node, CASE WHEN c_custkey > 0 THEN c_custkey - 1 END AS parent, c_custkey::INTEGER AS depth FROM customer")
def hierarchy_deep(spark, d):
    c = load(spark, d, "customer")
    return r.hierarchy(c.select("c_custkey", F.when(F.col("c_custkey") > 0, F.col("c_custkey") - 1).alias("up")), "c_custkey", "up")


@R.query("""SELECT c_custkey AS node, CASE WHEN c_custkey % 8 = 7 THEN c_custkey - 5 WHEN c_custkey % 8 = 0 THEN -1 ELSE c_custkey + 1 END AS parent,
 CASE c_custkey % 8 WHEN 0 THEN 'orphan' WHEN 1 THEN 'below cycle' ELSE 'cycle' END AS fault, CASE WHEN c_custkey % 8 = 0 THEN -1 ELSE c_custkey - c_custkey % 8 + 2 END AS at
 FROM customer WHERE c_custkey <= (SELECT max(c_custkey) // 8 * 8 FROM customer)""")
def hierarchy_faults(spark, d):
    c, k = load(spark, d, "customer"), F.col("c_custkey")
    last = c.agg(F.floor(F.max("c_custkey") / 8).alias("whole"))
    c = c.join(F.broadcast(last), k <= F.col("whole") * 8)  # one row
    return r.hierarchy_faults(c.select(k, F.when(k % 8 == 7, k - 5).when(k % 8 == 0, -1).otherwise(k + 1).alias("up")), "c_custkey", "up")


@R.query("SELECT 'm' || o_orderkey AS message_id, 'C' || o_custkey AS facility FROM orders")
def read_message_records(spark, d):
    path = f.scratch(spark, "messages")
    o = load(spark, d, "orders").select(F.concat(F.lit("MSH|^~\\&|app|C"), "o_custkey", F.lit("|||2024||ADT^A01|m"), "o_orderkey", F.lit("|P|2.5\nPID|1||MSH|\nOBX|1|ST|x||MSH|5")).alias("value"))
    o.repartition(4).write.text(path)
    return messages.segment_table(messages.split_batches(f.read_message_records(spark, path)), "MSH", names={"msh_4.namespace": "facility"}).select("message_id", "facility")
