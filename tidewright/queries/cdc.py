from pyspark.sql import functions as F

from tidewright.operators import cdc
from tidewright.queries._tables import Registry, load

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles


def _changes(spark, d):
    return load(spark, d, "events").select("user_id", "ts", "event_type", "value", (F.col("event_type") == "error").alias("is_delete"))


_ORDERS_1 = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 11 <> 3"
_ORDERS_2 = "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 13 <> 5"


def _snapshots(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    second = o.where("o_orderkey % 13 <> 5").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")))
    return o.where("o_orderkey % 11 <> 3"), second


@R.query("SELECT user_id, ts, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1")
def scd1_latest(spark, d):
    return cdc.scd1(load(spark, d, "events").select("user_id", "ts", "event_type", "value"), ["user_id"], "ts")


@R.query("SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1")
def scd1_merge(spark, d):
    o = load(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    first, second = o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1")
    state = cdc.scd1(first, ["o_custkey"], "o_orderkey", keep_tombstones=True)
    return cdc.scd1_merge(state, second, ["o_custkey"], "o_orderkey")


@R.query("SELECT user_id, ts, event_type, value FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1) WHERE event_type <> 'error'")
def scd1_with_deletes(spark, d):
    return cdc.scd1(_changes(spark, d), ["user_id"], "ts", "is_delete").drop("is_delete")


_SCD2 = "SELECT user_id, ts, event_type, value, ts AS valid_from, lead(ts) OVER w AS valid_to, lead(ts) OVER w IS NULL AS is_current FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)"


@R.query(_SCD2)
def scd2_versions(spark, d):
    return cdc.scd2(load(spark, d, "events").select("user_id", "ts", "event_type", "value"), ["user_id"], "ts")


@R.query(f"SELECT * FROM ({_SCD2}) WHERE event_type <> 'error'")
def scd2_with_deletes(spark, d):
    return cdc.scd2(_changes(spark, d), ["user_id"], "ts", "is_delete").drop("is_delete")


@R.query(_SCD2)
def scd2_merge_late(spark, d):
    e = load(spark, d, "events").select("user_id", "ts", "event_type", "value", "event_id")
    history, late = e.where("event_id % 10 <> 0").drop("event_id"), e.where("event_id % 10 = 0").drop("event_id")
    return cdc.scd2_merge(cdc.scd2(history, ["user_id"], "ts"), history, late, ["user_id"], "ts")


@R.query(_ORDERS_2)
def snapshot_scd1(spark, d):
    return cdc.snapshot_scd1(*_snapshots(spark, d), ["o_orderkey"])


_CHANGED = f"""SELECT CASE WHEN a.o_orderkey IS NULL THEN 'insert' WHEN b.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS change,
 coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey, coalesce(b.o_custkey, a.o_custkey) AS o_custkey, coalesce(b.o_orderstatus, a.o_orderstatus) AS o_orderstatus, coalesce(b.o_totalprice, a.o_totalprice) AS o_totalprice
 FROM ({_ORDERS_1}) a FULL JOIN ({_ORDERS_2}) b ON a.o_orderkey = b.o_orderkey
 WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_orderstatus <> b.o_orderstatus"""


@R.query(_CHANGED)
def snapshot_changes(spark, d):
    return cdc.snapshot_changes(*_snapshots(spark, d), ["o_orderkey"])


@R.query(f"""WITH a AS ({_ORDERS_1}), b AS ({_ORDERS_2}), c AS ({_CHANGED})
 SELECT a.*, 1::INTEGER AS valid_from, CASE WHEN c.change IS NOT NULL THEN 2::INTEGER END AS valid_to, c.change IS NULL AS is_current FROM a LEFT JOIN c ON a.o_orderkey = c.o_orderkey
 UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 2::INTEGER, NULL, true FROM c WHERE change <> 'delete'""")
def snapshot_scd2(spark, d):
    first, second = _snapshots(spark, d)
    history = first.withColumns({"valid_from": F.lit(1), "valid_to": F.lit(None).cast("int")})
    return cdc.snapshot_scd2(history, second, ["o_orderkey"], 2)


@R.query("""SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN value END AS value, event_type = 'error' AS _deleted, ts AS _sequence FROM events""")
def tombstone_feed(spark, d):
    e = load(spark, d, "events").select("event_id", "user_id", "value", "ts", "event_type", F.lit("x").alias("odata@etag"))
    return cdc.tombstone_feed(e, F.col("event_type") == "error", "ts", ["event_id", "user_id", "ts", "event_type"]).drop("ts", "event_type")


@R.query("""SELECT o_orderkey AS ref_id, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END AS "OrderID", CASE WHEN o_orderkey % 5 <> 0 THEN 'e''n' END AS "Lang",
 CASE WHEN o_orderkey % 5 = 0 THEN 'other collection: Parts' END AS key_error FROM orders""")
def tombstone_keys_from_ref(spark, d):
    o = load(spark, d, "orders").select("o_orderkey")
    ref = F.when(F.col("o_orderkey") % 5 == 0, F.lit("Parts(x)")).otherwise(F.concat(F.lit("Orders(OrderID="), F.col("o_orderkey"), F.lit(",Lang='e''n')")))
    out = cdc.tombstone_keys_from_ref(o.select(F.col("o_orderkey").alias("ref_id"), ref.alias("ref")), "ref", "Orders", {"OrderID": "bigint", "Lang": "string"})
    return out.drop("ref")


@R.query("SELECT DISTINCT user_id AS id FROM events WHERE event_type = 'error'")
def deletes_from_history(spark, d):
    log = load(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.collect_list(F.when(F.col("event_type") == "error", F.struct(F.col("user_id").alias("id")))).alias("removed"))
    return cdc.deletes_from_history(log, "removed")


@R.query("SELECT o_orderkey, o_orderdate + INTERVAL 1 DAY AS updated_at, true AS _deleted FROM orders WHERE o_orderstatus = 'F'")
def archived_as_deletes(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("updated_at"), (F.col("o_orderstatus") == "F").alias("archived"), F.expr("o_orderdate + interval 1 day").alias("archived_at"))
    return cdc.archived_as_deletes(o, "archived", "archived_at", "updated_at").select("o_orderkey", "updated_at", "_deleted")


@R.query("SELECT event_id, ts, CASE WHEN event_type <> 'error' THEN value END AS value, event_type = 'error' AS _deleted FROM events")
def upserts_plus_deletes(spark, d):
    e = load(spark, d, "events")
    return cdc.upserts_plus_deletes(e.where("event_type <> 'error'").select("event_id", "ts", "value"), e.where("event_type = 'error'").select("event_id", "ts"))


@R.query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def full_refresh_upsert(spark, d):
    c = load(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return cdc.full_refresh_upsert(c.where("c_custkey % 3 = 0").withColumn("c_acctbal", F.lit(0.0)), c, ["c_custkey"])


@R.query("SELECT l_orderkey, l_linenumber, max(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL")
def revision_upsert(spark, d):
    return cdc.scd1(load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber"], "l_partkey")


@R.query("SELECT count(*) AS n FROM events WHERE event_id % 10 = 0")
def rejected_changes(spark, d):
    e = load(spark, d, "events").withColumn("user_id", F.when(F.col("event_id") % 10 != 0, F.col("user_id")))
    return cdc.rejected_changes(e, ["user_id"], "ts").agg(F.count("*").alias("n"))
