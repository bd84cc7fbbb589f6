from datetime import datetime

from pyspark.sql import functions as F

from tidewright.operators import cursors as c
from tidewright.queries._tables import Registry, load

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles
LOW, HIGH = datetime(1995, 3, 1), datetime(1996, 3, 1)
_O = "SELECT o_orderkey, o_orderdate FROM orders"


def _orders(spark, d):
    return load(spark, d, "orders").select("o_orderkey", "o_orderdate")


@R.query(f"{_O} WHERE o_orderdate > '1995-03-01' AND o_orderdate <= '1996-03-01'")
def cursor_since(spark, d):
    return c.since(_orders(spark, d), "o_orderdate", LOW, HIGH)


@R.query("SELECT greatest(least(max(o_orderdate), TIMESTAMP '1996-03-01'), TIMESTAMP '1995-03-01') AS watermark FROM orders")
def cursor_next_watermark(spark, d):
    return c.next_watermark(_orders(spark, d), "o_orderdate", LOW, HIGH)


@R.query("SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-20' - INTERVAL 3600 SECOND")
def cursor_with_lookback(spark, d):
    return c.with_lookback(load(spark, d, "events").select("event_id", "ts"), "ts", datetime(2024, 1, 20), 3600)


@R.query("SELECT event_id, value, event_type FROM events WHERE event_id % 3 <> 0 OR event_id % 6 = 0")
def cursor_overlap_dedup(spark, d):
    e = load(spark, d, "events").select("event_id", "value", "event_type")
    delivered = e.where("event_id % 3 = 0").withColumn("event_type", F.when(F.col("event_id") % 6 == 0, "changed").otherwise(F.col("event_type")))
    return c.overlap_dedup(e, delivered, ["event_id"])


@R.query(f"{_O} QUALIFY rank() OVER (ORDER BY o_orderdate) <= 1000")
def cursor_soft_cap(spark, d):
    return c.soft_cap(_orders(spark, d), "o_orderdate", 1000)


@R.query(f"{_O} QUALIFY count(*) OVER (ORDER BY o_orderdate) <= 1000")
def cursor_trim_ties(spark, d):
    return c.trim_ties(_orders(spark, d), "o_orderdate", 1000)


@R.query(f"{_O} WHERE o_orderdate > '1995-03-01' OR (o_orderdate = '1995-03-01' AND o_orderkey > 500)")
def cursor_keyset_after(spark, d):
    return c.keyset_after(_orders(spark, d), "o_orderdate", "o_orderkey", (LOW, 500))


@R.query(f"{_O} WHERE o_orderdate > '1995-03-01' AND o_orderdate <= TIMESTAMP '1995-03-01' + INTERVAL 90 DAY QUALIFY rank() OVER (ORDER BY o_orderdate) <= 200")
def cursor_window_batch(spark, d):
    return c.window_batch(_orders(spark, d), "o_orderdate", LOW, "90 DAYS", 200)[0]


@R.query(f"""WITH w AS ({_O} WHERE o_orderdate > '1995-03-01' AND o_orderdate <= TIMESTAMP '1995-03-01' + INTERVAL 90 DAY), r AS (SELECT * FROM w QUALIFY rank() OVER (ORDER BY o_orderdate) <= 200)
 SELECT CASE WHEN (SELECT count(*) FROM w) = (SELECT count(*) FROM r) THEN TIMESTAMP '1995-03-01' + INTERVAL 90 DAY ELSE (SELECT max(o_orderdate) FROM r) END AS next""")
def cursor_window_next(spark, d):
    return c.window_batch(_orders(spark, d), "o_orderdate", LOW, "90 DAYS", 200)[1]


@R.query("""WITH w AS (SELECT date_trunc('day', ts)::TIMESTAMP AS w, count(*) AS n FROM events GROUP BY 1), b AS (SELECT *, ((sum(n) OVER (ORDER BY w) - n) // 700)::BIGINT AS batch FROM w)
 SELECT batch, min(w) AS begin, max(w) AS "end", sum(n)::BIGINT AS n FROM b GROUP BY 1""")
def cursor_compact_windows(spark, d):
    return c.compact_windows(load(spark, d, "events"), "ts", "day", 700)


@R.query("SELECT conv_id, turn, role FROM conversations QUALIFY rank() OVER (ORDER BY conv_id) <= 25")
def cursor_cap_at_group(spark, d):
    return c.cap_at_group(load(spark, d, "conversations").select("conv_id", "turn", "role"), "conv_id", 25)


@R.query(f"{_O}")
def cursor_redrain(spark, d):
    return c.redrain_on_stuck_cap(_orders(spark, d), "o_orderdate", 0)


@R.query("SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN ts END AS ts, CASE WHEN event_id % 4 <> 0 THEN ts ELSE TIMESTAMP '1900-01-01' END AS cursor_key FROM events")
def cursor_null_floor(spark, d):
    e = load(spark, d, "events").select("event_id", F.when(F.col("event_id") % 4 != 0, F.col("ts")).alias("ts"))
    return c.null_cursor(e, "ts")


@R.query("SELECT event_id, ts, ts AS cursor_key FROM events WHERE event_id % 4 <> 0")
def cursor_null_ignore(spark, d):
    e = load(spark, d, "events").select("event_id", F.when(F.col("event_id") % 4 != 0, F.col("ts")).alias("ts"))
    return c.null_cursor(e, "ts", "ignore")


def _texts(spark, d):
    ts = F.col("ts").cast("timestamp")
    forms = [F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")]
    raw = F.when(F.col("event_id") % 3 == 0, forms[0]).when(F.col("event_id") % 3 == 1, forms[1]).otherwise(forms[2])
    return load(spark, d, "events").select("event_id", raw.alias("raw"), "ts")


@R.query("SELECT event_id, row_number() OVER (PARTITION BY event_id % 50 ORDER BY CASE WHEN event_id % 3 = 1 THEN ts ELSE date_trunc('second', ts) END, event_id)::INTEGER AS k FROM events")
def cursor_key_order(spark, d):
    t = _texts(spark, d).withColumn("key", c.cursor_key(F.col("raw"))).withColumn("g", F.col("event_id") % 50)
    t = t.withColumn("at", F.struct("key.family", "key.number", "key.time", F.coalesce(F.nullif("key.fraction", F.lit("")), F.lit("000000000"))))
    return t.withColumn("k", F.expr("row_number() over (partition by g order by at, event_id)")).select("event_id", "k")


@R.query("SELECT strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%fZ') AS cursor FROM events WHERE event_id % 3 = 1")
def cursor_max(spark, d):
    return c.cursor_max(_texts(spark, d).where("event_id % 3 = 1"), "raw")


@R.query("SELECT min(o_orderdate) AS oldest FROM orders")
def cursor_oldest(spark, d):
    return c.oldest_cursor(_orders(spark, d), "o_orderdate")


@R.query("SELECT max(o_orderdate) >= TIMESTAMP '1996-03-01' AS has_new FROM orders")
def cursor_has_new_data(spark, d):
    return c.has_new_data(_orders(spark, d), "o_orderdate", HIGH)


_W = "SELECT o_custkey, max(o_orderdate) AS watermark FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey % 3 <> 0 GROUP BY 1"


def _marks(spark, d):
    o = load(spark, d, "orders")
    return o, o.where("o_orderkey % 2 = 0 and o_custkey % 3 <> 0").groupBy("o_custkey").agg(F.max("o_orderdate").alias("watermark"))


@R.query(f"SELECT o.o_orderkey, o.o_custkey FROM orders o LEFT JOIN ({_W}) w ON o.o_custkey = w.o_custkey WHERE w.watermark IS NULL OR o.o_orderdate > w.watermark")
def cursor_since_per_group(spark, d):
    o, marks = _marks(spark, d)
    return c.since_per_group(o, marks, "o_custkey", "o_orderdate").select("o_orderkey", "o_custkey")


@R.query("SELECT o_custkey, max(o_orderdate) AS watermark FROM orders WHERE (o_orderkey % 2 = 0 AND o_custkey % 3 <> 0) OR o_orderkey % 5 = 0 GROUP BY 1")
def cursor_watermarks_by_group(spark, d):
    o, marks = _marks(spark, d)
    return c.watermarks_by_group(o.where("o_orderkey % 5 = 0"), "o_custkey", "o_orderdate", marks)


@R.query("SELECT event_id, ts FROM events WHERE ts <= TIMESTAMP '2024-01-25' - INTERVAL 7200 SECOND")
def cursor_availability_ceiling(spark, d):
    return c.availability_ceiling(load(spark, d, "events").select("event_id", "ts"), "ts", datetime(2024, 1, 25), 7200)


@R.query("SELECT event_id, ts, CASE WHEN ts > TIMESTAMP '2024-01-20' - INTERVAL 3 DAY THEN value ELSE 0 END AS value FROM events")
def cursor_late_edit_window(spark, d):
    e = load(spark, d, "events").select("event_id", "ts", "value")
    return c.late_edit_window(e.withColumn("value", F.lit(0.0)), e, "ts", ["event_id"], datetime(2024, 1, 20), 3)


@R.query("SELECT event_id, ts FROM events")
def cursor_check_filter_honoured(spark, d):
    return c.check_filter_honoured(load(spark, d, "events").select("event_id", "ts"), "ts", datetime(2024, 1, 2))


@R.query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_shipdate > '1996-06-01' AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate > '1996-03-01')")
def cursor_children_of_changed(spark, d):
    o, li = load(spark, d, "orders", "lineitem")
    o, li = o.withColumnRenamed("o_orderkey", "k"), li.withColumn("k", F.col("l_orderkey"))
    return c.children_of_changed_parents(o, li, ["k"], "o_orderdate", HIGH, "l_shipdate", datetime(1996, 6, 1)).select("l_orderkey", "l_linenumber", "l_partkey")


@R.query("SELECT event_id, ts, user_id FROM events ORDER BY ts, event_id")
def cursor_order_for_batch(spark, d):
    return c.order_for_batch(load(spark, d, "events").select("event_id", "ts", "user_id"), "ts", "event_id")


@R.query("""WITH w AS (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '1996-12-31', INTERVAL 1 MONTH)) AS low)
 SELECT low, count(*) AS n FROM (SELECT low, least(low + INTERVAL 1 MONTH, TIMESTAMP '1997-01-01') AS high FROM w) x JOIN orders ON o_orderdate > low AND o_orderdate <= high GROUP BY 1""")
def cursor_time_windows(spark, d):
    w = c.time_windows(spark, "1995-01-01", "1997-01-01", "1 month")
    return c.rows_by_window(_orders(spark, d), "o_orderdate", w).groupBy("low").agg(F.count("*").alias("n"))
