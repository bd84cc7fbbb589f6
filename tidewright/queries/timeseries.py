from datetime import datetime

from pyspark.sql import functions as F

from tidewright.operators import timeseries as t
from tidewright.queries._tables import Registry, load

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles


def _series(spark, d):
    return load(spark, d, "events").select(F.col("user_id").alias("tag"), "ts", "value", "event_id")


_S = "SELECT user_id AS tag, ts, value, event_id FROM events"
_HOUR = "to_timestamp(floor(epoch_us(ts) / 3600000000) * 3600)::TIMESTAMP"


@R.query("SELECT user_id AS tag, ts, value, true AS good, false AS questionable, false AS substituted, false AS annotated FROM events WHERE ts >= '2024-01-05' AND ts <= '2024-01-20' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts) <= 20")
def recorded_points(spark, d):
    return t.recorded(_series(spark, d).drop("event_id"), datetime(2024, 1, 5), datetime(2024, 1, 20), 20)


@R.query("SELECT min(l) + INTERVAL 1 MICROSECOND AS resume FROM (SELECT max(ts) AS l FROM events GROUP BY user_id)")
def resume_at_min_of_last(spark, d):
    return t.resume_at_min_of_last(_series(spark, d))


@R.query(f"""WITH g AS (SELECT DISTINCT user_id AS tag, unnest(generate_series(TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-25', INTERVAL 12 HOUR)) AS at FROM events)
 SELECT g.tag, g.at, s.ts, s.value FROM g ASOF LEFT JOIN ({_S}) s ON g.tag = s.tag AND g.at >= s.ts""")
def recorded_at_times(spark, d):
    s = _series(spark, d)
    times = s.select("tag").distinct().select("tag", F.explode(F.expr("sequence(timestamp_ntz'2024-01-02', timestamp_ntz'2024-01-25', interval 12 hour)")).alias("at"))
    return t.as_of(s, times, "event_id")


@R.query("SELECT user_id AS tag, ts, value FROM events WHERE ts <= '2024-01-15' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def value_at_time(spark, d):
    return t.value_at(_series(spark, d), datetime(2024, 1, 15), "event_id")


@R.query("SELECT user_id AS tag, ts, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def current_value(spark, d):
    return t.current_value(_series(spark, d), "event_id")


@R.query(f"""WITH s AS (SELECT tag, epoch_us(ts) AS t, max(value) AS value FROM ({_S}) GROUP BY ALL),
 g AS (SELECT tag, unnest(generate_series(CAST(ceil(min(t) / 21600000000) AS BIGINT), CAST(floor(max(t) / 21600000000) AS BIGINT))) * 21600000000 AS t FROM s GROUP BY tag),
 b AS (SELECT g.tag, g.t, s.t AS bt, s.value AS bv FROM g ASOF JOIN s ON g.tag = s.tag AND g.t >= s.t),
 a AS (SELECT b.*, s.t AS ta, s.value AS av FROM b ASOF LEFT JOIN s ON b.tag = s.tag AND b.t <= s.t)
 SELECT tag, make_timestamp(t) AS ts, round(CASE WHEN bt = t THEN bv ELSE bv + (av - bv) * (t - bt) / (ta - bt) END, 6) AS value FROM a""")
def interpolated_grid(spark, d):
    return t.interpolated(_series(spark, d), 21_600).withColumn("value", F.round("value", 6))


@R.query(f"""WITH p AS (SELECT user_id AS tag, ts, value, floor(epoch_us(ts) / 86400000000) AS b FROM events)
 SELECT DISTINCT tag, ts, value FROM p QUALIFY row_number() OVER (PARTITION BY tag, b ORDER BY ts) = 1 OR row_number() OVER (PARTITION BY tag, b ORDER BY ts DESC) = 1
 OR row_number() OVER (PARTITION BY tag, b ORDER BY value, ts) = 1 OR row_number() OVER (PARTITION BY tag, b ORDER BY value DESC, ts DESC) = 1""")
def plot_values(spark, d):
    return t.plot(_series(spark, d), 86_400)


@R.query("""SELECT tag, summary_type, round(value, 6) AS value FROM (UNPIVOT (SELECT user_id AS tag, sum(value) AS "Total", avg(value) AS "Average", min(value) AS "Minimum", max(value) AS "Maximum", max(value) - min(value) AS "Range",
 stddev_pop(value) AS "StdDev", count(value)::DOUBLE AS "Count" FROM events GROUP BY 1) ON COLUMNS(* EXCLUDE tag) INTO NAME summary_type VALUE value)""")
def summary_types(spark, d):
    return t.summary(_series(spark, d), t.SUMMARIES).withColumn("value", F.round("value", 6))


@R.query(f"SELECT user_id AS tag, {_HOUR} AS ts, round(avg(value), 6) AS value FROM events GROUP BY 1, 2")
def calculated_average(spark, d):
    return t.calculated(_series(spark, d), 3600).withColumn("value", F.round("value", 6))


@R.query("""WITH s AS (SELECT user_id AS tag, epoch_us(ts) AS t, max(value) AS value FROM events GROUP BY ALL),
 e AS (SELECT *, coalesce(lead(t) OVER (PARTITION BY tag ORDER BY t), (t // 86400000000 + 1) * 86400000000) AS e FROM s),
 p AS (SELECT tag, value, t, e, unnest(generate_series(t // 86400000000, (e - 1) // 86400000000)) * 86400000000 AS b FROM e),
 w AS (SELECT tag, b, value, least(e, b + 86400000000) - greatest(t, b) AS dt FROM p)
 SELECT tag, make_timestamp(b) AS ts, round(sum(value * dt) / sum(dt), 4) AS value FROM w GROUP BY 1, 2""")
def time_weighted_by_day(spark, d):
    return t.time_weighted(_series(spark, d), 86_400).withColumn("value", F.round("value", 4))


_SESSIONS = """WITH m AS (SELECT user_id, ts, coalesce((epoch_us(ts) - epoch_us(lag(ts) OVER w) > 1800000000)::INT, 1) AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
 k AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts)::BIGINT AS session FROM m),
 s AS (SELECT user_id, session, min(ts) AS start, max(ts) AS "end", count(*) AS events, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds, min(ts)::DATE AS date FROM k GROUP BY 1, 2) """


@R.query(_SESSIONS + 'SELECT user_id, session, start, "end", events FROM s')
def gap_sessions(spark, d):
    return t.sessions(load(spark, d, "events"))


@R.query(_SESSIONS + """SELECT user_id, session, start, "end" FROM s WHERE start < '2024-01-12' AND "end" > '2024-01-10'""")
def event_frames_overlapping(spark, d):
    s = t.sessions(load(spark, d, "events")).drop("events")
    return t.event_frames_overlapping(s, datetime(2024, 1, 10), datetime(2024, 1, 12))


@R.query("SELECT event_id, 'type' AS name, event_type AS value FROM events UNION ALL SELECT event_id, 'k', CASE WHEN event_id % 2 = 0 THEN props->>'k' ELSE '' END FROM events")
def frame_attributes(spark, d):
    e = load(spark, d, "events")
    m = F.create_map(F.lit("type"), "event_type", F.lit("k"), F.when(F.col("event_id") % 2 == 0, F.get_json_object("props", "$.k")))
    return t.frame_attributes(t.event_frames(e.withColumn("attributes", m)), ["event_id"])


@R.query("""SELECT o_orderkey, o_custkey AS element, true AS is_primary FROM orders UNION ALL
 SELECT DISTINCT o_orderkey, l_partkey, false FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_partkey <> o_custkey""")
def frame_referenced_elements(spark, d):
    o, li = load(spark, d, "orders", "lineitem")
    refs = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list("l_partkey").alias("refs"))
    return t.frame_elements(o.join(refs, "o_orderkey", "left"), ["o_orderkey"], "o_custkey", "refs")


@R.query("SELECT n_nationkey, n_name AS name, n_regionkey::VARCHAR AS region, '' AS gap FROM nation")
def table_rows_to_map(spark, d):
    n = load(spark, d, "nation").withColumn("gap", F.lit(None).cast("string"))
    return t.table_rows_to_map(n, ["n_nationkey"], ["n_name", "n_regionkey", "gap"]).select("n_nationkey", F.col("cells.n_name").alias("name"), F.col("cells.n_regionkey").alias("region"), F.col("cells.gap").alias("gap"))
