from pyspark.sql import functions as F

from tidewright.operators import quality as q
from tidewright.operators import reports as r
from tidewright.operators.cdc import scd1
from tidewright.operators.cursors import since
from tidewright.queries._tables import Registry, load
from tidewright.queries.timeseries import _SESSIONS

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles


@R.query("""SELECT ts::DATE AS date, event_type AS "eventName", count(*) AS "eventCount", round(avg(value), 6) AS "averageValue", round(count(*) / count(DISTINCT user_id), 6) AS "eventsPerUser" FROM events
 WHERE ts >= '2024-01-03' AND ts < '2024-01-21' AND event_type <> 'error' GROUP BY 1, 2 HAVING count(*) > 3""")
def report(spark, d):
    out = r.report(load(spark, d, "events"), ["date", "eventName"], ["eventCount", "averageValue", "eventsPerUser"], ("2024-01-03", "2024-01-20"), F.col("event_type") != "error", F.col("eventCount") > 3, ordered=False)
    return out.withColumns({c: F.round(c, 6) for c in ("averageValue", "eventsPerUser")})


@R.query("""WITH f AS (SELECT user_id, min(ts)::DATE AS first FROM events GROUP BY 1) SELECT ts::DATE AS date, CASE WHEN ts::DATE = first THEN 'new' ELSE 'returning' END AS "newVsReturning", count(DISTINCT e.user_id) AS "activeUsers" FROM events e JOIN f ON e.user_id = f.user_id
 WHERE ts >= '2024-01-05' AND ts < '2024-01-12' AND event_type <> 'error' GROUP BY 1, 2""")
def report_new_users_in_a_range(spark, d):
    return r.report(load(spark, d, "events"), ["date", "newVsReturning"], ["activeUsers"], ("2024-01-05", "2024-01-11"), F.col("event_type") != "error", ordered=False)


# Events with their users' first day, sessions, customers, nations and a part each, under the names that the ready reports use.
_BASE = """WITH m AS (SELECT *, coalesce((epoch_us(ts) - epoch_us(lag(ts) OVER w) > 1800000000)::INT, 1) AS first, min(ts) OVER (PARTITION BY user_id)::DATE AS day FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 k AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM m),
 x AS (SELECT *, user_id || '-' || s AS session, (max(epoch_us(ts)) OVER z - min(epoch_us(ts)) OVER z) / 1e6 AS seconds, count(*) OVER z AS events FROM k WINDOW z AS (PARTITION BY user_id, s)),
 e AS (SELECT ts::DATE AS date, event_type AS "eventName", CASE WHEN ts::DATE = day THEN 'new' ELSE 'returning' END AS "newVsReturning", user_id, value, session, CASE WHEN seconds >= 10 OR events >= 2 THEN session END AS engaged, CASE WHEN first = 1 THEN seconds END AS length,
  n_name AS country, c_mktsegment AS segment, p_name, p_partkey, p_brand, p_type FROM x JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN part ON event_id % 200 + 1 = p_partkey) """
_METRICS = {
    "eventCount": "count(*)", "activeUsers": "count(DISTINCT user_id)", "sessions": "count(DISTINCT session)", "engagedSessions": "count(DISTINCT engaged)", "engagementRate": "round(count(DISTINCT engaged) / count(DISTINCT session), 6)",
    "bounceRate": "round(1 - count(DISTINCT engaged) / count(DISTINCT session), 6)", "averageSessionDuration": "round(avg(length), 3)", "newUsers": "count(DISTINCT user_id) FILTER (\"newVsReturning\" = 'new')", "screenPageViews": "count(*) FILTER (\"eventName\" = 'view')",
    "keyEvents": "count(*) FILTER (\"eventName\" = 'purchase')", "totalRevenue": "round(sum(value) FILTER (\"eventName\" = 'purchase'), 4)", "itemRevenue": "round(sum(value) FILTER (\"eventName\" = 'purchase'), 4)", "itemsViewed": "count(*) FILTER (\"eventName\" = 'view')",
    "itemsAddedToCart": "0::BIGINT", "itemsPurchased": "count(*) FILTER (\"eventName\" = 'purchase')", "itemsViewedInPromotion": "0::BIGINT", "itemsClickedInPromotion": "0::BIGINT", "advertiserAdCost": "round(sum(value / 10), 4)",
}
#: What stands for a dimension that the tables do not have.
_AS = {"country": "country", "sessionSource": "segment", "sessionMedium": "p_brand", "pagePath": "p_type", "pageTitle": "p_brand", "deviceCategory": "segment", "browser": "p_brand", "landingPage": "p_type", "itemName": "p_name", "itemId": "p_partkey", "itemPromotionName": "p_brand",
       "language": "segment", "audienceName": "segment", "operatingSystem": "p_brand", "defaultChannelGroup": "segment"}
_ROUND = {"engagementRate": 6, "bounceRate": 6, "averageSessionDuration": 3, "totalRevenue": 4, "itemRevenue": 4, "advertiserAdCost": 4}


def _named(spark, d):
    e, c, n, p = load(spark, d, "events", "customer", "nation", "part")
    all_ = r.with_sessions(r.with_new_vs_returning(e)).drop("new_vs_returning")
    all_ = all_.join(c, F.col("user_id") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(p, F.col("event_id") % 200 + 1 == F.col("p_partkey"))
    own = {"country": "n_name", "segment": "c_mktsegment"}
    return all_.withColumns({**{k: F.col(own.get(v, v)) for k, v in _AS.items()}, "ad_cost": F.col("value") / 10})


def _ready(name):
    dimensions, metrics = r.PRESETS[name]
    columns = [f'{_AS.get(x, chr(34) + x + chr(34))} AS "{x}"' for x in dimensions] + [f'{_METRICS[m]} AS "{m}"' for m in metrics]

    def query(spark, d):
        out = r.preset(_named(spark, d), name)
        return out.withColumns({m: F.round(m, _ROUND[m]) for m in metrics if m in _ROUND})

    query.__name__ = f"report_{name}"
    R.query(f"{_BASE} SELECT {', '.join(columns)} FROM e GROUP BY {', '.join(str(i + 1) for i in range(len(dimensions)))}")(query)


for _name in r.PRESETS:
    _ready(_name)


@R.query("SELECT ts::DATE AS date, event_type AS segment, count(DISTINCT user_id) AS count FROM events GROUP BY 1, 2")
def active_users(spark, d):
    return r.active_users(load(spark, d, "events"), "event_type")


@R.query("SELECT first AS date, 'Totals' AS segment, count(*) AS count FROM (SELECT min(ts)::DATE AS first FROM events GROUP BY user_id) GROUP BY 1")
def new_users(spark, d):
    return r.active_users(load(spark, d, "events"), mode="new")


@R.query(_SESSIONS + "SELECT date, round(avg(seconds), 4) AS average_seconds FROM s GROUP BY 1")
def average_session_length(spark, d):
    return r.average_session_length(load(spark, d, "events")).withColumn("average_seconds", F.round("average_seconds", 4))


@R.query(_SESSIONS + "SELECT CASE WHEN seconds < 60 THEN '0s-60s' WHEN seconds < 300 THEN '60s-300s' WHEN seconds < 1800 THEN '300s-1800s' ELSE '1800s+' END AS bucket, count(*) AS sessions FROM s GROUP BY 1")
def session_length_distribution(spark, d):
    return r.session_length_distribution(load(spark, d, "events"))


@R.query(_SESSIONS + "SELECT date, round(count(*) / count(DISTINCT user_id), 6) AS sessions_per_user FROM s GROUP BY 1")
def sessions_per_user(spark, d):
    return r.sessions_per_user(load(spark, d, "events")).withColumn("sessions_per_user", F.round("sessions_per_user", 6))


@R.query(_SESSIONS + "SELECT date, round(count(*) FILTER (seconds >= 10 OR events >= 2) / count(*), 6) AS engagement_rate FROM s GROUP BY 1")
def engagement_rate(spark, d):
    return r.engagement_rate(load(spark, d, "events")).withColumn("engagement_rate", F.round("engagement_rate", 6))


@R.query("SELECT user_id % 10 AS survey, event_type AS answer, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY user_id % 10), 6) AS share FROM events GROUP BY 1, 2")
def answer_rollup(spark, d):
    e = load(spark, d, "events").select((F.col("user_id") % 10).alias("survey"), F.col("event_type").alias("answer"))
    return r.answer_rollup(e, "survey", "answer").withColumn("share", F.round("share", 6))


@R.query("SELECT greatest((SELECT max(o_orderdate) FROM orders), (SELECT max(l_shipdate) FROM lineitem)) AS newest")
def max_date_over_properties(spark, d):
    o, li = load(spark, d, "orders", "lineitem")
    return r.max_date([o.select(F.col("o_orderdate").alias("d")), li.select(F.col("l_shipdate").alias("d"))], "d")


@R.query("""SELECT count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys, min(l_shipdate) AS cursor_min, max(l_shipdate) AS cursor_max, count(*) FILTER (l_quantity IS NULL) AS nulls_l_quantity, count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS "unique" FROM lineitem""")
def table_profile(spark, d):
    p = r.table_profile(load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity"), ["l_orderkey", "l_linenumber"], "l_shipdate")
    return p.select("rows", "distinct_keys", "cursor_min", "cursor_max", "nulls_l_quantity", "unique")


@R.query("SELECT 'l_orderkey' AS \"column\", count(l_orderkey) AS filled, true AS ok FROM lineitem UNION ALL SELECT 'l_comment', 0, true FROM (SELECT 1) UNION ALL SELECT 'l_gap', 0, false FROM (SELECT 1)")
def column_population(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey").withColumns({"l_comment": F.lit(None).cast("string"), "l_gap": F.lit(None).cast("int")})
    return q.column_population(li, ("l_comment",))


@R.query("SELECT count(*) FILTER (o_orderkey % 6 = 0) AS n FROM orders")
def all_null_rows(spark, d):
    some = F.col("o_orderkey") % 6 != 0
    o = load(spark, d, "orders").select(F.when(some, F.col("o_orderkey")).alias("k"), F.struct(F.when(some, F.col("o_custkey")).alias("c")).alias("s"), F.array(F.when(some, F.col("o_custkey"))).alias("a"))
    return q.all_null_rows(o).agg(F.count("*").alias("n"))


@R.query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def primary_key_check(spark, d):
    return q.primary_key_check(load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@R.query("SELECT 'k' AS field, 'undeclared' AS state, count(*) AS n FROM events UNION ALL SELECT 'country', 'unseen', 0 FROM (SELECT 1)")
def schema_coverage(spark, d):
    return q.schema_coverage(load(spark, d, "events"), "props", ["country"])


@R.query("SELECT 0::BIGINT AS only_once, 0::BIGINT AS only_replayed FROM (SELECT count(*) FROM events)")
def replay_equivalence(spark, d):
    e = load(spark, d, "events").select("user_id", "ts", "event_type", "value")
    cuts = [None, "2024-01-08", "2024-01-15", "2024-01-22", None]
    state = None
    for low, high in zip(cuts, cuts[1:], strict=False):
        batch = since(e, "ts", low and F.lit(low).cast("timestamp_ntz"), high and F.lit(high).cast("timestamp_ntz"))
        state = scd1(batch if state is None else state.unionByName(batch), ["user_id"], "ts", keep_tombstones=True)
    return q.replay_equivalence(scd1(e, ["user_id"], "ts"), state)


@R.query("SELECT 0::BIGINT AS missing, count(*) FILTER (o_orderkey % 100 = 0)::BIGINT AS repeated FROM orders")
def partition_disjoint(spark, d):
    o = load(spark, d, "orders").select("o_orderkey")
    parts = o.where("o_orderkey % 4 < 2").union(o.where("o_orderkey % 4 >= 2")).union(o.where("o_orderkey % 100 = 0"))
    return q.partition_disjoint(o, parts, ["o_orderkey"])
