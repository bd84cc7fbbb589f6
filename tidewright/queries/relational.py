from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.operators import relational as r
from tidewright.queries._tables import Registry, load

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles


@R.query("SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders")
def select_keep_keys(spark, d):
    return r.select_keep_keys(load(spark, d, "orders"), ["o_orderkey", "o_orderdate", "o_orderstatus"], ["o_orderkey", "o_orderdate"])


@R.query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice >= 50000 AND o_orderstatus <> 'P' AND o_orderpriority IN ('1-URGENT','2-HIGH') AND o_orderkey < 9000")
def where_spec(spark, d):
    spec = [("o_totalprice", "gte", "50000"), ("o_orderstatus", "ne", "P"), ("o_orderpriority", "in", ["1-URGENT", "2-HIGH"]), ("o_orderkey", "lt", "9000")]
    return r.where_spec(load(spark, d, "orders"), spec).select("o_orderkey", "o_orderstatus", "o_totalprice")


@R.query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def and_all(spark, d):
    return load(spark, d, "orders").where(r.and_all(F.col("o_orderstatus") == "F", None, F.col("o_totalprice") > 100000)).select("o_orderkey")


@R.query("""SELECT o_orderkey, c_custkey, l_linenumber, l_quantity FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
 WHERE c_mktsegment = 'BUILDING' AND o_orderdate >= '1995-01-01' AND l_quantity > 40""")
def filters_at(spark, d):
    c, o, li = load(spark, d, "customer", "orders", "lineitem")
    o = o.withColumn("c_custkey", F.col("o_custkey"))
    li = li.withColumn("o_orderkey", F.col("l_orderkey"))
    return r.filters_at([(c, [], F.col("c_mktsegment") == "BUILDING"), (o, ["c_custkey"], F.col("o_orderdate") >= "1995-01-01"), (li, ["o_orderkey"], F.col("l_quantity") > 40)]).select("o_orderkey", "c_custkey", "l_linenumber", "l_quantity")


@R.query("SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('click','purchase') GROUP BY 1")
def dimension_filter(spark, d):
    return load(spark, d, "events").where(F.col("event_type").isin("click", "purchase")).groupBy("event_type").agg(F.count("*").alias("n"))


@R.query("SELECT user_id, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 65")
def metric_filter(spark, d):
    return load(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n")).where("n > 65")


@R.query("SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^(red|blue) .*t$')")
def search_names(spark, d):
    return r.search_names(load(spark, d, "part").select("p_partkey", "p_name"), "p_name", "^(red|blue) .*t$")


@R.query("SELECT n_nationkey, n_name FROM nation WHERE lower(n_name) = lower((SELECT min(n_name) FROM nation))")
def key_filter(spark, d):
    n = load(spark, d, "nation").select("n_nationkey", "n_name")
    return r.key_filter(n, n_name=n.agg(F.min("n_name")).first()[0].swapcase())


@R.query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_custkey = 7")
def option_filters(spark, d):
    return r.option_filters(load(spark, d, "orders"), o_orderstatus="O", o_custkey=7, o_orderpriority=None).select("o_orderkey")


@R.query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (1, 5, 77)")
def ids_in(spark, d):
    return r.ids_in(load(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", " 1, 5,, 77 ")


@R.query("SELECT o_orderkey, 'acme' AS org, 3::INTEGER AS shard FROM orders")
def stamp(spark, d):
    return r.stamp(load(spark, d, "orders").select("o_orderkey"), org="acme", shard=3)


@R.query("SELECT n_nationkey, n_name FROM nation")
def drop_control(spark, d):
    n = load(spark, d, "nation").select("n_nationkey", "n_name")
    return r.drop_control(n.withColumns({"__metadata": F.lit(1), "n@odata.id": F.lit("x")}))


@R.query("SELECT o_orderkey, NULL::VARCHAR AS note, o_custkey::VARCHAR AS o_custkey FROM orders")
def pad_to_schema(spark, d):
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("note", T.StringType()), T.StructField("o_custkey", T.StringType())])
    return r.pad_to_schema(load(spark, d, "orders"), schema, ["o_orderkey"])


@R.query("SELECT p_partkey FROM part WHERE p_type LIKE (SELECT left(min(p_type), 3) FROM part) || '%'")
def prefix_filter(spark, d):
    p = load(spark, d, "part")
    return r.prefix_filter(p, "p_type", p.agg(F.left(F.min("p_type"), F.lit(3))).first()[0]).select("p_partkey")


@R.query("SELECT p_partkey FROM part WHERE lower(p_brand) LIKE 'b%#_2'")
def wildcard_filter(spark, d):
    return r.wildcard_filter(load(spark, d, "part"), "p_brand", "B*#?2").select("p_partkey")


@R.query("SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def fan_out(spark, d):
    o, li = load(spark, d, "orders", "lineitem")
    return r.fan_out(o.withColumn("l_orderkey", F.col("o_orderkey")), li.select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey"], ["o_custkey", "o_orderdate"])


@R.query("""SELECT n_name, c_mktsegment, count(*) AS messages, max(o_orderdate) AS latest FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
 GROUP BY ALL ORDER BY messages DESC, latest DESC, n_name, c_mktsegment LIMIT 20""")
def messages_per_channel(spark, d):
    o, c, n = load(spark, d, "orders", "customer", "nation")
    j = o.join(c, o.o_custkey == c.c_custkey, "left").join(n, c.c_nationkey == n.n_nationkey, "left")
    return r.top_groups(j, ["n_name", "c_mktsegment"], "o_orderdate", 20).withColumnRenamed("n", "messages")


@R.query("SELECT o_orderkey, count(*) AS replies, max(l_shipdate) AS latest FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1")
def messages_with_replies(spark, d):
    o, li = load(spark, d, "orders", "lineitem")
    return o.join(li, o.o_orderkey == li.l_orderkey).groupBy("o_orderkey").agg(F.count("*").alias("replies"), F.max("l_shipdate").alias("latest"))


@R.query("""SELECT 'building' AS cohort, c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' UNION ALL SELECT 'rich', c_custkey FROM customer WHERE c_acctbal > 5000 UNION ALL SELECT 'debt', c_custkey FROM customer WHERE c_acctbal < 0""")
def cohort_members(spark, d):
    return r.cohort_members(load(spark, d, "customer"), "c_custkey", {"building": F.col("c_mktsegment") == "BUILDING", "rich": F.col("c_acctbal") > 5000, "debt": F.col("c_acctbal") < 0})


@R.query("SELECT DISTINCT s_suppkey, p_partkey, s_suppkey || '_' || p_partkey AS id FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey")
def junction(spark, d):
    li, s, p = load(spark, d, "lineitem", "supplier", "part")
    left = li.join(s, li.l_suppkey == s.s_suppkey).select("l_orderkey", "l_linenumber", "l_partkey", "s_suppkey")
    right = p.select(F.col("p_partkey").alias("l_partkey"), "p_partkey")
    return r.junction(left, right, ["l_partkey"], "s_suppkey", "p_partkey")


_PATH = "SELECT c_custkey, o_orderkey AS orders_o_orderkey, l_linenumber, l_partkey, l_quantity FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey"


@R.query(_PATH)
def expand_path(spark, d):
    c, o, li = load(spark, d, "customer", "orders", "lineitem")
    lines = li.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity")).alias("lines"))
    orders = o.join(lines, o.o_orderkey == lines.l_orderkey).groupBy("o_custkey").agg(F.collect_list(F.struct("o_orderkey", "o_orderdate", "lines")).alias("orders"))
    nested = c.join(orders, c.c_custkey == orders.o_custkey).select("c_custkey", "orders")
    return r.expand_path(nested, [("orders", ["o_orderkey"]), ("lines", ["l_linenumber"])], ["l_linenumber", "l_partkey", "l_quantity"])


@R.query(_PATH)
def expand_by_join(spark, d):
    c, o, li = load(spark, d, "customer", "orders", "lineitem")
    o = o.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("orders_o_orderkey"))
    li = li.select(F.col("l_orderkey").alias("orders_o_orderkey"), "l_linenumber", "l_partkey", "l_quantity")
    return r.filters_at([(c.select("c_custkey"), [], None), (o, ["c_custkey"], None), (li, ["orders_o_orderkey"], None)])


@R.query("""SELECT 'R' || r_regionkey AS node, NULL::VARCHAR AS parent, 0::INTEGER AS depth FROM region UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, 1 FROM nation UNION ALL SELECT 'S' || s_suppkey, 'N' || s_nationkey, 2 FROM supplier""")
def hierarchy(spark, d):
    g, n, s = load(spark, d, "region", "nation", "supplier")
    t = lambda a, x: F.concat(F.lit(a), F.col(x))
    nodes = g.select(t("R", "r_regionkey").alias("id"), F.lit(None).cast("string").alias("up")).union(n.select(t("N", "n_nationkey"), t("R", "n_regionkey"))).union(s.select(t("S", "s_suppkey"), t("N", "s_nationkey")))
    return r.hierarchy(nodes, "id", "up")


@R.query("SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 9 = 0")
def vanished_parents(spark, d):
    o, li = load(spark, d, "orders", "lineitem")
    o = o.select(F.col("o_orderkey").alias("k"))
    return r.vanished_parents(o, o.where("k % 9 <> 0"), li.withColumnRenamed("l_orderkey", "k"), ["k"])[0]


@R.query("SELECT l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_orderkey % 9 <> 0 AND l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY 1")
def children_of_present_parents(spark, d):
    o, li = load(spark, d, "orders", "lineitem")
    o = o.select(F.col("o_orderkey").alias("k"))
    return r.vanished_parents(o, o.where("k % 9 <> 0"), li.withColumnRenamed("l_orderkey", "k"), ["k"])[1].groupBy("k").agg(F.count("*").alias("n"))


@R.query("""SELECT o_orderkey, list_sort(list(l_partkey)) AS parts FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' GROUP BY 1""")
def frame_elements(spark, d):
    o, li = load(spark, d, "orders", "lineitem")
    return o.where("o_orderstatus = 'F'").join(li, o.o_orderkey == li.l_orderkey).groupBy("o_orderkey").agg(F.array_sort(F.collect_list("l_partkey")).alias("parts"))


@R.query("SELECT l_returnflag, l_linestatus, count(*) AS n, min(l_shipdate) AS min, max(l_shipdate) AS max FROM lineitem GROUP BY 1, 2")
def count_min_max_by_group(spark, d):
    return r.count_min_max_by_group(load(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_shipdate")


_ALL = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@R.query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _ALL))
def table_row_counts(spark, d):
    return r.table_row_counts({t: load(spark, d, t) for t in _ALL})


@R.query("SELECT CASE WHEN p_size % 10 = 0 THEN 'Unknown' ELSE split_part(p_type, ' ', 1) END AS point_type, p_brand AS unit, count(*) AS n FROM part GROUP BY ALL")
def point_type_catalog(spark, d):
    p = load(spark, d, "part").withColumn("text", F.when(F.col("p_size") % 10 != 0, F.col("p_type")))
    return r.point_type_catalog(p, "text", "p_brand")


@R.query("SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN turn ELSE row_number() OVER (PARTITION BY conv_id ORDER BY turn) END::INTEGER AS ordinal FROM conversations")
def ordinal_in_group(spark, d):
    t = load(spark, d, "conversations").select("conv_id", "turn").withColumn("given", F.when(F.col("turn") % 2 == 0, F.col("turn")))
    return r.ordinal_in_group(t, ["conv_id"], ["turn"], "given").drop("given")


@R.query("SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_linenumber) - 1)::INTEGER AS result_index FROM lineitem")
def result_index(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return r.result_index(li, ["l_orderkey"], [F.desc("l_extendedprice"), F.col("l_partkey"), F.col("l_linenumber")])


@R.query("SELECT n_name, n_nationkey + 2 AS row_number FROM nation")
def row_number_with_header_offset(spark, d):
    return r.number_rows(load(spark, d, "nation").select("n_name", "n_nationkey"), "n_nationkey").select("n_name", "row_number")


@R.query("SELECT o_orderkey, left(o_orderpriority, 4) AS o_orderpriority, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10")
def recent_orders(spark, d):
    return r.recent_n(load(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate"), "o_orderdate", 10, "o_orderkey", {"o_orderpriority": 4})


@R.query("SELECT event_id, left(props, 100) AS props, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 10")
def recent_events(spark, d):
    return r.recent_n(load(spark, d, "events").select("event_id", "props", "ts"), "ts", 10, "event_id", {"props": 100})


@R.query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS price FROM orders ORDER BY price ASC NULLS LAST, o_orderkey LIMIT 50")
def sort_nulls_last_asc(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("price"))
    return r.sort_nulls_last(o, "price", True, "o_orderkey").limit(50)


@R.query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS price FROM orders ORDER BY price DESC NULLS FIRST, o_orderkey LIMIT 50")
def sort_nulls_first_desc(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("price"))
    return r.sort_nulls_last(o, "price", False, "o_orderkey").limit(50)


@R.query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100 OFFSET 250")
def page(spark, d):
    return r.page(load(spark, d, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 250, 100)


@R.query("SELECT user_id, count(*) AS n, max(ts) AS latest FROM events GROUP BY 1 ORDER BY n DESC, latest DESC, user_id LIMIT 10")
def top_groups(spark, d):
    return r.top_groups(load(spark, d, "events"), ["user_id"], "ts", 10)


@R.query("SELECT count(*) AS n FROM (SELECT DISTINCT text, lang FROM documents)")
def drop_exact_duplicates(spark, d):
    return r.drop_exact_duplicates(load(spark, d, "documents").select("text", "lang")).agg(F.count("*").alias("n"))


@R.query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_quantity) = 1")
def drop_duplicate_ids(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return r.drop_duplicate_ids(li, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_quantity"])


@R.query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 7 = 0")
def except_unchanged(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return r.except_unchanged(o, o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus"))))


@R.query("SELECT c_name AS name, c_acctbal AS balance, 'customer' AS source FROM customer UNION ALL SELECT s_name, s_acctbal, 'supplier' FROM supplier UNION ALL SELECT n_name, NULL, 'nation' FROM nation")
def union_sources(spark, d):
    c, s, n = load(spark, d, "customer", "supplier", "nation")
    return r.union_sources({"customer": c.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")), "supplier": s.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")), "nation": n.select(F.col("n_name").alias("name"))})


@R.query("SELECT o_orderkey, ntile(7) OVER (ORDER BY o_orderkey)::INTEGER AS bin FROM orders")
def contiguous_bins(spark, d):
    return r.contiguous_bins(load(spark, d, "orders").select("o_orderkey"), "o_orderkey", 7)


@R.query("""WITH RECURSIVE k AS (SELECT row_number() OVER (ORDER BY w DESC) AS i, w FROM (SELECT count(*) AS w FROM orders GROUP BY o_custkey)),
 g AS (SELECT 0::BIGINT AS i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[] AS loads, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[] AS ns UNION ALL
 SELECT i, list_transform(loads, lambda x, j: CASE WHEN j = p THEN x + w ELSE x END), list_transform(ns, lambda x, j: CASE WHEN j = p THEN x + 1 ELSE x END) FROM (SELECT k.i, w, loads, ns, list_position(loads, list_min(loads)) AS p FROM g JOIN k ON k.i = g.i + 1))
 SELECT unnest(range(8))::INTEGER AS bin, unnest(loads) AS load, unnest(ns) AS keys, unnest(ns) AS own FROM (SELECT * FROM g ORDER BY i DESC LIMIT 1)""")
def balanced_bins(spark, d):
    w = load(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("w"))
    return r.balanced_bins(w, "o_custkey", "w", 8).groupBy("bin").agg(F.sum("w").alias("load"), F.count("*").alias("keys"), F.countDistinct("o_custkey").alias("own"))
