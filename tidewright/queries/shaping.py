from pyspark.sql import functions as F

from tidewright.plans import shaping as h
from tidewright.queries._tables import Registry, load

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles


def _json(*cols):
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


@R.query("SELECT c_custkey::VARCHAR AS id, c_name AS title, c_acctbal AS balance, NULL::VARCHAR AS missing FROM customer")
def flatten_paths(spark, d):
    c = load(spark, d, "customer").select(_json(F.col("c_custkey").cast("string").alias("id"), F.struct(F.col("c_name").alias("title"), F.struct(F.col("c_acctbal").alias("b")).alias("s")).alias("snippet")).alias("r"))
    return h.flatten_paths(c, "r", {"id": ("id", "string"), "title": ("snippet.title", "string"), "balance": ("snippet.s.b", "double"), "missing": ("a.b.c", "string")})


@R.query("""SELECT o_orderkey::VARCHAR AS sha, o_orderpriority AS commit_message, 'a' || o_custkey AS commit_author_name, NULL::VARCHAR AS commit_author_email, strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') AS commit_author_date,
 CASE WHEN o_orderstatus = 'F' THEN 'web' END AS commit_committer_name, CASE WHEN o_orderstatus = 'F' THEN 'c' || o_custkey || '@x.org' END AS commit_committer_email, NULL::VARCHAR AS commit_committer_date, '{"login":"u' || o_custkey || '"}' AS author FROM orders""")
def commits_flatten(spark, d):
    author = F.struct(F.concat(F.lit("a"), "o_custkey").alias("name"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"))
    committer = F.when(F.col("o_orderstatus") == "F", F.struct(F.lit("web").alias("name"), F.concat(F.lit("c"), "o_custkey", F.lit("@x.org")).alias("email")))
    commit = F.struct(F.col("o_orderpriority").alias("message"), author.alias("author"), committer.alias("committer"))
    raw = load(spark, d, "orders").select(_json(F.col("o_orderkey").cast("string").alias("sha"), commit.alias("commit"), F.struct(F.concat(F.lit("u"), "o_custkey").alias("login")).alias("author")).alias("r"))
    people = [f"commit.{who}.{f}" for who in ("author", "committer") for f in ("name", "email", "date")]
    return h.flatten_paths(raw, "r", h.by_path("sha", "commit.message", *people, "author"))


@R.query("SELECT 'k:' || o_orderkey AS id, o_custkey AS version, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS depth, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS rock FROM orders")
def osdu_flatten(spark, d):
    kind = F.when(F.col("o_orderstatus") == "F", "osdu:wks:master-data--Wellbore:1.0.0").otherwise("osdu:wks:Sample:1.0.0")
    o = load(spark, d, "orders").select(_json(F.concat(F.lit("k:"), "o_orderkey").alias("id"), kind.alias("kind"), F.col("o_custkey").alias("version"), F.struct(F.col("o_totalprice").alias("Depth"), F.col("o_orderpriority").alias("Rock")).alias("data")).alias("r"))
    return h.osdu_flatten(o, "r", {"wellbore": {"depth": ("Depth", "double")}, "sample": {"rock": ("Rock", "string")}}).select("id", "version", "depth", "rock")


@R.query("SELECT l_orderkey AS ticket, l_partkey AS id, coalesce(l_shipdate, o_orderdate) AS created, o_custkey AS requester FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'")
def comments_from_events(spark, d):
    o, li = load(spark, d, "orders", "lineitem")
    kids = li.groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_returnflag").alias("event_type"), F.col("l_partkey").alias("id"), F.col("l_shipdate").alias("created"))).alias("kids"))
    t = o.join(kids, o.o_orderkey == kids.l_orderkey).select(F.col("o_orderkey").alias("ticket"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("created"), F.col("o_custkey").alias("requester"), "kids")
    return h.child_events(t, "kids", "event_type", "R").select("ticket", "id", "created", "requester")


@R.query("SELECT user_id, ts::DATE AS date, event_id AS task, value AS time FROM events")
def time_entries(spark, d):
    e = load(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("date")).agg(F.collect_list(F.struct(F.col("event_id").alias("task"), F.col("value").alias("time"))).alias("records"))
    return h.time_entries(e, "records", ["user_id", "date"])


def _surveys(spark, d):
    c, o, li = load(spark, d, "customer", "orders", "lineitem")
    q = li.groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("heading"))).alias("questions"))
    p = o.join(q, o.o_orderkey == q.l_orderkey).groupBy("o_custkey").agg(F.collect_list(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title"), "questions")).alias("pages"))
    return c.join(p, c.c_custkey == p.o_custkey).select("c_custkey", "pages")


@R.query("SELECT o_custkey AS survey_id, o_orderkey AS page_id, l_partkey AS id, l_returnflag AS heading FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey")
def survey_questions(spark, d):
    return h.questions_and_pages(_surveys(spark, d), "c_custkey", "pages")[1]


@R.query("SELECT o_custkey AS survey_id, o_orderkey AS page_id, o_orderpriority AS title FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def survey_pages(spark, d):
    return h.questions_and_pages(_surveys(spark, d), "c_custkey", "pages")[0]


@R.query("SELECT l_orderkey AS _parent_id, 'orders' AS _parent_module, l_partkey AS part, l_quantity AS quantity FROM lineitem")
def subform_items(spark, d):
    li = load(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_partkey").alias("part"), F.col("l_quantity").alias("quantity"))).alias("items"))
    return h.subform_items(li, "l_orderkey", "orders", "items")


@R.query("SELECT event_id AS response_id, CASE WHEN event_id % 2 = 0 THEN 'own' ELSE event_type END AS recorded_date, value::VARCHAR AS answer FROM events")
def survey_responses(spark, d):
    values = F.create_map(F.lit("recordedDate"), F.concat(F.lit('"'), "event_type", F.lit('"')), F.lit("QID1"), F.concat(F.lit('{"textEntry":"'), F.col("value").cast("string"), F.lit('"}')))
    e = load(spark, d, "events").select(F.col("event_id").alias("responseId"), F.when(F.col("event_id") % 2 == 0, "own").alias("recordedDate"), values.alias("values"))
    r = h.survey_responses(e, "values", {"recordedDate": "recordedDate"}, ["recordedDate"])
    return r.select("response_id", "recorded_date", F.col("answers")["QID1"]["text_entry"].alias("answer"))


@R.query("""SELECT p_partkey::VARCHAR AS survey_id, p_name AS survey_name, '{"size":' || p_size || '}' AS survey_flow FROM part""")
def survey_definition(spark, d):
    p = load(spark, d, "part").select(_json(F.col("p_partkey").alias("SurveyID"), F.col("p_name").alias("SurveyName"), F.struct(F.col("p_size").alias("size")).alias("SurveyFlow")).alias("r"))
    return h.survey_definition(p, "r", ["SurveyID", "SurveyName"], ["SurveyFlow"])


@R.query("SELECT event_id, event_type AS browser, value AS time, user_id::VARCHAR AS custom FROM events")
def events_with_custom_props(spark, d):
    m = F.create_map(F.lit("$browser"), "event_type", F.lit("time"), F.col("value").cast("string"), F.lit("plan"), F.col("user_id").cast("string"))
    e = load(spark, d, "events").select("event_id", m.alias("p"))
    return h.events_with_custom_props(e, "p", {"$browser": "string", "time": "double"}).select("event_id", "browser", "time", F.col("custom_properties.plan").alias("custom"))


@R.query("SELECT c_custkey::VARCHAR AS id, CASE WHEN c_custkey % 4 <> 0 THEN c_name END AS name, c_acctbal AS balance, coalesce(n, 0)::INTEGER AS deals FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey")
def crm_record(spark, d):
    c, o = load(spark, d, "customer", "orders")
    ids = o.groupBy("o_custkey").agg(F.collect_list(F.struct(F.col("o_orderkey").cast("string").alias("id"))).alias("results"))
    name = F.when(F.col("c_custkey") % 4 != 0, F.col("c_name")).otherwise("")
    raw = F.to_json(F.struct(F.col("c_custkey").cast("string").alias("id"), F.struct(name.alias("name"), F.col("c_acctbal").alias("balance")).alias("properties"), F.struct(F.struct("results").alias("deals")).alias("associations")))
    r = h.crm_record(c.join(ids, c.c_custkey == ids.o_custkey, "left").select(raw.alias("r")), "r", {"name": "string", "balance": "double"}, ["deals"])
    return r.select("id", "properties.name", "properties.balance", F.size("deals_ids").alias("deals"))


@R.query('SELECT n_nationkey::VARCHAR AS "Nation_Key", CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE \'\' END AS name, n_nationkey + 2 AS row_number FROM nation')
def sheet_table(spark, d):
    n = load(spark, d, "nation")
    cells = F.when(F.col("n_nationkey") % 2 == 0, F.array(F.col("n_nationkey").cast("string"), "n_name")).otherwise(F.array(F.col("n_nationkey").cast("string")))
    grid = n.select((F.col("n_nationkey") + 1).alias("i"), cells.alias("cells")).union(spark.createDataFrame([(0, ["Nation Key", "name"])], "i int, cells array<string>"))
    return h.sheet_table(grid, "cells", "i")


@R.query("SELECT l_orderkey::VARCHAR AS id, l_linenumber AS rev, l_returnflag AS state, 'https://h/workItems/' || l_orderkey || '/revisions/' || l_linenumber AS url FROM lineitem")
def work_item_revisions(spark, d):
    fields = F.struct(F.col("l_shipdate").cast("string").alias("System.RevisedDate"), F.col("l_returnflag").alias("System.State"))
    li = load(spark, d, "lineitem").select(_json(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("rev"), fields.alias("fields")).alias("r"))
    return h.work_item_revisions(li, "r", "https://h").select("id", "rev", "state", "url")


@R.query("SELECT p_name AS event_type, p_brand AS category_name, CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END::INTEGER AS n FROM part")
def taxonomy_flatten(spark, d):
    p = load(spark, d, "part").select(_json(F.col("p_name").alias("event_type"), F.struct(F.col("p_brand").alias("name")).alias("category"), F.when(F.col("p_partkey") % 2 == 0, F.array("p_type")).alias("properties")).alias("r"))
    return h.taxonomy_flatten(p, "r").select("event_type", "category_name", F.size("properties").alias("n"))


@R.query("""SELECT p_partkey, '{"n":' || p_size || '}' AS value FROM part""")
def tickets_custom_values(spark, d):
    p = load(spark, d, "part").select("p_partkey", F.array(F.struct(F.lit("f").alias("id"), F.struct(F.col("p_size").alias("n")).alias("value"))).alias("v"))
    return h.custom_values_to_text(p, "v").select("p_partkey", F.col("v")[0]["value"].alias("value"))


@R.query("SELECT p_partkey::VARCHAR AS id, p_brand AS domain, p_size::VARCHAR AS value, 'acme' AS organisation FROM part")
def governance_records(spark, d):
    p = load(spark, d, "part").select(_json(F.col("p_partkey").alias("id"), F.struct(F.col("p_brand").alias("id"), F.lit("D").alias("name")).alias("domain"), F.col("p_size").alias("value")).alias("r"))
    return h.governance_records(p, "r", ["domain"], "value", "acme").select("id", "domain.id", "value", "organisation").toDF("id", "domain", "value", "organisation")


@R.query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%gZ') AS at, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%gZ') AS inner_at FROM orders")
def odata_clean(spark, d):
    ms = F.concat(F.lit("/Date("), F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string"), F.lit(")/"))
    o = load(spark, d, "orders").select("o_orderkey", ms.alias("at"), F.array(F.struct(ms.alias("at"), F.lit("x").alias("__deferred"))).alias("nav"), F.lit("u").alias("__metadata"))
    return h.odata_clean(o).select("o_orderkey", "at", F.col("nav")[0]["at"].alias("inner_at"))


@R.query("SELECT ts::DATE AS date, event_type AS name, count(*) AS n, sum(event_id)::DOUBLE AS total FROM events GROUP BY 1, 2")
def report_rows(spark, d):
    e = load(spark, d, "events").groupBy(F.to_date("ts").alias("d"), "event_type").agg(F.count("*").cast("string").alias("n"), F.sum("event_id").cast("string").alias("t"))
    rows = e.select(F.array(F.date_format("d", "yyyyMMdd"), "event_type").alias("dims"), F.array("n", "t").alias("mets"))
    return h.report_rows(rows, ["date", "name"], {"n": "int", "total": "double"}, "dims", "mets")
