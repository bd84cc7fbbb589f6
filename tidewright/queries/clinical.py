from pyspark.sql import functions as F

from tidewright.plans import imaging, messages, resources
from tidewright.queries._tables import Registry, load

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles


def _messages(spark, d):
    """One message a customer with its orders and lines, rendered by Spark; half of them with other separators."""
    c, o, li = load(spark, d, "customer", "orders", "lineitem")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    obx = F.concat_ws("|", F.lit("OBX"), F.lit(""), F.lit("NM"), F.concat(F.lit("Q^quantity^L"), F.lit("")), F.lit(""), F.col("l_quantity").cast("string"), F.concat(F.lit("kg^"), F.col("l_returnflag")), *[F.lit("")] * 7, F.date_format("l_shipdate", "yyyyMMdd"))
    lines = li.select("l_orderkey", obx.alias("obx")).repartition("l_orderkey").groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_list("obx")), "\r").alias("obx"))
    obr = F.concat_ws("|", F.lit("OBR"), F.col("o_orderkey").cast("string"), F.concat(F.col("o_orderkey"), F.lit("^lab")), F.lit(""), F.concat(F.lit("C"), F.col("o_orderstatus"), F.lit("^status")), *[F.lit("")] * 2, day)
    orders = o.join(lines.hint("merge"), o.o_orderkey == lines.l_orderkey, "left").select("o_custkey", F.concat_ws("\r", obr, "obx").alias("t"))
    orders = orders.groupBy("o_custkey").agg(F.array_join(F.sort_array(F.collect_list("t")), "\r").alias("body"))
    msh = F.concat(F.lit("MSH|^~\\&|app^1.2^ISO|fac|||20240102030405||ORU^R01|M"), F.col("c_custkey"), F.lit("|P|2.5^x"))
    pid = F.concat(F.lit("PID|1||"), F.col("c_custkey"), F.lit("^^^A~X"), F.col("c_custkey"), F.lit("^^^B||"), F.regexp_replace("c_name", "#", "^\\\\T\\\\"), F.lit("||19700304|"), F.lit("M"))
    zed = F.concat(F.lit("ZZ1|"), F.col("c_mktsegment"))
    text = F.concat_ws("\r", msh, pid, zed, "body")
    # texts are taken for 20 bytes when joins are planned: broadcast, all messages would be read by the one task of a small customer table
    made = c.join(orders.hint("merge"), c.c_custkey == orders.o_custkey, "left").select("c_custkey", text.alias("t"))
    other = F.translate("t", "|^~\\&", "!@*/%")
    return made.select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, other).otherwise(F.col("t")).alias("message"))


def _segments(spark, d):
    return messages.segments(_messages(spark, d))


@R.query("SELECT 'M' || c_custkey AS message_id, 'app' AS app, '1.2' AS app_id, '2024-01-02T03:04:05Z' AS message_timestamp, '2.5' AS hl7_version FROM customer")
def hl7_msh(spark, d):
    t = messages.segment_table(_messages(spark, d), "MSH")
    return t.select("message_id", F.col("msh_3.namespace").alias("app"), F.col("msh_3.universal_id").alias("app_id"), "message_timestamp", "hl7_version")


@R.query("SELECT 'M' || c_custkey AS message_id, 1::INTEGER AS set_id, c_custkey::VARCHAR AS first_id, 'X' || c_custkey AS second_id, 'Customer' AS family, CASE WHEN c_custkey % 2 = 0 THEN '%' ELSE '&' END || split_part(c_name, '#', 2) AS given, '1970-03-04T00:00:00Z' AS born, 'M' AS sex FROM customer")
def hl7_pid(spark, d):
    t = messages.segment_table(_messages(spark, d), "PID")
    return t.select("message_id", "set_id", F.col("pid_3")[0]["id"].alias("first_id"), F.col("pid_3")[1]["id"].alias("second_id"), F.col("pid_5")[0]["family_name"].alias("family"), F.col("pid_5")[0]["given_name"].alias("given"), F.col("pid_7").alias("born"), F.col("pid_8.code").alias("sex"))


@R.query("SELECT 'M' || o_custkey AS message_id, o_orderkey::INTEGER AS set_id, o_orderkey::VARCHAR AS placer, 'lab' AS system, 'C' || o_orderstatus AS code, strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') AS at FROM orders")
def hl7_obr(spark, d):
    t = messages.segment_table(_messages(spark, d), "OBR")
    return t.select("message_id", "set_id", F.col("obr_2.id").alias("placer"), F.col("obr_2.namespace").alias("system"), F.col("obr_4.code").alias("code"), F.col("obr_7").alias("at"))


@R.query("SELECT 'M' || o_custkey AS message_id, 'quantity' AS what, l_quantity AS quantity, l_returnflag AS flag, strftime(l_shipdate, '%Y-%m-%dT00:00:00Z') AS at FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def hl7_obx(spark, d):
    t = messages.segment_table(_messages(spark, d), "OBX")
    return t.select("message_id", F.col("obx_3.text").alias("what"), F.col("obx_5")[0].cast("double").alias("quantity"), F.col("obx_6.text").alias("flag"), F.col("obx_14").alias("at"))


@R.query("SELECT 'M' || o_custkey AS message_id, count(*)::INTEGER AS last, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def hl7_set_ids(spark, d):
    return messages.segment_table(_messages(spark, d), "OBX").groupBy("message_id").agg(F.max("set_id").alias("last"), F.count("*").alias("n"))


@R.query("SELECT set_id, count(*) AS n FROM (SELECT row_number() OVER (PARTITION BY o_orderkey)::INTEGER AS set_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY 1")
def hl7_set_ids_without_message_ids(spark, d):
    li, o = load(spark, d, "lineitem", "orders")
    lines = li.join(o, li.l_orderkey == o.o_orderkey).groupBy("l_orderkey").agg(F.array_join(F.collect_list(F.concat(F.lit("OBX||NM|||"), F.col("l_quantity").cast("string"))), "\r").alias("t"))
    return messages.segment_table(lines.select(F.concat(F.lit("MSH|^~\\&|app\r"), "t").alias("message")), "OBX").groupBy("set_id").agg(F.count("*").alias("n"))


@R.query("SELECT 'M' || c_custkey AS message_id, c_mktsegment AS field_1 FROM customer")
def hl7_z_segment(spark, d):
    return messages.segment_table(_messages(spark, d), "ZZ1").select("message_id", "field_1")


@R.query("SELECT c_custkey // 10 AS file, 'M' || c_custkey AS message_id, 'fac' AS facility FROM customer")
def hl7_split_batches(spark, d):
    m = _messages(spark, d).withColumn("file", F.floor(F.col("c_custkey") / 10)).groupBy("file").agg(F.concat(F.lit("FHS|x\r\nBHS|y\r\n"), F.array_join(F.collect_list("message"), "\r\n"), F.lit("\r\nBTS|1\rFTS|1")).alias("value"))
    return messages.segment_table(messages.split_batches(m), "MSH", ("file",), names={"msh_4.namespace": "facility"}).select("file", "message_id", "facility")


@R.query("""SELECT 'M' || c_custkey AS message_id, unnest(['MSH', 'PID', 'ZZ1']) AS segment, 1 AS n FROM customer UNION ALL SELECT 'M' || o_custkey, 'OBR', count(*) FROM orders GROUP BY 1
 UNION ALL SELECT 'M' || o_custkey, 'OBX', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def hl7_segments(spark, d):
    return _segments(spark, d).groupBy("message_id", "segment").agg(F.count("*").alias("n"))


@R.query("SELECT 'M' || c_custkey AS message_id, c_custkey::VARCHAR AS patient_id, '1970-03-04T00:00:00Z' AS date_of_birth FROM customer")
def hl7_named_columns(spark, d):
    t = messages.segment_table(_messages(spark, d), "PID", names={"pid_7": "date_of_birth", "pid_3": "patient_ids"})
    return t.select("message_id", F.col("patient_ids")[0]["id"].alias("patient_id"), "date_of_birth")


def _bundles(spark, d):
    c, li, o = load(spark, d, "customer", "lineitem", "orders")
    uk = "https://fhir.hl7.org.uk/StructureDefinition/Extension-UKCore-"
    coded = lambda v: F.struct(F.struct(F.array(F.struct(v.alias("code"))).alias("coding")).alias("valueCodeableConcept"))
    ext = F.array(F.struct(F.lit(uk + "EthnicCategory").alias("url"), coded(F.col("c_mktsegment"))["valueCodeableConcept"].alias("valueCodeableConcept")))
    patient = F.to_json(F.struct(F.lit("Patient").alias("resourceType"), F.concat(F.lit("p"), "c_custkey").alias("id"), F.struct(F.lit("2024-05-06T07:08:09Z").alias("lastUpdated")).alias("meta"),
        F.array(F.struct(F.lit("https://fhir.nhs.uk/Id/nhs-number").alias("system"), F.col("c_custkey").cast("string").alias("value"))).alias("identifier"),
        F.array(F.struct(F.col("c_name").alias("family"))).alias("name"), F.lit("1980-02-03").alias("birthDate"), F.lit(True).alias("active"), ext.alias("extension")))
    obs = F.to_json(F.struct(F.lit("Observation").alias("resourceType"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("id"), F.lit("final").alias("status"),
        F.struct(F.array(F.struct(F.lit("http://loinc.org").alias("system"), F.col("l_returnflag").alias("code"))).alias("coding")).alias("code"),
        F.struct(F.col("l_quantity").alias("value"), F.lit("kg").alias("unit")).alias("valueQuantity"), F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("effectiveDateTime"),
        F.struct(F.concat(F.lit("Patient/p"), "o_custkey").alias("reference")).alias("subject")))
    rows = c.select((F.col("c_custkey") % 50).alias("b"), patient.alias("r")).union(li.join(o, li.l_orderkey == o.o_orderkey).select((F.col("o_custkey") % 50).alias("b"), obs.alias("r")))
    parts = rows.groupBy("b", F.pmod(F.xxhash64("r"), F.lit(40))).agg(F.concat(F.lit('{"resourceType":"Bundle","entry":['), F.array_join(F.collect_list(F.concat(F.lit('{"resource":'), "r", F.lit("}"))), ","), F.lit("]}")).alias("bundle"))
    return parts.select("b", "bundle").union(spark.createDataFrame([(0, '{"resourceType":"Patient"}')], "b int, bundle string"))


@R.query("SELECT 'p' || c_custkey AS id, TIMESTAMP '2024-05-06 07:08:09' AS updated, c_custkey::VARCHAR AS identifier, c_name AS family, DATE '1980-02-03' AS born, true AS active FROM customer")
def fhir_patient(spark, d):
    t = resources.resource_table(resources.bundle_entries(_bundles(spark, d), "bundle"), "Patient")
    return t.select("id", F.col("lastUpdated").cast("timestamp_ntz").alias("updated"), F.col("identifier")[0]["value"].alias("identifier"), F.col("name")[0]["family"].alias("family"), F.col("birthDate").alias("born"), "active")


@R.query("SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id, 'final' AS status, l_returnflag AS code, l_quantity AS quantity, 'kg' AS unit, l_shipdate AS at, 'Patient/p' || o_custkey AS subject FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def fhir_observation(spark, d):
    t = resources.resource_table(resources.bundle_entries(_bundles(spark, d), "bundle"), "Observation")
    return t.select("id", "status", F.col("code.coding")[0]["code"].alias("code"), F.col("valueQuantity.value").alias("quantity"), F.col("valueQuantity.unit").alias("unit"), F.col("effectiveDateTime").cast("timestamp_ntz").alias("at"), F.col("subject.reference").alias("subject"))


@R.query("SELECT 'p' || c_custkey AS id, c_custkey::VARCHAR AS nhs_number, c_mktsegment AS ethnicity, NULL::VARCHAR AS birth_sex FROM customer")
def fhir_profile_overlay(spark, d):
    resources.register_uk_core()
    t = resources.resource_table(resources.bundle_entries(_bundles(spark, d), "bundle"), "Patient", profile="uk_core")
    return t.select("id", "nhs_number", "ethnicity", "birth_sex")


def _studies(spark, d):
    value = lambda vr, *v: F.struct(F.lit(vr).alias("vr"), F.array(*v).alias("Value"))
    o = load(spark, d, "orders")
    name = F.struct(F.lit("PN").alias("vr"), F.array(F.struct(F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("P^"), "o_custkey")).alias("Alphabetic"), F.lit("ideo").alias("Ideographic"))).alias("Value"))
    raw = F.to_json(F.struct(F.when(F.col("o_orderkey") % 3 != 0, value("UI", F.concat(F.lit("1.2."), "o_orderkey"))).alias("0020000D"), value("DA", F.date_format("o_orderdate", "yyyyMMdd")).alias("00080020"), name.alias("00100010"),
        value("CS", F.lit("CT"), "o_orderstatus").alias("00080061"), value("IS", F.col("o_custkey")).alias("00201206"), value("UI", F.concat(F.lit("9."), "o_orderkey")).alias("0020000E"), value("CS", "o_orderstatus").alias("00080060"), value("DS", F.col("o_totalprice")).alias("00180050")))
    return o.select("o_orderkey", F.concat(F.lit("1.2."), "o_orderkey").alias("study_id"), raw.alias("raw_json"))


@R.query("SELECT CASE WHEN o_orderkey % 3 <> 0 THEN '1.2.' || o_orderkey END AS study_instance_uid, strftime(o_orderdate, '%Y%m%d') AS study_date, CASE WHEN o_orderkey % 2 = 0 THEN 'P^' || o_custkey ELSE 'ideo' END AS patient_name, o_orderstatus AS second, o_custkey::INTEGER AS number_of_series FROM orders")
def imaging_studies(spark, d):
    t = imaging.studies(_studies(spark, d))
    return t.select("study_instance_uid", "study_date", "patient_name", F.col("modalities_in_study")[1].alias("second"), "number_of_series")


@R.query("SELECT '1.2.' || o_orderkey AS study_instance_uid, '9.' || o_orderkey AS series_instance_uid, o_orderstatus AS modality FROM orders")
def imaging_series(spark, d):
    return imaging.series(_studies(spark, d)).select("study_instance_uid", "series_instance_uid", "modality")


@R.query("SELECT '1.2.' || o_orderkey AS study_instance_uid, '9.' || o_orderkey AS series_instance_uid, o_totalprice AS slice_thickness FROM orders")
def imaging_instances(spark, d):
    s = _studies(spark, d)
    return imaging.instances(s.drop("study_id"), imaging.series(s)).select("study_instance_uid", "series_instance_uid", "slice_thickness")
