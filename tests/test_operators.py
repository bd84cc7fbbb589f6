"""Small adversarial tables: ties, late rows, deletes, nulls, empty input, wrong shapes."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions import scalars as s
from tidewright.functions.conform import conform, conform_strict
from tidewright.operators import cdc, cursors, quality, relational, reports, scans, timeseries
from tidewright.plans import messages, resources
from tidewright.sources import files
from tidewright.streaming import merges
from tidewright.streaming.merges import Table, ingest

CHANGE = "k string, seq int, v string, gone boolean"


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), CHANGE)


def values(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_scd1_ties_nulls_and_deletes(spark):
    df = changes(spark, ("a", 1, "x", False), ("a", 1, "y", True), ("b", 1, "x", True), ("b", 2, "back", False), (None, 1, "n", False), ("c", None, "n", False))
    assert values(cdc.scd1(df, ["k"], "seq", "gone"), "k", "v") == [("b", "back")]  # at equal sequence a delete wins
    assert cdc.rejected_changes(df, ["k"], "seq").count() == 2
    again = cdc.scd1(df.union(df), ["k"], "seq", "gone", keep_tombstones=True)
    assert values(again, "k", "v") == [("a", "y"), ("b", "back")]
    assert cdc.scd1(df.limit(0), ["k"], "seq").count() == 0


def test_late_upsert_does_not_bring_a_deleted_row_back(spark):
    state = cdc.scd1(changes(spark, ("a", 5, "x", True)), ["k"], "seq", "gone", keep_tombstones=True)
    state = cdc.scd1_merge(state, changes(spark, ("a", 3, "late", False)), ["k"], "seq", "gone")
    assert values(state, "k", "seq", "gone") == [("a", 5, True)]


def test_scd2_late_row_splits_and_delete_closes(spark):
    first = changes(spark, ("a", 1, "x", False), ("a", 9, "z", True))
    late = changes(spark, ("a", 5, "y", False))
    merged = cdc.scd2_merge(cdc.scd2(first, ["k"], "seq", "gone"), first, late, ["k"], "seq", "gone")
    assert values(merged, "v", "valid_from", "valid_to") == [("x", 1, 5), ("y", 5, 9)]
    assert values(merged, "is_current") == [(False,), (False,)]


def test_snapshots_with_null_cells(spark):
    a = spark.createDataFrame([(1, None), (2, "b"), (3, "c")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, None), (4, "d")], "k int, v string")
    assert values(cdc.snapshot_changes(a, b, ["k"]), "change", "k") == [("delete", 3), ("insert", 4), ("update", 2)]
    assert values(cdc.snapshot_scd1(a, b, ["k"]), "k", "v") == [(1, None), (2, None), (4, "d")]


def test_snapshots_with_null_and_repeated_keys(spark):
    a = spark.createDataFrame([(None, "n"), (1, "x"), (1, "x"), (2, "old")], "k int, v string")
    b = spark.createDataFrame([(None, "n"), (1, "x"), (2, "new"), (2, "new")], "k int, v string")
    assert values(cdc.snapshot_changes(a, b, ["k"]), "change", "k", "v") == [("update", 2, "new")]
    assert values(cdc.snapshot_scd1(a, b, ["k"]), "k", "v") == [(1, "x"), (2, "new"), (None, "n")]
    assert values(cdc.snapshot_changes(a, b.limit(0), ["k"]), "change", "k") == [("delete", 1), ("delete", 2), ("delete", None)]
    history = a.distinct().selectExpr("k", "v", "1 AS valid_from", "cast(null AS int) AS valid_to")
    second = cdc.snapshot_scd2(history, b, ["k"], 2)
    assert values(second, "k", "v", "valid_from", "valid_to") == [(1, "x", 1, None), (2, "new", 2, None), (2, "old", 1, 2), (None, "n", 1, None)]
    third = cdc.snapshot_scd2(second, b.where("k = 1"), ["k"], 3)
    assert values(third, "k", "v", "valid_from", "valid_to") == [(1, "x", 1, None), (2, "new", 2, 3), (2, "old", 1, 2), (None, "n", 1, 3)]


def test_equal_sequences_have_one_order(spark):
    schema = "k int, seq int, a string, b string, m map<string,int>, s struct<x:int,y:int>"
    rows = [(1, 1, "v", None, {"p": 1}, (1, None)), (1, 1, None, "v", {"p": 1}, (1, None)), (1, 1, "v", None, {"p": 1}, (None, 1)), (1, 1, None, None, None, None)]
    found = {repr(cdc.scd1(spark.createDataFrame(order, schema).repartition(n), ["k"], "seq").collect()) for order in (rows, rows[::-1], rows[2:] + rows[:2]) for n in (1, 3)}
    assert len(found) == 1


def test_tombstone_keys(spark):
    df = spark.createDataFrame([("Orders(1)",), ("Orders(OrderID=2)",), ("Other(1)",), ("Orders(x=1)",), (None,)], "ref string")
    out = cdc.tombstone_keys_from_ref(df, "ref", "Orders", {"OrderID": "int"})
    assert [(r.OrderID, r.key_error) for r in out.collect()][:4] == [(1, None), (2, None), (1, "other collection: Other"), (None, "key not found")]


def test_caps_with_ties(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (2,), (2,), (None,)], "c int")
    assert cursors.soft_cap(df, "c", 3).count() == 5
    assert cursors.trim_ties(df, "c", 3).count() == 2
    assert cursors.trim_ties(df, "c", 1).count() == 0
    assert cursors.redrain_on_stuck_cap(df, "c", 1).count() == 6
    assert cursors.soft_cap(df.limit(0), "c", 3).count() == 0


def test_keyset_needs_a_tie_break(spark):
    df = spark.createDataFrame([(1, None)], "c int, k int")
    with pytest.raises(Exception, match="k is null"):
        cursors.keyset_after(df, "c", "k", (1, 0)).collect()


def test_cursor_keys_of_mixed_texts(spark):
    df = spark.createDataFrame([("999",), ("1000",), ("2024-01-01T00:00:00.5Z",), ("2024-01-01T00:00:00Z",), ("2024-01-01T01:00:00+02:00",), ("zzz",)], "c string")
    got = [r.c for r in df.orderBy(cursors.cursor_key(F.col("c"))).collect()]
    assert got == ["999", "1000", "2024-01-01T01:00:00+02:00", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00.5Z", "zzz"]
    assert cursors.cursor_max(df, "c").first()[0] == "zzz"


def test_null_cursor_modes(spark):
    df = spark.createDataFrame([(None,), (datetime(2024, 1, 1),)], "c timestamp_ntz")
    assert cursors.null_cursor(df, "c", "floor", 1970).orderBy("cursor_key").first()["cursor_key"] == datetime(1970, 1, 1)
    assert cursors.null_cursor(df, "c", "ignore").count() == 1
    with pytest.raises(Exception, match="c is null"):
        cursors.null_cursor(df, "c", "error").collect()


def test_filter_check(spark):
    df = spark.createDataFrame([(1,)], "c int")
    with pytest.raises(ValueError):
        cursors.check_filter_honoured(df, "c", 1)
    assert cursors.check_filter_honoured(df.limit(0), "c", 1).count() == 0


TRUTH = [
    ("3.7", "int", 3), ("12", "bigint", 12), ("", "int", None), ("abc", "int", None), ("1e3", "double", 1000.0), ("x", "double", None), ("YES", "boolean", True), ("0", "boolean", False), ("maybe", "boolean", True),
    ("", "boolean", None), ("2024-02-30", "date", None), ("02/03/2024", "date", datetime(2024, 2, 3).date()), ("03-02-2024", "date", datetime(2024, 2, 3).date()), ("2024/02/03", "date", datetime(2024, 2, 3).date()),
    ("2024-02-03T04:05:06Z", "timestamp", datetime(2024, 2, 3, 4, 5, 6)), ("2024-02-03T04:05:06+01:00", "timestamp", datetime(2024, 2, 3, 3, 5, 6)), ("1700000000", "timestamp", datetime(2023, 11, 14, 22, 13, 20)), ("1.25", "decimal(5,2)", "1.25"), ("68656c6c6f", "binary", b"hello"), ("aGVsbG8=", "binary", b"hello"), ("hi!", "binary", b"hi!"),
]


@pytest.mark.parametrize("text,kind,want", TRUTH)
def test_coercion(spark, text, kind, want):
    schema = T.StructType([T.StructField("x", T._parse_datatype_string(kind))])
    df = conform(spark.createDataFrame([(text,), (None,)], "x string"), schema)
    if kind == "timestamp":
        df = df.withColumn("x", F.col("x").cast("timestamp_ntz"))
    got = [r[0] for r in df.collect()]
    assert got[1] is None
    assert (str(got[0]) if isinstance(want, str) else bytes(got[0]) if isinstance(want, bytes) else got[0]) == want


def test_conform_nested_and_strict(spark):
    want = T.StructType([T.StructField("a", T.ArrayType(T.IntegerType())), T.StructField("s", T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.StringType())])), T.StructField("must", T.StringType(), False)])
    df = spark.createDataFrame([("5", ("7", 1), "m"), ("[1,2]", (None, None), None)], "a string, s struct<x:string,z:int>, must string")
    rows = conform(df, want).collect()
    assert rows[0].a == [5] and rows[0].s.x == 7 and rows[0].s.y is None and rows[1].a == [1, 2]
    good, bad = conform_strict(df, want)
    assert good.count() == 1 and bad.first().reasons == ["must: missing"]


def test_names_and_times(spark):
    assert [s.snake_case(x) for x in ("recordedDate", "HTTPName", "n_name", "A", "startTime2")] == ["recorded_date", "http_name", "n_name", "a", "start_time2"]
    assert [s.safe_column_name(x, i) for i, x in enumerate(["a b!", "", None, "__x__"])] == ["a_b", "_col1", "_col2", "x"]
    df = spark.createDataFrame([("2024",), ("202403",), ("20240305101112.5-0500",), ("(20240305)",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(s.hl7_ts(F.col("t"))).collect()] == ["2024-01-01T00:00:00Z", "2024-03-01T00:00:00Z", "2024-03-05T15:11:12Z", "2024-03-05T00:00:00Z", None, None]
    df = spark.createDataFrame([("/Date(-1234567890000)/",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(s.sap_date(F.col("t"))).collect()] == ["1930-11-18T00:28:30.000Z", "x", None]


def test_message_parsing(spark):
    text = "FHS|x\r\nMSH|^~\\&|a|||||||id1||2.4\rPID|||1^^^A~2\rOBX||NM|c||5\r\nOBX|7|NM|c||a\\T\\b\\S\\c\\.br\\\nMSH|no"
    rows = messages.split_batches(spark.createDataFrame([(text,), ("PID|only",), (None,), ("",)], "value string"))
    assert messages.segments(rows).groupBy("segment").count().count() == 3
    obx = messages.segment_table(rows, "OBX").orderBy("set_id").collect()
    assert [r.set_id for r in obx] == [1, 7] and obx[1].obx_5 == ["a&b^c\\.br\\"]
    pid = messages.segment_table(rows, "PID").first()
    assert [x.id for x in pid.pid_3] == ["1", "2"] and pid.message_id == "id1"
    assert messages.segment_table(rows, "ZZZ").count() == 0


def test_names_of_people_keep_all_components(spark):
    text = "MSH|^~\\&|a\rPV1|1|I|||||77^Fam^Given^M^S^Dr^MD^T^AUTH&1.2&ISO^L^9^M10^NPI^FAC&3.4&DNS^I^^^F^20240101^20250101^Prof\rPID|1||||A^B^C^D^E^F^G^H^I^^K^20240101^20250101^N^O"
    df = spark.createDataFrame([(text,)], "message string")
    d = messages.segment_table(df, "PV1").first().pv1_7[0]
    assert (d.id, d.assigning_authority, d.assigning_authority_universal_id, d.assigning_authority_universal_id_type, d.identifier_type_code, d.assigning_facility_universal_id_type, d.professional_suffix) == ("77", "AUTH", "1.2", "ISO", "NPI", "DNS", "Prof")
    n = messages.segment_table(df, "PID").first().pid_5[0]
    assert (n.family_name, n.name_context, n.name_assembly_order, n.called_by) == ("A", "I", "K", "O")


def test_names_for_columns_and_registered_kinds(spark):
    df = spark.createDataFrame([("MSH|^~\\&|app^1.2|||||||m1\rZQ1|1|7^left|aB|x~y",)], "message string")
    msh = messages.segment_table(df, "MSH", names={"msh_3.namespace": "sending_application", "msh_10": "control_id"}).first()
    assert (msh.sending_application, msh.control_id, msh.msh_3.universal_id) == ("app", "m1", "1.2")
    with pytest.raises(ValueError, match="MSH has no msh_99"):
        messages.segment_table(df, "MSH", names={"msh_99": "x"})
    messages.register_kind("ZPOS", "number side")
    messages.register_kind("ZUP", convert=F.upper)
    messages.register_segment("ZQ1", 4, {"SI": "1", "ZPOS": "2", "ZUP": "3 4*"})
    try:
        row = messages.segment_table(df, "ZQ1").first()
        assert (row.zq1_2.number, row.zq1_2.side, row.zq1_3, row.zq1_4) == ("7", "left", "AB", ["X", "Y"])
    finally:
        del messages.SEGMENTS["ZQ1"], messages.COMPOSITES["ZPOS"], messages._plain["ZUP"]


def test_registered_metrics_and_dimensions(spark):
    e = spark.createDataFrame([(datetime(2024, 1, d), d % 2, "view", float(d)) for d in (1, 2, 3)], "ts timestamp_ntz, user_id int, event_type string, value double")
    reports.register_metric("largest", lambda: F.max("value"))
    reports.register_dimension("odd", lambda: F.col("user_id") == 1)
    try:
        assert values(reports.report(e, ["odd"], ["largest"]), "odd", "largest") == [(False, 2.0), (True, 3.0)]
    finally:
        del reports.METRICS["largest"], reports.DIMENSIONS["odd"]


def test_every_declared_segment_builds(spark):
    rows = spark.createDataFrame([("MSH|^~\\&|a",)], "message string")
    for name in messages.SEGMENTS:
        assert len(messages.segment_table(rows, name).columns) == messages.SEGMENTS[name][0] + 5


def test_every_declared_resource_builds(spark):
    df = spark.createDataFrame([('{"resourceType":"Bundle","entry":[{"resource":{"resourceType":"Goal","id":"g","startDate":"2024-01-02","note":[{"text":"t"}]}}]}',), ("{}",), (None,)], "b string")
    entries = resources.bundle_entries(df, "b")
    assert resources.rejected_bundles(df, "b").count() == 2
    for name in resources.RESOURCES:
        got = resources.resource_table(entries, name).collect()
        assert len(got) == (name == "Goal")
        if got:
            assert got[0].startDate == datetime(2024, 1, 2).date() and got[0].note[0].text == "t"


def test_series_edges(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 1, 0, 30), 1.0), ("b", datetime(2024, 1, 1), 1.0), ("b", datetime(2024, 1, 1, 2), 3.0)], "tag string, ts timestamp_ntz, value double")
    got = values(timeseries.interpolated(df, 3600), "tag", "ts", "value")
    assert got == [("b", datetime(2024, 1, 1, h), 1.0 + h) for h in range(3)]  # a lone point between grid times has none
    assert timeseries.interpolated(df.limit(0), 3600).count() == 0
    frames = spark.createDataFrame([(1, 5, None), (2, 1, 2), (3, 9, 12)], "i int, start int, end int")
    assert values(timeseries.event_frames_overlapping(frames, 2, 9), "i") == [(1,)]


def test_report_rules(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    with pytest.raises(ValueError, match="unknown names: nope"):
        reports.report(e, ["date"], ["nope"])
    with pytest.raises(ValueError):
        reports.report(e, ["date"] * 10, ["eventCount"])
    with pytest.raises(ValueError):
        reports.report(e, ["date"], [])


def test_projection_and_padding_keep_keys(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError):
        relational.select_keep_keys(df, ["b"], ["a"])
    with pytest.raises(ValueError):
        relational.pad_to_schema(df, T.StructType([T.StructField("k", T.LongType())]), ["k"])
    with pytest.raises(ValueError):
        quality.primary_key_check(df, ["zz"])


def test_streams_run_again_without_new_files_and_with_late_ones(spark):
    source, target = files.scratch(spark, "source"), files.scratch(spark, "target")
    df = spark.createDataFrame([(1, 5, False), (2, 1, False)], "k int, seq int, gone boolean")
    df.limit(0).write.parquet(source)
    run = lambda: merges.stream_scd1(merges.stream_table(spark, source, df.schema), target, ["k"], "seq", "gone")
    assert run().count() == 0
    df.write.mode("append").parquet(source)
    assert values(run(), "k", "seq") == [(1, 5), (2, 1)] == values(run(), "k", "seq")
    df.selectExpr("k", "seq + 5 AS seq", "true AS gone").where("k = 2").write.mode("append").parquet(source)
    df.selectExpr("k", "2 AS seq", "gone").write.mode("append").parquet(source)  # late
    assert values(run(), "k", "seq") == [(1, 5)]
    counts = lambda: merges.collect_complete(merges.stream_table(spark, source, df.schema).groupBy("k").count(), f"{target}-counts")
    assert values(counts(), "k", "count") == [(1, 2), (2, 3)] == values(counts(), "k", "count")
    rows = merges.replay_windows(df, "seq", ["0", "3", "9"], f"{target}-replay")
    assert values(rows, "k") == [(1,), (2,)] == values(merges.replay_windows(df, "seq", ["0", "3", "9"], f"{target}-replay"), "k")


def _bytes(spark, df):
    place = lambda f: spark._jvm.org.apache.hadoop.fs.Path(f)
    return sum(place(f).getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place(f)).getLen() for f in df.inputFiles())


@pytest.mark.parametrize("kind", ["scd1", "scd2"])
def test_logs_fold_and_reads_stay_small(spark, monkeypatch, kind):
    monkeypatch.setattr(merges, "FANOUT", 3)
    source, target = files.scratch(spark, "source"), files.scratch(spark, "target")
    schema = "k int, seq int, v string, gone boolean"
    merge = {"scd1": merges.stream_scd1, "scd2": merges.stream_scd2}[kind]
    plain = {"scd1": cdc.scd1, "scd2": cdc.scd2}[kind]
    everything, reads = [], []
    for n in range(12):
        rows = [(n % 4, 10 * n, f"v{n}", False), (9, 200 - 7 * n, f"late{n}", n % 3 == 0), (100 + n, 1, "own", False), (None, 1, "no key", False)]
        everything += rows
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        got = merge(merges.stream_table(spark, source, spark.createDataFrame([], schema).schema), target, ["k"], "seq", "gone")
        reads.append(len(merges.Log(spark, f"{target}/data", None).ranges()))
        if n in (4, 11):
            assert values(got, *got.columns) == values(plain(spark.createDataFrame(everything, schema), ["k"], "seq", "gone"), *got.columns)
    log = merges.Log(spark, f"{target}/data", got.schema)
    assert (0, 9) in log.ranges() and merges._widest(log.ranges()) == [(0, 9), (9, 12)] and max(reads) <= 9
    again = merges.Log(spark, f"{target}/data", spark.createDataFrame([], schema).schema)
    again.write(spark.createDataFrame(everything[:4], schema), 0)  # a batch that comes again after its fold
    got = merge(merges.stream_table(spark, source, again.schema), target, ["k"], "seq", "gone")
    assert values(got, *got.columns) == values(plain(spark.createDataFrame(everything, schema), ["k"], "seq", "gone"), *got.columns) and (0, 1) not in again.ranges()


def test_snapshot_runs_count_empty_ones_and_write_open_versions_only(spark):
    source, target = files.scratch(spark, "source"), files.scratch(spark, "target")
    schema = "k int, open string, run int"
    run = lambda rows: merges.snapshot_history(spark.createDataFrame(rows, schema), target, ["k"])
    assert run([]).count() == 0
    assert values(run([(1, "a", 0), (None, "n", 0)]), "k", "open", "valid_from", "valid_to", "is_current") == [(1, "a", 2, None, True), (None, "n", 2, None, True)]
    assert values(run([(1, "b", 0)]), "k", "open", "valid_from", "valid_to") == [(1, "a", 2, 3), (1, "b", 3, None), (None, "n", 2, 3)]
    assert values(run([]), "k", "valid_to") == [(1, 3), (1, 4), (None, 3)]
    wrote = []
    for n in range(5):
        got = run([(i, f"{n}-{i}", n) for i in range(200)])
        wrote.append(_bytes(spark, spark.read.parquet(f"{target}/runs/__run={5 + n}")))
    assert got.count() == 3 + 5 * 200 and got.where("is_current").count() == 200 and max(wrote[1:]) < 1.2 * min(wrote[1:])
    spark.createDataFrame([(1, "a", 0), (1, "a", 0), (2, "b", 0), (None, "n", 0)], schema).write.parquet(source)
    job = lambda: ingest(spark, [Table("t", source, ["k"], ingestion_type="snapshot")], f"{target}-job")["t"]
    first = job()
    assert values(first, "k") == [(1,), (2,), (None,)]
    spark.createDataFrame([(2, "c", 0)], schema).write.mode("overwrite").parquet(source)
    assert values(first, "k") == [(1,), (2,), (None,)]  # stored, not read from the source again
    assert values(job(), "k", "open") == [(2, "c")]


def test_a_full_refresh_takes_null_keys_as_equal(spark):
    a = spark.createDataFrame([(None, 1, "old"), (1, None, "old"), (2, 2, "old")], "a int, b int, v string")
    b = spark.createDataFrame([(None, 1, "new"), (1, None, "new"), (None, None, "new")], "a int, b int, v string")
    assert values(cdc.full_refresh_upsert(a, b, ["a", "b"]), "a", "b", "v") == [(1, None, "new"), (2, 2, "old"), (None, 1, "new"), (None, None, "new")]


def test_strict_conforming_looks_inside(spark):
    want = T.StructType([T.StructField("s", T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.StringType(), False)])), T.StructField("a", T.ArrayType(T.IntegerType())), T.StructField("m", T.MapType(T.StringType(), T.DoubleType()))])
    df = spark.createDataFrame([(("1", "y"), ["1", None], {"k": "1.5"}), (("abc", None), ["1", "zz"], {"k": "x"}), (None, None, None)], "s struct<x:string,y:string>, a array<string>, m map<string,string>")
    good, bad = conform_strict(df, want)
    assert good.count() == 2 and good.where("s is not null").first().a == [1, None]
    assert bad.first().reasons == ["s.x: not a int", "s.y: missing", "a[]: not a int", "m[]: not a double"]
    texts = spark.createDataFrame([("{\"x\": 1, \"y\": \"z\"}", "[1, 2]", None), ("{\"x\": \"b\", \"y\": \"z\"}", "[1, \"b\"]", None), ("{broken", "7", None)], "s string, a string, m string")
    good, bad = conform_strict(texts, want)
    assert good.first().a == [1, 2] and sorted(r.reasons for r in bad.collect()) == [["s.x: not a int", "a[]: not a int"], ["s: not a struct<x:int,y:string>"]]
    ntz = T.StructType([T.StructField("t", T.TimestampNTZType())])
    assert conform(spark.createDataFrame([("2024-02-03T04:05:06Z",)], "t string"), ntz).first().t == datetime(2024, 2, 3, 4, 5, 6)


def test_bins_take_the_least_loaded(spark):
    rows = [(i, w) for i, w in enumerate([9, 7, 7, 3, 3, 3, 1, 1, 0, None])]
    got = relational.balanced_bins(spark.createDataFrame(rows, "k int, w int"), "k", "w", 3)
    loads = {r.bin: r.load for r in got.groupBy("bin").agg(F.sum("w").alias("load")).collect()}
    assert got.count() == 10 and sorted(loads.values()) == [11, 11, 12] and sorted(r.k for r in got.collect()) == list(range(10))
    assert relational.balanced_bins(spark.createDataFrame([], "k int, w int"), "k", "w", 3).count() == 0


def test_caps_over_many_values(spark):
    df = spark.range(20_000).selectExpr("id", "id div 3 AS c", "cast(id div 3 AS string) AS t")
    for n in (1, 2, 3, 7000, 7001, 19_999, 20_000, 30_000):
        assert cursors.soft_cap(df, "c", n).count() == min(20_000, -(-n // 3) * 3)
        assert cursors.trim_ties(df, "c", n).count() == (20_000 if n >= 20_000 else n // 3 * 3)
    assert cursors.soft_cap(df, "t", 4).count() == 6  # text has no ranges


def test_ingest_rejects_unknown_types(spark):
    with pytest.raises(ValueError, match="unknown ingestion type"):
        ingest(spark, [Table("t", "/none", ["k"], "s", ingestion_type="other")], "/none")
    with pytest.raises(ValueError, match="keys and a sequence"):
        ingest(spark, [Table("t", "/none")], "/none")


@pytest.mark.parametrize("column", ["id", "t", "at", "d"])
def test_caps_and_bins_over_any_cursor(spark, column):
    df = spark.range(5000).selectExpr("id", "lpad(cast(id AS string), 6, '0') AS t", "timestamp_seconds(id * 7) AS at", "cast(id AS decimal(12,2)) / 3 AS d").repartition(5)
    for n in (1, 99, 100, 4999, 5000, 6000):
        got = cursors.soft_cap(df, column, n)
        assert [r.id for r in got.orderBy("id").collect()] == list(range(min(n, 5000)))
        assert got.count() == cursors.trim_ties(df, column, n).count()
    plan = cursors._cut(df, column, 100, True)._jdf.queryExecution().executedPlan().toString()
    window = plan[plan.index("Window") :]
    assert "hashpartitioning(__r" in window and "SinglePartition" not in window  # only the last maximum meets in one place
    bins = relational.contiguous_bins(df, column, 7)
    assert {(r.bin, r.n, r.low) for r in bins.groupBy("bin").agg(F.count("*").alias("n"), F.min("id").alias("low")).collect()} == {(b + 1, 715 if b < 2 else 714, 714 * b + min(b, 2)) for b in range(7)}
    assert relational.contiguous_bins(df.limit(0), column, 7).count() == 0


def test_scans_in_pieces_equal_windows(spark):
    hot = spark.range(4000).selectExpr("if(id % 50 = 0, null, if(id % 7 = 0, id % 3, 9)) AS k", "id * 13 % 4000 AS t", "if(id % 5 = 0, null, id) AS v")
    asked = {"a": ("previous", "v"), "b": ("next", "v"), "c": ("upto", "v"), "d": ("from", "v")}
    whole, cut = scans.with_neighbours(hot, ["k"], ["t"], asked), scans.with_neighbours(hot, ["k"], ["t"], asked, 16)
    assert cut.columns == whole.columns and values(cut, *cut.columns) == values(whole, *whole.columns)
    one, many = scans.running_sum(hot, ["k"], ["t"], "v", "s"), scans.running_sum(hot, ["k"], ["t"], "v", "s", 16)
    assert values(many.where("v is not null"), "k", "t", "s") == values(one.where("v is not null"), "k", "t", "s")
    assert scans.with_neighbours(hot.limit(0), ["k"], ["t"], asked, 16).count() == 0


def test_neighbours_take_one_pass(spark):
    hot = spark.range(200_000).selectExpr("1 AS k", "id AS t", "if(id % 1000 = 999, id, null) AS v")
    asked = {"a": ("previous", "v"), "b": ("next", "v"), "c": ("upto", "v"), "d": ("from", "v")}
    got = scans.with_neighbours(hot, ["k"], ["t"], asked)
    assert "unboundedfollowing" not in got._jdf.queryExecution().executedPlan().toString().lower()  # such a frame is read again for each row
    wrong = got.where("not (a <=> if(t < 1000, null, t div 1000 * 1000 - 1) and b <=> if(t < 199999, if(t % 1000 = 999, t + 1000, t div 1000 * 1000 + 999), null) and c <=> if(t < 999, null, (t + 1) div 1000 * 1000 - 1) and d <=> t div 1000 * 1000 + 999)")
    assert wrong.count() == 0


def test_hot_tags_users_and_keys_in_pieces(spark):
    series = spark.range(3000).selectExpr("if(id % 9 = 0, id % 4, 99) AS tag", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 37 % 90000) AS ts", "cast(id % 101 AS double) AS value", "id AS event_id")
    times = spark.range(300).selectExpr("if(id % 5 = 0, id % 4, 99) AS tag", "timestamp_ntz'2023-12-31 23:00:00' + make_dt_interval(0, 0, 0, id * 331) AS at")
    same = lambda a, b: a.columns == b.columns and values(a, *a.columns) == values(b, *b.columns)
    distinct = series.dropDuplicates(["tag", "ts"])
    assert same(timeseries.as_of(distinct, times), timeseries.as_of(distinct, times, pieces=12))
    assert same(timeseries.interpolated(series, 600), timeseries.interpolated(series, 600, pieces=12))
    assert same(timeseries.time_weighted(series, 3600), timeseries.time_weighted(series, 3600, pieces=12))
    assert same(timeseries.sessions(series, "tag", gap_seconds=120), timeseries.sessions(series, "tag", gap_seconds=120, pieces=12))
    assert same(cdc.scd2(series, ["tag"], "ts"), cdc.scd2(series, ["tag"], "ts", pieces=12))
    users = series.withColumnRenamed("tag", "user_id")
    assert same(reports.with_sessions(users, 120), reports.with_sessions(users, 120, pieces=12))
    plan = timeseries.sessions(series, "tag", gap_seconds=120, pieces=12)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(tag" in plan and "__piece" in plan
    assert timeseries.sessions(series.limit(0), "tag", pieces=12).count() == 0


@pytest.mark.parametrize("line_end", ["\r", "\n", "\r\n"])
def test_message_files_are_split_among_tasks(spark, line_end):
    import os

    path = files.scratch(spark, "hl7")
    os.makedirs(path)
    made = [line_end.join([f"MSH|^~\\&|app|MSH{i}|||2024||ADT^A01|m{i}|P|2.5", f"PID|1||{i}^^^x||Name{i}^MSH|"] + ["OBX|1|ST|c||" + "v" * (i % 300)]) for i in range(3000)]
    body = f"FHS|^~\\&|batch{line_end}BHS|^~\\&|b{line_end}" + line_end.join(made) + f"{line_end}BTS|3000{line_end}FTS|1{line_end}"
    for name, text in (("a.hl7", body), ("b.hl7", made[0]), ("c.hl7", "")):
        with open(f"{path}/{name}", "w", newline="") as f:
            f.write(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        got = files.read_message_records(spark, path, "*.hl7", line_end=line_end[-1])
        assert got.rdd.getNumPartitions() >= 8 and got.count() == 3001
        by_record = messages.split_batches(got.select("value", "file"))
        whole = messages.split_batches(files.read_message_files(spark, path, "*.hl7").select("value", "file"))
        text = F.regexp_replace("message", "\\n+$", "")  # the last line end goes with the cut
        assert values(by_record.select("file", text.alias("m")), "file", "m") == values(whole.select("file", text.alias("m")), "file", "m")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_deep_hierarchies_and_cycles(spark):
    chain = spark.range(3000).selectExpr("cast(id AS int) AS id", "cast(if(id = 0, null, id - 1) AS int) AS up")
    got = relational.hierarchy(chain, "id", "up")
    assert got.count() == 3000 and got.where("depth <> node").count() == 0
    bad = spark.createDataFrame([(1, None), (2, 1), (10, 12), (11, 10), (12, 11), (13, 12), (14, 13), (20, 20), (30, 99), (31, 30), (None, 1)], "id int, up int")
    assert values(relational.hierarchy(bad, "id", "up"), "node", "depth") == [(1, 0), (2, 1)]
    want = [(10, "cycle", 10), (11, "cycle", 10), (12, "cycle", 10), (13, "below cycle", 10), (14, "below cycle", 10), (20, "cycle", 20), (30, "orphan", 99), (31, "orphan", 99)]
    assert values(relational.hierarchy_faults(bad, "id", "up"), "node", "fault", "at") == want
    assert relational.hierarchy(bad.limit(0), "id", "up").count() == 0 and relational.hierarchy_faults(chain, "id", "up").count() == 0


def test_hierarchies_broadcast_nothing(spark):
    nodes = spark.range(64).selectExpr("id", "if(id % 8 = 7, id - 5, if(id % 8 = 0, -1, id + 1)) AS up")
    faults = relational.hierarchy_faults(nodes, "id", "up")
    assert faults.count() == 64 and "Broadcast" not in faults._jdf.queryExecution().executedPlan().toString()



def test_bins_over_continuous_weights_stay_at_one_level(spark):
    df = spark.range(40_000).selectExpr("id", "if(id < 3, 900.0 * (id + 1), if(id % 1000 = 7, null, (id * 7919 % 100003) / 100003.0)) AS w")
    total = df.agg(F.sum("w")).first()[0]
    for deal in (relational.level_bins, relational.balanced_bins):  # more weights than are dealt one by one
        got = deal(df, "id", "w", 9)
        loads = [r.load for r in got.groupBy("bin").agg(F.sum("w").alias("load")).collect()]
        assert got.count() == 40_000 and got.select("id").distinct().count() == 40_000
        assert len(loads) == 9 and max(loads) <= max(total / 9, 2700) + total / (16 * 9)
    assert relational.level_bins(df.where("w is null"), "id", "w", 3).count() == 40
    with pytest.raises(ValueError, match="negative"):
        relational.level_bins(df.withColumn("w", -F.col("w")), "id", "w", 3)


def test_reports_count_users_and_sessions_by_levels(spark):
    events = spark.range(900).selectExpr("id AS event_id", "if(id % 11 = 0, null, id % 13) AS user_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 977 % 400000) AS ts", "if(id % 5 = 0, 'purchase', 'view') AS event_type", "if(id % 7 = 0, null, cast(id AS double)) AS value")
    metrics = ["eventCount", "activeUsers", "newUsers", "sessions", "engagedSessions", "engagementRate", "bounceRate", "averageSessionDuration", "eventsPerUser", "averageValue"]
    got = reports.report(events, ["date", "eventName"], metrics)
    assert "Expand" not in got._jdf.queryExecution().optimizedPlan().toString()
    full = reports.with_sessions(reports.with_new_vs_returning(events))
    want = full.groupBy(F.to_date("ts").alias("date"), F.col("event_type").alias("eventName")).agg(*(reports.METRICS[m]().alias(m) for m in metrics))
    r = lambda df: [tuple(round(x, 6) if isinstance(x, float) else x for x in row) for row in values(df, *df.columns)]
    assert r(got) == r(want) and got.agg(F.sum("eventCount")).first()[0] == 900
    assert reports.report(events, [], ["activeUsers", "newUsers"]).first()[:] == (13, 13)
    assert "Expand" not in reports.report(events.withColumns({c: F.lit("x") for c in ("sessionSource", "sessionMedium")}), *reports.PRESETS["user_acquisition"])._jdf.queryExecution().optimizedPlan().toString()


def test_interleaved_files_are_skipped_on_every_column(spark):
    import glob

    import pyarrow.parquet as pq

    df = spark.range(40_000).selectExpr("id", "id * 7919 % 40009 AS a", "concat('k', lpad(cast(id * 104729 % 40009 AS string), 6, '0')) AS b", "if(id % 100 = 0, null, date'2024-01-01' + cast(id * 31 % 365 AS int)) AS c")

    def read(write, column, low, high):
        path = files.scratch(spark, "clustered")
        write(df, path, ["a", "b", "c"], 32)
        met = 0
        for name in glob.glob(f"{path}/*.parquet"):
            meta = pq.ParquetFile(name).metadata
            for g in range(meta.num_row_groups):
                stats = next(c for c in (meta.row_group(g).column(i) for i in range(meta.num_columns)) if c.path_in_schema == column).statistics
                met += stats is None or not stats.has_min_max or (stats.min <= high and stats.max >= low)
        assert spark.read.parquet(path).count() == 40_000
        return met

    asked = {"a": (1000, 2000), "b": ("k001000", "k002000"), "c": (datetime(2024, 3, 1).date(), datetime(2024, 3, 9).date())}
    plain = {c: read(files.write_clustered, c, *x) for c, x in asked.items()}
    mixed = {c: read(files.write_interleaved, c, *x) for c, x in asked.items()}
    assert plain["b"] >= 30 and plain["c"] >= 30 and mixed["b"] <= 20 and mixed["c"] <= 20 and mixed["a"] <= 20
    with pytest.raises(ValueError, match="no order"):
        files.interleaved(df.withColumn("m", F.create_map("a", "b")), ["m"])


def test_clustered_files_grow_with_the_table(spark, monkeypatch):
    import glob

    monkeypatch.setattr(files, "RANGE_ROWS", 1000)
    df = spark.range(20_000).selectExpr("id * 7919 % 20000 AS a", "id AS b")
    for write in (files.write_clustered, files.write_interleaved):
        for least, want in ((4, 15), (None, 15), (32, 28)):
            path = files.scratch(spark, "clustered")
            write(df, path, ["a"], least)
            assert len(glob.glob(f"{path}/*.parquet")) >= want and spark.read.parquet(path).agg(F.count("*"), F.sum("b")).first() == (20_000, 199_990_000)


@pytest.mark.parametrize("kind", sorted(messages.COMPOSITES))
def test_composites_give_every_component(spark, kind):
    parts = [name.split("/") for name in messages.COMPOSITES[kind].split()]
    text = "^".join("&".join(f"v{i}.{k}" for k in range(len(names))) for i, names in enumerate(parts))
    messages.register_segment("ZZ9", 2, {kind: "1 2*"})
    try:
        msg = spark.createDataFrame([(f"MSH|^~\\&|a|b|||2024||ADT^A01|m|P|2.5\rZZ9|{text}|{text}~x",)], "message string")
        row = messages.segment_table(msg, "ZZ9").first()
    finally:
        del messages.SEGMENTS["ZZ9"]
    want = {n: f"v{i}.{k}" for i, names in enumerate(parts) for k, n in enumerate(names)}
    assert row.zz9_1.asDict() == want == row.zz9_2[0].asDict() and len(want) == sum(map(len, parts)) and len(row.zz9_2) == 2


# How many fields each segment table has.
FIELD_COUNTS = {"MSH": 28, "EVN": 7, "PID": 40, "PD1": 23, "PV1": 54, "PV2": 50, "NK1": 41, "MRG": 7, "AL1": 6, "IAM": 30, "DG1": 26, "PR1": 25, "ORC": 38, "OBR": 55, "OBX": 33, "NTE": 9, "SPM": 35, "IN1": 55, "GT1": 57, "FT1": 56, "RXA": 29, "SCH": 28, "TXA": 28}


def test_segments_have_all_fields_of_known_kinds_once():
    assert {k: n for k, (n, _) in messages.SEGMENTS.items()} == FIELD_COUNTS
    known = {*messages.COMPOSITES, *messages._plain, "DR"}
    for name, (count, kinds) in messages.SEGMENTS.items():
        places = [int(p.strip("*")) for of in kinds.values() for p in of.split()]
        assert set(kinds) <= known and len(set(places)) == len(places) and max(places) <= count, name


def test_resources_have_their_nested_parts(spark):
    import json

    ref, concept = {"reference": "X/1"}, {"text": "t"}
    sent = {
        "DocumentReference": {"content": [{"attachment": {"contentType": "text/plain", "url": "u", "size": 5}, "format": {"code": "f"}}], "context": {"encounter": [ref], "period": {"start": "2024"}}},
        "Encounter": {"participant": [{"type": [concept], "individual": ref}], "diagnosis": [{"condition": ref, "rank": 1}], "hospitalization": {"admitSource": concept}, "location": [{"location": ref, "status": "active"}]},
        "Observation": {"component": [{"code": concept, "valueQuantity": {"value": 1.5}}], "referenceRange": [{"low": {"value": 1}, "text": "r"}], "hasMember": [ref], "derivedFrom": [ref]},
        "Coverage": {"class": [{"value": "v"}], "order": 2}, "Procedure": {"performer": [{"actor": ref}], "complication": [concept], "report": [ref]},
    }
    bundle = json.dumps({"resourceType": "Bundle", "entry": [{"resource": {"resourceType": k, "id": k, **v}} for k, v in sent.items()]})
    entries = resources.bundle_entries(spark.createDataFrame([(bundle,)], "b string"), "b")
    row = lambda k: resources.resource_table(entries, k).first()
    d, e, o = row("DocumentReference"), row("Encounter"), row("Observation")
    assert (d["content"][0].attachment.url, d["content"][0].attachment.size, d["content"][0].format.code, d["context"].encounter[0].reference) == ("u", 5, "f", "X/1")
    assert (e.participant[0].individual.reference, e.diagnosis[0]["rank"], e.hospitalization.admitSource.text, e.location[0].status) == ("X/1", 1, "t", "active")
    assert (o.component[0].valueQuantity.value, o.referenceRange[0].text, o.hasMember[0].reference, o.derivedFrom[0].reference) == (1.5, "r", "X/1", "X/1")
    assert row("Coverage")["class"][0].value == "v" and row("Procedure").performer[0].actor.reference == "X/1"
    assert all(resources.resource_table(entries, k).count() == (k in sent) for k in resources.RESOURCES)


def test_message_queries_broadcast_no_messages(spark, sf_dir):
    """Planned by texts of 20 bytes, the rendered messages were broadcast and read by the one task of the customer table."""
    from tidewright.queries import clinical

    for name in ("hl7_obx", "hl7_obr", "hl7_segments"):
        plan = getattr(clinical, name)(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_segments_are_rewritten_line_by_line(spark):
    """Only the lines asked for are rewritten; before, whole messages were, and all their lines were kept in both forms."""
    from tidewright.plans import messages

    df = spark.createDataFrame([("MSH|^~\\&|a||||2024||X|M1|P|2.5\r\n\r\nOBX||NM|a\\S\\b^c\nOBX|7|NM|d\rOBXY|1\r",), ("MSH!@*/%!a!!!!2024!!X!M2!P!2.5\rOBX!!NM!a/S/b@c",), ("PID|1\rOBX|1|NM|x",), (None,)], "message string")
    made = messages.segment_table(df, "OBX")
    assert sorted(tuple(r) for r in made.select("message_id", "set_id", "obx_3.code", "obx_3.text").collect()) == [("M1", 1, "a^b", "c"), ("M1", 7, "d", None), ("M2", 1, "a@b", "c")]
    plan = made.select("obx_3.code")._jdf.queryExecution().optimizedPlan().toString()
    assert "arrays_zip" not in plan
    assert sorted(tuple(r) for r in messages.segments(df).select("message_id", "ordinal", "segment").collect()) == [("M1", 0, "MSH"), ("M1", 1, "OBX"), ("M1", 2, "OBX"), ("M1", 3, "OBXY"), ("M2", 0, "MSH"), ("M2", 1, "OBX")]
