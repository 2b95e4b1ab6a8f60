import datetime as dt

from pyspark.sql import functions as F, types as T

from cardwatch.operators import joins, project
from cardwatch.schema import REQUEST_DEFAULTS, TRANSACTION
from cardwatch.session import scratch_path
from cardwatch.sources import files, store


def write(spark, name, *lines):
    path = scratch_path(spark, name)
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(path)
    return path


SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("amt", T.DoubleType()),
])


def test_bad_rows_go_to_quarantine_whatever_is_selected(spark):
    path = write(spark, "q", "id,ts,amt", "1,bad,x", "2,2020-01-02 03:04:05,1.5", "3,2020-01-02 03:04:05,",
                 "4,2020-01-02 03:04:05,1,9", ",2020-01-02 03:04:05,1")
    good, bad = files.quarantine(files.read_checked(spark, path, SCHEMA), ["id"])
    assert [r.id for r in good.select("id").collect()] == [2, 3]
    assert good.count() == 2 and bad.count() == 3
    rows = {r["_corrupt_record"]: r for r in bad.collect()}
    assert list(rows["1,bad,x"]["_errors"]) == ["ts", "amt"] and rows["1,bad,x"].ts is None
    assert "4,2020-01-02 03:04:05,1,9" in rows


def test_declared_schema_names_the_first_column(spark):
    header = "," + ",".join(f.name for f in TRANSACTION.fields[1:])
    row = ("0,2019-01-01 00:00:18,2703186189652095,m,misc_net,4.97,Ann,Lee,F,1 St,Town,NC,01234,36.0,-81.1,"
           "3495,job,1988-03-09,abc,1325376018,36.01,-82.0,0")
    got = files.load_transactions(spark, write(spark, "csv", header, row)).first()
    assert got.id == 0 and got.zip == "01234" and got.dob == dt.date(1988, 3, 9)
    assert got.trans_date_trans_time == dt.datetime(2019, 1, 1, 0, 0, 18)
    loose = files.rename_first(spark.read.csv(write(spark, "csv2", "1,2")))
    assert loose.columns == ["id", "_c1"]


def test_written_files_read_back_equal(spark, view):
    rows = view.select("id", "trans_date_trans_time", "amt", "dob")
    path = scratch_path(spark, "round")
    files.write_csv(rows, path)
    assert sorted(files.load_transactions(spark, path, rows.schema).collect()) == sorted(rows.collect())
    parquet = scratch_path(spark, "round") + ".parquet"
    rows.write.parquet(parquet)
    assert files.load_transactions(spark, parquet, rows.schema).count() == rows.count()


def test_align_and_requests(spark):
    train = spark.createDataFrame([(1, 2.0, 1)], "id long, a double, is_fraud int")
    test = spark.createDataFrame([(5, 7)], "id long, b int")
    left, right = project.align(train, test)
    assert left.columns == ["id", "a", "b", "is_fraud"] and right.columns == ["id", "a", "b"]
    assert tuple(left.first()) == (1, 2.0, 0, 1) and tuple(right.first()) == (5, 0.0, 7)
    filled = project.request_defaults(spark.createDataFrame([(1.0, None)], "amt double, age_group int"))
    assert filled.first().age_group == 0 and set(REQUEST_DEFAULTS) <= set(filled.columns)
    assert len(REQUEST_DEFAULTS) == 14


def test_assign_by_key_is_a_left_join(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y")], "id long, v string")
    right = spark.createDataFrame([(2, "z")], "id long, v string")
    assert sorted(tuple(r) for r in joins.assign_by_key(left, right, "id", "v").collect()) == [(1, None), (2, "z")]


def test_scan_reads_only_needed_columns(spark):
    from cardwatch.plans.catalog import CATALOG

    plan = CATALOG["a_rate_hour"](spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
    orders = [l for l in plan.splitlines() if "ReadSchema" in l and "o_orderkey" in l]
    assert orders and all("o_orderpriority" not in l for l in orders)


def test_times_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    rows = [("2024-03-10 02:30:00", "2024-03-10"), ("2024-13-01 00:00:00", "2024-02-30"), ("2024-03-10", "x"), (None, None)]
    df = spark.createDataFrame(rows, "trans_date_trans_time string, dob string")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = files.parse_times(df).selectExpr("CAST(trans_date_trans_time AS STRING)", "CAST(dob AS STRING)").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [tuple(r) for r in got] == [("2024-03-10 02:30:00", "2024-03-10"), (None, None), (None, None), (None, None)]


def _scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Scan ")


def test_set_aside_and_failures_read_their_source_once(spark):
    path = scratch_path(spark, "once")
    raw = spark.range(200).selectExpr(
        "CAST(id AS STRING) AS id", "IF(id % 10 = 0, 'bad', '2.5') AS amt",
        "IF(id % 7 = 0, 'x', '2020-01-31 10:00:00') AS ts")
    raw.write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("amt", T.DoubleType()),
                           T.StructField("ts", T.TimestampNTZType())])
    checked = files.read_checked(spark, path, schema)
    good, bad, counts = files.set_aside(checked, scratch_path(spark, "aside"), ["id"])
    want_good, want_bad = files.quarantine(checked, ["id"])
    assert counts == {"good": good.count(), "bad": bad.count()} == {"good": 154, "bad": 46}
    assert sorted(good.collect()) == sorted(want_good.collect()) and good.columns == ["id", "amt", "ts"]
    assert sorted(map(str, bad.collect())) == sorted(map(str, want_bad.collect()))
    assert path not in good._jdf.queryExecution().executedPlan().toString()
    text = spark.read.schema("id string, amt string, ts string").option("header", True).csv(path)
    failures = files.count_failures(text, ["ts"], [])
    assert _scans(failures) == 1 and failures.collect()[0][:] == ("ts", 29)


def test_a_run_is_written_once_and_counts_from_its_marker(spark):
    root = scratch_path(spark, "log")
    results = spark.createDataFrame([("a", 0.5), ("b", 0.7)], "model string, score double")
    info = {m: {"model_type": "x", "num_features": 1, "features": ["f"], "scaler_available": False} for m in "ab"}
    assert store.registry(spark, root).count() == 0
    # an attempt that died before its marker is neither seen nor kept
    store._put(results.withColumn("run_id", F.lit("r/1")), f"{root}/runs")
    assert store.registry(spark, root).count() == 0
    assert store.write_summary(results, info, "b", root, "r/1")
    assert not store.write_summary(results.limit(1), info, "a", root, "r/1")
    assert store.write_summary(results.limit(1), {"a": info["a"]}, "a", root, "r2")
    rows = sorted((r.run_id, r.model, r.is_best) for r in store.registry(spark, root).collect())
    assert rows == [("r/1", "a", False), ("r/1", "b", True), ("r2", "a", True)]
    assert {r.model: r.run_id for r in store.latest_runs(store.registry(spark, root)).collect()} == {"a": "r2", "b": "r/1"}
