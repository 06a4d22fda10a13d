import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxsieve.operators import align
from rxsieve.operators.history import VARIABLE_COLUMNS, history_rows
from rxsieve.params import CampaignParams
from rxsieve.plans.load import append_history, load_table, prepare_load, record_variables
from rxsieve.sources import reports, tables

RUN = CampaignParams(campaign_id=30, run_ts=dt.datetime(2024, 3, 4, 5, 6, 7, 890000))


def test_column_metadata():
    schema = T.StructType(
        [
            T.StructField("ID", T.LongType(), False),
            T.StructField("Name", T.StringType()),
            T.StructField("born", T.DateType()),
            T.StructField("seen", T.TimestampType()),
            T.StructField("raw", T.BinaryType()),
            T.StructField("rate", T.DecimalType(9, 2)),
        ]
    )
    info = align.column_metadata(schema)
    assert [(c.name, c.varnum, c.type) for c in info] == [
        ("id", 0, 1), ("name", 1, 2), ("born", 2, 2), ("seen", 3, 2), ("raw", 4, 2), ("rate", 5, 1),
    ]
    assert (info[0].length, info[1].length, info[5].format) == ("REQUIRED", "NULLABLE", "decimal(9,2)")


def test_align_fills_orders_and_drops(spark):
    source = spark.createDataFrame([(1, "x", "gone")], "Key long, NAME string, extra string")
    target = T._parse_datatype_string(
        "memo string, name string, opened date, key long, score double, at timestamp, raw binary"
    )
    assert align.unmatched_columns(source.schema, target) == ["memo", "opened", "score", "at", "raw"]
    aligned = align.align_to_target(source, target)
    assert [(f.name, f.dataType) for f in aligned.schema] == [(f.name, f.dataType) for f in target]
    assert tuple(aligned.first()) == ("", "x", None, 1, None, None, None)


def test_only_printable_text_is_loaded(spark):
    source = spark.createDataFrame([("a\u0000b\tcé~ ", 1)], "t string, n int")
    assert align.strip_unprintable(source, RUN).first().t == "abc~ "
    assert align.strip_unprintable(source, CampaignParams(campaign_id=99)).first().t == "a\u0000b\tcé~ "


def test_append_projection(spark):
    source = spark.createDataFrame([(7, "x")], "ROW_GID int, b string").withColumn("DQI_TS", F.current_timestamp())
    row = align.append_projection(source, RUN)
    assert row.columns == ["row_gid", "b", "dqi_ts"]
    assert tuple(row.withColumn("dqi_ts", F.col("dqi_ts").cast("string")).first()) == (1, "x", "2024-03-04 05:06:07.89")


def test_aware_run_time_keeps_its_moment(spark):
    zone = dt.timezone(dt.timedelta(hours=2))
    run = CampaignParams(run_ts=dt.datetime(2024, 3, 4, 7, 6, 7, tzinfo=zone))
    assert spark.range(1).select(align.load_time(run).cast("string")).first()[0] == "2024-03-04 05:06:07"
    assert spark.range(1).select(align.load_time(CampaignParams()).isNotNull()).first()[0]


def test_load_appends_by_position(spark):
    spark.sql("create table load_target (row_gid int, name string, memo string, dqi_ts timestamp) using parquet")
    try:
        absent = load_table(spark.createDataFrame([("ü1",)], "NAME string"), "load_target", RUN)
        assert absent == (3, ["row_gid", "memo", "dqi_ts"])
        load_table(spark.createDataFrame([("2",)], "NAME string"), "load_target", RUN)
        got = spark.table("load_target").selectExpr("row_gid", "name", "memo", "cast(dqi_ts as string)")
        assert sorted(map(tuple, got.collect())) == [
            (1, "1", "", "2024-03-04 05:06:07.89"),
            (1, "2", "", "2024-03-04 05:06:07.89"),
        ]
    finally:
        tables.drop_table(spark, "load_target")
    assert not tables.table_exists(spark, "load_target")


@pytest.fixture
def variables(spark):
    return spark.createDataFrame([tuple(f"{c} {i}" for c in VARIABLE_COLUMNS) for i in range(3)], VARIABLE_COLUMNS)


def test_history_rows_have_whole_seconds(variables):
    row = history_rows(variables, RUN).withColumn("dqi_ts", F.col("dqi_ts").cast("string")).first()
    assert (row.row_gid, row.dqi_ts) == (1, "2024-03-04 05:06:07")


@pytest.mark.parametrize(("flag", "target"), [("Y", "dqi_process_macros"), ("N", "dqi_process_macros_dev")])
def test_record_variables(spark, variables, flag, target):
    run = CampaignParams(production=flag, run_ts=RUN.run_ts)
    assert record_variables(spark, "no_such_table", run) is False
    tables.replace_table(variables, "run_variables")
    # The history names its columns differently: rows go in by position.
    names = ", ".join(f"h{i} string" for i in range(10))
    spark.sql(f"create table {target} (row_gid int, {names}, dqi_ts timestamp) using parquet")
    try:
        assert record_variables(spark, "run_variables", run) is True
        assert record_variables(spark, "run_variables", run) is True
        stored = spark.table(target)
        assert stored.count() == 6 and stored.first().h9.startswith("dqi_job_id")
        stats = spark.sql(f"describe extended {target} row_gid").where("info_name = 'distinct_count'").first()
        assert stats.info_value == "1"
    finally:
        tables.drop_table(spark, target)
        tables.drop_table(spark, "run_variables")


def test_reports(spark, tmp_path):
    rows = spark.createDataFrame([("b", 2), ("a", 1)], "k string, v int")
    path = reports.write_report(rows, str(tmp_path), "validate_drug_quality", order_by=["k"])
    assert [r.k for r in spark.read.option("header", True).csv(path).collect()] == ["a", "b"]
    parquet = reports.write_report(rows, str(tmp_path), "duplicates", fmt="parquet")
    assert spark.read.parquet(parquet).count() == 2


@pytest.mark.parametrize(
    ("run", "name"),
    [
        (CampaignParams(campaign_id=30, program_type="P"), "validate_drug_quality"),
        (CampaignParams(campaign_id=557, program_type="P"), "P_validate_drug_quality"),
        (CampaignParams(campaign_id=553, formulary_run_type="F"), "F_validate_drug_quality"),
        (CampaignParams(campaign_id=562, formulary_run_type="F"), "F_validate_drug_quality"),
    ],
)
def test_report_names(run, name):
    assert reports.quality_report_name(run) == name


def test_prepared_load_needs_no_job(spark):
    source = spark.createDataFrame([(1,)], "c_custkey long")
    assert prepare_load(source, spark.createDataFrame([], "row_gid int, c_custkey long"), RUN).columns == [
        "row_gid",
        "c_custkey",
    ]


def test_history_is_appended_once_for_each_run(spark, variables):
    run = CampaignParams(production="Y", run_ts=RUN.run_ts)
    spark.sql("create schema runs")
    try:
        name = append_history(variables, run, "it's 1", "runs")
        assert name == "runs.dqi_process_macros"
        append_history(variables.limit(1), run, "2", "runs")
        files = set(spark.table(name).where("run_key = '2'").inputFiles())
        append_history(variables, run, "it's 1", "runs")
        assert {r.run_key: r["count"] for r in spark.table(name).groupBy("run_key").count().collect()} == {"it's 1": 3, "2": 1}
        assert files <= set(spark.table(name).inputFiles())
        assert tables.read_statistics(spark, name, "row_gid") == (4, 1, 0)
        # a run that is recorded again without rows leaves none
        append_history(variables.limit(0), run, "it's 1", "runs")
        assert [r.run_key for r in spark.table(name).select("run_key").collect()] == ["2"]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    finally:
        spark.sql("drop schema runs cascade")


def test_schema_difference(spark):
    source = spark.createDataFrame([(1, None, "x"), (2, "a", None)], "KEY long, Name string, extra string")
    target = T._parse_datatype_string("name string, opened date, key long")
    assert [tuple(r) for r in align.schema_difference(source, target).collect()] == [
        ("name", 1, 0, 2, 2, "both", 1), ("opened", None, 1, None, 2, "target", 0), ("key", 0, 2, 1, 1, "both", 2), ("extra", 2, None, 2, None, "source", 1),
    ]
    assert align.schema_difference(source.limit(0), source.schema).count() == 3
