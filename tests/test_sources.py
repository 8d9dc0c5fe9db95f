"""Readers, writers and stage tables."""

import pytest
from pyspark.sql import functions as F

from panelcast.sources import schemas, stages, tables


def test_delimited_input_is_selected_by_heading(spark, tmp_path):
    path = tmp_path / "universe.csv"
    path.write_text(
        "extra,省,地级市,区[县/县级市】,单位名称,PCHC_Code,其中：西药药品收入（千元）\n"
        "1,江苏,苏州,区,医院,P01,12.5\n2,江苏,苏州,区,其他,P02,n/a\n",
        encoding="utf-8",
    )
    df = tables.read_delimited(spark, str(path), schemas.SITE_UNIVERSE)
    assert df.columns == ["province", "city", "district", "hospital", "site", "est"]
    assert [(r.site, r.est) for r in df.orderBy("site").collect()] == [("P01", 12.5), ("P02", None)]


def test_pipe_separated_input(spark, tmp_path):
    path = tmp_path / "corp.txt"
    path.write_text("Corp_ID|Corp_Desc\n7|A, B\n")
    assert tables.read_delimited(spark, str(path), schemas.CORPORATIONS, "|").first().corp_desc == "A, B"


def test_headings_with_dots_and_blanks(spark, tmp_path):
    path = str(tmp_path / "bid")
    spark.createDataFrame([("1", "a", "b", "c", "d")], "`Pack_ID` string, `Display Name1 CN` string,"
                          " `Display Name2 CN` string, `Display Name3 CN` string, `x.y` string").write.parquet(path)
    columns = {**schemas.BID_MAPPING, "x.y": ("alt", "string")}
    assert tables.read_parquet(spark, path, columns).first().asDict() == {
        "packid": "1", "name1": "a", "name2": "b", "name3": "c", "alt": "d"}


def test_period_sink_replaces_only_its_periods(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("2020Q1", 1), ("2020Q2", 2)], "quarter string, x int")
    tables.write_periods(df, path)
    tables.write_periods(df.filter("quarter = '2020Q2'").withColumn("x", F.lit(9)), path)
    got = tables.read_periods(spark, path, ["2020Q2"])
    assert [r.x for r in got.collect()] == [9]
    assert "PartitionFilters: [isnotnull" in got._jdf.queryExecution().toString() or "quarter" in str(
        got._jdf.queryExecution().executedPlan())
    assert tables.read_periods(spark, path).count() == 2


def test_delivery_as_delimited_text(spark, tmp_path):
    path = str(tmp_path / "export")
    df = spark.createDataFrame([("中标, x", 1.5), (None, 2.0)], "label string, sales double")
    tables.write_delimited(df, path)
    columns = {"label": ("label", "string"), "sales": ("sales", "double")}
    got = {(r.label, r.sales) for r in tables.read_delimited(spark, path, columns).collect()}
    assert got == {("中标, x", 1.5), (None, 2.0)}


def test_stage_uses_the_shared_folder(spark, tmp_path):
    assert stages.stage_folder(spark)
    df = stages.stage(spark.range(5).toDF("x"), "numbers")
    assert df.count() == 5 and "numbers-" in df.inputFiles()[0]


def test_stages_go_to_shared_folders_only():
    class Session:
        class conf:  # noqa: N801
            settings = {"spark.sql.warehouse.dir": "store://house/"}

            @classmethod
            def get(cls, key, default=None):
                return cls.settings.get(key, default)

    assert stages.stage_folder(Session) == "store://house/stages"
    Session.conf.settings["spark.checkpoint.dir"] = "store://shared"
    assert stages.stage_folder(Session) == "store://shared"
