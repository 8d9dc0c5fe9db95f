"""The stored history: restating, pruning, joins without a shuffle, opening in another session."""

import re

import pytest

from panelcast.queries import history as q
from panelcast.sources.history import History

SCHEMA = "packid string, city string, sales double, units double, quarter string"
ROWS = [
    (f"{p:07d}", c, float(p), 1.0, t)
    for p in range(40) for c in ("A", "B") for t in ("1999Q1", "2000Q1", "2000Q2")
] + [(None, "A", 1.5, 2.0, "2000Q1"), ("0000001", None, 2.5, None, "1999Q1"), ("0000001", "A", 1.0, 1.0, "2000Q1")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.select("packid", "city", "sales", "units", "quarter").collect()), key=repr)


@pytest.fixture
def store(spark, tmp_path):
    name = f"history_{tmp_path.name}"
    return History(spark, name, str(tmp_path / "h"), ("packid", "city"), 4).create(spark.createDataFrame(ROWS, SCHEMA))


def test_rows_come_back_and_only_asked_periods_are_read(store):
    assert rows(store.rows()) == sorted(ROWS, key=repr)
    some = store.rows(["2000Q1"])
    assert rows(some) == sorted((r for r in ROWS if r[4] == "2000Q1"), key=repr)
    assert re.search(r"PartitionFilters: \[.*2000Q1", plan(some))


def test_periods_are_replaced_also_by_nothing_and_from_the_history_itself(store, spark):
    more = store.rows().selectExpr("packid", "city", "sales + 1 AS sales", "units", "quarter").filter("quarter <> '2000Q2'")
    store.replace(more, ["2000Q1", "2000Q2"])
    expected = [r for r in ROWS if r[4] == "1999Q1"] + [(*r[:2], r[2] + 1, *r[3:]) for r in ROWS if r[4] == "2000Q1"]
    assert rows(store.rows()) == sorted(expected, key=repr)
    store.replace(more.filter("false"), ["1998Q4"])
    assert rows(store.rows()) == sorted(expected, key=repr)


def test_an_empty_history_is_stored_and_filled(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    empty = History(spark, "history_empty", str(tmp_path / "h"), ("packid", "city"), 2).create(none)
    assert empty.rows().count() == 0
    empty.replace(spark.createDataFrame(ROWS, SCHEMA), ["2000Q2"])
    assert rows(empty.rows()) == sorted((r for r in ROWS if r[4] == "2000Q2"), key=repr)


def test_files_are_opened_under_another_name(store, spark):
    other = History(spark, store.table + "_again", store.path, store.keys, store.buckets).open(store.rows().schema)
    assert rows(other.rows()) == sorted(ROWS, key=repr)
    assert "Exchange hashpartitioning" not in plan(other.rows().groupBy("packid", "city").count())


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_growth_and_consolidation_move_no_row_of_the_history(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        history = q.deliver.history(spark, "/root/testdata/sf0.001")
        for store, use in ((q.stored(spark, history), q.growth), (q.stored(spark, history, ("product", "city")), q.consolidated)):
            text = plan(use(store))
            assert "Exchange" not in text.replace("BroadcastExchange", ""), text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_buckets_grow_with_the_rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert q.stored(spark, df).buckets == q.BUCKETS
    store = q.stored(spark, df, bucket_rows=20)
    assert store.buckets == -(-len(ROWS) // 20) > q.BUCKETS
    assert rows(store.rows()) == sorted(ROWS, key=repr)
    assert "Exchange hashpartitioning" not in plan(store.rows().groupBy("packid", "city").count())
