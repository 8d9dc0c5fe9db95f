"""Plans: what reaches the scan, how often data is scanned, how it is joined."""

import re

import pytest
from pyspark.sql import functions as F

from pyspark.sql.readwriter import DataFrameWriter

from panelcast.operators import price
from panelcast.queries import REGISTRY
from panelcast.queries import bindings as b

SF = "/root/testdata/sf0.001"
PYTHON = {"knn_items", "knn_vectors", "inverse_distance_weights", "neighbour_weighted_growth",
          "growth_cascade", "apply_growth", "borrowed_price_ladder"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    """Plans of each query: of the stage tables that it writes and of its result."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    texts, write = [], DataFrameWriter.parquet

    def recorded(self, *args, **kwargs):
        texts.append(plan(self._df))
        return write(self, *args, **kwargs)

    out = {}
    DataFrameWriter.parquet = recorded
    try:
        for name, (fn, _) in REGISTRY.items():
            last = plan(fn(spark, SF))
            out[name] = "\n".join([*texts, last])
            texts.clear()
    finally:
        DataFrameWriter.parquet = write
    return out


def test_stage_plans_are_seen(plans):
    assert "lineitem.parquet" in plans["borrowed_price_ladder"] and "InPandas" in plans["borrowed_price_ladder"]


def test_no_cross_join_anywhere(plans):
    bad = [n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p]
    assert not bad


def test_python_only_in_the_nearest_neighbour_search(plans):
    used = {n for n, p in plans.items() if re.search("InPandas|EvalPython|MapInArrow", p)}
    assert used <= PYTHON


def test_price_grains_scan_transactions_once(spark):
    df = price.price_grains(b.sample(spark, SF).filter(F.col("year") == "2000"))
    assert plan(df).count("lineitem.parquet") == 1


def test_filters_and_columns_reach_the_scan(plans):
    text = plans["qc_totals"]
    scan = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    assert "l_extendedprice" in scan and "l_tax" not in scan and "l_linenumber" not in scan
    assert "IsNotNull(l_partkey)" in scan


def test_results_are_not_gathered_by_unpartitioned_windows(plans):
    for name, text in plans.items():
        assert not re.search(r"Exchange SinglePartition.*\n.*Window ", text), name


def test_rank_correlation_builds_no_universe(plans):
    assert "_place#" in plans["expand_universe"] and "_place#" not in plans["spearman_by_group"]


def test_rows_joined_to_packs_are_summed_and_looked_up_where_they_lie(spark):
    from panelcast.queries import deliver, impute

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (deliver.history(spark, "/root/testdata/sf0.001"), impute.observed(spark, "/root/testdata/sf0.001")):
            text = df._jdf.queryExecution().executedPlan().toString()
            dealt = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line]
            facts = [line for line in dealt if "quarter" in line or "city" in line]
            assert not facts, facts
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_restating_deals_no_history_by_quarter(spark):
    from panelcast.queries import deliver

    _, new = deliver.two_versions(spark, "/root/testdata/sf0.001")
    text = new._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in text.splitlines() if "LeftAnti" in line]
    assert joins and all("BroadcastHashJoin" in line for line in joins), joins


def test_imputation_stores_only_the_rows_of_its_years(plans):
    for name in ("bounded_growth", "impute_paired_period", "unpivot_compound"):
        above = plans[name].split("lineitem.parquet")[0]
        kept = [line for line in above.splitlines() if "Filter" in line and "FileScan" not in line][-1]
        assert "l_shipdate" in kept and "IN (1999,2000)" in kept, (name, kept)


def test_rows_to_impute_are_not_sorted_for_their_cells(spark):
    from panelcast.queries import impute

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = impute.imputable(impute.observed(spark, SF))
        text = plan(impute.paired(rows))
        joins = [line for line in text.splitlines() if "LeftSemi" in line]
        assert joins and all("ShuffledHashJoin" in line for line in joins), joins
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
