"""Runs, rejects, ordered files and change sets."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from panelcast.functions import semantics as sem
from panelcast.operators import conform, deliver
from panelcast.sources import rejects, tables
from panelcast.sources.runs import OTHER, Run, compare_totals


def test_totals_are_counted_while_writing_and_equal_the_control_totals(spark, tmp_path):
    rows = [("2020Q1", 1.5, 2.0), ("2020Q1", None, 1.0), ("2020Q2", 0.1, None), (None, 7.0, 7.0), ("1999Q4", 0.2, 3.0)]
    df = spark.createDataFrame(rows, "quarter string, sales double, units double")
    run = Run(spark, "r1", str(tmp_path))
    out = run.stage(df, "panel", ["sales", "units"], {"quarter": ["2020Q1", "2020Q2"]})
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(rows, key=repr)
    got = {(r.column, r.value, r.measure): (r.n_rows, r.total) for r in run.totals("panel").collect()}
    assert got["", "", "sales"] == (5, 8.8) and got["quarter", OTHER, "units"] == (2, 10.0)
    for r in conform.qc_totals(df, ["quarter"], ["sales", "units"]).collect():
        if r.quarter in ("2020Q1", "2020Q2"):
            assert (got["quarter", r.quarter, "sales"][1], got["quarter", r.quarter, "units"][1]) == (r.sales, r.units)
    assert run.totals("none").count() == 0 and run.stages() == ["panel"]


def test_a_lost_run_goes_on_and_is_cleaned_up(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def counted(df):
        def seen(batches):
            for batch in batches:
                calls.add(len(batch))
                yield batch

        return df.mapInPandas(seen, df.schema)

    df = spark.createDataFrame([(1,), (2,)], "x int")
    broken = df.withColumn("x", F.expr("CAST(raise_error('lost') AS int)"))
    with pytest.raises(Exception, match="lost"):
        with Run(spark, "r2", str(tmp_path)) as run:
            first = run.stage(counted(df), "first", ["x"])
            run.stage(broken, "second")
    assert first.count() == 2 and calls.value == 2
    with Run(spark, "r2", str(tmp_path)) as run:
        assert run.stages() == ["first"]
        again = run.stage(counted(df), "first", ["x"])
        assert calls.value == 2
        assert run.stage(again.filter("x > 1"), "second", ["x"]).count() == 1
        lost = compare_totals(run.totals("first"), run.totals("second")).first()
        assert (lost.rows_before, lost.rows_after, lost.change) == (2, 1, -1.0)
        run.drop("second")
        assert run.stages() == ["first"]
    assert not list(tmp_path.glob("run-r2*"))


def test_every_row_read_is_kept_or_rejected(spark, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text("id,Value,note\na,1.5,x\nb,oops,\nc,,y\nd,2,z,extra\ne\n,3,q\nf,-1,\"a,b\"\n", encoding="utf-8")
    columns = {"id": ("site", "string"), "Value": ("sales", "double")}
    rows = rejects.canonical_with_reasons(rejects.read_raw(spark, str(path), columns), columns)
    rows = rejects.with_rules(rows, rejects.gate_rules(["site"], ["sales"])).cache()
    assert [tuple(r) for r in rejects.kept(rows).collect()] == [("a", 1.5)]
    out = {r._raw: r.reasons for r in rejects.rejected(rows).collect()}
    assert out['{"id":"b","Value":"oops"}'] == ["sales unreadable", "sales missing"]
    assert out['{"id":"c","note":"y"}'.replace(',"note"', ',"note"')] == ["sales missing"]
    assert out["d,2,z,extra"][0] == "wrong number of fields" and out["e"][0] == "wrong number of fields"
    assert out['{"Value":"3","note":"q"}'] == ["site missing"] and out['{"id":"f","Value":"-1","note":"a,b"}'] == ["sales not positive"]
    balance = {r.reason: r.n_rows for r in rejects.balance(rows).collect()}
    assert sum(balance.values()) == 7 and balance[None] == 1
    gated = conform.validity_gate(rows.drop("_raw", "_reasons"), ["site"], ["sales"])
    unread = rows.filter(F.array_contains("_reasons", "wrong number of fields"))
    assert gated.count() == 1 + unread.filter("site IS NOT NULL AND sales > 0").count()


def test_files_keep_the_order_and_split_a_hot_key(spark, tmp_path):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.8 else rng.choice(["a", "z", None]), rng.randint(0, 5), i) for i in range(4000)]
    path = str(tmp_path / "out")
    tables.write_ordered(spark.createDataFrame(rows, "channel string, n int, id int"), path, ["channel", "n"], files=8)
    got = tables.read_ordered(spark, path)
    assert spark.read.parquet(path).groupBy(F.col("_metadata.file_name")).count().agg(F.max("count")).first()[0] < 1500
    out = sorted((r.position, r.channel, r.n, r.id) for r in got.collect())
    assert [p for p, *_ in out] == list(range(1, 4001))
    keys = [(c is None, c or "", n) for _, c, n, _ in out]
    assert keys == sorted(keys) and Counter(r[1:] for r in out) == Counter(rows)
    tables.write_ordered(spark.createDataFrame([], "channel string, n int"), path, ["channel"])
    assert tables.read_ordered(spark, path).count() == 0


def test_changes_turn_old_rows_into_new_ones(spark):
    schema = "k string, q string, x double, y string"
    old = [("a", "1", 1.0, "u"), ("b", "1", None, "u"), ("c", None, 3.0, None), ("d", "1", 4.0, "u"), ("d", "1", 4.0, "u"), ("d", "1", 5.0, "u"), ("e", "1", 1.0, "u")]
    new = [("a", "1", 1.0, "u"), ("b", "1", 2.0, "u"), ("c", None, 3.0, "v"), ("d", "1", 4.0, "u"), ("d", "1", 6.0, "u"), ("f", None, None, None)]
    a, b = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    changes = deliver.change_set(a, b, ["k", "q"]).cache()
    assert sorted((r.change, r.k) for r in changes.collect()) == [
        ("changed", "b"), ("changed", "c"), ("changed", "d"), ("inserted", "f"), ("removed", "d"), ("removed", "e")]
    for start, end in ((old, new), (new, old), (old, old), ([], new), (old, [])):
        a, b = spark.createDataFrame(start, schema), spark.createDataFrame(end, schema)
        out = deliver.apply_changes(a, deliver.change_set(a, b, ["k", "q"]), ["k", "q"])
        assert Counter(map(tuple, out.collect())) == Counter(end)


def test_only_slices_that_differ_are_matched_row_by_row(spark):
    schema = "k string, q string, x double, y double, z string"
    same = [("a", "1", 1.0, None, "u"), ("a", "1", 1.0, None, "u"), (None, "1", 0.0, float("nan"), None), ("b", None, None, None, "")]
    old = [*same, ("c", "2", None, 5.0, "u"), ("d", "3", 1.0, 1.0, "u"), ("e", "4", 1.0, 1.0, "u"), ("f", "5", 1.0, 2.0, "ab"), ("f", "5", 2.0, 1.0, "")]
    new = [*same[::-1], ("c", "2", 5.0, None, "u"), ("d", "3", 1.0, 1.0, "u"), ("d", "3", 1.0, 1.0, "u"), ("f", "5", 1.0, 1.0, "ab"), ("f", "5", 2.0, 2.0, ""), ("g", "6", 1.0, 1.0, "u")]
    a, b = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    differing = deliver.differing_slices(a, b, ["k", "q", "x", "y", "z"], ["q"])
    assert sorted(r.q for r in differing.collect()) == ["2", "3", "4", "5", "6"]
    lists = [df.withColumn("z", F.array("z")) for df in (a, b)]
    assert deliver.differing_slices(*lists, ["k", "q", "x", "y", "z"], ["q"]) is None
    for start, end in ((a, b), (b, a), (a, a), (a.filter("false"), b), (a, b.filter("false")), lists):
        plain, sliced = (deliver.change_set(start, end, ["k", "q"], s) for s in ([], ["q"]))
        assert Counter(map(str, plain.collect())) == Counter(map(str, sliced.collect()))
        out = deliver.apply_changes(start, sliced, ["k", "q"], ["q"])
        assert out.columns == a.columns and Counter(map(str, out.collect())) == Counter(map(str, end.collect()))


def test_totals_of_parts_equal_exact_sums(spark):
    values = [0.1, -0.1, 1e-9, -1234567.891, 999999999999999.0, -999999999999999.5, 123456.789, None, 5e14, 0.3]
    sets = [values, [], [None], [1e15, 2.5], [float("inf"), 1.0], [-0.000000001] * 3]
    for some in sets:
        df = spark.createDataFrame([(v,) for v in some], "x double")
        parts = df.select(*[c.alias(p) for p, c in sem.exact_parts("x").items()])
        sums = parts.agg(*[F.sum(p) for p in sem.PARTS]).first()
        assert sem.of_parts(sums) == df.agg(sem.sum0("x")).first()[0], some


def test_a_row_is_split_once_for_all_cells(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5, 1), ("b", -2.25, 2), (None, None, 3), ("c", 1e16, 4)], "k string, x double, _n int")
    run = Run(spark, "split", str(tmp_path))
    back = run.stage(df, "rows", ["x"], {"k": ["a", "b", "a"]})
    assert back.columns == df.columns and back.count() == 4
    got = [(r.column, r.value, r.n_rows, r.total) for r in run.totals().collect()]
    assert sorted(got) == sorted([
        ("", "", 4, 1e16 - 0.75), ("k", "a", 1, 1.5), ("k", "b", 1, -2.25), ("k", "a", 1, 1.5), ("k", "(other)", 2, 1e16),
    ])
