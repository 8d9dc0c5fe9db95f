"""One test per rule on NULL, ordering and arithmetic."""

from pyspark.sql import functions as F

from panelcast.functions import semantics as sem


def values(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_missing_keys_match_each_other(rows):
    left = rows("a string, b int, x int", ("k", None, 1), (None, 1, 2), ("z", 9, 3))
    right = rows("a string, b int, y int", ("k", None, 10), (None, 1, 20), ("q", 8, 30))
    assert values(sem.null_safe_join(left, right, ["a", "b"]), "x", "y") == [(1, 10), (2, 20)]
    full = sem.null_safe_join(left, right, ["a", "b"], "full")
    assert values(full, "a", "b", "x", "y") == sorted(
        [("k", None, 1, 10), (None, 1, 2, 20), ("z", 9, 3, None), ("q", 8, None, 30)], key=repr
    )
    assert values(sem.null_safe_join(left, right, ["a", "b"], "right"), "a", "y") == sorted(
        [("k", 10), (None, 20), ("q", 30)], key=repr
    )
    assert sem.null_safe_join(left, right, ["a", "b"], "left_anti").count() == 1


def test_empty_sum_is_zero_and_sums_are_exact(rows):
    df = rows("g string, x double", ("a", None), ("b", 0.1), ("b", 0.2), ("b", None), ("c", -1.25))
    out = df.groupBy("g").agg(sem.sum0("x").alias("s"), sem.exact_sum("x").alias("e"))
    assert values(out, "g", "s", "e") == sorted(
        [("a", 0.0, None), ("b", 0.3, 0.3), ("c", -1.25, -1.25)], key=repr
    )


def test_sum_does_not_depend_on_partitioning(spark):
    df = spark.range(20000).select((F.col("id") * 0.37 + 1e7).alias("x"))
    sums = {
        df.repartition(n).agg(sem.sum0("x").alias("s")).first()["s"] for n in (1, 3, 7)
    }
    assert len(sums) == 1


def test_ratio_without_infinities(rows):
    df = rows("a double, b double", (0.0, 0.0), (1.0, 0.0), (0.0, 2.0), (1.0, 4.0))
    assert [r.q for r in df.select(sem.ratio("a", "b").alias("q")).collect()] == [
        None, None, 0.0, 0.25,
    ]


def test_growth_bounds(rows):
    df = rows("g double", (None,), (0.05,), (0.1,), (1.0,), (10.0,), (11.0,))
    got = [r.g for r in df.select(sem.bounded_or("g", 1.0, 0.1, 10.0).alias("g")).collect()]
    assert got == [1.0, 1.0, 0.1, 1.0, 10.0, 1.0]


def test_three_valued_conditional(rows):
    df = rows("c boolean", (True,), (False,), (None,))
    out = df.select(sem.if_else3(F.col("c"), F.lit(1), F.lit(2)).alias("v")).collect()
    assert [r.v for r in out] == [1, 2, None]


def test_negated_tests_keep_missing_values(rows):
    df = rows("t string", ("AMP 1",), ("TAB 1",), (None,))
    assert values(df.filter(sem.not_matching("t", "AMP")), "t") == [("TAB 1",), (None,)]
    assert values(df.filter(sem.not_in("t", ["TAB 1"])), "t") == [("AMP 1",), (None,)]


def test_ids_are_padded_and_never_cut(rows):
    df = rows("i string", ("123",), ("1234567",), ("123456789",), (None,))
    assert [r.i for r in df.select(sem.pad_id("i").alias("i")).collect()] == [
        "0000123", "1234567", "123456789", None,
    ]


def test_first_valid_is_by_rank_then_value(rows):
    df = rows(
        "k int, r int, v string", (1, 0, None), (1, 1, "b"), (1, 1, "a"), (1, 2, "0"), (2, 0, None)
    )
    out = df.groupBy("k").agg(
        sem.first_valid("v", "r").alias("f"), sem.last_valid("v", "r").alias("l")
    )
    assert values(out, "k", "f", "l") == [(1, "a", "0"), (2, None, None)]


def test_lookup_never_multiplies_rows(rows):
    left = rows("k string, x int", ("a", 1), ("b", 2), (None, 3))
    table = rows("k string, v string, w int", ("a", None, 1), ("a", "p", 2), ("a", "q", 0), (None, "n", 5))
    out = sem.lookup_join(left, table, ["k"], ["v", "w"])
    assert values(out, "x", "v", "w") == [(1, "p", 2), (2, None, None), (3, "n", 5)]


def test_half_even_rounding(rows):
    df = rows("x double", (0.5,), (1.5,), (2.5,))
    assert [r.y for r in df.select(F.bround("x", 0).alias("y")).collect()] == [0.0, 2.0, 2.0]
    assert df.select(F.bround(F.lit(0.125), 2).alias("y")).first().y == 0.12


def test_fan_out_join_equals_a_plain_join(spark):
    left = spark.range(50).select(
        F.col("id").cast("string").alias("site"),
        F.when(F.col("id") < 40, "big").when(F.col("id") < 45, "small").alias("area"),
    )
    right = spark.createDataFrame(
        [("big", i) for i in range(7)] + [(None, 1), (None, 2), ("unused", 3)], "area string, pack int"
    )
    for how in ("inner", "left"):
        plain = sem.null_safe_join(left, right, ["area"], how)
        cut = sem.fan_out_join(left, right, ["area"], "site", how, rows_per_task=6)
        assert cut.columns == plain.columns
        assert values(cut, "site", "area", "pack") == values(plain, "site", "area", "pack")


def test_one_hot_area_is_written_by_many_tasks(spark):
    left = spark.range(4000).select(F.col("id").alias("site"), F.lit("hot").alias("area"))
    right = spark.range(300).select(F.lit("hot").alias("area"), F.col("id").alias("pack"))
    out = sem.fan_out_join(left, right, ["area"], "site", rows_per_task=100_000)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1_200_000 and len(sizes) == 12 and max(sizes) < 250_000


def test_sums_keep_small_infinite_and_huge_addends(rows):
    df = rows("g string, x double", *[("small", 4e-7)] * 3, ("huge", 9e18), ("huge", 9e18), ("inf", float("inf")), ("inf", 1.5),
              ("nan", float("nan")), ("nan", 1.0), ("cents", 0.1), ("cents", 0.2), ("none", None), ("mixed", -2e15), ("mixed", 0.25))
    got = {r.g: r.s for r in df.groupBy("g").agg(sem.exact_sum("x").alias("s")).collect()}
    assert got.pop("nan") != got.get("nan") and got.pop("none") is None
    assert got == {"small": 1.2e-6, "huge": 1.8e19, "inf": float("inf"), "cents": 0.3, "mixed": -2e15 + 0.25}
