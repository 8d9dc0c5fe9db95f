"""Edge fixtures and invariants of single operators."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from panelcast import config as cfg
from panelcast.operators import adjust, channel, conform, deliver, impute, price, project, transfer


def values(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# --- conform --------------------------------------------------------------------


def test_recode_keeps_the_tail(rows):
    df = rows("packid string", ("4777512",), ("0647034",), ("1234567",), (None,))
    out = conform.recode_ids(df, prefix={"packid": cfg.PACK_PREFIX_RECODES})
    assert [r.packid for r in out.collect()] == ["5890612", "6489534", "1234567", None]


def test_periods_of_all_months(rows):
    df = rows("p string", *[(f"2020-{m}",) for m in range(1, 13)], ("2020-13",), ("2020",), ("20200415",))
    out = {r.p: (r.year, r.date, r.quarter) for r in conform.derive_periods(df, "p").collect()}
    for m in range(1, 13):
        assert out[f"2020-{m}"] == ("2020", f"2020{m:02d}", f"2020Q{(m + 2) // 3}")
    assert out["2020-13"][2] == "2020" and out["2020"] == ("2020", "2020", "2020")
    assert out["20200415"] == ("2020", "202004", "2020Q2")


def test_gate_drops_unknown_and_non_positive(rows):
    df = rows(
        "site string, market string, units double, sales double, quarter string",
        ("a", "m", 1.0, 1.0, "2020Q1"), (None, "m", 1.0, 1.0, "2020Q1"),
        ("a", None, 1.0, 1.0, "2020Q1"), ("#N/A", "m", 1.0, 1.0, "2020Q1"),
        ("b", "m", 0.0, 1.0, "2020Q1"), ("b", "m", None, 1.0, "2020Q1"),
        ("b", "m", 1.0, -1.0, "2020Q1"), ("b", "m", 1.0, 1.0, "2018Q1"),
    )
    out = conform.validity_gate(
        df, ["site", "market"], ["units", "sales"], {"site": "#N/A"}, ["2020Q1"]
    )
    assert values(out, "site") == [("a",)]


def test_feed_conforming(rows):
    df = rows(
        "Province string, City string, pc string, Price double, Value double",
        ("北京市", "市辖区", "12", 2.0, 10.0), ("江苏省", "苏州市", "12", 0.0, 10.0),
        ("江苏省", None, "12", 2.0, 10.0), ("江苏省", None, "12", 2.0, 10.0),
    )
    columns = {"province": "Province", "city": "City", "packid": "pc", "price": "Price", "sales": "Value"}
    out = conform.normalise_transactions(df, columns, "省|市", "市", "市辖区", "北京")
    assert values(out, "province", "city", "packid", "units") == sorted(
        [("北京", "北京", "0000012", 5.0), ("江苏", "苏州", "0000012", None), ("江苏", None, "0000012", 5.0)],
        key=repr,
    )


def test_feeds_without_a_column_and_with_other_types(rows):
    a = rows("year int, product string", (2019, "p"))
    c = rows("year string", ("2020",))
    out = conform.union_feeds(a, c, text=["year"])
    assert values(out, "year", "product", "source_rank") == [("2019", "p", 0), ("2020", None, 1)]


# --- imputation -----------------------------------------------------------------

CELL = ["qoy", "province", "city", "district", "site", "market"]
GROWTH = ["qoy", "province", "city", "market", "atc3", "molecule"]
ITEM = ["qoy", "month", *CELL[1:], "atc3", "molecule", "packid"]
KEYS = ["year", "date", "quarter", *CELL[1:], "atc3", "molecule", "packid"]


def panel_rows(rows):
    data = []
    for site, months in (("A", {2019: [1, 2, 3], 2020: [1, 2, 3]}), ("B", {2019: [1, 2], 2020: []}),
                         ("C", {2019: [1], 2020: []})):
        for year, ms in months.items():
            for m in ms:
                sales = 10.0 if year == 2019 else 20.0
                data.append((str(year), f"{year}{m:02d}", f"{year}Q1", "P", "T", None, site, "M", "C01A",
                             "mol", "0000001", sales))
    return rows(
        "year string, date string, quarter string, province string, city string, district string,"
        " site string, market string, atc3 string, molecule string, packid string, sales double", *data
    )


def imputed(rows):
    observed = panel_rows(rows)
    parts = impute.with_quarter_parts(observed)
    cont = impute.period_continuity(parts, CELL, ("2019", "2020"))
    growth = impute.bounded_growth(parts, cont, CELL, GROWTH, ("2019", "2020"))
    wide = impute.impute_paired_period(parts, cont, growth, CELL, ITEM, GROWTH, ("2019", "2020"))
    long = impute.unpivot_compound(wide, ["flag", "sales"], "year")
    return observed, cont, growth, impute.merge_imputed(observed, impute.rebuild_periods(long), KEYS)


def test_imputation_fills_the_missing_year_only(rows):
    observed, cont, growth, merged = imputed(rows)
    assert values(cont, "site", "cnt_min", "cnt_max") == [("A", 3, 3), ("B", 0, 2), ("C", 0, 1)]
    assert growth.first()["growth"] == 2.0
    got = {(r.site, r.date): (r.sales, r.flag1) for r in merged.collect()}
    assert got[("B", "202001")] == (20.0, 1) and got[("B", "202002")] == (20.0, 1)
    assert ("C", "202001") not in got
    assert got[("A", "202003")] == (20.0, 0)
    # Observed rows are unchanged, although the district is missing everywhere.
    for r in observed.collect():
        assert got[(r.site, r.date)] == (r.sales, 0)
    assert len(got) == merged.count()


# --- projection -----------------------------------------------------------------


def test_average_ranks_with_ties_against_brute_force(spark):
    rnd = random.Random(3)
    data = [("g", rnd.choice([-5.5, 0.0, 0.0, 1.0, 2.5, rnd.uniform(0, 9e6)])) for _ in range(400)]
    data += [("h", 1.0)] * 5 + [("one", 3.0)]
    df = spark.createDataFrame(data, "g string, v double")
    ranks = {(r.g, r.v): r.r for r in project.average_rank(df, ["g"], "v", "r").collect()}
    for g in ("g", "h", "one"):
        vs = [v for k, v in data if k == g]
        for v in set(vs):
            assert ranks[(g, v)] == sum(x < v for x in vs) + (vs.count(v) + 1) / 2


def test_spearman_edge_groups(rows):
    df = rows(
        "g string, y double, x double",
        ("up", 1.0, 10.0), ("up", 2.0, 20.0), ("up", 3.0, 30.0),
        ("tie", 1.0, 1.0), ("tie", 1.0, 2.0), ("tie", 5.0, 3.0),
        ("flat", 2.0, 1.0), ("flat", 2.0, 2.0), ("zero", 0.0, 1.0), ("zero", 0.0, 4.0), ("one", 1.0, 1.0),
    )
    out = {r.g: r.spearman_cor for r in project.spearman_by_group(df, ["g"], "y", "x").collect()}
    assert math.isclose(out["up"], 1.0) and math.isclose(out["tie"], math.sqrt(3) / 2)
    assert out["flat"] is None and out["zero"] is None and out["one"] is None


def test_outlier_keeps_its_sales_but_leaves_the_panel(rows):
    """An outlier is no basis for slopes, yet its own sales are reported."""
    sites = rows(
        "site string, province string, city string, est double, seg int, panel_all int, panel int",
        ("a", "P", "T", 10.0, 1, 1, 1), ("o", "P", "T", 10.0, 1, 1, 0), ("u", "P", "T", 20.0, 1, 0, 0),
    )
    observed = rows(
        "quarter string, site string, province string, city string, market string, item string, sales double",
        ("q", "a", "P", "T", "M", "i", 5.0), ("q", "o", "P", "T", "M", "i", 900.0),
    )
    pairs = rows("site string, market string")
    factors = rows("market string, seg int, factor double", ("M", 1, 2.0))
    group = ["city", "quarter", "item", "market", "seg"]
    args = (sites, observed, observed, pairs)
    slopes = project.ratio_slope_compact(*args, ["province", "city"], ["market", "item"], group)
    assert slopes.first()["slope"] == 0.5
    out = project.score_universe_compact(
        *args, slopes, factors, ["province", "city"], ["market", "item"], group
    )
    assert values(out, "site", "final_sales", "panel") == [("a", 5.0, 1), ("o", 900.0, 0), ("u", 20.0, 0)]


def test_equal_shares_add_up(rows):
    universe = rows(
        "site string, province string, city string",
        *[(s, "P", "T") for s in "abcd"], ("x", "P", "other"),
    )
    observed = rows(
        "site string, province string, city string, item string, sales double",
        ("a", "P", "T", "i", 30.0), ("b", "P", "T", "i", 10.0),
    )
    out = project.equal_share_allocation(observed, universe, ["province", "city"], ["item"])
    given = {r.site: r.final_sales for r in out.collect()}
    assert given == {"c": 10.0, "d": 10.0, "x": None}
    total = sum(v for v in given.values() if v)
    assert total == 40.0 * 2 / 4
    both = project.observed_passthrough(observed, out, ["province", "city"], ["item"])
    assert values(both, "site", "panel") == [("a", 1), ("b", 1), ("c", 0), ("d", 0)]


def test_duplicate_joins_are_detected(rows):
    before = rows("x double", (1.0,), (2.0,))
    assert project.match_uniqueness(before, before, "x").first()["unique_match"]
    assert not project.match_uniqueness(before, before.union(before), "x").first()["unique_match"]


# --- price and adjustment -------------------------------------------------------


def test_ladder_takes_the_finest_known_price(rows):
    panel = rows(
        "packid string, year string, quarter string, province string, city string, sales double, units double",
        ("p", "2020", "2020Q1", "P", "T", 10.0, 1.0), ("p", "2020", "2020Q2", "P", "T", 30.0, 1.0),
        ("p", "2020", "2020Q1", "P", "U", 40.0, 1.0), ("p", "2020", "2020Q1", "R", "V", 100.0, 0.0),
    )
    targets = rows(
        "packid string, year string, quarter string, province string, city string, sales double",
        ("p", "2020", "2020Q1", "P", "T", 20.0),    # city quarter: 10
        ("p", "2020", "2020Q3", "P", "T", 20.0),    # city year: 20
        ("p", "2020", "2020Q1", "P", "W", 50.0),    # province quarter: 25
        ("p", "2020", "2020Q3", "P", "W", 80.0),    # province year: 80 / 3
        ("p", "2020", "2020Q2", "Z", "Z", 60.0),    # quarter: 30
        ("p", "2020", "2020Q4", "Z", "Z", 80.0),    # year: 80 / 3
        ("q", "2020", "2020Q4", "Z", "Z", 80.0),    # no price at all
    )
    out = price.price_ladder(targets, price.price_grains(panel))
    assert sorted(round(r.price, 6) for r in out.collect()) == [
        10.0, 20.0, 25.0, 26.666667, 26.666667, 30.0,
    ]
    assert all(math.isclose(r.units, r.sales / r.price) for r in out.collect())


def test_split_and_back_out_restore_the_input(rows):
    df = rows(
        "atc3 string, market string, sales double, units double",
        ("C07A", "IHD", 100.0, 8.0), ("C08A", "IHD", 50.0, 4.0), ("A10S", "OAD", 7.0, 1.0), (None, None, 1.0, 1.0),
    ).withColumn("atc2", F.substring("atc3", 1, 3))
    for cls, group in itertools.groupby(cfg.ALLOCATION, key=lambda r: r[0]):
        assert math.isclose(sum(r[2] for r in group), 1.0), cls
    split = adjust.split_across_markets(df, cfg.ALLOCATION, ["sales", "units"])
    assert split.count() == 6
    assert math.isclose(split.agg(F.sum("sales")).first()[0], 158.0)
    back = deliver.back_out_allocation(split, cfg.ALLOCATION, ["sales", "units"])
    expected = {"C07A": 100.0, "C08A": 50.0, "A10S": 7.0, None: 1.0}
    assert all(math.isclose(r.sales_raw, expected[r.atc3]) for r in back.collect())


def test_exclusion_keeps_rows_with_missing_values(rows):
    df = rows("atc3 string, market string, molecule string", ("A10S", "OAD", None),
              (None, None, "EPALRESTAT"), ("A10S", "OAD", "EPALRESTAT"), ("C07A", "HTN", "x"))
    out = adjust.reassign_and_exclude(
        df, cfg.REASSIGNED_CLASSES, cfg.REASSIGNED_MARKET, cfg.EXCLUDED_MOLECULES
    )
    assert values(out, "market", "molecule") == sorted(
        [("OAD", None), (None, "EPALRESTAT"), ("IHD", "x")], key=repr
    )


def test_scaling_leaves_observed_rows_and_unknown_markets(rows):
    df = rows("city string, market string, panel int, sales double, units double",
              ("苏州", "HTN", 1, 10.0, 1.0), ("苏州", "HTN", 0, 10.0, 1.0), ("徐州", "OAD", 0, 10.0, 1.0),
              ("徐州", "HTN", 0, 10.0, 1.0), ("苏州", "other", 0, 10.0, 1.0))
    grid = adjust.factor_grid(df, cfg.SCALED_MARKETS, cfg.SCALE_OVERRIDES)
    out = adjust.scale_unobserved(df, grid)
    assert values(out, "city", "market", "panel", "sales") == sorted(
        [("苏州", "HTN", 1, 10.0), ("苏州", "HTN", 0, 5.0), ("徐州", "OAD", 0, 3.0),
         ("徐州", "HTN", 0, 10.0), ("苏州", "other", 0, 10.0)], key=repr)


# --- transfer -------------------------------------------------------------------


@pytest.mark.parametrize("block_rows", [5, 1000])
def test_nearest_items_against_brute_force(spark, block_rows):
    rnd = random.Random(7)
    data = [(i, [float(rnd.randint(0, 4)), rnd.uniform(0, 9), 1.0], int(i % 3 == 0)) for i in range(60)]
    data.append((99, data[0][1], 0))
    data.append((98, data[0][1], 1))    # a tie, settled by id
    df = spark.createDataFrame(data, "item long, vector array<double>, train_flag int")
    out = transfer.knn_items(df, "item", k=3, block_rows=block_rows)
    train = [(i, v) for i, v, t in data if t]
    sd = []
    for p in range(3):
        xs = [v[p] for _, v in train]
        m = sum(xs) / len(xs)
        sd.append(math.sqrt(sum((x - m) ** 2 for x in xs) / (len(xs) - 1)) or 1.0)
    got = {(r.item, r.knn_level): (r.neighbour, r.distance) for r in out.collect()}
    for i, v, t in data:
        if t:
            assert (i, 1) not in got
            continue
        best = sorted(
            (math.sqrt(sum(((a - b) / s) ** 2 for a, b, s in zip(v, w, sd))), j) for j, w in train
        )[:3]
        for level, (d, j) in enumerate(best, 1):
            assert got[(i, level)][0] == j and math.isclose(got[(i, level)][1], d, abs_tol=1e-9)


def test_no_train_items_gives_no_neighbours(spark):
    df = spark.createDataFrame([(1, [1.0], 0), (2, [2.0], 0)], "item long, vector array<double>, train_flag int")
    assert transfer.knn_items(df, "item").count() == 0


def test_weights_sum_to_one(rows):
    near = rows("packid string, neighbour string, distance double", ("t", "a", 0.0), ("t", "b", 1.0), ("t", "c", 3.0))
    w = {r.neighbour: r.weight for r in transfer.inverse_distance_weights(near, "packid").collect()}
    assert math.isclose(sum(w.values()), 1.0) and math.isclose(w["a"], 4 / 7)


def test_donor_growth_limits(rows):
    data = [("half", 10.0, 5.0), ("new", 0.0, 5.0), ("gone", 5.0, 0.0), ("fast", 1.0, 9.0), ("edge", 2.0, 3.0)]
    panel = rows(
        "city string, quarter string, packid string, sales double",
        *[("D", q, p, s) for p, a, c in data for q, s in (("2019Q2", a), ("2020Q2", c)) if s],
    )
    out = transfer.donor_growth(panel, F.col("city") == "D", "T", ("2019Q2", "2020Q2"), None, "packid")
    assert values(out, "city", "packid", "growth") == [("T", "edge", 1.5), ("T", "half", 0.5), ("T", "new", 1.0)]


def test_cascade_covers_each_source(rows):
    g = "city string, packid string, growth double"
    out = transfer.growth_cascade(
        rows("packid string", ("a",), ("b",), ("c",), ("c",)), rows(g, ("T", "a", 0.5)),
        rows(g, ("T", "b", 0.7)), rows("packid string", ("a",), ("b",)), "packid", "T",
    )
    assert values(out, "packid", "growth", "flag") == [("a", 0.5, 0), ("b", 0.7, 1), ("c", 1.0, 2)]


# --- channel and delivery -------------------------------------------------------


def test_missing_product_keeps_the_corporation(rows):
    df = rows("packid string, product string, units double", ("1", None, 2.0), ("2", "GLUCOPHAGE", 1.0))
    packs = rows("packid string, pack_desc string, corp_desc string, pack_size double",
                 ("1", "TAB 1", "X", 10.0), ("2", "TAB 2", "Y", 5.0))
    out = channel.dosage_units(df, packs, ["pack_desc", "corp_desc", "pack_size"], cfg.CORP_BY_PRODUCT)
    assert values(out, "packid", "corp_desc", "dosage_units") == [("1", "X", 20.0), ("2", "MERCK GROUP", 5.0)]


def test_form_gate(rows):
    df = rows("pack_desc string, atc2 string", ("TAB 1", "C09"), ("AMP 1", "C09"), ("TAB 1", "C05"),
              ("AMP 1", "C07"), (None, "C09"), ("CAP 1", None))
    out = channel.dosage_form_gate(df, cfg.ORAL_FORMS, 4, cfg.DROPPED_CLASSES, bypass=["C07"])
    assert values(out, "pack_desc", "atc2") == sorted([("TAB 1", "C09"), ("AMP 1", "C07"), ("CAP 1", None)], key=repr)


def test_site_flag_is_strict_in_some_cities_only(rows):
    df = rows("city string, site string, quarter string", ("S", "a", "q"), ("S", "b", "q"), ("S", "c", "q"),
              ("T", "c", "q"), (None, "c", "q"), ("T", "c", "old"))
    flags = rows("site string, f int", ("a", 1), ("b", 0))
    out = deliver.flagged_site_filter(df, flags, ["site"], "f", ["S"], ["q"])
    assert values(out, "city", "site", "f") == sorted([("S", "a", 1), ("T", "c", None), (None, "c", None)], key=repr)


def test_pack_descriptions(rows):
    df = rows("d string", ("TAB 10MG 30",), ("TAB  F.C  10MG  X  30",), ("TAB",), ("TAB10MG",), ("TAB 30",), (None,), ("SOL A 5ML B",))
    out = {r.d: (r.package, r.dosage, r.quantity) for r in deliver.parse_pack_description(df, "d").collect()}
    assert out["TAB 10MG 30"] == ("TAB", "10MG", 30)
    assert out["TAB  F.C  10MG  X  30"] == ("TAB F.C", "10MG X", 30)
    assert out["TAB"] == (None, None, None)
    assert out["TAB10MG"] == ("TAB", None, None)
    assert out["TAB 30"] == ("TAB", "", 30)
    assert out["SOL A 5ML B"] == ("SOL A", "5ML", None)
    assert out[None] == (None, None, None)


def test_class_rules_first_match_wins(rows):
    df = rows("market string, atc3 string, molecule string, sales double",
              ("IHD", "C01D", "TRIMETAZIDINE", 1.0), ("IHD", "C01D", "OTHER", 1.0), ("HTN", "C09A", "x", 0.125),
              ("HTN", "Z99Z", "x", 1.0), ("HTN", "C09A", "ENALAPRIL+FOLIC ACID", 1.0), ("HTN", "C09A", None, 1.0))
    out = deliver.therapeutic_class_rules(df, cfg.CLASS_RULES, cfg.DROPPED_MOLECULE, {"sales": 2})
    assert values(out, "molecule", "class_label", "sales") == sorted(
        [("TRIMETAZIDINE", "TMZ", 1.0), ("OTHER", "OTHERS", 1.0), ("x", "RAASi Plain", 0.12), ("x", None, 1.0)], key=repr)


def test_mat_windows(rows):
    df = rows("quarter string", ("2020Q3",), ("2020Q2",), ("2019Q3",), ("2019Q2",), ("2018Q3",), ("2017Q3",), ("2017Q2",))
    out = {r.quarter: r.period_mat for r in deliver.mat_label(df, "2020Q2").collect()}
    assert out == {"2020Q3": None, "2020Q2": "MAT20Q2", "2019Q3": "MAT20Q2", "2019Q2": "MAT19Q2",
                   "2018Q3": "MAT19Q2", "2017Q3": "MAT18Q2", "2017Q2": None}


def test_restatement_is_idempotent(rows):
    schema = "channel string, city string, packid string, quarter string, sales double"
    history = rows(schema, ("CHC", "A", "1", "2020Q1", 1.0), ("CHC", "A", "2", "2020Q1", -1.0))
    new = rows(schema, ("CHC", "A", "1", "2020Q2", 2.0), ("CHC", "A", "9", "2020Q2", 5.0), ("CHC", None, "9", "2020Q2", 6.0))
    override = rows(schema, ("CHC", "A", "9", "2020Q2", 7.0), ("CHC", "A", "9", "2021Q2", 8.0))
    slice_ = (F.col("channel") == "CHC") & (F.col("city") == "A") & (F.col("packid") == "9")
    run = lambda h: deliver.restate_history(h, new, override, ["2020Q2"], slice_, ["sales"], F.lit(True))
    once = run(history)
    expected = sorted([("1", "2020Q1", 1.0), ("1", "2020Q2", 2.0), ("9", "2020Q2", 6.0), ("9", "2020Q2", 7.0)], key=repr)
    assert values(once, "packid", "quarter", "sales") == expected
    again = run(once)
    assert values(again, "packid", "quarter", "sales") == expected


def test_override_keeps_the_implied_price(rows):
    df = rows("packid string, quarter string, sales double, units double, quantity int, dosage_units double",
              ("5890602", "2019Q1", 100.0, 10.0, 7, 70.0), ("5890602", "2018Q1", 100.0, 10.0, 7, 70.0), ("x", "2019Q1", 1.0, 1.0, 1, 1.0))
    out = deliver.pack_period_override(df, F.lit(True), cfg.OVERRIDE_FACTORS)
    assert values(out, "quarter", "sales", "units", "dosage_units") == [("2020Q1", 120.78, 12.0, 85.0)]


def test_zero_sales_and_zero_units_go_together(rows):
    df = rows("packid string, units double, sales double", ("a", 1.0, 0.0), ("b", 0.0, 5.0), ("c", -1.0, 5.0), ("d", 1.0, -5.0), ("e", 2.0, 5.0))
    packs = rows("packid string, pack_desc string, corp_desc string, pack_size double", ("e", "TAB", "X", 3.0))
    names = rows("packid string, product string")
    out = deliver.delivery_aggregate(df, packs, names, ["packid"], "CHC")
    assert values(out, "packid", "units", "sales", "dosage_units") == [
        ("a", 0.0, 0.0, 0.0), ("b", 0.0, 0.0, 0.0), ("c", 0.0, 0.0, 0.0), ("d", 0.0, 0.0, 0.0), ("e", 2.0, 5.0, 6.0)]


def test_repeated_keys_are_listed_with_their_count(rows):
    df = rows("k string, x int", ("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5))
    assert values(deliver.duplicate_key_check(df, ["k"]), "k", "x", "n") == sorted(
        [("a", 1, 2), ("a", 2, 2), (None, 4, 2), (None, 5, 2)], key=repr)


def test_spearman_without_the_panel_equals_the_long_form(spark):
    rng = random.Random(4)
    sites = [(f"s{i}", f"p{i % 2}", f"c{i % 5}", rng.choice([1, 2]), float(rng.randint(1, 6)), int(i % 9 > 0)) for i in range(60)]
    quarters = ["q1", "q2", "q3"]
    observed = []
    for s, p, c, _, _, _ in sites:
        for item in range(8):
            for q in quarters[:2]:
                if rng.random() < 0.3 and (item + int(c[1])) % 3:
                    observed.append((s, p, c, f"m{item % 2}", f"a{item}", f"i{item // 2}", q, float(rng.choice([-2, -1, 0, 1, 2, 3, 3]))))
    site_df = spark.createDataFrame(sites, "site string, province string, city string, seg int, est double, panel int")
    sales = spark.createDataFrame(observed, "site string, province string, city string, market string, atc3 string, item string, quarter string, sales double")
    pairs = spark.createDataFrame([(f"s{i}", "m1") for i in range(0, 60, 7)], "site string, market string")
    area, pack, group = ["province", "city"], ["market", "atc3", "item"], ["province", "quarter", "item", "market", "seg"]
    skeleton = project.demote_pairs(project.expand_universe(site_df, sales, quarters, area, pack), pairs, ["site", "market"])
    panel = project.zero_filled_panel(skeleton, sales, ["quarter", "site", *area, *pack], ["est", "seg"])
    long = project.spearman_by_group(panel, group, "panel_sales", "est")
    short = project.spearman_compact(site_df, sales, sales, pairs, quarters, area, pack, group)

    def seen(df):
        return sorted((*[r[g] for g in group], None if r.spearman_cor is None else round(r.spearman_cor, 9)) for r in df.collect())

    got = seen(short)
    assert [g[:5] for g in got] == [g[:5] for g in seen(long)] and got == seen(long)
    assert sum(g[5] is not None for g in got) > 20
