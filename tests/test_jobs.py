"""A small reporting round through all seven jobs, with the fixed values."""

import math

import pytest
from pyspark.sql import functions as F

from panelcast import config as cfg
from panelcast.config import Periods
from panelcast.operators import conform, deliver
from panelcast.plans import checks, jobs

PERIODS = Periods(external_start="201910")
PACKS = {  # pack → class, molecule, market, description
    "1000001": ("C09A1", "PERIN", "HTN", "TAB 10MG 30"),
    "1000002": ("C07A0", "BISO", "IHD", "TAB 5MG 20"),
    "1000003": ("A10N1", "SITA", "OAD", "TAB 100MG 7"),
    "4777502": ("C01D0", "TRIMETAZIDINE", "IHD", "CAP 20MG 30"),
}
MONTHS = ["01", "02", "03", "04", "05", "06"]


def quarter(year, month):
    return f"{year}Q{(int(month) + 2) // 3}"


@pytest.fixture(scope="module")
def inputs(rows):
    universe = []
    for province, city, n in (("江苏", "苏州", 6), ("福建", "福州", 4), ("北京", "北京", 4), ("上海", "上海", 2), ("广东", "广州", 2)):
        for i in range(n):
            universe.append((province, city, f"{city}区", f"{city}院{i}", f"{city}站{i}", f"{city}{i}", 1000.0 * (i + 1)))
    feed = []
    for province, city, sites in (("江苏省", "苏州市", 3), ("福建省", "福州市", 2), ("北京市", "市辖区", 3)):
        short = "北京" if city == "市辖区" else city[:-1]
        for i in range(sites):
            for pack in PACKS:
                for year in (2019, 2020):
                    for m in MONTHS:
                        if i == 0 and year == 2020 and m == "05":
                            continue    # to be imputed
                        feed.append((year, f"{year}{m}", quarter(year, m), province, city, f"{short}区", f"{short}院{i}",
                                     "x", "n", f"p{pack}", pack, 10.0, 100.0 * (i + 1)))
    feed_schema = ("year int, date string, quarter string, province string, city string, district string,"
                   " hospital string, atc4 string, nfc string, product string, packid string, price double, sales double")
    service = [(*r[:6], "北京服务站", *r[7:]) for r in feed if r[3] == "北京市"]
    history_schema = ", ".join(
        f"{c} {'double' if c in jobs.MEASURES else 'int' if c == 'quantity' else 'string'}" for c in jobs.DELIVERED
    )

    def delivered(city, province, quarter_, pack, sales, product="X", label=None):
        cls, molecule, market, text = PACKS.get(pack, ("A10N1", "VILDA", "OAD", "TAB 50MG 14"))
        base = dict(packid=pack, channel="CHC", province=province, city=city, quarter=quarter_, atc3=cls[:4],
                    market=market, molecule=molecule, product=product, pack_desc=text, corp_desc="C",
                    sales=sales, units=sales / 10, dosage_units=sales, class_label=label, package="TAB", quantity=14)
        return tuple(base.get(c) for c in jobs.DELIVERED)

    history = [delivered("上海", "上海", q, p, 500.0) for q in ("2019Q1", "2019Q2") for p in PACKS]
    history += [delivered("福州", "福建", q, "4268602", 200.0, label="DPP-IV") for q in ("2019Q1", "2019Q2")]
    history += [delivered("福州", "福建", "2020Q2", "4268602", 999.0, label="DPP-IV"),
                delivered("苏州", "江苏", "2017Q1", "4777502", 50.0, product="GLUCOPHAGE")]
    return {
        "panel": jobs.PanelInputs(
            provincial_feeds=[rows(feed_schema, *feed), rows(feed_schema.replace("year int", "year string"))],
            city_history=rows("year string, date string, quarter string, province string, city string, district string,"
                              " site string, hospital string, packid string, units double, sales double",
                              ("2019", "201901", "2019Q1", "广东", "广州", None, None, "广州站0", "1000001", 5.0, 50.0)),
            total_history=rows("year string, date string, quarter string, province string, city string, site string,"
                               " market string, atc3 string, molecule string, packid string, units double, sales double",
                               ("2019", "201901", "2019Q1", None, "苏州", "苏州5", "HTN", "C09A", "PERIN", "1000001", 5.0, 50.0),
                               ("2019", "201901", "2019Q1", "江苏", None, "苏州5", "HTN", "C09A", "PERIN", "1000001", 1.0, 10.0)),
            city_feeds=[rows("period string, hospital string, packid string, units double, sales double",
                             ("2020-1", "广州院0", "1000001", 3.0, 33.0), ("2020-10", "广州院0", "1000001", 3.0, 33.0))],
            universe=rows("province string, city string, district string, hospital string, alt string, site string, est double", *universe),
            packs=rows("packid string, atc4 string, molecule string, product string", *[(p, v[0], v[1], f"P{p}") for p, v in PACKS.items()]),
            markets=rows("molecule string, market string", *[(v[1], v[2]) for v in PACKS.values()]),
            alternative_name="alt",
        ),
        "service": rows(feed_schema.replace("year int", "year string"), *[(str(r[0]), *r[1:]) for r in service])
        .select("year", "quarter", "date", "province", "city", "district", "hospital", "packid", "price", "sales"),
        "history": rows(history_schema, *history),
        "external": rows("period string, packid string, geography string, sales double",
                         *[(f"M2019{m}", p, "CHT", 10.0 * i + int(m)) for i, p in enumerate([*PACKS, "5890602"]) for m in ("10", "11", "12")]),
        "details": rows("packid string, pack_desc string, corp_desc string, pack_size double", *[(p, v[3], "C", 10.0) for p, v in PACKS.items()],
                        ("5890602", "CAP 20MG 30", "C", 30.0)),
    }


@pytest.fixture(scope="module")
def panel(inputs):
    return jobs.panel_job(inputs["panel"], PERIODS)


def test_panel(panel):
    got = panel.collect()
    assert {r.city for r in got} == {"苏州", "福州", "北京", "广州"}
    assert "4777502" not in {r.packid for r in got} and "5890602" in {r.packid for r in got}
    assert {r.quarter for r in got} <= set(PERIODS.panel_quarters)
    # A history row without a province is dropped by the province filter.
    filled = [r for r in got if r.site == "苏州5"]
    assert len(filled) == 1 and (filled[0].province, filled[0].district, filled[0].sales) == ("江苏", "苏州区", 10.0)
    city = {(r.date, r.site): r.sales for r in got if r.city == "广州"}
    assert city == {("201901", "广州0"): 50.0, ("202001", "广州0"): 33.0}
    assert deliver.duplicate_key_check(panel, jobs.PANEL_KEYS).count() == 0


@pytest.fixture(scope="module")
def adjusted(inputs, panel, rows):
    imputed = jobs.impute_job(panel, PERIODS)
    may = imputed.filter((F.col("site") == "苏州0") & (F.col("date") == "202005")).collect()
    # Growth of the city: 1800 in 2019Q2, 1700 in 2020Q2, where the month is missing.
    estimate = 100 * 1700 / 1800
    assert len(may) == 4 and all(r.flag1 == 1 and math.isclose(r.sales, estimate) for r in may)
    universe = inputs["panel"].universe
    projected = jobs.project_job(
        jobs.ProjectInputs(
            imputed=imputed, panel=panel, universe=universe,
            sizes=universe.select("province", "city", "site", "est"),
            segments=rows("city string, district string, seg int", ("苏州", None, 2)),
            historic_sites=panel.select("site").distinct(),
            outliers=rows("site string"), flagged_pairs=rows("site string, market string"),
            factors=rows("market string, seg int, factor double",
                         *[(m, s, 1.0) for m in ("HTN", "IHD", "OAD") for s in (1, 2)]),
        ),
        PERIODS,
    )
    q2 = {(r.site, r.packid): r.sales for r in projected.filter("quarter = '2020Q2'").collect()}
    # Suzhou: sites 0-2 report at sizes 1000, 2000, 3000. Site 5 is in the sample
    # (through history), with a size of 6000 and no sales in 2020.
    slope = (1700.0 + estimate) / 12000.0
    assert math.isclose(q2[("苏州3", "1000001")], 4000 * slope, rel_tol=1e-6)
    assert math.isclose(q2[("苏州1", "1000001")], 600.0)
    # Fuzhou: two of four sites report; the others get a quarter of the total each.
    assert math.isclose(q2[("福州3", "1000001")], (200.0 + 100 * 800 / 900 + 600.0) / 4, rel_tol=1e-6)
    return jobs.price_adjust_job(projected, panel, PERIODS)


def test_adjustment(adjusted):
    got = adjusted.filter("quarter = '2020Q2' and city = '苏州'").collect()
    split = {(r.site, r.market): r.sales for r in got if r.packid == "1000002"}
    assert math.isclose(split[("苏州1", "IHD")], 150.0) and math.isclose(split[("苏州1", "HTN")], 450.0)
    assert split[("苏州3", "HTN")] / (0.75 * 0.5) == pytest.approx(
        4000 * (1700 + 100 * 1700 / 1800) / 12000
    )    # scaled: not observed
    assert all(math.isclose(r.price, 10.0) for r in got)


@pytest.fixture(scope="module")
def transferred(inputs, panel):
    return jobs.transfer_job(inputs["history"], panel, inputs["external"], PERIODS)


def test_transfer(transferred):
    got = {r.packid: (r.quarter, r.city, r.sales, r.price) for r in transferred.collect()}
    assert set(got) == {"1000001", "1000002", "1000003", "5890602"}
    for q, city, sales, price in got.values():
        # Donor: 1800 in 2019Q2, 1700 in 2020Q2 (one month of a site is missing).
        assert (q, city, price) == ("2020Q2", "上海", 10.0) and math.isclose(sales, 500 * 1700 / 1800)


def test_transfer_with_own_prices(inputs, panel):
    out = jobs.transfer_job(inputs["history"], panel, inputs["external"], PERIODS, own_prices=True)
    assert {(r.packid, r.price) for r in out.collect()} >= {("1000001", 10.0)}
    assert all(math.isclose(r.units, r.sales / r.price) for r in out.collect())


def test_checks_of_a_round(inputs, panel, adjusted):
    lost = checks.gate_losses(jobs.panel_rows(inputs["panel"]), PERIODS.panel_quarters, cfg.NOT_AVAILABLE)
    reasons = {r.reason: r.n_rows for r in lost.collect()}
    assert set(reasons) == {"other quarter"} and reasons["other quarter"] == 1
    totals = checks.panel_totals(panel)
    assert math.isclose(totals.agg({"sales": "sum"}).first()[0], panel.agg({"sales": "sum"}).first()[0])
    verdict = checks.projection_checks(panel, adjusted)["unique_match"].first()
    assert verdict.lookup == "projection"
    split = checks.adjustment_checks(adjusted)["by_panel"].filter("city = '苏州'").first()
    assert split.observed > 0 and split.unobserved > 0
    broken = checks.lost_rows(panel.limit(3).withColumn("sales", F.lit(2.0)), {"a": F.lit(True), "b": F.col("units").isNull()})
    assert [(r.reason, r.n_rows, r.sales) for r in broken.collect()] == [("a", 3, 6.0)]


def test_jobs_store_what_they_return(adjusted, panel):
    plan = adjusted._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan and panel.inputFiles()


def test_second_channel(inputs):
    from panelcast.plans.jobs import channel_job, pack_markets

    markets = pack_markets(inputs["panel"].packs, inputs["panel"].markets)
    out = channel_job(inputs["service"], markets, inputs["panel"].packs, inputs["details"], PERIODS)
    got = out.collect()
    assert {r.channel for r in got} == {"CHS"} and {r.city for r in got} == {"北京"}
    halves = {r.market: r.sales for r in got if r.packid == "1000002" and r.quarter == "2020Q2"}
    assert math.isclose(halves["HTN"] / (halves["HTN"] + halves["IHD"]), 0.75)


def test_delivery(inputs, adjusted, transferred, rows, spark, tmp_path):
    from panelcast.plans.jobs import DeliveryInputs, channel_job, delivery_job, pack_markets
    from panelcast.sources import tables

    markets = pack_markets(inputs["panel"].packs, inputs["panel"].markets)
    reference = rows("packid string, pack_desc string, corp_id string, pack_size double",
                     *[(p, v[3], "c1", 10.0) for p, v in PACKS.items()], ("5890602", "CAP 20MG 30", "c1", 30.0))
    products = rows("packid string, product string", *[(p, f"P{p}") for p in [*PACKS, "5890602"]])
    out = delivery_job(
        DeliveryInputs(
            adjusted=adjusted, transferred=transferred,
            second_channel=channel_job(inputs["service"], markets, products, inputs["details"], PERIODS),
            site_flags=rows("province string, city string, site string, in_scope string, zs_flag int",
                            ("北京", "北京", "北京1", "y", 1), ("北京", "北京", "北京2", "y", 0)),
            corporations=rows("corp_id string, corp_desc string", ("c1", "LUYE GROUP")),
            pack_reference=reference, products=products,
            policy_cities=rows("policy string, city string", ("4+7城市", "上海市"), ("省会", "福州市")),
            bids=rows("packid string, name1 string, name2 string, name3 string",
                      ("1000001", "4+7分子", "中标产品-1", "中标品规"), ("1000003", None, "非中标产品", None)),
            nature=rows("corp_desc string, maker_type string, atc3 string, class_name string, molecule string, molecule_name string",
                        ("LVYE GROUP", None, "C09A", "class", "PERIN", "培哚普利")),
            corporation_info=rows("corp_desc string, maker_type string", ("LVYE GROUP", "Joint Venture"), ("LVYE GROUP", None)),
            profile=rows("packid string, atc4 string, product_cn string", ("1000001", "C09A1", "名"), ("1000099", "X", "其他")),
            city_names=rows("city string, city_en string", ("上海", "Shanghai")),
            history=inputs["history"],
        ),
        PERIODS,
    )
    path = str(tmp_path / "delivery")
    tables.write_periods(out, path)
    got = tables.read_periods(spark, path).collect()
    new = [r for r in got if r.quarter == "2020Q2"]
    beijing = {r.packid for r in new if r.city == "北京" and r.channel == "CHC"}
    assert beijing == {"1000001", "1000002", "1000003", "5890602"}
    one = next(r for r in new if r.city == "上海" and r.packid == "1000001")
    assert (one.policy, one.city_en, one.name1, one.name3, one.name2) == ("4+7城市", "Shanghai", "4+7分子", "仿制", "中标产品")
    assert (one.product_cn, one.corp_desc, one.maker_type, one.class_label) == ("名", "LVYE GROUP", "MNC", "RAASi Plain")
    assert (one.package, one.dosage, one.quantity, one.period_mat) == ("TAB", "10MG", 30, "MAT20Q2")
    # Another pack of the same product code: bid and profile come from that code.
    other = next(r for r in new if r.city == "上海" and r.packid == "1000003")
    assert (other.name2, other.name3, other.product_cn) == ("中标产品", "仿制", "其他")
    alone = next(r for r in new if r.city == "上海" and r.packid == "5890602")
    assert (alone.name2, alone.name3, alone.product_cn) == (None, "原研", None)
    # The delivered row of the overridden slice is replaced by the scaled one of the year before.
    fuzhou = [r for r in new if r.city == "福州" and r.packid == "4268602"]
    assert [r.sales for r in fuzhou] == [275.34]
    old = next(r for r in got if r.quarter == "2017Q1")
    assert (old.packid, old.corp_desc, old.period_mat) == ("5890602", "MERCK GROUP", None)
    bb = next(r for r in new if r.city == "苏州" and r.packid == "1000002" and r.market == "HTN")
    assert math.isclose(bb.sales_raw, bb.sales / 0.75)
    assert deliver.duplicate_key_check(out, ["channel", "quarter", "city", "market", "packid"]).count() == 0
    # A second run replaces its partitions and nothing else.
    tables.write_periods(out.filter("quarter = '2020Q2'"), path)
    assert tables.read_periods(spark, path).count() == len(got)
    export = jobs.delivery_export(out).collect()
    keys = [(r.channel, r.quarter, r.province, r.city, r.market, r.packid) for r in export]
    assert keys == sorted(keys)
    totals = conform.qc_totals(out, ["city", "market", "quarter"], ["sales"])
    assert math.isclose(sum(r.sales for r in totals.collect()), sum(r.sales for r in got), abs_tol=1e-6)
    assert cfg.DELIVERY_ROUNDING["sales"] == 2


def test_jobs_in_a_run_count_their_totals_and_leave_nothing(spark, inputs, panel, transferred, tmp_path):
    from panelcast.sources.runs import OTHER, Run

    with Run(spark, "round", str(tmp_path)) as run:
        again = jobs.panel_job(inputs["panel"], PERIODS, run)
        imputed = jobs.impute_job(again, PERIODS, run=run)
        moved = jobs.transfer_job(inputs["history"], again, inputs["external"], PERIODS, run=run)
        for name, df, measures in (("panel", again, ["units", "sales"]), ("imputed", imputed, ["sales"]), ("transferred", moved, ["units", "sales"])):
            counted = {(r.column, r.value, r.measure): r.total for r in run.totals(name).collect()}
            for r in conform.qc_totals(df, ["quarter"], measures).collect():
                cell = ("quarter", r.quarter) if ("quarter", r.quarter, measures[0]) in counted else ("quarter", OTHER)
                assert all(counted[*cell, m] == r[m] for m in measures) or cell[1] == OTHER
            whole = conform.qc_totals(df, [], measures).first()
            assert all(counted["", "", m] == whole[m] for m in measures)
        assert {"panel_rows", "panel", "impute_scope", "imputed", "matrix", "transferred"} <= set(run.stages())
        assert moved.count() == transferred.count()
        # A second call in the same run reads what is there.
        assert jobs.panel_job(inputs["panel"], PERIODS, run).inputFiles() == again.inputFiles()
    assert not list(tmp_path.iterdir())
