"""The seven jobs of a reporting round, from feeds to the restated delivery.

Each job takes canonical DataFrames, stores its result as a stage table and
returns that, so that the next job scans neither the feeds nor the steps before
again. What several steps of a job read is stored too. With a ``Run``, all
stages of a job belong to it: their control totals are counted while they are
written, a lost run goes on after its last finished stage, and closing the run
removes them. Further checks of the results are in ``panelcast.plans.checks``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast import config as cfg
from panelcast.config import Periods
from panelcast.functions import semantics as sem
from panelcast.operators import adjust, channel, conform, deliver, impute, price, project, transfer
from panelcast.sources.runs import Run
from panelcast.sources.stages import stage

PANEL_KEYS = [
    "year", "date", "quarter", "province", "city", "district", "site", "market", "atc3",
    "molecule", "product", "packid",
]
IMPUTED_KEYS = [k for k in PANEL_KEYS if k != "product"]
CELL = ["qoy", "province", "city", "district", "site", "market"]
GROWTH = ["qoy", "province", "city", "market", "atc3", "molecule"]
ITEM = ["qoy", "month", *CELL[1:], "atc3", "molecule", "packid"]
AREA = ["province", "city", "district"]
PACK = ["market", "atc3", "molecule", "packid"]
SLOPE = ["city", "quarter", "packid", "market", "seg"]
PLACE_PACK = ["province", "city", "year", "quarter", *PACK]
FEED_RULES = {
    "province_suffix": cfg.PROVINCE_SUFFIX,
    "city_suffix": cfg.CITY_SUFFIX,
    "municipal_label": cfg.MUNICIPAL_LABEL,
    "municipal_city": cfg.MUNICIPAL_CITY,
}


def _keep(run: Run | None):
    """How a job stores its stages: in its run, or else one by one."""

    def keep(df: DataFrame, name: str, measures: Sequence[str] = (), by: dict | None = None) -> DataFrame:
        return run.stage(df, name, measures, by) if run else stage(df, name)

    return keep


# --- 1. canonical panel ---------------------------------------------------------


@dataclass(frozen=True)
class PanelInputs:
    provincial_feeds: Sequence[DataFrame]
    city_history: DataFrame
    total_history: DataFrame
    city_feeds: Sequence[DataFrame]
    universe: DataFrame
    packs: DataFrame
    markets: DataFrame
    feed_province: str = cfg.FEED_PROVINCE
    feed_city: str = cfg.FEED_CITY
    alternative_name: str | None = None


def site_names(universe: DataFrame, alternative_name: str | None = None) -> DataFrame:
    """Place and name → site, for the official and the alternative name."""
    keys = [*AREA, "hospital"]
    names = [conform.lookup_first_by_key(universe, keys, "site")]
    if alternative_name:
        other = universe.drop("hospital").withColumnRenamed(alternative_name, "hospital")
        names.append(conform.lookup_first_by_key(other, keys, "site"))
    return conform.lookup_union_distinct(*names)


def pack_markets(packs: DataFrame, markets: DataFrame) -> DataFrame:
    reference = conform.conform_pack_reference(packs, "packid", "atc4", "molecule")
    return conform.market_definition(markets, reference).drop("atc2")


def panel_rows(inputs: PanelInputs) -> DataFrame:
    """All feeds with places, sites and markets, before the gate; ``checks.gate_losses`` reads them."""
    names = site_names(inputs.universe, inputs.alternative_name)
    places = conform.first_valid_by_key(names, ["site"], AREA)
    markets = pack_markets(inputs.packs, inputs.markets)

    def padded(df: DataFrame) -> DataFrame:
        """Ids in one width; before duplicates are removed, so that both spellings are one sale."""
        return df.withColumn("packid", sem.pad_id("packid"))

    def with_market(df: DataFrame) -> DataFrame:
        return sem.null_safe_join(padded(df), markets, ["packid"], "left")

    facts = ["year", "date", "quarter", *AREA, "site", *PACK, "units", "sales"]
    city_history = conform.coalesce_join(
        padded(inputs.city_history).distinct(), names, ["province", "city", "hospital"], ["district", "site"]
    )
    city_history = with_market(city_history.filter(F.col("site").isNotNull())).select(*facts)
    total_history = conform.recode_ids(
        inputs.total_history.filter(F.col("province") != inputs.feed_province),
        whole={"site": cfg.SITE_RECODES},
    )
    total_history = conform.coalesce_join(
        total_history, places, ["site"], ["province", "city", "district"]
    ).select(*facts)
    history = conform.union_feeds(total_history, city_history)
    history = conform.fill_attrs_within_key(history, ["site"], AREA, "source_rank")
    history = history.drop("source_rank").groupBy(*facts[:-2]).agg(
        sem.sum0("units").alias("units"), sem.sum0("sales").alias("sales")
    )

    city_feeds = []
    for feed in inputs.city_feeds:
        rows = conform.derive_periods(feed, "period").withColumns(
            {"province": F.lit(inputs.feed_province), "city": F.lit(inputs.feed_city)}
        )
        rows = padded(rows.drop("period")).distinct()
        rows = sem.lookup_join(rows, names, ["province", "city", "hospital"], ["district", "site"])
        city_feeds.append(with_market(rows).select(*facts))

    merged = conform.union_feeds(*inputs.provincial_feeds, text=["year", "date"]).drop("source_rank")
    columns = {c: c for c in merged.columns}
    provincial = conform.normalise_transactions(merged, columns, **FEED_RULES)
    provincial = sem.lookup_join(provincial, names, [*AREA, "hospital"], ["site"])
    provincial = with_market(provincial).select(*facts, "product")

    total = conform.union_feeds(provincial, *city_feeds, history)
    return total


def panel_job(inputs: PanelInputs, periods: Periods, run: Run | None = None) -> DataFrame:
    keep = _keep(run)
    total = keep(panel_rows(inputs), "panel_rows", ["units", "sales"], {"quarter": periods.panel_quarters})
    total = conform.validity_gate(
        total, ["site", "market"], ["units", "sales"], {"site": cfg.NOT_AVAILABLE},
        periods.panel_quarters,
    )
    total = conform.recode_ids(total, prefix={"packid": cfg.PACK_PREFIX_RECODES})
    total = conform.fill_attrs_within_key(total, ["site"], AREA, "source_rank")
    panel = conform.canonical_panel(total, PANEL_KEYS)
    return keep(panel, "panel", ["units", "sales"], {"quarter": periods.panel_quarters})


# --- 2. imputation --------------------------------------------------------------


def impute_job(
    panel: DataFrame, periods: Periods, cities: Sequence[str] | None = None, run: Run | None = None
) -> DataFrame:
    """Observed panel with the estimated months of the target cities."""
    keep = _keep(run)
    wanted = cfg.IMPUTED_CITIES if cities is None else cities
    scope = keep(
        impute.with_quarter_parts(panel.filter(F.col("city").isin(list(wanted)))), "impute_scope"
    )
    cont = impute.period_continuity(scope, CELL, periods.years)
    growth = impute.bounded_growth(scope, cont, CELL, GROWTH, periods.years)
    wide = impute.impute_paired_period(scope, cont, growth, CELL, ITEM, GROWTH, periods.years)
    long = impute.rebuild_periods(impute.unpivot_compound(wide, ["flag", "sales"], "year"))
    merged = impute.merge_imputed(panel, long, IMPUTED_KEYS)
    return keep(merged, "imputed", ["sales"], {"quarter": periods.panel_quarters, "flag1": [0, 1]})


# --- 3. projection --------------------------------------------------------------


@dataclass(frozen=True)
class ProjectInputs:
    imputed: DataFrame
    panel: DataFrame
    universe: DataFrame
    sizes: DataFrame
    segments: DataFrame
    historic_sites: DataFrame
    outliers: DataFrame
    flagged_pairs: DataFrame
    factors: DataFrame
    extra_size_province: str = cfg.EXTRA_SIZE_PROVINCE


def project_job(inputs: ProjectInputs, periods: Periods, run: Run | None = None) -> DataFrame:
    """Universe estimate: ratio projection, and equal shares for one city."""
    keep = _keep(run)
    universe = keep(
        project.site_universe(inputs.panel, inputs.universe, "site", [*AREA, "est"]), "universe"
    )
    known = inputs.sizes.filter(F.col("est") > 0).select("province", "city", "site", "est")
    extra = universe.filter(
        (F.col("province") == inputs.extra_size_province) & (F.col("est") > 0)
    ).select("province", "city", "site", "est")
    sites = known.unionByName(extra).dropDuplicates()
    sites = sem.lookup_join(sites, universe, ["province", "city", "site"], ["district"])
    sites = project.panel_membership(sites, inputs.panel, "site", "est")
    sites = project.trusted_sites(sites, inputs.outliers, inputs.historic_sites, "site")
    sites = keep(
        project.assign_segment(
            sites, inputs.segments, "city", "district", cfg.SPLIT_SEGMENT_CITIES
        ),
        "sites",
    )

    rows = inputs.imputed.filter(F.col("quarter").isin(list(periods.projected_quarters)))
    rows = keep(
        rows.groupBy("quarter", *AREA, "site", *PACK).agg(sem.sum0("sales").alias("sales")),
        "quarter_sales", ["sales"], {"quarter": periods.projected_quarters},
    )
    excluded = [*cfg.SPLIT_SEGMENT_CITIES, cfg.EQUAL_SHARE_CITY]
    most = rows.filter(sem.not_in("city", excluded))
    slopes = project.ratio_slope_compact(
        sites, most, most, inputs.flagged_pairs, AREA, PACK, SLOPE
    )
    scored = project.score_universe_compact(
        sites, most, most, inputs.flagged_pairs, slopes, inputs.factors, AREA, PACK, SLOPE
    )

    here = F.col("city") == cfg.EQUAL_SHARE_CITY
    equal = rows.filter(here)
    # The number of sites per area counts the whole universe.
    allocated = project.equal_share_allocation(
        equal, universe.filter(here), AREA, ["quarter", *PACK]
    )
    equal = project.observed_passthrough(equal, allocated, AREA, ["quarter", *PACK])
    parts = [
        p.withColumnRenamed("final_sales", "sales").withColumn("year", F.substring("quarter", 1, 4))
        for p in (scored, equal)
    ]
    keys = ["year", "quarter", "province", "city", "site", *PACK, "panel"]
    projected = project.projection_rollup(*parts, keys=keys)
    return keep(projected, "projected", ["sales"], {"quarter": periods.projected_quarters, "panel": [0, 1]})


# --- 4. price and adjustment ----------------------------------------------------


@dataclass(frozen=True)
class AdjustRules:
    classes: Sequence[str] = tuple(cfg.REASSIGNED_CLASSES)
    market: str = cfg.REASSIGNED_MARKET
    exclusions: Sequence[tuple[str, str]] = tuple(cfg.EXCLUDED_MOLECULES)
    allocation: Sequence[tuple[str, str, float]] = tuple(cfg.ALLOCATION)
    scaled_markets: Sequence[str] = tuple(cfg.SCALED_MARKETS)
    factors: Sequence[tuple[str, str | None, float]] = tuple(cfg.SCALE_OVERRIDES)


def price_adjust_job(
    projected: DataFrame, panel: DataFrame, periods: Periods, run: Run | None = None,
    rules: AdjustRules = AdjustRules(),
) -> DataFrame:
    """Priced projection after class split and scaling of unobserved rows."""
    grains = price.price_grains(panel.filter(F.col("year") == periods.current_year))
    priced = price.price_ladder(projected, grains)
    moved = adjust.reassign_and_exclude(priced, rules.classes, rules.market, rules.exclusions)
    split = adjust.split_across_markets(moved, rules.allocation, ["sales", "units"])
    return _keep(run)(
        adjust.scale_in_place(split, rules.scaled_markets, rules.factors), "adjusted", ["units", "sales"],
        {"quarter": periods.projected_quarters, "market": rules.scaled_markets, "panel": [0, 1]},
    )


# --- 5. growth transfer ---------------------------------------------------------


def transfer_job(
    history: DataFrame,
    panel: DataFrame,
    external: DataFrame,
    periods: Periods,
    own_prices: bool = False,
    run: Run | None = None,
) -> DataFrame:
    """Current-period estimate of the target city from donor and neighbour growth.

    Units come from the prices of the donor city, or with ``own_prices`` from the
    target's own prices of the base quarter and the listed overrides.
    """
    keep = _keep(run)
    totals = ["units", "sales"], {"quarter": [periods.report_quarter]}
    recoded = conform.recode_ids(
        history.withColumn("packid", sem.pad_id("packid")),
        prefix={"packid": cfg.PACK_PREFIX_RECODES},
    )
    scope = (
        (F.col("channel") == cfg.OVERRIDE_CHANNEL)
        & (F.col("province") == cfg.TRANSFER_TARGET)
        & (F.col("quarter") == periods.base_quarter)
    )
    target = keep(
        transfer.history_slice(
            recoded, scope, ["quarter", *PACK], ["province", "city"], ["units", "sales"]
        ),
        "target",
    )
    own = keep(
        transfer.donor_growth(
            panel, F.col("city") == cfg.TRANSFER_DONOR, cfg.TRANSFER_TARGET,
            (periods.base_quarter, periods.report_quarter), target, "packid", cfg.GROWTH_CEILING,
        ),
        "own_growth",
    )
    outside = external.filter(F.col("geography") == cfg.EXTERNAL_GEOGRAPHY).withColumns(
        {"period": F.regexp_replace("period", "M", ""), "packid": sem.pad_id("packid")}
    )
    outside = keep(outside, "external")
    months = transfer.months_from(outside, "period", periods.external_start)
    matrix = keep(
        transfer.item_period_matrix(outside, "packid", "period", "sales", months, own), "matrix"
    )
    near = transfer.knn_items(transfer.as_vector(matrix, months), "packid", k=cfg.NEIGHBOURS)
    weights = transfer.inverse_distance_weights(near, "packid")
    borrowed = transfer.neighbour_weighted_growth(weights, own, "packid")
    growth = transfer.growth_cascade(target, own, borrowed, matrix, "packid", cfg.TRANSFER_TARGET)
    if own_prices:
        own_priced = transfer.apply_growth(
            target, growth, cfg.PRICE_OVERRIDES, "packid", periods.report_quarter
        )
        return keep(own_priced.select(*PLACE_PACK, "units", "sales", "price"), "transferred_own", *totals)
    grown = keep(transfer.grow(target, growth, "packid", periods.report_quarter), "grown")

    grains = price.price_grains(panel.filter(F.col("year") == periods.current_year))
    relabelled = price.relabel_grains(
        grains, cfg.TRANSFER_DONOR, cfg.TRANSFER_DONOR, cfg.TRANSFER_TARGET, cfg.TRANSFER_TARGET
    )
    priced = transfer.borrowed_price_ladder(grown, relabelled)
    return keep(priced.select(*PLACE_PACK, "units", "sales", "price"), "transferred", *totals)


# --- 6. second channel ----------------------------------------------------------


def channel_job(
    feed: DataFrame,
    markets: DataFrame,
    products: DataFrame,
    details: DataFrame,
    periods: Periods,
    run: Run | None = None,
) -> DataFrame:
    """Sites of the second channel, priced as sold, split and gated by form.

    Codes are replaced before any lookup, so that old and new codes of a pack
    are one pack.
    """
    codes = {"packid": cfg.PACK_PREFIX_RECODES}
    recoded = conform.recode_ids(feed.withColumn("packid", sem.pad_id("packid")), prefix=codes)
    columns = {c: c for c in feed.columns}
    rows = channel.channel_extract(
        recoded, columns, cfg.SECOND_CHANNEL_PATTERN, cfg.SECOND_CHANNEL_PROVINCE,
        periods.projected_quarters, markets, PLACE_PACK, FEED_RULES,
    )
    rows = sem.lookup_join(rows, products, ["packid"], ["product"])
    rows = channel.dosage_units(
        rows, details, ["pack_desc", "corp_desc", "pack_size"], cfg.CORP_BY_PRODUCT
    )
    rows = adjust.reassign_and_exclude(
        rows, cfg.REASSIGNED_CLASSES, cfg.REASSIGNED_MARKET, cfg.EXCLUDED_PRODUCTS, by="product"
    )
    rows = adjust.split_across_markets(rows, cfg.ALLOCATION, ["sales", "units", "dosage_units"])
    rows = channel.dosage_form_gate(
        rows, cfg.ORAL_FORMS, 4, cfg.DROPPED_CLASSES, bypass=cfg.REASSIGNED_CLASSES
    )
    rows = rows.withColumn("channel", F.lit("CHS"))
    if run is None:
        return rows
    return run.stage(rows, "second_channel", MEASURES, {"quarter": periods.projected_quarters})


# --- 7. delivery ----------------------------------------------------------------


@dataclass(frozen=True)
class DeliveryInputs:
    adjusted: DataFrame
    transferred: DataFrame
    second_channel: DataFrame
    site_flags: DataFrame
    corporations: DataFrame
    pack_reference: DataFrame
    products: DataFrame
    policy_cities: DataFrame
    bids: DataFrame
    nature: DataFrame
    corporation_info: DataFrame
    profile: DataFrame
    city_names: DataFrame
    history: DataFrame


DELIVERED = [
    "packid", "channel", "province", "city", "quarter", "atc3", "market", "molecule", "product",
    "pack_desc", "corp_desc", "sales", "units", "dosage_units", "period_mat", "city_en",
    "class_label", "product_cn", "package", "dosage", "quantity", "policy", "name1", "name3",
    "name2", "maker_type", "class_name",
]
MEASURES = ["sales", "units", "dosage_units"]
DELIVERY_KEYS = [c for c in DELIVERED if c not in ("pack_desc", "dosage", *MEASURES)]


def current_channels(inputs: DeliveryInputs, periods: Periods, run: Run | None = None) -> DataFrame:
    """Totals of all channels at delivery grain."""
    flags = inputs.site_flags.filter(F.col("in_scope").isNotNull())
    sampled = deliver.flagged_site_filter(
        inputs.adjusted, flags, ["province", "city", "site"], "zs_flag",
        cfg.STRICT_FLAG_CITIES, [periods.report_quarter],
    )
    packs = deliver.corp_pack_reference(
        inputs.pack_reference.withColumn("packid", sem.pad_id("packid")),
        inputs.corporations, cfg.CORP_RENAMES,
    )
    products = inputs.products.withColumn("packid", sem.pad_id("packid"))
    facts = [*PLACE_PACK, "units", "sales"]
    rows = sampled.select(*facts).unionByName(inputs.transferred.select(*facts))
    args = (packs, products, PLACE_PACK, cfg.OVERRIDE_CHANNEL)
    rows = deliver.without_class(rows, cfg.SUPPLEMENT_CLASS)
    main = _keep(run)(deliver.delivery_aggregate(rows, *args, cfg.ORAL_FORMS), "delivery")
    extra = deliver.class_supplement(
        inputs.adjusted, *args, cfg.SUPPLEMENT_CLASS, cfg.ORAL_FORMS
    )
    names = {c: c for c in DELIVERED if c in main.columns}
    return deliver.channel_union(main, extra, inputs.second_channel, names=names)


def enrich(rows: DataFrame, inputs: DeliveryInputs, run: Run | None = None) -> DataFrame:
    """Policy, origin, profile, class and text attributes."""
    suffixed = F.regexp_replace("city", cfg.CITY_SUFFIX, "")
    cities = inputs.policy_cities.filter(F.col("policy") == cfg.POLICY_CATEGORY)
    bids = deliver.clean_bid_labels(
        inputs.bids, cfg.MERGED_BID_LABELS, cfg.MERGED_BID_LABEL, cfg.BID_SUFFIX
    )
    rows = _keep(run)(rows, "channels", MEASURES)
    out = deliver.policy_flags(rows, cities.withColumn("city", suffixed), bids)
    lookups = deliver.reference_split(
        inputs.nature,
        {
            "maker": ("corp_desc", "maker_type"),
            "class": ("atc3", "class_name"),
        },
    )
    molecules = deliver.molecule_flag(
        deliver.bid_labels(rows, bids), inputs.nature.select("molecule", "molecule_name").distinct(),
        cfg.BID_MOLECULE_LABEL, cfg.BID_MOLECULES,
    )
    makers = deliver.maker_type_bucket(
        inputs.corporation_info, cfg.MAKER_BUCKETS, cfg.DEFAULT_MAKER
    ).withColumnRenamed("maker_type", "maker_type1")
    out = sem.lookup_join(out.drop("name1", "product_code"), molecules, ["molecule"], ["name1"])
    out = sem.lookup_join(out, lookups["maker"], ["corp_desc"], ["maker_type"])
    out = sem.lookup_join(out, makers, ["corp_desc"], ["maker_type1"])
    out = sem.lookup_join(out, lookups["class"], ["atc3"], ["class_name"])
    out = deliver.origin_classification(
        out, cfg.ORIGIN_LABELS, cfg.BLANK_BID_LABEL, cfg.DROPPED_FORM_PATTERN
    )
    out = deliver.parse_pack_description(out, "pack_desc")
    profile = inputs.profile.withColumn("packid", sem.pad_id("packid"))
    out = deliver.two_level_code_fallback(out, profile, ["atc4", "product_cn"])
    out = sem.lookup_join(out, inputs.city_names, ["city"], ["city_en"])
    out = deliver.therapeutic_class_rules(
        out, cfg.CLASS_RULES, cfg.DROPPED_MOLECULE, cfg.DELIVERY_ROUNDING
    )
    return out.withColumn("period_mat", F.lit(None).cast("string")).select(*DELIVERED)


def delivery_job(inputs: DeliveryInputs, periods: Periods, run: Run | None = None) -> DataFrame:
    """The delivered history restated with the reporting quarter."""
    keep = _keep(run)
    new_rows = keep(enrich(current_channels(inputs, periods, run), inputs, run), "enriched", MEASURES)
    padded = inputs.history.withColumn("packid", sem.pad_id("packid"))
    corp = F.col("corp_desc")
    for product, name in cfg.CORP_BY_PRODUCT.items():
        corp = F.when(F.col("product") == product, F.lit(name)).otherwise(corp)
    history = conform.recode_ids(
        padded, prefix={"packid": cfg.PACK_PREFIX_RECODES}
    ).withColumn("corp_desc", corp)

    place = (F.col("channel") == cfg.OVERRIDE_CHANNEL) & F.col("city").isin(cfg.OVERRIDE_CITIES)
    override = deliver.pack_period_override(
        padded, place & (F.col("class_label") == cfg.OVERRIDE_LABEL), cfg.OVERRIDE_FACTORS
    )
    listed = F.col("packid").isin(sorted({pack for pack, _, _ in cfg.OVERRIDE_FACTORS}))
    form_ok = sem.not_in("market", cfg.FORM_CHECKED_MARKETS) | F.coalesce(
        F.substring("package", 1, 3).isin(cfg.DELIVERED_FORMS), F.lit(False)
    )
    out = deliver.restate_history(
        history, new_rows, override, [periods.report_quarter], place & listed, MEASURES, form_ok
    )
    out = deliver.fill_dosage(deliver.mat_label(out, periods.report_quarter), "pack_desc")
    out = deliver.consolidate_delivery(
        out, DELIVERY_KEYS, ["pack_desc", "dosage"], cfg.DELIVERY_ROUNDING
    )
    out = deliver.back_out_allocation(out, cfg.ALLOCATION, MEASURES)
    out = out.select(*DELIVERED, *[f"{m}_raw" for m in MEASURES])
    return run.stage(out, "delivered", MEASURES, {"quarter": [periods.report_quarter]}) if run else out


def delivery_export(delivered: DataFrame) -> DataFrame:
    """Sorted for export."""
    return deliver.ordered_delivery(
        delivered, delivered.columns,
        ["channel", "quarter", "province", "city", "market", "packid"],
    )
