"""Projection of the reporting sample to the universe of sites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions import semantics as sem
from panelcast.operators.conform import first_valid_by_key, union_feeds
from panelcast.sources.stages import stage


def site_universe(
    sample: DataFrame, reference: DataFrame, key: str, attrs: Sequence[str]
) -> DataFrame:
    """Sample sites and reference sites, first valid attributes, sample first."""
    sample_sites = sample.select(
        key, *[a for a in attrs if a in sample.columns]
    ).distinct()
    both = union_feeds(sample_sites, reference.select(key, *attrs))
    return first_valid_by_key(both, [key], attrs, rank="source_rank")


def _flag(df: DataFrame, ids: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """0/1 column telling whether the key occurs in a list."""
    marked = ids.select(*keys).distinct().withColumn(name, F.lit(1))
    return sem.null_safe_join(df, marked, keys, "left").withColumn(
        name, F.coalesce(name, F.lit(0))
    )


def panel_membership(sites: DataFrame, sample: DataFrame, key: str, size: str) -> DataFrame:
    """panel_all = 1 for sites that report and whose size is known."""
    flagged = _flag(sites, sample, [key], "_reports")
    member = (F.col("_reports") == 1) & F.col(size).isNotNull()
    return flagged.withColumn("panel_all", member.cast("int")).drop("_reports")


def trusted_sites(
    sites: DataFrame, outliers: DataFrame, historic: DataFrame, key: str
) -> DataFrame:
    """panel = panel_all without outliers and without sites new to the sample."""
    flagged = _flag(_flag(sites, outliers, [key], "_outlier"), historic, [key], "_historic")
    keep = (F.col("_outlier") == 0) & (F.col("_historic") == 1)
    return flagged.withColumn(
        "panel", F.when(keep, F.col("panel_all")).otherwise(F.lit(0))
    ).drop("_outlier", "_historic")


def demote_pairs(rows: DataFrame, pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """panel = 0 for the listed (site, market) pairs."""
    flagged = _flag(rows, pairs, keys, "flag_ot")
    return flagged.withColumn(
        "panel", F.when(F.col("flag_ot") == 1, F.lit(0)).otherwise(F.col("panel"))
    )


def panel_flags(
    rows: DataFrame,
    sample: DataFrame,
    outliers: DataFrame,
    flagged_pairs: DataFrame,
    historic: DataFrame,
    key: str,
    market: str,
    size: str,
) -> DataFrame:
    """All panel flags on site × market rows.

    In a job the site-level part is computed on the site dimension, before the
    universe is expanded; only the pair list is joined per market.
    """
    sites = trusted_sites(panel_membership(rows, sample, key, size), outliers, historic, key)
    return demote_pairs(sites, flagged_pairs, [key, market])


def assign_segment(
    sites: DataFrame,
    segments: DataFrame,
    city: str,
    district: str,
    split_cities: Sequence[str],
    default: int = 1,
) -> DataFrame:
    """Segment by city, or by city and district in the cities that are split."""

    def key() -> Column:
        return F.trim(
            F.when(F.col(city).isin(list(split_cities)), F.concat(city, district)).otherwise(
                F.col(city)
            )
        )

    table = segments.select(key().alias("seg_city"), "seg")
    keyed = sites.withColumn("seg_city", key())
    return sem.lookup_join(keyed, table, ["seg_city"], ["seg"]).withColumn(
        "seg", F.coalesce("seg", F.lit(default))
    )


def expand_universe(
    sites: DataFrame,
    packs: DataFrame,
    quarters: Sequence[str],
    area: Sequence[str],
    pack: Sequence[str],
    site: str = "site",
) -> DataFrame:
    """Each site × quarter × pack sold in the area of the site: the zero skeleton.

    The periods are a configured list, exploded in place. This is the largest
    intermediate of the projection; the job uses the compact forms below, which
    never build it.
    """
    local = packs.select(*area, *pack).distinct()
    periods = F.explode(F.array(*[F.lit(q) for q in quarters])).alias("quarter")
    return sem.fan_out_join(sites, local, area, site, "left").select("*", periods)


def zero_filled_panel(
    skeleton: DataFrame, observed: DataFrame, keys: Sequence[str], attrs: Sequence[str]
) -> DataFrame:
    """Panel rows of the skeleton with their quarter sales, 0 where none.

    Skeleton rows (unique per key) and observed rows are stacked and aggregated
    once. Grouping treats a missing key as equal to a missing key, partial sums
    are combined before the shuffle, and no join is needed.
    """
    base = skeleton.filter(F.col("panel") == 1).select(
        *keys, *attrs, F.lit(None).cast("double").alias("sales"), F.lit(1).alias("_in")
    )
    facts = observed.select(*keys, F.col("sales").cast("double"), F.lit(0).alias("_in"))
    return (
        base.unionByName(facts, allowMissingColumns=True)
        .groupBy(*keys)
        .agg(
            *[F.max(a).alias(a) for a in attrs],
            sem.sum0("sales").alias("panel_sales"),
            F.max("_in").alias("_in"),
        )
        .filter(F.col("_in") == 1)
        .drop("_in")
    )


def ratio_slope(panel: DataFrame, group: Sequence[str], y: str, x: str) -> DataFrame:
    """Ratio estimator per group: mean(y) / mean(x), no intercept."""
    return (
        panel.groupBy(*group)
        .agg(sem.sum0(y).alias("_y"), sem.sum0(x).alias("_x"))
        .select(*group, sem.ratio("_y", "_x").alias("slope"), F.lit(0.0).alias("intercept"))
    )


def average_rank(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    out: str,
    bands_per_octave: int = 64,
    weight: str | None = None,
) -> DataFrame:
    """Rank of a value within its group, ties sharing their average rank.

    With a weight, a row counts as that many rows of its value. Values are
    counted per group first. A group is then cut into bands by a
    fixed increasing function of the value: a rank is the size of the lower
    bands plus the position in the own band. No task has to sort a whole group,
    so a group that holds a third of the rows is ranked in many tasks.
    """
    magnitude = F.floor(F.log2(F.abs(F.col(value).cast("double")) + 1) * bands_per_octave)
    counts = (
        df.groupBy(*group, value)
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"))
        .withColumn("_band", (F.signum(value) * magnitude).cast("int"))
    )
    lower = Window.partitionBy(*group).orderBy("_band").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bands = (
        counts.groupBy(*group, "_band")
        .agg(F.sum("_n").alias("_band_n"))
        .select(*group, "_band", F.coalesce(F.sum("_band_n").over(lower), F.lit(0)).alias("_below"))
    )
    inside = Window.partitionBy(*group, "_band").orderBy(value).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = counts.withColumn("_upto", F.sum("_n").over(inside))
    ranks = sem.null_safe_join(running, bands, [*group, "_band"], "inner").select(
        *group,
        value,
        (F.col("_below") + F.col("_upto") - (F.col("_n") - 1) / F.lit(2.0)).alias(out),
    )
    return sem.null_safe_join(df, ranks, [*group, value], "left")


def spearman_by_group(panel: DataFrame, group: Sequence[str], y: str, x: str) -> DataFrame:
    """Rank correlation of y and its prediction slope · x; NULL if a side is constant.

    Multiplying by the slope does not change the order of x except for its sign,
    and a zero slope makes the prediction constant; so x itself is ranked.
    """
    ranked = average_rank(panel.select(*group, y, x), group, y, "_ry")
    ranked = average_rank(ranked, group, x, "_rx")
    slope_sign = F.nullif(F.signum(sem.sum0(y)) * F.signum(sem.sum0(x)), F.lit(0.0))
    return (
        ranked.groupBy(*group)
        .agg(
            F.covar_pop("_rx", "_ry").alias("_cov"),
            (F.stddev_pop("_rx") * F.stddev_pop("_ry")).alias("_dev"),
            slope_sign.alias("_sign"),
        )
        .select(*group, (sem.ratio("_cov", "_dev") * F.col("_sign")).alias("spearman_cor"))
    )


def spearman_compact(
    sites: DataFrame,
    packs: DataFrame,
    observed: DataFrame,
    flagged_pairs: DataFrame,
    quarters: Sequence[str],
    area: Sequence[str],
    pack: Sequence[str],
    group: Sequence[str],
    site: str = "site",
    size: str = "est",
) -> DataFrame:
    """The result of ``spearman_by_group`` on the zero-filled panel, without building that panel.

    Most cells of the panel are zero, and all zeros of a group share one rank
    that follows from their number. So only the rows with sales are ranked. The
    size of a site is ranked among the panel sites of the areas in which a
    group's packs are sold; groups that are sold in the same areas share that
    ranking, which is worked out once per set of areas. All sums of ranks run
    over rows with sales; what the zeros add is a closed form.

    ``observed`` holds quarter sums, one row per site, quarter and pack.
    """
    outer = [c for c in area if c in group]
    inner = [c for c in area if c not in group]
    fixed = [c for c in pack if c in group]  # the group's packs
    trusted = sites.filter(F.col("panel") == 1).select(site, *area, "seg", size)
    trusted = stage(with_flagged_markets(trusted, flagged_pairs, site), "trusted_sites")

    # Where each group's packs are sold, and by how many packs: the set of areas.
    local = packs.select(*area, *pack).distinct().groupBy(*area, *fixed).agg(F.count(F.lit(1)).alias("_packs"))
    places = F.array_sort(F.collect_list(F.struct(*inner, "_packs")))  # bounded by the number of areas
    sold = local.groupBy(*outer, *fixed).agg(places.alias("_places"))
    shared = [*outer, "market"]
    sold = stage(sold.withColumn("_set", F.sha2(F.to_json("_places"), 256)), "sold_areas")
    sets = sold.select(*shared, "_set", "_places").dropDuplicates([*shared, "_set"])
    sets = sets.select(*shared, "_set", F.inline("_places"))

    members = sem.null_safe_join(trusted, sets, area).filter(~_is_flagged())
    by_set = [*shared, "_set", "seg"]
    members = average_rank(members.select(*by_set, site, *inner, size, "_packs"), by_set, size, "_rx", weight="_packs")
    members = stage(members, "size_ranks")
    x, packs_there = F.col("_rx"), F.col("_packs")
    totals = members.groupBy(*by_set).agg(
        F.sum("_packs").cast("double").alias("_n"),
        F.sum(x * x * packs_there).alias("_xx"),
        sem.sum0(F.col(size) * packs_there).alias("_x"),
    )
    frame = sem.null_safe_join(sold.drop("_places"), totals, [*shared, "_set"]).withColumn(
        "quarter", F.explode(F.array(*[F.lit(q) for q in quarters]))
    )

    # Rows with sales: their rank among each other, and the rank of their site's size.
    rows = sem.null_safe_join(
        observed.filter((F.col("sales") != 0) & F.col("quarter").isin(list(quarters))).select(site, *area, *pack, "quarter", "sales"),
        trusted.select(site, *area, "seg", "flagged"),
        [site, *area],
    ).filter(~_is_flagged())
    rows = sem.null_safe_join(rows.drop("flagged"), sold.drop("_places"), [*outer, *fixed])
    rows = sem.null_safe_join(rows, members.select(*by_set, site, *inner, "_rx"), [*by_set, site, *inner])
    rows = average_rank(rows.select(*group, "sales", "_rx"), group, "sales", "_ry")
    y, above = F.col("_ry"), (F.col("sales") > 0).cast("int")
    sums = rows.groupBy(*group).agg(
        F.count(F.lit(1)).cast("double").alias("_k"),
        F.sum(above).cast("double").alias("_above"),
        F.sum(y * y).alias("_yy"),
        F.sum(y * above).alias("_y_above"),
        F.sum(x * y).alias("_xy"),
        F.sum("_rx").alias("_x_rows"),
        F.sum(x * above).alias("_x_above"),
        sem.sum0("sales").alias("_sales"),
    )
    all_ = sem.null_safe_join(frame, sums, group, "left").na.fill(
        0.0, ["_k", "_above", "_yy", "_y_above", "_xy", "_x_rows", "_x_above", "_sales"]
    )
    c = F.col
    zeros = c("_n") - c("_k")
    zero_rank = c("_k") - c("_above") + (zeros + 1) / 2
    # Ranks above the zeros move up by their number.
    yy = c("_yy") + 2 * zeros * c("_y_above") + zeros * zeros * c("_above") + zeros * zero_rank * zero_rank
    xy = c("_xy") + zeros * c("_x_above") + zero_rank * (c("_n") * (c("_n") + 1) / 2 - c("_x_rows"))
    middle = c("_n") * (c("_n") + 1) * (c("_n") + 1) / 4
    sign = F.nullif(F.signum("_sales") * F.signum("_x"), F.lit(0.0))
    deviation = F.sqrt(c("_xx") - middle) * F.sqrt(yy - middle)
    return all_.select(*group, (sem.ratio(xy - middle, deviation) * sign).alias("spearman_cor"))


def match_uniqueness(before: DataFrame, after: DataFrame, measure: str) -> DataFrame:
    """Totals before and after a join; unique is false if the join multiplied rows."""
    both = before.select(F.lit(0).alias("_side"), measure).unionByName(
        after.select(F.lit(1).alias("_side"), measure)
    )
    return both.agg(
        sem.sum_where(F.col("_side") == 0, measure).alias("total_before"),
        sem.sum_where(F.col("_side") == 1, measure).alias("total_after"),
    ).withColumn("unique_match", F.col("total_after") <= F.col("total_before"))


def sites_per_area(sites: DataFrame, area: Sequence[str]) -> DataFrame:
    return sites.groupBy(*area).agg(F.count(F.lit(1)).alias("n"))


def score_universe(
    universe: DataFrame,
    observed: DataFrame,
    slopes: DataFrame,
    factors: DataFrame,
    keys: Sequence[str],
    slope_keys: Sequence[str],
    size: str = "est",
) -> DataFrame:
    """Final sales per universe row (long form, on the expanded skeleton).

    Observed sales for sites of the sample, otherwise size × slope × factor;
    only positive results are kept.
    """
    sales = observed.groupBy(*keys).agg(sem.sum0("sales").alias("panel_sales"))
    rows = sem.null_safe_join(universe, sales, keys, "left")
    rows = sem.null_safe_join(rows, slopes, slope_keys, "left")
    rows = sem.lookup_join(rows, factors, ["market", "seg"], ["factor"])
    predicted = F.greatest(
        F.col(size) * F.col("slope") + F.col("intercept"), F.lit(0.0)
    )
    # greatest() skips NULL, so a row without a slope must be kept NULL by hand.
    predicted = F.when(F.col("slope").isNotNull(), predicted)
    final = F.when(F.col("panel_all") == 0, predicted * F.col("factor")).otherwise(
        F.coalesce("panel_sales", F.lit(0.0))
    )
    return (
        rows.withColumn("final_sales", final)
        .filter(F.col("final_sales") > 0)
        .drop("panel_sales", "slope", "intercept", "factor")
    )


def with_flagged_markets(sites: DataFrame, pairs: DataFrame, site: str) -> DataFrame:
    """The flagged markets of each site as an array on the site dimension.

    A site has at most as many flagged markets as there are markets, so facts
    that are joined to their site need no second join to the pair list.
    """
    flagged = pairs.groupBy(site).agg(F.collect_set("market").alias("flagged"))
    return sem.null_safe_join(sites, flagged, [site], "left")


def _is_flagged() -> Column:
    return F.coalesce(F.array_contains("flagged", F.col("market")), F.lit(False))


def ratio_slope_compact(
    sites: DataFrame,
    packs: DataFrame,
    observed: DataFrame,
    flagged_pairs: DataFrame,
    area: Sequence[str],
    pack: Sequence[str],
    group: Sequence[str],
    site: str = "site",
    size: str = "est",
) -> DataFrame:
    """The positive slopes of ``ratio_slope`` without expanding the universe.

    mean(sales) / mean(size) over the panel sites of a group is Σ sales / Σ size.
    Σ size needs only the size of the panel per area, segment and market, times
    the packs sold in that area; Σ sales needs only rows that exist. Both are
    aggregated before anything is joined to packs.
    """
    trusted = sites.filter(F.col("panel") == 1).select(site, *area, "seg", size)
    trusted = with_flagged_markets(trusted, flagged_pairs, site)
    local = packs.select(*area, *pack).distinct()
    markets = local.select(*area, "market").distinct()

    # Flagged pairs are few: take their size out of the total of their area.
    total = trusted.groupBy(*area, "seg").agg(sem.sum0(size).alias("_all"))
    out = trusted.select(*area, "seg", size, F.explode("flagged").alias("market"))
    out = out.groupBy(*area, "seg", "market").agg(sem.sum0(size).alias("_out"))
    sizes = sem.null_safe_join(total, markets, area)
    sizes = sem.null_safe_join(sizes, out, [*area, "seg", "market"], "left").select(
        *area, "seg", "market", (F.col("_all") - F.coalesce("_out", F.lit(0.0))).alias("_x")
    )
    sizes = sem.null_safe_join(sizes, local, [*area, "market"])
    by = [c for c in group if c != "quarter"]
    sizes = sizes.groupBy(*by).agg(sem.sum0("_x").alias("_x"))

    rows = sem.null_safe_join(
        observed.select(site, *area, *pack, "quarter", "sales"),
        trusted.select(site, *area, "seg", "flagged"),
        [site, *area],
    )
    sales = rows.filter(~_is_flagged()).groupBy(*group).agg(sem.sum0("sales").alias("_y"))
    return (
        sem.null_safe_join(sales, sizes, by)
        .filter((F.col("_y") > 0) & (F.col("_x") > 0))
        .select(*group, sem.ratio("_y", "_x").alias("slope"), F.lit(0.0).alias("intercept"))
    )


def score_universe_compact(
    sites: DataFrame,
    packs: DataFrame,
    observed: DataFrame,
    flagged_pairs: DataFrame,
    slopes: DataFrame,
    factors: DataFrame,
    area: Sequence[str],
    pack: Sequence[str],
    slope_keys: Sequence[str],
    site: str = "site",
    size: str = "est",
) -> DataFrame:
    """The rows of ``score_universe`` without the zero skeleton.

    ``observed`` holds quarter sums, one row per site, quarter and pack. Only
    positive results are kept in the end, so it is enough to take the observed
    sums of reporting sites and to bring positive slopes, per area and segment,
    to the sites that do not report. The latter are outside the panel anyway,
    so the flagged pairs matter for reporting sites only.
    """
    attrs = [site, *area, "seg", "panel", "panel_all", size]
    reporting = with_flagged_markets(
        sites.filter(F.col("panel_all") != 0).select(*attrs), flagged_pairs, site
    )
    own = observed.select("quarter", site, *area, *pack, F.col("sales").alias("final_sales"))
    reporting = sem.null_safe_join(own, reporting, [site, *area]).withColumn(
        "panel", F.when(_is_flagged(), F.lit(0)).otherwise(F.col("panel"))
    ).drop("flagged")

    quiet = sites.filter(F.col("panel_all") == 0).select(*attrs)
    rates = sem.lookup_join(
        slopes.filter(F.col("slope") > 0), factors, ["market", "seg"], ["factor"]
    )
    # What is offered to an area and segment is worked out before any site is joined.
    offer = sem.null_safe_join(
        quiet.select(*area, "seg").distinct(), packs.select(*area, *pack).distinct(), area
    )
    offer = sem.null_safe_join(offer, rates, [k for k in slope_keys if k != "quarter"])
    predicted = F.greatest(F.col(size) * F.col("slope") + F.col("intercept"), F.lit(0.0))
    silent = (
        sem.fan_out_join(quiet, offer, [*area, "seg"], site)
        .withColumn("final_sales", predicted * F.col("factor"))
        .drop("slope", "intercept", "factor")
    )
    return reporting.unionByName(silent).filter(F.col("final_sales") > 0)


def equal_share_allocation(
    observed: DataFrame,
    universe: DataFrame,
    area: Sequence[str],
    item: Sequence[str],
    site: str = "site",
) -> DataFrame:
    """Area total per item ÷ number of sites, given to each unobserved site."""
    totals = observed.groupBy(*area, *item).agg(sem.sum0("sales").alias("_total"))
    counted = sem.null_safe_join(totals, sites_per_area(universe, area), area, "left")
    share = counted.select(*area, *item, sem.ratio("_total", "n").alias("final_sales"))
    silent = sem.null_safe_join(
        universe.select(site, *area), observed.select(site).distinct(), [site], "left_anti"
    )
    return sem.fan_out_join(silent, share, area, site, "left").withColumn("panel", F.lit(0))


def observed_passthrough(
    observed: DataFrame,
    allocated: DataFrame,
    area: Sequence[str],
    item: Sequence[str],
    site: str = "site",
) -> DataFrame:
    """Own sums of the observed sites (panel = 1) with the allocated rows, > 0."""
    own = (
        observed.groupBy(site, *area, *item)
        .agg(sem.sum0("sales").alias("final_sales"))
        .withColumn("panel", F.lit(1))
    )
    return own.unionByName(allocated).filter(F.col("final_sales") > 0)


def projection_rollup(*parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Union of the projected parts at the final grain."""
    merged = union_feeds(*[p.select(*keys, "sales") for p in parts])
    return merged.groupBy(*keys).agg(sem.sum0("sales").alias("sales"))
