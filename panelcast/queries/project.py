"""Projection on the test tables: regions as cities, item names as packs."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions import semantics as sem
from panelcast.operators import project as op
from panelcast.queries import bindings as b
from panelcast.queries.registry import in_, query, rounded, total0, using, with_
from panelcast.sources.stages import stage

AREA = ["province", "city"]
PACK = ["market", "item"]
KEYS = ["quarter", "site", *AREA, *PACK]
GROUP = ["province", "quarter", "item", "market", "seg"]
ITEM = ["quarter", *PACK]


def _list(keys):
    return ", ".join(keys)


_FLAGS = f"""segments AS (
  SELECT DISTINCT CASE WHEN city = '{b.SPLIT_CITY}' THEN city || district ELSE city END AS seg_city,
         CASE WHEN city = '{b.SPLIT_CITY}' THEN 2 + site_key % 2
              WHEN CAST(substr(city, 8) AS INTEGER) % 5 = 0 THEN NULL
              ELSE CAST(substr(city, 8) AS INTEGER) % 3 + 1 END AS seg
  FROM sites),
keyed AS (
  SELECT site, province, city, district, est, size,
         CASE WHEN city = '{b.SPLIT_CITY}' THEN city || district ELSE city END AS seg_city
  FROM sites),
members AS (
  SELECT k.site, k.province, k.city, k.est, k.size, k.seg_city,
         CAST(k.site IN (SELECT site FROM sample) AS INTEGER) AS panel_all
  FROM keyed k WHERE est IS NOT NULL),
psites AS (
  SELECT k.site, k.province, k.city, k.est, k.size, CAST(coalesce(seg, 1) AS INTEGER) AS seg,
         panel_all,
         CASE WHEN k.size > {b.OUTLIER_SIZE}
                OR k.size BETWEEN {b.NEW_SITES[0]} AND {b.NEW_SITES[1]} THEN 0
              ELSE panel_all END AS panel
  FROM members k LEFT JOIN segments s USING (seg_city)),
pairs AS (
  SELECT DISTINCT site, market FROM sample
  WHERE market = '{b.DOUBTFUL[0]}' AND size BETWEEN {b.DOUBTFUL[1]} AND {b.DOUBTFUL[2]})"""
_OBSERVED = f"""observed AS (
  SELECT quarter, site, province, city, market, item, sales
  FROM sample WHERE quarter IN {in_(b.PERIODS)}),
local AS (SELECT DISTINCT province, city, market, item FROM observed)"""
_UNIVERSE = f"""universe AS (
  SELECT s.site, s.province, s.city, s.est, s.seg, s.panel_all, q.quarter, l.market, l.item,
         CAST(p.site IS NOT NULL AS INTEGER) AS flag_ot,
         CASE WHEN p.site IS NOT NULL THEN 0 ELSE s.panel END AS panel
  FROM psites s CROSS JOIN (VALUES {', '.join(f"('{q}')" for q in b.PERIODS)}) q(quarter)
  LEFT JOIN local l ON l.province = s.province AND l.city = s.city
  LEFT JOIN pairs p ON p.site = s.site AND p.market IS NOT DISTINCT FROM l.market)"""
_ZERO = f"""quarter_sales AS (
  SELECT {_list(KEYS)}, {total0('sales')} AS panel_sales FROM observed GROUP BY {_list(KEYS)}),
zero_filled AS (
  SELECT {_list('u.' + k for k in KEYS)}, u.est, u.seg, coalesce(o.panel_sales, 0.0) AS panel_sales
  FROM universe u LEFT JOIN quarter_sales o ON {using(KEYS, 'u', 'o')} WHERE u.panel = 1)"""
_SLOPES = f"""slopes AS (
  SELECT {_list(GROUP)}, {total0('panel_sales')} / nullif({total0('est')}, 0) AS slope, 0.0 AS intercept
  FROM zero_filled GROUP BY {_list(GROUP)})"""
_FACTORS = """factors AS (
  SELECT market, seg, CASE WHEN NOT (market = 'SMALL' AND seg = 3) THEN 0.5 + seg * 0.25 END AS factor
  FROM (SELECT DISTINCT market FROM packs) CROSS JOIN (VALUES (1), (2), (3)) s(seg))"""
_SCORED = f"""predicted AS (
  SELECT u.*, coalesce(o.panel_sales, 0.0) AS panel_sales,
         CASE WHEN u.est * slope + intercept < 0 THEN 0 ELSE u.est * slope + intercept END AS pred,
         factor
  FROM universe u LEFT JOIN quarter_sales o ON {using(KEYS, 'u', 'o')}
  LEFT JOIN slopes s ON {using(GROUP, 'u', 's')}
  LEFT JOIN factors f ON f.market = u.market AND f.seg = u.seg),
scored AS (
  SELECT site, province, city, est, seg, panel_all, quarter, market, item, panel,
         CASE WHEN panel_all = 0 THEN pred * factor ELSE panel_sales END AS final_sales
  FROM predicted
  WHERE CASE WHEN panel_all = 0 THEN pred * factor ELSE panel_sales END > 0)"""
_CHAIN = [b.SAMPLE, _FLAGS, _OBSERVED, _UNIVERSE, _ZERO, _SLOPES, _FACTORS, _SCORED]


def segments(spark, sf):
    nation_key = F.substring("city", 8, 5).cast("int")
    return b.sites(spark, sf).select(
        "city",
        "district",
        F.when(F.col("city") == b.SPLIT_CITY, (F.col("site_key") % 2 + 2).cast("int"))
        .when(nation_key % 5 != 0, nation_key % 3 + 1)
        .alias("seg"),
    )


def site_markets(spark, sf):
    """Distinct site × market of the sample."""
    return b.sample(spark, sf).select("site", "market", "size").distinct()


def projected_sites(spark, sf, reporting):
    """The site dimension with size, segment and site-level panel flags."""
    sites = b.sites(spark, sf)
    flagged = op.panel_membership(
        sites.filter(F.col("est").isNotNull()), reporting, "site", "est"
    )
    flagged = op.trusted_sites(
        flagged,
        sites.filter(F.col("size") > b.OUTLIER_SIZE),
        sites.filter(~F.col("size").between(*b.NEW_SITES)),
        "site",
    )
    return op.assign_segment(
        flagged, segments(spark, sf), "city", "district", [b.SPLIT_CITY]
    ).select("site", *AREA, "est", "seg", "panel_all", "panel")


def flagged_pairs(seen):
    market, low, high = b.DOUBTFUL
    return seen.filter((F.col("market") == market) & F.col("size").between(low, high)).select(
        "site", "market"
    )


def observed(spark, sf):
    """Quarter sales per site and pack: the only pass over the transactions."""
    return (
        b.sample(spark, sf)
        .filter(F.col("quarter").isin(b.PERIODS))
        .groupBy(*KEYS)
        .agg(sem.sum0("sales").alias("sales"))
    )


def factors(spark, sf):
    rows = b.packs(spark, sf).select("market").distinct()
    rows = rows.withColumn("seg", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    known = ~((F.col("market") == "SMALL") & (F.col("seg") == 3))
    return rows.withColumn("factor", F.when(known, F.lit(0.5) + F.col("seg") * 0.25))


class Projection:
    """Inputs of the projection, stored once because every step reads them again."""

    def __init__(self, spark, sf):
        self.observed = stage(observed(spark, sf), "quarter_sales")
        seen = stage(site_markets(spark, sf), "site_markets")
        self.sites = stage(projected_sites(spark, sf, seen), "sites")
        self.pairs = flagged_pairs(seen)
        self.factors = factors(spark, sf)

    def universe(self):
        rows = op.expand_universe(self.sites, self.observed, b.PERIODS, AREA, PACK)
        return op.demote_pairs(rows, self.pairs, ["site", "market"])

    def zero_filled(self):
        return op.zero_filled_panel(self.universe(), self.observed, KEYS, ["est", "seg"])

    def slopes(self):
        return op.ratio_slope_compact(
            self.sites, self.observed, self.observed, self.pairs, AREA, PACK, GROUP
        )

    def scored(self):
        return op.score_universe_compact(
            self.sites, self.observed, self.observed, self.pairs, self.slopes(), self.factors,
            AREA, PACK, GROUP,
        )


@query(
    with_(
        b.SAMPLE,
        """reference AS (SELECT site, province, CASE WHEN size > 8000 THEN NULL ELSE city END AS city,
                                district, est FROM sites),
           both_ AS (SELECT DISTINCT 0 AS r, site, province, city, NULL AS district, CAST(NULL AS DOUBLE) AS est
                     FROM sample UNION ALL SELECT 1, site, province, city, district, est FROM reference)""",
        """SELECT site,
                  (min({'r': r, 'v': province}) FILTER (WHERE province IS NOT NULL)).v AS province,
                  (min({'r': r, 'v': city}) FILTER (WHERE city IS NOT NULL)).v AS city,
                  (min({'r': r, 'v': district}) FILTER (WHERE district IS NOT NULL)).v AS district,
                  (min({'r': r, 'v': est}) FILTER (WHERE est IS NOT NULL)).v AS est
           FROM both_ GROUP BY site""",
    )
)
def site_universe(spark, sf):
    reference = b.sites(spark, sf).withColumn(
        "city", F.when(F.col("size") <= 8000, F.col("city"))
    )
    seen = b.sample(spark, sf).select("site", "province", "city")
    return op.site_universe(seen, reference, "site", ["province", "city", "district", "est"])


@query(
    with_(
        b.SAMPLE, _FLAGS,
        """rows_ AS (SELECT s.site, s.est, s.size, p.market,
                            CAST(s.est IS NOT NULL AND s.site IN (SELECT site FROM sample) AS INTEGER)
                                AS panel_all
                     FROM sites s CROSS JOIN (SELECT DISTINCT market FROM packs) p)""",
        f"""SELECT r.site, r.est, r.market, panel_all,
                   CAST(q.site IS NOT NULL AS INTEGER) AS flag_ot,
                   CASE WHEN r.size > {b.OUTLIER_SIZE} OR q.site IS NOT NULL
                          OR r.size BETWEEN {b.NEW_SITES[0]} AND {b.NEW_SITES[1]} THEN 0
                        ELSE panel_all END AS panel
            FROM rows_ r LEFT JOIN pairs q ON q.site = r.site AND q.market = r.market""",
    )
)
def panel_flags(spark, sf):
    sites = b.sites(spark, sf)
    markets = [F.lit(m) for m in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")]
    rows = sites.select("site", "est", F.explode(F.array(*markets)).alias("market"))
    seen = stage(site_markets(spark, sf), "site_markets")
    return op.panel_flags(
        rows,
        seen,
        sites.filter(F.col("size") > b.OUTLIER_SIZE),
        flagged_pairs(seen),
        sites.filter(~F.col("size").between(*b.NEW_SITES)),
        "site", "market", "est",
    )


@query(
    with_(
        b.SAMPLE, _FLAGS,
        """SELECT k.site, k.city, k.district, k.seg_city, CAST(coalesce(seg, 1) AS INTEGER) AS seg
           FROM keyed k LEFT JOIN segments USING (seg_city)""",
    )
)
def assign_segment(spark, sf):
    rows = b.sites(spark, sf).select("site", "city", "district")
    return op.assign_segment(rows, segments(spark, sf), "city", "district", [b.SPLIT_CITY])


@query(with_(*_CHAIN[:4], "SELECT * EXCLUDE (flag_ot, panel), panel FROM universe"))
def expand_universe(spark, sf):
    return Projection(spark, sf).universe().drop("flag_ot")


@query(with_(*_CHAIN[:5], "SELECT * FROM zero_filled"))
def zero_filled_panel(spark, sf):
    return Projection(spark, sf).zero_filled()


@query(with_(*_CHAIN[:6], "SELECT * FROM slopes"))
def ratio_slope(spark, sf):
    return op.ratio_slope(Projection(spark, sf).zero_filled(), GROUP, "panel_sales", "est")


@query(with_(*_CHAIN[:6], "SELECT * FROM slopes WHERE slope > 0"))
def ratio_slope_compact(spark, sf):
    return Projection(spark, sf).slopes()


@query(
    with_(
        *_CHAIN[:6],
        f"""fitted AS (
             SELECT {_list('z.' + g for g in GROUP)}, panel_sales, z.est * s.slope AS fit
             FROM zero_filled z JOIN slopes s ON {using(GROUP, 'z', 's')}),
        ranked AS (
             SELECT *, rank() OVER (PARTITION BY {_list(GROUP)} ORDER BY panel_sales)
                       + (count(*) OVER (PARTITION BY {_list(GROUP)}, panel_sales) - 1) / 2.0 AS ry,
                    rank() OVER (PARTITION BY {_list(GROUP)} ORDER BY fit)
                       + (count(*) OVER (PARTITION BY {_list(GROUP)}, fit) - 1) / 2.0 AS rx
             FROM fitted),
        moments AS (
             SELECT {_list(GROUP)}, covar_pop(rx, ry) AS c, stddev_pop(rx) * stddev_pop(ry) AS d
             FROM ranked GROUP BY {_list(GROUP)})""",
        f"SELECT {_list(GROUP)}, round(c / nullif(d, 0), 6) AS spearman_cor FROM moments",
    )
)
def spearman_by_group(spark, sf):
    p = Projection(spark, sf)
    out = op.spearman_compact(
        p.sites, p.observed, p.observed, p.pairs, b.PERIODS, AREA, PACK, GROUP
    )
    return rounded(out, 6, "spearman_cor")


@query(
    with_(
        *_CHAIN[:5],
        f"""matched AS (SELECT o.panel_sales FROM universe u
                        JOIN quarter_sales o ON {using(KEYS, 'u', 'o')})""",
        f"""SELECT b.t AS total_before, a.t AS total_after, a.t <= b.t AS unique_match
            FROM (SELECT {total0('panel_sales')} AS t FROM quarter_sales) b,
                 (SELECT {total0('panel_sales')} AS t FROM matched) a""",
    )
)
def match_uniqueness(spark, sf):
    p = Projection(spark, sf)
    sales = p.observed.withColumnRenamed("sales", "panel_sales")
    matched = sem.null_safe_join(p.universe(), sales, KEYS)
    return op.match_uniqueness(sales, matched, "panel_sales")


@query(with_(b.SITES, "SELECT province, city, district, count(*) AS n FROM sites GROUP BY ALL"))
def sites_per_area(spark, sf):
    return op.sites_per_area(b.sites(spark, sf), ["province", "city", "district"])


@query(with_(*_CHAIN, "SELECT * FROM scored"))
def score_universe(spark, sf):
    """The compact form used by the job."""
    return Projection(spark, sf).scored()


@query(with_(*_CHAIN, "SELECT * FROM scored"))
def score_universe_long(spark, sf):
    """The long form on the expanded skeleton."""
    p = Projection(spark, sf)
    slopes = op.ratio_slope(p.zero_filled(), GROUP, "panel_sales", "est")
    return op.score_universe(
        p.universe(), p.observed, slopes, p.factors, KEYS, GROUP
    ).drop("flag_ot")


_EQUAL = f"""area_sales AS (SELECT * FROM observed WHERE province = '{b.EQUAL_SHARE_PROVINCE}'),
area_sites AS (SELECT site, province, city FROM sites WHERE province = '{b.EQUAL_SHARE_PROVINCE}'),
share AS (
  SELECT t.province, t.city, t.quarter, t.market, t.item, t.total / n.n AS final_sales
  FROM (SELECT province, city, quarter, market, item, {total0('sales')} AS total
        FROM area_sales GROUP BY ALL) t
  LEFT JOIN (SELECT province, city, count(*) AS n FROM area_sites GROUP BY ALL) n USING (province, city)),
allocated AS (
  SELECT s.site, s.province, s.city, h.quarter, h.market, h.item, h.final_sales, 0 AS panel
  FROM area_sites s LEFT JOIN share h USING (province, city)
  WHERE s.site NOT IN (SELECT site FROM area_sales))"""
_PASS = f"""passed AS (
  SELECT * FROM (
    SELECT site, province, city, quarter, market, item, {total0('sales')} AS final_sales, 1 AS panel
    FROM area_sales GROUP BY site, province, city, quarter, market, item
    UNION ALL SELECT * FROM allocated)
  WHERE final_sales > 0)"""


def _equal_share_scope(spark, sf):
    here = F.col("province") == b.EQUAL_SHARE_PROVINCE
    return stage(observed(spark, sf).filter(here), "area_sales"), b.sites(spark, sf).filter(here)


@query(with_(b.SAMPLE, _OBSERVED, _EQUAL, "SELECT * FROM allocated"))
def equal_share_allocation(spark, sf):
    rows, sites = _equal_share_scope(spark, sf)
    return op.equal_share_allocation(rows, sites, AREA, ITEM)


@query(with_(b.SAMPLE, _OBSERVED, _EQUAL, _PASS, "SELECT * FROM passed"))
def observed_passthrough(spark, sf):
    rows, sites = _equal_share_scope(spark, sf)
    allocated = op.equal_share_allocation(rows, sites, AREA, ITEM)
    return op.observed_passthrough(rows, allocated, AREA, ITEM)


_ROLLUP = ["quarter", "province", "site", "market", "item", "panel"]


@query(
    with_(
        *_CHAIN, _EQUAL, _PASS,
        f"""parts AS (SELECT {_list(_ROLLUP)}, final_sales FROM scored
                      WHERE province <> '{b.EQUAL_SHARE_PROVINCE}'
                      UNION ALL SELECT {_list(_ROLLUP)}, final_sales FROM passed)""",
        f"""SELECT {_list(_ROLLUP)}, {total0('final_sales')} AS sales
            FROM parts GROUP BY {_list(_ROLLUP)}""",
    )
)
def projection_rollup(spark, sf):
    p = Projection(spark, sf)
    rows = p.observed.filter(F.col("province") == b.EQUAL_SHARE_PROVINCE)
    sites = b.sites(spark, sf).filter(F.col("province") == b.EQUAL_SHARE_PROVINCE)
    allocated = op.equal_share_allocation(rows, sites, AREA, ITEM)
    equal = op.observed_passthrough(rows, allocated, AREA, ITEM)
    most = p.scored().filter(F.col("province") != b.EQUAL_SHARE_PROVINCE)
    parts = [p.withColumnRenamed("final_sales", "sales") for p in (most, equal)]
    return op.projection_rollup(*parts, keys=_ROLLUP)
