"""Class reassignment, split and scaling on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.operators import adjust as op
from panelcast.operators.deliver import back_out_allocation as back_out
from panelcast.queries import bindings as b
from panelcast.queries import price
from panelcast.queries.registry import query, total, values, with_

MARKETS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"]
CLASSES, MARKET = ["C07", "C08"], "PROMO"
EXCLUDED = [("PROMO", "Brand#12"), ("LARGE", "Brand#3")]
ALLOCATION = [
    ("C07", "PROMO", 0.25), ("C07", "STANDARD", 0.75),
    ("C08", "PROMO", 0.10), ("C08", "STANDARD", 0.90),
]
OVERRIDES = [
    ("NATION_1", None, 0.5), ("NATION_7", None, 10.0), ("NATION_9", "PROMO", 0.3),
    ("NATION_9", "LARGE", 1.8),
]
COLUMNS = ["site", "city", "packid", "date", "market", "molecule", "atc3", "sales", "units", "size"]

_MOVED = f"""moved AS (
  SELECT * FROM (
    SELECT {', '.join(c for c in COLUMNS if c != 'market')}, substr(atc3, 1, 3) AS atc2,
           CASE WHEN substr(atc3, 1, 3) IN ('C07', 'C08') THEN 'PROMO'
                ELSE nullif(market, 'SMALL') END AS market
    FROM panel)
  WHERE ((market = 'PROMO' AND molecule = 'Brand#12')
         OR (market = 'LARGE' AND molecule = 'Brand#3')) IS NOT TRUE)"""
_SPLIT = values(ALLOCATION, ["class", "target", "share"], "allocation") + """,
split AS (
  SELECT m.site, m.city, m.packid, m.date, m.molecule, m.atc3, m.atc2, m.size,
         coalesce(a.target, m.market) AS market,
         m.sales * coalesce(a.share, 1.0) AS sales, m.units * coalesce(a.share, 1.0) AS units
  FROM moved m LEFT JOIN allocation a ON a.class = m.atc2)"""
_GRID = values([(m,) for m in MARKETS], ["market"], "markets") + """,
grid AS (
  SELECT c.city, m.market,
         CASE WHEN c.city = 'NATION_1' THEN 0.5 WHEN c.city = 'NATION_7' THEN 10.0
              WHEN c.city = 'NATION_9' AND m.market = 'PROMO' THEN 0.3
              WHEN c.city = 'NATION_9' AND m.market = 'LARGE' THEN 1.8 ELSE 1.0 END AS factor
  FROM (SELECT n_name AS city FROM nation) c CROSS JOIN markets m)"""


def moved(spark, sf):
    rows = b.panel(spark, sf).select(*COLUMNS)
    rows = rows.withColumn("market", F.nullif(F.col("market"), F.lit("SMALL")))
    return op.reassign_and_exclude(rows, CLASSES, MARKET, EXCLUDED)


def split(spark, sf):
    return op.split_across_markets(moved(spark, sf), ALLOCATION, ["sales", "units"])


def grid(spark, sf):
    cities = b.table(spark, sf, "nation").select(F.col("n_name").alias("city"))
    return op.factor_grid(cities, MARKETS, OVERRIDES)


def flagged(spark, sf):
    panel = (F.col("size") >= b.REPORTING_SIZE).cast("int")
    return split(spark, sf).withColumn("panel", panel)


@query(with_(b.PANEL, _MOVED, "SELECT * FROM moved"))
def reassign_and_exclude(spark, sf):
    return moved(spark, sf)


@query(with_(b.PANEL, _MOVED, _SPLIT, "SELECT * FROM split"))
def split_across_markets(spark, sf):
    return split(spark, sf)


@query(with_(_GRID, "SELECT city, market, CAST(factor AS DOUBLE) AS factor FROM grid"))
def factor_grid(spark, sf):
    return grid(spark, sf)


_SCALED = f"""flagged AS (SELECT *, CAST(size >= {b.REPORTING_SIZE} AS INTEGER) AS panel FROM split),
scaled AS (
  SELECT f.* EXCLUDE (sales, units),
         f.sales * CASE WHEN f.panel = 1 THEN 1.0 ELSE coalesce(g.factor, 1.0) END::DOUBLE AS sales,
         f.units * CASE WHEN f.panel = 1 THEN 1.0 ELSE coalesce(g.factor, 1.0) END::DOUBLE AS units
  FROM flagged f LEFT JOIN grid g ON g.city = f.city AND g.market = f.market)"""


@query(with_(b.PANEL, _MOVED, _SPLIT, _GRID, _SCALED, "SELECT * FROM scaled"))
def scale_unobserved(spark, sf):
    return op.scale_unobserved(flagged(spark, sf), grid(spark, sf))


@query(
    with_(
        b.PANEL, _MOVED, _SPLIT, _GRID, _SCALED,
        f"""SELECT city, {total('CASE WHEN panel = 0 THEN sales END')} AS unobserved,
                   {total('CASE WHEN panel = 1 THEN sales END')} AS observed
            FROM flagged GROUP BY city""",
    )
)
def crosstab(spark, sf):
    return op.crosstab(flagged(spark, sf), "city", "panel", {0: "unobserved", 1: "observed"}, "sales")


@query(
    with_(
        b.PANEL, _MOVED, _SPLIT,
        """SELECT s.*, s.sales / coalesce(a.share, 1.0) AS sales_raw,
                  s.units / coalesce(a.share, 1.0) AS units_raw
           FROM split s LEFT JOIN allocation a ON a.class = s.atc2 AND a.target = s.market""",
    )
)
def back_out_allocation(spark, sf):
    return back_out(split(spark, sf), ALLOCATION, ["sales", "units"])


@query(
    with_(
        b.PANEL, price.PRICED,
        """ladder AS (SELECT *, sales / nullif(price, 0) AS units FROM priced
                      WHERE sales > 0 AND price > 0 AND sales / nullif(price, 0) > 0)""",
        """moved AS (
             SELECT * FROM (
               SELECT l.* REPLACE (CASE WHEN substr(atc3, 1, 3) IN ('C07', 'C08') THEN 'PROMO'
                                        ELSE market END AS market), substr(atc3, 1, 3) AS atc2
               FROM ladder l)
             WHERE NOT (market = 'PROMO' AND molecule = 'Brand#12')
               AND NOT (market = 'LARGE' AND molecule = 'Brand#3'))""",
        values(ALLOCATION, ["class", "target", "share"], "allocation"),
        _GRID,
        """factors AS (
             SELECT m.*, coalesce(a.target, m.market) AS new_market, coalesce(a.share, 1.0) AS share,
                    CAST(s.size >= 1500 AS INTEGER) AS panel
             FROM moved m LEFT JOIN allocation a ON a.class = m.atc2
             JOIN sites s ON s.site = m.site)""",
        """SELECT f.year, f.quarter, f.province, f.city, f.site, f.atc3, f.molecule, f.packid, f.price,
                  f.atc2, f.panel, f.new_market AS market,
                  f.sales * f.share * CAST(CASE WHEN f.panel = 1 THEN 1.0 ELSE coalesce(g.factor, 1.0) END
                                           AS DOUBLE) AS sales,
                  f.units * f.share * CAST(CASE WHEN f.panel = 1 THEN 1.0 ELSE coalesce(g.factor, 1.0) END
                                           AS DOUBLE) AS units
           FROM factors f LEFT JOIN grid g ON g.city = f.city AND g.market = f.new_market""",
    )
)
def adjusted_prices(spark, sf):
    """Price ladder → reassign and exclude → split → scale of unobserved rows."""
    moved_rows = op.reassign_and_exclude(
        price.price_ladder(spark, sf), CLASSES, MARKET, EXCLUDED
    )
    parts = op.split_across_markets(moved_rows, ALLOCATION, ["sales", "units"])
    sizes = b.sites(spark, sf).select(
        "site", (F.col("size") >= b.REPORTING_SIZE).cast("int").alias("panel")
    )
    return op.scale_unobserved(parts.join(sizes, "site"), grid(spark, sf))
