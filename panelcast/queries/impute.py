"""Imputation on the test tables, years 1999 and 2000."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.operators import impute as op
from panelcast.operators.conform import canonical_panel
from panelcast.queries import bindings as b
from panelcast.queries.conform import PANEL_KEYS
from panelcast.queries.registry import query, total, total0, using, with_
from panelcast.sources.stages import stage

CELL = ["qoy", "province", "city", "district", "site", "market"]
GROWTH = ["qoy", "province", "city", "market", "atc3", "molecule"]
ITEM = [
    "qoy", "month", "province", "city", "district", "site", "market", "atc3", "molecule", "packid",
]


def _list(keys):
    return ", ".join(keys)


# One class is left without a code, so that missing keys have to match.
_OBSERVED = f"""observed AS (
  SELECT year, date, quarter, province, city, district, site, market,
         nullif(atc3, 'C05P') AS atc3, molecule, packid, {total0('sales')} AS sales
  FROM panel GROUP BY ALL)"""
_IMP = """imp AS (
  SELECT *, substr(quarter, 5, 2) AS qoy, substr(date, 5, 2) AS month
  FROM observed WHERE year IN ('1999', '2000'))"""
_CONTINUITY = f"""continuity AS (
  SELECT {_list(CELL)},
         CAST(count(DISTINCT month) FILTER (WHERE year = '1999') AS INTEGER) AS months_1999,
         CAST(count(DISTINCT month) FILTER (WHERE year = '2000') AS INTEGER) AS months_2000,
         least(months_1999, months_2000) AS cnt_min,
         greatest(months_1999, months_2000) AS cnt_max
  FROM imp GROUP BY {_list(CELL)})"""
_GROWTH = f"""growth_sums AS (
  SELECT {_list(['i.' + c for c in GROWTH])},
         {total0("CASE WHEN year = '1999' THEN sales END")} AS a,
         {total0("CASE WHEN year = '2000' THEN sales END")} AS b
  FROM imp i JOIN continuity c ON {using(CELL, 'i', 'c')} AND c.cnt_min >= 2
  GROUP BY {_list(['i.' + c for c in GROWTH])}),
growth AS (
  SELECT {_list(GROWTH)},
         CASE WHEN b / nullif(a, 0) BETWEEN 0.1 AND 10 THEN b / nullif(a, 0) ELSE 1.0 END AS growth
  FROM growth_sums)"""
_WIDE = f"""wide_sums AS (
  SELECT {_list(['i.' + c for c in ITEM])},
         {total("CASE WHEN year = '1999' THEN sales END")} AS a,
         {total("CASE WHEN year = '2000' THEN sales END")} AS b
  FROM imp i JOIN continuity c ON {using(CELL, 'i', 'c')} AND c.cnt_max >= 2
  GROUP BY {_list(['i.' + c for c in ITEM])}),
wide AS (
  SELECT {_list(['w.' + c for c in ITEM])},
         CAST(a IS NULL AS INTEGER) AS flag_1999, CAST(b IS NULL AS INTEGER) AS flag_2000,
         coalesce(a, b / coalesce(growth, 1.0)) AS sales_1999,
         coalesce(b, a * coalesce(growth, 1.0)) AS sales_2000
  FROM wide_sums w LEFT JOIN growth g ON {using(GROWTH, 'w', 'g')})"""
_LONG = f"""long AS (
  SELECT {_list(ITEM)}, '1999' AS year, flag_1999 AS flag, sales_1999 AS sales FROM wide
  UNION ALL
  SELECT {_list(ITEM)}, '2000' AS year, flag_2000 AS flag, sales_2000 AS sales FROM wide)"""
_CHAIN = [b.PANEL, _OBSERVED, _IMP, _CONTINUITY, _GROWTH, _WIDE, _LONG]


def observed(spark, sf):
    rows = b.panel(spark, sf).withColumn("atc3", F.nullif(F.col("atc3"), F.lit("C05P")))
    return canonical_panel(rows, PANEL_KEYS).drop("units", "price")


def imputable(panel):
    return op.with_quarter_parts(panel.filter(F.col("year").isin(list(b.YEARS))))


def paired(rows):
    """Both lookups are stored: the first is used twice, and of the second only the measured size tells that it is small."""
    cont = stage(op.period_continuity(rows, CELL, b.YEARS), "continuity")
    growth = stage(op.bounded_growth(rows, cont, CELL, GROWTH, b.YEARS), "growth")
    return op.impute_paired_period(rows, cont, growth, CELL, ITEM, GROWTH, b.YEARS)


def stored_rows(spark, sf):
    """The canonical panel's rows of the two years as a stored stage: the imputation reads them several times."""
    return stage(imputable(observed(spark, sf)), "panel-years")


@query(with_(*_CHAIN[:4], "SELECT * FROM continuity"))
def period_continuity(spark, sf):
    return op.period_continuity(imputable(observed(spark, sf)), CELL, b.YEARS)


@query(with_(*_CHAIN[:5], "SELECT * FROM growth"))
def bounded_growth(spark, sf):
    rows = stored_rows(spark, sf)
    cont = op.period_continuity(rows, CELL, b.YEARS)
    return op.bounded_growth(rows, cont, CELL, GROWTH, b.YEARS)


@query(with_(*_CHAIN[:6], "SELECT * FROM wide"))
def impute_paired_period(spark, sf):
    return paired(stored_rows(spark, sf))


@query(with_(*_CHAIN, "SELECT * FROM long"))
def unpivot_compound(spark, sf):
    return op.unpivot_compound(paired(stored_rows(spark, sf)), ["flag", "sales"], "year")


@query(
    with_(
        *_CHAIN,
        f"""imputed AS (
             SELECT year, year || month AS date, year || qoy AS quarter,
                    {_list(c for c in PANEL_KEYS if c not in ('year', 'date', 'quarter'))},
                    sales AS sales_imp, flag FROM long)""",
        f"""SELECT {_list(f'coalesce(o.{k}, i.{k}) AS {k}' for k in PANEL_KEYS)},
                   coalesce(o.sales, i.sales_imp) AS sales, coalesce(i.flag, 0) AS flag1
            FROM observed o FULL JOIN imputed i ON {using(PANEL_KEYS, 'o', 'i')}""",
    )
)
def merge_imputed(spark, sf):
    panel = stage(observed(spark, sf), "panel")
    long = op.unpivot_compound(paired(imputable(panel)), ["flag", "sales"], "year")
    return op.merge_imputed(panel, op.rebuild_periods(long), PANEL_KEYS)
