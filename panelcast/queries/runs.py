"""Jobs as a run executes them, on the test tables: results, and the totals counted while writing."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.config import Periods
from panelcast.functions import semantics as sem
from panelcast.plans import jobs
from panelcast.queries import adjust, impute, price
from panelcast.queries import bindings as b
from panelcast.queries.conform import PANEL_KEYS
from panelcast.queries.registry import REGISTRY, in_, query, total0, using, with_
from panelcast.sources.runs import OTHER, Run

QUARTERS = ("2000Q1", "2000Q2")
PERIODS = Periods(
    previous_year="1999", current_year="2000", panel_quarters=QUARTERS, projected_quarters=QUARTERS,
    base_quarter="1999Q2", report_quarter="2000Q2",
)
#: The cities whose missing months are estimated; the others keep what they reported.
CITIES = [f"NATION_{i}" for i in range(1, 20)]

_SCOPE = impute._IMP.replace("WHERE", f"WHERE city IN {in_(CITIES)} AND")
_RUN = [
    b.PANEL, impute._OBSERVED, _SCOPE, impute._CONTINUITY, impute._GROWTH, impute._WIDE, impute._LONG,
    f"""estimated AS (
  SELECT year, year || month AS date, year || qoy AS quarter,
         {', '.join(c for c in PANEL_KEYS if c not in ('year', 'date', 'quarter'))}, sales AS sales_imp, flag
  FROM long),
imputed AS (
  SELECT {', '.join(f'coalesce(o.{k}, i.{k}) AS {k}' for k in PANEL_KEYS)},
         coalesce(o.sales, i.sales_imp) AS sales, coalesce(i.flag, 0) AS flag1
  FROM observed o FULL JOIN estimated i ON {using(PANEL_KEYS, 'o', 'i')})""",
]


def imputed(spark, sf):
    """The imputation job in a run of its own, and its result; its intermediate stages are removed."""
    run = Run(spark)
    panel = run.stage(impute.observed(spark, sf), "panel", ["sales"])
    out = jobs.impute_job(panel, PERIODS, CITIES, run)
    run.drop("panel", "impute_scope")
    return run, out


@query(with_(*_RUN, "SELECT * FROM imputed"))
def impute_run(spark, sf):
    return imputed(spark, sf)[1]


def _cells(column: str, values) -> str:
    """SQL rows of the totals of one column: one per listed value, and one for all others."""
    text = f"CAST({column} AS VARCHAR)"
    cell = f"CASE WHEN {text} IN {in_([str(v) for v in values])} THEN {text} ELSE '{OTHER}' END"
    return f"""SELECT '{column}' AS "column", {cell} AS value, count(*) AS n_rows, {total0('sales')} AS total
               FROM imputed GROUP BY ALL"""


@query(
    with_(
        *_RUN,
        f"""cells AS (
  SELECT '' AS "column", '' AS value, count(*) AS n_rows, {total0('sales')} AS total FROM imputed
  UNION ALL {_cells('quarter', QUARTERS)} UNION ALL {_cells('flag1', (0, 1))})""",
        "SELECT 'imputed' AS stage, 'sales' AS measure, * FROM cells",
    )
)
def impute_run_totals(spark, sf):
    """Control totals that the run counted while it wrote the result; cells without a row are left out."""
    run, _ = imputed(spark, sf)
    return run.totals("imputed").filter("n_rows > 0")


RULES = jobs.AdjustRules(
    adjust.CLASSES, adjust.MARKET, adjust.EXCLUDED, adjust.ALLOCATION, adjust.MARKETS, adjust.OVERRIDES
)


@query(REGISTRY["adjusted_prices"][1])
def price_adjust_run(spark, sf):
    """The job of prices and adjustments in a run of its own: the rows of its operators one by one."""
    run = Run(spark)
    rows = b.panel(spark, sf).filter(F.col("year") == PERIODS.current_year)
    sums = [sem.sum0(m).alias(m) for m in ("sales", "units")]
    sold = run.stage(rows.groupBy(*price.TARGET, "size").agg(*sums), "sold", ["sales", "units"])
    reports = F.col("size") >= b.REPORTING_SIZE
    projected = sold.select(*price.TARGET, "sales", reports.cast("int").alias("panel"))
    out = jobs.price_adjust_job(projected, sold.filter(reports), PERIODS, run, RULES)
    run.drop("sold")
    return out
