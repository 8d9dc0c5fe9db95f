"""Prices of the sampled sites, applied to all sites."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions import semantics as sem
from panelcast.operators import price as op
from panelcast.queries import bindings as b
from panelcast.queries.registry import query, total0, with_
from panelcast.sources.stages import stage

TARGET = ["year", "quarter", "province", "city", "site", "market", "atc3", "molecule", "packid"]


def grain_sql(source: str) -> str:
    """Six separate aggregations, as UNION ALL."""
    parts = []
    for name, keys in op.LADDER.items():
        cols = ", ".join(
            f"{c}" if c in keys else f"CAST(NULL AS VARCHAR) AS {c}" for c in op.PLACE_TIME
        )
        parts.append(
            f"SELECT packid, {cols}, '{name}' AS grain, "
            f"{total0('sales')} / nullif({total0('units')}, 0) AS price FROM {source} "
            f"WHERE sales > 0 AND units > 0 GROUP BY {', '.join(['packid', *keys])}"
        )
    return "grains AS MATERIALIZED (" + "\nUNION ALL ".join(parts) + ")"


def window_total(x: str, keys: str) -> str:
    """SQL of an exact sum over the rows that share keys."""
    over = f"OVER (PARTITION BY {keys})"
    return (
        f"(CAST(sum(CAST(floor({x}) AS BIGINT)) {over} * 1000000000"
        f" + sum(CAST(floor(({x} - floor({x})) * 1000000000 + 0.5) AS BIGINT)) {over} AS DOUBLE) / 1000000000)"
    )


_GRAINS = [", ".join(["packid", *keys]) for keys in op.LADDER.values()]
_LADDER = ", ".join(f"{window_total('sold', g)} / nullif({window_total('moved', g)}, 0)" for g in _GRAINS)
#: Every sale of the year with the finest price of its pack, place and period; no joins.
PRICED = f"""marked AS (
  SELECT *, size >= {b.REPORTING_SIZE} AND sales > 0 AND units > 0 AS counts FROM panel WHERE year = '2000'),
measured AS (
  SELECT *, CAST(CASE WHEN counts THEN sales END AS DOUBLE) AS sold,
         CAST(CASE WHEN counts THEN units END AS DOUBLE) AS moved FROM marked),
laddered AS (
  SELECT {', '.join(TARGET)}, sales, coalesce({_LADDER}) AS price FROM measured),
priced AS (
  SELECT {', '.join(TARGET)}, {total0('sales')} AS sales, any_value(price) AS price
  FROM laddered GROUP BY {', '.join(TARGET)})"""
BASE = "base AS (SELECT * FROM sample WHERE year = '2000')"


def grains(spark, sf):
    return op.price_grains(b.sample(spark, sf).filter(F.col("year") == "2000"))


@query(with_(b.SAMPLE, BASE, grain_sql("base"), "SELECT * FROM grains"))
def price_grains(spark, sf):
    return grains(spark, sf)


@query(
    with_(
        b.PANEL, PRICED,
        """SELECT *, sales / nullif(price, 0) AS units FROM priced
           WHERE sales > 0 AND price > 0 AND sales / nullif(price, 0) > 0""",
    )
)
def price_ladder(spark, sf):
    sums = [sem.sum0(m).alias(m) for m in ("sales", "units")]
    rows = b.panel(spark, sf).filter(F.col("year") == "2000")
    sold = stage(rows.groupBy(*TARGET, "size").agg(*sums), "sold")
    prices = op.price_grains(sold.filter(F.col("size") >= b.REPORTING_SIZE))
    return op.price_ladder(sold.select(*TARGET, "sales"), prices)
