"""Class reassignment, market split and scale factors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions import semantics as sem


def reassign_and_exclude(
    df: DataFrame,
    classes: Sequence[str],
    market: str,
    exclusions: Sequence[tuple[str, str]],
    by: str = "molecule",
) -> DataFrame:
    """Force a market for some classes, then drop listed (market, value) pairs."""
    moved = df.withColumn("atc2", F.substring("atc3", 1, 3))
    moved = moved.withColumn(
        "market",
        F.when(F.col("atc2").isin(list(classes)), F.lit(market)).otherwise(F.col("market")),
    )
    listed = sem.any_of((F.col("market") == m) & (F.col(by) == v) for m, v in exclusions)
    return moved.filter(~F.coalesce(listed, F.lit(False)))


def split_across_markets(
    df: DataFrame,
    allocation: Sequence[tuple[str, str, float]],
    measures: Sequence[str],
    by: str = "atc2",
) -> DataFrame:
    """Rows of a class become one row per market with its share; others stay.

    ``allocation`` lists (class, market, share). Each row is exploded in place:
    one scan, no join.
    """
    shares: dict[str, list[Column]] = {}
    for cls, market, share in allocation:
        shares.setdefault(cls, []).append(
            F.struct(F.lit(market).alias("market"), F.lit(float(share)).alias("share"))
        )
    unchanged = F.array(F.struct(F.col("market"), F.lit(1.0).alias("share")))
    parts = unchanged
    for cls, rows in shares.items():
        parts = F.when(F.col(by) == cls, F.array(*rows)).otherwise(parts)
    out = df.withColumn("_part", F.explode(parts))
    scaled = {m: F.col(m) * F.col("_part.share") for m in measures}
    return out.withColumns({**scaled, "market": F.col("_part.market")}).drop("_part")


def factor_of(
    overrides: Sequence[tuple[str, str | None, float]], default: float = 1.0
) -> Column:
    """Factor of a city and market; the first matching rule wins, one without a market holds for all."""
    factor = F.lit(float(default))
    for city, market, value in reversed(overrides):
        hit = F.col("city") == city
        if market is not None:
            hit = hit & (F.col("market") == market)
        factor = F.when(hit, F.lit(float(value))).otherwise(factor)
    return factor


def factor_grid(
    cities: DataFrame,
    markets: Sequence[str],
    overrides: Sequence[tuple[str, str | None, float]],
    default: float = 1.0,
) -> DataFrame:
    """City × market factors: default, overridden per city or city and market."""
    factor = factor_of(overrides, default)
    grid = cities.select("city").distinct().withColumn(
        "market", F.explode(F.array(*[F.lit(m) for m in markets]))
    )
    return grid.withColumn("factor", factor)


def scale_unobserved(
    df: DataFrame, grid: DataFrame, measures: Sequence[str] = ("sales", "units")
) -> DataFrame:
    """Multiply by the factor where panel is not 1; observed rows are unchanged.

    A city or market outside the grid keeps its values (factor 1).
    """
    joined = sem.lookup_join(df, grid, ["city", "market"], ["factor"])
    factor = F.when(F.col("panel") == 1, F.lit(1.0)).otherwise(
        F.coalesce("factor", F.lit(1.0))
    )
    return joined.withColumns({m: F.col(m) * factor for m in measures}).drop("factor")


def scale_in_place(
    df: DataFrame,
    markets: Sequence[str],
    overrides: Sequence[tuple[str, str | None, float]],
    measures: Sequence[str] = ("sales", "units"),
    default: float = 1.0,
) -> DataFrame:
    """scale_unobserved with the factor as an expression of city and market: no grid, no join."""
    scaled = (F.coalesce("panel", F.lit(0)) != 1) & F.col("market").isin(list(markets))
    factor = F.when(scaled, factor_of(overrides, default)).otherwise(F.lit(1.0))
    return df.withColumns({m: F.col(m) * factor for m in measures})


def crosstab(
    df: DataFrame, row: str, column: str, names: Mapping[object, str], measure: str
) -> DataFrame:
    """Totals of a measure by row, one named column per listed value."""
    cells = [
        sem.exact_sum(F.when(F.col(column) == value, F.col(measure))).alias(name)
        for value, name in names.items()
    ]
    return df.groupBy(row).agg(*cells)
