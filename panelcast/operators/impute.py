"""Imputation of missing months from the other year and a bounded growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions import semantics as sem


def with_quarter_parts(panel: DataFrame) -> DataFrame:
    """Quarter of the year (Qn) and month (mm) as columns of their own."""
    return panel.withColumns(
        {"qoy": F.substring("quarter", 5, 2), "month": F.substring("date", 5, 2)}
    )


def period_continuity(
    panel: DataFrame, cell: Sequence[str], years: tuple[str, str]
) -> DataFrame:
    """Months reported per cell in each of the two years, with their min and max.

    The set of months is kept as one bit per month, so the distinct count needs
    a single aggregation instead of a de-duplication followed by a count.
    """
    bit = F.call_function("shiftleft", F.lit(1), F.col("month").cast("int"))
    months = {
        f"months_{y}": F.bit_count(
            F.coalesce(F.bit_or(F.when(F.col("year") == y, bit)), F.lit(0))
        )
        for y in years
    }
    names = list(months)
    return (
        panel.filter(F.col("year").isin(list(years)))
        .groupBy(*cell)
        .agg(*[c.alias(n) for n, c in months.items()])
        .withColumn("cnt_min", F.least(*names))
        .withColumn("cnt_max", F.greatest(*names))
    )


def _in_cells(
    panel: DataFrame, cells: DataFrame, cell: Sequence[str], years: tuple[str, str]
) -> DataFrame:
    """Rows of the two years in the cells listed.

    The cells are hashed: there is one row for each, so a task holds few of them,
    and the panel's rows needn't be sorted by the many texts of the key.
    """
    rows = panel.filter(F.col("year").isin(list(years)))
    return sem.null_safe_join(rows, cells.select(*cell).hint("shuffle_hash"), cell, "left_semi")


def bounded_growth(
    panel: DataFrame,
    continuity: DataFrame,
    cell: Sequence[str],
    grain: Sequence[str],
    years: tuple[str, str],
    min_months: int = 2,
    low: float = 0.1,
    high: float = 10.0,
) -> DataFrame:
    """Year-on-year growth per grain from cells present in both years."""
    eligible = _in_cells(panel, continuity.filter(F.col("cnt_min") >= min_months), cell, years)
    y0, y1 = years
    return (
        eligible.groupBy(*grain)
        .agg(
            sem.sum_where(F.col("year") == y0, "sales").alias("_before"),
            sem.sum_where(F.col("year") == y1, "sales").alias("_after"),
        )
        .select(
            *grain,
            sem.bounded_or(sem.ratio("_after", "_before"), 1.0, low, high).alias("growth"),
        )
    )


def impute_paired_period(
    panel: DataFrame,
    continuity: DataFrame,
    growth: DataFrame,
    cell: Sequence[str],
    item: Sequence[str],
    growth_grain: Sequence[str],
    years: tuple[str, str],
    min_months: int = 2,
) -> DataFrame:
    """Sales of both years per item and month; the missing one is estimated.

    Result columns follow the pattern measure_year (sales_1999, flag_1999, …).
    """
    y0, y1 = years
    scope = _in_cells(panel, continuity.filter(F.col("cnt_max") >= min_months), cell, years)

    def year_sum(y: str):
        here = F.col("year") == y
        return F.when(F.count(F.when(here, 1)) > 0, sem.sum_where(here, "sales"))

    wide = scope.groupBy(*item).agg(year_sum(y0).alias("_a"), year_sum(y1).alias("_b"))
    wide = sem.null_safe_join(wide, growth, growth_grain, "left").withColumn(
        "growth", F.coalesce("growth", F.lit(1.0))
    )
    return wide.select(
        *item,
        F.col("_a").isNull().cast("int").alias(f"flag_{y0}"),
        F.col("_b").isNull().cast("int").alias(f"flag_{y1}"),
        F.coalesce("_a", sem.ratio("_b", "growth")).alias(f"sales_{y0}"),
        F.coalesce("_b", F.col("_a") * F.col("growth")).alias(f"sales_{y1}"),
    )


def unpivot_compound(
    df: DataFrame, measures: Sequence[str], suffix_name: str, sep: str = "_"
) -> DataFrame:
    """Columns measure_suffix to one row per suffix with one column per measure.

    Every input row becomes its output rows on the spot: no shuffle, unlike an
    unpivot that is pivoted back.
    """
    suffixes = [
        c[len(measures[0]) + len(sep):] for c in df.columns if c.startswith(measures[0] + sep)
    ]
    compound = {f"{m}{sep}{s}" for m in measures for s in suffixes}
    rows = [
        F.struct(
            F.lit(s).alias(suffix_name), *[F.col(f"{m}{sep}{s}").alias(m) for m in measures]
        )
        for s in suffixes
    ]
    ids = [c for c in df.columns if c not in compound]
    return df.select(*ids, F.inline(F.array(*rows)))


def rebuild_periods(df: DataFrame) -> DataFrame:
    """date and quarter from year, month and quarter of the year."""
    return df.withColumns(
        {"date": F.concat("year", "month"), "quarter": F.concat("year", "qoy")}
    ).drop("month", "qoy")


def merge_imputed(
    observed: DataFrame, imputed: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Observed and imputed rows; observed sales win, flag1 marks imputed ones."""
    left = observed.select(*keys, "sales")
    right = imputed.select(*keys, F.col("sales").alias("sales_imp"), "flag")
    joined = sem.null_safe_join(left, right, keys, "full")
    return joined.select(
        *keys,
        F.coalesce("sales", "sales_imp").alias("sales"),
        F.coalesce("flag", F.lit(0)).alias("flag1"),
    )
