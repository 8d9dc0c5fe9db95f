"""Control totals and checks of a reporting round, one per stage.

Each function takes what a job read and returned. All results are small: totals
per listed key, one verdict per lookup, or the rows that break a rule.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions import semantics as sem
from panelcast.operators import adjust, conform, deliver, project


def panel_totals(panel: DataFrame) -> DataFrame:
    """Sales and units by quarter, province and market."""
    return conform.qc_totals(panel, ["quarter", "province", "market"], ["sales", "units"])


def lookup_verdict(before: DataFrame, after: DataFrame, lookup: str, measure: str = "sales") -> DataFrame:
    """Whether a lookup join multiplied a measure."""
    return project.match_uniqueness(before, after, measure).withColumn("lookup", F.lit(lookup))


def projection_checks(imputed: DataFrame, projected: DataFrame) -> dict[str, DataFrame]:
    """Totals, and whether the sales of reporting sites grew on their way through the joins."""
    scope = projected.select("quarter").distinct()
    sampled = sem.null_safe_join(imputed, scope, ["quarter"], "left_semi")
    return {
        "totals": conform.qc_totals(projected, ["quarter", "city", "market"], ["sales"]),
        "unique_match": lookup_verdict(sampled, projected.filter(F.col("panel") == 1), "projection"),
    }


def adjustment_checks(adjusted: DataFrame) -> dict[str, DataFrame]:
    """Totals, and sales of observed and unobserved sites by city."""
    return {
        "totals": conform.qc_totals(adjusted, ["quarter", "city", "market"], ["sales", "units"]),
        "by_panel": adjust.crosstab(adjusted, "city", "panel", {0: "unobserved", 1: "observed"}, "sales"),
    }


def delivery_checks(delivered: DataFrame, keys: Sequence[str]) -> dict[str, DataFrame]:
    """Totals, and the rows whose key occurs more than once."""
    return {
        "totals": conform.qc_totals(delivered, ["channel", "quarter", "market"], ["sales", "units"]),
        "repeated": deliver.duplicate_key_check(delivered, keys),
    }


def lost_rows(df: DataFrame, reasons: Mapping[str, Column]) -> DataFrame:
    """Rows and sales that fall under each reason, in one pass; a row counts for each that holds."""
    held = F.filter(
        F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in reasons.items()]),
        lambda x: x.isNotNull(),
    )
    return (
        df.select(F.explode(held).alias("reason"), "sales")
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n_rows"), sem.sum0("sales").alias("sales"))
    )


def gate_losses(rows: DataFrame, quarters: Sequence[str], not_available: str) -> DataFrame:
    """What the panel gate drops: sites without an id, packs without a market, unparsed or empty numbers."""
    return lost_rows(
        rows,
        {
            "no site": F.col("site").isNull() | (F.col("site") == not_available),
            "no market": F.col("market").isNull(),
            "no number": F.col("units").isNull() | F.col("sales").isNull(),
            "not positive": (F.col("units") <= 0) | (F.col("sales") <= 0),
            "other quarter": ~F.col("quarter").isin(list(quarters)),
        },
    )
