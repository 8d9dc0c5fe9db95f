"""Growth transfer to places without current data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions import semantics as sem
from panelcast.operators.neighbours import knn_items
from panelcast.operators.price import attach_price

__all__ = [
    "history_slice", "split_known_missing", "donor_growth", "months_from", "item_period_matrix", "as_vector",
    "knn_items", "inverse_distance_weights", "neighbour_weighted_growth", "growth_cascade", "grow", "apply_growth",
    "borrowed_price_ladder",
]


def history_slice(
    history: DataFrame,
    scope: Column,
    keys: Sequence[str],
    attrs: Sequence[str],
    measures: Sequence[str],
) -> DataFrame:
    """Delivered history of one channel, region and period at item grain."""
    rows = history.filter(scope & F.col("packid").isNotNull() & (F.col("sales") > 0))
    out = sem.sums_with_picks(rows, keys, {a: sem.first_valid(a) for a in attrs}, measures)
    if {"sales", "units"} <= set(measures):
        out = out.withColumn("price", sem.ratio("sales", "units"))
    return out


def split_known_missing(
    target: DataFrame, sample: DataFrame, key: str
) -> tuple[DataFrame, DataFrame]:
    """Target rows whose item does, and does not, occur in the sample."""
    known = sample.select(key).distinct()
    return (
        sem.null_safe_join(target, known, [key], "left_semi"),
        sem.null_safe_join(target, known, [key], "left_anti"),
    )


def donor_growth(
    panel: DataFrame,
    donor: Column,
    target_city: str,
    periods: tuple[str, str],
    items: DataFrame | None,
    item: str,
    ceiling: float = 1.5,
) -> DataFrame:
    """Growth of the donor place per item, relabelled as the target place.

    An undefined ratio counts as 1; only 0 < growth ≤ ceiling is kept.
    """
    before, after = periods
    rows = panel.filter(donor & F.col("quarter").isin([before, after]))
    if items is not None:
        rows = sem.null_safe_join(rows, items.select(item).distinct(), [item], "left_semi")
    growth = F.coalesce(sem.ratio("_after", "_before"), F.lit(1.0))
    return (
        rows.groupBy(item)
        .agg(
            sem.sum_where(F.col("quarter") == before, "sales").alias("_before"),
            sem.sum_where(F.col("quarter") == after, "sales").alias("_after"),
        )
        .select(F.lit(target_city).alias("city"), item, growth.alias("growth"))
        .filter((F.col("growth") <= ceiling) & (F.col("growth") > 0))
    )


def months_from(external: DataFrame, period: str, start: str) -> list[str]:
    """Months from the start to the last one with sales; one aggregated value is read.

    There is no end setting: what the external source delivers decides it.
    """
    last = external.filter(F.col(period) >= start).agg(F.max(period)).first()[0]
    if last is None:
        return []
    first, end = (int(p[:4]) * 12 + int(p[4:6]) - 1 for p in (start, last))
    return [f"{m // 12}{m % 12 + 1:02d}" for m in range(first, end + 1)]


def item_period_matrix(
    external: DataFrame,
    item: str,
    period: str,
    value: str,
    periods: Sequence[str],
    train_items: DataFrame,
) -> DataFrame:
    """Item × period sales (0 fill), one column per listed period, and train_flag."""
    wide = (
        external.filter(F.col(period).isin(list(periods)))
        .groupBy(item)
        .pivot(period, list(periods))
        .agg(sem.sum0(value))
        .na.fill(0.0, subset=list(periods))
    )
    marked = train_items.select(item).distinct().withColumn("train_flag", F.lit(1))
    return sem.null_safe_join(wide, marked, [item], "left").withColumn(
        "train_flag", F.coalesce("train_flag", F.lit(0))
    )


def as_vector(matrix: DataFrame, periods: Sequence[str], out: str = "vector") -> DataFrame:
    """Period columns as one array in the given order."""
    return matrix.withColumn(out, F.array(*[F.col(p) for p in periods])).drop(*periods)


def inverse_distance_weights(neighbours: DataFrame, item: str) -> DataFrame:
    """Weights 1 / (distance + 1), summing to 1 per item."""
    raw = neighbours.withColumn("_w", 1 / (F.col("distance") + 1))
    # A window over the k neighbours of an item.
    total = F.sum("_w").over(Window.partitionBy(item))
    return raw.withColumn("weight", F.col("_w") / total).drop("_w")


def neighbour_weighted_growth(
    weights: DataFrame, growth: DataFrame, item: str
) -> DataFrame:
    """Σ growth of the neighbours × weight per item."""
    donors = growth.select("city", F.col(item).alias("neighbour"), "growth")
    joined = sem.null_safe_join(weights, donors, ["neighbour"], "left")
    return joined.groupBy("city", item).agg(
        F.coalesce(F.sum(F.col("growth") * F.col("weight")), F.lit(0.0)).alias("growth")
    )


def growth_cascade(
    targets: DataFrame,
    own: DataFrame,
    neighbour: DataFrame,
    external: DataFrame,
    item: str,
    target_city: str,
) -> DataFrame:
    """Own donor growth (flag 0), neighbour growth (1), neither → 1.0 (2)."""
    surplus = targets.select(item).distinct()
    for known in (own, external):
        surplus = sem.null_safe_join(surplus, known.select(item).distinct(), [item], "left_anti")
    surplus = surplus.select(
        F.lit(target_city).alias("city"), item, F.lit(1.0).alias("growth")
    )
    tagged = [
        part.select("city", item, "growth", F.lit(flag).alias("flag"))
        for flag, part in enumerate((own, neighbour, surplus))
    ]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


def grow(
    target: DataFrame, growth: DataFrame, item: str, quarter: str
) -> DataFrame:
    """Last year's sales × growth, relabelled to the current period, > 0."""
    rates = growth.select("city", item, "growth")
    grown = sem.null_safe_join(target, rates, ["city", item], "left").withColumns(
        {
            "sales": F.col("sales") * F.col("growth"),
            "quarter": F.lit(quarter),
            "year": F.lit(quarter[:4]),
        }
    )
    return grown.filter(F.col("sales") > 0).drop("growth")


def apply_growth(
    target: DataFrame,
    growth: DataFrame,
    price_overrides: Mapping[str, float],
    item: str,
    quarter: str,
) -> DataFrame:
    """Grown sales with last year's price, or the listed price of an item."""
    grown = grow(target, growth, item, quarter)
    price = F.col("price")
    for listed, value in price_overrides.items():
        price = F.when(F.col(item) == listed, F.lit(float(value))).otherwise(price)
    return grown.withColumn("price", price).withColumn("units", sem.ratio("sales", "price"))


def borrowed_price_ladder(
    target: DataFrame, relabelled_grains: DataFrame, pack: str = "packid"
) -> DataFrame:
    """Priced with the grains of the donor place; rows without a price stay."""
    return attach_price(target.drop("units", "price"), relabelled_grains, pack)
