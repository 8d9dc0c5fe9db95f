"""Second channel: sites selected by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions import semantics as sem
from panelcast.operators.conform import normalise_transactions


def channel_extract(
    feed: DataFrame,
    columns: Mapping[str, str],
    name_pattern: str,
    province: str,
    quarters: Sequence[str],
    markets: DataFrame,
    keys: Sequence[str],
    rules: Mapping[str, str],
) -> DataFrame:
    """Conformed and aggregated sales of the sites whose name matches a pattern.

    The filters are on feed columns, so they reach the scan.
    """
    scope = feed.filter(
        F.col(columns["quarter"]).isin(list(quarters))
        & (F.col(columns["province"]) == province)
        & F.col(columns["hospital"]).rlike(name_pattern)
    )
    rows = normalise_transactions(scope, columns, **rules)
    attrs = [c for c in markets.columns if c != "packid"]
    joined = sem.null_safe_join(
        rows.select(*[c for c in rows.columns if c not in attrs]),
        markets.dropDuplicates(),
        ["packid"],
        "inner",
    ).filter(F.col("market").isNotNull())
    return joined.groupBy(*keys).agg(
        sem.sum0("sales").alias("sales"), sem.sum0("units").alias("units")
    )


def dosage_units(
    df: DataFrame,
    packs: DataFrame,
    attrs: Sequence[str],
    corp_by_product: Mapping[str, str],
) -> DataFrame:
    """Pack attributes, dosage units = pack size × units, corporation override.

    A missing product keeps the corporation (it does not blank it).
    """
    joined = sem.lookup_join(df, packs, ["packid"], attrs)
    corp = F.col("corp_desc")
    for product, name in corp_by_product.items():
        corp = F.when(F.col("product") == product, F.lit(name)).otherwise(corp)
    return joined.withColumns(
        {"dosage_units": F.col("pack_size") * F.col("units"), "corp_desc": corp}
    )


def dosage_form_gate(
    df: DataFrame,
    forms: Sequence[str],
    width: int,
    dropped: Sequence[str] = (),
    bypass: Sequence[str] = (),
    text: str = "pack_desc",
    by: str = "atc2",
) -> DataFrame:
    """Keep listed forms (prefix of the description) and drop whole classes.

    Classes in ``bypass`` have been split before and pass unchecked.
    """
    listed = F.substring(text, 1, width).isin(list(forms)) & sem.not_in(by, dropped)
    passing = F.coalesce(F.col(by).isin(list(bypass)), F.lit(False))
    return df.filter(listed | passing)
