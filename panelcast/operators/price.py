"""Weighted prices at six grains and the fallback ladder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions import semantics as sem

# Grain name → key columns beside the pack, from the finest to the coarsest.
LADDER = {
    "city_quarter": ["quarter", "province", "city"],
    "city_year": ["year", "province", "city"],
    "province_quarter": ["quarter", "province"],
    "province_year": ["year", "province"],
    "quarter": ["quarter"],
    "year": ["year"],
}
PLACE_TIME = ["year", "quarter", "province", "city"]


def price_grains(panel: DataFrame, pack: str = "packid") -> DataFrame:
    """Σ sales / Σ units per pack at all six grains, from one scan.

    Rows are first summed to pack × year × quarter × city. The grouping sets
    then multiply that small result by six, not the transactions.
    """
    base = (
        panel.filter((F.col("sales") > 0) & (F.col("units") > 0))
        .groupBy(pack, *PLACE_TIME)
        .agg(sem.sum0("sales").alias("sales"), sem.sum0("units").alias("units"))
    )
    # grouping_id sets a bit, left to right, for each column that is not in the set.
    bits = {c: 1 << (len(PLACE_TIME) - 1 - i) for i, c in enumerate(PLACE_TIME)}
    grain = F.col("_gid").cast("int")
    label = F.lit(None).cast("string")
    for name, keys in LADDER.items():
        gid = sum(b for c, b in bits.items() if c not in keys)
        label = F.when(grain == gid, F.lit(name)).otherwise(label)
    sets = [[F.col(c) for c in (pack, *keys)] for keys in LADDER.values()]
    return (
        base.groupingSets(sets, pack, *PLACE_TIME)
        .agg(
            F.grouping_id(pack, *PLACE_TIME).alias("_gid"),
            sem.sum0("sales").alias("sales"),
            sem.sum0("units").alias("units"),
        )
        .select(
            pack, *PLACE_TIME, label.alias("grain"), sem.ratio("sales", "units").alias("price")
        )
    )


def _asked(name: str) -> Column:
    """Key of a grain in the map of a pack: the grain and the columns that it has, missing ones marked."""
    cells = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in LADDER[name]]
    return F.concat_ws("\u0001", F.lit(name), *cells)


def price_map(grains: DataFrame, pack: str = "packid") -> DataFrame:
    """One row per pack: its prices at all grains in one map column ``prices``.

    A pack has at most as many prices as there are places and periods, which
    doesn't grow with the transactions.
    """
    key = F.lit(None).cast("string")
    for name in LADDER:
        key = F.when(F.col("grain") == name, _asked(name)).otherwise(key)
    known = grains.filter(F.col("price").isNotNull()).select(pack, key.alias("_key"), "price")
    single = known.groupBy(pack, "_key").agg(F.max("price").alias("price"))
    entries = F.collect_list(F.struct("_key", "price"))
    return single.groupBy(pack).agg(F.map_from_entries(entries).alias("prices"))


def attach_price(targets: DataFrame, grains: DataFrame, pack: str = "packid") -> DataFrame:
    """Price of the finest grain that has one, and units = sales / price, on every target row.

    Target rows meet the prices of their pack in one join on the pack and look
    the six grains up in place.
    """
    name = "_prices"
    while name in targets.columns:
        name += "_"
    priced = sem.null_safe_join(targets, price_map(grains, pack).withColumnRenamed("prices", name), [pack], "left")
    ladder = [F.try_element_at(F.col(name), _asked(grain)) for grain in LADDER]
    priced = priced.withColumn("price", F.coalesce(*ladder)).drop(name)
    return priced.withColumn("units", sem.ratio("sales", "price"))


def price_ladder(targets: DataFrame, grains: DataFrame, pack: str = "packid") -> DataFrame:
    """Priced targets with positive units, sales and price."""
    return attach_price(targets, grains, pack).filter(
        sem.positive("units", "sales", "price")
    )


def relabel_grains(
    grains: DataFrame,
    donor_province: str,
    donor_city: str,
    target_province: str,
    target_city: str,
) -> DataFrame:
    """Grains of a donor place handed to a target place; national grains stay."""
    city_level = F.col("grain").isin("city_quarter", "city_year")
    province_level = F.col("grain").isin("province_quarter", "province_year")
    keep = (
        (city_level & (F.col("city") == donor_city))
        | (province_level & (F.col("province") == donor_province))
        | F.col("grain").isin("quarter", "year")
    )
    regional = city_level | province_level
    return grains.filter(keep).withColumns(
        {
            "province": F.when(regional, F.lit(target_province)).otherwise(F.col("province")),
            "city": F.when(city_level, F.lit(target_city)).otherwise(F.col("city")),
        }
    )
