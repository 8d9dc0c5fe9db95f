"""Ingest and conform: from heterogeneous feeds to the canonical panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions import semantics as sem


def lookup_first_by_key(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One code per place; rows without a name (last key) or a code are dropped."""
    return (
        df.filter(F.col(keys[-1]).isNotNull() & F.col(value).isNotNull())
        .groupBy(*keys)
        .agg(F.min(value).alias(value))
    )


def lookup_union_distinct(*lookups: DataFrame) -> DataFrame:
    """Several name variants as one mapping without repeated rows."""
    merged = lookups[0]
    for other in lookups[1:]:
        merged = merged.unionByName(other)
    return merged.dropDuplicates()


def first_valid_by_key(
    df: DataFrame, key: Sequence[str], attrs: Sequence[str], rank: str | None = None
) -> DataFrame:
    """First non-NULL value of each attribute, independently of the others.

    Combinations are made distinct first, by hash aggregation combined on the
    map side; the sort-based choice of the first text sees only those.
    """
    by = [*key, *attrs]
    if rank is None:
        combos = df.select(*by).distinct()
    else:
        combos = df.groupBy(*by).agg(F.min(rank).alias(rank))
    return combos.groupBy(*key).agg(*[sem.first_valid(a, rank).alias(a) for a in attrs])


def fill_attrs_within_key(
    df: DataFrame, key: Sequence[str], attrs: Sequence[str], rank: str | None = None
) -> DataFrame:
    """Write the first valid attributes of a key back to all of its rows.

    Reduced to one row per key and joined back. No window is used, so a key that
    owns a large part of the rows never sits in a single task.
    """
    first = first_valid_by_key(df, key, attrs, rank)
    filled = sem.null_safe_join(df.drop(*attrs), first, key, "left")
    return filled.select(*df.columns)


def conform_pack_reference(
    df: DataFrame, pack_id: str, class_code: str, molecule: str
) -> DataFrame:
    """Padded pack id with the third and second class levels cut from the fourth."""
    return df.select(
        sem.pad_id(pack_id).alias("packid"),
        F.substring(class_code, 1, 4).alias("atc3"),
        F.substring(class_code, 1, 3).alias("atc2"),
        F.col(molecule).alias("molecule"),
    ).dropDuplicates()


def market_definition(markets: DataFrame, packs: DataFrame) -> DataFrame:
    """Packs whose molecule belongs to a market; one row per pack and market."""
    defined = markets.select("molecule", "market").dropDuplicates()
    joined = sem.null_safe_join(defined, packs, ["molecule"], "right")
    return joined.filter(F.col("market").isNotNull())


def normalise_transactions(
    df: DataFrame,
    columns: Mapping[str, str],
    province_suffix: str,
    city_suffix: str,
    municipal_label: str,
    municipal_city: str,
) -> DataFrame:
    """One sales feed in canonical columns, exact duplicates removed.

    ``columns`` maps canonical names to feed names; it must name province, city,
    packid, price and sales. Units follow from value and price.
    """
    special = {
        "province": lambda c: F.regexp_replace(c, province_suffix, ""),
        "city": lambda c: sem.if_else3(
            c == municipal_label, F.lit(municipal_city), F.regexp_replace(c, city_suffix, "")
        ),
        "packid": sem.pad_id,
        "year": lambda c: c.cast("string"),
        "date": lambda c: c.cast("string"),
    }
    picked = [
        special.get(name, lambda c: c)(F.col(source)).alias(name)
        for name, source in columns.items()
    ]
    units = sem.ratio(columns["sales"], columns["price"]).alias("units")
    return df.select(*picked, units).dropDuplicates()


def union_feeds(*feeds: DataFrame, text: Sequence[str] = ()) -> DataFrame:
    """All feeds by column name; absent columns are NULL, bind order is kept.

    ``text`` columns are cast first because feeds disagree on their type.
    """
    merged = None
    for i, feed in enumerate(feeds):
        casts = {c: F.col(c).cast("string") for c in text if c in feed.columns}
        ranked = feed.withColumns({**casts, "source_rank": F.lit(i)})
        merged = ranked if merged is None else merged.unionByName(
            ranked, allowMissingColumns=True
        )
    return merged


def derive_periods(df: DataFrame, text: str) -> DataFrame:
    """year, date (yyyymm) and quarter (yyyyQn) from 'yyyy-m' or 'yyyymm…' text.

    Without a valid month the quarter falls back to the year.
    """
    raw = F.col(text).cast("string")
    year = F.substring(raw, 1, 4)
    month_text = F.regexp_extract(raw, r"^\d{4}\D?(\d{1,2})", 1)
    month = month_text.try_cast("int")
    quarter = F.when(
        month.between(1, 12),
        F.concat(year, F.lit("Q"), F.ceil(month / 3).cast("string")),
    ).otherwise(year)
    padded = F.when(month.isNotNull(), F.lpad(month_text, 2, "0")).otherwise(F.lit(""))
    return df.withColumns({"year": year, "date": F.concat(year, padded), "quarter": quarter})


def coalesce_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], attrs: Sequence[str]
) -> DataFrame:
    """Fill missing attributes of the left side from a lookup on a partial key."""
    fill = {a: f"_fill_{a}" for a in attrs}
    table = sem.unique_lookup(right, on, attrs).withColumnsRenamed(fill)
    joined = sem.null_safe_join(left, table, on, "left")
    present = [
        F.coalesce(a, fill[a]).alias(a) if a in left.columns else F.col(fill[a]).alias(a)
        for a in attrs
    ]
    return joined.select(*[c for c in left.columns if c not in attrs], *present)


def recode_ids(
    df: DataFrame,
    whole: Mapping[str, Mapping[str, str]] | None = None,
    prefix: Mapping[str, Mapping[str, str]] | None = None,
    prefix_length: int = 5,
    tail_length: int = 2,
) -> DataFrame:
    """Master-code replacement by whole code or by prefix, the tail being kept.

    Both arguments map a column name to its replacements, which are short
    configured lists and go into the plan as literals (no join).
    """
    out = {}
    for name, mapping in (whole or {}).items():
        out[name] = sem.recode(name, mapping)
    for name, mapping in (prefix or {}).items():
        base = out.get(name, F.col(name))
        head = F.substring(base, 1, prefix_length)
        tail = F.substring(base, prefix_length + 1, tail_length)
        new_head = sem.recode(head, mapping)
        out[name] = F.when(new_head != head, F.concat(new_head, tail)).otherwise(base)
    return df.withColumns(out)


def validity_gate(
    df: DataFrame,
    required: Sequence[str],
    positive: Sequence[str],
    invalid: Mapping[str, str] | None = None,
    quarters: Sequence[str] | None = None,
) -> DataFrame:
    """Rows that may enter the panel."""
    keep = [F.col(c).isNotNull() for c in required]
    keep += [F.col(c) > 0 for c in positive]
    keep += [F.col(c) != bad for c, bad in (invalid or {}).items()]
    if quarters is not None:
        keep.append(F.col("quarter").isin(list(quarters)))
    return df.filter(sem.all_of(keep))


def canonical_panel(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Panel at its canonical grain with the weighted price."""
    return (
        df.groupBy(*keys)
        .agg(sem.sum0("units").alias("units"), sem.sum0("sales").alias("sales"))
        .withColumn("price", sem.ratio("sales", "units"))
    )


def qc_totals(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Control totals, sorted; run after each stage."""
    totals = df.groupBy(*keys).agg(*[sem.sum0(m).alias(m) for m in measures])
    return totals.orderBy(*[F.col(k).asc_nulls_last() for k in keys]) if keys else totals
