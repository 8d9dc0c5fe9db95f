"""Delivery: enrichment, labels, restated history and final checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions import semantics as sem


def flagged_site_filter(
    df: DataFrame,
    flags: DataFrame,
    keys: Sequence[str],
    flag: str,
    strict_cities: Sequence[str],
    quarters: Sequence[str],
) -> DataFrame:
    """In the strict cities only sites with flag = 1; elsewhere all sites.

    A missing flag is dropped in a strict city and kept elsewhere.
    """
    current = df.filter(F.col("quarter").isin(list(quarters)))
    joined = sem.lookup_join(current, flags, keys, [flag])
    keep = sem.not_in("city", strict_cities) | (F.col(flag) == 1)
    cleaned = F.when(F.col(flag).isNotNull(), (F.col(flag) == 1).cast("int"))
    return joined.filter(keep).withColumn(flag, cleaned)


def corp_pack_reference(
    packs: DataFrame, corporations: DataFrame, renames: Mapping[str, str]
) -> DataFrame:
    """Pack → description, size and corporation name."""
    base = packs.select("packid", "pack_desc", "corp_id", "pack_size").dropDuplicates()
    named = sem.lookup_join(base, corporations, ["corp_id"], ["corp_desc"])
    return named.withColumn("corp_desc", sem.recode("corp_desc", renames)).drop("corp_id")


def delivery_aggregate(
    df: DataFrame,
    packs: DataFrame,
    products: DataFrame,
    keys: Sequence[str],
    channel: str,
    forms: Sequence[str] | None = None,
    form_width: int = 4,
) -> DataFrame:
    """Sums at delivery grain with pack and product attributes.

    Attributes depend on the pack alone, so the facts are summed first and only
    the totals are joined to the lookups.
    """
    totals = df.groupBy(*keys).agg(
        sem.sum0("units").alias("units"), sem.sum0("sales").alias("sales")
    )
    out = sem.lookup_join(totals, packs, ["packid"], ["pack_desc", "corp_desc", "pack_size"])
    out = sem.lookup_join(out, products, ["packid"], ["product"])
    if forms is not None:
        out = out.filter(F.substring("pack_desc", 1, form_width).isin(list(forms)))
    out = out.withColumns(
        {
            "dosage_units": F.coalesce(F.col("pack_size") * F.col("units"), F.lit(0.0)),
            "channel": F.lit(channel),
        }
    ).drop("pack_size")
    # In this order: floors at 0, then sales and units are zero together.
    for name, value in (
        ("sales", F.when(F.col("sales") < 0, F.lit(0.0)).otherwise(F.col("sales"))),
        ("units", F.when(F.col("units") < 0, F.lit(0.0)).otherwise(F.col("units"))),
        ("sales", F.when(F.col("units") == 0, F.lit(0.0)).otherwise(F.col("sales"))),
        ("units", F.when(F.col("sales") == 0, F.lit(0.0)).otherwise(F.col("units"))),
    ):
        out = out.withColumn(name, value)
    return out


def without_class(df: DataFrame, class_code: str) -> DataFrame:
    """The main part's input without the class that the supplement brings."""
    return df.filter(sem.not_in("atc3", [class_code]))


def class_supplement(
    df: DataFrame,
    packs: DataFrame,
    products: DataFrame,
    keys: Sequence[str],
    channel: str,
    class_code: str,
    forms: Sequence[str] | None = None,
) -> DataFrame:
    """One class over all quarters and sites; the main part is made without the class."""
    return delivery_aggregate(
        df.filter(F.col("atc3") == class_code), packs, products, keys, channel, forms
    )


def channel_union(*parts: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """All channels under delivery names."""
    renamed = [p.select(*[F.col(c).alias(n) for c, n in names.items()]) for p in parts]
    merged = renamed[0]
    for other in renamed[1:]:
        merged = merged.unionByName(other)
    return merged


def clean_bid_labels(
    bids: DataFrame, merged: Sequence[str], merged_label: str, suffix: str
) -> DataFrame:
    """Bid attributes per 5-character product code, label text cleaned."""
    name3 = F.when(F.col("name3").isin(list(merged)), F.lit(merged_label)).otherwise(
        F.col("name3")
    )
    return bids.select(
        F.substring(sem.pad_id("packid"), 1, 5).alias("product_code"),
        "name1",
        F.regexp_replace("name2", suffix, "").alias("name2"),
        F.regexp_replace(name3, suffix, "").alias("name3"),
    ).distinct()


def policy_flags(df: DataFrame, policy_cities: DataFrame, bids: DataFrame) -> DataFrame:
    """City policy flag and bid attributes by product code."""
    flagged = sem.lookup_join(df, policy_cities, ["city"], ["policy"])
    coded = flagged.withColumn("product_code", F.substring("packid", 1, 5))
    return sem.lookup_join(coded, bids, ["product_code"], ["name1", "name2", "name3"])


def _positions(text: str) -> tuple[Column, Column]:
    """Position of the first digit and of the last blank; NULL if absent."""
    digit = F.nullif(F.regexp_instr(text, F.lit(r"[0-9]")), F.lit(0))
    blank = F.nullif(F.regexp_instr(text, F.lit(r"\s\S*$")), F.lit(0))
    return digit, blank


def dosage_text(text: str) -> Column:
    """First digit up to the last blank."""
    digit, blank = _positions(text)
    length = F.when(blank > digit, blank - digit).when(blank.isNotNull(), F.lit(0))
    return sem.squish(F.substring(F.col(text), digit, length))


def parse_pack_description(df: DataFrame, text: str) -> DataFrame:
    """package, dosage and quantity cut from the free-text description."""
    digit, blank = _positions(text)
    tail = sem.squish(F.substring(F.col(text), blank, F.length(text)))
    return df.withColumns(
        {
            "package": sem.squish(F.substring(F.col(text), F.lit(1), digit - 1)),
            "dosage": dosage_text(text),
            "quantity": tail.try_cast("int"),
        }
    )


def fill_dosage(df: DataFrame, text: str) -> DataFrame:
    """Parsed dosage where the delivered one is missing."""
    return df.withColumn("dosage", F.coalesce("dosage", dosage_text(text)))


def reference_split(
    nature: DataFrame, parts: Mapping[str, tuple[str, str]]
) -> dict[str, DataFrame]:
    """One wide reference as several lookups, each unique on its key."""
    return {
        name: sem.unique_lookup(
            nature.filter(F.col(key).isNotNull() & F.col(value).isNotNull()), [key], [value]
        )
        for name, (key, value) in parts.items()
    }


def maker_type_bucket(
    makers: DataFrame, buckets: Mapping[str, str], default: str
) -> DataFrame:
    """One maker type per corporation: smallest known, bucketed, default if none."""
    first = makers.groupBy("corp_desc").agg(F.min("maker_type").alias("maker_type"))
    return first.withColumn(
        "maker_type", F.coalesce(sem.recode("maker_type", buckets), F.lit(default))
    )


def molecule_flag(
    bids: DataFrame, molecules: DataFrame, label: str, exceptions: Sequence[str]
) -> DataFrame:
    """Molecule-level flag from all bid rows of the packs, on all molecules, plus named ones.

    A molecule may have several names and a product several bid labels: it is
    flagged if any of them says so.
    """
    flagged = bids.filter(F.col("name1") == label).select("molecule", "name1").distinct()
    all_molecules = sem.null_safe_join(flagged, molecules, ["molecule"], "right")
    forced = F.col("molecule_name").isin(list(exceptions))
    named = all_molecules.withColumn(
        "name1", F.when(forced, F.lit(label)).otherwise(F.col("name1"))
    )
    return named.groupBy("molecule").agg(F.max("name1").alias("name1"))


def bid_labels(rows: DataFrame, bids: DataFrame) -> DataFrame:
    """Every bid label of the products of each molecule."""
    packs = rows.select("molecule", F.substring("packid", 1, 5).alias("product_code")).distinct()
    labels = bids.select("product_code", "name1").distinct()
    return sem.null_safe_join(packs, labels, ["product_code"]).select("molecule", "name1").distinct()


def origin_classification(
    df: DataFrame,
    labels: Mapping[str, str],
    blank_label: str,
    drop_pattern: str,
    text: str = "pack_desc",
) -> DataFrame:
    """Origin label: the given one, else the one that follows from the maker type.

    Expects name2, name3, maker_type and the fallback maker_type1.
    """
    maker = F.trim(F.coalesce("maker_type", "maker_type1"))
    derived = F.lit(None).cast("string")
    for kind, label in labels.items():
        derived = F.when(maker == kind, F.lit(label)).otherwise(derived)
    return (
        df.filter(sem.not_matching(text, drop_pattern))
        .withColumns(
            {
                "name3": F.coalesce(F.trim("name3"), derived),
                "name2": F.nullif(F.col("name2"), F.lit(blank_label)),
                "maker_type": maker,
            }
        )
        .drop("maker_type1")
    )


def two_level_code_fallback(
    df: DataFrame, profile: DataFrame, attrs: Sequence[str], width: int = 5
) -> DataFrame:
    """Pack-level profile; where missing, the profile of the product code."""
    coded = profile.withColumn("product_code", F.substring("packid", 1, width))
    by_pack = sem.unique_lookup(coded, ["packid"], attrs)
    by_product = coded.groupBy("product_code").agg(
        *[sem.first_valid(a).alias(f"_p_{a}") for a in attrs]
    )
    out = sem.null_safe_join(df, by_pack, ["packid"], "left")
    out = out.withColumn("product_code", F.substring("packid", 1, width))
    out = sem.null_safe_join(out, by_product, ["product_code"], "left")
    filled = {
        a: F.when(F.col("packid").isNotNull(), F.coalesce(a, f"_p_{a}")).otherwise(F.col(a))
        for a in attrs
    }
    return out.withColumns(filled).drop("product_code", *[f"_p_{a}" for a in attrs])


def therapeutic_class_rules(
    df: DataFrame,
    rules: Sequence[tuple[str, str, str | None, str]],
    drop_molecule: str,
    rounding: Mapping[str, int],
) -> DataFrame:
    """Label by (market, class, molecule or any) → label; first match wins.

    Rows of one molecule (and of an unknown molecule) are dropped; measures are
    rounded half to even.
    """
    label = F.lit(None).cast("string")
    for market, class_code, molecule, name in reversed(rules):
        hit = (F.col("market") == market) & (F.col("atc3") == class_code)
        if molecule is not None:
            hit = hit & (F.col("molecule") == molecule)
        label = F.when(hit, F.lit(name)).otherwise(label)
    return df.filter(F.col("molecule") != drop_molecule).withColumns(
        {
            "class_label": label,
            **{m: sem.half_even(m, digits) for m, digits in rounding.items()},
        }
    )


def shift_year(quarter: str, by: int = 1) -> Column:
    year = (F.substring(quarter, 1, 4).cast("int") + by).cast("string")
    return F.concat(year, F.substring(quarter, 5, 2))


def pack_period_override(
    history: DataFrame, scope: Column, factors: Sequence[tuple[str, str, float]]
) -> DataFrame:
    """History of listed packs scaled into the following year at its own price.

    ``factors`` lists (pack, quarter, factor); other rows are dropped. Products
    are worked out and rounded in decimals. At an unchanged price units grow by
    the same factor; without a price (no sales or no units) they are NULL.
    """
    factor = F.lit(None).cast("decimal(12,8)")
    for pack, quarter, value in factors:
        hit = (F.col("packid") == pack) & (F.col("quarter") == quarter)
        factor = F.when(hit, F.lit(str(value)).cast("decimal(12,8)")).otherwise(factor)
    scaled = history.filter(scope).withColumn("_factor", factor)
    scaled = scaled.filter(F.col("_factor").isNotNull() & F.col("sales").isNotNull())
    units = F.when(
        (F.col("sales") != 0) & (F.col("units") != 0), F.col("units").cast("decimal(16,6)") * F.col("_factor")
    )
    new = {
        "sales": (F.col("sales").cast("decimal(20,6)") * F.col("_factor"), 2),
        "units": (units, 0),
        "dosage_units": (units * F.col("quantity"), 0),
    }
    return scaled.withColumns(
        {
            **{name: F.bround(value, digits).cast("double") for name, (value, digits) in new.items()},
            "quarter": shift_year("quarter"),
        }
    ).drop("_factor")


def restate_history(
    history: DataFrame,
    new_rows: DataFrame,
    override: DataFrame,
    periods: Sequence[str],
    replaced_slice: Column,
    positive: Sequence[str],
    form_ok: Column,
) -> DataFrame:
    """History with the restated periods replaced, and one slice of them taken from the override.

    What the history already holds of a restated quarter and channel makes way
    for the new rows, so that a second run on the result gives the same result.
    ``replaced_slice`` says which (channel, city, pack) rows the override takes
    over in the restated periods.
    """
    current = F.col("quarter").isin(list(periods))
    restated = new_rows.filter(current).select("quarter", "channel").unionByName(
        override.filter(current).select("quarter", "channel")
    )
    # At most the listed periods times the channels: sent to the history, which isn't shuffled for it.
    restated = F.broadcast(restated.distinct())
    history = sem.null_safe_join(history, restated, ["quarter", "channel"], "left_anti")
    appended = history.unionByName(new_rows.filter(current), allowMissingColumns=True)
    valid = appended.filter(sem.positive(*positive) & form_ok)
    kept = valid.filter(~F.coalesce(replaced_slice & current, F.lit(False)))
    return kept.unionByName(override.filter(current), allowMissingColumns=True)


def restated_periods(delivered: DataFrame, periods: Sequence[str]) -> DataFrame:
    """The restated periods alone: what the sink has to overwrite."""
    return delivered.filter(F.col("quarter").isin(list(periods)))


def differing_slices(old: DataFrame, new: DataFrame, columns: Sequence[str], slices: Sequence[str]) -> DataFrame | None:
    """Slices whose rows differ between old and new; nothing if rows have columns that have no hash of their own.

    Every row is read: a slice is the same if its number of rows and the sums of two 64-bit hashes of them are. Hashes
    are summed in halves, which holds for 2^31 rows of a slice. What is shuffled is one row per slice and task.
    """
    if any(isinstance(old.schema[c].dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) for c in columns):
        return None
    # A missing value leaves a hash as it is, so which are missing is hashed, too.
    whole = [*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns]]
    hashes = {"_a": F.xxhash64(*whole), "_b": F.xxhash64(F.lit(1), *whole)}
    low = F.lit(2**32 - 1).cast("bigint")
    halves = {f"{h}{i}": part for h in hashes for i, part in enumerate((F.col(h).bitwiseAND(low), F.shiftright(h, 32)))}

    def sums(df: DataFrame) -> DataFrame:
        rows = df.select(*slices, *[h.alias(name) for name, h in hashes.items()]).withColumns(halves)
        return rows.groupBy(*slices).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(h).alias(h) for h in halves])

    both = sums(old).unionByName(sums(new)).groupBy(*slices)
    same = sem.all_of(F.min(c) == F.max(c) for c in ("_n", *halves)) & (F.count(F.lit(1)) == 2)
    return both.agg(same.alias("_same")).filter(~F.col("_same")).select(*slices)


def change_set(old: DataFrame, new: DataFrame, keys: Sequence[str], slices: Sequence[str] = ()) -> DataFrame:
    """What turns old into new: rows of new that are inserted or changed, and rows of old that are removed.

    Rows are matched by key, a missing key to a missing key; rows that share a
    key are matched one by one, equal ones first. A changed row carries its new
    values. ``change`` is one of inserted, changed and removed; ``occurrence``
    tells rows of one key apart. ``slices`` are keys of few values, such as the
    quarter: rows of a slice that is the same in both aren't matched one by one.
    """
    values = [c for c in new.columns if c not in keys]
    differing = differing_slices(old, new, [*keys, *values], slices) if slices else None
    if differing is not None:
        # One row per slice at most: sent to both sides, which aren't shuffled for it.
        old, new = (sem.null_safe_join(df, F.broadcast(differing), slices, "left_semi") for df in (old, new))

    def rows(df: DataFrame) -> DataFrame:
        return df.select(*keys, F.struct(*values).alias("_row"))

    # Equal rows of both sides cancel out by their number, so that only the rest is matched by key.
    counted = rows(old).withColumn("_n", F.lit(-1)).unionByName(rows(new).withColumn("_n", F.lit(1)))
    left_over = counted.groupBy(*keys, "_row").agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    each = left_over.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("_n"))))
    order = Window.partitionBy(*keys, F.signum("_n")).orderBy("_row", "_copy")
    each = each.withColumn("occurrence", F.row_number().over(order))
    paired = each.groupBy(*keys, "occurrence").agg(
        F.max(F.when(F.col("_n") < 0, F.col("_row"))).alias("_old"),
        F.max(F.when(F.col("_n") > 0, F.col("_row"))).alias("_new"),
    )
    change = F.when(F.col("_old").isNull(), "inserted").when(F.col("_new").isNull(), "removed").otherwise("changed")
    shown = F.coalesce("_new", "_old")
    before = F.when(F.col("_new").isNotNull(), F.col("_old"))
    return paired.select(
        change.alias("change"), *keys, "occurrence", *[shown[v].alias(v) for v in values], before.alias("before")
    )


def apply_changes(old: DataFrame, changes: DataFrame, keys: Sequence[str], slices: Sequence[str] = ()) -> DataFrame:
    """old with a change set applied: as many copies of each removed or replaced row go as the changes name.

    Rows of ``slices``, keys of few values, without a change are handed on without being matched.
    """
    values = [c for c in old.columns if c not in keys]
    now = F.struct(*values)
    gone = changes.filter("change <> 'inserted'").select(
        *keys, F.when(F.col("change") == "changed", F.col("before")).otherwise(now).alias("_row"), F.lit(-1).alias("_n")
    )
    come = changes.filter("change <> 'removed'").select(*keys, now.alias("_row"), F.lit(1).alias("_n"))
    touched = changes.select(*keys).distinct()
    apart = []
    if slices:
        # One row per slice at most: sent to the history, which isn't shuffled for it.
        changed = F.broadcast(changes.select(*slices).distinct())
        apart = [sem.null_safe_join(old, changed, slices, "left_anti").select(*keys, *values)]
        old = sem.null_safe_join(old, changed, slices, "left_semi")
    stay = sem.null_safe_join(old, touched, keys, "left_anti")
    moved = sem.null_safe_join(old, touched, keys, "left_semi").select(*keys, now.alias("_row"), F.lit(1).alias("_n"))
    counted = moved.unionByName(gone).unionByName(come).groupBy(*keys, "_row").agg(F.sum("_n").alias("_n"))
    result = counted.filter("_n > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_n")))
    result = result.select(*keys, *[F.col("_row")[v].alias(v) for v in values])
    return reduce(DataFrame.unionByName, [*apart, result], stay)


def mat_label(df: DataFrame, end: str, windows: int = 3, quarter: str = "quarter") -> DataFrame:
    """Label of the four-quarter window, counted back from the reporting quarter."""
    end_year, end_quarter = int(end[:4]), int(end[5])
    index = F.substring(quarter, 1, 4).cast("int") * 4 + F.substring(quarter, 6, 1).cast("int")
    back = F.lit(end_year * 4 + end_quarter) - index
    years = F.floor(back / 4).cast("int")
    label = F.concat(
        F.lit("MAT"),
        F.substring((F.lit(end_year) - years).cast("string"), 3, 2),
        F.lit(f"Q{end_quarter}"),
    )
    return df.withColumn("period_mat", F.when(back.between(0, 4 * windows - 1), label))


def consolidate_delivery(
    df: DataFrame, keys: Sequence[str], last: Sequence[str], rounding: Mapping[str, int]
) -> DataFrame:
    """Final grain: rounded sums and the last description and dosage."""
    sums = sem.sums_with_picks(df, keys, {c: sem.last_valid(c) for c in last}, list(rounding))
    return sums.withColumns({m: sem.half_even(m, digits) for m, digits in rounding.items()})


def back_out_allocation(
    df: DataFrame,
    allocation: Sequence[tuple[str, str, float]],
    measures: Sequence[str],
    suffix: str = "_raw",
) -> DataFrame:
    """Measures before the market split: divided by the share of (class, market)."""
    share = F.lit(1.0)
    for cls, market, value in allocation:
        hit = (F.substring("atc3", 1, 3) == cls) & (F.col("market") == market)
        share = F.when(hit, F.lit(float(value))).otherwise(share)
    return df.withColumns({f"{m}{suffix}": sem.ratio(m, share) for m in measures})


def ordered_delivery(
    df: DataFrame, columns: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Final column order and sort, missing keys last."""
    return df.select(*columns).orderBy(*[F.col(c).asc_nulls_last() for c in order])


def duplicate_key_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs more than once, with the count.

    Counted by aggregation and joined back, so that a frequent key is not
    gathered in one window.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return sem.null_safe_join(df, repeated, keys, "inner")
