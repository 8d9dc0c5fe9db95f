"""NULL, ordering and arithmetic rules that every operator relies on.

The estimation rules were written for a data-frame language in which missing
keys match each other, empty sums are zero and rounding goes to the even digit.
Spark SQL decides otherwise in each of these cases, so the rule is stated once
here and the operators use the helpers instead of the bare functions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = str | Column

def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


# --- arithmetic ---------------------------------------------------------------


def ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Quotient as double; NULL where it would be infinite or undefined."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def exact_sum(c: ColumnLike) -> Column:
    """Sum as double, whatever the order of the rows; NULL for no values.

    Whole units and billionths are summed as two integer totals, so the result
    doesn't depend on partitioning or retries. Values that are infinite, no
    number, or too large to have billionths (from 10^15) are summed as they are.
    """
    x = col(c).cast("double")
    plain = F.isnan(x) | (F.abs(x) >= 1e15)
    fine = F.when(~plain, x)
    whole = F.floor(fine)
    billionths = F.floor((fine - whole) * 1e9 + 0.5)
    units = F.sum(whole.cast("decimal(19,0)")).cast("decimal(28,0)")
    total = units * F.lit(1_000_000_000).cast("decimal(10,0)") + F.sum(billionths.cast("decimal(11,0)"))
    exact, rest = total.cast("double") / 1e9, F.sum(F.when(plain, x))
    return F.when(rest.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + rest)


#: What exact_parts splits a value into.
PARTS = ("millions", "units", "billionths", "plain")


def exact_parts(c: ColumnLike) -> dict[str, Column]:
    """A value as whole millions, the units above them and billionths, each a small integer, or as it is.

    Their sums fit 64 bits for 9 * 10^9 rows, and of_parts makes exact_sum's result of them, 0 for no values.
    """
    x = col(c).cast("double")
    plain = F.isnan(x) | (F.abs(x) >= 1e15)
    fine = F.when(~plain, x)
    whole = F.floor(fine)
    millions = F.floor(whole / F.lit(1e6))
    units = whole - millions * F.lit(1_000_000)
    return dict(zip(PARTS, (millions, units, F.floor((fine - whole) * 1e9 + 0.5), F.when(plain, x)), strict=True))


def of_parts(sums: Sequence) -> float:
    """The total of summed exact_parts."""
    millions, units, billionths, plain = sums
    exact = float(((millions or 0) * 10**6 + (units or 0)) * 10**9 + (billionths or 0)) / 1e9
    return exact if plain is None else exact + plain


def sum0(c: ColumnLike) -> Column:
    """exact_sum with 0 for a group without values."""
    return F.coalesce(exact_sum(c), F.lit(0.0))


def sum_where(condition: Column, c: ColumnLike) -> Column:
    """sum0 over the rows that meet a condition (one cell of a pivot)."""
    return sum0(F.when(condition, col(c)))


def bounded_or(c: ColumnLike, default: float, low: float, high: float) -> Column:
    """Value if it lies in [low, high]; the default if outside or NULL."""
    return F.when(col(c).between(low, high), col(c)).otherwise(F.lit(default))


def half_even(c: ColumnLike, digits: int) -> Column:
    """Rounded half to even by the decimal digits of the value (nine are kept), as double.

    Values too large for that, infinite or no number are rounded as doubles.
    """
    exact = F.bround(col(c).cast("double").try_cast("decimal(28,9)"), digits).cast("double")
    return F.coalesce(exact, F.bround(col(c).cast("double"), digits))


# --- three-valued logic -------------------------------------------------------


def not_in(c: ColumnLike, values: Sequence) -> Column:
    """Membership test that keeps NULL on the 'not a member' side."""
    return ~F.coalesce(col(c).isin(list(values)), F.lit(False))


def not_matching(c: ColumnLike, pattern: str) -> Column:
    """Negated regex test that keeps NULL text."""
    return ~F.coalesce(col(c).rlike(pattern), F.lit(False))


def if_else3(condition: Column, yes: ColumnLike, no: ColumnLike) -> Column:
    """Conditional whose result is NULL when the condition is NULL."""
    return F.when(condition, col(yes)).when(~condition, col(no))


# --- text ---------------------------------------------------------------------


def pad_id(c: ColumnLike, width: int = 7) -> Column:
    """Left-pad an id with zeros; longer ids stay whole (lpad would cut them)."""
    text = col(c).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def squish(c: ColumnLike) -> Column:
    """Trim and reduce inner blanks to one."""
    return F.trim(F.regexp_replace(col(c), r"\s+", " "))


def recode(c: ColumnLike, mapping: Mapping[str, str]) -> Column:
    """Replace listed values, keep the others. The mapping is a literal in the plan."""
    if not mapping:
        return col(c)
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col(c)), col(c))


# --- order-dependent picks ----------------------------------------------------


def first_valid(c: str, rank: str | None = None) -> Column:
    """First non-NULL value: lowest source rank, then smallest value.

    Row order does not survive a shuffle, so 'first' is defined by a total
    order over the data itself.
    """
    if rank is None:
        return F.min(c)
    return F.min(F.when(F.col(c).isNotNull(), F.struct(F.col(rank), F.col(c))))[c]


def last_valid(c: str, rank: str | None = None) -> Column:
    """Last non-NULL value: highest source rank, then greatest value."""
    if rank is None:
        return F.max(c)
    return F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(rank), F.col(c))))[c]


def sums_with_picks(
    df: DataFrame, keys: Sequence[str], picks: Mapping[str, Column], measures: Sequence[str]
) -> DataFrame:
    """Sums per key together with picked text attributes (first or last valid).

    The smallest or largest text needs a sort-based aggregation. Rows are
    therefore summed by hash first, with the attributes as part of the key, and
    only the few distinct combinations go through the second step.
    """
    fine = df.groupBy(*keys, *picks).agg(*[exact_sum(m).alias(m) for m in measures])
    return fine.groupBy(*keys).agg(
        *[pick.alias(name) for name, pick in picks.items()],
        *[sum0(m).alias(m) for m in measures],
    )


# --- joins --------------------------------------------------------------------


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join in which a missing key matches a missing key.

    Still hash-partitioned on the keys. No broadcast is forced: whether a side
    is small is left to the optimizer, which knows its measured size.
    """
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if clash and how not in ("left_semi", "left_anti"):
        raise ValueError(f"columns on both sides of the join: {sorted(clash)}")
    other = {k: f"_right_{k}" for k in keys}
    rest = [c for c in right.columns if c not in keys]
    if how in ("left_semi", "left_anti"):
        rest = []
    renamed = right.select(*[F.col(k).alias(other[k]) for k in keys], *rest)
    joined = left.join(
        renamed, all_of(F.col(k).eqNullSafe(F.col(other[k])) for k in keys), how
    )
    if how in ("left_semi", "left_anti"):
        return joined
    if how == "right":
        key_cols = [F.col(other[k]).alias(k) for k in keys]
    elif how in ("full", "outer", "full_outer"):
        key_cols = [F.coalesce(k, other[k]).alias(k) for k in keys]
    else:
        key_cols = [F.col(k) for k in keys]
    by_name = dict(zip(keys, key_cols))
    return joined.select(*[by_name.get(c, F.col(c)) for c in left.columns], *rest)


def unique_lookup(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Exactly one row per key, so that a lookup join can never multiply rows.

    Where a key has several rows the one that sorts first (NULL last) is kept as
    a whole.
    """
    order = F.struct(*[x for v in values for x in (F.col(v).isNull(), F.col(v))])
    best = F.min_by(F.struct(*[F.col(v) for v in values]), order)
    return (
        df.select(*keys, *values)
        .groupBy(*keys)
        .agg(best.alias("_best"))
        .select(*keys, *[F.col(f"_best.{v}").alias(v) for v in values])
    )


def lookup_join(
    df: DataFrame, table: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Left join to a table that is first made unique on the join key."""
    return null_safe_join(df, unique_lookup(table, keys, values), keys, "left")


def fan_out_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    row_id: str,
    how: str = "inner",
    rows_per_task: int = 200_000,
) -> DataFrame:
    """Null-safe join in which every left row of a key meets every right row of it.

    The output of one key is the product of both sides, while its input is
    small, so neither the hash of the key nor measured input sizes spread it.
    The products are counted first. Left rows of a key are cut into shards by a
    hash of ``row_id``, several for each task that the key's product is worth,
    and the right rows of the key are repeated once per shard. Both sides are
    then dealt by key and shard to a fixed number of tasks, which adaptive
    coalescing leaves alone.
    """
    sizes = null_safe_join(
        left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_left")),
        right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_right")),
        keys,
        "left",
    ).withColumn("_out", F.col("_left") * F.greatest(F.coalesce("_right", F.lit(1)), F.lit(1)))
    total = sizes.agg(F.sum("_out")).first()[0] or 0
    tasks = max(1, -(-int(total) // rows_per_task))
    shards = sizes.select(
        *keys,
        F.when(F.col("_out") <= rows_per_task, F.lit(1))
        .otherwise(F.least(F.col("_left"), F.ceil(8 * F.col("_out") / rows_per_task)))
        .cast("bigint")
        .alias("_shards"),
    )
    placed = null_safe_join(left, shards, keys, "left").withColumn(
        "_shard", F.pmod(F.xxhash64(row_id), "_shards")
    )
    repeated = null_safe_join(right, shards, keys, "inner").withColumn(
        "_shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_shards") - 1))
    )
    # One text for key and shard (missing keys are left out of it): a single join
    # key, so that the given number of partitions serves the join as it is.
    place = F.to_json(F.struct(*keys, "_shard"))
    rest = [c for c in right.columns if c not in keys]
    dealt = placed.withColumn("_place", place).drop("_shards", "_shard").repartition(tasks, "_place")
    offered = repeated.select(place.alias("_place"), *rest).repartition(tasks, "_place")
    return dealt.join(offered, "_place", how).select(*left.columns, *rest)


def positive(*columns: str) -> Column:
    return all_of(F.col(c) > 0 for c in columns)
