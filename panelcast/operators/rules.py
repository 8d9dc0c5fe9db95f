"""Rules as data: a table of keys, a priority and values, in place of chains of conditions.

A missing key of a rule means any value. Of the rules that match a row the one
with the lowest priority decides; among equal priorities, the lowest values.
A missing key of a fact is matched by "any" only.

Rules fall into patterns: the sets of keys that they bind, at most 2^keys of
them. The rules of a pattern are a lookup by its bound keys, so a fact meets one
lookup per pattern, whatever the number of rules, and rules are compared with
rules by lookups, too. Lookups are unique on their key: no fact is multiplied.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions import semantics as sem


def from_rows(
    like: DataFrame, rows: Sequence[Sequence], keys: Sequence[str], values: str, priority: str = "priority"
) -> DataFrame:
    """Rule table of a listed rule set, in its order; keys are text, ``values`` is a schema text."""
    schema = ", ".join([f"{priority} int", *[f"{k} string" for k in keys], values])
    numbered = [(i, *r) for i, r in enumerate(rows)]
    return like.sparkSession.createDataFrame(numbered, schema)


def patterns(rules: DataFrame, keys: Sequence[str]) -> list[tuple[str, ...]]:
    """The sets of bound keys that occur, larger ones first."""
    bound = rules.select(*[F.col(k).isNotNull().alias(k) for k in keys]).distinct().collect()
    found = {tuple(k for k in keys if r[k]) for r in bound}
    return sorted(found, key=lambda p: (-len(p), p))


def _of(rules: DataFrame, keys: Sequence[str], pattern: Sequence[str]) -> DataFrame:
    return rules.filter(
        sem.all_of(F.col(k).isNotNull() if k in pattern else F.col(k).isNull() for k in keys)
    )


def _with_first(
    df: DataFrame, rules: DataFrame, on: Sequence[str], what: Column, name: str
) -> DataFrame:
    """df with the lowest ``what`` of the rules that share the keys ``on``; NULL without one.

    Without keys this is a single value, which enters the plan as a literal.
    """
    if on:
        return df.join(rules.groupBy(*on).agg(F.min(what).alias(name)), list(on), "left")
    kind = rules.select(what.alias(name)).schema[name].dataType
    lowest = rules.agg(F.min(what).alias(name)).first()[name]
    if lowest is None:
        return df.withColumn(name, F.lit(None).cast(kind))
    fields = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(lowest, kind.fields)]
    return df.withColumn(name, F.struct(*fields))


def _lowest(columns: Sequence[str]) -> Column:
    """The lowest of the columns that aren't NULL; NULL without any."""
    if len(columns) == 1:
        return F.col(columns[0])
    return F.least(*columns)


def first_match(
    df: DataFrame,
    rules: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    priority: str = "priority",
    rule: str = "rule",
) -> DataFrame:
    """df with the values of the first rule that matches, and that rule's priority as ``rule``.

    All of them are NULL for a row that no rule matches, also without any rules.
    """
    chosen = []
    out = df
    decides = F.struct(priority, *values)
    for i, pattern in enumerate(patterns(rules, keys)):
        chosen.append(f"_rule{i}")
        out = _with_first(out, _of(rules, keys, pattern), pattern, decides, chosen[-1])
    if not chosen:
        kinds = {f.name: f.dataType for f in rules.schema}
        return df.withColumns(
            {rule: F.lit(None).cast(kinds[priority]), **{v: F.lit(None).cast(kinds[v]) for v in values}}
        )
    out = out.withColumn("_first", _lowest(chosen))
    taken = {rule: F.col("_first")[priority], **{v: F.col("_first")[v] for v in values}}
    return out.withColumns(taken).drop("_first", *chosen)


def conflicts(
    rules: DataFrame, keys: Sequence[str], values: Sequence[str], priority: str = "priority"
) -> DataFrame:
    """Each rule with the first earlier rule that takes all of its rows, and the first that takes some.

    ``covered_by`` is the lowest priority of an earlier rule whose keys are each
    "any" or the same: the rule can't be reached. ``overlapped_by`` is the lowest
    priority of an earlier rule that can match some of its rows, but not all. That
    several rules cover a rule only together isn't looked for, since keys are open
    sets. Equal rules count as one.
    """
    rules = rules.select(priority, *keys, *values).distinct()
    place = F.struct(priority, *values)
    occurring = patterns(rules, keys)
    kind = rules.schema[priority].dataType
    parts = []
    for later in occurring:
        part = _of(rules, keys, later).withColumn("_at", place)
        covering, overlapping = [], []
        for i, earlier in enumerate(occurring):
            name = f"_p{i}"
            shared = [k for k in earlier if k in later]
            (covering if len(shared) == len(earlier) else overlapping).append(name)
            part = _with_first(part, _of(rules, keys, earlier), shared, place, name)
            part = part.withColumn(name, F.when(F.col(name) < F.col("_at"), F.col(name)))

        def first(columns: Sequence[str]) -> Column:
            return _lowest(columns)[priority] if columns else F.lit(None).cast(kind)

        parts.append(
            part.select(
                priority, *keys, *values, first(covering).alias("covered_by"), first(overlapping).alias("overlapped_by")
            )
        )
    if not parts:
        nothing = F.lit(None).cast(kind)
        return rules.withColumns({"covered_by": nothing, "overlapped_by": nothing})
    return reduce(DataFrame.unionByName, parts)


def usage(
    report: DataFrame,
    matched: DataFrame,
    measures: Sequence[str],
    priority: str = "priority",
    rule: str = "rule",
) -> DataFrame:
    """The report with a status and the rows and sums that each priority decided in ``matched``.

    A rule is ``unreachable`` behind a covering one; else ``unused`` if it decided
    no row, ``partly`` if an earlier rule takes some of its rows, else ``clear``.
    """
    decided = matched.filter(F.col(rule).isNotNull()).groupBy(F.col(rule).alias(priority)).agg(
        F.count(F.lit(1)).alias("n_rows"), *[sem.sum0(m).alias(m) for m in measures]
    )
    out = report.join(decided, [priority], "left").withColumns(
        {"n_rows": F.coalesce("n_rows", F.lit(0)), **{m: F.coalesce(m, F.lit(0.0)) for m in measures}}
    )
    status = (
        F.when(F.col("covered_by").isNotNull(), "unreachable")
        .when(F.col("n_rows") == 0, "unused")
        .when(F.col("overlapped_by").isNotNull(), "partly")
        .otherwise("clear")
    )
    return out.withColumn("status", status)
