"""Rejects: rows that can't be used, with their reasons and their text as delivered.

Delimited files are read without guessing: every field stays text until it is
cast, and a record with too few or too many fields keeps its whole line. Nothing
is turned into NULL silently: each row either is kept or goes to the rejects with
every reason that holds, so that rows read = rows kept + rows rejected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions import semantics as sem
from panelcast.sources.schemas import Columns

REASONS, RAW, LINE = "_reasons", "_raw", "_line"


def read_raw(spark: SparkSession, path: str, columns: Columns, sep: str = ",") -> DataFrame:
    """All fields as text under their headings, and the whole line of a record whose number of fields is off."""
    head = spark.read.csv(path, header=True, sep=sep, inferSchema=False).schema
    schema = T.StructType([*[T.StructField(f.name, T.StringType()) for f in head.fields], T.StructField(LINE, T.StringType())])
    return spark.read.csv(
        path, header=True, sep=sep, schema=schema, mode="PERMISSIVE", columnNameOfCorruptRecord=LINE, enforceSchema=True
    )


def _reasons(conditions: Mapping[str, Column]) -> Column:
    held = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in conditions.items()])
    return F.filter(held, lambda x: x.isNotNull())


def canonical_with_reasons(raw: DataFrame, columns: Columns) -> DataFrame:
    """Declared columns under their canonical names, the text of all fields, and what is wrong with them.

    A field that holds text other than blanks but can't be read as its type is a
    reason; an empty field is a missing value.
    """
    fields = [c for c in raw.columns if c != LINE]
    text = F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in fields]))
    wrong = {}
    for heading, (name, kind) in columns.items():
        given = F.trim(F.col(f"`{heading}`").cast("string"))
        wrong[f"{name} unreadable"] = (given != "") & F.col(f"`{heading}`").try_cast(kind).isNull()
    if LINE in raw.columns:
        wrong = {"wrong number of fields": F.col(LINE).isNotNull(), **wrong}
        text = F.coalesce(F.col(LINE), text)
    values = [F.col(f"`{heading}`").try_cast(kind).alias(name) for heading, (name, kind) in columns.items()]
    return raw.select(*values, text.alias(RAW), _reasons(wrong).alias(REASONS))


def with_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Adds the names of the rules that hold to the reasons of each row; a rule that is unknown doesn't hold."""
    found = _reasons(rules)
    before = F.col(REASONS) if REASONS in df.columns else F.array().cast("array<string>")
    return df.withColumn(REASONS, F.concat(before, found))


def gate_rules(
    required: Sequence[str],
    positive: Sequence[str],
    invalid: Mapping[str, str] | None = None,
    quarters: Sequence[str] | None = None,
) -> dict[str, Column]:
    """The panel gate as rules, one per way to fail it: what ``validity_gate`` drops, and nothing else."""
    rules = {f"{c} missing": F.col(c).isNull() for c in [*required, *positive, *(invalid or {})]}
    rules |= {f"{c} not positive": F.col(c) <= 0 for c in positive}
    rules |= {f"{c} not available": F.col(c) == bad for c, bad in (invalid or {}).items()}
    if quarters is not None:
        rules["other quarter"] = sem.not_in("quarter", quarters)
    return rules


def kept(df: DataFrame) -> DataFrame:
    """Rows without a reason, as they were."""
    return df.filter(F.size(REASONS) == 0).drop(REASONS, RAW)


def rejected(df: DataFrame) -> DataFrame:
    """Rows with a reason; ``reason`` is the first of them, under which the row is counted."""
    return df.filter(F.size(REASONS) > 0).withColumn("reason", F.get(F.col(REASONS), F.lit(0))).withColumnRenamed(REASONS, "reasons")


def balance(df: DataFrame, measure: str | None = None) -> DataFrame:
    """Rows, and their sum of a measure, that were kept (reason NULL) and rejected for each first reason."""
    sums = [sem.sum0(measure).alias(measure)] if measure else []
    return df.groupBy(F.get(F.col(REASONS), F.lit(0)).alias("reason")).agg(F.count(F.lit(1)).alias("n_rows"), *sums)
