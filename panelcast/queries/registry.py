"""Registry of queries and small helpers for writing their SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str]] = {}


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name with its equivalent SQL."""

    def register(fn: Query) -> Query:
        REGISTRY[name or fn.__name__] = (fn, sql)
        return fn

    return register


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def total(x: str) -> str:
    """SQL of a sum of whole units and billionths (NULL for no values)."""
    x = f"CAST({x} AS DOUBLE)"
    return (
        f"(CAST(sum(CAST(floor({x}) AS BIGINT)) * 1000000000"
        f" + sum(CAST(floor(({x} - floor({x})) * 1000000000 + 0.5) AS BIGINT)) AS DOUBLE) / 1000000000)"
    )


def total0(x: str) -> str:
    """SQL of an exact sum as double, 0 for no values."""
    return f"coalesce({total(x)}, 0.0)"


def half_even(x: str, digits: int) -> str:
    """SQL of rounding half to even by the decimal digits of a double."""
    return f"CAST(round_even(CAST({x} AS DECIMAL(28, 9)), {digits}) AS DOUBLE)"


def values(rows: Sequence[Sequence], names: Sequence[str], alias: str) -> str:
    """SQL VALUES list as a common table expression."""

    def lit(x) -> str:
        if x is None:
            return "NULL"
        if isinstance(x, str):
            return f"'{x}'"
        return f"CAST({x} AS DOUBLE)" if isinstance(x, float) else str(x)

    body = ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows)
    return f"{alias}({', '.join(names)}) AS (VALUES {body})"


def with_(*parts: str) -> str:
    """Common table expressions followed by the final SELECT."""
    return "WITH " + ",\n".join(parts[:-1]) + "\n" + parts[-1]


def in_(values_: Sequence[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values_) + ")"


def using(keys: Sequence[str], left: str, right: str) -> str:
    """Null-safe join condition in SQL."""
    return " AND ".join(f"{left}.{k} IS NOT DISTINCT FROM {right}.{k}" for k in keys)
