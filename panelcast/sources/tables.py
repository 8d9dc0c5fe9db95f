"""Readers and writers for inputs, stage results and deliveries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.sources.schemas import Columns


def canonical(df: DataFrame, columns: Columns) -> DataFrame:
    """Declared columns under their canonical names; text that is no number is NULL."""
    return df.select(
        *[F.col(f"`{heading}`").try_cast(kind).alias(name)
          for heading, (name, kind) in columns.items()]
    )


def read_delimited(
    spark: SparkSession, path: str, columns: Columns, sep: str = ","
) -> DataFrame:
    """Delimited text with a header. Only the header is read for the schema."""
    raw = spark.read.csv(path, header=True, sep=sep, inferSchema=False)
    return canonical(raw, columns)


def read_parquet(spark: SparkSession, path: str, columns: Columns) -> DataFrame:
    """Columnar input; only the declared columns are scanned."""
    return canonical(spark.read.parquet(path), columns)


def write_periods(df: DataFrame, path: str, period: str = "quarter") -> None:
    """Replace the partitions of the periods contained in the result, no others.

    The rebalance hint gathers small partitions and splits large ones, so a
    period that holds most of the rows is written by many tasks.
    """
    (
        df.hint("rebalance", period)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(period)
        .parquet(path)
    )


def read_periods(
    spark: SparkSession, path: str, periods: Sequence[str] | None = None, period: str = "quarter"
) -> DataFrame:
    """Stored periods; the list prunes partitions."""
    df = spark.read.parquet(path)
    df = df.withColumn(period, F.col(period).cast("string"))
    return df if periods is None else df.filter(F.col(period).isin(list(periods)))


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    """Delivery or review table as delimited text with a header."""
    df.write.mode("overwrite").csv(path, header=True, sep=sep)


def write_ordered(df: DataFrame, path: str, order: Sequence[str], files: int = 64) -> None:
    """Columnar files whose names in order, and rows within, give the sort order; missing keys last.

    Rows are dealt by ranges of the order columns and, among equal ones, by a
    hash of the whole row, so that one key that holds most rows is written by
    many tasks. No task sorts more than its range.
    """
    by = [F.col(c).asc_nulls_last() for c in order] + [F.xxhash64(*df.columns).asc()]
    ranged = df.repartitionByRange(files, *by).sortWithinPartitions(*by)
    ranged.write.mode("overwrite").parquet(path)


def read_ordered(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """Ordered files with the place of each row in the delivered order, counted from 1.

    File names begin with the number of their range. Only the number of rows per
    file is gathered; no row is sorted.
    """
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    counts = sorted((r["_file"], r["count"]) for r in rows.groupBy("_file").count().collect())
    before, starts = 0, []
    for name, count in counts:
        starts.append((name, before))
        before += count
    offsets = spark.createDataFrame(starts, "_file string, _before bigint")
    placed = rows.join(offsets, "_file")
    return placed.withColumn(position, F.col("_before") + F.col("_row") + 1).drop("_file", "_row", "_before")
