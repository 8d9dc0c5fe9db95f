"""Helpers shared by the operators: tables, stage tables, words, components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words.
BLANKS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: no later step computes it again."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/stages"
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: str) -> str:
    """SQL array of the words of a text column; empty for null or blank text."""
    trimmed = f"trim(BOTH ' \\u0009\\u000a\\u000b\\u000c\\u000d' FROM coalesce({text}, ''))"
    return f"CASE WHEN {trimmed} = '' THEN CAST(array() AS array<string>) ELSE split({trimmed}, '[\\\\x20\\\\x09-\\\\x0D]+') END"


def components(edges: DataFrame, left: str = "a", right: str = "b", rounds: int = 60) -> DataFrame:
    """Smallest id reachable over undirected edges: rows (id, component), one per id in an edge.

    Alternates linking the larger neighbours of a node to its smallest one and
    linking all smaller neighbours to it, until nothing changes. Each pass is an
    aggregation for the minimum and a join back, so that no neighbourhood is
    ever held in one task; every pass is a stage table.
    """

    def both(e: DataFrame) -> DataFrame:
        return e.select(F.col("u").alias("x"), F.col("v").alias("y")).union(
            e.select(F.col("v").alias("x"), F.col("u").alias("y"))
        )

    links = stage(
        edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .filter("u <> v")
        .distinct(),
        "links",
    )
    for _ in range(rounds):
        # Each node's larger neighbours, and the node itself, go to its smallest neighbour or itself.
        around = both(links)
        low = around.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
        large = around.filter("y > x").join(low, "x").select(F.col("y").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # Among smaller neighbours, the node and all others go to the smallest.
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = stage(moved.union(small.select("u", F.col("m").alias("v"))).distinct(), "links")
        same = new.count() == links.count() and new.exceptAll(links).isEmpty()
        links = new
        if same:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("v").alias("id")).distinct()
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        roots.select("id", F.col("id").alias("component"))
    )
