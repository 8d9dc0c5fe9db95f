"""Stage tables: intermediates that several later steps read.

A stage is written once to the shared folder and read back. That cuts the
lineage, survives the loss of executors, and gives the optimizer the measured
size of the intermediate for its join choices.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def stage_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, else one in the warehouse; both are shared."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/stages"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write an intermediate as a parquet table and read it back."""
    path = f"{stage_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
