"""Delivered history stored for joining: one folder per period, bucketed and sorted by key.

Slicing reads only the periods asked for, and rows of one key lie in the bucket
of the same number in every period, so that grouping by the key, or joining
slices on it, moves no row of the history. Restating writes only the periods
concerned. The table is external: its files outlive the session, and another
session opens them under the same description.

The key should leave few rows of one value in a period (place and pack, whose
rows in a period are their channels): a bucket is read by one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelcast.sources.stages import stage


def _quoted(*names: str) -> str:
    return ", ".join("`" + n.replace("`", "``") + "`" for n in names)


@dataclass(frozen=True)
class History:
    """A stored history; ``buckets`` must be that of its files, some 200 MB of a period each."""

    spark: SparkSession
    table: str
    path: str
    keys: tuple[str, ...]
    buckets: int
    period: str = "quarter"

    def _dealt(self, df: DataFrame) -> DataFrame:
        """Rows of a bucket in one task, as Spark's own bucket numbers have it: one file per bucket and period."""
        return df.repartition(self.buckets, *self.keys)

    def create(self, df: DataFrame) -> History:
        """Store a history at a path that holds none."""
        writer = self._dealt(df).write.format("parquet").mode("errorifexists").option("path", self.path)
        (
            writer.partitionBy(self.period)
            .bucketBy(self.buckets, *self.keys)
            .sortBy(*self.keys)
            .saveAsTable(self.table)
        )
        return self

    def open(self, schema: StructType) -> History:
        """Describe stored files to this session's catalog and find their periods; ``schema`` is that of the rows."""
        fields = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        path = self.path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {_quoted(self.table)} ({fields}) USING parquet PARTITIONED BY ({_quoted(self.period)}) "
            f"CLUSTERED BY ({_quoted(*self.keys)}) SORTED BY ({_quoted(*self.keys)}) "
            f"INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )
        self.spark.sql(f"ALTER TABLE {_quoted(self.table)} RECOVER PARTITIONS")
        return self

    def rows(self, periods: Sequence[str] | None = None) -> DataFrame:
        """The history, or a slice of it: other periods aren't read."""
        df = self.spark.table(_quoted(self.table))
        return df if periods is None else df.filter(F.col(self.period).isin(list(periods)))

    def replace(self, fresh: DataFrame, periods: Sequence[str]) -> None:
        """Periods hold the rows that ``fresh`` has of them, and none where it has none; others stay untouched.

        ``fresh`` may be worked out from this history: it is stored before the
        first period is overwritten. A period is replaced as a whole, so a run
        that was lost is simply run again.
        """
        columns = [c for c in self.rows().columns if c != self.period]
        wanted = fresh.filter(F.col(self.period).isin(list(periods)))
        kept = stage(wanted.select(*columns, self.period), "restated")
        for i, period in enumerate(periods):
            view = f"{self.table}_restated_{i}"
            rows = kept.filter(F.col(self.period) == period).select(*columns)
            self._dealt(rows).createOrReplaceTempView(view)
            text = period.replace("'", "\\'")
            self.spark.sql(
                f"INSERT OVERWRITE TABLE {_quoted(self.table)} PARTITION ({_quoted(self.period)} = '{text}') "
                f"SELECT {_quoted(*columns)} FROM {_quoted(view)}"
            )
            self.spark.catalog.dropTempView(view)
