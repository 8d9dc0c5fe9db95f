"""A run: its stage tables, their control totals, resumption and clean-up.

A run owns one folder. Each stage is written there under its own name, together
with the control totals that Spark counts while it writes: rows, and sums of the
measures over all rows and over each listed value of chosen columns, with what
belongs to no listed value apart. No table is scanned again for them.

A stage counts as finished once its totals are recorded, which happens after the
table is complete. A run that was lost is resumed by opening it under the same
name: finished stages are read back, and half-written ones are written anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelcast.functions import semantics as sem
from panelcast.sources.stages import stage_folder

TOTALS = "stage string, column string, value string, n_rows bigint, measure string, total double"
#: Name of the cell of a column that holds everything not listed, missing values included.
OTHER = "(other)"


class Run:
    """Stage tables of one run below ``folder``/``name``."""

    def __init__(self, spark: SparkSession, name: str | None = None, folder: str | None = None):
        self.spark = spark
        self.name = name or uuid.uuid4().hex
        self.path = f"{(folder or stage_folder(spark)).rstrip('/')}/run-{self.name}"

    def _files(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _exists(self, path: str) -> bool:
        files, where = self._files(path)
        return files.exists(where)

    def finished(self, name: str) -> bool:
        return self._exists(f"{self.path}/totals/{name}/_SUCCESS")

    def stage(
        self,
        df: DataFrame,
        name: str,
        measures: Sequence[str] = (),
        by: Mapping[str, Iterable] | None = None,
    ) -> DataFrame:
        """df as a stage table; read back, without running df, if this run has finished it before.

        ``by`` lists the values of a column whose totals are kept apart.
        """
        path = f"{self.path}/{name}"
        if not self.finished(name):
            cells, parts = [("", "", F.lit(True))], {}
            for i, (column, values) in enumerate((by or {}).items()):
                listed = list(values)
                place = F.lit(None).cast("int")
                for v in reversed(listed):
                    place = F.when(F.col(column).eqNullSafe(F.lit(v)), listed.index(v)).otherwise(place)
                parts |= {f"_place{i}": place, f"_rest{i}": sem.not_in(column, listed)}
                cells += [(column, str(v), F.col(f"_place{i}") == listed.index(v)) for v in listed]
                cells.append((column, OTHER, F.col(f"_rest{i}")))
            for j, m in enumerate(measures):
                parts |= {f"_part{j}_{p}": c for p, c in sem.exact_parts(m).items()}
            counted = []
            for i, (_, _, inside) in enumerate(cells):
                counted.append(F.count_if(inside).alias(f"n{i}"))
                for j in range(len(measures)):
                    counted += [F.sum(F.when(inside, F.col(f"_part{j}_{p}"))).alias(f"s{i}_{j}_{p}") for p in sem.PARTS]
            seen = Observation(f"{name}-{uuid.uuid4().hex}")
            # What the counts need of a row is worked out once, not once per cell.
            df.withColumns(parts).observe(seen, *counted).drop(*parts).write.mode("overwrite").parquet(path)
            got = seen.get
            rows = [
                (name, column, value, got[f"n{i}"], measure, None if measure is None else sem.of_parts([got[f"s{i}_{j}_{p}"] for p in sem.PARTS]))
                for i, (column, value, _) in enumerate(cells)
                for j, measure in enumerate(measures or [None])
            ]
            totals = self.spark.createDataFrame(rows, TOTALS).coalesce(1)
            totals.write.mode("overwrite").parquet(f"{self.path}/totals/{name}")
        return self.spark.read.schema(df.schema).parquet(path)

    def totals(self, *names: str) -> DataFrame:
        """Control totals of the finished stages, or of the named ones."""
        if not self._exists(f"{self.path}/totals"):
            return self.spark.createDataFrame([], TOTALS)
        rows = self.spark.read.schema(TOTALS).option("recursiveFileLookup", "true").parquet(f"{self.path}/totals")
        return rows.filter(F.col("stage").isin(list(names))) if names else rows

    def stages(self) -> list[str]:
        """Names of the finished stages."""
        files, where = self._files(f"{self.path}/totals")
        if not files.exists(where):
            return []
        return sorted(s.getPath().getName() for s in files.listStatus(where) if self.finished(s.getPath().getName()))

    def drop(self, *names: str) -> None:
        """Remove stages; a result that was read from them can't be used any more."""
        for name in names:
            for path in (f"{self.path}/totals/{name}", f"{self.path}/{name}"):
                files, where = self._files(path)
                files.delete(where, True)

    def close(self) -> None:
        """Remove the whole run."""
        files, where = self._files(self.path)
        files.delete(where, True)

    def __enter__(self) -> Run:
        return self

    def __exit__(self, kind, error, trace) -> None:
        """Clean up after success; a run that failed stays, to be resumed under its name."""
        if kind is None:
            self.close()


def compare_totals(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("column", "value", "measure")) -> DataFrame:
    """Totals of two stages side by side: what a step lost or gained in each cell."""
    left = before.select(*keys, F.col("n_rows").alias("rows_before"), F.col("total").alias("total_before"))
    right = after.select(*keys, F.col("n_rows").alias("rows_after"), F.col("total").alias("total_after"))
    joined = sem.null_safe_join(left, right, list(keys), "full")
    return joined.withColumn("change", F.coalesce("total_after", F.lit(0.0)) - F.coalesce("total_before", F.lit(0.0)))
