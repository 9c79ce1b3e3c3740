"""Partitioned Parquet tables that are refreshed in place.

A table is a folder with one derived partition column (A11: the day of a timestamp or the month of a date) and rows
clustered inside each partition (A12). `merge` brings in new versions of keyed rows and rewrites only the partitions
that hold one of them, before or after:

  1. the new rows, one per key, are written beside the table
  2. the partitions that hold those keys now are found by a semi-join on the key column alone
  3. old and new rows of the touched partitions are reduced to the newest per key and written beside the table; the
     list of touched partitions is written last and makes the change complete
  4. the change is applied: touched partitions are overwritten (dynamic partition overwrite), emptied ones removed

A run that stops before 3 leaves the table as it was. One that stops later is finished by the next `merge` or
`finish`, from the rows written beside the table, so no partition is lost between its removal and its new files. The
newest row of a key wins whatever the order of merges, and the same merge twice changes nothing. Partitions that no
new key touches keep their files.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundwork.operators.incremental import newest
from groundwork.session import shuffles_dropped
from groundwork.sources import files

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Table:
    """A partitioned table: `grain` of `part_of` is the partition, `cluster` orders rows inside, newest `order_col` wins."""

    spark: SparkSession = field(repr=False)
    path: str
    key: str
    order_col: str
    part_of: str
    grain: str = "day"
    cluster: tuple[str, ...] = ()

    @property
    def part(self) -> str:
        return f"{self.part_of}_{self.grain}"

    @property
    def pending(self) -> str:
        return f"{self.path}_pending"

    def with_part(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.part, period(F.col(self.part_of), self.grain))

    def exists(self) -> bool:
        return any(f.startswith(f"{self.part}=") for f in files.names(self.spark, self.path))

    def read(self, with_part: bool = False) -> DataFrame:
        """All rows; columns that came later are NULL in partitions without them."""
        df = self.spark.read.option("mergeSchema", "true").parquet(self.path)
        df = df.withColumn(self.part, F.col(self.part).cast("date"))
        return df if with_part else df.drop(self.part)

    def write_rows(self, df: DataFrame, path: str, mode: str = "overwrite") -> None:
        """Rows with the partition column, one range of clustered rows a file."""
        ranged = df.repartitionByRange(self.part, *self.cluster).sortWithinPartitions(self.part, *self.cluster)
        with shuffles_dropped(self.spark):
            ranged.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(self.part).parquet(path)

    def merge(self, new: DataFrame, name: str = "merge") -> list[str]:
        """Bring in new rows; `name` tells merges apart while one is unfinished. Returns the touched partitions."""
        self.finish()
        work = f"{self.pending}/{name}"
        with shuffles_dropped(self.spark):
            newest(self.with_part(new), self.key, self.order_col).write.mode("overwrite").option("compression", "zstd").parquet(f"{work}/new")
        fresh = self.spark.read.parquet(f"{work}/new")
        places = fresh.select(self.part)
        rows = fresh
        if self.exists():
            old = self.read(with_part=True)
            keys = fresh.select(self.key)
            places = places.union(old.join(keys, self.key, "left_semi").select(self.part))
        touched = partition_names(places)
        if self.exists():
            rows = newest(old.where(self.among(touched)).unionByName(fresh, allowMissingColumns=True), self.key, self.order_col)
        with shuffles_dropped(self.spark):  # their order is made once, when they are applied
            rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{work}/rows")
        files.write_lines(self.spark, touched, f"{work}/touched")
        files.remove(self.spark, f"{work}/new")
        self.finish()
        return touched

    def among(self, parts: list[str]) -> Column:
        named = [p for p in parts if p != NULL_PARTITION]
        at = F.col(self.part)
        cond = at.isin([F.lit(p).cast("date") for p in named]) if named else F.lit(False)
        return F.coalesce(cond, F.lit(False)) | (at.isNull() if len(named) < len(parts) else F.lit(False))

    def finish(self) -> None:
        """Apply changes that were written completely; drop those that were not."""
        for name in files.names(self.spark, self.pending):
            work = f"{self.pending}/{name}"
            if files.complete(self.spark, f"{work}/touched"):
                touched = files.read_lines(self.spark, f"{work}/touched")
                rows = self.spark.read.parquet(f"{work}/rows")
                rows = rows.withColumn(self.part, F.col(self.part).cast("date"))
                held = partition_names(rows.select(self.part))
                if held:
                    self.write_rows(rows, self.path)
                for part in touched:
                    if part not in held:
                        files.remove(self.spark, f"{self.path}/{self.part}={part}")
            files.remove(self.spark, work)


def partition_names(places: DataFrame) -> list[str]:
    """The names of the partitions in a column of partition dates; a row per partition is collected."""
    return sorted(NULL_PARTITION if r[0] is None else str(r[0]) for r in places.distinct().collect())


def period(at: Column, grain: str) -> Column:
    """The day of a timestamp or date, or the first day of its month."""
    if grain not in ("day", "month"):
        raise ValueError(f"grain is day or month, not {grain}")
    return F.to_date(at) if grain == "day" else F.trunc(F.to_date(at), "month")
