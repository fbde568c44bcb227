"""Tables that are replaced as a whole: each write is a new folder, and a pointer names the current one.

A reader that has begun keeps its folder, and a write that fails leaves the table as it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worktally.operators.delta import delete_keys, upsert
from worktally.sources import files


class VersionedTable:
    """A table at ``path`` with the versions ``v000001``, ``v000002`` and so on."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 2, partition_by: tuple[str, ...] = ()) -> None:
        self.spark, self.path, self.keep, self.partition_by = spark, path, max(1, keep), partition_by

    @property
    def current(self) -> str | None:
        """The name of the current version; none before the first write."""
        pointer = f"{self.path}/_CURRENT"
        return files.read_small(self.spark, pointer).strip() if files.exists(self.spark, pointer) else None

    def read(self) -> DataFrame:
        """The rows of the current version."""
        name = self.current
        if name is None:
            raise FileNotFoundError(f"nothing was written to {self.path}")
        return self.spark.read.parquet(f"{self.path}/{name}")

    def write(self, df: DataFrame) -> str:
        """Write a new version and make it current."""
        number = max([int(n[1:]) for n in files.names(self.spark, self.path) if n[:1] == "v" and n[1:].isdigit()] or [0]) + 1
        name = f"v{number:06d}"
        df.write.mode("overwrite").partitionBy(*self.partition_by).parquet(f"{self.path}/{name}")
        files.write_small(self.spark, f"{self.path}/_CURRENT", name)
        versions = [n for n in files.names(self.spark, self.path) if n[:1] == "v" and n[1:].isdigit()]
        for old in versions[: -self.keep]:
            files.remove(self.spark, f"{self.path}/{old}")
        return name

    def write_unless_empty(self, df: DataFrame, counts: list[str]) -> str | None:
        """Write a new version unless there are no rows or all ``counts`` are zero or null in each; then nothing is written."""
        some = F.lit(False)
        for c in counts:
            some = some | (F.coalesce(F.col(c), F.lit(0)) != 0)
        return self.write(df) if df.filter(some).limit(1).count() else None

    def upsert(self, batch: DataFrame, keys: list[str], order: list[str]) -> str:
        """Put a batch in; of repeated keys the last by ``order`` wins. An empty batch writes nothing new once there is a version."""
        if self.current is None:
            return self.write(upsert(batch.limit(0), batch, keys, order))
        if batch.limit(1).count() == 0:
            return self.current
        return self.write(upsert(self.read(), batch, keys, order))

    def delete(self, gone: DataFrame, keys: list[str]) -> str:
        """Take the keys of ``gone`` out."""
        return self.write(delete_keys(self.read(), gone, keys))
