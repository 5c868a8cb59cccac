"""A keyed table that is replaced as a whole, generation after generation.

A generation is a folder of its own that counts once it is complete, so a reader never sees half a table,
and one that has opened the generation before goes on reading it. A repeated micro-batch writes the same
generation again, from the one before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kilowatch.operators.alerts import merge_states
from kilowatch.sinks import folders


class Snapshot:
    """Generations of one table below ``path``; ``table`` is the catalog's name for the newest."""

    def __init__(self, spark: SparkSession, path: str, table: str | None = None, keep: int = 3):
        if keep < 2:
            raise ValueError("open readers and repeated batches need the generation before the newest")
        self.spark, self.path, self.table, self.keep = spark, path.rstrip("/"), table, keep

    def _folder(self, generation: int) -> str:
        return f"{self.path}/generation={generation:012d}"

    def generations(self) -> list[int]:
        """Complete ones, oldest first."""
        numbers = [int(n.partition("=")[2]) for n in folders.subfolders(self.spark, self.path) if n.startswith("generation=")]
        return [n for n in numbers if folders.exists(self.spark, f"{self._folder(n)}/_SUCCESS")]

    def read(self, before: int | None = None) -> DataFrame | None:
        """The newest generation, or the newest that is older than ``before``; None if there is none."""
        found = [n for n in self.generations() if before is None or n < before]
        return self.spark.read.parquet(self._folder(found[-1])) if found else None

    def publish(self, df: DataFrame, generation: int) -> None:
        """Write a generation, point the catalog at the newest and drop the oldest."""
        df.write.mode("overwrite").parquet(self._folder(generation))
        complete = self.generations()
        for old in complete[: -self.keep]:
            folders.remove(self.spark, self._folder(old))
        if self.table:
            self._point_to(self._folder(complete[-1]))

    def _point_to(self, folder: str) -> None:
        if self.spark.catalog.tableExists(self.table):
            self.spark.sql(f"ALTER TABLE {self.table} SET LOCATION '{folder}'")
            self.spark.catalog.refreshTable(self.table)
        else:
            self.spark.catalog.createTable(self.table, path=folder, source="parquet")


def upsert_states(snapshot: Snapshot, updates: DataFrame, batch_id: int) -> None:
    """Lay the states of a micro-batch over the stored ones: of a meter the state of later time stays.

    The batch number is the generation, so a repeated batch changes nothing.
    """
    before = snapshot.read(before=batch_id)
    snapshot.publish(updates if before is None else merge_states(before, updates), batch_id)
