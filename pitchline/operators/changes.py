"""What changed between two states of a table, kept as snapshots of identities and content hashes.

A snapshot has a row for each identity: how many rows it has and the sum of their hashes, so that rows may be repeated and come in any order, and so that tasks combine rows before
they are shuffled; no key gathers its rows.  Snapshots are versions below a folder; a small document beside them names the current one and is replaced as a whole,
so a run that fails leaves the state before it.  Null identities are one identity of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import publish

_HASH = "decimal(38,0)"


def snapshot(rows: DataFrame, identity: Column, content: Column) -> DataFrame:
    """(identity, rows, content) of a table.  identity: any type that can be grouped; content: a struct of what counts as a change."""
    hashed = F.xxhash64(F.to_json(content, {"ignoreNullFields": "false"})).cast(_HASH)
    return rows.groupBy(identity.alias("identity")).agg(F.count("*").alias("rows"), F.sum(hashed).cast(_HASH).alias("content"))


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(identity, change: added, changed, removed or same) between two snapshots."""
    a, b = (s.select(F.col("identity").alias(f"{n}_identity"), F.struct("rows", "content").alias(n)) for s, n in ((before, "old"), (after, "new")))
    both = a.join(b, F.col("old_identity").eqNullSafe(F.col("new_identity")), "full_outer")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") == F.col("new"), "same").otherwise("changed")
    return both.select(F.when(F.col("new").isNotNull(), F.col("new_identity")).otherwise(F.col("old_identity")).alias("identity"), change.alias("change"))


def drift(before: int | None, now: int, most: float) -> str:
    """none, drop or increase: whether a number of rows moved by more than a share of the last one.  Nothing is unexpected the first time."""
    if not before or abs(now - before) <= most * before:
        return "none"
    return "drop" if now < before else "increase"


@dataclass
class Told:
    """What a commit came to.  written: whether there is a new version."""

    version: int
    written: bool
    added: int
    changed: int
    removed: int
    rows: int
    drift: str


class Snapshots:
    """Versions of a table's snapshot below a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _told(self) -> dict | None:
        from ..sources.documents import document

        try:
            return document(self.spark, f"{self.folder}/current.json", "no snapshot")
        except FileNotFoundError:
            return None

    def current(self) -> DataFrame | None:
        told = self._told()
        return self.spark.read.parquet(f"{self.folder}/version={told['version']}") if told else None

    def commit(self, new: DataFrame, most: float = 0.8) -> tuple[Told, DataFrame]:
        """Compare a snapshot with the current one; it becomes the current one if it differs.  Also the table of changes(), without those that are the same.

        most: the share by which the number of rows may move without being told as drift.
        """
        told = self._told()
        version = told["version"] + 1 if told else 0
        at = f"{self.folder}/version={version}"
        new.write.mode("overwrite").parquet(at)
        after = self.spark.read.schema(new.schema).parquet(at)
        before = self.current()
        before = after.limit(0) if before is None else before
        found = changes(before, after).filter("change != 'same'")
        found.write.mode("overwrite").parquet(f"{self.folder}/changes={version}")
        found = self.spark.read.schema(found.schema).parquet(f"{self.folder}/changes={version}")
        counts = dict(found.groupBy("change").count().collect())
        rows = int(after.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0])
        added, changed, removed = (counts.get(c, 0) for c in ("added", "changed", "removed"))
        differs = told is None or bool(counts)
        if differs:
            publish.write_atomically(self.spark, {"version": version, "rows": rows}, f"{self.folder}/current.json")
        return Told(version if differs else told["version"], differs, added, changed, removed, rows, drift(told["rows"] if told else None, rows, most)), found
