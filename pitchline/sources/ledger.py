"""What was tried to download, and how it ended: a rerun asks for what is missing alone."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "source_id string, path string, url string, place int, at string, attempts int, status int, error string, size long"


class Ledger:
    """A table of attempts below a folder; each fetch of a source adds a part of its own, so fetches do not overwrite each other."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def add(self, rows: DataFrame) -> None:
        """rows of SCHEMA."""
        rows.select(*(c.split()[0] for c in SCHEMA.split(", "))).write.parquet(f"{self.folder}/part={uuid.uuid4().hex}")

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.folder)
        except AnalysisException:  # nothing was tried yet
            return self.spark.createDataFrame([], SCHEMA)

    def done(self, source_id: str) -> DataFrame:
        """(path, place, url) of the files of a source that were downloaded, each once.

        A file counts under the place and address that it had: one that a new listing names otherwise is downloaded again.
        """
        return self.rows().filter((F.col("source_id") == source_id) & F.col("error").isNull()).select("path", "place", "url").distinct()
