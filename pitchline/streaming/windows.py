"""Windows over rows that arrive in portions, with a bound on how late a row may come.

A window is told each time that it changes and the last line counts, so results are there before a window ends.  Rows that come after the watermark has passed the end of
their window are dropped, and with it their window's state, so the state has the open windows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import temporal
from .intake import Batches, drain


class WindowTable:
    """temporal.windows() of a stream.  at: where log and checkpoint are kept; late: how late a row may come, as `10 minutes`."""

    def __init__(self, spark: SparkSession, at: str, time: str, size: str, *keys: str, late: str, slide: str | None = None, **sums: Column):
        self.spark, self.at, self.time, self.size, self.keys, self.late, self.slide, self.sums = spark, at.rstrip("/"), time, size, keys, late, slide, sums
        self.batches = Batches(spark, self.at)

    def update(self, rows: DataFrame) -> None:
        """Take the rows of a stream that are new."""
        told = temporal.windows(rows.withWatermark(self.time, self.late), self.time, self.size, *self.keys, slide=self.slide, **self.sums)

        def log(part: DataFrame, number: int) -> None:
            self.batches.put("log", part, number)

        drain(told, log, f"{self.at}/state", "update")

    def rows(self) -> DataFrame:
        log = self.spark.read.parquet(f"{self.at}/log")
        key = [*self.keys, "start", "end"]
        last = log.groupBy(*key).agg(F.max_by(F.struct("rows", *self.sums), "batch").alias("last"))
        return last.select(*key, "last.*")
