"""The merge by identity over rows that arrive in portions.

The merge is an argmax for each field, so parts of it can be combined: a micro-batch tells, for each identity among its rows, the best values with their ranks, never the rows.  These go to a log
whose parts are overwritten if the batch runs again, and the table is what all lines of an identity come to: the merge of all rows at once, however they were split into batches.
No state is kept between batches, as matches have no time after which they cannot change, and a batch costs what its own rows do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators import merge
from ..shared import spread
from .intake import Batches, drain


class MergedTable:
    """The merged rows of a stream of match rows.  at: where log and checkpoint are kept."""

    def __init__(self, spark: SparkSession, at: str, merge_provenance: bool = False):
        self.spark, self.at, self.provenance = spark, at.rstrip("/"), merge_provenance
        self.batches = Batches(spark, self.at)
        self.schema: StructType | None = None

    def update(self, rows: DataFrame) -> None:
        """Take the rows of a stream that are new."""
        self.schema = merge.partly(self.spark.createDataFrame([], rows.schema), self.provenance).schema

        def log(part: DataFrame, number: int) -> None:
            self.batches.put("log", merge.partly(spread(part), self.provenance), number)  # a portion may be one file

        drain(rows, log, f"{self.at}/state")

    def rows(self) -> DataFrame:
        """merge.merged() of all rows so far."""
        log = self.batches.rows("log", self.schema) if self.schema else self.spark.read.parquet(f"{self.at}/log")
        return merge.told(merge.combined(log.drop("batch")))
