"""Raw files that arrive over time: each is parsed once, in the micro-batch that first sees it.

The stream over the folder keeps the files that it has seen in its checkpoint.  A micro-batch writes its rows and its files' report to partitions named by its number, and overwrites
them if it runs again, so a run that was stopped at any point and started anew gives each row once.  A file is known by its path: one that changes later is not read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.lines import text_matches
from ..operators.records import json_matches
from ..sources import files

BINARY = "path string, modificationTime timestamp, length long, content binary"


class Batches:
    """Tables whose partitions are the numbers of micro-batches."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def put(self, name: str, rows: DataFrame, number: int) -> DataFrame:
        """Write a micro-batch's part, in place of what an earlier try left, and read it."""
        at = f"{self.folder}/{name}/batch={number}"
        rows.write.mode("overwrite").parquet(at)
        return self.spark.read.schema(rows.schema).parquet(at)

    def rows(self, name: str, schema: StructType) -> DataFrame:
        """All parts, with the column batch; none is an empty table."""
        whole = StructType([*schema.fields, StructField("batch", LongType())])
        try:
            return self.spark.read.schema(whole).parquet(f"{self.folder}/{name}")
        except AnalysisException:
            return self.spark.createDataFrame([], whole)


def drain(stream: DataFrame, each: Callable[[DataFrame, int], None], state: str, mode: str = "append") -> None:
    """Run a stream over all that is there now.  state: its checkpoint."""
    run = stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", state).trigger(availableNow=True).start()
    run.awaitTermination()


def _match_schema(spark: SparkSession, as_of_year: int, text_form: str) -> tuple[StructType, StructType]:
    none = spark.createDataFrame([], "path string, source_id string, format string, text string")
    rows = files.union(json_matches(none), text_matches(none, as_of_year, text_form))
    return rows.schema, files.file_report(none, rows).schema


class Intake:
    """Match rows of the raw files of a folder, of those that have come since the last call as well.

    folder: where raw files arrive; at: where rows, report and checkpoint are kept.
    """

    def __init__(self, spark: SparkSession, folder: str, at: str, as_of_year: int, text_form: str = "text", most: int = 1000):
        self.spark, self.folder, self.at, self.year, self.form, self.most = spark, folder, at.rstrip("/"), as_of_year, text_form, most
        self.batches, self.taken = Batches(spark, self.at), 0

    def _take(self, found: DataFrame, number: int) -> None:
        raw = files.described(self.spark, found, self.folder)
        rows = self.batches.put("rows", files.file_matches(raw, self.year, self.form), number)
        self.taken += self.batches.put("files", files.file_report(raw, rows), number).count()

    def run(self) -> int:
        """Take all files that are new, at most `most` at a time; how many they were."""
        self.taken = 0
        stream = self.spark.readStream.format("binaryFile").schema(BINARY).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.raw").option("maxFilesPerTrigger", str(self.most)).load(self.folder)
        drain(stream, self._take, f"{self.at}/state")
        return self.taken

    def rows(self) -> DataFrame:
        return self.batches.rows("rows", _match_schema(self.spark, self.year, self.form)[0]).drop("batch")

    def report(self) -> DataFrame:
        """files.file_report() of all files so far."""
        return self.batches.rows("files", _match_schema(self.spark, self.year, self.form)[1]).drop("batch")
