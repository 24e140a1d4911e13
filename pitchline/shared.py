"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a folder of this machine, if all of Spark runs on it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    return named or f"file://{tempfile.gettempdir()}/checkpoints"


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for files that stay."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(rows: DataFrame) -> DataFrame:
    """rows dealt to all cores, for work that takes much longer than to move them; a table of few files is read by few tasks."""
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


class Workspace:
    """Intermediate tables of one query.

    A saved table cuts the lineage: if an executor is lost, only the steps after it run again.
    Tables are deleted by drop(), and those left over when Python ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.saved: set[str] = set()
        atexit.register(self.close)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.saved.add(name)
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/{name}")
        return self.read(name, df)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(f"{self.path}/{name}")

    def drop(self, name: str = "") -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def only(self, *names: str) -> None:
        """Drop all saved tables but these, which a result still reads."""
        for name in self.saved - set(names):
            self.drop(name)
        self.saved &= set(names)

    def close(self) -> None:
        try:
            self.drop()
        except Exception:  # the JVM may have ended before Python does
            pass
