"""Cascading erasure: rows that belong to erased keys leave a lake of Parquet files, file by file.

1. The frontier.  Tables are linked by edges (a child's column refers to a parent's key).  Keys to erase are expanded along
   the edges by semi-joins of the rows met for the first time only, until no edge finds new keys; cycles and self references end as well.
2. Copy-on-write.  The erased keys of each edge tell which files hold victims.  Those files alone are written again from their
   survivors, in their order, under their number; a file without survivors is removed; all other files stay as they are.

A lake has a folder for each table with a directory `<number>=<n>` for each file.  Files are written by Spark: a task that is
lost runs again, and nothing stands at its place before it is committed.  Rows are numbered through a range-partitioned sort by all their columns,
so one key with most of the rows is split over tasks; a file, which has to hold consecutive rows whole, is written by one task in a stream.

Nulls refer to nothing.  Rows that are equal are erased or stay together.  Columns of any name may stand in a table; their types have to be orderable.
An empty table has no files.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..shared import shared_folder
from .common import Workspace, partitions

#: Keys that are sent to all executors; more are joined by a shuffle.  8 bytes and some overhead each.
SMALL_KEYS = 1_000_000
#: A table is written to so many files, or one more.
FILES = 250


@dataclass(frozen=True)
class Edge:
    """Rows of child whose column refers to an erased key of parent are erased."""

    child: str
    column: str
    parent: str
    key: str


def _among(keys: DataFrame) -> DataFrame:
    """keys, broadcast only if they were counted to be few."""
    return F.broadcast(keys) if keys.limit(SMALL_KEYS + 1).count() <= SMALL_KEYS else keys


def frontier(work: Workspace, tables: dict[str, DataFrame], edges: list[Edge], seeds: dict[tuple[str, str], DataFrame]) -> dict[tuple[str, str], DataFrame]:
    """The erased keys (column k) of each (parent, key) that an edge refers to.

    seeds: a one-column table of keys for a (parent, key).  Each round follows the keys that the round before found for the first time.
    """
    wanted = {(e.parent, e.key) for e in edges}
    known: dict[tuple[str, str], DataFrame] = {}
    delta = {}
    for place, keys in seeds.items():
        k = keys.select(keys[keys.columns[0]].alias("k")).filter("k is not null").distinct()
        delta[place] = known[place] = work.save(k, f"keys-{'-'.join(place)}-0")
    step = 0
    while delta:
        step += 1
        found: dict[tuple[str, str], list[DataFrame]] = {}
        for e in edges:
            for place in (p for p in wanted if p[0] == e.child and (e.parent, e.key) in delta):
                rows = tables[e.child].select(F.col(f"`{e.column}`").alias("via"), F.col(f"`{place[1]}`").alias("k")).filter("k is not null")
                new = _among(delta[e.parent, e.key])
                found.setdefault(place, []).append(rows.join(new.withColumnRenamed("k", "via"), "via", "left_semi").select("k"))
        delta = {}
        for place, parts in found.items():
            new = parts[0]
            for part in parts[1:]:
                new = new.unionByName(part)
            new = new.distinct()
            if place in known:
                new = new.join(known[place], "k", "left_anti")
            new = work.save(new, f"keys-{'-'.join(place)}-{step}")
            if not new.isEmpty():
                delta[place] = new
                known[place] = known[place].unionByName(new) if place in known else new
    return known


def erased_rows(rows: DataFrame, table: str, edges: list[Edge], erased: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """rows, whose columns stand in the struct `row`, with a boolean `gone`: whether an edge leads from the row to an erased key."""
    gone = F.lit(False)
    for i, e in enumerate(e for e in edges if e.child == table and (e.parent, e.key) in erased):
        keys = _among(erased[e.parent, e.key].withColumnRenamed("k", f"key{i}"))
        rows = rows.join(keys, F.col(f"row.`{e.column}`") == F.col(f"key{i}"), "left")
        gone = gone | F.col(f"key{i}").isNotNull()
    return rows.withColumn("gone", gone)


def free_name(name: str, taken: list[str]) -> str:
    """name, or name with underscores after it, that no taken one equals in any case."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name


class Lake:
    """Tables as numbered Parquet files below a folder that stays."""

    def __init__(self, spark: SparkSession, path: str = ""):
        self.spark = spark
        self.path = path or f"{shared_folder(spark).rstrip('/')}/lake-{uuid.uuid4().hex}"
        self.tables: dict[str, DataFrame] = {}
        self.files: dict[str, int] = {}

    def number(self, name: str) -> str:
        return free_name("file_no", self.tables[name].columns)

    def _put(self, name: str, rows: DataFrame, id: Column, ids: int) -> None:
        """Replace the files whose rows are given: (row, n: their file, at: their place); id, below ids, is the task that writes a file."""
        n = self.number(name)
        dealt = rows.repartitionById(max(1, ids), id.cast("int")).sortWithinPartitions("n", "at").select("row.*", F.col("n").alias(n))
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(n).parquet(f"{self.path}/{name}")

    def write(self, name: str, table: DataFrame, keyed: DataFrame, work: Workspace) -> None:
        """Sort the rows of a table by a key, then by all their columns, nulls first, and write them to files of 1 + floor(n / FILES) rows.

        keyed: (row: a struct of table's columns, first: the key).
        """
        self.tables[name] = table
        order = [F.col("first").asc_nulls_first(), *(F.col(f"row.`{c}`").asc_nulls_first() for c in table.columns)]
        placed = keyed.repartitionByRange(partitions(self.spark), *order).sortWithinPartitions(*order)
        # the id is the partition's number, then the row's place in it
        saved = work.save(placed.select("row", F.monotonically_increasing_id().alias("at")), f"sorted-{name}")
        part = F.shiftright("at", 33).cast("int")
        sizes = dict(saved.groupBy(part.alias("part")).count().collect())  # one row for each partition
        before, total = {}, 0
        for p in sorted(sizes):
            before[p], total = total, total + sizes[p]
        starts = self.spark.createDataFrame(list(before.items()) or [(0, 0)], "part int, before long")
        place = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)
        numbered = saved.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("place", place)
        size = 1 + total // FILES
        self.files[name] = -(-total // size)
        self._put(name, numbered.select("row", F.expr(f"place div {size}").alias("n"), F.col("place").alias("at")), F.col("n"), self.files[name])
        work.drop(f"sorted-{name}")

    def read(self, name: str) -> DataFrame:
        """(row, n: the file's number, at: the row's place in the file, path)."""
        like, n = self.tables[name], self.number(name)
        files = self.spark.read.schema(StructType([*like.schema.fields, StructField(n, LongType())])).parquet(f"{self.path}/{name}")
        return files.select(F.struct(*(F.col(f"`{c}`") for c in like.columns)).alias("row"), F.col(f"`{n}`").alias("n"), F.col("_metadata.row_index").alias("at"), F.col("_metadata.file_path").alias("path"))

    def erase(self, name: str, edges: list[Edge], erased: dict[tuple[str, str], DataFrame]) -> dict[int, tuple[int, int]]:
        """Take erased rows from the files; (rows, erased rows) of each file that held any, by its number.  At most FILES + 1 numbers are collected."""
        rows = self.read(name).select("row", "n", "at")
        counts = erased_rows(rows, name, edges, erased).groupBy("n").agg(F.count("*").alias("rows"), F.count_if("gone").alias("erased")).filter("erased > 0").collect()
        touched = {r.n: (r.rows, r.erased) for r in counts}
        rewritten = sorted(n for n, (rows, gone) in touched.items() if gone < rows)
        if rewritten:
            kept = erased_rows(rows.filter(F.col("n").isin(rewritten)), name, edges, erased).filter("not gone")
            dense = F.create_map(*(F.lit(x) for i, n in enumerate(rewritten) for x in (n, i)))[F.col("n")]
            self._put(name, kept.select("row", "n", "at"), dense, len(rewritten))
        jvm = self.spark._jvm
        for n in touched.keys() - set(rewritten):  # no row is left
            path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/{self.number(name)}={n}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return touched

    def digests(self, name: str, money: str) -> DataFrame:
        """(n, path, rows, cents of column money, ids_sha256 of the first column) of each file, read back in its order by one task in a stream."""
        first = self.tables[name].columns[0]
        value = F.col(f"row.`{money}`").cast("double")
        cents = F.when(F.isnan(value) | (F.abs(value) == float("inf")), 0).otherwise(F.coalesce(F.floor(100 * value + 0.5), F.lit(0))).cast("long")
        rows = self.read(name).select("n", "at", "path", F.coalesce(F.col(f"row.`{first}`").cast("string"), F.lit("")).alias("id"), cents.alias("cents"))
        dealt = rows.repartitionById(max(1, self.files[name]), F.col("n").cast("int")).sortWithinPartitions("n", "at")
        return dealt.drop("at").mapInArrow(_digested, "n long, path string, rows long, cents long, ids_sha256 string")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of files, one file after the other; keeps a running hash and sum."""
    names = ["n", "path", "rows", "cents", "ids_sha256"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    at, path, rows, cents, sha = None, "", 0, 0, hashlib.sha256()

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((at, path, rows, cents, sha.hexdigest()), types)], names)

    for batch in batches:
        files, paths, ids, values = (c.to_pylist() for c in batch.columns)
        begin = 0
        while begin < len(files):
            end = begin + 1
            while end < len(files) and files[end] == files[begin]:
                end += 1
            if files[begin] != at:
                if at is not None:
                    yield told()
                at, path, rows, cents, sha = files[begin], paths[begin], 0, 0, hashlib.sha256()
            sha.update(("," * (rows > 0) + ",".join(ids[begin:end])).encode())
            rows += end - begin
            cents += sum(values[begin:end])
            begin = end
    if at is not None:
        yield told()


# The shop: which tables, the column with money, and how they refer to each other.
MONEY = {"clients": "balance", "clicks": "value", "sales": "total", "sale_lines": "amount"}
SHOP = [Edge("clients", "master_id", "masters", "master_id"), Edge("clicks", "client_id", "clients", "client_id"), Edge("sales", "client_id", "clients", "client_id"), Edge("sale_lines", "sale_id", "sales", "sale_id")]
#: One master in so many is erased.
EVERY = 200


def victim_masters(clients: DataFrame, clicks: DataFrame) -> DataFrame:
    """Masters whose crc32 is divisible by EVERY, and the one with most clicks, of equal ones the smallest."""
    owned = clients.filter("master_id is not null").select("master_id", "client_id").distinct()
    counts = clicks.filter("client_id is not null").groupBy("client_id").agg(F.count("*").alias("clicks"))
    busy = owned.join(counts, "client_id", "left").groupBy("master_id").agg(F.coalesce(F.sum("clicks"), F.lit(0)).alias("clicks"))
    most = busy.orderBy(F.desc("clicks"), "master_id").limit(1).select("master_id")
    return owned.select("master_id").filter(F.crc32(F.col("master_id").cast("string")) % EVERY == 0).unionByName(most).distinct()


def erased_shop(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Write the shop's tables as files, erase the victim masters with all that hangs on them, and tell each final file.

    Of several rows of a sale, the smallest client_id that is not null places its lines.
    """
    work = Workspace(spark, "erasure")
    lake = Lake(spark)
    sales = tables["sales"].filter("sale_id is not null").groupBy("sale_id").agg(F.min("client_id").alias("client_id"))
    owners = work.save(sales.select(F.col("sale_id").alias("sale"), F.col("client_id").alias("client")), "owners")
    for name in MONEY:
        rows = tables[name].select(F.struct("*").alias("row"))
        if name == "sale_lines":
            rows, client = rows.join(owners, F.col("row.sale_id") == owners["sale"], "left"), F.col("client")
        else:
            client = F.col("row.client_id")
        lake.write(name, tables[name], rows.select("row", F.crc32(F.coalesce(client.cast("string"), F.lit(""))).alias("first")), work)
    erased = frontier(work, tables, SHOP, {("masters", "master_id"): victim_masters(tables["clients"], tables["clicks"])})
    told: DataFrame | None = None
    for name, money in MONEY.items():
        touched = lake.erase(name, SHOP, erased)
        lost = spark.createDataFrame([(n, gone) for n, (_, gone) in touched.items()], "n long, erased long")
        files = lake.digests(name, money).join(F.broadcast(lost), "n", "left").select(
            F.col("n").alias("file_no"), F.col("rows").alias("n_rows"), F.coalesce("erased", F.lit(0)).cast("long").alias("n_erased"), "cents", F.col("erased").isNotNull().alias("rewritten"),
            F.lit(name).alias("table_name"), "ids_sha256", F.lit(",".join(tables[name].columns)).alias("columns"), "path",
        )
        told = files if told is None else told.unionByName(files)
    return told
