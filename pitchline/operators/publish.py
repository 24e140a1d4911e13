"""Publication: the canonical projection, order, hash and atomic single-file sink."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ..shared import Workspace

VERSION = "1.0"


def clean_ids(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(c, lambda s: F.trim(s) != "")))


def _pair(c: str) -> Column:
    return F.struct(F.col(f"{c}.id").alias("id"), F.col(f"{c}.name").alias("name"))


def canonical(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Match rows as published: six fields and the source ids.  Members are in the order of their names, as the hash needs."""
    return rows.select(
        _pair("awayTeam").alias("awayTeam"), _pair("competition").alias("competition"), _pair("homeTeam").alias("homeTeam"), "id",
        F.struct(clean_ids(F.col("provenance.sourceIds")).alias("sourceIds")).alias("provenance"), "scheduledAt", "status", *keep,
    )


def sort_key() -> list[Column]:
    return [F.coalesce(F.col("scheduledAt"), F.lit("")), F.lower(F.coalesce(F.col("competition.name"), F.lit(""))), F.lower(F.coalesce(F.col("id"), F.lit("")))]


#: Rows of the published document at most, as the rules have it.
MOST = 10_000


def dataset_hash(rows: DataFrame, order: tuple[str, ...], most: int = MOST) -> DataFrame:
    """One row, match_count and dataset_hash: SHA-256 of the sorted rows' compact JSON.

    All rows are one text, so more than `most` of them are an error before they meet in one task.
    """
    match = F.struct("awayTeam", "competition", "homeTeam", "id", "provenance", "scheduledAt", "status")
    keyed = rows.select(F.struct(*[k.alias(f"k{i}") for i, k in enumerate(sort_key())], *order, match.alias("match")).alias("row"))
    # each task hands on `most` rows and one at most
    listed = keyed.limit(most + 1).agg(F.transform(F.array_sort(F.collect_list("row")), lambda r: r.match).alias("matches"))
    text = F.when(F.size("matches") > most, F.raise_error(F.lit(f"more than {most} matches")).cast("string")).when(F.size("matches") == 0, "[]").otherwise(F.to_json("matches", {"ignoreNullFields": "false"}))
    return listed.select(F.size("matches").cast("long").alias("match_count"), F.sha2(text, 256).alias("dataset_hash"))


def places(rows: DataFrame, keys: list[Column], day: Column, work: Workspace) -> DataFrame:
    """rows with their place (from 1) in the order of the keys, of which the day is the first.

    Days are counted and ranked each by itself, so no task sees all rows; rows are saved first, as they are read twice.
    """
    saved = work.save(rows.withColumn("__day", day), "placed")
    days = saved.groupBy("__day").agg(F.count("*").alias("n"))
    before = days.select(F.col("__day").alias("__of"), (F.sum("n").over(Window.orderBy("__day")) - F.col("n")).alias("__before"))  # one row for each day
    within = F.row_number().over(Window.partitionBy("__day").orderBy(*keys))
    placed = saved.withColumn("__within", within).join(before, F.col("__day").eqNullSafe(F.col("__of")))
    return placed.withColumn("place", F.col("__before") + F.col("__within")).drop("__day", "__of", "__before", "__within")


def source_ids(rows: DataFrame) -> DataFrame:
    """One row, source_ids and source_count over all rows."""
    ids = rows.select(F.explode("provenance.sourceIds").alias("s")).filter(F.trim("s") != "").distinct()
    return ids.agg(F.array_sort(F.collect_list("s")).alias("source_ids"), F.count("*").alias("source_count"))


def match_dict(row: Row) -> dict:
    return {c: row[c].asDict(True) if isinstance(row[c], Row) else row[c] for c in ("id", "competition", "homeTeam", "awayTeam", "scheduledAt", "status", "provenance")}


def payload(rows: DataFrame, order: tuple[str, ...], generated_at: str, validation: dict, most: int = MOST) -> dict:
    """The published document.  More rows than the rules allow are an error, so the driver never holds more.

    validation: what the report says of the check; its status and permission are told in the document.
    """
    ordered = rows.orderBy(*sort_key(), *order).limit(most + 1).collect()
    if len(ordered) > most:
        raise ValueError(f"more than {most} matches")
    matches = [match_dict(r) for r in ordered]
    ids = sorted({s for m in matches for s in (m["provenance"] or {}).get("sourceIds") or ()})
    text = json.dumps(matches, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    return {
        "schemaVersion": VERSION, "generatedAt": generated_at,
        "pipeline": {"stage": "BUILD_MATCHES", "validationStatus": validation.get("status"), "publicationAllowed": validation.get("publicationAllowed")},
        "sourceCount": len(ids), "sourceIds": ids, "matchCount": len(matches), "datasetHash": hashlib.sha256(text.encode()).hexdigest(), "matches": matches,
    }


def json_text(document: object) -> str:
    """The style of every document that is written."""
    return json.dumps(document, ensure_ascii=False, indent=2) + "\n"


def write_atomically(spark: SparkSession, document: dict, path: str) -> None:
    """One JSON file: written beside its place, then renamed over it, in whatever file system the path names."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target, aside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    system = target.getFileSystem(conf)
    out = system.create(aside, True)
    out.write(bytearray(json_text(document).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri() if target.toUri().getScheme() else system.getUri(), conf)
    over = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(system.makeQualified(aside), system.makeQualified(target), over)
