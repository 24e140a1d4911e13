"""The documents that stages leave for each other, read back: registry, configuration, normalised and merged rows, report."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import clean
from ..operators.merge import with_source
from ..operators.sinks import MATCH
from .selection import by_priority, definition_error


def document(spark: SparkSession, path: str, missing: str) -> object:
    """A small JSON document, in any file system that Spark reads; FileNotFoundError(missing) if there is none."""
    try:
        row = spark.read.text(path, wholetext=True).first()
    except AnalysisException as e:
        raise FileNotFoundError(missing) from e
    return json.loads(row[0] if row else "")


def _elements(array: Column) -> Column:
    """(text, whether it is an object) of each element of a JSON array."""
    texts, kinds = F.from_json(array, "array<string>"), F.from_json(array, "array<variant>")
    return F.transform(F.arrays_zip(texts.alias("t"), kinds.alias("k")), lambda x: F.struct(x.t.alias("json"), F.coalesce(F.schema_of_variant(x.k).startswith("OBJECT"), F.lit(False)).alias("is_object")))


def registry(spark: SparkSession, path: str) -> DataFrame:
    """(ord, json, id, url, priority, error, place) of each source of a registry, place (from 1) by priority.

    A document without a list of sources is an error; a definition with a fault is a row that says so.
    """
    told = document(spark, path, f"Source registry not found: {path}")
    if not isinstance(told, dict):
        raise ValueError("source.json must contain a JSON object.")
    if not isinstance(told.get("sources"), list):
        raise ValueError("source.json must contain a 'sources' array.")
    return definitions(spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>")["sources"].alias("sources")))


def definitions(listed: DataFrame) -> DataFrame:
    """registry() of a row with `sources`, the JSON text of the list."""
    each = listed.select(F.posexplode(_elements(F.col("sources"))).alias("ord", "x")).select("ord", F.col("x.json").alias("json"))
    texts = F.col("texts")
    rows = each.withColumn("texts", F.from_json("json", "map<string,string>")).select("ord", "json", texts["id"].alias("id"), texts["url"].alias("url"), texts["priority"].try_cast("long").alias("priority"), definition_error(F.col("json")).alias("error"))
    # a registry is one small document, so its order is found in one task
    return rows.select("*", F.row_number().over(Window.orderBy(*by_priority())).alias("place"))


def _typed(each: DataFrame, *keep: str) -> DataFrame:
    """Match rows of JSON texts (column json), which stay beside them as `raw`."""
    fields = F.from_json("json", MATCH)
    return each.select(*keep, F.col("json").alias("raw"), fields.alias("m")).select(*keep, "raw", "m.*")


def normalized_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Match rows of all documents (*.json) of a folder, with provenance, `_file` and `_rec_ord`.

    The source is the document's sourceId, else its file's stem.  A document without a list of matches has none; elements
    that are no objects are left out; a file that is no object gives no rows and leaves the others.
    """
    files = spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("name"), "value")
    members = F.from_json("value", "map<string,string>")
    source = F.coalesce(clean(members["sourceId"]), F.regexp_replace("name", r"\.json$", ""))
    listed = F.when(F.ltrim(members["matches"]).startswith("["), _elements(members["matches"]))
    each = files.select(F.array("name").alias("_file"), source.alias("source"), F.posexplode(F.filter(listed, lambda x: x.is_object)).alias("at", "x"))
    rows = _typed(each.select("_file", "source", F.col("at").cast("long").alias("_rec_ord"), F.col("x.json").alias("json")), "_file", "_rec_ord", "source")
    return with_source(rows, F.col("source")).drop("source")


def dataset_rows(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Match rows of the merged document with `record_index`, their place among the objects of its list.

    Elements that are no objects are left out; strict makes the first of them an error.
    """
    try:
        text = spark.read.text(path, wholetext=True).select(F.col("value"))
        members = F.from_json("value", "map<string,string>")
        told = text.select(members.isNotNull().alias("object"), F.coalesce(F.ltrim(members["matches"]).startswith("["), F.lit(False)).alias("listed")).first()
    except AnalysisException as e:
        raise (RuntimeError(f"Deduplicated input dataset does not exist: {path}") if strict else FileNotFoundError(f"Deduplicated dataset not found: {path}")) from e
    error = RuntimeError if strict else ValueError
    if not told or not told["object"]:
        raise error("Deduplicated dataset must be a JSON object.")
    if not told["listed"]:
        raise error("Deduplicated dataset does not contain a valid matches array." if strict else "Deduplicated dataset is missing a valid 'matches' array.")
    elements = _elements(members["matches"])
    if strict:
        wrong = text.select(F.posexplode(elements).alias("at", "x")).filter("not x.is_object").agg(F.min("at").alias("at")).first()["at"]
        if wrong is not None:
            raise RuntimeError(f"Invalid match record at index {wrong}.")
    each = text.select(F.posexplode(F.filter(elements, lambda x: x.is_object)).alias("at", "x"))
    return _typed(each.select(F.col("at").cast("long").alias("record_index"), F.col("x.json").alias("json")), "record_index")
