"""Choosing among the files of a source's listing, and naming what is fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip

# Names of files about the data, words in the paths of data files.
ABOUT = "readme.txt notes.txt license.txt license.md changelog.txt".split()
WORDS = "match league premier bundesliga serie laliga ligue cup qual championship division euro worldcup".split()
EXTENSIONS = (".json", ".txt")
_REPOSITORY = r"^https?://github\.com/([^/]+)/([^/#?]+)(?:/.*)?$"


def repository(url: Column) -> Column:
    """Struct owner, repo of a repository's address; null for others."""
    text = strip(url)
    return F.when(text.rlike(_REPOSITORY), F.struct(F.regexp_extract(text, _REPOSITORY, 1).alias("owner"), F.regexp_replace(F.regexp_extract(text, _REPOSITORY, 2), r"\.git$", "").alias("repo")))


def season_score(path: Column, as_of_year: int) -> Column:
    years = F.regexp_extract_all(path, F.lit(r"(?<!\p{Nd})(20\p{Nd}{2})(?!\p{Nd})"), 1)
    near = F.array_max(F.transform(years, lambda y: F.lit(1000) - 10 * F.abs(y.cast("int") - as_of_year)))
    return F.coalesce(near, F.lit(0)) + F.when(path.rlike(r"20\p{Nd}{2}[-_/]20\p{Nd}{2}"), 100).otherwise(0)


def is_about(path: Column) -> Column:
    return F.lower(F.element_at(F.split(path, "/"), -1)).isin(*ABOUT)


def is_match_data(path: Column) -> Column:
    return ~is_about(path) & F.lower(path).rlike("|".join(WORDS))


def select_files(listing: DataFrame, as_of_year: int, override: tuple[str, str] | None = None) -> DataFrame:
    """listing: source_id, ord, path, extension.  The files to fetch, with place (from 0) in each source.

    override: a source and what stands in the paths of the files that replace its selection, if it has such files.
    """
    source = Window.partitionBy("source_id")
    data = F.when(is_match_data(F.col("path")), 1).otherwise(0)
    told = listing.withColumn("data", data).withColumn("any", F.max("data").over(source)).filter("data = any")
    scored = told.withColumn("score", season_score(F.col("path"), as_of_year))
    best = F.max("score").over(Window.partitionBy("source_id", "extension"))
    fresh = F.col("score") >= best - 30
    own = F.lit(False) if override is None else (F.col("source_id") == override[0]) & F.col("path").contains(override[1])
    flagged = scored.withColumn("fresh", fresh & F.col("extension").isin(*EXTENSIONS)).withColumn("override", own)
    kept = flagged.withColumn("overridden", F.max("override").over(source)).filter(F.when(F.col("overridden"), F.col("override")).otherwise(F.col("fresh")))
    section = F.when(F.col("overridden"), 0).when(F.col("extension") == ".json", 0).otherwise(1)
    keys = [section, F.when(F.col("overridden"), 0).otherwise(-F.col("score")), F.when(F.col("overridden"), 0).otherwise(F.length("path")), F.col("ord")]
    ranked = kept.withColumn("rank", F.row_number().over(source.orderBy(*keys)))
    once = ranked.withColumn("again", F.row_number().over(Window.partitionBy("source_id", "path").orderBy("rank"))).filter("again = 1")
    return once.select("source_id", "path", "extension", "score", (F.row_number().over(source.orderBy("rank")) - 1).alias("place"))


def safe_filename(source_id: Column, index: Column, path: Column) -> Column:
    name = F.element_at(F.split(path, "/"), -1)
    extension = F.lower(F.regexp_extract(name, r".(\.[^.]*)$", 1))
    stem = F.when(extension != "", F.regexp_replace(name, r"\.[^.]*$", "")).otherwise(name)
    return F.format_string("%s__%04d__%s%s.raw", F.regexp_replace(source_id, "[^A-Za-z0-9_-]", "_"), index, F.regexp_replace(stem, "[^A-Za-z0-9_.-]", "_"), extension)


def source_of(path: Column) -> Column:
    """The source of a raw file by its path below the raw folder."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) >= 2, parts[0]).otherwise(F.split_part(F.regexp_replace(path, r"\.raw$", ""), F.lit("__"), F.lit(1)))


# The members that a source's definition needs, in the order in which they are looked for.
REQUIRED = ("id", "name", "provider", "type", "priority", "url")


def definition_error(json: Column) -> Column:
    """The first thing wrong with a source's definition (a JSON text); null if nothing is.  A member that stands there with null is not missing."""
    texts, kinds = F.from_json(json, "map<string,string>"), F.from_json(json, "map<string,variant>")
    kind = lambda k: F.schema_of_variant(kinds[k])
    missing = [F.when(~F.map_contains_key(texts, F.lit(k)), f"Source definition missing '{k}'.") for k in REQUIRED]
    return F.when(texts.isNull(), "Source definition must be an object.").otherwise(F.coalesce(
        *missing, F.when(kind("id") != "STRING", "Source id must be a string."), F.when(strip(texts["id"]) == "", "Source id cannot be empty."),
        F.when(kind("url") != "STRING", F.concat(F.lit("Source '"), texts["id"], F.lit("' URL must be a string."))),
    ))


def by_priority() -> list[Column]:
    return [F.coalesce(F.col("priority"), F.lit(999_999)), F.col("ord")]
