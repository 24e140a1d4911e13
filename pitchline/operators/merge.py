"""Identity of matches, and merging records of one identity by completeness.

Each field is an argmax over (completeness, earlier first), which partial aggregation combines before
the shuffle; no group is ever gathered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_or_empty, identity_text, let, strip_or_empty
from ..functions.timeparse import identity_datetime

ORDER = ("_file", "_rec_ord")
_TEAMS = ("homeTeam", "awayTeam")
_HELD = ("id", "competition", *_TEAMS, "scheduledAt", "status", "provenance", "score")


def file_key(path: Column) -> Column:
    """Files are in the order of the parts of their paths, not of the paths as texts."""
    return F.split(path, "/")


def side_key(team: str) -> Column:
    told = F.struct(F.lower(clean_or_empty(F.col(f"{team}.id"))).alias("id"), identity_text(F.col(f"{team}.name")).alias("name"))
    return let(told, lambda t: F.when(t["id"] != "", F.concat(F.lit("id:"), t["id"])).when(t["name"] != "", F.concat(F.lit("name:"), t["name"])).otherwise(""))


def identity() -> Column:
    """Struct type, key: the explicit id, else sides and time, else none that is safe."""
    found = lambda kind, key: F.struct(F.lit(kind).alias("type"), key.alias("key"))

    def chosen(p: Column) -> Column:
        every = (p["home"] != "") & (p["away"] != "") & (p["time"] != "")
        composite = F.when(every, found("FIXTURE_COMPOSITE", F.concat_ws("|", p["home"], p["away"], p["time"])))
        return F.when(p["own"] != "", found("EXPLICIT_MATCH_ID", F.lower(p["own"]))).otherwise(F.coalesce(composite, found("NO_SAFE_IDENTITY", F.lit(""))))

    # sides and times are read only where there is no id; the body names nothing but its argument, so that filters over joins stay whole
    without_id = lambda c: F.when(value_quality(F.col("id")) == 0, c).otherwise("")
    sides = {side: without_id(side_key(f"{side}Team")) for side in ("home", "away")} | {"time": without_id(identity_datetime(F.col("scheduledAt")))}
    return let(F.struct(clean_or_empty(F.col("id")).alias("own"), *[c.alias(n) for n, c in sides.items()]), chosen)


def duplicate_key() -> Column:
    """The validator's key: id, else both team ids and the time as written, else null."""
    low = lambda c: F.lower(strip_or_empty(F.col(c)))
    own, home, away, when = low("id"), low("homeTeam.id"), low("awayTeam.id"), strip_or_empty(F.col("scheduledAt"))
    return F.when(own != "", F.concat(F.lit("id:"), own)).when((home != "") & (away != "") & (when != ""), F.concat_ws("|", F.lit("fixture"), home, away, when))


def value_quality(c: Column) -> Column:
    """1 for a value that says something; 0 for null and blank texts."""
    return F.coalesce(F.when(c.cast("string").rlike("(?U)[^\\s\\x1c-\\x1f]"), 1), F.lit(0))


def with_source(rows: DataFrame, source: Column) -> DataFrame:
    """rows whose provenance names the source that they came from."""
    ids = F.array_sort(F.array_union(F.coalesce(F.col("provenance.sourceIds"), F.array().cast("array<string>")), F.array(source)))
    return rows.withColumn("provenance", F.col("provenance").withField("sourceIds", ids))


def partly(rows: DataFrame, merge_provenance: bool = False) -> DataFrame:
    """What merged() has to know of some of the rows: for each identity the best value of each field with its rank, so parts can be combined in any order and number."""
    safe = F.col("identity.type") != "NO_SAFE_IDENTITY"
    # the places may be told twice, so a row without a safe identity is grouped by all that it holds
    told = rows.withColumn("identity", identity()).withColumn("alone", F.when(~safe, F.struct(*ORDER, *_HELD)))
    # the value of the highest quality, the earliest of equals; null values may win
    best = lambda value, quality: F.min_by(F.struct((-quality).alias("q"), *ORDER, value.alias("v")), F.struct((-quality).alias("q"), *ORDER))
    of = lambda c: best(F.col(c), value_quality(F.col(c)))
    whole = value_quality(F.col("competition.id")) + value_quality(F.col("competition.name"))
    first = lambda c: best(F.col(c), F.lit(0))
    teams = [c for s in _TEAMS for c in (F.max(F.col(s).isNotNull()).alias(s), of(f"{s}.id").alias(f"{s}_id"), of(f"{s}.name").alias(f"{s}_name"))]
    every = [F.array_distinct(F.flatten(F.collect_set("provenance.sourceIds"))).alias("sources")] if merge_provenance else []
    return told.groupBy("identity", "alone").agg(
        of("id").alias("id"), best(F.col("competition"), whole).alias("competition"), *teams, *(of(c).alias(c) for c in ("scheduledAt", "status")),
        *(first(c).alias(c) for c in ("provenance", "score")), F.min(F.struct(*ORDER)).alias("first"), F.count("*").alias("records"), *every,
    )


def combined(parts: DataFrame) -> DataFrame:
    """partly() of all rows, of its results for parts of them."""
    held = [c for c in parts.columns if c not in ("identity", "alone", *_TEAMS, "first", "records", "sources")]
    best = [F.min_by(c, F.struct(f"{c}.q", *(f"{c}.{o}" for o in ORDER))).alias(c) for c in held]
    every = [F.array_distinct(F.flatten(F.collect_set("sources"))).alias("sources")] if "sources" in parts.columns else []
    return parts.groupBy("identity", "alone").agg(*best, *(F.max(s).alias(s) for s in _TEAMS), F.min("first").alias("first"), F.sum("records").alias("records"), *every)


def told(parts: DataFrame) -> DataFrame:
    """merged() of the rows that partly() or combined() was told of."""
    # a team that is an object in no row of the group stays none
    team = lambda s: F.when(F.col(s), F.struct(F.col(f"{s}_id.v").alias("id"), F.col(f"{s}_name.v").alias("name"))).alias(s)
    value = lambda c: F.col(f"{c}.v").alias(c)
    provenance = F.col("provenance.v").withField("sourceIds", F.array_sort("sources")).alias("provenance") if "sources" in parts.columns else value("provenance")
    safe = F.col("alone").isNull()
    section = F.when(safe, 0).otherwise(1).alias("_section")
    # equal rows without a safe identity are as many as they were
    each = F.explode(F.array_repeat(F.when(safe, F.col("records")).otherwise(F.lit(1).cast("long")), F.when(safe, 1).otherwise(F.col("records")).cast("int"))).alias("records")
    return parts.select(value("id"), value("competition"), *map(team, _TEAMS), value("scheduledAt"), value("status"), provenance, value("score"), section, "first._file", "first._rec_ord", each)


def merged(rows: DataFrame, merge_provenance: bool = False) -> DataFrame:
    """One row for each safe identity, then the rows without; section and order columns tell the order, `records` how many were merged.

    A row without a safe identity is a group of its own, so all rows go through one aggregation.
    """
    return told(partly(rows, merge_provenance))


def statistics(rows: DataFrame) -> DataFrame:
    """One row of counters over what merged() gets."""
    told = rows.select(identity().alias("i"))
    safe = F.col("i.type") != "NO_SAFE_IDENTITY"
    groups = told.groupBy("i").agg(F.count("*").alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("input"), F.coalesce(F.sum(F.when(safe, F.col("n"))), F.lit(0)).alias("identified"),
        F.coalesce(F.sum(F.when(~safe, F.col("n"))), F.lit(0)).alias("without_identity"),
        F.coalesce(F.sum(F.when(safe, F.col("n") - 1)), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum(F.when(safe, 1).otherwise(F.col("n"))), F.lit(0)).alias("unique_rows"), F.lit(0).cast("long").alias("collisions"),
    )


def union(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
