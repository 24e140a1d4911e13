"""JSON documents of unknown shape: record discovery and normalisation through alias chains."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean, let, status
from ..functions.timeparse import published_datetime
from .merge import file_key

# Keys that hold collections of records, and aliases in the order in which they are tried.
COLLECTIONS = "matches fixtures events games results".split()
ALIASES = {
    "home": "homeTeam home_team home team1 localTeam",
    "away": "awayTeam away_team away team2 visitorTeam",
    "team_id": "id teamId team_id uid",
    "team_name": "name teamName team club",
    "date": "scheduledAt scheduled_at date datetime dateTime startTime start_time",
    "competition_id": "id competitionId",
    "competition_name": "name competitionName",
    "outer_competition_id": "competitionId competition_id",
    "outer_competition_name": "competitionName league leagueName competition",
    "status": "status state matchStatus",
    "match_id": "id matchId match_id eventId event_id",
    "id_home": "homeTeam team1 home",
    "id_away": "awayTeam team2 away",
    "id_date": "date scheduledAt",
}
_MAP = "map<string,string>"


def kinds_of(json: Column) -> Column:
    """What kind of value each member of a JSON object has."""
    return F.transform_values(F.from_json(json, "map<string,variant>"), lambda _, v: F.schema_of_variant(v))


def given_of(texts: Column, kinds: Column) -> Column:
    """The members that are not null, empty, zero or false, as Python's str() writes scalars."""

    def counts(key: Column, text: Column) -> Column:
        kind = kinds[key]
        nothing = (kind == "VOID") | ((kind == "STRING") & (text == "")) | ((kind == "BOOLEAN") & (text == "false")) | (kind == "OBJECT<>") | (kind.startswith("ARRAY") & F.regexp_replace(text, "\\s", "").isin("[]"))
        number = kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)") & (text.try_cast("double") == 0)
        return F.coalesce(~nothing & ~number, F.lit(False))

    return F.transform_values(F.map_filter(texts, counts), lambda k, v: F.when(kinds[k] == "BOOLEAN", F.initcap(v)).otherwise(v))


class Record(NamedTuple):
    """A JSON object: its members' texts, their kinds, and the members that count as given."""

    texts: Column
    kinds: Column
    given: Column

    def kind(self, key: str) -> Column:
        return self.kinds[key]

    def first(self, chain: str) -> Column:
        """Text of the first given member of a chain; null if none is given."""
        return F.coalesce(*[self.given[k] for k in ALIASES[chain].split()])

    def first_kind(self, chain: str) -> Column:
        return F.coalesce(*[F.when(self.given[k].isNotNull(), self.kinds[k]) for k in ALIASES[chain].split()])


def with_record(rows: DataFrame, json: Column) -> tuple[DataFrame, Record]:
    """rows with the columns of a record: as columns they are read once, however often members are asked for."""
    told = rows.withColumns({"__texts": F.from_json(json, _MAP), "__kinds": kinds_of(json)})
    told = told.withColumn("__given", given_of(F.col("__texts"), F.col("__kinds")))
    return told, Record(F.col("__texts"), F.col("__kinds"), F.col("__given"))


def inner(json: Column, body: Callable[[Record], Column]) -> Column:
    """body of the record in a nested value."""
    read = F.struct(F.from_json(json, _MAP).alias("texts"), kinds_of(json).alias("kinds"))
    return let(read, lambda r: let(given_of(r["texts"], r["kinds"]), lambda g: body(Record(r["texts"], r["kinds"], g))))


def python_text(json: Column) -> Column:
    """How Python writes a nested value, a batch at a time; only ids made of whole objects need it, other rows bring null."""

    @F.arrow_udf("string")
    def written(texts: pa.Array) -> pa.Array:
        import json

        import pyarrow

        def said(text: str) -> str:
            try:
                return str(json.loads(text))
            except (ValueError, RecursionError):  # what Spark reads beyond JSON stays as it is
                return text

        return pyarrow.array([None if t is None else said(t) for t in texts.to_pylist()], pyarrow.string())

    return written(json)


def _objects(array: Column) -> Column:
    """Texts of the elements of a JSON array that are objects; null if it is no array."""
    texts, kinds = F.from_json(array, "array<string>"), F.from_json(array, "array<variant>")
    pairs = F.filter(F.arrays_zip(texts.alias("t"), F.transform(kinds, lambda v: F.schema_of_variant(v)).alias("k")), lambda x: x.k.startswith("OBJECT"))
    return F.when(F.ltrim(array).startswith("["), F.transform(pairs, lambda x: x.t))


def _below(json: Column) -> Column:
    """Records of objects in which no collection stands at the top, at any depth, a batch at a time; other rows bring null."""
    collections = list(COLLECTIONS)

    @F.arrow_udf("array<string>")
    def found(texts: pa.Array) -> pa.Array:
        import json

        import pyarrow

        def records(text: str) -> list[str]:
            try:
                out, todo = [], [json.loads(text)]
            except (ValueError, RecursionError):  # no JSON, or deeper than Python reads: the file gives no records
                return []
            while todo:
                value = todo.pop()
                if isinstance(value, list):
                    lists = [value]
                else:
                    lists = [value[k] for k in collections if isinstance(value.get(k), list)]
                    if not lists:
                        todo += [v for v in reversed(value.values()) if isinstance(v, (dict, list))]
                out += [json.dumps(x, ensure_ascii=False) for part in lists for x in part if isinstance(x, dict)]
            return out

        return pyarrow.array([None if t is None else records(t) for t in texts.to_pylist()], pyarrow.list_(pyarrow.string()))

    return found(json)


def discovered(json: Column) -> Column:
    """Array of the record objects (as JSON texts) of a document, in order; empty if the document is no JSON.

    Lists and objects with a collection are read in the JVM; objects that hold them further down, however deep, in Python.
    """
    none = F.array().cast("array<string>")
    members = F.from_json(json, _MAP)
    standing = [F.when(F.ltrim(members[k]).startswith("["), _objects(members[k])) for k in COLLECTIONS]
    any_list = F.coalesce(*[F.when(a.isNotNull(), F.lit(True)) for a in standing], F.lit(False))
    is_list = F.ltrim(json).startswith("[")
    deeper = _below(F.when(~is_list & members.isNotNull() & ~any_list, json))
    return F.when(is_list, F.coalesce(_objects(json), none)).when(any_list, F.concat(*[F.coalesce(a, none) for a in standing])).otherwise(F.coalesce(deeper, none))


def team(record: Record, side: str) -> Column:
    """Struct id, name of a side of a record."""
    return team_of(record.first(side), record.first_kind(side))


def team_of(value: Column, kind: Column) -> Column:
    """Struct id, name: an object's own id and name, or no id and the value itself."""
    none = F.lit(None).cast("string")
    own = inner(value, lambda r: F.struct(clean(r.first("team_id")).alias("id"), clean(r.first("team_name")).alias("name")))
    return F.when(kind.startswith("OBJECT"), own).otherwise(F.struct(none.alias("id"), clean(value).alias("name")))


def match_id(record: Record, source: Column) -> Column:
    def part(chain: str, default: str) -> Column:
        value, kind = record.first(chain), record.first_kind(chain)
        nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
        return F.coalesce(python_text(F.when(nested, value)), value, F.lit(default))

    own = clean(record.first("match_id"))
    made = F.concat_ws(":", source, part("id_date", "unknown-date"), part("id_home", "unknown-home"), part("id_away", "unknown-away"))
    return F.when(own.isNotNull(), F.concat_ws(":", source, own)).otherwise(made)


def normalized(records: DataFrame) -> DataFrame:
    """Match rows of records (source_id, json, _file, _rec_ord); records without both names and a date are dropped."""
    told, r = with_record(records, F.col("json"))
    is_object = F.coalesce(r.kind("competition").startswith("OBJECT"), F.lit(False))
    pair = lambda r, i, n: F.struct(clean(r.first(i)).alias("id"), clean(r.first(n)).alias("name"))
    league = F.when(is_object, inner(r.texts["competition"], lambda own: pair(own, "competition_id", "competition_name"))).otherwise(pair(r, "outer_competition_id", "outer_competition_name"))
    sides = {f"__{s}": team(r, s) for s in ("home", "away")}
    made = told.withColumns(sides).select(
        match_id(r, F.col("source_id")).alias("id"), league.alias("competition"), F.col("__home").alias("homeTeam"), F.col("__away").alias("awayTeam"), published_datetime(r.first("date")).alias("scheduledAt"), status(r.first("status")).alias("status"),
        F.struct(F.col("source_id").alias("sourceId"), F.lit("json").alias("format"), F.lit(None).cast("string").alias("sourceFile"), F.lit(None).cast("int").alias("sourceLine"), F.lit(None).cast("array<string>").alias("sourceIds")).alias("provenance"),
        F.lit(None).cast("struct<home:int,away:int>").alias("score"), "_file", "_rec_ord",
    )
    # a filter would be pushed below all that it names, which would then be found again for each mention; a list of one or none is not
    whole = lambda m: m["homeTeam"]["name"].isNotNull() & m["awayTeam"]["name"].isNotNull() & m["scheduledAt"].isNotNull()
    return made.select(F.inline(F.filter(F.array(F.struct(*made.columns)), whole)))


def json_matches(files: DataFrame) -> DataFrame:
    """Match rows of JSON files (path, source_id, text); files that are no JSON give none."""
    records = files.select("source_id", file_key(F.col("path")).alias("_file"), F.posexplode(discovered(F.col("text"))).alias("at", "json"))
    return normalized(records.select("source_id", "json", "_file", F.col("at").cast("long").alias("_rec_ord")))
