"""JSON Schema documents as Column expressions over values of any shape.

A schema is compiled once into expressions over a VARIANT column, so a table is checked in one pass of the JVM, without a shuffle and without a row in
Python.  Each fault is (path, keyword), in the order of the schema.  Keywords: $ref within the document, type, required, properties, additionalProperties, items, enum, const,
minLength, maxLength, pattern, minimum, maximum, exclusiveMinimum, exclusiveMaximum, minItems, maxItems, uniqueItems, minProperties, maxProperties, allOf, anyOf, oneOf, not, if/then/else.
Annotations (among them format) say nothing about a value.  Any other keyword, and a schema that contains itself, is an error when it is compiled: nothing is passed over in silence.

As in the standard a keyword speaks about values of its own type only, a number without a fraction is an integer, and 1 equals 1.0.
A value that is null in SQL is absent and has no fault; JSON null is a value.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import let

FAULTS = "array<struct<path:string,keyword:string>>"
# Keywords that check nothing.
ANNOTATIONS = frozenset("$schema $id $comment $defs definitions title description default examples format deprecated readOnly writeOnly".split())
_NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT")
_KINDS = {"object": ("OBJECT",), "array": ("ARRAY",), "string": ("STRING",), "boolean": ("BOOLEAN",), "null": ("VOID",), "number": _NUMBERS}
#: What each keyword but the combining ones speaks about.
_ABOUT = {
    "required": "object", "properties": "object", "additionalProperties": "object", "minProperties": "object", "maxProperties": "object",
    "items": "array", "minItems": "array", "maxItems": "array", "uniqueItems": "array", "minLength": "string", "maxLength": "string", "pattern": "string",
    "minimum": "number", "maximum": "number", "exclusiveMinimum": "number", "exclusiveMaximum": "number",
}
_COMBINED = frozenset("$ref type enum const allOf anyOf oneOf not if then else".split())


class SchemaError(ValueError):
    """A schema that cannot be compiled."""


def _kind(v: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _as(v: Column, kind: str) -> Column:
    return F.try_variant_get(v, "$", kind)


def _member(v: Column, name: str) -> Column:
    """The member of an object; null where there is none."""
    for quote in "'\"":
        if name and quote not in name and "?" not in name:
            return F.try_variant_get(v, f"$[{quote}{name}{quote}]", "variant")
    return _as(v, "map<string,variant>")[name]


def canonical(v: Column) -> Column:
    """A text that equal values share: members of objects are sorted, and numbers lose what does not change them."""
    number = _as(v, "double")
    return F.when(_kind(v).isin(*_NUMBERS), number.cast("string")).otherwise(F.to_json(v))


def _join(path: Column | None, name: Column) -> Column:
    return name if path is None else F.concat(path, F.lit("."), name)


class Schema:
    """A schema document."""

    def __init__(self, document: dict):
        if not isinstance(document, (dict, bool)):
            raise SchemaError("a schema has to be an object")
        self.document = document

    def resolve(self, pointer: str) -> dict | bool:
        """The part of the document at a pointer like #/$defs/name."""
        if not pointer.startswith("#"):
            raise SchemaError(f"{pointer} is not within the document")
        part = self.document
        for step in filter(None, pointer[1:].split("/")):
            step = step.replace("~1", "/").replace("~0", "~")
            if not isinstance(part, dict) or step not in part:
                raise SchemaError(f"{pointer} is nowhere in the document")
            part = part[step]
        return part

    def faults(self, value: Column, pointer: str = "#", path: Column | None = None) -> Column:
        """FAULTS of a VARIANT column under the part of the document at pointer."""
        return self._value(self.resolve(pointer), value, path, (pointer,))

    def _value(self, schema: dict | bool, value: Column, path: Column | None, seen: tuple[str, ...]) -> Column:
        """Faults of a value that is found, with its kind, once, however many keywords speak about it."""
        whole = lambda v: let(F.struct(v.alias("v"), _kind(v).alias("kind")), lambda x: self._whole(schema, x["v"], x["kind"], path, seen))
        return let(value, lambda v: F.when(v.isNotNull(), whole(v)).otherwise(F.array().cast(FAULTS)))

    def _whole(self, schema: dict | bool, v: Column, kind: Column, path: Column | None, seen: tuple[str, ...]) -> Column:
        parts = self._parts(schema, v, kind, path, seen)
        return F.flatten(F.array(*parts)) if len(parts) > 1 else parts[0] if parts else F.array().cast(FAULTS)

    def _parts(self, schema: dict | bool, v: Column, kind: Column, path: Column | None, seen: tuple[str, ...]) -> list[Column]:
        at = F.lit("") if path is None else path
        say = lambda bad, keyword, where=None: F.when(F.coalesce(bad, F.lit(False)), F.struct((at if where is None else where).alias("path"), F.lit(keyword).alias("keyword")))
        if isinstance(schema, bool):
            return [] if schema else [F.array(say(F.lit(True), "false")).cast(FAULTS)]
        if not isinstance(schema, dict):
            raise SchemaError(f"{schema!r} is no schema")
        if odd := [k for k in schema if k not in _ABOUT and k not in _COMBINED and k not in ANNOTATIONS]:
            raise SchemaError(f"unknown keyword {odd[0]}")
        simple: list[Column] = []
        nested: list[Column] = []
        valid = lambda s: F.size(self._whole(s, v, kind, path, seen)) == 0
        for keyword, told in schema.items():
            about = kind.isin(*_KINDS[_ABOUT[keyword]]) if keyword in _ABOUT else None
            if keyword == "$ref":
                if told in seen:
                    raise SchemaError(f"{told} contains itself")
                nested += self._parts(self.resolve(told), v, kind, path, (*seen, told))
            elif keyword == "type":
                simple.append(say(~reduce(Column.__or__, [self._is(v, kind, t) for t in ([told] if isinstance(told, str) else told)]), keyword))
            elif keyword in ("enum", "const"):
                simple.append(say(~reduce(Column.__or__, [self._equals(v, kind, t) for t in (told if keyword == "enum" else [told])]), keyword))
            elif keyword == "required":
                simple += [say(about & _member(v, name).isNull(), keyword, _join(path, F.lit(name))) for name in told]
            elif keyword == "properties":
                nested += [self._value(sub, _member(v, name), _join(path, F.lit(name)), seen) for name, sub in told.items()]
            elif keyword == "additionalProperties":
                nested += self._additional(schema, told, v, path, seen)
            elif keyword == "items":
                each = F.transform(_as(v, "array<variant>"), lambda x, i: self._value(told, x, F.concat(at, F.lit("["), i, F.lit("]")), seen))
                nested.append(F.when(about, F.flatten(each)).otherwise(F.array().cast(FAULTS)))
            elif keyword == "uniqueItems":
                texts = F.transform(_as(v, "array<variant>"), canonical)
                simple.append(say(about & (F.size(F.array_distinct(texts)) < F.size(texts)) if told else F.lit(False), keyword))
            elif keyword in ("minItems", "maxItems", "minLength", "maxLength", "minProperties", "maxProperties"):
                size = {"array": lambda: F.size(_as(v, "array<variant>")), "string": lambda: F.char_length(_as(v, "string")), "object": lambda: F.size(_as(v, "map<string,variant>"))}[_ABOUT[keyword]]()
                simple.append(say(about & ((size < told) if keyword.startswith("min") else (size > told)), keyword))
            elif keyword == "pattern":
                simple.append(say(about & ~_as(v, "string").rlike(told), keyword))
            elif keyword in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"):
                number = _as(v, "double")
                simple.append(say(about & {"minimum": number < told, "maximum": number > told, "exclusiveMinimum": number <= told, "exclusiveMaximum": number >= told}[keyword], keyword))
            elif keyword == "allOf":
                nested += [self._whole(s, v, kind, path, seen) for s in told]
            elif keyword in ("anyOf", "oneOf"):
                holds = reduce(Column.__add__, [valid(s).cast("int") for s in told])
                simple.append(say(holds == 0 if keyword == "anyOf" else holds != 1, keyword))
            elif keyword == "not":
                simple.append(say(valid(told), keyword))
            elif keyword == "if":
                then, other = (self._whole(schema.get(k, True), v, kind, path, seen) for k in ("then", "else"))
                nested.append(F.when(valid(told), then).otherwise(other))
        own = [F.array_compact(F.array(*simple)).cast(FAULTS)] if simple else []
        return own + nested

    @staticmethod
    def _is(v: Column, kind: Column, name: str) -> Column:
        if name == "integer":
            number = _as(v, "double")
            return kind.isin(*_NUMBERS) & (number == F.floor(number))
        if name not in _KINDS:
            raise SchemaError(f"unknown type {name}")
        return kind.isin(*_KINDS[name])

    @staticmethod
    def _equals(v: Column, kind: Column, told: object) -> Column:
        if isinstance(told, str):
            return (kind == "STRING") & (_as(v, "string") == told)
        if told is None:
            return kind == "VOID"
        if isinstance(told, bool):
            return (kind == "BOOLEAN") & (_as(v, "boolean") == told)
        if isinstance(told, (int, float)):
            return kind.isin(*_NUMBERS) & (_as(v, "double") == float(told))
        return canonical(v) == canonical(F.parse_json(F.lit(json.dumps(told))))

    def _additional(self, schema: dict, told: dict | bool, v: Column, path: Column | None, seen: tuple[str, ...]) -> list[Column]:
        if told is True:
            return []
        known = list(schema.get("properties", ()))
        more = _as(v, "map<string,variant>")
        more = F.map_filter(more, lambda k, _: ~k.isin(*known)) if known else more
        none = F.array().cast(FAULTS)
        if told is False:
            named = F.transform(F.array_sort(F.map_keys(more)), lambda k: F.struct(_join(path, k).alias("path"), F.lit("additionalProperties").alias("keyword")))
            return [F.coalesce(named.cast(FAULTS), none)]
        each = F.transform(F.map_entries(more), lambda e: self._value(told, e["value"], _join(path, e["key"]), seen))
        return [F.coalesce(F.flatten(each), none)]


def check(rows: DataFrame, text: str, schema: Schema, pointer: str = "#") -> DataFrame:
    """rows with FAULTS of the JSON texts in a column, as `faults`; what is no JSON has the one fault (``, `json`).  A null text has none."""
    parsed = rows.withColumn("faults", F.try_parse_json(text))
    wrong = F.array(F.struct(F.lit("").alias("path"), F.lit("json").alias("keyword"))).cast(FAULTS)
    return parsed.withColumn("faults", F.when(F.col("faults").isNull() & F.col(text).isNotNull(), wrong).otherwise(schema.faults(F.col("faults"), pointer)))


def each_fault(checked: DataFrame, *keep: str) -> DataFrame:
    """(keep, path, keyword): a row for each fault of what check() gives."""
    # faults as such would also be filtered by their number before they are told, and so be found anew for each filter
    return checked.select(*keep, F.inline(F.flatten(F.array("faults"))))


def document_faults(spark: SparkSession, document: object, schema: Schema) -> list[tuple[str, str]]:
    """Faults of one document that the driver holds."""
    row = check(spark.createDataFrame([(json.dumps(document, ensure_ascii=False),)], "text string"), "text", schema).first()
    return [(f["path"], f["keyword"]) for f in row["faults"]]


# The schema of the published document.
def _closed(required: str, properties: dict) -> dict:
    return {"type": "object", "additionalProperties": False, "required": required.split(), "properties": properties}


_TEXT, _TIME, _MAYBE = {"type": "string", "minLength": 1}, {"type": "string", "format": "date-time"}, {"type": ["string", "null"]}
_IDS = {"type": "array", "uniqueItems": True, "items": _TEXT}
_COUNT = {"type": "integer", "minimum": 0}
_NAMED = _closed("id name", {"id": _MAYBE, "name": _MAYBE})
_STATUSES = "SCHEDULED LIVE FINISHED POSTPONED CANCELLED SUSPENDED UNKNOWN".split()
_none_at_zero = lambda count, listed: {"if": {"properties": {count: {"const": 0}}}, "then": {"properties": {listed: {"maxItems": 0}}}}
PUBLISHED = _closed(
    "schemaVersion generatedAt pipeline sourceCount sourceIds matchCount datasetHash matches",
    {
        "schemaVersion": {"type": "string", "const": "1.0"}, "generatedAt": _TIME, "pipeline": {"$ref": "#/$defs/pipeline"}, "sourceCount": _COUNT, "sourceIds": _IDS, "matchCount": _COUNT,
        "datasetHash": {"type": "string", "pattern": "^[a-fA-F0-9]{64}$"}, "matches": {"type": "array", "items": {"$ref": "#/$defs/match"}},
    },
) | {
    "allOf": [_none_at_zero("sourceCount", "sourceIds"), _none_at_zero("matchCount", "matches")],
    "$defs": {
        "pipeline": _closed("stage validationStatus publicationAllowed", {"stage": {"type": "string", "const": "BUILD_MATCHES"}, "validationStatus": {"type": "string", "const": "PASS"}, "publicationAllowed": {"type": "boolean", "const": True}}),
        "competition": _NAMED, "team": _NAMED, "provenance": _closed("sourceIds", {"sourceIds": _IDS}),
        "match": _closed("id competition homeTeam awayTeam scheduledAt status", {
            "id": _TEXT, "competition": {"$ref": "#/$defs/competition"}, "homeTeam": {"$ref": "#/$defs/team"}, "awayTeam": {"$ref": "#/$defs/team"},
            "scheduledAt": _TIME, "status": {"type": "string", "enum": _STATUSES}, "provenance": {"$ref": "#/$defs/provenance"},
        }),
    },
}
MATCH = "#/$defs/match"


def published_row(source_ids: Column) -> Column:
    """The JSON text of a row of matches as it would be published."""
    ids = F.coalesce(source_ids, F.array().cast("array<string>"))
    members = [F.col(c) for c in ("id", "competition", "homeTeam", "awayTeam", "scheduledAt", "status")]
    return F.to_json(F.struct(*members, F.struct(ids.alias("sourceIds")).alias("provenance")), {"ignoreNullFields": "false"})
