import json
import random
import re

import pytest

from pitchline.operators import schema
from pitchline.plans.stage_queries import _SHAPE

NUMBER = (int, float)
KIND = {"object": dict, "array": list, "string": str, "number": NUMBER}


def is_kind(x, name):
    if name == "null":
        return x is None
    if name == "boolean":
        return isinstance(x, bool)
    if isinstance(x, bool):
        return False
    if name == "integer":
        return isinstance(x, NUMBER) and float(x).is_integer()
    return isinstance(x, KIND[name])


def key(x):
    """Equal values have equal keys."""
    if isinstance(x, dict):
        return ("o", tuple(sorted((k, key(v)) for k, v in x.items())))
    if isinstance(x, list):
        return ("a", tuple(map(key, x)))
    return (type(x).__name__ if isinstance(x, bool) or x is None or isinstance(x, str) else "n", x)


def brute(s, x, path, root):
    """Faults of a Python value, by the standard's words."""
    out = []
    if s is True:
        return out
    if s is False:
        return [(path, "false")]
    to = lambda name: f"{path}.{name}" if path else name
    ok = lambda sub: not brute(sub, x, path, root)
    for k, v in s.items():
        if k == "$ref":
            part = root
            for step in v[2:].split("/"):
                part = part[step]
            out += brute(part, x, path, root)
        if k == "type" and not any(is_kind(x, t) for t in ([v] if isinstance(v, str) else v)):
            out.append((path, k))
        if k == "enum" and key(x) not in map(key, v) or k == "const" and key(x) != key(v):
            out.append((path, k))
        if isinstance(x, dict):
            if k == "required":
                out += [(to(n), k) for n in v if n not in x]
            if k == "properties":
                out += [f for n, sub in v.items() if n in x for f in brute(sub, x[n], to(n), root)]
            if k == "additionalProperties":
                for n in sorted(set(x) - set(s.get("properties", ()))):
                    out += [(to(n), k)] if v is False else brute(v, x[n], to(n), root)
            out += [(path, k)] * (k == "minProperties" and len(x) < v or k == "maxProperties" and len(x) > v)
        if isinstance(x, list):
            if k == "items":
                out += [f for i, e in enumerate(x) for f in brute(v, e, f"{path}[{i}]", root)]
            out += [(path, k)] * (k == "minItems" and len(x) < v or k == "maxItems" and len(x) > v or k == "uniqueItems" and v and len(set(map(key, x))) < len(x))
        if isinstance(x, str):
            out += [(path, k)] * (k == "minLength" and len(x) < v or k == "maxLength" and len(x) > v or k == "pattern" and not re.search(v, x))
        if isinstance(x, NUMBER) and not isinstance(x, bool):
            out += [(path, k)] * (k == "minimum" and x < v or k == "maximum" and x > v or k == "exclusiveMinimum" and x <= v or k == "exclusiveMaximum" and x >= v)
        if k == "allOf":
            out += [f for sub in v for f in brute(sub, x, path, root)]
        out += [(path, k)] * (k == "anyOf" and not any(map(ok, v)) or k == "oneOf" and sum(map(ok, v)) != 1 or k == "not" and ok(v))
        if k == "if":
            out += brute(s.get("then" if ok(v) else "else", True), x, path, root)
    return out


LEAVES = [None, True, False, 0, 1, -1, 7, 2.5, 3.0, 12345678901, "", "a", "AB1", "é€", "LIVE", "home", [], {}, [1, 1.0], ["a", "b", "a"], {"id": 1}, {"a": [1, True]}, {"name": None}]
SCHEMAS = [
    _SHAPE,
    {"oneOf": [{"type": "number"}, {"type": "integer"}, {"type": "string", "minLength": 2}]},
    {"not": {"type": ["array", "object"], "maxItems": 1}, "minProperties": 1},
    {"type": "object", "additionalProperties": {"type": "array", "items": {"exclusiveMinimum": 0, "exclusiveMaximum": 7}}, "maxProperties": 2},
    {"if": {"type": "string"}, "then": {"maxLength": 2}, "else": {"enum": [1, None, [], {"a": [1.0, True]}]}},
    {"items": {"items": False}, "properties": {"it's \"odd\"?": {"const": 1}, "": {"const": 2}, "a.b": {"minimum": 1, "maximum": 3}}, "minItems": 1},
]


def values(rng):
    def value(depth):
        if depth == 0 or rng.random() < 0.3:
            return rng.choice(LEAVES)
        if rng.random() < 0.4:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        names = ["id", "team", "status", "when", "n", "ids", "code", "odd name", "side", "free", "more", "it's \"odd\"?", "", "a.b"]
        return {n: value(depth - 1) for n in rng.sample(names, rng.randrange(6))}

    return LEAVES + [value(3) for _ in range(300)]


@pytest.mark.parametrize("number", range(len(SCHEMAS)))
def test_faults_equal_those_of_values_one_by_one(spark, number):
    told, made = SCHEMAS[number], values(random.Random(number))
    rows = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(made)], "i int, text string")
    got = {r.i: sorted((f.path, f.keyword) for f in r.faults) for r in schema.check(rows, "text", schema.Schema(told)).collect()}
    for i, v in enumerate(made):
        assert got[i] == sorted(brute(told, v, "", told)), v


def test_texts_that_are_no_json_and_nulls(spark):
    rows = spark.createDataFrame([("{",), (None,), ("",), ("5",)], "text string")
    got = [[(f.path, f.keyword) for f in r.faults] for r in schema.check(rows, "text", schema.Schema({"type": "object"})).collect()]
    assert got == [[("", "json")], [], [("", "json")], [("", "type")]]


@pytest.mark.parametrize("bad", [{"kind": 1}, {"$ref": "#/$defs/a"}, {"$ref": "other.json"}, {"$defs": {"a": {"items": {"$ref": "#/$defs/a"}}}, "$ref": "#/$defs/a"}, {"type": "text"}, {"items": 5}])
def test_schemas_that_cannot_be_compiled(spark, bad):
    with pytest.raises(schema.SchemaError):
        schema.check(spark.createDataFrame([("1",)], "text string"), "text", schema.Schema(bad))


def test_values_are_read_once_and_faults_found_once(spark):
    rows = spark.createDataFrame([(1, "{}")], "i int, text string")
    inner = {"type": "object", "required": ["a"], "properties": {"a": {"type": "string", "minLength": 1}}}
    deep = {"type": "object", "properties": {"b": {"type": "object", "properties": {"c": inner}}}}
    plan = schema.each_fault(schema.check(rows, "text", schema.Schema(deep)), "i")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("schemaofvariant(") == 4, plan
    assert "Filter" not in plan
