"""Schemas compiled to columns: each word, nested paths, order, texts that aren't JSON."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.errors import ConfigError
from tidemark.plans import schemas

TASK = {
    "type": "object", "required": ["name", "meta", "plugin"], "additionalProperties": False,
    "properties": {
        "name": {"type": "string", "minLength": 2, "maxLength": 5, "pattern": "^[a-z]+$"},
        "meta": {"type": "object", "required": ["back"], "properties": {"back": {"type": "integer", "minimum": 1, "maximum": 100}, "share": {"type": ["number", "null"]}}},
        "plugin": {"enum": ["storm", "dust", 3, True]},
        "inputs": {"type": "array", "minItems": 1, "maxItems": 3, "items": {"type": "object", "required": ["dir"], "properties": {"dir": {"type": "string"}, "odd key": {"type": "boolean"}}}},
    },
}
GOOD = {"name": "abc", "meta": {"back": 5, "share": None}, "plugin": "storm", "inputs": [{"dir": "x", "odd key": True}]}
CASES = [
    (json.dumps(GOOD), []),
    (json.dumps(GOOD | {"plugin": 3, "meta": {"back": 100, "share": 1.5}}), []),
    (json.dumps(GOOD | {"plugin": True}), []),
    ("{}", ["$: 'name' is a required property", "$: 'meta' is a required property", "$: 'plugin' is a required property"]),
    (json.dumps(GOOD | {"name": 4, "zzz": 1, "aaa": 2}), ["$: 'aaa' is not expected", "$: 'zzz' is not expected", "$.name: not of type string"]),
    (json.dumps(GOOD | {"name": "A"}), ["$.name: shorter than 2", "$.name: doesn't match ^[a-z]+$"]),
    (json.dumps(GOOD | {"name": "abcdefg"}), ["$.name: longer than 5"]),
    (json.dumps(GOOD | {"meta": {}}), ["$.meta: 'back' is a required property"]),
    (json.dumps(GOOD | {"meta": {"back": 101}}), ["$.meta.back: more than 100"]),
    (json.dumps(GOOD | {"meta": {"back": 0}}), ["$.meta.back: less than 1"]),
    (json.dumps(GOOD | {"meta": {"back": 1.5, "share": "x"}}), ["$.meta.back: not of type integer", "$.meta.share: not of type number or null"]),
    (json.dumps(GOOD | {"meta": [1]}), ["$.meta: not of type object"]),
    (json.dumps(GOOD | {"plugin": "rain"}), ["$.plugin: none of storm, dust, 3, true"]),
    (json.dumps(GOOD | {"plugin": None}), ["$.plugin: none of storm, dust, 3, true"]),
    (json.dumps(GOOD | {"inputs": []}), ["$.inputs: fewer items than 1"]),
    (json.dumps(GOOD | {"inputs": [{"dir": "x"}, {"dir": 1, "odd key": "no"}, 7, {}]}), [
        "$.inputs: more items than 3", "$.inputs[1].dir: not of type string", "$.inputs[1].odd key: not of type boolean", "$.inputs[2]: not of type object", "$.inputs[3]: 'dir' is a required property",
    ]),
    ("[1]", ["$: not of type object"]), ("null", ["$: not of type object"]), ("{", ["$: not JSON"]), ("", ["$: not JSON"]), (None, ["$: missing"]),
]


def test_errors_with_paths_in_order(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, text string")
    got = {r.i: r.e for r in df.select("i", schemas.schema_errors(F.col("text"), TASK).alias("e")).collect()}
    for i, (text, want) in enumerate(CASES):
        assert got[i] == want, text
    good, bad = schemas.split_by_schema(df, "text", TASK)
    assert good.count() == 3 and good.columns == ["i", "text"]
    assert bad.count() == len(CASES) - 3


def test_schemas_that_cannot_be_compiled():
    for schema, what in (({"oneOf": []}, "oneOf"), ({"type": "date"}, "date"), ({"properties": {"a'b": {}}}, "quotes")):
        with pytest.raises(ConfigError, match=what):
            schemas.schema_errors(F.lit("{}"), schema)


def test_no_schema_accepts_all_json(spark):
    df = spark.createDataFrame([("1",), ("[]",), ("x",)], "t string")
    assert sorted(len(r.e) for r in df.select(schemas.schema_errors(F.col("t"), {}).alias("e")).collect()) == [0, 0, 1]
