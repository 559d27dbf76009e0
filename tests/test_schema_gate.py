import json

import pytest
from pyspark.sql import functions as F

from quire.operators import schema_gate as G
from tests.conftest import frame

SCHEMA = {
    "$schema": "x",
    "type": "object",
    "required": ["version", "id"],
    "properties": {
        "version": {"type": "string", "pattern": r"^[0-9]+\.[0-9]+$"},
        "id": {"type": "string", "minLength": 2, "format": "uri"},
        "kind": {"enum": ["a", "b", 3, None]},
        "count": {"type": "integer", "minimum": 0, "maximum": 10},
        "share": {"type": ["number", "null"], "exclusiveMaximum": 1},
        "lines": {"type": "array", "items": {"type": "object", "required": ["n"], "properties": {"n": {"$ref": "#/$defs/page"}, "box": {"$ref": "#/$defs/box"}}, "additionalProperties": False}},
        "entity": {"oneOf": [{"$ref": "#/$defs/page"}, {"type": "null"}]},
        "tags": {"type": "array", "uniqueItems": True, "maxItems": 3},
        "map": {"type": "object", "additionalProperties": {"type": "integer"}, "minProperties": 1},
        "mixed": {"anyOf": [{"type": "string"}, {"type": "object", "required": ["x"]}], "not": {"const": "no"}},
    },
    "$defs": {"page": {"type": "integer", "minimum": 1}, "box": {"type": "array", "items": {"type": "number"}, "minItems": 4, "maxItems": 4}},
}
GOOD = {"version": "1.0", "id": "ab"}


def broken(spark, *records):
    df = frame(spark, [(i, r if isinstance(r, str) or r is None else json.dumps(r)) for i, r in enumerate(records)], "doc_id int, record string")
    return [sorted(r[0]) for r in df.orderBy("doc_id").select(G.schema_violations(SCHEMA, F.try_parse_json("record"))).collect()]


def test_one_record_for_each_rule(spark):
    cases = [
        (GOOD, []), (None, ["$:null"]), ("{", ["$:null"]), ("[]", ["$:type"]), ({"id": "ab"}, ["$.version:required"]), (GOOD | {"version": "1"}, ["$.version:pattern"]), (GOOD | {"version": 1.0}, ["$.version:type"]), (GOOD | {"id": "a"}, ["$.id:minLength"]),
        (GOOD | {"kind": "b"}, []), (GOOD | {"kind": 3}, []), (GOOD | {"kind": None}, []), (GOOD | {"kind": "3"}, ["$.kind:enum"]), (GOOD | {"count": 10.0}, []), (GOOD | {"count": 2.5}, ["$.count:type"]), (GOOD | {"count": -1}, ["$.count:minimum"]), (GOOD | {"count": 11}, ["$.count:maximum"]),
        (GOOD | {"count": "1"}, ["$.count:type"]), (GOOD | {"count": None}, ["$.count:type"]), (GOOD | {"share": None}, []), (GOOD | {"share": 1}, ["$.share:exclusiveMaximum"]), (GOOD | {"share": True}, ["$.share:type"]),
        (GOOD | {"lines": [{"n": 1}, {"n": 0, "box": [1, 2, "x"]}, {"m": 1}, 7]}, sorted(["$.lines[1].n:minimum", "$.lines[1].box:minItems", "$.lines[1].box[2]:type", "$.lines[2].n:required", "$.lines[2].m:additionalProperties", "$.lines[3]:type"])),
        (GOOD | {"lines": {}}, ["$.lines:type"]), (GOOD | {"lines": []}, []), (GOOD | {"entity": None}, []), (GOOD | {"entity": 2}, []), (GOOD | {"entity": 0}, ["$.entity:oneOf"]), (GOOD | {"tags": [1, "1", 1]}, ["$.tags:uniqueItems"]), (GOOD | {"tags": [1, 2, 3, 4]}, ["$.tags:maxItems"]),
        (GOOD | {"map": {"a": 1, "b c.d": "x"}}, ["$.map.b c.d:type"]), (GOOD | {"map": {}}, ["$.map:minProperties"]), (GOOD | {"mixed": "yes"}, []), (GOOD | {"mixed": "no"}, ["$.mixed:not"]), (GOOD | {"mixed": {"y": 1}}, ["$.mixed:anyOf"]), (GOOD | {"unknown": [1]}, []),
    ]
    got = broken(spark, *(r for r, _ in cases))
    assert got == [want for _, want in cases]


def test_own_violations_refuse_and_inherited_ones_warn(spark):
    bad, worse = GOOD | {"count": -1}, GOOD | {"count": -1, "id": "x"}
    own = frame(spark, [(1, json.dumps(GOOD), "k"), (2, json.dumps(bad), "k"), (3, json.dumps(worse), "k"), (4, json.dumps(GOOD), "k")], "doc_id int, record string, more string")
    base = frame(spark, [(2, json.dumps(GOOD)), (3, json.dumps(bad)), (4, json.dumps(bad)), (9, json.dumps(bad))], "doc_id int, record string")
    kept, complaints = G.gate(own, SCHEMA, base)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4] and kept.columns == own.columns
    assert sorted(map(tuple, complaints.collect())) == [(2, "refuse", "own", "$.count:minimum"), (3, "warn", "inherited", "$.count:minimum"), (3, "warn", "own", "$.count:minimum"), (3, "warn", "own", "$.id:minLength"), (4, "warn", "inherited", "$.count:minimum")]
    with pytest.raises(ValueError, match="2: \\$.count:minimum"):
        G.raise_if_refused(complaints)
    kept, complaints = G.gate(own, json.dumps(SCHEMA))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4] and complaints.where("severity = 'warn'").isEmpty()


@pytest.mark.parametrize("schema", [{"if": {}}, {"properties": {"a": {"patternProperties": {}}}}, {"$ref": "other.json"}, {"$ref": "#"}])
def test_what_cannot_be_checked_is_an_error(spark, schema):
    with pytest.raises(ValueError):
        G.schema_violations(schema, F.parse_json(F.lit("1")))


def test_a_value_is_computed_once_for_all_its_rules(spark):
    broken = G.schema_violations(SCHEMA, F.try_parse_json("record")).alias("v")
    plan = frame(spark, [("{}",)], "record string").select(broken)._jdf.queryExecution().analyzed().toString()
    assert plan.count("parse_json") == 1
