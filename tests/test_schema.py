"""Schemas compiled to checks on variants."""

import copy
import json

import pytest

from grovekit.fixed import RECORD_SCHEMA
from grovekit.functions.schema import violations
from grovekit.operators import records as OR

GOOD = {
    "language": "go", "success": True,
    "metadata": {"lines": 1, "avg_line_length": 2.5, "nodes": 2, "errors": 0, "source_hash": "ab"},
    "ast": {"root": "program", "nodes": [
        {"id": 0, "type": "program", "text": "x", "parent": None, "children": [1], "start_point": {"row": 0, "column": 0}},
        {"id": 1, "type": "word", "text": "", "parent": 0, "children": []}]},
    "extra": {"any": [1, "two"]},
}


def found(spark, rows, schema):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "at int, json string")
    got = df.select("at", violations("json", schema).alias("v")).orderBy("at").collect()
    return [[(v.path, v.rule) for v in r.v] for r in got]


def changed(path, value=None, drop=False):
    record = copy.deepcopy(GOOD)
    place = record
    for step in path[:-1]:
        place = place[step]
    if drop:
        del place[path[-1]]
    else:
        place[path[-1]] = value
    return json.dumps(record)


def shown(path):
    return "$" + "".join(f"[{p}]" if isinstance(p, int) else f".{p}" for p in path)


def schema_rules(schema, value, path=()):
    """One fault for each required, type and enum rule that the value meets."""
    if "type" in schema and path:
        wrong = 1.5 if schema["type"] != "number" else "1.5"
        yield path, dict(value=wrong), {(shown(path), "type")} | ({(shown(path), "enum")} if "enum" in schema else set())
    if "enum" in schema:
        yield path, dict(value="no such value"), {(shown(path), "enum")}
    if isinstance(value, dict):
        for name in schema.get("required", ()):
            yield (*path, name), dict(drop=True), {(shown((*path, name)), "required")}
        for name, rules in schema.get("properties", {}).items():
            if name in value:
                yield from schema_rules(rules, value[name], (*path, name))
    if isinstance(value, list):
        for i, item in enumerate(value):
            yield from schema_rules(schema["items"], item, (*path, i))


def test_one_fault_per_rule_of_the_record_schema(spark):
    cases = list(schema_rules(RECORD_SCHEMA, GOOD))
    assert len(cases) > 35
    got = found(spark, [json.dumps(GOOD)] + [changed(p, **how) for p, how, _ in cases], RECORD_SCHEMA)
    assert got[0] == []
    for (path, how, want), have in zip(cases, got[1:]):
        assert set(have) == want and len(have) == len(want), (path, how)


def test_texts_that_are_no_records(spark):
    rows = [None, "", "{", "[]", "1", "null", '{"language": "go", "language": "c"}']
    got = found(spark, rows, RECORD_SCHEMA)
    assert got == [[("$", "json")]] * 3 + [[("$", "type")]] * 3 + [[("$", "json")]]


@pytest.mark.parametrize("schema, good, bad", [
    ({"type": "integer"}, ["1", "1.0", "1e3", "-12345678901234567890", "0"], ["1.5", '"1"', "true", "null", "[1]", "12345678901234567.5"]),
    ({"type": "number"}, ["1", "1.5", "2e9"], ['"1"', "false", "{}"]),
    ({"type": ["integer", "null"]}, ["null", "3"], ['"x"', "{}"]),
    ({"type": "boolean"}, ["true", "false"], ["0", '"true"']),
    ({"enum": [1, "1", None, [1, 2], {"b": 1, "a": 2}]}, ["1", "1.0", '"1"', "null", "[1, 2]", '{"a":2,"b":1}'], ["2", '"2"', "[2,1]", "true"]),
    ({"enum": []}, [], ["1"]),
    ({"const": True}, ["true"], ["1", '"true"']),
    ({"const": 9007199254740993}, ["9007199254740993"], ["9007199254740992"]),
    ({"minimum": 2, "maximum": 4}, ["2", "4", '"9"'], ["1.9", "5"]),
    ({"exclusiveMinimum": 2}, ["2.1"], ["2"]), ({"exclusiveMaximum": 2}, ["1.9"], ["2"]),
    ({"minLength": 2}, ['"ab"', "1"], ['"a"', '""']), ({"maxLength": 1}, ['"é"', "[1,2]"], ['"ab"']),
    ({"pattern": "^a"}, ['"ab"', "1"], ['"ba"']),
    ({"items": {"type": "string"}, "minItems": 1, "maxItems": 2}, ['["a"]', "7"], ["[]", '["a","b","c"]', "[1]"]),
    ({"properties": {"a": False}}, ['{"b":1}', "[]"], ['{"a":1}']),
    ({"properties": {"a.b": {"type": "string"}}, "additionalProperties": False}, ['{"a.b":"x"}', "{}"], ['{"a.b":"x","c":1}', '{"a.b":1}']),
    ({"additionalProperties": {"type": "integer"}}, ['{"a":1}'], ['{"a":1,"b":"x"}']),
    ({"items": {"$ref": "#/definitions/n"}, "definitions": {"n": {"type": "null"}}}, ["[null]", "[]"], ["[null,0]"]),
    ({}, ["1", "{}"], []),
])
def test_keywords(spark, schema, good, bad):
    got = found(spark, good + bad, schema)
    assert all(not v for v in got[:len(good)])
    assert all(len(v) == 1 for v in got[len(good):]), list(zip(bad, got[len(good):]))


def test_nested_paths(spark):
    schema = {"items": {"items": {"properties": {"k": {"items": {"type": "string"}}}}}}
    got = found(spark, ['[[{"k": ["a", 1]}], [{}, {"k": [2, "b", 3]}]]'], schema)
    assert [p for p, _ in got[0]] == ["$[0][0].k[1]", "$[1][1].k[0]", "$[1][1].k[2]"]


@pytest.mark.parametrize("schema", [
    {"anyOf": [{}]}, {"type": "text"}, {"$ref": "other.json"}, {"items": {"$ref": "#"}},
    {"definitions": {"t": {"items": {"$ref": "#/definitions/t"}}}, "$ref": "#/definitions/t"}])
def test_what_cannot_be_compiled_raises(spark, schema):
    with pytest.raises(ValueError):
        violations("json", schema)


def test_violation_rows_and_report(spark):
    texts = [json.dumps(GOOD), changed(("ast", "nodes", 1, "id"), "x"), changed(("ast", "nodes", 0, "id"), "x"), None]
    df = spark.createDataFrame([(i, t, "go") for i, t in enumerate(texts)], "path int, json string, rule string")
    df = df.withColumnsRenamed({"path": "key", "rule": "language"})
    rows = OR.schema_violations(df, "key", "json", carry=["language"])
    assert {tuple(r) for r in rows.collect()} == {
        (1, "go", "$.ast.nodes[1].id", "type"), (2, "go", "$.ast.nodes[0].id", "type"), (3, "go", "$", "json")}
    report = OR.violation_report(rows.drop("language"))
    assert {tuple(r) for r in report.collect()} == {("type", "$.ast.nodes[*].id", 2, 2), ("json", "$", 1, 1)}
    assert OR.schema_violations(df.limit(0), "key", "json").count() == 0


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_texts_are_checked_once(spark):
    df = spark.createDataFrame([(0, json.dumps(GOOD))], "at int, json string")
    assert optimized(OR.schema_violations(df, "at", "json")).count("parseJson") == 1


def test_items_that_break_nothing_by_their_shape(spark):
    item = {"type": "object", "required": ["id"], "properties": {
        "id": {"type": "integer"}, "up": {"type": ["integer", "null"]}, "of": {"type": "array", "items": {"type": "integer"}},
        "at": {"type": "object", "properties": {"row": {"type": "integer"}}}, "any": {"items": {"type": "string"}}}}
    # A list shows its item type but not its nulls, and an empty one looks like one of nulls.
    items = [
        {"id": 1}, {"id": 2, "up": None, "of": [], "at": {}}, {"id": 3, "of": [1, None]}, {"id": 4, "of": [None]}, {"up": 1}, {"id": None},
        {"id": 1.5}, {"id": 7.0, "of": [1, 2]}, {"id": 8, "more": {"x": [None]}}, {"id": 9, "at": {"row": "x"}}, {"id": 10, "any": ["a", 1]},
        {"id": 11, "of": 5}, 12, None, {"id": 14, "up": "x", "of": ["y", 1]}]
    got = found(spark, [json.dumps(items), "[]", json.dumps(items[:2])], {"items": item})
    assert got[1:] == [[], []]
    # The item itself breaks the rule for its type.
    assert got[0] == [
        ("$[2].of[1]", "type"), ("$[3].of[0]", "type"), ("$[4].id", "required"), ("$[5].id", "type"), ("$[6].id", "type"),
        ("$[9].at.row", "type"), ("$[10].any[1]", "type"), ("$[11].of", "type"), ("$[12]", "type"), ("$[13]", "type"),
        ("$[14].up", "type"), ("$[14].of[0]", "type")]
