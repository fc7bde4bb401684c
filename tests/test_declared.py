"""Rules compiled from declarations, and many keys in one shuffle."""

import json
from pathlib import Path

import pytest

import __spark_entry__ as contract
from conftest import DATA
from studymart import contracts
from studymart.operators import declared, quality
from studymart.sources.sample_views import sample_view

KINDS = {"string": {"type": "string"}, "double": {"type": "number"}, "date": {"type": "string", "format": "date"}}
KINDS["timestamp_ntz"] = {"type": "string", "format": "date-time"}


def schema_of(schema, required):
    properties = {f.name: KINDS[f.dataType.simpleString()] for f in schema.fields}
    return {"type": "object", "properties": properties, "required": list(required)}


def lines(df):
    return sorted(map(tuple, df.collect()))


def test_record_schemas_equal_the_rules_written_by_hand(spark, base):
    path = Path(base, "schema.json")
    path.write_text(
        json.dumps(
            {
                "sleep_summary": schema_of(contracts.STUDY_SCHEMA, contracts.REQUIRED_STUDY_COLUMNS),
                "events": schema_of(contracts.EVENT_SCHEMA, contracts.REQUIRED_EVENT_COLUMNS),
            }
        )
    )
    tables = {"sleep_summary": sample_view(spark, DATA, "raw_studies_dirty"), "events": sample_view(spark, DATA, "raw_events_dirty")}
    compiled = declared.declared_report(tables, declared.record_contracts(path))
    assert lines(compiled) == lines(contract.check_contract(spark, DATA))


def test_value_lists_and_bounds(frame):
    rules = declared.record_rules(
        "t",
        {
            "properties": {
                "kind": {"type": "string", "enum": ["a", "b"], "description": "of a row"},
                "n": {"type": "integer", "minimum": 0, "exclusiveMaximum": 10},
            },
            "required": ["kind", "id"],
        },
    )
    df = frame([("a", "0", "x"), ("c", "10", "x"), ("NULL", "-1", ""), (None, "1.5", None), ("b", None, "y")], "kind string, n string, id string")
    assert lines(declared.declared_report({"t": df}, {"t": rules})) == [
        ("t.enum", "kind", 1), ("t.exclusiveMaximum", "n", 1), ("t.minimum", "n", 1), ("t.number", "n", 1),
        ("t.required", "id", 2), ("t.required", "kind", 2),
    ]


MODELS = """
models:
  - name: t
    description: "a table"
    columns:
      - name: id
        tests: [unique, not_null]
      - name: kind
        tests:
          - accepted_values:
              name: kinds
              values: ["a", "b"]
"""


def test_model_tests_from_a_file(frame, base):
    path = Path(base, "tests.yml")
    path.write_text(MODELS)
    df = frame([("1", "a"), ("1", "c"), (None, None), (None, "b")], "id string, kind string")
    assert lines(declared.declared_report({"t": df}, declared.model_tests(path))) == [
        ("t.accepted_values", "kind", 1), ("t.not_null", "id", 2), ("t.unique", "id", 1),
    ]


@pytest.mark.parametrize(
    "schema",
    [
        {"properties": {"a": {"type": "string", "pattern": "x"}}},
        {"properties": {"a": {"type": "array"}}},
        {"properties": {"a": {"type": "string", "format": "email"}}},
        {"properties": {}, "additionalProperties": False},
        {"type": "array"},
    ],
)
def test_unknown_keywords_of_schemas_fail(schema):
    with pytest.raises(declared.UnknownKeyword):
        declared.record_rules("t", schema)


@pytest.mark.parametrize(
    "column", [{"tests": ["relationships"]}, {"tests": [{"accepted_values": {"values": [1], "quote": False}}]}, {"meta": {}}]
)
def test_unknown_keywords_of_tests_fail(column):
    with pytest.raises(declared.UnknownKeyword):
        declared.model_tests({"models": [{"name": "t", "columns": [{"name": "a", **column}]}]})


def test_missing_tables_and_columns_fail(frame):
    rules = declared.model_tests({"models": [{"name": "t", "columns": [{"name": "a", "tests": ["unique"]}]}]})
    with pytest.raises(KeyError):
        declared.declared_report({}, rules)
    with pytest.raises(KeyError):
        declared.declared_report({"t": frame([(1,)], "b int")}, rules)


def test_many_keys_in_one_shuffle(spark, frame):
    rows = [(1, "x", None), (1, "x", "p"), (1, "y", "p"), (2, None, "p"), (2, None, "p"), (None, "z", "q"), (None, "z", "q")]
    df = frame(rows, "a int, b string, c string").repartition(3)
    rules = [("r1", ["a"]), ("r2", ["b", "a"]), ("r3", ["a", "b", "c"]), ("r4", ["c"]), ("r5", ["a"])]
    report = quality.unique_reports(df, rules)
    single = quality.combine(*[quality.unique_report(df, keys, rule) for rule, keys in rules])
    assert lines(report) == lines(single)
    assert [r.violations for r in quality.unique_reports(df, rules).orderBy("rule").collect()] == [2, 1, 0, 2, 2]
    plan = quality.unique_reports(spark.range(9).selectExpr("id a", "id b", "id c"), rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and plan.count("Expand") == 1
