"""Rules from the declarations users write: JSON schemas of landed records, and column tests of models."""

import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studymart.contracts import NULL_TOKENS
from studymart.functions import null_if_token, try_read
from studymart.operators import quality
from studymart.operators.quality import RowRule

# JSON types and formats, and what a value must read as.
_TYPES = {
    ("string", None): T.StringType(),
    ("string", "date"): T.DateType(),
    ("string", "date-time"): T.TimestampNTZType(),
    ("number", None): T.DoubleType(),
    ("integer", None): T.LongType(),
    ("boolean", None): T.BooleanType(),
}
_BOUNDS = {
    "minimum": lambda value, bound: value < bound,
    "maximum": lambda value, bound: value > bound,
    "exclusiveMinimum": lambda value, bound: value <= bound,
    "exclusiveMaximum": lambda value, bound: value >= bound,
}
_NOTES = {"description", "title", "$comment", "$schema", "$id"}


class UnknownKeyword(ValueError):
    """A declaration asks for something that would go unchecked."""


@dataclass
class TableRules:
    """What is declared for one table: rules on rows, and keys that must be unique."""

    rows: list[RowRule] = field(default_factory=list)
    unique: list[tuple[str, tuple[str, ...]]] = field(default_factory=list)


def _only(known: Iterable[str], given: Iterable[str], where: str) -> None:
    unknown = sorted(set(given) - set(known) - _NOTES)
    if unknown:
        raise UnknownKeyword(f"{where}: " + ", ".join(unknown))


def record_rules(table: str, schema: dict, null_tokens: Iterable[str] = NULL_TOKENS) -> TableRules:
    """The rules of one record schema, for landed text: required fields, types, value lists and bounds.

    Null markers are NULL; NULL passes all rules but ``required``. Keywords without a rule fail.
    """
    _only({"type", "properties", "required"}, schema, table)
    if schema.get("type", "object") != "object":
        raise UnknownKeyword(f"{table}: type {schema['type']}")
    fields, extra, tokens = [], [], tuple(null_tokens)
    for name, kind in schema.get("properties", {}).items():
        where = f"{table}.{name}"
        _only({"type", "format", "enum", *_BOUNDS}, kind, where)
        key = (kind.get("type", "string"), kind.get("format"))
        if key not in _TYPES:
            raise UnknownKeyword(f"{where}: type {key[0]}, format {key[1]}")
        fields.append(T.StructField(name, _TYPES[key]))
        if "enum" in kind:
            values = [str(v) for v in kind["enum"]]
            extra.append(RowRule(f"{table}.enum", name, lambda c, v=values: ~null_if_token(c, tokens).isin(*v)))
        for word in _BOUNDS.keys() & kind.keys():
            def beyond(c, word=word, bound=kind[word]):
                return _BOUNDS[word](try_read(null_if_token(c, tokens), T.DoubleType()), F.lit(bound))

            extra.append(RowRule(f"{table}.{word}", name, beyond))
    required = schema.get("required", [])
    missing = sorted(set(required) - {f.name for f in fields})
    fields += [T.StructField(name, T.StringType()) for name in missing]
    return TableRules(quality.contract_rules(T.StructType(fields), required, table, tokens) + sorted(extra, key=lambda r: (r.rule, r.column)))


def record_contracts(source: str | Path | dict) -> dict[str, TableRules]:
    """The rules of a JSON file that maps tables to record schemas."""
    declared = source if isinstance(source, dict) else json.loads(Path(source).read_text(encoding="utf-8"))
    return {table: record_rules(table, schema) for table, schema in declared.items()}


def _model_test(rules: TableRules, model: str, column: str, test: str | dict) -> None:
    name, options = (test, {}) if isinstance(test, str) else next(iter(test.items()))
    where = f"{model}.{column}.{name}"
    if name == "unique":
        _only({"name"}, options or {}, where)
        rules.unique.append((f"{model}.unique", (column,)))
    elif name == "not_null":
        _only({"name"}, options or {}, where)
        rules.rows.append(quality.not_null(column, f"{model}.not_null"))
    elif name == "accepted_values":
        _only({"name", "values"}, options, where)
        rules.rows.append(quality.accepted_values(column, options["values"], f"{model}.accepted_values"))
    else:
        raise UnknownKeyword(f"{model}.{column}: test {name}")


def model_tests(source: str | Path | dict) -> dict[str, TableRules]:
    """The column tests of a YAML file: ``models``, their ``columns``, and ``tests`` of each.

    A mapping is taken as it is; a file needs the yaml package.
    """
    if not isinstance(source, dict):
        import yaml

        source = yaml.safe_load(Path(source).read_text(encoding="utf-8"))
    _only({"models", "version"}, source, "tests")
    out: dict[str, TableRules] = {}
    for model in source["models"]:
        _only({"name", "columns"}, model, str(model.get("name")))
        rules = out.setdefault(model["name"], TableRules())
        for column in model.get("columns", []):
            _only({"name", "tests"}, column, f"{model['name']}.{column.get('name')}")
            for test in column.get("tests", []):
                _model_test(rules, model["name"], column["name"], test)
    return out


def declared_report(tables: dict[str, DataFrame], declared: dict[str, TableRules]) -> DataFrame:
    """(rule, column_name, violations) of all that is declared.

    A table is scanned once for all its row rules, and shuffled once for all its keys. A declared
    table that isn't given fails, and so does a declared column that its table lacks.
    """
    reports = []
    for name, rules in declared.items():
        if name not in tables:
            raise KeyError(f"rules are declared for {name}, which isn't there")
        named = [r.column for r in rules.rows] + [c for _, keys in rules.unique for c in keys]
        missing = sorted(set(named) - set(tables[name].columns))
        if missing:
            raise KeyError(f"{name} lacks " + ", ".join(missing))
        if rules.rows:
            reports.append(quality.rule_report(tables[name], rules.rows))
        if rules.unique:
            reports.append(quality.unique_reports(tables[name], rules.unique))
    return quality.combine(*reports)
