"""Declarative data-quality rules. Every report has columns (rule, column_name, violations)."""

import logging
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studymart.contracts import NULL_TOKENS, REJECTS, REPORT_SCHEMA, STAGE_SUM_BUFFER_MIN
from studymart.functions import null_if_token, try_read
from studymart.sources.files import MissingInput, scan_any


log = logging.getLogger(__name__)


@dataclass(frozen=True)
class RowRule:
    """A rule that one row can break on its own; ``violated`` maps the column to a condition."""

    rule: str
    column: str
    violated: Callable[[Column], Column]


def not_null(column: str, rule: str = "not_null") -> RowRule:
    return RowRule(rule, column, lambda c: c.isNull())


def positive(column: str, rule: str = "positive") -> RowRule:
    """Values must be above 0; NULL passes."""
    return RowRule(rule, column, lambda c: c <= 0)


def accepted_values(column: str, values: Sequence, rule: str = "accepted_values") -> RowRule:
    """Values must be in the list; NULL passes."""
    return RowRule(rule, column, lambda c: ~c.isin(*values))


def typed_as(column: str, data_type: T.DataType, rule: str | None = None) -> RowRule:
    """Text must read as the type; NULL passes."""
    name = rule or data_type.simpleString()
    return RowRule(name, column, lambda c: c.isNotNull() & try_read(c, data_type).isNull())


def readable(rejects: str, rule: str = "readable") -> RowRule:
    """No value of the row may have been unreadable; ``rejects`` is the column that lists them."""
    return RowRule(rule, rejects, lambda c: F.size(c) > 0)


# What a table of sleep events must satisfy before it is aggregated.
EVENT_RULES = (not_null("study_id"), positive("duration_sec"))


def contract_rules(
    schema: T.StructType, required: Iterable[str], table: str, null_tokens: Iterable[str] = NULL_TOKENS
) -> list[RowRule]:
    """Required fields must be there and every non-text field must read as its type.

    For landed text: null markers are NULL here as they are when the text is typed.
    """
    tokens = tuple(null_tokens)

    def marked(rule: RowRule) -> RowRule:
        return RowRule(rule.rule, rule.column, lambda c: rule.violated(null_if_token(c, tokens)))

    rules = [not_null(c, f"{table}.required") for c in required]
    for field in schema.fields:
        if not isinstance(field.dataType, T.StringType):
            kind = "number" if isinstance(field.dataType, T.NumericType) else field.dataType.typeName()
            rules.append(typed_as(field.name, field.dataType, f"{table}.{kind}"))
    return [marked(r) for r in rules]


def applicable(df: DataFrame, rules: Iterable[RowRule]) -> list[RowRule]:
    """The rules whose column the frame has."""
    return [r for r in rules if r.column in df.columns]


def violation_counts(rules: Sequence[RowRule]) -> list[Column]:
    return [F.count_if(r.violated(F.col(r.column))).alias(f"rule_{i}") for i, r in enumerate(rules)]


def _report_rows(counts: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    lines = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                F.lit(column).alias("column_name"),
                F.col(f"rule_{i}").cast("long").alias("violations"),
            )
            for i, (rule, column) in enumerate(rules)
        ]
    )
    return counts.select(F.inline(lines))


def rule_report(df: DataFrame, rules: Iterable[RowRule]) -> DataFrame:
    """Violations of all row rules, counted together in one scan of the frame."""
    active = applicable(df, rules)
    if not active:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    counts = df.agg(*violation_counts(active))
    return _report_rows(counts, [(r.rule, r.column) for r in active])


def unique_report(df: DataFrame, keys: Sequence[str], rule: str = "unique") -> DataFrame:
    """Number of key values held by more than one row; keys with a NULL are left out.

    Counting starts inside every task, so a key on a third of the rows is no burden. NULL keys
    are left out only after counting: the scan then stays the same for every rule on a
    table, and Spark reuses it.
    """
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    copies = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    counts = copies.agg(F.count_if((F.col("copies") > 1) & present).alias("rule_0"))
    return _report_rows(counts, [(rule, ", ".join(keys))])


def unique_reports(df: DataFrame, rules: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """`unique_report` for any number of (rule, keys) on one table, in one shuffle of its rows.

    The key sets are grouping sets: one expansion of the scan, counted within each task before the
    one exchange. Keys are compared as they are, not by a hash.
    """
    columns = list(dict.fromkeys(k for _, keys in rules for k in keys))
    sets = list(dict.fromkeys(tuple(sorted(keys, key=columns.index)) for _, keys in rules))
    # In the grouping id the first column is the highest bit; a bit is set where a column is not grouped.
    ids = {keys: sum(1 << i for i, c in enumerate(reversed(columns)) if c not in keys) for keys in sets}
    copies = df.groupingSets([[F.col(c) for c in keys] for keys in sets], *columns).agg(
        F.grouping_id().alias("_set"), F.count("*").alias("_copies")
    )

    def broken(keys: Sequence[str]) -> Column:
        found = (F.col("_set") == ids[tuple(sorted(keys, key=columns.index))]) & (F.col("_copies") > 1)
        return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], found)

    counts = copies.agg(*[F.count_if(broken(keys)).alias(f"rule_{i}") for i, (_, keys) in enumerate(rules)])
    return _report_rows(counts, [(rule, ", ".join(keys)) for rule, keys in rules])


def unaccepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """The values outside the list with their row counts."""
    return (
        df.where(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("records"))
    )


def _overfull(total: Column) -> Column:
    return total < F.col("rem_min") + F.col("deep_min") + F.col("light_min") - STAGE_SUM_BUFFER_MIN


def stage_sum(rule: str = "fct_sleep_summary.stage_sum") -> RowRule:
    """Stages must not add up to more than the night, beyond a rounding buffer."""
    return RowRule(rule, "total_sleep_time_min", _overfull)


def stage_sum_violations(summary: DataFrame) -> DataFrame:
    """The studies that break `stage_sum`."""
    return summary.where(_overfull(F.col("total_sleep_time_min")))


def combine(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


class QualityGateError(RuntimeError):
    """Raised when a gate finds broken rules; carries them as (rule, column, violations)."""

    def __init__(self, failures: Sequence[tuple[str, str, int]]):
        self.failures = list(failures)
        lines = ", ".join(f"{rule}({column}): {n}" for rule, column, n in self.failures)
        super().__init__(f"quality rules broken: {lines}")


def require(report: DataFrame) -> DataFrame:
    """Stop unless the report is clean; return it with its figures settled.

    The report runs once, and only its few rows, one per rule, reach the driver.
    """
    lines = [tuple(r) for r in report.collect()]
    failures = [line for line in lines if line[2] > 0]
    if failures:
        raise QualityGateError(failures)
    return report.sparkSession.createDataFrame(lines, REPORT_SCHEMA)


def require_counts(rules: Sequence[RowRule], counts: dict) -> None:
    """`require` for counts gathered while a table was written."""
    found = [(r.rule, r.column, counts[f"rule_{i}"] or 0) for i, r in enumerate(rules)]
    failures = [f for f in found if f[2] > 0]
    if failures:
        raise QualityGateError(failures)


def check_path(spark: SparkSession, path: str) -> bool:
    """Whether the events stored at a path (Parquet, or CSV as landed) satisfy the event rules.

    Unreadable values and malformed lines of a CSV break them too. So does a path that can't be read:
    nothing there, damaged files, or CSV and Parquet mixed; the log says which.
    """
    try:
        events = scan_any(spark, path, rejects=REJECTS)
        require(rule_report(events, [*EVENT_RULES, readable(REJECTS)]))
    except QualityGateError:
        return False
    except (MissingInput, ValueError, PySparkException, Py4JError) as error:
        log.warning("%s can't be read: %s", path, str(error).partition("\n")[0])
        return False
    return True
