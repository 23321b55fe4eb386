"""Data-quality expectations.

A check is a set of aggregate columns plus a rule over their results, so a whole suite is
one aggregate pass. Checks that need distinct values bring their own grouped pass.
The ``title`` of a check is a fixed value: it names the check in results.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wanewatch.operators.clean import column_set
from wanewatch.session import lookup_join
from wanewatch.sources.subscribers import SUBSCRIBER_COLUMNS

# Declared type names and the Spark types each one accepts.
TYPE_NAMES = {
    "int": ["tinyint", "smallint", "int", "bigint"],
    "float": ["float", "double"],
    "string": ["string"],
    "bool": ["boolean"],
    "datetime": ["timestamp", "timestamp_ntz"],
}
UNEXPECTED_SHOWN = 10

RESULT_DDL = (
    "check_id int, check_name string, passed boolean, severity string, "
    "details map<string,string>"
)


def _map(pairs: dict[str, Column | str | float | int | bool | None]) -> Column:
    parts = []
    for key, value in pairs.items():
        column = value if isinstance(value, Column) else F.lit(value)
        parts += [F.lit(key), column.cast("string")]
    return F.create_map(*parts)


@dataclass
class Check:
    """One expectation; subclass and override to add your own."""

    column: str = ""

    @property
    def name(self) -> str:
        return f"{self.title}({self.column})" if self.column else self.title

    title = "check"

    def present(self, df: DataFrame) -> bool:
        return not self.column or self.column in df.columns

    def aggregates(self, df: DataFrame) -> dict[str, Column]:
        """Aggregates this check adds to the shared pass."""
        return {}

    def distinct_aggregates(self) -> bool:
        """Whether the check needs a pass of its own over its column."""
        return False

    def counted(self, df: DataFrame) -> DataFrame:
        """One row of aggregates of a check with a pass of its own."""
        return (
            df.where(F.col(self.column).isNotNull())
            .groupBy(self.column)
            .agg(F.count("*").alias("n"))
            .agg(F.count("*").alias("distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias("values"))
        )

    def value_set(self) -> list | None:
        return None

    def outcome(self, df: DataFrame, at) -> tuple[Column, dict, Column]:
        """passed, details, severity; ``at(name)`` reads an aggregate."""
        raise NotImplementedError


def _error() -> Column:
    return F.lit("error")


@dataclass
class ColumnExists(Check):
    title = "expect_column_to_exist"

    def present(self, df: DataFrame) -> bool:
        return True

    def outcome(self, df, at):
        found = self.column in df.columns
        return F.lit(found), {"column": self.column, "found": found}, _error()


@dataclass
class ColumnsMatch(Check):
    columns: list[str] = field(default_factory=list)
    exact: bool = False
    title = "expect_table_columns_to_match_set"

    def outcome(self, df, at):
        found = column_set(df, self.columns, self.exact)
        details = {
            "expected": ",".join(sorted(self.columns)),
            "missing": ",".join(found["missing"]),
            "extra": ",".join(found["extra"]),
        }
        return F.lit(found["passed"]), details, _error()


@dataclass
class OfType(Check):
    expected: str = "string"
    title = "expect_column_values_to_be_of_type"

    def outcome(self, df, at):
        actual = df.schema[self.column].dataType.simpleString()
        passed = actual in TYPE_NAMES.get(self.expected, [self.expected])
        details = {
            "column": self.column,
            "expected_type": self.expected,
            "actual_type": actual,
        }
        return F.lit(passed), details, _error()


@dataclass
class NotNull(Check):
    mostly: float = 1.0
    title = "expect_column_values_to_not_be_null"

    def aggregates(self, df):
        return {"nulls": F.count_if(F.col(self.column).isNull()), "rows": F.count("*")}

    def outcome(self, df, at):
        ratio = F.coalesce(1 - F.try_divide(at("nulls"), at("rows")), F.lit(0.0))
        passed = ratio >= self.mostly
        details = {
            "column": self.column,
            "null_count": at("nulls"),
            "total_count": at("rows"),
            "non_null_ratio": F.round(ratio, 6),
            "threshold": self.mostly,
        }
        severity = F.when(passed & (at("nulls") > 0), "warning").otherwise("error")
        return passed, details, severity


@dataclass
class Between(Check):
    low: float | None = None
    high: float | None = None
    mostly: float = 1.0
    title = "expect_column_values_to_be_between"

    def aggregates(self, df):
        c = F.col(self.column)
        tests = [F.lit(True)]
        if self.low is not None:
            tests.append(c >= self.low)
        if self.high is not None:
            tests.append(c <= self.high)
        inside = reduce(lambda a, b: a & b, tests)
        return {
            "values": F.count(c),
            "inside": F.count_if(c.isNotNull() & inside),
            "min": F.min(c),
            "max": F.max(c),
        }

    def outcome(self, df, at):
        ratio = F.coalesce(F.try_divide(at("inside"), at("values")), F.lit(0.0))
        details = {
            "column": self.column,
            "min_value": self.low,
            "max_value": self.high,
            "actual_min": at("min"),
            "actual_max": at("max"),
            "out_of_range_count": at("values") - at("inside"),
            "in_range_ratio": F.round(ratio, 6),
            "threshold": self.mostly,
        }
        return ratio >= self.mostly, details, _error()


@dataclass
class InSet(Check):
    values: list = field(default_factory=list)
    mostly: float = 1.0
    title = "expect_column_values_to_be_in_set"

    def value_set(self):
        return self.values

    def aggregates(self, df):
        c = F.col(self.column)
        return {"values": F.count(c), "inside": F.count_if(c.isin(self.values))}

    def outcome(self, df, at):
        ratio = F.coalesce(F.try_divide(at("inside"), at("values")), F.lit(0.0))
        details = {
            "column": self.column,
            "expected_set": ",".join(str(v) for v in self.values),
            "in_set_ratio": F.round(ratio, 6),
            "threshold": self.mostly,
        }
        return ratio >= self.mostly, details, _error()


@dataclass
class InTable(Check):
    """Membership in a set that is a table; for sets too long for a list of literals.

    Values are tallied before they meet the set, so a hot value is one row; the set is
    broadcast only within measured rows and bytes.
    """

    allowed: DataFrame | None = None
    allowed_column: str = ""
    mostly: float = 1.0
    title = "expect_column_values_to_be_in_set"

    def distinct_aggregates(self):
        return True

    def counted(self, df):
        kind = df.schema[self.column].dataType
        source = self.allowed_column or self.column
        allowed = (
            self.allowed.select(F.col(source).try_cast(kind).alias("__value"))
            .where(F.col("__value").isNotNull())
            .distinct()
            .withColumn("__allowed", F.lit(True))
        )
        tally = (
            df.where(F.col(self.column).isNotNull())
            .groupBy(F.col(self.column).alias("__value"))
            .agg(F.count("*").alias("n"))
        )
        found = lookup_join(tally, allowed, "__value", "left")
        inside = F.when(F.col("__allowed"), F.col("n"))
        texts = (
            found.where(F.col("__allowed").isNull())
            .select(F.col("__value").cast("string").alias("__value"))
            .orderBy("__value")
            .limit(UNEXPECTED_SHOWN)
        )
        none = F.lit(0).cast("bigint")
        counts = found.agg(
            F.coalesce(F.sum("n"), none).alias("values"), F.coalesce(F.sum(inside), none).alias("inside")
        ).withColumn("outside", F.lit(""))
        shown = texts.agg(F.array_join(F.array_sort(F.collect_list("__value")), ",").alias("outside"))
        both = counts.unionByName(shown.select(none.alias("values"), none.alias("inside"), "outside"))
        return both.agg(*[F.max(c).alias(c) for c in ("values", "inside", "outside")])

    def outcome(self, df, at):
        ratio = F.coalesce(F.try_divide(at("inside"), at("values")), F.lit(0.0))
        details = {
            "column": self.column,
            "expected_set": f"table column {self.allowed_column or self.column}",
            "in_set_ratio": F.round(ratio, 6),
            "out_of_set_count": at("values") - at("inside"),
            "unexpected_values": at("outside"),
            "threshold": self.mostly,
        }
        return ratio >= self.mostly, details, _error()


@dataclass
class Unique(Check):
    mostly: float = 1.0
    title = "expect_column_values_to_be_unique"

    def distinct_aggregates(self):
        return True

    def outcome(self, df, at):
        ratio = F.coalesce(F.try_divide(at("distinct"), at("values")), F.lit(0.0))
        details = {
            "column": self.column,
            "unique_count": at("distinct"),
            "total_count": at("values"),
            "duplicate_count": at("values") - at("distinct"),
            "unique_ratio": F.round(ratio, 6),
            "threshold": self.mostly,
        }
        return ratio >= self.mostly, details, _error()


@dataclass
class MeanBetween(Check):
    low: float | None = None
    high: float | None = None
    title = "expect_column_mean_to_be_between"

    def aggregates(self, df):
        return {"mean": F.avg(self.column)}

    def outcome(self, df, at):
        passed = F.lit(True)
        if self.low is not None:
            passed = passed & F.coalesce(at("mean") >= self.low, F.lit(True))
        if self.high is not None:
            passed = passed & F.coalesce(at("mean") <= self.high, F.lit(True))
        details = {
            "column": self.column,
            "mean": F.round(at("mean"), 6),
            "min_value": self.low,
            "max_value": self.high,
        }
        return passed, details, _error()


@dataclass
class RowCountBetween(Check):
    low: int | None = None
    high: int | None = None
    title = "expect_table_row_count_to_be_between"

    def aggregates(self, df):
        return {"rows": F.count("*")}

    def outcome(self, df, at):
        passed = F.lit(True)
        if self.low is not None:
            passed = passed & (at("rows") >= self.low)
        if self.high is not None:
            passed = passed & (at("rows") <= self.high)
        details = {"row_count": at("rows"), "min_value": self.low, "max_value": self.high}
        return passed, details, _error()


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One result row per check, in the order given.

    All plain aggregates share one pass. Each check of uniqueness or of membership in a table adds
    one pass grouped by its column, and all other membership checks together one pass over the values outside their sets.
    """
    shared: dict[str, Column] = {}
    keys: dict[tuple[int, str], str] = {}
    seen: dict[str, str] = {}
    for i, check in enumerate(checks):
        if not check.present(df):
            continue
        for name, column in check.aggregates(df).items():
            text = str(column)
            if text not in seen:
                seen[text] = f"a{len(seen)}"
                shared[seen[text]] = column
            keys[i, name] = seen[text]
    shared = shared or {"a0": F.count("*")}
    base = df.agg(*[c.alias(alias) for alias, c in shared.items()])

    rows = []
    for i, check in enumerate(checks):
        if not check.present(df):
            missing = _map({"error": "column not found"})
            rows.append(_row(i, check, F.lit(False), missing, _error()))
        elif not check.distinct_aggregates():

            def at(name: str, i: int = i) -> Column:
                return F.col(keys[i, name])

            passed, details, severity = check.outcome(df, at)
            rows.append(_row(i, check, passed, _map(details), severity))
    sets = [c for c in enumerate(checks) if c[1].present(df) and c[1].value_set() is not None]
    parts = []
    if rows:
        plain = base.select(F.inline(F.array(*rows)))
        parts.append(_with_unexpected(df, plain, sets) if sets else plain)
    for i, check in enumerate(checks):
        if check.present(df) and check.distinct_aggregates():
            parts.append(_own_pass(df, i, check))
    return reduce(DataFrame.unionByName, parts).orderBy("check_id")


def _row(i: int, check: Check, passed: Column, details: Column, severity: Column) -> Column:
    return F.struct(
        F.lit(i + 1).alias("check_id"),
        F.lit(check.name).alias("check_name"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        severity.alias("severity"),
        details.alias("details"),
    )


def _with_unexpected(df: DataFrame, rows: DataFrame, sets: list) -> DataFrame:
    """Add the first unexpected values, sorted, to the details of the membership checks.

    Unexpected values are deduplicated by (check, value); a window then keeps the first
    few per check, so no list ever holds more than the number shown.
    """
    outside = [
        F.when(
            F.col(c.column).isNotNull() & ~F.col(c.column).isin(c.value_set()),
            F.struct(F.lit(i + 1).alias("check_id"), F.col(c.column).cast("string").alias("v")),
        )
        for i, c in sets
    ]
    w = Window.partitionBy("check_id").orderBy("v")
    first = (
        df.select(F.inline(F.array_compact(F.array(*outside))))
        .distinct()
        .withColumn("place", F.row_number().over(w))
        .where(F.col("place") <= UNEXPECTED_SHOWN)
        .groupBy("check_id")
        .agg(F.array_join(F.array_sort(F.collect_list("v")), ",").alias("unexpected"))
    )
    shown = F.create_map(
        F.lit("unexpected_values"), F.coalesce("unexpected", F.lit(""))
    )
    is_set = F.col("check_id").isin([i + 1 for i, _ in sets])
    return (
        rows.join(first, "check_id", "left")
        .withColumn(
            "details", F.when(is_set, F.map_concat("details", shown)).otherwise(F.col("details"))
        )
        .drop("unexpected")
    )


def _own_pass(df: DataFrame, i: int, check: Check) -> DataFrame:
    counts = check.counted(df)
    passed, details, severity = check.outcome(df, F.col)
    return counts.select(_row(i, check, passed, _map(details), severity).alias("r")).select("r.*")


def summarise(results: DataFrame) -> DataFrame:
    """One row: totals and whether no error-severity check failed."""
    return results.agg(
        F.count("*").alias("total_checks"),
        F.count_if("passed").alias("passed_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        (F.count_if(~F.col("passed") & (F.col("severity") == "error")) == 0).alias(
            "overall_success"
        ),
    )


def failures(results: DataFrame, severity: str | None = None) -> DataFrame:
    failed = results.where(~F.col("passed"))
    return failed.where(F.col("severity") == severity) if severity else failed


@dataclass
class Report:
    """Result of one suite run. ``results`` has one row per check, so it fits anywhere."""

    dataset_name: str
    validation_time: datetime
    results: DataFrame

    def to_dict(self) -> dict:
        rows = [r.asDict(recursive=True) for r in self.results.collect()]
        failed = [r for r in rows if not r["passed"]]
        return {
            "dataset_name": self.dataset_name,
            "validation_time": self.validation_time.isoformat(),
            "total_checks": len(rows),
            "passed_checks": len(rows) - len(failed),
            "failed_checks": len(failed),
            "overall_success": not any(r["severity"] == "error" for r in failed),
            "results": [
                {k: r[k] for k in ("check_name", "passed", "severity", "details")} for r in rows
            ],
        }

    def to_json(self) -> str:
        return json.dumps(self.to_dict(), indent=2)

    def document(self) -> DataFrame:
        """The whole report as one JSON text, built by Spark."""
        document = F.struct(
            F.lit(self.dataset_name).alias("dataset_name"),
            F.lit(self.validation_time.isoformat()).alias("validation_time"),
            F.count("*").alias("total_checks"),
            F.count_if("passed").alias("passed_checks"),
            F.sort_array(
                F.collect_list(F.struct("check_id", "check_name", "passed", "severity", "details"))
            ).alias("results"),
        )
        flat = self.results.withColumn("details", F.to_json("details"))
        return flat.agg(F.to_json(document).alias("report"))


class Suite:
    """Named list of checks; add to it with ``expect``, start over with ``clear``."""

    def __init__(self, dataset_name: str, checks: list[Check] | None = None):
        self.dataset_name = dataset_name
        self.checks = list(checks or [])

    def expect(self, check: Check) -> "Suite":
        self.checks.append(check)
        return self

    def clear(self) -> None:
        self.checks = []

    def results(self, df: DataFrame) -> DataFrame:
        return run_checks(df, self.checks)

    def run(self, df: DataFrame, at: datetime | None = None) -> Report:
        at = at or datetime.now(timezone.utc)
        return Report(self.dataset_name, at, self.results(df))


# Domains of the subscriber columns.
YES_NO = ["Yes", "No"]
DOMAINS = {
    "gender": ["Male", "Female"],
    "Partner": YES_NO,
    "Dependents": YES_NO,
    "PhoneService": YES_NO,
    "Contract": ["Month-to-month", "One year", "Two year"],
    "InternetService": ["DSL", "Fiber optic", "No"],
    "PaymentMethod": [
        "Electronic check",
        "Mailed check",
        "Bank transfer (automatic)",
        "Credit card (automatic)",
    ],
    "Churn": YES_NO,
}


# Fixed values, down to the suite: columns, types, bounds and the name of the subscriber checks.
def schema_checks() -> list[Check]:
    return [
        ColumnsMatch(columns=SUBSCRIBER_COLUMNS),
        OfType("tenure", "int"),
        OfType("MonthlyCharges", "float"),
        OfType("SeniorCitizen", "int"),
    ]


def value_checks() -> list[Check]:
    return [InSet(c, values) for c, values in DOMAINS.items()] + [
        Between("tenure", 0, 100),
        Between("MonthlyCharges", 0, 500),
        Between("SeniorCitizen", 0, 1),
    ]


def completeness_checks() -> list[Check]:
    strict = [NotNull(c) for c in ("customerID", "Churn", "tenure", "MonthlyCharges")]
    return strict + [NotNull("TotalCharges", 0.99)]


def uniqueness_checks() -> list[Check]:
    return [Unique("customerID")]


def statistics_checks() -> list[Check]:
    return [
        RowCountBetween(low=1000),
        MeanBetween("tenure", 10, 50),
        MeanBetween("MonthlyCharges", 30, 100),
    ]


def subscriber_suite() -> Suite:
    """The 24 checks of the subscriber table."""
    return Suite(
        "telco_churn",
        schema_checks()
        + value_checks()
        + completeness_checks()
        + uniqueness_checks()
        + statistics_checks(),
    )


def validate_subscribers(df: DataFrame) -> Report:
    return subscriber_suite().run(df)
