"""Cleaning, profiling, expectation and file queries."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import functions as F

from wanewatch.catalog.registry import (
    LABEL,
    NUMBER,
    on_clean,
    on_scored,
    on_subs,
    query,
    r6,
)
from wanewatch.functions import rules
from wanewatch.operators import clean as cleaning
from wanewatch.operators import expectations, profile
from wanewatch.session import fresh_path
from wanewatch.sources import files
from wanewatch.sources.subscribers import (
    SUBSCRIBER_COLUMNS,
    SUBSCRIBER_DDL,
    clean_subscribers,
    scored_subscribers,
    subscribers,
)
from wanewatch.sources.tables import table

RUN_AT = datetime(2024, 1, 31, 12, 0, 0)


@query(
    on_scored(
        """SELECT CAST(rule_points > 50 AS INTEGER) AS prediction, count(*) AS customers,
  CAST(sum(label) AS BIGINT) AS churned, round(avg(rule_points) / 100, 6) AS mean_probability,
  round(avg(CAST((rule_points > 50) = (label = 1) AS INTEGER)), 6) AS accuracy
FROM scored GROUP BY 1"""
    )
)
def rule_score_summary(spark, folder):
    """Rule prediction against the label."""
    df = scored_subscribers(spark, folder)
    prediction = rules.rule_prediction(df.columns)
    return df.groupBy(prediction.alias("prediction")).agg(
        F.count("*").alias("customers"),
        F.sum("label").cast("bigint").alias("churned"),
        r6(F.avg("rule_points") / 100).alias("mean_probability"),
        r6(F.avg((prediction == F.col("label")).cast("int"))).alias("accuracy"),
    )


@query(on_subs("SELECT * FROM subs"))
def subscriber_view(spark, folder):
    return subscribers(spark, folder)


@query(on_clean('SELECT * EXCLUDE ("customerID") FROM clean'))
def clean_table(spark, folder):
    return cleaning.clean(subscribers(spark, folder))


@query(
    on_subs(
        f"""SELECT label, count(*) AS n, round(sum("TotalCharges"), 2) AS total FROM (
  SELECT DISTINCT * EXCLUDE ("Churn") REPLACE ({NUMBER} AS "TotalCharges"), CAST({LABEL} AS INTEGER) AS label, "Churn"
  FROM subs WHERE "Churn" IS NOT NULL) GROUP BY label"""
    )
)
def clean_drop_before_map(spark, folder):
    """The other order: an unmapped target survives as a NULL label."""
    df = cleaning.clean(subscribers(spark, folder), keep_key=True, drop_before_map=True)
    return df.groupBy("label").agg(
        F.count("*").alias("n"), F.round(F.sum("TotalCharges"), 2).alias("total")
    )


@query(
    on_subs(
        f"""SELECT s.* EXCLUDE ("customerID", "TotalCharges", "Churn", t), coalesce(t, m) AS "TotalCharges",
  CAST(coalesce("Churn" = 'Yes', FALSE) AS INTEGER) AS "Churn"
FROM (SELECT *, {NUMBER} AS t FROM subs) s, (SELECT median({NUMBER}) AS m FROM subs) q"""
    )
)
def preprocess_table(spark, folder):
    """No duplicate removal, median total, Yes-or-zero target."""
    return cleaning.preprocess(subscribers(spark, folder))


TEXTS = [c for c in SUBSCRIBER_COLUMNS if c not in ("SeniorCitizen", "tenure", "MonthlyCharges")]


def _filled(c: str) -> str:
    if c == "TotalCharges":
        return f'coalesce("{c}", (SELECT median("{c}") FROM d)) AS "{c}"'
    if c in TEXTS:
        mode = (
            f'SELECT "{c}" FROM d WHERE "{c}" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1'
        )
        return f'coalesce("{c}", ({mode})) AS "{c}"'
    return f'coalesce("{c}"::DOUBLE, (SELECT median("{c}"::DOUBLE) FROM d)) AS "{c}"'


@query(
    on_subs(
        "SELECT " + ",\n  ".join(_filled(c) for c in SUBSCRIBER_COLUMNS) + " FROM d",
        f'\nd AS (SELECT DISTINCT * REPLACE ({NUMBER} AS "TotalCharges") FROM subs)',
    )
)
def impute_median_mode(spark, folder):
    """Medians for numbers, modes for texts, a missing target included."""
    df = cleaning.coerce_total(subscribers(spark, folder)).dropDuplicates().persist()
    return cleaning.impute_all(df)


@query(
    on_subs(
        "SELECT (SELECT count(*) FROM subs) AS row_count, 21 AS column_count, "
        + "CAST((SELECT "
        + " + ".join(f'count(*) FILTER (WHERE "{c}" IS NULL)' for c in SUBSCRIBER_COLUMNS)
        + " FROM subs) AS BIGINT) AS missing_cells, "
        + "CAST((SELECT count(*) FROM subs) - (SELECT count(*) FROM (SELECT DISTINCT * FROM subs)) AS BIGINT)"
        + " AS duplicate_rows, '' AS issues, TRUE AS passed"
    )
)
def quality_profile(spark, folder):
    return profile.quality_report(subscribers(spark, folder))


@query(
    on_subs(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE \"{c}\" IS NULL) AS missing FROM subs"
            for c in SUBSCRIBER_COLUMNS
        )
    )
)
def missing_by_column(spark, folder):
    return profile.missing_counts(subscribers(spark, folder))


@query(
    on_subs('SELECT "Churn" AS value, count(*) AS n FROM subs WHERE "Churn" IS NOT NULL GROUP BY 1')
)
def target_distribution(spark, folder):
    return profile.target_distribution(subscribers(spark, folder))


@query("SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def value_counts(spark, folder):
    return profile.value_counts(table(spark, folder, "lineitem"), "l_returnflag")


@query(
    """SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM (
  SELECT l_partkey, l_suppkey, l_quantity, count(*) AS n FROM lineitem GROUP BY 1, 2, 3)"""
)
def duplicate_rows(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_quantity")
    return cleaning.duplicate_count(lines)


@query(
    on_subs(
        """SELECT (SELECT count(*) FROM subs) - (SELECT count(*) FROM (SELECT DISTINCT * FROM subs)) AS duplicate_rows"""
    )
)
def duplicate_subscribers(spark, folder):
    """Repeats of whole rows, all columns compared."""
    return cleaning.duplicate_count(subscribers(spark, folder))


@query("SELECT count(DISTINCT l_partkey) AS distinct_values FROM lineitem")
def distinct_count(spark, folder):
    return cleaning.distinct_count(table(spark, folder, "lineitem"), "l_partkey")


def _expectation_rows() -> str:
    rows, i = [], 0

    def add(name: str, passed: str, severity: str, measure: str, unexpected: str = "NULL"):
        nonlocal i
        i += 1
        rows.append(
            f"SELECT {i} AS check_id, '{name}' AS check_name, {passed} AS passed, "
            f"{severity} AS severity, CAST({measure} AS DOUBLE) AS measure, "
            f"CAST({unexpected} AS VARCHAR) AS unexpected"
        )

    error = "'error'"
    add("expect_table_columns_to_match_set", "TRUE", error, "NULL")
    for c in ("tenure", "MonthlyCharges", "SeniorCitizen"):
        add(f"expect_column_values_to_be_of_type({c})", "TRUE", error, "NULL")
    for c, values in expectations.DOMAINS.items():
        listed = ", ".join(f"'{v}'" for v in values)
        inside = f'(SELECT avg(CAST("{c}" IN ({listed}) AS INTEGER)) FROM subs WHERE "{c}" IS NOT NULL)'
        outside = (
            f"coalesce((SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT \"{c}\" AS v FROM subs "
            f'WHERE "{c}" NOT IN ({listed}) ORDER BY 1 LIMIT 10)), \'\')'
        )
        add(
            f"expect_column_values_to_be_in_set({c})",
            f"{inside} >= 1",
            error,
            f"round({inside}, 6)",
            outside,
        )
    for c, high in (("tenure", 100), ("MonthlyCharges", 500), ("SeniorCitizen", 1)):
        inside = f'(SELECT avg(CAST("{c}" BETWEEN 0 AND {high} AS INTEGER)) FROM subs)'
        add(
            f"expect_column_values_to_be_between({c})",
            f"{inside} >= 1",
            error,
            f"round({inside}, 6)",
        )
    for c, mostly in (
        ("customerID", 1.0),
        ("Churn", 1.0),
        ("tenure", 1.0),
        ("MonthlyCharges", 1.0),
        ("TotalCharges", 0.99),
    ):
        present = f'(SELECT 1 - count(*) FILTER (WHERE "{c}" IS NULL) / count(*) FROM subs)'
        add(
            f"expect_column_values_to_not_be_null({c})",
            f"{present} >= {mostly}",
            f"CASE WHEN {present} >= {mostly} AND {present} < 1 THEN 'warning' ELSE 'error' END",
            f"round({present}, 6)",
        )
    unique = '(SELECT count(DISTINCT "customerID") / count("customerID") FROM subs)'
    add(
        "expect_column_values_to_be_unique(customerID)",
        f"{unique} >= 1",
        error,
        f"round({unique}, 6)",
    )
    n = "(SELECT count(*) FROM subs)"
    add("expect_table_row_count_to_be_between", f"{n} >= 1000", error, n)
    for c, low, high in (("tenure", 10, 50), ("MonthlyCharges", 30, 100)):
        mean = f'(SELECT avg("{c}") FROM subs)'
        add(
            f"expect_column_mean_to_be_between({c})",
            f"{mean} BETWEEN {low} AND {high}",
            error,
            f"round({mean}, 6)",
        )
    return "\nUNION ALL ".join(rows)


MEASURES = [
    "non_null_ratio",
    "in_range_ratio",
    "in_set_ratio",
    "unique_ratio",
    "row_count",
    "mean",
]


@query(on_subs(_expectation_rows()))
def expectation_report(spark, folder):
    """The 24 checks of the subscriber suite."""
    results = expectations.validate_subscribers(subscribers(spark, folder)).results
    measure = F.coalesce(*[F.col("details")[m] for m in MEASURES]).cast("double")
    return results.select(
        "check_id",
        "check_name",
        "passed",
        "severity",
        measure.alias("measure"),
        F.col("details")["unexpected_values"].alias("unexpected"),
    )


@query(
    on_subs(
        """SELECT count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed_checks,
  count(*) FILTER (WHERE NOT passed) AS failed_checks,
  count(*) FILTER (WHERE NOT passed AND severity = 'error') = 0 AS overall_success FROM checks""",
        f"\nchecks AS ({_expectation_rows()})",
    )
)
def expectation_summary(spark, folder):
    return expectations.summarise(
        expectations.validate_subscribers(subscribers(spark, folder)).results
    )


@query(
    on_subs(
        "SELECT check_id, check_name FROM checks WHERE NOT passed AND severity = 'error'",
        f"\nchecks AS ({_expectation_rows()})",
    )
)
def expectation_failures(spark, folder):
    results = expectations.validate_subscribers(subscribers(spark, folder)).results
    return expectations.failures(results, "error").select("check_id", "check_name")


@query(
    on_subs(
        """SELECT 'telco_churn' AS dataset_name, '2024-01-31T12:00:00' AS validation_time,
  count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed_checks FROM checks""",
        f"\nchecks AS ({_expectation_rows()})",
    )
)
def expectation_document(spark, folder):
    """The report as JSON, written and read back."""
    report = expectations.subscriber_suite().run(subscribers(spark, folder), RUN_AT)
    path = fresh_path(spark, "report")
    report.document().write.mode("overwrite").text(path)
    text = F.col("value")
    return spark.read.text(path).select(
        F.get_json_object(text, "$.dataset_name").alias("dataset_name"),
        F.get_json_object(text, "$.validation_time").alias("validation_time"),
        F.get_json_object(text, "$.total_checks").cast("bigint").alias("total_checks"),
        F.get_json_object(text, "$.passed_checks").cast("bigint").alias("passed_checks"),
    )


@query("""SELECT check_id, check_name, passed, measure FROM (
  SELECT 1 AS check_id, 'expect_column_values_to_be_between(l_discount)' AS check_name,
    avg(CAST(l_discount BETWEEN 0 AND 0.05::DOUBLE AS INTEGER)) >= 0.4 AS passed,
    round(avg(CAST(l_discount BETWEEN 0 AND 0.05::DOUBLE AS INTEGER)), 6) AS measure FROM lineitem
  UNION ALL SELECT 2, 'expect_column_values_to_be_in_set(l_returnflag)',
    avg(CAST(l_returnflag IN ('A', 'N') AS INTEGER)) >= 1,
    round(avg(CAST(l_returnflag IN ('A', 'N') AS INTEGER)), 6) FROM lineitem
  UNION ALL SELECT 3, 'expect_column_values_to_be_unique(l_orderkey)',
    count(DISTINCT l_orderkey) / count(l_orderkey) >= 0.1,
    round(count(DISTINCT l_orderkey) / count(l_orderkey), 6) FROM lineitem
  UNION ALL SELECT 4, 'expect_column_values_to_not_be_null(l_missing)', FALSE, NULL)""")
def expectation_lineitem(spark, folder):
    """A suite of one's own, an absent column included, over the largest table."""
    suite = expectations.Suite("lineitem")
    suite.expect(expectations.Between("l_discount", 0, 0.05, mostly=0.4))
    suite.expect(expectations.InSet("l_returnflag", ["A", "N"]))
    suite.expect(expectations.Unique("l_orderkey", mostly=0.1))
    suite.expect(expectations.NotNull("l_missing"))
    measure = F.coalesce(*[F.col("details")[m] for m in MEASURES]).cast("double")
    return suite.results(table(spark, folder, "lineitem")).select(
        "check_id", "check_name", "passed", measure.alias("measure")
    )


@dataclass
class Positive(expectations.Check):
    """A check of one's own: a share of the values is above zero."""

    mostly: float = 1.0
    title = "expect_column_values_to_be_positive"

    def aggregates(self, df):
        return {"above": F.count_if(F.col(self.column) > 0), "rows": F.count("*")}

    def outcome(self, df, at):
        share = F.coalesce(F.try_divide(at("above"), at("rows")), F.lit(0.0))
        return share >= self.mostly, {"share": F.round(share, 6)}, F.lit("warning")


@query(
    """WITH there AS (SELECT column_name FROM (DESCRIBE SELECT * FROM lineitem))
SELECT 1 AS check_id, 'expect_column_to_exist(l_tax)' AS check_name,
  (SELECT count(*) FROM there WHERE column_name = 'l_tax') > 0 AS passed, 'error' AS severity, CAST(NULL AS DOUBLE) AS share
UNION ALL SELECT 2, 'expect_column_to_exist(l_missing)',
  (SELECT count(*) FROM there WHERE column_name = 'l_missing') > 0, 'error', NULL
UNION ALL SELECT 3, 'expect_column_values_to_be_positive(l_quantity)', avg(CAST(l_quantity > 0 AS INTEGER)) >= 1,
  'warning', round(avg(CAST(l_quantity > 0 AS INTEGER)), 6) FROM lineitem
UNION ALL SELECT 4, 'expect_column_values_to_be_positive(l_tax)', avg(CAST(l_tax > 0 AS INTEGER)) >= 0.95,
  'warning', round(avg(CAST(l_tax > 0 AS INTEGER)), 6) FROM lineitem"""
)
def expectation_own(spark, folder):
    """Columns that are there or not, and a check of one's own that holds and one that fails."""
    suite = expectations.Suite("lineitem")
    for check in (
        expectations.ColumnExists("l_tax"),
        expectations.ColumnExists("l_missing"),
        Positive("l_quantity"),
        Positive("l_tax", mostly=0.95),
    ):
        suite.expect(check)
    share = F.col("details")["share"].cast("double").alias("share")
    results = suite.results(table(spark, folder, "lineitem"))
    return results.select("check_id", "check_name", "passed", "severity", share)


MEMBERS = [("l_orderkey", "orders", "o_orderkey", "o_orderstatus = 'F'", 0.4), ("l_suppkey", "supplier", "s_suppkey", "s_suppkey > 0", 1.0), ("l_partkey", "part", "p_partkey", "p_size > 25", 0.9)]


def _member_sql(i: int, c: str, other: str, key: str, rule: str, mostly: float) -> str:
    inside = f"{c} IN (SELECT {key} FROM {other} WHERE {rule})"
    return f"""SELECT {i + 1} AS check_id, 'expect_column_values_to_be_in_set({c})' AS check_name,
  avg(({inside})::INTEGER) >= {mostly} AS passed, round(avg(({inside})::INTEGER), 6) AS share,
  count(*) FILTER (WHERE NOT {inside}) AS outside,
  (SELECT coalesce(string_agg(v, ',' ORDER BY v), '') FROM (
    SELECT DISTINCT {c}::VARCHAR AS v FROM lineitem WHERE NOT {inside} ORDER BY v LIMIT 10)) AS unexpected
FROM lineitem"""


@query(" UNION ALL ".join(_member_sql(i, *m) for i, m in enumerate(MEMBERS)))
def expectation_tables(spark, folder):
    """Keys of the lines against sets that are tables: most, all and too few inside."""
    suite = expectations.Suite("lineitem")
    for column, other, key, rule, mostly in MEMBERS:
        allowed = table(spark, folder, other).where(rule)
        suite.expect(expectations.InTable(column, allowed, key, mostly))
    details = F.col("details")
    return suite.results(table(spark, folder, "lineitem")).select(
        "check_id",
        "check_name",
        "passed",
        details["in_set_ratio"].cast("double").alias("share"),
        details["out_of_set_count"].cast("bigint").alias("outside"),
        details["unexpected_values"].alias("unexpected"),
    )


PROFILED = {
    "none": ("SELECT o_orderkey FROM orders WHERE o_orderkey < 0", ["o_orderkey"]),
    "repeated": ("SELECT l_returnflag, l_linestatus FROM lineitem", ["l_returnflag", "l_linestatus"]),
    "holes": (
        """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate END AS a,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS b FROM orders""",
        ["o_orderkey", "a", "b"],
    ),
}


def _profile_sql(name: str) -> str:
    rows, cols = PROFILED[name]
    blanks = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in cols)
    return f"""SELECT '{name}' AS input, n AS row_count, {len(cols)} AS column_count, CAST(m AS BIGINT) AS missing_cells,
  n - d AS duplicate_rows, concat_ws('; ', CASE WHEN n = 0 THEN 'Empty dataset' END,
    CASE WHEN n - d > n * 0.1::DOUBLE THEN 'High duplicate rate' END,
    CASE WHEN m > n * {len(cols)} * 0.2::DOUBLE THEN 'High missing value rate' END) AS issues
FROM (SELECT count(*) AS n, {blanks} AS m, (SELECT count(*) FROM (SELECT DISTINCT * FROM ({rows}))) AS d FROM ({rows}))"""


@query(" UNION ALL ".join(f"({_profile_sql(name)})" for name in PROFILED))
def quality_issues(spark, folder):
    """Profiles of an empty selection, of repeated rows and of rows with many holes."""
    orders, lines = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    even = F.col("o_orderkey") % 2 == 0
    inputs = {
        "none": orders.where("o_orderkey < 0").select("o_orderkey"),
        "repeated": lines.select("l_returnflag", "l_linestatus"),
        "holes": orders.select(
            "o_orderkey",
            F.when(even, F.col("o_orderdate")).alias("a"),
            F.when(even, F.col("o_orderstatus")).alias("b"),
        ),
    }
    reports = [
        profile.quality_report(df).select(F.lit(name).alias("input"), "*").drop("passed")
        for name, df in inputs.items()
    ]
    return reports[0].union(reports[1]).union(reports[2])


@query(on_subs("SELECT * FROM subs"))
def csv_round_trip(spark, folder):
    """Written as headed CSV and read back with the declared schema."""
    path = fresh_path(spark, "csv")
    files.write_csv(subscribers(spark, folder), path)
    return files.read_csv(spark, path, SUBSCRIBER_DDL)


@query(
    on_clean("SELECT label, count(*) AS n, round(sum(\"MonthlyCharges\"), 2) AS charges FROM clean GROUP BY 1")
)
def cleaned_csv_totals(spark, folder):
    """The cleaned table after a CSV round trip."""
    path = fresh_path(spark, "clean-csv")
    df = clean_subscribers(spark, folder)
    files.write_csv(df, path)
    read = files.read_csv(spark, path, df.schema.simpleString()[7:-1].replace(":", " "))
    return read.groupBy("label").agg(
        F.count("*").alias("n"), F.round(F.sum("MonthlyCharges"), 2).alias("charges")
    )
