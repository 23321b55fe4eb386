import json

import pytest
from pyspark.sql import functions as F

from wanewatch.operators import clean, expectations as ex, profile
from wanewatch.sources import files
from wanewatch.sources.subscribers import SUBSCRIBER_DDL, subscribers


def outcome(df, check):
    return ex.run_checks(df, [check]).first()


def numbers(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def test_range_check_ignores_nulls(spark):
    row = outcome(numbers(spark, [1.0, None, 3.0, 4.0]), ex.Between("x", 0, 10))
    assert row["passed"] and row["details"]["in_range_ratio"] == "1.0"
    row = outcome(numbers(spark, [1.0, 20.0]), ex.Between("x", 0, 10, mostly=0.6))
    assert not row["passed"] and row["details"]["out_of_range_count"] == "1"


def test_not_null_severity(spark):
    df = numbers(spark, [1.0, None, 3.0, 4.0])
    row = outcome(df, ex.NotNull("x", 0.5))
    assert row["passed"] and row["severity"] == "warning"
    row = outcome(df, ex.NotNull("x"))
    assert not row["passed"] and row["severity"] == "error"


def test_absent_column(spark):
    for check in (ex.NotNull("gone"), ex.Unique("gone"), ex.InSet("gone", ["a"]), ex.OfType("gone")):
        row = outcome(numbers(spark, [1.0]), check)
        assert not row["passed"] and row["details"] == {"error": "column not found"}
    assert not outcome(numbers(spark, [1.0]), ex.ColumnExists("gone"))["passed"]


def test_empty_table_fails_ratio_checks(spark):
    df = numbers(spark, [])
    checks = [ex.NotNull("x"), ex.Between("x", 0, 1), ex.InSet("x", [1.0]), ex.Unique("x")]
    assert [r["passed"] for r in ex.run_checks(df, checks).collect()] == [False] * 4


def test_mean_of_nothing_passes(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert outcome(df, ex.MeanBetween("x", 10, 50))["passed"]


def test_unexpected_values_are_the_first_ten_sorted(spark):
    df = spark.createDataFrame([(f"v{i:02d}",) for i in range(30)], "c string")
    row = outcome(df, ex.InSet("c", ["v00"]))
    assert row["details"]["unexpected_values"].split(",") == [f"v{i:02d}" for i in range(1, 11)]


def test_types_and_sets(spark):
    df = spark.createDataFrame([(1, "a", True)], "i int, s string, b boolean")
    checks = [ex.OfType("i", "int"), ex.OfType("s", "string"), ex.OfType("b", "bool"),
              ex.OfType("i", "float"), ex.OfType("i", "int32"), ex.ColumnsMatch(columns=["i"]),
              ex.ColumnsMatch(columns=["i"], exact=True), ex.RowCountBetween(low=1, high=1)]
    found = [r["passed"] for r in ex.run_checks(df, checks).collect()]
    assert found == [True, True, True, False, False, True, False, True]


def test_suite_report_and_custom_check(spark):
    class Positive(ex.Check):
        title = "expect_positive"

        def aggregates(self, df):
            return {"low": F.min(self.column)}

        def outcome(self, df, at):
            return at("low") > 0, {"low": at("low")}, F.lit("error")

    suite = ex.Suite("mine").expect(Positive("x")).expect(ex.NotNull("x"))
    report = suite.run(numbers(spark, [1.0, 2.0]))
    parsed = json.loads(report.to_json())
    assert parsed["overall_success"] and parsed["total_checks"] == 2
    assert json.loads(report.document().first()["report"])["passed_checks"] == 2
    suite.clear()
    assert suite.checks == []


def test_subscriber_suite_has_24_checks(spark):
    df = subscribers(spark, "/root/testdata/sf0.001")
    report = ex.validate_subscribers(df)
    assert report.results.count() == 24
    summary = ex.summarise(report.results).first()
    assert summary["passed_checks"] + summary["failed_checks"] == 24
    assert not summary["overall_success"]


def test_quality_issues(spark):
    empty = spark.createDataFrame([], "Churn string")
    row = profile.quality_report(empty).first()
    assert row["issues"] == "Empty dataset" and not row["passed"]
    twice = spark.createDataFrame([("Yes",)] * 5, "Churn string")
    row = profile.quality_report(twice).first()
    assert row["duplicate_rows"] == 4 and row["issues"] == "High duplicate rate"
    blank = spark.createDataFrame([("a", None), ("b", None)], "Churn string, x string")
    assert profile.quality_report(blank).first()["issues"] == "High missing value rate"
    assert set(profile.profile(blank)) == {"report", "missing", "duplicates", "target"}


def test_order_of_drop_and_map(spark):
    rows = [("1", "5", "Yes"), ("2", "6", "Unknown"), ("3", " ", None), ("1", "5", "Yes")]
    df = spark.createDataFrame(rows, "customerID string, TotalCharges string, Churn string")
    assert clean.clean(df).count() == 1
    kept = clean.clean(df, drop_before_map=True)
    assert sorted(str(r["label"]) for r in kept.collect()) == ["1", "None"]
    made = clean.preprocess(df)
    assert made.count() == 4 and made.where("TotalCharges is null").count() == 0


def test_csv_blank_becomes_null(spark, tmp_path):
    df = subscribers(spark, "/root/testdata/sf0.001")
    files.write_csv(df, str(tmp_path / "t"))
    read = files.read_csv(spark, str(tmp_path / "t"), SUBSCRIBER_DDL)
    assert read.count() == df.count()
    assert read.where("gender is null").count() == df.where("gender is null").count()
    guessed = files.read_csv(spark, str(tmp_path / "t"))
    assert dict(guessed.dtypes)["tenure"] == "int"


def test_empty_log_is_not_written(spark, tmp_path):
    df = spark.createDataFrame([], "a int")
    assert not files.append_log(df, str(tmp_path / "log"))
    one = spark.createDataFrame([(1,)], "a int")
    assert files.append_log(one, str(tmp_path / "log")) and files.append_log(one, str(tmp_path / "log"))
    assert files.read_log(spark, str(tmp_path / "log"), "a int").count() == 2


@pytest.mark.parametrize("approximate", [False, True])
def test_distinct(spark, approximate):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    assert clean.distinct_count(df, "c", approximate).first()[0] == 2
    assert clean.distinct_values(df, "c").count() == 2


def test_membership_in_a_table_of_100_000_values(spark):
    """A hot value, NULLs, values outside, another type, a set beyond the broadcast bound, no rows."""
    allowed = spark.range(100_001).select((F.col("id") * 2).cast("string").alias("v"))
    rows = [4] * 500 + [None] * 20 + list(range(0, 200)) + [999_999]
    df = spark.createDataFrame([(x,) for x in rows], "k bigint")
    results = ex.run_checks(df, [ex.InTable("k", allowed, "v", 0.85), ex.InTable("gone", allowed, "v"), ex.NotNull("k")])
    first, gone, last = results.orderBy("check_id").collect()
    assert first["passed"] and not gone["passed"] and not last["passed"]
    assert first["details"]["in_set_ratio"] == str(round(600 / 701, 6)) and first["details"]["out_of_set_count"] == "101"
    outside = sorted(str(x) for x in [*range(1, 200, 2), 999_999])[:10]
    assert first["details"]["unexpected_values"] == ",".join(outside)
    few = ex.run_checks(df, [ex.InTable("k", allowed.where("v = '4'"), "v", 1.0), ex.InSet("k", [4], 1.0)]).orderBy("check_id").collect()
    assert few[0]["details"]["in_set_ratio"] == few[1]["details"]["in_set_ratio"]
    assert few[0]["details"]["unexpected_values"] == few[1]["details"]["unexpected_values"]
    empty = ex.run_checks(df.limit(0), [ex.InTable("k", allowed, "v")]).first()
    assert not empty["passed"] and empty["details"]["unexpected_values"] == ""
