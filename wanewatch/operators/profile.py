"""Table profile: counts, missing cells, duplicates, target distribution, issues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanewatch.operators.clean import duplicate_count

# Share of duplicate rows and of missing cells above which a table fails.
DUPLICATE_LIMIT, MISSING_LIMIT = 0.1, 0.2


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def missing_counts(df: DataFrame) -> DataFrame:
    """(column, missing) rows from one aggregate pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in df.columns]
    return counts.select(F.inline(F.array(*pairs)))


def quality_report(df: DataFrame) -> DataFrame:
    """One row: row_count, column_count, missing_cells, duplicate_rows, issues, passed.

    Rows are grouped once; the group sizes give the row count, the duplicates and,
    weighted by size, the missing cells.
    """
    names = df.columns
    blanks = sum((F.col(c).isNull().cast("int") for c in names), F.lit(0))
    groups = df.groupBy(*names).agg(F.count("*").alias("_n"))
    totals = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.lit(len(names)).alias("column_count"),
        F.coalesce(F.sum(F.col("_n") * blanks), F.lit(0)).alias("missing_cells"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
    )
    empty = F.col("row_count") == 0
    cells = F.col("row_count") * F.col("column_count")
    issues = F.array_compact(
        F.array(
            F.when(empty, "Empty dataset"),
            F.when(
                F.col("duplicate_rows") > F.col("row_count") * DUPLICATE_LIMIT,
                "High duplicate rate",
            ),
            F.when(
                F.try_divide(F.col("missing_cells"), cells) > MISSING_LIMIT,
                "High missing value rate",
            ),
        )
    )
    return totals.withColumn("issues", F.array_join(issues, "; ")).withColumn(
        "passed", F.col("issues") == ""
    )


def target_distribution(df: DataFrame, target: str = "Churn") -> DataFrame:
    """Counts by value, NULL left out; no rows when the target is absent."""
    if target not in df.columns:
        return df.sparkSession.createDataFrame([], "value string, n bigint")
    return (
        df.where(F.col(target).isNotNull())
        .groupBy(F.col(target).cast("string").alias("value"))
        .agg(F.count("*").alias("n"))
    )


def profile(df: DataFrame, target: str = "Churn") -> dict[str, DataFrame]:
    """The four parts of a stand-alone quality run."""
    return {
        "report": quality_report(df),
        "missing": missing_counts(df),
        "duplicates": duplicate_count(df),
        "target": target_distribution(df, target),
    }
