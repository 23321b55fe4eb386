"""Cleaning: number coercion, label mapping, imputation, duplicates, column sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanewatch.functions import scalars
from wanewatch.operators.order_stats import medians


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def coerce_total(df: DataFrame, column: str = "TotalCharges") -> DataFrame:
    """Text to number; a column that is numeric already stays as it is."""
    if column in df.columns and column in text_columns(df):
        return df.withColumn(column, scalars.to_number(column))
    return df


def drop_missing_label(df: DataFrame, label: str) -> DataFrame:
    return df.na.drop(subset=[label])


def clean(
    df: DataFrame,
    *,
    keep_key: bool = False,
    key: str = "customerID",
    target: str = "Churn",
    drop_before_map: bool = False,
) -> DataFrame:
    """Coerce, deduplicate whole rows, drop the key, map the target and drop missing ones.

    ``drop_before_map`` drops NULL targets before mapping, so an unmapped value survives
    as a NULL label; the default maps first and drops both.
    """
    df = coerce_total(df).dropDuplicates()
    if not keep_key:
        df = df.drop(key)
    if target not in df.columns:
        return df
    if drop_before_map:
        df = drop_missing_label(df, target)
    mapped = (
        scalars.label_map(target) if target in text_columns(df) else F.col(target).cast("int")
    )
    df = df.select(*[c for c in df.columns if c != target], mapped.alias("label"))
    return df if drop_before_map else drop_missing_label(df, "label")


def preprocess(df: DataFrame, key: str = "customerID", target: str = "Churn") -> DataFrame:
    """Variant without duplicate removal: median TotalCharges and a Yes-or-zero target."""
    df = coerce_total(df.drop(key))
    df = impute(df, {"TotalCharges": medians(df, ["TotalCharges"])["TotalCharges"]})
    return df.withColumn(target, scalars.label_flag(target)) if target in df.columns else df


def modes(df: DataFrame, cols: list[str]) -> dict[str, str | None]:
    """Most frequent value per column, smallest on ties.

    Counted by (column, value) with map-side partial sums. Every task keeps its best value
    per column before the last comparison; one winner per column returns.
    """
    if not cols:
        return {}
    pairs = [F.struct(F.lit(c).alias("g"), F.col(c).cast("string").alias("v")) for c in cols]
    counts = (
        df.select(F.inline(F.array(*pairs)))
        .where(F.col("v").isNotNull())
        .groupBy("g", "v")
        .agg(F.count("*").alias("n"))
    )
    w = Window.partitionBy("g").orderBy(F.col("n").desc(), "v")
    winners = counts.withColumn("place", F.row_number().over(w)).where(F.col("place") == 1)
    found = {r["g"]: r["v"] for r in winners.collect()}
    return {c: found.get(c) for c in cols}


def impute(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace NULL by the fitted value of the column."""
    filled = {
        c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
        for c, v in values.items()
        if v is not None and c in df.columns
    }
    return df.withColumns(filled) if filled else df


def impute_all(df: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """Medians for numeric columns (as double) and modes for text columns."""
    numbers = [c for c in numeric_columns(df) if c not in skip]
    texts = [c for c in text_columns(df) if c not in skip]
    df = df.withColumns({c: F.col(c).cast("double") for c in numbers}) if numbers else df
    return impute(df, {**medians(df, numbers), **modes(df, texts)})


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier one."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def column_set(df: DataFrame, expected: list[str], exact: bool = False) -> dict[str, object]:
    """Missing and (exact only) extra columns, sorted."""
    actual, wanted = set(df.columns), set(expected)
    extra = sorted(actual - wanted) if exact else []
    missing = sorted(wanted - actual)
    return {"passed": not missing and not extra, "missing": missing, "extra": extra}


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """One row; ``approximate`` trades exactness for a sketch."""
    count = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
    return df.agg(count.alias("distinct_values"))
