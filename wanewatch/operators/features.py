"""Feature operators: scaling, one-hot, dummies, label, hashed and embedded categories."""

from __future__ import annotations

import math
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, StringIndexer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wanewatch.functions import scalars
from wanewatch.session import cut_lineage, lookup_join

# Categories turned into literal columns; wider vocabularies use ``one_hot_sparse``.
WIDE_CATEGORIES = 1_000
# Sorted values numbered by one task of a dictionary.
DICTIONARY_RANGE = 50_000
MISSING_CATEGORY = "nan"


def scale_statistics(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of every column from one aggregate row."""
    row = df.agg(
        *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)],
    ).first()
    return {c: (row[f"m_{i}"], row[f"s_{i}"]) for i, c in enumerate(cols)}


def standardise(df: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / deviation; a constant column is only centred."""
    scaled = {}
    for c, (mean, deviation) in fitted.items():
        if mean is None:
            continue
        scaled[c] = (F.col(c) - F.lit(mean)) / F.lit(deviation or 1.0)
    return df.withColumns(scaled)


def categories(df: DataFrame, cols: list[str], limit: int = WIDE_CATEGORIES) -> dict[str, list[str]]:
    """Sorted distinct values per column, fetched only while they stay within ``limit``."""
    pairs = [F.struct(F.lit(c).alias("g"), F.col(c).cast("string").alias("v")) for c in cols]
    rows = (
        df.select(F.inline(F.array(*pairs)))
        .where(F.col("v").isNotNull())
        .distinct()
        .take(limit * len(cols) + 1)
    )
    found = {c: sorted(r["v"] for r in rows if r["g"] == c) for c in cols}
    wide = [c for c, values in found.items() if len(values) > limit]
    if wide or len(rows) > limit * len(cols):
        raise ValueError(f"too many categories for one column each, use one_hot_sparse: {wide or cols}")
    return found


def one_hot_columns(df: DataFrame, fitted: dict[str, list[str]]) -> DataFrame:
    """One 0/1 column per fitted category; unseen values and NULL are all zero."""
    wide = {
        f"{c}={v}": F.coalesce((F.col(c).cast("string") == v).cast("int"), F.lit(0))
        for c, values in fitted.items()
        for v in values
    }
    return df.withColumns(wide)


def one_hot_stages(cols: list[str]) -> list:
    """Sparse-vector form for pipelines: the keep bucket is last and dropped."""
    indexed = [f"{c}_index" for c in cols]
    return [
        StringIndexer(
            inputCols=cols,
            outputCols=indexed,
            stringOrderType="alphabetAsc",
            handleInvalid="keep",
        ),
        OneHotEncoder(inputCols=indexed, outputCols=[f"{c}_hot" for c in cols], dropLast=True),
    ]


def dummies(df: DataFrame, fitted: dict[str, list[str]]) -> DataFrame:
    """0/1 columns for all but the first sorted category; the source column goes."""
    wide = one_hot_columns(df, {c: values[1:] for c, values in fitted.items()})
    return wide.select(
        *[c for c in df.columns if c not in fitted],
        *[F.col(f"`{c}={v}`").alias(f"{c}_{v}") for c, values in fitted.items() for v in values[1:]],
    )


def label_codes(df: DataFrame, column: str, range_rows: int = DICTIONARY_RANGE) -> DataFrame:
    """(category, code): position of each category in sorted order, NULL counted as nan.

    The distinct values are dealt into ranges of about ``range_rows`` sorted values and written;
    a code is the place inside the range plus the sizes of the ranges before it.
    """
    values = cut_lineage(
        df.select(
            F.coalesce(scalars.text(column), F.lit(MISSING_CATEGORY)).alias("category")
        ).distinct()
    )
    ranges = max(1, math.ceil(values.count() / range_rows))
    dealt = cut_lineage(
        values.repartitionByRange(ranges, "category").withColumn("__range", F.spark_partition_id())
    )
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("__range")
        .agg(F.count("*").alias("n"))
        .select("__range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__offset"))
    )
    place = F.row_number().over(Window.partitionBy("__range").orderBy("category")) - 1
    return (
        lookup_join(dealt.withColumn("__place", place), offsets, "__range")
        .select("category", (F.col("__offset") + F.col("__place")).cast("bigint").alias("code"))
    )


def one_hot_sparse(
    df: DataFrame, codes: dict[str, DataFrame], *, drop_first: bool = False
) -> DataFrame:
    """One-hot columns of any width: ``<c>_hot`` is a struct of size, indices and values.

    ``codes`` are tables of ``label_codes``. An unseen value has no index. ``drop_first`` leaves
    out the first category, as ``dummies`` does. The source columns go; NULL is the category nan.
    """
    first = int(drop_first)
    for column, table in codes.items():
        width = max(table.count() - first, 0)
        value = F.coalesce(scalars.text(column), F.lit(MISSING_CATEGORY))
        side = table.select(F.col("category").alias("__category"), F.col("code").alias("__code"))
        at = (F.col("__code") - first).cast("int")
        hot = at >= 0
        vector = F.struct(
            F.lit(width).alias("size"),
            F.when(hot, F.array(at)).otherwise(F.array().cast("array<int>")).alias("indices"),
            F.when(hot, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"),
        )
        df = (
            lookup_join(df.withColumn("__category", value), side, "__category", "left")
            .withColumn(f"{column}_hot", vector)
            .drop("__category", "__code", column)
        )
    return df


def label_encode(df: DataFrame, codes: dict[str, DataFrame]) -> DataFrame:
    """Replace each column by its code."""
    for column, table in codes.items():
        keyed = df.withColumn(
            column, F.coalesce(scalars.text(column), F.lit(MISSING_CATEGORY))
        )
        renamed = table.select(F.col("category").alias(column), F.col("code").alias("_code"))
        joined = lookup_join(keyed, renamed, column, "left")
        df = joined.select(
            *[F.col("_code").alias(column) if c == column else F.col(c) for c in df.columns]
        )
    return df


def hash_bucket(column: str, width: int) -> tuple[Column, Column]:
    """Bucket and sign of the token ``column=value``."""
    token = F.concat(
        F.lit(f"{column}="), F.coalesce(scalars.text(column), F.lit(MISSING_CATEGORY))
    )
    digest = F.md5(token)
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % width
    sign = F.when(F.substring(digest, 9, 1) < "8", 1).otherwise(-1)
    return bucket, sign


def hash_encode(df: DataFrame, column: str, width: int = 256) -> DataFrame:
    """Add ``<column>_hash``: zeros with the sign at the bucket of the value."""
    bucket, sign = hash_bucket(column, width)
    vector = F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda i: F.when(i == bucket, sign.cast("double")).otherwise(F.lit(0.0)),
    )
    return df.withColumn(f"{column}_hash", vector)


def hasher_stage(column: str, width: int) -> FeatureHasher:
    """Sparse built-in form for pipelines."""
    return FeatureHasher(
        inputCols=[column], outputCol=f"{column}_hash", numFeatures=width, categoricalCols=[column]
    )


def embedding_value(category: Column, i: Column, dim: int, seed: int) -> Column:
    limit = math.sqrt(6.0 / (1 + dim))
    unit = scalars.hash_unit(F.lit(str(seed)), category, i)
    return unit * F.lit(2 * limit) - F.lit(limit)


def embedding_table(df: DataFrame, column: str, dim: int = 32, seed: int = 42) -> DataFrame:
    """(category, vector): one vector per distinct value, uniform in +-sqrt(6 / (1 + dim))."""
    category = F.coalesce(scalars.text(column), F.lit(MISSING_CATEGORY)).alias("category")
    return (
        df.select(category)
        .distinct()
        .withColumn(
            "vector",
            F.array(
                *[embedding_value(F.col("category"), F.lit(i), dim, seed) for i in range(dim)]
            ),
        )
    )


def embed(df: DataFrame, column: str, fitted: DataFrame, dim: int = 32) -> DataFrame:
    """Add ``<column>_vector``; a value not in the fitted table gets zeros."""
    keyed = df.withColumn(
        "_category", F.coalesce(scalars.text(column), F.lit(MISSING_CATEGORY))
    )
    table = fitted.select(F.col("category").alias("_category"), "vector")
    zeros = F.array(*[F.lit(0.0)] * dim)
    return (
        lookup_join(keyed, table, "_category", "left")
        .withColumn(f"{column}_vector", F.coalesce("vector", zeros))
        .drop("_category", "vector")
    )


def cross_features(df: DataFrame, interactions: list[tuple[str, str]]) -> DataFrame:
    """Add ``a_x_b`` for each pair whose columns are both present."""
    wide = {
        f"{a}_x_{b}": scalars.cross(a, b)
        for a, b in interactions
        if a in df.columns and b in df.columns
    }
    return df.withColumns(wide) if wide else df


def derive(df: DataFrame) -> DataFrame:
    """Average monthly charge, tenure band and service count."""
    return df.withColumns(
        {
            "AvgMonthlyCharges": scalars.avg_monthly(),
            "tenure_group": scalars.tenure_group(),
            "service_count": scalars.service_count(df.columns),
        }
    )


def vector_sum(arrays: list[Column]) -> Column:
    return reduce(lambda a, b: F.concat(a, b), arrays)


class FeatureCrosser(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage of ``cross_features``; ``pairs`` holds texts of the form ``a|b``."""

    pairs = Param(
        Params._dummy(), "pairs", "column pairs", typeConverter=TypeConverters.toListString
    )

    @keyword_only
    def __init__(self, *, pairs: list[str] | None = None):
        super().__init__()
        self._setDefault(pairs=[])
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        chosen = [tuple(p.split("|", 1)) for p in self.getOrDefault(self.pairs)]
        return cross_features(dataset, chosen)
