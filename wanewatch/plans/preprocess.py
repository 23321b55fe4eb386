"""Feature preparation as a fitted pipeline of built-in stages."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanewatch.operators.clean import impute, medians, modes, numeric_columns, text_columns
from wanewatch.operators.features import (
    categories,
    hasher_stage,
    one_hot_stages,
    scale_statistics,
)
from wanewatch.functions.scalars import HASH_DIGITS, HASH_SPAN

FEATURES = "features"

# Columns of the named preprocessor.
NUMERIC = ["tenure", "MonthlyCharges", "TotalCharges"]
CATEGORICAL = [
    "gender",
    "SeniorCitizen",
    "Partner",
    "Dependents",
    "PhoneService",
    "MultipleLines",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
    "PaperlessBilling",
]


@dataclass
class FeatureSpec:
    """Which column is prepared how."""

    numeric: list[str]
    categorical: list[str]
    hashed: dict[str, int] = field(default_factory=dict)
    embedded: dict[str, int] = field(default_factory=dict)
    seed: int = 42


def named_spec() -> FeatureSpec:
    """Scaled numbers, one-hot services, hashed payment method, embedded contract and net."""
    return FeatureSpec(
        NUMERIC, CATEGORICAL, {"PaymentMethod": 8}, {"Contract": 4, "InternetService": 4}
    )


def generic_spec(df: DataFrame, skip: tuple[str, ...] = ("customerID", "label", "Churn")):
    """All numbers scaled, all texts one-hot."""
    return FeatureSpec(
        [c for c in numeric_columns(df) if c not in skip],
        [c for c in text_columns(df) if c not in skip],
    )


def _quote(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fit_preprocessor(df: DataFrame, spec: FeatureSpec) -> PipelineModel:
    """Fit on the training rows. The fitted values are literals in the stages, so the
    result saves, loads and applies as one projection without a join."""
    numeric = [c for c in spec.numeric if c in df.columns]
    plain = [c for c in spec.categorical if c in df.columns]
    hashed = {c: n for c, n in spec.hashed.items() if c in df.columns}
    embedded = {c: n for c, n in spec.embedded.items() if c in df.columns}
    middle = medians(df, numeric)
    common = modes(df, plain)
    filled = impute(
        df.select(*[F.col(c).cast("double").alias(c) for c in numeric]), middle
    )
    scale = scale_statistics(filled, numeric) if numeric else {}
    pieces, inputs = ["*"], []
    for c in numeric:
        mean, deviation = scale[c]
        value = f"coalesce(cast(`{c}` as double), {middle[c] or 0.0!r}D)"
        pieces.append(f"({value} - {mean or 0.0!r}D) / {deviation or 1.0!r}D as `{c}_scaled`")
        inputs.append(f"{c}_scaled")
    for c in plain:
        blank = _quote(common[c]) if common[c] is not None else "''"
        pieces.append(f"coalesce(cast(`{c}` as string), {blank}) as `{c}_text`")
    for c in hashed:
        pieces.append(f"coalesce(cast(`{c}` as string), 'nan') as `{c}_token`")
    # one-hot columns are left to the indexer, which sets no limit on the vocabulary
    known = categories(df, sorted(embedded)) if embedded else {}
    for c, dim in embedded.items():
        listed = ", ".join(_quote(v) for v in known[c]) or "''"
        limit = (6.0 / (1 + dim)) ** 0.5
        for i in range(dim):
            digest = f"substring(md5(concat('{spec.seed}|', `{c}`, '|{i}')), 1, {HASH_DIGITS})"
            unit = f"cast(conv({digest}, 16, 10) as bigint) / {float(HASH_SPAN)!r}D"
            pieces.append(
                f"case when `{c}` in ({listed}) then {unit} * {2 * limit!r}D - {limit!r}D "
                f"else 0D end as `{c}_e{i}`"
            )
            inputs.append(f"{c}_e{i}")
    stages = [SQLTransformer(statement=f"select {', '.join(pieces)} from __THIS__")]
    if plain:
        texts = [f"{c}_text" for c in plain]
        stages += one_hot_stages(texts)
        inputs += [f"{t}_hot" for t in texts]
    for c, width in hashed.items():
        stages.append(hasher_stage(f"{c}_token", width))
        inputs.append(f"{c}_token_hash")
    stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES, handleInvalid="error"))
    return Pipeline(stages=stages).fit(df)


def feature_table(df: DataFrame, model: PipelineModel, key: str, label: str) -> DataFrame:
    """(key, features, label); everything else is dropped."""
    return model.transform(df).select(
        F.col(key).alias("key"), FEATURES, F.col(label).cast("int").alias("label")
    )
