"""Fallback ladder: models, then rules, then the base rate, then a fixed answer."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanewatch.functions import rules, scalars

CONFIDENCE = 0.3
ULTIMATE = "ultimate_fallback"
# Reasons a result may carry; the ladder itself gives model_error and low_confidence.
REASONS = [
    "model_error",
    "timeout",
    "invalid_input",
    "low_confidence",
    "drift_detected",
    "resource_exhausted",
]


@dataclass
class Handler:
    """Name, prediction and probability columns, and whether the handler answered.

    ``prepare`` adds those columns to a table, e.g. by a model's ``transform``.
    """

    name: str
    prediction: Column
    probability: Column
    ok: Column | None = None
    prepare: Callable[[DataFrame], DataFrame] | None = None


def ladder(
    handlers: list[Handler],
    confidence: float = CONFIDENCE,
    symmetric: bool = False,
) -> Column:
    """Struct of the first accepted answer.

    A handler is accepted when it answered and its probability is NULL or reaches the
    threshold. ``symmetric`` compares the larger of p and 1 - p instead of p.
    """
    n = len(handlers)
    chosen = F
    for i, h in enumerate(handlers):
        p = h.probability
        level = F.greatest(p, 1 - p) if symmetric else p
        accepted = F.coalesce(level >= confidence, F.lit(True))
        if h.ok is not None:
            accepted = F.coalesce(h.ok, F.lit(False)) & accepted
        chosen = chosen.when(accepted, _answer(h.name, h.prediction, p, i, n))
    last = F.struct(
        F.lit(0).alias("prediction"),
        F.lit(0.5).alias("probability"),
        F.lit(ULTIMATE).alias("model_used"),
        F.lit(True).alias("is_fallback"),
        F.lit("model_error").alias("fallback_reason"),
        F.create_map(F.lit("error"), F.lit("all_handlers_failed")).alias("metadata"),
    )
    return chosen.otherwise(last) if handlers else last


def _answer(name: str, prediction: Column, p: Column, i: int, n: int) -> Column:
    return F.struct(
        prediction.cast("int").alias("prediction"),
        p.cast("double").alias("probability"),
        F.lit(name).alias("model_used"),
        F.lit(i > 0).alias("is_fallback"),
        F.lit("low_confidence" if i > 0 else None).cast("string").alias("fallback_reason"),
        F.create_map(
            F.lit("handler_index"),
            F.lit(str(i)),
            F.lit("total_handlers"),
            F.lit(str(n)),
        ).alias("metadata"),
    )


class FallbackChain:
    """Ordered handlers applied to a table; batch and stream share ``predict``."""

    def __init__(self, confidence: float = CONFIDENCE, symmetric: bool = False):
        self.confidence = confidence
        self.symmetric = symmetric
        self.handlers: list[Handler] = []

    def add_handler(self, handler: Handler) -> "FallbackChain":
        self.handlers.append(handler)
        return self

    def predict(
        self, df: DataFrame, at: Column | None = None, latency: Column | None = None
    ) -> DataFrame:
        """Add prediction, probability, model_used, is_fallback, fallback_reason, metadata,
        latency_ms and timestamp; helper columns of the handlers go."""
        kept = df.columns
        for h in self.handlers:
            if h.prepare is not None:
                df = h.prepare(df)
        answered = df.withColumn("_r", ladder(self.handlers, self.confidence, self.symmetric))
        return answered.select(
            *[F.col(c) for c in kept],
            "_r.*",
            (F.lit(None) if latency is None else latency).cast("double").alias("latency_ms"),
            (F.current_timestamp() if at is None else at).alias("timestamp"),
        )

    def usage(self, results: DataFrame) -> DataFrame:
        return handler_usage(results, [h.name for h in self.handlers])


def churn_ladder(
    columns: list[str],
    primary: Handler | None = None,
    secondary: Handler | None = None,
    **options,
) -> FallbackChain:
    """Primary, secondary, rules, base rate; models that are absent are skipped."""
    chain = FallbackChain(**options)
    for handler in (primary, secondary):
        if handler is not None:
            chain.add_handler(handler)
    chain.add_handler(
        Handler("rules_based", rules.rule_prediction(columns), rules.rule_probability(columns))
    )
    prediction, probability = rules.base_rate()
    return chain.add_handler(Handler("base_rate", prediction, probability))


def column_handler(name: str, probability: str) -> Handler:
    """Handler over a stored probability column; NULL or NaN means the model failed."""
    p = F.col(probability)
    return Handler(name, scalars.positive(p), p, ok=p.isNotNull() & ~F.isnan(p))


def model_handler(name: str, model, probability: str = "probability") -> Handler:
    """Handler over a fitted pipeline that writes a probability vector."""
    from pyspark.ml.functions import vector_to_array

    column = f"_{name}_p"

    def prepare(df: DataFrame) -> DataFrame:
        scored = model.transform(df)
        added = vector_to_array(F.col(probability))[1].alias(column)
        return scored.select(*[F.col(c) for c in df.columns], added)

    p = F.col(column)
    return Handler(name, scalars.positive(p), p, ok=p.isNotNull() & ~F.isnan(p), prepare=prepare)


def handler_usage(results: DataFrame, names: list[str]) -> DataFrame:
    """(model_used, uses, fallback_rate): the fixed answer is neither listed nor in the rate."""
    used = F.col("model_used")
    rest = [n for n in names[1:]]
    sums = [F.count_if(used == n).alias(f"u{i}") for i, n in enumerate(names)]
    total = F.greatest(F.count("*"), F.lit(1))
    row = results.agg(
        *sums, (F.count_if(used.isin(rest)) / total if rest else F.lit(0.0)).alias("rate")
    )
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("model_used"),
                        F.col(f"u{i}").alias("uses"),
                        F.col("rate").alias("fallback_rate"),
                    )
                    for i, n in enumerate(names)
                ]
            )
        )
    )


def fallback_summary(results: DataFrame) -> DataFrame:
    """One row: total, fallbacks (the fixed answer included), rate, mean latency, reasons."""
    reasons = [F.count_if(F.col("is_fallback") & (F.col("fallback_reason") == r)) for r in REASONS]
    row = results.agg(
        F.count("*").alias("total_predictions"),
        F.count_if("is_fallback").alias("fallback_count"),
        F.coalesce(F.avg("latency_ms"), F.lit(0.0)).alias("avg_latency_ms"),
        *[c.alias(f"_{r}") for r, c in zip(REASONS, reasons)],
    )
    entries = F.array(
        *[F.struct(F.lit(r).alias("k"), F.col(f"_{r}").alias("n")) for r in REASONS]
    )
    return row.select(
        "total_predictions",
        "fallback_count",
        (F.col("fallback_count") / F.greatest("total_predictions", F.lit(1))).alias(
            "fallback_rate"
        ),
        "avg_latency_ms",
        F.map_from_entries(F.filter(entries, lambda e: e["n"] > 0)).alias("fallback_reasons"),
    )


def respond(results: DataFrame) -> DataFrame:
    """Shape of an answer sent to a caller."""
    return results.withColumn("probability", scalars.response_probability("probability"))
