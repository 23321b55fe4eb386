"""Business rules that score a subscriber without a model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Risk points in hundredths, base rate and ceiling in hundredths.
TENURE_POINTS, TENURE_BELOW, TENURE_DEFAULT = 25, 6, 12
CONTRACT_POINTS, CONTRACT_RISK, CONTRACT_DEFAULT = 20, "Month-to-month", "Two year"
CHARGES_POINTS, CHARGES_ABOVE, CHARGES_DEFAULT = 15, 70, 50
SUPPORT_POINTS = 10
FIBER_POINTS = 15
PAYMENT_POINTS, PAYMENT_RISK = 10, "Electronic check"
BASE_POINTS, CEILING_POINTS = 27, 95


def rule_points(columns: list[str]) -> Column:
    """Risk in hundredths with the base rate added and the ceiling applied.

    A column missing from ``columns`` counts as a missing value.
    """

    def value(name: str, default=None) -> Column:
        fallback = F.lit(default)
        return F.coalesce(F.col(name), fallback) if name in columns else fallback

    def points(test: Column, n: int) -> Column:
        return F.when(test, n).otherwise(0)

    total = (
        points(value("tenure", TENURE_DEFAULT) < TENURE_BELOW, TENURE_POINTS)
        + points(value("Contract", CONTRACT_DEFAULT) == CONTRACT_RISK, CONTRACT_POINTS)
        + points(value("MonthlyCharges", CHARGES_DEFAULT) > CHARGES_ABOVE, CHARGES_POINTS)
        + points(value("TechSupport") == "No", SUPPORT_POINTS)
        + points(
            (value("InternetService") == "Fiber optic") & (value("OnlineSecurity") == "No"),
            FIBER_POINTS,
        )
        + points(value("PaymentMethod") == PAYMENT_RISK, PAYMENT_POINTS)
    )
    return F.least(total + BASE_POINTS, F.lit(CEILING_POINTS))


def rule_probability(columns: list[str]) -> Column:
    return rule_points(columns) / F.lit(100.0)


def rule_prediction(columns: list[str]) -> Column:
    return (rule_points(columns) > 50).cast("int")


def base_rate() -> tuple[Column, Column]:
    """Prediction and probability of the historical base rate."""
    return F.lit(0), F.lit(BASE_POINTS / 100.0)
