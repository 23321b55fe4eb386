"""Scalar column expressions used by cleaning, features, scoring and logging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal notation accepted as a number.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# Right-closed tenure bands in months and their labels.
TENURE_BANDS = [(0, 12, "0-1yr"), (12, 24, "1-2yr"), (24, 48, "2-4yr"), (48, 72, "4yr+")]

# Columns counted by service_count.
SERVICE_COLUMNS = [
    "PhoneService",
    "MultipleLines",
    "InternetService",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
]

HASH_DIGITS = 13
HASH_SPAN = 16**HASH_DIGITS


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def to_number(c: Column | str) -> Column:
    """Number in a string, NULL when the text is not one."""
    trimmed = F.trim(text(c))
    return F.when(trimmed.rlike(NUMBER_PATTERN), trimmed.try_cast("double"))


def nan_to_null(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)


def label_map(c: Column | str) -> Column:
    """Yes is 1, No is 0, any other value is NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == "Yes", 1).when(c == "No", 0)


def label_flag(c: Column | str) -> Column:
    """Yes is 1, everything else and NULL is 0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce((c == "Yes").cast("int"), F.lit(0))


def hash_int(*parts: Column | str | int) -> Column:
    """Seeded 52-bit integer of the parts, the same in every engine with md5.

    A string names a column; pass ``F.lit`` for constant text.
    """
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit("|"))
        pieces.append(F.lit(str(part)) if isinstance(part, int) else text(part))
    digest = F.substring(F.md5(F.concat(*pieces)), 1, HASH_DIGITS)
    return F.conv(digest, 16, 10).cast("bigint")


def hash_unit(*parts: Column | str | int) -> Column:
    """Seeded number in [0, 1)."""
    return hash_int(*parts) / F.lit(float(HASH_SPAN))


def row_hash(*cols: str) -> Column:
    """Stable fingerprint of a feature row for the prediction log."""
    return F.xxhash64(*cols)


def iso_time(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def time_stamped_name(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix + "_"), F.date_format(c, "yyyyMMdd_HHmmss"))


def avg_monthly(total: Column | str = "TotalCharges", tenure: Column | str = "tenure") -> Column:
    total = F.col(total) if isinstance(total, str) else total
    tenure = F.col(tenure) if isinstance(tenure, str) else tenure
    return F.try_divide(total, tenure + 1)


def tenure_group(c: Column | str = "tenure") -> Column:
    """Band label; 0, negative and above 72 are NULL."""
    c = F.col(c) if isinstance(c, str) else c
    ladder = F
    for low, high, name in TENURE_BANDS:
        ladder = ladder.when((c > low) & (c <= high), name)
    return ladder


def service_count(columns: list[str]) -> Column:
    """Services whose value differs from No, NULL included, over the columns present."""
    present = [c for c in SERVICE_COLUMNS if c in columns]
    counted = [F.when(F.col(c).eqNullSafe("No"), 0).otherwise(1) for c in present]
    return reduce(lambda a, b: a + b, counted, F.lit(0))


def cross(a: str, b: str) -> Column:
    """Values joined by an underscore; NULL reads as nan."""
    return F.concat(
        F.coalesce(text(a), F.lit("nan")), F.lit("_"), F.coalesce(text(b), F.lit("nan"))
    )


def positive(p: Column | str, threshold: float = 0.5, inclusive: bool = False) -> Column:
    """Class of a probability: strictly above the threshold unless ``inclusive``.

    A probability that is not a number has no class.
    """
    p = nan_to_null(p)
    return ((p >= threshold) if inclusive else (p > threshold)).cast("int")


def weighted_mean(cols: list[str], weights: list[float]) -> Column:
    """Row-wise average of probability columns; weights need not add up to one."""
    total = reduce(lambda a, b: a + b, weights)
    terms = [F.col(c) * F.lit(float(w)) for c, w in zip(cols, weights)]
    return reduce(lambda a, b: a + b, terms) / F.lit(float(total))


def response_probability(p: Column | str) -> Column:
    """Probability shown to a caller: missing or zero reads as one half."""
    p = F.col(p) if isinstance(p, str) else p
    return F.when(p.isNull() | (p == 0), F.lit(0.5)).otherwise(p)


def latency_band(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c < 1, "low").when(c < 10, "moderate").otherwise("high")


def ratio(a: Column, b: Column) -> Column:
    """a / b, zero where it is undefined."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
