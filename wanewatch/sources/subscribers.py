"""The 21-column subscriber table: its schema, and a view of it over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wanewatch.functions import rules, scalars
from wanewatch.sources.tables import table

SUBSCRIBER_DDL = (
    "customerID string, gender string, SeniorCitizen int, Partner string, Dependents string, "
    "tenure int, PhoneService string, MultipleLines string, InternetService string, "
    "OnlineSecurity string, OnlineBackup string, DeviceProtection string, TechSupport string, "
    "StreamingTV string, StreamingMovies string, Contract string, PaperlessBilling string, "
    "PaymentMethod string, MonthlyCharges double, TotalCharges string, Churn string"
)
SUBSCRIBER_COLUMNS = [part.split()[0] for part in SUBSCRIBER_DDL.split(", ")]

CUTOFF, HORIZON_END = "2000-08-01 00:00:00", "2001-08-01 00:00:00"

# Net-dependent services and the md5 digit each one reads.
NET_SERVICES = {
    "OnlineSecurity": 5,
    "OnlineBackup": 6,
    "DeviceProtection": 7,
    "TechSupport": 8,
    "StreamingTV": 9,
    "StreamingMovies": 10,
}

SCORE_NAMES = ["a", "b", "c", "d"]


def subscribers(spark: SparkSession, folder: str) -> DataFrame:
    """Subscribers with an order before the cut-off; churned when none follows in a year.

    One pass over the orders that matter, aggregated by customer before the join. Dirt is
    added by key arithmetic because the star schema is clean.
    """
    cutoff = F.lit(CUTOFF).cast("timestamp_ntz")
    before = F.col("o_orderdate") < cutoff
    # Date and key of an order as one number, and its status as a code: fixed-width buffers
    # keep the aggregate hash-based, so the orders are not sorted before they are combined.
    placed = F.expr(
        "cast(timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', o_orderdate) as decimal(19,0))"
        " * 10000000000000000000bd + o_orderkey"
    )
    history = (
        table(spark, folder, "orders")
        .where(F.col("o_orderdate") < F.lit(HORIZON_END).cast("timestamp_ntz"))
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.min(F.when(before, F.col("o_orderdate"))).alias("first_at"),
            F.sum(F.when(before, F.round(F.col("o_totalprice") * 100).cast("bigint"))).alias("cents"),
            F.count_if(before).alias("n_before"),
            F.count_if(~before).alias("n_after"),
            F.max_by(F.when(before, F.ascii("o_orderstatus")), F.when(before, placed)).alias(
                "last_code"
            ),
        )
        .where(F.col("n_before") > 0)
    )
    base = (
        table(spark, folder, "customer")
        .select("c_custkey", "c_nationkey", "c_mktsegment")
        .join(history, "c_custkey")
        .join(
            table(spark, folder, "nation").select(
                F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"
            ),
            "c_nationkey",
        )
    )

    k = F.col("c_custkey")
    digest = F.md5(k.cast("string"))

    def digit(i: int) -> Column:
        return F.substring(digest, i, 1)

    def yes_no(i: int, below: str = "8") -> Column:
        return F.when(digit(i) < below, "Yes").otherwise("No")

    def every(n: int) -> Column:
        return k % n == 0

    cents = F.expr("(2 * cents + n_before * 3500) div (2 * n_before * 3500)")
    base = base.select(
        k,
        "c_nationkey",
        "c_mktsegment",
        F.char("last_code").alias("last_status"),
        "n_after",
        cents.alias("month_cents"),
        F.expr(f"cast(datediff(timestamp_ntz'{CUTOFF}', first_at) div 30 as int)").alias("months"),
        F.when(F.col("n_regionkey") % 3 == 0, "DSL")
        .when(F.col("n_regionkey") % 3 == 1, "Fiber optic")
        .otherwise("No")
        .alias("net"),
        yes_no(4, "e").alias("phone"),
    )
    total_cents = F.col("month_cents") * F.col("months")
    dotted = F.concat(
        F.expr("(month_cents * months) div 100").cast("string"),
        F.lit("."),
        F.lpad((total_cents % 100).cast("string"), 2, "0"),
    )
    net = F.col("net")
    columns = {
        "customerID": k.cast("string"),
        "gender": F.when(every(43), F.lit(None))
        .when(digit(1) < "8", "Male")
        .otherwise("Female"),
        "SeniorCitizen": (F.col("c_nationkey") % 5 == 0).cast("int"),
        "Partner": yes_no(2),
        "Dependents": yes_no(3, "5"),
        "tenure": F.when(every(53), 0).when(every(59), 80).otherwise(F.col("months")),
        "PhoneService": F.col("phone"),
        "MultipleLines": F.when(F.col("phone") == "No", "No phone service").otherwise(yes_no(11)),
        "InternetService": net,
        **{
            name: F.when(net == "No", "No internet service").otherwise(yes_no(i))
            for name, i in NET_SERVICES.items()
        },
        "Contract": F.when(F.col("last_status") == "F", "Month-to-month")
        .when(F.col("last_status") == "O", "One year")
        .otherwise("Two year"),
        "PaperlessBilling": yes_no(12),
        "PaymentMethod": F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Electronic check")
        .when(F.col("c_mktsegment") == "BUILDING", "Mailed check")
        .when(F.col("c_mktsegment") == "FURNITURE", "Bank transfer (automatic)")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "Credit card (automatic)")
        .otherwise(F.col("c_mktsegment")),
        "MonthlyCharges": F.col("month_cents") / F.lit(100.0),
        "TotalCharges": F.when(every(37), " ").when(every(41), "1.0d").otherwise(dotted),
        "Churn": F.when(every(71), F.lit(None))
        .when(every(67), "Unknown")
        .when(F.col("n_after") == 0, "Yes")
        .otherwise("No"),
    }
    twice = F.when(every(61), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return base.select(
        *[c.alias(name) for name, c in columns.items()], F.explode(twice).alias("_copy")
    ).drop("_copy")


def clean_subscribers(spark: SparkSession, folder: str) -> DataFrame:
    """Deduplicated subscribers with numeric TotalCharges and a 0/1 label, key kept."""
    from wanewatch.operators.clean import clean

    return clean(subscribers(spark, folder), keep_key=True)


def scored_subscribers(spark: SparkSession, folder: str) -> DataFrame:
    """Clean subscribers with the rule score and four stand-in model probabilities.

    Each stand-in mixes a keyed hash with the label, so it separates the classes the way a
    model would. ``p_a`` is NULL for some keys: a model that failed on that row.
    """
    df = clean_subscribers(spark, folder)
    draws = [scalars.hash_int("customerID", F.lit(name)) % 7001 for name in SCORE_NAMES]
    scores = [(draw + F.col("label") * 3000) / F.lit(10000.0) for draw in draws]
    failed = F.col("customerID").cast("bigint") % 29 == 0
    return df.select(
        "*",
        rules.rule_points(df.columns).alias("rule_points"),
        rules.rule_probability(df.columns).alias("rule_p"),
        F.when(~failed, scores[0]).alias("p_a"),
        *[s.alias(f"p_{n}") for n, s in list(zip(SCORE_NAMES, scores))[1:]],
    )
