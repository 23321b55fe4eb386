"""Registry of queries and shared pieces of their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL twin if there is one."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def h13(text: str) -> str:
    """SQL of the 52-bit integer hash of a text expression."""
    return f"('0x' || substr(md5({text}), 1, 13))::BIGINT"


CUT, END = "TIMESTAMP '2000-08-01'", "TIMESTAMP '2001-08-01'"


def _yes(i: int, below: str = "8") -> str:
    return f"CASE WHEN substr(d, {i}, 1) < '{below}' THEN 'Yes' ELSE 'No' END"


def _net(name: str, i: int) -> str:
    return f"CASE WHEN net = 'No' THEN 'No internet service' ELSE {_yes(i)} END AS \"{name}\""


SUBS = f"""
hist AS (
  SELECT o_custkey AS k,
    min(o_orderdate) FILTER (WHERE o_orderdate < {CUT}) AS first_at,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) FILTER (WHERE o_orderdate < {CUT}) AS BIGINT) AS cents,
    count(*) FILTER (WHERE o_orderdate < {CUT}) AS n_before,
    count(*) FILTER (WHERE o_orderdate >= {CUT}) AS n_after,
    last(o_orderstatus ORDER BY o_orderdate, o_orderkey) FILTER (WHERE o_orderdate < {CUT}) AS last_status
  FROM orders WHERE o_orderdate < {END} GROUP BY 1),
base AS (
  SELECT c_custkey AS k, md5(c_custkey::VARCHAR) AS d, c_nationkey, c_mktsegment, last_status, n_after,
    (2 * cents + n_before * 3500) // (2 * n_before * 3500) AS mc,
    date_diff('day', first_at::DATE, DATE '2000-08-01') // 30 AS months,
    CASE n_regionkey % 3 WHEN 0 THEN 'DSL' WHEN 1 THEN 'Fiber optic' ELSE 'No' END AS net,
    CASE WHEN substr(md5(c_custkey::VARCHAR), 4, 1) < 'e' THEN 'Yes' ELSE 'No' END AS phone
  FROM customer JOIN hist ON hist.k = c_custkey JOIN nation ON n_nationkey = c_nationkey
  WHERE n_before > 0),
subs AS (
  SELECT k::VARCHAR AS "customerID",
    CASE WHEN k % 43 = 0 THEN NULL WHEN substr(d, 1, 1) < '8' THEN 'Male' ELSE 'Female' END AS gender,
    CAST(c_nationkey % 5 = 0 AS INTEGER) AS "SeniorCitizen",
    {_yes(2)} AS "Partner", {_yes(3, '5')} AS "Dependents",
    CAST(CASE WHEN k % 53 = 0 THEN 0 WHEN k % 59 = 0 THEN 80 ELSE months END AS INTEGER) AS tenure,
    phone AS "PhoneService",
    CASE WHEN phone = 'No' THEN 'No phone service' ELSE {_yes(11)} END AS "MultipleLines",
    net AS "InternetService",
    {_net('OnlineSecurity', 5)}, {_net('OnlineBackup', 6)}, {_net('DeviceProtection', 7)},
    {_net('TechSupport', 8)}, {_net('StreamingTV', 9)}, {_net('StreamingMovies', 10)},
    CASE last_status WHEN 'F' THEN 'Month-to-month' WHEN 'O' THEN 'One year' ELSE 'Two year' END AS "Contract",
    {_yes(12)} AS "PaperlessBilling",
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Electronic check' WHEN 'BUILDING' THEN 'Mailed check'
      WHEN 'FURNITURE' THEN 'Bank transfer (automatic)' WHEN 'HOUSEHOLD' THEN 'Credit card (automatic)'
      ELSE c_mktsegment END AS "PaymentMethod",
    mc / 100.0::DOUBLE AS "MonthlyCharges",
    CASE WHEN k % 37 = 0 THEN ' ' WHEN k % 41 = 0 THEN '1.0d'
      ELSE (mc * months // 100)::VARCHAR || '.' || lpad((mc * months % 100)::VARCHAR, 2, '0') END AS "TotalCharges",
    CASE WHEN k % 71 = 0 THEN NULL WHEN k % 67 = 0 THEN 'Unknown' WHEN n_after = 0 THEN 'Yes' ELSE 'No' END AS "Churn"
  FROM base, (VALUES (0), (1)) AS t(c) WHERE c = 0 OR k % 61 = 0)"""

NUMBER = (
    "CASE WHEN regexp_full_match(trim(\"TotalCharges\"), "
    "'[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
    'THEN trim("TotalCharges")::DOUBLE END'
)
LABEL = "CASE \"Churn\" WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END"

CLEAN = f"""
clean AS (
  SELECT DISTINCT * EXCLUDE ("Churn") REPLACE ({NUMBER} AS "TotalCharges"), CAST({LABEL} AS INTEGER) AS label
  FROM subs WHERE {LABEL} IS NOT NULL)"""

POINTS = """least(27
    + CASE WHEN coalesce(tenure, 12) < 6 THEN 25 ELSE 0 END
    + CASE WHEN coalesce("Contract", 'Two year') = 'Month-to-month' THEN 20 ELSE 0 END
    + CASE WHEN coalesce("MonthlyCharges", 50) > 70 THEN 15 ELSE 0 END
    + CASE WHEN "TechSupport" = 'No' THEN 10 ELSE 0 END
    + CASE WHEN "InternetService" = 'Fiber optic' AND "OnlineSecurity" = 'No' THEN 15 ELSE 0 END
    + CASE WHEN "PaymentMethod" = 'Electronic check' THEN 10 ELSE 0 END, 95)"""


def _draw(name: str) -> str:
    text = f"\"customerID\" || '|{name}'"
    return f"({h13(text)} % 7001 + label * 3000) / 10000.0::DOUBLE"


SCORED = f"""
scored AS (
  SELECT *, CAST({POINTS} AS INTEGER) AS rule_points, {POINTS} / 100.0::DOUBLE AS rule_p,
    CASE WHEN "customerID"::BIGINT % 29 <> 0 THEN {_draw('a')} END AS p_a,
    {_draw('b')} AS p_b, {_draw('c')} AS p_c, {_draw('d')} AS p_d
  FROM clean)"""

LONG = """
long AS (
  SELECT "customerID", label, 'rule' AS model, rule_p AS p FROM scored
  UNION ALL SELECT "customerID", label, 'a', p_a FROM scored
  UNION ALL SELECT "customerID", label, 'b', p_b FROM scored
  UNION ALL SELECT "customerID", label, 'c', p_c FROM scored)"""


def rates_sql(group: str, source: str) -> str:
    """SQL of counts and rates per group over rows with label and z (prediction)."""
    return f"""
counts AS (
  SELECT {group},
    count(*) FILTER (WHERE label <> 1 AND z <> 1) AS tn, count(*) FILTER (WHERE label <> 1 AND z = 1) AS fp,
    count(*) FILTER (WHERE label = 1 AND z <> 1) AS fn, count(*) FILTER (WHERE label = 1 AND z = 1) AS tp
  FROM {source} GROUP BY {group}),
rates AS (
  SELECT *, round(coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0), 0), 6) AS accuracy,
    round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS "precision",
    round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
    round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
    round(coalesce(tn / nullif(tn + fp, 0), 0), 6) AS specificity FROM counts)"""


AUC_BODY = """
ranked AS (
  SELECT model, label, rank() OVER (PARTITION BY model ORDER BY p) AS lo,
    count(*) OVER (PARTITION BY model, p) AS same FROM long WHERE p IS NOT NULL),
auc AS (
  SELECT model, round(coalesce(
      (sum((lo + (same - 1) / 2.0::DOUBLE) * label) - sum(label) * (sum(label) + 1) / 2.0::DOUBLE)
      / nullif(sum(label) * (count(*) - sum(label)), 0), 0), 6) AS roc_auc
  FROM ranked GROUP BY model)"""


def with_ctes(body: str, *ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def on_subs(body: str, *more: str) -> str:
    return with_ctes(body, SUBS, *more)


def on_clean(body: str, *more: str) -> str:
    return with_ctes(body, SUBS, CLEAN, *more)


def on_scored(body: str, *more: str) -> str:
    return with_ctes(body, SUBS, CLEAN, SCORED, *more)


def on_long(body: str, *more: str) -> str:
    return with_ctes(body, SUBS, CLEAN, SCORED, LONG, *more)
