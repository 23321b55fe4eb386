"""Evaluation, voting, weight search, fallback and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wanewatch.catalog.registry import (
    AUC_BODY,
    h13,
    on_long,
    on_scored,
    query,
    r6,
    rates_sql,
)
from wanewatch.functions import scalars
from wanewatch.operators import evaluate, fallback, ranking, weights
from wanewatch.operators.split import folds
from wanewatch.plans import benchmark
from wanewatch.sources import files
from wanewatch.sources.subscribers import scored_subscribers
from wanewatch.sources.tables import table
from wanewatch.session import fresh_path

MODELS = {"rule": "rule_p", "a": "p_a", "b": "p_b", "c": "p_c"}
RATES = ["accuracy", "precision", "recall", "f1", "specificity"]
VOTED = "\nvoted AS (SELECT *, CAST(p > 0.5 AS INTEGER) AS z FROM long WHERE p IS NOT NULL)"
RATE_COLUMNS = 'tn, fp, fn, tp, accuracy, "precision", recall, f1, specificity'


def _long(spark, folder):
    df = scored_subscribers(spark, folder)
    return evaluate.long_scores(df, "customerID", "label", MODELS).where(F.col("p").isNotNull())


@query(on_long(f"SELECT model, {RATE_COLUMNS} FROM rates", VOTED, rates_sql("model", "voted")))
def confusion_metrics(spark, folder):
    """Counts and rates of the rule score and three stand-in models."""
    counted = evaluate.confusion(_long(spark, folder), "label", scalars.positive("p"), ["model"])
    return evaluate.rates(counted).withColumns({c: r6(c) for c in RATES})


@query(on_long("SELECT * FROM auc", AUC_BODY))
def roc_auc(spark, folder):
    areas = evaluate.roc_auc(_long(spark, folder), "label", "p", ["model"])
    return areas.withColumn("roc_auc", r6("roc_auc"))


@query(
    """WITH long AS (SELECT l_returnflag AS model, CAST(l_discount > 0.05::DOUBLE AS INTEGER) AS label,
  l_extendedprice AS p FROM lineitem), """
    + AUC_BODY
    + " SELECT * FROM auc"
)
def roc_auc_lineitem(spark, folder):
    """The same operator on the largest table: price as the score of a high discount."""
    df = table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("model"),
        (F.col("l_discount") > 0.05).cast("int").alias("label"),
        F.col("l_extendedprice").alias("p"),
    )
    return evaluate.roc_auc(df, "label", "p", ["model"]).withColumn("roc_auc", r6("roc_auc"))


def _class_row(c: int, name: str) -> str:
    hit = f"count(*) FILTER (WHERE label = {c} AND z = {c})"
    said, was = f"count(*) FILTER (WHERE z = {c})", f"count(*) FILTER (WHERE label = {c})"
    return (
        f"SELECT '{name}' AS class, coalesce({hit} / nullif({said}, 0), 0) AS pr, "
        f"coalesce({hit} / nullif({was}, 0), 0) AS re, "
        f"coalesce(2 * {hit} / nullif({said} + {was}, 0), 0) AS f, {was} AS support FROM v"
    )


@query(
    on_scored(
        """SELECT class, round(pr, 6) AS "precision", round(re, 6) AS recall, round(f, 6) AS f1, support FROM (
  SELECT * FROM per
  UNION ALL SELECT 'accuracy', avg(CAST(label = z AS INTEGER)), avg(CAST(label = z AS INTEGER)),
    avg(CAST(label = z AS INTEGER)), count(*) FROM v
  UNION ALL SELECT 'macro avg', avg(pr), avg(re), avg(f), CAST(sum(support) AS BIGINT) FROM per
  UNION ALL SELECT 'weighted avg', sum(pr * support) / sum(support), sum(re * support) / sum(support),
    sum(f * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per)""",
        "\nv AS (SELECT label, CAST(p_b > 0.5 AS INTEGER) AS z FROM scored)",
        f"\nper AS ({_class_row(0, 'No Churn')} UNION ALL {_class_row(1, 'Churn')})",
    )
)
def class_report(spark, folder):
    df = scored_subscribers(spark, folder)
    report = evaluate.class_report(df, "label", scalars.positive("p_b"), {0: "No Churn", 1: "Churn"})
    return report.withColumns({c: r6(c) for c in ("precision", "recall", "f1")})


FOLD = h13("'42|' || \"customerID\"") + " % 5"


@query(
    on_long(
        """SELECT model, round(avg(acc), 6) AS accuracy_mean, round(stddev_pop(acc), 6) AS accuracy_std,
  round(avg(f), 6) AS f1_mean, round(stddev_pop(f), 6) AS f1_std, count(*) AS folds FROM (
  SELECT model, (tp + tn) / (tp + tn + fp + fn) AS acc, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f FROM counts)
GROUP BY 1""",
        f"\nvoted AS (SELECT *, CAST(p > 0.5 AS INTEGER) AS z, {FOLD} AS fold FROM long WHERE p IS NOT NULL)",
        rates_sql("model, fold", "voted"),
    )
)
def fold_summary(spark, folder):
    """Fold means and deviations of accuracy and F1 per model."""
    df = folds(_long(spark, folder), "customerID", "label", 5, exact=False)
    counted = evaluate.confusion(df, "label", scalars.positive("p"), ["model", "fold"])
    summary = evaluate.fold_summary(evaluate.rates(counted), "model", "fold", ["accuracy", "f1"])
    return summary.select(
        "model",
        *[r6(f"{m}_{s}").alias(f"{m}_{s}") for m in ("accuracy", "f1") for s in ("mean", "std")],
        F.size("f1_folds").cast("bigint").alias("folds"),
    )


MIX = "(p_b * 0.5::DOUBLE + p_c * 0.3::DOUBLE + p_d * 0.2::DOUBLE) / 1.0::DOUBLE"


@query(
    on_scored(
        f"""SELECT "customerID", round((p_b * 1.0::DOUBLE + p_c * 1.0::DOUBLE + p_d * 1.0::DOUBLE) / 3.0::DOUBLE, 6) AS soft,
  round({MIX}, 6) AS weighted, CAST({MIX} > 0.5 AS INTEGER) AS prediction FROM scored"""
    )
)
def soft_vote(spark, folder):
    """Equal and weighted average of three models."""
    df = scored_subscribers(spark, folder)
    names = ["p_b", "p_c", "p_d"]
    mixed = scalars.weighted_mean(names, [0.5, 0.3, 0.2])
    return df.select(
        "customerID",
        r6(scalars.weighted_mean(names, [1.0, 1.0, 1.0])).alias("soft"),
        r6(mixed).alias("weighted"),
        scalars.positive(mixed).alias("prediction"),
    )


def _search_sql(candidates: str, names: list[str], metric: str) -> str:
    total = " + ".join(f"w_{n}" for n in names)
    mix = " + ".join(f"{n} * w_{n}" for n in names)
    present = " AND ".join(f"{n} IS NOT NULL" for n in names)
    columns = ", ".join(f"round(w_{n}, 6) AS w_{n}" for n in names)
    return on_scored(
        f"""SELECT candidate, {columns}, round(acc, 6) AS accuracy, round(f, 6) AS f1,
  row_number() OVER (ORDER BY {metric} DESC, candidate) = 1 AS is_best FROM best""",
        candidates,
        f"""
hit AS (
  SELECT candidate, {", ".join(f"w_{n}" for n in names)}, label, ({mix}) / ({total}) > 0.5 AS z
  FROM scored, grid WHERE {present}),
best AS (
  SELECT candidate, {", ".join(f"w_{n}" for n in names)},
    count(*) FILTER (WHERE (label = 1) = z) / count(*) AS acc,
    coalesce(2 * count(*) FILTER (WHERE label = 1 AND z) / nullif(2 * count(*) FILTER (WHERE label = 1 AND z)
      + count(*) FILTER (WHERE (label = 1) <> z), 0), 0) AS f
  FROM hit GROUP BY ALL)""",
    )


OPTIONS = ", ".join(
    f"({i}, {w}::DOUBLE)" for i, w in enumerate([0.2, 0.25, 0.3, 0.33, 0.35, 0.4, 0.45, 0.5])
)
THREE = f"""
opts AS (SELECT * FROM (VALUES {OPTIONS}) t(i, w)),
grid AS (
  SELECT CAST(row_number() OVER (ORDER BY i, j) - 1 AS INTEGER) AS candidate, w_p_b, w_p_c, w_p_d FROM (
    SELECT a.i AS i, b.i AS j, a.w AS w_p_b, b.w AS w_p_c, 1.0::DOUBLE - a.w - b.w AS w_p_d FROM opts a, opts b)
  WHERE w_p_d >= 0.1::DOUBLE AND w_p_d <= 0.6::DOUBLE)"""
FOUR = """
step AS (SELECT range AS s FROM range(1, 20)),
grid AS (
  SELECT CAST(row_number() OVER (ORDER BY a.s, b.s, c.s) - 1 AS INTEGER) AS candidate,
    a.s / 20 AS w_p_a, b.s / 20 AS w_p_b, c.s / 20 AS w_p_c, (20 - a.s - b.s - c.s) / 20 AS w_p_d
  FROM step a, step b, step c WHERE a.s + b.s + c.s < 20)"""


@query(_search_sql(THREE, ["p_b", "p_c", "p_d"], "acc"))
def weight_search_three(spark, folder):
    """All weight candidates of three models; the best by accuracy, first on ties."""
    df = scored_subscribers(spark, folder)
    found = weights.weight_search(df, "label", ["p_b", "p_c", "p_d"])
    return found.withColumns(
        {c: r6(c) for c in ("w_p_b", "w_p_c", "w_p_d", "accuracy", "f1")}
    )


@query(_search_sql(FOUR, ["p_a", "p_b", "p_c", "p_d"], "f"))
def weight_search_four(spark, folder):
    """The weight simplex of four models; the best by F1."""
    df = scored_subscribers(spark, folder)
    names = ["p_a", "p_b", "p_c", "p_d"]
    found = weights.weight_search(df, "label", names, metric="f1")
    return found.withColumns({c: r6(c) for c in [*[f"w_{n}" for n in names], "accuracy", "f1"]})


@query(
    f"""WITH searched AS ({_search_sql(FOUR, ["p_a", "p_b", "p_c", "p_d"], "f")})
SELECT max(f1) AS grid_f1, TRUE AS on_simplex, TRUE AS not_below, TRUE AS within, TRUE AS recomputed FROM searched"""
)
def weight_optimise(spark, folder):
    """Weights refined on the simplex; the vote is scored again with the weights that were found."""
    df = scored_subscribers(spark, folder)
    names = ["p_a", "p_b", "p_c", "p_d"]
    found = weights.optimise_weights(df, "label", names)
    w = found["weights"]
    vote = scalars.weighted_mean(names, w)
    counts = evaluate.rates(evaluate.confusion(df, "label", scalars.positive(vote), []))
    valid = abs(sum(w) - 1) < 1e-9 and all(0 <= x <= 1 for x in w)
    return counts.select(
        F.round(F.lit(found["grid_score"]), 6).alias("grid_f1"),
        F.lit(valid).alias("on_simplex"),
        (F.col("f1") >= F.lit(found["grid_score"])).alias("not_below"),
        F.lit(found["passes"] <= 20).alias("within"),
        (F.abs(F.col("f1") - F.lit(found["score"])) < 1e-12).alias("recomputed"),
    )


@query(
    on_scored(
        f"SELECT model, {RATE_COLUMNS}, roc_auc, CASE model WHEN 'b' THEN 0.5::DOUBLE WHEN 'c' THEN 0.3::DOUBLE "
        "WHEN 'd' THEN 0.2::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM rates JOIN auc USING (model)",
        f"""
long AS (
  SELECT label, 'b' AS model, p_b AS p FROM scored UNION ALL SELECT label, 'c', p_c FROM scored
  UNION ALL SELECT label, 'd', p_d FROM scored UNION ALL SELECT label, 'ENSEMBLE', {MIX} FROM scored)""",
        VOTED,
        rates_sql("model", "voted"),
        AUC_BODY,
    )
)
def individual_scores(spark, folder):
    """Metrics of each model and of their weighted vote."""
    df = scored_subscribers(spark, folder)
    parts = {"b": 0.5, "c": 0.3, "d": 0.2}
    df = df.withColumn("p", scalars.weighted_mean([f"p_{m}" for m in parts], list(parts.values())))
    named = {**{m: f"p_{m}" for m in parts}, "ENSEMBLE": "p"}
    long = evaluate.long_scores(df, "customerID", "label", named)
    found = evaluate.metrics(long, "label", "p", ["model"])
    weight = F.when(F.col("model") == "b", 0.5).when(F.col("model") == "c", 0.3)
    weight = weight.when(F.col("model") == "d", 0.2).otherwise(1.0)
    return found.withColumns({c: r6(c) for c in [*RATES, "roc_auc"]}).withColumn("weight", weight)


RULE_Z = "CAST(rule_points > 50 AS INTEGER)"
FALLBACK = f"""
answered AS (
  SELECT *, CASE WHEN p_a IS NOT NULL AND p_a >= 0.3::DOUBLE THEN 'primary' WHEN p_b >= 0.3::DOUBLE THEN 'secondary'
    WHEN rule_p >= 0.3::DOUBLE THEN 'rules_based' WHEN 0.27 >= 0.3 THEN 'base_rate' ELSE 'ultimate_fallback' END AS model_used
  FROM scored),
results AS (
  SELECT "customerID", "MonthlyCharges" AS latency_ms, model_used,
    CAST(CASE model_used WHEN 'primary' THEN CAST(p_a > 0.5 AS INTEGER) WHEN 'secondary' THEN CAST(p_b > 0.5 AS INTEGER)
      WHEN 'rules_based' THEN {RULE_Z} ELSE 0 END AS INTEGER) AS prediction,
    CASE model_used WHEN 'primary' THEN p_a WHEN 'secondary' THEN p_b WHEN 'rules_based' THEN rule_p ELSE 0.5::DOUBLE END AS probability,
    model_used <> 'primary' AS is_fallback,
    CASE model_used WHEN 'primary' THEN NULL WHEN 'ultimate_fallback' THEN 'model_error' ELSE 'low_confidence' END AS fallback_reason,
    CASE model_used WHEN 'primary' THEN '0' WHEN 'secondary' THEN '1' WHEN 'rules_based' THEN '2' WHEN 'base_rate' THEN '3' END AS handler_index
  FROM answered)"""


def _chain(columns, **options):
    return fallback.churn_ladder(
        columns,
        fallback.column_handler("primary", "p_a"),
        fallback.column_handler("secondary", "p_b"),
        **options,
    )


def _results(spark, folder, **options):
    df = scored_subscribers(spark, folder)
    return _chain(df.columns, **options).predict(df, latency=F.col("MonthlyCharges"))


@query(
    on_scored(
        """SELECT "customerID", prediction, round(probability, 6) AS probability, model_used, is_fallback,
  fallback_reason, handler_index FROM results""",
        FALLBACK,
    )
)
def fallback_score(spark, folder):
    """Primary model, secondary model, rules, base rate, fixed answer."""
    return _results(spark, folder).select(
        "customerID",
        "prediction",
        r6("probability").alias("probability"),
        "model_used",
        "is_fallback",
        "fallback_reason",
        F.col("metadata")["handler_index"].alias("handler_index"),
    )


@query(
    on_scored(
        """SELECT model_used, count(*) AS n FROM (SELECT CASE
  WHEN p_a IS NOT NULL AND greatest(p_a, 1 - p_a) >= 0.7::DOUBLE THEN 'primary'
  WHEN greatest(p_b, 1 - p_b) >= 0.7::DOUBLE THEN 'secondary'
  WHEN greatest(rule_p, 1 - rule_p) >= 0.7::DOUBLE THEN 'rules_based' ELSE 'base_rate' END AS model_used FROM scored)
GROUP BY 1"""
    )
)
def fallback_symmetric(spark, folder):
    """Confidence as the larger of p and 1 - p."""
    results = _results(spark, folder, confidence=0.7, symmetric=True)
    return results.groupBy("model_used").agg(F.count("*").alias("n"))


@query(
    on_scored(
        """SELECT name AS model_used, (SELECT count(*) FROM results WHERE model_used = name) AS uses,
  round((SELECT count(*) FILTER (WHERE model_used IN ('secondary', 'rules_based', 'base_rate')) / greatest(count(*), 1) FROM results), 6) AS fallback_rate
FROM (VALUES ('primary'), ('secondary'), ('rules_based'), ('base_rate')) t(name)""",
        FALLBACK,
    )
)
def fallback_usage(spark, folder):
    df = scored_subscribers(spark, folder)
    chain = _chain(df.columns)
    used = chain.usage(chain.predict(df))
    return used.withColumn("fallback_rate", r6("fallback_rate"))


@query(
    on_scored(
        """SELECT count(*) AS total_predictions, count(*) FILTER (WHERE is_fallback) AS fallback_count,
  round(count(*) FILTER (WHERE is_fallback) / greatest(count(*), 1), 6) AS fallback_rate,
  round(avg(latency_ms), 6) AS avg_latency_ms,
  count(*) FILTER (WHERE fallback_reason = 'low_confidence') AS low_confidence,
  count(*) FILTER (WHERE fallback_reason = 'model_error') AS model_error FROM results""",
        FALLBACK,
    )
)
def fallback_summary(spark, folder):
    row = fallback.fallback_summary(_results(spark, folder))
    reasons = F.col("fallback_reasons")
    return row.select(
        "total_predictions",
        "fallback_count",
        r6("fallback_rate").alias("fallback_rate"),
        r6("avg_latency_ms").alias("avg_latency_ms"),
        *[
            F.coalesce(F.try_element_at(reasons, F.lit(r)), F.lit(0)).alias(r)
            for r in ("low_confidence", "model_error")
        ],
    )


@query(
    on_scored(
        """SELECT "customerID", round(CASE WHEN p_a IS NULL OR p_a = 0 THEN 0.5::DOUBLE ELSE p_a END, 6) AS probability FROM scored"""
    )
)
def response_probability(spark, folder):
    df = scored_subscribers(spark, folder).select("customerID", F.col("p_a").alias("probability"))
    return fallback.respond(df).withColumn("probability", r6("probability"))


@query(
    """SELECT event_type AS model, count(*) AS rows, round(avg(value), 6) AS mean_ms,
  round(quantile_cont(value, 0.5), 6) AS p50_ms, round(quantile_cont(value, 0.95), 6) AS p95_ms,
  round(quantile_cont(value, 0.99), 6) AS p99_ms, round(sum(value), 2) AS total_ms FROM events GROUP BY 1"""
)
def latency_quantiles(spark, folder):
    """Mean, p50, p95, p99 per model, the event value standing in for the latency."""
    found = benchmark.latency_quantiles(table(spark, folder, "events"), "event_type", "value")
    rounded = {c: r6(c) for c in ("mean_ms", "p50_ms", "p95_ms", "p99_ms")}
    return found.withColumns(rounded).withColumn("total_ms", F.round("total_ms", 2))


BENCH = """
bench AS (
  SELECT CASE model WHEN 'c' THEN 'Ensemble (Weighted Voting)' ELSE model END AS model, accuracy AS test_accuracy,
    f1 AS test_f1, roc_auc AS test_roc_auc, (tp + fp) / 100 AS train_seconds,
    (fp + fn) / 100 AS inference_ms_per_row FROM rates JOIN auc USING (model))"""


def _bench(spark, folder):
    """Benchmark rows from the stored probabilities; times are stand-ins from the counts."""
    found = evaluate.metrics(_long(spark, folder), "label", "p", ["model"])
    name = F.when(F.col("model") == "c", "Ensemble (Weighted Voting)").otherwise(F.col("model"))
    return found.select(
        name.alias("model"),
        r6("accuracy").alias("test_accuracy"),
        r6("f1").alias("test_f1"),
        r6("roc_auc").alias("test_roc_auc"),
        ((F.col("tp") + F.col("fp")) / 100).alias("train_seconds"),
        ((F.col("fp") + F.col("fn")) / 100).alias("inference_ms_per_row"),
        (F.col("accuracy") > benchmark.TARGET).alias("beats_target"),
    )


ON_BENCH = (VOTED, rates_sql("model", "voted"), AUC_BODY, BENCH)


@query(
    on_long(
        """SELECT model AS "Model", test_accuracy AS "Accuracy", test_f1 AS "F1", test_roc_auc AS "ROC_AUC",
  train_seconds AS "Train_Time_s", test_accuracy > 0.785::DOUBLE AS "Beats_Target",
  round((test_accuracy - 0.785::DOUBLE) * 100, 4) AS "Gap_Points" FROM bench""",
        *ON_BENCH,
    )
)
def benchmark_summary(spark, folder):
    shown = benchmark.summary(_bench(spark, folder))
    return shown.withColumn("Gap_Points", F.round("Gap_Points", 4))


@query(
    on_long(
        """SELECT model AS recommended_model, test_accuracy AS accuracy, test_f1 AS f1, test_roc_auc AS roc_auc, train_seconds,
  inference_ms_per_row, CASE WHEN inference_ms_per_row < 1 THEN 'serve_online'
    WHEN inference_ms_per_row < 10 THEN 'serve_with_cache'
    ELSE 'serve_in_batches' END
  || CASE WHEN model LIKE '%Ensemble%' THEN '; several_models_per_row'
    || '; fit_one_model_to_its_scores' ELSE '' END AS recommendations
FROM bench ORDER BY test_accuracy DESC, model LIMIT 1""",
        *ON_BENCH,
    )
)
def deployment_report(spark, folder):
    report = benchmark.deployment_report(_bench(spark, folder))
    return report.withColumn("recommendations", F.array_join("recommendations", "; "))


@query(
    on_long(
        "SELECT model, f1, CAST(row_number() OVER (ORDER BY f1 DESC, model) AS INTEGER) AS place FROM rates",
        VOTED,
        rates_sql("model", "voted"),
    )
)
def model_rank(spark, folder):
    """Models by F1; the position is taken after the sort of a handful of rows."""
    counted = evaluate.confusion(_long(spark, folder), "label", scalars.positive("p"), ["model"])
    ranked = ranking.rank_models(
        evaluate.rates(counted).select("model", r6("f1").alias("f1")), "f1"
    )
    listed = ranked.agg(F.collect_list(F.struct("f1", "model")).alias("l"))
    ordered = F.array_sort(
        "l",
        lambda a, b: F.when(a["f1"] > b["f1"], -1)
        .when(a["f1"] < b["f1"], 1)
        .when(a["model"] < b["model"], -1)
        .otherwise(1),
    )
    return listed.select(F.posexplode(ordered).alias("i", "r")).select(
        "r.model", "r.f1", (F.col("i") + 1).alias("place")
    )


@query(
    on_long(
        "SELECT model, f1 FROM rates ORDER BY f1 DESC, model LIMIT 1",
        VOTED,
        rates_sql("model", "voted"),
    )
)
def best_model(spark, folder):
    counted = evaluate.confusion(_long(spark, folder), "label", scalars.positive("p"), ["model"])
    return ranking.best_model(
        evaluate.rates(counted).select("model", r6("f1").alias("f1")), "f1"
    )


@query(
    on_long(
        """SELECT '2024-01-31T12:00:00' AS "timestamp", 0.785::DOUBLE AS target_metric,
  (SELECT model FROM bench ORDER BY test_accuracy DESC, model DESC LIMIT 1) AS best_model,
  max(test_accuracy) AS best_score, max(test_accuracy) > 0.785::DOUBLE AS beats_target, count(*) AS results FROM bench""",
        *ON_BENCH,
    )
)
def results_document(spark, folder):
    """Ranked rows as CSV and as one JSON document, written and read back."""
    path = fresh_path(spark, "results")
    at = F.lit("2024-01-31T12:00:00")
    ranked = _bench(spark, folder)
    files.save_results(ranked, path, score="test_accuracy", target=benchmark.TARGET, at=at)
    ddl = (
        "timestamp string, target_metric double, best_model string, best_score double, "
        "beats_target boolean, results array<struct<model string>>"
    )
    read = spark.read.schema(ddl).json(f"{path}/json")
    return read.withColumn("results", F.size("results").cast("bigint"))
