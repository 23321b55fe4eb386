"""Pipeline stages and penalised boosting, with fitted values worked out again in SQL."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from wanewatch.catalog.feature_queries import ORDERED
from wanewatch.catalog.registry import h13, on_clean, query, r6
from wanewatch.operators.evaluate import metrics
from wanewatch.plans import experiment, presets, stages, trainer, tuning
from wanewatch.plans.boosting import BoostedTrees, bin_edges, blocks_of
from wanewatch.plans.forest import BootstrapForest
from wanewatch.plans.preprocess import feature_table, fit_preprocessor, named_spec
from wanewatch.session import fresh_path
from wanewatch.sources.model_store import load_model, save_model
from wanewatch.sources.subscribers import clean_subscribers

DIM = 4
LIMIT = (6.0 / (1 + DIM)) ** 0.5
CATEGORY = "coalesce(\"PaymentMethod\", 'nan')"


def _coordinate(i: int) -> str:
    unit = h13(f"'42|' || {CATEGORY} || '|{i}'") + " / 4503599627370496.0::DOUBLE"
    return f"{unit} * {2 * LIMIT!r}::DOUBLE - {LIMIT!r}::DOUBLE"


@query(
    on_clean(
        f"""SELECT "customerID" AS key, CAST(('0x' || substr(md5('PaymentMethod=' || {CATEGORY}), 1, 8))::BIGINT % 64 AS INTEGER) AS bucket,
  CASE WHEN substr(md5('PaymentMethod=' || {CATEGORY}), 9, 1) < '8' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS sign,
  (SELECT count(*) FROM (SELECT DISTINCT "PaymentMethod" AS o FROM clean) WHERE coalesce(o, 'nan') < {CATEGORY}) AS code,
  round({_coordinate(0)}, 6) AS first, round({_coordinate(DIM - 1)}, 6) AS last,
  CASE WHEN tenure IS NOT NULL THEN CAST((tenure >= q[1])::INT + (tenure >= q[2])::INT + (tenure >= q[3])::INT AS INTEGER) END AS bin,
  TRUE AS same
FROM clean, (SELECT quantile_cont(tenure::DOUBLE, [0.25, 0.5, 0.75]) AS q FROM clean)"""
    )
)
def stage_round_trip(spark, folder):
    """Hash, embedding, codes and bins as one pipeline: fitted, saved, loaded, equal and right."""
    df = clean_subscribers(spark, folder).select(F.col("customerID").alias("key"), "PaymentMethod", F.col("tenure").cast("double"))
    one = {"inputCol": "PaymentMethod"}
    steps = [
        stages.Hashing(**one, outputCol="hash", width=64),
        stages.Embedding(**one, outputCol="vector", dim=DIM),
        stages.LabelCodes(**one, outputCol="code"),
        stages.TargetBins(inputCol="tenure", outputCol="bin", bins=4),
    ]
    path, fitted = fresh_path(spark, "stages"), Pipeline(stages=steps).fit(df)
    save_model(fitted, path)
    loaded: PipelineModel = load_model(path)
    made = ["hash", "vector", "code", "bin"]
    before = fitted.transform(df).select(*df.columns, F.struct(*made).alias("before"))
    both = loaded.transform(before)
    at = F.array_position(F.transform("hash", lambda v: v != 0), F.lit(True))
    return both.select(
        "key", (at - 1).cast("int").alias("bucket"), F.element_at("hash", at.cast("int")).alias("sign"),
        F.col("code").cast("bigint").alias("code"), r6(F.col("vector")[0]).alias("first"), r6(F.col("vector")[DIM - 1]).alias("last"),
        "bin", (F.struct(*made) == F.col("before")).alias("same"),
    )


STUMPS, RATE, L1, L2, GAMMA = 3, 0.3, 0.5, 2.0, 0.05
STUMP_FEATURES = {
    "senior": '"SeniorCitizen"::DOUBLE',
    "years": "floor(coalesce(tenure, 0) / 12)::DOUBLE",
    "contract": """CASE "Contract" WHEN 'Month-to-month' THEN 0 WHEN 'One year' THEN 1 ELSE 2 END::DOUBLE""",
    "net": """CASE "InternetService" WHEN 'DSL' THEN 0 WHEN 'Fiber optic' THEN 1 ELSE 2 END::DOUBLE""",
}


def _stump_sql() -> str:
    """Stump after stump: rounded gradients, sums on both sides of every value, the best split."""
    unit = 1 << 24

    def soft(g):
        return f"(sign({g}) * greatest(abs({g}) - {L1}::DOUBLE, 0))"

    def score(g, h):
        return f"({soft(g)} ** 2 / ({h} + {L2}::DOUBLE))"

    columns = ", ".join(f"{sql} AS x{i}" for i, sql in enumerate(STUMP_FEATURES.values()))
    tables = [
        f"""m0 AS (SELECT {columns}, label, ln(avg(label) OVER () / (1 - avg(label) OVER ())) AS m FROM clean)"""
    ]
    for t in range(STUMPS):
        long = " UNION ALL ".join(f"SELECT {i} AS f, x{i} AS x, g, h FROM g{t}" for i in range(len(STUMP_FEATURES)))
        pick = "CASE f " + " ".join(f"WHEN {i} THEN x{i}" for i in range(len(STUMP_FEATURES))) + " END"
        tables += [
            f"""g{t} AS (SELECT *, round((1 / (1 + exp(-m)) - label) * {unit}) AS g,
    round(1 / (1 + exp(-m)) * (1 - 1 / (1 + exp(-m))) * {unit}) AS h FROM m{t})""",
            f"""v{t} AS (SELECT f, x, sum(g) AS g, sum(h) AS h FROM ({long}) GROUP BY 1, 2)""",
            f"""l{t} AS (SELECT f, x, sum(g) OVER w / {unit} AS gl, sum(h) OVER w / {unit} AS hl,
    sum(g) OVER (PARTITION BY f) / {unit} AS gt, sum(h) OVER (PARTITION BY f) / {unit} AS ht, max(x) OVER (PARTITION BY f) AS top
  FROM v{t} WINDOW w AS (PARTITION BY f ORDER BY x))""",
            f"""b{t} AS MATERIALIZED (SELECT f, x,
    ({score('gl', 'hl')} + {score('(gt - gl)', '(ht - hl)')} - {score('gt', 'ht')}) / 2 - {GAMMA}::DOUBLE AS gain,
    -{RATE}::DOUBLE * {soft('gl')} / (hl + {L2}::DOUBLE) AS lv, -{RATE}::DOUBLE * {soft('(gt - gl)')} / (ht - hl + {L2}::DOUBLE) AS rv
  FROM l{t} WHERE x < top AND hl >= 1 AND ht - hl >= 1 ORDER BY round(gain, 9) DESC, f, x LIMIT 1)""",
            f"""m{t + 1} AS (SELECT g{t}.* EXCLUDE (g, h) REPLACE (m + CASE WHEN {pick} <= b{t}.x THEN lv ELSE rv END AS m) FROM g{t}, b{t})""",
        ]
    rows = " UNION ALL ".join(f"SELECT {t} AS tree, * FROM b{t}" for t in range(STUMPS))
    names = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(STUMP_FEATURES))
    return on_clean(
        f"""SELECT tree, CASE f {names} END AS feature, x AS threshold, round(lv, 5) AS left_value,
  round(rv, 5) AS right_value, round(gain, 4) AS gain FROM ({rows})""",
        *tables,
    )


@query(_stump_sql())
def boosted_stumps(spark, folder):
    """Three penalised stumps over all subscribers: split, worth and both leaf values."""
    rows = _few_features(spark, folder)
    model = BoostedTrees(maxIter=STUMPS, maxDepth=1, maxBins=256, stepSize=RATE, regAlpha=L1, regLambda=L2, gamma=GAMMA).fit(rows)
    names, found = list(STUMP_FEATURES), []
    for i, t in enumerate(model.tree_list()):
        if t["feature"][0] >= 0:
            left, right = (t["value"][t[side][0]] for side in ("left", "right"))
            found.append((i, names[t["feature"][0]], t["cut"][0], round(left, 5), round(right, 5), round(t["gain"][0], 4)))
    ddl = "tree int, feature string, threshold double, left_value double, right_value double, gain double"
    return spark.createDataFrame(found, ddl)


def _few_features(spark, folder):
    """The features of ``STUMP_FEATURES`` as vectors."""
    df = clean_subscribers(spark, folder)
    code = lambda c, a, b: F.when(F.col(c) == a, 0).when(F.col(c) == b, 1).otherwise(2)
    columns = [
        F.col("SeniorCitizen"), F.floor(F.coalesce("tenure", F.lit(0)) / 12),
        code("Contract", "Month-to-month", "One year"), code("InternetService", "DSL", "Fiber optic"),
    ]
    return df.select(array_to_vector(F.array(*[c.cast("double") for c in columns])).alias("features"), "label")


VOTES, VOTE_RATE = 6, 0.5
NAMED = "CASE f " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(STUMP_FEATURES)) + " END"
PICKED = "CASE f " + " ".join(f"WHEN {i} THEN x{i}" for i in range(len(STUMP_FEATURES))) + " END"


def _few_sql() -> str:
    return ", ".join(f"{sql} AS x{i}" for i, sql in enumerate(STUMP_FEATURES.values()))


def _sides_sql(name: str, source: str, by: str = "") -> str:
    """Class weights left of every cut and in all, per feature (and ``by``), with the impurity gain."""
    keys = f"{by}, " if by else ""
    long = " UNION ALL ".join(f"SELECT {keys}{i} AS f, x{i} AS x, label, w FROM {source}" for i in range(len(STUMP_FEATURES)))
    parts = f"PARTITION BY {keys}f"
    return f"""{name}_v AS (SELECT {keys}f, x, sum(CASE label WHEN 0 THEN w ELSE 0 END) AS a, sum(CASE label WHEN 1 THEN w ELSE 0 END) AS b,
    count(*) AS c FROM ({long}) GROUP BY ALL),
{name}_s AS (SELECT *, sum(a) OVER w AS al, sum(b) OVER w AS bl, sum(c) OVER w AS cl, sum(a) OVER ({parts}) AS a_all, sum(b) OVER ({parts}) AS b_all,
    sum(c) OVER ({parts}) AS c_all, max(x) OVER ({parts}) AS top FROM {name}_v WINDOW w AS ({parts} ORDER BY x)),
{name} AS (SELECT *, round(((al * al + bl * bl) / (al + bl) + ((a_all - al) * (a_all - al) + (b_all - bl) * (b_all - bl)) / (a_all + b_all - al - bl)
    - (a_all * a_all + b_all * b_all) / (a_all + b_all)) / (a_all + b_all), 9) AS gain FROM {name}_s WHERE x < top)"""


def _votes_sql() -> str:
    """Stump after stump: the purest cut, its error and vote, heavier rows where it misses."""
    tables = [f"w0 AS (SELECT {_few_sql()}, label, 1.0::DOUBLE AS w FROM clean)"]
    for t in range(VOTES):
        tables += [
            _sides_sql(f"c{t}", f"w{t}"),
            f"""b{t} AS MATERIALIZED (SELECT f, x, bl > al AS says_left, b_all - bl > a_all - al AS says_right,
    (least(al, bl) + least(a_all - al, b_all - bl)) / (a_all + b_all) AS error FROM c{t} ORDER BY gain DESC, f, x LIMIT 1)""",
            f"""w{t + 1} AS (SELECT w{t}.* REPLACE (CASE WHEN (CASE WHEN {PICKED} <= x THEN says_left ELSE says_right END) = (label = 1) THEN w
    ELSE w * pow((1 - error) / error, {VOTE_RATE}) END AS w) FROM w{t}, b{t})""",
        ]
    rows = " UNION ALL ".join(f"SELECT {t} AS round, * FROM b{t}" for t in range(VOTES))
    return on_clean(
        f"""SELECT round, {NAMED} AS feature, x AS threshold, says_left, says_right,
  round({VOTE_RATE} * ln((1 - error) / error), 5) AS vote FROM ({rows})""",
        *tables,
    )


@query(_votes_sql())
def voting_stumps(spark, folder):
    """First rounds of the reweighted stumps over all subscribers: cut, what both leaves say, vote."""
    rows = _few_features(spark, folder).select(
        vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y"), F.lit(1.0).alias("w")
    )
    edges, n = bin_edges(rows, 256), rows.count()
    first = blocks_of(rows, edges, 0.0, n)
    stumps, votes = presets.boost_stumps(first, [len(e) + 1 for e in edges], float(n), VOTES, VOTE_RATE)
    first.unpersist()
    names, found = list(STUMP_FEATURES), []
    for i, (t, vote) in enumerate(zip(stumps, votes)):
        if t["feature"][0] >= 0:
            f = t["feature"][0]
            found.append((i, names[f], float(edges[f][t["cut"][0]]), t["value"][1] == 1, t["value"][2] == 1, round(vote, 5)))
    ddl = "round int, feature string, threshold double, says_left boolean, says_right boolean, vote double"
    return spark.createDataFrame(found, ddl)


LEAST = 3
BALANCED = """CASE label WHEN 1 THEN (count(*) OVER ()) / (2.0::DOUBLE * sum(label) OVER ())
    ELSE (count(*) OVER ()) / (2.0::DOUBLE * (count(*) OVER () - sum(label) OVER ())) END"""


def _tree_sql() -> str:
    """The purest cut of the root, then of both halves."""
    best = f"""FROM {{0}} WHERE cl >= {LEAST} AND c_all - cl >= {LEAST}"""
    half = f"""n1 AS (SELECT n0.*, CASE WHEN {PICKED} <= x THEN 1 ELSE 2 END AS node FROM n0, b0)"""
    tables = [
        f"n0 AS (SELECT {_few_sql()}, label, {BALANCED} AS w FROM clean)",
        _sides_sql("c0", "n0"),
        f"""b0 AS MATERIALIZED (SELECT 0 AS node, f, x, bl / (al + bl) AS lv, (b_all - bl) / (a_all + b_all - al - bl) AS rv, c_all {best.format('c0')}
    ORDER BY gain DESC, f, x LIMIT 1)""",
        half,
        _sides_sql("c1", "n1", "node"),
        f"""b1 AS (SELECT node, f, x, bl / (al + bl) AS lv, (b_all - bl) / (a_all + b_all - al - bl) AS rv, c_all {best.format('c1')} AND gain > 0
    QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, x) = 1)""",
    ]
    return on_clean(
        f"""SELECT node, {NAMED} AS feature, x AS threshold, round(lv, 6) AS left_share, round(rv, 6) AS right_share
FROM (SELECT * FROM b0 UNION ALL SELECT * FROM b1)""",
        *tables,
    )


@query(_tree_sql())
def balanced_tree(spark, folder):
    """Two levels of a tree that weighs classes by its own root, over all subscribers."""
    made = BootstrapForest(
        numTrees=1, maxDepth=2, maxBins=256, minInstancesPerNode=LEAST, featureSubsetStrategy="all",
        classWeights="balanced_subsample", bootstrap=False,
    )
    t = made.fit(_few_features(spark, folder)).tree_list()[0]
    names, found = list(STUMP_FEATURES), []
    for node, f in enumerate(t["feature"]):
        if f >= 0:
            left, right = (t["value"][t[side][node]] for side in ("left", "right"))
            found.append((node, names[f], t["cut"][node], round(left, 6), round(right, 6)))
    return spark.createDataFrame(found, "node int, feature string, threshold double, left_share double, right_share double")


TRIED = {"numTrees": [5], "maxDepth": [0], "minInstancesPerSplit": [10], "classWeights": ["none", "balanced_subsample"]}


@query(
    on_clean(
        """SELECT setting, fold, count(*) AS n, sum(label)::BIGINT AS positives, TRUE AS agrees
FROM (SELECT label, CASE WHEN rn <= n // 3 THEN 0 WHEN rn <= n * 2 // 3 THEN 1 ELSE 2 END AS fold FROM ordered),
  (VALUES (0), (1)) AS s(setting) GROUP BY ALL""",
        ORDERED,
    )
)
def tuned_forest(spark, folder):
    """Settings of unlimited trees tried on three folds; F1 recomputed from the stored probabilities."""
    df = clean_subscribers(spark, folder).persist()
    rows = feature_table(df, fit_preprocessor(df, named_spec()), "customerID", "label").persist()
    path = fresh_path(spark, "tuned-forest")
    told = tuning.search_kept("random_forest", rows, tuning.combinations(TRIED), path, 3)
    df.unpersist()
    told = told.select("setting", F.posexplode("f1_folds").alias("fold", "f1"))
    hit = F.sum(F.when((F.col("p") > 0.5) & (F.col("label") == 1), 1).otherwise(0))
    both = F.sum((F.col("p") > 0.5).cast("int")) + F.sum("label")
    again = spark.read.parquet(path).groupBy("setting", "fold").agg(
        F.count("*").alias("n"), F.sum("label").alias("positives"), F.coalesce(2 * hit / both, F.lit(0.0)).alias("again")
    )
    agrees = (F.abs(F.col("f1") - F.col("again")) < 1e-9).alias("agrees")
    out = again.join(told, ["setting", "fold"]).select("setting", "fold", "n", "positives", agrees)
    rows.unpersist()
    return out


@query(
    on_clean(
        """SELECT model, count(*) AS n, sum(label)::BIGINT AS positives, TRUE AS metrics_agree, TRUE AS learns
FROM ordered, (VALUES ('xgboost'), ('lightgbm')) AS m(model)
WHERE rn > n - CAST(floor(n * 0.2::DOUBLE + 0.5::DOUBLE) AS BIGINT) GROUP BY 1""",
        ORDERED,
    )
)
def boosted_regularised(spark, folder):
    """Both penalised presets of the predictor, 10 trees each: test metrics against a recomputation.

    Metrics come once from the trainer and once from window functions over the stored test scores;
    ``learns`` says that the training rows are told apart with an AUC of 0.75 or more.
    """
    df = clean_subscribers(spark, folder)
    _, parts = experiment.prepared_parts(df, {"train": 0.8, "test": 0.2}, named_spec())
    train, test = (parts[p].persist() for p in ("train", "test"))
    out = []
    for name in ("xgboost", "lightgbm"):
        model = presets.make(name, presets.PREDICTOR[name], trees=10).fit(train)
        path = fresh_path(spark, "boosted-scores")
        trainer.with_probability(test, model, name).select("key", "label", F.col(f"p_{name}").alias("p")).write.parquet(path)
        scored = spark.read.parquet(path)
        told = trainer.evaluate(scored, "p")
        scored.createOrReplaceTempView("boosted_scores")
        again = spark.sql(
            """WITH r AS (SELECT label, p, rank() OVER (ORDER BY p) AS lo, count(*) OVER (PARTITION BY p) AS same FROM boosted_scores)
            SELECT count(*) AS n, sum(label) AS positives, avg(CAST(int(p > 0.5) = label AS INT)) AS accuracy,
              2 * count_if(p > 0.5 AND label = 1) / (2 * count_if(p > 0.5 AND label = 1) + count_if(int(p > 0.5) <> label)) AS f1,
              (sum((lo + (same - 1) / 2) * label) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * (count(*) - sum(label))) AS roc_auc
            FROM r"""
        ).first()
        agree = all(abs(told[k] - (again[k] or 0.0)) < 1e-6 for k in ("accuracy", "f1", "roc_auc"))
        seen = metrics(trainer.with_probability(train, model, name), "label", f"p_{name}", []).first()["roc_auc"]
        out.append((name, again["n"], int(again["positives"]), agree, seen >= 0.75))
    train.unpersist()
    test.unpersist()
    return spark.createDataFrame(out, "model string, n bigint, positives bigint, metrics_agree boolean, learns boolean")


@query(
    on_clean(
        """SELECT count(*) AS n, sum(label)::BIGINT AS positives, TRUE AS metrics_agree, TRUE AS learns
FROM ordered WHERE rn > n - CAST(floor(n * 0.2::DOUBLE + 0.5::DOUBLE) AS BIGINT)""",
        ORDERED,
    )
)
def adaboost_full(spark, folder):
    """The preset with its own 100 rounds: accuracy and F1 of the test rows against plain counts.

    ``learns`` says that the training rows are told apart better than by the first stump alone.
    """
    df = clean_subscribers(spark, folder)
    _, parts = experiment.prepared_parts(df, {"train": 0.8, "test": 0.2}, named_spec())
    train = parts["train"].persist()
    model = presets.make("adaboost").fit(train)
    one = model.copy()
    one._set(trees=json.dumps(model.tree_list()[:1]))
    path = fresh_path(spark, "adaboost-scores")
    trainer.with_probability(parts["test"], model, "a").select("label", F.col("p_a").alias("p")).write.parquet(path)
    scored = spark.read.parquet(path)
    told = trainer.evaluate(scored, "p")
    said = F.col("p") > 0.5
    hit = F.count_if(said & (F.col("label") == 1))
    again = scored.agg(
        F.count("*").alias("n"), F.sum("label").alias("positives"),
        F.avg((said.cast("int") == F.col("label")).cast("int")).alias("accuracy"),
        F.coalesce(2 * hit / (F.count_if(said) + F.sum("label")), F.lit(0.0)).alias("f1"),
    ).first()
    agree = all(abs(told[k] - again[k]) < 1e-9 for k in ("accuracy", "f1"))
    seen, alone = (trainer.evaluate(trainer.with_probability(train, m, "a"), "p_a")["roc_auc"] for m in (model, one))
    train.unpersist()
    row = [(again["n"], int(again["positives"]), agree, seen > alone)]
    return spark.createDataFrame(row, "n bigint, positives bigint, metrics_agree boolean, learns boolean")
