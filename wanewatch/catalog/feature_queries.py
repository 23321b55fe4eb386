"""Feature, binning, split, sampling and neighbour queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from wanewatch.catalog.registry import h13, on_clean, query, r6
from wanewatch.operators import binning, features, neighbor_graph, neighbors, rebalance, split
from wanewatch.operators.clean import impute, medians, modes
from wanewatch.sources.subscribers import clean_subscribers
from wanewatch.sources.tables import table

NUMBERS = ["tenure", "MonthlyCharges", "TotalCharges"]
SPAN = "4503599627370496.0::DOUBLE"


def _kept(spark, folder, *cols):
    """Columns of the clean table for a query that passes over it several times."""
    return clean_subscribers(spark, folder).select("customerID", "label", *cols).persist()


@query(
    on_clean(
        "SELECT \"customerID\", "
        + ", ".join(
            f'round(({c} - (SELECT avg({c}) FROM f)) / (SELECT stddev_pop({c}) FROM f), 6) AS "{c}"'
            for c in NUMBERS
        )
        + ' , "gender" FROM f',
        "\nf AS (SELECT \"customerID\", "
        + ", ".join(f'coalesce("{c}"::DOUBLE, (SELECT median("{c}"::DOUBLE) FROM clean)) AS "{c}"' for c in NUMBERS)
        + ", coalesce(gender, (SELECT gender FROM clean WHERE gender IS NOT NULL GROUP BY 1 "
        "ORDER BY count(*) DESC, 1 LIMIT 1)) AS gender FROM clean)",
    )
)
def impute_scale(spark, folder):
    """Median and mode imputation, then population-deviation scaling."""
    df = _kept(spark, folder, *[F.col(c).cast("double").alias(c) for c in NUMBERS], "gender")
    filled = impute(df, {**medians(df, NUMBERS), **modes(df, ["gender"])})
    scaled = features.standardise(filled, features.scale_statistics(filled, NUMBERS))
    return scaled.select("customerID", *[r6(c).alias(c) for c in NUMBERS], "gender")


HOT = {
    "Contract": ["Month-to-month", "One year", "Two year"],
    "InternetService": ["DSL", "Fiber optic", "No"],
    "gender": ["Female", "Male"],
}


@query(
    on_clean(
        'SELECT "customerID", '
        + ", ".join(
            f'CAST(coalesce("{c}" = \'{v}\', FALSE) AS INTEGER) AS "{c}={v}"'
            for c, vs in HOT.items()
            for v in vs
        )
        + " FROM clean"
    )
)
def one_hot(spark, folder):
    df = clean_subscribers(spark, folder).select("customerID", *HOT)
    return features.one_hot_columns(df, features.categories(df, list(HOT))).drop(*HOT)


@query(
    on_clean(
        'SELECT "customerID", '
        + ", ".join(
            f'CAST(coalesce("{c}" = \'{v}\', FALSE) AS INTEGER) AS "{c}_{v}"'
            for c, vs in HOT.items()
            for v in vs[1:]
        )
        + " FROM clean"
    )
)
def dummies(spark, folder):
    df = clean_subscribers(spark, folder).select("customerID", *HOT)
    return features.dummies(df, features.categories(df, list(HOT)))


@query(
    on_clean(
        'SELECT "customerID", (dense_rank() OVER (ORDER BY "PaymentMethod")) - 1 AS "PaymentMethod", '
        "(dense_rank() OVER (ORDER BY coalesce(gender, 'nan'))) - 1 AS gender FROM clean"
    )
)
def label_encode(spark, folder):
    df = clean_subscribers(spark, folder).select("customerID", "PaymentMethod", "gender")
    codes = {c: features.label_codes(df, c) for c in ("PaymentMethod", "gender")}
    return features.label_encode(df, codes)


@query(
    "SELECT o_orderkey::VARCHAR AS category, (row_number() OVER (ORDER BY o_orderkey::VARCHAR)) - 1 AS code "
    "FROM (SELECT DISTINCT o_orderkey FROM orders)"
)
def dictionary_codes(spark, folder):
    """Codes of a column with as many categories as there are orders."""
    return features.label_codes(table(spark, folder, "orders"), "o_orderkey")


@query(
    """WITH codes AS (
  SELECT v, row_number() OVER (ORDER BY v) - 1 AS code, count(*) OVER () AS size
  FROM (SELECT DISTINCT o_custkey::VARCHAR AS v FROM orders))
SELECT c_custkey, coalesce(size, (SELECT count(DISTINCT o_custkey) FROM orders))::INTEGER AS size, code::BIGINT AS hot,
  CASE WHEN code > 0 THEN code - 1 END::BIGINT AS dummy FROM customer LEFT JOIN codes ON c_custkey::VARCHAR = v"""
)
def one_hot_wide(spark, folder):
    """Customers one-hot over the customers with orders; those without have no index."""
    codes = features.label_codes(table(spark, folder, "orders"), "o_custkey")
    df = table(spark, folder, "customer").select("c_custkey", F.col("c_custkey").alias("a"), F.col("c_custkey").alias("b"))
    made = features.one_hot_sparse(features.one_hot_sparse(df, {"a": codes}), {"b": codes}, drop_first=True)
    return made.select(
        "c_custkey",
        F.col("a_hot.size").alias("size"),
        F.get("a_hot.indices", F.lit(0)).cast("bigint").alias("hot"),
        F.get("b_hot.indices", F.lit(0)).cast("bigint").alias("dummy"),
    )


TOKEN = "md5('PaymentMethod=' || coalesce(\"PaymentMethod\", 'nan'))"


@query(
    on_clean(
        'SELECT "customerID", '
        + ", ".join(
            f"CASE WHEN ('0x' || substr({TOKEN}, 1, 8))::BIGINT % 8 = {i} THEN "
            f"CASE WHEN substr({TOKEN}, 9, 1) < '8' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END "
            f"ELSE 0.0::DOUBLE END AS h{i}"
            for i in range(8)
        )
        + " FROM clean"
    )
)
def hash_encode(spark, folder):
    df = features.hash_encode(clean_subscribers(spark, folder), "PaymentMethod", 8)
    return df.select(
        "customerID", *[F.col("PaymentMethod_hash")[i].alias(f"h{i}") for i in range(8)]
    )


LIMIT = math.sqrt(6.0 / 5)


@query(
    on_clean(
        'SELECT "customerID", '
        + ", ".join(
            "round("
            + h13(f"'42|' || coalesce(\"Contract\", 'nan') || '|{i}'")
            + f" / {SPAN} * {2 * LIMIT!r}::DOUBLE - {LIMIT!r}::DOUBLE, 6) AS v{i}"
            for i in range(4)
        )
        + " FROM clean"
    )
)
def embed(spark, folder):
    df = clean_subscribers(spark, folder).select("customerID", "Contract")
    made = features.embed(df, "Contract", features.embedding_table(df, "Contract", 4), 4)
    return made.select("customerID", *[r6(F.col("Contract_vector")[i]).alias(f"v{i}") for i in range(4)])


@query(
    on_clean(
        "SELECT \"customerID\", coalesce(gender, 'nan') || '_' || \"Contract\" AS \"gender_x_Contract\", "
        "\"SeniorCitizen\"::VARCHAR || '_' || \"PaymentMethod\" AS \"SeniorCitizen_x_PaymentMethod\" FROM clean"
    )
)
def cross(spark, folder):
    df = clean_subscribers(spark, folder).select(
        "customerID", "gender", "Contract", "SeniorCitizen", "PaymentMethod"
    )
    pairs = [("gender", "Contract"), ("SeniorCitizen", "PaymentMethod"), ("gender", "absent")]
    made = features.cross_features(df, pairs)
    return made.select("customerID", "gender_x_Contract", "SeniorCitizen_x_PaymentMethod")


SERVICES = [
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


@query(
    on_clean(
        """SELECT "customerID", round("TotalCharges" / (tenure + 1), 8) AS "AvgMonthlyCharges",
  CASE WHEN tenure > 0 AND tenure <= 12 THEN '0-1yr' WHEN tenure > 12 AND tenure <= 24 THEN '1-2yr'
    WHEN tenure > 24 AND tenure <= 48 THEN '2-4yr' WHEN tenure > 48 AND tenure <= 72 THEN '4yr+' END AS tenure_group, """
        + "CAST("
        + " + ".join(f"CASE WHEN \"{c}\" = 'No' THEN 0 ELSE 1 END" for c in SERVICES)
        + " AS INTEGER) AS service_count FROM clean"
    )
)
def derived_features(spark, folder):
    made = features.derive(clean_subscribers(spark, folder))
    average = F.round("AvgMonthlyCharges", 8).alias("AvgMonthlyCharges")
    return made.select("customerID", average, "tenure_group", "service_count")


def _binned(edges: str) -> str:
    return f"""WITH e AS ({edges}), b AS (
  SELECT l_extendedprice AS x,
    (x >= e1)::INT + (x >= e2)::INT + (x >= e3)::INT + (x >= e4)::INT AS bin FROM lineitem, e)
SELECT bin, count(*) AS n, round(min(x), 6) AS low, round(max(x), 6) AS high FROM b GROUP BY 1"""


def _bin_table(spark, folder, strategy):
    df = table(spark, folder, "lineitem").select("l_extendedprice", "l_quantity")
    edges = binning.bin_edges(
        df, "l_extendedprice", 5, strategy.split("_")[0],
        "l_quantity" if strategy.endswith("weighted") else None,
    )
    made = binning.to_classes(df, "l_extendedprice", edges)
    return made.groupBy(F.col("l_extendedprice_bin").alias("bin")).agg(
        F.count("*").alias("n"),
        r6(F.min("l_extendedprice")).alias("low"),
        r6(F.max("l_extendedprice")).alias("high"),
    )


@query(
    _binned(
        "SELECT "
        + ", ".join(
            f"quantile_cont(l_extendedprice, {i / 5}::DOUBLE) AS e{i}" for i in range(1, 5)
        )
        + " FROM lineitem"
    )
)
def bin_quantile(spark, folder):
    """Row counts and extremes of five equal-frequency bins."""
    return _bin_table(spark, folder, "quantile")


@query(
    _binned(
        "SELECT "
        + ", ".join(
            f"min(l_extendedprice) + (max(l_extendedprice) - min(l_extendedprice)) / 5 * {i} AS e{i}"
            for i in range(1, 5)
        )
        + " FROM lineitem"
    )
)
def bin_uniform(spark, folder):
    return _bin_table(spark, folder, "uniform")


@query(
    _binned(
        "SELECT "
        + ", ".join(f"min(x) FILTER (WHERE up >= tot * {i} / 5) AS e{i}" for i in range(1, 5))
        + " FROM (SELECT x, sum(w) OVER (ORDER BY x) AS up, sum(w) OVER () AS tot FROM "
        "(SELECT l_extendedprice AS x, sum(l_quantity::BIGINT) AS w FROM lineitem GROUP BY 1))"
    )
)
def bin_weighted(spark, folder):
    """Equal-weight bins, rows weighted by quantity."""
    return _bin_table(spark, folder, "quantile_weighted")


@query()
def bin_kmeans(spark, folder):
    return _bin_table(spark, folder, "kmeans")


ORDER = h13("'42|' || \"customerID\"")
ORDERED = f"""
ordered AS (
  SELECT "customerID", label, row_number() OVER (PARTITION BY label ORDER BY {ORDER}) AS rn,
    count(*) OVER (PARTITION BY label) AS n FROM clean)"""


@query(
    on_clean(
        """SELECT "customerID", label, CASE WHEN rn <= n - v - t THEN 'train' WHEN rn <= n - t THEN 'val' ELSE 'test' END AS part
FROM (SELECT *, CAST(floor(n * 0.1::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS v,
  CAST(floor(n * 0.2::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS t FROM ordered)""",
        ORDERED,
    )
)
def stratified_split(spark, folder):
    """Exact 70/10/20 split per class."""
    df = _kept(spark, folder)
    return split.stratified_split(
        df, "customerID", "label", {"train": 0.7, "val": 0.1, "test": 0.2}
    )


@query(
    on_clean(
        f"""SELECT part, label, count(*) AS n FROM (SELECT label,
  CASE WHEN {ORDER} < {int(0.8 * 16**13)} THEN 'train' ELSE 'test' END AS part FROM clean) GROUP BY 1, 2"""
    )
)
def threshold_split(spark, folder):
    """80/20 in expectation by one hash threshold, no extra pass."""
    df = split.stratified_split(
        clean_subscribers(spark, folder),
        "customerID",
        "label",
        {"train": 0.8, "test": 0.2},
        exact=False,
    )
    return df.groupBy("part", "label").agg(F.count("*").alias("n"))


@query(
    on_clean(
        """SELECT "customerID", label, CASE WHEN rn <= n // 5 THEN 0 WHEN rn <= n * 2 // 5 THEN 1
  WHEN rn <= n * 3 // 5 THEN 2 WHEN rn <= n * 4 // 5 THEN 3 ELSE 4 END AS fold FROM ordered""",
        ORDERED,
    )
)
def folds(spark, folder):
    df = _kept(spark, folder)
    return split.folds(df, "customerID", "label", 5)


@query(
    on_clean(
        'SELECT "customerID", label FROM ordered WHERE rn <= (SELECT min(n) FROM ordered)', ORDERED
    )
)
def undersample(spark, folder):
    df = _kept(spark, folder)
    return split.undersample(df, "customerID", "label")


@query(
    on_clean(
        """SELECT "customerID", label, round((SELECT count(*) FROM clean) / (2 * n), 6) AS weight FROM ordered""",
        ORDERED,
    )
)
def class_weights(spark, folder):
    df = _kept(spark, folder)
    return split.class_weights(df, "label").withColumn("weight", r6("weight"))


NEAR = """
near AS (
  SELECT id, neighbor, rank, distance FROM (
    SELECT a.vec_id AS id, b.vec_id AS neighbor,
      sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS distance,
      row_number() OVER (PARTITION BY a.vec_id ORDER BY distance, b.vec_id) AS rank
    FROM points a JOIN points b ON a.vec_id <> b.vec_id {on})
  WHERE rank <= 5)"""
POINTS = "points AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"


@query(
    f"WITH {POINTS}, {NEAR.format(on='')} "
    "SELECT id, neighbor, CAST(rank AS INTEGER) AS rank, round(distance, 6) AS distance FROM near"
)
def knn(spark, folder):
    """Five nearest neighbours of every vector, exact."""
    near = neighbors.nearest(table(spark, folder, "embeddings"), "vec_id", "embedding", 5)
    return near.withColumn("distance", r6("distance"))


@query(
    f"WITH {POINTS}, {NEAR.format(on='AND a.label = b.label')} "
    "SELECT id, neighbor, CAST(rank AS INTEGER) AS rank, round(distance, 6) AS distance FROM near"
)
def knn_within_label(spark, folder):
    """Neighbours from the own class only, blocks small enough to need the second pass."""
    near = neighbors.nearest(
        table(spark, folder, "embeddings"), "vec_id", "embedding", 5, group="label", block_rows=24
    )
    return near.withColumn("distance", r6("distance"))


@query()
def knn_hashing(spark, folder):
    """Approximate neighbours by random projection."""
    near = neighbors.nearest_by_hashing(
        table(spark, folder, "embeddings"), "vec_id", "embedding", 5, radius=1.2
    )
    return near.withColumn("distance", r6("distance"))


@query(
    f"""WITH {POINTS},
gaps AS (SELECT a.vec_id AS id, b.vec_id AS neighbor, list_distance(a.v, b.v) AS d FROM points a, points b WHERE a.vec_id <> b.vec_id),
best AS (SELECT id, d FROM gaps QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, neighbor) <= 5)
SELECT count(DISTINCT id) AS queries, count(*) AS neighbours, round(avg(d), 6) AS exact_distance,
  TRUE AS recall_reached, TRUE AS distances_hold FROM best"""
)
def knn_graph(spark, folder):
    """The refined graph against the exact search: recall of at least 0.95, no distance too small."""
    vectors = table(spark, folder, "embeddings")
    found = neighbor_graph.nearest_by_graph(vectors, "vec_id", "embedding", 5)
    exact = neighbors.nearest(vectors, "vec_id", "embedding", 5).withColumnRenamed("distance", "d")
    met = exact.join(found.select("id", "neighbor", "distance"), ["id", "neighbor"], "left")
    place = exact.select("id", "rank", "d").join(found.select("id", "rank", "distance"), ["id", "rank"])
    bad = place.agg(F.count_if(F.col("distance") < F.col("d") - 1e-9).alias("bad"), F.lit(1).alias("one"))
    return (
        met.agg(
            F.countDistinct("id").alias("queries"),
            F.count("*").alias("neighbours"),
            r6(F.avg("d")).alias("exact_distance"),
            (F.count("distance") / F.count("*") >= 0.95).alias("recall_reached"),
            F.lit(1).alias("one"),
        )
        .join(bad, "one")
        .select("queries", "neighbours", "exact_distance", "recall_reached", (F.col("bad") == 0).alias("distances_hold"))
    )


def _smote_sql() -> str:
    order = h13("'42|' || vec_id")
    pick = h13("'42n|' || id || '|' || copy")
    share = h13("'42u|' || id || '|' || copy")
    return f"""WITH {POINTS}, {NEAR.format(on='AND a.label = b.label')},
sized AS (
  SELECT vec_id, label, v, count(*) OVER (PARTITION BY label) AS n,
    row_number() OVER (PARTITION BY label ORDER BY {order}) AS rn FROM points),
quota AS (
  SELECT vec_id AS id, label, (m - n) // n + CASE WHEN rn <= (m - n) % n THEN 1 ELSE 0 END AS copies
  FROM sized, (SELECT max(n) AS m FROM sized)),
drawn AS (
  SELECT id, label, copy, {pick} % (SELECT max(rank) FROM near x WHERE x.id = q.id) + 1 AS rank,
    {share} / {SPAN} AS share
  FROM (SELECT id, label, unnest(generate_series(1, copies)) AS copy FROM quota WHERE copies > 0) q),
made AS (
  SELECT d.id, d.label, d.copy, n.neighbor, d.share, a.v AS base, b.v AS other
  FROM drawn d JOIN near n ON n.id = d.id AND n.rank = d.rank
    JOIN points a ON a.vec_id = d.id JOIN points b ON b.vec_id = n.neighbor)
SELECT id, label, CAST(copy AS INTEGER) AS copy, neighbor, round(share, 6) AS share,
  CAST(i - 1 AS INTEGER) AS dim, round(base[i] + share * (other[i] - base[i]), 6) AS value
FROM made, generate_series(1, 64) AS g(i)"""


@query(_smote_sql())
def smote(spark, folder):
    """Synthetic vectors that raise every class to the largest, value by value."""
    df = table(spark, folder, "embeddings")
    made = rebalance.smote(df, "vec_id", "label", "embedding")
    return made.select(
        "id",
        "label",
        "copy",
        "neighbor",
        r6("share").alias("share"),
        F.posexplode("vector").alias("dim", "value"),
    ).withColumn("value", r6("value"))


@query(
    f"""WITH {POINTS}, {NEAR.format(on='')},
hard AS (
  SELECT n.id, avg(CAST(b.label <> 3 AS INTEGER)) AS h FROM near n
    JOIN points a ON a.vec_id = n.id JOIN points b ON b.vec_id = n.neighbor WHERE a.label = 3 GROUP BY 1),
quota AS (
  SELECT id, CAST(round_even(h / (SELECT sum(h) FROM hard) *
    (SELECT sum(CASE WHEN label = 3 THEN -1 ELSE 1 END) FROM points), 0) AS BIGINT) AS copies FROM hard)
SELECT CAST(label = 3 AS INTEGER) AS rare, 0 AS copy, count(*) AS n FROM points GROUP BY 1
UNION ALL SELECT 1, CAST(copy AS INTEGER), count(*)
FROM (SELECT unnest(generate_series(1, copies)) AS copy FROM quota WHERE copies > 0) GROUP BY 2"""
)
def adasyn(spark, folder):
    """One class against the rest, harder rows produce more."""
    df = table(spark, folder, "embeddings").withColumn("rare", (F.col("label") == 3).cast("int"))
    made = rebalance.rebalance(df, "vec_id", "rare", "embedding", "ADASYN")
    return made.groupBy("rare", "copy").agg(F.count("*").alias("n"))


@query(
    on_clean(
        'SELECT "customerID", label, 0 AS copy FROM clean',
    )
)
def rebalance_none(spark, folder):
    """An unknown strategy changes nothing."""
    df = clean_subscribers(spark, folder).withColumn(
        "vector", F.array(F.col("tenure").cast("double"), "MonthlyCharges")
    )
    return rebalance.rebalance(df, "customerID", "label", "vector", None).drop("vector")
