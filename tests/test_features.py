import math

import pytest
from pyspark.sql import functions as F

from wanewatch.functions import scalars
from wanewatch.operators import binning, clean, features


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "category string")


def hashed(df, width):
    made = features.hash_encode(df, "category", width)
    return [r[0] for r in made.select("category_hash").collect()]


def test_hash_width_and_unseen(spark):
    for width in (8, 16):
        rows = hashed(frame(spark, ["a", "b", "c", "never seen", None]), width)
        assert all(len(r) == width and sum(abs(x) for x in r) == 1 for r in rows)


def test_hash_is_stable_and_separates(spark):
    first, second, other = hashed(frame(spark, ["test", "test", "other"]), 32)
    assert first == second and first != other


def test_embedding_size_unknown_and_bounds(spark):
    table = features.embedding_table(frame(spark, ["a", "b", "c", "a"]), "category", 4)
    assert table.count() == 3
    made = features.embed(frame(spark, ["a", "unknown"]), "category", table, 4)
    rows = {r["category"]: r["category_vector"] for r in made.collect()}
    assert rows["unknown"] == [0.0] * 4 and any(rows["a"])
    many = features.embedding_table(frame(spark, [f"cat_{i}" for i in range(100)]), "category", 32)
    limit = math.sqrt(6 / 33)
    assert all(-limit <= x <= limit for r in many.collect() for x in r["vector"])


def test_cross_values_missing_column_and_null(spark):
    df = spark.createDataFrame(
        [("x", "1", "p"), ("y", None, "q")], "a string, b string, c string"
    )
    made = features.cross_features(df, [("a", "b"), ("b", "c"), ("a", "gone")])
    assert "a_x_gone" not in made.columns
    assert [r["a_x_b"] for r in made.orderBy("a").collect()] == ["x_1", "y_nan"]
    stage = features.FeatureCrosser(pairs=["a|c"])
    assert [r["a_x_c"] for r in stage.transform(df).orderBy("a").collect()] == ["x_p", "y_q"]


def test_crosser_saves_and_loads(spark, tmp_path):
    features.FeatureCrosser(pairs=["a|b"]).save(str(tmp_path / "stage"))
    loaded = features.FeatureCrosser.load(str(tmp_path / "stage"))
    df = spark.createDataFrame([("m", "n")], "a string, b string")
    assert loaded.transform(df).first()["a_x_b"] == "m_n"


def test_numbers_in_text(spark):
    texts = ["1.5", " 7 ", "", " ", "1.0d", "1e3", "-.5", "abc", None, "0x10"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [r[0] for r in df.orderBy("i").select(scalars.to_number("t")).collect()]
    assert found == [1.5, 7.0, None, None, None, 1000.0, -0.5, None, None, None]


def test_labels_and_tenure_bands(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("Unknown",), (None,)], "c string")
    rows = df.select(scalars.label_map("c").alias("m"), scalars.label_flag("c").alias("f"))
    assert [tuple(r) for r in rows.collect()] == [(1, 1), (0, 0), (None, 0), (None, 0)]
    edges = [0, 1, 12, 13, 24, 48, 72, 73, -1]
    df = spark.createDataFrame([(i, e) for i, e in enumerate(edges)], "i int, tenure int")
    found = [r[0] for r in df.orderBy("i").select(scalars.tenure_group()).collect()]
    assert found == [None, "0-1yr", "0-1yr", "1-2yr", "1-2yr", "2-4yr", "4yr+", None, None]


def test_service_count_counts_null_and_no_internet(spark):
    df = spark.createDataFrame(
        [("No", None, "No internet service")],
        "PhoneService string, MultipleLines string, OnlineBackup string",
    )
    assert df.select(scalars.service_count(df.columns)).first()[0] == 2


def test_scaling_constant_column_and_one_hot(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    made = features.standardise(df, features.scale_statistics(df, ["a", "b"]))
    assert sorted(tuple(r) for r in made.collect()) == [(-1.0, 0.0), (1.0, 0.0)]
    fitted = features.categories(frame(spark, ["b", "a", None]), ["category"])
    assert fitted == {"category": ["a", "b"]}
    row = features.one_hot_columns(frame(spark, ["unseen"]), fitted).first()
    assert row["category=a"] == 0 and row["category=b"] == 0
    wide = features.dummies(frame(spark, ["a", "b"]), fitted)
    assert wide.columns == ["category_b"]


def test_too_many_categories_is_an_error(spark):
    df = frame(spark, [str(i) for i in range(30)])
    with pytest.raises(ValueError):
        features.categories(df, ["category"], limit=10)


def test_label_codes_beyond_the_lookup_bound(spark):
    df = frame(spark, [f"{i:03d}" for i in range(200)] + [None])
    small = features.label_codes(df, "category").collect()
    large = features.label_codes(df, "category", range_rows=50).collect()
    assert sorted(map(tuple, small)) == sorted(map(tuple, large))
    encoded = features.label_encode(df, {"category": features.label_codes(df, "category", 50)})
    assert sorted(r[0] for r in encoded.collect()) == list(range(201))


def test_median_and_mode(spark):
    df = spark.createDataFrame(
        [(1.0, "b"), (2.0, "a"), (3.0, None), (10.0, "a"), (None, "b")], "x double, t string"
    )
    assert clean.medians(df, ["x"]) == {"x": 2.5}
    assert clean.modes(df, ["t"]) == {"t": "a"}
    filled = clean.impute_all(df).collect()
    assert {r["x"] for r in filled} == {1.0, 2.0, 3.0, 10.0, 2.5}
    assert all(r["t"] for r in filled)


def test_column_sets(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert clean.column_set(df, ["a"])["passed"]
    exact = clean.column_set(df, ["a", "c"], exact=True)
    assert exact == {"passed": False, "missing": ["c"], "extra": ["b"]}


def numbers(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "y double")


def test_binning_by_quantiles(spark):
    df = numbers(spark, range(10, 101, 10))
    edges = binning.bin_edges(df, "y", 5)
    made = binning.to_classes(df, "y", edges)
    assert made.count() == 10
    assert {r["y_bin"] for r in made.collect()} == set(range(5))
    assert len(binning.bin_edges(numbers(spark, range(1, 10)), "y", 3)) == 4


def test_binning_merges_equal_edges_and_clips(spark):
    df = numbers(spark, [1, 1, 1, 1, 1, 1, 1, 5])
    edges = binning.bin_edges(df, "y", 4)
    assert edges == [1.0, 5.0] or len(edges) < 5
    far = binning.to_classes(numbers(spark, [-9, 99]), "y", [0.0, 1.0, 2.0])
    assert sorted(r["y_bin"] for r in far.collect()) == [0, 1]


@pytest.mark.parametrize("strategy", ["uniform", "kmeans"])
def test_binning_strategies(spark, strategy):
    df = numbers(spark, [1, 2, 3, 50, 51, 52, 98, 99, 100])
    edges = binning.bin_edges(df, "y", 3, strategy)
    made = binning.to_classes(df, "y", edges)
    assert len(edges) == 4 and len({r["y_bin"] for r in made.collect()}) == 3
    hot = binning.to_classes(df, "y", edges, "onehot").select(
        sum(F.col(f"y_bin_{i}") for i in range(3)).alias("s")
    )
    assert {r["s"] for r in hot.collect()} == {1}


def test_binning_rejects_unknown_names(spark):
    with pytest.raises(ValueError):
        binning.bin_edges(numbers(spark, [1, 2]), "y", 2, "other")
    with pytest.raises(ValueError):
        binning.to_classes(numbers(spark, [1, 2]), "y", [0, 1, 2], "other")


def test_weighted_bins_match_repeated_rows(spark):
    rows = [(float(v), v % 4 + 1) for v in range(1, 40)]
    df = spark.createDataFrame(rows, "y double, w int")
    repeated = sorted(v for v, w in rows for _ in range(w))
    expected = [repeated[math.ceil(len(repeated) * i / 4) - 1] for i in (1, 2, 3)]
    assert binning.bin_edges(df, "y", 4, "quantile", "w")[1:-1] == expected


def test_wide_dictionary_and_sparse_one_hot(spark):
    """5,000 categories in ranges of 700; a hot value, NULL, an unseen value and clashing names."""
    names = [f"c{i % 5000}" for i in range(6000)] + ["c1"] * 3000 + [None]
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(names)], "k int, category string, code string")
    codes = features.label_codes(df, "category", range_rows=700)
    ordered = sorted({v or "nan" for v in names})
    assert {r["category"]: r["code"] for r in codes.collect()} == {v: i for i, v in enumerate(ordered)}
    for first in (False, True):
        seen = spark.createDataFrame([(1, "c1", "x"), (2, "other", "x"), (3, None, "x"), (4, ordered[0], "x")], df.schema)
        made = features.one_hot_sparse(seen, {"category": codes}, drop_first=first)
        assert made.columns == ["k", "code", "category_hot"]
        rows = {r["k"]: r["category_hot"] for r in made.collect()}
        assert {r["size"] for r in rows.values()} == {len(ordered) - first}
        assert rows[1]["indices"] == [ordered.index("c1") - first] and rows[1]["values"] == [1.0]
        assert rows[2]["indices"] == rows[2]["values"] == []
        assert rows[3]["indices"] == [ordered.index("nan") - first]
        assert rows[4]["indices"] == ([] if first else [0])
    assert features.label_codes(df.limit(0), "category").count() == 0
