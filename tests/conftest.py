from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wanewatch.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def classified(spark):
    """400 rows, 4 informative numbers and noise, balanced classes."""
    import numpy as np

    rng = np.random.default_rng(7)
    y = np.arange(400) % 2
    x = rng.normal(size=(400, 6))
    x[:, :3] += y[:, None] * 1.5
    return feature_frame(spark, x, y).persist()


@pytest.fixture(scope="session")
def imbalanced(spark):
    """300 rows, nine to one."""
    import numpy as np

    rng = np.random.default_rng(8)
    y = (np.arange(300) % 10 == 0).astype(int)
    x = rng.normal(size=(300, 4)) + y[:, None]
    return feature_frame(spark, x, y).persist()


def feature_frame(spark, x, y):
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    rows = [(i, [float(v) for v in x[i]], int(y[i])) for i in range(len(y))]
    df = spark.createDataFrame(rows, "key bigint, v array<double>, label int").repartition(2)
    return df.select("key", array_to_vector(F.col("v")).alias("features"), "label")
