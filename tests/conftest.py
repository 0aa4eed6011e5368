import os
import sys

import numpy as np
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from plumbline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rng():
    return np.random.default_rng(0)


@pytest.fixture(scope="session")
def linear_data(spark):
    """id, four features, y driven by f0."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 4))
    y = 3 * x[:, 0] + rng.normal(0, 0.2, 400) + 50
    rows = [(i, *map(float, x[i]), float(y[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, f0 double, f1 double, f2 double, f3 double, y double")
    return df.repartition(4).persist()


FEATURES = ["f0", "f1", "f2", "f3"]
