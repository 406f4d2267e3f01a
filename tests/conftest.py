import os
import sys
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("creditloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="creditloom-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["one task", "bucketed"])
def both_paths(spark, request):
    """Run a test with the small-data path and with the bucketed one."""
    key = "spark.creditloom.oneTaskRows"
    spark.conf.set(key, "1000000" if request.param == "one task" else "20")
    yield request.param
    spark.conf.unset(key)


@pytest.fixture(scope="session")
def scored_pdf():
    """Scores with heavy ties, three splits, and one score that holds a third of the rows."""
    rng = np.random.default_rng(7)
    n = 1500
    p = np.round(rng.beta(1.5, 8, n), 3)
    p[rng.random(n) < 0.33] = 0.1
    return pd.DataFrame(
        {
            "id": rng.permutation(n),
            "split": rng.choice(["train", "valid", "oot"], n, p=[0.6, 0.2, 0.2]),
            "p": p,
            "q": np.round(np.clip(p + rng.normal(0, 0.1, n), 0.001, 0.999), 3),
            "y": (rng.random(n) < p).astype(float),
        }
    )
