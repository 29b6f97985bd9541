import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import local_session
    s = local_session(8, 4, "tests", str(tmp_path_factory.mktemp("shared")))
    s.sparkContext.setCheckpointDir(s.conf.get("spark.checkpoint.dir"))
    return s


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def hourly(spark):
    """A keyed series with a daily shape, a constant series and a short one, from a generator."""
    import numpy as np
    import pandas as pd

    rng, frames = np.random.default_rng(7), []
    t = pd.date_range("2024-01-01", periods=900, freq="h")
    frames.append(pd.DataFrame({"k": "a", "ts": t, "x": (50 + 30 * np.sin(np.arange(900) * 2 * np.pi / 24) + rng.normal(0, 5, 900)).round().astype("int64")}))
    frames.append(pd.DataFrame({"k": "b", "ts": t[:300], "x": rng.poisson(2, 300).astype("int64")}))
    frames.append(pd.DataFrame({"k": "c", "ts": t[:5], "x": np.full(5, 3, dtype="int64")}))
    pdf = pd.concat(frames, ignore_index=True)
    df = spark.createDataFrame(pdf).select("k", pdf_ts(), "x")
    return pdf, df


def pdf_ts():
    from pyspark.sql import functions as F
    return F.col("ts").cast("timestamp_ntz").alias("ts")
