import os
import sys

os.environ.setdefault("OMP_NUM_THREADS", "1")
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import numpy as np
import pandas as pd
import pytest

from loomcast.operators.reshape import series_index
from loomcast.session import local_session, ship_package


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    ship_package(session)
    return session


@pytest.fixture(scope="session")
def frames(spark):
    """(pandas rows, bounded series, unbounded series): three keys with gaps, waves, ties and a walk."""
    rng = np.random.default_rng(7)
    parts = []
    for k, n in (("a", 300), ("b", 211), ("c", 90)):
        i = np.arange(n)
        x = rng.normal(size=n)
        y = np.zeros(n)
        for t in range(3, n):
            y[t] = 0.5 * y[t - 1] + 0.6 * x[t - 3] + rng.normal() * 0.4
        wave = 10 + 3 * np.sin(2 * np.pi * i / 26) + 0.01 * i + rng.normal(size=n) * 0.3
        gaps = np.where((i % 7 == 3) | (i < 2) | (i > n - 3), np.nan, wave)
        ties = rng.integers(0, 6, n).astype(float) + i // 60
        parts.append(
            pd.DataFrame(
                {"k": k, "h": i * 2, "x": x, "y": y, "wave": wave, "v": gaps, "ties": ties, "walk": np.cumsum(x)}
            )
        )
    pdf = pd.concat(parts, ignore_index=True)
    table = spark.createDataFrame(pdf).replace(float("nan"), None)
    bounded = series_index(table, ["k"], "h", span=(0, 100_000)).cache()
    unbounded = series_index(table, ["k"], "h").cache()
    return pdf, bounded, unbounded


def table_of(df, *order):
    return df.toPandas().sort_values(list(order)).reset_index(drop=True)
