"""A series cut into small blocks must give what the whole series gives."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loomcast.functions.blocks import known_bound, quantiles, value_counts
from loomcast.operators import arma, decompose, hypothesis, impute, profile, selection, spectrum, stationarity, windows
from tests.conftest import table_of


def same(left, right, *order):
    a, b = table_of(left, *order), table_of(right, *order)
    assert len(a) == len(b) and len(a)
    b = b[a.columns]
    for c in a.columns:
        if a[c].dtype.kind == "f":
            np.testing.assert_allclose(a[c].to_numpy(), b[c].to_numpy(), rtol=1e-7, atol=1e-9, err_msg=c)
        else:
            assert (a[c].astype(str) == b[c].astype(str)).all(), c


def test_positions_agree_and_only_one_is_bounded(frames):
    _, bounded, unbounded = frames
    assert known_bound(bounded, "i") == 100_000 and known_bound(unbounded, "i") is None
    same(bounded.select("k", "h", "i"), unbounded.select("k", "h", "i"), "k", "h")


def test_order_outside_its_span_fails(frames):
    from loomcast.operators.reshape import series_index

    with pytest.raises(Exception, match="outside"):
        series_index(frames[1].drop("i"), ["k"], "h", span=(0, 50)).agg(F.sum("i")).collect()


def test_timestamp_order_is_numbered_by_day_blocks(spark):
    from loomcast.operators.reshape import series_index

    base = pd.Timestamp("2024-01-01")
    pdf = pd.DataFrame({"k": "a", "ts": [base + pd.Timedelta(hours=5 * i) for i in range(100)]})
    got = table_of(series_index(spark.createDataFrame(pdf), ["k"], "ts"), "ts")
    assert got["i"].tolist() == list(range(100))


CASES = {
    "ffill": lambda df, s: windows.fill_forward(df, ["k"], "i", "v", size=s),
    "bfill": lambda df, s: windows.fill_backward(df, ["k"], "i", "v", size=s),
    "linear": lambda df, s: windows.fill_linear(df, ["k"], "i", "v", size=s),
    "knn": lambda df, s: windows.fill_neighbour_mean(df, ["k"], "i", "v", size=s),
    "all": lambda df, s: windows.fill_candidates(df, ["k"], "i", "v", size=s),
    "lags": lambda df, s: windows.lag_features(df, ["k"], "i", {"x": 9}, size=s),
    "diff": lambda df, s: windows.difference(df, ["k"], "i", "wave", 3, size=s),
    "peaks": lambda df, s: windows.moving_peaks(df, ["k"], "i", "wave", 30, 1.5, size=s),
    "season": lambda df, s: decompose.seasonal_decompose(df, ["k"], "i", "wave", 26, size=s),
}


@pytest.mark.parametrize("name", CASES)
def test_windows(frames, name):
    _, bounded, unbounded = frames
    same(CASES[name](bounded, None), CASES[name](unbounded, 16), "k", "i")


def test_cubic_from_blocks_of_knots(frames, monkeypatch):
    _, bounded, unbounded = frames
    monkeypatch.setattr(impute, "_KNOT_BLOCK", 80)
    whole = impute.fill_cubic(bounded, ["k"], "i", "v")
    cut = impute.fill_cubic(unbounded, ["k"], "i", "v", blocks=True)
    same(whole.select("k", "i", "filled"), cut.select("k", "i", "filled"), "k", "i")


def test_holdout_is_the_same_for_both(frames):
    _, bounded, unbounded = frames
    a = impute.holdout_mask(bounded, ["k"], "i", "wave", 20)
    b = impute.holdout_mask(unbounded, ["k"], "i", "wave", 20)
    same(a, b, "k", "j")
    assert a.where("hidden").groupBy("k").count().where("count = 20").count() == 3


def test_regressions_and_correlations(frames):
    _, bounded, unbounded = frames
    same(spectrum.acf(bounded, ["k"], "i", "v", 20), spectrum.acf(unbounded, ["k"], "i", "v", 20, size=25), "k", "lag")
    same(
        stationarity.adf_by_difference(bounded, ["k"], "i", "walk", 2),
        stationarity.adf_by_difference(unbounded, ["k"], "i", "walk", 2, size=40),
        "k",
        "d",
    )
    same(
        selection.granger(bounded, ["k"], "i", "y", "x", 6),
        selection.granger(unbounded, ["k"], "i", "y", "x", 6, size=40),
        "k",
        "lag",
    )


def test_arma_stages(frames):
    _, bounded, unbounded = frames
    a = arma.innovations(bounded, ["k"], "i", "y", ["x"])
    b = arma.innovations(unbounded, ["k"], "i", "y", ["x"], size=50)
    same(a, b, "k", "i")
    drop = ["terms", "coef", "se"]
    same(
        arma.arma_grid(a, ["k"], [1, 2], [0, 1], [0, 12], ["x"]).drop(*drop),
        arma.arma_grid(b, ["k"], [1, 2], [0, 1], [0, 12], ["x"], size=50).drop(*drop),
        "k",
        "season",
        "p",
        "q",
    )


def test_value_order_is_the_same_with_splits(frames):
    _, bounded, _ = frames
    for c in ("x", "ties"):
        same(value_counts(bounded, ["k"], c), value_counts(bounded, ["k"], c, max_rows=40), "k", c)
        same(profile.ecdf(bounded, ["k"], c), profile.ecdf(bounded, ["k"], c, max_rows=40), "k", c)
        same(profile.boxplot_stats(bounded, ["k"], c), profile.boxplot_stats(bounded, ["k"], c, max_rows=40), "k")
        same(
            windows.winsorize_upper(bounded, ["k"], c, 5).select("k", "i", "capped"),
            windows.winsorize_upper(bounded, ["k"], c, 5, max_rows=40).select("k", "i", "capped"),
            "k",
            "i",
        )
    halves = bounded.withColumn("half", F.when(F.col("i") < 100, "p").otherwise("q"))
    same(
        hypothesis.ks_two_sample(halves, ["k"], "half", "x", "p", "q"),
        hypothesis.ks_two_sample(halves, ["k"], "half", "x", "p", "q", max_rows=40),
        "k",
    )


def test_quantiles_match_numpy(frames):
    pdf, bounded, _ = frames
    counts = value_counts(bounded, ["k"], "x", max_rows=40)
    got = table_of(quantiles(counts, ["k"], "x", {"q": 0.3}), "k")
    want = pdf.groupby("k")["x"].quantile(0.3)
    np.testing.assert_allclose(got["q"], want)


def test_results_do_not_depend_on_partitioning(frames):
    _, bounded, _ = frames
    plain = impute.impute_easy(bounded, ["k"], "i", "v", 20)
    mixed = impute.impute_easy(bounded.repartition(7, "x"), ["k"], "i", "v", 20)
    same(plain.select("k", "i", "method", "filled"), mixed.select("k", "i", "method", "filled"), "k", "i")
