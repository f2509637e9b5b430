import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelmill.functions.quantiles import Quantile, largest_group, median, narrowed_quantiles, summarise

POINTS = [0.0, 0.01, 0.25, 0.5, 0.77, 1.0]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    n = 4000
    frame = pd.DataFrame({
        # One group holds half of the rows.
        "g": np.where(rng.random(n) < 0.5, "hot", rng.integers(0, 30, n).astype(str)),
        "skewed": np.exp(rng.normal(10, 2, n)),
        "signed": rng.normal(0, 1000, n),
        "tight": 1.0 + rng.random(n) * 1e-9,
        "few": rng.integers(-3, 3, n).astype(float),
    })
    frame.loc[rng.random(n) < 0.4, "few"] = 0.0
    frame.loc[rng.random(n) < 0.1, "signed"] = None
    frame.loc[rng.random(n) < 0.05, "g"] = None
    return frame


COLUMNS = ["skewed", "signed", "tight", "few"]
WANTED = [Quantile(c, p, f"{c}_{i}") for c in COLUMNS for i, p in enumerate(POINTS)]


def expected(frame, keys):
    def one(part):
        return pd.Series({
            f"{c}_{i}": np.quantile(part[c].dropna(), p) for c in COLUMNS for i, p in enumerate(POINTS)
        })

    return frame.dropna(subset=keys).groupby(keys)[COLUMNS].apply(one) if keys else one(frame)


@pytest.mark.parametrize("settings", [
    {}, {"bin_rows": 3}, {"bin_rows": 3, "broadcast_rows": 0, "pieces": 4},
])
@pytest.mark.parametrize("keys", [[], ["g"]])
def test_narrowed_equals_sorted_values(spark, rows, keys, settings):
    df = spark.createDataFrame(rows)
    got = narrowed_quantiles(df, keys, WANTED, **settings).toPandas()
    want = expected(rows, keys)
    if keys:
        got = got.set_index(keys).sort_index()
        assert list(got.index) == list(want.index)
        np.testing.assert_allclose(got[want.columns], want, rtol=1e-12)
    else:
        np.testing.assert_allclose(got.iloc[0][want.index].astype(float), want, rtol=1e-12)


def test_both_ways_and_measures_agree(spark, rows):
    df = spark.createDataFrame(rows)
    measures = [F.count(F.lit(1)).alias("n"), F.sum("few").alias("s")]
    for keys in ([], ["g"]):
        small = summarise(df, keys, measures, WANTED).toPandas()
        large = summarise(df, keys, measures, WANTED, group_rows=10).toPandas()
        order = keys or ["n"]
        pd.testing.assert_frame_equal(
            small.sort_values(order).reset_index(drop=True),
            large[small.columns].sort_values(order).reset_index(drop=True), rtol=1e-12)


def test_null_keys_are_left_out_and_nan_is_no_value(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", float("nan")), ("a", 3.0), (None, 9.0), ("b", None)], "k string, v double")
    for rows in (100, 0):
        got = {r["k"]: r["m"] for r in summarise(df, ["k"], [F.count(F.lit(1)).alias("n")],
                                                 [median("v", "m")], group_rows=rows).collect()}
        assert got == {"a": 2.0, "b": None}
    assert largest_group(df, ["k"]) == 3


def test_approximate_needs_no_check(spark, rows):
    df = spark.createDataFrame(rows)
    got = summarise(df, [], [], [median("skewed", "m")], exact=False).first()["m"]
    assert abs(got - rows["skewed"].median()) / rows["skewed"].median() < 0.05


def test_only_large_groups_are_narrowed(spark, rows, monkeypatch):
    from parcelmill.functions import quantiles

    narrowed, narrow = [], quantiles.narrowed_quantiles

    def noted(df, keys, wanted):
        narrowed.extend(r["g"] for r in df.select("g").distinct().collect())
        return narrow(df, keys, wanted)

    monkeypatch.setattr(quantiles, "narrowed_quantiles", noted)
    got = summarise(spark.createDataFrame(rows), ["g"], [F.count(F.lit(1)).alias("n")], WANTED, group_rows=500)
    assert narrowed == ["hot"]
    got, want = got.toPandas().set_index("g").sort_index(), expected(rows, ["g"]).sort_index()
    assert list(got["n"]) == list(rows.groupby("g").size().sort_index())
    np.testing.assert_allclose(got[want.columns].to_numpy(), want.to_numpy(), rtol=1e-12)
