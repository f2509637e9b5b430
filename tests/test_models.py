import datetime as dt
import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelmill.constants import FOREST_FEATURES, LEAKAGE, VALUE_BOOLEAN, VALUE_CATEGORY, VALUE_NUMERIC
from parcelmill.functions.sampling import random_rows
from parcelmill.operators import attribution, forecast, isolation, valuation


# --- forecast --------------------------------------------------------------

def months(n, start=dt.date(2020, 1, 1)):
    return [(pd.Timestamp(start) + pd.DateOffset(months=i)).date() for i in range(n)]


def test_seasonal_series_keeps_its_interval(spark):
    values = [100 + 10 * math.sin(2 * math.pi * i / 12) + 0.5 * i for i in range(28)]
    df = spark.createDataFrame([("s", m, v) for m, v in zip(months(28, dt.date(2024, 1, 1)), values)],
                               "k string, month date, value double")
    rows = forecast.forecast(df, ["k"]).orderBy("step").collect()
    assert [str(r["month"]) for r in rows] == ["2026-05-01", "2026-06-01", "2026-07-01"]
    assert all(r["hi"] - r["lo"] > 1e-6 for r in rows)


def seasonal_differences(n, a, s, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    w = list(rng.normal(0, scale, 13))
    for _ in range(n - 13):
        w.append(a * w[-1] + s * w[-12] - a * s * w[-13] + rng.normal(0, scale))
    return np.array(w)


def test_fit_is_the_least_squares_point():
    w = seasonal_differences(400, 0.5, 0.6, 1)
    a, s, variance = forecast.fit_seasonal(w)

    def squares(a, s):
        e = w[13:] - a * w[12:-1] - s * w[1:-12] + a * s * w[:-13]
        return float(e @ e)

    axis = np.linspace(-1, 1, 81)
    _, a_grid, s_grid = min((squares(p, q), p, q) for p in axis for q in axis)
    assert abs(a - a_grid) < 0.026 and abs(s - s_grid) < 0.026
    best = squares(a, s)
    assert variance == pytest.approx(best / (len(w) - 13))
    for step in (1e-3, -1e-3):
        assert squares(a + step, s) > best and squares(a, s + step) > best


def test_seasonal_forecast_follows_the_recursion():
    w = seasonal_differences(120, -0.4, 0.5, 2)
    y = 50 + np.concatenate([[0], np.cumsum(w)])
    a, s, variance = forecast.fit_seasonal(w)
    mean, lo, hi, model = forecast.forecast_values(y, 14)
    assert model == "seasonal"
    # By hand: extend the levels, and let many noisy futures give the spread.
    path = list(y)
    for _ in range(14):
        d = np.diff(path)
        path.append(path[-1] + a * d[-1] + s * d[-12] - a * s * d[-13])
    np.testing.assert_allclose(mean, path[-14:])
    rng = np.random.default_rng(5)
    ends = []
    for _ in range(4000):
        d = list(w)
        for _ in range(14):
            d.append(a * d[-1] + s * d[-12] - a * s * d[-13] + rng.normal(0, math.sqrt(variance)))
        ends.append(y[-1] + sum(d[-14:]))
    assert np.std(ends) * 1.2816 == pytest.approx((hi - lo)[-1] / 2, rel=0.05)


def test_short_series_fall_back_and_tiny_ones_are_null(spark):
    rng = np.random.default_rng(0)
    a, b, _, _ = forecast.fit_plain(seasonal_differences(300, 0.6, 0.0, 4))
    assert abs(a - 0.6) < 0.2 and abs(b) < 0.25
    rows = [("short", m, float(v)) for m, v in zip(months(10), rng.normal(100, 5, 10))]
    rows += [("tiny", m, 1.0) for m in months(2)]
    df = spark.createDataFrame(rows, "k string, month date, value double")
    got = forecast.forecast(df, ["k"]).collect()
    assert all(r["hi"] > r["lo"] for r in got if r["k"] == "short")
    assert all(r["mean"] is None for r in got if r["k"] == "tiny")
    assert {(r["k"], r["model"]) for r in got} == {("short", "plain"), ("tiny", "none")}


def test_steep_series_keep_the_seasonal_model():
    w = seasonal_differences(60, 0.2, 1.7, 9)
    a, s, _ = forecast.fit_seasonal(w)
    assert s > 1.5 and (a, s) == (round(a, 6), round(s, 6))
    assert forecast.forecast_values(np.concatenate([[0], np.cumsum(w)]) + 50, 3)[3] == "seasonal"


def test_as_many_months_as_unknowns():
    w = seasonal_differences(16, 0.3, 0.4, 10)
    assert forecast.fit_seasonal(w[:-1]) is None and forecast.fit_seasonal(w) is not None


def test_first_of_equal_points_is_taken():
    # All shocks of a constant difference of 0 are 0, wherever the point lies.
    assert forecast.fit_plain(np.zeros(8)) == forecast.fit_plain(np.zeros(20))


def test_gaps_do_not_stop_a_fit():
    y = np.concatenate([[0], np.cumsum(seasonal_differences(80, 0.3, 0.4, 6))]) + 100
    y[20] = np.nan
    mean, lo, hi, model = forecast.forecast_values(y, 3)
    assert np.isfinite(mean).all() and (hi > lo).all()


def test_backtest_and_alert(spark):
    base = [100 + 10 * math.sin(2 * math.pi * i / 12) for i in range(60)]
    rng = np.random.default_rng(8)
    calm = [v + rng.normal(0, 0.1) for v in base]
    jump = calm[:-1] + [calm[-1] * 3]
    rows = [(k, m, v) for k, vs in (("calm", calm), ("jump", jump)) for m, v in zip(months(60), vs)]
    df = spark.createDataFrame(rows, "k string, month date, value double")
    errors = {r["k"]: r for r in forecast.backtest(df, ["k"]).collect()}
    assert errors["calm"]["mape_pct"] < 2 and errors["calm"]["points"] == 3
    alerts = {r["k"]: r for r in forecast.latest_alert(df, ["k"]).collect()}
    assert alerts["jump"]["alert"] and alerts["jump"]["deviation_pct"] > 100
    assert str(alerts["calm"]["month"]) == "2024-12-01"


# --- isolation forest ------------------------------------------------------

def test_expected_length():
    assert isolation.expected_length(1) == 0 and isolation.expected_length(2) == 1
    harmonic = sum(1 / i for i in range(1, 256))
    assert isolation.expected_length(256) == pytest.approx(2 * harmonic - 2 * 255 / 256, rel=1e-3)


def test_sample_is_exact_and_distinct(spark):
    df = spark.range(5000)
    got = random_rows(df, 64, 1).toPandas()
    assert sorted(got["_row"]) == list(range(64)) and got["id"].nunique() == 64
    assert random_rows(df.limit(10), 64, 1).count() == 10


@pytest.mark.parametrize("key", [(), ("k",)])
@pytest.mark.parametrize("equal", [10_000, 30_000])
def test_equal_rows_are_drawn_one_by_one(spark, key, equal):
    row = F.when(F.col("id") < equal, F.lit(-1)).otherwise(F.col("id"))
    df = spark.range(30_000).select(row.alias("k"), (row * 0.5).alias("x"))
    for seed in range(3):
        got = random_rows(df, 600, seed, key=key).toPandas()
        assert sorted(got["_row"]) == list(range(600))
        assert abs((got["k"] == -1).mean() - equal / 30_000) < 0.1
    same = random_rows(df.repartition(7), 600, 2, key=key).toPandas()
    assert (got.sort_values("_row").to_numpy() == same.sort_values("_row").to_numpy()).all()


def test_bags_hold_distinct_rows(spark):
    df = spark.range(300).withColumn("x", F.col("id").cast("double"))
    bags = isolation.draw_bags(df, trees=7, bag=64, seed=1).toPandas()
    sizes = bags.groupby("tree")["id"].agg(["count", "nunique"])
    assert list(sizes.index) == list(range(7)) and (sizes == 64).all().all()
    small = isolation.draw_bags(df.limit(20), trees=3, bag=64, seed=1).toPandas()
    assert (small.groupby("tree")["id"].nunique() == 20).all()


def test_scores_equal_a_walk_down_each_tree(spark):
    rng = np.random.default_rng(2)
    frame = pd.DataFrame({"a": rng.normal(0, 1, 500), "b": rng.normal(5, 2, 500)})
    df = spark.createDataFrame(frame)
    nodes = isolation.grow_forest(df, ["a", "b"], trees=12, bag=32, seed=3)
    got = df.withColumn("s", isolation.score_column(nodes, ["a", "b"], 32)).toPandas()
    trees = {}
    for r in nodes.collect():
        trees.setdefault(r["tree"], {})[r["node"]] = r

    def length(tree, row):
        at = 1
        while tree[at]["feature"] >= 0:
            at = 2 * at + (row[tree[at]["feature"]] > tree[at]["threshold"])
        return tree[at]["length"] / isolation.STEP

    want = [-(2 ** (-np.mean([length(t, row) for t in trees.values()]) / isolation.expected_length(32)))
            for row in got[["a", "b"]].to_numpy()]
    np.testing.assert_allclose(got["s"], want)


def test_full_trees_give_the_walk_of_each_row():
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(300, 3)), 1)
    nodes = [(t, *n) for t in range(7) for n in isolation.grow_tree(x[rng.integers(0, 300, 40 if t else 1)], 1, t)]
    table = pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "length"])
    by = {(r.tree, r.node): r for r in table.itertuples()}
    x[3, 1], x[4, 0], x[5] = np.nan, np.inf, -np.inf
    want = []
    for row in x:
        total = 0
        for t in range(7):
            n = 1
            while by[t, n].feature >= 0:
                n = 2 * n + bool(row[by[t, n].feature] > by[t, n].threshold)
            total += by[t, n].length
        want.append(total)
    depth = int(table["node"].max()).bit_length() - 1
    assert list(isolation.path_lengths(x, *isolation.full_trees(table, depth))) == want
    single = table[(table["tree"] == 0)]
    assert len(single) == 1 and set(isolation.path_lengths(x, *isolation.full_trees(single, 0))) == {0}


def test_a_threshold_leaves_rows_on_both_sides():
    close = np.array([[1.0], [np.nextafter(1.0, 2)]])
    for seed in range(20):
        nodes = {n: (f, cut) for n, f, cut, _ in isolation.grow_tree(close, seed, 0)}
        assert nodes[1] == (0, 1.0) and nodes[2][0] == nodes[3][0] == -1


def test_draws_depend_on_seed_tree_and_node_only():
    assert isolation.node_draw(42, 1, 1) == isolation.node_draw(42, 1, 1)
    draws = {isolation.node_draw(s, t, n)[1] for s in (1, 2) for t in range(50) for n in range(1, 50)}
    assert len(draws) == 2 * 50 * 49 and 0.45 < np.mean(list(draws)) < 0.55
    assert all(0 <= d < 1 for d in draws)


def test_far_row_is_the_anomaly(spark):
    rng = np.random.default_rng(4)
    frame = pd.DataFrame(rng.normal(100, 5, (400, len(FOREST_FEATURES))), columns=FOREST_FEATURES)
    frame.loc[7, :] = 900.0
    frame.loc[9, "LivingArea"] = None
    frame["ListingKey"] = frame.index.astype(str)
    frame["quality_issue_flag"] = 0
    scored = isolation.isolation_scores(spark.createDataFrame(frame), trees=50, bag=64)
    assert scored.columns[:-2] == list(frame.columns)
    assert [r["ListingKey"] for r in isolation.most_anomalous(scored, "ListingKey", 1).collect()] == ["7"]
    counts = isolation.anomaly_counts(scored).first()
    assert counts["rows"] == 400 and 1 <= counts["anomalies"] <= 4
    assert scored.filter("ListingKey = '9'").first()["LivingArea"] is None


# --- valuation -------------------------------------------------------------

def test_no_feature_leaks():
    names = [*VALUE_NUMERIC, *VALUE_BOOLEAN, *VALUE_CATEGORY]
    assert LEAKAGE.isdisjoint(names)
    with pytest.raises(ValueError, match="ListPrice"):
        valuation.check_leakage(["LivingArea", "ListPrice"])


@pytest.fixture(scope="module")
def homes(spark):
    rng = np.random.default_rng(9)
    n = 1200
    frame = pd.DataFrame({c: rng.normal(10, 2, n) for c in VALUE_NUMERIC})
    frame["close_year"] = 2024
    frame["close_month"] = rng.integers(1, 11, n)
    for c in VALUE_BOOLEAN:
        frame[c] = rng.random(n) < 0.5
    frame["PropertySubType"] = rng.choice(["house", "flat"], n)
    frame["CountyOrParish"] = rng.choice(["x", "y", "z"], n)
    frame["ClosePrice"] = np.exp(8 + 0.3 * frame["LivingArea"] + (frame["PropertySubType"] == "house"))
    frame.loc[5, "ClosePrice"] = 0.0
    frame.loc[6, ["LivingArea", "PropertySubType"]] = None
    frame["PropertySubType"] = frame["PropertySubType"].astype(object).where(frame["PropertySubType"].notna(), None)
    return valuation.staged_rows(spark.createDataFrame(frame))


def test_model_learns_and_ranks_its_drivers(spark, homes, tmp_path):
    from parcelmill.sources.sinks import write_model
    from pyspark.ml import PipelineModel

    assert homes.count() == 1199
    train, test = valuation.split_by_month(homes)
    assert train.agg(F.max("month_index")).first()[0] < test.agg(F.min("month_index")).first()[0]
    assert test.count() >= 0.2 * 1199
    model = valuation.fit_value_model(train, maxIter=6, maxDepth=4, stepSize=0.3)
    scored = valuation.score_values(model, test).select("actual", "predicted")
    metrics = valuation.regression_metrics(scored).first()
    pdf = scored.toPandas()
    err, ape = pdf.predicted - pdf.actual, (pdf.predicted - pdf.actual).abs() / pdf.actual
    assert metrics["mae"] == pytest.approx(err.abs().mean())
    assert metrics["rmse"] == pytest.approx(math.sqrt((err**2).mean()))
    assert metrics["r2"] == pytest.approx(1 - (err**2).sum() / ((pdf.actual - pdf.actual.mean()) ** 2).sum())
    assert metrics["mdape_pct"] == pytest.approx(ape.median() * 100)
    assert metrics["ppe10_pct"] == pytest.approx((ape <= 0.1).mean() * 100)
    assert metrics["r2"] > 0.6
    features = [*VALUE_NUMERIC, *VALUE_BOOLEAN, *VALUE_CATEGORY]
    drivers = valuation.sampled_shapley(model, test, features, sample=40, draws=4).collect()
    assert {d["feature"] for d in drivers[:2]} == {"LivingArea", "PropertySubType"}
    write_model(model, str(tmp_path / "model"))
    assert PipelineModel.load(str(tmp_path / "model")).transform(test.limit(1)).count() == 1


def test_trees_grow_from_staged_vectors_in_even_pieces(spark, homes, monkeypatch):
    seen = []

    class Watched(valuation.GBTRegressor):
        def fit(self, dataset, params=None):
            seen.append(dataset)
            return super().fit(dataset, params)

    monkeypatch.setattr(valuation, "GBTRegressor", Watched)
    train = valuation.split_by_month(homes)[0].coalesce(1)
    model = valuation.fit_value_model(train, maxIter=2, maxDepth=2)
    grown, = seen
    assert grown.columns == ["features", "label"]
    assert all("/value-vectors-" in path for path in grown.inputFiles())
    sizes = [r["count"] for r in grown.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= spark.sparkContext.defaultParallelism and max(sizes) - min(sizes) <= len(sizes)
    built = model.transform(train).select("features", "label")
    assert grown.exceptAll(built).isEmpty() and built.exceptAll(grown).isEmpty()
    assert grown.schema["features"].metadata == built.schema["features"].metadata != {}


class Formula:
    """Stands for a model: predicts 3 a + b * c and keeps what it is given."""

    def transform(self, df):
        self.seen = df
        return df.withColumn("prediction", 3 * F.col("a") + F.col("b") * F.col("c"))


def test_drivers_are_of_all_rows(spark, monkeypatch):
    from parcelmill.functions import sampling

    monkeypatch.setattr(sampling, "PIECE_ROWS", 500)
    rng = np.random.default_rng(3)
    frame = pd.DataFrame(rng.normal(0, 1, (3000, 3)), columns=["a", "b", "c"])
    frame.loc[:999] = 0.5  # a third of the rows is equal
    df, model = spark.createDataFrame(frame), Formula()
    got = {r["feature"]: r["mean_abs"] for r in valuation.sampled_shapley(model, df, ["a", "b", "c"], draws=4).collect()}
    seen = model.seen.toPandas()
    assert sorted(seen["_row"].unique()) == list(range(3000)) and len(seen) == 3000 * 4 * 4
    whole = seen[seen["_own"] == 3].groupby("_row")[["a", "b", "c"]].first()
    assert sorted(map(tuple, whole.to_numpy())) == sorted(map(tuple, frame.to_numpy()))
    # By hand: each step of each walk.
    effect = {}
    value = 3 * seen["a"] + seen["b"] * seen["c"]
    walks = {}
    for row, order, own, v in zip(seen["_row"], seen["order"], seen["_own"], value):
        walks.setdefault((row, tuple(order)), {}).setdefault(own, []).append(v)
    for (row, order), points in walks.items():
        for k, f in enumerate(order):
            effect[row, f] = effect.get((row, f), 0.0) + (sum(points[k + 1]) - sum(points[k])) / 4
    for f in "abc":
        assert got[f] == pytest.approx(np.mean([abs(v) for (_, g), v in effect.items() if g == f]))
    again = valuation.sampled_shapley(Formula(), df.repartition(5), ["a", "b", "c"], draws=4).collect()
    assert {r["feature"]: r["mean_abs"] for r in again} == pytest.approx(got)


def _shapley_by_subsets(rows, x):
    """Shapley values of one tree by all subsets; ``rows`` by node number."""
    def value(known, number=0):
        r = rows[number]
        if r.left < 0:
            return r.value * r.weight
        if r.feature in known:
            left = x[r.feature] <= r.threshold if r.categories is None else x[r.feature] in r.categories
            return value(known, r.left if left else r.right)
        a, b = rows[r.left], rows[r.right]
        return (a.cover * value(known, r.left) + b.cover * value(known, r.right)) / r.cover

    used = sorted({r.feature for r in rows.values() if r.left >= 0})
    found, m = {}, len(used)
    for j in used:
        rest = [f for f in used if f != j]
        found[j] = sum(
            math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) * (value({*s, j}) - value(set(s)))
            for k in range(m) for s in itertools.combinations(rest, k))
    return found, value(set())


@pytest.mark.parametrize("bits", [attribution.TABLE_BITS, 2])
def test_attributions_equal_all_subsets(spark, homes, bits, monkeypatch):
    monkeypatch.setattr(attribution, "TABLE_BITS", bits)
    train, test = valuation.split_by_month(homes)
    model = valuation.fit_value_model(train, maxIter=4, maxDepth=5, stepSize=0.3)
    nodes = attribution.node_table(model, spark)
    trees = attribution.trees_of(nodes)
    vectors = [r.features.toArray() for r in model.transform(test.limit(6)).select("features").collect()]
    got = attribution.explain(trees, np.array(vectors))
    by_tree = {}
    for r in nodes.collect():
        by_tree.setdefault(r.tree, {})[r.node] = r
    assert len(by_tree) == 4 and any(r.categories for rows in by_tree.values() for r in rows.values())
    for x, row in zip(vectors, got):
        want = np.zeros(len(x))
        for rows in by_tree.values():
            for j, v in _shapley_by_subsets(rows, x)[0].items():
                want[j] += v
        assert row == pytest.approx(want, abs=1e-9)
    assert sum(t.mean() for t in trees) == pytest.approx(sum(_shapley_by_subsets(rows, vectors[0])[1] for rows in by_tree.values()))


def test_paths_of_one_length_share_their_points(monkeypatch):
    rng = np.random.default_rng(5)
    splits = tuple((k, k % 3, float(rng.normal()), None) for k in range(7))
    leaves = tuple(
        attribution.Leaf(float(rng.normal()), (0, 1, 2), tuple(rng.random(3)),
                         tuple(tuple((k, bool(leaf >> k & 1)) for k in range(f, 7, 3)) for f in range(3)))
        for leaf in range(40))
    x = rng.normal(size=(50, 4))
    asked, points = [], np.polynomial.legendre.leggauss
    monkeypatch.setattr(np.polynomial.legendre, "leggauss", lambda n: asked.append(n) or points(n))
    if hasattr(attribution, "_points"):
        attribution._points.cache_clear()
    got = attribution.explain([attribution.Tree(splits, leaves)], x)
    assert len(asked) <= 1
    want = np.zeros(x.shape)
    for leaf in leaves:
        for row, values in zip(want, x):
            bits = [[float(all((values[splits[k][1]] <= splits[k][2]) == left for k, left in tests)) for tests in leaf.tests]]
            row[:3] += attribution.leaf_table(leaf, np.array(bits))[0]
    assert got == pytest.approx(want, abs=1e-12)


def _random_tree(rng, depth, features):
    splits, leaves = [], []

    def grow(path, node, level):
        if level == depth or level > 3 and rng.random() < 0.2:
            parts = sorted(path.items())
            leaves.append(attribution.Leaf(float(rng.normal()), tuple(f for f, _ in parts),
                                           tuple(p[0] for _, p in parts), tuple(p[1] for _, p in parts)))
            return
        f = int(rng.integers(features))
        kinds = (0.0,) if f % 3 == 0 else (0.0, 2.0) if f % 3 == 1 else None
        splits.append((node, f, float(rng.normal()), kinds))
        share, tests = path.get(f, (1.0, ()))
        left = float(rng.choice([0.0, 0.3, 0.8, 1.0]))
        grow({**path, f: (share * left, (*tests, (node, True)))}, 2 * node + 1, level + 1)
        grow({**path, f: (share * (1 - left), (*tests, (node, False)))}, 2 * node + 2, level + 1)

    grow({}, 0, 0)
    return attribution.Tree(tuple(splits), tuple(leaves))


@pytest.mark.parametrize("depth,features", [(8, 6), (8, 40), (0, 3), (13, 40)])
def test_leaves_beside_each_other_share_a_code(depth, features):
    rng = np.random.default_rng(depth + features)
    tree = _random_tree(rng, depth, features)
    kinds = np.arange(features) % 3 < 2
    x = np.where(kinds, rng.integers(0, 3, (60, features)), rng.normal(size=(60, features)))
    goes = {k: x[:, f] <= cut if kind is None else np.isin(x[:, f], kind) for k, f, cut, kind in tree.splits}
    want = np.zeros(x.shape)
    for leaf in tree.leaves:
        if leaf.features:
            bits = np.stack([np.all([goes[k] == left for k, left in tests], axis=0) for tests in leaf.tests], axis=1)
            want[:, leaf.features] += attribution.leaf_table(leaf, bits.astype(float))
    assert attribution.explain([tree], x) == pytest.approx(want, abs=1e-9)
    grouped = [leaf for g in tree.groups for leaf in g.leaves]
    assert grouped == [leaf for leaf in tree.leaves if leaf.features]
    assert all(len(g.bits) <= attribution.GROUP_BITS or len(g.leaves) == 1 for g in tree.groups)
    assert depth != 8 or 2 * len(tree.groups) < len(tree.leaves)


def test_trees_are_made_one_at_a_time(spark, homes, monkeypatch):
    """500 trees as Python objects are more than a small driver holds."""
    train, test = valuation.split_by_month(homes)
    model = valuation.fit_value_model(train, maxIter=5, maxDepth=4)
    monkeypatch.setattr(attribution, "trees_of", lambda nodes: pytest.fail("all trees at once on the driver"))
    explained, mean = attribution.attributions(model, test, [*VALUE_NUMERIC, *VALUE_BOOLEAN, *VALUE_CATEGORY])
    assert explained.count() == test.count()
    monkeypatch.undo()
    nodes = attribution.node_table(model, spark)
    made = attribution.each_tree(nodes.orderBy(F.rand(3)).toArrow())
    assert iter(made) is made and list(made) == attribution.trees_of(nodes)
    assert mean == pytest.approx(sum(t.mean() for t in attribution.trees_of(nodes)))


def test_effects_add_up_and_rank(spark, homes):
    train, test = valuation.split_by_month(homes)
    model = valuation.fit_value_model(train, maxIter=5, maxDepth=4, stepSize=0.3)
    features = [*VALUE_NUMERIC, *VALUE_BOOLEAN, *VALUE_CATEGORY]
    explained, mean = attribution.attributions(model, test, features)
    rows = explained.toPandas()
    effects = rows[[f"effect_{c}" for c in features]]
    assert len(rows) == test.count()
    assert (effects.sum(axis=1) + mean).to_numpy() == pytest.approx(rows["prediction"].to_numpy())
    ranked = attribution.drivers(explained, features, 5).collect()
    assert {r["feature"] for r in ranked[:2]} == {"LivingArea", "PropertySubType"}
    want = effects.abs().mean().sort_values(ascending=False)
    assert [r["mean_abs"] for r in ranked] == pytest.approx(list(want[:5]))
    assert attribution.drivers(explained.where("false"), features, 5).collect() == []


def test_value_queries_use_the_defaults_and_share_a_fit(spark, homes, monkeypatch):
    from parcelmill.plans import model_queries

    told, fit = [], valuation.fit_value_model

    def small(train, **trees):
        told.append(trees)
        return fit(train, maxIter=2, maxDepth=3)

    monkeypatch.setattr(model_queries, "value_rows", lambda spark, folder: homes)
    monkeypatch.setattr(valuation, "fit_value_model", small)
    assert model_queries.avm_score(spark, "somewhere").count() == 1
    assert model_queries.avm_drivers(spark, "somewhere").count() == 15
    sums = model_queries.avm_effects_add_up(spark, "somewhere").collect()
    assert sums and all(r["rows"] == r["explained"] for r in sums)
    assert told == [{}]


def test_missing_category_has_no_column(spark, homes):
    from pyspark.ml import Pipeline

    built = Pipeline(stages=valuation.feature_stages(valuation.feature_medians(homes))).fit(homes).transform(homes)
    row = built.filter(F.col("PropertySubType").isNull()).first()
    assert row["PropertySubType_hot"].numNonzeros() == 0 and row["LivingArea_missing"] == 1.0
