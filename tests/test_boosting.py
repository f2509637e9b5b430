import os
import threading

import numpy as np
import pytest
from pyspark.ml import regression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from parcelmill.operators import boosting


@pytest.fixture(scope="module")
def rows(spark):
    """600 rows: two numbers of few values, one of many, and two categories."""
    rng = np.random.default_rng(4)
    n = 600
    table = [(float(a), float(b), float(c), float(d), float(e), float(a * d + 3 * (b > 4) + e + z)) for a, b, c, d, e, z in zip(
        rng.integers(0, 12, n), rng.integers(0, 30, n), rng.normal(size=n), rng.integers(0, 2, n), rng.integers(0, 2, n), rng.normal(size=n))]
    flat = spark.createDataFrame(table, "a double, b double, c double, d double, e double, label double")
    for name in "de":
        flat = flat.withColumn(name, F.col(name).alias(name, metadata={"ml_attr": {"type": "nominal", "num_vals": 2, "name": name}}))
    built = VectorAssembler(inputCols=list("abcde"), outputCol="features").transform(flat)
    path = f"{spark.conf.get('spark.checkpoint.dir')}/boosting-rows"
    built.repartition(4, "c").write.mode("overwrite").parquet(path)
    return spark.read.schema(built.schema).parquet(path)


def _predicted(model, rows):
    return [r[0] for r in model.transform(rows).orderBy(vector_to_array("features"), "label").select("prediction").collect()]


def test_trees_equal_sparks_own(rows):
    """Where nothing is drawn and every value has a bin, both are the same model."""
    few = rows.select(rows["features"], "label")
    settings = {"maxIter": 6, "maxDepth": 5, "stepSize": 0.3, "minInstancesPerNode": 5, "seed": 3, "maxBins": 700}
    mine = boosting.GBTRegressor(**settings).fit(few)
    want = regression.GBTRegressor(**settings).fit(few)
    assert type(mine) is type(want)
    assert _predicted(mine, few) == pytest.approx(_predicted(want, few), abs=1e-9)
    assert mine.totalNumNodes == want.totalNumNodes and mine.treeWeights == want.treeWeights
    assert mine.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray(), abs=1e-9)
    assert mine.getMaxDepth() == 5 and mine.getStepSize() == 0.3 and mine.numFeatures == 5


def test_jobs_do_not_grow_with_trees(spark, rows):
    def jobs(trees, depth):
        group = f"grow-{trees}-{depth}"
        spark.sparkContext.setJobGroup(group, group)
        model = boosting.GBTRegressor(maxIter=trees, maxDepth=depth, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=1).fit(rows)
        assert len(model.trees) == trees
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(3, 2) == jobs(30, 6) < 20
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_some_tasks_have_no_rows(spark, rows):
    few = rows.orderBy("label").limit(25).coalesce(1)
    settings = {"maxIter": 3, "maxDepth": 3, "minInstancesPerNode": 2, "maxBins": 700}
    mine = boosting.GBTRegressor(**settings).fit(few.repartition(4, F.lit(1)))
    assert _predicted(mine, few) == pytest.approx(_predicted(regression.GBTRegressor(**settings).fit(few), few), abs=1e-9)


def test_other_settings_grow_in_sparks_way(spark, rows, monkeypatch):
    monkeypatch.setattr(boosting, "grown_nodes", lambda *a: pytest.fail("not covered"))
    assert boosting.GBTRegressor(maxIter=1, maxDepth=2, lossType="absolute").fit(rows).transform(rows).count() == 600
    monkeypatch.setattr(boosting, "_plain_folder", lambda spark: False)
    assert boosting.GBTRegressor(maxIter=1, maxDepth=2).fit(rows).transform(rows).count() == 600


def test_limits_of_many_values_hold_even_shares():
    rng = np.random.default_rng(1)
    x = rng.lognormal(size=300_000)
    values, weights = np.empty(0), np.empty(0)
    for part in np.array_split(x, 3):
        values, weights = boosting.merged(np.concatenate([values, part]), np.concatenate([weights, np.ones(len(part))]), 4096)
    assert len(values) <= 4096 and weights.sum() == len(x)
    cuts = boosting.limits(values, weights, 32)
    shares = np.bincount(np.searchsorted(cuts, x)) / len(x)
    assert len(cuts) == 31 and abs(shares - 1 / 32).max() < 0.002
    assert list(boosting.limits(np.array([1.0, 2.0, 4.0]), np.ones(3), 32)) == [1.5, 3.0]


def test_messages_wait_for_all_tasks_and_keep_their_order(tmp_path):
    told = {}

    def task(me):
        messages = boosting.Messages(str(tmp_path / "run"), me, 3)
        for turn in range(20):
            messages.turn()
            messages.put(np.array([me + 0.1, turn, 7.0]))
            told[me, turn] = messages.sums(0, 2).tolist(), messages.get(me - 1 if me else 2, 16, 1).tolist()
            messages.put(np.ones(1))
            messages.sums(24, 1)
            messages.tidy()
        messages.close()

    threads = [threading.Thread(target=task, args=(k,)) for k in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(60)
    assert all(told[me, turn] == ([0.1 + 1.1 + 2.1, 3.0 * turn], [7.0]) for me in range(3) for turn in range(20))
    assert sorted(os.listdir(tmp_path / "run")) == [f"19-{k}" for k in range(3)]


def test_a_silent_task_is_told(tmp_path, monkeypatch):
    monkeypatch.setattr(boosting, "PATIENCE", 0.05)
    messages = boosting.Messages(str(tmp_path / "run"), 0, 2)
    messages.turn()
    with pytest.raises(RuntimeError, match="task 1"):
        messages.get(1, 0, 1)
