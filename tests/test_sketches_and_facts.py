import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from parcelmill.operators import matching, profile, sketches
from parcelmill.sources.sinks import write_facts


# --- sketches ----------------------------------------------------------------

@pytest.fixture(scope="module")
def sales(spark):
    # Group "hot" holds a third of the rows.
    return spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), F.col("id") % 7)).alias("market"),
        F.concat(F.lit("2024-"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0")).alias("yr_mo"),
        F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double").alias("price"))


def test_spans_are_within_the_stated_rank_error(spark, sales):
    k = 400
    stored = sketches.month_sketches(sales, ["market"], ["price"], k=k)
    for first, last in ((None, None), ("2024-03", "2024-05"), ("2024-12", None)):
        found = sketches.span_quantiles(
            stored, ["market"], {"q1": ("price", 0.25), "mid": ("price", 0.5), "top": ("price", 0.99)}, first, last)
        rows = sales.filter(F.col("yr_mo").between(first or "0", last or "9"))
        for r in found.collect():
            prices = sorted(x["price"] for x in rows.filter(F.col("market") == r["market"]).select("price").collect())
            assert r["rows"] == len(prices)
            for name, share in (("q1", 0.25), ("mid", 0.5), ("top", 0.99)):
                below = sum(p < r[name] for p in prices) / len(prices)
                up_to = sum(p <= r[name] for p in prices) / len(prices)
                assert below - 2 * sketches.rank_error(k) <= share <= up_to + 2 * sketches.rank_error(k)


def test_sketch_size_depends_on_k_not_on_rows(sales):
    sizes = sketches.month_sketches(sales, ["market"], ["price"], k=200).select(
        "market", "rows", F.length("price").alias("bytes")).collect()
    assert max(r["bytes"] for r in sizes) < 8 * 3.5 * 200 < 8 * max(r["rows"] for r in sizes)


def test_small_spans_are_exact_and_unknown_values_are_left_out(spark):
    rows = [("a", "2024-01", 1.0), ("a", "2024-02", 3.0), ("a", "2024-02", 2.0), ("a", "2024-02", float("nan")),
            ("a", "2024-03", None), ("b", "2024-01", None), ("a", None, 9.0), (None, "2024-01", 4.0)]
    df = spark.createDataFrame(rows, "market string, yr_mo string, price double")
    stored = sketches.month_sketches(df, ["market"], ["price"])
    got = {r["market"]: (r["rows"], r["mid"]) for r in
           sketches.span_quantiles(stored, ["market"], {"mid": ("price", 0.5)}).collect()}
    assert got == {"a": (5, 2.0), "b": (1, None), None: (1, 4.0)}
    assert sketches.span_quantiles(stored, ["market"], {"mid": ("price", 0.5)}, first="2025-01").count() == 0
    empty = sketches.month_sketches(df.limit(0), ["market"], ["price"])
    assert sketches.span_quantiles(empty, ["market"], {"mid": ("price", 0.5)}).count() == 0


def test_a_new_month_only_adds_its_sketches(spark, sales):
    months = ["market"], ["price"]
    before = sketches.month_sketches(sales.filter("yr_mo < '2024-12'"), *months)
    added = before.unionByName(sketches.month_sketches(sales.filter("yr_mo = '2024-12'"), *months))
    assert added.count() == sketches.month_sketches(sales, *months).count()
    got = sketches.span_quantiles(added, ["market"], {"mid": ("price", 0.5)})
    assert got.agg(F.sum("rows")).first()[0] == 60_000


# --- fingerprints ------------------------------------------------------------

def both(spark, left, right, buckets=matching.BUCKETS):
    a, b = (spark.createDataFrame(rows, "x string, y double") for rows in (left, right))
    whole = matching.compare_results(a, b).select("left_only", "right_only", "same").first()
    assert matching.differences(a, b, buckets).first() == whole
    return tuple(whole)


@pytest.mark.parametrize("buckets", [1, 3, 4096])
def test_differences_equal_the_whole_comparison(spark, buckets):
    rows = [(f"n{i % 40}", i / 4) for i in range(300)]
    assert both(spark, rows, rows[::-1], buckets) == (0, 0, True)
    assert both(spark, rows, rows + rows[:9], buckets) == (0, 0, True)  # repeats alone
    assert both(spark, rows, rows[:-1] + [("n1", 4000.0)], buckets) == (1, 1, False)
    assert both(spark, rows, [], buckets)[1:] == (0, False)
    assert both(spark, [], [], buckets) == (0, 0, True)
    assert both(spark, [(None, None), ("a", 1.0)], [("a", 1.0)], buckets) == (1, 0, False)
    assert both(spark, [(None, None)] * 3, [(None, None)], buckets) == (0, 0, True)


def test_names_and_order_of_columns_do_not_matter(spark):
    a = spark.createDataFrame([("p", 1.0), ("q", 2.0)], "x string, y double")
    b = a.select(F.col("y").alias("other"), F.concat(F.lit(" "), "x").alias("z"))
    assert matching.differing_buckets(a, b) == []


def test_few_changed_rows_leave_most_buckets_alone(spark):
    a = spark.range(20_000).select(F.col("id").cast("string").alias("x"), (F.col("id") * 1.0).alias("y"))
    b = a.withColumn("y", F.when(F.col("x").isin("7", "8"), -1.0).otherwise(F.col("y")))
    assert 1 <= len(matching.differing_buckets(a, b)) <= 4
    assert tuple(matching.differences(a, b).first()) == (2, 2, False)


def test_compared_rows_are_dealt_by_their_number(spark, monkeypatch):
    told, compare = [], matching.compare_results

    def noted(left, right, tasks=None):
        told.append(tasks)
        return compare(left, right, tasks)

    monkeypatch.setattr(matching, "compare_results", noted)
    one = spark.range(400).selectExpr("concat('k', id) AS k", "id AS v")
    two = one.selectExpr("CASE WHEN v % 2 = 0 THEN v + 1000 ELSE v END AS v", "k").unionByName(one.filter("v = 1"))
    got = matching.differences(one, two, task_rows=100).first()
    assert (got["left_only"], got["right_only"], got["same"]) == (200, 200, False)
    wide = matching.differences(one, two, 1, task_rows=100).first()
    assert wide == got and told[1] == 9
    assert matching.differences(one, one, task_rows=100).first()["same"] and told[2] == 1


def test_only_sums_of_buckets_are_shuffled(spark):
    df = spark.range(100).select(F.col("id").alias("x"))
    plan = matching.fingerprints(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("partial_sum") > plan.index("Exchange")


# --- bucketed facts ------------------------------------------------------------

def facts_of(spark, df, folder, buckets=8):
    name = "facts_" + uuid.uuid4().hex
    return name, write_facts(df, name, str(folder / name), "k", buckets)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keys_of_bucketed_facts_are_grouped_without_a_shuffle(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") % 1200).alias("k"), F.col("id").alias("day"), F.lit("x").alias("v"))
    name, facts = facts_of(spark, df, tmp_path)
    kept = profile.keep_last(facts, ["k"], ["day"])
    assert "Exchange" not in plan_of(kept)
    assert "hashpartitioning" not in plan_of(profile.duplicate_keys(facts, "k"))
    assert "hashpartitioning" in plan_of(profile.duplicate_keys(df, "k"))
    assert sorted(kept.collect()) == sorted(profile.keep_last(df, ["k"], ["day"]).collect())
    assert profile.duplicate_keys(facts, "k").first() == profile.duplicate_keys(df, "k").first()
    spark.sql(f"DROP TABLE {name}")


def test_bucketed_facts_join_without_a_shuffle(spark, tmp_path):
    df = spark.range(3000).select((F.col("id") % 700).alias("k"), F.col("id").alias("v"))
    one, a = facts_of(spark, df, tmp_path)
    two, b = facts_of(spark, df.withColumnRenamed("v", "w").filter("k < 50"), tmp_path)
    joined = a.join(b.hint("merge"), "k")
    assert "Exchange" not in plan_of(joined)
    assert joined.count() == df.join(df.filter("k < 50").withColumnRenamed("v", "w"), "k").count()
    for name in (one, two):
        spark.sql(f"DROP TABLE {name}")


def test_rows_without_a_key_are_refused(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    with pytest.raises(PySparkException, match="has no k"):
        facts_of(spark, df, tmp_path)
