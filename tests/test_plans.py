"""The physical plans keep the properties that matter on large tables."""

import os
import re

import pytest

from __spark_entry__ import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan(df, capsys):
    capsys.readouterr()
    df.explain("simple")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", [
    "iqr_flags", "median_impute", "price_histogram", "rate_enrich", "month_parity", "filtered_trends",
    "cleaning_summary", "anomaly_label", "month_boundary_split", "market_metrics",
])
def test_no_cross_join(spark, capsys, name):
    text = plan(queries()[name](spark, FOLDER), capsys)
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text)


def test_rank_limit_runs_before_the_shuffle(spark, capsys):
    text = plan(queries()["top_agents_per_county"](spark, FOLDER), capsys)
    assert re.search(r"WindowGroupLimit.*Partial", text)


def test_top_list_does_not_sort_everything(spark, capsys):
    assert "TakeOrderedAndProject" in plan(queries()["top_offices"](spark, FOLDER), capsys)


def test_scan_reads_only_what_is_asked(spark, capsys):
    text = plan(queries()["dom_by_city"](spark, FOLDER), capsys)
    assert set(re.findall(r"[A-Za-z]+(?=#)", re.search(r"FileScan parquet \[(.*?)\]", text).group(1))) == {
        "City", "DaysOnMarket", "ClosePrice", "LivingArea"}


def test_market_changes_and_records_share_one_shuffle(spark, capsys):
    from parcelmill.operators.calendar import mom_yoy, with_changes, _summary

    kpi = queries()["market_month_kpi"](spark, FOLDER)
    base = plan(kpi, capsys).count("Exchange hashpartitioning")
    both = plan(_summary(with_changes(kpi), "market"), capsys).count("Exchange hashpartitioning")
    assert both <= base + 1
    assert plan(mom_yoy(kpi), capsys).count("Exchange hashpartitioning") <= base + 1


def test_narrowing_joins_by_broadcast_only_while_bins_are_few(spark, capsys):
    from pyspark.sql import functions as F

    from parcelmill.functions.quantiles import median, narrowed_quantiles

    df = spark.range(2000).select((F.col("id") % 5).cast("string").alias("k"), F.sqrt("id").alias("v"))
    few = plan(narrowed_quantiles(df, ["k"], [median("v", "m")]), capsys)
    assert "BroadcastHashJoin" in few
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = plan(narrowed_quantiles(df, ["k"], [median("v", "m")], broadcast_rows=0), capsys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in many and "BroadcastHashJoin" not in many
