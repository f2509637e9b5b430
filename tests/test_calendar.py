import pytest

from parcelmill.operators import calendar, facts, marts, ranking

SCHEMA = ("market string, yr_mo string, closed_sales long, median_close_price double, median_dom double, "
          "median_price_per_sqft double, avg_close_to_orig_ratio double")


def frames(spark, months, prices, sales, market="all"):
    kpi = spark.createDataFrame(
        [(market, m, s, p, 20.0, 500.0, 1.0) for m, p, s in zip(months, prices, sales)], SCHEMA)
    new = spark.createDataFrame(
        [(market, m, 2 * s) for m, s in zip(months, sales)], "market string, yr_mo string, new_listings long")
    return kpi, new


def months_of(year, first, last):
    return [f"{year}-{m:02d}" for m in range(first, last + 1)]


def test_fourteen_months(spark):
    months = months_of(2024, 1, 12) + ["2025-01", "2025-02"]
    prices = [100000.0] * 12 + [200000.0, 220000.0]
    sales = [500] * 13 + [1100]
    record = calendar.market_metrics(*frames(spark, months, prices, sales)).first()
    assert record["latest"]["month"] == "2025-02"
    assert record["mom_change_pct"]["median_close_price"] == 10.0
    assert record["yoy_change_pct"]["median_close_price"] == 120.0
    assert record["yoy_change_pct"]["closed_sales"] == 120.0
    assert record["supply_demand"]["new_listings_to_sales_ratio"] == 2.0
    assert record["coverage"].asDict() == {"first_month": "2024-01", "last_month": "2025-02", "n_months": 14}
    assert record["series"]["peak_median_price"]["month"] == "2025-02"
    # All earlier months tie: the first one is the trough.
    assert record["series"]["trough_median_price"]["month"] == "2024-01"
    assert record["series"]["latest_vs_peak_pct"] == 0.0


def test_six_months_have_no_prior_year(spark):
    kpi, new = frames(spark, months_of(2025, 1, 6), [1.0] * 6, [5] * 6)
    record = calendar.market_metrics(kpi, new.limit(0)).first()
    assert record["yoy_change_pct"] is None
    assert record["mom_change_pct"]["median_close_price"] == 0.0
    assert record["latest"]["new_listings"] is None
    assert record["supply_demand"]["new_listings_to_sales_ratio"] is None


def test_gap_breaks_the_month_but_not_the_year(spark):
    months = months_of(2024, 1, 11) + ["2025-01"]
    kpi, _ = frames(spark, months, [100.0] * 11 + [150.0], [1] * 12)
    row = calendar.mom_yoy(kpi).filter("yr_mo = '2025-01'").first()
    assert row["mom_price"] is None and row["yoy_price"] == 50.0 and row["has_prior_year"]


def test_change_from_zero_or_null_is_null_but_the_year_counts(spark):
    months = months_of(2024, 1, 12) + ["2025-01"]
    prices = [None] + [0.0] * 11 + [10.0]
    kpi, new = frames(spark, months, prices, [1] * 13)
    record = calendar.market_metrics(kpi, new).first()
    assert record["mom_change_pct"]["median_close_price"] is None
    assert record["yoy_change_pct"]["median_close_price"] is None
    assert record["yoy_change_pct"]["closed_sales"] == 0.0
    assert record["series"]["trough_median_price"]["month"] == "2024-02"


def test_markets_do_not_mix(spark):
    a, new_a = frames(spark, ["2024-01", "2024-02"], [1.0, 2.0], [1, 2], "a")
    b, new_b = frames(spark, ["2024-01"], [5.0], [9], "b")
    records = calendar.market_metrics(a.union(b), new_a.union(new_b)).collect()
    got = {r["market"]: r["latest"]["closed_sales"] for r in records}
    assert got == {"a": 2, "b": 9}
    assert [r["market"] for r in ranking.top_markets(a.union(b), 1).collect()] == ["b"]


def test_densify_and_holdout(spark):
    kpi, _ = frames(spark, ["2023-11", "2024-02"], [1.0, 4.0], [1, 4])
    dense = calendar.as_series(kpi, ["closed_sales"]).orderBy("month").collect()
    assert [r["value"] for r in dense] == [1.0, None, None, 4.0]
    split = calendar.holdout_split(calendar.as_series(kpi, ["closed_sales"]), ["market", "metric"], 3)
    assert [r["held_out"] for r in split.orderBy("month").collect()] == [False, True, True, True]


def test_recent_months_takes_whole_months(spark):
    rows = [(2024, m) for m, n in ((1, 70), (2, 15), (3, 10), (4, 5)) for _ in range(n)]
    df = spark.createDataFrame(rows, "y int, m int")
    got = {r["month_index"] - 2024 * 12: r["is_test"] for r in calendar.recent_months(df, "y", "m", 0.2).collect()}
    assert got == {1: False, 2: True, 3: True, 4: True}
    # 15 rows are exactly the share: the walk stops there.
    exact = {r["month_index"] - 2024 * 12: r["is_test"] for r in calendar.recent_months(df, "y", "m", 0.15).collect()}
    assert exact == {1: False, 2: False, 3: True, 4: True}


def test_parity_and_filters(spark):
    one = spark.createDataFrame([("2024-01",), ("2024-03",)], "yr_mo string")
    two = spark.createDataFrame([("2024-01",), ("2024-02",)], "yr_mo string")
    assert marts.month_parity(one, one).first()["same"] is True
    assert marts.month_parity(one, two).first()["same"] is False
    df = spark.createDataFrame([("a", "2024-01"), ("b", "2024-01")], "City string, yr_mo string")
    assert marts.filter_market(df, months=["2024-01"], City="a").count() == 1
    with pytest.raises(ValueError):
        marts.filter_market(df, Street="x")
    with pytest.raises(ValueError, match="known are: a, b"):
        ranking.select_market(df, "City", "zzz")


def test_fact_sheet_text(spark):
    kpi, new = frames(spark, ["2025-01", "2025-02"], [1000000.0, 1100000.0], [10, 5])
    flat = calendar.flat_metrics(calendar.market_metrics(kpi, new))
    text = facts.fact_sheet(flat).first()["facts"]
    assert text.splitlines()[0].startswith("PRICE | median 1,100,000, 1m +10%, 12m n/a, per sqft ")
    assert "VOLUME | closed 5, 1m -50%, 12m n/a" in text and "DATA | from 2025-01, to 2025-02, months 2" in text
    summary = facts.template_summary(flat).first()
    assert summary["headline"].endswith(" in 2025-02: price up, sales down")
    assert "price unknown (n/a)" in summary["summary"] and "short history" in summary["watch"]
