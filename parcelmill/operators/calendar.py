"""Calendar comparisons of monthly figures, for all markets at once.

A table here has one row per (market, month), so a market holds as many rows
as the calendar has months; the windows below are bounded by that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmill.functions.scalar import month_index, month_start, percent_change


_CHANGES = {
    "mom_price": ("median_close_price", 1), "mom_sales": ("closed_sales", 1), "mom_dom": ("median_dom", 1),
    "yoy_price": ("median_close_price", 12), "yoy_sales": ("closed_sales", 12),
}


def with_changes(kpi: DataFrame, market: str = "market") -> DataFrame:
    """``kpi`` with month-over-month changes of price, sales and days,
    year-over-year changes of price and sales (percent, one decimal), and
    ``has_prior_year``. The earlier month is found by calendar distance, so a
    gap in the months gives null and never the row before."""
    def months_ago(n: int):
        return Window.partitionBy(market).orderBy("_month").rangeBetween(-n, -n)

    past = {f"_{c}_{n}": F.first(c).over(months_ago(n)) for c, n in _CHANGES.values()}
    past["has_prior_year"] = F.count(F.lit(1)).over(months_ago(12)) > 0
    rows = kpi.withColumn("_month", month_index("yr_mo")).withColumns(past)
    changes = {
        name: percent_change(F.col(c), F.col(f"_{c}_{n}")) for name, (c, n) in _CHANGES.items()
    }
    return rows.withColumns(changes).drop("_month", *[f"_{c}_{n}" for c, n in _CHANGES.values()])


def mom_yoy(kpi: DataFrame, market: str = "market") -> DataFrame:
    """The changes of every market and month."""
    return with_changes(kpi, market).select(market, "yr_mo", *_CHANGES, "has_prior_year")


def _best(function, sign: int) -> Column:
    """Month and value of the highest or lowest price; the earliest of equals."""
    price = F.col("median_close_price")
    order = F.when(
        price.isNotNull(), F.struct(price.alias("v"), (month_index("yr_mo") * sign).alias("m"))
    )
    return function(F.struct(F.col("yr_mo").alias("month"), price.alias("value")), order)


def _summary(rows: DataFrame, market: str) -> DataFrame:
    """One row per market: coverage, the row of the latest month as ``last``,
    peak and trough of the median price."""
    rest = [c for c in rows.columns if c != market]
    return rows.groupBy(market).agg(
        F.min("yr_mo").alias("first_month"), F.max("yr_mo").alias("last_month"),
        F.count(F.lit(1)).alias("n_months"),
        F.max_by(F.struct(*rest), month_index("yr_mo")).alias("last"),
        _best(F.max_by, -1).alias("peak"), _best(F.min_by, 1).alias("trough"),
    )


def peak_trough(kpi: DataFrame, market: str = "market") -> DataFrame:
    """Peak and trough month of the median price per market, and how far the
    latest month is from the peak."""
    return _summary(kpi, market).select(
        market,
        F.col("peak.month").alias("peak_month"), F.col("peak.value").alias("peak_price"),
        F.col("trough.month").alias("trough_month"), F.col("trough.value").alias("trough_price"),
        percent_change(F.col("last.median_close_price"), F.col("peak.value")).alias("latest_vs_peak_pct"),
    )


def latest_month(kpi: DataFrame, market: str = "market") -> DataFrame:
    """The row of the latest month of each market."""
    return _summary(kpi, market).select(market, "last.*")


def market_metrics(kpi: DataFrame, new_listings: DataFrame, market: str = "market") -> DataFrame:
    """One nested record per market: coverage, latest month, changes, series
    peaks and supply against demand.

    The window and the grouping share one shuffle by market; the listings of
    the latest month come by a left join."""
    found = _summary(with_changes(kpi, market), market)
    fresh = new_listings.select(
        F.col(market), F.col("yr_mo").alias("last_month"),
        F.col("new_listings").cast("long").alias("new_listings"),
    )
    whole = found.join(fresh, [market, "last_month"], "left")
    last = F.col("last")
    supply = F.try_divide(F.col("new_listings").cast("double"), last["closed_sales"].cast("double"))

    def whole_number(c: Column) -> Column:
        return F.round(c).cast("long")

    def place(c: str) -> Column:
        return F.struct(F.col(f"{c}.month").alias("month"), whole_number(F.col(f"{c}.value")).alias("value"))

    return whole.select(
        market,
        F.struct("first_month", "last_month", "n_months").alias("coverage"),
        F.struct(
            F.col("last_month").alias("month"),
            whole_number(last["median_close_price"]).alias("median_close_price"),
            last["closed_sales"].alias("closed_sales"),
            F.round(last["median_dom"], 1).alias("median_dom"),
            F.round(last["median_price_per_sqft"], 1).alias("median_price_per_sqft"),
            F.round(last["avg_close_to_orig_ratio"], 4).alias("avg_close_to_orig_ratio"),
            "new_listings",
        ).alias("latest"),
        F.struct(
            last["mom_price"].alias("median_close_price"), last["mom_sales"].alias("closed_sales"),
            last["mom_dom"].alias("median_dom"),
        ).alias("mom_change_pct"),
        F.when(last["has_prior_year"], F.struct(
            last["yoy_price"].alias("median_close_price"), last["yoy_sales"].alias("closed_sales"),
        )).alias("yoy_change_pct"),
        F.struct(
            place("peak").alias("peak_median_price"), place("trough").alias("trough_median_price"),
            percent_change(last["median_close_price"], F.col("peak.value")).alias("latest_vs_peak_pct"),
        ).alias("series"),
        F.struct(F.round(supply, 2).alias("new_listings_to_sales_ratio")).alias("supply_demand"),
    )


def flat_metrics(metrics: DataFrame, market: str = "market") -> DataFrame:
    """The nested record as plain columns."""
    return metrics.select(
        market, "coverage.*", "latest.median_close_price", "latest.closed_sales", "latest.median_dom",
        "latest.median_price_per_sqft", "latest.avg_close_to_orig_ratio", "latest.new_listings",
        F.col("mom_change_pct.median_close_price").alias("mom_price"),
        F.col("mom_change_pct.closed_sales").alias("mom_sales"),
        F.col("mom_change_pct.median_dom").alias("mom_dom"),
        F.col("yoy_change_pct.median_close_price").alias("yoy_price"),
        F.col("yoy_change_pct.closed_sales").alias("yoy_sales"),
        F.col("series.peak_median_price.month").alias("peak_month"),
        F.col("series.peak_median_price.value").alias("peak_price"),
        F.col("series.trough_median_price.month").alias("trough_month"),
        F.col("series.trough_median_price.value").alias("trough_price"),
        "series.latest_vs_peak_pct", "supply_demand.new_listings_to_sales_ratio",
    )


def densify_months(kpi: DataFrame, values: list[str], market: str = "market") -> DataFrame:
    """Every month from first to last of each market; missing months are null."""
    spans = kpi.groupBy(market).agg(
        F.min(month_start("yr_mo")).alias("a"), F.max(month_start("yr_mo")).alias("b")
    )
    months = spans.select(
        market, F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("_d")
    ).select(market, F.date_format("_d", "yyyy-MM").alias("yr_mo"))
    return months.join(kpi.select(market, "yr_mo", *values), [market, "yr_mo"], "left")


def as_series(kpi: DataFrame, values: list[str], market: str = "market") -> DataFrame:
    """(market, metric, month, value), one series per market and metric, with
    missing months as null."""
    dense = densify_months(kpi, values, market)
    parts = F.array(*[
        F.struct(F.lit(v).alias("metric"), F.col(v).cast("double").alias("value")) for v in values
    ])
    return dense.select(market, month_start("yr_mo").alias("month"), F.inline(parts))


def holdout_split(series: DataFrame, keys: list[str], points: int) -> DataFrame:
    """Marks the last ``points`` months of each series as ``held_out``."""
    newest = Window.partitionBy(*keys).orderBy(F.col("month").desc())
    return series.withColumn("held_out", F.row_number().over(newest) <= points)


def recent_months(df: DataFrame, year: str, month: str, share: float) -> DataFrame:
    """(month_index, rows, is_test): whole months from the latest backwards
    until they hold at least ``share`` of the rows."""
    counts = (
        df.filter(F.col(year).isNotNull() & F.col(month).isNotNull())
        .groupBy((F.col(year) * 12 + F.col(month)).alias("month_index"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    # One row per calendar month, so the window without a partition is small.
    newer = Window.orderBy(F.col("month_index").desc()).rowsBetween(Window.unboundedPreceding, -1)
    total = counts.agg(F.sum("rows")).scalar()
    return counts.select(
        "month_index", "rows",
        (F.coalesce(F.sum("rows").over(newer), F.lit(0)) < total * share).alias("is_test"),
    )
