"""Market records as text: a table of figures, a verdict and signals to check.

Nothing is worded by hand per market. The layout is data: sections list which
figures they show, trends name the direction of a change, and signals are
conditions with thresholds. All of it is column expressions over the flat
record, one row per market.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.functions.scalar import signed_percent

MISSING = "n/a"

#: (section, ((label, column, kind), ...)); kinds: count, plain, change.
SECTIONS = (
    ("PRICE", (("median", "median_close_price", "count"), ("1m", "mom_price", "change"), ("12m", "yoy_price", "change"),
               ("per sqft", "median_price_per_sqft", "plain"), ("of first ask", "avg_close_to_orig_ratio", "plain"))),
    ("PACE", (("median days", "median_dom", "plain"), ("1m", "mom_dom", "change"))),
    ("VOLUME", (("closed", "closed_sales", "count"), ("1m", "mom_sales", "change"), ("12m", "yoy_sales", "change"),
                ("listed", "new_listings", "count"), ("listed per closed", "new_listings_to_sales_ratio", "plain"))),
    ("RANGE", (("high", "peak_price", "count"), ("in", "peak_month", "plain"), ("low", "trough_price", "count"),
               ("in", "trough_month", "plain"), ("off high", "latest_vs_peak_pct", "change"))),
    ("DATA", (("from", "first_month", "plain"), ("to", "last_month", "plain"), ("months", "n_months", "plain"))),
)

#: A change in percent beyond which a trend is not flat.
FLAT = 1.0

#: (signal, column, smallest value or None, largest value or None): raised outside.
SIGNALS = (
    ("price jump within a year", "yoy_price", None, 10.0),
    ("price fall within a year", "yoy_price", -10.0, None),
    ("more listed than sold", "new_listings_to_sales_ratio", None, 1.25),
    ("less listed than sold", "new_listings_to_sales_ratio", 0.75, None),
    ("homes sell more slowly", "mom_dom", None, 10.0),
    ("far below the high", "latest_vs_peak_pct", -15.0, None),
    ("short history", "n_months", 13.0, None),
)


def _shown(column: str, kind: str) -> Column:
    if kind == "change":
        return signed_percent(column, MISSING)
    text = F.format_number(F.col(column), 0) if kind == "count" else F.col(column).cast("string")
    return F.coalesce(text, F.lit(MISSING))


def fact_sheet(flat: DataFrame, market: str = "market") -> DataFrame:
    """(market, facts): a line per section, from ``flat_metrics``."""
    lines = [
        F.concat(F.lit(f"{name} | "), F.concat_ws(", ", *[
            F.concat(F.lit(f"{label} "), _shown(column, kind)) for label, column, kind in figures]))
        for name, figures in SECTIONS
    ]
    return flat.select(market, F.concat_ws("\n", *lines).alias("facts"))


def trend(change: Column | str) -> Column:
    """'up', 'down', 'flat' or 'unknown'."""
    c = F.col(change) if isinstance(change, str) else change
    return (F.when(c.isNull(), "unknown").when(c > FLAT, "up").when(c < -FLAT, "down").otherwise("flat"))


def template_summary(flat: DataFrame, market: str = "market") -> DataFrame:
    """(market, headline, summary, watch): trends, key figures, and the signals
    that are raised, in the order of ``SIGNALS``."""
    headline = F.concat(
        F.col(market), F.lit(" in "), F.col("last_month"), F.lit(": price "), trend("mom_price"), F.lit(", sales "),
        trend("mom_sales"))
    summary = F.concat(
        F.lit("Within a year price "), trend("yoy_price"), F.lit(" ("), _shown("yoy_price", "change"), F.lit("), sales "),
        trend("yoy_sales"), F.lit(" ("), _shown("yoy_sales", "change"), F.lit("). Half of the "),
        _shown("closed_sales", "count"), F.lit(" homes sold below "), _shown("median_close_price", "count"),
        F.lit(" and within "), _shown("median_dom", "plain"), F.lit(" days."))
    raised = [
        F.when((F.col(column) < low) if low is not None else (F.col(column) > high), F.lit(name))
        for name, column, low, high in SIGNALS
    ]
    return flat.select(
        market, headline.alias("headline"), summary.alias("summary"), F.array_compact(F.array(*raised)).alias("watch"))
