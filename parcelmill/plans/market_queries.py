"""Marts, segments, rankings and calendar comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelmill.functions.scalar import is_month_text, month_text
from parcelmill.operators import calendar, facts, marts, ranking, sketches
from parcelmill.operators.clean import homes_only
from parcelmill.operators.features import listed_extract, preview, sold_extract
from parcelmill.plans import stages
from parcelmill.plans.registry import query
from parcelmill.plans.views import rate_rows, sold_rows, table
from parcelmill.session import stage
from parcelmill.sources import rates

_KPI_INPUT = ["yr_mo", "ClosePrice", "DaysOnMarket", "price_per_sqft", "close_to_original_list_ratio"]


def _mart(spark, folder):
    return marts.monthly_market(stages.sold_clean(spark, folder, [*_KPI_INPUT, "price_ratio"]))


def _new_mart(spark, folder):
    return marts.monthly_new_listings(stages.listed_clean(
        spark, folder, ["yr_mo", "ListPrice", "list_price_per_sqft"]))


def county_kpi(spark, folder):
    rows = stages.sold_clean(spark, folder, ["CountyOrParish", *_KPI_INPUT])
    # Small next to its input, and read by several comparisons below.
    return stage(marts.market_month_kpi(rows, "CountyOrParish"), "county-kpi")


def county_new(spark, folder):
    rows = stages.listed_clean(spark, folder, ["CountyOrParish", "yr_mo"])
    return marts.market_month_listings(rows, "CountyOrParish")


# --- monthly marts ---------------------------------------------------------

@query("monthly_market", """
SELECT yr_mo, closed_sales, round(median_close_price, 6) AS median_close_price,
  round(avg_close_price, 4) AS avg_close_price, round(median_price_per_sqft, 6) AS median_price_per_sqft,
  round(avg_dom, 4) AS avg_dom, round(median_dom, 6) AS median_dom,
  round(avg_close_to_orig_ratio, 4) AS avg_close_to_orig_ratio, round(avg_price_ratio, 4) AS avg_price_ratio
FROM monthly_market""", needs=("monthly_market",))
def monthly_market(spark, folder):
    return _mart(spark, folder)


@query("monthly_new_listings", """
SELECT yr_mo, new_listings, round(median_list_price, 6) AS median_list_price,
  round(median_list_per_sqft, 6) AS median_list_per_sqft FROM monthly_new_listings""",
       needs=("monthly_new_listings",))
def monthly_new_listings(spark, folder):
    return _new_mart(spark, folder)


_KPI_SQL = """
SELECT market, yr_mo, closed_sales, round(median_close_price, 6) AS median_close_price,
  round(median_dom, 6) AS median_dom, round(median_price_per_sqft, 6) AS median_price_per_sqft,
  round(avg_close_to_orig_ratio, 4) AS avg_close_to_orig_ratio FROM {s}"""


@query("market_month_kpi", _KPI_SQL.format(s="county_kpi"), needs=("county_kpi",))
def market_month_kpi(spark, folder):
    return county_kpi(spark, folder)


@query("whole_month_kpi", _KPI_SQL.format(s="kpi"), needs=("sold_clean",), kpi="""
SELECT 'all' AS market, yr_mo, count(*) AS closed_sales, median(ClosePrice) AS median_close_price,
  median(DaysOnMarket) AS median_dom, median(price_per_sqft) AS median_price_per_sqft,
  avg(close_to_original_list_ratio) AS avg_close_to_orig_ratio FROM sold_clean GROUP BY yr_mo""")
def whole_month_kpi(spark, folder):
    return marts.market_month_kpi(stages.sold_clean(spark, folder, _KPI_INPUT))


@query("market_month_listings", "SELECT * FROM county_new", needs=("county_new",))
def market_month_listings(spark, folder):
    return county_new(spark, folder)


@query("month_parity", """
SELECT a.*, b.*, a.sold_first = b.listed_first AND a.sold_last = b.listed_last AS same
FROM (SELECT min(yr_mo) AS sold_first, max(yr_mo) AS sold_last FROM monthly_market) a,
  (SELECT min(yr_mo) AS listed_first, max(yr_mo) AS listed_last FROM monthly_new_listings) b""",
       needs=("monthly_market", "monthly_new_listings"))
def month_parity(spark, folder):
    sales = stages.sold_clean(spark, folder, ["yr_mo"]).select("yr_mo")
    return marts.month_parity(sales, stages.listed_clean(spark, folder, ["yr_mo"]))


@query("supply_demand_monthly", """
SELECT m.yr_mo, m.closed_sales, l.new_listings
FROM monthly_market m LEFT JOIN monthly_new_listings l ON m.yr_mo = l.yr_mo""",
       needs=("monthly_market", "monthly_new_listings"))
def supply_demand_monthly(spark, folder):
    sales = stages.sold_clean(spark, folder, ["yr_mo", "ClosePrice"])
    fresh = stages.listed_clean(spark, folder, ["yr_mo", "ListPrice"])
    return marts.supply_demand(
        sales.groupBy("yr_mo").agg(F.count("ClosePrice").alias("closed_sales")),
        fresh.groupBy("yr_mo").agg(F.count("ListPrice").alias("new_listings")))


@query("price_and_sqft_monthly", """
SELECT yr_mo, round(median_close_price, 6) AS median_close_price,
  round(median_price_per_sqft, 6) AS median_price_per_sqft FROM monthly_market""", needs=("monthly_market",))
def price_and_sqft_monthly(spark, folder):
    return marts.price_and_sqft_by_month(
        stages.sold_clean(spark, folder, ["yr_mo", "ClosePrice", "price_per_sqft"]))


_CHOSEN = "City IN ('BUILDING', 'MACHINERY') AND CountyOrParish IN ('NATION_1', 'NATION_2', 'NATION_4', 'NATION_5')"
_CHOICE = {"City": ["BUILDING", "MACHINERY"],
           "CountyOrParish": ["NATION_1", "NATION_2", "NATION_4", "NATION_5"]}


@query("filtered_trends", f"""
SELECT coalesce(s.yr_mo, l.yr_mo) AS yr_mo, round(avg_dom, 4) AS avg_dom,
  round(avg_close_to_orig_ratio, 4) AS avg_close_to_orig_ratio, closed_sales,
  round(median_close_price, 6) AS median_close_price, new_listings
FROM (SELECT yr_mo, avg(DaysOnMarket) AS avg_dom, avg(close_to_original_list_ratio) AS avg_close_to_orig_ratio,
    count(*) AS closed_sales, median(ClosePrice) AS median_close_price
  FROM sold_clean WHERE {_CHOSEN} AND yr_mo >= '1997-01' GROUP BY yr_mo) s
FULL JOIN (SELECT yr_mo, count(*) AS new_listings FROM listed_clean
  WHERE {_CHOSEN} AND yr_mo >= '1997-01' GROUP BY yr_mo) l ON s.yr_mo = l.yr_mo""",
       needs=("sold_clean", "listed_clean"))
def filtered_trends(spark, folder):
    sales = stages.sold_clean(spark, folder, ["City", "CountyOrParish", *_KPI_INPUT])
    fresh = stages.listed_clean(spark, folder, ["City", "CountyOrParish", "yr_mo"])
    return marts.market_trends(sales, fresh, "1997-01", **_CHOICE)


# --- rates -----------------------------------------------------------------

@query("rate_monthly", "SELECT yr_mo, round(rate_30yr_fixed, 4) AS rate_30yr_fixed FROM rates_monthly",
       needs=("rates_monthly",))
def rate_monthly(spark, folder):
    return rates.monthly_rates(rate_rows(spark, folder))


# The points as a text feed, in which a dot marks a missing value.
@query("rate_points", """
SELECT strftime(cast(DATE '1995-01-01' + to_months(cast(event_id % 60 AS int)) AS date), '%Y-%m') AS yr_mo,
  count(*) AS points, round(avg(value), 4) AS mean
FROM events WHERE event_id % 9 <> 0 AND value IS NOT NULL GROUP BY 1""")
def rate_points(spark, folder):
    text = table(spark, folder, "events").select(
        F.add_months(F.lit("1995-01-01").cast("date"), (F.col("event_id") % 60).cast("int")).cast("string")
        .alias("observation_date"),
        F.when(F.col("event_id") % 9 == 0, ".").otherwise(F.col("value").cast("string")).alias("MORTGAGE"))
    return rates.tidy_rates(text).groupBy(month_text("date").alias("yr_mo")).agg(
        F.count(F.lit(1)).alias("points"), F.avg("value").alias("mean"))


# Which keys may stand for a period: 'YYYY' or 'YYYY-MM'.
@query("month_shape", " UNION ALL ".join(f"""
SELECT '{c}' AS field, count(*) FILTER (regexp_full_match(cast({c} AS varchar), '[0-9]{{4}}(-[0-9]{{2}})?')) AS periods,
  count(*) AS rows FROM sold""" for c in ("yr_mo", "close_year", "close_month", "PostalCode", "CloseDate")), needs=("sold",))
def month_shape(spark, folder):
    fields = ("yr_mo", "close_year", "close_month", "PostalCode", "CloseDate")
    cells = stages.sold(spark, folder).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("text")) for c in fields])))
    return cells.groupBy("field").agg(
        F.count_if(is_month_text("text")).alias("periods"), F.count(F.lit(1)).alias("rows"))


def _enrich_sql(day, source):
    return f"""
SELECT (SELECT count(*) FROM {source}) AS rows_before, count(*) AS rows_after,
  count(*) - count(rate_30yr_fixed) AS unmatched, round(min(rate_30yr_fixed), 4) AS min_rate_,
  round(max(rate_30yr_fixed), 4) AS max_rate_
FROM {source} s LEFT JOIN rates_monthly r ON strftime(s.{day}, '%Y-%m') = r.yr_mo"""


def _enrich(df, day, spark, folder):
    # Staged, so that counting the rows before the join does not redo the input.
    small = stage(df.select(day), "enrich")
    report = rates.enrich_report(small, rates.enrich(small, day, rate_rows(spark, folder)))
    return report.withColumnsRenamed({"min_rate": "min_rate_", "max_rate": "max_rate_"}).withColumns({
        c: F.round(c, 4) for c in ("min_rate_", "max_rate_")})


@query("rate_enrich", _enrich_sql("CloseDate", "home"), needs=("home", "rates_monthly"))
def rate_enrich(spark, folder):
    return _enrich(homes_only(sold_rows(spark, folder)), "CloseDate", spark, folder)


@query("listed_rate_enrich", _enrich_sql("ListingContractDate", "home"), needs=("home", "rates_monthly"))
def listed_rate_enrich(spark, folder):
    return _enrich(homes_only(sold_rows(spark, folder)), "ListingContractDate", spark, folder)


@query("rate_by_close_month", """
SELECT s.yr_mo, round(avg(r.rate_30yr_fixed), 4) AS rate_30yr_fixed FROM sold s
LEFT JOIN rates_monthly r ON s.yr_mo = r.yr_mo WHERE s.yr_mo IS NOT NULL GROUP BY s.yr_mo""",
       needs=("sold", "rates_monthly"))
def rate_by_close_month(spark, folder):
    rows = rates.enrich(stages.sold(spark, folder), "CloseDate", rate_rows(spark, folder))
    return rates.mean_rate_by_month(rows)


# --- segments --------------------------------------------------------------

_SOLD_SEGMENT = """
SELECT '{k}' AS dimension, {k} AS segment, count(ClosePrice) AS transaction_count,
  round(median(ClosePrice), 6) AS median_close_price, round(median(price_per_sqft), 6) AS median_price_per_sqft,
  round(median(price_ratio), 6) AS median_price_ratio, round(median(DaysOnMarket), 6) AS median_dom,
  round(median(listing_to_contract_days), 6) AS median_listing_to_contract,
  round(median(contract_to_close_days), 6) AS median_contract_to_close
FROM sold WHERE {k} IS NOT NULL GROUP BY {k}"""
_LISTED_SEGMENT = """
SELECT '{k}' AS dimension, {k} AS segment, count(ListPrice) AS listing_count,
  round(median(ListPrice), 6) AS median_list_price,
  round(median(list_price_per_sqft), 6) AS median_list_price_per_sqft,
  round(median(price_reduction_ratio), 6) AS median_price_reduction, round(median(DaysOnMarket), 6) AS median_dom,
  round(median(listing_to_contract_days), 6) AS median_listing_to_contract
FROM listed WHERE {k} IS NOT NULL GROUP BY {k}"""
_SOLD_KEYS = ["PropertySubType", "CountyOrParish", "ListOfficeName", "BuyerOfficeName"]
_LISTED_KEYS = ["MlsStatus", "PropertySubType", "CountyOrParish", "ListOfficeName"]
_SOLD_SEGMENT_INPUT = ["ClosePrice", "price_per_sqft", "price_ratio", "DaysOnMarket",
                       "listing_to_contract_days", "contract_to_close_days"]
_LISTED_SEGMENT_INPUT = ["ListPrice", "list_price_per_sqft", "price_reduction_ratio", "DaysOnMarket",
                         "listing_to_contract_days"]


@query("segment_sold", " UNION ALL ".join(_SOLD_SEGMENT.format(k=k) for k in _SOLD_KEYS), needs=("sold",))
def segment_sold(spark, folder):
    rows = stages.sold_staged(spark, folder, [*_SOLD_KEYS, *_SOLD_SEGMENT_INPUT])
    return marts.sold_segments_by(rows, _SOLD_KEYS)


@query("segment_listed", " UNION ALL ".join(_LISTED_SEGMENT.format(k=k) for k in _LISTED_KEYS),
       needs=("listed",))
def segment_listed(spark, folder):
    rows = stages.listed_staged(spark, folder, [*_LISTED_KEYS, *_LISTED_SEGMENT_INPUT])
    return marts.listed_segments_by(rows, _LISTED_KEYS)


@query("segment_sold_county", _SOLD_SEGMENT.format(k="CountyOrParish").replace("'CountyOrParish' AS dimension,", ""),
       needs=("sold",))
def segment_sold_county(spark, folder):
    rows = stages.sold_staged(spark, folder, ["CountyOrParish", *_SOLD_SEGMENT_INPUT])
    return marts.sold_segments(rows, "CountyOrParish")


# The value found from the sketches has a rank near the middle of the rows.
@query("sketched_medians", """
SELECT CountyOrParish AS market, count(*) AS rows, true AS within FROM sold_clean
WHERE CountyOrParish IS NOT NULL AND yr_mo BETWEEN '1994-01' AND '1998-06' GROUP BY 1""", needs=("sold_clean",))
def sketched_medians(spark, folder):
    rows = stage(stages.sold_clean(spark, folder, ["CountyOrParish", "yr_mo", "ClosePrice"]).select(
        F.col("CountyOrParish").alias("market"), "yr_mo", "ClosePrice").filter("market IS NOT NULL"), "sketch-rows")
    stored = stage(sketches.month_sketches(rows, ["market"], ["ClosePrice"]), "sketches")
    found = sketches.span_quantiles(stored, ["market"], {"middle": ("ClosePrice", 0.5)}, "1994-01", "1998-06")
    span = rows.filter(F.col("yr_mo").between("1994-01", "1998-06"))
    ranks = span.join(found.withColumnRenamed("rows", "n"), "market").groupBy("market").agg(
        F.max("n").alias("rows"), F.avg((F.col("ClosePrice") < F.col("middle")).cast("int")).alias("below"),
        F.avg((F.col("ClosePrice") <= F.col("middle")).cast("int")).alias("up_to"))
    slack = 2 * sketches.rank_error()  # a bound that the check never meets by chance
    return ranks.select("market", "rows", ((F.col("below") <= 0.5 + slack) & (F.col("up_to") >= 0.5 - slack)).alias("within"))


@query("zip_layers", """
SELECT PostalCode, count(*) AS units, round(median(ClosePrice), 6) AS median_close_price FROM sold_clean
WHERE yr_mo IN ('1997-03', '1997-04', '1997-05') GROUP BY 1""", needs=("sold_clean",))
def zip_layers(spark, folder):
    rows = stages.sold_clean(spark, folder, ["PostalCode", "yr_mo", "ClosePrice"])
    return marts.zip_layers(rows, months=["1997-03", "1997-04", "1997-05"])


@query("ratio_by_office", """
SELECT ListOfficeName, round(avg(close_to_original_list_ratio), 4) AS avg_ratio, count(*) AS units
FROM sold_clean WHERE ListOfficeName IS NOT NULL GROUP BY 1""", needs=("sold_clean",))
def ratio_by_office(spark, folder):
    rows = stages.sold_clean(spark, folder, ["ListOfficeName", "close_to_original_list_ratio"])
    return marts.mean_by(rows, "ListOfficeName", "close_to_original_list_ratio", "avg_ratio")


@query("dom_by_city", """
SELECT City, round(avg(DaysOnMarket), 4) AS avg_dom, count(*) AS units FROM sold_clean
WHERE City IS NOT NULL GROUP BY 1""", needs=("sold_clean",))
def dom_by_city(spark, folder):
    rows = stages.sold_clean(spark, folder, ["City", "DaysOnMarket"])
    return marts.mean_by(rows, "City", "DaysOnMarket", "avg_dom")


@query("above_below_list", """
SELECT *, round(above * 100.0 / (above + below + level), 4) AS above_pct,
  round(below * 100.0 / (above + below + level), 4) AS below_pct,
  round(level * 100.0 / (above + below + level), 4) AS level_pct
FROM (SELECT count(*) FILTER (ClosePrice > ListPrice) AS above, count(*) FILTER (ClosePrice < ListPrice) AS below,
  count(*) FILTER (ClosePrice = ListPrice) AS level,
  count(*) FILTER (ListingContractDate > CloseDate) AS date_issues FROM home) t""", needs=("home",))
def above_below_list(spark, folder):
    return marts.list_price_comparison(homes_only(sold_rows(spark, folder)))


# --- rankings --------------------------------------------------------------

_TOP10_SQL = """
SELECT CountyOrParish, count(*) AS rows, round(median({p}), 6) AS median_value FROM home
WHERE CountyOrParish IS NOT NULL GROUP BY 1 ORDER BY median({p}) DESC NULLS LAST, 1 LIMIT 10"""


@query("county_median_top10", _TOP10_SQL.format(p="ClosePrice"), needs=("home",))
def county_median_top10(spark, folder):
    rows = stages.sold_staged(spark, folder, ["CountyOrParish", "ClosePrice"])
    return ranking.top_groups_by_median(rows, "CountyOrParish", "ClosePrice")


@query("listed_county_median_top10", _TOP10_SQL.format(p="ListPrice"), needs=("home",))
def listed_county_median_top10(spark, folder):
    rows = stages.listed_staged(spark, folder, ["CountyOrParish", "ListPrice"])
    return ranking.top_groups_by_median(rows, "CountyOrParish", "ListPrice")


_VOLUME_SQL = """
SELECT {k}, rows, round(m, 6) AS median_value FROM (
  SELECT {k}, count(ClosePrice) AS rows, median(ClosePrice) AS m FROM sold WHERE {k} IS NOT NULL
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {n}) t"""


@query("top_by_volume_then_median", _VOLUME_SQL.format(k="CountyOrParish", n=12), needs=("sold",))
def top_by_volume_then_median(spark, folder):
    rows = stages.sold_staged(spark, folder, ["CountyOrParish", "ClosePrice"])
    return ranking.top_by_volume_then_median(rows, "CountyOrParish", "ClosePrice", 12)


@query("subtype_by_volume_then_median", _VOLUME_SQL.format(k="PropertySubType", n=8), needs=("sold",))
def subtype_by_volume_then_median(spark, folder):
    rows = stages.sold_staged(spark, folder, ["PropertySubType", "ClosePrice"])
    return ranking.top_by_volume_then_median(rows, "PropertySubType", "ClosePrice", 8)


@query("top_markets", """
SELECT market, cast(sum(closed_sales) AS bigint) AS closed_sales FROM county_kpi GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 8""", needs=("county_kpi",))
def top_markets(spark, folder):
    rows = stages.sold_clean(spark, folder, ["CountyOrParish", "yr_mo"])
    sales = rows.withColumn("market", F.col("CountyOrParish")).filter(
        F.col("market").isNotNull() & F.col("yr_mo").isNotNull())
    return ranking.top_markets(
        sales.groupBy("market", "yr_mo").agg(F.count(F.lit(1)).alias("closed_sales")))


_PARTY_SQL = """
SELECT {p} AS name, cast(sum(cast(round(ClosePrice, 4) AS decimal(18, 4))) AS double) AS volume, count(*) AS units
FROM {s} WHERE {p} IS NOT NULL GROUP BY 1 ORDER BY volume DESC NULLS LAST, name LIMIT {n}"""


@query("top_agents", _PARTY_SQL.format(p="ListAgentFullName", s="sold_clean", n=100), needs=("sold_clean",))
def top_agents(spark, folder):
    rows = stages.sold_clean(spark, folder, ["ListAgentFullName", "ClosePrice"])
    return ranking.top_parties(rows, "ListAgentFullName")


@query("top_offices", _PARTY_SQL.format(p="ListOfficeName", s="sold_clean", n=100), needs=("sold_clean",))
def top_offices(spark, folder):
    rows = stages.sold_clean(spark, folder, ["ListOfficeName", "ClosePrice"])
    return ranking.top_parties(rows, "ListOfficeName")


@query("top_agents_filtered", _PARTY_SQL.format(p="ListAgentFullName", s="chosen", n=100),
       needs=("sold_clean",), chosen=f"SELECT * FROM sold_clean WHERE {_CHOSEN}")
def top_agents_filtered(spark, folder):
    rows = stages.sold_clean(spark, folder, ["ListAgentFullName", "ClosePrice", "City", "CountyOrParish"])
    return ranking.top_parties(marts.filter_market(rows, **_CHOICE), "ListAgentFullName")


@query("top_agents_per_county", """
SELECT CountyOrParish, name, volume, units, cast(place AS int) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY CountyOrParish ORDER BY volume DESC NULLS LAST, name) AS place FROM (
    SELECT CountyOrParish, ListAgentFullName AS name,
      cast(sum(cast(round(ClosePrice, 4) AS decimal(18, 4))) AS double) AS volume, count(*) AS units
    FROM sold_clean WHERE CountyOrParish IS NOT NULL AND ListAgentFullName IS NOT NULL GROUP BY 1, 2) g) t
WHERE place <= 5""", needs=("sold_clean",))
def top_agents_per_county(spark, folder):
    rows = stages.sold_clean(spark, folder, ["CountyOrParish", "ListAgentFullName", "ClosePrice"])
    return ranking.top_parties_per_market(rows, "CountyOrParish", "ListAgentFullName")


@query("top_offices_per_county", """
SELECT CountyOrParish, name, volume, units, cast(place AS int) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY CountyOrParish ORDER BY volume DESC NULLS LAST, name) AS place FROM (
    SELECT CountyOrParish, ListOfficeName AS name,
      cast(sum(cast(round(ClosePrice, 4) AS decimal(18, 4))) AS double) AS volume, count(*) AS units
    FROM sold_clean WHERE CountyOrParish IS NOT NULL AND ListOfficeName IS NOT NULL GROUP BY 1, 2) g) t
WHERE place <= 5""", needs=("sold_clean",))
def top_offices_per_county(spark, folder):
    rows = stages.sold_clean(spark, folder, ["CountyOrParish", "ListOfficeName", "ClosePrice"])
    return ranking.top_parties_per_market(rows, "CountyOrParish", "ListOfficeName")


@query("growth_leaders", """
SELECT ListOfficeName, count(*) FILTER (yr_mo = '1997-04') - count(*) FILTER (yr_mo = '1997-03') AS change
FROM sold_clean WHERE yr_mo IN ('1997-03', '1997-04') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
       needs=("sold_clean",))
def growth_leaders(spark, folder):
    rows = stages.sold_clean(spark, folder, ["ListOfficeName", "yr_mo"])
    return ranking.growth_leaders(rows, "ListOfficeName", "1997-03", "1997-04")


@query("distinct_markets", "SELECT DISTINCT CountyOrParish FROM home WHERE CountyOrParish IS NOT NULL",
       needs=("home",))
def distinct_markets(spark, folder):
    return ranking.distinct_markets(homes_only(sold_rows(spark, folder)), "CountyOrParish")


@query("selected_market", """
SELECT City, count(*) AS rows FROM home WHERE CountyOrParish = 'NATION_7' GROUP BY 1""", needs=("home",))
def selected_market(spark, folder):
    rows = homes_only(sold_rows(spark, folder))
    return ranking.select_market(rows, "CountyOrParish", "NATION_7").groupBy("City").agg(
        F.count(F.lit(1)).alias("rows"))


# --- calendar --------------------------------------------------------------

_PAST_SQL = """
SELECT k.*, m.median_close_price AS price_m1, m.closed_sales AS sales_m1, m.median_dom AS dom_m1,
  y.median_close_price AS price_m12, y.closed_sales AS sales_m12, y.yr_mo IS NOT NULL AS has_prior_year
FROM (SELECT *, cast(yr_mo[1:4] AS int) * 12 + cast(yr_mo[6:7] AS int) AS i FROM county_kpi) k
LEFT JOIN (SELECT *, cast(yr_mo[1:4] AS int) * 12 + cast(yr_mo[6:7] AS int) AS i FROM county_kpi) m
  ON m.market = k.market AND m.i = k.i - 1
LEFT JOIN (SELECT *, cast(yr_mo[1:4] AS int) * 12 + cast(yr_mo[6:7] AS int) AS i FROM county_kpi) y
  ON y.market = k.market AND y.i = k.i - 12"""
_CHANGES_SQL = """
SELECT market, yr_mo, round((median_close_price - price_m1) / nullif(price_m1, 0) * 100, 1) AS mom_price,
  round((closed_sales - sales_m1) / nullif(sales_m1, 0) * 100, 1) AS mom_sales,
  round((median_dom - dom_m1) / nullif(dom_m1, 0) * 100, 1) AS mom_dom,
  round((median_close_price - price_m12) / nullif(price_m12, 0) * 100, 1) AS yoy_price,
  round((closed_sales - sales_m12) / nullif(sales_m12, 0) * 100, 1) AS yoy_sales, has_prior_year FROM past"""
# The earliest month among equal prices, spelled out with a rank.
_PEAK_SQL = """
SELECT market, max(CASE WHEN up = 1 THEN yr_mo END) AS peak_month, max(median_close_price) AS peak_price,
  max(CASE WHEN down = 1 THEN yr_mo END) AS trough_month, min(median_close_price) AS trough_price,
  max(CASE WHEN newest = 1 THEN median_close_price END) AS latest
FROM (SELECT *, row_number() OVER (PARTITION BY market ORDER BY median_close_price DESC NULLS LAST, yr_mo) AS up,
    row_number() OVER (PARTITION BY market ORDER BY median_close_price NULLS LAST, yr_mo) AS down,
    row_number() OVER (PARTITION BY market ORDER BY yr_mo DESC) AS newest FROM county_kpi) t GROUP BY market"""


@query("mom_yoy", "SELECT * FROM changes", needs=("county_kpi",), past=_PAST_SQL, changes=_CHANGES_SQL)
def mom_yoy(spark, folder):
    return calendar.mom_yoy(county_kpi(spark, folder))


@query("peak_trough", """
SELECT market, peak_month, round(peak_price, 4) AS peak_price, trough_month, round(trough_price, 4) AS trough_price,
  round((latest - peak_price) / nullif(peak_price, 0) * 100, 1) AS latest_vs_peak_pct FROM peaks""",
       needs=("county_kpi",), peaks=_PEAK_SQL)
def peak_trough(spark, folder):
    return calendar.peak_trough(county_kpi(spark, folder))


_METRICS_SQL = """
SELECT k.market, c.first_month, c.last_month, c.n_months,
  cast(round(k.median_close_price) AS bigint) AS median_close_price, k.closed_sales,
  round(k.median_dom, 1) AS median_dom, round(k.median_price_per_sqft, 1) AS median_price_per_sqft,
  round(k.avg_close_to_orig_ratio, 4) AS avg_close_to_orig_ratio, n.new_listings,
  g.mom_price, g.mom_sales, g.mom_dom, g.yoy_price, g.yoy_sales,
  p.peak_month, cast(round(p.peak_price) AS bigint) AS peak_price,
  p.trough_month, cast(round(p.trough_price) AS bigint) AS trough_price,
  round((p.latest - p.peak_price) / nullif(p.peak_price, 0) * 100, 1) AS latest_vs_peak_pct,
  round(n.new_listings / nullif(k.closed_sales, 0), 2) AS new_listings_to_sales_ratio
FROM county_kpi k JOIN cover c ON k.market = c.market AND k.yr_mo = c.last_month
JOIN changes g ON g.market = k.market AND g.yr_mo = k.yr_mo JOIN peaks p ON p.market = k.market
LEFT JOIN county_new n ON n.market = k.market AND n.yr_mo = k.yr_mo"""
_COVER_SQL = """SELECT market, min(yr_mo) AS first_month, max(yr_mo) AS last_month, count(*) AS n_months
FROM county_kpi GROUP BY market"""
_METRIC_STEPS = dict(past=_PAST_SQL, changes=_CHANGES_SQL, peaks=_PEAK_SQL, cover=_COVER_SQL)


def county_metrics(spark, folder):
    return calendar.market_metrics(county_kpi(spark, folder), county_new(spark, folder))


@query("market_metrics", _METRICS_SQL, needs=("county_kpi", "county_new"), **_METRIC_STEPS)
def market_metrics(spark, folder):
    return calendar.flat_metrics(county_metrics(spark, folder))


@query("top_market_metrics", f"""
SELECT market, last_month, median_close_price, mom_price, yoy_price, closed_sales, median_dom FROM (
  {_METRICS_SQL}) t WHERE market IN (SELECT market FROM county_kpi GROUP BY 1
  ORDER BY sum(closed_sales) DESC, 1 LIMIT 8)""", needs=("county_kpi", "county_new"), **_METRIC_STEPS)
def top_market_metrics(spark, folder):
    kpi = county_kpi(spark, folder)
    flat = calendar.flat_metrics(calendar.market_metrics(kpi, county_new(spark, folder)))
    return ranking.rows_of_markets(flat, ranking.top_markets(kpi)).select(
        "market", "last_month", "median_close_price", "mom_price", "yoy_price", "closed_sales",
        "median_dom")


_PCT = """coalesce(CASE WHEN {c} >= 0 THEN '+' ELSE '' END
  || regexp_replace(cast({c} AS varchar), '\\.0$', '') || '%', 'n/a')"""
_DIGITS = """coalesce(ltrim(format('{{:,}}', cast({c} AS bigint))), 'n/a')"""
_TEXT = """coalesce(cast({c} AS varchar), 'n/a')"""


def _p(c):
    return _PCT.format(c=c)


def _d(c):
    return _DIGITS.format(c=c)


def _t(c):
    return _TEXT.format(c=c)


def _trend(c):
    return f"CASE WHEN {c} IS NULL THEN 'unknown' WHEN {c} > 1 THEN 'up' WHEN {c} < -1 THEN 'down' ELSE 'flat' END"


@query("market_fact_sheet", f"""
SELECT market,
  'PRICE | median ' || {_d('median_close_price')} || ', 1m ' || {_p('mom_price')} || ', 12m ' || {_p('yoy_price')}
    || ', per sqft ' || {_t('median_price_per_sqft')} || ', of first ask ' || {_t('avg_close_to_orig_ratio')} || chr(10)
  || 'PACE | median days ' || {_t('median_dom')} || ', 1m ' || {_p('mom_dom')} || chr(10)
  || 'VOLUME | closed ' || {_d('closed_sales')} || ', 1m ' || {_p('mom_sales')} || ', 12m ' || {_p('yoy_sales')}
    || ', listed ' || {_d('new_listings')} || ', listed per closed ' || {_t('new_listings_to_sales_ratio')} || chr(10)
  || 'RANGE | high ' || {_d('peak_price')} || ', in ' || {_t('peak_month')} || ', low ' || {_d('trough_price')}
    || ', in ' || {_t('trough_month')} || ', off high ' || {_p('latest_vs_peak_pct')} || chr(10)
  || 'DATA | from ' || {_t('first_month')} || ', to ' || {_t('last_month')} || ', months ' || {_t('n_months')} AS facts
FROM metrics""", needs=("county_kpi", "county_new"), **_METRIC_STEPS, metrics=_METRICS_SQL)
def market_fact_sheet(spark, folder):
    return facts.fact_sheet(calendar.flat_metrics(county_metrics(spark, folder)))


@query("market_summary_text", f"""
SELECT market, market || ' in ' || last_month || ': price ' || {_trend('mom_price')} || ', sales '
    || {_trend('mom_sales')} AS headline,
  'Within a year price ' || {_trend('yoy_price')} || ' (' || {_p('yoy_price')} || '), sales ' || {_trend('yoy_sales')}
    || ' (' || {_p('yoy_sales')} || '). Half of the ' || {_d('closed_sales')} || ' homes sold below '
    || {_d('median_close_price')} || ' and within ' || {_t('median_dom')} || ' days.' AS summary,
  concat_ws('; ', CASE WHEN yoy_price > 10 THEN 'price jump within a year' END,
    CASE WHEN yoy_price < -10 THEN 'price fall within a year' END,
    CASE WHEN new_listings_to_sales_ratio > 1.25 THEN 'more listed than sold' END,
    CASE WHEN new_listings_to_sales_ratio < 0.75 THEN 'less listed than sold' END,
    CASE WHEN mom_dom > 10 THEN 'homes sell more slowly' END,
    CASE WHEN latest_vs_peak_pct < -15 THEN 'far below the high' END,
    CASE WHEN n_months < 13 THEN 'short history' END) AS watch
FROM metrics""", needs=("county_kpi", "county_new"), **_METRIC_STEPS, metrics=_METRICS_SQL)
def market_summary_text(spark, folder):
    told = facts.template_summary(calendar.flat_metrics(county_metrics(spark, folder)))
    return told.withColumn("watch", F.concat_ws("; ", "watch"))


@query("densify_all_months", """
SELECT g.market, g.yr_mo, k.closed_sales, round(k.median_close_price, 6) AS median_close_price
FROM (SELECT market, strftime(unnest(generate_series(a, z, INTERVAL 1 month)), '%Y-%m') AS yr_mo
  FROM (SELECT market, min(cast(yr_mo || '-01' AS date)) AS a, max(cast(yr_mo || '-01' AS date)) AS z
    FROM county_kpi GROUP BY market) s) g
LEFT JOIN county_kpi k ON k.market = g.market AND k.yr_mo = g.yr_mo""", needs=("county_kpi",))
def densify_all_months(spark, folder):
    return calendar.densify_months(county_kpi(spark, folder), ["closed_sales", "median_close_price"])


# The same with two months of every year taken out so that the series has gaps to fill.
@query("densify_months", """
SELECT g.market, g.yr_mo, k.closed_sales, round(k.median_close_price, 6) AS median_close_price
FROM (SELECT market, strftime(unnest(generate_series(a, z, INTERVAL 1 month)), '%Y-%m') AS yr_mo
  FROM (SELECT market, min(cast(yr_mo || '-01' AS date)) AS a, max(cast(yr_mo || '-01' AS date)) AS z
    FROM gapped GROUP BY market) s) g
LEFT JOIN gapped k ON k.market = g.market AND k.yr_mo = g.yr_mo""", needs=("county_kpi",),
       gapped="SELECT * FROM county_kpi WHERE yr_mo[6:7] NOT IN ('02', '07')")
def densify_months(spark, folder):
    gapped = county_kpi(spark, folder).filter(~F.substring("yr_mo", 6, 2).isin("02", "07"))
    return calendar.densify_months(gapped, ["closed_sales", "median_close_price"])


@query("holdout_split", """
SELECT market, held_out, count(*) AS months, min(yr_mo) AS first_month, round(avg(median_close_price), 4) AS mean_price
FROM (SELECT *, row_number() OVER (PARTITION BY market ORDER BY yr_mo DESC) <= 3 AS held_out FROM county_kpi) t
GROUP BY 1, 2""", needs=("county_kpi",))
def holdout_split(spark, folder):
    rows = county_kpi(spark, folder).withColumn("month", F.col("yr_mo"))
    marked = calendar.holdout_split(rows, ["market"], 3)
    return marked.groupBy("market", "held_out").agg(
        F.count(F.lit(1)).alias("months"), F.min("yr_mo").alias("first_month"),
        F.avg("median_close_price").alias("mean_price"))


@query("month_boundary_split", """
SELECT month_index, rows, coalesce(sum(rows) OVER (ORDER BY month_index DESC
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 0.2 * sum(rows) OVER () AS is_test
FROM (SELECT close_year * 12 + close_month AS month_index, count(*) AS rows FROM sold_clean
  WHERE ClosePrice > 0 GROUP BY 1) t""", needs=("sold_clean",))
def month_boundary_split(spark, folder):
    rows = stages.sold_clean(spark, folder, ["close_year", "close_month", "ClosePrice"])
    return calendar.recent_months(rows.filter(F.col("ClosePrice") > 0), "close_year", "close_month", 0.2)


# --- row-level outputs -----------------------------------------------------

_SOLD_LEAN = ["CountyOrParish", "City", "PostalCode", "yr_mo", "close_year", "ClosePrice", "price_ratio",
              "close_to_original_list_ratio", "contract_to_close_days"]


@query("lean_extract", """
SELECT CountyOrParish, City, PostalCode, yr_mo, close_year, round(ClosePrice, 4) AS ClosePrice,
  round(price_ratio, 4) AS price_ratio, round(close_to_original_list_ratio, 4) AS close_to_original_list_ratio,
  contract_to_close_days FROM sold_clean""", needs=("sold_clean",))
def lean_extract(spark, folder):
    extra = ["ListingKey", "YearBuilt"]
    return sold_extract(stages.sold_clean(spark, folder, [*_SOLD_LEAN, *extra]))


@query("listed_lean_extract", """
SELECT CountyOrParish, MlsStatus, cast(ListingContractDate AS varchar) AS ListingContractDate, yr_mo, list_year,
  round(ListPrice, 4) AS ListPrice, round(price_reduction_ratio, 4) AS price_reduction_ratio,
  listing_to_contract_days FROM listed_clean""", needs=("listed_clean",))
def listed_lean_extract(spark, folder):
    return listed_extract(stages.listed_clean(spark, folder, [
        "CountyOrParish", "MlsStatus", "ListingContractDate", "yr_mo", "list_year", "ListPrice",
        "price_reduction_ratio", "listing_to_contract_days", "ListingKey"]))


@query("preview_top_rows", """
SELECT cast(CloseDate AS varchar) AS CloseDate, yr_mo, round(ClosePrice, 4) AS ClosePrice,
  round(ListPrice, 4) AS ListPrice, DaysOnMarket, City
FROM sold ORDER BY sold.CloseDate, sold.yr_mo, sold.ClosePrice, sold.ListPrice, DaysOnMarket, City LIMIT 10""",
       needs=("sold",))
def preview_top_rows(spark, folder):
    return preview(stages.sold(spark, folder),
                   ["CloseDate", "yr_mo", "ClosePrice", "ListPrice", "DaysOnMarket", "City", "NotThere"],
                   10, ["CloseDate"])


@query("union_months", """
SELECT yr_mo, count(*) AS rows, count(rate_30yr_fixed) AS with_rate FROM (
  SELECT yr_mo, NULL AS rate_30yr_fixed FROM sold WHERE close_year < 1998
  UNION ALL SELECT s.yr_mo, r.rate_30yr_fixed FROM sold s LEFT JOIN rates_monthly r ON s.yr_mo = r.yr_mo
  WHERE close_year >= 1998) t GROUP BY 1""", needs=("sold", "rates_monthly"))
def union_months(spark, folder):
    rows = stages.sold(spark, folder).select("yr_mo", "close_year", "CloseDate")
    old = rows.filter(F.col("close_year") < 1998)
    new = rates.enrich(rows.filter(F.col("close_year") >= 1998), "CloseDate", rate_rows(spark, folder))
    both = old.unionByName(new, allowMissingColumns=True)
    return both.groupBy("yr_mo").agg(
        F.count(F.lit(1)).alias("rows"), F.count("rate_30yr_fixed").alias("with_rate"))
