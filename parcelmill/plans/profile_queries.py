"""Profiles, casts, flags and outliers over the home-sales tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelmill.constants import (
    CORE_COLUMNS, DATE_FLAGS, DESCRIBE_COLUMNS, GEO_FLAGS, HOME_TYPE, LISTED_ENGINEERED,
    LISTED_OUTLIERS, OUTLIER_FLAGS, SOLD_ENGINEERED, SOLD_OUTLIERS, VALUE_FLAGS,
)
from parcelmill.operators import clean, features, outliers, profile
from parcelmill.plans import stages
from parcelmill.plans.registry import query
from parcelmill.plans.views import sold_rows
from parcelmill.session import stage, staged_path
from parcelmill.sources import sinks


# --- frequencies and filters -----------------------------------------------

@query("type_frequency", """
SELECT PropertyType AS value, count(*) AS rows,
  round(count(*) * 100.0 / (SELECT count(*) FROM sale), 4) AS pct
FROM sale WHERE PropertyType IS NOT NULL GROUP BY 1""", needs=("sale",))
def type_frequency(spark, folder):
    return profile.frequency(sold_rows(spark, folder), "PropertyType")


@query("county_frequency", """
SELECT CountyOrParish AS value, count(*) AS rows,
  round(count(*) * 100.0 / (SELECT count(*) FROM sale), 4) AS pct
FROM sale WHERE CountyOrParish IS NOT NULL GROUP BY 1""", needs=("sale",))
def county_frequency(spark, folder):
    return profile.frequency(sold_rows(spark, folder), "CountyOrParish")


@query("status_frequency", """
SELECT MlsStatus AS value, count(*) AS rows,
  round(count(*) * 100.0 / (SELECT count(*) FROM home), 4) AS pct
FROM home WHERE MlsStatus IS NOT NULL GROUP BY 1""", needs=("home",))
def status_frequency(spark, folder):
    return profile.frequency(stages.listed(spark, folder), "MlsStatus")


@query("residential_filter_counts", """
SELECT count(*) AS rows_before, count(*) FILTER (PropertyType = 'Residential') AS rows_after,
  count(*) FILTER (PropertyType <> 'Residential') AS rows_removed FROM sale""", needs=("sale",))
def residential_filter_counts(spark, folder):
    return profile.filter_counts(sold_rows(spark, folder), F.col("PropertyType") == HOME_TYPE)


# --- casts -----------------------------------------------------------------

def _as_text(spark, folder):
    """Home sales as a text feed with bad dates and numbers in known rows."""
    bad = F.col("GarageSpaces") == 2
    return clean.homes_only(sold_rows(spark, folder)).select(
        "ListingKey",
        F.when(F.col("YearBuilt") % 7 == 0, "pending").otherwise(F.col("CloseDate").cast("string"))
        .alias("CloseDate"),
        F.col("PurchaseContractDate").cast("string").alias("PurchaseContractDate"),
        F.when(bad, "n/a").otherwise(F.col("ListPrice").cast("string")).alias("ListPrice"),
        F.when(bad, "unknown").otherwise(F.col("LivingArea").cast("string")).alias("LivingArea"),
        "DaysOnMarket", "LotSizeAcres",
    )


@query("lenient_date_cast", """
SELECT 'CloseDate' AS field, count(*) FILTER (CloseDate IS NULL OR YearBuilt % 7 = 0) AS nulls,
  count(*) FILTER (YearBuilt % 7 = 0) AS coerced FROM home
UNION ALL
SELECT 'PurchaseContractDate', count(*) FILTER (PurchaseContractDate IS NULL), 0 FROM home""",
       needs=("home",))
def lenient_date_cast(spark, folder):
    return clean.date_cast_report(_as_text(spark, folder))


@query("lenient_numeric_cast", """
SELECT 'ListPrice' AS field, 'string' AS type_before, 'double' AS type_after,
  count(*) FILTER (GarageSpaces = 2) AS nulls, count(*) FILTER (GarageSpaces = 2) AS coerced FROM home
UNION ALL
SELECT 'LivingArea', 'string', 'double', count(*) FILTER (LivingArea IS NULL OR GarageSpaces = 2),
  count(*) FILTER (LivingArea IS NOT NULL AND GarageSpaces = 2) FROM home
UNION ALL
SELECT 'LotSizeAcres', 'double', 'double', count(*) FILTER (LotSizeAcres IS NULL), 0 FROM home
UNION ALL
SELECT 'DaysOnMarket', 'int', 'double', count(*) FILTER (DaysOnMarket IS NULL), 0 FROM home""",
       needs=("home",))
def lenient_numeric_cast(spark, folder):
    return clean.number_cast_report(_as_text(spark, folder))


# --- gaps ------------------------------------------------------------------

_GAP_COLUMNS = ["ClosePrice", "ListPrice", "OriginalListPrice", "LivingArea", "LotSizeAcres",
                "CountyOrParish", "PurchaseContractDate", "YearBuilt", "PoolPrivateYN", "Latitude",
                "BuyerOfficeName"]


def _gap_sql(columns, source):
    one = """SELECT '{c}' AS field, count(*) AS rows, count(*) - count({c}) AS missing,
  round((count(*) - count({c})) * 100.0 / count(*), 2) AS pct FROM {s}"""
    return " UNION ALL ".join(one.format(c=c, s=source) for c in columns)


_BANDED = """SELECT *, CASE WHEN pct > 90 THEN 'sparse' WHEN pct > 50 THEN 'half_empty' ELSE 'kept' END
  AS band FROM gaps"""


@query("missing_profile", _BANDED, needs=("home",), gaps=_gap_sql(_GAP_COLUMNS, "home"))
def missing_profile(spark, folder):
    return profile.missing_profile(clean.homes_only(sold_rows(spark, folder)), _GAP_COLUMNS)


@query("core_completeness", _BANDED, needs=("home",), gaps=_gap_sql(CORE_COLUMNS, "home"))
def core_completeness(spark, folder):
    return profile.missing_profile(clean.homes_only(sold_rows(spark, folder)), CORE_COLUMNS)


@query("missing_top", f"""SELECT * FROM ({_BANDED}) t WHERE missing > 0
ORDER BY missing DESC, field LIMIT 5""", needs=("home",), gaps=_gap_sql(_GAP_COLUMNS, "home"))
def missing_top(spark, folder):
    return profile.missing_top(clean.homes_only(sold_rows(spark, folder)).select(*_GAP_COLUMNS), 5)


@query("drop_sparse_columns", """
SELECT ListingKey, count(*) AS copies, round(max(OriginalListPrice), 4) AS top_original FROM home GROUP BY 1""",
       needs=("home",))
def drop_sparse_columns(spark, folder):
    rows = stage(clean.homes_only(sold_rows(spark, folder)).select(
        "ListingKey", "OriginalListPrice", "LotSizeAcres"), "sparse")
    kept = clean.drop_sparse(rows)
    assert kept.columns == ["ListingKey", "OriginalListPrice"], kept.columns
    return kept.groupBy("ListingKey").agg(
        F.count(F.lit(1)).alias("copies"), F.max("OriginalListPrice").alias("top_original")
    )


@query("dtype_tally", """
SELECT 'string' AS dtype, cast(2 AS bigint) AS columns, count(CountyOrParish) + count(City) AS values FROM home
UNION ALL SELECT 'double', 3, count(ClosePrice) + count(LivingArea) + count(LotSizeAcres) FROM home
UNION ALL SELECT 'date', 2, count(CloseDate) + count(PurchaseContractDate) FROM home
UNION ALL SELECT 'int', 1, count(YearBuilt) FROM home
UNION ALL SELECT 'boolean', 1, count(PoolPrivateYN) FROM home""", needs=("home",))
def dtype_tally(spark, folder):
    return profile.dtype_tally(clean.homes_only(sold_rows(spark, folder)).select(
        "CountyOrParish", "City", "ClosePrice", "LivingArea", "LotSizeAcres", "CloseDate",
        "PurchaseContractDate", "YearBuilt", "PoolPrivateYN"))


@query("engineered_nonnull", " UNION ALL ".join(
    [f"SELECT 'sold' AS feed, '{c}' AS field, count({c}) AS present FROM sold" for c in SOLD_ENGINEERED]
    + [f"SELECT 'listed', '{c}', count({c}) FROM listed" for c in LISTED_ENGINEERED]),
       needs=("sold", "listed"))
def engineered_nonnull(spark, folder):
    one = profile.present_counts(stages.sold(spark, folder), SOLD_ENGINEERED)
    two = profile.present_counts(stages.listed(spark, folder), LISTED_ENGINEERED)
    both = one.withColumn("feed", F.lit("sold")).unionByName(two.withColumn("feed", F.lit("listed")))
    return both.select("feed", "field", "present")


# --- distributions ---------------------------------------------------------

_DESCRIBE_SQL = " UNION ALL ".join(f"""
SELECT '{c}' AS field, count({c}) * 1.0 AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
  round(min({c}), 6) AS min, {', '.join(
      f'round(quantile_cont({c}, {p}), 6) AS p{round(p * 100)}'
      for p in (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99))},
  round(max({c}), 6) AS max FROM home""" for c in DESCRIBE_COLUMNS)


def _describe_input(spark, folder):
    return stage(clean.homes_only(sold_rows(spark, folder)).select(*DESCRIBE_COLUMNS), "describe")


@query("numeric_describe", _DESCRIBE_SQL.replace("* 1.0", ""), needs=("home",))
def numeric_describe(spark, folder):
    return profile.describe(_describe_input(spark, folder), DESCRIBE_COLUMNS)


@query("numeric_describe_narrowed", _DESCRIBE_SQL.replace("* 1.0", ""), needs=("home",))
def numeric_describe_narrowed(spark, folder):
    """The same report through the narrowing that large groups use."""
    return profile.describe(_describe_input(spark, folder), DESCRIBE_COLUMNS, group_rows=0)


@query("centre_of_price_and_days", """
SELECT 'ClosePrice' AS field, round(median(ClosePrice), 6) AS median, round(avg(ClosePrice), 4) AS mean FROM home
UNION ALL SELECT 'DaysOnMarket', round(median(DaysOnMarket), 6), round(avg(DaysOnMarket), 4) FROM home""",
       needs=("home",))
def centre_of_price_and_days(spark, folder):
    columns = ["ClosePrice", "DaysOnMarket"]
    return profile.centre(stages.sold_staged(spark, folder, columns), columns)


_HISTOGRAM = """
SELECT b.bin, round(a + (z - a) / {n} * b.bin, 6) AS low, round(a + (z - a) / {n} * (b.bin + 1), 6) AS high,
  coalesce(c.rows, 0) AS rows
FROM ends, (SELECT cast(range AS int) AS bin FROM range({n})) b LEFT JOIN counts c ON b.bin = c.bin"""
_COUNTS = """SELECT cast(least(floor((v - a) / (z - a) * {n}), {n} - 1) AS int) AS bin, count(*) AS rows
FROM kept, ends GROUP BY 1"""


def _histogram_query(name, column, bins, source, kept):
    def register(function):
        return query(name, _HISTOGRAM.format(n=bins), needs=(source,), kept=kept,
                     ends="SELECT min(v) AS a, max(v) AS z FROM kept",
                     counts=_COUNTS.format(n=bins))(function)
    return register


@_histogram_query("price_histogram", "ClosePrice", 60, "sold", """
SELECT ClosePrice AS v FROM sold WHERE ClosePrice <= (SELECT quantile_cont(ClosePrice, 0.99) FROM sold)""")
def price_histogram(spark, folder):
    rows = stages.sold_staged(spark, folder, ["ClosePrice"])
    return profile.histogram(profile.trimmed(rows, "ClosePrice"), "ClosePrice", 60)


@_histogram_query("sqft_price_histogram", "price_per_sqft", 60, "sold", """
SELECT price_per_sqft AS v FROM sold
WHERE price_per_sqft > 0 AND price_per_sqft <= (SELECT quantile_cont(price_per_sqft, 0.99) FROM sold)""")
def sqft_price_histogram(spark, folder):
    rows = stages.sold_staged(spark, folder, ["price_per_sqft"])
    return profile.histogram(
        profile.trimmed(rows, "price_per_sqft", 0, strict=True), "price_per_sqft", 60
    )


@_histogram_query("days_histogram", "DaysOnMarket", 50, "sold", """
SELECT cast(DaysOnMarket AS double) AS v FROM sold
WHERE DaysOnMarket >= 0 AND DaysOnMarket <= (SELECT quantile_cont(DaysOnMarket, 0.99) FROM sold)""")
def days_histogram(spark, folder):
    rows = stages.sold_staged(spark, folder, ["DaysOnMarket"])
    return profile.histogram(profile.trimmed(rows, "DaysOnMarket", 0), "DaysOnMarket", 50)


@_histogram_query("list_price_histogram", "ListPrice", 50, "listed", """
SELECT ListPrice AS v FROM listed WHERE ListPrice IS NOT NULL""")
def list_price_histogram(spark, folder):
    return profile.histogram(stages.listed_staged(spark, folder, ["ListPrice"]), "ListPrice", 50)


@query("duplicate_keys", """
SELECT count(*) FILTER (n > 1) AS duplicate_keys, cast(sum(n - 1) AS bigint) AS surplus_rows
FROM (SELECT ListingKey, count(*) AS n FROM sale GROUP BY 1) t""", needs=("sale",))
def duplicate_keys(spark, folder):
    return profile.duplicate_keys(sold_rows(spark, folder), "ListingKey")


@query("keep_last_per_key", """
SELECT ListingKey, cast(closed AS varchar) AS CloseDate, round(price, 4) AS ClosePrice FROM (
  SELECT ListingKey, CloseDate AS closed, ClosePrice AS price,
    row_number() OVER (PARTITION BY ListingKey ORDER BY CloseDate DESC, ClosePrice DESC) AS k FROM sale) t
WHERE k = 1""", needs=("sale",))
def keep_last_per_key(spark, folder):
    rows = sold_rows(spark, folder).select("ListingKey", "CloseDate", "ClosePrice")
    return profile.keep_last(rows, ["ListingKey"], ["CloseDate", "ClosePrice"])


def _facts(spark, folder, columns):
    """Sales bucketed by key. The name leaves the catalogue again; the files are
    read by the plan and go with the staged tables."""
    path = staged_path(spark, "sale-facts")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"sale_facts_{path.rsplit('-', 1)[1]}"
    facts = sinks.write_facts(sold_rows(spark, folder).select(*columns), name, path, "ListingKey", buckets)
    spark.sql(f"DROP TABLE {name}")
    return facts


@query("duplicate_keys_bucketed", """
SELECT count(*) FILTER (n > 1) AS duplicate_keys, cast(sum(n - 1) AS bigint) AS surplus_rows
FROM (SELECT ListingKey, count(*) AS n FROM sale GROUP BY 1) t""", needs=("sale",))
def duplicate_keys_bucketed(spark, folder):
    return profile.duplicate_keys(_facts(spark, folder, ["ListingKey"]), "ListingKey")


@query("keep_last_bucketed", """
SELECT ListingKey, cast(closed AS varchar) AS CloseDate, round(price, 4) AS ClosePrice FROM (
  SELECT ListingKey, CloseDate AS closed, ClosePrice AS price,
    row_number() OVER (PARTITION BY ListingKey ORDER BY CloseDate DESC, ClosePrice DESC) AS k FROM sale) t
WHERE k = 1""", needs=("sale",))
def keep_last_bucketed(spark, folder):
    rows = _facts(spark, folder, ["ListingKey", "CloseDate", "ClosePrice"])
    return profile.keep_last(rows, ["ListingKey"], ["CloseDate", "ClosePrice"])


# --- rule flags ------------------------------------------------------------

def _sums_sql(flags, source):
    return (f"SELECT CountyOrParish, " + ", ".join(f"cast(sum({f}) AS bigint) AS {f}" for f in flags)
            + f", count(*) AS rows FROM {source} GROUP BY 1")


def _sums(df, flags):
    return df.groupBy("CountyOrParish").agg(
        *[F.sum(f).alias(f) for f in flags], F.count(F.lit(1)).alias("rows")
    )


@query("value_rule_flags", _sums_sql(VALUE_FLAGS, "sold_rules"), needs=("sold_rules",))
def value_rule_flags(spark, folder):
    return _sums(clean.add_value_flags(stages.sold(spark, folder)), VALUE_FLAGS)


@query("listed_value_rule_flags", _sums_sql(VALUE_FLAGS, "listed_rules"), needs=("listed_rules",))
def listed_value_rule_flags(spark, folder):
    return _sums(clean.add_value_flags(stages.listed(spark, folder), "ListPrice"), VALUE_FLAGS)


@query("date_rule_flags", _sums_sql(DATE_FLAGS, "sold_rules"), needs=("sold_rules",))
def date_rule_flags(spark, folder):
    return _sums(clean.add_date_flags(stages.sold(spark, folder)), DATE_FLAGS)


@query("geo_rule_flags", _sums_sql(GEO_FLAGS, "sold_rules"), needs=("sold_rules",))
def geo_rule_flags(spark, folder):
    return _sums(clean.add_geo_flags(stages.sold(spark, folder)), GEO_FLAGS)


@query("geo_issue_share", """
SELECT count(*) AS rows, count(*) FILTER (issue = 1) AS geo_issues,
  round(count(*) FILTER (issue = 1) * 100.0 / count(*), 4) AS pct
FROM (SELECT greatest(coord_missing_flag, coord_zero_flag, coord_positive_lon_flag,
  coord_out_of_state_flag) AS issue FROM sold_rules) t""", needs=("sold_rules",))
def geo_issue_share(spark, folder):
    return clean.geo_issue_share(clean.add_geo_flags(stages.sold(spark, folder)))


_ALL_FLAGS = [*VALUE_FLAGS, *DATE_FLAGS, *GEO_FLAGS, *OUTLIER_FLAGS, "outlier_any_flag",
              "quality_issue_flag"]


def _summary_sql(source):
    return " UNION ALL ".join(
        f"SELECT '{f}' AS flag, cast(sum({f}) AS bigint) AS hits, round(sum({f}) * 100.0 / count(*), 4) AS pct"
        f" FROM {source}" for f in _ALL_FLAGS)


@query("flag_summary", _summary_sql("sold_flagged"), needs=("sold_flagged",))
def flag_summary(spark, folder):
    return clean.flag_summary(stages.sold_flagged(spark, folder), _ALL_FLAGS)


@query("listed_flag_summary", _summary_sql("listed_flagged"), needs=("listed_flagged",))
def listed_flag_summary(spark, folder):
    return clean.flag_summary(stages.listed_flagged(spark, folder), _ALL_FLAGS)


_RULE_ITEMS = VALUE_FLAGS + DATE_FLAGS + GEO_FLAGS


@query("cleaning_summary", "SELECT 'rows_before' AS item, count(*) AS value FROM home UNION ALL "
       "SELECT 'rows_after', count(*) FROM home UNION ALL SELECT 'columns_before', 13 UNION ALL "
       "SELECT 'columns_after', 24 UNION ALL "
       + " UNION ALL ".join(f"SELECT '{f}', cast(sum({f}) AS bigint) FROM sold_rules" for f in _RULE_ITEMS)
       + """ UNION ALL SELECT 'any_geo_issue', count(*) FILTER (greatest(coord_missing_flag, coord_zero_flag,
  coord_positive_lon_flag, coord_out_of_state_flag) = 1) FROM sold_rules""",
       needs=("sold_rules",))
def cleaning_summary(spark, folder):
    raw = stage(clean.homes_only(sold_rows(spark, folder)).select(
        "CloseDate", "PurchaseContractDate", "ListingContractDate", "ContractStatusChangeDate",
        "ClosePrice", "LivingArea", "LotSizeAcres", "BedroomsTotal", "BathroomsTotalInteger",
        "DaysOnMarket", "Latitude", "Longitude", "CountyOrParish"), "cleaning")
    cleaned = clean.cast_numbers(clean.drop_sparse(clean.cast_dates(raw)))
    return clean.cleaning_summary(raw, clean.add_rule_flags(cleaned))


@query("flag_coercion", """
SELECT City, cast(sum(CASE WHEN lower(trim(w)) IN ('true', '1', 'yes', 'y', 't') THEN 1 ELSE 0 END) AS bigint)
  AS text_flag, cast(sum(CASE WHEN GarageSpaces <> 0 THEN 1 ELSE 0 END) AS bigint) AS number_flag,
  cast(sum(CASE WHEN PoolPrivateYN THEN 1 ELSE 0 END) AS bigint) AS boolean_flag
FROM (SELECT *, CASE GarageSpaces WHEN 0 THEN ' True ' WHEN 1 THEN 'no' WHEN 2 THEN 'YES' END AS w
  FROM home) t GROUP BY 1""", needs=("home",))
def flag_coercion(spark, folder):
    g = F.col("GarageSpaces")
    rows = clean.homes_only(sold_rows(spark, folder)).select(
        "City", F.when(g == 0, " True ").when(g == 1, "no").when(g == 2, "YES").alias("text_flag"),
        g.alias("number_flag"), F.col("PoolPrivateYN").alias("boolean_flag"))
    names = ["text_flag", "number_flag", "boolean_flag"]
    return clean.coerce_flags(rows, names).groupBy("City").agg(*[F.sum(n).alias(n) for n in names])


@query("median_impute", """
SELECT City, round(avg(coalesce(LivingArea, (SELECT median(LivingArea) FROM home))), 4) AS mean_area,
  round(avg(coalesce(YearBuilt, (SELECT median(YearBuilt) FROM home))), 4) AS mean_year
FROM home GROUP BY 1""", needs=("home",))
def median_impute(spark, folder):
    rows = stages.sold_staged(spark, folder, ["City", "LivingArea", "YearBuilt"])
    filled = clean.fill_medians(rows, ["LivingArea", "YearBuilt"])
    return filled.groupBy("City").agg(
        F.avg("LivingArea").alias("mean_area"), F.avg("YearBuilt").alias("mean_year"))


@query("positive_target", """
SELECT close_year, count(*) AS rows, round(min(ClosePrice), 6) AS min_price FROM sold
WHERE ClosePrice > 0 GROUP BY 1""", needs=("sold",))
def positive_target(spark, folder):
    rows = stages.sold(spark, folder).filter(F.col("ClosePrice") > 0)
    return rows.groupBy("close_year").agg(
        F.count(F.lit(1)).alias("rows"), F.min("ClosePrice").alias("min_price"))


@query("boolean_to_int", """
SELECT City, cast(sum(cast(PoolPrivateYN AS int)) AS bigint) AS pools, count(PoolPrivateYN) AS known_pools,
  cast(sum(cast(FireplaceYN AS int)) AS bigint) AS fireplaces FROM home GROUP BY 1""", needs=("home",))
def boolean_to_int(spark, folder):
    from parcelmill.functions.scalar import one_zero

    rows = clean.homes_only(sold_rows(spark, folder)).select(
        "City", one_zero("PoolPrivateYN").alias("pool"), one_zero("FireplaceYN").alias("fire"))
    return rows.groupBy("City").agg(
        F.sum("pool").alias("pools"), F.count("pool").alias("known_pools"),
        F.sum("fire").alias("fireplaces"))


# --- features --------------------------------------------------------------

def _ratio_sql(columns, source):
    return " UNION ALL ".join(f"""SELECT '{c}' AS field, count({c}) AS count, round(avg({c}), 4) AS mean,
  round(median({c}), 6) AS median, count(*) FILTER ({c} > 1) AS above_one,
  count(*) FILTER ({c} < 1) AS below_one,
  round(count(*) FILTER ({c} < 1) * 100.0 / count(*), 4) AS below_pct FROM {source}""" for c in columns)


_SOLD_RATIOS = ["price_ratio", "close_to_original_list_ratio", "price_per_sqft"]
_LISTED_RATIOS = ["list_price_per_sqft", "price_reduction_ratio", "close_to_list_ratio"]


@query("price_ratios", _ratio_sql(_SOLD_RATIOS, "sold"), needs=("sold",))
def price_ratios(spark, folder):
    return features.ratio_summary(stages.sold_staged(spark, folder, _SOLD_RATIOS), _SOLD_RATIOS)


@query("listed_price_ratios", _ratio_sql(_LISTED_RATIOS, "listed"), needs=("listed",))
def listed_price_ratios(spark, folder):
    return features.ratio_summary(stages.listed_staged(spark, folder, _LISTED_RATIOS), _LISTED_RATIOS)


@query("ratio_band_guard", """
SELECT count(*) AS rows, count(close_to_original_list_ratio) AS present,
  count(*) FILTER (close_to_original_list_ratio NOT BETWEEN 0.5 AND 2.0) AS nulled FROM sold""",
       needs=("sold",))
def ratio_band_guard(spark, folder):
    return features.guard_report(stages.sold(spark, folder))


@query("timeline_days", " UNION ALL ".join(f"""
SELECT '{c}' AS field, count({c}) AS count, round(avg({c}), 4) AS mean, round(median({c}), 6) AS median,
  round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.75), 6) AS p75 FROM sold"""
       for c in ("listing_to_contract_days", "contract_to_close_days")), needs=("sold",))
def timeline_days(spark, folder):
    return features.timeline_summary(stages.sold_staged(
        spark, folder, ["listing_to_contract_days", "contract_to_close_days"]))


@query("calendar_coverage", """
SELECT (SELECT string_agg(y, ',' ORDER BY y) FROM (SELECT DISTINCT cast(close_year AS varchar) AS y FROM sold) t)
    AS years, cast(min(close_month) AS int) AS min_month, cast(max(close_month) AS int) AS max_month,
  min(yr_mo) AS first_month, max(yr_mo) AS last_month, count(DISTINCT yr_mo) AS n_months FROM sold""",
       needs=("sold",))
def calendar_coverage(spark, folder):
    return features.calendar_coverage(stages.sold(spark, folder), "close_year", "close_month")


@query("listed_timeline_days", " UNION ALL ".join(f"""
SELECT '{c}' AS field, count({c}) AS count, round(avg({c}), 4) AS mean, round(median({c}), 6) AS median,
  round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.75), 6) AS p75 FROM listed"""
       for c in ("listing_to_contract_days", "contract_to_close_days")), needs=("listed",))
def listed_timeline_days(spark, folder):
    return features.timeline_summary(stages.listed_staged(
        spark, folder, ["listing_to_contract_days", "contract_to_close_days"]))


@query("listed_calendar_coverage", """
SELECT (SELECT string_agg(y, ',' ORDER BY y) FROM (SELECT DISTINCT cast(list_year AS varchar) AS y FROM listed) t)
    AS years, cast(min(list_month) AS int) AS min_month, cast(max(list_month) AS int) AS max_month,
  min(yr_mo) AS first_month, max(yr_mo) AS last_month, count(DISTINCT yr_mo) AS n_months FROM listed""",
       needs=("listed",))
def listed_calendar_coverage(spark, folder):
    return features.calendar_coverage(stages.listed(spark, folder), "list_year", "list_month")


# --- outliers --------------------------------------------------------------

def _fence_sql(price, source):
    parts = []
    for short, c in (("price", price), ("area", "LivingArea"), ("dom", "DaysOnMarket")):
        parts.append(f"""SELECT '{c}' AS field, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
  round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper, hits,
  round(hits * 100.0 / n, 4) AS pct, round(p1, 6) AS p1, round(p99, 6) AS p99, round(lo, 6) AS min,
  round(hi, 6) AS max
FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3,
    cast(sum(outlier_{short}_flag) AS bigint) AS hits, count(*) AS n, quantile_cont({c}, 0.01) AS p1,
    quantile_cont({c}, 0.99) AS p99, cast(min({c}) AS double) AS lo, cast(max({c}) AS double) AS hi
  FROM {source}) t""")
    return " UNION ALL ".join(parts)


@query("iqr_bounds", _fence_sql("ClosePrice", "sold_flagged"), needs=("sold_flagged",))
def iqr_bounds(spark, folder):
    return outliers.fence_table(stages.sold_staged(spark, folder, list(SOLD_OUTLIERS)), SOLD_OUTLIERS)


@query("listed_iqr_bounds", _fence_sql("ListPrice", "listed_flagged"), needs=("listed_flagged",))
def listed_iqr_bounds(spark, folder):
    return outliers.fence_table(stages.listed_staged(spark, folder, list(LISTED_OUTLIERS)), LISTED_OUTLIERS)


_IQR_FLAGS = [*OUTLIER_FLAGS, "outlier_any_flag"]


@query("iqr_flags", _sums_sql(_IQR_FLAGS, "sold_flagged"), needs=("sold_flagged",))
def iqr_flags(spark, folder):
    return _sums(stages.sold_flagged(spark, folder, ["CountyOrParish"]), _IQR_FLAGS)


@query("quality_flag", """
SELECT count(*) AS rows, cast(sum(quality_issue_flag) AS bigint) AS issues,
  round((1 - avg(quality_issue_flag)) * 100, 4) AS clean_pct FROM sold_flagged""", needs=("sold_flagged",))
def quality_flag(spark, folder):
    return outliers.clean_rate(stages.sold_flagged(spark, folder))


def _compare_sql(price, source):
    return " UNION ALL ".join(f"""
SELECT '{c}' AS field, rows_before, rows_after, round(m0, 6) AS median_before, round(m1, 6) AS median_after,
  round((m1 - m0) / nullif(m0, 0) * 100, 6) AS median_pct, round(a0, 4) AS mean_before, round(a1, 4) AS mean_after,
  round((a1 - a0) / nullif(a0, 0) * 100, 4) AS mean_pct
FROM (SELECT count(*) AS rows_before, count(*) FILTER (outlier_any_flag = 0) AS rows_after,
    median({c}) AS m0, median({c}) FILTER (outlier_any_flag = 0) AS m1,
    avg({c}) AS a0, avg({c}) FILTER (outlier_any_flag = 0) AS a1 FROM {source}) t"""
                            for c in (price, "LivingArea", "DaysOnMarket"))


@query("clean_before_after", _compare_sql("ClosePrice", "sold_flagged"), needs=("sold_flagged",))
def clean_before_after(spark, folder):
    return outliers.before_after(stages.sold_flagged(spark, folder), list(SOLD_OUTLIERS))


@query("listed_before_after", _compare_sql("ListPrice", "listed_flagged"), needs=("listed_flagged",))
def listed_before_after(spark, folder):
    return outliers.before_after(stages.listed_flagged(spark, folder), list(LISTED_OUTLIERS))


def _top_sql(day, field, flag, other):
    shown = f"{day}, CountyOrParish, City, PropertySubType, {field}, {other}"
    order = f"{day}, CountyOrParish NULLS FIRST, City, PropertySubType, {other} NULLS FIRST"
    return f"""(SELECT '{field}' AS ranked_by, cast({day} AS varchar) AS day, CountyOrParish, City, PropertySubType,
  round(cast({field} AS double), 4) AS value, round(cast({other} AS double), 4) AS companion
FROM (SELECT {shown}, {flag} FROM {{s}}) t WHERE {flag} = 1
ORDER BY cast({field} AS double) DESC, {order} LIMIT 5)"""


_TOPS = [("{p}", "outlier_price_flag", "LivingArea"), ("LivingArea", "outlier_area_flag", "{p}"),
         ("DaysOnMarket", "outlier_dom_flag", "{p}")]


def _tops_sql(day, price, source):
    return " UNION ALL ".join(
        _top_sql(day, f.format(p=price), flag, o.format(p=price)).format(s=source) for f, flag, o in _TOPS)


def _tops(df, day, price):
    whole = None
    for f, flag, o in _TOPS:
        field, other = f.format(p=price), o.format(p=price)
        top = outliers.top_outliers(
            df, field, flag, [day, "CountyOrParish", "City", "PropertySubType", field, other]
        ).select(
            F.lit(field).alias("ranked_by"), F.col(day).alias("day"), "CountyOrParish", "City",
            "PropertySubType", F.col(field).cast("double").alias("value"),
            F.col(other).cast("double").alias("companion"))
        whole = top if whole is None else whole.unionByName(top)
    return whole


@query("outlier_top5", _tops_sql("CloseDate", "ClosePrice", "sold_flagged"), needs=("sold_flagged",))
def outlier_top5(spark, folder):
    columns = ["CloseDate", "CountyOrParish", "City", "PropertySubType"]
    return _tops(stages.sold_flagged(spark, folder, columns), "CloseDate", "ClosePrice")


@query("listed_outlier_top5", _tops_sql("ListingContractDate", "ListPrice", "listed_flagged"),
       needs=("listed_flagged",))
def listed_outlier_top5(spark, folder):
    columns = ["ListingContractDate", "CountyOrParish", "City", "PropertySubType"]
    return _tops(stages.listed_flagged(spark, folder, columns), "ListingContractDate", "ListPrice")


@query("trimmed_rows", """
SELECT count(*) AS rows, round(max(price_per_sqft), 6) AS max_kept FROM sold
WHERE price_per_sqft > 0 AND price_per_sqft <= (SELECT quantile_cont(price_per_sqft, 0.99) FROM sold)""",
       needs=("sold",))
def trimmed_rows(spark, folder):
    rows = stages.sold_staged(spark, folder, ["price_per_sqft"])
    kept = profile.trimmed(rows, "price_per_sqft", 0, strict=True)
    return kept.agg(F.count(F.lit(1)).alias("rows"), F.max("price_per_sqft").alias("max_kept"))
