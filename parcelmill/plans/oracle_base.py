"""Shared SQL of the checks: the home-sales view and its derived steps, as
DuckDB common table expressions. Written apart from the Spark plans."""

from __future__ import annotations

STEPS: dict[str, tuple[list[str], str]] = {}


def _step(name: str, needs: list[str], body: str) -> None:
    STEPS[name] = (needs, body)


_step("joined", [], """
SELECT l.*, o.*, c.*, n.*, s.*, p.*,
       cast(o_orderdate AS date) AS listed_on, cast(l_shipdate AS date) AS closed_on,
       date_diff('day', cast(o_orderdate AS date), cast(l_shipdate AS date)) AS dom0
FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey
JOIN customer c ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n_nationkey
JOIN supplier s ON l_suppkey = s_suppkey JOIN part p ON l_partkey = p_partkey""")

_step("sale", ["joined"], """
SELECT concat(l_orderkey, '-', l_linenumber) AS ListingKey,
  CASE l_returnflag WHEN 'R' THEN 'Land' WHEN 'A' THEN 'Lease' ELSE 'Residential' END AS PropertyType,
  p_type AS PropertySubType, nullif(n_name, 'NATION_3') AS CountyOrParish,
  c_mktsegment AS City, p_brand AS PostalCode, concat('AREA_', n_regionkey) AS MLSAreaMajor,
  o_orderstatus AS MlsStatus, s_name AS ListOfficeName, c_name AS ListAgentFullName,
  nullif(concat('OFFICE_', c_custkey % 40), 'OFFICE_11') AS BuyerOfficeName,
  concat('AGENT_', c_custkey % 90) AS BuyerAgentFullName,
  closed_on AS CloseDate,
  CASE WHEN l_linenumber = 6 THEN NULL ELSE listed_on + cast(l_quantity AS int) END AS PurchaseContractDate,
  listed_on AS ListingContractDate, listed_on + 5 AS ContractStatusChangeDate,
  CASE WHEN l_linenumber = 7 AND l_quantity = 1 THEN 0 ELSE l_extendedprice * (1 - l_discount) END
    * CASE WHEN dom0 % 97 = 0 THEN 6 ELSE 1 END AS ClosePrice,
  l_extendedprice AS ListPrice,
  nullif(l_extendedprice * CASE WHEN l_partkey % 400 = 7 THEN cast(0.001 AS double) ELSE 1 + l_tax END,
         l_extendedprice) AS OriginalListPrice,
  cast((nullif(p_size, 13) - 1) * CASE WHEN dom0 % 83 = 0 THEN 7 ELSE 1 END AS double) AS LivingArea,
  CASE WHEN l_orderkey % 20 = 0 THEN p_retailprice * 5 / 43560 END AS LotSizeAcres,
  p_retailprice * 5 AS LotSizeSquareFeet,
  p_size % 6 - 1 AS BedroomsTotal, (p_size + 1) % 5 - 1 AS BathroomsTotalInteger,
  cast(CASE WHEN dom0 % 89 = 0 THEN dom0 * 8 ELSE dom0 END AS int) AS DaysOnMarket,
  cast(nullif(1950 + p_partkey % 70, 1983) AS int) AS YearBuilt, p_size % 4 AS GarageSpaces,
  CASE l_linenumber % 3 WHEN 0 THEN true WHEN 1 THEN false END AS PoolPrivateYN,
  l_quantity > 25 AS FireplaceYN, l_discount > cast(0.05 AS double) AS ViewYN, l_tax = 0 AS NewConstructionYN,
  CASE WHEN l_suppkey % 17 = 3 THEN NULL ELSE 33 + 9 * (s_acctbal / 10000) END AS Latitude,
  CASE l_suppkey % 19 WHEN 4 THEN 0 WHEN 5 THEN 118 WHEN 6 THEN -100
    ELSE -124 + 9 * (c_acctbal / 10000) END AS Longitude
FROM joined""")

_step("home", ["sale"], "SELECT * FROM sale WHERE PropertyType = 'Residential'")

_step("sold", ["home"], """
SELECT *, ClosePrice / nullif(ListPrice, 0) AS price_ratio,
  ClosePrice / nullif(OriginalListPrice, 0) AS close_to_original_list_ratio,
  ClosePrice / nullif(LivingArea, 0) AS price_per_sqft,
  cast(year(CloseDate) AS int) AS close_year, cast(month(CloseDate) AS int) AS close_month, strftime(CloseDate, '%Y-%m') AS yr_mo,
  CASE WHEN PurchaseContractDate >= ListingContractDate
    THEN cast(date_diff('day', ListingContractDate, PurchaseContractDate) AS int) END AS listing_to_contract_days,
  CASE WHEN CloseDate >= PurchaseContractDate
    THEN cast(date_diff('day', PurchaseContractDate, CloseDate) AS int) END AS contract_to_close_days
FROM home""")

_step("listed", ["home"], """
SELECT *, ListPrice / nullif(LivingArea, 0) AS list_price_per_sqft,
  ListPrice / nullif(OriginalListPrice, 0) AS price_reduction_ratio,
  ClosePrice / nullif(ListPrice, 0) AS close_to_list_ratio,
  cast(year(ListingContractDate) AS int) AS list_year, cast(month(ListingContractDate) AS int) AS list_month,
  strftime(ListingContractDate, '%Y-%m') AS yr_mo,
  CASE WHEN PurchaseContractDate >= ListingContractDate
    THEN cast(date_diff('day', ListingContractDate, PurchaseContractDate) AS int) END AS listing_to_contract_days,
  CASE WHEN CloseDate >= PurchaseContractDate
    THEN cast(date_diff('day', PurchaseContractDate, CloseDate) AS int) END AS contract_to_close_days
FROM home""")


def _rule_sql(price: str) -> str:
    return f"""
  CASE WHEN {price} <= 0 THEN 1 ELSE 0 END AS invalid_price_flag,
  CASE WHEN LivingArea <= 0 THEN 1 ELSE 0 END AS invalid_area_flag,
  CASE WHEN DaysOnMarket < 0 THEN 1 ELSE 0 END AS invalid_dom_flag,
  CASE WHEN BedroomsTotal < 0 THEN 1 ELSE 0 END AS invalid_beds_flag,
  CASE WHEN BathroomsTotalInteger < 0 THEN 1 ELSE 0 END AS invalid_baths_flag,
  CASE WHEN ListingContractDate > CloseDate THEN 1 ELSE 0 END AS listing_after_close_flag,
  CASE WHEN PurchaseContractDate > CloseDate THEN 1 ELSE 0 END AS purchase_after_close_flag,
  CASE WHEN ListingContractDate > CloseDate OR PurchaseContractDate > CloseDate
    THEN 1 ELSE 0 END AS negative_timeline_flag,
  CASE WHEN Latitude IS NULL OR Longitude IS NULL THEN 1 ELSE 0 END AS coord_missing_flag,
  CASE WHEN Latitude IS NOT NULL AND Longitude IS NOT NULL AND (Latitude = 0 OR Longitude = 0)
    THEN 1 ELSE 0 END AS coord_zero_flag,
  CASE WHEN Longitude > 0 THEN 1 ELSE 0 END AS coord_positive_lon_flag,
  CASE WHEN Latitude IS NOT NULL AND Longitude IS NOT NULL AND Latitude <> 0 AND Longitude <> 0
    AND (Latitude < 32.5 OR Latitude > 42.0 OR Longitude < -124.5 OR Longitude > -114.1)
    THEN 1 ELSE 0 END AS coord_out_of_state_flag"""


_step("sold_rules", ["sold"], f"SELECT *, {_rule_sql('ClosePrice')} FROM sold")
_step("listed_rules", ["listed"], f"SELECT *, {_rule_sql('ListPrice')} FROM listed")


def _fences_sql(price: str, source: str) -> str:
    parts = []
    for short, column in [("price", price), ("area", "LivingArea"), ("dom", "DaysOnMarket")]:
        parts.append(f"quantile_cont({column}, 0.25) AS {short}_q1, quantile_cont({column}, 0.75) AS {short}_q3")
    return f"SELECT {', '.join(parts)} FROM {source}"


def _flagged_sql(price: str, source: str, fences: str) -> str:
    tests = []
    for short, column in [("price", price), ("area", "LivingArea"), ("dom", "DaysOnMarket")]:
        width = f"1.5 * ({short}_q3 - {short}_q1)"
        tests.append(
            f"CASE WHEN {column} < {short}_q1 - {width} OR {column} > {short}_q3 + {width} "
            f"THEN 1 ELSE 0 END AS outlier_{short}_flag"
        )
    return f"""
SELECT *, greatest(outlier_price_flag, outlier_area_flag, outlier_dom_flag) AS outlier_any_flag,
  greatest(outlier_price_flag, outlier_area_flag, outlier_dom_flag, invalid_price_flag,
    invalid_area_flag, invalid_dom_flag, listing_after_close_flag, purchase_after_close_flag,
    coord_missing_flag) AS quality_issue_flag
FROM (SELECT r.*, {', '.join(tests)} FROM {source} r, {fences} f) t"""


_step("sold_fences", ["sold_rules"], _fences_sql("ClosePrice", "sold_rules"))
_step("listed_fences", ["listed_rules"], _fences_sql("ListPrice", "listed_rules"))
_step("sold_flagged", ["sold_rules", "sold_fences"],
      _flagged_sql("ClosePrice", "sold_rules", "sold_fences"))
_step("listed_flagged", ["listed_rules", "listed_fences"],
      _flagged_sql("ListPrice", "listed_rules", "listed_fences"))
_step("sold_clean", ["sold_flagged"], """
SELECT * REPLACE (CASE WHEN close_to_original_list_ratio BETWEEN 0.5 AND 2.0
  THEN close_to_original_list_ratio END AS close_to_original_list_ratio)
FROM sold_flagged WHERE outlier_any_flag = 0""")
_step("listed_clean", ["listed_flagged"], "SELECT * FROM listed_flagged WHERE outlier_any_flag = 0")

_step("rates", [], """
SELECT cast(DATE '1995-01-01' + to_months(cast(event_id % 60 AS int)) AS date) AS date, value FROM events""")
_step("rates_monthly", ["rates"], """
SELECT strftime(date, '%Y-%m') AS yr_mo, avg(value) AS rate_30yr_fixed FROM rates GROUP BY 1""")

_step("monthly_market", ["sold_clean"], """
SELECT yr_mo, count(ClosePrice) AS closed_sales, median(ClosePrice) AS median_close_price,
  avg(ClosePrice) AS avg_close_price, median(price_per_sqft) AS median_price_per_sqft,
  avg(DaysOnMarket) AS avg_dom, median(DaysOnMarket) AS median_dom,
  avg(close_to_original_list_ratio) AS avg_close_to_orig_ratio, avg(price_ratio) AS avg_price_ratio
FROM sold_clean WHERE yr_mo IS NOT NULL GROUP BY yr_mo""")
_step("monthly_new_listings", ["listed_clean"], """
SELECT yr_mo, count(ListPrice) AS new_listings, median(ListPrice) AS median_list_price,
  median(list_price_per_sqft) AS median_list_per_sqft
FROM listed_clean WHERE yr_mo IS NOT NULL GROUP BY yr_mo""")
_step("county_kpi", ["sold_clean"], """
SELECT CountyOrParish AS market, yr_mo, count(*) AS closed_sales, median(ClosePrice) AS median_close_price,
  median(DaysOnMarket) AS median_dom, median(price_per_sqft) AS median_price_per_sqft,
  avg(close_to_original_list_ratio) AS avg_close_to_orig_ratio
FROM sold_clean WHERE CountyOrParish IS NOT NULL AND yr_mo IS NOT NULL GROUP BY 1, 2""")
_step("county_new", ["listed_clean"], """
SELECT CountyOrParish AS market, yr_mo, count(*) AS new_listings FROM listed_clean
WHERE CountyOrParish IS NOT NULL AND yr_mo IS NOT NULL GROUP BY 1, 2""")


def compose(final: str, *needs: str, **extra: str) -> str:
    """A statement with every step that ``needs`` reaches, then ``extra``
    steps in order, then ``final``."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for before in STEPS[name][0]:
                visit(before)
            order.append(name)

    for name in needs:
        visit(name)
    parts = [f"{name} AS ({STEPS[name][1].strip()})" for name in order]
    parts += [f"{name} AS ({body.strip()})" for name, body in extra.items()]
    return (f"WITH {', '.join(parts)}\n" if parts else "") + final.strip()
