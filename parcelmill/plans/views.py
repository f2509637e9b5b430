"""The home-sales tables, derived from the driver tables.

``sold_rows`` and ``listed_rows`` read the star-schema Parquet files and give
them the home-sales column names, with null, zero, negative and extreme values
in known places. Nothing is broadcast by hint: Spark compares each side with
its own size threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmill.session import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sold_rows(spark: SparkSession, folder: str) -> DataFrame:
    lines = spread(table(spark, folder, "lineitem"), "l_orderkey")
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer")
    nations = table(spark, folder, "nation")
    suppliers = table(spark, folder, "supplier")
    parts = table(spark, folder, "part")
    rows = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("listed_on", F.col("o_orderdate").cast("date"))
        .withColumn("closed_on", F.col("l_shipdate").cast("date"))
        .withColumn("dom0", F.datediff("closed_on", "listed_on"))
    )
    return rows.selectExpr(
        "concat(l_orderkey, '-', l_linenumber) AS ListingKey",
        "CASE l_returnflag WHEN 'R' THEN 'Land' WHEN 'A' THEN 'Lease' ELSE 'Residential' END"
        " AS PropertyType",
        "p_type AS PropertySubType",
        "nullif(n_name, 'NATION_3') AS CountyOrParish",
        "c_mktsegment AS City",
        "p_brand AS PostalCode",
        "concat('AREA_', n_regionkey) AS MLSAreaMajor",
        "o_orderstatus AS MlsStatus",
        "s_name AS ListOfficeName",
        "c_name AS ListAgentFullName",
        "nullif(concat('OFFICE_', c_custkey % 40), 'OFFICE_11') AS BuyerOfficeName",
        "concat('AGENT_', c_custkey % 90) AS BuyerAgentFullName",
        "closed_on AS CloseDate",
        "CASE WHEN l_linenumber = 6 THEN NULL ELSE date_add(listed_on, cast(l_quantity AS int)) END"
        " AS PurchaseContractDate",
        "listed_on AS ListingContractDate",
        "date_add(listed_on, 5) AS ContractStatusChangeDate",
        "CASE WHEN l_linenumber = 7 AND l_quantity = 1 THEN 0D"
        " ELSE l_extendedprice * (1 - l_discount) END"
        " * CASE WHEN dom0 % 97 = 0 THEN 6 ELSE 1 END AS ClosePrice",
        "l_extendedprice AS ListPrice",
        "nullif(l_extendedprice * CASE WHEN l_partkey % 400 = 7 THEN 0.001D ELSE 1 + l_tax END,"
        " l_extendedprice) AS OriginalListPrice",
        "cast((nullif(p_size, 13) - 1) * CASE WHEN dom0 % 83 = 0 THEN 7 ELSE 1 END AS double)"
        " AS LivingArea",
        "cast(CASE WHEN l_orderkey % 20 = 0 THEN p_retailprice * 5 / 43560 END AS double)"
        " AS LotSizeAcres",
        "p_retailprice * 5 AS LotSizeSquareFeet",
        "p_size % 6 - 1 AS BedroomsTotal",
        "(p_size + 1) % 5 - 1 AS BathroomsTotalInteger",
        "CASE WHEN dom0 % 89 = 0 THEN dom0 * 8 ELSE dom0 END AS DaysOnMarket",
        "cast(nullif(1950 + p_partkey % 70, 1983) AS int) AS YearBuilt",
        "p_size % 4 AS GarageSpaces",
        "CASE l_linenumber % 3 WHEN 0 THEN true WHEN 1 THEN false END AS PoolPrivateYN",
        "l_quantity > 25 AS FireplaceYN",
        "l_discount > 0.05D AS ViewYN",
        "l_tax = 0 AS NewConstructionYN",
        "CASE WHEN l_suppkey % 17 = 3 THEN NULL ELSE 33 + 9 * (s_acctbal / 10000) END AS Latitude",
        "CASE l_suppkey % 19 WHEN 4 THEN 0D WHEN 5 THEN 118D WHEN 6 THEN -100D"
        " ELSE -124 + 9 * (c_acctbal / 10000) END AS Longitude",
    )


def listed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The listing feed: the same rows, seen from their listing date."""
    return sold_rows(spark, folder)


def rate_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(date, value) series with several points per month, 1995-01 to 1999-12."""
    return table(spark, folder, "events").selectExpr(
        "add_months(DATE'1995-01-01', cast(event_id % 60 AS int)) AS date", "value"
    )
