"""From monthly files to the finished tables, as one run.

    build_tables(spark, sold="in/sold_*.csv", listed="in/listed_*.csv",
                 rates=["in/rates.csv"], out="/shared/market")

Written tables: ``sold_flagged`` and ``listed_flagged`` (all rows with every
flag; the clean set is ``outlier_any_flag = 0``), the lean extracts
``sold_extract`` and ``listed_extract``, and the marts ``monthly_market`` and
``monthly_new_listings``. All are Parquet; the row-level tables are partitioned
by month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from parcelmill.constants import LISTED_OUTLIERS, SOLD_OUTLIERS
from parcelmill.operators import clean, marts
from parcelmill.operators.features import (
    guard_ratio, listed_extract, listed_features, sold_extract, sold_features,
)
from parcelmill.operators.outliers import add_outlier_flags, add_quality_flag, clean_iqr
from parcelmill.session import stage, staging
from parcelmill.sources.files import ingest
from parcelmill.sources.rates import enrich, first_readable
from parcelmill.sources.sinks import write_table

TABLES = ["sold_flagged", "listed_flagged", "sold_extract", "listed_extract", "monthly_market",
          "monthly_new_listings"]


def _cleaned(raw: DataFrame, day: str, rates: DataFrame | None, name: str) -> DataFrame:
    """Homes with the rate of the month, dates cast, sparse columns gone and
    numbers cast. Staged, because the null shares need a pass of their own."""
    homes = enrich(clean.cast_dates(clean.homes_only(raw)), day, rates)
    return clean.cast_numbers(clean.drop_sparse(stage(homes, name)))


def flag_feed(rows: DataFrame, price: str, outliers: dict[str, str]) -> DataFrame:
    ruled = clean.add_rule_flags(rows, price)
    return add_quality_flag(add_outlier_flags(ruled, outliers))


def build_tables(spark: SparkSession, sold: Sequence[str] | str, listed: Sequence[str] | str,
                 rates: Sequence[str], out: str) -> dict[str, DataFrame]:
    """Write all tables below ``out`` and return them as scans."""
    with staging(spark):
        series = first_readable(spark, rates)
        done: dict[str, DataFrame] = {}

        def put(name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
            write_table(df, f"{out}/{name}", partition_by)
            done[name] = spark.read.parquet(f"{out}/{name}")
            return done[name]

        sales = _cleaned(ingest(spark, sold), "CloseDate", series, "sold-feed")
        flagged = put("sold_flagged", flag_feed(sold_features(sales), "ClosePrice", SOLD_OUTLIERS), "yr_mo")
        kept = guard_ratio(clean_iqr(flagged))
        put("sold_extract", sold_extract(kept), "yr_mo")
        put("monthly_market", marts.monthly_market(kept))

        offers = _cleaned(ingest(spark, listed), "ListingContractDate", series, "listed-feed")
        flagged = put("listed_flagged", flag_feed(listed_features(offers), "ListPrice", LISTED_OUTLIERS), "yr_mo")
        kept = clean_iqr(flagged)
        put("listed_extract", listed_extract(kept), "yr_mo")
        put("monthly_new_listings", marts.monthly_new_listings(kept))
    return done
