"""The two feeds step by step, from raw rows to the clean tables.

The chain is lazy up to the fences. From there on a table is read several
times, so the columns a report needs are staged first: one join of the source
tables, then cheap column scans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from parcelmill.constants import (
    DATE_FLAGS, GEO_FLAGS, LISTED_OUTLIERS, SOLD_OUTLIERS, VALUE_FLAGS,
)
from parcelmill.operators.clean import add_rule_flags, homes_only
from parcelmill.operators.features import guard_ratio, listed_features, sold_features
from parcelmill.operators.outliers import add_outlier_flags, add_quality_flag, clean_iqr
from parcelmill.plans.views import listed_rows, sold_rows
from parcelmill.session import stage

_RULES = [*VALUE_FLAGS, *DATE_FLAGS, *GEO_FLAGS]


def sold(spark: SparkSession, folder: str) -> DataFrame:
    return sold_features(homes_only(sold_rows(spark, folder)))


def listed(spark: SparkSession, folder: str) -> DataFrame:
    return listed_features(homes_only(listed_rows(spark, folder)))


def sold_staged(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    return stage(sold(spark, folder).select(*columns), "sold")


def listed_staged(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    return stage(listed(spark, folder).select(*columns), "listed")


def flag_sold(rows: DataFrame) -> DataFrame:
    return add_quality_flag(add_outlier_flags(rows, SOLD_OUTLIERS))


def flag_listed(rows: DataFrame) -> DataFrame:
    return add_quality_flag(add_outlier_flags(rows, LISTED_OUTLIERS))


def sold_flagged(spark: SparkSession, folder: str, columns: Sequence[str] = ()) -> DataFrame:
    """All sales with every flag, and the asked columns."""
    wanted = list(dict.fromkeys([*columns, *SOLD_OUTLIERS, *_RULES]))
    return flag_sold(stage(add_rule_flags(sold(spark, folder)).select(*wanted), "sold-rules"))


def listed_flagged(spark: SparkSession, folder: str, columns: Sequence[str] = ()) -> DataFrame:
    wanted = list(dict.fromkeys([*columns, *LISTED_OUTLIERS, *_RULES]))
    rows = add_rule_flags(listed(spark, folder), price="ListPrice")
    return flag_listed(stage(rows.select(*wanted), "listed-rules"))


def sold_clean(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    """Sales inside the fences, with the close / original ratio guarded."""
    wanted = list(dict.fromkeys([*columns, *SOLD_OUTLIERS]))
    rows = add_outlier_flags(sold_staged(spark, folder, wanted), SOLD_OUTLIERS)
    kept = clean_iqr(rows)
    if "close_to_original_list_ratio" in wanted:
        kept = guard_ratio(kept)
    return kept.select(*columns)


def listed_clean(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    wanted = list(dict.fromkeys([*columns, *LISTED_OUTLIERS]))
    rows = add_outlier_flags(listed_staged(spark, folder, wanted), LISTED_OUTLIERS)
    return clean_iqr(rows).select(*columns)
