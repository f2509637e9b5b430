import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelmill.operators import marts
from parcelmill.plans import stages
from parcelmill.plans.build import TABLES, build_tables
from parcelmill.plans.views import listed_rows, rate_rows, sold_rows
from parcelmill.sources.sinks import write_csv

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_files_to_marts_equals_the_direct_way(spark, tmp_path):
    year = F.year("CloseDate")
    sales = sold_rows(spark, FOLDER)
    # Two files with different columns; the second lacks one.
    write_csv(sales.filter(year < 1998).coalesce(1), str(tmp_path / "sold_a"))
    write_csv(sales.filter(year >= 1998).drop("MLSAreaMajor").coalesce(1), str(tmp_path / "sold_b"))
    write_csv(listed_rows(spark, FOLDER).coalesce(1), str(tmp_path / "listed"))
    write_csv(rate_rows(spark, FOLDER).coalesce(1), str(tmp_path / "rates"))
    made = build_tables(
        spark, str(tmp_path / "sold_*" / "*.csv"), str(tmp_path / "listed" / "*.csv"),
        [str(tmp_path / "missing.csv"), str(tmp_path / "rates")], str(tmp_path / "out"))
    assert set(made) == set(TABLES)
    flagged = made["sold_flagged"]
    # 95 % empty, so it is dropped; the rate is there.
    assert "LotSizeAcres" not in flagged.columns and flagged.filter("rate_30yr_fixed > 0").count() > 0
    direct = stages.sold_flagged(spark, FOLDER, ["ListingKey"])
    def totals(df):
        return df.agg(F.count(F.lit(1)), F.sum("outlier_any_flag"), F.sum("quality_issue_flag"),
                      F.sum("coord_out_of_state_flag")).first()
    assert totals(flagged) == totals(direct)

    def rows(df):
        return df.toPandas().sort_values("yr_mo").reset_index(drop=True)

    columns = ["yr_mo", "ClosePrice", "price_per_sqft", "DaysOnMarket", "close_to_original_list_ratio", "price_ratio"]
    mart = rows(marts.monthly_market(stages.sold_clean(spark, FOLDER, columns)))
    pd.testing.assert_frame_equal(rows(made["monthly_market"])[mart.columns], mart, rtol=1e-9)
    assert made["sold_extract"].count() == made["monthly_market"].agg(F.sum("closed_sales")).first()[0]
    assert dict(made["sold_flagged"].dtypes)["PostalCode"] == "string"
