import datetime as dt

import pytest
from pyspark.sql import functions as F

from parcelmill.constants import DATE_FLAGS, GEO_FLAGS, QUALITY_FLAGS, VALUE_FLAGS
from parcelmill.functions import scalar
from parcelmill.operators import clean, features, outliers, profile


def column(df, name):
    return [r[name] for r in df.select(name).collect()]


def test_yes_no_flag_in_three_types(spark):
    text = ["True", "true", "False", "1", "0", " YES ", "y", "T", "maybe", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(text)], "i int, v string").orderBy("i")
    assert column(df.select(scalar.yes_no_flag("v", "string").alias("f")), "f") == [1, 1, 0, 1, 0, 1, 1, 1, 0, 0]
    df = spark.createDataFrame([(1.0,), (0.0,), (None,), (2.0,)], "v double")
    assert column(df.select(scalar.yes_no_flag("v", "double").alias("f")), "f") == [1, 0, 0, 1]
    df = spark.createDataFrame([(True,), (False,), (None,)], "v boolean")
    assert column(df.select(scalar.yes_no_flag("v", "boolean").alias("f")), "f") == [1, 0, 0]


def test_signed_percent(spark):
    df = spark.createDataFrame([(1.4,), (-1.5,), (0.0,), (None,)], "v double")
    assert column(df.select(scalar.signed_percent("v").alias("t")), "t") == ["+1.4%", "-1.5%", "+0%", "n/a"]


def test_lenient_casts_ratio_and_months(spark):
    df = spark.createDataFrame(
        [("2024-03-09", "1.5", 4.0, 0.0), ("soon", "NaN", 0.0, 0.0), (None, "x", 1.0, 2.0)],
        "d string, n string, a double, b double")
    out = df.select(
        scalar.lenient_date("d").alias("d"), scalar.lenient_double("n").alias("n"),
        scalar.ratio("a", "b").alias("r"), scalar.month_text(scalar.lenient_date("d")).alias("m"),
        scalar.is_month_text("d").alias("shape"))
    assert column(out, "d") == [dt.date(2024, 3, 9), None, None]
    assert column(out, "n") == [1.5, None, None]
    assert column(out, "r") == [None, None, 0.5]
    assert column(out, "m") == ["2024-03", None, None]
    one = spark.createDataFrame([("2024-01", "2023-12")], "a string, b string")
    assert one.select(scalar.month_index("a") - scalar.month_index("b")).first()[0] == 1


HOUSE = {
    "ClosePrice": 100.0, "ListPrice": 90.0, "LivingArea": 10.0, "DaysOnMarket": 5, "BedroomsTotal": 2,
    "BathroomsTotalInteger": 1, "Latitude": 34.0, "Longitude": -118.0,
    "ListingContractDate": dt.date(2024, 1, 1), "PurchaseContractDate": dt.date(2024, 1, 10),
    "CloseDate": dt.date(2024, 2, 1),
}
SCHEMA = ("ClosePrice double, ListPrice double, LivingArea double, DaysOnMarket int, BedroomsTotal int, "
          "BathroomsTotalInteger int, Latitude double, Longitude double, ListingContractDate date, "
          "PurchaseContractDate date, CloseDate date")


def flags_of(spark, price="ClosePrice", **changes):
    row = {**HOUSE, **changes}
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    df = spark.createDataFrame([tuple(row[n] for n in names)], SCHEMA)
    flagged = clean.add_rule_flags(df, price).first().asDict()
    return {f for f in VALUE_FLAGS + DATE_FLAGS + GEO_FLAGS if flagged[f] == 1}


@pytest.mark.parametrize("changes, wanted", [
    ({}, set()),
    ({"ClosePrice": 0.0}, {"invalid_price_flag"}),
    ({"ClosePrice": None, "LivingArea": None, "DaysOnMarket": None}, set()),
    ({"LivingArea": 0.0, "DaysOnMarket": -1}, {"invalid_area_flag", "invalid_dom_flag"}),
    ({"DaysOnMarket": 0, "BedroomsTotal": 0}, set()),
    ({"BedroomsTotal": -1, "BathroomsTotalInteger": -1}, {"invalid_beds_flag", "invalid_baths_flag"}),
    ({"CloseDate": dt.date(2023, 12, 31)}, set(DATE_FLAGS)),
    ({"CloseDate": dt.date(2024, 1, 5)}, {"purchase_after_close_flag", "negative_timeline_flag"}),
    ({"CloseDate": dt.date(2024, 1, 10)}, set()),
    ({"Latitude": None}, {"coord_missing_flag"}),
    ({"Latitude": None, "Longitude": 5.0}, {"coord_missing_flag", "coord_positive_lon_flag"}),
    ({"Latitude": 0.0}, {"coord_zero_flag"}),
    ({"Longitude": 118.0}, {"coord_positive_lon_flag", "coord_out_of_state_flag"}),
    ({"Longitude": -100.0}, {"coord_out_of_state_flag"}),
    ({"Latitude": 32.5, "Longitude": -114.1}, set()),
])
def test_rule_flags(spark, changes, wanted):
    assert flags_of(spark, **changes) == wanted


def test_listing_price_rule(spark):
    assert flags_of(spark, "ListPrice", ListPrice=-1.0) == {"invalid_price_flag"}


def test_sparse_columns_are_strictly_above_the_share(spark):
    rows = [(1, None, None if i else "x") for i in range(10)]
    df = spark.createDataFrame(rows, "a int, empty string, ninety string")
    assert clean.sparse_columns(df) == ["empty"]
    assert clean.drop_sparse(df).columns == ["a", "ninety"]


def test_cast_order_counts_bad_dates_but_not_bad_numbers(spark):
    rows = [("bad", "bad", i) for i in range(10)]
    df = spark.createDataFrame(rows, "CloseDate string, ClosePrice string, i int")
    assert clean.drop_sparse(clean.cast_dates(df)).columns == ["ClosePrice", "i"]


def test_cast_reports(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "1"), ("bad", "x"), (None, None)], "CloseDate string, ClosePrice string")
    assert clean.date_cast_report(df).first().asDict() == {"field": "CloseDate", "nulls": 2, "coerced": 1}
    assert clean.number_cast_report(df).first().asDict() == {
        "field": "ClosePrice", "type_before": "string", "type_after": "double", "nulls": 2, "coerced": 1}


def test_fence_table_counts_hits_against_its_own_quartiles(spark):
    values = [float(v) for v in (0, 1, 2, 3, 4, 5, 6, 7, 8)] * 20 + [99.0, -50.0, None]
    df = spark.createDataFrame([(v,) for v in values], "ClosePrice double")
    fields = {"ClosePrice": "outlier_price_flag"}
    row = outliers.fence_table(df, fields).first()
    flagged = outliers.add_outlier_flags(df, fields).filter("outlier_price_flag = 1").count()
    assert (row["q1"], row["q3"], row["hits"], row["min"], row["max"]) == (2.0, 6.0, flagged, -50.0, 99.0)
    assert flagged == 2 and row["pct"] == pytest.approx(200 / len(values))
    empty = outliers.fence_table(df.limit(0), fields).first()
    assert (empty["q1"], empty["hits"], empty["pct"]) == (None, 0, None)


def test_fences_are_strict_and_quality_leaves_some_flags_out(spark):
    values = [float(v) for v in (0, 1, 2, 3, 4, 5, 6, 7, 8)]  # q1 2, q3 6, fence -4 to 12
    df = spark.createDataFrame([(v,) for v in [*values]], "ClosePrice double")
    bounds = outliers.fences(df, ["ClosePrice"])
    probe = spark.createDataFrame([(-4.0,), (-4.1,), (12.0,), (12.5,), (None,)], "ClosePrice double")
    flagged = outliers.add_outlier_flags(probe, {"ClosePrice": "outlier_price_flag"}, bounds)
    assert column(flagged, "outlier_price_flag") == [0, 1, 0, 1, 0]
    assert column(outliers.clean_iqr(flagged), "ClosePrice") == [-4.0, 12.0, None]
    assert not {"invalid_beds_flag", "invalid_baths_flag", "coord_zero_flag", "coord_positive_lon_flag",
                "coord_out_of_state_flag"} & set(QUALITY_FLAGS)
    assert outliers.clean_rate(probe).first()["clean_pct"] == 100.0


def test_band_guard_counts_values_only(spark):
    df = spark.createDataFrame([(0.5,), (2.0,), (2.1,), (None,), (0.1,)], "close_to_original_list_ratio double")
    assert features.guard_report(df).first().asDict() == {"rows": 5, "present": 4, "nulled": 2}
    assert column(features.guard_ratio(df), "close_to_original_list_ratio") == [0.5, 2.0, None, None, None]


def test_frequency_share_is_of_all_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    got = {r["value"]: (r["rows"], r["pct"]) for r in profile.frequency(df, "k").collect()}
    assert got == {"a": (2, 50.0), "b": (1, 25.0)}


def test_histogram_last_bin_and_flat_column(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 3, 10)] + [(None,)], "v double")
    rows = profile.histogram(df, "v", 5).orderBy("bin").collect()
    assert [r["rows"] for r in rows] == [2, 2, 0, 0, 1]
    assert (rows[0]["low"], rows[-1]["high"]) == (0.0, 10.0)
    flat = profile.histogram(spark.createDataFrame([(7.0,), (7.0,)], "v double"), "v", 4)
    assert [r["rows"] for r in flat.orderBy("bin").collect()] == [0, 0, 2, 0]
    empty = profile.histogram(df.filter("v > 99"), "v", 4)
    assert empty.count() == 0


def test_keep_last_and_duplicate_keys(spark):
    df = spark.createDataFrame(
        [("k", 1, "a"), ("k", 3, "c"), ("k", 2, "b"), ("m", 1, None)], "k string, o int, v string")
    got = {r["k"]: (r["o"], r["v"]) for r in profile.keep_last(df, ["k"], ["o"]).collect()}
    assert got == {"k": (3, "c"), "m": (1, None)}
    assert profile.duplicate_keys(df, "k").first().asDict() == {"duplicate_keys": 1, "surplus_rows": 2}


def test_preview_and_dtype_tally(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "i int, s string")
    assert [r["i"] for r in features.preview(df, ["i", "gone"], 1, ["i"]).collect()] == [1]
    assert {r["dtype"]: r["values"] for r in profile.dtype_tally(df).collect()} == {"int": 2, "string": 2}


def test_fill_medians_and_negative_spans(spark):
    df = spark.createDataFrame([("1",), ("3",), (None,), ("x",)], "v string")
    assert column(clean.fill_medians(df, ["v"]), "v") == [1.0, 3.0, 2.0, 2.0]
    spans = spark.createDataFrame([(dt.date(2024, 1, 5), dt.date(2024, 1, 1))], "a date, b date")
    row = spans.select(scalar.day_span("a", "b").alias("x"), scalar.day_span("b", "a").alias("y")).first()
    assert (row["x"], row["y"]) == (None, 4)
    assert spans.select(F.lit(1)).count() == 1
