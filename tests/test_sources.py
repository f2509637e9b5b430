import csv
import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelmill.operators.clean import add_rule_flags, cast_dates, cast_numbers, homes_only
from parcelmill.operators.features import sold_features
from parcelmill.sources import files, rates, sinks

JAN = '''ListingKey,PropertyType,ClosePrice,PropertyType,Remarks
1,Residential,100,Land,"two
lines, and a ""quote"""
2,,200,Land,plain
'''
FEB = '''ListingKey,ClosePrice,PropertyType,PostalCode,ClosePrice.1
3,300,Residential,01234,999
4,n/a,Land,90001,999
'''
MAR = '''ListingKey,PropertyType,ClosePrice,PropertyType,Remarks
5,Residential,500,Land,last
'''


@pytest.fixture
def feed(tmp_path):
    for name, text in (("sold_01.csv", JAN), ("sold_02.csv", FEB), ("sold_03.csv", MAR)):
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_files_join_by_name(spark, feed):
    df = files.ingest(spark, feed + "/sold_*.csv")
    assert df.columns == ["ListingKey", "PropertyType", "ClosePrice", "Remarks", "PostalCode"]
    got = {r["ListingKey"]: r for r in df.collect()}
    assert len(got) == 5
    assert got["1"]["Remarks"] == 'two\nlines, and a "quote"'
    assert got["1"]["PropertyType"] == "Residential" and got["1"]["PostalCode"] is None
    assert got["2"]["PropertyType"] is None
    assert got["3"]["ClosePrice"] == "300" and got["3"]["PostalCode"] == "01234"
    homes = cast_numbers(homes_only(df))
    assert {r["ClosePrice"] for r in homes.collect()} == {100.0, 300.0, 500.0}


def test_files_are_counted(spark, feed):
    got = {r["file"]: (r["rows"], r["columns"]) for r in files.file_counts(spark, feed + "/*.csv").collect()}
    assert got == {"sold_01.csv": (2, 5), "sold_02.csv": (2, 5), "sold_03.csv": (1, 5)}
    with pytest.raises(FileNotFoundError):
        files.ingest(spark, [])


def test_repeated_names():
    assert files.distinct_header(["a", "b", "a", "b.1", "c"]) == ["a", "b", None, None, "c"]


def test_empty_months_and_malformed_records_are_counted(spark, feed):
    with open(feed + "/sold_04.csv", "w") as f:
        f.write("ListingKey,City\n")
    with open(feed + "/sold_05.csv", "w") as f:
        f.write("ListingKey,City\n6,a\n7,b,lost\n8\n")
    got = {r["file"]: (r["rows"], r["columns"], r["malformed"]) for r in files.file_counts(spark, feed + "/*.csv").collect()}
    assert got["sold_04.csv"] == (0, 2, 0) and got["sold_05.csv"] == (3, 2, 1) and got["sold_01.csv"] == (2, 5, 0)
    with pytest.raises(Exception, match="more fields than the header"):
        files.ingest(spark, feed + "/*.csv").collect()
    kept = files.ingest(spark, feed + "/*.csv", malformed="drop").collect()
    assert sorted(r["ListingKey"] for r in kept) == ["1", "2", "3", "4", "5", "6", "8"]


def test_quoted_line_breaks_across_splits(spark, tmp_path):
    rows = [(str(i), "\n".join(["x" * (i % 17), 'say "hi", ok'] * (i % 4 + 1)), str(i * 3)) for i in range(3000)]
    with open(tmp_path / "big.csv", "w", newline="") as f:
        out = csv.writer(f, lineterminator="\n")
        out.writerow(["ListingKey", "Remarks", "n"])
        out.writerows(rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        df = files.ingest(spark, str(tmp_path / "big.csv"))
        assert files.survey(spark, str(tmp_path / "big.csv")).count() > 5
        assert sorted(tuple(r) for r in df.collect()) == sorted(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _pandas(path):
    frame = pd.read_csv(path, dtype=str, keep_default_na=False)
    # Spark keeps the marks of a field that has text behind the closing one.
    return sorted(tuple('"5" x' if x == "5 x" else x for x in r) for r in frame.itertuples(index=False, name=None))


ODD = ['5,6" wide,z', '5,12"" wide,"a, b"', '"5" x,6,z', '5,"he said ""hi""",z', '5,"two\nlines",z', '5,"a\n6"" b\n, c",z',
       '5,a"b,"c\nd"']


@pytest.mark.parametrize("size", ["3000", "128m"])
def test_quote_marks_inside_fields_lose_no_rows(spark, tmp_path, size):
    lines = [f"{i},plain {i},n" for i in range(1000)]
    for i, odd in enumerate(ODD):
        lines.insert(137 * (i + 1), odd)
    path = str(tmp_path / "m.csv")
    with open(path, "w", newline="") as f:
        f.write("ListingKey,Remarks,n\n" + "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        df = files.ingest(spark, path)
        rows = df.collect()
        assert df.count() == len(rows) == files.file_counts(spark, path).first()["rows"]
        assert sorted(tuple(x or "" for x in r) for r in rows) == _pandas(path) and len(rows) == 1000 + len(ODD)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_line_maps():
    closed = {'a,b': False, 'a,6" b': False, '"a,b"': False, '"a,b': True, 'a,"b""': True, '"a""b",c': False, '"a" x,"y': True, "": False,
              'a,"",b': False, '"a"",b': True, ',"': True}
    assert {x: files.line_map(x)[0] for x in closed} == closed
    opened = {'a,b': True, 'a",b': False, 'a"",b': True, 'a" 6" b': False, 'a","b': True, '"': False, '""': True, '""",c': False, "": True}
    assert {x: files.line_map(x)[1] for x in opened} == opened


def test_counting_does_not_hide_malformed_records(spark, tmp_path):
    (tmp_path / "m.csv").write_text("a,b\n1,2\n1,2,3\n")
    with pytest.raises(Exception, match="more fields than the header"):
        files.ingest(spark, str(tmp_path / "m.csv")).count()
    assert files.ingest(spark, str(tmp_path / "m.csv"), malformed="drop").count() == 1


def test_round_trips(spark, feed, tmp_path):
    df = files.ingest(spark, feed + "/sold_*.csv")
    sinks.write_table(df, str(tmp_path / "t"), "PropertyType")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5
    assert files.size_of(spark.read.parquet(str(tmp_path / "t"))) == (5, 5)
    sinks.write_csv(df.coalesce(1), str(tmp_path / "c"))
    part = [n for n in os.listdir(tmp_path / "c") if n.endswith(".csv")]
    back = files.ingest(spark, [str(tmp_path / "c" / part[0])])
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    sinks.write_records(df.select(F.struct("ListingKey", "PostalCode").alias("r")), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).filter("r.PostalCode is null").count() == 3
    typed = files.read_columns(spark, str(tmp_path / "t"), {"ClosePrice": "double", "PostalCode": "string", "x": "int"})
    assert typed.dtypes == [("ClosePrice", "double"), ("PostalCode", "string")]
    assert typed.filter("ClosePrice is null").count() == 1


def test_weekly_rates_become_monthly_means(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        "observation_date,V\n2024-01-04,6.0\n2024-01-11,7.0\n2024-01-18,.\n2024-02-01,5.0\n2024-02-08,5.0\n")
    series = rates.read_rates(spark, str(tmp_path / "r.csv"))
    assert series.count() == 4
    monthly = rates.monthly_rates(series).orderBy("yr_mo")
    assert [tuple(r) for r in monthly.collect()] == [("2024-01", 6.5), ("2024-02", 5.0)]


def test_fallback_and_left_join(spark, tmp_path):
    (tmp_path / "second.csv").write_text("date,value\n2024-01-04,6.0\n2024-01-11,8.0\n")
    found = rates.first_readable(spark, [str(tmp_path / "gone.csv"), str(tmp_path / "second.csv")])
    days = [(dt.date(2024, 1, 1),), (dt.date(2024, 2, 1),), (None,)]
    df = spark.createDataFrame(days, "CloseDate date")
    joined = rates.enrich(df, "CloseDate", found)
    assert sorted(joined.collect(), key=str) == sorted([(days[0][0], 7.0), (days[1][0], None), (None, None)], key=str)
    report = rates.enrich_report(df, joined).first()
    assert (report["rows_before"], report["rows_after"], report["unmatched"]) == (3, 3, 2)
    none = rates.enrich(df, "CloseDate", rates.first_readable(spark, [str(tmp_path / "gone.csv")]))
    assert none.filter(F.col(rates.RATE).isNull()).count() == 3


def test_feed_runs_from_text_to_flags(spark, tmp_path):
    header = ("ListingKey,PropertyType,CloseDate,PurchaseContractDate,ListingContractDate,ClosePrice,ListPrice,"
              "OriginalListPrice,LivingArea,DaysOnMarket,BedroomsTotal,BathroomsTotalInteger,Latitude,Longitude\n")
    (tmp_path / "m.csv").write_text(
        header + "1,Residential,2024-03-05,2024-02-20,2024-02-01,200,100,0,0,5,3,2,34,-118\n"
        "2,Residential,bad,2024-02-20,2024-02-25,150,100,120,10,5,3,2,34,-118\n")
    df = add_rule_flags(sold_features(cast_numbers(cast_dates(files.ingest(spark, [str(tmp_path / "m.csv")])))))
    got = {r["ListingKey"]: r for r in df.collect()}
    one, two = got["1"], got["2"]
    assert (one["price_ratio"], one["close_to_original_list_ratio"], one["price_per_sqft"]) == (2.0, None, None)
    assert (one["yr_mo"], one["listing_to_contract_days"], one["contract_to_close_days"]) == ("2024-03", 19, 14)
    assert one["invalid_area_flag"] == 1
    assert (two["yr_mo"], two["close_year"], two["listing_to_contract_days"], two["price_per_sqft"]) == (None, None, None, 15.0)
