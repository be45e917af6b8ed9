import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from star_marts import schemas
from star_marts.sources import apply_types, read_by_header, read_positional, read_typed
from star_marts.sources.landing import normalize_name

SMALL = schemas.strings(["a", "b", "c"])


@pytest.fixture
def write(tmp_path):
    def _write(text, name="file.csv"):
        path = tmp_path / name
        path.write_text(text)
        return str(path)

    return _write


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_quotes_header_and_positions(spark, write):
    path = write('x,y,z\n1,"a, b",3\n2,"say ""hi""",\n3,"",z\n')
    got = read_positional(spark, path, SMALL).good
    assert got.columns == ["a", "b", "c"]
    assert rows(got, "a") == [("1", "a, b", "3"), ("2", 'say "hi"', None), ("3", "", "z")]


def test_newline_inside_quotes(spark, write):
    path = write('x,y,z\n1,"two\nlines",3\n4,5,6\n')
    got = read_positional(spark, path, SMALL, multiline=True).good
    assert rows(got, "a") == [("1", "two\nlines", "3"), ("4", "5", "6")]


def test_ragged_rows_are_rejected_by_position(spark, write):
    path = write("x,y,z\n1,2,3\n1,2\n1,2,3,4\n5,6,7\n")
    landed = read_positional(spark, path, SMALL)
    assert rows(landed.good, "a") == [("1", "2", "3"), ("5", "6", "7")]
    assert sorted(r.raw_record for r in landed.rejected.collect()) == ["1,2", "1,2,3,4"]


def test_counts_agree_with_listings(spark, write):
    """Reading no column, or one, must not change which rows are rejected."""
    path = write("x,y,z\n1,2,3\n1,2\n1,2,3,4\n5,6,7\n")
    landed = read_positional(spark, path, SMALL)
    assert landed.good.count() == 2
    assert landed.rejected.count() == 2
    assert landed.good.select("a").distinct().count() == 2
    assert landed.rejected.groupBy("reason").count().collect()[0]["count"] == 2


def test_typed_load_and_quarantine(spark, write):
    header = "session_id,station_id,session_date,kwh_delivered,duration_minutes,revenue_usd\n"
    path = write(
        header
        + "1,10,2025-01-02,5.25,30,2.10\n"
        + "2,10,02/30/2025,5.25,30,2.10\n"
        + "3,x,2025-01-02,5.25,30,2.10\n"
        + "4,10,2025-01-02,,30,99999999999\n"
        + "5,10,1/3/2025,,,\n"
        + "6,10,2025-01-02\n"
    )
    landed = read_typed(spark, path, schemas.TYPED_SESSIONS)
    assert landed.good.schema.fieldNames() == schemas.TYPED_SESSIONS.fieldNames()
    assert [f.dataType for f in landed.good.schema] == [f.dataType for f in schemas.TYPED_SESSIONS]
    assert rows(landed.good, "session_id") == [
        (1, 10, dt.date(2025, 1, 2), Decimal("5.25"), 30, Decimal("2.10")),
        (5, 10, dt.date(2025, 1, 3), None, None, None),
    ]
    why = {r.session_id: r.reason for r in landed.rejected.collect()}
    assert why == {
        "2": "bad session_date", "3": "bad station_id", "4": "bad revenue_usd", "6": "malformed row",
    }
    assert landed.good.count() + landed.rejected.count() == 6


def test_every_bad_column_is_named(spark):
    df = spark.createDataFrame([("x", "y", "z")], SMALL)
    schema = schemas.typed(a=schemas.INT, b=schemas.DATE, c=schemas.STRING)
    assert apply_types(df, schema).rejected.first().reason == "bad a, b"


def test_by_header_ignores_case_order_and_punctuation(spark, write):
    path = write("City,Station Name,extra,zip\n  Troy ,NULL,9,null\n, Main St,9,12180\n")
    got = read_by_header(spark, path, schemas.RAW_STATION_FEED)
    assert got.columns == schemas.RAW_STATION_FEED.fieldNames()
    assert rows(got.select("STATIONNAME", "ZIP", "CITY", "STATE"), F.col("CITY").asc_nulls_last()) == [
        (None, None, "Troy", None), ("Main St", "12180", None, None),
    ]


def test_by_header_tolerates_ragged_rows(spark, write):
    path = write("id,city\n1\n2,Troy,surplus\n")
    assert rows(read_by_header(spark, path), "ID") == [("1", None), ("2", "Troy")]


def test_files_with_different_headers(spark, write):
    one = write("id,city\n1,Troy\n", "one.csv")
    two = write("City,State,ID\nRome,NY,2\n", "two.csv")
    got = read_by_header(spark, [one, two])
    assert rows(got.select("ID", "CITY", "STATE"), "ID") == [("1", "Troy", None), ("2", "Rome", "NY")]


def test_one_folder_of_files_with_different_headers(spark, tmp_path):
    (tmp_path / "with blank").mkdir()
    for name, text in {
        "a.csv": "ID,ZIP,CITY\n1,10001,TROY\n", "b.csv": "CITY,ID,ZIP\nROME,2,10002\n",
        "c.csv": "ID,CITY\n3,OVID\n", "d.csv": "ID,ZIP,CITY\n4,10004,AVON\n",
    }.items():
        (tmp_path / "with blank" / name).write_text(text)
    got = read_by_header(spark, str(tmp_path / "with blank"), schemas.strings(["ID", "ZIP", "CITY"]))
    assert rows(got, "ID") == [
        ("1", "10001", "TROY"), ("2", "10002", "ROME"), ("3", None, "OVID"), ("4", "10004", "AVON"),
    ]


def test_names():
    assert normalize_name("EV Level1 EVSE Num") == "EVLEVEL1EVSENUM"
    assert [normalize_name(n) for n in ("Station Name", "station_name")] == ["STATIONNAME"] * 2
