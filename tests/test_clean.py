import datetime as dt
from decimal import ROUND_HALF_UP, Decimal, getcontext

import pytest
from pyspark.sql import functions as F

from star_marts import fixed_values as fixed
from star_marts.functions import (
    date_key,
    five_digit_code,
    half_up_ratio,
    label_by_members,
    money_text,
    norm_text,
    normalize_zip,
    not_blank,
    tier_label,
    try_date,
    try_number,
    try_us_date,
)


def values(spark, expression, inputs, to="string"):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, v {to}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_numbers_round_half_up_at_scale_zero(spark):
    texts = ["40.7128", "2.5", "-2.5", " 12 ", "abc", "", None, "1,200"]
    assert values(spark, try_number, texts) == [41, 3, -3, 12, None, None, None, None]


def test_numbers_keep_fractions_at_target_scale(spark):
    got = values(spark, lambda c: try_number(c, 10, 6), ["40.7128", "12345.5", "x"])
    assert got == [Decimal("40.712800"), None, None]


def test_dates(spark):
    texts = ["2024-01-05", "01/05/2024", "1/5/2024", "2024", "garbage", None]
    fifth = dt.date(2024, 1, 5)
    assert values(spark, try_date, texts) == [fifth, fifth, fifth, None, None, None]
    assert values(spark, try_us_date, texts) == [None, fifth, fifth, None, None, None]


def test_impossible_date_is_null(spark):
    assert values(spark, try_date, ["2023-02-29", "2/30/2023"]) == [None, None]


def test_zips_are_padded_and_cut(spark):
    texts = ["10001", "10001-1234", "501", "", "N/A", None]
    want = ["10001", "10001", "00501", "00000", "00000", None]
    assert values(spark, normalize_zip, texts) == want


def test_five_digit_code(spark):
    texts = ["ZCTA5 10001", "12", "123456", None]
    assert values(spark, five_digit_code, texts) == ["10001", None, "12345", None]


def test_text(spark):
    assert values(spark, norm_text, [" a b ", "  ", None]) == ["A B", "", None]
    assert values(spark, not_blank, ["x", "  ", None]) == [True, False, None]


def test_date_key(spark):
    assert values(spark, date_key, [dt.date(2025, 6, 1), None], "date") == [20250601, None]


def test_money_text(spark):
    got = values(spark, money_text, [Decimal("78453.50"), Decimal("999"), None], "decimal(12,2)")
    assert got == ["$78,454", "$999", None]


def test_ratio_guards_zero_and_rounds_half_up(spark):
    df = spark.createDataFrame(
        [(Decimal(1), Decimal(8)), (Decimal(1), Decimal(0)), (None, Decimal(1)), (Decimal(5), None)],
        "n decimal(10,0), d decimal(10,0)",
    )
    got = [r[0] for r in df.select(half_up_ratio(F.col("n"), F.col("d"), 2)).collect()]
    assert got == [Decimal("0.13"), None, None, None]


def test_ratio_of_wide_operands(spark):
    """One path whatever the size: 10^13 and more, and seven decimals."""
    getcontext().prec = 50
    pairs = [
        ("10000000000000", "3"), ("12345678901234567.89", "7"), ("1", "30000000000000"), ("0.0000001", "3"),
        ("10000000000000.0000005", "0.0000007"), ("2.0000049", "4"), ("99", "0.0000003"),
    ]
    df = spark.createDataFrame([(Decimal(n), Decimal(d)) for n, d in pairs], "n decimal(38,7), d decimal(38,7)")
    got = [r[0] for r in df.select(half_up_ratio(F.col("n"), F.col("d"), 8, operands="decimal(26,8)")).collect()]
    half = [(Decimal(n) / Decimal(d)).quantize(Decimal("1e-8"), ROUND_HALF_UP) for n, d in pairs]
    assert got == half
    beyond = spark.createDataFrame([(Decimal(10) ** 20, Decimal(3))], "n decimal(38,7), d decimal(38,7)")
    assert beyond.select(half_up_ratio(F.col("n"), F.col("d"), 2, operands="decimal(26,8)")).first()[0] is None


@pytest.mark.parametrize("unknown, last", [(None, "80%+ (saturated)"), ("unknown", "unknown")])
def test_tiers(spark, unknown, last):
    rates = [0.0, 19.99, 20.0, 40.0, 60.0, 79.99, 80.0, None]
    got = values(
        spark,
        lambda c: tier_label(c, fixed.UTILIZATION_TIERS, fixed.TOP_UTILIZATION_TIER, unknown),
        rates,
        "double",
    )
    assert got == [
        "0-20% (low)", "0-20% (low)", "20-40%", "40-60% (healthy)", "60-80% (high)",
        "60-80% (high)", "80%+ (saturated)", last,
    ]


def test_regions(spark):
    counties = ["KINGS", "SUFFOLK", "ORANGE", "ERIE", "MONROE", "ONONDAGA", "ALBANY", "TOMPKINS", None]
    got = values(spark, lambda c: label_by_members(c, fixed.NY_REGIONS, fixed.OTHER_REGION), counties)
    assert got == [*fixed.NY_REGIONS, fixed.OTHER_REGION, fixed.OTHER_REGION]


def test_layout_sizes():
    assert len(fixed.STATION_EXPORT_COLUMNS) == 75
    assert len(fixed.REGISTRATION_EXPORT_COLUMNS) == 20
    assert len(fixed.CLEAN_REGISTRATION_COLUMNS) == 17
