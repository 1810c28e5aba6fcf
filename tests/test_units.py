from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gleanery.operators.units import number, parse_quantities, per_month, read_amounts, with_factors

CASES = [
    ("10 - 15 triệu", None, None, 10e6, 15e6, "VND", "month"),
    ("12tr", "VND", None, 12e6, 12e6, "VND", "month"),
    ("Từ 9.000.000 đ/tháng", None, None, 9e6, None, "VND", "month"),
    ("Upto 2,190$", None, None, None, 2190, "USD", "month"),
    (">= 30,5 tr VNĐ một tháng", None, None, 30.5e6, None, "VND", "month"),
    ("57 – 82K/h", None, None, 57e3, 82e3, "VND", "hour"),
    ("460 đô la Mỹ ~ 500 đô la Mỹ per month", None, None, 460, 500, "USD", "month"),
    ("18~24", "Tr. VND", "tháng", 18e6, 24e6, "VND", "month"),
    ("41-62", "1000 VND", "hour", 41e3, 62e3, "VND", "hour"),
    ("6.000 usd – 11.500 usd p.a.", None, None, 6000, 11500, "USD", "year"),
    ("15 000 000 - 29 000 000 VNĐ", None, None, 15e6, 29e6, "VND", "month"),
    ("20 triệu trở lên", None, None, 20e6, None, "VND", "month"),
    ("620 nghìn đến 630 nghìn một ngày công", None, None, 620e3, 630e3, "VND", "day"),
    ("193", None, None, None, None, None, None),
    ("193", "", " ", None, None, None, None),
    ("Thỏa thuận", "VND", None, None, None, None, None),
    ("", "VND", None, None, None, None, None),
    (None, "VND", "month", None, None, None, None),
    ("5 triệu - 10$", None, None, None, None, None, None),
]


@pytest.mark.parametrize("text, currency, period, low, high, money, when", CASES)
def test_readings(text, currency, period, low, high, money, when):
    r = read_amounts(text, currency, period)
    assert (r.low, r.high) == (low and round(low * 10_000), high and round(high * 10_000))
    assert (r.low_money or r.high_money, r.period) == (money, when)


def test_numbers():
    assert [number(x) for x in ("1.500.000", "1,8", "18.5", "2 000", "1,234.5", "1.234,5", "7")] == [15_000_000_000, 18_000, 185_000, 20_000_000, 12_345_000, 12_345_000, 70_000]


def test_conversion_rounds_half_up_once(spark):
    rates = spark.createDataFrame([(2024, Decimal("23415.000000"))], "year int, vnd_per_usd decimal(18,6)")
    periods = spark.createDataFrame([("week", 13, 3), ("year", 1, 12), ("month", 1, 1)], "pay_period string, month_num long, month_den long")
    rows = [(1, "1$/week", None, None, 2024), (2, "6 đồng/năm", None, None, None), (3, "5 đồng/năm", None, None, None), (4, "1$", None, None, None), (5, "1$", None, None, 1999), (6, None, None, None, 2024)]
    df = spark.createDataFrame(rows, "id long, s string, c string, p string, year int").withColumn("money", F.lit("clash"))
    out = with_factors(parse_quantities(df, "s", "c", "p"), rates, periods)
    got = {r["id"]: r["v"] for r in out.select("id", per_month(F.col("low_e4"), F.col("rate_e6"), F.col("month_num"), F.col("month_den")).alias("v")).collect()}
    assert got == {1: 101465, 2: 1, 3: 0, 4: None, 5: None, 6: None}
    assert parse_quantities(df.limit(0), "s", None, None).collect() == []


def test_numbers_of_any_length_have_a_result(spark):
    rates = spark.createDataFrame([(2024, Decimal("25000.000000"))], "year int, vnd_per_usd decimal(18,6)")
    periods = spark.createDataFrame([("month", 1, 1), ("year", 1, 12), ("hour", 208, 1)], "pay_period string, month_num long, month_den long")
    rows = [(n, f"{'9' * n} {unit}", unit) for n in range(10, 41) for unit in ("đồng", "tỷ", "$/h")] + [(0, "912345678901 tỷ", "tỷ"), (1, "999999999999999 triệu", "triệu"), (2, "x", ""), (3, " ", "")]
    df = spark.createDataFrame(rows, "id long, s string, unit string").withColumn("year", F.lit(2024).cast("long"))
    out = with_factors(parse_quantities(df, "s", None, None), rates, periods)
    got = {(r.id, r.unit): r for r in out.select("*", per_month(F.col("low_e4"), F.col("rate_e6"), F.col("month_num"), F.col("month_den")).alias("v")).collect()}
    most = 2**63 - 1
    for (n, unit), r in got.items():
        if n >= 10:
            want = (10**n - 1) * {"đồng": 1, "tỷ": 10**9, "$/h": 25000 * 208}[unit]
            assert r.v == (want if want <= most else None), (n, unit)
            assert r.reading == ("read" if (10**n - 1) * {"đồng": 1, "tỷ": 10**9, "$/h": 1}[unit] * 10_000 < 10**38 else "out_of_range")
    assert got[0, "tỷ"].v is None and got[0, "tỷ"].reading == "read" and got[1, "triệu"].v is None
    assert (got[2, ""].reading, got[3, ""].reading) == ("unreadable", "missing")
    far = with_factors(parse_quantities(df.withColumn("year", F.lit(10**15)), "s", None, None), rates, periods)
    assert far.where("unit = '$/h' and rate_e6 is not null").count() == 0
