from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gleanery.operators.pay import convert_pay, read_pay

READ = {
    "12.000.000 - 18.000.000 VND": ("12000000", "18000000"), "11000000 - 16000000 VND MONTH": ("11000000", "16000000"), "6.5 - 9 triệu": ("6500000", "9000000"), "14.000.000VNĐ": ("14000000", "14000000"),
    "8,5tr–11tr ₫/tháng": ("8500000", "11000000"), "0 - 4.000.000 VND": ("4000000", "4000000"), "60.000.000 - 0 VND": ("60000000", "60000000"), "40.000.000 - 20.000.000 VND": ("20000000", "40000000"),
    "Trên 12 triệu": ("12000000", None), "Từ 7 triệu": ("7000000", None), "Dưới 25 triệu": (None, "25000000"), "Thu nhập lên đến 30 triệu VND": (None, "30000000"), "LC 13.5 triệu VND + Hoa Hồng": ("13500000", "13500000"),
    "7-8 triệu lương cứng": ("7000000", "8000000"), "Từ 11 Triệu - Dưới 14 Triệu VNĐ / Tháng": ("11000000", "14000000"), "Từ 3 - 5 triệu/tháng + phụ cấp 20k/ngày": ("3000000", "5000000"), "40 nghìn/giờ": ("8320000", "8320000"),
    "300 nghìn/ngày": ("7800000", "7800000"), "6 triệu/tuần": ("26000000", "26000000"), "2 nghìn/tuần": ("8666.67", "8666.67"), "35,500 - 60,000 VND/giờ": ("7384000", "12480000"), "9 triệu trở lên": ("9000000", None), "10 USD/giờ": ("52000000", "52000000"),
}
ABSTAIN = {
    None: ("missing", "missing_source"), "  ": ("missing", "missing_source"), "Đang cập nhật": ("missing", "not_updated"), "Thỏa thuận": ("negotiable", "no_numeric_offer"), "0 VND": ("zero_placeholder", "all_zero"), "0 triệu - 0 triệu": ("zero_placeholder", "all_zero"),
    "120": ("needs_review", "missing_currency_or_scale"), "70 - 160": ("needs_review", "missing_currency_or_scale"), "VND MONTH": ("missing", "no_numeric_amount"), "$ 12tr-16tr /tháng": ("needs_review", "currency_conflict"), "-6 triệu": ("needs_review", "unsupported_expression"),
    "9 triệu hoặc 12 triệu": ("needs_review", "alternative_offers"), "11 triệu/ngày/tháng": ("needs_review", "multiple_periods"), "11.20.300 VND": ("needs_review", "ambiguous_number"), "Tối đa 5 - 9 triệu": ("needs_review", "contradictory_qualifier"), "$90,000,000,000,000": ("needs_review", "unrepresentable_positive_money"),
    **{f"{'9' * n} triệu": ("needs_review", "unrepresentable_positive_money") for n in (13, 16, 20, 30, 60)},
}


@pytest.fixture(scope="module")
def got(spark):
    rows = [(k, 25000.0) for k in (*READ, *ABSTAIN)] + [("5 USD", None)]
    df = spark.createDataFrame(rows, "s string, rate double").withColumns({"rate": F.col("rate").cast("decimal(18,6)"), "late": F.lit(True), "pay": F.lit("clash")})
    out = convert_pay(read_pay(df, "s"), "rate", "late")
    assert out.limit(0).collect() == [] and set(out.columns) == {"s", "rate", "late", "pay", "salary_min", "salary_max"}
    return {r.s: r for r in out.collect()}


@pytest.mark.parametrize("text", READ)
def test_bounds(got, text):
    low, high = READ[text]
    r = got[text]
    assert r.pay.status == "mapped" and (r.salary_min, r.salary_max) == (low and Decimal(low), high and Decimal(high))


@pytest.mark.parametrize("text", ABSTAIN)
def test_abstention(got, text):
    r = got[text]
    assert (r.pay.status, r.pay.reason) == ABSTAIN[text] and r.salary_min is None and r.salary_max is None


def test_details(got):
    assert got["5 USD"].pay.status == "fx_missing" and got["5 USD"].salary_min is None
    assert got["Dưới 25 triệu"].pay.max_inclusive is False and got["Trên 12 triệu"].pay.min_inclusive is False and got["Từ 11 Triệu - Dưới 14 Triệu VNĐ / Tháng"].pay.max_inclusive is False
    assert "assumed_month" in got["Từ 7 triệu"].pay.flags and "assumed_month" not in got["8,5tr–11tr ₫/tháng"].pay.flags
    assert got["40.000.000 - 20.000.000 VND"].pay.flags == ["assumed_month", "positive_bounds_reordered"]
    assert got["LC 13.5 triệu VND + Hoa Hồng"].pay.flags == ["variable_component", "assumed_month"] and got["LC 13.5 triệu VND + Hoa Hồng"].pay.component == "base_salary"
    assert got["Thu nhập lên đến 30 triệu VND"].pay.component == "advertised_income" and got["7-8 triệu lương cứng"].pay.component == "base_salary"
    assert got["10 USD/giờ"].pay.flags == ["conventional_month_conversion", "provisional_ytd_fx"]
    assert "amount_review_signal" in got["2 nghìn/tuần"].pay.flags
