import pytest

from gleanery.operators.claims import claim_records, claims_of, read_claims, summary_of
from gleanery.operators.places import Places, classify_places


@pytest.mark.parametrize(
    "text, education, experience",
    [
        ("Tốt nghiệp Đại học ngành kế toán.", ("single", ["bachelor"]), ("not_mentioned", [])), ("Tốt nghiệp cao đẳng hoặc đại học.", ("alternatives", ["bachelor", "college"]), ("not_mentioned", [])),
        ("Có tối thiểu 3 năm kinh nghiệm kho.", ("not_mentioned", []), ("single", ["lower_bound"])), ("Có kinh nghiệm từ 2 năm trở lên.", ("not_mentioned", []), ("single", ["lower_bound"])), ("Cần 1–3 năm kinh nghiệm.", ("not_mentioned", []), ("single", ["range"])),
        ("Không yêu cầu kinh nghiệm, sẽ được đào tạo.", ("not_mentioned", []), ("single", ["no_requirement"])), ("Ưu tiên có 2 năm kinh nghiệm.", ("not_mentioned", []), ("mentions_only", [])), ("Có ít nhất 1 năm kinh nghiệm. Có trên 5 năm kinh nghiệm quản lý.", ("not_mentioned", []), ("complex", ["lower_bound"])),
        ("Không phải là không cần đại học", ("ambiguous", []), ("not_mentioned", [])), ("Sau đại học", ("single", ["postgraduate"]), ("not_mentioned", [])), ("Có kinh nghiệm bán hàng", ("not_mentioned", []), ("single", ["required_unspecified"])), ("", ("not_mentioned", []), ("not_mentioned", [])), (None, ("not_mentioned", []), ("not_mentioned", [])),
    ],
)
def test_claims(text, education, experience):
    got = claims_of(text)
    assert (summary_of(got, "education"), summary_of(got, "experience")) == (education, experience), got
    assert all(text[c["start"] : c["end"]] == c["text"] and c["clause_start"] <= c["start"] for c in got)


def test_claim_rows(spark):
    df = spark.createDataFrame([(1, "Có 6 tháng kinh nghiệm; tốt nghiệp trung cấp"), (2, None), (3, " "), (4, "x " * 60_000 + "đại học")], "id long, t string").selectExpr("*", "0 as claims", "0 as education")
    read = read_claims(df, "id", "t")
    rows = claim_records(read, "id", df, "t").orderBy("id", "ordinal").collect()
    assert [(r.id, r.ordinal, r.value, r.exact) for r in rows] == [(1, 1, "stated_point", True), (1, 2, "vocational", True), (4, 1, "bachelor", True)]
    assert float(rows[0].low_months) == 6 and read.count() == 4 and read_claims(df.limit(0), "id", "t").collect() == []


@pytest.mark.parametrize(
    "text, want",
    [
        ("Hà Khê", ("mapped_single", ["Hà Khê"], [])), ("tp. ha khe; Cổ Lũng", ("mapped_multiple", ["Hà Khê", "Cổ Lũng"], [])), ("đường Hà Khê, Cổ Lũng", ("mapped_single", ["Cổ Lũng"], ["street_or_facility"])), ("Nước ngoài", ("foreign", [], ["foreign"])),
        ("Nước ngoài, Hà Khê", ("mapped_multiple", ["Hà Khê"], ["foreign"])), ("Remote - Hà Khê", ("remote", ["Hà Khê"], ["remote"])), ("Toàn quốc / remote", ("nationwide", [], ["nationwide", "remote"])), ("chưa rõ", ("unknown", [], [])), ("Quận 7", ("unmapped", [], [])), (" ", ("missing", [], [])),
        ("Đông Hà Khê", ("mapped_single", ["Đông Hà Khê"], [])),
    ],
)
def test_places(text, want):
    assert Places({"Hà Khê": ["HKE"], "Cổ Lũng": [], "Đông Hà Khê": []}).classify(text) == want


def test_place_rows(spark):
    df = spark.createDataFrame([(1, "HKE"), (2, None), (1, "HKE")], "id long, t string").selectExpr("*", "0 as status")
    assert sorted(r.display for r in classify_places(df, "id", "t", {"Hà Khê": ["HKE"]}).collect()) == ["Hà Khê", "Hà Khê", "missing"]
    assert classify_places(df.limit(0), "id", "t", {}).collect() == []
