from random import Random

import pytest

from gleanery.operators.matching import Alias, Matcher, clause_rows, clauses, match_texts, pairs

TOOLS = [
    ("sql", "SQL"), ("postgres", "PostgreSQL"), ("sql_server", "SQL Server"), ("cpp", "C++"), ("csharp", "C#"), ("c", "C"), ("dotnet", ".NET"), ("python", "Python"), ("excel", "Excel"), ("english", "tiếng Anh"),
    Alias("figma", "fig", needs=r"thiết kế|design"), Alias("rest", "REST", needs=r"\bAPI\b|HTTP"), Alias("office", "office", not_before=r"\b(?:front|back|head)[ -]*", doubtful=True), Alias("ads", "Google", not_after=r"\s+(?:Analytics|Cloud)\b", needs="quảng cáo|ads"), ("strasse", "Straße"),
]
MATCHER = Matcher(TOOLS, {"sql_server": ("sql",)})


@pytest.mark.parametrize(
    "text, want",
    [
        ("Biết PostgreSQL và MySQL", {"postgres": "required"}), ("Biết SQL Server", {"sql_server": "required"}), ("Có kinh nghiệm C++, C# và .NET", {"cpp": "required", "csharp": "required", "dotnet": "required"}), ("Lập trình C", {"c": "required"}),
        ("Không yêu cầu Python", {"python": "negated"}), ("Python không bắt buộc, biết là lợi thế", {"python": "preferred"}), ("Không yêu cầu kinh nghiệm nhưng cần biết Excel", {"excel": "required"}), ("Không phải là không cần Python", {"python": "ambiguous"}),
        ("Sẽ được đào tạo Excel sau khi nhận việc", {"excel": "mentioned"}), ("Đã được đào tạo Excel", {"excel": "required"}), ("Được đào tạo Excel", {"excel": "ambiguous"}), ("Yêu thích Python", {"python": "mentioned"}), ("Yêu thích, thành thạo Python", {"python": "required"}),
        ("Tốt nghiệp đại học ngành tiếng Anh", {"english": "mentioned"}), ("Tốt nghiệp đại học, giao tiếp tiếng Anh", {"english": "required"}), ("Xem https://x.example/Python nhé", {"python": "mentioned"}), ("Công ty sử dụng Python", {"python": "mentioned"}),
        ("Ưu tiên:\n- Python\n- Excel\nYêu cầu:\n- C++", {"python": "preferred", "excel": "preferred", "cpp": "required"}), ("Biết thiết kế bằng fig", {"figma": "required"}), ("Biết fig", {}), ("REST API", {"rest": "required"}), ("cần rest nhiều", {}),
        ("Sử dụng office", {"office": "required"}), ("Có office", {"office": "ambiguous"}), ("head office", {}), ("Chạy quảng cáo Google", {"ads": "required"}), ("Quảng cáo: Google Analytics", {}), ("Cần Excel, không cần Python", {"excel": "required", "python": "negated"}),
        ("cần SQL; không cần SQL", {"sql": "ambiguous"}), ("STRASSE", {"strasse": "required"}), ("ưu tiên Python, Excel", {"python": "preferred", "excel": "preferred"}), ("x", {}),
    ],
)
def test_contexts(text, want):
    status, evidence = MATCHER.extract(text)
    assert {e["code"]: e["context"] for e in evidence} == want
    assert all(text[e["start"] : e["end"]] == e["text"] for e in evidence)
    contexts = set(want.values())
    assert status == ("needs_review" if "ambiguous" in contexts else "matched" if contexts & {"required", "preferred"} else "no_match")


def test_logic_and_states():
    of = lambda t: [e["logic"] for e in MATCHER.extract(t)[1]]
    assert of("Biết Python hoặc C++") == ["any_of"] * 2 and of("Python/C++") == ["listed"] * 2 and of("Biết ít nhất 2 ngôn ngữ: Python, C#") == ["at_least:2"] * 2 and of("Python") == ["single"]
    assert [MATCHER.extract(t)[0] for t in (None, " ", ".", "Không", "abc")] == ["missing", "missing", "unusable", "unusable", "no_match"]
    import hashlib

    fixed = Matcher(TOOLS, overrides={(hashlib.sha256(b"Python").hexdigest(), "python"): "negated"})
    assert fixed.extract("Python")[1][0]["context"] == "negated" and fixed.extract("Python!")[1][0]["context"] == "required"


def test_spans_equal_a_plain_search():
    """Against all occurrences of all aliases, chosen one after another by the rules of ``found``."""
    rng, covers = Random(8), {"ab": ("a",)}
    aliases = [("a", "a b"), ("ab", "a b c"), ("b", "b"), ("b2", "b c"), ("ß", "ß"), ("i", "İ x"), ("a", "c d")]
    m = Matcher(aliases, covers)
    for _ in range(2000):
        text = "".join(rng.choice(["a", "b", "c", "d", " ", " ", "ß", "ss", "İ", "x", "+", "."]) for _ in range(rng.randrange(14)))
        folds = [c.casefold() for c in text]
        hits = []
        for code, alias in aliases:
            for i in range(len(text)):
                for j in range(i + 1, len(text) + 1):
                    if "".join(folds[i:j]) == alias.casefold():
                        before, after = "".join(folds[:i])[-1:], "".join(folds[j:])[:1]
                        if not (before.isalnum() or after.isalnum() or after == "+"):
                            hits.append((i, -j, code))
        chosen = []
        for a, b, code in sorted(hits):
            if not any(a < y and (c == code or code in covers.get(c, ())) for x, y, c in chosen):
                chosen.append((a, -b, code))
        assert m.spans(text) == chosen, repr(text)


def test_clauses_cover_the_text():
    rng = Random(2)
    for _ in range(500):
        t = "".join(rng.choice(["a", " ", ". ", "; ", "\n", " - ", ", biết ", " nhưng ", "Ưu tiên:", "1.5"]) for _ in range(rng.randrange(12)))
        parts = clauses(t, [i for i, c in enumerate(t) if c == "a"])
        assert parts[0][0] == 0 and parts[-1][1] == len(t) + 1 and all(x[1] == y[0] for x, y in zip(parts, parts[1:]))


def test_rows(spark):
    df = spark.createDataFrame([(1, "Ưu tiên:\nPython. Không cần C++"), (2, None), (3, ""), (1, "Ưu tiên:\nPython. Không cần C++")], "id long, t string").selectExpr("*", "0 as status", "0 as section")
    got = sorted(map(tuple, clause_rows(df, "id", "t").select("id", "place", "section", "context").collect()))
    assert got == [(1, 1, "preferred", "preferred")] * 2 + [(1, 2, "preferred", "preferred")] * 2 + [(1, 3, "preferred", "negated")] * 2 + [(3, 1, "required", "required")]
    assert sorted(map(tuple, pairs(match_texts(df, "id", "t", TOOLS), "id").collect())) == [(1, "python")]
    assert clause_rows(df.limit(0), "id", "t").collect() == [] and match_texts(df, "id", "t", []).where("status = 'no_match'").count() == 2
    long = spark.createDataFrame([(1, "cần Python, " * 20_000)], "id long, t string")
    assert match_texts(long, "id", "t", TOOLS).selectExpr("size(evidence) as n").first().n == 20_000


def test_reviews_parents_and_proposals(spark):
    from gleanery.operators.matching import assess, close_reviews, with_parents

    texts = [(1, "cần SQL; không cần SQL. Cần Python"), (2, "cần SQL; không cần SQL"), (3, "Python"), (4, None)]
    matched = match_texts(spark.createDataFrame(texts, "id long, t string"), "id", "t", TOOLS)
    got = {r.id: r for r in close_reviews(matched).collect()}
    assert {k: (r.status, r.closed) for k, r in got.items()} == {1: ("matched", True), 2: ("no_match", True), 3: ("matched", False), 4: ("missing", False)}
    assert [e.code for e in got[1].evidence] == ["python"]
    found = spark.createDataFrame([(1, "sql_server"), (2, "sql"), (2, "sql_server")], "id long, code string")
    assert sorted(map(tuple, with_parents(found, "id", {"sql_server": ("sql",)}).collect())) == [(1, "sql", True), (1, "sql_server", False), (2, "sql", False), (2, "sql_server", False)]
    df = spark.createDataFrame([("biết sql", "sql"), ("biết sql", "python"), ("biết c", "c"), ("không cần sql", "không cần sql"), ("ưu tiên sql, không cần sql", "ưu tiên sql, không cần sql"), (None, "x"), ("a", None), ("a", "")], "t string, q string")
    assert [r.verdict for r in assess(df, "t", "q", "sql").collect()] == ["accepted", "not_quoted", "no_match", "rejected", "unclear", "not_quoted", "not_quoted", "not_quoted"]
