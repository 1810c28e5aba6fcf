import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanery.operators.packed_values import split_array, split_packed, split_text

PIECES = st.sampled_from(["Hà Khê", "Cũ", '"', '""', '\\"', "“", "”", "«", "»", ",", ";", "；", "|", "/", "\n", "\t", " ", "•", "1", "24/7", "1,5", "- ", "1) ", "(2) ", "+", "&", "[", "]", "a"])


@settings(max_examples=600, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=14).map("".join), max_size=6))
def test_scan_equals_state_machine_on_regular_quotes(texts):
    for text, got in zip(texts, split_array(pa.array(texts, pa.string())).to_pylist()):
        if not any(q in text for q in '"“”«»'):
            assert got == split_text(text)
        assert all(x == x.strip() and x for x in got)


def test_separators_quotes_numbers_and_markers():
    cases = {
        '"Khu A, X"; Y': ["Khu A, X", "Y"],
        'A,"B ""C"", D",E': ["A", 'B "C", D', "E"],
        '["a \\"b\\", c", "d"]': ['a "b", c', "d"],
        "“x, y” | «p \"q\", r»": ["x, y", 'p "q", r'],
        "24/7 / 1,5 lần, a - b + c & d": ["24/7", "1,5 lần", "a - b + c & d"],
        "1) a\n2) b\n\n(3) c": ["a", "b", "c"],
        "- a\n– b\n• c\n* d\n+ e": ["a", "b", "c", "d", "e"],
        "a；b\tc • d;;": ["a", "b", "c", "d"],
        'màn 27" cong, x': ['màn 27" cong', "x"],
        '"never closed; x': ['"never closed', "x"],
        "[]": [], "": [], "   ": [], "x": ["x"],
    }
    for text, want in cases.items():
        assert split_text(text) == want, text
    assert split_array(pa.array([*cases, None])).to_pylist() == [*cases.values(), []]


def test_slices_and_long_texts():
    a = pa.array(["a,b", None, "c;d", "", "e" * 100_000 + ";f"])
    assert split_array(a.slice(2, 3)).to_pylist() == [["c", "d"], [], ["e" * 100_000, "f"]]
    assert split_array(pa.array([], pa.string())).to_pylist() == []


def test_operator_on_nulls_repeats_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "a;b", 7), (1, "a;b", 7), (None, "c", 8), (2, None, 9), (3, " ", 9)], "id long, v string, pos int")
    got = sorted(split_packed(df, "v", ["id", "pos"]).collect(), key=str)
    assert [(r["id"], r["pos_in"], r["pos"], r["item"]) for r in got] == sorted([(1, 7, 1, "a"), (1, 7, 2, "b"), (1, 7, 1, "a"), (1, 7, 2, "b"), (None, 8, 1, "c")], key=lambda r: str(got[0].__class__(id=r[0], pos_in=r[1], pos=r[2], item=r[3])))
    assert split_packed(df.limit(0), "v", ["id"]).collect() == []
