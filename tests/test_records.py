import os

import pytest
from pyspark.sql import functions as F

from gleanery.operators import labels, publish
from gleanery.sources import contracts, html, tables
from gleanery.streaming import state


def test_workbook(tmp_path):
    rows = [["a", "b & <c>"], ["1", None], [" x ", 'é "q"']] + [[str(i), "z"] for i in range(60)]
    data = contracts.write_workbook(rows, "s")
    assert contracts.read_workbook(data, "s")[:2] == [{"a": "1", "b & <c>": None}, {"a": " x ", "b & <c>": 'é "q"'}]
    with pytest.raises(ValueError, match="no sheet"):
        contracts.read_workbook(data, "t")
    import io
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(data)) as old, zipfile.ZipFile(out, "w") as new:
        for i in old.namelist():
            text = old.read(i).decode()
            new.writestr(i, text.replace('<c r="A2" t="inlineStr">', '<c r="A2" t="inlineStr"><f>1+1</f>') if "sheet1" in i else text)
    with pytest.raises(ValueError, match="formula in A2"):
        contracts.read_workbook(out.getvalue(), "s")


def test_paths_do_not_leave_their_folder(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/f").write_text("x")
    os.symlink(tmp_path, tmp_path / "in/out")
    assert contracts.resolved(str(tmp_path / "in"), "f").endswith("/in/f")
    for bad in ("out/secret", "../x", "/etc/x", "."):
        with pytest.raises(ValueError):
            contracts.resolved(str(tmp_path / "in"), bad)


def test_faults_are_named(spark):
    codes = spark.createDataFrame([("a",), ("b",), ("c",)], "code string")
    aliases = spark.createDataFrame([("a", "Python", False), ("b", "python ", False), ("b", "AI", None), ("x", "sql", False), ("a", " ", True)], "code string, alias string, ctx boolean")
    faults = contracts.dictionary_faults(codes, aliases, "code", "alias", "ctx")
    assert {r["rule"]: r["breaks"] for r in faults.collect()} == {"alias_of_two_codes": 1, "code_without_alias": 1, "alias_of_unknown_code": 1, "short_alias_without_context": 1, "blank_alias": 1}
    with pytest.raises(ValueError, match="alias_of_two_codes"):
        contracts.sound(faults)
    contracts.sound(contracts.dictionary_faults(codes.limit(0), aliases.limit(0), "code", "alias", "ctx"))
    df = spark.createDataFrame([("1", "2024"), ("x", None), (None, "99999999999")], "id string, y string")
    got = contracts.typed_rows(df, {"id": "bigint", "y": "int"}, {"year": F.col("y") > 2000}).collect()
    assert [(r.id, r.y, r.faults) for r in got] == [(1, 2024, []), (None, None, ["id_not_bigint", "year"]), (None, None, ["y_not_int", "year"])]
    twice = spark.createDataFrame([(1, "b"), (1, "a"), (2, None)], "id int, v string")
    assert sorted(map(tuple, contracts.once_per_key(twice, "id").collect())) == [(1, "a"), (2, None)]


def test_pages_say_more(spark):
    page = '<a href="/x">x</a><a class="n" href="/p?page=2" rel="next">2</a> 1.234 việc làm'
    df = spark.createDataFrame([(page,), ("<p>nothing</p>",), (None,)], "h string").select(html.page_facts(F.col("h")).alias("f"), html.pagination(F.col("h")).alias("p")).select("f.*", "p")
    assert list(map(tuple, df.collect())) == [("/p?page=2", 1234, "next_link"), (None, None, "none"), (None, None, "none")]
    urls = spark.createDataFrame([("https://a.example/x",), ("http://w.a.example/private/1",), ("https://b.example/",), ("ftp://a.example",), (None,), ("not a url",)], "u string")
    assert [r[0] for r in urls.select(html.url_scope(F.col("u"), ("a.example",), ("/private",))).collect()] == ["allowed", "denied_path", "other_host", "no_url", "no_url", "no_url"]
    stream = '0:{"a":"$1","b":[{"c":"$2"}]}\n1:{"t":"x"}\n2:"deep"\nbroken\n3:{"me":"$3"}'
    assert [html.flight_value(stream, p) for p in ("0.a.t", "0.b.0.c", "0.a", "9.x", "0.b.7")] == ["x", "deep", '{"t": "x"}', None, None]
    assert html.flight_value(None, "0") is None
    with pytest.raises(ValueError, match="reference to itself"):
        html.flight_value(stream, "3.me")


def test_labels_and_counters(spark):
    df = spark.createDataFrame([("Toàn thời gian,  từ XA, lạ",), (None,), (" , ",)], "t string")
    shown = {"toàn thời gian": "Full time", "từ xa": "Remote"}
    assert [r[0] for r in df.select(labels.display_of(F.col("t"), shown, ",")).collect()] == ["Full time, Remote, lạ", None, None]
    assert [tuple(r[0]) for r in df.select(labels.arrangement(F.col("t"), {"Từ xa": "remote"}, ("lạ",))).collect()] == [("remote", True), (None, False), (None, False)]
    labels_ = spark.createDataFrame([(" kế toán/kiểm toán ,thuế.",), ("- it -  phần mềm&dữ liệu",), (" / ",), (None,)], "t string")
    assert [r[0] for r in labels_.select(labels.typography(F.col("t"))).collect()] == ["Kế toán / kiểm toán, thuế", "It - phần mềm & dữ liệu", None, None]
    runs = spark.createDataFrame([("a", 3, 0.01), ("b", 1, 0.5), ("c", 2, 0.1)], "r string, longest_failure_run long, failure_rate double")
    assert [r.stop for r in state.stop_reason(runs).orderBy("r").collect()] == ["consecutive_failures", "error_rate", None]
    queue, done = spark.createDataFrame([(1,), (2,), (3,)], "k int"), spark.createDataFrame([(2,), (None,)], "k int")
    assert sorted(r.k for r in state.outstanding(queue, done, "k").collect()) == [1, 3]


def test_migrations_refuse_what_changed(spark, tmp_path):
    root = str(tmp_path / "ledger")
    steps = [("1", f"CREATE TABLE mig_t (a INT) USING parquet LOCATION '{tmp_path}/t'")]
    assert publish.migrate(spark, root, steps) == ["1"] and publish.migrate(spark, root, steps) == []
    for bad in ([("1", "SELECT 1")], []):
        with pytest.raises(ValueError):
            publish.migrate(spark, root, bad)
    assert publish.migrate(spark, root, [*steps, ("2", "INSERT INTO mig_t VALUES (1)")]) == ["2"] and spark.table("mig_t").count() == 1
    spark.sql("DROP TABLE mig_t")
    live, staged = spark.createDataFrame([(1, "a"), (1, "a"), (2, "x"), (4, "n")], "k int, v string"), spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    got = {r["rule"]: r["breaks"] for r in publish.read_back(live, staged, "k", ["v"], {"child": (spark.createDataFrame([(9,), (1,), (None,)], "k int"), "k")}).collect()}
    assert got == {"missing": 1, "extra": 1, "modified": 1, "repeated": 1, "orphans_child": 1}


def test_latest_rows_are_filtered_in_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, 1), (2, 3), (3, 3)], "id int, load int").write.parquet(str(tmp_path / "x"))
    df = tables.latest_rows(spark.read.parquet(str(tmp_path / "x")), "load")
    assert sorted(r.id for r in df.collect()) == [2, 3] and "PushedFilters: [IsNotNull(load), EqualTo(load,3)]" in df._jdf.queryExecution().toString()


def test_json_shapes_and_ids_by_host(spark):
    from gleanery.functions.text import id_by_host
    from gleanery.operators.profiling import json_shapes

    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": "1"}',), ('{"a": [1]}',), ("{}",), ("[1]",), ("{torn",), (None,)], "j string")
    got = sorted((r.field, r.type, r.n) for r in json_shapes(df, "j").collect() if r.field)
    assert [(f, n) for f, _, n in got] == [("<broken>", 1), ("<null>", 1), ("<other>", 1), ("a", 1), ("a", 1), ("a", 1), ("b", 1)] and {t for f, t, _ in got if f == "a"} == {"BIGINT", "STRING", "ARRAY<BIGINT>"}
    urls = spark.createDataFrame([("https://w.a.example/x-12/",), ("https://a.example/x",), ("https://b.example/x-12",), (None,), ("::",)], "u string")
    assert [r[0] for r in urls.select(id_by_host(F.col("u"), {"a.example": r"-([0-9]+)/?$"})).collect()] == ["12", None, None, None, None]
