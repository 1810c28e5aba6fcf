import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.functions import text as tx
from gleanery.operators import aggregates, grammar, identity, joins, labels, matching, publish, sampling
from gleanery.sources import html, tables
from gleanery.streaming import state


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize(
    "value, want",
    [
        (None, (None, "missing")), ("", (None, "blank")), ("  ", (None, "blank")), ("a&amp;amp;b", ("a&b", "present")), ("&CN; x", ("&CN; x", "present")),
        ("é", ("é", "present")), ("a\r\nb\tc", ("a\nb c", "present")), ("x\x07y", ("x y", "present")), ("&amp;amp;amp;amp;amp;lt;", ("&amp;amp;amp;amp;amp;lt;", "present")), ("&#0;", ("�", "present")),
    ],
)
def test_clean(value, want):
    got = tx.clean(value)
    assert got[:2] == want
    assert got[0] is None or tx.clean(got[0])[0] == got[0]


def test_urls_dates_and_integers(spark):
    df = spark.createDataFrame([("HTTPS://A.Example:443//x//y/?utm_source=1&b=2&a=1#top", "07/12/2026", "Từ 1.500,00 đ"), (None, "x", "")], "u string, d string, n string")
    a, b = df.select(tx.canonical_url(F.col("u")), tx.source_date(F.col("d")).cast("string"), tx.first_integer(F.col("n"))).collect()
    assert tuple(a) == ("https://a.example/x/y?a=1&b=2", "2026-12-07", 150000) and tuple(b) == (None, None, None)
    now = F.lit(datetime(2026, 1, 10, 12))
    r = spark.createDataFrame([("4 ngày trước",), ("2 giờ trước",), ("hôm qua",), (None,)], "t string").select(tx.relative_time(F.col("t"), now).alias("r")).select("r.*").collect()
    assert [x["precision"] for x in r] == ["ngay", "gio", None, None] and r[0]["at"] == datetime(2026, 1, 6, 12)


def test_experience(spark):
    none = (None, None, None, None)
    cases = {
        "1 - 3 năm": ("mapped", "range", 12, 36, "range_crossing"), "Dưới 3 năm": ("mapped", "upper_bound", 0, 36, "range_crossing"), "Trên 5 năm": ("mapped", "lower_bound", 60, None, "ge_5"),
        "6 tháng": ("mapped", "stated_point", 6, 6, "lt_1"), "5 - 3 năm": ("invalid_bounds", *none), "Không yêu cầu": ("no_requirement", "no_requirement", None, None, "no_requirement"),
        "2 năm kinh nghiệm": ("mapped", "stated_point", 24, 24, "1_lt_3"), "hai năm": ("unmapped", *none), " ": ("missing", *none), "1 năm trở lên": ("mapped", "lower_bound", 12, None, "range_crossing"),
        "dưới 1 năm": ("mapped", "upper_bound", 0, 12, "lt_1"), "trên 1 năm trở xuống": ("ambiguous", *none), "1 năm - 18 tháng": ("mapped", "range", 12, 18, "1_lt_3"), "6 tháng đến 2 năm": ("mapped", "range", 6, 24, "range_crossing"),
        "từ 0,5 – 1 năm": ("mapped", "range", 6, 12, "range_crossing"), "Không": ("ambiguous_literal", *none), "Có": ("mapped", "required_unspecified", None, None, "required_unspecified"), "Chưa cập nhật": ("unknown", *none),
        "3 năm - 18 tháng": ("invalid_bounds", *none), "dưới 1 năm trở lên": ("ambiguous", *none), **{f"{'9' * n} năm": ("invalid_bounds", *none) for n in (10, 13, 20, 60)}, f"1 - {'9' * 20} tháng": ("invalid_bounds", *none),
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "t string").select("t", grammar.experience(F.col("t")).alias("r")).select("t", "r.*")
    for r in df.collect():
        want = cases.get(r.t, ("missing", None, None, None, None))
        assert (r.status, r.kind, r.low_months and float(r.low_months) or (0 if r.low_months is not None else None), r.high_months and float(r.high_months), r.bucket) == want, r.t


def test_joins(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y"), (None, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "q"), (3, None)], "k int, v string")
    r = joins.strict_check(a, b, "k", ["v"]).first()
    assert (r.matched, r.only_left, r.only_right, r.repeated_left, r.repeated_right, r.disagreeing) == (3, 1, 1, 1, 0, 2)
    with pytest.raises(ValueError):
        joins.strict_join(a, b, "k", ["v"])
    assert {(x.k, x.state) for x in joins.compare(b, a.distinct(), "k", ["v"]).collect()} == {(1, "matched"), (2, "modified"), (3, "missing"), (None, "extra")}
    assert rows(joins.orphans(a, "k", b.where("k = 1"), "k").select("k")) == [(2,), (2,)]
    assert joins.same_rows(a, a).first()["equal"] and not joins.same_rows(a, a.distinct()).first()["equal"]


def test_labels(spark):
    d = spark.createDataFrame([("A", "x", "mapped")], "label string, category string, status string")
    df = spark.createDataFrame([(" a ",), ("b",), (None,), ("",)], "v string")
    assert [r.status for r in labels.look_up(df, "v", d).collect()] == ["mapped", "unmapped", "missing", "missing"]
    with pytest.raises(Exception, match="label listed twice"):
        labels.look_up(df, "v", d.union(d)).collect()
    s = labels.preferred_spelling(spark.createDataFrame([("AB",), ("ab",), ("ab",), ("Cd",), ("CD",), (None,)], "c string"), "c")
    assert {(r.key, r.spelling) for r in s.collect()} == {("ab", "ab"), ("cd", "CD")}
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "c")], "child string, parent string")
    assert rows(labels.roll_up(spark, e)) == [("a", "c", 2), ("b", "c", 1), ("c", "c", 0), ("x", "c", 1)]
    with pytest.raises(Exception):
        labels.roll_up(spark, spark.createDataFrame([("a", "b"), ("b", "a")], "child string, parent string")).collect()


def test_samples_are_the_first_of_each_group(spark):
    df = spark.range(2000).selectExpr("id", "id % 3 as g")
    got = sampling.first_per_group(df, ["g"], ["id"], 4).select("g", "place", "id")
    assert rows(got) == sorted(((i % 3, i // 3 + 1, i) for i in range(12)), key=str)
    assert sampling.first_per_group(df.limit(0), ["g"], ["id"], 4).collect() == []


def test_metrics(spark):
    df = spark.createDataFrame([("s", ["a", "b"], ["a"]), ("s", None, ["c"]), ("t", [], [])], "s string, f array<string>, m array<string>")
    got = {r.s: r for r in aggregates.precision_recall(df, "s", "f", "m").collect()}
    assert (got["s"].tp, got["s"].fp, got["s"].fn, got["s"].precision) == (1, 1, 1, 0.5) and got["t"].precision is None


def test_digest_ignores_order_and_sees_every_field(spark):
    a = spark.createDataFrame([(1, None), (2, ""), (2, "")], "k int, v string")
    assert identity.digest(a, ["k", "v"]).first() == identity.digest(a.orderBy(F.desc("k")).repartition(3), ["k", "v"]).first()
    assert identity.digest(a, ["k", "v"]).first() != identity.digest(a.fillna(""), ["k", "v"]).first()
    assert identity.digest(a.limit(0), ["k", "v"]).first()["digest"] == "0"


def test_publish_states(spark, tmp_path):
    root, df = str(tmp_path / "store"), spark.createDataFrame([(1, "a")], "k int, v string")
    assert publish.publish(df, root, "t", "f1", df.columns) == "published"
    assert publish.publish(df, root, "t", "f1", df.columns) == "verified_noop"
    assert publish.publish(df.withColumn("v", F.lit("b")), root, "t", "f1", df.columns) == "republished_after_content_drift"
    assert rows(publish.read_current(spark, root, "t")) == [(1, "b")]
    ledger = json.loads((tmp_path / "store/t/ledger.json").read_text())
    assert [r["state"] for r in ledger] == ["published"] * 3
    with pytest.raises(FileExistsError):
        publish.stage_and_verify(df, root, df.columns)
    reg = publish.register(df, spark.createDataFrame([(2, "c"), (1, "a")], "k int, v string"), "k", ["v"])
    assert rows(reg) == [(1, "a"), (2, "c")]
    with pytest.raises(ValueError):
        publish.register(df, df.withColumn("v", F.lit("z")), "k", ["v"])


def test_matcher(spark):
    m = matching.Matcher([("sql", "SQL"), ("sql_server", "SQL Server"), ("cpp", "C++"), ("net", ".NET")], {"sql_server": ("sql",)})
    text = "Yêu cầu SQL Server và C++; không cần .NET. Ưu tiên sql; MySQL"
    status, e = m.extract(text)
    assert [(x["code"], x["context"]) for x in e] == [("sql_server", "required"), ("cpp", "required"), ("net", "negated"), ("sql", "preferred")]
    assert status == "matched" and all(text[x["start"] : x["end"]] == x["text"] for x in e)
    assert m.extract("cần SQL\nkhông cần SQL")[0] == "needs_review" and m.extract(" ")[0] == "missing" and m.extract(None)[0] == "missing"
    with pytest.raises(ValueError):
        matching.Matcher([("a", "x"), ("b", "X")])
    df = spark.createDataFrame([(1, text), (2, None), (2, None)], "id long, t string").withColumn("status", F.lit(0))
    out = matching.match_texts(df, "id", "t", [("sql", "SQL")])
    assert [r.status for r in out.orderBy("id").collect()] == ["matched", "missing", "missing"]
    assert rows(matching.pairs(out, "id")) == [(1, "sql")]


def test_sources(spark, tmp_path):
    assert tables.contained("/a", "b/c") == "/a/b/c"
    for bad in ("/x", "../x", "a/../../x", ""):
        with pytest.raises(ValueError):
            tables.contained("/a", bad)
    p = tmp_path / "x.jsonl"
    p.write_text('{"id": 1, "v": "a"}\n{"id": 2, "v": "b"}\n{"id": 3, "v": "tor')
    good, broken = tables.read_json_lines(spark, str(p), T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())]))
    assert rows(good) == [(1, "a"), (2, "b")] and [r.line for r in broken.collect()] == ['{"id": 3, "v": "tor']
    assert tables.schema_breaks(good, T.StructType([T.StructField("id", T.StringType()), T.StructField("w", T.StringType())])) == ["extra v", "id: bigint for string", "missing w"]
    df = spark.createDataFrame([(1, ' "a",\n b '), (2, None), (3, "")], "id long, v string")
    for fmt in ("parquet", "csv", "json", "orc"):
        assert rows(tables.write_read(df, str(tmp_path / fmt), fmt)) == rows(df), fmt
    tables.write_batches(df.selectExpr("*", "'d1' as day", "id as batch"), str(tmp_path / "b"), "day", "batch")
    assert [r.id for r in tables.latest_batch(spark.read.parquet(str(tmp_path / "b")), "day", "batch").collect()] == [3]


def test_pages(spark):
    page = '<h1>T &amp; x</h1><a href="/viec/a-12">1</a><a href="/viec/a-12?x">2</a><a href=\'/viec/b-7\'>3</a><script type="application/ld+json">{"@graph":[{"@type":"JobPosting","title":"Dev","hiringOrganization":{"name":"C"}}]}</script>'
    df = spark.createDataFrame([(1, page), (2, None), (3, "<script type='application/ld+json'>{</script>")], "p int, h string")
    assert rows(html.listing(df, "p", "h", r"-(\d+)$").select("p", "job_id")) == [(1, "12"), (1, "7")]
    got = df.select("p", html.detail(F.col("h")).alias("d")).select("p", "d.*").orderBy("p").collect()
    assert (got[0].title, got[0].company, got[0].heading, got[0].n_links) == ("Dev", "C", "T & x", 3)
    assert [r.error for r in got] == [None, "missing", "broken_json"]


EVENTS = [(i, f"k{i % 3}", datetime(2026, 1, 1, i % 24, i % 60), "a" if i % 4 else "b") for i in range(60)]


def test_stream_equals_batch(spark, tmp_path):
    df = spark.createDataFrame(EVENTS, "id long, k string, at timestamp, c string")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = state.stream_content_changes(stream, "k", "at", "c", "id").writeStream.format("memory").queryName("changes").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    want = state.content_changes(df, "k", "at", "c", "id").select("k", "id", "change")
    assert rows(spark.table("changes").select("key", "tie", "change")) == rows(want)
    seen = state.discovery(df.withColumn("b", F.hour("at")), "k", "at", "b")
    q = state.stream_discovery(stream.withColumn("b", F.hour("at")), "k", "at", "b").writeStream.outputMode("update").format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "d")).start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("seen").groupBy("k").agg(F.min("first_seen"), F.max("seen_count"))
    assert rows(got) == rows(seen.select("k", "first_seen", "seen_count"))


def test_stream_commits_once(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "a", "y"), (4, "b", None), (5, "b", None), (6, None, "z")], "id long, k string, f string")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    for _ in range(2):  # the same rows arrive again after a restart
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        q = state.stream_commit(stream, "k", "f", "id").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        assert q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).groupBy("key", "outcome").count()
    assert rows(got) == [("a", "conflict", 2), ("a", "new", 1), ("a", "overlap", 3), ("b", "new", 1), ("b", "overlap", 3)]


def test_state_rules(spark):
    known = spark.createDataFrame([("a", "1"), ("b", "1")], "k string, f string")
    new = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "1"), ("d", "1"), ("d", "2"), (None, "1")], "k string, f string")
    assert rows(state.commit(known, new, "k", "f")) == [("a", "overlap"), ("b", "conflict"), ("c", "new"), ("d", "conflict")]
    e = spark.createDataFrame([(1, "a", "pending"), (2, "a", "processing"), (1, "b", "done")], "o int, k string, s string")
    assert rows(state.last_state(e, "k", "s", "o")) == [("a", "pending"), ("b", "done")]


def test_stream_windows_hold_the_last_hours(spark, data):
    from gleanery.plans.reference import QUERIES

    want = sorted(map(tuple, QUERIES["m_hourly_windows"](spark, data).select("hour", "event_type", "n").collect()))
    assert want and sorted(map(tuple, QUERIES["m_stream_windows"](spark, data).select("window_start", "event_type", "n").collect())) == want


def test_failure_runs_equal_a_plain_scan(spark):
    from random import Random

    rng = Random(4)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None]), i, rng.random() < (0.9 if i % 400 < 120 else 0.2) or None) for i in range(4000)]
    want = {}
    for name in {r[0] for r in rows}:
        x = [bool(r[2]) for r in rows if r[0] == name]
        longest = now = 0
        for f in x:
            now = now + 1 if f else 0
            longest = max(longest, now)
        want[name] = (len(x), sum(x), longest)
    df = spark.createDataFrame(rows, "r string, o int, f boolean").repartition(7)
    assert {r.r: (r.n_events, r.failures, r.longest_failure_run) for r in state.failure_runs(df, "r", "o", "f").collect()} == want
    assert state.failure_runs(df.limit(0), "r", "o", "f").collect() == []


def test_roll_up_follows_long_chains_and_finds_cycles(spark):
    chain = spark.range(300).selectExpr("concat('n', id) as child", "concat('n', id + 1) as parent")
    got = {r.label: (r.root, r.steps) for r in labels.roll_up(spark, chain).collect()}
    assert got["n0"] == ("n300", 300) and got["n300"] == ("n300", 0) and len(got) == 301
    for bad in ([("a", "b"), ("b", "c"), ("c", "a")], [("a", "b"), ("a", "c")], [("a", "a")]):
        with pytest.raises(ValueError):
            labels.roll_up(spark, spark.createDataFrame(bad, "child string, parent string"))
    assert labels.roll_up(spark, chain.limit(0)).collect() == []


def test_overrides_are_guarded(spark):
    df = spark.createDataFrame([(1, "a", "e"), (2, None, "f"), (3, "c", None)], "k int, v string, ev string")
    sha = lambda c: F.sha2(F.col(c), 256)
    one = lambda k, old, new, ev: spark.createDataFrame([(k, old, new, ev)], "k int, expected string, value string, ev string").withColumn("evidence_sha256", sha("ev"))
    assert rows(joins.override(df, "k", "v", one(2, None, "x", "f"), "ev").select("k", "v")) == [(1, "a"), (2, "x"), (3, "c")]
    for bad in (one(1, "b", "x", "e"), one(1, "a", "x", "other")):
        with pytest.raises(Exception, match="override of a changed row: 1"):
            joins.override(df, "k", "v", bad, "ev").collect()
    twice = one(1, "a", "x", "e").union(one(1, "a", "y", "e")).union(one(9, "a", "y", "e"))
    assert rows(joins.override_faults(df, "k", twice)) == [(1, "repeated"), (9, "no_row")]
