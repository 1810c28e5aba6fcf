"""Queries of grammars, record assembly, text evidence and read-back checks, with their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions import text as tx
from gleanery.operators import claims, grammar, joins, labels, matching, pay, places, publish
from gleanery.session import shared_dir, small, table
from gleanery.sources import contracts, html, tables
from gleanery.streaming import state

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def strip_sql(c: str) -> str:
    return f"trim(regexp_replace({c}, '[\\s\\x{{0085}}\\x{{00a0}}\\x{{1680}}\\x{{2028}}\\x{{2029}}\\x{{205f}}\\x{{2000}}-\\x{{200a}}\\x{{202f}}\\x{{3000}}]+', ' ', 'g'))"


# --- pay ---------------------------------------------------------------------------------------

_EDGE = "[^\\p{L}\\p{N}_]"
_AMOUNTS = "'^([0-9]+(?:[.,][0-9]+)*)\\s*(triệu|nghìn|ngàn|tr|k|m)?(?:\\s*(-|đến|tới|dưới)\\s*([0-9]+(?:[.,][0-9]+)*)\\s*(triệu|nghìn|ngàn|tr|k|m)?)?$'"
_BODY = "'^(?:(?:thu nhập|lương cứng|khởi điểm|lc|cứng|cơ bản|chính thức) )?(?:(từ|trên|ít nhất|tối thiểu|lên tới|lên đến|tới|dưới|upto|up to|tối đa) )?(.*)$'"


def _value(n: str, u: str) -> str:
    return (
        f"CASE WHEN regexp_matches({n}, '^[0-9]{{1,3}}([.,][0-9]{{3}})+$') THEN CAST(replace(replace({n}, '.', ''), ',', '') AS DOUBLE) WHEN regexp_matches({n}, '^[0-9]+([.,][0-9]{{1,2}})?$') THEN CAST(replace({n}, ',', '.') AS DOUBLE) END"
        f" * CASE WHEN {u} IN ('triệu', 'tr', 'm') THEN 1000000 WHEN {u} IN ('nghìn', 'ngàn', 'k') THEN 1000 ELSE 1 END"
    )


_PAY = f"""
WITH s1 AS (SELECT id, year, regexp_replace(lower({strip_sql('salary')}), '[–—−]', '-', 'g') AS t FROM source_rows),
s2 AS (SELECT *, split_part(t, '+', 1) AS cut, contains(t, '+') AS plus FROM s1),
s3 AS (SELECT *, replace(cut, 'triêu', 'triệu') AS m0 FROM s2),
s4 AS (SELECT *, CASE WHEN regexp_matches(m0, '(^|{_EDGE})net($|{_EDGE})') THEN 'net' WHEN regexp_matches(m0, '(^|{_EDGE})gross($|{_EDGE})') THEN 'gross' END AS tax,
  regexp_replace(m0, '(^|{_EDGE})(net|gross)($|{_EDGE})', '\\1\\3', 'g') AS m FROM s3),
s5 AS (SELECT *, regexp_matches(m, 'usd|\\$') AS usd, regexp_matches(m, 'vnd|vnđ|đồng|₫|triệu|nghìn|ngàn|[0-9]\\s*(tr|k|đ)($|{_EDGE})') AS vnd,
  list_distinct(list_concat(regexp_extract_all(m, '/\\s*(tháng|tuần|ngày|giờ)', 1), CASE WHEN regexp_matches(m, '(^|{_EDGE})month($|{_EDGE})') THEN ['month'] ELSE [] END)) AS per,
  {strip_sql(f"regexp_replace(regexp_replace(regexp_replace(m, '(vnd|vnđ|usd|đồng|[₫$])', '', 'g'), '([0-9])đ($|{_EDGE})', '\\1\\2', 'g'), '/\\s*(tháng|tuần|ngày|giờ|month)|month', '', 'g')")} AS bare FROM s4),
s6 AS (SELECT *, regexp_extract(bare, {_BODY}, 1) AS head, regexp_replace(regexp_replace(regexp_extract(bare, {_BODY}, 2), '-\\s*dưới\\s+', 'dưới ', 'g'), '(tới|đến)\\s*<\\s*', 'dưới ', 'g') AS b0 FROM s5),
s7 AS (SELECT *, suffix(b0, 'lương cứng') AS late, regexp_replace(b0, '\\s*lương cứng$', '') AS b1 FROM s6),
s8 AS (SELECT *, suffix(b1, 'trở lên') AS rises, regexp_replace(b1, '\\s*trở lên$', '') AS body FROM s7),
s9 AS (SELECT *, regexp_matches(body, {_AMOUNTS}) AS fits, regexp_extract(body, {_AMOUNTS}, 1) AS n1, regexp_extract(body, {_AMOUNTS}, 2) AS u1, regexp_extract(body, {_AMOUNTS}, 3) AS sep,
  regexp_extract(body, {_AMOUNTS}, 4) AS n2, regexp_extract(body, {_AMOUNTS}, 5) AS u2 FROM s8),
s10 AS (SELECT *, n2 <> '' AS two, {_value('n1', "coalesce(nullif(u1, ''), u2)")} AS a, {_value('n2', 'u2')} AS b FROM s9),
s11 AS (SELECT *, CASE WHEN coalesce(t, '') = '' THEN 'missing_source' WHEN t = 'đang cập nhật' THEN 'not_updated'
  WHEN regexp_matches(t, '^({pay.NEGOTIABLE})') THEN 'no_numeric_offer' WHEN NOT regexp_matches(t, '[0-9]') THEN 'no_numeric_amount' WHEN contains(t, 'hoặc') THEN 'alternative_offers'
  WHEN usd AND vnd THEN 'currency_conflict' WHEN len(per) > 1 THEN 'multiple_periods' WHEN NOT fits THEN 'unsupported_expression' WHEN NOT usd AND NOT vnd THEN 'missing_currency_or_scale'
  WHEN a IS NULL OR two AND b IS NULL THEN 'ambiguous_number' WHEN greatest(a, coalesce(b, a)) = 0 THEN 'all_zero'
  WHEN two AND least(a, b) > 0 AND (head IN ('lên tới', 'lên đến', 'tới', 'dưới', 'upto', 'up to', 'tối đa', 'trên') OR rises) THEN 'contradictory_qualifier' END AS reason FROM s10),
s12 AS (SELECT *, coalesce(reason IN ('missing_source', 'not_updated', 'no_numeric_offer', 'no_numeric_amount', 'alternative_offers'), false) AS early,
  coalesce(reason IN ('missing_source', 'not_updated', 'no_numeric_offer', 'no_numeric_amount', 'alternative_offers', 'currency_conflict', 'multiple_periods'), false) AS unread,
  reason IS NULL OR reason = 'contradictory_qualifier' AS valued, two AND least(a, b) = 0 AND greatest(a, b) > 0 AS zero_end,
  head IN ('lên tới', 'lên đến', 'tới', 'dưới', 'upto', 'up to', 'tối đa') AS is_up, head IN ('từ', 'trên', 'ít nhất', 'tối thiểu') OR rises AS is_low FROM s11),
p AS (SELECT id, year, coalesce(reason, '') AS reason,
  CASE WHEN reason IS NULL THEN 'mapped' WHEN reason IN ('missing_source', 'not_updated', 'no_numeric_amount') THEN 'missing' WHEN reason = 'no_numeric_offer' THEN 'negotiable' WHEN reason = 'all_zero' THEN 'zero_placeholder' ELSE 'needs_review' END AS status,
  CASE WHEN reason = 'contradictory_qualifier' THEN 'range' WHEN NOT valued THEN 'unknown' WHEN zero_end THEN 'point' WHEN two THEN CASE WHEN a = b THEN 'point' ELSE 'range' END WHEN is_up THEN 'upper_only' WHEN is_low THEN 'lower_only' ELSE 'point' END AS kind,
  CASE WHEN NOT valued THEN NULL WHEN zero_end THEN greatest(a, b) WHEN two THEN least(a, b) WHEN NOT is_up THEN a END AS source_min,
  CASE WHEN NOT valued THEN NULL WHEN two THEN greatest(a, b) WHEN is_up OR NOT is_low THEN a END AS source_max,
  CASE WHEN unread THEN NULL WHEN usd THEN 'USD' WHEN vnd THEN 'VND' END AS currency,
  CASE WHEN unread THEN NULL WHEN len(per) = 0 THEN 'month' ELSE CASE per[1] WHEN 'tháng' THEN 'month' WHEN 'month' THEN 'month' WHEN 'tuần' THEN 'week' WHEN 'ngày' THEN 'day' ELSE 'hour' END END AS period,
  CASE WHEN unread THEN 'unspecified' WHEN regexp_matches(m0, '^(lc |lương cứng)') OR late THEN 'base_salary' WHEN prefix(m0, 'thu nhập') THEN 'advertised_income' ELSE 'unspecified' END AS component,
  list_filter([CASE WHEN plus AND NOT early AND coalesce(reason, '') <> 'multiple_periods' THEN 'variable_component' END, CASE WHEN contains(cut, 'triêu') AND NOT early AND coalesce(reason, '') <> 'multiple_periods' THEN 'observed_unit_typo' END,
    CASE WHEN NOT early AND coalesce(reason, '') <> 'multiple_periods' THEN tax END, CASE WHEN NOT unread AND len(per) = 0 THEN 'assumed_month' END, CASE WHEN reason IS NULL AND zero_end THEN 'positive_bound_as_point' END,
    CASE WHEN valued AND two AND NOT zero_end AND a > b THEN 'positive_bounds_reordered' END], lambda x: x IS NOT NULL) AS flags FROM s12)"""


@query(_PAY + " SELECT id, status, reason, kind, source_min, source_max, currency, period, component, array_to_string(flags, '|') AS flags FROM p")
def d5_salary(spark, d):
    """What every salary text states, or why it cannot be read."""
    r = pay.read_pay(table(spark, d, "source_rows").select("id", "salary"), "salary").select("id", "pay.*")
    as_double = {c: F.col(c).cast("double") for c in ("source_min", "source_max")}
    return r.drop("min_inclusive", "max_inclusive").withColumns(as_double).withColumn("flags", F.array_join("flags", "|"))


@query(
    _PAY
    + """, r AS (SELECT year AS y, max(vnd_per_usd) AS rate, bool_or(provisional) AS provisional FROM fx_rates WHERE approved GROUP BY 1),
c AS (SELECT p.*, r.provisional, status = 'mapped' AND currency = 'USD' AND r.rate IS NULL AS void, CASE WHEN currency = 'USD' THEN CAST(r.rate AS DOUBLE) ELSE 1 END * CASE period WHEN 'week' THEN 52 / 12 WHEN 'day' THEN 26 WHEN 'hour' THEN 208 ELSE 1 END AS f
  FROM p LEFT JOIN r ON p.year = r.y),
v AS (SELECT *, CASE WHEN status = 'mapped' AND NOT void THEN round(source_min * f, 2) END AS low, CASE WHEN status = 'mapped' AND NOT void THEN round(source_max * f, 2) END AS high FROM c),
w AS (SELECT *, coalesce(status = 'mapped' AND NOT void AND (low >= 1e16 OR low <= 0 OR high >= 1e16 OR high <= 0), false) AS broken FROM v)
SELECT id, CASE WHEN void THEN 'fx_missing' WHEN broken THEN 'needs_review' ELSE status END AS status, CASE WHEN broken THEN NULL ELSE low END AS salary_min, CASE WHEN broken THEN NULL ELSE high END AS salary_max,
  array_to_string(list_concat(flags, list_filter([CASE WHEN status = 'mapped' AND NOT void AND NOT broken AND period <> 'month' THEN 'conventional_month_conversion' END,
    CASE WHEN status = 'mapped' AND NOT void AND NOT broken AND currency = 'USD' AND provisional THEN 'provisional_ytd_fx' END,
    CASE WHEN NOT broken AND (low < 1000000 OR low > 200000000 OR high < 1000000 OR high > 200000000) THEN 'amount_review_signal' END, CASE WHEN NOT broken AND high > low * 10 THEN 'wide_range_signal' END], lambda x: x IS NOT NULL)), '|') AS flags FROM w"""
)
def d6_salary_month(spark, d):
    """A month's pay in VND of every salary text, with what to review."""
    rates = table(spark, d, "fx_rates").where("approved").groupBy(F.col("year").cast("long").alias("y")).agg(F.max("vnd_per_usd").alias("rate"), F.bool_or("provisional").alias("provisional"))
    read = pay.read_pay(table(spark, d, "source_rows").select("id", "year", "salary"), "salary").join(small(rates), F.col("year") == F.col("y"), "left")
    out = pay.convert_pay(read, "rate", "provisional")
    return out.select("id", "pay.status", F.col("salary_min").cast("double").alias("salary_min"), F.col("salary_max").cast("double").alias("salary_max"), F.array_join("pay.flags", "|").alias("flags"))


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- sources -----------------------------------------------------------------------------------

_PATHS = ["a/b.parquet", "/etc/x", "../x", "a/../../x", "", "  ", "a..b/c", "./a"]


@query(f"SELECT path, CASE WHEN trim(path) = '' THEN 'empty' WHEN path LIKE '/%' THEN 'absolute' WHEN list_contains(string_split(path, '/'), '..') THEN 'escapes' ELSE 'contained' END AS status FROM (VALUES {', '.join(f"('{p}')" for p in _PATHS)}) t(path)")
def a2_contained_paths(spark, d):
    """Which paths may be followed below a folder."""
    return spark.createDataFrame([(p,) for p in _PATHS], "path string").select("path", contracts.path_status(F.col("path")).alias("status"))


@query("SELECT CAST(ref_id AS VARCHAR) AS ref_id, field_name, ref_code, label_vi, label_en FROM ref_values")
def a7_workbook(spark, d):
    """The reference list written as a workbook and read from it by sheet and header."""
    refs = table(spark, d, "ref_values").select(F.col("ref_id").cast("string").alias("ref_id"), "field_name", "ref_code", "label_vi", "label_en")
    book = contracts.write_workbook([refs.columns, *map(list, refs.collect())], "values")  # a list that people keep by hand
    rows = contracts.read_workbook(book, "values")
    return spark.createDataFrame([tuple(r[c] for c in refs.columns) for r in rows], refs.schema)


_ALIASES = "SELECT ref_id, label_vi AS alias, false AS contextual FROM ref_values UNION ALL SELECT ref_id, label_en, false FROM ref_values UNION ALL SELECT ref_id, ref_code, true FROM ref_values WHERE ref_code IS NOT NULL"


@query(
    f"""WITH a AS (SELECT ref_id, lower(trim(alias)) AS f, contextual FROM ({_ALIASES})), h AS (SELECT * FROM a WHERE coalesce(f, '') <> '')
SELECT 'alias_of_two_codes' AS rule, count(*) AS breaks FROM (SELECT f FROM h GROUP BY f HAVING count(DISTINCT ref_id) > 1)
UNION ALL SELECT 'code_without_alias', count(*) FROM ref_values r WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.ref_id = r.ref_id)
UNION ALL SELECT 'alias_of_unknown_code', count(*) FROM a WHERE ref_id NOT IN (SELECT ref_id FROM ref_values)
UNION ALL SELECT 'short_alias_without_context', count(*) FROM h WHERE length(f) < 3 AND NOT contextual
UNION ALL SELECT 'blank_alias', count(*) FROM a WHERE coalesce(f, '') = ''"""
)
def a8_dictionary_faults(spark, d):
    """The reference list as a dictionary of aliases, held against its rules."""
    r = table(spark, d, "ref_values")
    one = lambda c, ctx: r.select("ref_id", F.col(c).alias("alias"), F.lit(ctx).alias("contextual"))
    aliases = one("label_vi", False).unionByName(one("label_en", False)).unionByName(one("ref_code", True).where("alias is not null"))
    return contracts.dictionary_faults(r.select("ref_id"), aliases, "ref_id", "alias", "contextual")


@query(
    """WITH r AS (SELECT * FROM fx_rates WHERE approved)
SELECT 'year_without_rate' AS rule, count(*) AS breaks FROM (SELECT DISTINCT year FROM salary_audit WHERE year IS NOT NULL) y WHERE y.year NOT IN (SELECT year FROM r)
UNION ALL SELECT 'year_with_two_rates', count(*) FROM (SELECT year FROM r GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'more_than_one_series', CASE WHEN (SELECT count(DISTINCT series) FROM r) > 1 THEN 1 ELSE 0 END
UNION ALL SELECT 'not_positive', count(*) FROM r WHERE vnd_per_usd IS NULL OR vnd_per_usd <= 0
UNION ALL SELECT 'period_reversed', count(*) FROM r WHERE period_start > period_end"""
)
def a9_rate_faults(spark, d):
    """The yearly rates held against the years of the audit."""
    return contracts.rate_faults(table(spark, d, "fx_rates"), table(spark, d, "salary_audit"), "year")


@query("SELECT id, job_title, year FROM jobs")
def a11_table_sink(spark, d):
    """Jobs saved as a catalogued table and scanned from it."""
    name = f"sink_{uuid.uuid4().hex}"
    return contracts.save_table(spark, table(spark, d, "jobs").select("id", "job_title", "year"), name, _fresh(spark, name))


@query("SELECT id, year, row_number() OVER (ORDER BY id) AS place FROM jobs")
def a12_ordered_scan(spark, d):
    """Jobs in the order of their ids, each with its place: counted by sorted ranges, not in one task."""
    rows = table(spark, d, "jobs").select("id", "year").repartitionByRange("id").sortWithinPartitions("id").withColumn("part", F.spark_partition_id())
    rows = rows.withColumn("within", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1)
    kept = rows.checkpoint() if shared_dir(spark) else rows
    sizes = {r["part"]: r["n"] for r in kept.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per partition
    before, at = [], 0
    for p in sorted(sizes):
        before += [F.lit(p), F.lit(at).cast("long")]
        at += sizes[p]
    start = F.element_at(F.create_map(*before), F.col("part")) if before else F.lit(0)
    return kept.select("id", "year", (start + F.col("within")).alias("place"))


@query(
    "SELECT id, CAST(year AS INTEGER) AS year, coalesce(array_to_string(list_filter([CASE WHEN NOT coalesce(id > 0, false) THEN 'key' END, CASE WHEN NOT coalesce(year BETWEEN 2022 AND 2026, false) THEN 'year_domain' END, "
    "CASE WHEN NOT coalesce(trim(job_title) <> '', false) THEN 'title' END], lambda x: x IS NOT NULL), '|'), '') AS faults FROM source_rows"
)
def a13_typed_rows(spark, d):
    """Source rows in their types with the checks each fails."""
    checks = {"key": F.col("id") > 0, "year_domain": F.col("year").between(2022, 2026), "title": F.trim("job_title") != ""}
    typed = contracts.typed_rows(table(spark, d, "source_rows"), {"id": "bigint", "year": "int", "job_title": "string"}, checks)
    return typed.select("id", "year", F.array_join("faults", "|").alias("faults"))


@query("SELECT probe_id, job_title, vacancies FROM probe_records")
def a14_json_lines(spark, d):
    """Records appended twice as JSON lines, with a torn last line: each comes back once, the torn line apart."""
    path, df = _fresh(spark, "lines"), table(spark, d, "probe_records").select("probe_id", "job_title", "vacancies")
    for _ in range(2):
        contracts.write_json_lines(df, path)
    spark.createDataFrame([('{"probe_id": 1, "job_ti',)], "value string").write.mode("append").text(path)
    good, broken = tables.read_json_lines(spark, path, df.schema)
    if broken.count() != 1:
        raise ValueError("the torn line was lost")
    return contracts.once_per_key(good, "probe_id")


@query("SELECT doc_id, length(text) AS chars, sha256(text) AS body_hash FROM documents WHERE text IS NOT NULL")
def a16_gzip_bodies(spark, d):
    """Bodies kept compressed and read again."""
    path = _fresh(spark, "bodies")
    contracts.write_json_lines(table(spark, d, "documents").where("text is not null").select("doc_id", "text"), path, gz=True)
    back = spark.read.schema("doc_id long, text string").json(path)
    return back.select("doc_id", F.length("text").alias("chars"), F.sha2("text", 256).alias("body_hash"))


# --- labels ------------------------------------------------------------------------------------

# Display labels, and roles and seniorities of positions.
DISPLAY = {"toàn thời gian": "Full time", "bán thời gian": "Part time", "thời vụ": "Seasonal", "thực tập": "Internship", "từ xa": "Remote"}
POSITIONS = [("Nhân viên", "staff", ""), ("Trưởng nhóm", "lead", "senior"), ("Quản lý", "manager", "senior|management"), ("Giám đốc", "director", "executive|management"), ("Chuyên gia", "expert", "senior"), ("Thực tập", "intern", "junior")]
_DISPLAY_CASE = "CASE lower({0}) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DISPLAY.items()) + " ELSE {0} END"


@query(f"""SELECT id, nullif(array_to_string(list_filter(list_transform(string_split(job_type, ','), lambda x: {_DISPLAY_CASE.format(strip_sql('x'))}), lambda x: x <> ''), ', '), '') AS label FROM source_rows""")
def c3_display_labels(spark, d):
    """Job types in their display spelling, list order and unknown labels kept."""
    return table(spark, d, "source_rows").select("id", labels.display_of(F.col("job_type"), DISPLAY, ",").alias("label"))


@query(
    f"""WITH p(label, roles, seniorities) AS (VALUES {', '.join(f"('{a.lower()}', '{b}', '{c}')" for a, b, c in POSITIONS)}), s AS (SELECT id, lower({strip_sql('job_position')}) AS k FROM source_rows)
SELECT id, coalesce(roles, '') AS roles, coalesce(seniorities, '') AS seniorities, CASE WHEN coalesce(k, '') = '' THEN 'missing' WHEN label IS NULL THEN 'unmapped' ELSE 'mapped' END AS status FROM s LEFT JOIN p ON k = label"""
)
def c6_position_facets(spark, d):
    """Roles and seniorities of every position."""
    dictionary = spark.createDataFrame(POSITIONS, "position string, roles string, seniorities string")
    out = labels.facets(table(spark, d, "source_rows").select("id", "job_position"), "job_position", dictionary, "position", ("roles", "seniorities"))
    return out.select("id", F.array_join("roles", "|").alias("roles"), F.array_join("seniorities", "|").alias("seniorities"), "status")


@query(
    f"""WITH a AS (SELECT DISTINCT job_industry, {strip_sql('job_industry')} AS t FROM source_rows WHERE job_industry IS NOT NULL),
b AS (SELECT job_industry, regexp_replace(regexp_replace(t, '\\s*([/&])\\s*', ' \\1 ', 'g'), '\\s+[-–—]\\s+', ' - ', 'g') AS t FROM a),
c AS (SELECT job_industry, regexp_replace(regexp_replace(t, '\\s+([,;:])', '\\1', 'g'), '([,;:])(\\S)', '\\1 \\2', 'g') AS t FROM b),
e AS (SELECT job_industry, regexp_replace(trim(regexp_replace(t, '\\s+', ' ', 'g')), '^[\\s/&,;:.\\-–—]+|[\\s/&,;:.\\-–—]+$', '', 'g') AS t FROM c)
SELECT job_industry, nullif(upper(substr(t, 1, 1)) || substr(t, 2), '') AS label FROM e"""
)
def c8_typography(spark, d):
    """Industries as they are printed."""
    return table(spark, d, "source_rows").where("job_industry is not null").select("job_industry").distinct().select("job_industry", labels.typography(F.col("job_industry")).alias("label"))


@query(
    f"""WITH p AS (SELECT id, list_transform(string_split(job_type, ','), lambda x: lower({strip_sql('x')})) AS k FROM source_rows)
SELECT id, CASE WHEN list_contains(k, 'từ xa') THEN 'remote' END AS arrangement, coalesce(list_contains(k, 'theo ca'), false) AS shift_work FROM p"""
)
def c5_arrangements(spark, d):
    """Work arrangement and shift work out of the job types."""
    r = labels.arrangement(F.col("job_type"), {"Từ xa": "remote", "Remote": "remote", "Hybrid": "hybrid"}, ("Theo ca",))
    return table(spark, d, "source_rows").select("id", r.alias("r")).select("id", "r.*")


_AGES = ["{n} phút trước", "{n} giờ trước", "{n} ngày trước", "{n} tuần trước", "{n} tháng trước"]


@query(
    """SELECT probe_id, crawled_at - CASE probe_id % 5 WHEN 0 THEN to_minutes(probe_id % 50) WHEN 1 THEN to_hours(probe_id % 50) WHEN 2 THEN to_days(CAST(probe_id % 50 AS INTEGER)) WHEN 3 THEN to_days(CAST(7 * (probe_id % 50) AS INTEGER)) ELSE to_months(CAST(probe_id % 50 AS INTEGER)) END AS at,
CASE probe_id % 5 WHEN 0 THEN 'phut' WHEN 1 THEN 'gio' WHEN 2 THEN 'ngay' WHEN 3 THEN 'tuan' ELSE 'thang' END AS precision FROM probe_records"""
)
def c14_relative_times(spark, d):
    """Ages as boards state them, counted back from the time of the crawl."""
    kind = F.element_at(F.array(*[F.lit(a) for a in _AGES]), (F.col("probe_id") % 5 + 1).cast("int"))
    raw = F.replace(kind, F.lit("{n}"), (F.col("probe_id") % 50).cast("string"))
    r = table(spark, d, "probe_records").select("probe_id", tx.relative_time(raw, F.col("crawled_at")).alias("r"))
    return r.select("probe_id", F.col("r.at").cast("timestamp_ntz").alias("at"), "r.precision")


# --- claims, places, assembly ------------------------------------------------------------------


@query()
def d9_claims(spark, d):
    """What every text of requirements claims about degree and experience."""
    r = claims.read_claims(table(spark, d, "source_rows").select("id", "requirements"), "id", "requirements")
    return r.select("id", F.size("claims").alias("n_claims"), "education_status", F.array_join("education", "|").alias("education"), "experience_status", F.array_join("experience", "|").alias("experience"))


@query()
def d10_claim_records(spark, d):
    """Every claim with its place, its clause and the hash of its text."""
    rows = table(spark, d, "source_rows").select("id", "requirements")
    return claims.claim_records(claims.read_claims(rows, "id", "requirements"), "id", rows, "requirements")


@query()
def d11_comparison(spark, d):
    """How labels of experience relate to what the requirements claim, in numbers."""
    rows = table(spark, d, "source_rows").select("id", "requirements", grammar.experience(F.col("experience_level")).getField("kind").alias("label"))
    read = claims.read_claims(rows, "id", "requirements").join(rows.select("id", "label"), "id")
    compared = read.select(claims.comparison(F.col("label"), F.col("experience_status"), F.col("experience")).alias("comparison"), "experience_status")
    return compared.groupBy("comparison", "experience_status").agg(F.count(F.lit(1)).alias("n"))


@query()
def k3_location_status(spark, d):
    """Which places every location names, and whether it says foreign, remote or nationwide."""
    refs = table(spark, d, "ref_values").where("field_name = 'location'").limit(20_001).collect()
    if len(refs) > 20_000:
        raise ValueError("more places than a task should hold")
    names = {r["label_vi"]: [x for x in (r["label_en"], r["ref_code"]) if x] for r in refs if r["label_vi"]}
    r = places.classify_places(table(spark, d, "source_rows").select("id", "location"), "id", "location", names)
    return r.select("id", "status", "display", F.array_join("flags", "|").alias("flags"))


_BAD_ROW = "CASE WHEN id IS NULL OR id <= 0 THEN 'bad_key' WHEN year IS NULL OR year NOT BETWEEN 2022 AND 2026 THEN 'bad_year' END"


@query(f"SELECT coalesce({_BAD_ROW}, 'sound') AS reason, count(*) AS n, min(id) AS example FROM source_rows GROUP BY 1")
def e2_row_contract(spark, d):
    """How many rows break the contract that a run is aborted by, with an example."""
    why = F.when(F.col("id").isNull() | (F.col("id") <= 0), "bad_key").when(F.col("year").isNull() | ~F.col("year").between(2022, 2026), "bad_year").otherwise("sound")
    return table(spark, d, "source_rows").groupBy(why.alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("example"))


@query(
    f"""WITH s AS (SELECT id, year, {strip_sql('nfc_normalize(job_title)')} AS t, {strip_sql('nfc_normalize(requirements)')} AS q, {strip_sql('education_level')} AS e, {strip_sql('experience_level')} AS x FROM source_rows),
f AS (SELECT *, list_sort(list_filter([CASE WHEN coalesce(q, '') = '' THEN 'no_requirements' END, CASE WHEN coalesce(e, '') = '' THEN 'no_education' END, CASE WHEN coalesce(x, '') = '' THEN 'no_experience' END,
  CASE WHEN year IS NULL OR year NOT BETWEEN 2022 AND 2026 THEN 'year_out_of_range' END], lambda v: v IS NOT NULL)) AS flags FROM s)
SELECT id, CASE WHEN coalesce(t, '') = '' THEN 'missing_title' WHEN lower(t) = 'không' THEN 'title_ambiguous_literal' END AS quarantine, nullif(t, '') AS title, array_to_string(flags, '|') AS flags,
  CASE WHEN coalesce(t, '') = '' OR lower(t) = 'không' THEN 'quarantined' WHEN len(flags) > 0 THEN 'ready_with_flags' ELSE 'ready' END AS status FROM f"""
)
def e3_row_assembly(spark, d):
    """One flat record per source row: title, flags of all fields, and whether it is ready."""
    text = lambda c: tx.collapse(F.col(c))
    void = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    rows = table(spark, d, "source_rows").select("id", "year", tx.collapse(tx.nfc(F.col("job_title"))).alias("t"), tx.collapse(tx.nfc(F.col("requirements"))).alias("q"), text("education_level").alias("e"), text("experience_level").alias("x"))
    flags = F.array_sort(
        F.array_compact(
            F.array(F.when(void("q"), "no_requirements"), F.when(void("e"), "no_education"), F.when(void("x"), "no_experience"), F.when(F.col("year").isNull() | ~F.col("year").between(2022, 2026), "year_out_of_range"))
        )
    )
    why = F.when(void("t"), "missing_title").when(F.lower("t") == "không", "title_ambiguous_literal")
    out = rows.select("id", why.alias("quarantine"), F.nullif("t", F.lit("")).alias("title"), flags.alias("flags"))
    state_ = F.when(F.col("quarantine").isNotNull(), "quarantined").when(F.size("flags") > 0, "ready_with_flags").otherwise("ready")
    return out.select("id", "quarantine", "title", F.array_join("flags", "|").alias("flags"), state_.alias("status"))


@query(
    "SELECT probe_id, CASE WHEN canonical_url IS NULL OR NOT regexp_matches(canonical_url, '^(?i)https?://') THEN 'no_url' WHEN NOT regexp_matches(lower(canonical_url), '^https?://([^/]*[.])?(timtho|viecmoi)[.]example(/|$)') THEN 'other_host' "
    "WHEN regexp_matches(canonical_url, '^https?://[^/]*/viec/ky-su') THEN 'denied_path' ELSE 'allowed' END AS scope FROM probe_records"
)
def e9_url_scope(spark, d):
    """Which addresses a reader of two boards may follow."""
    return table(spark, d, "probe_records").select("probe_id", html.url_scope(F.col("canonical_url"), ("timtho.example", "viecmoi.example"), ("/viec/ky-su",)).alias("scope"))


# --- joins, sets, reports ----------------------------------------------------------------------


@query("SELECT a.doc_id, a.lang, b.source, true AS same_key FROM documents a JOIN documents b USING (doc_id)")
def f2_positional_join(spark, d):
    """Two projections of a table joined by their place in the file, and the key verified."""
    rows = tables.numbered(spark, f"{d}/documents.parquet")
    a = rows.select("file_name", "row_index", "doc_id", "lang")
    b = rows.select("file_name", "row_index", F.col("doc_id").alias("other"), "source")
    return a.join(b, ["file_name", "row_index"]).select("doc_id", "lang", "source", (F.col("doc_id") == F.col("other")).alias("same_key"))


@query("SELECT count(*) AS pairs, sum(CASE WHEN c.record_key <> a.record_key THEN 1 ELSE 0 END) AS other_key, (SELECT count(*) FROM core_rows) - count(*) AS only_core, (SELECT count(*) FROM salary_audit) - count(*) AS only_audit FROM core_rows c JOIN salary_audit a ON c.id = a.id")
def f3_paired_streams(spark, d):
    """Two tables that must run side by side, paired by key instead of by order."""
    c, a = table(spark, d, "core_rows").select("id", "record_key"), table(spark, d, "salary_audit").select("id", "record_key")
    r = joins.strict_check(c, a, "id", ["record_key"])
    return r.select(F.col("matched").alias("pairs"), F.col("disagreeing").alias("other_key"), F.col("only_left").alias("only_core"), F.col("only_right").alias("only_audit"))


@query(
    f"""WITH p AS (SELECT DISTINCT {strip_sql('detailed_work_address')} AS a, {strip_sql('location_raw')} AS l FROM probe_records WHERE {strip_sql('detailed_work_address')} <> ''),
k AS (SELECT a, count(l) AS places, min(l) AS place FROM p WHERE l <> '' GROUP BY 1)
SELECT r.probe_id, k.place FROM probe_records r JOIN k ON {strip_sql('r.detailed_work_address')} = k.a WHERE coalesce({strip_sql('r.location_raw')}, '') = '' AND k.places = 1"""
)
def f9_same_text_links(spark, d):
    """Records without location whose address stands elsewhere with one location only: they take it; where it stands with several, none does."""
    clean = lambda c: tx.collapse(F.col(c))
    rows = table(spark, d, "probe_records").select("probe_id", clean("detailed_work_address").alias("a"), clean("location_raw").alias("l"))
    known = rows.where("a <> '' and l <> ''").select("a", "l").distinct().groupBy("a").agg(F.count("l").alias("places"), F.min("l").alias("place")).where("places = 1")
    return rows.where("coalesce(l, '') = ''").join(known, "a").select("probe_id", "place")


@query(
    "SELECT load_id, sum(CASE WHEN coalesce(trim(job_title), '') = '' THEN 1 ELSE 0 END) AS no_title, sum(CASE WHEN coalesce(trim(company_name), '') = '' THEN 1 ELSE 0 END) AS no_company, count(*) AS n_rows, count(*) - count(DISTINCT id) AS repeated_ids, "
    "30 * avg(CASE WHEN trim(job_title) <> '' THEN 1.0 ELSE 0 END) + 30 * avg(CASE WHEN trim(company_name) <> '' THEN 1.0 ELSE 0 END) + 25 * avg(CASE WHEN trim(salary) <> '' THEN 1.0 ELSE 0 END) + 10 * avg(CASE WHEN trim(location) <> '' THEN 1.0 ELSE 0 END) "
    "+ 5 * avg(CASE WHEN trim(benefits) <> '' THEN 1.0 ELSE 0 END) AS score FROM source_rows GROUP BY 1"
)
def g13_status_summary(spark, d):
    """Per load: rows, repeated ids, missing core fields, and a score of completeness."""
    held = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    weights = {"job_title": 30, "company_name": 30, "salary": 25, "location": 10, "benefits": 5}
    score = reduce(lambda x, y: x + y, [F.lit(float(w)) * F.avg(F.when(held(c), 1.0).otherwise(0.0)) for c, w in weights.items()])
    return table(spark, d, "source_rows").groupBy("load_id").agg(
        F.count_if(~held("job_title")).alias("no_title"), F.count_if(~held("company_name")).alias("no_company"), F.count(F.lit(1)).alias("n_rows"), (F.count(F.lit(1)) - F.count_distinct("id")).alias("repeated_ids"), score.alias("score")
    )


_KEYS9 = ["status", "kind", "currency", "period", "component", "min_inclusive", "max_inclusive", "salary_numeric_eligible", "analysis_selected"]


@query(f"SELECT {', '.join(_KEYS9)}, count(*) AS n, min(id) AS example FROM salary_audit GROUP BY {', '.join(_KEYS9)}")
def g6_audit_histogram(spark, d):
    """The audit by all nine of its state columns, with the least example of each."""
    return table(spark, d, "salary_audit").groupBy(*_KEYS9).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("example"))


@query(
    "WITH a AS (SELECT DISTINCT probe_id, unnest(category_tags) AS tag FROM probe_records), b AS (SELECT DISTINCT probe_id, unnest(specialization_tags) AS tag FROM probe_records) "
    "SELECT 'added' AS side, tag, count(*) AS n FROM (SELECT * FROM b EXCEPT SELECT * FROM a) GROUP BY 2 UNION ALL SELECT 'removed', tag, count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b) GROUP BY 2 "
    "UNION ALL SELECT 'kept', tag, count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b) GROUP BY 2"
)
def i4_set_arithmetic(spark, d):
    """Two sets of claims (record, tag): what the second adds, removes and keeps."""
    one = lambda c: table(spark, d, "probe_records").select("probe_id", F.explode(c).alias("tag")).distinct()
    a, b = one("category_tags"), one("specialization_tags")
    count = lambda df, side: df.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).select(F.lit(side).alias("side"), "tag", "n")
    return count(b.subtract(a), "added").unionByName(count(a.subtract(b), "removed")).unionByName(count(a.intersect(b), "kept"))


@query(
    "SELECT (SELECT count(*) FROM salary_audit WHERE id NOT IN (SELECT id FROM jobs)) AS orphans_audit, (SELECT count(*) FROM (SELECT id FROM jobs GROUP BY 1 HAVING count(*) > 1)) AS repeated, 0 AS missing, 0 AS extra, 0 AS modified"
)
def j7_read_back(spark, d):
    """Jobs published, read back and held against what was staged."""
    columns = ["job_title", "company_name", "salary_min", "year"]
    staged, path = table(spark, d, "jobs").select("id", *columns), _fresh(spark, "published")
    publish.stage_and_verify(staged, path, ["id", *columns])
    r = publish.read_back(spark.read.schema(staged.schema).parquet(path), staged, "id", columns, {"audit": (table(spark, d, "salary_audit"), "id")})
    return r.groupBy().pivot("rule", ["orphans_audit", "repeated", "missing", "extra", "modified"]).agg(F.max("breaks"))


@query("SELECT 'documents.parquet' AS name, 'same' AS state UNION ALL SELECT 'ref_values.parquet', 'same'")
def j2_unchanged_inputs(spark, d):
    """The hashes of a run's inputs before and after it."""
    hashes = lambda: tables.file_hashes(spark, f"{d}/ref_values.parquet").unionByName(tables.file_hashes(spark, f"{d}/documents.parquet"))
    return publish.unchanged_inputs(hashes(), hashes())


@query("SELECT 2 AS first_run, 0 AS second_run, (SELECT count(*) FROM ref_values) AS n_rows")
def j3_migrations(spark, d):
    """Two migrations run once and known the second time."""
    root, name = _fresh(spark, "ledger"), f"m{uuid.uuid4().hex}"
    steps = [("001", f"CREATE TABLE {name} (ref_id BIGINT) USING parquet LOCATION '{root}/{name}'"), ("002", f"INSERT INTO {name} SELECT ref_id FROM parquet.`{d}/ref_values.parquet`")]
    first, second = publish.migrate(spark, root, steps), publish.migrate(spark, root, steps)
    return spark.table(name).agg(F.lit(len(first)).alias("first_run"), F.lit(len(second)).alias("second_run"), F.count(F.lit(1)).alias("n_rows"))


@query(
    "WITH r AS (SELECT id, salary AS raw, year FROM source_rows), a AS (SELECT id, salary AS raw FROM salary_audit) SELECT CASE WHEN a.id IS NULL THEN 'unlabelled' WHEN r.id IS NULL THEN 'unknown_key' WHEN a.raw IS NULL AND r.raw IS NULL THEN 'no_text' "
    "WHEN contains(r.raw, a.raw) THEN 'quoted' ELSE 'not_in_text' END AS state, count(*) AS n FROM r FULL OUTER JOIN a ON r.id = a.id GROUP BY 1"
)
def x5_label_evidence(spark, d):
    """Labels held against the texts they quote: every row labelled, every quotation a part of its text."""
    r, a = table(spark, d, "source_rows").select("id", F.col("salary").alias("raw")), table(spark, d, "salary_audit").select(F.col("id").alias("aid"), F.col("salary").alias("quote"))
    s = F.when(F.col("aid").isNull(), "unlabelled").when(F.col("id").isNull(), "unknown_key").when(F.col("quote").isNull() & F.col("raw").isNull(), "no_text").when(F.contains("raw", "quote"), "quoted").otherwise("not_in_text")
    return r.join(a, r["id"] == a["aid"], "full_outer").groupBy(s.alias("state")).agg(F.count(F.lit(1)).alias("n"))


# --- pages -------------------------------------------------------------------------------------


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """Saved pages of the probe: JSON-LD in a graph, page state, component stream, heading."""
    p = table(spark, d, "probe_records")
    plain = lambda c: F.replace(F.to_json(c, {"ignoreNullFields": "true"}), F.lit("</"), F.lit("<\\/"))
    posting = F.struct(F.lit("JobPosting").alias("@type"), F.col("job_title").alias("title"), F.struct(F.col("company_name").alias("name")).alias("hiringOrganization"), F.struct(F.struct(F.col("location_raw").alias("addressRegion")).alias("address")).alias("jobLocation"), F.date_format("crawled_at", "yyyy-MM-dd").alias("datePosted"))
    graph = plain(F.struct(F.array(posting).alias("@graph")))
    page_state = plain(F.struct(F.struct(F.struct(F.col("source_job_id").alias("id"), F.col("job_title").alias("title")).alias("job")).alias("props")))
    rows = F.concat(F.lit('0:{"job":"$1"}\n1:'), F.to_json(F.struct(F.lit("$2").alias("title"), F.col("source_job_id").alias("id"))), F.lit("\n2:"), F.coalesce(F.to_json(F.struct(F.col("job_title").alias("text"))), F.lit("{}")))
    escaped = F.replace(F.replace("job_title", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    body = F.concat(F.lit("<h1>"), F.coalesce(escaped, F.lit("")), F.lit('</h1><script type="application/ld+json">'), graph, F.lit('</script><script id="__NEXT_DATA__" type="application/json">'), page_state, F.lit("</script>"))
    return p.select("probe_id", "source_job_id", "job_title", "company_name", "location_raw", body.alias("body"), rows.alias("stream"))



def _spaced_sql(c: str) -> str:
    return f"nullif({strip_sql(c)}, '')"


@query(f"SELECT probe_id, {_spaced_sql('job_title')} AS title, {_spaced_sql('company_name')} AS company, {_spaced_sql('location_raw')} AS location, CAST(NULL AS VARCHAR) AS error FROM probe_records")
def l2_details(spark, d):
    """The fields of every saved page out of its embedded posting."""
    r = _pages(spark, d).select("probe_id", html.detail(F.col("body")).alias("p"))
    return r.select("probe_id", "p.title", "p.company", "p.location", "p.error")


@query("SELECT probe_id, source_job_id AS job_id, job_title AS title FROM probe_records")
def l4_page_state(spark, d):
    """Values of the state that is embedded in a page."""
    b = _pages(spark, d)
    return b.select("probe_id", html.next_data(F.col("body"), "$.props.job.id").alias("job_id"), html.next_data(F.col("body"), "$.props.job.title").alias("title"))


@query("SELECT probe_id, source_job_id AS job_id, job_title AS title FROM probe_records")
def l5_component_stream(spark, d):
    """Values of a stream of components, references followed."""
    b = _pages(spark, d)
    return b.select("probe_id", html.flight(F.col("stream"), "0.job.id").alias("job_id"), html.flight(F.col("stream"), "0.job.title.text").alias("title"))


@query("SELECT count(*) AS pages, 0 AS title_differs, 0 AS company_differs, 0 AS heading_differs FROM probe_records")
def l8_extraction_audit(spark, d):
    """Pages read again and held against the stored fields, and their heading against the embedded title."""
    r = _pages(spark, d).select("*", html.detail(F.col("body")).alias("p"))
    spaced = lambda c: F.nullif(tx.collapse(F.col(c)), F.lit(""))
    return r.agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(~spaced("job_title").eqNullSafe(F.col("p.title"))).alias("title_differs"), F.count_if(~spaced("company_name").eqNullSafe(F.col("p.company"))).alias("company_differs"),
        F.count_if(~F.col("p.heading").eqNullSafe(F.col("p.title"))).alias("heading_differs"),
    )


@query("SELECT doc_id, coalesce(regexp_matches(lower(text), 'just a moment|verify you are human|captcha|access denied|xác minh bạn là con người|attention required'), false) AS challenged FROM documents")
def x7_challenge_pages(spark, d):
    """Which texts ask their reader to prove to be human."""
    return table(spark, d, "documents").select("doc_id", html.challenge(F.lit(None).cast("string"), F.col("text")).alias("challenged"))


@query("SELECT probe_id % 4 AS kind, CASE probe_id % 4 WHEN 0 THEN 'next_link' WHEN 1 THEN 'page_parameter' WHEN 2 THEN 'load_more' ELSE 'none' END AS pagination, count(*) AS n FROM probe_records GROUP BY 1, 2")
def x12_pagination(spark, d):
    """How listings say that more follows."""
    forms = ['<a class="x" rel="next" href="/p/2">2</a>', '<a href="/viec?page=2">2</a>', "<button>Xem thêm</button>", "<p>x</p>"]
    body = F.element_at(F.array(*[F.lit(x) for x in forms]), (F.col("probe_id") % 4 + 1).cast("int"))
    return table(spark, d, "probe_records").groupBy((F.col("probe_id") % 4).alias("kind"), html.pagination(body).alias("pagination")).agg(F.count(F.lit(1)).alias("n"))


# --- state -------------------------------------------------------------------------------------


@query("SELECT id FROM source_rows WHERE id NOT IN (SELECT id FROM core_rows)")
def m5_outstanding(spark, d):
    """What is still to do of a queue when the written rows are the authority."""
    return state.outstanding(table(spark, d, "source_rows").select("id"), table(spark, d, "core_rows"), "id")


@query(
    """WITH c AS (SELECT *, CASE WHEN row_number() OVER w = 1 THEN 'new' WHEN lag(content_hash) OVER w IS NOT DISTINCT FROM content_hash THEN 'unchanged' ELSE 'changed' END AS change
FROM probe_records WINDOW w AS (PARTITION BY source_name, source_job_id ORDER BY crawled_at, probe_id))
SELECT source_name, count(*) AS n_rows, sum(CASE WHEN change = 'new' THEN 1 ELSE 0 END) AS new, sum(CASE WHEN change = 'unchanged' THEN 1 ELSE 0 END) AS unchanged, sum(CASE WHEN change = 'changed' THEN 1 ELSE 0 END) AS changed,
  sum(CASE WHEN coalesce(trim(salary_raw), '') = '' THEN 1 ELSE 0 END) AS missing_salary_raw, sum(CASE WHEN coalesce(trim(location_raw), '') = '' THEN 1 ELSE 0 END) AS missing_location_raw FROM c GROUP BY 1"""
)
def m7_change_counters(spark, d):
    """Per board: how many records are new, unchanged and changed, and how many lack a field."""
    e = table(spark, d, "probe_records").withColumn("key", F.struct("source_name", "source_job_id"))
    return state.change_counters(state.content_changes(e, "key", "crawled_at", "content_hash", "probe_id"), "source_name", ("salary_raw", "location_raw"))


# --- reviews -----------------------------------------------------------------------------------


@query("SELECT 'verified' AS state, (SELECT count(*) FROM jobs) AS n_rows")
def x3_lineage(spark, d):
    """A published folder held against its manifest."""
    path = _fresh(spark, "lineage")
    publish.stage_and_verify(table(spark, d, "jobs").select("id", "job_title"), path, ["id", "job_title"])
    return publish.verify_lineage(spark, path).select("state", "n_rows")


_CLAUSE = "'[^.;\\n]*(?:python|sql)[^.;\\n]*'"
_NO_SQL = r"không\s+(?:yêu cầu|cần|đòi hỏi|bắt buộc)|chưa\s+(?:biết|có kinh nghiệm)|(?:not|isn''t|aren''t)\s+(?:required|mandatory|necessary)|no need"
_BETTER_SQL = r"ưu tiên|lợi thế|điểm cộng|ưu thế|preferred|nice[ -]to[ -]have|\bplus\b|advantage|bonus"


@query(
    f"""WITH q AS (SELECT doc_id, text, nullif(trim(regexp_extract(lower(text), {_CLAUSE})), '') AS quote FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CASE WHEN quote IS NULL OR NOT contains(lower(text), quote) THEN 'not_quoted' WHEN NOT regexp_matches(quote, '(^|[^\\p{{L}}\\p{{N}}_])sql($|[^\\p{{L}}\\p{{N}}_])') THEN 'no_match'
  WHEN regexp_matches(quote, '{_NO_SQL}') AND regexp_matches(quote, '{_BETTER_SQL}') THEN 'unclear' WHEN regexp_matches(quote, '{_NO_SQL}') THEN 'rejected' ELSE 'accepted' END AS verdict FROM q"""
)
def k11_proposals(spark, d):
    """Clauses proposed as evidence of SQL, assessed against their documents."""
    low = table(spark, d, "documents").where("text is not null").select("doc_id", F.lower("text").alias("text"))
    quoted = low.withColumn("quote", F.nullif(F.trim(F.regexp_extract("text", r"[^.;\n]*(?:python|sql)[^.;\n]*", 0)), F.lit("")))
    return matching.assess(quoted, "text", "quote", r"(?U)\bsql\b").select("doc_id", "verdict")


@query()
def k10_derived_parents(spark, d):
    """Skills of every document with those they imply."""
    from gleanery.plans.reference import IMPLIED, SKILLS

    found = matching.pairs(matching.match_texts(table(spark, d, "documents"), "doc_id", "text", SKILLS, IMPLIED), "doc_id")
    return matching.with_parents(found, "doc_id", IMPLIED)


@query()
def j10_closed_reviews(spark, d):
    """Documents by status before and after their reviews are closed."""
    from gleanery.plans.reference import IMPLIED, SKILLS

    matched = matching.match_texts(table(spark, d, "documents"), "doc_id", "text", SKILLS, IMPLIED).withColumn("before", F.col("status"))
    return matching.close_reviews(matched).groupBy("before", "status", "closed").agg(F.count(F.lit(1)).alias("n"))
