"""Queries of the record-curation operators, each with the SQL that says the same where SQL can."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions import text as tx
from gleanery.operators import aggregates, grammar, identity, joins, labels, matching, profiling, publish, sampling
from gleanery.plans.training import RAW_COLUMNS
from gleanery.session import shared_dir, small, table
from gleanery.sources import html, tables
from gleanery.streaming import state

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
CONTENT = [c for c in RAW_COLUMNS if c != "id"]
COUNTED = ["salary", "job_type", "job_industry", "experience_level", "education_level", "job_position", "year"]
# Words that stand for "not stated" in the raw columns, lower case.
SENTINELS = ("không", "chưa xác định", "chưa cập nhật", "đang cập nhật", "khác", "nghề nghiệp khác")
# Labels of education and employment type.
EDUCATION = [
    ("Không", None, "ambiguous_literal"), ("Cao đẳng", "college", "mapped"), ("Đại học", "bachelor", "mapped"), ("Trung cấp", "vocational", "mapped"),
    ("Trung học", "secondary_unspecified", "mapped"), ("Chứng chỉ", "certificate_unspecified", "mapped"), ("Cử nhân", "bachelor", "mapped"), ("Khác", "other", "other"),
    ("Kỹ sư", None, "ambiguous_degree_label"), ("Bằng cấp liên quan", "related_unspecified", "mapped"), ("Không yêu cầu bằng cấp", None, "no_requirement"),
]
JOB_TYPES = {"Toàn thời gian": "full_time", "Bán thời gian": "part_time", "Thực tập": "internship", "Thời vụ": "temporary", "Hợp đồng": "contract", "Freelance": "freelance"}
OTHER_TYPES = {"Remote": "remote", "Từ xa": "remote", "Theo ca": "shift"}
# A small dictionary of tools and skills.
SKILLS = [
    ("sql", "SQL"), ("python", "Python"), ("pivotix", "Pivotix"), ("lumetra", "Lumetra"), ("kestrel_erp", "Kestrel ERP"), ("orbiton_crm", "Orbiton CRM"), ("crm", "CRM"), ("figtree", "Figtree"),
    ("zoran", "phần mềm kho Zoran"), ("harrow", "hệ thống vé Harrow"), ("cnc", "máy CNC"), ("cnc", "CNC"), ("forklift", "xe nâng"), ("scale", "cân điện tử"), ("spreadsheet", "bảng tính"), ("ro_filter", "bộ lọc RO"),
    ("multimeter", "đồng hồ vạn năng"), matching.Alias("rest_api", "REST", needs=r"\bAPI\b|HTTP|tích hợp"), matching.Alias("office", "office", not_before=r"\b(?:front|back|head)[ -]*", doubtful=True), ("spectrometer", "máy đo quang phổ"), ("english", "tiếng Anh"), ("topik", "TOPIK"),
]
IMPLIED = {"orbiton_crm": ("crm",)}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _strip_sql(c: str) -> str:
    return f"trim(regexp_replace({c}, '[\\s\\x{{0085}}\\x{{00a0}}\\x{{1680}}\\x{{2028}}\\x{{2029}}\\x{{205f}}\\x{{2000}}-\\x{{200a}}\\x{{202f}}\\x{{3000}}]+', ' ', 'g'))"


def _json_sql(columns: list[str], numbers: tuple[str, ...] = ("year",)) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), 'null')" if c in numbers else f"coalesce(CAST(to_json({c}) AS VARCHAR), 'null')" for c in columns]
    return "'[' || " + " || ',' || ".join(parts) + " || ']'"


FINGERPRINT = f"sha256({_json_sql(CONTENT)})"

# --- scans, sources, sinks ---------------------------------------------------------------------


@query("SELECT doc_id, lang, n_chars FROM documents WHERE n_chars >= 500 AND lang = 'en'")
def a1_projected_scan(spark, d):
    return table(spark, d, "documents").where("n_chars >= 500 and lang = 'en'").select("doc_id", "lang", "n_chars")


@query(
    "SELECT count(*) AS n_rows, count(DISTINCT id) AS distinct_keys, sum(CASE WHEN id IS NULL OR id <= 0 THEN 1 ELSE 0 END) AS bad_keys, "
    "sum(CASE WHEN year IS NULL OR year NOT BETWEEN 2022 AND 2026 THEN 1 ELSE 0 END) AS bad_years FROM source_rows"
)
def a3_artifact_checks(spark, d):
    return tables.artifact_checks(table(spark, d, "source_rows"), "id", "year", (2022, 2026))


def _round_trip(spark, d, name, columns, fmt):
    return tables.write_read(table(spark, d, name).select(*columns), f"{shared_dir(spark)}/{fmt}-{uuid.uuid4().hex}", fmt)


@query("SELECT id, job_title, year FROM source_rows")
def a4_parquet_round_trip(spark, d):
    return _round_trip(spark, d, "source_rows", ["id", "job_title", "year"], "parquet")


@query("SELECT id, location, year FROM source_rows")
def a5_csv_round_trip(spark, d):
    return _round_trip(spark, d, "source_rows", ["id", "location", "year"], "csv")


@query("SELECT id, benefits, year FROM source_rows")
def a6_json_round_trip(spark, d):
    return _round_trip(spark, d, "source_rows", ["id", "benefits", "year"], "json")


@query("SELECT field_name, count(*) AS n, count(DISTINCT label_vi) AS names, count(ref_code) AS codes FROM ref_values GROUP BY 1")
def a10_rule_table_checks(spark, d):
    refs = table(spark, d, "ref_values")
    return refs.groupBy("field_name").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("label_vi").alias("names"), F.count("ref_code").alias("codes"))


@query("SELECT year, CAST(vnd_per_usd AS DOUBLE) AS rate, date_diff('day', period_start, period_end) + 1 AS days, provisional, approved FROM fx_rates WHERE approved")
def a9_rate_source(spark, d):
    r = table(spark, d, "fx_rates").where("approved")
    return r.select("year", F.col("vnd_per_usd").cast("double").alias("rate"), (F.date_diff("period_end", "period_start") + 1).alias("days"), "provisional", "approved")


@query("SELECT s.load_id, s.id FROM source_rows s JOIN (SELECT max(load_id) AS m FROM source_rows) x ON s.load_id = x.m")
def a15_latest_batch(spark, d):
    return tables.latest_rows(table(spark, d, "source_rows").select("load_id", "id"), "load_id")


@query()
def b1_file_hashes(spark, d):
    return tables.file_hashes(spark, f"{d}/*.parquet")


# --- identity and profiles ---------------------------------------------------------------------


@query()
def b2_row_keys(spark, d):
    df = tables.numbered(spark, f"{d}/documents.parquet").select("doc_id", "file_name", "row_index")
    return identity.row_keys(df, F.sha2("file_name", 256), F.col("row_index")).select("doc_id", "record_key")


@query(f"SELECT id, {FINGERPRINT} AS fingerprint FROM source_rows")
def b3_content_fingerprint(spark, d):
    df = table(spark, d, "source_rows")
    return df.select("id", identity.fingerprint(df, CONTENT).alias("fingerprint"))


@query(
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS nulls, "
        f"coalesce(sum(CASE WHEN {_strip_sql(f'CAST({c} AS VARCHAR)')} = '' THEN 1 ELSE 0 END), 0) AS blanks, count(DISTINCT {c}) AS distinct_values, "
        f"coalesce(sum(CASE WHEN lower({_strip_sql(f'CAST({c} AS VARCHAR)')}) IN ({', '.join(repr(s) for s in SENTINELS)}) THEN 1 ELSE 0 END), 0) AS sentinel_hits FROM source_rows"
        for c in RAW_COLUMNS
    )
    + ")"
)
def b4_field_profile(spark, d):
    return profiling.field_profile(table(spark, d, "source_rows"), RAW_COLUMNS, SENTINELS)


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM source_rows GROUP BY {c}" for c in COUNTED))
def b5_value_counts(spark, d):
    return profiling.value_counts(table(spark, d, "source_rows"), COUNTED)


@query("SELECT job_industry, year, count(*) AS n FROM source_rows GROUP BY 1, 2")
def b6_cross_counts(spark, d):
    return profiling.cross_counts(table(spark, d, "source_rows"), "job_industry", "year")


@query(
    "WITH p AS (SELECT doc_id, count(*) AS n FROM documents GROUP BY 1) SELECT sum(n) AS n_rows, count(doc_id) AS distinct_keys, "
    "sum(CASE WHEN n > 1 AND doc_id IS NOT NULL THEN 1 ELSE 0 END) AS repeated_keys, coalesce(sum(CASE WHEN doc_id IS NULL THEN n END), 0) AS null_keys, "
    "min(doc_id) AS least, max(doc_id) AS greatest FROM p"
)
def b7_key_checks(spark, d):
    return profiling.key_checks(table(spark, d, "documents"), "doc_id")


_GROUPS = f"SELECT {FINGERPRINT} AS fingerprint, count(*) AS n_rows, min(id) AS first_member FROM source_rows GROUP BY 1 HAVING count(*) > 1"


@query(_GROUPS)
def b8_duplicate_groups(spark, d):
    return identity.duplicate_groups(table(spark, d, "source_rows"), CONTENT, "id")


@query(f"SELECT s.fingerprint, s.id FROM (SELECT {FINGERPRINT} AS fingerprint, id FROM source_rows) s WHERE s.fingerprint IN (SELECT fingerprint FROM ({_GROUPS}))")
def b8_duplicate_members(spark, d):
    return identity.duplicate_members(table(spark, d, "source_rows"), CONTENT, "id")


@query(
    f"""WITH g AS ({_GROUPS}), t AS (SELECT *, row_number() OVER (ORDER BY n_rows DESC, first_member) AS r FROM g),
  a AS (SELECT fingerprint, n_rows, first_member, r AS place FROM t WHERE r <= 50),
  b AS (SELECT fingerprint, n_rows, first_member, 50 + row_number() OVER (ORDER BY fingerprint) AS place FROM t WHERE r > 50)
SELECT * FROM a UNION ALL SELECT * FROM b WHERE place <= 100"""
)
def b9_review_sample(spark, d):
    return identity.review_sample(identity.duplicate_groups(table(spark, d, "source_rows"), CONTENT, "id"))


@query(
    "SELECT field, CASE t WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'VARCHAR' THEN 'STRING' ELSE t END AS type, count(*) AS n, count(DISTINCT v) AS distinct_values FROM (SELECT k AS field, json_type(props, '$.' || k) AS t, CAST(json_extract(props, '$.' || k) AS VARCHAR) AS v "
    "FROM (SELECT props, unnest(json_keys(props)) AS k FROM events WHERE props IS NOT NULL)) GROUP BY 1, 2 UNION ALL SELECT '<null>', NULL, count(*), NULL FROM events WHERE props IS NULL HAVING count(*) > 0"
)
def b10_json_shapes(spark, d):
    """The fields of the events' properties with their types."""
    return profiling.json_shapes(table(spark, d, "events"), "props")


_SHAPE = f"""CASE WHEN coalesce(t, '') = '' THEN 'missing' WHEN regexp_matches(t, 'thỏa thuận|thoả thuận|cạnh tranh|negotiable|năng lực') THEN 'negotiable'
  WHEN NOT regexp_matches(t, '[0-9]') THEN 'other' WHEN regexp_matches(t, '[0-9][^0-9]*(-|–|~|đến)[^0-9]*[0-9]') THEN 'range'
  WHEN regexp_matches(t, '^(từ|trên|dưới|đến|tới|lên đến|upto|from|tối thiểu|tối đa|<=|>=)') THEN 'bound' ELSE 'number' END"""


@query(
    f"SELECT {_SHAPE} AS shape, count(*) AS n, min(length(salary)) AS shortest, CAST(median(length(salary)) AS DOUBLE) AS middle, max(length(salary)) AS longest "
    f"FROM (SELECT salary, lower({_strip_sql('salary')}) AS t FROM source_rows) GROUP BY 1"
)
def b11_salary_shapes(spark, d):
    size = F.length("salary")
    return (
        table(spark, d, "source_rows").groupBy(grammar.salary_shape(F.col("salary")).alias("shape")).agg(F.count(F.lit(1)).alias("n"), F.min(size).alias("shortest"), F.median(size).alias("middle"), F.max(size).alias("longest"))
    )


_HASHED = ("application_deadline", "benefits", "candidate_requirements", "company_name", "job_description", "job_title", "location_raw", "salary_raw")


@query(
    "SELECT probe_id, sha256('[' || " + " || ',' || ".join("coalesce(CAST(to_json(benefits) AS VARCHAR), 'null')" if c == "benefits" else f"coalesce(CAST(to_json({_strip_sql(c)}) AS VARCHAR), 'null')" for c in _HASHED) + " || ']') AS posting_hash FROM probe_records"
)
def b12_posting_hash(spark, d):
    """A hash of the fields that make a posting, their spacing settled."""
    df = table(spark, d, "probe_records").select("probe_id", *[F.col(c) if c == "benefits" else tx.collapse(F.col(c)).alias(c) for c in _HASHED])
    return df.select("probe_id", identity.fingerprint(df, _HASHED).alias("posting_hash"))


@query(f"SELECT doc_id, sha256(lower({_strip_sql('nfc_normalize(text)')})) AS text_hash FROM documents")
def b13_normalized_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(F.lower(tx.collapse(tx.nfc(F.col("text")))), 256).alias("text_hash"))


@query("SELECT id, [sha256('t:' || coalesce(CAST(to_json(salary) AS VARCHAR), 'null')), sha256('n:' || coalesce(CAST(year AS VARCHAR), 'null'))] AS hashes FROM salary_audit")
def b14_field_hashes(spark, d):
    df = table(spark, d, "salary_audit")
    return df.select("id", identity.field_hashes(df, ["salary", "year"]).alias("hashes"))


@query(
    f"SELECT count(*) AS n_rows, CAST(sum(CAST(('0x' || substr({FINGERPRINT}, 1, 12)) AS BIGINT)::HUGEINT) AS VARCHAR) AS digest FROM source_rows"
)
def b15_table_digest(spark, d):
    return identity.digest(table(spark, d, "source_rows"), CONTENT)


_TEXT_HASH = "sha256('[' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ']')"


@query(
    f"""WITH f AS (SELECT *, {_TEXT_HASH} AS h FROM documents), g AS (SELECT h, count(*) AS n, min(doc_id) AS a FROM f GROUP BY 1)
SELECT lang, count(*) AS n_docs, sum(CASE WHEN text IS NULL THEN 1 ELSE 0 END) AS nulls, sum(CASE WHEN g.n > 1 THEN 1 ELSE 0 END) AS in_groups,
  sum(CASE WHEN g.a <> f.doc_id THEN 1 ELSE 0 END) AS surplus, sum(n_chars) AS chars FROM f JOIN g ON f.h = g.h GROUP BY 1"""
)
def b_duplicate_aware_profile(spark, d):
    """Documents by language, with how many stand in duplicate groups and how many are surplus copies."""
    df = table(spark, d, "documents")
    keyed = df.select("doc_id", "lang", "n_chars", F.col("text").isNull().alias("void"), identity.fingerprint(df, ["text"]).alias("h"))
    groups = keyed.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("a"))
    return keyed.join(groups, "h").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if("void").alias("nulls"), F.count_if(F.col("n") > 1).alias("in_groups"), F.count_if(F.col("a") != F.col("doc_id")).alias("surplus"), F.sum("n_chars").alias("chars")
    )


# --- text, labels ------------------------------------------------------------------------------


@query()
def c1_normalized_text(spark, d):
    return table(spark, d, "source_rows").select("id", tx.normalize(F.col("job_title"), short=True).alias("r")).select("id", "r.*")


@query(
    f"SELECT id, CASE WHEN t IS NULL OR t = '' THEN 'missing' WHEN t = '.' THEN 'placeholder' WHEN lower(t) = 'không' THEN 'ambiguous_literal' "
    f"WHEN lower(t) = 'khác' THEN 'other_unspecified' ELSE 'present' END AS status FROM (SELECT id, {_strip_sql('requirements')} AS t FROM source_rows)"
)
def c2_content_status(spark, d):
    t = tx.collapse(F.col("requirements"))
    s = F.when(F.coalesce(t, F.lit("")) == "", "missing").when(t == ".", "placeholder").when(F.lower(t) == "không", "ambiguous_literal").when(F.lower(t) == "khác", "other_unspecified")
    return table(spark, d, "source_rows").select("id", s.otherwise("present").alias("status"))


_EDUCATION_SQL = ", ".join(f"('{a.lower()}', {repr(b) if b else 'NULL'}, '{c}')" for a, b, c in EDUCATION)


@query(
    f"""WITH m(label, category, status) AS (VALUES {_EDUCATION_SQL}), s AS (SELECT id, lower({_strip_sql('education_level')}) AS k FROM source_rows)
SELECT id, category, CASE WHEN coalesce(k, '') = '' THEN 'missing' WHEN m.label IS NULL THEN 'unmapped' ELSE m.status END AS status FROM s LEFT JOIN m ON k = m.label"""
)
def c4_education_category(spark, d):
    m = spark.createDataFrame(EDUCATION, "label string, category string, status string")
    return labels.look_up(table(spark, d, "source_rows").select("id", "education_level"), "education_level", m).select("id", "category", "status")


_KNOWN = ", ".join(f"'{k.lower()}'" for k in (*JOB_TYPES, *OTHER_TYPES))
_TYPE_CASE = "CASE x " + " ".join(f"WHEN '{k.lower()}' THEN '{v}'" for k, v in JOB_TYPES.items()) + " END"


@query(
    f"""WITH p AS (SELECT id, list_filter(list_transform(string_split(job_type, ','), lambda x: lower({_strip_sql('x')})), lambda x: x <> '') AS parts FROM source_rows),
  q AS (SELECT id, parts, list_sort(list_distinct(list_filter(list_transform(parts, lambda x: {_TYPE_CASE}), lambda x: x IS NOT NULL))) AS types,
    len(list_filter(parts, lambda x: x NOT IN ({_KNOWN}))) AS odd, len(list_filter(parts, lambda x: x IN ({_KNOWN}))) AS fine FROM p)
SELECT id, coalesce(array_to_string(types, '|'), '') AS types, CASE WHEN len(types) > 1 THEN 'multiple' WHEN len(types) = 1 THEN types[1] ELSE 'unknown' END AS label_group,
  CASE WHEN parts IS NULL OR len(parts) = 0 THEN 'missing' WHEN odd > 0 AND fine > 0 THEN 'partial' WHEN odd > 0 THEN 'unmapped' ELSE 'mapped' END AS status FROM q"""
)
def c5_job_types(spark, d):
    r = table(spark, d, "source_rows").select("id", labels.multi_label(F.col("job_type"), JOB_TYPES, OTHER_TYPES).alias("r"))
    return r.select("id", F.coalesce(F.array_join("r.types", "|"), F.lit("")).alias("types"), "r.label_group", "r.status")


@query(
    f"""WITH p AS (SELECT lower(c) AS key, c AS spelling, count(*) AS n FROM (SELECT {_strip_sql('company_name')} AS c FROM source_rows) WHERE c <> '' GROUP BY 1, 2),
  r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n DESC, spelling) AS i FROM p)
SELECT key, max(CASE WHEN i = 1 THEN spelling END) AS spelling, count(*) AS n_spellings, sum(n) AS n_rows FROM r GROUP BY 1"""
)
def c7_preferred_spelling(spark, d):
    return labels.preferred_spelling(table(spark, d, "source_rows"), "company_name")


@query(
    f"""WITH s AS (SELECT DISTINCT job_industry, lower({_strip_sql('job_industry')}) AS k FROM source_rows WHERE job_industry IS NOT NULL)
SELECT job_industry, CASE WHEN regexp_matches(k, '[,;()\\[\\]]') THEN 'ordered:' || k
  ELSE 'set:' || coalesce(array_to_string(list_sort(list_filter(list_transform(string_split(k, '/'), lambda x: trim(x)), lambda x: x <> '')), '/'), '') END AS key FROM s"""
)
def c9_equivalence_key(spark, d):
    return table(spark, d, "source_rows").where("job_industry is not null").select("job_industry").distinct().select("job_industry", labels.equivalence_key(F.col("job_industry")).alias("key"))


_EDGES = (
    "SELECT 'c' || c_custkey AS child, 'n' || c_nationkey AS parent FROM customer UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION ALL SELECT 'r' || r_regionkey, 'world' FROM region"
)


@query(
    f"""WITH RECURSIVE e AS ({_EDGES}), w(label, root, steps) AS (SELECT child, parent, 1 FROM e UNION ALL SELECT w.label, e.parent, w.steps + 1 FROM w JOIN e ON e.child = w.root)
SELECT label, arg_max(root, steps) AS root, max(steps) AS steps FROM w GROUP BY 1 UNION ALL SELECT 'world', 'world', 0"""
)
def c10_roll_up(spark, d):
    edge = lambda t, a, x, b, y: table(spark, d, t).select(F.concat(F.lit(x), F.col(a).cast("string")).alias("child"), F.concat(F.lit(y), F.col(b).cast("string") if b else F.lit("")).alias("parent"))
    edges = edge("customer", "c_custkey", "c", "c_nationkey", "n").unionByName(edge("nation", "n_nationkey", "n", "n_regionkey", "r")).unionByName(edge("region", "r_regionkey", "r", None, "world"))
    return labels.roll_up(spark, edges)


@query(
    r"""WITH u AS (SELECT probe_id, canonical_url AS u FROM probe_records)
SELECT probe_id, lower(regexp_extract(u, '^(?i)(https?://[^/?#]+)', 1)) || regexp_replace(regexp_replace(regexp_extract(u, '^(?i)https?://[^/?#]+([^?#]*)', 1), '/{2,}', '/', 'g'), '/$', '') AS url FROM u"""
)
def c11_canonical_url(spark, d):
    return table(spark, d, "probe_records").select("probe_id", tx.canonical_url(F.col("canonical_url")).alias("url"))


# Where each board keeps the id in its addresses.
ID_PATTERNS = {"timtho.example": r"-([0-9]+)/?$", "viecmoi.example": r"/viec/.*-([0-9]+)/?$", "nghechuan.example": r"-([0-9]{3,})/?$"}


@query(
    "SELECT probe_id, id AS job_id, coalesce(id = source_job_id, false) AS agrees FROM (SELECT probe_id, source_job_id, nullif(CASE WHEN regexp_matches(lower(canonical_url), '^https?://([^/]*[.])?timtho[.]example(/|$)') THEN regexp_extract(canonical_url, '-([0-9]+)/?$', 1) "
    "WHEN regexp_matches(lower(canonical_url), '^https?://([^/]*[.])?viecmoi[.]example(/|$)') THEN regexp_extract(canonical_url, '/viec/.*-([0-9]+)/?$', 1) WHEN regexp_matches(lower(canonical_url), '^https?://([^/]*[.])?nghechuan[.]example(/|$)') THEN regexp_extract(canonical_url, '-([0-9]{3,})/?$', 1) END, '') AS id FROM probe_records)"
)
def c12_id_from_url(spark, d):
    """The posting's id out of its address by the pattern of each board; other boards give none."""
    job = tx.id_by_host(F.col("canonical_url"), ID_PATTERNS)
    return table(spark, d, "probe_records").select("probe_id", job.alias("job_id"), F.coalesce(job == F.col("source_job_id"), F.lit(False)).alias("agrees"))


@query(
    "SELECT probe_id, CAST(coalesce(try_strptime(application_deadline, '%Y-%m-%d'), try_strptime(application_deadline, '%d/%m/%Y'), try_strptime(application_deadline, '%d-%m-%Y')) AS DATE) AS deadline FROM probe_records"
)
def c13_source_date(spark, d):
    return table(spark, d, "probe_records").select("probe_id", tx.source_date(F.col("application_deadline")).alias("deadline"))


@query("SELECT probe_id, CAST(crawled_at + INTERVAL 7 HOUR AS DATE) AS day FROM probe_records")
def c15_local_date(spark, d):
    return table(spark, d, "probe_records").select("probe_id", tx.local_date(F.col("crawled_at"), "Asia/Ho_Chi_Minh").alias("day"))


@query("SELECT probe_id, TRY_CAST(nullif(regexp_extract(translate(salary_raw, '.,', ''), '([0-9]+)', 1), '') AS BIGINT) AS n FROM probe_records")
def c16_first_integer(spark, d):
    return table(spark, d, "probe_records").select("probe_id", tx.first_integer(F.col("salary_raw")).alias("n"))


@query(f"SELECT DISTINCT job_industry, strip_accents(replace(lower({_strip_sql('job_industry')}), 'đ', 'd')) AS key FROM source_rows WHERE job_industry IS NOT NULL")
def c17_heading_key(spark, d):
    return table(spark, d, "source_rows").where("job_industry is not null").select("job_industry").distinct().select("job_industry", tx.unaccented(F.col("job_industry")).alias("key"))


# --- grammars ----------------------------------------------------------------------------------

_LOW, _UP = "trên|hơn|>=|>|ít nhất|tối thiểu|không dưới|từ", "dưới|lên đến|<=|<"
_NUM = "([0-9]+(?:[.,][0-9]+)?)"
_RANGE_RX = f"'^(?:từ )?{_NUM} ?(năm|tháng)? ?(?:[-–—]|đến|tới) ?{_NUM} ?(năm|tháng)$'"
_BOUND_RX = f"'^({_LOW}|{_UP})? ?{_NUM} ?(năm|tháng) ?(trở lên|trở xuống)?$'"
_EXPERIENCE = f"""
WITH s AS (SELECT id, regexp_replace(lower({_strip_sql('experience_level')}), ' kinh nghiệm$', '') AS t FROM source_rows),
r AS (SELECT id, t, regexp_matches(t, {_RANGE_RX}) AS ranged, regexp_matches(t, {_BOUND_RX}) AS bounded,
  TRY_CAST(replace(regexp_extract(t, {_RANGE_RX}, 1), ',', '.') AS DOUBLE) AS an, TRY_CAST(replace(regexp_extract(t, {_RANGE_RX}, 3), ',', '.') AS DOUBLE) AS bn, TRY_CAST(replace(regexp_extract(t, {_BOUND_RX}, 2), ',', '.') AS DOUBLE) AS pn,
  CASE WHEN coalesce(nullif(regexp_extract(t, {_RANGE_RX}, 2), ''), regexp_extract(t, {_RANGE_RX}, 4)) = 'năm' THEN 12 ELSE 1 END AS au, CASE WHEN regexp_extract(t, {_RANGE_RX}, 4) = 'năm' THEN 12 ELSE 1 END AS bu,
  CASE WHEN regexp_extract(t, {_BOUND_RX}, 3) = 'năm' THEN 12 ELSE 1 END AS pu, regexp_extract(t, {_BOUND_RX}, 1) AS head, regexp_extract(t, {_BOUND_RX}, 4) AS tail FROM s),
k AS (SELECT *, an * au AS a, bn * bu AS b, pn * pu AS p, bounded AND (regexp_matches(head, '^({_LOW})$') OR tail = 'trở lên') AS is_low, bounded AND (regexp_matches(head, '^({_UP})$') OR tail = 'trở xuống') AS is_up FROM r),
v AS (SELECT *, CASE WHEN coalesce(t, '') = '' THEN 'missing' WHEN t = 'không' THEN 'ambiguous_literal' WHEN t IN ('chưa xác định', 'chưa cập nhật') THEN 'unknown' WHEN t IN ('không yêu cầu kinh nghiệm', 'không yêu cầu', 'không cần') THEN 'no_requirement'
    WHEN t IN ('yêu cầu ứng viên có', 'có', 'yêu cầu') THEN 'mapped' WHEN ranged THEN CASE WHEN an >= 1e9 OR bn >= 1e9 OR a > b THEN 'invalid_bounds' ELSE 'mapped' END WHEN is_low AND is_up THEN 'ambiguous'
    WHEN bounded THEN CASE WHEN pn >= 1e9 THEN 'invalid_bounds' ELSE 'mapped' END ELSE 'unmapped' END AS status,
  CASE WHEN t IN ('yêu cầu ứng viên có', 'có', 'yêu cầu') THEN 'required_unspecified' WHEN t IN ('không yêu cầu kinh nghiệm', 'không yêu cầu', 'không cần') THEN 'no_requirement' END AS said FROM k),
w AS (SELECT id, status, CASE WHEN status IN ('mapped', 'no_requirement') THEN coalesce(said, CASE WHEN ranged THEN 'range' WHEN is_low THEN 'lower_bound' WHEN is_up THEN 'upper_bound' ELSE 'stated_point' END) END AS kind, said,
  CASE WHEN status = 'mapped' AND said IS NULL THEN CASE WHEN ranged THEN a WHEN is_up THEN 0 ELSE p END END AS low_months, CASE WHEN status = 'mapped' AND said IS NULL THEN CASE WHEN ranged THEN b WHEN NOT is_low THEN p END END AS high_months,
  status = 'mapped' AND bounded AND NOT ranged AND is_low AND head IN ('trên', 'hơn', '>') AS low_open, status = 'mapped' AND bounded AND NOT ranged AND is_up AND head IN ('dưới', '<') AS high_open FROM v)
SELECT id, status, kind, low_months, high_months, coalesce(low_open, false) AS low_open, coalesce(high_open, false) AS high_open,
  CASE WHEN said IS NOT NULL THEN said WHEN status <> 'mapped' THEN NULL WHEN low_months >= 60 THEN 'ge_5' WHEN low_months >= 0 AND (high_months < 12 OR high_months = 12 AND high_open) THEN 'lt_1'
  WHEN low_months >= 12 AND (high_months < 36 OR high_months = 36 AND high_open) THEN '1_lt_3' WHEN low_months >= 36 AND (high_months < 60 OR high_months = 60 AND high_open) THEN '3_lt_5' ELSE 'range_crossing' END AS bucket,
  CAST(low_months / 12 AS DOUBLE) AS low_years FROM w"""


@query(_EXPERIENCE)
def d1_experience(spark, d):
    r = table(spark, d, "source_rows").select("id", grammar.experience(F.col("experience_level")).alias("r")).select("id", "r.*")
    as_double = {c: F.col(c).cast("double") for c in ("low_months", "high_months")}
    return r.withColumn("low_years", grammar.years(F.col("low_months")).cast("double")).withColumns(as_double)


@query("SELECT p_partkey, CAST(round_even(p_size / 12, 6) AS DOUBLE) AS years, CAST(round(p_retailprice, 1) AS DOUBLE) AS price FROM part")
def d3_months_to_years(spark, d):
    return table(spark, d, "part").select("p_partkey", grammar.years(F.col("p_size")).cast("double").alias("years"), F.round("p_retailprice", 1).alias("price"))


@query(
    "SELECT id, salary_min IS NOT NULL OR salary_max IS NOT NULL AS numeric_eligible, salary_min IS NOT NULL AND salary_max IS NOT NULL AND salary_min <= salary_max AS midpoint_eligible FROM jobs"
)
def d8_eligibility(spark, d):
    lo, hi = F.col("salary_min"), F.col("salary_max")
    return table(spark, d, "jobs").select("id", (lo.isNotNull() | hi.isNotNull()).alias("numeric_eligible"), F.coalesce(lo <= hi, F.lit(False)).alias("midpoint_eligible"))


# --- filters, joins ----------------------------------------------------------------------------


@query(
    f"SELECT id, CASE WHEN t IS NULL OR t = '' THEN 'missing_title' WHEN lower(t) = 'không' THEN 'title_ambiguous_literal' END AS quarantine_reason FROM (SELECT id, {_strip_sql('job_title')} AS t FROM source_rows)"
)
def e1_quarantine(spark, d):
    t = tx.collapse(F.col("job_title"))
    why = F.when(F.coalesce(t, F.lit("")) == "", "missing_title").when(F.lower(t) == "không", "title_ambiguous_literal")
    return table(spark, d, "source_rows").select("id", why.alias("quarantine_reason"))


@query(
    "WITH c AS (SELECT job_industry, count(*) AS label_rows FROM source_rows GROUP BY 1) SELECT s.id, c.label_rows, s.job_industry IS NOT NULL AND c.label_rows >= 20 AS in_scope "
    "FROM source_rows s JOIN c ON s.job_industry IS NOT DISTINCT FROM c.job_industry"
)
def e4_label_scope(spark, d):
    return labels.label_scope(table(spark, d, "source_rows").select("id", "job_industry"), "job_industry", 20).select("id", "label_rows", "in_scope")


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))")
def e5_scope_semi_join(spark, d):
    inside = table(spark, d, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, d, "orders").join(inside, "o_custkey", "left_semi").select("o_orderkey")


@query(
    "SELECT id, coalesce(salary_min > salary_max, false) AS reversed_bounds, job_title IS NULL OR trim(job_title) = '' AS no_title, coalesce(len(location), 0) = 0 AS no_place, "
    "coalesce(experience_min_years > experience_max_years, false) AS reversed_years FROM jobs"
)
def e6_row_checks(spark, d):
    no = F.lit(False)
    return table(spark, d, "jobs").select(
        "id", F.coalesce(F.col("salary_min") > F.col("salary_max"), no).alias("reversed_bounds"), (F.col("job_title").isNull() | (F.trim("job_title") == "")).alias("no_title"),
        (F.coalesce(F.size("location"), F.lit(0)) <= 0).alias("no_place"), F.coalesce(F.col("experience_min_years") > F.col("experience_max_years"), no).alias("reversed_years"),
    )


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS field, sum(CASE WHEN {c} IS NOT NULL AND {_strip_sql(c)} <> '' THEN 1 ELSE 0 END) * 100.0 / count(*) AS filled FROM probe_records"
        for c in ("job_title", "company_name", "salary_raw", "location_raw", "detailed_work_address")
    )
)
def e8_completeness(spark, d):
    names = ("job_title", "company_name", "salary_raw", "location_raw", "detailed_work_address")
    one = table(spark, d, "probe_records").agg(F.array(*[F.struct(F.lit(c).alias("field"), (F.count_if(tx.collapse(F.col(c)) != "") * 100.0 / F.count(F.lit(1))).cast("double").alias("filled")) for c in names]).alias("a"))
    return one.select(F.explode("a").alias("f")).select("f.*")


@query(
    """SELECT count(*) FILTER (WHERE a.id IS NOT NULL AND c.id IS NOT NULL) AS matched, count(*) FILTER (WHERE a.id IS NULL) AS only_left, count(*) FILTER (WHERE c.id IS NULL) AS only_right,
  (SELECT count(*) FROM (SELECT record_key FROM core_rows GROUP BY 1 HAVING count(*) > 1)) AS repeated_left, (SELECT count(*) FROM (SELECT record_key FROM salary_audit GROUP BY 1 HAVING count(*) > 1)) AS repeated_right,
  count(*) FILTER (WHERE a.id IS NOT NULL AND c.id IS NOT NULL AND (a.id IS DISTINCT FROM c.id OR a.year IS DISTINCT FROM c.year)) AS disagreeing
FROM core_rows c FULL OUTER JOIN salary_audit a ON a.record_key = c.record_key"""
)
def f1_strict_check(spark, d):
    return joins.strict_check(table(spark, d, "core_rows"), table(spark, d, "salary_audit"), "record_key", ["id", "year"])


@query(
    f"""WITH u AS (SELECT job_industry AS v, count(*) AS n FROM source_rows WHERE job_industry IS NOT NULL GROUP BY 1), m AS (SELECT DISTINCT label_vi AS v FROM ref_values WHERE field_name = 'job_industry')
SELECT count(*) FILTER (WHERE u.v IS NOT NULL AND m.v IS NOT NULL) AS used, count(*) FILTER (WHERE u.v IS NULL) AS unused, count(*) FILTER (WHERE m.v IS NULL) AS unmapped_values,
  coalesce(sum(CASE WHEN m.v IS NULL THEN n END), 0) AS unmapped_rows FROM u FULL OUTER JOIN m ON u.v = m.v"""
)
def f4_mapping_coverage(spark, d):
    return joins.coverage(table(spark, d, "source_rows"), "job_industry", table(spark, d, "ref_values").where("field_name = 'job_industry'"), "label_vi")


@query("SELECT d.doc_id FROM documents d WHERE d.job_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM source_rows s WHERE s.id = d.job_id)")
def f5_orphans(spark, d):
    return joins.orphans(table(spark, d, "documents").select("doc_id", "job_id"), "job_id", table(spark, d, "source_rows"), "id").select("doc_id")


@query(
    """SELECT coalesce(c.id, j.id) AS id, CASE WHEN j.id IS NULL THEN 'missing' WHEN c.id IS NULL THEN 'extra' WHEN c.job_title IS DISTINCT FROM j.job_title OR c.year IS DISTINCT FROM j.year THEN 'modified' ELSE 'matched' END AS state
FROM (SELECT id, job_title_clean AS job_title, year FROM core_rows) c FULL OUTER JOIN jobs j ON c.id = j.id"""
)
def f6_compare_tables(spark, d):
    old = table(spark, d, "core_rows").select("id", F.col("job_title_clean").alias("job_title"), "year")
    return joins.compare(old, table(spark, d, "jobs").select("id", "job_title", F.col("year").cast("long").alias("year")), "id", ["job_title", "year"]).select("id", "state")


@query(
    "SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'right' WHEN b.k IS NULL THEN 'left' ELSE 'both' END AS found_by FROM (SELECT DISTINCT job_industry AS k FROM source_rows WHERE load_id = 1 AND job_industry IS NOT NULL) a "
    "FULL OUTER JOIN (SELECT DISTINCT job_industry AS k FROM source_rows WHERE load_id = 3 AND job_industry IS NOT NULL) b ON a.k = b.k"
)
def f8_disagreements(spark, d):
    s = table(spark, d, "source_rows").where("job_industry is not null")
    side = lambda n, as_: s.where(F.col("load_id") == n).select(F.col("job_industry").alias("k")).distinct().withColumn(as_, F.lit(1))
    both = side(1, "a").join(side(3, "b"), "k", "full_outer")
    return both.select("k", F.when(F.col("a").isNull(), "right").when(F.col("b").isNull(), "left").otherwise("both").alias("found_by"))


# --- aggregates --------------------------------------------------------------------------------


_METRICS = {
    "status": "status", "currency": "currency", "kind": "kind", "period": "period", "component": "component", "reason": "reason", "min_inclusive": "CAST(min_inclusive AS {t})", "max_inclusive": "CAST(max_inclusive AS {t})",
    "numeric_eligible": "CAST(salary_numeric_eligible AS {t})", "midpoint_eligible": "CAST(salary_midpoint_eligible AS {t})", "selected": "CAST(analysis_selected AS {t})", "stated": "CASE WHEN salary IS NULL THEN 'null' WHEN trim(salary) = '' THEN 'blank' ELSE 'text' END",
}


@query(
    "WITH m AS (" + " UNION ALL ".join(f"SELECT year, '{k}' AS metric, {v.format(t='VARCHAR')} AS value, count(*) AS n FROM salary_audit GROUP BY year, {v.format(t='VARCHAR')}" for k, v in _METRICS.items())
    + ") SELECT *, 'each' AS level FROM m UNION ALL SELECT NULL, metric, value, sum(n), 'all' FROM m GROUP BY metric, value"
)
def g1_quality_counters(spark, d):
    """Twelve metrics of the audit, counted per year and in all."""
    return aggregates.counters(table(spark, d, "salary_audit"), "year", {k: F.expr(v.format(t="STRING")) for k, v in _METRICS.items()})


@query(
    f"""WITH p AS (SELECT 'job_title' AS field, s.job_title AS a, c.job_title_clean AS b FROM source_rows s JOIN core_rows c ON s.id = c.id
  UNION ALL SELECT 'company_name', s.company_name, c.company_name_clean FROM source_rows s JOIN core_rows c ON s.id = c.id)
SELECT field, sum(CASE WHEN a IS DISTINCT FROM b THEN 1 ELSE 0 END) AS changed, count(DISTINCT a) AS before, count(DISTINCT b) AS after FROM p GROUP BY 1"""
)
def g2_changed_fields(spark, d):
    both = table(spark, d, "source_rows").select("id", "job_title", "company_name").join(table(spark, d, "core_rows").select("id", "job_title_clean", "company_name_clean"), "id")
    return aggregates.changes(both, {"job_title": (F.col("job_title"), F.col("job_title_clean")), "company_name": (F.col("company_name"), F.col("company_name_clean"))})


@query(f"SELECT job_type AS source, lower({_strip_sql('job_type')}) AS canonical, count(*) AS n FROM source_rows GROUP BY 1, 2")
def g3_label_mapping(spark, d):
    return table(spark, d, "source_rows").groupBy(F.col("job_type").alias("source"), F.lower(tx.collapse(F.col("job_type"))).alias("canonical")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH f AS (SELECT {FINGERPRINT} AS h, id, job_industry FROM source_rows), r AS (SELECT h, min(id) AS first_id, count(*) AS n FROM f GROUP BY 1)
SELECT f.job_industry, count(*) AS contents, sum(r.n) AS n_rows FROM r JOIN f ON f.id = r.first_id GROUP BY 1"""
)
def g4_content_representatives(spark, d):
    df = table(spark, d, "source_rows")
    reps = df.select(identity.fingerprint(df, CONTENT).alias("h"), "id", "job_industry").groupBy("h").agg(F.min_by("job_industry", "id").alias("job_industry"), F.count(F.lit(1)).alias("n"))
    return reps.groupBy("job_industry").agg(F.count(F.lit(1)).alias("contents"), F.sum("n").alias("n_rows"))


@query(
    "SELECT job_industry, year, count(*) AS n_rows, count(*) FILTER (WHERE salary_min IS NOT NULL OR salary_max IS NOT NULL) AS with_amount, count(*) FILTER (WHERE salary_min <= salary_max) AS with_midpoint FROM jobs GROUP BY 1, 2"
)
def g5_coverage_cube(spark, d):
    lo, hi = F.col("salary_min"), F.col("salary_max")
    return aggregates.coverage_cube(table(spark, d, "jobs"), ["job_industry", "year"], {"with_amount": lo.isNotNull() | hi.isNotNull(), "with_midpoint": lo <= hi})


@query("SELECT currency, period, status, year, count(*) AS n, min(id) AS example FROM salary_audit GROUP BY 1, 2, 3, 4")
def g6_histogram(spark, d):
    return aggregates.histogram(table(spark, d, "salary_audit"), ["currency", "period", "status", "year"], "id")


@query("SELECT count(*) AS n_rows, count(DISTINCT job_id) AS jobs, count(DISTINCT source) AS sources, count(text) AS with_text FROM documents")
def g8_table_counts(spark, d):
    return table(spark, d, "documents").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("job_id").alias("jobs"), F.count_distinct("source").alias("sources"), F.count("text").alias("with_text"))


@query("SELECT company_name, count(DISTINCT job_industry) AS names FROM source_rows WHERE company_name IS NOT NULL GROUP BY 1 HAVING count(DISTINCT job_industry) > 1")
def g9_dependency_breaks(spark, d):
    return aggregates.dependency_breaks(table(spark, d, "source_rows"), "company_name", "job_industry")


@query(
    """WITH t AS (SELECT source_name, coalesce(category_tags, []::VARCHAR[]) AS a, coalesce(specialization_tags, []::VARCHAR[]) AS b FROM probe_records),
  s AS (SELECT source_name, sum(len(list_intersect(list_distinct(a), list_distinct(b)))) AS tp, sum(len(list_filter(list_distinct(a), lambda x: NOT list_contains(b, x)))) AS fp,
    sum(len(list_filter(list_distinct(b), lambda x: NOT list_contains(a, x)))) AS fn FROM t GROUP BY 1)
SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS recall, CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) END AS f1 FROM s"""
)
def g11_precision_recall(spark, d):
    return aggregates.precision_recall(table(spark, d, "probe_records"), "source_name", "category_tags", "specialization_tags")


@query(
    "SELECT source_name, 0.5 * avg(CASE WHEN salary_raw IS NOT NULL THEN 1.0 ELSE 0.0 END) + 0.3 * avg(CASE WHEN location_raw IS NOT NULL THEN 1.0 ELSE 0.0 END) + 0.2 * avg(CASE WHEN experience_raw IS NOT NULL THEN 1.0 ELSE 0.0 END) AS score FROM probe_records GROUP BY 1"
)
def g12_weighted_score(spark, d):
    has = lambda c: F.avg(F.when(F.col(c).isNotNull(), 1.0).otherwise(0.0))
    return table(spark, d, "probe_records").groupBy("source_name").agg((0.5 * has("salary_raw") + 0.3 * has("location_raw") + 0.2 * has("experience_raw")).alias("score"))


# --- order, samples, sets ----------------------------------------------------------------------


@query(
    """WITH s AS (SELECT doc_id, doc_section, CASE WHEN CAST(('0x' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % 5 = 0 THEN 'holdout' ELSE 'train' END AS split, sha256(doc_id || ':a') AS score FROM documents),
  r AS (SELECT *, row_number() OVER (PARTITION BY split, doc_section ORDER BY score) AS place FROM s) SELECT split, doc_section, place, doc_id FROM r WHERE place <= CASE WHEN split = 'holdout' THEN 200 ELSE 20 END"""
)
def h1_hash_top(spark, d):
    key = F.col("doc_id").cast("string")
    split = table(spark, d, "documents").select("doc_id", "doc_section", sampling.split_of(F.sha2(key, 256)).alias("split"))
    return sampling.hash_top(split, ["split", "doc_section"], F.concat(key, F.lit(":a")), 200, F.when(F.col("split") == "holdout", 200).otherwise(20)).select("split", "doc_section", "place", "doc_id")


@query("SELECT status, place, id FROM (SELECT status, id, row_number() OVER (PARTITION BY status ORDER BY id) AS place FROM salary_audit) WHERE place <= 5")
def h3_first_per_status(spark, d):
    return sampling.first_per_group(table(spark, d, "salary_audit").select("status", "id"), ["status"], ["id"], 5).select("status", "place", "id")


@query(
    """WITH s AS (SELECT id, job_type, year, sha256(CAST(id AS VARCHAR)) AS h FROM source_rows WHERE job_type IS NOT NULL AND year IS NOT NULL),
  r AS (SELECT *, row_number() OVER (PARTITION BY job_type, year ORDER BY h) AS rnd FROM s), q AS (SELECT *, row_number() OVER (PARTITION BY job_type ORDER BY rnd, year) AS place FROM r)
SELECT job_type, place, id FROM q WHERE place <= 10"""
)
def h4_stratified_sample(spark, d):
    rows = table(spark, d, "source_rows").where("job_type is not null and year is not null").select("id", "job_type", "year")
    return sampling.stratified(rows, "job_type", "year", F.col("id").cast("string"), 10).select("job_type", "place", "id")


@query("SELECT job_industry, count(*) AS n FROM source_rows WHERE job_industry IS NOT NULL GROUP BY 1 ORDER BY n DESC, job_industry LIMIT 25")
def h6_most_common(spark, d):
    return labels.most_common(table(spark, d, "source_rows"), "job_industry", 25)


@query("SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) AS r FROM orders) WHERE r = 1")
def h8_latest_per_key(spark, d):
    return labels.latest(table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey"), "o_custkey", "o_orderdate").select("o_custkey", "o_orderkey")


_SET_A, _SET_B = "SELECT company_name, year FROM source_rows WHERE load_id <= 3", "SELECT company_name, year FROM source_rows WHERE load_id > 3"


@query(f"WITH x AS (SELECT count(*) AS only_a FROM ({_SET_A} EXCEPT ALL {_SET_B})), y AS (SELECT count(*) AS only_b FROM ({_SET_B} EXCEPT ALL {_SET_A})) SELECT only_a, only_b, only_a = 0 AND only_b = 0 AS equal FROM x, y")
def i1_except_all(spark, d):
    s = table(spark, d, "source_rows")
    return joins.same_rows(s.where("load_id <= 3").select("company_name", "year"), s.where("load_id > 3").select("company_name", "year"))


@query(
    """SELECT id, year, load_id FROM (SELECT id, year, load_id FROM source_rows WHERE load_id <= 4) WHERE coalesce(year < 2024, false) = false
UNION ALL SELECT b.id, b.year, b.load_id FROM source_rows b WHERE b.load_id <= 4 AND coalesce(b.year < 2024, false) AND b.id NOT IN (SELECT id FROM source_rows WHERE load_id >= 4)
UNION ALL SELECT n.id, n.year, n.load_id FROM source_rows n WHERE n.load_id >= 4 AND n.id NOT IN (SELECT id FROM source_rows WHERE load_id <= 4 AND coalesce(year < 2024, false) = false)"""
)
def i2_append_and_replace(spark, d):
    s = table(spark, d, "source_rows").select("id", "year", "load_id")
    return joins.append_and_replace(s.where("load_id <= 4"), s.where("load_id >= 4"), "id", "year < 2024")


@query(
    "SELECT probe_id, array_to_string(list_sort(list_distinct(list_filter(list_concat(category_tags, specialization_tags), lambda x: x IS NOT NULL))), '|') AS all_tags, "
    "array_to_string(list_sort(list_filter(list_distinct(category_tags), lambda x: NOT list_contains(specialization_tags, x))), '|') AS only_category FROM probe_records WHERE category_tags IS NOT NULL AND specialization_tags IS NOT NULL"
)
def i6_array_sets(spark, d):
    a, b = F.col("category_tags"), F.col("specialization_tags")
    rows = table(spark, d, "probe_records").where(a.isNotNull() & b.isNotNull())
    return rows.select("probe_id", F.array_join(F.array_sort(F.array_union(a, b)), "|").alias("all_tags"), F.array_join(F.array_sort(F.array_except(a, b)), "|").alias("only_category"))


# --- publishing --------------------------------------------------------------------------------


@query("SELECT id, job_title, year FROM jobs")
def j5_published_table(spark, d):
    root, name = f"{shared_dir(spark)}/published-{uuid.uuid4().hex}", "jobs"
    rows = table(spark, d, "jobs").select("id", "job_title", "year")
    publish.publish(rows, root, name, "v1", rows.columns)
    publish.publish(rows, root, name, "v1", rows.columns)  # the same again: verified, nothing moved
    return publish.read_current(spark, root, name)


@query(
    "SELECT (SELECT count(*) FROM core_rows) AS core, (SELECT count(*) FROM salary_audit) AS audit, (SELECT count(*) FROM jobs) AS jobs, "
    "(SELECT count(*) FROM core_rows c WHERE c.id NOT IN (SELECT id FROM jobs)) AS core_without_job, (SELECT count(*) FROM jobs j WHERE j.id NOT IN (SELECT id FROM core_rows)) AS jobs_without_core"
)
def j6_preflight(spark, d):
    c, a, j = (table(spark, d, n).select("id") for n in ("core_rows", "salary_audit", "jobs"))
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return joins.side_by_side(n(c, "core"), n(a, "audit"), n(j, "jobs"), n(c.join(j, "id", "left_anti"), "core_without_job"), n(j.join(c, "id", "left_anti"), "jobs_without_core"))


# --- dictionary matching -----------------------------------------------------------------------


def _matched(spark, d):
    return matching.match_texts(table(spark, d, "documents"), "doc_id", "text", SKILLS, IMPLIED)


@query()
def k5_skill_evidence(spark, d):
    e = _matched(spark, d).select("doc_id", F.explode("evidence").alias("e"))
    return e.select("doc_id", "e.*")


@query()
def k9_skill_pairs(spark, d):
    return matching.pairs(_matched(spark, d), "doc_id")


@query()
def k9_skill_status(spark, d):
    return _matched(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query()
def k7_clauses(spark, d):
    """The clauses of every document with the section they stand in."""
    return matching.clause_rows(table(spark, d, "documents"), "doc_id", "text")


@query()
def k8_contexts(spark, d):
    """How often each skill stands in each context, and by which rule."""
    e = _matched(spark, d).select(F.explode("evidence").alias("e"))
    return e.groupBy("e.code", "e.context", "e.rule", "e.logic").agg(F.count(F.lit(1)).alias("n"))


# Families of occupations and topics by words of a title, and what rules them out.
FAMILIES = [
    ("warehouse", "kho|thủ kho|warehouse|cold storage", "kho báu"), ("hr", "tuyển dụng|nhân sự|recruit", "^tuyển dụng *[:-]"), ("accounting", "kế toán|kiểm toán|thuế|account", ""), ("software", "phần mềm|lập trình|software|dữ liệu|data", "bán phần mềm"),
    ("marketing", "quảng cáo|truyền thông|marketing|thương hiệu", ""), ("production", "hàn |dệt|nhuộm|sản xuất|cơ khí|bao bì|weld|textile", ""), ("maintenance", "bảo trì|sửa chữa|vận hành|mainten", ""), ("design", "thiết kế|đồ họa|design", ""),
    ("law", "pháp chế|hợp đồng|legal", ""), ("logistics", "điều phối|xe tải|cảng|giao hàng|logist", ""), ("care", "chăm sóc|y khoa|điều dưỡng|care", ""),
]
_FAMILY_SQL = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(x, '{p}')" + (f" AND NOT regexp_matches(x, '{no}')" if no else "") + f" THEN '{f}' END" for f, p, no in sorted(FAMILIES)) + "], lambda v: v IS NOT NULL)"


@query(
    f"""WITH t AS (SELECT id, lower({_strip_sql('nfc_normalize(job_title)')}) AS title, lower({_strip_sql('nfc_normalize(job_industry)')}) AS source FROM source_rows),
a AS (SELECT id, title, {_FAMILY_SQL.replace('x,', 'title,')} AS own, {_FAMILY_SQL.replace('x,', 'source,')} AS said FROM t)
SELECT id, array_to_string(own, '|') AS families, CASE WHEN coalesce(title, '') = '' THEN 'missing' WHEN len(own) > 1 THEN 'multiple_or_ambiguous' WHEN len(own) = 1 THEN 'assigned' WHEN len(said) > 0 THEN 'needs_review' ELSE 'unmapped' END AS status,
  CASE WHEN len(own) = 1 THEN own[1] END AS family, len(own) = 1 AND len(said) > 0 AND NOT list_contains(said, own[1]) AS overrides_source FROM a"""
)
def k1_occupations(spark, d):
    """The family of occupations of every title; what the source calls it only proposes one."""
    low = lambda c: F.lower(tx.collapse(tx.nfc(F.col(c))))
    rows = table(spark, d, "source_rows").select("id", low("job_title").alias("title"), low("job_industry").alias("source"))
    return labels.occupation(rows, "title", "source", FAMILIES).select("id", F.array_join("families", "|").alias("families"), "status", "family", "overrides_source")


@query(
    f"""WITH t AS (SELECT id, lower({_strip_sql('nfc_normalize(job_title)')}) AS title, lower({_strip_sql('nfc_normalize(job_industry)')}) AS source FROM source_rows)
SELECT id, array_to_string(list_sort(list_distinct(list_concat({_FAMILY_SQL.replace('x,', 'title,')}, {_FAMILY_SQL.replace('x,', 'source,')}))), '|') AS tags FROM t"""
)
def k2_domain_tags(spark, d):
    """The domains that title and industry touch together."""
    low = lambda c: F.lower(tx.collapse(tx.nfc(F.col(c))))
    both = F.array_union(labels.families(low("job_title"), FAMILIES), labels.families(low("job_industry"), FAMILIES))
    return table(spark, d, "source_rows").select("id", F.array_join(F.array_sort(both), "|").alias("tags"))


# --- state -------------------------------------------------------------------------------------


@query(
    "WITH p AS (SELECT source_job_id, CAST(crawled_at AS DATE) AS batch, min(crawled_at) AS a, max(crawled_at) AS b FROM probe_records WHERE source_job_id IS NOT NULL GROUP BY 1, 2) "
    "SELECT source_job_id, min(a) AS first_seen, max(b) AS last_seen, count(*) AS seen_count, true AS active FROM p GROUP BY 1"
)
def m1_discovery(spark, d):
    e = table(spark, d, "probe_records").withColumn("batch", F.to_date("crawled_at"))
    return state.discovery(e, "source_job_id", "crawled_at", "batch")


@query(
    """SELECT probe_id, CASE WHEN row_number() OVER w = 1 THEN 'new' WHEN lag(content_hash) OVER w IS NOT DISTINCT FROM content_hash THEN 'unchanged' ELSE 'changed' END AS change
FROM probe_records WINDOW w AS (PARTITION BY source_name, source_job_id ORDER BY crawled_at, probe_id)"""
)
def m2_content_changes(spark, d):
    e = table(spark, d, "probe_records").withColumn("k", F.struct("source_name", "source_job_id"))
    return state.content_changes(e, "k", "crawled_at", "content_hash", "probe_id").select("probe_id", "change")


@query(
    "SELECT user_id, CASE WHEN s = 'view' THEN 'pending' ELSE s END AS state FROM (SELECT user_id, event_type AS s, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1"
)
def m3_last_state(spark, d):
    e = table(spark, d, "events").withColumn("o", F.struct("ts", "event_id")).withColumn("s", F.when(F.col("event_type") == "view", "processing").otherwise(F.col("event_type")))
    return state.last_state(e, "user_id", "s", "o")


@query(
    """WITH n AS (SELECT source_job_id AS k, min(job_title) AS f, count(DISTINCT job_title) AS c FROM probe_records WHERE crawled_at >= TIMESTAMP '2026-02-10' AND source_job_id IS NOT NULL GROUP BY 1),
  o AS (SELECT source_job_id AS k, min(job_title) AS f FROM probe_records WHERE crawled_at < TIMESTAMP '2026-02-10' GROUP BY 1)
SELECT n.k AS source_job_id, CASE WHEN c > 1 THEN 'conflict' WHEN o.f IS NULL THEN 'new' WHEN o.f = n.f THEN 'overlap' ELSE 'conflict' END AS outcome FROM n LEFT JOIN o ON n.k = o.k"""
)
def m4_commit(spark, d):
    e = table(spark, d, "probe_records")
    border = F.lit("2026-02-10").cast("timestamp_ntz")
    return state.commit(e.where(F.col("crawled_at") < border), e.where(F.col("crawled_at") >= border), "source_job_id", "job_title")


@query(
    """WITH e AS (SELECT source_name, probe_id, salary_raw IS NULL AS failed FROM probe_records), g AS (SELECT *, sum(CASE WHEN failed THEN 0 ELSE 1 END) OVER (PARTITION BY source_name ORDER BY probe_id) AS ok FROM e),
  b AS (SELECT source_name, ok, sum(CASE WHEN failed THEN 1 ELSE 0 END) AS f, count(*) AS n FROM g GROUP BY 1, 2)
SELECT source_name, sum(n) AS n_events, sum(f) AS failures, max(f) AS longest_failure_run, sum(f) / sum(n) AS failure_rate FROM b GROUP BY 1"""
)
def m6_failure_runs(spark, d):
    return state.failure_runs(table(spark, d, "probe_records").withColumn("failed", F.col("salary_raw").isNull()), "source_name", "probe_id", "failed")


@query("SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1, 2")
def m_hourly_windows(spark, d):
    w = F.window("ts", "1 hour")
    return table(spark, d, "events").groupBy("event_type", w.start.alias("hour")).agg(F.count(F.lit(1)).alias("n"))


#: Listings of so many record numbers of one board make a page.
_PER_PAGE = 40


def _listings(spark, d):
    """Listing pages of each board: the links of up to ``_PER_PAGE`` postings, each twice, and the next page."""
    e = table(spark, d, "probe_records").where("canonical_url is not null")
    n = F.floor(F.col("probe_id") / _PER_PAGE)
    link = F.concat(F.lit('<a href="'), F.col("canonical_url"), F.lit('">x</a>'))
    own = e.groupBy(F.concat_ws("/", "source_name", n).alias("page"), n.alias("n")).agg(F.array_sort(F.collect_list(F.struct("probe_id", F.concat(link, link).alias("h")))).alias("links"), F.count(F.lit(1)).alias("k"))
    more = F.concat(F.lit('<a rel="next" href="/p/'), F.col("n") + 1, F.lit('">next</a> '), F.col("k"), F.lit(" việc làm"))
    return own.select("page", F.concat(F.lit("<html>"), F.array_join(F.transform("links", lambda x: x.h), ""), more, F.lit("</html>")).alias("html"))


_LISTED = f"""WITH p AS (SELECT concat_ws('/', source_name, probe_id // {_PER_PAGE}) AS page, probe_id // {_PER_PAGE} AS n, canonical_url AS url, regexp_extract(canonical_url, '-([0-9]+)$', 1) AS job_id,
  2 * (row_number() OVER (PARTITION BY source_name, probe_id // {_PER_PAGE} ORDER BY probe_id) - 1) AS place FROM probe_records WHERE canonical_url IS NOT NULL)"""


@query(_LISTED + " SELECT page, job_id, min(place) AS place, arg_min(url, place) AS url FROM p WHERE job_id <> '' GROUP BY 1, 2")
def l1_listing_links(spark, d):
    """The postings of every listing page, each id once at its first place."""
    return html.listing(_listings(spark, d), "page", "html", r"-([0-9]+)$")


@query(
    _LISTED
    + """, j AS (SELECT page, count(DISTINCT job_id) AS n_jobs, sha256('["' || array_to_string(list_sort(list(DISTINCT job_id)), '","') || '"]') AS fingerprint FROM p WHERE job_id <> '' GROUP BY 1)
SELECT j.page, n_jobs, fingerprint, f.next_url, f.total FROM j JOIN (SELECT page, '/p/' || (n + 1) AS next_url, count(*) AS total FROM p GROUP BY page, n) f ON j.page = f.page"""
)
def l1_page_facts(spark, d):
    """The next page, the stated number of hits and the fingerprint of every listing page."""
    pages = _listings(spark, d)
    facts = pages.select("page", html.page_facts(F.col("html")).alias("f")).select("page", "f.*")
    return html.page_fingerprints(html.listing(pages, "page", "html", r"-([0-9]+)$"), "page").join(facts, "page")


# --- further rules -----------------------------------------------------------------------------


@query("SELECT a.id, CASE WHEN o.id IS NULL THEN a.salary ELSE 'override:' || o.salary END AS salary FROM salary_audit a LEFT JOIN (SELECT id, salary FROM salary_audit WHERE currency = '$') o ON a.id = o.id")
def d7_keyed_override(spark, d):
    """Pay in dollar signs overridden by key, each override guarded by the text it was made for and a hash of its record key."""
    a = table(spark, d, "salary_audit").select("id", "salary", "record_key", "currency")
    o = a.where("currency = '$'").select("id", F.col("salary").alias("expected"), F.concat(F.lit("override:"), "salary").alias("value"), F.sha2("record_key", 256).alias("evidence_sha256"))
    return joins.override(a, "id", "salary", o, "record_key").select("id", "salary")


@query(
    "SELECT 'jobs.id unique' AS rule, (SELECT count(*) FROM (SELECT id FROM jobs GROUP BY id HAVING count(*) > 1)) AS breaks UNION ALL "
    "SELECT 'jobs.salary ordered', (SELECT count(*) FROM jobs WHERE salary_min > salary_max) UNION ALL SELECT 'jobs.id in core_rows', (SELECT count(*) FROM jobs j WHERE j.id NOT IN (SELECT id FROM core_rows)) UNION ALL "
    "SELECT 'jobs.year known', (SELECT count(*) FROM jobs WHERE year IS NULL OR year NOT BETWEEN 2022 AND 2026)"
)
def e7_constraints(spark, d):
    jobs, core = table(spark, d, "jobs"), table(spark, d, "core_rows")
    return aggregates.constraints(
        {
            "jobs.id unique": jobs.groupBy("id").agg(F.count(F.lit(1)).alias("c")).where("c > 1"),
            "jobs.salary ordered": jobs.where("salary_min > salary_max"),
            "jobs.id in core_rows": joins.orphans(jobs.select("id"), "id", core, "id"),
            "jobs.year known": jobs.where("year is null or year not between 2022 and 2026"),
        }
    )


@query(
    f"SELECT id, CASE WHEN requirements IS NULL THEN 'missing' WHEN {_strip_sql('requirements')} = '' OR lower({_strip_sql('requirements')}) IN ('.', 'không', 'khác', 'n/a') THEN 'unusable' "
    "WHEN job_industry IS NULL OR job_industry NOT IN (SELECT label_vi FROM ref_values WHERE field_name = 'job_industry') THEN 'out_of_scope' ELSE 'match' END AS route FROM source_rows"
)
def e10_routing(spark, d):
    t = F.lower(tx.collapse(F.col("requirements")))
    scope = table(spark, d, "ref_values").where("field_name = 'job_industry'").select(F.col("label_vi").alias("job_industry")).distinct().withColumn("listed", F.lit(True))
    rows = table(spark, d, "source_rows").select("id", "requirements", "job_industry").join(small(scope), "job_industry", "left")
    route = F.when(F.col("requirements").isNull(), "missing").when(t.isin("", ".", "không", "khác", "n/a"), "unusable").when(F.col("listed").isNull(), "out_of_scope").otherwise("match")
    return rows.select("id", route.alias("route"))


@query("SELECT flag, place, id FROM (SELECT flag, id, row_number() OVER (PARTITION BY flag ORDER BY id) AS place FROM (SELECT unnest(category_tags) AS flag, probe_id AS id FROM probe_records)) WHERE place <= 3")
def h2_examples_per_flag(spark, d):
    flags = table(spark, d, "probe_records").select(F.explode("category_tags").alias("flag"), F.col("probe_id").alias("id"))
    return sampling.first_per_group(flags, ["flag"], ["id"], 3).select("flag", "place", "id")


@query(f"SELECT id FROM source_rows WHERE load_id = 5 AND sha256(coalesce({_strip_sql('job_title')}, '')) NOT IN (SELECT sha256(coalesce({_strip_sql('job_title')}, '')) FROM source_rows WHERE load_id = 1)")
def h5_exclude_sampled(spark, d):
    key = F.sha2(F.coalesce(tx.collapse(F.col("job_title")), F.lit("")), 256)
    s = table(spark, d, "source_rows")
    return sampling.without(s.where("load_id = 5"), key, s.where("load_id = 1").select(key.alias("k")), "k").select("id")


@query(
    "WITH p AS (SELECT probe_id AS k, unnest(category_tags) AS code FROM probe_records), q AS (SELECT probe_id AS k, unnest(specialization_tags) AS code FROM probe_records), "
    "r AS (SELECT probe_id AS k, company_industry AS code FROM probe_records WHERE company_industry IS NOT NULL) "
    "SELECT DISTINCT k, code FROM (SELECT * FROM p UNION SELECT * FROM q) x WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.k = x.k AND r.code = x.code AND NOT EXISTS (SELECT 1 FROM q WHERE q.k = r.k AND q.code = r.code))"
)
def i3_merge_with_reviews(spark, d):
    """Automatic pairs and accepted ones without the rejected; an acceptance wins over a rejection."""
    e = table(spark, d, "probe_records").withColumnRenamed("probe_id", "k")
    auto, accepted = (e.select("k", F.explode(c).alias("code")) for c in ("category_tags", "specialization_tags"))
    rejected = e.where("company_industry is not null").select("k", F.col("company_industry").alias("code"))
    return joins.merge_reviews(auto, accepted, rejected)


@query("SELECT (SELECT count(*) FROM (SELECT id FROM core_rows EXCEPT SELECT id FROM salary_audit)) AS only_a, (SELECT count(*) FROM (SELECT id FROM salary_audit EXCEPT SELECT id FROM core_rows)) AS only_b")
def i5_same_population(spark, d):
    a, b = table(spark, d, "core_rows").select("id").distinct(), table(spark, d, "salary_audit").select("id").distinct()
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return joins.side_by_side(n(a.join(b, "id", "left_anti"), "only_a"), n(b.join(a, "id", "left_anti"), "only_b"))


@query("SELECT id AS k, CAST(year AS VARCHAR) AS fact FROM source_rows WHERE load_id <= 2")
def j4_registration(spark, d):
    s = table(spark, d, "source_rows").select(F.col("id").alias("k"), F.col("year").cast("string").alias("fact"), "load_id")
    first = s.where("load_id = 1").drop("load_id")
    return publish.register(first, s.where("load_id <= 2").drop("load_id"), "k", ["fact"])


@query(
    "WITH c AS (SELECT year, count(*) AS n, sum(CASE WHEN salary_min IS NOT NULL THEN 1 ELSE 0 END) AS filled FROM jobs WHERE year IS NOT NULL GROUP BY 1) SELECT year, n, filled / n AS share, n >= 50 AND filled / n >= 0.2 AS passes FROM c"
)
def j8_quality_gate(spark, d):
    c = table(spark, d, "jobs").where("year is not null").groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.count("salary_min").alias("filled"))
    share = F.col("filled") / F.col("n")
    return c.select("year", "n", share.alias("share"), ((F.col("n") >= 50) & (share >= 0.2)).alias("passes"))


@query("SELECT probe_id, company_address IS NOT NULL AND contains(detailed_work_address, company_address) AS quoted FROM probe_records WHERE detailed_work_address IS NOT NULL")
def j9_quoted_evidence(spark, d):
    """Whether one field quotes another exactly (an evidence check, no training-data query)."""
    e = table(spark, d, "probe_records").where("detailed_work_address is not null")
    return e.select("probe_id", F.coalesce(F.contains("detailed_work_address", "company_address"), F.lit(False)).alias("quoted"))


@query("SELECT event_type, date_trunc('hour', ts) AS window_start, count(*) AS n FROM events GROUP BY 1, 2")
def m_stream_windows(spark, d):
    """The hourly windows of the event stream, run to its end, those still open included."""
    name, folder = f"windows_{uuid.uuid4().hex}", f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    stream = spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))

    def keep(updated, batch):
        # The same folder for a repeated batch, so that none counts twice.
        updated.write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch}")

    q = state.stream_windows(stream, "ts", "event_type").writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    kept = spark.read.schema("window_start timestamp, event_type string, n long, batch long").parquet(f"{folder}/{name}")
    return kept.groupBy(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type").agg(F.max_by("n", "batch").alias("n"))
