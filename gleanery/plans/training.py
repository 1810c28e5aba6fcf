"""Queries of the general training-data operators (p1, p5, p6) and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators import quality_profile as quality
from gleanery.operators.packed_values import split_packed
from gleanery.operators.units import parse_quantities, per_month, with_factors
from gleanery.session import table

# The raw columns of source_rows.
RAW_COLUMNS = (
    "id job_title company_name salary location job_type job_industry experience_level education_level job_position job_description benefits requirements year"
).split()


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place in ``location`` and every perk in ``benefits`` as its own row."""
    places = split_packed(table(spark, sf_dir, "source_rows"), "location", ["id"])
    perks = split_packed(table(spark, sf_dir, "core_rows"), "benefits", ["id"])
    named = [df.select(F.lit(n).alias("field_name"), "id", "pos", "item") for n, df in (("location", places), ("benefits", perks))]
    return named[0].unionByName(named[1])


def _profile(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict]:
    contract = quality.contract_of(table(spark, sf_dir, "column_contract"), RAW_COLUMNS)
    return quality.profile(table(spark, sf_dir, "source_rows"), "load_id", RAW_COLUMNS, contract), contract


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loads in which a column departs from the others, read off the profile."""
    profiled, contract = _profile(spark, sf_dir)
    mixed = [c for c in RAW_COLUMNS if contract.get(c, {}).get("check_mix")]
    return quality.departures(profiled, mixed).withColumnRenamed("load", "load_id")


def p5_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw column profiled per load, with the rows outside the induced expressions."""
    return _profile(spark, sf_dir)[0].withColumnRenamed("load", "load_id")


def p5_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expressions induced for every raw column, with their coverage in each load and elsewhere."""
    return quality.expression_coverage(table(spark, sf_dir, "source_rows"), "load_id", RAW_COLUMNS).withColumnRenamed("load", "load_id")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stated amount in VND per month."""
    audit = table(spark, sf_dir, "salary_audit").select("id", "salary", "currency", "period", "year")
    listed = table(spark, sf_dir, "jobs").where("salary_min is not null").select("id").distinct().withColumn("listed", F.lit(True))
    read = with_factors(parse_quantities(audit, "salary", "currency", "period"), table(spark, sf_dir, "fx_rates"), table(spark, sf_dir, "pay_periods"))
    amount = lambda c: per_month(F.col(c), F.col("rate_e6"), F.col("month_num"), F.col("month_den"))
    paid = read.select("id", amount("low_e4").alias("low"), amount("high_e4").alias("high")).join(listed, "id", "left")
    fields = F.array(
        F.struct(F.lit("salary_min").alias("field_name"), F.col("low").alias("vnd_month")),
        F.struct(F.lit("salary_max").alias("field_name"), F.col("high").alias("vnd_month")),
        F.struct(F.lit("jobs_salary_min").alias("field_name"), F.when(F.col("listed"), F.col("low")).alias("vnd_month")),
    )
    return paid.select("id", F.explode(fields).alias("f")).select("id", "f.field_name", "f.vnd_month").where("vnd_month is not null")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p5_found": p5_found,
    "p5_profile": p5_profile,
    "p5_expressions": p5_expressions,
    "p6_found": p6_found,
}


def _found_sql() -> str:
    """p5_found in SQL, column by column."""
    text = [c for c in RAW_COLUMNS if c not in ("id", "year")]
    long = " UNION ALL ".join(
        f"SELECT load_id, '{c}' AS column_name, CAST({c} AS VARCHAR) AS v, "
        + (f"{c} IS NOT NULL AND trim(regexp_replace({c}, '[[:space:]\\x{{00a0}}\\x{{2000}}-\\x{{200a}}\\x{{3000}}]', ' ', 'g')) = ''" if c in text else "false")
        + " AS is_blank FROM source_rows"
        for c in RAW_COLUMNS
    )
    return f"""
WITH l AS ({long}),
k AS (
  SELECT l.load_id, l.column_name, count(*) AS n_rows, sum(CASE WHEN v IS NULL THEN 1 ELSE 0 END) AS nulls,
    sum(CASE WHEN is_blank THEN 1 ELSE 0 END) AS blanks, sum(CASE WHEN v IS NOT NULL AND NOT is_blank THEN 1 ELSE 0 END) AS checked,
    sum(CASE WHEN v IS NOT NULL AND NOT is_blank AND c.value_pattern IS NOT NULL AND NOT regexp_matches(v, c.value_pattern) THEN 1 ELSE 0 END) AS pattern_breaks,
    sum(CASE WHEN v IS NOT NULL AND NOT is_blank AND (try_cast(v AS BIGINT) < c.min_allowed OR try_cast(v AS BIGINT) > c.max_allowed) THEN 1 ELSE 0 END) AS range_breaks
  FROM l JOIN column_contract c ON c.column_name = l.column_name GROUP BY 1, 2),
s AS (
  SELECT load_id, column_name, 'nulls' AS change_kind, nulls / n_rows AS share FROM k
  UNION ALL SELECT load_id, column_name, 'blanks', blanks / n_rows FROM k
  UNION ALL SELECT load_id, column_name, 'pattern', CASE WHEN checked = 0 THEN 0 ELSE pattern_breaks / checked END FROM k
  UNION ALL SELECT load_id, column_name, 'range', CASE WHEN checked = 0 THEN 0 ELSE range_breaks / checked END FROM k),
m AS (SELECT column_name, change_kind, median(share) AS usual FROM s GROUP BY 1, 2),
v AS (SELECT l.load_id, l.column_name, v, count(*) AS n FROM l JOIN column_contract c ON c.column_name = l.column_name AND c.check_mix
  WHERE v IS NOT NULL AND NOT is_blank GROUP BY 1, 2, 3),
g AS (SELECT a.load_id, b.column_name, b.v, coalesce(sum(CASE WHEN b.load_id = a.load_id THEN b.n END), 0) AS own, sum(b.n) AS whole
  FROM (SELECT DISTINCT load_id FROM v) a, v b GROUP BY 1, 2, 3),
t AS (SELECT load_id, column_name, sum(own) AS own_all, sum(whole) AS whole_all FROM g GROUP BY 1, 2),
d AS (SELECT g.load_id, g.column_name, sum(abs(own / own_all - (whole - own) / (whole_all - own_all))) / 2 AS distance
  FROM g JOIN t USING (load_id, column_name) WHERE own_all > 0 AND whole_all > own_all GROUP BY 1, 2)
SELECT s.load_id, s.column_name, s.change_kind FROM s JOIN m USING (column_name, change_kind) WHERE share - usual > 0.21
UNION ALL SELECT load_id, column_name, 'mix' FROM d WHERE distance > 0.41"""


SQL: dict[str, str] = {"p5_found": _found_sql()}
