"""Queries of the llm operators (p2, p3, p4, p7, p8, p9). None can be said in SQL; tests hold brute-force versions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import addresses, canonical, encodings, mixing, names, tokens
from gleanery.operators.packed_values import split_packed
from gleanery.session import table


def _companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    core = table(spark, sf_dir, "core_rows").select(F.col("company_name_clean").alias("name"))
    probe = table(spark, sf_dir, "probe_records").select(F.col("company_name").alias("name"))
    return names.link_names(core.unionByName(probe))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each pair of spellings of one employer."""
    return names.same_name_pairs(_companies(spark, sf_dir))


def p2_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per spelling with the employer it names."""
    return _companies(spark, sf_dir)


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs, source = table(spark, sf_dir, "ref_values"), table(spark, sf_dir, "source_rows")
    entries = {f: canonical.entries_of(refs, f) for f in ("location", "job_industry", "job_title_clean")}
    places = split_packed(source, "location", ["id"])
    industry = source.where(canonical.not_blank(F.col("job_industry"))).select("id", F.lit(1).alias("pos"), F.col("job_industry").alias("item"))
    core = table(spark, sf_dir, "core_rows")
    title = core.where(canonical.not_blank(F.col("job_title_clean"))).select("id", F.lit(1).alias("pos"), F.col("job_title_clean").alias("item"))
    parts = [
        canonical.map_values(places, "item", entries["location"]).withColumn("field_name", F.lit("location")),
        canonical.map_values(industry, "item", entries["job_industry"]).withColumn("field_name", F.lit("job_industry")),
        canonical.map_values(title, "item", entries["job_title_clean"], parts=True, aliases=canonical.ROLE_WORDS).withColumn("field_name", F.lit("job_title_clean")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entry each place, industry and title means, 0 if the list has none."""
    return _mapped(spark, sf_dir).select("field_name", "id", "pos", "ref_id")


def p3_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values the list has no entry for, with the rows they stand in."""
    return _mapped(spark, sf_dir).where("ref_id = 0").groupBy("field_name", "item").agg(F.count(F.lit(1)).alias("n_rows"))


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = canonical.entries_of(table(spark, sf_dir, "ref_values"), "location")
    return addresses.link_addresses(table(spark, sf_dir, "probe_records"), "probe_id", "detailed_work_address", "location_raw", entries)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each pair of records at one workplace."""
    return addresses.same_place_pairs(_places(spark, sf_dir), "probe_id_a", "probe_id_b")


def p4_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per record with the workplace its address denotes."""
    return _places(spark, sf_dir).withColumnRenamed("record", "probe_id")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of every document."""
    return tokens.encode_column(table(spark, sf_dir, "documents"), "doc_id", "text")


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs = table(spark, sf_dir, "documents")
    sized = mixing.sizes(docs, "doc_id", "text", "source")
    return docs, sized, mixing.plan_mix(sized, table(spark, sf_dir, "mix_targets"), "doc_id", "source")


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed and shuffled documents."""
    docs, _, plan = _mix(spark, sf_dir)
    return mixing.mix(docs, plan, "doc_id", "source", ["doc_id", "source", "text"])


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares the mixture reaches."""
    _, sized, plan = _mix(spark, sf_dir)
    return mixing.shares(sized, plan, "doc_id", "source")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with a garbled stretch."""
    return encodings.restore_documents(table(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id")


def p9_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The garbled documents with their texts as far as they can be restored."""
    return encodings.restore_documents(table(spark, sf_dir, "documents"), "doc_id", "text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p2_found, p2_companies, p3_found, p3_unmatched, p4_found, p4_places, p7_ids, p8_mix, p8_shares, p9_found, p9_restored)
}
SQL: dict[str, str] = {}
