"""Row keys, content fingerprints, digests of tables, duplicate groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def json_value(df: DataFrame, name: str) -> Column:
    """A value as JSON: texts quoted, numbers bare, null as null."""
    c = df[name]
    if dict(df.dtypes)[name] == "string":
        quoted = F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)
        return F.when(c.isNull(), "null").otherwise(quoted)
    if dict(df.dtypes)[name].startswith("array"):
        return F.coalesce(F.to_json(c), F.lit("null"))
    return F.coalesce(c.cast("string"), F.lit("null"))


def fingerprint(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 of the compact JSON array of the values in the given order; nothing is trimmed."""
    return F.sha2(F.concat(F.lit("["), F.concat_ws(",", *[json_value(df, c) for c in columns]), F.lit("]")), 256)


def row_keys(df: DataFrame, file_hash: Column, index: Column) -> DataFrame:
    """``df`` with ``record_key``: SHA-256 of file hash and row number within the file."""
    return df.withColumn("record_key", F.sha2(F.concat_ws(":", file_hash, index.cast("string")), 256))


def field_hashes(df: DataFrame, columns: Sequence[str]) -> Column:
    """One hash per field, so that null, empty text and 0 differ and a change can be located."""
    return F.array(*[F.sha2(F.concat(F.lit("t:" if dict(df.dtypes)[c] == "string" else "n:"), json_value(df, c)), 256) for c in columns])


def digest_parts(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """The aggregates of ``digest``."""
    part = F.conv(F.substring(fingerprint(df, columns), 1, 12), 16, 10).cast("decimal(20,0)")
    return [F.count(F.lit(1)).alias("n_rows"), F.sum(part).cast("decimal(38,0)").alias("digest")]


def digest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``n_rows, digest``: a digest of a table as a multiset of rows, whatever their order."""
    return df.agg(*digest_parts(df, columns)).select("n_rows", F.coalesce("digest", F.lit(0)).cast("decimal(38,0)").cast("string").alias("digest"))


def duplicate_groups(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """``fingerprint, n_rows, first_member`` of each content that stands in two rows or more.

    Membership is in ``duplicate_members``: a group is never gathered into one value.
    """
    return df.select(fingerprint(df, columns).alias("fingerprint"), key).groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("first_member")).where("n_rows > 1")


def duplicate_members(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """``fingerprint, key`` of every row whose content stands in another row too."""
    keyed = df.select(fingerprint(df, columns).alias("fingerprint"), key)
    return keyed.join(duplicate_groups(df, columns, key).select("fingerprint"), "fingerprint", "left_semi")


def review_sample(groups: DataFrame, largest: int = 50, total: int = 100) -> DataFrame:
    """The largest groups (ties to the first member), then others in hash order up to ``total``."""
    top = groups.orderBy(F.desc("n_rows"), "first_member").limit(largest)
    rest = groups.join(top.select("fingerprint"), "fingerprint", "left_anti").orderBy("fingerprint").limit(total)
    ranked = top.withColumn("tier", F.lit(1)).unionByName(rest.withColumn("tier", F.lit(2)))
    w = Window.orderBy("tier", F.desc(F.when(F.col("tier") == 1, F.col("n_rows"))), F.when(F.col("tier") == 1, F.col("first_member")), "fingerprint")
    return ranked.withColumn("place", F.row_number().over(w)).where(F.col("place") <= total).drop("tier")  # at most largest + total rows
