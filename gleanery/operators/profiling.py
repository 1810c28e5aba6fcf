"""Profiles of fields, values and keys, each in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import strip


def _long(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    return df.select(*keep, F.explode(F.array(*pairs)).alias("p")).select(*keep, "p.*")


def field_profile(df: DataFrame, columns: Sequence[str], sentinels: Sequence[str] = ()) -> DataFrame:
    """``column_name, n_rows, nulls, blanks, distinct_values, sentinel_hits``; one row per column.

    Values are judged and hashed (twice 64 bits) in the scan and counted by hash, so that no text is
    shuffled and a value of any frequency is one row in the distinct count; blanks are texts of white
    space only.
    """
    v, words = F.col("value"), [s.lower() for s in sentinels]
    judged = _long(df, columns).select(
        "column_name", F.xxhash64(v).alias("h"), F.xxhash64(F.lit(1), v).alias("g"), v.isNull().alias("null"), F.coalesce(strip(v) == "", F.lit(False)).alias("blank"), F.coalesce(F.lower(strip(v)).isin(words), F.lit(False)).alias("sentinel")
    )
    counted = judged.groupBy(*judged.columns).agg(F.count(F.lit(1)).alias("n"))
    rows = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0))
    return counted.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"), rows("null").alias("nulls"), rows("blank").alias("blanks"), F.count_if(~F.col("null")).alias("distinct_values"), rows("sentinel").alias("sentinel_hits")
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, value, n`` of every value of low-cardinality columns, nulls included."""
    return _long(df, columns).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def cross_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """``a, b, n``."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def key_checks(df: DataFrame, key: str) -> DataFrame:
    """``n_rows, distinct_keys, repeated_keys, null_keys, least, greatest`` of a key."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    return per.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"),
        F.count(key).alias("distinct_keys"),
        F.count_if(F.col(key).isNotNull() & (F.col("__n") > 1)).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("__n"))), F.lit(0)).alias("null_keys"),
        F.min(key).alias("least"),
        F.max(key).alias("greatest"),
    )


def json_shapes(df: DataFrame, column: str) -> DataFrame:
    """``field, type, n, distinct_values`` of the top-level fields of a JSON column, with a row each for
    texts that are null (``<null>``), no JSON (``<broken>``) or no object (``<other>``)."""
    c = F.col(column)
    parsed = df.select(c.alias("__t"), F.try_parse_json(c).alias("__v"))
    kind = F.schema_of_variant("__v")
    void = F.when(F.col("__t").isNull(), "<null>").when(F.col("__v").isNull(), "<broken>").when(~kind.startswith("OBJECT"), "<other>")
    odd = parsed.select(void.alias("field")).where("field is not null").groupBy("field").agg(F.count(F.lit(1)).alias("n")).select("field", F.lit(None).cast("string").alias("type"), "n", F.lit(None).cast("long").alias("distinct_values"))
    objects = parsed.where(F.col("__v").isNotNull() & kind.startswith("OBJECT")).select("__v")
    fields = objects.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("__v").outer())).select(F.col("key").alias("field"), F.schema_of_variant("value").alias("type"), F.to_json("value").alias("value"))
    return fields.groupBy("field", "type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("value").alias("distinct_values")).unionByName(odd)
