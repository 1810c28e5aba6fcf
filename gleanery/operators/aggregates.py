"""Quality counters, coverage cubes, functional dependencies, precision and recall."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counters(df: DataFrame, by: str, metrics: Mapping[str, Column]) -> DataFrame:
    """``by, metric, value, n``: how often each value of each metric occurs, per ``by`` and (null) in all."""
    pairs = [F.struct(F.lit(k).alias("metric"), c.cast("string").alias("value")) for k, c in metrics.items()]
    long = df.select(by, F.explode(F.array(*pairs)).alias("m")).select(by, "m.*")
    per = long.groupBy(by, "metric", "value").agg(F.count(F.lit(1)).alias("n"))
    return per.withColumn("level", F.lit("each")).unionByName(
        per.groupBy("metric", "value").agg(F.sum("n").alias("n")).withColumn(by, F.lit(None).cast(dict(df.dtypes)[by])).withColumn("level", F.lit("all"))
    )


def changes(df: DataFrame, pairs: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """``field, changed, before, after``: rows changed and distinct values on both sides."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("field"), a.cast("string").alias("a"), b.cast("string").alias("b")) for k, (a, b) in pairs.items()])).alias("p")).select("p.*")
    counted = long.groupBy("field", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("field").agg(
        F.sum(F.when(~F.col("a").eqNullSafe(F.col("b")), F.col("n")).otherwise(0)).alias("changed"),
        F.count_distinct("a").alias("before"),
        F.count_distinct("b").alias("after"),
    )


def coverage_cube(df: DataFrame, keys: Sequence[str], flags: Mapping[str, Column]) -> DataFrame:
    """``keys, n_rows`` and a count per flag."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(c).alias(k) for k, c in flags.items()])


def histogram(df: DataFrame, keys: Sequence[str], example: str) -> DataFrame:
    """``keys, n, example``: combinations with their least example."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(example).alias("example"))


def dependency_breaks(df: DataFrame, code: str, name: str) -> DataFrame:
    """``code, names``: codes that stand with more than one name."""
    return df.where(F.col(code).isNotNull()).select(code, name).distinct().groupBy(code).agg(F.count(name).alias("names")).where("names > 1")


def precision_recall(df: DataFrame, stratum: str, found: str, meant: str) -> DataFrame:
    """``stratum, tp, fp, fn, precision, recall, f1`` of label lists; null lists are empty, ratios
    without denominator null. An abstention is a list without labels and counts as missed."""
    a, b = (F.coalesce(F.col(c), F.array().cast("array<string>")) for c in (found, meant))
    sums = df.groupBy(stratum).agg(
        F.sum(F.size(F.array_intersect(a, b))).alias("tp"), F.sum(F.size(F.array_except(a, b))).alias("fp"), F.sum(F.size(F.array_except(b, a))).alias("fn")
    )
    p, r = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    return sums.withColumn("precision", p).withColumn("recall", r).withColumn("f1", F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")))


def constraints(violations: Mapping[str, DataFrame]) -> DataFrame:
    """``rule, breaks``: how many rows each rule's query of violations returns."""
    return reduce(DataFrame.unionByName, [df.agg(F.lit(rule).alias("rule"), F.count(F.lit(1)).alias("breaks")) for rule, df in violations.items()])
