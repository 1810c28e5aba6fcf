"""Deterministic samples: by hash, by order, by stratum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sub-groups in which a group is ranked before its bests are ranked together.
SALTS = 64


def split_of(digest: Column, parts: int = 5) -> Column:
    """holdout for one in ``parts`` of all hex digests, else train."""
    return F.when(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % parts == 0, "holdout").otherwise("train")


def first_per_group(df: DataFrame, groups: Sequence[str], order: Sequence, k: int, place: str = "place") -> DataFrame:
    """The first ``k`` rows of every group in ``order``, numbered from 1.

    A group is ranked in ``SALTS`` hashed parts first and only the first ``k`` of each part are
    ranked together, so a group of any size is never sorted in one task. Ties need a unique order.
    """
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*[c if isinstance(c, str) else c for c in df.columns if dict(df.dtypes)[c] != "map"]), F.lit(SALTS)))
    inner = Window.partitionBy(*groups, "__salt").orderBy(*order)
    outer = Window.partitionBy(*groups).orderBy(*order)
    bests = salted.withColumn("__r", F.row_number().over(inner)).where(F.col("__r") <= k)
    return bests.withColumn(place, F.row_number().over(outer)).where(F.col(place) <= k).drop("__salt", "__r")


def hash_top(df: DataFrame, groups: Sequence[str], key: Column, k: int, k_of: Column | None = None) -> DataFrame:
    """The ``k`` rows of every group with the smallest SHA-256 of ``key``; equal keys count once.
    ``k_of``: how many a group's rows say it has, at most ``k``."""
    scored = df.withColumn("score", F.sha2(key, 256)).dropDuplicates([*groups, "score"])
    best = first_per_group(scored, groups, ["score"], k)
    return best if k_of is None else best.where(F.col("place") <= k_of)


def stratified(df: DataFrame, stratum: str, turn: str, key: Column, k: int) -> DataFrame:
    """Round robin: ``k`` rows per stratum, one of each ``turn`` value after the other, in hash order."""
    scored = df.withColumn("score", F.sha2(key, 256))
    ranked = first_per_group(scored, [stratum, turn], ["score"], k, "round")
    return first_per_group(ranked, [stratum], ["round", turn], k)


def without(df: DataFrame, key: Column, seen: DataFrame, seen_key: str) -> DataFrame:
    """``df`` without the rows whose key was sampled before."""
    return df.withColumn("__k", key).join(seen.select(F.col(seen_key).alias("__k")), "__k", "left_anti").drop("__k")
