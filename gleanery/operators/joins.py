"""Joins with guarantees: what a dictionary look-up would refuse is counted before it is joined."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.session import small


def _keyed(df: DataFrame, key: str, columns: Sequence[str], side: str) -> DataFrame:
    return df.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__{side}_{c}") for c in columns], F.lit(True).alias(f"__in_{side}"))


def side_by_side(*rows: DataFrame) -> DataFrame:
    """One-row tables with different columns as one row."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def strict_check(left: DataFrame, right: DataFrame, key: str, agree: Sequence[str] = ()) -> DataFrame:
    """``matched, only_left, only_right, repeated_left, repeated_right, disagreeing`` of a 1:1 join.

    ``agree``: columns that must be equal on both sides (null equals null). Null keys match nothing.
    """
    joined = _keyed(left, key, agree, "l").join(_keyed(right, key, agree, "r"), "__k", "full_outer")
    differ = F.lit(False)
    for c in agree:
        differ = differ | ~F.col(f"__l_{c}").eqNullSafe(F.col(f"__r_{c}"))
    both = F.col("__in_l").isNotNull() & F.col("__in_r").isNotNull()
    main = joined.agg(
        F.count_if(both).alias("matched"),
        F.count_if(F.col("__in_r").isNull()).alias("only_left"),
        F.count_if(F.col("__in_l").isNull()).alias("only_right"),
        F.count_if(both & differ).alias("disagreeing"),
    )
    repeated = lambda df, n: df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if((F.col("n") > 1) & F.col(key).isNotNull()).alias(n))
    one = side_by_side(main, repeated(left, "repeated_left"), repeated(right, "repeated_right"))
    return one.select("matched", "only_left", "only_right", "repeated_left", "repeated_right", "disagreeing")


def strict_join(left: DataFrame, right: DataFrame, key: str, agree: Sequence[str] = ()) -> DataFrame:
    """The inner join, after ``strict_check`` found nothing missing, repeated or disagreeing."""
    r = strict_check(left, right, key, agree).first()
    faults = {k: r[k] for k in r.asDict() if k != "matched" and r[k]}
    if faults:
        raise ValueError(f"no one-to-one join: {faults}")
    return left.join(right.drop(*agree), key)


def coverage(left: DataFrame, key: str, mapping: DataFrame, label: str) -> DataFrame:
    """``used, unused, unmapped_values, unmapped_rows``: a mapping held against its use both ways."""
    use = left.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__v")).agg(F.count(F.lit(1)).alias("n"))
    listed = mapping.select(F.col(label).alias("__v")).where("__v is not null").distinct().withColumn("listed", F.lit(True))
    both = use.join(listed, "__v", "full_outer")
    here, there = F.col("n").isNotNull(), F.col("listed").isNotNull()
    return both.agg(
        F.count_if(here & there).alias("used"),
        F.count_if(~here).alias("unused"),
        F.count_if(~there).alias("unmapped_values"),
        F.coalesce(F.sum(F.when(~there, F.col("n"))), F.lit(0)).alias("unmapped_rows"),
    )


def compare(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``key, state, changed``: matched, modified, missing (only old) or extra (only new) per key.

    ``changed`` lists the columns whose values differ, null being a value of its own.
    """
    joined = _keyed(old, key, columns, "l").join(_keyed(new, key, columns, "r"), "__k", "full_outer")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"__l_{c}").eqNullSafe(F.col(f"__r_{c}")), F.lit(c)) for c in columns]))
    state = F.when(F.col("__in_r").isNull(), "missing").when(F.col("__in_l").isNull(), "extra").when(F.size(changed) > 0, "modified").otherwise("matched")
    empty = F.array().cast("array<string>")
    return joined.select(F.col("__k").alias(key), state.alias("state"), F.when(state == "modified", changed).otherwise(empty).alias("changed"))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of ``child`` whose key is not null and stands in no parent."""
    return child.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """``only_a, only_b, equal``: both differences of two tables as multisets of rows."""
    b = b.select(*a.columns)
    left, right = a.exceptAll(b).agg(F.count(F.lit(1)).alias("only_a")), b.exceptAll(a).agg(F.count(F.lit(1)).alias("only_b"))
    return side_by_side(left, right).withColumn("equal", (F.col("only_a") == 0) & (F.col("only_b") == 0))


def append_and_replace(base: DataFrame, new: DataFrame, key: str, scope: str) -> DataFrame:
    """``base`` with the rows inside ``scope`` (a condition) replaced by those of ``new`` that share
    their key; rows outside stay as they are, rows only in ``new`` are appended."""
    fresh = new.select(*base.columns)
    inside = base.where(scope)
    kept = base.where(f"not coalesce({scope}, false)").unionByName(inside.join(fresh.select(key), key, "left_anti"))
    known = base.where(f"not coalesce({scope}, false)").select(key)
    return kept.unionByName(fresh.join(known, key, "left_anti"))


def override(df: DataFrame, key: str, column: str, overrides: DataFrame, evidence: str | None = None) -> DataFrame:
    """``df`` with ``column`` replaced where ``overrides(key, expected, value)`` names the row.

    An override whose expected value no longer stands in the row is an error; with ``evidence``, the
    name of a column, so is one whose ``evidence_sha256`` is not that column's hash any more. A key
    that is overridden twice, or that stands in no row, is an error too (checked by ``override_faults``).
    """
    named = overrides.select(F.col(key).alias("__k"), F.col("expected").alias("__e"), F.col("value").alias("__v"), (F.col("evidence_sha256") if evidence else F.lit(None).cast("string")).alias("__h"), F.lit(True).alias("__hit"))
    joined = df.join(small(named), F.col(key) == F.col("__k"), "left")
    stale = F.raise_error(F.concat(F.lit("override of a changed row: "), F.col("__k").cast("string"))).cast("string")
    same = F.col("__e").eqNullSafe(F.col(column)) & (F.col("__h").eqNullSafe(F.sha2(F.col(evidence), 256)) if evidence else F.lit(True))
    value = F.when(F.col("__hit").isNull(), F.col(column)).when(same, F.col("__v")).otherwise(stale)
    return joined.withColumn(column, value).drop("__k", "__e", "__v", "__h", "__hit")


def override_faults(df: DataFrame, key: str, overrides: DataFrame) -> DataFrame:
    """``key, fault`` of overrides that cannot be applied: repeated, or of no row."""
    twice = overrides.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key, F.lit("repeated").alias("fault"))
    return twice.unionByName(overrides.select(key).distinct().join(df.select(key), key, "left_anti").withColumn("fault", F.lit("no_row")))


def merge_reviews(auto: DataFrame, accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    """Automatic and accepted rows without the rejected ones, each once; an acceptance wins."""
    refused = rejected.distinct().join(accepted.distinct(), rejected.columns, "left_anti")
    return auto.unionByName(accepted).distinct().join(refused, auto.columns, "left_anti")
