"""Mixing sources to target shares by Poisson replication.

Each document is repeated a number of times drawn by inverting a Poisson distribution at a seeded
hash of its key. The distribution is cut off at the source's largest number of repeats, its mean is
set so that the cut-off mean is the wanted rate, and the copies are shuffled globally. Documents are
never moved to size the sources: only their token counts are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.tokens import count_tokens
from gleanery.session import cut, small


def tails(rate: float, most: int) -> tuple[float, ...]:
    """P(count >= k) for k = 1..most of a Poisson count cut off at ``most`` whose mean is ``rate``."""

    def at(mean: float) -> list[float]:
        term, below, out = math.exp(-mean), 0.0, []
        for k in range(most):
            below += term
            out.append(max(0.0, 1 - below))
            term *= mean / (k + 1)
        return out

    if most <= 0 or rate <= 0:
        return (0.0,) * max(0, most)
    if rate >= most:
        return (1.0,) * most
    low, high = 0.0, 1.0
    while sum(at(high)) < rate and high < 700:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(at(mid)) < rate else (low, mid)
    return tuple(at(high))


def held_tails(rate: float, most: int) -> list[float]:
    """``tails`` without the probabilities that no hash of 53 bits falls below, so that their number
    follows the rate and not the largest number of repeats."""
    whole = tails(rate, min(most, int(rate + 12 * math.sqrt(rate + 1)) + 30)) if rate < most else (1.0,) * most
    return [p for p in whole if p >= 2.0**-53]


def repeats(key: Column, tail: Column, seed: Column) -> Column:
    """The count of a document: how many tail probabilities exceed its hash in [0, 1)."""
    u = F.shiftrightunsigned(F.xxhash64(seed, key), 11) / F.lit(float(1 << 53))
    return F.size(F.filter(tail, lambda p: u < p))


def plan_mix(sized: DataFrame, targets: DataFrame, key: str, source: str, total: float | None = None) -> DataFrame:
    """What each source of ``targets(source, target_share, max_repeats)`` contributes, a row each:
    source, ``target_share, max_repeats, documents, tokens, wanted_share, rate, tail``.

    ``sized``: key, source, n_tokens. ``total``: wanted tokens; by default the largest total at
    which no source must exceed its repeats. ``wanted_share`` counts over the sources that hold
    tokens and may be used; a source listed twice has the sum of its shares.
    """
    want = targets.where(F.col(source).isNotNull()).groupBy(source).agg(F.coalesce(F.sum(F.col("target_share").cast("double")), F.lit(0.0)).alias("target_share"), F.coalesce(F.max("max_repeats"), F.lit(0)).cast("int").alias("max_repeats"))
    size = sized.groupBy(source).agg(F.count(F.lit(1)).alias("documents"), F.sum("n_tokens").alias("tokens"))
    plan = want.join(size, source, "left").fillna(0, ["documents", "tokens"])
    usable = (F.col("tokens") > 0) & (F.col("max_repeats") > 0) & (F.col("target_share") > 0)
    shares_ = plan.where(usable).agg(F.sum("target_share").alias("s")).first()["s"]
    wanted = F.when(usable, F.col("target_share") / F.lit(shares_)).otherwise(0.0)
    plan = cut(plan.withColumn("wanted_share", wanted))
    if total is None:
        total = plan.where("wanted_share > 0").agg(F.min(F.col("max_repeats") * F.col("tokens") / F.col("wanted_share")).alias("t")).first()["t"]
    rate = F.when(F.col("wanted_share") > 0, F.least(F.col("max_repeats").cast("double"), F.lit(float(total or 0)) * F.col("wanted_share") / F.col("tokens"))).otherwise(0.0)

    @F.pandas_udf("array<double>")
    def tail(rates: pd.Series, most: pd.Series) -> pd.Series:
        return pd.Series([held_tails(float(r), int(m)) for r, m in zip(rates, most)])

    return cut(plan.withColumn("rate", rate).withColumn("tail", tail("rate", "max_repeats")))


def _drawn(df: DataFrame, plan: DataFrame, key: str, source: str, seed: int) -> DataFrame:
    """``df`` of the planned sources with ``__n``, how often each document is taken."""
    tail = plan.where("rate > 0").select(F.col(source).alias("__source"), F.col("tail").alias("__tail"))
    met = df.join(small(tail), F.col(source) == F.col("__source"))
    return met.withColumn("__n", repeats(F.col(key), F.col("__tail"), F.lit(seed))).drop("__source", "__tail")


def sizes(docs: DataFrame, key: str, text: str, source: str, path: str | None = None) -> DataFrame:
    """``key, source, n_tokens``, kept in the shared folder: texts are encoded once."""
    return cut(count_tokens(docs.select(key, source, text), text, path=path))


def mix(docs: DataFrame, plan: DataFrame, key: str, source: str, keep: Sequence[str], seed: int = 0) -> DataFrame:
    """The mixture: ``keep`` columns, ``copy`` (from 1) and ``shuffle_key``, in the order of the latter.

    A document appears at most ``max_repeats`` times; null and unlisted sources, for which there is
    no target, contribute nothing; rows with the same key are repeated equally; an empty plan
    gives an empty mixture. One seed draws all sources: the shares reached are those of one draw
    and are reported beside the wanted ones, not fitted to them.
    """
    drawn = _drawn(docs.select(*dict.fromkeys([key, source, *keep])), plan, key, source, seed).where("__n > 0")
    copies = drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    return copies.select(*keep, "copy", F.xxhash64(F.lit(seed), F.lit("order"), key, "copy").alias("shuffle_key")).orderBy("shuffle_key", "copy")


def shares(sized: DataFrame, plan: DataFrame, key: str, source: str, seed: int = 0) -> DataFrame:
    """The shares reached: one row per listed source, those without documents included; ``deviation``
    is ``reached_share`` less ``wanted_share``."""
    drawn = _drawn(sized, plan, key, source, seed)
    got = cut(drawn.groupBy(source).agg(F.sum("__n").alias("mixed_documents"), F.sum(F.col("__n") * F.col("n_tokens")).alias("mixed_tokens"), F.max("__n").alias("most_copies")))
    whole = got.agg(F.sum("mixed_tokens").alias("t")).first()["t"]
    out = plan.drop("tail").join(small(got), source, "left").fillna(0, ["mixed_documents", "mixed_tokens", "most_copies"])
    out = out.withColumn("reached_share", F.coalesce(F.try_divide(F.col("mixed_tokens"), F.lit(whole)), F.lit(0.0)))
    return out.withColumn("deviation", F.col("reached_share") - F.col("wanted_share"))
