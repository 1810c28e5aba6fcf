"""Labels: dictionary look-up, several labels in one field, preferred spellings, roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions.text import collapse
from gleanery.session import cut, small


def look_up(df: DataFrame, column: str, dictionary: DataFrame, label: str = "label", values: tuple[str, ...] = ("category", "status")) -> DataFrame:
    """``df`` with the dictionary's ``values`` for ``column``, matched without regard to case.

    Nulls and blanks have status ``missing``, unknown labels ``unmapped``; a label listed twice in
    the dictionary is an error.
    """
    d = dictionary.groupBy(F.lower(collapse(F.col(label))).alias("__label")).agg(*[F.max(v).alias(v) for v in values], F.count(F.lit(1)).alias("__n"))
    d = d.withColumn("__ok", F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit("label listed twice: "), "__label")).cast("boolean")).otherwise(True)).where("__ok")
    key = F.lower(collapse(F.col(column)))
    joined = df.withColumn("__key", key).join(small(d.drop("__n")), F.col("__key") == F.col("__label"), "left")
    if "status" in values:
        state = F.when(F.coalesce("__key", F.lit("")) == "", "missing").when(F.col("__label").isNull(), "unmapped").otherwise(F.col("status"))
        joined = joined.withColumn("status", state)
    return joined.drop("__key", "__label", "__ok")


def multi_label(column: Column, types: dict[str, str], others: dict[str, str]) -> Column:
    """``struct(types, label_group, unknown, status)`` of a comma-separated list of labels.

    ``types`` maps labels to types, ``others`` labels that are known but no type. Statuses:
    missing, mapped, partial (known beside unknown), unmapped.
    """
    parts = F.filter(F.transform(F.split(column, ","), lambda x: F.lower(collapse(x))), lambda x: x != "")
    table = F.create_map(*[F.lit(x) for k, v in types.items() for x in (k.lower(), v)])
    known = F.array(*[F.lit(k.lower()) for k in (*types, *others)])
    found = F.array_sort(F.array_distinct(F.filter(F.transform(parts, lambda x: F.try_element_at(table, x)), lambda x: x.isNotNull())))
    unknown = F.array_distinct(F.filter(parts, lambda x: ~F.array_contains(known, x)))
    seen = F.filter(parts, lambda x: F.array_contains(known, x))
    group = F.when(F.size(found) > 1, "multiple").when(F.size(found) == 1, found[0]).otherwise("unknown")
    status = (
        F.when(column.isNull() | (F.size(parts) == 0), "missing")
        .when((F.size(unknown) > 0) & (F.size(seen) > 0), "partial")
        .when(F.size(unknown) > 0, "unmapped")
        .otherwise("mapped")
    )
    return F.struct(found.alias("types"), group.alias("label_group"), unknown.alias("unknown"), status.alias("status"))


def preferred_spelling(df: DataFrame, column: str) -> DataFrame:
    """``key, spelling, n_spellings, n_rows``: per case-insensitive name the most frequent spelling.

    Ties go to the spelling first in code-point order; nulls and blanks have none. Counting comes
    before grouping, so a name that fills a third of the table is one row per spelling.
    """
    clean = collapse(F.col(column))
    per = df.where(clean != "").groupBy(F.lower(clean).alias("key"), clean.alias("spelling")).agg(F.count(F.lit(1)).alias("__n"))
    return per.groupBy("key").agg(F.min_by("spelling", F.struct(-F.col("__n"), F.col("spelling"))).alias("spelling"), F.count(F.lit(1)).alias("n_spellings"), F.sum("__n").alias("n_rows"))


def equivalence_key(column: Column) -> Column:
    """Labels whose slash-separated parts are the same in any order get the same key; labels with
    commas, semicolons or brackets stay ordered."""
    clean = F.lower(collapse(column))
    parts = F.array_sort(F.filter(F.transform(F.split(clean, "/"), lambda x: collapse(x)), lambda x: x != ""))
    return F.when(clean.rlike(r"[,;()\[\]]"), F.concat(F.lit("ordered:"), clean)).otherwise(F.concat(F.lit("set:"), F.array_join(parts, "/")))


def roll_up(spark: SparkSession, edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """``label, root, steps``: every label followed to the end of its parent chain, however long.

    A label without a parent is its own root; a cycle is an error, as are two parents of one label.
    Chains are followed by doubling: a chain of n steps takes log2(n) rounds, and what is still
    open after as many rounds as all labels together could need is a cycle.
    """
    named = edges.select(F.col(child).alias("label"), F.col(parent).alias("root")).where("label is not null and root is not null").distinct()
    walked = cut(named.withColumn("steps", F.lit(1).cast("long")))
    if not walked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        raise ValueError("a label with two parents")
    tops = walked.select(F.col("root").alias("label")).distinct().join(walked, "label", "left_anti")
    for _ in range(walked.count().bit_length() + 1):
        on = walked.select(F.col("label").alias("__at"), F.col("root").alias("__next"), F.col("steps").alias("__more"))
        moved = walked.join(on, F.col("root") == F.col("__at"), "left")
        walked = cut(moved.select("label", F.coalesce("__next", "root").alias("root"), (F.col("steps") + F.coalesce("__more", F.lit(0))).alias("steps"), F.col("__next").isNull().alias("done")))
        if walked.where("not done").isEmpty():
            break
        walked = walked.drop("done")
    else:
        raise ValueError("a cycle of parents")
    return walked.drop("done").unionByName(tops.select("label", F.col("label").alias("root"), F.lit(0).cast("long").alias("steps")))


def label_scope(df: DataFrame, label: str, least: int) -> DataFrame:
    """``df`` with ``label_rows`` and ``in_scope``: labels with at least ``least`` rows.

    The counts are aggregated first and joined back, so a hot label is no hot window.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("label_rows"))
    joined = df.join(small(counts.withColumnRenamed(label, "__label")), df[label].eqNullSafe(F.col("__label")), "left").drop("__label")
    return joined.withColumn("in_scope", F.col(label).isNotNull() & (F.col("label_rows") >= least))


def most_common(df: DataFrame, label: str, k: int) -> DataFrame:
    """The ``k`` most frequent labels, ties in label order: a report."""
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), label).limit(k)


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key: the last in ``order`` (largest values win, ties to the larger row)."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(order, *[F.col(c).cast("string") for c in others])).alias("r")).select(key, "r.*")




def display_of(column: Column, dictionary: dict[str, str], separator: str | None = None) -> Column:
    """The preferred spelling of a label by a dictionary, whatever its case; unknown labels only have
    their spacing settled. With ``separator`` of every label of a list, in order, blanks left out."""
    names = F.create_map(*[F.lit(x) for k, v in dictionary.items() for x in (k.lower(), v)])
    one = lambda x: F.coalesce(F.try_element_at(names, F.lower(collapse(x))), collapse(x))
    if separator is None:
        return F.nullif(one(column), F.lit(""))
    parts = F.filter(F.transform(F.split(column, separator), one), lambda x: x != "")
    return F.nullif(F.array_join(parts, f"{separator.strip()} "), F.lit(""))


def facets(df: DataFrame, column: str, dictionary: DataFrame, label: str, names: tuple[str, ...]) -> DataFrame:
    """``df`` with an array for each facet in ``names`` (the dictionary lists values split by '|') and
    ``status``: missing, mapped or unmapped."""
    d = dictionary.select(F.lower(collapse(F.col(label))).alias("__label"), *[F.filter(F.split(F.coalesce(n, F.lit("")), r"\|"), lambda x: x != "").alias(n) for n in names])
    joined = df.withColumn("__key", F.lower(collapse(F.col(column)))).join(small(d), F.col("__key") == F.col("__label"), "left")
    state = F.when(F.coalesce("__key", F.lit("")) == "", "missing").when(F.col("__label").isNull(), "unmapped").otherwise("mapped")
    empty = F.array().cast("array<string>")
    return joined.withColumns({n: F.coalesce(n, empty) for n in names}).withColumn("status", state).drop("__key", "__label")


def typography(column: Column) -> Column:
    """A label as it is printed: single spaces, one on each side of slashes, ampersands and dashes
    between words, none before commas, no full stop or separator at its ends, first letter a capital."""
    t = collapse(column)
    t = F.regexp_replace(t, r"\s*([/&])\s*", " $1 ")
    t = F.regexp_replace(t, r"\s+[-–—]\s+", " - ")
    t = F.regexp_replace(F.regexp_replace(t, r"\s+([,;:])", "$1"), r"([,;:])(?=\S)", "$1 ")
    t = F.regexp_replace(collapse(t), r"^[\s/&,;:.\-–—]+|[\s/&,;:.\-–—]+$", "")
    return F.nullif(F.concat(F.upper(F.substring(t, 1, 1)), F.substr(t, F.lit(2))), F.lit(""))


def arrangement(column: Column, arrangements: dict[str, str], shifts: tuple[str, ...]) -> Column:
    """``struct(arrangement, shift_work)`` of a comma-separated list of labels."""
    parts = F.transform(F.split(column, ","), lambda x: F.lower(collapse(x)))
    names = F.create_map(*[F.lit(x) for k, v in arrangements.items() for x in (k.lower(), v)])
    found = F.array_sort(F.array_distinct(F.array_compact(F.transform(parts, lambda x: F.try_element_at(names, x)))))
    shift = F.coalesce(F.exists(parts, lambda x: x.isin([s.lower() for s in shifts])), F.lit(False))
    return F.struct(F.when(F.size(found) == 1, F.get(found, F.lit(0))).when(F.size(found) > 1, "mixed").alias("arrangement"), shift.alias("shift_work"))


def families(text: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The families (family, pattern, exclusion) whose pattern stands in the text and whose exclusion
    does not, sorted; null texts have none."""
    hit = lambda p, no: text.rlike(p) & (~text.rlike(no) if no else F.lit(True))
    return F.array_compact(F.array(*[F.when(hit(p, no), F.lit(f)) for f, p, no in sorted(rules)]))


def occupation(df: DataFrame, title: str, source: str, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``df`` with ``families`` of the title, ``status``, ``family`` and ``overrides_source``.

    One family in the title assigns it, several are multiple_or_ambiguous; without any, what the
    source's own label touches only proposes (needs_review). A family that the source's label
    contradicts is marked. Null and blank titles are missing.
    """
    d = df.withColumn("families", families(F.col(title), rules)).withColumn("__said", families(F.col(source), rules))
    one, said = F.size("families") == 1, F.size("__said") > 0
    status = F.when(F.coalesce(title, F.lit("")) == "", "missing").when(F.size("families") > 1, "multiple_or_ambiguous").when(one, "assigned").when(said, "needs_review").otherwise("unmapped")
    family = F.when(one, F.get("families", F.lit(0)))
    return d.withColumn("status", status).withColumn("family", family).withColumn("overrides_source", one & said & ~F.array_contains("__said", F.coalesce(family, F.lit("")))).drop("__said")
