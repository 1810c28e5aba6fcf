"""Column-level data quality per load: nulls, blanks, distinct values, ranges, patterns, value mix.

Column expressions are induced by minimum description length over all distinct values: every
value has a chain of ever more general shapes (itself, a mask of character classes, runs of
classes, words, an alphabet, anything), shapes form a tree, and from the leaves up each node
either describes its values itself or leaves them to its children, whichever takes fewer bits.
Rows outside the chosen expressions and rows that break the contract are counted per expression,
and the coverage of each expression is compared between loads beside the standard aggregates.

Values are hashed in the scan and shaped there from Arrow buffers, so that hashes, counts and
lengths are shuffled and never a value or a shape.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Mapping, Sequence
from functools import lru_cache, reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.session import keep, small

#: A value described only by itself conforms if it holds at least this share of the column's rows.
SUPPORT = 0.001
#: Bits of one symbol of an expression, and of one character of each class.
SYMBOL, LETTER, DIGIT, ANY = 5.0, 6.5, 3.33, 12.0
#: Rows of one task that are summed up before they leave it.
COMBINED = 200_000
#: Expressions of one level are broadcast up to this number; each is two hashes.
BROADCAST_NODES = 200_000
_BLANK = r"(?U)^\s*$"
_LEVELS = ["mask", "runs", "words", "alphabet", "any"]
_UPPER, _LOWER, _DIGIT, _SPACE, _MARK, _WORD, _WORDS, _SIGN = 1, 2, 3, 4, 5, 6, 7, 16


def blank(c: Column) -> Column:
    """A text of white space only, the empty text included."""
    return c.rlike(_BLANK)


def load_counts(df: DataFrame, load: str, columns: Sequence[str]) -> DataFrame:
    """``load, column_name, n_rows, nulls, blanks, checked, low, high``: the standard aggregates.

    One row per load and column from one pass; ``checked`` counts values that are neither null nor
    blank. An empty table gives no row; a null load is a load of its own.
    """
    kinds = dict(df.dtypes)
    aggs: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        v = F.col(f"`{c}`")
        void = blank(v) if kinds[c] == "string" else F.lit(False)
        held = v.isNotNull() & ~void
        aggs.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count_if(v.isNull()).alias("nulls"),
                F.count_if(v.isNotNull() & void).alias("blanks"),
                F.count_if(held).alias("checked"),
                F.min(F.when(held, v)).cast("string").alias("low"),
                F.max(F.when(held, v)).cast("string").alias("high"),
            ).alias(f"__{len(aggs)}")
        )
    wide = df.groupBy(F.col(load).alias("load")).agg(*aggs)
    return wide.select("load", "n_rows", F.explode(F.array(*[F.col(f"__{i + 1}") for i in range(len(columns))])).alias("c")).select("load", "n_rows", "c.*")


# --- shapes ----------------------------------------------------------------------------------


class Shapes(NamedTuple):
    """Per value: the hash of each shape, the symbols of each shape, and what its bits are made of."""

    mask: np.ndarray
    runs: np.ndarray
    words: np.ndarray
    alphabet: np.ndarray
    mask_size: np.ndarray
    runs_size: np.ndarray
    words_size: np.ndarray
    alphabet_size: np.ndarray
    letters: np.ndarray
    digits: np.ndarray
    repeats: np.ndarray
    spread: np.ndarray
    chars: np.ndarray


@lru_cache(1)
def _classes() -> np.ndarray:
    """The class of every code point; what lies beyond the assigned planes is a sign."""
    of = {"Lu": _UPPER, "Lt": _UPPER, "Ll": _LOWER, "Lo": _LOWER, "Lm": _LOWER, "Nd": _DIGIT, "Mn": _MARK, "Mc": _MARK, "Me": _MARK}
    out = np.zeros(0x323B0, np.uint8)
    for i in range(len(out)):
        c = chr(i)
        out[i] = _SPACE if c.isspace() and c not in "\x1c\x1d\x1e\x1f" else of.get(unicodedata.category(c), 0)
    return out


class Sequences(NamedTuple):
    """The symbols of all values one after another and where each value's begin."""

    symbols: np.ndarray
    starts: np.ndarray


def _cut_at(symbols: np.ndarray, row: np.ndarray, n: int) -> Sequences:
    return Sequences(symbols, np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n)))).astype(np.int64))


def sequences(values: Sequence[str]) -> tuple[Sequences, Sequences, Sequences, Sequences]:
    """Mask, runs, words and alphabet of every value as sequences of symbols.

    A mask has one symbol a character: a class (upper, lower, digit, space) or the sign itself; the
    marks of a letter belong to it. Runs join equal classes (symbol x 2, + 1 where it repeats).
    Words join letters of any case, and words with single gaps of space between them. An alphabet
    is the ordered set of classes and signs.
    """
    n = len(values)
    points = np.frombuffer("".join(values).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(n), np.fromiter(map(len, values), np.int64, n))
    table = _classes()
    kind = np.where(points < len(table), table[np.minimum(points, len(table) - 1)], 0)
    symbol = np.where((kind > 0) & (kind != _MARK), kind, points + _SIGN).astype(np.uint32)

    plain = kind != _MARK
    key = np.unique((row[plain].astype(np.uint64) << np.uint64(32)) | np.where(symbol[plain] == _UPPER, _LOWER, symbol[plain]).astype(np.uint64))
    alphabet = _cut_at((key & np.uint64(0xFFFFFFFF)).astype(np.uint32), (key >> np.uint64(32)).astype(np.int64), n)

    at = np.arange(len(points))
    base = np.maximum.accumulate(np.where(plain, at, -1)) if len(points) else at
    inside = (base >= 0) & (row[base] == row)
    own_mark = ~plain & inside & np.isin(kind[base], (_UPPER, _LOWER))
    symbol, row = symbol[~own_mark], row[~own_mark]
    mask = _cut_at(symbol, row, n)

    first = np.ones(len(symbol), bool)
    first[1:] = (symbol[1:] != symbol[:-1]) | (row[1:] != row[:-1]) | (symbol[1:] >= _SIGN)
    begin = np.flatnonzero(first)
    longer = np.diff(np.append(begin, len(symbol))) > 1
    symbol, row = symbol[begin] * 2 + longer, row[begin]
    runs = _cut_at(symbol.astype(np.uint32), row, n)

    letter = np.isin(symbol >> 1, (_UPPER, _LOWER))
    follows = np.zeros(len(symbol), bool)
    follows[1:] = letter[1:] & letter[:-1] & (row[1:] == row[:-1])
    symbol, row, letter = np.where(letter, _WORD * 2, symbol)[~follows], row[~follows], letter[~follows]
    gap = np.zeros(len(symbol), bool)
    if len(symbol) > 2:
        gap[1:-1] = (symbol[1:-1] >> 1 == _SPACE) & letter[:-2] & letter[2:] & (row[:-2] == row[1:-1]) & (row[2:] == row[1:-1])
    symbol, row, letter = symbol[~gap], row[~gap], letter[~gap]
    first = np.ones(len(symbol), bool)
    first[1:] = ~(letter[1:] & letter[:-1] & (row[1:] == row[:-1]))
    begin = np.flatnonzero(first)
    several = np.diff(np.append(begin, len(symbol))) > 1
    words = _cut_at(np.where(several, _WORDS * 2, symbol[begin]).astype(np.uint32), row[begin], n)
    return mask, runs, words, alphabet


def _hashes(s: Sequences) -> np.ndarray:
    held = memoryview(np.ascontiguousarray(s.symbols)).cast("B") if len(s.symbols) else memoryview(b"")
    ends = (s.starts * 4).tolist()
    return np.array([xxhash.xxh3_64_intdigest(held[a:b]) for a, b in zip(ends, ends[1:])], np.uint64).view(np.int64)


def shape(values: Sequence[str]) -> Shapes:
    """The shapes of distinct values; values of any length have all of them."""
    n = len(values)
    mask, runs, words, alphabet = sequences(values)
    count = lambda s, hit: np.bincount(np.repeat(np.arange(n), np.diff(s.starts))[hit], minlength=n)
    has = lambda kind: count(alphabet, alphabet.symbols == kind)
    repeats, kept = count(runs, (runs.symbols & 1) == 1), count(words, (words.symbols & 1) == 1)
    return Shapes(
        *(_hashes(s) for s in (mask, runs, words, alphabet)),
        np.diff(mask.starts), np.diff(runs.starts) + repeats, np.diff(words.starts) + kept, np.diff(alphabet.starts) + 1,
        count(mask, (mask.symbols == _UPPER) | (mask.symbols == _LOWER)), count(mask, mask.symbols == _DIGIT), repeats,
        np.maximum(np.diff(alphabet.starts) + 90 * has(_LOWER) + 10 * has(_DIGIT), 1), np.fromiter(map(len, values), np.int64, n),
    )


def expression(level: str, value: str) -> str:
    """The shape of one value at one level as a regular expression; '' for the value itself."""
    if level == "any":
        return r"(?s).+"
    if level not in _LEVELS:
        return ""
    symbols = sequences([value])[_LEVELS.index(level)].symbols.tolist()
    if level == "alphabet":
        name = {_LOWER: r"\p{L}\p{M}", _DIGIT: r"\p{Nd}", _SPACE: r"\s"}
        return "[" + "".join(name[s] if s in name else re.escape(chr(s - _SIGN)) for s in symbols) + (r"\p{M}" if _LOWER not in symbols else "") + "]+"
    name = {_UPPER: r"[\p{Lu}\p{Lt}]\p{M}*", _LOWER: r"[\p{Ll}\p{Lo}\p{Lm}]\p{M}*", _DIGIT: r"\p{Nd}", _SPACE: r"\s", _WORD: r"[\p{L}\p{M}]+", _WORDS: r"[\p{L}\p{M}\s]+"}
    if level == "mask":
        return "".join(name[s] if s in name else re.escape(chr(s - _SIGN)) for s in symbols)
    out = []
    for s in symbols:
        rx = name[s >> 1] if s >> 1 in name else re.escape(chr((s >> 1) - _SIGN))
        out.append(f"(?:{rx}){{2,}}" if s & 1 else rx)
    return "".join(out)


# --- values of all loads ---------------------------------------------------------------------


def observe(df: DataFrame, load: str, columns: Sequence[str], contract: Mapping[str, dict]) -> DataFrame:
    """The distinct values of every load and column with their shapes, kept as a written table.

    ``load, col, v, n, total, once``, the shapes of ``Shapes`` and ``breaks`` (1: the contract's
    ``value_pattern``, 2: ``min_allowed`` or ``max_allowed``). ``col`` is the place of the column in
    ``columns``, ``v`` a 64-bit hash of the value, ``n`` its rows in the load, ``total`` in all
    loads; ``once`` marks one row per value. Nulls and blanks are no values. Two values of a column
    with n distinct ones share a hash with probability n^2 / 2^65.
    """
    cells, ruled = [F.col(load).alias("load")], {}
    for i, c in enumerate(columns):
        text, rule = F.col(f"`{c}`").cast("string"), contract.get(c, {})
        held = F.when(~blank(text), text)
        cells += [held.alias(f"v{i}"), F.xxhash64(held).alias(f"h{i}")]
        number, out = F.col(f"`{c}`").try_cast("decimal(38,6)"), F.lit(False)
        for bound, breaks in (("min_allowed", Column.__lt__), ("max_allowed", Column.__gt__)):
            if rule.get(bound) is not None:
                out = out | F.coalesce(breaks(number, F.lit(rule[bound])), F.lit(False))
        broken = ~held.rlike(rule["value_pattern"]) if rule.get("value_pattern") else F.lit(False)
        if set(rule) & {"value_pattern", "min_allowed", "max_allowed"}:
            ruled[i] = len(cells)
            cells.append((F.when(broken, 1).otherwise(0) + F.when(out, 2).otherwise(0)).alias(f"b{i}"))
    wide = df.select(*cells)
    kind = wide.schema["load"].dataType.simpleString()
    places = [wide.columns.index(f"v{i}") for i in range(len(columns))]
    keys = ["load", "col", "v", *Shapes._fields, "breaks"]

    def seen(batch: pa.RecordBatch) -> Iterator[pa.Table]:
        loads = batch.column(0).dictionary_encode()
        code = np.asarray(loads.indices.fill_null(len(loads.dictionary)))
        names = pa.concat_arrays([loads.dictionary, pa.nulls(1, loads.dictionary.type)])
        for i, p in enumerate(places):
            held = np.flatnonzero(np.asarray(batch.column(p).is_valid()))
            if not len(held):
                continue
            v, first, back = np.unique(np.asarray(batch.column(p + 1))[held], return_index=True, return_inverse=True)
            pair, n = np.unique(back.astype(np.int64) * len(names) + code[held], return_counts=True)
            which = pair // len(names)
            s = shape(batch.column(p).take(pa.array(held[first])).to_pylist())
            breaks = np.asarray(batch.column(ruled[i]))[held[first]] if i in ruled else np.zeros(len(v), np.int64)
            yield pa.table(
                [names.take(pa.array(pair % len(names))), pa.array(np.full(len(pair), i, np.int16)), pa.array(v[which]), *(pa.array(x[which].astype(np.int64)) for x in s), pa.array(breaks[which].astype(np.int8)), pa.array(n)],
                names=[*keys, "n"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        for batch in batches:
            waiting += seen(batch)
            if sum(map(len, waiting)) > COMBINED:
                yield from _summed(waiting, keys)
                waiting = []
        if waiting:
            yield from _summed(waiting, keys)

    schema = f"load {kind}, col smallint, v long, {', '.join(f'{f} long' for f in Shapes._fields)}, breaks tinyint, n long"
    # Partitioned by value only: its loads, its total and its first row are then found without moving it again.
    met = wide.mapInArrow(run, schema).repartition("col", "v").groupBy(*keys).agg(F.sum("n").alias("n"))
    value = Window.partitionBy("col", "v")
    return keep(met.withColumn("total", F.sum("n").over(value)).withColumn("once", F.row_number().over(value.orderBy("load")) == 1))


def _summed(tables: list[pa.Table], keys: list[str]) -> Iterator[pa.RecordBatch]:
    whole = pa.concat_tables(tables).group_by(keys).aggregate([("n", "sum")])
    yield from whole.rename_columns([*keys, "n"]).to_batches(max_chunksize=10_000)


def mix_distance(seen: DataFrame) -> DataFrame:
    """``load, col, distance``: half the sum of absolute differences between the value shares of a
    load and of all other loads together; null where there is no other load."""
    loads = seen.groupBy("load", "col").agg(F.sum("n").alias("own"))
    whole = loads.groupBy("col").agg(F.sum("own").alias("whole"))
    sizes = loads.join(whole, "col").withColumnRenamed("load", "__load")
    rows = seen.select("load", "col", "n", "total").join(small(sizes), (F.col("load").eqNullSafe(F.col("__load"))) & (seen["col"] == sizes["col"])).drop(sizes["col"])
    rest = F.try_divide(F.col("total") - F.col("n"), F.col("whole") - F.col("own"))
    share = F.col("n") / F.col("own")
    return rows.groupBy("load", "col").agg(((F.sum(F.abs(share - rest)) + 1 - F.sum(rest)) / 2).alias("distance"))


# --- expressions -----------------------------------------------------------------------------


def induce(seen: DataFrame) -> DataFrame:
    """``col, mask, level, node, example``: the expression chosen for each mask by least description length.

    A value counts once, however many loads and rows hold it. ``level`` 'value' says that the values
    are cheapest written out; ``node`` is the hash of the chosen shape, ``example`` the least value
    hash below it.
    """
    chain = _LEVELS[:4]
    sizes = [f"{k}_size" for k in chain]
    size = 2 * F.length(F.bin(F.col("chars") + 1)) - 1
    sums = {"values": F.count(F.lit(1)), "letters": F.sum("letters"), "digits": F.sum("digits"), "repeats": F.sum("repeats"), "chars": F.sum("chars"), "lengths": F.sum(size), "example": F.min("v")}
    leaves = keep(seen.where("once").groupBy("col", *chain, *sizes, "spread").agg(*[x.alias(k) for k, x in sums.items()]))
    text = LETTER * F.col("letters") + DIGIT * F.col("digits")
    own = {
        "mask": SYMBOL * F.col("mask_size") + text,
        "runs": SYMBOL * F.col("runs_size") + text + 3.0 * F.col("repeats"),
        "words": SYMBOL * F.col("words_size") + text + 0.8 * F.col("chars") + F.col("lengths"),
        "alphabet": SYMBOL * F.col("alphabet_size") + F.col("chars") * F.log2("spread") + F.col("lengths"),
        "any": SYMBOL + ANY * F.col("chars") + F.col("lengths"),
    }
    node = leaves.withColumn("any", F.lit(0).cast("long")).withColumn("below", SYMBOL * F.col("values") + 8.0 * F.col("chars"))
    chosen = leaves.select("col", *chain)
    marks = []
    for i, k in enumerate(_LEVELS):
        if i:
            above = [c for x in _LEVELS[i:] for c in (x, *([f"{x}_size"] if x in chain else []))]
            again = ["letters", "digits", "repeats", "chars", "lengths"]
            spread = ["spread"] if i < 4 else []
            node = node.groupBy("col", *above, *spread).agg(F.sum("best").alias("below"), F.min("example").alias("example"), *[F.sum(x).alias(x) for x in again])
        node = node.withColumn("taken", own[k] <= F.col("below")).withColumn("best", F.least("below", own[k]))
        if i:
            node = keep(node)  # a table of each level, or every level would begin at the leaves again
        marks.append(node.where("taken").select("col", F.col(k), F.col("example").alias(f"{k}_example")))
    chosen = chosen.withColumn("any", F.lit(0).cast("long"))
    for k, m in zip(_LEVELS, marks):  # the most general shape taken describes all below it
        chosen = chosen.join(small(m, BROADCAST_NODES), ["col", k], "left")
    level = reduce(lambda acc, k: F.when(F.col(f"{k}_example").isNotNull(), k).otherwise(acc), _LEVELS, F.lit("value"))
    of = lambda f, nothing: reduce(lambda acc, k: F.when(F.col(f"{k}_example").isNotNull(), F.col(f(k))).otherwise(acc), _LEVELS, nothing)
    none = F.lit(None).cast("long")
    return chosen.select("col", "mask", level.alias("level"), of(lambda k: k, none).alias("node"), of(lambda k: f"{k}_example", none).alias("example"))


def coverage(seen: DataFrame) -> DataFrame:
    """``load, col, level, node, example, rows, values, pattern_breaks, range_breaks, rare``: what each
    induced expression describes in each load, kept as a written table.

    ``rare`` counts the rows of values that hold less than ``SUPPORT`` of their column's rows.
    """
    whole = seen.groupBy("col").agg(F.sum("n").alias("whole"))
    rows = seen.select("load", "col", "mask", "n", "total", "breaks").join(small(whole), "col")
    count = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    bit = lambda b: F.col("breaks").bitwiseAND(F.lit(b)) > 0
    sums = {"rows": F.sum("n"), "values": F.count(F.lit(1)), "pattern_breaks": count(bit(1)), "range_breaks": count(bit(2)), "rare": count(F.col("total") < SUPPORT * F.col("whole"))}
    per = rows.groupBy("load", "col", "mask").agg(*[x.alias(k) for k, x in sums.items()])
    met = per.join(induce(seen), ["col", "mask"])
    return keep(met.groupBy("load", "col", "level", "node", "example").agg(*[F.sum(k).alias(k) for k in sums]))


def _beside(covered: DataFrame) -> DataFrame:
    """``covered`` with ``share`` in its load and ``other_share`` in all other loads together."""
    loads = covered.groupBy("load", "col").agg(F.sum("rows").alias("own"))
    sizes = loads.join(loads.groupBy("col").agg(F.sum("own").alias("whole")), "col").withColumnRenamed("load", "__load").withColumnRenamed("col", "__col")
    per = covered.groupBy("col", "level", F.coalesce("node", F.lit(0)).alias("__node")).agg(F.sum("rows").alias("everywhere"))
    joined = covered.withColumn("__node", F.coalesce("node", F.lit(0))).join(per, ["col", "level", "__node"])
    joined = joined.join(small(sizes), F.col("load").eqNullSafe(F.col("__load")) & (F.col("col") == F.col("__col")))
    rest = F.try_divide(F.col("everywhere") - F.col("rows"), F.col("whole") - F.col("own"))
    return joined.withColumn("share", F.col("rows") / F.col("own")).withColumn("other_share", rest)


def expression_coverage(df: DataFrame, load: str, columns: Sequence[str]) -> DataFrame:
    """``load, column_name, level, expression, rows, share, other_share``: the induced expressions with
    the share of each load's checked values they describe, beside that of all other loads.

    Values that are cheapest written out stand as expression '' of level 'value'. Expressions are
    written from one value each, looked up by its hash: no other value leaves the scan.
    """
    covered = coverage(observe(df, load, columns, {}))
    asked = covered.where("example is not null").select("col", "example").distinct()
    cells = [F.struct(F.lit(i).cast("smallint").alias("col"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(columns)]
    texts = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*").withColumn("example", F.xxhash64("value")).where("value is not null")
    texts = texts.join(small(asked, BROADCAST_NODES), ["col", "example"], "left_semi").groupBy("col", "example").agg(F.min("value").alias("value"))
    write = F.pandas_udf(lambda level, value: pd.Series([expression(l, v) if v is not None else "" for l, v in zip(level, value)]), "string")
    # Written once for each expression, whatever the number of its loads.
    levels = covered.where("example is not null").select("col", "level", "example").distinct()
    written = levels.join(texts, ["col", "example"]).select("col", "level", "example", write("level", "value").alias("expression"))
    found = _beside(covered).join(written, ["col", "level", "example"], "left")
    return found.select("load", _name(columns), "level", F.coalesce("expression", F.lit("")).alias("expression"), "rows", "share", "other_share")


def _name(columns: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("col") + 1).alias("column_name")


def profile(df: DataFrame, load: str, columns: Sequence[str], contract: Mapping[str, dict]) -> DataFrame:
    """One row per load and column: ``load_counts`` with ``distinct_values``, ``pattern_breaks``,
    ``range_breaks``, ``nonconforming``, ``coverage_shift`` and ``distance``.

    Breaks of the contract and nonconforming rows (of values that no expression describes and that
    hold less than ``SUPPORT`` of their column) are summed over the induced expressions;
    ``coverage_shift`` is half the sum of absolute differences between the shares the expressions
    have in the load and in all others, ``distance`` the same of the values themselves.
    """
    seen = observe(df, load, columns, contract)
    beside = _beside(coverage(seen))
    odd = F.when(F.col("level") == "value", F.col("rare")).otherwise(0)
    per = beside.groupBy("load", "col").agg(
        F.sum("values").alias("distinct_values"), F.sum("pattern_breaks").alias("pattern_breaks"), F.sum("range_breaks").alias("range_breaks"), F.sum(odd).alias("nonconforming"),
        ((F.sum(F.abs(F.col("share") - F.col("other_share"))) + 1 - F.sum("other_share")) / 2).alias("coverage_shift"),
    )
    extra = per.withColumnRenamed("load", "__load").select("*", _name(columns).alias("__column")).drop("col")
    mixed = mix_distance(seen).select(F.col("load").alias("__mload"), _name(columns).alias("__mcolumn"), "distance")
    base = load_counts(df, load, columns)
    out = base.join(extra, F.col("load").eqNullSafe(F.col("__load")) & (F.col("column_name") == F.col("__column")), "left")
    out = out.join(mixed, F.col("load").eqNullSafe(F.col("__mload")) & (F.col("column_name") == F.col("__mcolumn")), "left")
    counted = ["distinct_values", "pattern_breaks", "range_breaks", "nonconforming"]
    return out.select(*base.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in counted], "coverage_shift", "distance")


def departures(profiled: DataFrame, mixed: Sequence[str], margin: float = 0.21, mix_margin: float = 0.41) -> DataFrame:
    """``load, column_name, change_kind``: where a load departs from the others.

    ``nulls``, ``blanks`` (shares of the load's rows), ``pattern``, ``range`` (shares of its checked
    values) exceed the median over all loads by more than ``margin``; ``mix`` (of the columns in
    ``mixed``) exceeds ``mix_margin``. A load without checked values has a share of 0.
    """
    share = lambda top, of: F.coalesce(F.try_divide(F.col(top), F.col(of)), F.lit(0.0))
    kinds = {"nulls": ("nulls", "n_rows"), "blanks": ("blanks", "n_rows"), "pattern": ("pattern_breaks", "checked"), "range": ("range_breaks", "checked")}
    profiled = keep(profiled)  # a row per load and column
    long = profiled.select("load", "column_name", F.explode(F.array(*[F.struct(F.lit(k).alias("change_kind"), share(*x).alias("share")) for k, x in kinds.items()])).alias("s")).select("load", "column_name", "s.*")
    medians = long.groupBy("column_name", "change_kind").agg(F.median("share").alias("usual"))
    found = long.join(small(medians), ["column_name", "change_kind"]).where(F.col("share") - F.col("usual") > margin)
    moved = profiled.where(F.col("column_name").isin(*mixed) & (F.col("distance") > mix_margin)).withColumn("change_kind", F.lit("mix"))
    return found.select("load", "column_name", "change_kind").unionByName(moved.select("load", "column_name", "change_kind"))


def contract_of(rows: DataFrame, columns: Sequence[str]) -> dict[str, dict]:
    """The rules of ``columns`` from a contract table, at most a row per column."""
    rules = rows.where(F.col("column_name").isin(*columns)).dropDuplicates(["column_name"])
    return {r["column_name"]: r.asDict() for r in rules.collect()}
