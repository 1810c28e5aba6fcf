"""Quantities recorded in different units, scales and periods, converted to one unit.

A multi-pattern automaton finds unit aliases in the text and in its unit columns; the longest
match wins, the nearest number takes it, and the columns decide where the text says nothing. The
parsed amounts then meet their conversion factors in joins with the small factor tables, in exact
integer arithmetic, rounded half up once at the end.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.session import small

# Aliases of units. "scale" words multiply, "money" words name a currency,
# "period" words name what the amount is paid for.
SCALES = {
    1_000: "k nghìn nghin ngàn ngan thousand",
    1_000_000: "triệu trieu triêu tr m mil mio million",
    1_000_000_000: "tỷ tỉ ty billion",
}
MONEY = {
    "VND": "vnd vnđ đồng dong đ ₫ d vn",
    "USD": "usd us$ $ đô dollar dollars đô la đô la mỹ do la do la my đôla dola do usd$ u.s.d",
}
PERIODS = {
    "hour": "giờ gio hour hours h hr hrs hourly tiếng tieng",
    "day": "ngày ngay day days công cong ngày công ngay cong daily",
    "week": "tuần tuan week weeks weekly wk",
    "month": "tháng thang month months monthly mth m mo th",
    "year": "năm nam year years annum p.a. p.a pa per annum yearly annual y yr",
}
# Words that say which bound a single amount is.
LOWER = re.compile(r"(?:^|\W)(?:từ|tu|from|trên|tren|hơn|hon|tối thiểu|toi thieu|ít nhất|it nhat|min|minimum|at least|over|above|>=|≥|>|không dưới)(?:\W|$|(?=\d))")
UPPER = re.compile(r"(?:^|\W)(?:đến|den|tới|toi|dưới|duoi|lên đến|len den|lên tới|len toi|tối đa|toi da|up ?to|upto|max|maximum|under|below|<=|≤|<|không quá|to)(?:\W|$|(?=\d))")
_LOWER_AFTER = re.compile(r"^\W*(?:trở lên|tro len|\+|and above|and up|or more)")
_UPPER_AFTER = re.compile(r"^\W*(?:trở xuống|tro xuong|or less)")
_AMOUNT = re.compile(r"(?<![\w.,])\d{1,3}(?:[   ]\d{3})+(?!\d)|\d+(?:[.,]\d+)*")
_JOIN = re.compile(r"^\s*(?:[-–—~]|đến|den|tới|toi|to)\s*$")


class Reading(NamedTuple):
    """What one record states: bounds in ten-thousandths of the stated unit, currency and period."""

    low: int | None
    high: int | None
    low_money: str | None
    high_money: str | None
    period: str | None


_NONE = Reading(None, None, None, None, None)
_TOO_LARGE = 10**38


@lru_cache(1)
def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    found: dict[str, dict[str, object]] = {}
    for kind, table in (("scale", SCALES), ("money", MONEY), ("period", PERIODS)):
        for value, aliases in table.items():
            for alias in _aliases(aliases):
                found.setdefault(alias, {})[kind] = value
    for alias, meanings in found.items():
        a.add_word(alias, (alias, meanings))
    a.make_automaton()
    return a


def _aliases(text: str) -> set[str]:
    """The words of a list and those of its phrases that stand there in one."""
    phrases = {"đô la", "đô la mỹ", "do la", "do la my", "ngày công", "ngay cong", "per annum"}
    return {*text.split(), *(p for p in phrases if p in text)} - {"la", "mỹ", "my", "per"}


def _units(text: str) -> list[tuple[int, int, dict[str, object]]]:
    """Longest non-overlapping unit aliases with word boundaries: (start, end, meanings)."""
    hits = []
    for end, (alias, meanings) in _automaton().iter(text):
        start = end + 1 - len(alias)
        before, after = text[start - 1 : start], text[end + 1 : end + 2]
        if alias[0].isalpha() and before.isalpha() or alias[-1].isalpha() and after.isalpha():
            continue
        hits.append((start, end + 1, meanings))
    hits.sort(key=lambda h: (h[0] - h[1], h[0]))
    out: list = []
    for h in hits:
        if all(h[1] <= o[0] or h[0] >= o[1] for o in out):
            out.append(h)
    return sorted(out)


def number(text: str) -> int | None:
    """A number as typed, in ten-thousandths: groups of three are thousands, other marks decimal."""
    t = re.sub(r"\s", "", text)
    if re.fullmatch(r"\d{1,3}(?:[.,]\d{3})+", t):
        t = re.sub(r"[.,]", "", t)
    elif re.fullmatch(r"\d{1,3}(?:,\d{3})+\.\d{1,4}", t):
        t = t.replace(",", "")
    elif re.fullmatch(r"\d{1,3}(?:\.\d{3})+,\d{1,4}", t):
        t = t.replace(".", "").replace(",", ".")
    elif re.fullmatch(r"\d+[.,]\d{1,4}", t):
        t = t.replace(",", ".")
    elif not t.isdigit():
        return None
    whole, _, part = t.partition(".")
    return int(whole) * 10_000 + int(part.ljust(4, "0") or 0)


@lru_cache(1 << 16)
def read_column_units(currency: str | None, period: str | None) -> tuple[int | None, str | None, str | None]:
    """(scale, currency, period) as the unit columns state them."""
    scale, money = 1, None
    if currency and currency.strip():
        t = unicodedata.normalize("NFC", currency).lower()
        if m := re.search(r"\d{1,18}", t):
            scale = int(m[0])
        for _, _, meanings in _units(t):
            if "money" in meanings:
                money = meanings["money"]
            elif "scale" in meanings:
                scale = int(meanings["scale"])
    if money is None and scale > 1:
        money = "VND"
    when = None
    if period and period.strip():
        when = next((m["period"] for _, _, m in _units(unicodedata.normalize("NFC", period).strip().lower()) if "period" in m), None)
    return scale, money, when


def read_amounts(text: str | None, currency: str | None = None, period: str | None = None) -> Reading:
    """The bounds a record states; a single amount is both, "from" and "up to" give one.

    Null, blank and numberless texts, three or more amounts, both currencies at once and amounts
    without any unit in text or columns give no bounds.
    """
    if not text or not text.strip():
        return _NONE
    t = unicodedata.normalize("NFC", text).lower()
    spans = [(m.start(), m.end(), n) for m in _AMOUNT.finditer(t) if (n := number(m[0])) is not None]
    if not 1 <= len(spans) <= 2:
        return _NONE
    column_scale, column_money, column_period = read_column_units(currency, period)
    units = [u for u in _units(t) if all(u[1] <= s or u[0] >= e for s, e, _ in spans)]
    own: list[dict[str, object]] = [{}, {}]
    when = None
    for start, end, meanings in units:
        before = [k for k, s in enumerate(spans) if s[1] <= start]
        k = before[-1] if before else 0
        gap = t[spans[k][1] : start] if before else t[end : spans[0][0]]
        near = not re.search(r"[a-zà-ỹđ]", _without_units(gap, t, spans, k, units, start, before)) and "/" not in gap
        if "scale" in meanings and before and near and "scale" not in own[k]:
            own[k]["scale"] = meanings["scale"]
        elif "money" in meanings and near and "money" not in own[k] and (before or not gap.strip()):
            own[k]["money"] = meanings["money"]
        elif "period" in meanings:
            when = when or meanings["period"]
    n = len(spans)
    if n == 2 and not _JOIN.match(_between(t, spans, units)):
        return _NONE
    if n == 2:  # a unit after the second amount holds for the first as well
        own[0] = own[0] or own[1]
        if own[1].get("money") and own[1].get("scale"):
            own[0].setdefault("money", own[1]["money"])
        if "money" in own[0] and "money" not in own[1] and own[1].get("scale") is None:
            own[1] = own[0]
    out = []
    for k in range(n):
        scale, money = own[k].get("scale"), own[k].get("money")
        if scale and not money:
            money = column_money or "VND"
        elif money and not scale:
            scale = 1
        elif not scale and not money:
            scale, money = column_scale, column_money
        out.append((spans[k][2] * int(scale or 1), money))
    if any(m is None for _, m in out) or len({m for _, m in out}) > 1:
        return _NONE
    when = when or column_period or "month"
    if n == 2:
        (a, m), (b, _) = sorted(out)
        return Reading(a, b, m, m, str(when))
    (a, m), head, tail = out[0], t[: spans[0][0]], t[spans[0][1] :]
    tail = tail[max([u[1] - spans[0][1] for u in units if u[0] >= spans[0][1]], default=0) :]
    if UPPER.search(head) and not LOWER.search(head) or _UPPER_AFTER.match(tail):
        return Reading(None, a, None, m, str(when))
    if LOWER.search(head) or _LOWER_AFTER.match(tail):
        return Reading(a, None, m, None, str(when))
    return Reading(a, a, m, m, str(when))


def _between(t: str, spans: list, units: list) -> str:
    """The text between two amounts without the units in it."""
    start, end = spans[0][1], spans[1][0]
    chars = list(t[start:end])
    for a, b, m in units:
        if a >= start and b <= end and ("scale" in m or "money" in m or "period" in m):
            chars[a - start : b - start] = " " * (b - a)
    return re.sub(r"[/.]", " ", "".join(chars))


def _without_units(gap: str, t: str, spans: list, k: int, units: list, start: int, before: list) -> str:
    """A gap between an amount and a unit, without other units of scale and money in it."""
    if not before:
        return gap
    chars = list(gap)
    for a, b, m in units:
        if a >= spans[k][1] and b <= start and ("scale" in m or "money" in m):
            chars[a - spans[k][1] : b - spans[k][1]] = " " * (b - a)
    return "".join(chars)


def parse_quantities(df: DataFrame, text: str, currency: str | None, period: str | None) -> DataFrame:
    """``df`` with ``low_e4, high_e4`` (decimal, ten-thousandths of the unit), ``money``, ``pay_period``, ``reading``.

    ``reading``: ``missing`` (null or blank), ``read``, ``unreadable``, or ``out_of_range`` for amounts
    of more than 34 digits; the other columns are null unless it is ``read``. Columns of those names
    are replaced, others pass.
    """
    new = ["low_e4", "high_e4", "money", "pay_period", "reading"]
    base = df.drop(*new)
    names = base.columns
    spot = [names.index(c) if c else None for c in (text, currency, period)]
    shape = base.select("*", *[F.lit(None).cast(k).alias(c) for c, k in zip(new, ("decimal(38,0)", "decimal(38,0)", "string", "string", "string"))]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = lru_cache(1 << 16)(read_amounts)
        for batch in batches:
            columns = [batch.column(i).cast(pa.string()).to_pylist() if i is not None else [None] * batch.num_rows for i in spot]
            got = [read(*x) for x in zip(*columns)]
            huge = [max(g[0] or 0, g[1] or 0) >= _TOO_LARGE for g in got]
            state = ["out_of_range" if h else "read" if g[4] else "unreadable" if t and t.strip() else "missing" for g, h, t in zip(got, huge, columns[0])]
            got = [_NONE if h else g for g, h in zip(got, huge)]
            bounds = [pa.array([g[k] for g in got], pa.decimal128(38, 0)) for k in (0, 1)]
            words = [pa.array([g[2] or g[3] for g in got], pa.string()), pa.array([g[4] for g in got], pa.string()), pa.array(state, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *bounds, *words], names=[*names, *new])

    return base.mapInArrow(run, shape)


def with_factors(parsed: DataFrame, rates: DataFrame, periods: DataFrame, year: str = "year", base: str = "VND") -> DataFrame:
    """``parsed`` with ``rate_e6`` (base units per unit) and ``month_num, month_den``; unknown factors are null.

    rates(year, vnd_per_usd) and periods(pay_period, month_num, month_den) are broadcast if a
    count shows them small, else joined by shuffle. Of repeated entries the largest counts.
    """
    r = rates.groupBy(F.col("year").try_cast("int").alias("__year")).agg(F.try_multiply(F.max("vnd_per_usd"), F.lit(1_000_000)).try_cast("decimal(20,0)").alias("__rate"))
    p = periods.groupBy("pay_period").agg(F.max_by("month_num", "month_num").alias("month_num"), F.max_by("month_den", "month_num").alias("month_den"))
    joined = parsed.join(small(r), F.col(year).try_cast("int") == F.col("__year"), "left").join(small(p), "pay_period", "left")
    rate = F.when(F.col("money") == base, F.lit(1_000_000).cast("decimal(20,0)")).when(F.col("money") == "USD", F.col("__rate"))
    return joined.withColumn("rate_e6", rate).drop("__year", "__rate")


def per_month(amount_e4: Column, rate_e6: Column, num: Column, den: Column) -> Column:
    """Base units per month as BIGINT, rounded half up once: amount x rate x num / den.

    Null where a factor is null or the result does not fit BIGINT; the division is exact, as what
    does not divide evenly is taken off first.
    """
    whole = lambda c, digits: c.try_cast(f"decimal({digits},0)")
    top = F.try_multiply(F.try_multiply(whole(amount_e4, 38), whole(rate_e6, 20)), 2 * whole(num, 9))
    bottom = 2 * whole(den, 9) * F.lit(10_000_000_000).cast("decimal(11,0)")
    raised = F.try_add(top, bottom / F.lit(2)).try_cast("decimal(38,0)")
    return F.try_divide(raised - F.try_mod(raised, bottom), bottom).try_cast("bigint")
