"""Grammars of numeric expressions in text: ordered full-match rules, open and closed bounds, a
status for every value, never a guess."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.text import collapse

# Literals and bound words of experience labels.
AMBIGUOUS = ("không",)
UNKNOWN = ("chưa xác định", "chưa cập nhật")
NO_REQUIREMENT = ("không yêu cầu kinh nghiệm", "không yêu cầu", "không cần")
REQUIRED = ("yêu cầu ứng viên có", "có", "yêu cầu")
LOWER = "trên|hơn|>=|>|ít nhất|tối thiểu|không dưới|từ"
UPPER = "dưới|lên đến|<=|<"
OPEN_LOWER, OPEN_UPPER = ("trên", "hơn", ">"), ("dưới", "<")
#: A stated number this large is no experience.
TOO_MUCH = 1_000_000_000
_N, _U = r"([0-9]+(?:[.,][0-9]+)?)", "(năm|tháng)"
#: number, unit if it differs, number, unit
RANGE = rf"^(?:từ )?{_N} ?{_U}? ?(?:[-–—]|đến|tới) ?{_N} ?{_U}$"
#: bound word, number, unit, direction
BOUND = rf"^({LOWER}|{UPPER})? ?{_N} ?{_U} ?(trở lên|trở xuống)?$"


def experience(column: Column) -> Column:
    """``struct(status, kind, low_months, high_months, low_open, high_open, bucket)``.

    Statuses: missing, unknown, ambiguous_literal, no_requirement, mapped, ambiguous (bound words
    that contradict each other), invalid_bounds (reversed, or a number of ``TOO_MUCH`` and more,
    whatever its length), unmapped. Kinds: range, stated_point, lower_bound, upper_bound,
    no_requirement, required_unspecified. Each end of a range may have a unit of its own. A range
    that crosses a bucket's edge has no bucket.
    """
    t = F.regexp_replace(F.lower(collapse(column)), " kinh nghiệm$", "")
    part = lambda rx, i: F.nullif(F.regexp_extract(t, rx, i), F.lit(""))
    number = lambda rx, i: F.replace(part(rx, i), F.lit(","), F.lit(".")).try_cast("decimal(18,6)")
    months = lambda n, unit: (n * F.when(unit == "năm", 12).otherwise(1)).cast("decimal(24,6)")
    huge = lambda n: F.coalesce(n >= TOO_MUCH, F.lit(True))
    ranged, bounded = t.rlike(RANGE), t.rlike(BOUND)
    a, b, p = number(RANGE, 1), number(RANGE, 3), number(BOUND, 2)
    low_r, high_r, point = months(a, F.coalesce(part(RANGE, 2), part(RANGE, 4))), months(b, part(RANGE, 4)), months(p, part(BOUND, 3))
    head, tail = part(BOUND, 1), part(BOUND, 4)
    up, down = F.coalesce(head.rlike(f"^(?:{LOWER})$"), F.lit(False)), F.coalesce(head.rlike(f"^(?:{UPPER})$"), F.lit(False))
    rises, falls = F.coalesce(tail == "trở lên", F.lit(False)), F.coalesce(tail == "trở xuống", F.lit(False))
    lower, upper = bounded & (up | rises), bounded & (down | falls)
    literal = lambda *x: t.isin(*x)
    status = (
        F.when(F.coalesce(t, F.lit("")) == "", "missing")
        .when(literal(*AMBIGUOUS), "ambiguous_literal")
        .when(literal(*UNKNOWN), "unknown")
        .when(literal(*NO_REQUIREMENT), "no_requirement")
        .when(literal(*REQUIRED), "mapped")
        .when(ranged, F.when(huge(a) | huge(b) | (low_r > high_r), "invalid_bounds").otherwise("mapped"))
        .when(lower & upper, "ambiguous")
        .when(bounded, F.when(huge(p), "invalid_bounds").otherwise("mapped"))
        .otherwise("unmapped")
    )
    said = F.when(literal(*REQUIRED), "required_unspecified").when(literal(*NO_REQUIREMENT), "no_requirement")
    kind = F.coalesce(said, F.when(ranged, "range").when(lower, "lower_bound").when(upper, "upper_bound").when(bounded, "stated_point"))
    ok = (status == "mapped") & said.isNull()
    low = F.when(ok, F.when(ranged, low_r).when(upper, F.lit(0)).otherwise(point)).cast("decimal(24,6)")
    high = F.when(ok, F.when(ranged, high_r).when(~lower, point)).cast("decimal(24,6)")
    low_open, high_open = F.when(ok & lower, head.isin(*OPEN_LOWER)), F.when(ok & upper, head.isin(*OPEN_UPPER))
    return F.struct(
        status.alias("status"),
        F.when(status.isin("mapped", "no_requirement"), kind).alias("kind"),
        low.alias("low_months"),
        high.alias("high_months"),
        F.coalesce(low_open, F.lit(False)).alias("low_open"),
        F.coalesce(high_open, F.lit(False)).alias("high_open"),
        F.coalesce(said, F.when(ok, bucket(low, high, F.coalesce(high_open, F.lit(False))))).alias("bucket"),
    )


def bucket(low: Column, high: Column, high_open: Column) -> Column:
    """lt_1, 1_lt_3, 3_lt_5, ge_5 years, or range_crossing; bounds in months."""
    inside = lambda a, b: (low >= a) & ((high < b) | (high == b) & high_open)
    return F.when(low >= 60, "ge_5").when(inside(0, 12), "lt_1").when(inside(12, 36), "1_lt_3").when(inside(36, 60), "3_lt_5").otherwise("range_crossing")


def years(months: Column) -> Column:
    """Months as years with six decimals, rounded half even once."""
    return F.bround(months.cast("decimal(38,18)") / 12, 6).cast("decimal(18,6)")


def salary_shape(column: Column) -> Column:
    """Which form a salary text has: missing, negotiable, range, bound, number or other."""
    t = F.lower(collapse(column))
    return (
        F.when(F.coalesce(t, F.lit("")) == "", "missing")
        .when(t.rlike("thỏa thuận|thoả thuận|cạnh tranh|negotiable|năng lực"), "negotiable")
        .when(~t.rlike("[0-9]"), "other")
        .when(t.rlike("[0-9][^0-9]*(-|–|~|đến)[^0-9]*[0-9]"), "range")
        .when(t.rlike("^(từ|trên|dưới|đến|tới|lên đến|upto|from|tối thiểu|tối đa|<=|>=)"), "bound")
        .otherwise("number")
    )
