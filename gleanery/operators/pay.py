"""Pay as stated in a text: bounds, currency, period, component and flags, or the reason why it
cannot be read; and its conversion to a month's pay in one currency.

Everything is a chain of Catalyst projections: guards that abstain first, then tokens are taken
out of the text one kind after another until one pattern must match all that is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import collapse

# What a text without numeric offer begins with, or is.
NEGOTIABLE = (
    "thỏa thuận|thoả thuận|thương lượng|cạnh tranh|negotiable|mức lương thỏa thuận|competitive salary|"
    "theo năng lực trao đổi trực tiếp khi phỏng vấn|theo thỏa thuận|lương thỏa thuận|thỏa thuân|tùy năng lực"
)
PRAISE = ("you'll love it", "you'll surely love it")
# Nouns before an amount, bound words, units and periods.
NOUNS = "thu nhập|lương cứng|khởi điểm|lc|cứng|cơ bản|chính thức"
LOWER = ("từ", "trên", "ít nhất", "tối thiểu")
UPPER = ("lên tới", "lên đến", "tới", "dưới", "upto", "up to", "tối đa")
PERIODS = {"tháng": "month", "month": "month", "tuần": "week", "ngày": "day", "giờ": "hour"}
FACTORS = {"month": (1, 1), "week": (52, 12), "day": (26, 1), "hour": (208, 1), "year": (1, 12)}
_NUMBER, _UNIT = r"([0-9]+(?:[.,][0-9]+)*)", "(triệu|nghìn|ngàn|tr|k|m)?"
_PERIOD = r"(?U)/\s*(?:tháng|tuần|ngày|giờ|month)\b|\bmonth\b"
_CURRENCY = r"(?U)(?<![a-z])(?:vnd|vnđ|usd)(?![a-z])|\bđồng\b|[₫$]|(?<=[0-9])đ\b"
_DONG = r"(?U)vnd|vnđ|đồng|₫|triệu|nghìn|ngàn|[0-9]\s*(?:tr|k|đ)\b"
_AMOUNTS = rf"^{_NUMBER}\s*{_UNIT}(?:\s*(-|đến|tới|dưới)\s*{_NUMBER}\s*{_UNIT})?$"
_BODY = rf"^(?:(?:{NOUNS}) )?(?:({'|'.join((*LOWER, *UPPER))}) )?(.*)$"
#: Fields of ``read_pay``.
FIELDS = ["status", "reason", "kind", "source_min", "source_max", "currency", "period", "min_inclusive", "max_inclusive", "component", "flags"]


def _number(text: Column, unit: Column) -> Column:
    """A number as typed: groups of three are thousands, up to two digits after a mark are decimals,
    anything else is null; so is what has more than 24 digits."""
    plain = F.when(text.rlike(r"^[0-9]{1,3}(?:[.,][0-9]{3})+$"), F.translate(text, ".,", "")).when(text.rlike(r"^[0-9]+(?:[.,][0-9]{1,2})?$"), F.replace(text, F.lit(","), F.lit(".")))
    scale = F.when(unit.isin("triệu", "tr", "m"), 1_000_000).when(unit.isin("nghìn", "ngàn", "k"), 1_000).otherwise(1)
    return F.try_multiply(plain.try_cast("decimal(26,2)"), scale.cast("decimal(10,0)")).try_cast("decimal(26,2)")


def read_pay(df: DataFrame, column: str, out: str = "pay") -> DataFrame:
    """``df`` with ``out``, a struct of ``FIELDS``; a column of that name is replaced.

    Statuses: mapped, missing, negotiable, zero_placeholder, needs_review with a ``reason``. Null and
    blank texts are missing. What follows a plus sign is a variable component and is not read; a
    number that has more than 24 digits is out of range and needs review. Kinds: point, range,
    lower_only, upper_only.
    """
    text = F.regexp_replace(F.lower(collapse(F.col(column))), "[–—−]", "-")
    d = df.drop(out).withColumn("__t", text).withColumn("__m", F.regexp_replace(F.split("__t", r"\+", 2)[0], "triêu", "triệu"))
    t, m = F.col("__t"), F.col("__m")
    d = d.withColumn("__tax", F.when(m.rlike(r"(?U)\bnet\b"), "net").when(m.rlike(r"(?U)\bgross\b"), "gross"))
    d = d.withColumn("__base", m.rlike("^(?:lc |lương cứng)")).withColumn("__income", m.startswith("thu nhập")).withColumn("__m", F.regexp_replace(m, r"(?U)\b(?:net|gross)\b", ""))
    d = d.withColumn("__usd", m.rlike(r"usd|\$")).withColumn("__vnd", m.rlike(_DONG))
    d = d.withColumn("__periods", F.array_distinct(F.transform(F.regexp_extract_all(m, F.lit(f"({_PERIOD})"), F.lit(0)), lambda x: F.regexp_replace(x, r"^/\s*", ""))))
    bare = collapse(F.regexp_replace(F.regexp_replace(m, _CURRENCY, ""), _PERIOD, ""))
    d = d.withColumn("__bare", bare).withColumn("__head", F.nullif(F.regexp_extract("__bare", _BODY, 1), F.lit(""))).withColumn("__body", F.regexp_extract("__bare", _BODY, 2))
    d = d.withColumn("__body", F.regexp_replace(F.regexp_replace("__body", r"-\s*dưới\s+", "dưới "), r"(?:tới|đến)\s*<\s*", "dưới "))
    d = d.withColumn("__late", F.col("__body").endswith("lương cứng")).withColumn("__body", F.regexp_replace("__body", r"\s*lương cứng$", ""))
    d = d.withColumn("__open", F.col("__body").endswith("trở lên")).withColumn("__body", F.regexp_replace("__body", r"\s*trở lên$", ""))
    part = lambda i: F.nullif(F.regexp_extract("__body", _AMOUNTS, i), F.lit(""))
    d = d.withColumns({"__fits": F.col("__body").rlike(_AMOUNTS), "__n1": part(1), "__u2": part(5), "__sep": part(3), "__n2": part(4)}).withColumn("__u1", F.coalesce(part(2), "__u2"))
    d = d.withColumn("__a", _number(F.col("__n1"), F.col("__u1"))).withColumn("__b", _number(F.col("__n2"), F.col("__u2")))
    two, a, b, head, opened = F.col("__n2").isNotNull(), F.col("__a"), F.col("__b"), F.coalesce("__head", F.lit("")), F.col("__open")
    digits = lambda n: F.col(n).rlike(r"^[0-9]{1,3}(?:[.,][0-9]{3})+$|^[0-9]+(?:[.,][0-9]{1,2})?$")
    well_typed = digits("__n1") & (~two | digits("__n2"))
    largest, least = F.greatest(a, F.coalesce(b, a)), F.least(a, F.coalesce(b, a))
    reason = (
        F.when(F.coalesce(t, F.lit("")) == "", "missing_source")
        .when(t == "đang cập nhật", "not_updated")
        .when(t.rlike(f"^(?:{NEGOTIABLE})") | t.isin(*PRAISE), "no_numeric_offer")
        .when(~t.rlike(r"\d"), "no_numeric_amount")
        .when(t.contains("hoặc"), "alternative_offers")
        .when(F.col("__usd") & F.col("__vnd"), "currency_conflict")
        .when(F.size("__periods") > 1, "multiple_periods")
        .when(~F.col("__fits"), "unsupported_expression")
        .when(~F.col("__usd") & ~F.col("__vnd"), "missing_currency_or_scale")
        .when(~well_typed, "ambiguous_number")
        .when(a.isNull() | two & b.isNull(), "unrepresentable_positive_money")
        .when(largest == 0, "all_zero")
        .when(two & (least > 0) & (head.isin(*UPPER, "trên") | opened), "contradictory_qualifier")
    )
    d = d.withColumn("__reason", reason)
    why = F.col("__reason")
    status = (
        F.when(why.isNull(), "mapped")
        .when(why.isin("missing_source", "not_updated", "no_numeric_amount"), "missing")
        .when(why == "no_numeric_offer", "negotiable")
        .when(why == "all_zero", "zero_placeholder")
        .otherwise("needs_review")
    )
    torn = why == "contradictory_qualifier"
    valued = why.isNull() | torn
    late = ~F.coalesce(why.isin("missing_source", "not_updated", "no_numeric_offer", "no_numeric_amount", "alternative_offers"), F.lit(False))
    known = late & ~F.coalesce(why.isin("currency_conflict", "multiple_periods"), F.lit(False))
    zero_end = two & (least == 0) & (largest > 0)
    upper, lower = head.isin(*UPPER), head.isin(*LOWER) | opened
    kind = F.when(torn, "range").when(~valued, "unknown").when(zero_end, "point").when(two, F.when(a == b, "point").otherwise("range")).when(upper, "upper_only").when(lower, "lower_only").otherwise("point")
    source_min = F.when(valued, F.when(zero_end, largest).when(two, least).when(~upper, a))
    source_max = F.when(valued, F.when(two, largest).when(upper | ~lower, a))
    closed = lambda side, odd: F.when(why.isNull() & side.isNotNull(), ~odd)
    flags = F.array_compact(
        F.array(
            F.when(known & t.contains("+") | (late & t.contains("+") & (why == "currency_conflict")), "variable_component"),
            F.when((known | late & (why == "currency_conflict")) & F.split("__t", r"\+", 2)[0].contains("triêu"), "observed_unit_typo"),
            F.when(known | late & (why == "currency_conflict"), F.col("__tax")),
            F.when(known & (F.size("__periods") == 0), "assumed_month"),
            F.when(why.isNull() & zero_end, "positive_bound_as_point"),
            F.when(valued & two & ~zero_end & (a > b), "positive_bounds_reordered"),
        )
    )
    found = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for k, v in PERIODS.items() for x in (k, v)]), F.get("__periods", F.lit(0))), F.lit("month"))
    fitted = known & F.col("__fits")
    component = F.when(~known, "unspecified").when(F.col("__base") | F.col("__late"), "base_salary").when(F.col("__income"), "advertised_income").otherwise("unspecified")
    values = {
        "status": status, "reason": F.coalesce("__reason", F.lit("")), "kind": kind, "source_min": source_min, "source_max": source_max,
        "currency": F.when(known, F.when(F.col("__usd"), "USD").when(F.col("__vnd"), "VND")), "period": F.when(known, found),
        "min_inclusive": closed(source_min, ~two & (head == "trên")), "max_inclusive": closed(source_max, F.when(two & ~zero_end, F.coalesce(F.col("__sep") == "dưới", F.lit(False))).otherwise(~two & (head == "dưới"))),
        "component": F.when(fitted | known, component).otherwise("unspecified"), "flags": flags,
    }
    return d.withColumn(out, F.struct(*[values[k].alias(k) for k in FIELDS])).drop(*[c for c in d.columns if c.startswith("__") and c not in df.columns])


def convert_pay(df: DataFrame, rate: str, provisional: str, pay: str = "pay", quantum: Column | None = None) -> DataFrame:
    """``df`` with ``salary_min``, ``salary_max`` (a month's pay in VND, two decimals, half up) and the
    struct ``pay`` with its final status, reason and flags.

    ``rate``: VND per USD of the row's year or null, ``provisional``: whether it is. A rate is needed
    for USD only (``fx_missing``). ``quantum``: amounts are raised to a multiple of it. What is not
    above 0 or reaches 10^16 needs review. Flags never exclude a row.
    """
    f = lambda k: F.col(f"{pay}.{k}")
    mapped, dollars = f("status") == "mapped", f("currency") == "USD"
    fx = F.when(dollars, F.col(rate).cast("decimal(28,6)")).otherwise(F.lit(1))
    pick = lambda i: F.element_at(F.create_map(*[F.lit(x) for k, v in FACTORS.items() for x in (k, v[i])]), f("period"))

    def month(side: str) -> Column:
        whole = F.try_multiply(F.try_multiply(f(side).try_cast("decimal(20,2)"), fx.try_cast("decimal(12,6)")), pick(0).cast("decimal(3,0)"))
        value = F.try_divide(whole, pick(1).cast("decimal(2,0)"))
        if quantum is not None:
            value = F.coalesce(F.ceil(F.try_divide(value, quantum)) * quantum, value)
        return F.round(value, 2)

    d = df.withColumn("__low", F.when(mapped, month("source_min"))).withColumn("__high", F.when(mapped, month("source_max")))
    low, high = F.col("__low"), F.col("__high")
    void = mapped & dollars & F.col(rate).isNull()
    odd = lambda side, x: f(side).isNotNull() & F.coalesce((x <= 0) | (x >= F.lit("1e16").cast("decimal(20,0)")), F.lit(True))
    broken = mapped & ~void & (odd("source_min", low) | odd("source_max", high))
    d = d.withColumn("__void", F.coalesce(void, F.lit(False))).withColumn("__broken", F.coalesce(broken, F.lit(False)))
    good = mapped & ~F.col("__void") & ~F.col("__broken")
    small = lambda x: F.coalesce((x < 1_000_000) | (x > 200_000_000), F.lit(False))
    more = F.array_compact(
        F.array(
            F.when(good & (f("period") != "month"), "conventional_month_conversion"),
            F.when(good & quantum.isNotNull(), "owner_ceiling_monthly_amount") if quantum is not None else F.lit(None).cast("string"),
            F.when(good & dollars & F.col(provisional), "provisional_ytd_fx"),
            F.when(good & (small(low) | small(high)), "amount_review_signal"),
            F.when(good & (high > low * 10), "wide_range_signal"),
        )
    )
    status = F.when(F.col("__void"), "fx_missing").when(F.col("__broken"), "needs_review").otherwise(f("status"))
    reason = F.when(F.col("__void"), "verified_year_rate_missing").when(F.col("__broken"), "unrepresentable_positive_money").otherwise(f("reason"))
    new = F.struct(status.alias("status"), reason.alias("reason"), *[f(k).alias(k) for k in FIELDS[2:-1]], F.concat(f("flags"), more).alias("flags"))
    side = lambda x: F.when(good, x).cast("decimal(18,2)")
    return d.withColumns({"salary_min": side(low), "salary_max": side(high), pay: new}).drop("__low", "__high", "__void", "__broken")
