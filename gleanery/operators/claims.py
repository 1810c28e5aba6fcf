"""Claims about degree and experience in free text: where they stand, in which context, and what
all claims of a text come to."""

from __future__ import annotations

import re
from collections.abc import Iterator
from decimal import Decimal
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.operators.matching import POSITIVE, Matcher, Read, clauses, context_of, logic_of

# Words of degrees; numeric, negative and bare phrases of experience; bound words.
DEGREES = [("bachelor", "đại học"), ("bachelor", "cử nhân"), ("bachelor", "bachelor"), ("college", "cao đẳng"), ("vocational", "trung cấp"), ("secondary", "trung học"), ("postgraduate", "sau đại học"), ("postgraduate", "thạc sĩ"), ("certificate", "chứng chỉ")]
_NUMBER = r"(\d{1,3}(?:[.,]\d{1,2})?)"
NUMERIC = re.compile(rf"(?:(ít nhất|tối thiểu|trên|hơn|từ|dưới|at least|over)\s+)?{_NUMBER}(?:\s*(?:-|–|đến|tới|to)\s*{_NUMBER})?\s*\+?\s*(năm|tháng|years?|months?)(\s+trở lên)?(?=[^.;\n]{{0,40}}(?:kinh nghiệm|experience))|(?:kinh nghiệm|experience)[^.;\n]{{0,30}}?(?:(ít nhất|tối thiểu|trên|hơn|từ|dưới)\s+)?{_NUMBER}(?:\s*(?:-|–|đến|tới)\s*{_NUMBER})?\s*(năm|tháng)(\s+trở lên)?", re.I)
NO_NEED = re.compile(r"(?:không\s+(?:yêu cầu|cần)|chưa cần)\s+(?:có\s+)?kinh nghiệm|no experience (?:required|needed)", re.I)
SOME = re.compile(r"có\s+(?:\w+\s+){0,3}kinh nghiệm|experienced? in", re.I)
LOWER, UPPER = ("ít nhất", "tối thiểu", "trên", "hơn", "từ", "at least", "over"), ("dưới",)
CLAIM = "struct<attribute:string,value:string,low_months:decimal(18,6),high_months:decimal(18,6),start:int,end:int,text:string,clause_start:int,clause_end:int,context:string,status:string>"
_DEGREES = Matcher(DEGREES, {"postgraduate": ("bachelor",)})


def _numeric(m: re.Match) -> tuple[str, Decimal | None, Decimal | None]:
    """(kind, low, high) in months."""
    bound, a, b, unit, open_ = m.groups()[:5] if m[2] else m.groups()[5:]
    scale = 1 if unit.lower().startswith(("th", "mo")) else 12
    low, high = (Decimal(x.replace(",", ".")) * scale if x else None for x in (a, b))
    bound = (bound or "").lower()
    if high is not None:
        return "range", min(low, high), max(low, high)
    if bound in UPPER:
        return "upper_bound", Decimal(0), low
    return ("lower_bound", low, None) if bound in LOWER or open_ else ("stated_point", low, low)


def claims_of(text: str | None) -> list[dict]:
    """The claims of a text in order; null and blank texts have none.

    A claim is ``accepted`` (required or preferred), ``mention`` or ``needs_review``: its own context is
    ambiguous, or that of another claim of the same attribute is.
    """
    if not text or not text.strip():
        return []
    found = [(a, b, "education", code, None, None) for a, b, code in _DEGREES.spans(text)]
    free = [(m.span(), "no_requirement", None, None) for m in NO_NEED.finditer(text)]
    free += [(m.span(), *_numeric(m)) for m in NUMERIC.finditer(text)]
    taken = [s for s, *_ in free]
    free += [(m.span(), "required_unspecified", None, None) for m in SOME.finditer(text) if not any(x < m.end() and m.start() < y for x, y in taken) and not NUMERIC.search(text, m.start(), min(len(text), m.end() + 80))]
    found = sorted([*found, *((a, b, "experience", kind, low, high) for (a, b), kind, low, high in free)])
    read, parts = Read(text), clauses(text, [f[0] for f in found])
    out, at = [], 0
    for a, b, attribute, value, low, high in found:
        while parts[at][1] <= a:
            at += 1
        left, right, section = parts[at]
        context = "required" if value == "no_requirement" else context_of(read, left, a, right, section, ("study",))[0]
        out.append(
            {"attribute": attribute, "value": value, "low_months": low, "high_months": high, "start": a, "end": b, "text": text[a:b], "clause_start": left, "clause_end": min(right, len(text)), "context": context, "logic": logic_of(read, left, right)}
        )
    torn = {c["attribute"] for c in out if c["context"] == "ambiguous"}
    for c in out:
        c["status"] = "needs_review" if c["attribute"] in torn else "accepted" if c["context"] in POSITIVE else "mention"
    return out


def summary_of(claims: list[dict], attribute: str) -> tuple[str, list[str]]:
    """(status, values): not_mentioned, mentions_only, single, alternatives (one clause joins them by
    'or'), complex (several that do not belong together) or ambiguous."""
    own = [c for c in claims if c["attribute"] == attribute]
    wanted = [c for c in own if c["status"] == "accepted" and c["context"] == "required"]
    values = sorted({c["value"] for c in wanted})
    bounds = {(c["value"], c["low_months"], c["high_months"]) for c in wanted}
    if not own:
        return "not_mentioned", []
    if any(c["status"] == "needs_review" for c in own):
        return "ambiguous", []
    if not wanted:
        return "mentions_only", []
    if len(bounds) == 1:
        return "single", values
    one_clause = len({c["clause_start"] for c in wanted}) == 1 and wanted[0]["logic"] in ("any_of", "listed")
    return ("alternatives" if one_clause else "complex"), values


def read_claims(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, claims, education_status, education, experience_status, experience`` of every text.

    ``claims`` are exact slices of the text with their places. Repeated rows come out alike, null and
    blank texts have no claims and are ``not_mentioned``; other columns are ignored.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = lru_cache(4096)(claims_of)
        months = pa.decimal128(18, 6)
        number = {"low_months": months, "high_months": months, **dict.fromkeys(("start", "end", "clause_start", "clause_end"), pa.int32())}
        names = ("attribute", "value", "low_months", "high_months", "start", "end", "text", "clause_start", "clause_end", "context", "status")
        struct = pa.struct([pa.field(n, number.get(n, pa.string())) for n in names])
        for batch in batches:
            got = [find(t) for t in batch.column(1).to_pylist()]
            sums = [[summary_of(c, a) for c in got] for a in ("education", "experience")]
            listed = pa.array([[{n: c[n] for n in names} for c in g] for g in got], pa.list_(struct))
            told = [x for s in sums for x in (pa.array([y[0] for y in s], pa.string()), pa.array([y[1] for y in s], pa.list_(pa.string())))]
            yield pa.RecordBatch.from_arrays([batch.column(0), listed, *told], names=[key, "claims", "education_status", "education", "experience_status", "experience"])

    schema = f"`{key}` {kind}, claims array<{CLAIM}>, education_status string, education array<string>, experience_status string, experience array<string>"
    return df.select(key, df[text].cast("string")).mapInArrow(run, schema)


def claim_records(read: DataFrame, key: str, text_of: DataFrame, text: str) -> DataFrame:
    """One row per claim: ``key, ordinal`` (from 1), its fields, the SHA-256 of the text, and ``exact``:
    whether the claim is the slice of the text that its offsets name."""
    rows = read.select(key, F.posexplode("claims").alias("ordinal", "c")).select(key, (F.col("ordinal") + 1).alias("ordinal"), "c.*")
    joined = rows.join(text_of.select(F.col(key).alias("__k"), F.col(text).alias("__t")), F.col(key) == F.col("__k"))
    slice_ = F.substring("__t", F.col("start") + 1, F.col("end") - F.col("start"))
    return joined.select(*rows.columns, F.sha2("__t", 256).alias("text_hash"), (slice_ == F.col("text")).alias("exact"))


def comparison(label: Column, status: Column, values: Column) -> Column:
    """How a labelled category relates to what the text claims: source_unavailable, text_unavailable,
    unresolved, insufficient_evidence, consistent, compatible_detail or potential_conflict."""
    return (
        F.when(status.isNull(), "text_unavailable")
        .when(label.isNull(), "source_unavailable")
        .when(status.isin("complex", "ambiguous"), "unresolved")
        .when(F.size(values) == 0, "insufficient_evidence")
        .when(F.array_contains(values, label), F.when(F.size(values) == 1, "consistent").otherwise("compatible_detail"))
        .otherwise("potential_conflict")
    )
