"""Postings from saved pages: listings by patterns, details by a parser, embedded JSON."""

from __future__ import annotations

import json
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DETAIL = "title string, company string, salary string, location string, posted string, heading string, n_links int, error string"


def listing(df: DataFrame, page: str, html: str, id_pattern: str) -> DataFrame:
    """``page, place, url, job_id``: the linked postings of a page, each id once at its first place."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(r"""(?i)<a\b[^>]*?href\s*=\s*["']([^"'#]+)"""), 1)
    found = df.select(page, F.posexplode(hrefs).alias("place", "url")).withColumn("job_id", F.regexp_extract("url", id_pattern, 1)).where("job_id <> ''")
    first = found.groupBy(page, "job_id").agg(F.min("place").alias("place"), F.min_by("url", "place").alias("url"))
    return first.select(page, "place", "url", "job_id")


def page_fingerprints(found: DataFrame, page: str) -> DataFrame:
    """``page, n_jobs, fingerprint`` of a listing's ids, whatever their order; a page holds some dozens."""
    return found.groupBy(page).agg(F.count(F.lit(1)).alias("n_jobs"), F.sha2(F.to_json(F.array_sort(F.collect_set("job_id"))), 256).alias("fingerprint"))


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[str] = []
        self.links, self.heading, self._in = 0, "", ""

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        self.links += tag == "a" and bool(a.get("href"))
        if tag == "script" and (a.get("type") or "").lower() == "application/ld+json":
            self._in = "ld"
            self.blocks.append("")
        elif tag == "h1":
            self._in = "h1"

    def handle_endtag(self, tag):
        if tag in ("script", "h1"):
            self._in = ""

    def handle_data(self, data):
        if self._in == "ld":
            self.blocks[-1] += data
        elif self._in == "h1":
            self.heading += data


def posting_of(value: object) -> dict | None:
    """The first JobPosting anywhere in a JSON-LD value."""
    stack = [value]
    while stack:
        v = stack.pop(0)
        if isinstance(v, dict):
            kind = v.get("@type")
            if kind == "JobPosting" or isinstance(kind, list) and "JobPosting" in kind:
                return v
            stack += v.values()
        elif isinstance(v, list):
            stack += v
    return None


def _text(v: object, *path: str) -> str | None:
    for p in path:
        v = v[0] if isinstance(v, list) and v else v
        v = v.get(p) if isinstance(v, dict) else None
    return " ".join(str(v).split()) or None if v is not None and not isinstance(v, (dict, list)) else None


def read_page(html: str | None) -> tuple:
    """The fields of a posting's page; ``error`` says what could not be read."""
    if not html:
        return (None,) * 6 + (0, "missing")
    page, found, error = _Page(), None, None
    page.feed(html)
    for block in page.blocks:
        try:
            found = found or posting_of(json.loads(block))
        except ValueError:
            error = "broken_json"
    heading = " ".join(page.heading.split()) or None
    if not found:
        return (heading, None, None, None, None, heading, page.links, error or "no_posting")
    salary = _text(found, "baseSalary", "value", "value") or _text(found, "baseSalary", "value", "minValue") or _text(found, "baseSalary")
    return (
        _text(found, "title") or heading, _text(found, "hiringOrganization", "name"), salary, _text(found, "jobLocation", "address", "addressRegion") or _text(found, "jobLocation", "address"),
        _text(found, "datePosted"), heading, page.links, None,
    )


def detail(c: Column) -> Column:
    """``struct`` of the fields of a posting's page."""

    @F.pandas_udf(DETAIL)
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read_page(h if isinstance(h, str) else None) for h in s], columns=["title", "company", "salary", "location", "posted", "heading", "n_links", "error"])

    return run(c)


def challenge(title: Column, body: Column) -> Column:
    """Whether a page asks to prove that its reader is human."""
    words = r"(?iU)just a moment|verify you are human|captcha|access denied|xác minh bạn là con người|attention required"
    return F.coalesce(title.rlike(words), F.lit(False)) | F.coalesce(body.rlike(words), F.lit(False))


def next_data(html: Column, path: str) -> Column:
    """A value of the JSON state embedded in a page."""
    return F.get_json_object(F.regexp_extract(html, r'(?s)<script id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1), path)


def page_facts(html: Column) -> Column:
    """``struct(next_url, total)`` of a listing: the link to its next page, and the number of hits it states."""
    link = F.regexp_extract(html, r"""(?is)<a\b(?=[^>]*\brel\s*=\s*["']next["'])[^>]*?\bhref\s*=\s*["']([^"']+)""", 1)
    total = F.regexp_extract(html, r"(?iU)([0-9][0-9.,]*)\s*(?:việc làm|jobs|kết quả|results)\b", 1)
    return F.struct(F.nullif(link, F.lit("")).alias("next_url"), F.translate(total, ".,", "").try_cast("long").alias("total"))


def pagination(body: Column) -> Column:
    """How a page says that more follows: next_link, page_parameter, load_more or none."""
    return (
        F.when(body.rlike(r"""(?i)rel\s*=\s*["']next["']"""), "next_link")
        .when(body.rlike(r"""(?i)href\s*=\s*["'][^"']*[?&](?:page|p|trang)=\d+"""), "page_parameter")
        .when(body.rlike(r"(?iU)load more|xem thêm|tải thêm"), "load_more")
        .otherwise("none")
    )


def url_scope(url: Column, hosts: tuple[str, ...], denied: tuple[str, ...]) -> Column:
    """Whether a URL may be read: allowed, other_host, denied_path or no_url."""
    host, path = F.lower(F.try_parse_url(url, F.lit("HOST"))), F.try_parse_url(url, F.lit("PATH"))
    inside = F.exists(F.array(*[F.lit(h) for h in hosts]), lambda h: (host == h) | host.endswith(F.concat(F.lit("."), h)))
    refused = F.exists(F.array(*[F.lit(d) for d in denied]), lambda d: path.startswith(d))
    return F.when(host.isNull() | ~url.rlike("(?i)^https?://"), "no_url").when(~inside, "other_host").when(F.coalesce(refused, F.lit(False)), "denied_path").otherwise("allowed")


def flight_rows(stream: str) -> dict[str, object]:
    """The rows ``id:json`` of a page's component stream; what is no JSON is left out."""
    out: dict[str, object] = {}
    for line in stream.split("\n"):
        name, _, body = line.partition(":")
        try:
            out[name] = json.loads(body)
        except ValueError:
            continue
    return out


def flight_value(stream: str | None, path: str) -> str | None:
    """A value of a component stream as JSON, references ``$id`` followed; null where the path leads
    nowhere. ``path``: row id and keys, joined by dots. A reference to itself is an error."""
    if not stream:
        return None
    rows = flight_rows(stream)

    def follow(v: object, open_: tuple[str, ...]) -> object:
        if isinstance(v, str) and len(v) > 1 and v[0] == "$" and v[1:] in rows:
            if v in open_:
                raise ValueError(f"reference to itself: {v}")
            return follow(rows[v[1:]], (*open_, v))
        if isinstance(v, dict):
            return {k: follow(x, open_) for k, x in v.items()}
        return [follow(x, open_) for x in v] if isinstance(v, list) else v

    first, *keys = path.split(".")
    if first not in rows:
        return None
    at = follow(rows[first], (f"${first}",))
    for k in keys:
        at = at.get(k) if isinstance(at, dict) else at[int(k)] if isinstance(at, list) and k.isdigit() and int(k) < len(at) else None
    return None if at is None else at if isinstance(at, str) else json.dumps(at, ensure_ascii=False, sort_keys=True)


def flight(c: Column, path: str) -> Column:
    """``flight_value`` of every page."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda v: flight_value(v if isinstance(v, str) else None, path))

    return run(c)
