"""Contracts of sources that are read whole by the driver or checked before use: paths, workbooks,
dictionaries, rates, rules, rows."""

from __future__ import annotations

import io
import os
import re
import zipfile
from collections.abc import Mapping, Sequence
from functools import reduce
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A workbook may have this many bytes.
WORKBOOK_BYTES = 50_000_000
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def path_status(path: Column) -> Column:
    """``contained``, or why a path may not be followed: empty, absolute, escapes."""
    return F.when(F.coalesce(F.trim(path), F.lit("")) == "", "empty").when(path.startswith("/"), "absolute").when(F.array_contains(F.split(path, "/"), ".."), "escapes").otherwise("contained")


def resolved(root: str, relative: str) -> str:
    """The file below a local ``root``, links followed; what leads outside is refused."""
    whole = os.path.realpath(os.path.join(root, relative))
    base = os.path.realpath(root)
    if os.path.isabs(relative) or ".." in relative.split("/") or os.path.commonpath([base, whole]) != base or whole == base:
        raise ValueError(f"outside its folder: {relative}")
    return whole


def read_workbook(data: bytes, sheet: str) -> list[dict[str, str | None]]:
    """The rows of one sheet of an XLSX file by its header; formulas and oversized files are refused."""
    if len(data) > WORKBOOK_BYTES:
        raise ValueError("workbook too large")
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        if sum(i.file_size for i in z.infolist()) > 10 * WORKBOOK_BYTES:
            raise ValueError("workbook unpacks to too much")
        part = lambda name: ElementTree.fromstring(z.read(name))
        links = {r.get("Id"): r.get("Target") for r in part("xl/_rels/workbook.xml.rels")}
        target = next((links[s.get(_LINK)] for s in part("xl/workbook.xml").iter(f"{_MAIN}sheet") if s.get("name") == sheet), None)
        if target is None:
            raise ValueError(f"no sheet {sheet}")
        shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in part("xl/sharedStrings.xml")] if "xl/sharedStrings.xml" in z.namelist() else []
        rows = []
        for row in part(f"xl/{target.lstrip('/').removeprefix('xl/')}").iter(f"{_MAIN}row"):
            cells: dict[int, str | None] = {}
            for c in row.iter(f"{_MAIN}c"):
                if c.find(f"{_MAIN}f") is not None:
                    raise ValueError(f"formula in {c.get('r')}")
                cells[_column(c.get("r", "A"))] = _cell(c, shared)
            rows.append(cells)
    if not rows:
        return []
    header = {i: str(v) for i, v in rows[0].items() if v}
    return [{name: r.get(i) for i, name in header.items()} for r in rows[1:]]


def _column(reference: str) -> int:
    return reduce(lambda n, c: 26 * n + ord(c) - 64, re.match("[A-Z]+", reference)[0], 0)


def _cell(c: ElementTree.Element, shared: Sequence[str]) -> str | None:
    if c.get("t") == "inlineStr":
        return "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
    v = c.find(f"{_MAIN}v")
    return None if v is None or v.text is None else shared[int(v.text)] if c.get("t") == "s" else v.text


def write_workbook(rows: Sequence[Sequence[str | None]], sheet: str) -> bytes:
    """A workbook of one sheet of texts."""
    esc = lambda v: v.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")

    def letter(i: int) -> str:
        return (letter(i // 26 - 1) if i >= 26 else "") + chr(65 + i % 26)

    body = "".join(
        f'<row r="{n}">' + "".join(f'<c r="{letter(i)}{n}" t="inlineStr"><is><t xml:space="preserve">{esc(v)}</t></is></c>' for i, v in enumerate(r) if v is not None) + "</row>" for n, r in enumerate(rows, 1)
    )
    kind = "http://schemas.openxmlformats.org"
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{kind}/package/2006/content-types"><Default Extension="xml" ContentType="application/xml"/><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/></Types>',
        "xl/workbook.xml": f'<workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{_LINK[1:-3]}"><sheets><sheet name="{esc(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{kind}/package/2006/relationships"><Relationship Id="rId1" Type="{_LINK[1:-3]}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{_MAIN[1:-1]}"><sheetData>{body}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


def dictionary_faults(codes: DataFrame, aliases: DataFrame, code: str, alias: str, contextual: str, short: int = 3) -> DataFrame:
    """``rule, breaks`` of a dictionary: an alias of two codes, a code without alias, an alias of an
    unknown code, an alias of fewer than ``short`` letters that needs no context, a blank alias."""
    folded = F.lower(F.trim(F.col(alias)))
    held = aliases.where(F.coalesce(folded, F.lit("")) != "")
    shared = held.select(folded.alias("a"), F.col(code).alias("c")).distinct().groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return rules_broken(
        {
            "alias_of_two_codes": shared,
            "code_without_alias": codes.join(held.select(code), code, "left_anti"),
            "alias_of_unknown_code": aliases.join(codes.select(code), code, "left_anti"),
            "short_alias_without_context": held.where((F.length(folded) < short) & ~F.coalesce(F.col(contextual), F.lit(False))),
            "blank_alias": aliases.where(F.coalesce(folded, F.lit("")) == ""),
        }
    )


def rate_faults(rates: DataFrame, years: DataFrame, year: str) -> DataFrame:
    """``rule, breaks`` of a table of yearly rates held against the years it is needed for."""
    r = rates.where("approved")
    twice = r.groupBy(year).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    needed = years.where(F.col(year).isNotNull()).select(F.col(year).cast("long").alias(year)).distinct()
    series = r.select("series").distinct().agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return rules_broken(
        {
            "year_without_rate": needed.join(r.select(F.col(year).cast("long").alias(year)), year, "left_anti"),
            "year_with_two_rates": twice,
            "more_than_one_series": series,
            "not_positive": r.where("vnd_per_usd is null or vnd_per_usd <= 0"),
            "period_reversed": r.where("period_start > period_end"),
        }
    )


def rules_broken(breaks: Mapping[str, DataFrame]) -> DataFrame:
    """``rule, breaks``: how many rows each rule's query returns."""
    return reduce(DataFrame.unionByName, [df.agg(F.lit(k).alias("rule"), F.count(F.lit(1)).alias("breaks")) for k, df in breaks.items()])


def sound(faults: DataFrame) -> None:
    """An error naming the rules that are broken, if any is."""
    bad = {r["rule"]: r["breaks"] for r in faults.where("breaks > 0").collect()}
    if bad:
        raise ValueError(f"contract broken: {bad}")


def typed_rows(df: DataFrame, columns: Mapping[str, str], checks: Mapping[str, Column]) -> DataFrame:
    """The columns in their types (null where a value does not convert) with ``faults``, the names of
    the checks a row fails; a value that was there and did not convert is a fault of its own."""
    typed = df.select(*[F.col(c).try_cast(t).alias(c) for c, t in columns.items()], *[(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(f"__{c}") for c, t in columns.items()])
    lost = [F.when(F.col(f"__{c}"), F.lit(f"{c}_not_{t.split('(')[0]}")) for c, t in columns.items()]
    failed = [F.when(~F.coalesce(check, F.lit(False)), F.lit(k)) for k, check in checks.items()]
    return typed.withColumn("faults", F.array_compact(F.array(*lost, *failed))).drop(*[f"__{c}" for c in columns])


def write_json_lines(df: DataFrame, path: str, gz: bool = False) -> None:
    """One JSON object a line, nulls written."""
    df.write.mode("append").option("ignoreNullFields", False).option("compression", "gzip" if gz else "none").json(path)


def once_per_key(df: DataFrame, key: str) -> DataFrame:
    """One of the rows of each key: the least in the order of the other columns."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min(F.struct(*others)).alias("__r")).select(key, "__r.*")


def save_table(spark: SparkSession, df: DataFrame, name: str, path: str) -> DataFrame:
    """``df`` as a catalogued table at ``path``; an error if it does not hold as many rows as were read."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)
    return spark.table(name)
