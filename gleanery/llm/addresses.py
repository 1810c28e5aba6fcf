"""Postal addresses that denote the same place.

An address is read into house number (with suffix), street line and province; ward, district,
floor, room and building are set aside. Equal readings are collapsed; candidates come from
MinHash banding over token and q-gram shingles (number and province, in which no two readings of
one place differ, stand in every band key too); an affine-gap alignment of tokens whose
substitution costs know abbreviations decides; verified readings are clustered into stars.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.canonical import Mapper
from gleanery.llm.folding import fold
from gleanery.llm.minhash import bands_for, edits, grams
from gleanery.llm.names import BAND, candidate_pairs, respace, stars, word_edits
from gleanery.session import cut, small

# What opens the parts of an address, folded.
ROOM = re.compile(r"^(?:p\.?\s*\d{3,}|phong\s*\d+|room\s*\d+|(?:tang|lau|floor|toa nha|toa|cao oc|building|block|can ho)\b)")
AREA = re.compile(r"^(?:(?:phuong|xa|ward|quan|huyen|thi xa|thi tran|district)\b|[pfxqh]\.|[pfq]\s*\d|tx\b|tt\.)")
LEAD = re.compile(r"^(?:vp|van phong|dia chi|dc|noi lam viec|tru so|chi nhanh|tai)\s*:\s*")
NUMBER = re.compile(r"^(?:so nha|nha so|so|sn|no)?\.?\s*(\d+[a-z]?(?:\s*/\s*\d+[a-z]?)*)(?![\w/])\s*(.*)$")
# Abbreviations of street words, folded.
ABBREVIATIONS = {
    "d": "duong", "dg": "duong", "duog": "duong", "ph": "pho", "str": "street", "st": "street", "rd": "road", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "ln": "lane", "al": "alley",
    "dl": "dailo", "qlo": "quoclo", "ql": "quoclo", "tl": "tinhlo", "hl": "huonglo", "ng": "ngo", "h": "hem", "sn": "so", "no": "so", "n": "north", "s": "south", "e": "east", "w": "west",
}
TYPES = {"duong", "street", "pho", "so", "road", "avenue", "boulevard", "lane", "alley"}
#: What an edited letter costs, where a whole word costs 1; and what two readings of one place may cost.
LETTER, COST = 0.3, 0.65


@lru_cache(1 << 16)
def parse_address(address: str) -> tuple[str, str, str] | None:
    """(house number, street words, other parts that may name the province), None without number or street."""
    text = LEAD.sub("", re.sub(r"\([^()]*\)", " ", fold(address)).strip())
    number, street, rest, waiting = "", "", [], False
    for part in re.split(r"[,;\n|]|\s[-–]\s", text):
        part = part.strip(" .-")
        if not part or part in ("viet nam", "vietnam", "vn"):
            continue
        if waiting:  # a street may begin like a ward: what follows a bare house number is the street
            street, waiting = part, False
        elif ROOM.match(part) or AREA.match(part):
            continue
        elif not number and (m := NUMBER.match(part)):
            number, street = re.sub(r"\s", "", m[1]).upper(), m[2].strip()
            waiting = not street
        else:
            rest.append(part)
    ws = re.findall(r"[^\W_]+", street)
    if len(ws) > 1 and ws[0] in ("duong", "d", "dg", "pho"):
        ws = ws[1:]
    if len(ws) > 1 and ws[-1] in ("street", "st", "str"):
        ws = ws[:-1]
    return (number, " ".join(ws), " ".join(rest)) if number and ws else None


def align(a: Sequence[str], b: Sequence[str], opening: float = 1.0, extending: float = 0.5) -> float:
    """Cost of the best affine-gap alignment of two token lists.

    Equal tokens and abbreviations of the same word cost nothing, others ``LETTER`` for each edited
    letter, or 1 if more than two thirds are, numbers that differ are never aligned; gaps of
    street words cost a tenth.
    """
    a, b = [ABBREVIATIONS.get(x, x) for x in a], [ABBREVIATIONS.get(x, x) for x in b]
    far = float("inf")

    def swap(x: str, y: str) -> float:
        if x == y:
            return 0.0
        if x[:1].isdigit() or y[:1].isdigit():
            return far
        if x in TYPES or y in TYPES:
            return 0.1 if x in TYPES and y in TYPES else 2.0
        wrong = word_edits(x, y, 9)
        return LETTER * wrong if 3 * wrong <= 2 * max(len(x), len(y)) else 1.0

    def gap(x: str, goes_on: bool) -> float:
        return (extending if goes_on else opening) * (0.1 if x in TYPES else 1.0)

    n, m = len(a), len(b)
    match = [[far] * (m + 1) for _ in range(n + 1)]
    up = [[far] * (m + 1) for _ in range(n + 1)]
    side = [[far] * (m + 1) for _ in range(n + 1)]
    match[0][0] = 0.0
    for i in range(n + 1):
        for j in range(m + 1):
            if i and j:
                match[i][j] = min(match[i - 1][j - 1], up[i - 1][j - 1], side[i - 1][j - 1]) + swap(a[i - 1], b[j - 1])
            if i:
                up[i][j] = min(min(match[i - 1][j], side[i - 1][j]) + gap(a[i - 1], False), up[i - 1][j] + gap(a[i - 1], True))
            if j:
                side[i][j] = min(min(match[i][j - 1], up[i][j - 1]) + gap(b[j - 1], False), side[i][j - 1] + gap(b[j - 1], True))
    return min(match[n][m], up[n][m], side[n][m])


def same_place(a: str, b: str, most: float = COST) -> float:
    """Similarity of two readings ``province|number|street words``; 0 if they are different places."""
    (pa_, na, sa), (pb, nb, sb) = a.split("|"), b.split("|")
    if pa_ != pb or na != nb:
        return 0.0
    wa, wb = sa.split(), sb.split()
    cost = align(["so", na.lower(), *wa], ["so", nb.lower(), *wb])
    letters = int(most / LETTER)
    if cost > 0 and len(wa) != len(wb) and edits("".join(wa), "".join(wb), letters) <= letters:  # one of them may be glued
        wa, wb = (respace(wa, wb), wb) if len(wa) < len(wb) else (wa, respace(wb, wa))
        cost = min(cost, align(["so", na.lower(), *wa], ["so", nb.lower(), *wb]))
    return 1 / (1 + cost) if cost <= most else 0.0


def _province(location: str | None, find) -> int:
    """The first province among the parts of a location field that are no wards or districts."""
    parts = re.split(r"[,;|\n]", re.sub(r"\([^()]*\)", " ", location)) if location else []
    return next((p for x in parts if not AREA.match(fold(x)) and (p := find(x))), 0)


def shingles(reading: str) -> set[str]:
    """Tokens (province, number, words written out) and the trigrams of the street's letters."""
    province, number, street = reading.split("|")
    full = [ABBREVIATIONS.get(w, w) for w in street.split()]
    named = [w for w in full if w not in TYPES] or full
    return {f"@{province}", f"#{number}", *(f"={w}" for w in named)} | grams("".join(named), 3)


def _tokens(reading: str) -> str:
    """House number and province: tokens that no two readings of one place differ in."""
    return reading.rpartition("|")[0]


#: The least Jaccard similarity of two spellings that align is about 0.3 (two edits in eight letters).
BANDINGS = ((shingles, bands_for(0.3, 0.95, 2), 2),)


def link_addresses(records: DataFrame, key: str, address: str, location: str, places: list) -> DataFrame:
    """``record, place``: the place each record's address denotes.

    ``places``: entries of provinces (id, names, code). The province is read in the address, else
    in ``location``. Null, blank and remark-only addresses and those without number, street or
    known province give no row; repeated records share a place; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = lru_cache(1 << 16)(Mapper(places).find)
        for batch in batches:
            kept, readings = [], []
            for i, (a, l) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                got = parse_address(a) if a else None
                province = got and (find(got[2]) or _province(l, find))
                if province:
                    kept.append(i)
                    readings.append(f"{province}|{got[0]}|{got[1]}")
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept, pa.int64())), pa.array(readings, pa.string())], names=["record", "reading"])

    picked = records.select(F.col(key).alias("record"), F.col(address).cast("string"), F.col(location).cast("string"))
    kind = picked.schema["record"].dataType.simpleString()
    read = cut(picked.where(F.col("record").isNotNull()).mapInArrow(run, f"record {kind}, reading string"))
    nodes = cut(read.groupBy(F.col("reading").alias("node")).agg(F.count(F.lit(1)).alias("n")))
    pairs = candidate_pairs(nodes, "node", BANDINGS, _tokens)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sim = [same_place(a, b) for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sim, pa.float64())], names=["a", "b", "sim"])

    edges = cut(pairs.mapInArrow(verify, "a string, b string, sim double").where("sim > 0"))
    star = stars(nodes, edges, F.col("n"))
    return read.join(star.select(F.col("node").alias("reading"), F.col("center").alias("place")), "reading").select("record", "place")


def same_place_pairs(linked: DataFrame, a: str, b: str) -> DataFrame:
    """Each pair ``a < b`` of records at one place; a place of many records is cut into squares."""
    blocks = linked.groupBy("place").agg(F.ceil(F.count(F.lit(1)) / BAND).cast("int").alias("m")).where("m > 1")
    placed = linked.join(small(blocks), "place", "left").withColumn("m", F.coalesce("m", F.lit(1))).withColumn("__x", F.pmod(F.xxhash64("record"), F.col("m")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("m") - 1))
    left = placed.select("place", F.col("record").alias(a), "__x", every.alias("__y"))
    right = placed.select("place", F.col("record").alias(b), F.col("__x").alias("__y"), every.alias("__x"))
    return left.join(right, ["place", "__x", "__y"]).where(F.col(a) < F.col(b)).select(a, b)
