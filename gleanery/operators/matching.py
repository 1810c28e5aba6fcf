"""Dictionary matching in free text, with evidence: spans, clauses, sections, context and status.

Everything that depends on words is a table: aliases with the context they need, headings, cues
and the ordered rules of contexts. A text is folded, scanned once by an automaton, its matches are
chosen by how far each code already reaches, and each match is judged inside its own clause.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

# What ends a clause, what may divide one, and words that stand for an empty text.
BREAK = re.compile(r"(?<!\d)\.(?=\s|$)|[;\n!?•·●]|\s+[-–—]\s+")
DIVIDE = re.compile(r"\b(?:nhưng|tuy nhiên|however|but)\b|,\s*(?=(?:ưu tiên|không (?:yêu cầu|cần)|cần biết|phải biết|thành thạo|sử dụng|có khả năng|biết)\b)", re.I)
EMPTY = {"", ".", "-", "không", "khác", "n/a", "none"}
_FULL = re.compile(r"\S|\Z")
# Headings that hold until the next one.
HEADINGS = {
    "preferred": re.compile(r"ưu tiên|preferred(?: qualifications| skills)?|nice[ -]to[ -]have", re.I),
    "required": re.compile(r"yêu cầu(?: công việc)?|requirements|required(?: qualifications| skills)?|bắt buộc|must[ -]have", re.I),
}
# Cues of contexts.
_ABILITY = r"\b(?:biết|hiểu biết|am hiểu|thành thạo|sử dụng|kinh nghiệm|kiến thức|kỹ năng|giao tiếp|giỏi|nắm vững|know\w*|proficien\w*|fluent\w*|familiar\w*|experience|skills?|ability|using|working with)\b"
_STUDY = r"\b(?:tốt nghiệp|chuyên ngành|cử nhân|đại học|cao đẳng|degree in|major in|bachelor\w* in)\b"
_WISH = r"định hướng|mong muốn|yêu thích|đam mê"
_TAUGHT = r"được\s+(?:công ty\s+)?(?:đào tạo|hướng dẫn)|be\s+(?:trained|taught)|training\s+(?:is\s+)?provided"
_LATER = r"sẽ\s+được|sau khi\s+(?:nhận|vào)|will|shall|training\s+(?:is\s+)?provided"
_NO = r"không\s+(?:yêu cầu|cần|đòi hỏi|bắt buộc)|chưa\s+(?:biết|có kinh nghiệm)|(?:not|isn't|aren't)\s+(?:required|mandatory|necessary)|no need"
_BETTER = r"ưu tiên|lợi thế|điểm cộng|ưu thế|preferred|nice[ -]to[ -]have|\bplus\b|advantage|bonus"
EVIDENCE = "array<struct<code:string,start:int,end:int,text:string,clause_start:int,clause_end:int,context:string,rule:string,logic:string>>"
POSITIVE = ("required", "preferred")


@dataclass(frozen=True)
class Alias:
    """A spelling of a code. ``needs`` must stand in its clause, ``not_before`` directly before it and
    ``not_after`` directly after it must not; an alias whose context fails is no match. An alias that
    is ``doubtful`` needs a cue of ability in its clause, or its context is ambiguous."""

    code: str
    text: str
    needs: str = ""
    not_before: str = ""
    not_after: str = ""
    doubtful: bool = False


class Read:
    """A text with the places of every cue that was asked for: each cue is looked for once."""

    def __init__(self, text: str):
        self.text = text
        self._places: dict[str, tuple[list[int], list[int]]] = {}

    def places(self, cue: str) -> tuple[list[int], list[int]]:
        """Starts and ends of a cue's places, in order."""
        if cue not in self._places:
            spans = [m.span() for m in _rx(cue).finditer(self.text)]
            self._places[cue] = [s for s, _ in spans], [e for _, e in spans]
        return self._places[cue]

    def last(self, cue: str, left: int, right: int) -> int | None:
        """Where the last place of a cue inside [left, right) ends."""
        starts, ends = self.places(cue)
        i = bisect_right(ends, right) - 1
        return ends[i] if i >= 0 and starts[i] >= left else None

    def ends_at(self, cue: str, at: int) -> bool:
        _, ends = self.places(cue)
        i = bisect_left(ends, at)
        return i < len(ends) and ends[i] == at

    def inside(self, cue: str, a: int, b: int) -> bool:
        """Whether one place of a cue spans [a, b)."""
        starts, ends = self.places(cue)
        i = bisect_right(starts, a) - 1
        return i >= 0 and ends[i] >= b


@dataclass(frozen=True)
class Rule:
    """``context`` if ``cue`` stands in its part (before the match, or anywhere in what speaks of it),
    nothing of ``unless`` follows its last place there, and ``also`` stands in the same part."""

    name: str
    context: str
    part: str
    cue: str
    unless: str = ""
    also: str = ""

    def holds(self, read: Read, left: int, a: int, right: int) -> bool:
        end = a if self.part == "before" else right
        at = read.last(self.cue, left, end)
        if at is None or self.also and read.last(self.also, left, end) is None:
            return False
        return not self.unless or read.last(self.unless, at, end) is None


@lru_cache(512)
def _rx(pattern: str) -> re.Pattern:
    return re.compile(pattern, re.I)


#: Tried in order; a match that no rule takes has the context of its section.
RULES = (
    Rule("wish", "mentioned", "before", _WISH, unless=_ABILITY),
    Rule("study", "mentioned", "before", _STUDY, unless=_ABILITY),
    Rule("own_stack", "mentioned", "before", r"(?:công ty|our (?:company|stack))\s+(?:sử dụng|uses?|includes?)"),
    Rule("taught_before", "required", "clause", r"đã\s+được\s+đào tạo"),
    Rule("taught_later", "mentioned", "clause", _TAUGHT, also=_LATER),
    Rule("taught_some_time", "ambiguous", "clause", _TAUGHT),
    Rule("double_negation", "ambiguous", "clause", r"không phải (?:là )?không|not (?:unnecessary|without)"),
    Rule("optional_advantage", "preferred", "clause", r"không bắt buộc|not (?:required|mandatory)", also=_BETTER),
    Rule("negated_and_preferred", "ambiguous", "clause", _NO, also=_BETTER),
    Rule("negation", "negated", "clause", _NO),
    Rule("preference", "preferred", "clause", _BETTER),
)
_LINK = r"https?://\S+|\b[^\s@]{1,64}@[^\s@]+\.[^\s@]+"
_OWN = f"{_NO}|{_BETTER}"
_FEW = r"(?:ít nhất|at least)\s+(\d+|hai|ba)\s+(?:ngôn ngữ|công cụ|of)"
_OR = r"\b(?:hoặc|or|hay)\b"


class Matcher:
    """``aliases``: ``Alias`` or (code, text); ``implied``: code -> codes that its matches cover;
    ``overrides``: (SHA-256 of a text, code) -> context, for texts that somebody has read."""

    def __init__(self, aliases: Iterable[Alias | tuple[str, str]], implied: Mapping[str, Sequence[str]] | None = None, overrides: Mapping[tuple[str, str], str] | None = None):
        self.automaton = ahocorasick.Automaton()
        self.covers = {k: tuple(v) for k, v in (implied or {}).items()}
        self.overrides = dict(overrides or {})
        spelled: dict[str, Alias] = {}
        for x in aliases:
            alias = x if isinstance(x, Alias) else Alias(*x)
            if spelled.setdefault(alias.text.casefold(), alias).code != alias.code:
                raise ValueError(f"alias of two codes: {alias.text}")
        for text, alias in spelled.items():
            self.automaton.add_word(text, (len(text), alias))
        self.automaton.make_automaton()
        self.any = bool(spelled)

    def found(self, text: str) -> list[tuple[int, int, Alias]]:
        """The matches in order of their starts, longer ones first; offsets count code points.

        A code reaches to the end of its last match and of those that cover it: what starts before
        that point is not chosen. Matches of other codes may overlap.
        """
        if not self.any:
            return []
        folded, own = text.casefold(), None
        if len(folded) != len(text):  # only then do some signs fold to several
            own = np.repeat(np.arange(len(text) + 1), [*(len(c.casefold()) for c in text), 1])
        hits = []
        for last, (n, alias) in self.automaton.iter(folded):
            a, b = last + 1 - n, last + 1
            if not _stands_alone(folded, a, b):
                continue
            if own is not None:
                if a and own[a] == own[a - 1] or own[b] == own[b - 1]:
                    continue  # begins or ends inside a sign
                a, b = int(own[a]), int(own[b])
            hits.append((a, -b, alias.code, alias))
        reach: dict[str, int] = {}
        chosen = []
        for a, b, code, alias in sorted(hits, key=lambda h: h[:3]):
            if a >= reach.get(code, 0):
                chosen.append((a, -b, alias))
                for c in (code, *self.covers.get(code, ())):
                    reach[c] = max(reach.get(c, 0), -b)
        return chosen

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, code) of the matches, whatever their context."""
        return [(a, b, alias.code) for a, b, alias in self.found(text)]

    def extract(self, text: str | None) -> tuple[str, list[dict]]:
        """(status, evidence).

        Statuses: missing, unusable (a word that stands for nothing), no_match, matched, or
        needs_review if some evidence is ambiguous; a code both wanted and negated is.
        """
        if text is None or not text.strip():
            return "missing", []
        if text.strip().casefold() in EMPTY:
            return "unusable", []
        found = self.found(text)
        if not found:
            return "no_match", []
        parts, read = clauses(text, [a for a, _, _ in found]), Read(text)
        starts = [p[0] for p in parts]
        key = sha256(text.encode()).hexdigest() if self.overrides else ""
        evidence = []
        for i, (a, b, alias) in enumerate(found):
            left, right, section = parts[bisect_right(starts, a) - 1]
            if not _fits(alias, read, a, b, left, right):
                continue
            own = _own_part(read, found, i, left, right)
            context, rule = ("mentioned", "link") if read.inside(_LINK, a, b) else context_of(read, own[0], a, own[1], section)
            if alias.doubtful and context in POSITIVE and read.last(_ABILITY, left, right) is None:
                context, rule = "ambiguous", "doubtful_alias"
            if (key, alias.code) in self.overrides:
                context, rule = self.overrides[key, alias.code], "override"
            evidence.append(
                {"code": alias.code, "start": a, "end": b, "text": text[a:b], "clause_start": left, "clause_end": right, "context": context, "rule": rule, "logic": logic_of(read, left, right)}
            )
        kinds: dict[str, set[str]] = {}
        for e in evidence:
            kinds.setdefault(e["code"], set()).add(e["context"])
        for e in evidence:
            if "negated" in kinds[e["code"]] and kinds[e["code"]] & set(POSITIVE):
                e |= {"context": "ambiguous", "rule": "conflict"}
        if any(e["context"] == "ambiguous" for e in evidence):
            return "needs_review", evidence
        return ("matched" if any(e["context"] in POSITIVE for e in evidence) else "no_match"), evidence


def _stands_alone(text: str, a: int, b: int) -> bool:
    """Whether no word goes on at either side: C is not found in C++ or C#, .NET not in ..NET."""
    before, after = text[a - 1 : a], text[b : b + 1]
    word = lambda c: c.isalnum() or c == "_"
    return not (before and (word(before) or before == "." == text[a]) or after and (word(after) or after in "+#"))


def _fits(alias: Alias, read: Read, a: int, b: int, left: int, right: int) -> bool:
    return not (
        alias.needs and read.last(alias.needs, left, right) is None
        or alias.not_before and read.ends_at(alias.not_before, a)
        or alias.not_after and _rx(alias.not_after).match(read.text, b, right)
    )


def _own_part(read: Read, found: Sequence, i: int, left: int, right: int) -> tuple[int, int]:
    """The part of a clause that speaks of one match: up to the next match, and from the last comma
    on if a cue of its own stands between it and the match before."""
    a, b, _ = found[i]
    following = i + 1
    while following < len(found) and found[following][0] < b:
        following += 1
    before = i - 1
    while before >= 0 and found[before][0] >= left and found[before][1] > a:
        before -= 1
    if before >= 0 and found[before][0] >= left:
        last = found[before][1]
        comma = read.text.rfind(",", last, a)
        if comma >= 0 and read.last(_OWN, last, a) is not None:
            left = comma + 1
    return left, min(right, found[following][0]) if following < len(found) else right


def clauses(text: str, matches: Sequence[int] = ()) -> list[tuple[int, int, str]]:
    """(start, end, section) of the clauses, which cover the text.

    A clause that is a heading sets the section until the next heading, ``required`` before the
    first. A clause is divided at words of contrast, and at commas before a new cue, if a match
    follows in it; ``matches`` are the sorted starts of matches.
    """
    ends = [m.end() for m in BREAK.finditer(text)] + [len(text) + 1]
    out, section, left = [], "required", 0
    for right in ends:
        bare = text[left:right].strip(" \t\n:-–—.;!?•·●")
        section = next((k for k, rx in HEADINGS.items() if rx.fullmatch(bare)), section)
        opens = _FULL.search(text, left)
        cuts = [m.end() for m in DIVIDE.finditer(text, left, min(right, len(text))) if opens.start() < m.start() and bisect_left(matches, m.end()) < bisect_left(matches, right)]
        for x, y in zip([left, *cuts], [*cuts, right]):
            out.append((x, y, section))
        left = right
    return out


def context_of(read: Read, left: int, a: int, right: int, section: str, without: Sequence[str] = ()) -> tuple[str, str]:
    """(context, name of the rule) of a match at ``a`` of which [left, right) speaks: the first rule
    that holds, but for those in ``without``, else the section's context."""
    rule = next((r for r in RULES if r.name not in without and r.holds(read, left, a, right)), None)
    return (rule.context, rule.name) if rule else (section, "heading" if section == "preferred" else "assertion")


def logic_of(read: Read, left: int, right: int) -> str:
    """How the matches of a clause belong together: at_least:n, any_of, listed or single."""
    if (end := read.last(_FEW, left, right)) is not None:
        return "at_least:" + _rx(_FEW).match(read.text, read.places(_FEW)[0][bisect_left(read.places(_FEW)[1], end)])[1].lower()
    return "any_of" if read.last(_OR, left, right) is not None else "listed" if read.last("/", left, right) is not None else "single"


def match_texts(df: DataFrame, key: str, text: str, aliases: Iterable[Alias | tuple[str, str]], implied: Mapping[str, Sequence[str]] | None = None, overrides: Mapping[tuple[str, str], str] | None = None) -> DataFrame:
    """``key, status, evidence``: the dictionary matched in every text.

    Every evidence is the exact slice of the text. Equal texts of a batch are matched once; texts
    of any length are read whole; null and blank ones are ``missing``. Other columns are ignored.
    """
    kind = df.schema[key].dataType.simpleString()
    listed = list(aliases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = lru_cache(4096)(Matcher(listed, implied, overrides).extract)
        names = ("code", "start", "end", "text", "clause_start", "clause_end", "context", "rule", "logic")
        fields = [pa.field(n, pa.int32() if n in ("start", "end", "clause_start", "clause_end") else pa.string()) for n in names]
        for batch in batches:
            got = [extract(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.list_(pa.struct(fields)))], names=[key, "status", "evidence"]
            )

    return df.select(key, df[text].cast("string")).mapInArrow(run, f"`{key}` {kind}, status string, evidence {EVIDENCE}")


def clause_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, place, start, end, section, context``: the clauses of every text, numbered from 1.

    ``context`` is that of the whole clause. Null texts have none; a blank one is one clause.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [key, "place", "start", "end", "section", "context"]
        types = [df_type, pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string()]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                read = Read(t or "")
                for i, (a, b, section) in enumerate(clauses(t) if t is not None else (), 1):
                    for column, v in zip(out, (k, i, a, min(b, len(t)), section, context_of(read, a, b, b, section)[0])):
                        column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], names=names)

    df_type = to_arrow_type(df.schema[key].dataType)
    return df.select(key, df[text].cast("string")).mapInArrow(run, f"`{key}` {kind}, place int, start int, end int, section string, context string")


def pairs(matched: DataFrame, key: str) -> DataFrame:
    """``key, code`` once per code that is required or preferred; texts under review give none."""
    e = matched.where("status = 'matched'").select(key, F.explode("evidence").alias("e"))
    return e.where(F.col("e.context").isin(*POSITIVE)).select(key, F.col("e.code").alias("code")).distinct()


def with_parents(found: DataFrame, key: str, implied: Mapping[str, Sequence[str]]) -> DataFrame:
    """``key, code, derived``: the pairs and those of the codes they imply, each once; a pair that was
    found is not derived."""
    spark = found.sparkSession
    listed = spark.createDataFrame([(c, p) for c, ps in implied.items() for p in ps], "code string, parent string")
    derived = found.join(F.broadcast(listed), "code").select(key, F.col("parent").alias("code"), F.lit(True).alias("derived"))  # as long as the taxonomy
    return found.select(key, "code", F.lit(False).alias("derived")).unionByName(derived).groupBy(key, "code").agg(F.bool_and("derived").alias("derived"))


def close_reviews(matched: DataFrame) -> DataFrame:
    """``matched`` with its rows under review decided by keyword or skip: ambiguous evidence is left
    out, what then remains positive counts as matched. Other rows are as they were."""
    kept = F.filter("evidence", lambda e: e.context != "ambiguous")
    positive = F.exists(kept, lambda e: e.context.isin(*POSITIVE))
    review = F.col("status") == "needs_review"
    return matched.select(
        *[c for c in matched.columns if c not in ("status", "evidence")],
        F.when(review, F.when(positive, "matched").otherwise("no_match")).otherwise(F.col("status")).alias("status"),
        F.when(review, kept).otherwise(F.col("evidence")).alias("evidence"),
        review.alias("closed"),
    )


def assess(df: DataFrame, text: str, quote: str, pattern: str) -> DataFrame:
    """``df`` with ``verdict`` on a proposed quote: not_quoted (no part of the text), no_match (the
    pattern is not in it), rejected (negated), unclear (negated and preferred at once) or accepted."""
    q, t = F.col(quote), F.col(text)
    no, better = q.rlike(f"(?iU){_NO}"), q.rlike(f"(?iU){_BETTER}")
    verdict = (
        F.when(~F.coalesce(F.contains(t, q) & (F.length(q) > 0), F.lit(False)), "not_quoted").when(~q.rlike(pattern), "no_match").when(no & better, "unclear").when(no, "rejected").otherwise("accepted")
    )
    return df.withColumn("verdict", verdict)
