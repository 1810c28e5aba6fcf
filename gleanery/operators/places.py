"""Which places of a list a text names, and what else it says about where: a status for every text."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Mapping, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from gleanery.operators.matching import Alias, Matcher

# What a text may say instead of a place, and what stands before a name that is no place of the list.
SAID = {
    "foreign": ("nước ngoài", "overseas", "abroad", "foreign"),
    "remote": ("remote", "từ xa", "làm tại nhà", "work from home", "online"),
    "nationwide": ("toàn quốc", "cả nước", "nationwide", "63 tỉnh thành"),
    "unknown": ("chưa rõ", "chưa xác định", "khác", "không rõ", "unknown", "n/a"),
}
BEFORE = r"\b(?:duong|pho|ngo|hem|toa nha|chung cu|kcn|khu cong nghiep|street)\s+"


@lru_cache(1 << 16)
def plain(text: str) -> str:
    """Lower case without accents, white space as single spaces."""
    d = unicodedata.normalize("NFD", text.lower()).replace("đ", "d")
    return " ".join("".join(c for c in d if not unicodedata.combining(c)).split())


class Places:
    """``names``: label -> spellings. Longest name wins; a name behind a street or facility word is no place."""

    def __init__(self, names: Mapping[str, Sequence[str]]):
        spelled: dict[str, set[str]] = {}
        for label, forms in names.items():
            for f in (label, *forms):
                spelled.setdefault(plain(f), set()).add(label)
        self.matcher = Matcher([Alias(f"={next(iter(of))}", form, not_before=BEFORE) for form, of in spelled.items() if form and len(of) == 1] + [Alias(f"#{k}", plain(w)) for k, ws in SAID.items() for w in ws if plain(w) not in spelled])

    def classify(self, text: str | None) -> tuple[str, list[str], list[str]]:
        """(status, labels in order, flags)."""
        if text is None or not text.strip():
            return "missing", [], []
        folded = plain(text)
        labels, said, street = [], set(), False
        for a, b, alias in sorted(self.matcher.found(folded), key=lambda m: (m[0] - m[1], m[0])):
            if alias.not_before and _behind_facility(folded, a):
                street = True
            elif alias.code[0] == "#":
                said.add(alias.code[1:])
            else:
                labels.append((a, b, alias.code[1:]))
        chosen: list[tuple[int, int, str]] = []
        for a, b, label in labels:  # longest first, none inside another
            if all(b <= x or a >= y for x, y, _ in chosen):
                chosen.append((a, b, label))
        ordered = list(dict.fromkeys(label for _, _, label in sorted(chosen)))
        status = "mapped_multiple" if len(ordered) > 1 else "mapped_single" if ordered else "unmapped"
        if "foreign" in said:
            status = "mapped_multiple" if ordered else "foreign"
        if "remote" in said:
            status = "remote"
        if "nationwide" in said:
            status = "nationwide"
        if status == "unmapped" and "unknown" in said:
            status = "unknown"
        flags = sorted((said - {"unknown"}) | ({"street_or_facility"} if street else set()))
        return status, ordered, flags


_FACILITY = re.compile(BEFORE + "$")


def _behind_facility(text: str, a: int) -> bool:
    return _FACILITY.search(text[max(0, a - 40) : a]) is not None


def classify_places(df: DataFrame, key: str, text: str, names: Mapping[str, Sequence[str]]) -> DataFrame:
    """``key, status, labels, display, flags`` of every text.

    Statuses: missing, unknown, unmapped, mapped_single, mapped_multiple, foreign, remote, nationwide
    (a later one overrides). ``display``: the labels joined by '; ', or the status. Spelling without
    accents is known; misspelt names are not (they are the mapper's task). Other columns are ignored.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = lru_cache(1 << 16)(Places(names).classify)
        for batch in batches:
            got = [find(t) for t in batch.column(1).to_pylist()]
            lists = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], lists), pa.array(["; ".join(g[1]) or g[0] for g in got], pa.string()), pa.array([g[2] for g in got], lists)],
                names=[key, "status", "labels", "display", "flags"],
            )

    return df.select(key, df[text].cast("string")).mapInArrow(run, f"`{key}` {kind}, status string, labels array<string>, display string, flags array<string>")
