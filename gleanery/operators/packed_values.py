"""Several values packed in one text field: one row per value, with its position.

The text column is scanned as Arrow string buffers: a running count of quotes gives the parity
at every byte, masks give the delimiters outside quotes and numbers, their positions become the
offsets of a child string array over the same bytes, and the resulting list array is flattened
with its parents' ordinals. Only rows whose quotes are irregular (an inch sign, an unclosed
quote) are read by a small state machine instead.

Separators: ``; ； | tab newline •`` anywhere outside quotes; ``,`` and ``/`` unless between two
digits. Hyphens, plus signs and ampersands never separate. ``["a", "b"]`` is read as a list.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

_MARK = r"(?:[-–—*+•·▪●‣◦]|\(?[0-9]{1,3}[.)])"
_LIST = r"(?s)^\s*\[(\s*(?:\".*\")?\s*)\]\s*$"
_ALWAYS = np.isin(np.arange(256), [ord(c) for c in ";|\n\r\t"])
_DIGIT = np.isin(np.arange(256), [ord(c) for c in "0123456789"])
_SPACE = np.isin(np.arange(256), [ord(c) for c in " \n\r\t"])
_QUOTED = (('"', '"'), ("“", "”"), ("«", "»"))


def split_text(text: str | None) -> list[str]:
    """The values of one text, by a state machine; the reference for the vectorised scan.

    Null, empty and blank texts hold no value. A quote opens only at the start of a value; one
    that never closes before a separator is an ordinary sign.
    """
    if not text or not text.strip():
        return []
    if m := re.match(_LIST, text):
        text = m[1]
    out, start, i, n = [], 0, 0, len(text)
    fresh = True
    while i <= n:
        if i == n:
            out.append(text[start:i])
            break
        c = text[i]
        if fresh and (pair := next((p for p in _QUOTED if c == p[0]), None)):
            if (end := _closing(text, i, pair)) is not None:
                i, fresh = end + 1, False
                continue
        if _separates(text, i):
            out.append(text[start:i])
            start, fresh = i + 1, True
        elif not c.isspace():
            fresh = fresh and re.fullmatch(_MARK, text[start : i + 1].strip()) is not None or (
                fresh and re.fullmatch(r"\(?[0-9]{0,3}", text[start : i + 1].strip()) is not None
            )
        i += 1
    return [x for x in map(_tidy, out) if x]


def _separates(text: str, i: int) -> bool:
    c = text[i]
    if c in ";；|\n\r\t•":
        return True
    if c not in ",/":
        return False
    around = text[i - 1 : i] + text[i + 1 : i + 2]
    return not (i > 0 and len(around) == 2 and all(x in "0123456789" for x in around))


def _closing(text: str, i: int, pair: tuple[str, str]) -> int | None:
    """Where the quote opened at ``i`` closes, if a separator or the end follows."""
    j, n = i + 1, len(text)
    while j < n:
        c = text[j]
        if pair[0] == '"' and c == "\\":
            j += 2
            continue
        if c == pair[1]:
            if pair[0] == '"' and text[j + 1 : j + 2] == '"':
                j += 2
                continue
            k = j + 1
            while k < n and text[k] in "  ":
                k += 1
            return j if k == n or _separates(text, k) else None
        j += 1
    return None


def _tidy(item: str) -> str:
    item = item.strip()
    item = re.sub(rf"^{_MARK}(?:\s+|$)", "", item).strip()
    if re.fullmatch(r'"(?:[^"\\]|""|\\.)*"', item, re.S):
        return re.sub(r'""|\\(["\\])', lambda m: m[1] or '"', item[1:-1]).strip()
    for a, b in _QUOTED[1:]:
        if re.fullmatch(f"{a}[^{a}{b}]*{b}", item, re.S):
            return item[1:-1].strip()
    return item


def split_array(texts: pa.Array) -> pa.ListArray:
    """The values of each text as a list array; null and blank texts give empty lists."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    listed = pc.match_substring_regex(texts, _LIST)
    if pc.any(listed).as_py():
        texts = pc.if_else(listed, pc.replace_substring_regex(texts, _LIST, r"\1"), texts)
    n = len(texts)
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int32)
    first, size = int(at[0]), int(at[-1] - at[0])
    if not size:
        return pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, np.int32)), pa.array([], pa.string()))
    at = (at - first).astype(np.int64)
    b = np.frombuffer(texts.buffers()[2], np.uint8)[first : first + size].copy()
    held = np.diff(at)
    starts, ends = at[:-1][held > 0], at[1:][held > 0] - 1

    def shifted(by: int) -> np.ndarray:
        x = np.zeros(size, np.uint8)
        if by < 0:
            x[-by:] = b[:by] if by else b
        elif by < size:
            x[: size - by] = b[by:]
        return x

    before, after, after2 = shifted(-1), shifted(1), shifted(2)
    before[starts], after[ends] = 10, 10

    def row(x: np.ndarray) -> np.ndarray:
        """Running count of ``x`` within its row."""
        run = np.cumsum(x, dtype=np.int32)
        return run - np.repeat(np.concatenate(([0], run))[at[:-1]], held).astype(np.int32)

    e2 = (b == 0xE2) & (after == 0x80)
    up = e2 & (after2 == 0x9C) | (b == 0xC2) & (after == 0xAB)
    down = e2 & (after2 == 0x9D) | (b == 0xC2) & (after == 0xBB)
    depth = row(up) - row(down)
    escaped = (before == 0x5C) & (b == 0x22)
    straight = (b == 0x22) & ~escaped & (depth <= 0)
    parity = row(straight) & 1
    wide = (b == 0xEF) & (after == 0xBC) & (after2 == 0x9B) | e2 & (after2 == 0xA2)
    single = _ALWAYS[b] | ((b == 0x2C) | (b == 0x2F)) & ~(_DIGIT[before] & _DIGIT[after])
    outside = (depth <= 0) & (parity == 0)
    one, three = np.flatnonzero(single & outside), np.flatnonzero(wide & outside)

    # A row is regular if every quote opens after a separator and closes before one, all in balance.
    ended = single.copy()
    ended[np.minimum(np.flatnonzero(wide) + 2, size - 1)] = True
    left = np.zeros(size, bool)
    left[1:] = ended[:-1] | _SPACE[b[:-1]] | (b[:-1] == 0x22)
    left[starts] = True
    right = np.zeros(size, bool)
    right[:-1] = single[1:] | wide[1:] | _SPACE[b[1:]] | (b[1:] == 0x22)
    right[ends] = True
    odd = straight & (parity == 1) & ~left | straight & (parity == 0) & ~right | (depth < 0)
    odd |= up & (depth > 1) | (b == 0x5C) & (after == 0x5C)
    for k in (1, 2):  # typographic quotes: the byte before the opening, the byte after the closing
        odd |= up & (k == 1) & ~left
    wide_close = np.flatnonzero(down & e2)
    odd[wide_close] |= ~right[np.minimum(wide_close + 2, size - 1)]
    slim_close = np.flatnonzero(down & ~e2)
    odd[slim_close] |= ~right[np.minimum(slim_close + 1, size - 1)]
    odd[ends] |= (parity[ends] == 1) | (depth[ends] > 0)
    rough = np.zeros(n, bool)
    rough[np.searchsorted(at[1:], np.flatnonzero(odd), side="right")] = True

    b[one] = 0x20
    for k in range(3):
        b[three + k] = 0x20
    child_at = np.unique(np.concatenate((at, one + 1, three + 3)))
    child = pa.StringArray.from_buffers(len(child_at) - 1, pa.py_buffer(child_at.astype(np.int32)), pa.py_buffer(b))
    child = _tidy_array(child)
    parent = np.searchsorted(at[1:], child_at[:-1], side="right")
    keep = np.asarray(pc.fill_null(pc.greater(pc.binary_length(child), 0), False)) & ~rough[parent]
    child, parent = child.filter(pa.array(keep)), parent[keep]
    if rough.any():
        extra = [(int(r), x) for r in np.flatnonzero(rough) for x in split_text(texts[int(r)].as_py())]
        parent = np.concatenate((parent, np.array([r for r, _ in extra], np.int64)))
        order = np.argsort(parent, kind="stable")
        child = pa.concat_arrays([child, pa.array([x for _, x in extra], pa.string())]).take(pa.array(order))
        parent = parent[order]
    counts = np.bincount(parent, minlength=n)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), child)


def _tidy_array(items: pa.Array) -> pa.Array:
    items = pc.utf8_trim_whitespace(items)
    items = pc.utf8_trim_whitespace(pc.replace_substring_regex(items, rf"^{_MARK}(?:\s+|$)", ""))
    for a, b, body in (('"', '"', r'(?:[^"\\]|""|\\.)*'), ("“", "”", "[^“”]*"), ("«", "»", "[^«»]*")):
        whole = pc.match_substring_regex(items, f"(?s)^{a}{body}{b}$")
        if pc.any(whole).as_py():
            bare = pc.utf8_slice_codeunits(items, 1, -1)
            if a == '"':
                bare = pc.replace_substring_regex(bare, r'""|\\"', '"')
            items = pc.if_else(whole, pc.utf8_trim_whitespace(bare), items)
    return items


def split_packed(df: DataFrame, column: str, keep: Sequence[str], pos: str = "pos", item: str = "item") -> DataFrame:
    """One row per value packed in ``column``: the ``keep`` columns, ``pos`` (from 1) and ``item``.

    Null, empty and blank texts give no row; repeated rows are split each on its own; a value of
    any length stays whole. Columns not named are ignored, whatever their names; a kept column
    named like ``pos`` or ``item`` comes out with ``_in`` appended.
    """
    named = [k if k not in (pos, item) else f"{k}_in" for k in keep]
    picked = df.select(*[df[k].alias(a) for k, a in zip(keep, named)], df[column].alias("__packed"))
    schema = T.StructType([*picked.schema.fields[:-1], T.StructField(pos, T.IntegerType()), T.StructField(item, T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = split_array(batch.column(batch.num_columns - 1))
            parents = pc.list_parent_indices(lists)
            place = np.arange(len(parents)) - np.asarray(lists.offsets)[np.asarray(parents)] + 1
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i).take(parents) for i in range(len(named))], pa.array(place, pa.int32()), lists.flatten()],
                names=[*named, pos, item],
            )

    return picked.mapInArrow(run, schema)
