"""Folding of typed Vietnamese and English text to plain lower-case letters."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from html import unescape


@lru_cache(1 << 16)
def fold(text: str) -> str:
    """Lower case, without accents, entities decoded, white space as single spaces."""
    s = unicodedata.normalize("NFKD", unescape(text)).lower().replace("đ", "d").replace("ð", "d")
    return " ".join("".join(c for c in s if not unicodedata.combining(c)).split())


def uncamel(text: str) -> str:
    """A space wherever a small letter meets a capital one: NamLan -> Nam Lan."""
    out = []
    for i, c in enumerate(text):
        if i and c.isupper() and (text[i - 1].islower() or unicodedata.combining(text[i - 1])):
            out.append(" ")
        out.append(c)
    return "".join(out)


def words(text: str) -> list[str]:
    """The folded runs of letters and digits, glued words split at capitals."""
    return re.findall(r"[^\W_]+", fold(uncamel(unicodedata.normalize("NFC", unescape(text)))))
