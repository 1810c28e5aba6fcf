"""Free-entered values mapped to the closest entry of a reference list.

A multi-pattern automaton over the names and aliases of all entries finds embedded mentions in
the folded value; the longest non-overlapping ones win. What it leaves open goes to similarity:
windows of words against names with few edits, then token sets regardless of order. A list whose
entries are combinations of two parts (role and field) is factored into its parts, and a value
maps to an entry only if it mentions both parts of it.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import product

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.folding import fold, words
from gleanery.llm.minhash import edits, grams

#: Reference lists are held by every task; larger ones are refused.
MOST_ENTRIES = 200_000
# Roles by another word, folded.
ROLE_WORDS = {"nhan vien": ["staff"], "giam sat": ["sup", "supv"]}
# Consonants a syllable opens with that are two or three letters.
_ONSET = re.compile(r"ngh|ng|nh|tr|th|ch|ph|kh|gi|qu|gh|[a-z]")
# What a title opens with when it only says that somebody is wanted, folded.
WANTED = re.compile(r"^\W*(?:tuyen dung\s*:|(?:can |dang )?tuyen(?: gap)?\b(?! dung))\s*:?\s*")


def allowed(length: int) -> int:
    """How many edits a name of so many letters may have."""
    return 0 if length < 4 else 1 if length < 8 else 2 if length < 14 else 3


def short_forms(name: str) -> set[str]:
    """How a name of several words is shortened: each word whole, by its first letter, by its opening
    consonants or by these and its last one, spaced or glued, and a name of three words and more
    without its last."""
    ws = name.split()
    if len(ws) < 2:
        return set()
    opening = [m[0] if (m := _ONSET.match(w)) else w[0] for w in ws]
    choices = [dict.fromkeys((w, w[0], o, o if w[-1] in "aeiouy" else o + w[-1])) for w, o in zip(ws, opening)]
    forms = {joined for pick in product(*choices) for joined in (" ".join(pick), "".join(pick))} - {name}
    return forms | ({" ".join(ws[:-1])} if len(ws) > 2 else set())


class PieceIndex:
    """Finds the names that may be within k edits of a part of a text, by an unharmed piece.

    A name is cut into k + 1 pieces. k edits leave one of them whole, or harmed only by a swap of
    letters across its edge; pieces are filed with these swaps. No name in reach is missed.
    """

    def __init__(self, names: Sequence[tuple[str, int]]):
        filed: dict[str, set[int]] = defaultdict(set)
        for i, (name, most) in enumerate(names):
            cuts = [round(j * len(name) / (most + 1)) for j in range(most + 2)]
            for a, b in zip(cuts, cuts[1:]):
                forms = {name[a:b]}
                if a:
                    forms |= {name[a - 1] + x[1:] for x in forms}
                if b < len(name):
                    forms |= {x[:-1] + name[b] for x in forms}
                for x in forms:
                    filed[x].add(i)
        self.filed = dict(filed)
        self.sizes = sorted({len(x) for x in self.filed})

    def near(self, text: str) -> list[int]:
        out: set[int] = set()
        for n in self.sizes:
            for a in range(len(text) - n + 1):
                out.update(self.filed.get(text[a : a + n], ()))
        return sorted(out)


class WordIndex:
    """Finds the words of which at least four fifths are as in a given word.

    That is a quarter of their letters in edits at most: none below four letters; words of up to
    seven, one edit apart, share a form with one letter left out; longer ones an unharmed piece.
    """

    def __init__(self, words_: Sequence[str]):
        self.words = list(words_)
        self.exact = set(self.words)
        self.lacking: dict[str, list[int]] = defaultdict(list)
        for i, w in enumerate(self.words):
            for form in self._forms(w) if 4 <= len(w) < 8 else ():
                self.lacking[form].append(i)
        self.long = [w for w in self.words if len(w) >= 8]
        self.pieces = PieceIndex([(w, len(w) // 4) for w in self.long])

    @staticmethod
    def _forms(w: str) -> set[str]:
        return {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}

    def near(self, word: str) -> set[str]:
        found = {self.words[i] for form in self._forms(word) for i in self.lacking.get(form, ())}
        if len(word) >= 6:
            found.update(self.long[i] for i in self.pieces.near(word))
        return {w for w in found if edits(w, word, 3) <= 0.2 * max(len(w), len(word))} | ({word} & self.exact)


class Mapper:
    """entries: (id, names, code). ``find(value)`` gives the id meant, or 0.

    The time for a value depends on the names that share rare bigrams or words with it, not on the
    length of the list.
    """

    def __init__(self, entries: Iterable[tuple[int, Sequence[str], str | None]], parts: bool = False, aliases: dict[str, list[str]] | None = None):
        self.codes: dict[str, int] = {}
        self.short: set[str] = set()  # only ever matched exactly
        self.names: dict[int, dict[str, int]] = defaultdict(dict)  # part number -> name -> part id
        self.entry: dict[tuple[int, ...], int] = {}
        entries = list(entries)
        if parts:
            self._factor(entries, aliases or {})
        else:
            for i, names, code in entries:
                for n in names:
                    self.names[0][" ".join(words(n))] = i
                self.entry[(i,)] = i
                if code:
                    self.codes[code.lower()] = i
        self.automata, self.fuzzy, self.pieces, self.several, self.holding, self.words = ({} for _ in range(6))
        for k, names in self.names.items():
            a = ahocorasick.Automaton()
            for n, i in names.items():
                if n:
                    a.add_word(f" {n} ", (len(n), i))
            a.make_automaton()
            self.automata[k] = a
            self.fuzzy[k] = [(g, frozenset(grams(g, 2)), i, len(n.split())) for n, i in names.items() if n not in self.short and len(g := n.replace(" ", "")) >= 4]
            self.pieces[k] = PieceIndex([(name, allowed(len(name)) + (len(name) == 7)) for name, _, _, _ in self.fuzzy[k]])
            self.several[k] = [(n.split(), i) for n, i in names.items() if n not in self.short and len(n.split()) > 1]
            spelled: dict[str, list[int]] = defaultdict(list)
            for at, (ws, _) in enumerate(self.several[k]):
                for w in dict.fromkeys(ws):
                    spelled[w].append(at)
            self.holding[k] = spelled
            self.words[k] = WordIndex(list(spelled))

    def _factor(self, entries: list, aliases: dict[str, list[str]]) -> None:
        """Each label is cut in two so that both halves recur in other labels as often as they can."""
        splits = []
        for i, names, _ in entries:
            for lang, n in enumerate(names):
                ws = words(n)
                splits += [(i, lang, " ".join(ws[:k]), " ".join(ws[k:])) for k in range(1, len(ws))]
        heads, tails = Counter((x[1], x[2]) for x in splits), Counter((x[1], x[3]) for x in splits)
        best: dict[tuple[int, int], tuple] = {}
        for i, lang, h, t in splits:
            score = (min(heads[lang, h], tails[lang, t]), heads[lang, h] * tails[lang, t])
            if (i, lang) not in best or score > best[i, lang][0]:
                best[i, lang] = (score, h, t)
        # In the first language the half with fewer different values is the role; in the others it is
        # the half that goes with the same roles.
        def spread(lang: int, half: int, along: dict[int, str] | None) -> int:
            return len({(along.get(i) if along else None, b[half]) for (i, g), b in best.items() if g == lang})

        langs = sorted({g for _, g in best})
        head_is_role: dict[int, bool] = {}
        roles: dict[int, str] | None = None
        for lang in langs:
            head_is_role[lang] = spread(lang, 1, roles) <= spread(lang, 2, roles)
            if roles is None:
                roles = {i: b[1 if head_is_role[lang] else 2] for (i, g), b in best.items() if g == lang}
        role_of: dict[str, int] = {}
        field_of: dict[str, int] = {}
        for i, names, _ in entries:
            pair = {}
            for lang in range(len(names)):
                if (i, lang) in best:
                    _, h, t = best[i, lang]
                    pair[lang] = (h, t) if head_is_role[lang] else (t, h)
            if not pair:
                continue
            r = next((role_of[p[0]] for p in pair.values() if p[0] in role_of), i)
            f = next((field_of[p[1]] for p in pair.values() if p[1] in field_of), i)
            for p in pair.values():
                role_of.setdefault(p[0], r)
                field_of.setdefault(p[1], f)
            self.entry[r, f] = i
        forms: dict[str, set[int]] = defaultdict(set)
        for name, r in role_of.items():
            for s in (*short_forms(name), *aliases.get(name, ())):
                forms[s].add(r)
        taken = {w for n in field_of for w in (n, *n.split())}
        for s, of in forms.items():
            if len(of) == 1 and len(s) > 1 and s not in role_of and s not in taken:
                role_of[s] = min(of)
                self.short.add(s)
        self.names[0], self.names[1] = role_of, field_of

    def find(self, value: str | None) -> int:
        """0 for null, blank and unknown values."""
        if value is None or not value.strip():
            return 0
        text = value
        if len(self.names) > 1:
            text = WANTED.sub("", fold(text))
        ws = words(text)
        if not ws:
            return 0
        if len(ws) == 1 and ws[0] in self.codes:
            return self.codes[ws[0]]
        hits = []
        free = [True] * len(ws)
        for k in sorted(self.names):
            hits.append(self._exact(k, ws, free))
        for k in sorted(self.names):
            if not hits[k]:
                hits[k] = self._close(k, ws, free)
        if not all(hits):
            return 0
        return self.entry.get(tuple(hits), 0)

    def _exact(self, k: int, ws: list[str], free: list[bool]) -> int:
        line = " " + " ".join(ws) + " "
        best = None
        for end, (n, i) in self.automata[k].iter(line):
            start = end - n - 1
            first = line.count(" ", 0, start + 1) - 1
            last = first + line.count(" ", start + 1, end)
            if all(free[first : last + 1]) and (best is None or n > best[0] or n == best[0] and start < best[1]):
                best = (n, start, first, last, i)
        if not best:
            return 0
        free[best[2] : best[3] + 1] = [False] * (best[3] + 1 - best[2])
        return best[4]

    def _close(self, k: int, ws: list[str], free: list[bool]) -> int:
        runs, run = [], []
        for w, f in zip([*ws, ""], [*free, False]):
            if f:
                run.append(w)
            elif run:
                runs.append(run)
                run = []
        best: tuple | None = None
        tied = False
        for run in runs:
            all_grams = grams("".join(run), 2)
            for w in run:
                all_grams |= grams(w, 2)
            for name, g, i, n in map(self.fuzzy[k].__getitem__, self.pieces[k].near("".join(run))):
                most = allowed(len(name)) + (len(name) == 7 and len(ws) <= n + 1)  # a short name alone may have one more
                if not most or len(g & all_grams) < len(g) - 3 * most:
                    continue
                for a in range(len(run)):
                    for m in {n, n - 1, n + 1, 1}:
                        if 0 < m <= len(run) - a:
                            d = edits("".join(run[a : a + m]), name, most)
                            if d <= most:
                                score = (d / len(name), -len(name))
                                if best is None or score < best[0]:
                                    tied, best = False, (score, i)
                                elif score == best[0] and i != best[1]:
                                    tied = True
        if best:
            return 0 if tied else best[1]
        return self._tokens(k, [w for r in runs for w in r])

    def _tokens(self, k: int, ws: list[str]) -> int:
        """Token-set similarity: every word of the name close to a word of its own, in any order.

        A name is this similar only if one of its words is, so only those that hold such a word are compared.
        """
        best, second = (0.0, 0), 0.0
        near: set[int] = set()
        for w in dict.fromkeys(ws):
            near.update(at for x in self.words[k].near(w) for at in self.holding[k].get(x, ()))
        for parts, i in map(self.several[k].__getitem__, sorted(near)):
            if len(ws) < len(parts):
                continue
            left, total = list(ws), 0.0
            for p in parts:
                w = min(left, key=lambda x: edits(p, x, 3))
                total += len(p) * max(0.0, 1 - edits(p, w, 3) / max(len(p), len(w)))
                left.remove(w)
            s = total / sum(map(len, parts))
            if s > best[0]:
                second, best = (best[0] if best[1] != i else second), (s, i)
            elif i != best[1]:
                second = max(second, s)
        return best[1] if best[0] >= 0.8 and best[0] > second else 0


def entries_of(refs: DataFrame, field: str, key: str = "ref_id", group: str = "field_name", names: Sequence[str] = ("label_vi", "label_en"), code: str = "ref_code") -> list[tuple[int, list[str], str | None]]:
    """The entries of one field of a reference list, at most ``MOST_ENTRIES``."""
    rows = refs.where(F.col(group) == field).select(key, *names, code).limit(MOST_ENTRIES + 1).collect()
    if len(rows) > MOST_ENTRIES:
        raise ValueError(f"a reference list may have {MOST_ENTRIES} entries")
    return sorted((r[key], [r[n] for n in names if r[n] and r[n].strip()], r[code]) for r in rows)


def map_values(df: DataFrame, value: str, entries: list, parts: bool = False, out: str = "ref_id", aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """``df`` with ``out``: the id of the entry each value means, 0 where the list has none.

    Null and blank values and an empty list give 0; equal values get equal ids; names the list has
    for two entries go to the smaller id. Other columns pass through; one already named ``out``
    is replaced.
    """
    base = df.drop(out)
    columns = base.columns
    at = columns.index(value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapper = Mapper(entries, parts, aliases)
        find = lru_cache(1 << 17)(mapper.find)
        for batch in batches:
            coded = batch.column(at).cast(pa.string()).dictionary_encode()
            ids = pa.array([find(v) for v in coded.dictionary.to_pylist()], pa.int64())
            got = pc.fill_null(ids.take(coded.indices), 0) if len(ids) else pa.array([0] * batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*columns, out])

    return base.mapInArrow(run, base.select("*", F.lit(0).cast("long").alias(out)).schema)


def not_blank(c: Column) -> Column:
    return c.isNotNull() & (F.regexp_replace(c, r"(?U)\s+", "") != "")
