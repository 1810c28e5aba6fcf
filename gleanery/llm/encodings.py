"""Text garbled by a wrong decoding: found by a trained classifier, restored by inverting the chain.

Clean sentences of the corpus are garbled through every known chain of encodings; a multinomial
classifier on hashed byte bigrams of words learns which chain made a word. In a document each
word that carries signs beyond ASCII is classified, the predicted chain is inverted, and only a
strict decoding counts as restored. Only the weights come from a sample; which words are known
is read from the clean sentences of all documents.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How many documents the classifier is trained on, at most; everything else covers all rows.
TRAIN_DOCUMENTS = 3000
#: Buckets of hashed byte bigrams.
BUCKETS = 1 << 14
#: Log-odds against "clean" that a word needs: one that decodes strictly, and one that does not.
SURE, VERY_SURE = 1.5, 9.0

# The letters of a single-byte Vietnamese encoding (TCVN 5712, set 3) as Latin-1 shows them.
TCVN_SHOWN = "µ¸¶·¹¨»¾¼½Æ©ÇÊÈÉË®ÌÐÎÏÑªÒÕÓÔÖ×ÝØÜÞßãáâä«åèæçé¬êíëìîïóñòô\xadõøö÷ùúýûüþ¡¢§£¤¥¦"
TCVN_MEANT = "àáảãạăằắẳẵặâầấẩẫậđèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵĂÂĐÊÔƠƯ"
_TO_TCVN = dict(zip(TCVN_MEANT, TCVN_SHOWN)) | {c.upper(): s for c, s in zip(TCVN_MEANT[:67], TCVN_SHOWN) if c.upper() not in TCVN_MEANT}
_FROM_TCVN = dict(zip(TCVN_SHOWN, TCVN_MEANT))
_LEGACY_SIGN = re.compile(r"(?<=[A-Za-z])[µ¸¶¹¨»¾¼½©®ª«¬\xad§¦÷×ÆÇÈÉËÌÎÏÐÑÒÓÔÕÖØÜÝÞß]|[®¸µ¶¹](?=[a-z])")
_WORD = re.compile(r"[^ \n\r\t]+")
_SIGNS = frozenset(map(chr, range(128, 256)))  # all that _LEGACY_SIGN can match
_LETTERS = re.compile(r"[^\W\d_]+")


def _misread(codec: str) -> tuple[Callable[[str], str], Callable[[str], str]]:
    """UTF-8 bytes read in ``codec``, bytes it lacks as control signs; and the strict way back."""
    back = bytes_in(codec)
    table = {b: c for c, b in back.items()}

    def forth(text: str) -> str:
        return "".join(table[b] for b in text.encode())

    def inverse(text: str) -> str:
        return bytes(back[c] if c in back else _fail(c) for c in text).decode("utf-8")

    return forth, inverse


@lru_cache(32)
def bytes_in(codec: str) -> dict[str, int]:
    """The byte of each sign of a single-byte encoding, control signs for the bytes it lacks."""
    out = {}
    for b in range(256):
        try:
            out[bytes([b]).decode(codec)] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
    return out


def _fail(c: str) -> int:
    raise UnicodeError(f"{c!r} does not stand in this encoding")


def _from_tcvn(text: str) -> str:
    if any(ord(c) > 127 and c not in _FROM_TCVN for c in text):
        raise UnicodeError("no letter of this encoding")
    return "".join(_FROM_TCVN.get(c, c) for c in text)


@lru_cache(1)
def chains() -> dict[str, tuple[Callable[[str], str], Callable[[str], str]]]:
    """Every chain: how it garbles and how it is undone; undoing raises UnicodeError if it cannot."""
    single = {c: _misread(c) for c in ("cp1252", "latin-1", "cp1251", "mac-roman", "cp437", "cp850", "cp1258", "cp1250", "koi8-r", "cp866")}
    both = {}
    for a in ("cp1252", "latin-1"):
        for b in ("cp1252", "latin-1"):
            both[f"{a}+{b}"] = (lambda t, a=a, b=b: single[b][0](single[a][0](t)), lambda t, a=a, b=b: single[a][1](single[b][1](t)))
    tcvn = (lambda t: "".join(_TO_TCVN.get(c, c) for c in unicodedata.normalize("NFC", t)), _from_tcvn)
    return single | both | {"tcvn3": tcvn}


#: The class of words that lost signs: each lost byte or letter stands as U+FFFD.
LOST = "lost"


def lose(word: str) -> list[str]:
    """A word as readers leave it that replace what they cannot decode: by letter, and by byte."""
    return ["".join(c if c.isascii() else "\ufffd" for c in word), word.encode().decode("ascii", "replace")]


def undo(word: str, chain: str) -> str | None:
    """The word before the chain, if it decodes strictly to something else that can be shown."""
    try:
        got = chains()[chain][1](word)
    except (UnicodeError, KeyError):
        return None
    if got == word or any(unicodedata.category(c) in ("Cc", "Cn", "Co", "Cs") for c in got) or "�" in got:
        return None
    letters = [c for c in got if c.isalpha()]
    if any(c.isascii() for c in letters) and not all(c.isascii() or unicodedata.name(c, "").startswith("LATIN") for c in letters):
        return None  # no word mixes scripts: an accident, as with an apostrophe before an accented letter
    return got


def _features(word: str) -> np.ndarray:
    b = np.frombuffer(b"\x02" + word.encode("utf-8", "replace") + b"\x03", np.uint8).astype(np.uint32)
    return ((b[:-1] * 256 + b[1:]) * np.uint32(2654435761) >> np.uint32(18)) % BUCKETS


@dataclass(frozen=True)
class Classifier:
    names: tuple[str, ...]
    weights: np.ndarray  # classes x buckets, log probabilities; the first class is "clean"
    lexicon: dict[str, int] = field(default_factory=dict)  # letter runs of clean words and how often they stand

    def scores(self, word: str) -> np.ndarray:
        return self.weights[:, _features(word)].sum(axis=1)


def looks_clean(sentence: str, beyond: Sequence[str] | None = None) -> bool:
    """Whether a sentence may serve as a clean example: no word of it can be undone, no lost signs."""
    if "�" in sentence or not _SIGNS.isdisjoint(sentence) and len(_LEGACY_SIGN.findall(sentence)) > 1:
        return False
    return not any(map(_undoable, words_beyond(sentence) if beyond is None else beyond))


def words_beyond(text: str) -> list[str]:
    """The words of a text that are not plain ASCII."""
    return [w for w in text.replace("\n", " ").replace("\r", " ").replace("\t", " ").split(" ") if not w.isascii()]


@lru_cache(1 << 16)
def _undoable(word: str) -> bool:
    return any(undo(word, c) for c in chains() if c != "tcvn3")


def holds_pieces(word: str, chain: str) -> bool:
    """Whether a word that does not decode strictly still shows how UTF-8 looks through the chain:
    a leading byte with at least one byte of its own, and no byte that belongs to nothing."""
    if chain == "tcvn3" or "+" in chain or not any(c.isalpha() for c in word):
        return False
    back = bytes_in(chain)
    kinds = "".join("a" if ord(c) < 128 else "?" if c not in back else "c" if 0x80 <= back[c] < 0xC0 else "L" if 0xC2 <= back[c] < 0xF5 else "?" for c in word)
    return re.fullmatch(r"(?:a|Lc{0,3})*", kinds) is not None and "Lc" in kinds


def train(texts: Sequence[str], smoothing: float = 0.02) -> Classifier:
    """A multinomial classifier from clean sentences of ``texts`` and their garbled forms."""
    names = ("clean", *chains(), LOST)
    counts = np.full((len(names), BUCKETS), smoothing)
    seen: dict[str, int] = {}
    for text in texts:
        for w in clean_words(text):
            seen[w] = seen.get(w, 0) + 1
    for w, n in seen.items():
        weight = 1 + np.log(n)
        np.add.at(counts[0], _features(w), weight)
        for k, name in enumerate(names[1:], 1):
            for g in lose(w) if name == LOST else [chains()[name][0](w)]:
                for part in _WORD.findall(g) if g != w else ():  # a chain may put white space into a word
                    if not part.isascii():
                        np.add.at(counts[k], _features(part), weight)
    weights = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
    runs: Counter[str] = Counter()
    for w, n in seen.items():
        for r in _runs(w):
            runs[r] += n
    return Classifier(names, weights, dict(runs))


def clean_words(text: str) -> Iterator[str]:
    """The words beyond ASCII of the clean sentences of a text."""
    for sentence in re.split(r"(?<=[.!?])\s+|\n+", text):
        if not sentence.isascii() and looks_clean(sentence, beyond := words_beyond(sentence)):
            yield from beyond


@lru_cache(1 << 16)
def _runs(word: str) -> tuple[str, ...]:
    """The letter runs of a word that are not plain ASCII, composed, in lower case."""
    return tuple(r.lower() for r in _LETTERS.findall(unicodedata.normalize("NFC", word)) if not r.isascii())


@lru_cache(1 << 16)
def _legacy(word: str) -> str | None:
    """The word read in the single-byte Vietnamese encoding, if it may stand in it."""
    got = undo(word, "tcvn3")
    if got is None or word.isupper() and not got.isupper() or not re.search("[A-Za-z]", word):
        return None  # capitals and lone signs stand in clean text too
    return got


class Restorer:
    """Judges words with a memory, and documents by their words."""

    def __init__(self, classifier: Classifier):
        self.classifier = classifier
        self.judge = lru_cache(1 << 17)(self._judge)

    def known(self, word: str, restored: str) -> bool:
        """Whether clean sentences hold all letter runs of the restored word, and none of them less
        often than the word as it is written: a common word may read as a rare one by accident."""
        often = self.classifier.lexicon.get
        written = max((often(r, 0) for r in _runs(word)), default=0)
        return min((often(r, 0) for r in _runs(restored)), default=0) >= max(written, 1)

    def _judge(self, word: str) -> tuple[str, str | None, float]:
        """(class or '', the restored word if any, log-odds against clean).

        The most likely class that the word can have come from: a chain that does not invert strictly
        cannot have made it, and a word without U+FFFD has lost nothing.
        """
        s = self.classifier.scores(word)
        odds = s - s[0]
        order = np.argsort(-odds)
        top = float(odds[order[0]])
        for k in order:
            if odds[k] < SURE or k == 0:
                break
            name = self.classifier.names[k]
            if name == LOST:
                if "\ufffd" in word:
                    return LOST, None, float(odds[k])
                continue
            got = _legacy(word) if name == "tcvn3" else undo(word, name)
            if got is None:
                continue
            if name == "tcvn3" and not self.known(word, got):
                continue  # every text decodes strictly here: only known words count
            return name, got, float(odds[k])
        for k in order:
            if odds[k] >= VERY_SURE and self.classifier.names[k] != LOST and holds_pieces(word, self.classifier.names[k]):
                return self.classifier.names[k], None, float(odds[k])
        return "", None, top

    def restore(self, text: str | None) -> tuple[bool, bool, str | None, str | None]:
        """(garbled, wholly restored, restored text, main chain); null and ASCII texts are clean."""
        if not text or text.isascii():
            return False, False, text, None
        hits = [(m.start(), m.end(), *self.judge(m[0])) for m in _WORD.finditer(text) if not m[0].isascii()]
        hits = [h for h in hits if h[2]]
        sure = [h for h in hits if h[3] is not None and h[2] != "tcvn3" or h[2] == LOST]
        legacy = [h for h in hits if h[2] == "tcvn3" and h[3] is not None]
        rest = [h for h in hits if h[3] is None and h[2] != LOST]
        found = bool(sure or len(legacy) >= 2 or any(h[4] >= VERY_SURE for h in legacy) or rest)
        if not found:
            return False, False, text, None
        if len(legacy) >= 2:  # the other words of a sentence in a single-byte encoding
            for m in re.finditer(r"(?:[^.!?\n]|[.!?](?!\s))+", text):
                own = [h for h in hits if m.start() <= h[0] < m.end()]
                if len(own) >= 2 and all(h[2] == "tcvn3" for h in own):
                    hits += [(w.start(), w.end(), "tcvn3", got, 0.0) for w in _WORD.finditer(text, *m.span()) if (got := undo(w[0], "tcvn3")) and w.start() not in {h[0] for h in own}]
            hits.sort()
        out, at, whole = [], 0, True
        for start, end, _, got, _ in hits:
            out += [text[at:start], got if got is not None else text[start:end]]
            at, whole = end, whole and got is not None
        out.append(text[at:])
        names = [h[2] for h in hits]
        return True, whole, "".join(out), max(sorted(set(names)), key=names.count)


def known_runs(docs: DataFrame, text: str, classifier: Classifier) -> DataFrame:
    """``run, n``: how often the letter runs stand in clean sentences of the documents that some
    word holds, as written or restored, which the classifier takes for the single-byte Vietnamese
    encoding. Only of such words is it asked whether they are known, so the garbled vocabulary
    bounds the result and not the whole one."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        at = model.names.index("tcvn3")

        @lru_cache(1 << 17)
        def asks(word: str) -> tuple[str, ...]:
            got = _legacy(word)
            if got is None:
                return ()
            s = model.scores(word)
            return (*_runs(word), *_runs(got)) if s[at] - s[0] >= SURE else ()

        for batch in batches:
            stood, wanted, clean = Counter(), set(), Counter()
            for t in batch.column(0).to_pylist():
                if t and not t.isascii():
                    stood.update(clean_words(t))
                    wanted.update(words_beyond(t))
            for w, n in stood.items():
                for r in _runs(w):
                    clean[r] += n
            asked = {r for w in wanted for r in asks(w)}
            runs = list(clean.keys() | asked)
            yield pa.RecordBatch.from_arrays([pa.array(runs, pa.string()), pa.array([clean[r] for r in runs], pa.int64()), pa.array([r in asked for r in runs], pa.bool_())], names=["run", "n", "asked"])

    parts = docs.select(docs[text].cast("string")).mapInArrow(run, "run string, n long, asked boolean")
    return parts.groupBy("run").agg(F.sum("n").alias("n"), F.bool_or("asked").alias("asked")).where("asked and n > 0").select("run", "n")


def train_on(docs: DataFrame, key: str, text: str, most: int = TRAIN_DOCUMENTS) -> Classifier:
    """The classifier: its weights from at most ``most`` documents, picked by a hash of their keys,
    its lexicon from all of them."""
    held = docs.where(F.col(text).isNotNull())
    step = max(1, held.count() // most)
    rows = held.where(F.pmod(F.xxhash64(key), F.lit(step)) == 0).select(text).limit(most).collect()
    model = replace(train([r[text] for r in rows]), lexicon={})
    return replace(model, lexicon={r.run: r.n for r in known_runs(docs, text, model).collect()})


def restore_documents(docs: DataFrame, key: str, text: str, classifier: Classifier | None = None) -> DataFrame:
    """``key, chain, restored_whole, restored``: the documents with at least one garbled stretch.

    Null, empty, blank and ASCII texts are clean; repeated rows are judged alike; texts are read
    whole. ``restored`` holds the text with every stretch that decodes strictly put right,
    ``restored_whole`` says whether no garbled word was left. Other columns are ignored.
    """
    model = classifier or train_on(docs, key, text)
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value)
        for batch in batches:
            got = [(i, *g[1:]) for i, t in enumerate(batch.column(1).to_pylist()) if (g := restorer.restore(t))[0]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array([g[0] for g in got], pa.int64())), pa.array([g[3] for g in got], pa.string()), pa.array([g[1] for g in got], pa.bool_()), pa.array([g[2] for g in got], pa.string())],
                names=[key, "chain", "restored_whole", "restored"],
            )

    return docs.select(key, docs[text].cast("string")).mapInArrow(run, f"`{key}` {kind}, chain string, restored_whole boolean, restored string")
