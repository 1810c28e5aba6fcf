"""Token ids of a whole corpus with a public tokenizer.

A text longer than a leaf is halved recursively; the halves are encoded on their own and joined
like elements of a monoid: a window round the seam is encoded again and grows until it starts and
ends at a place where a new piece starts in every context (white space after something else), so
that all tokens outside the window provably stay as they were. Decoding concatenates up the tree.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Texts of at most so many characters are encoded in one go.
LEAF = 4096
#: Characters on each side of a seam that are tried first.
WINDOW = 32


@lru_cache(4)
def load(path: str | None = None):
    """The byte-level tokenizer of a rank file, and the number of bytes of each token."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, i in ranks.items():
        sizes[i] = len(token)
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes


class TreeEncoder:
    def __init__(self, path: str | None = None, leaf: int = LEAF, window: int = WINDOW):
        self.encoding, self.sizes = load(path)
        self.leaf, self.window = max(2, leaf), max(2, window)

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text; null and empty texts have none."""
        if not text:
            return []
        if len(text) <= self.leaf:
            return self.encoding.encode_ordinary(text)
        spans = [(a, min(a + self.leaf, len(text))) for a in range(0, len(text), self.leaf)]
        nodes = [(a, b, ids) for (a, b), ids in zip(spans, self.encoding.encode_ordinary_batch([text[a:b] for a, b in spans], num_threads=1))]
        while len(nodes) > 1:  # one level of the tree after another
            nodes = [self._join(text, *nodes[i : i + 2]) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
        return nodes[0][2]

    def _join(self, text: str, left: tuple, right: tuple) -> tuple:
        (a, seam, x), (_, b, y) = left, right
        w = self.window
        while True:
            p = next((i for i in range(seam - 1, max(a, seam - w), -1) if _starts(text, i)), a if seam - w <= a else None)
            q = next((i for i in range(seam + 1, min(b, seam + w)) if _starts(text, i)), b if seam + w >= b else None)
            if p is not None and q is not None:
                break
            w *= 2
        kept = self._tokens(x[::-1], len(text[p:seam].encode()))
        gone = self._tokens(y, len(text[seam:q].encode()))
        return a, b, x[: len(x) - kept] + self.encoding.encode_ordinary(text[p:q]) + y[gone:]

    def _tokens(self, ids: Sequence[int], size: int) -> int:
        """How many leading ids hold exactly ``size`` bytes."""
        n = 0
        while size > 0:
            size -= int(self.sizes[ids[n]])
            n += 1
        if size:
            raise AssertionError("a token crosses the edge of the window")
        return n

    def decode(self, ids: Sequence[int]) -> str:
        return self.encoding.decode(list(ids))


def _starts(text: str, i: int) -> bool:
    """Whether a piece starts at ``i`` whatever surrounds it: no piece holds white space after another sign."""
    return _white(text[i]) and not _white(text[i - 1])


def _white(c: str) -> bool:
    """White space as the splitting pattern has it; Python also counts the four separators."""
    return c.isspace() and c not in "\x1c\x1d\x1e\x1f"


def encode_column(df: DataFrame, key: str, text: str, ids: str = "ids", path: str | None = None, leaf: int = LEAF) -> DataFrame:
    """``key, ids``: one row per row of ``df``, with the ids of ``text`` without special tokens.

    Null and empty texts give an empty list, blank ones the ids of their white space; texts of any
    length are encoded whole; repeated rows and null keys come out as they are. Other columns are
    ignored.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = TreeEncoder(path, leaf)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                got = _encode_all(tree, part.column(1).to_pylist())
                at = np.concatenate(([0], np.cumsum([len(g) for g in got]))).astype(np.int32)
                flat = np.fromiter((i for g in got for i in g), np.int32, int(at[-1]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(at), pa.array(flat))], names=[key, ids])

    return df.select(key, df[text].cast("string")).mapInArrow(run, f"`{key}` {kind}, `{ids}` array<int>")


def count_tokens(df: DataFrame, text: str, out: str = "n_tokens", path: str | None = None, leaf: int = LEAF) -> DataFrame:
    """``df`` with the number of tokens in place of ``text``; 0 for null and empty texts."""
    kept = [c for c in df.columns if c not in (text, out)]
    picked = df.select(*kept, df[text].cast("string").alias("__text"))
    schema = picked.drop("__text").schema.add(out, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = TreeEncoder(path, leaf)
        for batch in batches:
            sizes = []
            for start in range(0, batch.num_rows, 500):
                sizes += [len(x) for x in _encode_all(tree, batch.column(len(kept)).slice(start, 500).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes, pa.int64())], names=[*kept, out])

    return picked.mapInArrow(run, schema)


def _encode_all(tree: TreeEncoder, texts: list[str | None]) -> list[list[int]]:
    """Short texts in one call, long ones up their trees."""
    got = tree.encoding.encode_ordinary_batch([t if t and len(t) <= tree.leaf else "" for t in texts], num_threads=1)
    return [tree.encode(t) if t and len(t) > tree.leaf else g for t, g in zip(texts, got)]
