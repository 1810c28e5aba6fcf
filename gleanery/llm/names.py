"""Variant spellings of organisation names.

Names are reduced to their proper part and stated line of business, equal parts are collapsed,
candidates come from MinHash banding over padded q-grams (number of bands from the collision
curve), candidates are verified by Monge-Elkan similarity over edit similarity, and the verified
graph is clustered into stars round the best attested spelling.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache, reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.folding import words
from gleanery.llm.minhash import Banding, bands_for, edits, grams
from gleanery.session import cut, keep, small

# Words of legal forms and what may trail a name, folded, without spaces.
LEGAL = (
    "congty cty ct ctcp congtycp congtytnhh ctytnhh ctycp cpty tnhh mtv tnhhmtv trachnhiemhuuhan cophan cp "
    "motthanhvien coltd co ltd limited limitedcompany jsc corp corporation inc llc company jointstock jointstockcompany "
    "group vn vietnam viet nhom tapdoan jvc plc pte"
).split()
# Spellings of lines of business, folded, without spaces.
BUSINESS = {
    "trade_service": "thuongmaidichvu thuongmaivadichvu tmdv thuongmaidv tmdichvu tmvadv tradingservice tradingservices tradeservice tradingandservice tradingandservices dichvuthuongmai dvtm thmdv",
    "make_trade": "sanxuatthuongmai sanxuatvathuongmai sxtm sanxuattm sxthuongmai sxvatm manufacturingtrading manufacturingandtrading productiontrading thuongmaisanxuat tmsx",
    "invest_develop": "dautuphattrien dautuvaphattrien dtpt dautupt dtphattrien dtvapt investmentdevelopment investmentanddevelopment developmentinvestment investdevelopment",
    "travel": "dulich dl travel tourism tourist dlich",
    "construction": "xaydung xd xdung construction constructions building",
    "education": "giaoduc gd education giaod gduc",
    "furniture": "noithat nt furniture nthat interior interiors",
    "pharma": "duocpham dp pharma pharmaceutical pharmaceuticals duoc dpham",
    "technology": "congnghe cn cnghe technology tech technologies cngh",
    "real_estate": "batdongsan bds realestate realty bdsan",
    "food": "thucpham tp tpham food foods foodstuff",
    "logistics": "logistics logistic logis hauccan haucan",
}
# What stands in a name field where no name was given, folded, without spaces.
PLACEHOLDERS = set(
    "dangcapnhat chuacapnhat capnhatsau andanh baomat baomatthongtin congtybaomat congtyandanh khong khongco khongro chuaro chuaxacdinh "
    "na none null nan unknown confidential anonymous test congty doanhnghiep nhatuyendung tuyendung tencongty dangcapnhap xemmota xemtrongmota "
    "khonghienthi congtyan an khac other khongxacdinh updating tbd thongtinbaomat nhatuyendungandanh".split()
)
_BUSINESS = {alias: line for line, aliases in BUSINESS.items() for alias in aliases.split()}
_LEGAL = set(LEGAL)
_HEADS, _TAILS = ({k: [a for a in _BUSINESS if len(a) >= 7 and f(a) == k] for k in map(f, _BUSINESS)} for f in (lambda a: a[:3], lambda a: a[-3:]))
_LONGEST = 5
#: Proper parts this similar may be one: an edit in six letters.
SIMILARITY = 0.83
#: With their words in another order they must be this similar.
MOVED = 0.9
#: Values of one band that meet in one task.
BAND = 500
#: A word that sound names hold this many times less often than the word it is held against is no regular word.
RARER = 10


@lru_cache(1 << 16)
def parse_name(name: str) -> tuple[str, str] | None:
    """(proper part as folded words, line of business or ''), None for blanks and placeholders."""
    bare = re.sub(r"\([^()]*\)", " ", name)
    ws = words(bare) or words(name)
    glued = "".join(ws)
    if not glued or glued in PLACEHOLDERS:
        return None
    line = ""
    moved = True
    while moved and len(ws) > 1:
        moved = False
        for n in range(min(_LONGEST, len(ws) - 1), 0, -1):
            for head in (True, False):
                part = "".join(w for w in (ws[:n] if head else ws[-n:]) if w != "va" or n == 1)
                if part in _LEGAL or not line and (found := _BUSINESS.get(part) or _near(part)):
                    if part not in _LEGAL:
                        line = found
                    ws = ws[n:] if head else ws[:-n]
                    moved = True
                    break
            if moved:
                break
    proper = " ".join(ws)
    return None if proper.replace(" ", "") in PLACEHOLDERS | _LEGAL else (proper, line)


@lru_cache(1 << 14)
def _near(part: str) -> str:
    """The line of business one typing error away; only for long spellings."""
    if len(part) < 7:
        return ""
    # One error leaves the first or the last three letters as they are.
    likely = dict.fromkeys([*_HEADS.get(part[:3], ()), *_TAILS.get(part[-3:], ())])
    return next((_BUSINESS[alias] for alias in likely if edits(part, alias, 1) <= 1), "")


#: Words are few and their pairs come again and again.
word_edits = lru_cache(1 << 18)(edits)


@lru_cache(1 << 18)
def alike(a: str, b: str) -> float:
    """Edit similarity of two words."""
    return 1 - edits(a, b, 99) / max(len(a), len(b))


def monge_elkan(a: Sequence[str], b: Sequence[str]) -> float:
    """Monge-Elkan similarity of two word lists over edit similarity, the lesser of both directions;
    words weigh as many letters as they have."""

    def one(x: Sequence[str], y: Sequence[str]) -> float:
        return sum(len(p) * max(alike(p, q) for q in y) for p in x) / sum(map(len, x))

    return min(one(a, b), one(b, a)) if a and b else 0.0


def respace(glued: Sequence[str], like: Sequence[str]) -> list[str]:
    """The letters of ``glued`` cut into as many words as ``like`` has, at the least total edits."""
    s, n = "".join(glued), len(like)
    best: list[dict[int, tuple[int, int]]] = [{0: (0, 0)}]
    for w in like:
        nxt: dict[int, tuple[int, int]] = {}
        for at, (cost, _) in best[-1].items():
            for end in range(max(at, at + len(w) - 2), min(len(s), at + len(w) + 2) + 1):
                c = cost + word_edits(s[at:end], w, 4)
                if end not in nxt or c < nxt[end][0]:
                    nxt[end] = (c, at)
        best.append(nxt)
    if len(s) not in best[-1]:
        return list(glued)
    out, end = [], len(s)
    for k in range(n, 0, -1):
        at = best[k][end][1]
        out.append(s[at:end])
        end = at
    return out[::-1]


def in_order(a: Sequence[str], b: Sequence[str]) -> float:
    """Edit similarity of two word lists word by word, 0 if they have different lengths."""
    if len(a) != len(b):
        return 0.0
    return sum(max(len(p), len(q)) * alike(p, q) for p, q in zip(a, b)) / sum(max(len(p), len(q)) for p, q in zip(a, b))


def same_proper(a: str, b: str, similarity: float = SIMILARITY, moved: float = MOVED) -> tuple[float, bool]:
    """(Monge-Elkan similarity of two proper parts, whether their words stand in another order).

    Words are compared as they are spaced, or with one part spaced like the other where their letters
    in order are as similar as that. The similarity is 0 below ``similarity``, and below ``moved`` if
    the order differs.
    """
    wa, wb = a.split(), b.split()
    forms = [(wa, wb)]
    if len(wa) != len(wb):
        ga, gb = "".join(wa), "".join(wb)
        most = int((1 - similarity + 0.05) * max(len(ga), len(gb)))
        if edits(ga, gb, most) <= most:
            forms.append((respace(wa, wb), wb) if len(wa) < len(wb) else (wa, respace(wb, wa)))
    s, x, y = max((monge_elkan(x, y), x, y) for x, y in forms)
    if s < similarity:
        return 0.0, False
    ordered = in_order(x, y) >= similarity - 0.05
    return (s, False) if ordered else (s if s >= moved else 0.0, True)


def letters(proper: str) -> set[str]:
    """Trigrams of the letters without spaces: the same for glued spellings."""
    return grams(proper.replace(" ", ""), 3)


def word_letters(proper: str) -> set[str]:
    """Bigrams of each word: the same in any order of words."""
    return set().union(*(grams(w, 2) for w in proper.split()))


#: The least Jaccard similarity of two sound spellings by letters is about 0.4 (two edits in twelve
#: letters), that of reordered words with an error in twelve letters 0.75.
BANDINGS = ((letters, bands_for(0.4, 0.92, 4), 4), (word_letters, bands_for(0.75, 0.95, 8), 8))


def candidate_pairs(keys: DataFrame, column: str, bandings: Sequence[tuple], block=None) -> DataFrame:
    """Pairs ``a < b`` of distinct values of ``column`` that share a band; each pair once.

    ``bandings``: (shingler, bands, rows) each. ``block(value)`` names tokens that must be equal
    besides; they become part of each band's key. A band of more than ``BAND`` values is cut into
    squares of at most that many on each side, which meet in tasks of their own: none is dropped.
    """
    each = sum(bands for _, bands, _ in bandings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = [(shingler, Banding(bands, rows, seed)) for seed, (shingler, bands, rows) in enumerate(bandings, 7)]
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                values = batch.column(0).slice(start, 500)
                texts = values.to_pylist()
                ks = np.concatenate([banding.keys_of([shingler(v) for v in texts]) for shingler, banding in made], axis=1)
                if block:
                    ks ^= np.array([_token_hash(block(v)) for v in texts])[:, None]
                yield pa.RecordBatch.from_arrays([values.take(pa.array(np.repeat(np.arange(len(texts)), each))), pa.array(ks.ravel())], names=["v", "band"])

    # Hashing and verifying cost far more than their bytes tell, so both get a fixed number of tasks.
    tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    banded = keys.select(F.col(column).alias("v")).repartition(tasks, "v").mapInArrow(run, "v string, band long")
    met = keep(banded)
    shared = met.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band", F.ceil(F.col("n") / BAND).cast("int").alias("m"))
    placed = met.join(shared, "band").withColumn("x", F.pmod(F.xxhash64("v"), F.col("m")).cast("int"))
    whole = F.sequence(F.lit(0), F.col("m") - 1)
    a = placed.select("band", F.col("v").alias("a"), "x", F.explode(F.slice(whole, F.col("x") + 1, F.col("m"))).alias("y"))
    b = placed.select("band", F.col("v").alias("b"), F.col("x").alias("y"), F.explode(F.slice(whole, F.lit(1), F.col("x") + 1)).alias("x"))
    pairs = a.join(b, ["band", "x", "y"]).where((F.col("a") < F.col("b")) | (F.col("x") < F.col("y")))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).repartition(tasks, "a", "b").distinct()


def _token_hash(token: str) -> np.int64:
    return np.int64(int.from_bytes(blake2b(token.encode(), digest_size=8).digest(), "big", signed=True))


def _verified(pairs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            got = [same_proper(a, b) for a, b in both]
            keep_ = pa.array([s > 0 for s, _ in got], pa.bool_())
            both, got = [x for x, g in zip(both, got) if g[0] > 0], [g for g in got if g[0] > 0]
            counted = [(Counter(a.split()), Counter(b.split())) for a, b in both]
            own = [pa.array([list(x[i] - x[1 - i]) for x in counted], pa.list_(pa.string())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(keep_), batch.column(1).filter(keep_), pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.bool_()), *own], names=["a", "b", "sim", "moved", "own_a", "own_b"]
            )

    return pairs.mapInArrow(run, "a string, b string, sim double, moved boolean, own_a array<string>, own_b array<string>")


def agreed(edges: DataFrame, keys: DataFrame) -> DataFrame:
    """The edges without those between parts in another word order that do not state the same lines
    of business: names are made of few words, and another order alone is often another name."""
    lines = keys.select("proper", "lines")
    moved = edges.where("moved").join(lines.select(F.col("proper").alias("a"), F.col("lines").alias("la")), "a").join(lines.select(F.col("proper").alias("b"), F.col("lines").alias("lb")), "b")
    return edges.where("not moved").unionByName(moved.where(F.col("la") == F.col("lb")).select(*edges.columns))


def unlike(edges: DataFrame, nodes: DataFrame, rank: Column) -> DataFrame:
    """``a, b``: the edges between two names that differ in regular words only, so no typing errors.

    edges(a, b, own_a, own_b), own_a and own_b the words that only a or b holds; nodes(node, ...).
    A name questions those of its words that a neighbour ranked above it lacks. A word is regular
    for an edge if most of the other names that hold it do not question it: a misspelt word is
    questioned wherever it stands, however often the table repeats it. The odd misspelt word whose
    right form is not in the table stands out by its rarity beside the words it is held against.
    """
    ranked = nodes.select("node", rank.alias("rank"))
    sides = edges.join(ranked.select(F.col("node").alias("a"), F.col("rank").alias("ra")), "a").join(ranked.select(F.col("node").alias("b"), F.col("rank").alias("rb")), "b")
    a_first = F.col("ra").__gt__(F.col("rb")) | (F.col("ra") == F.col("rb")) & (F.col("a") < F.col("b"))
    side = lambda x, above: F.struct(F.col(x).alias("node"), F.col(f"own_{x}").alias("own"), above.alias("above"))
    words_of = cut(sides.select("a", "b", F.explode(F.array(side("a", a_first), side("b", ~a_first))).alias("s")).select("a", "b", "s.node", "s.above", F.explode("s.own").alias("word")))
    questioned = words_of.where("not above").select("node", "word").distinct().withColumn("questioned", F.lit(True))
    held = ranked.select("node", F.explode(F.array_distinct(F.split("node", " "))).alias("word")).join(questioned, ["node", "word"], "left")
    held = cut(held.select("node", "word", F.coalesce("questioned", F.lit(False)).alias("questioned")))
    stats = held.groupBy("word").agg((F.count(F.lit(1)) - 1).alias("others"), F.count_if(~F.col("questioned")).alias("sound"))
    sound = F.col("sound") - F.when(F.col("questioned"), 0).otherwise(1)
    judged = words_of.join(held, ["node", "word"]).join(stats, "word").withColumn("sound", sound).withColumn("regular", 2 * F.col("sound") > F.col("others"))
    even = F.min("sound") * RARER >= F.max("sound")
    return judged.groupBy("a", "b").agg((F.bool_and("regular") & even).alias("unlike")).where("unlike").select("a", "b")


def stars(nodes: DataFrame, edges: DataFrame, rank: Column) -> DataFrame:
    """Star clustering: ``node, center``.

    nodes(node, ...) and edges(a, b, sim), each edge once. In each round every open node that
    outranks its open neighbours becomes a centre, and the open neighbours of centres join the
    most similar one. Every node ends as a centre or next to its centre; a node without edges is
    its own centre. ``rank`` orders nodes (larger first); ties go to the smaller node.
    """
    ranked = nodes.select("node", rank.alias("rank"))
    both = edges.select("a", "b", "sim").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim"))
    linked = both.join(ranked.select(F.col("node").alias("a"), F.col("rank").alias("ra")), "a").join(
        ranked.select(F.col("node").alias("b"), F.col("rank").alias("rb")), "b"
    )
    open_edges = cut(linked.withColumn("a_first", F.col("ra").__gt__(F.col("rb")) | (F.col("ra") == F.col("rb")) & (F.col("a") < F.col("b"))))
    done: list[DataFrame] = []
    while True:
        centers = open_edges.groupBy("a").agg(F.min("a_first").alias("top")).where("top").select("a")
        joined = (
            open_edges.join(centers, "a", "left_semi")
            .groupBy("b")
            .agg(F.max_by("a", F.struct("sim", "ra", "a")).alias("center"))
            .select(F.col("b").alias("node"), "center")
        )
        settled = cut(joined.unionByName(centers.select(F.col("a").alias("node"), F.col("a").alias("center"))))
        if settled.isEmpty():
            break
        done.append(settled)
        gone = settled.select("node")
        open_edges = cut(
            open_edges.join(gone.withColumnRenamed("node", "a"), "a", "left_anti").join(gone.withColumnRenamed("node", "b"), "b", "left_anti")
        )
    if not done:
        return ranked.select("node", F.col("node").alias("center"))
    found = reduce(DataFrame.unionByName, done)
    return ranked.select("node").join(found, "node", "left").select("node", F.coalesce("center", "node").alias("center"))


def link_names(names: DataFrame, column: str = "name", weight: str | None = None) -> DataFrame:
    """Which spellings name the same organisation: ``name, proper, line, company``.

    One row per distinct string that names an organisation; nulls, blanks and placeholders are
    left out. ``company`` is the spelling-independent id: the centre of the proper part's star and
    the line of business. A name without line of business belongs to the one company that has its
    proper part; where several lines share it, it stays with those that state none either.
    Repeated rows count as weight (``weight`` names a column of counts). Other columns are ignored.
    """
    spelled = names.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("name"))
    spelled = spelled.agg((F.sum(weight) if weight else F.count(F.lit(1))).cast("long").alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [parse_name(x) for x in batch.column(0).to_pylist()]
            keep = pa.array([g is not None for g in got])
            kept = [g for g in got if g]
            yield pa.RecordBatch.from_arrays(
                [*(c.filter(keep) for c in batch.columns), pa.array([g[0] for g in kept], pa.string()), pa.array([g[1] for g in kept], pa.string())],
                names=["name", "n", "proper", "line"],
            )

    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # counted first: a hot name is one row
    parsed = cut(spelled.repartition(tasks, "name").mapInArrow(run, "name string, n long, proper string, line string"))
    spaced = parsed.withColumn("key", F.regexp_replace("proper", " ", ""))
    # One spaced form per glued key: the one with most words, so that glued spellings are compared by words.
    keys = cut(
        spaced.groupBy("key").agg(
            F.max_by("proper", F.struct(F.length("proper"), F.col("n"), F.col("proper"))).alias("proper"),
            F.sum("n").alias("n"),
            F.count(F.lit(1)).alias("spellings"),
            F.array_sort(F.collect_set(F.nullif("line", F.lit("")))).alias("lines"),  # of a dozen lines at most
        )
    )
    edges = cut(agreed(cut(_verified(candidate_pairs(keys, "proper", BANDINGS))), keys))
    nodes = keys.withColumnRenamed("proper", "node")
    rank = F.struct("spellings", "n")
    edges = cut(edges.join(unlike(edges, nodes, rank), ["a", "b"], "left_anti").select("a", "b", "sim"))
    star = stars(nodes, edges, rank)
    centre = keys.select("key", "proper").join(star, keys["proper"] == star["node"]).select("key", "center")
    placed = spaced.join(centre, "key")
    lines = placed.where("line <> ''").groupBy("center").agg(F.count_distinct("line").alias("lines"), F.min("line").alias("only_line"))
    return placed.join(lines, "center", "left").select(
        "name",
        "proper",
        "line",
        F.concat_ws("/", "center", F.when((F.col("line") == "") & (F.col("lines") == 1), F.col("only_line")).otherwise(F.col("line"))).alias("company"),
    )


def same_name_pairs(linked: DataFrame) -> DataFrame:
    """Each pair ``name_a < name_b`` (code points) of spellings of one company.

    A company with many spellings is cut into squares of ``BAND`` spellings, so that its pairs are
    made in many tasks.
    """
    blocks = linked.groupBy("company").agg(F.ceil(F.count(F.lit(1)) / BAND).cast("int").alias("m")).where("m > 1")
    placed = linked.select("company", "name").join(small(blocks), "company", "left").withColumn("m", F.coalesce("m", F.lit(1)))
    placed = placed.withColumn("x", F.pmod(F.xxhash64("name"), F.col("m")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("m") - 1))
    a = placed.select("company", F.col("name").alias("name_a"), "x", every.alias("y"))
    b = placed.select("company", F.col("name").alias("name_b"), F.col("x").alias("y"), every.alias("x"))
    return a.join(b, ["company", "x", "y"]).where("name_a < name_b").select("name_a", "name_b")
