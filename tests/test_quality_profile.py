import math
from collections import Counter, defaultdict
from random import Random
from statistics import median

import pytest
import regex

from gleanery.operators import quality_profile as q

ROWS = [(load, None if i % 7 == 0 else " " if load == 2 and i % 2 else f"{i} năm" if load != 3 else f"lvl:{i}", 2030 if load == 3 else 2024) for load in (1, 2, 3, 4) for i in range(40)]
CONTRACT = {"v": {"value_pattern": r"^[0-9]+ năm$", "check_mix": True}, "y": {"min_allowed": 2020, "max_allowed": 2026}}


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "load int, v string, y long").selectExpr("*", "1 as n", "'x' as column_name", "0 as col", "'c' as mask")


def brute():
    out, loads = set(), sorted({r[0] for r in ROWS})
    share = {}
    for l in loads:
        rows = [r for r in ROWS if r[0] == l]
        held = [r[1] for r in rows if r[1] and r[1].strip()]
        share[l] = {
            ("v", "nulls"): sum(r[1] is None for r in rows) / len(rows),
            ("v", "blanks"): sum(r[1] is not None and not r[1].strip() for r in rows) / len(rows),
            ("v", "pattern"): sum(not regex.search(CONTRACT["v"]["value_pattern"], x) for x in held) / len(held),
            ("y", "range"): sum(not 2020 <= r[2] <= 2026 for r in rows) / len(rows),
        }
        own, rest = Counter(held), Counter(r[1] for r in ROWS if r[0] != l and r[1] and r[1].strip())
        d = sum(abs(own[k] / sum(own.values()) - rest[k] / sum(rest.values())) for k in own | rest) / 2
        if d > 0.41:
            out.add((l, "v", "mix"))
    for k in share[1]:
        out |= {(l, *k) for l in loads if share[l][k] - median(share[m][k] for m in loads) > 0.21}
    return out


def test_departures_equal_brute_force(spark):
    got = q.departures(q.profile(frame(spark), "load", ["v", "y"], CONTRACT), ["v"])
    assert {(r.load, r.column_name, r.change_kind) for r in got.collect()} == brute() != set()


# --- shapes and induction against plain versions ------------------------------------------------


def plain_shapes(value):
    """The four shapes by regular expressions; symbols of a sign are the sign itself."""
    m = regex.sub(r"[\p{Lu}\p{Lt}]\p{M}*", "\ue001", value)
    m = regex.sub(r"[\p{Ll}\p{Lo}\p{Lm}]\p{M}*", "\ue002", m)
    m = regex.sub(r"\s", "\ue004", regex.sub(r"\p{Nd}", "\ue003", m))
    r = regex.sub("([\ue001-\ue004])\\1+", "\\1\ue010", m)
    w = regex.sub("(?:[\ue001\ue002]\ue010?)+", "\ue005", r)
    w = regex.sub("(?<=\ue005)\ue004\ue010?(?=\ue005)", "", w)
    w = regex.sub("\ue005{2,}", "\ue006", w)
    a = {"a" if regex.match(r"\p{L}", c) else "9" if regex.match(r"\p{Nd}", c) else "s" if regex.match(r"\s", c) else "!" + c for c in regex.sub(r"\p{M}", "", value)}
    return m, r, w, "".join(sorted(a)), "*"


def plain_induction(values):
    """mask -> level by the description lengths of the docstring, recursively from the root."""
    values = sorted(set(values))
    own = {}
    shapes = {v: plain_shapes(v) for v in values}

    def cost(level, group):
        m, r, w, a, _ = shapes[group[0]]
        text = sum(q.LETTER * len(regex.findall("[\ue001\ue002]", shapes[v][0])) + q.DIGIT * shapes[v][0].count("\ue003") for v in group)
        size = sum(2 * math.floor(math.log2(len(v) + 1)) + 1 for v in group)
        chars = sum(map(len, group))
        signs = a.count("!") + sum(x in regex.sub("!.", "", a) for x in "a9s")
        spread = max(1, signs + 90 * ("a" in regex.sub("!.", "", a)) + 10 * ("9" in regex.sub("!.", "", a)))
        return [q.SYMBOL * len(m) + text, q.SYMBOL * len(r) + text + 3 * sum(shapes[v][1].count("\ue010") for v in group), q.SYMBOL * len(w) + text + 0.8 * chars + size,
                q.SYMBOL * (signs + 1) + chars * math.log2(spread) + size, q.SYMBOL + q.ANY * chars + size][level]

    def best(level, group):
        if level == 0:
            below = sum(q.SYMBOL + 8 * len(v) for v in group)
        else:
            parts = defaultdict(list)
            for v in group:
                parts[shapes[v][level - 1]].append(v)
            below = sum(best(level - 1, p) for p in parts.values())
        mine = cost(level, group)
        own[level, shapes[group[0]][level]] = mine <= below
        return min(mine, below)

    best(4, values)
    return {v: next((q._LEVELS[k] for k in range(4, -1, -1) if own[k, shapes[v][k]]), "value") for v in values}


def made(rng, n):
    word = lambda: "".join(rng.choice("aăeioubcđgmnTÔ") + rng.choice(["", "", "\u0301"]) for _ in range(rng.randrange(1, 6)))
    kinds = [lambda: f"{rng.randrange(10**rng.randrange(1, 6))}", lambda: f"{rng.randrange(99)} - {rng.randrange(99)} tr", lambda: " ".join(word() for _ in range(rng.randrange(1, 5))), lambda: word() + ":" * rng.randrange(3) + str(rng.randrange(9)),
             lambda: "".join(rng.choice("aA9 +-.\t\u0301é漢") for _ in range(rng.randrange(1, 7))), lambda: rng.choice(["x", "y"]) * rng.randrange(1, 9)]
    return [x for x in (rng.choice(kinds)() for _ in range(n)) if x.strip()]


@pytest.mark.parametrize("seed", [1, 2])
def test_induction_equals_brute_force(spark, seed):
    values = made(Random(seed), 600)
    seen = q.observe(spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "load int, v string"), "load", ["v"], {})
    chosen = q.induce(seen)
    got = {r.v: r.level for r in seen.join(chosen, ["col", "mask"]).collect()}
    of = {r.h: r.v for r in spark.createDataFrame([(v,) for v in set(values)], "v string").selectExpr("v", "xxhash64(v) as h").collect()}
    want = plain_induction(values)
    assert {of[h]: level for h, level in got.items()} == want and len(set(want.values())) >= 3
    for v in set(values):
        for level in q._LEVELS:
            assert regex.fullmatch(q.expression(level, v), v), (level, v)


def test_shapes_are_equal_where_plain_shapes_are(spark):
    values = sorted(set(made(Random(5), 3000)))
    s = q.shape(values)
    for k, level in enumerate(q._LEVELS[:4]):
        one, two = {}, {}
        for v, h in zip(values, getattr(s, level).tolist()):
            p = plain_shapes(v)[k]
            assert one.setdefault(p, h) == h and two.setdefault(h, p) == p, (level, v)


def test_expressions_cover_all_rows(spark):
    cover = q.expression_coverage(frame(spark), "load", ["v", "y"]).collect()
    assert sum(r.rows for r in cover) == sum(bool(r[1] and r[1].strip()) for r in ROWS) + len(ROWS)
    rx = {r.expression for r in cover if r.column_name == "v" and r.load == 3 and r.expression}
    assert rx and all(any(regex.fullmatch(x, v) for x in rx) for v in ("lvl:3", "lvl:12"))


def test_profile_and_edges(spark):
    df = frame(spark)
    rows = {(r.load, r.column_name): r for r in q.profile(df, "load", ["v", "y"], CONTRACT).collect()}
    assert len(rows) == 8 and rows[2, "v"].n_rows == 40
    for l in (1, 2, 3, 4):
        held = [r[1] for r in ROWS if r[0] == l and r[1] and r[1].strip()]
        assert (rows[l, "v"].distinct_values, rows[l, "v"].checked) == (len(set(held)), len(held))
        assert rows[l, "v"].pattern_breaks == sum(not regex.search(CONTRACT["v"]["value_pattern"], x) for x in held)
        assert rows[l, "y"].range_breaks == (40 if l == 3 else 0)
    assert q.profile(df.limit(0), "load", ["v"], {}).collect() == []
    assert q.profile(df.where("load = 1"), "load", ["v"], {}).first().distance is None
    odd = spark.createDataFrame([(None, "x" * 50_000), (None, None), (None, "x" * 50_000), (1, "a"), (1, "\u0301"), (1, "12")], "load int, v string")
    got = {r.load: r for r in q.profile(odd, "load", ["v"], {"v": {"min_allowed": 20}}).collect()}
    assert (got[None].nulls, got[None].distinct_values, got[None].checked) == (1, 1, 2) and (got[1].distinct_values, got[1].range_breaks) == (3, 1)
    assert sum(r.rows for r in q.expression_coverage(odd, "load", ["v"]).collect()) == 5


def test_long_values_have_their_structure(spark):
    rng = Random(3)
    word = lambda: "".join(rng.choice("aeioubcdgmnt") for _ in range(rng.randrange(2, 9)))
    text = lambda: " ".join(word() for _ in range(rng.randrange(14, 20)))
    rows = [(load, f"{text()}: {text()}" if load < 3 else f"{text()} :{text()}") for load in (1, 2, 3) for _ in range(30)]
    cover = q.expression_coverage(spark.createDataFrame(rows, "load int, v string"), "load", ["v"]).collect()
    assert {r.level for r in cover} == {"words"}
    assert {r.load for r in cover if r.other_share == 0} == {3} and sum(r.rows for r in cover) == 90
    assert [s.words_size.tolist() for s in [q.shape(["Ab c " * 40_000 + "1", "x-" * 40_000])]] == [[3, 80_000]]
