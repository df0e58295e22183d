"""Fill-in-middle, nearest neighbours and collocations against brute force, and odd rows."""

import collections
import glob
import hashlib
import os
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from check import compare
from tablesmith.llm import collocations, fill_middle, multiprobe_lsh, queries

DOCS = "doc_id long, text string, lang string, output string, rank long, f long"
LONG = "one two, three four five six. " * 20_000
ODD = [(1, None, "en", "x", 1, 1), (2, "", "en", None, 1, 1), (3, " \t\n", None, "x", 1, 1), (4, "a<P>b", "en", "x", 1, 1),
       (5, "one two", "fr", "x", 1, 1), (5, "one two", "fr", "x", 1, 1), (None, "日本 é́ 🎉 a\x1cb", None, None, None, None),
       (6, LONG, "de", "s", 2, 2), (7, "..,;:", "en", "x", 1, 1), (8, "de de de", "de", "x", 1, 1)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.mark.parametrize("name", ["op11_fill_middle", "op13_collocations"])
def test_query_equals_sql(spark, sf, name):
    duck = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        duck.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    got = queries.QUERIES[name](spark, sf).toArrow()
    assert compare(got, duck.sql(queries.ORACLES[name]).to_arrow_table()) is None


# --- fill-in-middle ---

@pytest.mark.parametrize("density,kind", [(1e-4, fill_middle.ArrayContainer), (0.02, fill_middle.ArrayContainer),
                                          (0.5, fill_middle.BitmapContainer), (1.0, fill_middle.RunContainer)])
def test_boundary_set_selects_the_kth_offset(density, kind):
    rng = np.random.default_rng(1)
    offsets = np.flatnonzero(rng.random(300_000) < density)
    found = fill_middle.BoundarySet(offsets)
    assert {type(c) for c in found.containers} == {kind} and len(found) == len(offsets)
    for k in {0, len(offsets) - 1, *rng.integers(0, len(offsets), 300).tolist()}:
        assert found.select(k) == offsets[k]
    with pytest.raises(IndexError):
        found.select(len(offsets))


def test_boundary_set_mixes_containers():
    offsets = np.concatenate([np.arange(70_000), np.arange(200_000, 260_000, 2), [10 ** 9]])
    found = fill_middle.BoundarySet(offsets)
    assert len({type(c) for c in found.containers}) == 3
    assert [found.select(k) for k in range(0, len(offsets), 997)] == offsets[::997].tolist()


@pytest.mark.parametrize("unit,pattern", [("character", r"(?s)."), ("line", r"[^\n]*\n|[^\n]+"),
                                          ("word", r"[ \t-\r]+(?=[^ \t-\r]|$)|[^ \t-\r]+[ \t-\r]*")])
def test_units_equal_a_pattern(unit, pattern):
    draw = random.Random(3)
    for _ in range(200):
        text = "".join(draw.choice(" \nab日é🎉\t") for _ in range(draw.randint(0, 30)))
        cuts = fill_middle.boundaries(np.frombuffer(text.encode(), np.uint8).copy(), unit)
        ends = [0]
        for match in re.findall(pattern, text):
            ends.append(ends[-1] + len(match.encode()))
        assert [cuts.select(k) for k in range(len(cuts))] == ends


def test_fill_middle_odd_rows(odd, spark):
    rows = fill_middle.digests(fill_middle.transform(odd)).collect()
    assert len(rows) == len(ODD)
    texts = {r[0]: r[1] or "" for r in ODD}
    for r in rows:
        assert r.restored_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() and r.n == len(texts[r.doc_id])
    assert {r.doc_id: r.form for r in rows}[4] == "plain" and {r.doc_id: r.form for r in rows}[1] == "plain"
    assert fill_middle.transform(odd.limit(0)).count() == 0
    for unit in ("word", "line"):
        words = fill_middle.transform(odd, unit=unit, rate=100)
        back = words.select("doc_id", fill_middle.restored().alias("text")).collect()
        assert sorted((r.doc_id or 0, r.text) for r in back) == sorted((r[0] or 0, r[1] or "") for r in ODD)


def test_marks_beside_cuts_restore(spark):
    """Text that looks like parts of marks at the cuts."""
    texts = ["<" * 9, "<S" * 5, "S>M>P>", "<P<S<M", "> <M >S<"]
    rows = spark.createDataFrame([(i, texts[i % 5]) for i in range(400)], "doc_id long, text string")
    got = fill_middle.transform(rows, rate=100).select("doc_id", "form", fill_middle.restored().alias("text")).collect()
    assert all(r.text == texts[r.doc_id % 5] for r in got) and {r.form for r in got} == {"psm", "spm"}


# --- nearest neighbours ---

def brute_neighbours(rows, wanted, k):
    """{query: [(id, score)]} by all products."""
    out = {}
    for i, v in rows.items():
        if wanted(i):
            near = sorted((-float((np.array(v) * np.array(w)).sum()), j) for j, w in rows.items() if j != i)
            out[i] = [(j, -s) for s, j in near[:k]]
    return out


def answers(df):
    out = collections.defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return dict(out)


VECTORS = "vec_id long, embedding array<float>, label int, cls long, v string"


@pytest.mark.parametrize("shape", ["sphere", "lengths", "clusters"])
def test_search_recall_and_exact_scores(spark, shape):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    if shape == "sphere":
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    elif shape == "clusters":
        x = (x * 0.05 + rng.normal(size=(10, 16))[rng.integers(0, 10, 1500)]).astype(np.float32)
    rows = {i: v.tolist() for i, v in enumerate(x)}
    df = spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows.items()], VECTORS)
    got = answers(multiprobe_lsh.search(df, F.col("vec_id") % 20 == 0))
    want = brute_neighbours({i: np.array(v, np.float32).astype(np.float64) for i, v in rows.items()}, lambda i: i % 20 == 0, 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    for q, found in got.items():
        assert found == sorted(found, key=lambda t: (-t[1], t[0]))
        for j, score in found:
            assert score == pytest.approx(float((x[q].astype(np.float64) * x[j].astype(np.float64)).sum()), abs=1e-12)


def test_search_small_cells_lose_nothing(spark, monkeypatch):
    """Many cells and blocks give what one block gives."""
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(i, v.tolist(), 0, 1, "x") for i, v in enumerate(rng.normal(size=(600, 8)))], VECTORS)
    one = answers(multiprobe_lsh.search(df, F.col("vec_id") % 20 == 0))
    monkeypatch.setattr(multiprobe_lsh, "CELL_ROWS", 20)
    monkeypatch.setattr(multiprobe_lsh, "CELL_QUERIES", 3)
    many = answers(multiprobe_lsh.search(df, F.col("vec_id") % 20 == 0))
    assert many == one


def test_search_copies_ties_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0], 0, 1, "x") for i in range(0, 120)]                # one vector many times
    rows += [(i, [0.0, 1.0], 0, 1, "x") for i in range(200, 205)]
    rows += [(0, [1.0, 0.0], 0, 1, "x"), (300, None, 0, 1, "x"), (320, [0.0, 0.0], 0, 1, "x"), (340, [nan, 1.0], 0, 1, "x"),
             (360, [1.0, None], 0, 1, "x"), (380, [inf, 1.0], 0, 1, "x"), (None, [1.0, 1.0], 0, 1, "x"),
             (400, [1.0, 2.0, 3.0], 0, 1, "x"), (420, [3.0, 2.0, 1.0], 0, 1, "x"), (440, [5.0], 0, 1, "x"),
             (7, [0.5, 0.5], 0, 1, "x")]                                       # a second vector of an id: the smallest counts
    got = answers(multiprobe_lsh.search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0))
    assert set(got) == {0, 20, 40, 60, 80, 100, 200, 400, 420}
    ones = [i for i in range(120) if i != 7]
    assert got[0] == [(j, 1.0) for j in ones if j != 0][:20] and got[100] == [(j, 1.0) for j in ones][:20]
    assert got[200][:5] == [(201, 1.0), (202, 1.0), (203, 1.0), (204, 1.0), (7, 0.5)]
    assert got[200][5:] == [(j, 0.0) for j in ones][:15]
    assert got[400] == [(420, 10.0)] and got[420] == [(400, 10.0)]
    empty = spark.createDataFrame([], VECTORS)
    assert multiprobe_lsh.search(empty, F.col("vec_id") % 20 == 0).count() == 0
    alone = spark.createDataFrame([(20, [1.0], 0, 1, "x")], VECTORS)
    assert multiprobe_lsh.search(alone, F.col("vec_id") % 20 == 0).count() == 0


# --- collocations ---

def brute_counts(docs, longest):
    counts = collections.Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    counts[(lang, *w[i:i + k])] += 1
    return counts


def brute_phrases(docs, least, longest=5, best=2000):
    counts = brute_counts(docs, longest)
    total = collections.Counter()
    for p, f in counts.items():
        if len(p) == 2:
            total[p[0]] += f
    found = {p: f for p, f in counts.items() if len(p) > 2 and f >= least}
    rows = collections.defaultdict(list)
    for p, a in found.items():
        lang, w = p[0], p[1:]
        if any(q[0] == lang and len(q) > len(p) and f >= a and any(q[i:i + len(w)] == w for i in range(1, len(q) - len(w) + 1))
               for q, f in found.items()):
            continue
        cuts = [(1000 * a * total[lang] // (counts[(lang, *w[:j])] * counts[(lang, *w[j:])]), j) for j in range(1, len(w))]
        score, j = min(cuts)
        rows[lang].append((-score, -a, " ".join(w).encode(), counts[(lang, *w[:j])], counts[(lang, *w[j:])]))
    out = []
    for lang, some in rows.items():
        for rank, (s, a, p, l, r) in enumerate(sorted(some)[:best], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


@pytest.fixture(scope="module")
def chatter():
    draw = random.Random(9)
    words = ["the", "de", "en", "of", "A", "B\tb", "c.", "d,", "é", "日本", "new york", "x\x1cy", " "]
    docs = [(" ".join(draw.choice(words) for _ in range(draw.randint(0, 60))), draw.choice(["en", "de", None])) for _ in range(300)]
    return docs + [("in the hot passage of many words " * 30, "en")] * 20 + [(None, "en"), ("", None), ("one", "xx")]


@pytest.mark.parametrize("pieces", [None, 2000])
def test_collocations_equal_brute_force(spark, chatter, monkeypatch, pieces):
    if pieces:  # many shards and prefix ranges
        monkeypatch.setattr(collocations, "RANGE_BYTES", pieces)
        monkeypatch.setattr(collocations, "SHARD_WORDS", 500)
    df = spark.createDataFrame([(i, t, lang, "x", 1, 1) for i, (t, lang) in enumerate(chatter)], DOCS)
    for least, best in ((20, 2000), (7, 5)):
        got = sorted(tuple(r) for r in collocations.mine(df, least, 5, best).collect())
        assert got == brute_phrases(chatter, least, 5, best)


def test_automata_count_and_share_states():
    rows = [b"a b c", b"a b d", b"x b c", b"x b d", b"y", b"y b c"]
    langs = [b"en"] * len(rows)
    machine = collocations.machine_of(langs, rows, np.ones(len(rows), np.int64))
    # a and x have equal continuations, so their states are one
    root, words = machine.target[0][0], {w: i for i, w in enumerate(machine.words)}
    arcs = slice(machine.first[1][root], machine.first[1][root + 1])
    target = dict(zip(machine.label[1][arcs].tolist(), machine.target[1][arcs].tolist()))
    assert target[words[b"a"]] == target[words[b"x"]] != target[words[b"y"]]
    twice = collocations.unite([machine, collocations.Automaton.load(machine.dump())], 1)
    assert [p.weight.sum() for p in twice[1]] == [0, 2, 0, 10]
    asked = collocations.machine_of([b"en", b"en", b"fr", b"en"], [b"x b d", b"a", b"y", b"y"], np.arange(1, 5))
    assert [x.tolist() for x in collocations.compose(asked, machine)] == [[4, 1], [1, 1]]


@pytest.mark.parametrize("shortest,longest", [(0, 1), (2, 2), (3, 5), (0, 5)])
def test_union_over_ranges_equals_counting(chatter, shortest, longest):
    draw = random.Random(4)
    docs = [(t or "", lang or "und") for t, lang in chatter[:200]]
    want = {tuple(x.encode() for x in p): f for p, f in brute_counts(docs, longest).items() if len(p) > max(shortest, 1)}
    if shortest == 0:
        for p, f in brute_counts(docs, 1).items():
            want[(p[0].encode(),)] = want.get((p[0].encode(),), 0) + f
    for n in (0, 3, 60):
        borders = sorted(set(draw.choice(sorted(want)) for _ in range(n)))
        by_range = collections.defaultdict(list)
        for at in range(0, len(docs), 40):
            part = docs[at:at + 40]
            found, text, fresh = collocations.cut(pa.array([t.encode() for t, _ in part], pa.binary()))
            langs = sorted({lang for _, lang in part})
            code = np.array([langs.index(lang) for _, lang in part])[text]
            for r, data in collocations.shard_automata(found, fresh, code, [x.encode() for x in langs], borders, shortest, longest,
                                                       None, 0):
                by_range[r].append(collocations.Automaton.load(data))
        got = {}
        for machines in by_range.values():
            names, parts = collocations.unite(machines, 3)
            paths = [()]
            for k, part in enumerate(parts):
                paths = [(paths[a] if k else ()) + (names[w],) for a, w in zip(part.parent, part.label)]
                for p, f in zip(paths, part.weight.tolist()):
                    if f:
                        assert p not in got
                        got[p] = f
        assert got == {p: f for p, f in want.items() if f >= 3}


def test_collocations_odd_rows(odd):
    rows = collocations.mine(odd, 2).collect()
    assert {r.lang for r in rows} == {"de", "fr"}
    assert [(r.phrase, r.a) for r in rows if r.lang == "fr"] == [("one two", 2)]
    assert ("one two", 20_000) in {(r.phrase, r.a) for r in rows}
    assert collocations.mine(odd.limit(0)).count() == 0
