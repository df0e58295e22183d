"""The training-data operators: brute force, round trips, held-out accuracy, odd rows."""

import base64
import collections
import functools
import hashlib
import io
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as tokens
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from check import compare
from tablesmith.llm import (
    byte_bpe, components, decontaminate, edit_counts, ftrl_toxicity, jaccard_rtree, license_dice, ppm_language, pq_dedup, queries,
    token_files, words, zstd_quality)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet consectetur " * 30_000
ODD = [(1, None, "en", None, None), (2, "", "en", "s", 0), (3, "   \n\t ", None, "s", 6), (4, "12 34 !!", "en", "s", 8),
       (5, "one two", "fr", "s", 7), (6, "one two", "fr", "s", 7), (6, "one two", "fr", "s", 7), (None, "one two three", None, None, 3),
       (7, LONG, "de", "s", len(LONG)), (8, LONG + "x", "de", "s", 1), (9, "日本 é́ 🎉 a b \x1c", "xx", "s", 3)]
TEXTS = ["", " ", "  a  b ", "x\x1cy z\x85 q", "don't we'll  I'VE", "日本語 🎉🎉", "\n\n\n  \n x", "aaaaaaaaaaaa ====== ------",
         "é H̱ İ ΑΣ Σ K", "﻿abc ​ def 　   g"]


def random_texts(n, alphabet=" \n\tab'sS1É日é.-= ", size=60, seed=1):
    draw = random.Random(seed)
    return ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, size))) for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (6, 0, 1), (6, 1, 1), (7, 1, None), (None, 1, 1), (8, None, 0)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def spec():
    return byte_bpe.specification(tokens.path("byte_bpe_multi_50k.tiktoken"), tokens.PATTERN)


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokens.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})


# --- queries against SQL, and that all of them run ---

@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf, name):
    import duckdb
    import glob
    import os
    duck = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        duck.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    problem = compare(queries.QUERIES[name](spark, sf).toArrow(), duck.sql(queries.ORACLES[name]).to_arrow_table())
    assert problem is None, problem


# --- components ---

def test_components_of_chain_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(500, 500), (None, 3), (-5, 700)]
    rows = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(rows[i] == 0 for i in range(41)) and all(rows[i] == 100 for i in range(100, 160))
    assert rows[700] == -5 and 500 not in rows
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 1: vectors ---

def test_pq_links_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(300, 16))
    rows[100:160] = rows[0] + rng.normal(size=(60, 16)) * 0.25
    rows[160:200] = rows[5]
    rows[200:220] = 3 * rows[7]
    table = [(i, [float(x) for x in r]) for i, r in enumerate(rows)]
    table += [(900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, [None] + [1.0] * 15), (904, []),
              (905, [1.0, 2.0]), (906, [2.0, 4.0]), (None, [1.0] * 16), (907, [float("inf")] * 16), (908, [1e-200] * 16), (909, [1e200] * 16)]
    got = {r.vec_id: r for r in pq_dedup.link(spark.createDataFrame(table, "vec_id long, embedding array<double>")).collect()}
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    label = np.arange(300)
    for _ in range(300):
        label = np.array([label[near[i]].min() for i in range(300)])
    assert [got[i].n_links for i in range(300)] == (near.sum(1) - 1).tolist()
    assert [got[i].component_id for i in range(300)] == label.tolist()
    assert all(got[i].n_links == 0 and got[i].kept for i in (900, 901, 902, 903, 904, 907))
    assert got[906].component_id == 905 and not got[906].kept and got[909].component_id == 908
    assert got[None].n_links == 0 and len(got) == 311
    assert pq_dedup.link(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_pq_links_of_a_dense_group(spark):
    """Every link of one group that holds a third of the vectors, spread over many lists."""
    rng = np.random.default_rng(5)
    centre, noise = rng.normal(size=64), rng.normal(size=(10_000, 64))
    rows = rng.normal(size=(30_000, 64))
    rows[:10_000] = centre / np.linalg.norm(centre) + 0.14 * noise / np.linalg.norm(noise, axis=1, keepdims=True)
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    want = np.concatenate([(unit[i:i + 1000] @ unit.T >= 0.95).sum(1) - 1 for i in range(0, 30_000, 1000)])
    assert want[:10_000].min() > 5000
    table = pa.table({"vec_id": np.arange(30_000), "embedding": pa.FixedSizeListArray.from_arrays(rows.ravel(), 64).cast(pa.list_(pa.float64()))})
    got = pq_dedup.link(spark.createDataFrame(table)).toArrow().sort_by("vec_id")
    assert (got.column("n_links").to_numpy() == want).all()
    assert (got.column("component_id").to_numpy()[:10_000] == 0).all()


# --- 2: language ---

def test_language_held_out_accuracy(spark, sf):
    got = queries.op2_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held > 0.97 and got.where("score < 0 OR score > 1").count() == 0


def gram_rows(samples):
    rows = []
    for lang, data in enumerate(samples):
        for order in range(4):
            grams = ppm_language._packed(np.frombuffer(ppm_language.PAD + data, np.uint8), order)
            rows += [(lang, order, int(g), int(c)) for g, c in zip(*np.unique(grams, return_counts=True))]
    return np.array(rows, np.int64).reshape(-1, 4)


def plain_ppm(sample, data):
    """Code length of ``data`` by counts kept in a dict of contexts, escape method C, byte by byte."""
    tree, sample, data, bits = {}, ppm_language.PAD + sample, ppm_language.PAD + data, 0.0
    for i in range(3, len(sample)):
        for order in range(4):
            tree.setdefault(sample[i - order:i], collections.Counter())[sample[i]] += 1
    for i in range(3, len(data)):
        for order in (3, 2, 1, 0):
            node = tree.get(data[i - order:i])
            if node is None:
                continue
            whole = sum(node.values()) + len(node)
            if data[i] in node:
                bits -= math.log2(node[data[i]] / whole)
                break
            bits -= math.log2(len(node) / whole)
        else:
            bits += 8
    return bits


def test_code_lengths_are_a_distribution():
    """In every context the costs of all 256 bytes sum to probability 1 or less, in order 0 with all bytes seen as well."""
    samples = (b"abracadabra abracadabra\n", b"zzarbadacarba", bytes(range(256)) * 3)
    coder = ppm_language.Coder(ppm_language.Statistics(["a", "b", "c"], gram_rows(samples)))
    for context in (b"abr", b"\n\n\n", b"xyz", b"zab", bytes([7, 8, 9]), b"qab"):
        grams = (int.from_bytes(context) << 8) + np.arange(256)
        mass = np.exp2(-coder.costs(grams.astype(np.uint32), 3).astype(float)).sum(0)
        assert mass.shape == (3,) and mass.max() <= 1.0 + 1e-4
    assert coder.lengths("abracadabra")[0] < coder.lengths("abracadabra")[1]
    whole = coder.lengths("abra" * 200_000)
    assert abs(whole[0] / (coder.lengths("abra" * 2000)[0] * 100) - 1) < 0.01


def test_code_lengths_equal_plain_ppm(monkeypatch):
    draw = random.Random(8)
    letters = [chr(draw.randrange(1, 0xD000)) for _ in range(300)] + list("etaoin shrdlu\n\x00\x7f")
    say = lambda n, some: "".join(draw.choice(some) for _ in range(n))
    samples = [say(4000, letters[k * 60:k * 60 + 90]).encode() for k in range(4)] + [b"", bytes(range(256)) * 4]
    coder = ppm_language.Coder(ppm_language.Statistics(list("abcdef"), gram_rows(samples)))
    monkeypatch.setattr(ppm_language, "SLICE", 700)
    for text in ["", "e", "\udc80x", say(3000, letters), say(2500, letters[:90]), samples[1].decode()[:1500]]:
        want = [plain_ppm(sample, text.encode("utf-8", "surrogatepass")) for sample in samples]
        assert np.allclose(coder.lengths(text), want, rtol=1e-6, atol=1e-4)


def test_language_query_equals_plain_ppm(spark, sf):
    """All rows of the query against counts and code lengths in plain Python, where the sample is all training rows."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text").collect()
    samples = collections.defaultdict(list)
    for r in docs:
        if zlib.crc32(str(r.doc_id).encode()) % 5 and r.lang is not None and r.text is not None:
            samples[r.lang].append(r.text.encode())
    tree = {}
    for lang, texts in samples.items():
        for data in (ppm_language.PAD + t for t in texts):
            for i in range(3, len(data)):
                for order in range(4):
                    tree.setdefault((lang, data[i - order:i]), collections.Counter())[data[i]] += 1
    size = {key: (sum(node.values()), len(node)) for key, node in tree.items()}

    @functools.cache
    def cost(lang, context, byte):
        if (lang, context) not in tree:
            return cost(lang, context[1:], byte) if context else 8.0
        total, kinds = size[lang, context]
        seen = tree[lang, context][byte]
        if seen:
            return -math.log2(seen / (total + kinds))
        return -math.log2(kinds / (total + kinds)) + (cost(lang, context[1:], byte) if context else 8.0)

    got = {r.doc_id: r for r in queries.op2_language_id(spark, sf).collect()}
    assert len(got) == len(docs)
    for r in docs:
        if not any(c.isalpha() for c in r.text or ""):
            assert got[r.doc_id].lang_pred == "und"
            continue
        data = ppm_language.PAD + r.text.encode()
        bits = {lang: sum(cost(lang, data[i - 3:i], data[i]) for i in range(3, len(data))) for lang in sorted(samples)}
        best = min(bits, key=bits.get)
        assert got[r.doc_id].lang_pred == best
        assert abs(got[r.doc_id].score - 1 / sum(2 ** max(bits[best] - b, -1000) for b in bits.values())) < 1e-3


def test_language_of_odd_rows(odd, empty):
    rows = ppm_language.identify(odd).collect()
    assert len(rows) == len(ODD)
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3, 4)} == {"und"}
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    assert all((r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)) for r in rows if r.doc_id is not None)
    assert ppm_language.identify(empty).count() == 0
    assert ppm_language.predict(odd, ppm_language.train(empty)).where("lang_pred <> 'und'").count() == 0


# --- 3: byte-level BPE ---

def test_bpe_equals_rank_library(spec, encoding):
    codec = byte_bpe.Codec(spec, limit=50)
    texts = TEXTS + random_texts(1500) + random_texts(500, "a= -\n")
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids.tolist() == encoding.encode_ordinary(text), repr(text)
        assert codec.decode(ids) == text.encode()


def test_bpe_tables_offsets_and_split_characters(spark, spec, odd, empty):
    rows = byte_bpe.encode(odd.withColumn("ids", F.lit("clash")), spec, offsets=True)
    for r in rows.collect():
        source = next(t for i, t, *_ in ODD if i == r.doc_id)
        assert len(r.starts) == len(r.ids) and (not r.ids or r.ends[-1] == len(source))
    back = byte_bpe.decode(rows, spec).collect()
    assert all((r.text or "") == (next(t for i, t, *_ in ODD if i == r.doc_id) or "") for r in back)
    part = spark.createDataFrame([(1, byte_bpe.Codec(spec).encode(["🎉"])[0].tolist()[:1])], "doc_id long, ids array<int>")
    assert byte_bpe.decode(part, spec).first().text == "�"
    digests = {r.doc_id: r for r in byte_bpe.round_trip(odd, spec).collect()}
    assert digests[1].n_tokens == 0 and digests[1].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert digests[7].decoded_sha256 == hashlib.sha256(LONG.encode()).hexdigest()
    assert byte_bpe.round_trip(empty, spec).count() == 0


# --- 4: decontamination ---

def test_alignment_equals_table():
    draw = random.Random(5)
    for _ in range(60):
        a, b = [np.array([draw.randint(0, 3) for _ in range(draw.randint(1, 12))]) for _ in range(2)]
        table, best = np.zeros((len(a) + 1, len(b) + 1), int), 0
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = max(0, table[i, j] + (1 if a[i] == b[j] else -1), table[i, j + 1] - 1, table[i + 1, j] - 1)
                best = max(best, table[i + 1, j + 1])
        assert decontaminate.align(a, b)[0] == best


def test_decontamination_finds_edited_copies(spark, odd, empty):
    draw = random.Random(9)
    vocabulary = [f"w{i}" for i in range(3000)]
    say = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    items = [say(30) for _ in range(20)]
    docs, planted = [], set()
    for i in range(200):
        text = say(200)
        if i % 4 == 0:
            k, copy = i // 4 % 20, list(items[i // 4 % 20])
            if i % 8 == 0:
                for p in (4, 12, 21):
                    copy[p] = "changed"
                del copy[26]
            text[50:50] = copy
            planted.add((i, k))
        docs.append((i, " ".join(text).upper() if i % 12 == 0 else ", ".join(text)))
    # a popular item does not lose its seeds, and a common phrase is no overlap
    docs += [(1000 + i, " ".join(say(5) + items[19] + say(5))) for i in range(300)]
    planted |= {(1000 + i, 19) for i in range(300)}
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(50, None), (51, ""), (52, "a b"), (None, "x y z u v")],
                                  "item_id long, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.overlaps(table, bench).collect()} == planted
    kept = decontaminate.clean(table.withColumn("score", F.lit(1)), bench)
    assert kept.columns == ["doc_id", "text", "score"] and kept.count() == 500 - len(planted)
    assert decontaminate.overlaps(empty, bench).count() == 0 and decontaminate.overlaps(table, bench.limit(0)).count() == 0
    assert decontaminate.clean(odd, bench).count() == len(ODD)


def test_parts_of_long_items(spark):
    draw = random.Random(4)
    say = lambda n: [f"w{draw.randrange(3000)}" for _ in range(n)]
    item = say(300)
    edited = item[40:80]
    edited[17] = "changed"
    rows = [(1, say(90) + item[100:200] + say(90)), (2, say(50) + item[:13] + say(50)), (3, say(50) + item[20:32] + say(50)), (4, edited), (5, item)]
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.overlaps(docs, bench).collect()}
    assert set(got) == {1, 2, 4, 5} and (got[1].item_start, got[1].item_end, got[1].doc_start, got[1].doc_end) == (100, 200, 90, 190)
    assert {r.doc_id for r in decontaminate.overlaps(docs, bench, passage=1000).collect()} == {5}
    assert [r.doc_id for r in decontaminate.clean(docs, bench).collect()] == [3]


def test_decontamination_query_equals_alignment_of_all_pairs(spark, sf):
    items = [(r.item_id, words.plain_words(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {}
    for row in spark.read.parquet(f"{sf}/documents.parquet").collect():
        said = words.plain_words(row.text or "")
        for key, item in items:
            least, own = min(0.5 * len(item), decontaminate.PASSAGE), set(item)
            if sum(w in own for w in said) >= least:
                number = {w: i for i, w in enumerate(own)}
                score = decontaminate.align(np.array([number.get(w, -1) for w in said]), np.array([number[w] for w in item]))[0]
                if score >= least:
                    want[row.doc_id, key] = round(score / len(item), 9)
    got = {(r.doc_id, r.item_id): round(r.score, 9) for r in queries.op4_decontamination(spark, sf).collect()}
    assert got == want and want


def test_benchmark_in_slices(spark, sf, monkeypatch):
    whole = {tuple(r) for r in queries.op4_decontamination(spark, sf).collect()}
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", 4000)
    assert {tuple(r)[:2] for r in queries.op4_decontamination(spark, sf).collect()} == {r[:2] for r in whole} and whole


# --- 5: edits ---

def test_edit_counts_equal_full_encoding(spec, monkeypatch):
    monkeypatch.setattr(edit_counts, "LEAF", 8)
    codec, draw = byte_bpe.Codec(spec), random.Random(2)
    for text in TEXTS + random_texts(300, size=150, seed=4):
        leaves = edit_counts.cut(text)
        tree = edit_counts.sums([len(i) for i in codec.encode(leaves)])
        lengths = list(map(len, leaves))
        for _ in range(3):
            edits = [{"at": draw.randint(0, len(text) + 2), "size": draw.randint(0, 6), "text": draw.choice(["", " ", "a", "\n x", None, "  "])}
                     for _ in range(draw.randint(0, 4))]
            expected, end = "", 0
            for e in sorted(edits, key=lambda e: (e["at"], e["size"])):
                at = min(e["at"], len(text))
                if at >= end:
                    expected += text[end:at] + (e["text"] or "")
                    end = min(len(text), at + e["size"])
            expected += text[end:]
            text, lengths, tree, _ = edit_counts.update(text, lengths, tree, edits, codec)
            assert text == expected and sum(lengths) == len(text)
            assert tree[1] == len(codec.encode([text])[0]), repr(text)
            assert all(tree[i] == tree[2 * i] + tree[2 * i + 1] for i in range(1, len(tree) // 2))


def test_edit_tables(spark, spec, odd, empty):
    trees = edit_counts.build(odd, spec)
    edits = spark.createDataFrame([(7, 6, 5, "IPSUM"), (7, 60_000, 0, "new "), (99, 0, 1, "x"), (None, 0, 1, "y"), (1, 0, 0, "hello")],
                                  "doc_id long, at int, size int, text string")
    rows = edit_counts.apply_edits(edit_counts.with_edits(trees, edits), spec).collect()
    assert len(rows) == len(ODD)
    long = next(r for r in rows if r.doc_id == 7)
    codec = byte_bpe.Codec(spec)
    assert long.n_tokens == len(codec.encode([long.text])[0]) and long.chars_encoded < 4 * edit_counts.LEAF + 200
    assert next(r for r in rows if r.doc_id == 1).text == "hello"
    assert edit_counts.apply_edits(edit_counts.redactions(edit_counts.build(empty, spec)), spec).count() == 0


def test_edit_query_equals_full_encoding(spark, sf):
    spec = byte_bpe.specification(tokens.path("byte_bpe_50k.tiktoken"), tokens.PATTERN)
    trees = edit_counts.redactions(edit_counts.build(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), spec))
    codec = byte_bpe.Codec(spec)
    rows = edit_counts.apply_edits(trees, spec).collect()
    assert [r.n_tokens for r in rows] == [len(i) for i in codec.encode([r.text for r in rows])]
    assert {(r.doc_id, r.n_tokens) for r in queries.op5_token_counts(spark, sf).collect()} == {(r.doc_id, r.n_tokens) for r in rows}


# --- 6 and 10: classifiers ---

@pytest.mark.parametrize("name, flag, least", [("op6_quality", "quality", 0.9), ("op10_toxicity", "toxic", 0.85)])
def test_held_out_accuracy(spark, sf, name, flag, least):
    big = sf.replace("0.001", "0.01")
    got = queries.QUERIES[name](spark, big)
    assert got.count() == spark.read.parquet(f"{big}/documents.parquet").count()
    held = got.join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id").where("held_out")
    assert held.agg(F.avg((F.col(flag) == F.col("predicted")).cast("int"))).first()[0] >= least
    assert got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


@pytest.mark.parametrize("module", [zstd_quality, ftrl_toxicity])
def test_classifiers_on_odd_rows(module, odd, empty, labels):
    assert module.classify(odd, labels).count() == len(ODD)
    assert module.classify(odd, labels.limit(0)).where("score = 0.5").count() == len(ODD)
    assert module.classify(empty, labels).count() == 0


def test_quality_keeps_rows_and_columns(odd, labels):
    kept = zstd_quality.accepted(odd, zstd_quality.train(odd, labels), threshold=0.0)
    assert kept.columns == odd.columns and kept.count() == len(ODD)


def test_toxic_words_decide(spark):
    draw = random.Random(3)
    rows, flags = [], []
    for i in range(1500):
        text = [f"w{draw.randint(0, 400)}" for _ in range(40)]
        if i % 5 == 0:
            text[draw.randint(0, 39)] = "Horrid!!"
        rows.append((i, " ".join(text)))
        flags.append((i, int(i % 5 == 0)))
    got = ftrl_toxicity.classify(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(flags, "doc_id long, toxic int"))
    assert got.where((F.col("predicted") == 1) != (F.col("doc_id") % 5 == 0)).count() == 0


# --- 7: token files ---

def test_word_encoder_equals_library():
    text = open(tokens.path("word_bpe_49k.json"), encoding="utf-8").read()
    encoder, library = token_files.WordEncoder(text, limit=60), Tokenizer.from_str(text)
    for text in TEXTS + random_texts(1500) + random_texts(300, "KKİiΣσH̱́e "):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_word_encoder_cuts_added_tokens():
    path = tokens.path("word_bpe_49k.json")
    library, encoder = Tokenizer.from_file(path), token_files.WordEncoder(open(path, encoding="utf-8").read())
    added = [t.content for t in library.get_added_tokens_decoder().values()]
    assert added
    for token in added:
        for text in (token, f"hello {token} world", f"a{token}b", f"x {token.upper()} y", f"{token}{token}", f"é{token} 日"):
            want = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want, text


def test_frames_and_random_access(monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_IDS", 10)
    out = io.BytesIO()
    writer, held = token_files.FrameWriter(out), []
    for i in range(100):
        held.append((i // 2, np.arange(i % 7, dtype="<u4").tobytes()))
        writer.add(*held[-1])
    writer.close()
    reader = token_files.FrameReader(io.BytesIO(out.getvalue()))
    assert list(reader.documents()) == held and len(reader.table) > 20
    read = []
    monkeypatch.setattr(reader, "frame", lambda i, real=reader.frame: (read.append(i), real(i))[1])
    assert list(reader.documents([17, 3, 999, -1])) == [d for d in held if d[0] in (3, 17)] and len(read) < 10
    spoiled = bytearray(out.getvalue())
    spoiled[20] ^= 1
    with pytest.raises(Exception):
        list(token_files.FrameReader(io.BytesIO(bytes(spoiled))).documents())
    import zstandard  # the file is a plain sequence of frames for other readers
    assert zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(out.getvalue())


def test_token_files_of_tables(spark, sf, odd, empty):
    text = open(tokens.path("word_bpe_49k.json"), encoding="utf-8").read()
    library = Tokenizer.from_str(text)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    start = 0
    got = {r.doc_id: r for r in queries.op7_token_files(spark, sf).collect()}
    for r in docs.orderBy("doc_id").collect():
        ids = [*library.encode(r.text, add_special_tokens=False).ids, 2]
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens) == (start, len(ids))
        assert got[r.doc_id].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    rows = token_files.read_files(token_files.write_files(odd, text, 2)).orderBy("start").collect()
    assert len(rows) == len(ODD) and rows[0].doc_id is None and rows[0].start == 0
    assert next(r for r in rows if r.doc_id == 1).n_tokens == 1
    assert token_files.read_files(token_files.write_files(empty, text, 2)).count() == 0


# --- 8: licences ---

def test_license_scan(spark, odd, empty):
    rows = [(1, "some words come before\nReleased under the MIT License.\nand more after it"), (2, "RELEASED, under the mit-license"), (3, "released under the license"),
            (4, "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public\n"
                "License as published by the Free Software Foundation, either version 3\nof the License, or (at your option) any later version."),
            (5, "Permission is granted to nobody."), (6, "Released under the MIT License.\nReleased under the MIT License.")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", F.lit("clash"))
    got = {(r.doc_id, r.license): (r.n_units, round(r.dice, 3)) for r in license_dice.scan(table).collect()}
    assert got == {(1, "MIT"): (1, 1.0), (2, "MIT"): (1, 1.0), (4, "GPL-3.0"): (1, 1.0), (6, "MIT"): (3, 1.0)}  # two lines and their paragraph
    assert license_dice.scan(odd).count() == 0 and license_dice.scan(empty).count() == 0
    plan = license_dice.scan(table)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_license_in_a_longer_line(spark):
    notice = "Released under the MIT License."
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(1, f"{notice} {notice}"), (2, f"This file is free. {notice} See the web site for more of it."), (3, f"{long}. {notice} {long}"),
            (4, "Some words. This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/. More words."),
            (5, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
            (None, notice), (None, notice), (7, notice), (7, f"{notice}\nother words of the second row")]
    got = {(r.doc_id, r.license): (r.n_units, round(r.dice, 3)) for r in license_dice.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # both sentences and the line; a run of other sentences with the notice is too long to resemble it
    assert got.pop((1, "MIT")) == (3, 1.0)
    assert got.pop((4, "MPL-2.0"))[1] == 1.0
    assert got == {(2, "MIT"): (1, 1.0), (3, "MIT"): (1, 1.0), (5, "LGPL-3.0"): (1, 1.0), (None, "MIT"): (1, 1.0), (7, "MIT"): (1, 1.0)}


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.95])
def test_license_bounds_lose_no_unit(threshold):
    draw = random.Random(3)
    for _, text in license_dice.TEMPLATES:
        grams = license_dice.template_bigrams(text)
        low, high = license_dice.size_bounds(len(grams), threshold)
        chosen = set(license_dice.marks(grams, threshold))
        for _ in range(300):
            unit = set(draw.sample(grams, draw.randint(0, len(grams)))) | {f"x {i}" for i in range(draw.randint(0, len(grams)))}
            if unit and 2 * len(unit & set(grams)) >= threshold * (len(unit) + len(grams)):
                assert low <= len(unit) <= high and unit & chosen


# --- 9: Jaccard join ---

def brute_components(texts, p=90, q=100, n=3):
    sets = [jaccard_rtree.shingle_set(t, words.WordHashes(), n) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if len(sets[i]) and len(sets[j]) and q * both >= p * (len(sets[i]) + len(sets[j]) - both):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label, [len(s) for s in sets]


@pytest.mark.parametrize("block", [1024, 7])
def test_jaccard_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_rtree, "BLOCK_ROWS", block)
    draw = random.Random(8)
    texts = []
    for _ in range(25):
        base = [f"v{draw.randint(0, 500)}" for _ in range(draw.choice([3, 11, 12, 21, 40, 90, 300]))]
        for _ in range(draw.randint(1, 12)):
            copy = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 50))):
                copy[draw.randrange(len(copy))] = f"v{draw.randint(0, 500)}"
            texts.append(" ".join(copy[:len(copy) - draw.randint(0, 2)]))
    shared = " ".join(f"p{i}" for i in range(60))  # a passage that many documents share
    texts += [f"{shared} x{i} y{i} z{i} u{i} v{i} w{i}" for i in range(40)] + ["", " ", "a", "a", "A b", "a  B"]
    label, sizes = brute_components(texts)
    got = {r.doc_id: r for r in jaccard_rtree.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i].component_id for i in range(len(texts))] == label
    assert [got[i].n_shingles for i in range(len(texts))] == sizes


@pytest.mark.parametrize("percent", [50, 80, 90, 97])
def test_keys_meet_for_every_linked_pair(percent):
    draw = np.random.default_rng(4)
    t = jaccard_rtree.Threshold(percent / 100)
    most = (100 - percent) / percent
    for _ in range(1500):
        size = int(draw.integers(2, 260))
        a = draw.integers(0, 1 << 63, size).astype(np.uint64)
        b = a.copy()
        if draw.integers(2):
            b = b[int(draw.integers(0, int(size * (1 - percent / 100)) + 1)):]          # fewer words
        else:
            edits = int(draw.integers(0, int(size * most / 2) + 1))
            b[:edits] = draw.integers(0, 1 << 63, edits).astype(np.uint64)     # other words
        a, b = np.unique(a), np.unique(b)
        both = len(np.intersect1d(a, b))
        if len(a) != both and 100 * both >= percent * (len(a) + len(b) - both):
            assert np.intersect1d(jaccard_rtree.group_keys(a, t), jaccard_rtree.group_keys(b, t)).size


@pytest.mark.parametrize("percent", [40, 80, 90])
def test_fine_points_lose_no_link(percent):
    draw = np.random.default_rng(9)
    t = jaccard_rtree.Threshold(percent / 100)
    sets = []
    for size in (40, 1000, 1030, 2040, 2060, 4090, 9000):
        base = draw.integers(0, 1 << 64, size, np.uint64)
        sets.append(np.unique(base))
        for share in (0.01, 0.05, 0.1, 0.11, 0.12, 0.2, 0.25, 0.4):
            gone = int(size * share)
            sets.append(np.unique(base[gone:]))
            sets.append(np.unique(np.append(base[gone:], draw.integers(0, 1 << 64, gone, np.uint64))))
    sets.append(np.arange(5000, dtype=np.uint64))       # one group for all: more than a byte holds
    sets.append(np.arange(200, 5000, dtype=np.uint64))
    vectors = [jaccard_rtree.fine_vector(s) for s in sets]
    assert all((jaccard_rtree.unpacked(jaccard_rtree.packed(v), len(s)) == v).all() for v, s in zip(vectors, sets))
    tree, names = jaccard_rtree.Tree.of_fine(vectors), np.arange(len(sets))
    near = {(x, y) for x, rest in jaccard_rtree.near_points(tree, tree, names, names, t) for y in rest.tolist()}
    true = {(x, y) for x in range(len(sets)) for y in range(len(sets)) if x != y and jaccard_rtree.linked(sets[x], sets[y], t)}
    assert true and true <= near


def test_large_unrelated_sets_are_not_sent_whole(spark, monkeypatch):
    """Texts of thousands of words that share a line meet in a cluster; only near copies of another class go on as whole sets."""
    monkeypatch.setattr(jaccard_rtree, "BLOCK_ROWS", 7)
    draw = random.Random(21)
    line = " ".join(f"s{i}" for i in range(40))
    texts = []
    for _ in range(40):
        base = [f"w{draw.randint(0, 99999)}" for _ in range(draw.randint(2900, 3100))]
        texts.append(line + " " + " ".join(base))
    for k in (3, 17):
        copy = texts[k].split()
        for at in draw.sample(range(40, len(copy)), 60):
            copy[at] = f"e{at}"
        texts.append(" ".join(copy))
    sent, whole = [], jaccard_rtree.verified

    def counting(cells, t):
        sent.append(cells.count())
        return whole(cells, t)

    monkeypatch.setattr(jaccard_rtree, "verified", counting)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_rtree.join(docs, 0.8, 5).collect()}
    assert [got[i] for i in range(len(texts))] == [*range(40), 3, 17] == brute_components(texts, 80, 100, 5)[0]
    assert len(sent) == 2 and sent[1] <= 12  # 26 without fine points


def test_jaccard_odd_rows(odd, empty):
    rows = jaccard_rtree.join(odd).collect()
    assert len(rows) == len(ODD)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert got[1] == (0, 1) and got[2] == (0, 2) and got[6] == (1, 5) and got[None] == (1, None)
    assert jaccard_rtree.join(empty).count() == 0


# --- the pipeline ---

def test_pipeline_equals_its_operators(spark, sf):
    """Each stage keeps what its operator's own result, computed apart, says."""
    import corpus_pipeline
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    lang = {r.doc_id for r in ppm_language.identify(docs).where("lang_pred <> 'und' AND score >= 0.5").collect()}
    kept = docs.where(F.col("doc_id").isin(list(lang)))
    marks = spark.read.parquet(f"{sf}/labels.parquet")
    good = {r.doc_id for r in zstd_quality.classify(kept, marks).where("score >= 0.5").collect()}
    left = sorted(good)
    label, _ = brute_components([texts[i] for i in left], round(100 * corpus_pipeline.NEAR_SIMILARITY), 100,
                                corpus_pipeline.NEAR_WORDS)
    left = [d for k, d in enumerate(left) if label[k] == k]
    bench = [words.plain_words(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    grams = {tuple(w[i:i + 8]) for w in bench for i in range(len(w) - 7)}
    clean = []
    for d in left:
        w = words.plain_words(texts[d])
        if not any(tuple(w[i:i + 8]) in grams for i in range(len(w) - 7)):
            clean.append(d)
    got = corpus_pipeline.run(spark, sf)
    assert sorted(r.doc_id for r in got.collect()) == clean
    assert len(clean) < len(texts) and got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert corpus_pipeline.run(spark, sf).exceptAll(got).count() == 0


def test_near_copy_stage_equals_brute_force(spark):
    """One document of each group at Jaccard 0.8 of five-word shingles."""
    import corpus_pipeline
    draw = random.Random(12)
    texts = []
    for _ in range(30):
        base = [f"w{draw.randint(0, 9999)}" for _ in range(draw.choice([4, 5, 20, 46, 50, 70, 120, 300]))]
        texts.append(" ".join(base))
        for edits in (0, 1, 2, 3):
            copy = list(base)
            for at in draw.sample(range(len(copy)), min(edits, len(copy))):
                copy[at] = f"e{draw.randint(0, 9999)}"
            texts.append(" ".join(copy))
    grams = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} for w in (x.split() for x in texts)]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(grams[i] & grams[j])
            if 10 * both >= 8 * (len(grams[i]) + len(grams[j]) - both):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = sorted(r.doc_id for r in corpus_pipeline.near_copy_stage(spark, docs, "").collect())
    assert kept == [i for i, x in enumerate(label) if i == x]
    narrow = jaccard_rtree.join(docs, 0.9).where("doc_id = component_id").count()
    assert len(kept) < narrow  # a stage of the other query's limits leaves edited copies
