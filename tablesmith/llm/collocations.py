"""Phrase collocations from weighted acyclic automata.

Texts are cut into pieces and words. A phrase's score is the least, over its cuts into two
parts, of ``floor(1000 a n / (l r))`` with ``a``, ``l``, ``r`` the counts of the phrase and the parts and ``n``
the words of the language.

Counting. A task cuts the n-grams of a shard (some millions of words) into the prefix ranges
that all tasks share and builds, from the sorted n-grams of each range, a minimal levelled
transducer: every arc carries a word and the count of the n-gram that ends there, and states
with equal arcs are kept once (found from the deepest level up, on whole sorted levels instead
of one string at a time). Only these automata are shuffled, by range. The automata of a range
are united level by level, summing the weights of equal paths; a path below the wanted count is
left at once, as no longer phrase can be more frequent than its beginning.

Three passes read the texts: words, pairs, phrases of three and more. A phrase can be frequent
only if all pairs in it are, and a pair only if its words are, so a later pass enters only runs of n-grams
that the pass before found frequent. They are looked up in a bitmap of ``FILTER_BITS`` bits, whose
size does not grow with the data; a false hit costs work, not correctness.

Parts. The parts of all candidates are made an automaton per range and composed with the automaton
of the counts of that range: both are walked together and the weights read off the count side.

Null languages are ``und``, null texts empty; ids are not read, repeated rows count as often as
they occur; an empty table gives an empty result. Words are byte strings of any length; other
columns cannot clash. Ranges follow the bytes of text and cut at whole n-grams, so a hot word
or pair spreads over several; a hot phrase is one arc per shard.
"""

from __future__ import annotations

import math
import pickle
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tablesmith.llm.storage import saved, small_batches
from tablesmith.llm.words import GOLDEN, mix

LONGEST = 5
SHARD_WORDS = 1_000_000
RANGE_BYTES = 16 << 20   # bytes of text behind one prefix range
SAMPLE_TEXTS = 2000      # texts that the borders of ranges are drawn from
FILTER_BITS = 1 << 23
BORDER_BYTES = 64        # words in a border are cut to this length

WORD, BLANK, BREAK = 0, 1, 2
KIND = np.full(256, WORD, np.uint8)
KIND[[0x20, 0x09]] = BLANK
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = BREAK
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, text of each word, whether it begins a piece) of binary texts, none of them null."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[ends[0]:ends[-1]] if body is not None else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    kind = KIND[data]
    inside = kind == WORD
    borders = ends[1:-1][(ends[1:-1] > 0) & (ends[1:-1] < len(data))]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[borders] = False
    after[borders - 1] = False
    starts, stops = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [
        None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(LOWER[data][inside].tobytes())])
    text = np.searchsorted(ends, starts, "right") - 1
    breaks = np.cumsum(kind == BREAK)[starts] if len(starts) else np.zeros(0, np.int64)
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (breaks[1:] != breaks[:-1])
    return words, text, fresh


@dataclass
class Level:
    """Distinct n-grams of one length in order: prefix (row of the level above), word, weight."""

    parent: np.ndarray
    label: np.ndarray
    weight: np.ndarray


def levels(tokens: np.ndarray, starts: np.ndarray, roots: np.ndarray, length: np.ndarray, shortest: int, n_labels: int,
           weights: np.ndarray | None = None) -> list[Level]:
    """All n-grams that start at ``starts`` below their root, sorted, level by level.

    Without ``weights`` each n-gram of ``shortest`` to ``length`` words counts 1 (level 0: words);
    with them only the whole one counts.
    """
    used, node, count = np.unique(roots, return_inverse=True, return_counts=True)
    zero = np.zeros(len(used), np.int64)
    out = [Level(zero, used, count if shortest == 0 and weights is None else zero)]
    if weights is not None:
        np.add.at(out[0].weight, node[length == 0], weights[length == 0])
    for k in range(1, int(length.max(initial=0)) + 1):
        on = length >= k
        starts, node, length = starts[on], node[on], length[on]
        weights = weights[on] if weights is not None else None
        found, node, count = np.unique(node * n_labels + tokens[starts + k - 1], return_inverse=True, return_counts=True)
        if weights is not None:
            count = np.zeros(len(found), np.int64)
            np.add.at(count, node[length == k], weights[length == k])
        elif k < shortest:
            count = np.zeros(len(found), np.int64)
        out.append(Level(found // n_labels, found % n_labels, count))
    return out


@dataclass
class Automaton:
    """A levelled transducer: per level the first arc of each state, and words, weights and targets
    of arcs; state 0 has no arcs, a level's only starting state is that of level 0."""

    words: list[bytes]
    first: list[np.ndarray]
    label: list[np.ndarray]
    weight: list[np.ndarray]
    target: list[np.ndarray]

    def dump(self) -> bytes:
        data = pickle.dumps((self.words, [[a.astype(np.int32) for a in x] for x in (self.first, self.label, self.target)],
                             self.weight), protocol=5)
        return zstandard.ZstdCompressor(level=1).compress(data)

    @staticmethod
    def load(data: bytes) -> Automaton:
        words, (first, label, target), weight = pickle.loads(zstandard.ZstdDecompressor().decompress(data))
        return Automaton(words, first, label, weight, target)


def spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices ``first[i] .. first[i] + size[i] - 1`` one after another."""
    total = int(size.sum())
    return np.arange(total) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)


def _states(group: np.ndarray, n: int, label: np.ndarray, weight: np.ndarray, target: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(state of each of ``n`` nodes, first arc of each state, arcs kept): nodes with equal arcs share one.

    Equal nodes are found by a hash of their arcs and compared arc by arc before they are merged.
    """
    size = np.bincount(group, minlength=n)
    first = np.cumsum(size) - size
    some = np.flatnonzero(size)
    if not len(some):
        return np.zeros(n, np.int64), np.array([0, 0]), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        arc = mix(mix(mix(label.astype(np.uint64) * GOLDEN) + weight.astype(np.uint64)) + target.astype(np.uint64))
        sign = mix(np.add.reduceat(arc, first[some]) + size[some].astype(np.uint64))
    _, chosen, same = np.unique(sign, return_index=True, return_inverse=True)
    like = some[chosen[same]]
    equal = size[like] == size[some]
    mine = spans(first[some], size[some])
    theirs = spans(first[like], np.where(equal, size[some], 0))
    mine = mine[np.repeat(equal, size[some])]
    bad = (label[mine] != label[theirs]) | (weight[mine] != weight[theirs]) | (target[mine] != target[theirs])
    whose = np.repeat(np.flatnonzero(equal), size[some][equal])
    equal[whose[bad]] = False
    like = np.where(equal, like, some)
    kept, state = np.unique(like, return_inverse=True)
    states = np.zeros(n, np.int64)
    states[some] = state + 1
    starts = np.concatenate([[0, 0], np.cumsum(size[kept])])
    return states, starts, spans(first[kept], size[kept])


def build(parts: Sequence[Level], words: Sequence[bytes], roots: Sequence[bytes]) -> Automaton:
    """The minimal automaton of sorted levels; level 0 is labelled by ``roots``, the others by ``words``."""
    used = [np.unique(p.label) for p in parts]
    inner = np.unique(np.concatenate(used[1:])) if len(used) > 1 else np.zeros(0, np.int64)
    names = [*[roots[i] for i in used[0]], *[words[i] for i in inner]]
    first, label, weight, target = [], [], [], []
    states = np.zeros(len(parts[-1].label), np.int64)
    for k in range(len(parts) - 1, -1, -1):
        own = (np.searchsorted(used[0], parts[k].label) if k == 0
               else np.searchsorted(inner, parts[k].label) + len(used[0]))
        n = len(parts[k - 1].label) if k else 1
        above, starts, arcs = _states(parts[k].parent, n, own, parts[k].weight, states)
        first.append(starts)
        label.append(own[arcs])
        weight.append(parts[k].weight[arcs])
        target.append(states[arcs])
        states = above
    return Automaton(names, first[::-1], label[::-1], weight[::-1], target[::-1])


def ranges(parts: Sequence[Level], words: Sequence[bytes], roots: Sequence[bytes], borders: Sequence[tuple]
           ) -> Iterator[tuple[int, list[Level]]]:
    """(range, its levels): an n-gram belongs to the range that its whole word sequence falls into.

    Nodes that only lead to n-grams of a range are in it with weight 0.
    """
    n_words = len(words)
    spots = []  # per level: the first n-gram not below each border
    on_path, at = np.ones(len(borders), bool), np.zeros(len(borders), np.int64)
    place = np.zeros(len(borders), np.int64)
    for k, part in enumerate(parts):
        labels = roots if k == 0 else words
        width = len(labels) + 1 if k == 0 else n_words + 1
        keys = part.parent * width + part.label
        spot = np.searchsorted(keys, place * width)
        for b in np.flatnonzero(on_path):
            if len(borders[b]) <= k:
                # the border ended above: what follows it begins with its node's children
                on_path[b] = False
                spot[b] = np.searchsorted(keys, at[b] * width)
                continue
            word = bisect_left(labels, borders[b][k])
            key = at[b] * width + word
            spot[b] = np.searchsorted(keys, key)
            hit = word < len(labels) and labels[word] == borders[b][k] and spot[b] < len(keys) and keys[spot[b]] == key
            on_path[b] = hit
            at[b] = spot[b]
        spots.append(spot)
        # a node on the path that is shorter than its border lies below it, its children may not
        longer = on_path & (np.array([len(x) for x in borders], np.int64) > k + 1) if len(borders) else on_path
        place = spot
        spots[-1] = np.where(longer, spot + 1, spot)
    for r in range(len(borders) + 1):
        low = [int(s[r - 1]) if r else 0 for s in spots]
        high = [int(s[r]) if r < len(borders) else len(p.label) for s, p in zip(spots, parts)]
        bounds: list[tuple[int, int]] = []
        for k in range(len(parts) - 1, -1, -1):
            a, b = low[k], max(high[k], low[k])
            if bounds:  # the prefixes of the n-grams below, which may lie in the range before
                child = bounds[-1]
                c, d = int(parts[k + 1].parent[child[0]]), int(parts[k + 1].parent[child[1] - 1]) + 1
                a, b = (min(a, c), max(b, d)) if a < b else (c, d)
            if a < b:
                bounds.append((a, b))
        bounds.reverse()
        if not bounds:
            continue
        out = []
        for k, (a, b) in enumerate(bounds):
            weight = parts[k].weight[a:b].copy()
            weight[:max(0, min(low[k], b) - a)] = 0
            weight[max(0, high[k] - a):] = 0
            out.append(Level(parts[k].parent[a:b] - (bounds[k - 1][0] if k else 0), parts[k].label[a:b], weight))
        if any(x.weight.any() for x in out):
            yield r, out


def unite(machines: Sequence[Automaton], least: int) -> tuple[list[bytes], list[Level]]:
    """(words, levels) of the union with summed weights; paths with 0 < weight < ``least`` are left."""
    names = sorted(set().union(*[m.words for m in machines])) if machines else []
    rank = {w: i for i, w in enumerate(names)}
    known = [np.array([rank[w] for w in m.words], np.int64) for m in machines]
    machine = np.arange(len(machines))
    node, state = np.zeros(len(machines), np.int64), np.ones(len(machines), np.int64)
    out: list[Level] = []
    for k in range(max((len(m.first) for m in machines), default=0)):
        on = [m if len(m.first) > k else None for m in machines]
        blank = np.zeros(0, np.int64)
        firsts = [m.first[k].astype(np.int64) if m else np.zeros(1, np.int64) for m in on]
        n_arcs = np.array([len(m.label[k]) if m else 0 for m in on])
        arc_base = np.cumsum(n_arcs) - n_arcs
        state_base = np.cumsum([len(f) - 1 for f in firsts]) - np.array([len(f) - 1 for f in firsts])
        first = np.concatenate([f[:-1] + base for f, base in zip(firsts, arc_base)])
        size = np.concatenate([np.diff(f) for f in firsts])
        label = np.concatenate([names_of[m.label[k]] if m else blank for m, names_of in zip(on, known)])
        weight = np.concatenate([m.weight[k] if m else blank for m in on])
        target = np.concatenate([m.target[k] if m else blank for m in on])
        at = state_base[machine] + state
        arcs = spans(first[at], size[at])
        owner = np.repeat(np.arange(len(at)), size[at])
        found, which = np.unique(node[owner] * len(names) + label[arcs], return_inverse=True)
        total = np.zeros(len(found), np.int64)
        np.add.at(total, which, weight[arcs])
        alive = (total == 0) | (total >= least)
        place = np.cumsum(alive) - 1
        out.append(Level(found[alive] // len(names), found[alive] % len(names), total[alive]))
        on_arc = alive[which] & (target[arcs] != 0)
        node, machine, state = place[which[on_arc]], machine[owner[on_arc]], target[arcs][on_arc].astype(np.int64)
        if not len(node):
            break
    return names, out


def compose(asked: Automaton, counts: Automaton) -> tuple[np.ndarray, np.ndarray]:
    """(weight in ``asked``, weight in ``counts``) of every path that both accept."""
    # a language may be spelt like a word; languages come first in the list of words
    words = {w: i for i, w in enumerate(counts.words)}
    roots = {w: i for i, w in reversed(list(enumerate(counts.words)))}
    known = [np.array([rank.get(w, -1) for w in asked.words], np.int64) for rank in (roots, words)]
    here, there = np.ones(1, np.int64), np.ones(1, np.int64)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    width = len(counts.words) + 1
    for k in range(min(len(asked.first), len(counts.first))):
        first, size = asked.first[k].astype(np.int64), np.diff(asked.first[k]).astype(np.int64)
        arcs = spans(first[here], size[here])
        word = known[min(k, 1)][asked.label[k][arcs]]
        beside = np.repeat(there, size[here])
        state = np.repeat(np.arange(len(counts.first[k]) - 1), np.diff(counts.first[k]))
        keys = state * width + counts.label[k]
        spot = np.minimum(np.searchsorted(keys, beside * width + word), max(len(keys) - 1, 0))
        hit = (word >= 0) & (keys[spot] == beside * width + word) if len(keys) else np.zeros(len(arcs), bool)
        arcs, spot = arcs[hit], spot[hit]
        left.append(asked.weight[k][arcs])
        right.append(counts.weight[k][spot])
        here, there = asked.target[k][arcs].astype(np.int64), counts.target[k][spot].astype(np.int64)
        on = (here > 0) & (there > 0)
        here, there = here[on], there[on]
    a, b = np.concatenate(left), np.concatenate(right)
    return a[(a > 0) & (b > 0)], b[(a > 0) & (b > 0)]


def machine_of(langs: Sequence[bytes], phrases: Sequence[bytes], weights: np.ndarray) -> Automaton:
    """The automaton of distinct phrases (words joined by a space) with their weights."""
    rows = [p.split(b" ") for p in phrases]
    names, roots = sorted({w for r in rows for w in r}), sorted(set(langs))
    rank, root = {w: i for i, w in enumerate(names)}, {w: i for i, w in enumerate(roots)}
    tokens = np.array([rank[w] for r in rows for w in r], np.int64)
    length = np.array([len(r) for r in rows], np.int64)
    parts = levels(tokens, np.cumsum(length) - length, np.array([root[x] for x in langs], np.int64), length, 1,
                   max(len(names), 1), np.asarray(weights, np.int64))
    return build(parts, names, roots)


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def longer_hash(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of an n-gram from that of all but its last word."""
    with np.errstate(over="ignore"):
        return mix(prefix * GOLDEN + word)


def marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    spot = hashes >> np.uint64(65 - FILTER_BITS.bit_length())
    return (bitmap[spot >> np.uint64(6)] >> (spot & np.uint64(63)) & np.uint64(1)).astype(bool)


def shard_automata(words: pa.Array, fresh: np.ndarray, lang: np.ndarray, langs: Sequence[bytes], borders: Sequence[tuple],
                   shortest: int, longest: int, bitmap: np.ndarray | None, filter_words: int
                   ) -> Iterator[tuple[int, bytes]]:
    """(range, automaton of its n-grams) of one shard of words."""
    coded = words.dictionary_encode()
    listed = coded.dictionary.to_pylist()
    order = sorted(range(len(listed)), key=listed.__getitem__)
    names = [listed[i] for i in order]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    tokens = rank[coded.indices.to_numpy()]
    by_name = sorted(range(len(langs)), key=langs.__getitem__)
    roots = [langs[i] for i in by_name]
    back = np.empty(len(langs), np.int64)
    back[by_name] = np.arange(len(langs))
    root = back[lang]
    n = len(tokens)
    begin = np.flatnonzero(fresh)
    sizes = np.diff(np.append(begin, n))
    room = np.repeat(begin + sizes, sizes) - np.arange(n)
    if bitmap is not None:
        hashed = word_hashes(names)
        run = longer_hash(word_hashes(roots)[root], hashed[tokens])
        for step in range(1, filter_words):
            run = longer_hash(run[:n - step], hashed[tokens[step:]])
        link = np.zeros(n, bool)
        link[:len(run)] = marked(bitmap, run)
        link &= room >= filter_words
        stop = np.minimum.accumulate(np.where(link, n, np.arange(n))[::-1])[::-1]
        room = np.where(link, np.minimum(room, stop - np.arange(n) + filter_words - 1), 0)
    length = np.minimum(room, longest)
    starts = np.flatnonzero(length >= max(shortest, 1))
    if not len(starts):
        return
    parts = levels(tokens, starts, root[starts], length[starts], shortest, len(names))
    for r, out in ranges(parts, names, roots, borders):
        yield r, build(out, names, roots).dump()


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).cast("binary").alias("lang"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def draw_borders(docs: DataFrame, longest: int) -> list[tuple]:
    """Word sequences that part the n-grams of all texts evenly, drawn from a bounded sample.

    They decide where n-grams are summed, never what the sums are.
    """
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    wanted = min(1 << 16, math.ceil((row.bytes or 0) / RANGE_BYTES))
    if wanted <= 1:
        return []
    each = max(16, math.ceil(8 * wanted / SAMPLE_TEXTS))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, text, _ = cut(batch.column("text"))
            langs = batch.column("lang").to_pylist()
            drawn = np.random.default_rng(len(words)).permutation(len(words))
            order = np.argsort(text[drawn], kind="stable")
            own = text[drawn][order]
            nth = np.arange(len(own)) - np.searchsorted(own, own)
            chosen = drawn[order][nth < each]
            path = [[langs[text[i]], *[w[:BORDER_BYTES] for w in words.slice(i, longest).to_pylist()]] for i in chosen.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(path, pa.list_(pa.binary()))], ["path"])

    some = docs.sample(min(1.0, SAMPLE_TEXTS / max(row.n, 1)), seed=3)
    found = sorted(tuple(r.path) for r in small_batches(some).mapInArrow(keys, "path array<binary>").collect())
    found = [tuple(bytes(w) for w in p) for p in found]
    return sorted({found[len(found) * i // wanted] for i in range(1, wanted)} if found else [])


COUNTED = T.StructType([T.StructField("lang", T.StringType()), T.StructField("k", T.IntegerType()),
                        T.StructField("phrase", T.StringType()), T.StructField("f", T.LongType()),
                        T.StructField("hash", T.LongType()), T.StructField("range", T.IntegerType())])


def text_array(values: Sequence[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).view(pa.string())


def count_pass(docs: DataFrame, borders: Sequence[tuple], shortest: int, longest: int, least: int,
               bitmap: np.ndarray | None = None, filter_words: int = 0) -> DataFrame:
    """(lang, k, phrase, f, hash, range) of all n-grams of the given lengths that occur ``least`` times."""
    shared = docs.sparkSession.sparkContext.broadcast((list(borders), bitmap))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, bits = shared.value
        words, fresh, lang, langs, held = [], [], [], {}, 0

        def flush():
            rows = list(shard_automata(pa.concat_arrays(words), np.concatenate(fresh), np.concatenate(lang), list(langs), cuts,
                                       shortest, longest, bits, filter_words))
            return pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int32()),
                                               pa.array([d for _, d in rows], pa.binary())], ["range", "data"])

        for batch in batches:
            found, text, starts = cut(batch.column("text"))
            if not len(found):
                continue
            own = [langs.setdefault(x, len(langs)) for x in batch.column("lang").to_pylist()]
            words.append(found)
            fresh.append(starts)
            lang.append(np.array(own, np.int64)[text])
            held += len(found)
            if held >= SHARD_WORDS:
                yield flush()
                words, fresh, lang, langs, held = [], [], [], {}, 0
        if held:
            yield flush()

    def union(key, pieces):
        names, parts = unite([Automaton.load(x) for x in pieces.column("data").to_pylist()], least)
        hashed = word_hashes(names)
        rows: list[list] = [[], [], [], [], []]
        roots: list[bytes] = []
        phrase: list[bytes] = []
        for k, part in enumerate(parts):
            word = [names[i] for i in part.label.tolist()]
            if k == 0:
                roots, phrase, mark = word, [b""] * len(word), hashed[part.label]
            else:
                above = part.parent.tolist()
                roots = [roots[i] for i in above]
                phrase = [phrase[i] + b" " + w if k > 1 else w for i, w in zip(above, word)]
                mark = longer_hash(mark[part.parent], hashed[part.label])
            for i in np.flatnonzero(part.weight >= least).tolist():
                for column, value in zip(rows, (roots[i], k, phrase[i], int(part.weight[i]), int(mark[i].astype(np.int64)))):
                    column.append(value)
        return pa.table([text_array(rows[0]), pa.array(rows[1], pa.int32()), text_array(rows[2]), pa.array(rows[3], pa.int64()),
                         pa.array(rows[4], pa.int64()), pa.array(np.full(len(rows[0]), key[0].as_py(), np.int32))],
                        names=[f.name for f in COUNTED.fields])

    pieces = small_batches(docs).mapInArrow(shards, "range int, data binary")
    return saved(pieces.groupBy("range").applyInArrow(union, COUNTED), "counts")


def bitmap_of(counted: DataFrame) -> np.ndarray:
    """One bit for the hash of every n-gram; ``FILTER_BITS`` bits whatever the data."""
    spot = F.shiftrightunsigned("hash", 65 - FILTER_BITS.bit_length())
    bits = (counted.select(spot.alias("s"))
            .select(F.shiftright("s", 6).alias("at"), F.expr("shiftleft(1L, cast(s & 63 as int))").alias("bit")))
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    for row in bits.groupBy("at").agg(F.bit_or("bit").alias("bits")).collect():
        out[row["at"]] = np.uint64(row["bits"] & 0xFFFFFFFFFFFFFFFF)
    return out


def part_counts(candidates: DataFrame, counted: DataFrame, borders: Sequence[tuple]) -> DataFrame:
    """(lang, part, f) of every part of every candidate, by composition within each range."""
    shared = candidates.sparkSession.sparkContext.broadcast(list(borders))

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limits = shared.value
        for batch in batches:
            found = set()
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()):
                words = phrase.split(b" ")
                for j in range(1, len(words)):
                    found |= {(lang, *words[:j]), (lang, *words[j:])}
            found = sorted(found)
            yield pa.RecordBatch.from_arrays(
                [text_array([p[0] for p in found]), text_array([b" ".join(p[1:]) for p in found]),
                 pa.array([bisect_right(limits, p) for p in found], pa.int32())], ["lang", "part", "range"])

    def look_up(left, right):
        asked = [right.column(c).cast(pa.binary()).to_pylist() for c in ("lang", "part")]
        have = [left.column(c).cast(pa.binary()).to_pylist() for c in ("lang", "phrase")]
        if not asked[0] or not have[0]:
            row, f = np.zeros(0, np.int64), np.zeros(0, np.int64)
        else:
            row, f = compose(machine_of(*asked, np.arange(1, len(asked[0]) + 1)),
                             machine_of(*have, left.column("f").to_numpy()))
        kept = (row - 1).tolist()
        return pa.table([text_array([asked[0][i] for i in kept]), text_array([asked[1][i] for i in kept]), pa.array(f, pa.int64())],
                        names=["lang", "part", "f"])

    binary = candidates.select(F.col("lang").cast("binary").alias("lang"), F.col("phrase").cast("binary").alias("phrase"))
    parts = binary.mapInArrow(cuts, "lang string, part string, range int").distinct()
    return saved(counted.where("k > 0").groupBy("range").cogroup(parts.groupBy("range"))
                 .applyInArrow(look_up, "lang string, part string, f long"), "parts")


def phrase_counts(docs: DataFrame, least: int = 100, longest: int = LONGEST) -> tuple[DataFrame, list[tuple]]:
    """(table of all phrases of up to ``longest`` words that occur ``least`` times, borders of its ranges).

    ``k`` is the number of words; 0 marks a language's words as a whole.
    """
    texts = _plain(docs)
    borders = draw_borders(texts, longest)
    words = count_pass(texts, borders, 0, 1, least)
    tables = [words]
    if longest > 1:
        tables.append(count_pass(texts, borders, 2, 2, least, bitmap_of(words.where("k = 1")), 1))
    if longest > 2:
        tables.append(count_pass(texts, borders, 3, longest, least, bitmap_of(tables[1]), 2))
    out = tables[0]
    for table in tables[1:]:
        out = out.union(table)
    return out, borders


def mine(docs: DataFrame, least: int = 100, longest: int = LONGEST, best: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``best`` phrases of each language.

    The lowest-scoring cut counts, the earliest on ties. A phrase that lies inside a longer candidate of
    the same count is left out. Order: score and count descending, then the phrase's bytes.
    """
    counted, borders = phrase_counts(docs, least, longest)
    candidates = counted.where("k >= 2").select("lang", "phrase", "k", F.col("f").alias("a"))
    parts = part_counts(candidates, counted, borders)
    words = F.split("phrase", " ")
    cuts = (candidates.select("*", words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("j"))
            .select("lang", "phrase", "k", "a", "j", F.array_join(F.slice("w", F.lit(1), F.col("j")), " ").alias("one"),
                    F.array_join(F.slice("w", F.col("j") + 1, F.col("k") - F.col("j")), " ").alias("two")))
    cuts = (cuts.join(parts.select("lang", F.col("part").alias("one"), F.col("f").alias("l")), ["lang", "one"])
            .join(parts.select("lang", F.col("part").alias("two"), F.col("f").alias("r")), ["lang", "two"])
            .join(counted.where("k = 0").select("lang", F.col("f").alias("n")), "lang"))
    # 38 digits: 1000 a has at most 18, n 17; l and r 17 each
    score = F.expr("(cast(1000 * a AS decimal(18,0)) * cast(n AS decimal(17,0))) div "
                   "(cast(l AS decimal(17,0)) * cast(r AS decimal(17,0)))")
    scored = (cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n")
              .agg(F.min(F.struct("score", "j", "l", "r")).alias("cut")))
    inner = (candidates.where("k >= 3").select("lang", "a", "k", words.alias("w"))
             .select("lang", "a", F.explode(F.array(F.slice("w", F.lit(1), F.col("k") - 1),
                                                    F.slice("w", F.lit(2), F.col("k") - 1))).alias("w"))
             .groupBy("lang", F.array_join("w", " ").alias("phrase")).agg(F.max("a").alias("longer")))
    # counts only fall with length, so the candidates of one more word decide
    left = scored.join(inner, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a")
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase"))
    return (left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"),
                    F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")))
