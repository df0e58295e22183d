"""Jaccard join of documents on word n-grams by count-vector R-trees.

1. A document is the set of hashes of its distinct 3-word shingles; equal sets are one node.
2. Tokens are hashed into groups. Two sets of Jaccard similarity of at least t whose smaller one
   has m elements differ in at most d = m (1/t - 1) elements, so of d + 1 groups at least one
   holds the same tokens in both. Sets are keyed by (size class, group, its tokens) and meet
   where a key agrees: that is the top of the tree, a partition that Spark can shuffle. A group
   that is empty in both says nothing. With G > d groups at least G - d agree, so a set with fewer empty
   groups than that has an agreeing group that is not empty: it is keyed at a few more groups
   than d + 1 and goes on to more groups only while too many are empty. Of a linked pair both
   are keyed at the step where the first of them ends. In the last step empty groups count.
3. Sets that are connected by keys form a candidate cluster. A small cluster is joined in one task: group
   counts of each set are a point, points are packed into R-tree leaves with bounding boxes, and the overlap
   of two boxes, then of two points, is bounded by the sum of the smaller coordinates. Surviving
   pairs are verified on the sets, unless links found before already connect them.
4. In a large cluster a set that shares some keys with another is first verified against the one it
   shares most with, which makes one class of most copies. Then points, not sets, are dealt into blocks by size, the tree's inner
   nodes; pairs of blocks whose boxes cannot hold a link are dropped, and the others are joined as
   above. Only sets with a surviving partner of another class are sent on. Counts in few groups rule out
   little between sets of thousands of tokens (the larger the counts, the nearer the sum of the smaller ones comes to
   the size), so these are first sent as fine points, with groups in proportion to their size, and
   whole only if a partner survives that too; then they are verified.
5. Links of all tasks give the connected components.

Nothing is capped: large clusters only mean more pairs of blocks, and no task sends out more links than
it has sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from tablesmith.llm.components import components
from tablesmith.llm.storage import beside_texts, saved, small_batches
from tablesmith.llm.words import GOLDEN, MIX_1, WordHashes, ascii_words, mix, ngram_hashes

SHINGLE = 3
LADDER = (1.06, 1.12, 1.25, 1.5, 2.0)
KEY_BITS = 27
STAR_KEYS = 4      # fewer shared keys hardly mean a copy; effort only
GROUP_BITS = 7
GROUPS = 1 << GROUP_BITS
FINE_TOKENS = 8    # at most so many tokens a group of a fine point; effort only
LEAF = 16
BLOCK_TOKENS = 400_000
BLOCK_ROWS = 1024
POINT_BLOCK = 4    # a block of points, in blocks of sets
BAND = math.log(1.05)


class Threshold:
    """Similarity p / q with exact integer tests, and the size classes that belong to it."""

    def __init__(self, similarity: float):
        t = Fraction(similarity).limit_denominator(10_000)
        if not 0 < t <= 1:
            raise ValueError("the similarity must be above 0 and at most 1")
        self.p, self.q = t.numerator, t.denominator
        # below ``first`` elements only equal sets can be linked
        self.first = -(-self.p // (self.q - self.p)) if self.q > self.p else 1 << 62
        self.edges = [self.first]
        while self.edges[-1] < 1 << 40:
            self.edges.append(max(self.edges[-1] + 1, self.edges[-1] * 3 // 2))

    def differing(self, m: int) -> int:
        """How many elements two linked sets can differ in, the smaller having ``m``."""
        return m * (self.q - self.p) // self.p

    def needed(self, a, b):
        """Smallest intersection of linked sets of sizes a and b: ceil(p (a + b) / (p + q))."""
        return -(-self.p * (a + b) // (self.p + self.q))

    def classes(self, size: int) -> list[tuple[int, int]]:
        """(class, number of groups) in which a set of ``size`` is keyed.

        The class of a pair is that of its smaller set, so a set takes part in every class that
        holds a size from t * size to size.
        """
        if size < self.first:
            return []
        low = max(-(-self.p * size // self.q), self.first)
        at = int(np.searchsorted(self.edges, low, "right")) - 1
        out = []
        while self.edges[at] <= size:
            out.append((at, self.differing(self.edges[at + 1] - 1) + 1))
            at += 1
        return out


def ladder(groups: int, smallest: int) -> list[int]:
    """Group counts tried one after another in a class of ``groups`` = d + 1; 0 ends it with empty groups.

    Where even the smallest set of the class leaves hardly a group empty, d + 1 groups will do.
    """
    full = groups * math.exp(-smallest / groups) < 0.05
    return [groups if full else max(groups + 1, math.ceil(groups * LADDER[0])), *[max(groups + 2, math.ceil(groups * x)) for x in LADDER[1:]], 0]


def group_keys(shingles: np.ndarray, threshold: Threshold) -> np.ndarray:
    """Keys of a set; two linked different sets have at least one in common."""
    out = []
    for number, least in threshold.classes(len(shingles)):
        for step, groups in enumerate(ladder(least, threshold.edges[number])):
            last, groups = groups == 0, groups or least
            place = mix(shingles * MIX_1 + np.uint64(step))
            group = (place % np.uint64(groups)).astype(np.int64)
            content, count = np.zeros(groups, np.uint64), np.bincount(group, minlength=groups)
            np.add.at(content, group, mix(place))
            label = np.uint64((number * (len(LADDER) + 1) + step) << 40) + np.arange(groups, dtype=np.uint64)
            keys = mix(content * GOLDEN + mix(label))
            if last:
                out.append(keys)
                break
            out.append(keys[count > 0])
            # least - 1 groups may differ; of the others one is not empty
            if np.count_nonzero(count == 0) <= groups - least:
                break
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def shingle_set(text: str | None, hashes: WordHashes, n: int) -> np.ndarray:
    return np.unique(ngram_hashes(hashes.of(ascii_words(text or "")), n))


def signature(shingles: np.ndarray) -> int:
    """64-bit name of a set; never null, 0 for the empty set."""
    if not len(shingles):
        return 0
    return int(mix(np.array([mix(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))])).view(np.int64)[0]) or 1


def held_keys(keys: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The keys whose bit is set in a mask."""
    slot = keys.view(np.uint64) >> np.uint64(64 - KEY_BITS)
    return keys[(mask[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)]


def sketch(docs: DataFrame, threshold: Threshold, n: int = SHINGLE, mask: Broadcast | None = None) -> DataFrame:
    """doc_id, n_shingles, node (the name of the set) and keys, or those that the mask holds, of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in (whole.slice(at, 512) for whole in batches for at in range(0, whole.num_rows, 512)):
            sizes, nodes, keys = [], [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py(), hashes, n)
                sizes.append(len(shingles))
                nodes.append(signature(shingles))
                own = group_keys(shingles, threshold)
                keys.append(own if mask is None else held_keys(own, mask.value))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "node", "keys"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return small_batches(docs).select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_shingles long, node long, keys array<long>")


def key_mask(keys: DataFrame) -> np.ndarray:
    """One bit per value of the upper KEY_BITS bits of a key, set where ``keys`` holds one: 16 MB, whatever the table."""
    slot = F.shiftrightunsigned("key", 64 - KEY_BITS) + 1
    parts = (keys.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("part"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect())
    mask = np.zeros(1 << (KEY_BITS - 3), np.uint8)
    for part, bits in parts:
        mask[(part - 1) * len(bits):part * len(bits)] = np.frombuffer(bits, np.uint8)
    return mask


def shared_keys(points: DataFrame) -> DataFrame:
    """(key, low): keys of more than one set, and the smallest node of each."""
    rows = points.select("node", F.explode("keys").alias("key"))
    return saved(rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
                 .where("low <> high").select("key", "low"), "shared")


def meetings(points: DataFrame, shared: DataFrame) -> DataFrame:
    """(node, low, n): sets and the smallest node with which each shares n keys."""
    rows = points.select("node", F.explode("keys").alias("key"))
    return saved(rows.join(shared, "key").where("node <> low").groupBy("node", "low").agg(F.count(F.lit(1)).alias("n")), "meetings")


def clusters(met: DataFrame) -> DataFrame:
    """(node, component) of the candidate clusters: different sets connected by shared keys."""
    return components(met.select(F.col("node").alias("a"), F.col("low").alias("b")))


def count_vector(shingles: np.ndarray, bits: int = GROUP_BITS) -> np.ndarray:
    """The point of a set: how many of its tokens fall into each group of equal upper bits."""
    return np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)


def fine_bits(size: int) -> int:
    return max(GROUP_BITS, (-(-size // FINE_TOKENS) - 1).bit_length())


def fine_vector(shingles: np.ndarray) -> np.ndarray:
    """The fine point of a set; sums of neighbouring groups give its coarser points."""
    return count_vector(shingles, fine_bits(len(shingles)))


def packed(counts: np.ndarray) -> bytes:
    """A fine point as bytes; four a group should one not hold every count."""
    return counts.astype(np.uint8 if counts.max() < 256 else "<u4").tobytes()


def unpacked(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8 if len(data) == 1 << fine_bits(size) else "<u4")


class FinePoints:
    """Fine points of a block and the sums of their neighbouring groups, made when first needed."""

    def __init__(self, vectors: list[np.ndarray]):
        self.vectors, self.levels = vectors, {}
        self.bits = np.array([len(v).bit_length() - 1 for v in vectors])

    def at(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(row of each point in the matrix, points of 2 ** bits groups of those that have as many)."""
        if bits not in self.levels:
            has = self.bits >= bits
            self.levels[bits] = np.cumsum(has) - 1, np.stack(
                [v.reshape(1 << bits, -1).sum(1, dtype=np.int32) for v, own in zip(self.vectors, has) if own])
        return self.levels[bits]


class Tree:
    """Bulk-loaded R-tree over points of one block: leaves of neighbours in size and direction."""

    def __init__(self, points: np.ndarray, fine: FinePoints | None = None):
        self.points, self.sizes, self.fine = points, points.sum(1, dtype=np.int64), fine
        order = np.lexsort((*points[:, :4].T, self.sizes))
        self.leaves = [order[i:i + LEAF] for i in range(0, len(order), LEAF)]
        self.high = np.stack([points[leaf].max(0) for leaf in self.leaves])
        self.low_size = np.array([self.sizes[leaf].min() for leaf in self.leaves])

    @classmethod
    def of_fine(cls, vectors: list[np.ndarray]) -> Tree:
        fine = FinePoints(vectors)
        return cls(fine.at(GROUP_BITS)[1], fine)


def fine_partners(a: Tree, b: Tree, x: int, rest: np.ndarray, t: Threshold) -> np.ndarray:
    """Rows of ``rest`` that row x of a may be linked with by the finest groups that both have."""
    bits = np.minimum(a.fine.bits[x], b.fine.bits[rest])
    keep = np.ones(len(rest), bool)
    for level in np.unique(bits[bits > GROUP_BITS]).tolist():
        (own, left), (row, right), mine = a.fine.at(level), b.fine.at(level), np.flatnonzero(bits == level)
        both = np.minimum(left[own[x]], right[row[rest[mine]]]).sum(1)
        keep[mine] = both >= t.needed(a.sizes[x], b.sizes[rest[mine]])
    return rest[keep]


def near_points(a: Tree, b: Tree, name_a: np.ndarray, name_b: np.ndarray, t: Threshold) -> Iterator[tuple[int, np.ndarray]]:
    """(row of a, rows of b of another name that it may be linked with).

    A pair of leaves is skipped if the summed minima of their upper corners cannot reach the
    overlap that their smallest sets need; so is a pair of points by its own summed minima, then by those
    of its fine points if the trees hold them. Names are read when a row's turn comes.
    """
    for i, leaf in enumerate(a.leaves):
        bound = np.minimum(a.high[i], b.high).sum(1)
        near = np.flatnonzero(bound >= t.needed(a.low_size[i], b.low_size))
        if not len(near):
            continue
        others = np.concatenate([b.leaves[j] for j in near])
        for x in leaf:
            rest = others[(name_b[others] != name_a[x]) & (np.minimum(a.sizes[x], b.sizes[others]) >= t.needed(a.sizes[x], b.sizes[others]))]
            if len(rest):
                rest = rest[np.minimum(a.points[x], b.points[rest]).sum(1) >= t.needed(a.sizes[x], b.sizes[rest])]
            if len(rest) and a.fine and b.fine:
                rest = fine_partners(a, b, x, rest, t)
            if len(rest):
                yield int(x), rest


def linked(x: np.ndarray, y: np.ndarray, t: Threshold) -> bool:
    return len(np.intersect1d(x, y, assume_unique=True)) >= t.needed(len(x), len(y))


def join_sets(a: list[np.ndarray], b: list[np.ndarray], name_a: np.ndarray, name_b: np.ndarray, t: Threshold) -> list[tuple[int, int]]:
    """Links between two blocks that suffice to connect all sets that are linked.

    Equal names are connected already; of one block, both names are the same array. The arrays are changed.
    """
    links, tree = [], Tree.of_fine([fine_vector(s) for s in a])
    for x, rest in near_points(tree, tree if b is a else Tree.of_fine([fine_vector(s) for s in b]), name_a, name_b, t):
        for y in rest:
            if name_a[x] != name_b[y] and linked(a[x], b[y], t):
                links.append((x, int(y)))
                old, new = name_b[y], name_a[x]
                name_b[name_b == old] = new
                name_a[name_a == old] = new
    return links


def candidate_sets(docs: DataFrame, one: DataFrame, n: int) -> DataFrame:
    """component, node, shingles, counts and fine (packed fine point) of the rows of ``one``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in (whole.slice(at, 512) for whole in batches for at in range(0, whole.num_rows, 512)):
            found = [shingle_set(text.as_py(), hashes, n) for text in batch.column("text")]
            own = [signature(s) == node for s, node in zip(found, batch.column("node").to_pylist())]  # not so if ids repeat
            counts = [count_vector(s) for s in found]
            rows = pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("component", "node")],
                 pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int32())),
                 pa.array([packed(fine_vector(s)) for s in found], pa.binary())],
                ["component", "node", "shingles", "counts", "fine"])
            yield rows.filter(pa.array(own, pa.bool_()))

    ready = docs.select("doc_id", "text").join(beside_texts(one), "doc_id").select("component", "node", "text")
    return ready.mapInArrow(run, "component long, node long, shingles array<long>, counts array<int>, fine binary")


def star_links(sets: DataFrame, stars: DataFrame, t: Threshold) -> DataFrame:
    """(a, b) where the set of a node reaches the threshold with that of its center.

    ``stars``: node, center. A center of many nodes is sent once per BLOCK_ROWS of them, and
    rows of a center pass one by one, so no group is held.
    """
    copies = F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("copies")
    centers = saved(stars.groupBy("center").agg(copies), "centers")
    hub = (sets.join(beside_texts(centers.withColumnRenamed("center", "node")), "node")
           .select(F.col("node").alias("center"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"),
                   F.lit(0).alias("role"), "node", "shingles"))
    spokes = (sets.join(beside_texts(stars.join(centers, "center")), "node")
              .select("center", F.pmod(F.xxhash64("node"), F.col("copies")).cast("int").alias("copy"), F.lit(1).alias("role"),
                      "node", "shingles"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        center, held = None, None
        for batch in batches:
            out, values = [], batch.column("shingles")
            for row, (key, role, node) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("center", "role", "node")])):
                mine = values[row].values.to_numpy()
                if role == 0:
                    center, held = key, mine
                elif center == key and linked(mine, held, t):
                    out.append((node, key))
            a, b = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    rows = hub.union(spokes).repartition("center", "copy").sortWithinPartitions("center", "copy", "role")
    return saved(small_batches(rows).mapInArrow(run, "a long, b long"), "stars")


def point_blocks(sets: DataFrame, one: DataFrame, near: DataFrame) -> DataFrame:
    """component, block, node, class, size and counts of wide clusters.

    Blocks follow the size of the sets: sets of a cluster are counted by narrow bands of
    sizes, a running total over the (boundedly many) bands says where a band begins, and a
    set's hash says where in its band it lies.
    """
    weight = F.greatest(F.lit(1.0) / BLOCK_ROWS, F.col("n_shingles") / float(BLOCK_TOKENS))
    flat = (one.select("component", "node", "n_shingles", weight.alias("w"), F.floor(F.log("n_shingles") / BAND).alias("band"))
            .join(near.select("node", F.col("component").alias("class")), "node", "left"))
    order = Window.partitionBy("component").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = (flat.groupBy("component", "band").agg(F.sum("w").alias("width"))
             .withColumn("before", F.coalesce(F.sum("width").over(order), F.lit(0.0))))
    spot = F.col("before") + F.col("width") * F.pmod(F.xxhash64("node"), F.lit(1 << 20)) / (1 << 20)
    place = flat.join(bands, ["component", "band"]).select(
        "node", F.coalesce("class", "node").alias("class"), F.floor(spot / POINT_BLOCK).cast("int").alias("block"))
    return saved(sets.select("component", "node", F.size("shingles").alias("size"), "counts").join(beside_texts(place), "node")
                 .select("component", "block", "node", "class", "size", "counts"), "blocks")


def block_pairs(blocks: DataFrame, t: Threshold) -> DataFrame:
    """component, block, i, j: the pairs of blocks (i <= j) whose boxes can hold a link, once per side."""
    corner = F.array(*[F.max(F.col("counts")[g]) for g in range(GROUPS)])
    boxes = saved(blocks.groupBy("component", "block").agg(
        F.min("size").cast("long").alias("low"), F.max("size").cast("long").alias("high"), corner.alias("corner")), "boxes")
    a, b = [boxes.select("component", *[F.col(c).alias(f"{c}_{side}") for c in ("block", "low", "high", "corner")]) for side in "ab"]
    bound = F.aggregate(F.zip_with("corner_a", "corner_b", lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda total, x: total + x)
    sizes = F.least("high_a", "high_b", bound) * (t.p + t.q) >= (F.col("low_a") + F.col("low_b")) * t.p
    ratio = (F.col("high_a") * t.q >= F.col("low_b") * t.p) & (F.col("high_b") * t.q >= F.col("low_a") * t.p)
    return (a.join(b, "component").where("block_a <= block_b").where(sizes & ratio)
            .select("component", F.explode(F.array_distinct(F.array("block_a", "block_b"))).alias("block"),
                    F.col("block_a").alias("i"), F.col("block_b").alias("j")))


def _sides(key: tuple, table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """Table ordered by node, rows of block i and of block j (a node once), and the rows' classes."""
    table = table.sort_by("node").combine_chunks()
    nodes, block = table.column("node").to_numpy(), table.column("block").to_numpy()
    once = np.append(True, nodes[1:] != nodes[:-1])[:len(nodes)]
    left, right = [np.flatnonzero((block == k.as_py()) & once) for k in key[1:3]]
    return table, left, right, table.column("class").to_numpy()


def partners(points: DataFrame, t: Threshold, fine: bool = False) -> DataFrame:
    """component, i, j, block, node, class of the points that have a partner in a pair of blocks.

    ``points``: these columns and counts, or size and fine.
    """
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table, left, right, names = _sides(key, table)
        busy = np.zeros(table.num_rows, bool)
        if len(left) and len(right):
            if fine:
                vectors = [unpacked(v, n) for v, n in zip(table.column("fine").to_pylist(), table.column("size").to_pylist())]
                a, b = [Tree.of_fine([vectors[k] for k in side]) for side in (left, right)]
            else:
                points = table.column("counts").combine_chunks().values.to_numpy().reshape(-1, GROUPS)
                a, b = Tree(points[left]), Tree(points[right])
            for x, rest in near_points(a, b, names[left], names[right], t):
                busy[left[x]] = True
                busy[right[rest]] = True
        return table.filter(pa.array(busy)).select(["component", "i", "j", "block", "node", "class"])

    return points.groupBy("component", "i", "j").applyInArrow(run, "component long, i int, j int, block int, node long, class long")


def verified(cells: DataFrame, t: Threshold) -> DataFrame:
    """(a, b) links within each pair of blocks: component, i, j, block, node, class, shingles."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table, left, right, names = _sides(key, table)
        nodes, lists = table.column("node").to_numpy(), table.column("shingles").combine_chunks()
        ends, values = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
        pairs = []
        if len(left) and len(right):
            a = [values[ends[k]:ends[k + 1]] for k in left]
            name_a = names[left].copy()
            one = key[1] == key[2]
            pairs = join_sets(a, a if one else [values[ends[k]:ends[k + 1]] for k in right],
                              name_a, name_a if one else names[right].copy(), t)
        return pa.table({"a": pa.array([int(nodes[left[x]]) for x, _ in pairs], pa.int64()),
                         "b": pa.array([int(nodes[right[y]]) for _, y in pairs], pa.int64())})

    return cells.groupBy("component", "i", "j").applyInArrow(run, "a long, b long")


def links(docs: DataFrame, points: DataFrame, met: DataFrame, t: Threshold, n: int = SHINGLE) -> DataFrame:
    """(a, b) nodes whose sets reach the threshold, enough of them to connect every group."""
    one = points.join(clusters(met), "node").groupBy("node", "component", "n_shingles").agg(F.min("doc_id").alias("doc_id"))
    size = one.groupBy("component").agg(
        ((F.count(F.lit(1)) > BLOCK_ROWS) | (F.sum("n_shingles") > BLOCK_TOKENS)).alias("wide"))
    one = saved(one.join(size, "component"), "candidates")
    zero = F.lit(0)
    small = candidate_sets(docs, one.where("NOT wide").select("doc_id", "component", "node"), n)
    found = verified(small.select("component", zero.alias("i"), zero.alias("j"), zero.alias("block"), "node",
                                  F.col("node").alias("class"), "shingles"), t)
    many = one.where("wide")
    if many.isEmpty():
        return found
    sets = saved(candidate_sets(docs, many.select("doc_id", "component", "node"), n), "sets")
    stars = (met.groupBy("node").agg(F.max(F.struct("n", "low")).alias("most")).where(F.col("most.n") >= STAR_KEYS)
             .join(many.select("node"), "node").select("node", F.col("most.low").alias("center")))
    near = star_links(sets.select("node", "shingles"), stars, t)
    blocks = point_blocks(sets, many, components(near))
    busy = partners(blocks.join(beside_texts(block_pairs(blocks, t)), ["component", "block"]), t)
    busy = partners(sets.select("node", F.size("shingles").alias("size"), "fine").join(beside_texts(busy), "node"), t, fine=True)
    cells = sets.select("node", "shingles").join(beside_texts(busy), "node").select(
        "component", "i", "j", "block", "node", "class", "shingles")
    return found.union(near).union(verified(cells, t))


def join(docs: DataFrame, similarity: float = 0.9, n: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links, itself included).

    Null, empty and wordless texts have no shingles and link with nothing; fewer than ``n`` words
    are one shingle. Copies link as equal sets. A null id is left out of the components, and
    its row gets a null component; rows that repeat an id count as one document.
    """
    t = Threshold(similarity)
    some = "node <> 0 AND doc_id IS NOT NULL"
    # keys go out once, to find those of more than one set; only keys that a mask of these holds are kept
    shared = shared_keys(sketch(docs, t, n).where(some))
    mask = docs.sparkSession.sparkContext.broadcast(key_mask(shared))
    points = saved(sketch(docs, t, n, mask), "points")
    named = points.where(some)
    connected = components(links(docs, named, meetings(named, shared), t, n))
    # documents and sets as one graph: a set stands for its documents, components join sets
    group = F.coalesce("component", "node")
    keyed = (named.select("doc_id", "n_shingles", "node").join(connected, "node", "left")
             .select("doc_id", "n_shingles", group.alias("group")))
    smallest = keyed.groupBy("group").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("rows"))
    more = saved(smallest.where("rows > 1").drop("rows"), "groups")
    placed = keyed.join(more, "group", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    alone = points.where("node = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return placed.union(alone)
