"""Near-duplicate vectors by product quantisation over coarse inverted lists.

Vectors of unit length go to the inverted list of their nearest coarse centroid; the residual is
coded by the nearest codeword in each subspace. A query visits every list that can hold a vector
within the radius of the wanted cosine: a member is nearer to its list's centroid c than to the
query's own centroid h, so c is left out only if the query is further than the radius from the
plane halfway between c and h. The table of distances from its residual to all codewords gives
the distance to a coded member as a sum of look-ups. A member is kept if that distance does not
exceed the radius plus the member's own coding error (triangle inequality), and kept pairs are
compared by exact cosine in double precision. No linked pair is lost, whatever the data's shape;
where lists overlap much, the comparisons grow with the square of the vectors.

Lists are packed into shelves of about BLOCK members; a query is sent once to each shelf that has
a list it visits, and only to its own and later ones, so each pair of shelves meets once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablesmith.llm.components import components
from tablesmith.llm.storage import saved

SUBSPACES = 8
CODEWORDS = 64
MAX_LISTS = 4096
BLOCK = 4096   # members of a shelf in one task
CHUNK = 4096   # queries of a shelf in one task
SLICE = 256    # queries compared at a time
SLACK = 1e-6   # rounding of distances


def k_means(rows: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)].copy()
    for _ in range(rounds):
        nearest = nearest_of(rows, centres)
        count = np.bincount(nearest, minlength=len(centres))
        order = np.argsort(nearest, kind="stable")
        used = np.flatnonzero(count)
        starts = np.concatenate([[0], np.cumsum(count[used])[:-1]])
        centres[used] = np.add.reduceat(rows[order], starts) / count[used, None]
    return centres


def distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances up to the rows' own squared length."""
    return (centres ** 2).sum(1) - 2 * rows @ centres.T


def nearest_of(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([distances(rows[i:i + 4096], centres).argmin(1) for i in range(0, len(rows), 4096)]
                          or [np.zeros(0, np.int64)])


@dataclass(frozen=True)
class Index:
    """Coarse centroids and, per subspace, codewords of residuals; bounds are parameters."""

    lists: np.ndarray
    codewords: list[np.ndarray]

    def parts(self) -> list[slice]:
        cuts = [self.lists.shape[1] * i // len(self.codewords) for i in range(len(self.codewords) + 1)]
        return [slice(a, b) for a, b in zip(cuts, cuts[1:])]

    def encode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, length of the coding error) of each row."""
        home = nearest_of(rows, self.lists)
        residual = rows - self.lists[home]
        codes = np.empty((len(rows), len(self.codewords)), np.uint8)
        for s, (part, words) in enumerate(zip(self.parts(), self.codewords)):
            codes[:, s] = nearest_of(residual[:, part], words)
            residual[:, part] -= words[codes[:, s]]
        return home, codes, np.sqrt((residual ** 2).sum(1))


def fit(sample: np.ndarray, n_lists: int, seed: int = 1) -> Index:
    rng = np.random.default_rng(seed)
    lists = k_means(sample, n_lists, 8, rng)
    index = Index(lists, [])
    residual = sample - lists[nearest_of(sample, lists)]
    dims = sample.shape[1]
    cuts = [dims * i // min(SUBSPACES, dims) for i in range(min(SUBSPACES, dims) + 1)]
    words = [k_means(residual[:, a:b], CODEWORDS, 8, rng) for a, b in zip(cuts, cuts[1:])]
    return Index(index.lists, words)


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose vector can link: not null, no null or non-finite component, not all zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return (vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL")
            .where(~F.exists("embedding", bad) & F.exists("embedding", lambda x: x != 0)))


def unit(rows: pa.Array) -> np.ndarray:
    """Rows scaled to length 1 in double precision, first by the largest component."""
    dense = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)
    dense = dense / np.abs(dense).max(1, keepdims=True)
    return dense / np.sqrt((dense ** 2).sum(1, keepdims=True))


def visited(rows: np.ndarray, home: np.ndarray, lists: np.ndarray, radius: float) -> np.ndarray:
    """Row x list: whether a member of the list can lie within ``radius`` of the row."""
    d = distances(rows, lists)
    own = lists[home]
    gap = np.sqrt(np.maximum((own ** 2).sum(1)[:, None] + distances(own, lists), 0))
    return d - d[np.arange(len(rows)), home][:, None] <= 2 * radius * gap + SLACK


def shelves(lists: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Shelf of each list; neighbouring lists share one until it has about BLOCK members."""
    anchors = k_means(lists, max(1, -(-int(sizes.sum()) // BLOCK)), 8, np.random.default_rng(1))
    order = np.argsort(nearest_of(lists, anchors), kind="stable")
    before = np.cumsum(sizes[order]) - sizes[order]
    out = np.empty(len(lists), np.int64)
    out[order] = before // BLOCK
    return out


def _homes(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                home = nearest_of(unit(whole.slice(at, 4096).column("embedding")), shared.value.lists)
                yield pa.RecordBatch.from_arrays([pa.array(home.astype(np.int32))], ["home"])

    return run


def _index_rows(shared, shelf: np.ndarray, radius: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        order = np.argsort(shelf, kind="stable")
        names, starts = np.unique(shelf[order], return_index=True)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                rows = unit(batch.column("embedding"))
                home, codes, error = index.encode(rows)
                open_ = np.logical_or.reduceat(visited(rows, home, index.lists, radius)[:, order], starts, 1)
                visits = [names[v & (names >= own)].astype(np.int32) for v, own in zip(open_, shelf[home])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep"), batch.column("copies"), pa.array(home.astype(np.int32)),
                     pa.array(shelf[home].astype(np.int32)), pa.array(visits, pa.list_(pa.int32())),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error),
                     pa.array([r.tobytes() for r in rows], pa.binary())],
                    ["rep", "copies", "home", "shelf", "visits", "codes", "error", "vector"])

    return run


def _spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node reachable from each of n nodes over edges (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _similar(q: np.ndarray, x: np.ndarray, maybe: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs that are ``maybe`` similar reach the cosine; close calls are summed pair by pair."""
    out = np.zeros(maybe.shape, bool)
    rows, cols = np.flatnonzero(maybe.any(1)), np.flatnonzero(maybe.any(0))
    if len(rows):
        part = np.ix_(rows, cols)
        cosine = q[rows] @ x[cols].T
        out[part] = maybe[part] & (cosine >= threshold + 1e-9)
        close_q, close_x = np.nonzero(maybe[part] & (np.abs(cosine - threshold) < 1e-9))
        for at in range(0, len(close_q), 4096):
            i, j = rows[close_q[at:at + 4096]], cols[close_x[at:at + 4096]]
            out[i, j] = np.einsum("ij,ij->i", q[i], x[j]) >= threshold
    return out


def _compare(shared, threshold: float, radius: float):
    def run(key: tuple, members: pa.Table, queries: pa.Table) -> pa.Table:
        empty = pa.table({"id": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        if not members.num_rows or not queries.num_rows:
            return empty
        index, here = shared.value, key[0].as_py()
        m_id, q_id = members.column("rep").to_numpy(), queries.column("q_rep").to_numpy()
        m_copies, q_copies = members.column("copies").to_numpy(), queries.column("q_copies").to_numpy()
        wide = lambda c: np.frombuffer(b"".join(c.to_pylist()), np.float64).reshape(len(c), -1)
        x, q = wide(members.column("vector")), wide(queries.column("q_vector"))
        codes = np.frombuffer(b"".join(members.column("codes").to_pylist()), np.uint8).reshape(len(x), -1)
        error, home = members.column("error").to_numpy(), members.column("home").to_numpy()
        q_home = queries.column("q_home").to_numpy()
        # a query of this shelf is a member of it too and is counted there; a guest's links count on both sides
        guest = queries.column("q_shelf").to_numpy() != here
        nodes, where = np.unique(np.concatenate([q_id, m_id]), return_inverse=True)
        node_q, node_m = where[:len(q)], where[len(q):]
        links, label, parts = np.zeros(len(nodes), np.int64), np.arange(len(nodes)), index.parts()
        held = [(c, np.flatnonzero(home == c)) for c in np.unique(home)]
        # |q - c - w|^2 = |q - c|^2 + (|w|^2 + 2 c w) - 2 q w: the middle term belongs to the member, and the
        # tables of q w (query x codeword) serve every list
        coded = np.hstack([index.codewords[s][codes[:, s]] for s in range(len(parts))])
        own = (coded ** 2).sum(1) + 2 * np.einsum("ij,ij->i", coded, index.lists[home])
        for at in range(0, len(q), SLICE):
            mask = visited(q[at:at + SLICE], q_home[at:at + SLICE], index.lists, radius)
            away = distances(q[at:at + SLICE], index.lists) + (q[at:at + SLICE] ** 2).sum(1)[:, None]
            tables = [q[at:at + SLICE, part] @ words.T for part, words in zip(parts, index.codewords)]
            for c, m in held:
                rows = np.flatnonzero(mask[:, c])
                if not len(rows):
                    continue
                near, product = at + rows, np.zeros((len(rows), len(m)))
                for k, table in enumerate(tables):
                    product += table[rows].take(codes[m, k], 1)
                total = np.maximum(away[rows, c][:, None] + own[m] - 2 * product, 0)
                maybe = (np.sqrt(total) <= radius + error[m]) & (node_q[near][:, None] != node_m[m])
                sure = _similar(q[near], x[m], maybe, threshold)
                a, b = np.nonzero(sure)
                if not len(a):
                    continue
                np.add.at(links, node_q[near], sure @ m_copies[m])
                np.add.at(links, node_m[m], (q_copies[near] * guest[near]) @ sure)
                low, high = label[node_q[near[a]]], label[node_m[m[b]]]
                new = low != high
                if new.any():
                    label = _spanning(len(nodes), low[new], high[new])[label]
        used = (links > 0) | (label != np.arange(len(nodes)))
        return pa.table({"id": nodes[used], "links": links[used], "root": nodes[label[used]]})

    return run


def link(vectors: DataFrame, threshold: float = 0.95, sample_rows: int = 20_000) -> DataFrame:
    """vec_id, n_links, component_id, kept for every vector (vec_id long, embedding array).

    The index is fitted on at most about ``sample_rows`` distinct vectors (a hash sample; with
    fewer vectors, all of them) and holds every vector. Equal vectors are one indexed row with a
    number of copies. Vectors of different lengths never link. A null, zero or non-finite
    vector, or one with a null component, links with nothing; a null id gets null component
    and kept. Rows that repeat an id count as one vector of the component.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    reps = saved(usable(rows).groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")),
                 "vectors")
    found = None
    for dims, n in sorted(tuple(r) for r in reps.groupBy(F.size("embedding")).count().collect()):
        part = _links(reps.where(F.size("embedding") == dims), n, threshold, sample_rows)
        found = part if found is None else found.union(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "id long, links long, root long")
    found = saved(found, "links")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    known = (reps.join(counts, F.col("rep") == F.col("id"), "left").join(groups, F.col("rep") == F.col("node"), "left")
             .select("embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id"))
             .where("n_links > 0"))
    able = usable(rows)
    placed = (able.join(known, "embedding", "left")
              .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component_id", "vec_id").alias("component_id")))
    unable = (rows.where(F.col("vec_id").isNull() | F.col("embedding").isNull()
                         | F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
                         | ~F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False)))
              .select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return placed.union(unable).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _links(reps: DataFrame, n: int, threshold: float, sample_rows: int) -> DataFrame:
    """(id, links, root) found in every pair of a shelf block and a chunk of its queries."""
    spark = reps.sparkSession
    share = min(1.0, sample_rows / n)
    sample = (reps.where(F.pmod(F.xxhash64("embedding"), F.lit(1_000_000)) < 1e6 * share)
              .select("embedding").toArrow().column("embedding").combine_chunks())
    if not len(sample):
        sample = reps.limit(1).select("embedding").toArrow().column("embedding").combine_chunks()
    rows = unit(sample)
    rows = rows[np.lexsort(rows.T)]  # the same order in every run
    index = fit(rows, max(1, min(MAX_LISTS, int(2 * math.sqrt(n)), len(rows) // 8)))
    shared = spark.sparkContext.broadcast(index)
    radius = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    sizes = np.zeros(len(index.lists), np.int64)
    for home, count in reps.mapInArrow(_homes(shared), "home int").groupBy("home").count().collect():  # at most MAX_LISTS rows
        sizes[home] = count
    coded = saved(reps.mapInArrow(_index_rows(shared, shelves(index.lists, sizes), radius), "rep long, copies long, home int, "
                                  "shelf int, visits array<int>, codes binary, error double, vector binary"), "codes")
    # a row of counts for each shelf: how many blocks and chunks it needs
    members = coded.groupBy("shelf").agg(F.count(F.lit(1)).alias("m"))
    visits = coded.select(F.explode("visits").alias("shelf")).groupBy("shelf").agg(F.count(F.lit(1)).alias("v"))
    plan = F.broadcast(members.join(visits, "shelf").select(
        "shelf", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("v") / CHUNK).cast("int").alias("chunks")))
    spread = lambda salt, count: F.pmod(F.xxhash64("rep", F.lit(salt)), F.col(count)).cast("int")
    left = (coded.join(plan, "shelf").withColumn("block", spread(1, "blocks"))
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select("shelf", "block", "chunk", "rep", "copies", "home", "codes", "error", "vector"))
    right = (coded.select("rep", "copies", "home", F.col("shelf").alias("own"), "vector", F.explode("visits").alias("shelf"))
             .join(plan, "shelf").withColumn("chunk", spread(2, "chunks"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(*[F.col(c).alias(f"q_{c}") for c in ("rep", "copies", "home", "vector")], F.col("own").alias("q_shelf"),
                     F.col("shelf").alias("q_place"), F.col("block").alias("q_block"), F.col("chunk").alias("q_chunk")))
    return (left.groupBy("shelf", "block", "chunk").cogroup(right.groupBy("q_place", "q_block", "q_chunk"))
            .applyInArrow(_compare(shared, threshold, radius), "id long, links long, root long"))
