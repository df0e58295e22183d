"""Nearest neighbours by largest inner product: p-stable hashing with many probes per table.

Inner products become distances: with ``M`` the largest length of a stored vector, a row ``x``
is the unit vector ``(x, sqrt(M^2 - |x|^2)) / M`` and a query ``q`` is ``(q, 0) / |q|``, so the
nearest row has the largest product. Every table has ``K`` hashes ``floor((a . v + b) / W)``
with normal ``a``; a row's bucket is the tuple of its ``K`` slots.

A query visits perturbed buckets in the order of their estimated success: a neighbour at
distance ``d`` moves each projection by a normal step of width ``d``, so the chance of a bucket is
a product of ``K`` normal masses. The query's chance limit is the one at which the buckets above it
hold a neighbour with probability ``recall`` over all tables (a quantile over drawn steps); every
bucket above the limit is visited, so nothing is capped. ``d`` is the query's distance to the row of
matching rank in a bounded sample of ``SAMPLE`` rows, which sets the effort only: every row
is indexed and every visited candidate is scored exactly on the original vectors. Scores below
those of ``1.5 k`` rows of the sample are not sent on: they cannot be among the nearest.

On Spark: equal vectors are one class with its smallest ids, so copies cost nothing. Classes and
queries are dealt by (table, first slots of the bucket), and cells with many rows or queries are
cut into blocks of ``CELL_ROWS`` x ``CELL_QUERIES`` by a hash of the class. A block finds
the visited buckets of its queries, scores the rows in them and keeps each query's best; these
are merged over tables and cells. Vectors are shuffled once per table; no pairs are shuffled but the
best of each block. Queries that found too few go through all cells of one table.

Vectors that are null, all zero or hold null or non-finite components, and rows without an id,
take no part. Vectors of another length are no candidates. Repeated rows count once; an id with
several usable vectors has the smallest of them (in array order). Empty tables give an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tablesmith.llm.storage import saved
from tablesmith.operators.relational import attach

TABLES = 3
WIDTH = 1.5           # slot width; unit vectors project to a standard normal
RECALL = 0.95
SAMPLE = 16_384       # rows of the sample that sets the effort, and at most SAMPLE_BYTES of them
SAMPLE_BYTES = 32 << 20
DRAWS = 512
CELL_ROWS, CELL_QUERIES, SLICE = 8192, 4096, 128
REACH = 6.0           # slots further away than this many steps are not enumerated for cells


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part, one per id.

    Ids are counted first, so that vectors are grouped by id only where ids repeat.
    """
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    rows = (vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL")
            .where(~F.exists("embedding", bad) & F.exists("embedding", lambda x: x != 0))
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v")))
    again = saved(rows.groupBy("vec_id").count().where("count > 1").select("vec_id"), "repeated")
    if again.isEmpty():
        return rows
    one = rows.join(again, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("v").alias("v"))
    return rows.join(again, "vec_id", "left_anti").union(one)


def classes(rows: DataFrame, wanted: Column, k: int) -> DataFrame:
    """Equal vectors as one class: cls, v, its ``k + 1`` smallest ids and whether a query has it.

    Ranks are limited in every task before the shuffle, so a vector that a third of the rows share
    sends a few rows from each task.
    """
    both = rows.withColumn("kind", F.lit(0)).union(rows.where(wanted).withColumn("kind", F.lit(1)))
    order = Window.partitionBy("v", "kind").orderBy("vec_id")
    few = both.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= k + 1)
    one = few.groupBy("v").agg(F.array_sort(F.collect_set(F.when(F.col("kind") == 0, F.col("vec_id")))).alias("members"),
                               (F.max("kind") == 1).alias("asks"))
    square = F.aggregate("v", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    return saved(one.select(F.monotonically_increasing_id().alias("cls"), "v", F.size("v").alias("dim"),
                            F.sqrt(square).alias("norm"), "members", "asks"), "classes")


def normal_cdf(x: np.ndarray) -> np.ndarray:
    """Distribution function of the standard normal to 1e-7 (a published rational approximation)."""
    # Coefficients of the error function's approximation.
    p, a = 0.3275911, (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    z = np.abs(x) / math.sqrt(2.0)
    t = 1.0 / (1.0 + p * z)
    poly = t * (a[0] + t * (a[1] + t * (a[2] + t * (a[3] + t * a[4]))))
    return 0.5 + 0.5 * np.sign(x) * (1.0 - poly * np.exp(-z * z))


class Hashes:
    """The hash functions of all tables for one vector length; a function of its parameters."""

    def __init__(self, dim: int, bits: int, coarse: int, longest: float, tables: int = TABLES, seed: int = 1):
        rng = np.random.default_rng([seed, dim])
        self.dim, self.bits, self.coarse, self.longest, self.tables = dim, bits, coarse, longest, tables
        self.directions = rng.normal(size=(tables, dim + 1, bits))
        self.offsets = rng.uniform(0, WIDTH, (tables, bits))
        self.steps = rng.normal(size=(DRAWS, bits))

    def rows(self, v: np.ndarray) -> np.ndarray:
        """Stored vectors on the unit sphere of one more dimension."""
        v = v / self.longest
        return np.column_stack([v, np.sqrt(np.maximum(0.0, 1.0 - (v * v).sum(1)))])

    def queries(self, v: np.ndarray) -> np.ndarray:
        v = v / np.abs(v).max(1, keepdims=True)
        return np.column_stack([v / np.sqrt((v * v).sum(1, keepdims=True)), np.zeros(len(v))])

    def project(self, points: np.ndarray, table: int) -> np.ndarray:
        return points @ self.directions[table] + self.offsets[table]

    def slots(self, points: np.ndarray, table: int) -> np.ndarray:
        return np.floor(self.project(points, table) / WIDTH).astype(np.int64)


def chance(projected: np.ndarray, slots: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Log probability that a neighbour at distance ``d`` falls into a slot of one hash."""
    low = (slots * WIDTH - projected) / d
    mass = normal_cdf(low + WIDTH / d) - normal_cdf(low)
    return np.log(np.maximum(mass, 1e-12))


def limits(projected: np.ndarray, d: np.ndarray, steps: np.ndarray, recall: float, tables: int) -> np.ndarray:
    """Log chance above which the buckets of one table hold a neighbour often enough."""
    total = np.zeros((len(projected), len(steps)))
    for k in range(projected.shape[1]):
        here = projected[:, k:k + 1]
        slots = np.floor((here + d[:, None] * steps[None, :, k]) / WIDTH)
        total += chance(here, slots, d[:, None])
    share = 1.0 - (1.0 - recall) ** (1.0 / tables)
    return np.quantile(total, 1.0 - share, axis=1) - 1e-9


def cells_of(projected: np.ndarray, d: np.ndarray, limit: np.ndarray, coarse: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, first ``coarse`` slots) of all cells that can hold a bucket above the limit."""
    n, bits = projected.shape
    reach = int(math.ceil(REACH * float(d.max(initial=0.0)) / WIDTH)) + 1
    around = np.arange(-reach, reach + 1)
    slots = np.floor(projected / WIDTH).astype(np.int64)[:, :, None] + around
    logs = chance(projected[:, :, None], slots, d[:, None, None])
    best = logs.max(2)
    rest = np.concatenate([np.cumsum(best[:, ::-1], 1)[:, ::-1], np.zeros((n, 1))], 1)
    who, total, found = np.arange(n), np.zeros(n), np.zeros((n, 0), np.int64)
    for k in range(coarse):
        longer = total[:, None] + logs[who, k]
        keep = longer + rest[who, k + 1][:, None] >= limit[who][:, None]
        row, col = np.nonzero(keep)
        found = np.column_stack([found[row], slots[who[row], k, col]])
        who, total = who[row], longer[row, col]
    return who, found


def dense(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of equally long lists as a matrix in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            yield int(dim), batch.filter(pa.array(dims == dim))


CELL = ["dim", "tab", "cell"]
PLACED = "dim int, tab int, cell string, cls long, first long, v array<{0}>"


def _names(slots: np.ndarray) -> list[str]:
    return [",".join(map(str, row)) for row in slots.tolist()]


def place_rows(table: DataFrame, shared) -> DataFrame:
    """Every class in its cell of every table."""
    def run(batches):
        for dim, batch in _by_length(batches):
            hashes: Hashes = shared.value[0][dim]
            points = hashes.rows(dense(batch.column("v")))
            for t in range(hashes.tables):
                cell = _names(hashes.slots(points, t)[:, :hashes.coarse])
                n = len(cell)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("dim"), pa.array(np.full(n, t, np.int32)), pa.array(cell, pa.string()),
                     batch.column("cls"), batch.column("first"), batch.column("v")],
                    ["dim", "tab", "cell", "cls", "first", "v"])

    kind = table.schema["v"].dataType.elementType.simpleString()
    return table.select("dim", "cls", F.col("members")[0].alias("first"), "v").mapInArrow(run, PLACED.format(kind))


def place_queries(table: DataFrame, shared, k: int, everything: bool) -> DataFrame:
    """Every query class in each cell that it visits, with its distance and chance limit.

    With ``everything`` all cells of the first table are to be visited: one row without a cell.
    """
    def run(batches):
        for dim, batch in _by_length(batches):
            hashes, sample, total = (s[dim] for s in shared.value)
            points = hashes.queries(dense(batch.column("v")))
            if everything:
                n = len(points)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("dim"), pa.array(np.zeros(n, np.int32)), pa.nulls(n, pa.string()), batch.column("cls"),
                     batch.column("v"), pa.array(np.ones(n)), pa.array(np.full(n, -1e300)), pa.array(np.full(n, -np.inf))],
                    ["dim", "tab", "cell", "cls", "v", "d", "limit", "least"])
                continue
            lengths = np.sqrt((dense(batch.column("v")) ** 2).sum(1)) * hashes.longest
            for at in range(0, len(points), SLICE):
                part, own = points[at:at + SLICE], batch.slice(at, SLICE)
                product = part @ sample[0].T
                gap = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * product))
                itself = own.column("cls").to_numpy()[:, None] == sample[1][None]
                gap[itself] = np.inf  # not its own neighbour
                # half as many again as wanted reach this score, so no row below it can be among the k nearest
                product[itself] = -np.inf
                least, enough = np.full(len(part), -np.inf), k + k // 2 + 1
                if product.shape[1] > enough:
                    least = np.partition(product, product.shape[1] - enough, axis=1)[:, -enough]
                least = (least - 1e-9) * lengths[at:at + SLICE]
                rank = min(gap.shape[1], max(1, math.ceil(k * len(sample[1]) / total))) - 1
                d = np.partition(gap, rank, axis=1)[:, rank]
                d = np.clip(np.where(np.isfinite(d), d, 2.0), 1e-3, 2.0)
                for t in range(hashes.tables):
                    projected = hashes.project(part, t)
                    limit = limits(projected, d, hashes.steps, shared_recall, hashes.tables)
                    who, found = cells_of(projected, d, limit, hashes.coarse)
                    rows = own.take(pa.array(who))
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("dim"), pa.array(np.full(len(who), t, np.int32)), pa.array(_names(found), pa.string()),
                         rows.column("cls"), rows.column("v"), pa.array(d[who]), pa.array(limit[who]), pa.array(least[who])],
                        ["dim", "tab", "cell", "cls", "v", "d", "limit", "least"])

    shared_recall = RECALL
    kind = table.schema["v"].dataType.elementType.simpleString()
    return table.select("dim", "cls", "v").mapInArrow(
        run, f"dim int, tab int, cell string, cls long, v array<{kind}>, d double, limit double, least double")


def best_of_block(key, rows: pa.Table, asked: pa.Table, shared, k: int) -> pa.Table:
    """The ``k`` best scored rows in the visited buckets of one block, for each of its queries."""
    hashes: Hashes = shared.value[0][key[0].as_py()]
    t = key[1].as_py()
    vectors, wanted = dense(rows.column("v")), dense(asked.column("v"))
    ids, first = rows.column("cls").to_numpy(), rows.column("first").to_numpy()
    slots = hashes.slots(hashes.rows(vectors), t)
    buckets, bucket = np.unique(slots, axis=0, return_inverse=True)
    bucket = bucket.reshape(-1)
    projected = hashes.project(hashes.queries(wanted), t)
    d, limit, least, who = (asked.column(c).to_numpy() for c in ("d", "limit", "least", "cls"))
    out = []
    for at in range(0, len(wanted), SLICE):
        part = slice(at, at + SLICE)
        logs = np.zeros((len(wanted[part]), len(buckets)))
        for j in range(hashes.bits):
            values, back = np.unique(buckets[:, j], return_inverse=True)
            logs += chance(projected[part, j:j + 1], values[None], d[part, None])[:, back]
        visit = (logs >= limit[part, None])[:, bucket]
        some = np.flatnonzero(visit.any(0))
        scores = wanted[part] @ vectors[some].T
        scores = np.where(visit[:, some] & (scores >= least[part, None]), scores, -np.inf)
        if scores.shape[1] > k:
            edge = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
            # all that tie with the k-th, give or take the error of the last bits
            keep = (scores >= (edge - 1e-12 * (1.0 + np.abs(edge)))[:, None]) & (scores > -np.inf)
        else:
            keep = scores > -np.inf
        q, r = np.nonzero(keep)
        r = some[r]
        exact = np.concatenate([np.zeros(0), *[(wanted[part][q[i:i + 8192]] * vectors[r[i:i + 8192]]).sum(1)
                                               for i in range(0, len(q), 8192)]])
        order = np.lexsort((first[r], -exact, q))
        q, r, exact = q[order], r[order], exact[order]
        begin = np.flatnonzero(np.diff(q, prepend=-1))
        place = np.arange(len(q)) - np.repeat(begin, np.diff(np.append(begin, len(q))))
        top = place < k
        out.append(pa.table({"ask": who[part][q[top]], "cls": ids[r[top]], "first": first[r[top]], "score": exact[top]}))
    return pa.concat_tables(out)


def _top(df: DataFrame, by: str, order: list, k: int) -> DataFrame:
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    return ranked.where(F.col("rank") <= k).drop("rank")


def _round(placed: DataFrame, asked: DataFrame, shared, k: int) -> DataFrame:
    """(ask, cls, score) of the ``k`` best classes each query found in its cells."""
    sizes = (placed.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n"))
             .join(asked.groupBy(*CELL).agg(F.count(F.lit(1)).alias("m")), CELL)
             .select(*CELL, F.ceil(F.col("n") / CELL_ROWS).cast("int").alias("row_blocks"),
                     F.ceil(F.col("m") / CELL_QUERIES).cast("int").alias("query_blocks"), (F.col("n") + F.col("m")).alias("size")))
    sizes = saved(sizes, "cells")
    own = F.xxhash64("cls", F.lit(11))

    def every(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    left = (attach(placed, sizes, CELL, "size", ["cls"]).where("row_blocks IS NOT NULL")
            .withColumn("rb", F.pmod(own, F.col("row_blocks")).cast("int")).withColumn("qb", every("query_blocks")))
    right = (attach(asked, sizes, CELL, "size", ["cls"]).where("row_blocks IS NOT NULL")
             .withColumn("qb", F.pmod(own, F.col("query_blocks")).cast("int")).withColumn("rb", every("row_blocks")))
    block = [*CELL, "rb", "qb"]

    def probe(key, rows, queries):
        if not rows.num_rows or not queries.num_rows:
            return pa.table({"ask": pa.array([], pa.int64()), "cls": pa.array([], pa.int64()),
                             "first": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return best_of_block(key, rows, queries, shared, k)

    found = (left.select(*block, "cls", "first", "v").groupBy(*block)
             .cogroup(right.select(*block, "cls", "v", "d", "limit", "least").groupBy(*block))
             .applyInArrow(probe, "ask long, cls long, first long, score double"))
    once = found.groupBy("ask", "cls").agg(F.max("score").alias("score"), F.min("first").alias("first"))
    return saved(_top(once, "ask", [F.col("score").desc(), F.col("first"), F.col("cls")], k), "found")


def plan(table: DataFrame, k: int, sample_rows: int = SAMPLE) -> tuple[dict, dict, dict]:
    """(hashes, sample, number of classes) for every vector length.

    The sample is bounded in rows and bytes and drawn by a hash; it sets distances, not results.
    """
    shapes = {r.dim: r for r in table.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("longest")).collect()}
    total, widest = sum(r.n for r in shapes.values()), max(shapes, default=1)
    bound = max(1, min(sample_rows, SAMPLE_BYTES // (8 * widest)))
    rate = min(1.0, bound / max(total, 1))
    drawn = table.where(F.pmod(F.xxhash64("cls", F.lit(5)), F.lit(1 << 30)) < int(rate * (1 << 30)) + 1)
    drawn = drawn.select("dim", "cls", "v").toArrow()
    hashes, sample, counts = {}, {}, {}
    for dim, row in shapes.items():
        bits = int(min(24, max(4, round(0.65 * math.log2(row.n + 1)))))
        coarse = min(bits, max(0, math.ceil(math.log(row.n / CELL_ROWS, 3)))) if row.n else 0
        hashes[dim] = Hashes(dim, bits, coarse, row.longest)
        mine = drawn.filter(pa.array(drawn.column("dim").to_numpy() == dim))
        points = hashes[dim].rows(dense(mine.column("v"))) if mine.num_rows else np.zeros((1, dim + 1))
        sample[dim] = (points, mine.column("cls").to_numpy() if mine.num_rows else np.array([-1]))
        counts[dim] = row.n
    return hashes, sample, counts


def search(vectors: DataFrame, wanted: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows of every row that is ``wanted``.

    ``score`` is the inner product of the original vectors in double precision; ties go to the
    smaller id. A query with fewer candidates gets all of them.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    table = classes(rows, wanted, k)
    shared = spark.sparkContext.broadcast(plan(table, k))
    asking = table.where("asks")
    found = _round(place_rows(table, shared), place_queries(asking, shared, k, False), shared, k + 1)
    # a query that met too few other classes goes through all cells of one table
    counts = {dim: n for dim, n in shared.value[2].items()}
    need = F.lit(0)
    for dim, n in counts.items():
        need = F.when(F.col("dim") == dim, F.lit(min(k, n - 1))).otherwise(need)
    met = found.where("ask <> cls").groupBy(F.col("ask").alias("cls")).agg(F.count(F.lit(1)).alias("met"))
    short = saved(asking.join(met, "cls", "left").where(F.coalesce("met", F.lit(0)) < need).select(*asking.columns), "short")
    if not short.isEmpty():
        placed = place_rows(table, shared).where("tab = 0")
        cells = saved(placed.select("dim", "cell").distinct(), "all-cells")
        asked = place_queries(short, shared, k, True).drop("cell").join(cells, "dim").select(
            "dim", "tab", "cell", "cls", "v", "d", "limit", "least")
        again = _round(placed, asked, shared, k + 1)
        found = found.join(short.select(F.col("cls").alias("ask")), "ask", "left_anti").union(again.select(found.columns))
    members = table.select("cls", "members")
    each = found.join(members, "cls").select("ask", "score", F.explode("members").alias("vec_id"))
    best = (_top(each, "ask", [F.col("score").desc(), F.col("vec_id")], k + 1).groupBy("ask")
            .agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("best")))
    answers = best.join(asking.select(F.col("cls").alias("ask"), "v"), "ask").select("v", "best")
    askers = rows.where(wanted)
    sizes = askers.groupBy("v").agg(F.count(F.lit(1)).alias("size"))
    ranked = attach(askers, answers.join(sizes, "v"), ["v"], "size", ["vec_id"])
    others = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("vec_id")), 1, k)
    return (ranked.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("rank", "hit"))
            .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                    (-F.col("hit.s")).alias("score")))

