"""Approximate nearest neighbours by an inverted multi-index.

Both halves of the vectors are quantised on their own (k-means on a bounded
sample); a cell is a pair of centroids. A query sorts the centroids of each
half by inner product and walks the pairs in order of their sum with a heap,
until the cells hold ``candidates`` distinct vectors (or all are reached);
copies of a vector count once, so that a hot vector does not end the walk. The
heap holds runs: the pairs of one first centroid whose sums are within a step
of each other. The last step is cut at the exact sum, the query's reach: it
visits the cells whose sum is at least that. The entries of the visited cells,
all copies too, are ranked by the exact inner product of the original vectors
in double precision.

Scale. Every row is indexed. Rows are dealt into blocks of about
``block_rows`` neighbouring cells; a cell with more rows (many copies of one
vector) is split over several blocks. A query travels to the blocks that hold a
cell it visits and to no other, in groups of at most about ``query_block``, with
its reach instead of a list of cells; a task scores one such group against one
block of rows. It returns at most ``k`` rows for a query; the rest is a ranked
top-k with a map-side limit. Centroids grow with the square root of the rows, so
a cell holds about as many rows at every size up to the bound below.

Bounds. k-means sees the distinct ones of at most ``sample_rows`` vectors, the
smallest by a seeded hash of the row, and has a third of them as centroids at
most, ``MAX_CENTROIDS`` a half in all. Cell counts (centroids squared) come to
the driver.

Defined cases. Vectors that are NULL, zero, hold a NULL or non-finite
component, or differ in length from the most frequent length (ties: the
smallest) take no part; neither do rows without an id. With fewer candidates
than ``k`` all are returned. Ties go to the smaller id. Repeated ids are
separate rows; a query never returns a row of its own id. A query whose sums
overflow visits every cell. Empty tables give empty results.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.llm.common import hash_sample

MIN_CENTROIDS, MAX_CENTROIDS = 256, 1024
_STEPS = 16  # steps between the largest and the smallest sum of a query
_ROUTED = 8192  # (query, block) pairs in one batch


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 42) -> np.ndarray:
    """Centroids of the rows of ``x`` (Lloyd's rounds from a random start)."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        at = nearest(x, c)
        n = np.bincount(at, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c ** 2).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)


@dataclass
class MultiIndex:
    """Centroids of both halves, distinct vectors and rows per cell."""
    first: np.ndarray
    second: np.ndarray
    counts: np.ndarray | None = None  # distinct vectors of each cell, flat
    rows: np.ndarray | None = None  # rows of each cell, flat

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)

    def cell_of(self, x: np.ndarray) -> np.ndarray:
        half = self.first.shape[1]
        return nearest(x[:, :half], self.first) * len(self.second) + nearest(x[:, half:], self.second)

    def reach(self, q: np.ndarray, wanted: int) -> float:
        """The sum down to which a query visits cells: pairs by falling sum, until they hold ``wanted`` distinct vectors."""
        half = self.first.shape[1]
        with np.errstate(over="ignore", invalid="ignore"):
            a, b = self.first @ q[:half], self.second @ q[half:]
        ia, ib = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
        sa, sb = a[ia], b[ib]
        step = (sa[0] - sa[-1] + sb[0] - sb[-1]) / _STEPS
        if not np.isfinite(step):
            return -np.inf
        counts = self.counts.reshape(len(a), len(b))[np.ix_(ia, ib)]
        held = np.zeros((len(a), len(b) + 1), np.int64)  # vectors in the first pairs of each first centroid
        np.cumsum(counts, axis=1, out=held[:, 1:])
        tops, falling, width = sa.tolist(), (-sb).tolist(), len(b)
        heap, at, found, low = [(-(tops[0] - falling[0]), 0)], [0] * len(a), 0, np.inf
        while heap and found < wanted:
            top, i = heapq.heappop(heap)
            low, start = -top - step, at[i]
            end = max(start + 1, bisect_right(falling, tops[i] - low))
            found += held[i, end] - held[i, start]
            at[i] = end
            if end < width:
                heapq.heappush(heap, (falling[end] - tops[i], i))
            if start == 0 and i + 1 < len(tops):
                heapq.heappush(heap, (falling[0] - tops[i + 1], i + 1))
        if found < wanted:
            return -np.inf
        # the cells of the last step one by one; what rounding moved across its ends is taken with it
        slack = 1e-12 * (np.abs(a).max() + np.abs(b).max())
        last = np.searchsorted(-sb, sa - low + slack, "right")
        first = np.minimum(np.searchsorted(-sb, sa - low - step - slack, "left"), last)
        size = last - first
        i = np.repeat(np.arange(len(a)), size)
        j = np.arange(len(i)) - np.repeat(np.cumsum(size) - size - first, size)
        sums = sa[i] + sb[j]
        order = np.argsort(-sums, kind="stable")
        more = held[np.arange(len(a)), first].sum() + np.cumsum(counts[i, j][order])
        return float(sums[order][min(np.searchsorted(more, wanted), len(order) - 1)] - slack)

    def sums(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inner products of queries with the centroids of both halves."""
        half = self.first.shape[1]
        return q[:, :half] @ self.first.T, q[:, half:] @ self.second.T

    def visited(self, q: np.ndarray, wanted: int) -> np.ndarray:
        """Bitmap of the cells a query visits."""
        a, b = self.sums(q[None, :])
        return (a[0][:, None] + b[0][None, :]).ravel() >= self.reach(q, wanted)


def inner_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """(queries, rows) sums taken component by component, so that equal vectors get equal scores."""
    out = np.zeros((len(q), len(x)))
    for d in range(q.shape[1]):
        out += q[:, d:d + 1] * x[None, :, d]
    return out


def usable(vec: Column, width: int) -> Column:
    """A vector of ``width`` finite components that are not all zero."""
    finite = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vec.isNotNull() & (F.size(vec) == width) & finite & F.exists(vec, lambda v: v != 0)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64)


def _usual_width(rows: DataFrame, vec_col: str) -> int:
    top = (rows.where(F.col(vec_col).isNotNull()).groupBy(F.size(vec_col).alias("w")).count()
           .orderBy(F.desc("count"), "w").first())
    return top["w"] if top else 0


def build_index(rows: DataFrame, id_col: str, vec_col: str, centroids: int, sample_rows: int) -> MultiIndex | None:
    """Centroids from a bounded sample; distinct vectors (by a 64-bit hash) and rows of each cell, over all usable rows."""
    sample = hash_sample(rows.select(id_col, vec_col), id_col, sample_rows).toPandas()
    if not len(sample):
        return None
    x = np.stack(sample.sort_values(id_col, kind="stable")[vec_col].to_numpy()).astype(np.float64)
    x = x[np.sort(np.unique(x, axis=0, return_index=True)[1])]  # copies would take up centroids
    half = max(1, x.shape[1] // 2)  # one component: the second half is empty, with equal sums
    centroids = min(centroids, max(1, len(x) // 3))
    index = MultiIndex(kmeans(x[:, :half], centroids), kmeans(x[:, half:], centroids, seed=43))
    vectors = rows.groupBy(_cell_column(index, x.shape[1])(vec_col).alias("cell"), F.xxhash64(vec_col).alias("vector")).count()
    n = vectors.groupBy("cell").agg(F.count("*").alias("distinct"), F.sum("count").alias("rows")).toPandas()
    index.counts, index.rows = np.zeros(index.cells, np.int64), np.zeros(index.cells, np.int64)
    index.counts[n["cell"]], index.rows[n["cell"]] = n["distinct"], n["rows"]
    return index


def _cell_column(index: MultiIndex, width: int):
    first, second = index.first, index.second

    @F.arrow_udf("int")
    def cell(vectors: pa.Array) -> pa.Array:
        return pa.array(MultiIndex(first, second).cell_of(_matrix(vectors, width)).astype(np.int32))
    return cell


def _block_layout(counts: np.ndarray, block_rows: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First block and number of blocks of every cell, and of all."""
    parts = np.maximum(1, -(-counts // block_rows))
    small = np.where(parts == 1, counts, 0)
    shared = np.cumsum(small) // block_rows  # neighbouring small cells share a block
    n_shared = int(shared[-1]) + 1
    own = n_shared + np.cumsum(np.where(parts > 1, parts, 0)) - parts
    return np.where(parts > 1, own, shared).astype(np.int64), parts, n_shared + int(parts[parts > 1].sum())


def search(rows: DataFrame, queries: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20,
           candidates: float = 0.4, centroids: int | None = None, sample_rows: int = 20_000, block_rows: int = 4096,
           query_block: int = 512) -> DataFrame:
    """The ``k`` rows of largest inner product for every row where ``queries`` holds.

    Returns query_id, rank (from 1), ``id_col``, score. ``candidates`` is the
    share of all distinct vectors whose cells a query visits at least. Recall rises with
    it; embeddings without clusters need a large one. ``centroids`` of a half: the square root of the
    rows within MIN_CENTROIDS and MAX_CENTROIDS, if not given.
    """
    schema = f"query_id bigint, rank int, {id_col} bigint, score double"
    spark = rows.sparkSession
    width = _usual_width(rows, vec_col)
    good = rows.where(F.col(id_col).isNotNull() & usable(F.col(vec_col), width)).select(F.col(id_col).cast("bigint"), vec_col)
    n_rows, n_queries = good.agg(F.count(F.lit(1)), F.count_if(queries)).first()
    centroids = centroids or min(MAX_CENTROIDS, max(MIN_CENTROIDS, isqrt(n_rows)))
    index = build_index(good, id_col, vec_col, centroids, sample_rows) if width else None
    if index is None:
        return spark.createDataFrame([], schema)
    total = int(index.counts.sum())
    wanted = min(total, max(k + 1, int(np.ceil(candidates * total))))
    start, parts, n_blocks = _block_layout(index.rows, block_rows)
    n_query_blocks = max(1, -(-n_queries // query_block))

    @F.arrow_udf("struct<cell:int,block:int>")
    def place(vectors: pa.Array, salt: pa.Array) -> pa.Array:
        c = index.cell_of(_matrix(vectors, width))
        block = start[c] + salt.to_numpy(zero_copy_only=False) % parts[c]
        return pa.StructArray.from_arrays([pa.array(c.astype(np.int32)), pa.array(block.astype(np.int32))], ["cell", "block"])

    @F.arrow_udf("double")
    def reach(vectors: pa.Array) -> pa.Array:
        return pa.array([index.reach(q, wanted) for q in _matrix(vectors, width)], pa.float64())

    salt = F.pmod(F.xxhash64(id_col, vec_col), F.lit(1 << 30))
    placed = good.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"), place(vec_col, salt).alias("p"))
    # never NULL, and known to be: else the join would filter by the function once more
    stored = (placed.select("id", "vec", "p.cell", F.coalesce("p.block", F.lit(0)).alias("block")).groupBy("block")
              .agg(F.collect_list(F.struct("id", "cell", "vec")).alias("stored")))
    # rows equal in id and vector are one query, answered as often as they stand there
    each = (good.where(queries).select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"), reach(vec_col).alias("reach"))
            .groupBy("id", "vec").agg(F.count(F.lit(1)).alias("times"), F.first("reach").alias("reach")))
    query = F.struct("id", "reach", "vec", F.xxhash64("vec").alias("number"), "times")
    grouped = (each.groupBy(F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(n_query_blocks)).alias("query_block"))
               .agg(F.collect_list(query).alias("asked")).select("asked"))

    occupied, large = index.rows > 0, np.flatnonzero(parts > 1)
    small = np.flatnonzero(occupied & (parts == 1))

    def blocks_of(sums: np.ndarray, limit: float) -> np.ndarray:
        own = large[sums[large] >= limit]
        of_own = np.repeat(start[own] - np.cumsum(parts[own]) + parts[own], parts[own]) + np.arange(parts[own].sum())
        return np.append(np.unique(start[small[sums[small] >= limit]]), of_own)

    def route(batches):
        """Groups of queries -> for each block, the queries of a group that visit a cell of it."""
        for batch in batches:
            for group in batch.column(0):
                asked = group.values
                q, limit = _matrix(asked.field("vec"), width), asked.field("reach").to_numpy(zero_copy_only=False)
                a, b = index.sums(q)
                seen = [blocks_of((a[i][:, None] + b[i][None, :]).ravel(), limit[i]) for i in range(len(q))]
                block, who = np.concatenate(seen), np.repeat(np.arange(len(q)), [len(x) for x in seen])
                order = np.argsort(block, kind="stable")
                block, who = block[order], who[order]
                for lo in range(0, len(block), _ROUTED):
                    part = block[lo:lo + _ROUTED]
                    at = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
                    members = asked.take(pa.array(who[lo:lo + _ROUTED]))
                    offsets = pa.array(np.append(at, len(part)).astype(np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array(part[at].astype(np.int32)),
                                                      pa.ListArray.from_arrays(offsets, members)], ["block", "asked"])

    asked = grouped.mapInArrow(route, f"block int, asked {grouped.schema['asked'].dataType.simpleString()}")
    n_second = len(index.second)

    def score(batches):
        for batch in batches:
            out = ([], [], [], [], [])
            for asked, stored in zip(batch.column(0), batch.column(1)):
                qid, limit, q, number, times = asked.values.flatten()
                rid, at, x = stored.values.flatten()
                qid, limit, rid, at, number, times = (v.to_numpy(zero_copy_only=False)
                                                      for v in (qid, limit, rid, at, number, times))
                q, x = _matrix(q, width), _matrix(x, width)
                a, b = index.sums(q)
                visits = a[:, at // n_second] + b[:, at % n_second] >= limit[:, None]
                rough = np.where(visits & (qid[:, None] != rid[None, :]), q @ x.T, -np.inf)
                for i in range(len(qid)):
                    r = rough[i]
                    found = np.flatnonzero(r > -np.inf)
                    if len(found) > k:  # all that may tie with the k-th by rounding stay
                        floor = np.partition(r[found], len(found) - k)[len(found) - k]
                        found = found[r[found] >= floor - 1e-9 * max(1.0, abs(floor))]
                    exact = inner_products(q[i:i + 1], x[found])[0]
                    best = np.lexsort((rid[found], -exact))[:k]
                    out[0].append(np.full(len(best), qid[i]))
                    out[1].append(rid[found][best])
                    out[2].append(exact[best])
                    out[3].append(np.full(len(best), number[i]))
                    out[4].append(np.full(len(best), times[i]))
            joined = [np.concatenate(c) if c else np.zeros(0) for c in out]
            whole = [pa.array(joined[c].astype(np.int64)) for c in (0, 1, 3, 4)]
            yield pa.RecordBatch.from_arrays([whole[0], whole[1], pa.array(joined[2], pa.float64()), whole[2], whole[3]],
                                             ["query_id", "id", "score", "number", "times"])

    found = asked.join(stored, "block").select("asked", "stored").mapInArrow(
        score, "query_id bigint, id bigint, score double, number bigint, times bigint")
    order = Window.partitionBy("query_id", "number").orderBy(F.desc("score"), "id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    copies = F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int")))
    return best.withColumn("copy", copies).select("query_id", "rank", F.col("id").alias(id_col), "score")
