"""SimHash near-duplicates by the generalised pigeonhole principle.

A document's fingerprint is the bitwise majority of the 64-bit hashes of its
word shingles. Two fingerprints within ``max_distance`` bits are linked.

Search. The 64 bits are permuted so that correlated bits share one of four
16-bit blocks. A partitioning is either the four blocks or two pairs of
them. If d(x, q) <= tau, then for any thresholds t_1..t_m that sum to
tau - m + 1 there is a partition i with d(x_i, q_i) <= t_i (a threshold of
-1 skips a partition). Every fingerprint gets its own thresholds from a
dynamic program over the estimated number of candidates, taken from block
histograms of all fingerprints. It probes the keys within t_i bits of its
own; matching buckets are compared bit by bit.

Scale. Copies collapse to one fingerprint before the search. A bucket is cut
into chunks of about ``CHUNK`` fingerprints, so a frequent key becomes many
chunk pairs over many tasks. A task returns a spanning forest of the links it
verified, never all pairs of a group.

Defined cases. NULL or wordless text has fingerprint 0 and is linked like any
other. Repeated rows share a component; NULL ids never name one unless the
component has no other id. Empty tables give empty results.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import row_key, utf8, with_row
from ontime.llm.graph import connected_components
from ontime.session import cut_lineage

BITS, BLOCK_BITS = 64, 16
BLOCKS = BITS // BLOCK_BITS
CHUNK = 512
PROBE_COST = 250.0  # one probed key (a shuffled row) against one compared candidate
PARTITIONINGS = (((0,), (1,), (2,), (3,)), ((0, 1), (2, 3)))
_SLICE = 1 << 16
_BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_BYTE_AT = (np.arange(8) * 256).astype(np.int64)


def simhash_bytes(text: bytes | None, shingle: int) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    words = (text or b"").lower().split()  # bytes.lower() touches A-Z only
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if n < shingle:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: n - shingle + 1], ends[shingle - 1:]
    digest, total = xxhash.xxh64_intdigest, len(starts)
    ones = np.zeros(BITS, np.int64)
    for lo in range(0, total, _SLICE):  # bounds the memory of a very long text
        spans = zip(starts[lo:lo + _SLICE].tolist(), ends[lo:lo + _SLICE].tolist())
        h = np.array([digest(joined[a:b], 42) for a, b in spans], np.uint64)
        seen = np.bincount((h.view(np.uint8).reshape(-1, 8) + _BYTE_AT).ravel(), minlength=2048)
        ones += (seen.reshape(8, 256) @ _BIT_OF_BYTE).ravel()
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """BIGINT holding the 64 fingerprint bits of a text column."""
    @F.arrow_udf("bigint")
    def of(texts: pa.Array) -> pa.Array:
        out = np.fromiter((simhash_bytes(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
        return pa.array(out.view(np.int64))
    return of(utf8(text))


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ---- statistics of all fingerprints (bounded: 64 x 64 and 4 x 65,536 counts) ----

def _bit_matrix(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_blocks(fps: DataFrame, column: str = "fp") -> list[list[int]]:
    """Four lists of 16 bit positions; each block greedily gathers correlated bits."""
    def gram(batches):
        total = np.zeros((BITS, BITS))
        for b in batches:
            x = _bit_matrix(b.column(0).to_numpy(zero_copy_only=False)).astype(np.float32)
            for lo in range(0, len(x), _SLICE):
                total += x[lo:lo + _SLICE].T @ x[lo:lo + _SLICE]
        i, j = np.divmod(np.arange(BITS * BITS), BITS)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel().astype(np.int64))],
                                         ["i", "j", "n"])

    counts = (fps.select(column).mapInArrow(gram, "i bigint, j bigint, n bigint")
              .groupBy("i", "j").agg(F.sum("n").alias("n")).toPandas())
    g = np.zeros((BITS, BITS))
    g[counts["i"], counts["j"]] = counts["n"]
    n = max(1, fps.count())
    p = np.diag(g) / n
    var = np.maximum(p * (1 - p), 1e-12)
    corr = np.abs((g / n - np.outer(p, p)) / np.sqrt(np.outer(var, var)))
    np.fill_diagonal(corr, 0)
    left, blocks = set(range(BITS)), []
    while left:
        idx = sorted(left)
        a, b = divmod(int(np.argmax(corr[np.ix_(idx, idx)])), len(idx))
        block = [idx[a], idx[b]] if a != b else idx[:2]
        left -= set(block)
        while len(block) < BLOCK_BITS:
            rest = sorted(left)
            best = rest[int(np.argmax(corr[np.ix_(rest, block)].mean(axis=1)))]
            block.append(best)
            left.discard(best)
        blocks.append(block)
    return blocks


def block_values(fps: np.ndarray, blocks: list[list[int]]) -> np.ndarray:
    """(n, 4) block values of unsigned fingerprints."""
    out = np.zeros((len(fps), len(blocks)), np.int64)
    for b, bits in enumerate(blocks):
        for k, bit in enumerate(bits):
            out[:, b] |= (((fps >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)) << k
    return out


def block_histograms(fps: DataFrame, blocks: list[list[int]], column: str = "fp") -> np.ndarray:
    """(4, 65536) counts of every block value over all fingerprints."""
    @F.arrow_udf("array<int>")
    def values(col: pa.Array) -> pa.Array:
        v = block_values(col.to_numpy(zero_copy_only=False).view(np.uint64), blocks)
        return pa.FixedSizeListArray.from_arrays(pa.array(v.astype(np.int32).ravel()), len(blocks)).cast(pa.list_(pa.int32()))

    counts = (fps.select(F.posexplode(values(column)).alias("b", "v")).groupBy("b", "v").count().toPandas())
    hist = np.zeros((len(blocks), 1 << BLOCK_BITS))
    hist[counts["b"], counts["v"]] = counts["count"]
    return hist


def _spread(hist: np.ndarray, radius: int) -> np.ndarray:
    """[r, v]: how many fingerprints have a block value at exactly r bits from v, r <= radius."""
    at = np.arange(1 << BLOCK_BITS)
    out = np.zeros((radius + 1, 1 << BLOCK_BITS))
    out[0] = hist
    for bit in range(BLOCK_BITS):
        for r in range(radius, 0, -1):
            out[r] += out[r - 1][at ^ (1 << bit)]
    return out


class Plan:
    """Partitioning, block histograms and the per-fingerprint threshold allocation."""

    def __init__(self, blocks: list[list[int]], hist: np.ndarray, max_distance: int):
        self.blocks, self.tau, self.n = blocks, max_distance, max(1.0, float(hist[0].sum()))
        self.spread = [_spread(h, max_distance).astype(np.float32) for h in hist]
        self.parts = min(PARTITIONINGS, key=lambda parts: self._average_cost(parts, hist))
        self.masks = {len(p): _masks(len(p) * BLOCK_BITS, max_distance) for p in self.parts}

    def _average_cost(self, parts, hist) -> float:
        """Cost of the even allocation for a fingerprint with average block values."""
        total, share = 0.0, self._even(len(parts))
        for part, t in zip(parts, share):
            if t < 0:
                continue
            width = len(part) * BLOCK_BITS
            probes = sum(comb(width, r) for r in range(t + 1))
            same = self.n * np.prod([(hist[b] ** 2).sum() / self.n ** 2 for b in part])
            total += probes * (PROBE_COST + same)
        return total

    def _even(self, m: int) -> list[int]:
        total = self.tau - m + 1
        return [total // m + (i < total % m) for i in range(m)]

    def thresholds(self, values: np.ndarray) -> np.ndarray:
        """(n, m) thresholds, each row summing to tau - m + 1, of the least estimated cost."""
        n, m, tau = len(values), len(self.parts), self.tau
        choice_cost = []
        for part in self.parts:
            near = self.spread[part[0]][:, values[:, part[0]]].astype(np.float64)
            for b in part[1:]:  # two blocks of one partition: distances add, taken as independent
                other = self.spread[b][:, values[:, b]] / self.n
                near = np.stack([sum(near[a] * other[r - a] for a in range(r + 1)) for r in range(tau + 1)])
            width = len(part) * BLOCK_BITS
            probes = np.cumsum([comb(width, r) for r in range(tau + 1)])
            cost = np.cumsum(near, axis=0) + probes[:, None] * PROBE_COST
            choice_cost.append(np.vstack([np.zeros(n), cost]))  # row 0: threshold -1, skipped
        # budget in units above -1 for each partition: tau - m + 1 + m = tau + 1 in all
        budget = tau + 1
        best = np.full((budget + 1, n), np.inf)
        best[0] = 0
        taken = np.zeros((m, budget + 1, n), np.int8)
        for i in range(m):
            new = np.full((budget + 1, n), np.inf)
            for used in range(budget + 1):
                for units in range(used + 1):
                    c = best[used - units] + choice_cost[i][units]
                    better = c < new[used]
                    new[used] = np.where(better, c, new[used])
                    taken[i, used] = np.where(better, units, taken[i, used])
            best = new
        out = np.zeros((n, m), np.int64)
        used = np.full(n, budget)
        for i in range(m - 1, -1, -1):
            out[:, i] = taken[i, used, np.arange(n)]
            used = used - out[:, i]
        return out - 1

    def keys(self, values: np.ndarray) -> np.ndarray:
        """(n, m) partition keys."""
        return np.stack([sum(values[:, b] << (BLOCK_BITS * k) for k, b in enumerate(p)) for p in self.parts], axis=1)


def _masks(width: int, radius: int) -> list[np.ndarray]:
    """masks[t]: every bit mask of at most t of ``width`` bits."""
    out, so_far = [], [0]
    for r in range(radius + 1):
        if r:
            so_far = so_far + [sum(1 << i for i in c) for c in combinations(range(width), r)]
        out.append(np.array(so_far, np.int64))
    return out


def _pairs_type() -> pa.DataType:
    return pa.list_(pa.struct([("part", pa.int32()), ("key", pa.int64())]))


def _key_columns(plan: Plan):
    @F.arrow_udf("array<struct<part:int,key:bigint>>")
    def stored(col: pa.Array) -> pa.Array:
        keys = plan.keys(block_values(col.to_numpy(zero_copy_only=False).view(np.uint64), plan.blocks))
        n, m = keys.shape
        flat = pa.StructArray.from_arrays([pa.array(np.tile(np.arange(m, dtype=np.int32), n)), pa.array(keys.ravel())],
                                          ["part", "key"])
        return pa.ListArray.from_arrays(pa.array(np.arange(0, n * m + 1, m, dtype=np.int32)), flat).cast(_pairs_type())

    @F.arrow_udf("array<struct<part:int,key:bigint>>")
    def probed(col: pa.Array) -> pa.Array:
        values = block_values(col.to_numpy(zero_copy_only=False).view(np.uint64), plan.blocks)
        keys, limits = plan.keys(values), plan.thresholds(values)
        at, parts, out = [0], [], []
        for row, lim in zip(keys, limits):
            size = 0
            for i, t in enumerate(lim):
                if t >= 0:
                    near = row[i] ^ plan.masks[len(plan.parts[i])][t]
                    parts.append(np.full(len(near), i, np.int32))
                    out.append(near)
                    size += len(near)
            at.append(at[-1] + size)
        flat = pa.StructArray.from_arrays(
            [pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32)),
             pa.array(np.concatenate(out) if out else np.zeros(0, np.int64))], ["part", "key"])
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), flat).cast(_pairs_type())

    return stored, probed


def _chunks(rows: DataFrame, name: str) -> DataFrame:
    """(part, key, fp) -> one row per chunk of about CHUNK fingerprints of a bucket."""
    large = rows.groupBy("part", "key").count().where(F.col("count") > CHUNK)
    cut = F.coalesce(F.ceil(F.col("count") / CHUNK), F.lit(1))
    return (rows.join(large, ["part", "key"], "left")
            .withColumn("chunk", F.pmod(F.xxhash64("fp"), cut))
            .groupBy("part", "key", "chunk").agg(F.collect_list("fp").alias(name)).drop("chunk"))


def spanning_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links a-b -> at most one edge per node, joining it to its component's smallest node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    ia, ib = at[: len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[ia], label[ib])
        new = label.copy()
        np.minimum.at(new, ia, low)
        np.minimum.at(new, ib, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def _verified(batches, max_distance: int):
    for b in batches:
        left, right = [], []
        xs, ys = b.column(0), b.column(1)
        xo, yo = xs.offsets.to_numpy(), ys.offsets.to_numpy()
        xv = xs.values.to_numpy(zero_copy_only=False)
        yv = ys.values.to_numpy(zero_copy_only=False)
        for i in range(len(xs)):
            x, y = xv[xo[i]:xo[i + 1]], yv[yo[i]:yo[i + 1]]
            diff = x.view(np.uint64)[:, None] ^ y.view(np.uint64)[None, :]
            # either end of a link probes for the other, so one direction is enough
            hit = (np.bitwise_count(diff) <= max_distance) & (x[:, None] > y[None, :])
            r, c = np.nonzero(hit)
            left.append(x[r])
            right.append(y[c])
        u, v = spanning_forest(np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64),) * 2
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def fingerprint_links(fps: DataFrame, max_distance: int = 3) -> DataFrame:
    """Distinct fingerprints (fp) -> edges (u, v) that span every component of links.

    Every pair at most ``max_distance`` bits apart is connected through the
    edges; each edge joins fingerprints that are connected by such links.
    """
    blocks = bit_blocks(fps)
    plan = Plan(blocks, block_histograms(fps, blocks), max_distance)
    stored, probed = _key_columns(plan)
    index = _chunks(fps.select("fp", F.inline(stored("fp"))), "stored")
    probes = _chunks(fps.select("fp", F.inline(probed("fp"))), "probing")
    return (probes.join(index, ["part", "key"]).select("probing", "stored")
            .mapInArrow(lambda batches: _verified(batches, max_distance), "u bigint, v bigint"))


def _components(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_distance: int) -> DataFrame:
    """One row per document: id, _k1, _k2 (content key), fp, root, component_id."""
    rows = cut_lineage(docs.select(id_col, *row_key(id_col, text_col), fingerprint(F.col(text_col), shingle).alias("fp")))
    classes = cut_lineage(rows.groupBy("fp").agg(F.min(id_col).alias("first_id")))
    roots = connected_components(fingerprint_links(classes.select("fp"), max_distance))
    named = (classes.join(roots, classes.fp == roots.node, "left")
             .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows.join(named.join(smallest, "root").select("fp", "root", "component_id"), "fp")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       max_distance: int = 3) -> DataFrame:
    """One row per document: ``id_col``, fp (BIGINT bits), component_id.

    component_id is the smallest id reachable over links of at most
    ``max_distance`` differing bits, the document's own id included.
    """
    return _components(docs, id_col, text_col, shingle, max_distance).select(id_col, "fp", "component_id")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
               max_distance: int = 3) -> DataFrame:
    """The documents without near-duplicates: one row of each component stays.

    That row has the smallest id (NULL ids last; rows of one id by content
    hash); of rows equal in id and text one stays.
    """
    first = F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "_k1", "_k2"))
    stay = (_components(docs, id_col, text_col, shingle, max_distance)
            .groupBy("root").agg(first.alias("first")).select("first._k1", "first._k2"))
    keyed = with_row(docs, *row_key(id_col, text_col))
    return keyed.join(stay, ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"]).select("_row.*")
