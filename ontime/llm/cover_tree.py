"""Embedding near-duplicates by dual traversal of cover trees.

On unit vectors a cosine of at least ``t`` is a distance of at most
``r = sqrt(2 - 2 t)``. A cover tree holds nested levels: a node covers its points
within a radius, its children cover them within half of that, the first child
around the same centre. Two trees (or a tree and itself) are walked together
from their roots: a pair of nodes whose centres are farther apart than their
exact covering radii and ``r`` allow holds no link and is dropped; one so close
that every pair of points must link is taken as a whole; others are opened. Only
points in pairs of opened leaves are compared on their own.

Scale. Equal vectors of a label are one point with a count. Labels of up to
``block_rows`` points are dealt into bins, a tree for each label. A larger
label is cut along the upper levels of a cover tree of a bounded sample
(``sample_rows``), wherever that holds dense regions; every region takes all its
points, and a region of more than ``block_rows`` points is dealt into chunks by
hash. The driver walks the regions (their number is bounded by the sample): pairs
that are too far apart are dropped, whole pairs are taken by their counts alone,
and for the rest the trees of their chunks meet. Vectors without structure let
no bound drop a pair; then all chunks of a label meet, which grows with the
square of its rows. A traversal returns a spanning forest of its links and one
count for each point, never the pairs.

Defined cases. A vector links with nothing if it is NULL or zero, holds NULL or
non-finite components, or has no label; vectors of different length never link.
Rows without an id link as others but name no component; they are kept where
no row of their component has an id. Repeated ids are separate vectors. Empty
tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import hash_sample
from ontime.llm.graph import connected_components
from ontime.llm.simhash import spanning_forest
from ontime.session import cut_lineage

_SLACK = 1e-6  # bounds decide only beyond rounding (a distance is the root of a difference); single pairs are exact
_LEAF = 24
_CHUNKS = 1 << 20


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distances of unit vectors, (points, centres)."""
    return np.sqrt(np.maximum(0.0, 2 - 2 * (points @ centres.T)))


def _covers(points: np.ndarray, members: np.ndarray, centre: int, half: float):
    """(centre, members, radius) of balls of radius ``half`` that cover ``members``, the first around ``centre``."""
    gap = distances(points[members], points[centre:centre + 1])[:, 0]
    near = gap <= half
    near |= members == centre
    yield centre, members[near], float(gap[near].max())
    rest = members[~near]
    while len(rest):
        gap = distances(points[rest], points[rest[:64]])
        free = np.ones(len(rest), bool)
        for c in range(gap.shape[1]):
            if free[c]:
                near = free & (gap[:, c] <= half)
                near[c] = True
                yield int(rest[c]), rest[near], float(gap[near, c].max())
                free &= ~near
        rest = rest[free]


@dataclass
class CoverTree:
    """Points in tree order. Node i holds points low[i]:high[i] within radius[i] of point centre[i]; its children
    are nodes child[i]:child[i] + children[i]."""
    points: np.ndarray
    order: np.ndarray  # where each point stood before
    low: np.ndarray
    high: np.ndarray
    centre: np.ndarray
    child: np.ndarray
    children: np.ndarray
    radius: np.ndarray

    @staticmethod
    def build(points: np.ndarray, solid: float = 0.0, leaf: int = _LEAF) -> CoverTree:
        """Nodes whose radius is at most ``solid``, or of at most ``leaf`` points, have no children."""
        order = np.arange(len(points))
        low, high, centre, child, children = [0], [len(points)], [0], [0], [0]
        radius = [float(distances(points, points[:1]).max())]
        at = 0
        while at < len(low):
            lo, hi = low[at], high[at]
            if hi - lo > leaf and radius[at] > max(solid, _SLACK):
                child[at], place = len(low), lo
                for middle, members, far in _covers(points, order[lo:hi].copy(), centre[at], radius[at] / 2):
                    order[place:place + len(members)] = members
                    for column, value in zip((low, high, centre, child, children, radius),
                                             (place, place + len(members), middle, 0, 0, far)):
                        column.append(value)
                    place += len(members)
                children[at] = len(low) - child[at]
            at += 1
        place_of = np.empty(len(points), np.int64)
        place_of[order] = np.arange(len(points))
        return CoverTree(points[order], order, np.array(low), np.array(high), place_of[centre], np.array(child),
                         np.array(children), np.array(radius))

    def pack(self) -> tuple[bytes, bytes, bytes]:
        shape = np.stack([self.low, self.high, self.centre, self.child, self.children]).astype(np.int32)
        return self.points.tobytes(), shape.tobytes(), self.radius.tobytes()

    @staticmethod
    def unpack(points: bytes, shape: bytes, radius: bytes, n: int) -> CoverTree:
        return CoverTree(np.frombuffer(points).reshape(n, -1), np.arange(n), *np.frombuffer(shape, np.int32).reshape(5, -1).astype(np.int64),
                         np.frombuffer(radius))

    def opened(self, node: int) -> np.ndarray:
        """The children of a node, or the node itself if it has none."""
        return np.arange(self.child[node], self.child[node] + self.children[node]) if self.children[node] else np.array([node])


@dataclass
class Edges:
    """Edges of links, thinned to a spanning forest as they grow."""
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    held: int = 0

    def add(self, u, v) -> None:
        u, v = np.broadcast_arrays(u, v)
        self.left.append(u.ravel())
        self.right.append(v.ravel())
        self.held += self.left[-1].size
        if self.held > 500_000:
            u, v = self.forest()
            self.left, self.right, self.held = [u], [v], min(u.size, 250_000)

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        none = [np.zeros(0, np.int64)]
        return spanning_forest(np.concatenate(none + self.left), np.concatenate(none + self.right))


def dual_traversal(a: CoverTree, b: CoverTree, ids_a: np.ndarray, ids_b: np.ndarray, weight_a: np.ndarray,
                   weight_b: np.ndarray, threshold: float, edges: Edges) -> tuple[np.ndarray, np.ndarray]:
    """Linked weight of every point of two trees (in tree order), or of one tree with itself where ``a is b``.

    Edges that span the links go to ``edges``.
    """
    reach, same = float(np.sqrt(2 - 2 * threshold)), a is b
    sum_a, sum_b = (np.concatenate([[0], np.cumsum(w)]) for w in (weight_a, weight_b))
    found_a = np.zeros(len(ids_a), np.int64)
    found_b = found_a if same else np.zeros(len(ids_b), np.int64)
    # a range of points gains a weight at its start and loses it at its end
    range_a = np.zeros(len(ids_a) + 1, np.int64)
    range_b = range_a if same else np.zeros(len(ids_b) + 1, np.int64)

    def take(la, ha, lb, hb):
        """Every point of a range la:ha links with every point of its lb:hb."""
        in_a, in_b = sum_a[ha] - sum_a[la], sum_b[hb] - sum_b[lb]
        for total, at, amount in ((range_a, la, in_b), (range_a, ha, -in_b), (range_b, lb, in_a), (range_b, hb, -in_a)):
            np.add.at(total, at, amount)
        edges.add(ids_a[la], ids_b[lb])
        for w, x, y, z in zip(*(c[(ha - la > 1) | (hb - lb > 1)] for c in (la, ha, lb, hb))):
            edges.add(ids_a[w:x], ids_b[y])
            edges.add(ids_a[w], ids_b[y:z])

    stack = [(0, 0)]
    while stack:
        i, j = stack.pop()
        twin = same and i == j
        lo, hi = a.low[i], a.high[i]
        if twin and 2 * a.radius[i] < reach - _SLACK:
            range_a[lo] += sum_a[hi] - sum_a[lo]
            range_a[hi] -= sum_a[hi] - sum_a[lo]
            found_a[lo:hi] -= weight_a[lo:hi]  # no point links with itself
            edges.add(ids_a[lo:hi], ids_a[lo])
            continue
        if not a.children[i] and not b.children[j]:
            pb = slice(b.low[j], b.high[j])
            hit = a.points[lo:hi] @ b.points[pb].T >= threshold
            if twin:
                hit = np.triu(hit, 1)
            found_a[lo:hi] += hit @ weight_b[pb]
            found_b[pb] += hit.T @ weight_a[lo:hi]
            r, c = np.nonzero(hit)
            edges.add(ids_a[lo + r], ids_b[pb.start + c])
            continue
        nodes_a, nodes_b = a.opened(i), b.opened(j)
        step = max(1, (1 << 21) // len(nodes_b))
        for start in range(0, len(nodes_a), step):
            na = nodes_a[start:start + step]
            cos = a.points[a.centre[na]] @ b.points[b.centre[nodes_b]].T
            gap = np.sqrt(np.maximum(0.0, 2 - 2 * cos))
            radii = a.radius[na][:, None] + b.radius[nodes_b]
            single = (a.high[na] - a.low[na] == 1)[:, None] & (b.high[nodes_b] - b.low[nodes_b] == 1)
            whole = np.where(single, cos >= threshold, gap + radii < reach - _SLACK)
            look = ~whole & ~single & (gap - radii <= reach + _SLACK)
            if twin:  # every pair once; a child with itself is a pair of its own
                whole &= na[:, None] < nodes_b
                look = (look & (na[:, None] < nodes_b)) | ((na[:, None] == nodes_b) & ~single)
            r, c = np.nonzero(whole)
            if len(r):
                take(a.low[na[r]], a.high[na[r]], b.low[nodes_b[c]], b.high[nodes_b[c]])
            r, c = np.nonzero(look)
            stack.extend(zip(na[r].tolist(), nodes_b[c].tolist()))
    found_a += np.cumsum(range_a)[:-1]
    if not same:
        found_b += np.cumsum(range_b)[:-1]
    return found_a, found_b


@dataclass
class Regions:
    """The dense upper nodes of one label's cover tree: region 0 holds all, others lie within ``scale`` of their centre."""
    centres: np.ndarray
    scale: np.ndarray
    parent: np.ndarray

    @staticmethod
    def cut(sample: np.ndarray, rows: int, block_rows: int) -> Regions:
        """Nodes of the sample's tree that hold at least half a block of the label's rows, down to one block."""
        tree = CoverTree.build(sample, leaf=8)
        chosen, scale, parent, queue = [0], [2.0], [-1], [0]
        share = rows / len(sample)
        for region, node in enumerate(queue):
            if (tree.high[node] - tree.low[node]) * share <= block_rows:
                continue
            for c in range(tree.child[node], tree.child[node] + tree.children[node]):
                held = tree.high[c] - tree.low[c]
                if held >= 8 and held * share >= block_rows / 2:
                    queue.append(c)
                    chosen.append(c)
                    scale.append(tree.radius[node] / 2)
                    parent.append(region)
        return Regions(tree.points[tree.centre[chosen]], np.array(scale), np.array(parent))

    def place(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Region of every point, found downwards by the nearest centre that covers it, and its distance from the centre."""
        gap, at = distances(points, self.centres), np.zeros(len(points), np.int64)
        for p in range(len(self.centres)):
            below = np.flatnonzero(self.parent == p)
            if len(below):
                nearest = below[gap[:, below].argmin(axis=1)]
                down = (at == p) & (gap[np.arange(len(points)), nearest] <= self.scale[nearest])
                at = np.where(down, nearest, at)
        return at, gap[np.arange(len(points)), at]


def _units(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as unit vectors in double precision."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the norm
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


_TREE = "block bigint, nodes array<bigint>, weights array<bigint>, points binary, shape binary, radius binary"


def _trees(classes: DataFrame, threshold: float) -> DataFrame:
    """A cover tree for every block and label."""
    solid = float(np.sqrt(2 - 2 * threshold)) / 2 - _SLACK
    schema = pa.schema([("block", pa.int64()), ("nodes", pa.list_(pa.int64())), ("weights", pa.list_(pa.int64())),
                        ("points", pa.binary()), ("shape", pa.binary()), ("radius", pa.binary())])

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by([("label", "ascending"), ("node", "ascending")]).combine_chunks()
        names = table.column("label").to_numpy()
        cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
        rows = []
        for lo, hi in zip(cuts, cuts[1:]):
            part = table.slice(lo, hi - lo)
            tree = CoverTree.build(_units(part.column("vec").combine_chunks()), solid)
            rows.append((part.column("block")[0].as_py(), part.column("node").to_numpy()[tree.order],
                         part.column("n").to_numpy()[tree.order], *tree.pack()))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return cut_lineage(classes.groupBy("block").applyInArrow(build, _TREE))


def _found(trees: DataFrame, pairs: DataFrame | None, threshold: float) -> list[DataFrame]:
    """(node, other, links): a linked weight (other is NULL), or an edge."""
    def read(batch, at, prefix):
        nodes, weights, points, shape, radius = (batch.column(f"{prefix}{c}")[at] for c in ("nodes", "weights", "points", "shape", "radius"))
        nodes, weights = (c.values.to_numpy() for c in (nodes, weights))
        return CoverTree.unpack(points.as_py(), shape.as_py(), radius.as_py(), len(nodes)), nodes, weights

    def walk(batches, cross):
        for batch in batches:
            for at in range(len(batch)):
                edges = Edges()
                a, ids_a, weight_a = read(batch, at, "")
                b, ids_b, weight_b = read(batch, at, "b_") if cross else (a, ids_a, weight_a)
                found_a, found_b = dual_traversal(a, b, ids_a, ids_b, weight_a, weight_b, threshold, edges)
                u, v = edges.forest()
                nodes = [(ids_a, found_a), (ids_b, found_b)] if cross else [(ids_a, found_a)]
                ids = np.concatenate([i[f > 0] for i, f in nodes])
                links = np.concatenate([f[f > 0] for _, f in nodes])
                other = np.concatenate([np.zeros(len(ids), np.int64), v])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([ids, u])), pa.array(other, mask=np.arange(len(other)) < len(ids)),
                    pa.array(np.concatenate([links, np.zeros(len(u), np.int64)]))], ["node", "other", "links"])

    schema = "node bigint, other bigint, links bigint"
    out = [trees.drop("block").mapInArrow(lambda batches: walk(batches, False), schema)]
    if pairs is not None:
        second = trees.select(F.col("block").alias("other_block"), *[F.col(c).alias(f"b_{c}") for c in trees.columns if c != "block"])
        met = pairs.join(trees, "block").join(second, "other_block").drop("block", "other_block")
        out.append(met.mapInArrow(lambda batches: walk(batches, True), schema))
    return out


def _place_large(classes: DataFrame, large: dict, threshold: float, block_rows: int, sample_rows: int):
    """Blocks of the large labels: (classes with block, pairs of blocks, links of whole regions)."""
    spark = classes.sparkSession
    reach = float(np.sqrt(2 - 2 * threshold))
    names = spark.createDataFrame([(g, i) for i, g in enumerate(large)], "label string, large int")
    marked = classes.join(F.broadcast(names), "label")
    sample = hash_sample(marked.select("large", "node", "vec"), "node", sample_rows).orderBy("large", "node").toPandas()
    cuts, first = [], [0]
    for i, g in enumerate(large):
        vectors = sample.loc[sample["large"] == i, "vec"]
        # a label that the sample missed is one region around no point of it
        points = _units(pa.array(vectors.tolist(), pa.list_(pa.float64()))) if len(vectors) else np.eye(1, large[g][1])
        cuts.append(Regions.cut(points, large[g][0], block_rows))
        first.append(first[-1] + len(cuts[-1].scale))

    @F.arrow_udf("struct<region:bigint,gap:double>")
    def place(label: pa.Array, vec: pa.Array) -> pa.Array:
        label = label.to_numpy(zero_copy_only=False)
        region, gap = np.zeros(len(label), np.int64), np.zeros(len(label))
        for i in np.unique(label):
            at = np.flatnonzero(label == i)
            region[at], gap[at] = cuts[i].place(_units(vec.take(pa.array(at))))
            region[at] += first[i]
        return pa.StructArray.from_arrays([pa.array(region), pa.array(gap)], ["region", "gap"])

    placed = cut_lineage(marked.select("label", "node", "n", "vec", place("large", "vec").alias("p"))
                         .select("label", "node", "n", "vec", "p.region", "p.gap"))
    stats = {r["region"]: r for r in placed.groupBy("region").agg(
        F.count("*").alias("rows"), F.sum("n").alias("weight"), F.max("gap").alias("radius"), F.min("node").alias("head")).collect()}
    chunks = {r: -(-s["rows"] // block_rows) for r, s in stats.items()}
    meets, bulk = [], {}
    for cut, base in zip(cuts, first):
        held = [r for r in range(base, base + len(cut.scale)) if r in stats]
        centres, radius = cut.centres[[r - base for r in held]], np.array([stats[r]["radius"] for r in held])
        gap = distances(centres, centres)
        for x, p in enumerate(held):
            for y in np.flatnonzero(gap[x] - radius[x] - radius <= reach + _SLACK).tolist():
                q, wide = held[y], radius[x] + radius[y] + (gap[x, y] if x != y else 0.0)
                if wide < reach - _SLACK:
                    bulk.setdefault(p, []).append(q)
                elif y >= x:
                    for c in range(chunks[p]):
                        partners = range(c + 1 if x == y else 0, chunks[q])
                        if len(partners):
                            meets.append((p * _CHUNKS + c, q * _CHUNKS + partners.start, q * _CHUNKS + partners.stop - 1))
    parts = spark.createDataFrame(list(chunks.items()), "region bigint, chunks int")
    placed = (placed.join(F.broadcast(parts), "region")
              .withColumn("block", F.col("region") * _CHUNKS + F.pmod(F.xxhash64("node"), F.col("chunks"))))
    pairs = (spark.createDataFrame(meets, "block bigint, low bigint, high bigint")
             .select("block", F.explode(F.sequence("low", "high")).alias("other_block"))) if meets else None
    return placed, pairs, _whole_regions(placed, stats, bulk)


def _whole_regions(placed: DataFrame, stats: dict, bulk: dict) -> list[DataFrame]:
    """Links of regions whose points all link with all of another region, or with each other, taken by their weights."""
    if not bulk:
        return []
    # a region's own blocks meet themselves, so its own weight counts without the block's
    rows = [(p, sum(stats[q]["weight"] for q in qs), p in qs, [stats[q]["head"] for q in qs]) for p, qs in bulk.items()]
    known = placed.sparkSession.createDataFrame(rows, "region bigint, weight bigint, own boolean, heads array<bigint>")
    blocks = placed.groupBy("region", "block").agg(F.sum("n").alias("held")).join(F.broadcast(known), "region")
    extra = blocks.select("block", (F.col("weight") - F.when(F.col("own"), F.col("held")).otherwise(0)).alias("links"), "heads")
    members = placed.select("block", "node").join(extra, "block")
    return [members.select("node", F.lit(None).cast("bigint").alias("other"), "links").where("links > 0"),
            members.select("node", F.explode("heads").alias("other"), F.lit(0).cast("bigint").alias("links")).where("node <> other")]


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = 0.93, block_rows: int = 2048, sample_rows: int = 20_000) -> DataFrame:
    """One row per vector: ``id_col``, n_links, component_id, kept.

    Vectors of one label link at a cosine of at least ``threshold`` (above 0). n_links counts the other vectors
    linked directly, component_id is the smallest id reachable, kept is ``id_col = component_id``.
    """
    vec = F.col(vec_col)
    finite = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(F.col(label_col).isNotNull() & vec.isNotNull() & finite & F.exists(vec, lambda v: v != 0), F.lit(False))
    keyed = rows.select(
        F.col(id_col).alias("id"), vec.alias("vec"),
        F.when(usable, F.concat_ws("|", F.size(vec), F.col(label_col).cast("string"))).alias("label"),
        F.when(usable, F.xxhash64(F.lit(1), vec)).alias("h1"), F.when(usable, F.xxhash64(F.lit(2), vec)).alias("h2"))
    classes = cut_lineage(keyed.where("label IS NOT NULL").groupBy("label", "h1", "h2")
                          .agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.first("vec").alias("vec"))
                          .withColumn("node", F.monotonically_increasing_id()))
    sizes = classes.groupBy("label").agg(F.count("*").alias("rows"), F.first(F.size("vec")).alias("width"))
    large = {r["label"]: (r["rows"], r["width"]) for r in sizes.where(F.col("rows") > block_rows).orderBy("label").collect()}
    bins = max(1, -(-(classes.count() - sum(n for n, _ in large.values())) // block_rows))
    small = sizes.where(F.col("rows") <= block_rows).select("label")
    blocks = classes.join(small, "label").select("label", "node", "n", "vec", (-1 - F.pmod(F.xxhash64("label"), F.lit(bins))).alias("block"))
    pairs, whole = None, []
    if large:
        placed, pairs, whole = _place_large(classes, large, threshold, block_rows, sample_rows)
        blocks = blocks.union(placed.select(*blocks.columns))
    found = cut_lineage(reduce(DataFrame.unionAll, [*_found(_trees(blocks, threshold), pairs, threshold), *whole]))
    roots = connected_components(found.where("other IS NOT NULL").select(F.col("node").alias("u"), F.col("other").alias("v")))
    links = found.where("other IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
    named = (classes.select("label", "h1", "h2", "n", "first_id", "node").join(links, "node", "left").join(roots, "node", "left")
             .withColumn("root", F.coalesce("root", "node")))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    results = named.join(smallest, "root").select(
        "label", "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id", F.lit(True).alias("known"))
    joined = keyed.select("id", "label", "h1", "h2").join(results, ["label", "h1", "h2"], "left")
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("id"))
    return joined.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
                         component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
