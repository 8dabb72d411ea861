import math

import numpy as np
from pyspark.sql import functions as F

from ontime.llm import ann

SF = "/root/testdata/sf0.01"


def dot(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


def brute(rows, queries, k):
    out = {}
    for q, qv in queries:
        scored = sorted((-dot(qv, v), i) for i, v in rows if i != q)
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_recall_on_embeddings(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    got = ann.search(df, F.col("vec_id") % 20 == 0, k=20).collect()
    found = sum(r.vec_id in {i for i, _ in want[r.query_id]} for r in got)
    assert found / (20 * len(want)) >= 0.9
    scores = {(q, i): s for q, hits in want.items() for i, s in hits}
    assert all(scores[r.query_id, r.vec_id] == r.score for r in got if (r.query_id, r.vec_id) in scores)
    for q in want:
        mine = sorted((r.rank, -r.score, r.vec_id) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 21)) and mine == sorted(mine, key=lambda m: m[1:])


def hot_recall(spark, rows, queries):
    """Recall of the queries that are not copies, on a table where one vector is a third of the rows."""
    top = max(i for i, _ in rows) + 1
    hot = rows + [(top + i, rows[1][1]) for i in range(len(rows) // 2)]
    df = spark.createDataFrame(hot, "vec_id bigint, embedding array<float>").repartition(4)
    ids, x = np.array([i for i, _ in hot]), np.array([v for _, v in hot], np.float64)
    got, recalls = {}, []
    for r in ann.search(df, F.col("vec_id").isin(queries), k=20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    for q in queries:
        score = ann.inner_products(x[ids == q], x)[0]
        score[ids == q] = -np.inf
        recalls.append(len(got[q] & set(ids[np.lexsort((ids, -score))[:20]].tolist())) / 20)
    return np.mean(recalls)


def test_recall_beside_a_hot_vector(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    queries = [i for i, _ in rows if i % 4 == 0 and i != rows[1][0]]
    assert hot_recall(spark, rows, queries) >= 0.93


def test_copies_count_once(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(50)]
    df = spark.createDataFrame(rows + [(100 + i, rows[7][1]) for i in range(70)], "vec_id bigint, embedding array<float>")
    index = ann.build_index(df, "vec_id", "embedding", 4, 1000)
    assert index.counts.sum() == 50 and index.rows.sum() == 120
    hot = index.cell_of(np.array([rows[7][1]]))[0]
    assert index.rows[hot] - index.counts[hot] == 70


def odd_vectors():
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100 + i, [1.0] * 6) for i in range(300)]  # one vector very often
    rows += [(500, None), (501, [0.0] * 6), (502, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (503, [math.nan] * 6),
             (504, [math.inf] + [1.0] * 5), (505, [1.0] * 5), (506, []), (None, [1.0] * 6), (520, [1.0] * 6)]
    return rows


def test_ties_hot_vector_and_unusable_rows(spark):
    rows = odd_vectors()
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<float>, cell int, block int").repartition(4)
    good = [(i, v) for i, v in rows if i is not None and i not in range(500, 510)]
    got = ann.search(df, F.col("vec_id") % 20 == 0, k=5, candidates=1.0, centroids=8, block_rows=32, query_block=4)
    out = {}
    for r in got.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert out == brute(good, [r for r in good if r[0] % 20 == 0], 5)


def test_few_and_no_candidates(spark):
    schema = "vec_id bigint, embedding array<float>"
    three = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (20, [0.5, 0.0]), (0, [2.0, 0.0])], schema)
    got = ann.search(three, F.col("vec_id") % 20 == 0, k=5).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got if r.query_id == 20) == [(20, 1, 0), (20, 2, 0), (20, 3, 1)]
    assert ann.search(three.limit(0), F.lit(True)).count() == 0
    assert ann.search(spark.createDataFrame([(0, None)], schema), F.lit(True)).count() == 0


def test_heap_visits_cells_by_falling_sum():
    rng = np.random.default_rng(2)
    index = ann.MultiIndex(rng.normal(size=(7, 3)), rng.normal(size=(5, 3)), rng.integers(0, 4, 35))
    q = rng.normal(size=6)
    sums = ((index.first @ q[:3])[:, None] + (index.second @ q[3:])[None, :]).ravel()
    for wanted in (1, 10, 40, 10 ** 6):
        seen = index.visited(q, wanted)
        assert index.counts[seen].sum() >= min(wanted, index.counts.sum())
        if seen.any() and not seen.all():
            assert sums[seen].min() >= sums[~seen].max()


def test_blocks_split_large_cells():
    start, parts, n = ann._block_layout(np.array([3, 0, 100, 5, 5]), 10)
    assert parts.tolist() == [1, 1, 10, 1, 1] and n == max(start + parts)
    assert set(range(start[2], start[2] + 10)).isdisjoint({start[0], start[3], start[4]})


def test_one_component_and_repeated_query_ids(spark):
    """One-wide vectors, two queries of one id, and two equal query rows: each is answered on its own."""
    rows = [(i, [float(i % 7 - 3)]) for i in range(1, 40)]
    got = ann.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") % 20 == 0, k=3,
                     candidates=1.0).collect()
    want = sorted((r for r in rows if r[0] != 20 and r[1] != [0.0]), key=lambda r: (-r[1][0] * (20 % 7 - 3), r[0]))[:3]
    assert [(r.rank, r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [(i + 1, r[0]) for i, r in enumerate(want)]
    rng = np.random.default_rng(4)
    rows = [(0, v.tolist()) for v in rng.normal(size=(2, 6))] + [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 6)), 1)]
    rows.append(rows[0])
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted((r["rank"], r.vec_id, round(r.score, 9)) for r in ann.search(df, F.col("vec_id") == 0, k=4, candidates=1.0).collect())
    want = []
    for _, q in (rows[0], rows[1], rows[0]):
        near = sorted(((-float(np.dot(q, v)), i) for i, v in rows if i != 0))[:4]
        want += [(n + 1, i, round(-s, 9)) for n, (s, i) in enumerate(near)]
    assert got == sorted(want)


def test_few_ids_keep_their_sample(spark):
    """Half of the rows share an id: the index is built from all the same (a sample by id alone may be empty)."""
    rng = np.random.default_rng(6)
    rows = [(3 if i % 2 else 20, v.tolist()) for i, v in enumerate(rng.normal(size=(600, 4)))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = ann.search(df, F.col("vec_id") == 20, k=5, sample_rows=50)
    assert got.count() == 300 * 5


def test_reach_takes_no_more_cells_than_wanted():
    """The walk stops at the cell that completes the wanted vectors, whatever the steps of its runs."""
    rng = np.random.default_rng(8)
    index = ann.MultiIndex(rng.normal(size=(40, 3)), rng.normal(size=(30, 3)), rng.integers(0, 3, 1200))
    for q in rng.normal(size=(20, 6)):
        sums = ((index.first @ q[:3])[:, None] + (index.second @ q[3:])[None, :]).ravel()
        order = np.argsort(-sums)
        held = np.cumsum(index.counts[order])
        for wanted in (1, 7, 300, int(held[-1])):
            seen = np.flatnonzero(index.visited(q, wanted))
            assert set(seen) == set(order[:np.searchsorted(held, wanted) + 1])
    assert index.reach(np.full(6, 1e308), 5) == -np.inf
    flat = ann.MultiIndex(np.zeros((2, 3)), np.zeros((2, 3)), np.ones(4, int))
    assert flat.visited(np.ones(6), 1).all()  # equal sums are not told apart
