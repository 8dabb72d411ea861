import math

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ontime.llm import cover_tree
from ontime.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def reference(rows, threshold=0.93):
    """Brute force over all pairs: (id, n_links, component_id, kept)."""
    def good(v, label):
        return label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    def unit(v):
        x = np.array(v, float) / max(abs(c) for c in v)  # first, as squares of very large or small components have no double
        return x / np.linalg.norm(x)
    units = [unit(v) if good(v, label) else None for _, v, label in rows]
    links = [[j for j in range(len(rows)) if j != i and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
              and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold] for i in range(len(rows))]
    out, part = [], list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, js in enumerate(links):
            low = min([part[i], *(part[j] for j in js)])
            changed |= low != part[i]
            part[i] = low
    for i, (key, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if part[j] == part[i] and rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((key, len(links[i]), component, key == component))
    return out


def clustered(rng, clusters, size, noise, width=8, label=1, first=0):
    rows = []
    for c in range(clusters):
        centre = rng.normal(size=width)
        rows += [(first + c * size + i, (centre / np.linalg.norm(centre) + rng.normal(size=width) * noise).tolist(), label)
                 for i in range(size)]
    return rows


@settings(deadline=None, max_examples=80)
@given(st.integers(0, 10 ** 6), st.integers(1, 6), st.integers(1, 40), st.sampled_from([0.0, 0.02, 0.08, 0.3]), st.booleans())
def test_dual_traversal_equals_all_pairs(seed, clusters, size, noise, cross):
    rng = np.random.default_rng(seed)
    x = np.array([r[1] for r in clustered(rng, clusters, size, noise, 3)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    weight, ids, edges = rng.integers(1, 5, len(x)), np.arange(len(x)) * 3 + 1, cover_tree.Edges()
    hit = x @ x.T >= 0.93
    if cross:
        half = len(x) // 2 or 1
        a, b = cover_tree.CoverTree.build(x[:half], leaf=4), cover_tree.CoverTree.build(x[half:] if half < len(x) else x[:1], leaf=4)
        at_b = np.arange(half, len(x)) if half < len(x) else np.arange(1)
        oa, ob = a.order, at_b[b.order]
        fa, fb = cover_tree.dual_traversal(a, b, ids[oa], ids[ob], weight[oa], weight[ob], 0.93, edges)
        assert fa.tolist() == (hit[np.ix_(oa, ob)] @ weight[ob]).tolist() and fb.tolist() == (hit[np.ix_(ob, oa)] @ weight[oa]).tolist()
        hit = np.zeros_like(hit)
        hit[np.ix_(oa, ob)] = x[oa] @ x[ob].T >= 0.93
        hit |= hit.T
    else:
        np.fill_diagonal(hit, False)
        tree = cover_tree.CoverTree.build(x, solid=0.1, leaf=4)
        o = tree.order
        found, _ = cover_tree.dual_traversal(tree, tree, ids[o], ids[o], weight[o], weight[o], 0.93, edges)
        assert found.tolist() == (hit[np.ix_(o, o)] @ weight[o]).tolist()
    u, v = edges.forest()
    for p, q in zip((u // 3).tolist(), (v // 3).tolist()):
        assert p != q
    part = np.arange(len(x))
    spanned = part.copy()
    for _ in range(len(x)):
        part = np.array([min([part[i], *part[hit[i]]]) for i in range(len(x))])
        for p, q in zip(u // 3, v // 3):
            spanned[p] = spanned[q] = min(spanned[p], spanned[q])
    assert spanned.tolist() == part.tolist()


def test_nested_levels_halve_their_radii():
    x = np.random.default_rng(1).normal(size=(300, 4))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    t = cover_tree.CoverTree.build(x, leaf=3)
    for i in range(len(t.low)):
        assert np.isclose(cover_tree.distances(t.points[t.low[i]:t.high[i]], t.points[t.centre[i]][None]).max(), t.radius[i], atol=1e-7)
        for c in t.opened(i):
            assert c == i or t.radius[c] <= t.radius[i] / 2
        if t.children[i]:
            assert t.centre[t.child[i]] == t.centre[i] and t.low[t.child[i]] == t.low[i]
    assert sorted(t.order.tolist()) == list(range(300))


def test_traversal_leaves_far_nodes_closed():
    """Tight clusters far apart: few of all pairs are compared one by one."""
    x = np.array([r[1] for r in clustered(np.random.default_rng(2), 40, 50, 0.01, 16)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    t = cover_tree.CoverTree.build(x, solid=0.18)
    assert len(t.low) < 400
    found, _ = cover_tree.dual_traversal(t, t, t.order, t.order, np.ones(2000, int), np.ones(2000, int), 0.93, cover_tree.Edges())
    assert (found >= 49).all()


def rows_of(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


@pytest.mark.parametrize("settings", [{}, {"block_rows": 16, "sample_rows": 60}, {"block_rows": 5, "sample_rows": 400}])
def test_operator_equals_brute_force(spark, settings):
    rng = np.random.default_rng(5)
    rows = clustered(rng, 9, 12, 0.05) + clustered(rng, 1, 70, 0.02, label=1, first=200) + clustered(rng, 30, 1, 0, label=2, first=300)
    rows += clustered(rng, 3, 4, 0.1, label=3, first=400) + [(500 + i, rows[0][1], 1) for i in range(40)]
    rows += [(600, None, 1), (601, [0.0] * 8, 1), (602, [1.0, None] * 4, 1), (603, [float("nan")] * 8, 1), (604, [float("inf")] * 8, 1),
             (605, rows[0][1], None), (606, [1.0, 2.0], 1), (607, [2.0, 4.0], 1), (None, rows[0][1], 1), (None, [-1.0] * 8, 9),
             (1, rows[0][1], 1), (1, [5.0] + [0.0] * 7, 7), (608, [1e-320] * 8, 8), (609, [1e300] * 8, 8), (610, [], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(3)
    assert rows_of(cover_tree.near_duplicates(df, **settings)) == sorted(reference(rows), key=str)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = con.execute(f"select vec_id, n_links, component_id, kept from ({ORACLE['op12_near_vectors']})").fetchall()
    assert rows_of(QUERIES["op12_near_vectors"](spark, SF)) == sorted(want, key=str)


def test_odd_tables(spark):
    schema = "vec_id bigint, embedding array<float>, label string, node int, block string, n int, root int"
    assert cover_tree.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    only = spark.createDataFrame([(3, None, "a", 1, "x", 2, 3), (4, [1.0], "a", 1, "x", 2, 3), (2, [2.0], "a", 1, "x", 2, 3)], schema)
    assert rows_of(cover_tree.near_duplicates(only)) == [(2, 1, 2, True), (3, 0, 3, True), (4, 1, 2, False)]
