import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ontime.llm import ranked_search
from ontime.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def reference(docs, items, k=10):
    """Brute force: every document scored for every item."""
    counts = [Counter(TERM.findall(lowered(t))) for _, t in docs]
    n_docs, n_terms = sum(1 for c in counts if c), sum(sum(c.values()) for c in counts)
    df = Counter(t for c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for (doc, _), c in zip(docs, counts):
            m = 100 - 75 + 75 * sum(c.values()) * n_docs // max(1, n_terms)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in TERM.findall(lowered(text)) if c[t])
            if s > 0:
                scores.append((-s, doc is None, doc))
        scores.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out += [(item, i + 1, doc, -s) for i, (s, _, doc) in enumerate(scores[:k])]
    return out


def as_rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


DOCS = [(i, " ".join(f"w{(i * 7 + j * j) % 23}" for j in range(3 + i % 9))) for i in range(90)]
DOCS += [(1, "w1 w2 W3"), (1, "w1 w2 W3"), (None, "w1 w2 w3"), (500, None), (501, ""), (502, " .,- "), (503, "É É école ECOLE e"),
         (504, "w1 " * 4000), (505, "日本語 w5 a_b x-y 3.14")]
DOCS += [(600 + i, "w1 w2 w3 copy of a copy") for i in range(40)]
ITEMS = [(1, "w1 w2 w3"), (2, "w1 w1 w9 W9, copy"), (2, "école e É"), (3, None), (4, ""), (None, "w5 日本語 b"), (7, "nothing here"),
         (8, " ".join(f"w{i}" for i in range(23)))]


@pytest.mark.parametrize("settings", [{}, {"chunk_docs": 7}, {"block_bytes": 40}, {"k": 1}, {"k": 500}])
def test_search_equals_brute_force(spark, settings):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    want = reference(DOCS, ITEMS, settings.get("k", 10))
    assert as_rows(ranked_search.search(docs, items, **{"k": 10, **settings})) == sorted(want, key=str)


@settings(deadline=None, max_examples=150)
@given(st.lists(st.lists(st.tuples(st.integers(0, 5), st.integers(1, 4)), unique_by=lambda p: p[0], max_size=6), min_size=1, max_size=40),
       st.lists(st.tuples(st.integers(0, 5), st.integers(1, 3)), unique_by=lambda p: p[0], max_size=6), st.integers(1, 4))
def test_chunk_finds_all_that_may_rank(rows, query, k):
    doc = np.array([d for d, r in enumerate(rows) for _ in r], np.int64)
    term, impact = (np.array([p[c] for r in rows for p in r], np.int64) for c in (0, 1))
    scores = [sum(c * dict(r).get(t, 0) for t, c in query) for r in rows]
    docs, got = ranked_search.Chunk(doc, term, impact, len(rows), 6).best(query, k, 0)
    kth = sorted(scores, reverse=True)[min(k, len(scores)) - 1]
    assert dict(zip(docs.tolist(), got.tolist())) == {d: s for d, s in enumerate(scores) if s > 0 and s >= kth}


def test_best_positions_stop_early():
    """One document leads every list: it is found without reading the lists to their ends."""
    n = 20_000
    doc, term = np.repeat(np.arange(n), 3), np.tile(np.arange(3), n)
    impact = np.where(doc == 17, 10 ** 6, 1 + (doc * 7919 + term * 31) % 1000)
    chunk = ranked_search.Chunk(doc, term, impact, n, 3)
    reads = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice):
                reads.append(key.stop - key.start)
            return super().__getitem__(key)
    chunk.list_doc = chunk.list_doc.view(Watched)
    docs, scores = chunk.best([(0, 1), (1, 1), (2, 2)], 1, 0)
    assert docs.tolist() == [17] and scores.tolist() == [4 * 10 ** 6] and sum(reads) < 100


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    want = con.execute(f"select item_id, rank, doc_id, score from ({ORACLE['op13_ranked_search']})").fetchall()
    assert as_rows(QUERIES["op13_ranked_search"](spark, SF)) == sorted(want, key=str) and want


def test_odd_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame(ITEMS + [(9, "fox words w5x5 aa")], "item_id bigint, text string")
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert as_rows(ranked_search.search(odd_docs, items)) == sorted(reference(rows, ITEMS + [(9, "fox words w5x5 aa")]), key=str)
    empty = ranked_search.search(no_docs, items)
    assert empty.collect() == [] and empty.columns == ["item_id", "rank", "doc_id", "score"]
    assert ranked_search.search(odd_docs, items.limit(0)).collect() == []
