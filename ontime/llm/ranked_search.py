"""Ranked lexical search by the Best Position Algorithm.

Every term of a query has an impact list: the documents that hold it, by falling
impact (its share of their score). All lists of a query are read from the top,
side by side. A document met for the first time is looked up directly in the
other lists, which gives its whole score and its position in each. A list's
best position is the last one up to which every entry was seen, by reading or
by a direct access; the impacts there add up to a bound on every document not
seen yet. It is lower than the bound of the positions read last, as direct
accesses move best positions ahead of them. Reading stops when the bound is
strictly below the k-th score, so that no document that ties with it is missed.

A term's weight is ``floor(1000 * ln((2N + 2) / (2 df + 1)))`` and a document's
length factor ``100 - 75 + (75 * n * N) div L``; an impact is
``weight * ((10^9 * tf) div (1000 * tf + 8 * factor))`` in 64-bit integers.

Scale. Texts are read once for a block of queries (all queries whose texts
amount to ``block_bytes``); what is kept of a document is its length and its
counts of the block's terms, in a table in the shared folder. N, L and df are
aggregates over all documents. Documents are searched in chunks of at most
``chunk_docs``, each with impact lists of its own, so that no list of a frequent
term is gathered in one place. A task returns at most ``k`` rows for a query;
these are ranked in two steps with map-side limits.

Defined cases. NULL texts have no term, and neither such documents nor such
queries give a row. Repeated rows, of documents or queries, count and rank on
their own. Ties go to the smaller id, NULL ids last. A document that holds none
of the terms, or only terms of weight 0, is not returned. Empty tables give an
empty result. Other columns are not read.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime.llm.common import utf8
from ontime.session import checkpoint_dir

# Letters, digits and all bytes above ASCII make terms; A-Z are lowered.
_TO_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TO_TERMS).split()


class Chunk:
    """Impact lists over some documents: by falling impact, and by document for direct access."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int):
        self.n_docs = n_docs
        self.start = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=n_terms))])
        by_doc = np.argsort(term, kind="stable")  # postings come document by document
        by_impact = np.lexsort((-impact, term))
        self.direct_doc, self.direct_impact = doc[by_doc], impact[by_doc]
        self.list_doc, self.list_impact = doc[by_impact], impact[by_impact]
        place = np.empty(len(doc), np.int64)
        place[by_impact] = np.arange(len(doc))
        self.direct_place = place[by_doc] - self.start[term[by_doc]]  # position in its list

    def best(self, query: list[tuple[int, int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores, all that may be among the ``k`` best or tie with the last of them.

        ``query`` holds (term, repeats). ``floor`` is a score that ``k`` documents elsewhere reach (else 0).
        """
        lists = [(c, self.start[t], self.start[t + 1]) for t, c in query if self.start[t + 1] > self.start[t]]
        seen, score = np.zeros(self.n_docs, bool), np.zeros(self.n_docs, np.int64)
        marks = [np.zeros(hi - lo + 1, bool) for _, lo, hi in lists]  # the entry behind the end is never seen
        places, depth, step = [0] * len(lists), 0, 8
        while lists:
            read = np.concatenate([self.list_doc[lo + depth:min(hi, lo + depth + step)] for _, lo, hi in lists])
            new = np.unique(read[~seen[read]])
            seen[new] = True
            bound = 0
            for j, (c, lo, hi) in enumerate(lists):
                docs = self.direct_doc[lo:hi]
                at = np.searchsorted(docs, new)
                at[at == hi - lo] = 0
                hit = docs[at] == new
                at = lo + at[hit]
                score[new[hit]] += c * self.direct_impact[at]
                marks[j][self.direct_place[at]] = True
                places[j] += int(np.argmin(marks[j][places[j]:]))
                if places[j] < hi - lo:  # a list seen to its end holds no unseen document
                    bound += c * int(self.list_impact[lo + places[j] - 1])
            depth, step = depth + step, 2 * step
            found = score[seen]
            kth = int(np.partition(found, len(found) - k)[len(found) - k]) if len(found) >= k else 0
            if bound < max(kth, floor) or depth >= max(hi - lo for _, lo, hi in lists):
                break
        docs = np.flatnonzero(score > 0)
        if len(docs) > k:
            docs = docs[score[docs] >= np.partition(score[docs], len(docs) - k)[len(docs) - k]]
        return docs, score[docs]


def _counts_table(docs: DataFrame, id_col: str, text_col: str, vocabulary: dict[bytes, int], path: str) -> DataFrame:
    """id, n (terms in all), and the terms of the vocabulary with their counts, written and read again."""

    @F.arrow_udf("struct<n:bigint,terms:array<int>,tf:array<bigint>>")
    def count(texts: pa.Array) -> pa.Array:
        n, cuts, terms, tf = [], [0], [], []
        for t in texts.to_pylist():
            words = terms_of(t)
            n.append(len(words))
            held = [(vocabulary[w], c) for w, c in Counter(words).items() if w in vocabulary]
            terms.extend(t for t, _ in held)
            tf.extend(c for _, c in held)
            cuts.append(len(terms))
        cuts = pa.array(cuts, pa.int32())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.ListArray.from_arrays(cuts, pa.array(terms, pa.int32())),
                                           pa.ListArray.from_arrays(cuts, pa.array(tf, pa.int64()))], ["n", "terms", "tf"])

    docs.select(F.col(id_col).cast("bigint").alias("id"), count(utf8(text_col)).alias("c")).select("id", "c.*").write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _search_block(docs: DataFrame, queries: list[tuple], id_col: str, text_col: str, k: int, chunk_docs: int, path: str):
    """(query, id, score) candidates for one block of (text, ...) queries; None if no document has a term."""
    vocabulary: dict[bytes, int] = {}
    asked = [[(vocabulary.setdefault(t, len(vocabulary)), c) for t, c in Counter(terms_of(q)).items()] for q in queries]
    counted = _counts_table(docs, id_col, text_col, vocabulary, path)
    n_docs, n_terms = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not n_docs:
        return None
    df = {r["t"]: r["df"] for r in counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect()}
    weight = np.zeros(max(1, len(vocabulary)), np.int64)
    for t, n in df.items():
        weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1)))
    asked = [[(t, c) for t, c in q if weight[t] > 0] for q in asked]

    def search(batches):
        best: list[tuple] = [(np.zeros(0, np.int64),) * 3] * len(asked)  # score, id, id is NULL
        held: list[tuple] = []

        def run():
            ids, no_id, n, sizes, term, tf = (np.concatenate(c) for c in zip(*held))
            doc = np.repeat(np.arange(len(ids)), sizes)
            factor = 25 + 75 * n * n_docs // n_terms
            impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * factor[doc]))
            chunk = Chunk(doc, term, impact, len(ids), len(weight))
            for i, q in enumerate(asked):
                floor = int(best[i][0][-1]) if len(best[i][0]) == k else 0
                d, score = chunk.best(q, k, floor)
                rows = [np.concatenate(c) for c in zip(best[i], (score, ids[d], no_id[d]))]
                order = np.lexsort((rows[1], rows[2], -rows[0]))[:k]
                best[i] = tuple(c[order] for c in rows)

        n_held = 0
        for batch in batches:
            ids, n, terms, tf = (batch.column(c) for c in ("id", "n", "terms", "tf"))
            for lo in range(0, len(batch), chunk_docs):
                part = slice(lo, lo + chunk_docs)
                t = terms[part]
                held.append((ids[part].fill_null(0).to_numpy(zero_copy_only=False), ids[part].is_null().to_numpy(zero_copy_only=False),
                             n[part].to_numpy(), np.diff(t.offsets.to_numpy()), t.flatten().to_numpy(), tf[part].flatten().to_numpy()))
                n_held += len(held[-1][0])
                if n_held >= chunk_docs:
                    run()
                    held.clear()
                    n_held = 0
        if held:
            run()
        out = [np.concatenate(c) for c in zip(*best)] if best else [np.zeros(0, np.int64)] * 3
        query = np.repeat(np.arange(len(best)), [len(b[0]) for b in best])
        yield pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), pa.array(out[1].astype(np.int64), mask=out[2].astype(bool)),
                                          pa.array(out[0].astype(np.int64))], ["query", "id", "score"])

    return counted.where(F.size("terms") > 0).mapInArrow(search, "query int, id bigint, score bigint")


def _top(found: DataFrame, by: list, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", query_id: str = "item_id",
           query_text: str = "text", k: int = 10, chunk_docs: int = 20_000, block_bytes: int = 4 << 20) -> DataFrame:
    """The ``k`` documents of highest score for every query: ``query_id``, rank (from 1), ``id_col``, score.

    Queries are dealt by hash into blocks of about ``block_bytes`` of text; a block and its vocabulary
    come to the driver and go to the tasks, and each block is one pass over the documents.
    """
    spark = docs.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/search-{uuid.uuid4().hex}"
    asked = queries.select(F.col(query_id).alias("id"), utf8(query_text).alias("text")).where(F.col("text").isNotNull())
    n_blocks = max(1, -(-(asked.agg(F.sum(F.length("text"))).first()[0] or 0) // block_bytes))
    block = F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks))
    key_type = queries.schema[query_id].dataType
    results = []
    for b in range(n_blocks):
        rows = asked.where(block == b).orderBy("id", "text").collect()
        found = _search_block(docs, [bytes(r["text"]) for r in rows], id_col, text_col, k, chunk_docs, f"{folder}/{b}") if rows else None
        if found is None:
            continue
        first = _top(found, ["query", F.pmod(F.xxhash64("id"), F.lit(64))], k).drop("rank")
        ids = F.array(*[F.lit(r["id"]).cast(key_type) for r in rows])
        results.append(_top(first, ["query"], k).select(F.get(ids, F.col("query")).alias(query_id), "rank",
                                                        F.col("id").alias(id_col), "score"))
    if not results:
        return (docs.limit(0).select(F.lit(None).cast(key_type).alias(query_id), F.lit(0).alias("rank"),
                                     F.lit(0).cast("bigint").alias(id_col), F.lit(0).cast("bigint").alias("score")))
    return reduce(DataFrame.unionAll, results)
