"""Cross-tokenizer alignment by pointer jumping.

A text is encoded by two tokenizers; both cut the same bytes. Byte offsets where
tokens of both end cut the sequences into groups, the smallest stretches that
both cover with whole tokens. A token points to the farthest-right token that
overlaps it, a token that ends with its partner to itself; doubling the
successors of a whole batch of texts at once (``succ = succ[succ]``) converges
to the last token of every group, which labels the group. Texts of a batch lie
behind each other on one byte axis, so one set of array operations serves all.

A link is a pair of tokens whose byte ranges end together. Links are counted
over the whole corpus by id pair; a text's best links are those whose count is
the highest that their B id has anywhere.

Scale. Texts are encoded once; the per-text rows, with their distinct id pairs,
are written to the shared folder. Pair counts have a map-side step. The counted
pairs go back to the texts by a broadcast where their size is proven small,
else by a shuffle join in which AQE splits frequent pairs.

Defined cases. Texts that are NULL or empty, or whose joined A or B bytes are
not space + text, have no tokens: zeros and an empty ``groups_sha256``. Strings
of special tokens are plain text. Repeated rows are texts of their own, counted
each. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import utf8
from ontime.llm.packing import ordinary_encoder
from ontime.operators.sizing import fits
from ontime.session import checkpoint_dir

SPACE = "▁"  # the mark that SentencePiece writes for a space
_sides: dict = {}


class Side:
    """One tokenizer: texts -> ids, and the bytes of every id."""

    def __init__(self, encode, token_bytes: list[bytes]):
        self.encode, self.bytes = encode, np.array(token_bytes, object)
        self.lengths = np.array([len(b) for b in token_bytes], np.int64)
        self.labels = {sep: np.array([b"%d%s" % (i, sep) for i in range(len(token_bytes))], object) for sep in (b",", b"|", b";")}

    def ids_of(self, text: str, wanted: bytes) -> np.ndarray | None:
        """Ids of a text, or None where their joined bytes are not ``wanted``."""
        ids = np.array(self.encode(text), np.int64)
        return ids if b"".join(self.bytes[ids].tolist()) == wanted else None


def byte_bpe_side(ranks_path: str) -> Side:
    """Space + text by a byte-level BPE rank file."""
    encode, tokens = ordinary_encoder(ranks_path)
    return Side(lambda text: encode(" " + text), tokens)


def piece_side(model_path: str) -> Side:
    """Text by a SentencePiece model with byte fallback, which puts the space in front itself."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    tokens = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            tokens.append(bytes([int(piece[3:5], 16)]))
        else:
            tokens.append(piece.replace(SPACE, " ").encode())
    return Side(model.encode, tokens)


def _side(make, path: str) -> Side:
    """A tokenizer, loaded once per worker."""
    if (make, path) not in _sides:
        _sides[make, path] = make(path)
    return _sides[make, path]


def group_ends(end_a: np.ndarray, end_b: np.ndarray) -> np.ndarray:
    """The last token of each token's group, by pointer jumping.

    ``end_a`` and ``end_b`` are the rising end offsets of both sequences over
    the same bytes. Nodes are A tokens, then B tokens; a group is named by its
    last A token.
    """
    n = len(end_a)
    over_a = np.searchsorted(end_b, end_a)  # the B token over the last byte of each A token: the farthest right
    over_b = np.searchsorted(end_a, end_b)
    ends_here = end_b[over_a] == end_a
    succ = np.concatenate([np.where(ends_here, np.arange(n), n + over_a), over_b])
    while True:
        farther = succ[succ]
        if np.array_equal(farther, succ):
            return succ
        succ = farther


def _numbered(labels: np.ndarray) -> np.ndarray:
    """Group labels (rising) as 0, 1, 2 ..."""
    return np.cumsum(np.concatenate([[0], labels[1:] != labels[:-1]])) if len(labels) else labels


def _group_text(a: Side, b: Side, ids_a, ids_b, group_a, group_b) -> bytes:
    """``a1,a2|b1;a3|b2,b3`` of one text."""
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    at = np.concatenate([2 * group_a, 2 * group_b + 1])[order]
    after = np.concatenate([at[1:], [-1]])
    is_b = (at & 1).astype(bool)
    kind = np.where(after == at, 0, np.where(is_b, 2, 1))
    ids = np.concatenate([ids_a, ids_b])[order]
    out = np.empty(len(ids), object)
    for side, chosen in ((a, ~is_b), (b, is_b)):
        for k, sep in enumerate((b",", b"|", b";")):
            here = chosen & (kind == k)
            out[here] = side.labels[sep][ids[here]]
    return b"".join(out.tolist())[:-1]


def _align_batch(a: Side, b: Side, texts: list[bytes | None]) -> list[tuple]:
    """(n_a, n_b, n_groups, groups_sha256, pairs, times) of every text."""
    encoded = []
    for t in texts:
        ids_a = ids_b = None
        if t:
            text = t.decode("utf-8", "replace")
            ids_a = a.ids_of(text, b" " + t)
            ids_b = b.ids_of(text, b" " + t) if ids_a is not None else None
        encoded.append((ids_a, ids_b) if ids_b is not None else None)
    out = [(0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(texts)
    used = [i for i, e in enumerate(encoded) if e]
    if not used:
        return out
    all_a, all_b = (np.concatenate([encoded[i][s] for i in used]) for s in (0, 1))
    label = group_ends(np.cumsum(a.lengths[all_a]), np.cumsum(b.lengths[all_b]))
    cut_a, cut_b = (np.cumsum([0] + [len(encoded[i][s]) for i in used]).tolist() for s in (0, 1))
    n = len(all_a)
    for k, i in enumerate(used):
        sa, sb = slice(cut_a[k], cut_a[k + 1]), slice(cut_b[k], cut_b[k + 1])
        ids_a, ids_b = all_a[sa], all_b[sb]
        group_a, group_b = _numbered(label[sa]), _numbered(label[n + sb.start:n + sb.stop])
        # the last token of each side of a group end together: that is its link
        last_a, last_b = (ids[np.flatnonzero(np.diff(g, append=g[-1] + 1))] for ids, g in ((ids_a, group_a), (ids_b, group_b)))
        pairs, times = np.unique(last_a * (1 << 32) + last_b, return_counts=True)
        digest = hashlib.sha256(_group_text(a, b, ids_a, ids_b, group_a, group_b)).hexdigest()
        out[i] = (len(ids_a), len(ids_b), len(last_a), digest, pairs, times)
    return out


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None,
                    model_path: str | None = None) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, groups_sha256, and its distinct id pairs with their times.

    A pair is ``a * 2^32 + b``. The paths must exist on every executor
    (default: the public byte-level and piece vocabularies).
    """
    ranks = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    model = model_path or public_tokenizers.path("piece_bpe_32k.model")

    @F.arrow_udf("struct<n_a:bigint,n_b:bigint,n_groups:bigint,groups_sha256:string,pairs:array<bigint>,times:array<bigint>>")
    def align(texts: pa.Array) -> pa.Array:
        rows = _align_batch(_side(byte_bpe_side, ranks), _side(piece_side, model), texts.to_pylist())
        cuts = pa.array(np.cumsum([0] + [len(r[4]) for r in rows]), pa.int32())
        lists = [pa.ListArray.from_arrays(cuts, pa.array(np.concatenate([r[c] for r in rows] or [np.zeros(0)]), pa.int64()))
                 for c in (4, 5)]
        return pa.StructArray.from_arrays(
            [*(pa.array([r[c] for r in rows], pa.int64()) for c in range(3)), pa.array([r[3] for r in rows], pa.string()), *lists],
            ["n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"])

    # the function stands in one projection only, so that no filter can copy it
    return docs.select(F.col(id_col).alias("id"), align(utf8(text_col)).alias("found")).select("id", "found.*")


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n, best): links that hold a pair, and whether no pair of its B id has more."""
    counted = links.groupBy("pair").agg(F.sum("times").alias("n"))
    most = counted.groupBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b")).agg(F.max("n").alias("most"))
    return (counted.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))).join(most, "b")
            .select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def _scratch(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/alignment-{uuid.uuid4().hex}"


def alignment_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None,
                     model_path: str | None = None, max_broadcast_pairs: int = 2_000_000) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    The count table is broadcast only if it has at most ``max_broadcast_pairs`` rows.
    """
    spark, folder = docs.sparkSession, _scratch(docs.sparkSession)
    (align_documents(docs, id_col, text_col, ranks_path, model_path).withColumn("row", F.monotonically_increasing_id())
     .write.parquet(f"{folder}/aligned"))
    aligned = spark.read.parquet(f"{folder}/aligned")
    links = aligned.select("row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times"))))
    pair_counts(links.select("pair", "times")).write.parquet(f"{folder}/counted")
    counted = spark.read.parquet(f"{folder}/counted")
    if fits(counted, max_broadcast_pairs):
        counted = F.broadcast(counted)
    per_row = (links.join(counted, "pair").groupBy("row")
               .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                    F.sum(F.col("times") * F.col("n")).alias("count_sum")))
    return (aligned.select("id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "groups_sha256", "row")
            .join(per_row, "row", "left")
            .select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
                    F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256"))
