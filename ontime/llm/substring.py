"""Duplicate spans by minimum-hash anchors and window counting over content-defined blocks.

A window is ``width`` consecutive words. Every window has an anchor: the
smallest hash of the ``SEED``-word sequences inside it. Equal windows have
equal anchors, wherever they stand. A reference block is a longest run of
consecutive windows of a document with one anchor value; the corpus is the
sequence of its blocks, and the anchors are the index over all of them.

Finding. No factors are parsed. A block whose anchor occurs once holds no repeated window. Where
every block of an anchor has the same words, all windows of the block are
duplicates. In all other blocks of a repeated anchor a copy may end inside
the block. One document of each distinct block text gives its windows, and each
window is looked up among the windows of every reference block with that
anchor, so boundaries are exact to the word.

Scale. Per document about one row in 14 words is shuffled (anchor, block
hash, place); only blocks of repeated anchors go on, and only distinct block
texts at boundaries are expanded to windows. Counts have a map-side step, so
frequent passages are combined before the shuffle; joins can be split by AQE.
Sequences are compared by 64-bit hashes within an anchor of 64 bits.

Defined cases. NULL text has no words; texts shorter than a window lose
nothing. Repeated rows are copies of each other, so both lose the words of
every window. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import row_key, row_with, utf8, windows_of, with_row
from ontime.session import cut_lineage

SEED = 8
_SLICE_WORDS = 1 << 18
_P = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_P_INV = pow(_P, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class _Sequences:
    """Hashes of word runs of one or more texts laid end to end."""

    def __init__(self, words: list[bytes]):
        n = len(words)
        x = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_mix(x) * _powers(_P, n), out=self.sums[1:])
        self.back = _powers(_P_INV, n + 1)

    def runs(self, starts: np.ndarray, ends: np.ndarray | int) -> np.ndarray:
        return _mix((self.sums[ends] - self.sums[starts]) * self.back[starts])


def _slices(texts: pa.Array):
    """Lists of the words of consecutive texts, about _SLICE_WORDS each (one text at least)."""
    group, size = [], 0
    for t in texts:
        words = (t.as_py() or b"").split()
        if group and size + len(words) > _SLICE_WORDS:
            yield group
            group, size = [], 0
        group.append(words)
        size += len(words)
    if group:
        yield group


def _blocks_of(group: list[list[bytes]], width: int):
    """Per text the number of blocks, then p0, n, anchor, hash, inner of all blocks."""
    lengths = np.array([len(w) for w in group], np.int64)
    empty = (np.zeros(len(group), np.int64), *(np.zeros(0, t) for t in (np.int32, np.int32, np.int64, np.int64, bool)))
    total = int(lengths.sum())
    if not len(lengths) or lengths.max() < width:
        return empty
    seq = _Sequences([w for words in group for w in words])
    first = np.cumsum(lengths) - lengths
    text_of = np.repeat(np.arange(len(group)), lengths)
    seeds = seq.runs(np.arange(total - SEED + 1), np.arange(SEED, total + 1))
    anchor = windows_of(seeds, width - SEED + 1)  # one for every window start
    starts = np.arange(len(anchor))
    inside = starts + width <= (first + lengths)[text_of[: len(anchor)]]
    starts, anchor = starts[inside], anchor[inside]
    owner = text_of[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(starts)))
    p0 = starts[at]
    whole = seq.runs(p0, p0 + count + width - 1)
    # a window that stands twice within its own block
    block_of = np.cumsum(new) - 1
    mine = seq.runs(starts, starts + width) ^ _mix(block_of.astype(np.uint64) + np.uint64(1))
    order = np.argsort(mine)
    same = mine[order][1:] == mine[order][:-1]
    inner = np.zeros(len(at), bool)
    inner[block_of[order[1:][same]]] = True
    per_text = np.bincount(owner[at], minlength=len(group))
    return (per_text, (p0 - first[owner[at]]).astype(np.int32), count.astype(np.int32),
            anchor[at].view(np.int64), whole.view(np.int64), inner)


_BLOCK = "array<struct<p0:int,n:int,anchor:bigint,whole:bigint,inner:boolean>>"


def _blocks_column(width: int):
    fields = [("p0", pa.int32()), ("n", pa.int32()), ("anchor", pa.int64()), ("whole", pa.int64()), ("inner", pa.bool_())]

    @F.arrow_udf(_BLOCK)
    def blocks(texts: pa.Array) -> pa.Array:
        parts = [_blocks_of(g, width) for g in _slices(texts)]
        columns = [np.concatenate([p[i] for p in parts]) for i in range(1, 6)]
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([p[0] for p in parts]))])
        flat = pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [f for f, _ in fields])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat).cast(pa.list_(pa.struct(fields)))

    return blocks


def _windows_column(width: int):
    """(text, [(p0, n, anchor)]) -> [(p, anchor, window)] for the windows of those blocks."""
    fields = [("p", pa.int32()), ("anchor", pa.int64()), ("window", pa.int64())]

    @F.arrow_udf("array<struct<p:int,anchor:bigint,window:bigint>>")
    def windows(texts: pa.Array, wanted: pa.Array) -> pa.Array:
        offsets, columns = [0], ([], [], [])
        for text, blocks in zip(texts, wanted):
            seq = _Sequences((text.as_py() or b"").split())
            p0, n, anchor = (c.to_numpy(zero_copy_only=False) for c in blocks.values.flatten())
            at = np.repeat(p0.astype(np.int64) - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            columns[0].append(at.astype(np.int32))
            columns[1].append(np.repeat(anchor, n))
            columns[2].append(seq.runs(at, at + width).view(np.int64))
            offsets.append(offsets[-1] + len(at))
        flat = pa.StructArray.from_arrays([pa.array(np.concatenate(c) if c else [], t) for c, (_, t) in zip(columns, fields)],
                                          [f for f, _ in fields])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat).cast(pa.list_(pa.struct(fields)))

    return windows


def duplicate_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 35) -> DataFrame:
    """(_k1, _k2, p0, n): runs of n window starts from word p0 whose windows stand elsewhere, too.

    The key is that of ``common.row_key``. Runs of one document may touch.
    """
    if width <= SEED:
        raise ValueError(f"a window must be longer than {SEED} words")
    keyed = docs.select(*row_key(id_col, text_col), utf8(text_col).alias("_text"))
    blocks = keyed.select("_k1", "_k2", F.inline(_blocks_column(width)("_text")))
    index = (blocks.groupBy("anchor")
             .agg(F.count("*").alias("copies"), F.min("whole").alias("w0"), F.max("whole").alias("w1"),
                  F.max("inner").alias("any_inner"))
             .where("copies > 1 OR any_inner")
             .select("anchor", (F.expr("copies > 1 AND w0 = w1")).alias("one_text")))
    found = cut_lineage(blocks.select("_k1", "_k2", "p0", "n", "anchor", "whole").join(index, "anchor"))
    long_factors = found.where("one_text").select("_k1", "_k2", "p0", "n")

    boundary = found.where("NOT one_text")
    place = F.struct("_k1", "_k2", "p0", "n")
    texts = cut_lineage(boundary.groupBy("anchor", "whole").agg(F.count("*").alias("copies"), F.min(place).alias("first")))
    repeated = boundary.join(texts.where("copies > 1").select("anchor", "whole"), ["anchor", "whole"], "left_semi")
    # one document gives the windows of each distinct block text
    givers = (texts.select("first.*", "anchor", "copies").groupBy("_k1", "_k2")
              .agg(F.collect_list(F.struct("p0", "n", "anchor")).alias("blocks")))
    windows = (keyed.join(givers, ["_k1", "_k2"])
               .select("_k1", "_k2", F.inline(_windows_column(width)("_text", "blocks"))))
    elsewhere = windows.groupBy("anchor", "window").count().where("count > 1").select("anchor", "window")
    at_boundary = (windows.join(elsewhere, ["anchor", "window"], "left_semi")
                   .select("_k1", "_k2", F.col("p").alias("p0"), F.lit(1).alias("n")))
    return long_factors.unionByName(repeated.select("_k1", "_k2", "p0", "n")).unionByName(at_boundary)


def _cut(words: list[bytes], p0: np.ndarray, n: np.ndarray, width: int) -> tuple[int, bytes]:
    """How many words the spans cover, and the others joined by a space."""
    edge = np.zeros(len(words) + 1, np.int32)
    np.add.at(edge, p0, 1)
    np.add.at(edge, p0 + n + width - 1, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return int(covered.sum()), b" ".join([w for w, c in zip(words, covered.tolist()) if not c])


def _cut_column(width: int):
    out = [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())]

    @F.arrow_udf("struct<n_words:bigint,n_removed:bigint,kept_text:string>")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        columns = ([], [], [])
        for text, found in zip(texts, spans):
            words = (text.as_py() or b"").split()
            removed, kept = 0, None
            if found.is_valid:
                p0, n = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in found.values.flatten())
                removed, kept = _cut(words, p0, n, width)
            columns[0].append(len(words))
            columns[1].append(removed)
            columns[2].append((b" ".join(words) if kept is None else kept).decode())
        return pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, out)], [f for f, _ in out])

    return cut


def remove_duplicate_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           width: int = 35) -> DataFrame:
    """Every input row with n_words, n_removed and kept_text (the kept words joined by one space)."""
    spans = (duplicate_spans(docs, id_col, text_col, width).groupBy("_k1", "_k2")
             .agg(F.collect_list(F.struct("p0", "n")).alias("_spans")))
    text = utf8(F.col("_row").getField(text_col))
    cut = (with_row(docs, *row_key(id_col, text_col)).join(spans, ["_k1", "_k2"], "left")
           .select("_row", _cut_column(width)(text, "_spans").alias("_cut")))
    return row_with(cut, docs.columns, "_cut")
