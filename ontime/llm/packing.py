"""Packing by power-of-two decomposition.

Every document is tokenised whole, closed with an end id and cut into pieces
of power-of-two length: as many of ``max_length`` as fit, then one for each
binary digit of the rest, longest first. Pieces of one length form a bucket;
a piece is a whole sequence of its bucket, so no sequence crosses documents
and none is padded. The work is map-only: nothing is shuffled. Batches for
training are read bucket by bucket (``write_buckets`` partitions by length).

Ids are those of the ``tokenizers`` file (JSON) beside the rank file: ordinary
text by tiktoken, and the JSON's added tokens (``<|endoftext|>``) wherever
their literal stands in a text. A rank file without a JSON has no added tokens.

Defined cases. NULL or empty text is the end id alone. Repeated rows are
packed again under their own sequence ids. Ids of pieces are unique in one
run of the job over the same input splits. Empty tables give empty results.
"""

from __future__ import annotations

import base64
import json
import os
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_ID = 1
_RUN_OF_SPACE = re.compile(r"\s\s")
_LOOKAHEAD = r"|\s+(?!\S)"
_encoders: dict[tuple[str, bool], tiktoken.Encoding] = {}
_added: dict[str, dict[str, int]] = {}


def _encoding(ranks_path: str, lookahead: bool) -> tiktoken.Encoding:
    """The encoding of a rank file, loaded once per worker and only if a text needs it."""
    key = (ranks_path, lookahead)
    if key not in _encoders:
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        pattern = public_tokenizers.PATTERN if lookahead else public_tokenizers.PATTERN.replace(_LOOKAHEAD, "")
        _encoders[key] = tiktoken.Encoding(f"ranks-{lookahead}", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[key]


def added_tokens(ranks_path: str) -> dict[str, int]:
    """Literal -> id of the added tokens in the JSON beside a rank file, read once per worker."""
    if ranks_path not in _added:
        path, tokens = os.path.splitext(ranks_path)[0] + ".json", []
        if os.path.exists(path):
            with open(path, encoding="utf-8") as f:
                tokens = json.load(f)["added_tokens"]
        if any(t[flag] for t in tokens for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path}: only added tokens matched as they stand are supported")
        _added[ranks_path] = {t["content"]: t["id"] for t in tokens}
    return _added[ranks_path]


def ordinary_encoder(ranks_path: str):
    """(text -> ids without added tokens, bytes of every id) of a byte-level BPE rank file.

    The look-ahead of the splitting pattern matters only for runs of two or
    more white-space characters; other texts take the pattern without it,
    which is several times faster and splits them alike.
    """
    def encode(text: str) -> list[int]:
        return _encoding(ranks_path, bool(_RUN_OF_SPACE.search(text))).encode_ordinary(text)

    full = _encoding(ranks_path, True)
    return encode, [full.decode_single_token_bytes(i) for i in range(full.max_token_value + 1)]


def encoder(ranks_path: str):
    """text -> ids for a byte-level BPE rank file and the added tokens of its JSON.

    Texts are cut at the literals of added tokens (the longest where several
    start), and the stretches between are encoded on their own, as tokenizers does.

    The look-ahead of the splitting pattern matters only for runs of two or
    more white-space characters; other texts take the pattern without it,
    which is several times faster and splits them alike.
    """
    added = added_tokens(ranks_path)
    literals = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None

    def ordinary(text: str) -> list[int]:
        return _encoding(ranks_path, bool(_RUN_OF_SPACE.search(text))).encode_ordinary(text)

    def encode(text: str) -> list[int]:
        if literals is None or not literals.search(text):
            return ordinary(text)
        ids, at = [], 0
        for m in literals.finditer(text):
            ids += ordinary(text[at:m.start()])
            ids.append(added[m.group()])
            at = m.end()
        return ids + ordinary(text[at:])

    return encode


def piece_lengths(n: int, max_length: int) -> list[int]:
    """Power-of-two lengths that sum to n, longest first."""
    out = [max_length] * (n // max_length)
    rest = n % max_length
    return out + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_length: int = 2048,
                   ranks_path: str | None = None) -> DataFrame:
    """One row per piece: id, start, length, tokens (little-endian uint32 bytes), doc_tokens, sequence_id, offset.

    ``ranks_path`` is a rank file present on every executor (default: the
    public 50k byte-level vocabulary). ``length`` is the bucket.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    fields = [("start", pa.int64()), ("length", pa.int64()), ("tokens", pa.binary()), ("doc_tokens", pa.int64())]

    @F.arrow_udf("array<struct<start:bigint,length:bigint,tokens:binary,doc_tokens:bigint>>")
    def pieces(texts: pa.Array) -> pa.Array:
        encode, offsets, columns = encoder(path), [0], ([], [], [], [])
        for t in texts:
            ids = np.array(encode(t.as_py() or "") + [END_ID], np.uint32)
            cut = piece_lengths(len(ids), max_length)
            ends = np.cumsum(cut).tolist()
            raw = ids.tobytes()
            columns[0].extend(e - n for e, n in zip(ends, cut))
            columns[1].extend(cut)
            columns[2].extend(raw[4 * (e - n):4 * e] for e, n in zip(ends, cut))
            columns[3].extend([len(ids)] * len(cut))
            offsets.append(offsets[-1] + len(cut))
        flat = pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [f for f, _ in fields])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)

    # inlined at once: a filter that Spark infers from a named generator input would run the function again
    return (docs.select(id_col, F.inline(pieces(F.col(text_col))))
            .withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("bigint")))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write the sequences as Parquet, one folder for each length."""
    pieces.withColumn("bucket", F.col("length")).write.mode("overwrite").partitionBy("bucket").parquet(path)
