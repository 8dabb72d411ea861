"""Rule statistics of whole texts, shared by the quality operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ontime.llm.common import utf8

SYMBOLS = b"#*$%&|<>"
REPEAT_WIDTH = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_unique",
          "n_upper", "n_digits", "n_stops", "n_commas", "n_other", "n_wide", "longest_word", "n_caps_words")
_P = np.uint64(0x9E3779B97F4A7C15)
_SPACE = list(b" \t\n\x0b\x0c\r")
_CONTINUATION = np.arange(0x80, 0xC0)
_OTHER = [c for c in range(33, 127) if not chr(c).isalnum() and c not in SYMBOLS and c not in b".,"]


def repeat_words(words: list[bytes], width: int = REPEAT_WIDTH) -> int:
    """Words inside ``width``-word windows that stand twice or more in the text."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    window = np.zeros(n, np.uint64)
    for k in range(width):
        window = window * _P + h[k:n + k]
    ordered = np.sort(window)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(window, twice).astype(np.int32)
    edge = np.zeros(len(words) + 1, np.int32)
    edge[:n] += hit
    edge[width:width + n] -= hit
    return int((np.cumsum(edge[:-1]) > 0).sum())


def dup_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those equal to an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines), len(lines) - len(set(lines))


def text_counts(text: bytes | None) -> tuple[int, ...]:
    """The values of COUNTS for one text."""
    text = text or b""
    words = text.split()
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n_lines, n_dup = dup_lines(text)
    wide = int(seen[_CONTINUATION].sum())
    return (len(words), len(text) - wide - int(seen[_SPACE].sum()), int(seen[list(SYMBOLS)].sum()), n_dup,
            repeat_words(words), n_lines, len(set(words)), int(seen[65:91].sum()), int(seen[48:58].sum()),
            int(seen[ord(".")]), int(seen[ord(",")]), int(seen[_OTHER].sum()), wide,
            max(map(len, words), default=0), sum(map(bytes.isupper, words)))


def text_stats(text: Column) -> Column:
    """Struct of COUNTS (BIGINT each) of a text column; NULL counts as empty."""
    @F.arrow_udf("struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">")
    def stats(texts: pa.Array) -> pa.Array:
        rows = np.array([text_counts(t.as_py()) for t in texts], np.int64).reshape(-1, len(COUNTS))
        return pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(COUNTS))], list(COUNTS))
    return stats(utf8(text))


FEATURES = ("log_words", "chars_a_word", "symbols", "dup_lines", "repeated", "words_a_line", "unique", "upper",
            "digits", "stops", "commas", "other", "wide", "log_longest", "caps_words")


def feature_matrix(counts: np.ndarray) -> np.ndarray:
    """(n, len(COUNTS)) counts -> (n, len(FEATURES)) ratios, finite for empty texts."""
    c = {name: counts[:, i].astype(np.float64) for i, name in enumerate(COUNTS)}
    words, chars, lines = (np.maximum(c[k], 1) for k in ("n_words", "word_chars", "n_lines"))
    return np.stack([np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / chars,
                     c["n_dup_lines"] / lines, c["n_repeat_words"] / words, c["n_words"] / lines,
                     c["n_unique"] / words, c["n_upper"] / chars, c["n_digits"] / chars, c["n_stops"] / words,
                     c["n_commas"] / words, c["n_other"] / chars, c["n_wide"] / chars,
                     np.log1p(c["longest_word"]), c["n_caps_words"] / words], axis=1)
