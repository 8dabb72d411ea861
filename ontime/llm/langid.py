"""Language identification by a linear-chain conditional random field over words.

Words are runs of letters. A word's emission adds the weights of its affixes
(first and last two and three bytes), its byte trigrams with word borders and
its lexicon entry (the whole word), all hashed into weight tables. Transition
weights between the languages of neighbouring words are learned with them.
Forward-backward gives every word its probability of each language, so a text
that switches languages is labelled word by word; the document's language is
the one with the largest mean probability, and that mean is its score.

Training. Learnable are documents with a letter whose crc32(id as text) mod 3
is not 1 and whose language is known. Up to ``max_rows`` of them, a quota for
each language (smallest by a seeded hash of the id), each give spans of ``span``
words at hashed places; spans of different documents follow each other in the
training chains, which is where switches are learned. Half of the rows are
dealt evenly, the rest by the languages' counts in the whole table; each has one
row at least (more than ``max_rows`` only if there are more languages). So the
languages are all learnable values. Their counts come to the driver.
Prediction reads whole texts.

Defined cases. NULL text or text without a letter is ``und`` with score 0;
so is every text if nothing can be learned. Ties go to the first language in
alphabetical order. Repeated rows are predicted alike; empty tables give empty
results.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.llm.common import learnable, row_with, with_row

UND = "und"
_WORD = re.compile(r"[^\W\d_]+")
_P, _P_INV = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
TABLE_BITS = {"trigram": 15, "lexicon": 17, "prefix2": 12, "prefix3": 14, "suffix2": 12, "suffix3": 14}
_STEP = 1 << 21  # bytes of words handled at a time


def letters(text: str | None) -> list[str]:
    """Lower-case runs of letters; none if the text holds no letter."""
    words = _WORD.findall((text or "").lower())
    return words if any(c.isalpha() for w in words for c in w) else []


def _top(h: np.ndarray, bits: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class WordFeatures:
    """Hashed feature places of a list of words; trigrams lie flat with one owner per word run."""
    single: dict[str, np.ndarray]
    trigram: np.ndarray
    first: np.ndarray  # start of each word's trigrams


def word_features(words: list[str]) -> WordFeatures:
    raw = [w.encode("utf-8", "replace") for w in words]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
    start = np.cumsum(size + 1) - size  # after the leading space
    end = start + size
    power = np.full(len(data) + 1, _P, np.uint64)
    back = np.full(len(data) + 1, _P_INV, np.uint64)
    power[0] = back[0] = 1
    power, back = np.multiply.accumulate(power), np.multiply.accumulate(back)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], out=sums[1:])
    run = lambda a, b: (sums[b] - sums[a]) * back[a]
    single = {"lexicon": run(start, end)}
    for k in (2, 3):
        single[f"prefix{k}"] = run(start, np.minimum(start + k, end))
        single[f"suffix{k}"] = run(np.maximum(end - k, start), end)
    single = {name: _top(h, TABLE_BITS[name]) for name, h in single.items()}
    # trigrams from the border before a word to the border after it: one for each of its bytes
    d = data.astype(np.uint32)
    grams = (d[:-2] << np.uint32(16)) | (d[1:-1] << np.uint32(8)) | d[2:]
    inside = np.ones(len(grams), bool)
    inside[end[:-1] - 1] = False  # centred on the space between two words
    hashed = (grams[inside] * np.uint32(0x9E3779B1)) >> np.uint32(32 - TABLE_BITS["trigram"])
    return WordFeatures(single, hashed, np.cumsum(size) - size)


@dataclass
class LanguageModel:
    languages: list[str]
    tables: dict[str, np.ndarray]
    transition: np.ndarray
    initial: np.ndarray

    def emissions(self, f: WordFeatures) -> np.ndarray:
        out = np.add.reduceat(self.tables["trigram"][f.trigram], f.first, axis=0)
        for name, place in f.single.items():
            out += self.tables[name][place]
        return out

    def word_probabilities(self, docs: list[list[str]]) -> np.ndarray:
        """Probabilities of all words (in order) of documents with at least one word each."""
        known: dict[str, int] = {}
        at = np.array([known.setdefault(w, len(known)) for d in docs for w in d])
        words, parts, lo, size = list(known), [], 0, 0
        for i, w in enumerate(words):
            size += len(w)
            if size > _STEP or i + 1 == len(words):
                parts.append(self.emissions(word_features(words[lo:i + 1])))
                lo, size = i + 1, 0
        return forward_backward(np.concatenate(parts)[at], np.fromiter(map(len, docs), np.int64, len(docs)),
                                self.transition, self.initial)


def forward_backward(emission: np.ndarray, lengths: np.ndarray, transition: np.ndarray, initial: np.ndarray) -> np.ndarray:
    """Label probabilities of every word; chains (one word at least) lie one after another.

    All chains advance together, longest first, so that the words of one step are a slice.
    """
    order = np.argsort(-lengths, kind="stable")
    rank = np.empty(len(lengths), np.int64)
    rank[order] = np.arange(len(lengths))
    active = np.searchsorted(-lengths[order], -np.arange(int(lengths.max())), "left")  # chains longer than t
    offset = np.concatenate([[0], np.cumsum(active)])
    step = np.arange(len(emission)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    place = offset[step] + np.repeat(rank, lengths)
    emit = np.empty(emission.shape)
    emit[place] = np.exp(np.maximum(emission - emission.max(axis=1, keepdims=True), -30))
    move = np.exp(transition - transition.max())
    alpha, beta = np.empty_like(emit), np.ones_like(emit)
    at = offset.tolist()
    a = alpha[:at[1]]
    a[:] = emit[:at[1]] * np.exp(initial - initial.max())
    for t in range(1, len(active)):
        now = alpha[at[t]:at[t + 1]]
        np.matmul(a[:len(now)], move, out=now)
        now *= emit[at[t]:at[t + 1]]
        if t % 8 == 0:  # any scale will do; this keeps it in range
            now /= now.sum(axis=1, keepdims=True)
        a = now
    back = np.ascontiguousarray(move.T)
    for t in range(len(active) - 2, -1, -1):
        now = beta[at[t]:at[t + 1]][:at[t + 2] - at[t + 1]]  # chains that end here keep 1
        np.matmul(beta[at[t + 1]:at[t + 2]] * emit[at[t + 1]:at[t + 2]], back, out=now)
        if t % 8 == 0:
            now /= now.sum(axis=1, keepdims=True)
    alpha *= beta
    alpha /= alpha.sum(axis=1, keepdims=True)
    return alpha[place]


def _pair_counts(emission, gamma, transition):
    """Expected transitions of equal-length chains: emission and gamma (chains, words, labels)."""
    # xi is rebuilt from one more sweep, chain-parallel
    emit = np.exp(emission - emission.max(axis=2, keepdims=True)) + 1e-30
    move = np.exp(transition - transition.max())
    n, length, labels = emission.shape
    alpha = np.empty_like(emit)
    a = None
    for t in range(length):
        a = emit[:, t] * (a @ move if t else 1.0)
        a /= a.sum(axis=1, keepdims=True)
        alpha[:, t] = a
    out = np.zeros((labels, labels))
    b = np.ones((n, labels))
    for t in range(length - 1, 0, -1):
        right = b * emit[:, t]
        xi = alpha[:, t - 1, :, None] * move[None] * right[:, None, :]
        out += (xi / xi.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        b = right @ move.T
        b /= b.sum(axis=1, keepdims=True)
    return out


def fit_crf(spans: list[tuple[str, list[str]]], chain: int = 128, chains_a_step: int = 32, epochs: int = 4,
            rate: float = 0.3, seed: int = 42) -> LanguageModel | None:
    """Fit on (language, words) spans by AdaGrad on the log-likelihood of chains of ``chain`` words."""
    spans = [(lang, words) for lang, words in spans if words]
    if not spans:
        return None
    languages = sorted({lang for lang, _ in spans})
    n_lang = len(languages)
    tables = {name: np.zeros((1 << bits, n_lang), np.float32) for name, bits in TABLE_BITS.items()}
    seen = {name: np.full(t.shape, 1e-6, np.float32) for name, t in tables.items()}
    model = LanguageModel(languages, tables, np.zeros((n_lang, n_lang)), np.zeros(n_lang))
    seen_move = np.full((n_lang, n_lang), 1e-6)
    place = {lang: i for i, lang in enumerate(languages)}
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        stream = [spans[i] for i in rng.permutation(len(spans))]
        words = [w for _, ws in stream for w in ws]
        truth = np.concatenate([np.full(len(ws), place[lang]) for lang, ws in stream])
        step = chain * chains_a_step
        for lo in range(0, len(words), step):
            part = words[lo:lo + step]
            n = len(part)
            width = chain if n >= chain else n
            n -= n % width
            f = word_features(part[:n])
            emission = model.emissions(f)
            gamma = forward_backward(emission, np.full(n // width, width), model.transition, model.initial)
            y = truth[lo:lo + n]
            grad = -gamma
            grad[np.arange(n), y] += 1
            grad /= np.sqrt(n)
            grams = np.diff(np.append(f.first, len(f.trigram)))
            spread = np.repeat(grad, grams, axis=0)
            for name, at, g in [("trigram", f.trigram, spread), *((k, v, grad) for k, v in f.single.items())]:
                total = np.stack([np.bincount(at, g[:, k], len(tables[name])) for k in range(n_lang)], axis=1)
                seen[name] += total ** 2
                tables[name] += (rate * total / np.sqrt(seen[name])).astype(np.float32)
            shaped = y.reshape(-1, width)
            real = np.zeros((n_lang, n_lang))
            np.add.at(real, (shaped[:, :-1].ravel(), shaped[:, 1:].ravel()), 1)
            g = (real - _pair_counts(emission.reshape(-1, width, n_lang).astype(np.float64), gamma, model.transition)) / n
            seen_move += g ** 2
            model.transition += rate * g / np.sqrt(seen_move)
    return model


def quotas(counts: list[int], max_rows: int) -> list[int]:
    """Rows to learn from each language: half dealt evenly, the rest by count, one at least."""
    even = max(1, max_rows // (2 * max(1, len(counts))))
    first = [min(n, even) for n in counts]
    left, rest = max(0, max_rows - sum(first)), sum(counts) - sum(first)
    return [f + min(n - f, left * (n - f) // max(1, rest)) for n, f in zip(counts, first)]


def learn_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    max_rows: int = 4000, span: int = 40, **options) -> LanguageModel | None:
    """Fit on spans of at most ``max_rows`` learnable documents of all languages; spans and counts reach the driver."""
    @F.arrow_udf("array<string>")
    def spans_of(texts: pa.Array, salt: pa.Array) -> pa.Array:
        out = []
        for text, s in zip(texts, salt):
            words, s = letters(text.as_py()), s.as_py()
            starts = {(s >> shift) % max(1, len(words) - span + 1) for shift in (0, 20)}
            out.append([" ".join(words[a:a + span]) for a in sorted(starts)] if words else [])
        return pa.array(out, pa.list_(pa.string()))

    known = (docs.where(learnable(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
             .select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
             .withColumn("h", F.xxhash64(F.lit(42), "id")))
    seen = known.groupBy("lang").agg(F.count("*").alias("n"), F.min("h").alias("least")).orderBy("lang").collect()
    if not seen:
        return None
    quota = quotas([r.n for r in seen], max_rows)
    # a cut at the share of hashes that the quota needs, with a margin, so that few rows are ranked
    share = [min(1.0, (q + 10 * q ** 0.5 + 100) / r.n) for q, r in zip(quota, seen)]
    cut = [max(r.least, min(int(s * 2 ** 64) - 2 ** 63, 2 ** 63 - 1)) for s, r in zip(share, seen)]
    schema = T.StructType([known.schema["lang"], T.StructField("cut", T.LongType()), T.StructField("quota", T.LongType())])
    bounds = docs.sparkSession.createDataFrame([(r.lang, c, q) for r, c, q in zip(seen, cut, quota)], schema)
    salt = F.shiftrightunsigned(F.xxhash64(F.lit(5), "id"), 1)
    near = (known.join(F.broadcast(bounds), "lang").where(F.col("h") <= F.col("cut"))
            .select("id", "lang", "quota", "h", spans_of("text", salt).alias("spans")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id", "spans"))
    sample = near.withColumn("rank", rank).where((F.col("rank") <= max(quota)) & (F.col("rank") <= F.col("quota")))
    rows = sample.select("id", "lang", F.explode("spans").alias("span")).toPandas()
    rows = rows.sort_values(["id", "lang", "span"], kind="stable")
    return fit_crf([(lang, text.split()) for lang, text in zip(rows["lang"], rows["span"])], **options)


def language(model: LanguageModel | None):
    """Column function: text -> struct of lang_pred, score, runs (first word, words, language)."""
    run = pa.list_(pa.struct([("word", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))

    @F.arrow_udf("struct<lang_pred:string,score:double,runs:array<struct<word:int,words:int,lang:string>>>")
    def predict(texts: pa.Array) -> pa.Array:
        words = [letters(t.as_py()) for t in texts] if model else [[]] * len(texts)
        some = [i for i, w in enumerate(words) if w]
        pred, score, runs = [UND] * len(words), [0.0] * len(words), [[] for _ in words]
        if some:
            docs = [words[i] for i in some]
            p = model.word_probabilities(docs)
            size = np.fromiter(map(len, docs), np.int64, len(docs))
            first = np.cumsum(size) - size
            share = np.add.reduceat(p, first, axis=0) / size[:, None]
            best, label = share.argmax(axis=1), p.argmax(axis=1)
            for k, i in enumerate(some):
                pred[i], score[i] = model.languages[best[k]], float(min(1.0, share[k, best[k]]))
                own = label[first[k]:first[k] + size[k]]
                at = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
                runs[i] = [{"word": a, "words": b - a, "lang": model.languages[own[a]]}
                           for a, b in zip(at.tolist(), [*at[1:].tolist(), len(own)])]
        return pa.StructArray.from_arrays([pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(runs, run)],
                                          ["lang_pred", "score", "runs"])
    return predict


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """Every input row with lang_pred, score and runs (the languages of a code-switched text in order)."""
    model = learn_languages(docs, id_col, text_col, lang_col, **options)
    return row_with(with_row(docs, language(model)(F.col(text_col)).alias("_l")), docs.columns, "_l")
