"""Language identification with a linear-chain conditional random field: affix, character
n-gram and lexicon features with learned transitions label the words of code-switched text
by forward-backward; a document gets the language with the largest mean word posterior."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.llm.common import slices

DOCS_PER_LANGUAGE = 600   # training documents of a language, at most
SEGMENTS = 24             # training segments of a document, spread over its whole text
LANGUAGES = 64            # languages learned, at most
FIT_CELLS = 16_000        # training documents times languages, at most: the driver's arrays grow with it
BITS = 15                 # hashed feature space
SEGMENT = 12              # words of one document in a training sequence
STEPS = 60
SEED = 11
BLOCK = 64                # words handled step by step before blocks are linked
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Model:
    languages: tuple
    weights: np.ndarray      # (2^BITS, languages): affixes and n-grams
    lexicon: np.ndarray      # sorted hashes of known words
    lexicon_weights: np.ndarray  # (words + 1, languages); the last row is for unknown words
    transitions: np.ndarray  # (languages, languages)


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters."""
    return [w for w in WORD.findall(text.lower()) if any(map(str.isalpha, w))] if text else []


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, feature) pairs of distinct words, and a hash of each whole word. Features are
    hashed character n-grams (2 to 4) of the word between boundary marks; those with a mark
    are its affixes of 1 to 3 characters."""
    text = "".join(f"\x02{w}\x03" for w in words)
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    word = np.cumsum(c == 2) - 1
    at, found = [], []
    with np.errstate(over="ignore"):
        h = c + np.uint64(1)
        for n in (2, 3, 4):
            h = h[:len(c) - n + 1] * np.uint64(1099511628211) + c[n - 1:] + np.uint64(n)
            inside = word[:len(c) - n + 1] == word[n - 1:]
            at.append(word[:len(c) - n + 1][inside])
            found.append(((h[inside] * MIX) >> np.uint64(64 - BITS)).astype(np.int64))
        place = np.arange(len(c)) - np.searchsorted(word, word)
        power = (c + np.uint64(7)) * MIX ^ (place.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        power = (power ^ (power >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        whole = np.add.reduceat(power, np.flatnonzero(c == 2)) if len(c) else power
    return np.concatenate(at), np.concatenate(found), whole


def _word_scores(m: Model, words: list[str]) -> np.ndarray:
    word, feature, whole = features(words)
    out = np.stack([np.bincount(word, weights=m.weights[feature, k], minlength=len(words)) for k in range(len(m.languages))], axis=1)
    return out + m.lexicon_weights[_lookup(m.lexicon, whole)]


def _lookup(lexicon: np.ndarray, whole: np.ndarray) -> np.ndarray:
    if not len(lexicon):
        return np.zeros(len(whole), dtype=np.int64)
    i = np.minimum(np.searchsorted(lexicon, whole), len(lexicon) - 1)
    return np.where(lexicon[i] == whole, i, len(lexicon))


def posteriors(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Word posteriors of chains laid end to end (``lengths`` > 0) by forward-backward.

    Chains are cut into blocks of BLOCK words. A first pass multiplies each block's matrix, a
    second carries the states over the blocks of each chain, a third runs inside all blocks
    at once, so that work is vectorised however long a single text is.
    """
    n, k = scores.shape
    a = np.exp(transitions - transitions.max())
    blocks = -(-lengths // BLOCK)
    first = np.concatenate([[0], np.cumsum(blocks)])
    start = np.concatenate([[0], np.cumsum(lengths)])
    chain = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(n) - start[chain]
    row, col = first[chain] + inside // BLOCK, inside % BLOCK
    e = np.ones((int(first[-1]), BLOCK, k))
    e[row, col] = np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-12
    moves = np.zeros((len(e), BLOCK), dtype=bool)  # is there a next word?
    moves[row, col] = inside < lengths[chain] - 1
    prod = np.broadcast_to(np.eye(k), (len(e), k, k)).copy()
    for s in range(BLOCK):
        prod = prod * e[:, s, None, :]
        prod = np.where(moves[:, s, None, None], prod @ a, prod)
        prod /= prod.sum(axis=(1, 2), keepdims=True)
    ahead, back = np.ones((len(e), k)), np.ones((len(e), k))  # states before and after each block
    order = np.argsort(-blocks, kind="stable")
    many = blocks[order]
    for s in range(1, int(many[0]) if len(many) else 0):
        live = order[:np.searchsorted(-many, -s, side="left")]  # chains with more than s blocks
        b = first[live] + s
        u = np.einsum("bi,bij->bj", ahead[b - 1], prod[b - 1])
        ahead[b] = u / u.sum(axis=1, keepdims=True)
        b = first[live] + blocks[live] - 1 - s
        v = np.einsum("bij,bj->bi", prod[b + 1], back[b + 1])
        back[b] = v / v.sum(axis=1, keepdims=True)
    out = np.empty_like(e)
    u = ahead
    for s in range(BLOCK):
        out[:, s] = u * e[:, s]
        u = np.where(moves[:, s, None], out[:, s] @ a, out[:, s])
        u = u / u.sum(axis=1, keepdims=True)
    v = back
    for s in range(BLOCK - 1, -1, -1):
        v = np.where(moves[:, s, None], v @ a.T, v)
        out[:, s] *= v
        v = v * e[:, s]
        v = v / v.sum(axis=1, keepdims=True)
    p = out[row, col]
    return p / p.sum(axis=1, keepdims=True)


def label_words(m: Model, texts: list[list[str]]) -> list[np.ndarray]:
    """Posteriors (words x languages) of each text's words."""
    lengths = np.array([len(t) for t in texts])
    if not lengths.sum():
        return [np.zeros((0, len(m.languages))) for _ in texts]
    codes, distinct = pd.factorize(np.array([w for t in texts for w in t], dtype=object))
    p = posteriors(_word_scores(m, list(distinct))[codes], lengths[lengths > 0], m.transitions)
    return np.split(p, np.cumsum(lengths)[:-1])


def fit_crf(texts: list[tuple[list[str], str]], seed: int = SEED) -> Model:
    """Fits to (words, language) pairs by full-batch Adam on the chain likelihood. Training
    sequences join segments of one to three documents, so that the transitions are learned
    on code-switched text; a word's label is the language of its document."""
    languages = tuple(sorted({t[1] for t in texts}))
    number = {x: i for i, x in enumerate(languages)}
    k = len(languages)
    rng = np.random.default_rng(seed)
    pieces = [(ws[i:i + SEGMENT], number[lang]) for ws, lang in texts for i in range(0, len(ws), SEGMENT) if ws[i:i + SEGMENT]]
    if k < 2 or not pieces:
        return Model(languages, np.zeros((1 << BITS, k)), np.zeros(0, np.uint64), np.zeros((1, k)), np.zeros((k, k)))
    order, groups, i = rng.permutation(len(pieces)), [], 0
    while i < len(order):
        n = int(rng.integers(1, 4))
        groups.append([pieces[j] for j in order[i:i + n]])
        i += n
    t_max = 3 * SEGMENT
    tokens = [w for g in groups for ws, _ in g for w in ws]
    codes, distinct = pd.factorize(np.array(tokens, dtype=object))
    label = np.concatenate([np.full(len(ws), y) for g in groups for ws, y in g])
    length = np.array([sum(len(ws) for ws, _ in g) for g in groups])
    seq = np.repeat(np.arange(len(groups)), length)
    pos = np.arange(len(codes)) - np.repeat(np.cumsum(length) - length, length)
    word, feature, whole = features(list(distinct))
    counts = np.zeros((len(distinct), k))
    np.add.at(counts, (codes, label), 1)
    known = (counts.sum(axis=1) >= 3) & (counts.max(axis=1) >= 0.7 * counts.sum(axis=1))
    lexicon, index = np.unique(whole[known], return_index=True)
    prior = np.vstack([np.log((counts[known] + 0.5) / (counts[known] + 0.5).sum(axis=1, keepdims=True))[index], np.zeros((1, k))]) + np.log(k)
    prior[-1] = 0
    entry = _lookup(lexicon, whole)
    lex = prior[entry]
    w, a, scale = np.zeros((1 << BITS, k)), np.zeros((k, k)), np.ones(1)
    real = np.zeros((len(groups), t_max), dtype=bool)
    real[seq, pos] = True
    gold = np.zeros((len(groups), t_max), dtype=np.int64)
    gold[seq, pos] = label
    both = real[:, 1:]
    wanted = np.zeros((k, k))
    np.add.at(wanted, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    state = [[np.zeros_like(v), np.zeros_like(v)] for v in (w, a, scale)]
    for step in range(1, STEPS + 1):
        s = np.stack([np.bincount(word, weights=w[feature, j], minlength=len(distinct)) for j in range(k)], axis=1) + scale * lex
        e = np.ones((len(groups), t_max, k))
        e[seq, pos] = np.exp(s[codes] - s[codes].max(axis=1, keepdims=True)) + 1e-12
        m = np.exp(a - a.max())
        fwd, bwd = np.empty_like(e), np.ones_like(e)
        fwd[:, 0] = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, t_max):
            u = np.where(real[:, t, None], (fwd[:, t - 1] @ m) * e[:, t], fwd[:, t - 1])
            fwd[:, t] = u / u.sum(axis=1, keepdims=True)
        expected = np.zeros((k, k))
        for t in range(t_max - 2, -1, -1):
            next_ = e[:, t + 1] * bwd[:, t + 1]
            v = np.where(real[:, t + 1, None], next_ @ m.T, bwd[:, t + 1])
            bwd[:, t] = v / v.sum(axis=1, keepdims=True)
            on = real[:, t + 1]
            if on.any():
                x = fwd[on, t][:, :, None] * m[None] * next_[on][:, None, :]
                expected += (x / x.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        p = fwd * bwd
        p = (p / p.sum(axis=2, keepdims=True))[seq, pos]
        error = -p
        error[np.arange(len(label)), label] += 1
        per_word = np.stack([np.bincount(codes, weights=error[:, j], minlength=len(distinct)) for j in range(k)], axis=1)
        g = (np.stack([np.bincount(feature, weights=per_word[word, j], minlength=1 << BITS) for j in range(k)], axis=1) / len(codes) - 1e-5 * w,
             (wanted - expected) / len(codes), np.array([(per_word * lex).sum() / len(codes)]))
        for v, grad, (m1, m2) in zip((w, a, scale), g, state):
            m1 *= 0.9
            m1 += 0.1 * grad
            m2 *= 0.99
            m2 += 0.01 * grad ** 2
            v += 0.1 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-7)
    return Model(languages, w, lexicon, scale * prior, a)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def _pick_segments(segments: int):
    """Replaces each text by at most ``segments`` of its segments of SEGMENT words. A
    multiplicative hash of the place, started at the row's own hash, spreads them evenly over
    the whole text; they stay in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                picked = []
                for start, text in zip(part.column("_h").to_pylist(), part.column("text").to_pylist()):
                    words = words_of(text)
                    places = np.arange(-(-len(words) // SEGMENT))
                    if len(places) > segments:
                        with np.errstate(over="ignore"):
                            key = places.astype(np.uint64) * MIX + np.int64(start).astype(np.uint64)
                        places = np.sort(np.argsort(key, kind="stable")[:segments])
                    picked.append(" ".join(w for i in places for w in words[i * SEGMENT:(i + 1) * SEGMENT]))
                yield part.set_column(part.schema.get_field_index("text"), "text", pa.array(picked, pa.string()))
    return run


def training_texts(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, segments: int = SEGMENTS,
                   languages: int = LANGUAGES, cells: int = FIT_CELLS) -> list[tuple[list[str], str]]:
    """(words, language) of the training documents: of each language the first
    ``docs_per_language`` usable ones by a hash of id and language (usable: not held out, with a
    language and a letter), each by segments from all over its text.

    The share of the hash range that goes on to be ranked follows from the usable documents of
    a language. Bounds: the ``languages`` with the most usable documents (ties to the smaller
    name) are learned, with at most ``cells // k`` documents for k languages together.
    """
    usable = docs.where("lang is not null and text is not null").where(~is_held_out(F.col("doc_id"))).where(F.rlike(F.col("text"), F.lit(r"\p{L}")))
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()
    if not counts:
        return []
    each = max(1, min(docs_per_language, cells // len(counts) ** 2))
    share = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, 4.0 * each / r["n"])) for r in counts], "lang string, _share double")
    rows = usable.select("doc_id", "lang", "text", F.xxhash64("doc_id", "lang").alias("_h")).withColumn("_key", F.pmod("_h", F.lit(1 << 30)))
    rows = rows.join(F.broadcast(share), "lang").where(F.col("_key") < F.col("_share") * (1 << 30)).select("doc_id", "lang", "_h", "_key", "text")
    rows = rows.mapInArrow(_pick_segments(segments), rows.schema)
    first = Window.partitionBy("lang").orderBy("_key", "_h", "doc_id", "text")
    rows = rows.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= each).select("lang", "_n", "text").collect()
    return [(r["text"].split(), r["lang"]) for r in sorted(rows, key=lambda r: (r["lang"], r["_n"]))]


def fit(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, segments: int = SEGMENTS) -> Model:
    """Fits on the sample of ``training_texts``. Columns ``doc_id, text, lang`` are read; null
    languages, null texts and texts without letters teach nothing, repeated rows count each;
    without usable rows the model knows no language."""
    return fit_crf(training_texts(docs, docs_per_language, segments))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``docs`` (columns ``doc_id, text``).

    The whole text is labelled word by word; the prediction is the language with the largest
    mean posterior (ties to the smaller name), the score that mean. Null texts and texts
    without letters get ``und`` with score 0; with no language to learn from every text does.
    Null ids are not held out; repeated rows get equal predictions; other columns are
    ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                pred, score = [], []
                for p in label_words(m, [words_of(t) for t in part.column("text").to_pylist()]) if m.languages else [np.zeros((0, 0))] * part.num_rows:
                    mean = p.mean(axis=0) if len(p) else None
                    pred.append(UNKNOWN if mean is None else m.languages[int(mean.argmax())])
                    score.append(0.0 if mean is None else min(1.0, float(mean.max())))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                                 names=["doc_id", "held_out", "lang_pred", "score"])
    rows = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double")
