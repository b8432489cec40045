"""Toxic spans by a linear-chain conditional random field: words are tagged outside, begin or
inside from labelled tokens, forward-backward marginals give every word a probability, and
the marginals add up to a document score and to the offsets of the offending spans.

Labels name documents, not words. A word of a toxic document is labelled toxic if it, or its
beginning, is tied to toxic documents beyond chance; every word of a clean document is labelled
outside. A second fit takes the labels that the first one finds in toxic documents, and the
windows of clean documents in which it was wrong.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import sized, slices, written
from zoneflow.llm.language_id import posteriors

TOXIC_ROWS = 2000       # labelled documents to learn from, at most, of either class
CLEAN_ROWS = 4000
SEED_UNITS = 20_000     # units tied to toxic documents, at most (the strongest)
EVIDENCE = 12.0         # nats by which a unit's share of toxic documents must beat chance
SHARE = 0.4             # toxic share of a unit's documents, at least
PREFIXES = range(4, 9)  # units are whole words (marked by a blank) and beginnings of so many letters
WINDOW = 24             # words of a training window
WINDOWS = 8             # training windows of a document, chosen by hash over its whole text
BITS = 18               # hashed feature space
STEPS = 40
THRESHOLD = 0.3
OUTSIDE, BEGIN, INSIDE = 0, 1, 2
NEVER = -30.0           # score of the move outside -> inside, and of a chain that begins inside
WORD = re.compile(r"[^\W\d_]+")
PRIME = np.uint64(1099511628211)
MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray      # (2^BITS, 3)
    transitions: np.ndarray  # (3, 3)
    scale: tuple             # document score: intercept, then one weight for each evidence


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters."""
    return [w.lower() for w in WORD.findall(text)] if text else []


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, feature) pairs: the whole word, prefixes of 2 to 8 and suffixes of 2 to 5
    characters, and character 3- and 4-grams, hashed to BITS bits."""
    c = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    first = np.flatnonzero(c == 2) + 1
    last = np.flatnonzero(c == 3) - 1
    size = last - first + 1
    word = np.cumsum(c == 2) - 1
    at, found = [], []

    def add(which: np.ndarray, h: np.ndarray, kind: int) -> None:
        h = (h + np.uint64(kind)) * MIX
        at.append(which.astype(np.int32))
        found.append(((h ^ (h >> np.uint64(31))) * MIX >> np.uint64(64 - BITS)).astype(np.int32))
    with np.errstate(over="ignore"):
        every = np.arange(len(words))
        for kind, edge, step, most in ((1, first, 1, 8), (2, last, -1, 5)):
            h = np.full(len(words), 7, np.uint64)
            for n in range(1, most + 1):
                live = size >= n
                h[live] = (h[live] ^ c[edge[live] + step * (n - 1)]) * PRIME
                if n > 1:
                    add(every[live], h[live], 16 * kind + n)
        h = c + np.uint64(1)
        for n in (2, 3, 4):
            h = h[:len(c) - n + 1] * PRIME + c[n - 1:]
            if n > 2:
                inside = word[:len(h)] == word[n - 1:]
                add(word[:len(h)][inside], h[inside], 64 + n)
        place = (np.arange(len(c)) - first[word] if len(c) else np.zeros(0)).astype(np.int64).astype(np.uint64)
        mixed = (c + np.uint64(7)) * MIX ^ (place * np.uint64(0xC2B2AE3D27D4EB4F))
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        if len(c):
            add(every, np.add.reduceat(mixed, first - 1), 3)
    return (np.concatenate(at), np.concatenate(found)) if at else (np.zeros(0, np.int32),) * 2


def emissions(weights: np.ndarray, words: list[str]) -> np.ndarray:
    """Scores (words x tags) of distinct words."""
    word, feature = word_features(words)
    return np.stack([np.bincount(word, weights=weights[feature, k], minlength=len(words)) for k in range(3)], axis=1)


def marginals(model: Model, texts: list[list[str]]) -> list[np.ndarray]:
    """For each word of each text the probability that it is part of a toxic span."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    if not lengths.sum():
        return [np.zeros(0) for _ in texts]
    codes, distinct = pd.factorize(np.array([w for t in texts for w in t], dtype=object))
    scores = emissions(model.weights, list(distinct))[codes]
    scores[np.cumsum(lengths)[lengths > 0] - lengths[lengths > 0], INSIDE] += NEVER
    p = posteriors(scores, lengths[lengths > 0], model.transitions)
    return np.split(1 - p[:, OUTSIDE], np.cumsum(lengths)[:-1])


def evidence(p: np.ndarray) -> tuple[float, float, float]:
    """What a document score is made of: the surest word, the expected number of toxic words
    and their share; words that are most likely clean do not add up."""
    sure = p[p >= 0.1]
    total = float(sure.sum())
    return float(p.max(initial=0.0)), float(np.log1p(total)), total / (len(p) + 20.0) ** 0.5


def document_score(model: Model, p: np.ndarray) -> float:
    z = model.scale[0] + float(np.dot(model.scale[1:], evidence(p)))
    return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def spans(text: str, p: np.ndarray, at_least: float = 0.5) -> list[tuple[int, int, float]]:
    """(start, end, surest probability) in code points of each run of toxic words."""
    out: list[tuple[int, int, float]] = []
    if not (p >= at_least).any():
        return out
    before = False
    for m, q in zip(WORD.finditer(text), p):
        if q >= at_least:
            out[-1:] = [(out[-1][0], m.end(), max(out[-1][2], float(q)))] if before else [*out[-1:], (m.start(), m.end(), float(q))]
        before = q >= at_least
    return out


def tags_of(toxic: np.ndarray) -> np.ndarray:
    """Tags of a window from the toxic marks of its words."""
    before = np.concatenate([[False], toxic[:-1]])
    return np.where(toxic, np.where(before, INSIDE, BEGIN), OUTSIDE)


def fit_tagger(windows: list[tuple[list[str], np.ndarray]], steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions by full-batch Adam on the chain likelihood of tagged windows."""
    w, a = np.zeros((1 << BITS, 3)), np.zeros((3, 3))
    a[OUTSIDE, INSIDE] = NEVER
    windows = [x for x in windows if x[0]]
    if not windows:
        w[:, OUTSIDE] = 1.0
        return w, a
    length = np.array([len(ws) for ws, _ in windows])
    most = int(length.max())
    codes, distinct = pd.factorize(np.array([x for ws, _ in windows for x in ws], dtype=object))
    word, feature = word_features(list(distinct))
    label = np.concatenate([t for _, t in windows])
    seq = np.repeat(np.arange(len(windows)), length)
    pos = np.arange(len(codes)) - np.repeat(np.cumsum(length) - length, length)
    real = np.zeros((len(windows), most), dtype=bool)
    real[seq, pos] = True
    gold = np.zeros((len(windows), most), dtype=np.int64)
    gold[seq, pos] = label
    both = real[:, 1:]
    wanted = np.zeros((3, 3))
    np.add.at(wanted, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    free = np.ones((3, 3))
    free[OUTSIDE, INSIDE] = 0
    state = [[np.zeros_like(v), np.zeros_like(v)] for v in (w, a)]
    total = float(len(codes))
    for step in range(1, steps + 1):
        s = np.stack([np.bincount(word, weights=w[feature, k], minlength=len(distinct)) for k in range(3)], axis=1)[codes]
        s[pos == 0, INSIDE] += NEVER
        e = np.ones((len(windows), most, 3))
        e[seq, pos] = np.exp(s - s.max(axis=1, keepdims=True)) + 1e-12
        m = np.exp(a)
        ahead, back = np.empty_like(e), np.ones_like(e)
        ahead[:, 0] = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, most):
            u = np.where(real[:, t, None], (ahead[:, t - 1] @ m) * e[:, t], ahead[:, t - 1])
            ahead[:, t] = u / u.sum(axis=1, keepdims=True)
        expected = np.zeros((3, 3))
        for t in range(most - 2, -1, -1):
            on = real[:, t + 1]
            nxt = e[:, t + 1] * back[:, t + 1]
            v = np.where(on[:, None], nxt @ m.T, back[:, t + 1])
            back[:, t] = v / v.sum(axis=1, keepdims=True)
            x = ahead[on, t][:, :, None] * m[None] * nxt[on][:, None, :]
            expected += (x / x.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        p = (ahead * back)[seq, pos]
        error = -p / p.sum(axis=1, keepdims=True)
        error[np.arange(len(label)), label] += 1
        per_word = np.stack([np.bincount(codes, weights=error[:, k], minlength=len(distinct)) for k in range(3)], axis=1)
        grown = np.stack([np.bincount(feature, weights=per_word[word, k], minlength=1 << BITS) for k in range(3)], axis=1)
        for v, g, (m1, m2) in zip((w, a), (grown / total - 1e-6 * w, (wanted - expected) * free / total), state):
            m1 *= 0.9
            m1 += 0.1 * g
            m2 *= 0.99
            m2 += 0.01 * g ** 2
            v += 0.1 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
    return w, a


def fit_scale(rows: np.ndarray, toxic: np.ndarray) -> tuple:
    """Intercept and weights of the document score: ridge logistic regression by Newton steps."""
    if not len(toxic) or toxic.min() == toxic.max():
        return (-2.0 if not len(toxic) or not toxic.max() else 2.0, 4.0, 1.0, 1.0)
    x = np.column_stack([np.ones(len(rows)), rows])
    ridge = np.array([1e-6, 0.1, 0.1, 0.1])
    b = np.zeros(4)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), x.T @ (toxic - p) - ridge * b)
        b = b + step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in b)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, toxic_rows: int, clean_rows: int) -> DataFrame:
    """``toxic, text``: the first documents of either class by a hash of the id, among those
    not held out that have a label and a text (an id counts once, with its largest label and
    smallest text)."""
    known = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ready = docs.where("text is not null").where(~is_held_out(F.col("doc_id"))).select("doc_id").distinct().join(known, "doc_id")
    ready = written(ready.select("doc_id", (F.col("toxic") > 0).alias("toxic"), F.xxhash64("doc_id").alias("_h")), "toxicity-labelled")
    parts = [ready.where(F.col("toxic") == F.lit(y)).orderBy("_h", "doc_id").limit(n) for y, n in ((True, toxic_rows), (False, clean_rows))]
    ids = sized(written(parts[0].unionByName(parts[1]).select("doc_id", "toxic"), "toxicity-chosen"))
    rows = docs.select("doc_id", "text").where("text is not null").join(ids, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return written(rows.select("toxic", "text", F.xxhash64("doc_id").alias("_h")).repartition(16, "_h"), "toxicity-sample")


def units(word: str) -> list[str]:
    """What evidence is counted for: the whole word and its beginnings."""
    return [word + " ", *(word[:n] for n in PREFIXES if n < len(word))]


def _distinct_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            ws, ys = [], []
            for y, t in zip(part.column("toxic").to_pylist(), part.column("text").to_pylist()):
                found = {u for w in set(words_of(t)) for u in units(w)}
                ws += found
                ys += [y] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(ws, pa.string()), pa.array(ys, pa.bool_())], names=["word", "toxic"])


def seed_units(rows: DataFrame) -> set[str]:
    """Units whose share of toxic documents is SHARE or more and beats the sample's by EVIDENCE
    nats (number of the unit's documents times the divergence of both shares)."""
    counts = rows.groupBy("toxic").count().collect()
    n1, n0 = (sum(r["count"] for r in counts if r["toxic"] == y) for y in (True, False))
    if not n1 or not n0:
        return set()
    base = n1 / (n1 + n0)
    per = rows.select("toxic", "text").mapInArrow(_distinct_units, "word string, toxic boolean").groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("toxic").cast("long")).alias("k"))
    share = F.col("k") / F.col("n")
    clean = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(F.lit(0.0))
    nats = F.col("n") * (share * F.log(share / base) + clean)
    strong = per.where("k >= 2").where((share > base) & (share >= SHARE)).withColumn("nats", nats).where(F.col("nats") >= EVIDENCE)
    return {r["word"] for r in strong.orderBy(F.desc("nats"), "word").limit(SEED_UNITS).collect()}


def _windows(mark, hard: bool):
    """Training windows of the sample's texts (``words``, toxic ``marks``). ``mark`` gives the
    toxic marks of a text's words. Windows with marks come first, the others by hash; ``hard``
    takes marked windows of clean texts, with all words labelled clean."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                out, marks = [], []
                texts = [words_of(t) for t in part.column("text").to_pylist()]
                for ws, on, y, h in zip(texts, mark(texts), part.column("toxic").to_pylist(), part.column("_h").to_pylist()):
                    starts = np.arange(0, len(ws), WINDOW)
                    if not len(starts):
                        continue
                    hit = np.add.reduceat(on, starts) > 0
                    with np.errstate(over="ignore"):
                        order = (starts.astype(np.uint64) + np.uint64(h & (1 << 62) - 1)) * MIX
                    chosen = np.lexsort((order, ~hit))
                    chosen = chosen[hit[chosen]][:WINDOWS] if hard else np.concatenate([chosen[hit[chosen]][:WINDOWS], chosen[~hit[chosen]][:WINDOWS // 4]])
                    for i in chosen:
                        s = slice(int(starts[i]), int(starts[i]) + WINDOW)
                        out.append(ws[s])
                        marks.append((on[s] & y).tolist())
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.string())), pa.array(marks, pa.list_(pa.bool_()))], names=["words", "marks"])
    return run


def _evidence_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [evidence(p) for p in marginals(shared.value, [words_of(t) for t in part.column("text").to_pylist()])]
                yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array([list(r) for r in rows], pa.list_(pa.float64()))], names=["toxic", "evidence"])
    return run


def fit(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Model:
    """Fits the tagger and the document score on at most ``toxic_rows`` and ``clean_rows``
    labelled documents that are not held out. Word statistics, marks and evidence are taken
    from their whole texts on Spark; the driver gets at most 2 * WINDOWS windows of each.
    Without toxic or without clean documents nothing is marked."""
    spark = docs.sparkSession
    rows = sample(docs, labels, toxic_rows, clean_rows)
    seeds = spark.sparkContext.broadcast(seed_units(rows))

    def collected(mark, hard=False, only=None):
        src = rows if only is None else rows.where(only)
        got = src.mapInArrow(_windows(mark, hard), "words array<string>, marks array<boolean>").collect()
        return sorted((r["words"], r["marks"]) for r in got)

    def tagged(windows):
        return [(ws, tags_of(np.array(m, dtype=bool))) for ws, m in windows]

    def seeded(texts):
        known = seeds.value
        return [np.fromiter((any(u in known for u in units(w)) for w in ws), bool, len(ws)) for ws in texts]
    clean = collected(seeded, only="not toxic")
    w, a = fit_tagger(tagged(collected(seeded, only="toxic") + clean))
    first = spark.sparkContext.broadcast(Model(w, a, ()))

    def found(texts):
        return [p >= 0.5 for p in marginals(first.value, texts)]

    def doubtful(texts):
        return [p >= 0.1 for p in marginals(first.value, texts)]
    toxic = collected(found, only="toxic")
    w, a = fit_tagger(tagged(toxic + clean + collected(doubtful, hard=True, only="not toxic")))
    shared = spark.sparkContext.broadcast(Model(w, a, ()))
    got = sorted((r["evidence"], r["toxic"]) for r in rows.mapInArrow(_evidence_rows(shared), "toxic boolean, evidence array<double>").collect())
    scale = fit_scale(np.array([g[0] for g in got], dtype=float).reshape(-1, 3), np.array([g[1] for g in got], dtype=float))
    return Model(w, a, scale)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted, spans`` of every row of ``docs`` (``doc_id, text``).

    Every word of the whole text gets a marginal; ``spans`` lists start, end (code points) and
    probability of each run of words with 0.5 or more. Null texts and texts without letters
    have no evidence and the lowest score. A null id is not held out; repeated rows get equal
    scores; other columns, whatever their names, are ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").to_pylist()
                p = marginals(m, [words_of(t) for t in texts])
                s = [document_score(m, x) for x in p]
                places = [[dict(zip(("start", "end", "p"), z)) for z in spans(t or "", x)] for t, x in zip(texts, p)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(s, pa.float64()), pa.array([int(v >= threshold) for v in s], pa.int32()), pa.array(places, kind)],
                    names=["doc_id", "held_out", "score", "predicted", "spans"])
    rows = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, score double, predicted int, spans array<struct<start:int,end:int,p:double>>")
