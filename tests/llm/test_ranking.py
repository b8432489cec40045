"""Toxicity, whitening and lexical search on small tables: brute force, round trips, nulls,
empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import collections
import itertools
import math
import random

import numpy as np
import pytest

from zoneflow.llm import lexical_search, toxicity, whitening

# --- toxicity ---------------------------------------------------------------------------

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron".split()


def toxic_table(n=240, seed=0):
    """Documents of which a third hold runs of bad words, and their labels."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        ws = [rng.choice(WORDS) + rng.choice(["", "s", "n"]) for _ in range(rng.randrange(15, 80))]
        for _ in range(rng.randrange(1, 4) if bad else 0):
            at = rng.randrange(len(ws))
            ws[at:at] = [rng.choice(["nasty", "vile", "grim"])] * rng.randrange(1, 3)
        docs.append((i, " ".join(ws), 0.5, "x"))
        labels.append((i, int(not bad), int(bad), "y"))
    return docs, labels


DOCS = "doc_id long, text string, score double, toxic string"
LABELS = "doc_id long, quality int, toxic int, text string"


def test_toxic_spans_and_scores(spark):
    docs, labels = toxic_table()
    odd = [(1000, None, None, None), (1001, "", 0.0, ""), (1002, "1 2 3 _", 0.0, ""), (None, "nasty words", 0.0, ""), (1003, "alpha İ beta VILE alpha vile!", 1.0, ""),
           (1003, "alpha İ beta VILE alpha vile!", 1.0, ""), (1004, "alpha " * 200_000 + "vile " * 40, 1.0, ""), (1005, "a" * 100_000, 1.0, "")]
    df = spark.createDataFrame(docs + odd, DOCS)
    known = spark.createDataFrame([*labels, (None, 1, 1, ""), (1000, 0, 1, ""), (7, None, None, ""), (9999, 0, 1, "")], LABELS)
    model = toxicity.fit(df, known)
    got = toxicity.score(df, model).collect()
    assert len(got) == len(docs) + len(odd)
    by = {r["doc_id"]: r for r in got}
    wrong = sum(by[i]["predicted"] != y for i, _, y, _ in labels)
    assert wrong <= 2 and all(0 <= r["score"] <= 1 and (r["score"] >= 0.3) == r["predicted"] for r in got)
    texts = {i: t for i, t, _, _ in docs + odd}
    for i, _, y, _ in labels:
        if y and by[i]["predicted"]:
            assert all(set(texts[i][s["start"]:s["end"]].split()) <= {"nasty", "vile", "grim"} for s in by[i]["spans"])
    assert [texts[1003][s["start"]:s["end"]] for s in by[1003]["spans"]] == ["VILE", "vile"]
    assert len({r["score"] for r in got if r["doc_id"] == 1003}) == 1 and not by[None]["held_out"]
    assert by[1000]["score"] == by[1001]["score"] == by[1002]["score"] == min(r["score"] for r in got)
    assert by[1004]["predicted"] == 1 and by[1004]["spans"][-1]["end"] == len(texts[1004]) - 1
    assert toxicity.score(df.limit(0), model).count() == 0


def test_held_out_labels_do_not_teach(spark):
    docs, labels = toxic_table()
    df = spark.createDataFrame(docs, DOCS)
    held = {r["doc_id"] for r in toxicity.score(df, toxicity.Model(np.zeros((1 << toxicity.BITS, 3)), np.zeros((3, 3)), (0.0, 0.0, 0.0, 0.0))).collect() if r["held_out"]}
    assert held == {i for i, *_ in docs if __import__("zlib").crc32(str(i).encode()) % 4 == 2}
    flipped = [(i, q, 1 - y if i in held else y, t) for i, q, y, t in labels]
    a, b = (toxicity.fit(df, spark.createDataFrame(x, LABELS)) for x in (labels, flipped))
    assert a.scale == b.scale and (a.weights == b.weights).all() and (a.transitions == b.transitions).all()


@pytest.mark.parametrize("labels", [[], [(3, 0, 1, "")], [(3, 0, 0, ""), (4, 0, 0, "")]])
def test_toxicity_without_two_classes(spark, labels):
    docs, _ = toxic_table(20)
    df = spark.createDataFrame(docs, DOCS)
    model = toxicity.fit(df, spark.createDataFrame(labels, LABELS))
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(df, model).collect())


def test_tag_marginals_match_every_path():
    rng = np.random.default_rng(1)
    model = toxicity.Model(rng.normal(size=(1 << toxicity.BITS, 3)) * 0.1, np.where([[0, 0, 1], [0, 0, 0], [0, 0, 0]], toxicity.NEVER, rng.normal(size=(3, 3))), ())
    texts = [["one"], ["two", "three", "two", "x"], []]
    for ws, p in zip(texts, toxicity.marginals(model, texts)):
        total, held = 0.0, np.zeros(len(ws))
        e = toxicity.emissions(model.weights, ws) if ws else None
        for path in itertools.product(range(3), repeat=len(ws)) if ws else []:
            z = sum(e[i, y] for i, y in enumerate(path)) + sum(model.transitions[a, b] for a, b in zip(path, path[1:])) + toxicity.NEVER * (path[0] == 2)
            total += math.exp(z)
            held += math.exp(z) * (np.array(path) != 0)
        assert np.allclose(p, held / total if ws else [], atol=1e-9)


def test_tags_and_units():
    assert toxicity.tags_of(np.array([True, True, False, True])).tolist() == [1, 2, 0, 1]
    assert toxicity.units("abcdef") == ["abcdef ", "abcd", "abcde"] and toxicity.units("ab") == ["ab "]


# --- whitening --------------------------------------------------------------------------


def brute_whitening(vectors, k=4):
    """{row: whitened}, explained, deviation by numpy over the distinct vectors."""
    x = np.array(vectors, dtype=np.float64) * 256
    x = np.floor(x).astype(np.int64)
    u = np.unique(x, axis=0)
    values, vectors = np.linalg.eigh(np.cov(u.T, bias=True).reshape(x.shape[1], x.shape[1]))
    values, vectors = values[::-1], vectors[:, ::-1]
    deviation = [sum((len(u) * int(a) - int(s)) ** 2 for a, s in zip(r, u.sum(axis=0))) for r in x]
    return (x - u.sum(axis=0) / len(u)) @ vectors[:, :k] / np.sqrt(np.maximum(values[:k], 1e-300)), values / values.sum(), deviation, len(u)


@pytest.mark.parametrize("dim, scale", [(3, 1.0), (8, 1.0), (8, 1e-2), (5, 3e3), (5, 1e5)])
def test_whitening_matches_numpy(spark, dim, scale):
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(300, dim)) * np.linspace(3, 0.5, dim) * scale + 5 * scale
    x = np.concatenate([x, np.repeat(x[:1], 150, axis=0)])  # one vector is a third of all rows
    df = spark.createDataFrame([(i, [float(v) for v in r], 1, "c") for i, r in enumerate(x)], "vec_id long, embedding array<double>, n int, x string").repartition(7)
    got = whitening.whiten(df).toPandas()
    z, share, deviation, n = brute_whitening(x)
    assert len(got) == len(x) * min(4, dim) and (got.n == n).all() and got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-8
    for c in range(min(4, dim)):
        part = got[got.component == c + 1].sort_values("vec_id")
        assert np.allclose(part.explained, share[c], rtol=1e-9)
        assert min(np.abs(part.whitened - z[:, c]).max(), np.abs(part.whitened + z[:, c]).max()) < 1e-7
        assert [None if v != v else int(v) for v in part.deviation] == [v if v < 1 << 63 else None for v in deviation]


def test_whitening_of_dependent_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 2))
    x = np.floor(np.column_stack([base, base @ [[1.0], [1.0]], np.ones(60)]) * 256) / 256  # rank 2 in 4 dimensions
    x[:, 2] = x[:, 0] + x[:, 1]
    rows = [(i, r.tolist()) for i, r in enumerate(x)]
    odd = [(100, None), (101, []), (102, [1.0, None, 0.0, 0.0]), (103, [float("nan")] * 4), (104, [float("inf"), 0.0, 0.0, 0.0]), (105, [1e300, 0.0, 0.0, 0.0]), (106, [1.0, 2.0]),
           (0, rows[0][1]), (None, rows[1][1])]
    got = whitening.whiten(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")).toPandas()
    assert sorted(set(got.component)) == [1, 2] and (got.n == 60).all() and got.identity_error.iloc[0] < 1e-8
    assert collections.Counter(got.vec_id.fillna(-1)) == collections.Counter([*range(60), 0, -1] * 2)
    empty = spark.createDataFrame(rows, "vec_id long, embedding array<double>").limit(0)
    assert whitening.whiten(empty).count() == 0 and whitening.whiten(spark.createDataFrame(rows[:1], empty.schema)).count() == 0


def test_exact_numbers_beyond_longs():
    x = np.array([[1 << 50, -(1 << 50)], [3, 4]])
    sums = ((1 << 50) + 3, 4 - (1 << 50))
    assert whitening.deviations(x, 1 << 20, sums).tolist() == [[(1 << 70) - sums[0], -(1 << 70) - sums[1]], [(3 << 20) - sums[0], (4 << 20) - sums[1]]]


def test_cholesky_qr_factors():
    rng = np.random.default_rng(3)
    for spread in (1.0, 1e-4, 1e-7):
        a = rng.normal(size=(200, 6)) @ np.diag(np.geomspace(1, spread, 6)) @ np.linalg.qr(rng.normal(size=(6, 6)))[0]

        def pass_(factors):
            q = a
            for f in factors:
                q = whitening.triangular_solve(q, f)
            return q.T @ q
        r, factors = whitening.cholesky_qr(pass_)
        assert np.allclose(r.T @ r, a.T @ a, rtol=0, atol=1e-13 * 200)
        q = np.linalg.solve(r.T, a.T).T
        assert np.abs(q.T @ q - np.eye(6)).max() < 1e-6 and 3 <= len(factors) <= whitening.PASSES


# --- lexical search ---------------------------------------------------------------------


def brute_search(docs, items, k):
    def terms(t):
        return "".join(c.lower() if c.isascii() and c.isalnum() else c if ord(c) > 127 else " " for c in t or "").split(" ")
    words = [[w for w in terms(t) if w] for _, t in docs]
    n_docs, n_terms = sum(bool(w) for w in words), sum(map(len, words))
    counts = [collections.Counter(w) for w in words]
    df = collections.Counter(t for c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for (i, _), w, c in zip(docs, words, counts):
            m = 75 + (25 * len(w) * n_docs) // n_terms if n_terms else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def search_rows(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    common = ["the", "of", "and"]

    def text(n):
        return " ".join(rng.choice(common) if rng.random() < 0.4 else vocabulary[int(rng.random() ** 2 * 300)] for _ in range(n))
    docs = [(i, text(rng.randrange(1, 60))) for i in range(300)]
    passage = text(30)
    docs += [(300 + i, text(5) + " " + passage) for i in range(40)]  # near copies
    docs += [(400 + i, docs[0][1]) for i in range(100)]              # a third are exact copies: ties
    docs += [(600, None), (601, ""), (602, " ,;-\n"), (None, passage), (603, "É é the-OF"), (603, "É é the-OF"), (604, "the " * 30_000)]
    items = [(i, text(rng.randrange(1, 40))) for i in range(12)] + [(50, passage), (51, None), (52, "?!"), (53, "É é The the"), (None, "w1 w2"), (50, passage), (54, "unknown words"), (55, docs[0][1])]
    return docs, items


@pytest.mark.parametrize("seed, block, shard, k", [(1, 4, 64, 20), (2, 64, 4096, 20), (3, 2, 100, 3)])
def test_search_is_exact(spark, monkeypatch, seed, block, shard, k):
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical_search, "SHARD_DOCS", shard)
    docs, items = search_rows(seed)
    d = spark.createDataFrame([(*r, 1, "n") for r in docs], "doc_id long, text string, score int, terms string").repartition(3)
    q = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    got, report = lexical_search.search_report(d, q, k)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_search(docs, items, k)
    counted = report.first()
    assert 0 < counted["opened"] <= counted["blocks"] and (seed == 2 or counted["opened"] < counted["blocks"])


def test_search_in_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "QUERY_ITEMS", 5)
    docs, items = search_rows(4)
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sorted((tuple(r) for r in lexical_search.search(d, q).collect()), key=repr) == brute_search(docs, items, 20)
    assert lexical_search.search(d.limit(0), q).count() == lexical_search.search(d, q.limit(0)).count() == lexical_search.search(d, q.where("item_id = 51")).count() == 0


def test_bounds_hold_for_every_document():
    rng = np.random.default_rng(0)
    queries = lexical_search.query_block([(i, " ".join(f"t{j}" for j in rng.integers(0, 20, size=6))) for i in range(8)])
    n = len(queries.vocabulary)
    dense = np.where(rng.random((90, n)) < 0.3, rng.integers(1, 1000, size=(90, n)), 0).astype(np.float32)
    weights = rng.integers(0, 50, size=n)
    sketch = lexical_search.sketches(np.arange(0, 90 * n + 1, n), np.tile(np.arange(n), 90), dense.ravel(), lexical_search.signs(n))
    s = lexical_search.posting_blocks(dense, sketch, queries.near)
    best = {}
    for q, b, bound in zip(*lexical_search.block_bounds(s, queries, weights)):
        for d in s["block_docs"][s["block_ptr"][int(b)]:s["block_ptr"][int(b) + 1]]:
            best[(int(q), int(d))] = max(bound, best.get((int(q), int(d)), 0))
    for q in range(8):
        scores = dense[:, queries.terms[q]].astype(int) @ (queries.counts[q] * weights[queries.terms[q]])
        for d in range(90):
            assert scores[d] <= best.get((q, d), 0)
