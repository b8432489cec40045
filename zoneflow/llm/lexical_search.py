"""Ranked lexical search with per-term geometric blocking: the documents of each term's posting
list are clustered by similarity into blocks, a block keeps the coordinatewise maximum of its
documents, and a query opens a block only if its score on those maxima (over the block's term
and the lighter terms of the query) reaches the query's threshold.

The index is cut by documents: similar documents stand together in shards of bounded size (one
row of a written table), and each shard holds the posting lists of its documents. All work of a
shard is local, so nothing grows with a term's full list. Impacts are integers, the maxima are
exact, and so are the bounds: no document that belongs to a result can be skipped.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.llm.common import small_batches, sized, slices, written

K = 20
QUERY_ITEMS = 512          # items of a query block, about
QUERY_BYTES = 1 << 20      # and their text, about
SHARD_CELLS = 1 << 23      # documents x query terms of a shard
SHARD_DOCS = 4096
BLOCK_DOCS = 64            # documents of a posting block, about
SKETCH = 64                # dimensions of the similarity sketch
SKETCH_ROWS = 256
CLUSTERS = 64
SAMPLE = 2048              # documents from which the cluster centres are chosen; all are indexed
FIRST_BLOCKS = 2           # blocks a query opens in a shard to find its threshold
SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
NORMAL = bytes.maketrans(SEPARATORS + bytes(range(65, 91)), b" " * len(SEPARATORS) + bytes(range(97, 123)))


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all characters beyond ASCII; A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(NORMAL).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impact(tf, n, n_docs: int, n_terms: int):
    """Integer part of a term's score in a document of ``n`` terms, before the weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // max(n_terms, 1)))


@dataclass(frozen=True)
class Queries:
    """A block of queries over its own vocabulary."""
    keys: tuple             # query keys
    vocabulary: dict        # term -> number
    terms: tuple            # arrays of term numbers, by query
    counts: tuple           # arrays of repeats, by query
    holders: tuple          # arrays of queries, by term
    near: tuple             # arrays of the terms that share a query with a term, itself included


def query_block(rows: list[tuple[int, str | None]]) -> Queries:
    vocabulary: dict[bytes, int] = {}
    terms, counts = [], []
    for _, text in rows:
        c = Counter(terms_of(text))
        terms.append(np.array([vocabulary.setdefault(t, len(vocabulary)) for t in c], dtype=np.int64))
        counts.append(np.array(list(c.values()), dtype=np.int64))
    holders: list[list[int]] = [[] for _ in vocabulary]
    for q, ts in enumerate(terms):
        for t in ts.tolist():
            holders[t].append(q)
    near = tuple(np.unique(np.concatenate([terms[q] for q in h])) for h in holders)
    return Queries(tuple(k for k, _ in rows), vocabulary, tuple(terms), tuple(counts), tuple(np.array(h, dtype=np.int64) for h in holders), near)


def _vectors(shared):
    """``n`` and the numbers and frequencies of the query terms of each text that has a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value.vocabulary
        for batch in batches:
            for part in slices(batch, "text"):
                n, terms, tfs = [], [], []
                for t in part.column("text").to_pylist():
                    words = terms_of(t)
                    c = Counter(w for w in words if w in vocabulary)
                    n.append(len(words))
                    terms.append([vocabulary[w] for w in c])
                    tfs.append(list(c.values()))
                out = pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                                                 names=["doc_id", "n", "terms", "tfs"])
                yield out.filter(pc.greater(out.column("n"), 0))
    return run


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0, and values, of a list column."""
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.flatten().to_numpy(zero_copy_only=False)


def signs(n_terms: int) -> np.ndarray:
    """Random signs (n_terms x SKETCH) of the similarity sketch."""
    return np.random.default_rng(5).choice(np.array([-1.0, 1.0], dtype=np.float32), size=(n_terms, SKETCH))


def sketches(offsets: np.ndarray, terms: np.ndarray, values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Unit sketches of sparse vectors: random projections that keep their angles, about."""
    out = np.zeros((len(offsets) - 1, table.shape[1]), dtype=np.float32)
    some = np.flatnonzero(np.diff(offsets))
    for rows in np.split(some, range(SKETCH_ROWS, len(some), SKETCH_ROWS)) if len(some) else []:  # bounds the memory of the products
        at = slice(offsets[rows[0]], offsets[rows[-1] + 1])
        out[rows] = np.add.reduceat(table[terms[at]] * values[at, None].astype(np.float32), offsets[rows] - offsets[rows[0]])
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def centres_of(x: np.ndarray, k: int, rounds: int = 5) -> np.ndarray:
    """Unit cluster centres of unit vectors: farthest-first starts, then spherical k-means."""
    if not len(x):
        return np.zeros((1, SKETCH), dtype=np.float32)
    picks, near = [0], x @ x[0]
    while len(picks) < min(k, len(x)):
        picks.append(int(near.argmin()))
        near = np.maximum(near, x @ x[picks[-1]])
    c = x[picks].copy()
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 1e-9, total / np.maximum(size, 1e-9), c)
    return c


def _placed(shared_facts):
    """Impacts of the query terms and the place of each document: cluster, then similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, n_docs, n_terms, centres, table = shared_facts.value
        for b in batches:
            offsets, terms = _flat(b.column("terms"))
            _, tfs = _flat(b.column("tfs"))
            n = np.repeat(b.column("n").to_numpy(), np.diff(offsets))
            f = impact(tfs, n, n_docs, n_terms)
            s = sketches(offsets, terms, f * weights[terms], table)
            near = s @ centres.T
            own = near.argmax(axis=1)
            lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(v, pa.int32())) for v in (terms, f)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *lists, pa.array(own, pa.int32()), pa.array(near[np.arange(len(own)), own], pa.float32())],
                                             names=["doc_id", "terms", "impacts", "cluster", "likeness"])
    return run


INDEX = "ids {}, ptr binary, terms binary, impacts binary, block_term binary, block_ptr binary, block_docs binary, sum_ptr binary, sum_terms binary, sum_max binary"


def posting_blocks(dense: np.ndarray, sketch: np.ndarray, near: tuple) -> dict[str, np.ndarray]:
    """Blocks of the posting lists of a shard (``dense``: documents x terms): for each block its
    term, its documents, and the largest impact of each term that shares a query with its own."""
    term_of, ptr, members, sum_ptr, sum_terms, sum_max = [], [0], [], [0], [], []
    for t in np.flatnonzero(dense.any(axis=0)):
        held = np.flatnonzero(dense[:, t])
        k = -(-len(held) // BLOCK_DOCS)
        if k > 1:  # documents most like each of k documents spread over the list
            spread = held[(np.arange(k) * len(held)) // k]
            own = (sketch[held] @ sketch[spread].T).argmax(axis=1)
            order = np.argsort(own, kind="stable")
            held, own = held[order], own[order]
            starts = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1])
        else:
            starts = np.array([0])
        columns = near[t]
        best = np.maximum.reduceat(dense[np.ix_(held, columns)], starts, axis=0)
        for i, row in enumerate(best):
            some = np.flatnonzero(row)
            sum_terms.append(columns[some])
            sum_max.append(row[some])
            sum_ptr.append(sum_ptr[-1] + len(some))
        term_of += [t] * len(starts)
        members.append(held)
        ptr += [ptr[-1] + int(s) for s in [*starts[1:], len(held)]]

    def joined(parts):
        return np.concatenate(parts).astype("<i4") if parts else np.zeros(0, "<i4")
    return {"block_term": np.array(term_of, "<i4"), "block_ptr": np.array(ptr, "<i4"), "block_docs": joined(members),
            "sum_ptr": np.array(sum_ptr, "<i4"), "sum_terms": joined(sum_terms), "sum_max": joined(sum_max)}


def densely(ptr: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_terms: int) -> np.ndarray:
    """Impacts as a matrix; below 2^24, so exact as floats."""
    out = np.zeros((len(ptr) - 1, n_terms), dtype=np.float32)
    out[np.repeat(np.arange(len(ptr) - 1), np.diff(ptr)), terms] = impacts
    return out


def shard_docs(n_terms: int) -> int:
    return max(64, min(SHARD_DOCS, SHARD_CELLS // max(n_terms, 1)))


def _shards(shared, shared_facts, id_type: pa.DataType):
    """One row for each run of at most SHARD_DOCS documents that stand together."""
    def shard(ids, terms, impacts, near, table, weights):
        ptr = np.concatenate([[0], np.cumsum([len(t) for t in terms])]).astype("<i4")
        flat, f = np.concatenate(terms).astype("<i4"), np.concatenate(impacts).astype("<i4")
        blocks = posting_blocks(densely(ptr, flat, f, len(near)), sketches(ptr, flat, f * weights[flat], table), near)
        columns = {"ptr": ptr, "terms": flat, "impacts": f} | blocks
        return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(id_type))] + [pa.array([c.tobytes()], pa.binary()) for c in columns.values()], names=["ids", *columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = shared.value.near
        weights, _, _, _, table = shared_facts.value
        most = shard_docs(len(near))
        ids, terms, impacts = [], [], []
        for b in batches:
            offsets, flat = _flat(b.column("terms"))
            _, f = _flat(b.column("impacts"))
            ids += b.column("doc_id").to_pylist()
            terms += np.split(flat, offsets[1:-1])
            impacts += np.split(f, offsets[1:-1])
            while len(ids) >= most:
                yield shard(ids[:most], terms[:most], impacts[:most], near, table, weights)
                ids, terms, impacts = ids[most:], terms[most:], impacts[most:]
        if ids:
            yield shard(ids, terms, impacts, near, table, weights)
    return run


def block_bounds(s: dict[str, np.ndarray], queries: Queries, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, block, bound) for every block of a term of the query: the score of the block's
    maxima over that term and the lighter terms of the query. A document is sought in the block
    of the heaviest query term that it holds, where no heavier term adds to its score."""
    term, ptr = s["block_term"], s["sum_ptr"]
    qs, blocks, bounds = [], [], []
    starts = np.concatenate([[0], np.flatnonzero(np.diff(term)) + 1, [len(term)]]) if len(term) else np.zeros(1, int)
    place = np.full(len(weights), -1)
    for a, b in zip(starts[:-1], starts[1:]):
        t = int(term[a])
        columns, holders = queries.near[t], queries.holders[t]
        place[columns] = np.arange(len(columns))
        best = np.zeros((b - a, len(columns)))
        at = slice(ptr[a], ptr[b])
        best[np.repeat(np.arange(b - a), np.diff(ptr[a:b + 1])), place[s["sum_terms"][at]]] = s["sum_max"][at]
        ask = np.zeros((len(columns), len(holders)))
        for j, q in enumerate(holders.tolist()):
            us = queries.terms[q]
            lighter = (weights[us] < weights[t]) | ((weights[us] == weights[t]) & (us >= t))
            ask[place[us], j] = np.where(lighter, queries.counts[q] * weights[us], 0)
        qs.append(np.tile(holders, b - a))
        blocks.append(np.repeat(np.arange(a, b), len(holders)))
        bound = best @ ask
        if ask.sum(axis=0).max() * 1e6 >= 1 << 53:
            bound *= 1 + 1e-9  # sums that doubles may round
        bounds.append(bound.ravel())
    return tuple(np.concatenate(v) if v else np.zeros(0) for v in (qs, blocks, bounds))


def _probe(shared, shared_facts, thresholds, id_type: pa.DataType, k: int):
    """The best documents of each shard for each query, from opened blocks only. With
    ``thresholds`` None a query opens its FIRST_BLOCKS best blocks, otherwise all blocks whose
    bound reaches its threshold. One more row a shard (``q`` -1) counts ``blocks`` and ``opened``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = shared.value, shared_facts.value[0]
        known = thresholds.value if thresholds is not None else None
        for b in batches:
            for r in range(b.num_rows):
                s = {c: np.frombuffer(b.column(c)[r].as_buffer(), dtype="<i4") for c in b.schema.names if c != "ids"}
                ids = b.column("ids")[r].values
                id_value = ids.cast(pa.int64()).fill_null(np.iinfo(np.int64).max).to_numpy()  # null ids last
                q, block, bound = block_bounds(s, queries, weights)
                if known is None:
                    order = np.lexsort((-bound, q))
                    first = np.concatenate([[0], np.flatnonzero(np.diff(q[order])) + 1])
                    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.concatenate([first, [len(order)]]))) if len(order) else order
                    keep = order[rank < FIRST_BLOCKS]
                else:
                    keep = np.flatnonzero(bound >= known[q.astype(np.int64)]) if len(q) else np.zeros(0, int)
                keep = keep[np.argsort(q[keep], kind="stable")] if len(keep) else keep
                n_terms = len(weights)
                dense = densely(s["ptr"], s["terms"], s["impacts"], n_terms)
                out_q, out_at, out_s = [], [], []
                cuts = np.flatnonzero(np.diff(q[keep])) + 1 if len(keep) else []
                for part in np.split(keep, cuts) if len(keep) else []:
                    one = int(q[part[0]])
                    docs = np.unique(np.concatenate([s["block_docs"][s["block_ptr"][i]:s["block_ptr"][i + 1]] for i in block[part].astype(np.int64)]))
                    ask = queries.counts[one] * weights[queries.terms[one]]
                    x = dense[np.ix_(docs, queries.terms[one])]
                    if int(ask.sum()) * 1_000_000 < 1 << 53:
                        total = (x.astype(np.float64) @ ask.astype(np.float64)).astype(np.int64)  # exact: integers below 2^53
                    else:
                        total = x.astype(np.int64) @ ask
                    ok = total >= (max(1, known[one]) if known is not None else 1)
                    docs, total = docs[ok], total[ok]
                    best = np.lexsort((id_value[docs], -total))[:k]
                    out_q += [one] * len(best)
                    out_at += docs[best].tolist()
                    out_s += total[best].tolist()
                empty = pa.nulls(len(out_q), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([*out_q, -1], pa.int32()), pa.concat_arrays([ids.take(pa.array(out_at, pa.int64())), pa.nulls(1, id_type)]), pa.array([*out_s, None], pa.int64()),
                                                  pa.concat_arrays([empty, pa.array([len(q)], pa.int64())]), pa.concat_arrays([empty, pa.array([len(keep)], pa.int64())])],
                                                 names=["q", "doc_id", "score", "blocks", "opened"])
    return run


def _search_block(docs: DataFrame, queries: Queries, k: int) -> DataFrame:
    """``qkey, doc_id, score`` candidates (the best ``k`` of each query among them) and the
    counting rows, for one block of queries."""
    spark = docs.sparkSession
    id_type = dict(docs.dtypes)["doc_id"]
    arrow_id = {"bigint": pa.int64(), "int": pa.int32()}[id_type]
    shared = spark.sparkContext.broadcast(queries)
    vectors = written(docs.select("doc_id", "text").mapInArrow(_vectors(shared), f"doc_id {id_type}, n long, terms array<int>, tfs array<long>"), "lexical-vectors")
    facts = vectors.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    dfs = {r["t"]: r["df"] for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect()}
    weights = np.array([weight(facts["n"], dfs[t]) if t in dfs else 0 for t in range(len(queries.vocabulary))], dtype=np.int64)
    table = signs(len(weights))
    with_terms = vectors.where(F.size("terms") > 0)
    share = min(1.0, 4 * SAMPLE / max(facts["n"], 1))  # the others are not even ranked
    chosen = with_terms.withColumn("_h", F.xxhash64("doc_id", "terms")).where(F.pmod("_h", F.lit(1 << 30)) < share * (1 << 30)).orderBy("_h", "doc_id").limit(SAMPLE).collect()
    offsets = np.concatenate([[0], np.cumsum([len(r["terms"]) for r in chosen])]).astype(np.int64)
    terms = np.array([t for r in chosen for t in r["terms"]], dtype=np.int64)
    f = impact(np.array([t for r in chosen for t in r["tfs"]], dtype=np.int64), np.repeat(np.array([r["n"] for r in chosen], dtype=np.int64), np.diff(offsets)), facts["n"], facts["l"])
    centres = centres_of(sketches(offsets, terms, f * weights[terms], table), CLUSTERS)
    shared_facts = spark.sparkContext.broadcast((weights, facts["n"], facts["l"], centres, table))
    placed = with_terms.mapInArrow(_placed(shared_facts), f"doc_id {id_type}, terms array<int>, impacts array<int>, cluster int, likeness float")
    placed = written(placed, "lexical-placed").withColumn("_r", F.monotonically_increasing_id())
    parts = max(1, math.ceil(facts["n"] / (2 * shard_docs(len(weights)))))
    placed = placed.repartitionByRange(parts, "cluster", "likeness", "_r").sortWithinPartitions("cluster", "likeness").select("doc_id", "terms", "impacts")
    index = written(placed.mapInArrow(_shards(shared, shared_facts, arrow_id), INDEX.format(f"array<{id_type}>")), "lexical-index")
    schema = f"q int, doc_id {id_type}, score long, blocks long, opened long"
    with small_batches(spark, 2):
        first = written(index.mapInArrow(_probe(shared, shared_facts, None, arrow_id, k), schema).where("q >= 0"), "lexical-first")
        place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
        floor = {r["q"]: r["score"] for r in first.withColumn("_n", place).where(F.col("_n") == k).select("q", "score").collect()}
        thresholds = spark.sparkContext.broadcast(np.array([floor.get(q, 1) for q in range(len(queries.keys))], dtype=np.int64))
        found = written(index.mapInArrow(_probe(shared, shared_facts, thresholds, arrow_id, k), schema), "lexical-found")
    keys = sized(written(spark.createDataFrame(list(enumerate(queries.keys)), "q int, qkey long"), "lexical-keys"))
    return found.join(keys, "q", "left").drop("q")


def search_report(docs: DataFrame, items: DataFrame, k: int = K) -> tuple[DataFrame, DataFrame]:
    """The result of ``search``, and one row with the numbers of (query, block) pairs that a
    query's terms have and of those that were opened."""
    spark = docs.sparkSession
    asked = written(items.select(F.monotonically_increasing_id().alias("qkey"), "item_id", "text"), "lexical-items")
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    n_blocks = max(1, math.ceil(size["n"] / QUERY_ITEMS), math.ceil(size["b"] / QUERY_BYTES))
    found = None
    for i in range(n_blocks):
        rows = asked.where(F.pmod(F.xxhash64("qkey"), F.lit(n_blocks)) == i).select("qkey", "text").collect()
        queries = query_block(sorted((r["qkey"], r["text"]) for r in rows))
        if queries.vocabulary:
            part = _search_block(docs, queries, k)
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], f"doc_id {dict(docs.dtypes)['doc_id']}, score long, blocks long, opened long, qkey long")
    place = F.row_number().over(Window.partitionBy("qkey").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    best = found.where("qkey is not null").withColumn("rank", place).where(F.col("rank") <= k).select("qkey", "rank", "doc_id", "score")
    result = best.join(asked.select("qkey", "item_id"), "qkey").select("item_id", "rank", "doc_id", "score")
    return result, found.where("qkey is null").agg(F.coalesce(F.sum("blocks"), F.lit(0)).alias("blocks"), F.coalesce(F.sum("opened"), F.lit(0)).alias("opened"))


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of ``docs`` (``doc_id, text``) with the
    highest score above 0 for every row of ``items`` (``item_id, text``).

    Whole texts are read. Null texts and texts without terms are no documents, and as items
    they find nothing. Equal scores go to the smaller doc_id (null ids last); repeated rows are
    documents, and items, of their own. Other columns are ignored whatever their names; empty
    tables give no rows. Items are taken in blocks whose vocabulary every task can hold; one
    item's text is never split.
    """
    return search_report(docs, items, k)[0]
