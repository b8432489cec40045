"""Packing: optimal length buckets. Dynamic programming over the global length histogram
chooses the bucket boundaries that minimise padding; token-budget batches form inside each
bucket."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import prefix_sums, word_count, written

CONTEXT = 2048
BUCKETS = 12
BATCH_TOKENS = 16384
SEED = 20240612


def best_boundaries(lengths, counts, n_buckets: int) -> list[int]:
    """Upper bounds of at most ``n_buckets`` buckets over a histogram (ascending positive
    ``lengths`` with ``counts``) with the least padding; of equal choices the one with
    fewer buckets, then smaller bounds. Exact: every boundary of a best solution is an occurring length."""
    n = len(lengths)
    if not n:
        return []
    length, count = np.asarray(lengths, dtype=np.float64), np.asarray(counts, dtype=np.float64)
    c = np.concatenate([[0], np.cumsum(count)])
    best = np.concatenate([[0.0], length * c[1:]])  # one bucket up to each length; the sum of all lengths is constant
    cuts, total = [], [best[n]]
    for _ in range(1, min(n_buckets, n)):
        new, arg = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=np.int64)
        new[0] = 0
        for j in range(1, n + 1):
            cost = best[:j] + length[j - 1] * (c[j] - c[:j])
            arg[j] = int(np.argmin(cost))
            new[j] = cost[arg[j]]
        best = new
        cuts.append(arg)
        total.append(best[n])
    k, j, out = int(np.argmin(total)), n, []
    while j:
        out.append(int(lengths[j - 1]))
        j = int(cuts[k - 1][j]) if k else 0
        k -= 1
    return out[::-1]


def pack(docs: DataFrame, context: int = CONTEXT, n_buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS,
         n_tokens: str | None = None, seed: int = SEED) -> DataFrame:
    """Batches of similarly long sequences.

    ``docs`` needs ``doc_id, text`` (or the column named by ``n_tokens`` in place of the
    text; by default a token is a word). A document longer than ``context`` is cut into
    consecutive segments of ``context`` tokens and a rest, so nothing is dropped and the
    histogram has at most ``context`` entries, the only thing the driver sees. A segment
    belongs to the smallest bucket that holds it; a bucket's segments, in hash order, fill
    batches of ``batch_tokens // bucket_len`` rows (one at least) padded to ``bucket_len``.

    Returns one row per segment: ``doc_id, segment`` (from 0), ``start`` (first token),
    ``n_tokens, bucket_len, batch`` (from 0 in its bucket), ``slot`` (row in the batch) and
    ``padding``. A document without tokens (null, blank) has one row with 0 tokens and null
    bucket, batch and slot. Null ids, repeated rows and extra columns are fine: only the
    named columns are read, and equal rows are packed separately. An empty table gives none.
    """
    size = word_count(F.col("text")) if n_tokens is None else F.greatest(F.coalesce(F.col(n_tokens), F.lit(0)), F.lit(0)).cast("long")
    sizes = docs.select("doc_id", size.alias("_size"), F.xxhash64(*(["doc_id", "text"] if n_tokens is None else ["doc_id", n_tokens])).alias("_h"))
    last = F.greatest(F.ceil(F.col("_size") / context).cast("long") - 1, F.lit(0).cast("long"))
    parts = written(sizes.withColumn("segment", F.explode(F.sequence(F.lit(0).cast("long"), last)))
                    .withColumn("start", F.col("segment") * context)
                    .withColumn("n_tokens", F.least(F.lit(context).cast("long"), F.col("_size") - F.col("start")))
                    .withColumn("_key", F.xxhash64(F.lit(seed), "_h", "segment"))
                    .select("doc_id", "segment", "start", "n_tokens", "_key"), "pack-segments")
    histogram = parts.where("n_tokens > 0").groupBy("n_tokens").count().orderBy("n_tokens").collect()  # <= context rows
    bounds = best_boundaries([r["n_tokens"] for r in histogram], [r["count"] for r in histogram], n_buckets)
    if not bounds:
        return parts.select("doc_id", "segment", "start", "n_tokens", *[F.lit(None).cast("long").alias(c) for c in ("bucket_len", "batch", "slot")], F.lit(0).cast("long").alias("padding"))
    bucket = F.element_at(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds]), lambda b: b >= F.col("n_tokens")), 1)
    filled = parts.where("n_tokens > 0").withColumn("bucket_len", bucket).withColumn("_one", F.lit(1).cast("long"))
    ranked = prefix_sums(filled, "bucket_len", "_key", "_one", ["doc_id", "segment", "n_tokens"])
    rows = F.greatest(F.floor(F.lit(batch_tokens) / F.col("bucket_len")), F.lit(1)).cast("long")
    out = ranked.select("doc_id", "segment", "start", "n_tokens", "bucket_len", F.floor(F.col("before") / rows).cast("long").alias("batch"),
                        F.pmod(F.col("before"), rows).cast("long").alias("slot"), (F.col("bucket_len") - F.col("n_tokens")).alias("padding"))
    empty = parts.where("n_tokens = 0").select("doc_id", "segment", "start", "n_tokens", *[F.lit(None).cast("long").alias(c) for c in ("bucket_len", "batch", "slot")], F.lit(0).cast("long").alias("padding"))
    return out.unionByName(empty)
