"""Mixing sources to target weights: hash-random order within each source, distributed
prefix sums of word counts, a cut at each source's exact budget, whole epochs repeated.

Native: DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.llm.common import group_key, prefix_sums, sized, word_count, written

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 20240611


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``_g, source_size, target``.

    Sources in code point order (null last) get ``weights`` in turn. All sizes together are
    shared by weight; a target stops at ``max_epochs`` times its source's size and the rest
    is shared again by weight among the others. In order of (limit / weight) the sources
    that stop come first, so the level at which the rest share is found with window sums
    over the source table (one row a source) instead of repeated passes.
    """
    per = sizes.groupBy("_g").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("_g") == "n", "_g")
    w = F.array(*[F.lit(int(x)) for x in weights])
    per = per.withColumn("_w", F.element_at(w, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("_cap", F.col("source_size") * max_epochs).withColumn("_ratio", F.col("_cap") / F.col("_w"))
    level = Window.orderBy("_ratio", "_g")
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    rest = level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    per = (per.withColumn("_rank", F.row_number().over(level))
           .withColumn("_level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
                       / F.sum("_w").over(rest)))
    per = per.withColumn("_first", F.min(F.when(F.col("_level") <= F.col("_ratio"), F.col("_rank"))).over(everything))
    shared = F.max(F.when(F.col("_rank") == F.col("_first"), F.col("_level"))).over(everything)
    return per.select("_g", "source_size",
                      F.when(F.col("_rank") < F.col("_first"), F.col("_cap").cast("double"))
                      .otherwise(F.least(shared * F.col("_w"), F.col("_cap").cast("double"))).alias("target"))


def hash_key(seed: int) -> Column:
    """60 bits of the MD5 of seed, id and text, as long."""
    text = F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def mix_plan(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """How many words of each document the mix takes.

    Returns one row per row of ``docs`` (columns ``doc_id, text, source`` are read):
    ``doc_id, source, size, source_size, target, epochs, taken, text_hash``. ``epochs`` whole
    passes over the source fit its budget (the target rounded down); in hash order the
    documents of the last pass are taken until the budget is used up, the one at the cut in
    part. The order depends on document id and text only, so reruns agree. Null or blank
    texts have size 0 and are taken with 0 words; a null source is a source of its own; null
    ids and repeated rows are counted like any others; an empty table gives an empty plan.
    """
    sizes = written(docs.select("doc_id", "source", group_key(F.col("source")).alias("_g"),
                                word_count(F.col("text")).alias("size"),
                                F.xxhash64("text").alias("text_hash"),
                                hash_key(seed).alias("_key")), "mix-sizes")
    targets = sized(written(source_targets(sizes, weights, max_epochs), "mix-targets"))
    ranked = prefix_sums(sizes, "_g", "_key", "size", ["doc_id", "size"], key_bits=60)
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = budget - F.col("epochs") * F.col("source_size")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("before")))
    return (ranked.join(targets, "_g").withColumn("epochs", epochs)
            .withColumn("taken", (F.col("epochs") * F.col("size") + part).cast("long"))
            .select("doc_id", "source", "size", "source_size", "target", "epochs", "taken", "text_hash"))


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The mixed corpus: every document as often as the plan takes it, with all columns of
    ``docs``; the document at a source's cut ends after its last taken word in its last
    copy. Documents without words are not part of a mix (they carry none of its words).
    """
    plan = mix_plan(docs, weights, max_epochs, seed)
    plan = written(plan.where("taken > 0").groupBy("doc_id", "text_hash").agg(
        F.max("size").alias("size"), F.count(F.lit(1)).alias("n"), F.sum("taken").alias("taken")), "mix-plan")
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"))
    one = rows.join(plan.where("n = 1"), F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash"))).select("_row", "size", "taken")
    # equal rows (repeated id and text) share a plan row: one of them, taken as often as all together, stands for all
    many = rows.join(sized(written(plan.where("n > 1"), "mix-repeated")), F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash")))
    many = many.dropDuplicates(["_id", "_hash"]).select("_row", "size", "taken")
    copies = F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))
    out = one.unionByName(many).withColumn("_copy", F.explode(copies))
    words = F.least(F.col("size"), F.col("taken") - (F.col("_copy") - 1) * F.col("size"))
    pieces = F.split(F.col("_row.text"), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")  # a word each, after its white space
    cut = F.array_join(F.slice(pieces, F.lit(1), words.cast("int")), "")
    text = F.when(words < F.col("size"), cut).otherwise(F.col("_row.text"))
    return out.select(*[(text if c == "text" else F.col("_row").getField(c)).alias(c) for c in docs.columns])
