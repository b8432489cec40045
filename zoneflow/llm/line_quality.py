"""Quality rules with cross-document line frequency: hash normalised lines, count the
distinct documents of a host that hold each, remove lines above the limits and reject
documents that the removal depletes. Base rules (length, repetition) judge each text alone."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import group_key, sized, slices, small_batches, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_LINE_DOCS = 10        # a line is never removed while at most so many documents of its host have it
MAX_LINE_SHARE = 0.1      # nor while at most this share of them has it
MAX_REMOVED_SHARE = 0.7   # a document that loses more of its words is depleted
SYMBOLS = r"[#*$%&|<>]"

STATS = ("rid long, doc_id {id}, g string, text_hash long, n_words long, word_chars long, n_symbols long, "
         "n_dup_lines long, n_repeat_words long, line_hash array<long>, line_words array<long>, line_at array<array<int>>")


def normal_line(line: str) -> str:
    """Lower case, digits as 0, white space as single blanks."""
    return re.sub(r"[0-9]+", "0", re.sub(r"[\x20\x09-\x0D]+", " ", line.lower()).strip(" "))


def line_hash(line: str) -> int:
    h = xxhash.xxh3_64_intdigest(normal_line(line).encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def _lines(text: str) -> tuple[int, list[int], list[int], list[list[int]]]:
    """Repeated lines, and for each distinct normalised line its hash, words and places (from 0)."""
    seen, dup, words, at = set(), 0, {}, {}
    for i, line in enumerate(text.split("\n")):
        n = len(line.encode("utf-8", "surrogatepass").split())  # bytes split at ASCII white space only
        if n:
            dup += line in seen
            seen.add(line)
            h = line_hash(line)
            words[h] = words.get(h, 0) + n
            at.setdefault(h, []).append(i)
    return dup, list(words), list(words.values()), list(at.values())


def word_stats(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: words, code points in words, words inside 3-word windows that the text has
    at least twice."""
    split = pc.ascii_split_whitespace(texts)
    words, offsets = split.flatten(), split.offsets.to_numpy()
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    length = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    full = length > 0
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)[full]
    doc, length = doc[full], length[full]
    n = len(texts)
    n_words, chars = np.bincount(doc, minlength=n), np.bincount(doc, weights=length, minlength=n).astype(np.int64)
    repeated = np.zeros(len(codes), dtype=bool)
    if len(codes) > 2:
        base = int(codes.max()) + 1
        pair = pd.factorize(codes[:-1] * base + codes[1:])[0].astype(np.int64)
        window = pd.factorize(pair[:-1] * base + codes[2:])[0].astype(np.int64)
        inside = doc[:-2] == doc[2:]
        key = pd.factorize(doc[:-2] * (int(window.max()) + 1) + window)[0]
        often = inside & (np.bincount(key, weights=inside)[key] >= 2)
        for k in range(3):
            repeated[k:len(codes) - 2 + k] |= often
    return n_words, chars, np.bincount(doc, weights=repeated, minlength=n).astype(np.int64)


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            texts = part.column("text").fill_null("").cast(pa.string())
            n_words, chars, repeat = word_stats(texts)
            symbols = pc.count_substring_regex(texts, SYMBOLS).cast(pa.int64())
            lines = [_lines(t) for t in texts.to_pylist()]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("rid"), part.column("doc_id"), part.column("g"), part.column("text_hash"), pa.array(n_words, pa.int64()),
                 pa.array(chars, pa.int64()), symbols, pa.array([x[0] for x in lines], pa.int64()), pa.array(repeat, pa.int64()),
                 pa.array([x[1] for x in lines], longs), pa.array([x[2] for x in lines], longs), pa.array([x[3] for x in lines], pa.list_(pa.list_(pa.int32())))],
                names=["rid", "doc_id", "g", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_hash", "line_words", "line_at"])


def judge(docs: DataFrame, host: str = "source", min_line_docs: int = MIN_LINE_DOCS, max_line_share: float = MAX_LINE_SHARE,
          max_removed_share: float = MAX_REMOVED_SHARE) -> DataFrame:
    """Verdict of every row of ``docs`` (``doc_id, text`` and the ``host`` column are read).

    Returns ``doc_id, host`` (its key), ``text_hash, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    removed_words, base_failed, kept``. A line is frequent in a host when more than
    ``min_line_docs`` and more than ``max_line_share`` of the host's distinct documents (rows
    with equal text are one document) hold it after normalising; a document is kept unless
    the base rules fail it or frequent lines hold over ``max_removed_share`` of its words.
    Null and blank texts have no words and fail the base rules; null hosts are one host; null
    ids and repeated rows are judged row by row. An empty table gives no rows.
    """
    return _judged(docs, host, min_line_docs, max_line_share, max_removed_share).drop("removed_lines")


def _judged(docs: DataFrame, host: str, min_line_docs: int, max_line_share: float, max_removed_share: float) -> DataFrame:
    """The columns of ``judge`` and ``removed_lines``, the places of the frequent lines (null: none)."""
    id_type = dict(docs.dtypes)["doc_id"]
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", group_key(F.col(host)).alias("g"),
                       F.xxhash64("text").alias("text_hash"), "text")
    with small_batches(docs.sparkSession, 1000):
        stats = written(rows.mapInArrow(_stats, STATS.format(id=id_type)), "line-stats")
    distinct = stats.select("g", "text_hash", "line_hash").dropDuplicates(["g", "text_hash"])
    docs_of = distinct.groupBy("g").agg(F.count(F.lit(1)).alias("n_docs"))
    held = distinct.select("g", F.explode("line_hash").alias("h")).groupBy("g", "h").agg(F.count(F.lit(1)).alias("n"))
    frequent = sized(written(held.where(F.col("n") > min_line_docs).join(docs_of, "g")
                             .where(F.col("n") > F.col("n_docs") * max_line_share).select("g", "h"), "line-frequent"))
    lines = stats.select("rid", "g", F.explode(F.arrays_zip("line_hash", "line_words", "line_at")).alias("l"))
    lines = lines.select("rid", "g", F.col("l.line_hash").alias("h"), F.col("l.line_words").alias("w"), F.col("l.line_at").alias("at"))
    removed = lines.join(frequent, ["g", "h"]).groupBy("rid").agg(F.sum("w").alias("removed_words"), F.flatten(F.collect_list("at")).alias("removed_lines"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = (stats.drop("line_hash", "line_words", "line_at").withColumnRenamed("g", "host").join(removed, "rid", "left")
           .withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long"))).withColumn("base_failed", base_failed)
           .withColumn("kept", ~F.col("base_failed") & ~(F.col("removed_words") > max_removed_share * F.col("n_words"))))
    return out.drop("rid")


def keep_good(docs: DataFrame, host: str = "source", min_line_docs: int = MIN_LINE_DOCS, max_line_share: float = MAX_LINE_SHARE,
              max_removed_share: float = MAX_REMOVED_SHARE) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, without their frequent lines: the other lines,
    blank ones too, stay as they are and in order, the other columns as they came. Rows are
    matched by id, host and text hash (equal rows are judged equally), against the smaller
    list of rows that go or lose lines. Rows travel as one struct, so their other columns may
    have any name. Null and blank texts go; an empty table gives no rows."""
    judged = _judged(docs.select("doc_id", "text", host), host, min_line_docs, max_line_share, max_removed_share)
    changed = judged.where(~F.col("kept") | F.col("removed_lines").isNotNull()).select(
        F.col("doc_id").alias("_d"), F.col("host").alias("_g"), F.col("text_hash").alias("_t"), F.col("kept").alias("_kept"), F.when(F.col("kept"), F.col("removed_lines")).alias("_lines"))
    changed = sized(written(changed.dropDuplicates(["_d", "_g", "_t"]), "line-changes"))
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), group_key(F.col(host)).alias("_host"), F.xxhash64("text").alias("_hash"))
    same = F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_host") == F.col("_g")) & (F.col("_hash") == F.col("_t"))
    whole = F.col("_row").getField("text")
    other = F.array_join(F.filter(F.split(whole, "\n"), lambda _, i: ~F.array_contains("_lines", i)), "\n")
    text = F.when(F.col("_lines").isNull(), whole).otherwise(other)
    kept = rows.join(changed, same, "left").where(F.coalesce("_kept", F.lit(True)))
    return kept.select(*[(text if c == "text" else F.col("_row").getField(c)).alias(c) for c in docs.columns])
