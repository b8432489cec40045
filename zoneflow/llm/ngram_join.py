"""N-gram Jaccard join with a token-group matrix: similar documents form groups, a group
stores the union of its tokens, the overlap of a query with a union bounds its overlap with
every member, and only groups whose bound qualifies are opened.

A token is the 64-bit hash of a word shingle. Equal sets are one node. Every pair of linked
sets shares a token among the first ``prefix_length`` tokens of each under any common order
of the tokens; the order used here is by hash, with frequent tokens moved back. Short lists
of nodes that share such a token give candidate pairs, which an overlap bound thins out.
Long lists (shared passages, large groups of near copies) make families; a family is joined
by what sets its members apart from its core, and members that meet there go through the
group matrix (``_group_links``). No list is ever paired with itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.llm.common import release, sized, slices, small_batches, written
from zoneflow.llm.components import components

WORDS = 5
PERCENT = 80
LONG_LIST = 50          # nodes that share a token before the list goes through the matrix
LOW = 0.4               # share of the hash range from which frequent tokens are moved back
MAX_FREQUENT = 1 << 20  # frequent tokens broadcast (8 bytes each); the limit above rises until they fit
BLOCK_NODES = 256
BLOCK_TOKENS = 1 << 16
GROUP_NODES = 16
UNLIKE, LIKE = 100 - PERCENT, 100 + PERCENT  # sets of a and b tokens are linked iff LIKE * (tokens in one only) <= UNLIKE * (a + b)
LOW_LIMIT = int(LOW * 2 ** 64) - 2 ** 63
MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def prefix_length(n):
    """Linked sets share a token among so many first tokens of a set of ``n``."""
    return n - (PERCENT * n + 99) // 100 + 1


def linked(overlap, a, b):
    return 100 * overlap >= PERCENT * (a + b - overlap)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct tokens (as signed longs) of each text."""
    words = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]  # bytes: ASCII only, in both
    flat = [w for ws in words for w in ws]
    if not flat:
        return [np.zeros(0, np.int64) for _ in texts]
    codes, distinct = pd.factorize(np.array(flat, dtype=object))
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct], dtype=np.uint64)[codes]
    n = max(len(h) - WORDS + 1, 0)
    shingle = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WORDS):
            shingle = (shingle ^ (shingle >> np.uint64(31))) * MULTIPLY + h[k:k + n]
        shingle = (shingle ^ (shingle >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        shingle ^= shingle >> np.uint64(32)
    signed = (shingle ^ np.uint64(1 << 63)).view(np.int64)
    out, at = [], 0
    for ws in words:
        if len(ws) >= WORDS:
            out.append(np.unique(signed[at:at + len(ws) - WORDS + 1]))
        elif ws:
            out.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(ws)) - (1 << 63)], dtype=np.int64))
        else:
            out.append(np.zeros(0, np.int64))
        at += len(ws)
    return out


def _print(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64), pa.int64()))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", 1 << 21):
            sets = shingle_sets(part.column("text").to_pylist())
            low = [a[:max(int(np.searchsorted(a, LOW_LIMIT)), prefix_length(len(a)) if len(a) else 0)] for a in sets]
            yield pa.RecordBatch.from_arrays([part.column("nid"), part.column("doc_id"), part.column("text_hash"), pa.array([len(a) for a in sets], pa.int64()), pa.array([_print(a) for a in sets], pa.binary()), _lists(low)],
                                             names=["nid", "doc_id", "text_hash", "n", "print", "low"])


def _prefixes(frequent, every: bool = False):
    """``nid, n, cold, hot``: each node's prefix under the order of low tokens, low frequent
    tokens, other tokens. ``every``: all low tokens of the nodes that have frequent ones in their prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = frequent.value
        for b in batches:
            n = b.column("n").to_numpy()
            low = b.column("low")
            offsets, flat = low.offsets.to_numpy(), low.values.to_numpy(zero_copy_only=False)
            flat, offsets = flat[offsets[0]:offsets[-1]], offsets - offsets[0]
            common = often[np.minimum(np.searchsorted(often, flat), len(often) - 1)] == flat if len(often) else np.zeros(len(flat), bool)
            cold, hot, keep = [], [], []
            for i in range(len(n)):
                t, c = flat[offsets[i]:offsets[i + 1]], common[offsets[i]:offsets[i + 1]]
                p = prefix_length(int(n[i]))
                if every:
                    if c[:p].any():
                        keep.append(i)
                        cold.append(t[~c])
                        hot.append(t[:0])
                    continue
                if c.any():
                    rank = np.where(t >= LOW_LIMIT, 2, c.astype(int))
                    first = np.argsort(rank, kind="stable")[:p]
                    cold.append(t[first][~c[first]])
                    hot.append(t[first][c[first]])
                else:
                    cold.append(t[:p])
                    hot.append(t[:0])
                keep.append(i)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("nid").take(at), b.column("n").take(at), _lists(cold), _lists(hot)], names=["nid", "n", "cold", "hot"])
    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token: all pairs of each list of 2 to LONG_LIST nodes (``token``
    null), and one row a longer list (``token``). Memory is bounded by a batch."""
    def done(token: int, nodes: np.ndarray, longer: bool):
        if longer:
            big.append(token)
        elif len(nodes) > 1:
            nodes = np.sort(nodes)
            i, j = np.triu_indices(len(nodes), 1)
            xs.append(nodes[i])
            ys.append(nodes[j])

    def out() -> pa.RecordBatch:
        x, y = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (xs, ys))
        pad = [None] * len(big)
        batch = pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(x, pa.int64()), pa.array(pad, pa.int64())]), pa.concat_arrays([pa.array(y, pa.int64()), pa.array(pad, pa.int64())]),
                                            pa.concat_arrays([pa.nulls(len(x), pa.int64()), pa.array(big, pa.int64())])], names=["x", "y", "token"])
        xs.clear(), ys.clear(), big.clear()
        return batch
    xs, ys, big = [], [], []
    held, nodes, longer = None, np.zeros(0, np.int64), False
    for b in batches:
        t, v = b.column("token").to_numpy(), b.column("nid").to_numpy()
        if not len(t):
            continue
        start = np.concatenate([[0], np.flatnonzero(np.diff(t)) + 1, [len(t)]])
        first = 0
        if held is not None and t[0] == held:
            nodes, first = np.concatenate([nodes, v[:start[1]]]), 1
            longer |= len(nodes) > LONG_LIST
            nodes = nodes[:LONG_LIST + 1]
        if first < len(start) - 1:
            if held is not None:
                done(held, nodes, longer)
            size = np.diff(start)
            for k in np.flatnonzero(size[:-1] > 1):
                if k >= first:
                    done(int(t[start[k]]), v[start[k]:start[k + 1]], size[k] > LONG_LIST)
            held, nodes = int(t[start[-2]]), v[start[-2]:][:LONG_LIST + 1]
            longer = size[-1] > LONG_LIST
        yield out()
    if held is not None:
        done(held, nodes, longer)
        yield out()


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The linked ones of pairs that carry both sets."""
    for b in batches:
        keep = []
        for i in range(b.num_rows):
            a, c = (b.column(k)[i].values.to_numpy(zero_copy_only=False) for k in ("left", "right"))
            if linked(len(np.intersect1d(a, c, assume_unique=True)), len(a), len(c)):
                keep.append(i)
        yield pa.RecordBatch.from_arrays([b.column("x").take(pa.array(keep, pa.int64())), b.column("y").take(pa.array(keep, pa.int64()))], names=["x", "y"])


BLOCK = ["key", "nids", "roots", "slacks", "sizes", "tokens"]
BLOCK_SCHEMA = "key long, nids array<long>, roots array<long>, slacks array<long>, sizes array<long>, tokens array<long>"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of consecutive nodes that meet in one ``key``."""
    def block():
        nids, roots, slacks, sets = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), *(pa.array([v], pa.list_(pa.int64())) for v in (nids, roots, slacks)),
                                           pa.array([[len(s) for s in sets]], pa.list_(pa.int64())), _lists([np.concatenate(sets)])], names=BLOCK)
    held, total, now = [], 0, None
    for b in batches:
        columns = [b.column(c).to_pylist() for c in ("key", "nid", "root", "s")]
        for i, (key, nid, root, slack) in enumerate(zip(*columns)):
            tokens = b.column("apart")[i].values.to_numpy(zero_copy_only=False)
            if held and (key != now or len(held) >= BLOCK_NODES or total + len(tokens) > BLOCK_TOKENS):
                yield block()
                held, total = [], 0
            now = key
            held.append((nid, root, slack, tokens))
            total += len(tokens)
    if held:
        yield block()


def group_matrix_links(nids, roots, slacks, sets, other_nids, other_roots, other_slacks, other_sets) -> list[tuple[int, int]]:
    """Links between two blocks that join different components, one for each pair of
    components at least. ``sets`` hold the tokens in which the nodes are apart from their
    family's core; a pair is linked iff both slacks and 2 * LIKE times the tokens apart in both
    add up to 0 or more. The groups are runs of GROUP_NODES nodes of the second block; a query
    opens a group only if its overlap with the union of the group's tokens would do for the
    largest slack of the group."""
    size = np.array([len(s) for s in sets])
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    other_size = np.array([len(s) for s in other_sets])
    slacks, other_slacks = np.asarray(slacks), np.asarray(other_slacks)
    _, ids = np.unique(np.concatenate([*sets, *other_sets]), return_inverse=True)
    flat, others = ids[:size.sum()], np.split(ids[size.sum():], np.cumsum(other_size)[:-1])
    held = np.zeros(len(ids) + 1, dtype=np.int64)

    def overlaps(tokens: np.ndarray) -> np.ndarray:
        held[tokens] = 1
        out = np.add.reduceat(held[flat], start)  # no set is empty: its key is in it
        held[tokens] = 0
        return out
    joined: dict[int, int] = {}

    def find(r: int) -> int:
        while r in joined:
            r = joined[r]
        return r
    out = []
    for g in range(0, len(others), GROUP_NODES):
        members = range(g, min(g + GROUP_NODES, len(others)))
        bound = slacks + other_slacks[g:g + GROUP_NODES].max() + 2 * LIKE * overlaps(np.concatenate([others[m] for m in members]))
        qualify = bound >= 0
        for m in members if qualify.any() else ():
            for q in np.flatnonzero(qualify & (slacks + other_slacks[m] + 2 * LIKE * overlaps(others[m]) >= 0)).tolist():
                a, b = find(int(roots[q])), find(int(other_roots[m]))
                if a != b:
                    out.append((int(nids[q]), int(other_nids[m])))
                    joined[a] = b
    return out


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def parts(b, i, side):
        tokens, sizes = (b.column(f"{side}_{c}")[i].values.to_numpy(zero_copy_only=False) for c in ("tokens", "sizes"))
        return [b.column(f"{side}_{c}")[i].as_py() for c in ("nids", "roots", "slacks")] + [np.split(tokens, np.cumsum(sizes)[:-1])]
    for b in batches:
        found = [p for i in range(b.num_rows) for p in group_matrix_links(*parts(b, i, "a"), *parts(b, i, "b"))]
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["x", "y"])


def _full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``nid, tokens`` of the nodes in ``wanted`` (``nid, doc_id, print``), made anew from the texts."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 1 << 21):
                sets = shingle_sets(part.column("text").to_pylist())
                same = [i for i, (s, p) in enumerate(zip(sets, part.column("print").to_pylist())) if _print(s) == p]
                yield pa.RecordBatch.from_arrays([part.column("nid").take(pa.array(same, pa.int64())), _lists([sets[i] for i in same])], names=["nid", "tokens"])
    wanted = sized(written(wanted.select("nid", F.col("doc_id").alias("_d"), "print"), "jaccard-wanted"))
    rows = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("_d"))).select("nid", "print", "text")
    return written(rows.mapInArrow(run, "nid long, tokens array<long>").dropDuplicates(["nid"]), "jaccard-sets")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    with small_batches(pairs.sparkSession, 256):
        both = pairs.join(sets.select(F.col("nid").alias("x"), F.col("tokens").alias("left")), "x").join(sets.select(F.col("nid").alias("y"), F.col("tokens").alias("right")), "y")
        return written(both.select("x", "y", "left", "right").mapInArrow(_exact, "x long, y long"), "jaccard-links")


def _mixed(long_rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``token, nid, n_hot, root`` of the long lists whose nodes are not all in one component."""
    rows = long_rows.join(sized(roots).withColumnRenamed("node", "nid"), "nid", "left").withColumn("root", F.coalesce("root", "nid"))
    mixed = rows.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("token")
    return written(rows.join(sized(written(mixed, "jaccard-mixed")), "token"), "jaccard-long")


def _side(blocks: DataFrame, name: str) -> DataFrame:
    return blocks.select("key", *[F.col(c).alias(f"{name}_{c}") for c in BLOCK[1:]])


def _in_blocks(rows: DataFrame, apart: DataFrame, name: str) -> DataFrame:
    """Written blocks of ``rows`` (``key, lead, nid``) with what sets the nodes apart; those of one
    key and component stand together."""
    parts = max(1, rows.count() // (8 * BLOCK_NODES))
    ordered = rows.join(apart, ["lead", "nid"]).repartitionByRange(parts, "key", "root", "nid").sortWithinPartitions("key", "root", "nid")
    return written(ordered.select("key", "nid", "root", "s", "apart").mapInArrow(_blocks, BLOCK_SCHEMA), name)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by lead: the tokens that most members of a run (the rows of one lead in a
    batch) have apart, with the run's size."""
    for b in batches:
        lead, apart = b.column("lead").to_numpy(), b.column("apart")
        start = np.concatenate([[0], np.flatnonzero(np.diff(lead)) + 1, [len(lead)]]) if len(lead) else [0]
        leads, tokens, sizes = [], [], []
        for i, j in zip(start, start[1:]):
            run, count = np.unique(apart[i:j].flatten().to_numpy(zero_copy_only=False), return_counts=True)
            tokens.append(run[count * 2 > j - i])
            leads.append(np.full(len(tokens[-1]), lead[i]))
            sizes.append(np.full(len(tokens[-1]), j - i))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v) if v else [], pa.int64()) for v in (leads, tokens, sizes)], names=["lead", "token", "c"])


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens in just one of two sets, ``left`` and ``right`` (null: empty)."""
    for b in batches:
        out = []
        for i in range(b.num_rows):
            left, right = b.column("left")[i], b.column("right")[i]
            x = left.values.to_numpy(zero_copy_only=False)
            out.append(np.setxor1d(x, right.values.to_numpy(zero_copy_only=False), assume_unique=True) if right.is_valid else x)
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("lead", "nid", "root", "n")), _lists(out)], names=["lead", "nid", "root", "n", "apart"])


APART = "lead long, nid long, root long, n long, apart array<long>"


def _group_links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links that join the components inside the mixed lists ``rows`` of ``_mixed``.

    Lists with the same leader (the node with the most frequent tokens in its prefix) make a
    family. Links with the leader come first; a family all of whose components have one is
    done. In the others, sets are taken relative to the core, the tokens that most of them
    hold by a vote of runs of members (any core gives the same links): what is apart from the
    core is small, and two sets differ where just one of them is apart. With s = UNLIKE *
    size - LIKE * apart, a pair is linked iff s + s' + 2 * LIKE * (apart in both) >= 0. Pairs
    with s + s' >= 0 are all linked with the node of the largest s, so only nodes whose
    component has no link with it ask for others. Any other link shares apart tokens, so many
    that it shares one among the rarest of both sets; nodes that meet in such a token go
    through the group matrix. A token apart in one node, or in none that asks, is no meeting
    point, so a node with too few shared ones is done without meeting any other.
    """
    spark = rows.sparkSession
    lead = rows.groupBy("token").agg(F.max_by("nid", F.struct("n_hot", "nid")).alias("lead"))
    members = written(rows.join(sized(written(lead, "jaccard-leads")), "token").select("lead", "nid", "root").distinct(), "jaccard-members")
    leaders = sets.join(members.select(F.col("lead").alias("nid")).distinct(), "nid").select(F.col("nid").alias("lead"), F.col("tokens").alias("right"))
    with small_batches(spark, 256):
        both = members.join(sets.select("nid", F.col("tokens").alias("left")), "nid").join(sized(written(leaders, "jaccard-leaders")), "lead")
        first = written(both.select("lead", "nid", "root", F.size("left").cast("long").alias("n"), "left", "right").mapInArrow(_differences, APART), "jaccard-from-leader")
        ends = sized(written(first.where("nid = lead").select("lead", F.col("n").alias("lead_n")), "jaccard-ends"))
        close = (F.col("n") + F.col("lead_n")) * UNLIKE - F.size("apart") * LIKE >= 0
        near = written(first.join(ends, "lead").where(close).select("lead", "nid", "root"), "jaccard-near-leader")
        from_leader = near.where("nid != lead").select(F.col("lead").alias("x"), F.col("nid").alias("y"))
        joined = sized(written(near.select("lead", "root").distinct(), "jaccard-joined"))
        left = written(first.join(joined, ["lead", "root"], "left_anti").select("lead").distinct(), "jaccard-open-families")
        if left.isEmpty():
            return from_leader
        first = first.join(sized(left), "lead", "left_semi")
        parts = max(1, first.count() // (8 * BLOCK_NODES))
        ordered = first.repartitionByRange(parts, "lead", "nid").sortWithinPartitions("lead", "nid").select("lead", "apart")
        held = ordered.mapInArrow(_votes, "lead long, token long, c long").groupBy("lead", "token").agg(F.sum("c").alias("c"))
        most = sized(written(members.groupBy("lead").agg(F.count(F.lit(1)).alias("m")), "jaccard-families"))
        turned = held.join(most, "lead").where(F.col("c") * 2 > F.col("m")).groupBy("lead").agg(F.collect_list("token").alias("right"))
        both = first.withColumnRenamed("apart", "left").join(sized(written(turned, "jaccard-turned")), "lead", "left")
        apart = written(both.select("lead", "nid", "root", "n", "left", "right").mapInArrow(_differences, APART), "jaccard-from-core")
    apart = apart.select("lead", "nid", "root", "apart", (F.col("n") * UNLIKE - F.size("apart") * LIKE).alias("s"))
    best = apart.groupBy("lead").agg(F.max("s").alias("top"), F.max_by("nid", F.struct("s", "nid")).alias("centre"))
    placed = apart.join(sized(written(best, "jaccard-centres")), "lead").withColumn("minor", F.col("s") + F.col("top") < 0)
    stars = from_leader.unionByName(placed.where("not minor and nid != centre").select(F.col("centre").alias("x"), F.col("nid").alias("y")))
    settled = written(placed.where("not minor").select("lead", "root").distinct(), "jaccard-settled").withColumn("settled", F.lit(True))
    placed = placed.join(sized(settled), ["lead", "root"], "left").withColumn("alone", F.col("settled").isNull()).drop("settled", "minor")
    asking = written(placed.where("alone").select("lead").distinct(), "jaccard-asking-families")
    tokens = written(placed.join(sized(asking), "lead", "left_semi").select("lead", "nid", "root", "s", "top", "alone", F.explode("apart").alias("token")), "jaccard-apart-rows")
    shared = tokens.groupBy("lead", "token").agg(F.count(F.lit(1)).alias("c"), F.max("alone").alias("asked")).where("asked and c > 1").drop("asked")
    own = Window.partitionBy("lead", "nid")
    tokens = tokens.join(shared, ["lead", "token"]).withColumn("rank", F.row_number().over(own.orderBy("c", "token"))).withColumn("held", F.count(F.lit(1)).over(own))
    past = F.col("rank") - F.col("held") - 1  # to the first ``held - needed + 1`` tokens: past + needed <= 0
    asks = F.col("alone") & (past + F.ceil(-(F.col("s") + F.col("top")) / (2 * LIKE)) <= 0)
    stands = past + F.ceil((F.col("top") + 1 - F.col("s")) / (2 * LIKE)) <= 0
    tokens = written(tokens.where(asks | stands).select(F.xxhash64("lead", "token").alias("key"), "lead", "root", "nid", asks.alias("asks"), stands.alias("stands")), "jaccard-meeting")
    who = [F.bit_xor(F.xxhash64("nid", "asks", "stands", F.lit(i))).alias(f"who{i}") for i in (0, 1)]
    meet = tokens.groupBy("lead", "key").agg(F.max("asks").alias("a"), F.max("stands").alias("b"), F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("c"), *who)
    # one token of those in which the same nodes meet (long texts share thousands)
    meet = meet.where("a and b and lo < hi").groupBy("lead", "c", "who0", "who1").agg(F.min("key").alias("key")).select("key").distinct()
    tokens = written(tokens.join(sized(written(meet, "jaccard-keys-met")), "key"), "jaccard-met-rows")
    with small_batches(spark, 256):
        a = _in_blocks(tokens.where("asks").select("key", "lead", "nid"), apart, "jaccard-asking")
        b = _in_blocks(tokens.where("stands").select("key", "lead", "nid"), apart, "jaccard-standing")
    with small_batches(spark, 8):
        opened = written(_side(a, "a").join(_side(b, "b"), "key").mapInArrow(_open, "x long, y long"), "jaccard-opened")
    return stars.unionByName(opened)


def classes(docs: DataFrame) -> DataFrame:
    """The class of every row of ``docs`` (``doc_id, text``) under links of Jaccard similarity
    ``PERCENT`` % or more between sets of ``WORDS``-word shingles.

    Returns ``doc_id, n_shingles, component_id`` (smallest doc_id reachable by links, itself
    included), ``component`` (an opaque number of the class) and ``text_hash``. Shorter texts
    have one shingle of all their words; null and blank texts have none and are linked with
    nothing. Each row is a document: repeated rows are linked with each other, a null id is
    never a component_id unless all ids of the class are null. Other columns are ignored; an
    empty table gives no rows.

    Exact but for collisions of 64-bit shingle hashes: candidate generation and bounds never
    lose a linked pair of different sets unless other links already connect it.
    """
    with small_batches(docs.sparkSession, 1000):  # every Python step below runs in an eager job
        return _classes(docs)


def _classes(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    id_type = dict(docs.dtypes)["doc_id"]
    rows = docs.select(F.monotonically_increasing_id().alias("nid"), "doc_id", F.xxhash64("text").alias("text_hash"), "text")
    sketch = written(rows.mapInArrow(_sketches, f"nid long, doc_id {id_type}, text_hash long, n long, print binary, low array<long>"), "jaccard-sketches")
    copies = written(sketch.where("n > 0").groupBy("print").agg(F.min("nid").alias("rep"), F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"), "jaccard-copies")
    extra = written(sketch.where("n > 0").select("print", "nid").join(sized(copies), "print").where("nid != rep").select("nid"), "jaccard-extra")
    nodes = sketch.where("n > 0").join(sized(extra), "nid", "left_anti").select("nid", "n", "low")

    def counted(tokens: DataFrame) -> DataFrame:
        return written(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > LONG_LIST), "jaccard-frequent")

    def fetched(*tables: DataFrame):
        limit = LONG_LIST
        while sum(t.where(F.col("c") > limit).count() for t in tables) > MAX_FREQUENT:
            limit *= 2
        got = [r["token"] for t in tables for r in t.where(F.col("c") > limit).select("token").collect()]
        return spark.sparkContext.broadcast(np.unique(np.array(got, dtype=np.int64)))
    places = "nid long, n long, cold array<long>, hot array<long>"
    share = (F.col("n") - F.floor((F.col("n") * PERCENT + 99) / 100) + 1).cast("int")
    seen = counted(nodes.select(F.explode(F.slice("low", F.lit(1), share)).alias("token")))
    frequent = fetched(seen)
    if len(frequent.value):  # what moves up behind frequent tokens may be frequent as well
        more = counted(nodes.mapInArrow(_prefixes(frequent, every=True), places).select(F.explode("cold").alias("token")))
        frequent = fetched(seen, more)
    release(spark)
    prefixes = nodes.mapInArrow(_prefixes(frequent), places)

    tokens = prefixes.select("nid", F.explode("cold").alias("token")).repartition("token").sortWithinPartitions("token")
    with small_batches(spark, 10_000):
        met = written(tokens.select("token", "nid").mapInArrow(_pairs, "x long, y long, token long").groupBy("x", "y", "token").agg(F.count(F.lit(1)).alias("c")), "jaccard-met")
    late = written(met.where("token is not null").select("token"), "jaccard-late")
    release(spark)
    facts = prefixes.select("nid", "n", F.size("hot").alias("slack"), "cold")
    long_rows = prefixes.select("nid", F.explode("hot").alias("token"))
    if late.count():  # lists that turned out long only now
        late = sized(late)
        late_rows = written(prefixes.select("nid", F.explode("cold").alias("token")).join(late, "token").select("nid", "token"), "jaccard-late-rows")
        added = late_rows.groupBy("nid").agg(F.count(F.lit(1)).alias("_more"))
        facts = facts.drop("cold").join(added, "nid", "left").withColumn("slack", F.col("slack") + F.coalesce("_more", F.lit(0)))
        long_rows = long_rows.unionByName(late_rows)
    facts = sized(written(facts.select("nid", "n", "slack"), "jaccard-facts"))
    hot = facts.select("nid", F.col("slack").alias("n_hot"))
    long_rows = written(long_rows.select("token", "nid").join(hot, "nid"), "jaccard-long-rows")

    def fact(name: str) -> DataFrame:
        return facts.select(F.col("nid").alias(name), F.col("n").alias(f"n{name}"), F.col("slack").alias(f"s{name}"))
    # overlap <= shared prefix tokens (seen, or possibly in long lists) + what lies behind the prefixes
    n, m = F.col("nx"), F.col("ny")
    behind = F.greatest(F.ceil(n * PERCENT / 100), F.ceil(m * PERCENT / 100)) - 1
    needed = F.ceil((n + m) * PERCENT / (100 + PERCENT))
    near = met.where("token is null").select("x", "y", "c").join(fact("x"), "x").join(fact("y"), "y")
    near = near.where((F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT) & (F.col("c") + F.least("sx", "sy") + behind >= needed)).select("x", "y")
    leaders = long_rows.groupBy("token").agg(F.min("nid").alias("x"))
    stars = long_rows.groupBy("nid").agg(F.min("token").alias("token")).join(leaders, "token").where("nid != x").select("x", F.col("nid").alias("y"))
    pairs = written(near.unionByName(stars).distinct(), "jaccard-pairs")
    release(spark)

    wanted = pairs.select(F.col("x").alias("nid")).unionByName(pairs.select(F.col("y").alias("nid"))).unionByName(long_rows.select("nid")).distinct()
    sets = _full_sets(docs, sketch.select("nid", "doc_id", "print").join(sized(written(wanted, "jaccard-nodes")), "nid"))
    release(spark)
    links = _verified(pairs, sets)
    roots = written(components(links), "jaccard-roots")
    rows = _mixed(long_rows, roots)
    if not rows.isEmpty():
        roots = written(components(links.unionByName(_group_links(rows, sets))), "jaccard-roots")
    release(spark)
    copy = sized(copies)
    own = sketch.select("nid", "doc_id", "n", "text_hash", "print").join(copy, "print", "left").withColumn("rep", F.when(F.col("n") > 0, F.coalesce("rep", "nid")).otherwise(F.col("nid")))
    own = written(own.join(sized(roots.withColumnRenamed("node", "rep")), "rep", "left").select("doc_id", F.col("n").alias("n_shingles"), "text_hash", F.coalesce("first_id", "doc_id").alias("first_id"), "root", "rep"), "jaccard-rows")
    first = sized(written(own.where("root is not null").groupBy("root").agg(F.min("first_id").alias("class_id")), "jaccard-classes"))
    return own.join(first, "root", "left").select("doc_id", "n_shingles", F.coalesce("class_id", "first_id").alias("component_id"), F.coalesce("root", "rep").alias("component"), "text_hash")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stand for their class: the smallest
    (doc_id, nulls last; then text hash), once. Texts without words stay. Rows travel as one
    struct, so their columns may have any name; an empty table gives no rows."""
    rows = written(classes(docs), "jaccard-rows")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    first = rows.groupBy("component").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    many = rows.join(sized(written(first, "jaccard-first")), "component").select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"), (place == F.col("first")).alias("stays"))
    keys = written(many.groupBy("_d", "_t").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("n")), "jaccard-keys")
    packed = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"))
    same = F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_t"))
    gone = sized(written(keys.where("not stays").select("_d", "_t"), "jaccard-gone"))
    twice = written(keys.where("stays and n > 1").select("_d", "_t"), "jaccard-twice")
    kept = packed.join(gone, same, "left_anti")
    if twice.count():
        twice = sized(twice)
        one = packed.join(twice, same).dropDuplicates(["_d", "_t"]).select("_row", "_id", "_hash")
        kept = kept.join(twice, same, "left_anti").unionByName(one)
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
