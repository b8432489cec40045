"""Corpus operators on small tables: brute force, round trips, nulls, empty and long texts,
ties, repeated rows, empty tables and clashing columns."""

import collections
import glob
import gzip
import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from zoneflow.llm import html_extract, language_id, line_quality, mixing, ngram_join, packing, quality_model, topk_search, url_filter, warc
from zoneflow.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, rank string, _row string, n string"


def docs_of(spark, rows):
    """(doc_id, text, lang, source) rows with further columns whose names the operators use."""
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), 7, "x", "y", "z") for i, t, lang, s in rows], DOCS)


def prose(rng, n, vocabulary="alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()):
    return " ".join(rng.choice(vocabulary) + str(rng.randrange(50)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(1)
    long_text = prose(rng, 30_000)
    return docs_of(spark, [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, "one two", "en", "a"), (5, long_text, "en", "a"),
                           (None, "one two", "en", "b"), (7, "one two", None, "b"), (7, "one two", None, "b"), (8, prose(rng, 60), "en", None), (9, "\u3000\x1c é", "fr", "b")])


def one(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- top-k search -----------------------------------------------------------------------


def brute_topk(rows, k=5):
    v = [(i, np.floor(np.array(e, dtype=float) * 256).astype(np.int64)) for i, e in rows if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for q, x in v:
        if q is None or q % 50:
            continue
        found = sorted(((-int(x @ y), i is None, i or 0) for i, y in v if i != q and len(y) == len(x)))[:k]
        out += [(q, r, None if none else i, -s) for r, (s, none, i) in enumerate(found, 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_topk_is_exact(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, 8))
    rows = [(i, [float(x) for x in centres[i % 5] + rng.normal(size=8) * (0.1 if seed == 1 else 2.0)]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)]  # ties
    rows += [(2000, None), (2050, [None] * 8), (2100, [float("nan")] * 8), (2150, [float("inf")] + [0.0] * 7), (2200, [1.0, 2.0]), (2201, [1.0, 1.0]), (None, rows[3][1]), (2250, [])]
    df = spark.createDataFrame([(i, e, "x", 1) for i, e in rows], "vec_id long, embedding array<double>, rank string, score int")
    got = topk_search.search(df, df.where("vec_id % 50 = 0"), n_pivots=6, n_rings=3)
    assert one(got) == brute_topk(rows)


def test_topk_small_and_empty(spark):
    df = spark.createDataFrame([(0, [0.5, -0.25]), (1, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert one(topk_search.search(df, df.where("vec_id = 0"))) == [(0, 1, 1, 128 * 256 - 64 * 256)]
    assert one(topk_search.search(df.limit(0), df.limit(0))) == []
    big = spark.createDataFrame([(0, [1e300]), (1, [-1e300]), (50, [1e300])], "vec_id long, embedding array<double>")
    assert one(topk_search.search(big, big.where("vec_id % 50 = 0")))[0] == (0, 1, 50, 1 << 52)


def topk_rows(n, dim=8, seed=3):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(size=dim)]) for i in range(n)]


def test_topk_driver_gets_bounded_parts(spark, monkeypatch):
    """Nothing that grows with vectors, queries or tasks is ranked, sampled or broadcast through the driver."""
    rows = topk_rows(600)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(20)
    plans, write, collect = {}, topk_search.written, type(df).collect

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def noted(df, name):
        plans[name] = plan(df)
        return write(df, name)

    def collected(self):
        plans[f"collect {len(plans)}"] = plan(self)
        return collect(self)
    monkeypatch.setattr(topk_search, "written", noted)
    monkeypatch.setattr(type(df), "collect", collected)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        got = topk_search.search(df, df.where("vec_id % 50 = 0"), n_pivots=3, n_rings=2)
        plans["result"] = plan(got)
        got = [tuple(r) for r in collect(got)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(got, key=repr) == brute_topk(rows)
    assert not [k for k, p in plans.items() if "TakeOrderedAndProject" in p]
    tables = {k: p for k, p in plans.items() if "collect" not in k}
    assert not [k for k, p in tables.items() if "rangepartitioning" in p]
    assert {k for k, p in tables.items() if "BroadcastHashJoin" in p} == {"topk-blocks"}  # cuts and annuli


@pytest.mark.parametrize("parts", [1, 40])
def test_topk_sample_is_cut_before_it_is_sent(spark, parts):
    df = spark.range(20_000, numPartitions=parts).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 4 > 0, F.array(F.col("id").cast("double"))).alias("embedding"))
    assert 500 <= len(topk_search.sample_rows(df, 1, 500)) <= 4 * 500
    assert len(topk_search.sample_rows(df.where("vec_id < 300"), 1, 500)) == 225
    same = df.select(F.lit(1).cast("long").alias("vec_id"), F.array(F.lit(1.0)).alias("embedding"))
    assert 500 <= len(topk_search.sample_rows(same, 1, 500)) <= 4 * 500


def test_topk_queries_come_in_blocks(spark, monkeypatch):
    rows = topk_rows(700) + [(2000 + i, [1.0, float(i)]) for i in range(120)] + [(2000, [1.0, 0.0]), (None, [1.0, 7.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    sent, to_arrow = [], type(df).toArrow

    def noted(self):
        sent.append(to_arrow(self))
        return sent[-1]
    monkeypatch.setattr(type(df), "toArrow", noted)
    monkeypatch.setattr(topk_search, "BROADCAST_BYTES", 500)
    got = one(topk_search.search(df, df.where("vec_id % 50 = 0"), n_pivots=4, n_rings=2))
    assert got == brute_topk(rows)
    assert len(sent) > 2 and max(t.num_rows for t in sent) < 15  # of 18 queries


# --- packing ----------------------------------------------------------------------------


def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))


@pytest.mark.parametrize("seed", range(5))
def test_boundaries_are_optimal(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(1, 60), 8))
    counts = [rng.randrange(1, 30) for _ in lengths]
    for n in (1, 2, 3, 8, 20):
        best = min(padding(lengths, counts, [*c, lengths[-1]]) for k in range(min(n, 8)) for c in itertools.combinations(lengths[:-1], k))
        got = packing.best_boundaries(lengths, counts, n)
        assert len(got) <= n and padding(lengths, counts, got) == best
    assert packing.best_boundaries([], [], 4) == []


def test_pack_keeps_every_token(spark, odd):
    rows = packing.pack(odd, context=100, n_buckets=3, batch_tokens=400).collect()
    per = collections.Counter()
    for r in rows:
        per[r["doc_id"]] += r["n_tokens"]
    assert per == collections.Counter({1: 0, 2: 0, 3: 0, 4: 2, 5: 30_000, None: 2, 7: 4, 8: 60, 9: 2})
    full = [r for r in rows if r["n_tokens"]]
    assert all(r["bucket_len"] - r["n_tokens"] == r["padding"] >= 0 for r in full)
    assert all(r["bucket_len"] is None and r["batch"] is None for r in rows if not r["n_tokens"])
    places = collections.Counter((r["bucket_len"], r["batch"], r["slot"]) for r in full)
    assert set(places.values()) == {1}
    for b in {r["bucket_len"] for r in full}:
        per_batch, n = max(1, 400 // b), sum(r["bucket_len"] == b for r in full)
        assert {(r["batch"], r["slot"]) for r in full if r["bucket_len"] == b} == {divmod(i, per_batch) for i in range(n)}
    assert packing.pack(odd.limit(0)).collect() == [] and packing.pack(odd.where("doc_id = 2")).count() == 1


# --- URL filters ------------------------------------------------------------------------

URLS = [None, "", "no scheme", "http://", "http://EXAMPLE.com/en/x", "http://www.example.com/en/", "http://www.example.com/EN/", "https://a.b.net/es/1?x=/fr/#y", "http://net/fr/", "http://net/fr",
        "http://notexample.com/en/", "http://x.org?u=http://example.com/en/", "http://x.org/casino/a", "http://casinos.org/", "http://adult-x.example.com/en/", "ftp://my.com/", "http://x.com#a/b", "x://y://example.com/en/",
        "http://a.net/es/casino", "http://\u00e9.net/es/ü"]


def brute_url(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:] if rest[cut:cut + 1] == "/" else ""
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fit = [r for r in rules if r.host and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: (len(r.name), r.name), default=None)
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in (url or "").lower()).split()
    hit = [r for r in rules if r.pattern and r.pattern.strip("^") in words]
    pattern = max(hit, key=lambda r: (len(r.name), r.name), default=None) if best is None else None
    return host, path, best and best.name, pattern and pattern.name, (best or pattern).verdict if best or pattern else "allow"


def test_url_rules(spark):
    rules = [*url_filter.DEFAULT_RULES, url_filter.Rule("block", "my.com"), url_filter.Rule("allow", "com", "/")]
    rows = [(i, u) for i, u in enumerate(URLS)] + [(3, URLS[4]), (3, URLS[4]), (None, URLS[5])]
    df = spark.createDataFrame([(i, u, "h", "p") for i, u in rows], "page_id long, url string, host string, token string")
    got = one(url_filter.filter_urls(df, rules))
    rules = [r for r in rules if r.host != "my.com"] + [r for r in rules if r.host == "my.com"]
    assert got == sorted(((i, u, *brute_url(u, rules)) for i, u in rows), key=repr)
    assert one(url_filter.filter_urls(df.limit(0))) == []
    assert {r["verdict"] for r in url_filter.filter_urls(df, [], "block").collect()} == {"block"}


def test_url_tokens_are_bounded():
    assert url_filter.Rule("block", "a.b", "/cd/ef").tokens == ["a", "b", "cd"]
    assert url_filter.Rule("block", pattern="^ads*x^").tokens == []
    assert url_filter.Rule("block", pattern="ads").tokens == []


# --- HTML extraction --------------------------------------------------------------------


def test_html_blocks():
    page = """<html><head><title>x</title><style>p{}</style></head><body><header>Site</header><nav><ul><li>menu</ul></nav>
      <div class="wrap sidebar-page"><article><header><h1>T &amp; U</h1><span>by me</span></header><p>one <b>two</b><br>
      three<p>four &#x41;&eacute;<aside>rel</aside><ul><li>a<li>b</ul><form><p>f</form><div class="comments"><article><p>c</article></div>
      <script>var t="</p><p>no</p>";</script><!-- <p>no --></article></div><div id="cookie-notice">n</div><footer>foo"""
    assert [t for _, t in html_extract.analyse(page)[2]] == ["T & U", "one two three", "four Aé", "a", "b"]
    assert [t for _, t in html_extract.analyse("<main><p>x</main><p>y")[2]] == ["x"]
    for bad in ("", "<", "<!-- x", "<a href='<b", "<p" * 50, "</p></p>", "<div>" * 5000 + "z"):
        html_extract.analyse(bad)
    assert [t for _, t in html_extract.analyse("<div>" * 5000 + "z")[2]] == ["z"]


def test_tree_matching():
    a = html_extract.tree_of('[["r",2],["x",1],["y",0],["z",0]]')
    b = html_extract.tree_of('[["r",3],["x",0],["x",1],["y",0],["z",0]]')
    assert html_extract.align(a, b) == {0: 0, 1: 2, 2: 3, 3: 4}
    assert html_extract.align(a, html_extract.tree_of('[["q",0]]')) == {}


def test_wrapper_drops_constant_slots(spark):
    rows = [(i, f"http://h.org/{i}", f"<body><div class=top>Welcome to H</div><div class=txt><p>Story {i}<p>More {i}</div><div class=end>All rights</div>") for i in range(8)]
    rows += [(100 + i, f"http://same.org/{i}", f"<article><p>Equal text</article><nav>{i}</nav>") for i in range(8)]
    rows += [(200, None, None), (201, "http://h.org/z", ""), (202, None, "<p> </p>"), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, host int")
    got = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in html_extract.extract(df).collect()}
    assert html_extract.extract(df).count() == len(rows)
    assert got[(3, "http://h.org/3")] == ("Story 3\nMore 3", 14)
    assert got[(103, "http://same.org/3")] == ("Equal text", 10)
    assert got[(200, None)] == got[(201, "http://h.org/z")] == got[(202, None)] == ("", 0)
    assert one(html_extract.extract(df.limit(0))) == []


# --- archives ---------------------------------------------------------------------------


def test_wrapper_drops_constant_siblings(spark):
    def page(host, i, body):
        return (100 * len(host) + i, f"http://{host}/{i}", f"<html><body>{body}</body></html>")

    def story(i, k):
        return "".join(f"<p>story {i} part {j}</p>" for j in range(k))

    rows = [page("a.org", i, f"<article>{story(i, 1 + i % 3)}<p>All rights reserved</p></article>") for i in range(20)]
    rows += [page("bb.org", i, f"<div>Menu</div><div>tale {i}</div><div>{'Rights' if i else 'Other'}</div>") for i in range(20)]
    rows += [page("ccc.org", i, f"<article>{story(i, 2)}{'<p>Part time</p>' * (i < 15)}</article>") for i in range(20)]
    rows += [page("dddd.org", i, f"<article>{story(i, 2)}<p>Few pages</p></article>") for i in range(4)]
    got = {r["url"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(20):
        assert got[f"http://a.org/{i}"] == "\n".join(f"story {i} part {j}" for j in range(1 + i % 3))
        assert got[f"http://bb.org/{i}"] == f"tale {i}" + "\nOther" * (i == 0)
        assert got[f"http://ccc.org/{i}"].endswith("Part time") == (i < 15)
    assert all(got[f"http://dddd.org/{i}"].endswith("Few pages") for i in range(4))


def test_arc_versions():
    v1 = b"filedesc://x 0.0.0.0 20200101000000 text/plain 75\n" + b"1 0 org\nURL IP-address Archive-date Content-type Archive-length\n".ljust(75, b"\n")
    v1 += b"\nhttp://a/ b 1.2.3.4 20200102030405 text/html 5\nab\ncd\n"
    v2 = b"filedesc://x 0.0.0.0 20200101000000 text/plain 200 - - 0 x 8\n2 0 org\n\nhttp://c 1.2.3.4 2021 text/html 200 CK - 77 f 3\nxyz\nhttp://d 1.2.3.4 20210101 text/html 200 CK - 77 f 9\nxyz"
    got = list(warc.parse_arc(v1 + b"\n" + v2))
    assert [(r["url"], r["content"], r["truncated"]) for r in got] == [("http://a/ b", b"ab\ncd", False), ("http://c", b"xyz", False), ("http://d", b"xyz", True)]
    assert [warc.warc_date(r["date"]) for r in got] == ["2020-01-02T03:04:05Z", "2021-01-01T00:00:00Z", "2021-01-01T00:00:00Z"]
    with pytest.raises(ValueError):
        list(warc.parse_arc(b"http://a 1.2.3.4 2020 text/html x\n"))


def test_archive_round_trip(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i % 3}\r\n\r\nWARC/1.0 é</p>") for i in range(9)] + [(20, None, None), (21, "http://a b", ""), (None, "u", "<p>0\r\n\r\nWARC/1.0 é</p>"), (5, "again", "<p>2\r\n\r\nWARC/1.0 é</p>")]
    rows.append((30, "long", "x" * 10_000_000))
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, payload string")
    got = warc.archive_pages(df).collect()
    body = [(i, (h or "").encode()) for i, _, h in rows]
    assert sorted((repr(r["page_id"]), r["payload_bytes"], r["payload_digest"]) for r in got) == sorted((repr(i), len(b), warc.sha1_base32(b)) for i, b in body)
    first = {}
    for i, b in body:
        if i is not None:
            first[b] = min(i, first.get(b, i))
    kinds = collections.Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got)
    seen, want = set(), collections.Counter()
    for i, b in sorted(body, key=lambda x: (x[0] is None, x[0] or 0)):
        want[(i, "response", None) if b not in seen else (i, "revisit", first[b])] += 1
        seen.add(b)
    assert kinds == want
    assert one(warc.archive_pages(df.limit(0))) == []
    assert warc.sha1_base32(b"a") == __import__("base64").b32encode(hashlib.sha1(b"a").digest()).decode()


def test_archives_are_compressed_at_the_fastest_level(spark, scratch):
    rng = random.Random(3)
    rows = [(i, f"http://h/{i}", prose(rng, 300)) for i in range(200)]
    warc.write_arc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), scratch + "/arc")
    files = [open(f, "rb").read() for f in glob.glob(scratch + "/arc/part-*")]
    raw = [gzip.decompress(f) for f in files]
    assert sum(r["content"].endswith(rows[int(r["url"].rsplit("/", 1)[1])][2].encode()) for x in raw for r in warc.parse_arc(x)) == 200
    assert sum(map(len, files)) > 1.05 * sum(len(gzip.compress(x, 6)) for x in raw)


# --- mixing -----------------------------------------------------------------------------


def test_mix_targets_by_repeated_sharing(spark):
    sizes = {"a": 10, "b": 1000, "c": 0, "d": 50, None: 300}
    df = spark.createDataFrame([(k, "n" if k is None else "v" + k, s) for k, s in sizes.items()], "source string, _g string, size long")
    got = {r["_g"]: r["target"] for r in mixing.source_targets(df).collect()}
    weights = dict(zip(["va", "vb", "vc", "vd", "n"], [5, 2, 1, 5, 2]))
    caps = {("n" if k is None else "v" + k): 3 * s for k, s in sizes.items()}
    total, stopped, want = sum(sizes.values()), set(), {}
    while True:
        rest = total - sum(caps[k] for k in stopped)
        open_ = [k for k in caps if k not in stopped]
        want = {k: caps[k] if k in stopped else rest * weights[k] / sum(weights[o] for o in open_) for k in caps}
        over = {k for k in open_ if want[k] > caps[k]}
        if not over:
            break
        stopped |= over
    assert got == pytest.approx(want)


def test_mix_takes_exact_budgets(spark, odd):
    rng = random.Random(3)
    df = odd.unionByName(docs_of(spark, [(100 + i, prose(rng, rng.randrange(1, 80)), "en", f"s{i % 4}") for i in range(300)]))
    plan = mixing.mix_plan(df).collect()
    assert len(plan) == df.count()
    per = collections.defaultdict(int)
    for r in plan:
        assert 0 <= r["taken"] <= 3 * r["size"]
        per[(r["source"], int(r["target"]))] += r["taken"]
    assert all(taken == target for (_, target), taken in per.items())
    assert one(mixing.mix_plan(df)) == one(mixing.mix_plan(df.repartition(5)))
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    words = collections.Counter()
    for r in mixed.collect():
        words[r["source"]] += len(r["text"].encode().split())
    assert {k: v for k, v in words.items()} == {k: v for (k, _), v in per.items() if v}
    assert mixing.mix_plan(df.limit(0)).count() == mixing.mix(df.limit(0)).count() == 0


# --- quality classifier -----------------------------------------------------------------


def test_rules_learn_a_conjunction():
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(3000, len(quality_model.STATISTICS)))
    y = ((x[:, 2] > 0.4) & (x[:, 5] <= 0.7)).astype(int)
    m = quality_model.fit_rules(x, y)
    z = m.intercept + sum(w * np.logical_and.reduce([(x[:, quality_model.STATISTICS.index(n)] > c) if a else (x[:, quality_model.STATISTICS.index(n)] <= c) for n, a, c in r]) for r, w in m.rules)
    assert ((z >= 0) == y).mean() > 0.98 and len(m.rules) < 60
    assert m == quality_model.fit_rules(x, y)


def test_statistics_names():
    assert tuple(quality_model.statistics(F.lit("")).keys()) == quality_model.STATISTICS


def test_quality_edges(spark, odd):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    m = quality_model.fit(odd, empty)
    got = quality_model.score(odd, m).collect()
    assert len(got) == odd.count() and all(r["score"] == 0.5 and r["predicted"] == 1 for r in got)
    one_class = spark.createDataFrame([(4, 0, 0), (5, 0, 0), (None, 1, 0), (8, None, 0), (99, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    m = quality_model.fit(odd, one_class)
    assert all(0 <= r["score"] <= 1 for r in quality_model.score(odd, m).collect())
    assert quality_model.keep_good(odd, m).columns == odd.columns
    assert quality_model.score(odd.limit(0), m).count() == 0


# --- language identification ------------------------------------------------------------


def brute_posteriors(scores, transitions):
    n, k = scores.shape
    total = collections.defaultdict(float)
    p = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        s = sum(scores[i, y] for i, y in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:]))
        total[0] += np.exp(s)
        for i, y in enumerate(path):
            p[i, y] += np.exp(s)
    return p / total[0]


def test_forward_backward(monkeypatch):
    rng = np.random.default_rng(0)
    monkeypatch.setattr(language_id, "BLOCK", 3)
    lengths = np.array([1, 7, 3, 4, 8])
    scores, transitions = rng.normal(size=(lengths.sum(), 3)), rng.normal(size=(3, 3))
    got = language_id.posteriors(scores, lengths, transitions)
    want = np.concatenate([brute_posteriors(s, transitions) for s in np.split(scores, np.cumsum(lengths)[:-1])])
    assert np.allclose(got, want)
    monkeypatch.setattr(language_id, "BLOCK", 64)
    assert np.allclose(got, language_id.posteriors(scores, lengths, transitions))


def test_code_switched_words():
    rng = random.Random(0)
    texts = [([rng.choice(["thing", "the", "other", "wash"]) + rng.choice(["", "ing"]) for _ in range(20)], "en") for _ in range(40)]
    texts += [([rng.choice(["über", "schön", "und", "keit"]) + rng.choice(["", "ung"]) for _ in range(20)], "de") for _ in range(40)]
    m = language_id.fit_crf(texts)
    p = language_id.label_words(m, ["the other thing washing schönung und keitung über the wash".split()])[0]
    assert [m.languages[i] for i in p.argmax(axis=1)] == ["en"] * 4 + ["de"] * 4 + ["en"] * 2
    assert m.transitions[0, 0] > m.transitions[0, 1] and m.transitions[1, 1] > m.transitions[1, 0]


def test_language_edges(spark, odd):
    m = language_id.fit(odd)
    got = [(r["doc_id"], r["lang_pred"]) for r in language_id.predict(odd, m).collect()]
    assert len(got) == odd.count() and {g for i, g in got if i in (1, 2, 3)} == {"und"}
    assert {g for i, g in got if i in (4, 5, 9)} <= {"en", "fr"}
    none = language_id.fit(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in language_id.predict(odd, none).collect()} == {"und"}
    assert language_id.predict(odd.limit(0), m).count() == 0


def test_language_sample_covers_whole_texts(spark):
    """Letterless heads and words far into a text: segments come from everywhere, and rows that
    cannot teach (held out, null, without a letter) take no place in the sample."""
    head = "12 34 !! " * 600
    late = [(i, head + " ".join(f"wort{'abcdefgh'[j % 8]}" for j in range(400)) + " ende", "de", "a") for i in range(40)]
    junk = [(100 + i, "1 2 3", "de", "a") for i in range(3000)] + [(5000, None, "de", "a"), (5001, "text", None, "a")]
    docs = docs_of(spark, late + junk + [(6000 + i, "the words here", "en", "a") for i in range(10)]).withColumn("_share", F.lit(1)).withColumn("_key", F.lit("k"))
    usable = docs.where(~language_id.is_held_out(F.col("doc_id")) & F.rlike("text", F.lit("[a-z]")) & F.col("lang").isNotNull())
    got = language_id.training_texts(docs, 600, 10)
    assert len(got) == usable.count()
    places = [w for w, lang in got if lang == "de"]
    assert all(len(w) <= 10 * language_id.SEGMENT for w in places) and len({tuple(w) for w in places}) > 1
    assert any("ende" in w for w in places)
    few = language_id.training_texts(docs, 5, 10)
    assert sorted(lang for _, lang in few) == ["de"] * 5 + ["en"] * 5
    assert {lang for _, lang in language_id.training_texts(docs, 600, 10, languages=1)} == {"de"}
    assert len(language_id.training_texts(docs, 600, 10, cells=12)) == 6
    long = [" ".join(f"w{'abcdefghij'[i // 100]}{'abcdefghij'[i // 10 % 10]}{'abcdefghij'[i % 10]}" for i in range(1000))]
    words = language_id.training_texts(docs_of(spark, [(1, long[0], "en", "a"), (2, long[0], "en", "a"), (3, long[0], "en", "a")]), 9, 24)[0][0]
    at = [long[0].split().index(w) for w in words]
    assert at == sorted(at) and max(b - a for a, b in zip(at, at[1:])) < 150 and at[0] < 150 and at[-1] > 850


# --- near duplicates --------------------------------------------------------------------


def brute_classes(rows):
    sets = [set(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else {tuple(w)} if w else set() for w in ((t or "").encode().lower().split() for _, t in rows)]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        k = len(sets[i] & sets[j])
        if k and 100 * k >= 80 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return sorted(((d, len(sets[i]), low.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def near_rows(seed, families=6, members=14, passages=3):
    """Families of edited copies around the threshold, texts that share passages, short texts."""
    rng = random.Random(seed)
    shared = [prose(rng, 30) for _ in range(passages)]
    texts = []
    for _ in range(families):
        base = prose(rng, rng.randrange(20, 90)).split()
        for _ in range(members):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = prose(rng, 1)
            texts.append(" ".join(w))
    texts += [f"{prose(rng, rng.randrange(1, 25))}\n{rng.choice(shared)}" for _ in range(60)]
    texts += [prose(rng, rng.randrange(0, 7)) for _ in range(20)] + ["a b", "A  b", "a b", "", None, "É b", "é b"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed, long_list", [(1, 50), (2, 4), (3, 2)])
def test_near_duplicates_match_brute_force(spark, monkeypatch, seed, long_list):
    monkeypatch.setattr(ngram_join, "LONG_LIST", long_list)
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", 8)
    monkeypatch.setattr(ngram_join, "GROUP_NODES", 3)
    rows = near_rows(seed)
    df = docs_of(spark, [(i, t, None, None) for i, t in rows])
    assert one(ngram_join.classes(df).select("doc_id", "n_shingles", "component_id")) == brute_classes(rows)


def test_core_by_vote_has_few_rows():
    """A family's core is found from the tokens that most members of a run have apart, not from a row for every token of every member."""
    apart = [np.array([1, 2, 3, 100 + i]) for i in range(60)] + [np.array([7, 200 + i % 2]) for i in range(5)]
    batch = pa.RecordBatch.from_arrays([pa.array([4] * 60 + [9] * 5, pa.int64()), ngram_join._lists(apart)], names=["lead", "apart"])
    got = [tuple(r.values()) for b in ngram_join._votes(iter([batch, batch.slice(0, 0), batch.slice(58, 4)])) for r in b.to_pylist()]
    assert got == [(4, 1, 60), (4, 2, 60), (4, 3, 60), (9, 7, 5), (9, 200, 5), (4, 1, 2), (4, 2, 2), (4, 3, 2), (9, 7, 2)]


def test_near_duplicate_edges(spark, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert one(ngram_join.classes(odd).select("doc_id", "n_shingles", "component_id")) == brute_classes(rows)
    assert ngram_join.classes(odd.limit(0)).count() == 0
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == sorted(map(repr, [1, 2, 3, 4, 5, 8, 9]))


def test_keep_one_of_every_class(spark):
    rows = near_rows(5) + [(3, "a b"), (3, "a b")]
    df = docs_of(spark, [(i, t, None, None) for i, t in rows])
    classes = ngram_join.classes(df).collect()
    kept = [r["doc_id"] for r in ngram_join.keep_one(df).collect()]
    assert len(kept) == len({r["component"] for r in classes})


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (200, 200)]
    random.Random(0).shuffle(links)
    got = dict(one(components(spark.createDataFrame(links, "x long, y long"))))
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


# --- quality rules ----------------------------------------------------------------------


def test_line_rules(spark, odd):
    rng = random.Random(4)
    footer = "Subscribe to our 12 letters and read more of this every day"
    rows = [(i, prose(rng, 60) + "\n" + footer.replace("12", str(i)), "en", "h") for i in range(30)]
    rows += [(100 + i, "\n".join([footer] * 12) + f"\nx{i}", "en", "h") for i in range(2)]
    rows += [(200 + i, prose(rng, 60) + "\n" + footer, "en", f"h{i}") for i in range(5)]
    df = odd.unionByName(docs_of(spark, rows))
    got = {r["doc_id"]: r for r in line_quality.judge(df).collect()}
    assert line_quality.judge(df).count() == df.count()
    assert all(got[i]["kept"] and got[i]["removed_words"] == 12 for i in range(10, 30))
    assert not got[100]["kept"] and got[100]["removed_words"] == 144 and got[100]["n_dup_lines"] == 11
    assert all(got[200 + i]["kept"] and got[200 + i]["removed_words"] == 0 for i in range(5))
    assert got[1]["n_words"] == got[2]["n_words"] == got[3]["n_words"] == 0 and got[1]["base_failed"]
    assert got[9]["n_words"] == 2 and got[9]["word_chars"] == 3
    assert line_quality.judge(df.limit(0)).count() == 0
    kept = line_quality.keep_good(df)
    assert kept.columns == df.columns and kept.count() == sum(r["kept"] for r in line_quality.judge(df).collect())


def test_line_rules_keep_groups_of_copies(spark):
    text = prose(random.Random(5), 80)
    df = docs_of(spark, [(i, text, "en", "h") for i in range(40)])
    assert line_quality.keep_good(df).count() == 40


def test_frequent_lines_leave_the_text(spark, odd):
    rng = random.Random(6)
    often, rows = ["Read More 7", "All rights reserved", "\u00c9t\u00e9 9 fois"], []
    for i in range(60):
        lines = [prose(rng, 20) for _ in range(4)] + rng.choices(often, k=i % 4) + [rng.choice(["", " \t", "Once \r"])] + ["rare one"] * (i < 3)
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines) + "\n" * (i % 2), "en", [None, "h"][i % 2]))
    rows += [rows[1], rows[1], (None, rows[2][1], "en", None), (500, rows[2][1], "en", "lone")]
    df = odd.unionByName(docs_of(spark, rows))
    table = df.collect()
    texts = collections.defaultdict(set)
    for r in table:
        texts[r["source"]].add(r["text"] or "")
    held = {s: collections.Counter(h for t in ts for h in {line_quality.line_hash(x) for x in t.split("\n") if x.split()}) for s, ts in texts.items()}
    assert len({h for c in held.values() for h in c if c[h] > 10}) >= 3

    def brute(r):
        return "\n".join(x for x in r["text"].split("\n") if not x.split() or held[r["source"]][line_quality.line_hash(x)] <= 10)

    kept = {(r["doc_id"], r["host"]) for r in line_quality.judge(df).collect() if r["kept"]}
    want = [r.asDict() | {"text": brute(r)} for r in table if (r["doc_id"], "n" if r["source"] is None else "v" + r["source"]) in kept]
    got = line_quality.keep_good(df)
    assert got.columns == df.columns and sum(w["text"] not in {r["text"] for r in table} for w in want) > 30
    assert sorted((repr(r.asDict()) for r in got.collect())) == sorted(map(repr, want))


def test_markup_counts_at_any_depth():
    def texts(page):
        return [t for _, t in html_extract.analyse(page)[2]]
    deep = "<div>" * 300
    assert texts(deep + "<nav>menu</nav><p>z</p><form>ask</form><div class='comments'>me too</div>") == ["z"]
    assert texts("<p>out</p>" + deep + "<article><p>in</p><footer>end</footer></article>") == ["in"]
    assert texts("<article class='social-science'><p>x</p></article>") == ["x"]
    assert texts("<article><p>a</p></article><article class='comment-body'><p>no</p></article>") == ["a"]
    assert len(texts("<body>" + "<div>x " * 20_000)) == 20_000
    assert len(texts("<li><ul>" + "<div>" * 20_000 + "<li>y" * 20_000)) == 20_000


CLASHING = ["_row", "_rid", "_id", "_hash", "_host", "_d", "_g", "_t", "_kept", "_lines", "quality", "n_words", "kept", "stays", "n", "component", "x", "label", "text_hash"]


def test_helpers_that_keep_rows_take_any_column_name(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, 60) if i % 5 else prose(random.Random(1), 80), "en", "h") for i in range(30)]
    df = docs_of(spark, rows + [rows[0], (None, None, None, None), (77, "", "en", None)])
    wide = df.select("*", *[F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in CLASHING if c not in df.columns])
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    model = quality_model.fit(df, labels)
    assert quality_model.fit(wide, labels) == model
    for keep in (lambda d: quality_model.keep_good(d, model), line_quality.keep_good, ngram_join.keep_one):
        got, want = keep(wide), keep(df)
        assert got.columns == wide.columns
        assert sorted(map(repr, got.select(df.columns).collect())) == sorted(map(repr, want.collect()))
        assert all(r["_kept"] == f"_kept{'-' if r['doc_id'] is None else r['doc_id']}" for r in got.collect())
        assert keep(wide.limit(0)).count() == 0
