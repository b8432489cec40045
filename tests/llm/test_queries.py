"""The corpus queries and the pipeline on the given tables: held-out accuracy, and stages
against plain Python. (tests/test_oracle.py compares the queries that have SQL.)"""

import collections

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from zoneflow.llm import ngram_join
from zoneflow.llm.common import read
from zoneflow.llm.oracle import ORACLE
from zoneflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def table(name):
    return duckdb.connect().execute(f"SELECT * FROM read_parquet('{SF}/{name}.parquet')").fetch_df()


def test_registered():
    names = [f"op{n}_" for n in range(1, 14)]
    assert [sum(k.startswith(n) for k in QUERIES) for n in names] == [1] * 13
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE) <= set(QUERIES)


def test_quality_on_held_out_labels(spark):
    got = E.queries()["op7_quality"](spark, SF).toPandas().merge(table("labels"), on="doc_id")
    held = got[got.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() >= 0.95


def test_language_on_held_out_documents(spark):
    got = E.queries()["op8_language"](spark, SF).toPandas().merge(table("documents"), on="doc_id")
    held = got[got.held_out]
    assert len(held) > 100 and (held.lang_pred == held.lang).mean() >= 0.95


def test_toxicity_on_held_out_labels(spark):
    # few toxic documents in some languages here; README has the figures of larger tables
    got = E.queries()["op11_toxicity"](spark, SF).toPandas()
    assert len(got) == len(table("documents")) and got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()
    texts = table("documents").set_index("doc_id").text
    for r in got[got.predicted == 1].itertuples():
        assert all(texts[r.doc_id][s["start"]:s["end"]].strip() for s in r.spans)
    held = got.merge(table("labels"), on="doc_id")
    held = held[held.held_out]
    assert (held.predicted == held.toxic).mean() >= 0.9 and held.predicted[held.toxic == 0].mean() <= 0.02
    english = held[(held.toxic == 1) & held.doc_id.isin(table("documents").query("lang == 'en'").doc_id)]
    assert english.predicted.mean() >= 0.9


def test_extraction_matches_a_plain_reading(spark):
    import html
    import re
    got = E.queries()["op4_wrapper"](spark, SF).toPandas().merge(table("pages"), on=["page_id", "url"])
    for text, page in zip(got.text, got.html):
        inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert text == "\n".join(b for b in blocks if b)


def test_pipeline_stages(spark):
    docs = read(spark, SF, "documents")
    labels = table("labels").set_index("doc_id").quality
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:3]:
        before = [r["doc_id"] for r in docs.select("doc_id").collect()]
        classes = ngram_join.classes(docs).collect() if name == "n-gram Jaccard join" else None
        docs = corpus_pipeline.written(stage(spark, docs, SF), "test")
        after = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert docs.columns == columns and set(after) < set(before) and len(after) == len(set(after))
        if name == "quality classifier":
            gone = set(before) - set(after)
            known = labels[labels.index.isin(before)]
            assert ((known == 0) == known.index.isin(gone)).mean() >= 0.97
        if classes:
            assert set(after) == {r["component_id"] for r in classes}
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, SF)
    assert mixed.columns == columns
    packed = corpus_pipeline.STAGES[4][1](spark, corpus_pipeline.written(mixed, "test"), SF).toPandas()
    words = collections.Counter()
    for r in mixed.select("doc_id", "text").collect():
        words[r["doc_id"]] += len(r["text"].encode().split())
    assert packed.groupby("doc_id").n_tokens.sum().to_dict() == dict(words)


@pytest.mark.parametrize("name", ["op2_packing"])
def test_every_document_is_packed(spark, name):
    got = E.queries()[name](spark, SF).toPandas().groupby("doc_id").n_tokens.sum()
    want = table("documents").set_index("doc_id").text.map(lambda t: len(t.encode().split()))
    assert (got.sort_index() == want.sort_index()).all()
