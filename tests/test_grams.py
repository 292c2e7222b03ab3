"""Words and pairs of words with dense ids, and the sparse vectors made of them."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tenderlake.context import write_table
from tenderlake.operators import text as T

DOCS = {1: "Red fish blue fish", 2: "red FISH, one fish", 3: "a b c", 4: "", 5: "blue_2 red fish red fish", 6: None}


def grams(text):
    import re
    words = re.findall(r"\w{2,}", (text or "").lower())
    return Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame(list(DOCS.items()), "doc_id long, text string")


def test_terms_and_vocabulary(spark, docs):
    terms = T.gram_terms(docs)
    assert {(r.doc_id, r.gram): r.tf for r in terms.collect()} == {
        (i, g): n for i, t in DOCS.items() for g, n in grams(t).items()}
    vocab = T.gram_vocabulary(spark, terms, F.lit(6), least_df=2).orderBy("gram_id").collect()
    df = Counter(g for t in DOCS.values() for g in grams(t))
    total = sum((grams(t) for t in DOCS.values()), Counter())
    kept = sorted((g for g in df if df[g] >= 2), key=lambda g: (-total[g], g))
    assert [(r.gram, r.gram_id, r.df) for r in vocab] == [(g, i, df[g]) for i, g in enumerate(kept)]
    assert all(r.idf == pytest.approx(math.log(7 / (1 + r.df)) + 1) for r in vocab)


def test_sparse_vectors(spark, docs):
    terms = T.gram_terms(docs)
    vocab = T.gram_vocabulary(spark, terms, F.lit(6), least_df=1)
    size = 3  # a cut of the ids: the three most frequent grams
    weights = T.gram_weights(terms, vocab, size)
    made = T.sparse_features(docs.select("doc_id"), weights, size, lambda rows, schema: write_table(spark, rows, "vectors", schema=schema))
    got = {r.doc_id: r.features for r in made.collect()}
    rank = {r.gram: (r.gram_id, r.idf) for r in vocab.where(F.col("gram_id") < size).collect()}
    assert set(got) == set(DOCS)
    for i, text in DOCS.items():
        raw = {rank[g][0]: (1 + math.log(n)) * rank[g][1] for g, n in grams(text).items() if g in rank}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        assert got[i].size == size and list(got[i].indices) == sorted(raw)
        assert list(got[i].values) == pytest.approx([raw[k] / norm for k in sorted(raw)])
    plan = made._jdf.queryExecution().toString()
    assert "Python" not in plan


def _exchanges(df, *names):
    """The names that occur in the plan's shuffles, each shuffle once."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [x for x in lines if "Exchange hashpartitioning" in x and any(f"{n}#" in x for n in names)]


def test_grams_are_counted_beside_their_text(spark, docs):
    """What is shuffled is the text by document, not each gram."""
    for terms, name in ((T.gram_terms(docs), "gram"), (T.doc_terms(docs), "token")):
        assert not _exchanges(terms, name)
        assert len(_exchanges(terms, "doc_id")) == 1
    twice = spark.createDataFrame([(1, "red fish"), (1, "red fish red"), (None, "red fish"), (None, "fish fish")], "doc_id long, text string")
    assert {(r.doc_id, r.gram): r.tf for r in T.gram_terms(twice).collect()} == {
        (1, "red"): 3, (1, "fish"): 2, (1, "red fish"): 2, (1, "fish red"): 1, (None, "red"): 1, (None, "fish"): 3,
        (None, "red fish"): 1, (None, "fish fish"): 1}


def test_weights_shuffle_once_by_document_and_no_gram(spark, docs, tmp_path):
    rows = [(1, "a", 1), (1, "b", 3), (2, "a", 2), (2, "unknown", 9), (None, "a", 1)]
    spark.createDataFrame(rows, "doc_id long, gram string, tf long").write.parquet(str(tmp_path / "t"))
    terms = spark.read.parquet(str(tmp_path / "t"))
    vocab = spark.createDataFrame([("a", 0, 2.0), ("b", 1, 3.0), ("cut", 2, 1.0)], "gram string, gram_id long, idf double")
    weights = T.gram_weights(terms, vocab, size=2)
    assert not _exchanges(weights, "gram", "token") and len(_exchanges(weights, "doc_id")) == 1
    b = 3.0 * (1 + math.log(3))
    n = math.hypot(2.0, b)
    got = {(r.doc_id, r.gram_id): r.weight for r in weights.collect()}
    assert got == pytest.approx({(1, 0): 2.0 / n, (1, 1): b / n, (2, 0): 1.0})
