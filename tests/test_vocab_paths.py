"""Vocabulary order with and without a cap; no term is lost unless asked."""

import random

import pytest
from pyspark.ml.feature import IDF, CountVectorizerModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from revlens.functions.text import ngrams, tokenize
from revlens.operators import features
from revlens.operators import vocab as V
from revlens.operators.features import sparse_features
from revlens.operators.skew import SkewSpec


def _docs(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    return spark.createDataFrame(
        [(d, [rnd.choice(words) for _ in range(rnd.randint(0, 30))]) for d in range(80)],
        "doc_id long, w array<string>")


def test_cap_is_a_prefix_of_the_whole(spark):
    stats = V.term_stats(_docs(spark), "doc_id", "w")
    whole = V.vocabulary(stats).orderBy("term_index").collect()
    assert len(whole) == stats.count()
    assert [r["term_index"] for r in whole] == list(range(len(whole)))
    assert [tuple(r) for r in whole] == sorted((tuple(r) for r in whole), key=lambda r: (-r[2], r[0]))
    assert V.vocabulary(stats, cap=25).orderBy("term_index").collect() == whole[:25]


def test_tfidf_with_salted_terms(spark):
    table = V.term_table(_docs(spark), "doc_id", "w")
    plain = V.tfidf(table, "doc_id", 80)
    salted = V.tfidf(table, "doc_id", 80, skew=SkewSpec(min_rows=5, rows_per_salt=2))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.collect()))


@pytest.mark.parametrize("skew", [SkewSpec(), SkewSpec(min_rows=5, rows_per_salt=2)])
@pytest.mark.parametrize("cap", [None, 7])
def test_vectors_equal_count_vectorizer_and_idf(spark, skew, cap):
    docs = _docs(spark).unionByName(spark.createDataFrame([(900, []), (901, None)], "doc_id long, w array<string>"))
    table = V.term_table(docs, "doc_id", "w")
    vocab = V.vocabulary(V.table_stats(table), cap)
    ours = sparse_features(docs.select("doc_id"), table, vocab, docs.count(), "doc_id", "x", skew)
    terms = [r["term"] for r in vocab.orderBy("term_index").collect()]
    whole = docs.withColumn("w", F.coalesce("w", F.array()))
    counted = CountVectorizerModel.from_vocabulary(terms, inputCol="w", outputCol="tf").transform(whole)
    theirs = IDF(inputCol="tf", outputCol="x").fit(counted).transform(counted)
    got = {r["doc_id"]: r["x"] for r in ours.collect()}
    for r in theirs.select("doc_id", "x").collect():
        assert got[r["doc_id"]].size == len(terms)
        assert got[r["doc_id"]].toArray().tolist() == pytest.approx(r["x"].toArray().tolist(), abs=1e-12)
    assert len(got) == 82


def test_vectors_refuse_what_does_not_fit(spark, monkeypatch):
    table = V.term_table(_docs(spark), "doc_id", "w")
    vocab = V.vocabulary(V.table_stats(table))
    monkeypatch.setattr(features, "FEATURES_MAX", 10)
    with pytest.raises(ValueError, match="vocab_cap"):
        sparse_features(_docs(spark).select("doc_id"), table, vocab, 80, "doc_id")
    with pytest.raises(ValueError, match="empty vocabulary"):
        sparse_features(_docs(spark).select("doc_id"), table, vocab.limit(0), 80, "doc_id")


def test_coefficients_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(features, "COEFFICIENT_BLOCK", 7)
    values = [0.5 * i for i in range(30)]
    got = features.coefficient_rows(spark, Vectors.dense(values)).orderBy("term_index").collect()
    assert [(r["term_index"], r["weight"]) for r in got] == list(enumerate(values))


def test_text_is_evaluated_once_by_tfidf_and_vectors(spark):
    """Counted over all jobs: the text comes from a function that counts its calls."""
    for job in ("tfidf", "vectors"):
        calls = spark.sparkContext.accumulator(0)

        def text(i, calls=calls):
            calls.add(1)
            return f"a b c{i % 7} d{i}"

        docs = (spark.range(40).repartition(4).withColumn("t", F.udf(text)("id"))
                .select(F.col("id").alias("doc_id"), ngrams(tokenize("t"), 2).alias("g")))
        table = V.term_table(docs, "doc_id", "g")
        if job == "tfidf":
            out = V.tfidf(table, "doc_id", docs.agg(F.count(F.lit(1))).scalar())
            assert out.count() == 120
        else:
            out = sparse_features(docs.select("doc_id"), table, V.vocabulary(V.table_stats(table)), 40, "doc_id")
        out.collect()
        assert calls.value == 40


def _shuffles(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()   # after a run: the final plan and the first
    return sorted({line.split("Exchange ")[1].split(", [plan_id")[0] for line in plan.splitlines() if "Exchange hashpartitioning" in line})


def test_terms_are_counted_where_their_document_lies(spark):
    """One shuffle of the text, none of the (document, term) rows; ids repeat and are null."""
    rows = [(1, "a b a"), (1, "a c"), (2, "b"), (None, "a"), (None, "a b"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plain = V.term_frequency(docs.select("doc_id", F.split("text", " ").alias("w")), "doc_id", "w")
    dealt = V.by_document(docs, "doc_id", "text").select("doc_id", F.split("text", " ").alias("w"))
    counted = V.term_frequency(dealt, "doc_id", "w")
    assert sorted(map(str, counted.collect())) == sorted(map(str, plain.collect()))
    assert len(_shuffles(counted)) == 1 and "term" not in _shuffles(counted)[0]


def test_vocabulary_shuffles_no_document_term_rows(spark, sf001):
    from revlens.queries import text
    stats = V.term_stats(text._bigram_docs(spark, sf001), "doc_id", "grams")
    assert not any("doc_id" in s and "term" in s for s in _shuffles(stats))


def test_text_partitions_follow_its_bytes(spark, monkeypatch):
    monkeypatch.setattr(V, "PARTITION_BYTES", 100)
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 40).alias("text"))
    assert V.by_document(docs, "doc_id", "text").rdd.getNumPartitions() == 20


def test_tfidf_shuffles_its_rows_once(spark):
    docs = _docs(spark).select("doc_id", F.array_join("w", " ").alias("text"))
    dealt = V.by_document(docs, "doc_id", "text").select("doc_id", F.split("text", " ").alias("w"))
    out = V.tfidf(V.term_frequency(dealt, "doc_id", "w"), "doc_id", 80)
    assert len(_shuffles(out)) == 2   # the text by document, the rows by term
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_frequent_terms_are_counted_apart(spark):
    rows = [(d, t) for d in range(40) for t in ["all", f"own{d}", *(["half"] if d % 2 else [])]]
    table = spark.createDataFrame(rows, "doc_id long, term string").withColumn("tf", F.lit(2).cast("long"))
    often = V.frequent_terms(table, "doc_id", 40, SkewSpec(min_rows=20))
    assert sorted(map(tuple, often.collect())) == [("all", 40), ("half", 20)]
    assert V.frequent_terms(table, "doc_id", 40, SkewSpec(min_rows=41)) is None
    plain, apart = (V.tfidf(table, "doc_id", 40, skew=SkewSpec(min_rows=m)) for m in (1000, 20))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, apart.collect()))
