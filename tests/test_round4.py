"""Whole fits, and fits whose vectors are as long as there are documents."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import LinearSVC as SparkSVC
from pyspark.sql import functions as F

from revlens.functions.text import tokenize
from revlens.operators import features, svm
from revlens.operators.svm import LinearSVC, margins
from revlens.operators.vocab import table_stats, term_table, vocabulary
from revlens.plans import keyphrase, tune
from revlens.plans import sentiment as plan
from revlens.queries import models


def test_svm_queries_take_the_original_number_of_iterations(spark, sf001, monkeypatch):
    asked = {}

    def stop(docs, **kwargs):
        asked.update(kwargs)
        raise InterruptedError

    monkeypatch.setattr(plan, "key_ngrams", stop)
    models.release_fits()
    try:
        models.svm_key_bigrams(spark, sf001)
    except InterruptedError:
        pass
    assert asked["max_iter"] == 100 and models.SVM_PARAMS["max_iter"] == 100


def _rows(spark, n=90, seed=5):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(25)]
    return spark.createDataFrame(
        [(d, " ".join([*(rnd.choice(words) for _ in range(rnd.randint(1, 9))), *(["good"] * (d % 3)), f"own{d}", "all"]),
          int(d % 3 > 0 or rnd.random() < 0.2)) for d in range(n)], "doc_id long, text string, label int")


def _columns(spark, docs, late):
    words = docs.select("doc_id", tokenize("text").alias("w"))
    numbers, n, n_first = features.number_documents(docs, "doc_id", ~late)
    cols = features.term_columns(term_table(words, "doc_id", "w", False), numbers, n, "doc_id", F.lit(True))
    return cols, numbers, n, n_first


def _listed(cols):
    return {r["term"]: (r["tf"], r["df"], np.frombuffer(r["pos"], np.int32).tolist(), np.frombuffer(r["n"], np.int32).tolist())
            for r in cols.collect()}


def test_columns_hold_every_entry_in_order(spark):
    docs = _rows(spark)
    cols, numbers, n, n_first = _columns(spark, docs, F.col("doc_id") % 5 == 0)
    assert (n, n_first) == (90, 72)
    at = {r[0]: r[1] for r in numbers.collect()}
    assert sorted(at, key=at.get) == sorted(at, key=lambda d: (d % 5 == 0, d))
    want = {}
    for r in docs.collect():
        for term, k in Counter(r["text"].split()).items():
            want.setdefault(term, []).append((at[r["doc_id"]], k))
    assert _listed(cols) == {t: (sum(k for _, k in e), len(e), [p for p, _ in sorted(e)], [k for _, k in sorted(e)])
                             for t, e in want.items()}


def test_terms_of_one_hash_and_of_many_batches():
    """A run of one hash may hold several terms and reach over batches."""
    rows = [("b", 3, 1, True, 7), ("a", 2, 2, True, 7), ("b", 1, 5, False, 7), ("c", -1, 4, True, 9), ("c", 0, 1, True, 9),
            ("d", 4, 1, False, 11), ("e", 4, 1, True, 12)]
    names = ["term", "pos", "n", "counted", "h"]
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.int64()]
    for size in (1, 2, 3, 7):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i:i + size]), kinds)], names)
                   for i in range(0, len(rows), size)]
        got = {t: (tf, df, np.frombuffer(p, np.int32).tolist(), np.frombuffer(n, np.int32).tolist())
               for b in features._to_columns(iter(batches)) for t, tf, df, p, n in zip(*(c.to_pylist() for c in b.columns))}
        assert got == {"a": (2, 1, [2], [2]), "b": (1, 1, [1, 3], [5, 1]), "c": (5, 2, [0], [1]), "e": (1, 1, [4], [1])}


def test_fit_is_at_the_minimum_of_spark_mls_objective(spark):
    docs = _rows(spark)
    cols, numbers, n, _ = _columns(spark, docs, F.col("doc_id") < 0)
    fitted = features.samples(docs, numbers, n, "doc_id", "label")
    model = LinearSVC(fitted, 90, regParam=0.05, maxIter=500).fit(cols)
    assert 0 <= model.gap <= 1e-6 * model.objective
    found = {r["term"]: r["weight"] for r in model.weights(cols).collect()}

    table = term_table(docs.select("doc_id", tokenize("text").alias("w")), "doc_id", "w")
    vocab = vocabulary(table_stats(table))
    terms = [r["term"] for r in vocab.orderBy("term_index").collect()]
    vectors = features.sparse_features(docs.select("doc_id", "label"), table, vocab, 90, "doc_id")
    theirs = SparkSVC(regParam=0.05, maxIter=500).fit(vectors)
    rows = vectors.orderBy("doc_id").collect()
    x, y = np.array([r["features"].toArray() for r in rows]), np.array([2 * r["label"] - 1 for r in rows])

    def objective(w, b):
        return np.maximum(0, 1 - y * (x @ w + b)).mean() + 0.025 * ((w * x.std(0, ddof=1)) ** 2).sum()

    w = np.array([found[t] for t in terms])
    at = {r[0]: r[1] for r in numbers.collect()}
    assert objective(w, model.intercept) == pytest.approx(model.objective, rel=1e-9)
    assert model.objective <= objective(theirs.coefficients.toArray(), theirs.intercept) + 1e-9
    assert found["all"] == 0 and len(found) == model.numFeatures
    ours = margins(cols, [model])[0][[at[r["doc_id"]] for r in rows]]
    assert ours.tolist() == pytest.approx((x @ w + model.intercept).tolist(), abs=1e-9)


def test_repeated_and_null_ids_are_training_rows(spark):
    """As before: rows of one id have the same vector, rows without an id an empty one."""
    docs = spark.createDataFrame([(1, "good x", 1), (1, "good x", 1), (2, "bad x", 0), (3, "bad y", 0), (None, "good y", 1),
                                  (4, "good y", 1)], "doc_id long, text string, label int")
    cols, numbers, n, _ = _columns(spark, docs, F.lit(False))
    fitted = features.samples(docs, numbers, n, "doc_id", "label")
    assert fitted.weights().tolist() == [2, 1, 1, 1, 1] and fitted.size == 5
    assert _listed(cols)["good"] == (4, 3, [0, 3], [2, 1])
    model = LinearSVC(fitted, 6, regParam=0.1).fit(cols)
    assert model.iterations <= 100 and margins(cols, [model])[0][4] == model.intercept
    with pytest.raises(ValueError, match="0 and 1"):
        features.samples(docs.withColumn("label", F.lit(2)), numbers, n, "doc_id", "label")


def test_nothing_as_long_as_the_vocabulary_is_sent(spark, monkeypatch):
    sent, product = [], svm._product
    monkeypatch.setattr(svm, "_product", lambda blocks, v: sent.append(v.shape) or product(blocks, v))
    found = keyphrase.key_ngrams(_rows(spark, 30), max_iter=5, per_side=2)
    numbers = {30, 31}
    assert sent and all(k == 1 and n in numbers for k, n in sent) and found.vocabulary.count() > 60
    found.release()


def test_grid_cells_share_the_rounds(spark, monkeypatch):
    docs = _rows(spark)
    cols, numbers, n, _ = _columns(spark, docs, F.lit(False))
    svc = LinearSVC(features.samples(docs, numbers, n, "doc_id", "label"), 90, regParam=0.1, maxIter=40)
    rounds, product = [], svm._product
    monkeypatch.setattr(svm, "_product", lambda blocks, v: rounds.append(len(v)) or product(blocks, v))
    together = svc.fit_many(cols, [0.01, 0.1, 1.0])
    assert rounds[0] == 3 and len(rounds) == max(m.iterations for m in together)
    alone = svc.fit(cols)
    assert together[1].objective == pytest.approx(alone.objective, rel=1e-12)


def test_a_large_grid_keeps_its_fits_out_of_memory(spark, monkeypatch):
    ratings = spark.range(600).select(
        (F.col("id") % 20).cast("int").alias("user_id_numeric"), (F.col("id") * 7 % 30).cast("int").alias("business_id_numeric"),
        (F.col("id") % 5 + 1).cast("double").alias("rating"))
    seen, at_once, most, fit = [], [], [], tune.fit

    def spy(als, train):
        at_once.append(als)
        most.append(len(at_once))
        seen.append((als.getIntermediateStorageLevel(), als.getFinalStorageLevel(), als.getNumUserBlocks()))
        try:
            return fit(als, train)
        finally:
            at_once.pop()

    monkeypatch.setattr(tune, "fit", spy)
    small = tune.als_grid_search(ratings, [2], [0.1, 1.0], 2, parallelism=2).results.collect()
    assert seen == [("MEMORY_AND_DISK", "MEMORY_AND_DISK", 10)] * 2
    seen.clear()
    most.clear()
    monkeypatch.setattr(tune, "GRID_MEMORY_RATINGS", 100)
    large = tune.als_grid_search(ratings, [2], [0.1, 1.0], 2, parallelism=2).results.collect()
    assert seen == [("DISK_ONLY", "DISK_ONLY", 10)] * 2 and most == [1, 1]
    # the same models, up to the order of sums
    assert [r["rmse"] for r in large] == pytest.approx([r["rmse"] for r in small], rel=1e-6)
    assert [tuple(r)[:3] + tuple(r)[4:] for r in large] == [tuple(r)[:3] + tuple(r)[4:] for r in small]
    monkeypatch.setattr(tune, "GRID_BLOCK_RATINGS", 20)
    seen.clear()
    tune.als_grid_search(ratings, [2], [0.1], 1)
    assert seen[0][2] > 10
