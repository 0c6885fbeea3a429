import random

import pytest

from revlens.plans.sentiment import label_reviews, sentiment
from revlens.sources import tables

FILLER = ["food", "service", "place", "staff", "price", "menu", "table", "drinks"]


def _planted(spark, n=240, seed=11):
    rnd = random.Random(seed)
    rows = []
    for d in range(n):
        pos = d % 2 == 0
        words = rnd.sample(FILLER, 3)
        core = "very good" if pos else "not good"
        rows.append((d, f"The {words[0]} was {core}, {words[1]} {words[2]}.", 5.0 if pos else 1.0))
    return spark.createDataFrame(rows, "doc_id long, text string, stars double")


def test_label_reviews(spark):
    df = spark.createDataFrame([(1, "GOOD", 4.0, 1), (2, "Bad", 3.5, 2), (3, "x", None, 3)],
                               "doc_id long, text string, stars double, cool int")
    rows = {r["doc_id"]: (r["text"], r["label"]) for r in label_reviews(df).collect()}
    assert rows == {1: ("good", 1), 2: ("bad", 0), 3: ("x", 0)}
    assert "stars" not in label_reviews(df).columns and "cool" not in label_reviews(df).columns


def test_t16_planted_bigrams_are_keys_and_glue_helps(spark):
    res = sentiment(_planted(spark), key_max_iter=30, max_iter=30, per_side=3,
                    reg_grid=(0.01, 0.1))
    assert "not good" in res.keys.keys[:3]
    assert "very good" in res.keys.keys[-3:]
    glued = [r["ngram_text"] for r in res.keys.docs.select("ngram_text").limit(4).collect()]
    assert any("very_good" in t or "not_good" in t for t in glued)
    assert res.auroc > 0.95
    assert res.best_reg in (0.01, 0.1)
    rows = res.scored.collect()
    assert all((r["prediction"] == 1.0) == (r["margin"] > 0) for r in rows)


def test_t18_key_list_stable_under_repartition(spark):
    a = sentiment(_planted(spark).repartition(1), key_max_iter=10, max_iter=5, per_side=3,
                  reg_grid=(0.1,))
    b = sentiment(_planted(spark).repartition(5), key_max_iter=10, max_iter=5, per_side=3,
                  reg_grid=(0.1,))
    assert a.keys.keys == b.keys.keys
    assert sorted(r["doc_id"] for r in a.scored.collect()) == sorted(r["doc_id"] for r in b.scored.collect())


def test_fit_on_all_option_uses_all_documents(spark):
    from revlens.plans.keyphrase import key_ngrams
    docs = label_reviews(_planted(spark, n=60))
    train_only = key_ngrams(docs, max_iter=5, per_side=2)
    all_docs = key_ngrams(docs, max_iter=5, per_side=2, fit_on_all=True)
    n_train = train_only.vocabulary.agg({"df": "max"}).first()[0]
    n_all = all_docs.vocabulary.agg({"df": "max"}).first()[0]
    assert n_all > n_train
