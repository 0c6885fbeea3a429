"""Work that is done once, or in few parts."""

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import functions as F

from revlens.operators.features import in_few_parts
from revlens.plans import keyphrase
from revlens.queries import models


def test_fits_read_no_more_partitions_than_cores(spark):
    wide = spark.range(1000).repartition(64)
    few = in_few_parts(wide)
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert few.agg(F.sum("id")).first()[0] == 499500


def test_key_ngrams_fit_and_count_by_document(spark, monkeypatch):
    seen, fit = [], keyphrase.LinearSVC.fit
    monkeypatch.setattr(keyphrase.LinearSVC, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    dealt = []
    frequency = keyphrase.term_table
    monkeypatch.setattr(keyphrase, "term_table", lambda df, *a: dealt.append(
        df._jdf.queryExecution().executedPlan().toString()) or frequency(df, *a))
    docs = spark.createDataFrame([(d, d % 2, f"{'very good' if d % 2 else 'not good'} a{d}") for d in range(40)],
                                 "doc_id long, label int, text string")
    found = keyphrase.key_ngrams(docs, max_iter=5, per_side=1)
    assert seen and max(seen) <= spark.sparkContext.defaultParallelism
    assert "hashpartitioning(doc_id" in dealt[0]
    assert found.weights.count() == found.vocabulary.count() == found.model.numFeatures
    found.release()


def test_als_rmse_identity_predicts_once(spark, sf001, monkeypatch):
    written = []
    whole = models.write_table
    monkeypatch.setattr(models, "write_table", lambda df, name: written.append(name) or whole(df, name))
    calls, transform = [], ALSModel.transform
    monkeypatch.setattr(ALSModel, "transform", lambda self, df: calls.append(1) or transform(self, df))
    row = models.als_rmse_identity(spark, sf001).first()
    assert tuple(row) == (True, True) and calls == [1] and written == ["predicted"]
