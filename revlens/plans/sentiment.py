"""Review sentiment: key n-gram gluing, TF-IDF, tuned linear SVM, AUROC.

label = stars >= 4 -> key n-grams (stage 1) -> tokens of the glued text
-> stop words removed -> vocabulary and IDF on the training side -> a
linear SVM tuned over regParam by a train/validation split -> scores and
AUROC on the test side. Train and test come from one hash split of the
document id, used by both stages.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.fixed import (KEY_EXTREMES_PER_SIDE, KEY_NGRAM_N,
                                     POSITIVE_MIN_STARS, SPLIT_SEED, SVM_REG_GRID,
                                     TOKEN_PATTERN)
from revlens.functions.text import remove_stopwords, tokenize
from revlens.operators.features import (POSITION, in_few_parts, in_first_part, number_documents,
                                        position_values, samples, sparse_features)
from revlens.operators.sampling import hash_split
from revlens.operators.svm import LinearSVC, LinearSVCModel, margins
from revlens.operators.vocab import term_table
from revlens.plans.keyphrase import SIDES, KeyNgrams, fit_columns, key_ngrams
from revlens.session import write_table

DROPPED = ("cool", "funny", "useful", "date", "stars")


def label_reviews(reviews: DataFrame, min_stars: int = POSITIVE_MIN_STARS) -> DataFrame:
    """label = 1 when stars >= min_stars else 0 (null stars -> 0); text lower-cased."""
    return (reviews
            .withColumn("label", F.when(F.col("stars") >= min_stars, 1).otherwise(0))
            .withColumn("text", F.lower(F.col("text")))
            .drop(*DROPPED))


@dataclass
class SentimentResult:
    scored: DataFrame            # doc_id, label, prediction, rawPrediction, margin
    auroc: float
    best_reg: float
    validation: list[tuple[float, float]]   # (regParam, validation AUROC)
    n_validation: int            # documents held back to choose regParam
    keys: KeyNgrams
    model: LinearSVCModel        # the best regParam, fitted on the whole training side
    vectors: Callable[[], DataFrame]
    held: tuple[DataFrame, ...] = ()

    @property
    def features(self) -> DataFrame:
        """doc_id, label, features of all docs; made when asked for, as the fits read columns."""
        return self.vectors()

    def release(self) -> None:
        """Unpersist everything the job has cached."""
        self.keys.release()
        for df in self.held:
            df.unpersist()


def sentiment(reviews: DataFrame, seed: int = SPLIT_SEED, n: int = KEY_NGRAM_N,
              per_side: int = KEY_EXTREMES_PER_SIDE, key_max_iter: int = 100,
              key_reg: float = 0.1, max_iter: int = 100,
              reg_grid: Sequence[float] = SVM_REG_GRID, train_ratio: float = 0.8,
              parallelism: int | None = None, vocab_cap: int | None = None, min_df: int = 1,
              fit_on_all: bool = False, num_bins: int = 0,
              doc_col: str = "doc_id", pattern: str = TOKEN_PATTERN) -> SentimentResult:
    """Train and evaluate the classifier; AUROC is exact with ``num_bins=0``.

    regParam is chosen on a part of the training side that a hash of the
    document id holds back, then fitted on the whole training side.
    ``parallelism``: grid cells fitted concurrently (default: the grid size,
    at most 4); they share the rounds' passes over the training columns.
    """
    if parallelism is None:
        parallelism = max(1, min(len(reg_grid), 4))
    labelled = label_reviews(reviews)
    kn = key_ngrams(labelled, n=n, seed=seed, per_side=per_side, max_iter=key_max_iter,
                    reg_param=key_reg, doc_col=doc_col, output_col="ngram_text",
                    pattern=pattern, vocab_cap=vocab_cap, min_df=min_df, fit_on_all=fit_on_all)
    kept = kn.docs.select(doc_col, remove_stopwords(tokenize("ngram_text", pattern)).alias("kept"))
    table = term_table(kept, doc_col, "kept", False)   # the one pass over the glued text
    docs = write_table(kn.docs.select(doc_col, "label"), "labels")
    train, test = hash_split(docs, SIDES, seed, [doc_col])
    numbers, n_numbers, n_train = number_documents(docs, doc_col, in_first_part(doc_col, SIDES, seed))
    columns, vocab = fit_columns(table, numbers, n_numbers, n_train, doc_col, seed, vocab_cap, min_df, fit_on_all, False)
    n_fit = (docs if fit_on_all else train).count()
    few = in_few_parts(columns)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction",
                                              labelCol="label", numBins=num_bins)
    # another seed than the outer split's, whose buckets end at the training side
    inner, held_back = hash_split(train, [train_ratio, 1 - train_ratio], seed + 1, [doc_col])
    n_validation = held_back.count()
    if not n_validation:
        raise ValueError("no document falls on the validation side")

    def svc(rows: DataFrame, reg: float) -> LinearSVC:
        return LinearSVC(samples(rows, numbers, n_numbers, doc_col, "label"), n_fit, regParam=reg, maxIter=max_iter)

    def score(rows: DataFrame, by_position, intercept: float) -> DataFrame:
        """Rows with the margins of their document; an empty one has the intercept."""
        found = numbers.join(position_values(rows.sparkSession, by_position, "margin"), POSITION).select(doc_col, "margin")
        margin = F.coalesce("margin", F.lit(intercept))
        return (rows.join(found, doc_col, "left")
                .select(doc_col, "label", F.when(margin > 0, 1.0).otherwise(0.0).alias("prediction"),
                        array_to_vector(F.array(-margin, margin)).alias("rawPrediction"), margin.alias("margin")))

    regs = [float(r) for r in reg_grid]
    grid, models = svc(inner, regs[0]), []
    for k in range(0, len(regs), max(1, parallelism)):
        models += grid.fit_many(few, regs[k:k + max(1, parallelism)])
    metrics = [evaluator.evaluate(score(held_back, m, model.intercept))
               for m, model in zip(margins(few, models), models)]
    best_reg = regs[max(range(len(regs)), key=lambda i: metrics[i])]  # ties: the earlier one
    model = svc(train, best_reg).fit(few)
    scored = write_table(score(test, margins(few, [model])[0], model.intercept), "scored")
    auroc = evaluator.evaluate(scored)
    return SentimentResult(scored, auroc, best_reg, list(zip(regs, metrics)), n_validation, kn, model,
                           lambda: sparse_features(docs, table, vocab, n_fit, doc_col))
