"""Key n-grams: the n-grams a linear SVM weighs most, glued into one token.

tokens -> n-grams -> vocabulary (train docs) -> tf-idf -> linear SVM on the
training side of a hash split -> the ``per_side`` lowest and highest
weighted n-grams -> every document's text with those n-grams glued
(``"not good"`` -> ``"not_good"``), in key-list order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.fixed import (KEY_EXTREMES_PER_SIDE, KEY_NGRAM_N, SPLIT_SEED,
                                     TOKEN_PATTERN)
from revlens.functions.text import glue_list, join_words, ngrams, tokenize
from revlens.operators.extremes import key_extremes, key_list
from revlens.operators.features import (POSITION, in_few_parts, in_first_part, number_documents, samples,
                                        term_columns)
from revlens.operators.svm import WEIGHT, LinearSVC, LinearSVCModel
from revlens.operators.vocab import TERM, TERM_INDEX, by_document, term_table, vocabulary
from revlens.session import write_table


SIDES = [0.8, 0.2]   # training, test


@dataclass
class KeyNgrams:
    docs: DataFrame        # input + words, <output_col>
    extremes: DataFrame    # side, position, term, weight
    keys: list[str]
    vocabulary: DataFrame  # term, term_index, tf, df
    weights: DataFrame     # term, term_index, weight
    model: LinearSVCModel
    held: tuple[DataFrame, ...] = ()

    def release(self) -> None:
        """Unpersist the text."""
        for df in self.held:
            df.unpersist()


def coefficient_frame(weights: DataFrame, vocab: DataFrame) -> DataFrame:
    """(term, term_index, weight): the SVM weight of every vocabulary term."""
    return vocab.select(TERM, TERM_INDEX).join(weights, TERM)


def fit_columns(table: DataFrame, numbers: DataFrame, n_numbers: int, n_train: int, doc_col: str, seed: int,
                vocab_cap: int | None, min_df: int, fit_on_all: bool, train_only: bool) -> tuple[DataFrame, DataFrame]:
    """(columns, vocabulary) of a (doc, term, tf) table: statistics and weights from
    one shuffle by term. Documents below position ``n_train`` are the training side."""
    # a null id has no position
    train = F.when(F.col(POSITION).isNull(), in_first_part(doc_col, SIDES, seed)).otherwise(F.col(POSITION) < n_train)
    columns = term_columns(table, numbers, n_numbers, doc_col, F.lit(True) if fit_on_all else train,
                           F.col(POSITION) < n_train if train_only else None)
    vocab = vocabulary(columns.select(TERM, "tf", "df"), vocab_cap, min_df, compact=True)
    if vocab_cap is not None or min_df > 1:
        columns = write_table(columns.join(vocab.select(TERM), TERM, "left_semi"), "columns")
    return columns, vocab


def key_ngrams(docs: DataFrame, n: int = KEY_NGRAM_N, seed: int = SPLIT_SEED,
               per_side: int = KEY_EXTREMES_PER_SIDE, max_iter: int = 100,
               reg_param: float = 0.1, doc_col: str = "doc_id", text_col: str = "text",
               label_col: str = "label", output_col: str = "ngram_text",
               pattern: str = TOKEN_PATTERN, vocab_cap: int | None = None, min_df: int = 1,
               fit_on_all: bool = False) -> KeyNgrams:
    """Find key n-grams and add ``output_col``: the glued text of every doc.

    ``fit_on_all`` fits vocabulary and IDF on all documents (as the original
    job did); by default only the training side is used.
    """
    spark = docs.sparkSession
    # The text, dealt by document, is kept and tokenised for the term table and
    # for gluing: token arrays take several times its memory. Persisted, not
    # written: the lineage is deterministic, so a lost executor recomputes its part.
    dealt = by_document(docs, doc_col, text_col).persist(StorageLevel.MEMORY_AND_DISK)
    words = dealt.withColumn("words", tokenize(text_col, pattern))
    grams = words.select(doc_col, ngrams("words", n).alias("ngrams"))
    table = term_table(grams, doc_col, "ngrams", False)
    first = in_first_part(doc_col, SIDES, seed)
    numbers, n_numbers, n_train = number_documents(dealt, doc_col, first)
    columns, vocab = fit_columns(table, numbers, n_numbers, n_train, doc_col, seed, vocab_cap, min_df, fit_on_all, True)
    train = dealt.where(first)
    n_fit = (dealt if fit_on_all else train).count()
    fitted = samples(train, numbers, n_numbers, doc_col, label_col)
    svc = LinearSVC(fitted, n_fit, regParam=reg_param, maxIter=max_iter).fit(in_few_parts(columns))
    found = write_table(svc.weights(columns), "weights", "zstd")
    extremes = key_extremes(found.select(TERM, WEIGHT), per_side)
    keys = key_list(extremes)
    weights = coefficient_frame(found, vocab)
    glued = words.withColumn(output_col, glue_list(join_words("words"), keys))
    return KeyNgrams(glued, extremes, keys, vocab, weights, svc, (dealt,))
