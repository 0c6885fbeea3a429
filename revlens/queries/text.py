"""Text queries: tokenizer, n-grams, stop words, gluing, vocabulary, tf,
tf-idf and weighted extremes (survey sections 2.5, 2.6, 2.8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions.text import glue_list, join_words, ngrams, remove_stopwords, tokenize
from revlens.operators.extremes import key_extremes
from revlens.operators.vocab import TERM, by_document, term_frequency, term_stats, tfidf, vocabulary
from revlens.queries.sql import DOCS as TEXT, bigram_list, filtered_list
from revlens.sources import tables

GLUE_KEYS = 20
EXTREMES_N = 50


def _words(spark: SparkSession, sf: str, counted: bool = False) -> DataFrame:
    """Token arrays; ``counted``: dealt by document, for term counts."""
    docs = tables.review_text(spark, sf)
    if counted:
        docs = by_document(docs, "doc_id", "text")
    return docs.select("doc_id", tokenize(F.lower(F.col("text"))).alias("words"))


def _exploded(df: DataFrame, array_col: str, out: str) -> DataFrame:
    # posexplode_outer + null filter: see revlens.operators.vocab.term_frequency
    return (df.select("doc_id", F.posexplode_outer(array_col).alias("pos", out))
            .where(F.col("pos").isNotNull())
            .select("doc_id", F.col("pos").cast("long").alias("pos"), out))


def tokenize_q(spark, sf):
    return _exploded(_words(spark, sf), "words", "token")


def bigrams_q(spark, sf):
    w = _words(spark, sf).select("doc_id", ngrams("words", 2).alias("grams"))
    return _exploded(w, "grams", "bigram")


def remove_stopwords_q(spark, sf):
    w = _words(spark, sf).select("doc_id", remove_stopwords("words").alias("kept"))
    return _exploded(w, "kept", "word")


def _bigram_docs(spark, sf):
    return _words(spark, sf, counted=True).select("doc_id", ngrams("words", 2).alias("grams"))


def _filtered_docs(spark, sf):
    return _words(spark, sf, counted=True).select("doc_id", remove_stopwords("words").alias("kept"))


def glue_bigrams(spark, sf):
    """Glue the 20 most frequent bigrams, in frequency order.

    The key list is a top-20 (TakeOrderedAndProject): 20 strings reach the
    driver and go back as one literal array.
    """
    top = (term_stats(_bigram_docs(spark, sf), "doc_id", "grams")
           .orderBy(F.col("tf").desc(), F.col(TERM).asc()).limit(GLUE_KEYS))
    keys = [r[TERM] for r in top.collect()]
    return _words(spark, sf).select("doc_id", glue_list(join_words("words"), keys).alias("glued_text"))


def ngram_vocabulary(spark, sf):
    return vocabulary(term_stats(_bigram_docs(spark, sf), "doc_id", "grams"))


def term_vocabulary(spark, sf):
    return vocabulary(term_stats(_filtered_docs(spark, sf), "doc_id", "kept"))


def vocabulary_size(spark, sf):
    return (term_frequency(_bigram_docs(spark, sf), "doc_id", "grams").select(TERM).distinct()
            .agg(F.count(F.lit(1)).alias("n_terms")))


def term_frequency_q(spark, sf):
    return term_frequency(_filtered_docs(spark, sf), "doc_id", "kept")


def _tfidf(docs, n_docs, terms_col):
    out = tfidf(term_frequency(docs, "doc_id", terms_col), "doc_id", n_docs)
    return out.select("doc_id", TERM, "tf", F.round("tfidf", 6).alias("tfidf"))


def tfidf_bigram(spark, sf):
    return _tfidf(_bigram_docs(spark, sf), tables.review_text(spark, sf).count(), "grams")


def tfidf_filtered(spark, sf):
    return _tfidf(_filtered_docs(spark, sf), tables.review_text(spark, sf).count(), "kept")


def key_extremes_q(spark, sf):
    stats = term_stats(_bigram_docs(spark, sf), "doc_id", "grams")
    weights = stats.select(TERM, F.col("df").cast("double").alias("weight"))
    return key_extremes(weights, EXTREMES_N)


# -- oracles -------------------------------------------------------------------

_EXPLODE = ("SELECT doc_id, CAST(generate_subscripts({l}, 1) - 1 AS BIGINT) AS pos, "
            "unnest({l}) AS {name} FROM toks")


def _stats_sql(list_expr: str) -> str:
    return (f"pairs AS (SELECT doc_id, unnest({list_expr}) AS term FROM toks), "
            "tfd AS (SELECT doc_id, term, count(*) AS tf FROM pairs GROUP BY doc_id, term), "
            "st AS (SELECT term, sum(tf) AS tf, count(*) AS df FROM tfd GROUP BY term), "
            "vocab AS (SELECT term, row_number() OVER (ORDER BY tf DESC, term) - 1 AS term_index, "
            "tf, df FROM st) ")


def _tfidf_sql(list_expr: str) -> str:
    return (TEXT + ", " + _stats_sql(list_expr) +
            "SELECT t.doc_id, t.term, t.tf, round(t.tf * ln(((SELECT count(*) FROM toks) + 1) "
            "/ (v.df + 1)), 6) AS tfidf FROM tfd t JOIN vocab v ON t.term = v.term")


_GLUE_SQL = TEXT.replace("WITH texts", "WITH RECURSIVE texts") + ", " + _stats_sql(bigram_list()) + (
    f", keys AS (SELECT term, term_index + 1 AS k FROM vocab WHERE term_index < {GLUE_KEYS}), "
    "g(doc_id, k, t) AS (SELECT doc_id, 0, array_to_string(w, ' ') FROM toks "
    "UNION ALL SELECT g.doc_id, g.k + 1, replace(g.t, keys.term, replace(keys.term, ' ', '_')) "
    "FROM g JOIN keys ON keys.k = g.k + 1) "
    "SELECT doc_id, t AS glued_text FROM g WHERE k = (SELECT count(*) FROM keys)")

SQL = {
    "tokenize": TEXT + _EXPLODE.format(l="w", name="token"),
    "bigrams": TEXT + _EXPLODE.format(l=bigram_list(), name="bigram"),
    "remove_stopwords": TEXT + _EXPLODE.format(l=filtered_list(), name="word"),
    "glue_bigrams": _GLUE_SQL,
    "ngram_vocabulary": TEXT + ", " + _stats_sql(bigram_list()) + "SELECT term, term_index, tf, df FROM vocab",
    "term_vocabulary": TEXT + ", " + _stats_sql(filtered_list()) + "SELECT term, term_index, tf, df FROM vocab",
    "vocabulary_size": TEXT + ", " + _stats_sql(bigram_list()) + "SELECT count(*) AS n_terms FROM vocab",
    "term_frequency": TEXT + ", " + _stats_sql(filtered_list()) + "SELECT doc_id, term, tf FROM tfd",
    "tfidf_bigram": _tfidf_sql(bigram_list()),
    "tfidf_filtered": _tfidf_sql(filtered_list()),
    "key_extremes": TEXT + ", " + _stats_sql(bigram_list()) + (
        f", o AS (SELECT term, CAST(df AS DOUBLE) AS weight, "
        "row_number() OVER (ORDER BY df, term) - 1 AS p, count(*) OVER () AS v FROM st) "
        f"SELECT 'low' AS side, CAST(p AS BIGINT) AS position, term, weight FROM o WHERE p < {EXTREMES_N} "
        f"UNION ALL SELECT 'high' AS side, CAST(least({EXTREMES_N}, v) + p - (v - least({EXTREMES_N}, v)) "
        f"AS BIGINT) AS position, term, weight FROM o WHERE p >= v - {EXTREMES_N}"),
}

QUERIES = {
    "tokenize": (tokenize_q, SQL["tokenize"]),
    "bigrams": (bigrams_q, SQL["bigrams"]),
    "remove_stopwords": (remove_stopwords_q, SQL["remove_stopwords"]),
    "glue_bigrams": (glue_bigrams, SQL["glue_bigrams"]),
    "ngram_vocabulary": (ngram_vocabulary, SQL["ngram_vocabulary"]),
    "term_vocabulary": (term_vocabulary, SQL["term_vocabulary"]),
    "vocabulary_size": (vocabulary_size, SQL["vocabulary_size"]),
    "term_frequency": (term_frequency_q, SQL["term_frequency"]),
    "tfidf_bigram": (tfidf_bigram, SQL["tfidf_bigram"]),
    "tfidf_filtered": (tfidf_filtered, SQL["tfidf_filtered"]),
    "key_extremes": (key_extremes_q, SQL["key_extremes"]),
}
