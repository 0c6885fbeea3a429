"""Term statistics, vocabulary, term frequency and IDF as relational plans.

Vocabulary order: corpus count descending, then term ascending (a total
order, so a cut at a caller's ``cap`` is deterministic). IDF is
``ln((N + 1) / (df + 1))`` with N the number of documents, as Spark ML's IDF
with ``minDocFreq = 0``; tf-idf is the raw count times IDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.operators.indexing import row_index
from revlens.operators.skew import SkewSpec, hot_keys, salted_join
from revlens.session import write_table

TERM = "term"
TERM_INDEX = "term_index"
# Text of one partition whose terms are counted: its hash table stays in a task's memory.
PARTITION_BYTES = 16 << 20
# The least share of all rows that Spark's freqItems looks for.
LEAST_SUPPORT = 1e-4


def by_document(docs: DataFrame, doc_col: str, text_col: str) -> DataFrame:
    """``docs`` dealt by document, to be tokenised afterwards.

    All rows of a document then lie in one partition, so its terms are counted
    there: the text is shuffled once, and not every (document, term) row. The
    number of partitions follows the bytes of the text.
    """
    n_bytes = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.repartition(max(least, -(-n_bytes // PARTITION_BYTES)), doc_col)


def term_frequency(docs: DataFrame, doc_col: str, terms_col: str) -> DataFrame:
    """(doc, term, tf): occurrences of each term in each document.

    Documents dealt by :func:`by_document` are counted where they are; others
    are shuffled by (document, term), after a partial aggregate that leaves
    one row of a document's repeated terms. ``explode_outer`` + an explicit
    null filter: a plain ``explode`` makes the optimizer infer a
    ``size(terms) > 0`` filter and push it, with the whole tokenizer
    expression inlined, down to the scan, where it runs a second time.
    """
    return (docs.select(doc_col, F.explode_outer(terms_col).alias(TERM))
            .where(F.col(TERM).isNotNull())
            .groupBy(doc_col, TERM).agg(F.count(F.lit(1)).alias("tf")))


def term_table(docs: DataFrame, doc_col: str, terms_col: str, written: bool = True) -> DataFrame:
    """:func:`term_frequency`, written once: statistics, weights and vectors
    read it, and the text is scanned and tokenised in this one pass. Not
    ``written``: for one reader, that makes what is kept from it."""
    counted = term_frequency(docs, doc_col, terms_col)
    return write_table(counted, "terms") if written else counted


def table_stats(table: DataFrame) -> DataFrame:
    """(term, tf, df) of a (doc, term, tf) table: corpus count and document frequency."""
    return table.groupBy(TERM).agg(F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df"))


def term_stats(docs: DataFrame, doc_col: str, terms_col: str) -> DataFrame:
    """(term, tf, df): corpus count and document frequency per term."""
    return table_stats(term_frequency(docs, doc_col, terms_col))


def vocabulary(stats: DataFrame, cap: int | None = None, min_df: int = 1, compact: bool = False) -> DataFrame:
    """(term, term_index, tf, df) of all terms, or of the ``cap`` most frequent.

    Order: tf descending, term ascending; one distributed sort with positions,
    whatever the size. There is no cap unless the caller asks for one.
    ``compact``: see :func:`row_index`.
    """
    kept = stats.where(F.col("df") >= F.lit(min_df))
    indexed = row_index(kept, [F.col("tf").desc(), F.col(TERM).asc()], TERM_INDEX, compact=compact)
    if cap is not None:
        indexed = indexed.where(F.col(TERM_INDEX) < F.lit(cap))
    return indexed.select(TERM, TERM_INDEX, "tf", "df")


def idf(stats: DataFrame, n_docs, *also: Column) -> DataFrame:
    """(term, *also, idf) with ``ln((N + 1) / (df + 1))``; ``n_docs`` a Column or int."""
    n = n_docs if not isinstance(n_docs, int) else F.lit(n_docs)
    return stats.select(TERM, *also, F.log((n + 1) / (F.col("df") + 1)).alias("idf"))


def frequent_terms(table: DataFrame, doc_col: str, n_docs: int, skew: SkewSpec) -> DataFrame | None:
    """(term, df) of at least the terms in ``skew.min_rows`` documents, without
    a shuffle of the table; None if there can't be any.

    Spark's ``freqItems`` names every term above a share of the rows, and some
    below it, from one pass; only their rows are counted then.
    """
    if n_docs < skew.min_rows:
        return None
    support = skew.min_rows / max(table.count(), 1)
    if support > 1:
        return None
    if support < LEAST_SUPPORT:
        return table_stats(table).where(F.col("df") >= F.lit(skew.min_rows)).select(TERM, "df")
    # a little below, as it names what lies above
    named = table.stat.freqItems([TERM], max(LEAST_SUPPORT, support * 0.9)).select(F.explode(f"{TERM}_freqItems").alias(TERM))
    rows = table.join(F.broadcast(named), TERM, "left_semi")
    found = write_table(rows.groupBy(TERM).agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= F.lit(skew.min_rows)), "frequent")
    return None if found.isEmpty() else found


def tfidf(table: DataFrame, doc_col: str, n_docs, stats: DataFrame | None = None,
          skew: SkewSpec = SkewSpec()) -> DataFrame:
    """(doc, term, tf, tfidf) of a (doc, term, tf) table.

    Document frequencies come from ``stats`` (default: the table's own), built
    on ``n_docs`` documents (a Column or int); terms without any are left out.
    No position of a term is needed.

    With the table's own statistics and a known number of documents the table
    is shuffled by term once, and a term's rows are counted where they meet;
    terms of very many documents don't move but get their counts by a join
    with their short list. With other statistics both sides grow with the
    corpus and are shuffled by term; terms of very many documents (their
    ``df`` says how many rows they have) are salted.
    """
    if stats is None and isinstance(n_docs, int):
        weight = lambda df: F.log((F.lit(n_docs) + 1) / (F.col(df) + 1))
        out = [doc_col, TERM, "tf", (F.col("tf") * weight("df")).alias("tfidf")]
        table = table.select(doc_col, TERM, "tf")
        if n_docs >= skew.min_rows:
            table = write_table(table, "terms")   # read three times
        often = frequent_terms(table, doc_col, n_docs, skew)
        rest = table if often is None else table.join(F.broadcast(often.select(TERM)), TERM, "left_anti")
        met = rest.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy(TERM))).select(*out)
        return met if often is None else met.unionByName(table.join(F.broadcast(often), TERM).select(*out))
    if stats is None:
        stats = write_table(table_stats(table), "term-stats")
    weights = idf(stats, n_docs)
    hot = hot_keys(stats, TERM, "df", skew)
    joined = table.join(weights, TERM, "inner") if hot.isEmpty() else salted_join(table, weights, TERM, hot)
    return joined.select(doc_col, TERM, "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))
