"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)``, works on all that the stage
before kept, and returns a DataFrame; all but the last return the columns of
``documents``. :func:`run` writes every stage's result to the shared folder
and reads it back as the next one's input.

Extra columns pass through; null texts and ids, empty and repeated rows have
the results that the operators' docstrings define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import langid, mixing, ngram_join, packing, substring_dedup
from revlens.llm.common import col, fresh, join_measured, keyed, load, task_count
from revlens.llm.queries import tokenizer_path
from revlens.session import write_table

# Rows of an Arrow batch: whole texts are long, and Spark's 10,000 of them a
# task, twice in the JVM and once in Python, crowd an executor of 3 GB.
ARROW_ROWS = 2000

# A document goes if no learned language has at least this posterior, or if it
# does not fit the one that has (see langid).
MIN_POSTERIOR = 0.5


def _small_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > ARROW_ROWS or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(ARROW_ROWS))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; null texts, texts without a
    letter, texts that no language claims and texts that fit the claiming
    language worse than its own documents do go."""
    _small_batches(spark)
    langs, matrix, bars = langid.fit_open_fold_with_bars(docs)
    told = langid.predict(docs, langs, matrix, bars=bars)
    name, score, fits = told.columns[-3:]
    return (told.where((col(name) != langid.UNKNOWN) & (col(score) >= MIN_POSTERIOR) & col(fits))
            .select(*[col(c) for c in docs.columns]))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document (by id) of every class of near-duplicates."""
    _small_batches(spark)
    rows, key, _ = keyed(docs, "doc_id", "text")
    classes = ngram_join.join_classes(rows, key, "text")
    gone = write_table(classes.where("class_rid <> rid").select(F.col("rid").alias(key)), "duplicates")
    return (join_measured(rows, gone, key, "left_anti", 8 * gone.count())
            .select(*[col(c) for c in docs.columns]))


def _with_n_chars(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                           .otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without the windows of 50 words that also
    start in a document with a smaller id."""
    _small_batches(spark)
    return _with_n_chars(substring_dedup.remove(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies of documents that the mix takes, in training order.

    A source that is asked for more than it has comes in several copies per
    document, one asked for less keeps some; the copy on which a source's
    target ends is cut to the words that are left.
    """
    _small_batches(spark)
    rows, key, _ = keyed(docs, "doc_id", "text")
    plan = mixing.plan_mix(mixing.sized_documents(rows, key))
    order = write_table(mixing.curriculum(plan).select("doc_id", "words", "size", "place"), "order")
    n = order.count()
    parts = task_count(rows, F.coalesce(F.octet_length("text"), F.lit(0)), 1)  # the mix is as large as what it mixes
    place, words, size = (fresh(rows, c) for c in ("place", "words", "size"))
    asked = order.select(F.col("doc_id").alias(key), F.col("place").alias(place), F.col("words").alias(words),
                         F.col("size").alias(size))
    texts = join_measured(rows, asked, key, "inner", 32 * n)
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(mixing.WORD), 0), 1, col(words).cast("int")), " ")
    texts = texts.withColumn("text", F.when(col(words) < col(size), cut).otherwise(F.col("text")))
    bucket = F.floor(col(place) * F.lit(parts) / F.lit(max(n, 1))).cast("int")
    dealt = texts.repartitionById(parts, bucket).sortWithinPartitions(place)
    return _with_n_chars(dealt.select(*[col(c) for c in docs.columns]))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and offset."""
    _small_batches(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates),
          ("repeated_passages", repeated_passages), ("source_mix", source_mix), ("pack", pack)]

# Naive Bayes, near-duplicate classes and tokenisation are not SQL; the stages
# are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
