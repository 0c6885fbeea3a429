"""Sparse feature vectors and model coefficients without a driver vocabulary.

A document's vector comes from the (document, term, count) table: joined with
the terms' positions and weights by a shuffle on the term, grouped by document.
Terms stay in rows from the text to the vector; their number is limited by
the int positions of an ML vector alone. The vectors are laid out as ML
vectors are stored and written once, so fits, scores and other sides of a
split read them instead of the text.

The same matrix by columns (:func:`term_columns`): a row for each term, with the
positions of its documents and its counts there, from one shuffle of the table.
The linear fits read it so.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.operators.indexing import row_index
from revlens.operators.joins import small_side
from revlens.operators.sampling import hash_bucket, split_bounds
from revlens.operators.skew import SkewSpec, hot_keys, salted_join
from revlens.operators.svm import Samples
from revlens.operators.vocab import TERM, TERM_INDEX, idf
from revlens.session import scratch_path, write_table

FEATURES_MAX = 2**31 - 1
COEFFICIENT_BLOCK = 1 << 16


def sparse_features(docs: DataFrame, table: DataFrame, vocab: DataFrame, n_docs: int, doc_col: str,
                    out_col: str = "features", skew: SkewSpec = SkewSpec()) -> DataFrame:
    """``docs`` with the tf-idf vector of each row's terms, written once.

    ``docs`` holds ``doc_col`` (a key) and what is to be kept; ``table`` is
    (doc, term, tf); ``vocab`` (term, term_index, tf, df) was built on
    ``n_docs`` documents. Documents without a term of the vocabulary get an
    empty vector.
    """
    size = vocab.agg(F.max(TERM_INDEX)).first()[0]
    if size is None:
        raise ValueError("empty vocabulary: the fitted documents hold no terms")
    size += 1
    if size > FEATURES_MAX:
        raise ValueError(f"{size} terms do not fit the int positions of a vector: set min_df or vocab_cap")
    index = idf(vocab, n_docs, F.col(TERM_INDEX).cast("int").alias("i"))
    hot = hot_keys(vocab, TERM, "df", skew)
    terms = table.select(doc_col, TERM, "tf")
    joined = terms.join(index, TERM) if hot.isEmpty() else salted_join(terms, index, TERM, hot)
    entry = F.struct("i", (F.col("tf") * F.col("idf")).alias("x"))
    grouped = joined.groupBy(doc_col).agg(F.array_sort(F.collect_list(entry)).alias("e"))
    none = F.array().cast("array<struct<i:int,x:double>>")
    entries = F.coalesce("e", none)
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).cast("int").alias("size"),
                      F.transform(entries, lambda e: e["i"]).alias("indices"),
                      F.transform(entries, lambda e: e["x"]).alias("values"))
    kept = [f for f in docs.schema.fields if f.name != out_col]
    whole = docs.join(grouped, doc_col, "left").select(*[f.name for f in kept], vector.alias(out_col))
    spark = docs.sparkSession
    path = scratch_path(spark, "features")
    whole.write.parquet(path)
    # the columns of an ML vector, read back as one
    schema = T.StructType([*kept, T.StructField(out_col, VectorUDT())])
    return spark.read.schema(schema).parquet(path)


def in_few_parts(df: DataFrame) -> DataFrame:
    """``df`` in no more partitions than the cluster has cores: in every round
    of a linear fit each partition sends vectors of one double per term."""
    return df.coalesce(max(2, df.sparkSession.sparkContext.defaultParallelism))


def coefficient_rows(spark: SparkSession, coefficients) -> DataFrame:
    """(term_index, weight) of a model's coefficients.

    The vector, which ML keeps on the driver, is cut into blocks, one row
    each, that tasks unfold.
    """
    values = coefficients.toArray()
    starts = list(range(0, len(values), COEFFICIENT_BLOCK))
    blocks = pa.table({"first": pa.array(starts, pa.int64()),
                       "w": pa.array([values[s:s + COEFFICIENT_BLOCK] for s in starts], pa.list_(pa.float64()))})
    parts = max(1, min(len(starts), 4 * spark.sparkContext.defaultParallelism))
    rows = spark.createDataFrame(blocks).repartition(parts)
    return (rows.select("first", F.posexplode("w").alias("k", "weight"))
            .select((F.col("first") + F.col("k")).alias(TERM_INDEX), "weight"))


POSITION = "_rl_pos"


def in_first_part(doc_col: str, weights: Sequence[float], seed: int) -> Column:
    """Whether a row lies in the first part of :func:`hash_split`."""
    return hash_bucket([doc_col], seed) < F.lit(split_bounds(weights)[0])


def number_documents(docs: DataFrame, doc_col: str, first: Column) -> tuple[DataFrame, int, int]:
    """((doc, position), how many, how many of them ``first``): those come first,
    each part in the order of the ids. Null ids have no position."""
    ids = docs.where(F.col(doc_col).isNotNull()).select(doc_col, (~first).alias("_late")).distinct()
    numbers = write_table(row_index(ids, ["_late", doc_col], POSITION).select(
        doc_col, F.col(POSITION).cast("int").alias(POSITION), "_late"), "documents")
    total, late = numbers.agg(F.count(F.lit(1)), F.count_if("_late")).first()
    return numbers.select(doc_col, POSITION), total, total - late


def samples(docs: DataFrame, numbers: DataFrame, total: int, doc_col: str, label_col: str) -> Samples:
    """The training rows of ``docs``. Rows with one id have one vector, rows with a
    null id an empty one, which is at the last position, ``total``."""
    rows = (docs.groupBy(doc_col, label_col).agg(F.count(F.lit(1)).alias("c")).join(numbers, doc_col, "left")
            .select(F.coalesce(POSITION, F.lit(total)).alias("p"), F.col(label_col).cast("double").alias("y"), "c").toArrow())
    pos, y, c = (rows.column(k).to_numpy() for k in range(3))
    if rows.column(1).null_count or not np.isin(y, (0, 1)).all():
        raise ValueError(f"{label_col} holds other values than 0 and 1")
    if not len(pos):
        raise ValueError("no document falls on the training side")
    order = np.lexsort((y, pos))
    return Samples(pos[order].astype(np.int64), np.where(y[order] > 0, 1, -1), c[order].astype(np.float64), total + 1)


def _whole(t: pa.Table, k: int) -> pa.Array:
    got = t.column(k).combine_chunks()
    return got.chunk(0) if isinstance(got, pa.ChunkedArray) else got


def _new(a: pa.Array) -> np.ndarray:
    """Where a value differs from the one before it."""
    return np.concatenate([[True], pc.not_equal(a.slice(1), a.slice(0, len(a) - 1)).to_numpy(zero_copy_only=False)])


def _to_columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, tf, df, pos, n) of rows (term, pos, n, counted, hash of the term) in
    the order of the hashes. Terms of one hash are told apart here."""
    held: list[pa.RecordBatch] = []

    def out(t: pa.Table) -> pa.RecordBatch:
        hashes, terms = _new(_whole(t, 4)), _new(_whole(t, 0))
        if (terms & ~hashes).any():
            t = t.take(pc.sort_indices(t, sort_keys=[("h", "ascending"), (TERM, "ascending")]))
            terms = _new(_whole(t, 0))
        starts = np.flatnonzero(terms)
        pos, n, counted = (_whole(t, k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
        order = np.argsort((np.cumsum(terms) << 32) + pos, kind="stable")
        pos, n, counted = pos[order], n[order], counted[order]
        df = np.add.reduceat(counted.astype(np.int64), starts)
        tf = np.add.reduceat(np.where(counted, n, 0).astype(np.int64), starts)
        sel = np.flatnonzero(df > 0)
        kept = (pos >= 0) & np.repeat(df > 0, np.diff([*starts, len(pos)]))
        many = np.add.reduceat(kept.astype(np.int64), starts)[sel]
        bounds = pa.py_buffer(np.concatenate([[0], np.cumsum(many) * 4]).astype(np.int32).tobytes())
        flat = [pa.Array.from_buffers(pa.binary(), len(sel), [None, bounds, pa.py_buffer(x[kept].astype(np.int32).tobytes())])
                for x in (pos, n)]
        return pa.RecordBatch.from_arrays([_whole(t, 0).take(pa.array(starts[sel])), pa.array(tf[sel]), pa.array(df[sel]), *flat],
                                          [TERM, "tf", "df", "pos", "n"])

    for b in batches:
        if not b.num_rows:
            continue
        if held and held[0].column(4)[0] == b.column(4)[b.num_rows - 1]:
            held.append(b)   # all of it has the hash that is held
            continue
        t = pa.Table.from_batches([*held, b])
        last = int(np.flatnonzero(_new(_whole(t, 4)))[-1])
        held = t.slice(last).to_batches()
        if last:
            yield out(t.slice(0, last))
    if held:
        yield out(pa.Table.from_batches(held))


def term_columns(table: DataFrame, numbers: DataFrame, n_numbers: int, doc_col: str, counted: Column,
                 kept: Column | None = None) -> DataFrame:
    """(term, tf, df, pos, n) of a (doc, term, tf) table, written once.

    A row for each term of the documents for which ``counted`` holds, with their
    ``tf`` and ``df``; ``pos`` and ``n`` are the positions of its documents, in
    their order, and its counts there, as bytes of 32-bit whole numbers.
    ``kept``: which positions are to be listed (default: all).
    """
    rows = table.join(small_side(numbers, n_numbers), doc_col, "left")
    at = F.col(POSITION) if kept is None else F.when(kept, F.col(POSITION))
    rows = rows.select(TERM, F.coalesce(at, F.lit(-1)).alias("pos"), F.col("tf").cast("int").alias("n"), counted.alias("counted"))
    # one number to sort by, which costs a fraction of a sort of texts
    dealt = rows.where("counted OR pos >= 0").repartition(TERM).withColumn("h", F.xxhash64(TERM)).sortWithinPartitions("h")
    return write_table(dealt.mapInArrow(_to_columns, f"{TERM} string, tf long, df long, pos binary, n binary"), "columns", "zstd")


def position_values(spark: SparkSession, values: np.ndarray, name: str) -> DataFrame:
    """(position, name) of an array by document position."""
    return spark.createDataFrame(pa.table({POSITION: pa.array(np.arange(len(values), dtype=np.int32)), name: pa.array(values)}))
