"""Document fingerprints by consistent weighted sampling.

Terms are words (runs of bytes other than ASCII white space), weighted by how
often they occur. For sample k a term of weight w draws, from its hash alone,
r ~ Gamma(2,1), c ~ Gamma(2,1) and b ~ U(0,1); with t = floor(ln w / r + b)
its value is ln a = ln c - r (t - b + 1), and the sample is the (term, t) of
the smallest value. Two texts agree in a sample with a probability equal to
their generalised Jaccard similarity (sum of minima over sum of maxima).

The variates come from 64-bit mixes of the term's hash and the sample's
number, so every term has its own, however many terms a text has; terms that
stand in several texts of a chunk with one weight are drawn once. Equal values
are told apart by the term's hash. A sample is kept as 16 bits.

The edited text takes the place of a document's last half by the beginning
of the next document in descending id. Rows go to buckets of neighbouring
ids, the largest id of a bucket also to the bucket before it, so each text
crosses the shuffle once and no global window is needed.

Defined results: null text counts as empty; texts without a term have a
fingerprint of zeros (likeness 1 with each other, 0 with others); null ids
come last in descending order; rows with equal ids stand in the order of
their texts; a lone document is its own next; other columns are ignored
whatever their names; a text of any length is one task's; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import (CHUNK_BYTES, NOT_SPACE, keyed_texts, mix64, runs, tasks_for, tidy, word_hashes,
                                word_spans)

SAMPLES = 64
SEED = 0x9E3779B97F4A7C15


def _uniforms(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two uniform draws in (0, 1) from each 64-bit seed."""
    bits = mix64(seeds)
    return ((bits >> np.uint64(32)) + 0.5) / 2.0 ** 32, ((bits & np.uint64(0xFFFFFFFF)) + 0.5) / 2.0 ** 32


def _ordered(values: np.ndarray) -> np.ndarray:
    """float32 -> uint64 of the same order, in the upper 32 bits."""
    bits = values.view(np.uint32)
    flip = np.where(bits >> np.uint32(31), np.uint32(0xFFFFFFFF), np.uint32(0x80000000))
    return (bits ^ flip).astype(np.uint64) << np.uint64(32)


def weighted_samples(terms: np.ndarray, weights: np.ndarray, starts: np.ndarray,
                     samples: int = SAMPLES) -> np.ndarray:
    """(sets, samples) uint16; set i holds the terms from starts[i] on."""
    out = np.empty((len(starts), samples), np.uint16)
    order = np.lexsort((weights, terms))
    first = runs_of_pairs(terms[order], weights[order])
    place = np.empty(len(terms), np.int64)
    place[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(terms))))
    terms, log_w = terms[order][first], np.log(weights[order][first])
    name = mix64(terms) & np.uint64(0xFFFFFFFF)
    for k in range(samples):
        seeds = terms ^ mix64(np.array([SEED + 3 * k + i for i in range(3)], np.uint64))[:, None]
        (u1, u2), (u3, u4), (b, _) = (_uniforms(x) for x in seeds)
        r, c = -np.log(u1 * u2), -np.log(u3 * u4)
        t = np.floor(log_w / r + b)
        value = (np.log(c) - r * (t - b + 1)).astype(np.float32)
        step = (t.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)
        key = _ordered(value) | (name ^ step)
        least = np.minimum.reduceat(key[place], starts) & np.uint64(0xFFFFFFFF)
        out[:, k] = (mix64(least) >> np.uint64(48)).astype(np.uint16)
    return out


def runs_of_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Starts of runs of equal neighbours in both of two arrays of one length."""
    return np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))


def fingerprints(texts: list[bytes], samples: int = SAMPLES) -> np.ndarray:
    """(texts, samples) uint16 signatures; zeros for a text without a term."""
    out = np.zeros((len(texts), samples), np.uint16)
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    starts, ends, cut = word_spans(data, offsets, NOT_SPACE)
    if not len(starts):
        return out
    doc = np.repeat(np.arange(len(texts)), np.diff(cut))
    words = word_hashes(data, starts, ends)
    order = np.lexsort((words, doc))
    words, doc = words[order], doc[order]
    first = runs_of_pairs(words, doc)
    weights = np.diff(np.append(first, len(words))).astype(np.float64)
    words, doc = words[first], doc[first]
    begin = runs(doc)
    out[doc[begin]] = weighted_samples(words, weights, begin, samples)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of agreeing samples, row by row."""
    return (a == b).mean(axis=-1)


def edit(text: str, following: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by the first as
    many (or all) of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def _with_next(rows: Iterator[tuple]) -> Iterator[tuple[tuple, tuple]]:
    """(row, next row of its bucket) for every row that isn't a neighbour's copy."""
    before = None
    for row in rows:  # (bucket, is copy, id, text)
        if before is not None:
            if before[0] != row[0]:
                raise RuntimeError("a bucket has no following row")
            yield before, row
        before = None if row[1] else row
    if before is not None:
        raise RuntimeError("a bucket has no following row")


def _fingerprint_rows(samples: int):
    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[tuple, tuple]] = []
        size = 0
        for pair in _with_next(rows_of(batches)):
            held.append(pair)
            size += len(pair[0][3])
            if size >= CHUNK_BYTES:
                yield _finish(held, samples)
                held, size = [], 0
        if held:
            yield _finish(held, samples)

    return run


def _finish(pairs: list[tuple[tuple, tuple]], samples: int) -> pa.RecordBatch:
    """Rows in order; the row after each is the next row of the list where it
    belongs to the same bucket, so most texts are hashed once."""
    texts, own, after, last = [], [], [], None
    for row, following in pairs:
        if last is not row:
            texts.append(row[3])
        own.append(len(texts) - 1)
        texts.append(following[3])
        after.append(len(texts) - 1)
        last = following
    edited = [edit(row[3], following[3]) for row, following in pairs]
    prints = fingerprints([t.encode() for t in texts + edited], samples)
    prints, changed = prints[:len(texts)], prints[len(texts):]
    mine = prints[own]
    return pa.RecordBatch.from_arrays([
        pa.array([row[2] for row, _ in pairs], pa.int64()),
        pa.array([len(row[3]) for row, _ in pairs], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
        pa.array([x.astype(">u2").tobytes().hex() for x in mine]),
        pa.array([x.astype(">u2").tobytes().hex() for x in changed]),
        pa.array(likeness(mine, changed)), pa.array(likeness(mine, prints[after]))],
        [f.split()[0] for f in OUT.split(", ")])


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness."""
    spark = docs.sparkSession
    rows, _ = keyed_texts(docs, id_col, text_col)
    n, size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text").cast("long"))).first()
    if not n:
        return spark.createDataFrame([], OUT)
    parts = tasks_for(spark, size)
    buckets = max(1, min(8 * parts, n))
    # Boundaries from about 20 sampled keys a bucket, as a range partitioner draws them.
    every = max(1, n // (20 * buckets))
    drawn = np.sort(rows.where(F.pmod(F.xxhash64("rid"), F.lit(every)) == 0).select("rid").toArrow()
                    .column("rid").to_numpy())
    bounds = np.unique(drawn[np.linspace(0, len(drawn), buckets, endpoint=False).astype(int)[1:]]) \
        if len(drawn) else np.zeros(0, np.int64)
    tops = (rows.select("rid").mapInArrow(tidy(_bucket_tops(bounds)), "bucket int, top long")
            .groupBy("bucket").agg(F.max("top").alias("top")).orderBy("bucket").collect())
    # In descending order the largest key of a bucket follows the last row of the next larger bucket.
    goes = {r["top"]: tops[(i + 1) % len(tops)]["bucket"] for i, r in enumerate(tops)}
    dealt = (rows.mapInArrow(tidy(_deal(bounds, goes)), "bucket int, copy boolean, rid long, id long, text string")
             .repartition(parts, "bucket").sortWithinPartitions("bucket", "copy", F.col("rid").desc()))
    return dealt.select("bucket", "copy", "id", "text").mapInArrow(tidy(_fingerprint_rows(samples)), OUT)


def _bucket_tops(bounds: np.ndarray):
    """(bucket, largest key) of every bucket a task sees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.sort(batch.column(0).to_numpy())
            bucket = np.searchsorted(bounds, keys, "right")
            last = np.append(runs(bucket)[1:], len(keys)) - 1 if len(keys) else runs(bucket)
            yield pa.RecordBatch.from_arrays([pa.array(bucket[last].astype(np.int32)), pa.array(keys[last])],
                                             ["bucket", "top"])
    return run


def _deal(bounds: np.ndarray, goes: dict[int, int]):
    """Every row to its bucket; a bucket's largest key also to the bucket it follows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            also = np.array([i for i, k in enumerate(keys.tolist()) if k in goes], np.int64)
            bucket = np.concatenate([np.searchsorted(bounds, keys, "right"),
                                     [goes[int(keys[i])] for i in also]]).astype(np.int32)
            table = pa.concat_tables([pa.Table.from_batches([batch]),
                                      pa.Table.from_batches([batch]).take(pa.array(also))]).combine_chunks()
            copy = np.arange(len(bucket)) >= len(keys)
            out = pa.Table.from_arrays([pa.array(bucket), pa.array(copy), *(c for c in table.columns)],
                                       ["bucket", "copy", "rid", "id", "text"])
            yield from out.to_batches()
    return run
