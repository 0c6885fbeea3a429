"""N-gram Jaccard self-join with Bayesian pruning of candidates.

A text's shingles are its runs of five words (lower-cased runs of letters,
digits and non-ASCII bytes; a text of one to four words is one shingle).
Texts with the same words are one class, represented by its smallest key.
Representatives get ``BANDS x ROWS`` MinHash values; two that agree on a
whole band are candidates (a pair at the threshold 0.8 is missed with a
probability of 3e-6). Candidate pairs are compared on more and more MinHash
values and dropped as soon as the posterior probability (uniform prior) of a
similarity of at least the threshold is under ``TOLERANCE``; what survives is
verified exactly on the shingle sets.

No pair leaves a task. Buckets of a band become star edges; a connected set
of candidates small enough for one task is compared there as a whole. A
larger one is compared bucket by bucket, in block pairs, each pair in the
first band it agrees on. A task returns the links per text and a spanning
forest of what it found; classes are the components of all forests.

Defined results: null and empty texts and texts without a word have no links
and are classes of their own; null ids and repeated rows are texts of their
own (see :func:`~revlens.llm.common.keyed`); other columns are ignored whatever
their names; a text of any length is one task's shingle set; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import (ALNUM, LOWER, PrefixHash, byte_column, components, doc_chunks, flat_ranges,
                                join_measured, keyed_texts, mix64, tidy, word_hashes, word_spans)
from revlens.session import write_table

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 5
STEP = 32               # MinHash values compared at a time
TOLERANCE = 1e-6
TASK_SHINGLES = 1 << 20  # shingles of a candidate set, or of a block, that one task compares
TASK_ROWS = 2048
_RNG = np.random.default_rng(77)
_FACTOR = _RNG.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def word_digests(part: np.ndarray, offsets: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(2, docs) halves of a BLAKE2 of each document's words, joined by spaces."""
    word = ALNUM[part]
    keep = word.copy()
    keep[ends[ends < len(part)]] = True   # one byte after each word stands for what parts it from the next
    raw = np.where(word, part, np.uint8(0x20))[keep].tobytes()
    cut = np.concatenate([[0], np.cumsum(keep)])[offsets].tolist()
    made = b"".join(hashlib.blake2b(raw[a:b].strip(b" "), digest_size=16).digest() for a, b in zip(cut[:-1], cut[1:]))
    return np.ascontiguousarray(np.frombuffer(made, np.uint64).reshape(-1, 2).T)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE):
    """(digests of the word sequences (2, docs), shingle hashes sorted and
    distinct per document, shingles before each document)."""
    part = LOWER[data]
    starts, ends, cut = word_spans(part, offsets, ALNUM)
    words = word_hashes(part, starts, ends)
    n = np.diff(cut)
    whole = word_digests(part, offsets, ends)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    begin = flat_ranges(cut[:-1], count)
    doc = np.repeat(np.arange(len(n)), count)
    stop = np.minimum(begin + size, cut[1:][doc])
    grams = mix64(PrefixHash(words).ranges(begin, stop) ^ (stop - begin).astype(np.uint64))
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    if len(grams):
        keep = np.concatenate([[True], (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])])
        grams, doc = grams[keep], doc[keep]
    return whole, grams, np.searchsorted(doc, np.arange(len(n) + 1))


def minhash(grams: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """(docs, BANDS * ROWS) uint32; zeros for a document without shingles."""
    out = np.zeros((len(cut) - 1, BANDS * ROWS), np.uint32)
    has = np.flatnonzero(np.diff(cut))
    if len(has):
        for k in range(BANDS * ROWS):
            h = ((grams * _FACTOR[k] + _SHIFT[k]) >> np.uint64(32)).astype(np.uint32)
            out[has, k] = np.minimum.reduceat(h, cut[has])
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """(docs, BANDS) 64-bit keys of bands."""
    key = np.zeros((len(sig), BANDS), np.uint64)
    for r in range(ROWS):
        key = mix64(key + sig[:, r::ROWS] + np.uint64(0x9E3779B97F4A7C15))
    return key + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(values compared, least matches to go on): with a uniform prior, the
    posterior of similarity >= t after m of n matches is P(Bin(n + 1, t) <= m)."""
    out = []
    for n in range(STEP, BANDS * ROWS + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = byte_column(batch.column(2))
        for lo, hi in doc_chunks(offsets):
            whole, grams, cut = shingle_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            sig = minhash(grams, cut)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                 *(pa.array(w.view(np.int64)) for w in whole), pa.array(np.diff(cut)),
                 pa.array([r.tobytes() for r in sig], pa.binary())], ["rid", "id", "w1", "w2", "n", "sig"])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sig = np.frombuffer(byte_column(batch.column(1))[0].tobytes(), np.uint32).reshape(len(batch), -1)
        keys = band_keys(sig)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.ravel().view(np.int64)), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(sig))),
             pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))], ["key", "band", "rep"])


def _payload(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """MinHash values and shingle sets of candidate representatives."""
    for batch in batches:
        data, offsets = byte_column(batch.column(batch.schema.get_field_index("text")))
        rest = batch.select([c for c in batch.schema.names if c != "text"])
        for lo, hi in doc_chunks(offsets):
            _, grams, cut = shingle_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            sig = minhash(grams, cut)
            sets = [grams[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays(
                [*rest.slice(lo, hi - lo).columns, pa.array([r.tobytes() for r in sig], pa.binary()),
                 pa.array(sets, pa.binary())], [*rest.schema.names, "sig", "grams"])


class _Sets:
    """The texts of a task: MinHash values, bands and shingles as local numbers."""

    def __init__(self, table: pa.Table):
        self.reps, self.mult = table.column("rep").to_numpy(), table.column("mult").to_numpy()
        self.sig = np.frombuffer(byte_column(table.column("sig"))[0].tobytes(), np.uint32).reshape(len(self.reps), -1)
        raw, off = byte_column(table.column("grams"))
        grams = np.frombuffer(raw.tobytes(), np.uint64)
        self.start, self.size = off[:-1] // 8, np.diff(off) // 8
        self.local = np.unique(grams, return_inverse=True)[1]
        self.seen = np.zeros(int(self.local.max(initial=-1)) + 1, bool)
        self.root = np.arange(len(self.reps))
        self.links = np.zeros(len(self.reps), np.int64)

    def compare(self, q: int, others: np.ndarray, threshold: float, rungs: list[tuple[int, int]]) -> None:
        """Link ``q`` with those of ``others`` that reach the threshold."""
        matches, done = np.zeros(len(others), np.int64), 0
        for n, least in rungs:
            matches += (self.sig[others, done:n] == self.sig[q, done:n]).sum(1)
            keep = matches >= least
            others, matches, done = others[keep], matches[keep], n
            if not len(others):
                return
        mine = self.local[self.start[q]:self.start[q] + self.size[q]]
        self.seen[mine] = True
        near = []
        budget = max(1, TASK_SHINGLES // max(1, int(self.size[others].max())))
        for lo in range(0, len(others), budget):
            part = others[lo:lo + budget]
            flags = self.seen[self.local[flat_ranges(self.start[part], self.size[part])]]
            common = np.add.reduceat(flags.astype(np.int64), np.cumsum(self.size[part]) - self.size[part])
            union = self.size[q] + self.size[part] - common
            near.append(part[common >= threshold * union - 1e-9])
        self.seen[mine] = False
        near = np.concatenate(near)
        if len(near):
            self.links[q] += self.mult[near].sum()
            self.links[near] += self.mult[q]
            members = np.unique(self.root[np.append(near, q)])
            if len(members) > 1:
                self.root[np.isin(self.root, members)] = members[0]

    def result(self) -> pa.Table:
        """(a, null, links) per linked text and (a, b, 0) per forest edge."""
        top = np.full(len(self.reps), np.iinfo(np.int64).max)
        np.minimum.at(top, self.root, self.reps)
        parent = top[self.root]
        counted, child = np.flatnonzero(self.links), np.flatnonzero(parent != self.reps)
        pad = np.arange(len(counted) + len(child)) < len(counted)
        return pa.table({"a": pa.array(np.concatenate([self.reps[counted], self.reps[child]])),
                         "b": pa.array(np.concatenate([np.zeros(len(counted), np.int64), parent[child]]), mask=pad),
                         "links": pa.array(np.concatenate([self.links[counted], np.zeros(len(child), np.int64)]))})


def _compare_all(threshold: float, rungs: list[tuple[int, int]]):
    """All pairs of a small candidate set."""
    def run(table: pa.Table) -> pa.Table:
        sets = _Sets(table)
        for q in range(len(sets.reps) - 1):
            sets.compare(q, np.arange(q + 1, len(sets.reps)), threshold, rungs)
        return sets.result()
    return run


def _compare_bucket(threshold: float, rungs: list[tuple[int, int]]):
    """The pairs of a block pair whose first common band is this bucket's."""
    def run(table: pa.Table) -> pa.Table:
        sets, block = _Sets(table), table.column("block").to_numpy()
        band, same = table.column("band")[0].as_py(), table.column("i")[0].as_py() == table.column("j")[0].as_py()
        earlier = band_keys(sets.sig)[:, :band]
        first = block == table.column("i")[0].as_py()
        for q in np.flatnonzero(first).tolist():
            others = np.arange(q + 1, len(block)) if same else np.flatnonzero(~first)
            met = np.zeros(len(others), bool)
            for b in range(band):
                met |= earlier[others, b] == earlier[q, b]
            sets.compare(q, others[~met], threshold, rungs)
        return sets.result()
    return run


def join_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                 tolerance: float = TOLERANCE) -> DataFrame:
    """(rid, id, class_rid, class_id, n_links): one row per document with its
    key, the smallest key of its class, and its number of links."""
    rows, plain = keyed_texts(docs, id_col, text_col)
    signed = write_table(rows.mapInArrow(tidy(_signatures), "rid long, id long, w1 long, w2 long, n long, sig binary"), "sig")
    rungs = least_matches(threshold, tolerance)
    classes = write_table(signed.where("n > 0").groupBy("w1", "w2")
                          .agg(F.min("rid").alias("rep"), F.count(F.lit(1)).alias("mult")), "classes")
    n = classes.count()
    reps = join_measured(signed.select(F.col("rid").alias("rep"), "n", "sig"), classes.select("rep", "mult"),
                         "rep", "inner", 16 * n)
    banded = reps.select("rep", "sig").mapInArrow(tidy(_bands), "key long, band int, rep long")
    buckets = write_table(banded.groupBy("key", "band").agg(
        F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("rep")).alias("members"), F.min("rep").alias("low"))
        .where("size > 1"), "buckets")
    # Buckets of the same texts in several bands: the first one is enough.
    kept = (buckets.groupBy("size", "members").agg(F.min(F.struct("band", "key", "low")).alias("b"))
            .select("b.key", "b.low", "size"))
    hits = write_table(join_measured(banded, kept, "key", "inner", 24 * buckets.count()), "hits")
    # Connected candidates, with their numbers of shingles.
    star = components(hits.select(F.col("rep").alias("a"), F.col("low").alias("b")))
    nodes = write_table(star.withColumnRenamed("node", "rep")
                        .join(reps.select("rep", "n", "mult"), "rep"), "nodes")
    sizes = nodes.groupBy("root").agg(F.sum("n").alias("all_n"), F.count(F.lit(1)).alias("all_rows"))
    nodes = write_table(nodes.join(sizes, "root").select(
        "rep", "mult", "root", "n", ((F.col("all_n") > TASK_SHINGLES) | (F.col("all_rows") > TASK_ROWS)).alias("big")),
        "members")
    texts = join_measured(rows.select(F.col("rid").alias("rep"), "text"), nodes, "rep", "inner", 40 * nodes.count())
    sets = write_table(texts.select("rep", "mult", "root", "big", "text").mapInArrow(
        tidy(_payload), "rep long, mult long, root long, big boolean, sig binary, grams binary"), "sets")
    out = "a long, b long, links long"
    small = sets.where("NOT big").groupBy("root").applyInArrow(_compare_all(threshold, rungs), out)
    large = hits.join(nodes.where("big").select("rep", "n"), "rep")
    shape = (large.groupBy("key").agg(F.greatest(F.ceil(F.count(F.lit(1)) / TASK_ROWS),
                                                 F.ceil(F.sum("n") / TASK_SHINGLES)).cast("int").alias("blocks")))
    blocked = (large.join(shape, "key")
               .withColumn("block", F.pmod(F.xxhash64("rep", F.lit(9)), F.col("blocks")).cast("int"))
               .select("key", "band", "rep", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
               .select("key", "band", "rep", "block", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j")))
    large = (blocked.join(sets.where("big").select("rep", "mult", "sig", "grams"), "rep")
             .groupBy("key", "i", "j").applyInArrow(_compare_bucket(threshold, rungs), out))
    found = write_table(small.unionByName(large), "links")
    links = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b IS NOT NULL")).select(F.col("node").alias("rep"), "root")
    judged = (classes.join(links, "rep", "left").join(roots, "rep", "left")
              .select("w1", "w2", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("links"),
                      F.coalesce("root", "rep").alias("root")))
    per = (signed.select("rid", "id", F.when(F.col("n") > 0, F.col("w1")).alias("w1"), "w2")
           .join(judged, ["w1", "w2"], "left")
           .select("rid", "id", F.coalesce("root", "rid").alias("class_rid"),
                   F.coalesce("links", F.lit(0)).cast("long").alias("n_links")))
    if plain:
        return per.withColumn("class_id", F.col("class_rid"))
    names = signed.select(F.col("rid").alias("class_rid"), F.col("id").alias("class_id"))
    return per.join(names, "class_rid")
