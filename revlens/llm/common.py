"""Helpers shared by the corpus operators.

Texts travel as Arrow buffers and are handled as whole byte arrays with
numpy; a chunk holds whole documents and about ``CHUNK_BYTES`` bytes, so the
memory of a task follows the longest document, not the partition.
"""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.operators.indexing import row_index
from revlens.session import write_table

CHUNK_BYTES = 1 << 20
# A side is broadcast only when its rows were counted and fit in this many bytes.
BROADCAST_BYTES = 48 << 20
# What one task of a shuffle with an explicit number of partitions should read.
SHUFFLE_BYTES = 128 << 20


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores appended until ``df`` has no such column
    (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str, bool]:
    """(docs with a unique long key in the order of the ids, name of the key
    column, whether the key is the id itself).

    Normally it is. If an id is null or repeated, rows are numbered in the
    order (id, nulls last, text) instead, so each row stays a document of its
    own and a repeated row comes after its original.
    """
    key, number = fresh(docs, "rid"), col(id_col).cast("long")
    odd = (docs.select(number.alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
           .where((F.col("n") > 1) | F.col("id").isNull()))
    if odd.isEmpty():
        return docs.withColumn(key, number), key, True
    return row_index(docs, [number.asc_nulls_last(), col(text_col).asc_nulls_first()], key), key, False


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """(rid, id, text) of :func:`keyed`, null texts as empty ones."""
    rows, key, plain = keyed(docs, id_col, text_col)
    return rows.select(col(key).cast("long").alias("rid"), col(id_col).cast("long").alias("id"),
                       F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text")), plain


def join_measured(left: DataFrame, right: DataFrame, on: str | list[str], how: str,
                  right_bytes: int) -> DataFrame:
    """Join; ``right`` is broadcast only if its measured size is small,
    otherwise both sides are shuffled (AQE splits skewed partitions)."""
    if right_bytes <= BROADCAST_BYTES:
        right = F.broadcast(right)
    return left.join(right, on, how)


def tasks_for(spark: SparkSession, n_bytes: float) -> int:
    """Partitions for a shuffle of ``n_bytes``: the session's number, and more
    where a task would get over ``SHUFFLE_BYTES`` (an explicit number is never
    split at run time)."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(-(-n_bytes // SHUFFLE_BYTES)))


def task_count(df: DataFrame, size: Column, factor: float) -> int:
    """:func:`tasks_for` ``factor`` times the summed ``size`` of ``df``."""
    total = df.agg(F.sum(size.cast("long"))).first()[0] or 0
    return tasks_for(df.sparkSession, total * factor)


def tidy(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``fn`` for mapInArrow; at the end of a task the worker, which lives on
    for other tasks, gives back the memory it has freed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if sys.platform == "linux":
                with contextlib.suppress(OSError, AttributeError):  # another C library
                    ctypes.CDLL("libc.so.6").malloc_trim(0)
    return run


# -- bytes ----------------------------------------------------------------------

def byte_column(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; null counts as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null(b"" if pa.types.is_binary(array.type) or
                                pa.types.is_large_binary(array.type) else "")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)
    off = off[array.offset:array.offset + len(array) + 1].astype(np.int64)
    body = array.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def doc_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about ``limit`` bytes."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def byte_table(members) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


# Fixed word classes of the contracts.
NOT_SPACE = byte_table(b for b in range(256) if b not in (0x20, 9, 10, 11, 12, 13))
ALNUM = byte_table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray,
               members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each document) of maximal runs of member
    bytes; a run never crosses a document."""
    inside = members[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = offsets[:-1][np.diff(offsets) > 0]
    first[edge] = inside[edge]
    last[edge[1:] - 1] = inside[edge[1:] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SYMBOL = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept by base."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        out = np.ones(max(n, 1 << 16), np.uint64)
        done, step = 1, base
        while done < len(out):
            more = min(done, len(out) - done)
            out[done:done + more] = out[:more] * np.uint64(step)
            done, step = done + more, step * step % (1 << 64)
        if n <= 4 * CHUNK_BYTES:
            _POWERS[base] = out
        have = out
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


class PrefixHash:
    """Polynomial hashes of any range of a symbol sequence, modulo 2^64.

    For ranges of fixed, small length (grams, windows): sequences of 1024 and
    more symbols that alternate like the Thue-Morse word collide in it."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * powers(_BASE, n), out=self.sums[1:])
        self.inverse = powers(_INVERSE, n + 1)

    @classmethod
    def of_bytes(cls, data: np.ndarray) -> "PrefixHash":
        return cls(_SYMBOL[data])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of [start, end), equal for equal content wherever it stands."""
        return (self.sums[ends] - self.sums[starts]) * self.inverse[starts]

    def windows(self, size: int) -> np.ndarray:
        """Hash of every window of ``size`` symbols."""
        n = len(self.sums) - 1
        if n < size:
            return np.zeros(0, np.uint64)
        return (self.sums[size:] - self.sums[:n - size + 1]) * self.inverse[:n - size + 1]


# Words of up to this many bytes are hashed in 8-byte blocks, longer ones one by one.
_BLOCK_WORD = 64
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _blocks(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position on as a little-endian number, zeros
    after the end (an unaligned view, no copy for each position)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word's bytes; another ``seed``, an independent one.

    Not a polynomial: those modulo 2^64 collide on Thue-Morse words whatever
    the base. Blocks of eight bytes are mixed in one after another, each by a
    bijection, so words of one length up to eight never collide; words over 64
    bytes get a keyed BLAKE2.
    """
    size = ends - starts
    h = mix64(size.astype(np.uint64) + np.uint64((0xA24BAED4963EE407 * (2 * seed + 1)) % (1 << 64)))
    blocks = _blocks(data)
    todo = np.flatnonzero((size > 0) & (size <= _BLOCK_WORD))
    at = starts[todo]
    left = size[todo]
    while len(todo):
        block = blocks[at] & _LOW_BYTES[np.minimum(left, 8)]
        h[todo] = mix64((h[todo] ^ block) + np.uint64(0x9FB21C651E98DF25))
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    key = seed.to_bytes(8, "little")
    for i in np.flatnonzero(size > _BLOCK_WORD).tolist():
        word = data[starts[i]:ends[i]].tobytes()
        h[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8, key=key).digest(), "little")
    return h


def same_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray,
               other_starts: np.ndarray, other_ends: np.ndarray) -> np.ndarray:
    """Whether each word has the bytes of its counterpart in ``other``."""
    size = ends - starts
    same = size == other_ends - other_starts
    mine, theirs = _blocks(data), _blocks(other) if other is not data else None
    theirs = mine if theirs is None else theirs
    todo = np.flatnonzero(same & (size > 0) & (size <= _BLOCK_WORD))
    a, b, left = starts[todo], other_starts[todo], size[todo]
    while len(todo):
        equal = ((mine[a] ^ theirs[b]) & _LOW_BYTES[np.minimum(left, 8)]) == 0
        same[todo[~equal]] = False
        more = equal & (left > 8)
        todo, a, b, left = todo[more], a[more] + 8, b[more] + 8, left[more] - 8
    for i in np.flatnonzero(same & (size > _BLOCK_WORD)).tolist():
        same[i] = np.array_equal(data[starts[i]:ends[i]], other[other_starts[i]:other_ends[i]])
    return same


def runs(keys: np.ndarray) -> np.ndarray:
    """Starts of runs of equal neighbours."""
    if not len(keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))


def flat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, .. of every (start, length), one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def merge_intervals(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals, touching ones joined."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate([[True], s[1:] > e[:-1]])
    last = np.concatenate([first[1:], [True]])
    return s[first], e[last]


# -- connected components -------------------------------------------------------

def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node of ``edges`` and the smallest node it reaches.

    Large-star / small-star rounds: each round replaces edges by edges to
    smaller neighbours until every node hangs off its root. A round is two
    grouped minima (combined before their shuffle) and two joins by node
    (AQE splits a hub's rows); nothing but a changed flag reaches the driver.
    Each round's edges are written to the shared folder.
    """
    u, v = col(a).cast("long"), col(b).cast("long")
    now = write_table(edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
                      .where("u <> v").distinct(), "cc")
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: larger neighbours of u move to u's smallest neighbour
        large = (now.select(F.col("v").alias("u"), F.col("u").alias("w")).join(low, "u")
                 .select(F.col("w").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        large = write_table(large, "cc")
        # small star: u and its smaller neighbours move to the smallest of them
        best = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(best, "u")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(best.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        after = write_table(small, "cc")
        same = (after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
                == now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        now = after
        if same:
            break
    child = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return child.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
