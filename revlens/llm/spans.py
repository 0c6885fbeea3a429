"""Shared by the two substring operators: anchors of windows, removed spans.

Every window of ``w`` symbols is filed under an anchor: the smallest hash of
the ``q``-grams inside it. Equal windows have equal anchors, so windows need
only be compared under the same anchor, and neighbouring windows mostly share
one, which makes one row of a run of windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import (flat_ranges, join_measured, merge_intervals, runs, tasks_for, tidy)
from revlens.session import write_table

MAX_RUN = 1 << 15   # windows of a run; longer ones are split
SPAN_BYTES = 32     # a shuffled interval


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    out, have = h, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def window_runs(h: np.ndarray, window: int, gram: int, cut: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first window, number of windows, anchor, document) of every run.

    ``h`` are the hashes of all ``gram``-grams of the symbols, ``cut`` the
    symbols before each document. Within a run the leftmost anchor stays at
    one place.
    """
    low = sliding_min(h, window - gram + 1) if len(h) >= window - gram + 1 else h[:0]
    n = np.diff(cut)
    count = np.maximum(n - window + 1, 0)
    at = flat_ranges(cut[:-1], count)
    doc = np.repeat(np.arange(len(n)), count)
    if not len(at):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64), z
    m = low[at]
    new = np.concatenate([[True], (m[1:] != m[:-1]) | (h[at[:-1]] == m[:-1]) | (doc[1:] != doc[:-1])])
    first = np.flatnonzero(new)
    if len(at) > MAX_RUN:
        offset = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        first = np.flatnonzero(new | (offset % MAX_RUN == 0))
    size = np.diff(np.append(first, len(at)))
    return at[first], size, m[first], doc[first]


def write_spans(found: DataFrame, n: int) -> DataFrame:
    """(rid, los, his): the union of the intervals (rid, lo, hi) of each
    document, in the shared folder. A document's intervals meet in one task;
    their number is bounded by its length. ``found`` has at most ``n`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows = 0
        for batch in batches:
            held.append(np.stack([c.to_numpy() for c in batch.columns]))
            rows += len(batch)
            if rows < 200_000:
                continue
            block = np.concatenate(held, axis=1)
            last = np.searchsorted(block[0], block[0, -1])  # the last document may go on
            if last:
                yield flush(block[:, :last])
            held, rows = [block[:, last:]], 0 if last else rows
        if held:
            block = np.concatenate(held, axis=1)
            if block.shape[1]:
                yield flush(block)

    def flush(block: np.ndarray) -> pa.RecordBatch:
        first = np.append(runs(block[0]), block.shape[1])
        los, his = [], []
        for a, b in zip(first[:-1], first[1:]):
            s, e = merge_intervals(block[1, a:b], block[2, a:b])
            los.append(s)
            his.append(e)
        return pa.RecordBatch.from_arrays([pa.array(block[0, first[:-1]]), pa.array(los, pa.list_(pa.int64())),
                                           pa.array(his, pa.list_(pa.int64()))], ["rid", "los", "his"])

    parts = tasks_for(found.sparkSession, n * SPAN_BYTES)
    return write_table(found.select("rid", "lo", "hi").repartition(parts, "rid").sortWithinPartitions("rid", "lo")
                       .mapInArrow(tidy(run), "rid long, los array<long>, his array<long>"), "spans")


def with_spans(rows: DataFrame, spans: DataFrame, key: str = "rid", los: str = "los",
               his: str = "his") -> DataFrame:
    """``rows`` with the spans of their key (null arrays where there are none)."""
    size = spans.agg(F.sum(F.size("los") * 16 + 48).alias("b")).first()["b"] or 0
    right = spans.select(F.col("rid").alias(key), F.col("los").alias(los), F.col("his").alias(his))
    return join_measured(rows, right, key, "left", int(size))


def covered(defer: DataFrame, first: list[str]) -> DataFrame:
    """Windows (wkey, rid, lo, hi) that a row smaller in ``first`` precedes
    under the same key: a grouped minimum (combined before its shuffle) and a
    join that AQE may split. For windows whose anchor is too common for one task."""
    best = defer.groupBy("wkey").agg(F.min(F.struct(*first)).alias("best"))
    return defer.join(best, "wkey").where(F.struct(*first) > F.col("best")).select("rid", "lo", "hi")
