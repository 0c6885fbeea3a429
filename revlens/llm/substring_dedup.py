"""Substring dedup by Rabin-Karp hashes of every fixed-length token window.

Every window of ``window`` consecutive words is hashed from rolling prefix
hashes. Windows travel in runs that share an anchor (see
:mod:`revlens.llm.spans`): a row holds the anchor and the packed hashes of
its windows, so a window costs eight bytes of shuffle. Under its anchor each
window hash is counted; a window that also starts in a document with a
smaller key marks its words, and marked windows merge into maximal removal
intervals. Anchor and window hash, 64 bits each and made from independent
hashes of the words, together name a window; the hash alone tells apart the
many contexts of one common passage.

Before the shuffle each task folds equal runs, so a passage that stands in
many documents leaves it once. An anchor with more than ``HOT_WINDOWS``
windows after that is not resolved in its task: its windows go through a
grouped minimum and a join by window, which have no hot key.

Defined results: null and empty texts have no words; a null id and rows that
repeat an id are documents of their own in the order of
:func:`~revlens.llm.common.keyed`; a document without repeats keeps its text
byte for byte; other columns are kept as they are, or ignored, whatever their
names; a text of any length is cut into windows whole by one task, its windows
spread by their anchors; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import (NOT_SPACE, PrefixHash, byte_column, col, doc_chunks, flat_ranges, fresh, keyed,
                                keyed_texts, mix64, runs, task_count, tidy, word_hashes,
                                word_spans)
from revlens.llm.spans import covered, window_runs, with_spans, write_spans
from revlens.session import write_table

WINDOW = 50
WINDOW_FACTOR = 2.2        # bytes of window rows a byte of text
FOLD_ROWS = 100_000        # runs a task folds at a time
TASK_WINDOWS = 500_000     # windows counted at a time
HOT_WINDOWS = 4_000_000    # windows of one anchor that one task counts
PACK = 8                   # bytes of a window's hash

ROWS = "akey long, rid long, lo long, n int, body binary"


def _fold(akey, rid, lo, n, bodies: list[bytes]):
    """Rows to send on: of equal runs those of the smallest key; the others
    are repeats (body null), filed under their document."""
    digest = np.array([hash(b) for b in bodies], np.int64)
    order = np.lexsort((lo, rid, digest, akey))
    a, d, r = akey[order], digest[order], rid[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (d[1:] != d[:-1])])
    best = r[np.flatnonzero(new)][np.cumsum(new) - 1]
    repeat = r > best
    key = np.where(repeat, mix64(r.view(np.uint64)).view(np.int64), a)
    return pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(r), pa.array(lo[order]), pa.array(n[order].astype(np.int32)),
         pa.array([None if x else bodies[i] for i, x in zip(order.tolist(), repeat.tolist())], pa.binary())],
        [f.split()[0] for f in ROWS.split(", ")])


def _window_rows(window: int):
    gram = max(1, window // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        bodies: list[bytes] = []
        for batch in batches:
            keys = batch.column(0).to_numpy()
            data, offsets = byte_column(batch.column(1))
            for lo, hi in doc_chunks(offsets):
                part = data[offsets[lo]:offsets[hi]]
                starts, ends, cut = word_spans(part, offsets[lo:hi + 1] - offsets[lo], NOT_SPACE)
                grams = PrefixHash(word_hashes(part, starts, ends)).windows(gram)
                first, n, anchor, doc = window_runs(mix64(grams), window, gram, cut)
                if not len(first):
                    continue
                # the window's own hash comes from other word hashes than its anchor
                second = PrefixHash(word_hashes(part, starts, ends, seed=1))
                every = mix64(second.windows(window))[flat_ranges(first, n)]
                packed = every.astype("<u8").tobytes()
                ends_at = np.cumsum(n) * PACK
                bodies += [packed[b - PACK * k:b] for b, k in zip(ends_at.tolist(), n.tolist())]
                held.append((anchor.view(np.int64), keys[lo + doc], first - cut[doc], n))
                if len(bodies) >= FOLD_ROWS:
                    yield _fold(*(np.concatenate(x) for x in zip(*held)), bodies)
                    held, bodies = [], []
        if held:
            yield _fold(*(np.concatenate(x) for x in zip(*held)), bodies)

    return run


FOUND = "rid long, lo long, hi long, wkey long"


def _count_windows(window: int, hot: int):
    """Rows sorted by anchor -> covered intervals of words; windows of an
    anchor that is too common come out singly, with a key."""
    def intervals(rid, lo, hi, wkey=None) -> pa.RecordBatch:
        none = pa.nulls(len(rid), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(rid), pa.array(lo), pa.array(hi),
                                           none if wkey is None else pa.array(wkey)], ["rid", "lo", "hi", "wkey"])

    def expand(akey, rid, lo, n, body):
        """Single windows: (anchor, hash, key, start)."""
        row = np.repeat(np.arange(len(n)), n)
        return akey[row], body.view("<u8"), rid[row], flat_ranges(lo, n)

    def resolve(akey, rid, lo, n, body) -> Iterator[pa.RecordBatch]:
        # anchors of one document only have nothing to count
        first = runs(akey)
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(akey))))
        mixed = (np.minimum.reduceat(rid, first) != np.maximum.reduceat(rid, first))[group]
        if not mixed.any():
            return
        body = body[np.repeat(mixed, n * PACK)]
        a, w, r, s = expand(group[mixed], rid[mixed], lo[mixed], n[mixed], body)
        order = np.lexsort((s, r, w, a))
        a, w, r, s = a[order], w[order], r[order], s[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (w[1:] != w[:-1])])
        hit = r > r[np.flatnonzero(new)][np.cumsum(new) - 1]
        r, s = r[hit], s[hit]
        if len(r):  # windows that follow each other make one interval
            order = np.lexsort((s, r))
            r, s = r[order], s[order]
            head = np.concatenate([[True], (r[1:] != r[:-1]) | (s[1:] > s[:-1] + 1)])
            last = np.append(np.flatnonzero(head)[1:], len(r)) - 1
            yield intervals(r[head], s[head], s[last] + window)

    def single(akey, rid, lo, n, body) -> pa.RecordBatch:
        a, w, r, s = expand(akey, rid, lo, n, body)
        return intervals(r, s, s + window, mix64(a.view(np.uint64) + mix64(w)).view(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, too_common = 0, None
        for batch in batches:
            akey, rid, lo = (batch.column(k).to_numpy() for k in range(3))
            n = batch.column(3).to_numpy().astype(np.int64)
            whole = np.asarray(batch.column(4).is_null())
            if whole.any():
                yield intervals(rid[whole], lo[whole], (lo + n + window - 1)[whole])
                akey, rid, lo, n = akey[~whole], rid[~whole], lo[~whole], n[~whole]
            if not len(akey):
                continue
            body = byte_column(batch.column(4))[0]
            held.append((akey, rid, lo, n, body))
            size += int(n.sum())
            if size < TASK_WINDOWS:
                continue
            akey, rid, lo, n, body = (np.concatenate(x) for x in zip(*held))
            at = np.concatenate([[0], np.cumsum(n)]) * PACK
            if too_common is not None:
                k = int(np.searchsorted(akey != too_common, True))
                if k:
                    yield single(akey[:k], rid[:k], lo[:k], n[:k], body[:at[k]])
                akey, rid, lo, n, body, at = akey[k:], rid[k:], lo[k:], n[k:], body[at[k]:], at[k:] - at[k]
                if len(akey):
                    too_common = None
            k = int(np.flatnonzero(akey != akey[-1])[-1]) + 1 if len(akey) and (akey != akey[-1]).any() else 0
            if k:
                yield from resolve(akey[:k], rid[:k], lo[:k], n[:k], body[:at[k]])
            akey, rid, lo, n, body = akey[k:], rid[k:], lo[k:], n[k:], body[at[k]:]
            if n.sum() > hot:
                too_common = akey[-1]
                yield single(akey, rid, lo, n, body)
                akey, rid, lo, n, body = akey[:0], rid[:0], lo[:0], n[:0], body[:0]
            held, size = ([(akey, rid, lo, n, body)] if len(akey) else []), int(n.sum())
        if held:
            akey, rid, lo, n, body = (np.concatenate(x) for x in zip(*held))
            if too_common is not None and (akey == too_common).any():
                k = int((akey == too_common).sum())
                cut = int(n[:k].sum()) * PACK
                yield single(akey[:k], rid[:k], lo[:k], n[:k], body[:cut])
                akey, rid, lo, n, body = akey[k:], rid[k:], lo[k:], n[k:], body[cut:]
            if len(akey):
                yield from resolve(akey, rid, lo, n, body)

    return run


def repeated_spans(texts: DataFrame, window: int = WINDOW, hot: int = HOT_WINDOWS) -> DataFrame:
    """(rid, los, his): intervals of word numbers covered by windows that also
    start in a document with a smaller key, of documents (rid, text)."""
    parts = task_count(texts, F.octet_length("text"), WINDOW_FACTOR)
    dealt = (texts.select("rid", "text").mapInArrow(tidy(_window_rows(window)), ROWS)
             .repartition(parts, "akey").sortWithinPartitions("akey"))
    found = write_table(dealt.mapInArrow(tidy(_count_windows(window, hot)), FOUND), "covered")
    late = found.where("wkey IS NOT NULL")
    done = found.where("wkey IS NULL").select("rid", "lo", "hi")
    n = found.count()
    return write_spans(done if late.isEmpty() else done.unionByName(covered(late, ["rid"])), n)


def _words(data: np.ndarray):
    starts, ends, _ = word_spans(data, np.array([0, len(data)]), NOT_SPACE)
    return starts, ends


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        los, his = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        data, offsets = byte_column(batch.column(1))
        total, removed, digest = [], [], []
        for i in range(len(batch)):
            text = data[offsets[i]:offsets[i + 1]]
            if los[i] is None:
                words = text.tobytes().split()  # bytes.split() cuts at exactly the six ASCII white-space bytes
                total.append(len(words))
                removed.append(0)
                digest.append(hashlib.sha256(b" ".join(words)).hexdigest())
                continue
            starts, ends = _words(text)
            keep = np.ones(len(starts), bool)
            keep[flat_ranges(np.array(los[i]), np.array(his[i]) - np.array(los[i]))] = False
            raw = text.tobytes()
            words = [raw[s:e] for s, e in zip(starts[keep].tolist(), ends[keep].tolist())]
            total.append(len(starts))
            removed.append(len(starts) - len(words))
            digest.append(hashlib.sha256(b" ".join(words)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                                          pa.array(digest, pa.string())],
                                         ["doc_id", "n_words", "n_removed", "kept_sha256"])


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""
    rows, _ = keyed_texts(docs, id_col, text_col)
    both = with_spans(rows, repeated_spans(rows, window))
    return both.select("id", "text", "los", "his").mapInArrow(
        tidy(_digest), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def cut_words(text: bytes, los: list[int], his: list[int]) -> bytes:
    """``text`` without the words of the intervals and the white space after
    each of them; what is kept stays as it stood."""
    starts, _ = _words(np.frombuffer(text, np.uint8))
    edge = np.append(starts, len(text))
    out, at = [], 0
    for lo, hi in zip(los, his):
        out.append(text[at:edge[lo]])
        at = int(edge[hi])
    return b"".join([*out, text[at:]])


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated words cut from their texts; other columns as they are."""
    rows, key, _ = keyed(docs, id_col, text_col)
    texts = rows.select(col(key).cast("long").alias("rid"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    spans = repeated_spans(texts, window)
    los, his = fresh(rows, "los"), fresh(rows, "his")
    both = with_spans(rows, spans, key, los, his)
    at, a, b = (both.columns.index(c) for c in (text_col, los, his))
    keep = [i for i, c in enumerate(both.columns) if c not in (key, los, his)]
    schema = T.StructType([both.schema.fields[i] for i in keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            l, h, texts = batch.column(a).to_pylist(), batch.column(b).to_pylist(), batch.column(at)
            if any(l):
                new = [t if not x else cut_words(t.encode(), x, y).decode()
                       for t, x, y in zip(texts.to_pylist(), l, h)]
                texts = pa.array(new, texts.type)
            yield pa.RecordBatch.from_arrays([texts if i == at else batch.column(i) for i in keep], schema.names)

    return both.mapInArrow(tidy(run), schema)
