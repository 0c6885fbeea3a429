"""Periodic runs of words, found with suffix-tree extensions of Lyndon roots.

A run is a stretch of consecutive words with smallest period ``q`` and a
length of at least ``max(LEAST, 2 q)`` that no neighbouring word extends with
that period. Every run holds a Lyndon root that is the longest Lyndon word
from its place, under an order of the words or its reverse, so

* Ukkonen trees of the words and of their reversal are built; an Euler tour
  with a block-wise sparse table gives the lowest common ancestor of two
  leaves, hence the longest common extension of two places, in constant time;
* the leaves of the first tree in both orders rank the suffixes, and the next
  smaller rank ends the longest Lyndon word of every place: two candidate
  periods a place;
* each candidate is extended in both directions; extents of two periods and
  more are the runs.

Any word of a run stands in some six words that its text holds twice (places
``q`` apart agree along at least ``max(LEAST - q, q) >= 6`` words, and those
stretches cover the run). Stretches without such words are set aside first,
and the stretches that remain of many texts share one tree, parted by words
of their own. Words are named by their bytes, not by hashes.

A text belongs to one task, which works on whole texts in chunks; nothing is
shuffled. Memory is about 0.5 KB per word of the stretches that remain of a
chunk, so of the longest text at worst.

Defined results: null and empty texts have no words, no runs and the hashes
of the empty string; with ``stretch`` a null id leaves its text as it is;
null ids stay null, repeated rows are judged one by one, other columns are
ignored whatever their names; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from revlens.llm.common import (NOT_SPACE, PrefixHash, byte_column, col, doc_chunks, mix64, runs, tidy,
                                word_hashes, word_spans)

LEAST = 12               # words of the shortest run
GRAM = LEAST // 2        # a run's words all stand in grams of this size that occur twice
TREE_WORDS = 1 << 15     # words of the stretches that share a tree (more if a text has more)
BLOCK = 32               # tour places of a block

EMPTY = hashlib.sha256(b"").hexdigest()

OUT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
       "runs_sha256 string, collapsed_sha256 string")


# -- suffix trees -----------------------------------------------------------------

class SuffixTree:
    """Ukkonen's tree of a sequence of small numbers whose last is unique.

    Nodes are numbers: 0 the root; ``first`` and ``last`` delimit the edge into
    a node (``last`` of a leaf is the end of the sequence), ``up`` is the
    parent. Edges are found by ``node * symbols + symbol``.
    """

    def __init__(self, seq: list[int], symbols: int):
        n = len(seq)
        first, last, up, link = [0], [0], [-1], [0]
        edge: dict[int, int] = {}
        get = edge.get
        node, at, length, left = 0, 0, 0, 0       # active point, suffixes still to insert
        for i, c in enumerate(seq):
            left += 1
            before = 0                            # inner node that waits for its link
            while left:
                if not length:
                    at = i
                key = node * symbols + seq[at]
                child = get(key)
                if child is None:
                    edge[key] = len(first)
                    first.append(i)
                    last.append(n)
                    up.append(node)
                    link.append(0)
                    if before:
                        link[before] = node
                        before = 0
                else:
                    size = (last[child] if last[child] < n else i + 1) - first[child]
                    if length >= size:
                        node, at, length = child, at + size, length - size
                        continue
                    if seq[first[child] + length] == c:
                        if before:
                            link[before] = node
                        length += 1
                        break
                    split = len(first)
                    edge[key] = split
                    first.append(first[child])
                    last.append(first[child] + length)
                    up.append(node)
                    link.append(0)
                    first[child] += length
                    up[child] = split
                    edge[split * symbols + seq[first[child]]] = child
                    edge[split * symbols + c] = split + 1
                    first.append(i)
                    last.append(n)
                    up.append(split)
                    link.append(0)
                    if before:
                        link[before] = split
                    before = split
                left -= 1
                if not node and length:
                    length -= 1
                    at = i - left + 1
                elif node:
                    node = link[node]
        del edge
        self.size = n
        self.first, self.last, self.up = (np.array(x, np.int64) for x in (first, last, up))
        self.symbol = np.array(seq, np.int64)[self.first]
        self.symbol[0] = -1
        order = np.argsort(self.up, kind="stable")
        begin = np.searchsorted(self.up[order], np.arange(len(first) + 1))
        self.level, self.depth = self.path_sums(np.ones(len(first), np.int64), self.last - self.first)
        leaf = np.flatnonzero(begin[1:] == begin[:-1])
        self.leaf = np.empty(n, np.int64)         # leaf of every suffix
        self.leaf[n - self.depth[leaf]] = leaf

        # nodes of every subtree, deepest first
        weight, parent = [1] * len(first), self.up.tolist()
        for node in np.argsort(-self.depth, kind="stable").tolist()[:-1]:
            weight[parent[node]] += weight[node]
        self.weight = np.array(weight, np.int64)

    def path_sums(self, *values: np.ndarray) -> list[np.ndarray]:
        """Sums of a value over the nodes from the root (left out) to each
        node, by pointer doubling: as many rounds as the tree's depth has bits."""
        at = np.maximum(self.up, 0)
        sums = [np.where(self.up < 0, 0, v) for v in values]
        while at.any():
            sums = [v + v[at] for v in sums]
            at = at[at]
        return sums

    def ranks(self) -> tuple[np.ndarray, np.ndarray]:
        """Rank of every suffix among the suffixes, under the order of the
        symbols and under its reverse (an end counts as smallest: the last,
        unique symbol plays that part in both)."""
        out = []
        end = self.symbol == self.symbol[self.leaf[self.size - 1]]
        for sign in (1, -1):
            key = np.where(end, np.iinfo(np.int64).min, sign * self.symbol)
            out.append(self.places(key)[self.leaf])
        return out[0], out[1]

    def places(self, key: np.ndarray) -> np.ndarray:
        """Place of every node in a preorder with children by ``key``."""
        kids = np.lexsort((key, self.up))[1:]     # the root's parent is -1: it comes first
        weight, parent = self.weight[kids], self.up[kids]
        before = np.cumsum(weight) - weight
        head = np.concatenate([[True], parent[1:] != parent[:-1]])
        step = np.zeros(len(key), np.int64)
        step[kids] = 1 + before - before[np.flatnonzero(head)][np.cumsum(head) - 1]   # from the parent's place
        return self.path_sums(step)[0]


class Extensions:
    """Longest common extensions of places by lowest common ancestors.

    The Euler tour visits a node before its first child and after each child.
    Between the visits of two leaves the smallest depth is their ancestor's;
    it is looked up in a sparse table over blocks and in the blocks' ends.
    """

    def __init__(self, tree: SuffixTree):
        place = tree.places(tree.symbol)
        first = 2 * place - tree.level            # first visit; every step goes down or up one edge
        tour = np.zeros(2 * len(place) - 1, np.int32)
        tour[first] = tree.depth
        inner = tree.up >= 0
        back = first + 2 * tree.weight - 1        # after a node's subtree its parent is visited again
        tour[back[inner]] = tree.depth[tree.up[inner]]
        self.at = first[tree.leaf]
        pad = -len(tour) % BLOCK
        grid = np.append(tour, np.full(pad, np.iinfo(np.int32).max, np.int32)).reshape(-1, BLOCK)
        self.left = np.minimum.accumulate(grid, axis=1).ravel()
        self.right = np.ascontiguousarray(np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1]).ravel()
        self.grid = grid.ravel()
        self.table = [grid.min(axis=1)]
        while 2 ** len(self.table) <= len(self.table[0]):
            half = 2 ** (len(self.table) - 1)
            row = self.table[-1]
            self.table.append(np.minimum(row[:-half], row[half:]))

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common symbols from places ``a`` and ``b`` on (a differs from b)."""
        lo, hi = np.minimum(self.at[a], self.at[b]), np.maximum(self.at[a], self.at[b])
        first, last = lo // BLOCK, hi // BLOCK
        out = np.minimum(self.right[lo], self.left[hi])
        between = last - first - 1
        many = np.flatnonzero(between > 0)
        power = np.frexp(between[many].astype(np.float64))[1] - 1
        for k in np.unique(power).tolist():
            these = many[power == k]
            row = self.table[k]
            out[these] = np.minimum(out[these], np.minimum(row[first[these] + 1], row[last[these] - 2 ** k]))
        one = np.flatnonzero(first == last)       # within a block: at most BLOCK places
        if len(one):
            least = self.grid[lo[one]]
            for step in range(1, BLOCK):
                seen = lo[one] + step <= hi[one]
                if not seen.any():
                    break
                least[seen] = np.minimum(least[seen], self.grid[(lo[one] + step)[seen]])
            out[one] = least
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For every place the next one of smaller rank (or the end)."""
    values = rank.tolist()
    out = [len(values)] * len(values)
    stack: list[int] = []
    for i, r in enumerate(values):
        while stack and values[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out, np.int64)


def find_runs(seq: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of a sequence of numbers, by start,
    then period. A number that occurs once can part stretches."""
    n = len(seq)
    none = np.zeros(0, np.int64)
    if n < 2:
        return none, none, none
    codes = np.unique(seq, return_inverse=True)[1]
    symbols = int(codes.max()) + 2                # and one for the end
    forward = SuffixTree([*codes.tolist(), symbols - 1], symbols)
    ranks = [r[:n] for r in forward.ranks()]
    ahead = Extensions(forward)
    del forward
    backward = Extensions(SuffixTree([*codes[::-1].tolist(), symbols - 1], symbols))
    found = []
    for rank in ranks:
        place = np.arange(n)
        period = next_smaller(rank) - place
        inside = place + period < n
        right = np.zeros(n, np.int64)
        right[inside] = ahead.of(place[inside], (place + period)[inside])
        left = np.zeros(n, np.int64)
        inside = place > 0
        # place - 1 and place + period - 1, in the reversal
        left[inside] = backward.of(n - place[inside], n - (place + period)[inside])
        start, end = place - left, place + period + right
        good = end - start >= np.maximum(2 * period, least)
        found.append(np.stack([start[good], end[good], period[good]]))
    both = np.concatenate(found, axis=1)
    both = np.unique(both[[0, 2, 1]], axis=1)
    return both[0], both[2], both[1]


# -- texts ------------------------------------------------------------------------

def repeated_stretches(names: np.ndarray, group: np.ndarray, least: int = LEAST) -> list[np.ndarray]:
    """Stretches of places that may hold runs: all their words stand in grams
    of ``least // 2`` words that the stretch holds twice. ``group`` tells the
    texts apart."""
    gram = max(1, least // 2)
    grams = PrefixHash(names).windows(gram)
    alive = np.ones(len(names), bool)
    group = group.copy()
    while True:
        # grams whose words are all alive and of one group
        dead = np.concatenate([[0], np.cumsum(~alive)])
        at = np.flatnonzero((dead[gram:] == dead[:-gram]) & (group[gram - 1:] == group[:len(group) - gram + 1])) \
            if len(names) >= gram else np.zeros(0, np.int64)
        key = mix64(grams[at] ^ mix64(group[at].astype(np.uint64)))
        order = np.argsort(key)
        size = np.diff(np.append(runs(key[order]), len(at)))
        at = at[order][np.repeat(size > 1, size)]
        edge = np.zeros(len(names) + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + gram, -1)
        now = np.cumsum(edge)[:-1] > 0
        # stretches: alive words in a row, of one group
        head = now.copy()
        head[1:] &= ~now[:-1] | (group[1:] != group[:-1])
        fresh = np.cumsum(head)
        sizes = np.bincount(fresh[now], minlength=int(fresh[-1]) + 1 if len(fresh) else 1)
        if len(fresh):
            now &= sizes[fresh] >= least
        if (now == alive).all():
            break
        alive, group = now, np.where(now, fresh, 0)
    if not alive.any():
        return []
    head = alive.copy()
    head[1:] &= ~alive[:-1] | (group[1:] != group[:-1])
    place = np.flatnonzero(alive)
    return np.split(place, np.flatnonzero(head[place])[1:])


def stretch_words(doc_id: int | None, n: int) -> np.ndarray:
    """The original word of each of ``n`` words after the contract's rebuild:
    with h = crc32(decimal id) and h % 10 = 0 the words from the (g % n)-th on,
    g = h // 10, repeat the first 1 + (n - a) // (3 + g % 8) of them."""
    place = np.arange(n)
    if doc_id is None or not n:
        return place
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return place
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.where(place < a, place, a + (place - a) % p)


def _judge(parts: list[np.ndarray], raw: bytes, begin: np.ndarray, end: np.ndarray):
    """(part number, start, end, period) of the runs of some stretches; the
    stretches' places are numbers of words."""
    names: dict[bytes, int] = {}
    seq: list[int] = []
    offset = []
    for part in parts:
        offset.append(len(seq))
        seq += [names.setdefault(raw[b:e], len(names)) for b, e in zip(begin[part].tolist(), end[part].tolist())]
        seq.append(-len(offset))                  # a word of its own parts the stretches
    start, stop, period = find_runs(np.array(seq, np.int64))
    which = np.searchsorted(offset, start, "right") - 1
    base = np.array(offset)[which]
    return which, start - base, stop - base, period


def _describe(doc_id, starts, ends, periods, raw: bytes, begin: np.ndarray, end: np.ndarray) -> tuple:
    """Result row of a text whose words are raw[begin:end]; runs by start, period."""
    lengths = ends - starts
    best = (None,) * 4
    if len(starts):
        k = int(np.lexsort((periods, starts, -lengths))[0])
        best = (int(starts[k]), int(lengths[k]), int(periods[k]), 1000 * int(lengths[k]) // int(periods[k]))
    if not len(starts):
        kept = b" ".join([raw[b:e] for b, e in zip(begin.tolist(), end.tolist())])
        return (doc_id, 0, *best, EMPTY, hashlib.sha256(kept).hexdigest())
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in zip(starts.tolist(), lengths.tolist(), periods.tolist()))
    edge = np.zeros(len(begin) + 1, np.int64)
    np.add.at(edge, starts + periods, 1)
    np.add.at(edge, ends, -1)
    keep = np.cumsum(edge)[:-1] == 0
    kept = b" ".join([raw[b:e] for b, e in zip(begin[keep].tolist(), end[keep].tolist())])
    return (doc_id, len(starts), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def _rows(rebuild: bool, tree_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, offsets = byte_column(batch.column(1))
            for lo, hi in doc_chunks(offsets):
                yield chunk(ids[lo:hi], data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])

    def chunk(ids: list, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        starts, ends, cut = word_spans(data, offsets, NOT_SPACE)
        if rebuild:
            taken = np.concatenate([a + stretch_words(i, b - a) for i, a, b in
                                    zip(ids, cut[:-1].tolist(), cut[1:].tolist())]) if len(ids) else starts[:0]
            starts, ends, names = starts[taken], ends[taken], word_hashes(data, starts, ends)[taken]
        else:
            names = word_hashes(data, starts, ends)
        doc = np.repeat(np.arange(len(ids)), np.diff(cut))
        raw = data.tobytes()
        found: list[tuple] = []
        parts: list[np.ndarray] = []
        held = 0
        todo = repeated_stretches(names, doc)
        for k, part in enumerate(todo):
            parts.append(part)
            held += len(part)
            if held >= tree_words or k + 1 == len(todo):
                which, s, e, p = _judge(parts, raw, starts, ends)
                head = np.array([x[0] for x in parts])[which]
                found.append((doc[head], head + s, head + e, p))
                parts, held = [], 0
        owner, s, e, p = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 4
        order = np.lexsort((p, s, owner))
        owner, s, e, p = owner[order], s[order], e[order], p[order]
        span = np.searchsorted(owner, np.arange(len(ids) + 1))
        rows = []
        for i, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())):
            mine = slice(span[i], span[i + 1])
            rows.append(_describe(ids[i], s[mine] - a, e[mine] - a, p[mine], raw, starts[a:b], ends[a:b]))
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                          [f.split()[0] for f in OUT.split(", ")])

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stretch: bool = False,
                  tree_words: int = TREE_WORDS) -> DataFrame:
    """One row per text: its runs, the longest one, and the hash of the text
    without the words that any run repeats. ``stretch`` first rebuilds the
    texts that :func:`stretch_words` names."""
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy(_rows(stretch, tree_words)), OUT)


def collapse(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the words that a run repeats cut from their texts (kept
    words joined by one space where any went); other columns as they are."""
    at, schema = docs.columns.index(text_col), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for i, text in enumerate(texts):
                if text is None:
                    continue
                raw = text.encode()
                data = np.frombuffer(raw, np.uint8)
                starts, ends, _ = word_spans(data, np.array([0, len(data)]), NOT_SPACE)
                parts = repeated_stretches(word_hashes(data, starts, ends), np.zeros(len(starts), np.int64))
                if not parts:
                    continue
                which, s, e, p = _judge(parts, raw, starts, ends)
                head = np.array([x[0] for x in parts])[which]
                edge = np.zeros(len(starts) + 1, np.int64)
                np.add.at(edge, head + s + p, 1)
                np.add.at(edge, head + e, -1)
                keep = np.cumsum(edge)[:-1] == 0
                if not keep.all():
                    texts[i] = b" ".join([raw[b:c] for b, c in
                                          zip(starts[keep].tolist(), ends[keep].tolist())]).decode()
            new = pa.array(texts, batch.column(at).type)
            yield pa.RecordBatch.from_arrays([new if k == at else c for k, c in enumerate(batch.columns)],
                                             batch.schema.names)

    return docs.mapInArrow(tidy(run), schema)
