"""Linear SVM whose vectors are as long as there are documents, not terms.

The objective is that of Spark ML's ``LinearSVC``: the mean hinge loss plus
``reg / 2`` times the squared weights of the terms scaled to unit variance,
with a free intercept. At its minimum the weights are a combination of the
documents' vectors, so the fit looks for one number a document (the dual
problem): a box for each and one equation for the intercept. A round is one
product with the documents' inner products, ``X (X' v)``, made term by term
from the columns of :func:`revlens.operators.features.term_columns`: a vector
of one double per document goes out to the tasks and one comes back from each.
Weights of terms stay in rows; neither the driver nor a task holds a vector of
all terms.

The driver takes gradient projection steps with Barzilai-Borwein lengths and
an exact line search, in coordinates scaled by the documents' own inner
products, and stops when the duality gap is below ``tol`` of the objective.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame

from revlens.operators.vocab import TERM

BLOCK_ENTRIES = 1 << 17   # of a block: its arrays stay near the core
WEIGHT = "weight"
# The vectors of a round are too long for the young generation of the driver's JVM; they and
# what Spark keeps of jobs that have ended go with a full collection, each so many rounds.
TIDY_ROUNDS = 20
# Step lengths: the shorter kind while it is below this share of the longer, the least of so many.
STEP_RATIO, STEP_MEMORY = 0.5, 5


@dataclass(frozen=True)
class Samples:
    """The training rows: document position, label +1 or -1, and how many rows
    are alike. ``size`` is the number of positions; a document without any term
    table row has the last one."""
    pos: np.ndarray
    sign: np.ndarray
    count: np.ndarray
    size: int

    def weights(self) -> np.ndarray:
        return np.bincount(self.pos, self.count, self.size)


@dataclass(frozen=True)
class LinearSVCModel:
    """``alpha``: by document position; a term's weight is its column times ``alpha``."""
    alpha: np.ndarray
    intercept: float
    numFeatures: int
    objective: float
    gap: float            # the objective lies above its minimum by this at most
    iterations: int
    reg: float
    max_iter: int
    samples: Samples
    n_docs: int

    def getRegParam(self) -> float:
        return self.reg

    def getMaxIter(self) -> int:
        return self.max_iter

    def weights(self, columns: DataFrame) -> DataFrame:
        """(term, weight): the coefficient of every term's tf-idf."""
        sc = columns.sparkSession.sparkContext
        sent = sc.broadcast((self.samples.weights(), self.alpha))
        n_docs = self.n_docs

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c, alpha = sent.value
            for b in batches:
                if not b.num_rows:
                    continue
                col = Columns.read(b)
                scale = col.scales(c, n_docs)
                idf = np.log((n_docs + 1) / (col.df + 1))
                w = scale * scale * col.sums(col.tf * alpha[col.pos])
                out = np.divide(w, idf, out=np.zeros(len(w)), where=idf != 0)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out)], [TERM, WEIGHT])

        return columns.select(TERM, "df", "pos", "n").mapInArrow(run, f"{TERM} string, {WEIGHT} double")


class Columns:
    """Columns of the term matrix, end to end: positions, counts, bounds, df."""

    def __init__(self, pos, tf, bounds, df):
        self.pos, self.tf, self.bounds, self.df = pos, tf, bounds, df

    @classmethod
    def read(cls, batch: pa.RecordBatch) -> "Columns":
        """From (.., df, pos, n), the last two as bytes of 32-bit whole numbers."""
        names = batch.schema.names
        pos, bounds = _flat(batch.column(names.index("pos")))
        tf, _ = _flat(batch.column(names.index("n")))
        return cls(pos, tf, bounds, batch.column(names.index("df")).to_numpy())

    def sums(self, x: np.ndarray) -> np.ndarray:
        """Of each column; zero for one without entries."""
        return _sums(x, self.bounds)

    def where(self, keep: np.ndarray) -> "Columns":
        bounds = np.concatenate([[0], np.cumsum(keep)])[self.bounds]
        return Columns(self.pos[keep], self.tf[keep], bounds, self.df)

    def scales(self, c: np.ndarray, n_docs: int) -> np.ndarray:
        """1 / the deviation of a column's counts over the rows that ``c`` counts; 0 if
        they don't vary, or weigh nothing as the term is in every document."""
        n = c.sum()
        at = c[self.pos]
        first, second = self.sums(at * self.tf), self.sums(at * self.tf * self.tf)
        var = (second - first * first / n) / max(n - 1, 1)
        ok = (var > 1e-12 * second / n) & (self.df < n_docs)
        return np.where(ok, 1 / np.sqrt(np.where(ok, var, 1)), 0.0)


def _flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8)[bounds[0]:bounds[-1]] if bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
    return np.frombuffer(data.tobytes(), np.int32), (bounds - bounds[0]).astype(np.int64) // 4


def _sums(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bounds) - 1)
    some = bounds[1:] > bounds[:-1]
    if some.any():
        out[some] = np.add.reduceat(x, bounds[:-1][some])
    return out


def _binary(values: np.ndarray) -> pa.Array:
    return pa.array([values.tobytes()], pa.binary())


BLOCK_SCHEMA = "pos binary, n binary, bounds binary, scale binary, single binary, diag binary"


def _blocks(columns: DataFrame, samples: Samples, n_docs: int) -> DataFrame:
    """The columns of the training rows in blocks of many entries, to be read in
    every round. A column with one entry adds to that document's own product
    only (``single``); ``diag`` is each document's product with itself."""
    size = samples.size
    sent = columns.sparkSession.sparkContext.broadcast(samples.weights())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = sent.value
        single, diag = np.zeros(size), np.zeros(size)
        parts: list[tuple] = []

        def block() -> pa.RecordBatch:
            pos, tf, lens, scale = (np.concatenate(x) for x in zip(*parts))
            bounds = np.concatenate([[0], np.cumsum(lens)])
            none = pa.nulls(1, pa.binary())
            parts.clear()
            return pa.RecordBatch.from_arrays([*map(_binary, (pos, tf, bounds, scale)), none, none],
                                              [x.split()[0] for x in BLOCK_SCHEMA.split(", ")])

        for b in batches:
            if not b.num_rows:
                continue
            col = Columns.read(b)
            col = col.where(c[col.pos] > 0)
            scale, lens = col.scales(c, n_docs), np.diff(col.bounds)
            x = col.tf * np.repeat(scale, lens)
            own = np.bincount(col.pos, x * x, size)
            diag += own
            many = np.repeat((lens > 1) & (scale > 0), lens)
            lone = np.repeat(lens == 1, lens)
            single += np.bincount(col.pos[lone], (x * x)[lone], size)
            kept = (lens > 1) & (scale > 0)
            if kept.any():
                parts.append((col.pos[many], col.tf[many].astype(np.float32), lens[kept], scale[kept]))
            if sum(len(p[0]) for p in parts) >= BLOCK_ENTRIES:
                yield block()
        if parts:
            yield block()
        none = pa.nulls(1, pa.binary())
        yield pa.RecordBatch.from_arrays([none, none, none, none, _binary(single), _binary(diag)],
                                         [x.split()[0] for x in BLOCK_SCHEMA.split(", ")])

    return columns.select("df", "pos", "n").mapInArrow(run, BLOCK_SCHEMA)


def _added(rows: list, shape: tuple[int, ...]) -> np.ndarray:
    """In the partitions' order, so that a sum doesn't depend on which task ended first."""
    out = np.zeros(shape)
    for r in rows:
        out += np.frombuffer(r[0], np.float64).reshape(shape)
    return out


def _unpacked(rows: Iterator) -> Iterator[tuple]:
    """(positions, counts, first entries, entries, squared scales) of each block, or (single, diag)."""
    for r in rows:
        if r["diag"] is not None:
            yield np.frombuffer(r["single"], np.float64), np.frombuffer(r["diag"], np.float64)
            continue
        bounds, scale = np.frombuffer(r["bounds"], np.int64), np.frombuffer(r["scale"], np.float64)
        yield (np.frombuffer(r["pos"], np.int32), np.frombuffer(r["n"], np.float32), bounds[:-1], np.diff(bounds), scale * scale)


def _product(blocks: RDD, v: np.ndarray) -> np.ndarray:
    """The blocks' part of X (X' v), for each row of ``v``."""
    sent = blocks.context.broadcast(v)

    def run(rows: Iterator[tuple]) -> Iterator[tuple[bytes]]:
        vs = sent.value
        out = np.zeros(vs.shape)
        for r in rows:
            if len(r) == 2:
                continue
            pos, tf, first, lens, squared = r
            pos = pos.astype(np.int64)
            for k in range(len(vs)):
                w = squared * np.add.reduceat(tf * vs[k][pos], first)
                out[k] += np.bincount(pos, tf * np.repeat(w, lens), vs.shape[1])
        yield (out.tobytes(),)

    got = blocks.mapPartitions(run).collect()
    sent.destroy()
    return _added(got, v.shape)


def _project(z: np.ndarray, top: np.ndarray, sign: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The nearest point, distances weighed by ``h``, with every entry in [0, top]
    and ``sum(sign * point) == 0``."""
    slope = sign / h

    def at(nu: float) -> tuple[np.ndarray, float]:
        x = np.clip(z + nu * slope, 0, top)
        return x, float(sign @ x)

    x, r = at(0.0)
    lo, hi, nu = -np.inf, np.inf, 0.0
    small = 1e-15 * max(float(top.sum()), 1e-300)
    for _ in range(200):
        if abs(r) <= small:
            break
        lo, hi = (nu, hi) if r < 0 else (lo, nu)
        free = (x > 0) & (x < top)
        # r grows with nu, by 1 / h of each free entry
        rate = float((1 / h[free]).sum()) or float((1 / h).sum())
        nu = nu - r / rate
        if not lo < nu < hi:
            if np.isinf(lo) or np.isinf(hi):
                edge = lo if np.isinf(hi) else hi
                nu = edge + (1 if np.isinf(hi) else -1) * max(1.0, 2 * abs(edge))
            else:
                nu = (lo + hi) / 2
                if nu in (lo, hi):
                    break
        x, r = at(nu)
    return x


def _intercept(margins: np.ndarray, sign: np.ndarray, c: np.ndarray) -> float:
    """The intercept with the least hinge loss; in the middle where many have it."""
    edges = sign - margins
    order = np.argsort(edges, kind="stable")
    slopes = np.cumsum(c[order]) - c[sign > 0].sum()
    k = int(np.searchsorted(slopes, 0))
    k = min(k, len(order) - 1)
    level = slopes[k] == 0 and k + 1 < len(order)
    return float((edges[order[k]] + edges[order[k + 1]]) / 2 if level else edges[order[k]])


Steps = Generator[np.ndarray, np.ndarray, tuple]


def _solve(s: Samples, diag: np.ndarray, reg: float, max_iter: int, tol: float) -> Steps:
    """Asks for products with vectors by document, one a round; returns the best
    (alpha, intercept, objective, gap, iterations)."""
    n = s.count.sum()
    top, sign = s.count / n, s.sign.astype(float)
    own = diag[s.pos] / reg
    h = np.where(own > 0, own, own[own > 0].mean() if (own > 0).any() else 1.0)
    x, margins, uku = np.zeros(len(sign)), np.zeros(len(sign)), 0.0
    best, low, step, recent, done = None, -np.inf, 1.0, [], 0
    while True:
        b = _intercept(margins, sign, s.count)
        half = float(x @ (sign * margins)) / 2
        objective = float(top @ np.maximum(0, 1 - sign * (margins + b))) + half
        low = max(low, float(x.sum()) - half)
        if best is None or objective < best[2]:
            best = (np.bincount(s.pos, x * sign, s.size) / reg, b, objective)
        if done >= max_iter or best[2] - low <= tol * max(best[2], 1e-12):
            break
        g = sign * margins - 1
        d = _project(x - step * g / h, top, sign, h) - x
        down = float(g @ d)
        if not down < 0:
            break
        asked = yield np.bincount(s.pos, d * sign, s.size)
        done += 1
        moved = asked[s.pos] / reg
        hd = sign * moved
        curve = float(d @ hd)
        length = 1.0 if curve <= 0 else min(1.0, -down / curve)
        x = np.clip(x + length * d, 0, top)
        margins = margins + length * moved
        if curve > 0:
            long, short = float(h @ (d * d)) / curve, curve / float((hd * hd / h).sum())
            recent = [*recent, short][-STEP_MEMORY:]
            step = min(recent) if short < STEP_RATIO * long else long
    return (*best, best[2] - low, done)


class LinearSVC:
    """``LinearSVC(samples, n_docs).fit(columns)``; ``n_docs``: what the columns'
    document frequencies were counted on."""

    def __init__(self, samples: Samples, n_docs: int, regParam: float = 0.0, maxIter: int = 100, tol: float = 1e-6):
        if regParam <= 0:
            raise ValueError("regParam must be above 0")
        self.samples, self.n_docs = samples, n_docs
        self.regParam, self.maxIter, self.tol = float(regParam), int(maxIter), tol

    def fit(self, columns: DataFrame) -> LinearSVCModel:
        return self.fit_many(columns, [self.regParam])[0]

    def fit_many(self, columns: DataFrame, regs: Sequence[float]) -> list[LinearSVCModel]:
        """A model for each regParam; they share the rounds' products."""
        s = self.samples
        n_terms = columns.count()
        if not n_terms:
            raise ValueError("empty vocabulary: the fitted documents hold no terms")
        # an RDD, as a round plans nothing
        blocks = _blocks(columns, s, self.n_docs).rdd.mapPartitions(_unpacked).persist(StorageLevel.MEMORY_AND_DISK)
        ends = blocks.filter(lambda r: len(r) == 2).map(lambda r: (np.stack(r).tobytes(),)).collect()
        single, diag = _added(ends, (2, s.size))
        rounds = [_solve(s, diag, float(r), self.maxIter, self.tol) for r in regs]
        found: dict[int, tuple] = {}
        asked: dict[int, np.ndarray] = {}

        def go(k: int, answer: np.ndarray | None) -> None:
            try:
                asked[k] = rounds[k].send(answer)
            except StopIteration as e:
                found[k] = e.value
                asked.pop(k, None)

        for k in range(len(rounds)):
            go(k, None)
        done, jvm = 0, columns.sparkSession.sparkContext._jvm
        while asked:
            done += 1
            if done % TIDY_ROUNDS == 0:
                jvm.System.gc()
            ks = sorted(asked)
            v = np.stack([asked[k] for k in ks])
            answers = _product(blocks, v) + single * v
            for k, answer in zip(ks, answers):
                go(k, answer)
        blocks.unpersist()
        return [LinearSVCModel(alpha, b, n_terms, objective, gap, done, float(regs[k]), self.maxIter, s, self.n_docs)
                for k, (alpha, b, objective, gap, done) in sorted(found.items())]


def margins(columns: DataFrame, models: Sequence[LinearSVCModel]) -> np.ndarray:
    """The margin of every document position, a row for each model (of the same samples)."""
    s, n_docs = models[0].samples, models[0].n_docs
    alphas = np.stack([m.alpha for m in models])
    sent = columns.sparkSession.sparkContext.broadcast((s.weights(), alphas))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, vs = sent.value
        out = np.zeros(vs.shape)
        for b in batches:
            if not b.num_rows:
                continue
            col = Columns.read(b)
            scale, lens = col.scales(c, n_docs), np.diff(col.bounds)
            for k in range(len(vs)):
                w = scale * scale * col.sums(col.tf * vs[k][col.pos])
                out[k] += np.bincount(col.pos, col.tf * np.repeat(w, lens), vs.shape[1])
        yield pa.RecordBatch.from_arrays([_binary(out)], ["out"])

    got = columns.select("df", "pos", "n").mapInArrow(run, "out binary").collect()
    sent.destroy()
    return _added(got, alphas.shape) + np.array([[m.intercept] for m in models])
