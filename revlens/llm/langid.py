"""Language identification by multinomial naive Bayes over hashed character n-grams.

Around every letter of the (simply lower-cased) text stand three features:
the letter, the pair with its left neighbour and the triple with both; what
is no letter counts as one boundary sign. Features are hashed into
``buckets`` counters per language. Training counts are summed in Spark; the
resulting matrix of log-probabilities (buckets x languages) is broadcast, and
batches are scored with numpy gathers and sums per document.

Training rows are bounded: at most about ``fit_docs`` documents per language,
chosen by a hash of the id; prediction covers every document whole.

A posterior only compares the learned languages with each other, and over a
whole text it saturates near 1 for the least bad of them. Whether a text is in
that language at all is judged by its fit, the mean log-likelihood per feature
under the winning language: it must reach the language's bar, the ``LOW_FIT``
quantile of the fits of its training documents (each judged by the counts
without its own) less ``SLACK * (1 + SHORT / sqrt(letters))``.

Defined results: null text, empty text and text without a letter give
``und`` with score 0; rows with a null language are never learned from; a
null id is never held out and never learned from; repeated rows are predicted
one by one; ties go to the language that sorts first; with no training row
every document is ``und``; an empty table gives no rows; predictions are added
under names no column has, all columns are kept; a text of any length is scored
whole by one task. More than ``MAX_LANGUAGES`` languages are an error, as the
broadcast matrix would have no bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import (byte_column, col, doc_chunks, fresh, mix64, tidy)

BUCKETS = 1 << 15
FIT_DOCS = 50_000       # training documents per language, about
MAX_LANGUAGES = 512     # bounds the broadcast matrix: BUCKETS x 512 x 4 bytes = 64 MB
SMOOTHING = 0.5
LOW_FIT = 0.01          # quantile of the training documents' fits
SLACK = 1.0             # nats a feature below that quantile that still fit
SHORT = 4.0             # widens the slack for short texts, whose mean scatters
UNKNOWN = "und"
SCORE_BYTES = 1 << 19   # bytes of text whose features are held at once

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For every code point: its simple lower case if it is a letter, else 0."""
    if not _LETTERS:
        table = np.zeros(0x110000, np.uint32)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                low = c.lower()
                table[cp] = ord(low) if len(low) == 1 else cp
        _LETTERS.append(table)
    return _LETTERS[0]


def features(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(3, letters) feature buckets, and the letters before each document."""
    cps = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    cuts = lead[offsets] if lead[-1] == len(cps) else _cuts(data, offsets)
    n = len(offsets) - 1
    seq = np.zeros(len(cps) + n + 1, np.uint32)  # a boundary before and after each document
    seq[np.arange(len(cps)) + np.repeat(np.arange(n), np.diff(cuts)) + 1] = _letters()[cps]
    at = np.flatnonzero(seq)
    x, y, z = (seq[at + k].astype(np.uint64) for k in (-1, 0, 1))
    shift = np.uint64(64 - int(buckets).bit_length() + 1)
    one = y * np.uint64(0x9E3779B97F4A7C15)
    two = one ^ mix64(x + np.uint64(1 << 32))
    three = two ^ mix64(z + np.uint64(1 << 40))
    out = np.stack([mix64(f + np.uint64(k)) >> shift for k, f in enumerate((one, two, three))])
    return out.astype(np.int32), np.searchsorted(at, cuts + np.arange(n + 1))


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points before each document when the bytes aren't valid UTF-8."""
    body = data.tobytes()
    sizes = [len(body[a:b].decode("utf-8", "replace")) for a, b in zip(offsets[:-1], offsets[1:])]
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, buckets: int,
           fit_docs: int) -> tuple[dict[str, int], np.ndarray, DataFrame | None]:
    """(documents by language, feature counts of shape (languages, buckets),
    the training rows)."""
    rows = docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text"),
                       col(lang_col).cast("string").alias("lang")).where("id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
             .orderBy("lang").limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the matrix would not be bounded")
    langs = sorted(sizes)
    if not langs:
        return {}, np.zeros((0, buckets)), None
    grain = 1 << 30
    share = {k: min(grain, fit_docs * grain // n) for k, n in sizes.items()}
    bar = F.element_at(F.create_map(*[F.lit(x) for kv in share.items() for x in kv]), F.col("lang"))
    kept = rows.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(grain)) < bar).select("text", "lang")
    index = {k: i for i, k in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(langs) * buckets, np.int64)
        for batch in batches:
            data, offsets = byte_column(batch.column(0))
            which = np.array([index[k] for k in batch.column(1).to_pylist()], np.int64)
            for lo, hi in doc_chunks(offsets, SCORE_BYTES):
                f, cut = features(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], buckets)
                base = np.repeat(which[lo:hi] * buckets, np.diff(cut))
                for row in f:
                    total += np.bincount(base + row, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    cells = (kept.mapInArrow(tidy(count), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
             .toArrow())
    counts = np.zeros(len(langs) * buckets)
    counts[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    return {k: sizes[k] for k in langs}, counts.reshape(len(langs), buckets), kept


def _matrix(sizes: dict[str, int], counts: np.ndarray) -> np.ndarray:
    if not sizes:
        return np.zeros((counts.shape[1] + 1, 0), np.float32)
    counts = counts + SMOOTHING
    logp = np.log(counts / counts.sum(1, keepdims=True)).T
    prior = np.log(np.array(list(sizes.values()), float) / sum(sizes.values()))
    return np.vstack([logp, prior]).astype(np.float32)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        buckets: int = BUCKETS, fit_docs: int = FIT_DOCS) -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities of shape (buckets + 1, languages)).

    The last row holds the log-priors. Rows with a null text, language or id
    are left out.
    """
    sizes, counts, _ = _train(docs, id_col, text_col, lang_col, buckets, fit_docs)
    return list(sizes), _matrix(sizes, counts)


def _own_fits(data: np.ndarray, offsets: np.ndarray, which: np.ndarray, counts: np.ndarray,
              totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(documents with a letter, their fit under their own language by the
    counts without themselves)."""
    buckets = counts.shape[1]
    f, cut = features(data, offsets, buckets)
    letters = np.diff(cut)
    has = np.flatnonzero(letters)
    if not len(has):
        return has, np.zeros(0)
    doc = np.repeat(np.arange(len(letters)), letters) * buckets
    cell, own = np.unique((doc + f).ravel(), return_counts=True)
    at, feature = cell // buckets, cell % buckets
    rest = np.maximum(counts[which[at], feature] - own, 0.0)
    sums = np.bincount(at, own * np.log(rest + SMOOTHING), len(letters))[has]
    n = 3.0 * letters[has]
    return has, sums / n - np.log(np.maximum(totals[which[has]] - n, 0.0) + SMOOTHING * buckets)


def _bars(kept: DataFrame, langs: list[str], counts: np.ndarray) -> np.ndarray:
    """The ``LOW_FIT`` quantile of the training documents' fits, by language;
    -inf for a language whose documents have no letter."""
    model = kept.sparkSession.sparkContext.broadcast((counts.astype(np.float32), counts.sum(1)))
    index = {k: i for i, k in enumerate(langs)}

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_column(batch.column(0))
            which = np.array([index[k] for k in batch.column(1).to_pylist()], np.int64)
            for lo, hi in doc_chunks(offsets, SCORE_BYTES):
                has, fits = _own_fits(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo],
                                      which[lo:hi], *model.value)
                yield pa.RecordBatch.from_arrays([pa.array(which[lo:hi][has]), pa.array(fits.round(3))],
                                                 ["lang", "fit"])

    # Rounded, a language has few distinct values, so the exact quantile is small state.
    rows = (kept.mapInArrow(tidy(judge), "lang long, fit double").groupBy("lang")
            .agg(F.percentile("fit", F.lit(LOW_FIT)).alias("bar")).collect())
    bars = np.full(len(langs), -np.inf)
    for r in rows:
        bars[r["lang"]] = r["bar"]
    return bars


def fit_with_bars(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  buckets: int = BUCKETS, fit_docs: int = FIT_DOCS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """:func:`fit`, and the low quantile of every language's fits."""
    sizes, counts, kept = _train(docs, id_col, text_col, lang_col, buckets, fit_docs)
    langs = list(sizes)
    return langs, _matrix(sizes, counts), _bars(kept, langs, counts) if langs else np.zeros(0)


def score_texts(array: pa.Array, langs: list[str], matrix: np.ndarray,
                bars: np.ndarray | None = None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, posterior, whether the language fits) of every text of an
    Arrow array; without bars every language fits."""
    buckets = len(matrix) - 1
    data, offsets = byte_column(array)
    names, scores, fits = [UNKNOWN] * len(array), np.zeros(len(array)), np.zeros(len(array), bool)
    if not langs:
        return names, scores, fits
    for lo, hi in doc_chunks(offsets, SCORE_BYTES):
        f, cut = features(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], buckets)
        has = np.flatnonzero(np.diff(cut))
        if not len(has):
            continue
        per = matrix[f[0]]
        per += matrix[f[1]]
        per += matrix[f[2]]
        loglik = np.add.reduceat(per, cut[has], axis=0, dtype=np.float64) + matrix[-1]
        best = loglik.argmax(1)
        post = 1.0 / np.exp(loglik - loglik.max(1, keepdims=True)).sum(1)
        for d, b, p in zip(has.tolist(), best.tolist(), post.tolist()):
            names[lo + d], scores[lo + d] = langs[b], min(1.0, p)
        if bars is None:
            fits[lo + has] = True
        else:
            n = np.diff(cut)[has]
            mean = (loglik[np.arange(len(has)), best] - matrix[-1][best]) / (3.0 * n)
            fits[lo + has] = mean >= bars[best] - SLACK * (1 + SHORT / np.sqrt(n))
    return names, scores, fits


def predict(docs: DataFrame, langs: list[str], matrix: np.ndarray, text_col: str = "text",
            lang_out: str = "lang_pred", score_out: str = "score", bars: np.ndarray | None = None,
            fits_out: str = "fits") -> DataFrame:
    """``docs`` with the predicted language and its posterior (0 to 1) added,
    in one narrow pass; with ``bars`` also whether the text fits the language."""
    lang_out, score_out, fits_out = fresh(docs, lang_out), fresh(docs, score_out), fresh(docs, fits_out)
    model = docs.sparkSession.sparkContext.broadcast((langs, matrix, bars))
    at = docs.columns.index(text_col)
    added = [T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType()),
             T.StructField(fits_out, T.BooleanType())][:2 if bars is None else 3]
    schema = T.StructType([*docs.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, fits = score_texts(batch.column(at), *model.value)
            columns = [pa.array(names, pa.string()), pa.array(scores), pa.array(fits)][:len(added)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns],
                                             [*batch.schema.names, *(f.name for f in added)])

    return docs.mapInArrow(tidy(run), schema)


def held_out(doc_id: Column) -> Column:
    """The fold of the contract; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit_open_fold(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """:func:`fit` on the documents that aren't held out."""
    return fit(docs.where(~held_out(F.col("doc_id"))))


def fit_open_fold_with_bars(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """:func:`fit_with_bars` on the documents that aren't held out."""
    return fit_with_bars(docs.where(~held_out(F.col("doc_id"))))
