"""Text expressions: tokenizer, n-grams, stop words, gluing, row text.

All are built-in column functions, so they run inside whole-stage codegen
and on every executor with no Python worker.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from revlens.functions.fixed import STOP_WORDS_ENGLISH, TOKEN_PATTERN


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text: Column | str, pattern: str = TOKEN_PATTERN,
             lowercase: bool = True) -> Column:
    """All matches of ``pattern`` in (lower-cased) text, in order.

    Equal to ``RegexTokenizer(pattern=..., gaps=False)`` with its default
    ``toLowercase=True`` and ``minTokenLength=1``.
    """
    t = _col(text)
    if lowercase:
        t = F.lower(t)
    return F.regexp_extract_all(t, F.lit(pattern), 0)


def ngrams(words: Column | str, n: int) -> Column:
    """Space-joined n-grams of a token array; empty when fewer than n tokens.

    Equal to ``NGram(n=n)``.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    w = _col(words)
    size = F.size(w)
    count = F.greatest(size - n + 1, F.lit(0))
    # Zip n shifted slices. The lambdas see only their own arguments: a
    # lambda that referenced ``w`` would let the optimizer inline the
    # tokenizer into it and re-run it once per element.
    grams = F.slice(w, 1, count)
    for k in range(2, n + 1):
        grams = F.zip_with(grams, F.slice(w, k, count),
                           lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(size >= n, grams).otherwise(F.array().cast("array<string>"))


def remove_stopwords(words: Column | str,
                     stop_words: Sequence[str] = STOP_WORDS_ENGLISH) -> Column:
    """Drop stop words, case-insensitively (``StopWordsRemover`` defaults).

    ``isin`` over a long literal list becomes a hash-set lookup (InSet).
    """
    stops = list(dict.fromkeys(s.lower() for s in stop_words))
    return F.filter(_col(words), lambda w: ~F.lower(w).isin(stops))


def glue(text: Column | str, keys: Column) -> Column:
    """Replace each key n-gram ``"a b"`` by ``"a_b"``, keys applied in order.

    Substring based, like ``str.replace``: ``"kip it"`` also hits
    ``"skip it"``. ``keys`` is an ``array<string>`` column (bounded list).
    """
    return F.aggregate(
        keys, _col(text),
        lambda acc, k: F.replace(acc, k, F.replace(k, F.lit(" "), F.lit("_"))))


def glue_list(text: Column | str, keys: Sequence[str]) -> Column:
    """:func:`glue` with a literal key list."""
    return glue(text, F.lit(list(keys)).cast("array<string>") if keys
                else F.array().cast("array<string>"))


def join_words(words: Column | str) -> Column:
    """Tokens joined with one space."""
    return F.array_join(_col(words), " ")


def join_fields(*cols: Column | str, sep: str = ", ",
                null_text: str = "None") -> Column:
    """All fields of a row as one text, nulls written as ``None``.

    Plain ``concat_ws`` would skip nulls; each field is coalesced first.
    """
    return F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit(null_text))
                              for c in cols])


def like_literal(pattern: str) -> str:
    """Escape LIKE wildcards so ``pattern`` matches only itself."""
    return (pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_"))
