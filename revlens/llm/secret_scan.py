"""Secret scans with multipart credential linking.

One pass over the texts finds parts, each with its span in code points and its
scope (a block of lines without a blank line between them):

* the base kinds, reported wherever they stand: ``assign`` (a secret's name,
  ``:`` or ``=``, a value of six characters and more), ``access`` (an access
  identifier), ``hex`` (24 and more hexadecimal digits);
* weak candidates, reported only with their complement: ``id`` (an account or
  key name given a value), ``key`` (a bare token of mixed letters and digits
  with a high entropy), ``short`` (an assignment of three to five characters),
  ``endpoint`` (a URL, or a host or region given a value).

An identifier is an ``access`` or an ``id``; a secret an ``assign``, ``hex``,
``key`` or ``short``. Within ``REACH`` code points and one scope an ``id``
needs a secret, a ``key`` or ``short`` an identifier, an ``endpoint`` both. A
candidate that overlaps a base span, or a candidate listed before it in
``id, short, endpoint, key``, is none.

The co-occurrence is an interval join in Spark: space is cut into bins of
``REACH``; per (text, scope, bin) the least start and the greatest end of each
role are kept (a grouped aggregate, no pairs), and a candidate looks at the
bins its extended span touches: presence decides in inner bins, the two
extremes at its ends. A bin holds at most a few parts per code point, so no
key is hot, however many parts a text has.

Defined results: null and empty texts have no spans; a null id stays null;
repeated rows are scanned one by one; other columns are ignored whatever
their names; matches never cross texts; empty tables give no rows. A text of
any length is scanned whole by one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import (byte_column, byte_table, col, doc_chunks, fresh, join_measured, keyed, tidy,
                                word_spans)
from revlens.session import write_table

REACH = 400
ENTROPY = 3.5        # bits a character of a bare token
KINDS = ("assign", "access", "hex", "id", "key", "short", "endpoint")
_ASSIGN, _ACCESS, _HEX, _ID, _KEY, _SHORT, _ENDPOINT = range(7)
_BASE = 3            # kinds before this one are base

# The contract's patterns, on texts with A-Z lowered (bytes keep their places).
ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
ASSIGN_MIN = 6
# A run of access or hexadecimal characters that is too short has no long enough tail, so the minimum can stand here.
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
HEX_MIN = 24

SHORT_MIN = 3
IDENTIFIER = re.compile(rb"""(?:access_?key_?id|client_?id|account(?:_?id)?|key_?id|user(?:_?name)?|login)["']?\x20*"""
                        rb"""[:=]\x20*["']?([a-z0-9+/_.@-]{3,})""")
URL = re.compile(rb"""[a-z][a-z0-9+.-]{0,20}://[^\x00-\x20"'<>]+""")
HOST = re.compile(rb"""(?:host(?:name)?|endpoint|server|region|bucket)["']?\x20*[:=]\x20*["']?[a-z0-9][a-z0-9._:/-]{2,}""")
KEY_MIN = 20
BLANK = re.compile(rb"\n[\x20\t\r\x0b\x0c]*(?=\n)")

_HEX_BYTES = byte_table(b"0123456789abcdef")
_KEY_BYTES = byte_table(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")
_SIGNS = byte_table(b":=")

_PART = "struct<start:long,kind:int,end:long,scope:long>"
PARTS = f"key long, doc_id long, parts array<{_PART}>"


def _is_key(token: bytes) -> bool:
    """Upper and lower letters, digits, and a high entropy."""
    if not (re.search(rb"[A-Z]", token) and re.search(rb"[a-z]", token) and re.search(rb"[0-9]", token)):
        return False
    counts = np.bincount(np.frombuffer(token, np.uint8))
    share = counts[counts > 0] / len(token)
    return -sum(p * log2(p) for p in share.tolist()) >= ENTROPY


def text_parts(text: bytes, hexes: list[tuple[int, int]], tokens: list[tuple[int, int]],
               signs: bool = True, access: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of a text's parts; its runs of hexadecimal
    digits and of token characters come in, flags tell what else it may hold."""
    low = text.lower()
    base = [(a, _HEX, b) for a, b in hexes]
    if access:
        base += [(m.start(), _ACCESS, m.end()) for m in ACCESS.finditer(text)]
    weak: list[tuple[int, int, int]] = []
    if signs:
        for m in ASSIGN.finditer(low):
            size = m.end(1) - m.start(1)
            if size >= ASSIGN_MIN:
                base.append((m.start(), _ASSIGN, m.end()))
            elif size >= SHORT_MIN:
                weak.append((m.start(), _SHORT, m.end()))
        weak = [(m.start(), _ID, m.end()) for m in IDENTIFIER.finditer(low)] + weak
        if b"://" in low:
            weak += [(m.start(), _ENDPOINT, m.end()) for m in URL.finditer(low)]
        weak += [(m.start(), _ENDPOINT, m.end()) for m in HOST.finditer(low)]
    weak += [(a, _KEY, b) for a, b in tokens if _is_key(text[a:b])]
    if not weak:
        return base
    # by rank: a candidate that overlaps what is already there goes
    taken = _Spans(base)
    for rank in (_ID, _SHORT, _ENDPOINT, _KEY):
        free: list[tuple[int, int, int]] = []
        for p in sorted(p for p in weak if p[1] == rank):
            if not taken.overlaps(p[0], p[2]) and (not free or free[-1][2] <= p[0]):
                free.append(p)
        taken = _Spans(taken.parts + free)
    return taken.parts


class _Spans:
    """Spans that may overlap, and whether another one overlaps any."""

    def __init__(self, parts: list[tuple[int, int, int]]):
        self.parts = parts
        rows = sorted((a, b) for a, _, b in parts)
        self.starts = np.array([a for a, _ in rows], np.int64)
        self.reach = np.maximum.accumulate(np.array([b for _, b in rows], np.int64)) if rows else self.starts

    def overlaps(self, start: int, end: int) -> bool:
        k = int(np.searchsorted(self.starts, end))      # spans that start before the end
        return k > 0 and int(self.reach[k - 1]) > start


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("scope", pa.int64())]))
    for batch in batches:
        data, offsets = byte_column(batch.column(2))
        for lo, hi in doc_chunks(offsets):
            part, cut = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
            raw = part.tobytes()
            runs = []
            for table, least in ((_HEX_BYTES, HEX_MIN), (_KEY_BYTES, KEY_MIN)):
                s, e, _ = word_spans(part, cut, table)
                long = e - s >= least
                s, e = s[long], e[long]
                runs.append((s, e, np.searchsorted(cut, s, "right") - 1))
            signs = set((np.searchsorted(cut, np.flatnonzero(_SIGNS[part]), "right") - 1).tolist())
            access, at = set(), raw.find(b"AKIA")
            while at >= 0:
                access.add(int(np.searchsorted(cut, at, "right")) - 1)
                at = raw.find(b"AKIA", at + 1)
            found: list[list[dict]] = [[] for _ in range(hi - lo)]
            points = None
            for d in sorted(signs | access | set(runs[0][2].tolist()) | set(runs[1][2].tolist())):
                a, b = int(cut[d]), int(cut[d + 1])
                own = []
                for s, e, doc in runs:
                    i, j = np.searchsorted(doc, (d, d + 1))
                    own.append(list(zip((s[i:j] - a).tolist(), (e[i:j] - a).tolist())))
                text = raw[a:b]
                parts = text_parts(text, own[0], own[1], d in signs, d in access)
                if not parts:
                    continue
                if points is None:
                    points = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
                blank = np.array([m.start() for m in BLANK.finditer(text)], np.int64)
                scope = np.searchsorted(blank, [p[0] for p in parts])
                found[d] = [{"start": int(points[a + s] - points[a]), "kind": k, "end": int(points[a + e] - points[a]),
                             "scope": int(c)} for (s, k, e), c in zip(parts, scope.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(found, arrow)],
                ["key", "doc_id", "parts"])


def find_parts(rows: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, doc_id, parts) of every text, from one narrow pass."""
    return rows.select(col(key).cast("long").alias("key"), col(id_col).cast("long").alias("doc_id"),
                       col(text_col).cast("string").alias("text")).mapInArrow(tidy(_find), PARTS)


def _role(kind: Column) -> tuple[Column, Column]:
    """(is an identifier, is a secret)."""
    return kind.isin(_ACCESS, _ID), kind.isin(_ASSIGN, _HEX, _KEY, _SHORT)


def link(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """(key, start, kind, end) of the weak candidates whose complement
    co-occurs; ``parts`` holds rows (key, start, kind, end, scope)."""
    def bins(lo: Column, hi: Column) -> Column:
        return F.explode(F.sequence(F.floor(lo / F.lit(reach)).cast("long"), F.floor(hi / F.lit(reach)).cast("long")))

    identifier, secret = _role(F.col("kind"))
    binned = parts.where(identifier | secret).select("key", "scope", "kind", "start", "end",
                                                     bins(F.col("start"), F.col("end")).alias("bin"))
    held = binned.groupBy("key", "scope", "bin").agg(
        *[f(F.when(role, F.col(c))).alias(f"{name}_{c}") for name, role in (("i", identifier), ("s", secret))
          for f, c in ((F.min, "start"), (F.max, "end"))])
    # An extended span is 2 * reach wide at least, so its first and last bins differ.
    lo, hi = F.col("start") - F.lit(reach), F.col("end") + F.lit(reach)
    asked = (parts.where(F.col("kind") >= F.lit(_BASE))
             .select("key", "scope", "kind", "start", "end", bins(lo, hi).alias("bin")))
    first, last = F.floor(lo / F.lit(reach)).cast("long"), F.floor(hi / F.lit(reach)).cast("long")

    def near(name: str) -> Column:
        start, end = F.col(f"{name}_start"), F.col(f"{name}_end")
        return F.when(F.col("bin") == first, end >= lo).when(F.col("bin") == last, start <= hi).otherwise(start.isNotNull())

    met = (asked.join(held, ["key", "scope", "bin"]).groupBy("key", "scope", "kind", "start", "end")
           .agg(F.max(F.coalesce(near("i"), F.lit(False))).alias("by_id"),
                F.max(F.coalesce(near("s"), F.lit(False))).alias("by_secret")))
    kind = F.col("kind")
    whole = (F.when(kind == _ID, F.col("by_secret")).when(kind.isin(_KEY, _SHORT), F.col("by_id"))
             .otherwise(F.col("by_id") & F.col("by_secret")))
    return met.where(whole).select("key", "start", "kind", "end")


def spans(found: DataFrame, reach: int = REACH) -> DataFrame:
    """(key, doc_id, base, spans): arrays of (start, kind, end) in order, of
    every row of ``found`` (rows of :func:`find_parts`, materialised)."""
    bare = F.col("parts").isNotNull() & F.exists("parts", lambda p: p["kind"] >= F.lit(_BASE))
    rows = (found.where(bare).select("key", F.explode("parts").alias("p"))
            .select("key", "p.start", "p.kind", "p.end", "p.scope"))
    weak = write_table(link(rows, reach).groupBy("key").agg(F.collect_list(F.struct("start", "kind", "end")).alias("weak")),
                       "linked")
    size = weak.agg(F.sum(F.size("weak") * 24 + 40)).first()[0] or 0
    base = F.transform(F.filter("parts", lambda p: p["kind"] < F.lit(_BASE)),
                       lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end")))
    both = join_measured(found.select("key", "doc_id", base.alias("base")), weak, "key", "left", int(size))
    return both.select("key", "doc_id", F.array_sort("base").alias("base"),
                       F.array_sort(F.concat("base", F.coalesce("weak", F.slice("base", 1, 0)))).alias("spans"))


def _listed(spans_col: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans_col, lambda p: F.concat_ws(
        ":", F.element_at(names, p["kind"] + 1), p["start"].cast("string"), p["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """One row per text: its base counts, the hash of its base spans, all spans."""
    key = fresh(docs, "key")
    # The number is written with the row, so what follows reads it as data.
    numbered = docs.withColumn(key, F.monotonically_increasing_id())
    found = spans(write_table(find_parts(numbered, key, id_col, text_col), "parts"), reach)
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda p: p["kind"] == F.lit(kind))).cast("long").alias(f"n_{KINDS[kind]}")

    counts = [count(k) for k in range(_BASE)]
    return found.select("doc_id", *counts, F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"),
                        _listed("spans").alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """``docs`` with every reported span of its text replaced by ``[kind]``
    (overlapping spans by the kind of the first); other columns as they are."""
    rows, key, _ = keyed(docs, id_col, text_col)
    found = spans(write_table(find_parts(rows, key, id_col, text_col), "parts"), reach).where(F.size("spans") > 0)
    marks = fresh(rows, "marks")
    cut = write_table(found.select(F.col("key").alias(key), F.col("spans").alias(marks)), "marks")
    size = cut.agg(F.sum(F.size(col(marks)) * 24 + 40)).first()[0] or 0
    both = join_measured(rows, cut, key, "left", int(size))
    at, mark = both.columns.index(text_col), both.columns.index(marks)
    keep = [i for i, c in enumerate(both.columns) if c not in (key, marks)]
    schema = T.StructType([both.schema.fields[i] for i in keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, listed = batch.column(at).to_pylist(), batch.column(mark).to_pylist()
            for i, some in enumerate(listed):
                if not some:
                    continue
                out, done = [], 0
                for p in some:
                    if p["start"] >= done:
                        out += [texts[i][done:p["start"]], f"[{KINDS[p['kind']]}]"]
                    done = max(done, p["end"])
                texts[i] = "".join([*out, texts[i][done:]])
            new = pa.array(texts, batch.column(at).type)
            yield pa.RecordBatch.from_arrays([new if k == at else batch.column(k) for k in keep], schema.names)

    return both.mapInArrow(tidy(run), schema)
