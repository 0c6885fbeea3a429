"""Packing documents into fixed-length sequences.

Each text is tokenised once; its ids (with the end id appended) are cut into
full pieces of ``length`` ids and one remainder. Full pieces are sequences of
their own. Remainders are dealt by a hash into randomised groups of about
``GROUP_PIECES`` pieces, and each group is packed on its own by first-fit
decreasing: pieces from long to short, each into the first bin that still
has room, found in a tournament tree over the bins' free capacities.

The ids of every distinct unit of text are asked of the tokenizer once per
worker and kept in a bounded table (see :class:`UnitEncoder`).

Defined results: null and empty texts hold the end id alone; a null id is
kept as null; repeated rows are pieces of their own; ties in length are
broken by id and start; other columns are ignored whatever their names; a text
of any length is tokenised whole by one task; empty tables give no rows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import (LOWER, NOT_SPACE, byte_column, col, doc_chunks, flat_ranges, runs,
                                same_words, tidy, word_hashes, word_spans)
from revlens.session import write_table

LENGTH = 4096
END_ID = 2
GROUP_PIECES = 1 << 15
KEPT_UNITS = 3_000_000  # units of text whose ids a worker remembers, about 32 bytes each
KEPT_IDS = 16_000_000   # and their ids
KEPT_BYTES = 64 << 20   # and their bytes
CHUNK_BYTES = 1 << 20

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


# White space outside ASCII, in UTF-8 (fixed: Unicode's White_Space).
_WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_SPACE, _LETTER, _DIGIT, _SIGN, _OTHER = range(5)


def _classes() -> np.ndarray:
    """Class of every byte. Letters: ASCII, and U+00C0 to U+027F with their
    continuation bytes. Signs: printable ASCII. The apostrophe, control
    characters and other lead bytes are _OTHER: a word that holds one is not
    cut here."""
    out = np.full(256, _OTHER, np.uint8)
    out[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), *range(0xC3, 0xCA)]] = _LETTER
    out[0x30:0x3A] = _DIGIT
    out[[b for b in range(33, 127) if not chr(b).isalnum() and b != 0x27]] = _SIGN
    out[~NOT_SPACE] = _SPACE
    return out


_CLASS = _classes()


class UnitEncoder:
    """Ids of texts through a bounded table of the ids of their units.

    The tokenizer this is written for (NFC, lower case; runs of letters,
    single digits and runs of signs as pieces; byte-level BPE with an
    end-of-word mark) treats pieces independently. A unit is such a piece
    where ASCII bytes and Latin letters alone decide that, else a whole word
    between white space, which is given to the tokenizer as it stands. Units
    are found and named by 64-bit hashes with numpy; each new one is asked of
    the tokenizer once. Every occurrence is compared byte by byte with the
    unit it is taken for; one that only shares the hash is asked on its own.
    Another kind of tokenizer is given whole texts.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        steps = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.plain = (steps == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in cuts] == ["Split", "ByteLevel"]
                      and cuts[0]["invert"] and cuts[0]["behavior"] == "Removed" and spec["model"]["type"] == "BPE"
                      and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"]
                      and "[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+" in cuts[0]["pattern"]["Regex"]
                      and all(t["content"].startswith("<|") for t in spec["added_tokens"]))
        self.level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.keys = np.zeros(0, np.uint64)     # sorted names of the known units
        self.place = np.zeros(0, np.int64)     # their numbers
        self.offset, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self.raw, self.raw_at = np.zeros(0, np.uint8), np.zeros(1, np.int64)   # bytes of the units

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _ids(self, unit: bytes, kind: int) -> list[int]:
        text = unit.decode("utf-8", "replace")
        if kind == 0:    # ASCII stands for itself
            return [t.id for t in self.tokenizer.model.tokenize(text)]
        if kind == 1:    # Latin letters
            return [t.id for t in self.tokenizer.model.tokenize(self.level.pre_tokenize_str(text.lower())[0][0])]
        return self.whole(text)

    def units(self, data: np.ndarray, offsets: np.ndarray):
        """(bytes with ASCII capitals lowered where that is right, starts, ends,
        units before each document, kind of every byte)."""
        cls = _CLASS[data]
        starts, ends, cut = word_spans(data, offsets, NOT_SPACE)
        bad = cls == _OTHER
        follow = np.append(data[1:], np.uint8(0))
        bad |= (data == 0xC3) & ((follow == 0x97) | (follow == 0xB7))   # the two signs among the Latin letters
        bad |= (data == 0xC4) & (follow == 0xB0)                        # its lower case is a letter and a mark
        bad |= (data == 0x3C) & (follow == 0x7C)                        # special tokens begin with <|
        low = LOWER[data]
        change = np.zeros(len(data), bool)
        change[1:] = cls[1:] != cls[:-1]
        change |= cls == _DIGIT
        if bad.any():
            seen = np.concatenate([[0], np.cumsum(bad)])
            odd = np.flatnonzero(seen[ends] > seen[starts])
            inside = flat_ranges(starts[odd], ends[odd] - starts[odd])
            change[inside] = False
            low[inside] = data[inside]
        change[cls == _SPACE] = False
        change[starts] = True
        begin = np.flatnonzero(change)
        stop = np.minimum(np.append(begin[1:], len(data)), ends[np.searchsorted(starts, begin, "right") - 1])
        return low, begin, stop, np.searchsorted(begin, offsets), (data >= 0x80).astype(np.int8) + 2 * bad

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents one after another, ids before each)."""
        if not self.plain:
            raw = data.tobytes()
            each = [self.whole(raw[a:b].decode("utf-8", "replace")) for a, b in zip(offsets[:-1], offsets[1:])]
            return (np.fromiter((i for x in each for i in x), np.uint32),
                    np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int64))
        if np.isin(data, (0xC2, 0xE1, 0xE2, 0xE3)).any():
            data = np.frombuffer(_WIDE_SPACE.sub(lambda m: b" " * len(m[0]), data.tobytes()), np.uint8)
        low, begin, stop, cut, kind = self.units(data, offsets)
        names = word_hashes(low, begin, stop)
        order = np.argsort(names)
        ranked = names[order]
        first = runs(ranked)
        unique = ranked[first]
        spot = order[first]      # an occurrence of every name
        group = np.empty(len(names), np.int64)
        group[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(names))))
        at = np.searchsorted(self.keys, unique)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == unique if len(self.keys) else np.zeros(len(unique), bool)
        number = np.full(len(unique), -1, np.int64)
        number[known] = self.place[at[known]]
        alike = same_words(low, begin, stop, low, begin[spot][group], stop[spot][group])
        mine = np.flatnonzero(known)
        held = number[mine]
        as_kept = same_words(low, begin[spot[mine]], stop[spot[mine]], self.raw, self.raw_at[held], self.raw_at[held + 1])
        number[mine[~as_kept]] = -1
        new = np.flatnonzero(number < 0)
        before = len(self.size), len(self.flat), len(self.raw)
        # units to ask: one of every new name, and occurrences that share a name with other bytes
        clash = np.flatnonzero(~alike)
        ask = np.concatenate([spot[new], clash])
        if len(ask):
            raw = low.tobytes()
            seen = [np.concatenate([[0], np.cumsum(kind >= k)]) for k in (1, 2)]
            kinds = sum((c[stop[ask]] > c[begin[ask]]).astype(int) for c in seen)
            asked = [self._ids(raw[a:b], k) for a, b, k in
                     zip(begin[ask].tolist(), stop[ask].tolist(), kinds.tolist())]
            sizes = np.array([len(x) for x in asked], np.int64)
            number[new] = len(self.size) + np.arange(len(new))
            self.offset = np.concatenate([self.offset, len(self.flat) + np.cumsum(sizes) - sizes])
            self.size = np.concatenate([self.size, sizes])
            self.flat = np.concatenate([self.flat, np.fromiter((i for x in asked for i in x), np.uint32, int(sizes.sum()))])
            width = stop[ask] - begin[ask]
            self.raw = np.concatenate([self.raw, low[flat_ranges(begin[ask], width)]])
            self.raw_at = np.concatenate([self.raw_at, self.raw_at[-1] + np.cumsum(width)])
        which = number[group]
        which[clash] = before[0] + len(new) + np.arange(len(clash))
        sizes = self.size[which]
        ids = self.flat[flat_ranges(self.offset[which], sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])[cut]
        if (len(self.size) > KEPT_UNITS or len(self.flat) > KEPT_IDS  # frequent units are known by now
                or len(self.raw) > KEPT_BYTES):
            self.offset, self.size, self.flat = self.offset[:before[0]], self.size[:before[0]], self.flat[:before[1]]
            self.raw, self.raw_at = self.raw[:before[2]], self.raw_at[:before[0] + 1]
        else:
            fresh = new[~known[new]]
            where = np.searchsorted(self.keys, unique[fresh])
            self.keys = np.insert(self.keys, where, unique[fresh])
            self.place = np.insert(self.place, where, number[fresh])
        return ids, ends


_ENCODERS: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """One encoder per worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           length: int = LENGTH) -> DataFrame:
    """One row per piece of at most ``length`` ids, with a CRC-32 of its ids
    as little-endian unsigned 32-bit values. One narrow pass over the texts."""
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for batch in batches:
            names = batch.column(0).to_pylist()
            data, offsets = byte_column(batch.column(1))
            out: list[list] = [[], [], [], [], []]
            for lo, hi in doc_chunks(offsets, CHUNK_BYTES):
                ids, cut = enc.encode(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                raw = memoryview(ids.astype("<u4").tobytes())
                for k, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())):
                    total = b - a + 1
                    for start in range(0, total, length):
                        stop = min(start + length, total)
                        crc = zlib.crc32(raw[4 * (a + start):4 * min(a + stop, b)])
                        if stop == total:
                            crc = zlib.crc32(end, crc)
                        for c, v in zip(out, (names[lo + k], start, stop - start, crc, total)):
                            c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), PIECES)


class Tournament:
    """Free capacity of bins 0..n-1 in a complete binary tree; an inner node
    holds the larger of its children."""

    def __init__(self, bins: int, capacity: int):
        self.leaf = 1
        while self.leaf < max(bins, 1):
            self.leaf *= 2
        self.best = [capacity] * (2 * self.leaf)

    def first_fit(self, size: int) -> int:
        """Leftmost bin with room for ``size``; takes the room."""
        best, i = self.best, 1
        while i < self.leaf:
            i *= 2
            if best[i] < size:
                i += 1
        best[i] -= size
        found = i - self.leaf
        while i > 1:
            i //= 2
            top = max(best[2 * i], best[2 * i + 1])
            if best[i] == top:
                break
            best[i] = top
        return found


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every piece; ``sizes`` come in descending order."""
    tree, fill = Tournament(len(sizes), capacity), [0] * len(sizes)
    bins, offsets = [], []
    for size in sizes.tolist():
        b = tree.first_fit(size)
        bins.append(b)
        offsets.append(fill[b])
        fill[b] += size
    return np.array(bins, np.int64), np.array(offsets, np.int64)


def pack(cut: DataFrame, length: int = LENGTH, group_pieces: int = GROUP_PIECES,
         seed: int = 11) -> DataFrame:
    """``cut`` (rows of :func:`pieces`, materialised) with sequence_id and offset.

    Rows are numbered by the hash groups: sequence = group x 2^31 + bin.
    Full pieces get a sequence each in the groups above those. A group's
    size follows ``group_pieces``, whatever the size of the table.
    """
    short = cut.where(F.col("length") < length)
    n = short.count()
    groups = max(1, -(-n // group_pieces))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    # The row's number in the written table spreads rows of null or repeated ids and equal text.
    number = F.monotonically_increasing_id()
    grouped = short.select(*columns, F.pmod(F.xxhash64(F.lit(seed), "doc_id", "start", "ids_crc32", number),
                                            F.lit(groups)).alias("grp"))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"),
                               ("ids_crc32", "ascending")])
        bins, offsets = first_fit_decreasing(table.column("length").to_numpy(), length)
        base = np.int64(table.column("grp")[0].as_py()) << 31
        return (table.select(columns).append_column("sequence_id", pa.array(bins + base))
                .append_column("offset", pa.array(offsets)))

    packed = grouped.groupBy("grp").applyInArrow(run, PIECES + ", sequence_id long, offset long")
    full = cut.where(F.col("length") == length).select(
        *columns, ((F.lit(groups).cast("long") + F.spark_partition_id()) * F.lit(1 << 31)
                   + F.pmod(F.monotonically_increasing_id(), F.lit(1 << 31))).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Tokenise, cut and pack; the pieces are written once in between."""
    return pack(write_table(pieces(docs, tokenizer_path, id_col, text_col, length), "pieces"), length, group_pieces)
