"""License scan by diagonal voting.

Every rolling word k-gram of a text is hashed and joined in Spark with the
index (gram hash -> template, position) of a fixed set of license texts and
phrases; the index is broadcast, its size does not depend on the data. A hit
at word ``p`` of the text and ``t`` of the template votes for the diagonal
``p - t``. Neighbouring diagonals (a few words inserted or missing) are
merged, farther ones too where words were put in or left out inside, and the
merged span is verified word by word against the template and returned.

The rows of a document (a header with its text, then its grams) leave one
task in order and pass a broadcast join, which is narrow, so votes are
counted where the text is, with no shuffle; out-of-order rows are refused.

Defined results: null text counts as empty: 0 words, no labels, score 0; a
null id stays null; repeated rows are scanned one by one; empty tables give
no rows; matches never cross documents.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import (ALNUM, LOWER, PrefixHash, byte_column, col, doc_chunks, tidy, word_hashes,
                                word_spans)

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# The phrases of the contract and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Well-known license texts, notices and lines, by label.
TEMPLATES = {
    "mit-whole": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                 "associated documentation files the software to deal in the software without restriction including "
                 "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                 "copies of the software and to permit persons to whom the software is furnished to do so subject to "
                 "the following conditions the above copyright notice and this permission notice shall be included in "
                 "all copies or substantial portions of the software the software is provided as is without warranty "
                 "of any kind express or implied including but not limited to the warranties of merchantability fitness "
                 "for a particular purpose and noninfringement in no event shall the authors or copyright holders be "
                 "liable for any claim damages or other liability whether in an action of contract tort or otherwise "
                 "arising from out of or in connection with the software or the use or other dealings in the software",
    "isc-whole": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
                 "hereby granted provided that the above copyright notice and this permission notice appear in all copies "
                 "the software is provided as is and the author disclaims all warranties with regard to this software "
                 "including all implied warranties of merchantability and fitness in no event shall the author be liable "
                 "for any special direct indirect or consequential damages or any damages whatsoever resulting from loss "
                 "of use data or profits whether in an action of contract negligence or other tortious action arising out "
                 "of or in connection with the use or performance of this software",
    "bsd-2-whole": "redistribution and use in source and binary forms with or without modification are permitted provided "
                   "that the following conditions are met 1 redistributions of source code must retain the above copyright "
                   "notice this list of conditions and the following disclaimer 2 redistributions in binary form must "
                   "reproduce the above copyright notice this list of conditions and the following disclaimer in the "
                   "documentation and or other materials provided with the distribution this software is provided by the "
                   "copyright holders and contributors as is and any express or implied warranties including but not "
                   "limited to the implied warranties of merchantability and fitness for a particular purpose are "
                   "disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect "
                   "incidental special exemplary or consequential damages including but not limited to procurement of "
                   "substitute goods or services loss of use data or profits or business interruption however caused and "
                   "on any theory of liability whether in contract strict liability or tort including negligence or "
                   "otherwise arising in any way out of the use of this software even if advised of the possibility of "
                   "such damage",
    "apache-notice": "licensed under the apache license version 2 0 the license you may not use this file except in "
                     "compliance with the license you may obtain a copy of the license at http www apache org licenses "
                     "license 2 0 unless required by applicable law or agreed to in writing software distributed under "
                     "the license is distributed on an as is basis without warranties or conditions of any kind either "
                     "express or implied see the license for the specific language governing permissions and limitations "
                     "under the license",
    "gpl-whole-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                        "general public license as published by the free software foundation either version 3 of the "
                        "license or at your option any later version this program is distributed in the hope that it will "
                        "be useful but without any warranty without even the implied warranty of merchantability or "
                        "fitness for a particular purpose see the gnu general public license for more details you should "
                        "have received a copy of the gnu general public license along with this program",
    "zlib-whole": "this software is provided as is without any express or implied warranty in no event will the authors be "
                  "held liable for any damages arising from the use of this software permission is granted to anyone to "
                  "use this software for any purpose including commercial applications and to alter it and redistribute "
                  "it freely subject to the following restrictions 1 the origin of this software must not be "
                  "misrepresented you must not claim that you wrote the original software if you use this software in a "
                  "product an acknowledgment in the product documentation would be appreciated but is not required 2 "
                  "altered source versions must be plainly marked as such and must not be misrepresented as being the "
                  "original software 3 this notice may not be removed or altered from any source distribution",
    "unlicense": "this is free and unencumbered software released into the public domain anyone is free to copy modify "
                 "publish use compile sell or distribute this software either in source code form or as a compiled binary "
                 "for any purpose commercial or non commercial and by any means",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software "
                "and associated documentation files the software to deal in the software without restriction "
                "including without limitation the rights to use copy modify merge publish distribute "
                "sublicense and or sell copies of the software",
    "apache-header": "licensed under the apache license version 2 0 the license you may not use this file "
                     "except in compliance with the license you may obtain a copy of the license at",
    "apache-line": "licensed under the apache license version 2 0",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of "
                  "the gnu general public license as published by the free software foundation",
    "gpl-line": "this work is licensed under the gnu general public license version 3",
    "mit-line": "released under the mit license",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted "
                "provided that the following conditions are met",
    "mpl-header": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "isc-text": "permission to use copy modify and or distribute this software for any purpose with or without "
                "fee is hereby granted",
    "cc-by-line": "this work is licensed under a creative commons attribution",
}

PHRASE_GRAM = 2   # words of a gram for the phrases
TEXT_GRAM = 4     # words of a gram for the passages
NEIGHBOUR = 3     # diagonals up to so far apart are one ...
GAP_PART = 4      # ... or up to this part of the passage: words may be put in or left out inside
MIN_COVER = 0.8   # part of a passage's words that must be verified

OUT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
       "labels string, score double, spans string")
HEADER = 0        # the gram value of a document's header row


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` word hashes; never HEADER."""
    h = PrefixHash(words).windows(size) + np.uint64(size)
    return np.where(h == HEADER, np.uint64(1), h)


def templates() -> list[tuple[str, list[bytes], int, bool]]:
    """(label, words, gram size, is a phrase of the contract)."""
    rows = [(label, p.encode().split(), PHRASE_GRAM, True) for p, label in PHRASES.items()]
    return rows + [(label, t.encode().split(), TEXT_GRAM, False) for label, t in TEMPLATES.items()]


def index(spark: SparkSession) -> DataFrame:
    """(gram, tmpl, tpos), with the header row's own entry."""
    rows = [(HEADER, -1, 0)]
    for i, (_, words, size, _) in enumerate(templates()):
        text = np.frombuffer(b" ".join(words), np.uint8)
        starts, ends, _ = word_spans(text, np.array([0, len(text)]), ALNUM)
        grams = gram_hashes(word_hashes(text, starts, ends), size).view(np.int64).tolist()
        rows += [(g, i, t) for t, g in enumerate(grams)]
    return spark.createDataFrame(rows, "gram long, tmpl int, tpos int")


def emit_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document a header row (its text, its number of words), then a row
    per gram of either size with its position."""
    seq = 0
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        data, offsets = byte_column(texts)
        for lo, hi in doc_chunks(offsets):
            part = LOWER[data[offsets[lo]:offsets[hi]]]
            starts, ends, cut = word_spans(part, offsets[lo:hi + 1] - offsets[lo], ALNUM)
            words, n, docs = word_hashes(part, starts, ends), np.diff(cut), hi - lo
            # grams that end inside their document, by position; then headers in front
            pos = np.arange(len(words)) - np.repeat(cut[:-1], n)
            left = np.repeat(n, n) - pos
            doc = np.repeat(np.arange(docs), n)
            keys, docs_of, at = [np.zeros(docs, np.uint64)], [np.arange(docs)], [n]
            for size in (PHRASE_GRAM, TEXT_GRAM):
                g = gram_hashes(words, size)
                ok = np.flatnonzero(left[:len(g)] >= size)
                keys.append(g[ok])
                docs_of.append(doc[ok])
                at.append(pos[ok])
            gram, owner, where = np.concatenate(keys), np.concatenate(docs_of), np.concatenate(at)
            order = np.argsort(owner, kind="stable")
            gram, owner, where = gram[order], owner[order], where[order]
            head = np.concatenate([[True], owner[1:] != owner[:-1]])
            source = np.where(head, lo + owner, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner + seq + lo), ids.take(pa.array(source, mask=~head)),
                 texts.take(pa.array(source, mask=~head)), pa.array(where.astype(np.int32)),
                 pa.array(gram.view(np.int64))], ["seq", "doc_id", "text", "n", "gram"])
        seq += len(ids)


Span = tuple[int, int, str]


def _judge(text: bytes, hits: dict[int, list[tuple[int, int]]]) -> tuple[list[int], set[str], set[str], float, list[Span]]:
    """(places of phrases, base labels, labels, score, spans of words) of a document with hits."""
    words = WORD.findall(text.lower())
    places: list[int] = []
    base: set[str] = set()
    labels: set[str] = set()
    spans: list[Span] = []
    score = 0.0
    for tmpl, found in hits.items():
        label, want, size, phrase = templates_()[tmpl]
        votes: dict[int, list[int]] = defaultdict(list)
        for p, t in found:
            votes[p - t].append(t)
        if phrase:  # every gram must vote, then every word must agree
            for d, ts in votes.items():
                if d >= 0 and len(set(ts)) == len(want) - size + 1 and words[d:d + len(want)] == want:
                    places.append(d)
                    base.add(label)
                    spans.append((d, d + len(want), label))
            continue
        apart = max(NEIGHBOUR, len(want) // GAP_PART)
        diagonals = sorted(votes)
        group = [diagonals[0]]
        for d in diagonals[1:] + [None]:
            if d is not None and d - group[-1] <= apart:
                group.append(d)
                continue
            # on each diagonal, the words between its first and its last vote that agree;
            # the passage's beginning and end are looked for on the outermost ones
            head, tail = min(group, key=lambda g: min(votes[g])), max(group, key=lambda g: max(votes[g]))
            agreed: dict[int, int] = {}
            for g in group:
                lo, hi = min(votes[g]), max(votes[g]) + size
                for t in range(0 if g == head else lo, len(want) if g == tail else hi):
                    if 0 <= t + g < len(words) and words[t + g] == want[t]:
                        agreed.setdefault(t, t + g)
            cover = len(agreed) / len(want)
            if cover >= MIN_COVER:
                labels.add(label)
                score = max(score, cover)
                spans.append((min(agreed.values()), max(agreed.values()) + 1, label))
            group = [d]
    return places, base, labels | base, 1.0 if places else score, sorted(spans)


_TEMPLATES: list = []


def templates_() -> list:
    if not _TEMPLATES:
        _TEMPLATES.extend(templates())
    return _TEMPLATES


def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per header from a document's header and hit rows."""
    names = [f.split()[0] for f in OUT.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.string()]
    now, last = None, -1

    def close(doc) -> tuple:
        _, doc_id, text, n, hits = doc
        if not hits:
            return doc_id, n, 0, None, None, "", "", 0.0, ""
        places, base, labels, score, spans = _judge(text or b"", hits)
        return (doc_id, n, len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(base)), ",".join(sorted(labels)), score, ",".join(f"{x}:{a}:{b}" for a, b, x in spans))

    for batch in batches:
        rows = []
        seq, tmpl = batch.column(0).to_numpy(), batch.column(4).to_numpy()
        ids, ns, tpos = batch.column(1), batch.column(3).to_numpy(), batch.column(5).to_numpy()
        texts = batch.column(2)
        for i in range(len(seq)):
            if tmpl[i] < 0:
                if now is not None:
                    rows.append(close(now))
                if seq[i] <= last:
                    raise RuntimeError("rows of the license scan came out of order")
                last = int(seq[i])
                after = i + 1 == len(seq) or tmpl[i + 1] >= 0  # only texts with hits are fetched
                now = (last, ids[i].as_py(), texts[i].as_py() if after else None, int(ns[i]), defaultdict(list))
            else:
                if now is None or seq[i] != now[0]:
                    raise RuntimeError("rows of the license scan came out of order")
                now[4][int(tmpl[i])].append((int(ns[i]), int(tpos[i])))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(close(now), kinds)], names)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """License findings of every document."""
    rows = docs.select(col(id_col).cast("long").alias("doc_id"),
                       col(text_col).cast("string").cast("binary").alias("text"))
    grams = rows.mapInArrow(tidy(emit_grams), "seq long, doc_id long, text binary, n int, gram long")
    hits = grams.join(F.broadcast(index(docs.sparkSession)), "gram", "inner")
    return hits.select("seq", "doc_id", "text", "n", "tmpl", "tpos").mapInArrow(tidy(vote), OUT)
