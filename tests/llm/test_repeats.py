"""Substring and suffix dedup against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from revlens.llm import substring_dedup, suffix_dedup
from revlens.llm.common import PrefixHash
from revlens.llm.suffix_dedup import Suffixes, merge_sort

from .conftest import corpus, in_order

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def brute_words(rows, window):
    seen, out = set(), []
    for doc_id, text, *_ in in_order(rows):
        words = SPACE.findall(text or "")
        drop = [False] * len(words)
        grams = [tuple(words[i:i + window]) for i in range(len(words) - window + 1)]
        for i, g in enumerate(grams):
            if g in seen:
                drop[i:i + window] = [True] * window
        seen.update(grams)
        kept = " ".join(w for w, d in zip(words, drop) if not d)
        out.append((doc_id, len(words), sum(drop), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def brute_bytes(rows, window):
    seen, out = set(), []
    for doc_id, text, *_ in in_order(rows):
        raw = (text or "").encode()
        drop = [False] * len(raw)
        for i in range(len(raw) - window + 1):
            g = raw[i:i + window]
            if g in seen:
                drop[i:i + window] = [True] * window
            seen.add(g)
        kept = bytes(b for b, d in zip(raw, drop) if not d)
        spans = sum(d and not p for d, p in zip(drop, [False] + drop))
        out.append((doc_id, len(raw), sum(drop), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("odd", [False, True])
def test_substring_against_brute_force(spark, docs, odd_docs, odd):
    got = Counter(tuple(r) for r in substring_dedup.digests(odd_docs if odd else docs).collect())
    assert got == brute_words(corpus(odd), 50)


def test_substring_small_windows_and_hot_path(docs):
    from revlens.llm.common import keyed_texts
    from revlens.llm.spans import with_spans

    rows, _ = keyed_texts(docs, "doc_id", "text")
    want = brute_words(corpus(False), 6)
    for hot in (5, 10 ** 9):
        spans = substring_dedup.repeated_spans(rows, 6, hot)
        both = with_spans(rows, spans).select("id", "text", "los", "his")
        got = Counter(tuple(r) for r in both.mapInArrow(
            substring_dedup._digest, "doc_id long, n_words long, n_removed long, kept_sha256 string").collect())
        assert got == want


def test_substring_hot_anchor_across_batches(monkeypatch, docs):
    monkeypatch.setattr(substring_dedup, "TASK_WINDOWS", 3)
    import pyarrow as pa

    # three rows of one anchor, then another anchor: streamed in batches of one row
    def row(akey, rid, hashes):
        body = b"".join(int(h).to_bytes(substring_dedup.PACK, "little") for h in hashes)
        return pa.RecordBatch.from_arrays([pa.array([akey]), pa.array([rid]), pa.array([0]),
                                           pa.array([len(hashes)], pa.int32()), pa.array([body], pa.binary())],
                                          ["akey", "rid", "lo", "n", "body"])
    rows = [row(1, 5, [9, 8, 7]), row(1, 6, [9, 8, 6]), row(1, 7, [1, 8, 7]), row(2, 1, [4]), row(2, 3, [4])]
    out = [b.to_pylist() for b in substring_dedup._count_windows(10, 4)(iter(rows))]
    flat = [r for b in out for r in b]
    singles = [r for r in flat if r["wkey"] is not None]
    assert len(singles) == 9 and len({r["wkey"] for r in singles}) == 5
    assert [(r["rid"], r["lo"], r["hi"]) for r in flat if r["wkey"] is None] == [(3, 0, 10)]


@pytest.mark.parametrize("odd", [False, True])
def test_suffix_against_brute_force(docs, odd_docs, odd):
    got = Counter(tuple(r) for r in suffix_dedup.digests(odd_docs if odd else docs).collect())
    assert got == brute_bytes(corpus(odd), 100)


def test_suffix_small_windows_and_hot_path(docs):
    from revlens.llm.common import keyed_texts
    from revlens.llm.spans import with_spans

    rows, _ = keyed_texts(docs, "doc_id", "text")
    want = brute_bytes(corpus(False), 12)
    for hot in (20, 10 ** 9):
        spans = suffix_dedup.repeated_spans(rows, 12, 4, hot)
        both = with_spans(rows, spans).select("id", "text", "los", "his")
        got = Counter(tuple(r) for r in both.mapInArrow(
            suffix_dedup._digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string").collect())
        assert got == want


def test_suffix_sort_against_sorted():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    starts = np.arange(2900)
    group = np.sort(rng.integers(0, 7, 2900))
    raw = data.tobytes()
    order = merge_sort(Suffixes(data, starts, 20), group)
    want = [i for g in range(7) for i in sorted(np.flatnonzero(group == g).tolist(), key=lambda i: (raw[i:i + 20], i))]
    assert order.tolist() == want


def test_prefix_hash_is_the_same_anywhere():
    data = np.frombuffer(b"abcabcabd", np.uint8)
    h = PrefixHash.of_bytes(data).windows(3)
    assert h[0] == h[3] and h[0] != h[6] and len(PrefixHash.of_bytes(data).windows(10)) == 0


def test_empty_tables(no_docs):
    assert substring_dedup.digests(no_docs).count() == 0
    assert suffix_dedup.digests(no_docs).count() == 0


def test_removal_keeps_columns_and_clean_texts(odd_docs):
    out = substring_dedup.remove(odd_docs)
    assert out.schema == odd_docs.schema or out.columns == odd_docs.columns
    before = Counter(r["text"] for r in odd_docs.collect())
    after = out.collect()
    assert len(after) == sum(before.values())
    clean = {r["text"] for r in after}
    assert "ab" * 200 in clean and None in clean
    kept = dict(Counter(r["doc_id"] for r in suffix_dedup.remove(odd_docs).collect()))
    assert sum(kept.values()) == len(after)


def test_removal_with_clashing_columns(odd_docs):
    clash = odd_docs.withColumnRenamed("score", "los").withColumnRenamed("source", "His")
    out = substring_dedup.remove(clash)
    assert out.columns == clash.columns and out.count() == clash.count()


def test_cut_words_leaves_the_rest_as_it_stood():
    assert substring_dedup.cut_words(b"  a b\n c  d e ", [1], [3]) == b"  a d e "
    assert substring_dedup.cut_words(b"a b", [0], [2]) == b""
    assert substring_dedup.cut_words(b"a\n\nb c", [1], [3]) == b"a\n\n"


def test_runs_are_named_by_a_digest():
    a = bytes(b"ab"[bin(i).count("1") & 1] for i in range(1024))
    b = a.translate(bytes.maketrans(b"ab", b"ba"))
    data = np.frombuffer(a + b + a, np.uint8)
    cut = np.array([0, 1024, 2048, 3072])
    poly = PrefixHash.of_bytes(data).ranges(cut[:-1], cut[1:])
    assert poly[0] == poly[1]  # what a polynomial modulo 2^64 makes of them
    one, two = suffix_dedup.run_digests(data, cut[:-1], cut[1:])
    assert one[0] == one[2] != one[1] and two[0] == two[2] != two[1]


def test_suffix_on_alternating_letters(spark):
    a = "".join("ab"[bin(i).count("1") & 1] for i in range(4096))
    b = a.translate(str.maketrans("ab", "ba"))
    rows = [(0, a[:1500]), (1, b[:1500]), (2, "x" + b), (3, a[700:2100] + "c" + a[700:2100]), (4, b[:1024] + a[:1024])]
    got = suffix_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(tuple(r) for r in got) == brute_bytes(rows, 100)


@pytest.mark.parametrize("op", ["op7", "op8", "op9"])
def test_both_sides_shuffled(docs, monkeypatch, op):
    """Beyond the broadcast bound, and with more partitions than the session's."""
    from revlens.llm import common, ngram_join

    run = {"op7": ngram_join.join_classes, "op8": suffix_dedup.digests, "op9": substring_dedup.digests}[op]
    small = Counter(tuple(r) for r in run(docs).collect())
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(common, "SHUFFLE_BYTES", 10_000)
    assert Counter(tuple(r) for r in run(docs).collect()) == small


def test_partitions_follow_the_bytes(spark, monkeypatch):
    from pyspark.sql import functions as F

    from revlens.llm import common

    texts = spark.createDataFrame([("é" * 500,), (None,), ("a" * 24,)], "text string")
    conf = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert common.task_count(texts, F.octet_length("text"), 2) == conf
    monkeypatch.setattr(common, "SHUFFLE_BYTES", 64)
    assert common.task_count(texts, F.octet_length("text"), 2) == 32
    assert common.task_count(texts.limit(0), F.octet_length("text"), 2) == conf


@pytest.mark.parametrize("op", ["op5", "op13"])
def test_more_partitions_than_the_sessions(spark, sf001, docs, monkeypatch, op):
    from revlens.llm import common, conversation_trie, fingerprint

    def run():
        if op == "op5":
            return Counter(tuple(r) for r in fingerprint.fingerprint_documents(docs).collect())
        return Counter(tuple(r) for r in conversation_trie.trie_of(common.load(spark, sf001, "conversations")).collect())

    small = run()
    monkeypatch.setattr(common, "SHUFFLE_BYTES", 2_000)
    assert run() == small
