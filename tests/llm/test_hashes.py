"""Words whose polynomial hashes modulo 2^64 collide: Thue-Morse letters."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from revlens.llm import fingerprint, ngram_join, packing, substring_dedup
from revlens.llm.common import same_words, word_hashes
from revlens.llm.queries import tokenizer_path


def thue_morse(n):
    word = "".join("ab"[bin(i).count("1") & 1] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [64, 1024, 2048, 4096])
def test_hashes_differ_and_bytes_are_compared(n):
    a, b = thue_morse(n)
    data = np.frombuffer((a + b + a).encode(), np.uint8)
    starts, ends = np.array([0, n, 2 * n]), np.array([n, 2 * n, 3 * n])
    for seed in (0, 1):
        h = word_hashes(data, starts, ends, seed)
        assert h[0] == h[2] != h[1]
    assert (word_hashes(data, starts, ends) != word_hashes(data, starts, ends, 1)).all()
    assert same_words(data, starts, ends, data, starts[[0, 0, 0]], ends[[0, 0, 0]]).tolist() == [True, False, True]


def test_word_hashes_against_the_words():
    rng = np.random.default_rng(5)
    words = [bytes(rng.integers(97, 100, k).astype(np.uint8)) for k in [*range(1, 140), *[9] * 50, *[17] * 50]]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    h = word_hashes(data, starts, ends)
    assert len(set(h.tolist())) == len(set(words))
    assert all(len({int(x) for x, v in zip(h, words) if v == w}) == 1 for w in words)


@pytest.fixture(scope="module")
def twins(spark):
    rows = []
    for n in (1024, 2048, 4096):
        a, b = thue_morse(n)
        head = " ".join(f"w{n}x{i}" for i in range(49))
        rows += [(len(rows) + k, t) for k, t in enumerate((a, b, f"{head} {a}", f"{head} {b}"))]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_packed_ids_are_the_tokenizers(twins):
    rows, docs = twins
    whole = packing.encoder(tokenizer_path()).whole
    want = {i: zlib.crc32(np.array([*whole(t), packing.END_ID], "<u4").tobytes()) for i, t in rows}
    got = {r["doc_id"]: r["ids_crc32"] for r in packing.pieces(docs, tokenizer_path(), length=10**6).collect()}
    assert got == want


def test_units_that_share_a_name_are_asked_singly(monkeypatch):
    monkeypatch.setattr(packing, "word_hashes", lambda d, s, e, seed=0: word_hashes(d, s, e, seed) % np.uint64(3))
    enc = packing.UnitEncoder(tokenizer_path())
    for texts in (["a cat sat on the mat", "12 other cats sat there"], ["the cat: é, don't", "mat", ""]):
        raw = [t.encode() for t in texts]
        ids, cut = enc.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(t) for t in raw]))
        assert [ids[x:y].tolist() for x, y in zip(cut[:-1], cut[1:])] == [enc.whole(t) for t in texts]


def test_no_window_is_taken_for_another(twins):
    rows, docs = twins
    got = {r["doc_id"]: r for r in substring_dedup.digests(docs).collect()}
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        assert (got[i]["n_words"], got[i]["n_removed"]) == (len(words), 0)
        assert got[i]["kept_sha256"] == hashlib.sha256(" ".join(words).encode()).hexdigest()


def test_no_link_without_a_common_shingle(twins):
    rows, docs = twins
    alone = docs.where("doc_id % 4 < 2")
    assert all(r["n_links"] == 0 and r["class_id"] == r["id"] for r in ngram_join.join_classes(alone).collect())


def test_word_digests_see_words_only():
    texts = [b"One two", b" one, TWO!", b"one tw o", b"", b"...", b"onetwo", b"one two one"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    whole, _, _ = ngram_join.shingle_sets(data, offsets)
    names = list(zip(*whole.tolist()))
    assert names[0] == names[1] and names[3] == names[4] and len(set(names)) == 5


def test_fingerprints_differ():
    for n in (1024, 2048, 4096):
        a, b = (t.encode() for t in thue_morse(n))
        one, two = fingerprint.fingerprints([a, b])
        assert fingerprint.likeness(one, two) < 0.2
