"""Periodic runs against all periods tried one by one."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from revlens.llm import periodic_runs as pr
from revlens.llm.queries import QUERIES

from .conftest import SCHEMA

SF = "/root/testdata/sf0.001"


def brute_runs(seq, least):
    n, out = len(seq), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if seq[i] != seq[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and seq[j] == seq[j + q]:
                j += 1
            s, e = i, j + q
            if e - s >= max(2 * q, least) and not any(all(seq[k] == seq[k + d] for k in range(s, e - d))
                                                      for d in range(1, q)):
                out.add((s, e - s, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, stretch):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if stretch and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words, 12)
    gone = {k for s, size, q in found for k in range(s + q, s + size)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_sequences_against_brute_force():
    rng = random.Random(3)
    for _ in range(600):
        n, k, least = rng.randrange(60), rng.choice([1, 2, 2, 3, 5]), rng.choice([2, 4, 12])
        seq = [rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.4 and n > 6:
            p, a = rng.randrange(1, n // 2), rng.randrange(n // 2)
            seq = [v if i < a else seq[a + (i - a) % p] for i, v in enumerate(seq)]
        got = list(zip(*(x.tolist() for x in pr.find_runs(np.array(seq, np.int64), least))))
        assert [(s, e - s, q) for s, e, q in got] == brute_runs(seq, least)


def test_tree_against_sorted_suffixes():
    rng = random.Random(8)
    for _ in range(60):
        seq = [rng.randrange(3) for _ in range(rng.randrange(1, 40))]
        tree = pr.SuffixTree([*seq, 3], 4)
        up, down = tree.ranks()
        n = len(seq)
        assert np.argsort(up)[1:].tolist() == sorted(range(n), key=lambda i: seq[i:])
        assert np.argsort(down)[1:].tolist() == sorted(range(n), key=lambda i: [-v for v in seq[i:]])
        ahead = pr.Extensions(tree)
        for a in range(n):
            for b in range(a + 1, n):
                same = 0
                while b + same < n and seq[a + same] == seq[b + same]:
                    same += 1
                assert ahead.of(np.array([a]), np.array([b]))[0] == same


def planted():
    """Runs at edges, within each other, next to each other, across documents."""
    rng = random.Random(12)
    noise = [" ".join(f"w{rng.randrange(50)}" for _ in range(80)) for _ in range(6)]
    texts = ["a " * 11, "a " * 12, "A a " * 6, "a b c d e f " * 2, "a b c d e f a b c d e", noise[0] + " x y" * 9,
             "x y " * 7 + noise[1], "a a b a a b a a b a a b a a b a a b " * 2, "a a a a b " * 5, noise[2] + " " + noise[2],
             noise[2] + " " + noise[2] + " " + noise[3], (noise[4] + "\n") * 4, "u v " * 6, "u v " * 6, "v u " * 6,
             "é\x0bü\t" * 20, "a b " * 13, " ".join("ab"[bin(i).count("1") & 1] for i in range(256)), None, "", " \n\t"]
    texts += [" ".join("ab"[rng.randrange(2)] for _ in range(70)) for _ in range(40)]
    texts += [noise[5]] * 30
    return [(i, t, "en", "a", len(t or ""), 0.0, "r") for i, t in enumerate(texts)]


@pytest.mark.parametrize("stretch", [False, True])
@pytest.mark.parametrize("tree_words", [1, 1 << 15])
def test_planted_against_brute_force(spark, stretch, tree_words):
    rows = planted()
    docs = spark.createDataFrame(rows, SCHEMA)
    got = rows_of(pr.periodic_runs(docs, stretch=stretch, tree_words=tree_words))
    assert got == sorted((brute_row(r[0], r[1], stretch) for r in rows), key=repr)
    assert sum(r[1] > 0 for r in got) > 20


def test_odd_rows(odd_docs, no_docs):
    clash = odd_docs.withColumnRenamed("n_chars", "start").withColumnRenamed("lang", "period")
    rows = odd_docs.select("doc_id", "text").collect()
    assert rows_of(pr.periodic_runs(clash, stretch=True)) == sorted((brute_row(*r, True) for r in rows), key=repr)
    assert pr.periodic_runs(no_docs).count() == 0 and pr.collapse(no_docs).count() == 0


def test_long_texts(spark):
    """Over 1 MB: one word, a phrase again and again, prose twice."""
    rng = random.Random(5)
    prose = " ".join(f"word{rng.randrange(4000)}" for _ in range(120_000))
    texts = ["ab " * 400_000, "one two three four " * 60_000, prose + " " + prose, "y" * 3_000_000, prose]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_runs"], r["start"], r["length"], r["period"]) for r in pr.periodic_runs(docs).collect()}
    assert got == {0: (1, 0, 400_000, 1), 1: (1, 0, 240_000, 4), 2: (1, 0, 240_000, 120_000),
                   3: (0, None, None, None), 4: (0, None, None, None)}


def test_query_against_brute_force(spark):
    got = rows_of(QUERIES["op12_periodic_runs"](spark, SF))
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in rows if len((r[1] or "").split()) < 600]
    want = {brute_row(*r, True) for r in short}
    assert len(got) == len(rows) and len(short) > 150 and want <= set(got)
    assert sum(r[1] > 0 for r in want) >= 10


def test_collapse(spark, odd_docs):
    rows = [(1, "a b " * 8 + "end"), (2, "one  two\nthree"), (3, None), (4, "x " * 20)]
    docs = spark.createDataFrame(rows, "los long, text string")
    assert sorted(map(tuple, pr.collapse(docs).collect())) == [(1, "a b end"), (2, "one  two\nthree"), (3, None), (4, "x")]
    assert pr.collapse(odd_docs).columns == odd_docs.columns
