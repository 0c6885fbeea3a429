"""N-gram join and embedding dedup against brute force."""

import re
from collections import Counter

import numpy as np
import pytest

from revlens.llm import embed_dedup, ngram_join
from revlens.llm.common import components

from .conftest import corpus, in_order


def roots(n, links):
    root = list(range(n))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in links:
        a, b = sorted((find(i), find(j)))
        root[b] = a
    return [find(i) for i in range(n)]


def brute_join(rows, threshold=0.8):
    sets = []
    for r in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links = [(i, j) for i in range(len(sets)) for j in range(i)
             if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])]
    n = Counter(i for p in links for i in p)
    root = roots(len(sets), links)
    return Counter((rows[i][0], rows[root[i]][0], n[i]) for i in range(len(sets)))


@pytest.mark.parametrize("odd", [False, True])
def test_join_against_brute_force(docs, odd_docs, odd):
    got = ngram_join.join_classes(odd_docs if odd else docs).collect()
    assert Counter((r["id"], r["class_id"], r["n_links"]) for r in got) == brute_join(in_order(corpus(odd)))


def test_join_bucket_by_bucket(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "TASK_ROWS", 7)
    got = ngram_join.join_classes(docs).collect()
    assert Counter((r["id"], r["class_id"], r["n_links"]) for r in got) == brute_join(in_order(corpus(False)))


def test_join_on_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = in_order([tuple(r) for r in docs.select("doc_id", "text").collect()])
    got = ngram_join.join_classes(docs).collect()
    assert Counter((r["id"], r["class_id"], r["n_links"]) for r in got) == brute_join(rows)


def test_join_of_nothing(no_docs):
    assert ngram_join.join_classes(no_docs).count() == 0


def test_pruning_rungs():
    rungs = ngram_join.least_matches()
    assert [n for n, _ in rungs] == [32, 64, 96, 128, 160]
    rng = np.random.default_rng(0)
    for n, m in rungs:  # a pair at the threshold is hardly ever dropped, a pair at 0.4 mostly
        assert (rng.binomial(n, 0.8, 200_000) < m).mean() < 1e-4
    assert (rng.binomial(160, 0.4, 10_000) < rungs[-1][1]).mean() > 0.999


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (300, 300), (7, 3)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 150: 100}


def brute_vectors(rows, threshold=0.93):
    unit = []
    for _, v, _ in rows:
        ok = v and None not in v and np.isfinite(v).all() and np.any(v)
        unit.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    links = [(i, j) for i in range(len(rows)) for j in range(i)
             if unit[i] is not None and unit[j] is not None and rows[i][2] is not None and rows[i][2] == rows[j][2]
             and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold]
    n = Counter(i for p in links for i in p)
    root = roots(len(rows), links)
    return Counter((rows[i][0], n[i], rows[root[i]][0], root[i] == i) for i in range(len(rows)))


def vectors(n=700, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(9, dim))
    x = centre[rng.integers(0, 9, n)] + rng.normal(size=(n, dim)) * rng.choice([0.05, 0.3, 1.0], (n, 1))
    rows = [(i, [float(c) for c in np.float32(v)], int(i % 3 > 0)) for i, v in enumerate(x)]
    rows += [(n + 1, rows[5][1], rows[5][2]), (n + 2, rows[5][1], rows[5][2]), (n + 3, None, 1), (n + 4, [0.0] * dim, 1),
             (n + 5, [None] + [1.0] * (dim - 1), 1), (n + 6, [float("nan")] + [1.0] * (dim - 1), 0), (n + 7, rows[5][1], None),
             (n + 8, [1.0, 2.0], 1), (n + 9, [2.0, 4.0], 1), (n + 10, [], 1), (n + 11, [float("inf")] * dim, 1)]
    return rows


@pytest.mark.parametrize("cell,block", [(4096, 4096), (40, 25)])
def test_vectors_against_brute_force(spark, monkeypatch, cell, block):
    monkeypatch.setattr(embed_dedup, "CELL_ROWS", cell)
    monkeypatch.setattr(embed_dedup, "BLOCK_ROWS", block)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = embed_dedup.dedup(df.withColumnRenamed("label", "Home"), label_col="Home").collect()
    assert Counter(tuple(r) for r in got) == brute_vectors(rows)


def test_vectors_of_a_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = sorted(tuple(r) for r in df.select("vec_id", "embedding", "label").collect())
    got = embed_dedup.dedup(df).collect()
    assert Counter(tuple(r) for r in got) == brute_vectors(rows)


def test_odd_vector_ids(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1),
                                (4, [1.0, 0.01], 1)], "vec_id long, embedding array<double>, label int")
    got = Counter(tuple(r) for r in embed_dedup.dedup(df).collect())
    assert got == Counter({(None, 0, None, True): 2, (3, 1, 3, True): 2, (4, 1, 3, False): 1})
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>, label int")
    assert embed_dedup.dedup(empty).count() == 0


def test_vectors_in_cells_within_cells(spark, monkeypatch):
    for name, size in {"CELL_ROWS": 16, "MAX_CELLS": 8, "SPLIT_ROWS": 40, "INNER_CELLS": 6, "INNER_FIT": 50,
                       "BLOCK_ROWS": 13}.items():
        monkeypatch.setattr(embed_dedup, name, size)
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(12, 6))
    x = np.concatenate([centre[rng.integers(0, 12, 700)] + 0.35 * rng.normal(size=(700, 6)), rng.normal(size=(80, 6))])
    rows = [(i, v.tolist(), ("a", "a", "b")[i % 3]) for i, v in enumerate(x)]
    divided = []
    inner = embed_dedup.split_large_cells
    monkeypatch.setattr(embed_dedup, "split_large_cells", lambda *a: divided.append(inner(*a)) or divided[-1])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed_dedup.dedup(df).collect()}
    assert divided[0].agg({"inner": "max"}).first()[0] == 5
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    label = np.array([r[2] for r in rows])
    near = (unit @ unit.T >= 0.93) & (label[:, None] == label) & ~np.eye(len(x), dtype=bool)
    root = roots(len(x), list(zip(*np.nonzero(np.tril(near)))))
    assert got == {i: (int(near[i].sum()), root[i]) for i in range(len(x))}
    assert near.any(1).sum() > 200
