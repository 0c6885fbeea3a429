"""License scan, language id, packing, fingerprints, sharding, mixing."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from revlens.llm import fingerprint, langid, license_scan, mixing, packing, sharding
from revlens.llm.queries import tokenizer_path

from .conftest import corpus, in_order

SF = "/root/testdata/sf0.001"


# -- sharding ---------------------------------------------------------------------

def test_table_is_even_and_moves_little():
    names = [f"s{i}" for i in range(20)]
    full, less = sharding.fill_table(names, 65537), sharding.fill_table(names[:-1], 65537)
    share = np.bincount(full, minlength=20)
    assert share.max() - share.min() <= 1
    moved = ((full != less) & (full != 19)).mean()
    assert moved < 0.1
    weighted = np.bincount(sharding.fill_table(names, 65537, [2.0] + [1.0] * 19), minlength=20)
    assert 1.9 < weighted[0] / weighted[1] < 2.1
    for bad in (dict(size=100), dict(size=13), dict(weights=[0.0] * 20)):
        with pytest.raises(ValueError):
            sharding.fill_table(names, **{"size": 65537, **bad})


def test_assign_against_plain_python(odd_docs, no_docs):
    names = [f"s{i}" for i in range(7)]
    table = sharding.fill_table(names, 251)
    out = sharding.assign(odd_docs.withColumnRenamed("rid", "Slot"), "doc_id", names, 251)
    assert out.columns == [*odd_docs.withColumnRenamed("rid", "Slot").columns, "slot_", "shard"]
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 251
        assert (r["slot_"], r["shard"]) == (slot, names[table[slot]])
    assert sharding.assign(no_docs, "doc_id", names, 251).count() == 0


def test_write_sharded(spark, odd_docs, tmp_path):
    sharding.write_sharded(odd_docs, str(tmp_path / "out"), "doc_id", ["a", "b", "c"], 251)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == odd_docs.count() and set(back.columns) == {*odd_docs.columns, "slot", "shard"}


# -- license scan -------------------------------------------------------------------

def brute_license(rows):
    out = []
    for doc_id, text, *_ in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(i, label) for phrase, label in license_scan.PHRASES.items() for i in range(len(words))
                  if words[i:i + len(phrase.split())] == phrase.split()]
        spots = [i for i, _ in places]
        out.append((doc_id, len(words), len(places), min(spots, default=None), max(spots, default=None),
                    ",".join(sorted({x for _, x in places}))))
    return Counter(out)


@pytest.mark.parametrize("odd", [False, True])
def test_license_against_brute_force(docs, odd_docs, odd):
    rows = license_scan.scan(odd_docs if odd else docs).collect()
    assert Counter(tuple(r)[:6] for r in rows) == brute_license(corpus(odd))
    assert all(0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
               for r in rows)


def test_license_on_a_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert Counter(tuple(r)[:6] for r in license_scan.scan(docs).collect()) == brute_license(rows)


def test_license_passages(spark, no_docs):
    text = license_scan.TEMPLATES["mit-text"].split()
    whole, holes = " ".join(text), " ".join(text[:20] + ["inserted", "words"] + text[20:30] + text[31:])
    gap = " ".join(text[:22] + ["z"] * 10 + text[22:])
    far = " ".join(text[:22] + ["z"] * 40 + text[22:])
    half = " ".join(text[:15])
    df = spark.createDataFrame([(1, f"Intro. {whole.upper()}, end"), (2, f"a b {holes}"), (3, half),
                                (4, "x " * 700_000 + whole), (5, f"q {gap} q"), (6, far)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.scan(df).collect()}
    n = len(text)
    assert got[1]["labels"] == "mit-text" and got[1]["score"] == 1.0 and got[1]["n_base"] == 0
    assert got[1]["spans"] == f"mit-text:1:{1 + n}"
    assert got[2]["labels"] == "mit-text" and 0.9 < got[2]["score"] < 1.0 and got[2]["spans"] == f"mit-text:2:{n + 3}"
    assert got[3]["labels"] == got[3]["spans"] == ""
    assert got[4]["labels"] == "mit-text" and got[4]["spans"] == f"mit-text:700000:{700_000 + n}"
    assert got[5]["score"] == 1.0 and got[5]["spans"] == f"mit-text:1:{1 + n + 10}"
    assert got[6]["labels"] == ""
    assert license_scan.scan(no_docs).count() == 0


def plain_license(text):
    """Labels and best cover by trying every template on every diagonal, no grams, no votes."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    found = {}
    for label, passage in license_scan.TEMPLATES.items():
        want = passage.split()
        for d in range(-len(want) + 1, len(words)):
            same = sum(0 <= t + d < len(words) and words[t + d] == w for t, w in enumerate(want))
            if same >= license_scan.MIN_COVER * len(want):
                found[label] = max(found.get(label, 0), same / len(want))
    return found


def test_license_labels_and_scores_against_every_diagonal(spark):
    rng = np.random.default_rng(7)
    texts = []
    for label, passage in license_scan.TEMPLATES.items():
        words = passage.split()
        texts += [passage, f"before {passage.title()} after", " ".join(words[:len(words) * 7 // 10])]
        changed = list(words)
        changed[int(rng.integers(5, len(words) - 2)) if len(words) > 8 else 0] = "zzz"
        texts += [" ".join(changed), " ".join(reversed(words))]
    texts += [" ".join(rng.choice("the a of to license software".split(), 60))for _ in range(10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in license_scan.scan(docs).collect():
        want = plain_license(texts[r["doc_id"]])
        labels = {x for x in r["labels"].split(",") if x and x in license_scan.TEMPLATES}
        assert labels == set(want), texts[r["doc_id"]]
        if not r["n_base"]:
            assert abs(r["score"] - max(want.values(), default=0)) < 1e-9
        for span in filter(None, r["spans"].split(",")):
            label, a, b = span.split(":")
            assert 0 <= int(a) < int(b) <= r["n_words"] and label in r["labels"].split(",")


# -- language id --------------------------------------------------------------------

def test_langid_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    langs, matrix = langid.fit_open_fold(docs)
    rows = langid.predict(docs.withColumn("h", langid.held_out(docs.doc_id)), langs, matrix).collect()
    test = [r for r in rows if r["h"] and r["lang"] is not None and r["lang_pred"] != "und"]
    assert len(test) > 150 and all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert np.mean([r["lang"] == r["lang_pred"] for r in test]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def plain_features(text):
    """Hashed n-grams of a text, with the operator's own features one text at a time."""
    data = np.frombuffer(text.encode(), np.uint8)
    f, _ = langid.features(data, np.array([0, len(data)]), langid.BUCKETS)
    return f.ravel().tolist()


def test_langid_predictions_against_plain_naive_bayes(spark):
    """Counts, priors, sums of logarithms and posteriors in plain Python over all rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rows = [tuple(r) for r in docs.collect()]
    train = [r for r in rows if r[1] is not None and r[2] is not None and zlib.crc32(str(r[0]).encode()) % 4 != 2]
    counts, docs_of = defaultdict(Counter), Counter(r[2] for r in train)
    for _, text, lang in train:
        counts[lang].update(plain_features(text))
    total = {k: sum(c.values()) + langid.SMOOTHING * langid.BUCKETS for k, c in counts.items()}
    langs, matrix = langid.fit_open_fold(docs)
    got = {r["doc_id"]: r for r in langid.predict(docs, langs, matrix).collect()}
    for i, text, _ in rows:
        own = plain_features(text or "")
        if not own:
            assert got[i]["lang_pred"] == "und"
            continue
        score = {k: np.log(docs_of[k] / len(train)) + sum(np.log((counts[k][f] + langid.SMOOTHING) / total[k]) for f in own)
                 for k in docs_of}
        best = max(score, key=score.get)
        second = sorted(score.values())[-2]
        post = 1 / sum(np.exp(v - score[best]) for v in score.values())
        assert got[i]["lang_pred"] == best or score[best] - second < 1e-2
        assert abs(got[i]["score"] - post) < 1e-3 * max(1, len(own) / 500)


def test_langid_counts_against_plain_python(spark):
    texts = [(1, "Ab c", "x"), (3, "ÉÉ", "y"), (4, "", "x"), (5, None, "x"), (6, "z", None), (None, "q", "x")]
    langs, matrix = langid.fit(spark.createDataFrame(texts, "doc_id long, text string, lang string"), buckets=1 << 10)
    assert langs == ["x", "y"] and matrix.shape == ((1 << 10) + 1, 2)
    # 3 letters x 3 features in x, 2 x 3 in y
    for j, letters in ((0, 3), (1, 2)):
        p = np.exp(matrix[:-1, j].astype(float))
        total = letters * 3 + langid.SMOOTHING * (1 << 10)
        assert abs(p.sum() - 1) < 1e-3
        assert round(((p * total) - langid.SMOOTHING).sum()) == letters * 3


def test_langid_defined_results(spark, odd_docs, no_docs):
    langs, matrix = langid.fit(odd_docs)
    out = langid.predict(odd_docs, langs, matrix)
    assert out.columns == [*odd_docs.columns, "lang_pred", "score_"]
    for r in out.collect():
        has = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not has) and (has or r["score_"] == 0)
    langs, matrix = langid.fit(no_docs)
    assert langs == [] and {r["lang_pred"] for r in langid.predict(odd_docs, langs, matrix).collect()} == {"und"}
    assert langid.predict(no_docs, langs, matrix).count() == 0


def test_langid_bounded_sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    langs, matrix = langid.fit(docs, fit_docs=20)
    rows = [r for r in langid.predict(docs, langs, matrix).collect() if r["lang_pred"] != "und"]
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.9


# -- packing --------------------------------------------------------------------------

def check_packing(rows, texts, length):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for doc_id, text, *_ in texts:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
        for s in range(0, len(ids), length):
            part = ids[s:s + length]
            want[(doc_id, s, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    seqs = defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return seqs


@pytest.mark.parametrize("odd", [False, True])
def test_packing_round_trip(docs, odd_docs, odd):
    rows = packing.pack_documents(odd_docs if odd else docs, tokenizer_path(), length=128, group_pieces=40).collect()
    check_packing(rows, corpus(odd), 128)


def test_packing_a_table(spark, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack_documents(docs, tokenizer_path()).collect()
    seqs = check_packing(rows, [tuple(r) for r in docs.select("doc_id", "text").collect()], 4096)
    used = sum(n for p in seqs.values() for _, n in p)
    assert used / (4096 * len(seqs)) > 0.97
    assert packing.pack_documents(no_docs, tokenizer_path()).count() == 0


def test_groups_of_null_ids_and_equal_texts_stay_small(spark):
    docs = spark.range(0, 4000, 1, 4).selectExpr("IF(id % 2 = 0, NULL, 7L) AS doc_id", "'one two three' AS text")
    rows = packing.pack_documents(docs, tokenizer_path(), length=128, group_pieces=100).collect()
    check_packing(rows, [(None, "one two three"), (7, "one two three")] * 2000, 128)
    assert max(Counter(r["sequence_id"] >> 31 for r in rows).values()) < 200


def test_units_agree_with_the_tokenizer(monkeypatch):
    monkeypatch.setattr(packing, "KEPT_UNITS", 12)
    enc = packing.UnitEncoder(tokenizer_path())
    assert enc.plain
    texts = ["It's we'll  don't x'sy 'tis", "a\x1cb c\x1fd\x00e", "tab\tnew\nline nbsp\u00a0wide\u3000x\u2028y\u0085z",
             "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|> <| a", "e\u0301 É Å A\u030a ﬁ İI ßß ǅ", "ΣΑΣ Σ", "w" * 300 + " Tail",
             "", "12 ³ Ⅷ a1b2 3.14,15", "  x y", "ab" * 50 + " c", "Çêre, «dé» é×é 2÷3 naïve-ly... é!é", "日本語、テスト。abc中文def",
             "a\u200bb \ufeff 👍🏽!! ok", "don\u2019t — no…, \u00a1Hola!", "\u00ad x \u0344", "UPPER Lower É.É,é"]
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in data])])
    for _ in range(3):
        ids, cut = enc.encode(np.frombuffer(b"".join(data), np.uint8), offsets)
        for i, t in enumerate(texts):
            assert ids[cut[i]:cut[i + 1]].tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids, t
    enc.plain = False
    whole, again = enc.encode(np.frombuffer(b"".join(data), np.uint8), offsets)
    assert whole.tolist() == ids.tolist() and again.tolist() == cut.tolist()


@pytest.mark.parametrize("seed", range(4))
def test_units_of_random_texts(seed):
    rng = np.random.default_rng(seed)
    enc = packing.UnitEncoder(tokenizer_path())
    signs = [*"abzABZ019 .,'\"<|>-_\t\n", "é", "É", "×", "ß", "\u00a0", "\u0301", "中", "…", "ſ", "\u2003", "'s", "'LL", "\x7f", "ʼ"]
    texts = ["".join(rng.choice(signs, rng.integers(0, 60))) for _ in range(400)]
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in data])])
    ids, cut = enc.encode(np.frombuffer(b"".join(data), np.uint8), offsets)
    for i, t in enumerate(texts):
        assert ids[cut[i]:cut[i + 1]].tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_first_fit_decreasing_against_plain_loop():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 300):
        sizes = np.sort(rng.integers(1, 100, n))[::-1]
        free, want = [], []
        for s in sizes:
            b = next((i for i, f in enumerate(free) if f >= s), len(free))
            if b == len(free):
                free.append(100)
            want.append((b, 100 - free[b]))
            free[b] -= s
        bins, offsets = packing.first_fit_decreasing(sizes, 100)
        assert list(zip(bins.tolist(), offsets.tolist())) == [(int(a), int(b)) for a, b in want]


# -- fingerprints -----------------------------------------------------------------------

@pytest.mark.parametrize("odd", [False, True])
def test_fingerprints_against_plain_order(docs, odd_docs, odd):
    rows = [(r[0], r[1] or "") for r in reversed(in_order(corpus(odd)))]
    out = fingerprint.fingerprint_documents(odd_docs if odd else docs).collect()
    want = Counter()
    for i, (doc_id, text) in enumerate(rows):
        edited = fingerprint.edit(text, rows[(i + 1) % len(rows)][1])
        want[(doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest())] += 1
    assert Counter(tuple(r)[:3] for r in out) == want
    texts = {r["edited_sha256"]: r for r in out}
    prints = fingerprint.fingerprints([t.encode() for _, t in rows])
    by_sha = {}
    for i, (_, text) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        edited = fingerprint.edit(text, nxt)
        two = fingerprint.fingerprints([edited.encode()])[0]
        r = [x for x in out if x["doc_id"] == rows[i][0] and x["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()][0]
        assert r["fingerprint"] == prints[i].astype(">u2").tobytes().hex()
        assert r["edited_fingerprint"] == two.astype(">u2").tobytes().hex()
        assert r["near_edited"] == fingerprint.likeness(prints[i], two)
        assert r["near_next"] == fingerprint.likeness(prints[i], prints[(i + 1) % len(rows)])


def test_likeness_estimates_generalised_jaccard():
    rng = np.random.default_rng(3)
    for _ in range(6):
        a, b = (Counter(rng.integers(0, 60, rng.integers(50, 400)).tolist()) for _ in range(2))
        low, high = sum((a & b).values()), sum((a | b).values())
        x, y = fingerprint.fingerprints([" ".join(f"t{k}" for k in c.elements()).encode() for c in (a, b)], 2048)
        assert abs(fingerprint.likeness(x, y) - low / high) < 0.05


def test_likeness_of_many_distinct_words():
    """200,000 words, half of them once in one text and four times in the other: likeness 0.4.

    Over four word sets of 256 samples, so with a standard error of 0.015 (one set alone has 0.031)."""
    n, seen = 200_000, []
    for tag in ("t", "u", "word", "x9"):
        once, often = (" ".join(f"{tag}{k}" for k in np.repeat(np.arange(n), np.where(np.arange(n) < n // 2, w, 1))).encode()
                       for w in (1, 4))
        a, b = fingerprint.fingerprints([once, often], 256)
        seen.append(fingerprint.likeness(a, b))
    assert abs(np.mean(seen) - 0.4) < 0.05


def test_single_and_empty(spark, no_docs):
    one = spark.createDataFrame([(5, "ab cd")], "doc_id long, text string")
    r = fingerprint.fingerprint_documents(one).collect()[0]
    assert r["near_next"] == 1.0 and r["edited_sha256"] == hashlib.sha256(b"ab ab").hexdigest()
    assert fingerprint.fingerprint_documents(no_docs).count() == 0


# -- mixing ------------------------------------------------------------------------------

def brute_targets(sizes, weights, cap=3):
    target, open_ = {}, set(sizes)
    total = sum(sizes.values())
    while open_:
        left = total - sum(target.values())
        w = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / w > cap * sizes[s]}
        if not over:
            return target | {s: left * weights[s] / w for s in open_}
        target |= {s: cap * sizes[s] for s in over}
        open_ -= over
    return target


@pytest.mark.parametrize("odd", [False, True])
def test_mix(docs, odd_docs, odd):
    rows = corpus(odd)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += count(r[1])
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: 1 + i % 3 for i, s in enumerate(order)}
    want = brute_targets(dict(sizes), weights)
    sized = mixing.sized_documents(odd_docs if odd else docs)
    plan = mixing.plan_mix(sized)
    out = plan.collect()
    assert Counter((r["doc_id"], r["source"], r["size"], r["source_size"]) for r in out) == \
        Counter((r[0], r[3], count(r[1]), sizes[r[3]]) for r in rows)
    taken = defaultdict(int)
    for r in out:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(taken[s] == int(want[s] + 1e-9) for s in order)
    made = mixing.curriculum(plan).collect()
    assert sum(r["words"] for r in made) == sum(taken.values())
    made.sort(key=lambda r: r["place"])
    assert [r["place"] for r in made] == list(range(len(made)))
    assert [r["position"] for r in made] == sorted(r["position"] for r in made)
    placed = mixing.training_places(plan).collect()
    assert sorted(x for r in placed for x in r["places"]) == list(range(len(made)))
    by_row = defaultdict(list)
    for r in sorted(made, key=lambda r: r["copy"]):
        by_row[r["row"]].append((r["position"], r["place"]))
    for r in placed:
        assert list(zip(r["positions"], r["places"])) == by_row[r["row"]] and r["copies"] == len(r["places"])
        assert r["position"] == (r["positions"][0] if r["positions"] else None)
    assert all(0 <= r["position"] <= 1 for r in made)
    again = mixing.plan_mix(mixing.sized_documents((odd_docs if odd else docs).repartition(5))).collect()
    pick = lambda rs: Counter((r["doc_id"], r["size"], r["taken"], r["position"]) for r in rs)
    assert pick(out) == pick(again)


def test_ramp_shifts_a_source(spark):
    from pyspark.sql import functions as F

    shares = [i / 50 for i in range(51)]
    rows = spark.createDataFrame([(s,) for s in shares], "s double").select(
        *[mixing.invert_ramp(F.col("s"), F.lit(a), F.lit(b)) for a, b in ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))]).collect()
    for r, s in zip(rows, shares):
        for t, (a, b) in zip(r, ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))):
            assert abs(a * t + (b - a) * t * t / 2 - s * (a + b) / 2) < 1e-9


@pytest.mark.parametrize("bound", [0, 1 << 20])
def test_many_sources_against_plain_targets(spark, monkeypatch, bound):
    """5000 sources, one with a third of the words, some empty; joined by a shuffle or broadcast."""
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", bound)
    rng = np.random.default_rng(6)
    words = {f"s{i:04d}": int(n) for i, n in enumerate(rng.integers(0, 9, 5000))} | {"s0007": 9000}
    rows = [(i, s, " ".join(["w"] * n)) for i, (s, n) in enumerate(words.items())]
    plan = mixing.plan_mix(mixing.sized_documents(spark.createDataFrame(rows, "doc_id long, source string, text string")))
    want = brute_targets(words, {s: 1 + i % 3 for i, s in enumerate(sorted(words))})
    got = {r["source"]: r for r in plan.collect()}
    assert set(got) == set(words)
    for s, r in got.items():
        assert abs(r["target"] - want[s]) < 1e-6 * max(1, want[s]) and r["taken"] == int(want[s] + 1e-9)


def test_mix_of_nothing(no_docs):
    assert mixing.plan_mix(mixing.sized_documents(no_docs)).count() == 0
