"""Every pipeline stage against brute force on its own input."""

from collections import Counter, defaultdict

import corpus_pipeline as p
import pytest
from pyspark.sql import functions as F

from revlens.llm import langid

from .conftest import corpus, in_order
from .test_documents import brute_targets, check_packing
from .test_pairs import brute_join
from .test_repeats import SPACE, brute_words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def check_stages(spark, docs, length=4096):
    now = docs
    for name, stage in p.STAGES:
        before = rows_of(now)
        out = stage(spark, now, "").cache()
        if name != "pack":
            assert out.columns == now.columns
        if name == "language_id":
            langs, matrix = langid.fit_open_fold(now)
            told = langid.predict(now, langs, matrix).collect()
            assert Counter(rows_of(out)) == Counter(tuple(r[c] for c in COLUMNS) for r in told
                                                    if r[-2] != "und" and r[-1] >= p.MIN_POSTERIOR)
        elif name == "near_duplicates":
            ordered = in_order(before)
            keys = brute_join([(i, *r[1:]) for i, r in enumerate(ordered)])
            assert Counter(rows_of(out)) == Counter(ordered[i] for i, root, _ in keys.elements() if i == root)
        elif name == "repeated_passages":
            got = Counter()
            by = defaultdict(list)
            for r in before:
                by[r[0], r[3]].append(len(SPACE.findall(r[1] or "")))
            want = Counter((i, n - gone) for i, n, gone, _ in brute_words(before, 50).elements())
            for r in rows_of(out):
                got[r[0], len(SPACE.findall(r[1] or ""))] += 1
                assert r[1] is None or r[4] == len(r[1])
            assert got == want
            untouched = {i for i, _, gone, _ in brute_words(before, 50) if not gone}
            texts = {(r[0], r[1]) for r in before}
            assert all((r[0], r[1]) in texts for r in rows_of(out) if r[0] in untouched and r[0] is not None
                       and sum(x[0] == r[0] for x in before) == 1)
        elif name == "source_mix":
            sizes, taken = defaultdict(int), defaultdict(int)
            for r in before:
                sizes[r[3]] += len(SPACE.findall(r[1] or ""))
            order = sorted(sizes, key=lambda s: (s is None, s or ""))
            want = brute_targets(dict(sizes), {s: 1 + i % 3 for i, s in enumerate(order)})
            for r in rows_of(out):
                taken[r[3]] += len(SPACE.findall(r[1]))
            assert all(taken[s] == int(want[s] + 1e-9) for s in order)
            assert max(Counter(r[0] for r in rows_of(out)).values(), default=0) <= 3 * max(
                Counter(r[0] for r in before).values(), default=0)
        else:
            check_packing([tuple(r) for r in out.collect()] and out.collect(), before, length)
        now = out


def test_stages_on_a_table(spark):
    check_stages(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


@pytest.mark.parametrize("odd", [False, True])
def test_stages_on_odd_rows(docs, odd_docs, spark, odd):
    check_stages(spark, odd_docs if odd else docs)


def test_run(spark, no_docs, tmp_path):
    assert p.run(spark, "/root/testdata/sf0.001").count() > 0
    no_docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert p.run(spark, str(tmp_path)).count() == 0


def test_single_stages_on_odd_rows(odd_docs, spark):
    """Every stage also takes rows that the stages before would have dropped."""
    n = odd_docs.count()
    assert p.repeated_passages(spark, odd_docs, "").count() == n
    assert p.near_duplicates(spark, odd_docs, "").count() < n
    assert p.source_mix(spark, odd_docs, "").columns == odd_docs.columns
    assert p.pack(spark, odd_docs, "").count() >= n
    told = {r["doc_id"] for r in p.language_id(spark, odd_docs, "").collect()}
    assert told <= {r[0] for r in corpus(True) if any(c.isalpha() for c in r[1] or "")}


@pytest.mark.parametrize("out", ["de", "en", "es", "fr"])
def test_language_never_learned_goes(spark, out):
    """Posteriors saturate: texts of a language left out of training, other
    scripts, random letters and mojibake go by their fit; clean texts stay."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*COLUMNS)
    texts = ["Сегодня хорошая погода, и мы идём гулять по старому городу", "xqzv kjwq zzxk qpwv jjkx wvqz " * 4,
             "Ã©tÃ© dÃ©jÃ\xa0 Ã¼ber grÃ¶ÃŸe Ã±andÃº Ð¿Ñ€Ð¸Ð²ÐµÑ‚"]
    odd = spark.createDataFrame([(10**9 + i, t, None, "s", len(t)) for i, t in enumerate(texts)], docs.schema)
    masked = docs.withColumn("lang", F.when(F.col("lang") != out, F.col("lang"))).unionByName(odd)
    letters = {r["doc_id"]: r["lang"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}
    kept = {r["doc_id"] for r in p.language_id(spark, masked, "").collect()}
    never = [i for i, lang in letters.items() if lang == out]
    clean = [i for i, lang in letters.items() if lang != out]
    assert not kept & {10**9 + i for i in range(len(texts))}
    assert len(kept & set(never)) <= 0.03 * len(never)
    assert len(kept & set(clean)) >= 0.995 * len(clean)
