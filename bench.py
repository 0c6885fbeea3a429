"""Benchmark the headline jobs; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default all). Every query runs to completion
through the ``noop`` sink (no driver collection), timed wall-clock.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def _session(cpus: str):
    from pyspark.sql import SparkSession
    b = (SparkSession.builder.master(f"local[{cpus}]").appName("revlens-bench")
         .config("spark.sql.shuffle.partitions", str(max(8, int(cpus) * 2)))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="revlens-bench-ckpt-"))
    return spark


def _run(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = _session(cpus)

    from pyspark.sql import functions as F

    from revlens.functions.text import glue_list, join_words, tokenize
    from revlens.operators.metrics import auroc
    from revlens.plans.keyphrase import key_ngrams
    from revlens.plans.recommend import als_estimator, fit, prepare, recommend
    from revlens.plans.sentiment import label_reviews, sentiment
    from revlens.plans.subset import subset_ratings_joined, write_sample
    from revlens.plans.tune import als_grid_search
    from revlens.queries import text as tq
    from revlens.session import scratch_path
    from revlens.sources import tables

    parts = {}  # parts of a job's time, not added to the total

    def q_prepare():
        prep = prepare(tables.catalog(spark, sf_dir), tables.reviews(spark, sf_dir),
                       materialize=False)
        _run(prep.ratings)

    def q_als_fit():
        prep = prepare(tables.catalog(spark, sf_dir), tables.reviews(spark, sf_dir),
                       materialize=True)
        began = time.time()
        fit(als_estimator(rank=10, max_iter=10, reg_param=0.1), prep.ratings)
        parts["als_fit_alone"] = round(time.time() - began, 3)

    def q_recommend():
        prep = prepare(tables.catalog(spark, sf_dir), tables.reviews(spark, sf_dir),
                       materialize=True)
        _run(recommend(prep, "red plate", n=10, rank=10, max_iter=10, reg_param=0.1).report)

    def q_recommend_full():
        # the original job's settings: rank 30, 50 iterations, regParam 0.3
        prep = prepare(tables.catalog(spark, sf_dir), tables.reviews(spark, sf_dir))
        _run(recommend(prep, "red plate", n=10, rank=30, max_iter=50, reg_param=0.3).report)

    def q_grid():
        prep = prepare(tables.catalog(spark, sf_dir), tables.reviews(spark, sf_dir),
                       materialize=True)
        als_grid_search(prep.ratings, [5, 10], [0.1, 1.0], 5)

    def q_tfidf():
        _run(tq.tfidf_bigram(spark, sf_dir))

    def q_glue100():
        docs = tables.table(spark, sf_dir, "documents").select("doc_id", "text")
        words = docs.select("doc_id", tokenize("text").alias("w"))
        top = tq.term_stats(tq._bigram_docs(spark, sf_dir), "doc_id", "grams") \
            .orderBy(F.col("tf").desc(), F.col("term")).limit(100)
        keys = [r["term"] for r in top.collect()]
        _run(words.select("doc_id", glue_list(join_words("w"), keys).alias("g")))

    def q_key_ngrams():
        kn = key_ngrams(label_reviews(tables.labelled_text(spark, sf_dir)), max_iter=20)
        _run(kn.docs.select("doc_id", "ngram_text"))
        kn.release()

    def q_sentiment():
        res = sentiment(tables.labelled_text(spark, sf_dir), key_max_iter=20, max_iter=20)
        _run(res.scored)
        res.release()

    def q_auroc():
        docs = tables.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
        labels = tables.table(spark, sf_dir, "labels").select("doc_id", "quality")
        _run(auroc(docs.join(labels, "doc_id"), "n_chars", "quality"))

    def q_subset():
        out = scratch_path(spark, "bench-subset")
        items, orders = tables.review_parts(spark, sf_dir)
        sample = subset_ratings_joined(items, orders, "l_orderkey", 10_000, tables.REVIEW_ORDER, tables.as_reviews)
        write_sample(sample, tables.catalog(spark, sf_dir), f"{out}/ratings", f"{out}/businesses")

    suite = {
        "prepare_ids": q_prepare,
        "als_fit_r10_i10": q_als_fit,
        "recommend_report": q_recommend,
        "recommend_rank30_iter50": q_recommend_full,
        "als_grid_2x2": q_grid,
        "tfidf_bigram": q_tfidf,
        "glue_100_keys_all_docs": q_glue100,
        "key_ngrams": q_key_ngrams,
        "sentiment_auroc": q_sentiment,
        "auroc_ranksum": q_auroc,
        "debug_subset_10k": q_subset,
    }
    # The test tables are single files of one row group, one scan task each. A
    # cluster reads many splits, so the jobs run on a copy in two files a core,
    # written outside the timings (which also warms the JVM).
    given, sf_dir = sf_dir, scratch_path(spark, "bench-input")
    for t in ("lineitem", "orders", "part", "documents", "labels"):
        tables.table(spark, given, t).repartition(2 * int(cpus)).write.parquet(f"{sf_dir}/{t}.parquet")
    times = {}
    for name, fn in suite.items():
        if only and name not in only:
            continue
        t0 = time.time()
        fn()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", given)
    print(json.dumps({
        "metric": "total_wall_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "parts": parts,
        "sf": float(m.group(1)) if m else given,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
