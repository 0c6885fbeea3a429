"""Property tests: our column expressions equal Spark ML's transformers on
arbitrary text, and positions/splits do not depend on partitioning."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import NGram, RegexTokenizer, StopWordsRemover

from revlens.functions.fixed import TOKEN_PATTERN
from revlens.functions.text import ngrams, remove_stopwords, tokenize
from revlens.operators.indexing import row_index

ALPHABET = "ab 'éI_.\nTHE don't"
texts = st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=8)
SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(texts)
def test_tokenize_ngrams_stopwords_equal_transformers(spark, rows):
    df = spark.createDataFrame([(t,) for t in rows], "text string")
    ml = RegexTokenizer(inputCol="text", outputCol="w", pattern=TOKEN_PATTERN, gaps=False).transform(df)
    ml = NGram(n=2, inputCol="w", outputCol="g2").transform(ml)
    ml = NGram(n=3, inputCol="w", outputCol="g3").transform(ml)
    ml = StopWordsRemover(inputCol="w", outputCol="sw").transform(ml)
    out = ml.select("w", "g2", "g3", "sw", tokenize("text").alias("t"),
                    ngrams("w", 2).alias("o2"), ngrams("w", 3).alias("o3"),
                    remove_stopwords("w").alias("osw")).collect()
    for r in out:
        assert r["w"] == r["t"]
        assert r["g2"] == r["o2"] and r["g3"] == r["o3"]
        assert r["sw"] == r["osw"]


@SETTINGS
@given(st.lists(st.integers(-50, 50), min_size=0, max_size=60), st.integers(1, 7))
def test_row_index_is_a_permutation_in_order(spark, values, parts):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, k int")
    got = sorted((r["idx"], r["v"], r["k"]) for r in
                 row_index(df.repartition(parts), ["v", "k"], "idx").collect())
    assert [g[0] for g in got] == list(range(len(values)))
    assert [(g[1], g[2]) for g in got] == sorted((v, i) for i, v in enumerate(values))
