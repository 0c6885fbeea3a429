import math


from pyspark.ml.feature import IDF, NGram, RegexTokenizer, StopWordsRemover, CountVectorizer
from pyspark.sql import functions as F

from revlens.functions.fixed import STOP_WORDS_ENGLISH, TOKEN_PATTERN
from revlens.functions.text import (glue_list, join_fields, join_words, ngrams,
                                    remove_stopwords, tokenize)
from revlens.operators.vocab import term_frequency, term_stats, tfidf, vocabulary

T1 = "They're i don't a_b it's x'y'z ''q éa naïve"


def test_t1_tokenizer_apostrophe_quirk(spark):
    df = spark.createDataFrame([(T1,)], "text string")
    got = df.select(tokenize("text").alias("w")).first()["w"]
    assert got == ["they", "e", "i", "don", "a_b", "it", "x", "a", "na", "ve"]


def test_tokenizer_equals_regex_tokenizer(spark):
    rows = [(T1,), ("Hello, World! it's 42_x",), ("",), ("ÄÖÜ straße o'neil",)]
    df = spark.createDataFrame(rows, "text string")
    ml = RegexTokenizer(inputCol="text", outputCol="ml", pattern=TOKEN_PATTERN, gaps=False)
    out = ml.transform(df).select("ml", tokenize("text").alias("ours")).collect()
    for r in out:
        assert r["ml"] == r["ours"]


def test_t2_bigrams_and_ngram_transformer(spark):
    df = spark.createDataFrame([(["a", "b", "a"],), (["b", "c"],), (["b"],), ([],)],
                               "w array<string>")
    got = [r["g"] for r in df.select(ngrams("w", 2).alias("g")).collect()]
    assert got == [["a b", "b a"], ["b c"], [], []]
    for n in (1, 2, 3):
        ml = NGram(n=n, inputCol="w", outputCol="ml").transform(df)
        for r in ml.select("ml", ngrams("w", n).alias("ours")).collect():
            assert r["ml"] == r["ours"]


def test_t3_idf_matches_formula_and_spark_idf(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, ["b"])],
                                 "doc_id long, w array<string>")
    vocab = vocabulary(term_stats(docs, "doc_id", "w"))
    rows = {(r["doc_id"], r["term"]): r["tfidf"] for r in
            tfidf(term_frequency(docs, "doc_id", "w"), "doc_id", docs.count(), vocab).collect()}
    assert math.isclose(rows[(1, "a")], 2 * math.log(4 / 2))
    assert rows[(1, "b")] == 0.0 and rows[(3, "b")] == 0.0
    assert math.isclose(rows[(2, "c")], math.log(2))
    cv = CountVectorizer(inputCol="w", outputCol="tf").fit(docs)
    idf = IDF(inputCol="tf", outputCol="x").fit(cv.transform(docs))
    spark_idf = dict(zip(cv.vocabulary, idf.idf.toArray()))
    assert math.isclose(spark_idf["a"], math.log(4 / 2))
    assert spark_idf["b"] == 0.0


def test_vocabulary_order_and_cap(spark):
    docs = spark.createDataFrame([(1, ["b", "a", "c"]), (2, ["a", "c"]), (3, ["d"])],
                                 "doc_id long, w array<string>")
    v = vocabulary(term_stats(docs, "doc_id", "w"), cap=3).orderBy("term_index").collect()
    assert [r["term"] for r in v] == ["a", "c", "b"]
    assert [r["term_index"] for r in v] == [0, 1, 2]


def test_t4_gluing_substring_semantics(spark):
    df = spark.createDataFrame([("tea a team eat it a a a",)], "t string")
    got = df.select(glue_list("t", ["a team", "at it", "a a"]).alias("g")).first()["g"]
    assert got == "tea_a_team eat_it a_a a"
    # a key listed twice applies twice: "a a a" -> "a_a a" -> "a_a_a"
    one = spark.createDataFrame([("a a a",)], "t string")
    assert one.select(glue_list("t", ["a a"]).alias("g")).first()["g"] == "a_a a"
    assert one.select(glue_list("t", ["a a", "a a"]).alias("g")).first()["g"] == "a_a_a"


def test_glue_matches_python_str_replace_semantics(spark):
    texts = ["not good at all not good", "very good very good food", "good"]
    keys = ["not good", "very good", "good food"]

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["g"] for r in df.select(glue_list("t", keys).alias("g")).collect()]
    assert got == ["not_good at all not_good", "very_good very_good_food", "good"]


def test_stopwords_list_and_transformer(spark):
    assert list(STOP_WORDS_ENGLISH) == StopWordsRemover.loadDefaultStopWords("english")
    df = spark.createDataFrame([(["I", "don", "t", "e", "good", "The", "s"],)], "w array<string>")
    ml = StopWordsRemover(inputCol="w", outputCol="ml").transform(df)
    r = ml.select("ml", remove_stopwords("w").alias("ours")).first()
    assert r["ml"] == r["ours"] == ["e", "good"]


def test_join_fields_writes_none(spark):
    df = spark.createDataFrame([("Cafe", None, "123", "X")], "a string, b string, c string, d string")
    got = df.select(join_fields("a", "b", "c", "d").alias("s")).first()["s"]
    assert got == "Cafe, None, 123, X"
    assert df.select(join_words(F.array(F.lit("a"), F.lit("b"))).alias("s")).first()["s"] == "a b"
