"""Explicit schemas for every scan (no inference pass over the input)."""

from pyspark.sql import types as T

# Business file: the columns the jobs use.
BUSINESS_SCHEMA = T.StructType([
    T.StructField("business_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("postal_code", T.StringType()),
    T.StructField("city", T.StringType()),
])

# Review file, recommendation view.
REVIEW_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("stars", T.DoubleType()),
])

# Review file, text view.
REVIEW_TEXT_SCHEMA = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("stars", T.DoubleType()),
])
