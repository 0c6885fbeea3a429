import os
import tempfile

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

from revlens.plans.subset import write_subset
from revlens.sources import tables
from revlens.sources.jsonio import local_rows, read_json, write_json

PEOPLE = T.StructType([T.StructField("name", T.StringType(), False),
                       T.StructField("age", T.LongType(), False)])


def test_local_rows_and_t14_sink_modes(spark):
    df = local_rows(spark, [Row("Ines", 31), Row("Okoro", 19), Row("Mei", 44)],
                    PEOPLE)
    path = os.path.join(tempfile.mkdtemp(prefix="revlens-io-"), "people")
    write_json(df, path, mode=None, single_file=True)
    back = read_json(spark, path, PEOPLE)
    assert sorted((r["name"], r["age"]) for r in back.collect()) == sorted(
        (r["name"], r["age"]) for r in df.collect())
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 1
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        write_json(df, path, mode=None)
    write_json(df.limit(1), path, mode="overwrite")
    assert read_json(spark, path, PEOPLE).count() == 1
    with pytest.raises(ValueError):
        write_json(df, path, mode="sometimes")


def test_debug_subset_is_consistent(spark, sf001):
    out = tempfile.mkdtemp(prefix="revlens-subset-")
    ratings, business = write_subset(
        tables.reviews(spark, sf001, with_order=True), tables.catalog(spark, sf001),
        f"{out}/r", f"{out}/b", 100, tables.REVIEW_ORDER)
    assert ratings.count() == 100
    rated = {r["business_id"] for r in ratings.collect()}
    assert {r["business_id"] for r in business.collect()} == rated
