"""JSON-lines scan and sink, and local rows with an explicit schema."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MODES = {"overwrite", "errorifexists", "error", "append", "ignore"}


def read_json(spark: SparkSession, path: str | Sequence[str],
              schema: T.StructType) -> DataFrame:
    """Scan JSON lines from a file or a folder of part files.

    The schema is always given, so Spark runs no inference job and the
    column order and types are the declared ones.
    """
    return spark.read.schema(schema).json(path)


BAD_LINE = "_corrupt_record"


def infer_json(spark: SparkSession, path: str | Sequence[str]) -> T.StructType:
    """Schema of a JSON-lines input from a pass over all of it.

    Every line is looked at, not a sample, so a field that a single line holds
    is there, and a number is double if it ever is. Lines that don't parse
    decide nothing. Columns are in alphabetical order, as Spark infers them.
    """
    found = spark.read.option("samplingRatio", 1.0).option("columnNameOfCorruptRecord", BAD_LINE).json(path).schema
    return T.StructType([f for f in found.fields if f.name != BAD_LINE])


@dataclass
class JsonInput:
    rows: DataFrame    # the lines that fit the schema
    bad: DataFrame     # line: those that don't, as they stand


def scan_json(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
              strict: bool = False) -> JsonInput:
    """Scan JSON lines; what doesn't parse or fit the types is set aside.

    Without a schema it is inferred (:func:`infer_json`). ``strict`` raises on
    the first bad line, when a result is asked for, instead of setting it aside.
    A field the schema doesn't name is ignored; one a line lacks is null.
    """
    schema = infer_json(spark, path) if schema is None else schema
    if BAD_LINE in schema.names:
        raise ValueError(f"the schema must not name {BAD_LINE}")
    if strict:
        rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
        return JsonInput(rows, spark.createDataFrame([], "line string"))
    marked = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE})
                          .alias("_rl_row"))
    is_bad = F.col("_rl_row").isNull() | F.col("_rl_row").getField(BAD_LINE).isNotNull()
    rows = parsed.where(~is_bad).select(*[F.col("_rl_row").getField(c).alias(c) for c in schema.names])
    return JsonInput(rows, parsed.where(is_bad).select(F.col("value").alias("line")))


def write_json(df: DataFrame, path: str, mode: str | None = "errorifexists",
               single_file: bool = False) -> None:
    """Write JSON lines. ``mode=None`` fails if the path exists.

    ``single_file`` reduces the output to one part file with ``coalesce(1)``;
    only meant for small results, as it funnels the write through one task.
    """
    mode = "errorifexists" if mode is None else mode
    if mode not in _MODES:
        raise ValueError(f"unknown save mode {mode!r}")
    if single_file:
        df = df.coalesce(1)
    df.write.mode(mode).json(path)


def local_rows(spark: SparkSession, rows: Iterable[Sequence],
               schema: T.StructType) -> DataFrame:
    """Small driver-side rows with a fixed schema (fixtures, parameters)."""
    return spark.createDataFrame(list(rows), schema)
