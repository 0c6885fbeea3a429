"""Registered queries: one Spark function and, where SQL can say it, one
DuckDB oracle per operator of the survey's inventory.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole test tables. Model queries return invariant flags (INV), whose oracle
gives the expected rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from revlens.queries import models, relational, text

QueryFn = Callable[[SparkSession, str], DataFrame]


def registry() -> dict[str, tuple[QueryFn, str | None]]:
    out: dict[str, tuple[QueryFn, str | None]] = {}
    for mod in (relational, text, models):
        for key, entry in mod.QUERIES.items():
            if key in out:
                raise ValueError(f"duplicate query key {key}")
            out[key] = entry
    return out
