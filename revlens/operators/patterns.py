"""Many LIKE patterns against many names, without a nested loop.

A gram index finds the candidates: a pattern's literal stretches are cut into
runs of three characters (two or one where none is longer), the rarest of
which, by the number of names that hold it, is its key; names are joined on
the keys they hold, and LIKE verifies what meets. Patterns without a literal
character are told apart by the length they ask for alone; they match (nearly)
every name, so their pairs are the result itself.

Lower-casing may change a text's length (``İ`` becomes two characters), so
every cut is made on lowered texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3
_SEGMENT = r"(?s)(?:[^%_\\]|\\.)+"


def segments(pattern: Column) -> Column:
    """Literal stretches of a LIKE pattern, escapes resolved."""
    return F.transform(F.regexp_extract_all(pattern, F.lit(_SEGMENT), F.lit(0)),
                       lambda s: F.regexp_replace(s, r"(?s)\\(.)", "$1"))


def grams(text: Column, size: Column | int) -> Column:
    """All runs of ``size`` characters of a text, each once."""
    n = F.lit(size) if isinstance(size, int) else size
    last = F.length(text) - n + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, n)))


def _own_grams(pattern: Column) -> Column:
    """The pattern's grams of the largest size up to GRAM that any of its
    stretches has; none without a literal character."""
    parts = segments(pattern)
    longest = F.least(F.coalesce(F.array_max(F.transform(parts, F.length)), F.lit(0)), F.lit(GRAM))
    return F.array_distinct(F.flatten(F.transform(parts, lambda s: grams(s, F.greatest(longest, F.lit(1))))))


def like_join(patterns: DataFrame, names: DataFrame, pattern_col: str, name_col: str) -> DataFrame:
    """Pairs with ``lower(name) LIKE lower(pattern)``: the patterns' columns,
    then the names'. Columns of the two sides must differ."""
    pattern, name = F.lower(F.col(pattern_col)), F.lower(F.col(name_col))
    distinct = patterns.select(pattern.alias("_rl_pattern")).where("_rl_pattern IS NOT NULL").distinct()
    asked = distinct.withColumn("_rl_grams", _own_grams(F.col("_rl_pattern")))
    keyed = asked.select("_rl_pattern", F.explode("_rl_grams").alias("_rl_key"))

    # how many names hold each of the patterns' grams
    texts = names.select(name.alias("_rl_name")).where("_rl_name IS NOT NULL")
    held = F.flatten(F.array(*[grams(F.col("_rl_name"), k) for k in range(1, GRAM + 1)]))
    wanted = keyed.select("_rl_key").distinct()
    common = (texts.select(F.explode(held).alias("_rl_key")).join(wanted, "_rl_key", "left_semi")
              .groupBy("_rl_key").agg(F.count(F.lit(1)).alias("_rl_n")))
    rarest = (keyed.join(common, "_rl_key", "left")
              .groupBy("_rl_pattern").agg(F.min(F.struct(F.coalesce("_rl_n", F.lit(0)).alias("n"), "_rl_key")).alias("m"))
              .select("_rl_pattern", F.col("m.n").alias("_rl_n"), F.col("m._rl_key").alias("_rl_key"))
              .where("_rl_n > 0").select("_rl_pattern", "_rl_key"))
    keys = rarest.select("_rl_key").distinct()

    wide = names.withColumn("_rl_name", name)
    by_gram = (wide.where("_rl_name IS NOT NULL").withColumn("_rl_key", F.explode(held))
               .join(keys, "_rl_key", "left_semi"))
    own = patterns.withColumn("_rl_pattern", pattern)
    columns = [*patterns.columns, *names.columns]
    found = (own.join(rarest, "_rl_pattern").join(by_gram, "_rl_key")
             .where(F.like(F.col("_rl_name"), F.col("_rl_pattern"))).select(*columns))

    # patterns of wildcards alone: '%' asks for a least length, only '_' for the length
    bare = own.where(F.col("_rl_pattern").rlike(r"^[%_]*$"))
    size = F.length(F.regexp_replace("_rl_pattern", "%", ""))
    bare = bare.withColumn("_rl_size", size).withColumn("_rl_open", F.col("_rl_pattern").contains("%"))
    if bare.isEmpty():
        return found
    # lengths that names have, and which of them each pattern takes
    lengths = wide.where("_rl_name IS NOT NULL").select(F.length("_rl_name").alias("_rl_length")).distinct()
    longest = lengths.agg(F.max("_rl_length")).first()[0]
    if longest is None:
        return found
    takes = F.when(F.col("_rl_size") > F.lit(longest), F.array().cast("array<int>")) \
        .when(F.col("_rl_open"), F.sequence(F.col("_rl_size"), F.greatest(F.lit(longest), F.col("_rl_size")))) \
        .otherwise(F.array("_rl_size"))
    by_length = (bare.withColumn("_rl_length", F.explode(takes))
                 .join(wide.withColumn("_rl_length", F.length("_rl_name")), "_rl_length").select(*columns))
    return found.unionByName(by_length)
