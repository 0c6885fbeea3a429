"""DuckDB SQL fragments of the views in :mod:`revlens.sources.tables`."""

from __future__ import annotations

from revlens.functions.fixed import STOP_WORDS_ENGLISH

# Views shared by the recommendation oracles (string ids -> dense ids).
BASE = """
WITH reviews AS (
  SELECT 'U' || CAST(o.o_custkey AS VARCHAR) AS user_id,
         'B' || CAST(l.l_partkey AS VARCHAR) AS business_id,
         CAST(ceil(l.l_quantity / 10) AS DOUBLE) AS stars
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
catalog_raw AS (
  SELECT 'B' || CAST(p_partkey AS VARCHAR) AS business_id, p_name AS name,
         p_brand AS address, CAST(p_size AS VARCHAR) AS postal_code, p_type AS city
  FROM part),
item_ids AS (
  SELECT business_id,
         CAST(row_number() OVER (ORDER BY business_id) - 1 AS INTEGER) AS business_id_numeric
  FROM (SELECT DISTINCT business_id FROM catalog_raw WHERE business_id IS NOT NULL)),
user_ids AS (
  SELECT user_id, n_rows,
         CAST(row_number() OVER (ORDER BY user_id) - 1 AS INTEGER) AS user_id_numeric
  FROM (SELECT user_id, count(*) AS n_rows FROM reviews
        WHERE user_id IS NOT NULL GROUP BY user_id)),
catalog AS (
  SELECT i.business_id_numeric, c.name, c.address, c.postal_code, c.city
  FROM catalog_raw c JOIN item_ids i ON c.business_id = i.business_id),
ratings AS (
  SELECT u.user_id_numeric, i.business_id_numeric, r.stars AS rating
  FROM reviews r JOIN user_ids u ON r.user_id = u.user_id
                 JOIN item_ids i ON r.business_id = i.business_id)
"""


def bucket(*cols: str, seed: int = 42) -> str:
    """SQL twin of ``revlens.operators.sampling.hash_bucket``."""
    parts = ", ".join([f"'{seed}'"] + [f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols])
    return f"CAST(('0x' || substr(md5(concat_ws('|', {parts})), 1, 8))::UBIGINT % 10000 AS BIGINT)"


# Labelled text: documents joined with labels.
TEXT = """
WITH texts AS (
  SELECT d.doc_id, d.text,
         CASE WHEN l.quality = 1 THEN 5.0 ELSE 1.0 END AS stars
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
toks AS (
  SELECT doc_id,
         regexp_extract_all(regexp_replace(lower(text), '''\\w', ' ', 'g'), '\\w+') AS w
  FROM texts)
"""


# The text of every document.
DOCS = """
WITH texts AS (SELECT doc_id, text FROM documents),
toks AS (
  SELECT doc_id,
         regexp_extract_all(regexp_replace(lower(text), '''\\w', ' ', 'g'), '\\w+') AS w
  FROM texts)
"""


def bigram_list(words: str = "w") -> str:
    return f"[{words}[i] || ' ' || {words}[i + 1] for i in range(1, len({words}))]"


def stop_list() -> str:
    quoted = ", ".join("'" + s.replace("'", "''") + "'" for s in STOP_WORDS_ENGLISH)
    return f"[{quoted}]"


def filtered_list(words: str = "w") -> str:
    return f"[x for x in {words} if NOT list_contains({stop_list()}, x)]"
