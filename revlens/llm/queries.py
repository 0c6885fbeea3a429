"""The registered queries of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import (conversation_trie, embed_dedup, fingerprint, langid, license_scan, mixing, ngram_join,
                         packing, periodic_runs, secret_scan, sharding, substring_dedup, suffix_dedup)
from revlens.llm.common import load

SHARDS = [f"shard-{i:03d}" for i in range(100)]


def tokenizer_path() -> str:
    """The contract's vocabulary file; operators take any path."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_shard_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(load(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(load(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    langs, matrix = langid.fit_open_fold(docs)
    rows = docs.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "text")
    return langid.predict(rows, langs, matrix).select("doc_id", "held_out", "lang_pred", "score")


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(load(spark, sf_dir, "documents"), tokenizer_path())


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(load(spark, sf_dir, "documents"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.dedup(load(spark, sf_dir, "embeddings"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_classes(load(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "class_id", "n_links")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(load(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(load(spark, sf_dir, "documents"))


def op10_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(mixing.sized_documents(load(spark, sf_dir, "documents")))
    return mixing.training_places(plan).select("doc_id", "size", "source_size", "target", "taken", "copies", "position",
                                               "positions", "places")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(load(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(load(spark, sf_dir, "documents"), stretch=True)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie_of(load(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_shard_table, op2_license_scan, op3_language_id, op4_pack, op5_fingerprint,
                                   op6_embedding_dedup, op7_ngram_join, op8_suffix_dedup, op9_substring_dedup,
                                   op10_curriculum_mix, op11_secret_scan, op12_periodic_runs,
                                   op13_conversation_trie)}
ORACLES: dict[str, str] = {}

# -- oracles: what SQL can say ------------------------------------------------------

ORACLES["op9_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS g FROM s),
f AS (SELECT g, min(doc_id) AS m FROM g GROUP BY g),
h AS (SELECT doc_id, i FROM g JOIN f USING (g) WHERE doc_id > m),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM h, range(50) t(k)),
x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
k AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) AS kept FROM x
      WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = x.doc_id AND gone.i = x.i) GROUP BY x.doc_id),
c AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id
"""

ORACLES["op10_curriculum_mix"] = r"""
WITH d AS (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r
      FROM d GROUP BY source),
w AS (SELECT *, CAST(1 + r % 3 AS DOUBLE) AS w FROM s),
o AS (SELECT *, coalesce(sum(3 * n) OVER b, 0) AS full_before, sum(w) OVER a AS open_w FROM w
      WINDOW b AS (ORDER BY 3 * n / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
             a AS (ORDER BY 3 * n / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
lv AS (SELECT *, CAST((SELECT sum(n) FROM s) - full_before AS DOUBLE) / open_w AS level FROM o),
l AS (SELECT level FROM lv WHERE level * w <= 3 * n ORDER BY 3 * n / w, r LIMIT 1),
t AS (SELECT w.*, CASE WHEN (SELECT level FROM l) * w > 3 * n THEN CAST(3 * n AS DOUBLE)
                       ELSE (SELECT level FROM l) * w END AS target,
             [1.5, 1.0, 0.5][1 + r % 3]::DOUBLE AS a, [0.5, 1.0, 1.5][1 + r % 3]::DOUBLE AS b FROM w),
p AS (SELECT d.doc_id, d.size, t.n, t.target, t.a, t.b, CAST(floor(t.target) AS BIGINT) AS whole,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id NULLS LAST, d.size
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, [greatest(0, least(size, whole - (before + e * n))) FOR e IN [0, 1, 2]] AS parts FROM p),
v AS (SELECT *, [CASE WHEN parts[e + 1] > 0 THEN least(greatest(CASE WHEN a = b THEN (before + e * n) / target ELSE
                   (sqrt(greatest(a * a + 2 * (b - a) * ((before + e * n) / target * (a + b) / 2), 0.0)) - a) / (b - a) END,
                   0.0), 1.0) + 0.0 END FOR e IN [0, 1, 2]] AS spots, row_number() OVER () AS r FROM q),
u AS (SELECT r, doc_id, size, e, spots[e + 1] AS spot FROM v, range(3) t(e) WHERE parts[e + 1] > 0),
ord AS (SELECT r, e, spot, row_number() OVER (ORDER BY spot, doc_id NULLS LAST, e, size) - 1 AS place FROM u),
lists AS (SELECT r, list(spot ORDER BY e) AS positions, list(place ORDER BY e) AS places FROM ord GROUP BY r)
SELECT doc_id, CAST(size AS BIGINT) AS size, n AS source_size, target, CAST(list_sum(parts) AS BIGINT) AS taken,
       CAST(len([x FOR x IN parts IF x > 0]) AS BIGINT) AS copies, spots[1] AS position,
       coalesce(positions, []::DOUBLE[]) AS positions, coalesce(places, []::BIGINT[]) AS places
FROM v LEFT JOIN lists USING (r)
"""

# The table is filled here; the SQL hashes and looks up.
ORACLES["op1_shard_table"] = (
    "WITH s AS (SELECT doc_id, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::UBIGINT "
    f"% {sharding.TABLE_SIZE} AS BIGINT) AS slot FROM documents), "
    f"t AS (SELECT {sharding.fill_table(SHARDS).tolist()} AS owner) "
    "SELECT doc_id, slot, 'shard-' || lpad(CAST(owner[slot + 1] AS VARCHAR), 3, '0') AS shard FROM s, t")

# CRC-32 bit by bit: a byte is xored in, then eight steps (-1) follow.
ORACLES["op13_conversation_trie"] = r"""
WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
           WHERE conv_id IS NOT NULL),
m AS (SELECT c, turn, sha256(length(r) || ':' || r || x) AS name, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words FROM t),
o AS (SELECT c, list(name ORDER BY turn NULLS FIRST, name) AS names, list(words ORDER BY turn NULLS FIRST, name) AS words
      FROM m GROUP BY c),
h AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
                  lambda s: [ascii(s)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 4 AS h
      FROM o),
b AS (SELECT h.c, list_concat(coalesce(f.names[1:h], []), h.names[h + 1:]) AS names,
             list_concat(coalesce(f.words[1:h], []), h.words[h + 1:]) AS words
      FROM h LEFT JOIN o AS f ON f.c = h.c - h.c % 20),
p AS (SELECT c, len(names) AS n, names, words, unnest(range(len(names) + 1)) AS d FROM b),
k AS (SELECT c, d, n = d AS last, sha256(array_to_string(names[1:d], ',')) AS node,
             CASE WHEN d > 0 THEN sha256(array_to_string(names[1:d - 1], ',')) END AS up,
             CASE WHEN d > 0 THEN words[d] ELSE 0 END AS w FROM p),
g AS (SELECT node, d, min(c) AS conv_id, count(*) AS n_convs, min(up) AS up, min(w) AS w,
             sha256(coalesce(string_agg(CASE WHEN last THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')) AS ends
      FROM k GROUP BY node, d),
q AS (SELECT up AS node, d - 1 AS d, count(*) AS n FROM g WHERE d > 0 GROUP BY up, d),
v AS (SELECT g.*, coalesce(q.n, 0) AS kids FROM g LEFT JOIN q ON q.node = g.node AND q.d = g.d),
s AS (SELECT k.node, k.d, sum(CASE WHEN v.kids = 0 THEN 1 ELSE 0 END) AS leaves, sum((v.n_convs - 1) * v.w) AS saved
      FROM v JOIN k ON k.c = v.conv_id AND k.d <= v.d GROUP BY k.node, k.d)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, v.n_convs, CAST(v.kids AS BIGINT) AS n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, v.ends AS ends_sha256
FROM v JOIN s ON s.node = v.node AND s.d = v.d LEFT JOIN g AS u ON u.node = v.up AND u.d = v.d - 1
"""
