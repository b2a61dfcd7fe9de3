"""Registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyboard.llm import (aggregation, bytepairs, chat, language, mixing, neighbours, pieces, pseudonyms, repair, sharding, simhash,
                            trie, warc)
from tallyboard.llm.common import table, word_count
from tallyboard.session import scratch_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


@_query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    return simhash.classes(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


@_query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.digests(pieces.encode(table(spark, sf_dir, "documents"), model))


@_query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs))


# For the registered query alone; whoever pseudonymises real data keeps a key of their own.
PSEUDONYM_KEY = "registered query"


@_query
def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms for personal data, and whether that changed it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    new = pseudonyms.pseudonymise_column(F.col("text"), PSEUDONYM_KEY)
    return docs.select("doc_id", new.alias("text"), F.col("text").alias("old")).select(
        "doc_id", "text", (~F.col("text").eqNullSafe(F.col("old"))).alias("changed"))


@_query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, counted in the shards it writes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    plan = mixing.make_plan(mixing.weigh(docs))
    mixture = scratch_table(mixing.mix(docs, plan, "shard"), "mixture")
    found = mixing.counted(docs.withColumn("size", word_count(F.col("text"))), plan, mixture, "mixed")
    return found.select("doc_id", "size", F.col("mixed.source_size").alias("source_size"), F.col("mixed.target").alias("target"),
                        (F.col("size") * F.col("mixed.copies")).alias("taken"))


@_query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; row counts of shards differ by one at most."""
    rows = sharding.assign(table(spark, sf_dir, "documents"), 40)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


ORACLE["op8_sharding"] = """
WITH steps AS (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
        CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) t(i)),
crc AS (SELECT list(v ORDER BY i) AS t FROM steps),
texts AS (
    SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) AS bytes, hex(encode(coalesce(text, ''))) AS h,
           ('0x' || substr(md5(concat_ws(':', '1', doc_id, text)), 1, 15))::BIGINT AS key
    FROM documents),
rows AS (
    SELECT doc_id, source, key, bytes + 16 AS size,
           xor(list_reduce(list_prepend(4294967295::BIGINT,
                   list_transform(range(bytes), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
    FROM texts, crc),
ranked AS (
    SELECT *, (row_number() OVER (PARTITION BY source ORDER BY key, doc_id, text_crc32, size) - 0.5)::DOUBLE
              / count(*) OVER (PARTITION BY source) AS share
    FROM rows),
placed AS (
    SELECT *, row_number() OVER (ORDER BY share, key, doc_id, text_crc32, size, source) - 1 AS place,
           count(*) OVER () AS n
    FROM ranked)
SELECT doc_id, size, text_crc32, 'rows' AS law, (place * 40 // n)::INT AS shard,
       place - ((place * 40 // n) * n + 39) // 40 AS slot, NULL::INT AS grown_shard
FROM placed
"""


@_query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back."""
    archives = warc.write_archives(table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    return warc.read_archives(archives, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op9_warc"] = """
WITH digests AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
typed AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS response FROM digests),
groups AS (SELECT *, list_transform(range(8), lambda k: ('0x' || substr(h, 5 * k + 1, 5))::INT) AS g FROM typed)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((g[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31) + 1, 1)), 'string_agg', '')
           AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM response THEN response END AS refers_to
FROM groups
"""


@_query
def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best integer inner products of every fiftieth vector."""
    return aggregation.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256)


ORACLE["op5_top_k"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@_query
def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest vectors found for every twentieth vector."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), k=20, every=20)


@_query
def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that speaks the template's own marks, formatted and read back."""
    said = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    ranks = bytepairs.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return chat.digests(chat.windows(turns, count=chat.BytePairCount(ranks, public_tokenizers.PATTERN)))


@_query
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every conversation after damage: counts of faults, cost, audit, and a digest of the repaired turns."""
    turns = table(spark, sf_dir, "conversations")
    return repair.digests(repair.repair(repair.damaged(turns)), turns)


# CRC-32 of an ASCII text, with the table ``t`` of CTE ``crc`` at hand.
_CRC = """
steps AS (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
        CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) t(i)),
crc AS (SELECT list(v ORDER BY i) AS t FROM steps)"""


def _crc32(text: str) -> str:
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length({text})), lambda i: "
            f"ascii(substr({text}, i + 1, 1))::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")


def _add(head: str, cost: str, edit: str) -> str:
    return f"{{'c': {head}.c + {cost}, 'a': {head}.a || '{edit}'}}"


def _least(*heads: str) -> str:
    return f"list_min([{', '.join(heads)}])"


_NONE = 1 << 40  # cost of a state that cannot be reached
_DELETED = {f"d{s}": _add(f"h{s}", "4", "D") for s in range(4)}
# Keeping costs k of the role's initial; another role costs 3 more than keeping.
_TO_USER = [way for s in (0, 1, 3) for way in (_add(f"h{s}", "ku", "K"), _add(f"h{s}", "kr", "R"))]

ORACLE["op11_repair"] = f"""
WITH RECURSIVE {_CRC},
hurt AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS damage
    FROM conversations, crc),
left_over AS (
    SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
           CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM hurt, range(CASE WHEN damage = 3 THEN 2 ELSE 1 END) r(copy) WHERE damage <> 0),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM left_over),
faulty AS (
    SELECT *, left(role, 1) AS initial,
           CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM placed),
kinds AS (
    SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN {_NONE} WHEN fault = 'truncated' THEN 3 ELSE 0 END AS k FROM faulty),
costs AS (
    SELECT conv_id, i, k + CASE initial WHEN 's' THEN 0 ELSE {_NONE} END AS ks, k + CASE initial WHEN 'u' THEN 0 ELSE {_NONE} END AS ku,
           k + CASE initial WHEN 'a' THEN 0 ELSE {_NONE} END AS ka, k + 3 AS kr
    FROM kinds),
ids AS (SELECT DISTINCT conv_id FROM conversations),
step AS (
    SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': ''}} AS h0, {{'c': {_NONE}::BIGINT, 'a': ''}} AS h1,
           {{'c': 3::BIGINT, 'a': 'I'}} AS h2, {{'c': 6::BIGINT, 'a': 'II'}} AS h3
    FROM ids
    UNION ALL
    SELECT conv_id, i, d0, d1, {_least("u2", _add("u3", "3", "I"))}, u3
    FROM (SELECT conv_id, i, d0, d1, u2, {_least("d3", _add("u2", "3", "I"))} AS u3
          FROM (SELECT conv_id, i, d0, d1, d3, {_least("d2", _add("d0", "3", "I"), _add("d1", "3", "I"))} AS u2
                FROM (SELECT s.conv_id, r.i, {_DELETED["d0"]} AS d0, {_least(_DELETED["d1"], _add("h0", "ks", "K"))} AS d1,
                             {_least(_DELETED["d2"], *_TO_USER)} AS d2,
                             {_least(_DELETED["d3"], _add("h2", "ka", "K"), _add("h2", "kr", "R"))} AS d3
                      FROM step s JOIN costs r ON s.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = s.i + 1)))),
best AS (SELECT conv_id, i AS n, {_least("h0", "h3")} AS b FROM step QUALIFY i = max(i) OVER (PARTITION BY conv_id)),
edits AS (
    SELECT conv_id, j, substr(b.a, j, 1) AS edit, j - length(replace(left(b.a, j), 'I', '')) AS inserted
    FROM best, unnest(range(1, length(b.a) + 1)) u(j)),
kept AS (SELECT * FROM edits WHERE edit <> 'D'),
turns AS (
    SELECT e.conv_id, e.j, e.edit, k.role, coalesce(k.text, '') AS text,
           CASE WHEN first_value(k.initial = 's' AND e.edit = 'K') OVER w THEN row_number() OVER w - 2 ELSE row_number() OVER w - 1 END AS place
    FROM kept e LEFT JOIN kinds k ON e.conv_id IS NOT DISTINCT FROM k.conv_id AND e.edit <> 'I' AND k.i = e.j - e.inserted
    WINDOW w AS (PARTITION BY e.conv_id ORDER BY e.j)),
repaired AS (
    SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN place % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j) AS lines
    FROM turns GROUP BY conv_id),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faulty GROUP BY conv_id)
SELECT best.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, b.c AS cost, b.a AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM best LEFT JOIN counts ON best.conv_id IS NOT DISTINCT FROM counts.conv_id
LEFT JOIN repaired ON best.conv_id IS NOT DISTINCT FROM repaired.conv_id
"""


@_query
def op12_bytepairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level ids and decoded bytes of every document, as digests."""
    ranks = bytepairs.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bytepairs.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bytepairs.digests(bytepairs.decode(encoded, ranks))


@_query
def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all conversations, rebuilt on shared openings."""
    light = scratch_table(trie.turn_digests(table(spark, sf_dir, "conversations")), "turns")
    return trie.trie(scratch_table(trie.shared_openings(light), "rebuilt")).drop("node")


ORACLE["op13_trie"] = f"""
WITH {_CRC},
ordered AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
    FROM conversations WHERE conv_id IS NOT NULL),
counted AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base FROM ordered GROUP BY conv_id),
convs AS (SELECT conv_id, n, base, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM counted, crc),
grafted AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS taken FROM convs c LEFT JOIN convs b ON c.base = b.conv_id),
rebuilt AS (
    SELECT g.conv_id, o.p, o.role, o.text FROM grafted g JOIN ordered o ON o.conv_id = g.base AND o.p <= g.h
    UNION ALL
    SELECT g.conv_id, o.p - g.h + g.taken, o.role, o.text FROM grafted g JOIN ordered o ON o.conv_id = g.conv_id AND o.p > g.h),
paths AS (
    SELECT conv_id, p AS depth, octet_length(encode(text)) AS bytes,
           string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY p) AS path
    FROM rebuilt
    UNION ALL SELECT conv_id, 0, 0, '' FROM grafted),
nodes AS (SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM paths GROUP BY path),
children AS (SELECT left(path, length(path) - 32) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
grown AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.path = c.path),
sums AS (
    SELECT left(path, 32 * k) AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens
    FROM grown, unnest(range(0, depth + 1)) u(k) GROUP BY 1),
lasts AS (SELECT conv_id, arg_max(path, depth) AS path FROM paths GROUP BY conv_id),
ends AS (SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM lasts GROUP BY path)
SELECT g.conv_id, g.depth, p.conv_id AS parent_conv_id, g.n_convs, g.n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM grown g JOIN sums s ON g.path = s.path LEFT JOIN ends e ON g.path = e.path
LEFT JOIN nodes p ON g.depth > 0 AND p.path = left(g.path, length(g.path) - 32)
"""
