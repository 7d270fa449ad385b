"""The thin `opN_<name>` queries over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from terroir.llm import (contamination, language, near_dups, packing, repair, repeats, replies, sharding, simple8b, url_rules,
                         vectors, warc, whitening)
from terroir.llm.common import table, written
from terroir.llm.tokens import default_tokenizer
from terroir.session import scratch_path

# Fixed values of the contract: (host, path, verdict).
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op1_best_fit_packing(spark, d):
    return packing.pack_documents(table(spark, d, "documents"), default_tokenizer(), 2048, 0)


def op2_language_masks(spark, d):
    docs = table(spark, d, "documents")
    filters = language.fit(language.labelled_rows(docs))
    return language.predict(docs, filters).select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op3_simple8b(spark, d):
    path = scratch_path(spark, "simple8b")
    simple8b.write_token_files(table(spark, d, "documents"), path, default_tokenizer(), 2)
    return simple8b.read_documents(spark, path)


def op4_templates(spark, d):
    """One row for each contaminated document and benchmark item."""
    return contamination.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark")).drop("text_hash")


def op5_multi_index_minhash(spark, d):
    return near_dups.near_duplicates(table(spark, d, "documents"))


def op6_shard_graphs(spark, d):
    return vectors.near_vectors(table(spark, d, "embeddings"))


def op7_warc(spark, d):
    path = scratch_path(spark, "warc")
    warc.write_bundles(table(spark, d, "pages"), path, min_bytes=0)
    return warc.read_bundles(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_prefix_free_parsing(spark, d):
    return repeats.remove_repeats(table(spark, d, "documents"))


def op9_url_rules(spark, d):
    rules = [url_rules.host_path_rule(*r) for r in URL_RULES]
    return url_rules.judge_urls(table(spark, d, "pages"), rules)


def op10_minimax_shards(spark, d):
    return sharding.shard_documents(table(spark, d, "documents"), 16)


def op11_edit_search(spark, d):
    return repair.repaired(table(spark, d, "conversations"), repair.damaged)


def op12_jacobi_davidson(spark, d):
    return whitening.whiten(table(spark, d, "embeddings"))


# Fixed values of the contract: the conversation added to the table.
ADDED_ID, ADDED_ROLES, ADDED_TEXT = -1, ("user", "assistant"), "</s>[INST] ok [/INST]"


def op13_reply_trees(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, ADDED_ROLES[0]).otherwise(ADDED_ROLES[1])
    added = spark.range(2).select(F.lit(ADDED_ID).cast(rows.schema["conv_id"].dataType).alias("conv_id"),
                                  F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
                                  role.alias("role"), F.lit(ADDED_TEXT).alias("text"))
    return replies.digests(written(replies.format_conversations(rows.unionByName(added)), "formatted"))


QUERIES = {f.__name__: f for f in (op1_best_fit_packing, op2_language_masks, op3_simple8b, op4_templates, op5_multi_index_minhash, op6_shard_graphs, op7_warc, op8_prefix_free_parsing,
                                     op9_url_rules, op10_minimax_shards, op11_edit_search, op12_jacobi_davidson, op13_reply_trees)}

_WORDS = "|".join(url_rules.BLOCKED_HOST_WORDS)
SQL = {
    "op7_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
g AS (SELECT page_id, octet_length(body) AS n, sha1(body) AS h,
             max(page_id) OVER (PARTITION BY sha1(body)) AS chosen FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
           (CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> ((3 - i % 4) * 5)) & 31 AS BIGINT) + 1,
           1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = chosen OR chosen IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = chosen THEN NULL ELSE chosen END AS refers_to
FROM g""",
    "op9_url_rules": rf"""
WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '^[\s\S]*?://([^/?#]*)', 1), ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  coalesce(regexp_extract(url, '^[\s\S]*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT *, CASE
        WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule FROM u)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host, '(^|[.\-])({_WORDS})([.\-]|$)') THEN 'block' ELSE 'allow' END AS verdict FROM r""",
    "op13_reply_trees": rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT {ADDED_ID}, 0, '{ADDED_ROLES[0]}', '{ADDED_TEXT}'
           UNION ALL SELECT {ADDED_ID}, 1, '{ADDED_ROLES[1]}', '{ADDED_TEXT}'),
e AS (SELECT *, regexp_replace(regexp_replace(role, '(<\\*)(/?s>)', '\1\\\2', 'g'),
                               '(\[\\*)(/?INST\])', '\1\\\2', 'g') AS safe_role,
             regexp_replace(regexp_replace(text, '(<\\*)(/?s>)', '\1\\\2', 'g'),
                            '(\[\\*)(/?INST\])', '\1\\\2', 'g') AS safe_text FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<s>' || safe_role || '[INST]' || safe_text || '[/INST]</s>')) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""",
}
