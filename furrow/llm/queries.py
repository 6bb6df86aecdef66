"""One query for each operator, over its whole table, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow import session
from furrow.llm import byte_bpe, chat, embedding_dedup, language_id, mixing, quality_classifier, quality_rules, simhash, substring_dedup, token_files
from furrow.llm import text as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_hash(column: Column):
    """SHA-256 of a text's words joined by one space."""
    return F.sha2(F.regexp_replace(F.regexp_replace(column, "[\\x20\\x09-\\x0D]+", " "), "^ | $", ""), 256)


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_dedup(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    done = byte_bpe.encode(table(spark, sf_dir, "documents"), path, pattern, decoded=True)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    to = session.place(spark, "tokens")
    token_files.write(table(spark, sf_dir, "documents"), to, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.read(spark, to)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.dedup(table(spark, sf_dir, "documents"), min_words=20)
    return done.select("doc_id", "n_words", "n_removed", words_hash(F.coalesce("text", F.lit(""))).alias("kept_sha256"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.train(docs))
    return found.select("doc_id", T.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations are written as plain transcripts, many markers of which are missing or odd, and their roles and turns recovered."""
    conversations = table(spark, sf_dir, "conversations")
    raw = chat.transcripts(conversations).withColumn("key", F.struct("conv_id", "part"))
    found = chat.parsed(raw.select("key", "text"), "key", "text", chat.learn(conversations), escaped=True)
    return found.select("key.conv_id", "key.part", F.size("turns").cast("long").alias("n_turns"), F.array_join(F.transform("turns", lambda t: t["role"]), ",").alias("roles"), F.sha2("rendered", 256).alias("rendered_sha256"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.classify(docs, model).select("doc_id", T.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_embedding_dedup, op2_byte_bpe, op3_token_files, op4_substring_dedup, op5_quality_rules, op6_language_id, op7_mixing, op8_chat, op9_quality_classifier, op10_simhash)
}

ORACLE_SQL: dict[str, str] = {
    "op1_embedding_dedup": r"""
        WITH RECURSIVE fine AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
        ), reach AS (
            SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        ), least AS (
            SELECT a, min(b) AS component_id FROM reach GROUP BY a
        )
        SELECT e.vec_id, CAST((SELECT count(*) FROM links WHERE links.a = e.vec_id) AS BIGINT) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
        FROM embeddings e JOIN least l ON l.a = e.vec_id""",
    "op8_chat": r"""
        SELECT conv_id, turn // 512 AS part, count(*) AS n_turns, string_agg(role, ',' ORDER BY turn) AS roles,
               sha256(string_agg('<|' || role || '|>' || chr(10) || trim(coalesce(text, ''), chr(10)) || chr(10) || '<|end|>' || chr(10), '' ORDER BY turn)) AS rendered_sha256
        FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL
        UNION ALL
        SELECT conv_id, turn // 512, 1, role, sha256('<|' || role || '|>' || chr(10) || trim(coalesce(text, ''), chr(10)) || chr(10) || '<|end|>' || chr(10))
        FROM conversations WHERE conv_id IS NULL OR turn IS NULL""",
    "op4_substring_dedup": r"""
        WITH texts AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
        ), windows AS (
            SELECT doc_id, unnest(list_transform(range(1, len(words) - 18), lambda i: {'i': i, 'k': md5(array_to_string(words[i : i + 19], ' '))})) AS w FROM texts
        ), later AS (
            SELECT doc_id, w.i AS i FROM windows QUALIFY row_number() OVER (PARTITION BY w.k ORDER BY doc_id, w.i) > 1
        ), gone AS (
            SELECT DISTINCT doc_id, i + j AS place FROM later, range(0, 20) AS r(j)
        ), removed AS (
            SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id
        )
        SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
               sha256(CASE WHEN places IS NULL THEN array_to_string(words, ' ')
                           ELSE array_to_string(list_transform(list_filter(range(1, len(words) + 1), lambda p: NOT list_contains(places, p)), lambda p: words[p]), ' ') END) AS kept_sha256
        FROM texts t LEFT JOIN removed r ON t.doc_id = r.doc_id""",
}
