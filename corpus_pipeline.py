"""documents -> training tokens: quality classifier, near-dedup, substring dedup, mixing, byte-level BPE."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow import session
from furrow.llm import byte_bpe, mixing, quality_classifier, simhash, substring_dedup
from furrow.llm import text as T


OWN = ("doc_id", "text", "lang", "source", "n_chars")  #: columns that stages know; all others pass through


def _stage(f: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage over a table whose other columns are numbered meanwhile, so that no name of theirs can clash."""

    @functools.wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        session.ship(spark)
        plain = docs.toDF(*(c if c in OWN else f"column{i}" for i, c in enumerate(docs.columns)))
        out = f(spark, plain, sf_dir)
        return out.toDF(*docs.columns) if out.columns == plain.columns else out

    return run


def _packed(docs: DataFrame) -> DataFrame:
    """Id, text and all other columns in one."""
    return docs.select("doc_id", "text", F.struct(F.lit(None).cast("int").alias("none"), *(c for c in docs.columns if c not in ("doc_id", "text"))).alias("_others"))


def _unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*(F.col(c) if c in ("doc_id", "text") else F.col(f"_others.{c}") for c in columns))


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled ones outside the held-out fold."""
    model = quality_classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _unpacked(quality_classifier.classify(_packed(docs), model, keep=("text", "_others")).where("predicted = 1"), docs.columns)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of least id, rows without an id last.

    Where ids repeat or are missing, id and fingerprint tell rows apart; of rows that share both, the least one stays.
    """
    found = session.written(simhash.grouped(docs), "groups")
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("_k")).select(F.col("_k.doc_id").alias("_id"), F.col("_k.fp").alias("_fp"))
    repeated = session.written(found.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_again")).count().where("count > 1").select("_again"), "repeated-ids")
    alone = first.join(repeated, F.col("_id") == F.col("_again"), "left_anti")
    out = docs.join(alone, F.col("doc_id") == F.col("_id"), "left_semi")
    unclear = docs.join(repeated, F.col("doc_id") == F.col("_again"), "left_semi").unionByName(docs.where("doc_id IS NULL"))
    if not unclear.limit(1).count():
        return out
    fp = F.udf(lambda raw: simhash.signed(bytes(raw)), "long", useArrow=True)
    told = _packed(unclear).withColumn("_own", fp(T.as_bytes(F.col("text"))))
    kept = told.join(first, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_fp")), "left_semi")
    # of rows alike in id and fingerprint the least text, and with it the least other columns as JSON (maps have no order)
    least = kept.groupBy("doc_id", "_own").agg(F.min_by(F.struct("text", "_others"), F.struct("text", F.to_json("_others"))).alias("_row")).select("doc_id", "_row.text", "_row._others")
    return out.unionByName(_unpacked(least, docs.columns))


@_stage
def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the words that a window of 20 repeats from an earlier place."""
    done = substring_dedup.dedup(_packed(docs), min_words=20, keep=("_others",))
    if "n_chars" in docs.columns:
        changed = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_others.n_chars"))
        done = done.withColumn("_others", F.col("_others").withField("n_chars", changed))
    return _unpacked(done, docs.columns)


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each pass that the mix takes over a document, with the words it takes."""
    mixed = session.written(mixing.mix(docs), "mix")
    return mixing.render(docs, mixed, docs.columns)


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and whether they decode to its text."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    hashed = docs.select("doc_id", "text", "lang", "source", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    done = byte_bpe.encode(hashed, path, pattern, keep=("lang", "source", "sha"), decoded=True)
    return done.select("doc_id", "lang", "source", "n_tokens", "ids", (F.sha2("decoded", 256) == F.col("sha")).alias("round_trip"))


STAGES = [("quality classifier", quality), ("simhash near-dedup", near_dedup), ("substring dedup", substrings), ("mixing sources", mix), ("byte-level bpe", tokens)]

#: The classifier and the fingerprints are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = session.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
