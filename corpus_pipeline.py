"""A training-corpus pipeline: classify, cut repeated lines, join near copies, decontaminate, tokenise.

Every stage is (name, function); a function takes (spark, docs, sf_dir) and returns the next stage's
docs. All but the last keep the columns of ``documents``.

Null texts count as empty: they have no lines, shingles, benchmark words or tokens, and stay as far as the classifier
lets empty texts stay. Rows with a null id take part like others and come after them where order matters. Rows
alike in id and text are one place for the line stage and one document for the join, which keeps one of them; rows
that repeat an id with other texts are documents of their own. Extra columns pass through all stages but the
last, whatever their names. An empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm import bpe, compression_quality, decontamination, line_dedup, ngram_join
from martflow.llm.common import fold_of, read_table, ship, small_batches, written
from martflow.llm.queries import BPE_VOCAB

#: A document scored below this is rejected by the classifier.
LEAST_QUALITY = 0.3
#: Near copies share at least so many of 100 shingles of so many words.
COPY_SHINGLE, COPY_PERCENT = 5, 80


def prepare(spark: SparkSession) -> None:
    """What every stage needs of the session, where executors stay up through all of them."""
    ship(spark)
    small_batches(spark)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier doesn't reject; it learns from the labelled ones."""
    prepare(spark)
    model = compression_quality.fit_quality(docs, read_table(spark, sf_dir, "labels"), fold_of("doc_id", 5) != 0)
    scored = compression_quality.quality_scores(docs, model, score="quality_score")
    return scored.where(F.col("quality_score") >= LEAST_QUALITY).select(*docs.columns)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeats of line runs; one of which nothing is left goes."""
    prepare(spark)
    found = line_dedup.dedup_lines(docs)
    cut = F.col("n_removed") > 0
    changed = found.where(~(cut & (F.col("text") == ""))).withColumn("n_chars", F.when(cut, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)


def join_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: five-word shingles, a similarity of 0.8 or more."""
    prepare(spark)
    return ngram_join.one_of_each(docs, size=COPY_SHINGLE, percent=COPY_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passages of the benchmark, or hardly any."""
    prepare(spark)
    found = decontamination.contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return found.where(~decontamination.is_contaminated(F.col("n_hit"), F.col("n_words"))).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of the ids and of the text that they decode to."""
    prepare(spark)
    # written in between: else each task has one Python worker that encodes and another that decodes
    encoded = written(bpe.bpe_encode(docs, BPE_VOCAB), "token-ids")
    decoded = bpe.bpe_decode(encoded, BPE_VOCAB)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", cut_lines),
    ("ngram_join", join_copies),
    ("decontamination", decontaminate),
    ("bpe", tokenize),
]

#: SQL can't restate the trained classifier and the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
