"""The registered queries of the training-data operators, each over whole tables.

Every query applies its operator with production parameters and derives the digest columns of its
contract from the operator's real outputs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm import (
    bpe,
    compression_quality,
    decontamination,
    hmm,
    language_id,
    licenses,
    line_dedup,
    ngram_join,
    oracles,
    periodic_runs,
    quality_rules,
    substring_dedup,
    token_frames,
    whitening,
)
from martflow.llm.common import fold_of, read_table, shared_folder

BPE_VOCAB = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCAB = public_tokenizers.path("word_bpe_49k.json")
#: The token that op 11 appends to each document.
END_ID = 2


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup_substrings(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = language_id.fit_languages(docs, fold_of("doc_id", 4) != 2)
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op4_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model, counts, encoded = hmm.fit_hmm(docs, fold_of("doc_id", 5) != 1)
    scored = hmm.score_texts(encoded, model, counts)
    held_out = (fold_of("doc_id", 5) == 1).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.bpe_encode(read_table(spark, sf_dir, "documents"), BPE_VOCAB)
    decoded = bpe.bpe_decode(encoded, BPE_VOCAB)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        decontamination.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(read_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules.quality_cascade(docs, counts="counts")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return (
        judged.select("doc_id", *(F.col(f"counts.{c}").alias(c) for c in columns), "kept")
        .withColumn("base_failed", failed)
        .withColumn("kept", F.col("kept") & ~failed)
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = lambda labels: F.array_join(F.sort_array(F.array_distinct(labels)), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").cast("long").alias("first_word"),
        F.array_max("base.word").cast("long").alias("last_word"),
        joined(F.col("base.label")).alias("base_labels"),
        joined(F.concat("base.label", "licenses.label")).alias("labels"),
        F.col("license_score").alias("score"),
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    model = compression_quality.fit_quality(docs, labels, fold_of("doc_id", 5) != 0)
    scored = compression_quality.quality_scores(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op11_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = token_frames.encode_words(read_table(spark, sf_dir, "documents"), WORD_VOCAB)
    folder = f"{shared_folder(spark).rstrip('/')}/token-frames-{uuid.uuid4().hex}"
    found = token_frames.read_tokens(spark, token_frames.write_tokens(encoded, folder, END_ID))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def with_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text) as the contract of op 12 has it: the words of every tenth document become periodic."""
    h = F.crc32(F.col("doc_id").cast("string"))
    parts = (
        docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.coalesce(h % 10 == 0, F.lit(False)).alias("chosen"))
        .withColumn("w", F.when(F.col("chosen"), F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")))
        .withColumn("n", F.coalesce(F.size("w"), F.lit(0)))
        .withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
        .withColumn("p", F.when(F.col("n") > 0, F.expr("cast(1 + (n - a) div (3 + g % 8) as int)")))
    )
    repeated = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    words = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(repeated, F.lit(1), F.col("n") - F.col("a")))
    return parts.select("doc_id", F.when(F.col("n") > 0, F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_periods(read_table(spark, sf_dir, "documents")))
    ordered = F.sort_array(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"], r["period"])))
    best = found.withColumn("best", F.get(ordered, F.lit(0)))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.shorter")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("-1000 * best.shorter div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select(
        "vec_id", F.posexplode_outer("whitened").alias("at", "whitened"), "n", "deviation", "explained", "identity_error"
    ).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        # a sum beyond 64 bits has no long: null; the operator has it as a decimal
        F.col("deviation").try_cast("bigint").alias("deviation"),
        "whitened",
        F.get("explained", F.col("at")).alias("explained"),
        "identity_error",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_language_id": op2_language_id,
    "op3_line_dedup": op3_line_dedup,
    "op4_hmm": op4_hmm,
    "op5_bpe": op5_bpe,
    "op6_quality": op6_quality,
    "op7_decontamination": op7_decontamination,
    "op8_ngram_join": op8_ngram_join,
    "op9_quality_rules": op9_quality_rules,
    "op10_licenses": op10_licenses,
    "op11_token_frames": op11_token_frames,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_whitening": op13_whitening,
}

#: The other queries depend on trained models, a tokenizer, or regular expressions that DuckDB lacks.
ORACLES: dict[str, str | None] = {
    "op1_substring_dedup": oracles.OP1,
    "op3_line_dedup": oracles.OP3,
    "op7_decontamination": oracles.OP7,
    "op8_ngram_join": oracles.OP8,
    "op12_periodic_runs": oracles.OP12,
}
