"""One query per operator: the operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import language, toxicity
from tripmart.llm.common import remainder, table
from tripmart.llm.decontamination import contamination
from tripmart.llm.edits import edited_counts
from tripmart.llm.html_text import main_text
from tripmart.llm.katz import katz_scores_by_part
from tripmart.llm.licenses import license_labels
from tripmart.llm.merkle import folded, manifest, proof_digest
from tripmart.llm.oracle import ORACLE
from tripmart.llm.packing import pack_documents
from tripmart.llm.simhash import near_duplicate_groups
from tripmart.llm.suffix_dedup import without_repeats
from tripmart.llm.variants import spelling_variants
from tripmart.llm.winnowing import fingerprint_edits

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"), TOKENIZER, keep_ids=False)
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


TOXIC_FROM = 0.7


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", (remainder("doc_id", 3) == 1).alias("held_out")
    )
    labels = table(spark, sf_dir, "labels").filter(remainder("doc_id", 3) != 1)
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model, keep=("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "documents"))


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_labels(table(spark, sf_dir, "documents")).drop("blocks")


def _spelled(entries: str) -> Column:
    """Kept hashes with their places, as text."""
    return F.array_join(F.transform(entries, lambda x: F.lower(F.hex(x))), " ")


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint_edits(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256", _spelled("entries").alias("fingerprint"),
        _spelled("edited_entries").alias("edited_fingerprint"), "near_edited", "near_next",
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three edits of every document: ten code points cut at a quarter, its source and language
    put in the middle, and twenty at three quarters replaced by the first twenty."""
    n = F.length("text")
    edit = lambda start, length, text: F.struct(
        F.floor(start).cast("int").alias("start"), F.lit(length).alias("length"), text.alias("text")
    )
    docs = table(spark, sf_dir, "documents").withColumn("edits", F.array(
        edit(n / 4, 10, F.lit("")),
        edit(n / 2, 0, F.concat_ws(" ", F.lit(" from"), "source", "lang")),
        edit(3 * n / 4, 20, F.substring("text", 1, 20)),
    ))
    return edited_counts(docs, TOKENIZER).drop("leaf_chars", "leaf_tokens")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", (remainder("doc_id", 3) == 1).alias("held_out")
    )
    model = language.fit(docs.filter("not held_out"))
    return language.predict(docs, model, keep=("doc_id", "held_out"))


def contaminated() -> Column:
    """At least one hit word in twenty."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", (remainder("doc_id", 7) == 2).alias("held_out")
    )
    return katz_scores_by_part(docs, ~F.col("held_out"), keep=("doc_id", "held_out"))


def manifest_digests(docs: DataFrame) -> DataFrame:
    """Leaves, roots and proofs of the documents, and what a copy leads to in which the lengths of some are one
    too high. A null id counts as empty text."""
    altered = F.when(remainder("doc_id", 7) == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    found = manifest(
        docs, columns, key="doc_id", group="lang", keep=("doc_id",),
        changed=["doc_id", "source", "lang", altered, "text"],
    )
    back = folded(F.col("changed_leaf"), F.col("path"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), back.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_digests(table(spark, sf_dir, "documents"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_toxicity": op2_toxicity,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_license_scans": op4_license_scans,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_token_counts": op6_token_counts,
    "op7_language_id": op7_language_id,
    "op8_decontamination": op8_decontamination,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_html_extraction": op12_html_extraction,
    "op13_spelling_variants": op13_spelling_variants,
}
__all__ = ["ORACLE", "QUERIES"]
