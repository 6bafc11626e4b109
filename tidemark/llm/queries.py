"""The registered queries of the training-data operators: each applies its
operator to the whole table and returns the full result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, fill_middle, html_text, jaccard_join, near_dup, packing, quality, relative_lz, secrets, suffixes, token_counts, tokenbin, vocab, whitening
from .common import prepare
from .oracle import ORACLE_SQL  # noqa: F401 - read by the entry module

VOCAB_DIR = None  # None: the installed public_tokenizers package


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(_table(spark, sf_dir, "documents", "doc_id", "text"))


#: The edit that op2's query makes: each number of four digits and more is masked.
NUMBER = secrets.Rule("number", "[0-9]{4,}", 0, 4)
MASK = "<number>"


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    found = secrets.matches("text", NUMBER)
    edits = F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"),
                                                  F.lit(MASK).alias("text")))
    rows = token_counts.with_trees(docs.withColumn("edits", edits), folder=VOCAB_DIR)
    return token_counts.edited_counts(rows, VOCAB_DIR).drop("tree_tokens")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    found, _ = secrets.scan_secrets(docs)
    return secrets.span_digest(found)


def op4_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relative_lz.remove_repeats(_table(spark, sf_dir, "documents", "doc_id", "text")) \
        .select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_suffix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents", "doc_id", "text")) \
        .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return tokenbin.documents_in(tokenbin.token_table(docs, folder=VOCAB_DIR, remembered=vocab.MANY_REMEMBERED))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.matches(docs, _table(spark, sf_dir, "benchmark", "item_id", "text")) \
        .select("doc_id", "item_id", "distance")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents", "doc_id", "text"), folder=VOCAB_DIR,
                                  remembered=vocab.MANY_REMEMBERED)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op11_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digest(fill_middle.fill_in_middle(_table(spark, sf_dir, "documents", "doc_id", "text")))


QUERIES = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_secret_scan": op3_secret_scan,
    "op4_relative_lz": op4_relative_lz,
    "op5_suffix_sort": op5_suffix_sort,
    "op6_token_blocks": op6_token_blocks,
    "op7_quality_rules": op7_quality_rules,
    "op8_decontamination": op8_decontamination,
    "op9_packing": op9_packing,
    "op10_html_extraction": op10_html_extraction,
    "op11_partenum_join": op11_partenum_join,
    "op12_whitening": op12_whitening,
    "op13_fill_middle": op13_fill_middle,
}
