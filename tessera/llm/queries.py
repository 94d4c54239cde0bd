"""Registered queries ``op<N>_<name>``: thin, whole tables, production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import collocations, decontamination, html_text, line_dedup, ngram_join, packing, pii, quality_rules, recurrent_lm, spelling, suffix_dedup, toxicity, url_filter
from tessera.llm.scratch import crc_mod, documents, written

#: The rules that the URL query judges by.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    return ngram_join.near_duplicates(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links", "class_size")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; fitted on labelled rows outside the held-out third."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.fit(docs, documents(spark, sf_dir, "labels"), crc_mod("doc_id", 3) != 1)
    return toxicity.score(docs, model).select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score",
                                              "predicted")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract_main_text(documents(spark, sf_dir, "pages"))


def op4_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and recurrent log10 probability of every document; a seventh is held out."""
    docs = documents(spark, sf_dir)
    held_out = crc_mod("doc_id", 7) == 2
    return recurrent_lm.score(docs, ~held_out).select(
        "doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes outside repeated 200-byte strings."""
    found = suffix_dedup.repeated_spans(documents(spark, sf_dir), keep="none")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    kept = (F.when(F.size("spans") == 0, F.col("text_sha256"))
            .otherwise(F.sha2(F.coalesce("kept", F.lit("").cast("binary")), 256)))
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        kept.alias("kept_sha256"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with later copies of repeated line runs cut out."""
    return line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", F.char_length("text").cast("long").alias("n_chars"),
        F.md5("text").alias("text_md5"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL under the fixed rules."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(documents(spark, sf_dir, "pages"), rules).select(
        "page_id", "host", "path", "rule", "verdict")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's matches of benchmark items within the allowed edits."""
    return decontamination.find_leaks(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 2048 ids."""
    pieces = packing.tokenized_pieces(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(pieces)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and the learned decision list's verdict on every document."""
    stats = written(quality_rules.text_statistics(documents(spark, sf_dir).select("doc_id", "text")).drop("text"),
                    "quality-figures")
    marked = (documents(spark, sf_dir, "labels").where("quality is not null and doc_id is not null")
              .groupBy("doc_id").agg(F.max(1 - F.col("quality")).alias("bad")))
    failed = quality_rules.base_failed()
    rules = quality_rules.learn_rules(stats.where(~failed).join(marked, "doc_id"))
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        failed.alias("base_failed"), (~failed & quality_rules.rules_column(rules)).alias("kept"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of two and three words of every language."""
    return collocations.mine_phrases(documents(spark, sf_dir)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every word of seven letters or more that occurs twice."""
    return spelling.spelling_variants(documents(spark, sf_dir))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: pattern counts and digest, and all spans."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = pii.find_personal_data(docs, pii.fit(docs)).drop("text")
    counts = [F.size(F.array_remove(F.col("base.kind"), F.lit(kind))) for kind in pii.KINDS]
    counts = [(F.size("base") - rest).cast("long").alias(f"n_{kind}") for kind, rest in zip(pii.KINDS, counts)]
    return found.select("doc_id", *counts, F.sha2(pii.written_out("base"), 256).alias("base_sha256"),
                        pii.written_out("spans").alias("spans"))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_toxicity": op2_toxicity,
    "op3_html_text": op3_html_text,
    "op4_recurrent_lm": op4_recurrent_lm,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_decontamination": op8_decontamination,
    "op9_packing": op9_packing,
    "op10_quality_rules": op10_quality_rules,
    "op11_collocations": op11_collocations,
    "op12_spelling": op12_spelling,
    "op13_pii": op13_pii,
}
