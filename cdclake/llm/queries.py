"""Query catalog of the training-data operators: name -> function, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.llm import bpe, html_density, language_id, multiprobe_ann, ngram_jaccard, ordinal_quality, passage_dedup, pfair_mix, quality_rules, secret_scan, vector_codes, whitening
from cdclake.llm import toxicity as toxicity_model
from cdclake.llm.common import read_table

#: Folder of the public vocabulary files.
TOKENIZER_DIR = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
VOCABULARY = os.path.join(TOKENIZER_DIR, "word_bpe_49k.json")


def op1_multiprobe_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found of every vector whose id is divisible by 100."""
    return multiprobe_ann.nearest(read_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text."""
    return toxicity_model.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    return ngram_jaccard.classes(read_table(spark, sf_dir, "documents"))


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded; digests of ids and decoded text."""
    return bpe.digests(bpe.encode(read_table(spark, sf_dir, "documents"), VOCABULARY, decoded=True))


def op5_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in the mix: the slot of its block and the offset inside the block."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    return pfair_mix.mix(docs).select("doc_id", "source", "mix_slot", "mix_offset")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document, and the verdict of the risk-controlled rules."""
    verdicts = quality_rules.quality_verdicts(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and entropy spans of every whole text."""
    return secret_scan.digests(secret_scan.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op8_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, tail probability and selection of every document."""
    return ordinal_quality.quality_grades(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated passages; spans in offsets of the original text."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = passage_dedup.remove(docs, passage_dedup.repeated_spans(docs))
    return kept.select(
        "doc_id",
        F.size("removed_spans").alias("n_removed"),
        "removed_spans",
        "kept_spans",
        F.col("text").alias("kept_text"),
    )


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    texts = html_density.extract(read_table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as 16 indexes into the codebooks of its parts, with its error."""
    return vector_codes.digests(*vector_codes.compress(read_table(spark, sf_dir, "embeddings")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the 32 leading components, scaled to variance one."""
    return whitening.components(whitening.whiten(read_table(spark, sf_dir, "embeddings")))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text."""
    return language_id.languages(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_multiprobe_ann": op1_multiprobe_ann,
    "op2_toxicity": op2_toxicity,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_bpe_codec": op4_bpe_codec,
    "op5_pfair_mix": op5_pfair_mix,
    "op6_quality_rules": op6_quality_rules,
    "op7_secret_scan": op7_secret_scan,
    "op8_ordinal_quality": op8_ordinal_quality,
    "op9_passage_dedup": op9_passage_dedup,
    "op10_html_extraction": op10_html_extraction,
    "op11_vector_codes": op11_vector_codes,
    "op12_whitening": op12_whitening,
    "op13_language_id": op13_language_id,
}
ORACLES: dict[str, str] = {
    "op3_ngram_jaccard": ngram_jaccard.oracle(),
    "op6_quality_rules": quality_rules.oracle(),
    "op7_secret_scan": secret_scan.oracle(),
    "op11_vector_codes": vector_codes.oracle(),
}
