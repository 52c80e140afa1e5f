"""The queries of the operators, one thin query each, and the SQL for those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auricle.llm import (
    collocations,
    decontamination,
    language,
    licenses,
    lm,
    minhash,
    packing,
    pii,
    quality,
    simhash,
    spelling,
    token_files,
    urls,
)
from auricle.llm.common import fold, table
from auricle.session import run_dir

TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"
RANKS = "byte_bpe_50k.tiktoken"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return urls.verdicts(table(spark, sf_dir, "pages"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MinHash fingerprints of every document and of its edited text, and its near-duplicate class."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        "class_id",
    )


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence paragraphs of every document."""
    return licenses.licenses(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in every document."""
    return decontamination.leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of every document."""
    return lm.scores(
        table(spark, sf_dir, "documents"), tokenizer_path(RANKS), tokenizer_pattern()
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 1024 tokens."""
    return packing.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    found = language.languages(docs, language.learn(docs))
    held = F.coalesce(fold(F.col("doc_id"), language.FOLDS) == language.HELD_OUT, F.lit(False))
    return found.withColumn("held_out", held)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word, the form it is a variant of and the root of that."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written to ORC files and read back."""
    path = run_dir(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path(WORD_TOKENIZER))
    return token_files.checksums(token_files.read_tokens(spark, path))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of every language that occur most above what their parts let expect."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_urls,
        op2_personal_data,
        op3_fingerprints,
        op4_licenses,
        op5_decontamination,
        op6_quality,
        op7_lm_scores,
        op8_simhash,
        op9_packing,
        op10_language,
        op11_spelling,
        op12_token_files,
        op13_collocations,
    )
}
ORACLE: dict[str, str] = {"op1_urls": urls.ORACLE, "op13_collocations": collocations.ORACLE}
