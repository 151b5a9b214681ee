"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html_extract, line_dedup, mixing, ordinal, periodic_runs, pieces, quality_rules, secret_scan, simhash, spelling, substring_dedup, topk, warc
from .common import table

PIECE_MODEL = "piece_bpe_32k.model"


def piece_model(name: str = PIECE_MODEL) -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op1_warc_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines_removed")


#: Domains of the labels: good, of low quality, toxic; and the share of the tokens that each shall have.
DOMAIN_WEIGHTS = (0.97, 0.02, 0.01)


def domains(labels: DataFrame) -> DataFrame:
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 0)
    return labels.select("doc_id", domain.alias("domain"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates that bring the domains to their weights, while good documents keep their total."""
    found = mixing.mixed(table(spark, sf_dir, "documents"), domains(table(spark, sf_dir, "labels")), DOMAIN_WEIGHTS, ["doc_id"], steady=0)
    return found.select("doc_id", "n_tokens", *[F.col("p")[k].alias(f"p_{name}") for k, name in enumerate(("good", "low", "toxic"))], "rate")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"), ["page_id", "url"])


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoding_digests(table(spark, sf_dir, "documents"), piece_model())


def op9_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings 0 to 2: a point for good quality, one for not being toxic. Kept: rating 2 is likely."""
    docs = table(spark, sf_dir, "documents")
    ratings = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") + 1 - F.col("toxic")).alias("grade"))
    graded = ordinal.grade(docs, ordinal.train(docs, ratings, 3), ["doc_id"])
    return graded.select("doc_id", "expected_grade", F.col("tails")[0].alias("p_grade_1"), F.col("tails")[1].alias("p_grade_2"), ordinal.selected(F.col("tails")[1]).alias("kept"))


def op10_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests only, so that texts without a tile aren't stored."""
    docs = periodic_runs.planted(table(spark, sf_dir, "documents"))
    return periodic_runs.run_digests(periodic_runs.periodic_runs(docs, texts=False))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spelling.word_counts(table(spark, sf_dir, "documents")))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.span_digests(secret_scan.secrets(docs, secret_scan.train(docs)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_merge": op1_warc_merge,
    "op2_quality_rules": op2_quality_rules,
    "op3_line_dedup": op3_line_dedup,
    "op4_mixing": op4_mixing,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_html_extract": op6_html_extract,
    "op7_simhash": op7_simhash,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_ordinal_quality": op9_ordinal_quality,
    "op10_mtree_topk": op10_mtree_topk,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_secret_scan": op13_secret_scan,
}

ORACLES: dict[str, str] = {
    "op1_warc_merge": warc.ORACLE,
    "op2_quality_rules": quality_rules.oracle(),
    "op3_line_dedup": line_dedup.ORACLE,
    "op5_substring_dedup": substring_dedup.ORACLE,
    "op10_mtree_topk": topk.oracle(5, 50),
}
