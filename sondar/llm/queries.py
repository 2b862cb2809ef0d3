"""Queries of the llm operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondar.llm.bpe import encode_corpus
from sondar.llm.encoding import find_garbled
from sondar.llm.linkage import match_entities
from sondar.llm.lookalike import lookalike_classes, lookalike_pairs, unify_text
from sondar.llm.residue import find_residue, main_body
from sondar.llm.mixing import mix, plan_sources, shares
from sondar.plans.lineage import written
from sondar.plans.tables import table


_PAGE = ("evidence_id", "host", "content", "html", "title")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Pages that are template residue or an error page."""
    return find_residue(table(spark, d, "fetched_evidence"), *_PAGE).select("evidence_id").distinct()


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the main body of real pages."""
    return main_body(table(spark, d, "fetched_evidence"), *_PAGE).select("evidence_id", "line_no").distinct()


def p6_matches(spark: SparkSession, d: str) -> DataFrame:
    """Rows of both tables that tell of the same certame, with a confidence."""
    return match_entities(table(spark, d, "concursos_base"), table(spark, d, "concursos_radar"), "base_id", "radar_id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """The matched pairs."""
    return p6_matches(spark, d).select("base_id", "radar_id")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose content was read in a wrong encoding."""
    return find_garbled(table(spark, d, "fetched_evidence"), "evidence_id", "content", restore=False).select("evidence_id").distinct()


def p7_restored(spark: SparkSession, d: str) -> DataFrame:
    """Garbled rows with the cipher source found and the text restored by it."""
    return find_garbled(table(spark, d, "fetched_evidence"), "evidence_id", "content")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Every document as ids of byte_bpe_50k."""
    return encode_corpus(table(spark, d, "documents"), "doc_id", "text")


def _sized(spark: SparkSession, d: str) -> DataFrame:
    return written(encode_corpus(table(spark, d, "documents"), "doc_id", "text", out="n_tokens", count_only=True, keep=["source"]), "sized")


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The mixture: one row for each use of a document."""
    return mix(_sized(spark, d), table(spark, d, "mix_targets"), "doc_id", "n_tokens")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share of each source in the mixture."""
    sized, targets = _sized(spark, d), table(spark, d, "mix_targets")
    return shares(mix(sized, targets, "doc_id", "n_tokens"), plan_sources(sized, targets, "n_tokens"), "n_tokens")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of documents that look the same but differ in their characters."""
    return lookalike_pairs(table(spark, d, "documents"), "doc_id", "text")


def p10_classes(spark: SparkSession, d: str) -> DataFrame:
    """Documents that look like a different string, by class, with the number of their links."""
    return lookalike_classes(table(spark, d, "documents"), "doc_id", "text")


def p10_canonical(spark: SparkSession, d: str) -> DataFrame:
    """The consistent form of every document."""
    return unify_text(table(spark, d, "documents"), "doc_id", "text").select("doc_id", "canonical", F.coalesce(F.col("canonical") != F.col("text"), F.lit(False)).alias("changed"))


QUERIES = {f.__name__: f for f in (p3_found, p4_found, p6_found, p6_matches, p7_found, p7_restored, p8_ids, p9_mix, p9_shares, p10_found, p10_classes, p10_canonical)}
ORACLES: dict[str, str] = {}
