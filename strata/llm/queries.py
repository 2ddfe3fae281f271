"""The registered queries of the operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import exact_dedup, html_render, language_id, lexical_search, licenses, odd_sketch, piece_bpe, prefix_trie, secret_scan, substring_dedup, token_counts, winnowing, wu_manber
from strata.llm.common import table

#: Vocabulary files of public tokenizers: the name of a file in the package that carries them.
PIECE_MODEL = "piece_bpe_32k.model"
BYTE_RANKS = "byte_bpe_50k.tiktoken"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edits with the next one."""
    return winnowing.with_edits(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of license templates in every document, a row a document;
    ``n_licenses`` counts distinct templates."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    places = F.transform("licenses", lambda m: F.concat_ws(":", m["name"], m["start"].cast("string"), m["end"].cast("string")))
    return found.select("doc_id", "n_words", F.size(F.array_distinct("licenses.name")).cast("long").alias("n_licenses"), F.array_join(places, ";").alias("licenses"))


def op3_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near duplicates over all documents."""
    return odd_sketch.near_duplicates(table(spark, sf_dir, "documents"))


def op4_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return piece_bpe.digests(table(spark, sf_dir, "documents"), vocabulary(PIECE_MODEL))


def op5_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows inside every document."""
    return wu_manber.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document outside passages that an earlier one has."""
    return substring_dedup.removed(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every section of every document."""
    return token_counts.section_counts(table(spark, sf_dir, "documents"), vocabulary(BYTE_RANKS))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from two thirds of them."""
    docs = table(spark, sf_dir, "documents")
    out = language_id.predicted(docs, language_id.fit(docs))
    return out.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_html_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page."""
    return html_render.rendered(table(spark, sf_dir, "pages"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all documents."""
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the prefix trie of all rebuilt conversations."""
    return prefix_trie.nodes(table(spark, sf_dir, "conversations"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_winnowing, op2_license_scan, op3_odd_sketch, op4_piece_bpe, op5_wu_manber,
    op6_substring_dedup, op7_token_counts, op8_secret_scan, op9_language_id, op10_html_render,
    op11_exact_dedup, op12_prefix_trie, op13_lexical_search,
)}
