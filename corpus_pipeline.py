"""The corpus pipeline: from raw documents to encoded training text.

Every stage takes what its predecessor kept and returns the columns of
``documents``; the last returns the token ids. ``run`` writes each stage as
Parquet in the shared folder and reads it again for the next one, so a lost
executor repeats one stage at most.

Edge cases, for all stages: extra columns are dropped, an empty table gives
an empty one, repeated rows are judged alike (near_dedup leaves one of them).
A null or empty text has no letters and goes in the first stage; rows with a
null id are documents like others. Tables that a stage leaves in the shared
folder are removed once the next one's input is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import language_id, odd_sketch, piece_bpe, secret_scan, wu_manber
from strata.llm.common import prepare, table, tidied, written
from strata.llm.queries import PIECE_MODEL, vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A language is rejected if its posterior is below this.
LEAST_SCORE = 0.5
#: And if the text fits the language worse (``language_id``): it is of none that was learned.
LEAST_FIT = -1.0
#: SQL can't learn a classifier or encode by a model file.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (``und``: no letters) or without a likely
    one go, and so do those that fit it badly (another language, letter junk).
    The classifier is learned from the raw documents."""
    prepare(spark)
    model = language_id.fit(table(spark, sf_dir, "documents"))
    out = language_id.with_language(docs.select(*COLUMNS), model)
    return out.filter((F.col("_lang.lang_pred") != "und") & (F.col("_lang.score") >= LEAST_SCORE) & (F.col("_lang.fit") >= LEAST_FIT)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays, that with the least id,
    also where ids repeat or are null."""
    prepare(spark)
    return odd_sketch.deduplicated(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    prepare(spark)
    return wu_manber.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; every document stays."""
    prepare(spark)
    out = secret_scan.redacted(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the ids (end id last) and the text that they decode to."""
    prepare(spark)
    return piece_bpe.encoded(docs, vocabulary(PIECE_MODEL))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("secrets", mask_secrets),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with tidied(spark) as result:
        for name, stage in STAGES:
            with tidied(spark) as kept:
                docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
                kept.append(docs)
        result.append(docs)
    return docs
