"""Corpus cleaning in five stages: language, repeated lines, near-duplicates, benchmark items, packing.

Every stage works on all that the one before it kept. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import decontaminate, language, lines, minhash, packing
from ledgermill.sources.shared import materialise
from ledgermill.sources.shipping import ship_package

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# Share of words that must be of one known language. Texts of two languages pass, texts without letters do not.
LEAST_SHARE = 0.4

# The language stage learns a model, so no SQL can say what it keeps; every stage is tested on its own instead.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose words are of a known language, which becomes their `lang`."""
    model = language.fit(docs.select("doc_id", "text", "lang"))
    found = language.predict(docs, model, keep=("text", "source", "n_chars"))
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SHARE)).select(
        "doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take later copies of runs of lines out of the texts, and `n_chars` after them; drop texts nothing is left of."""
    left = lines.without_repeated_runs(docs.select(*COLUMNS))
    changed = F.col("lines_removed") > 0
    return left.where(~changed | (F.trim("text") != "")).select(
        "doc_id", "text", "lang", "source", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast("bigint").alias("n_chars"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group with 80 % shared five-word shingles."""
    found = minhash.near_duplicates(docs, width=5, percent=80)
    return docs.select(*COLUMNS).join(found.where("NOT kept").select("doc_id").distinct(), "doc_id", "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold benchmark items, exactly or with other parameters."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_contaminated(docs.select(*COLUMNS), benchmark)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bin and place of each piece of each document."""
    return packing.pack(docs)


STAGES = [
    ("language", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("minhash_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder before the next reads it."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
