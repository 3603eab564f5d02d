"""From raw documents to packed token sequences: five stages, each on all that the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.llm.common import stored, table, tokenizer_file
from seriesmill.llm.decontaminate import without_benchmark
from seriesmill.llm.line_dedup import without_shared_lines
from seriesmill.llm.near_dedup import without_near_duplicates
from seriesmill.llm.packing import pack_documents
from seriesmill.llm.quality import clean_documents


def sized(docs: DataFrame) -> DataFrame:
    """n_chars of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines go, and documents that fail as a whole or lose too much text."""
    return sized(clean_documents(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document has go; so do documents of which no word is left."""
    out, removed = without_shared_lines(docs)
    return sized(out.filter(F.col(f"`{removed}`").isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]")).drop(removed))


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, by shingles of five words."""
    return without_near_duplicates(docs, shingle=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item go."""
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of 2048 ids, with their ids."""
    return pack_documents(docs, tokenizer_file("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("minhash dedup", minhash_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# The sketches, the alignment and the tokenizer have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
