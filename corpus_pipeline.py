"""From raw documents to packed token sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept. All but the last return the
columns of ``documents``; the last returns a row per token piece with its place in a sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import free_name, reach_workers, table
from panelkit.llm.decontamination import decontaminated
from panelkit.llm.language import fit, held_out, recognised
from panelkit.llm.line_dedup import without_recurring_lines
from panelkit.llm.packing import packed_documents
from panelkit.llm.queries import CAPACITY, TOKENIZER
from panelkit.llm.simhash import without_near_duplicates
from panelkit.sources.tables import checkpointed


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; without letters, or with none for three tenths of them, they go."""
    reach_workers(spark)
    return recognised(docs, fit(docs.filter(~held_out())))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that recur across documents; ``n_chars`` follows the text."""
    reach_workers(spark)
    dropped = free_name(docs, "n_dropped")
    found = without_recurring_lines(docs, count=dropped)
    size = F.when(
        F.col(dropped) > 0, F.length("text")
    ).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.withColumn("n_chars", size).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    reach_workers(spark)
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences: a row per piece."""
    reach_workers(spark)
    return packed_documents(docs, TOKENIZER, CAPACITY)


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL expresses none of the stages; tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return docs
