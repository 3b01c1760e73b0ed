"""Exact deduplication by content hash, with a byte comparison inside the groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import WHITE_SPACE, text_or_empty
from panelkit.sources.tables import checkpointed


def exact_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", hashed=F.md5) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal if they are identical after each run of ASCII white space became one space;
    of equal texts the row with the smallest id stays. Rows are grouped by a 128-bit hash of the
    text (``hashed``, another one only in tests) *and* the text, which compares bytes inside the groups; each
    task sends one row per distinct text, so a text held by a third of all rows costs one row per task.
    A hash that stands for several texts (a collision) makes one class per text, and rows find theirs by
    the SHA-256 that is returned anyway. Only classes of more than one row are kept and joined back.

    NULL text is the empty text. NULL ids never stay where a group has another id; a group with
    NULL ids only has ``keep_id`` NULL and keeps its rows. Rows repeated with the same id and text share
    their decision. An empty table gives no rows. Other columns are not looked at.
    """
    normal = F.regexp_replace(text_or_empty(text_column), WHITE_SPACE, " ")
    texts = df.select(F.col(id_column).alias("_id"), normal.alias("_text"))
    rows = checkpointed(
        texts.select("_id", F.unhex(hashed("_text")).alias("_hash"), F.unhex(F.sha2("_text", 256)).alias("_sha"))
    )
    classes = checkpointed(
        texts.groupBy(F.unhex(hashed("_text")).alias("_hash"), "_text")
        .agg(F.count(F.lit(1)).alias("_size"), F.min("_id").alias("_first"))
        .filter("_size > 1")
        .withColumn("_sha", F.unhex(F.sha2("_text", 256)))
        .drop("_text")
    )
    decided = rows.join(classes, ["_hash", "_sha"], "left")
    return decided.select(
        F.col("_id").alias(id_column),
        F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_first")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("_first"), F.col("_id")).eqNullSafe(F.col("_id")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )
