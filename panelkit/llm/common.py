"""What the text operators share: reading tables, row identity and hashed keys."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space as the query contracts define it.
WHITE_SPACE = r"[\x20\x09-\x0D]+"


#: Rows that go to a Python worker at a time, unless the session was started with another number.
BATCH_ROWS = 2_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def reach_workers(spark: SparkSession) -> None:
    """Prepare the session for operators that work on texts in Python.

    Batches get fewer rows than Spark's default, as texts are long. Workers that start on this machine can import
    the package from where it lies; on a cluster it is installed or shipped as usual, and this changes nothing.
    """
    if not spark.sparkContext.getConf().contains(_BATCH_SETTING):
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        environment["PYTHONPATH"] = ":".join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str) -> Column:
    """A text column with NULL read as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def sampled(rows: DataFrame, most: int, id_column: str, *groups: str) -> DataFrame:
    """Ids (and groups) of at most ``most`` rows per group: those whose hashed ids are smallest.

    Counts come first. They set how small a hash has to be for four times as many rows to be expected, so that
    no task ever ranks many more, however large a group is. NULL ids are left out.
    """
    ids = rows.select(id_column, *groups).filter(F.col(id_column).isNotNull())
    ids = ids.withColumn("_hash", F.pmod(F.xxhash64(id_column), F.lit(1 << 40)))
    sizes = ids.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
    if groups:
        # A model of the groups has more than a number for each, and is broadcast too.
        ids = ids.join(F.broadcast(sizes), list(groups))
    else:
        ids = ids.withColumn("_n", F.lit(sizes.first()[0]))
    few = ids.filter(F.col("_hash").cast("double") * F.col("_n") <= 4.0 * most * (1 << 40))
    order = Window.partitionBy(*groups).orderBy("_hash", id_column)
    return few.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= most).select(id_column, *groups)


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores in front as long as the frame has a column called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
