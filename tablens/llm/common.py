"""Helpers shared by the training-data operators: tables, folds, written intermediates."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, ship_package


#: Arrow batches hold at most so many bytes (one longer row is a batch of its own), not only so many rows.
BATCH_BYTES = "8m"


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches that tasks send to Python by bytes, where the session has no bound of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, BATCH_BYTES)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    ship_package(spark)
    checkpoint_dir(spark)
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(doc_id: Column | str, mod: int) -> Column:
    """crc32(doc_id as text) mod ``mod``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")), F.lit(mod))


def word_count(text: Column) -> Column:
    """The number of words ``[^\\x20\\x09-\\x0D]+`` of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Cuts lineage: ``df`` written once as Parquet below the shared checkpoint folder and reread.

    The folder is the one the session names in ``spark.checkpoint.dir``, which all executors
    share; the written rows survive the loss of any executor.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/tablens-{name}-{uuid.uuid4().hex}"
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

