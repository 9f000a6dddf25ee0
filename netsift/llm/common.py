"""Shared helpers of the training-data queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


# Arrow batches end at so many bytes, so that a worker's memory does not hang on the rows' length.
BATCH_BYTES = "8m"


def bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def persisted(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: cuts lineage and survives lost executors."""
    bound_batches(df.sparkSession)
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct: whatever their names, they meet no other column."""
    return F.struct(*(df[f"`{c}`"].alias(c) for c in df.columns))


def fold_of(doc_id: str, k: int) -> Column:
    """crc32 of the id as text, modulo k; a null id counts as the id text ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % k


def bucket_filter(df: DataFrame, key: str, wanted: DataFrame, wanted_key: str | None = None,
                  buckets: int = 1 << 19) -> DataFrame:
    """Rows of ``df`` whose hashed long ``key`` may be among the wanted ones, before an exact join.

    Only the distinct key remainders are broadcast: at most ``buckets`` integers, whatever
    the size of ``wanted``. No wanted row is lost; the join that follows drops the rest.
    """
    b = wanted.select(F.pmod(F.col(wanted_key or key), F.lit(buckets)).cast("long").alias("__bucket")).distinct()
    return df.join(F.broadcast(b), F.pmod(F.col(key), F.lit(buckets)).cast("long") == F.col("__bucket"), "left_semi")
