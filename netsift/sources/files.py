"""CSV and parquet sources / sinks, and stage materialisation.

Stages are parquet (types survive, unlike CSV re-inference). Writes go to paths the
caller names — on a cluster, a shared file system; ``write_stage`` defaults to the
shared checkpoint folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schema import CSV_SESSION_SCHEMA
from ..session import shared_path


def read_sessions_csv(spark: SparkSession, path: str, schema: T.StructType | None = CSV_SESSION_SCHEMA,
                      infer: bool = False) -> DataFrame:
    """CSV with a header. Explicit schema by default; inference only when asked."""
    r = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if infer or schema is None:
        return r.option("inferSchema", True).csv(path)
    return r.schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> str:
    """CSV with header. ``single_file`` is for small, bounded outputs (e.g. a top-N review list)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)
    return path


def write_stage(df: DataFrame, name: str, path: str | None = None, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> str:
    """Materialise a stage as parquet (cuts lineage; survives executor loss)."""
    spark = df.sparkSession
    target = path or shared_path(spark, name)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(target)
    return target


def read_stage(spark: SparkSession, name: str, path: str | None = None, schema=None) -> DataFrame:
    """``schema`` is needed where a partitioned stage may have no row, and so no file."""
    r = spark.read if schema is None else spark.read.schema(schema)
    return r.parquet(path or shared_path(spark, name))
