"""Join helpers: size-checked broadcast of derived lookup tables, scalar attachment."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir, shared_path


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as parquet in the shared folder and read again: passes over it read
    only their columns, and it survives lost executors."""
    path = shared_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bytes_of(df: DataFrame) -> int:
    """Bytes of the rows of a checkpointed table: 8 a field, and the lengths of its strings."""
    strings = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    row = F.lit(8 * (len(df.columns) + 1))
    for c in strings:
        row = row + F.coalesce(F.octet_length(c), F.lit(0))
    return df.agg(F.sum(row)).first()[0] or 0


def attach_lookup(big: DataFrame, small: DataFrame, on, how: str = "left", stored: bool = False) -> DataFrame:
    """Join a derived lookup table onto ``big``.

    The lookup (an aggregate of ``big``) is checkpointed and its bytes are summed: within
    ``spark.sql.autoBroadcastJoinThreshold`` it is broadcast, so ``big`` is not shuffled at
    all. Beyond that a shuffle join is planned, whose hot keys AQE can split; the rows are
    the same either way. ``stored``: the lookup is checkpointed already.
    """
    small = small if stored else materialize(small)
    conf = small.sparkSession._jsparkSession.sessionState().conf()
    side = F.broadcast(small) if _bytes_of(small) <= conf.autoBroadcastJoinThreshold() else small
    return big.join(side, on, how)


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row (broadcast, no driver collect)."""
    return df.crossJoin(F.broadcast(one_row))
