"""SparkSession helpers: building a session, pinning SQL semantics, checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every plan in this package assumes.
_SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str = "netsift", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this package relies on.

    On a cluster ``master`` stays ``None`` so spark-submit decides; locally pass
    ``local[N]``. The Spark UI stays off: nothing here needs a web server.
    """
    b = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**_SQL_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    pin_sql_conf(spark)
    return spark


def pin_sql_conf(spark: SparkSession) -> None:
    """Session-level settings the results depend on (UTC wall clock for syslog times)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local session without the setting gets a private folder; on a cluster a
    machine-local folder would be lost with its machine, so the setting is required.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="netsift-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def shared_path(spark: SparkSession, name: str) -> str:
    """A path for a written intermediate table under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "tables", name)
