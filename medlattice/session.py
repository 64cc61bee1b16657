"""Session helpers: where shared scratch data goes and how tables are read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CHECKPOINT_CONF = "spark.checkpoint.dir"
_METHOD_LIMIT_CONF = "spark.sql.codegen.hugeMethodLimit"

#: the JVM never compiles a method above this many bytes, it interprets it
JIT_METHOD_BYTES = 8000


def tuned(spark: SparkSession) -> SparkSession:
    """Session settings the jobs run best with; a setting made by the user is kept.

    The rule projections are wide. Fused into one generated method they can exceed what the
    JVM compiles, which made them four times slower; with the limit set Spark splits such a
    stage into small methods instead.
    """
    if int(spark.conf.get(_METHOD_LIMIT_CONF)) == 65535:
        spark.conf.set(_METHOD_LIMIT_CONF, JIT_METHOD_BYTES)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: on a cluster every executor has
    to see the same path, so a missing setting is an error there.
    """
    root = spark.conf.get(_CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_CONF} to a folder all executors share")
    root = tempfile.mkdtemp(prefix="medlattice-")
    spark.conf.set(_CHECKPOINT_CONF, root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is ever overwritten in place."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, so a lost executor re-reads
    files instead of recomputing a long plan."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, label: str, limit: int) -> tuple[DataFrame, bool]:
    """``df`` written once, marked for broadcast when it has at most ``limit`` rows.

    The size is known before the join with the large side is planned. Left to the adaptive
    planner, the large side would already be on its way through a shuffle by the time the
    small side is measured. Beyond the limit the plain join remains.
    """
    stored = cut_lineage(df, label)
    small = stored.limit(limit + 1).count() <= limit
    return (F.broadcast(stored) if small else stored), small


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the supplied Parquet tables."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
