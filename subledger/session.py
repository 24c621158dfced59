"""Session settings the library relies on.

On a cluster the session comes from the platform; ``configure`` only sets what
the plans depend on (UTC session zone, ANSI casts, AQE) and never overrides a
value the cluster already chose for ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every plan in this package is written against.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the record table's VARIANT is written with its leaves as Parquet columns, and read by leaf
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
}


# Shuffle sizing, applied only when the cluster did not choose: AQE starts
# from many partitions and merges them to ~128 MB each; it never splits an
# oversized one (outside skew joins), so the starting number must be high.
ADVISORY_PARTITION_BYTES = "128m"
PARTITIONS_PER_CORE = 4


# Broadcasts chosen by the planner should rest on measured sizes: when the
# cluster leaves it unset, the estimate-based threshold is turned off and AQE
# broadcasts a join side only after its shuffle output measured under 10 MB.
# (Explicit broadcasts in this package sit behind their own bounded counts.)
RUNTIME_BROADCAST_BYTES = "10MB"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    if not spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None):
        if not spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None):
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", RUNTIME_BROADCAST_BYTES)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    if not spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None):
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", ADVISORY_PARTITION_BYTES)
    if not spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None):
        try:
            cores = spark.sparkContext.defaultParallelism
        except Exception:  # remote session: leave the cluster's settings alone
            return spark
        shuffle = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                       str(max(shuffle, PARTITIONS_PER_CORE * cores)))
    return spark


def build_session(master: str | None = None, app: str = "subledger",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local/test session builder. Cluster jobs should call ``configure`` instead."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(REQUIRED_CONF)
    conf.update({
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("SUBLEDGER_DRIVER_MEMORY", "8g"),
    })
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """The shared checkpoint folder named by the cluster, else ``fallback`` (tests only)."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    if fallback:
        spark.sparkContext.setCheckpointDir(fallback)
        spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def shared_folder(spark):
    """The shared folder the cluster names; where none is named, a local session (tests) gets a folder of its own.

    On a cluster that is an error, as files in one machine's folder would go with it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("no shared folder: set spark.checkpoint.dir")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="subledger-shared-"))
    return context.getCheckpointDir()


def keep_small(df):
    """A narrow intermediate table made durable: a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def keep_written(df):
    """A narrow intermediate table written to the shared folder and read back, for tables made from one another in rounds.

    A checkpoint keeps its plan's estimated size, and an estimate over joins is a product; a written table has its files' size.
    """
    path = f"{shared_folder(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
