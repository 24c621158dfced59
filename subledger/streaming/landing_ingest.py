"""Exactly-once landing of page files (Structured Streaming, availableNow)."""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession

from subledger.schemas import LANDING_PAGE


def ingest_pages(spark: SparkSession, inbox: str, landing_path: str,
                 checkpoint: str | None = None, fmt: str = "json",
                 max_files_per_trigger: int | None = None) -> int:
    """Append every not-yet-landed page file of ``inbox`` to ``landing_path``.

    The landing table is Parquet partitioned by ``source``, so a scan of one
    source reads only its partition. Progress lives in ``checkpoint`` (by
    default under the cluster's shared ``spark.checkpoint.dir``); a rerun or
    a restart after a lost executor or driver resumes from it without landing
    a file twice. Returns the number of page rows landed by this call.
    """
    if checkpoint is None:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            raise ValueError("no checkpoint given and spark.checkpoint.dir is unset")
        # one stream state per landing table: stable across runs, distinct across tables
        tag = hashlib.sha1(landing_path.rstrip("/").encode()).hexdigest()[:16]
        checkpoint = f"{base.rstrip('/')}/landing_ingest/{tag}"
    reader = spark.readStream.schema(LANDING_PAGE).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    query = (reader.load(inbox).writeStream.format("parquet")
             .option("path", landing_path).option("checkpointLocation", checkpoint)
             .partitionBy("source").outputMode("append").trigger(availableNow=True).start())
    landed: dict[int, int] = {}  # by batch: Spark keeps only the latest progress entries
    ended = False
    while not ended:
        ended = query.awaitTermination(1)
        landed.update((p["batchId"], int(p.get("numInputRows", 0))) for p in query.recentProgress)
    return sum(landed.values())
