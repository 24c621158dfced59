"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Keys hash to one of ``CELLS`` cells of the ring; a cell of more than a
thousandth of a shard's share is cut into pieces of about that size, by a hash
of the row, so that no sort holds a hot key whole. The bytes of the pieces, at
most ``CELLS + shards * PIECES`` numbers however large the table is, are placed
on the driver: large pieces first, each goes to the shard of the first virtual
node clockwise whose shard has room for it below (1 + epsilon) times the mean
load. A full shard's keys thus continue clockwise, and a new shard takes little
besides what it needs.

Defined results: a null text has size 1 and the checksum of empty text; a null
key is replaced by that checksum; repeated rows are rows of their own, and a
key with very many rows is spread over pieces; an empty table gives an empty
result; only doc_id and text are read.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subledger.llm.common import checkpointed, table

CELL_BITS = 16
CELLS = 1 << CELL_BITS
PIECES = 1024
VNODES = 256
EPSILON = 0.005


def _point(what: str) -> int:
    return int.from_bytes(hashlib.blake2b(what.encode(), digest_size=8).digest(), "big")


def place(pieces: list[tuple[int, int, int]], shards: int, vnodes: int = VNODES, epsilon: float = EPSILON) -> list[int]:
    """The shard of each piece (cell, number in the cell, bytes)."""
    ring = sorted((_point(f"{s}/{v}"), s) for s in range(shards) for v in range(vnodes))
    points = [p for p, _ in ring]
    total = sum(size for _, _, size in pieces)
    most = total * (1 + epsilon) / shards
    load = [0] * shards
    out = [0] * len(pieces)
    order = sorted(range(len(pieces)), key=lambda i: (-pieces[i][2], _point(f"{pieces[i][0]}:{pieces[i][1]}")))
    for i in order:
        cell, _, size = pieces[i]
        at = bisect.bisect_left(points, cell << (64 - CELL_BITS))
        tried: set[int] = set()
        while len(tried) < shards:
            shard = ring[at % len(ring)][1]
            if shard not in tried and load[shard] + size <= most:
                break
            tried.add(shard)
            at += 1
        else:  # it fits nowhere: the emptiest shard
            shard = min(range(shards), key=lambda s: (load[s], s))
        load[shard] += size
        out[i] = shard
    return out


def shard_rows(df: DataFrame, shards: int, vnodes: int = VNODES, epsilon: float = EPSILON) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in a shard) of every row.

    Narrow rows are checkpointed once, with a salt that gives each row its piece and its
    place in it whenever they are computed; one shuffle ranks them by piece.
    """
    crc = F.coalesce(F.crc32("text"), F.lit(0).cast("long"))
    narrow = df.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"), crc.alias("text_crc32"),
        F.xxhash64(F.coalesce(F.col("doc_id"), crc)).alias("_hash"), F.monotonically_increasing_id().alias("_salt"))
    narrow = checkpointed(narrow.withColumn("_cell", F.shiftrightunsigned("_hash", 64 - CELL_BITS).cast("int")))
    total = narrow.agg(F.sum("size")).first()[0] or 0
    limit = max(1, total // (shards * PIECES))
    large = narrow.groupBy("_cell").agg(F.ceil(F.sum("size") / limit).alias("_pieces")).where("_pieces > 1")
    cut = narrow.join(F.broadcast(large), "_cell", "left")  # at most CELLS rows
    cut = cut.withColumn("_piece", F.pmod(F.xxhash64("_salt"), F.coalesce("_pieces", F.lit(1))))
    sizes = cut.groupBy("_cell", "_piece").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    found = sizes.toPandas().sort_values(["_cell", "_piece"], ignore_index=True)
    found["shard"] = place(list(zip(found["_cell"].tolist(), found["_piece"].tolist(), found["bytes"].tolist(), strict=True)), shards, vnodes, epsilon)
    found["base"] = found.groupby("shard")["rows"].cumsum() - found["rows"]
    spark = df.sparkSession
    where = spark.createDataFrame(
        found[["_cell", "_piece", "shard", "base"]] if len(found) else [],
        "_cell int, _piece long, shard int, base long")
    rank = F.row_number().over(Window.partitionBy("_cell", "_piece").orderBy("_hash", "doc_id", "text_crc32", "size", "_salt"))
    placed = cut.withColumn("_rank", rank - 1).join(F.broadcast(where), ["_cell", "_piece"])  # at most CELLS + shards * PIECES rows
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("_rank")).alias("slot"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The law is ``bytes``: bounded loads keep the shards' bytes near equal."""
    rows = shard_rows(table(spark, sf_dir, "documents"), shards=8)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
