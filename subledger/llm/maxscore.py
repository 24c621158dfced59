"""Exact top-k search by inner product with MaxScore over sharded postings.

A vector's components are its term weights: dimension j is a term, and the
vectors whose component j is not zero are its postings. Rows are dealt by hash
to shards of about ``SHARD_ROWS`` rows; a shard keeps, for each term, postings
and the largest and smallest weight in it. For a query these bound what a term
can add. Terms are ordered by bound: the longest run of smallest bounds whose
sum stays below the score to beat is non-essential, as a row that is in no
other posting cannot reach that score. Essential postings are traversed, then
the other terms are probed, largest bound first, for the rows that are still
competitive. Each shard returns its best rows and these are merged.

The score to beat is found first: a block of queries searches one shard, and
the k-th best score there holds in all others. Blocks of queries are dealt to
all shards, so every query meets every shard, and neither side is ever whole in
one task or in the driver.

Defined results: a vector that is null or holds a null, NaN or infinite
component takes no part; an empty vector scores 0 with every other; a shorter
vector's missing components are zero; rows with a null id are candidates (after
all others in a tie) and never queries; repeated rows are rows of their own: a
repeated query row is answered once for each copy and finds its other copies;
ties go to the smaller id; an empty table gives an empty result. Weights are
exact as 64-bit integers (larger ones become the nearest such integer) and
scores are exact at any size; one outside 64 bits is returned as the nearest
64-bit integer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subledger.llm.common import checkpointed, table

SCALE = 256
TOP = 5
SHARD_ROWS, BLOCK_ROWS = 4096, 512

ROWS = "part long, keys binary, named binary, copies binary, width int, kind string, weights binary"


def weighted(vectors: DataFrame, key: str, column: str, scale: int = SCALE) -> DataFrame:
    """key, w (floor(scale * x) of each component) and copies (equal rows) of the vectors that take part."""
    x = F.col(f"`{column}`")
    finite = F.forall(x, lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False)))  # NaN is above infinity
    weights = F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")))
    rows = vectors.where(x.isNotNull() & finite).select(F.col(f"`{key}`").cast("long").alias("key"), weights.alias("w"))
    return rows.groupBy("key", "w").agg(F.count(F.lit(1)).alias("copies"))


def _packed(rows: DataFrame, parts: int, seed: int) -> DataFrame:
    """The rows of each of ``parts`` parts (dealt by hash of the distinct rows) as one row of arrays."""
    def pack(found: pa.Table) -> pa.Table:
        keys, lists = found.column("key").combine_chunks(), found.column("w").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        width = int(sizes.max(initial=0))
        flat = lists.values.slice(lists.offsets[0].as_py(), int(sizes.sum())).to_numpy(zero_copy_only=False)
        w = np.zeros((len(sizes), width), np.int64)
        w[np.arange(width) < sizes[:, None]] = flat
        most = max(abs(int(w.min(initial=0))), abs(int(w.max(initial=0))))
        kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
        named = keys.is_valid().to_numpy(zero_copy_only=False)
        return pa.table({
            "part": pa.array([found.column("part")[0].as_py()], pa.int64()), "keys": [keys.fill_null(0).to_numpy().astype("<i8").tobytes()],
            "named": [named.astype(np.uint8).tobytes()], "copies": [found.column("copies").to_numpy().astype("<i8").tobytes()],
            "width": pa.array([width], pa.int32()), "kind": [kind], "weights": [w.astype(kind).tobytes()]})

    part = F.pmod(F.xxhash64(F.lit(seed), "key", "w"), F.lit(parts))
    return rows.withColumn("part", part).groupBy("part").applyInArrow(pack, ROWS)


class Rows:
    """The rows of one part: keys, whether a row has a key, copies, weights (rows x terms)."""

    def __init__(self, row: dict, of: str = "") -> None:
        self.keys = np.frombuffer(row[f"{of}keys"], "<i8")
        self.named = np.frombuffer(row[f"{of}named"], np.uint8).astype(bool)
        self.copies = np.frombuffer(row[f"{of}copies"], "<i8")
        self.weights = np.frombuffer(row[f"{of}weights"], row[f"{of}kind"]).astype(np.int64).reshape(len(self.keys), row[f"{of}width"])


class Shard(Rows):
    """Postings by term: the rows with a weight (None: all of them), the weights, and their extremes."""

    def __init__(self, row: dict) -> None:
        super().__init__(row)
        self.columns = np.ascontiguousarray(self.weights.T)
        self.postings = [None if c.all() else np.flatnonzero(c) for c in self.columns]
        self.top = np.array([max(0, int(c.max())) for c in self.columns], object)
        self.low = np.array([min(0, int(c.min())) for c in self.columns], object)
        self.reach = np.maximum(self.top.astype(float), -self.low.astype(float))

    def search(self, query: np.ndarray, k: int, beat: int | None, own: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the shard's best k rows that score at least ``beat``; row ``own`` takes no part."""
        terms = np.flatnonzero(query[:len(self.columns)])
        wide = float(np.abs(query[terms].astype(float)) @ self.reach[terms]) >= 2.0**62
        kind = object if wide else np.int64
        query = query.astype(kind)
        bound = np.maximum(query[terms] * self.top[terms].astype(kind), query[terms] * self.low[terms].astype(kind))
        order = np.argsort(bound, kind="stable")
        terms, bound = terms[order], bound[order]
        sums = np.cumsum(bound) if len(bound) else bound
        others = 0 if beat is None or beat <= 0 else int(np.searchsorted(sums, beat))  # bounds whose sum is below the score to beat
        score = np.zeros(len(self.keys), kind)
        met = np.full(len(self.keys), beat is None or beat <= 0)
        for t in terms[others:][::-1].tolist():
            at = self.postings[t]
            if at is None:
                score += query[t] * self.columns[t].astype(kind, copy=False)
                met[:] = True
            else:
                score[at] += query[t] * self.columns[t][at].astype(kind, copy=False)
                met[at] = True
        if own is not None:
            met[own] = False
        rest = sums[others - 1] if others else 0
        if beat is not None:
            met &= (score + rest >= beat).astype(bool)
        rows = np.flatnonzero(met)
        score = score[rows]
        for t, most in zip(terms[:others][::-1].tolist(), bound[:others][::-1], strict=True):
            rest -= most
            score = score + query[t] * self.columns[t][rows].astype(kind, copy=False)
            still = (score + rest >= beat).astype(bool)
            rows, score = rows[still], score[still]
        if len(rows) > k:
            least = np.sort(score)[-k] if wide else np.partition(score, -k)[-k]
            still = (score >= least).astype(bool)
            rows, score = rows[still], score[still]
            best = np.lexsort((self.keys[rows], ~self.named[rows], -np.unique(score, return_inverse=True)[1]))[:k]
            rows, score = rows[best], score[best]
        return rows, score


def _own(shard: Shard, key: int, query: np.ndarray) -> int | None:
    """The shard's row that is the query row itself."""
    for at in np.flatnonzero((shard.keys == key) & shard.named).tolist():
        here, width = shard.weights[at], min(len(query), shard.weights.shape[1])
        if (here[:width] == query[:width]).all() and not here[width:].any() and not query[width:].any():
            return at
    return None


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Shard, Rows]]:
    held: tuple[int, Shard] | None = None
    for batch in batches:
        for i in range(len(batch)):
            row = batch.slice(i, 1).to_pylist()[0]
            if held is None or held[0] != row["part"]:
                held = (row["part"], Shard(row))
            yield row, held[1], Rows(row, "q_")


def top_k(vectors: DataFrame, queries: Column, k: int = TOP, key: str = "vec_id", column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row of ``vectors`` for which ``queries`` (over the id, named key) holds."""
    rows = checkpointed(weighted(vectors, key, column, scale))
    asking = rows.where(queries & F.col("key").isNotNull())
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(queries & F.col("key").isNotNull(), 1)).alias("q")).first()
    shards, blocks = max(1, -(-sizes["n"] // SHARD_ROWS)), max(1, -(-sizes["q"] // BLOCK_ROWS))
    shard = _packed(rows, shards, 1)
    block = _packed(asking, blocks, 2).select(*[F.col(c).alias(f"q_{c}") for c in ("part", "keys", "named", "copies", "width", "kind", "weights")])

    def to_beat(batches):
        for row, at, asked in _pairs(batches):
            floors, known = np.zeros(len(asked.keys), "<i8"), np.zeros(len(asked.keys), np.uint8)
            for i, query in enumerate(asked.weights):
                found, score = at.search(query, k, None, _own(at, asked.keys[i], query))
                if len(found) == k and abs(least := int(min(score))) < 1 << 63:
                    floors[i], known[i] = least, 1
            yield pa.record_batch({f"q_{c}": [row[f"q_{c}"]] for c in ("part", "keys", "named", "copies", "width", "kind", "weights")}
                                  | {"floors": [floors.tobytes()], "known": [known.tobytes()]}, schema=beaten)

    fields = [("q_part", pa.int64()), ("q_keys", pa.binary()), ("q_named", pa.binary()), ("q_copies", pa.binary()), ("q_width", pa.int32()), ("q_kind", pa.string()), ("q_weights", pa.binary())]
    beaten = pa.schema([*fields, ("floors", pa.binary()), ("known", pa.binary())])
    first = block.withColumn("part", F.pmod(F.col("q_part"), F.lit(shards))).join(shard, "part")
    asked_for = first.mapInArrow(to_beat, ", ".join(f"q_{c}" for c in ROWS.split(", ")) + ", floors binary, known binary")

    def search(batches):
        for row, at, asked in _pairs(batches):
            floors, known = np.frombuffer(row["floors"], "<i8"), np.frombuffer(row["known"], np.uint8)
            out: list[tuple] = []
            for i, query in enumerate(asked.weights):
                own = _own(at, asked.keys[i], query)
                beat = int(floors[i]) if known[i] else None
                found, score = at.search(query, k, beat, own if own is not None and at.copies[own] == 1 else None)
                for r, s in zip(found.tolist(), score.tolist(), strict=True):
                    copies = int(at.copies[r]) - (r == own)
                    out.append((row["q_part"], i, int(asked.keys[i]), int(asked.copies[i]), int(at.keys[r]) if at.named[r] else None, min(copies, k),
                                max(-(1 << 63), min((1 << 63) - 1, s))))
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 7, names)

    names = ["block", "place", "query_id", "asked", "vec_id", "copies", "score"]
    met = asked_for.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))).join(shard, "part")
    found = met.mapInArrow(search, ", ".join(f"{c} long" for c in names))
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    rank = F.row_number().over(Window.partitionBy("block", "place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    best = each.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.withColumn("_asked", F.explode(F.sequence(F.lit(1).cast("long"), F.col("asked")))).select("query_id", "rank", "vec_id", "score")


def op11_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("key") % 50 == 0)


ORACLE = """
WITH rows_ AS (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
pairs AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum([q.w[j] * c.w[j] FOR j IN range(1, 1 + least(len(q.w), len(c.w)))]), 0) AS BIGINT) AS score
  FROM rows_ q JOIN rows_ c ON q.r <> c.r
  WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
