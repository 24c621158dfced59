"""SimHash near-dedup by a segment-popcount embedding.

A fingerprint maps to the bit counts (0 to 2) of its 32 two-bit segments. The
Manhattan distance of two embeddings is a lower bound of the fingerprints'
bit distance, so fingerprints at 3 bits or fewer lie within range 3 of each
other. The range join runs on a grid: the embedding's 8 blocks of 4 segments
give 56 choices of 5 blocks, and points within range 3 agree on at least 5
blocks, so each such pair shares a cell of at least one choice. Sorted runs of
a cell are checked by the Manhattan bound and then exactly; a cell emits a
spanning forest of its links, not its pairs. Alternating stars over the
forests' edges give the components.

Only distinct fingerprints enter the grid, so copies of a text cost one row,
and a cell holds 8 bytes a distinct fingerprint. Cells of more than
``BIG_CELL`` fingerprints are divided once more by four 16-bit bands, one of
which any linked pair shares.

Defined results: null and empty texts have fingerprint zero and link with one
another; ties cannot occur; repeated rows give repeated results; a null key
gets its component's smallest key, null if there is none; an empty table gives
an empty result; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subledger.llm.common import byte_rows, checkpointed, table

SHINGLE, MAX_BITS = 3, 3
BLOCKS, BIG_CELL = 8, 256
#: Shingles whose bits are counted at a time.
RUN = 1 << 15


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the text's word shingles, repeats included; 0 if it has no word."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(line, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-shingle]])
    stops = ends[shingle - 1:] - 1
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(starts), RUN):
        pairs = zip(starts[at:at + RUN].tolist(), stops[at:at + RUN].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(line[a:b], 42) for a, b in pairs], "<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row's whole text, and the string columns of ``also``."""
    def run(batches):
        for batch in batches:
            for at, raw in byte_rows(batch):
                found = np.array([fingerprint(t, shingle) for t in raw], np.uint64).view(np.int64)
                own = [batch.column(c).slice(at, len(raw)) for c in ("doc_id", *also)]
                yield pa.record_batch([own[0], pa.array(found, pa.int64()), *own[1:]], ["doc_id", "fp", *also])

    return docs.select("doc_id", "text", *also).mapInArrow(run, ", ".join(["doc_id long", "fp long", *(f"{c} string" for c in also)]))


def _embedding_tables() -> tuple[np.ndarray, np.ndarray]:
    """By byte: the code (base 3) of its four segments' bit counts; by two codes: their Manhattan distance."""
    counts = np.array([[bin(b >> s & 3).count("1") for s in (0, 2, 4, 6)] for b in range(256)])
    codes = counts @ np.array([1, 3, 9, 27])
    points = np.array([[c // 3**k % 3 for k in range(4)] for c in range(81)])
    return codes.astype(np.uint8), np.abs(points[:, None] - points[None]).sum(axis=2).astype(np.uint8)


CODES, MANHATTAN = _embedding_tables()


def embed(fps: np.ndarray) -> np.ndarray:
    """n x 8 codes: each block's four segment bit counts."""
    return CODES[np.ascontiguousarray(fps).astype("<i8").view(np.uint8).reshape(-1, 8)]


def grid(nodes: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """cell and fp: each fingerprint in the cells of all choices of ``BLOCKS - most`` blocks."""
    choices = list(combinations(range(BLOCKS), BLOCKS - most))

    def run(batches):
        for batch in batches:
            for start in range(0, len(batch), 1 << 14):
                fps = batch.column("fp").slice(start, 1 << 14).to_numpy(zero_copy_only=False)
                codes = embed(fps).astype(np.int64)
                cells = np.empty((len(choices), len(fps)), np.int64)
                for k, choice in enumerate(choices):
                    cells[k] = k
                    for block in choice:
                        cells[k] = cells[k] << 7 | codes[:, block]
                yield pa.record_batch([pa.array(cells.ravel()), pa.array(np.tile(fps, len(choices)))], ["cell", "fp"])

    return nodes.select("fp").mapInArrow(run, "cell long, fp long")


def _near(fp: np.ndarray, others: np.ndarray, most: int) -> np.ndarray:
    """Which of ``others`` are linked to ``fp`` (one, or one for each): Manhattan bound first, then bits."""
    found = MANHATTAN[embed(np.atleast_1d(fp)), embed(others)].sum(axis=1) <= most
    found[found] = np.bitwise_count((np.broadcast_to(fp, others.shape)[found] ^ others[found]).view(np.uint64)) <= most
    return found


def forest(fps: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray]]:
    """Edges (one, others) that span the linked fingerprints of one cell."""
    if len(fps) > BIG_CELL and most < 4:
        for band in range(4):
            values = (fps >> np.int64(16 * band)) & np.int64(0xFFFF)
            order = np.argsort(values, kind="stable")
            for part in np.split(fps[order], np.flatnonzero(np.diff(values[order])) + 1):
                if len(part) > 1:
                    yield from _walk(part, most)
    else:
        yield from _walk(fps, most)


def _walk(fps: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray]]:
    left = fps
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = _near(at, left, most)
            if near.any():
                found, left = left[near], left[~near]
                queue.extend(found)
                yield int(at), found


def links(cells: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """Edges a, b (a < b) that connect exactly the fingerprints linked within a cell."""
    def of_runs(cell: np.ndarray, fps: np.ndarray):
        ends = np.append(np.flatnonzero(np.diff(cell)) + 1, len(cell))
        starts = np.append(0, ends[:-1])
        size = ends - starts
        two = starts[size == 2]
        a, b = fps[two], fps[two + 1]
        near = _near(a, b, most) if len(a) else np.zeros(0, bool)
        left, right = [a[near]], [b[near]]
        for s, e in zip(starts[size > 2].tolist(), ends[size > 2].tolist(), strict=True):
            for one, others in forest(fps[s:e], most):
                left.append(np.full(len(others), one, np.int64))
                right.append(others)
        a, b = np.concatenate(left), np.concatenate(right)
        return pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []  # rows of the cell that is still open
        for batch in batches:
            cell, fps = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "fp"))
            if not len(cell):
                continue
            cut = int(np.searchsorted(cell, cell[-1]))
            if held and (cut or held[0][0][0] != cell[0]):
                closed = int(np.searchsorted(cell, held[0][0][0], "right"))
                held.append((cell[:closed], fps[:closed]))
                yield of_runs(np.concatenate([c for c, _ in held]), np.concatenate([f for _, f in held]))
                held = []
                cell, fps, cut = cell[closed:], fps[closed:], cut - closed
            if cut > 0:
                yield of_runs(cell[:cut], fps[:cut])
            held.append((cell[max(cut, 0):], fps[max(cut, 0):]))
        if held:
            yield of_runs(np.concatenate([c for c, _ in held]), np.concatenate([f for _, f in held]))

    dealt = cells.repartition("cell").sortWithinPartitions("cell", "fp")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def connect(edges: DataFrame) -> DataFrame:
    """node and root (its component's smallest node) of all nodes that edges a, b touch.

    Alternating large and small stars; each round is checkpointed and ends
    when it changes nothing.
    """
    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()

    now = checkpointed(edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).where("node <> root").distinct())
    before, after = None, state(now)
    while before != after:
        both = now.unionByName(now.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.min("root").alias("m")).select(F.col("node"), F.least("node", "m").alias("m"))
        large = both.join(least, "node").where("root > node").select(F.col("root").alias("node"), F.col("m").alias("root")).distinct()
        least = large.groupBy("node").agg(F.min("root").alias("m"))
        stars = large.join(least, "node")
        small = stars.select("node", F.col("m").alias("root")).unionByName(stars.where("root <> m").select(F.col("root").alias("node"), F.col("m").alias("root")))
        now = checkpointed(small.distinct())
        before, after = after, state(now)
    return now


def rooted_nodes(prints: DataFrame, first: Column, most: int = MAX_BITS) -> DataFrame:
    """Every distinct fp, the least ``first`` of its rows, and its component's root."""
    nodes = checkpointed(prints.groupBy("fp").agg(F.min(first).alias("first")))
    roots = connect(links(grid(nodes, most), most))
    return nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def components(prints: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable) of rows doc_id, fp."""
    rooted = rooted_nodes(prints, F.col("doc_id"), most)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(rooted.select("fp", "root").join(smallest, "root").drop("root"), "fp").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``."""
    found = components(checkpointed(fingerprints(docs, shingle)), most)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """One row of ``docs``, with all its columns, of each component: that with the smallest doc_id (rows
    without a key come last), then by hash of key and text.

    Rows are told apart by that hash, so unlike texts under one key stay. Of rows that repeat key and
    text, each task hands on one before the shuffle.
    """
    own = F.sha2(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text"), 256)  # a null text leaves out the colon
    prints = checkpointed(fingerprints(docs.select("doc_id", "text", own.alias("own")), shingle, ("own",)))
    rooted = rooted_nodes(prints, F.struct(F.col("doc_id").isNull(), "doc_id", "own"), most)
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.own").alias("_own"))
    rank = F.row_number().over(Window.partitionBy("_own").orderBy("_own"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), own.alias("_own")).withColumn("_rank", rank)
    return rows.where("_rank = 1").join(kept, "_own", "left_semi").select("_row.*")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
