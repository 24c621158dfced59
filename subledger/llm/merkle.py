"""Merkle manifest of a dataset, with nested-interval labels.

A leaf is the SHA-256 of a document's fields; its label is the interval
[rank, rank + 1) of its rank in its tree (one tree a language, ordered by
doc_id). An inner node's interval is the union of its two children's (one, at
the end of a level), so ancestors are the nodes whose intervals contain the
leaf's, and a node's sibling is what its parent's interval has besides its own.

Levels are taken in bands of ``BITS``. A node of a band's top level covers one
bucket of 2**BITS nodes of the band below: buckets are folded as groups of at
most 2**BITS rows, upward until every tree is one node. Downward, a
containment join by bucket attaches to each node the covering node of the band
above, with that one's siblings up to the root; inside a bucket, siblings are
found as interval differences. The languages' tops are leaves of one more tree.

Defined results: rows with equal doc_id (or none, which come first) follow one
another by leaf digest; repeated rows are leaves of their own; a null language
is a tree of its own; a tree of one leaf has that leaf as its top; an empty
table gives an empty result; a null doc_id is never tampered with; only the
five fields are read, whatever other columns are called.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm.common import checkpointed, table
from subledger.operators.ordinals import with_ordinals

BITS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

LEFT, RIGHT, NONE = "<", ">", "="


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[_field(f) for f in fields]), 256)


def digest(*parts: bytes) -> bytes:
    return sha256(b"".join(parts)).hexdigest().encode()


def folded(nodes: list[tuple[int, int, bytes]], n: int, bits: int) -> list[list[tuple[int, int, bytes]]]:
    """Levels of (lo, hi, digest) from one bucket's nodes up to its top, or to the root of a tree of n leaves."""
    levels = [nodes]
    while len(levels) <= bits and (nodes[0][0], nodes[0][1]) != (0, n):
        nodes = [(pair[0][0], pair[-1][1], digest(*[d for _, _, d in pair])) for pair in (nodes[i:i + 2] for i in range(0, len(nodes), 2))]
        levels.append(nodes)
    return levels


def siblings(levels: list[list[tuple[int, int, bytes]]]) -> list[list[str]]:
    """For each node of the lowest level: side and digest of its and its ancestors' siblings, below the top level."""
    by_lo = [{lo: (hi, d.decode()) for lo, hi, d in level} for level in levels[:-1]]
    paths: list[list[str]] = [[] for _ in levels[0]]
    for below, parents in zip(by_lo, levels[1:], strict=True):
        at = 0
        for p_lo, p_hi, _ in parents:
            first_hi = below[p_lo][0]
            while at < len(levels[0]) and levels[0][at][0] < p_hi:  # leaves that the parent's interval contains
                if levels[0][at][0] < first_hi:  # in the first child: the sibling covers [first_hi, p_hi)
                    paths[at].append(RIGHT + below[first_hi][1] if first_hi < p_hi else NONE)
                else:  # in the second: the sibling covers [p_lo, first_hi)
                    paths[at].append(LEFT + below[p_lo][1])
                at += 1
    return paths


def fold_up(node: bytes, path: list[str]) -> bytes:
    """The root that a node and its siblings' path give."""
    for step in path:
        other = step[1:].encode()
        node = digest(other, node) if step[0] == LEFT else digest(node, other)
    return node


NODE = "tree string, lo long, hi long, digest string, n long"


def _bucket_nodes(found: pa.Table) -> tuple[pa.Table, list[tuple[int, int, bytes]], int]:
    found = found.sort_by("lo")
    return found, list(zip(found["lo"].to_pylist(), found["hi"].to_pylist(), [d.encode() for d in found["digest"].to_pylist()], strict=True)), found["n"][0].as_py()


def climb(nodes: DataFrame, most: int, bits: int) -> list[DataFrame]:
    """The bands' nodes (tree, lo, hi, digest, n) from the leaves to one node a tree. ``most``: leaves of the largest tree."""
    def tops(found: pa.Table) -> pa.Table:
        found, held, n = _bucket_nodes(found)
        (lo, hi, top), = folded(held, n, bits)[-1]
        return pa.table({"tree": [found["tree"][0].as_py()], "lo": pa.array([lo], pa.int64()), "hi": pa.array([hi], pa.int64()),
                         "digest": [top.decode()], "n": pa.array([n], pa.int64())})

    bands = [nodes]
    while len(bands) == 1 or most > 1 << (bits * (len(bands) - 1)):
        bucket = F.shiftright("lo", bits * len(bands))
        below = bands[-1].select("tree", "lo", "hi", "digest", "n", bucket.alias("bucket"))
        bands.append(checkpointed(below.groupBy("tree", "bucket").applyInArrow(tops, NODE)))
    return bands


def descend(bands: list[DataFrame], over: DataFrame, bits: int, finish, schema: str) -> DataFrame:
    """``finish`` over the buckets of the leaves; each row has its bucket top's ``above`` (siblings from there upward), subroot and root.

    ``over``: the same for the highest band (tree, lo, hi, above, subroot, root).
    """
    def paths(found: pa.Table) -> pa.Table:
        found, held, n = _bucket_nodes(found)
        above = found["above"][0].as_py()
        return found.select(["tree", "lo", "hi", "subroot", "root"]).append_column(
            "above", pa.array([own + above for own in siblings(folded(held, n, bits))], pa.list_(pa.string())))

    for k in range(len(bands) - 2, -1, -1):
        bucket = F.shiftright("lo", bits * (k + 1))
        cover = over.select(F.col("tree").alias("_tree"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), bucket.alias("_bucket"), "above", "subroot", "root")
        inside = (F.col("tree") == F.col("_tree")) & (F.col("bucket") == F.col("_bucket")) & (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi"))
        within = bands[k].withColumn("bucket", bucket).join(cover, inside).drop("_tree", "_lo", "_hi", "_bucket").groupBy("tree", "bucket")
        over = within.applyInArrow(finish, schema) if k == 0 else within.applyInArrow(paths, "tree string, lo long, hi long, subroot string, root string, above array<string>")
    return over


def _roof_paths(bits: int):
    def finish(found: pa.Table) -> pa.Table:
        found, held, n = _bucket_nodes(found)
        above = found["above"][0].as_py()
        return found.select(["lo", "root"]).append_column("above", pa.array([own + above for own in siblings(folded(held, n, bits))], pa.list_(pa.string())))

    return finish


def _tree(lang: Column) -> Column:
    """A tree's name: sorts as the language does, null first."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit(""))


def _leaves(docs: DataFrame) -> DataFrame:
    """doc_id, tree, leaf and forged (the leaf after tampering, null where that changes nothing), in the trees' order with rank and n."""
    fields = {f: F.col(f) for f in FIELDS}
    changed = [fields[f] + 1 if f == "n_chars" else fields[f] for f in FIELDS]
    struck = F.crc32(fields["doc_id"].cast("string")) % 7 == 0
    leaves = checkpointed(docs.select(
        "doc_id", _tree(F.col("lang")).alias("tree"), leaf_digest([fields[f] for f in FIELDS]).alias("digest"),
        F.when(struck & fields["n_chars"].isNotNull(), leaf_digest(changed)).alias("forged"), F.monotonically_increasing_id().alias("_salt")))
    ranked = with_ordinals(leaves, ["tree"], [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("_salt")], "lo", checkpointed).drop("_salt")
    sizes = leaves.groupBy(F.col("tree").alias("_tree")).agg(F.count(F.lit(1)).alias("n"))
    return ranked.withColumn("hi", F.col("lo") + 1).join(sizes, F.col("tree") == F.col("_tree")).drop("_tree")


def manifest(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row of ``docs``."""
    leaves = checkpointed(_leaves(docs))
    bands = climb(leaves, leaves.agg(F.max("n")).first()[0] or 1, bits)
    crowns = bands[-1]  # one row a tree
    trees = checkpointed(with_ordinals(crowns.select(F.col("tree").alias("of"), "digest"), [], [F.col("of")], "lo", checkpointed))
    count = trees.count()
    trees = trees.select(F.lit("").alias("tree"), "lo", (F.col("lo") + 1).alias("hi"), "digest", F.lit(count).cast("long").alias("n"), "of")
    roof = climb(trees, count, bits)
    nothing = F.array().cast("array<string>").alias("above")
    roof[0] = roof[0].drop("of")
    proofs = descend(roof, roof[-1].select("tree", "lo", "hi", nothing, F.col("digest").alias("subroot"), F.col("digest").alias("root")), bits,
                     _roof_paths(bits), "lo long, root string, above array<string>")
    proofs = trees.select(F.col("of").alias("_of"), F.col("lo").alias("_at")).join(proofs, F.col("_at") == F.col("lo")).select("_of", "root", "above")
    over = crowns.join(proofs, F.col("tree") == F.col("_of")).select("tree", "lo", "hi", "above", F.col("digest").alias("subroot"), "root")

    def prove(found: pa.Table) -> pa.Table:
        found, held, n = _bucket_nodes(found)
        above, root = found["above"][0].as_py(), found["root"][0].as_py()
        paths = [own + above for own in siblings(folded(held, n, bits))]
        starts = [f or d for f, d in zip(found["forged"].to_pylist(), found["digest"].to_pylist(), strict=True)]
        ends = [fold_up(s.encode(), p).decode() for s, p in zip(starts, paths, strict=True)]
        return pa.table({
            "doc_id": found["doc_id"], "leaf": found["digest"], "subroot": found["subroot"], "root": found["root"],
            "proof_sha256": pa.array([sha256("".join(s[1:] for s in p).encode()).hexdigest() for p in paths], pa.string()),
            "folded_root": pa.array(ends, pa.string()), "verified": pa.array([e == root for e in ends], pa.bool_())})

    return descend(bands, checkpointed(over), bits, prove, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


#: The same tree, level by level, for DuckDB (which has no crc32: bits are folded one by one).
ORACLE = """
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, n_chars,
         concat(CASE WHEN doc_id IS NULL THEN '-' ELSE concat(strlen(CAST(doc_id AS VARCHAR)), ':', doc_id) END,
                CASE WHEN source IS NULL THEN '-' ELSE concat(strlen(source), ':', source) END,
                CASE WHEN lang IS NULL THEN '-' ELSE concat(strlen(lang), ':', lang) END) AS head,
         CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':', text) END AS tail,
         list_reduce(list_prepend(4294967295, flatten([[CAST(ascii(ch) AS BIGINT), 0, 0, 0, 0, 0, 0, 0] FOR ch IN str_split(CAST(doc_id AS VARCHAR), '')])),
                     lambda c, x: xor(xor(c, x) >> 1, (xor(c, x) & 1) * 3988292384)) AS crc
  FROM documents),
leaf AS (
  SELECT *, sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE concat(strlen(CAST(n_chars AS VARCHAR)), ':', n_chars) END || tail) AS h,
         CASE WHEN xor(crc, 4294967295) % 7 = 0 AND n_chars IS NOT NULL THEN sha256(head || concat(strlen(CAST(n_chars + 1 AS VARCHAR)), ':', n_chars + 1) || tail) END AS forged
  FROM docs),
ranked AS (SELECT doc_id, tree, h, coalesce(forged, h) AS start, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM leaf),
nodes(tree, level, i, h, n) AS (
  SELECT tree, 0, i, h, count(*) OVER (PARTITION BY tree) FROM ranked
  UNION ALL
  SELECT tree, any_value(level) + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY tree, i // 2),
subroots AS (SELECT tree, h AS subroot, level AS height, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
roof(level, i, h, n) AS (
  SELECT 0, i, subroot, n FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2
  FROM roof WHERE n > 1 GROUP BY i // 2),
every AS (
  SELECT tree, level, i, h FROM nodes WHERE n > 1
  UNION ALL
  SELECT s.tree, s.height + r.level, r.i, r.h FROM subroots s CROSS JOIN roof r),
walk AS (
  SELECT r.tree, r.i AS leaf_i, l.level, CASE WHEN l.level < s.height THEN r.i >> l.level ELSE s.i >> (l.level - s.height) END AS at
  FROM ranked r JOIN subroots s USING (tree), (SELECT CAST(range AS INTEGER) AS level FROM range(64)) l
  WHERE l.level < s.height + (SELECT max(level) FROM roof)),
path AS (
  SELECT w.tree, w.leaf_i, w.level, w.at % 2 AS side, e.h
  FROM walk w JOIN every e ON e.tree = w.tree AND e.level = w.level AND e.i = xor(w.at, 1)),
steps AS (SELECT w.tree, w.leaf_i, w.level, p.side, p.h FROM walk w LEFT JOIN path p USING (tree, leaf_i, level)),
proof AS (SELECT tree, leaf_i, sha256(string_agg(h, '' ORDER BY level)) AS proof_sha256 FROM path GROUP BY ALL),
up(tree, leaf_i, level, h) AS (
  SELECT tree, i, 0, start FROM ranked
  UNION ALL
  SELECT u.tree, u.leaf_i, u.level + 1, sha256(CASE WHEN s.h IS NULL THEN u.h WHEN s.side = 1 THEN s.h || u.h ELSE u.h || s.h END)
  FROM up u JOIN steps s ON s.tree = u.tree AND s.leaf_i = u.leaf_i AND s.level = u.level),
top AS (SELECT tree, leaf_i, arg_max(h, level) AS folded_root FROM up GROUP BY ALL)
SELECT r.doc_id, r.h AS leaf, s.subroot, (SELECT h FROM roof WHERE n = 1) AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
       t.folded_root, t.folded_root = (SELECT h FROM roof WHERE n = 1) AS verified
FROM ranked r JOIN subroots s USING (tree) JOIN top t ON t.tree = r.tree AND t.leaf_i = r.i LEFT JOIN proof p ON p.tree = r.tree AND p.leaf_i = r.i
"""
