import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.llm import maxscore

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       *[T.StructField(c, T.StringType()) for c in ("key", "w", "copies", "part", "score", "rank", "q_part", "label")]])


@pytest.fixture
def vectors(spark):
    return lambda rows: spark.createDataFrame([(*r, *["clash"] * 8) for r in rows], SCHEMA)


def brute(rows, k=5, every=50):
    live = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, a) in enumerate(live):
        if q is not None and q % every == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), c is None, c or 0) for j, (c, b) in enumerate(live) if j != at)
            out += [(q, n + 1, None if none else c, -s) for n, (s, none, c) in enumerate(found[:k])]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def asked(df, **kw):
    return maxscore.top_k(df, F.col("key") % 50 == 0, **kw)


def rows_of(n, seed, width=16, sparse=0.0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, width)).astype(np.float32)
    v[rng.random(v.shape) < sparse] = 0
    return [(i, [float(x) for x in row]) for i, row in enumerate(v)]


@pytest.mark.parametrize("sparse", [0.0, 0.8, 0.97])
def test_equals_brute_force_over_many_shards(vectors, monkeypatch, sparse):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 60)
    monkeypatch.setattr(maxscore, "BLOCK_ROWS", 3)
    rows = rows_of(400, 3, sparse=sparse)
    assert got(asked(vectors(rows))) == brute(rows)


def test_edges(vectors, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 9)
    nan, inf = float("nan"), float("inf")
    rows = rows_of(30, 5, 4) + [(50, [1.0, 2.0, 0.5, -1.0])] * 4 + [(100, [1.0, 2.0, 0.5, -1.0]), (None, [1.0, 2.0, 0.5, -1.0]), (None, None), (150, None),
            (200, [nan, 1.0]), (250, [inf]), (300, [1.0, None]), (350, []), (400, [0.5]), (7, [1.0, 2.0, 0.5, -1.0, 3.0]), (450, [0.0, 0.0, 0.0, 0.0]),
            (500, [1e3, 1e3, 0.0, 0.0]), (501, [-1e3, -1e3, 0.0, 0.0])]
    assert got(asked(vectors(rows))) == brute(rows)
    assert got(asked(vectors(rows), k=100)) == brute(rows, k=100)
    assert asked(vectors([])).count() == 0
    assert got(asked(vectors([(50, [1.0])]))) == []
    assert [r["rank"] for r in asked(vectors([(50, [1.0]), (3, [1.0])])).collect()] == [1]


def test_common_vector_and_ties(vectors, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 50)
    rows = rows_of(200, 8, 8) + [(1000 + i, [0.5] * 8) for i in range(200)]
    assert got(asked(vectors(rows))) == brute(rows)


def test_scores_beyond_64_bits(spark):
    schema = "vec_id long, embedding array<double>"
    rows = [(50, [2.0**50, 1.0]), (1, [2.0**50, 1.0]), (2, [2.0**50, 2.0]), (3, [-(2.0**50), 0.0]), (4, [2.0**30, 0.0]), (5, [2.0**30, 1.0]), (6, [2.0**2, 1.0])]
    found = [tuple(r) for r in asked(spark.createDataFrame(rows, schema), k=6).orderBy("rank").collect()]
    top = (1 << 63) - 1
    # order by the nearest 64-bit score, then id
    assert [(r[2], r[3]) for r in found] == [(1, top), (2, top), (4, top), (5, top), (6, top), (3, -top - 1)]


def test_search_prunes_and_stays_exact():
    rng = np.random.default_rng(1)
    w = rng.integers(-90, 90, (300, 12))
    w[rng.random(w.shape) < 0.5] = 0
    n = len(w)
    row = {"keys": np.arange(n, dtype="<i8").tobytes(), "named": np.ones(n, np.uint8).tobytes(), "copies": np.ones(n, "<i8").tobytes(), "width": 12, "kind": "<i8", "weights": w.astype("<i8").tobytes()}
    shard = maxscore.Shard(row)
    for q in w[:40]:
        scores = w @ q
        want = sorted(zip(-scores, range(n)))[:5]
        for beat in (None, -want[-1][0], -want[0][0] + 1, 0, -50):
            found, score = shard.search(q, 5, beat, None)
            assert sorted(zip(-score, found)) == [x for x in want if beat is None or -x[0] >= beat]


def test_sql_agrees(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = con.execute(f"SELECT query_id, rank, vec_id, score FROM ({maxscore.ORACLE})").fetchall()
    assert got(maxscore.op11_maxscore(spark, sf)) == sorted(want, key=str)
