import zlib
from hashlib import sha256

import duckdb
import pytest

from subledger.llm import merkle


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def brute(docs):
    """docs: (doc_id, source, lang, n_chars, text)"""
    groups = {}
    for d in docs:
        groups.setdefault(d[2], []).append((d[0] is not None, d[0] or 0, leaf_of(d), d))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {n: tree([g[2] for g in sorted(groups[n], key=lambda g: g[:3])]) for n in names}
    roof = tree([trees[n][-1][0] for n in names])
    out = []
    for place, n in enumerate(names):
        for i, (_, _, own, d) in enumerate(sorted(groups[n], key=lambda g: g[:3])):
            forged = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 7 == 0 and d[3] is not None
            node, proof = leaf_of((*d[:3], d[3] + 1, d[4])) if forged else own, ""
            for levels, at in ((trees[n], i), (roof, place)):
                for level in levels[:-1]:
                    other = level[at ^ 1] if at ^ 1 < len(level) else None
                    proof += other or ""
                    node = h(node + (other or "")) if at % 2 == 0 else h(other + node)
                    at //= 2
            out.append((d[0], own, trees[n][-1][0], roof[-1][0], h(proof), node, node == roof[-1][0]))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def fields(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_edges(edge_docs, no_docs, bits):
    assert got(merkle.manifest(edge_docs, bits)) == brute(fields(edge_docs))
    assert merkle.manifest(no_docs, bits).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 17, 65])
def test_sizes_over_bands(make_docs, n):
    docs = make_docs([(i, f"text {i}", "en" if i % 3 else None if i % 2 else "de", "s") for i in range(n)])
    assert got(merkle.manifest(docs, 2)) == brute(fields(docs))


def test_hot_key_and_repeated_rows(make_docs):
    docs = make_docs([(5, "same", "en", "s")] * 60 + [(5, f"t{i}", "en", "s") for i in range(60)] + [(i, "x", "fr", "s") for i in range(60)])
    assert got(merkle.manifest(docs, 3)) == brute(fields(docs))


def test_many_languages(make_docs):
    docs = make_docs([(i, "x", f"l{i}é" if i % 2 else f"l{i}", "s") for i in range(70)])
    assert got(merkle.manifest(docs, 2)) == brute(fields(docs))


def test_folded_and_siblings_are_intervals():
    nodes = [(i, i + 1, merkle.digest(str(i).encode())) for i in range(5)]
    levels = merkle.folded(nodes, 5, 10)
    assert [[(lo, hi) for lo, hi, _ in level] for level in levels] == [[(i, i + 1) for i in range(5)], [(0, 2), (2, 4), (4, 5)], [(0, 4), (4, 5)], [(0, 5)]]
    assert [p[0][0] for p in merkle.siblings(levels)] == [">", "<", ">", "<", "="]
    assert all(merkle.fold_up(d, p) == levels[-1][0][2] for (_, _, d), p in zip(nodes, merkle.siblings(levels)))


def test_sql_agrees(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    rows = merkle.op12_merkle(spark, sf)
    assert got(rows) == sorted(con.execute(f"SELECT {', '.join(rows.columns)} FROM ({merkle.ORACLE})").fetchall(), key=str) == brute(fields(spark.read.parquet(f"{sf}/documents.parquet")))
