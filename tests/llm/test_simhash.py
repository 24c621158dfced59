import random

import numpy as np
import pytest
import xxhash
from llm_helpers import prose

from subledger.llm import simhash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """rows: (id, fingerprint); smallest id reachable over links of 3 bits or fewer."""
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    smallest = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            smallest[find(i)] = min(smallest.get(find(i), key), key)
    return [smallest.get(find(i)) for i in range(len(rows))]


@pytest.mark.parametrize("text", [None, "", " \n", "A", "a B", "a b C", "a b c d " * 50, prose(1, 500), "é 東 " * 9, "x" * 100000, prose(2, 70000)])
def test_fingerprint(text):
    raw = None if text is None else text.encode()
    if text is None or len(text) < 10000:
        assert simhash.fingerprint(raw) == brute_fingerprint(text)
    else:
        run, simhash.RUN = simhash.RUN, 1000
        try:
            cut = simhash.fingerprint(raw)
        finally:
            simhash.RUN = run
        assert cut == simhash.fingerprint(raw) == brute_fingerprint(text)


def test_manhattan_distance_bounds_bit_distance():
    rng = np.random.default_rng(0)
    a, b = rng.integers(-2**63, 2**63 - 1, (2, 2000))
    bound = simhash.MANHATTAN[simhash.embed(a), simhash.embed(b)].sum(axis=1)
    assert (bound <= np.bitwise_count((a ^ b).view(np.uint64))).all()


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_components_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(60):  # chains of near fingerprints, copies, and pairs at exactly 3 and 4 bits
        at = int(rng.integers(0, 2**63)) * 2 + int(rng.integers(0, 2))
        for _ in range(6):
            rows.append((len(rows) * 7 % 1009, at))
            for bit in rng.choice(64, int(rng.integers(0, 6)), replace=False):
                at ^= 1 << int(bit)
    rows += [(5000, 0), (5001, 0), (5002, 7), (5003, 15 << 40), (None, rows[0][1]), (None, 12345)]
    df = spark.createDataFrame([(i, signed(f)) for i, f in rows], "doc_id long, fp long").repartition(5)
    got = sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.components(df).collect()), key=str)
    assert got == sorted(((i, f, c) for (i, f), c in zip(rows, brute_components(rows))), key=str)


def test_a_dense_cell_is_linked_whole(monkeypatch):
    rng = np.random.default_rng(5)
    center = 0x0123456789ABCDEF
    near = sorted({center ^ sum(1 << int(b) for b in rng.choice(64, 2, replace=False)) for _ in range(400)} | {center})
    far = [int(x) for x in rng.integers(0, 2**62, 300)]
    fps = np.array(sorted(map(signed, near + far)), np.int64)
    for big in (20_000, 100):
        monkeypatch.setattr(simhash, "BIG_CELL", big)
        edges = [(a, int(b)) for a, found in simhash.forest(fps, 3) for b in found]
        assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 3 for a, b in edges)
        root = {int(f): int(f) for f in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            root[find(a)] = find(b)
        assert len({find(signed(x)) for x in near}) == 1
        assert len(edges) < 5 * len(fps)  # a forest, not all pairs


def test_edges(edge_docs, no_docs, edge_rows):
    rows = simhash.near_duplicates(edge_docs).collect()
    prints = [(r[0], brute_fingerprint(r[1]) if not r[1] or len(r[1]) < 10**5 else simhash.fingerprint(r[1].encode())) for r in edge_rows]
    want = sorted(((i, f"{f:016x}", c) for (i, f), c in zip(prints, brute_components(prints))), key=str)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows), key=str) == want
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0
    kept = simhash.keep_one(edge_docs)
    ids = [r["doc_id"] for r in kept.collect()]
    firsts = {c for (i, _), c in zip(prints, brute_components(prints)) if i is not None}
    assert kept.columns == edge_docs.columns
    assert sorted(i for i in ids if i is not None) == sorted(i for i in firsts if i is not None) and ids.count(None) == 1  # the one with a text of its own


def test_one_row_of_each_component_is_kept(make_docs):
    a, b, c, e = (prose(k, 90) for k in (11, 12, 13, 14))
    rows = [(1, a), (1, b), (1, b), (2, b), (2, a), (None, a), (None, c), (None, c.upper()), (None, c), (4, e), (3, e), (None, e)]
    assert len({brute_fingerprint(t) for _, t in rows}) == 4
    got = [(r["doc_id"], r["text"].lower()) for r in simhash.keep_one(make_docs([(*r, "en", "s") for r in rows]).repartition(3)).collect()]
    assert sorted(got, key=str) == sorted([(1, a), (1, b), (3, e), (None, c)], key=str)


def test_a_key_that_repeats_is_cut_before_the_shuffle(make_docs):
    plan = simhash.keep_one(make_docs([(1, "a b c", "en", "s")] * 9))._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and plan.count("Partial") >= 1


def test_a_dense_cell_takes_little_more_than_linear_time():
    import time

    rng, spent = np.random.default_rng(3), []
    for n in (5000, 40000):
        fps = np.unique(rng.integers(0, 1 << 63, n).astype(np.int64))  # unlinked, in one cell
        began = time.process_time()
        assert sum(len(o) for _, o in simhash.forest(fps, 3)) < 50
        spent.append(time.process_time() - began)
    assert spent[1] < 30 * max(spent[0], 0.1)


@pytest.mark.parametrize("big", [2, 30, 256])
def test_divided_cells_lose_no_link(monkeypatch, big):
    monkeypatch.setattr(simhash, "BIG_CELL", big)
    rng = random.Random(big)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(25)}
    own = np.array(sorted(fps), np.uint64).view(np.int64)
    parent = {f: f for f in own.tolist()}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for one, others in simhash.forest(own, 3):
        for o in others.tolist():
            assert bin((one ^ o) & (1 << 64) - 1).count("1") <= 3
            parent[root(o)] = root(one)
    for a in own.tolist():
        for b in own.tolist():
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= 3:
                assert root(a) == root(b)
