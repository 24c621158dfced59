import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from llm_helpers import prose

from subledger.llm import collocations


def brute(rows, threshold, longest=5, top=2000):
    """rows: (lang, text)"""
    total, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall(r"[^ \t]+", piece)
            total[lang] += len(w)
            f.update((lang, tuple(w[i:i + n])) for n in range(1, longest + 1) for i in range(len(w) - n + 1))
    found = {k: c for k, c in f.items() if len(k[1]) > 1 and c >= threshold}
    out = {}
    for (lang, p), a in found.items():
        if any(g == lang and len(q) > len(p) and c >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for (g, q), c in found.items()):
            continue
        n = total[lang]
        score, _, left, right = min((1000 * a * n // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right, n))
    return sorted(((lang, k + 1, r[2].decode(), -r[1], r[3], r[4], r[5], -r[0]) for lang, rs in out.items() for k, r in enumerate(sorted(rs)[:top])), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def pairs(docs):
    return [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]


def test_edges(edge_docs, no_docs):
    for threshold in (1, 2, 3):
        rows = [r for r in pairs(edge_docs) if r[1] is None or len(r[1]) < 20000]
        docs = edge_docs.where("text IS NULL OR length(text) < 20000")
        assert got(collocations.collocations(docs, threshold)) == brute(rows, threshold)
    assert collocations.collocations(no_docs).count() == 0


def test_pieces_case_and_languages(make_docs):
    rows = [(i, t, lang, "s") for i in range(6) for lang in ("en", None, "und", "") for t in
            ("The RED Fox, the red\tfox;the red fox", "ÄB äb. the red\rfox the  red fox", "a a a a a a", "..", "x\x0by\x0cz!p?q:r", "the red fox\x1fjumps over red fox")]
    docs = make_docs(rows)
    assert got(collocations.collocations(docs, 12)) == brute(pairs(docs), 12)
    assert got(collocations.collocations(docs, 12, top=2)) == brute(pairs(docs), 12, top=2)


def test_long_texts_are_cut_without_loss(make_docs, monkeypatch):
    monkeypatch.setattr(collocations, "RUN", 64)
    monkeypatch.setattr(collocations, "HELD", 50)
    words = prose(4, 40).split()
    text = " ".join(words[i * i % 7] for i in range(900)) + ". " + "y" * 200 + " " + " ".join(words[:5] * 30)
    seen = Counter()
    for run, _ in collocations._long(text.encode(), "en", 5):
        for n, at, _ in run.grams(run.words(3), 3, 5):
            seen.update(run.phrase(a, n) for a in at.tolist())
    want = Counter()
    for piece in text.split("."):
        w = piece.encode().split()
        want.update(b" ".join(w[i:i + n]) for n in range(1, 6) for i in range(len(w) - n + 1))
    assert seen == want
    docs = make_docs([(1, text, "en", "s"), (2, text, "en", "s")])
    counts = collocations.frequent(docs, 20)
    assert {(r["words"], r["phrase"].encode()): r["n"] for r in counts.where("words > 0").collect()} == {(len(p.split()), p): 2 * c for p, c in want.items() if 2 * c >= 20}


@pytest.mark.parametrize("seed", range(4))
def test_every_frequent_item_survives_merged_summaries(seed):
    rng = np.random.default_rng(seed)
    items = rng.zipf(1.3, 60000).astype(np.uint64) % np.uint64(5000)
    true, threshold = Counter(items.tolist()), 100
    capacity = len(items) // threshold + 1
    whole = collocations.Summary(capacity)
    for part in np.array_split(items, 60):
        whole.merge(*[x.astype(t) for x, t in zip(np.unique(part, return_counts=True), (np.uint64, np.int64))])
    left, right = collocations.Summary(capacity), collocations.Summary(capacity)
    for k, part in enumerate(np.array_split(items, 60)):
        (left, right)[k % 2].merge(*[x.astype(t) for x, t in zip(np.unique(part, return_counts=True), (np.uint64, np.int64))])
    lost = left.lost + right.lost
    left.merge(right.h, right.c)
    left.lost += right.lost
    for s in (whole, left):
        kept = set(s.at_least(threshold).tolist())
        assert len(s.h) <= capacity and s.lost < threshold and lost < threshold
        assert {x for x, c in true.items() if c >= threshold} <= kept
        assert all(c <= true[x] <= c + s.lost for x, c in zip(s.h.tolist(), s.c.tolist()))
        assert len(kept) < len(true)


def test_hot_phrase(make_docs):
    docs = make_docs([(i, "hot pair " * 30 + prose(i, 6), "en", "s") for i in range(40)])
    assert got(collocations.collocations(docs, 100)) == brute(pairs(docs), 100)


def test_filter_has_no_false_negative():
    h = np.random.default_rng(2).integers(0, 1 << 63, 5000).astype(np.uint64)
    s = collocations.Sieve(1 << 17)
    s.add(h)
    assert s.has(h).all() and s.has(h + np.uint64(1)).mean() < 0.1


def test_exact_products_beyond_64_bits(spark):
    big = 4 * 10**12
    counts = spark.createDataFrame([("en", 0, "", 9 * big), ("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big)], "lang string, words int, phrase string, n long")
    row = collocations.scored(counts).first()
    assert row["score"] == 1000 * big * 9 * big // (big * (big + 1))


def test_sql_agrees(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    rows = collocations.op13_collocations(spark, sf)
    assert got(rows) == sorted(con.execute(f"SELECT {', '.join(rows.columns)} FROM ({collocations.ORACLE})").fetchall(), key=str)
