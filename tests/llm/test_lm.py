import math
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_helpers import prose
from pyspark.sql import functions as F

from subledger.llm import lm
from subledger.llm.elias_fano import EliasFano, encode


@pytest.mark.parametrize("n,universe", [(0, 5), (1, 1), (1, 2**63), (5, 10), (1000, 1000), (3000, 2**64), (20000, 10**7)])
def test_elias_fano(n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(np.unique(rng.integers(0, universe, n, dtype=np.uint64, endpoint=False))) if n else np.zeros(0, np.uint64)
    ef = EliasFano(encode(values, universe))
    assert (ef.access(np.arange(len(values))) == values).all() if n else True
    asked = np.concatenate([values, rng.integers(0, universe, 500, dtype=np.uint64), values + np.uint64(1)])
    place, equal = ef.find(asked)
    want = np.searchsorted(values, asked)
    there = want < len(values)
    there[there] = values[want[there]] == asked[there]
    assert (equal == there).all() and (place[equal] == want[equal]).all()


def test_elias_fano_keeps_repeats():
    values = np.sort(np.random.default_rng(0).integers(0, 50, 500)).astype(np.uint64)
    assert (EliasFano(encode(values, 50)).access(np.arange(500)) == values).all()


def test_parts_round_trip():
    contexts = np.array([0, 0, 5, 2**50, 2**62], np.uint64)
    words, counts = np.array([1, 300, 0, 70000, 2]), np.array([1, 1, 900, 1, 2**33])
    for got, want in zip(lm.unpack(lm.pack(contexts, words, counts)), (contexts, words, counts)):
        assert (got == want.astype(np.uint64)).all()


def brute(train, texts):
    tok = lambda t: (t or "").encode().lower().split() + [b""]
    grams = {k: Counter() for k in (1, 2, 3)}
    for t in train:
        for k in grams:
            grams[k].update(zip(*(tok(t)[j:] for j in range(k))))
    seen, kinds = Counter(), Counter()
    for k in (2, 3):
        for g, n in grams[k].items():
            seen[g[:-1]] += n
            kinds[g[:-1]] += 1
    total, distinct = sum(grams[1].values()), len(grams[1])
    for t in texts:
        words, base, score = tok(t), 0.0, 0.0
        for j, w in enumerate(words):
            p = (grams[1][(w,)] + 1) / (total + distinct + 1)
            base += math.log10(p)
            for k in (2, 3):
                c = tuple(words[j - k + 1:j]) if j >= k - 1 else ()
                if c and seen[c]:
                    p = (grams[k][(*c, w)] + kinds[c] * p) / (seen[c] + kinds[c])
            score += math.log10(p)
        yield len(words), sum(grams[1][(w,)] > 0 for w in words), total, base, score


@pytest.mark.parametrize("shard,run", [(1 << 21, 1 << 20), (500, 64)])
def test_scores_equal_brute_force(make_docs, edge_rows, monkeypatch, shard, run):
    monkeypatch.setattr(lm, "RUN", run)  # tasks of local mode run elsewhere: the module's default holds there
    rows = [*edge_rows, *((100 + k, prose(k % 9, 30 + k), "en", "s") for k in range(60))]
    docs = make_docs(rows)
    train = docs.where(~lm.held_out(F.col("doc_id")))
    trie = lm.build(train, shard=shard)
    assert trie.shards > 1 or shard > 500
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    want = list(brute([r[1] for r in rows if not held(r[0])], [r[1] for r in rows]))
    got = lm.score(docs, trie).collect()
    assert len(got) == len(rows)
    for r, w in zip(got, want):
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:3]
        assert math.isclose(r["base_score"], w[3], rel_tol=1e-9)
        assert abs(r["score"] - w[4]) < 0.02 * r["n_tokens"] + 1e-6  # one byte a probability


def test_runs_cut_inside_a_text_count_every_ngram_once(spark, monkeypatch):
    from subledger.llm.lm import _count_ngrams  # noqa: F401
    trie = lm.Trie("", 10, 100, 0, [0], 3)
    ids = np.arange(50) * 7 % 31

    class Same:
        def __init__(self, _):
            pass

        def read(self, texts):
            return np.array([len(ids)]), ids, ids

    monkeypatch.setattr(lm, "Reader", Same)
    monkeypatch.setattr(lm, "RUN", 11)
    import pyarrow as pa

    class Frame:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return list(run([pa.record_batch([pa.array(["x"])], ["text"])]))

    found = {2: Counter(), 3: Counter()}
    for batch in _count_ngrams(Frame(), trie, 3):
        for row in batch.to_pylist():
            for c, w, n in zip(*lm.unpack(row["part"])) if row["part"] else ():
                found[row["level"]][int(c), int(w)] += int(n)
    assert found[2] == Counter((int(a), int(b)) for a, b in zip(ids, ids[1:]))
    assert found[3] == Counter((int(a) * 100 + int(b), int(c)) for a, b, c in zip(ids, ids[1:], ids[2:]))


def test_nothing_learned(edge_docs, no_docs):
    trie = lm.build(no_docs)
    rows = lm.score(edge_docs, trie).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 and r["score"] == 0 for r in rows)
    assert lm.score(no_docs, trie).count() == 0


def test_words_are_hashed_in_slices_as_whole(monkeypatch):
    from subledger.llm import common

    texts = [None, b"", b" \t\n", b"One two\x0bTHREE\x1c one", "Über ñandú 東京".encode(), b"x" * 5000, prose(3, 400).encode(), b"end "]
    whole = lm.token_hashes(texts)
    assert whole[0].tolist() == [len((t or b"").split()) + 1 for t in texts]
    words = [w for t in texts for w in [*(t or b"").lower().split(), None]]
    assert len(set(whole[1].tolist())) == len(set(words)) and len({*zip(words, whole[1].tolist())}) == len(set(words))
    monkeypatch.setattr(common, "HASHED", 64)
    assert (lm.token_hashes(texts)[1] == whole[1]).all()


def test_parts_are_added_up_as_they_come():
    rng, want = np.random.default_rng(6), Counter()
    parts = []
    for _ in range(30):
        grams = Counter(zip(rng.integers(0, 5, 200).tolist(), rng.integers(0, 400, 200).tolist()))  # hot contexts
        want.update(grams)
        rows = sorted(grams.items())
        parts.append(lm.pack(np.array([c for (c, _), _ in rows], np.uint64), np.array([w for (_, w), _ in rows]), np.array([n for _, n in rows])))
    contexts, words, counts = lm.merge(iter(parts), 8, held=300)
    mixed = {int(m): c for c, m in enumerate(lm._mixed(np.arange(5, dtype=np.uint64), 8))}
    assert Counter({(mixed[int(c)], int(w)): int(n) for c, w, n in zip(contexts, words, counts)}) == want
    assert sorted(zip(contexts.tolist(), words.tolist())) == list(zip(contexts.tolist(), words.tolist()))


def test_no_cap_on_the_vocabulary():
    big = lm.Trie("", 10, 4 * 10**9, 0, [0], 3)
    ids = np.arange(10**5, dtype=np.int64) * 39999
    keys = big.joined(3, big.joined(3, np.zeros(len(ids), np.uint64), ids), ids[::-1])
    assert len(np.unique(keys)) == len(ids) and int(keys.max()) < 1 << big.key_bits(3) == 1 << 63
    assert len(np.unique(lm._mixed(keys, big.key_bits(3)))) == len(ids)


def test_order_and_numbers_of_any_values():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 5, 3000):
        for top in (0, 1, 1000, 1 << 50, (1 << 64) - 1):
            values = rng.integers(0, top, n, dtype=np.uint64, endpoint=True)
            order = lm.order_of(values)
            assert sorted(order.tolist()) == list(range(n)) and values[order].tolist() == sorted(values.tolist())
            for got, want in zip(lm.numbered(values), np.unique(values, return_inverse=True), strict=True):
                assert got.tolist() == want.tolist()
    close = np.array([(1 << 63) + 5, (1 << 63) + 4, (1 << 63) + 5, 3], np.uint64)  # they differ in dropped bits alone
    assert lm.order_of(close).tolist() == [3, 1, 0, 2]


def test_low_parts_of_any_width():
    rng = np.random.default_rng(6)
    for universe in (2, 1 << 9, 1 << 20, 1 << 41, 1 << 63, 1 << 64):
        for n in (1, 2, 65, 2000):
            values = np.sort(rng.integers(0, universe - 1, n, dtype=np.uint64, endpoint=True))
            assert EliasFano(encode(values, universe)).access(np.arange(n)).tolist() == values.tolist()
