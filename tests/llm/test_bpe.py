import hashlib

import public_tokenizers as P
from llm_helpers import prose

from subledger.llm import bpe

FILE = P.path("byte_bpe_multi_50k.tiktoken")


def test_long_texts_encode_as_whole():
    whole = bpe.encoding(FILE, P.PATTERN).encode_ordinary
    texts = [prose(5, 30000), "ab  \n c" * 30000, ("don't   stop " * 9000) + "　 x", "x" * 100000 + " y", " " * 5000 + "z", "東京 " * 40000]
    for text in texts:
        assert "".join(bpe.safe_pieces(text, 1000)) == text
        assert bpe.encode(text, FILE, P.PATTERN) == whole(text)
        assert [i for p in bpe.safe_pieces(text, 777) for i in whole(p)] == whole(text)


def test_decodes_raw_bytes():
    ids = bpe.encode("東", FILE, P.PATTERN)
    assert b"".join(bpe.decode([i], FILE, P.PATTERN) for i in ids) == "東".encode()


def test_round_trip_and_edges(edge_docs, no_docs, edge_rows):
    got = bpe.round_trip(edge_docs, FILE, P.PATTERN).collect()
    assert sorted(r["decoded_sha256"] for r in got) == sorted(hashlib.sha256((r[1] or "").encode()).hexdigest() for r in edge_rows)
    empty = [r for r in got if r["doc_id"] == 1][0]
    assert empty["n_tokens"] == 0 and empty["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    assert bpe.round_trip(no_docs, FILE, P.PATTERN).count() == 0
    ids = {r["doc_id"]: r["ids"] for r in bpe.encode_documents(edge_docs, FILE, P.PATTERN).collect()}
    assert ids[4] == bpe.encode("a", FILE, P.PATTERN)


def merged(piece, ranks):
    """One match's ids by the plain merge loop: always the pair of lowest rank, the leftmost of equals."""
    parts = [bytes([b]) for b in piece]
    while len(parts) > 1:
        best = min((ranks.get(parts[i] + parts[i + 1], float("inf")), i) for i in range(len(parts) - 1))
        if best[0] == float("inf"):
            break
        parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    return [ranks[p] for p in parts]


def test_equals_plain_merges():
    import base64

    import regex

    ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in open(FILE, "rb"))}
    blank = "  \t\n\u3000\x1c\x85 " * 30
    for text in ["", prose(9, 200), "Über ñandú 東京   x don't we'll 12345 ...!? \x00\x7f", blank, blank + "a", "a" + blank, "don't\u00a0\u2003 \n\n  stop"]:
        want = [i for m in regex.findall(P.PATTERN, text) for i in merged(m.encode(), ranks)]
        assert bpe.encode(text, FILE, P.PATTERN) == want and bpe.decode(want, FILE, P.PATTERN) == text.encode()


def test_long_blank_runs_are_cut_out(monkeypatch):
    whole = bpe.encoding(FILE, P.PATTERN).encode_ordinary
    texts = ["a" + " " * 9000 + "b", " " * 9000, "\n \u3000" * 4000 + "'s x", "x" + "\x1c \x1d" * 4000 + "y", ("a" + " " * 5000 + "!\n" * 3000) * 3, " " * 4096, " " * 4097 + "\t", "é\u2009" * 5000 + " " * 5000]
    want = [whole(t) for t in texts]
    monkeypatch.setattr(bpe, "LONG_TEXT", 100)
    assert [bpe.encode(t, FILE, P.PATTERN) for t in texts] == want


def test_millions_of_one_kind():
    for text in (" " * 1_000_000 + "a", "a" + "\n" * 5_000_000, " \t" * 2_500_000, "x" * 5_000_000, "!" * 2_000_000, "7" * 5_000_000):
        ids = bpe.encode(text, FILE, P.PATTERN)
        assert bpe.decode(ids, FILE, P.PATTERN).decode() == text
