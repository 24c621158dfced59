"""Byte-level BPE encoding and decoding by a local rank file.

Texts go through tiktoken in Arrow batches. A long text is first cut where
the split pattern must end a match anyway: between a letter or digit and a
space. No match spans such a place, and white space keeps what follows it,
so the pieces' ids joined are the whole text's ids. A long run of white space
is cut out: it is one match up to its last character, which goes to what
follows, and all of it at the text's end. Its match is merged as one piece
without the pattern, whose search for it would need a stack as deep as the
run is long. Runs of other kinds need no such stack.

Defined results: a null or empty text has no ids; repeated rows give repeated
results; an empty table gives an empty result; only the key and text columns
are read, so other columns cannot clash.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from subledger.llm.common import table

#: Texts longer than this many characters are cut at safe places.
LONG_TEXT = 1 << 16

#: Runs of the pattern's white space that are longer than this are cut out of long texts.
LONG_BLANK = 1 << 12
_BLANKS = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


@functools.cache
def encoding(rank_file: str, pattern: str):
    """The encoder of a rank file (base64 token and rank per line); one per Python worker."""
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, most: int = LONG_TEXT) -> Iterator[str]:
    """Cut a text at places no match of the pattern spans, into pieces of about ``most`` characters."""
    start = 0
    while len(text) - start > most:
        cut = text.find(" ", start + most)
        while cut > 0 and not text[cut - 1].isalnum():
            cut = text.find(" ", cut + 1)
        if cut <= 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def encode(text: str | None, rank_file: str, pattern: str) -> list[int]:
    """Ids of a whole text, without special tokens."""
    bpe = encoding(rank_file, pattern)
    if not text:
        return []
    if len(text) <= LONG_TEXT:
        return bpe.encode_ordinary(text)
    ids: list[int] = []
    start = 0
    for run in re.finditer(f"{_BLANKS}{{{LONG_BLANK},}}", text):
        at, end = run.span()
        end -= end < len(text)
        for piece in safe_pieces(text[start:at]):
            ids += bpe.encode_ordinary(piece)
        ids += bpe._encode_single_piece(text[at:end])
        start = end
    for piece in safe_pieces(text[start:]):
        ids += bpe.encode_ordinary(piece)
    return ids


def decode(ids: list[int], rank_file: str, pattern: str) -> bytes:
    """The raw bytes of the ids; bytes that end inside a character stay as they are."""
    return encoding(rank_file, pattern).decode_bytes(ids)


def encode_documents(df: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, ids array<int> of every row's whole text."""
    def run(batches):
        for batch in batches:
            keys, texts = batch.column("doc_id"), batch.column("text")
            for at in range(0, len(texts), 256):
                ids = [encode(t, rank_file, pattern) for t in texts.slice(at, 256).to_pylist()]
                yield pa.record_batch([keys.slice(at, 256), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return df.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def round_trip(df: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Token count, digest of the ids and digest of the bytes they decode to, per row."""
    def run(batches):
        for batch in batches:
            keys, texts = batch.column("doc_id"), batch.column("text")
            for at in range(0, len(texts), 256):
                counts, of_ids, of_bytes = [], [], []
                for text in texts.slice(at, 256).to_pylist():
                    ids = encode(text, rank_file, pattern)
                    counts.append(len(ids))
                    of_ids.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                    of_bytes.append(hashlib.sha256(decode(ids, rank_file, pattern)).hexdigest())
                yield pa.record_batch(
                    [keys.slice(at, 256), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select("doc_id", "text").mapInArrow(run, SCHEMA)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
