"""LM scoring by an Elias-Fano n-gram trie.

Level 1 holds the vocabulary: words' 64-bit hashes in order, so that a word's
place is its id, and exact counts. Level n holds contexts of n - 1 ids: an
Elias-Fano sequence of context keys (mixed one to one, so that the contexts of
a frequent word do not crowd), monotone pointers to each context's range of
successors, the successors as one Elias-Fano sequence, and by one byte each the
quantised discounted probability of every successor and the quantised back-off
mass of every context. A lookup finds the context, follows its pointers, and
searches the successor there. Successors are numbered relative to their
context: in a range of s successors from place b on, word w is b * V + w * s.
This rises through the level, and as ids spread evenly (they follow hashes),
so do these numbers: buckets stay small however many successors a context has.

Probabilities are Witten-Bell: of a context seen C times with T different
successors, a successor seen c times has c / (C + T), and T / (C + T) goes to
the shorter context; the last step is the add-one unigram of the base score.

Counting and building are Spark jobs: tasks count n-grams in bounded runs,
Spark deals the runs' parts out by a hash of the context to shards of about
``SHARD`` n-grams, and each shard is merged and written, under a name that
holds its content's place, to the shared folder (a retried task writes the
same bytes again). Scoring tasks map the shards' files into memory.

Defined results: a null or empty text is the end token alone; repeated rows
are learned and scored each; a null key counts as empty text for the fold; an
empty table gives an empty result, and with nothing learned all tokens are
unknown, N and V are 0. Only doc_id and text are read. Words are told apart by
64-bit hashes: two words that share one would count as one word (among a
billion distinct words, some 0.03 such pairs are to be expected; made-up words of
over a thousand bytes can be built to share one). From about
three billion distinct words on, contexts of two are known by 63 mixed bits too.
"""

from __future__ import annotations

import functools
import json
import mmap
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm.common import byte_rows, crc_fold, mixed_bits, new_shared_path, table, word_hashes
from subledger.llm.elias_fano import EliasFano, encode

ORDER = 3
#: N-grams of a shard, about; words of a vocabulary shard, about.
SHARD = 1 << 21
#: Tokens that a counting task gathers before it hands their n-grams on (their local numbers fit 20 bits).
RUN = 1 << 20
#: Bytes of text read at a time.
READ = 4 << 20
#: Distinct words that a counting task gathers.
HELD_WORDS = 1 << 18
#: Shards that a task holds where the shared folder cannot be mapped.
HELD_SHARDS = 16
_U = np.uint64


_BLANK = np.array([chr(b) in " \t\n\v\f\r" for b in range(256)])
_END_HASH = _U(0x6A09E667F3BCC909)


def token_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each text (its words, then the end), and all tokens' hashes."""
    lower = [(t or b"").lower() for t in texts]
    ends = np.cumsum(np.fromiter(map(len, lower), np.int64, len(lower)) + 1)
    starts, hashes = word_hashes(b"\n".join(lower), _BLANK)
    owner = np.searchsorted(ends, starts, "right")
    sizes = np.bincount(owner, minlength=len(texts)) + 1
    out = np.full(len(starts) + len(texts), _END_HASH)
    out[np.arange(len(starts)) + owner] = hashes
    return sizes, out


def order_of(values: np.ndarray) -> np.ndarray:
    """An order that sorts values: they are sorted as one number with their places behind them, without the
    lowest bits where both do not fit; if values that differ in those alone come out of order, the long way."""
    place = max(0, len(values) - 1).bit_length()
    dropped = max(0, int(values.max()).bit_length() + place - 64) if len(values) else 0
    packed = values >> _U(dropped) << _U(place) | np.arange(len(values), dtype=_U)
    packed.sort()
    order = (packed & _U((1 << place) - 1)).astype(np.int64)
    if dropped:
        found = values[order]
        if (found[1:] < found[:-1]).any():
            return np.argsort(values, kind="stable")
    return order


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and each value's number among them."""
    order = order_of(values)
    in_order = values[order]
    first = np.append(True, in_order[1:] != in_order[:-1])[:len(values)]
    number = np.empty(len(values), np.int64)
    number[order] = np.cumsum(first) - 1
    return in_order[first], number


# Level files: a JSON head line and then the arrays, aligned to 8 bytes.


def write_level(uri: str, name: str, arrays: dict[str, np.ndarray], facts: dict) -> None:
    fs, folder = pyarrow.fs.FileSystem.from_uri(uri)
    at, places, parts = 0, {}, []
    for key, value in arrays.items():
        raw = value.tobytes()
        places[key] = (at, len(value), value.dtype.str)
        parts += [raw, b"\0" * (-len(raw) % 8)]
        at += len(raw) + -len(raw) % 8
    head = json.dumps({"places": places, "facts": facts}).encode()
    head += b" " * (-(len(head) + 1) % 8) + b"\n"
    fs.create_dir(folder, recursive=True)
    own = f"{folder}/.{name}-{np.random.SeedSequence().entropy:x}"
    with fs.open_output_stream(own) as out:
        for part in (len(head).to_bytes(8, "little"), head, *parts):
            out.write(part)
    fs.move(own, f"{folder}/{name}")


def _held(read):
    """Remember mapped shards, which take no memory of the task's own, and few of those that had to be read."""
    mapped, few = functools.lru_cache(maxsize=4096)(read), functools.lru_cache(maxsize=HELD_SHARDS)(read)

    @functools.wraps(read)
    def get(uri: str, *which):
        return (mapped if uri.startswith("file:") else few)(uri, *which)

    return get


def open_level(uri: str, name: str) -> tuple[dict[str, np.ndarray], dict] | None:
    """A level file's arrays, mapped into memory (read, if the shared folder cannot be mapped), and facts; None if it has none."""
    fs, folder = pyarrow.fs.FileSystem.from_uri(uri)
    path = f"{folder}/{name}"
    if fs.get_file_info(path).type == pyarrow.fs.FileType.NotFound:
        return None
    if isinstance(fs, pyarrow.fs.LocalFileSystem):
        with open(path, "rb") as f:
            raw = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    else:
        with fs.open_input_file(path) as f:
            raw = f.read_buffer()
    size = int.from_bytes(bytes(memoryview(raw)[:8]), "little")
    head = json.loads(bytes(memoryview(raw)[8:8 + size]))
    return {k: np.frombuffer(raw, np.dtype(t), n, 8 + size + at) for k, (at, n, t) in head["places"].items()}, head["facts"]


def _prefixed(name: str, arrays: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {f"{name}.{k}": v for k, v in arrays.items()}


def _sequence(name: str, arrays: dict[str, np.ndarray]) -> EliasFano:
    return EliasFano({k.removeprefix(f"{name}."): v for k, v in arrays.items() if k.startswith(f"{name}.")})


def quantise(p: np.ndarray) -> tuple[np.ndarray, dict]:
    """One byte a probability: even steps of its logarithm between the least and the most."""
    logs = np.log(p) if len(p) else np.zeros(1)
    low, step = float(logs.min()), max(float(logs.max() - logs.min()) / 255, 1e-12)
    return np.rint((logs - low) / step).astype(np.uint8)[:len(p)], {"low": low, "step": step}


def _levels_of(q: dict) -> np.ndarray:
    return np.exp(q["low"] + q["step"] * np.arange(256))


@dataclass
class Trie:
    """Where a model's levels lie, and its totals. Small: the arrays stay in the files."""

    uri: str
    total: int  # training tokens
    words: int  # distinct ones
    vocabulary_bits: int  # shards of the vocabulary, as a power of two
    bases: list[int]  # first id of each of them
    shards: int  # of each higher level

    def key_bits(self, level: int) -> int:
        return max(2, min(63, (self.words ** (level - 1)).bit_length()))

    def joined(self, level: int, key: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """A context's key with one more id: a number to base V, or 63 mixed bits where such numbers would not fit."""
        if self.words ** (level - 1) < 1 << 63:
            return key * _U(max(1, self.words)) + ids.astype(_U)
        return mixed_bits(key * _U(0x9E3779B97F4A7C15) + ids.astype(_U) + _U(1)) >> _U(1)

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and counts of words, by their hashes."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        part = (hashes >> _U(64 - self.vocabulary_bits)).astype(np.int64) if self.vocabulary_bits else np.zeros(len(hashes), np.int64)
        for k in np.unique(part).tolist():
            own = np.flatnonzero(part == k)
            if (held := _vocabulary(self.uri, k)) is None:
                continue
            place, equal = held[0].find(hashes[own])
            ids[own[equal]] = place[equal] + self.bases[k]
            counts[own[equal]] = held[1][place[equal]]
        return ids, counts

    def step(self, level: int, contexts: np.ndarray, words: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Interpolate: p of the shorter context becomes p after these contexts (keys)."""
        out = p.copy()
        mixed = _mixed(contexts, self.key_bits(level))
        order = order_of(mixed)  # neighbours in the level, and equal contexts, come together
        part = _shard_of(contexts, self.shards)[order]
        by = _by_shard(part, self.shards)
        order, part = order[by], part[by]
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(order)]
        for at, end in zip(cuts[:-1], cuts[1:], strict=True) if len(order) else ():
            own = order[at:end]
            if (held := _level(self.uri, level, int(part[at]))) is None:
                continue
            keys, pointers, successors, chance, mass, chances, masses = held
            asked = mixed[own]
            first = np.append(True, asked[1:] != asked[:-1])  # each context once
            rank, equal = keys.find(asked[first])
            begin, stop = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            begin[equal], stop[equal] = (x.astype(np.int64) for x in pointers.access_two(rank[equal]))
            which = np.cumsum(first) - 1
            found = equal[which]
            own, which = own[found], which[found]
            if not len(own):
                continue
            begin, stop, rank = begin[which], stop[which], rank[which]
            known = words[own] >= 0
            relative = begin.astype(_U) * _U(self.words) + np.maximum(words[own], 0).astype(_U) * (stop - begin).astype(_U)
            by = order_of(relative)  # each context and word once, in the level's order
            sorted_ = relative[by]
            first = np.append(True, sorted_[1:] != sorted_[:-1])
            one = by[first]
            place, there = successors.find(relative[one], begin[one], stop[one])
            found = np.zeros(len(one))
            found[there] = chances[chance[place[there]]]
            value = np.empty(len(own))
            value[by] = found[np.cumsum(first) - 1]
            value[~known] = 0.0
            out[own] = value + masses[mass[rank]] * p[own]
        return out


@_held
def _vocabulary(uri: str, shard: int) -> tuple[EliasFano, np.ndarray] | None:
    found = open_level(uri, f"1-{shard}")
    return found and (_sequence("words", found[0]), found[0]["counts"])


@_held
def _level(uri: str, level: int, shard: int):
    found = open_level(uri, f"{level}-{shard}")
    if found is None:
        return None
    arrays, facts = found
    return (*(_sequence(k, arrays) for k in ("keys", "pointers", "successors")), arrays["chance"], arrays["mass"], _levels_of(facts["chance"]), _levels_of(facts["mass"]))


def _shard_of(contexts: np.ndarray, shards: int) -> np.ndarray:
    mixed = contexts * _U(0x9E3779B97F4A7C15)
    return (((mixed ^ (mixed >> _U(29))) * _U(0xBF58476D1CE4E5B9) >> _U(33)) % _U(shards)).astype(np.int64)


def _by_shard(part: np.ndarray, shards: int) -> np.ndarray:
    """A stable order by shard: a radix sort for few of them."""
    return np.argsort(part.astype(np.uint16) if shards <= 1 << 16 else part, kind="stable")


def _mixed(contexts: np.ndarray, bits: int) -> np.ndarray:
    """A one-to-one mixing of keys of so many bits."""
    mask, half = _U((1 << bits) - 1), _U(bits // 2 + 1)
    for factor in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9):
        contexts = (contexts * _U(factor)) & mask
        contexts = contexts ^ (contexts >> half)
    return contexts


class Reader:
    """Turns texts into ids and counts; each distinct word of a run of texts is looked up once."""

    def __init__(self, trie: Trie) -> None:
        self.trie = trie

    def read(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of each text; all tokens' ids and counts."""
        sizes, hashes = token_hashes(texts)
        words, own = numbered(hashes)
        ids, counts = self.trie.lookup(words)
        return sizes, ids[own], counts[own]


def _places(sizes: np.ndarray) -> np.ndarray:
    """Each token's place in its text."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _keys(trie: Trie, level: int, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The key of the context of level - 1 ids before each place ``at``."""
    key = np.zeros(len(at), _U)
    for back in range(level - 1, 0, -1):
        key = trie.joined(level, key, ids[at - back])
    return key


# Building


def _count_words(docs: DataFrame) -> DataFrame:
    """h (hash as a long whose order is the unsigned order) and n of all tokens."""
    def run(batches):
        h, n = np.zeros(0, _U), np.zeros(0, np.int64)

        def out():
            return pa.record_batch([pa.array((h ^ _U(1 << 63)).view(np.int64)), pa.array(n, pa.int64())], ["h", "n"])

        for batch in batches:
            for _, raw in byte_rows(batch, most=READ):
                words, counts = np.unique(token_hashes(raw)[1], return_counts=True)
                h, own = numbered(np.append(h, words))
                n = np.bincount(own, np.append(n, counts), len(h)).astype(np.int64)
                if len(h) > HELD_WORDS:
                    yield out()
                    h, n = h[:0], n[:0]
        if len(h):
            yield out()

    return docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _write_vocabulary(counted: DataFrame, uri: str, words: int, shard: int) -> tuple[int, list[int]]:
    """Write level 1 by ranges of hashes; bits of the shard numbers and the shards' first ids."""
    bits = max(0, -(-words // shard) - 1).bit_length()
    size = F.shiftrightunsigned(F.col("h").bitwiseXOR(F.lit(-1 << 63)), 64 - bits) if bits else F.lit(0).cast("long")

    def write(key, part):
        shard = key[0].as_py()
        hashes = part.column("h").to_numpy().view(_U) ^ _U(1 << 63)
        order = np.argsort(hashes)
        counts = part.column("n").to_numpy()[order]
        least = next(t for t in (np.uint8, np.uint16, np.uint32, np.int64) if counts.max() <= np.iinfo(t).max)
        write_level(uri, f"1-{shard}", _prefixed("words", encode(hashes[order], 1 << 64)) | {"counts": counts.astype(least)}, {})
        return pa.table({"shard": pa.array([shard], pa.int64()), "n": pa.array([len(order)], pa.int64())})

    rows = counted.withColumn("shard", size).groupBy("shard").applyInArrow(write, "shard long, n long").collect()  # a row a shard
    sizes = [0] * (1 << bits)
    for row in rows:
        sizes[row["shard"]] = row["n"]
    return bits, [sum(sizes[:k]) for k in range(len(sizes))]


def _count_ngrams(docs: DataFrame, trie: Trie, order: int) -> DataFrame:
    """level, shard and a compressed part (contexts, words, counts of one run), for all n-grams of 2 to ``order`` ids."""
    def parts(level: int, own: np.ndarray, local: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
        at = np.flatnonzero(places >= level - 1)
        if not len(at):
            return
        packed = np.zeros(len(at), _U)
        for back in range(level - 1, -1, -1):
            packed = packed << _U(21) | local[at - back].astype(_U)
        grams, counts = np.unique(packed, return_counts=True)
        pieces = [own[((grams >> _U(21 * k)) & _U((1 << 21) - 1)).astype(np.int64)] for k in range(level)]  # the last word first
        contexts = np.zeros(len(grams), _U)
        for piece in pieces[:0:-1]:
            contexts = trie.joined(level, contexts, piece)
        shard = _shard_of(contexts, trie.shards)
        by = _by_shard(shard, trie.shards)
        ends = np.append(np.flatnonzero(np.diff(shard[by])) + 1, len(by))
        for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True):
            rows = by[a:b]
            yield level, int(shard[rows[0]]), pack(contexts[rows], pieces[0][rows], counts[rows])

    def batch_of(found: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        levels, shards, blobs = zip(*found, strict=True)
        return pa.record_batch([pa.array(levels, pa.int32()), pa.array(shards, pa.int64()), pa.array(blobs, pa.binary())], ["level", "shard", "part"])

    def run(batches):
        reader = Reader(trie)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush():
            ids, places = (np.concatenate(x) for x in zip(*held, strict=True))
            own, local = numbered(ids.view(_U))
            own = own.view(np.int64)
            return batch_of([p for level in range(2, order + 1) for p in parts(level, own, local, places)] or [(2, 0, b"")])

        for batch in batches:
            for _, raw in byte_rows(batch, most=READ):
                sizes, ids, _ = reader.read(raw)
                places = _places(sizes)
                # A run cut inside a text goes on with the order - 1 ids before the cut, at places too low to count again.
                for at in range(0, len(ids), RUN - order):
                    back = min(order - 1, int(places[at]), at)
                    piece = ids[at - back:at + RUN - order], np.concatenate([np.arange(back), places[at:at + RUN - order]])
                    if back:
                        piece[1][:back] = 0
                    if size + len(piece[0]) > RUN and held:
                        yield flush()
                        held, size = [], 0
                    held.append(piece)
                    size += len(piece[0])
        if held:
            yield flush()

    return docs.select("text").mapInArrow(run, "level int, shard long, part binary")


def pack(contexts: np.ndarray, words: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted n-grams, compressed: steps between contexts, words and counts, each in its least width."""
    steps = np.diff(contexts, prepend=_U(0))
    out = [np.array([len(contexts)], np.int64).tobytes()]
    for values in (steps, words.astype(_U), counts.astype(_U)):
        least = next(t for t in (np.uint8, np.uint16, np.uint32, _U) if values.max() <= np.iinfo(t).max)
        planes = np.ascontiguousarray(values.astype(least).view(np.uint8).reshape(len(values), -1).T)
        out += [bytes([np.dtype(least).itemsize]), planes.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(part: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(part)
    n, at, out = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for _ in range(3):
        width = raw[at]
        planes = np.frombuffer(raw, np.uint8, n * width, at + 1).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(_U))
        at += 1 + n * width
    out[0] = np.cumsum(out[0], dtype=_U)
    return out


def merge(parts: Iterator[bytes], key_bits: int, held: int = 1 << 22) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-grams of a shard in order of mixed context and word, each once, with their counts.

    Parts are added up as they come: besides the shard's distinct n-grams, about as many (``held`` at least) are in memory.
    """
    def added(runs: list) -> list[np.ndarray]:
        contexts, words, counts = (np.concatenate(x) for x in zip(*runs, strict=True))
        order = order_of(contexts)
        in_order = contexts[order]
        ranks = np.cumsum(np.append(False, in_order[1:] != in_order[:-1]).astype(_U))
        span = int(words.max()) + 1
        if int(ranks[-1]) * span + span >= 1 << 64:  # too wide for one number
            order = np.lexsort((words, contexts))
        else:
            order = order[order_of(ranks * _U(span) + words[order])]
        contexts, words, counts = contexts[order], words[order], counts[order]
        starts = np.flatnonzero(np.append(True, (contexts[1:] != contexts[:-1]) | (words[1:] != words[:-1])))
        return [contexts[starts], words[starts], np.add.reduceat(counts, starts)]

    runs: list = []
    for part in parts:
        contexts, words, counts = unpack(part)
        runs.append([_mixed(contexts, key_bits), words, counts])
        if len(runs) > 1 and sum(len(r[0]) for r in runs[1:]) > max(held, len(runs[0][0])):
            runs = [added(runs)]
    return tuple(added(runs))


def level_arrays(contexts: np.ndarray, words: np.ndarray, counts: np.ndarray, vocabulary: int, key_bits: int) -> tuple[dict[str, np.ndarray], dict]:
    """A level's shard from its merged n-grams."""
    starts = np.flatnonzero(np.append(True, np.diff(contexts) != 0))
    sizes = np.diff(starts, append=len(contexts))
    totals = np.add.reduceat(counts, starts).astype(float)
    rank = np.repeat(np.arange(len(starts)), sizes)
    chance, q_chance = quantise(counts / (totals + sizes)[rank])
    mass, q_mass = quantise(sizes / (totals + sizes))
    arrays = _prefixed("keys", encode(contexts[starts], 1 << key_bits))
    arrays |= _prefixed("pointers", encode(np.append(starts, len(contexts)).astype(_U), len(contexts) + 1))
    relative = starts[rank].astype(_U) * _U(vocabulary) + words * sizes[rank].astype(_U)
    arrays |= _prefixed("successors", encode(relative, len(contexts) * vocabulary))
    for name, unused in (("keys", "ones"), ("successors", "ones"), ("pointers", "zeros")):  # keys and successors are searched, pointers read
        arrays[f"{name}.{unused}"] = np.zeros(0, np.uint32)
    return arrays | {"chance": chance, "mass": mass}, {"chance": q_chance, "mass": q_mass}


def build(docs: DataFrame, order: int = ORDER, shard: int = SHARD) -> Trie:
    """Learn from every whole text of ``docs`` (text) and write the levels to the shared folder."""
    uri = new_shared_path(docs.sparkSession, "trie")
    uri = uri if "://" in uri or uri.startswith("file:") else f"file://{uri}"
    uri = uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri
    _count_words(docs).write.parquet(f"{uri}/counts")  # read twice: the totals, then the vocabulary
    counted = docs.sparkSession.read.parquet(f"{uri}/counts")
    words, total = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    bits, bases = _write_vocabulary(counted, uri, words, shard)
    trie = Trie(uri, total, words, bits, bases, max(1, -(-total // shard)))
    if not total:
        return trie

    def write(key, part):
        level, shard = (k.as_py() for k in key)
        blobs = part.column("part")
        n = 0
        if any(len(b.as_buffer() or b"") for b in blobs):
            contexts, words, counts = merge((b.as_py() for b in blobs if len(b.as_buffer() or b"")), trie.key_bits(level))
            n = len(contexts)
            write_level(trie.uri, f"{level}-{shard}", *level_arrays(contexts, words, counts, trie.words, trie.key_bits(level)))
        return pa.table({"n": pa.array([n], pa.int64())})

    _count_ngrams(docs, trie, order).groupBy("level", "shard").applyInArrow(write, "n long").agg(F.sum("n")).first()
    return trie


# Scoring

SCHEMA = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, trie: Trie, order: int = ORDER) -> DataFrame:
    """Of every row's whole text: tokens, known ones, base score and the model's log10 probability."""
    def run(batches):
        reader = Reader(trie)
        for batch in batches:
            for at, raw in byte_rows(batch, most=READ):
                sizes, ids, counts = reader.read(raw)
                places = _places(sizes)
                unigram = (counts + 1) / (trie.total + trie.words + 1)
                p = unigram.copy()
                for level in range(2, order + 1):
                    old_enough = places >= level - 1
                    for back in range(1, level):
                        old_enough[back:] &= ids[:-back] >= 0
                    own = np.flatnonzero(old_enough)
                    if len(own):
                        p[own] = trie.step(level, _keys(trie, level, ids, own), ids[own], p[own])
                starts = np.cumsum(sizes) - sizes
                columns = [sizes, np.add.reduceat((ids >= 0).astype(np.int64), starts), np.full(len(sizes), trie.total),
                           np.add.reduceat(np.log10(unigram), starts), np.add.reduceat(np.log10(p), starts)]
                yield pa.record_batch([batch.column("doc_id").slice(at, len(raw)), *map(pa.array, columns)], [x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def held_out(key: Column) -> Column:
    return crc_fold(key, 7) == 2


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trie = build(docs.where(~held_out(F.col("doc_id"))))
    scored = score(docs, trie)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
