"""Phrase collocation mining with Misra-Gries summaries.

Every frequent n-gram is found in two passes. In the first, tasks hash their
n-grams and deal (hash, count) to hash partitions; a partition merges them into
one Misra-Gries summary whose capacity exceeds the partition's mass (all its
occurrences, summed first) divided by the threshold. The summary loses less
than the threshold of any n-gram's count, so each frequent one survives. The
second pass counts the survivors exactly, by their words. Survivors are known
to tasks by a Bloom filter of bounded size; what it lets through besides is
counted as exactly and fails the threshold.

Words and pairs are mined first. Longer n-grams are mined among those whose
every pair of neighbours is frequent, as the others cannot be.

Text is taken as bytes, word and n-gram hashes are computed for whole runs of
texts in numpy. Hashes are 64 bits: in the first pass, n-grams with one hash
only share a count (and survive together); in the second a further hash of
other make tells them apart, so that a wrong count takes 128 equal bits.

Defined results: a null text is empty; a null language is ``und``; A-Z are
lower-cased, nothing else is; pieces without a word count nothing; ties go by
phrase; repeated rows count again; an empty table gives an empty result; only
text and lang are read, whatever other columns are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subledger.llm.common import byte_rows, checkpointed, table

LONGEST, THRESHOLD, TOP = 5, 100, 2000
#: A summary's counters, in multiples of what the guarantee asks for: more let fewer infrequent n-grams through.
ROOM = 4
#: Bytes of text taken at a time, and n-grams held before they are dealt out.
RUN, HELD = 1 << 20, 1 << 21
#: Bytes of text a hash partition is made for; bits of a Bloom filter at most.
PART_BYTES, FILTER_BITS = 1 << 24, 1 << 27

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORD, _BLANK, _BREAK = 0, 1, 2
_KIND = np.array([_BREAK if chr(b) in ".,;:!?\n\x0b\x0c\r" else _BLANK if chr(b) in " \t" else _WORD for b in range(256)], np.uint8)
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverses modulo 2**64, for i below n at least."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        size = max(n, RUN + (RUN >> 2))
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _POWERS[base] = tuple(both)
    return _POWERS[base]


class Run:
    """The words of a run of text: bounds in ``raw``, piece numbers and owners' language hashes.

    The first ``carried`` words repeat the end of the run before, of the same text: n-grams of them alone have been counted.
    """

    def __init__(self, raw: bytes, ends: np.ndarray, langs: np.ndarray, carried: int = 0) -> None:
        self.raw, self.carried = raw, carried
        kinds = _KIND[np.frombuffer(raw, np.uint8)]
        inside = np.zeros(len(raw) + 2, np.int8)
        inside[1:-1] = kinds == _WORD
        steps = np.diff(inside)
        self.starts, self.stops = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
        self.piece = np.cumsum(kinds == _BREAK, dtype=np.int32)[self.starts] if len(raw) else np.zeros(0, np.int32)
        self.owner = np.searchsorted(ends, self.starts, "right")
        self.langs = langs[self.owner] if len(langs) else np.zeros(0, np.uint64)

    def words(self, base: int) -> np.ndarray:
        codes = np.frombuffer(self.raw, np.uint8).astype(np.uint64)
        up, down = _powers(base, len(self.raw) + 1)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes + np.uint64(1)) * up[:len(codes)], out=sums[1:])
        return _mixed((sums[self.stops] - sums[self.starts]) * down[self.starts])

    def grams(self, words: np.ndarray, base: int, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For n from 1: n, the first words of the n-grams that lie in a piece and are new, and their hashes (the language's counts)."""
        mixed = words
        for n in range(1, longest + 1):
            if n > len(words):
                return
            if n > 1:
                mixed = _mixed(mixed[:-1] * np.uint64(base) + words[n - 1:])
            at = np.flatnonzero(self.piece[n - 1:] == self.piece[:len(words) - n + 1])
            at = at[at + n > self.carried]
            yield n, at, _mixed(mixed[at] + self.langs[at])

    def phrase(self, at: int, n: int) -> bytes:
        return b" ".join(self.raw[a:b] for a, b in zip(self.starts[at:at + n].tolist(), self.stops[at:at + n].tolist(), strict=True))


def _lang_hash(lang: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(lang.encode(), 7)


def runs(batches: Iterator[pa.RecordBatch], longest: int = LONGEST) -> Iterator[tuple[Run, list[str]]]:
    """Runs of about RUN bytes over all texts of (lang, text) batches, and the language of each owner."""
    for batch in batches:
        langs = [x or "" if x is not None else "und" for x in batch.column("lang").to_pylist()]
        for first, raw in byte_rows(batch, most=RUN):
            texts, own, size = [], [], 0
            for lang, text in zip(langs[first:first + len(raw)], raw, strict=True):
                text = (text or b"").translate(_LOWER)
                if len(text) > RUN:
                    yield from _long(text, lang, longest)
                    continue
                texts.append(text)
                own.append(lang)
                size += len(text) + 1
                if size >= RUN:
                    yield _run(texts, own)
                    texts, own, size = [], [], 0
            if texts:
                yield _run(texts, own)


def _run(texts: list[bytes], langs: list[str]) -> tuple[Run, list[str]]:
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    known = {x: _lang_hash(x) for x in set(langs)}
    return Run(b"\n".join(texts), ends, np.array([known[x] for x in langs], np.uint64)), langs


def _long(text: bytes, lang: str, longest: int) -> Iterator[tuple[Run, list[str]]]:
    """A long text in slices that end outside words; each but the first begins with the words that n-grams across the cut need."""
    key = np.array([_lang_hash(lang)], np.uint64)
    at, back, carried = 0, 0, 0
    while at < len(text):
        stop = min(len(text), at + RUN)
        while stop < len(text) and _KIND[text[stop]] == _WORD:
            stop += 1
        run = Run(text[back:stop], np.array([stop - back + 1]), key, carried)
        yield run, [lang]
        kept = min(longest - 1, len(run.starts))
        carried, at = kept, stop
        back = back + int(run.starts[len(run.starts) - kept]) if kept else stop


class Sieve:
    """A Bloom filter over 64-bit hashes: two bits a hash."""

    def __init__(self, bits: int, words: np.ndarray | None = None) -> None:
        self.bits, self.words = bits, words if words is not None else np.zeros(bits >> 6, np.uint64)

    def _places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(self.bits - 1)
        return h & mask, (h >> np.uint64(32) ^ h * np.uint64(0x9E3779B1)) & mask

    def add(self, h: np.ndarray) -> None:
        for p in self._places(h):
            np.bitwise_or.at(self.words, (p >> np.uint64(6)).astype(np.int64), np.uint64(1) << (p & np.uint64(63)))

    def has(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), bool)
        for p in self._places(h):
            found &= (self.words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found


def sieve(hashes: DataFrame) -> Sieve:
    """The filter of the column h; tasks send their set words, summed by Spark, so the driver gets at most FILTER_BITS."""
    count = hashes.count()
    bits = min(FILTER_BITS, max(1 << 16, 1 << (16 * count).bit_length()))

    def run(batches):
        own = Sieve(bits)
        for batch in batches:
            own.add(batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64))
        at = np.flatnonzero(own.words)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(own.words[at].view(np.int64), pa.int64())], ["at", "bits"])

    found = hashes.mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(bits >> 6, np.uint64)
    words[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return Sieve(bits, words)


def _counted(h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h, kind="stable")
    h = h[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
    return h[first], np.add.reduceat(c[order], first) if len(first) else c[:0]


class Summary:
    """Misra-Gries: at most ``capacity`` counters; ``lost`` is the most that a counter is below the true count."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.lost = capacity, 0
        self.h, self.c = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, h: np.ndarray, c: np.ndarray) -> None:
        self.h, self.c = _counted(np.concatenate([self.h, h]), np.concatenate([self.c, c]))
        if len(self.h) > self.capacity:
            cut = int(np.partition(self.c, -self.capacity - 1)[-self.capacity - 1])  # the largest that has no counter
            self.lost += cut
            live = self.c > cut
            self.h, self.c = self.h[live], self.c[live] - cut

    def at_least(self, threshold: int) -> np.ndarray:
        return self.h[self.c + self.lost >= threshold]


class _Held:
    """Counts of a task's n-grams, merged as they grow."""

    def __init__(self) -> None:
        self.h: list[np.ndarray] = []
        self.c: list[np.ndarray] = []
        self.size = self.merged = 0

    def add(self, h: np.ndarray) -> None:
        found, counts = np.unique(h, return_counts=True)
        self.h.append(found)
        self.c.append(counts.astype(np.int64))
        self.size += len(found)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        out = _counted(np.concatenate(self.h), np.concatenate(self.c)) if self.h else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.__init__()
        return out


def _gated(run: Run, orders: range, gate: Sieve | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The n-grams of ``orders``; with a gate, those whose every pair of neighbours passes it."""
    words = run.words(_BASES[0])
    if gate is not None and len(words) > 1:
        near = run.piece[1:] == run.piece[:-1]
        pair = np.flatnonzero(near)
        near[pair] = gate.has(_mixed(_mixed(words[:-1] * np.uint64(_BASES[0]) + words[1:])[pair] + run.langs[pair]))
        passed = np.append(0, np.cumsum(near))
    for n, at, h in run.grams(words, _BASES[0], orders[-1]):
        if n not in orders:
            continue
        if gate is not None and n > 1:
            whole = passed[at + n - 1] - passed[at] == n - 1
            at, h = at[whole], h[whole]
        yield n, at, h


def survivors(docs: DataFrame, orders: range, threshold: int, parts: int, gate: Sieve | None = None) -> DataFrame:
    """h: hashes that hold every n-gram of ``orders`` with at least ``threshold`` occurrences in a language."""
    def deal(batches):
        held, mass = _Held(), np.zeros(parts, np.int64)

        def out():
            h, c = held.take()
            part = (h % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            h, c, part = h[order], c[order], part[order]
            cuts = np.searchsorted(part, np.arange(parts + 1))
            mass[:] += np.bincount(part, c, parts).astype(np.int64)
            for p in range(parts):
                a, b = cuts[p], cuts[p + 1]
                if b > a:
                    small = c[a:b].max() < 256
                    yield pa.record_batch([pa.array([p], pa.int32()), pa.array([0], pa.int64()), pa.array([h[a:b].tobytes()], pa.binary()),
                                           pa.array([c[a:b].astype("u1" if small else "<i8").tobytes()], pa.binary())], names)

        for run, _ in runs(batches):
            for _, _, h in _gated(run, orders, gate):
                held.add(h)
            if held.size >= HELD:
                yield from out()
        yield from out()
        some = np.flatnonzero(mass)
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(mass[some], pa.int64()), pa.nulls(len(some), pa.binary()), pa.nulls(len(some), pa.binary())], names)

    def merge(batches):
        part, summary, total, h, c, held = None, None, 0, [], [], 0
        for batch in batches:
            for p, mass, hashes, counts in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
                if p != part:
                    if summary is not None:
                        summary.merge(np.concatenate(h), np.concatenate(c))
                        yield _hashes(summary.at_least(threshold))
                    part, summary, total, h, c, held = p, None, 0, [], [], 0
                if hashes is None:  # masses come first
                    total += mass
                    continue
                summary = summary or Summary(ROOM * total // threshold + 1)
                h.append(np.frombuffer(hashes, "<u8"))
                c.append(np.frombuffer(counts, "u1" if len(counts) * 8 == len(hashes) else "<i8").astype(np.int64))
                held += len(h[-1])
                if held >= max(1 << 20, 2 * summary.capacity):
                    summary.merge(np.concatenate(h), np.concatenate(c))
                    h, c, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        if summary is not None:
            summary.merge(np.concatenate(h), np.concatenate(c))
            yield _hashes(summary.at_least(threshold))

    names = ["part", "mass", "hashes", "counts"]
    dealt = docs.select("lang", "text").mapInArrow(deal, "part int, mass long, hashes binary, counts binary")
    return dealt.repartition("part").sortWithinPartitions("part", F.col("hashes").isNotNull()).mapInArrow(merge, "h long")


def _hashes(h: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(h.view(np.int64), pa.int64())], ["h"])


class _Exact:
    """Counts of n-grams told apart by two hashes, with their phrases; sorted by the hashes."""

    def __init__(self) -> None:
        self.h, self.s, self.n = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.at = np.zeros(0, np.int64)  # places in the lists
        self.langs: list[str] = []
        self.words: list[int] = []
        self.phrases: list[bytes] = []

    def add(self, h: np.ndarray, s: np.ndarray, n: np.ndarray, name) -> None:
        """Distinct h, s with counts; ``name(i)`` gives the language, words and phrase of the i-th."""
        found = np.searchsorted(self.h, h)
        same = found < len(self.h)
        same[same] = (self.h[found[same]] == h[same]) & (self.s[found[same]] == s[same])
        self.n[found[same]] += n[same]
        new = np.flatnonzero(~same)
        if not len(new):
            return
        first = len(self.phrases)
        for lang, words, phrase in map(name, new.tolist()):
            self.langs.append(lang)
            self.words.append(words)
            self.phrases.append(phrase)
        h, s, n = (np.concatenate(x) for x in ((self.h, h[new]), (self.s, s[new]), (self.n, n[new])))
        at = np.append(self.at, np.arange(first, len(self.phrases)))
        order = np.argsort(h, kind="stable")
        self.h, self.s, self.n, self.at = h[order], s[order], n[order], at[order]

    def packed(self, parts: int) -> Iterator[pa.RecordBatch]:
        """A row for each hash partition that has n-grams."""
        part = (self.h % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(cuts)).tolist():
            mine = order[cuts[p]:cuts[p + 1]]
            at = self.at[mine].tolist()
            yield pa.record_batch([
                pa.array([p], pa.int32()), *(pa.array([x[mine].tobytes()], pa.binary()) for x in (self.h, self.s, self.n)),
                pa.array([[self.langs[i] for i in at]], pa.list_(pa.string())), pa.array([[self.words[i] for i in at]], pa.list_(pa.int32())),
                pa.array([[self.phrases[i].decode("utf-8", "replace") for i in at]], pa.list_(pa.string()))], _PACKED)


_PACKED = ["part", "h", "s", "n", "langs", "words", "phrases"]


def _sums(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    """Sums over the packed rows of each partition (in order of part), of the n-grams that reach the threshold."""
    part, held = None, []

    def merged() -> list:
        h, s, n = (np.concatenate([x[k] for x in held]) for k in range(3))
        named = [pa.concat_arrays([x[k] for x in held]) for k in range(3, 6)]
        order = np.lexsort((s, h))
        h, s, n = h[order], s[order], n[order]
        first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (s[1:] != s[:-1])))
        return [h[first], s[first], np.add.reduceat(n, first), *(x.take(pa.array(order[first])) for x in named)]

    def out() -> pa.RecordBatch:
        h, _, n, langs, words, phrases = merged()
        live = pa.array(np.flatnonzero((n >= threshold) | (words.to_numpy() == 0)))
        return pa.record_batch([x.take(live) for x in (langs, words, phrases, pa.array(h.view(np.int64)), pa.array(n))], ["lang", "words", "phrase", "h", "n"])

    for batch in batches:
        for k in range(len(batch)):
            p = batch.column(0)[k].as_py()
            if p != part and held:
                yield out()
                held = []
            part = p
            held.append([*(np.frombuffer(batch.column(j)[k].as_py(), t) for j, t in ((1, "<u8"), (2, "<u8"), (3, "<i8"))), *(batch.column(j)[k].values for j in (4, 5, 6))])
            if len(held) > 1 and sum(len(x[0]) for x in held[1:]) > max(1 << 18, len(held[0][0])):
                held = [merged()]
    if held:
        yield out()


def exact(docs: DataFrame, orders: range, threshold: int, parts: int, known: Sieve, gate: Sieve | None = None) -> DataFrame:
    """lang, words (0: the language's whole count), phrase, h, n: exact counts of the n-grams that ``known`` lets through, from the threshold on."""
    def count(batches):
        held = _Exact()
        for run, langs in runs(batches):
            other = None
            if orders[0] == 1:
                owners, counts = np.unique(run.owner[run.carried:], return_counts=True)
                totals: dict[str, int] = {}
                for o, c in zip(owners.tolist(), counts.tolist(), strict=True):
                    totals[langs[o]] = totals.get(langs[o], 0) + c
                names = sorted(totals, key=_lang_hash)
                keys = np.array([_lang_hash(x) for x in names], np.uint64)
                held.add(_mixed(keys), keys, np.array([totals[x] for x in names], np.int64), lambda i, names=names: (names[i], 0, b""))
            for n, at, h in _gated(run, orders, gate):
                passed = known.has(h)
                at, h = at[passed], h[passed]
                if not len(h):
                    continue
                if other is None:
                    other = dict((k, (a, x)) for k, a, x in run.grams(run.words(_BASES[1]), _BASES[1], orders[-1]))
                places, second = other[n]
                second = second[np.searchsorted(places, at)]
                order = np.argsort(h, kind="stable")
                if ((h[order][1:] == h[order][:-1]) & (second[order][1:] != second[order][:-1])).any():  # one hash, unlike n-grams
                    order = np.lexsort((second, h))
                at, h, second = at[order], h[order], second[order]
                first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (second[1:] != second[:-1])))
                at = at[first]
                held.add(h[first], second[first], np.diff(np.append(first, len(h))),
                         lambda i, at=at, n=n, run=run, langs=langs: (langs[run.owner[at[i]]], n, run.phrase(int(at[i]), n)))
        yield from held.packed(parts)

    kinds = "part int, h binary, s binary, n binary, langs array<string>, words array<int>, phrases array<string>"
    dealt = docs.select("lang", "text").mapInArrow(count, kinds).repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(lambda batches: _sums(batches, threshold), "lang string, words int, phrase string, h long, n long")


def frequent(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST) -> DataFrame:
    """lang, words, phrase, n of every n-gram (1 to ``longest`` words) with at least ``threshold`` occurrences; words 0: all of the language's."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(64, -(-size // PART_BYTES))
    few, gate = range(1, 3), None
    out: DataFrame | None = None
    for orders in (few, range(3, longest + 1)):
        if not orders:
            continue
        kept = checkpointed(survivors(docs, orders, threshold, parts, gate))
        found = checkpointed(exact(docs, orders, threshold, parts, sieve(kept), gate))
        out = found if out is None else out.unionByName(found)
        gate = sieve(found.where("words = 2"))
    return out.select("lang", "words", "phrase", "n")


def scored(counts: DataFrame, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score from ``frequent``'s rows."""
    split = F.split("phrase", " ", -1)
    phrases = counts.where("words > 0")
    totals = counts.where("words = 0").select("lang", F.col("n").alias("n"))
    candidates = phrases.where("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"), split.alias("w"))

    def joined(start: Column, length: Column) -> Column:
        return F.array_join(F.slice("w", start, length), " ")

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("_left"), joined(F.col("k") + 1, F.col("words") - F.col("k")).alias("_right"))
    left = phrases.select(F.col("lang").alias("_ll"), F.col("phrase").alias("_lp"), F.col("n").alias("l"))
    right = phrases.select(F.col("lang").alias("_rl"), F.col("phrase").alias("_rp"), F.col("n").alias("r"))
    parts = cuts.join(left, (F.col("lang") == F.col("_ll")) & (F.col("_left") == F.col("_lp"))).join(right, (F.col("lang") == F.col("_rl")) & (F.col("_right") == F.col("_rp")))
    wide = [F.col(c).cast("decimal(38,0)") for c in ("a", "n", "l", "r")]
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (wide[0].cast("decimal(17,0)") * wide[1].cast("decimal(17,0)")), wide[2].cast("decimal(18,0)") * wide[3].cast("decimal(18,0)"))
    parts = parts.join(totals.withColumnRenamed("lang", "_nl"), F.col("lang") == F.col("_nl")).withColumn("score", score.cast("long"))
    lowest = parts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r", "n")).alias("cut")).select("lang", "phrase", "a", "cut.*")

    span = F.sequence(F.lit(2), F.col("words") - 1)
    subs = F.flatten(F.transform(span, lambda m: F.transform(F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: joined(i, m))))
    inside = candidates.select("lang", "a", F.when(F.col("words") > 2, subs).alias("subs"))
    longer = inside.select(F.col("lang").alias("_wl"), F.explode("subs").alias("_wp"), F.col("a").alias("_wa"))
    longer = longer.groupBy("_wl", "_wp").agg(F.max("_wa").alias("_wa"))
    own = lowest.join(longer, (F.col("lang") == F.col("_wl")) & (F.col("phrase") == F.col("_wp")), "left")
    kept = own.where(F.col("_wa").isNull() | (100 * F.col("_wa") < 100 * F.col("a")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase")))
    return kept.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """The collocations of each language of ``docs`` (lang, text)."""
    return scored(checkpointed(frequent(docs, threshold, longest)), top)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, m, w[i:i + m - 1] AS g
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT lang, w, unnest(range(1, 6)) AS m FROM words) WHERE m <= len(w))),
f AS (SELECT lang, m, g, count(*) AS c FROM grams GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT p.lang, p.g, p.c AS a, l.c AS l, r.c AS r, t.n, l.m AS k,
         CAST((CAST(1000 AS HUGEINT) * p.c * t.n) // (CAST(l.c AS HUGEINT) * r.c) AS BIGINT) AS score
  FROM f p JOIN f l ON l.lang = p.lang AND l.m < p.m AND l.g = p.g[1:l.m]
  JOIN f r ON r.lang = p.lang AND r.m = p.m - l.m AND r.g = p.g[l.m + 1:]
  JOIN totals t ON t.lang = p.lang),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS place FROM cuts),
covered AS (
  SELECT DISTINCT s.lang, s.g
  FROM (SELECT lang, m, c, g[i:i + sm - 1] AS sub
        FROM (SELECT *, unnest(range(1, m - sm + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS sm FROM f WHERE m > 2))) x
  JOIN f s ON s.lang = x.lang AND s.g = x.sub AND 100 * x.c >= 100 * s.c),
ranked AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank
  FROM lowest ANTI JOIN covered USING (lang, g) WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
