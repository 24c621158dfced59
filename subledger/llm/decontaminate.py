"""Benchmark decontamination: a BM25 inverted index of test items, searched
with block-max WAND for every training passage, then an overlap check.

Items are cut into sections of at most ``SECTION`` words, each a document of
the index. A section's BM25 weights are divided by their sum, so a passage's
score is the weighted share of the section's words that it holds, and one
threshold serves all sections. Documents are cut into passages of
``2 * SECTION`` words, each beginning ``SECTION`` words after the last, so any
section that occurs lies whole in some passage. Every passage is a query that
retrieves all sections at or above the threshold: terms' upper bounds find
the pivot, block maxima skip blocks that cannot reach it, and only what is
left is scored. A passage whose rare terms cannot lift it to the threshold
(the common terms' part of any section is bounded) ends before its first pivot.

Retrieved items are verified on the document's words around the passage: the
share of the question's and the answer's word windows found there. The answer
is the item's last sentence, the question what stands before it. Both are asked
for: half the question and half the answer, or most of the answer and a quarter
of the question; an item without an answer needs its question alone. A question
too short to tell anything (under ``WINDOW + 2`` words) before an answer is
verified by the windows of the whole item instead.

Items come in blocks of bounded text. Their sections and words are counted
over all items by Spark, so that weights and scores do not depend on the
blocks; a task a block writes its index to the shared folder, from where
scoring tasks read it.

Defined results: null or empty texts and items match nothing; equal scores all
count; repeated documents each give their rows, rows that repeat an item's id
and text count as one. Unlike texts of one id, and items without an id (reported
with a null item_id), are items of their own; an empty table gives an empty
result; only doc_id and text, and item_id and text, are read.
"""

from __future__ import annotations

import bisect
import functools
import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm.common import byte_rows, checkpointed, new_shared_path, table

SECTION = 32
THRESHOLD = 0.45
K1, B = 1.2, 0.75
WINDOW = 3
#: Shares of the question's and the answer's windows that verify a match.
QUESTION, ANSWER = 0.5, 0.8
#: The share of the answer's windows that must stand beside the question.
ANSWER_BESIDE = 0.5
#: Sections of a block, and cells (passages by blocks) that are bounded at a time.
BLOCK, CELLS = 4, 1 << 22
#: Characters of item text that one index holds, at most (and one item more).
ITEM_CHARS = 32 << 20

SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long"

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_SENTENCE = re.compile(rb"[.!?\n]+\s")


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORDS).split()


def question_and_answer(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """An item's words before its last sentence, and that sentence's; one sentence is all question."""
    ends = [m.end() for m in _SENTENCE.finditer(text.rstrip())]
    cut = ends[-1] if ends else len(text)
    question, answer = words_of(text[:cut]), words_of(text[cut:])
    return (question, answer) if question else (answer, [])


def sections_of(words: list[bytes]) -> list[Counter]:
    """An item's words in sections of equal size, the last perhaps shorter."""
    size = math.ceil(len(words) / max(1, math.ceil(len(words) / SECTION)))
    return [Counter(words[at:at + size]) for at in range(0, len(words), size)] if words else []


def windows(words: list[bytes]) -> set[tuple[bytes, ...]]:
    n = min(WINDOW, len(words))
    return set(zip(*(words[k:] for k in range(n)), strict=False)) if n else set()


def overlap(part: set[tuple[bytes, ...]], words: list[bytes]) -> float:
    """The share of a part's windows that stand in the words; 0 of an empty part."""
    if not part:
        return 0.0
    n = len(next(iter(part)))
    held = set(zip(*(words[k:] for k in range(n)), strict=False))
    return sum(w in held for w in part) / len(part)


@dataclass
class Postings:
    sections: list[int]  # in order
    weights: list[float]


@dataclass
class Index:
    """BM25 weights by term and section; ``ids`` has the items' ids and ``parts`` an item's question and answer
    windows, those that verify it, and its size, both by the item's place."""

    ids: list[int | None] = field(default_factory=list)
    terms: dict[bytes, int] = field(default_factory=dict)
    postings: list[Postings] = field(default_factory=list)
    item_of: list[int] = field(default_factory=list)
    parts: dict[int, tuple[set, set, set, int]] = field(default_factory=dict)
    #: By rarer term, its blocks and their maxima: those of term t are first[t] to first[t + 1]. By block, what common terms can add.
    first: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    blocks: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    maxima: np.ndarray = field(default_factory=lambda: np.zeros(0))
    common: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @classmethod
    def build(cls, items: list[tuple[int | None, bytes]], threshold: float = THRESHOLD, of_all: tuple[dict[bytes, int], int, float] | None = None) -> Index:
        """An index that finds every section at ``threshold`` or above. ``of_all``: by term the sections that
        hold it, the number of sections and their mean size, where these items are not all items."""
        index, sections = cls([item for item, _ in items]), []
        for item, (_, text) in enumerate(items):
            words = words_of(text)
            question, answer = question_and_answer(text)
            if not words:
                continue
            asked = windows(question)
            index.parts[item] = (asked, windows(answer), windows(words) if answer and len(question) < WINDOW + 2 else asked, len(words))
            own = sections_of(words)
            sections += own
            index.item_of += [item] * len(own)
        if not sections:
            return index
        df, n_sections, mean = of_all or (Counter(t for s in sections for t in s), len(sections), sum(s.total() for s in sections) / len(sections))
        lists: dict[bytes, list[tuple[int, float]]] = {t: [] for t in sorted({t for s in sections for t in s})}
        for k, section in enumerate(sections):
            norm = K1 * (1 - B + B * section.total() / mean)
            raw = {t: math.log1p((n_sections - df[t] + 0.5) / (df[t] + 0.5)) * n * (K1 + 1) / (n + norm) for t, n in section.items()}
            whole = sum(raw.values())
            for t, weight in raw.items():
                lists[t].append((k, weight / whole))
        for t, pairs in lists.items():
            index.terms[t] = len(index.postings)
            index.postings.append(Postings([k for k, _ in pairs], [w for _, w in pairs]))
        index._bound(df, threshold)
        return index

    def _bound(self, df: dict[bytes, int], threshold: float) -> None:
        """Most frequent terms are common as long as they make up at most half the threshold of every section."""
        share = np.zeros(-(-len(self.item_of) // BLOCK) * BLOCK)
        by_df: dict[int, list[int]] = {}
        for t, k in self.terms.items():
            by_df.setdefault(df[t], []).append(k)
        common: set[int] = set()
        for n in sorted(by_df, reverse=True):
            more = share.copy()
            for k in by_df[n]:
                more[self.postings[k].sections] += self.postings[k].weights
            if more.max() > threshold / 2:
                break
            share = more
            common.update(by_df[n])
        self.common = share.reshape(-1, BLOCK).max(axis=1)
        tops = []
        for k, own in enumerate(self.postings):
            found: dict[int, float] = {}
            for section, weight in zip(own.sections, own.weights, strict=True):
                found[section // BLOCK] = max(found.get(section // BLOCK, 0.0), weight)
            tops.append({} if k in common else found)
        self.first = np.cumsum([0] + [len(x) for x in tops])
        self.blocks = np.array([b for x in tops for b in x], np.int64)
        self.maxima = np.array([w for x in tops for w in x.values()])

    def candidates(self, ids: np.ndarray, passages: np.ndarray, n_passages: int, threshold: float) -> dict[int, list[int]]:
        """Blocks that can hold a section at the threshold, by passage, for terms and the passages they stand in."""
        rare = self.first[ids + 1] > self.first[ids]
        pairs = np.unique(passages[rare] * len(self.postings) + ids[rare])
        passage, term = np.divmod(pairs, len(self.postings))
        out: dict[int, list[int]] = {}
        step = max(1, CELLS // len(self.common))
        for at in range(0, n_passages, step):
            a, b = np.searchsorted(passage, [at, at + step])
            begin, sizes = self.first[term[a:b]], self.first[term[a:b] + 1] - self.first[term[a:b]]
            places = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begin, sizes)
            cells = np.repeat(passage[a:b] - at, sizes) * len(self.common) + self.blocks[places]
            bounds = np.bincount(cells, self.maxima[places], minlength=len(self.common))
            found = np.flatnonzero(bounds)
            found = found[bounds[found] + self.common[found % len(self.common)] >= threshold - 1e-9]
            for p, block in zip((found // len(self.common) + at).tolist(), (found % len(self.common)).tolist(), strict=True):
                out.setdefault(p, []).append(block)
        return out

    def search(self, terms: set[int], blocks: list[int], threshold: float) -> dict[int, float]:
        """The sections of these blocks whose score for the terms reaches the threshold, by WAND with block maxima as bounds."""
        found: dict[int, float] = {}
        reach = threshold - 1e-9
        for block in blocks:
            cursors = []  # section, place, end, postings, bound
            for t in terms:
                own = self.postings[t]
                at = bisect.bisect_left(own.sections, block * BLOCK)
                end = bisect.bisect_left(own.sections, (block + 1) * BLOCK, at)
                if at < end:
                    cursors.append([own.sections[at], at, end, own, max(own.weights[at:end])])
            while cursors:
                cursors.sort(key=lambda c: c[0])
                bound, pivot = 0.0, None
                for cursor in cursors:
                    bound += cursor[4]
                    if bound >= reach:
                        pivot = cursor[0]
                        break
                if pivot is None:
                    break
                if cursors[0][0] == pivot:
                    score = sum(c[3].weights[c[1]] for c in cursors if c[0] == pivot)
                    if score >= reach:
                        found[pivot] = score
                    pivot += 1
                for cursor in cursors:  # all that stand before the pivot go on to it
                    if cursor[0] < pivot:
                        cursor[1] = bisect.bisect_left(cursor[3].sections, pivot, cursor[1], cursor[2])
                        cursor[0] = cursor[3].sections[cursor[1]] if cursor[1] < cursor[2] else -1
                cursors = [c for c in cursors if c[0] >= 0]
        return found

    def matches(self, texts: list[bytes | None], threshold: float = THRESHOLD) -> Iterator[tuple[int, int | None, float, float, float, int]]:
        """Place of the text, item, best score, question and answer overlap and the passage's first word, for each verified item."""
        if not self.postings:
            return
        docs = [words_of(t) for t in texts]
        sizes = np.array([len(w) for w in docs])
        ids = np.fromiter((self.terms.get(w, -1) for words in docs for w in words), np.int64, int(sizes.sum()))
        counts = np.maximum(1, -(-sizes // SECTION) - 1)
        base = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(docs)), sizes)
        begin = np.cumsum(sizes) - sizes
        half = (np.arange(len(ids)) - begin[owner]) // SECTION
        last, before = base[owner] + np.minimum(half, counts[owner] - 1), base[owner] + np.maximum(half - 1, 0)
        known, both = ids >= 0, (ids >= 0) & (last != before)
        live = self.candidates(np.concatenate([ids[known], ids[both]]), np.concatenate([last[known], before[both]]), int(counts.sum()), threshold)
        best: dict[tuple[int, int], tuple[float, float, float, int]] = {}
        for passage, blocks in live.items():
            doc = int(np.searchsorted(base, passage, "right")) - 1
            start = (passage - int(base[doc])) * SECTION
            at = int(begin[doc]) + start
            terms = set(ids[at:min(at + 2 * SECTION, int(begin[doc] + sizes[doc]))].tolist()) - {-1}
            near: dict[int, float] = {}
            for section, score in self.search(terms, blocks, threshold).items():
                near[self.item_of[section]] = max(near.get(self.item_of[section], 0.0), score)
            for item, score in near.items():
                question, answer, telling, size = self.parts[item]
                around = docs[doc][max(0, start - size):start + 2 * SECTION + size]
                q, a = overlap(question, around), overlap(answer, around)
                asked = q if telling is question else overlap(telling, around)
                if asked >= QUESTION and (a >= ANSWER_BESIDE or not answer) or (a >= ANSWER and q >= QUESTION / 2):
                    best[doc, item] = max(best.get((doc, item), (-1.0, 0.0, 0.0, 0)), (score, q, a, -start))
        for (doc, item), (score, q, a, start) in sorted(best.items()):
            yield doc, self.ids[item], min(1.0, score), q, a, -start


def item_blocks(items: DataFrame, threshold: float = THRESHOLD) -> list[str]:
    """Index files of the items in blocks of bounded text: as many hash classes as their size asks for."""
    known = items.select("item_id", "text").where("text IS NOT NULL").distinct()
    chars = known.agg(F.sum(F.length("text"))).first()[0] or 0
    known = known.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(chars // ITEM_CHARS + 1)))

    def count(batches):
        for batch in batches:
            of_block = batch.column("block").to_pylist()
            for at, raw in byte_rows(batch, most=1 << 20):
                held: Counter = Counter()  # by block and term, the sections with it; by block and no term, all sections
                words: Counter = Counter()
                for block, text in zip(of_block[at:at + len(raw)], raw, strict=True):
                    own = sections_of(words_of(text))
                    held.update((block, t) for section in own for t in section)
                    held[block, None] += len(own)
                    words[block, None] += sum(section.total() for section in own)
                blocks, terms = zip(*held, strict=True)
                yield pa.record_batch([pa.array(blocks, pa.int64()), pa.array(terms, pa.binary()), pa.array(held.values(), pa.int64()), pa.array([words[k] for k in held], pa.int64())],
                                      ["block", "term", "sections", "words"])

    counted = known.select("block", "text").mapInArrow(count, "block long, term binary, sections long, words long")
    counted = checkpointed(counted.groupBy("block", "term").agg(F.sum("sections").alias("sections"), F.sum("words").alias("words")))
    n_sections, n_words = counted.where("term IS NULL").agg(F.sum("sections"), F.sum("words")).first()
    if not n_sections:
        return []
    terms = counted.where("term IS NOT NULL")
    terms = terms.select("block", "term").join(terms.groupBy("term").agg(F.sum("sections").alias("df")), "term")
    uri = new_shared_path(items.sparkSession, "items")
    uri = uri if "://" in uri or uri.startswith("file:") else f"file://{uri}"
    uri = uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri

    def write(key, part, own):
        texts = part.column("text").cast(pa.binary()).to_pylist()
        df = dict(zip(own.column("term").to_pylist(), own.column("df").to_pylist(), strict=True))
        index = Index.build(sorted(zip(part.column("item_id").to_pylist(), texts, strict=True), key=lambda x: (x[0] is None, x[0] or 0, x[1])), threshold, (df, n_sections, n_words / n_sections))
        if index.postings:
            write_index(uri, f"{key[0].as_py()}", index)
        return pa.table({"block": pa.array([key[0].as_py()] if index.postings else [], pa.int64())})

    built = known.groupBy("block").cogroup(terms.groupBy("block")).applyInArrow(write, "block long").collect()  # a row a block
    return [f"{uri}/{k}" for k in sorted(r["block"] for r in built)]


def write_index(uri: str, name: str, index: Index) -> None:
    fs, folder = pyarrow.fs.FileSystem.from_uri(uri)
    fs.create_dir(folder, recursive=True)
    own = f"{folder}/.{name}-{np.random.SeedSequence().entropy:x}"
    with fs.open_output_stream(own) as out:
        pickle.dump(index, out, protocol=pickle.HIGHEST_PROTOCOL)
    fs.move(own, f"{folder}/{name}")


@functools.lru_cache(maxsize=1)
def open_index(uri: str) -> Index:
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    with fs.open_input_file(path) as f:
        return pickle.loads(f.read_buffer())


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``docs`` and benchmark item verified in it."""
    out = None
    for block in item_blocks(items, threshold):
        def run(batches, block=block):
            index = open_index(block)
            for batch in batches:
                keys = batch.column("doc_id").to_pylist()
                for at, raw in byte_rows(batch, most=1 << 20):
                    rows = [(keys[at + k], *hit) for k, *hit in index.matches(raw, threshold)]
                    columns = list(zip(*rows, strict=True)) or [[]] * 6
                    types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "first_word"])

        found = docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], SCHEMA) if out is None else out


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` in which no item is verified, with all their columns; texts are not shuffled."""
    for block in item_blocks(items, threshold):
        def run(batches, block=block):
            index = open_index(block)
            for batch in batches:
                free = np.ones(len(batch), bool)
                for at, raw in byte_rows(batch, most=1 << 20):
                    free[[at + k for k, *_ in index.matches(raw, threshold)]] = False
                yield batch.filter(pa.array(free))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
