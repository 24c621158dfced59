"""Language ID: multinomial naive Bayes over hashed character n-grams.

Every training row's whole text is counted: tasks count n-grams by language
in numpy and Spark sums them. The matrix of log probabilities (features by
languages) is broadcast; tasks score batches as a sparse product, gathering
the rows of the n-grams that occur and summing them by document.

The broadcast matrix holds at most ``BLOCK`` languages (49 153 numbers each).
Where the column has more distinct values, tasks write the matrices of blocks
of so many languages, in their order, to the shared folder, and scoring tasks
read one after the other, carrying on each text's best label, its sum and the
total odds: the results are those of one matrix, memory is that of one block,
and the work grows with the number of languages, as it must.

Defined results: a text that is null or has no letter is ``und`` with score 0,
and so is every text when nothing was learned; equal scores go to the first
language in order; null languages teach nothing; repeated rows count again;
an empty table gives an empty result; only doc_id, text and lang are read.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm.common import byte_rows, checkpointed, crc_fold, new_shared_path, table
from subledger.operators.ordinals import with_ordinals

ORDERS = 3
BITS = 14
FEATURES = ORDERS << BITS
ALPHA = 0.1
#: Characters of a text taken at a time; n-grams across such cuts count too.
PIECE = 1 << 20
#: Languages of a matrix (50 MB), and of which a counting task holds counts before it hands them on.
BLOCK = 128

SCHEMA = "doc_id long, lang_pred string, score double"


def pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Runs of about PIECE characters: (owner of each part, parts). Each part begins with two
    characters that only give context: the text's previous ones, or two NULs."""
    owners, parts, size = [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text)), PIECE):
            owners.append(i)
            parts.append((text[at - 2:at] if at else "\0\0") + text[at:at + PIECE])
            size += len(parts[-1])
            if size >= PIECE:
                yield owners, parts
                owners, parts, size = [], [], 0
    if parts:
        yield owners, parts


def features(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each order a row: the feature of the n-gram that ends at each character (FEATURES: none); the parts' starts."""
    codes = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
    starts = np.cumsum([0] + [len(p) for p in parts[:-1]])
    live = codes != 0
    live_end = live.copy()
    live_end[starts] = live_end[starts + 1] = False
    out = np.full((ORDERS, len(codes)), FEATURES, np.int32)
    mixed, whole = np.zeros(len(codes), np.uint32), np.ones(len(codes), bool)
    for order in range(ORDERS):
        if order:
            mixed[order:] = (mixed[order:] + codes[:-order]) * np.uint32(0x85EBCA6B)
            whole[order:] &= live[:-order]
            whole[:order] = False
        else:
            mixed = codes * np.uint32(0x9E3779B1)
        spread = mixed ^ (mixed >> np.uint32(15))
        buckets = ((spread * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)).astype(np.int32) + (order << BITS)
        np.copyto(out[order], buckets, where=whole & live_end)
    return out, starts


@dataclass
class Model:
    langs: list[str]
    prior: np.ndarray
    matrix: np.ndarray  # (FEATURES + 1) x languages; the last row is zero

    def sums(self, known: list[str]) -> np.ndarray:
        """Log probabilities of these texts (rows) with each language."""
        sums = np.tile(self.prior, (len(known), 1))
        step = max(1, (1 << 22) // len(self.langs))
        for owners, parts in pieces([t.lower() for t in known]):
            ends, starts = features(parts)
            for at in range(0, ends.shape[1], step):
                stop = min(at + step, ends.shape[1])
                block = np.take(self.matrix, ends[0, at:stop], axis=0, mode="clip")
                for order in range(1, ORDERS):
                    block += np.take(self.matrix, ends[order, at:stop], axis=0, mode="clip")
                first = int(np.searchsorted(starts, at, "right")) - 1
                cuts = np.append(at, starts[first + 1:np.searchsorted(starts, stop)]) - at
                np.add.at(sums, owners[first:first + len(cuts)], np.add.reduceat(block, cuts, axis=0))
        return sums

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        labels, scores, known = _unknown(texts)
        if not self.langs or not known:
            return labels, scores
        sums = self.sums([texts[i] for i in known])
        best = sums.argmax(axis=1)
        odds = np.exp(sums - sums[np.arange(len(known)), best][:, None]).sum(axis=1)
        for k, i in enumerate(known):
            labels[i], scores[i] = self.langs[best[k]], float(1 / odds[k])
        return labels, scores


@dataclass
class Blocks:
    """A model of more languages than one matrix holds: where the blocks' models lie. Small."""

    uri: str
    count: int

    def read(self, block: int) -> Model:
        fs, folder = pyarrow.fs.FileSystem.from_uri(self.uri)
        with fs.open_input_file(f"{folder}/block-{block}") as f:
            return pickle.load(f)  # noqa: S301 (written by this run's own tasks)

    def write(self, block: int, model: Model) -> None:
        """Under a name of its own first: a retried task writes the same again."""
        fs, folder = pyarrow.fs.FileSystem.from_uri(self.uri)
        fs.create_dir(folder, recursive=True)
        own = f"{folder}/.block-{block}-{uuid.uuid4().hex}"
        with fs.open_output_stream(own) as out:
            out.write(pickle.dumps(model))
        fs.move(own, f"{folder}/block-{block}")

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        labels, scores, known = _unknown(texts)
        if not known:
            return labels, scores
        asked = [texts[i] for i in known]
        best, total = np.full(len(known), -np.inf), np.full(len(known), -np.inf)
        for block in range(self.count):
            model = self.read(block)
            sums = model.sums(asked)
            top = sums.argmax(axis=1)
            most = sums[np.arange(len(known)), top]
            total = np.logaddexp(total, most + np.log(np.exp(sums - most[:, None]).sum(axis=1)))
            for k in np.flatnonzero(most > best).tolist():
                labels[known[k]] = model.langs[top[k]]
            best = np.maximum(best, most)
        for k, i in enumerate(known):
            scores[i] = float(np.exp(best[k] - total[k]))
        return labels, scores


def _unknown(texts: list[str | None]) -> tuple[list[str], list[float], list[int]]:
    """Labels and scores of texts without a letter, for all; the places of the others."""
    known = [i for i, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))]
    return ["und"] * len(texts), [0.0] * len(texts), known


def count_ngrams(df: DataFrame, most: int = BLOCK) -> DataFrame:
    """lang, feature (-1: documents), n over all rows of ``df`` (text, lang); a task holds ``most`` languages at a time."""
    def parts_of(counts: dict[str, np.ndarray], docs: dict[str, int]) -> Iterator[pa.RecordBatch]:
        for lang, held in counts.items():
            seen = np.flatnonzero(held[:-1])
            yield pa.record_batch(
                [pa.array([lang] * (len(seen) + 1), pa.string()), pa.array(np.append(seen, -1), pa.int32()), pa.array(np.append(held[seen], docs[lang]), pa.int64())],
                ["lang", "feature", "n"])

    def run(batches):
        counts: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for at, raw in byte_rows(batch):
                own = langs[at:at + len(raw)]
                for lang in set(own):
                    if len(counts) >= most and lang not in counts:
                        yield from parts_of(counts, docs)
                        counts, docs = {}, {}
                    texts = [t.decode("utf-8", "replace").lower() for t, x in zip(raw, own, strict=True) if x == lang and t is not None]
                    docs[lang] = docs.get(lang, 0) + len(texts)
                    held = counts.setdefault(lang, np.zeros(FEATURES + 1, np.int64))
                    for _, parts in pieces(texts):
                        held += np.bincount(features(parts)[0].ravel(), minlength=FEATURES + 1)
        yield from parts_of(counts, docs)

    parts = df.select("text", "lang").where("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(run, "lang string, feature int, n long")
    return parts.groupBy("lang", "feature").agg(F.sum("n").alias("n"))


def model_of(langs: np.ndarray, features_: np.ndarray, n: np.ndarray, all_docs: int) -> Model:
    """The model of some languages from their counts (feature -1: documents), of ``all_docs`` documents in all."""
    column, names = pd.factorize(langs, sort=True)
    names = names.tolist()
    matrix, prior = np.zeros((FEATURES + 1, len(names))), np.zeros(len(names))
    for k in range(len(names)):
        own, counted = features_[column == k], n[column == k]
        held = np.zeros(FEATURES)
        held[own[own >= 0]] = counted[own >= 0]
        matrix[:-1, k] = np.log((held + ALPHA) / (held.sum() + ALPHA * FEATURES))
        prior[k] = np.log(counted[own < 0].sum() / all_docs)
    return Model(names, prior, matrix)


def fit(df: DataFrame, block: int = BLOCK) -> Model | Blocks:
    """Train on all rows of ``df``. What reaches the driver is one matrix of at most ``block`` languages, or nothing of the blocks."""
    spark = df.sparkSession
    uri = new_shared_path(spark, "langid")
    uri = uri if ":" in uri else f"file://{uri}"
    uri = uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri
    count_ngrams(df, block).write.parquet(f"{uri}/counts")
    counts = spark.read.schema("lang string, feature int, n long").parquet(f"{uri}/counts")
    docs = counts.where("feature < 0")  # a row a language
    langs, all_docs = docs.agg(F.count(F.lit(1)), F.sum("n")).first()
    if langs <= block:
        held = counts.toPandas()
        return model_of(held["lang"].to_numpy(object), held["feature"].to_numpy(), held["n"].to_numpy(), all_docs)
    made = Blocks(f"{uri}/blocks", -(-langs // block))
    numbered = with_ordinals(docs.select("lang"), [], [F.col("lang")], "place", checkpointed)
    numbered = numbered.select("lang", F.floor(F.col("place") / block).cast("long").alias("block"))

    def build(key, part):
        which = key[0].as_py()
        made.write(which, model_of(*(part.column(c).to_numpy(zero_copy_only=False) for c in ("lang", "feature", "n")), all_docs))
        return pa.table({"block": pa.array([which], pa.int64())})

    counts.join(numbered, "lang").groupBy("block").applyInArrow(build, "block long").agg(F.count(F.lit(1))).first()
    return made


def identify(df: DataFrame, model: Model | Blocks) -> DataFrame:
    """doc_id, lang_pred and score (the posterior) of every row's whole text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for at, raw in byte_rows(batch):
                labels, scores = shared.value.predict([None if t is None else t.decode("utf-8", "replace") for t in raw])
                yield pa.record_batch([batch.column("doc_id").slice(at, len(raw)), pa.array(labels, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return df.select("doc_id", "text").mapInArrow(run, SCHEMA)


def held_out(key: Column) -> Column:
    return crc_fold(key, 3) == 1


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
