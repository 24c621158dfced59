"""Quality classifier: naive Bayes support vectors.

Indicators of hashed byte n-grams, of n-grams of the words' distances to their
last occurrence (which show repetition whatever the words are) and of the
text's length and share of repeated words are scaled by the classes' log-count ratios; a linear hinge-loss model is fitted on them by dual coordinate
descent, in one task over a bounded sample (at most ``PER_CLASS`` labelled
rows of each class, chosen by a hash of their keys among those whose text is there; a row of it is one bit a
feature, so the sample's bytes are bounded too). A fifth of the sample is
left out of the fit and turns margins into probabilities. Every row's whole
text is scored with the broadcast weights (one number a feature).

Defined results: null texts score as empty ones, by the bias and an empty text's two shape features; a key
whose labels disagree, or are null, teaches nothing; with no label of one
class every row gets the other's score (0.5 with no labels at all); repeated
rows give repeated results; an empty table gives an empty result; only doc_id
and text, and the labels' doc_id and quality, are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm.common import byte_rows, crc_fold, table

BITS = 17
FEATURES = 1 << BITS
ORDERS = 3
#: Rows of each class in the training sample, at most.
PER_CLASS = 2000
COST, EPOCHS, SMOOTHING = 1.0, 12, 1.0
PIECE = 1 << 20
#: Distances to a word's last occurrence: 0 none, then 1, 2, 3-4, 5-8, ... up to NEAR words back.
NEAR, WORD_ORDERS = 64, 3

SCHEMA = "doc_id long, score double, predicted int"


class Marker:
    """Finds the distinct features of one text at a time, in memory that does not grow with the text."""

    def __init__(self) -> None:
        self.flags = np.zeros(FEATURES, bool)

    def features(self, text: bytes | None) -> np.ndarray:
        text = text or b""
        for at in range(0, len(text), PIECE):
            codes = np.frombuffer(text[max(0, at - ORDERS + 1):at + PIECE], np.uint8).astype(np.uint32)
            mixed = np.zeros(len(codes), np.uint32)
            for order in range(min(ORDERS, len(codes))):
                mixed = (mixed[order > 0:] + codes[:len(codes) - order] + np.uint32(1)) * np.uint32(0x9E3779B1)
                spread = mixed ^ (mixed >> np.uint32(15))
                self.flags[(spread * np.uint32(0xC2B2AE35) + np.uint32(order * 0x27D4EB2F)) >> np.uint32(32 - BITS)] = True
        self.flags[self._shape(text)] = True
        found = np.flatnonzero(self.flags)
        self.flags[found] = False
        return found

    @staticmethod
    def _shape(text: bytes) -> np.ndarray:
        """Features of the repetition and the length of a text."""
        last: dict[bytes, int] = {}
        back = []
        for i, word in enumerate(text.split()):
            back.append(i - last.get(word, -NEAR - 1))
            last[word] = i
        steps = np.array(back, np.int64)
        kinds = np.where(steps <= NEAR, np.ceil(np.log2(np.maximum(steps, 1))).astype(np.int64) + 1, 0)
        share = int(10 * np.count_nonzero(kinds) / max(1, len(kinds)))
        codes = [np.array([share, 16 + len(text).bit_length()])]
        mixed = np.zeros(len(kinds), np.int64)
        for order in range(min(WORD_ORDERS, len(kinds))):
            mixed = mixed[order > 0:] * 16 + kinds[order:]
            codes.append(mixed + (64 << 4 * (order + 1)))
        return (np.concatenate(codes).astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


@dataclass
class Model:
    weights: np.ndarray  # of the indicators, ratios included
    bias: float
    slope: float
    offset: float

    def score(self, found: np.ndarray) -> float:
        margin = self.bias + (float(self.weights[found].sum()) / math.sqrt(len(found)) if len(found) else 0.0)
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, self.slope * margin + self.offset))))


def descend(rows: list[np.ndarray], signs: np.ndarray, cost: float = COST, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss over rows of feature numbers; log-count ratios included."""
    ratio = np.zeros(FEATURES)
    for sign in (1, -1):
        held = np.full(FEATURES, SMOOTHING)
        for row, own in zip(rows, signs, strict=True):
            if own == sign:
                held[row] += 1
        ratio += sign * np.log(held / held.sum())
    values = [ratio[row] / math.sqrt(max(1, len(row))) for row in rows]
    squares = [float(v @ v) + 1 for v in values]
    weights, bias, dual = np.zeros(FEATURES), 0.0, np.zeros(len(rows))
    deal = np.random.default_rng(0)
    for _ in range(epochs):
        worst = 0.0
        for i in deal.permutation(len(rows)):
            slope = signs[i] * (float(weights[rows[i]] @ values[i]) + bias) - 1
            new = min(max(dual[i] - slope / squares[i], 0.0), cost)
            if new != dual[i]:
                step = (new - dual[i]) * signs[i]
                worst = max(worst, abs(step))
                weights[rows[i]] += step * values[i]
                bias += step
                dual[i] = new
        if worst < 1e-4:
            break
    return weights * ratio, bias


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through margins, by Newton steps, with smoothed targets."""
    good, bad = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    design = np.stack([margins, np.ones(len(margins))], axis=1)
    best = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ best, -30, 30)))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (target - p) - 1e-3 * (best - [1.0, 0.0]))
        best = best + np.clip(step, -2, 2)
        if abs(step).max() < 1e-8:
            break
    return float(max(best[0], 1e-6)), float(best[1])


def train(rows: list[np.ndarray], labels: list[int], folds: list[int]) -> Model:
    """Fit on the rows of folds 1 to 4, calibrate on those of fold 0."""
    truth = np.array(labels)
    if len(set(labels)) < 2:
        return Model(np.zeros(FEATURES), 0.0, 0.0, 0.0 if not labels else 4.0 if labels[0] else -4.0)
    apart = np.array(folds) == 0
    if len(set(truth[~apart])) < 2 or len(set(truth[apart])) < 2:  # too few: fit and calibrate on all
        fit_on, check_on = np.arange(len(rows)), np.arange(len(rows))
    else:
        fit_on, check_on = np.flatnonzero(~apart), np.flatnonzero(apart)
    weights, bias = descend([rows[i] for i in fit_on], np.where(truth[fit_on] == 1, 1, -1))
    model = Model(weights, bias, 1.0, 0.0)
    margins = np.array([bias + (weights[rows[i]].sum() / math.sqrt(len(rows[i])) if len(rows[i]) else 0.0) for i in check_on])
    model.slope, model.offset = calibrate(margins, truth[check_on])
    return model


def training_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id and label of at most ``per_class`` keys of each class that ``docs`` has, by a hash of the key."""
    agreed = labels.select("doc_id", F.col(label).cast("int").alias("label")).groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_most"))
    agreed = agreed.where("label = _most AND label IN (0, 1) AND doc_id IS NOT NULL").drop("_most")
    agreed = agreed.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [agreed.where(F.col("label") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    return chosen[0].unionByName(chosen[1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Model:
    """Train on a bounded sample of ``labels`` (doc_id, ``label``) and the texts of ``docs``.

    The sample's keys (at most two classes of ``per_class`` rows) are broadcast;
    a repeated key trains with its smallest text by hash, so that one hot key cannot fill the sample.
    """
    sample = training_sample(docs, labels, label, per_class)

    def mark(batches):
        marker = Marker()
        for batch in batches:
            keys, own = batch.column("doc_id"), batch.column("label")
            for at, raw in byte_rows(batch):
                bits = []
                for text in raw:
                    flags = np.zeros(FEATURES, bool)
                    flags[marker.features(text)] = True
                    bits.append(np.packbits(flags).tobytes())
                yield pa.record_batch([keys.slice(at, len(raw)), own.slice(at, len(raw)), pa.array(bits, pa.binary())], ["doc_id", "label", "bits"])

    def learn(batches):
        found: dict[int, tuple[bytes, int]] = {}
        for batch in batches:
            for key, own, bits in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "label", "bits")), strict=True):
                found[key] = min(found.get(key, (bits, own)), (bits, own))
        keys = sorted(found)
        rows = [np.flatnonzero(np.unpackbits(np.frombuffer(found[k][0], np.uint8))) for k in keys]
        model = train(rows, [found[k][1] for k in keys], [i % 5 for i in range(len(keys))])
        yield pa.record_batch(
            [pa.array([model.weights.astype(np.float32).tobytes()], pa.binary()), *(pa.array([x], pa.float64()) for x in (model.bias, model.slope, model.offset))],
            ["weights", "bias", "slope", "offset"])

    marked = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text").mapInArrow(mark, "doc_id long, label int, bits binary")
    distinct = marked.groupBy("doc_id").agg(F.min(F.struct("bits", "label")).alias("x")).select("doc_id", "x.label", "x.bits")
    got = distinct.repartition(1).mapInArrow(learn, "weights binary, bias double, slope double, offset double").first()
    if got is None:
        return train([], [], [])
    return Model(np.frombuffer(got["weights"], np.float32), got["bias"], got["slope"], got["offset"])


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and predicted of every row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        marker = Marker()
        for batch in batches:
            for at, raw in byte_rows(batch):
                scores = np.array([shared.value.score(marker.features(text)) for text in raw])
                yield pa.record_batch(
                    [batch.column("doc_id").slice(at, len(raw)), pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32), pa.int32())],
                    ["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the classifier predicts to be good, with all their columns; texts are not shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        marker = Marker()
        for batch in batches:
            good = [shared.value.score(marker.features(text)) >= 0.5 for _, raw in byte_rows(batch) for text in raw]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(key: Column) -> Column:
    return crc_fold(key, 3) == 1


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.where(~held_out(F.col("doc_id"))))
    return classify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
