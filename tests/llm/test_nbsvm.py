import numpy as np
from pyspark.sql import functions as F
from llm_helpers import prose

from subledger.llm import nbsvm

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = nbsvm.op4_quality_classifier(spark, SF).where("held_out").join(labels, "doc_id").groupBy("quality").agg(F.avg("predicted").alias("good"), F.min("score"), F.max("score")).collect()
    good = {r["quality"]: r["good"] for r in rows}
    assert good[1] > 0.99 and good[0] < 0.1
    assert all(0 <= r[2] <= r[3] <= 1 for r in rows)


def test_descent_reaches_the_hinge_optimum():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 60, 12)) for _ in range(80)]
    signs = np.where([5 in r or 7 in r for r in rows], 1, -1)
    weights, bias = nbsvm.descend(rows, signs, epochs=300)
    ratio = np.zeros(nbsvm.FEATURES)
    for sign in (1, -1):
        held = np.full(nbsvm.FEATURES, nbsvm.SMOOTHING)
        for r, s in zip(rows, signs):
            held[r] += s == sign
        ratio += sign * np.log(held / held.sum())
    used = np.flatnonzero(ratio[:60])
    design = np.array([[ratio[k] / np.sqrt(len(r)) if k in r else 0.0 for k in used] + [1.0] for r in rows])
    found = np.append(weights[used] / ratio[used], bias)

    def primal(w):
        return 0.5 * w @ w + nbsvm.COST * np.maximum(0, 1 - signs * (design @ w)).sum()

    best = primal(found)
    for _ in range(300):
        assert primal(found + rng.normal(scale=0.02, size=len(found))) >= best - 1e-2


def test_features_do_not_depend_on_cuts(monkeypatch):
    marker = nbsvm.Marker()
    text = prose(4, 300).encode()
    whole = marker.features(text).tolist()
    monkeypatch.setattr(nbsvm, "PIECE", 50)
    assert marker.features(text).tolist() == whole and len(marker.features(None)) > 0


def test_edges(spark, edge_docs, no_docs, edge_rows):
    schema = "doc_id long, quality int, toxic int, text string, label int"
    labels = spark.createDataFrame([(1, 0, 0, "x", 1), (2, 0, 0, "x", 1), (6, 1, 0, "x", 1), (8, 1, None, "x", 1), (7, 1, 0, "x", 0), (7, 0, 0, "x", 0), (9, None, 0, "x", 1), (None, 1, 0, "x", 1)], schema)
    model = nbsvm.fit(edge_docs, labels)
    rows = nbsvm.classify(edge_docs, model).collect()
    assert len(rows) == len(edge_rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    got = {r["doc_id"]: r["predicted"] for r in rows}
    assert (got[1], got[2], got[6], got[8]) == (0, 0, 1, 1)
    none = labels.where("1 = 0")
    assert {r["score"] for r in nbsvm.classify(edge_docs, nbsvm.fit(edge_docs, none)).collect()} == {0.5}
    one = nbsvm.fit(edge_docs, labels.where("quality = 1 AND doc_id <> 7"))
    assert {r["predicted"] for r in nbsvm.classify(edge_docs, one).collect()} == {1}
    assert nbsvm.classify(no_docs, model).count() == 0 and nbsvm.keep(no_docs, model).count() == 0
    kept = nbsvm.keep(edge_docs, model)
    assert kept.columns == edge_docs.columns and kept.count() == sum(r["predicted"] for r in rows)


def test_keys_without_documents_do_not_use_up_the_sample(spark, make_docs):
    docs = make_docs([(k, prose(k, 60) if k < 10 else "buy now " * 40, "en", "s") for k in range(20)])
    labels = spark.createDataFrame([(k, int(k < 10)) for k in range(20)] + [(1000 + k, k % 2) for k in range(400)], "doc_id long, quality int")
    assert {tuple(r) for r in nbsvm.training_sample(docs, labels, "quality", 10).collect()} == {(k, int(k < 10)) for k in range(20)}
    model = nbsvm.fit(docs, labels, per_class=10)
    assert {r["doc_id"]: r["predicted"] for r in nbsvm.classify(docs, model).collect()} == {k: int(k < 10) for k in range(20)}
