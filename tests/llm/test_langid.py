import numpy as np
from pyspark.sql import functions as F
from llm_helpers import prose

from subledger.llm import langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = langid.op7_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out AND lang IS NOT NULL").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert rows[0] > 0.97 and 0 <= rows[1] <= rows[2] <= 1


def test_counts_equal_brute_force(monkeypatch):
    texts = ["abcabd" * 40, "", "x", "a\0bc", "ñandú 東京"]

    def of(text):
        parts = [list(langid.features(p)[0]) for _, p in langid.pieces([text])]
        return sorted(f for part in parts for order in part for f in order.tolist() if f != langid.FEATURES)

    whole = [of(t) for t in texts]
    assert [len(w) for w in whole] == [sum(max(0, len(run) - k) for run in t.split("\0") for k in range(3)) for t in texts]
    monkeypatch.setattr(langid, "PIECE", 7)  # n-grams across cuts count as well
    assert [of(t) for t in texts] == whole


def test_scores_equal_plain_sums():
    rng = np.random.default_rng(0)
    matrix = np.vstack([rng.normal(size=(langid.FEATURES, 3)), np.zeros((1, 3))])
    model = langid.Model(["a", "b", "c"], np.log(np.array([0.2, 0.3, 0.5])), matrix)
    texts = [prose(k, 5 + k) for k in range(20)] + [None, "", "123 !?", "é"]
    labels, scores = model.predict(texts)
    for text, label, score in zip(texts, labels, scores):
        if text is None or not any(map(str.isalpha, text)):
            assert (label, score) == ("und", 0.0)
            continue
        sums = model.prior + sum(matrix[order].sum(axis=0) for _, p in langid.pieces([text]) for order in langid.features(p)[0])
        assert label == "abc"[sums.argmax()] and abs(score - np.exp(sums - sums.max()).max() / np.exp(sums - sums.max()).sum()) < 1e-9


def test_edges(edge_docs, no_docs, edge_rows):
    model = langid.fit(edge_docs)
    assert model.langs == ["de", "en"]
    rows = langid.identify(edge_docs, model).collect()
    assert len(rows) == len(edge_rows)
    assert {r["doc_id"]: r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3, 10)} == dict.fromkeys((1, 2, 3, 10), "und")
    nothing = langid.fit(no_docs)
    assert nothing.langs == [] and {r["lang_pred"] for r in langid.identify(edge_docs, nothing).collect()} == {"und"}
    assert langid.identify(no_docs, model).count() == 0


def test_more_languages_than_a_matrix_holds(spark):
    """Blocks of languages give the labels and scores of one matrix, ties to the first language included."""
    rows = [(k, prose(k % 7, 30), f"l{k % 7}") for k in range(70)] + [(k, prose(3, 30), "l3 too") for k in range(70, 80)]  # l3 and its twin tie
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    whole, blocks = langid.fit(docs), langid.fit(docs, block=3)
    assert isinstance(whole, langid.Model) and (blocks.count, len(whole.langs)) == (3, 8)
    assert [blocks.read(k).langs for k in range(3)] == [whole.langs[:3], whole.langs[3:6], whole.langs[6:]]
    asked = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(100, None), (101, "12 !"), (102, "")], "doc_id long, text string"))
    one, many = ({r["doc_id"]: r for r in langid.identify(asked, m).collect()} for m in (whole, blocks))
    assert len(one) == 83 and {k: r["lang_pred"] for k, r in one.items()} == {k: r["lang_pred"] for k, r in many.items()}
    assert max(abs(one[k]["score"] - many[k]["score"]) for k in one) < 1e-6
    assert one[100]["lang_pred"] == "und" and many[100]["score"] == 0.0
    counts = {tuple(r) for r in langid.count_ngrams(docs, 1).collect()}
    assert counts == {tuple(r) for r in langid.count_ngrams(docs).collect()}
