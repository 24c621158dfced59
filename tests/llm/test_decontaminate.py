import random

from llm_helpers import prose

from subledger.llm import decontaminate as d

ITEMS = [(k, prose(100 + k, 12 + 9 * k % 70) + ". " + prose(200 + k, 6) + ".") for k in range(40)]


def docs_with_plants():
    docs = [(k, prose(1000 + k, 40 + 37 * k % 400), "en", "s") for k in range(60)]
    for k in range(0, 40, 3):
        docs.append((500 + k, f"{prose(2000 + k, 11 * k % 90)} {ITEMS[k][1].upper() if k % 2 else ITEMS[k][1]} {prose(3000 + k, 50)}", "en", "s"))
    return docs


def test_planted_items_are_found_and_clean_documents_left(make_docs, spark):
    items = spark.createDataFrame([(*x, "clash") for x in ITEMS], "item_id long, text string, doc_id string")
    docs = make_docs(docs_with_plants())
    got = {(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, items).collect()}
    assert got == {(500 + k, k) for k in range(0, 40, 3)}
    kept = d.clean(docs, items)
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(60)) and kept.columns == docs.columns


def test_search_equals_plain_scoring():
    index = d.Index.build([(k, t.encode()) for k, t in ITEMS])
    import numpy as np
    rng, hits = random.Random(2), 0
    for _ in range(300):
        terms = set(rng.sample(range(len(index.postings)), 40))
        scores = {}
        for t in terms:
            for s, w in zip(index.postings[t].sections, index.postings[t].weights):
                scores[s] = scores.get(s, 0.0) + w
        for threshold in (0.45, 0.3, 0.2):
            want = {s for s, v in scores.items() if v >= threshold - 1e-9}
            ids = np.array(sorted(terms))
            blocks = index.candidates(ids, np.zeros(len(ids), np.int64), 1, threshold).get(0, [])
            assert set(index.search(terms, blocks, threshold)) == want
            hits += len(want)
    assert hits > 100


def test_items_in_blocks_are_all_searched(make_docs, spark, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = make_docs(docs_with_plants())
    monkeypatch.setattr(d, "ITEM_CHARS", 1500)
    assert len(list(d.item_blocks(items))) > 2
    got = {(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, items).collect()}
    assert got == {(500 + k, k) for k in range(0, 40, 3)}


def test_question_and_answer():
    assert d.question_and_answer(b"What is it? It is so.") == ([b"what", b"is", b"it"], [b"it", b"is", b"so"])
    assert d.question_and_answer(b"one sentence") == ([b"one", b"sentence"], [])
    assert d.question_and_answer(b"") == ([], [])


def test_edges(edge_docs, no_docs, spark):
    items = spark.createDataFrame([(1, None), (2, ""), (None, "x y z"), (3, "short item"), (3, "short item"), (4, prose(1, 80))], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in d.contaminated(edge_docs, items).collect())
    assert got == [(6, 4), (6, 4), (7, 4)]
    assert d.contaminated(no_docs, items).count() == 0
    assert d.contaminated(edge_docs, items.where("1 = 0")).count() == 0 and d.clean(edge_docs, items.where("1 = 0")).count() == edge_docs.count()


def test_a_low_threshold_is_reached_by_common_terms_alone(make_docs, spark):
    questions = ["one two three four five six seven eight nine ten", "uno dos tres cuatro cinco seis siete ocho nueve diez"]
    items = spark.createDataFrame([(k, f"{questions[k % 2]} {' '.join(f'rare{k}x{n}' for n in range(4))}") for k in range(40)], "item_id long, text string")
    docs = make_docs([(1, f"{prose(1, 20)} {questions[0]}", "en", "s"), (2, prose(2, 30), "en", "s")])
    assert {(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, items, 0.1).collect()} == {(1, k) for k in range(0, 40, 2)}
    assert [r["doc_id"] for r in d.clean(docs, items, 0.1).collect()] == [2]
    assert d.contaminated(docs, items).count() == 0


def test_a_short_question_alone_verifies_nothing(make_docs, spark):
    answer = [f"answer{k}" for k in range(22)]
    items = spark.createDataFrame([(1, f"Why? {' '.join(answer)}."), (2, "Why not? Because."), (3, prose(3, 40))], "item_id long, text string")
    mixed = " ".join(answer[::2] + answer[::-2])
    docs = make_docs([(1, f"{prose(1, 9)} why {mixed}", "en", "s"), (2, f"{prose(2, 9)} why {' '.join(answer)} {prose(4, 9)}", "en", "s"),
                      (3, f"{prose(5, 9)} why {' '.join(answer[:18])} {prose(6, 9)}", "en", "s"), (4, f"{prose(7, 9)} Why not? Because.", "en", "s")])
    assert {(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, items).collect()} == {(2, 1), (3, 1), (4, 2)}
    assert [r["doc_id"] for r in d.clean(docs, items).collect()] == [1]


def test_blocks_change_no_score(make_docs, spark, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    altered = [(k, " ".join(w if n % 9 or n < 9 else "other" for n, w in enumerate(t.split()))) for k, t in ITEMS]
    docs = make_docs([(k, f"{prose(4000 + k, 20)} {t} {prose(5000 + k, 20)}", "en", "s") for k, t in altered])

    def rows():
        return sorted((r["doc_id"], r["item_id"], round(r["score"], 9), r["question_overlap"], r["answer_overlap"], r["first_word"]) for r in d.contaminated(docs, items).collect())

    whole = rows()
    monkeypatch.setattr(d, "ITEM_CHARS", 1500)
    assert rows() == whole and any(r[2] < 1 for r in whole)


def test_no_item_is_lost_and_the_answer_is_asked_for(make_docs, spark):
    one, other, nameless = ((prose(k, 30), prose(k + 1, 14)) for k in (7000, 7010, 7020))
    items = spark.createDataFrame([(7, f"{one[0]}. {one[1]}."), (7, f"{other[0]}. {other[1]}."), (7, f"{other[0]}. {other[1]}."), (None, f"{nameless[0]}. {nameless[1]}.")],
                                  "item_id long, text string")
    docs = make_docs([
        (1, f"{prose(1, 30)} {one[0]} {one[1]} {prose(2, 30)}", "en", "s"), (2, f"{other[0]} {other[1]}", "en", "s"), (3, f"{nameless[0]}. {nameless[1]}", "en", "s"),
        (4, f"{one[0]} {prose(7050, 14)}", "en", "s"),  # the question with another answer
        (5, f"{one[0]} {' '.join(one[1].split()[:9])} {prose(8, 9)}", "en", "s"), (6, prose(7060, 60), "en", "s"), (None, f"{other[0]} {other[1]}", "en", "s")])
    got = sorted(((r["doc_id"], r["item_id"]) for r in d.contaminated(docs, items).collect()), key=str)
    assert got == [(1, 7), (2, 7), (3, None), (5, 7), (None, 7)]
    assert sorted(r["doc_id"] for r in d.clean(docs, items).collect()) == [4, 6]
