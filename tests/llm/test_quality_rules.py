import math
import re
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from subledger.llm import quality_rules as q

SF = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    words = [w for w in re.split("[ \t-\r]+", text) if w]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + o for i, g in enumerate(grams) if grams.count(g) > 1 for o in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^ \t-\r]", x)]
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


TEXTS = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "a a a a a", "x a b c y a b c z", "a b a b a b a", "ñ 東 # ñ 東 # |<>|", "l\nl\n\nm\n l\nl", "A B c\x0bD\x0ce\rf\x00g h"]


def test_counts_equal_brute_force(make_docs):
    rows = q.measure(make_docs([(i, t, "en", "s") for i, t in enumerate(TEXTS)])).collect()
    got = {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rows}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("p", [0.01, 0.3])
def test_binomial_tail_is_exact(spark, p):
    cases = [(k, n) for n in (1, 7, 50, 800, 3000) for k in (0, 1, 2, 5, 20, 100) if k < n * p]
    df = spark.createDataFrame(cases, "k long, n long")
    for r in df.select("k", "n", q.binomial_tail(F.col("k"), F.col("n"), p).alias("t")).collect():
        exact = sum(math.comb(r["n"], i) * Fraction(p) ** i * (1 - Fraction(p)) ** (r["n"] - i) for i in range(r["k"] + 1))
        assert math.isclose(r["t"], float(exact), rel_tol=1e-9, abs_tol=1e-300)


MEASURED = "doc_id long, stratum string, symbol_rate double, dup_line_rate double, repeat_rate double, upper_rate double, chars_per_word double"


def strictest(rows, level):
    """The strictest step of the fixed sequence, by exact arithmetic."""
    end = None
    for i, step in enumerate(q.STEPS):
        k = sum(any(r[rule] > cut for rule, cut in step.items()) for r in rows)
        if k >= len(rows) * q.RISK or sum(math.comb(len(rows), j) * q.RISK**j * (1 - q.RISK) ** (len(rows) - j) for j in range(k + 1)) > level:
            break
        end = i
    return end


@pytest.mark.parametrize("n", [60, 84, 100, 1000])
def test_cutoffs_are_the_strictest_admitted(spark, n):
    rows = [(i, lang, k / n / 2.4, 0.0, k / n / 2, 0.0, 5.0) for lang, at in (("en", 0), ("de", n)) for k, i in enumerate(range(at, at + n))]
    measured = spark.createDataFrame([r for r in rows if r[1] == "en"] + [(*r[:2], 0.0, 0.0, 0.0, 0.0, 5.0) for r in rows if r[1] == "de"], MEASURED)
    labels = spark.createDataFrame([(i, 1) for i in range(2 * n)], "doc_id long, quality int")
    got = {r["stratum"]: r for r in q.cutoffs(measured, labels).collect()}
    for lang in ("en", "de"):
        end = strictest([r for r in measured.collect() if r["stratum"] == lang], q.ALPHA / 2)
        assert (lang in got) == (end is not None)
        if end is not None:
            assert all(got[lang][f"max_{rule}"] == cut for rule, cut in q.STEPS[end].items())
    assert ("de" in got) == (n >= 84)


def test_steps_only_get_stricter():
    assert all(later[rule] <= step[rule] for step, later in zip(q.STEPS, q.STEPS[1:]) for rule in q.GRIDS)
    assert q.STEPS[0] == {r: g[0] for r, g in q.GRIDS.items()} and q.STEPS[-1] == {r: g[-1] for r, g in q.GRIDS.items()}


def test_too_few_labels_give_no_cutoffs(edge_docs, spark):
    labels = spark.createDataFrame([(6, 1), (7, 1)], "doc_id long, quality int")
    rows = q.judge(edge_docs, labels).collect()
    assert {r["failed_rules"] for r in rows} == {""} and all(r["kept"] != r["base_failed"] for r in rows)


def test_edges(edge_docs, no_docs, edge_rows, spark):
    labels = spark.createDataFrame([(6, 1, "x"), (None, 1, "x"), (7, None, "x")], "doc_id long, quality int, stratum string")
    rows = q.judge(edge_docs, labels).collect()
    assert len(rows) == len(edge_rows) and q.judge(no_docs, labels).count() == 0
    assert q.judge(edge_docs, labels.where("1 = 0")).where("kept").count() == sum(r["kept"] for r in rows)
    kept = q.keep(edge_docs, labels)
    assert kept.columns == edge_docs.columns and kept.count() == sum(r["kept"] for r in rows)
    assert q.keep(no_docs, labels).count() == 0


def test_native_plan(edge_docs, spark):
    labels = spark.createDataFrame([(6, 1)], "doc_id long, quality int")
    for df in (q.measure(edge_docs), q.keep(edge_docs, labels)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_sql_agrees_where_cutoffs_reject(make_docs, spark):
    """Languages with many good labels, so that steps are admitted and rows fail them."""
    import random
    rng = random.Random(8)
    rows = []
    for i in range(900):
        words = [rng.choice("abcdefghijklmnopqrst") * rng.randint(1, 9) for _ in range(70)]
        if i % 40 == 0:
            words = [w.upper() for w in words]
        if i % 33 == 0:
            words[::2] = ["#$%"] * 35
        rows.append((i, " ".join(words[:35]) + "\n" + " ".join(words[35:]) + "\nsame line\nsame line" * (i % 50 == 0), "en" if i % 3 else "de", "s"))
    docs, labels = make_docs(rows), spark.createDataFrame([(i, int(i % 40 != 0 and i % 33 != 0)) for i in range(0, 900, 2)], "doc_id long, quality int")
    got = q.judge(docs, labels)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "lang").toArrow())
    con.register("labels", labels.toArrow())
    want = con.sql(q.ORACLE)
    mine = [r.asDict() for r in got.collect()]
    assert sorted(map(str, mine)) == sorted(str(dict(zip(want.columns, r))) for r in want.fetchall())
    failed = [r["failed_rules"] for r in mine if r["failed_rules"]]
    assert len(failed) > 20 and len(set(failed)) > 1


def test_sql_agrees(spark):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    want = con.sql(q.ORACLE)
    rows = sorted(str(dict(zip(want.columns, r))) for r in want.fetchall())
    assert sorted(str(r.asDict()) for r in q.op2_quality_rules(spark, SF).collect()) == rows
