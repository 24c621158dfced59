import re

import duckdb

from subledger.llm import preferences as p

SF = "/root/testdata/sf0.001"


def render(turns):
    return "".join(f"<|im_start|>{r or ''}\n{(t or '').replace('<|', '< |')}<|im_end|>\n" for r, t in turns)


def brute(chosen, rejected):
    same = lambda a, b: (a[0] or "", a[1] or "") == (b[0] or "", b[1] or "")
    n = 0
    while n < min(len(chosen), len(rejected)) and same(chosen[n], rejected[n]):
        n += 1
    return n, render(chosen[:n]), render(chosen[n:]), render(rejected[n:])


PAIRS = [
    ([("user", "q"), ("assistant", "good")], [("user", "q"), ("assistant", "bad")]),
    ([("system", "s"), ("user", "q"), ("assistant", "a"), ("user", "r"), ("assistant", "b")], [("system", "s"), ("user", "q"), ("assistant", "a"), ("user", "r2"), ("assistant", "c")]),
    ([("user", "q")], [("user", "q")]), ([("user", "q"), ("assistant", "a")], [("user", "q")]), ([], [("user", "q")]), ([], []),
    ([("user", "x")], [("system", "x")]), ([(None, None), ("assistant", "<|im_end|> é")], [("", ""), ("assistant", None)]),
    ([("user", "same")] * 3 + [("assistant", "1")], [("user", "same")] * 4),
]


def test_prefix_and_rendering(spark):
    df = spark.createDataFrame([(i, c, r, "clash") for i, (c, r) in enumerate(PAIRS)], "key int, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt string")
    rows = {r["key"]: r for r in p.format_pairs(df).collect()}
    for i, (c, r) in enumerate(PAIRS):
        assert (rows[i]["n_shared"], rows[i]["prompt"], rows[i]["chosen"], rows[i]["rejected"]) == brute(c, r), i
        for side, turns in (("chosen", c), ("rejected", r)):
            spans = [tuple(map(int, x.split(":"))) for x in rows[i][f"{side}_mask"].split(",") if x]
            assert sum(n for n, _ in spans) == len(rows[i][side])
            at, trained = 0, ""
            for n, flag in spans:
                trained += rows[i][side][at:at + n] * flag
                at += n
            rest = turns[rows[i]["n_shared"]:]
            assert trained == "".join(f"{(t or '').replace('<|', '< |')}<|im_end|>\n" for role, t in rest if role == "assistant")
        assert rows[i]["usable"] == all(any(role == "assistant" for role, _ in t[rows[i]["n_shared"]:]) for t in (c, r))


EDGES = [
    (1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "b"), (1, 4, "user", "t"), (1, 3, "assistant", "b"),
    (2, 0, "user", None), (2, None, None, "early"), (3, 0, "assistant", "only"), (4, 0, "assistant", "x"), (4, 1, "assistant", "x"),
    (5, 0, "user", "tie b"), (5, 0, "user", "tie a"), (5, 1, "assistant", ""), (None, 0, "user", "lost"), (6, 0, "user", "long " * 30000), (6, 1, "assistant", "y" * 100000),
]


def oracle_rows(con):
    out = con.sql(p.ORACLE)
    return sorted(map(str, (dict(zip(out.columns, r)) for r in out.fetchall())))


def test_edges_and_sql_agree(spark):
    schema = "conv_id long, turn long, role string, text string, key string, turns string"
    df = spark.createDataFrame([(*r, "clash", "clash") for r in EDGES], schema)
    got = p.format_pairs(p.stale_reply_pairs(df)).withColumnRenamed("key", "conv_id")
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", EDGES)
    assert sorted(str(r.asDict()) for r in got.collect()) == oracle_rows(con)
    by = {r["conv_id"]: r for r in got.collect()}
    assert set(by) == {1, 2, 3, 4, 5, 6} and by[1]["n_shared"] == 3 and not by[2]["usable"] and "<|im_start|>user\ntie a" in by[5]["prompt"]
    assert p.format_pairs(p.stale_reply_pairs(df.where("1 = 0"))).count() == 0


def test_native_plan(spark):
    plan = p.op9_chat_preferences(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
