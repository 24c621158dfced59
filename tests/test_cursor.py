"""Cursor pages put in order by list ranking."""

import json
import random

import pytest

from subledger.plans import catalog
from subledger.session import keep_small, keep_written
from subledger.sources import cursor, proxies

SCHEMA = "source string, starting_after string, http_status int, body string, run_id string, attempt int"


def page(after, ids, more=True, source="s", status=200, body=None, run="r2", attempt=0):
    return (source, after, status, json.dumps({"data": [{"id": i} for i in ids], "has_more": more}) if body is None else body, run, attempt)


def ranked(spark, rows, shuffle=True):
    rows = list(rows)
    if shuffle:
        random.Random(len(rows)).shuffle(rows)
    parsed = cursor.parse_cursor_pages(spark.createDataFrame(rows, SCHEMA))
    return parsed, cursor.chains(parsed, keep_small)


def states(chain):
    return {(r["source"], None if r["cursor"] == cursor.FIRST else r["cursor"], r["last_id"], r["attempt"]): (r["rank"], r["state"]) for r in chain.collect()}


def ids(parsed, chain):
    rows = cursor.scan_cursor_pages(parsed, chain).orderBy("source", "seq").selectExpr("source", "try_variant_get(doc, '$.id', 'string') AS id").collect()
    return [(r["source"], r["id"]) for r in rows]


@pytest.mark.parametrize("n", [1, 2, 5, 33])
def test_shuffled_pages_come_in_order(spark, n):
    rows = [page(f"x{k * 3 - 1}" if k else None, [f"x{k * 3 + j}" for j in range(3)], k < n - 1) for k in range(n)]
    parsed, chain = ranked(spark, rows)
    assert ids(parsed, chain) == [("s", f"x{k}") for k in range(3 * n)]
    assert sorted(r["rank"] for r in chain.collect()) == list(range(n))


def test_rounds_are_logarithmic(spark):
    seen = []
    rows = [page(f"x{k - 1}" if k else None, [f"x{k}"], k < 63) for k in range(64)]
    parsed = cursor.parse_cursor_pages(spark.createDataFrame(rows, SCHEMA))
    chain = cursor.chains(parsed, lambda df: seen.append(df) or keep_small(df))
    assert max(r["rank"] for r in chain.collect()) == 63 and len(seen) <= 4 + 2 * 8 + 2 + 8


def test_states(spark):
    rows = [
        page(None, ["a1", "a2"]), page("a2", ["a3"]), page("a3", [], status=500, body="<html>"), page("a3", ["a4"], attempt=1), page("a4", ["a5"], more=False),
        page("a5", ["a6"]), page("a6", ["a7"]),                                            # after the end
        page("a2", ["zz"]),                                                                # a rival
        page("lost", ["b1"]), page("b1", ["b2"]),                                          # nothing ends at its cursor
        page("c2", ["c1"]), page("c1", ["c2"]), page("c0", ["c0"]),                        # rings of two and of one
        page(None, ["e1"], source="t"), page("e1", [], source="t"), page("e2", ["e3"], source="t"),  # ends at an empty page
        page(None, [], source="u", status=503, body=None), page(None, ["v1"], source="v", body="[1"), page(None, ["w1"], source="w", body='{"data": 5}'),
        page(None, ["f1"], source="x"), page("f1", ["f2"], source="x"), page("f2", ["f1"], source="x"),  # the chain runs into a ring
        page(None, ["old"], run="r1"),
    ]
    parsed, chain = ranked(spark, rows)
    got = states(chain)
    assert got == {
        ("s", None, "a2", 0): (0, "ok"), ("s", "a2", "a3", 0): (1, "ok"), ("s", "a3", None, 0): (None, "superseded"), ("s", "a3", "a4", 1): (2, "ok"),
        ("s", "a4", "a5", 0): (3, "ok"), ("s", "a5", "a6", 0): (None, "after_end"), ("s", "a6", "a7", 0): (None, "after_end"), ("s", "a2", "zz", 0): (None, "forked"),
        ("s", "lost", "b1", 0): (None, "broken"), ("s", "b1", "b2", 0): (None, "broken"), ("s", "c2", "c1", 0): (None, "cyclic"), ("s", "c1", "c2", 0): (None, "cyclic"),
        ("s", "c0", "c0", 0): (None, "cyclic"), ("t", None, "e1", 0): (0, "ok"), ("t", "e1", None, 0): (None, "end"), ("t", "e2", "e3", 0): (None, "broken"),
        ("u", None, None, 0): (None, "end"), ("v", None, None, 0): (None, "end"), ("w", None, None, 0): (None, "end"),
        ("x", None, "f1", 0): (0, "ok"), ("x", "f1", "f2", 0): (1, "ok"), ("x", "f2", "f1", 0): (2, "cyclic")}
    assert ids(parsed, chain) == [("s", f"a{k}") for k in range(1, 6)] + [("t", "e1"), ("x", "f1"), ("x", "f2"), ("x", "f1")]


def test_empty_landing_and_repeats(spark):
    parsed, chain = ranked(spark, [])
    assert chain.count() == 0 and ids(parsed, chain) == []
    parsed, chain = ranked(spark, [page(None, ["a"], more=False)] * 3)
    assert chain.count() == 1 and ids(parsed, chain) == [("s", "a")] * 3  # delivered three times


def test_hot_cursor(spark):
    rows = [page("k0", [f"z{k:03}"]) for k in range(60)] + [page(None, ["k0"])] + [page(f"z{k:03}", [f"y{k:03}"], more=False) for k in range(60)]
    _, chain = ranked(spark, rows)
    got = [(r["rank"], r["state"]) for r in chain.collect()]
    assert got.count((None, "forked")) == 59 and got.count((None, "broken")) + got.count((None, "after_end")) == 59 and sorted(r for r, _ in got if r is not None) == [0, 1, 2]


def estimated_bits(df):
    """Length of the planner's estimated size."""
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length()


@pytest.mark.parametrize("query, rows", [("cursor_pages", 70), ("cursor_scan", 65)])
def test_estimated_sizes_stay_numbers_a_driver_can_hold(spark, monkeypatch, query, rows):
    pages = [page(f"x{k - 1}" if k else None, [f"x{k}"], k < 64) for k in range(65)] + [page(f"y{k}", [f"y{k + 1}"]) for k in range(5)]
    monkeypatch.setattr(proxies, "cursor_pages", lambda spark, d: spark.createDataFrame(pages, SCHEMA))
    df = getattr(catalog, query)(spark, "")
    assert estimated_bits(df) < 1000 and df.count() == rows  # an estimate squared in each round had 341154 digits here


def test_written_rounds_match_checkpoints(spark):
    rows = [page(f"x{k - 1}" if k else None, [f"x{k}"], k < 20) for k in range(21)] + [page("x5", ["zz"]), page("c1", ["c2"]), page("c2", ["c1"]), page("q", [], status=500)]
    parsed = cursor.parse_cursor_pages(spark.createDataFrame(rows, SCHEMA), keep_written)
    assert states(cursor.chains(parsed, keep_written)) == states(ranked(spark, rows)[1])


def test_jumps_of_four(spark):
    rows, lengths = [], (1, 4, 5, 16, 17, 70)  # a source of each length
    for n in lengths:
        put = lambda after, ids, more=True: rows.append(page(after, ids, more, source=f"s{n}"))  # noqa: B023, E731
        for k in range(n):
            put(f"x{k - 1}" if k else None, [f"x{k}"], k < n - 1)
            put(f"l{k - 1}", [f"l{k}"])
            put(f"r{(k or n) - 1}", [f"r{k}"])
            put(f"y{k - 1}" if k else f"x{n - 1}", [f"y{k}"])
    got = states(ranked(spark, rows)[1])
    assert len(got) == 4 * sum(lengths)
    for (source, _, last, _), found in got.items():
        want = {"x": (int(last[1:]), "ok"), "l": (None, "broken"), "r": (None, "cyclic"), "y": (None, "after_end")}[last[0]]
        assert found == want, (source, last)


def test_few_rounds_and_none_over_rings(spark):
    seen = []
    rows = [page(f"x{k - 1}" if k else None, [f"x{k}"], k < 63) for k in range(64)] + [page(f"r{(k or 64) - 1}", [f"r{k}"]) for k in range(64)]
    chain = cursor.chains(cursor.parse_cursor_pages(spark.createDataFrame(rows, SCHEMA)), lambda df: seen.append(df) or keep_small(df))
    got = [(r["rank"], r["state"]) for r in chain.collect()]
    assert got.count((None, "cyclic")) == 64 and max(r for r, _ in got if r is not None) == 63
    assert len(seen) <= 3 + 4 + 2 + 1  # jumps of two take more


def test_bodies_are_parsed_once(spark, monkeypatch):
    pages = [page(None, ["a1", "a2"]), page("a2", ["a3"], more=False)]
    landed = spark.createDataFrame(pages, SCHEMA)
    rows = cursor.scan_cursor_pages(*ranked(spark, pages))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1
    monkeypatch.setattr(proxies, "cursor_pages", lambda spark, d: landed)
    df = catalog.cursor_scan(spark, "")
    assert "parseJson" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["rank"], r["pos"], r["id"]) for r in df.collect()) == [(0, 0, "a1"), (0, 1, "a2"), (1, 0, "a3")]


def test_many_sources_meet_their_runs_by_join(spark, monkeypatch):
    monkeypatch.setattr(cursor, "FEW_SOURCES", 2)
    rows = [page(None, [f"a{k}"], more=False, source=f"s{k}", run=run) for k in range(5) for run in ("r1", "r2")]
    parsed = cursor.parse_cursor_pages(spark.createDataFrame(rows, SCHEMA), keep_small)
    assert sorted(r["last_id"] for r in parsed.collect()) == [f"a{k}" for k in range(5)]
