"""Paged scans: contiguous prefix, attempts and runs, arrival order, gaps, newest-N."""

import json

import pytest
from pyspark.sql import types as T

from subledger.schemas import LANDING_PAGE
from subledger.sources.landing import newest_n, page_gaps, page_status, parse_pages, scan_pages, scan_task_pages

REC = T.StructType([T.StructField("id", T.LongType())])


def _landing(spark, pages, source="s", run="", total=None):
    """pages: (page_no, status, body or list[, attempt])."""
    rows = []
    for no, status, body, *attempt in pages:
        text = body if body is None or isinstance(body, str) else json.dumps(body)
        rows.append((source, no, status, 100, total or max(p[0] for p in pages), text, run, attempt[0] if attempt else None))
    return spark.createDataFrame(rows, LANDING_PAGE)


def _ids(df):
    return [r["id"] for r in df.orderBy("seq").collect()]


def _gap(land):
    return page_gaps(parse_pages(land), "s").first()


def test_failed_page_stops_scan(spark):
    land = _landing(spark, [(1, 200, [{"id": 1}, {"id": 2}]), (2, 200, [{"id": 3}, {"id": 4}]),
                            (3, 500, None), (4, 200, [{"id": 5}, {"id": 6}])])
    assert _ids(scan_pages(land, "s", REC)) == [1, 2, 3, 4]
    assert (_gap(land)["first_bad_page"], _gap(land)["dropped_pages"], _gap(land)["records"]) == (3, 2, 4)


@pytest.mark.parametrize("body", ["[]", "[" + " " * 80 + "]"])
def test_empty_page_stops_scan_however_long_its_body(spark, body):
    land = _landing(spark, [(1, 200, [{"id": 9}]), (2, 200, body), (3, 200, [{"id": 7}])])
    assert _ids(scan_pages(land, "s", REC)) == [9]
    assert sorted(_ids(scan_pages(land, "s", REC, prefix_rule=False))) == [7, 9]
    assert _gap(land)["dropped_pages"] == 1  # page 3
    end = _landing(spark, [(1, 200, [{"id": 9}]), (2, 200, body)], total=1)
    assert _gap(end)["dropped_pages"] == 0  # an empty last page is the end, not a gap


@pytest.mark.parametrize("body", ['[{"id": 2}, {"i', '{"error": "' + "x" * 200 + '"}', "{}", "not json"])
def test_cut_off_and_non_array_bodies_are_bad_pages(spark, body):
    land = _landing(spark, [(1, 200, [{"id": 1}]), (2, 200, body), (3, 200, [{"id": 3}])])
    assert _ids(scan_pages(land, "s", REC)) == [1]
    assert _ids(scan_pages(land, "s", REC, prefix_rule=False)) == [1, 3]
    assert _gap(land)["dropped_pages"] == 2


def test_last_attempt_counts(spark):
    land = _landing(spark, [(1, 200, [{"id": 1}]), (2, 500, "<html>", 0), (2, 200, [{"id": 2}], 1), (3, 200, [{"id": 3}])])
    assert _ids(scan_pages(land, "s", REC)) == [1, 2, 3] and _gap(land)["dropped_pages"] == 0
    lost = _landing(spark, [(1, 200, [{"id": 1}]), (2, 200, [{"id": 2}], 0), (2, 500, None, 1), (3, 200, [{"id": 3}])])
    assert _ids(scan_pages(lost, "s", REC)) == [1]


def test_absent_pages_end_the_prefix_and_are_gaps(spark):
    land = _landing(spark, [(1, 200, [{"id": 1}]), (3, 200, [{"id": 3}])])
    assert _ids(scan_pages(land, "s", REC)) == [1]
    assert (_gap(land)["first_bad_page"], _gap(land)["dropped_pages"]) == (2, 2)
    late = _landing(spark, [(2, 200, [{"id": 1}])])
    assert _ids(scan_pages(late, "s", REC)) == [] and _gap(late)["first_bad_page"] == 1
    short = _landing(spark, [(1, 200, [{"id": 1}])], total=4)  # announced, never landed
    assert _gap(short)["dropped_pages"] == 3
    assert page_gaps(parse_pages(short), "s", max_pages=1).first()["dropped_pages"] == 0  # the cap asked for no more


def test_latest_run_counts(spark):
    land = _landing(spark, [(1, 200, [{"id": 1}]), (2, 200, [{"id": 2}])], run="2025-01").unionByName(
        _landing(spark, [(1, 200, [{"id": 1}, {"id": 5}])], run="2025-02"))
    assert _ids(scan_pages(land, "s", REC)) == [1, 5]
    rows = page_status(parse_pages(land), "s").collect()
    assert [(r["page_no"], r["outcome"], r["n_records"], r["in_prefix"]) for r in rows] == [(1, "ok", 2, True)]


def test_arrival_order_and_other_sources(spark):
    land = _landing(spark, [(2, 200, [{"id": 5}, {"id": 1}]), (1, 200, [{"id": 8}])]).unionByName(
        _landing(spark, [(1, 500, None)], source="other"))
    assert _ids(scan_pages(land, "s", REC)) == [8, 5, 1]
    assert _ids(scan_pages(land, "other", REC)) == [] and _ids(scan_pages(land, "none", REC)) == []


def test_task_listing_goes_on_after_empty_pages_only(spark):
    pages = [(0, 200, [{"id": 1}]), (1, 200, "[ ]"), (2, 200, [{"id": 2}]), (3, 503, None), (4, 200, [{"id": 3}])]
    assert _ids(scan_task_pages(_landing(spark, pages), "s", REC)) == [1, 2]


def test_fields_of_other_types_are_null_alone(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("user", T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())]))])
    land = _landing(spark, [(1, 200, [{"id": "x", "user": {"id": 3, "name": "a"}}, {"id": 2, "user": 5}, {"id": 3}])])
    got = [(r["id"], r["user"]["id"], r["user"]["name"]) for r in scan_pages(land, "s", schema).orderBy("seq").collect()]
    assert got == [(None, 3, "a"), (2, None, None), (3, None, None)]


def test_newest_n(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "id")
    assert [r["id"] for r in newest_n(df, 3).collect()] == [4999, 4998, 4997]
