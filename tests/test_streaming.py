"""Incremental landing: each page file lands exactly once; the report reads the landed table."""

import json

from pyspark.sql import functions as F

from subledger.schemas import PLAN
from subledger.sinks.writers import read_report
from subledger.sources.landing import read_landing, scan_pages
from subledger.streaming import ingest_pages


def _page(path, source, no, recs):
    path.write_text(json.dumps({"source": source, "page_no": no, "http_status": 200, "total": None,
                                "last_page": None, "body": json.dumps(recs)}))


def test_ingest_is_incremental(spark, tmp_path):
    inbox, land, ckpt = tmp_path / "inbox", str(tmp_path / "landing"), str(tmp_path / "ckpt")
    inbox.mkdir()
    _page(inbox / "p1.json", "plans", 1, [{"id": 1, "name": "a", "price": {"recurring_interval": "month"}}])
    _page(inbox / "p2.json", "plans", 2, [{"id": 2, "name": "b", "price": None}])
    assert ingest_pages(spark, str(inbox), land, ckpt) == 2
    assert ingest_pages(spark, str(inbox), land, ckpt) == 0          # nothing new, nothing twice
    _page(inbox / "p3.json", "usersubs", 1, [])
    assert ingest_pages(spark, str(inbox), land, ckpt) == 1
    landed = read_landing(spark, land, "parquet")
    assert landed.count() == 3
    plans = scan_pages(landed, "plans", PLAN)
    assert [r["id"] for r in plans.orderBy("seq").collect()] == [1, 2]
    plan = plans._sc._jvm.PythonSQLUtils.explainString(plans._jdf.queryExecution(), "simple")
    assert "PartitionFilters: [isnotnull(source" in plan


def test_checkpoint_defaults_to_cluster_folder(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    _page(inbox / "a.json", "plans", 1, [])
    assert spark.conf.get("spark.checkpoint.dir")
    assert ingest_pages(spark, str(inbox), str(tmp_path / "l")) == 1
    assert spark.read.parquet(str(tmp_path / "l")).filter(F.col("source") == "plans").count() == 1


def test_ingested_landing_feeds_the_job(spark, tmp_path):
    """Pages landed through the stream give the job the same report as the raw files."""
    from test_job import PARAMS, _landing
    from subledger.plans.job import JobConfig, run_report
    raw = _landing(tmp_path)                       # one JSON-lines file of page rows
    lines = open(f"{raw}/pages.json", encoding="utf-8").read().splitlines()
    inbox = tmp_path / "inbox2"
    inbox.mkdir()
    half = len(lines) // 2
    (inbox / "a.json").write_text("\n".join(lines[:half]))
    land, ckpt = str(tmp_path / "landed"), str(tmp_path / "ck2")
    assert ingest_pages(spark, str(inbox), land, ckpt) == half
    (inbox / "b.json").write_text("\n".join(lines[half:]))   # a later fetch run's files
    assert ingest_pages(spark, str(inbox), land, ckpt) == len(lines) - half
    a, b = str(tmp_path / "from_raw"), str(tmp_path / "from_stream")
    assert run_report(spark, JobConfig(raw, a), PARAMS) == \
        run_report(spark, JobConfig(land, b, landing_format="parquet"), PARAMS)
    rows = lambda p: sorted(str(tuple(r)) for r in read_report(spark, f"{p}/report", f"{p}/report_meta").collect())
    assert rows(a) == rows(b)
