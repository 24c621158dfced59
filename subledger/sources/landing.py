"""Scans over landed API pages.

HTTP fetching is not part of the engine: each API answer is landed as one row
``(source, page_no, http_status, total, last_page, body, run_id, attempt)``
(JSON lines or Parquet), and the reference's paging rules are applied here as
plans. ``parse_pages`` reads each body once and gives one row per record (one
per page without records), the record as VARIANT; the job writes that table,
so everything else (the page index, gaps, records) reads it and no body again.

Which pages count: those of the latest run, of each page its last attempt. A
page failed (no 200, no body), is invalid (its body is no JSON array), empty,
or ok. The contiguous prefix ends before the first page that is not ok or
whose number was never landed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.schemas import LANDING_PAGE

PAGE_COLUMNS = ("source", "run_id", "page_no", "attempt", "http_status", "total", "last_page", "outcome", "n_records")


# Sources whose body is one document
SINGLE_DOCUMENT = ("crm_project",)


def read_landing(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Landing table with an explicit schema (no inference pass; absent columns are NULL)."""
    return spark.read.format(fmt).schema(LANDING_PAGE).load(path)


def _page_columns(landing: DataFrame, single: tuple[str, ...]) -> DataFrame:
    """The page columns and ``_docs`` (the body's records, NULL unless the page is ok)."""
    optional = lambda c, default: F.coalesce(F.col(c), F.lit(default)) if c in landing.columns else F.lit(default)
    body = F.try_parse_json("body")
    alone = F.col("source").isin(*single) & F.schema_of_variant(body).startswith("OBJECT")
    docs = F.when(alone, F.array(body)).otherwise(F.try_variant_get(body, "$", "array<variant>"))
    pages = landing.select("source", "page_no", "http_status", "total", "last_page", optional("run_id", "").alias("run_id"),
                           optional("attempt", 0).alias("attempt"), F.col("body").isNull().alias("_none"), docs.alias("_docs"))
    outcome = (F.when(F.col("_none") | ~F.col("http_status").eqNullSafe(F.lit(200)), "failed")
               .when(F.col("_docs").isNull(), "invalid").when(F.size("_docs") == 0, "empty").otherwise("ok"))
    pages = pages.withColumn("outcome", outcome).withColumn("_docs", F.when(F.col("outcome") == "ok", F.col("_docs")))
    return pages.select(*PAGE_COLUMNS[:-1], F.coalesce(F.size("_docs"), F.lit(0)).alias("n_records"), "_docs")


def parse_pages(landing: DataFrame, single: tuple[str, ...] = SINGLE_DOCUMENT) -> DataFrame:
    """The page columns, ``pos`` and ``doc`` (VARIANT): a row per record, or one row with
    NULL ``pos`` for a page without records. Each body is parsed once. The pages of the
    sources in ``single`` hold one document instead of an array."""
    return _page_columns(landing, single).select(*PAGE_COLUMNS, F.posexplode_outer("_docs").alias("pos", "doc"))


def page_index(parsed: DataFrame) -> DataFrame:
    """One narrow row per landed page and attempt; no shuffle, no bodies."""
    return parsed.filter(F.coalesce(F.col("pos"), F.lit(0)) == 0).select(*PAGE_COLUMNS)


def landed_index(landing: DataFrame, single: tuple[str, ...] = SINGLE_DOCUMENT) -> DataFrame:
    """``page_index`` straight from the landed pages, as a projection: what asks for page columns
    alone (the newest run, superseded attempts) parses no body."""
    return _page_columns(landing, single).select(*PAGE_COLUMNS)


def _current(parsed: DataFrame, source: str, index: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """A source's rows and page index (from a written index, if given), of its latest run."""
    own = parsed.filter(F.col("source") == source)
    index = page_index(own) if index is None else index.filter(F.col("source") == source)
    newest = index.select(F.max("run_id")).scalar()
    return own.filter(F.col("run_id") == newest), index.filter(F.col("run_id") == newest)


def last_attempts(index: DataFrame) -> DataFrame:
    """The last attempt of each page: (page_no, attempt, outcome, total, last_page, http_status, n_records)."""
    cols = ["attempt", "outcome", "total", "last_page", "http_status", "n_records"]
    return index.groupBy("page_no").agg(F.max(F.struct(*cols)).alias("_last")).select("page_no", "_last.*")


def _stop(pages: DataFrame, first_page: int, stop_on_empty: bool) -> DataFrame:
    """One row: the first page number that ends the prefix (failed, invalid, empty if asked, or never landed)."""
    ends = ("failed", "invalid", "empty") if stop_on_empty else ("failed", "invalid")
    pages = pages.filter(F.col("page_no") >= first_page)
    bad = pages.filter(F.col("outcome").isin(*ends)).select("page_no")
    after = pages.select(F.explode(F.array(F.lit(first_page), F.col("page_no") + 1)).alias("page_no")).distinct()
    return bad.unionByName(after.join(pages.select("page_no"), "page_no", "left_anti")).select(F.min("page_no").alias("stop"))


def kept_rows(parsed: DataFrame, source: str, prefix_rule: bool = True, max_pages: int | None = None,
              first_page: int = 1, stop_on_empty: bool = True, index: DataFrame | None = None) -> DataFrame:
    """The parsed rows that count: latest run, last attempts, and (S2) before the prefix's end.

    The page numbers are compared on the narrow index; the end is a one-row
    scalar subquery and superseded attempts an anti join, so records are not
    shuffled unless pages were retried in bulk.
    """
    own, index = _current(parsed, source, index)
    if max_pages is not None:
        own, index = (df.filter(F.col("page_no") < F.lit(first_page + max_pages)) for df in (own, index))
    last = last_attempts(index)
    superseded = index.select("page_no", "attempt").join(last.select("page_no", F.col("attempt").alias("_last")), "page_no").filter("attempt < _last")
    own = own.join(superseded.select("page_no", "attempt").distinct(), ["page_no", "attempt"], "left_anti")
    if prefix_rule:
        own = own.filter(F.col("page_no") < F.coalesce(_stop(last, first_page, stop_on_empty).scalar(), F.lit(first_page)))
    return own


def typed(doc: Column, schema: T.StructType, path: str = "$") -> Column:
    """A VARIANT object's fields by ``schema``; a field that is absent or of another type is NULL."""
    fields = []
    for f in schema.fields:
        at = f"{path}.{f.name}"
        value = typed(doc, f.dataType, at) if isinstance(f.dataType, T.StructType) else F.try_variant_get(doc, at, f.dataType.simpleString())
        fields.append(value.alias(f.name))
    return F.struct(*fields)


def scan_records(parsed: DataFrame, source: str, record_schema: T.StructType | None = None, **rules) -> DataFrame:
    """S1 (+S2) over parsed pages: ``page_no``, ``pos``, ``seq`` (arrival order: page, then
    position) and the record's fields, or the record itself as ``doc`` without a schema.

    Fields are taken before the paging rules' joins, so that over a written record table
    only these leaves of the VARIANT are read.
    """
    if record_schema is not None:
        parsed = parsed.withColumn("_rec", typed(F.col("doc"), record_schema)).drop("doc")
    rows = kept_rows(parsed, source, **rules).filter(F.col("pos").isNotNull())
    seq = F.shiftleft(F.col("page_no").cast("bigint"), 32) + F.col("pos")
    if record_schema is None:
        extra = [c for c in ("created",) if c in rows.columns]
        return rows.select("page_no", "pos", seq.alias("seq"), "doc", *extra)
    return rows.select("page_no", "pos", seq.alias("seq"), "_rec.*")


def scan_pages(landing: DataFrame, source: str, record_schema: T.StructType, prefix_rule: bool = True,
               max_pages: int | None = None, first_page: int = 1, stop_on_empty: bool = True) -> DataFrame:
    """S1 (+S2): concatenate the record arrays of a source's pages in page order.

    ``max_pages`` reproduces a page cap (pages past it were never fetched).
    """
    own = landing.filter(F.col("source") == source)
    return scan_records(parse_pages(own), source, record_schema, prefix_rule=prefix_rule, max_pages=max_pages,
                        first_page=first_page, stop_on_empty=stop_on_empty, index=landed_index(own))


def scan_pages_variant(landing: DataFrame, source: str, prefix_rule: bool = True) -> DataFrame:
    """S1 without a schema: each record as VARIANT (``doc``), keeping missing vs null keys."""
    own = landing.filter(F.col("source") == source)
    return scan_records(parse_pages(own), source, prefix_rule=prefix_rule, index=landed_index(own))


def newest_n(records: DataFrame, n: int, key: str = "id") -> DataFrame:
    """The ``n`` records with the highest ``key`` (page size x page cap).

    Planned as TakeOrderedAndProject: a per-partition top-n, then one merge of
    at most n rows per partition. The limit is the feature here.
    """
    return records.orderBy(F.col(key).desc()).limit(n)


def scan_task_records(parsed: DataFrame, source: str, record_schema: T.StructType, index: DataFrame | None = None) -> DataFrame:
    """S5 over parsed pages, see ``scan_task_pages``."""
    within = F.col("page_no") <= F.coalesce(F.col("last_page"), F.lit(1))
    index = None if index is None else index.filter(within)
    return scan_records(parsed.filter(within), source, record_schema, first_page=0, stop_on_empty=False, index=index)


def scan_task_pages(landing: DataFrame, source: str, record_schema: T.StructType) -> DataFrame:
    """CRM task listing. Pages are numbered from 0 and read up to and
    including the announced page count (one page past the end, as the CRM
    client does); a failed, invalid or absent page stops the listing, an empty
    one does not. A page delivered twice yields its tasks twice (dedupe downstream, D13).
    """
    own = landing.filter(F.col("source") == source)
    return scan_task_records(parse_pages(own), source, record_schema, index=landed_index(own))


def page_status(parsed: DataFrame, source: str) -> DataFrame:
    """The page index of a source's latest run, last attempts only, with the page's place to the prefix."""
    _, index = _current(parsed, source)
    last = last_attempts(index)
    stop = _stop(last, 1, True).scalar()
    return last.select(F.lit(source).alias("source"), "page_no", "attempt", "outcome", "n_records", (F.col("page_no") < stop).alias("in_prefix"))


def page_gaps(parsed: DataFrame, source: str, max_pages: int | None = None, first_page: int = 1,
              stop_on_empty: bool = True, index: DataFrame | None = None) -> DataFrame:
    """What a scan leaves out: pages with records or errors at or after the prefix's end, and
    page numbers never landed up to the announced (or highest landed) one, within the cap.

    One row ``(source, first_bad_page, announced_last_page, dropped_pages, records)``;
    ``records`` counts those the scan keeps.
    """
    _, index = _current(parsed, source, index)
    if max_pages is not None:
        index = index.filter(F.col("page_no") < F.lit(first_page + max_pages))
    last = last_attempts(index)
    stop = _stop(last, first_page, stop_on_empty).scalar()
    upto = F.greatest(F.max("page_no"), F.least(F.max("last_page"), F.lit(2**31 - 1 if max_pages is None else first_page + max_pages - 1)))
    absent = F.greatest(upto - first_page + 1 - F.count_if(F.col("page_no") >= first_page), F.lit(0))
    left = F.count_if((F.col("page_no") >= stop) & (F.col("outcome") != "empty"))
    return last.agg(
        F.lit(source).alias("source"), stop.alias("first_bad_page"), F.max("last_page").alias("announced_last_page"),
        (left + F.coalesce(absent, F.lit(0))).cast("bigint").alias("dropped_pages"),
        F.coalesce(F.sum(F.when((F.col("page_no") >= first_page) & (F.col("page_no") < stop), F.col("n_records"))), F.lit(0)).alias("records"))
