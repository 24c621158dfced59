"""Invoice pages that are ordered by cursors alone.

A landed page tells the cursor it was asked for (``starting_after``, NULL for
the first) and its body ``{"data": [...], "has_more": ...}``; there are no page
numbers. The page after a page is the one whose cursor is the id of its last
record. ``chains`` finds each page's place by list ranking: every page has a
pointer to the page after it, pointers jump four times as far in every round, and the
pages reached from a source's first page grow with them, so a chain of n pages takes
log4(n) rounds of three joins each (a jump of four) and is never walked page by page.

States of a page:

* ``ok``: in the chain; ``rank`` is its place from 0. A chain ends after a page
  without ``has_more``, or before a page that failed, is invalid or is empty;
* ``end``: the page before which the chain ended, as it is failed, invalid or empty;
* ``cyclic``: it leads back to an earlier page of its chain, or no chain reaches it and the pages before it follow one another in a ring;
* ``after_end``: it follows, over however many pages, a page that ended its chain;
* ``broken``: no landed page ends at its cursor, or at that of a page before it;
* ``forked``: another page was landed for the same cursor and counts instead (of
  the pages of a cursor's last attempt: an ok one first, then the smallest last id);
* ``superseded``: an earlier attempt for its cursor.

Pages of each source's latest run count. Rows that repeat a page are one page to the chain; their records come
as often as they were landed (as in S5, to be removed downstream), so that no body is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Keep = Callable[[DataFrame], DataFrame]

PAGE = ("source", "cursor", "attempt", "outcome", "has_more", "n_records", "first_id", "last_id")
#: The key of a source's first page: no id has a NUL before it.
FIRST = "\u0000"
#: Jumps a round: its pointers reach so many times as far as those of the round before.
JUMPS = 4
#: Up to so many sources, the bodies meet the latest runs where they are; else both are dealt by source.
FEW_SOURCES = 10_000


def parse_cursor_pages(landing: DataFrame, keep: Keep | None = None) -> DataFrame:
    """The page columns of ``PAGE`` and ``docs`` (array of VARIANT) of each landed page of its source's latest run.

    ``landing``: source, starting_after, http_status, body and, if there are any, run_id and attempt.
    ``keep`` makes the latest runs durable (a row a source), so that later reads of the pages do not look for them again.
    """
    optional = lambda c, default: F.coalesce(F.col(c), F.lit(default)) if c in landing.columns else F.lit(default)
    newest = landing.groupBy(F.col("source").alias("_source")).agg(F.max(optional("run_id", "")).alias("_run"))
    if keep:
        newest = keep(newest)
        newest = F.broadcast(newest) if newest.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES else newest
    rows = landing.withColumn("_own", optional("run_id", "")).join(newest, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_own") == F.col("_run")))
    body = rows.select("source", F.coalesce(F.col("starting_after"), F.lit(FIRST)).alias("cursor"), optional("attempt", 0).alias("attempt"),
                       (F.col("body").isNull() | ~F.col("http_status").eqNullSafe(F.lit(200))).alias("_failed"), F.try_parse_json("body").alias("_body"))
    read = body.select("source", "cursor", "attempt", "_failed", F.try_variant_get("_body", "$", "struct<data array<variant>, has_more boolean>").alias("_page"))
    docs, failed = F.col("_page.data"), F.col("_failed")
    outcome = F.when(failed, "failed").when(docs.isNull(), "invalid").when(F.size(docs) == 0, "empty").otherwise("ok")
    named = lambda at: F.when(~failed, F.try_variant_get(F.try_element_at(docs, F.lit(at)), "$.id", "string"))
    return read.select(
        "source", "cursor", "attempt", outcome.alias("outcome"), (~failed & F.coalesce(F.col("_page.has_more"), F.lit(False))).alias("has_more"),
        F.when(failed | docs.isNull(), 0).otherwise(F.size(docs)).alias("n_records"), named(1).alias("first_id"), named(-1).alias("last_id"),
        F.when(outcome == "ok", docs).alias("docs"))


def _winners(pages: DataFrame) -> DataFrame:
    """One page for each cursor: of its last attempt, an ok one first, then by last and first id."""
    place = F.struct((-F.col("attempt")).alias("a"), (F.col("outcome") != "ok").alias("o"), F.coalesce("last_id", F.lit("")).alias("l"), F.coalesce("first_id", F.lit("")).alias("f"),
                     F.col("n_records").alias("n"), (~F.col("has_more")).alias("h"), F.struct(*PAGE).alias("page"))
    return pages.groupBy("source", "cursor").agg(F.min(place).alias("_best")).select("_best.page.*")


def _join(left: DataFrame, right: DataFrame, at: str, how: str = "inner") -> DataFrame:
    """``left`` with ``right`` (source and cursor named s, c) where left's ``at`` is right's cursor."""
    return left.join(right, (F.col("source") == F.col("s")) & (F.col(at) == F.col("c")), how).drop("s", "c")


def chains(pages: DataFrame, keep: Keep) -> DataFrame:
    """Every distinct page with ``rank`` (NULL outside the chain) and ``state``.

    ``pages``: the columns of ``PAGE``. ``keep`` makes a small table durable: each round
    reads the one before it several times. Over many pages it must be a written table
    (``keep_written``): a checkpoint carries its plan's estimated size along, which every
    round's join squares, until the estimate alone has more digits than the driver has memory.
    """
    pages = keep(pages.select(*PAGE).distinct())
    own = keep(_winners(pages))
    known = own.select(F.col("source").alias("s"), F.col("cursor").alias("c"), F.col("cursor").alias("_known"))
    on = own.select("source", "cursor", F.when((F.col("outcome") == "ok") & F.col("has_more"), F.col("last_id")).alias("_to"),
                    F.when(F.col("cursor") == FIRST, F.lit(0).cast("long")).alias("rank"))
    # every page, the landed page ``step`` pages after it, and its rank once it is reached
    at = keep(_join(on, known, "_to", "left").select("source", "cursor", F.col("_known").alias("next"), "rank"))
    reached = at.filter(F.col("rank").isNotNull())
    tally = F.count(F.lit(1)), F.count("next")  # reached pages, and those of them with a page to jump to
    (count, onward), before, step = reached.agg(*tally).first(), 0, 1
    while onward and count > before:
        leap = at.select(F.col("source").alias("s"), F.col("cursor").alias("c"), F.col("next").alias("_next"))
        far = at.withColumnRenamed("next", "_1")
        for i in range(1, JUMPS):
            far = _join(far, leap, f"_{i}", "left").withColumnRenamed("_next", f"_{i + 1}")
        # a page with its pointer over all jumps and, where it is reached, the pages at its jumps with their ranks
        row = lambda c, to, rank: F.struct(F.col(c).alias("cursor"), to.cast("string").alias("next"), rank.alias("rank"))
        rows = [row("cursor", F.col(f"_{JUMPS}"), F.col("rank"))]
        rows += [F.when(F.col("rank").isNotNull() & F.col(f"_{i}").isNotNull(), row(f"_{i}", F.lit(None), F.col("rank") + i * step)) for i in range(1, JUMPS)]
        far = far.select("source", F.explode(F.array_compact(F.array(*rows))).alias("_row")).select("source", "_row.*")
        at = keep(far.groupBy("source", "cursor").agg(F.max("next").alias("next"), F.min("rank").alias("rank")))
        reached = at.filter(F.col("rank").isNotNull())
        before, (count, onward) = count, reached.agg(*tally).first()
        step *= JUMPS
    return _with_states(pages, own, reached.select("source", "cursor", "rank"), keep)


def _with_states(pages: DataFrame, own: DataFrame, reached: DataFrame, keep: Keep) -> DataFrame:
    at = reached.select(F.col("source").alias("s"), F.col("cursor").alias("c"), "rank")
    placed = _join(own, at, "cursor", "left")
    lost = keep(placed.filter(F.col("rank").isNull()).select("source", "cursor"))
    states = _lost_states(lost, own, keep).select(F.col("source").alias("s"), F.col("cursor").alias("c"), F.col("state").alias("_lost"))
    back = reached.select(F.col("source").alias("s"), F.col("cursor").alias("c"), F.col("rank").alias("_next"))
    placed = _join(placed, states, "cursor", "left")
    placed = _join(placed.withColumn("_to", F.when((F.col("outcome") == "ok") & F.col("has_more"), F.col("last_id"))), back, "_to", "left")
    state = (F.when(F.col("rank").isNull(), F.col("_lost")).when(F.col("outcome") != "ok", "end")
             .when(F.col("_next") <= F.col("rank"), "cyclic").otherwise("ok"))
    placed = placed.select("source", "cursor", F.struct(*PAGE).alias("_page"), state.alias("_state"), F.when(state != "end", F.col("rank")).alias("rank"), F.col("attempt").alias("_last"))
    placed = placed.select(F.col("source").alias("s"), F.col("cursor").alias("c"), "_page", "_state", "rank", "_last")
    every = _join(pages.withColumn("_own", F.struct(*PAGE)), placed, "cursor")
    mine = F.col("_own").eqNullSafe(F.col("_page"))
    state = F.when(mine, F.col("_state")).when(F.col("attempt") < F.col("_last"), "superseded").otherwise("forked")
    return every.select(*PAGE, F.when(mine, F.col("rank")).alias("rank"), state.alias("state"))


def _lost_states(lost: DataFrame, own: DataFrame, keep: Keep) -> DataFrame:
    """The state of the pages that no chain reaches, from the page before the first page before them (pointers back, ``JUMPS`` a round)."""
    before = own.filter(F.col("outcome") == "ok").groupBy("source", "last_id").agg(
        F.min(F.struct(F.col("has_more").alias("m"), F.col("cursor").alias("c"))).alias("_p"))
    before = before.select(F.col("source").alias("s"), F.col("last_id").alias("c"), F.col("_p.c").alias("prev"), F.col("_p.m").alias("more"))
    first = _join(lost, before, "cursor", "left")
    among = lost.select(F.col("source").alias("s"), F.col("cursor").alias("c"), F.lit(True).alias("_in"))
    first = _join(first.withColumn("_prev", F.coalesce("prev", F.lit(FIRST))), among, "_prev", "left")
    # settled: nothing ends at its cursor; what does says that it was the last; or that is in a chain or led elsewhere
    state = F.when(F.col("prev").isNull(), "broken").when(~F.col("more") | F.col("_in").isNull(), "after_end")
    now = keep(first.select("source", "cursor", F.when(state.isNull(), F.col("prev")).alias("prev"), state.alias("state")))
    open_, before = now.filter(F.col("state").isNull()).count(), None
    while open_ and open_ != before:  # a round that settles none leaves rings alone: of pages before them, the nearest are settled first
        over = now.select(F.col("source").alias("s"), F.col("cursor").alias("c"), F.col("prev").alias("_p"), F.col("state").alias("_s"))
        for _ in range(1, JUMPS):
            state = F.coalesce("state", "_s")
            now = _join(now, over, "prev", "left").select("source", "cursor", F.when(state.isNull(), F.col("_p")).alias("prev"), state.alias("state"))
        now = keep(now)
        open_, before = now.filter(F.col("state").isNull()).count(), open_
    return now.select("source", "cursor", F.coalesce("state", F.lit("cyclic")).alias("state"))


def scan_cursor_pages(parsed: DataFrame, ranked: DataFrame) -> DataFrame:
    """The chains' records in arrival order: source, rank, pos, seq, doc. ``parsed``: ``parse_cursor_pages``; ``ranked``: ``chains`` of it."""
    live = ranked.filter(F.col("rank").isNotNull()).select(F.struct(*PAGE).alias("_page"), "rank", F.col("source").alias("s"), F.col("cursor").alias("c"))
    rows = _join(parsed.withColumn("_own", F.struct(*PAGE)), live, "cursor").filter(F.col("_own").eqNullSafe(F.col("_page")))
    # the outer form, as for the plain one Spark adds a filter on the array that parses each body again, several times
    rows = rows.select("source", "rank", F.posexplode_outer("docs").alias("pos", "doc")).filter(F.col("pos").isNotNull())
    return rows.select("source", "rank", "pos", (F.shiftleft("rank", 32) + F.col("pos")).alias("seq"), "doc")
