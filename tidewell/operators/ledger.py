"""Run ledger of a paged load, derived from the pages that were committed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAGE_SIZE = 1000


def page_log(rows: DataFrame, item: str | None = None) -> DataFrame:
    """One row per committed page from the loaded rows (``run_id``, ``page``, ...).

    Name an ``item`` column if a row without item marks a page that was empty.
    """
    return rows.groupBy("run_id", "page").agg(F.count(item or "*").cast("int").alias("n"))


def run_progress(pages: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Last page, rows loaded and, once the list is whole, its size.

    ``last_page`` is the last one with rows before the first page that is missing, so the page
    behind it is where a run goes on. A run is complete if no page is missing, its last
    one is short and every page before is full, so the last page with rows decides the size of the
    list. The size is NULL for other runs, and for a list without rows. ``page_faults`` says why
    a run with a short page is not complete.

    The pages of a run meet in one row: one number pair for each ``page_size`` games.
    """
    in_order = F.sort_array(F.collect_list(F.struct("page", "n")))
    runs = pages.groupBy("run_id").agg(
        in_order.alias("pages"), F.sum("n").cast("int").alias("games_loaded")
    )
    # Pages are distinct, so one stands at its own number only if none before it is missing.
    whole = F.filter("pages", lambda x, k: x["page"] == k)
    filled = F.element_at(F.filter(whole, lambda x: x["n"] > 0), -1)
    # a short page ends a list, so there is one and it is the last
    short = F.exists(F.slice("pages", -1, 1), lambda x: x["n"] < page_size)
    short &= F.size(F.filter("pages", lambda x: x["n"] < page_size)) == 1
    progress = runs.select(
        "run_id",
        F.when(F.exists(whole, lambda x: x["n"] > 0), filled).alias("filled"),
        "games_loaded",
        ((F.size(whole) == F.size("pages")) & short).alias("is_complete"),
    )
    size = F.col("filled.page") * page_size + F.col("filled.n")
    return progress.select(
        "run_id",
        F.col("filled.page").alias("last_page"),
        "games_loaded",
        "is_complete",
        F.when(F.col("is_complete"), size).alias("list_size"),
    )


def page_faults(pages: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """``(run_id, page, upto, fault)``: what keeps the committed pages from being one whole list.

    - "missing": pages ``page`` to ``upto`` are not there, but a later one is;
    - "short": a page that is not full, though it is not the last one;
    - "after the end": a page behind a short one, where the list had ended.

    One shuffle by run. An open run whose pages so far are all full has no faults.
    """
    by_page = Window.partitionBy("run_id").orderBy("page")
    before = by_page.rowsBetween(Window.unboundedPreceding, -1)
    short = F.col("n") < page_size
    seen = pages.select(
        "run_id", "page",
        (F.coalesce(F.lag("page").over(by_page), F.lit(-1)) + 1).alias("due"),
        (short & F.lead("page").over(by_page).isNotNull()).alias("short"),
        F.coalesce(F.max(short).over(before), F.lit(False)).alias("ended"),
    )

    def fault(when: Column, first: str, last: Column, name: str) -> Column:
        return F.when(when, F.struct(F.col(first).alias("page"), last.alias("upto"), F.lit(name).alias("fault")))

    found = F.array(
        fault(F.col("due") < F.col("page"), "due", F.col("page") - 1, "missing"),
        fault(F.col("short"), "page", F.col("page"), "short"),
        fault(F.col("ended"), "page", F.col("page"), "after the end"),
    )
    return seen.select("run_id", F.inline(F.array_compact(found)))


def resume_point(runs: DataFrame) -> DataFrame:
    """One row ``(run_id, next_page, resumed)``: the newest open run, else a new one.

    A new run gets the highest run id plus one and starts at page 0. One pass and one
    row of state per task, also on an empty ledger.
    """
    open_run = F.max(F.when(F.col("finished_at").isNull(), F.struct("run_id", "last_page")))
    return runs.agg(open_run.alias("open"), F.max("run_id").alias("newest")).select(
        F.coalesce(F.col("open.run_id"), F.coalesce("newest", F.lit(0)) + 1)
        .cast("bigint")
        .alias("run_id"),
        F.coalesce(F.col("open.last_page") + 1, F.lit(0)).alias("next_page"),
        F.col("open").isNotNull().alias("resumed"),
    )


def start_run(runs: DataFrame, started_at: Column, anew: bool = False) -> DataFrame:
    """``runs`` with a row for a new run, or unchanged if an open run is resumed.

    ``anew`` leaves an open run as it is, for one whose pages cannot become a whole list.
    """
    if anew:
        point = runs.agg((F.coalesce(F.max("run_id"), F.lit(0)) + 1).cast("bigint").alias("run_id"))
    else:
        point = resume_point(runs).filter(~F.col("resumed"))
    new = point.select(
        "run_id",
        started_at.cast("timestamp_ntz").alias("started_at"),
        F.lit(None).cast("timestamp_ntz").alias("finished_at"),
        F.lit(None).cast("int").alias("last_page"),
        F.lit(0).alias("games_loaded"),
        F.lit(None).cast("int").alias("list_size"),
    )
    return runs.unionByName(new)


def run_ledger(
    runs: DataFrame, pages: DataFrame, finished_at: Column, page_size: int = PAGE_SIZE
) -> DataFrame:
    """``runs`` brought up to date with the page log.

    Progress is recomputed from the committed pages, so a page that is replayed is
    not counted twice. Runs without pages in the log keep their row. Open runs are finished at
    ``finished_at`` once all their pages are in.
    """
    kept = ["last_page", "games_loaded", "list_size"]
    own = runs.withColumnsRenamed({c: f"__{c}" for c in kept})
    progress = run_progress(pages, page_size)
    done = F.coalesce(F.col("is_complete"), F.lit(False))
    ended = F.when(done, finished_at.cast("timestamp_ntz"))
    return own.join(progress, "run_id", "left").select(
        "run_id",
        "started_at",
        F.coalesce("finished_at", ended).alias("finished_at"),
        F.when(F.col("is_complete").isNull(), F.col("__last_page"))
        .otherwise(F.col("last_page"))
        .alias("last_page"),
        F.coalesce("games_loaded", "__games_loaded").alias("games_loaded"),
        F.coalesce("__list_size", "list_size").alias("list_size"),
    )
