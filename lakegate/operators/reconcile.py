"""What a source says it holds against what was landed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakegate.functions.casts import lenient_long
from lakegate.functions.evaluation import with_computed
from lakegate.functions.json_text import allow_duplicate_keys, with_page_parts
from lakegate.operators.landing import page_numbers

# Pages one expansion step writes; a run of any length is cut into such blocks.
PAGE_BLOCK = 10_000
# Pages of a run that are put in order together.
PAGE_SPAN = 1 << 20


def total_in_metadata(raw_text: Column) -> Column:
    """The total a page declares, or NULL."""
    return lenient_long(F.get_json_object(raw_text, "$[0].total"))


def agreed_total(total: Column) -> Column:
    """Aggregate: the one total all pages agree on, NULL if there is none.

    Equal minimum and maximum means one distinct value, so the check needs no
    distinct shuffle, and a repeated task cannot change it. Pages without a
    readable total do not count.
    """
    return F.when(F.min(total) == F.max(total), F.max(total))


def declared_total(documents: DataFrame) -> DataFrame:
    """One row with ``expected_rows``: the total declared by all pages, or NULL."""
    totals = documents.select(total_in_metadata(F.col("raw_text")).alias("total"))
    return totals.agg(agreed_total(F.col("total")).alias("expected_rows"))


def page_metrics(documents: DataFrame) -> DataFrame:
    """Per page: declared page and page count, number of records, bytes of text.

    All but the bytes are NULL (no records: 0) unless the text is one JSON array of two.
    """
    allow_duplicate_keys(documents.sparkSession)
    opened = with_computed(with_page_parts(documents), page_numbers())
    is_pair = F.col("_is_pair")
    return opened.select(
        *documents.columns,
        F.when(is_pair, F.col("returned_page")).alias("returned_page"),
        F.when(is_pair, F.col("total_pages")).alias("total_pages"),
        F.greatest(F.coalesce("record_count", F.lit(0)), F.lit(0)).cast("bigint").alias("record_count"),
        "source_bytes",
    )


def expected_pages(runs: DataFrame) -> DataFrame:
    """``run_id, start_page, pages_expected`` -> one row per expected page.

    A run is first cut into blocks and the blocks are spread before they are
    expanded, so even one run with billions of pages is written by many tasks.
    """
    start, end = F.col("start_page").cast("bigint"), F.col("pages_expected").cast("bigint")
    last_block = F.floor((end - start) / PAGE_BLOCK).cast("bigint")
    blocks = (
        runs.filter(F.col("pages_expected") >= F.col("start_page"))
        .select(
            "run_id",
            "start_page",
            "pages_expected",
            F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)).alias("block"),
        )
        .repartition("run_id", "block")
    )
    first = start + F.col("block") * PAGE_BLOCK
    last = F.least(first + (PAGE_BLOCK - 1), end)
    pages = blocks.select("run_id", F.explode(F.sequence(first, last)).alias("page"))
    return pages


def missing_pages(runs: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected pages of each run that never landed: ``run_id, page``.

    ``landed`` holds ``run_id, page``. The join key is the pair, which spreads a
    run with a third of all pages over every partition.
    """
    return expected_pages(runs).join(
        landed.select("run_id", "page"), on=["run_id", "page"], how="left_anti"
    )


def missing_page_ranges(runs: DataFrame, landed: DataFrame) -> DataFrame:
    """Stretches of expected pages that never landed: ``run_id, from_page, to_page``.

    The work follows the pages there are, whatever number is declared: a page is compared with
    the one before it. Pages are ordered in blocks of ``PAGE_SPAN`` numbers, so no run is sorted
    in one task; the last page before a block comes from the blocks' own ends.
    ``runs`` holds ``run_id, start_page, pages_expected``, ``landed`` ``run_id, page``. A page
    that landed twice counts once; pages outside the expected ones do not count.
    """
    wanted = runs.filter(F.col("pages_expected") >= F.col("start_page")).select(
        "run_id", F.col("start_page").cast("bigint").alias("_from"), F.col("pages_expected").cast("bigint").alias("_to")
    )
    page = F.col("page").cast("bigint").alias("page")
    inside = landed.select("run_id", page).join(wanted, "run_id").filter(F.col("page").between(F.col("_from"), F.col("_to")))
    inside = inside.select("run_id", "page", F.floor(F.col("page") / PAGE_SPAN).alias("_block")).distinct()
    ends = inside.groupBy("run_id", "_block").agg(F.max("page").alias("_last"))
    order = Window.partitionBy("run_id").orderBy("_block")
    before = ends.select("run_id", "_block", F.lag("_last").over(order).alias("_before"))
    own = Window.partitionBy("run_id", "_block").orderBy("page")
    steps = inside.withColumn("_prior", F.lag("page").over(own)).join(before, ["run_id", "_block"]).select(
        "run_id", "page", F.coalesce("_prior", "_before").alias("_prior")
    )
    first = F.coalesce(F.col("_prior") + 1, F.col("_from"))
    gaps = steps.join(wanted, "run_id").filter(first < F.col("page"))
    gaps = gaps.select("run_id", first.alias("from_page"), (F.col("page") - 1).alias("to_page"))
    reached = ends.groupBy("run_id").agg(F.max("_last").alias("_last"))
    rest = wanted.join(reached, "run_id", "left").withColumn("from_page", F.coalesce(F.col("_last") + 1, F.col("_from")))
    rest = rest.filter(F.col("from_page") <= F.col("_to")).select("run_id", "from_page", F.col("_to").alias("to_page"))
    return gaps.union(rest)


def expected_from_landed(landed: DataFrame) -> DataFrame:
    """Pages each run should have: the count declared by its last landed page."""
    return landed.groupBy("run_id").agg(
        F.min("start_page").alias("start_page"),
        F.max_by("total_pages", "page").alias("pages_expected"),
    )


def within_run(pages: DataFrame, sound: Column) -> DataFrame:
    """Pages from the start of their run to its end, with ``is_last``.

    A run ends at the first sound page that reaches its own page count; pages
    after it, and those before ``start_page``, are no part of the run. ``pages``
    holds ``run_id, page, start_page, total_pages``.
    """
    reaches = sound & (F.col("page") >= F.col("total_pages")) & (F.col("page") >= F.col("start_page"))
    ends = pages.groupBy(F.col("run_id").alias("_run")).agg(
        F.min(F.when(reaches, F.col("page"))).alias("_end")
    )
    inside = pages.join(ends, F.col("run_id") == F.col("_run")).filter(
        (F.col("page") >= F.col("start_page"))
        & (F.col("_end").isNull() | (F.col("page") <= F.col("_end")))
    )
    return inside.withColumn(
        "is_last", F.coalesce(F.col("page") == F.col("_end"), F.lit(False))
    ).drop("_run", "_end")


def first_gaps(runs: DataFrame, pages: DataFrame) -> DataFrame:
    """The first page of each run that should be there and is not: ``run_id, page``.

    ``runs`` holds ``run_id, start_page``, and ``pages`` what :func:`within_run`
    gives. Only the start and the page after each page are looked for, so the
    work follows the pages there are, whatever number they declare.
    """
    followers = pages.filter(~F.col("is_last")).select(
        "run_id", (F.col("page") + 1).cast("bigint").alias("page")
    )
    wanted = runs.select("run_id", F.col("start_page").cast("bigint").alias("page")).union(followers)
    present = pages.select("run_id", F.col("page").cast("bigint").alias("page"))
    absent = wanted.join(present, ["run_id", "page"], "left_anti")
    return absent.groupBy("run_id").agg(F.min("page").alias("page"))


def page_mismatches(pages: DataFrame) -> DataFrame:
    """Pages whose source answered with another page than the requested one."""
    return pages.filter(~F.col("page").eqNullSafe(F.col("returned_page"))).select(
        "run_id", "page", "returned_page"
    )
