"""Document text in (J8, J9): cached marked text and page-wise extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the first line of a cached text carries the page counts.
PAGE_MARKER = "%%PAGES\t"


def split_marker(raw: DataFrame) -> DataFrame:
    """``(thesis_id, raw)`` -> ``(thesis_id, n_pages, kept, text)``.

    ``%%PAGES\\t<total>\\t<kept>`` on the first line: no marker -> (raw, NULL,
    NULL); an unreadable total -> (rest, NULL, NULL); a missing or unreadable
    kept count -> kept NULL (an old cache, always stale).
    """
    r = F.col("raw")
    has = F.coalesce(r.startswith(PAGE_MARKER), F.lit(False))
    nl = F.instr(r, "\n")
    head = F.when(nl > 0, F.substring(r, 1, nl - 1)).otherwise(r)
    rest = F.when(nl > 0, F.expr("substring(raw, instr(raw, '\\n') + 1)")).otherwise(F.lit(""))
    fields = F.split(F.substring(head, len(PAGE_MARKER) + 1, 1 << 30), "\t")
    total = F.trim(F.try_element_at(fields, F.lit(1))).try_cast("int")
    kept = F.trim(F.try_element_at(fields, F.lit(2))).try_cast("int")
    return raw.select(
        "thesis_id",
        F.when(has, total).alias("n_pages"),
        F.when(has & total.isNotNull(), kept).alias("kept"),
        F.when(has, rest).otherwise(r).alias("text"),
    )


def assemble_text(page_rows: DataFrame, n: int | None = 20) -> DataFrame:
    """Page-wise text -> one document per thesis.

    The first ``n`` pages (all when ``n`` is None) are joined with newlines in
    page order, however pages are numbered; a failed page contributes '' and
    keeps its place. The document fails only when every kept page failed. Only
    pages inside the window are collected, so a thesis's buffer is at most ``n``
    pages; without ``n`` it is the document itself.
    """
    if n is not None:
        first = Window.partitionBy("thesis_id").orderBy("page_no")
        page_rows = page_rows.withColumn("_rank", F.row_number().over(first))
    page_txt = F.when(F.coalesce("failed", F.lit(False)), F.lit("")).otherwise(
        F.coalesce("text", F.lit("")))
    in_window = F.lit(True) if n is None else (F.col("_rank") <= n)
    g = page_rows.groupBy("thesis_id").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.sort_array(F.collect_list(F.when(in_window, F.struct("page_no", page_txt.alias("t")))))
        .alias("pages"),
        F.count_if(in_window & F.coalesce("failed", F.lit(False))).alias("_failed"),
    )
    kept = F.size("pages")
    return g.select(
        "thesis_id",
        F.col("n_pages").cast("int").alias("n_pages"),
        kept.cast("int").alias("kept"),
        F.array_join(F.transform("pages", lambda p: p["t"]), "\n").alias("text"),
        ((kept > 0) & (F.col("_failed") == kept)).alias("failed"),
    )
