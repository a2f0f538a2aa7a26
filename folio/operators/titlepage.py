"""Title-page extraction, a narrow map over ``doc_text``.

No shuffle: every output row depends on one input row, so the job is a single
scan -> project stage at any scale, parallel over the text table's splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions import titlepage as tp
from folio.functions.text import text_lines

TITLEPAGE_COLUMNS = [
    "thesis_id", "faculty", "school", "department", "deild", "svid", "ects", "degree",
    "subject", "committee", "examiner", "advisors", "year_on_page", "n_pages", "text_chars",
]


def extract_titlepage(doc_text: DataFrame, partitions: int | None = None) -> DataFrame:
    """``doc_text(thesis_id, n_pages, text)`` -> ``thesis_titlepage``.

    A row is produced when there is text or at least a page count (a scanned
    document still gets its row); a row with neither is a failure, see
    ``folio.operators.ledger.classify_fetch``. The text is not moved: scan splits set
    the parallelism. ``partitions`` spreads it first, for a source of few, large
    splits.
    """
    src = doc_text.where(
        (F.coalesce(F.length("text"), F.lit(0)) > 0) | F.col("n_pages").isNotNull())
    if partitions:
        src = src.repartition(partitions, "thesis_id")
    # Three projections, so that per-page intermediates (the line array, the
    # unit names, the block-break flags) are computed once and shared; the
    # optimizer does not collapse projections that would duplicate them.
    lines = F.col("_lines")
    stage1 = src.select(
        "thesis_id",
        F.col("n_pages").cast("int").alias("n_pages"),
        F.coalesce(F.length("text"), F.lit(0)).cast("int").alias("text_chars"),
        text_lines("text").alias("_lines"),
    )
    stage2 = stage1.select(
        "thesis_id", "n_pages", "text_chars", "_lines",
        F.array_join(lines, " ").alias("_joined"),
        tp.unit_names(lines).alias("_units"),
        tp.block_breaks(lines).alias("_breaks"),
        *[tp.heading_at(lines, r).alias(f"_at_{r}") for r in ("committee", "examiner", "advisors")],
    )
    joined, units, breaks = F.col("_joined"), F.col("_units"), F.col("_breaks")
    deild, svid = tp.unit_kinds(units)
    return stage2.select(
        F.col("thesis_id"),
        tp.unit_en(lines, "faculty").alias("faculty"),
        tp.unit_en(lines, "school").alias("school"),
        tp.unit_en(lines, "department").alias("department"),
        deild.alias("deild"),
        svid.alias("svid"),
        tp.ects(joined).alias("ects"),
        tp.degree_stated(joined).alias("degree"),
        tp.subject(lines).alias("subject"),
        *[tp.people_block(lines, breaks, F.col(f"_at_{r}")).alias(r)
          for r in ("committee", "examiner", "advisors")],
        tp.year_on_page(lines).alias("year_on_page"),
        "n_pages",
        "text_chars",
    )


def replace_titlepages(state: DataFrame, failures: DataFrame, new_rows: DataFrame
                       ) -> tuple[DataFrame, DataFrame]:
    """(titlepages, failures) after a load: the newest extraction replaces a thesis's
    row, and its failure is cleared."""
    done = new_rows.select("thesis_id")
    kept = state.select(*TITLEPAGE_COLUMNS).join(done, "thesis_id", "left_anti")
    return (kept.unionByName(new_rows.select(*TITLEPAGE_COLUMNS)),
            failures.join(done, "thesis_id", "left_anti"))
