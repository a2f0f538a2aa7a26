"""Election of the one file per item that is the document.

Both elections are a ``groupBy(thesis_id)`` over a struct ``max`` followed by a
join back on thesis_id. The aggregation combines map-side, so a thesis with a
million attachments (or a third of all rows) still ships one partial row per
task; a window would have to sort the whole group in one task instead. The
join back is on the same key, so it reuses the aggregation's partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.functions import files as ff


def _join_role(files: DataFrame, winners: DataFrame) -> DataFrame:
    w = winners.select("thesis_id", F.col("_pos").alias("_win_pos"))
    return (
        files.join(w, "thesis_id", "left")
        .withColumn(
            "role",
            F.when(F.col("pos") == F.col("_win_pos"), F.lit("primary")).otherwise("secondary"),
        )
        .drop("_win_pos")
    )


def elect_primary_scored(files: DataFrame) -> DataFrame:
    """J24 (bundle listing): among ``filetype == 'PDF'`` files, the best
    (score, size or 0) wins, first listed on ties; a winner whose description
    *and* filename both say it is a form (score <= -7) means nobody wins.
    Every input row is returned with ``role`` primary / secondary."""
    scored = files.where(F.col("filetype") == "PDF").select(
        "thesis_id",
        F.struct(
            ff.thesis_score("description", "filename").alias("score"),
            F.coalesce(F.col("size_bytes"), F.lit(0)).alias("size"),
            (-F.col("pos")).alias("neg_pos"),
        ).alias("k"),
    )
    best = scored.groupBy("thesis_id").agg(F.max("k").alias("best"))
    winners = best.where(F.col("best.score") > -7).select(
        "thesis_id", (-F.col("best.neg_pos")).alias("_pos")
    )
    return _join_role(files, winners)


def elect_primary_tiered(files: DataFrame) -> DataFrame:
    """J25 (item-page grid): PDFs (any case). Full-text files if there are any,
    otherwise PDFs not marked as forms by description or filename; the largest
    (NULL size = -1) wins, first listed on ties. May elect nobody."""
    pdf = F.upper(F.coalesce(F.col("filetype"), F.lit(""))) == "PDF"
    tier = (
        F.when(ff.is_fulltext("description"), 1)
        .when(ff.looks_like_thesis("description", "filename"), 0)
    )
    cands = files.where(pdf).select(
        "thesis_id",
        F.struct(
            tier.alias("tier"),
            F.coalesce(F.col("size_bytes"), F.lit(-1)).alias("size"),
            (-F.col("pos")).alias("neg_pos"),
        ).alias("k"),
    ).where(F.col("k.tier").isNotNull())
    winners = cands.groupBy("thesis_id").agg(F.max("k").alias("best")).select(
        "thesis_id", (-F.col("best.neg_pos")).alias("_pos")
    )
    return _join_role(files, winners)


def candidate_sort_key() -> list:
    """Order of preference for the file a queue entry fetches (planning rule 1)."""
    return [
        F.when(F.col("role") == "primary", 0).otherwise(1),
        F.when(F.col("description") == "Heildartexti", 0).otherwise(1),
        F.when(
            F.lower(F.coalesce(F.col("description"), F.lit(""))).isin(
                ff.DECLARATION_DESCRIPTIONS
            ),
            1,
        ).otherwise(0),
    ]


def queue_candidates(thesis_file: DataFrame, as_of) -> DataFrame:
    """One row per thesis: its preferred PDF and what is known about getting it.

    Aggregation form: ``min`` over a struct whose leading fields are the sort
    keys (size descending = negated, NULLs last), trailing fields the payload.
    """
    key = candidate_sort_key()
    open_ = ff.is_open("access", as_of)
    s = thesis_file.where(F.col("filetype") == "PDF").select(
        "thesis_id",
        F.struct(
            key[0].alias("k0"), key[1].alias("k1"), key[2].alias("k2"),
            F.col("size_bytes").isNull().alias("k3"),
            (-F.col("size_bytes")).alias("k4"),
            F.col("filename").alias("k5"),
            F.col("url").alias("k6"),
            F.col("size_bytes").alias("size_bytes"),
            F.coalesce(open_, F.lit(False)).alias("is_open"),
        ).alias("c"),
    )
    best = s.groupBy("thesis_id").agg(F.min("c").alias("c"))
    return best.select(
        "thesis_id",
        F.col("c.k6").alias("pdf_url"),
        F.when(F.col("c.is_open"), 1).otherwise(0).alias("open_pdfs"),
        F.when(F.col("c.is_open"), F.col("c.size_bytes")).alias("open_size"),
        F.col("c.size_bytes").alias("any_size"),
    )


def queue_candidates_window(thesis_file: DataFrame, as_of) -> DataFrame:
    """The same candidate by ``row_number`` over a window -- the shape of
    the original SQL. Kept to prove the aggregation form equivalent; the
    window sorts each thesis's files inside one task."""
    key = candidate_sort_key()
    w = Window.partitionBy("thesis_id").orderBy(
        *key, F.col("size_bytes").desc_nulls_last(), F.col("filename"), F.col("url")
    )
    open_ = F.coalesce(ff.is_open("access", as_of), F.lit(False))
    ranked = thesis_file.where(F.col("filetype") == "PDF").withColumn("rn", F.row_number().over(w))
    return ranked.where(F.col("rn") == 1).select(
        "thesis_id",
        F.col("url").alias("pdf_url"),
        F.when(open_, 1).otherwise(0).alias("open_pdfs"),
        F.when(open_, F.col("size_bytes")).alias("open_size"),
        F.col("size_bytes").alias("any_size"),
    )
