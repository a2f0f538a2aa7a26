"""Work-queue planning (J26) and pending file-index selection.

The queue is composed from Column predicates chosen by the caller's options;
Catalyst folds the unused ones away. Every join is on thesis_id: small
"already done" sets (titlepages, failures, wanted ids) are anti/semi joins,
which AQE turns into broadcasts at runtime only when their measured size is
under the broadcast threshold, and into shuffled joins otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.operators.election import queue_candidates

MAX_LONG = 2 ** 63 - 1


def plan_queue(
    metadata: DataFrame,
    thesis_file: DataFrame,
    titlepage: DataFrame,
    failures: DataFrame,
    *,
    as_of,
    degree_level: str = "master",
    ids: DataFrame | None = None,
    cached_ids: DataFrame | None = None,
    retry_failed: bool = False,
    max_bytes: int | None = None,
    include_closed: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Which theses to fetch next, smallest open file first.

    ``ids`` (a one-column DataFrame of thesis_id) replaces the degree,
    already-parsed and failed filters. ``cached_ids`` switches to offline mode:
    the candidate set is the cached texts and the url, parsed, failed and
    closed filters are off. Ties in the original are undefined; here the
    candidate file is fully ordered and the queue is ordered by thesis_id last.
    """
    m = metadata.select("thesis_id", "degree_level")
    cached_only = cached_ids is not None
    if cached_only:
        m = m.join(cached_ids.select("thesis_id").distinct(), "thesis_id", "left_semi")
    if ids is not None:
        m = m.join(ids.select("thesis_id").distinct(), "thesis_id", "left_semi")
    else:
        m = m.where((F.col("degree_level") == degree_level) | F.col("degree_level").isNull())
        if not cached_only:
            m = m.join(titlepage.select("thesis_id"), "thesis_id", "left_anti")
            if not retry_failed:
                permanent = failures.where(F.col("permanent")).select("thesis_id")
                m = m.join(permanent, "thesis_id", "left_anti")

    f = queue_candidates(thesis_file, as_of)
    q = m.join(f, "thesis_id", "left")
    if not cached_only:
        q = q.where(F.col("pdf_url").isNotNull())
    if max_bytes:
        q = q.where(F.coalesce("open_size", "any_size", F.lit(0)) <= F.lit(max_bytes))
    if not include_closed and not cached_only:
        # With pdf_url required, a thesis always has a candidate here, so the
        # original's "no candidate file" arm cannot fire and is left out.
        q = q.where(F.col("open_pdfs") > 0)
    q = q.select(
        "thesis_id",
        "pdf_url",
        F.coalesce("open_size", "any_size", F.lit(MAX_LONG).cast("bigint")).alias("cost"),
    )
    q = q.orderBy("cost", "thesis_id")
    return q.limit(limit) if limit else q


def pending_index(thesis: DataFrame, status: DataFrame, *, ids: DataFrame | None = None,
                  limit: int | None = None) -> DataFrame:
    """Items whose file table has not been indexed, by id. Given ids
    override the anti-join and the limit."""
    t = thesis.select(F.col("id").alias("thesis_id"))
    if ids is not None:
        return t.join(ids.select("thesis_id").distinct(), "thesis_id", "left_semi").orderBy(
            "thesis_id"
        )
    q = t.join(status.select("thesis_id"), "thesis_id", "left_anti").orderBy("thesis_id")
    return q.limit(limit) if limit else q
