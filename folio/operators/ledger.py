"""Fetch outcomes, the failure ledger and text-cache state.

All three are keyed by thesis_id: J19 is a narrow map, J20 one aggregation
(partial max per task, so a thesis retried a million times is one buffer),
J21 a map plus a left join of the wanted ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.files import item_url
from folio.operators import registers as reg

# The reasons recorded in the ledger.
NOT_PDF = "not a PDF (restricted or a landing page)"
NO_TEXT = "no text and no page count"
PDF_MAGIC = "%PDF-"
GONE_STATUSES = [403, 404, 410]


def classify_fetch(outcomes: DataFrame) -> DataFrame:
    """One fetch attempt per row -> (ok, reason, permanent).

    Columns used: http_status (NULL = no response), expected_bytes,
    received_bytes, magic (first 5 bytes), readable, read_error, text_chars,
    n_pages and, if there, unexpected (the type of an exception outside these
    rules). Rules, in the order the fetch meets them: no response or HTTP error
    (permanent for 403/404/410), short read, not a PDF (permanent), unreadable,
    unexpected, no text and no page count; anything else is a success. The reason
    holds the first 120 characters of a read error; the column keeps it whole.
    """
    unexpected = (F.col("unexpected") if "unexpected" in outcomes.columns
                  else F.lit(None).cast("string"))
    status = F.col("http_status")
    truncated = (F.coalesce("expected_bytes", F.lit(0)) > 0) & (
        F.col("received_bytes") != F.col("expected_bytes")
    )
    read_error = F.coalesce(
        F.col("read_error") if "read_error" in outcomes.columns else F.lit(None),
        F.lit("PdfReadError: EOF marker not found"),
    )
    reason = (
        F.when(status.isNull() & unexpected.isNotNull(),
               F.concat(F.lit("unexpected: "), unexpected))
        .when(status.isNull(), F.lit("download failed: URLError"))
        .when(status >= 400,
              F.concat(F.lit("download failed: HTTPError "), status.cast("string")))
        .when(truncated, F.lit("download failed: OSError"))
        .when(F.coalesce(F.col("magic"), F.lit("")) != PDF_MAGIC, F.lit(NOT_PDF))
        .when(~F.coalesce(F.col("readable"), F.lit(False)),
              F.concat(F.lit("unreadable PDF: "), F.substring(read_error, 1, 120)))
        .when(unexpected.isNotNull(), F.concat(F.lit("unexpected: "), unexpected))
        .when((F.coalesce(F.col("text_chars"), F.lit(0)) == 0) & F.col("n_pages").isNull(),
              F.lit(NO_TEXT))
    )
    permanent = (
        F.when(status.isin(GONE_STATUSES), True)
        .when(status.isNull() | (status >= 400) | truncated, False)
        .when(F.coalesce(F.col("magic"), F.lit("")) != PDF_MAGIC, True)
        .otherwise(False)
    )
    return outcomes.select(
        "*",
        reason.alias("reason"),
        reason.isNull().alias("ok"),
        F.when(reason.isNotNull(), permanent).alias("permanent"),
    )


def outcome_registers(classified: DataFrame) -> DataFrame:
    """J20 as state: per thesis its latest outcome, a success included, so that outcomes may
    come in any order; ``registers.merge`` puts two lots together."""
    return classified.select("thesis_id", _outcome(
        1, F.col("at_ts"), F.col("event_id"), F.col("ok")).alias("o")).groupBy("thesis_id").agg(
        F.max("o").alias("o"))


def _outcome(gen: int, at: Column, event: Column, ok: Column) -> Column:
    # Leading field ``gen``: an earlier ledger row is older than every outcome.
    return F.struct(F.lit(gen).alias("gen"), at.alias("t"), event.cast("bigint").alias("e"),
                    ok.alias("ok"), F.col("pdf_url"), F.col("reason"), F.col("permanent"))


def ledger_of(registers: DataFrame) -> DataFrame:
    """The failure ledger that the latest outcomes make."""
    return registers.where(~F.col("o.ok")).select(
        F.col("thesis_id"),
        item_url("thesis_id").alias("item_url"),
        F.col("o.pdf_url").alias("pdf_url"),
        F.col("o.reason").alias("reason"),
        F.col("o.permanent").alias("permanent"),
        F.col("o.t").alias("failed_at"),
    )


def merge_failures(classified: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """The failure ledger after replaying outcomes in time order.

    A failure replaces the thesis's ledger row, a success deletes it, so the
    ledger holds a thesis exactly when its *latest* outcome (by time, then
    event id) is a failure. ``state`` (an earlier ledger) counts as older than
    every outcome.
    """
    latest = outcome_registers(classified)
    if state is not None:
        old = state.select("thesis_id", _outcome(
            0, F.col("failed_at"), F.lit(-1), F.lit(False)).alias("o"))
        latest = reg.merge(old, latest, "thesis_id")
    return ledger_of(latest)


def failure_report(ledger: DataFrame) -> DataFrame:
    """The triage table -- theses per (reason, permanent)."""
    return ledger.groupBy("reason", "permanent").agg(F.count(F.lit(1)).alias("n"))


def text_cache_state(doc_text: DataFrame, wanted: DataFrame, pages: int | None = 20,
                     offline: bool = False) -> DataFrame:
    """Per wanted thesis, is its cached text fresh, stale or missing.

    Stale when the total or kept count is unknown, or fewer pages were kept
    than ``min(pages, total)`` (``pages`` None = the whole document). Offline,
    stale text is used as it is and missing ids are skipped.
    """
    total, kept = F.col("n_pages"), F.col("kept")
    want = total if pages is None else F.least(F.lit(pages), total)
    stale = total.isNull() | kept.isNull() | (kept < want)
    cache = doc_text.select("thesis_id", "n_pages", "kept", F.lit(True).alias("_cached"))
    j = wanted.select("thesis_id").distinct().join(cache, "thesis_id", "left")
    state = (
        F.when(F.col("_cached").isNull(), "missing")
        .when(stale, "stale")
        .otherwise("fresh")
    )
    out = j.select(
        "thesis_id",
        state.alias("state"),
        # What a run does with it: fetch, or read the cache.
        F.when(F.col("_cached").isNull(), F.lit(None if offline else "fetch"))
        .when(stale & F.lit(not offline), "fetch")
        .otherwise("cache")
        .alias("action"),
    )
    return out.where(F.col("action").isNotNull()) if offline else out
