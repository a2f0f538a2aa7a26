"""Harvest progress per (prefix, set).

The resumable state of a paged harvest, derived from the pages already
stored: one aggregation per set over page rows (never over records).

Where pages of several runs are stored together, each carries ``context``, the digest of
its run's parameters: a run resumes from pages of its own context only. A page names the
offset of the next one in its token, so a page that is not there can be named too.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.sources import oai_dc


def harvest_progress(pages: DataFrame) -> DataFrame:
    """Per set: pages stored, the last offset, the last page's token, the
    offset to resume from (token tail ``/<n>``, else last + 1) and whether
    the set is complete (its last page carries no token)."""
    p = oai_dc.page_tokens(pages).select(
        *oai_dc.lineage_columns(F.col("file_name")), "token")
    g = p.groupBy("prefix", "set_spec").agg(
        F.count(F.lit(1)).alias("pages"),
        F.max(F.struct("page_offset", "token")).alias("last"),
    )
    tail = F.nullif(F.regexp_extract(F.coalesce("last.token", F.lit("")), r"/(\d+)$", 1), F.lit(""))
    return g.select(
        "prefix", "set_spec", F.col("pages").cast("bigint").alias("pages"),
        F.col("last.page_offset").alias("last_offset"),
        F.col("last.token").alias("next_token"),
        F.coalesce(tail.try_cast("bigint"), F.col("last.page_offset") + 1).alias("next_offset"),
        F.col("last.token").isNull().alias("complete"),
    )


def context_digest(**params) -> str:
    """The digest of a run's parameters (years, prefix, set, output ...), whatever their order."""
    return hashlib.sha256(json.dumps(params, sort_keys=True, default=str).encode()).hexdigest()[:16]


def _page_chain(pages: DataFrame) -> DataFrame:
    """``(context, prefix, set_spec, page_offset, token, next_offset)`` of each good page."""
    token = oai_dc.page_tokens(pages.select("file_name", "xml", "context"), "context")
    tail = F.nullif(F.regexp_extract(F.coalesce("token", F.lit("")), r"/(\d+)$", 1), F.lit(""))
    return token.select("context", *oai_dc.lineage_columns(F.col("file_name")), "token",
                        tail.try_cast("bigint").alias("next_offset"))


def missing_pages(pages: DataFrame) -> DataFrame:
    """``pages(file_name, xml, context)`` -> ``(context, prefix, set_spec, after_offset,
    missing_offset)``: offsets that a stored page's token names, with pages stored beyond
    them but not there. The join is on the offset too, so a large set is no hot key."""
    p = _page_chain(pages)
    place = ["context", "prefix", "set_spec"]
    last = p.groupBy(*place).agg(F.max("page_offset").alias("_last"))
    named = p.where(F.col("next_offset").isNotNull()).select(
        *place, F.col("page_offset").alias("after_offset"),
        F.col("next_offset").alias("missing_offset"))
    there = p.select(*place, F.col("page_offset").alias("missing_offset"))
    return named.join(there, [*place, "missing_offset"], "left_anti").join(last, place).where(
        F.col("missing_offset") <= F.col("_last")).drop("_last")


def resume_points(pages: DataFrame, context: str) -> DataFrame:
    """Per set of the run ``context``: where it goes on. At the first missing page if there is
    one, else after the last stored page; no row for a set it has no page of, nor for one
    that is complete."""
    own = pages.where(F.col("context") == context)
    place = ["prefix", "set_spec"]
    gaps = missing_pages(own).groupBy(*place).agg(
        F.count(F.lit(1)).alias("missing"), F.min("missing_offset").alias("first_missing"))
    last = _page_chain(own).groupBy(*place).agg(
        F.max(F.struct("page_offset", "token", "next_offset")).alias("last"))
    return last.join(gaps, place, "left").select(
        *place, F.coalesce("first_missing", "last.next_offset").alias("resume_offset"),
        F.coalesce("missing", F.lit(0)).alias("missing")).where(
        F.col("resume_offset").isNotNull())
