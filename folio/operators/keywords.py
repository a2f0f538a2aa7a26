"""Keyword dictionary and per-thesis links.

The dictionary key is the normalised keyword itself, so links need no
dictionary lookup join and no global sequence. Common keywords are hot keys;
the dictionary is a ``min`` aggregation that combines map-side, so a keyword
on a third of all theses still costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions.text import fold
from folio.operators import registers as reg


def keyword_norm(c: F.Column) -> F.Column:
    return F.trim(fold(c))


def keyword_registers(fields: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``fields(thesis_id, file_name, pos, keywords)`` as state that carries record order:
    (keyword_norm, first) with the first spelling seen, (thesis_id, last) with the last
    record's list, an empty one included."""
    exploded = fields.select(reg.record_order().alias("o"), F.explode("keywords").alias("keyword"))
    dictionary = exploded.groupBy(keyword_norm(F.col("keyword")).alias("keyword_norm")).agg(
        F.min(reg.register(F.col("keyword"), F.col("o"))).alias("first"))
    links = fields.groupBy("thesis_id").agg(F.max(reg.register(F.col("keywords"))).alias("last"))
    return dictionary, links


def merge_keywords(state: tuple[DataFrame, DataFrame] | None, batch: tuple[DataFrame, DataFrame]
                   ) -> tuple[DataFrame, DataFrame]:
    """Registers of two lots of records, in whatever order they came."""
    if state is None:
        return batch
    return (reg.merge(state[0], batch[0], "keyword_norm", first=True),
            reg.merge(state[1], batch[1], "thesis_id"))


def keyword_tables(dictionary: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """dictionary(keyword_norm, keyword) and links(thesis_id, keyword_norm, sort_order) of the
    registers."""
    listed = links.select("thesis_id", F.posexplode("last.v").alias("sort_order", "keyword"))
    return dictionary.select("keyword_norm", F.col("first.v").alias("keyword")), listed.select(
        "thesis_id", keyword_norm(F.col("keyword")).alias("keyword_norm"),
        F.col("sort_order").cast("int").alias("sort_order"))


def build_keywords(fields: DataFrame, dictionary_state: DataFrame | None = None,
                   links_state: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``fields(thesis_id, file_name, pos, keywords)`` -> (dictionary, links).

    dictionary(keyword_norm, keyword): display spelling = first seen in record
    order. links(thesis_id, keyword_norm, sort_order): each thesis's list is
    replaced by its *last* record's list -- even an empty one. Over the plain state of
    earlier runs known keywords keep their spelling, and theses outside this
    batch their links; where records may come late, keep ``keyword_registers``.
    """
    registers = keyword_registers(fields)
    dictionary, links = keyword_tables(*registers)
    if dictionary_state is not None:
        dictionary = dictionary_state.select("keyword_norm", "keyword").unionByName(
            dictionary.join(dictionary_state.select("keyword_norm"), "keyword_norm", "left_anti"))
    if links_state is not None:
        links = links_state.select("thesis_id", "keyword_norm", "sort_order").join(
            registers[1].select("thesis_id"), "thesis_id", "left_anti").unionByName(links)
    return dictionary, links
