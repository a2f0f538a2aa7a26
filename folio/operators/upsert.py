"""Upsert algebra as ``state x batch -> state'`` functions.

There is no row-level UPDATE: each job is an aggregation and an outer or anti
join on thesis_id, so it runs in a fixed number of shuffles regardless of how
many records a batch holds. Record order is ``ord = struct(file_name, pos)``;
"first" / "last" are struct ``min`` / ``max``, which combine map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions import metadata as md
from folio.functions.files import abs_url
from folio.operators import registers as reg

THESIS_COLUMNS = ["id", "date_accepted", "title", "authors"]
METADATA_FIELDS = [
    "title_is", "title_en", "abstract_is", "abstract_en", "degree_level", "thesis_type",
    "note", "related_url", "raw_keywords", "institution", "university",
]


def _ord() -> F.Column:
    return F.struct(F.col("file_name"), F.col("pos"))


def upsert_thesis(state: DataFrame | None, records: DataFrame) -> DataFrame:
    """Insert-only. Ids already in ``state`` are untouched; a new id is
    inserted once, from its first record in (file, position) order."""
    first = records.groupBy(F.col("id")).agg(
        F.min(F.struct(_ord().alias("o"), "date_accepted", "title", "authors")).alias("r")
    )
    new = first.select(
        F.col("id"),
        md.parse_date4(F.col("r.date_accepted")).alias("date_accepted"),
        F.col("r.title").alias("title"),
        F.col("r.authors").alias("authors"),
    )
    if state is None:
        return new
    fresh = new.join(state.select("id"), "id", "left_anti")
    return state.select(*THESIS_COLUMNS).unionByName(fresh)


def metadata_fields(records: DataFrame) -> DataFrame:
    """Per record: the derived metadata columns (E3-E8) and its keyword list."""
    title_is, title_en = md.split_title("title")
    abs_is, abs_en, note = md.abstracts_and_note(F.col("descriptions"))
    keywords = md.split_keywords(F.col("subjects"))
    with_level = records.select(
        "id", "file_name", "pos", "types", "contributors", "relations",
        title_is.alias("title_is"), title_en.alias("title_en"),
        abs_is.alias("abstract_is"), abs_en.alias("abstract_en"), note.alias("note"),
        keywords.alias("keywords"),
        md.degree_from_list(F.col("types")).alias("degree_level"),
    )
    institution = md.first_deduped(F.col("contributors"))
    return with_level.select(
        F.col("id").alias("thesis_id"), "file_name", "pos", "keywords",
        "title_is", "title_en", "abstract_is", "abstract_en", "degree_level",
        md.thesis_types(F.col("types"), F.col("degree_level")).alias("thesis_type"),
        "note",
        md.first_deduped(F.col("relations")).alias("related_url"),
        F.when(F.size("keywords") > 0, F.array_join("keywords", "; ")).alias("raw_keywords"),
        institution.alias("institution"),
        institution.alias("university"),
    )


def metadata_registers(records: DataFrame) -> DataFrame:
    """J11 as state: per thesis and field the last non-NULL value and its record order. Merged
    by ``registers.merge``, whatever the order in which records arrive.

    One ``groupBy(thesis_id)`` computes every field, by ``max`` over ``struct(order, value)``.
    """
    return metadata_fields(records).groupBy("thesis_id").agg(
        *[F.max(reg.register(F.col(c))).alias(c) for c in METADATA_FIELDS])


def merge_metadata(state: DataFrame | None, records: DataFrame) -> DataFrame:
    """Per thesis and per field, the last non-NULL value in record order wins; a field no
    record fills keeps its old value; new theses appear. ``state`` holds plain values, older
    than any record; where records may come late, keep ``metadata_registers`` instead."""
    folded = reg.values(metadata_registers(records), "thesis_id")
    if state is None:
        return folded
    old = state.select("thesis_id", *[F.col(c).alias(f"_old_{c}") for c in METADATA_FIELDS])
    j = folded.join(old, "thesis_id", "full_outer")
    return j.select(
        "thesis_id", *[F.coalesce(F.col(c), F.col(f"_old_{c}")).alias(c) for c in METADATA_FIELDS]
    )


def replace_files(state: DataFrame | None, files: DataFrame) -> DataFrame:
    """J15 (bundle path): theses with files in the batch are wholly replaced;
    theses with none keep their rows. ``access`` is carried over by filename
    from the previous non-NULL value (several: the greatest)."""
    cols = ["thesis_id", "filename", "size_label", "size_bytes", "access", "description",
            "filetype", "url", "role"]
    new = files.select(
        "thesis_id", "filename", F.lit(None).cast("string").alias("size_label"),
        "size_bytes", "description", "filetype", "url", "role",
    )
    if state is None:
        return new.withColumn("access", F.lit(None).cast("string")).select(*cols)
    known = (
        state.where(F.col("access").isNotNull())
        .groupBy("thesis_id", "filename").agg(F.max("access").alias("access"))
    )
    touched = new.select("thesis_id").distinct()
    kept = state.select(*cols).join(touched, "thesis_id", "left_anti")
    carried = new.join(known, ["thesis_id", "filename"], "left").select(*cols)
    return kept.unionByName(carried)


def replace_file_index(state: DataFrame | None, status: DataFrame | None,
                       indexed_ids: DataFrame, files: DataFrame, indexed_at,
                       base: str | None = None) -> tuple[DataFrame, DataFrame]:
    """J16 (item-page path): every indexed thesis is replaced, even with zero
    files; its status row becomes (thesis_id, indexed_at, file_count).
    Relative links are made absolute."""
    ids = indexed_ids.select("thesis_id").distinct()
    href = abs_url("href", base) if base else abs_url("href")
    new = files.select(
        "thesis_id", "filename", "size_label", "size_bytes", "access", "description",
        "filetype", href.alias("url"), "role",
    )
    counts = files.groupBy("thesis_id").agg(F.count(F.lit(1)).alias("file_count"))
    new_status = ids.join(counts, "thesis_id", "left").select(
        "thesis_id",
        F.lit(indexed_at).cast("timestamp").alias("indexed_at"),
        F.coalesce("file_count", F.lit(0)).cast("int").alias("file_count"),
    )
    out_files = new if state is None else (
        state.join(ids, "thesis_id", "left_anti").select(*new.columns).unionByName(new)
    )
    out_status = new_status if status is None else (
        status.join(ids, "thesis_id", "left_anti").select(*new_status.columns)
        .unionByName(new_status)
    )
    return out_files, out_status


def degree_registers(rich: DataFrame) -> DataFrame:
    """J17 as state: per thesis the last stated degree and its record order."""
    return rich.where(F.col("degree").isNotNull()).groupBy(F.col("id").alias("thesis_id")).agg(
        F.max(reg.register(F.col("degree"))).alias("degree"))


def fill_degree(metadata: DataFrame, rich: DataFrame) -> DataFrame:
    """From the rich records, degree_raw is overwritten where a degree is
    stated (last by record order) and degree_level filled only where NULL."""
    return fill_degree_from(metadata, degree_registers(rich))


def fill_degree_from(metadata: DataFrame, degrees: DataFrame) -> DataFrame:
    """J17 over the registers of all rich records so far."""
    stated = degrees.select("thesis_id", F.col("degree.v").alias("_degree"))
    base = metadata if "degree_raw" in metadata.columns else metadata.withColumn(
        "degree_raw", F.lit(None).cast("string"))
    j = base.join(stated, "thesis_id", "left")
    return j.select(
        *[c for c in base.columns if c not in ("degree_level", "degree_raw")],
        F.coalesce(F.col("degree_level"), md.degree_level(F.col("_degree"))).alias("degree_level"),
        F.coalesce(F.col("_degree"), F.col("degree_raw")).alias("degree_raw"),
    )


def evolve_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append across schema versions; columns added later (role,
    degree_raw) read as NULL on older rows."""
    return old.unionByName(new, allowMissingColumns=True)
