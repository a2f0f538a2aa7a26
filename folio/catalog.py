"""Registry of runnable queries: name -> f(spark, sf_dir) -> DataFrame.

Every query reads the driver tables through a binding (``folio.bindings``)
and runs one job from SURVEY section 2 over the whole table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession

from pyspark.sql import functions as F

from folio import bindings as B
from folio.session import new_work_dir, read_table, stored
from folio.sinks.table import VersionedTable
from folio.streaming.ingest import (
    PAGE_SCHEMA, checkpoint_dir, merge_batches, raw_pages, read_bronze, run_to_bronze,
)

from folio.operators import election, keywords, ledger, people, progress, registers, upsert
from folio.functions import metadata
from folio.sources import doc_text, dump, html_grid, oai_dc, xoai
from folio.sources.pages import land_folders, land_pages, scan_doc_text, scan_page_folders
from folio.operators.titlepage import extract_titlepage, replace_titlepages
from folio.plans import queue, reports

Query = Callable[[SparkSession, str], DataFrame]


def title_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title-page texts, dealt out: a compact table has few splits, and the patterns cost far more
    than the move. AQE sets the number of tasks by size and cores."""
    return B.doc_text_from_titlepages(spark, sf_dir).repartition("thesis_id")


def q_titlepage_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    tp = extract_titlepage(B.doc_text_from_titlepages(spark, sf_dir))
    return tp.select("thesis_id", "ects", "degree", "subject", "year_on_page",
                     "n_pages", "text_chars")


def q_titlepage_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    tp = extract_titlepage(B.doc_text_from_titlepages(spark, sf_dir))
    return tp.select("thesis_id", "faculty", "school", "department", "deild", "svid")


def q_titlepage_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    tp = extract_titlepage(B.doc_text_from_titlepages(spark, sf_dir))
    return tp.select("thesis_id", "committee", "examiner", "advisors")


def q_faculty_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.faculty_summary(extract_titlepage(title_texts(spark, sf_dir)))


# The planning date is an argument, never the clock, so plans are reproducible.
AS_OF = dt.date(2000, 1, 1)


def thesis_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with their elected role, as the queue reads them."""
    return election.elect_primary_scored(B.files_from_lineitem(spark, sf_dir))


def failure_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.merge_failures(ledger.classify_fetch(B.fetch_outcomes(spark, sf_dir)))


def q_elect_primary_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return thesis_file(spark, sf_dir).select("thesis_id", "pos", "filename", "role")


def q_elect_primary_tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = election.elect_primary_tiered(B.files_from_lineitem(spark, sf_dir))
    return f.select("thesis_id", "pos", "filename", "role")


def q_queue_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return election.queue_candidates(thesis_file(spark, sf_dir), AS_OF)


def q_queue_candidate_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return election.queue_candidates_window(thesis_file(spark, sf_dir), AS_OF)


def _queue(spark: SparkSession, sf_dir: str, **opts) -> DataFrame:
    return queue.plan_queue(
        B.metadata_levels(spark, sf_dir),
        thesis_file(spark, sf_dir),
        B.parsed_ids(spark, sf_dir),
        failure_ledger(spark, sf_dir),
        as_of=AS_OF,
        **opts,
    )


def q_queue_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _queue(spark, sf_dir)


def q_queue_plan_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explicit ids: the theses that have a fetch outcome on record."""
    ids = B.fetch_outcomes(spark, sf_dir).select("thesis_id")
    return _queue(spark, sf_dir, ids=ids)


def q_queue_plan_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offline: the candidate set is the theses with cached text."""
    cached = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("thesis_id"))
    return _queue(spark, sf_dir, cached_ids=cached)


def q_queue_plan_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next 100 fetches, files over 5 MB skipped, closed files included."""
    return _queue(spark, sf_dir, max_bytes=5_000_000, include_closed=True, limit=100)


def q_fetch_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = ledger.classify_fetch(B.fetch_outcomes(spark, sf_dir))
    return c.select("event_id", "thesis_id", "ok", "reason", "permanent")


def q_failure_ledger_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failure_ledger(spark, sf_dir)


def q_failure_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.failure_report(failure_ledger(spark, sf_dir))


def q_election_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.election_audit(thesis_file(spark, sf_dir))


def _records(pages: DataFrame) -> DataFrame:
    """The good pages' records; the bad pages are the result of ``rejected_pages``."""
    return oai_dc.parse_oai_dc(pages, fail_on_error=False)


def _dealt_records(pages: DataFrame) -> DataFrame:
    """The same of a batch of few files, dealt out before the parse: a file is one split, and its
    one task would parse all its pages. AQE sets the number of tasks by size and cores."""
    return _records(pages.repartition("file_name"))


def q_rejected_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages whose records a harvest lacks, with the reason."""
    return oai_dc.rejected_pages(B.oai_pages(spark, sf_dir))


def oai_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oai_dc.parse_oai_dc(B.oai_pages(spark, sf_dir), fail_on_error=False)


def replay_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three replays of the harvest (B11), parsed."""
    return _records(B.oai_pages(spark, sf_dir, B.B11_RECORDS))


def _flat(df: DataFrame) -> DataFrame:
    lists = ["subjects", "descriptions", "contributors", "types", "relations"]
    return df.select("id", "date_accepted", "title", "authors",
                     *[F.array_join(c, "|").alias(c) for c in lists])


def q_oai_dc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(oai_records(spark, sf_dir))


def q_page_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oai_dc.page_lineage(B.oai_pages(spark, sf_dir))


def q_page_error_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = oai_dc.route_page_errors(oai_dc.parse_pages(B.oai_pages(spark, sf_dir)))
    return routed.select(
        "file_name", "page_status", "page_error",
        F.when(F.col("p.ListRecords.record").isNull(), 0)
        .otherwise(F.size("p.ListRecords.record")).cast("int").alias("n_records"),
    )


def q_year_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oai_dc.year_filter(oai_records(spark, sf_dir), 1996, 1998).select("id", "date_accepted")


def q_id_semi_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """records of theses already in the thesis table (metadata replay)."""
    ids = B.thesis_state(spark, sf_dir).select("id")
    return oai_records(spark, sf_dir).join(ids, "id", "left_semi").select("id", "title")


def q_limit_per_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = oai_dc.limit_per_set(oai_records(spark, sf_dir), 50)
    return first.select("set_spec", "id")


def q_thesis_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.upsert_thesis(B.thesis_state(spark, sf_dir), oai_records(spark, sf_dir))


def q_metadata_last_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.merge_metadata(None, replay_records(spark, sf_dir))


def replay_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that the keyword tables need of the replays' records."""
    return upsert.metadata_fields(replay_records(spark, sf_dir)).select(
        "thesis_id", "file_name", "pos", "keywords")


def _keywords(spark: SparkSession, sf_dir: str):
    return keywords.build_keywords(replay_keywords(spark, sf_dir))


def q_keyword_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keywords(spark, sf_dir)[0]


def q_thesis_keyword_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keywords(spark, sf_dir)[1]


def cached_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_text.split_marker(B.raw_text(spark, sf_dir))


def q_doc_text_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cached_text(spark, sf_dir).select(
        "thesis_id", "n_pages", "kept",
        F.length("text").cast("int").alias("text_chars"), F.md5("text").alias("text_md5"))


def q_text_cache_staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted: every thesis with an event or a label."""
    wanted = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("thesis_id")).union(
        read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("thesis_id")))
    return ledger.text_cache_state(cached_text(spark, sf_dir), wanted, pages=20)


def q_assemble_first_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = doc_text.assemble_text(B.page_rows(spark, sf_dir), n=3)
    return d.select("thesis_id", "n_pages", "kept", F.md5("text").alias("text_md5"), "failed")


def _clean_people(spark: SparkSession, sf_dir: str):
    return people.clean_people(B.people_table(spark, sf_dir), B.people_links(spark, sf_dir))


def q_clean_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean_people(spark, sf_dir)[0]


def q_clean_people_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean_people(spark, sf_dir)[1]


def q_clean_people_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean_people(spark, sf_dir)[2]


def titlepages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_titlepage(title_texts(spark, sf_dir))


def q_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.run_summary(titlepages(spark, sf_dir), failure_ledger(spark, sf_dir))


def q_reconcile_document_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.reconcile(B.metadata_levels(spark, sf_dir), titlepages(spark, sf_dir))


def q_schema_evolution_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older file snapshot without ``role`` appended to a newer one with it."""
    files = B.files_from_lineitem(spark, sf_dir)
    old = files.select("thesis_id", "pos", "filename", F.lit("old").alias("snapshot"))
    new = election.elect_primary_tiered(files).select(
        "thesis_id", "pos", "filename", "role", F.lit("new").alias("snapshot"))
    return upsert.evolve_union(old, new).select("thesis_id", "pos", "snapshot", "role")


def q_harvest_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mid-harvest snapshot: sets 2 and 4 have not stored their final page yet."""
    pages = B.oai_pages(spark, sf_dir)
    lin = pages.select("file_name", *oai_dc.lineage_columns(F.col("file_name")))
    last = lin.where(F.col("page_offset") < 999997).groupBy("set_spec").agg(
        F.max("page_offset").alias("_last"))
    stored = lin.join(last, "set_spec").where(
        ~(F.col("set_spec").isin("col_1946_2", "col_1946_4") & (F.col("page_offset") == F.col("_last")))
    ).select("file_name")
    return progress.harvest_progress(pages.join(stored, "file_name", "left_semi"))


def q_pending_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Theses whose file table is not indexed yet: orders with no file rows."""
    thesis = B.metadata_levels(spark, sf_dir).select(F.col("thesis_id").alias("id"))
    status = B.files_from_lineitem(spark, sf_dir).select("thesis_id").distinct()
    return queue.pending_index(thesis, status)


def rich_records(spark: SparkSession, sf_dir: str, bundles: bool = True) -> DataFrame:
    return xoai.parse_xoai(B.xoai_pages(spark, sf_dir), bundles=bundles)


def q_xoai_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rich_records(spark, sf_dir, bundles=False)
    return r.select("id", F.array_join("authors", "; ").alias("authors"),
                    F.array_join("advisors", "; ").alias("advisors"), "degree")


def q_xoai_bitstreams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return xoai.explode_bitstreams(rich_records(spark, sf_dir)).drop(
        "checksum", "file_name", "record_pos")


def _degree_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.fill_degree(B.metadata_levels(spark, sf_dir),
                              rich_records(spark, sf_dir, bundles=False))


def q_degree_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _degree_fill(spark, sf_dir).select("thesis_id", "degree_level", "degree_raw")


def q_degree_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.degree_audit(B.metadata_levels(spark, sf_dir), _degree_fill(spark, sf_dir))


def bundle_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the bundles, stored: the election reads them more than once."""
    return stored(spark, xoai.last_record_files(
        xoai.explode_bitstreams(rich_records(spark, sf_dir))), "bundle-files")


def q_files_replace_carry_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bundle files replace the item-page file table; access carries over."""
    state = B.files_from_lineitem(spark, sf_dir).select(
        "thesis_id", "filename", F.lit(None).cast("string").alias("size_label"), "size_bytes",
        "access", "description", "filetype", "url", F.lit(None).cast("string").alias("role"))
    new = election.elect_primary_scored(bundle_files(spark, sf_dir))
    out = upsert.replace_files(state, new)
    return out.select("thesis_id", "filename", "size_bytes", "access", "description", "filetype",
                      "role", "url")


def _land(df: DataFrame, path: str) -> None:
    """Land rows as files, the way an upstream fetcher drops them; the number of
    files follows the data."""
    df.write.parquet(path)


def q_scan_pages_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pages scanned back from the store, with their record counts."""
    work = new_work_dir(spark, "j1")
    land_pages(B.oai_pages(spark, sf_dir), f"{work}/pages")
    routed = oai_dc.route_page_errors(oai_dc.parse_pages(
        scan_page_folders(spark, f"{work}/pages")))
    return routed.select("file_name", "page_status", F.coalesce(
        F.size(F.coalesce("p.ListRecords.record", F.array())), F.lit(0)).alias("n_records"))


def q_scan_doc_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marked texts scanned back from a folder per thesis."""
    work = new_work_dir(spark, "j8")
    raw = B.raw_text(spark, sf_dir).withColumn("raw", F.regexp_replace("raw", "\\s+$", ""))
    land_folders(raw.select("thesis_id", F.col("raw").alias("value")), f"{work}/texts", " ")
    d = doc_text.split_marker(scan_doc_text(spark, f"{work}/texts"))
    return d.select("thesis_id", "n_pages", "kept")


def q_stream_pages_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1: raw pages arrive one a file; the stream parses them into bronze."""
    work = new_work_dir(spark, "st1")
    land_pages(B.oai_pages(spark, sf_dir), f"{work}/landing")
    run_to_bronze(spark, f"{work}/landing", "value STRING",
                  lambda b: _records(raw_pages(b)), f"{work}/bronze",
                  checkpoint_dir(f"{work}/checkpoint", prefix="oai_dc"), wholetext=True)
    return _flat(read_bronze(spark, f"{work}/bronze", ["file_name", "pos"]))


def _replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions of the harvest streamed in, then all of it again from a second
    checkpoint with other batches; bronze read back."""
    work = new_work_dir(spark, "st2")
    _land(B.oai_pages(spark, sf_dir, B.B11_RECORDS), f"{work}/landing")
    for files in (4, 7):
        run_to_bronze(spark, f"{work}/landing", PAGE_SCHEMA, _records, f"{work}/bronze",
                      checkpoint_dir(f"{work}/checkpoint", files=files),
                      max_files_per_trigger=files)
    return read_bronze(spark, f"{work}/bronze", ["file_name", "pos"])


def q_stream_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2: the fold over a bronze that holds a replay equals the batch fold."""
    return upsert.merge_metadata(None, _replayed(spark, sf_dir))


def q_stream_replay_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2: a replay adds no row: records per page in bronze."""
    return _replayed(spark, sf_dir).groupBy("file_name").agg(
        F.count(F.lit(1)).alias("n_records"))


def q_stream_failure_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3: fetch outcomes stream in; the ledger is folded from bronze."""
    work = new_work_dir(spark, "st3")
    outcomes = B.fetch_outcomes(spark, sf_dir)
    _land(outcomes, f"{work}/landing")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in outcomes.schema.fields)
    run_to_bronze(spark, f"{work}/landing", schema, ledger.classify_fetch, f"{work}/bronze",
                  checkpoint_dir(f"{work}/checkpoint", table="outcomes"))
    return ledger.merge_failures(read_bronze(spark, f"{work}/bronze", ["event_id"]))


def q_html_file_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_grid.parse_file_grid(B.item_pages(spark, sf_dir))


INDEXED_AT = dt.datetime(2024, 1, 1, 12, 0, 0)


def indexed_files(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Files of the item pages with their elected role; the pages are read once, stored for the
    election and the counts. They are dealt out first: joined to a broadcast side they would come
    in the few splits of their compact table."""
    return election.elect_primary_tiered(
        stored(spark, html_grid.parse_file_grid(pages.repartition("thesis_id")), "grid"))


def q_file_index_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fetched item page replaces its files, zero files included."""
    pages = B.item_pages(spark, sf_dir)
    files = indexed_files(spark, pages)
    _, status = upsert.replace_file_index(None, None, pages, files, INDEXED_AT)
    return status


def q_file_index_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = B.item_pages(spark, sf_dir)
    files = indexed_files(spark, pages)
    out, _ = upsert.replace_file_index(None, None, pages, files, INDEXED_AT)
    return out.select("thesis_id", "filename", "size_bytes", "access", "url", "role")


def q_people_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People from the rich records' authors and advisors."""
    ppl, links = people.load_people(stored(
        spark, rich_records(spark, sf_dir, bundles=False), "rich"))
    return links.join(ppl, links["person_id"] == ppl["id"]).select(
        "thesis_id", "role", "sort_order", "person_id", "name", "year_born")


# Jobs over the state that earlier runs left.


def q_metadata_merge_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first version folded earlier, the other two merged onto it."""
    records = replay_records(spark, sf_dir)
    first = F.element_at(F.split("file_name", "_"), -1).substr(1, 7) < "1000000"
    state = upsert.merge_metadata(None, records.where(first))
    return upsert.merge_metadata(state, records.where(~first))


def _keywords_over_state(spark: SparkSession, sf_dir: str):
    fields = stored(spark, replay_keywords(spark, sf_dir), "keywords")
    first = F.element_at(F.split("file_name", "_"), -1).substr(1, 7) < "1000000"
    earlier = keywords.build_keywords(fields.where(first))
    return keywords.build_keywords(fields.where(~first), *earlier)


def q_keyword_dictionary_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keywords_over_state(spark, sf_dir)[0]


def q_keyword_links_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keywords_over_state(spark, sf_dir)[1]


HALF_MONTH = dt.datetime(2024, 1, 16)


def q_failure_ledger_merge_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of the first half of the month, then the other half on it."""
    c = ledger.classify_fetch(B.fetch_outcomes(spark, sf_dir))
    earlier = ledger.merge_failures(c.where(F.col("at_ts") < HALF_MONTH))
    return ledger.merge_failures(c.where(F.col("at_ts") >= HALF_MONTH), earlier)


def _reindexed(spark: SparkSession, sf_dir: str):
    """Even theses were indexed in 2020 under other names; every third one is
    indexed again."""
    pages = B.item_pages(spark, sf_dir)
    files = indexed_files(spark, pages)
    even = F.col("thesis_id") % 2 == 0
    third = F.col("thesis_id") % 3 == 0
    state = upsert.replace_file_index(
        None, None, pages.where(even), files.where(even).withColumn(
            "filename", F.concat(F.lit("old_"), "filename")), dt.datetime(2020, 1, 1))
    return upsert.replace_file_index(*state, pages.where(third), files.where(third), INDEXED_AT)


def q_file_index_replace_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reindexed(spark, sf_dir)[0].select(
        "thesis_id", "filename", "size_bytes", "access", "url", "role")


def q_file_index_status_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reindexed(spark, sf_dir)[1]


def q_titlepage_replace_clears_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even theses are loaded; their failures go, the others stay."""
    tp = titlepages(spark, sf_dir)
    even = F.col("thesis_id") % 2 == 0
    _, failures = replace_titlepages(tp, failure_ledger(spark, sf_dir), tp.where(even))
    return failures


def q_queue_plan_retry_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _queue(spark, sf_dir, retry_failed=True)


def q_text_cache_offline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offline over the wanted theses: what is cached is read as it is."""
    wanted = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("thesis_id")).union(
        read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("thesis_id")))
    return ledger.text_cache_state(cached_text(spark, sf_dir), wanted, offline=True)


def q_pending_index_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explicit ids: the theses with a fetch outcome, indexed or not."""
    thesis = B.metadata_levels(spark, sf_dir).select(F.col("thesis_id").alias("id"))
    status = B.files_from_lineitem(spark, sf_dir).select("thesis_id").distinct()
    return queue.pending_index(thesis, status, ids=B.fetch_outcomes(spark, sf_dir).select(
        "thesis_id"))


def q_pages_without_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_grid.pages_without_grid(B.item_pages(spark, sf_dir))


# State that carries order, versioned tables and merged micro-batches.


def q_silver_metadata_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2: the harvests streamed in 1, 4 and 7 batches; each merges the theses it touches
    into the buckets that hold them."""
    work = new_work_dir(spark, "silver")
    B.oai_pages(spark, sf_dir, B.B11_RECORDS).repartition(28).write.parquet(f"{work}/landing")
    out = None
    for n in (1, 4, 7):
        table = VersionedTable(spark, f"{work}/silver-{n}", ["thesis_id"], buckets=16)
        run_to_bronze(
            spark, f"{work}/landing", PAGE_SCHEMA, _dealt_records, f"{work}/bronze-{n}",
            checkpoint_dir(f"{work}/checkpoint", batches=n), max_files_per_trigger=28 // n,
            then=merge_batches(table, upsert.metadata_registers,
                               lambda r: r.select(F.col("id").alias("thesis_id"))))
        rows = registers.values(table.read(), "thesis_id").withColumn("n_batches", F.lit(n))
        out = rows if out is None else out.unionByName(rows)
    return out


def _versions_reversed(records: DataFrame) -> list[DataFrame]:
    """The records of the three replays, the last one first."""
    version = F.length(F.element_at(F.split("file_name", "_"), -1)) > F.length(F.lit("000000.xml"))
    offset = F.regexp_extract("file_name", r"_(\d+)\.xml$", 1).cast("long")
    ver = F.when(version, F.floor(offset / 1000000)).otherwise(0)
    return [records.where(ver == v) for v in (2, 1, 0)]


def q_metadata_reversed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replays merged in reverse order of their records."""
    state = None
    for records in _versions_reversed(replay_records(spark, sf_dir)):
        state = registers.merge(state, upsert.metadata_registers(records), "thesis_id")
    return registers.values(state, "thesis_id")


def _keywords_reversed(spark: SparkSession, sf_dir: str):
    state = None
    for fields in _versions_reversed(stored(spark, replay_keywords(spark, sf_dir), "keywords")):
        state = keywords.merge_keywords(state, keywords.keyword_registers(fields))
    return keywords.keyword_tables(*state)


def q_keyword_dictionary_reversed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keywords_reversed(spark, sf_dir)[0]


def q_keyword_links_reversed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keywords_reversed(spark, sf_dir)[1]


def q_degree_fill_reversed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Theses of a later half of the ids first, and stale degrees of an earlier page last."""
    rich = stored(spark, rich_records(spark, sf_dir, bundles=False).select(
        "id", "file_name", "pos", "degree"), "rich")
    stale = rich.withColumn("file_name", F.lit("")).withColumn(
        "degree", F.concat(F.lit("stale "), "degree"))
    state = None
    for records in (rich.where(F.col("id") % 2 == 1), rich.where(F.col("id") % 2 == 0), stale):
        state = registers.merge(state, upsert.degree_registers(records), "thesis_id")
    return upsert.fill_degree_from(B.metadata_levels(spark, sf_dir), state).select(
        "thesis_id", "degree_level", "degree_raw")


def q_stream_ledger_crash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3: outcomes stream in batches into the ledger's state. The second batch is lost after
    its rows are written, before the manifest; the stream is started again, and then all
    of it is replayed from another checkpoint."""
    work = new_work_dir(spark, "st3-table")
    outcomes = B.fetch_outcomes(spark, sf_dir)
    outcomes.repartition(6).write.parquet(f"{work}/landing")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in outcomes.schema.fields)
    table = VersionedTable(spark, f"{work}/ledger", ["thesis_id"], buckets=16)
    merge = merge_batches(table, ledger.outcome_registers, lambda r: r.select("thesis_id"))

    def lost(rows: DataFrame, run: str, batch: int) -> None:
        if batch == 1:
            table.write_buckets(table.manifest(), ledger.outcome_registers(rows))
            raise RuntimeError("the batch is lost")
        merge(rows, run, batch)

    def run(then, **params) -> None:
        run_to_bronze(spark, f"{work}/landing", schema, ledger.classify_fetch, f"{work}/bronze",
                      checkpoint_dir(f"{work}/checkpoint", **params), max_files_per_trigger=2,
                      then=then)

    try:
        run(lost, table="outcomes")
    except StreamingQueryException:
        pass
    run(merge, table="outcomes")
    run(merge, table="outcomes", replay=1)
    return ledger.ledger_of(table.read())


def q_files_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item-page files were stored by an earlier run; the bundles' files replace those of
    their theses, and access carries over from the version read."""
    root = f"{new_work_dir(spark, 'files')}/thesis_file"
    earlier = B.files_from_lineitem(spark, sf_dir).select(
        "thesis_id", "filename", F.lit(None).cast("string").alias("size_label"), "size_bytes",
        "access", "description", "filetype", "url", F.lit(None).cast("string").alias("role"))
    VersionedTable(spark, root, ["thesis_id"], 16).merge(earlier, lambda _, rows: rows)
    new = stored(spark, election.elect_primary_scored(bundle_files(spark, sf_dir)), "elected")
    table = VersionedTable(spark, root, ["thesis_id"])
    table.merge(new, upsert.replace_files)
    return table.read().select("thesis_id", "filename", "size_bytes", "access", "description",
                               "filetype", "role", "url")


def _reindexed_versions(spark: SparkSession, sf_dir: str):
    """J16 as ``_reindexed``, over tables that the run of 2020 stored."""
    root = new_work_dir(spark, "file-index")
    pages = B.item_pages(spark, sf_dir).select("thesis_id", "html")
    files = stored(spark, indexed_files(spark, pages), "elected")

    def load(which: Column, files: DataFrame, at: dt.datetime) -> list[VersionedTable]:
        ids = pages.where(which).select("thesis_id")
        rows = upsert.replace_file_index(None, None, ids, files.where(which), at)
        tables = [VersionedTable(spark, f"{root}/{name}", ["thesis_id"], 16)
                  for name in ("thesis_file", "thesis_file_status")]
        for table, new in zip(tables, rows):
            table.replace(ids, new)
        return tables

    load(F.col("thesis_id") % 2 == 0, files.withColumn(
        "filename", F.concat(F.lit("old_"), "filename")), dt.datetime(2020, 1, 1))
    return load(F.col("thesis_id") % 3 == 0, files, INDEXED_AT)


def q_file_index_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reindexed_versions(spark, sf_dir)[0].read().select(
        "thesis_id", "filename", "size_bytes", "access", "url", "role")


def q_file_index_status_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reindexed_versions(spark, sf_dir)[1].read()


def q_titlepage_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows were stored by an earlier extraction with other values; the new rows of
    even theses replace theirs."""
    root = f"{new_work_dir(spark, 'titlepage')}/thesis_titlepage"
    tp = stored(spark, titlepages(spark, sf_dir), "titlepage")
    earlier = tp.withColumn("faculty", F.concat(F.lit("old "), "faculty")).withColumn(
        "n_pages", F.lit(-1))
    VersionedTable(spark, root, ["thesis_id"], 16).merge(earlier, lambda _, rows: rows)
    new = tp.where(F.col("thesis_id") % 2 == 0)
    table = VersionedTable(spark, root, ["thesis_id"])
    table.replace(new.select("thesis_id"), new)
    return table.read().select("thesis_id", "faculty", "n_pages")


def _dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages of the harvest in files of many pages, scanned by records; the number of files
    follows the data."""
    work = new_work_dir(spark, "dump")
    B.oai_pages(spark, sf_dir).select("xml").hint("rebalance").write.text(f"{work}/dump")
    return dump.scan_dump(spark, f"{work}/dump")


def q_dump_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 from a dump: splits of one file are parsed by many tasks."""
    return _flat(dump.parse_dump(_dump(spark, sf_dir)))


def q_dump_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dump.dump_problems(_dump(spark, sf_dir)).groupBy("status", "problem").agg(
        F.count(F.lit(1)).alias("n"))


def q_dump_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dump.dump_tokens(_dump(spark, sf_dir)).select("token")


#: Two harvests with other parameters, stored together, and one that has stored nothing.
EARLY, LATE, NEVER = (progress.context_digest(years=y, output="catalog") for y in (
    "1990-1995", "1996-2000", "2001-2005"))


def _two_harvests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The early harvest lost some pages in its middle, the late one has not come to the end."""
    pages = B.oai_pages(spark, sf_dir)
    offset = F.regexp_extract("file_name", r"_(\d+)\.xml$", 1).cast("long")
    stored_pages = pages.withColumn("offset", offset)
    return stored_pages.where(F.col("offset") % 700 != 300).withColumn(
        "context", F.lit(EARLY)).unionByName(stored_pages.where(F.col("offset") < 5000).withColumn(
            "context", F.lit(LATE))).drop("offset")


def q_harvest_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that are named by a stored page and not there, for each run."""
    return progress.missing_pages(_two_harvests(spark, sf_dir))


def q_harvest_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each run goes on; a run with other parameters has no resume point."""
    pages = stored(spark, _two_harvests(spark, sf_dir), "harvests")
    points = [progress.resume_points(pages, c).withColumn("context", F.lit(c))
              for c in (EARLY, LATE, NEVER)]
    return points[0].unionByName(points[1]).unionByName(points[2])


def _people_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Odd people are loaded and cleaned, then all are loaded and cleaned again."""
    loaded = B.people_table(spark, sf_dir)
    odd = F.col("id") % 2 == 1
    first = people.clean_more(None, None, loaded.where(odd))
    return people.clean_more(*first, loaded)


def q_people_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people_runs(spark, sf_dir)[0].drop("dirty", "absorbed")


def q_people_links_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links under the ids of their load, resolved through the forwarding table."""
    return people.resolve_links(B.people_links(spark, sf_dir), _people_runs(spark, sf_dir)[1])


def q_keyword_folding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings that differ in case only are one keyword."""
    fields = B.folding_keywords(spark, sf_dir).withColumn(
        "keywords", metadata.split_keywords(F.col("subjects")))
    words, links = keywords.build_keywords(fields)
    return links.join(words, "keyword_norm")


def q_harvest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = B.oai_pages(spark, sf_dir)
    return reports.harvest_counts(pages, _records(pages))


def q_file_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item-page load and the bundle load of a run."""
    pages = B.item_pages(spark, sf_dir)
    rich = stored(spark, rich_records(spark, sf_dir), "rich")
    bundles = xoai.last_record_files(xoai.explode_bitstreams(rich))
    degrees = upsert.fill_degree(B.metadata_levels(spark, sf_dir), rich)
    return reports.file_load_counts(
        "item pages", html_grid.parse_file_grid(pages), pages.select("thesis_id")).unionByName(
        reports.file_load_counts("bundles", bundles, degrees=degrees))


def q_scan_doc_text_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marked texts scanned back whole; the writer ends each file with one line feed."""
    work = new_work_dir(spark, "j8")
    land_folders(B.raw_text(spark, sf_dir).select("thesis_id", F.col("raw").alias("value")),
                 f"{work}/texts")
    scanned = scan_doc_text(spark, f"{work}/texts").withColumn(
        "raw", F.expr("left(raw, length(raw) - 1)"))
    return doc_text.split_marker(scanned).select(
        "thesis_id", "n_pages", "kept", F.length("text").cast("int").alias("text_chars"),
        F.md5("text").alias("text_md5"))


QUERIES: dict[str, Query] = {
    "harvest_counts": q_harvest_counts,
    "file_load_counts": q_file_load_counts,
    "scan_doc_text_whole": q_scan_doc_text_whole,
    "dump_records": q_dump_records,
    "dump_problems": q_dump_problems,
    "dump_tokens": q_dump_tokens,
    "harvest_missing": q_harvest_missing,
    "harvest_resume": q_harvest_resume,
    "people_runs": q_people_runs,
    "people_links_runs": q_people_links_runs,
    "keyword_folding": q_keyword_folding,
    "silver_metadata_batches": q_silver_metadata_batches,
    "metadata_reversed": q_metadata_reversed,
    "keyword_dictionary_reversed": q_keyword_dictionary_reversed,
    "keyword_links_reversed": q_keyword_links_reversed,
    "degree_fill_reversed": q_degree_fill_reversed,
    "stream_ledger_crash": q_stream_ledger_crash,
    "files_versions": q_files_versions,
    "file_index_versions": q_file_index_versions,
    "file_index_status_versions": q_file_index_status_versions,
    "titlepage_versions": q_titlepage_versions,
    "rejected_pages": q_rejected_pages,
    "scan_pages_inventory": q_scan_pages_inventory,
    "scan_doc_text": q_scan_doc_text,
    "stream_replay_bronze": q_stream_replay_bronze,
    "metadata_merge_state": q_metadata_merge_state,
    "keyword_dictionary_state": q_keyword_dictionary_state,
    "keyword_links_state": q_keyword_links_state,
    "failure_ledger_merge_state": q_failure_ledger_merge_state,
    "file_index_replace_state": q_file_index_replace_state,
    "file_index_status_state": q_file_index_status_state,
    "titlepage_replace_clears_failure": q_titlepage_replace_clears_failure,
    "queue_plan_retry_failed": q_queue_plan_retry_failed,
    "text_cache_offline": q_text_cache_offline,
    "pending_index_ids": q_pending_index_ids,
    "pages_without_grid": q_pages_without_grid,
    "people_load": q_people_load,
    "html_file_grid": q_html_file_grid,
    "file_index_status": q_file_index_status,
    "file_index_files": q_file_index_files,
    "stream_pages_ingest": q_stream_pages_ingest,
    "stream_replay_idempotent": q_stream_replay_idempotent,
    "stream_failure_ledger": q_stream_failure_ledger,
    "xoai_records": q_xoai_records,
    "xoai_bitstreams": q_xoai_bitstreams,
    "degree_fill": q_degree_fill,
    "degree_audit": q_degree_audit,
    "files_replace_carry_access": q_files_replace_carry_access,
    "run_summary": q_run_summary,
    "reconcile_document_wins": q_reconcile_document_wins,
    "schema_evolution_union": q_schema_evolution_union,
    "harvest_progress": q_harvest_progress,
    "pending_index": q_pending_index,
    "doc_text_marker": q_doc_text_marker,
    "text_cache_staleness": q_text_cache_staleness,
    "assemble_first_pages": q_assemble_first_pages,
    "clean_people": q_clean_people,
    "clean_people_links": q_clean_people_links,
    "clean_people_changed": q_clean_people_changed,
    "oai_dc_records": q_oai_dc_records,
    "page_lineage": q_page_lineage,
    "page_error_routing": q_page_error_routing,
    "year_filter": q_year_filter,
    "id_semi_filter": q_id_semi_filter,
    "limit_per_set": q_limit_per_set,
    "thesis_insert_only": q_thesis_insert_only,
    "metadata_last_non_null": q_metadata_last_non_null,
    "keyword_dictionary": q_keyword_dictionary,
    "thesis_keyword_links": q_thesis_keyword_links,
    "elect_primary_scored": q_elect_primary_scored,
    "elect_primary_tiered": q_elect_primary_tiered,
    "queue_candidates": q_queue_candidates,
    "queue_candidate_window": q_queue_candidate_window,
    "queue_plan": q_queue_plan,
    "queue_plan_ids": q_queue_plan_ids,
    "queue_plan_cached": q_queue_plan_cached,
    "queue_plan_topk": q_queue_plan_topk,
    "fetch_outcome": q_fetch_outcome,
    "failure_ledger_latest": q_failure_ledger_latest,
    "failure_report": q_failure_report,
    "election_audit": q_election_audit,
    "faculty_summary": q_faculty_summary,
    "titlepage_fields": q_titlepage_fields,
    "titlepage_units": q_titlepage_units,
    "titlepage_people": q_titlepage_people,
}
