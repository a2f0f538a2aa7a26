import random

import pytest
from pyspark.sql import functions as F

from folio.operators import keywords, ledger, registers, upsert
from folio.session import new_work_dir
from folio.sinks.table import VersionedTable
from folio.streaming.ingest import merge_batches, read_bronze, run_to_bronze


def table(spark, root=None, buckets=8):
    return VersionedTable(spark, root or f"{new_work_dir(spark, 'table')}/t", ["id"], buckets)


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "id long, v string")


def held(df):
    return sorted(map(tuple, df.collect()))


def test_replace_by_key_as_one_version(spark):
    t = table(spark)
    assert t.read() is None and t.versions() == []
    t.replace(rows(spark, [(i, "a") for i in range(20)]), rows(spark, [(i, "a") for i in range(20)]))
    first = t.read()
    # 3 gets two rows, 4 loses its row, 30 is new, 99 was never there.
    t.replace(rows(spark, [(3, ""), (4, ""), (99, "")]), rows(spark, [(3, "b"), (3, "c"), (30, "d")]))
    assert held(t.read()) == sorted([(i, "a") for i in range(20) if i not in (3, 4)]
                                    + [(3, "b"), (3, "c"), (30, "d")])
    # A reader keeps the version it opened; another object reads what this one stored.
    assert held(first) == held(t.read(1)) == [(i, "a") for i in range(20)]
    assert held(table(spark, t.root, buckets=3).read()) == held(t.read())
    assert t.manifest().buckets == 8


def test_buckets_that_a_batch_does_not_touch_keep_their_files(spark):
    t = table(spark, buckets=32)
    t.merge(rows(spark, [(i, "a") for i in range(200)]), lambda _, new: new)
    before = t.manifest().folders
    t.merge(rows(spark, [(7, "b")]), lambda old, new: old.where("id <> 7").unionByName(new))
    after = t.manifest().folders
    changed = [b for b in before if before[b] != after[b]]
    assert len(before) == len(after) == 32 and len(changed) == 1
    assert dict(held(t.read()))[7] == "b" and t.read().count() == 200


def test_rows_outside_the_touched_buckets_are_refused(spark):
    t = table(spark)
    t.merge(rows(spark, [(1, "a")]), lambda _, new: new)
    with pytest.raises(ValueError, match="touch"):
        t.merge(rows(spark, [(1, "a")]), lambda old, _: rows(spark, [(i, "x") for i in range(50)]))
    assert held(t.read()) == [(1, "a")]


def test_failed_write_leaves_the_version_before(spark):
    t = table(spark)
    t.merge(rows(spark, [(i, "a") for i in range(9)]), lambda _, new: new)

    def breaks(old, new):
        return new.withColumn("v", F.when(F.col("id") == 5, F.raise_error(F.lit("lost"))).otherwise(
            F.col("v")).cast("string"))

    with pytest.raises(Exception, match="lost"):
        t.merge(rows(spark, [(i, "b") for i in range(9)]), breaks)
    assert t.versions() == [1] and held(t.read()) == [(i, "a") for i in range(9)]
    # What the failed write left is never read, and goes with the old versions.
    t.replace(rows(spark, [(1, "")]), rows(spark, [(1, "c")]))
    t.vacuum(keep=1)
    assert t.versions() == [2] and dict(held(t.read()))[1] == "c" and t.read().count() == 9
    assert {f"data/{n}" for n in t.files.names(f"{t.root}/data")} == {
        f.rsplit("/", 1)[0] for f in t.manifest().folders.values()}


def test_two_writers_cannot_publish_one_version(spark):
    t = table(spark)
    t.files.publish(f"{t.root}/manifest/x.json", "one")
    with pytest.raises(Exception, match="exists|Exists"):
        t.files.publish(f"{t.root}/manifest/x.json", "two")
    assert t.files.read(f"{t.root}/manifest/x.json") == "one"


def test_retried_batch_changes_nothing_and_later_columns_read_null(spark):
    t = table(spark)
    fold = lambda old, new: new if old is None else old.unionByName(new, True)
    assert t.merge(rows(spark, [(1, "a")]), fold, "run", 0) == 1
    assert t.merge(rows(spark, [(1, "a")]), fold, "run", 0) == 1
    assert t.merge(rows(spark, [(2, "b")]).withColumn("w", F.lit(1)), fold, "run", 1) == 2
    assert t.merge(rows(spark, [(1, "a")]), fold, "run", 0) == 2
    assert t.merge(rows(spark, [(1, "z")]), fold, "other", 0) == 3
    assert sorted(map(str, t.read().collect())) == sorted(map(str, [
        *rows(spark, [(1, "a"), (1, "z")]).withColumn("w", F.lit(None).cast("int")).collect(),
        *rows(spark, [(2, "b")]).withColumn("w", F.lit(1)).collect()]))


def test_all_rows_of_a_bucket_can_go(spark):
    t = table(spark)
    t.merge(rows(spark, [(1, "a")]), lambda _, new: new)
    t.replace(rows(spark, [(1, "")]), rows(spark, []))
    assert held(t.read()) == [] and t.manifest().folders == {}


RECORD = ("id long, file_name string, pos int, title string, descriptions array<string>, "
          "subjects array<string>, types array<string>, contributors array<string>, "
          "relations array<string>")


def record(i, page, pos, title=None, subjects=(), relation=None):
    return (i, page, pos, title, [], list(subjects), [], [], [relation] if relation else [])


RECORDS = [
    record(1, "p1", 0, "The first title", ["Fish", "Sea"], "http://a"),
    record(1, "p2", 0, None, ["sea"], None),
    record(1, "p3", 4, "The last title", [], None),
    record(2, "p1", 1, None, ["FISH"], "http://b"),
    record(2, "p2", 7, None, ["fish", "Ice"], "http://c"),
]


@pytest.mark.parametrize("seed", range(3))
def test_registers_do_not_depend_on_order_or_batches(spark, seed):
    want = held(upsert.merge_metadata(None, spark.createDataFrame(RECORDS, RECORD)))
    fields = upsert.metadata_fields(spark.createDataFrame(RECORDS, RECORD))
    tables = [held(t) for t in keywords.build_keywords(fields)]
    shuffled = RECORDS + RECORDS[:2]
    random.Random(seed).shuffle(shuffled)
    state = words = None
    for at in range(0, len(shuffled), 3):
        batch = spark.createDataFrame(shuffled[at:at + 3], RECORD)
        state = registers.merge(state, upsert.metadata_registers(batch), "thesis_id")
        words = keywords.merge_keywords(words, keywords.keyword_registers(
            upsert.metadata_fields(batch)))
    assert held(registers.values(state, "thesis_id")) == want
    assert [held(t) for t in keywords.keyword_tables(*words)] == tables
    # The last record of thesis 1 has no subjects: its links are gone.
    assert not any(r[0] == 1 for r in tables[1])


def test_a_late_failure_does_not_undo_a_success(spark):
    schema = ("thesis_id long, event_id long, at_ts timestamp, ok boolean, pdf_url string, "
              "reason string, permanent boolean")
    early, late = (spark.sql(f"select 1L, {e}L, timestamp'2024-01-0{e} 00:00:00', {ok}, 'u', "
                             f"{why}, false").toDF(*[c.split()[0] for c in schema.split(", ")])
                   for e, ok, why in ((1, "false", "'r'"), (2, "true", "cast(null as string)")))
    state = registers.merge(ledger.outcome_registers(late), ledger.outcome_registers(early),
                            "thesis_id")
    assert ledger.ledger_of(state).count() == 0
    assert ledger.ledger_of(ledger.outcome_registers(early)).count() == 1


def test_stream_merges_touched_buckets_and_survives_a_lost_batch(spark):
    work = new_work_dir(spark, "stream")
    for part in range(3):
        spark.createDataFrame([(i, f"{part}", i) for i in range(part, 12, 3)],
                              "id long, v string, at long").coalesce(1).write.mode(
            "append").parquet(f"{work}/in")
    t = table(spark)

    def regs(r):
        return r.groupBy("id").agg(F.max(registers.register(F.col("v"), F.col("at"))).alias("v"))

    merge = merge_batches(t, regs, lambda r: r.select("id"))

    def run(then, name="one"):
        run_to_bronze(spark, f"{work}/in", "id long, v string, at long", lambda b: b,
                      f"{work}/bronze", f"{work}/ckpt/{name}", max_files_per_trigger=1, then=then)

    def lost_after(r, run_name, batch):
        merge(r, run_name, batch)
        if batch == 1:
            raise RuntimeError("lost after the commit")

    with pytest.raises(Exception):
        run(lost_after)
    assert t.versions() == [1, 2]
    run(merge)
    assert t.versions() == [1, 2, 3]  # batch 1 came again and was known
    want = [(i, str(i % 3)) for i in range(12)]
    assert held(registers.values(t.read(), "id")) == want
    run(merge, "replay")
    assert held(registers.values(t.read(), "id")) == want
    assert read_bronze(spark, f"{work}/bronze", ["id"]).count() == 12


def test_a_page_stored_again_counts_as_stored_last(spark):
    work = new_work_dir(spark, "again")
    for name, rows_ in (("a", [("p", 0, "old"), ("p", 1, "old")]), ("b", [("p", 0, "new")])):
        spark.createDataFrame(rows_, "file_name string, pos int, v string").write.parquet(
            f"{work}/{name}")
        run_to_bronze(spark, f"{work}/{name}", "file_name string, pos int, v string", lambda b: b,
                      f"{work}/bronze", f"{work}/ckpt-{name}")
    assert held(read_bronze(spark, f"{work}/bronze", ["file_name", "pos"])) == [("p", 0, "new")]
