"""Plan assertions: core queries stay JVM-side (no Python evaluation nodes)."""

import pytest

from folio.catalog import QUERIES

SF = "/root/testdata/sf0.001"
CORE = ["faculty_summary", "elect_primary_scored", "queue_plan", "oai_dc_records",
        "metadata_last_non_null", "clean_people"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CORE)
def test_no_python_udf(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan, f"{name} runs Python: {node}"


@pytest.mark.parametrize("name", ["oai_dc_records", "rejected_pages", "xoai_records"])
def test_pages_are_parsed_once(spark, name):
    assert _plan(QUERIES[name](spark, SF)).count("from_xml(") == 1


@pytest.mark.parametrize("name", ["titlepage_fields", "titlepage_units", "titlepage_people"])
def test_titlepage_text_is_not_repartitioned(spark, name):
    assert "REPARTITION" not in _plan(QUERIES[name](spark, SF))


def test_no_task_takes_all_rows(spark):
    """Single-partition exchanges only where the result is one row or a limited list."""
    one_row = {"clean_people_changed", "run_summary", "election_audit", "queue_plan_topk"}
    streams = {n for n in QUERIES if n.startswith("stream_") or n.startswith("scan_")}
    # The plans of these are plain reads of the tables that they have just stored.
    read_back = {n for n in QUERIES if n.startswith("silver_") or n.endswith("_versions")}
    for name in sorted(set(QUERIES) - one_row - streams - read_back):
        assert "Exchange SinglePartition" not in _plan(QUERIES[name](spark, SF)), name
