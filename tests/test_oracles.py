"""Catalog queries vs their DuckDB oracle SQL on the smallest driver tables.

Slow file/stream queries are covered by dedicated tests; here every query with an oracle
that runs in a few seconds is compared (row count, column names, values)."""

import os

import pytest

from tests.conftest import SF_SMALL

SLOW = {"compact_touched", "stream_import", "only_new_files", "replay_idempotence", "incremental_import",
        "import_ledger", "ledger_totals", "run_totals", "file_fault_isolation", "sink_month_process_csv",
        "export_ledger", "discover_files", "limit_per_file", "scan_typed_json", "resume_export"}


def _keys():
    import __spark_entry__ as se
    return sorted(k for k in se.oracle_sql() if k not in SLOW)


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver tables not present")
def test_oracle_matches(spark):
    from tools.oracle_check import check
    res = check(spark, SF_SMALL, _keys(), verbose=False)
    bad = {k: v for k, v in res.items() if v[0] != "OK"}
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as se
    df = se.entry(spark)
    assert df.columns == ["company_id", "tag_id", "value", "ts"]
    assert df.count() >= 0


def test_every_query_has_survey_ids():
    from telemetra.plans.catalog import load_all
    for k, e in load_all().items():
        assert e.ids, k
