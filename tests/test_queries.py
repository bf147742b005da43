"""Registered queries against their SQL on the smallest tables; METERLAKE_ALL=1 runs the slow ones too."""

from __future__ import annotations

import os
from pathlib import Path

import pytest

from meterlake.workload.registry import QUERIES
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
# Whole jobs and streams that take from ten seconds on; the tests of their parts run them on small files.
SLOW = [
    "audit_documents", "drain_files", "ingest_fallthrough", "ingest_file_run", "ingest_mixed", "lead_lines", "offcadence_purge_table", "redelivered_file",
    "site_import", "stream_archive", "stream_ingest_once", "stream_upsert",
]
NAMES = [name for name in QUERIES if os.environ.get("METERLAKE_ALL") or name not in SLOW]

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="tables not present")


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, name):
    query, sql = QUERIES[name]
    assert compare(query(spark, SF), connect(SF), sql) is None
