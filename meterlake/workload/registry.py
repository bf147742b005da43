"""All registered queries: name to (query, SQL or None)."""

from __future__ import annotations

from meterlake.workload import accounting, changes, lake_table, meter_files, reports, vendor_files

QUERIES = {
    **meter_files.QUERIES,
    **vendor_files.QUERIES,
    **accounting.QUERIES,
    **lake_table.QUERIES,
    **reports.QUERIES,
    **changes.QUERIES,
}
