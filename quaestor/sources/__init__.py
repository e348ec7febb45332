"""Scans, writers and run logs (A-ops)."""

from quaestor.sources.scan import (  # noqa: F401
    read_source, read_jdbc, table, scan_table, scan_incremental, high_watermark, row_count,
    profile_table, TEST_TABLES)
from quaestor.sources.sinks import (  # noqa: F401
    write_staging, append_staging, full_refresh, partition_by_month, write_partitioned_fact,
    seed_allowed_values, run_record, purge_staging)
