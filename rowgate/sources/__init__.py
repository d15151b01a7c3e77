"""Reading and writing: delimited text, Parquet, intermediate tables and reports."""

from .buckets import largest_share, read_bucketed, write_bucketed
from .files import SplitCounts, read_csv, read_parquet, read_quarantine, write_parquet, write_split
from .ledger import read_ledger, record_run
from .reports import read_report, read_verdict, write_report, write_verdict
from .runs import aside
from .staging import StagingArea
from .versions import expire, manifests, read_clean, read_manifest, read_rejected, read_unbucketed, read_version

__all__ = [
    "SplitCounts",
    "StagingArea",
    "aside",
    "expire",
    "largest_share",
    "manifests",
    "read_bucketed",
    "read_clean",
    "read_csv",
    "read_ledger",
    "read_manifest",
    "read_parquet",
    "read_quarantine",
    "read_rejected",
    "read_report",
    "read_verdict",
    "read_unbucketed",
    "read_version",
    "write_bucketed",
    "record_run",
    "write_parquet",
    "write_report",
    "write_split",
    "write_verdict",
]
