"""Sources and sinks."""

from .csv import PANDAS_NA, normalize_na, scan_csv
from .publication import Entry, NotPublished, Snapshot, begin, publish, retire, snapshot
from .sinks import as_view, audit_counts, entry_of, materialize, new_run_id, write_table
from .spine import date_spine, date_spine_between
from .tables import TableSet, read_table

__all__ = [
    "PANDAS_NA", "normalize_na", "scan_csv", "Entry", "NotPublished", "Snapshot", "begin", "publish", "retire",
    "snapshot", "as_view", "audit_counts", "entry_of", "materialize", "new_run_id", "write_table", "date_spine", "date_spine_between", "TableSet", "read_table",
]
