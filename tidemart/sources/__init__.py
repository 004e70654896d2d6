from tidemart.sources.appendlog import append_delta, read_delta
from tidemart.sources.extract import FileSource, JdbcSource, read_snapshot, read_window
from tidemart.sources.landing import read_landing, write_landing
from tidemart.sources.partitions import overwrite_partitions, read_partitions
from tidemart.sources.snapshots import expire_snapshots, merge_into_table, read_current, write_snapshot

__all__ = [
    "FileSource",
    "JdbcSource",
    "append_delta",
    "expire_snapshots",
    "merge_into_table",
    "overwrite_partitions",
    "read_current",
    "read_delta",
    "read_landing",
    "read_partitions",
    "read_snapshot",
    "read_window",
    "write_landing",
    "write_snapshot",
]
