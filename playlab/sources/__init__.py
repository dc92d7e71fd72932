"""Reading plays, profiling them and writing reports."""

from playlab.sources.plays import plays, scan, scan_table, write_partitioned, PLAYS_SCHEMA
from playlab.sources.io import profile, write_csv, read_csv, head

__all__ = [
    "plays", "scan", "scan_table", "write_partitioned", "PLAYS_SCHEMA",
    "profile", "write_csv", "read_csv", "head",
]
