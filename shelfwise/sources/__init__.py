from .feeds import read_bronze, read_bronze_by_name, read_bronze_strict, read_feeds
from .shared import shared_path
from .store import Load, Snapshot, open_snapshot, read_star, read_table

__all__ = [
    "Load", "Snapshot", "open_snapshot", "read_bronze", "read_bronze_by_name", "read_bronze_strict", "read_feeds", "read_star", "read_table",
    "shared_path",
]
