"""DataFrame-level operators (``DataFrame -> DataFrame``)."""

from .joins import anti_missing, join_bounded, semi_existing
from .lookup import Lookup, join_lookup, measure_lookups
from .project import rename_drop, with_audit
from .snapshot import latest_path_string_max, latest_snapshot, load_order, newest_entries, newest_load
from .tables import (dedup_latest, dedup_latest_window, duplicate_keys, empty_like,
                     require_unique_keys, row_hash, union_by_name_evolve, upsert)

__all__ = [n for n in dir() if not n.startswith("_")]
