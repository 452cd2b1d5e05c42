"""Sources (readers) and sinks (writers, catalogue maintenance)."""

from .keyed import read_keyed, register_keyed, upsert_keyed
from .readers import (newest_partitions, parse_json_column, read_csv, read_csv_tagged, read_json, read_newest, read_table,
                      read_workbooks, string_schema)
from .sinks import (append_load, create_table, export_single_csv, insert_into, read_evolving, read_key_buckets,
                    register_table, replace_table, upsert_partitions, with_key_bucket,
                    write_table)
from .versions import ConcurrentWrite, read_current

__all__ = [n for n in dir() if not n.startswith("_")]
