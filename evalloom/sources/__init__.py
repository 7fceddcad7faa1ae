"""Readers and writers."""

from evalloom.sources.stored import Ledger, append_stored, merge_stored, read_stored
from evalloom.sources.tables import (
    append_evolving,
    from_records,
    fold_kv,
    kv_to_map,
    legacy_layout,
    load,
    load_jsonl,
    save,
    save_jsonl,
)

__all__ = [
    "Ledger", "append_evolving", "append_stored", "fold_kv", "from_records", "kv_to_map", "legacy_layout", "load",
    "load_jsonl", "merge_stored", "read_stored", "save", "save_jsonl",
]
