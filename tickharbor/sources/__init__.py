from .inventory import file_inventory, read_inventory, read_latest_files
from .lake import read_legacy_ticks, read_partitions, read_ticks, ticks_since, union_ticks
from .stream import tick_source
from .tables import events_as_ticks, events_as_messages

__all__ = [
    "events_as_messages",
    "events_as_ticks",
    "file_inventory",
    "read_inventory",
    "read_latest_files",
    "read_legacy_ticks",
    "read_partitions",
    "read_ticks",
    "tick_source",
    "ticks_since",
    "union_ticks",
]
