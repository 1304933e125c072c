from .parsing import normalize_event_time, parse_ticks, split_bad_ticks, with_time_partitions
from .partitions import (
    format_spec,
    hour_key,
    hour_key_of,
    parse_partition_specs,
    partition_predicate,
    partition_spec_for,
)
from .times import event_time

__all__ = [
    "event_time",
    "format_spec",
    "hour_key",
    "hour_key_of",
    "normalize_event_time",
    "parse_partition_specs",
    "parse_ticks",
    "partition_predicate",
    "partition_spec_for",
    "split_bad_ticks",
    "with_time_partitions",
]
