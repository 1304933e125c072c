from .aggregates import (
    avg_price_by_hour_ticker,
    avg_price_by_ticker,
    daily_avg_price,
    price_trend,
    record_count_by_ticker,
    tick_count,
    ticker_kpis,
    ticker_list,
    ticker_summary,
    ticks_by_partition,
)
from .compaction import CompactionError, compact_partitions, partition_stats
from .history import file_history, inventory_as_of, inventory_changes_between, keep_snapshot, read_snapshot
from .inventory import (
    assert_compaction,
    compaction_reduction,
    inventory_by_group,
    inventory_by_partition,
    inventory_diff,
    inventory_summary,
    largest_files,
    require_compaction,
)
from .models import first_model, materialize, second_model
from .quality import check_ticks, not_null_violations, unique_violations
from .ranked import latest_ticks, latest_ticks_at, latest_ticks_recent, preview, price_bands, ticker_tail
from .sinks import save_inventory, save_table

__all__ = [
    "CompactionError",
    "assert_compaction",
    "avg_price_by_hour_ticker",
    "avg_price_by_ticker",
    "check_ticks",
    "compact_partitions",
    "compaction_reduction",
    "daily_avg_price",
    "file_history",
    "first_model",
    "inventory_as_of",
    "inventory_by_group",
    "inventory_by_partition",
    "inventory_changes_between",
    "inventory_diff",
    "inventory_summary",
    "keep_snapshot",
    "largest_files",
    "latest_ticks",
    "latest_ticks_at",
    "latest_ticks_recent",
    "materialize",
    "not_null_violations",
    "partition_stats",
    "preview",
    "price_bands",
    "price_trend",
    "read_snapshot",
    "record_count_by_ticker",
    "require_compaction",
    "save_inventory",
    "save_table",
    "second_model",
    "tick_count",
    "ticker_kpis",
    "ticker_list",
    "ticker_summary",
    "ticker_tail",
    "ticks_by_partition",
    "unique_violations",
]
