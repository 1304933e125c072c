from .ingest import ingest_ticks, write_tick_stream
from .latest import latest_ticks_stream, read_latest_ticks
from .progress import read_progress, recorded_progress
from .repeats import without_repeats
from .stats import read_window_stats, windowed_ticker_stats, write_window_stats

__all__ = [
    "ingest_ticks",
    "latest_ticks_stream",
    "read_latest_ticks",
    "read_progress",
    "read_window_stats",
    "recorded_progress",
    "windowed_ticker_stats",
    "without_repeats",
    "write_tick_stream",
    "write_window_stats",
]
