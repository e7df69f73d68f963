from tiermill.streaming.pipelines import (
    hourly_windows,
    stream_bronze,
    stream_gold_hourly,
    stream_gold_incremental,
    stream_silver,
    stream_silver_smallest,
    stream_silver_stateful,
)

__all__ = ["hourly_windows", "stream_bronze", "stream_gold_hourly", "stream_gold_incremental", "stream_silver", "stream_silver_smallest", "stream_silver_stateful"]
