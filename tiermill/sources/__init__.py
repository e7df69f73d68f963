from tiermill.sources.layers import read_layer, read_layer_stream
from tiermill.sources.messages import read_message_stream, read_messages
from tiermill.sources.metrics import latest_values, read_metrics, time_range

__all__ = [
    "latest_values",
    "read_layer",
    "read_layer_stream",
    "read_message_stream",
    "read_messages",
    "read_metrics",
    "time_range",
]
