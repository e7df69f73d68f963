from tiermill.sinks.messages import encode_messages, publish_messages
from tiermill.sinks.tables import (
    append,
    create_schema,
    create_table,
    overwrite_all,
    overwrite_partitions,
    register_table,
    show_tables,
)

__all__ = [
    "append",
    "create_schema",
    "create_table",
    "encode_messages",
    "overwrite_all",
    "overwrite_partitions",
    "publish_messages",
    "register_table",
    "show_tables",
]
