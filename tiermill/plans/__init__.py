from tiermill.plans.jobs import bronze_to_silver, ingest_bronze, redo_changed, run_medallion, silver_to_gold
from tiermill.plans.maintenance import maintenance_report, register_tables, table_history
from tiermill.plans.monitoring import add_samples, layer_row_counts, run_samples, table_metrics

__all__ = [
    "add_samples",
    "bronze_to_silver",
    "ingest_bronze",
    "layer_row_counts",
    "maintenance_report",
    "redo_changed",
    "register_tables",
    "run_medallion",
    "run_samples",
    "silver_to_gold",
    "table_history",
    "table_metrics",
]
