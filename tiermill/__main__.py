"""Run one job: ``spark-submit … -m tiermill JOB`` or ``python -m tiermill JOB``.

Parameters come from the environment (see `config.ENVIRONMENT`); order, schedule and retries
are the caller's.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tiermill import plans
from tiermill.config import PipelineConfig, configure_session

JOBS = (
    "ingest-bronze",
    "bronze-to-silver",
    "silver-to-gold",
    "run-medallion",
    "maintenance-report",
    "register-tables",
    "table-metrics",
)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tiermill")
    p.add_argument("job", choices=JOBS)
    p.add_argument("--date-from")
    p.add_argument("--date-to")
    p.add_argument("--full-refresh", action="store_true")
    p.add_argument("--touched-only", action="store_true", help="run-medallion: redo the dates of the new messages")
    p.add_argument("--resume", action="store_true", help="ingest: start where the last run ended")
    p.add_argument("--starting-offsets")
    p.add_argument("--ending-offsets")
    return p


def main() -> None:
    args = parser().parse_args()
    cfg = PipelineConfig.from_env()
    builder = SparkSession.builder.appName(f"tiermill {args.job}").config(map=cfg.session_settings())
    spark = configure_session(builder.getOrCreate())
    dates = (args.date_from, args.date_to)
    if args.job == "ingest-bronze":
        print(plans.ingest_bronze(spark, cfg, args.starting_offsets, args.ending_offsets, resume=args.resume))
    elif args.job == "bronze-to-silver":
        print(plans.bronze_to_silver(spark, cfg, *dates, full_refresh=args.full_refresh))
    elif args.job == "silver-to-gold":
        print(plans.silver_to_gold(spark, cfg, *dates, full_refresh=args.full_refresh))
    elif args.job == "run-medallion":
        runs, report = plans.run_medallion(spark, cfg, *dates, touched_only=args.touched_only, resume=args.resume)
        print(*runs, sep="\n")
        report.show(truncate=False)
    elif args.job == "maintenance-report":
        plans.maintenance_report(spark, cfg).show(truncate=False)
    elif args.job == "register-tables":
        plans.register_tables(spark, cfg).show(truncate=False)
    else:
        plans.table_metrics(spark, cfg)
    spark.stop()


if __name__ == "__main__":
    main()
