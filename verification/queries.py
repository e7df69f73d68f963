"""One Spark query per operator, over the given tables.

Results are shown in types that compare alike in any engine: dates as text, times as epoch
seconds, floats as doubles rounded to six places (two engines add in different orders).
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermill.config import LAYERS, configure_session
from tiermill.functions import thresholds
from tiermill.operators import analysis, cleaning, counts, hourly, parsing, quality, series, storage
from tiermill.plans import ingest_ledger, jobs, maintenance, monitoring
from tiermill.sinks import messages as message_sinks
from tiermill.sinks import tables
from tiermill.sources import layers as layer_scans
from tiermill.sources import messages as message_scans
from tiermill.sources import metrics as M
from tiermill.sources.ranges import as_offsets, bounded, without
from tiermill.streaming import pipelines as streams
from verification import inputs
from verification.inputs import AS_OF

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

# End of the metric clock's 30 days, and a time shortly before it.
METRICS_AS_OF = "2024-01-01 11:50:00"


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure_session(spark)
        return portable(function(spark, sf_dir))

    _QUERIES[function.__name__] = run
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def portable(df: DataFrame) -> DataFrame:
    def shown(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            column = F.round(column.cast("double"), 6)
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.unix_seconds(column)
        return column.alias(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def rows_shown(df: DataFrame) -> DataFrame:
    """Layer rows with an epoch number that stays whole beside nulls, and NaN told from null."""
    return df.withColumns(
        {
            "timestamp": F.col("timestamp").cast("string"),
            "upload_is_nan": F.coalesce(F.isnan("upload_speed"), F.lit(False)),
            "upload_speed": F.when(F.isnan("upload_speed"), F.lit(None)).otherwise(F.col("upload_speed")),
        }
    )


def _layer(spark, sf_dir, layer):
    return layer_scans.read_layer(spark, inputs.built_pipeline(spark, sf_dir, layer), layer)


# --- scans ------------------------------------------------------------------------------------


@query
def scan_messages(spark, sf_dir):
    cfg = inputs.built_pipeline(spark, sf_dir, "messages")
    messages = message_scans.read_messages(spark, cfg)
    return messages.groupBy("topic", "partition", "timestampType").agg(
        F.count(F.lit(1)).alias("messages"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.max("timestamp").alias("last_time"),
        F.sum(F.length(F.col("value").cast("string"))).alias("characters"),
    )


@query
def scan_messages_offsets(spark, sf_dir):
    """A part of each topic partition, from one offset on and before another."""
    cfg = inputs.built_pipeline(spark, sf_dir, "messages")
    starts, ends = (f'{{"{cfg.topic}": {{{", ".join(f"{chr(34)}{p}{chr(34)}: {o}" for p, o in enumerate(x))}}}}}' for x in ((300, -2, 100, 20), (900, 500, 800, 90)))
    messages = message_scans.read_messages(spark, cfg, starts, ends)
    return messages.groupBy("partition").agg(F.count(F.lit(1)).alias("messages"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))


@query
def ingest_twice_adds_nothing(spark, sf_dir):
    """The second run starts where the first one ended."""
    cfg = _stream_config(spark, sf_dir)
    for _ in range(2):
        jobs.ingest_bronze(spark, cfg, resume=True)
    return rows_shown(layer_scans.read_layer(spark, cfg, "bronze"))


@query
def ingest_text_twice(spark, sf_dir):
    """Lines of a landing folder, more of them, and nothing new: three runs that each go on where the last one ended."""
    cfg = dataclasses.replace(inputs.fresh_config(spark), message_format="text")
    measured = inputs.measurements(spark, sf_dir)
    late = F.col("location").isin("Paris", "Toronto")
    for part in (measured.where(~late), measured.where(late), None):
        if part is not None:
            message_sinks.publish_messages(part, cfg)
        jobs.ingest_bronze(spark, cfg, resume=True)
    return rows_shown(layer_scans.read_layer(spark, cfg, "bronze"))


@query
def ingest_gap_then_resume(spark, sf_dir):
    """The later part of each partition first, then the rest."""
    cfg = _stream_config(spark, sf_dir)
    jobs.ingest_bronze(spark, cfg, as_offsets(cfg.topic, {"0": 900, "1": 500, "2": 700, "3": 90}))
    jobs.ingest_bronze(spark, cfg, resume=True)
    return rows_shown(layer_scans.read_layer(spark, cfg, "bronze"))


class _BrokenOff(Exception):
    pass


@query
def ingest_after_crash(spark, sf_dir):
    """Two runs that break off, one halfway through its write and one right after it, and the runs that settle them."""
    cfg = _stream_config(spark, sf_dir)
    tables.ensure_table(spark, cfg, "bronze")
    ingest_ledger.ensure(spark, cfg)
    there = message_scans.available(spark, cfg)
    early = bounded(there, {}, {p: 400 for p in there})
    for run_id, ranges, written in (("halfway", early, F.col("offset") % 2 == 0), ("unmarked", without(there, early), F.lit(True))):
        try:
            with ingest_ledger.intent(spark, cfg, run_id, ranges):
                jobs.write_run(message_scans.read_ranges(spark, cfg, ranges).where(written), cfg, run_id)
                raise _BrokenOff
        except _BrokenOff:
            jobs.ingest_bronze(spark, cfg, ending_offsets=as_offsets(cfg.topic, {p: own[-1][1] for p, own in ranges.items()}), resume=True)
    return rows_shown(layer_scans.read_layer(spark, cfg, "bronze"))


@query
def scan_bronze(spark, sf_dir):
    return rows_shown(_layer(spark, sf_dir, "bronze"))


@query
def scan_silver(spark, sf_dir):
    return rows_shown(_layer(spark, sf_dir, "silver"))


@query
def scan_gold(spark, sf_dir):
    return _layer(spark, sf_dir, "gold")


@query
def scan_silver_dates(spark, sf_dir):
    """A range of days, read through partition pruning."""
    cfg = inputs.built_pipeline(spark, sf_dir, "silver")
    return rows_shown(layer_scans.read_layer(spark, cfg, "silver", "2024-01-10", "2024-01-12"))


# --- messages to rows -------------------------------------------------------------------------


@query
def publish_messages(spark, sf_dir):
    """Events to a landing folder and back as lines."""
    cfg = dataclasses.replace(inputs.fresh_config(spark), message_format="text")
    message_sinks.publish_messages(inputs.measurements(spark, sf_dir), cfg)
    return message_scans.read_messages(spark, cfg).select(F.col("value").cast("string").alias("message"))


@query
def encode_json(spark, sf_dir):
    encoded = message_sinks.encode_messages(inputs.silver_view(spark, sf_dir))
    return encoded.select(F.col("value").cast("string").alias("message"))


@query
def parse_messages(spark, sf_dir):
    cfg = inputs.built_pipeline(spark, sf_dir, "messages")
    return rows_shown(parsing.parse_messages(message_scans.read_messages(spark, cfg)))


@query
def bronze_lineage(spark, sf_dir):
    sent = inputs.built_pipeline(spark, sf_dir, "messages")
    cfg = dataclasses.replace(inputs.fresh_config(spark), message_path=sent.message_path, keep_lineage=True)
    jobs.ingest_bronze(spark, cfg)
    bronze = layer_scans.read_layer(spark, cfg, "bronze")
    return bronze.select("user_id", "location", "date", "_topic", "_partition", "_offset", "_ingest_ts")


@query
def add_date(spark, sf_dir):
    return rows_shown(parsing.add_date(inputs.measurements(spark, sf_dir)))


@query
def add_date_if_missing(spark, sf_dir):
    """Once where the column is there, once where it is not."""
    bronze = inputs.bronze_view(spark, sf_dir)
    kept = parsing.add_date_if_missing(bronze.withColumn("date", F.date_add("date", 1)))
    derived = parsing.add_date_if_missing(bronze.drop("date"))
    return counts.row_counts({"kept": kept}).select(F.lit("-").alias("date"), "layer", "row_count").unionByName(
        kept.groupBy(F.col("date").cast("string").alias("date"), F.lit("kept, by date").alias("layer"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .unionByName(
            derived.groupBy(F.col("date").cast("string").alias("date"), F.lit("derived, by date").alias("layer")).agg(
                F.count(F.lit(1)).alias("row_count")
            )
        )
    )


@query
def add_hour(spark, sf_dir):
    return rows_shown(parsing.add_hour(inputs.measurements(spark, sf_dir)))


@query
def add_hour_seconds(spark, sf_dir):
    """The hour when the epoch number is read as seconds."""
    with_hour = parsing.add_hour(inputs.measurements(spark, sf_dir), ts_unit="s")
    return with_hour.groupBy("location", "hour").agg(F.count(F.lit(1)).alias("n"))


# --- cleaning ---------------------------------------------------------------------------------


@query
def drop_nulls(spark, sf_dir):
    return rows_shown(cleaning.drop_nulls(inputs.bronze_view(spark, sf_dir)))


@query
def dedup(spark, sf_dir):
    """Copies that differ in latency: the survivor is the smallest."""
    bronze = inputs.bronze_view(spark, sf_dir, differing_copies=True)
    return rows_shown(cleaning.dedup(cleaning.drop_nulls(bronze)))


@query
def clean(spark, sf_dir):
    return rows_shown(inputs.silver_view(spark, sf_dir))


# --- aggregates and analyses ------------------------------------------------------------------


@query
def gold_hourly(spark, sf_dir):
    return inputs.gold_view(spark, sf_dir)


@query
def gold_kpis(spark, sf_dir):
    return hourly.gold_kpis(_layer(spark, sf_dir, "silver"))


@query
def date_distribution(spark, sf_dir):
    return analysis.date_distribution(_layer(spark, sf_dir, "bronze"))


@query
def top_locations(spark, sf_dir):
    return analysis.top_locations(_layer(spark, sf_dir, "gold"), as_of=AS_OF)


@query
def top_locations_weighted(spark, sf_dir):
    silver = _layer(spark, sf_dir, "silver")
    return analysis.top_locations_weighted(hourly.gold_kpis(silver, probabilities=()), as_of=AS_OF)


@query
def hourly_trend(spark, sf_dir):
    return analysis.hourly_trend(_layer(spark, sf_dir, "gold"), "New York")


@query
def latency_by_location(spark, sf_dir):
    return analysis.latency_by_location(_layer(spark, sf_dir, "gold"))


@query
def gold_today(spark, sf_dir):
    return analysis.gold_today(_layer(spark, sf_dir, "gold"), as_of=AS_OF)


@query
def gold_sql(spark, sf_dir):
    """An analyst's statement, as text, on the gold table."""
    gold = inputs.built_pipeline(spark, sf_dir).table_name("gold")
    return spark.sql(f"""
        SELECT location, count(*) AS hours, avg(avg_download_speed) AS avg_dl, avg(avg_latency) AS avg_latency
        FROM {gold}
        WHERE date >= DATE '{AS_OF}' - INTERVAL '1' DAY
        GROUP BY location
    """)


@query
def preview_rows(spark, sf_dir):
    silver = _layer(spark, sf_dir, "silver")
    return rows_shown(analysis.preview_rows(silver, 10, order_by=("user_id", "timestamp")))


# --- tables and jobs --------------------------------------------------------------------------


@query
def bronze_append(spark, sf_dir):
    """Two appends add up."""
    cfg = inputs.fresh_config(spark)
    tables.create_schema(spark, cfg, "bronze")
    tables.create_table(spark, cfg, "bronze")
    for _ in range(2):
        tables.append(inputs.bronze_view(spark, sf_dir), cfg, "bronze")
    return layer_scans.read_layer(spark, cfg, "bronze").groupBy("date", "location").agg(F.count(F.lit(1)).alias("n"))


def _written_twice(spark, sf_dir, layer, df, second):
    cfg = inputs.fresh_config(spark)
    tables.create_schema(spark, cfg, layer)
    tables.create_table(spark, cfg, layer)
    tables.overwrite_partitions(df, cfg, layer)
    tables.overwrite_partitions(second, cfg, layer)
    return layer_scans.read_layer(spark, cfg, layer)


@query
def silver_overwrite_partitions(spark, sf_dir):
    """The second write brings the last fifteen days, with latency doubled; the others stay."""
    silver = inputs.silver_view(spark, sf_dir)
    second = silver.where(F.col("date") >= F.lit("2024-01-16").cast("date")).withColumn(
        "latency", (F.col("latency") * 2).cast("float")
    )
    return rows_shown(_written_twice(spark, sf_dir, "silver", silver, second))


@query
def gold_overwrite_partitions(spark, sf_dir):
    """The second write brings one location's hours before noon; of its days nothing else is left."""
    cfg = dataclasses.replace(inputs.fresh_config(spark), gold_partition_by=("date", "location"))
    tables.create_schema(spark, cfg, "gold")
    tables.create_table(spark, cfg, "gold")
    gold = inputs.gold_view(spark, sf_dir)
    tables.overwrite_partitions(tables.group_for_write(gold, "date", "location"), cfg, "gold")
    second = gold.where((F.col("location") == "Berlin") & (F.col("hour") < 12))
    tables.overwrite_partitions(tables.group_for_write(second, "date", "location"), cfg, "gold")
    return layer_scans.read_layer(spark, cfg, "gold")


@query
def run_medallion(spark, sf_dir):
    """All jobs, from messages to gold."""
    sent = inputs.built_pipeline(spark, sf_dir, "messages")
    cfg = dataclasses.replace(inputs.fresh_config(spark), message_path=sent.message_path)
    jobs.run_medallion(spark, cfg)
    return layer_scans.read_layer(spark, cfg, "gold")


@query
def run_medallion_daily(spark, sf_dir):
    """Silver and gold filled day range by day range end up as in one run."""
    built = inputs.built_pipeline(spark, sf_dir, "bronze")
    own = inputs.fresh_config(spark)
    cfg = dataclasses.replace(own, bronze_db=built.bronze_db)
    for first, last in (("2024-01-01", "2024-01-14"), ("2024-01-15", "2024-01-15"), ("2024-01-16", None)):
        jobs.bronze_to_silver(spark, cfg, first, last)
        jobs.silver_to_gold(spark, cfg, first, last)
    return layer_scans.read_layer(spark, cfg, "gold")


@query
def redo_changed_day(spark, sf_dir):
    """All days, nothing, and the one day that got rows meanwhile: the rows of silver that each of the runs wrote."""
    built = inputs.built_pipeline(spark, sf_dir, "bronze")
    cfg = inputs.fresh_config(spark)
    tables.ensure_table(spark, cfg, "bronze")
    bronze = layer_scans.read_layer(spark, built, "bronze")
    late = (F.col("date") == F.lit("2024-01-09").cast("date")) & (F.col("location") == "Tokyo")
    tables.append(bronze.where(~late | F.col("date").isNull()), cfg, "bronze")
    written = []
    for _ in range(2):
        written.append(jobs.redo_changed(spark, cfg))
    tables.append(bronze.where(late), cfg, "bronze")
    written.append(jobs.redo_changed(spark, cfg))
    shown = [(i, r.job, r.rows_out) for i, runs in enumerate(written, 1) for r in runs]
    return spark.createDataFrame(shown, "turn int, job string, rows_out long")


@query
def ddl_layers(spark, sf_dir):
    """Rows written to the tables the DDL makes, with the number of columns and partitions."""
    cfg = inputs.built_pipeline(spark, sf_dir)
    shown = []
    for layer in LAYERS:
        df = layer_scans.read_layer(spark, cfg, layer)
        shown.append(
            df.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("date").alias("dates")).select(
                F.lit(layer).alias("layer"), F.lit(len(df.columns)).alias("columns"), "dates", "row_count"
            )
        )
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


@query
def register_tables(spark, sf_dir):
    """Files of the built tables under new names: registered, and all rows there."""
    built = inputs.built_pipeline(spark, sf_dir)
    fresh = inputs.fresh_config(spark)
    rows = None
    for layer in LAYERS:
        tables.register_table(spark, fresh, layer, built.location(layer))
        count = counts.row_counts({layer: layer_scans.read_layer(spark, fresh, layer)})
        rows = count if rows is None else rows.unionByName(count)
    return rows


@query
def show_tables(spark, sf_dir):
    """Tables of the three schemas, each with its rows."""
    cfg = inputs.built_pipeline(spark, sf_dir)
    listed = None
    for layer in LAYERS:
        names = tables.show_tables(spark, cfg, layer).select(F.col("tableName").alias("table_name"))
        rows = counts.row_counts({cfg.table(layer): layer_scans.read_layer(spark, cfg, layer)})
        part = names.join(rows, names.table_name == rows.layer).select("table_name", "row_count")
        listed = part if listed is None else listed.unionByName(part)
    return listed


@query
def table_history(spark, sf_dir):
    cfg = inputs.built_pipeline(spark, sf_dir)
    history = None
    for layer in LAYERS:
        commits = maintenance.table_history(spark, cfg, layer).select("layer", "rows_in", "rows_out")
        history = commits if history is None else history.unionByName(commits)
    return history


@query
def maintenance_report(spark, sf_dir):
    report = maintenance.maintenance_report(spark, inputs.built_pipeline(spark, sf_dir))
    return report.select("layer", "row_count", "commits", "status")


@query
def run_metrics(spark, sf_dir):
    cfg = inputs.built_pipeline(spark, sf_dir)
    log = spark.table(cfg.table_name("run_log"))
    return log.select(
        "job", "rows_in", "rows_rejected", "rows_out", "status", (F.col("rows_per_s") > 0).alias("has_rate")
    )


@query
def error_rate(spark, sf_dir):
    cfg = inputs.built_pipeline(spark, sf_dir)
    return quality.error_rate(spark.table(cfg.table_name("run_log"))).drop("run_id")


@query
def error_rate_dated(spark, sf_dir):
    """Rows read and rejected, summed over an ingest and runs over parts of the days: as for a whole run."""
    built = inputs.built_pipeline(spark, sf_dir, "bronze")
    cfg = dataclasses.replace(inputs.fresh_config(spark), bronze_db=built.bronze_db)
    for first, last in ((None, "2024-01-14"), ("2024-01-15", "2024-01-15"), ("2024-01-16", None)):
        jobs.bronze_to_silver(spark, cfg, first, last)
    ingested = spark.table(built.table_name("run_log")).where("job = 'ingest_bronze'")
    log = spark.table(cfg.table_name("run_log")).unionByName(ingested)
    return log.groupBy("job").agg(F.sum("rows_in").alias("rows_in"), F.sum("rows_rejected").alias("rows_rejected"))


@query
def quality_report(spark, sf_dir):
    return quality.quality_report(_layer(spark, sf_dir, "bronze"))


@query
def layer_row_counts(spark, sf_dir):
    return monitoring.layer_row_counts(spark, inputs.built_pipeline(spark, sf_dir), with_messages=True)


@query
def table_metrics(spark, sf_dir):
    built = inputs.built_pipeline(spark, sf_dir)
    cfg = dataclasses.replace(built, ops_db=inputs.fresh_config(spark).ops_db)
    monitoring.table_metrics(spark, cfg, as_of=f"{AS_OF} 00:00:00", with_messages=True)
    return M.read_metrics(spark, cfg).select("metric", "series", "ts", "value")


@query
def run_log_metrics(spark, sf_dir):
    """Durations and ingested messages, as the jobs leave them."""
    cfg = inputs.built_pipeline(spark, sf_dir)
    samples = monitoring.run_samples(spark.table(cfg.table_name("run_log")))
    counted = F.when(F.col("metric") == M.MESSAGES_IN, F.col("value"))
    return samples.select("metric", "series", "job_id", counted.alias("messages"), (F.col("value") > 0).alias("has_value"))


@query
def storage_usage(spark, sf_dir):
    used = storage.storage_usage(spark, inputs.built_pipeline(spark, sf_dir, "silver"), "silver")
    return used.select("date", (F.col("files") > 0).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"))


# --- metric series ----------------------------------------------------------------------------


def _folded(spark, sf_dir):
    """Current values after two folds, of which the second brings late samples and ones folded in before."""
    cfg = inputs.fresh_config(spark)
    samples = inputs.metric_samples(spark, sf_dir).where(F.col("metric").isin(*M.ROW_COUNTS))
    in_time = F.col("ts") >= F.lit("2024-01-01 06:00:00").cast("timestamp")
    for part in (samples.where(in_time), samples):
        monitoring.fold_current(spark, cfg, part)
    return cfg


@query
def metric_latest(spark, sf_dir):
    return M.read_current(spark, _folded(spark, sf_dir), M.ROW_COUNTS).select("metric", "series", "ts", "value")


@query
def metric_latest_scan(spark, sf_dir):
    """The same from all samples."""
    return M.latest_values(inputs.metric_samples(spark, sf_dir), M.ROW_COUNTS)


@query
def metric_time_range(spark, sf_dir):
    samples = M.time_range(inputs.metric_samples(spark, sf_dir), METRICS_AS_OF)
    return samples.groupBy("metric", "series").agg(
        F.count(F.lit(1)).alias("samples"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


@query
def counter_rate_1m(spark, sf_dir):
    rates = series.counter_rate(inputs.metric_samples(spark, sf_dir), M.MESSAGES_IN, 60)
    return rates.select("series", "ts", "rate")


@query
def counter_rate_5m(spark, sf_dir):
    rates = series.counter_rate(inputs.metric_samples(spark, sf_dir), M.BRONZE_ROWS, 300)
    return series.metric_status(rates, "rate", thresholds.RATE_STEPS).select("series", "ts", "rate", "status")


@query
def throughput_total(spark, sf_dir):
    return series.throughput_total(inputs.metric_samples(spark, sf_dir), M.MESSAGES_IN)


@query
def avg_by_label(spark, sf_dir):
    samples = inputs.metric_samples(spark, sf_dir)
    per_job = series.avg_by_label(samples, M.JOB_DURATION, "job_id").withColumnRenamed("job_id", "label")
    per_query = series.avg_by_label(samples, M.QUERY_ELAPSED, "query_id").withColumnRenamed("query_id", "label")
    return per_job.unionByName(per_query)


@query
def quality_pct(spark, sf_dir):
    pct = series.quality_pct(inputs.metric_samples(spark, sf_dir))
    return series.metric_status(pct, "quality_pct", thresholds.QUALITY_STEPS)


@query
def metric_status(spark, sf_dir):
    """Each layer's samples counted by colour."""
    samples = inputs.metric_samples(spark, sf_dir).where(F.col("metric").isin(*M.ROW_COUNTS))
    coloured = series.metric_status(samples, "value", thresholds.ROW_COUNT_STEPS)
    return coloured.groupBy("metric", "status").agg(F.count(F.lit(1)).alias("samples"))


@query
def metric_timeline(spark, sf_dir):
    return series.metric_timeline(inputs.metric_samples(spark, sf_dir))


@query
def freshness_seconds(spark, sf_dir):
    fresh = series.freshness_seconds(inputs.metric_samples(spark, sf_dir), METRICS_AS_OF)
    return series.metric_status(fresh, "freshness_s", thresholds.FRESHNESS_STEPS)


@query
def pipeline_health(spark, sf_dir):
    return series.pipeline_health(M.read_current(spark, _folded(spark, sf_dir)))


# --- streams ----------------------------------------------------------------------------------


def _stream_config(spark, sf_dir):
    sent = inputs.built_pipeline(spark, sf_dir, "messages")
    return dataclasses.replace(inputs.fresh_config(spark), message_path=sent.message_path)


def _streamed_bronze(spark, sf_dir):
    cfg = _stream_config(spark, sf_dir)
    streams.stream_bronze(message_scans.read_message_stream(spark, cfg), cfg).awaitTermination()
    return cfg


@query
def stream_bronze(spark, sf_dir):
    """Run twice: the second run finds nothing new."""
    cfg = _streamed_bronze(spark, sf_dir)
    streams.stream_bronze(message_scans.read_message_stream(spark, cfg), cfg).awaitTermination()
    return rows_shown(layer_scans.read_layer(spark, cfg, "bronze"))


@query
def stream_silver(spark, sf_dir):
    cfg = _streamed_bronze(spark, sf_dir)
    streams.stream_silver(layer_scans.read_layer_stream(spark, cfg, "bronze"), cfg).awaitTermination()
    return rows_shown(layer_scans.read_layer(spark, cfg, "silver"))


@query
def stream_silver_stateful(spark, sf_dir):
    cfg = _streamed_bronze(spark, sf_dir)
    bronze = layer_scans.read_layer_stream(spark, cfg, "bronze")
    streams.stream_silver_stateful(bronze, cfg, spread=F.col("_metadata.file_path")).awaitTermination()
    return rows_shown(layer_scans.read_layer(spark, cfg, "silver"))


@query
def stream_silver_smallest(spark, sf_dir):
    """Copies that differ in latency, in two appends to bronze; what the watermark, 36 hours behind the last event, has passed."""
    cfg = inputs.fresh_config(spark)
    tables.ensure_table(spark, cfg, "bronze")
    events = inputs.replayed_events(spark, sf_dir)
    for part in (F.col("copy") == 1, F.col("copy") == 0):
        tables.append(parsing.add_date(inputs.as_measurements(events.where(part), differing_copies=True)), cfg, "bronze")
    streams.stream_silver_smallest(layer_scans.read_layer_stream(spark, cfg, "bronze"), cfg, delay="36 hours").awaitTermination()
    return rows_shown(layer_scans.read_layer(spark, cfg, "silver"))


@query
def stream_gold_hourly(spark, sf_dir):
    built = inputs.built_pipeline(spark, sf_dir, "silver")
    cfg = dataclasses.replace(inputs.fresh_config(spark), silver_db=built.silver_db)
    streams.stream_gold_hourly(layer_scans.read_layer_stream(spark, cfg, "silver"), cfg).awaitTermination()
    return layer_scans.read_layer(spark, cfg, "gold")


@query
def stream_gold_incremental(spark, sf_dir):
    """Gold from the sums of each micro-batch, of which there are several."""
    built = inputs.built_pipeline(spark, sf_dir, "silver")
    cfg = dataclasses.replace(inputs.fresh_config(spark), silver_db=built.silver_db)
    silver = layer_scans.read_layer_stream(spark, cfg, "silver", max_per_trigger=12)
    streams.stream_gold_incremental(silver, cfg, compact_every=2).awaitTermination()
    return layer_scans.read_layer(spark, cfg, "gold")


def _stream_all(spark, cfg):
    streams.stream_bronze(message_scans.read_message_stream(spark, cfg), cfg).awaitTermination()
    streams.stream_silver(layer_scans.read_layer_stream(spark, cfg, "bronze"), cfg).awaitTermination()
    streams.stream_gold_hourly(layer_scans.read_layer_stream(spark, cfg, "silver"), cfg).awaitTermination()


@query
def stream_then_batch(spark, sf_dir):
    """All layers by streams, and then all jobs on the same tables."""
    cfg = _stream_config(spark, sf_dir)
    _stream_all(spark, cfg)
    jobs.run_medallion(spark, cfg)
    return monitoring.layer_row_counts(spark, cfg)


@query
def batch_then_stream(spark, sf_dir):
    """Half of the days by jobs, and then all streams on the same tables."""
    cfg = _stream_config(spark, sf_dir)
    jobs.ingest_bronze(spark, cfg)
    jobs.bronze_to_silver(spark, cfg, None, "2024-01-15")
    jobs.silver_to_gold(spark, cfg)
    _stream_all(spark, cfg)
    return monitoring.layer_row_counts(spark, cfg)
