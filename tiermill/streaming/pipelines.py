"""The layers as Structured Streaming queries.

Every query runs what has arrived and stops (`availableNow`), unless given another trigger, and
keeps its offsets in a checkpoint: a second run reads only what is new. All of them write micro-batch
by micro-batch through the same table writes as the jobs, so that batch and stream may share a table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tiermill.config import PipelineConfig
from tiermill.functions.event_time import event_timestamp
from tiermill.operators.cleaning import dedup, drop_nulls
from tiermill.operators.hourly import gold_hourly, gold_of_parts, gold_parts, merged_parts
from tiermill.operators.parsing import add_date, parse_messages
from tiermill.plans.run_log import write_observed
from tiermill.schemas import DEDUP_KEYS, GOLD_PARTS, INGEST_RUN, MEASURES, SILVER, STREAM_BATCHES
from tiermill.sinks.tables import append, ensure_table, group_for_write, overwrite_partitions, sort_for_write
from tiermill.sources.layers import read_layer

_ONCE: Mapping = {"availableNow": True}


def stream_bronze(messages: DataFrame, cfg: PipelineConfig, trigger: Mapping = _ONCE) -> StreamingQuery:
    """Messages to bronze, each once.

    A ledger names the micro-batches that are in the table; one that comes again after a failure is passed
    over. Each has partitions of its own there: where the failure falls between the write and its entry, the batch that
    comes again replaces what it left.
    """
    ensure_table(messages.sparkSession, cfg, "bronze")
    bronze = add_date(parse_messages(messages, cfg.keep_lineage), cfg.ts_unit)
    name = md5(cfg.checkpoint("stream_bronze").encode()).hexdigest()

    def write(batch: DataFrame, batch_id: int) -> None:
        overwrite_partitions(batch.withColumn(INGEST_RUN.name, F.lit(f"{name}-{batch_id}")), cfg, "bronze")

    return _each_batch(bronze, cfg, "stream_bronze", trigger, _once_each(cfg, "stream_bronze", write))


def stream_silver(bronze: DataFrame, cfg: PipelineConfig, trigger: Mapping = _ONCE) -> StreamingQuery:
    """Bronze to silver, exact however late a copy comes.

    Each micro-batch is cleaned and deduplicated in itself, then only keys that silver does not
    hold yet are appended. Copies are combined before the shuffle and silver has each key once,
    so the anti-join meets no hot key; it reads two columns of the days the batch touches, without a shuffle of
    silver's side where the configuration gives silver buckets. No
    state is kept, and a micro-batch that is run again finds its rows in place. Between copies
    that differ, the first micro-batch wins, and the smallest copy within one.
    """
    ensure_table(bronze.sparkSession, cfg, "silver")

    def add_new(batch: DataFrame, batch_id: int) -> None:
        present = read_layer(batch.sparkSession, cfg, "silver", dates=_days_of(batch)).select(*DEDUP_KEYS)
        new = new_rows(batch, present, cfg.bucket_by("silver"))
        if not cfg.bucket_by("silver"):
            new = group_for_write(new, "date")
        append(sort_for_write(new, "date", "location", "timestamp"), cfg, "silver")

    return _each_batch(bronze, cfg, "stream_silver", trigger, add_new)


def new_rows(batch: DataFrame, present: DataFrame, buckets: tuple[int, tuple[str, ...]] | None = None) -> DataFrame:
    """Clean rows of a micro-batch whose key isn't present.

    Where silver has buckets, the micro-batch, combined before, is dealt out like them: silver's side stays where it lies.
    """
    fresh = dedup(drop_nulls(batch.select(*SILVER.fieldNames())))
    if not buckets:
        return fresh.join(present, list(DEDUP_KEYS), "left_anti")
    # silver has each key once; an anti-join would be moved below the repartition
    dealt, there = fresh.repartition(buckets[0], *buckets[1]), present.withColumn("_there", F.lit(True))
    return dealt.join(there, list(DEDUP_KEYS), "left").where(F.col("_there").isNull()).drop("_there")


def _days_of(batch: DataFrame) -> list[str]:
    """All days of a micro-batch, from its partition values alone: as many as the partitions it meets.

    As text: a stray date may lie beyond what a Python date can hold.
    """
    days = batch.where(F.col("date").isNotNull()).select(F.col("date").cast("string").alias("day")).distinct()
    return sorted(r["day"] for r in days.collect())


def stream_silver_stateful(
    bronze: DataFrame,
    cfg: PipelineConfig,
    delay: str = "2 hours",
    spread: Column | None = None,
    salts: int = 16,
    trigger: Mapping = _ONCE,
) -> StreamingQuery:
    """Bronze to silver with keys kept as state, for short triggers.

    Cheaper per micro-batch than `stream_silver`, but a first copy later than `delay` is lost
    and the first copy to arrive survives. `spread` is a deterministic column in which copies of
    one key differ (offset, file): with it, copies are first thinned out over `salts` tasks, so
    that one key with very many copies does not end in a single task.
    """
    ensure_table(bronze.sparkSession, cfg, "silver")
    rows = drop_nulls(bronze.select(*SILVER.fieldNames(), *([spread.alias("_spread")] if spread is not None else [])))
    rows = rows.withColumn("_event_time", event_timestamp("timestamp", cfg.ts_unit)).withWatermark("_event_time", delay)
    if spread is not None:
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64("_spread"), F.lit(salts)))
        rows = rows.dropDuplicatesWithinWatermark([*DEDUP_KEYS, "_salt"])
    rows = rows.dropDuplicatesWithinWatermark(list(DEDUP_KEYS))
    name = "stream_silver_stateful"
    return _each_batch(rows.select(*SILVER.fieldNames()), cfg, name, trigger, _once_each(cfg, name, lambda batch, _: append(batch, cfg, "silver")))


def stream_silver_smallest(bronze: DataFrame, cfg: PipelineConfig, delay: str = "2 hours", trigger: Mapping = _ONCE) -> StreamingQuery:
    """Bronze to silver with keys kept as state until no copy can come any more; of the copies the smallest survives, as in a batch.

    A key waits until the watermark has passed its time, is written once and forgotten; a copy that comes more than
    `delay` after the newest event is dropped. Copies are combined before the shuffle and held as one row, so that a key
    with very many of them costs one row per task; the state holds the keys of the last `delay`. The last of these are
    written when later events come.
    """
    ensure_table(bronze.sparkSession, cfg, "silver")
    rows = drop_nulls(bronze.select(*SILVER.fieldNames()))
    timed = rows.withColumn("_event_time", event_timestamp("timestamp", cfg.ts_unit)).where(F.col("_event_time").isNotNull()).withWatermark("_event_time", delay)
    rest = [c for c in SILVER.fieldNames() if c not in DEDUP_KEYS]
    kept = timed.groupBy("_event_time", *DEDUP_KEYS).agg(F.min(F.struct(*rest)).alias("_first"))
    survivors = kept.select(*[F.col(c) if c in DEDUP_KEYS else F.col(f"_first.{c}").alias(c) for c in SILVER.fieldNames()])
    name = "stream_silver_smallest"
    write = _once_each(cfg, name, lambda batch, _: append(sort_for_write(group_for_write(batch, "date"), "date", "location", "timestamp"), cfg, "silver"))
    return _each_batch(survivors, cfg, name, trigger, write)


def hourly_windows(silver: DataFrame, delay: str = "2 hours", ts_unit: str = "ms") -> DataFrame:
    """Gold rows over one-hour event-time windows; on a stream, with a watermark."""
    timed = silver.withColumn("_event_time", event_timestamp("timestamp", ts_unit)).withWatermark("_event_time", delay)
    means = [F.avg(m).alias(f"avg_{m}") for m in MEASURES]
    start = F.col("window.start")
    return (
        timed.groupBy(F.window("_event_time", "1 hour"), "location")
        .agg(*means)
        .select(F.to_date(start).alias("date"), "location", F.hour(start).alias("hour"), *[f"avg_{m}" for m in MEASURES])
    )


def stream_gold_hourly(silver: DataFrame, cfg: PipelineConfig, trigger: Mapping = _ONCE) -> StreamingQuery:
    """Silver to gold: the days that a micro-batch touches are taken anew from silver and replaced.

    So gold is complete after each micro-batch, however late a row comes, and a micro-batch that is run again
    changes nothing. A day costs a scan of that day of silver; longer triggers do it less often.
    """
    ensure_table(silver.sparkSession, cfg, "gold")

    def redo(batch: DataFrame, batch_id: int) -> None:
        days = _days_of(batch)
        if days:
            whole = read_layer(batch.sparkSession, cfg, "silver", dates=days)
            gold = group_for_write(gold_hourly(whole, cfg.ts_unit), *cfg.partition_by("gold"))
            overwrite_partitions(sort_for_write(gold, "date", "location", "hour"), cfg, "gold")

    return _each_batch(silver, cfg, "stream_gold_hourly", trigger, redo)


#: Pieces of a day after which they are merged into one.
COMPACT_EVERY = 64


def stream_gold_incremental(silver: DataFrame, cfg: PipelineConfig, trigger: Mapping = _ONCE, compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Silver to gold at a cost in proportion to what arrived: no day of silver is read again.

    Each micro-batch writes the sums and counts of its own rows, per hour and location, as a piece of its own, and takes
    the gold of the days that it touches from the pieces of these days. A micro-batch that is run again replaces its piece, so
    nothing is counted twice. After every `compact_every` micro-batches the pieces of the days in hand become one.

    Silver must only be appended to, as `stream_silver` does: rows that a job writes anew would count again. Where jobs
    replace days of silver too, `stream_gold_hourly` is the one to take.
    """
    ensure_table(silver.sparkSession, cfg, "gold")
    ensure_table(silver.sparkSession, cfg, "gold_parts")
    name = md5(cfg.checkpoint("stream_gold_incremental").encode()).hexdigest()[:12]

    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = gold_parts(batch, cfg.ts_unit).withColumn("piece", F.lit(_piece(name, "batch", batch_id)))
        days = write_observed(own, lambda df: overwrite_partitions(df, cfg, "gold_parts"))["dates"]
        if not days:
            return
        gold = group_for_write(gold_of_parts(read_gold_parts(spark, cfg, name, days)), *cfg.partition_by("gold"))
        overwrite_partitions(sort_for_write(gold, "date", "location", "hour"), cfg, "gold")
        if (batch_id + 1) % compact_every == 0:
            _compact(spark, cfg, name, days, batch_id)

    return _each_batch(silver, cfg, "stream_gold_incremental", trigger, fold)


def _piece(name: str, kind: str, batch_id: int) -> str:
    return f"{name}-{kind}-{batch_id:012d}"


def read_gold_parts(spark: SparkSession, cfg: PipelineConfig, name: str, days: Sequence[str]) -> DataFrame:
    """Parts of the days: of each the newest merged piece, and those of micro-batches after it."""
    parts = read_layer(spark, cfg, "gold_parts", dates=days).where(F.col("piece").startswith(f"{name}-"))
    kind, number = F.split_part("piece", F.lit("-"), F.lit(2)), F.split_part("piece", F.lit("-"), F.lit(3)).cast("long")
    parts = parts.withColumns({"_merged": kind == "merged", "_number": number})
    upto = parts.where("_merged").groupBy(F.col("date").alias("_date")).agg(F.max("_number").alias("_upto"))
    known = parts.join(upto, F.col("date") == F.col("_date"), "left")
    return known.where(F.when(F.col("_merged"), F.col("_number") == F.col("_upto")).otherwise(F.col("_number") > F.coalesce("_upto", F.lit(-1)))).select(*GOLD_PARTS.fieldNames())


def _compact(spark: SparkSession, cfg: PipelineConfig, name: str, days: Sequence[str], batch_id: int) -> None:
    """The pieces of the days as one, and then without those that it holds."""
    merged = merged_parts(read_gold_parts(spark, cfg, name, days)).withColumn("piece", F.lit(_piece(name, "merged", batch_id)))
    overwrite_partitions(group_for_write(merged, "date"), cfg, "gold_parts")
    if cfg.is_v2:
        return
    held = F.col("piece").startswith(f"{name}-batch-") & (F.col("piece") <= _piece(name, "batch", batch_id))
    older = held | F.col("piece").startswith(f"{name}-merged-") & (F.col("piece") < _piece(name, "merged", batch_id))
    # as many as pieces were merged
    for r in read_layer(spark, cfg, "gold_parts", dates=days).where(older).select(F.col("date").cast("string").alias("date"), "piece").distinct().collect():
        spark.sql(f"ALTER TABLE {cfg.table_name('gold_parts')} DROP IF EXISTS PARTITION (date = '{r['date']}', piece = '{r['piece']}')")


def _once_each(cfg: PipelineConfig, query: str, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """`write` for micro-batches that the ledger doesn't name yet. Batches are counted per checkpoint folder."""
    place = cfg.checkpoint(query)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ensure_table(spark, cfg, "stream_batches")
        done = spark.table(cfg.table_name("stream_batches")).where((F.col("checkpoint") == place) & (F.col("batch_id") == batch_id))
        if done.isEmpty():
            write(batch, batch_id)
            entry = {"checkpoint": F.lit(place), "batch_id": F.lit(batch_id), "written_at": F.current_timestamp()}
            append(spark.range(0, 1, 1, 1).select(*[entry[f.name].cast(f.dataType).alias(f.name) for f in STREAM_BATCHES.fields]), cfg, "stream_batches")

    return run


def _each_batch(df: DataFrame, cfg: PipelineConfig, name: str, trigger: Mapping, work: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return df.writeStream.foreachBatch(work).trigger(**trigger).option("checkpointLocation", cfg.checkpoint(name)).queryName(name).start()
