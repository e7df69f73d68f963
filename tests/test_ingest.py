"""Each message in bronze once: ranges, the landing folder's positions, and runs that break off."""

import dataclasses
import json
from pathlib import Path

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tiermill.plans import ingest_bronze, run_medallion
from tiermill.plans import ingest_ledger as ledger
from tiermill.plans import jobs
from tiermill.schemas import MESSAGE
from tiermill.sources import landing, read_layer, read_message_stream
from tiermill.sources.messages import available, kafka_reads, read_ranges
from tiermill.sources.ranges import as_offsets, bounded, layers, merged, rows_of, without
from tiermill.streaming import stream_bronze

pairs = st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 30), st.integers(0, 30)).map(lambda r: (r[0], min(r[1:]), max(r[1:]))), max_size=8)


def points(ranges):
    return {(p, i) for p, a, b in rows_of(ranges) for i in range(a, b)}


@given(pairs, pairs)
def test_ranges_are_sets(one, two):
    a, b = merged(one), merged(two)
    assert points(a) == {(p, i) for p, x, y in one for i in range(x, y)}
    assert points(without(a, b)) == points(a) - points(b)
    assert points(merged(rows_of(a) + rows_of(b))) == points(a) | points(b)
    for own in (*a.values(), *without(a, b).values()):
        assert all(x < y for x, y in own) and all(y < z for (_, y), (z, _) in zip(own, own[1:], strict=False))
    assert set().union(*({(p, i) for p, (x, y) in layer.items() for i in range(x, y)} for layer in layers(a)), set()) == points(a)


def test_bounds():
    there = merged([("0", 0, 10), ("1", 5, 9)])
    assert bounded(there, {"0": 4}, {}) == {"0": [(4, 10)], "1": [(5, 9)]}
    assert bounded(there, {}, {"0": 3}) == {"0": [(0, 3)]}


def test_a_topic_is_read_range_by_range(cfg):
    kafka = dataclasses.replace(cfg, message_format="kafka", kafka_broker="b:9092")
    first, second = kafka_reads(kafka, merged([("0", 0, 5), ("0", 8, 9), ("2", 1, 4)]))
    assert json.loads(first["assign"]) == {"measurements": [0, 2]} and "subscribe" not in first
    assert json.loads(first["startingOffsets"]) == {"measurements": {"0": 0, "2": 1}}
    assert json.loads(second["endingOffsets"]) == {"measurements": {"0": 9}}
    assert available(None, kafka, None, as_offsets("measurements", {"0": 7})) == {"0": [(0, 7)]}


def test_a_topic_without_ends_cannot_be_resumed(spark, cfg):
    kafka = dataclasses.replace(cfg, message_format="kafka", kafka_broker="b:9092")
    with pytest.raises(ValueError, match="ending_offsets"):
        ingest_bronze(spark, kafka, resume=True)


# --- lines and their places


@given(st.binary(max_size=60).map(lambda b: b.replace(b"a", b"\n")), st.lists(st.integers(0, 60), max_size=3), st.sampled_from([1, 2, 7, 4 << 20]))
def test_ranges_cut_a_file_anywhere(tmp_path_factory, data, cuts, chunk):
    file = tmp_path_factory.mktemp("landing") / "f"
    file.write_bytes(data)
    landing.CHUNK_BYTES, before = chunk, landing.CHUNK_BYTES
    try:
        edges = sorted({0, len(data), *(min(c, len(data)) for c in cuts)})
        store, found = landing._folder(str(file))[0], []
        for a, b in zip(edges, edges[1:], strict=False):
            for lines, places in landing._lines(store, str(file), a, b):
                assert all(a <= p < b for p in places)
                found += zip(places, lines, strict=True)
    finally:
        landing.CHUNK_BYTES = before
    expected, at = [], 0
    for line in data.split(b"\n")[: None if not data.endswith(b"\n") and data else -1]:
        expected.append((at, line.removesuffix(b"\r")))
        at += len(line) + 1
    assert found == expected


def test_lines_as_spark_reads_them(spark, cfg, land, event):
    land(event(user="a"), "", "not json")
    land(event(user="Ünder"))
    got = read_ranges(spark, cfg, available(spark, cfg))
    assert got.schema.fieldNames() == MESSAGE.fieldNames()
    rows = got.collect()
    plain = [r.value.encode() for r in spark.read.text(cfg.message_path).collect()]
    assert sorted(bytes(r.value) for r in rows) == sorted(plain)
    assert len({(r.partition, r.offset) for r in rows}) == 4
    assert all(r.timestamp is not None and r.topic == cfg.topic for r in rows)


def test_large_files_are_read_in_pieces(spark, cfg, land, event, monkeypatch):
    land(*[event(user=f"u{i}") for i in range(300)])
    whole = available(spark, cfg)
    monkeypatch.setattr(landing, "PIECE_BYTES", 1000)
    assert len(landing._pieces(cfg.message_path, whole)) > 20
    assert read_ranges(spark, cfg, whole).count() == 300


def test_compressed_and_missing_files_are_refused(spark, cfg, tmp_path, land, event):
    land(event())
    with pytest.raises(ValueError, match="no file"):
        available(spark, cfg, as_offsets(cfg.topic, {"gone": 3}))
    (tmp_path / "x.json.gz").write_bytes(b"1")
    with pytest.raises(ValueError, match="compressed"):
        landing.files(str(tmp_path))
    assert landing.files(f"{tmp_path}/nowhere") == {}


# --- runs


@pytest.fixture
def archive(spark, cfg, event):
    """An archive of a topic, and a way to send to it: (partition, offset) pairs."""
    own = dataclasses.replace(cfg, message_format="parquet", message_path=f"{cfg.message_path}_archive")

    def send(*places):
        lines = [(None, event(user=f"u{p}-{o}").encode(), own.topic, p, o, None, 0) for p, o in places]
        spark.createDataFrame(lines, MESSAGE).write.mode("append").parquet(own.message_path)

    return own, send


def users(spark, cfg):
    return sorted(r["user_id"] for r in read_layer(spark, cfg, "bronze").collect())


def test_what_earlier_runs_left_out_is_read(spark, archive):
    """The later part first, then a piece in the middle, then everything else."""
    cfg, send = archive
    send(*[(p, o) for p in (0, 1) for o in range(20)])
    assert ingest_bronze(spark, cfg, as_offsets(cfg.topic, {"0": 12, "1": 15})).rows_out == 13
    assert ingest_bronze(spark, cfg, as_offsets(cfg.topic, {"0": 3}), as_offsets(cfg.topic, {"0": 6})).rows_out == 3
    assert ledger.covered(spark, cfg) == {"0": [(3, 6), (12, 20)], "1": [(15, 20)]}
    assert ingest_bronze(spark, cfg, resume=True).rows_out == 24
    assert ingest_bronze(spark, cfg, resume=True).rows_out == 0
    assert users(spark, cfg) == sorted(f"u{p}-{o}" for p in (0, 1) for o in range(20))
    assert ledger.covered(spark, cfg) == {"0": [(0, 20)], "1": [(0, 20)]}


class Crash(Exception):
    pass


def crash(*_, **__):
    raise Crash


@pytest.mark.parametrize("where", ["before the write", "after the write"])
def test_a_run_that_breaks_off_leaves_each_message_once(spark, archive, monkeypatch, where):
    cfg, send = archive
    send((0, 0), (0, 1), (1, 5))
    ingest_bronze(spark, cfg, resume=True)
    send((0, 2), (2, 0))
    with monkeypatch.context() as broken:
        broken.setattr(*((jobs, "write_run", crash) if where == "before the write" else (ledger, "mark_done", crash)))
        with pytest.raises(Crash):
            ingest_bronze(spark, cfg, resume=True)
    assert list(ledger.open_intents(spark, cfg).values()) == [{"0": [(2, 3)], "2": [(0, 1)]}]
    send((0, 3))
    run = ingest_bronze(spark, cfg, resume=True)
    assert run.rows_out == 1 and run.dates == ["2024-07-19"]
    assert users(spark, cfg) == ["u0-0", "u0-1", "u0-2", "u0-3", "u1-5", "u2-0"]
    assert ledger.open_intents(spark, cfg) == {} and ingest_bronze(spark, cfg, resume=True).rows_out == 0


def test_a_write_that_got_halfway_is_replaced(spark, archive, monkeypatch):
    """Some of a run's partitions are there and some are not: settling replaces them all."""
    cfg, send = archive
    send(*[(0, o) for o in range(6)])
    whole = jobs.write_run

    def half(messages, *rest):
        whole(messages.where("offset < 2"), *rest)
        raise Crash

    with monkeypatch.context() as broken:
        broken.setattr(jobs, "write_run", half)
        with pytest.raises(Crash):
            ingest_bronze(spark, cfg, resume=True)
    assert len(users(spark, cfg)) == 2
    ingest_bronze(spark, cfg, resume=True)
    assert users(spark, cfg) == [f"u0-{o}" for o in range(6)]


def test_settled_days_reach_silver_and_gold(spark, archive, monkeypatch):
    cfg, send = archive
    send((0, 0))
    with monkeypatch.context() as broken:
        broken.setattr(ledger, "mark_done", crash)
        with pytest.raises(Crash):
            run_medallion(spark, cfg, touched_only=True, resume=True)
    runs, _ = run_medallion(spark, cfg, touched_only=True, resume=True)
    assert [r.job for r in runs] == ["ingest_bronze", "bronze_to_silver", "silver_to_gold"]
    assert read_layer(spark, cfg, "gold").count() == 1


def test_a_landing_folder_is_read_on(spark, cfg, land, event):
    land(event(user="a"), event(user="b"))
    assert ingest_bronze(spark, cfg, resume=True).rows_out == 2
    assert ingest_bronze(spark, cfg, resume=True).rows_out == 0
    land(event(user="c"))
    grown = next(Path(cfg.message_path.removeprefix("file:")).glob("part-*"))
    with grown.open("a") as file:
        file.write(event(user="d") + "\n")
    (grown.parent / f".{grown.name}.crc").unlink()
    assert ingest_bronze(spark, cfg, resume=True).rows_out == 2
    assert users(spark, cfg) == ["a", "b", "c", "d"]


def test_a_plain_run_counts_as_read(spark, cfg, land, event):
    land(event(user="a"))
    assert ingest_bronze(spark, cfg).rows_out == 1
    assert ingest_bronze(spark, cfg, resume=True).rows_out == 0
    assert ingest_bronze(spark, cfg).rows_out == 1  # asked to read everything again


def test_a_stream_of_lines_with_places(spark, cfg, land, event):
    kept = dataclasses.replace(cfg, keep_lineage=True)

    def run():
        stream_bronze(read_message_stream(spark, kept, positions=True), kept).awaitTermination()
        return [(r["user_id"], r["_offset"] is not None) for r in read_layer(spark, kept, "bronze").orderBy("user_id").collect()]

    land(event(user="a"), event(user="b"))
    assert run() == [("a", True), ("b", True)]
    assert run() == [("a", True), ("b", True)]
    grown = next(Path(cfg.message_path.removeprefix("file:")).glob("part-*"))
    with grown.open("a") as file:
        file.write(event(user="c") + "\n")
    assert run() == [("a", True), ("b", True), ("c", True)]


def test_a_micro_batch_cut_off_before_its_entry_is_replaced(spark, cfg, land, event, monkeypatch):
    land(event(user="a"), event(user="b"))
    with monkeypatch.context() as broken:
        broken.setattr("tiermill.streaming.pipelines.append", crash)
        with pytest.raises(Exception):
            stream_bronze(read_message_stream(spark, cfg), cfg).awaitTermination()
    assert read_layer(spark, cfg, "bronze").count() == 2
    stream_bronze(read_message_stream(spark, cfg), cfg).awaitTermination()
    assert users(spark, cfg) == ["a", "b"]


def test_runs_are_partitions_that_readers_do_not_see(spark, cfg, land, event):
    land(event())
    ingest_bronze(spark, cfg)
    assert read_layer(spark, cfg, "bronze").columns == cfg.schema("bronze").fieldNames()
    assert spark.table(cfg.table_name("bronze")).where(F.col("ingest_run").isNotNull()).count() == 1
