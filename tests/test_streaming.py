from __future__ import annotations

import random
import shutil

import pytest
from pyspark.sql import functions as F

from cuesheet.operators.scan import suppress_near_duplicates
from cuesheet.operators.windows import build_windows
from cuesheet.streaming.dedupe import streaming_suppress
from cuesheet.streaming.windows import streaming_build_windows, streaming_windows


def run(spark, stream, name, tmp_path):
    query = stream.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / f"{name}-state")).outputMode("append").start()
    query.processAllAvailable()
    return query


def test_windows_close_with_the_watermark(spark, tmp_path):
    schema = "video_id long, at timestamp, kind string"
    rows = [(1, 0, "frame"), (1, 44, "event"), (1, 45, "frame"), (1, 300, "frame"), (1, 10, "event")]
    table = spark.createDataFrame(rows, "video_id long, s long, kind string").select("video_id", F.timestamp_seconds("s").alias("at"), "kind")
    for i, part in enumerate((table.limit(4), table.filter("kind = 'event' and at = timestamp_seconds(10)"), table.filter("at = timestamp_seconds(300)"))):
        part.coalesce(1).write.parquet(str(tmp_path / f"part{i}"))
    source = tmp_path / "in"
    source.mkdir()
    stream = spark.readStream.schema(schema).parquet(str(source))
    query = run(spark, streaming_windows(stream), "w", tmp_path)
    for i in range(3):
        for file in (tmp_path / f"part{i}").glob("*.parquet"):
            shutil.copy(file, source / f"{i}-{file.name}")
        query.processAllAvailable()
    query.stop()
    got = {(x["window_start"].second + 60 * x["window_start"].minute, x["kind"], x["n"]) for x in spark.sql("select * from w").collect()}
    # The event at 10 came after the watermark had passed its window.
    assert got == {(0, "frame", 1), (0, "event", 1), (45, "frame", 1)}


def feed(spark, tables, source, tmp_path):
    """Puts tables into the folder source one after another, each as a file of its own; yields after each."""
    source.mkdir()
    for i, table in enumerate(tables):
        table.coalesce(1).write.parquet(str(tmp_path / f"{source.name}{i}"))
        for file in (tmp_path / f"{source.name}{i}").glob("*.parquet"):
            shutil.copy(file, source / f"{i}-{file.name}")
        yield


@pytest.fixture
def rocksdb(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.set(key, old)


@pytest.mark.parametrize("delta", [False, True])
def test_suppression_is_the_batch_form(spark, tmp_path, rocksdb, delta):
    rng = random.Random(3)
    rows = [(v, i, i * 0.7, f"f{i}", None if i % 13 == 5 else 0, (i * 5 + v) % 16, float(i % 4 == 0)) for v in range(3) for i in range(40)]
    schema = "video_id long, seq long, timestamp double, frame_path string, hash_hi long, hash_lo long, level double"
    # Rows come out of order, no more than 10 seconds late; the last one moves the watermark past all others.
    rows.sort(key=lambda x: x[2] + rng.uniform(0, 9))
    last = [(9, 0, 1000.0, "end", 0, 0, 0.0)]
    parts = [rows[:50], rows[50:90], rows[90:], last, [(9, 1, 2000.0, "end", 0, 0, 0.0)]]
    tables = [spark.createDataFrame(x, schema) for x in [*parts, [(0, 99, 1.0, "late", 0, 0, 0.0)], [(9, 2, 3000.0, "end", 0, 0, 0.0)]]]
    more = {"delta": lambda row, kept: abs(row["level"] - kept["level"])} if delta else {}
    columns = ["video_id", "seq", "timestamp", "frame_path", "status", "duplicate_of", "hash_distance", "drop_blocked_reason", "candidate_delta_ratio"]
    query = None
    for _ in feed(spark, tables, tmp_path / "in", tmp_path):
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        query = query or run(spark, streaming_suppress(stream, 3.0, 1, late="10 seconds", delta_columns="level double" if delta else "", **more), f"s{delta}", tmp_path)
        query.processAllAvailable()
    progress = query.lastProgress["stateOperators"][0]
    query.stop()
    whole = spark.createDataFrame(rows, schema)
    want = suppress_near_duplicates(whole, 3.0, 1, **(more | {"delta_columns": ("level",)} if delta else {})).select(*columns).collect()
    got = [tuple(x) for x in spark.sql(f"select * from s{delta}").select(*columns).collect()]
    # The late frame is not there, and the state of the recordings that ended is empty.
    assert sorted((x for x in got if x[0] < 9), key=repr) == sorted(map(tuple, want), key=repr)
    assert {x[3] for x in got if x[0] == 9} == {"end"}
    assert progress["numRowsTotal"] <= 6


def test_windows_have_their_intervals(spark, tmp_path):
    segments = spark.createDataFrame([(1, 0, 1.0, 50.0, "A", " hello ", "w"), (1, 1, 50.0, 140.0, "B", "over three windows", "w"), (2, 0, 10.0, 20.0, None, "", "x"), (9, 0, 2000.0, 2001.0, "Z", "end", "w")], "video_id long, seq long, start double, end double, speaker string, text string, asr_provider string")
    frames = spark.createDataFrame([(1, 0, 0.0, "a", "text", 1.0, "t", 0.5), (1, 1, 44.999, "b", "text", 2.0, "g", 0.5), (1, 2, 45.0, "c", "", None, "t", None), (2, 3, 12.0, "d", None, None, None, 0.1), (9, 4, 2000.0, "z", "", None, "t", 0.0)], "video_id long, seq long, timestamp double, frame_path string, ocr_text string, avg_conf double, ocr_provider string, quality_score double")
    events = spark.createDataFrame([(1, 0, 46.0, "click", "{}"), (1, 1, 134.0, "key", "{}"), (9, 2, 2000.0, "click", "{}")], "video_id long, seq long, timestamp double, event_type string, payload string")
    feeds = {"segments": segments, "frames": frames, "events": events}
    parts = [feed(spark, [x.filter("video_id < 9"), x.filter("video_id = 9"), x.filter("video_id = 9")], tmp_path / name, tmp_path) for name, x in feeds.items()]
    query = None
    for _ in zip(*parts):
        streams = [spark.readStream.schema(x.schema).parquet(str(tmp_path / name)) for name, x in feeds.items()]
        query = query or run(spark, streaming_build_windows(*streams, late="2 minutes"), "whole", tmp_path)
        query.processAllAvailable()
    query.stop()
    got = spark.sql("select * from whole")
    want = build_windows(*(x.filter("video_id < 9") for x in (segments, frames, events)))
    shape = ["video_id", "window_ix", "window_start", "window_end", "transcript_text", F.array_join("speakers_present", ",").alias("sp"), F.array_join("asr_providers", ",").alias("ap"), F.array_join("ocr_providers", ",").alias("op"), F.coalesce("key_frame.seq", F.lit(-1)).alias("key")]
    lists = [F.transform(F.coalesce(x, F.array().cast(got.schema[x].dataType)), lambda y: y["seq"]).alias(x) for x in feeds]
    rows = lambda df: sorted(map(tuple, df.select(*shape, *lists).collect()), key=repr)
    assert rows(got) == rows(want) and got.count() == 5
