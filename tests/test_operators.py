"""Hand-worked cases and properties of the library's own operators."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from cuesheet.functions import numbers, quality, text
from cuesheet.operators import align, candidates, crops, frame_ocr, frames, images, report, scan, segments, settings, tuning, windows
from cuesheet.sources import events, providers, showinfo, sinks

FRAMES = "video_id long, seq long, timestamp double, frame_path string, ocr_provider string, quality_score double, ocr_text string, avg_conf double"
SEGMENTS = "video_id long, seq long, start double, end double, speaker string, text string, asr_provider string"


def times(spark, *ts):
    return spark.createDataFrame([(1, i, float(t)) for i, t in enumerate(ts)], "video_id long, seq long, timestamp double")


def values(df, *columns):
    return sorted(tuple(x) if len(x) > 1 else x[0] for x in df.select(*columns).collect())


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def frame(seq, ts, q=1.0, **more):
    return (1, seq, float(ts), f"f{seq}", "tesseract", q, more.get("text", ""), more.get("conf"))


def segment(seq, a, b, speaker="A", said="x"):
    return (1, seq, float(a), float(b), speaker, said, "whisper")


def video(spark, duration):
    return spark.createDataFrame([(1, float(duration))], "video_id long, duration double")


def test_merging_compares_with_the_last_kept(spark):
    assert values(scan.keep_spaced(times(spark, 0, 0.15, 0.3), 0.2), "timestamp") == [0.0, 0.3]
    assert values(scan.keep_spaced(times(spark, 0, 2, 4), 2), "timestamp") == [0.0, 4.0]
    assert values(frames.merge_legacy(times(spark, 0, 2, 4), 2), "timestamp") == [0.0, 2.0, 4.0]


def test_merging_leaves_no_close_points(spark):
    rng = random.Random(3)
    rows = [(v, i, round(rng.random() * 20, 2)) for v in range(5) for i in range(200)]
    kept = frames.merge_entries(spark.createDataFrame(rows, "video_id long, seq long, timestamp double"), 0.5)
    for v in range(5):
        own = [x["timestamp"] for x in kept.filter(f"video_id = {v}").orderBy("original_index").collect()]
        assert all(b - a > 0.5 for a, b in zip(own, own[1:]))
        expected = []
        for t in sorted(x[2] for x in rows if x[0] == v):
            if not expected or t - expected[-1] > 0.5:
                expected.append(t)
        assert own == expected


def test_anchors_and_gap_fill(spark):
    assert values(frames.required_anchors(times(spark, 0.1, 5), video(spark, 10)), "timestamp") == [9.5]
    none = times(spark, 1).filter("false")
    assert values(frames.gap_fill(none, video(spark, 40.5), 15.0), "timestamp") == [15.0, 30.0]
    assert values(frames.gap_fill(none, video(spark, 40.5), 15.0, ends=False), "timestamp") == [0.0]
    assert frames.gap_fill(none, video(spark, 40.5), 0).count() == 0


def test_windows_edges(spark):
    segs = spark.createDataFrame([segment(0, 45, 45), segment(1, 50, 50, None, " hi "), segment(2, 0, 45)], SEGMENTS)
    assert values(windows.segment_members(segs), "seq", "window_ix") == [(1, 1), (2, 0)]
    out = windows.build_windows(segs.filter("seq = 0"), spark.createDataFrame([frame(0, 50)], FRAMES))
    row = out.collect()
    assert len(row) == 1 and (row[0]["window_start"], row[0]["window_end"]) == (45.0, 90.0)
    assert row[0]["segments"] is None and len(row[0]["frames"]) == 1 and row[0]["key_frame"]["seq"] == 0
    assert windows.build_windows(segs.filter("false"), spark.createDataFrame([frame(0, 0)], FRAMES)).count() == 0
    with pytest.raises(ValueError):
        windows.segment_members(segs, 0)


def test_as_of_and_nearest(spark):
    seg = spark.createDataFrame([segment(0, 4, 6)], SEGMENTS)
    own = spark.createDataFrame([frame(0, 3), frame(1, 5), frame(2, 7)], FRAMES)
    row = align.prev_next(seg, own).first()
    assert (row["prev"]["timestamp"], row["next"]["timestamp"]) == (3.0, 5.0)
    row = align.nearest(seg, own.filter("seq <> 1")).first()
    assert row["frame"]["timestamp"] == 3.0 and row["score"] == pytest.approx(0.8)
    assert align.nearest(seg, own.filter("seq <> 1"), 1.0).first()["frame"] is None


def test_attach_score(spark):
    score = lambda ts, q: one(spark, align.attach_score(F.lit(0.0), F.lit(10.0), F.lit(float(ts)), F.lit(q), 10.0))
    assert score(5, 1.0) == pytest.approx(1.0)
    assert score(15, 0.0) == pytest.approx(0.25)


def test_every_segment_has_a_row_and_k_candidates_at_most(spark):
    rng = random.Random(1)
    segs = spark.createDataFrame([segment(i, a := rng.random() * 200, a + rng.random() * 9) for i in range(60)], SEGMENTS)
    own = spark.createDataFrame([frame(i, rng.random() * 120, rng.random()) for i in range(80)], FRAMES)
    out = align.build_dataset(segs, own, 5.0, 2).collect()
    assert len(out) == 60
    for x in out:
        assert len(x["frame_candidates"]) <= 2
        assert (x["attach_reason"] == "candidate_attached") == bool(x["frame_candidates"])
        if x["frame_candidates"]:
            assert x["frame_candidates"][0]["frame_path"] == x["frame_path"] and x["frame_candidates"][0]["attach_score"] == x["attach_score"]
    assert align.build_dataset(segs, own, mode="nearest").count() == 60
    with pytest.raises(ValueError):
        align.build_dataset(segs, own, mode="else")


def test_p95_and_coverage(spark):
    segs = spark.createDataFrame([segment(i, 0, i + 1) for i in range(10)], SEGMENTS)
    assert report.p95_durations(segs).first()["p95_segment_duration_sec"] == 9.0
    row = report.coverage(times(spark, 10, 50), video(spark, 100)).first()
    assert (row["max_gap_sec"], row["tail_gap_sec"]) == (50.0, 50.0)
    row = report.coverage(times(spark, 10).filter("false"), video(spark, 100)).first()
    assert (row["max_gap_sec"], row["tail_gap_sec"]) == (100.0, 100.0)


def test_gates_can_be_enforced(spark):
    columns = ", ".join(f"{name} double" for name, _, _ in report.GATES)
    good = spark.createDataFrame([(1, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0)], f"video_id long, {columns}")
    report.enforce(report.evaluate_gates(good))
    with pytest.raises(ValueError, match="attach_rate"):
        report.enforce(report.evaluate_gates(good.withColumn("attach_rate", F.lit(0.1))))


def test_text_functions(spark):
    tokens = F.array(*map(F.lit, ["Hello", ",", "(", "world", ")", "!", " "]))
    assert one(spark, text.join_tokens(tokens)) == "Hello, (world)!"
    assert one(spark, text.srt_stamp(F.lit(3723.004))) == "01:02:03,004"
    assert one(spark, text.file_stamp(F.lit(3.5))) == "000003.500"
    assert [one(spark, text.speaker_label(F.lit(x))) for x in ("0", "1", "26", "a", " ")] == ["A", "B", "S26", "A", None]
    assert one(spark, text.speaker_label(F.lit("A"), "numeric")) == "1"
    assert one(spark, text.compact(F.lit(" a  b\n"))) == "a b"
    assert one(spark, numbers.ms_to_seconds(F.lit("x"))) == 0.0
    crops_ = F.array(F.struct(F.lit("FULL").alias("name"), F.lit(" a ").alias("text")), F.struct(F.lit("TOP").alias("name"), F.lit("").alias("text")))
    assert one(spark, text.labelled_text(crops_)) == "[FULL]\na"
    assert one(spark, text.str2bool(F.lit(" Yes "))) is True
    with pytest.raises(Exception, match="not a switch"):
        one(spark, text.str2bool(F.lit("maybe")))


def test_quality_of_empty_and_plain_text(spark):
    rows = quality.with_quality(spark.createDataFrame([("", None), ("A plain line of words.", 95.0), (None, 10.0)], "text string, avg_conf double")).collect()
    assert rows[0]["quality_score"] == 0.0 and rows[0]["quality_flags"] == ["low_confidence", "low_lexicality", "garble_like"]
    assert rows[1]["quality_flags"] == [] and rows[1]["quality_metrics"]["word_count"] == 5
    assert rows[2]["quality_score"] == 0.0
    odd = "a, 12345 x-y ab.c internationalisation internationalisation, snake_case_that_is_long_indeed (ok) ... élan"
    m = quality.with_quality(spark.createDataFrame([(odd, 50.0)], "text string, avg_conf double")).first()["quality_metrics"]
    # Weird: "a,", "12345", "(ok)" and "..."; joined: the two long words.
    assert (m["token_count"], m["weird_token_ratio"], m["long_joined_ratio"]) == (10, 0.4, 0.2)


def words(spark, *items):
    return spark.createDataFrame([(1, 1, i, float(a), float(b), w) for i, (w, a, b) in enumerate(items)], "video_id long, utterance_id int, word_ix long, start double, end double, text string")


def test_splitting_at_silence_punctuation_and_length(spark):
    own = words(spark, ("a", 0, 1), ("b.", 1, 2), ("c", 2, 3), ("d", 4, 5), ("e", 5, 9), ("f", 9, 10))
    got = [(x["text"], x["split_reason"]) for x in segments.split_words(own, 5.0, 0.6).orderBy("chunk").collect()]
    assert got == [("a b.", "punctuation"), ("c", "silence_gap"), ("d", "max_duration"), ("e", "max_duration"), ("f", "tail")]


def test_merging_short_segments(spark):
    segs = spark.createDataFrame([(1, 0, 0.0, 1.0, "A", "a", "tail"), (1, 1, 1.0, 2.0, "A", "b", "tail"), (1, 2, 2.0, 3.0, None, "c", "tail"), (1, 3, 3.0, 4.0, None, "d", "tail"), (1, 4, 4.0, 9.0, None, "e", "tail")], "video_id long, seq long, start double, end double, speaker string, text string, split_reason string")
    got = [(x["text"], x["end"], x["split_reason"]) for x in segments.merge_short(segs, ["seq"]).orderBy("seq").collect()]
    assert got == [("a b", 2.0, "tail+merged_short"), ("c d", 4.0, "tail+merged_short"), ("e", 9.0, "tail")]


def test_utterances_without_words_stay(spark):
    said = segments.normalise_utterances(spark.createDataFrame([(1, 0, 0.0, 5.0, " one ", "A", 0.91239), (1, 1, 5.0, 6.0, "  ", "A", None), (1, 2, 6.0, 9.0, "two", "B", None)], "video_id long, seq long, start double, end double, text string, speaker string, confidence double"))
    assert values(said, "utterance_id") == [1, 2]
    out = segments.refine_segments(said, words(spark, ("hey", 0, 5)))
    assert values(out, "segment_id", "text", "split_reason") == [(1, "hey", "tail"), (2, "two", "utterance_fallback")]


def hashes(spark, *items):
    return spark.createDataFrame([(1, i, float(t), f"f{i}", None if h is None else 0, h) for i, (t, h) in enumerate(items)], "video_id long, seq long, timestamp double, frame_path string, hash_hi long, hash_lo long")


def test_near_duplicates_of_frames(spark):
    own = hashes(spark, (0, 0), (1, 1), (2, 3), (2.5, None), (5, 1))
    got = scan.suppress_near_duplicates(own, 2.0, 1).orderBy("seq").collect()
    # The frame at 2 differs in two bits from the one kept at 0, and the dropped one at 1 is compared with no other.
    assert [(x["status"], x["duplicate_of"]) for x in got] == [("kept", None), ("dropped", "f0"), ("kept", None), ("kept", None), ("kept", None)]
    got = scan.suppress_near_duplicates(own, 2.0, 1, delta=lambda row, kept: 0.5).orderBy("seq").collect()
    assert got[1]["drop_blocked_reason"] == "transition_preserved" and got[1]["status"] == "kept"


def test_crops_and_candidates(spark):
    image = spark.createDataFrame([(100, 50)], "width int, height int")
    assert [x["name"] for x in crops.crop_boxes(image, "none", ["1,2,3,4", "200,0,300,9"]).collect()] == ["FULL", "MANUAL_01", "MANUAL_02"]  # the second is clipped to a column
    with pytest.raises(Exception, match="no box"):
        crops.crop_boxes(image, "none", ["4,2,3,4"]).collect()
    with pytest.raises(ValueError):
        crops.crop_boxes(image, "else")
    two = spark.createDataFrame([(1, 0, 0.5, "ab", None), (1, 1, 0.5, "ab", 0.0), (1, 2, 0.5, "abc", None)], "k int, seq int, quality_score double, text string, avg_conf double")
    assert candidates.best_candidate(two, ["k"]).first()["seq"] == 2
    assert candidates.best_candidate(two.filter("seq < 2"), ["k"]).first()["seq"] == 0
    pages = F.from_json(F.lit('[{"confidence":0.5,"blocks":[{"confidence":null,"paragraphs":[{"confidence":0.9,"words":[{"confidence":-1,"symbols":[{"confidence":70}]}]}]}]}]'), "array<struct<confidence:double,blocks:array<struct<confidence:double,paragraphs:array<struct<confidence:double,words:array<struct<confidence:double,symbols:array<struct<confidence:double>>>>>>>>>>")
    assert one(spark, candidates.flatten_pages(pages)) == pytest.approx(70.0)


def test_tuning(spark):
    probe = spark.createDataFrame([(1, 100.0, 700, 7.0, 50.0), (2, 2000.0, 1080, 1.0, 200.0)], "video_id long, duration double, height int, scene_changes_per_minute double, avg_text_length double")
    a, b = tuning.tune(probe).orderBy("video_id").collect()
    assert (a["periodic_interval_seconds"], a["ocr_scale"], a["ocr_crops"], a["dedupe_hash_threshold"], a["frame_reason"]) == (5.0, 3.0, "none", 5, "high scene rate (7.0/min)")
    assert (b["periodic_interval_seconds"], b["ocr_scale"], b["ocr_crops"], b["dedupe_hash_threshold"]) == (20.0, 2.0, "preset", 8)


def test_event_logs(spark, tmp_path):
    lines = ['{"time":"1.2346","type":" CLICK ","x":1}', "", '{"ts":3,"event":"hover"}', '{"ts":0.5,"event":"","type":"key","payload":"{\\"a\\": 2}"}', '{"ts":2,"type":"scroll","payload":" far "}', '{"ts":4,"type":"key","payload":7}']
    path = tmp_path / "log.jsonl"
    path.write_text("\n" + "\n".join(lines))
    got = [(x["event_id"], x["timestamp"], x["event_type"], json.loads(x["payload"])) for x in events.read_events(spark, str(path)).collect()]
    assert got == [(4, 0.5, "key", {"a": 2}), (1, 1.235, "click", {"x": 1}), (5, 2.0, "scroll", {"raw": "far"}), (6, 4.0, "key", {"raw": "7"})]
    bad = tmp_path / "log.txt"
    bad.write_text(lines[0] + "\nnot json\n" + lines[3])
    assert [x["event_id"] for x in events.read_events(spark, str(bad)).collect()] == [3, 1]
    strict = tmp_path / "bad.ndjson"
    strict.write_text("not json")
    with pytest.raises(Exception):
        events.read_events(spark, str(strict)).collect()
    doc = tmp_path / "log.json"
    doc.write_text(json.dumps({"events": [json.loads(lines[0]), {"ts": 9, "type": "key"}]}))
    assert [(x["event_id"], x["timestamp"]) for x in events.read_events(spark, str(doc)).collect()] == [(1, 1.235), (2, 9.0)]
    table = tmp_path / "log.csv"
    table.write_text("ts,event,payload,extra\n2,click,,z\n1,key,raw text,z\nx,key,,z\n")
    assert [(x["event_id"], x["timestamp"], json.loads(x["payload"])) for x in events.read_events(spark, str(table)).collect()] == [(2, 1.0, {"raw": "raw text"}), (1, 2.0, {})]
    empty = tmp_path / "none.jsonl"
    empty.write_text("")
    assert events.read_events(spark, str(empty)).count() == 0


def test_showinfo_log(spark, tmp_path):
    path = tmp_path / "err.log"
    path.write_text("showinfo pts_time:1.5\nother pts_time:2\nshowinfo pts_time:-\n")
    assert values(showinfo.read_log(spark, str(path)), "pts") == [1.5]


def test_sinks(spark, tmp_path):
    segs = spark.createDataFrame([segment(1, 1, 2, said=" b "), segment(0, 0, 1.5, said="a")], SEGMENTS)
    sinks.write_srt(segs, ["seq"], str(tmp_path / "srt"))
    files = list((tmp_path / "srt" / "video_id=1").glob("*.txt"))
    assert "".join(x.read_text() for x in files) == "1\n00:00:00,000 --> 00:00:01,500\na\n\n2\n00:00:01,000 --> 00:00:02,000\nb\n\n"
    nested = spark.range(1).select(F.lit("/d/a.png").alias("raw_path"), F.lit("/d/b.png").alias("duplicate_of"), F.array(F.struct(F.lit("/d/c.png").alias("x_path"))).alias("items"))
    row = sinks.relativize(nested, "/d").first()
    assert (row["raw_path"], row["duplicate_of"], row["items"][0]["x_path"]) == ("a.png", "/d/b.png", "c.png")
    sinks.write_json(segs, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2


def test_subtitles_of_many_recordings_are_in_few_folders(spark, tmp_path):
    segs = spark.createDataFrame([(v, k, float(k), k + 0.5, "A", f"{v} {k}", "whisper") for v in range(40) for k in (1, 0)], SEGMENTS)
    path = tmp_path / "srt"
    sinks.write_srt(segs, ["seq"], str(path), shards=3)
    folders = {x.name for x in path.iterdir() if x.is_dir()}
    assert folders == {"shard=0", "shard=1", "shard=2"}
    assert sorted(len(list(x.glob("*.txt"))) for x in path.glob("shard=*/video_id=*")) == [1] * 40
    want = [(v, "".join(f"{k + 1}\n00:00:0{k},000 --> 00:00:0{k},500\n{v} {k}\n\n" for k in range(2))) for v in range(40)]
    assert values(sinks.read_srt(spark, str(path)), "video_id", "content") == want


def test_providers(spark):
    requests = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    a = providers.precomputed("a", spark.createDataFrame([(1, "x", None), (2, "y", "failed")], "k int, text string, error string"), ["k"])
    b = providers.precomputed("b", spark.createDataFrame([(2, "z")], "k int, text string"), ["k"])
    out = providers.ask_in_turn(requests, a, b, lambda: F.col("error").isNotNull())
    assert values(out, "k", "asked") == [(1, "a"), (2, "a"), (2, "b"), (3, "a"), (3, "b")]
    assert values(out.filter("error is null"), "k", "text") == [(1, "x"), (2, "z")]


def test_images(spark):

    drawn = images.drawn(spark.createDataFrame([(3, 1), (3, 1), (4, 2)], "vec_id long, seq long"))
    hashed = images.with_phash(drawn).collect()
    assert hashed[0]["phash_hex"] == hashed[1]["phash_hex"] != hashed[2]["phash_hex"]
    broken = spark.createDataFrame([((4, 4, b"x"),)], "image struct<height:int,width:int,data:binary>")
    row = images.with_phash(broken).first()
    assert row["hash_hi"] is None and row["phash_error"]
    got = drawn.select(images.preprocessed(F.col("image"), mode="otsu").alias("p"), images.delta_ratio(F.col("image"), F.col("image")).alias("d"), images.variants(F.col("image")).alias("v")).first()
    assert (got["p"]["height"], got["p"]["width"], got["d"]) == (96, 128, 0.0) and set(got["p"]["data"]) <= {0, 255} and len(got["v"]["a"]) == 48 * 64


def test_backfill_leaves_no_large_gap(spark):
    kept = hashes(spark, (0, 0), (30, 1)).withColumn("status", F.lit("kept"))
    fetch = lambda p: p.select("video_id", F.lit(0).cast("long").alias("seq"), "timestamp", F.lit("new").alias("frame_path"), F.lit(0).cast("long").alias("hash_hi"), F.round(F.col("timestamp") * 1001).cast("long").alias("hash_lo"))
    suppress = lambda x: scan.suppress_near_duplicates(x.drop("status"), 2.0, 0)
    out = frames.backfill(kept, video(spark, 30.5), fetch, suppress, 10.0)
    assert values(out.filter("status = 'kept'"), "timestamp") == [0.0, 10.0, 20.0, 30.0]


def test_backfill_works_out_what_it_is_given_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    given = hashes(spark, (0, 0), (30, 1)).withColumn("status", F.lit("kept"))
    kept = given.mapInArrow(count, given.schema)
    fetch = lambda p: p.select("video_id", F.lit(0).cast("long").alias("seq"), "timestamp", F.lit("new").alias("frame_path"), F.lit(0).cast("long").alias("hash_hi"), F.round(F.col("timestamp") * 1001).cast("long").alias("hash_lo"))
    suppress = lambda x: scan.suppress_near_duplicates(x.drop("status"), 2.0, 0)
    out = frames.backfill(kept, video(spark, 30.5), fetch, suppress, 10.0)
    assert values(out.filter("status = 'kept'"), "timestamp") == [0.0, 10.0, 20.0, 30.0]
    assert seen.value == 2


def test_short_recordings_are_spaced_as_long_ones(spark):
    rng = random.Random(11)
    rows = [(rng.randrange(3), round(rng.random() * 40, 1) if rng.random() < 0.95 else rng.choice([None, float("nan")]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "video_id long, timestamp double, seq long")
    for epsilon, strict in ((0.2, True), (0.5, False), (0.0, True)):
        long, short = (sorted(map(tuple, scan.keep_spaced(df, epsilon, strict=strict, short=x).collect())) for x in (False, True))
        assert long == short and 0 < len(short) < 400
    long, short = (frames.merge_entries(df, 0.3, x) for x in (False, True))
    assert long.schema["original_index"].dataType == short.schema["original_index"].dataType
    assert sorted(map(tuple, long.select("seq", "original_index").collect())) == sorted(map(tuple, short.select("seq", "original_index").collect()))


def test_a_long_recording_is_cut_into_buckets(spark):
    rng = random.Random(6)
    frames_ = [frame(i, round(rng.random() * 900, 1)) for i in range(60)] + [frame(100, 0.0), frame(101, 899.9), frame(102, 450.0), frame(103, 450.0)]
    segments_ = [segment(i, a := round(rng.random() * 1000, 1), a + 3) for i in range(80)] + [segment(200, 449.0, 451.0), segment(201, 2000.0, 2001.0)]
    own, seg = spark.createDataFrame(frames_, FRAMES), spark.createDataFrame(segments_, SEGMENTS)
    for bucket in (1.0, 37.0, 300.0):
        for x in align.prev_next(seg, own, bucket).collect():
            middle = (x["start"] + x["end"]) / 2
            before = max(((f[2], f[1]) for f in frames_ if f[2] < middle), default=None)
            after = min(((f[2], f[1]) for f in frames_ if f[2] >= middle), default=None)
            assert (x["prev"] and (x["prev"]["timestamp"], x["prev"]["seq"])) == before
            assert (x["next"] and (x["next"]["timestamp"], x["next"]["seq"])) == after


def test_rows_are_numbered_in_order_and_as_read(spark, tmp_path):
    ids = random.Random(2).sample(range(-500, 5000), 300)
    got = values(scan.numbered(spark.createDataFrame([(x,) for x in ids], "id long").repartition(5), "id", 97, "k"), "k", "id")
    assert got == list(enumerate(sorted(ids), 1))
    (tmp_path / "log.txt").write_text("".join(f"line {i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = spark.read.text(str(tmp_path / "log.txt"))
        assert lines.rdd.getNumPartitions() > 3
        assert values(scan.numbered_as_read(lines, "k"), "k", "value") == [(i + 1, f"line {i}") for i in range(5000)]
        many = tmp_path / "many.jsonl"
        many.write_text("\n \n" + "".join(f'{{"ts": {i}, "type": "click"}}\n' for i in range(3000)))
        assert [(x["event_id"], x["timestamp"]) for x in events.read_events(spark, str(many)).collect()] == [(i + 1, float(i)) for i in range(3000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_images_are_written_and_read_back(spark, tmp_path):
    made = images.drawn(spark.createDataFrame([(1, 0.5, 3, 1), (1, 12.25, 4, 2), (2, 0.5, 5, 3)], "video_id long, timestamp double, vec_id long, seq long"))
    folder = tmp_path.as_uri()
    paths = values(images.write_images(made, folder), "processed_path")
    assert [x.removeprefix(folder) for x in paths] == ["/1/frame_000000.500.png", "/1/frame_000012.250.png", "/2/frame_000000.500.png"]
    values(images.write_images(made, folder), "processed_path")  # again, over those that are there
    back = images.read_images(spark, f"{tmp_path}/1").select("path", "image.*").collect()
    want = {bytes(x["data"]) for x in made.filter("video_id = 1").select("image.data").collect()}
    assert {bytes(x["data"]) for x in back} == want and {(x["height"], x["width"]) for x in back} == {images.DRAWN}


def test_frames_without_answers_for_a_pass(spark):
    shape = "video_id long, seq long, name string, box struct<x1: int, y1: int, x2: int, y2: int>, place int, psm int, text string, avg_conf double"
    answers = spark.createDataFrame([(1, 1, "FULL", None, 1, 11, "only the second", 50.0), (1, 1, "TOP", None, 2, 6, " ", None), (1, 2, "FULL", None, 1, 6, None, None)], shape)
    got = {x["seq"]: x for x in frame_ocr.frame_records(answers, 6).collect()}
    assert got[1]["ocr"]["full_text"] == "[FULL]\nonly the second" and got[1]["ocr"]["avg_conf"] == 50.0 and got[1]["ocr"]["crops"][0]["psm_used"] == 11
    assert got[2]["ocr"]["full_text"] == "" and got[2]["ocr"]["avg_conf"] is None and got[2]["quality_score"] == 0.0
    assert got[1]["provider_candidates"][0]["provider"] == "tesseract" and not got[1]["fallback_used"]


def test_settings_are_checked(spark):
    runs = spark.createDataFrame([(1, None, None)], "video_id int, profile string, align_mode string")
    row = settings.effective_settings(runs).first()
    assert (row["profile"], row["ocr_provider"], row["align_mode"], row["window_seconds"]) == ("quality_first", "google", "overlap_topk", 45.0)
    with pytest.raises(Exception, match="not a value of align_mode"):
        settings.effective_settings(runs.fillna("sideways", ["align_mode"])).collect()


def test_json_is_written_and_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "é")], "id long, text string")
    sinks.write_json(df, str(tmp_path / "out"))
    assert {(x["id"], x["text"]) for x in sinks.read_json(spark, str(tmp_path / "out")).collect()} == {(1, None), (2, "é")}
    (tmp_path / "doc.json").write_text('[\n {"a": 1},\n {"a": 2}\n]')
    assert values(sinks.read_json(spark, str(tmp_path / "doc.json"), lines=False), "a") == [1, 2]


def test_a_recording_without_text_gets_one_segment(spark):
    videos = spark.createDataFrame([(1, 10.0), (2, 20.0)], "video_id long, duration double")
    own = spark.createDataFrame([segment(0, 0, 1)], SEGMENTS)
    said = spark.createDataFrame([(1, "a"), (2, "b")], "video_id long, text string")
    assert values(providers.fallback_segments(videos, own, said), "video_id", "start", "end", "text", "split_reason") == [(2, 0.0, 20.0, "b", "global_fallback")]
