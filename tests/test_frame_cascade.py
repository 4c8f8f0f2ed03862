"""Providers asked in turn for the boxes of frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from cuesheet.operators import frame_cascade as fc
from cuesheet.operators import report

GOOD = "A clear line of plain words, well read. And another one, as good as the first."
SCHEMA = "video_id long, seq long, name string, place int, box struct<x1:int,y1:int,x2:int,y2:int>"
BOX = (0, 0, 9, 9)


def stages(spark, asked: dict, answers: dict) -> list[fc.Stage]:
    """Stages that count what they are asked. answers: (variant, seq, name) -> (text, avg_conf, error)."""

    def of(variant: str):
        counter = asked[variant] = spark.sparkContext.accumulator(0)

        def map_rows(batches):
            for batch in batches:
                counter.add(len(batch))
                yield batch

        known = spark.createDataFrame([(s, n, *x) for (v, s, n), x in answers.items() if v == variant], "seq long, name string, text string, avg_conf double, error string")
        return lambda df: df.mapInPandas(map_rows, df.schema).join(F.broadcast(known), ["seq", "name"], "left").withColumn("meta", F.lit("m") if variant == "z" else F.lit(None).cast("string"))

    return [fc.Stage("google", "a", of("a")), fc.Stage("google", "b", of("b")), fc.Stage("azure", "z", of("z"), fallback=True)]


def test_only_weak_boxes_are_asked_on(spark):
    requests = spark.createDataFrame([(1, s, n, p, BOX) for s in (1, 2, 3) for p, n in ((1, "FULL"), (2, "TOP"))], SCHEMA)
    answers = {
        ("a", 1, "FULL"): (GOOD, 95.0, None), ("a", 1, "TOP"): ("@@ ##", 5.0, None), ("b", 1, "TOP"): (GOOD, 90.0, None),
        ("a", 2, "FULL"): (GOOD, 95.0, "late"), ("b", 2, "FULL"): ("", None, "gone"), ("z", 2, "FULL"): ("", None, "throttled"),
        ("a", 2, "TOP"): ("", None, None), ("b", 2, "TOP"): ("", None, "gone"), ("z", 2, "TOP"): (GOOD, 80.0, None),
        ("a", 3, "FULL"): (None, None, None), ("b", 3, "FULL"): (None, None, None), ("z", 3, "FULL"): (None, None, None),
        ("a", 3, "TOP"): (GOOD, 95.0, None),
    }
    asked: dict = {}
    boxes = fc.cascade_boxes(requests, stages(spark, asked, answers))
    got = {(x["seq"], x["name"]): ([y["variant"] for y in x["candidates"]], x["best"]["variant"], x["fallback_used"]) for x in boxes.collect()}
    assert got == {
        (1, "FULL"): (["a"], "a", False), (1, "TOP"): (["a", "b"], "b", False), (2, "FULL"): (["a", "b", "z"], "a", False),
        (2, "TOP"): (["a", "b", "z"], "z", True), (3, "FULL"): (["a", "b", "z"], "a", False), (3, "TOP"): (["a"], "a", False),
    }
    # Answers were stored: reading the result again asked nobody again.
    assert boxes.count() == 6 and {k: v.value for k, v in asked.items()} == {"a": 6, "b": 4, "z": 3}
    records = {x["seq"]: x for x in fc.cascade_records(boxes, settings={"feature": "text"}).collect()}
    one, two, three = records[1], records[2], records[3]
    assert one["ocr"]["full_text"] == f"[FULL]\n{GOOD}\n\n[TOP]\n{GOOD}" and one["ocr"]["avg_conf"] == 92.5 and one["provider_meta"]["feature"] == "text"
    assert two["provider_meta"]["per_crop_errors"] == {"FULL": "late"} and two["fallback_used"] and len(two["provider_candidates"]) == 6
    assert [x["name"] for x in two["ocr"]["crops"]] == ["FULL", "TOP"] and two["ocr"]["crops"][1]["provider_candidates"][2]["meta"] == "m"
    assert three["ocr"]["full_text"] == f"[TOP]\n{GOOD}" and not three["fallback_used"] and three["provider_meta"]["errors"] == []
    stats = report.ocr_stats(fc.for_report(fc.cascade_records(boxes))).first()
    assert (stats["frame_records"], stats["provider_error_count"], stats["fallback_used_count"], stats["retry_invocations"], stats["azure_candidate_count"]) == (3, 1, 1, 10, 3)


def test_last_error_wins_and_empty_tables(spark):
    pairs = spark.createDataFrame([(["a", "b", "a"], ["1", "2", "3"]), ([], [])], "k array<string>, v array<string>")
    assert [x[0] for x in pairs.select(fc.last_by(F.col("k"), F.col("v"))).collect()] == [{"a": "3", "b": "2"}, {}]
    none = spark.createDataFrame([], SCHEMA)
    assert fc.cascade_records(fc.cascade_boxes(none, stages(spark, {}, {}))).collect() == []
