from __future__ import annotations

from pyspark.sql import functions as F

from cuesheet.operators import frame_ocr


def test_boxes_and_passes_of_a_frame_are_not_shuffled(spark):
    frames = spark.createDataFrame([(1, 1, 640, 480)], "video_id long, seq long, width int, height int")
    answers = frame_ocr.crop_requests(frames, [6, 11]).withColumns({"text": F.lit("a b"), "avg_conf": F.lit(50.0)})
    plan = frame_ocr.frame_records(answers, 6)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
