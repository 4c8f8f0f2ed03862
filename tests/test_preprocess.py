from __future__ import annotations

import weakref
from pathlib import Path

import numpy as np
import pytest

from cuesheet.operators import images
from cuesheet.plans.queries import QUERIES
from cuesheet.scratch import tasks

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")
def test_a_small_file_of_frames_is_dealt_over_tasks(spark):
    assert QUERIES["preprocess"](spark, str(DATA)).rdd.getNumPartitions() == tasks(spark) >= 2 * spark.sparkContext.defaultParallelism


def test_equal_images_are_processed_once_within_bounds():
    made = []

    def make(x):
        made.append(x[0, 0])
        return x + 1

    results = images.Results(most=30)
    pictures = [np.full((2, 5), i, np.uint8) for i in range(4)]
    for i in (0, 1, 0, 2, 2, 3, 0):
        assert (results.of(pictures[i], (), make) == i + 1).all() and results.held <= 30
    assert made == [0, 1, 2, 3, 0]
    assert results.of(pictures[0], ("other",), make).shape == (2, 5) and made[-1] == 0 and len(made) == 6
    assert (results.of(pictures[1].reshape(5, 2), (), make)).shape == (5, 2)


def test_each_image_is_turned_to_bytes_before_the_next_is_made():
    alive = []

    def one(i):
        assert not any(x() is not None for x in alive[:-1])
        own = np.full((2, 3), float(i))
        alive.append(weakref.ref(own))
        return own

    assert images._struct(map(one, range(5)))["data"].tolist() == [bytes([i] * 6) for i in range(5)]


def test_median_network():
    own = np.random.default_rng(2).random((9, 11)) * 255
    padded = np.pad(own, 1, mode="edge")
    want = [[np.median(padded[y : y + 3, x : x + 3]) for x in range(11)] for y in range(9)]
    assert (images._middle(own) == np.array(want)).all()
