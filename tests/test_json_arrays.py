"""JSON arrays read in splits: against the standard library's parser, with splits that cut strings, escapes and objects."""

import json
import random

import pytest

from cuesheet.sources import events, json_arrays


@pytest.fixture
def small_splits(spark):
    """Splits of some hundred bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def thing(rng, depth=0):
    kind = rng.randrange(8 if depth < 4 else 5)
    if kind < 3:
        return "".join(rng.choice('ab{}[]",:\\ é中\n') for _ in range(rng.randrange(9)))
    if kind < 5:
        return rng.choice([1, -2.5, None, True, 12345678901])
    if kind < 6:
        return [thing(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice('ab}"\\{k') + str(k): thing(rng, depth + 1) for k in range(rng.randrange(4))}


def test_arrays_against_a_parser(spark, tmp_path, small_splits):
    rng = random.Random(8)
    want = {}
    for k, (n, text) in enumerate([(200, {}), (150, {"indent": 1}), (40, {"ensure_ascii": False}), (0, {}), (1, {})]):
        own = [thing(rng) if rng.random() < 0.3 else {"k": thing(rng), "n": i} for i in range(n)]
        (tmp_path / f"{k}.json").write_text(json.dumps(own, **text) + "\n" * (k % 2), encoding="utf-8")
        want |= {(f"{k}.json", i + 1): x for i, x in enumerate(own)}
    read = json_arrays.read_array(spark, str(tmp_path))
    assert json_arrays.pieces(spark, str(tmp_path)).select("file", "block").distinct().count() > 50
    got = {(x["file"].rsplit("/", 1)[1], x["position"]): x["v"] for x in read.selectExpr("file", "position", "to_json(value) as v").collect()}
    assert got.keys() == want.keys()
    assert all(x is None and want[k] is None or json.loads(x) == want[k] for k, x in got.items())


@pytest.mark.parametrize("text", ['[{"a": 1}', '[{"a": 1}, {"b": 2', '[{"a": 1} {"b": 2}]', '[{"a": 1},]', '[{"a": "x}]', '[{"a": 1}] x', '[{"a": 1}}]', "["])
def test_what_is_no_array_raises(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match=r"(?i)json"):
        json_arrays.read_array(spark, str(tmp_path / "bad.json")).collect()


def test_events_of_an_array(spark, tmp_path, small_splits):
    logged = [x for i in range(120) for x in ({"ts": i, "type": "click", "payload": {"x": "}{\"" * (i % 5)}}, "no object" if i % 7 else {"ts": "bad"})]
    (tmp_path / "log.json").write_text(json.dumps(logged))
    got = [(x["event_id"], x["timestamp"], json.loads(x["payload"])) for x in events.read_events(spark, str(tmp_path / "log.json")).collect()]
    assert got == [(2 * i + 1, float(i), {"x": "}{\"" * (i % 5)}) for i in range(120)]
    (tmp_path / "none.json").write_text("")
    assert events.read_events(spark, str(tmp_path / "none.json")).count() == 0
