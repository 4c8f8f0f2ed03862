"""Streaming form of near-duplicate suppression: a stateful processor with event-time timers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.scan import DECISION, suppression

#: Milliseconds added to times: the watermark begins at 0, and what is not after it is late.
EPOCH = 86_400_000
FRAME = "timestamp double, seq long, frame_path string, hash_hi long, hash_lo long"
#: What a recording's decided frames have, besides its key.
NAMES = [x.split()[0] for x in f"timestamp double, seq long, frame_path string, {DECISION}".split(", ")]


def _plain(row: tuple, whole: set[int]) -> tuple:
    """A row of pandas or of the state as Python values: whole numbers, which pandas has as floats beside nulls, as int."""
    return tuple(None if pd.isna(x) else int(x) if i in whole else x for i, x in enumerate(row))


class Suppressor(StatefulProcessor):
    """Holds a recording's frames until the watermark has passed them, then decides on them in order.

    Two lists are its state: frames not decided yet, and frames kept in the last time_gap seconds. A timer at the last
    time of what came in decides; another, when the frames kept have grown too old for any frame to come, empties the state.
    """

    def __init__(self, key: str, kind: str, rule: tuple, time_gap: float, more: str):
        self.key, self.kind, self.rule, self.time_gap = key, kind, rule, time_gap
        self.schema = FRAME + (f", {more}" if more else "")
        self.columns = [x.split()[0] for x in self.schema.split(", ")]
        kinds = [x.split()[1] for x in f"due long, {self.schema}".split(", ")]
        self.whole = {i for i, x in enumerate(kinds) if x in ("long", "bigint", "int")}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", f"due long, {self.schema}")
        self.recent = handle.getListState("recent", self.schema)
        self.settle, self.step = suppression(*self.rule)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = 0
        for batch in rows:
            own = [_plain(x, self.whole) for x in batch[["due", *self.columns]].itertuples(index=False, name=None)]
            self.waiting.appendList(own)
            last = max(last, *(int(x[0]) for x in own))
        if last:
            self.handle.registerTimer(last)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        waiting = [_plain(x, self.whole) for x in self.waiting.get()]
        ready = sorted((x for x in waiting if x[0] <= now), key=lambda x: x[1:3])
        later = [x for x in waiting if x[0] > now]
        recent = [dict(zip(self.columns, _plain((0, *x), self.whole)[1:])) for x in self.recent.get()]
        out = []
        for _, *row in ready:
            own = dict(zip(self.columns, row))
            out.append((key[0], *row[:3], *self.step(recent, own)))
        recent = self.settle(recent, (now - EPOCH) / 1000)
        _put(self.waiting, later)
        _put(self.recent, [tuple(x[y] for y in self.columns) for x in recent])
        if recent:
            self.handle.registerTimer(EPOCH + int(1000 * (recent[-1]["timestamp"] + self.time_gap)) + 2)
        if out:
            yield pd.DataFrame(out, columns=[self.key, *NAMES]).astype({"hash_distance": "Int64", "candidate_delta_ratio": "float64"})

    def close(self) -> None:
        pass


def _put(state, rows: list[tuple]) -> None:
    if rows:
        state.put(rows)
    else:
        state.clear()


def streaming_suppress(
    frames: DataFrame,
    time_gap: float = 2.0,
    max_distance: int = 6,
    late: str = "2 minutes",
    preserve_transitions: bool = True,
    transition_gap: float = 2.5,
    transition_delta: float = 0.012,
    key: str = "video_id",
    delta: Callable | None = None,
    delta_columns: str = "",
) -> DataFrame:
    """As the batch form, over a stream of frames: key, timestamp (seconds), seq, frame_path, hash_hi, hash_lo, and the
    columns of delta_columns (name and type of each, as in a schema), which delta reads.

    Frames may come in any order. A frame is decided when the watermark, late behind the newest time of any recording,
    has passed it, so the result is the batch form's over the frames that came in time; later ones are dropped. A
    recording's state is its frames of the time that is late, and those kept in the last time_gap seconds; it is
    emptied when time has passed these. Frames without a time are dropped. Needs the state store of RocksDB
    (spark.sql.streaming.stateStore.providerClass).
    """
    kind = frames.schema[key].dataType.simpleString()
    schema = FRAME + (f", {delta_columns}" if delta_columns else "")
    due = F.ceil(F.col("timestamp") * 1000).cast("long") + EPOCH
    rows = frames.filter(F.col("timestamp").isNotNull() & ~F.isnan("timestamp")).select(key, F.timestamp_millis(due).alias("at"), due.alias("due"), *(x.split()[0] for x in schema.split(", ")))
    rule = (time_gap, max_distance, transition_gap, transition_delta, delta if preserve_transitions else None)
    processor = Suppressor(key, kind, rule, time_gap, delta_columns)
    out = f"`{key}` {kind}, timestamp double, seq long, frame_path string, {DECISION}"
    return rows.withWatermark("at", late).groupBy(key).transformWithStateInPandas(statefulProcessor=processor, outputStructType=out, outputMode="append", timeMode="EventTime")
