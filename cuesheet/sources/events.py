"""Logs of interaction events as JSON lines, JSON documents, CSV or TSV, in one normal form.

Result: event_id (the position in the input, from 1, counting rows that are left out), timestamp (seconds, three
decimals), event_type (click, scroll or key), payload (a JSON object).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import round_to
from ..functions.text import EDGE_SPACE, LINE_END
from ..operators.scan import numbered_as_read
from .json_arrays import read_array

#: The types that are kept, and the keys that are no payload.
EVENT_TYPES = ("click", "scroll", "key")
OWN_KEYS = ("ts", "timestamp", "time", "event", "type")

FIELDS = "map<string,variant>"


def _strip(x: Column) -> Column:
    return F.regexp_replace(x, EDGE_SPACE, "")


def _given(x: Column) -> Column:
    """A variant, null also where it holds JSON's null."""
    return F.when(x.isNotNull() & ~F.is_variant_null(x), x)


def _payload(value: Column, rest: Column) -> Column:
    kind = F.schema_of_variant(value)
    said = _strip(value.cast("string"))
    parsed = F.try_parse_json(said)
    of_text = F.when(said == "", F.lit("{}")).when(F.schema_of_variant(parsed).startswith("OBJECT"), F.to_json(parsed)).otherwise(F.to_json(F.struct(said.alias("raw"))))
    return F.when(value.isNull(), rest).when(kind.startswith("OBJECT"), F.to_json(value)).when(kind == "STRING", of_text).otherwise(F.to_json(F.struct(F.to_json(value).alias("raw"))))


def clean_events(rows: DataFrame) -> DataFrame:
    """rows: position, fields (a map of names to variants, or to strings). Rows without a number of seconds or a known type go.

    The time is the first of ts, timestamp and time that is not null; if it is no number, the row goes. The type is
    the first of event and type that is not empty. The payload is payload or, without one, all other fields.
    """
    if "VARIANT" not in rows.schema["fields"].dataType.simpleString().upper():
        rows = rows.withColumn("fields", F.from_json(F.to_json("fields"), FIELDS))
    field = lambda name: _given(F.col("fields")[name])
    seconds = F.coalesce(*(field(x).cast("string") for x in ("ts", "timestamp", "time"))).try_cast("double")
    kind = F.lower(_strip(F.coalesce(*(F.nullif(field(x).cast("string"), F.lit("")) for x in ("event", "type")))))
    rest = F.to_json(F.map_filter("fields", lambda k, _: ~k.isin(*OWN_KEYS)))
    out = rows.select(F.col("position").alias("event_id"), seconds.alias("t"), kind.alias("event_type"), _payload(field("payload"), rest).alias("payload"))
    return out.filter(F.col("t").isNotNull() & F.col("event_type").isin(*EVENT_TYPES)).select("event_id", round_to(F.col("t"), 3).alias("timestamp"), "event_type", "payload")


def from_lines(lines: DataFrame, strict: bool = True) -> DataFrame:
    """lines: position, value. Blank lines count but have no event; a line that is no JSON object raises if strict."""
    some = lines.filter(_strip(F.col("value")) != "")
    parsed = some.withColumn("v", F.parse_json("value") if strict else F.try_parse_json("value"))
    objects = parsed.filter(F.schema_of_variant("v").startswith("OBJECT"))
    return clean_events(objects.select("position", F.from_json(F.col("value"), FIELDS).alias("fields")))


def from_array(elements: DataFrame) -> DataFrame:
    """elements: position, value (a variant). Elements that are no objects count but have no event."""
    objects = elements.filter(F.schema_of_variant("value").startswith("OBJECT"))
    return clean_events(objects.select("position", F.from_json(F.to_json("value"), FIELDS).alias("fields")))


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The events of a log file, in the form that its suffix names; other suffixes are JSON lines of which bad ones are left out.

    Lines and rows are read in splits and numbered by the counts of the splits before; blank lines before the first
    event don't count. A JSON array is read in splits too; a document around one is one value, and read whole.
    """
    kind = path.rsplit(".", 1)[-1].lower()
    if kind in ("csv", "tsv"):
        table = spark.read.csv(path, header=True, sep="," if kind == "csv" else "\t")
        names = [x for x in table.columns]
        fields = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*(F.coalesce(F.col(f"`{x}`"), F.lit("")) for x in names)))
        return clean_events(numbered_as_read(table.select(fields.alias("fields")), "position")).orderBy("timestamp", "event_id")
    if kind == "json":
        head = spark.read.option("lineSep", "}").text(path).first()
        if head and head["value"].lstrip().startswith("["):
            return from_array(read_array(spark, path)).orderBy("timestamp", "event_id")
        whole = spark.read.text(path, wholetext=True).select(_strip(F.col("value")).alias("value"))
        doc = F.parse_json("value")
        listed = F.when(F.schema_of_variant(doc).startswith("ARRAY"), F.col("value")).otherwise(F.get_json_object("value", "$.events"))
        rows = whole.filter("value <> ''").select(F.posexplode(F.from_json(listed, f"array<{FIELDS}>")).alias("i", "fields"))
        return clean_events(rows.select((F.col("i") + 1).alias("position"), "fields")).orderBy("timestamp", "event_id")
    lines = numbered_as_read(spark.read.text(path).select(F.explode(F.split("value", LINE_END)).alias("value")), "position")
    some = lines.filter(_strip(F.col("value")) != "")
    first = some.agg(F.min("position").alias("first"))
    placed = some.join(F.broadcast(first), some["position"] >= first["first"]).select((F.col("position") - F.col("first") + 1).alias("position"), "value")
    return from_lines(placed, strict=kind in ("jsonl", "ndjson")).orderBy("timestamp", "event_id")
