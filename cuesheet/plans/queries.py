"""All queries of the library's own operators over the fixtures, each with SQL for an independent engine."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import ship
from ..functions import numbers, quality, text
from ..operators import align, candidates, crops, frames, report, scan, segments, settings, tuning, windows
from ..operators import frame_cascade
from ..operators import frame_ocr as recognition
from ..scratch import scratch_root, tasks
from ..sources import events as event_logs
from ..sources import json_arrays, providers, showinfo, sinks
from .fixtures import fixture, with_fixtures

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, recursive: bool = False) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with SQL over the tables and fixtures."""

    def register(function: Query) -> Query:
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = shipped
        if sql is not None:
            ORACLE_SQL[function.__name__] = with_fixtures(sql, recursive) if "fx_" in sql else sql
        return function

    return register


R = "round(({0})::decimal(30,12), {1})::double"


def _round(x: str, n: int) -> str:
    return R.format(x, n)


# --- windows ------------------------------------------------------------------------------------------------------

_SEGMENT_MEMBERS = """seg_m AS (SELECT s.*, ix AS window_ix FROM (SELECT *, unnest(generate_series(0, floor(end_ / 45)::bigint + 1)) AS ix FROM fx_segments) s
    WHERE end_ > ix * 45.0::double AND start < (ix + 1) * 45.0::double)"""


@query(f"""{_SEGMENT_MEMBERS},
    s AS (SELECT video_id, window_ix, count(*) AS n_segments, string_agg(trim(text, chr(32) || chr(9) || chr(10) || chr(13)), ' ' ORDER BY seq) AS txt,
                 string_agg(DISTINCT speaker, ',' ORDER BY speaker) AS speakers FROM seg_m GROUP BY ALL),
    f AS (SELECT video_id, floor(timestamp / 45)::bigint AS window_ix, count(*) AS n_frames FROM fx_frames GROUP BY ALL),
    e AS (SELECT video_id, floor(timestamp / 45)::bigint AS window_ix, count(*) AS n_events FROM fx_events GROUP BY ALL),
    k AS (SELECT video_id, window_ix, seq AS key_seq FROM (SELECT video_id, floor(timestamp / 45)::bigint AS window_ix, seq,
          row_number() OVER (PARTITION BY video_id, floor(timestamp / 45)::bigint ORDER BY coalesce(quality_score, 0) DESC, length(ocr_text) DESC, coalesce(avg_conf, -1) DESC, seq) AS r FROM fx_frames) WHERE r = 1)
    SELECT video_id, window_ix, {_round("window_ix * 45.0::double", 3)} AS window_start, {_round("(window_ix + 1) * 45.0::double", 3)} AS window_end,
           coalesce(n_segments, 0) AS n_segments, coalesce(n_frames, 0) AS n_frames, coalesce(n_events, 0) AS n_events, coalesce(txt, '') AS transcript_text,
           coalesce(speakers, '') AS speakers, coalesce(key_seq, -1) AS key_seq
    FROM s FULL JOIN f USING (video_id, window_ix) FULL JOIN e USING (video_id, window_ix) LEFT JOIN k USING (video_id, window_ix)""")
def windows_flat(spark, sf_dir):
    out = windows.build_windows(*(fixture(spark, sf_dir, x) for x in ("fx_segments", "fx_frames", "fx_events")))
    n = lambda x: F.coalesce(F.size(x), F.lit(0)).cast("long")
    return out.select(
        "video_id", "window_ix", "window_start", "window_end", n("segments").alias("n_segments"), n("frames").alias("n_frames"), n("events").alias("n_events"),
        "transcript_text", F.array_join("speakers_present", ",").alias("speakers"), F.coalesce("key_frame.seq", F.lit(-1)).alias("key_seq"),
    )


@query(f"{_SEGMENT_MEMBERS} SELECT video_id, seq, window_ix, start, end_ FROM seg_m")
def window_members_segments(spark, sf_dir):
    return windows.segment_members(fixture(spark, sf_dir, "fx_segments")).select("video_id", "seq", "window_ix", "start", F.col("end").alias("end_"))


@query("SELECT video_id, seq, floor(timestamp / 45)::bigint AS window_ix, timestamp FROM fx_frames WHERE timestamp >= 0")
def window_members_frames(spark, sf_dir):
    return windows.point_members(fixture(spark, sf_dir, "fx_frames")).select("video_id", "seq", "window_ix", "timestamp")


@query("SELECT video_id, seq, floor(timestamp / 45)::bigint AS window_ix, event_type FROM fx_events WHERE timestamp >= 0")
def window_members_events(spark, sf_dir):
    return windows.point_members(fixture(spark, sf_dir, "fx_events")).select("video_id", "seq", "window_ix", "event_type")


@query("""SELECT video_id, window_ix, seq AS key_seq, frame_path, quality_score FROM (SELECT *, floor(timestamp / 45)::bigint AS window_ix,
    row_number() OVER (PARTITION BY video_id, floor(timestamp / 45)::bigint ORDER BY coalesce(quality_score, 0) DESC, length(ocr_text) DESC, coalesce(avg_conf, -1) DESC, seq) AS r FROM fx_frames) WHERE r = 1""")
def window_key_frame(spark, sf_dir):
    k = windows.key_frames(fixture(spark, sf_dir, "fx_frames"))
    return k.select("video_id", "window_ix", F.col("key_frame.seq").alias("key_seq"), "key_frame.frame_path", "key_frame.quality_score")


@query(f"{_SEGMENT_MEMBERS} SELECT DISTINCT video_id, window_ix, speaker FROM seg_m WHERE speaker <> ''")
def window_speakers(spark, sf_dir):
    own = windows.segment_members(fixture(spark, sf_dir, "fx_segments"))
    sets = own.groupBy("video_id", "window_ix").agg(F.collect_set(F.when(F.col("speaker") != "", F.col("speaker"))).alias("s"))
    return sets.select("video_id", "window_ix", F.explode("s").alias("speaker"))


# --- alignment ----------------------------------------------------------------------------------------------------

_SCORE = """((1.0 - least(1.0, greatest(s.start - f.timestamp, f.timestamp - s.end_, 0.0) / 10.0::double)) * 0.5::double
    + (1.0 - least(1.0, abs(f.timestamp - (s.start + s.end_) / 2.0::double) / 10.0::double)) * 0.3::double + coalesce(f.quality_score, 0.0) * 0.2::double)"""
_RANKED = f"""scored AS (SELECT s.video_id, s.seq, f.seq AS frame_seq, f.timestamp, f.frame_path, coalesce(f.quality_score, 0) AS q, {_SCORE} AS score
    FROM fx_segments s JOIN fx_frames f ON s.video_id = f.video_id AND f.timestamp BETWEEN s.start - 10.0::double AND s.end_ + 10.0::double),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY video_id, seq ORDER BY score DESC, q DESC, timestamp, frame_seq) AS rank FROM scored)"""


@query(f"{_RANKED} SELECT video_id, seq, rank, frame_seq, {_round('score', 4)} AS attach_score FROM ranked WHERE rank <= 3")
def align_topk(spark, sf_dir):
    top = align.top_candidates(fixture(spark, sf_dir, "fx_segments"), fixture(spark, sf_dir, "fx_frames"), 10.0, 3)
    return top.select("video_id", "seq", F.col("rank").cast("long").alias("rank"), F.col("frame.seq").alias("frame_seq"), numbers.round_to(F.col("score"), 4).alias("attach_score"))


@query(f"""{_RANKED} SELECT s.video_id, s.seq, r.timestamp AS frame_timestamp, r.frame_path, coalesce({_round('r.score', 4)}, 0.0) AS attach_score,
    CASE WHEN r.seq IS NULL THEN 'no_in_range_candidate' ELSE 'candidate_attached' END AS attach_reason,
    (SELECT count(*) FROM ranked x WHERE x.video_id = s.video_id AND x.seq = s.seq AND x.rank <= 3) AS n_candidates
    FROM fx_segments s LEFT JOIN ranked r ON s.video_id = r.video_id AND s.seq = r.seq AND r.rank = 1""")
def align_attach(spark, sf_dir):
    out = align.build_dataset(fixture(spark, sf_dir, "fx_segments"), fixture(spark, sf_dir, "fx_frames"))
    return out.select("video_id", "seq", "frame_timestamp", "frame_path", "attach_score", "attach_reason", F.size("frame_candidates").cast("long").alias("n_candidates"))


@query(f"""near AS (SELECT s.video_id, s.seq, f.seq AS frame_seq, abs(f.timestamp - (s.start + s.end_) / 2.0::double) AS gap,
        row_number() OVER (PARTITION BY s.video_id, s.seq ORDER BY abs(f.timestamp - (s.start + s.end_) / 2.0::double), f.timestamp, f.seq) AS r
        FROM fx_segments s JOIN fx_frames f USING (video_id))
    SELECT s.video_id, s.seq, coalesce(n.frame_seq, -1) AS frame_seq, CASE WHEN gap IS NOT NULL THEN {_round('1.0 - least(1.0, gap / 10.0::double)', 4)} END AS score
    FROM fx_segments s LEFT JOIN near n ON s.video_id = n.video_id AND s.seq = n.seq AND r = 1 AND gap <= 10.0::double""")
def align_nearest(spark, sf_dir):
    out = align.nearest(fixture(spark, sf_dir, "fx_segments"), fixture(spark, sf_dir, "fx_frames"))
    return out.select("video_id", "seq", F.coalesce("frame.seq", F.lit(-1)).alias("frame_seq"), numbers.round_to(F.col("score"), 4).alias("score"))


def _as_of(compare: str, order: str) -> str:
    return f"""found AS (SELECT s.video_id, s.seq, f.seq AS frame_seq, f.timestamp, row_number() OVER (PARTITION BY s.video_id, s.seq ORDER BY f.timestamp {order}, f.seq {order}) AS r
        FROM fx_segments s JOIN fx_frames f ON s.video_id = f.video_id AND f.timestamp {compare} (s.start + s.end_) / 2.0::double)
    SELECT s.video_id, s.seq, coalesce(f.frame_seq, -1) AS frame_seq, f.timestamp AS frame_timestamp FROM fx_segments s LEFT JOIN found f ON s.video_id = f.video_id AND s.seq = f.seq AND r = 1"""


def _neighbour(spark, sf_dir, side):
    out = align.prev_next(fixture(spark, sf_dir, "fx_segments"), fixture(spark, sf_dir, "fx_frames"))
    return out.select("video_id", "seq", F.coalesce(f"{side}.seq", F.lit(-1)).alias("frame_seq"), F.col(f"{side}.timestamp").alias("frame_timestamp"))


@query(_as_of("<", "DESC"))
def align_prev(spark, sf_dir):
    return _neighbour(spark, sf_dir, "prev")


@query(_as_of(">=", ""))
def align_next(spark, sf_dir):
    return _neighbour(spark, sf_dir, "next")


# --- text quality -------------------------------------------------------------------------------------------------

_QUALITY = r"""t AS (SELECT *, regexp_extract_all(text, '\S+') AS tokens, len(regexp_extract_all(text, '[A-Za-z][A-Za-z''\-]*')) AS words FROM fx_ocr),
    m AS (SELECT *, len(tokens) AS n,
            len(list_filter(tokens, lambda x: length(regexp_replace(x, '[^\p{L}]', '', 'g')) = 0
                OR length(regexp_replace(x, '[\p{L}\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨_\-''.]', '', 'g')) / length(x)::double > 0.25)) AS weird,
            len(list_filter(tokens, lambda x: length(x) >= 18 AND length(regexp_replace(x, '[^\p{L}]', '', 'g')) / length(x)::double > 0.8 AND NOT regexp_matches(x, '[-_]'))) AS joined,
            len(list_filter(regexp_split_to_array(text, '\n'), lambda x: trim(x) <> '')) AS nl, length(regexp_replace(text, '[^.,:;!?()\[\]]', '', 'g')) AS marks FROM t),
    r AS (SELECT *, CASE WHEN n = 0 THEN 0 ELSE least(1.0, words / n::double) END AS lex, CASE WHEN n = 0 THEN 1 ELSE weird / n::double END AS wr, CASE WHEN n = 0 THEN 0 ELSE joined / n::double END AS jr,
            CASE WHEN n = 0 THEN 0 ELSE least(1.0, least(1.0, nl / 16.0::double) * 0.45::double + least(1.0, marks / greatest(1.0, length(text) / 24.0::double)) * 0.55::double) END AS st,
            CASE WHEN avg_conf IS NULL THEN 0.5 ELSE greatest(0.0, least(1.0, avg_conf / 100.0::double)) END AS unit FROM m),
    q AS (SELECT *, greatest(0.0, least(1.0, lex * 0.65::double + (1.0 - wr) * 0.25::double + (1.0 - jr) * 0.10::double)) AS lexical FROM r),
    z AS (SELECT *, CASE WHEN trim(regexp_replace(text, '\s+', ' ', 'g')) = '' THEN 0.0 ELSE greatest(0.0, least(1.0, unit * 0.45::double + lexical * 0.40::double + st * 0.15::double)) END AS quality FROM q)"""


@query(f"""{_QUALITY} SELECT video_id, {_round("quality", 4)} AS quality_score, length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS text_len, n::bigint AS token_count, words::bigint AS word_count,
    {_round("lex", 4)} AS lexicality, {_round("wr", 4)} AS weird_token_ratio, {_round("jr", 4)} AS long_joined_ratio, {_round("st", 4)} AS structure_score, {_round("lexical", 4)} AS lexical_score FROM z""")
def ocr_quality_score(spark, sf_dir):
    out = quality.with_quality(fixture(spark, sf_dir, "fx_ocr"))
    m = lambda x: F.col(f"quality_metrics.{x}")
    return out.select("video_id", "quality_score", *(m(x).cast("long").alias(x) for x in ("text_len", "token_count", "word_count")), *(m(x).alias(x) for x in ("lexicality", "weird_token_ratio", "long_joined_ratio", "structure_score", "lexical_score")))


@query(f"""{_QUALITY} SELECT video_id, unnest(list_filter([CASE WHEN unit < 0.65 THEN 'low_confidence' END, CASE WHEN lexical < 0.60 THEN 'low_lexicality' END,
    CASE WHEN jr > 0.08 THEN 'suspicious_joined_tokens' END, CASE WHEN quality < 0.55 THEN 'garble_like' END], lambda x: x IS NOT NULL)) AS flag FROM z""")
def ocr_quality_flags(spark, sf_dir):
    return quality.with_quality(fixture(spark, sf_dir, "fx_ocr")).select("video_id", F.explode("quality_flags").alias("flag"))


@query(f"""{_QUALITY} SELECT l.quality, l.toxic, count(*) AS n, {_round(f"sum({R.format('z.quality', 4)}::decimal(30,12)) / count(*)", 6)} AS mean_score
    FROM z JOIN labels l ON z.video_id = l.doc_id GROUP BY ALL""")
def label_vs_quality(spark, sf_dir):
    scored = quality.with_quality(fixture(spark, sf_dir, "fx_ocr"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").withColumnRenamed("quality", "label")
    mean = F.sum(F.col("quality_score").cast("decimal(30,12)")) / F.count("*")
    out = scored.join(labels, scored["video_id"] == labels["doc_id"]).groupBy("label", "toxic").agg(F.count("*").alias("n"), numbers.round_to(mean, 6).alias("mean_score"))
    return out.withColumnRenamed("label", "quality")


_WIDTH, _HEIGHT = "1 + (video_id * 37) % 1930", "1 + (video_id * 53) % 1090"
_SIZES = f"(SELECT video_id AS id, {_WIDTH} AS w, {_HEIGHT} AS h FROM fx_videos) AS v"


@query(f"""SELECT id, name, x1::int AS x1, y1::int AS y1, x2::int AS x2, y2::int AS y2 FROM (
    SELECT id, 'FULL' AS name, 0 AS x1, 0 AS y1, w AS x2, h AS y2 FROM {_SIZES}
    UNION ALL SELECT id, 'TOP', 0, 0, w, floor(h * 0.20::double) FROM {_SIZES} UNION ALL SELECT id, 'LEFT', 0, 0, floor(w * 0.25::double), h FROM {_SIZES}
    UNION ALL SELECT id, 'MAIN', floor(w * 0.15::double), floor(h * 0.15::double), floor(w * 0.85::double), floor(h * 0.85::double) FROM {_SIZES}
    UNION ALL SELECT id, 'BOTTOM', 0, floor(h * 0.80::double), w, h FROM {_SIZES}
    UNION ALL SELECT id, 'MANUAL_01', least(w - 1, 5), least(h - 1, 6), least(w, 300), least(h, 200) FROM {_SIZES} WHERE least(w, 300) > least(w - 1, 5) AND least(h, 200) > least(h - 1, 6))""")
def crop_boxes(spark, sf_dir):
    images = fixture(spark, sf_dir, "fx_videos").select(F.col("video_id").alias("id"), F.expr(_WIDTH).cast("int").alias("width"), F.expr(_HEIGHT).cast("int").alias("height"))
    return crops.crop_boxes(images, "preset", ["5,6,300,200"]).select("id", "name", "box.*")


_EDGES = {"x1": "(event_id * 7) % 220 - 60", "y1": "(event_id * 11) % 200 - 50", "x2": "(event_id * 13) % 260 - 40", "y2": "(event_id * 17) % 240 - 30"}
_BOXES = f"(SELECT event_id AS id, {', '.join(f'({y})::int AS {x}' for x, y in _EDGES.items())} FROM events) AS v"


@query(f"""SELECT id, CASE WHEN ok THEN a END AS x1, CASE WHEN ok THEN b END AS y1, CASE WHEN ok THEN c END AS x2, CASE WHEN ok THEN d END AS y2 FROM (SELECT *, c > a AND d > b AS ok FROM (
    SELECT id, greatest(0, least(99, x1)) AS a, greatest(0, least(99, y1)) AS b, greatest(1, least(100, x2)) AS c, greatest(1, least(100, y2)) AS d FROM {_BOXES}))""")
def clip_box(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("id"), *(F.expr(y).cast("int").alias(x) for x, y in _EDGES.items()))
    clipped = crops.clip_box(crops.box(*(F.col(x) for x in ("x1", "y1", "x2", "y2"))), F.lit(100), F.lit(100))
    return rows.select("id", clipped.alias("b")).select("id", "b.*")


# --- choice of candidates -----------------------------------------------------------------------------------------

_BY_RANK = "coalesce(quality_score, 0) DESC, length(text) DESC, coalesce(avg_conf, 0) DESC, seq"


@query(f"SELECT doc_id, variant, quality_score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY {_BY_RANK}) AS r FROM fx_candidates) WHERE r = 1")
def best_candidate(spark, sf_dir):
    return candidates.best_candidate(fixture(spark, sf_dir, "fx_candidates"), ["doc_id"]).select("doc_id", "variant", "quality_score")


@query("""SELECT doc_id, CASE WHEN length(trim(regexp_replace(b, '\\s+', ' ', 'g'))) > length(trim(regexp_replace(a, '\\s+', ' ', 'g'))) THEN b ELSE a END AS text
    FROM (SELECT doc_id, max(text) FILTER (variant = 'google_b') AS a, max(text) FILTER (variant = 'azure_read') AS b FROM fx_candidates GROUP BY doc_id)""")
def psm_better(spark, sf_dir):
    of = lambda v: F.max(F.when(F.col("variant") == v, F.struct("text")))
    both = fixture(spark, sf_dir, "fx_candidates").groupBy("doc_id").agg(of("google_b").alias("a"), of("azure_read").alias("b"))
    return both.select("doc_id", candidates.better_pass(F.col("a"), F.col("b"))["text"].alias("text"))


@query("""a AS (SELECT * FROM fx_candidates WHERE variant = 'google_a'), b AS (SELECT * FROM fx_candidates WHERE variant = 'google_b'), z AS (SELECT * FROM fx_candidates WHERE variant = 'azure_read'),
    asked_b AS (SELECT a.doc_id FROM a WHERE coalesce(error, '') <> '' OR quality_score < 0.55),
    two AS (SELECT * FROM a UNION ALL SELECT b.* FROM b JOIN asked_b USING (doc_id)),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(quality_score, 0) DESC, length(text) DESC, coalesce(avg_conf, 0) DESC, seq) AS r FROM two) WHERE r = 1),
    asked_z AS (SELECT doc_id FROM best WHERE coalesce(error, '') <> '' OR quality_score < 0.55),
    three AS (SELECT * FROM two UNION ALL SELECT z.* FROM z JOIN asked_z USING (doc_id)),
    final AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(quality_score, 0) DESC, length(text) DESC, coalesce(avg_conf, 0) DESC, seq) AS r,
              count(*) OVER (PARTITION BY doc_id) AS n FROM three) WHERE r = 1)
    SELECT doc_id, variant, quality_score, error, n AS n_asked, provider = 'azure' AS fallback_used FROM final""")
def provider_cascade(spark, sf_dir):
    out = candidates.cascade(fixture(spark, sf_dir, "fx_candidates"), ["doc_id"])
    return out.select("doc_id", "variant", "quality_score", "error", F.col("n_asked").cast("long").alias("n_asked"), "fallback_used")


@query(f"""c AS (SELECT video_id, utterance_id, CASE WHEN word_ix % 9 = 0 THEN NULL WHEN word_ix % 5 = 0 THEN -1.0 ELSE ((word_ix * 37) % 101) / 100.0::double END AS conf FROM fx_words),
    ok AS (SELECT video_id, utterance_id, (CASE WHEN conf <= 1.0 THEN conf * 100.0::double ELSE conf END) AS p FROM c WHERE conf >= 0)
    SELECT w.video_id, w.utterance_id, {_round(_round("sum(p::decimal(30,6))::double / count(p)", 2), 1)} AS avg_conf
    FROM (SELECT DISTINCT video_id, utterance_id FROM fx_words) w LEFT JOIN ok USING (video_id, utterance_id) GROUP BY ALL""")
def conf_flatten_mean(spark, sf_dir):
    conf = F.expr("case when word_ix % 9 = 0 then null when word_ix % 5 = 0 then -1.0D else ((word_ix * 37) % 101) / 100.0D end")
    words = fixture(spark, sf_dir, "fx_words").select("video_id", "utterance_id", F.struct("word_ix", F.col("text"), conf.alias("confidence")).alias("w"))
    lines = words.groupBy("video_id", "utterance_id").agg(F.sort_array(F.collect_list("w")).alias("ws"))
    blocks = F.array(F.struct(F.array(F.struct(F.lit("x").alias("text"), F.transform("ws", lambda w: F.struct(F.when(w["confidence"] >= 0, w["confidence"]).alias("confidence"))).alias("words"))).alias("lines")))
    return lines.select("video_id", "utterance_id", numbers.round_to(candidates.flatten_lines(blocks)["avg_conf"], 1).alias("avg_conf"))


# --- scalar functions ---------------------------------------------------------------------------------------------

_SPEAKER = "case event_id % 6 when 0 then cast(event_id % 40 as {0}) when 1 then chr(cast(97 + event_id % 26 as int)) when 2 then concat(' ', upper(event_type), ' ') when 3 then '' when 4 then event_type end"
_SPEAKERS = f"(SELECT event_id AS id, {_SPEAKER.format('varchar')} AS raw FROM events)"


@query(f"""SELECT id, CASE WHEN x = '' THEN NULL WHEN regexp_full_match(x, '[A-Za-z]') THEN upper(x) WHEN regexp_full_match(x, '[0-9]+') AND x::int <= 25 THEN chr(65 + x::int)
        WHEN regexp_full_match(x, '[0-9]+') THEN 'S' || x ELSE upper(x) END AS alpha,
    CASE WHEN x = '' THEN NULL WHEN regexp_full_match(x, '[0-9]+') THEN x WHEN regexp_full_match(x, '[A-Za-z]') THEN (ord(upper(x)) - 64)::varchar ELSE x END AS number
    FROM (SELECT id, trim(raw) AS x FROM {_SPEAKERS})""")
def normalize_speaker(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("id"), F.expr(_SPEAKER.format("string")).alias("raw"))
    return rows.select("id", text.speaker_label(F.col("raw"), "alpha").alias("alpha"), text.speaker_label(F.col("raw"), "numeric").alias("number"))


_MILLIS = "case event_id % 5 when 0 then cast(event_id * 37 as {0}) when 1 then null when 2 then concat('x', event_type) when 3 then concat(' ', cast(event_id as {0}), '.5 ') else '0' end"


@query(f"SELECT id, coalesce(try_cast(x AS double) / 1000.0::double, 0.0) AS seconds FROM (SELECT event_id AS id, {_MILLIS.format('varchar')} AS x FROM events)")
def ms_to_seconds(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("id"), F.expr(_MILLIS.format("string")).alias("x"))
    return rows.select("id", numbers.ms_to_seconds(F.col("x")).alias("seconds"))


@query("""SELECT video_id, seq, printf('%02d:%02d:%02d,%03d', ms // 3600000, ms % 3600000 // 60000, ms % 60000 // 1000, ms % 1000) AS stamp
    FROM (SELECT video_id, seq, round(start::decimal(30,12) * 1000)::bigint AS ms FROM fx_segments)""")
def srt_stamp(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_segments").select("video_id", "seq", text.srt_stamp(F.col("start")).alias("stamp"))


@query("SELECT video_id, seq, printf('%010.3f', timestamp) AS stamp FROM fx_frames")
def file_stamp(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_frames").select("video_id", "seq", text.file_stamp(F.col("timestamp")).alias("stamp"))


@query("""SELECT id, CASE WHEN s < 60 THEN printf('%.1fs', s) WHEN floor(s / 60) < 60 THEN printf('%dm %ds', floor(s / 60)::bigint, round_even(s % 60, 0)::bigint)
    ELSE printf('%dh %dm', floor(floor(s / 60) / 60)::bigint, floor(s / 60)::bigint % 60) END AS said
    FROM (SELECT event_id AS id, (event_id * 137 % 100000)::double / CASE WHEN event_id % 3 = 0 THEN 2000.0 ELSE 10.0 END::double AS s FROM events)""")
def human_duration(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("id"), F.expr("cast(event_id * 137 % 100000 as double) / case when event_id % 3 = 0 then 2000.0D else 10.0D end").alias("s"))
    return rows.select("id", text.human_duration(F.col("s")).alias("said"))


_CODE = "case event_id % 8 when 0 then 'eng' when 1 then ' SPA ' when 2 then 'ita' when 3 then '' when 4 then 'Fra' when 5 then concat(' deu', ' ') when 6 then event_type end"


@query(f"""SELECT id, CASE WHEN trim(x) = '' THEN NULL ELSE CASE lower(trim(x)) WHEN 'eng' THEN 'en' WHEN 'spa' THEN 'es' WHEN 'fra' THEN 'fr' WHEN 'deu' THEN 'de' ELSE trim(x) END END AS hint
    FROM (SELECT event_id AS id, {_CODE} AS x FROM events)""")
def lang_hint(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("id"), F.expr(_CODE).alias("x"))
    return rows.select("id", text.language_hint(F.col("x")).alias("hint"))


@query("""s AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY seq) AS i FROM fx_segments),
    t AS (SELECT *, round(start::decimal(30,12) * 1000)::bigint AS a, round(end_::decimal(30,12) * 1000)::bigint AS b FROM s)
    SELECT video_id, i AS cue, i || chr(10) || printf('%02d:%02d:%02d,%03d', a // 3600000, a % 3600000 // 60000, a % 60000 // 1000, a % 1000) || ' --> '
        || printf('%02d:%02d:%02d,%03d', b // 3600000, b % 3600000 // 60000, b % 60000 // 1000, b % 1000) || chr(10) || trim(text, chr(32) || chr(9) || chr(10) || chr(13)) AS lines FROM t""")
def srt_lines(spark, sf_dir):
    from ..sources.sinks import srt_cues

    return srt_cues(fixture(spark, sf_dir, "fx_segments"), ["seq"]).select("video_id", F.col("cue").cast("long").alias("cue"), "lines")


_TIGHTEN = r"trim(regexp_replace(regexp_replace(regexp_replace({0}, '\s+([,.;:!?])', '\1', 'g'), '\(\s+', '(', 'g'), '\s+\)', ')', 'g'))"


@query(f"SELECT video_id, utterance_id, {_TIGHTEN.format(chr(34) + 't' + chr(34))} AS text FROM (SELECT video_id, utterance_id, string_agg(text, ' ' ORDER BY word_ix) AS t FROM fx_words GROUP BY ALL)")
def join_tokens(spark, sf_dir):
    own = fixture(spark, sf_dir, "fx_words").groupBy("video_id", "utterance_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("word_ix", "text"))), lambda x: x["text"]).alias("t"))
    return own.select("video_id", "utterance_id", text.join_tokens(F.col("t")).alias("text"))


# --- segmentation -------------------------------------------------------------------------------------------------

_PAUSED = """fx_paused AS (SELECT video_id, utterance_id, word_ix, text, start + (word_ix // 60) * 0.0 AS start, end_ FROM fx_words)"""
_SPLIT = r"""w AS (SELECT *, row_number() OVER (PARTITION BY video_id, utterance_id ORDER BY word_ix) AS i FROM fx_words),
    rec AS (SELECT video_id, utterance_id, i, word_ix, text, start, end_, start AS t0, 0::bigint AS chunk, 'start' AS cut FROM w WHERE i = 1
        UNION ALL SELECT video_id, utterance_id, i, word_ix, text, start, end_, CASE WHEN c IS NULL THEN t0 ELSE start END, CASE WHEN c IS NULL THEN chunk ELSE chunk + 1 END, c
        FROM (SELECT n.*, r.t0, r.chunk, CASE WHEN regexp_matches(r.text, '[.!?;:]$') THEN 'start' WHEN greatest(0.0, n.start - r.end_) >= 0.6::double THEN 'silence_gap' WHEN n.end_ - r.t0 >= 5.0::double THEN 'max_duration' END AS c
              FROM rec r JOIN w n ON r.video_id = n.video_id AND r.utterance_id = n.utterance_id AND n.i = r.i + 1)),
    chunks AS (SELECT video_id, utterance_id, chunk, min(start) AS start, max(end_) AS end_, string_agg(text, ' ' ORDER BY i) AS t, arg_min(cut, i) AS cut, arg_max(text, i) AS last FROM rec GROUP BY ALL),
    split AS (SELECT video_id, utterance_id, chunk, start, end_, """ + _TIGHTEN.format("t") + r""" AS text,
        CASE WHEN regexp_matches(last, '[.!?;:]$') THEN 'punctuation' ELSE coalesce(lead(cut) OVER (PARTITION BY video_id, utterance_id ORDER BY chunk), 'tail') END AS split_reason FROM chunks)"""


@query(f"{_SPLIT} SELECT video_id, utterance_id, chunk, {_round('start', 3)} AS start, {_round('end_', 3)} AS end_, text, split_reason FROM split", recursive=True)
def split_utterances(spark, sf_dir):
    return segments.split_words(fixture(spark, sf_dir, "fx_words"), 5.0, 0.6).withColumnRenamed("end", "end_")


def _merge(source: str, order: str, least: str) -> str:
    return f"""o AS (SELECT *, row_number() OVER w AS i, lag(speaker) OVER w AS before FROM {source} WINDOW w AS (PARTITION BY video_id ORDER BY {order})),
    g AS (SELECT *, sum(CASE WHEN i = 1 OR end_ - start >= {least}::double OR speaker IS DISTINCT FROM before THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY i) AS grp FROM o),
    merged AS (SELECT video_id, grp, arg_min(start, i) AS start, max(end_) AS end_, arg_min(speaker, i) AS speaker, arg_min(split_reason, i) || repeat('+merged_short', (count(*) - 1)::bigint) AS split_reason,
        CASE WHEN count(*) = 1 THEN any_value(text) ELSE {_TIGHTEN.format("string_agg(trim(text, chr(32) || chr(9) || chr(10) || chr(13)), ' ' ORDER BY i)")} END AS text,
        arg_min(key, i) AS key FROM g GROUP BY video_id, grp)"""


@query(f"""src AS (SELECT video_id, seq, seq AS key, start, end_, CASE WHEN seq % 3 = 0 THEN 'x' ELSE speaker END AS speaker, text, 'tail' AS split_reason FROM fx_segments),
    {_merge('src', 'start, end_, seq', '20.0')} SELECT video_id, key AS seq, start, end_, speaker, text, split_reason FROM merged""")
def merge_short_segments(spark, sf_dir):
    own = fixture(spark, sf_dir, "fx_segments").select("video_id", "seq", "start", "end", F.expr("case when seq % 3 = 0 then 'x' else speaker end").alias("speaker"), "text", F.lit("tail").alias("split_reason"))
    return segments.merge_short(own, ["start", "end", "seq"], 20.0).withColumnRenamed("end", "end_")


@query(f"""{_SPLIT}, src AS (SELECT s.video_id, s.utterance_id AS key, s.chunk, s.utterance_id, {_round('s.start', 3)} AS start, {_round('s.end_', 3)} AS end_, f.speaker, s.text, s.split_reason
        FROM split s JOIN fx_segments f ON f.video_id = s.video_id AND f.seq = s.utterance_id),
    {_merge('src', 'start, end_, utterance_id, chunk', '3.0')}
    SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY grp) AS segment_id, start, end_, speaker, text, split_reason, key AS parent_utterance_id, 'assemblyai' AS asr_provider FROM merged""", recursive=True)
def refine_segments(spark, sf_dir):
    said = fixture(spark, sf_dir, "fx_segments").select("video_id", F.col("seq").alias("utterance_id"), "start", "end", "text", "speaker", F.lit(None).cast("double").alias("speaker_confidence"))
    out = segments.refine_segments(said, fixture(spark, sf_dir, "fx_words"), 5.0, 0.6, 3.0)
    return out.select("video_id", F.col("segment_id").cast("long").alias("segment_id"), "start", F.col("end").alias("end_"), "speaker", "text", "split_reason", "parent_utterance_id", "asr_provider")


# --- frame policy -------------------------------------------------------------------------------------------------


def _greedy(source: str, epsilon: str, compare: str = ">", name: str = "kept") -> str:
    return f"""{name}_o AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY timestamp, seq) AS rn FROM {source}),
    {name} AS (SELECT video_id, rn, timestamp, seq FROM {name}_o WHERE rn = 1
        UNION ALL SELECT video_id, rn, timestamp, seq FROM (SELECT o.video_id, o.rn, o.timestamp, o.seq, row_number() OVER (PARTITION BY o.video_id ORDER BY o.rn) AS k
            FROM {name} r JOIN {name}_o o ON o.video_id = r.video_id AND o.rn > r.rn AND abs(o.timestamp - r.timestamp) {compare} {epsilon}::double) WHERE k = 1)"""


@query(f"{_greedy('fx_frames', '2.5')} SELECT video_id, seq, timestamp, row_number() OVER (PARTITION BY video_id ORDER BY rn) AS original_index FROM kept", recursive=True)
def merge_epsilon(spark, sf_dir):
    out = frames.merge_entries(fixture(spark, sf_dir, "fx_frames"), 2.5)
    return out.select("video_id", "seq", "timestamp", F.col("original_index").cast("long").alias("original_index"))


@query(f"{_greedy('fx_frames', '0.2')} SELECT video_id, timestamp FROM kept", recursive=True)
def unique_ts(spark, sf_dir):
    return scan.keep_spaced(fixture(spark, sf_dir, "fx_frames").select("video_id", "timestamp", "seq"), 0.2).select("video_id", "timestamp")


_GRID = "fx_grid AS (SELECT video_id, seq, round(timestamp) AS timestamp FROM fx_frames)"


@query(f"{_GRID}, {_greedy('fx_grid', '3.0', '>=')} SELECT video_id, seq, timestamp FROM kept", recursive=True)
def legacy_merge(spark, sf_dir):
    grid = fixture(spark, sf_dir, "fx_frames").select("video_id", "seq", F.round("timestamp").alias("timestamp"))
    return frames.merge_legacy(grid, 3.0).select("video_id", "seq", "timestamp")


@query(f"""{_greedy('fx_frames', '2.0')}, a AS (SELECT video_id, unnest([0.0::double, greatest(0.0, duration - 0.5)]) AS anchor FROM fx_videos WHERE duration > 0)
    SELECT video_id, {_round('anchor', 3)} AS timestamp FROM a WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.video_id = a.video_id AND abs(a.anchor - k.timestamp) <= 2.0::double)""", recursive=True)
def anchors(spark, sf_dir):
    return frames.required_anchors(fixture(spark, sf_dir, "fx_frames"), fixture(spark, sf_dir, "fx_videos"), 2.0)


@query(f"""pts AS (SELECT video_id, timestamp, seq FROM fx_frames UNION ALL SELECT video_id, unnest([0.0::double, greatest(0.0, duration - 0.5)]), 4611686018427387904 FROM fx_videos WHERE duration > 0),
    {_greedy('pts', '0.2')}, gaps AS (SELECT *, lead(timestamp) OVER (PARTITION BY video_id ORDER BY rn) AS until FROM kept),
    fill AS (SELECT video_id, until, timestamp + k * 8.0::double AS p FROM (SELECT *, unnest(generate_series(1, floor((until - timestamp) / 8.0::double)::bigint)) AS k FROM gaps WHERE until - timestamp > 8.0))
    SELECT video_id, {_round('p', 3)} AS timestamp FROM fill WHERE p < until - 0.2::double""", recursive=True)
def gap_fill(spark, sf_dir):
    return frames.gap_fill(fixture(spark, sf_dir, "fx_frames"), fixture(spark, sf_dir, "fx_videos"), 8.0)


@query(f"""SELECT video_id, {_round("i * 15.0::double", 3)} AS timestamp, 'sample' AS source, (i + 1)::int AS original_index
    FROM (SELECT video_id, unnest(generate_series(0, ceil(duration / 15.0)::bigint - 1)) AS i FROM fx_videos WHERE duration > 0)""")
def sample_grid(spark, sf_dir):
    return frames.sample_grid(fixture(spark, sf_dir, "fx_videos"), 15.0)


@query("""SELECT video_id, seq, timestamp FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY timestamp, seq) - 1 AS i, greatest(1, count(*) OVER (PARTITION BY video_id) // 5) AS step FROM fx_frames)
    WHERE i % step = 0 AND i // step < 5""")
def systematic_sample(spark, sf_dir):
    return frames.systematic_sample(fixture(spark, sf_dir, "fx_frames")).select("video_id", "seq", "timestamp")


@query(f"SELECT DISTINCT video_id, {_round('timestamp - 100', 2)} AS timestamp FROM fx_frames WHERE timestamp >= 100")
def lookup_points(spark, sf_dir):
    # Points are tested before they are rounded: -0.001 is negative, though it would round to 0.
    late = fixture(spark, sf_dir, "fx_frames").filter("timestamp >= 100")
    return frames.lookup_points(late.select("video_id", numbers.round_to(F.col("timestamp") - 100, 2).alias("timestamp")))


@query(f"""f AS (SELECT video_id, seq, row_number() OVER (PARTITION BY video_id ORDER BY seq) AS k FROM fx_frames), p AS (SELECT video_id, k, timestamp FROM (SELECT video_id, timestamp, row_number() OVER (PARTITION BY video_id ORDER BY timestamp, seq) AS k FROM fx_frames) WHERE k % 10 <> 0)
    SELECT f.video_id, f.seq, {_round('coalesce(p.timestamp, (f.k - 1)::double)', 3)} AS timestamp FROM f LEFT JOIN p USING (video_id, k)""")
def positional_pairs(spark, sf_dir):
    own = fixture(spark, sf_dir, "fx_frames")
    number = lambda *order: F.expr(f"row_number() over (partition by video_id order by {', '.join(order)})")
    stamps = own.select("video_id", "timestamp", number("timestamp", "seq").alias("k")).filter("k % 10 <> 0")
    return frames.pair_by_position(own.select("video_id", "seq", number("seq").alias("k")), stamps).select("video_id", "seq", "timestamp")


# --- near-duplicates of frames ------------------------------------------------------------------------------------


def _suppress(transition: str) -> str:
    keep = f"d IS NULL OR ({transition})"
    return f"""o AS (SELECT f.*, h.hash_hi AS hi, h.hash_lo AS lo, row_number() OVER (PARTITION BY video_id ORDER BY timestamp, seq) AS rn FROM fx_frames f JOIN fx_hash h USING (vec_id)),
    rec AS (SELECT video_id, rn, seq, timestamp, [{{'t': timestamp, 'hi': hi, 'lo': lo, 'p': frame_path, 's': seq}}] AS held, 'kept' AS status, NULL::varchar AS duplicate_of, NULL::bigint AS hash_distance FROM o WHERE rn = 1
        UNION ALL SELECT video_id, rn, seq, timestamp, CASE WHEN {keep} THEN list_append(held, {{'t': timestamp, 'hi': hi, 'lo': lo, 'p': frame_path, 's': seq}}) ELSE held END,
            CASE WHEN {keep} THEN 'kept' ELSE 'dropped' END, d.p, bit_count(xor(d.hi, hi)) + bit_count(xor(d.lo, lo))
        FROM (SELECT n.video_id, n.rn, n.seq, n.timestamp, n.hi, n.lo, n.frame_path, r.held,
                list_filter(r.held, lambda x: n.timestamp - x.t <= 10.0 AND bit_count(xor(x.hi, n.hi)) + bit_count(xor(x.lo, n.lo)) <= 28)[-1] AS d
              FROM rec r JOIN o n ON n.video_id = r.video_id AND n.rn = r.rn + 1))"""


def _marked(spark, sf_dir, **more):
    own = fixture(spark, sf_dir, "fx_frames").select("video_id", "timestamp", "seq", "frame_path", "vec_id")
    hashed = own.join(fixture(spark, sf_dir, "fx_hash"), "vec_id")
    return scan.suppress_near_duplicates(hashed, 10.0, 28, **more)


@query(f"{_suppress('false')} SELECT video_id, seq, timestamp FROM rec WHERE status = 'kept'", recursive=True)
def dedupe_kept(spark, sf_dir):
    return _marked(spark, sf_dir).filter("status = 'kept'").select("video_id", "seq", "timestamp")


@query(f"{_suppress('false')} SELECT video_id, seq, duplicate_of, hash_distance FROM rec WHERE status = 'dropped'", recursive=True)
def dedupe_dropped(spark, sf_dir):
    return _marked(spark, sf_dir).filter("status = 'dropped'").select("video_id", "seq", "duplicate_of", "hash_distance")


def _synthetic_delta(row, kept):
    return (row["seq"] * 7 + kept["seq"] * 3) % 20 / 1000.0


@query(f"{_suppress('timestamp - d.t <= 2.5 AND ((seq * 7 + d.s * 3) % 20) / 1000.0 >= 0.012')} SELECT video_id, seq, status, duplicate_of, coalesce(hash_distance, -1) AS hash_distance FROM rec", recursive=True)
def dedupe_transition(spark, sf_dir):
    return _marked(spark, sf_dir, delta=_synthetic_delta).select("video_id", "seq", "status", "duplicate_of", F.coalesce("hash_distance", F.lit(-1)).alias("hash_distance"))


_FETCHED = ("(video_id * 2654435761 + {0} * 40503) % 4294967296", "(video_id * 40503 + {0} * 2654435761) % 4294967296")


def _settled(source: str, name: str) -> str:
    """Near-duplicates of source (video_id, seq, timestamp, frame_path, hi, lo) marked in name, row by row."""
    own = "{'t': timestamp, 'hi': hi, 'lo': lo}"
    return f"""{name}_o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY timestamp, seq) AS rn FROM {source}),
    {name} AS (SELECT video_id, rn, seq, timestamp, frame_path, hi, lo, [{own}] AS held, 'kept' AS status FROM {name}_o WHERE rn = 1
        UNION ALL SELECT video_id, rn, seq, timestamp, frame_path, hi, lo, CASE WHEN n = 0 THEN list_append(held, {own}) ELSE held END, CASE WHEN n = 0 THEN 'kept' ELSE 'dropped' END
        FROM (SELECT o.*, r.held, len(list_filter(r.held, lambda x: o.timestamp - x.t <= 10.0 AND bit_count(xor(x.hi, o.hi)) + bit_count(xor(x.lo, o.lo)) <= 28)) AS n
              FROM {name} r JOIN {name}_o o ON o.video_id = r.video_id AND o.rn = r.rn + 1))"""


def _round_of(k: int) -> str:
    own, hashes = "video_id, timestamp, seq, frame_path, hi, lo", ", ".join(x.format("round(timestamp * 1000)::bigint") for x in _FETCHED)
    return f"""pts{k} AS (SELECT video_id, timestamp, seq FROM k{k - 1} UNION ALL SELECT video_id, unnest([0.0::double, greatest(0.0, duration - 0.5)]), 4611686018427387904 FROM fx_videos WHERE duration > 0),
    {_greedy(f"pts{k}", "0.2", name=f"g{k}")},
    gaps{k} AS (SELECT *, lead(timestamp) OVER (PARTITION BY video_id ORDER BY rn) AS until FROM g{k}),
    fill{k} AS (SELECT video_id, until, timestamp + i * 8.0::double AS p FROM (SELECT *, unnest(generate_series(1, floor((until - timestamp) / 8.0::double)::bigint)) AS i FROM gaps{k} WHERE until - timestamp > 8.0)),
    at{k} AS (SELECT video_id, {_round("p", 3)} AS timestamp FROM fill{k} WHERE p < until - 0.2::double),
    found{k} AS MATERIALIZED (SELECT video_id, timestamp, 'fill/' || printf('%010.3f', timestamp) AS frame_path, {hashes.replace(", (", " AS hi, (", 1)} AS lo FROM at{k}),
    u{k} AS MATERIALIZED (SELECT video_id, timestamp, row_number() OVER (PARTITION BY video_id ORDER BY src, seq, timestamp) AS seq, frame_path, hi, lo
        FROM (SELECT 0 AS src, {own} FROM k{k - 1} WHERE EXISTS (SELECT 1 FROM found{k}) UNION ALL SELECT 1, video_id, timestamp, 0, frame_path, hi, lo FROM found{k})),
    {_greedy(f"u{k}", "0.05", name=f"m{k}")},
    mm{k} AS (SELECT u{k}.* FROM u{k} JOIN m{k} USING (video_id, seq)),
    {_settled(f"mm{k}", f"rec{k}")},
    k{k} AS MATERIALIZED (SELECT {own} FROM rec{k} WHERE status = 'kept' UNION ALL SELECT {own} FROM k{k - 1} WHERE NOT EXISTS (SELECT 1 FROM found{k}))"""


@query(f"""b0 AS (SELECT f.video_id, f.timestamp, f.seq, f.frame_path, h.hash_hi AS hi, h.hash_lo AS lo FROM fx_frames f JOIN fx_hash h USING (vec_id)),
    {_settled("b0", "rec0")}, k0 AS MATERIALIZED (SELECT video_id, timestamp, seq, frame_path, hi, lo FROM rec0 WHERE status = 'kept'), {", ".join(map(_round_of, (1, 2, 3)))}
    SELECT video_id, timestamp, frame_path, 'kept' AS status, NULL::varchar AS dropped_phase FROM k3 UNION ALL {" UNION ALL ".join(f"SELECT video_id, timestamp, frame_path, status, 'gap_backfill_round_{k}' FROM rec{k} WHERE status = 'dropped'" for k in (1, 2, 3))}""", recursive=True)
def backfill_rounds(spark, sf_dir):
    own = fixture(spark, sf_dir, "fx_frames").select("video_id", "timestamp", "seq", "frame_path", "vec_id").join(fixture(spark, sf_dir, "fx_hash"), "vec_id")
    suppress = lambda x: scan.suppress_near_duplicates(x.drop("status", "duplicate_of", "hash_distance", "drop_blocked_reason", "candidate_delta_ratio"), 10.0, 28)
    hashes = {x: F.expr(y.format("cast(round(timestamp * 1000) as bigint)")) for x, y in zip(("hash_hi", "hash_lo"), _FETCHED)}

    def fetch(points: DataFrame) -> DataFrame:
        made = points.withColumns({"seq": F.lit(0).cast("long"), "frame_path": F.concat(F.lit("fill/"), text.file_stamp(F.col("timestamp"))), "vec_id": F.lit(-1).cast("long")})
        return made.withColumns(hashes)

    kept = suppress(own).filter("status = 'kept'").select(*own.columns)
    out = frames.backfill(kept, fixture(spark, sf_dir, "fx_videos"), fetch, suppress, 8.0)
    return out.select("video_id", "timestamp", "frame_path", "status", "dropped_phase")


# --- events and logs ----------------------------------------------------------------------------------------------


@query(f"""e AS (SELECT row_number() OVER (ORDER BY event_id) AS i, event_id, (epoch_us(ts) % 300000000) / 1000000.0::double AS t, event_type, props FROM events)
    SELECT i AS event_id, {_round('t', 3)} AS timestamp, event_type, json_extract_string(props, '$.k') AS k FROM e WHERE event_type IN ('click', 'scroll', 'key')""".replace("e AS", "WITH e AS", 1))
def events_clean(spark, sf_dir):
    raw = scan.numbered(spark.read.parquet(f"{sf_dir}/events.parquet"), "event_id", 1 << 20, "position")
    t = F.expr("(unix_micros(cast(ts as timestamp)) % 300000000) / 1000000.0D")
    fields = F.create_map(F.lit("ts"), t.cast("string"), F.lit("type"), F.concat(F.lit(" "), F.upper("event_type")), F.lit("payload"), F.col("props"))
    out = event_logs.clean_events(raw.select("position", fields.alias("fields")))
    return out.select(F.col("event_id").cast("long").alias("event_id"), "timestamp", "event_type", F.get_json_object("payload", "$.k").alias("k"))


_LOG = """case seq % 5 when 0 then concat('[Parsed_showinfo_1] n: ', cast(seq as {0}), ' pts_time:', cast(timestamp as {0}), ' fmt') when 1 then concat('frame= ', cast(seq as {0}))
    when 2 then concat('[Parsed_showinfo_1] n: 1 pts_time:', cast(seq % 9 as {0}), 'e1') when 3 then 'showinfo pts_time:--' else concat('pts_time:', cast(seq as {0})) end"""


@query(f"""SELECT id, try_cast(nullif(regexp_extract(line, 'pts_time:([0-9eE+\\-.]+)', 1), '') AS double) AS pts FROM (SELECT seq AS id, {_LOG.format('varchar')} AS line FROM fx_frames)
    WHERE contains(line, 'showinfo') AND contains(line, 'pts_time:') AND pts IS NOT NULL""")
def showinfo_parse(spark, sf_dir):
    lines = fixture(spark, sf_dir, "fx_frames").select(F.col("seq").alias("id"), F.expr(_LOG.format("string")).alias("value"))
    return showinfo.parse_lines(lines).select("id", "pts")


_LINE = """case event_id % 6 when 0 then concat('{{"ts": ', cast(event_id / 4.0{1} as {0}), ', "type": "click", "payload": {{"x": ', cast(event_id as {0}), '}}}}') when 1 then concat('{{"time": "', cast(event_id as {0}), '.25", "event": "KEY", "code": "a"}}')
    when 2 then '{{"ts": "bad", "type": "click"}}' when 3 then 'not json' when 4 then '' else concat('{{"timestamp": ', cast(event_id as {0}), '.5, "type": "scroll", "payload": "far"}}') end"""


@query("""SELECT event_id::int + 1 AS event_id, CASE event_id % 6 WHEN 0 THEN event_id / 4.0::double WHEN 1 THEN event_id + 0.25::double ELSE event_id + 0.5::double END AS timestamp,
    CASE event_id % 6 WHEN 0 THEN 'click' WHEN 1 THEN 'key' ELSE 'scroll' END AS event_type, CASE event_id % 6 WHEN 0 THEN '{"x":' || event_id || '}' WHEN 1 THEN '{"code":"a"}' ELSE '{"raw":"far"}' END AS payload
    FROM events WHERE event_id % 6 IN (0, 1, 5)""")
def events_formats(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/events.parquet").select((F.col("event_id") + 1).cast("int").alias("position"), F.expr(_LINE.format("string", "D")).alias("value"))
    return event_logs.from_lines(lines, strict=False)


#: Files that events are written to, one JSON array each, in one line.
_ARRAYS = 8


@query(f"""WITH e AS (SELECT event_id, user_id % {_ARRAYS} AS bucket, row_number() OVER (PARTITION BY user_id % {_ARRAYS} ORDER BY event_id) AS i, (epoch_us(ts) % 300000000) / 1000000.0::double AS t, event_type, props FROM events)
    SELECT bucket::int AS bucket, i AS event_id, {_round('t', 3)} AS timestamp, event_type, json_extract_string(props, '$.k') AS k FROM e WHERE event_type IN ('click', 'scroll', 'key')""")
def events_arrays(spark, sf_dir):
    """Events written as JSON arrays and read back in splits; each array is numbered by itself."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("bucket", F.expr(f"cast(user_id % {_ARRAYS} as int)"))
    ends = rows.groupBy("bucket").agg(F.min("event_id").alias("first"), F.max("event_id").alias("last"))
    payload = F.struct("bucket", F.get_json_object("props", "$.k").alias("k"), F.lit('}, {"[').alias("mark"))
    logged = F.to_json(F.struct(F.expr("(unix_micros(cast(ts as timestamp)) % 300000000) / 1000000.0D").alias("ts"), F.upper("event_type").alias("type"), payload.alias("payload")))
    value = F.concat(F.when(F.col("event_id") == F.col("first"), "[").otherwise(","), logged, F.when(F.col("event_id") == F.col("last"), "]").otherwise(""))
    lines = rows.join(F.broadcast(ends), "bucket").select("bucket", "event_id", value.alias("value"))
    path = _written(spark, "arrays")
    lines.repartition("bucket").sortWithinPartitions("bucket", "event_id").select("bucket", "value").write.option("lineSep", " ").partitionBy("bucket").text(path)
    out = event_logs.from_array(json_arrays.read_array(spark, path))
    return out.select(F.get_json_object("payload", "$.bucket").cast("int").alias("bucket"), F.col("event_id").cast("long").alias("event_id"), "timestamp", "event_type", F.get_json_object("payload", "$.k").alias("k"))


# --- report -------------------------------------------------------------------------------------------------------


_COVERAGE = """c AS (SELECT video_id, count(*) AS n, max(timestamp - prev) AS gap, max(timestamp) AS last FROM (SELECT video_id, timestamp, lag(timestamp, 1, 0.0::double) OVER (PARTITION BY video_id ORDER BY timestamp) AS prev FROM fx_frames) GROUP BY video_id),
    cov AS (SELECT v.video_id, coalesce(n, 0) AS kept_frames, CASE WHEN n IS NULL THEN duration ELSE greatest(0.0, gap, greatest(0.0, duration - last)) END AS max_gap_sec, CASE WHEN n IS NULL THEN duration ELSE greatest(0.0, duration - last) END AS tail_gap_sec FROM fx_videos v LEFT JOIN c USING (video_id))"""
_P95 = "p AS (SELECT video_id, count(*) AS segment_count, list_sort(list(end_ - start))[floor(0.95::double * (count(*) - 1))::bigint + 1] AS p95_segment_duration_sec FROM fx_segments GROUP BY video_id)"
_RATES = f"""{_RANKED}, att AS (SELECT s.video_id, count(*) AS dataset_records, count(r.seq) AS attached_records, count(r.seq) / count(*)::double AS attach_rate
    FROM fx_segments s LEFT JOIN ranked r ON s.video_id = r.video_id AND s.seq = r.seq AND r.rank = 1 GROUP BY s.video_id)"""
_STATS = """ocr AS (SELECT video_id, count(*) AS frame_records, count(*) FILTER (trim(ocr_text) <> '') / count(*)::double AS ocr_nonempty_rate, count(*) FILTER (coalesce(quality_score, 0) < 0.55) / count(*)::double AS low_quality_rate,
    count(*) FILTER (seq % 17 = 0) AS provider_error_count, count(*) FILTER (seq % 5 = 0) AS fallback_used_count, sum(seq % 4 - CASE WHEN seq % 4 > 0 THEN 1 ELSE 0 END)::bigint AS retry_invocations,
    count(*) FILTER (seq % 4 = 3) AS azure_candidate_count FROM fx_frames GROUP BY video_id)"""


def _frame_ocr(spark, sf_dir):
    providers = F.expr("slice(array('google', 'google', 'azure'), 1, cast(seq % 4 as int))")
    return fixture(spark, sf_dir, "fx_frames").select("video_id", F.col("ocr_text").alias("text"), "quality_score", F.expr("if(seq % 17 = 0, 1, 0)").alias("n_errors"), F.expr("seq % 5 = 0").alias("fallback_used"), providers.alias("providers"))


def _dataset(spark, sf_dir):
    return align.build_dataset(fixture(spark, sf_dir, "fx_segments"), fixture(spark, sf_dir, "fx_frames"))


@query(f"{_COVERAGE} SELECT video_id, kept_frames, {_round('max_gap_sec', 3)} AS max_gap_sec, {_round('tail_gap_sec', 3)} AS tail_gap_sec FROM cov")
def coverage_gaps(spark, sf_dir):
    out = report.coverage(fixture(spark, sf_dir, "fx_frames"), fixture(spark, sf_dir, "fx_videos"))
    return out.select("video_id", "kept_frames", *(numbers.round_to(F.col(x), 3).alias(x) for x in ("max_gap_sec", "tail_gap_sec")))


@query(f"{_P95} SELECT video_id, segment_count, {_round('p95_segment_duration_sec', 3)} AS p95_segment_duration_sec FROM p")
def p95_segment(spark, sf_dir):
    return report.p95_durations(fixture(spark, sf_dir, "fx_segments")).withColumn("p95_segment_duration_sec", numbers.round_to(F.col("p95_segment_duration_sec"), 3))


@query(f"{_RATES} SELECT video_id, dataset_records, attached_records, {_round('attach_rate', 4)} AS attach_rate FROM att")
def attach_rate(spark, sf_dir):
    return report.attach_rates(_dataset(spark, sf_dir)).withColumn("attach_rate", numbers.round_to(F.col("attach_rate"), 4))


@query(f"{_STATS} SELECT * REPLACE ({_round('ocr_nonempty_rate', 4)} AS ocr_nonempty_rate, {_round('low_quality_rate', 4)} AS low_quality_rate) FROM ocr")
def ocr_stats(spark, sf_dir):
    return report.ocr_stats(_frame_ocr(spark, sf_dir)).withColumns({x: numbers.round_to(F.col(x), 4) for x in ("ocr_nonempty_rate", "low_quality_rate")})


_REPORT = f"""{_COVERAGE}, {_P95}, {_RATES}, {_STATS},
    rep AS (SELECT v.video_id, {_round('v.duration', 3)} AS duration_seconds, 45.0::double AS window_seconds, kept_frames, {_round('max_gap_sec', 3)} AS max_gap_sec, {_round('tail_gap_sec', 3)} AS tail_gap_sec,
        coalesce(segment_count, 0) AS segment_count, {_round('coalesce(p95_segment_duration_sec, 0)', 3)} AS p95_segment_duration_sec, coalesce(dataset_records, 0) AS dataset_records, coalesce(attached_records, 0) AS attached_records,
        {_round('coalesce(attach_rate, 0)', 4)} AS attach_rate, coalesce(frame_records, 0) AS frame_records, {_round('coalesce(ocr_nonempty_rate, 0)', 4)} AS ocr_nonempty_rate, {_round('coalesce(low_quality_rate, 0)', 4)} AS low_quality_rate,
        coalesce(provider_error_count, 0) AS provider_error_count, coalesce(fallback_used_count, 0) AS fallback_used_count, coalesce(retry_invocations, 0) AS retry_invocations, coalesce(azure_candidate_count, 0) AS azure_candidate_count
        FROM fx_videos v LEFT JOIN cov USING (video_id) LEFT JOIN p USING (video_id) LEFT JOIN att USING (video_id) LEFT JOIN ocr USING (video_id))"""


def _report(spark, sf_dir):
    own = fixture(spark, sf_dir, "fx_frames")
    return report.quality_report(fixture(spark, sf_dir, "fx_videos"), own, fixture(spark, sf_dir, "fx_segments"), _dataset(spark, sf_dir), _frame_ocr(spark, sf_dir))


@query(f"{_REPORT} SELECT * FROM rep")
def quality_report(spark, sf_dir):
    return _report(spark, sf_dir)


@query(_REPORT + " SELECT video_id, name, round(observed::decimal(30,12), 4)::double AS observed, operator, target, CASE operator WHEN '>=' THEN observed >= target ELSE observed <= target END AS passed FROM (" + " UNION ALL ".join(
    f"SELECT video_id, '{name}' AS name, {name}::double AS observed, '{op}' AS operator, {target}::double AS target FROM rep" for name, op, target in report.GATES) + ")")
def quality_gates(spark, sf_dir):
    return report.evaluate_gates(_report(spark, sf_dir))


# --- tuning -------------------------------------------------------------------------------------------------------

_PROBES = f"""sc AS (SELECT video_id, count(*) AS n FROM fx_frames WHERE source = 'scene' GROUP BY video_id),
    sy AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY timestamp, seq) - 1 AS i, greatest(1, count(*) OVER (PARTITION BY video_id) // 5) AS step FROM fx_frames WHERE source = 'sample'),
    tx AS (SELECT video_id, avg(length(ocr_text)) AS len, {_round("sum(coalesce(avg_conf, 50.0)::decimal(20,6))::double / count(*)", 6)} AS conf FROM sy WHERE i % step = 0 AND i // step < 5 GROUP BY video_id),
    pr AS (SELECT v.*, {_round("coalesce(n, 0) / greatest(duration / 60.0::double, 0.01)", 6)} AS scene_changes_per_minute, {_round("coalesce(len, 200.0) * CASE WHEN v.video_id % 2 = 0 THEN 10 ELSE 1 END", 6)} AS avg_text_length, coalesce(conf, 70.0) AS avg_ocr_confidence
        FROM fx_videos v LEFT JOIN sc USING (video_id) LEFT JOIN tx USING (video_id))"""
_TUNED = f"""{_PROBES}, b AS (SELECT *, CASE WHEN scene_changes_per_minute > 6 THEN 5.0 WHEN scene_changes_per_minute > 2 THEN 10.0 ELSE 20.0 END AS base FROM pr),
    tn AS (SELECT video_id, greatest(CASE WHEN duration < 120 THEN greatest(3.0, least(base, 5.0)) ELSE base END, CASE WHEN duration > 1800 THEN 15.0 ELSE 0.0 END)::double AS periodic_interval_seconds,
        CASE WHEN height < 720 THEN 3.0 WHEN height <= 1080 THEN 2.0 ELSE 1.5 END::double AS ocr_scale, CASE WHEN avg_text_length < 100 THEN 'none' ELSE 'preset' END AS ocr_crops,
        CASE WHEN duration > 1800 THEN 3.0 WHEN duration < 120 THEN 1.5 ELSE 2.0 END::double AS dedupe_time_gap_sec, CASE WHEN duration > 1800 THEN 8 WHEN duration < 120 THEN 5 ELSE 6 END AS dedupe_hash_threshold,
        CASE WHEN height < 720 THEN 'low res (' WHEN height <= 1080 THEN 'HD (' ELSE 'high res (' END || height || 'p)' AS scale_reason FROM b)"""


def _read_samples(own):
    """The frames whose text a probe reads: a few of the sampled ones, evenly over the recording."""
    return frames.systematic_sample(own.filter("source = 'sample'")).select("video_id", F.col("ocr_text").alias("text"), F.col("avg_conf").alias("conf"))


def _probes(spark, sf_dir):
    own = fixture(spark, sf_dir, "fx_frames")
    samples = _read_samples(own)
    out = tuning.probe_rates(fixture(spark, sf_dir, "fx_videos"), own.filter("source = 'scene'"), samples)
    scaled = F.col("avg_text_length") * F.expr("case when video_id % 2 = 0 then 10 else 1 end")
    return out.withColumns({"scene_changes_per_minute": numbers.round_to(F.col("scene_changes_per_minute"), 6), "avg_text_length": numbers.round_to(scaled, 6), "avg_ocr_confidence": numbers.round_to(F.col("avg_ocr_confidence"), 6)})


@query(f"{_PROBES} SELECT video_id, scene_changes_per_minute, avg_text_length, avg_ocr_confidence FROM pr")
def probe_rates(spark, sf_dir):
    return _probes(spark, sf_dir).select("video_id", "scene_changes_per_minute", "avg_text_length", "avg_ocr_confidence")


@query(f"{_TUNED} SELECT * FROM tn")
def tune_params(spark, sf_dir):
    return tuning.tune(_probes(spark, sf_dir)).select("video_id", "periodic_interval_seconds", "ocr_scale", "ocr_crops", "dedupe_time_gap_sec", "dedupe_hash_threshold", "scale_reason")


@query(f"""{_TUNED}, long AS (SELECT video_id, 'periodic_interval_seconds' AS parameter, '15.0' AS default_value, periodic_interval_seconds::varchar AS tuned_value FROM tn
    UNION ALL SELECT video_id, 'max_frame_gap_seconds', '15.0', periodic_interval_seconds::varchar FROM tn UNION ALL SELECT video_id, 'ocr_scale', '2.0', ocr_scale::varchar FROM tn UNION ALL SELECT video_id, 'ocr_crops', 'preset', ocr_crops FROM tn
    UNION ALL SELECT video_id, 'dedupe_time_gap_sec', '2.0', dedupe_time_gap_sec::varchar FROM tn UNION ALL SELECT video_id, 'dedupe_hash_threshold', '6', dedupe_hash_threshold::varchar FROM tn)
    SELECT *, default_value <> tuned_value AS changed FROM long""")
def tune_diff(spark, sf_dir):
    return tuning.compare_with_defaults(tuning.tune(_probes(spark, sf_dir)))


_REACHED = {"a": "video_id % 2 = 0", "g": "video_id % 3 <> 0", "z": "video_id % 5 < 3"}


@query(f"""SELECT video_id, CASE WHEN a THEN 'assemblyai' ELSE 'whisper' END AS transcribe_provider, CASE WHEN g THEN 'google' ELSE 'tesseract' END AS ocr_provider, CASE WHEN g AND z THEN 'azure' ELSE 'none' END AS ocr_fallback_provider
    FROM (SELECT video_id, {", ".join(f"{y} AS {x}" for x, y in _REACHED.items())} FROM fx_videos)""")
def provider_stack(spark, sf_dir):
    stack = tuning.provider_stack(*map(F.expr, _REACHED.values()))
    return fixture(spark, sf_dir, "fx_videos").select("video_id", stack.alias("p")).select("video_id", "p.*")


@query("""SELECT video_id, seq, CASE WHEN starts_with(p, '/data/out/') THEN substring(p, 11) ELSE p END AS frame_path FROM (SELECT video_id, seq, CASE WHEN seq % 3 = 0 THEN '/data/out/' ELSE '/other/' END || frame_path AS p FROM fx_frames)""")
def relativize(spark, sf_dir):
    p = F.concat(F.expr("case when seq % 3 = 0 then '/data/out/' else '/other/' end"), F.col("frame_path"))
    return fixture(spark, sf_dir, "fx_frames").select("video_id", "seq", text.relative_path(p, "/data/out").alias("frame_path"))


_FPS_LINE = "case video_id % 6 when 0 then concat('1280,', cast(height as {0}), ',30000/1001') when 1 then '' when 2 then concat('640,', cast(height as {0}), ',30/0') when 3 then 'x,480,25' when 4 then concat(cast(video_id as {0}), ',20,1000/1') else '10,20,a/b' end"


@query("""SELECT video_id, CASE video_id % 6 WHEN 0 THEN 1280 WHEN 2 THEN 640 WHEN 4 THEN video_id WHEN 5 THEN 10 ELSE 1920 END::int AS width, CASE video_id % 6 WHEN 1 THEN 1080 WHEN 3 THEN 480 WHEN 4 THEN 20 WHEN 5 THEN 20 ELSE height END::int AS height,
    CASE video_id % 6 WHEN 0 THEN 30000 / 1001.0::double WHEN 3 THEN 25.0 WHEN 4 THEN 240.0 ELSE 30.0 END::double AS fps FROM fx_videos""")
def fps_parse(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_videos").select("video_id", tuning.parse_stream_line(F.expr(_FPS_LINE.format("string"))).alias("s")).select("video_id", "s.*")


@query("SELECT video_id, seq, timestamp FROM fx_frames WHERE timestamp < least(200.0::double, 1.5 * 60.0)")
def trim_max_seconds(spark, sf_dir):
    limit = numbers.trim_seconds(F.lit(200.0), F.lit(1.5))
    return fixture(spark, sf_dir, "fx_frames").filter(F.col("timestamp") < limit).select("video_id", "seq", "timestamp")


# --- images -------------------------------------------------------------------------------------------------------

_PIXEL = "CASE WHEN y >= {s} % 5 * 8 AND y < {s} % 5 * 8 + 6 AND x >= {s} % 7 * 8 AND x < {s} % 7 * 8 + 6 THEN 255 ELSE (7 * x * x + 13 * y * y + x * y * ({v} % 17 + 3) + 31 * {v}) % 256 END"


def _box_weights(n: int, size: int) -> str:
    """What each of size pixels adds to each of n, as a table i, j, w."""
    ratio = size / n
    low, high = f"greatest(i * {ratio}::double, j)", f"least((i + 1) * {ratio}::double, j + 1)"
    return f"(SELECT i, j, ({high} - {low}) / {ratio}::double AS w FROM (SELECT unnest(range({n})) AS i), (SELECT unnest(range({size})) AS j) WHERE {high} > {low})"


@query(f"""WITH v AS (SELECT DISTINCT vec_id AS v FROM embeddings), px AS (SELECT v, y, x, ({_PIXEL.format(s='v', v='v')})::double AS p FROM v, (SELECT unnest(range(48)) AS y), (SELECT unnest(range(64)) AS x)),
    a AS (SELECT v, i, x, sum(w * p) AS p FROM px JOIN {_box_weights(32, 48)} ON j = y GROUP BY v, i, x), b AS (SELECT v, a.i AS y, w.i AS x, sum(w * p) AS p FROM a JOIN {_box_weights(32, 64)} w ON w.j = a.x GROUP BY ALL),
    c AS (SELECT u, i, cos(pi() * u * (2 * i + 1) / 64.0) AS c FROM (SELECT unnest(range(8)) AS u), (SELECT unnest(range(32)) AS i)),
    d AS (SELECT v, u, x, sum(p * c) AS p FROM b JOIN c ON c.i = b.y GROUP BY v, u, x), e AS (SELECT v, d.u AS a, c.u AS b, sum(p * c) AS p FROM d JOIN c ON c.i = d.x GROUP BY ALL),
    m AS (SELECT *, 8 * a + b AS ix, p > median(p) OVER (PARTITION BY v) AS bit FROM e),
    h AS (SELECT v AS vec_id, sum(CASE WHEN bit AND ix < 32 THEN 1::bigint << (31 - ix)::int ELSE 0 END)::bigint AS hash_hi, sum(CASE WHEN bit AND ix >= 32 THEN 1::bigint << (63 - ix)::int ELSE 0 END)::bigint AS hash_lo FROM m GROUP BY v)
    SELECT vec_id, hash_hi, hash_lo, printf('%08x%08x', hash_hi, hash_lo) AS phash_hex FROM h""")
def phash_numpy(spark, sf_dir):
    from ..operators import images

    own = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", F.col("vec_id").alias("seq")).distinct()
    return images.with_phash(images.drawn(own)).select("vec_id", "hash_hi", "hash_lo", "phash_hex")


@query(f"""o AS (SELECT video_id, seq, vec_id, lag(seq) OVER w AS seq0, lag(vec_id) OVER w AS vec0 FROM fx_frames WINDOW w AS (PARTITION BY video_id ORDER BY seq)),
    d AS (SELECT video_id, seq, sum(abs(({_PIXEL.format(s='seq', v='vec_id')}) - ({_PIXEL.format(s='seq0', v='vec0')}))) / (48 * 64 * 255.0::double) AS delta
        FROM o, (SELECT unnest(range(48)) AS y), (SELECT unnest(range(64)) AS x) WHERE seq0 IS NOT NULL GROUP BY ALL)
    SELECT o.video_id, o.seq, {_round("coalesce(delta, 0.0)", 9)} AS delta FROM o LEFT JOIN d USING (video_id, seq)""")
def pixel_delta(spark, sf_dir):
    from ..operators import images, scenes

    own = fixture(spark, sf_dir, "fx_frames").select("video_id", "seq", "vec_id")
    return scenes.pixel_deltas(own, decode=images.drawn).withColumn("delta", numbers.round_to(F.col("delta"), 9))


@query(f"""o AS (SELECT video_id, timestamp, seq, vec_id, lag(seq) OVER w AS seq0, lag(vec_id) OVER w AS vec0 FROM fx_frames WINDOW w AS (PARTITION BY video_id ORDER BY timestamp, seq)),
    d AS (SELECT video_id, seq, sum(abs(({_PIXEL.format(s='seq', v='vec_id')}) - ({_PIXEL.format(s='seq0', v='vec0')}))) * 100.0::double / (48 * 64) / 256 AS delta
        FROM o, (SELECT unnest(range(48)) AS y), (SELECT unnest(range(64)) AS x) WHERE seq0 IS NOT NULL GROUP BY ALL),
    c AS (SELECT video_id, timestamp, seq, coalesce(delta, 0.0) AS change, coalesce(lag(coalesce(delta, 0.0)) OVER (PARTITION BY video_id ORDER BY timestamp, seq), 0.0) AS last FROM o LEFT JOIN d USING (video_id, seq)),
    s AS (SELECT *, least(change, abs(change - last), 100.0) / 100.0 AS score FROM c)
    SELECT video_id, timestamp, seq, {_round("score", 9)} AS score FROM s WHERE score > 0.02::double""")
def scene_changes(spark, sf_dir):
    from ..operators import images, scenes

    own = fixture(spark, sf_dir, "fx_frames").select("video_id", "timestamp", "seq", "vec_id")
    return scenes.scene_changes(own, 0.02, decode=images.drawn).withColumn("score", numbers.round_to(F.col("score"), 9))


@query()
def preprocess(spark, sf_dir):
    from ..operators import images

    own = images.drawn(fixture(spark, sf_dir, "fx_frames").select("video_id", "seq", "vec_id").repartition(tasks(spark)))
    return own.select("video_id", "seq", images.preprocessed(F.col("image")).alias("image")).select("video_id", "seq", "image.height", "image.width", F.sha2("image.data", 256).alias("sha"))


# --- what the larger operators hold ---------------------------------------------------------------------------------


@query("""SELECT video_id, floor(timestamp / 45)::bigint AS window_ix, seq, timestamp, frame_path, ocr_text, avg_conf, ocr_provider, quality_score FROM fx_frames WHERE timestamp >= 0""")
def window_frames(spark, sf_dir):
    out = windows.build_windows(*(fixture(spark, sf_dir, x) for x in ("fx_segments", "fx_frames", "fx_events")))
    return out.select("video_id", "window_ix", F.inline("frames"))


@query(f"""{_RANKED} SELECT video_id, seq, rank, timestamp, frame_path, (SELECT ocr_provider FROM fx_frames f WHERE f.video_id = ranked.video_id AND f.seq = frame_seq) AS ocr_provider,
    (SELECT quality_score FROM fx_frames f WHERE f.video_id = ranked.video_id AND f.seq = frame_seq) AS quality_score, {_round('score', 4)} AS attach_score FROM ranked WHERE rank <= 3""")
def align_candidates(spark, sf_dir):
    out = _dataset(spark, sf_dir).select("video_id", "seq", F.posexplode("frame_candidates").alias("i", "c"))
    return out.select("video_id", "seq", (F.col("i") + 1).cast("long").alias("rank"), "c.*")


@query(f"""r AS (SELECT video_id, seq, CASE WHEN seq % 5 = 0 THEN NULL ELSE start END AS start, end_, trim(CASE WHEN seq % 4 = 0 THEN ' ' ELSE text END, chr(32) || chr(9) || chr(10) || chr(13)) AS text, speaker, seq / 10.0::double AS confidence FROM fx_segments)
    SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY seq) AS utterance_id, {_round('coalesce(start, 0.0)', 3)} AS start, {_round('coalesce(end_, 0.0)', 3)} AS end_, text, speaker, confidence AS speaker_confidence FROM r WHERE text <> ''""")
def normalize_utterances(spark, sf_dir):
    raw = fixture(spark, sf_dir, "fx_segments").withColumns({"start": F.expr("if(seq % 5 = 0, null, start)"), "text": F.expr("if(seq % 4 = 0, ' ', concat(' ', text, '\n'))"), "confidence": F.col("seq") / 10.0})
    out = segments.normalise_utterances(raw)
    return out.withColumn("utterance_id", F.col("utterance_id").cast("long")).withColumnRenamed("end", "end_")


@query("""SELECT video_id, coalesce(string_agg('[' || speaker || ']' || chr(10) || t, chr(10) || chr(10) ORDER BY seq) FILTER (t <> ''), '') AS text
    FROM (SELECT video_id, seq, speaker, CASE WHEN seq % 3 = 1 THEN '' ELSE trim(text, chr(32) || chr(9) || chr(10) || chr(13)) END AS t FROM fx_segments) GROUP BY video_id""")
def labelled_texts(spark, sf_dir):
    said = fixture(spark, sf_dir, "fx_segments").select("video_id", F.struct("seq", F.col("speaker").alias("name"), F.expr("if(seq % 3 = 1, ' ', text)").alias("text")).alias("c"))
    return said.groupBy("video_id").agg(F.sort_array(F.collect_list("c")).alias("cs")).select("video_id", text.labelled_text(F.col("cs")).alias("text"))


@query(f"""w AS (SELECT video_id, utterance_id, CASE WHEN word_ix % 9 = 0 THEN NULL WHEN word_ix % 5 = 0 THEN -1.0 ELSE ((word_ix * 37) % 101) / 100.0::double END AS c FROM fx_words),
    s AS (SELECT video_id, utterance_id, unnest([((word_ix * 13) % 100)::double, CASE WHEN word_ix % 4 = 0 THEN -1.0 ELSE 0.25::double END]) AS c FROM fx_words),
    u AS (SELECT * FROM w UNION ALL SELECT * FROM s UNION ALL SELECT DISTINCT video_id, utterance_id, 0.5::double FROM fx_words UNION ALL SELECT DISTINCT video_id, utterance_id, 88.0::double FROM fx_words)
    SELECT video_id, utterance_id, {_round("sum((CASE WHEN c <= 1 THEN c * 100.0::double ELSE c END)::decimal(30,6))::double / count(*)", 2)} AS avg_conf FROM u WHERE c >= 0 GROUP BY ALL""")
def conf_all_levels(spark, sf_dir):
    word = F.struct("word_ix", F.expr("case when word_ix % 9 = 0 then null when word_ix % 5 = 0 then -1.0D else ((word_ix * 37) % 101) / 100.0D end").alias("confidence"), F.expr("array(named_struct('confidence', cast((word_ix * 13) % 100 as double)), named_struct('confidence', if(word_ix % 4 = 0, -1.0D, 0.25D)))").alias("symbols"))
    own = fixture(spark, sf_dir, "fx_words").groupBy("video_id", "utterance_id").agg(F.sort_array(F.collect_list(F.struct("word_ix", word.alias("w"))), asc=True).alias("ws"))
    words = F.transform("ws", lambda x: x["w"])
    pages = F.array(F.struct(F.lit(0.5).alias("confidence"), F.array(F.struct(F.lit(None).cast("double").alias("confidence"), F.array(F.struct(F.lit(88.0).alias("confidence"), words.alias("words"))).alias("paragraphs"))).alias("blocks")))
    return own.select("video_id", "utterance_id", candidates.flatten_pages(pages).alias("avg_conf"))


@query("""SELECT video_id, coalesce(n, 0) AS segments, coalesce(u, 0) AS speaker_rows, coalesce(d, 0) AS speakers, coalesce(f, 0) AS frames FROM fx_videos
    LEFT JOIN (SELECT video_id, count(*) AS n, count(*) FILTER (seq % 2 = 0) AS u, count(DISTINCT speaker) FILTER (seq % 2 = 0) AS d FROM fx_segments GROUP BY video_id) USING (video_id) LEFT JOIN (SELECT video_id, count(*) AS f FROM fx_frames GROUP BY video_id) USING (video_id)""")
def run_counts(spark, sf_dir):
    said = fixture(spark, sf_dir, "fx_segments")
    return report.run_counts(fixture(spark, sf_dir, "fx_videos"), said, said.filter("seq % 2 = 0"), fixture(spark, sf_dir, "fx_frames"))


@query(_REPORT + ", g AS (" + " UNION ALL ".join(f"SELECT '{name}' AS name, {name} {op} {target} AS passed FROM rep" for name, op, target in report.GATES) + ") SELECT name, count(*) AS n FROM g WHERE NOT passed GROUP BY name")
def failed_gates(spark, sf_dir):
    return report.failed_gates(report.evaluate_gates(_report(spark, sf_dir)))


@query(f"""a AS (SELECT video_id, timestamp, seq, 0 AS k, source FROM fx_frames WHERE source = 'scene' UNION ALL SELECT video_id, timestamp, seq, 1, source FROM fx_frames WHERE source = 'sample'
        UNION ALL SELECT video_id, {_round("i * 15.0::double", 3)}, i + 1, 2, 'grid' FROM (SELECT video_id, unnest(generate_series(0, ceil(duration / 15.0)::bigint - 1)) AS i FROM fx_videos WHERE duration > 0))
    SELECT video_id, timestamp, source, row_number() OVER (PARTITION BY video_id ORDER BY k, seq) AS seq FROM a""")
def union_frames(spark, sf_dir):
    own = fixture(spark, sf_dir, "fx_frames").select("video_id", "timestamp", "seq", "source")
    grid = frames.sample_grid(fixture(spark, sf_dir, "fx_videos"), 15.0).select("video_id", "timestamp", F.col("original_index").alias("seq"), F.lit("grid").alias("source"))
    return frames.union_frames(own.filter("source = 'scene'"), own.filter("source = 'sample'"), grid).select("video_id", "timestamp", "source", "seq")


_GIVEN = {
    "profile": "case video_id % 4 when 1 then 'local_safe' when 2 then 'quality_first' end",
    "transcribe_provider": "case when video_id % 7 = 3 then 'whisper' end",
    "ocr_provider": "case when video_id % 5 = 1 then 'google' end",
    "align_topk": "case when video_id % 3 = 0 then 5 end",
    "window_seconds": "case when video_id % 6 = 2 then cast(30 as double) end",
}


@query(f"""SELECT video_id, CASE WHEN video_id % 5 = 0 THEN 'auto' ELSE base END AS profile, coalesce(transcribe_provider, CASE base WHEN 'local_safe' THEN 'whisper' ELSE 'assemblyai' END) AS transcribe_provider,
    coalesce(ocr_provider, CASE base WHEN 'local_safe' THEN 'tesseract' ELSE 'google' END) AS ocr_provider, CASE base WHEN 'local_safe' THEN 'none' ELSE 'azure' END AS ocr_fallback_provider,
    CASE WHEN video_id % 5 <> 0 THEN 2.0 WHEN height < 720 THEN 3.0 ELSE 1.5 END::double AS ocr_scale, CASE WHEN video_id % 10 = 0 THEN 'none' ELSE 'preset' END AS ocr_crops, coalesce(align_topk, 3)::int AS align_topk, coalesce(window_seconds, 45.0::double) AS window_seconds
    FROM (SELECT *, coalesce(profile, 'quality_first') AS base FROM (SELECT video_id, height, {", ".join(f"{y} AS {x}" for x, y in _GIVEN.items())} FROM fx_videos))""")
def config_overlay(spark, sf_dir):
    videos = fixture(spark, sf_dir, "fx_videos")
    runs = videos.select("video_id", *(F.expr(y).alias(x) for x, y in _GIVEN.items()))
    tuned = videos.filter("video_id % 5 = 0").select("video_id", F.expr("case when height < 720 then 3.0D else 1.5D end").alias("ocr_scale"), F.expr("if(video_id % 10 = 0, 'none', 'preset')").alias("ocr_crops"))
    return settings.effective_settings(runs, tuned).select("video_id", "profile", "transcribe_provider", "ocr_provider", "ocr_fallback_provider", "ocr_scale", "ocr_crops", "align_topk", "window_seconds")


_STREAM = "CASE video_id % 4 WHEN 0 THEN '1280,' || height || ',30000/1001' WHEN 1 THEN 'x,' || height || ',25' WHEN 2 THEN '640,480,30/0' END"


@query(f"""{_PROBES}, n AS (SELECT video_id, count(*) FILTER (source = 'sample') AS sampled, count(*) FILTER (source = 'scene') AS scenes FROM fx_frames GROUP BY video_id)
    SELECT video_id, duration AS duration_seconds, CASE video_id % 4 WHEN 0 THEN 1280 WHEN 2 THEN 640 ELSE 1920 END AS width, CASE video_id % 4 WHEN 2 THEN 480 WHEN 3 THEN 1080 ELSE height END AS height,
        {_round("CASE video_id % 4 WHEN 0 THEN 30000 / 1001.0::double WHEN 1 THEN 25.0 ELSE 30.0 END", 9)} AS fps, video_id % 3 = 0 AS has_audio, coalesce(sampled, 0) AS sample_frame_count, coalesce(scenes, 0) AS scene_frame_count,
        scene_changes_per_minute, {_round("coalesce(len, 200.0)", 6)} AS avg_text_length, avg_ocr_confidence FROM pr LEFT JOIN tx USING (video_id) LEFT JOIN n USING (video_id)""")
def probe_chain(spark, sf_dir):
    videos, own = fixture(spark, sf_dir, "fx_videos"), fixture(spark, sf_dir, "fx_frames")
    streams = videos.select("video_id", F.expr(_STREAM).alias("line")).filter("line is not null")
    audio = videos.select("video_id", F.explode(F.array(F.lit(" "), F.expr("if(video_id % 3 = 0, 'audio', '')"))).alias("line"))
    out = tuning.probe(videos, streams, audio, own.filter("source = 'sample'"), own.filter("source = 'scene'"), _read_samples(own))
    digits = {"fps": 9, "scene_changes_per_minute": 6, "avg_text_length": 6, "avg_ocr_confidence": 6}
    return out.select("video_id", "duration_seconds", "width", "height", "has_audio", "sample_frame_count", "scene_frame_count", *(numbers.round_to(F.col(x), n).alias(x) for x, n in digits.items()))


_BOX_NAMES = "(VALUES (1, 'FULL'), (2, 'TOP'), (3, 'LEFT'), (4, 'MAIN'), (5, 'BOTTOM'))"
_BOX_TEXT = "case when (seq + place) % 4 = 0 then '' when (seq + place) % 3 = 0 and psm = 11 then {0} else ocr_text end"
_BOX_CONF = "case when (seq + place) % 5 = 0 then null else cast((seq * 7 + place * 13 + psm) % 101 as double) end"


@query(f"""asked AS (SELECT f.video_id, f.seq, f.ocr_text, place, name, psm FROM fx_frames f, {_BOX_NAMES} AS b(place, name), (VALUES (6), (11)) AS p(psm)),
    said AS (SELECT *, {_BOX_TEXT.format("ocr_text || ' once more'")} AS said, {_BOX_CONF} AS conf FROM asked),
    crop AS (SELECT a.video_id, a.seq, a.place, a.name, length(b.said) > length(a.said) AS second, CASE WHEN length(b.said) > length(a.said) THEN b.said ELSE a.said END AS said, CASE WHEN length(b.said) > length(a.said) THEN b.conf ELSE a.conf END AS conf
        FROM said a JOIN said b USING (video_id, seq, place) WHERE a.psm = 6 AND b.psm = 11),
    fr AS (SELECT video_id, seq, count(*) AS n_crops, count(*) FILTER (second) AS n_second, coalesce(string_agg('[' || name || ']' || chr(10) || said, chr(10) || chr(10) ORDER BY place) FILTER (said <> ''), '') AS text,
        {_round("sum(conf::decimal(30,6))::double / count(conf)", 2)} AS avg_conf FROM crop GROUP BY ALL), {_QUALITY.replace("fx_ocr", "fr")}
    SELECT video_id, seq, text AS full_text, avg_conf, n_crops, n_second, {_round("quality", 4)} AS quality_score FROM z""")
def frame_ocr(spark, sf_dir):
    own = fixture(spark, sf_dir, "fx_frames").select("video_id", "seq", "ocr_text", F.lit(640).alias("width"), F.lit(480).alias("height"))
    answers = recognition.crop_requests(own, [6, 11]).withColumns({"text": F.expr(_BOX_TEXT.format("concat(ocr_text, ' once more')")), "avg_conf": F.expr(_BOX_CONF)})
    out = recognition.frame_records(answers, 6)
    second = F.size(F.filter("ocr.crops", lambda x: x["psm_used"] == 11)).cast("long")
    return out.select("video_id", "seq", "ocr.full_text", "ocr.avg_conf", F.size("ocr.crops").cast("long").alias("n_crops"), second.alias("n_second"), "quality_score")


@query(f"""asked AS (SELECT f.video_id, f.seq, f.ocr_text, place, name, psm FROM fx_frames f, {_BOX_NAMES} AS b(place, name), (VALUES (6), (11)) AS p(psm)),
    said AS (SELECT *, {_BOX_TEXT.format("ocr_text || ' once more'")} AS said, {_BOX_CONF} AS conf FROM asked),
    passes AS (SELECT video_id, seq, name, any_value(place) AS place, max(said) FILTER (psm = 6) AS a, max(said) FILTER (psm = 11) AS b, max(conf) FILTER (psm = 6) AS ca, max(conf) FILTER (psm = 11) AS cb FROM said GROUP BY video_id, seq, name)
    SELECT video_id, seq, name, CASE WHEN length(b) > length(a) THEN b ELSE a END AS text, CASE WHEN length(b) > length(a) THEN cb ELSE ca END AS avg_conf, CASE WHEN length(b) > length(a) THEN 11 ELSE 6 END AS psm_used,
        CASE place WHEN 4 THEN 96 ELSE 0 END AS x1, CASE place WHEN 4 THEN 72 WHEN 5 THEN 384 ELSE 0 END AS y1 FROM passes""")
def frame_ocr_crops(spark, sf_dir):
    own = fixture(spark, sf_dir, "fx_frames").select("video_id", "seq", "ocr_text", F.lit(640).alias("width"), F.lit(480).alias("height"))
    answers = recognition.crop_requests(own, [6, 11]).withColumns({"text": F.expr(_BOX_TEXT.format("concat(ocr_text, ' once more')")), "avg_conf": F.expr(_BOX_CONF)})
    return recognition.better_crops(answers, 6).select("video_id", "seq", "name", "text", "avg_conf", "psm_used", "box.x1", "box.y1")


# --- providers in turn, box by box --------------------------------------------------------------------------------

_TWO_BOXES = "(VALUES (1, 'FULL'), (2, 'MANUAL_01'))"
#: What the stages say of a box: text, confidence, error.
_SAID = {
    "google_a": ("case when (seq + place) % 4 = 0 then '' when seq % 3 = 0 then replace(ocr_text, 'e', '#') else ocr_text end", "case when seq % 5 = 0 then null else cast((seq * 7 + place * 13) % 101 as double) end", "case when (seq + place) % 11 = 0 then 'timeout' end"),
    "google_b": ("case when (seq + place) % 6 = 0 then '' else concat(ocr_text, ' again.') end", "cast((seq * 11 + place * 5) % 101 as double)", "case when (seq + place) % 13 = 0 then 'timeout b' end"),
    "azure_read": ("concat('Read: ', ocr_text, case when seq % 2 = 0 then '' else ' ((' end)", "cast((seq * 3 + place) % 101 as double)", "case when (seq + place) % 7 = 0 then 'throttled' end"),
}
_CANDIDATE_RANK = "struct_pack(a := coalesce(score, 0), b := length(text), c := coalesce(avg_conf, 0), d := -stage)"
_ASKED = f"""asked AS (SELECT f.video_id, f.seq, f.ocr_text, place, name FROM fx_frames f, {_TWO_BOXES} AS b(place, name)),
    every AS ({" UNION ALL ".join(f"SELECT video_id, seq, place, name, {i} AS stage, '{v}' AS variant, {said} AS text, {conf} AS avg_conf, {error} AS error FROM asked" for i, (v, (said, conf, error)) in enumerate(_SAID.items()))}),
    {_QUALITY.replace("fx_ocr", "every")},
    rated AS (SELECT *, {_round("quality", 4)} AS score FROM z),
    one AS (SELECT video_id, seq, place, max(CASE WHEN coalesce(error, '') <> '' OR score < 0.55 THEN 1 ELSE 0 END) AS weak FROM rated WHERE stage = 0 GROUP BY ALL),
    two AS (SELECT video_id, seq, place, arg_max(CASE WHEN coalesce(error, '') <> '' OR score < 0.55 THEN 1 ELSE 0 END, {_CANDIDATE_RANK}) AS weak FROM rated JOIN one USING (video_id, seq, place) WHERE stage < 1 + weak GROUP BY ALL),
    cand AS (SELECT rated.* FROM rated JOIN one USING (video_id, seq, place) JOIN two USING (video_id, seq, place) WHERE stage = 0 OR stage = 1 AND one.weak = 1 OR stage = 2 AND two.weak = 1),
    boxes AS (SELECT video_id, seq, place, any_value(name) AS name, arg_max(struct_pack(text := text, avg_conf := avg_conf, error := error, score := score, variant := variant), {_CANDIDATE_RANK}) AS best, count(*) AS n, string_agg(variant, ',' ORDER BY stage) AS variants FROM cand GROUP BY video_id, seq, place)"""
_FOLDED = f"""{_ASKED}, fold AS (SELECT video_id, seq, trim(coalesce(string_agg('[' || name || ']' || chr(10) || best.text, chr(10) || chr(10) ORDER BY place) FILTER (best.text <> ''), ''), chr(32) || chr(9) || chr(10)) AS text,
        {_round("sum(best.avg_conf::decimal(30,6))::double / count(best.avg_conf)", 2)} AS avg_conf, sum(n)::bigint AS n_candidates, bool_or(best.variant = 'azure_read') AS fallback_used,
        coalesce(string_agg(name || '=' || best.error, ',' ORDER BY place) FILTER (coalesce(best.error, '') <> ''), '') AS errors, string_agg(variants, ';' ORDER BY place) AS variants FROM boxes GROUP BY video_id, seq)"""
_FRAME_QUALITY = _QUALITY.replace("fx_ocr", "fold").replace("t AS (", "t2 AS (", 1).replace("FROM t)", "FROM t2)")
for _x in ("m", "r", "q", "z"):
    _FRAME_QUALITY = _FRAME_QUALITY.replace(f"    {_x} AS (", f"    {_x}2 AS (").replace(f"FROM {_x})", f"FROM {_x}2)")


def _cascaded(spark, sf_dir):
    own = fixture(spark, sf_dir, "fx_frames").select("video_id", "seq", "ocr_text", F.lit(640).alias("width"), F.lit(480).alias("height"))
    requests = recognition.crop_requests(own, [0], "none", ["5,6,300,200"]).withColumn("place", F.when(F.col("name") == "FULL", 1).otherwise(2)).drop("psm")

    def said(variant):
        columns = {x: F.expr(y) for x, y in zip(("text", "avg_conf", "error"), _SAID[variant])}
        return lambda asked: asked.withColumns(columns)

    stages = [frame_cascade.Stage("azure" if x == "azure_read" else "google", x, said(x), fallback=x == "azure_read") for x in _SAID]
    return frame_cascade.cascade_boxes(requests, stages)


@query(f"{_ASKED} SELECT video_id, seq, name, best.text AS text, best.avg_conf AS avg_conf, best.error AS error, best.score AS quality_score, best.variant AS variant, best.variant = 'azure_read' AS fallback_used, n AS n_candidates, variants FROM boxes")
def cascade_boxes(spark, sf_dir):
    out = _cascaded(spark, sf_dir)
    variants = F.array_join(F.transform("candidates", lambda x: x["variant"]), ",")
    return out.select("video_id", "seq", "name", *(f"best.{x}" for x in ("text", "avg_conf", "error", "quality_score", "variant")), "fallback_used", F.size("candidates").cast("long").alias("n_candidates"), variants.alias("variants"))


@query(f"""{_FOLDED}, {_FRAME_QUALITY} SELECT video_id, seq, text AS full_text, avg_conf, {_round("quality", 4)} AS quality_score, n_candidates, fallback_used, errors, variants FROM z2""")
def cascade_records(spark, sf_dir):
    out = frame_cascade.cascade_records(_cascaded(spark, sf_dir), settings={"feature": "document_text_detection", "fallback_provider": "azure"})
    errors = F.array_join(F.transform("provider_meta.errors", lambda x: F.concat(x["crop"], F.lit("="), F.col("provider_meta.per_crop_errors")[x["crop"]])), ",")
    variants = F.array_join(F.transform("ocr.crops", lambda x: F.array_join(F.transform(x["provider_candidates"], lambda y: y["variant"]), ",")), ";")
    return out.select("video_id", "seq", "ocr.full_text", "ocr.avg_conf", "quality_score", F.size("provider_candidates").cast("long").alias("n_candidates"), "fallback_used", errors.alias("errors"), variants.alias("variants"))


@query(f"""{_FOLDED}, {_FRAME_QUALITY}, zz AS (SELECT *, {_round("quality", 4)} AS score, len(regexp_extract_all(variants, 'azure')) AS azure FROM z2)
    SELECT video_id, count(*) AS frame_records, {_round("count(*) FILTER (trim(text) <> '') / count(*)::double", 4)} AS ocr_nonempty_rate, {_round("count(*) FILTER (score < 0.55) / count(*)::double", 4)} AS low_quality_rate,
        count(*) FILTER (errors <> '') AS provider_error_count, count(*) FILTER (fallback_used) AS fallback_used_count, sum(n_candidates - 1)::bigint AS retry_invocations, sum(azure)::bigint AS azure_candidate_count FROM zz GROUP BY video_id""")
def cascade_stats(spark, sf_dir):
    records = frame_cascade.cascade_records(_cascaded(spark, sf_dir))
    return report.ocr_stats(frame_cascade.for_report(records)).withColumns({x: numbers.round_to(F.col(x), 4) for x in ("ocr_nonempty_rate", "low_quality_rate")})


@query(f"""{_FOLDED}, {_RANKED}, first_box AS (SELECT video_id, seq, arg_min(name || ':' || best.variant, place) AS crop FROM boxes GROUP BY ALL)
    SELECT s.video_id, s.seq, r.frame_path, o.text AS frame_ocr_text, CASE WHEN r.seq IS NULL THEN -1 ELSE 2 END::bigint AS n_crops, b.crop AS first_crop
    FROM fx_segments s LEFT JOIN ranked r ON s.video_id = r.video_id AND s.seq = r.seq AND r.rank = 1
    LEFT JOIN fold o ON o.video_id = r.video_id AND o.seq = r.frame_seq LEFT JOIN first_box b ON b.video_id = r.video_id AND b.seq = r.frame_seq""")
def dataset_recognised(spark, sf_dir):
    records = frame_cascade.cascade_records(_cascaded(spark, sf_dir)).select("video_id", "seq", "ocr")
    own = fixture(spark, sf_dir, "fx_frames").drop("ocr_text").join(records, ["video_id", "seq"])
    out = align.build_dataset(fixture(spark, sf_dir, "fx_segments"), own)
    first = F.get("frame_ocr_crops", F.lit(0))
    used = F.filter(first["provider_candidates"], lambda x: x["text"] == first["text"])
    return out.select("video_id", "seq", "frame_path", "frame_ocr_text", F.coalesce(F.size("frame_ocr_crops"), F.lit(-1)).cast("long").alias("n_crops"), F.concat(first["name"], F.lit(":"), F.get(used, F.lit(0))["variant"]).alias("first_crop"))


# --- what is written and read back, and what other queries leave out ----------------------------------------------


def _written(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT video_id, seq, start, end_, speaker, text, asr_provider FROM fx_segments")
def json_written(spark, sf_dir):
    path = _written(spark, "json")
    sinks.write_json(fixture(spark, sf_dir, "fx_segments"), path)
    return sinks.read_json(spark, path).select("video_id", "seq", "start", F.col("end").alias("end_"), "speaker", "text", "asr_provider")


@query("""s AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY seq) AS i, round(start::decimal(30,12) * 1000)::bigint AS a, round(end_::decimal(30,12) * 1000)::bigint AS b FROM fx_segments)
    SELECT video_id, string_agg(i || chr(10) || printf('%02d:%02d:%02d,%03d', a // 3600000, a % 3600000 // 60000, a % 60000 // 1000, a % 1000) || ' --> ' || printf('%02d:%02d:%02d,%03d', b // 3600000, b % 3600000 // 60000, b % 60000 // 1000, b % 1000)
        || chr(10) || trim(text, chr(32) || chr(9) || chr(10) || chr(13)) || chr(10) || chr(10), '' ORDER BY i) AS content FROM s GROUP BY video_id""")
def srt_written(spark, sf_dir):
    path = _written(spark, "srt")
    sinks.write_srt(fixture(spark, sf_dir, "fx_segments"), ["seq"], path, shards=tasks(spark))
    # One file for each recording, whose cues are in order.
    return sinks.read_srt(spark, path)


@query("""SELECT video_id, utterance_id, string_agg(text, ' ' ORDER BY word_ix) AS words, count(*) AS n FROM fx_words WHERE word_ix % 7 <> 3 GROUP BY ALL""")
def blank_words(spark, sf_dir):
    """Words that are blank are no words: every seventh is replaced by white space."""
    words = fixture(spark, sf_dir, "fx_words").withColumn("text", F.when(F.col("word_ix") % 7 == 3, F.expr("case word_ix % 3 when 0 then '' when 1 then ' \\t' end")).otherwise(F.col("text")))
    chunks = segments.split_words(words, 1e9, 1e9)
    parts = chunks.groupBy("video_id", "utterance_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "text"))), lambda x: x["text"]).alias("t"))
    joined = F.array_join("t", " ")
    return parts.select("video_id", "utterance_id", joined.alias("words"), F.size(F.split(joined, " ")).cast("long").alias("n"))


_SWITCH = "case event_id % 6 when 0 then 'Yes' when 1 then ' true ' when 2 then 'F' when 3 then '0' when 4 then 'n' else 'T' end"


@query(f"SELECT event_id, lower(trim({_SWITCH})) IN ('1', 'true', 't', 'yes', 'y') AS switch FROM events")
def switches(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", text.str2bool(F.expr(_SWITCH)).alias("switch"))


@query(f"""{_PROBES} SELECT video_id, CASE WHEN scene_changes_per_minute > 6 THEN 'high' WHEN scene_changes_per_minute > 2 THEN 'moderate' ELSE 'low' END || ' scene rate (' || printf('%.1f', scene_changes_per_minute) || '/min)' AS frame_reason,
    CASE WHEN height < 720 THEN 'low res' WHEN height <= 1080 THEN 'HD' ELSE 'high res' END || ' (' || height || 'p)' AS scale_reason, CASE WHEN avg_text_length < 100 THEN 'sparse text detected' ELSE 'dense text detected' END AS crops_reason,
    CASE WHEN duration > 1800 THEN 'long video (>30min)' WHEN duration < 120 THEN 'short video (<2min)' ELSE 'standard duration' END AS dedup_reason FROM pr""")
def tune_reasons(spark, sf_dir):
    return tuning.tune(_probes(spark, sf_dir)).select("video_id", "frame_reason", "scale_reason", "crops_reason", "dedup_reason")


@query("""SELECT v.video_id, 0.0::double AS start, duration AS end_, 'all of ' || v.video_id AS text, 'global_fallback' AS split_reason FROM fx_videos v
    WHERE v.video_id % 3 <> 1 AND NOT EXISTS (SELECT 1 FROM fx_segments s WHERE s.video_id = v.video_id AND s.video_id % 2 = 0)""")
def fallback_segments(spark, sf_dir):
    videos = fixture(spark, sf_dir, "fx_videos")
    texts = videos.filter("video_id % 3 <> 1").select("video_id", F.concat(F.lit("all of "), F.col("video_id").cast("string")).alias("text"))
    own = fixture(spark, sf_dir, "fx_segments").filter("video_id % 2 = 0")
    return providers.fallback_segments(videos, own, texts).select("video_id", "start", F.col("end").alias("end_"), "text", "split_reason")
