"""Recordings derived from the tables at hand, so that operators have input: in Spark, and in SQL for the oracles.

Times are in seconds from a recording's start. A user's events are a recording's frames, a conversation's turns are
its segments, a turn's words follow each other at a fixed pace.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..scratch import spread

_TS = "(unix_micros(cast(ts as timestamp)) div 1000) % 300000"
_TS_DUCK = "(epoch_us(ts) // 1000) % 300000"

SPARK = {
    "fx_frames": f"""
        select user_id as video_id, event_id as seq, ({_TS}) / 1000.0D as timestamp,
               concat('frames/frame_', cast(event_id as string), '.png') as frame_path,
               case when event_type in ('view', 'click') then 'scene' else 'sample' end as source,
               case when event_type = 'error' then 'google' else 'tesseract' end as ocr_provider,
               value / 500 as quality_score, event_id % 500 as vec_id,
               concat(event_type, ' ', props) as ocr_text, case when event_id % 7 = 0 then null else cast((event_id * 37) % 101 as double) end as avg_conf
        from events""",
    "fx_events": f"""
        select user_id as video_id, event_id as seq, ({_TS}) / 1000.0D as timestamp, event_type, props as payload
        from events where event_type = 'click'""",
    "fx_segments": """
        select video_id, seq, start_ms / 1000.0D as start, (start_ms + dur) / 1000.0D as end, speaker, text, 'whisper' as asr_provider
        from (select conv_id as video_id, turn as seq, role as speaker, text, length(text) * 64L as dur,
                     coalesce(sum(length(text) * 64L + 400L) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding), 0L) as start_ms
              from conversations)""",
    "fx_words": """
        select conv_id as video_id, turn as utterance_id, cast(pos as bigint) as word_ix, word as text,
               (pos * 350 + (pos div 17) * 700) / 1000.0D as start, (pos * 350 + (pos div 17) * 700 + 300) / 1000.0D as end
        from conversations lateral view posexplode(filter(split(text, '[ \\\\n]+'), x -> x <> '')) p as pos, word""",
    "fx_hash": """
        select vec_id,
               aggregate(slice(transform(embedding, x -> if(x > 0, 1L, 0L)), 1, 32), 0L, (a, b) -> a * 2 + b) as hash_hi,
               aggregate(slice(transform(embedding, x -> if(x > 0, 1L, 0L)), 33, 32), 0L, (a, b) -> a * 2 + b) as hash_lo
        from embeddings""",
    "fx_ocr": """
        select doc_id as video_id, doc_id as seq, text, case when doc_id % 7 = 0 then null else cast((doc_id * 37) % 101 as double) end as avg_conf
        from documents""",
    "fx_videos": """
        select user_id as video_id, case user_id % 4 when 0 then 300.0D when 1 then 310.5D when 2 then 90.0D else 2400.0D end as duration,
               cast(case user_id % 3 when 0 then 480 when 1 then 1080 else 2160 end as int) as height
        from (select distinct user_id from events)""",
    "fx_candidates": """
        select doc_id, 0 as seq, 'google' as provider, 'google_a' as variant, text, cast((doc_id * 37) % 101 as double) as avg_conf,
               case when doc_id % 11 = 0 then 'timeout' end as error, ((doc_id * 31) % 100) / 100.0D as quality_score from documents
        union all
        select doc_id, 1, 'google', 'google_b', replace(text, 'e', ' '), cast((doc_id * 41) % 101 as double), null, ((doc_id * 17) % 100) / 100.0D from documents
        union all
        select doc_id, 2, 'azure', 'azure_read', concat(replace(text, ' ', '  '), case when doc_id % 2 = 0 then ' end' else '' end), null, case when doc_id % 13 = 0 then 'throttled' end, ((doc_id * 53) % 100) / 100.0D from documents""",
}

DUCK = {
    "fx_frames": SPARK["fx_frames"].replace(_TS, _TS_DUCK).replace("1000.0D", "1000.0::double").replace("as string", "as varchar"),
    "fx_events": SPARK["fx_events"].replace(_TS, _TS_DUCK).replace("1000.0D", "1000.0::double"),
    "fx_segments": """
        select video_id, seq, start_ms / 1000.0::double as start, (start_ms + dur) / 1000.0::double as end_, speaker, text, 'whisper' as asr_provider
        from (select conv_id as video_id, turn as seq, role as speaker, text, length(text) * 64::bigint as dur,
                     coalesce(sum(length(text) * 64 + 400) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding), 0)::bigint as start_ms
              from conversations)""",
    "fx_words": """
        select video_id, utterance_id, i as word_ix, words[i + 1] as text, (i * 350 + (i // 17) * 700) / 1000.0::double as start, (i * 350 + (i // 17) * 700 + 300) / 1000.0::double as end_
        from (select *, unnest(range(len(words))) as i
              from (select conv_id as video_id, turn as utterance_id, list_filter(regexp_split_to_array(text, '[ \\n]+'), lambda x: x <> '') as words from conversations))""",
    "fx_hash": """
        select vec_id,
               list_sum([case when embedding[i] > 0 then 1::bigint << (32 - i)::int else 0 end for i in range(1, 33)])::bigint as hash_hi,
               list_sum([case when embedding[i] > 0 then 1::bigint << (64 - i)::int else 0 end for i in range(33, 65)])::bigint as hash_lo
        from embeddings""",
    "fx_ocr": SPARK["fx_ocr"],
    "fx_videos": SPARK["fx_videos"].replace("0D", "0::double").replace("5D", "5::double"),
    "fx_candidates": SPARK["fx_candidates"].replace("100.0D", "100.0::double"),
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture over the tables of sf_dir."""
    text = SPARK[name]
    tables = {x: (spread if x == "documents" else lambda df: df)(spark.read.parquet(f"{sf_dir}/{x}.parquet")) for x in ("events", "conversations", "documents", "embeddings") if re.search(rf"\bfrom {x}\b", text)}
    for x in tables:
        text = re.sub(rf"\bfrom {x}\b", f"from {{{x}}}", text)
    return spark.sql(text, **tables)


def with_fixtures(body: str, recursive: bool = False) -> str:
    """SQL with the fixtures that it names put before it; a body that starts with common tables goes on with them."""
    own = ", ".join(f"{x} AS ({DUCK[x]})" for x in DUCK if re.search(rf"\b{x}\b", body))
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + own + (", " + body if re.match(r"\s*\w+ AS \(", body) else " " + body)
