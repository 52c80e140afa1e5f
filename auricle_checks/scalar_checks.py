"""Column functions, each over every row of a table and every character of a text."""

from pyspark.sql import functions as F

from auricle.functions import scalars as S
from auricle_checks.registry import check

# White space as DuckDB's regular expressions spell it; the same set the strip function removes.
WS = (
    r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)


@check(
    "SC1_json_text",
    """SELECT id, json_extract_string(parquet_metadata, '$.meta_id') AS meta_id,
       json_extract_string(parquet_metadata, '$.author_uniqueid') AS author
FROM audio_files""",
)
def _(t):
    return t.audio_files.select(
        "id",
        S.json_text("parquet_metadata", "meta_id").alias("meta_id"),
        S.json_text("parquet_metadata", "author_uniqueid").alias("author"),
    )


@check(
    "SC2_json_int",
    """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events""",
)
def _(t):
    return t.raw("events").select("event_id", S.json_int("props", "k").alias("k"))


@check(
    "SC3_row_to_json",
    """SELECT '{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber
    || ',"l_returnflag":"' || l_returnflag || '"}' AS document FROM lineitem""",
)
def _(t):
    return t.raw("lineitem").select(
        S.row_json("l_orderkey", "l_linenumber", "l_returnflag").alias("document")
    )


@check(
    "SC4_json_to_row",
    """SELECT id, json_extract_string(parquet_metadata, '$.author_uniqueid') AS author_uniqueid,
       json_extract_string(parquet_metadata, '$.stats_playcount')::BIGINT AS stats_playcount
FROM audio_files""",
)
def _(t):
    row = S.json_row("parquet_metadata", "author_uniqueid STRING, stats_playcount BIGINT")
    return t.audio_files.select("id", row.alias("r")).select("id", "r.*")


@check("SC5_day", "SELECT event_id, ts::DATE::VARCHAR AS day FROM events")
def _(t):
    return t.raw("events").select("event_id", S.day("ts").cast("string").alias("day"))


@check("SC6_hour", "SELECT event_id, date_trunc('hour', ts)::TIMESTAMP AS hour FROM events")
def _(t):
    return t.raw("events").select("event_id", S.hour("ts").alias("hour"))


@check(
    "SC7_year_month_day",
    """SELECT event_id, year(ts)::INT AS year, month(ts)::INT AS month, day(ts)::INT AS day
FROM events""",
)
def _(t):
    return t.raw("events").select(
        "event_id",
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
    )


@check("SC8_hour_label", "SELECT event_id, strftime(ts, '%H:%M') AS label FROM events")
def _(t):
    return t.raw("events").select("event_id", S.hour_label("ts").alias("label"))


@check(
    "SC9_time_texts",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%Y%m%d-%H%M%S') AS stamp,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso FROM events""",
)
def _(t):
    return t.raw("events").select(
        "event_id",
        S.date_text("ts").alias("date"),
        S.batch_stamp("ts").alias("stamp"),
        S.iso_utc("ts").alias("iso"),
    )


@check(
    "SC10_epoch_text",
    """SELECT l_orderkey, l_linenumber,
       strftime(make_timestamp((l_orderkey * 1000 + l_linenumber)::BIGINT * 1000000),
                '%Y-%m-%d %H:%M:%S') AS at
FROM lineitem""",
)
def _(t):
    seconds = F.col("l_orderkey") * 1000 + F.col("l_linenumber")
    return t.raw("lineitem").select(
        "l_orderkey", "l_linenumber", S.epoch_text(seconds).alias("at")
    )


@check(
    "SC11_interval_arithmetic",
    """SELECT event_id, ts - INTERVAL 24 HOURS AS day_before, ts - INTERVAL 7 DAYS AS week_before
FROM events""",
)
def _(t):
    from auricle.clock import before

    return t.raw("events").select(
        "event_id",
        before(F.col("ts"), "24 HOURS").alias("day_before"),
        before(F.col("ts"), "7 DAYS").alias("week_before"),
    )


@check(
    "SC12_strip_extension",
    r"SELECT page_id, regexp_replace(url, '\.[^.]+$', '') AS name FROM pages",
)
def _(t):
    return t.raw("pages").select("page_id", S.strip_extension("url").alias("name"))


@check(
    "SC13_path_stem",
    r"""SELECT page_id, parse_filename(url) AS base,
       regexp_replace(parse_filename(url), '^(.+)\.[^.]+$', '\1', 's') AS stem FROM pages""",
)
def _(t):
    return t.raw("pages").select(
        "page_id", S.base_name("url").alias("base"), S.path_stem("url").alias("stem")
    )


@check(
    "SC14_suffix_test",
    """SELECT id, name, lower(name) LIKE '%.mp3' AS is_audio FROM (
    SELECT id, CASE WHEN synced_to_ra THEN upper(original_filename) ELSE opus_path END AS name
    FROM audio_files)""",
)
def _(t):
    name = F.when(F.col("synced_to_ra"), F.upper("original_filename")).otherwise(F.col("opus_path"))
    return t.audio_files.select("id", name.alias("name")).withColumn(
        "is_audio", S.has_suffix("name", ".mp3")
    )


@check(
    "SC15_response_verdict",
    """SELECT doc_id, digit = '1' AS flagged, CASE WHEN digit = '1' THEN 1.0 ELSE 0.0 END AS flag_score,
       CASE WHEN digit = '1' THEN 'reportable_content' END AS flag_category
FROM (SELECT doc_id, regexp_extract(text, '[01]', 0) AS digit FROM documents)""",
)
def _(t):
    return (
        t.raw("documents").select("doc_id", S.verdict("text").alias("v")).select("doc_id", "v.*")
    )


@check(
    "SC16_strip",
    f"""SELECT doc_id, sha256(regexp_replace(text, '^{WS}+|{WS}+$', '', 'g')) AS digest
FROM (SELECT doc_id, ' ' || chr(10) || chr(8195) || text || chr(9) || chr(160) AS text
      FROM documents)""",
)
def _(t):
    padded = F.concat(F.lit(" \n "), "text", F.lit("\t "))
    return t.raw("documents").select(
        "doc_id", F.sha2(S.strip(padded).cast("binary"), 256).alias("digest")
    )


@check(
    "SC17_join_texts",
    """SELECT conv_id, turn, concat_ws(' ', role, conv_id, turn) AS joined FROM conversations""",
)
def _(t):
    return t.raw("conversations").select(
        "conv_id", "turn", S.composite_key("role", "conv_id", "turn", separator=" ").alias("joined")
    )


@check(
    "SC18_clamp",
    """SELECT event_id, least(1.0, greatest(0.0, 1.0 - value / 100)) AS confidence FROM events""",
)
def _(t):
    return t.raw("events").select(
        "event_id", S.clamp_unit(F.lit(1.0) - F.col("value") / 100).alias("confidence")
    )


@check("SC19_length", "SELECT doc_id, length(text) AS chars FROM documents")
def _(t):
    return t.raw("documents").select("doc_id", F.length("text").cast("long").alias("chars"))


@check(
    "SC20_rounded_mean",
    """SELECT user_id, round(avg(value)::DECIMAL(30,12), 3)::DOUBLE AS mean FROM events
GROUP BY user_id""",
)
def _(t):
    mean = S.round_half_up(F.avg("value"), 3).cast("double")
    return t.raw("events").groupBy("user_id").agg(mean.alias("mean"))


@check(
    "SC21_cell_types",
    f"""SELECT kind, count(*) AS cells, min(n) AS smallest, max(n) AS largest
FROM (
    SELECT cell, CASE
        WHEN contains(cell, '.') AND regexp_full_match(cell,
            '{WS}*[+-]?([0-9]+(_[0-9]+)*\\.([0-9]+(_[0-9]+)*)?|\\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+(_[0-9]+)*)?{WS}*')
            THEN 'float'
        WHEN NOT contains(cell, '.') AND regexp_full_match(cell, '{WS}*[+-]?[0-9]+(_[0-9]+)*{WS}*')
            THEN 'int' ELSE 'text' END AS kind,
        n
    FROM (SELECT cell, CASE WHEN regexp_full_match(cell, '{WS}*[+-]?[0-9]+(_[0-9]+)*{WS}*')
                 THEN TRY_CAST(regexp_replace(cell, '{WS}|_', '', 'g') AS BIGINT) END AS n
          FROM (SELECT unnest(string_split(text, ' ')) AS cell FROM documents
                UNION ALL SELECT value::VARCHAR FROM events
                UNION ALL SELECT event_id::VARCHAR FROM events
                UNION ALL SELECT '-12345678901234567890' || event_id FROM events))
) GROUP BY kind""",
)
def _(t):
    words = t.raw("documents").select(F.explode(F.split("text", " ")).alias("cell"))
    events = t.raw("events")
    cells = words.unionAll(events.select(F.col("value").cast("string"))).unionAll(
        events.select(F.col("event_id").cast("string"))
    )
    beyond = F.concat(F.lit("-12345678901234567890"), F.col("event_id").cast("string"))
    cells = cells.unionAll(events.select(beyond))
    return (
        cells.withColumns({"kind": S.cell_kind("cell"), "n": S.cell_int("cell")})
        .groupBy("kind")
        .agg(
            F.count("*").alias("cells"),
            F.min("n").alias("smallest"),
            F.max("n").alias("largest"),
        )
    )


@check(
    "SC22_falsy_default",
    """SELECT id, coalesce(nullif(s3_opus_path, ''), 'unknown') AS path FROM audio_files""",
)
def _(t):
    return t.audio_files.select("id", S.value_or("s3_opus_path", "unknown").alias("path"))


@check(
    "SC23_status_by_flag",
    """SELECT id, CASE WHEN flagged THEN 'flagged' ELSE 'transcribed' END AS status
FROM pipeline_classifications""",
)
def _(t):
    return t.classifications.select("id", S.status_for("flagged").alias("status"))


@check(
    "SC24_prompt",
    """SELECT doc_id, sha256('Policy {1}: ' || text || ' / again: ' || text || '.') AS digest
FROM documents""",
)
def _(t):
    template = F.lit("Policy {{1}}: {content_text} / again: {content_text}.")
    prompt = S.render_prompt(template, "text").cast("binary")
    return t.raw("documents").select("doc_id", F.sha2(prompt, 256).alias("digest"))


@check(
    "SC25_percent",
    """SELECT archive_source, round(100.0::DOUBLE * count(s3_opus_path) / greatest(count(*), 1), 9)
    AS stored_pct FROM audio_files GROUP BY 1""",
)
def _(t):
    counts = t.audio_files.groupBy("archive_source").agg(
        F.count("s3_opus_path").alias("stored"), F.count("*").alias("n")
    )
    return counts.select("archive_source", F.round(S.percent("stored", "n"), 9).alias("stored_pct"))


@check(
    "SC26_byte_units",
    """SELECT id, round(file_size_bytes / 1024.0::DOUBLE, 9) AS kib,
       round(file_size_bytes / 1048576.0::DOUBLE, 9) AS mib,
       round(file_size_bytes / 1073741824.0::DOUBLE, 12) AS gib FROM audio_files""",
)
def _(t):
    return t.audio_files.select(
        "id",
        F.round(S.kib("file_size_bytes"), 9).alias("kib"),
        F.round(S.mib("file_size_bytes"), 9).alias("mib"),
        F.round(S.gib("file_size_bytes"), 12).alias("gib"),
    )


@check(
    "SC27_preview_and_pad",
    """SELECT id, substring(original_filename, 1, 4) AS shown,
       CASE WHEN length(original_filename) < 8 THEN rpad(original_filename, 8, ' ')
            ELSE original_filename END AS padded FROM audio_files""",
)
def _(t):
    return t.audio_files.select(
        "id",
        S.preview("original_filename", 4).alias("shown"),
        S.pad_right("original_filename", 8).alias("padded"),
    )


@check(
    "SC29_composite_key",
    """SELECT archive_source || ':' || status AS key, count(*) AS count FROM audio_files
GROUP BY archive_source, status""",
)
def _(t):
    return (
        t.audio_files.groupBy(S.composite_key("archive_source", "status").alias("key"))
        .agg(F.count("*").alias("count"))
    )


@check(
    "SC30_score_cast",
    """SELECT event_id, TRY_CAST(value / 7 AS DECIMAL(10,9))::DOUBLE AS score FROM events""",
)
def _(t):
    return t.raw("events").select(
        "event_id", S.as_score(F.col("value") / 7).cast("double").alias("score")
    )


@check(
    "SNK7_processed_keys",
    """SELECT id, 'processed/' || strftime(created_at, '%Y-%m-%d') || '/'
    || CASE WHEN synced_to_ra THEN id::VARCHAR ELSE 'v' || id END || '.opus' AS key
FROM audio_files""",
)
def _(t):
    name = F.when(F.col("synced_to_ra"), F.lit("")).otherwise(F.col("original_filename"))
    return t.audio_files.select(
        "id", S.processed_key(S.date_text("created_at"), "id", name).alias("key")
    )


@check(
    "SNK8_batch_ids",
    """SELECT id, batch_id, 'archives/' || batch_id || '.tar' AS key FROM (
    SELECT id, strftime(created_at, '%Y%m%d-%H%M%S') || '-' ||
           substring(sha256(original_filename || '|' || opus_path), 1, 6) AS batch_id
    FROM audio_files)""",
)
def _(t):
    made = S.batch_id("created_at", "original_filename", "opus_path")
    return t.audio_files.select("id", made.alias("batch_id")).withColumn(
        "key", S.archive_key("batch_id")
    )
