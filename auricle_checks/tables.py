"""Content-review tables derived from the star-schema test tables, in Spark and in DuckDB SQL.

The two forms state one mapping (FIXTURES.md §3). Every row of every source table takes part;
the derived flags below are column values, not samples.
"""

from __future__ import annotations

import csv
import io
import tarfile
from collections.abc import Callable
from functools import cached_property

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auricle import clock
from auricle.functions import scalars as S
from auricle.plans.unpack import batch_members
from auricle.session import run_dir
from auricle.sources import storage
from auricle.sources.objects import list_objects
from auricle.sources.tables import read_table, write_table


# Where each derived table of a session was written: (application, folder, table) → path.
_WRITTEN: dict[tuple[str, str, str], str] = {}


class Tables:
    """Lazy frames over one folder of test tables.

    The three core tables are derived by joins over the source tables, so each is written once
    per session in the layout the jobs expect (partitioned by day) and read back from there.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _stored(
        self, name: str, derive: Callable[[], DataFrame], order: str = "id"
    ) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _WRITTEN:
            path = run_dir(self.spark, name)
            write_table(derive(), path, order=order)
            _WRITTEN[key] = path
        return read_table(self.spark, _WRITTEN[key], name)

    @cached_property
    def audio_files(self) -> DataFrame:
        return self._stored("audio_files", lambda: self.derived_files)

    @cached_property
    def transcripts(self) -> DataFrame:
        """The `pipeline_transcripts` table: one row per labelled document."""
        return self._stored("pipeline_transcripts", lambda: self.derived_transcripts, order="audio_file_id")

    @cached_property
    def classifications(self) -> DataFrame:
        """The `pipeline_classifications` table: one row per labelled document."""
        return self._stored("pipeline_classifications", lambda: self.derived_classifications, order="audio_file_id")

    @cached_property
    def as_of(self) -> Column:
        return clock.latest(self.audio_files)

    @cached_property
    def _joined(self) -> DataFrame:
        events = self.raw("events")
        nations = self.raw("nation").select("n_nationkey", "n_name")
        return (
            self.raw("documents")
            .join(self.raw("labels"), "doc_id", "left")
            .join(events.withColumnRenamed("event_id", "doc_id"), "doc_id", "left")
            .join(nations, F.col("n_nationkey") == F.col("user_id") % 25, "left")
            .withColumn("labelled", F.col("toxic").isNotNull())
            .withColumn("stem", F.concat(F.lit("v"), "doc_id"))
            .withColumn("done_at", F.col("ts") + F.expr("INTERVAL 1 HOUR"))
            .withColumn(
                "meta_id",
                F.when(
                    F.col("doc_id") % 11 != 0,
                    F.concat(F.lit("m"), F.expr("doc_id div 8")),
                ),
            )
            .withColumn("author", F.concat(F.lit("u"), "user_id"))
            .withColumn("score", (F.lit(50) + F.col("doc_id") % 50).cast("double") / 100)
        )

    @cached_property
    def derived_files(self) -> DataFrame:
        return self._joined.select(
            F.col("doc_id").alias("id"),
            F.concat("stem", F.lit(".mp3")).alias("original_filename"),
            F.concat(F.lit("/scratch/"), "source", F.lit("/"), "stem", F.lit(".opus")).alias(
                "opus_path"
            ),
            F.when(
                F.col("labelled"),
                F.concat(
                    F.lit("processed/"), S.date_text("done_at"), F.lit("/"), "stem", F.lit(".opus")
                ),
            ).alias("s3_opus_path"),
            F.col("source").alias("archive_source"),
            F.col("value").alias("duration_seconds"),
            F.col("n_chars").alias("file_size_bytes"),
            F.col("ts").alias("created_at"),
            F.when(F.col("labelled"), F.col("done_at")).alias("processed_at"),
            F.when(F.col("toxic") == 1, "flagged")
            .when(F.col("labelled"), "transcribed")
            .when(F.col("event_type") == "error", "failed")
            .otherwise("pending")
            .alias("status"),
            F.col("lang").alias("parquet_lang"),
            F.col("n_name").alias("parquet_country"),
            F.to_json(
                F.struct(
                    "meta_id",
                    F.col("author").alias("author_uniqueid"),
                    S.json_int("props", "k").alias("stats_playcount"),
                )
            ).alias("parquet_metadata"),
            (F.col("doc_id") % 5 == 0).alias("synced_to_ra"),
            F.when(F.col("doc_id") % 5 == 0, F.col("done_at")).alias("synced_at"),
        )

    @cached_property
    def derived_transcripts(self) -> DataFrame:
        return self._joined.filter("labelled").select(
            F.col("doc_id").alias("id"),
            F.col("doc_id").alias("audio_file_id"),
            F.col("text").alias("transcript_text"),
            F.col("lang").alias("language"),
            S.clamp_unit(F.lit(1.0) - F.col("value") / 500).alias("confidence"),
            F.col("done_at").alias("created_at"),
        )

    @cached_property
    def derived_classifications(self) -> DataFrame:
        flagged = F.col("toxic") == 1
        return self._joined.filter("labelled").select(
            F.col("doc_id").alias("id"),
            F.col("doc_id").alias("audio_file_id"),
            flagged.alias("flagged"),
            F.when(flagged, F.col("score")).otherwise(F.lit(0.0)).alias("flag_score"),
            F.when(flagged, F.lit(S.FLAG_CATEGORY)).alias("flag_category"),
            F.col("done_at").alias("created_at"),
        )

    @cached_property
    def review_rows(self) -> DataFrame:
        """The review `transcripts` table: metadata ids that were reviewed before."""
        return self._stored("transcripts", lambda: self.derived_review_rows, "meta_id")

    @cached_property
    def derived_review_rows(self) -> DataFrame:
        """One row per metadata id with a purchase on a low-quality labelled document, taken
        from the lowest such document."""
        known = self._joined.filter(
            (F.col("event_type") == "purchase") & (F.col("quality") == 0)
        ).withColumn("number", F.expr("doc_id div 8"))
        first = known.groupBy("number").agg(F.min("doc_id").alias("doc_id"))
        return known.join(first, ["number", "doc_id"], "left_semi").select(
            F.concat(F.lit("m"), "number").alias("meta_id"),
            F.year("ts").alias("year"),
            F.month("ts").alias("month"),
            F.dayofmonth("ts").alias("day"),
            F.col("text").alias("transcript"),
            F.col("ts").alias("created_at"),
            (F.col("user_id") + 1).alias("creator_id"),
            F.col("score").cast("decimal(10,9)").alias("label_1_pred"),
            F.col("n_name").alias("country"),
            "lang",
            F.when(F.col("lang") == "de", "queued").otherwise("unqueued").alias("queue_status"),
            F.lit("unreviewed").alias("review_status"),
        )

    @cached_property
    def creators(self) -> DataFrame:
        """Creators known before: the authors of large purchases."""
        return (
            self.raw("events")
            .filter((F.col("event_type") == "purchase") & (F.col("value") > 150))
            .groupBy("user_id")
            .agg(F.min("ts").alias("created_at"))
            .select(
                (F.col("user_id") + 1).alias("creator_id"),
                F.concat(F.lit("u"), "user_id").alias("author_uniqueid"),
                "created_at",
            )
        )

    def written(self, name: str, derive: Callable[[], DataFrame]) -> DataFrame:
        """A derived frame as a written table, once per session."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _WRITTEN:
            path = run_dir(self.spark, name)
            derive().write.parquet(path)
            _WRITTEN[key] = path
        return self.spark.read.parquet(_WRITTEN[key])

    def path_of(self, name: str) -> str:
        return _WRITTEN[(self.spark.sparkContext.applicationId, self.folder, name)]

    @cached_property
    def archives(self) -> DataFrame:
        """Archives of up to 64 documents of one source: audio members hold the whole texts,
        metadata members one row each. Shaped like a `binaryFile` frame."""

        def pack(docs: pd.DataFrame) -> pd.DataFrame:
            batch, kind = docs["batch_id"].iloc[0], docs["kind"].iloc[0]
            packed = io.BytesIO()
            with tarfile.open(fileobj=packed, mode={0: "w", 1: "w:gz", 2: "w:xz"}[kind]) as tar:
                for doc in docs.sort_values("doc_id").itertuples():
                    members = [(f"audio/{doc.name}", doc.text)]
                    if doc.meta_id is not None:
                        text = io.StringIO()
                        out = csv.writer(text)
                        out.writerow(["meta_id", "lang", "n_chars", "score", "note"])
                        out.writerow([doc.meta_id, doc.lang, doc.n_chars, doc.score, 'a "b", c'])
                        members.append((f"metadata/{doc.stem}.txt", text.getvalue()))
                    for name, body in members:
                        data = body.encode("utf-8")
                        info = tarfile.TarInfo(name)
                        info.size = len(data)
                        tar.addfile(info, io.BytesIO(data))
            content = packed.getvalue()
            return pd.DataFrame(
                {
                    "path": [f"archives/{batch}.tar"],
                    "length": [len(content)],
                    "content": [content],
                }
            )

        def derive() -> DataFrame:
            block = F.expr("doc_id div 64")
            docs = self._joined.select(
                "doc_id",
                "text",
                "lang",
                "n_chars",
                "score",
                "meta_id",
                "stem",
                F.concat_ws("-", "source", block).alias("batch_id"),
                (block % 3).cast("int").alias("kind"),
                F.concat(
                    "stem", F.when(F.col("lang") == "de", ".MP3").otherwise(".mp3")
                ).alias("name"),
            )
            return docs.groupBy("batch_id").applyInPandas(
                pack, "path STRING, length BIGINT, content BINARY"
            )

        return self.written("archives", derive)

    @cached_property
    def archive_files(self) -> DataFrame:
        """The archives as files below one folder, (path, key, length) as listed."""
        key = (self.spark.sparkContext.applicationId, self.folder, "archive_files")
        if key not in _WRITTEN:
            root = run_dir(self.spark, "archive-files")

            def put(batches):
                for batch in batches:
                    paths, contents = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                    for path, content in zip(paths, contents):
                        system, within = storage.resolve(f"{root}/{path}")
                        system.create_dir(within.rpartition("/")[0])
                        with system.open_output_stream(within) as out:
                            out.write(content)
                    yield batch.select(["path"])

            self.archives.select("path", "content").mapInArrow(put, "path STRING").count()
            _WRITTEN[key] = root
        root = _WRITTEN[key]
        listed = list_objects(self.spark, root)
        return listed.select(F.concat(F.lit(f"{root}/"), "key").alias("path"), "key", "length")

    @cached_property
    def members(self) -> DataFrame:
        """Extracted members of the archives, metadata content kept."""
        return self.written("members", lambda: batch_members(self.archive_files))

    @cached_property
    def unified_files(self) -> DataFrame:
        """The unified variant: flagged files are `classified`, or `synced` with a meta_id."""
        synced = F.col("synced_to_ra")
        return self.audio_files.withColumns(
            {
                "meta_id": F.when(synced, S.json_text("parquet_metadata", "meta_id")),
                "status": F.when(
                    F.col("status") == "flagged", F.when(synced, "synced").otherwise("classified")
                ).otherwise(F.col("status")),
            }
        )

    @cached_property
    def segments(self) -> DataFrame:
        """Recognised segments: one per conversation turn, every fourth without a log-prob."""
        return self.raw("conversations").select(
            F.col("conv_id").alias("audio_file_id"),
            F.col("turn").cast("int").alias("idx"),
            "text",
            F.when(F.col("turn") % 4 != 3, (-(F.col("turn") % 5)).cast("double")).alias(
                "avg_logprob"
            ),
        )


PRELUDE = """
joined AS (
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic,
           e.ts, e.user_id, e.event_type, e.value, e.props, n.n_name,
           l.toxic IS NOT NULL AS labelled,
           'v' || d.doc_id AS stem,
           e.ts + INTERVAL 1 HOUR AS done_at,
           CASE WHEN d.doc_id % 11 <> 0 THEN 'm' || (d.doc_id // 8) END AS meta_id,
           'u' || e.user_id AS author,
           (50 + d.doc_id % 50)::DOUBLE / 100 AS score
    FROM documents d
    LEFT JOIN labels l ON l.doc_id = d.doc_id
    LEFT JOIN events e ON e.event_id = d.doc_id
    LEFT JOIN nation n ON n.n_nationkey = e.user_id % 25
),
audio_files AS (
    SELECT doc_id AS id, stem || '.mp3' AS original_filename,
           '/scratch/' || source || '/' || stem || '.opus' AS opus_path,
           CASE WHEN labelled
                THEN 'processed/' || strftime(done_at, '%Y-%m-%d') || '/' || stem || '.opus'
           END AS s3_opus_path,
           source AS archive_source, value AS duration_seconds, n_chars AS file_size_bytes,
           ts AS created_at, CASE WHEN labelled THEN done_at END AS processed_at,
           CASE WHEN toxic = 1 THEN 'flagged' WHEN labelled THEN 'transcribed'
                WHEN event_type = 'error' THEN 'failed' ELSE 'pending' END AS status,
           lang AS parquet_lang, n_name AS parquet_country,
           '{' || concat_ws(',', '"meta_id":"' || meta_id || '"',
                                 '"author_uniqueid":"' || author || '"',
                                 '"stats_playcount":' || json_extract_string(props, '$.k')) || '}'
               AS parquet_metadata,
           doc_id % 5 = 0 AS synced_to_ra,
           CASE WHEN doc_id % 5 = 0 THEN done_at END AS synced_at
    FROM joined
),
pipeline_transcripts AS (
    SELECT doc_id AS id, doc_id AS audio_file_id, text AS transcript_text, lang AS language,
           least(1.0, greatest(0.0, 1.0 - value / 500)) AS confidence, done_at AS created_at
    FROM joined WHERE labelled
),
pipeline_classifications AS (
    SELECT doc_id AS id, doc_id AS audio_file_id, toxic = 1 AS flagged,
           CASE WHEN toxic = 1 THEN score ELSE 0.0 END AS flag_score,
           CASE WHEN toxic = 1 THEN 'reportable_content' END AS flag_category,
           done_at AS created_at
    FROM joined WHERE labelled
),
review_rows AS (
    SELECT 'm' || (doc_id // 8) AS meta_id, year(ts)::INT AS year, month(ts)::INT AS month,
           day(ts)::INT AS day, text AS transcript, ts AS created_at,
           NULL::VARCHAR AS video_url, user_id + 1 AS creator_id,
           score::DECIMAL(10,9) AS label_1_pred, n_name AS country, lang,
           CASE WHEN lang = 'de' THEN 'queued' ELSE 'unqueued' END AS queue_status,
           'unreviewed' AS review_status
    FROM joined
    WHERE event_type = 'purchase' AND quality = 0
    QUALIFY row_number() OVER (PARTITION BY doc_id // 8 ORDER BY doc_id) = 1
),
creators AS (
    SELECT user_id + 1 AS creator_id, 'u' || user_id AS author_uniqueid, min(ts) AS created_at
    FROM events WHERE event_type = 'purchase' AND value > 150 GROUP BY user_id
),
unified_files AS (
    SELECT * REPLACE (CASE WHEN status = 'flagged' AND synced_to_ra THEN 'synced'
                           WHEN status = 'flagged' THEN 'classified' ELSE status END AS status),
           CASE WHEN synced_to_ra
                THEN json_extract_string(parquet_metadata, '$.meta_id') END AS meta_id
    FROM audio_files
),
segments AS (
    SELECT conv_id AS audio_file_id, turn::INT AS idx, text,
           CASE WHEN turn % 4 <> 3 THEN (-(turn % 5))::DOUBLE END AS avg_logprob
    FROM conversations
),
members AS (
    SELECT d.*, d.source || '-' || (d.doc_id // 64) AS batch_id, (d.doc_id // 64) % 3 AS kind,
           stem || CASE WHEN lang = 'de' THEN '.MP3' ELSE '.mp3' END AS name,
           CASE WHEN meta_id IS NOT NULL THEN
               '{"meta_id":"' || meta_id || '","lang":"' || lang || '","n_chars":' || n_chars
               || ',"score":' || score || ',"note":"a \\"b\\", c"}' END AS metadata
    FROM joined d
),
now_ AS (SELECT max(created_at) AS t FROM audio_files),
day_files AS (
    SELECT * FROM audio_files WHERE created_at > (SELECT t FROM now_) - INTERVAL 24 HOURS
)
"""
