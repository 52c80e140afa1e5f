"""JSON job messages, as batch frames and as streams.

A message frame has one text column `value`. Files of text or Parquet serve as the queue here;
any Spark source that gives text values can take their place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auricle import schemas
from auricle.functions import scalars as S

_CORRUPT = "_corrupt"


def message_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """Messages arriving as files; `max_files` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).schema("value STRING")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def write_messages(messages: DataFrame, path: str) -> None:
    """Append messages to a queue folder, one JSON text per line."""
    messages.select("value").write.mode("append").text(path)


def parse_jobs(messages: DataFrame, schema: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """`value`, the columns to keep, the job fields, and `is_json`: is the message a JSON object?"""
    row = F.from_json(
        "value",
        f"{schema}, {_CORRUPT} STRING",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT},
    )
    return (
        messages.select("value", *keep, row.alias("job"))
        .withColumn(
            "is_json",
            F.coalesce(F.col(f"job.{_CORRUPT}").isNull() & F.col("job").isNotNull(), F.lit(False)),
        )
        .select("value", *keep, "is_json", "job.*")
        .drop(_CORRUPT)
    )


def unpack_jobs(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(jobs, dead letters): anything that is not a JSON object is diverted as raw text."""
    parsed = parse_jobs(messages, schemas.UNPACK_JOB)
    return parsed.filter("is_json").drop("is_json"), parsed.filter(~F.col("is_json")).select(
        "value"
    )


def transcribe_jobs(
    messages: DataFrame, keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """(jobs, rejects): a job must be a JSON object with batch_id and opus_path. Columns of the messages
    to `keep` are in both."""
    parsed = parse_jobs(messages, schemas.TRANSCRIBE_JOB, keep)
    whole = F.col("is_json") & F.col("batch_id").isNotNull() & F.col("opus_path").isNotNull()
    reason = F.when(F.col("is_json"), "missing field").otherwise("invalid JSON")
    return (
        parsed.filter(whole).drop("is_json", "value"),
        parsed.filter(~whole).select(*keep, "value", reason.alias("reason")),
    )


def dead_letter(value: Column | str, error: Column, failed_at: Column) -> Column:
    """The job's own text with error and failed_at added; all its other keys are kept."""
    text = S.strip(value)
    opened = F.substring(text, F.lit(1), F.length(text) - 1)
    comma = F.when(F.regexp_like(text, F.lit(r"^\{\s*\}$")), "").otherwise(",")
    extra = F.to_json(F.struct(error.alias("error"), S.iso_utc(failed_at).alias("failed_at")))
    return F.concat(opened, comma, F.substring(extra, F.lit(2), F.length(extra)))


def unpack_message(batch_id, s3_key, filename, transferred_at) -> Column:
    """An unpack job as JSON text."""
    return F.to_json(
        F.struct(
            S.col(batch_id).alias("batch_id"),
            S.col(s3_key).alias("s3_key"),
            S.col(filename).alias("original_filename"),
            S.iso_utc(transferred_at).alias("transferred_at"),
        )
    )


def transcribe_message(batch_id, opus_path, filename, metadata) -> Column:
    """A transcribe job as JSON text; the metadata is already JSON and goes in as an object."""
    head = F.to_json(
        F.struct(
            S.col(batch_id).alias("batch_id"),
            S.col(opus_path).alias("opus_path"),
            S.col(filename).alias("original_filename"),
        )
    )
    return F.concat(
        F.substring(head, F.lit(1), F.length(head) - 1),
        F.lit(',"parquet_metadata":'),
        S.col(metadata),
        F.lit("}"),
    )
