"""Transcript assembly, confidence, and the harness for caller-supplied scoring functions."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auricle.functions import scalars as S

UNKNOWN_LANGUAGE = "unknown"
# Fixed value: the log-prob range that maps to a confidence of one.
LOGPROB_SCALE = 5.0
# Segments of one file that are gathered in a first step.
SEGMENT_BLOCK = 1024
# Scored rows are sent on in frames of at least this many rows.
SEND_ROWS = 256


def confidence(mean_logprob: Column, has_segments: Column) -> Column:
    """Mean log-prob mapped to 0..1; unscored segments count as 0, no segments give 0.0."""
    mapped = S.clamp_unit(F.lit(1.0) + F.coalesce(mean_logprob, F.lit(0.0)) / LOGPROB_SCALE)
    return F.when(has_segments, mapped).otherwise(F.lit(0.0))


def _ordered_text(order: str, text: str) -> Column:
    pieces = F.array_sort(F.collect_list(F.struct(order, text)))
    return F.array_join(F.transform(pieces, lambda p: p[text]), " ")


def assemble_transcripts(segments: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """(audio_file_id, text, language, confidence) from rows (audio_file_id, idx, text,
    avg_logprob).

    Segments are joined in blocks of consecutive indexes first, so a file with very many
    segments is spread over tasks and only its blocks meet in the last one. `files`
    (audio_file_id, language) adds files without any segment.
    """
    piece = F.coalesce(S.strip("text"), F.lit(""))
    blocks = (
        segments.select(
            "audio_file_id",
            F.floor(F.col("idx") / SEGMENT_BLOCK).alias("block"),
            "idx",
            piece.alias("piece"),
            "avg_logprob",
        )
        .groupBy("audio_file_id", "block")
        .agg(
            _ordered_text("idx", "piece").alias("piece"),
            F.sum("avg_logprob").alias("logprob_sum"),
            F.count("avg_logprob").alias("logprob_n"),
        )
    )
    joined = blocks.groupBy("audio_file_id").agg(
        _ordered_text("block", "piece").alias("text"),
        confidence(
            F.sum("logprob_sum") / F.nullif(F.sum("logprob_n"), F.lit(0)), F.lit(True)
        ).alias("confidence"),
    )
    if files is None:
        return joined.select(
            "audio_file_id", "text", F.lit(UNKNOWN_LANGUAGE).alias("language"), "confidence"
        )
    return files.join(joined, "audio_file_id", "left").select(
        "audio_file_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("language", F.lit(UNKNOWN_LANGUAGE)).alias("language"),
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
    )


def transcript_text(segments: Column | str) -> Column:
    """The text of an array of structs (text, avg_logprob), in array order."""
    return F.array_join(
        F.transform(S.col(segments), lambda s: F.coalesce(S.strip(s["text"]), F.lit(""))), " "
    )


def transcript_confidence(segments: Column | str) -> Column:
    scored = F.filter(
        F.transform(S.col(segments), lambda s: s["avg_logprob"]), lambda p: p.isNotNull()
    )
    total = F.aggregate(scored, F.lit(0.0), lambda a, p: a + p)
    mean = total / F.nullif(F.size(scored), F.lit(0))
    return confidence(mean, F.coalesce(F.size(S.col(segments)) > 0, F.lit(False)))


def score_rows(
    df: DataFrame,
    load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
    result_schema: str,
    model_key: str,
    batch_rows: int = 32,
    needs: str | None = None,
) -> DataFrame:
    """Apply a caller-supplied scoring function to slices of at most `batch_rows` rows.

    `load()` is called once per Python worker process and returns the function; `model_key`
    names what it loads. The function takes the columns of `df` and returns one row of result
    columns per input row. A slice that fails, or gives more or fewer rows than it got, is tried row
    by row; a row that fails so keeps null results and its message in `error`. Rows with null in the column `needs` are not scored.
    Scored rows are sent on after a few slices, so a task holds no more of them than that.
    """
    send_rows = batch_rows * max(1, SEND_ROWS // batch_rows)
    results = T._parse_datatype_string(result_schema)
    names = [f.name for f in results.fields]
    output = T.StructType([*df.schema.fields, *results.fields, T.StructField("error", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _loaded(model_key, load)
        for pdf in frames:
            idle = None if needs is None else pdf[needs].isna()
            if idle is not None and idle.any():
                unscored = pdf[idle]
                for start in range(0, len(unscored), send_rows):
                    yield _unscored(unscored.iloc[start : start + send_rows], names)
            if idle is not None:
                pdf = pdf[~idle]
            for begin in range(0, len(pdf), send_rows):
                yield pd.concat(
                    [
                        _score_slice(model, part.reset_index(drop=True), names)
                        for part in _slices(pdf.iloc[begin : begin + send_rows], batch_rows)
                    ],
                    ignore_index=True,
                )

    return df.mapInPandas(run, output)


def _slices(pdf: pd.DataFrame, rows: int) -> Iterator[pd.DataFrame]:
    for start in range(0, len(pdf), rows):
        yield pdf.iloc[start : start + rows]


def _loaded(key: str, load: Callable):
    """The loaded function of this worker process; it outlives a task."""
    store = sys.modules.setdefault("_auricle_models", types.ModuleType("_auricle_models"))
    if key not in store.__dict__:
        store.__dict__[key] = load()
    return store.__dict__[key]


def _unscored(part: pd.DataFrame, names: list[str], error: str | None = None) -> pd.DataFrame:
    part = part.reset_index(drop=True)
    empty = pd.DataFrame({n: pd.Series([None] * len(part), dtype=object) for n in names})
    return pd.concat([part, empty], axis=1).assign(error=error)


def _score_slice(model, part: pd.DataFrame, names: list[str]) -> pd.DataFrame:
    try:
        scored = model(part)
        if len(scored) != len(part):
            raise ValueError(f"the model gave {len(scored)} rows for {len(part)}")
        return pd.concat([part, scored[names].reset_index(drop=True)], axis=1).assign(error=None)
    except Exception as error:
        if len(part) == 1:
            return _unscored(part, names, f"{type(error).__name__}: {error}")
        rows = [
            _score_slice(model, part.iloc[i : i + 1].reset_index(drop=True), names)
            for i in range(len(part))
        ]
        return pd.concat(rows, ignore_index=True)
