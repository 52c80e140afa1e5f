"""Item metadata from Parquet files and from one-row text files."""

from __future__ import annotations

import csv
import io
import json
import math
from collections.abc import Iterator

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auricle.functions import scalars as S
from auricle.operators.ranking import last_per_key
from auricle.session import run_dir
from auricle.sources.objects import binary_files


def read_parquet_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(meta_id, metadata): the last row of each id over all Parquet files below a path.

    Files may have different columns, and columns that differ by case only, so the wide scan
    runs in a session of its own that keeps cases apart. Where a column has types that do not merge,
    files are scanned by groups of one schema. The result, the row as JSON, is written once as a
    narrow table. Corrupt files are skipped. "Last" is by file path, then position.
    """
    wide = spark.newSession()
    wide.conf.set("spark.sql.caseSensitive", "true")
    try:
        parts = [_scan(wide, [path], merge=True)]
    except (PySparkException, Py4JJavaError) as error:
        if "MERGE_SCHEMA" not in str(error):
            raise
        parts = [_scan(wide, paths) for paths in _same_schema(spark, path)]
    parts = [p for p in parts if p is not None]
    if not parts:
        return spark.createDataFrame([], "meta_id STRING, metadata STRING")
    target = run_dir(spark, "metadata-rows")
    for part in parts:
        part.write.mode("append").parquet(target)
    narrow = spark.read.schema(
        "meta_id STRING, metadata STRING, file_path STRING, row_index BIGINT"
    ).parquet(target)
    return last_per_key(narrow, "meta_id", ["file_path", "row_index"]).select(
        "meta_id", "metadata"
    )


def _scan(wide: SparkSession, paths: list[str], merge: bool = False) -> DataFrame | None:
    """The rows of the files as JSON with their place; None when they have no key column."""
    rows = (
        wide.read.option("mergeSchema", str(merge).lower())
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("ignoreCorruptFiles", "true")
        .parquet(*paths)
    )
    if "meta_id" not in rows.columns:
        return None
    return rows.filter(F.col("meta_id").isNotNull()).select(
        F.col("meta_id").cast("string").alias("meta_id"),
        F.to_json(
            F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "false"}
        ).alias("metadata"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.row_index").alias("row_index"),
    )


def _same_schema(spark: SparkSession, path: str) -> list[list[str]]:
    """The files below a path grouped by their columns and types; unreadable files are left out.

    The schemas are read in tasks; the driver sees the names of the files, as any scan's does.
    """

    def schemas(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq

        for pdf in frames:
            found = []
            for content in pdf["content"]:
                try:
                    schema = pq.ParquetFile(io.BytesIO(bytes(content))).schema_arrow
                    found.append(schema.remove_metadata().to_string())
                except Exception:  # a broken file is left out, the others go on
                    found.append(None)
            yield pdf[["path"]].assign(columns=pd.Series(found, dtype=object, index=pdf.index))

    read = binary_files(spark, path, "*.parquet").select("path", "content")
    groups = (
        read.mapInPandas(schemas, "path STRING, columns STRING")
        .filter("columns is not null")
        .groupBy("columns")
        .agg(F.sort_array(F.collect_list("path")).alias("paths"))
        .orderBy("columns")
        .collect()
    )
    return [list(g["paths"]) for g in groups]


def coalesce_case_pairs(df: DataFrame) -> DataFrame:
    """Merge columns whose names differ by case only; the first spelling keeps its name.

    Needs a session with spark.sql.caseSensitive set.
    """
    groups: dict[str, list[str]] = {}
    for name in df.columns:
        groups.setdefault(name.lower(), []).append(name)
    return df.select(
        *[F.coalesce(*[F.col(f"`{n}`") for n in names]).alias(names[0]) for names in groups.values()]
    )


def _finite(value):
    """The value with numbers that JSON lacks as text, as the column functions write them."""
    if isinstance(value, float) and not math.isfinite(value):
        return "NaN" if math.isnan(value) else "Infinity" if value > 0 else "-Infinity"
    if isinstance(value, dict):
        return {k: _finite(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_finite(v) for v in value]
    return value


def parse_parquet_members(members: DataFrame) -> DataFrame:
    """(path, member_path, position, meta_id, metadata) from Parquet members of archives.

    Unreadable members are skipped; rows without an id are dropped.
    """

    def rows_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq

        for pdf in frames:
            for path, name, content in zip(pdf["path"], pdf["member_path"], pdf["content"]):
                try:
                    batches = pq.ParquetFile(io.BytesIO(bytes(content))).iter_batches(4096)
                    at = 0
                    for batch in batches:
                        rows = batch.to_pylist()
                        yield pd.DataFrame(
                            {
                                "path": path,
                                "member_path": name,
                                "position": range(at, at + len(rows)),
                                "meta_id": [
                                    None if r.get("meta_id") is None else str(r["meta_id"])
                                    for r in rows
                                ],
                                "metadata": [
                                    json.dumps(_finite(r), default=str, ensure_ascii=False)
                                    for r in rows
                                ],
                            }
                        )
                        at += len(rows)
                except Exception:  # a broken file is left out, the others go on
                    continue

    parsed = members.select("path", "member_path", "content").mapInPandas(
        rows_of,
        "path STRING, member_path STRING, position BIGINT, meta_id STRING, metadata STRING",
    )
    return parsed.filter(F.col("meta_id").isNotNull())


def _first_record(content: bytes):
    """(names, cells, surplus) of the first data row, or None without one."""
    reader = csv.reader(io.StringIO(content.decode("utf-8"), newline=None))
    names = next(reader, None)  # the first line is the header, even a blank one
    records = [r for r in reader if r]  # the whole file must be well formed
    cells = records[0] if records else None
    if names is None or cells is None:
        return None
    known = dict(zip(names, cells + [None] * (len(names) - len(cells))))
    return list(known.keys()), list(known.values()), cells[len(names) :]


def parse_txt_files(files: DataFrame) -> DataFrame:
    """One row per metadata text file: its own columns, the stem as key, and the row as JSON.

    `files` has `content` and `name` (a path). Python splits the comma-separated text; value
    types are inferred by column functions. Files without a data row, or that are not UTF-8 or
    not well formed, are left out.
    """
    carried = [f for f in files.schema.fields if f.name != "content"]
    layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried)
    names = [f.name for f in carried]

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            records = []
            for content in pdf["content"]:
                try:
                    records.append(_first_record(bytes(content)))
                except (UnicodeDecodeError, csv.Error):
                    records.append(None)
            keep = [r is not None for r in records]
            found = [r for r in records if r is not None]
            out = pdf.loc[keep, names].copy()
            for i, column in enumerate(("fields", "cells", "surplus")):
                out[column] = pd.Series([r[i] for r in found], index=out.index, dtype=object)
            yield out

    parsed = files.mapInPandas(
        parse, f"{layout}, fields ARRAY<STRING>, cells ARRAY<STRING>, surplus ARRAY<STRING>"
    )
    return parsed.withColumn("stem", S.path_stem("name")).select(
        *names, F.col("stem"), _row_json().alias("metadata")
    )


def _row_json() -> Column:
    """The record as JSON: typed cells, surplus cells under "null", the key when it is missing."""
    pairs = F.transform(
        F.arrays_zip("fields", "cells"),
        lambda e: F.concat(S.json_quote(e["fields"]), F.lit(":"), S.cell_json(e["cells"])),
    )
    surplus = F.when(
        F.size("surplus") > 0,
        F.array(F.concat(F.lit('"null":'), F.to_json("surplus"))),
    ).otherwise(F.array().cast("array<string>"))
    key = F.when(
        ~F.array_contains("fields", "meta_id"),
        F.array(F.concat(F.lit('"meta_id":'), S.json_quote(F.col("stem")))),
    ).otherwise(F.array().cast("array<string>"))
    return F.concat(F.lit("{"), F.array_join(F.concat(pairs, surplus, key), ","), F.lit("}"))


def read_txt_metadata(spark: SparkSession, root: str) -> DataFrame:
    """(stem, metadata) of the text files of one folder tree; see `pick_txt` for which count."""
    marker = root.rstrip("/").split(":", 1)[-1].lstrip("/") + "/"
    name = F.substring_index("path", marker, -1)
    has_folder = (
        binary_files(spark, root)
        .agg(F.coalesce(F.max(name.startswith("metadata/")), F.lit(False)))
        .scalar()
    )
    named = binary_files(spark, root, "*.txt").select(
        name.alias("name"), "content", has_folder.alias("has_metadata_dir")
    )
    parsed = parse_txt_files(pick_txt(named))
    return last_per_key(parsed, "stem", ["name"]).select("stem", "metadata")


def pick_txt(files: DataFrame) -> DataFrame:
    """Text files that hold metadata: directly inside metadata/ when there is such a folder,
    else anywhere."""
    direct = F.col("name").startswith("metadata/") & (F.size(F.split("name", "/")) == 2)
    return files.filter(
        F.col("name").endswith(".txt") & (direct | ~F.col("has_metadata_dir"))
    ).drop("has_metadata_dir")
