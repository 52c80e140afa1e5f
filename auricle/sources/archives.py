"""Tar archives: type by content, member lists, member content.

Archives come as paths, such as a listing gives, and are opened by the tasks. A first pass finds the
members: in a plain tar it seeks from header to header, in a packed one it streams. A second one
fetches the content that is asked for, of plain tars by byte ranges, so one large archive is shared
by many tasks; none ever holds more than a member at a time. A `binaryFile` frame, with the content
of small archives in its rows, is taken as well.
"""

from __future__ import annotations

import io
import lzma
import tarfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auricle.functions import scalars as S
from auricle.session import staged
from auricle.sources import storage

# Leading bytes of the compressed formats, and the tar mark with its offset.
GZIP_MAGIC = "1f8b"
XZ_MAGIC = "fd377a585a00"
LZMA_MAGIC = "5d0000"
TAR_MAGIC = "7573746172"
TAR_OFFSET = 257
HEADER_BYTES = 512
# Compressed bytes that are sent along to find the first 512 plain bytes.
PROBE_BYTES = 1 << 16
# As many more are looked at where the packed stream's own header is longer.
HEAD_LIMIT = 1 << 20
# Members are sent on in frames of about this many bytes.
EMIT_BYTES = 32 << 20

MEMBER_SCHEMA = (
    "path STRING, position INT, member_path STRING, size BIGINT, content BINARY, "
    "has_metadata_dir BOOLEAN, error STRING"
)


def _hex(content: Column, start: int, length: int) -> Column:
    return F.lower(F.hex(F.substring(content, start, length)))


def _plain_head(data: bytes) -> bytes:
    """The first plain bytes of a gzip, xz or lzma stream; empty when it cannot be read."""
    try:
        if data[:2] == b"\x1f\x8b":
            return zlib.decompressobj(wbits=31).decompress(data, HEADER_BYTES)
        return lzma.LZMADecompressor().decompress(data, HEADER_BYTES)
    except (zlib.error, lzma.LZMAError, EOFError):
        return b""


@F.pandas_udf(T.BinaryType())
def _plain_heads(heads: pd.Series) -> pd.Series:
    return heads.map(lambda data: None if data is None else _plain_head(bytes(data)))


def _is_tar_head(head: bytes) -> bool:
    """Is the block a tar header by its checksum (tar without the later mark)?"""
    try:
        tarfile.TarInfo.frombuf(head[:HEADER_BYTES], "utf-8", "surrogateescape")
        return True
    except tarfile.HeaderError:
        return False


@F.pandas_udf(T.BooleanType())
def _old_tar(heads: pd.Series) -> pd.Series:
    return heads.map(lambda data: data is not None and _is_tar_head(bytes(data)))


def _kind(content: bytes) -> str:
    """The archive type where the whole content is at hand; agrees with `with_archive_type`."""
    mark = bytes.fromhex(TAR_MAGIC)
    end = TAR_OFFSET + len(mark)
    for magic, plain in ((GZIP_MAGIC, "gzip"), (XZ_MAGIC, "xz"), (LZMA_MAGIC, "xz")):
        if content.startswith(bytes.fromhex(magic)):
            packed = {"gzip": "tar.gz", "xz": "tar.xz"}[plain]
            return packed if _plain_head(content)[TAR_OFFSET:end] == mark else plain
    tar = content[TAR_OFFSET:end] == mark or _is_tar_head(content)
    return "tar" if tar else "unknown"


def with_archive_type(archives: DataFrame) -> DataFrame:
    """Add `archive_type` from the content: tar, gzip, tar.gz, xz, tar.xz or unknown.

    Only the head of each archive goes to Python. A compressed head too short to give a header
    is followed by a second look at the whole content of just those rows.
    """
    content = F.col("content")
    is_gzip = _hex(content, 1, 2) == GZIP_MAGIC
    is_xz = (_hex(content, 1, 6) == XZ_MAGIC) | (_hex(content, 1, 3) == LZMA_MAGIC)
    has_mark = _hex(content, TAR_OFFSET + 1, 5) == TAR_MAGIC
    packed = is_gzip | is_xz
    looked = archives.withColumns(
        {
            "_head": _plain_heads(F.when(packed, F.substring(content, 1, PROBE_BYTES))),
            "_old": _old_tar(F.when(~packed & ~has_mark, F.substring(content, 1, HEADER_BYTES))),
        }
    )
    short = (F.length("_head") < TAR_OFFSET + 5) & (F.length(content) > PROBE_BYTES)
    looked = looked.withColumn(
        "_head", F.coalesce(_plain_heads(F.when(short, content)), F.col("_head"))
    )
    inner_tar = F.coalesce(_hex(F.col("_head"), TAR_OFFSET + 1, 5) == TAR_MAGIC, F.lit(False))
    kind = (
        F.when(is_gzip & inner_tar, "tar.gz")
        .when(is_gzip, "gzip")
        .when(is_xz & inner_tar, "tar.xz")
        .when(is_xz, "xz")
        .when(has_mark | F.col("_old"), "tar")
        .otherwise("unknown")
    )
    return looked.withColumn("archive_type", kind).drop("_head", "_old")


def _open_tar(content: bytes, kind: str) -> tarfile.TarFile:
    modes = {"tar.gz": ["r:gz"], "tar.xz": ["r:xz"]}.get(kind, ["r:", "r:gz", "r:xz"])
    for mode in modes:
        try:
            return tarfile.open(fileobj=io.BytesIO(content), mode=mode)
        except tarfile.ReadError as error:
            failure = error
    raise failure


# Bytes of members that one task fetches from a plain tar.
RANGE_BYTES = 128 << 20
# Members that the tarfile object may remember; it keeps all of them if nobody clears them.
FORGET = 1024

_FOUND = (
    "path STRING, kind STRING, position INT, name STRING, member_path STRING, size BIGINT, "
    "at BIGINT, plain BOOLEAN, link BOOLEAN, error STRING"
)


def _file_kind(file) -> str:
    """The archive type from the head of an open file."""
    head = file.read(PROBE_BYTES)
    kind = _kind(head)
    if kind in ("gzip", "xz") and len(head) == PROBE_BYTES and not _plain_head(head):
        # the head ends within the packed stream's own header
        kind = _kind(head + file.read(HEAD_LIMIT - PROBE_BYTES))
    file.seek(0)
    return kind


def _walk(
    file, kind: str, links: bool = False
) -> Iterator[tuple[int, tarfile.TarInfo, tarfile.TarFile]]:
    """The members in order. Plain tars are walked by seeking, packed ones unpacked on the way.
    Earlier members are forgotten unless links to them are to be followed."""
    mode = {"tar": "r:", "tar.gz": "r:gz", "tar.xz": "r:xz", "gzip": "r:gz", "xz": "r:xz"}[kind]
    with tarfile.open(fileobj=file, mode=mode) as tar:
        position = 0
        while (member := tar.next()) is not None:
            yield position, member, tar
            position += 1
            if len(tar.members) > FORGET and not links:
                tar.members = tar.members[-1:]


def _frame(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = {"STRING": pa.string(), "INT": pa.int32(), "BIGINT": pa.int64(), "BOOLEAN": pa.bool_(),
             "BINARY": pa.binary()}
    types = [kinds[part.split()[1]] for part in schema.split(", ")]
    columns = [*zip(*rows)] or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, types)], names=names
    )


def _emit(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about EMIT_BYTES."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + sum(len(value) for value in row if isinstance(value, bytes))
        if size >= EMIT_BYTES or len(held) >= 10_000:
            yield _frame(held, schema)
            held, size = [], 0
    if held:
        yield _frame(held, schema)


def find_members(files: DataFrame) -> DataFrame:
    """(path, kind, position, name, member_path, size, at, plain, link, error): every member header of the
    archives of files(path, …), folders included; `at` is where the content of a plain one begins.

    member_path is null for what is no file or has no safe name. An archive that cannot be read to
    the end has a last row with the error, and no other columns.
    """

    def of_archive(path: str) -> Iterator[tuple]:
        try:
            with storage.open_file(path) as file:
                kind = _file_kind(file)
                if kind == "unknown":
                    yield (path, kind, *[None] * 7, "unknown archive type")
                    return
                for position, member, _ in _walk(file, kind):
                    safe = tarfile.data_filter(member, "/unpacked")
                    named = None
                    if safe is not None and not member.isdir():
                        named = safe.name.removeprefix("./")
                    plain = kind == "tar" and member.isreg() and not member.issparse()
                    yield (path, kind, position, member.name, named, member.size,
                           member.offset_data, plain, member.islnk() or member.issym(), None)
        except Exception as error:  # any unreadable archive becomes a row
            yield (path, *[None] * 8, f"{type(error).__name__}: {error}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # archives may be small and many, so one frame holds the members of several
        paths = (path for batch in batches for path in batch.column(0).to_pylist())
        yield from _emit((row for path in paths for row in of_archive(path)), _FOUND)

    width = 4 * files.sparkSession.sparkContext.defaultParallelism
    return files.select("path").repartition(max(1, width)).mapInArrow(run, _FOUND)


def _fetch(wanted: DataFrame) -> DataFrame:
    """(path, position, content, failed) of the members wanted(path, kind, position, size, at, plain,
    link).

    Plain members are dealt by ranges of their archive and read there; others need their archive
    read as a stream, once, by one task.
    """
    schema = "path STRING, position INT, content BINARY, failed STRING"

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            opened, file = None, None
            for batch in batches:
                for r in batch.to_pylist():
                    try:
                        if r["path"] != opened:
                            if file:
                                file.close()
                            file, opened = storage.open_file(r["path"]), r["path"]
                        file.seek(r["at"])
                        data = file.read(r["size"])
                        if len(data) < r["size"]:
                            raise tarfile.ReadError("unexpected end of data")
                        yield (r["path"], r["position"], data, None)
                    except Exception as error:
                        yield (r["path"], r["position"], None, f"{type(error).__name__}: {error}")
            if file:
                file.close()

        yield from _emit(rows(), schema)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for r in batch.to_pylist():
                    left = set(r["positions"])
                    try:
                        with storage.open_file(r["path"]) as file:
                            for position, member, tar in _walk(file, r["kind"], r["links"]):
                                if position in left:
                                    left.remove(position)
                                    yield (r["path"], position, tar.extractfile(member).read(), None)
                                if not left:
                                    break
                    except Exception as error:
                        for position in sorted(left):
                            yield (r["path"], position, None, f"{type(error).__name__}: {error}")

        yield from _emit(rows(), schema)

    width = max(1, 4 * wanted.sparkSession.sparkContext.defaultParallelism)
    block = F.floor(F.col("at") / RANGE_BYTES)
    plain = (
        wanted.where("plain")
        .repartition(width, "path", block)
        .sortWithinPartitions("path", "at")
        .mapInArrow(ranges, schema)
    )
    others = (
        wanted.where("not plain")
        .groupBy("path", "kind")
        .agg(F.collect_list("position").alias("positions"), F.max("link").alias("links"))
        .mapInArrow(packed, schema)
    )
    return plain.unionByName(others)


def read_files(files: DataFrame, content_suffixes: list[str] | None = None) -> DataFrame:
    """Member files of the archives of files(path, …), as `read_members` gives them.

    Archives may be of any size and are never held whole. Their headers are read in a pass of its
    own, whose rows are written to the shared folder.
    """
    found = staged(find_members(files))
    broken = found.where("error is not null").select("path", "error")
    good = found.where("error is null").join(broken, "path", "left_anti")
    # a later member of the same name replaces the earlier one
    last = good.groupBy("path", "name").agg(F.max("position").alias("position"))
    folders = good.groupBy("path").agg(
        F.max(F.regexp_replace("name", r"^\./", "").startswith("metadata/")).alias(
            "has_metadata_dir"
        )
    )
    kept = (
        good.where("member_path is not null")
        .join(last, ["path", "name", "position"], "left_semi")
        .join(folders, "path", "left")
    )
    wanted = kept
    if content_suffixes is not None:
        asked = F.lit(False)
        for suffix in content_suffixes:
            asked = asked | F.lower("member_path").endswith(suffix)
        wanted = kept.where(asked)
    columns = [part.split()[0] for part in MEMBER_SCHEMA.split(", ")]
    broken = broken.select("path", *[F.lit(None).alias(c) for c in columns[1:-1]], "error")
    if content_suffixes == []:
        members = kept.withColumns({"content": F.lit(None).cast("binary"), "failed": F.lit(None)})
    else:
        fetched = _fetch(wanted.select("path", "kind", "position", "size", "at", "plain", "link"))
        members = kept.join(fetched, ["path", "position"], "left")
    return members.select(*columns[:-1], F.col("failed").alias("error")).unionByName(broken).to(
        files.sparkSession.createDataFrame([], MEMBER_SCHEMA).schema
    )


def _members(path: str, content: bytes, suffixes: tuple[str, ...] | None):
    """Rows of one archive; a problem gives a last row with the error."""
    kind = _kind(content)
    if kind == "unknown":
        yield (path, None, None, None, None, None, "unknown archive type")
        return
    try:
        with _open_tar(content, kind) as tar:
            entries = tar.getmembers()
            # A later member of the same name replaces the earlier one.
            last = {m.name: i for i, m in enumerate(entries)}
            folder = any(n.removeprefix("./").startswith("metadata/") for n in last)
            for i, member in enumerate(entries):
                safe = tarfile.data_filter(member, "/unpacked")
                if safe is None or member.isdir() or last[member.name] != i:
                    continue
                name = safe.name.removeprefix("./")
                wanted = suffixes is None or name.lower().endswith(suffixes)
                data = tar.extractfile(member).read() if wanted else None
                yield (path, i, name, member.size, data, folder, None)
    except Exception as error:  # any unreadable archive becomes a row
        yield (path, None, None, None, None, None, f"{type(error).__name__}: {error}")


def read_members(archives: DataFrame, content_suffixes: list[str] | None = None) -> DataFrame:
    """Member files of each archive, with content for the given suffixes (None: for all).

    Rows with `error` set stand for archives that could not be read to the end. Archives without a
    `content` column are opened by their path, and may be of any size.
    """
    if "content" not in archives.columns:
        return read_files(archives, content_suffixes)
    suffixes = None if content_suffixes is None else tuple(content_suffixes)

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = "path position member_path size content has_metadata_dir error".split()

        def frame(rows):
            out = pd.DataFrame(rows, columns=names)
            out["position"] = out["position"].astype("Int32")
            out["size"] = out["size"].astype("Int64")
            return out

        for pdf in frames:
            rows, held = [], 0
            for path, content in zip(pdf["path"], pdf["content"]):
                for row in _members(path, bytes(content), suffixes):
                    rows.append(row)
                    held += len(row[4] or b"") + 200
                    if held >= EMIT_BYTES:
                        yield frame(rows)
                        rows, held = [], 0
            if rows:
                yield frame(rows)

    return archives.select("path", "content").mapInPandas(extract, MEMBER_SCHEMA)


def audio_stems(archives: DataFrame) -> DataFrame:
    """(path, meta_id) for each member that is an mp3 in any case, in any folder."""
    members = read_members(archives, [])
    return members.filter(S.has_suffix("member_path", ".mp3")).select(
        "path", S.path_stem("member_path").alias("meta_id")
    )


def audio_members(members: DataFrame) -> DataFrame:
    """Members that are unpacked as audio: suffix .mp3 or .MP3, no other case."""
    name = F.col("member_path")
    return members.filter(name.endswith(".mp3") | name.endswith(".MP3"))
