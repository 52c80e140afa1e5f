import gzip
import io
import json
import lzma
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from auricle.plans import retention, unpack
from auricle.sources import archives, objects
from tests.conftest import values


def tar(members, mode="w", fmt=tarfile.PAX_FORMAT):
    packed = io.BytesIO()
    with tarfile.open(fileobj=packed, mode=mode, format=fmt) as out:
        for name, body in members:
            info = tarfile.TarInfo(name)
            info.size = len(body)
            out.addfile(info, io.BytesIO(body))
    return packed.getvalue()


SONGS = [("a/x.mp3", b"1"), ("b/x.MP3", b"22"), ("y.Mp3", b"3"), ("z.txt", b"4")]


def old_tar():
    """A header without the later mark: only the checksum tells."""
    data = bytearray(tar([("x.mp3", b"1")], fmt=tarfile.USTAR_FORMAT))
    data[257:265] = b"\0" * 8
    data[148:156] = b" " * 8
    data[148:156] = b"%06o\0 " % sum(data[:512])
    return bytes(data)


@pytest.fixture
def folder(tmp_path):
    files = {
        "plain.tar": tar(SONGS),
        "mislabelled.tar.gz": tar(SONGS),
        "real.tar.gz": tar(SONGS, "w:gz"),
        "real.tar.xz": tar(SONGS, "w:xz"),
        "lzma.tar": lzma.compress(tar(SONGS), format=lzma.FORMAT_ALONE),
        "text.gz": gzip.compress(b"hello"),
        "text.xz": lzma.compress(b"hello"),
        "old.tar": old_tar(),
        "noise.tar": b"noise" * 200,
        "cut.tar": tar([("x.mp3", b"1" * 5000)])[:2000],
        "long-name.tar.gz": b"\x1f\x8b\x08\x08\0\0\0\0\0\xff" + b"n" * 70000 + b"\0"
        + gzip.compress(tar(SONGS), mtime=0)[10:],
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    return tmp_path


def by_name(df, *columns):
    rows = df.withColumn("name", F.element_at(F.split("path", "/"), -1)).collect()
    out = {}
    for r in rows:
        out.setdefault(r["name"], []).append(tuple(r[c] for c in columns))
    return out


def test_types_by_content(spark, folder):
    typed = archives.with_archive_type(objects.binary_files(spark, f"file:{folder}"))
    got = {k: v[0][0] for k, v in by_name(typed, "archive_type").items()}
    assert got == {
        "plain.tar": "tar",
        "mislabelled.tar.gz": "tar",
        "real.tar.gz": "tar.gz",
        "real.tar.xz": "tar.xz",
        "lzma.tar": "tar.xz",
        "text.gz": "gzip",
        "text.xz": "xz",
        "old.tar": "tar",
        "noise.tar": "unknown",
        "cut.tar": "tar",
        "long-name.tar.gz": "tar.gz",
    }


def test_members_and_errors(spark, folder):
    got = by_name(
        archives.read_members(objects.binary_files(spark, f"file:{folder}")),
        "member_path", "size", "content", "error",
    )
    for name in ("plain.tar", "mislabelled.tar.gz", "real.tar.gz", "real.tar.xz", "long-name.tar.gz"):
        assert [(m[0], bytes(m[2])) for m in got[name]] == SONGS, name
    for name in ("text.gz", "text.xz", "noise.tar", "cut.tar"):
        assert got[name][-1][3] is not None, name
    assert [m[0] for m in got["old.tar"]] == ["x.mp3"]


def paths(spark, folder):
    root = f"file:{folder}"
    listed = objects.list_objects(spark, root)
    return listed.select(F.concat(F.lit(f"{root}/"), "key").alias("path"))


def test_members_by_path_equal_those_of_content(spark, folder):
    (folder / "empty.tar").write_bytes(b"")
    (folder / "twice.tar").write_bytes(tar([("a.mp3", b"old"), ("metadata/b.txt", b"m"), ("a.mp3", b"new")]))
    (folder / "evil.tar").write_bytes(tar([("../../a.mp3", b"x")]))
    many = [(f"m{k}.txt", b"%d" % k) for k in range(3000)]
    (folder / "many.tar").write_bytes(tar(many))
    (folder / "many.tar.gz").write_bytes(tar(many, "w:gz"))
    columns = ("member_path", "size", "content", "has_metadata_dir", "error")
    got = by_name(archives.read_members(paths(spark, folder)), *columns)
    want = by_name(archives.read_members(objects.binary_files(spark, f"file:{folder}")), *columns)
    del got["empty.tar"]  # binaryFile gives no row for it
    assert got.keys() == want.keys()
    for name in want:
        if want[name][-1][4]:
            kinds = [r[4].split(":")[0] for r in got[name]]
            assert kinds == [want[name][-1][4].split(":")[0]], name
        else:
            assert sorted(got[name]) == sorted(want[name]), name
    some = archives.read_members(paths(spark, folder), [".txt"])
    held = {(r.path.rsplit("/", 1)[1], r.member_path) for r in some.where("content is not null").collect()}
    assert ("plain.tar", "z.txt") in held and len(held) == 6000 + 6 + 1
    assert archives.read_members(paths(spark, folder), []).where("content is not null").isEmpty()


def test_links_are_followed(spark, tmp_path):
    for name, mode in (("l.tar", "w"), ("l.tar.gz", "w:gz")):
        with tarfile.open(tmp_path / name, mode) as out:
            body = tarfile.TarInfo("a.mp3")
            body.size = 3
            out.addfile(body, io.BytesIO(b"abc"))
            link = tarfile.TarInfo("b.mp3")
            link.type, link.linkname = tarfile.LNKTYPE, "a.mp3"
            out.addfile(link)
    got = by_name(archives.read_members(paths(spark, tmp_path)), "member_path", "content", "error")
    for name in ("l.tar", "l.tar.gz"):
        assert sorted(got[name]) == [("a.mp3", b"abc", None), ("b.mp3", b"abc", None)], got


def test_archive_over_two_gibibytes(spark, tmp_path):
    size = 5 << 29  # a hole in a file, which takes no room on disk
    with open(tmp_path / "large.tar", "wb") as out:
        for name, length in (("first.txt", 5), ("hole.mp3", size), ("last.txt", 4)):
            info = tarfile.TarInfo(name)
            info.size = length
            out.write(info.tobuf(tarfile.GNU_FORMAT))
            if length < 512:
                out.write(name.encode()[:length].ljust(512, b"\0"))
            else:
                out.seek(length, 1)
        out.write(b"\0" * 1024)
    members = archives.read_members(paths(spark, tmp_path), [".txt"])
    got = {r.member_path: (r.size, r.content and bytes(r.content)) for r in members.collect()}
    assert got == {"first.txt": (5, b"first"), "hole.mp3": (size, None), "last.txt": (4, b"last")}
    assert values(archives.audio_stems(paths(spark, tmp_path)), "meta_id") == [("hole",)]


def test_keys_are_cut_by_the_length_of_the_root(spark, tmp_path):
    root = tmp_path / "R"
    inner = root / "x" / "R"
    inner.mkdir(parents=True)
    (inner / "b.tar").write_bytes(b"")
    (root / ".hidden").write_bytes(b"1")
    (root / "_also").mkdir()
    (root / "_also" / "c:d%20 +.tar").write_bytes(b"12")
    got = values(objects.list_objects(spark, f"file:{root}"), "key", "length")
    assert got == [(".hidden", 1), ("_also/c:d%20 +.tar", 2), ("x/R/b.tar", 0)]
    assert objects.list_objects(spark, f"file:{root}", "none").collect() == []
    assert values(objects.list_objects(spark, f"file:{root}/", "x/", "*.t[ab]r"), "key") == [("x/R/b.tar",)]


def test_stems_take_any_case_but_audio_members_two(spark, folder):
    one = objects.binary_files(spark, f"file:{folder}/plain.tar")
    assert values(archives.audio_stems(one), "meta_id") == [("x",), ("x",), ("y",)]
    audio = archives.audio_members(archives.read_members(one, []))
    assert values(audio, "member_path", "content") == [("a/x.mp3", None), ("b/x.MP3", None)]


def test_last_of_repeated_names_and_unsafe_names(spark, tmp_path):
    (tmp_path / "twice.tar").write_bytes(tar([("a.mp3", b"old"), ("a.mp3", b"new")]))
    (tmp_path / "evil.tar").write_bytes(tar([("../../a.mp3", b"x")]))
    got = by_name(
        archives.read_members(objects.binary_files(spark, f"file:{tmp_path}")), "content", "error"
    )
    assert [bytes(m[0]) for m in got["twice.tar"]] == [b"new"]
    assert "OutsideDestinationError" in got["evil.tar"][-1][1]


def test_listing_keys_are_relative(spark, folder):
    (folder / "sub").mkdir()
    (folder / "sub" / "k.txt").write_bytes(b"abc")
    listed = objects.list_objects(spark, f"file:{folder}", glob="*.txt")
    assert values(listed, "key", "length") == [("sub/k.txt", 3)]


def test_ready_archives_floor_the_age(spark, rows):
    now = "TIMESTAMP_NTZ'2025-01-01 12:00:00'"
    listing = spark.sql(
        f"""SELECT * FROM VALUES ('b.tar', 1, {now} - INTERVAL '10:59' MINUTE TO SECOND),
        ('a.tar', 1, {now} - INTERVAL '11' MINUTE), ('c.tar.lock', 1, {now} - INTERVAL '1' HOUR)
        AS t(key, length, modification_time)"""
    )
    ready = objects.ready_archives(listing, F.expr(now))
    assert values(ready, "key") == [("a.tar",)]


def test_text_value_reads_a_whole_file(spark, tmp_path):
    (tmp_path / "p.txt").write_text("line 1\nline {content_text}\n")
    value = objects.text_value(spark, f"file:{tmp_path}/p.txt")
    assert spark.range(1).select(value).first()[0] == "line 1\nline {content_text}\n"


def jobs_for(rows, *names):
    data = [
        (n, f"archives/{n}.tar", f'{{"batch_id":"{n}","extra":{{"k":1}}}}') for n in names
    ]
    return rows("batch_id STRING, s3_key STRING, value STRING", data)


@pytest.mark.parametrize("fmt", ["txt", "parquet"])
def test_unpack_job(spark, rows, tmp_path, fmt):
    import pyarrow as pa
    import pyarrow.parquet as pq

    table = io.BytesIO()
    pq.write_table(pa.table({"meta_id": ["x", "x"], "n": [1, 7]}), table)
    good = [("a/x.mp3", b"1"), ("b/y.MP3", b"2"), ("metadata/x.txt", b"n\n7\n"),
            ("meta.parquet", table.getvalue())]
    (tmp_path / "good.tar").write_bytes(tar(good))
    (tmp_path / "silent.tar").write_bytes(tar([("readme.md", b"")]))
    (tmp_path / "broken.tar").write_bytes(b"noise" * 200)
    (tmp_path / "failed.tar").write_bytes(tar([("q.mp3", b"1")]))
    conversions = rows(
        "batch_id STRING, member_path STRING, file_size_bytes BIGINT, success BOOLEAN",
        [("good", "a/x.mp3", 5, True), ("good", "b/y.MP3", 5, True), ("failed", "q.mp3", 0, False)],
    )
    members = unpack.batch_members(objects.binary_files(spark, f"file:{tmp_path}"), fmt)
    now = F.expr("TIMESTAMP_NTZ'2025-01-01 12:00:00'")
    result = unpack.unpack(
        jobs_for(rows, "good", "silent", "broken", "failed", "lost"),
        members.checkpoint(), conversions, now, fmt,
    )
    sent = {r.opus_path: json.loads(r.value) for r in result.transcribe_jobs.collect()}
    assert set(sent) == {"/data/scratch/good/x.opus", "/data/scratch/good/y.opus"}
    meta = sent["/data/scratch/good/x.opus"]["parquet_metadata"]
    assert meta["n"] == 7 and meta["meta_id"] == "x"
    assert sent["/data/scratch/good/y.opus"]["parquet_metadata"] == {}
    assert values(result.totals, "batch_id", "total") == [("good", 2)]
    stats = {r.batch_id: r.asDict() for r in result.stats.collect()}
    assert stats["good"]["metadata_matched"] == 1 and stats["good"]["mp3_found"] == 2
    assert stats["silent"]["mp3_found"] == 0 and set(stats) == {"good", "silent"}
    letters = {r.value and json.loads(r.value)["batch_id"]: json.loads(r.value) for r in result.dead_letters.collect()}
    assert set(letters) == {"broken", "failed", "lost"}
    assert letters["failed"]["extra"] == {"k": 1} and letters["failed"]["failed_at"].endswith("Z")
    assert values(result.consumed, "batch_id") == [("good",)]


def test_listing_holds_empty_objects(spark, tmp_path):
    (tmp_path / "a b").mkdir()
    content = {"a b/1+2 é%20.zip": b"", "a b/full.zip": b"abc", "c.zip": b"", "d.txt": b""}
    for name, data in content.items():
        (tmp_path / name).write_bytes(data)
        os.utime(tmp_path / name, (1_700_000_000, 1_700_000_000))
    listed = objects.list_objects(spark, f"file:{tmp_path}")
    assert {(r.key, r.length) for r in listed.collect()} == {(k, len(v)) for k, v in content.items()}
    seconds = listed.select(F.unix_seconds("modification_time").alias("s")).distinct().collect()
    assert [r.s for r in seconds] == [1_700_000_000]
    assert {r.key for r in objects.list_objects(spark, f"file:{tmp_path}", "a b", "*.zip").collect()} == {
        k for k in content if k.startswith("a b/")
    }
    plan = retention.bucket_clear(listed)
    assert {r.key for r in plan.collect()} == set(content)
    as_of = F.lit("2023-12-01 00:00:00").cast("timestamp")
    assert [r.key for r in objects.ready_archives(listed, as_of).collect()] == sorted(content)
