import json

import pyarrow as pa
import pyarrow.parquet as pq

from auricle.sources import metadata
from tests.conftest import values


def write(folder, name, content):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())


def read(spark, folder):
    found = metadata.read_txt_metadata(spark, f"file:{folder}").collect()
    return {r.stem: json.loads(r.metadata) for r in found}


def test_txt_rows(spark, tmp_path):
    write(tmp_path, "a.txt", "meta_id,n,f,t,e\nother,007,1.5e3,1e5,\n")
    write(tmp_path, "sub/b.txt", 'x,"y, z"\r\n"q ""r""",9\r\n3,4\r\n')
    write(tmp_path, "short.txt", "p,q\n1\n")
    write(tmp_path, "long.txt", "p\n1,2,3\n")
    write(tmp_path, "header.txt", "p,q\n")
    write(tmp_path, "empty.txt", "")
    write(tmp_path, "latin.txt", b"p\n\xe9\n")
    write(tmp_path, "big.txt", "p\n12345678901234567890\n")
    write(tmp_path, "quote.txt", 'p\n"a\\b/c\n d"\n')
    got = read(spark, tmp_path)
    assert got == {
        "a": {"meta_id": "other", "n": 7, "f": 1500.0, "t": "1e5", "e": ""},
        "b": {"x": 'q "r"', "y, z": 9, "meta_id": "b"},
        "short": {"p": 1, "q": None, "meta_id": "short"},
        "long": {"p": 1, "null": ["2", "3"], "meta_id": "long"},
        "big": {"p": 12345678901234567890, "meta_id": "big"},
        "quote": {"p": "a\\b/c\n d", "meta_id": "quote"},
    }


def test_txt_only_directly_inside_the_metadata_folder(spark, tmp_path):
    write(tmp_path, "metadata/a.txt", "p\n1\n")
    write(tmp_path, "metadata/deep/b.txt", "p\n1\n")
    write(tmp_path, "c.txt", "p\n1\n")
    assert set(read(spark, tmp_path)) == {"a"}


def test_txt_folder_without_txt_files_still_counts(spark, tmp_path):
    write(tmp_path, "metadata/readme.md", "x")
    write(tmp_path, "c.txt", "p\n1\n")
    assert read(spark, tmp_path) == {}


def test_parquet_rows(spark, tmp_path):
    def save(name, **columns):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        pq.write_table(pa.table(columns), tmp_path / name)

    save("a/1.parquet", meta_id=["x", "y", None], stats_playcount=[1, 2, 3], stats_playCount=[4, 5, 6])
    save("b/2.parquet", meta_id=["x", "x"], other=["first", "last"])
    write(tmp_path, "b/broken.parquet", b"not parquet")
    found = metadata.read_parquet_metadata(spark, f"file:{tmp_path}").collect()
    got = {r.meta_id: {k: v for k, v in json.loads(r.metadata).items() if v is not None} for r in found}
    assert got == {
        "x": {"meta_id": "x", "other": "last"},
        "y": {"meta_id": "y", "stats_playcount": 2, "stats_playCount": 5},
    }
    assert spark.conf.get("spark.sql.caseSensitive") == "false"


def test_parquet_without_the_key_gives_nothing(spark, tmp_path):
    pq.write_table(pa.table({"a": [1]}), tmp_path / "x.parquet")
    assert metadata.read_parquet_metadata(spark, f"file:{tmp_path}").count() == 0


def test_case_pairs(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.caseSensitive", "true")
    df = session.createDataFrame([(None, 2, 3), (1, 5, None)], "a INT, A INT, b INT")
    merged = metadata.coalesce_case_pairs(df)
    assert merged.columns == ["a", "b"]
    assert values(merged) == [(1, None), (2, 3)]


def test_parquet_members(spark, tmp_path):
    pq.write_table(pa.table({"meta_id": [1, None, 3], "v": ["a", "b", "é"]}), tmp_path / "m.parquet")
    data = (tmp_path / "m.parquet").read_bytes()
    members = spark.createDataFrame(
        [("k", "m.parquet", bytearray(data)), ("k", "bad.parquet", bytearray(b"zz"))],
        "path STRING, member_path STRING, content BINARY",
    )
    got = values(metadata.parse_parquet_members(members), "meta_id", "position", "metadata")
    assert got == [("1", 0, '{"meta_id": 1, "v": "a"}'), ("3", 2, '{"meta_id": 3, "v": "é"}')]


def test_files_whose_types_do_not_merge(spark, tmp_path):
    def save(name, **columns):
        pq.write_table(pa.table(columns), tmp_path / name)

    save("1.parquet", meta_id=["x", "y"], n=[1, 2])
    save("2.parquet", meta_id=["y", "z"], n=["two", "three"])
    save("3.parquet", other=[1])
    (tmp_path / "4.parquet").write_bytes(b"broken")
    found = metadata.read_parquet_metadata(spark, f"file:{tmp_path}").collect()
    got = {r.meta_id: json.loads(r.metadata) for r in found}
    assert got == {
        "x": {"meta_id": "x", "n": 1},
        "y": {"meta_id": "y", "n": "two"},
        "z": {"meta_id": "z", "n": "three"},
    }


def test_numbers_that_json_lacks(spark, rows, tmp_path):
    table = pa.table({"meta_id": ["a"], "f": [float("nan")], "g": [[float("inf"), 1.5]]})
    pq.write_table(table, tmp_path / "m.parquet")
    content = (tmp_path / "m.parquet").read_bytes()
    members = rows("path STRING, member_path STRING, content BINARY", [("p", "m.parquet", content)])
    (row,) = metadata.parse_parquet_members(members).collect()
    assert json.loads(row.metadata) == {"meta_id": "a", "f": "NaN", "g": ["Infinity", 1.5]}
    (scanned,) = metadata.read_parquet_metadata(spark, f"file:{tmp_path}").collect()
    assert json.loads(scanned.metadata) == json.loads(row.metadata)
