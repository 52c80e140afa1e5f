import zlib
from pathlib import Path

import numpy as np
import pyarrow.orc as orc
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from auricle.llm import token_files
from auricle.llm.registry import tokenizer_path
from auricle.session import run_dir
from tests.llm.conftest import ODD

PATH = tokenizer_path("word_bpe_49k.json")


def local(path):
    return path.removeprefix("file:")


@pytest.fixture(scope="module")
def encode():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("per_file", [3, 1000])
def test_round_trip_of_odd_rows(spark, odd, encode, per_file):
    path = run_dir(spark, "tokens")
    token_files.write_tokens(odd, path, PATH, docs_per_file=per_file)
    rows = token_files.checksums(token_files.read_tokens(spark, path)).collect()
    rows.sort(key=lambda r: r["start"])
    keys = [r["doc_id"] for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    want = []
    for key, text, _ in ODD:
        ids = encode(text)
        want.append((key, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
    got = [(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    held = {r["doc_id"]: r["ids"] for r in token_files.read_tokens(spark, path).collect()}
    assert held[9] == encode("Élan ßtraße 日本語 \U0001f600 ok")


def test_one_id_for_many_rows_is_split_over_files(spark, docs, encode):
    rows = [(7, f"text number {k}", None) for k in range(400)] + [(k, "x", None) for k in range(20)]
    path = run_dir(spark, "tokens")
    token_files.write_tokens(docs(rows), path, PATH, docs_per_file=50)
    found = token_files.read_tokens(spark, path)
    assert found.count() == 420
    files = spark.read.orc(path).where("doc_id = 7").select("file").distinct().count()
    assert files >= 4
    starts = sorted((r["start"], r["n_tokens"]) for r in found.collect())
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_stripes_indexes_and_filters(spark, docs, monkeypatch):
    monkeypatch.setattr(token_files, "STRIPE_BYTES", 1 << 16)
    rows = [(3 * k, f"a text with the number {k * 7919} in it " * 6, None) for k in range(12000)]
    path = run_dir(spark, "tokens")
    token_files.write_tokens(docs(rows), path, PATH, docs_per_file=12000)
    files = sorted(Path(local(path)).glob("*.orc"))
    opened = [orc.ORCFile(f) for f in files]
    assert all(f.row_index_stride == token_files.ROW_GROUP for f in opened)
    assert max(f.nstripes for f in opened) > 1
    assert all(f.compression == "ZSTD" for f in opened)
    jvm = spark._jvm
    options = jvm.org.apache.orc.OrcFile.readerOptions(spark._jsc.hadoopConfiguration())
    reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(str(files[0])), options)
    footer = reader.rows().readStripeFooter(reader.getStripes().get(0))
    kinds = {(s.getColumn(), s.getKind().toString()) for s in footer.getStreamsList()}
    assert (1, "BLOOM_FILTER_UTF8") in kinds and (1, "ROW_INDEX") in kinds
    assert {footer.getColumns(k).getKind().toString() for k in (1, 6)} == {"DIRECT_V2"}
    one = token_files.read_tokens(spark, path, F.col("doc_id") == 3 * 4567)
    assert "EqualTo(doc_id,13701)" in one._jdf.queryExecution().toString()
    (row,) = one.collect()
    whole = {r["doc_id"]: r["start"] for r in token_files.read_tokens(spark, path).collect()}
    assert row["start"] == whole[13701]
    assert token_files.read_tokens(spark, path, F.col("doc_id") == 13702).collect() == []


def test_empty_table(spark, empty):
    path = run_dir(spark, "tokens")
    token_files.write_tokens(empty, path, PATH)
    assert token_files.checksums(token_files.read_tokens(spark, path)).collect() == []
