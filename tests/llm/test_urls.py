import duckdb
import pytest

from auricle.llm import urls
from auricle.llm.registry import ORACLE, QUERIES

SCHEMA = "page_id long, url string, host string, listed string, h1 string"
URLS = [
    "http://a.EXAMPLE.org/es/1", "http://example.org/en/12", "http://example.org/en/2", "x://org/", "x://org",
    "http://b.com/de/1", "http://b.com/en/1", "http://c.com/fr/", "http://c.com/de/x", "http://c.com/", "http://notcom/de/",
    "http://xcom/de/", "no scheme /de/", None, "", "://", "http://b.com?/de/", "http://b.com#/x", "http://ÄB.com/de/?q#z",
    "a://b.com/x://c.com/de/", "http://b.com/de/\n2", "http://é.net/x",
]


def run_sql(connection):
    result = connection.execute(urls.ORACLE)
    names = [d[0] for d in result.description]
    return sorted((tuple(sorted(zip(names, r))) for r in result.fetchall()), key=repr)


def run_spark(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=repr)


def test_odd_urls(spark):
    rows = [(k, u, "h", "l", "x") for k, u in enumerate(URLS + URLS[:5])] + [(None, URLS[0], "", "", "")]
    connection = duckdb.connect()
    connection.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    connection.executemany("INSERT INTO pages VALUES (?, ?)", [r[:2] for r in rows])
    assert run_spark(urls.verdicts(spark.createDataFrame(rows, SCHEMA))) == run_sql(connection)


def test_no_pages(spark):
    assert urls.verdicts(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_test_tables(spark, folder):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    assert run_spark(QUERIES["op1_urls"](spark, folder)) == run_sql(connection)
    assert ORACLE["op1_urls"] == urls.ORACLE


@pytest.mark.parametrize("per_shard, at_once", [(1 << 20, 64 << 20), (700, 1500)])
def test_cascade_is_exact_over_its_universe(spark, monkeypatch, per_shard, at_once):
    monkeypatch.setattr(urls, "KEYS_PER_SHARD", per_shard)
    monkeypatch.setattr(urls, "BYTES_AT_ONCE", at_once)
    keys = spark.range(6000).selectExpr("concat('key', id) as k", "id % 11 = 0 as listed")
    cascade = urls.build(keys, "k")
    assert len(cascade.bits) >= 2
    judged = urls._hashed(keys, "k").withColumn("got", cascade.listed())
    assert judged.where("got <> listed").count() == 0


def test_cascade_of_nothing_listed(spark):
    keys = spark.range(10).selectExpr("cast(id as string) as k", "false as listed")
    assert urls.build(keys, "k").bits == []
