import pytest

import __spark_entry__ as entry
from auricle.session import ROCKSDB, STATE_STORE, rocksdb_state

HDFS = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def default_store(spark):
    spark.conf.set(STATE_STORE, HDFS)
    yield spark
    spark.conf.set(STATE_STORE, ROCKSDB)


@pytest.mark.parametrize("name", ["ST3_batch_progress", "ST5_shuffled_lease_stream"])
def test_streams_with_several_state_variables_run_in_a_plain_session(default_store, name):
    assert entry.queries()[name](default_store, FOLDER).count() > 0
    assert default_store.conf.get(STATE_STORE) == HDFS


def test_the_setting_is_put_back_after_a_failure(default_store):
    with pytest.raises(RuntimeError), rocksdb_state(default_store):
        assert default_store.conf.get(STATE_STORE) == ROCKSDB
        raise RuntimeError
    assert default_store.conf.get(STATE_STORE) == HDFS
