from types import SimpleNamespace

import pytest

from tidemark.session import SETTINGS, scratch_dir, sql_settings


def session(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_is_in_the_shared_folder_and_new_each_time():
    spark = session("spark://host:7077", "hdfs:///shared/")
    first, second = scratch_dir(spark, "a"), scratch_dir(spark, "a")
    assert first.startswith("hdfs:///shared/tidemark-a-")
    assert first != second


def test_a_cluster_must_name_the_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session("yarn"), "a")
    assert "tidemark-a-" in scratch_dir(session("local[2]"), "a")


def test_session_settings(spark):
    assert all(spark.conf.get(key) == value for key, value in SETTINGS.items())


def test_settings_are_put_back_after_an_error(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(RuntimeError):
        with sql_settings(spark, {"spark.sql.shuffle.partitions": "77", "tidemark.test": "x"}):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "77"
            raise RuntimeError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("tidemark.test", None) is None
