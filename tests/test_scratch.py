import pytest

from cachecurve import scratch


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.value or default


class _Session:
    def __init__(self, value, master="local[2]"):
        self.conf = _Conf(value)
        self.sparkContext = type("Context", (), {"applicationId": "trial", "master": master})()


def test_the_cluster_names_the_folder():
    assert scratch.scratch_root(_Session("s3a://shared/run/")) == "s3a://shared/run"


def test_one_local_folder_where_it_is_unset():
    first = scratch.scratch_root(_Session(None))
    assert first and scratch.scratch_root(_Session(None)) == first


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(ValueError):
        scratch.scratch_root(_Session(None, "spark://host:7077"))


def test_saved_tables_keep_schema_and_rows(spark):
    df = spark.range(10).selectExpr("id", "cast(id as string) as name")
    saved = scratch.save(df, "t")
    assert saved.schema.simpleString() == df.schema.simpleString() and saved.count() == 10
    assert all(scratch.scratch_root(spark) in f for f in saved.inputFiles())
