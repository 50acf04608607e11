from __future__ import annotations

import pytest

from orderflow.session import conf_scope, engine_session, pin_utc, require_utc, shared_dir


def test_shared_dir_follows_the_cluster(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(f"{base}/orderflow/x-") and first != second


def test_conf_scope_restores(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    unset = "spark.sql.files.maxRecordsPerFile"
    with pytest.raises(RuntimeError):
        with conf_scope(spark, {key: "3", unset: "5"}):
            assert (spark.conf.get(key), spark.conf.get(unset)) == ("3", "5")
            raise RuntimeError
    assert spark.conf.get(key) == before
    assert spark.conf.get(unset) == "0"


def test_zone(spark):
    with conf_scope(spark, {"spark.sql.session.timeZone": "Asia/Tokyo"}):
        with pytest.raises(ValueError, match="Asia/Tokyo"):
            require_utc(spark)
        require_utc(pin_utc(spark))


def test_engine_session_is_the_running_one(spark):
    assert engine_session().sparkContext is spark.sparkContext
