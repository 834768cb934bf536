import pytest

import tidemark.session as session
from tidemark.session import estimated_bytes, join_on, small_or_not, stage


def joined(spark, how="left"):
    left = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "k string, l int")
    right = stage(spark.createDataFrame([("a", 10), (None, 20)], "k string, r int"))
    return join_on(left, small_or_not(right), ["k"], how)


def test_null_keys_pair_and_one_copy_of_the_key_stays(spark):
    assert sorted(map(tuple, joined(spark).select("l", "r").collect())) == [(1, 10), (2, 20), (3, None)]
    assert joined(spark).columns == ["k", "l", "r"]
    assert [r.l for r in joined(spark, "left_anti").collect()] == [3]


@pytest.mark.parametrize("limit, broadcast", [(1 << 20, True), (1, False)])
def test_broadcast_follows_the_size(spark, monkeypatch, limit, broadcast):
    monkeypatch.setattr(session, "BROADCAST_BYTES", limit)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joined(spark)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("BroadcastHashJoin" in plan) == broadcast


def test_staged_size_is_known(spark):
    assert 0 < estimated_bytes(stage(spark.range(1000))) < 100_000


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(Session)
    Session.conf = {"spark.checkpoint.dir": "s3a://shared/"}
    assert session.scratch_root(Session) == "s3a://shared"
