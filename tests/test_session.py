from types import SimpleNamespace

import pytest

from anagrove import session


def stub(master, configured=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: configured or default),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_configured_folder_wins():
    assert session.shared_dir(stub("yarn", "hdfs:///shared/")) == "hdfs:///shared"


def test_only_local_masters_fall_back():
    with pytest.raises(ValueError, match="shared by the cluster"):
        session.shared_dir(stub("yarn"))
    assert session.shared_dir(stub("local[2]")) == session.shared_dir(stub("local[2]"))


def test_stages_are_read_by_column(spark):
    staged = session.materialise(spark.range(10).selectExpr("id", "id * 2 AS twice"))
    assert staged.count() == 10
    plan = staged.filter("twice > 4").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(twice), GreaterThan(twice,4)]" in plan


def test_stages_go_at_the_end(spark):
    import os

    from anagrove.session import materialise, scratch_path, stages

    with stages(spark):
        df = materialise(spark.range(5))
        kept = df.inputFiles()[0].removeprefix("file://")
        assert df.count() == 5 and os.path.exists(kept)
    assert not os.path.exists(kept)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
