import pytest

from heartwood import session


def test_sizes_follow_the_input():
    small = session.settings_for(10 * session.GIB)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert session.settings_for(5 * session.TIB)["spark.sql.shuffle.partitions"] == "1024"
    large = session.settings_for(100 * session.TIB, split_bytes=512 * session.MIB)
    assert large == {
        "spark.sql.shuffle.partitions": "20480",
        "spark.sql.files.maxPartitionBytes": str(512 * session.MIB),
    }


def test_lineage_is_cut_in_the_configured_folder(spark, tmp_path):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.conf.unset("spark.checkpoint.dir")
        with pytest.raises(RuntimeError):
            session.cut_lineage(spark.range(1))
        spark.conf.set("spark.checkpoint.dir", str(tmp_path))
    stored = session.cut_lineage(spark.range(10).selectExpr("id * 2 AS twice"))
    assert sorted(r.twice for r in stored.collect()) == list(range(0, 20, 2))
    assert "Range" not in stored._jdf.queryExecution().optimizedPlan().toString()
