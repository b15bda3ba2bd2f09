"""The lines of orders are dealt to as many tasks as their files' size asks for."""

import tempfile

from cartwheel.sources import testdata


def test_lines_are_dealt_by_the_size_of_their_files(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="cartwheel-dealt-")
    spark.range(5000).selectExpr("id % 700 as l_orderkey", "xxhash64(id) as l_partkey").coalesce(2).write.parquet(f"{root}/lineitem.parquet")
    monkeypatch.setattr(testdata, "TASK_BYTES", 1000)
    dealt = testdata.by_key(spark, root, "lineitem", "l_orderkey")
    assert dealt.rdd.getNumPartitions() > max(30, int(spark.conf.get("spark.sql.shuffle.partitions")))
    assert dealt.count() == 5000 and dealt.selectExpr("l_orderkey", "spark_partition_id() p").distinct().count() == 700
    monkeypatch.setattr(testdata, "TASK_BYTES", 1 << 30)
    assert testdata.by_key(spark, root, "lineitem", "l_orderkey").count() == 5000
