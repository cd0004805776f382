"""Scratch folder, its removal, and partition spreading."""

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tessella import durable, scratch_path, spread
from tessella.session import durable_by, scratch


def stub(setting, master):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting), sparkContext=context)


def test_scratch_follows_the_session_setting():
    assert scratch_path(stub("s3a://shared/folder/", "yarn")).startswith("s3a://shared/folder/tessella-")


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(stub(None, "spark://host:7077"))


def test_durable_cuts_the_plan(spark):
    df = spark.range(10).groupBy((F.col("id") % 3).alias("g")).agg(F.count("*").alias("n"))
    kept = durable(df)
    assert sorted(kept.collect()) == sorted(df.collect())
    assert "Aggregate" not in kept._jdf.queryExecution().executedPlan().toString()


def test_scratch_tables_have_an_owner(spark):
    outside = durable(spark.range(3))
    with scratch(spark):
        inside = durable(spark.range(5))
        path = inside.inputFiles()[0].removeprefix("file://")
        assert inside.count() == 5 and os.path.exists(path)
    assert not os.path.exists(path)
    assert outside.count() == 3


def test_a_dealt_table_is_grouped_without_exchange(spark):
    dealt = durable_by(spark.range(100).select("id", (F.col("id") % 3).alias("g")), "id")
    counted = dealt.groupBy("id", "g").agg(F.count("*").alias("n"))
    assert counted.count() == 100
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()


def test_spread_leaves_a_large_scan_alone(spark, tmp_path):
    few, many = str(tmp_path / "few"), str(tmp_path / "many")
    spark.range(100).coalesce(1).write.parquet(few)
    spark.range(100).repartition(64).write.parquet(many)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert spread(spark.read.parquet(few)).rdd.getNumPartitions() == 16
        large = spread(spark.read.parquet(many))
        assert "Exchange" not in large._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
