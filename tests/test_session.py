from types import SimpleNamespace

import pytest
from corpuslens import session
from corpuslens.sources.readers import spread


def fake(master, conf=None, current=None):
    chosen = []
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: current or (chosen[-1] if chosen else None),
        setCheckpointDir=chosen.append,
    )
    settings = SimpleNamespace(get=lambda key, default: (conf or {}).get(key, default))
    return SimpleNamespace(sparkContext=context, conf=settings), chosen


def test_checkpoint_folder_comes_from_the_session():
    spark, chosen = fake("yarn", {"spark.checkpoint.dir": "hdfs://shared/cp"})
    session.use_checkpoint_dir(spark)
    assert chosen == ["hdfs://shared/cp"]
    assert session.scratch_path(spark, "t").startswith("hdfs://shared/cp/t-")


def test_existing_checkpoint_folder_is_kept():
    spark, chosen = fake("yarn", {"spark.checkpoint.dir": "other"}, current="hdfs://set/before")
    session.use_checkpoint_dir(spark)
    assert chosen == []


def test_temporary_folder_only_in_local_mode():
    spark, chosen = fake("local[4]")
    session.use_checkpoint_dir(spark)
    assert len(chosen) == 1
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.use_checkpoint_dir(fake("yarn")[0])


def test_materialized_table_is_read_not_computed(spark):
    df = spark.range(10).selectExpr("id", "uuid() AS u")
    table = session.materialize(df)
    assert table.schema.names == ["id", "u"]
    assert sorted(table.collect()) == sorted(table.collect())
    assert "uuid" not in table._jdf.queryExecution().optimizedPlan().toString()
    assert session.materialize(spark.range(0)).count() == 0


def test_spread_only_for_few_splits(spark, tmp_path):
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    spark.range(100).coalesce(1).write.parquet(one)
    spark.range(100).repartition(40).write.parquet(many)
    assert spread(spark.read.parquet(one)).rdd.getNumPartitions() == 4
    plan = spread(spark.read.parquet(many))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
