"""Duplicates by bitmaps of places, without shuffling texts."""

import random

import pytest
from pyspark.sql import functions as F

from corpuslens.operators import dedup

TEXTS = ["same", "sa me", " same\n", "other", "", " ", None]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Files of different sizes, one of more than a bucket of rows, most rows duplicates."""
    path = str(tmp_path_factory.mktemp("dedup") / "table")
    rng = random.Random(1)
    rows = [(i, rng.choice(TEXTS) if rng.random() < 0.9 else f"text {i // 3}", "x") for i in range(3000)]
    spark.createDataFrame(rows, "id bigint, text string, _bits string").repartition(7).write.parquet(path)
    more = spark.range(0, 70_000, 1, 1).select(
        (F.col("id") + 10_000).alias("id"), F.concat(F.lit("n"), F.col("id") % 40_000).alias("text"), F.lit("y").alias("_bits")
    )
    more.write.mode("append").parquet(path)
    return spark.read.parquet(path)


def expected(table, order):
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    first = {}
    for r in table.select("id", "text", *place).collect():
        key = None if r["text"] is None else "".join(r["text"].split())
        rank = (r["id"],) if order else (r["file"], r["row"])
        first[key] = min(first.get(key, (rank, r["id"])), (rank, r["id"]))
    return sorted(k for _, k in first.values())


@pytest.mark.parametrize("order", [None, "id"])
@pytest.mark.parametrize("broadcast_bytes", [1 << 26, 6000])
def test_first_of_each_text_stays(table, order, broadcast_bytes):
    kept = dedup.drop_duplicate_rows_in_files(table, order_by=order, broadcast_bytes=broadcast_bytes)
    assert kept.columns == table.columns
    assert sorted(r["id"] for r in kept.select("id").collect()) == expected(table, order)


def test_no_text_is_shuffled(table):
    kept = dedup.drop_duplicate_rows_in_files(table)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan and "Exchange hashpartitioning" not in plan and "Sort" not in plan
    assert "SinglePartition" not in plan


def test_every_file_is_read_by_one_scan(table):
    """With several scans the condition on the path leaves each file to one of them."""
    bitmaps = dedup.position_bitmaps(dedup.first_positions(table)).cache()
    kept = dedup.at_positions(table, bitmaps, broadcast_bytes=6000)
    files = len(table.inputFiles())
    kept.collect()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    scans = plan.count("BroadcastHashJoin") // (2 if "== Final Plan ==" in plan else 1)
    assert scans > 1
    each = [
        table.filter(F.pmod(F.xxhash64("_metadata.file_path"), F.lit(scans)) == i).select(F.input_file_name()).distinct()
        for i in range(scans)
    ]
    assert sum(x.count() for x in each) == files
    bitmaps.unpersist()


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "id bigint, text string").write.parquet(str(tmp_path / "none"))
    none = spark.read.parquet(str(tmp_path / "none"))
    assert dedup.drop_duplicate_rows_in_files(none).collect() == []


def test_bitmaps_are_cut(table):
    maps = dedup.position_bitmaps(dedup.first_positions(table))
    assert maps.filter(F.octet_length("bits") > 4096).count() == 0
    assert maps.filter(F.octet_length("bits") < 4096).count() > 0
