import hashlib

import pytest
from corpuslens.operators import positions, reports
from pyspark.sql import functions as F


def indexed(df, *columns):
    rows = positions.with_row_index(df, list(columns)).orderBy("row_index").collect()
    assert [r["row_index"] for r in rows] == list(range(len(rows)))
    assert {r["_total"] for r in rows} <= {len(rows)}
    return rows


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_row_index_is_the_sorted_position(spark, parts):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(parts)
    rows = positions.with_row_index(df, ["k"], partitions=parts).collect()
    assert all(r["k"] == r["row_index"] for r in rows) and len(rows) == 1000


def test_row_index_with_a_hot_value(spark):
    values = ["hot"] * 500 + [f"v{n:04}" for n in range(500)] + [None]
    rows = indexed(spark.createDataFrame([(v,) for v in values], "v string"), "v")
    assert [r["v"] for r in rows] == [None, *sorted(values[:-1])]


def test_hot_value_is_spread_over_partitions(spark):
    df = spark.createDataFrame([("hot",)] * 4000, "v string").repartition(4)
    placed = positions.with_row_index(df, ["v"], partitions=4)
    per_task = [len(part) for part in placed.rdd.glom().collect()]
    assert max(per_task) < 2000


def test_row_index_of_nothing(spark):
    assert indexed(spark.createDataFrame([], "v string"), "v") == []


def test_file_row_index(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).repartitionByRange(5, "id").sortWithinPartitions("id").write.parquet(path)
    rows = positions.with_file_row_index(spark.read.parquet(path)).collect()
    assert len(rows) == 1000
    # part files are named in range order
    assert all(r["id"] == r["row_index"] for r in rows)


def test_segments(spark):
    repos = spark.createDataFrame([(f"o/r{n}",) for n in range(10)], "repo_name string")
    parts = [
        [r[0] for r in positions.select_repos(repos, 0.25, s).collect()] for s in (1, 2, 3, 4)
    ]
    assert [sorted(p) for p in parts] == [[f"o/r{n}", f"o/r{n + 1}"] for n in (0, 2, 4, 6)]
    whole = positions.with_row_index(repos, ["repo_name"])
    last = positions.take_segment(whole, 0.25, 4, cover_remainder=True)
    assert sorted(r["repo_name"] for r in last.collect()) == [f"o/r{n}" for n in (6, 7, 8, 9)]
    assert positions.select_repos(repos, 1.0, 3).count() == 10
    assert positions.select_repos(repos, 0.25, 5).count() == 2
    assert positions.select_repos(repos, 0.25, 6).count() == 0


def test_chunks(spark):
    numbered = positions.with_row_index(spark.range(23), ["id"])
    sizes = positions.with_chunks(numbered, 5).groupBy("chunk_id").count().orderBy("chunk_id")
    assert [tuple(r) for r in sizes.collect()] == [(0, 5), (1, 5), (2, 5), (3, 5), (4, 3)]
    with pytest.raises(ValueError):
        positions.with_chunks(numbered, 0)


@pytest.mark.parametrize("n,frac", [(1000, 0.1), (1000, 0.0), (1000, 1.0), (7, 0.5), (5, 0.5), (1, 0.3), (0, 0.5)])
def test_exact_sample_size(spark, n, frac):
    df = spark.range(n)
    got = [r[0] for r in positions.sample_exact(df, frac, "id").collect()]
    assert len(got) == len(set(got)) == round(frac * n)


@pytest.mark.parametrize("digits", [1, 4])
def test_exact_sample_takes_the_smallest_digests(spark, monkeypatch, digits):
    # with one digit to a histogram the border is found in several passes
    monkeypatch.setattr(positions, "_BUCKET_DIGITS", digits)
    got = {r[0] for r in positions.sample_exact(spark.range(3000), 0.37, "id", 5).collect()}
    ranked = sorted(range(3000), key=lambda n: hashlib.md5(f"5|{n}".encode()).hexdigest())
    assert got == set(ranked[:1110])


def test_exact_sample_shuffles_no_rows(spark):
    rows = spark.range(3000).withColumn("text", F.lit("x"))
    plan = positions.sample_exact(rows, 0.37, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_exact_sample_is_reproducible(spark):
    def sample(seed, parts):
        rows = positions.sample_exact(spark.range(500).repartition(parts), 0.2, "id", seed)
        return sorted(r[0] for r in rows.collect())

    assert sample(1, 1) == sample(1, 9) != sample(2, 1)


def test_sample_fractions_are_checked(spark):
    for frac in (-0.1, 1.5):
        with pytest.raises(ValueError):
            positions.sample_exact(spark.range(10), frac, "id")


def test_segments_do_not_overlap(spark):
    indexed = positions.with_row_index(spark.range(200).repartition(3), ["id"])
    for n in (3, 7, 93):
        for frac in (1 / n, round(1 / n, 3)):
            numbers = range(1, round(1 / frac) + 3)
            parts = [positions.take_segment(indexed, frac, k, cover_remainder=True) for k in numbers]
            rows = [r[0] for part in parts for r in part.select("id").collect()] if n < 93 else None
            assert rows is None or sorted(rows) == list(range(200))
    bounds = positions.segment_bounds(F.col("_total"), 1 / 93, 93, True)
    last = indexed.filter(bounds).count()
    assert last == 200 - 92 * int(200 / 93)
    assert indexed.filter(positions.segment_bounds(F.col("_total"), 1 / 93, 94, True)).count() == 0


def test_file_rows_keep_their_numbers_when_filtered(spark, tmp_path):
    spark.range(1000).repartition(4).write.parquet(str(tmp_path / "t[1]"))
    whole = spark.read.parquet(str(tmp_path / "t\\[1\\]"))
    all_rows = {r["id"]: r["row_index"] for r in positions.with_file_row_index(whole).collect()}
    part = positions.with_file_row_index(whole.filter("id % 2 = 0")).collect()
    assert sorted(all_rows.values()) == list(range(1000))
    assert {r["id"]: r["row_index"] for r in part} == {k: v for k, v in all_rows.items() if k % 2 == 0}


def test_running_mean_keeps_rows_without_order(spark):
    rows = spark.createDataFrame([(1, 2.0), (None, 50.0), (10**15, 4.0)], "chunk_id bigint, success_rate double")
    got = {r["chunk_id"]: r["running_rate"] for r in reports.running_mean(rows).collect()}
    assert got == {1: 2.0, None: None, 10**15: 3.0}


def test_exact_sample_with_a_hot_key(spark):
    df = spark.createDataFrame([("hot", n) for n in range(600)] + [(f"k{n}", n) for n in range(600)], "k string, n int")
    got = positions.sample_exact(df, 0.25, "k")
    assert got.count() == 300 and got.columns == ["k", "n"]
    # 600 equal keys fall into one bucket; a quarter, half and three quarters cut it or not
    for frac in (0.5, 0.75, 0.99):
        assert positions.sample_exact(df, frac, "k").distinct().count() == round(1200 * frac)


def test_select_repos_samples_without_segment(spark):
    repos = spark.createDataFrame([(f"o/r{n}",) for n in range(10)], "repo_name string")
    assert positions.select_repos(repos, 0.3, None).count() == 3


@pytest.mark.parametrize("blocks", [4096, 3])
def test_running_mean(spark, monkeypatch, blocks):
    monkeypatch.setattr(reports, "_BLOCKS", blocks)
    values = [(n + 5, float(n * n % 17)) for n in range(100)]
    rates = spark.createDataFrame(values, "chunk_id bigint, success_rate double").repartition(5)
    got = {r["chunk_id"]: r["running_rate"] for r in reports.running_mean(rates).collect()}
    total = 0.0
    for count, (chunk, value) in enumerate(values, start=1):
        total += value
        assert got[chunk] == pytest.approx(total / count, rel=1e-12)


def test_running_mean_of_nothing(spark):
    assert reports.running_mean(spark.createDataFrame([], "chunk_id bigint, success_rate double")).count() == 0


def test_chunk_success(spark):
    rows = spark.createDataFrame(
        [(0, False, 2), (0, True, 0), (0, None, 0), (1, False, 0)],
        "chunk_id bigint, failed boolean, n_files bigint",
    )
    rate = reports.chunk_success(rows, reports.repo_success(rows))
    assert {tuple(r) for r in rate.collect()} == {(0, 2 / 3 * 100), (1, 100.0)}
    strict = reports.chunk_success(rows, reports.repo_success(rows, count_empty_as_success=False))
    assert {tuple(r) for r in strict.collect()} == {(0, 1 / 3 * 100), (1, 0.0)}


@pytest.fixture
def small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "700")
    yield
    spark.conf.set(key, before)


def test_lines_are_numbered_in_file_order(spark, tmp_path, small_splits):
    """Lists of many splits, which are no multiples of lines, and of one line."""
    names = []
    for part, n in [("a", 500), ("b-1", 1), ("b", 0), ("c", 300)]:
        own = [f"{(i * 7919) % 1000:03}/{part}é{'x' * (i % 9)}" for i in range(n)]
        (tmp_path / f"{part}.csv").write_text("".join(f"{x}\n" for x in ["repo_name", *own]))
        names += [(part, x) for x in own]
    names = [x for _, x in sorted(names, key=lambda r: f"{r[0]}.csv")]
    from corpuslens.sources.readers import read_repo_list

    repos = read_repo_list(spark, str(tmp_path))
    assert repos.rdd.getNumPartitions() > 10
    rows = positions.with_line_index(repos).collect()
    assert sorted((r["row_index"], r["repo_name"]) for r in rows) == list(enumerate(names))
    assert {r["_total"] for r in rows} == {801}
    part = positions.select_listed_repos(repos, 0.4, 2)
    assert sorted(r[0] for r in part.collect()) == sorted(names[320:640])
    filtered = positions.with_line_index(repos.filter("repo_name like '%a%'")).collect()
    assert sorted(r["row_index"] for r in filtered) == list(range(500))


def test_segment_of_a_list_that_is_not_sorted(spark, tmp_path):
    (tmp_path / "list.csv").write_text("repo_name\nz/1\na/2\nm/3\nb/4\n")
    from corpuslens.sources.readers import read_repo_list

    repos = read_repo_list(spark, str(tmp_path / "list.csv"))
    segments = [{r[0] for r in positions.select_listed_repos(repos, 0.5, s).collect()} for s in (1, 2, 3)]
    assert segments == [{"z/1", "a/2"}, {"m/3", "b/4"}, set()]
    assert positions.select_listed_repos(repos, 1.0, 2).count() == 4
    assert positions.select_listed_repos(repos, 0.5, None).count() == 2
    assert positions.with_line_index(repos.filter("repo_name = ''")).collect() == []


def test_files_are_summed_up_by_folder(spark, tmp_path):
    """No window takes all files into one task."""
    for folder in ("a", "a-b", "c"):
        spark.range(40).repartition(3).write.parquet(str(tmp_path / folder))
    df = spark.read.parquet(str(tmp_path / "*"))
    indexed = positions.with_file_row_index(df)
    assert sorted(r["row_index"] for r in indexed.collect()) == list(range(120))
    assert {r["_total"] for r in indexed.collect()} == {120}
    counts = spark.createDataFrame([("x", f"x/{i}", 2) for i in range(5)] + [("y", "y/1", 3)], "g string, m string, n bigint")
    plan = positions._starts(counts, "g", "m")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1 and "hashpartitioning(g" in plan
    got = {r["m"]: (r["_before"], r["_total"]) for r in positions._starts(counts, "g", "m").collect()}
    assert got == {**{f"x/{i}": (2 * i, 13) for i in range(5)}, "y/1": (10, 13)}
