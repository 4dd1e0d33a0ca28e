import pytest
from pyspark.sql import functions as F
from corpuslens.operators import languages

# Sizes in MB of each file. By size: big, tie_a = tie_b, many, .csv, csv.
FILES = {
    "big": [50.0],
    "tie_a": [15.0, 15.0],
    "tie_b": [30.0],
    "many": [2.0] * 10,
    ".csv": [9.0],
    "csv": [1.0],
}


@pytest.fixture(scope="module")
def files(spark):
    rows = [
        (f"/c/{lang}/{n}.parquet", lang, int(mb * 2**20))
        for lang, sizes in FILES.items()
        for n, mb in enumerate(sizes)
    ]
    return spark.createDataFrame(rows, "pq_path string, lang string, length bigint").repartition(3)


@pytest.fixture(scope="module")
def meta(files):
    return languages.with_language_totals(files)


def langs(df):
    return {r["lang"] for r in df.select("lang").distinct().collect()}


def test_totals(files, meta):
    got = {r["lang"]: (r["lang_size_mb"], r["lang_file_cnt"]) for r in meta.collect()}
    assert got == {lang: (sum(s), len(s)) for lang, s in FILES.items()}
    assert meta.count() == files.count()


def test_first_file(files):
    got = {r["lang"]: r["pq_path"] for r in languages.first_file(files).collect()}
    assert got == {lang: f"/c/{lang}/0.parquet" for lang in FILES}


@pytest.mark.parametrize("k", range(1, 8))
def test_top_k_by_size(meta, k):
    order = sorted(FILES, key=lambda lang: (-sum(FILES[lang]), lang))
    assert [r["lang"] for r in languages.top_languages(meta, k).collect()] == order[:k]


@pytest.mark.parametrize("k", range(1, 8))
def test_top_k_by_size_and_files(meta, k):
    order = sorted(FILES, key=lambda lang: (-sum(FILES[lang]) * len(FILES[lang]), lang))
    assert order[0] == "many"
    got = languages.top_languages(meta, k, rank_by="size_x_files").collect()
    assert [r["lang"] for r in got] == order[:k]


def test_selectors(meta):
    choose = languages.select_languages
    everything = set(FILES) - {".csv"}
    assert langs(choose(meta)) == everything
    assert langs(choose(meta, bad_langs=())) == set(FILES)
    assert langs(choose(meta, top_k=2)) == {"big", "tie_a"}
    assert langs(choose(meta, top_k=2, rank_by="size_x_files")) == {"many", "tie_a"}
    assert langs(choose(meta, mb_size_thresh=20)) == {"big", "tie_a", "tie_b"}  # strict
    assert langs(choose(meta, pq_file_cnt_thresh=2)) == {"tie_a", "many"}  # inclusive
    assert langs(choose(meta, top_k=1, mb_size_thresh=1e9, pq_file_cnt_thresh=99)) == {"big"}
    assert langs(choose(meta, top_k=0, mb_size_thresh=40, pq_file_cnt_thresh=99)) == {"big"}
    assert langs(choose(meta, mb_size_thresh=0, pq_file_cnt_thresh=2)) == {"tie_a", "many"}
    # excluded last: the place of a top language is not filled again
    assert langs(choose(meta, top_k=2, bad_langs=("big",))) == {"tie_a"}
    with pytest.raises(ValueError):
        languages.top_languages(meta, 1, rank_by="name")


def test_missing_language_is_not_excluded(spark):
    rows = spark.createDataFrame([(None,), ("x",), (".csv",)], "lang string")
    assert {r[0] for r in languages.select_languages(rows).collect()} == {None, "x"}


def test_restrict_corpus(spark, meta):
    corpus = spark.createDataFrame([("big", 1), ("csv", 2), ("other", 3), ("many", 4), (None, 5)], "lang string, n int")
    chosen = languages.select_languages(meta, mb_size_thresh=19.0)
    got = languages.restrict_to_languages(corpus, chosen)
    assert {r["n"] for r in got.collect()} == {1, 4}
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
    assert languages.restrict_to_languages(corpus, chosen.filter("lang = 'none'")).count() == 0


@pytest.mark.parametrize("wanted", [3, 1001])
def test_partitions_are_pruned_by_the_chosen_languages(spark, tmp_path, wanted):
    """At any number of languages, only the files of those chosen are opened."""
    corpus = spark.range(1010).select(F.concat(F.lit("l"), "id").alias("lang"), "id")
    corpus.repartition(4, "lang").write.partitionBy("lang").parquet(str(tmp_path / "c"))
    chosen = spark.range(wanted).select(F.concat(F.lit("l"), "id").alias("lang"))
    got = languages.restrict_to_languages(spark.read.parquet(str(tmp_path / "c")), chosen)
    plan = got._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString()
    assert sorted(r["id"] for r in got.collect()) == list(range(wanted))

    def scans(node):
        found = [node] if "FileSourceScanExec" in node.getClass().getName() else []
        inner = node.executedPlan() if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else None
        inner = node.plan() if "QueryStageExec" in node.getClass().getSimpleName() else inner
        below = [inner] if inner is not None else [node.children().apply(i) for i in range(node.children().size())]
        return found + [x for child in below for x in scans(child)]

    read = [s.metrics().get("numPartitions").get().value() for s in scans(plan) if s.metrics().contains("numPartitions")]
    assert read == [wanted]


def test_without(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4)], "k string, n int")
    blocked = spark.createDataFrame([("b",), ("b",), ("z",)], "k string")
    assert {r["n"] for r in languages.without(rows, blocked, "k").collect()} == {1, 4}


def test_no_broadcast_hint_on_growing_data(meta):
    plan = meta._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in plan


def test_top_k_side_is_bounded(meta):
    plan = languages.select_languages(meta, top_k=3)._jdf.queryExecution().optimizedPlan().toString()
    assert "GlobalLimit 3" in plan
