"""Every stage of the pipeline against brute force on its own input."""

import random

import brute
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpuslens.llm import queries
from corpuslens.session import BATCH_BYTES, materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    out = [rows]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SF)))
    return out


def texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.select("doc_id", "text").collect()}


def test_columns_stay(tables):
    for frame in tables[1:5]:
        assert frame.dtypes == tables[0].dtypes


def test_only_toxic_documents_go(spark, tables):
    scored = queries.op10(spark, SF)
    kept = {r[0] for r in scored.filter("predicted = 0").select("doc_id").collect()}
    assert set(texts(tables[1])) == kept


def test_passages_are_cut(tables):
    before, after = texts(tables[2]), texts(tables[3])
    cut = brute.op8(before.items())
    assert set(before) == set(after)
    for k, (_, gone, digest) in cut.items():
        assert after[k] == before[k] if gone == 0 else brute.sha(after[k]) == digest
    assert tables[3].filter(F.col("n_chars") != F.length("text")).count() == 0


def test_contaminated_documents_go(spark, tables):
    from corpuslens.llm.decontamination import decontaminate

    found = decontaminate(tables[3], spark.read.parquet(f"{SF}/benchmark.parquet"))
    clean = {r[0] for r in found.filter("not contaminated").select("doc_id").collect()}
    assert set(texts(tables[4])) == clean


def test_all_tokens_are_packed(tables):
    docs = tables[5].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    assert docs.filter("n <> all").count() == 0
    assert {r[0] for r in docs.select("doc_id").collect()} == set(texts(tables[4]))


def test_run(spark, tables):
    assert corpus_pipeline.run(spark, SF).count() == tables[5].count()


def test_a_repeated_row_survives_once(spark):
    """One of the rows with one doc_id stays, with its text; rows without one all stay."""
    say = lambda mark: " ".join(f"{mark}{i}" for i in range(30))
    rows = [(1, say("a")), (2, say("b")), (2, say("b")), (3, say("a")), (3, say("a")), (None, say("c")), (None, say("c"))]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert kept.dtypes == docs.dtypes
    want = [(1, say("a")), (2, say("b")), (None, say("c")), (None, say("c"))]
    by = lambda row: str(row)
    assert sorted(map(tuple, kept.select("doc_id", "text").collect()), key=by) == sorted(want, key=by)
    cut = corpus_pipeline.cut_repeated_passages(spark, docs.filter("doc_id = 2 or doc_id is null"), SF)
    assert {r["text"] for r in cut.collect()} == {say("b"), say("c")}


def test_near_duplicates_share_five_words_and_four_fifths(spark):
    """Copies with more text and with spread edits, on both sides of 0.8."""
    rng = random.Random(3)
    say = lambda n: ["".join(rng.choices("abcdefgh", k=6)) for _ in range(n)]
    rows = []
    for i in range(8):
        base = say(200)
        edited = list(base)
        for at in range(10, 10 + 20 * (i // 2 + 2), 20):
            edited[at] = say(1)[0]
        rows += [(10 * i, base), (10 * i + 1, base + say(24 + 5 * i)), (10 * i + 2, edited)]
    rows = [(k, " ".join(words)) for k, words in rows]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    want = {g for _, g in brute.op7(rows, percent=80, words=5).values()}
    assert len(want) not in (8, 24) and want != {g for _, g in brute.op7(rows).values()}
    assert set(texts(corpus_pipeline.drop_near_duplicates(spark, docs, SF))) == want


def test_stage_agrees_with_brute_force_on_the_documents(tables):
    groups = brute.op7(texts(tables[1]).items(), percent=80, words=5)
    assert set(texts(tables[2])) == {g for _, g in groups.values()}


ODD_COLUMNS = {
    "predicted": "int", "score": "double", "_text": "string", "_kept": "string", "a.b": "string", "row": "int",
    "m": "map<string,int>", "n_removed": "int", "doc": "bigint", "first": "int", "c0": "string", "contaminated": "int",
    "tick`": "string", "carried": "int", "kept": "string",
}


def odd_rows(rng):
    say = lambda mark, n: " ".join(f"{mark}{i}" for i in range(n))
    shared = say("s", 60)
    texts = [(1, say("a", 30)), (2, say("b", 30) + " " + shared), (3, shared + " " + say("c", 300)), (4, say("a", 30)),
             (5, None), (6, ""), (7, " \n"), (8, "word"), (9, say("long", 40_000)), (None, say("n", 30)), (None, None),
             (2, say("b", 30) + " " + shared)]
    more = {"int": 3, "double": 0.5, "string": "x", "bigint": 7, "map<string,int>": {"k": 1}}
    return [(k, t, "en", "s", len(t or ""), *(more[v] if rng.random() < 0.8 else None for v in ODD_COLUMNS.values()))
            for k, t in texts]


@pytest.mark.parametrize("number", range(5))
def test_stages_survive_odd_rows_and_columns(spark, number):
    """Nulls, empty and long texts, repeated rows, columns of any name and type; no rows at all."""
    extra = ", ".join(f"`{k.replace('`', '``')}` {v}" for k, v in ODD_COLUMNS.items())
    schema = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}"
    docs = materialize(spark.createDataFrame(odd_rows(random.Random(number)), schema))
    name, stage = corpus_pipeline.STAGES[number]
    out = materialize(stage(spark, docs, SF))
    assert stage(spark, docs.limit(0), SF).collect() == []
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    if name == "packing":
        assert set(ids) == {None, *range(1, 10)}
        return
    assert out.dtypes == docs.dtypes
    got = {k: t for k, t in out.select("doc_id", "text").collect() if k is not None}
    want = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect() if r["doc_id"] is not None}
    assert ids.count(None) == 2
    if name == "near_duplicates":
        assert sorted(k for k in ids if k) == [1, 2, 3, 5, 6, 7, 8, 9]
        assert all(got[k] == want[k] for k in got)
    elif name == "repeated_passages":
        assert got[4] == "" and got[3] == " ".join(f"c{i}" for i in range(300))
        assert all(got[k] == want[k] for k in got if k not in (3, 4))
        assert out.filter("doc_id in (3, 4) and n_chars <> length(text)").count() == 0
    else:
        assert all(got[k] == want[k] for k in got) and set(got) == set(want)


def test_texts_go_to_workers_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    before = spark.conf.get(BATCH_BYTES)
    word = F.concat(F.lit("w"), F.col("id").cast("string"), F.lit(" "))
    docs = spark.range(0, 1500, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(word, 3000).alias("text"))
    try:
        for name, stage in corpus_pipeline.STAGES[:4]:
            spark.conf.set(BATCH_BYTES, "64m")
            stage(spark, docs.limit(0), SF)
            found = docs.mapInArrow(sizes, "n bigint").collect()
            assert len(found) > 1 and max(r[0] for r in found) < 5_000_000, name
    finally:
        spark.conf.set(BATCH_BYTES, before)


def test_run_puts_the_limit_of_batches_back(spark, monkeypatch):
    before, seen = spark.conf.get(BATCH_BYTES), []

    def stage(spark, docs, sf_dir):
        seen.append(spark.conf.get(BATCH_BYTES))
        if len(seen) > 1:
            raise ValueError("stop")
        return docs

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", corpus_pipeline.bounded(stage))])
    rows = corpus_pipeline.run(spark, SF)
    assert seen == ["4m"] and spark.conf.get(BATCH_BYTES) == before
    assert rows.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    with pytest.raises(ValueError, match="stop"):
        corpus_pipeline.run(spark, SF)
    assert spark.conf.get(BATCH_BYTES) == before
