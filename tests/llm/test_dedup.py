"""Repeated bytes and words against brute force."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from corpuslens.llm import jaccard_join, passages, substring_dedup, suffix_dedup, textbuf

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string"


def fixture():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(60)]
    say = lambda n: " ".join(rng.choices(words, k=n))
    common = say(70)
    rows = [(i, say(rng.randint(0, 40)) + " " + common + "\n " + say(rng.randint(0, 40))) for i in range(40)]
    rows += [(40 + i, common) for i in range(10)]
    rows += [(60 + i, rows[i][1]) for i in range(5)]
    rows += [(70 + i, rows[i][1].replace("a", "b", 1)) for i in range(5)]
    rows += [(80, "ab" * 2000), (81, "x " * 500), (82, None), (83, ""), (84, " \n\t"), (85, "x " * 19)]
    rows += [(90, say(3000)), (91, say(300) * 3), (-3, say(100))]
    return rows


@pytest.fixture(scope="module")
def texts():
    return fixture()


def as_dict(frame, *columns):
    return {r[0]: tuple(r[1:]) for r in frame.select("doc_id", *columns).collect()}


@pytest.fixture(params=[4096, 8], ids=["kernel", "crowded"])
def limit(request, monkeypatch):
    monkeypatch.setattr(passages, "MAX_STRETCHES", request.param)
    original = passages.compare

    def compare(windows, kernel):
        run = original(windows, kernel)
        most = request.param

        def limited(batches):
            passages.MAX_STRETCHES = most
            return run(batches)

        return limited

    monkeypatch.setattr(passages, "compare", compare)


def digests(frame):
    from pyspark.sql import functions as F

    return frame.withColumn("kept", F.sha2("kept", 256))


def test_bytes_agree_with_brute_force(spark, texts, limit):
    docs = spark.createDataFrame(texts, SCHEMA).repartition(7)
    got = as_dict(digests(suffix_dedup.remove_repeated_bytes(docs)), "n_bytes", "n_removed", "n_spans", "kept")
    assert got == brute.op1(texts)


def test_words_agree_with_brute_force(spark, texts, limit):
    docs = spark.createDataFrame(texts, SCHEMA).repartition(7)
    got = as_dict(digests(substring_dedup.remove_repeated_words(docs)), "n_words", "n_removed", "kept")
    assert got == brute.op8(texts)


def near_copies():
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdef", k=4)) for _ in range(400)]
    rows, key = [], 0
    for n in (5, 8, 11, 30, 60, 130, 400):
        for _ in range(6):
            base = rng.choices(words, k=n)
            for _ in range(14):
                copy = list(base)
                for _ in range(rng.randint(0, max(1, n // 25))):
                    copy[rng.randrange(n)] = rng.choice(words)
                rows.append((key, " ".join(copy)))
                key += 1
    chain = rng.choices(words, k=120)  # each links with the next only
    for _ in range(40):
        chain = chain[4:] + rng.choices(words, k=4)
        rows.append((key, " ".join(chain).upper()))
        key += 1
    rows += [(key, None), (key + 1, " "), (key + 2, "a"), (key + 3, "A\n")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("least", [16, 1], ids=["rare", "frequent"])
def test_components_agree_with_brute_force(spark, monkeypatch, least):
    monkeypatch.setattr(jaccard_join, "LEAST_HEAVY", least)
    rows = near_copies()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert as_dict(jaccard_join.jaccard_components(docs), "n_shingles", "component_id") == brute.op7(rows)


def test_long_sets_agree_with_brute_force(spark):
    """Sets wider than the narrow parities, of few words, so that signatures are shared by all."""
    rng = random.Random(8)
    words = ["".join(rng.choices("abcde", k=3)) for _ in range(25)]
    rows = []
    for i in range(12):
        text = rng.choices(words, k=rng.choice([2500, 2600, 5000]))
        for k, changes in enumerate((0, 60, 95, 110, 300)):
            copy = list(text)
            for at in rng.sample(range(len(copy)), changes):
                copy[at] = "x" + str(rng.random())
            rows.append((10 * i + k, " ".join(copy)))
    docs = spark.createDataFrame(rows, SCHEMA)
    assert as_dict(jaccard_join.jaccard_components(docs), "n_shingles", "component_id") == brute.op7(rows)


def test_wide_parities_bound_the_difference():
    """No linked pair is ruled out, at equal and at different widths."""
    rng = np.random.default_rng(3)
    tokens = rng.integers(0, 2**63, 9000, dtype=np.uint64)
    sets = [tokens[:2100], tokens[100:2300], tokens[:4096], tokens[:4800], tokens[4000:8200]]
    parity = [jaccard_join.parity_of(s) for s in sets]
    parity = [jaccard_join.folded(p, max(jaccard_join.PARITY_BYTES, len(p) // 2)) for p in parity]
    narrow, width, whole = jaccard_join.parities(pa.array([p.tobytes() for p in parity], pa.binary()))
    assert len(narrow) == len(sets) and sorted(set(width.tolist())) == [256, 512]
    x, y = np.triu_indices(len(sets), 1)
    seen = 0
    for some, apart in jaccard_join.apart_by_width(x, y, width, whole):
        seen += len(some)
        for at, bits in zip(some.tolist(), apart.tolist()):
            differ = len(np.setxor1d(sets[x[at]], sets[y[at]]))
            assert bits <= differ and bits % 2 == differ % 2
    assert seen == len(x)


def test_odd_components(spark):
    assert jaccard_join.jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, "a b c d e", 1), (4, "a b c d e", 2), (4, "a b c d e", 2), (3, "A B c d e", 0), (5, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n int")
    out = sorted(map(str, jaccard_join.jaccard_components(docs).collect()))
    assert out == sorted(
        f"Row(doc_id={a}, n_shingles={b}, component_id={c})"
        for a, b, c in [(None, None, None), (4, 2, 3), (4, 2, 3), (3, 2, 3), (5, 0, 5)]
    )


def test_queries_agree_with_brute_force(spark):
    from corpuslens.llm import queries

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert as_dict(queries.op1(spark, SF), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.op1(rows)
    assert as_dict(queries.op7(spark, SF), "n_shingles", "component_id") == brute.op7(rows)
    assert as_dict(queries.op8(spark, SF), "n_words", "n_removed", "kept_sha256") == brute.op8(rows)


@pytest.mark.parametrize("remove", [suffix_dedup.remove_repeated_bytes, substring_dedup.remove_repeated_words])
def test_odd_input(spark, remove):
    assert remove(spark.createDataFrame([], SCHEMA)).count() == 0
    long = "w" + " w".join(str(i) for i in range(60))
    rows = [(None, long, 1), (1, long, 2), (1, long, 2), (2, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, doc int")
    out = remove(docs).orderBy("doc_id", "n_removed").collect()
    assert [r["doc_id"] for r in out] == [None, 1, 1, 2]
    assert out[0]["n_removed"] == 0
    assert out[1]["n_removed"] == out[2]["n_removed"]


def test_repeated_rows_are_one_document(spark, texts, limit):
    """Rows repeated within a block and across blocks lose only what stands earlier elsewhere."""
    docs = spark.createDataFrame(texts + texts, SCHEMA)
    for frame in (docs.repartition(1), docs.repartition(7)):
        out = digests(substring_dedup.remove_repeated_words(frame))
        assert out.count() == 2 * len(texts)
        assert as_dict(out.distinct(), "n_words", "n_removed", "kept") == brute.op8(texts)
        assert out.distinct().count() == len(texts)


def test_pairs_are_listed_once_and_across_blocks():
    """Rows of one signature in several blocks give the pairs that one block gives; a pair with
    many common signatures comes at the least of them."""
    rng = np.random.default_rng(8)
    tokens = [np.unique(rng.integers(0, 2**62, 100, dtype=np.uint64)) for _ in range(6)]
    sets = [np.unique(np.concatenate([tokens[i % 6][: 100 - i % 3], rng.integers(0, 2**62, i % 4, dtype=np.uint64)])) for i in range(40)]

    def rows(signature, blocks):
        out = []
        for i, s in enumerate(sets):
            parity = jaccard_join.folded(jaccard_join.parity_of(s), jaccard_join.PARITY_BYTES).tobytes()
            least = [5, 9] if i % 6 else [9]
            for other in range(blocks):
                block = i % blocks
                pair = min(block, other) * blocks + max(block, other)
                out.append((signature, pair, block, i // 2, i, len(s), float("nan"), parity, least))
        out.sort(key=lambda r: r[:2])
        types = [pa.int64()] * 6 + [pa.float64(), pa.binary(), pa.list_(pa.int64())]
        names = ["signature", "pair", "block", "component", "doc", "n", "distance", "parity", "least"]
        arrays = [pa.array(c, t) for c, t in zip(zip(*out), types)]
        batch = pa.RecordBatch.from_arrays(arrays, names=names)
        return [batch.slice(a, 7) for a in range(0, len(out), 7)]

    def listed(signature, blocks):
        found = [tuple(r.values())[:2] for b in jaccard_join.across(iter(rows(signature, blocks)), 80) for r in b.to_pylist()]
        assert len(found) == len(set(found))
        return set(found)

    one = {signature: listed(signature, 1) for signature in (5, 9, 77)}
    for blocks in (2, 3, 7):
        assert {signature: listed(signature, blocks) for signature in one} == one
    assert one[5] and one[9] and not one[77]
    assert not one[5] & one[9]
    alike = {(a, b) for a in range(40) for b in range(a + 1, 40) if a % 6 == b % 6 and a // 2 != b // 2}
    assert one[5] | one[9] == alike


def morse(n, zero="a", one="b"):
    return "".join(one if i.bit_count() % 2 else zero for i in range(n))


def test_long_words_that_fool_polynomials(spark):
    """The sequence of Thue and Morse and its complement, as words of 1,024 letters."""
    x, y = morse(1024), morse(1024, "b", "a")
    rows = [[f"w{i}" for i in range(10)] + [x] + [f"v{i}" for i in range(10)]]
    rows.append([y if w == x else w for w in rows[0]])
    docs = [(i, " ".join(words)) for i, words in enumerate(rows)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {r[0]: r["component_id"] for r in jaccard_join.jaccard_components(frame).collect()} == {0: 0, 1: 1}
    assert brute.op7(docs) == {0: (18, 0), 1: (18, 1)}
    cut = substring_dedup.remove_repeated_words(frame).collect()
    assert [r["n_removed"] for r in cut] == [0, 0]
    words = np.frombuffer((x + y).encode(), dtype=np.uint8)
    hashes = textbuf.word_hashes(words, np.array([0, 1024]), np.array([1024, 2048]), lower=False)
    assert hashes[0] != hashes[1]


def test_word_hashes_do_not_depend_on_the_place():
    text = b"Aa bb aA bb " + b"q" * 200 + b" " + b"Q" * 200 + b" a"
    data = np.frombuffer(text, dtype=np.uint8)
    start, end, _ = textbuf.word_spans(data, np.array([0, len(text)]))
    plain = textbuf.word_hashes(data, start, end, lower=False)
    lower = textbuf.word_hashes(data, start, end, lower=True)
    assert plain[1] == plain[3] and len(set(plain.tolist())) == 6
    assert lower[0] == lower[2] and lower[4] == lower[5] and len(set(lower.tolist())) == 4
