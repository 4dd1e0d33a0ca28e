"""Lines that many documents share, against plain Python."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from corpuslens.llm import line_dedup

SCHEMA = "doc_id bigint, text string, pos int, version string, keep string, n_lines int"
SPACE = " \t\n\v\f\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, min_docs=10, min_chars=1):
    have = {}
    for k, t in rows:
        for line in (t or "").split("\n"):
            have.setdefault(key_of(line), set()).add(k)
    out = []
    for k, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key_of(x)) < min_chars or len(have[key_of(x)]) < min_docs]
        out.append((k, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def run(spark, rows, **how):
    docs = spark.createDataFrame([(k, t, 1, "x", "y", 3) for k, t in rows], SCHEMA)
    cut = line_dedup.remove_common_lines(docs.repartition(5), **how)
    return sorted((tuple(r) for r in cut.collect()), key=str)


def fixture():
    rng = random.Random(4)
    common = [f"Line {i}" for i in range(12)] + ["é È", "ß", " x", "Ä"]
    rows = []
    for i in range(120):
        lines = [rng.choice(["", " ", "\t"]) + rng.choice(common[: 1 + i % 16]) + rng.choice(["", " \v"])
                 for _ in range(rng.randint(0, 9))]
        rows.append((i, "\n".join(lines + [f"own {i}", "", "  "])))
    rows += [(i, t.upper()) for i, t in rows[:20]]  # other texts with the same keys
    rows += [(200 + i, "nine documents have it") for i in range(9)]
    rows += [(200, "nine documents have it\nNINE documents have it ")]
    rows += [(300 + i, "ten of them\r") for i in range(10)]
    rows += [(None, None), (None, "Line 3"), (None, "Line 3"), (400, None), (401, ""), (402, "\n"), (402, "\n")]
    rows += [(403, "long " * 20000), (404, "Line 1\n" * 30000)]
    return rows


@pytest.mark.parametrize("how", [{}, {"min_docs": 1}, {"min_docs": 40, "min_chars": 4}])
def test_against_plain_python(spark, how):
    assert run(spark, fixture(), **how) == brute(fixture(), **how)


def test_a_line_of_most_documents_over_many_partitions(spark):
    """More partitions than different lines: every line goes on in the next partition."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [(i, "all\nof them" if i % 3 else "some\nof them") for i in range(90)]
        rows += [(i, "nine") for i in range(9)] + [(i, "ten") for i in range(20, 30)]
        assert run(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("held", [1, 3, 10_000])
def test_sieve_over_any_cuts(monkeypatch, held):
    """Decided, pending and marked rows of all partitions make up the rows of common keys."""
    monkeypatch.setattr(line_dedup, "MOST_HELD", held)
    rng = random.Random(held)
    for _ in range(150):
        rows = sorted({(rng.randint(0, 2), 0, rng.randint(0, 6), rng.randint(0, 2), rng.randint(0, 2))
                       for _ in range(rng.randint(1, 60))})
        docs = {}
        for h1, _, doc, _, _ in rows:
            docs.setdefault(h1, set()).add(doc)
        want = {r for r in rows if len(docs[r[0]]) >= 4}
        names = ["h1", "h2", "doc", "version", "pos", "more"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        cuts = sorted(rng.choices(range(len(rows) + 1), k=4))
        out = []
        for a, b in zip([0, *cuts], [*cuts, len(rows)]):
            at, batches = a, []
            while at < b:
                step = rng.randint(1, 9)
                part = [(*r, str(r).encode()) for r in rows[at : min(b, at + step)]]
                batches.append(pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*part), types)], names=names))
                at += step
            for batch in line_dedup.common_rows(iter(batches), 4):
                out += [tuple(r.values()) for r in batch.to_pylist()]
        marked = {r[0] for r in out if r[6] == line_dedup.COMMON}
        late = {}
        for r in out:
            if r[6] == line_dedup.PENDING:
                late.setdefault(r[0], set()).add(r[2])
        found = marked | {k for k, d in late.items() if len(d) >= 4}
        got = {r[5] for r in out if r[6] == line_dedup.DECIDED or r[6] == line_dedup.PENDING and r[0] in found}
        assert got == {str(r).encode() for r in want}


def test_bitmaps_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 7, 8, 9, 1000):
        keep = rng.random(n) < 0.5
        assert (line_dedup.unpack(line_dedup.pack(keep), n) == keep).all()


def test_bitmaps_tell_texts_of_one_key_apart(spark):
    rows = [(i, "same\nown " + str(i)) for i in range(10)] + [(0, "other\nsame")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    maps = line_dedup.line_bitmaps(docs).filter("doc = 0").collect()
    kept = sorted(line_dedup.unpack(m["keep"], m["n_lines"]).tolist() for m in maps)
    assert kept == [[False, True], [True, False]]


def test_digest_is_that_of_the_kept_text(spark):
    from corpuslens.llm import queries

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {(k, n, gone, hashlib.sha256(t.encode()).hexdigest()) for k, n, gone, t in brute([tuple(d) for d in docs])}
    assert {tuple(r) for r in queries.op13(spark, sf).collect()} == want
