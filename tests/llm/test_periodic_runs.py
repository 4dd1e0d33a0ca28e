"""Runs of repeated words against plain Python."""

import hashlib
import random
from zlib import crc32

import pytest

from corpuslens.llm import periodic_runs, queries

SCHEMA = "doc_id bigint, text string, kind int, row string, runs int, words string"


def brute_runs(words, min_length=12):
    """Every period on its own; of one stretch the smallest counts."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(min_length, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def brute(words, min_length=12):
    runs = brute_runs(words, min_length)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return len(words), runs, " ".join(w for i, w in enumerate(words) if i not in gone)


def cases(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(160):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choices("abcdefghij"[: rng.choice([1, 2, 3, 10])], k=rng.randint(0, 40))
            unit = rng.choices("abcé"[: rng.randint(1, 4)], k=rng.randint(1, 40))
            words += (unit * rng.randint(1, 12))[: rng.randint(1, 200)]
        out.append(words)
    out += [["x"] * n for n in (1, 11, 12, 13, 31, 32, 33, 500)]
    out += [["a", "b"] * n for n in (5, 6, 7, 300)]
    unit = [f"w{i}" for i in range(700)]
    out += [unit * 2, unit * 2 + unit[:1], unit + unit[:-1], unit * 4, ["y"] + unit * 3 + ["z"], (unit * 2 + ["!"]) * 3]
    fib = ["a"], ["a", "b"]
    for _ in range(11):
        fib = fib[1], fib[1] + fib[0]
    return out + [fib[1]]


@pytest.mark.parametrize("min_length", [2, 3, 12, 29])
def test_tiles_find_all_runs(spark, min_length):
    texts = cases(min_length)
    rows = [(i, " \t".join(words) + "\n", 1, "x", 2, "y") for i, words in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r[0]: (r[1], [tuple(x) for x in r[2]], r[3]) for r in periodic_runs.periodic_runs(docs, min_length=min_length).collect()}
    for i, words in enumerate(texts):
        assert got[i] == brute(words, min_length), words


def test_odd_rows(spark):
    rows = [(None, None, 1, "x", 2, "y"), (None, "a " * 20, 1, "x", 2, "y"), (None, "a " * 20, 1, "x", 2, "y"),
            (1, "", 1, None, 2, "y"), (1, " \n", 1, None, 2, "y"), (2, "b", 1, None, None, None)]
    out = periodic_runs.periodic_runs(spark.createDataFrame(rows, SCHEMA))
    got = sorted((str(r[0]), r[1], [tuple(x) for x in r[2]], r[3]) for r in out.collect())
    assert got == sorted([("None", 0, [], ""), ("None", 20, [(0, 20, 1)], "a"), ("None", 20, [(0, 20, 1)], "a"),
                          ("1", 0, [], ""), ("1", 0, [], ""), ("2", 1, [], "b")])
    assert periodic_runs.periodic_runs(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_text(spark):
    """Over a million words, read piece by piece: distinct ones, a period of 100,000 and one of 1."""
    words = [f"{i:x}" for i in range(300_000)] + [f"p{i:x}" for i in range(100_000)] * 7 + ["z"] * 50_000
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id bigint, text string")
    (row,) = periodic_runs.periodic_runs(docs).collect()
    assert [tuple(r) for r in row["runs"]] == [(300_000, 700_000, 100_000), (1_000_000, 50_000, 1)]
    assert row["collapsed"] == " ".join(words[:400_000] + ["z"])


def test_words_across_pieces(monkeypatch):
    monkeypatch.setattr(periodic_runs, "PIECE", 5)
    raw = "a bcdefghijklmnopq r  stuv wx\tyz aa aa\n".encode()
    known = {}
    numbers = periodic_runs.word_numbers(raw, known)
    assert [list(known)[i] for i in numbers] == raw.split()


def test_planted_table(spark):
    sf = "/root/testdata/sf0.001"
    want = {}
    for doc, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        words = text.encode().split()
        words = [w.decode() for w in words]
        h, n = crc32(str(doc).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        _, runs, kept = brute(words)
        best = min(((-length, s, q) for s, length, q in runs), default=None)
        four = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        want[doc] = (len(runs), *four, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())
    got = {r[0]: tuple(r)[1:] for r in queries.op11(spark, sf).collect()}
    assert got == want
    assert sum(r[0] > 0 for r in got.values()) > 10
