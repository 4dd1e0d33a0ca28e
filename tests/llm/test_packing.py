"""Token ids, best-fit packing and cutting stock."""

import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest

from corpuslens.llm import best_fit, cutting_stock, tokens

SCHEMA = "doc_id bigint, text string"
# two words of 1,024 letters that have one polynomial hash modulo 2**64
MORSE = ["".join(ab[i.bit_count() % 2] for i in range(1024)) for ab in ("ab", "ba")]
ODD = [
    "<|endoftext|>foo. Bar<|ENDOFTEXT|>", "don't. I'll...stop!? á. É. ≠", "", "  ", "日本語。テスト, ok",
    "it's.'s 'S", "İstanbul. K", "x<|startoftext|>. y", "x" * 70000 + ". y", "H\u0331 h\u0331", None,
    " ".join(MORSE), MORSE[1],
]


def expected(rows):
    tokenizer = tokens.load(tokens.default_path())
    return {k: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for k, t in rows}


def check(rows, pieces, capacity):
    ids = expected(rows)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        own = np.array(ids[p["doc_id"]][p["start"] : p["start"] + p["length"]], dtype="<u4")
        assert crc32(own.tobytes()) == p["ids_crc32"]
        assert p["doc_tokens"] == len(ids[p["doc_id"]])
        by_doc[p["doc_id"]].append((p["start"], p["length"]))
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"], p["sequence_tokens"]))
    assert set(by_doc) == set(ids)
    for groups, total in ((by_doc, lambda k: len(ids[k])), (by_sequence, lambda k: by_sequence[k][0][2])):
        for k, parts in groups.items():
            end = 0
            for part in sorted(parts):
                assert part[0] == end
                end += part[1]
            assert end == total(k)
    assert max(p["sequence_tokens"] for p in pieces) <= capacity


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 6))) for _ in range(200)]
    texts = [" ".join(rng.choices(words, k=rng.choice([0, 1, 5, 60, 200, 900]))) for _ in range(150)]
    return list(enumerate(ODD + texts))


def test_best_fit_rows(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    packed = best_fit.pack_best_fit(docs, tokens.default_path(), capacity=512, block_tokens=20000)
    check(rows, best_fit.segments(packed).collect(), 512)
    for r in packed.collect():
        n = r["n_tokens"]
        assert len(r["ids"]) == 4 * (n if n & (n - 1) == 0 else 512)
        assert r["cu_seqlens"][:-1] == r["position_resets"] and r["cu_seqlens"][-1] == n


def test_cutting_stock_rows(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    check(rows, cutting_stock.pack_cutting_stock(docs, tokens.default_path(), capacity=512).collect(), 512)


def test_empty_tables_and_null_keys(spark):
    for pack in (best_fit.pack_best_fit, cutting_stock.pack_cutting_stock):
        assert pack(spark.createDataFrame([], SCHEMA), tokens.default_path()).count() == 0
        docs = spark.createDataFrame([(None, "a b", 1), (1, None, 2), (1, None, 2)], "doc_id bigint, text string, start int")
        assert pack(docs, tokens.default_path()).count() in (1, 3)


def test_best_fit_takes_the_fullest_bin():
    rng = random.Random(1)
    lengths = [rng.randint(1, 100) for _ in range(400)]
    bins, room = [], []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [b for b in range(len(bins)) if room[b] >= lengths[item]]
        if fits:
            best = min(fits, key=lambda b: room[b])
        else:
            best = len(bins)
            bins.append([])
            room.append(100)
        bins[best].append(item)
        room[best] -= lengths[item]
    got = best_fit.best_fit_decreasing(lengths, 100)
    assert sorted(sum(lengths[i] for i in b) for b in got) == sorted(100 - r for r in room)


def test_plan_meets_every_demand_with_little_waste():
    rng = random.Random(2)
    histogram = defaultdict(int)
    for _ in range(5000):
        histogram[min(64, 1 + int(rng.expovariate(0.08)))] += 1
    plan = cutting_stock.plan_patterns(dict(histogram), 64)
    made = defaultdict(int)
    for pattern, times in plan:
        assert sum(w * n for w, n in pattern.items()) <= 64
        for w, n in pattern.items():
            made[w] += n * times
    assert made == histogram
    used = sum(times for _, times in plan)
    assert used <= 1.02 * sum(w * n for w, n in histogram.items()) / 64 + 2
    place = cutting_stock.Assignment(plan)
    seen = set()
    for w, n in histogram.items():
        seen |= set(zip(*map(list, place.place(w, np.arange(n)))))
    assert len(seen) == sum(histogram.values())


@pytest.mark.parametrize("sizes", [(1,), (2,), (17,), (20,), (65,), (250,), (270,), (5, 30, 90), (1, 40, 200, 900, 3000)])
def test_little_padding_on_short_texts(spark, sizes):
    """At most 2 % of all sequences but the last of each task; 1 is an empty text."""
    rng = random.Random(sizes[0])
    n = 200_000 // (sum(sizes) // len(sizes))
    rows = []
    for i in range(min(n, 20_000)):
        size = rng.choice(sizes)
        size = size if size < 20 else rng.randint(size - 9, size + 9)
        rows.append((i, " ".join(["a"] * (size - 1))))
    packed = cutting_stock.pack_cutting_stock(spark.createDataFrame(rows, SCHEMA).repartition(2), tokens.default_path())
    pieces = [r.asDict() for r in packed.collect()]
    check(rows, pieces, 4096)
    total = sum(p["length"] for p in pieces)
    sequences = {p["sequence_id"] for p in pieces}
    assert len(sequences) * 4096 <= 1.02 * total + 2 * 4096
