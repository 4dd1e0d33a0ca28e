"""The trie of conversations against plain Python."""

import hashlib
import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest

from corpuslens.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, node string, path string, conv int"


def rebuild(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 9
        rest = c % 5 if c >= 0 else -(-c % 5)  # of the sign of c
        out[c] = own.get(c - rest, [])[:h] + turns[h:]
    return out


def brute(rows):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sorted(rebuild(rows).items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted(
        (convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), children[node], leaves[node],
         saved[node], hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest())
        for node, convs in members.items()
    )


def run(spark, rows, **how):
    chats = spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in prefix_trie.shared_prefixes(chats, **how).collect())


def fixture(n=150):
    rng = random.Random(n)
    rows = []
    for c in range(-20, n):
        for t in range(rng.choice([1, 2, 3, 6, 12])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "é", "", None, "long " * 9])))
    rows += [(n + i, t, "user", f"same {t}") for i in range(40) for t in range(10)]  # copies
    rows += [(500, None, "user", "first"), (500, 3, "u", "x"), (501, 1, None, None), (None, 1, "user", "nobody")]
    rows += [(505, t, "user", "t" * (t % 7)) for t in range(400)] + [(506, t, "user", "t" * (t % 7)) for t in range(400)]
    rows += [(511, 1, "user", "said twice"), (511, 2, "user", "said twice"), (1003, 1, "user", "no turn is left")]
    return rows


@pytest.fixture
def many_partitions(spark):
    keys = {"spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [1, 7, 1 << 18])
def test_against_plain_python(spark, many_partitions, size):
    rows = fixture()
    assert any(not turns for turns in rebuild(rows).values())
    assert run(spark, rows, shard_size=size) == brute(rows)


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()]
    assert run(spark, rows) == brute(rows)


def test_repeated_rows_are_repeated_turns(spark):
    rows = [(1, 0, "user", "a")] * 12 + [(2, 0, "user", "a"), (2, 0, "user", "b")] * 5
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_lonely_conversations(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "a", "b")]) == []
    assert run(spark, [(7, 1, "a", "b")]) == brute([(7, 1, "a", "b")])


def test_ends_of_subtrees():
    rng = random.Random(2)
    for n in [1, 2, 3, 50, 64, 65, 1000, 20_000]:
        for wide in (0.1, 0.5, 0.97):
            depth = [0]
            for _ in range(n - 1):
                depth.append(depth[-1] + 1 if rng.random() < wide else rng.randint(1, depth[-1] + 1))
            depth = np.array(depth)
            parent = np.full(n, -1)
            stack = {}
            for i, d in enumerate(depth.tolist()):
                parent[i] = stack.get(d - 1, -1)
                stack[d] = i
            tree = prefix_trie.Tree(depth, parent)
            later, end = [], np.empty(n, dtype=np.int64)
            for i in range(n - 1, -1, -1):
                while later and depth[later[-1]] > depth[i]:
                    later.pop()
                end[i] = later[-1] if later else n
                later.append(i)
            assert (tree.end == end).all()
            values = np.arange(n) % 11
            some = rng.randrange(n)
            assert tree.sums(values)[some] == values[some : end[some]].sum()
            assert tree.least(values)[some] == values[some : end[some]].min()
            leaf = ~np.isin(np.arange(n), parent)
            assert tree.leaves(np.array([], dtype=np.int64))[some] == leaf[some : end[some]].sum()
