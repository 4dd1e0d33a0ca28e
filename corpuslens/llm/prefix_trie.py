"""The trie of conversations that begin with the same turns, in balanced parentheses."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.session import materialize

TURN = 16  # bytes of a turn's digest in a path
BLOCK = 64  # parentheses to a block of the excess tree

# A shard is closed after so many nodes or conversations, which bounds its memory.
SHARD_SIZE = 1 << 18
MOST_IDS = 1 << 16  # ids in one row of those that end at a node of a spine

EMPTY = hashlib.sha256(b"").hexdigest()
NODE, SPINE, ENDS = 0, 1, 2


class Parentheses:
    """A tree, given as the depths of its nodes in preorder, as balanced parentheses.

    The excess (open less closed) is summed up in blocks by minimum and maximum, and these in a
    binary tree, so the end of a subtree is found without walking through it.
    """

    def __init__(self, depth: np.ndarray):
        n = len(depth)
        self.open = 2 * np.arange(n) - depth  # closed before: all but the open ancestors
        self.bits = np.zeros(2 * n, dtype=bool)
        self.bits[self.open] = True
        self.excess = np.cumsum(np.where(self.bits, 1, -1)).astype(np.int64)
        pad = -len(self.bits) % BLOCK
        padded = np.concatenate([self.excess, np.zeros(pad, dtype=np.int64)]).reshape(-1, BLOCK)
        self.low, self.high = [padded.min(axis=1)], [padded.max(axis=1)]
        while len(self.low[-1]) > 1:
            for levels, best in ((self.low, np.minimum), (self.high, np.maximum)):
                top = levels[-1]
                top = np.append(top, top[-1:]) if len(top) % 2 else top
                levels.append(best(top[::2], top[1::2]))

    def _holds(self, level: int, block: np.ndarray, excess: np.ndarray) -> np.ndarray:
        return (self.low[level][block] <= excess) & (excess <= self.high[level][block])

    def _scan(self, at, excess, out, which):
        """Look on from ``at`` to the end of its block; gives who found nothing there."""
        while len(which):
            inside = at[which] < len(self.excess)
            hit = np.zeros(len(which), dtype=bool)
            hit[inside] = self.excess[at[which[inside]]] == excess[which[inside]]
            out[which[hit]] = at[which[hit]]
            which = which[~hit]
            at[which] += 1
            ended = at[which] % BLOCK == 0
            if ended.any():
                yield which[ended]
                which = which[~ended]

    def find_close(self) -> np.ndarray:
        """Place of the parenthesis that closes each node."""
        at, out = self.open + 1, np.full(len(self.open), -1)
        excess = self.excess[self.open] - 1
        # the rest of the first block; a node may begin at the end of one
        start = np.arange(len(at))
        border = at % BLOCK == 0
        late = [start[border], *self._scan(at, excess, out, start[~border])]
        which = np.concatenate(late)
        block, level = at[which] // BLOCK, np.zeros(len(which), dtype=np.int64)
        # up until a block holds the excess: a left block by way of its parent, a right one itself
        block, top = at[which] // BLOCK, len(self.low) - 1
        level, todo = np.full(len(which), top), np.arange(len(which))
        for k in range(top):
            ask = todo[block[todo] % 2 == 1]
            hit = self._holds(k, block[ask], excess[which[ask]])
            level[ask[hit]] = k
            block[ask[~hit]] += 1
            todo = np.setdiff1d(todo, ask[hit], assume_unique=True)
            block[todo] //= 2
        # and down to the first block that does
        for k in range(len(self.low) - 1, 0, -1):
            here = np.flatnonzero(level == k)
            left = 2 * block[here]
            right = ~self._holds(k - 1, left, excess[which[here]])
            block[here] = left + right
            level[here] = k - 1
        at[which] = block * BLOCK
        for _ in self._scan(at, excess, out, which):
            raise ValueError("parentheses are not balanced")
        return out


class Tree:
    """Figures of all subtrees from those of single nodes, by the places of their ends."""

    def __init__(self, depth: np.ndarray, parent: np.ndarray):
        self.depth, self.parent = depth, parent
        self.shape = Parentheses(depth)
        self.close = self.shape.find_close()
        self.start = np.arange(len(depth))
        self.end = self.start + (self.close - self.shape.open + 1) // 2

    def sums(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.end] - total[self.start]

    def leaves(self, without: np.ndarray) -> np.ndarray:
        """Pairs of parentheses next to each other inside every node, but for nodes ``without``."""
        bits = self.shape.bits
        pair = np.append(bits[:-1] & ~bits[1:], False)
        pair[self.shape.open[without]] = False
        rank = np.concatenate([[0], np.cumsum(pair)])
        return rank[self.close] - rank[self.shape.open]

    def least(self, values: np.ndarray) -> np.ndarray:
        out = values.copy()
        order = np.argsort(-self.depth, kind="stable")
        border = np.flatnonzero(np.diff(self.depth[order])) + 1
        for nodes in np.split(order, border):
            if len(nodes) and self.depth[nodes[0]] > 0:
                np.minimum.at(out, self.parent[nodes], out[nodes])
        return out


def shared_turns(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b)) // TURN
    if a[: n * TURN] == b[: n * TURN]:
        return n
    low = 0
    while n - low > 1:
        middle = (low + n) // 2
        if a[low * TURN : middle * TURN] == b[low * TURN : middle * TURN]:
            low = middle
        else:
            n = middle
    return low


class Growing:
    """The trie of sorted paths, built in preorder."""

    def __init__(self):
        self.depth, self.parent, self.weight, self.stack = [0], [-1], [0], [0]
        self.path = b""

    def add(self, path: bytes, weights) -> int:
        """The node of ``path``; ``weights`` of all its turns."""
        shared = shared_turns(self.path, path)
        del self.stack[shared + 1 :]
        for d in range(shared, len(path) // TURN):
            self.depth.append(d + 1)
            self.parent.append(self.stack[-1])
            self.weight.append(weights[d])
            self.stack.append(len(self.depth) - 1)
        self.path = path
        return self.stack[-1]

    def tree(self) -> Tree:
        return Tree(np.array(self.depth, dtype=np.int64), np.array(self.parent, dtype=np.int64))


NO_ID = np.iinfo(np.int64).max
SHARDS = (
    "kind int, shard bigint, side int, depth bigint, conv bigint, parent bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved bigint, ends string, path binary, figures binary"
)
NAMES = [c.split()[0] for c in SHARDS.split(", ")]
INTS = {"kind": pa.int32(), "side": pa.int32(), "ends": pa.string(), "path": pa.binary(), "figures": pa.binary()}


def rows_of(n: int, **columns) -> pa.RecordBatch:
    """A batch of ``n`` rows; a single value stands in all of them, what is not given is null."""
    out = []
    for name in NAMES:
        value, kind = columns.get(name), INTS.get(name, pa.int64())
        if value is None or isinstance(value, (int, str, bytes)):
            value = pa.array([value] * n, kind)
        out.append(value if isinstance(value, pa.Array) else pa.array(value, kind))
    return pa.RecordBatch.from_arrays(out, names=NAMES)


class Shard:
    """Consecutive conversations in the order of their paths.

    Nodes on the paths of the first and of the last conversation, the spines, may go on in other
    shards. All others are finished here. A spine carries, for each of its nodes, the figures of
    what hangs on that node and on no deeper node of a spine.
    """

    def __init__(self, number: int):
        self.number, self.trie = number, Growing()
        self.first: bytes | None = None
        self.ends: dict[int, list[int]] = {}
        self.rows = 0

    def add(self, path: bytes, conv: int, weights):
        node = self.trie.add(path, weights)
        if self.first is None:
            self.first = path
        self.ends.setdefault(node, []).append(conv)
        self.rows += 1

    def finish(self) -> Iterator[pa.RecordBatch]:
        tree, n = self.trie.tree(), len(self.trie.depth)
        weight = np.array(self.trie.weight, dtype=np.int64)
        ended, least = np.zeros(n, dtype=np.int64), np.full(n, NO_ID)
        for node, convs in self.ends.items():
            ended[node], least[node] = len(convs), convs[0]
        left = np.arange(len(self.first) // TURN + 1)  # first in preorder
        shared = shared_turns(self.first, self.trie.path)
        right = np.array(self.trie.stack[shared + 1 :], dtype=np.int64)
        spine = np.zeros(n, dtype=bool)
        spine[left] = spine[right] = True
        own = np.flatnonzero(~spine)

        n_convs, conv = tree.sums(ended), tree.least(least)
        saved = tree.sums(np.where(spine, 0, (n_convs - 1) * weight))
        leaves = tree.leaves(np.flatnonzero(spine))
        children = np.bincount(tree.parent[own], minlength=n)
        hung = own[spine[tree.parent[own]]]  # on a node of a spine

        def hanging(values):
            out = np.zeros(n, dtype=np.int64)
            np.add.at(out, tree.parent[hung], values[hung])
            return out

        parent = tree.parent[own]
        far = spine[parent]
        side = np.where(far, np.isin(parent, right).astype(np.int64), -1)
        for a in range(0, len(own), 1 << 16):
            some = slice(a, a + (1 << 16))
            nodes = own[some]
            digests = [
                hashlib.sha256(",".join(map(str, self.ends[x])).encode()).hexdigest() if x in self.ends else EMPTY
                for x in nodes.tolist()
            ]
            yield rows_of(
                len(nodes), kind=NODE, shard=self.number, side=side[some].astype(np.int32),
                depth=tree.depth[nodes], conv=conv[nodes],
                parent=pa.array(conv[parent[some]], pa.int64(), mask=far[some]),
                n_convs=n_convs[nodes], n_children=children[nodes], n_leaves=leaves[nodes],
                saved=saved[nodes], ends=digests,
            )

        lowest = least.copy()
        np.minimum.at(lowest, tree.parent[hung], conv[hung])
        figures = np.stack([ended + hanging(n_convs), lowest, children, hanging(leaves), hanging(saved), weight])
        figures[2] = np.where(spine, children, 0)
        for number, (nodes, path) in enumerate(((left, self.first), (right, self.trie.path))):
            if not len(nodes):
                continue
            yield rows_of(
                1, kind=SPINE, shard=self.number, side=number, depth=int(tree.depth[nodes[0]]),
                path=path, figures=np.ascontiguousarray(figures[:, nodes]).tobytes(),
            )
            for node in nodes.tolist():
                convs = self.ends.get(node, [])
                for a in range(0, len(convs), MOST_IDS):
                    ids = convs[a : a + MOST_IDS]
                    yield rows_of(
                        1, kind=ENDS, shard=self.number, side=number, depth=int(tree.depth[node]),
                        conv=ids[0], ends=",".join(map(str, ids)),
                    )


def shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows (path, conv, weights) of a partition to the rows of its shards."""
    number = TaskContext.get().partitionId() << 32
    shard = None
    for batch in batches:
        paths, convs = batch.column(0), batch.column(1).to_pylist()
        weights = batch.column(2)
        for i, conv in enumerate(convs):
            if shard is None:
                shard, number = Shard(number), number + 1
            shard.add(paths[i].as_py(), conv, weights[i].as_py())
            if shard.rows >= size or len(shard.trie.depth) >= size:
                yield from shard.finish()
                shard = None
    if shard is not None:
        yield from shard.finish()


MERGED = (
    "kind int, shard bigint, side int, depth bigint, node bigint, conv bigint, parent bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved bigint"
)


def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spines (shard, side, depth, path, figures) of all shards, in order, to their nodes
    (kind ``NODE``), and which node each place of a spine is (kind ``SPINE``)."""
    trie, parts, places = Growing(), [], []
    for batch in batches:
        for row in batch.to_pylist():
            path, depth = row["path"], row["depth"]
            figures = np.frombuffer(row["figures"], dtype=np.int64).reshape(6, -1)
            weights = [0] * depth + figures[5].tolist()
            trie.add(path, weights[1:])
            nodes = trie.stack[depth:]
            parts.append((np.array(nodes), figures))
            places += [(row["shard"], row["side"], depth + i, node) for i, node in enumerate(nodes)]
    if not parts:
        return
    n, tree = len(trie.depth), trie.tree()
    total, lowest = np.zeros((4, n), dtype=np.int64), np.full(n, NO_ID)
    for nodes, figures in parts:  # all nodes of one spine are different
        total[:, nodes] += figures[[0, 2, 3, 4]]
        lowest[nodes] = np.minimum(lowest[nodes], figures[1])
    n_convs, conv = tree.sums(total[0]), tree.least(lowest)
    children = total[1] + np.bincount(tree.parent[1:], minlength=n)
    leaves = tree.sums(total[2] + (children == 0))
    saved = tree.sums(total[3] + (n_convs - 1) * np.array(trie.weight, dtype=np.int64))
    names = [c.split()[0] for c in MERGED.split(", ")]

    def made(kind, size, *columns):
        given = [pa.array(np.full(size, kind, dtype=np.int32))]
        for c, name in zip(columns, names[1:]):
            t = pa.int32() if name == "side" else pa.int64()
            given.append(pa.nulls(size, t) if c is None else c if isinstance(c, pa.Array) else pa.array(c, t))
        return pa.RecordBatch.from_arrays(given, names=names)

    top = tree.parent < 0
    parent = pa.array(conv[np.maximum(tree.parent, 0)], pa.int64(), mask=top)
    yield made(NODE, n, None, None, tree.depth, np.arange(n), conv, parent, n_convs, children, leaves, saved)
    shard, side, depth, node = (np.array(x, dtype=np.int64) for x in zip(*places))
    side = side.astype(np.int32)
    yield made(SPINE, len(node), shard, side, depth, node, conv[node], None, None, None, None, None)


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (node, first id, ids) to one digest per node, in a stream."""

    def made(node, digest):
        return pa.RecordBatch.from_arrays(
            [pa.array([node], pa.int64()), pa.array([digest.hexdigest()])], names=["node", "ends"]
        )

    node, digest = None, None
    for batch in batches:
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(2)):
            if k != node:
                if node is not None:
                    yield made(node, digest)
                node, digest = k, hashlib.sha256(ids.as_buffer())
            else:
                digest.update(b",")
                digest.update(ids.as_buffer())
    if node is not None:
        yield made(node, digest)


def conversation_paths(chats: DataFrame) -> DataFrame:
    """One row per ``conv``: ``digests`` of its turns as hexadecimal text and their ``weights``,
    the UTF-8 bytes of their texts, in the order of turns."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = chats.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"),
        F.struct(
            F.col("turn").alias("turn"),
            F.substring(F.sha2(said, 256), 1, 2 * TURN).alias("digest"),
            F.octet_length(text).cast("bigint").alias("weight"),
        ).alias("said"),
    )
    own = turns.groupBy("conv").agg(F.sort_array(F.collect_list("said")).alias("said"))
    return own.select("conv", F.col("said.digest").alias("digests"), F.col("said.weight").alias("weights"))


def rebuilt(paths: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Every conversation with the first turns of the first one of its group of ``group`` ids in
    place of its own; ``crc32`` of its id tells how many, less than ``most``."""
    base = paths.select(F.col("conv").alias("_base"), F.col("digests").alias("_d"), F.col("weights").alias("_w"))
    head = (F.crc32(F.col("conv").cast("string")) % most).cast("int")
    rows = paths.withColumn("_h", head).join(base, F.col("conv") - F.col("conv") % group == F.col("_base"), "left")

    def joined(first: str, own: str) -> Column:
        start = F.coalesce(F.slice(first, F.lit(1), F.col("_h")), F.slice(own, 1, 0))
        return F.concat(start, F.slice(own, F.col("_h") + 1, F.size(own)))

    return rows.select("conv", joined("_d", "digests").alias("digests"), joined("_w", "weights").alias("weights"))


def prefix_trie(paths: DataFrame, shard_size: int = SHARD_SIZE) -> DataFrame:
    """The nodes of the trie of ``paths(conv, digests, weights)``.

    A node is a different sequence of first turns, down to the root, which has none. Returns
    ``conv_id`` (the least of the conversations that begin with it), ``depth``, that of its
    parent as ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes of
    its subtree), ``saved_tokens`` (over its subtree, each node's conversations but one times the
    weight of its last turn) and ``ends_sha256`` of the ids that end at it.

    Paths are range-partitioned together with their id, so equal conversations are dealt over as
    many partitions as they need, and sorted. Every partition cuts its rows into shards of bounded
    size and writes each as balanced parentheses, see ``Parentheses``: the place where a
    parenthesis closes delimits a subtree, ranks of neighbouring pairs count its leaves, and
    cumulative figures in preorder give its sums. Only the paths to the first and to the last
    conversation of a shard, its spines, can go on in another shard; they are merged by one task,
    which reads two rows per shard. Ids that end at a shared node come as rows of joined ids and
    are digested as a stream, in order, since a digest cannot be put together from parts.

    Turns are compared by 128 bits of SHA-256 of role and text. A conversation is one row of
    about 40 bytes a turn. An empty table gives no rows.
    """
    path = F.unhex(F.array_join("digests", "")).alias("path")
    rows = materialize(paths.select(path, F.col("conv"), "weights"))
    rows = rows.repartitionByRange("path", "conv").sortWithinPartitions("path", "conv")
    found = materialize(rows.mapInArrow(lambda batches: shards(batches, shard_size), SHARDS))

    spines = found.filter(F.col("kind") == SPINE).select("shard", "side", "depth", "path", "figures")
    spines = spines.coalesce(1).sortWithinPartitions("shard", "side")
    merged = materialize(spines.mapInArrow(merge, MERGED))
    places = merged.filter(F.col("kind") == SPINE).select("shard", "side", "depth", "node", "conv")

    ends = found.filter(F.col("kind") == ENDS).select("shard", "side", "depth", "conv", "ends")
    ends = ends.join(places.drop("conv"), ["shard", "side", "depth"]).select("node", "conv", "ends")
    ends = ends.repartition("node").sortWithinPartitions("node", "conv")
    ends = ends.mapInArrow(digests, "node bigint, ends string")

    figures = ["conv", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    shared = merged.filter(F.col("kind") == NODE).join(ends, "node", "left")
    shared = shared.withColumn("ends", F.coalesce("ends", F.lit(EMPTY))).select(*figures)
    own = found.filter(F.col("kind") == NODE)
    inner = own.filter("side < 0").select(*figures)
    above = places.select("shard", "side", (F.col("depth") + 1).alias("depth"), F.col("conv").alias("_above"))
    outer = own.filter("side >= 0").drop("parent").join(above, ["shard", "side", "depth"])
    outer = outer.withColumnRenamed("_above", "parent").select(*figures)
    return shared.unionByName(inner).unionByName(outer).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs",
        "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
    )


def shared_prefixes(
    chats: DataFrame, group: int = 5, most: int = 9, shard_size: int = SHARD_SIZE
) -> DataFrame:
    """The trie of the rebuilt conversations ``chats(conv_id, turn, role, text)``.

    Turns are ordered by ``turn``, nulls first, those with one number by their digests; a null
    role or text is empty. Rows without ``conv_id`` belong to no conversation. Repeated rows are
    repeated turns. Other columns are not read.
    """
    return prefix_trie(rebuilt(materialize(conversation_paths(chats)), group, most), shard_size)
