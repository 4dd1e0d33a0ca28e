"""Best-fit-decreasing packing of token ids into fixed-length sequences, as binary rows."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm import tokens

SEQUENCES = pa.schema(
    [
        ("sequence_id", pa.int64()),
        ("n_tokens", pa.int32()),
        ("ids", pa.binary()),
        ("cu_seqlens", pa.list_(pa.int32())),
        ("position_resets", pa.list_(pa.int32())),
        ("doc_ids", pa.list_(pa.int64())),
        ("starts", pa.list_(pa.int64())),
        ("doc_tokens", pa.list_(pa.int64())),
    ]
)
SEQUENCES_DDL = (
    "sequence_id bigint, n_tokens int, ids binary, cu_seqlens array<int>, "
    "position_resets array<int>, doc_ids array<bigint>, starts array<bigint>, "
    "doc_tokens array<bigint>"
)


class Capacities:
    """Open bins by remaining capacity: a segment tree of counts finds the least that fits."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, capacity: int, number: int):
        self.bins[capacity].append(number)
        node = capacity + self.size
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove a bin with the least capacity of ``length`` or more; its capacity, number."""
        node = length + self.size
        count = self.count
        while not count[node]:
            while node & 1:  # a right child: go on behind its parent
                node >>= 1
            if not node:
                return None
            node += 1
            if node & (node - 1) == 0:  # past the last leaf of this level
                return None
        while node < self.size:
            node <<= 1
            if not count[node]:
                node += 1
        capacity = node - self.size
        while node:
            count[node] -= 1
            node >>= 1
        return capacity, self.bins[capacity].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers; items in order of falling length, equals in their own order."""
    open_bins, bins = Capacities(capacity), []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        length = lengths[item]
        fit = open_bins.take(length)
        if fit is None:
            fit = capacity, len(bins)
            bins.append([])
        bins[fit[1]].append(item)
        if fit[0] > length:
            open_bins.add(fit[0] - length, fit[1])
    return bins


def padded_length(n: int, capacity: int) -> int:
    """Tokens a sequence is stored with: a power of two stays, all else is filled up."""
    return n if n & (n - 1) == 0 else capacity


def cut(total: int, capacity: int) -> Iterator[tuple[int, int]]:
    """Start and length of the pieces of a document: whole sequences and a rest."""
    for start in range(0, total, capacity):
        yield start, min(capacity, total - start)


def pack_block(block: list, first_number: int, capacity: int, pad_id: int) -> pa.RecordBatch:
    """``block``: (doc_id, start, ids, tokens of the document) of every piece."""
    rows = []
    for number, items in enumerate(best_fit_decreasing([len(b[2]) for b in block], capacity)):
        parts = [block[i] for i in items]
        ends = np.cumsum([len(p[2]) for p in parts])
        total = int(ends[-1])
        row = np.full(padded_length(total, capacity), pad_id, dtype="<u4")
        np.concatenate([p[2] for p in parts], out=row[:total])
        rows.append(
            {
                "sequence_id": first_number + number,
                "n_tokens": total,
                "ids": row.tobytes(),
                "cu_seqlens": [0, *ends.tolist()],
                "position_resets": [0, *ends[:-1].tolist()],
                "doc_ids": [p[0] for p in parts],
                "starts": [p[1] for p in parts],
                "doc_tokens": [p[3] for p in parts],
            }
        )
    return pa.RecordBatch.from_pylist(rows, schema=SEQUENCES)


def pack_best_fit(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int = 2,
    pad_id: int = 0,
    block_tokens: int = 8_000_000,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pack the token ids of all texts into sequences of at most ``capacity`` tokens.

    One row per sequence: ``ids`` is the row of the id matrix (little-endian unsigned 32-bit),
    filled up to ``capacity`` with ``pad_id`` unless its length is a power of two;
    ``cu_seqlens`` are the cumulative segment lengths from 0, ``position_resets`` the places
    where positions start again; ``doc_ids``, ``starts`` and ``doc_tokens`` tell for each
    segment which tokens of which document it holds. A document longer than ``capacity`` is
    cut into whole sequences and a rest, without loss.

    Nothing is shuffled: every input partition is packed on its own, in blocks of about
    ``block_tokens`` tokens, which bounds memory. Padding is left over only in the last bins
    of a block. A null text counts as empty and gives ``end_id`` alone; a null key stays null;
    repeated rows are packed as often as they occur; an empty table gives no rows; other
    columns are ignored. Sequence numbers are unique, not consecutive.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        block, held = [], 0
        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            for low, ids, first in tokens.encode_column(batch.column(1), tokenizer, end_id):
                for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                    for start, length in cut(b - a, capacity):
                        piece = ids[a + start : a + start + length].copy()
                        block.append((ids_of[low + i], start, piece, b - a))
                    held += b - a
                if held >= block_tokens:
                    packed = pack_block(block, number, capacity, pad_id)
                    number += len(packed)
                    yield packed
                    block, held = [], 0
        if block:
            yield pack_block(block, number, capacity, pad_id)

    rows = docs.select(F.col(key).cast("bigint"), F.col(text))
    return rows.mapInArrow(pack, SEQUENCES_DDL)


def segments(sequences: DataFrame) -> DataFrame:
    """One row per segment, read from the packed rows: its place, length and CRC of its ids."""
    at = F.posexplode("position_resets").alias("_n", "offset")
    rows = sequences.select("*", at)
    pick = lambda name: F.element_at(name, F.col("_n") + 1)
    length = F.element_at("cu_seqlens", F.col("_n") + 2) - F.col("offset")
    own = F.substring("ids", F.col("offset") * 4 + 1, length * 4)
    return rows.select(
        pick("doc_ids").alias("doc_id"),
        pick("starts").alias("start"),
        length.cast("bigint").alias("length"),
        F.crc32(own).alias("ids_crc32"),
        pick("doc_tokens").alias("doc_tokens"),
        "sequence_id",
        F.col("offset").cast("bigint").alias("offset"),
        F.col("n_tokens").cast("bigint").alias("sequence_tokens"),
    )
