"""Packing as a cutting-stock problem: column generation over the histogram of lengths."""

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.llm import tokens
from corpuslens.llm.best_fit import cut
from corpuslens.session import materialize

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("width", pa.int32()),
        ("part", pa.int32()),
        ("place", pa.int64()),
        ("inner", pa.int32()),
    ]
)
PIECES_DDL = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "width int, part int, place bigint, inner int"
)


# The plan ------------------------------------------------------------------------------


def price(values: np.ndarray, widths: np.ndarray, capacity: int) -> np.ndarray:
    """Pattern of greatest value: unbounded knapsack by dynamic programming."""
    worth = np.full(capacity + 1, -1.0)
    worth[widths] = values
    item = np.full(capacity + 1, -1)
    item[widths] = np.arange(len(widths))
    best = np.zeros(capacity + 1)
    choice = np.zeros(capacity + 1, dtype=np.int64)  # width taken last; 0: leave one unit
    for c in range(1, capacity + 1):
        options = worth[1 : c + 1] + best[c - 1 :: -1]
        w = int(options.argmax())
        if options[w] > best[c - 1] + 1e-12:
            best[c], choice[c] = options[w], w + 1
        else:
            best[c] = best[c - 1]
    pattern = np.zeros(len(widths), dtype=np.int64)
    c = capacity
    while c > 0:
        if choice[c]:
            pattern[item[choice[c]]] += 1
        c -= choice[c] or 1
    return pattern


def generate_columns(
    widths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 0.001, rounds: int = 5000
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one per column) and how often the linear program uses each.

    Revised simplex on the restricted master problem, minimal number of sequences with every
    demand met exactly; the knapsack prices new columns by the dual values. The worth of the
    best pattern bounds how far the solution is from the optimum, and so does the sum of all
    lengths: it ends when either is within ``gap``, or after ``rounds``; the last basis is a
    solution in any case.
    """
    m = len(widths)
    each = capacity // widths
    basis = np.diag(each.astype(np.float64))
    inverse = np.diag(1.0 / each)
    amount = demand / each
    enough = float(widths @ demand) / capacity * (1 + gap)
    for turn in range(rounds):
        if amount.sum() <= enough:
            break
        duals = inverse.sum(axis=0)
        pattern = price(duals, widths, capacity)
        if duals @ pattern <= 1 + gap:
            break
        direction = inverse @ pattern
        rows = np.flatnonzero(direction > 1e-9)
        ratio = amount[rows] / direction[rows]
        step = ratio.min()
        # of equals the largest pivot, for stable arithmetic
        ties = rows[ratio <= step + 1e-12]
        out = int(ties[direction[ties].argmax()])
        amount -= step * direction
        amount[out] = step
        np.maximum(amount, 0, out=amount)
        basis[:, out] = pattern
        inverse[out] /= direction[out]
        others = np.arange(m) != out
        inverse[others] -= np.outer(direction[others], inverse[out])
        if turn % 100 == 99:  # rounding errors do not pile up
            inverse = np.linalg.inv(basis)
            amount = np.maximum(inverse @ demand, 0)
    return np.rint(basis).astype(np.int64), amount


def first_fit(widths: np.ndarray, demand: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Patterns for a remainder, by first fit decreasing over the histogram."""
    left, patterns = demand.copy(), []
    order = np.argsort(-widths)
    while left.any():
        pattern, room = np.zeros(len(widths), dtype=np.int64), capacity
        for i in order:
            n = min(int(left[i]), room // int(widths[i]))
            pattern[i] = n
            room -= n * int(widths[i])
        # the same pattern as long as the remainder holds it
        times = int((left[pattern > 0] // pattern[pattern > 0]).min())
        left -= times * pattern
        patterns.append((pattern, times))
    return patterns


def plan_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns {width: pieces} and how many sequences use each; demands are met exactly."""
    if not histogram:
        return []
    widths = np.array(sorted(histogram), dtype=np.int64)
    demand = np.array([histogram[w] for w in widths.tolist()], dtype=np.int64)
    basis, amount = generate_columns(widths, demand.astype(np.float64), capacity)
    plan, left = [], demand.copy()
    for j in np.argsort(-amount):
        used = basis[:, j] > 0
        # rounded down, and never more than is left, whatever the rounding errors
        times = min(int(amount[j] + 1e-6), int((left[used] // basis[used, j]).min()))
        if times > 0:
            left -= times * basis[:, j]
            plan.append((basis[:, j], times))
    plan += first_fit(widths, left, capacity)
    as_dict = lambda p: {int(w): int(n) for w, n in zip(widths, p) if n}
    return [(as_dict(p), times) for p, times in plan]


class Assignment:
    """Where the piece of a given rank among those of its width goes.

    The pieces of one width are dealt to the patterns in order; within a pattern, to its
    sequences in order.
    """

    def __init__(self, plan: list[tuple[dict[int, int], int]]):
        self.of: dict[int, tuple] = {}
        lists: dict[int, list] = {}
        sequence = 0
        for pattern, times in plan:
            slot = 0
            for width in sorted(pattern, reverse=True):
                n = pattern[width]
                lists.setdefault(width, []).append((n * times, n, sequence, slot))
                slot += n
            sequence += times
        for width, entries in lists.items():
            total, n, first, slot = (np.array(x, dtype=np.int64) for x in zip(*entries))
            self.of[width] = np.cumsum(total) - total, n, first, slot

    def place(self, width: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        before, n, first, slot = self.of[width]
        j = np.searchsorted(before, rank, "right") - 1
        inside = rank - before[j]
        return first[j] + inside // n[j], slot[j] + inside % n[j]


# The operator --------------------------------------------------------------------------


class Bundles:
    """Gives pieces their width and their place among those of this width.

    A piece shorter than half a bundle would lose much by rounding, so such pieces are gathered
    and take the place of one piece together. A bundle ends where its length is nearest below a
    multiple of ``unit``, between half and all of its greatest length.
    """

    def __init__(self, part: int, capacity: int, unit: int):
        self.part, self.unit = part, unit
        self.most = min(32 * unit, capacity)
        self.seen = np.zeros(capacity // unit + 2, dtype=np.int64)
        self.rows, self.held, self.held_length = [], [], 0

    def close(self, pieces: list[tuple]):
        width = -(-sum(p[2] for p in pieces) // self.unit)
        place = int(self.seen[width])
        self.seen[width] += 1
        self.rows += [(*p, width, self.part, place, i) for i, p in enumerate(pieces)]

    def add(self, piece: tuple):
        if 2 * piece[2] >= self.most:
            self.close([piece])
            return
        self.held.append(piece)
        self.held_length += piece[2]
        if self.held_length > self.most:
            ends = np.cumsum([p[2] for p in self.held])
            fit = np.flatnonzero((2 * ends >= self.most) & (ends <= self.most))
            n = int(fit[np.lexsort((-ends[fit], -ends[fit] % self.unit))[0]]) + 1
            self.close(self.held[:n])
            self.held = self.held[n:]
            self.held_length -= int(ends[n - 1])

    def take(self, last: bool = False) -> pa.RecordBatch | None:
        if last and self.held:
            self.close(self.held)
            self.held = []
        if not self.rows:
            return None
        columns = [pa.array(c, f.type) for c, f in zip(zip(*self.rows), PIECES)]
        self.rows = []
        return pa.RecordBatch.from_arrays(columns, schema=PIECES)


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int, unit: int, end_id: int, key: str, text: str
) -> DataFrame:
    """One row per piece of a document, numbered within partition and width."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundles = Bundles(TaskContext.get().partitionId(), capacity, unit)
        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            for low, ids, first in tokens.encode_column(batch.column(1), tokenizer, end_id):
                view = memoryview(ids.astype("<u4", copy=False)).cast("B")
                for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                    for start, length in cut(b - a, capacity):
                        low_byte = 4 * (a + start)
                        crc = crc32(view[low_byte : low_byte + 4 * length])
                        bundles.add((ids_of[low + i], start, length, crc, b - a))
            done = bundles.take()
            if done is not None:
                yield done
        done = bundles.take(last=True)
        if done is not None:
            yield done

    rows = docs.select(F.col(key).cast("bigint"), F.col(text))
    return rows.mapInArrow(pieces, PIECES_DDL)


def pack_cutting_stock(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    unit: int = 16,
    end_id: int = 2,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Assign the token ids of all texts to sequences of at most ``capacity`` tokens.

    Documents longer than ``capacity`` are cut into whole sequences and a rest. Pieces shorter
    than ``16 * unit`` are gathered into bundles of twice that at most, which are packed like one
    piece. The lengths, rounded up to ``unit`` tokens, form a histogram of at most
    ``capacity / unit`` entries; only that reaches the driver, whatever the input. A linear
    program over its patterns, with columns priced by a knapsack, says how many sequences
    take which lengths; fractions are rounded down and the few pieces left are packed by
    first fit. Pieces are ranked within their length by counts per partition, and the rank
    decides pattern, sequence and slot, so no token and no text is shuffled.

    One row per piece: ``doc_id``, ``start`` (ids of its document before it), ``length``,
    ``ids_crc32`` (of the little-endian unsigned 32-bit ids), ``doc_tokens`` (ids of the
    document with ``end_id``), ``sequence_id``, ``offset`` (gapless from 0) and
    ``sequence_tokens``. Padding is what a sequence lacks to ``capacity``; a sequence whose
    length is a power of two needs none.

    A null text counts as empty and gives ``end_id`` alone; a null key stays null; repeated
    rows are packed as often as they occur; an empty table gives no rows; other columns are
    ignored.
    """
    if capacity % unit:
        raise ValueError("capacity must be a multiple of unit")
    pieces = materialize(token_pieces(docs, tokenizer, capacity, unit, end_id, key, text))
    counts = pieces.groupBy("part", "width").agg(F.max("place").alias("n"))
    counts = materialize(counts.withColumn("n", F.col("n") + 1))  # one row per task and width
    totals = counts.groupBy("width").agg(F.sum("n").alias("n")).collect()  # capacity / unit rows
    plan = plan_patterns({r["width"]: r["n"] for r in totals}, capacity // unit)
    assignment = Assignment(plan)

    before = Window.partitionBy("width").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "part", "width", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    ranked = pieces.join(starts, ["part", "width"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "width",
        (F.col("before") + F.col("place")).alias("rank"), "inner",
    )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = batch.column(5).to_numpy()
            rank = batch.column(6).to_numpy()
            sequence, slot = np.empty(len(width), np.int64), np.empty(len(width), np.int64)
            for w in np.unique(width).tolist():
                at = np.flatnonzero(width == w)
                sequence[at], slot[at] = assignment.place(w, rank[at])
            columns = [*batch.columns[:5], pa.array(sequence), pa.array(slot), batch.column(7)]
            names = [*batch.schema.names[:5], "sequence_id", "slot", "inner"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    placed = ranked.mapInArrow(
        assign,
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, slot bigint, inner int",
    )
    row = Window.partitionBy("sequence_id").orderBy("slot", "inner")  # at most capacity rows
    upto = row.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = row.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        (F.sum("length").over(upto) - F.col("length")).alias("offset"),
        F.sum("length").over(everything).alias("sequence_tokens"),
    )
