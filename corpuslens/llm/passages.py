"""Finds windows of consecutive values that occur more than once, over all texts.

Comparing all windows would shuffle many times the text. Instead every window is represented
by its anchor, the least hash among its short grams: equal windows have equal anchors at equal
distance. Consecutive windows with one anchor form a unit, a dozen values apart for words and
some eighty for bytes, and only units are shuffled:

1. Units are brought together by anchor and sorted by the hash of their whole stretch. Units
   with equal stretches are copies, settled without their text.
2. Where one anchor has several different stretches, one representative of each is fetched
   from its text and compared exactly, in tasks by anchor (the kernels of the operators).
3. Where one anchor has more different stretches than a task should hold, its windows are
   compared by their own hashes instead, in a plain aggregation.

Copies within one block of text are settled before the shuffle, so a character or line
repeated a million times sends one unit per block.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm import textbuf
from corpuslens.session import materialize

BLOCK_BYTES = 4 * textbuf.GROUP_BYTES

# Different stretches of one anchor that a kernel holds; beyond it windows are aggregated.
MAX_STRETCHES = 4096

U64 = np.uint64


def pack(start, count, lead, flag):
    """Start of a unit, its windows, the distance from its start to the anchor, and a flag."""
    return (start << 24) | (count << 12) | (lead << 1) | flag


def unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return packed >> 24, (packed >> 12) & 0xFFF, (packed >> 1) & 0x7FF, (packed & 1).astype(bool)


@dataclass(frozen=True)
class Windows:
    """``size`` consecutive values make a window, ``gram`` a gram; values are words or bytes."""

    size: int
    gram: int
    words: bool

    def values(self, data, offsets) -> tuple[np.ndarray, np.ndarray]:
        """Values of several texts, and the number of the first value of each."""
        if self.words:
            start, end, first = textbuf.word_spans(data, offsets)
            return textbuf.word_hashes(data, start, end, lower=False), first
        low = int(offsets[0])
        return textbuf.BYTE_VALUES[data[low : int(offsets[-1])]], offsets - low

    def stretch(self, data, low: int, high: int) -> Callable[[int, int], bytes]:
        """Bytes of values ``start`` to ``end`` of the text at ``low`` to ``high``."""
        if not self.words:
            return lambda start, end: data[low + start : low + end].tobytes()
        begins, ends, _ = textbuf.word_spans(data, np.array([low, high]))
        return lambda start, end: data[begins[start] : ends[end - 1]].tobytes()


def units_of(values: np.ndarray, first: np.ndarray, windows: Windows):
    """Units of several texts: start and number of windows, anchor, hashes of anchor and stretch.

    Windows cross no text. ``first`` holds the number of the first value of every text, and
    of the one behind the last.
    """
    size, width = windows.size, windows.size - windows.gram + 1
    if len(values) < size:
        return (np.empty(0, dtype=np.int64),) * 3 + (np.empty(0, dtype=U64),) * 2
    prefix = textbuf.prefix_hashes(values)
    _, down = textbuf.powers(len(prefix))
    k = windows.gram
    grams = textbuf.mix((prefix[k:] - prefix[:-k]) * down[: len(values) - k + 1])
    anchor = textbuf.anchors(grams, width)
    inside = np.zeros(len(anchor) + 1, dtype=np.int32)
    low, high = first[:-1], np.minimum(first[1:] - size + 1, len(anchor))
    real = high > low
    np.add.at(inside, low[real], 1)
    np.add.at(inside, high[real], -1)
    inside = np.cumsum(inside[:-1]) > 0
    border = np.ones(len(anchor), dtype=bool)
    border[1:] = anchor[1:] != anchor[:-1]
    border[low[real]] = True
    border[1:] |= inside[1:] & ~inside[:-1]
    starts = np.flatnonzero(border & inside)
    ends = np.flatnonzero(np.concatenate([border[1:] | ~inside[1:], [True]]) & inside) + 1
    count, at = ends - starts, anchor[starts]
    # the stretch, and where its anchor stands in it
    stretch = textbuf.range_hash(prefix, starts, ends + size - 1)
    stretch = textbuf.mix(stretch + (at - starts).astype(U64) * U64(0xA24BAED4963EE407))
    return starts, count, at, grams[at], stretch


def repeats_before(*columns: np.ndarray) -> np.ndarray:
    """Whether a row equals the one before it in all ``columns``."""
    out = np.zeros(len(columns[0]), dtype=bool)
    out[1:] = np.logical_and.reduce([c[1:] == c[:-1] for c in columns])
    return out


def find_units(
    docs: DataFrame, key: str, text: str, windows: Windows, all_copies: bool
) -> DataFrame:
    """Units of all texts, copies within a block settled: flag 1 means a copy is known.

    A settled unit needs no company, so its anchor is replaced by a hash of its place. Unless
    ``all_copies``, a place of a document counts once, however often its row is repeated.
    """

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = textbuf.column_bytes(batch.column(1))
            for a, b in textbuf.groups(offsets, BLOCK_BYTES):
                values, first = windows.values(data, offsets[a : b + 1])
                start, count, at, anchor, stretch = units_of(values, first, windows)
                if not len(start):
                    continue
                owner = np.searchsorted(first, start, "right") - 1
                doc, place = ids[a + owner], start - first[owner]
                order = np.lexsort((place, doc, stretch, anchor))
                again = repeats_before(*(x[order] for x in (anchor, stretch, doc, place)))
                if not all_copies and again.any():
                    once = np.sort(order[~again])
                    start, count, at, anchor, stretch, doc, place = (
                        x[once] for x in (start, count, at, anchor, stretch, doc, place)
                    )
                    order = np.lexsort((place, doc, stretch, anchor))
                same = np.zeros(len(order), dtype=bool)  # as the one before in this order
                same[1:] = (anchor[order][1:] == anchor[order][:-1]) & (
                    stretch[order][1:] == stretch[order][:-1]
                )
                settled, has_copy = np.zeros(len(order), dtype=bool), np.zeros(len(order), dtype=bool)
                settled[order] = same
                has_copy[order] = same | np.append(same[1:], False)
                anchor = np.where(settled, textbuf.mix(start.astype(U64) ^ anchor), anchor)
                # a settled unit is told by a stretch of 0 with the flag
                stretch = np.where(settled, U64(0), stretch | U64(1))
                packed = pack(place, count, at - start, has_copy.astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor.view(np.int64)),
                        pa.array(stretch.view(np.int64)),
                        pa.array(doc),
                        pa.array(packed),
                    ],
                    names=["anchor", "stretch", "doc", "unit"],
                )

    rows = docs.filter(F.col(key).isNotNull()).select(F.col(key).cast("bigint"), F.col(text))
    return rows.mapInArrow(units, "anchor bigint, stretch bigint, doc bigint, unit bigint")


def settle(all_copies: bool):
    """Goes through units sorted by anchor, stretch, document and place.

    Emits the units that are copies (all of them, or all but the first), and as
    representatives the first of each stretch where an anchor has more than one. Of all but
    the first, a place met again in a repeated row is no copy.
    """

    def rows(kind, anchor, doc, unit):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(doc), kind, np.int32)), pa.array(anchor), pa.array(doc), pa.array(unit)],
            names=["kind", "anchor", "doc", "unit"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last first-of-stretch: anchor, stretch, doc, unit, company before

        def close(state, company_after):
            anchor, _, doc, unit, company = state
            if all_copies and unit & 1:
                yield rows(0, np.array([0]), np.array([doc]), np.array([unit]))
            if company or company_after:
                yield rows(1, np.array([anchor]), np.array([doc]), np.array([unit]))

        for batch in batches:
            anchor, stretch, doc, unit = (c.to_numpy().copy() for c in batch.columns)
            gone = stretch == 0  # settled before
            if gone.any():
                yield rows(0, np.zeros(int(gone.sum()), np.int64), doc[gone], unit[gone])
                anchor, stretch, doc, unit = (x[~gone] for x in (anchor, stretch, doc, unit))
            if not len(anchor):
                continue
            company_first = False
            if held is not None:
                anchor = np.concatenate([[held[0]], anchor])
                stretch = np.concatenate([[held[1]], stretch])
                doc = np.concatenate([[held[2]], doc])
                unit = np.concatenate([[held[3]], unit])
                company_first = held[4]
            if not all_copies:
                again = repeats_before(anchor, stretch, doc, unit >> 1)
                if again.any():
                    anchor, stretch, doc, unit = (x[~again] for x in (anchor, stretch, doc, unit))
            new = np.ones(len(anchor), dtype=bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (stretch[1:] != stretch[:-1])
            copies = ~new
            if copies.any():
                yield rows(0, np.zeros(int(copies.sum()), np.int64), doc[copies], unit[copies])
            first = np.flatnonzero(new)
            followed = np.append(copies[1:], False)
            unit[first] |= followed[first]  # a first with a copy
            a = anchor[first]
            company = np.zeros(len(first), dtype=bool)
            company[0] = company_first
            company[1:] = a[1:] == a[:-1]
            after = np.append(a[1:] == a[:-1], False)
            last = first[-1]
            held = (anchor[last], stretch[last], doc[last], unit[last], bool(company[-1]))
            first, company, after = first[:-1], company[:-1], after[:-1]
            if all_copies:
                out = first[(unit[first] & 1) == 1]
                if len(out):
                    yield rows(0, np.zeros(len(out), np.int64), doc[out], unit[out])
            out = first[company | after]
            if len(out):
                yield rows(1, anchor[out], doc[out], unit[out])
        if held is not None:
            yield from close(held, False)

    return run


def fetch(windows: Windows):
    """Text of the representatives of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textbuf.column_bytes(batch.column(1))
            wanted = batch.column(2)
            at = wanted.offsets.to_numpy()
            anchor = wanted.values.field("anchor").to_numpy()
            unit = wanted.values.field("unit").to_numpy()
            start, count, _, _ = unpack(unit)
            docs = batch.column(0).to_numpy()
            texts, picked = [], []
            held = 0
            for i in range(len(batch)):
                if at[i] == at[i + 1]:
                    continue
                cut = windows.stretch(data, int(offsets[i]), int(offsets[i + 1]))
                for j in range(at[i], at[i + 1]):
                    texts.append(cut(int(start[j]), int(start[j] + count[j] - 1 + windows.size)))
                    held += len(texts[-1])
                    picked.append((i, j))
                if held > BLOCK_BYTES:
                    yield made(texts, picked, docs, anchor, unit)
                    texts, picked, held = [], [], 0
            if texts:
                yield made(texts, picked, docs, anchor, unit)

    def made(texts, picked, docs, anchor, unit):
        i, j = np.array(picked).T
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor[j]), pa.array(docs[i]), pa.array(unit[j]), pa.array(texts, pa.binary())],
            names=["anchor", "doc", "unit", "bytes"],
        )

    return run


def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted representatives without those that a repeated row of their document gave again."""
    last = None
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(i).to_numpy() for i in range(3)]
        again = repeats_before(*columns)
        again[0] = last == tuple(c[0] for c in columns)
        last = tuple(c[-1] for c in columns)
        yield batch.filter(pa.array(~again)) if again.any() else batch


def window_hashes(windows: Windows, texts: pa.Array, unit: np.ndarray):
    """Values of all stretches, prefix hashes, the first value of each, and its windows."""
    data, offsets = textbuf.column_bytes(texts)
    values, first = windows.values(data, offsets)
    _, count, _, _ = unpack(unit)
    return values, textbuf.prefix_hashes(values), first, count


def compare(windows: Windows, kernel):
    """Feeds whole groups of one anchor to the kernel, or emits their windows if too many.

    ``kernel(group, unit, doc, texts)`` returns, for every window of every stretch in order,
    whether it has a (first) copy elsewhere in its group.
    """

    def spans(doc, unit, marks):
        """Runs of marked windows as units."""
        start, count, _, _ = unpack(unit)
        owner = np.repeat(np.arange(len(unit)), count)
        place = textbuf.ranges(start, count)
        run = np.ones(len(marks), dtype=bool)
        run[1:] = ~marks[:-1] | (owner[1:] != owner[:-1])
        begins = np.flatnonzero(run & marks)
        stop = np.ones(len(marks), dtype=bool)
        stop[:-1] = ~marks[1:] | (owner[1:] != owner[:-1])
        ends = np.flatnonzero(stop & marks)
        return out(0, 0, 0, doc[owner[begins]], pack(place[begins], ends - begins + 1, 0, 0))

    def out(kind, anchor, window, doc, unit):
        full = lambda v, t: v if isinstance(v, np.ndarray) else np.full(len(doc), v, t)
        columns = [full(kind, np.int32), full(anchor, np.int64), full(window, np.int64), doc, unit]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], names=["kind", "anchor", "window", "doc", "unit"]
        )

    def single(batch):
        """Every window on its own, for an aggregation."""
        anchor, doc, unit = (batch.column(i).to_numpy() for i in range(3))
        values, prefix, first, count = window_hashes(windows, batch.column(3), unit)
        at = textbuf.ranges(first[:-1], count)
        owner = np.repeat(np.arange(len(unit)), count)
        window = textbuf.mix(textbuf.range_hash(prefix, at, at + windows.size))
        start = textbuf.ranges(unpack(unit)[0], count)
        # the distance to the anchor is part of what is equal
        lead = unpack(unit)[2][owner] - (start - unpack(unit)[0][owner])
        window = textbuf.mix(window + lead.astype(U64))
        flag = (unit & 1)[owner]
        return out(2, anchor[owner], window.view(np.int64), doc[owner], pack(start, 1, 0, flag))

    def solve(batch):
        anchor, doc, unit = (batch.column(i).to_numpy() for i in range(3))
        group = np.cumsum(np.concatenate([[0], anchor[1:] != anchor[:-1]]))
        marks = kernel(group, unit, doc, batch.column(3))
        return spans(doc, unit, marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, crowded = [], None  # batches of the group that is still open; its anchor if too large

        def parts(table):
            for b in table.combine_chunks().to_batches(max_chunksize=MAX_STRETCHES):
                yield b

        def close(table):
            """Whole groups, in portions of about MAX_STRETCHES stretches."""
            anchor = table.column(0).to_numpy()
            border = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, [len(anchor)]])
            low = 0
            while low < len(border) - 1:
                high = int(np.searchsorted(border, border[low] + MAX_STRETCHES, "right")) - 1
                if high <= low:  # one group alone is too large
                    for b in parts(table.slice(border[low], border[low + 1] - border[low])):
                        yield single(b)
                    low += 1
                    continue
                piece = table.slice(border[low], border[high] - border[low]).combine_chunks()
                yield solve(piece.to_batches()[0])
                low = high

        for batch in batches:
            if not len(batch):
                continue
            anchor = batch.column(0).to_numpy()
            if crowded is not None:
                n = int(np.searchsorted(anchor != crowded, True)) if (anchor != crowded).any() else len(anchor)
                n = len(anchor) if not (anchor != crowded).any() else int(np.argmax(anchor != crowded))
                for b in parts(pa.Table.from_batches([batch.slice(0, n)])) if n else ():
                    yield single(b)
                if n == len(anchor):
                    continue
                batch, crowded = batch.slice(n), None
            table = pa.Table.from_batches([*held, batch]).combine_chunks()
            anchor = table.column(0).to_numpy()
            open_from = int(np.argmax(anchor == anchor[-1]))
            if open_from:
                yield from close(table.slice(0, open_from))
            rest = table.slice(open_from)
            held = rest.combine_chunks().to_batches()
            if len(rest) > MAX_STRETCHES:
                crowded, held = int(anchor[-1]), []
                for b in parts(rest):
                    yield single(b)
        if held:
            yield from close(pa.Table.from_batches(held).combine_chunks())

    return run


def repeated_spans(
    docs: DataFrame, key: str, text: str, windows: Windows, kernel, all_copies: bool
) -> DataFrame:
    """``doc`` and ``spans`` (start and number of windows) of all repeated windows.

    ``all_copies``: every occurrence counts, those in repeated rows too; else all but the
    first by document and place, where repeated rows of a document are one occurrence.
    """
    units = find_units(docs, key, text, windows, all_copies)
    settled = units.repartition("anchor").sortWithinPartitions("anchor", "stretch", "doc", "unit")
    settled = materialize(
        settled.mapInArrow(settle(all_copies), "kind int, anchor bigint, doc bigint, unit bigint")
    )
    wanted = settled.filter("kind = 1").groupBy("doc").agg(F.collect_list(F.struct("anchor", "unit")).alias("units"))
    rows = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("text"))
    stretches = rows.join(wanted, "doc").select("doc", "text", "units")
    stretches = stretches.mapInArrow(fetch(windows), "anchor bigint, doc bigint, unit bigint, bytes binary")
    compared = stretches.repartition("anchor").sortWithinPartitions("anchor", "doc", "unit")
    solve = compare(windows, kernel)
    compared = materialize(
        compared.mapInArrow(
            solve if all_copies else lambda batches: solve(once(batches)),
            "kind int, anchor bigint, window bigint, doc bigint, unit bigint",
        )
    )
    crowded = compared.filter("kind = 2").drop("kind")
    classes = crowded.groupBy("anchor", "window").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "unit")).alias("first")
    )
    classes = classes.filter("n > 1")
    repeats = crowded.join(classes, ["anchor", "window"])
    if not all_copies:
        repeats = repeats.filter(F.struct("doc", "unit") != F.col("first"))
    spans = (
        settled.filter("kind = 0").select("doc", "unit")
        .unionByName(compared.filter("kind = 0").select("doc", "unit"))
        .unionByName(repeats.select("doc", "unit"))
    )
    return spans.groupBy("doc").agg(F.collect_list("unit").alias("spans"))


def covered(spans: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint ranges of values covered by windows, from packed units; adjacent ones joined."""
    start, count, _, _ = unpack(np.sort(spans))
    end = np.maximum.accumulate(start + count - 1 + size)
    fresh = np.ones(len(start), dtype=bool)
    fresh[1:] = start[1:] > end[:-1]
    low = start[fresh]
    return low, np.append(end[:-1][fresh[1:]], end[-1])
