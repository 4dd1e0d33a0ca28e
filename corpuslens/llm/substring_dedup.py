"""Removal of repeated word passages by relative Lempel-Ziv parsing."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.llm import passages, textbuf

LENGTH, GRAM = 20, 6


class Reference:
    """Index of the stretches of a block: the earliest place of every window."""

    def __init__(self, prefix, place, group, size):
        hashes = textbuf.mix(textbuf.range_hash(prefix, place, place + size))
        # stretches come by document and start, so the first of equals is the earliest
        order = np.lexsort((np.arange(len(place)), hashes, group))
        h, g = hashes[order], group[order]
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        leader = order[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        self.earliest = np.empty(len(place), dtype=np.int64)
        self.earliest[order] = leader


def factor(values, prefix, first, count, group, size) -> np.ndarray:
    """Parse every stretch against the indexed stretches before it; marks repeated windows.

    At the left end of what is not parsed yet, the window there is looked up. If it stands in
    an earlier stretch, the factor is the longest common extension from there; all windows
    inside it are repeats. Parsing goes on with the first window that reaches over the end of
    the factor, so that a repeat across two factors is not missed; without a match it goes on
    one word further. All stretches are parsed at once.
    """
    place = textbuf.ranges(first[:-1], count)
    owner = np.repeat(np.arange(len(count)), count)
    marks = np.zeros(len(place) + 1, dtype=np.int64)
    index = Reference(prefix, place, group[owner], size)
    window_of = np.cumsum(count) - count  # first window of every stretch
    at = np.zeros(len(count), dtype=np.int64)
    while True:
        busy = np.flatnonzero(at < count)
        if not len(busy):
            break
        w = window_of[busy] + at[busy]
        source = index.earliest[w]
        hit = source != w
        at[busy[~hit]] += 1
        busy, w, source = busy[hit], w[hit], source[hit]
        if not len(busy):
            continue
        here, there = place[w], place[source]
        room = np.minimum(first[busy + 1] - here, first[owner[source] + 1] - there)
        length = extension(prefix, here, there, size, room)
        # verification, word by word
        step = np.arange(size)
        good = (values[here[:, None] + step] == values[there[:, None] + step]).all(axis=1)
        inside = np.where(good, length - size + 1, 0)
        inside = np.minimum(inside, count[busy] - at[busy])
        np.add.at(marks, w[good], 1)
        np.add.at(marks, w[good] + inside[good], -1)
        at[busy] += np.maximum(inside, 1)
    return np.cumsum(marks[:-1]) > 0


def extension(prefix, here, there, size, room) -> np.ndarray:
    """Common length from both places, known to be ``size`` at least, up to ``room``."""
    low, high = np.full(len(here), size), room
    while (low < high).any():
        middle = (low + high + 1) >> 1
        same = textbuf.range_hash(prefix, here, here + middle) == textbuf.range_hash(
            prefix, there, there + middle
        )
        low = np.where(same, middle, low)
        high = np.where(same, high, middle - 1)
    return low


def kernel(windows: passages.Windows):
    def repeats(group, unit, doc, texts) -> np.ndarray:
        values, prefix, first, count = passages.window_hashes(windows, texts, unit)
        return factor(values, prefix, first, count, group, windows.size)

    return repeats


def repeated_words(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH
) -> DataFrame:
    """Packed spans of words that repeat an earlier passage, see ``passages``."""
    if not 2 * GRAM <= length < 1024:
        raise ValueError(f"length must be from {2 * GRAM} to 1023")
    windows = passages.Windows(length, GRAM, words=True)
    return passages.repeated_spans(docs, key, text, windows, kernel(windows), all_copies=False)


def remove_repeated_words(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
    carry: list[str] | None = None, as_is: bool = False,
) -> DataFrame:
    """Remove every word of a passage of ``length`` words that also starts earlier.

    Words are runs without ASCII white space, unchanged. Earlier means a smaller ``key``, or
    the same document and an earlier word; passages are judged on the input. Returns ``key``,
    ``n_words``, ``n_removed`` and ``kept``, the remaining words joined by single spaces.

    ``key`` is an integer that identifies a document. A null text has no words. Rows with a
    null key are compared with nothing and keep all their words. Repeated rows with one key
    are one document, no copies of each other: the passages that one loses, all lose. An
    empty table gives no rows. Other columns are ignored, but for those in ``carry``, which come
    back with their row; ``as_is`` leaves texts that lose nothing unchanged, nulls too.
    """
    spans = repeated_words(docs, key, text, length)
    own = [f"_carried{i}" for i in range(len(carry or []))]
    more = [F.col(c).alias(name) for c, name in zip(carry or [], own)]
    rows = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("text"), *more)
    rows = rows.join(spans, "doc", "left").select("doc", "text", "spans", *own)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textbuf.column_bytes(batch.column(1))
            at = batch.column(2).offsets.to_numpy()
            packed = batch.column(2).values.to_numpy()
            words, gone, kept = [], [], []
            texts = batch.column(1)
            for i in range(len(batch)):
                all_words = data[int(offsets[i]) : int(offsets[i + 1])].tobytes().split()
                n = len(all_words)
                if at[i + 1] > at[i]:
                    start, end = passages.covered(packed[at[i] : at[i + 1]], length)
                    rest, last = [], 0
                    for s, e in zip(start.tolist(), end.tolist()):
                        rest += all_words[last:s]
                        last = e
                    all_words = rest + all_words[last:]
                words.append(n)
                gone.append(n - len(all_words))
                same = as_is and n == len(all_words)
                kept.append(texts[i].as_py() if same else b" ".join(all_words).decode())
            columns = [pa.array(words, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())]
            columns = [batch.column(0), *columns, *batch.columns[3:]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "n_words", "n_removed", "kept", *own])

    made = T.StructType.fromDDL("doc bigint, n_words bigint, n_removed bigint, kept string")
    out = rows.mapInArrow(cut, T.StructType(made.fields + rows.schema.fields[3:]))
    return out.withColumnsRenamed({"doc": key, **dict(zip(own, carry or []))})
