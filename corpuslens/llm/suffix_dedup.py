"""Removal of repeated byte strings by sorting suffixes, compared through prefix hashes."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm import passages, textbuf

LENGTH, GRAM = 200, 48


def common_extension(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common start of suffixes ``a`` and ``b``, up to ``limit``: binary search
    over the hashes of their prefixes. Suffixes have ``limit`` values at least."""
    low, high = np.zeros(len(a), dtype=np.int64), np.full(len(a), limit)
    for _ in range(int(limit).bit_length()):
        middle = (low + high + 1) >> 1
        same = textbuf.range_hash(prefix, a, a + middle) == textbuf.range_hash(prefix, b, b + middle)
        low = np.where(same, middle, low)
        high = np.where(same, high, middle - 1)
    return low


def precedes(data, prefix, a, b, limit, or_equal) -> np.ndarray:
    """Whether suffix ``a`` stands before ``b``, judged on the first ``limit`` bytes."""
    common = common_extension(prefix, a, b, limit)
    inner = np.minimum(common, limit - 1)
    smaller = data[a + inner] < data[b + inner]
    return np.where(common >= limit, or_equal, smaller)


def sort_suffixes(data, prefix, suffix, bucket, limit) -> np.ndarray:
    """Order of ``suffix`` within each ``bucket`` by the first ``limit`` bytes: merge sort.

    Runs of one, two, four, ... suffixes are merged in all buckets at once. The place of a
    suffix in a merged run is its place in its own run plus its rank in the other, which a
    binary search with hash comparisons finds.
    """
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    first = np.searchsorted(b, b)  # where the bucket begins
    size = np.searchsorted(b, b, "right") - first
    inside = np.arange(len(order)) - first
    run = 1
    while len(size) and run < size.max():
        busy = size > run
        busy_at = np.flatnonzero(busy)
        place, begin, n = inside[busy_at], first[busy_at], size[busy_at]
        own = place // run
        pair = begin + (own & ~1) * run
        right = (own & 1) == 1
        other = np.where(right, pair, pair + run)
        other_size = np.clip(begin + n - other, 0, run)
        low, high = np.zeros(len(place), dtype=np.int64), other_size.copy()
        mine = suffix[order[busy_at]]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) >> 1
            theirs = suffix[order[other[open_] + middle]]
            # equals of the left run go first
            before = precedes(data, prefix, theirs, mine[open_], limit, right[open_])
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)
        target = pair + place % run + low
        merged = order.copy()
        merged[target] = order[busy_at]
        order = merged
        run *= 2
    return order


def repeated_suffixes(data, prefix, suffix, bucket, limit) -> np.ndarray:
    """Which suffixes share their first ``limit`` bytes with another one of their bucket."""
    out = np.zeros(len(suffix), dtype=bool)
    if len(suffix) < 2:
        return out
    order = sort_suffixes(data, prefix, suffix, bucket, limit)
    s, b = suffix[order], bucket[order]
    equal = b[1:] == b[:-1]
    at = np.flatnonzero(equal)
    same = textbuf.range_hash(prefix, s[at], s[at] + limit) == textbuf.range_hash(
        prefix, s[at + 1], s[at + 1] + limit
    )
    at = at[same]
    # verification: equal hashes must mean equal bytes
    step = np.arange(limit)
    for i in range(0, len(at), 4096):
        part = at[i : i + 4096]
        wrong = (data[s[part][:, None] + step] != data[s[part + 1][:, None] + step]).any(axis=1)
        if wrong.any():  # a collision: compare that bucket by its bytes alone
            for bad in np.unique(b[part[wrong]]):
                members = np.flatnonzero(bucket == bad)
                texts = [data[suffix[m] : suffix[m] + limit].tobytes() for m in members]
                for m, t in zip(members, texts):
                    out[m] = texts.count(t) > 1
            part = part[~np.isin(b[part], b[part[wrong]])]
        out[order[part]] = True
        out[order[part + 1]] = True
    return out


def kernel(windows: passages.Windows):
    def repeats(group, unit, doc, texts) -> np.ndarray:
        data, offsets = textbuf.column_bytes(texts)
        low = int(offsets[0])
        data = data[low : int(offsets[-1])]
        _, prefix, first, count = passages.window_hashes(windows, texts, unit)
        suffix = textbuf.ranges(first[:-1], count)
        owner = np.repeat(np.arange(len(unit)), count)
        lead = passages.unpack(unit)[2][owner] - (suffix - first[:-1][owner])
        # equal strings have their anchor at the same distance: only those are compared
        bucket = group[owner] * 4096 + lead
        return repeated_suffixes(data, prefix, suffix, bucket, windows.size)

    return repeats


def repeated_bytes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH
) -> DataFrame:
    """Packed spans of every document that repeat elsewhere, see ``passages``."""
    if not 2 * GRAM <= length < 1024:
        raise ValueError(f"length must be from {2 * GRAM} to 1023")
    windows = passages.Windows(length, GRAM, words=False)
    return passages.repeated_spans(docs, key, text, windows, kernel(windows), all_copies=True)


def remove_repeated_bytes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH
) -> DataFrame:
    """Remove every byte covered by a string of ``length`` bytes that also starts elsewhere.

    Texts are taken as UTF-8 bytes. Strings are judged on the input and cross no document;
    overlapping occurrences count. Returns ``key``, ``n_bytes``, ``n_removed``, ``n_spans``
    (maximal removed runs), ``removed`` (start and end of each, in bytes) and ``kept`` (the
    remaining bytes, which need not be valid UTF-8).

    ``key`` is an integer that identifies a document. A null text counts as empty. Rows with
    a null key are compared with nothing and returned whole. Repeated rows are copies of each
    other and lose what they share; an empty table gives no rows. Other columns are ignored.
    """
    spans = repeated_bytes(docs, key, text, length)
    rows = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("text"))
    rows = rows.join(spans, "doc", "left").select("doc", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textbuf.column_bytes(batch.column(1))
            at = batch.column(2).offsets.to_numpy()
            packed = batch.column(2).values.to_numpy()
            sizes, gone, runs, kept, removed = [], [], [], [], []
            for i in range(len(batch)):
                low, high = int(offsets[i]), int(offsets[i + 1])
                raw = data[low:high].tobytes()
                ranges = []
                if at[i + 1] > at[i]:
                    start, end = passages.covered(packed[at[i] : at[i + 1]], length)
                    ranges = list(zip(start.tolist(), end.tolist()))
                parts, last = [], 0
                for s, e in ranges:
                    parts.append(raw[last:s])
                    last = e
                parts.append(raw[last:])
                rest = b"".join(parts)
                sizes.append(len(raw))
                gone.append(len(raw) - len(rest))
                runs.append(len(ranges))
                kept.append(rest)
                removed.append([{"start": s, "end": e} for s, e in ranges])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array(runs, pa.int64()),
                    pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(kept, pa.binary()),
                ],
                names=["doc", "n_bytes", "n_removed", "n_spans", "removed", "kept"],
            )

    out = rows.mapInArrow(
        cut,
        "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
        "removed array<struct<start:bigint,end:bigint>>, kept binary",
    )
    return out.withColumnRenamed("doc", key)
