"""Stretches of words that repeat with one period, found in tiles of the size of the period."""

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm import textbuf
from corpuslens.session import materialize

SCREENED = 1 << 20  # comparisons at once
PIECE = 4 << 20  # bytes of a text that are split into words at once
TILES_OUT = 4 << 20  # bytes of tiles in one batch

DOCUMENT, TILE = 0, 1
PARTS = (
    "kind int, row bigint, doc bigint, n bigint, whole string, text binary, octave int, at bigint, lead int, "
    "words binary"
)
NAMES = [c.split()[0] for c in PARTS.split(", ")]
TYPES = {"kind": pa.int32(), "whole": pa.string(), "text": pa.binary(), "octave": pa.int32(), "lead": pa.int32(),
         "words": pa.binary()}


def needed(period: int, min_length: int) -> int:
    """Words that agree with the one a period later, in a run of at least ``min_length`` words."""
    return max(period, min_length - period)


def distance(octave: int, min_length: int) -> tuple[int, int]:
    """Distance of boundaries, and length of the blocks that are compared, half of it.

    So many words as the distance agree in each run of the octave at least; any so many hold a
    boundary and a whole block that begins at a multiple of its length.
    """
    first = 1 << octave
    least = min(needed(q, min_length) for q in range(first, min(2 * first, first + min_length)))
    return (2 * (least // 2), least // 2) if least > 1 else (1, 1)


def word_numbers(raw: bytes, known: dict[bytes, int]) -> np.ndarray:
    """Numbers of the words of a text; equal words have one number. A piece at a time."""
    out, rest, at = [], b"", 0
    number = known.setdefault
    while at < len(raw) or rest:
        piece = rest + raw[at : at + PIECE]
        at += PIECE
        words, rest = piece.split(), b""
        if at < len(raw) and words and not piece[-1:].isspace():
            rest = words.pop()  # perhaps it goes on
        out.append(np.array([number(w, len(known)) for w in words], dtype=np.int64))
    return np.concatenate(out) if out else np.empty(0, dtype=np.int64)


def candidates(values: np.ndarray, first: np.ndarray, octave: int, min_length: int):
    """Tiles (document, boundary) that may lie in a run with a period of the octave.

    A run has a block, at a multiple of half the distance of boundaries, that stands again a
    period later. Blocks are compared by hash with all windows an octave away; equal words have
    equal hashes, so none is missed, and what is given in vain is found out by the Z-function.
    A tile that as a whole has a period of at most the distance of boundaries is left out: a
    run through its boundary that has no shorter period would overlap that one by more than
    both periods together.
    """
    low, (step, half) = 1 << octave, distance(octave, min_length)
    n = np.diff(first)
    long = np.flatnonzero((n >= 2 * low) & (n >= min_length))
    if not len(long):
        return
    grams = textbuf.gram_hashes(values, half)
    count = np.maximum(n[long] - half - low, -1) // half + 1
    block = textbuf.ranges(np.zeros(len(long), dtype=np.int64), count) * half
    doc = np.repeat(long, count)
    start = first[doc] + block
    grams = np.concatenate([grams, np.zeros(2 * low + half, dtype=np.uint64)])
    windows = np.lib.stride_tricks.sliding_window_view(grams, low)
    at_once = max(1, SCREENED // low)
    gaps: dict[tuple[int, int], int] = {}
    for a in range(0, len(start), at_once):
        x = start[a : a + at_once]
        same = windows[x + low] == grams[x][:, None]
        for i in np.flatnonzero(same.any(axis=1)).tolist():
            d = int(doc[a + i])
            hits = np.flatnonzero(same[i])
            hits = hits[x[i] + low + hits + half <= first[d + 1]]
            if not len(hits):
                continue
            b = -(-int(block[a + i]) // step) * step
            gap = int(np.diff(hits).min()) if len(hits) > 1 else 0
            gaps[d, b] = gaps.get((d, b), 0) or gap
    for (d, b), gap in gaps.items():
        lo, hi = tile_of(int(first[d]), int(first[d + 1]), b, low, step)
        whole = 0 < gap <= min(step, low)
        if not (whole and np.array_equal(values[lo : hi - gap], values[lo + gap : hi])):
            yield d, b, lo, hi


def tile_of(start: int, end: int, boundary: int, low: int, step: int) -> tuple[int, int]:
    at = start + boundary
    return max(start, at - step), min(end, at + 2 * low + step)


def tile_rows(
    batches: Iterator[pa.RecordBatch], min_length: int, planted: Callable | None, digest: bool
) -> Iterator[pa.RecordBatch]:
    """Rows (row, doc, text) to one row per document and one per tile to be solved. A document
    without tiles is finished: all its words stay."""

    def made(columns):
        arrays = [pa.array(columns[name], TYPES.get(name, pa.int64())) for name in NAMES]
        return pa.RecordBatch.from_arrays(arrays, names=NAMES)

    for batch in batches:
        data, offsets = textbuf.column_bytes(batch.column(2))
        rows, docs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for a, b in textbuf.groups(offsets):
            known: dict[bytes, int] = {}
            parts = []
            for i in range(a, b):
                numbers = word_numbers(data[offsets[i] : offsets[i + 1]].tobytes(), known)
                repeat = planted(docs[i], len(numbers)) if planted and len(numbers) else None
                if repeat:
                    at, period = repeat
                    numbers[at:] = numbers[at + np.arange(len(numbers) - at) % period]
                parts.append(numbers)
            numbers, names = np.concatenate(parts), list(known)
            first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            values = textbuf.mix(numbers.astype(np.uint64) + np.uint64(1))
            out, size = {name: [] for name in NAMES}, 0
            tiled = set()
            octave = 0
            while 2 << octave <= max(map(len, parts)):
                for d, at, lo, hi in candidates(values, first, octave, min_length):
                    tiled.add(d)
                    words = numbers[lo:hi].astype("<i4").tobytes()
                    tile = (TILE, rows[a + d], None, None, None, None, octave, at, first[d] + at - lo, words)
                    for name, value in zip(NAMES, tile):
                        out[name].append(value)
                    size += len(words)
                    if size > TILES_OUT:
                        yield made(out)
                        out, size = {name: [] for name in NAMES}, 0
                octave += 1
            yield made(out)
            out = {name: [] for name in NAMES}
            for d, part in enumerate(parts):
                text = b" ".join([names[w] for w in part.tolist()])
                whole = hashlib.sha256(text).hexdigest() if digest else text.decode()
                done = d not in tiled
                document = (DOCUMENT, rows[a + d], docs[a + d], len(part), whole if done else None,
                            None if done else text, None, None, None, None)
                for name, value in zip(NAMES, document):
                    out[name].append(value)
            yield made(out)


def z_function(s: list[int]) -> list[int]:
    """How many words of ``s`` from each place on agree with its beginning."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            j = right
        elif s[i] != s[0]:
            continue
        else:
            j = i + 1
        while j < n and s[j] == s[j - i]:
            j += 1
        z[i], left, right = j - i, i, j
    return z


def prime_divisors(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] if n > 1 else out


def fragments_of(words: list[int], lead: int, low: int, step: int, min_length: int):
    """(period, left, right): words around the boundary at ``lead`` that agree with the ones a
    period later, in so far as they may belong to a run; ``step`` at most to either side.

    The Z-function of what follows the boundary gives the right sides of all periods, that of
    what precedes it, both reversed, the left ones. A period whose stretch has a shorter one is
    left out; every boundary within a run sees this alike.
    """
    ahead = words[lead:]
    most = min(2 * low - 1, len(ahead))
    if most < low:
        return
    right = z_function(ahead) + [0]
    behind = words[:lead][::-1]
    left = z_function(behind + [-1] + words[low : lead + most][::-1]) + [0]
    for period in range(low, most + 1):
        r, l = min(right[period], step), min(left[lead + 1 + most - period], lead)
        if r < step and l < step and r + l < needed(period, min_length):
            continue
        if not any(right[period // p] >= period - period // p for p in prime_divisors(period)):
            yield period, l, r


def solve(batches: Iterator[pa.RecordBatch], min_length: int) -> Iterator[pa.RecordBatch]:
    """Tiles (row, octave, at, lead, words) to fragments (row, period, start, end)."""
    for batch in batches:
        out = [[], [], [], []]
        columns = (batch.column(i).to_pylist() for i in range(4))
        for row, octave, at, lead, words in zip(*columns, batch.column(4)):
            words = np.frombuffer(words.as_buffer(), dtype="<i4").tolist()
            step, _ = distance(octave, min_length)
            for period, l, r in fragments_of(words, lead, 1 << octave, step, min_length):
                for column, value in zip(out, (row, period, at - l, at + r)):
                    column.append(value)
        arrays = [pa.array(c, pa.int64()) for c in out]
        yield pa.RecordBatch.from_arrays(arrays, names=["row", "period", "start", "end"])


def stitch(batches: Iterator[pa.RecordBatch], min_length: int) -> Iterator[pa.RecordBatch]:
    """Sorted fragments to runs (row, start, length, period): fragments of one document and
    period that touch are one. Only the last run of a batch is held back."""
    held = None

    def made(row, period, start, end):
        length = end - start
        long = length >= np.maximum(period, min_length - period)
        columns = [row[long], start[long], (length + period)[long], period[long]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row", "start", "length", "period"])

    for batch in batches:
        if not len(batch):
            continue
        rows = [c.to_numpy() for c in batch.columns]
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows)]
        row, period, start, end = rows
        # in this order the ends of what belongs together grow as well
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (period[1:] != period[:-1]) | (start[1:] > end[:-1])
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(row)) - 1
        held = [x[at[-1] : at[-1] + 1] for x in (row, period, start)] + [end[-1:]]
        yield made(row[at[:-1]], period[at[:-1]], start[at[:-1]], end[last[:-1]])
    if held is not None:
        yield made(*held)


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _collapse(batches: Iterator[pa.RecordBatch], digest: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for raw, runs in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            words = raw.split(b" ") if raw else []
            stay = np.ones(len(words), dtype=bool)
            for run in runs:
                stay[run["start"] + run["period"] : run["start"] + run["length"]] = False
            text = b" ".join([words[i] for i in np.flatnonzero(stay).tolist()])
            texts.append(hashlib.sha256(text).hexdigest() if digest else text.decode())
        columns = [batch.column(0), batch.column(1), batch.column(3), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc", "n", "runs", "collapsed"])


def periodic_runs(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_length: int = 12,
    planted: Callable[[int | None, int], tuple[int, int] | None] | None = None,
    digest: bool = False,
) -> DataFrame:
    """Runs of every document, and its text without their repetitions.

    A run is a stretch of consecutive words (runs of bytes without ASCII white space) with a
    smallest period ``q`` and a length of at least ``min_length`` and ``2 * q`` that cannot be
    extended to either side with that period. Returns ``key``, ``n_words``, ``runs``, sorted by
    start and period, and ``collapsed``: the words that no run contains after its first ``q``,
    joined by spaces, or the SHA-256 of that with ``digest``, which spares storing texts
    without candidates.

    Periods are dealt with by octaves. For each octave a document has a boundary every so many
    words as its periods are long at least, and a tile around each boundary that reaches two
    octaves ahead. Words of a run that agree with the one a period later make an interval that
    holds a boundary at least, so Z-functions from the boundaries of single tiles find its parts,
    and parts of one document and period are put together where they touch. Tiles are made in
    the task that has the text, where blocks of words that do not stand again an octave later are
    left out by hash; the others are dealt over all tasks. Tiles, and thus time and shuffle, are
    proportional to the words of runs; screening takes n log n comparisons in a text of n words.

    A null text has no words. Every row is a document of its own, also with a null or repeated
    key; an empty table gives no rows. A text is held by one task, about 50 bytes a word.
    ``planted(key, n)`` may say ``(a, p)`` for a text of n words: from word a on, its first p
    words from there are repeated instead of what stands there. Other columns are not read.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("bigint").alias("doc"), F.col(text).alias("text")
    )
    # row numbers are only good within this table
    parts = materialize(rows.mapInArrow(lambda batches: tile_rows(batches, min_length, planted, digest), PARTS))
    tiles = parts.filter(F.col("kind") == TILE).select("row", "octave", "at", "lead", "words")
    tiles = tiles.repartition("row", "octave", "at")
    fragments = tiles.mapInArrow(lambda batches: solve(batches, min_length), "row bigint, period bigint, start bigint, end bigint")
    fragments = fragments.repartition("row", "period").sortWithinPartitions("row", "period", "start", "end")
    runs = fragments.mapInArrow(
        lambda batches: stitch(batches, min_length), "row bigint, start bigint, length bigint, period bigint"
    )
    runs = runs.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs")
    )
    runs = runs.select("row", F.transform("runs", lambda r: F.struct(r["start"], r["length"], r["period"])).cast(RUNS).alias("runs"))

    all_docs = parts.filter(F.col("kind") == DOCUMENT)
    none = F.array().cast(RUNS)
    quiet = all_docs.filter("text is null").select("doc", "n", none.alias("runs"), F.col("whole").alias("collapsed"))
    open_ = all_docs.filter("text is not null").join(runs, "row", "left")
    open_ = open_.select("doc", "n", "text", F.coalesce("runs", none).alias("runs"))
    out = quiet.unionByName(
        open_.mapInArrow(lambda batches: _collapse(batches, digest), f"doc bigint, n bigint, runs {RUNS}, collapsed string")
    )
    return out.withColumnsRenamed({"doc": key, "n": "n_words"})
