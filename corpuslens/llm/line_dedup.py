"""Lines that many documents share, found by one global sort of line hashes."""

import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm import textbuf
from corpuslens.session import materialize

SPACE = b" \t\n\v\f\r"

# Rows of one undecided line that a task holds back; more are left to the second step.
MOST_HELD = 10_000

LINES = "doc bigint, version bigint, n_lines bigint, h1 bigint, h2 bigint, pos int, more binary"
DECIDED, PENDING, COMMON = 0, 1, 2
STREAM = "h1 bigint, h2 bigint, doc bigint, version bigint, pos int, more binary, state int"
ORDER = ["h1", "h2", "doc", "version", "pos"]


def line_rows(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """Rows (doc, version, text) to one row per document with its number of lines, and one per
    document and different line: a 128-bit hash of its key, its first place, and the further
    places as packed integers."""
    for batch in batches:
        data, offsets = textbuf.column_bytes(batch.column(2))
        versions = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        seen, fresh = set(), []
        for i, version in enumerate(versions):  # repeated rows are sent once
            if version not in seen:
                seen.add(version)
                fresh.append(i)
        owner, n_lines, digests, first, more = [], [], [], [], []
        size = 0
        for i in fresh:
            raw = data[offsets[i] : offsets[i + 1]].tobytes()
            places: dict[bytes, list[int]] = {}
            lines = raw.lower().split(b"\n")  # of bytes only A-Z are changed
            for at, line in enumerate(lines):
                key = line.strip(SPACE)
                if key and (min_chars <= 1 or len(key.decode(errors="replace")) >= min_chars):
                    places.setdefault(key, []).append(at)
            owner += [i] * (len(places) + 1)
            n_lines.append(len(lines))
            digests.append(bytes(16))
            first.append(-1)
            more.append(None)
            for key, where in places.items():
                n_lines.append(None)
                digests.append(blake2b(key, digest_size=16).digest())
                first.append(where[0])
                more.append(np.array(where[1:], dtype="<i4").tobytes() if len(where) > 1 else None)
            size += len(raw)
            if size > textbuf.GROUP_BYTES:
                yield _line_batch(batch, owner, n_lines, digests, first, more)
                owner, n_lines, digests, first, more, size = [], [], [], [], [], 0
        yield _line_batch(batch, owner, n_lines, digests, first, more)


def _line_batch(batch, owner, n_lines, digests, first, more):
    names = ["doc", "version", "n_lines", "h1", "h2", "pos", "more"]
    halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
    owner = pa.array(owner, pa.int64())
    columns = [batch.column(0).take(owner), batch.column(1).take(owner), pa.array(n_lines, pa.int64())]
    columns += [pa.array(halves[:, 0]), pa.array(halves[:, 1])]
    columns += [pa.array(first, pa.int32()), pa.array(more, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=names)


class Sieve:
    """Streams a sorted partition (h1, h2, doc, version, pos, more) and gives the rows of keys
    that ``min_docs`` documents have.

    A key whose rows lie in this partition alone is decided here. The first and the last key may
    go on in other partitions: while they have too few documents here, their rows are given as
    pending, with the key; a mark tells where they have enough.
    """

    def __init__(self, min_docs: int):
        self.min_docs = min_docs
        self.held: pa.RecordBatch | None = None  # undecided rows of the last key
        self.key = None  # last key, once it is decided or partly given as pending
        self.common = False
        self.started = False

    def rows(self, batch: pa.RecordBatch, index, state: int, with_key: bool) -> pa.RecordBatch:
        part = batch.take(pa.array(index))
        none = pa.nulls(len(index), pa.int64())
        keys = [part.column(0), part.column(1)] if with_key else [none, none]
        columns = [*keys, *part.columns[2:], pa.array(np.full(len(index), state, dtype=np.int32))]
        return pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "state"])

    def mark(self, key) -> pa.RecordBatch:
        columns = [pa.array([k], pa.int64()) for k in key]
        columns += [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.binary())]
        columns.append(pa.array([COMMON], pa.int32()))
        return pa.RecordBatch.from_arrays(columns, names=["h1", "h2", "doc", "version", "pos", "more", "state"])

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if self.held is not None:
            batch = pa.Table.from_batches([self.held, batch]).combine_chunks().to_batches()[0]
            self.held = None
        h1, h2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        null = batch.column(2).is_null().to_numpy(zero_copy_only=False)
        doc = batch.column(2).fill_null(0).to_numpy()
        version, pos = batch.column(3).to_numpy(), batch.column(4).to_numpy()

        def differs(*columns):
            out = np.ones(len(batch), dtype=bool)
            out[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            return out

        new_key = differs(h1, h2)
        new_doc = new_key | differs(doc, null)
        new_row = new_doc | differs(version, pos)  # a repeated row is one row
        start = np.flatnonzero(new_key)
        n_docs = np.add.reduceat(new_doc, start)
        run = np.cumsum(new_key) - 1
        known = self.key is not None and self.key == (h1[0], h2[0])  # the first key was seen before
        common = n_docs >= self.min_docs
        if self.common and not known:  # it ended with the batch before
            yield self.mark(self.key)
        if known and self.common:
            common[0] = True
        give = common[run] & new_row
        if give.any():
            yield self.rows(batch, np.flatnonzero(give), DECIDED, False)
        last = len(start) - 1
        edge = not self.started  # the first key of the partition
        self.started = True
        if last > 0:  # the first key ends in this batch
            yield from self.close(batch, np.flatnonzero((run == 0) & new_row), common[0], edge or known)
        # what is known of the last key
        same = known and last == 0
        key = (int(h1[-1]), int(h2[-1]))
        if common[last]:
            self.key, self.common = key, True
        else:
            rest = np.flatnonzero((run == last) & new_row)
            if same or (edge and last == 0) or len(rest) > MOST_HELD:
                if len(rest) > MOST_HELD:
                    # one row stays behind, so that the document it belongs to is not counted twice
                    yield self.rows(batch, rest[:-1], PENDING, True)
                    rest = rest[-1:]
                self.key, self.common = key, False
            else:
                self.key, self.common = None, False
            self.held = batch.take(pa.array(rest))

    def close(self, batch, index, common: bool, shared: bool) -> Iterator[pa.RecordBatch]:
        """The end of a key; ``shared``: rows of it may be elsewhere."""
        if shared and common:
            yield self.mark((batch.column(0)[0].as_py(), batch.column(1)[0].as_py()))
        elif shared:
            yield self.rows(batch, index, PENDING, True)

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.common:
            yield self.mark(self.key)
        elif self.held is not None:
            yield self.rows(self.held, np.arange(len(self.held)), PENDING, True)


def common_rows(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    sieve = Sieve(min_docs)
    for batch in batches:
        if len(batch):
            yield from sieve.add(batch)
    yield from sieve.end()


def pack(keep: np.ndarray) -> bytes:
    """A bit for every line, packed and compressed."""
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 1)


def unpack(bitmap: bytes, n_lines: int) -> np.ndarray:
    bits = np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8)
    return np.unpackbits(bits, count=n_lines, bitorder="little").astype(bool)


def bitmaps_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc, version, n_lines, first, more) to their bitmaps."""
    for batch in batches:
        gone, maps = [], []
        for n, first, more in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
            keep = np.ones(n, dtype=bool)
            keep[first or []] = False
            for packed in more or []:
                keep[np.frombuffer(packed, dtype="<i4")] = False
            gone.append(n - int(keep.sum()))
            maps.append(pack(keep))
        columns = [*batch.columns[:3], pa.array(gone, pa.int64()), pa.array(maps, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc", "version", "n_lines", "n_dropped", "keep"])


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    text = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).cast("bigint").alias("doc"), F.xxhash64(text).alias("version"), text.alias("text")
    )


def line_bitmaps(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = 10, min_chars: int = 1
) -> DataFrame:
    """Which lines of every document stay when common lines go.

    A line's key is the line without ASCII white space at both ends and with A-Z in lower case;
    keys of at least ``min_chars`` code points that at least ``min_docs`` documents have lose all
    their lines. Returns, once per different row, ``doc`` (the key), ``version`` (a hash of the
    text, which tells apart different texts of one key), ``n_lines``, ``n_dropped`` and ``keep``,
    a compressed bitmap with a bit for every line (see ``unpack``).

    Every document sends a 128-bit hash and the places of each of its different lines, no text.
    Hashes are range-partitioned together with document and place, so the rows of a line that a
    third of all documents have are dealt over as many partitions as they need, and sorted by
    document and place within a partition, where one pass counts first occurrences. Only the
    first and the last line of a partition may go on in another one; these are settled by a
    small second step, whose input is bounded by the number of partitions.

    A null text is an empty one and has one empty line, which no key of one code point has. Rows
    with one key are one document; a null key is a key like others. Places of a document are one
    row, of four bytes for each line that it drops. An empty table gives no rows. Other columns
    are not read.
    """
    rows = _rows(docs, key, text)
    lines = materialize(rows.mapInArrow(lambda batches: line_rows(batches, min_chars), LINES))
    heads = lines.filter("pos < 0").groupBy("doc", "version").agg(F.first("n_lines").alias("n_lines"))
    sort = lines.filter("pos >= 0").select(*ORDER, "more").repartitionByRange(*ORDER)
    sort = sort.sortWithinPartitions(*ORDER)
    stream = materialize(sort.mapInArrow(lambda batches: common_rows(batches, min_docs), STREAM))

    # lines at the borders of partitions
    shared = stream.filter(F.col("state") != DECIDED).groupBy("h1", "h2")
    shared = shared.agg(
        F.max("state").alias("state"), F.count_distinct(F.struct("doc")).alias("n")
    ).filter((F.col("state") == COMMON) | (F.col("n") >= min_docs))
    late = stream.filter(F.col("state") == PENDING).join(shared.select("h1", "h2"), ["h1", "h2"], "left_semi")
    places = ["doc", "version", "pos", "more"]
    gone = stream.filter(F.col("state") == DECIDED).select(*places).unionByName(late.select(*places))

    gone = gone.groupBy(F.col("doc").alias("_doc"), F.col("version").alias("_version")).agg(
        F.collect_list("pos").alias("first"), F.collect_list("more").alias("more")
    )
    same = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("version") == F.col("_version"))
    found = heads.join(gone, same, "left").select("doc", "version", "n_lines", "first", "more")
    return found.mapInArrow(
        bitmaps_of, "doc bigint, version bigint, n_lines bigint, n_dropped bigint, keep binary"
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = textbuf.column_bytes(batch.column(1))
        kept = []
        columns = (batch.column(i).to_pylist() for i in (2, 3, 4))
        for i, (n_lines, n_dropped, keep) in enumerate(zip(*columns)):
            raw = data[offsets[i] : offsets[i + 1]].tobytes()
            if n_dropped:
                stay = np.flatnonzero(unpack(keep, n_lines)).tolist()
                lines = raw.split(b"\n")
                raw = b"\n".join([lines[j] for j in stay])
            kept.append(raw)
        columns = [batch.column(0), *batch.columns[2:4], pa.array(kept, pa.binary()).cast(pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc", "n_lines", "n_dropped", "kept"])


def remove_common_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = 10, min_chars: int = 1
) -> DataFrame:
    """Texts without the lines that at least ``min_docs`` documents have, see ``line_bitmaps``.

    Returns ``key``, ``n_lines`` (before), ``n_dropped`` and ``kept``, the other lines joined by
    line feeds; every row comes back as often as it occurs, nulls and empty tables as told there.
    """
    maps = line_bitmaps(docs, key, text, min_docs, min_chars)
    maps = maps.withColumnsRenamed({"doc": "_doc", "version": "_version"})
    same = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("version") == F.col("_version"))
    rows = _rows(docs, key, text).join(maps, same).select("doc", "text", "n_lines", "n_dropped", "keep")
    out = rows.mapInArrow(_cut, "doc bigint, n_lines bigint, n_dropped bigint, kept string")
    return out.withColumnRenamed("doc", key)
