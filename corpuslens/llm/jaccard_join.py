"""Jaccard join on word shingles with prefixes of token combinations."""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm import textbuf
from corpuslens.llm.components import connected_components
from corpuslens.session import materialize

U64 = np.uint64
SKETCH_BITS, SLICE_BITS = 20, 12

# Tokens at least so many times as frequent as the mean bucket of the sketch are frequent.
HEAVY_LEVEL, LEAST_HEAVY = 2, 16

# Sets smaller than this index frequent tokens alone as well; larger ones in pairs.
SMALL_SET, MOST_CLASSES = 8, 32

PARITY_BYTES = 128

# Documents to be verified up to this many are picked by a broadcast of their keys, 8 bytes
# each; beyond it their texts are shuffled.
MAX_BROADCAST_KEYS = 1_000_000

PARTNERS = 64  # rows of one signature compared at once
BLOCK_ROWS = 1024  # rows of one signature in one block; a task compares two blocks
LEAST = 16  # least signatures of a document that travel with each of its rows
WIDE_BYTES = 16 * 1024 * 1024  # of wide parities compared at once


@dataclass(frozen=True)
class Similarity:
    """Two sets link when 100 * intersection >= percent * union."""

    percent: int
    words: int

    def missing(self, n: int) -> int:
        """Most elements of a set of ``n`` that a linked set may lack."""
        return n - -(-self.percent * n // 100)

    def partners(self, n: int) -> tuple[int, int]:
        return -(-self.percent * n // 100), 100 * n // self.percent


def token_sets(data, offsets, size: int):
    """Distinct shingles of several texts, sorted within each, and where each text begins.

    A text with fewer words than a shingle has its whole sequence as the only one.
    """
    start, end, first = textbuf.word_spans(data, offsets)
    words = textbuf.word_hashes(data, start, end, lower=True)
    n = np.diff(first)
    shingles = textbuf.gram_hashes(words, size)
    per = np.maximum(n - size + 1, 0)
    at = textbuf.ranges(first[:-1], per)
    short = np.flatnonzero((n > 0) & (n < size))
    prefix = textbuf.prefix_hashes(words)
    whole = textbuf.range_hash(prefix, first[short], first[short + 1])
    whole = textbuf.mix(whole + n[short].astype(U64))
    tokens = np.concatenate([shingles[at], whole])
    owner = np.concatenate([np.repeat(np.arange(len(n)), per), short])
    order = np.lexsort((tokens, owner))
    tokens, owner = tokens[order], owner[order]
    fresh = np.ones(len(tokens), dtype=bool)
    fresh[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    tokens, owner = tokens[fresh], owner[fresh]
    return tokens, np.searchsorted(owner, np.arange(len(n) + 1))


def blocks(batch: pa.RecordBatch, size: int):
    """Ids, tokens and places of the texts of an Arrow batch, a block at a time."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    data, offsets = textbuf.column_bytes(batch.column(1))
    for low, high in textbuf.groups(offsets):
        tokens, first = token_sets(data, offsets[low : high + 1], size)
        yield ids[low:high], tokens, first


# Sets and the sketch of frequencies ------------------------------------------------------


def summaries(rows: DataFrame, size: int) -> DataFrame:
    """Per document (``slice`` -1) its number of tokens and a 128-bit hash of its set; per task
    and slice a part of the frequency sketch of all tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch in batches:
            for ids, tokens, first in blocks(batch, size):
                sketch += np.bincount((tokens >> U64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(sketch))
                sums = []
                for salt in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
                    total = np.concatenate([[U64(0)], np.cumsum(textbuf.mix(tokens ^ U64(salt)))])
                    sums.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
                n = np.diff(first)
                yield made(np.full(len(ids), -1), ids, n, *sums, [None] * len(ids))
        used = sketch.reshape(-1, 1 << SLICE_BITS)
        filled = np.flatnonzero(used.any(axis=1))
        zero = np.zeros(len(filled), dtype=np.int64)
        packed = [zlib.compress(used[i].tobytes(), 1) for i in filled]
        yield made(filled, zero, zero, zero, zero, packed)

    def made(part, ids, n, h1, h2, packed):
        columns = [pa.array(part.astype(np.int32)), pa.array(ids.astype(np.int64)), pa.array(n.astype(np.int64))]
        columns += [pa.array(h1), pa.array(h2), pa.array(packed, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["slice", "doc", "n", "h1", "h2", "counts"])

    return rows.mapInArrow(run, "slice int, doc bigint, n bigint, h1 bigint, h2 bigint, counts binary")


def levels_of(parts: DataFrame) -> np.ndarray:
    """Frequency level of every bucket of the sketch: 0 for rare, one more for each doubling.

    Parts of a slice are added up in a stream; only the finished sketch, a fixed number of
    bytes, reaches the driver.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = np.frombuffer(zlib.decompress(packed.as_buffer()), dtype=np.int64)
                sums[part] = sums.get(part, 0) + counts
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
                names=["slice", "counts"],
            )

    added = parts.select("slice", "counts").repartition("slice").mapInArrow(add, "slice int, counts binary")
    sketch = np.zeros((1 << (SKETCH_BITS - SLICE_BITS), 1 << SLICE_BITS), dtype=np.int64)
    for row in added.toLocalIterator():
        sketch[row["slice"]] = np.frombuffer(row["counts"], dtype=np.int64)
    sketch = sketch.reshape(-1)
    base = max(float(sketch.mean()), LEAST_HEAVY)
    return np.clip(np.log2(np.maximum(sketch, 1) / base), 0, 15).astype(np.uint8)


# Signatures ------------------------------------------------------------------------------


def scheme(n: int) -> int:
    """Number of classes of frequent tokens for sets of ``n``; 0: every token for itself."""
    return 0 if n < SMALL_SET else min(MOST_CLASSES, (1 << (n.bit_length() - 1)) // 4)


def signatures(keys: np.ndarray, rare: int, like: Similarity) -> np.ndarray:
    """Signatures of one set, whose tokens are given in the global order, rare ones first.

    A linked set lacks at most ``missing`` tokens of this one. Rare tokens count one each. Of
    frequent tokens, which are dealt to classes by their hash, a class with k tokens in the
    prefix counts k - 1, because only pairs of its tokens are indexed. The prefix is extended
    until the count exceeds what may be missing: then one signature at least is shared.
    Signatures of single rare tokens are even, all others odd.
    """
    n = len(keys)
    need = like.missing(n) + 1
    singles = keys[: min(rare, need)]
    out = []
    if rare < need:
        low, high = like.partners(n)
        for classes in sorted({scheme(m) for m in range(max(low, 1), high + 1)} if high < 300 else {scheme(low), scheme(n), scheme(high)}):
            frequent = keys[rare:]
            if classes == 0:
                out.append(textbuf.mix(frequent[: need - rare] + U64(1)))
                continue
            kind = (textbuf.mix(frequent) % U64(classes)).astype(np.int64)
            counts = np.ones(len(kind), dtype=np.int64)
            counts[np.unique(kind, return_index=True)[1]] = 0
            enough = int(np.searchsorted(np.cumsum(counts), need - rare)) + 1
            frequent, kind = frequent[:enough], kind[:enough]
            salt = textbuf.mix(np.array([classes], dtype=U64))
            for c in np.unique(kind):
                own = textbuf.mix(frequent[kind == c] + salt)
                i, j = np.triu_indices(len(own), 1)
                out.append(textbuf.mix(own[i] * U64(3) + own[j]))
    out = [np.concatenate(out) | U64(1)] if out else []
    return np.unique(np.concatenate([textbuf.mix(singles) & ~U64(1), *out]))


def parity_of(tokens: np.ndarray) -> np.ndarray:
    """Packed parity of a set, of a power of two of bits."""
    bits = max(8 * PARITY_BYTES, 1 << (len(tokens) - 1).bit_length())
    odd = np.bincount((tokens % U64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool))


def folded(parity: np.ndarray, size: int) -> np.ndarray:
    """The parity over fewer classes, ``size`` bytes."""
    return np.bitwise_xor.reduce(parity.reshape(-1, size), axis=0)


def signed(rows: DataFrame, levels: np.ndarray, like: Similarity) -> DataFrame:
    """Signatures of every set, its size, how many rare tokens its prefix has, and its parity:
    a bit for every class of tokens, whether the set has an odd number of them. It has at least
    half as many classes as the set has tokens, the wide one at least as many as tokens."""
    model = rows.sparkSession.sparkContext.broadcast(levels)  # one byte per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.value
        for batch in batches:
            for ids, tokens, first in blocks(batch, like.words):
                level = table[(tokens >> U64(64 - SKETCH_BITS)).astype(np.int64)]
                # order of all tokens: by level, then by hash
                keys = (level.astype(U64) << U64(60)) | (textbuf.mix(tokens) >> U64(4))
                owner = np.repeat(np.arange(len(ids)), np.diff(first))
                keys = keys[np.lexsort((keys, owner))]
                heavy = np.concatenate([[0], np.cumsum((keys >> U64(60)) >= U64(HEAVY_LEVEL))])
                some = np.flatnonzero(np.diff(first))
                lists, plain, parity = [], [], []
                for i in some.tolist():
                    a, b = int(first[i]), int(first[i + 1])
                    rare = b - a - int(heavy[b] - heavy[a])
                    parity.append(parity_of(tokens[a:b]))
                    lists.append(signatures(keys[a:b], rare, like).view(np.int64))
                    need = like.missing(b - a) + 1
                    plain.append(min(rare, need))
                if not lists:
                    continue
                at = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[some].astype(np.int64)),
                        pa.array(np.diff(first)[some]),
                        pa.array(np.array(plain, dtype=np.int64)),
                        pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(lists))),
                        pa.array([folded(x, max(PARITY_BYTES, len(x) // 2)).tobytes() for x in parity], pa.binary()),
                        pa.array([x.tobytes() for x in parity], pa.binary()),
                    ],
                    names=["doc", "n", "plain", "signatures", "parity", "wide_parity"],
                )

    return rows.mapInArrow(
        run, "doc bigint, n bigint, plain bigint, signatures array<bigint>, parity binary, wide_parity binary"
    )


MEMBERS = "signature bigint, plain bigint, doc bigint, n bigint, centre bigint, centre_n bigint"


def with_company(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (signature, plain, doc, n), sorted, of signatures that occur more than once; each
    with the first document of its signature, the centre."""
    held = None  # a first row whose company is not known yet: signature, plain, doc, n, shown

    def made(*columns):
        names = ["signature", "plain", "doc", "n", "centre", "centre_n"]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    for batch in batches:
        sig, plain, doc, n = (c.to_numpy() for c in batch.columns)
        if not len(sig):
            continue
        if held is not None:
            sig, plain, doc, n = (np.concatenate([[h], x]) for h, x in zip(held, (sig, plain, doc, n)))
        new = np.ones(len(sig), dtype=bool)
        new[1:] = sig[1:] != sig[:-1]
        first = np.flatnonzero(new)
        centre = first[np.cumsum(new) - 1]
        keep = ~new | np.append(~new[1:], False)
        if held is not None and held[4]:
            keep[0] = False
        if keep.any():
            yield made(sig[keep], plain[keep], doc[keep], n[keep], doc[centre[keep]], n[centre[keep]])
        last = first[-1]
        shown = (len(sig) - 1 > last) or (held is not None and last == 0 and held[4])
        held = (sig[last], plain[last], doc[last], n[last], shown)


# Verification ----------------------------------------------------------------------------


def sets_of(rows: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, tokens, first in blocks(batch, size):
                raw = tokens.tobytes()
                sets = [raw[8 * a : 8 * b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids.astype(np.int64)), pa.array(sets, pa.binary())], names=["doc", "set"]
                )

    return rows.mapInArrow(run, "doc bigint, set binary")


def overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        common = np.empty(len(batch), dtype=np.int64)
        for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
            x = np.frombuffer(x.as_buffer(), dtype=U64)
            y = np.frombuffer(y.as_buffer(), dtype=U64)
            both = np.concatenate([x, y])
            both.sort(kind="stable")
            common[i] = (both[1:] == both[:-1]).sum()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(common)], names=["a", "b", "common"]
        )


def measured(pairs: DataFrame, known: DataFrame, size: int) -> DataFrame:
    """Size of the intersection of every pair ``(a, b)``; ``pairs`` is a stored table. Sets are
    made again from the texts of those documents alone that stand in a pair."""
    docs = pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct()
    docs = materialize(docs)
    few = docs.count() <= MAX_BROADCAST_KEYS
    wanted = known.join(F.broadcast(docs) if few else docs, "doc", "left_semi")
    sets = materialize(sets_of(wanted, size)).dropDuplicates(["doc"])
    x = sets.select(F.col("doc").alias("a"), F.col("set").alias("x"))
    y = sets.select(F.col("doc").alias("b"), F.col("set").alias("y"))
    both = pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return both.mapInArrow(overlaps, "a bigint, b bigint, common bigint")


def may_link(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, na, nb, wide parity, wide parity) that their parities do not rule out."""
    differ = (100 - percent) / (100 + percent)
    for batch in batches:
        if not len(batch):
            continue
        apart = np.empty(len(batch), dtype=np.int64)
        for i, (x, y) in enumerate(zip(batch.column(4), batch.column(5))):
            x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint8) for v in (x, y))
            size = min(len(x), len(y))
            apart[i] = np.bitwise_count(folded(x, size) ^ folded(y, size)).sum(dtype=np.int64)
        n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
        yield batch.select([0, 1, 2, 3]).filter(pa.array(apart <= differ * n + 1e-9))


def plausible(pairs: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """``pairs(a, b, na, nb)`` without those that cannot link by their wide parities."""
    x = signs.select(F.col("doc").alias("a"), F.col("wide_parity").alias("x"))
    y = signs.select(F.col("doc").alias("b"), F.col("wide_parity").alias("y"))
    both = pairs.join(x, "a").join(y, "b").select("a", "b", "na", "nb", "x", "y")
    return both.mapInArrow(
        lambda batches: may_link(batches, percent), "a bigint, b bigint, na bigint, nb bigint"
    )


def parities(column: pa.Array) -> list[np.ndarray]:
    """Every parity folded to ``PARITY_BYTES``, as a row of words; its own width; and itself
    where it is wider than that."""
    data, at = textbuf.column_bytes(column)
    width = np.diff(at)
    narrow = np.empty((len(column), PARITY_BYTES // 8), dtype=U64)
    plain = width == PARITY_BYTES
    narrow[plain] = data[at[:-1][plain, None] + np.arange(PARITY_BYTES)].view(U64)
    whole = np.full(len(column), None, dtype=object)
    for i in np.flatnonzero(~plain).tolist():
        whole[i] = data[at[i] : at[i + 1]].copy()
        narrow[i] = folded(whole[i], PARITY_BYTES).view(U64)
    return [narrow, width, whole]


def apart_by_width(x: np.ndarray, y: np.ndarray, width: np.ndarray, whole: np.ndarray):
    """Rows ``x`` and ``y`` of the pairs whose parities are both wide: which pairs, and in how
    many bits they differ at the lesser width. A block of pairs at a time."""
    least = np.minimum(width[x], width[y])
    for size in np.unique(least[least > PARITY_BYTES]).tolist():
        some = np.flatnonzero(least == size)
        for part in np.array_split(some, len(some) * size // WIDE_BYTES + 1):
            rows, place = np.unique(np.concatenate([x[part], y[part]]), return_inverse=True)
            bits = np.stack([folded(whole[row], size) for row in rows]).view(U64)
            differ = bits[place[: len(part)]] ^ bits[place[len(part) :]]
            yield part, np.bitwise_count(differ).sum(axis=1, dtype=np.int64)


def least_lists(column: pa.ListArray) -> np.ndarray:
    """Lists of up to ``LEAST`` signatures as rows of a matrix, their last one repeated."""
    at = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy()
    place = at[:-1, None] + np.minimum(np.arange(LEAST), np.diff(at)[:, None] - 1)
    return values[place]


def least_common(x: np.ndarray, y: np.ndarray, signature: int) -> np.ndarray:
    """Which pairs of rows of least signatures are to be listed at ``signature``.

    A signature that both lists hold is the least of all that the documents share, if it is the
    least in both lists; the pair is listed there alone. Where the lists have none in common, the
    pair is listed wherever it is found: it shares few of its signatures, so that is not often.
    """
    out = np.empty(len(x), dtype=bool)
    for a in range(0, len(x), 4096):
        p, q = x[a : a + 4096], y[a : a + 4096]
        both = (p[:, :, None] == q[:, None, :]).any(axis=2)
        first = np.where(both, p, np.iinfo(np.int64).max).min(axis=1)
        out[a : a + 4096] = ~both.any(axis=1) | (first == signature)
    return out


def across(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of rows (signature, pair, block, component, doc, n, distance, parity, least),
    sorted, of one signature and different components, as far as their sizes, their distances
    from the centre and their parities allow a link.

    Rows of a common signature are dealt to blocks; ``pair`` tells which two blocks meet here, and
    rows of two blocks are compared across these alone. ``parity`` has a bit for every class of
    tokens: whether the set has an odd number of them. Every token that only one of two sets has
    flips one bit, so they differ in as many tokens as bits at least. Long sets have more bits,
    or half of them would differ at any distance. A pair that shares many signatures is given at
    the least of them.
    """
    reach = 1 - percent / 100 + 1e-9
    differ = (100 - percent) / (100 + percent)

    def made(a, b, na, nb):
        swap = a > b
        columns = [np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb, na), np.where(swap, na, nb)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "na", "nb"])

    def pairs(signature, _, block, comp, doc, n, far, least, parity, width, whole):
        alone = len(doc) == 0 or (block == block[0]).all()
        for i in range(0, len(doc), PARTNERS):
            j = slice(i, i + PARTNERS)
            fits = (comp[j, None] != comp[None, i:]) & (100 * np.minimum(n[j, None], n[None, i:])
                >= percent * np.maximum(n[j, None], n[None, i:]))
            if not alone:
                fits &= block[j, None] != block[None, i:]
            known = np.abs(far[j, None] - far[None, i:])
            fits &= ~(known > reach)  # an unknown distance rules nothing out
            x, y = (i + k for k in np.nonzero(np.triu(fits, 1)))
            apart = np.bitwise_count(parity[x] ^ parity[y]).sum(axis=1, dtype=np.int64)
            fits = apart <= differ * (n[x] + n[y]) + 1e-9
            x, y = x[fits], y[fits]
            fits = least_common(least[x], least[y], signature[0])
            x, y = x[fits], y[fits]
            fits = np.ones(len(x), dtype=bool)
            for some, apart in apart_by_width(x, y, width, whole):
                fits[some] = apart <= differ * (n[x[some]] + n[y[some]]) + 1e-9
            x, y = x[fits], y[fits]
            if len(x):
                yield made(doc[x], doc[y], n[x], n[y])

    held = None
    for batch in batches:
        if not len(batch):
            continue
        rows = [c.to_numpy() for c in batch.columns[:7]]
        rows += [least_lists(batch.column(8)), *parities(batch.column(7))]
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows)]
        border = np.flatnonzero(np.append(True, (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])))
        for a, b in zip(border[:-1], border[1:]):
            yield from pairs(*(x[a:b] for x in rows))
        held = [x[border[-1] :] for x in rows]
    if held is not None:
        yield from pairs(*held)


def block_pairs(rows: DataFrame) -> DataFrame:
    """Rows with the number ``rows`` of their signature to one row per pair of blocks.

    Nearly all signatures have one block. A row of one with b blocks meets each of them, so it
    comes b times, and no task holds more than two blocks of a signature.
    """
    blocks = F.ceil(F.col("rows") / BLOCK_ROWS)
    block = F.pmod(F.xxhash64("doc"), blocks)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("_other")
    rows = rows.withColumns({"block": block, "_blocks": blocks}).select("*", other)
    pair = F.least("block", "_other") * F.col("_blocks") + F.greatest("block", "_other")
    return rows.withColumn("pair", pair).drop("_blocks", "_other", "rows")


# The operator ----------------------------------------------------------------------------


def jaccard_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85, words: int = 4
) -> DataFrame:
    """Groups of documents linked by shingle sets of Jaccard similarity ``percent`` or more.

    Returns ``key``, ``n_shingles`` and ``component_id``, the least key reachable by links.

    Documents with equal sets are found by a hash of the set and represented by the first.
    The tokens of the others are ordered by their frequency in a sketch over all documents;
    a prefix of each set is indexed, rare tokens alone and frequent ones in pairs within
    classes (see ``signatures``), so any two linked sets share a signature. Candidates are
    verified on whole sets. First every set is compared with one other per signature, the one
    with the fewest rare tokens, to which near copies are closest; what that joins need not be
    compared any more, since only components are asked for. Then all pairs that still share a
    signature across components are compared, unless their sizes, their distances from the
    common centre by the triangle inequality, or parities of their sets rule a link out. No
    pair of a finished group is ever listed, and no pair that could join two groups is left out.
    A signature of many documents is cut into blocks, whose pairs are dealt over all tasks, and
    a pair that shares many signatures is listed at the least of them (see ``least_common``).

    A null or blank text has an empty set and links with nothing; rows with a null key come
    back with a null component; repeated rows with one key are one document and come back as
    often as they occur; an empty table gives no rows. Other columns are not read.
    """
    like = Similarity(percent, words)
    rows = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("text"))
    known = rows.filter("doc is not null")
    summary = materialize(summaries(known, words))
    sets = summary.filter("slice = -1").select("doc", "n", "h1", "h2")
    classes = materialize(sets.filter("n > 0").groupBy("h1", "h2", "n").agg(F.min("doc").alias("first")))
    levels = levels_of(summary.filter("slice >= 0"))

    firsts = classes.select(F.col("first").alias("doc"))
    signs = signed(known, levels, like).join(firsts, "doc", "left_semi")
    signs = materialize(signs).dropDuplicates(["doc"])
    members = signs.select(F.explode("signatures").alias("signature"), "plain", "doc", "n")
    members = members.repartition("signature").sortWithinPartitions("signature", "plain", "doc")
    members = materialize(members.mapInArrow(with_company, MEMBERS))

    # everyone with the centre of each signature
    smaller, larger = F.least("n", "centre_n"), F.greatest("n", "centre_n")
    pairs = members.filter((F.col("doc") != F.col("centre")) & (100 * smaller >= percent * larger))
    pairs = pairs.select(
        F.col("doc").alias("a"), F.col("centre").alias("b"), F.col("n").alias("na"), F.col("centre_n").alias("nb")
    ).distinct()
    pairs = materialize(plausible(pairs, signs, percent))
    near = measured(pairs, known, words).join(pairs, ["a", "b"])
    union = F.col("na") + F.col("nb") - F.col("common")
    near = materialize(
        near.select(F.col("a").alias("doc"), F.col("b").alias("centre"),
                    (1 - F.col("common") / union).alias("distance"),
                    (100 * F.col("common") >= percent * union).alias("linked"))
    )
    links = near.filter("linked").select(F.col("doc").alias("a"), F.col("centre").alias("b"))
    labels = materialize(connected_components(links))

    # signatures that still span components
    open_ = members.join(labels, F.col("doc") == F.col("node"), "left").drop("node")
    open_ = materialize(open_.withColumn("component", F.coalesce("component", "doc")))
    split = open_.groupBy("signature").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.count_if(F.col("doc") != F.col("centre")).alias("rows"),
    )
    split = split.filter("low <> high").select("signature", "rows")
    open_ = materialize(open_.filter("doc <> centre").join(split, "signature"))
    least = open_.groupBy("doc").agg(F.slice(F.sort_array(F.collect_set("signature")), 1, LEAST).alias("least"))
    shapes = signs.select("doc", "parity").join(least, "doc")
    open_ = open_.join(near.select("doc", "centre", "distance"), ["doc", "centre"], "left")
    open_ = block_pairs(open_.join(shapes, "doc")).select(
        "signature", "pair", "block", "component", "doc", "n",
        # not measured: nothing is known of the distance
        F.coalesce("distance", F.lit(float("nan"))).alias("distance"), "parity", "least",
    )
    rest = open_.repartition("signature", "pair")
    rest = rest.sortWithinPartitions("signature", "pair", "component", "doc")
    rest = rest.mapInArrow(
        lambda batches: across(batches, percent), "a bigint, b bigint, na bigint, nb bigint"
    )
    rest = materialize(plausible(rest.distinct(), signs, percent))
    found = measured(rest, known, words).join(rest, ["a", "b"])
    found = found.filter(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common")))
    found = materialize(found.select("a", "b"))
    if not found.isEmpty():
        labels = connected_components(links.unionByName(found))

    joined = classes.join(labels, F.col("first") == F.col("node"), "left")
    joined = joined.select("h1", "h2", "n", F.coalesce("component", "first").alias("component"))
    joined = joined.groupBy("h1", "h2", "n").agg(F.min("component").alias("component"))
    out = sets.join(joined, ["h1", "h2", "n"], "left")
    out = out.select(
        F.col("doc").alias(key),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc").alias("component_id"),
    )
    lost = rows.filter("doc is null").select(
        F.col("doc").alias(key), F.lit(None).cast("bigint").alias("n_shingles"), F.col("doc").alias("component_id")
    )
    return out.unionByName(lost)
