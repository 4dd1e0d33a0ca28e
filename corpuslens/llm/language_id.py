"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm import textbuf

ORDERS = (1, 2, 3)
MAX_LANGUAGES = 1024


def character_values(codes: np.ndarray) -> np.ndarray:
    """A random 64-bit value for every character, given as the number its UTF-8 bytes write."""
    return textbuf.mix((codes + np.uint64(1)) * np.uint64(0xA24BAED4963EE407))


ASCII = character_values(np.arange(128, dtype=np.uint64))

# The longest n-gram ends at most so many bytes after the byte behind its first one.
TAIL = 4 * max(ORDERS) - 1


def characters(part: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the characters that begin in these bytes, and the places where they begin.

    ``firsts`` are the first bytes of texts, so that nothing crosses them.
    """
    begins = (part & 0xC0) != 0x80
    begins[firsts] = True
    at = np.flatnonzero(begins)
    if len(at) == len(part) and not (part & 0x80).any():
        return ASCII[part], at
    codes = part[at].astype(np.uint64)
    room = np.diff(at, append=len(part))
    for k in range(1, 4):
        longer = np.flatnonzero(room > k)
        codes[longer] = (codes[longer] << np.uint64(8)) | part[at[longer] + k]
    return character_values(codes), at


def ngram_buckets(
    column: pa.Array, buckets: int, piece: int = textbuf.GROUP_BYTES
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per group of texts: number of its first text, the bucket of every n-gram of each order
    and the text it belongs to, counted from the group's first.

    Characters are code points with A-Z folded; n-grams do not cross texts, and a white
    space character of ASCII stands for the border of words. Long texts are read in pieces of
    so many bytes, which look as far into the next as the longest n-gram reaches.
    """
    data, offsets = textbuf.column_bytes(column)
    for low, high in textbuf.groups(offsets):
        for start in range(int(offsets[low]), int(offsets[high]), piece):
            end = min(start + piece, int(offsets[high]))
            part = textbuf.LOWER[data[start : min(end + TAIL, int(offsets[high]))]]
            part[textbuf.SPACES[part]] = 32
            borders = offsets[low : high + 1] - start
            firsts = borders[:-1]
            values, at = characters(part, firsts[(firsts >= 0) & (firsts < len(part))])
            owner = np.repeat(np.arange(high - low), np.diff(np.searchsorted(at, borders)))
            own = int(np.searchsorted(at, end - start))
            for n in ORDERS:
                grams = textbuf.gram_hashes(values, n)[:own]
                inside = owner[: len(grams)] == owner[n - 1 :][: len(grams)]
                yield low, (grams[inside] % np.uint64(buckets)).astype(np.int64), owner[: len(grams)][inside]


def train(
    docs: DataFrame, learn: Column, text: str, lang: str, buckets: int
) -> tuple[list[str], np.ndarray]:
    """Languages, and log probabilities of every bucket by language with the prior as last row.

    Counts come from all rows that ``learn`` admits, one partial sum per task. Languages are
    few by nature; more than ``MAX_LANGUAGES`` is an error, not a reason to drop some, and
    bounds the matrix that is broadcast.
    """
    rows = docs.filter(learn & F.col(lang).isNotNull()).select(F.col(lang), F.col(text))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs])
            totals = np.zeros((len(names), buckets + 1), dtype=np.int64)
            totals[:, buckets] = np.bincount(number, minlength=len(names))
            for low, grams, owner in ngram_buckets(batch.column(1), buckets):
                cell = number[low + owner] * buckets + grams
                added = np.bincount(cell, minlength=len(names) * buckets)
                totals[:, :buckets] += added.reshape(len(names), buckets)
            for i, name in enumerate(names):
                sums[name] = sums.get(name, 0) + totals[i]
        for name, total in sums.items():
            slots = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(slots), pa.string()), pa.array(slots.astype(np.int32)), pa.array(total[slots])],
                names=["lang", "slot", "n"],
            )

    partial = rows.mapInArrow(count, "lang string, slot int, n bigint")
    counts = partial.groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    packed = counts.groupBy("lang").agg(F.collect_list(F.struct("slot", "n")).alias("cells"))
    languages = packed.limit(MAX_LANGUAGES + 1).toArrow()  # one row of at most ``buckets`` cells each
    if languages.num_rows > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    order = np.argsort(np.array(languages.column("lang").to_pylist(), dtype=object))
    names, matrix = [], np.zeros((buckets + 1, len(order)), dtype=np.float64)
    cells = languages.column("cells").combine_chunks()
    for column, row in enumerate(order.tolist()):
        names.append(languages.column("lang")[row].as_py())
        own = cells[row].values
        matrix[own.field("slot").to_numpy(), column] = own.field("n").to_numpy()
    if names:
        grams, docs_of = matrix[:buckets], matrix[buckets]
        matrix[buckets] = np.log(docs_of / docs_of.sum())
        matrix[:buckets] = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * buckets))
    return names, matrix


def identify_language(
    docs: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    buckets: int = 1 << 14,
    keep: list[Column] | None = None,
) -> DataFrame:
    """Language of every text and its posterior probability.

    The model is learnt from rows that ``learn`` admits and that have a language; the matrix
    of ``buckets`` times languages is broadcast, and texts are scored in batches: the
    occupied cells of the batch's sparse count matrix times the rows of the matrix they meet.
    ``lang`` is never an input of a prediction.

    ``lang_pred`` is ``und`` with score 0 where a text is null or has no letter, and wherever
    there was nothing to learn from. Ties go to the language that sorts first. A null key
    stays null; repeated rows are judged alike; an empty table gives no rows.
    """
    names, matrix = train(docs, F.coalesce(learn, F.lit(False)), text, lang, buckets)
    model = docs.sparkSession.sparkContext.broadcast(matrix)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = model.value
        for batch in batches:
            n = len(batch)
            sums = np.tile(logs[buckets], (n, 1)) if names else np.zeros((n, 0))
            for low, grams, owner in ngram_buckets(batch.column(batch.num_columns - 2), buckets):
                if not names or not len(grams):
                    continue
                # sparse rows: the n-grams of one text stand together
                first = np.flatnonzero(np.concatenate([[True], np.diff(owner) > 0]))
                for column in range(len(names)):
                    sums[low + owner[first], column] += np.add.reduceat(logs[grams, column], first)
            letters = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            best = sums.argmax(axis=1) if names else np.zeros(n, dtype=np.int64)
            known = letters.astype(bool) & (len(names) > 0)
            top = sums.max(axis=1, keepdims=True) if names else np.zeros((n, 1))
            weight = np.exp(sums - top).sum(axis=1) if names else np.ones(n)
            value = np.where(known, 1.0 / weight, 0.0)
            predicted = [names[b] if k else "und" for b, k in zip(best.tolist(), known.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: batch.num_columns - 2], pa.array(predicted, pa.string()), pa.array(value)],
                names=[*batch.schema.names[: batch.num_columns - 2], "lang_pred", "score"],
            )

    kept = [F.col(key), *(keep or [])]
    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(*kept, F.col(text).alias("_text"), has_letter.alias("_letter"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-2])
    return rows.mapInArrow(score, f"{fields}, lang_pred string, score double")
