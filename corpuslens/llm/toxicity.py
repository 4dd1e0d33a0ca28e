"""Toxicity of texts: obfuscated words are restored by a noisy-channel decoder, then scored."""

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm import textbuf

# Signs written for letters.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e",
}
SEPARATORS = " .-_*"

LETTERS = 27  # a to z, and 0 for everything else
_CODE = np.zeros(256, dtype=np.int64)
_CODE[97:123] = np.arange(1, 27)

# Costs of the channel, in nats: a sign for a letter, a sign left as it is in a word of signs
# alone, a letter once more (in a pair, which spelling has as well, or a longer run), a separator.
SIGN_COST, RAW_COST, PAIR_COST, REPEAT_COST, SEPARATOR_COST = 1.0, 5.0, 5.0, 0.7, 0.5

_IS_LETTER = np.zeros(256, dtype=bool)
_IS_LETTER[97:123] = True
_IS_SIGN = np.zeros(256, dtype=bool)
_IS_SIGN[[ord(c) for c in LEET if ord(c) < 128]] = True
_IS_SEPARATOR = np.zeros(256, dtype=bool)
_IS_SEPARATOR[[ord(c) for c in SEPARATORS]] = True

LEAST = 3  # characters of a run of single ones, or of a word of signs alone


# Character language model ---------------------------------------------------------------


def character_model(docs: DataFrame, text: str) -> np.ndarray:
    """Log probability of every letter after two others, from all texts.

    Every task counts its trigrams; the model has 27**3 entries whatever the input.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LETTERS**3, dtype=np.int64)
        for batch in batches:
            data, offsets = textbuf.column_bytes(batch.column(0))
            for low, high in textbuf.groups(offsets):
                part = textbuf.LOWER[data[offsets[low] : offsets[high]]]
                code = _CODE[part]
                if len(code) > 2:
                    grams = (code[:-2] * LETTERS + code[1:-1]) * LETTERS + code[2:]
                    total += np.bincount(grams, minlength=len(total))
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(total[slots])], names=["slot", "n"])

    counted = docs.select(text).mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    model = np.full(LETTERS**3, 0.1)
    rows = counted.toArrow()
    model[rows.column("slot").to_numpy()] += rows.column("n").to_numpy()
    model = model.reshape(LETTERS, LETTERS, LETTERS)
    return np.log(model / model.sum(axis=2, keepdims=True))


class Decoder:
    """Viterbi search through the lattice of readings of an obfuscated word."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        self.known: dict[str, str] = {}

    def readings(self, char: str, before: str, run: int, parted: bool) -> list[tuple[str, float]]:
        """What ``char``, one of ``run`` equal ones, may stand for, with costs; empty: nothing.
        ``parted``: a separator stands before it already."""
        if char in SEPARATORS:
            return [("", 0.0)] if parted else [("", 0.0), (" ", SEPARATOR_COST)]
        if "a" <= char <= "z":
            again = [("", REPEAT_COST if run > 2 else PAIR_COST)] if char == before else []
            return [(char, 0.0), *again]
        return [(letter, SIGN_COST) for letter in LEET[char]]

    def raw_score(self, word: str) -> float:
        """Score of a word of signs alone left as it is."""
        start, inner = self.model[0][0][0], len(word) - sum(c in SEPARATORS for c in word)
        return (len(word) + 1) * start - RAW_COST * inner

    def decode(self, word: str) -> str:
        if word in self.known:
            return self.known[word]
        # best way into every pair of last letters: score and back pointer
        layer = {(0, 0): 0.0}
        trail = []
        bare = [c for c in word if c not in SEPARATORS]
        runs = [n for n in (len(list(same)) for _, same in groupby(bare)) for _ in range(n)]
        before, parted, at = "", False, 0
        for char in word:
            apart = char in SEPARATORS
            options = self.readings(char, before, 0 if apart else runs[at], parted)
            following, back = {}, {}
            for state, score in layer.items():
                row = self.model[state[0]][state[1]]
                for letter, cost in options:
                    if letter == "":
                        to, value = state, score - cost
                    else:
                        code = ord(letter) - 96 if letter != " " else 0
                        to, value = (state[1], code), score - cost + row[code]
                    if value > following.get(to, -1e300):
                        following[to], back[to] = value, (state, letter)
            layer, parted = following, apart
            if not apart:
                before, at = char, at + 1
            trail.append(back)
        score = lambda s: layer[s] + self.model[s[0]][s[1]][0]
        end = max(layer, key=score)
        if not any("a" <= c <= "z" for c in word) and self.raw_score(word) > score(end):
            out = word
        else:
            letters = []
            for back in reversed(trail):
                end, letter = back[end]
                letters.append(letter)
            out = "".join(reversed(letters))
        if len(self.known) > 200_000:
            self.known.clear()
        self.known[word] = out
        return out

    def restore(self, text: str) -> str:
        """``text`` in lower case with every suspect word decoded."""
        part = np.frombuffer(text.lower().encode(), dtype=np.uint8)
        return self.restore_all(part, np.array([0, len(part)]))[0].tobytes().decode()

    def restore_all(self, part: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower-case texts that begin at ``at``, with every suspect word decoded; new offsets."""
        start, end = suspects(part, at)
        if not len(start):
            return part, at
        raw, pieces, last = part.tobytes(), [], 0
        grown = np.empty(len(start), dtype=np.int64)
        for i, (low, high) in enumerate(zip(start.tolist(), end.tolist())):
            word = self.decode(raw[low:high].decode()).encode()
            pieces += (raw[last:low], word)
            grown[i] = len(word) - (high - low)
            last = high
        pieces.append(raw[last:])
        grown = np.concatenate([[0], np.cumsum(grown)])
        at = at + grown[np.searchsorted(end, at, "right")]
        return np.frombuffer(b"".join(pieces), dtype=np.uint8), at


def runs_of(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of all runs of ``inside``, which cross no text."""
    first = np.zeros(len(inside) + 1, dtype=bool)
    first[at] = True
    starts, ends = inside.copy(), inside.copy()
    if len(inside):
        starts[1:] &= ~inside[:-1] | first[1:-1]
        ends[:-1] &= ~inside[1:] | first[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def near(part: np.ndarray, at: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether only separators stand between each run and the next one of the same text."""
    if len(start) < 2:
        return np.empty(0, dtype=bool)
    seen = np.concatenate([[0], np.cumsum(_IS_SEPARATOR[part])])
    owner = np.searchsorted(at, start, "right")
    gap = start[1:] - end[:-1]
    return (gap > 0) & (seen[start[1:]] - seen[end[:-1]] == gap) & (owner[1:] == owner[:-1])


def suspects(part: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of what may be obfuscated in lower-case texts that begin at ``at``.

    These are words with letters and signs, with a letter twice in a row, or of signs alone,
    and runs of single letters or signs with separators between them.
    """
    letter, sign = _IS_LETTER[part], _IS_SIGN[part]
    tail = np.zeros(len(part), dtype=bool)  # second and third byte of a euro sign
    for i in np.flatnonzero(part[:-2] == 0xE2) if len(part) > 2 else ():
        if part[i + 1] == 0x82 and part[i + 2] == 0xAC:
            sign[i : i + 3] = tail[i + 1 : i + 3] = True
    start, end = runs_of(letter | sign, at)
    if not len(start):
        return start, end
    total = lambda flags: np.concatenate([[0], np.cumsum(flags)])
    of = lambda sums: sums[end] - sums[start]
    size = of(total(~tail))
    letters = of(total(letter))
    twice = np.zeros(len(part), dtype=bool)  # the same letter as the byte before
    twice[1:] = letter[1:] & (part[1:] == part[:-1])
    twice[start] = False
    odd = ((letters > 0) & (letters < size)) | ((letters == 0) & (size >= LEAST)) | (of(total(twice)) > 0)
    # single characters apart; a letter beyond ASCII beside one makes it part of a word
    beyond = np.concatenate([part >= 128, [False]])
    owner = np.searchsorted(at, start, "right")
    before = beyond[start - 1] & (start > at[owner - 1])
    after = beyond[end] & (end < at[owner])
    single = (size == 1) & ~before & ~after
    chained = near(part, at, start, end) & single[:-1] & single[1:]
    link = np.concatenate([[False], chained])  # with the one before
    head = np.flatnonzero(~link)
    last = np.append(head[1:], len(start)) - 1
    chosen = (last - head + 1 >= LEAST) | ((last == head) & odd[head])
    return start[head[chosen]], end[last[chosen]]


# Features -------------------------------------------------------------------------------

_WORD_BYTE = _IS_LETTER.copy()
_WORD_BYTE[128:] = True
PREFIXES = (4, 5)
MOST_PARTS, MOST_JOINED = 3, 24  # words joined to one, and letters before the last of them


def features(
    data: np.ndarray, offsets: np.ndarray, joined: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words and of their first letters, with the text they stand in; and the
    number of words of each text. Words are runs of letters, a byte beyond ASCII included.

    ``joined`` adds the words that two or three neighbours make without their separators.
    """
    low = int(offsets[0])
    part, at = data[low : int(offsets[-1])], offsets - low
    start, end = runs_of(_WORD_BYTE[part], at)
    owner = np.searchsorted(at, start, "right") - 1
    prefix = textbuf.prefix_hashes(textbuf.BYTE_VALUES[part])
    hashes, owners = [textbuf.mix(textbuf.range_hash(prefix, start, end))], [owner]
    for n in PREFIXES:
        long = np.flatnonzero(end - start > n)
        own = textbuf.range_hash(prefix, start[long], start[long] + n)
        hashes.append(textbuf.mix(own + np.uint64(n)))
        owners.append(owner[long])
    if joined and len(start) > 1:
        up, _ = textbuf.powers(MOST_JOINED + 1)
        link = near(part, at, start, end)
        whole, size = textbuf.range_hash(prefix, start, end), end - start
        first = np.arange(len(start))
        joint, length = whole, size
        for n in range(1, MOST_PARTS):
            some = np.flatnonzero(first + n < len(start))
            some = some[link[first[some] + n - 1] & (length[some] < MOST_JOINED)]
            following = first[some] + n
            joint = joint[some] + whole[following] * up[length[some]]
            first, length = first[some], length[some] + size[following]
            hashes.append(textbuf.mix(joint))
            owners.append(owner[first])
    words = np.bincount(owner, minlength=len(offsets) - 1)
    return np.concatenate(hashes), np.concatenate(owners), words


def restored(column: pa.Array, decoder: Decoder) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per group of texts: number of the first, restored lower-case bytes, offsets."""
    data, offsets = textbuf.column_bytes(column)
    for low, high in textbuf.groups(offsets):
        at = offsets[low : high + 1] - offsets[low]
        raw = data[offsets[low] : offsets[high]]
        part, at = decoder.restore_all(textbuf.LOWER[raw], at)
        yield low, part, at


# The classifier -------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Log odds by feature from document counts, and a logistic curve over their sum."""

    keys: np.ndarray  # sorted feature hashes
    toxic: np.ndarray
    clean: np.ndarray
    n_toxic: int
    n_clean: int
    curve: np.ndarray

    def evidence(self, hashes, owners, n, label=None) -> np.ndarray:
        """Sum over the distinct known features of each of ``n`` texts of their log odds, less
        one and two standard errors, so that chance finds in few texts weigh little and
        features hardly more common in toxic texts nothing. With ``label``, the text itself is
        left out of the counts."""
        out = np.zeros(n)
        if not len(self.keys):
            return out
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[at] == hashes)
        pairs = np.unique(owners[hit] * len(self.keys) + at[hit])
        owner, at = pairs // len(self.keys), pairs % len(self.keys)
        toxic, clean = self.toxic[at].astype(float), self.clean[at].astype(float)
        if label is not None:
            # a joined word was not counted
            toxic, clean = np.maximum(toxic - label[owner], 0), np.maximum(clean - 1 + label[owner], 0)
        odds = np.log((toxic + 0.5) / (self.n_toxic + 1)) - np.log((clean + 0.5) / (self.n_clean + 1))
        error = np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
        np.add.at(out, owner, np.maximum(odds - 2 * error - 1, 0))
        return out

    def score(self, evidence, words) -> np.ndarray:
        x = np.column_stack([np.ones(len(words)), evidence, np.log1p(words)])
        return 1 / (1 + np.exp(-np.clip(x @ self.curve, -50, 50)))


def fit_curve(evidence: np.ndarray, words: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Logistic regression on evidence and length, by Newton's method with a weak ridge."""
    x = np.column_stack([np.ones(len(words)), evidence, np.log1p(words)])
    curve = np.zeros(3)
    ridge = np.diag([1e-3, 1e-3, 1e-1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -50, 50)))
        gradient = x.T @ (label - p) - ridge @ curve
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, gradient)
        size = np.abs(step).max()
        curve += step * min(1.0, 5.0 / max(size, 1e-12))
        if size < 1e-8:
            break
    return curve


def train(
    docs: DataFrame, labels: DataFrame, learn: Column, key: str, text: str, label: str,
    characters: np.ndarray, max_rows: int, min_z: float, max_features: int,
) -> Model:
    """Fit on at most ``max_rows`` labelled rows, picked by a hash of their key."""
    spark = docs.sparkSession
    sample = labels.filter(F.coalesce(learn, F.lit(False)) & F.col(label).isNotNull())
    sample = sample.groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("_label"))
    sample = sample.orderBy(F.xxhash64("_key"), "_key").limit(max_rows).toArrow()
    n = sample.num_rows  # at most max_rows numbers
    if n == 0:
        nothing = np.empty(0)
        return Model(np.empty(0, np.uint64), nothing, nothing, 0, 0, np.array([-50.0, 0.0, 0.0]))
    picked = spark.createDataFrame(sample)
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    rows = rows.join(F.broadcast(picked), "_key").select("_key", "_label", "_text")
    signs = spark.sparkContext.broadcast(characters)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(signs.value)
        for batch in batches:
            label = batch.column(1).to_numpy()
            for low, part, at in restored(batch.column(2), decoder):
                hashes, owners, _ = features(part, at)
                order = np.lexsort((hashes, owners))
                h, o = hashes[order], owners[order]
                fresh = np.ones(len(h), dtype=bool)
                fresh[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
                h, o = h[fresh], o[fresh]
                distinct, which = np.unique(h, return_inverse=True)
                total = np.bincount(which, minlength=len(distinct))
                toxic = np.bincount(which, weights=label[low + o], minlength=len(distinct))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(distinct.view(np.int64)), pa.array(toxic.astype(np.int64)), pa.array(total)],
                    names=["feature", "toxic", "n"],
                )

    sizes = rows.groupBy("_label").count().collect()  # two rows
    found = {r["_label"]: r["count"] for r in sizes}
    n_toxic, n_clean = found.get(1, 0), found.get(0, 0)
    counts = rows.mapInArrow(count, "feature bigint, toxic bigint, n bigint")
    counts = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    clean = F.col("n") - F.col("toxic")
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((clean + 0.5) / (n_clean + 1))
    z = odds / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (clean + 0.5))
    telling = counts.select("feature", "toxic", clean.alias("clean"), z.alias("z")).filter(F.col("z") >= min_z)
    telling = telling.orderBy(F.desc("z"), "feature").limit(max_features).toArrow()
    keys = telling.column("feature").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    known = Model(
        keys[order], telling.column("toxic").to_numpy()[order], telling.column("clean").to_numpy()[order],
        n_toxic, n_clean, np.zeros(3),
    )
    model = spark.sparkContext.broadcast(known)

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(signs.value)
        for batch in batches:
            label = batch.column(1).to_numpy()
            for low, part, at in restored(batch.column(2), decoder):
                hashes, owners, words = features(part, at, joined=True)
                own = label[low : low + len(words)]
                found = model.value.evidence(hashes, owners, len(words), own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array(words.astype(np.int64)), pa.array(own.astype(np.int64))],
                    names=["evidence", "words", "label"],
                )

    points = rows.mapInArrow(left_out, "evidence double, words bigint, label bigint").toArrow()
    if n_toxic == 0 or n_clean == 0:
        curve = np.array([50.0 if n_toxic else -50.0, 0.0, 0.0])
    else:
        columns = [points.column(c).to_numpy() for c in ("evidence", "words", "label")]
        order = np.lexsort(columns)  # the same sums whatever the order of tasks
        curve = fit_curve(*(c[order] for c in columns))
    return Model(known.keys, known.toxic, known.clean, n_toxic, n_clean, curve)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    keep: list[Column] | None = None,
    max_rows: int = 20_000,
    min_z: float = 2.5,
    max_features: int = 50_000,
) -> DataFrame:
    """Probability that ``label`` is 1, for every whole text; ``predicted`` is 1 from 0.5 on.

    A character language model is counted over all texts. Words with signs for letters or of
    signs alone, single letters or signs apart and words with a letter twice in a row are
    decoded by a Viterbi search for the likeliest reading under that model, the signs,
    repetitions and separators having a cost each, and signs left as they are as well. Where two
    or three neighbouring words joined make a word the classifier knows, it counts too. The
    restored words and their beginnings are scored by log odds of document counts, and a
    logistic curve turns their sum into a probability; it is fitted with each text left out
    of its own counts. The classifier learns from the labelled rows that ``learn`` admits, at
    most ``max_rows`` of them, picked by a hash of the key, and keeps at most ``max_features``
    features of at least ``min_z`` standard errors; so all that is broadcast has a bound.

    A null or empty text has no evidence and gets a score by its length alone. A key with
    several labels counts as toxic if one of them says so; without labelled rows every score
    is 0. Rows with a null key are scored, never learnt from; repeated rows are scored alike;
    an empty table gives no rows.
    """
    characters = character_model(docs, text)
    known = train(docs, labels, learn, key, text, label, characters, max_rows, min_z, max_features)
    model = docs.sparkSession.sparkContext.broadcast((characters, known))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs, fitted = model.value
        decoder = Decoder(signs)
        for batch in batches:
            parts = [np.empty(0)]
            for _, part, at in restored(batch.column(batch.num_columns - 1), decoder):
                hashes, owners, words = features(part, at, joined=True)
                parts.append(fitted.score(fitted.evidence(hashes, owners, len(words)), words))
            value = np.concatenate(parts)
            columns = [*batch.columns[:-1], pa.array(value), pa.array((value >= 0.5).astype(np.int32))]
            names = [*batch.schema.names[:-1], "score", "predicted"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(*(keep or [F.col(key)]), F.col(text).alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(score, f"{fields}, score double, predicted int")
