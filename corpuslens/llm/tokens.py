"""Token ids of whole texts by a public tokenizer, with a cache of words.

The tokenizer drops white space and never looks across it, so a text is cut at ASCII white
space and, where an ASCII letter is followed by one of ``.,;:?!``, before that sign. What lies
between is encoded once per distinct piece and worker and then looked up by a 64-bit hash.
"""

import os
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa

from corpuslens.llm import textbuf

# Distinct pieces remembered per Python worker, about 70 bytes each; beyond it the cache
# starts anew.
CACHE_PIECES = 1_000_000

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_SIGN = np.zeros(256, dtype=bool)
_SIGN[[ord(c) for c in ".,;:?!"]] = True


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def load(path: str):
    """A tokenizer that runs in the calling thread only: Spark has one task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def pieces(part: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every piece of ``part``, and for every text its first piece."""
    inside = ~textbuf.SPACES[part]
    first = np.zeros(len(part) + 1, dtype=bool)
    first[offsets] = True
    first[1:-1] |= _LETTER[part[:-1]] & _SIGN[part[1:]]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends[:-1] &= ~inside[1:] | first[1:-1]
    start = np.flatnonzero(starts)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets)


def folded(part: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A-Z in lower case, but for pieces with bytes beyond ASCII, where lower case and
    composition of characters do not commute, and with ``<``, where it could make a special
    token."""
    out = textbuf.LOWER[part]
    odd = np.flatnonzero((part >= 128) | (part == 60))
    if len(odd):
        raw = np.zeros(len(start), dtype=bool)
        at = np.searchsorted(start, odd, "right") - 1
        raw[at] = True
        back = textbuf.ranges(start[raw], end[raw] - start[raw])
        out[back] = part[back]
    return out


def _is_plain(text: str) -> bool:
    """Whether normalization leaves the text alone and it is one word."""
    return text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text)


class _Words:
    """The same model without normalization and patterns, for plain words between spaces."""

    def __init__(self, path: str):
        from tokenizers import normalizers, pre_tokenizers

        self.tokenizer = load(path)
        self.tokenizer.normalizer = normalizers.Sequence([])
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids


class Encoder:
    """Encodes texts; keeps the hashes of known pieces in an open hash table and all their
    ids in one flat array."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.words = _Words(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.clear()

    def clear(self):
        self.size = 0
        self.bits = np.uint64(64 - 16)
        self.keys = np.zeros(1 << 16, dtype=np.uint64)  # 0: free
        self.at = np.zeros(1 << 16, dtype=np.uint32)
        self.count = np.zeros(1 << 16, dtype=np.uint16)
        self.flat = np.empty(1 << 16, dtype=np.uint32)
        self.used = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of every key, or -1."""
        mask = np.uint64(len(self.keys) - 1)
        slot = (keys >> self.bits).astype(np.int64)
        seen = self.keys[slot]
        found = np.where(seen == keys, slot, -1)
        left = np.flatnonzero((seen != keys) & (seen != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & int(mask)
            seen = self.keys[slot[left]]
            hit = seen == keys[left]
            found[left[hit]] = slot[left[hit]]
            left = left[~hit & (seen != 0)]
        return found

    def put(self, keys: np.ndarray, at: np.ndarray, count: np.ndarray):
        """Enter distinct keys that are not there yet."""
        mask = len(self.keys) - 1
        slot = (keys >> self.bits).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.keys[slot[left]] == 0]
            self.keys[slot[free]] = keys[free]
            won = free[self.keys[slot[free]] == keys[free]]
            self.at[slot[won]], self.count[slot[won]] = at[won], count[won]
            done = np.zeros(len(keys), dtype=bool)
            done[won] = True
            left = left[~done[left]]
            slot[left] = (slot[left] + 1) & mask

    def learn(self, keys, part, start, end):
        """Encode pieces that are not known yet."""
        if 2 * (self.size + len(keys)) > len(self.keys):
            old = self.keys, self.at, self.count
            slots = 1 << int(2 * (self.size + len(keys))).bit_length()
            self.bits = np.uint64(65 - slots.bit_length())
            self.keys = np.zeros(slots, dtype=np.uint64)
            self.at = np.zeros(slots, dtype=np.uint32)
            self.count = np.zeros(slots, dtype=np.uint16)
            full = old[0] != 0
            self.put(*(x[full] for x in old))
        raw = part.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(start.tolist(), end.tolist())]
        plain = np.fromiter(map(_is_plain, texts), dtype=bool, count=len(texts))
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        keys, texts = keys[order], [texts[i] for i in order.tolist()]
        n = int(plain.sum())
        words = np.array(self.words.encode(" ".join(texts[:n])), dtype=np.uint32)
        ends = np.flatnonzero(self.ends_word[words])
        if len(ends) != n:  # not one word each after all
            words, ends, n = words[:0], ends[:0], 0
        rest = self.tokenizer.encode_batch_fast(texts[n:], add_special_tokens=False)
        rest = [e.ids for e in rest]
        count = np.concatenate([np.diff(ends, prepend=-1), [len(x) for x in rest]]).astype(np.int64)
        total = int(count.sum())
        if self.used + total > len(self.flat):
            grown = np.empty(5 * (self.used + total) // 4, dtype=np.uint32)
            grown[: self.used] = self.flat[: self.used]
            self.flat = grown
        self.flat[self.used : self.used + len(words)] = words
        self.flat[self.used + len(words) : self.used + total] = np.fromiter(
            chain.from_iterable(rest), dtype=np.uint32, count=total - len(words)
        )
        self.put(keys, self.used + np.cumsum(count) - count, count)
        self.used += total
        self.size += len(keys)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the place of the first id of each text."""
        low = int(offsets[0])
        part, offsets = data[low : int(offsets[-1])], offsets - low
        start, end, first = pieces(part, offsets)
        if len(start) == 0:
            return np.empty(0, dtype=np.uint32), np.zeros(len(offsets), dtype=np.int64)
        keys = textbuf.word_hashes(folded(part, start, end), start, end, lower=False)
        keys |= np.uint64(1)  # 0 marks a free slot
        # a piece too long for the table of counts is encoded each time
        long = np.flatnonzero(end - start > 60_000)
        slot = self.find(keys)
        slot[long] = 0
        if (slot < 0).any():
            new = np.flatnonzero(slot < 0)
            distinct, example = np.unique(keys[new], return_index=True)
            if self.size + len(distinct) > CACHE_PIECES:
                self.clear()
                new = np.setdiff1d(np.arange(len(keys)), long)
                distinct, example = np.unique(keys[new], return_index=True)
            self.learn(distinct, part, start[new[example]], end[new[example]])
            slot = self.find(keys)
        at, count = self.at[slot].astype(np.int64), self.count[slot].astype(np.int64)
        flat = self.flat
        if len(long):
            texts = [part[start[i] : end[i]].tobytes().decode() for i in long]
            extra = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
            count[long] = [len(x) for x in extra]
            at[long] = self.used + np.cumsum(count[long]) - count[long]
            flat = np.concatenate([flat[: self.used], *(np.array(x, np.uint32) for x in extra)])
        ids = flat[textbuf.ranges(at, count)]
        total = np.concatenate([[0], np.cumsum(count)])
        return ids, total[first]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_column(column: pa.Array, path: str, end_id: int | None):
    """Per group of texts: number of its first text, ids, and where each text begins.

    ``end_id`` is put behind every text.
    """
    data, offsets = textbuf.column_bytes(column)
    known = encoder(path)
    for low, high in textbuf.groups(offsets, 2 * textbuf.GROUP_BYTES):
        ids, first = known.encode(data, offsets[low : high + 1])
        if end_id is not None:
            ids = np.insert(ids, first[1:], np.uint32(end_id))
            first = first + np.arange(len(first))
        yield low, ids, first
