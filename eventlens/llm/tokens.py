"""Token ids of whole texts, by the tokenizers library behind a word table.

``words`` finds the pre-tokenizer's words of a block of texts; the
library's merge model encodes each word it has not met, and its ids stay
in a bounded open-addressing table of numpy arrays, one per worker.  A
word is found by its bytes themselves (a hash only says where to look),
so the ids are the library's for every text.  Texts with special strings
go to the library whole.
"""

from __future__ import annotations

import os

import numpy as np

from .words import SEP, WordStarts, byte_letters

#: Longest word kept (bytes), words kept, and the text encoded at a time.
KEEP, MAX_WORDS, GROUP_CHARS = 24, 1_000_000, 1 << 20
_SLOT_BITS = 22
#: Bytes of a key that belong to a word of each length.
_MASK = ((np.arange(KEEP) < np.arange(KEEP + 1)[:, None]) * np.uint8(255)).view(np.uint64)
_WORKER: dict[str, "Encoder"] = {}


def _hash(key: np.ndarray, size: np.ndarray) -> np.ndarray:
    h = size.astype(np.uint64)
    for k in range(key.shape[1]):
        h = (h ^ key[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        # Spark runs one task per core; the library's own threads would compete with them
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tokenizer.model)
        self.starts = WordStarts(path)
        letter = {b: c for c, b in byte_letters().items()}
        self.letters = {b: letter[b] for b in range(256)}
        vocabulary = self.tokenizer.get_vocab()
        # a token of the byte-level vocabulary has one letter per byte
        self.size = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.size[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._clear()

    def _clear(self) -> None:
        self.slot = np.full(1 << _SLOT_BITS, -1, np.int32)
        self.key = np.zeros((1 << 14, KEEP // 8), np.uint64)
        self.length = np.zeros(1 << 14, np.int64)
        self.first = np.zeros(1 << 14, np.int64)
        self.count = np.zeros(1 << 14, np.int64)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.words = self.n_ids = 0

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = []
        lo, size = 0, 0
        for i, t in enumerate(texts):
            size += len(t or "")
            if size > GROUP_CHARS or i == len(texts) - 1:
                out += self._encode([t or "" for t in texts[lo:i + 1]])
                lo, size = i + 1, 0
        return out

    def _encode(self, texts: list[str]) -> list[bytes]:
        whole = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        by_library = {i: np.array(e.ids, "<u4").tobytes() for i, e in zip(
            whole, self.tokenizer.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False))}
        joined = "".join([SEP if i in by_library else t + SEP for i, t in enumerate(texts)])
        data = np.frombuffer(joined.encode("utf-8", "surrogatepass") + b"\0" * KEEP, np.uint8)
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        heads = np.flatnonzero((data[:len(data) - KEEP] & 0xC0) != 0x80)
        at = heads[self.starts.run(chars)]
        size = np.diff(np.append(at, len(data) - KEEP))
        seps = heads[chars == ord(SEP)]
        apart = np.searchsorted(at, seps)  # a separator is a word of its own
        kept = np.ones(len(at), bool)
        kept[apart] = False
        ids, ends = self._ids(data, at[kept], size[kept])
        doc_ends = np.append(0, ends)[apart - np.arange(len(apart))]
        raw = ids.astype("<u4", copy=False).tobytes()
        lo, out = 0, []
        for i, hi in enumerate((4 * doc_ends).tolist()):
            out.append(by_library[i] if i in by_library else raw[lo:hi])
            lo = hi
        return out

    def _ids(self, data: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, end of each word's ids) of the words at ``at``."""
        if self.words > MAX_WORDS:
            self._clear()
        first, count = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        short = np.flatnonzero(size <= KEEP)
        n = size[short]
        eight = np.lib.stride_tricks.sliding_window_view(data, 8)
        key = np.stack([eight[at[short] + k].view(np.uint64)[:, 0] for k in range(0, KEEP, 8)], 1) & _MASK[n]
        h = _hash(key, n)
        entry = self._find(h, key, n)
        missing = np.flatnonzero(entry < 0)
        while len(missing):
            _, new = np.unique(h[missing], return_index=True)
            new = missing[new]
            self._add(h[new], key[new], n[new], self._ask(data, at[short[new]], n[new]))
            entry[missing] = self._find(h[missing], key[missing], n[missing])
            missing = missing[entry[missing] < 0]  # another word of the same hash
        first[short], count[short] = self.first[entry], self.count[entry]
        long = np.flatnonzero(size > KEEP)
        held = self.n_ids
        if len(long):
            first[long], count[long] = self._ask(data, at[long], size[long])
        ends = np.cumsum(count)
        ids = self.ids[np.repeat(first - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]
        self.n_ids = held  # long words are not kept
        return ids, ends

    def _find(self, h: np.ndarray, key: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Entry of each word, or -1: linear probing, all words at once."""
        entry = np.full(len(h), -1, np.int64)
        open_, at = np.arange(len(h)), (h >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        while len(open_):
            e = self.slot[at]
            used = e >= 0
            open_, at, e = open_[used], at[used], e[used]
            hit = (self.length[e] == n[open_]) & (self.key[e] == key[open_]).all(axis=1)
            entry[open_[hit]] = e[hit]
            open_, at = open_[~hit], at[~hit] + 1 & (1 << _SLOT_BITS) - 1
        return entry

    def _add(self, h: np.ndarray, key: np.ndarray, n: np.ndarray, ids: tuple[np.ndarray, np.ndarray]) -> None:
        lo, hi = self.words, self.words + len(h)
        while hi > len(self.length):
            for name in ("key", "length", "first", "count"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros_like(old)]))
        self.key[lo:hi], self.length[lo:hi] = key, n
        self.first[lo:hi], self.count[lo:hi] = ids
        self.words = hi
        entry, at = np.arange(lo, hi), (h >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        while len(entry):
            free = np.flatnonzero(self.slot[at] < 0)
            _, one = np.unique(at[free], return_index=True)
            one = free[one]
            self.slot[at[one]] = entry[one]
            left = np.ones(len(entry), bool)
            left[one] = False
            entry, at = entry[left], at[left] + 1 & (1 << _SLOT_BITS) - 1

    def _ask(self, data: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, count) of the ids that the library's model gives each word."""
        raw = data.tobytes() if len(at) > 64 else data
        text = [bytes(raw[s:e]).decode("latin-1").translate(self.letters) for s, e in zip(at.tolist(), (at + size).tolist())]
        ids = np.array(self.model.encode(text, is_pretokenized=True, add_special_tokens=False).ids, np.uint32)
        ends = np.searchsorted(np.cumsum(self.size[ids]), np.cumsum(size)) + 1
        while self.n_ids + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.n_ids:self.n_ids + len(ids)] = ids
        starts = np.append(0, ends[:-1])
        place = self.n_ids + starts
        self.n_ids += len(ids)
        return place, ends - starts


def encoder(path: str) -> Encoder:
    """The worker's encoder of this tokenizer file."""
    if path not in _WORKER:
        _WORKER[path] = Encoder(path)
    return _WORKER[path]
