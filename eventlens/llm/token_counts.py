"""Token counts by a byte-level BPE tokenizer compiled to finite-state transducers.

Two deterministic transducers run one after the other:

*Words.*  Over character classes (letter, number, white space, ...; the
letters of the contractions apart), it marks where the pre-tokenizer
starts a word.  Decisions that need the next character are emitted one
character late.  A text is cut into chunks; a chunk's state map says, for
every state it may start in, the state it ends in.  Maps compose through
a parallel prefix scan, which gives every chunk its true start, and all
chunks step together as lanes.

*Tokens.*  Over bytes, from a start state at each word.  Greedy merging
by rank has two properties that make it finite-state: dropping the last
token of a word's encoding leaves the encoding of the shorter word, and
a sequence is an encoding exactly if each adjacent pair is the encoding
of its own bytes.  So a state holds, for each suffix of the bytes so far
that begins some token, the token before that suffix and the difference
of token counts; reading a byte extends the suffixes, and the one that
is a token compatible with its left neighbour is the new last token.
Each transition carries the change of the token count (it can be
negative: merging shortens).  Transitions are compiled when a text first
needs them and kept in a bounded table per worker, as lazy automata do.

The counts are sums of the emitted changes, so no id is ever produced.

Defined results: null or empty text has no bytes and no tokens; special
strings inside a text count one token each, as the library has it.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common
from .words import SEP, SPACE_CHARS, WordStarts, byte_letters

CHUNK = 256
BLOCK_CHARS = 1 << 20
MAX_CELLS = 32_000_000
_NEVER = 1 << 60
#: Lanes from which stepping all at once is worth it; fewer (long unbroken words) run one by one.
FEW = 24


class TokenTransducer:
    """Lazily compiled transducer over the bytes of words."""

    START = 1

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"] or {}, spec["model"]
        if (spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True)
                or model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges")):
            raise ValueError("only a byte-level BPE tokenizer with the standard word pattern can be compiled")
        letters = byte_letters()
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.rank: dict[tuple[bytes, bytes], int] = {}
        self.made: dict[bytes, int] = {}
        for i, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.rank[bytes(letters[c] for c in a), bytes(letters[c] for c in b)] = i
        self.child: dict[int, int] = {}
        self.token: dict[int, bytes] = {}
        # right and left spine of each token: its outer parts, with the rank at which the next larger part takes them up
        self.right = {bytes([b]): [(bytes([b]), _NEVER)] for b in range(256)}
        self.left = {bytes([b]): [(bytes([b]), _NEVER)] for b in range(256)}
        for (a, b), r in self.rank.items():
            if a not in self.right or b not in self.right or max(self.made.get(a, -1), self.made.get(b, -1)) > r:
                raise ValueError("the merges are not in the order of a trained vocabulary")
            if a + b in self.made:
                continue  # made by an earlier merge
            self.made[a + b] = r
            self.right[a + b] = [(a + b, _NEVER), (b, r), *self.right[b][1:]]
            self.left[a + b] = [(a + b, _NEVER), (a, r), *self.left[a][1:]]
        names = list(self.right)
        nodes = 1
        for t in names:
            at = 0
            for b in t:
                key = at * 256 + b
                if key not in self.child:
                    self.child[key] = nodes
                    nodes += 1
                at = self.child[key]
            self.token[at] = t
        # tokens that continue each node
        self.below: list[list[bytes]] = [[] for _ in range(nodes)]
        for t in names:
            at = 0
            for b in t:
                self.below[at].append(t)
                at = self.child[at * 256 + b]
        self.reset()

    def reset(self) -> None:
        self.column = np.full(256, -1, np.int64)
        self.columns, self.width = 0, 64
        self._forget(None)

    def _forget(self, state: int | None) -> int:
        """Drop all transitions; the columns stay.  Returns the new number of ``state``."""
        kept = None if state is None else self.states[state]
        self.table = np.zeros(1024 * self.width, np.int32)
        self.states = [(), ((0, b"", 0),)]
        self.number = {self.states[1]: self.START}
        self.open: dict[tuple[int, bytes], bool] = {}
        return self.START if kept is None else self._number(kept)

    def _number(self, state: tuple) -> int:
        """The number of a state, a new one where it has none."""
        number = self.number.get(state)
        if number is None:
            number = self.number[state] = len(self.states)
            self.states.append(state)
            if len(self.states) * self.width > len(self.table):
                self.table = np.concatenate([self.table, np.zeros(len(self.table), np.int32)])
        return number

    def _fits(self, left: bytes, token: bytes) -> bool:
        """Whether the two tokens are the encoding of their bytes: no part at
        the end of one merges with a part at the start of the other before a
        larger part takes it up (of equal ranks the leftmost merges first)."""
        rank = self.rank
        ends = self.left[token]
        for x, until_x in self.right[left]:
            for y, until_y in ends:
                r = rank.get((x, y))
                if r is not None and r < until_x and r <= until_y:
                    return False
        return True

    def _open(self, node: int, left: bytes) -> bool:
        """Whether some longer token from here can stand after ``left``."""
        key = (node, left)
        known = self.open.get(key)
        if known is None:
            known = self.open[key] = bool(self.below[node]) and (not left or any(self._fits(left, t) for t in self.below[node]))
        return known

    def _step(self, state: int, byte: int) -> int:
        """The transition as next state * 512 + change of the count + 256."""
        grown, last = [], None
        for node, left, d in self.states[state]:
            to = self.child.get(node * 256 + byte)
            if to is not None:
                if self._open(to, left):
                    grown.append((to, left, d))
                t = self.token.get(to)
                if t is not None and last is None and (not left or self._fits(left, t)):
                    last = (t, d + 1)
        t, change = last
        # only suffixes that some token continues matter
        new = ((0, t, 0), *((node, left, d - change) for node, left, d in grown))
        return self._number(new) * 512 + change + 256

    def _columns(self, data: np.ndarray) -> np.ndarray:
        """Dense column of each byte; the table widens for bytes not met before."""
        for b in np.flatnonzero(np.bincount(data, minlength=256)):
            if self.column[b] < 0:
                if self.columns == self.width:
                    wide = np.zeros((len(self.table) // self.width, 2 * self.width), np.int32)
                    wide[:, :self.width] = self.table.reshape(-1, self.width)
                    self.table, self.width = wide.reshape(-1), 2 * self.width
                self.column[b] = self.columns
                self.columns += 1
        return self.column[data]

    def run(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Change of the token count at each byte; ``starts`` marks the words."""
        if len(self.table) > MAX_CELLS:
            self.reset()
        columns = self._columns(data)
        byte_of = np.zeros(self.width, np.int64)
        met = np.flatnonzero(self.column >= 0)
        byte_of[self.column[met]] = met
        at = np.flatnonzero(starts)
        # lanes of whole words, longest first
        first = at[np.unique(np.searchsorted(at, np.arange(0, len(data), CHUNK)).clip(0, len(at) - 1))]
        length = np.diff(np.append(first, len(data)))
        by = np.argsort(-length, kind="stable")
        first, length = first[by], length[by]
        change = np.empty(len(data), np.int16)
        state = np.full(len(first), self.START, np.int64)
        shorter = -length
        for t in range(int(length[0])):
            n = int(np.searchsorted(shorter, -t))
            if n <= FEW:
                # by what they hold: a lane may drop the table, and with it the numbers of the others
                held = [self.states[s] for s in state[:n].tolist()]
                for lo, size, s in zip(first[:n].tolist(), length[:n].tolist(), held):
                    self._alone(columns[lo + t:lo + size], starts[lo + t:lo + size], self._number(s), byte_of, change[lo + t:lo + size])
                break
            pos = first[:n] + t
            state = state[:n]
            state[starts[pos]] = self.START
            cell = state * self.width + columns[pos]
            value = self.table[cell]
            missing = np.flatnonzero(value == 0)
            if len(missing):
                for c in np.unique(cell[missing]).tolist():
                    self.table[c] = self._put(c, byte_of)
                value = self.table[cell]
            state = (value >> 9).astype(np.int64)
            change[pos] = (value & 511) - 256
        return change

    def _alone(self, columns: np.ndarray, starts: np.ndarray, state: int, byte_of: np.ndarray, change: np.ndarray) -> None:
        """One lane, byte by byte, from a state."""
        out = []
        for lo in range(0, len(columns), 1 << 16):
            if len(self.table) > MAX_CELLS:  # a word may meet new states all along
                state = self._forget(state)
            for c, start in zip(columns[lo:lo + (1 << 16)].tolist(), starts[lo:lo + (1 << 16)].tolist()):
                cell = (self.START if start else state) * self.width + c
                value = self.table.item(cell)
                if not value:
                    value = self.table[cell] = self._put(cell, byte_of)
                state = value >> 9
                out.append((value & 511) - 256)
            change[lo:lo + len(out)] = out
            out.clear()

    def _put(self, cell: int, byte_of: np.ndarray) -> int:
        return self._step(cell // self.width, int(byte_of[cell % self.width]))


class Counter:
    """Token counts of texts."""

    def __init__(self, path: str):
        self.words = WordStarts(path)
        self.tokens = TokenTransducer(path)
        self.special = re.compile("|".join(map(re.escape, sorted(self.tokens.special, key=len, reverse=True)))) if self.tokens.special else None

    def count(self, texts: list[str]) -> list[int]:
        """Counts of a block of texts."""
        total = [0] * len(texts)
        body = []
        for i, t in enumerate(texts):
            if self.special and "<" in t or self.special and self.special.pattern[0] != "<":
                t, total[i] = self.special.subn(SEP, t)
            body.append(t)
        joined = SEP.join(body) + SEP
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        starts = np.zeros(len(data), bool)
        starts[heads] = self.words.run(chars)
        change = self.tokens.run(data, starts)
        parting = heads[chars == ord(SEP)]
        for k in range(3):
            change[parting + k] = 0
        size = np.array([len(t.encode("utf-8", "surrogatepass")) + 3 for t in body])
        sums = np.add.reduceat(change, np.cumsum(size) - size, dtype=np.int64)
        return [n + s for n, s in zip(total, sums.tolist())]


_AFTER_WORD = re.compile(f"(?<=[^{SPACE_CHARS}])[{SPACE_CHARS}]")
_WORKER: dict[str, Counter] = {}


def _cuts(text: str, limit: int = BLOCK_CHARS) -> list[str]:
    """A long text in pieces that count on their own: cut where white space follows a word."""
    out, lo = [], 0
    while len(text) - lo > limit:
        m = _AFTER_WORD.search(text, lo + limit)
        if not m:
            break
        out.append(text[lo:m.start()])
        lo = m.start()
    out.append(text[lo:])
    return out


def count_texts(path: str, texts: list[str | None]) -> list[int]:
    """Token counts, by the worker's transducers of this tokenizer file."""
    if path not in _WORKER:
        _WORKER[path] = Counter(path)
    counter = _WORKER[path]
    pieces = [(i, p) for i, t in enumerate(texts) for p in _cuts(t or "")]
    out, held, size = [0] * len(texts), [], 0
    for k, (i, p) in enumerate(pieces):
        held.append((i, p))
        size += len(p)
        if size > BLOCK_CHARS or k == len(pieces) - 1:
            for (j, _), n in zip(held, counter.count([p for _, p in held])):
                out[j] += n
            held, size = [], 0
    return out


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per input row."""
    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = b.column("text")
        sizes = [len(t.encode()) if t else 0 for t in texts.to_pylist()]
        n = [c for lo, hi in common.text_spans(texts) for c in count_texts(tokenizer, texts.slice(lo, hi - lo).to_pylist())]
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return common.id_text(docs).mapInArrow(common.per_batch(batch), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
