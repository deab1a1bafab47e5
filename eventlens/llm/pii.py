"""Personal data: base patterns, and spans added by a BiLSTM-CRF over characters.

The base patterns find email, ip, card and phone spans as stated by the
contract.  The tagger is a character-level bidirectional LSTM with CRF
transitions, written and trained in numpy: its labelled spans are base
spans of a bounded sample of documents and rewritten variants of them
(other separators, a missing ``+``, ``[at]`` for ``@``), so it learns
forms that the patterns cannot name.

Texts are tagged in overlapping windows: a window has a core of ``CORE``
characters and context on both sides; windows of many documents run as
one batch of lanes.  A window answers for spans that begin in its core,
and the spans of all windows of a document are then reconciled together:
base spans stay, an added one must pass its kind's plain check (digits,
Luhn, numbers up to 255, an at-mark and a dot) and overlap no span
already taken, longer spans first.  Every check asks for a digit or an
``@[(`` in the span, so a window without one after its core's start is
not run: it could not add anything.

Defined results: null or empty text has no spans; without any labelled
span there is no tagger and the base patterns decide alone.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

KINDS = ["email", "ip", "card", "phone"]
LEFT, CORE, RIGHT = 32, 64, 64
WIDTH = LEFT + CORE + RIGHT
SAMPLE = 600
HIDDEN = 8
LANES = 2048
Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a run of digits fails or matches as a whole, so only its start is tried
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NUMBER = re.compile("[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(_NUMBER.findall(s))


def _card(s: str) -> bool:
    d = _digits(s)
    return 12 <= len(d) <= 19 and luhn(d)


def _byte(digits: str) -> bool:
    """Whether a number, however many zeros it begins with, is at most 255."""
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def base_spans(text: str | None) -> list[Span]:
    """Leftmost non-overlapping matches per kind, by start, then kind as listed."""
    text = text or ""
    out: list[Span] = []
    cursor = 0
    at = text.find("@")
    while at >= 0:  # a match can only run through the next @
        start = at
        while start > cursor and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            cursor = m.end()
        at = text.find("@", max(at + 1, cursor))
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(_byte(p) for p in m[0].split("."))]
        out += [("card", *m.span()) for m in _CARD.finditer(text) if _card(m[0])]
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def named(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


# ---- what an added span must look like -------------------------------------------------

_AT = re.compile(r"@| ?[\[(] ?at ?[\])] ?", re.I)
_DOT = re.compile(r"\.| ?[\[(] ?dot ?[\])] ?", re.I)


def plausible(kind: str, s: str) -> bool:
    """Plain check of an added span; each asks for a digit or an at-mark."""
    if "\n" in s or s != s.strip():
        return False
    d = _digits(s)
    if kind == "email":
        parts = _AT.split(s)
        return len(parts) == 2 and all(parts) and bool(_DOT.search(parts[1])) and " " not in _DOT.sub("", "".join(parts)) and len(s) >= 8
    if any(c.isalpha() for c in s):
        return False
    if kind == "ip":
        numbers = _NUMBER.findall(s)
        return len(numbers) == 4 and all(len(n) <= 3 and _byte(n) for n in numbers) and "." in s
    if kind == "card":
        return _card(s) and s[0].isdigit() and s[-1].isdigit()
    return 10 <= len(d) <= 15 and len(_NUMBER.findall(s)) >= 3 and s[-1].isdigit() and (s[0] in "+(" or s[0].isdigit())


# ---- the tagger ------------------------------------------------------------------------

_MARKS = " \n@.-+()[]_%/:,"
PAD, DIGIT, LOWER, UPPER, WIDE, OTHER = range(6)
VOCABULARY = 6 + len(_MARKS) + 4
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind


def _symbols() -> np.ndarray:
    table = np.full(256, OTHER, np.uint8)
    table[ord("0"):ord("9") + 1] = DIGIT
    table[ord("a"):ord("z") + 1] = LOWER
    table[ord("A"):ord("Z") + 1] = UPPER
    for i, c in enumerate(_MARKS):
        table[ord(c)] = 6 + i
    for i, c in enumerate("atdo"):  # letters of the spelled-out marks
        table[ord(c)] = 6 + len(_MARKS) + i
    table[128:] = WIDE
    return table


_SYMBOL = _symbols()


def encode(text: str) -> np.ndarray:
    return _SYMBOL[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).clip(0, 255)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class Tagger:
    """Weights by name: ``w``/``u`` of each direction, output ``o``/``b``, transitions ``t``."""

    p: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int = 0) -> "Tagger":
        rng = np.random.default_rng(seed)
        p = {}
        for side in "fb":
            w = rng.normal(0, 0.3, (VOCABULARY, 4 * HIDDEN))
            w[:, HIDDEN:2 * HIDDEN] += 1  # remember at first
            p["w" + side], p["u" + side] = w, rng.normal(0, 0.3, (HIDDEN, 4 * HIDDEN))
        p["o"], p["b"] = rng.normal(0, 0.3, (2 * HIDDEN, TAGS)), np.zeros(TAGS)
        p["t"] = np.zeros((TAGS, TAGS))
        return Tagger({k: v.astype(np.float32) for k, v in p.items()})

    def _direction(self, x: np.ndarray, side: str, keep: bool):
        """Hidden states (T, lanes, HIDDEN) of one direction, with what backpropagation needs."""
        w, u = self.p["w" + side], self.p["u" + side]
        T, lanes = x.shape
        h = np.zeros((lanes, HIDDEN), np.float32)
        c = np.zeros_like(h)
        out = np.empty((T, lanes, HIDDEN), np.float32)
        saved = []
        for t in range(T) if side == "f" else range(T - 1, -1, -1):
            z = w[x[t]] + h @ u
            ifo = _sigmoid(z[:, :3 * HIDDEN])
            i, f, o = ifo[:, :HIDDEN], ifo[:, HIDDEN:2 * HIDDEN], ifo[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            before, c = c, f * c + i * g
            tc = np.tanh(c)
            if keep:
                saved.append((t, h, before, i, f, o, g, tc))
            h = o * tc
            out[t] = h
        return out, saved

    def scores(self, x: np.ndarray, keep: bool = False):
        f, sf = self._direction(x, "f", keep)
        b, sb = self._direction(x, "b", keep)
        h = np.concatenate([f, b], axis=2)
        return h @ self.p["o"] + self.p["b"], (h, sf, sb)

    def _back(self, x: np.ndarray, side: str, dh: np.ndarray, saved: list, grad: dict) -> None:
        u = self.p["u" + side]
        dw, du = np.zeros_like(self.p["w" + side]), np.zeros_like(u)
        next_h = np.zeros(dh.shape[1:], np.float32)
        next_c = np.zeros_like(next_h)
        for t, h, before, i, f, o, g, tc in reversed(saved):
            d = dh[t] + next_h
            dc = next_c + d * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), d * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            np.add.at(dw, x[t], dz)
            du += h.T @ dz
            next_h, next_c = dz @ u.T, dc * f
        grad["w" + side], grad["u" + side] = dw, du

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Negative log-likelihood of tags ``y`` per lane, and its gradients."""
        s, (h, sf, sb) = self.scores(x, True)
        T, lanes, _ = s.shape
        t = self.p["t"]
        a = np.empty_like(s)
        a[0] = s[0]
        for k in range(1, T):
            a[k] = s[k] + _log_sum(a[k - 1][:, :, None] + t, 1)
        z = _log_sum(a[-1], 1)
        b = np.zeros_like(s)
        dt = np.zeros_like(t)
        for k in range(T - 2, -1, -1):
            after = s[k + 1] + b[k + 1]
            b[k] = _log_sum(t[None] + after[:, None, :], 2)
            dt += np.exp(a[k][:, :, None] + t + after[:, None, :] - z[:, None, None]).sum(axis=0)
        ds = np.exp(a + b - z[None, :, None])
        lane = np.arange(lanes)
        gold = s[np.arange(T)[:, None], lane, y].sum(axis=0) + t[y[:-1], y[1:]].sum(axis=0)
        ds[np.arange(T)[:, None], lane, y] -= 1
        np.add.at(dt, (y[:-1], y[1:]), -1)
        ds, dt = ds / lanes, dt / lanes
        grad = {"t": dt, "o": np.einsum("tlh,tlk->hk", h, ds), "b": ds.sum(axis=(0, 1))}
        dh = ds @ self.p["o"].T
        self._back(x, "f", dh[:, :, :HIDDEN], sf, grad)
        self._back(x, "b", dh[:, :, HIDDEN:], sb, grad)
        return float((z - gold).mean()), grad

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Best tags (T, lanes) by Viterbi."""
        s, _ = self.scores(x)
        T, lanes, _ = s.shape
        best, back = s[0], np.empty(s.shape, np.int8)
        for k in range(1, T):
            step = best[:, :, None] + self.p["t"]
            back[k] = step.argmax(axis=1)
            best = step.max(axis=1) + s[k]
        y = np.empty((T, lanes), np.int8)
        y[-1] = best.argmax(axis=1)
        for k in range(T - 1, 0, -1):
            y[k - 1] = back[k][np.arange(lanes), y[k]]
        return y


def tags(length: int, spans: list[Span]) -> np.ndarray:
    y = np.zeros(length, np.int64)
    for kind, s, e in spans:
        k = 1 + 2 * KINDS.index(kind)
        y[s:e] = k + 1
        y[s] = k
    return y


def variant(kind: str, s: str, rng: np.random.Generator) -> str:
    """A labelled span rewritten in a form that the base patterns do not know."""
    if kind == "email":
        at, dot = [(" [at] ", " [dot] "), ("[at]", "."), (" (at) ", "."), ("(at)", "(dot)")][rng.integers(4)]
        user, host = s.split("@", 1)
        return user + at + host.replace(".", dot)
    if kind == "ip":
        return s.replace(".", ["[.]", "(.)"][rng.integers(2)])
    d = _digits(s)
    if kind == "card":
        sep = ["." , "_", "/"][rng.integers(3)]
        return sep.join(d[i:i + 4] for i in range(0, len(d), 4))
    a, b, c = d[-10:-7], d[-7:-4], d[-4:]
    return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}", f"({a}) {b} {c}"][rng.integers(5)] if len(d) >= 10 else s


def fit(samples: list[tuple[str, int, int, str]], steps: int = 220, batch: int = 96, seed: int = 0) -> Tagger | None:
    """Train on (kind, start, end, text) windows; kind '' marks a window without spans."""
    if not any(k for k, *_ in samples):
        return None
    rng = np.random.default_rng(seed)
    x, y = [], []
    for kind, s, e, text in samples:
        rows = [(text, [(kind, s, e)] if kind else [])]
        if kind:
            v = variant(kind, text[s:e], rng)
            rows.append((text[:s] + v + text[e:], [(kind, s, s + len(v))]))
        for t, spans in rows:
            spans = [z for z in spans if z[2] <= WIDTH] + [z for z in base_spans(t[:WIDTH]) if not any(z[1] < q[2] and q[1] < z[2] for q in spans)]
            row = np.zeros(WIDTH, np.uint8)
            ids = encode(t)[:WIDTH]
            row[:len(ids)] = ids
            x.append(row)
            y.append(tags(WIDTH, spans))
    x, y = np.array(x), np.array(y)
    tagger = Tagger.fresh(seed)
    m = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    v = {k: np.zeros_like(w) for k, w in tagger.p.items()}
    for step in range(1, steps + 1):
        at = rng.integers(0, len(x), batch)
        _, grad = tagger.loss(x[at].T, y[at].T)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        rate = 0.03 * min(1.0, 1.3 - step / steps)
        for k, g in grad.items():
            g = g * min(1.0, 5 / max(norm, 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            tagger.p[k] = (tagger.p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return tagger


# ---- tagging of texts ------------------------------------------------------------------

_TRIGGER = re.compile(r"[0-9@\[(]")


def _cores(text: str) -> list[int]:
    """Starts of the cores that can hold the start of a plausible span."""
    out: list[int] = []
    for m in _TRIGGER.finditer(text):
        for core in range(max(0, (m.start() - RIGHT - CORE) // CORE + 1), m.start() // CORE + 1):
            if not out or core > out[-1]:
                out.append(core)
    return [c * CORE for c in out]


def added_spans(tagger: Tagger, texts: list[str], every: bool = False) -> list[list[Span]]:
    """Candidate spans of each text from all its windows, unreconciled.

    A span that reaches its window's edge goes on as long as the windows
    that follow find their characters inside the same kind."""
    windows = [(i, core) for i, t in enumerate(texts) for core in (range(0, len(t), CORE) if every else _cores(t))]
    found: list[list[Span]] = [[] for _ in texts]
    codes: dict[int, np.ndarray] = {}

    def tagged(part: list[tuple[int, int]]) -> np.ndarray:
        nonlocal codes
        x = np.zeros((len(part), WIDTH), np.uint8)
        for j, (i, core) in enumerate(part):
            if i not in codes:
                codes = {i: encode(texts[i])}  # windows come text by text
            a = max(0, core - LEFT)
            ids = codes[i][a:core + CORE + RIGHT]
            x[j, a - core + LEFT:a - core + LEFT + len(ids)] = ids
        return tagger.decode(x.T)

    def inside(y: np.ndarray, j: int, at: int, kind: int) -> int:
        while at < WIDTH and y[at, j] == 2 + 2 * kind:
            at += 1
        return at
    for lo in range(0, len(windows), LANES):
        part = windows[lo:lo + LANES]
        y = tagged(part)
        open_ = []  # text, kind, start, core of the window read last
        for at, j in zip(*np.nonzero((y[LEFT:LEFT + CORE] % 2 == 1))):
            kind, at = int(y[LEFT + at, j] - 1) // 2, int(at) + LEFT
            end = inside(y, j, at + 1, kind)
            i, core = part[j]
            if end == WIDTH and core + CORE + RIGHT < len(texts[i]):
                open_.append((i, kind, core - LEFT + at, core))
            else:
                found[i].append((KINDS[kind], core - LEFT + at, min(core - LEFT + end, len(texts[i]))))
        while open_:
            batch, open_ = open_[:LANES], open_[LANES:]
            y = tagged([(i, core + CORE) for i, _, _, core in batch])
            for j, (i, kind, start, core) in enumerate(batch):
                core += CORE
                end = inside(y, j, WIDTH - CORE, kind)  # where the window before has ended
                if end == WIDTH and core + CORE + RIGHT < len(texts[i]):
                    open_.append((i, kind, start, core))
                else:
                    found[i].append((KINDS[kind], start, min(core - LEFT + end, len(texts[i]))))
    return found


def reconcile(text: str, base: list[Span], added: list[Span]) -> list[Span]:
    """Base spans, and the plausible added ones that overlap none taken, longest first."""
    taken = list(base)
    out = list(base)
    for kind, s, e in sorted(set(added), key=lambda z: (z[1] - z[2], z[1], KINDS.index(z[0]))):
        if plausible(kind, text[s:e]) and all(e <= a or b <= s for _, a, b in taken):
            taken.append((kind, s, e))
            out.append((kind, s, e))
    return sorted(out, key=lambda z: (z[1], KINDS.index(z[0]), z[2]))


def find(tagger: Tagger | None, texts: list[str | None]) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text."""
    texts = [t or "" for t in texts]
    base = [base_spans(t) for t in texts]
    added = added_spans(tagger, texts) if tagger else [[]] * len(texts)
    return [(b, reconcile(t, b, a) if a else b) for t, b, a in zip(texts, base, added)]


def train(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Tagger | None:
    """Fit on at most ``sample`` labelled windows, as many of each kind, and a third as many without spans, by hash.

    A window with several spans is labelled by the first of its kind.  Windows
    without spans are the first ``WIDTH`` characters of a sixteenth of the texts."""
    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for t in b.column("text").to_pylist():
            t = t or ""
            spans = base_spans(t)
            for kind, s, e in spans:
                a = max(0, s - LEFT - s % CORE)  # the span begins anywhere in the core
                if e - a <= WIDTH:
                    rows.append((kind, s - a, e - a, t[a:a + WIDTH]))
            if not spans and t and zlib.crc32(t.encode()) % 16 == 0:
                rows.append(("", 0, 0, t[:WIDTH]))
        cols = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                          ["kind", "s", "e", "t"])
    rows = common.id_text(docs, id_col, text_col).select("text").mapInArrow(common.per_batch(batch), "kind string, s long, e long, t string")
    rank = F.xxhash64("kind", "s", "e", "t")
    some = rows.groupBy("kind", "t").agg(F.min(F.struct("s", "e")).alias("at")).select("kind", "at.s", "at.e", "t")
    some = common.materialise(some, "pii-windows")
    picked = [some.where(F.col("kind") == k).orderBy(rank, "t").limit(sample // len(KINDS) if k else sample // 3) for k in [*KINDS, ""]]
    return fit([(r["kind"], r["s"], r["e"], r["t"]) for d in picked for r in d.collect()])


def detect(docs: DataFrame, tagger: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans): lists of kind:start:end, comma-joined; code points, end exclusive."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = b.column("text")
        found = [f for lo, hi in common.text_spans(texts) for f in find(shared.value, texts.slice(lo, hi - lo).to_pylist())]
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array([named(x) for x, _ in found], pa.string()), pa.array([named(x) for _, x in found], pa.string())],
            ["doc_id", "base", "spans"])
    return common.id_text(docs, id_col, text_col).mapInArrow(common.per_batch(batch), "doc_id long, base string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span (overlapping ones together) as the first one's kind in brackets."""
    out, at = [], 0
    for kind, s, e in spans:
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, tagger: Tagger | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with the spans in ``text_col`` masked."""
    common.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    at = docs.columns.index(text_col)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = b.column(at)
        out = []
        for lo, hi in common.text_spans(texts):
            part = texts.slice(lo, hi - lo).to_pylist()
            out += [t if t is None else masked(t, spans) for t, (_, spans) in zip(part, find(shared.value, part))]
        return pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(out, texts.type), *b.columns[at + 1:]], b.schema.names)
    return common.map_rows(docs, batch)
