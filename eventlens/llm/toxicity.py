"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

The lexicon has a fixed part (``INSULTS``) and a learned one: beginnings
of words, and whole words, that toxic documents of the labelled sample
hold more often than others (log-likelihood ratio of ``EVIDENCE`` at
least); each weighs its log-odds.  Features are the densities of both
parts, how near their words are to a second-person word, capitals,
punctuation, and the rates of obfuscated writing (digits and symbols for
letters, letters drawn out or set apart), behind which the lexicon is
looked up again.

The documents of the sample are dealt into ``FOLDS`` by their ids.  A
document's features come from a lexicon learned without its fold, so the
trees do not trust entries that only recall their own document; the
number of trees and the calibration come from margins of trees that have
not seen the fold either.

Defined results: a null text counts as empty, and an empty one gets the
score of its (zero) features.  Documents without an id teach nothing;
conflicting labels of one id count as toxic; repeated rows teach once.
Without any label the score is 0, with labels of one kind that label.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Labelled documents learned from, entries of the learned lexicon, and the folds.
SAMPLE, ENTRIES, FOLDS = 12_000, 4_000, 4
#: Least documents of an entry, least log-likelihood ratio, and the weight from which an entry is strong.
SUPPORT, EVIDENCE, STRONG = 3, 9.0, 2.5
PREFIXES = range(3, 9)
LONGEST = 24
NEAR = 5
#: Words known without learning (fixed values).
INSULTS = frozenset((
    "idiot idiots moron morons stupid dumb dumbass loser losers scum trash garbage pathetic worthless disgusting clown "
    "imbecile cretin fool jerk bastard bitch asshole shit fuck fucking crap whore slut retard filth vermin parasite "
    "dummkopf arschloch scheisse scheiße abschaum wichser trottel schwachkopf hurensohn "
    "connard connasse salope merde imbécile crétin ordure débile "
    "estúpido estúpida idiota imbécil basura puta mierda gilipollas cabrón asqueroso").split())
#: Second-person words (fixed values).
SECOND = frozenset(("you your yours yourself yourselves u ur du dich dir dein deine deiner deinen ihr euch euer "
                    "tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros vuestro vuestra").split())
#: Letters that digits and symbols stand for.
_PLAIN = str.maketrans("013457@$!|+", "oieastasiit")

FEATURES = ["known", "log_known", "strong", "log_strong", "mild", "log_mild", "weight", "top", "distinct", "near", "log_near", "second",
            "capitals", "shouted", "exclaims", "asks", "mark_runs", "symbols", "mixed", "drawn", "spaced", "log_revealed", "revealed",
            "log_words", "word_length", "variety"]

_WORD = re.compile(r"[^\W\d_]+")
_SHOUT = re.compile(r"\b[^\W\d_a-z]{2,}\b")
_MARKS = re.compile(r"[!?]{2,}")
_MIXED = re.compile(r"[^\W\d_]+(?:[0-9@$!|+*]+|[.\-_](?=[^\W\d_]))(?:[0-9@$!|+*.\-_]|[^\W\d_])*[^\W\d_]|[0-9@$!|+]+[^\W\d_][0-9@$!|+*]*[^\W\d_]+")
#: What every mixed form holds: a digit or symbol before a letter.
_INNER = re.compile(r"[0-9@$!|+*.\-_][^\W\d_]")
_DRAWN = re.compile(r"(.)\1\1")
_SAME = re.compile(r"(.)\1{2,}")
_SPACED = re.compile(r"(?<![^\W_])[^\W\d_](?:[ .\-_*][^\W\d_]){3,}(?![^\W_])")
_APART = re.compile(r"[ .\-_*]")


def entries(word: str) -> list[str]:
    """What of a word the lexicon may hold: its beginnings (with ~) and itself."""
    return [f"{word[:k]}~" for k in PREFIXES if k < len(word)] + [word[:LONGEST]]


@dataclass
class Lexicon:
    weights: dict[str, float]
    seen: dict[str, tuple[float, bool]] = field(default_factory=dict, repr=False)

    def of(self, word: str) -> tuple[float, bool]:
        """The largest weight of a word's entries (0 without any), and whether a letter is drawn out."""
        w = self.seen.get(word)
        if w is None:
            if len(self.seen) > 300_000:
                self.seen.clear()
            w = self.seen[word] = max((self.weights.get(e, 0.0) for e in entries(word)), default=0.0), bool(_DRAWN.search(word))
        return w

    def bad(self, word: str) -> bool:
        return word in INSULTS or self.weights.get(word[:LONGEST], 0.0) >= STRONG

    def starred(self, word: str) -> bool:
        """Whether letters for the stars of ``word`` make a bad word."""
        fits = re.compile(word.replace("*", "[^\\W\\d_]") + "$").match
        return any(len(x) == len(word) and fits(x) and self.bad(x) for x in (*INSULTS, *self.weights))


def _mixed(low: str) -> list[str]:
    """Words with digits or symbols among their letters; only what stands between blanks there is looked at."""
    out, end = [], 0
    for m in _INNER.finditer(low):
        at = m.start()
        if at >= end:
            start = low.rfind(" ", end, at) + 1 or end
            end = low.find(" ", at)
            end = len(low) if end < 0 else end
            out += _MIXED.findall(low, start, end)
    return out


def _revealed(low: str, drawn: dict[str, int], lexicon: Lexicon) -> tuple[int, int, int]:
    """(mixed, spaced, those and the drawn ones that hide a bad word) of a lower-cased text."""
    forms: Counter[str] = Counter(drawn)
    mixed, spaced = _mixed(low), _SPACED.findall(low)
    forms.update(mixed)
    forms.update(spaced)
    hits, apart = 0, set(spaced)
    for form, n in forms.items():
        bare = _APART.sub("", form.translate(_PLAIN)) if "*" not in form else form
        tries = {bare, _APART.sub("", form), _SAME.sub(r"\1", bare), _SAME.sub(r"\1\1", bare)}
        if form in apart:  # letters set apart may begin with a word of one letter
            tries |= {bare[i:j] for i in range(len(bare)) for j in range(i + 4, min(i + LONGEST, len(bare)) + 1)}
        found = any(lexicon.bad(x) for x in tries if len(x) > 2 and x != form)
        if not found and "*" in form and sum(c.isalpha() for c in form) >= 2 and all(c.isalpha() or c == "*" for c in form):
            found = lexicon.starred(form)
        hits += n * found
    return len(mixed), len(spaced), hits


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """The values of ``FEATURES``; zeros for a text without words."""
    text = text or ""
    low = text.lower()
    words = _WORD.findall(low)
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    counts = Counter(words)
    known = strong = mild = distinct = 0
    total = top = 0.0
    hit, drawn = set(), {}
    for w, k in counts.items():
        x, long = lexicon.of(w)
        if long:
            drawn[w] = k
        if w in INSULTS:
            known += k
            hit.add(w)
        if x > 0:
            hit.add(w)
            total += k * x
            top = max(top, x)
            if x >= STRONG:
                strong += k
                distinct += 1
            else:
                mild += k
    second = sum(counts[w] for w in SECOND if w in counts)
    near = 0
    if hit and second:
        at = [i for i, w in enumerate(words) if w in SECOND]
        for i, w in enumerate(words):
            if w in hit:
                k = bisect_left(at, i - NEAR)
                near += k < len(at) and at[k] <= i + NEAR
    letters = sum(map(len, words))
    upper = sum(map(len, re.findall("[A-Z]+", text)))
    mixed, spaced, revealed = _revealed(low, drawn, lexicon)
    log = math.log1p
    return [known / n, log(known), strong / n, log(strong), mild / n, log(mild), total / n, top, log(distinct), near / n, log(near), second / n,
            upper / letters, len(_SHOUT.findall(text)) / n, text.count("!") / n, text.count("?") / n, len(_MARKS.findall(text)) / n,
            sum(map(text.count, "#@$%&*")) / n, mixed / n, sum(drawn.values()) / n, spaced / n, log(revealed), revealed / n,
            log(n), letters / n, len(counts) / n]


# ---- boosted trees ---------------------------------------------------------------------

DEPTH, TREES, RATE, BINS = 3, 120, 0.1, 32


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Tree:
    """A complete binary tree: inner nodes by level, then the leaves."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        row = np.arange(len(x))
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[row, self.feature[node]] > self.threshold[node])
        return self.leaf[node - len(self.feature)]


def cuts(x: np.ndarray) -> list[np.ndarray]:
    """Thresholds of each feature: half way between neighbouring quantiles."""
    out = []
    for column in x.T:
        v = np.unique(np.quantile(column, np.linspace(0, 1, BINS), method="nearest"))
        out.append((v[1:] + v[:-1]) / 2)
    return out


def grow(bins: np.ndarray, at: list[np.ndarray], g: np.ndarray, h: np.ndarray, penalty: float = 1.0, least: float = 1.0) -> tuple[Tree, np.ndarray]:
    """One tree on gradients ``g`` and curvatures ``h``, and its values for the rows."""
    inner = 2 ** DEPTH - 1
    feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
    n, m = bins.shape
    node = np.zeros(n, np.int64)
    row = np.arange(n)
    for depth in range(DEPTH):
        first, wide = 2 ** depth - 1, 2 ** depth
        cell = (((node - first)[:, None] * m + np.arange(m)) * BINS + bins).reshape(-1)
        size = wide * m * BINS
        sum_g = np.bincount(cell, np.repeat(g, m), size).reshape(wide, m, BINS).cumsum(axis=2)
        sum_h = np.bincount(cell, np.repeat(h, m), size).reshape(wide, m, BINS).cumsum(axis=2)
        all_g, all_h = sum_g[:, :, -1:], sum_h[:, :, -1:]
        gain = (sum_g ** 2 / (sum_h + penalty) + (all_g - sum_g) ** 2 / (all_h - sum_h + penalty) - all_g ** 2 / (all_h + penalty))
        gain[(sum_h < least) | (all_h - sum_h < least)] = 0
        best = gain.reshape(wide, -1).argmax(axis=1)
        ok = gain.reshape(wide, -1)[np.arange(wide), best] > 1e-9
        f, b = best // BINS, best % BINS
        place = np.full(wide, BINS)
        for k in range(wide):
            if ok[k]:
                feature[first + k], threshold[first + k], place[k] = f[k], at[f[k]][b[k]], b[k]
        own = node - first
        node = 2 * node + 1 + (bins[row, feature[node]] > place[own])
    leaf_of = node - inner
    leaf = -np.bincount(leaf_of, g, 2 ** DEPTH) / (np.bincount(leaf_of, h, 2 ** DEPTH) + penalty)
    return Tree(feature, threshold, RATE * leaf), RATE * leaf[leaf_of]


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> tuple[float, list[Tree]]:
    """(first margin, trees) for the labels ``y`` by logistic loss."""
    base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    at = cuts(x)
    bins = np.stack([np.searchsorted(c, v) for c, v in zip(at, x.T)], 1)
    margin = np.full(len(y), base)
    out = []
    for _ in range(trees):
        p = _sigmoid(margin)
        tree, step = grow(bins, at, p - y, p * (1 - p))
        out.append(tree)
        margin += step
    return base, out


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(centre, value) of the pooled blocks of the best increasing fit of ``y`` on ``x``."""
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order].astype(float)
    blocks: list[list[float]] = []  # sum of x, sum of y, rows
    i = 0
    while i < len(x):
        j = int(np.searchsorted(x, x[i], "right"))  # ties are one block
        blocks.append([float(x[i:j].sum()), float(y[i:j].sum()), j - i])
        i = j
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    b = np.array(blocks)
    return b[:, 0] / b[:, 2], b[:, 1] / b[:, 2]


@dataclass
class Model:
    lexicon: Lexicon
    base: float
    trees: list[Tree]
    centres: np.ndarray
    values: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum((t.predict(x) for t in self.trees), np.zeros(len(x)))

    def score(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([features(t, self.lexicon) for t in texts], float).reshape(len(texts), len(FEATURES))
        return np.clip(np.interp(self.margins(x), self.centres, self.values), 0, 1)


def fit(x: np.ndarray, y: np.ndarray, fold: np.ndarray, lexicon: Lexicon) -> Model:
    """Trees and calibration from features whose lexicon has not seen the row's fold."""
    if len(y) == 0 or y.min() == y.max():
        return Model(lexicon, 0.0, [], np.zeros(1), np.array([float(y.max(initial=0))]))
    staged = np.zeros((TREES + 1, len(y)))
    seen = np.zeros(len(y), bool)
    for k in np.unique(fold):
        out = fold == k
        if out.all():
            continue
        base, trees = boost(x[~out], y[~out])
        staged[0, out] = base
        staged[1:, out] = base + np.cumsum([t.predict(x[out]) for t in trees], axis=0)
        seen |= out
    p = np.clip(_sigmoid(staged[:, seen]), 1e-6, 1 - 1e-6)
    loss = -(y[seen] * np.log(p) + (1 - y[seen]) * np.log(1 - p)).mean(axis=1) if seen.any() else np.zeros(1)
    best = int(loss.argmin())
    base, trees = boost(x, y, best)
    margin = staged[best, seen] if seen.any() else np.full(len(y), base)
    return Model(lexicon, base, trees, *isotonic(margin, y[seen] if seen.any() else y))


# ---- learning on Spark -----------------------------------------------------------------


def labelled(docs: DataFrame, labels: DataFrame, sample: int, id_col: str, text_col: str, label_id_col: str, label_col: str) -> DataFrame:
    """At most ``sample`` distinct labelled (id, text), by hash: (doc_id, text, y, fold)."""
    label = (labels.where(F.col(label_col).isNotNull() & F.col(label_id_col).isNotNull())
             .groupBy(F.col(label_id_col).cast("long").alias("lid")).agg((F.max(label_col) > 0).cast("int").alias("y"))
             .orderBy(F.xxhash64("lid"), "lid").limit(sample))
    d = common.id_text(docs, id_col, text_col).where("doc_id is not null")
    d = d.join(F.broadcast(label), F.col("doc_id") == F.col("lid")).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "y")
    d = common.materialise(d.withColumn("h", F.xxhash64("doc_id", "text")), "toxicity-labelled")
    # an id may have many texts: the same bound holds for them
    last = d.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    d = d.where(F.col("h") <= (0 if last is None else last)).groupBy("h").agg(*(F.first(c).alias(c) for c in ("doc_id", "text", "y")))
    return common.materialise(d.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(FOLDS)).cast("int")), "toxicity-sample")


def _counted(sample: DataFrame) -> tuple[list, np.ndarray]:
    """(entries with counts, documents) by fold and label, of entries that toxic documents hold more often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Counter[str]] = [Counter() for _ in range(2 * FOLDS)]

        def out() -> Iterator[pa.RecordBatch]:
            for part, c in enumerate(held):
                if c:
                    yield pa.RecordBatch.from_arrays([pa.array(c.keys(), pa.string()), pa.array([part] * len(c), pa.int32()), pa.array(c.values(), pa.int64())],
                                                     ["entry", "part", "n"])
                c.clear()
        for b in batches:
            for t, y, f in zip(*(b.column(c).to_pylist() for c in ("text", "y", "fold"))):
                own = {e for w in set(_WORD.findall(t.lower())) for e in entries(w)}
                held[2 * f + y].update(own)
            if sum(map(len, held)) > 1_000_000:
                yield from out()
        yield from out()
    size = np.zeros(2 * FOLDS)
    for r in sample.groupBy("fold", "y").count().collect():
        size[2 * r.fold + r.y] = r["count"]
    n1, n0 = max(size[1::2].sum(), 1), max(size[0::2].sum(), 1)
    parts = [F.sum(F.when(F.col("part") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(2 * FOLDS)]
    toxic, clean = (sum((F.col(f"n{2 * k + y}") for k in range(1, FOLDS)), F.col(f"n{y}")) for y in (1, 0))
    counts = sample.select("text", "y", "fold").mapInArrow(run, "entry string, part int, n long").groupBy("entry").agg(*parts)
    share = (n1 / (n1 + n0))
    some = counts.where((toxic >= SUPPORT) & (toxic / n1 > 2 * clean / n0)).withColumn(
        "evidence", toxic * F.log(toxic / ((toxic + clean) * share)) + F.when(clean > 0, clean * F.log(clean / ((toxic + clean) * (1 - share)))).otherwise(0.0))
    rows = some.where(F.col("evidence") >= EVIDENCE / 2).orderBy(F.col("evidence").desc(), "entry").limit(ENTRIES).collect()
    return [(r.entry, np.array([r[f"n{k}"] for k in range(2 * FOLDS)], float)) for r in rows], size


def lexicon_of(counted: list, size: np.ndarray, without: int | None = None) -> Lexicon:
    """Entries with enough evidence in all folds but ``without``."""
    use = np.repeat(np.arange(FOLDS) != (FOLDS if without is None else without), 2)
    n1, n0 = size[use][1::2].sum(), size[use][0::2].sum()
    out = {}
    for entry, n in counted:
        a, b = n[use][1::2].sum(), n[use][0::2].sum()
        if a < SUPPORT or n1 == 0 or n0 == 0 or a * n0 <= b * n1:
            continue
        share = n1 / (n1 + n0)
        if a * math.log(a / ((a + b) * share)) + (b * math.log(b / ((a + b) * (1 - share))) if b else 0) >= EVIDENCE:
            out[entry] = math.log((a + 0.5) / (n1 + 1)) - math.log((b + 0.5) / (n0 + 1))
    return Lexicon(out)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
          label_id_col: str = "doc_id", label_col: str = "toxic") -> Model:
    """Fit on at most ``sample`` labelled documents; texts stay on the executors."""
    rows = labelled(docs, labels, sample, id_col, text_col, label_id_col, label_col)
    counted, size = _counted(rows)
    shared = rows.sparkSession.sparkContext.broadcast([lexicon_of(counted, size, k) for k in range(FOLDS)])

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [features(t, shared.value[f]) for t, f in zip(b.column("text").to_pylist(), b.column("fold").to_pylist())]
        return pa.RecordBatch.from_arrays([b.column("h"), b.column("y"), b.column("fold"), pa.array(found, pa.list_(pa.float64()))], ["h", "y", "fold", "x"])
    got = rows.select("text", "y", "fold", "h").mapInArrow(common.per_batch(batch), "h long, y int, fold int, x array<double>").collect()
    got.sort(key=lambda r: r.h)
    x = np.array([r.x for r in got], float).reshape(len(got), len(FEATURES))
    return fit(x, np.array([r.y for r in got], float), np.array([r.fold for r in got], int), lexicon_of(counted, size))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted): only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = b.column("text")
        s = np.concatenate([shared.value.score(texts.slice(lo, hi - lo).to_pylist()) for lo, hi in common.text_spans(texts)])
        return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])
    return common.id_text(docs, id_col, text_col).mapInArrow(common.per_batch(batch), "doc_id long, score double, predicted int")
