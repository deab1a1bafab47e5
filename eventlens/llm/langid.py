"""Language identification by nearest centroid.

A text is the TF-IDF vector of its character n-grams (one to three
letters of the lower-cased text, runs of anything else as one blank,
hashed into ``DIMS`` columns), of unit length.  Each language has several
centroids, found by spherical k-means over a bounded labelled sample; a
text goes to the language of the centroid with the largest cosine.  A
text farther from it than nearly all of that language's own sample is
flagged as rejected.

Defined results: a null text, or one without a letter, is ``und`` with
score 0; so is every text when there is nothing to learn from.  Texts of
more than ``SLICE`` characters are counted slice by slice (the n-grams
across a cut are left out).
"""

from __future__ import annotations

import math
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

DIMS = 4096
SAMPLE = 600
CENTROIDS = 4
SLICE = 1 << 20
BATCH = 256
UNKNOWN = "und"
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters or marks of letters."""
    if not _LETTER:
        _LETTER.append(np.array([unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)]))
    return _LETTER[0]


def ngram_counts(texts: list[str | None]) -> np.ndarray:
    """(texts, DIMS) counts of hashed n-grams; a row of zeros has no letter."""
    out = np.zeros((len(texts), DIMS), np.float32)
    held: list[tuple[int, str]] = []
    size = 0

    def flush() -> None:
        joined = "\n".join([t for _, t in held]) + "\n"
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        row = np.repeat([i for i, _ in held], [len(t) + 1 for _, t in held])
        c = np.where(_letters()[chars], chars, 0).astype(np.uint64)
        new_row = np.concatenate([[True], row[1:] != row[:-1]])
        keep = (c > 0) | np.concatenate([[True], c[:-1] > 0]) | new_row  # a run of blanks is one
        c, row = c[keep], row[keep]
        grams = np.zeros(len(c), np.uint64)
        for n in (1, 2, 3):
            grams = (grams[:len(c) - n + 1] if n > 1 else grams) * np.uint64(0x100000001B3) + c[n - 1:] + np.uint64(1)
            own = row[:len(grams)] == row[n - 1:]
            full = (c[:len(grams)] > 0) | (c[n - 1:] > 0)
            h = ((grams ^ (grams >> np.uint64(17))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - 12)).astype(np.int64)
            at = np.flatnonzero(own & full)
            first = held[0][0]
            rows = held[-1][0] - first + 1
            out[first:first + rows] += np.bincount((row[at] - first) * DIMS + h[at], minlength=rows * DIMS).reshape(rows, DIMS)
        held.clear()
    for i, t in enumerate(texts):
        t = (t or "").lower()
        for lo in range(0, max(len(t), 1), SLICE):
            held.append((i, t[lo:lo + SLICE]))
            size += len(held[-1][1])
            if size >= SLICE or len(held) >= BATCH:
                flush()
                size = 0
    if held:
        flush()
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # one row each, unit length
    owner: np.ndarray  # language number of each row
    least: np.ndarray  # smallest cosine a text of the language is expected to have

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return _unit(np.log1p(counts) * self.idf)

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, cosine, rejected) of each row."""
        cosine = self.vectors(counts) @ self.centroids.T
        best = cosine.argmax(axis=1)
        score = cosine[np.arange(len(best)), best]
        lang = self.owner[best]
        return lang, score, score < self.least[lang]


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts far apart, empty clusters keep their centre."""
    centres = [x[rng.integers(len(x))]]
    for _ in range(min(k, len(x)) - 1):
        centres.append(x[np.max(x @ np.array(centres).T, axis=1).argmin()])
    c = np.array(centres)
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        c = _unit(np.array([x[near == j].sum(axis=0) if (near == j).any() else c[j] for j in range(len(c))]))
    return c


def fit_language(counts: np.ndarray, idf: np.ndarray, lang: str, centroids: int) -> tuple[np.ndarray, float]:
    """A language's centroids, and the smallest cosine its texts are expected to have."""
    x = _unit(np.log1p(counts) * idf)
    p = _kmeans(x, centroids, np.random.default_rng(zlib.crc32(lang.encode())))
    return p.astype(np.float32), 0.8 * float(np.quantile((x @ p.T).max(axis=1), 0.01))


def _sparse(b: pa.RecordBatch | pa.Table) -> np.ndarray:
    """(rows, DIMS) counts from the packed columns ``at`` and ``n``."""
    counts = np.zeros((b.num_rows, DIMS), np.float32)
    for i, (at, n) in enumerate(zip(b.column("at").to_pylist(), b.column("n").to_pylist())):
        counts[i, np.frombuffer(at, "<u2")] = np.frombuffer(n, "<f4")
    return counts


def _drawn(docs: DataFrame, sample: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """At most ``sample`` rows of each language, by hash of id and text."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                    F.col(lang_col).cast("string").alias("lang")).where("doc_id is not null and lang is not null and text is not null")
    # a written table of one row a language: Spark sees its size and broadcasts it, or not
    sizes = common.materialise(d.groupBy("lang").agg(F.count("*").alias("of")), "language-sizes")
    h = F.xxhash64("doc_id", "text")
    share = F.shiftrightunsigned(h, 1) / F.lit(float(1 << 63))
    # somewhat more than asked for, so that the exact bound below rarely finds fewer
    some = d.join(sizes, "lang").where(share * F.col("of") < sample + 5 * math.sqrt(sample) + 5)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(h, "doc_id"))
    return some.withColumn("rank", rank).where(F.col("rank") <= sample).select("doc_id", "text", "lang")


def train(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          centroids: int = CENTROIDS) -> Model | None:
    """Fit on at most ``sample`` documents of each language, by hash of id and text.

    Documents are those with a language, a text with a letter and an id.
    Each language is fitted in a task of its own, on its bounded sample; the
    driver gets the weights of the columns and the centroids alone."""
    spark = docs.sparkSession

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        counts = ngram_counts(b.column("text").to_pylist())
        some = counts.any(axis=1)
        counts, b = counts[some], b.filter(pa.array(some))
        at = [np.flatnonzero(c) for c in counts]
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("lang"), pa.array([a.astype("<u2").tobytes() for a in at], pa.binary()),
             pa.array([c[a].astype("<f4").tobytes() for c, a in zip(counts, at)], pa.binary())], ["doc_id", "lang", "at", "n"])
    rows = common.materialise(_drawn(docs, sample, id_col, text_col, lang_col).mapInArrow(
        common.per_batch(batch), "doc_id long, lang string, at binary, n binary"), "language-sample")

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(DIMS, np.int64), 0
        for b in batches:
            texts += b.num_rows
            for at in b.column("at").to_pylist():
                total[np.frombuffer(at, "<u2")] += 1
        yield pa.RecordBatch.from_arrays([pa.array([*range(DIMS), -1], pa.int32()), pa.array([*total.tolist(), texts], pa.int64())], ["column", "n"])
    found = {r["column"]: r.n for r in rows.select("at").mapInArrow(held, "column int, n long").groupBy("column").agg(F.sum("n").alias("n")).collect()}
    if not found.get(-1):
        return None
    idf = np.log((1 + found[-1]) / (1 + np.array([found[i] for i in range(DIMS)]))).astype(np.float32) + 1
    shared = spark.sparkContext.broadcast(idf)

    def one(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("at", "ascending")])
        lang = table.column("lang")[0].as_py()
        p, least = fit_language(_sparse(table), shared.value, lang, centroids)
        return pa.table({"lang": [lang], "centroids": pa.array([p.astype("<f4").tobytes()], pa.binary()), "least": [least]})
    got = sorted(rows.groupBy("lang").applyInArrow(one, "lang string, centroids binary, least double").collect(), key=lambda r: r.lang)
    parts = [np.frombuffer(r["centroids"], "<f4").reshape(-1, DIMS) for r in got]
    return Model([r.lang for r in got], idf, np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts]),
                 np.array([r.least for r in got]))


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected): only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        names, scores, far = [], [], []
        texts = b.column("text")
        for lo in range(0, len(texts), BATCH):
            counts = ngram_counts(texts.slice(lo, BATCH).to_pylist())
            some = counts.any(axis=1)
            if m is None:
                some[:] = False
            else:
                lang, score, rejected = m.predict(counts)
            for i, s in enumerate(some.tolist()):
                names.append(m.languages[lang[i]] if s else UNKNOWN)
                scores.append(float(min(1.0, max(0.0, score[i]))) if s else 0.0)
                far.append(bool(rejected[i]) if s else True)
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(far, pa.bool_())],
            ["doc_id", "lang_pred", "score", "rejected"])
    return common.id_text(docs, id_col, text_col).mapInArrow(
        common.per_batch(batch), "doc_id long, lang_pred string, score double, rejected boolean")
