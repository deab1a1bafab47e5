"""Benchmark decontamination as a prefix-filtered set join.

A window is ``window`` consecutive words of a benchmark item (an item of
fewer words is one window); it is the set of its 3-word shingles (fewer
words: one shingle).  Shingles are ordered by their count over all
documents.  To hold a window, a document must hold every one of its
shingles, so a prefix of one, the rarest, is enough to join on.  A
document position that carries the prefix shingle fixes where the window
would start: the positional bound drops starts before the document, the
length bound those that run past it, and the words left are compared one
by one.

The benchmark is taken in blocks of about ``block_bytes`` bytes, each
sent to the tasks as one bounded index; documents pass up to
``max_blocks`` of them one after the other.  Every (item, text) is one
row, a long text several that overlap by a window less one word, and the
rows are dealt by hash, so neither copies of a text nor a long item make
a block large.  Words are numbered by the block's vocabulary: a document
word outside it is no candidate.

A larger benchmark is shuffled instead, and the documents are read three
times whatever its size: once to count its shingles, once to send the
words around each prefix shingle to the windows that own it, and once to
take the hits.  A bit table of ``FILTER_BITS`` bits, the only thing sent
to every task, keeps most other shingles at home.  Equal texts have
equal hits, so they travel once, under the SHA-256 of the text.

Defined results: null or empty text has no words and no hits; repeated
items count once per item_id; an item with a null id can be hit but has
no name in the list.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

BLOCK_BYTES = 8_000_000
MAX_BLOCKS = 4
SHINGLE = 3
#: Size of the bit table of shingles: a power of two.
FILTER_BITS = 1 << 27
#: Rows of a batch that a task makes.
ROWS = 20_000
#: Words of a benchmark text that stay in one row.
PIECE_WORDS = 2000
#: Bytes that end a word; A-Z is lower-cased first.
_BREAK = bytes(range(0x30)) + bytes(range(0x3A, 0x61)) + bytes(range(0x7B, 0x80))
_TO_SPACE = bytes.maketrans(_BREAK, b" " * len(_BREAK))


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(_TO_SPACE).split()


class Index:
    """Windows of a block of items by length; joins documents by prefix shingle."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.word: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.word.setdefault(w, len(self.word)) for w in _words(text)]
            n = min(window, len(ids))
            for s in range(len(ids) - n + 1 if n else 0):
                found.setdefault(tuple(ids[s:s + n]), set()).add(item)
        self.lengths = []
        for n in sorted({len(w) for w in found}):
            windows = [w for w in found if len(w) == n]
            self.lengths.append((n, np.array(windows, np.int64), [tuple(found[w]) for w in windows]))
        self.prefix: list[tuple] = []
        self.shingles = np.unique(np.concatenate(
            [self._keys(w, min(SHINGLE, n)).ravel() for n, w, _ in self.lengths] or [np.empty(0, np.uint64)]))

    def _keys(self, ids: np.ndarray, k: int) -> np.ndarray:
        """A hash of every run of ``k`` word numbers, along the last axis.

        Runs that agree by chance only make a candidate more: words decide."""
        n = ids.shape[-1] - k + 1
        key = np.full((*ids.shape[:-1], max(n, 0)), k, np.uint64)
        for i in range(k):
            key = (key ^ (ids[..., i:i + n] + 1).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(31)
        return key

    def ids(self, words: list[bytes]) -> np.ndarray:
        get = self.word.get
        return np.array([get(w, -1) for w in words], np.int64)

    def doc_shingles(self, ids: np.ndarray):
        """(k, keys) of the document's runs of known words, for each shingle length in use."""
        for k in sorted({min(SHINGLE, n) for n, _, _ in self.lengths}):
            if len(ids) >= k:
                known = np.lib.stride_tricks.sliding_window_view(ids >= 0, k).all(axis=1)
                at = np.flatnonzero(known)
                if len(at):
                    yield k, at, self._keys(ids, k)[at]

    def count(self, ids: np.ndarray, seen: np.ndarray) -> None:
        for _, _, keys in self.doc_shingles(ids):
            i = np.minimum(np.searchsorted(self.shingles, keys), len(self.shingles) - 1)
            np.add.at(seen, i[self.shingles[i] == keys], 1)

    def order(self, counts: np.ndarray) -> None:
        """Choose every window's rarest shingle (ties by key) as its prefix."""
        for n, windows, _ in self.lengths:
            k = min(SHINGLE, n)
            keys = self._keys(windows, k)
            rank = counts[np.searchsorted(self.shingles, keys)]
            offset = np.lexsort((keys, rank), axis=1)[:, 0]
            key = keys[np.arange(len(keys)), offset]
            by = np.argsort(key, kind="stable")
            self.prefix.append((n, k, key[by], offset[by], by))

    def join(self, words: list[bytes]) -> tuple[np.ndarray, set]:
        """(hit mask, items) of one document."""
        hit = np.zeros(len(words) + 1, np.int64)
        items: set = set()
        ids = self.ids(words)
        runs = {k: (at, keys) for k, at, keys in self.doc_shingles(ids)}
        for (n, windows, names), (_, k, keys, offsets, by) in zip(self.lengths, self.prefix):
            if k not in runs or len(words) < n:
                continue
            at, found = runs[k]
            lo, hi = np.searchsorted(keys, found), np.searchsorted(keys, found, side="right")
            some = np.flatnonzero(hi > lo)
            for a in range(0, len(some), 4096):
                part = some[a:a + 4096]
                m = (hi - lo)[part]
                entry = np.repeat(lo[part] - np.cumsum(m) + m, m) + np.arange(m.sum())
                start = np.repeat(at[part], m) - offsets[entry]
                ok = (start >= 0) & (start + n <= len(words))
                entry, start = entry[ok], start[ok]
                w = by[entry]
                same = (ids[start[:, None] + np.arange(n)] == windows[w]).all(axis=1)
                for i in np.unique(w[same]).tolist():
                    items.update(names[i])
                start = np.unique(start[same])
                hit[start] += 1
                hit[start + n] -= 1
        return np.cumsum(hit[:-1]) > 0, items


def _rarity(docs: DataFrame, index) -> np.ndarray:
    """Occurrences over all documents of the block's shingles, summed by task first."""
    def run(batches):
        ix = index.value
        seen = np.zeros(len(ix.shingles), np.int64)
        for b in batches:
            for t in b.column("text"):
                if len(seen):
                    ix.count(ix.ids(_words(t.as_py())), seen)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["shingle", "n"])
    counts = np.zeros(len(index.value.shingles), np.int64)
    # at most one row per shingle of a bounded block
    for r in docs.select("text").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).collect():
        counts[r.shingle] = r.n
    return counts


def _pieces(benchmark: DataFrame, window: int, block_bytes: int, item_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(item, text) in pieces of bounded size, and the number of blocks they fill."""
    common.small_batches(benchmark.sparkSession)
    bench = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text")).distinct()

    width = max(PIECE_WORDS, 2 * window)

    def cut(b: pa.RecordBatch) -> pa.RecordBatch:
        items, texts = [], []
        for item, text in zip(b.column("item").to_pylist(), b.column("text").to_pylist()):
            words = _words(text)
            for s in range(0, max(len(words) - window + 1, 1), width - window + 1):
                items.append(item)
                texts.append(b" ".join(words[s:s + width]).decode())
        return pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(texts, pa.string())], ["item", "text"])
    bench = common.materialise(bench.where("text is not null").mapInArrow(common.per_batch(cut), "item string, text string"), "benchmark-pieces")
    size = bench.select(F.sum(F.octet_length("text"))).first()[0] or 0
    return bench, max(1, math.ceil(size / block_bytes))


def _blocks(bench: DataFrame, blocks: int, window: int):
    """Whether it is the last, and how to get the shared index, of each block of pieces.

    The index is built when asked for: its order counts the documents
    that the earlier blocks left."""
    spark = bench.sparkSession

    def index(k: int, of: DataFrame):
        part = bench if blocks == 1 else bench.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        ix = Index([(r["item"], r["text"]) for r in part.collect()], window)
        ix.order(_rarity(of, spark.sparkContext.broadcast(ix)))
        return spark.sparkContext.broadcast(ix)
    return [(k + 1 == blocks, lambda of, k=k: index(k, of)) for k in range(blocks)]


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)


def _shingle_keys(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of every run of ``k`` words, from the words' hashes."""
    n = max(len(h) - k + 1, 0)
    key = np.full(n, k, np.uint64)
    for i in range(k):
        key = (key ^ h[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def _item_windows(bench: DataFrame, window: int) -> DataFrame:
    """(phrase, item, n, keys): the windows of the pieces, each with its shingles."""
    types = {"phrase": pa.string(), "item": pa.string(), "n": pa.int32(), "keys": pa.list_(pa.int64())}

    def run(batches):
        rows: list[tuple] = []

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.values())], list(types))
        for b in batches:
            for item, text in zip(b.column("item").to_pylist(), b.column("text").to_pylist()):
                words = _words(text)
                n = min(window, len(words))
                k = min(SHINGLE, n)
                keys = _shingle_keys(_word_hashes(words), k) if n else None
                for s in range(len(words) - n + 1 if n else 0):
                    rows.append((b" ".join(words[s:s + n]).decode(), item, n, keys[s:s + n - k + 1].tolist()))
                if len(rows) >= ROWS:
                    yield flush()
                    rows.clear()
        if rows:
            yield flush()
    return bench.mapInArrow(run, "phrase string, item string, n int, keys array<long>")


def _members(keys: DataFrame):
    """A shared bit table of the column ``key``: what is not in it is no member."""
    spark = keys.sparkSession
    place = F.col("key").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = (keys.select(F.shiftright(place, 6).alias("word"), place.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
             .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow())
    table = np.zeros(FILTER_BITS // 64, np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    return spark.sparkContext.broadcast(table.view(np.uint64))


def _among(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    place = keys.view(np.uint64) & np.uint64(64 * len(table) - 1)
    return (table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) > 0


def _occurrences(texts: DataFrame, members, sizes: list[int]) -> DataFrame:
    """(key, seen) over all documents, summed by batch first."""
    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.empty(0, np.int64)]
        for t in b.column("text"):
            h = _word_hashes(_words(t.as_py()))
            for k in sizes:
                keys = _shingle_keys(h, k)
                found.append(keys[_among(keys, members.value)])
        keys, n = np.unique(np.concatenate(found), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], ["key", "n"])
    return texts.select("text").mapInArrow(common.per_batch(batch), "key long, n long").groupBy("key").agg(F.sum("n").alias("seen"))


def _candidates(texts: DataFrame, members, sizes: list[int], window: int) -> DataFrame:
    """(sha, key, at, lo, around): the words around each shingle that may be a prefix."""
    types = {"sha": pa.string(), "key": pa.int64(), "at": pa.int32(), "lo": pa.int32(), "around": pa.list_(pa.string())}

    def run(batches):
        rows: list[tuple] = []

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.values())], list(types))
        for b in batches:
            for sha, t in zip(b.column("sha").to_pylist(), b.column("text")):
                words = _words(t.as_py())
                h = _word_hashes(words)
                for k in sizes:
                    keys = _shingle_keys(h, k)
                    for at in np.flatnonzero(_among(keys, members.value)).tolist():
                        lo = max(0, at - window + 1)
                        rows.append((sha, int(keys[at]), at, lo, [w.decode() for w in words[lo:at + window]]))
                        if len(rows) >= ROWS:
                            yield flush()
                            rows.clear()
        if rows:
            yield flush()
    return (texts.mapInArrow(run, "sha string, key long, at int, lo int, around array<string>")
            .dropDuplicates(["sha", "key", "at"]))


def _shuffled_hits(texts: DataFrame, bench: DataFrame, window: int) -> DataFrame:
    """(sha, n_hit, items) of the texts with hits; ``bench`` holds the pieces."""
    texts = texts.where("text is not null").select(F.sha2("text", 256).alias("sha"), "text")
    windows = common.materialise(_item_windows(bench, window), "benchmark-windows")
    phrases = windows.select("phrase", "n", "keys").dropDuplicates(["phrase"])
    sizes = sorted(r[0] for r in windows.select(F.least("n", F.lit(SHINGLE))).distinct().collect())
    shingles = phrases.select("phrase", "n", F.posexplode("keys").alias("offset", "key"))

    seen = _occurrences(texts, _members(shingles.select("key")), sizes)
    rarest = F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "key", "offset")).alias("p")
    prefix = shingles.join(seen, "key", "left").groupBy("phrase", "n").agg(rarest)
    # a shingle that no document has leads to no hit
    prefix = common.materialise(prefix.where("p.seen > 0").select("p.key", "p.offset", "phrase", "n"), "benchmark-prefixes")

    start = F.col("at") - F.col("offset")
    there = F.slice("around", F.greatest(start - F.col("lo") + 1, F.lit(1)), F.col("n"))
    hits = (_candidates(texts, _members(prefix.select("key")), sizes, window).join(prefix, "key")
            .where((start >= 0) & (F.array_join(there, " ") == F.col("phrase")))
            .select("sha", start.alias("start"), "n", "phrase"))
    hits = common.materialise(hits, "benchmark-hits")

    before = Window.partitionBy("sha").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("n")
    new = F.greatest(end - F.greatest("start", F.coalesce(F.max(end).over(before), "start")), F.lit(0))
    n_hit = (hits.groupBy("sha", "start").agg(F.max("n").alias("n")).select("sha", new.alias("new"))
             .groupBy("sha").agg(F.sum("new").alias("n_hit")))
    names = windows.where("item is not null").select("phrase", "item").distinct()
    items = (hits.select("sha", "phrase").distinct().join(names, "phrase")
             .groupBy("sha").agg(F.sort_array(F.collect_set("item")).alias("items")))
    return n_hit.join(items, "sha", "left")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES,
                  item_col: str = "item_id", item_text_col: str = "text", max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """(doc_id, n_words, n_hit, items): one row per input row.

    ``n_hit`` words lie inside an occurrence of a benchmark window;
    ``items`` are the item ids with such windows, sorted as strings.
    A benchmark of more than ``max_blocks`` blocks is shuffled."""
    state = common.id_text(docs)
    bench, blocks = _pieces(benchmark, window, block_bytes, item_col, item_text_col)
    if blocks > max_blocks:
        def sizes(b: pa.RecordBatch) -> pa.RecordBatch:
            n = pa.array([len(_words(t.as_py())) for t in b.column("text")], pa.int64())
            return pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("sha"), n], ["doc_id", "sha", "n_words"])
        counted = state.withColumn("sha", F.sha2("text", 256)).mapInArrow(common.per_batch(sizes), "doc_id long, sha string, n_words long")
        return counted.join(_shuffled_hits(state, bench, window), "sha", "left").select(
            "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    state = state.withColumns({"hits": F.lit(None).cast("binary"), "items": F.lit(None).cast("array<string>")})
    for last, index in _blocks(bench, blocks, window):
        shared = index(state)

        def batch(b: pa.RecordBatch, shared=shared, last=last) -> pa.RecordBatch:
            ix = shared.value
            n_words, hits, items = [], [], []
            for t, h, i in zip(b.column("text"), b.column("hits"), b.column("items")):
                mask, found = ix.join(_words(t.as_py()))
                bits = np.packbits(mask)
                if h.as_py():
                    bits |= np.frombuffer(h.as_py(), np.uint8)
                n_words.append(len(mask))
                hits.append(bits)
                items.append(sorted({x for x in found if x is not None}.union(i.as_py() or [])))
            items = pa.array(items, pa.list_(pa.string()))
            if not last:
                return pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), pa.array([h.tobytes() for h in hits], pa.binary()), items],
                                                  ["doc_id", "text", "hits", "items"])
            return pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n_words, pa.int64()), pa.array([int(np.bitwise_count(h).sum()) for h in hits], pa.int64()), items],
                ["doc_id", "n_words", "n_hit", "items"])
        state = state.mapInArrow(common.per_batch(batch), "doc_id long, n_words long, n_hit long, items array<string>" if last
                                 else "doc_id long, text string, hits binary, items array<string>")
        if not last:
            state = common.materialise(state, "decontaminate")
    return state


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES,
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark window."""
    at = docs.columns.index(text_col)
    bench, blocks = _pieces(benchmark, window, block_bytes, item_col, item_text_col)
    if blocks > max_blocks:
        names = docs.columns
        text = F.col(f"`{text_col}`").cast("string").alias("text")
        hits = _shuffled_hits(docs.select(text), bench, window).select("sha")
        numbered = docs.toDF(*(f"c{i}" for i in range(len(names))))
        return (numbered.withColumn("sha", F.sha2(F.col(f"c{at}").cast("string"), 256)).join(hits, "sha", "left_anti")
                .drop("sha").toDF(*names))
    for last, index in _blocks(bench, blocks, window):
        shared = index(docs.select(F.col(f"`{text_col}`").cast("string").alias("text")))

        def batch(b: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            clean = [not shared.value.join(_words(t))[0].any() for t in b.column(at).cast(pa.string()).to_pylist()]
            return b.filter(pa.array(clean, pa.bool_()))
        docs = common.map_rows(docs, batch)
        if not last:
            docs = common.materialise(docs, "decontaminate")
    return docs
