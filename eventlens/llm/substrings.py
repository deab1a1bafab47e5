"""Repeated-substring removal with sharded Aho-Corasick automata.

A window is ``window`` consecutive words; every window but the first of
its word sequence (smallest document, then start) marks its words.

1. *Candidates.*  Each window owns its leftmost minimal word gram (a
   minimiser), so equal windows own equal anchors at equal offsets and
   nothing that recurs is missed.  Tasks count anchors before the
   shuffle; an anchor seen once in the corpus has no repeated window.
   Anchors that may send more segments than a shard is sized for are hot
   (a licence line between different neighbours); their windows are
   nominated again, by the hash of the whole window, and travel one by one.
2. *Segments.*  Documents are dealt into blocks; a block that holds
   recurring anchors sends the words of their windows to the anchor's
   shard, and recurring windows of hot anchors to the window's own shard.
   Within a block only the first copy of a segment travels: the later
   ones are repeats whatever the others hold.  A passage that a third of
   all documents share is thus one small row per block.  Windows of hot
   anchors are merged the same way over ``MERGE_BLOCKS`` blocks at a
   time, level by level, so that what lies in every block does not fill
   its shard.
3. *Automata.*  A shard confirms the recurring passages (runs of windows
   that occur again) word by word, compiles them into one Aho-Corasick
   automaton (a word is one letter of the shard's own alphabet) whose
   values are first occurrences, and streams all its segments through
   it to locate every occurrence.
4. *Removal.*  Blocks gather the ranges and cut their documents.

Shards and blocks are sized by counts, so both grow in number, not in
size, with the corpus: an anchor brings a shard at most as many segments
as a shard is sized for (or a millionth of all, as the list of hot
anchors is bounded), a window of a hot anchor at most ``MERGE_BLOCKS``
rows.  Hashes only nominate candidates; what is removed was equal word
for word.

Defined results: null or empty text has no words, and keeps the empty
text; rows of one doc_id and different text are ordered by a hash of the
text; identical rows count as one document and get the same result; a
null doc_id sorts first.
"""

from __future__ import annotations

import hashlib
import math

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

GRAM = 6
BLOCK_BYTES = 6 << 20
SHARD_SEGMENTS = 20_000
NO_ID = -(1 << 63)
ONE_LETTER = 900_000
HOT_ANCHORS = 1_000_000
#: Blocks whose copies of a hot window are merged at a time.
MERGE_BLOCKS = 512


def _tie(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)


def _grams(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, from the words' hashes."""
    m = len(h) - size + 1
    g = np.zeros(m, np.uint64)
    for k in range(size):
        g += h[k:k + m] * np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64))
    g ^= g >> np.uint64(29)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    g ^= g >> np.uint64(32)
    return g


def anchors(h: np.ndarray, window: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, last window) of each run of windows with one anchor, from the words' hashes."""
    n = len(h) - window + 1
    if n < 1:
        e = np.empty(0, np.int64)
        return e, e, e
    g = _grams(h, gram)
    view = np.lib.stride_tricks.sliding_window_view(g, window - gram + 1)
    at = np.concatenate([view[i:i + 65536].argmin(axis=1) + np.arange(i, min(i + 65536, n)) for i in range(0, n, 65536)])
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return g[at[first]].view(np.int64), first, np.append(first[1:], n) - 1


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in the sorted ``known``."""
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def _hot_windows(h: np.ndarray, window: int, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window hash, window) of a document's runs ``lo`` to ``hi``."""
    if not len(lo):
        e = np.empty(0, np.int64)
        return e, e
    at = np.concatenate([np.arange(s, e + 1) for s, e in zip(lo.tolist(), hi.tolist())])
    return _grams(h, window).view(np.int64)[at], at


def _with_block(docs: DataFrame, blocks: int) -> DataFrame:
    d = common.id_text(docs)
    return d.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"))


def _anchor_rows(docs: DataFrame, window: int, gram: int, hot: np.ndarray | None = None) -> DataFrame:
    """(anchor, block, n, d): occurrences and different segments, counted
    within a task before anything is shuffled.

    Given the ``hot`` anchors, the same of the hashes of their windows."""
    def keys_of(words):
        if len(words) < window:
            return np.empty((2, 0), np.int64)
        h = _hashes(words)
        a, lo, hi = anchors(h, window, gram)
        if hot is not None:
            found = _among(a, hot)
            a = _hot_windows(h, window, lo[found], hi[found])[0]
            return np.stack([a, a])
        # equal segments have equal sums of word hashes
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h)])
        return np.stack([a, (upto[hi + window] - upto[lo]).view(np.int64)])

    def run(batches):
        held, rows = [], 0

        def flush():
            a, s, b = np.concatenate(held, axis=1)
            order = np.lexsort((s, b, a))
            a, s, b = a[order], s[order], b[order]
            new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            other = new.copy()
            other[1:] |= s[1:] != s[:-1]
            at = np.flatnonzero(new)
            return pa.RecordBatch.from_arrays(
                [pa.array(a[at]), pa.array(b[at].astype(np.int32)), pa.array(np.diff(np.append(at, len(a)))),
                 pa.array(np.add.reduceat(other.astype(np.int64), at))], ["anchor", "block", "n", "d"])
        for batch in batches:
            for text, block in zip(batch.column("text"), batch.column("block")):
                k = keys_of((text.as_py() or "").encode().split())
                if k.shape[1]:
                    held.append(np.concatenate([k, np.full((1, k.shape[1]), block.as_py())]))
                    rows += k.shape[1]
                if rows > 1 << 19:
                    yield flush()
                    held, rows = [], 0
        if rows:
            yield flush()
    return docs.select("text", "block").mapInArrow(run, "anchor long, block int, n long, d long")


def _recurring(seen: DataFrame, name: str) -> DataFrame:
    """(block, anchor, d, segments) of the anchors that occur twice or more in the corpus."""
    every = Window.partitionBy("anchor")
    return common.materialise(
        seen.withColumns({"all": F.sum("n").over(every), "segments": F.sum("d").over(every)})
        .where("all > 1").select("block", "anchor", "d", "segments"), name)


def _packed(docs: DataFrame) -> DataFrame:
    """Documents with compressed text, for the shuffle by block."""
    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        z = zstandard.ZstdCompressor(level=1)
        texts = [(t.as_py() or "").encode() for t in b.column("text")]
        return pa.RecordBatch.from_arrays(
            [b.column("block"), b.column("doc_id"), pa.array([_tie(t) for t in texts], pa.int64()),
             pa.array([z.compress(t) for t in texts], pa.binary())], ["block", "doc_id", "tie", "z"])
    return docs.mapInArrow(common.per_batch(batch), "block int, doc_id long, tie long, z binary")


def _documents(t: pa.Table):
    """((doc, tie) key, words) of a block's rows, in order; identical rows once."""
    z = zstandard.ZstdDecompressor()
    ids = [NO_ID if i is None else i for i in t.column("doc_id").to_pylist()]
    keys = list(zip(ids, t.column("tie").to_pylist()))
    seen = None
    for i in sorted(range(len(keys)), key=keys.__getitem__):
        if keys[i] != seen:
            seen = keys[i]
            yield seen, z.decompress(t.column("z")[i].as_py()).split()


def _pack(keys: list[tuple], texts: list[bytes] | None = None) -> bytes:
    k = np.array(keys, np.int64).reshape(len(keys), -1)
    body = b"\n".join(texts) if texts is not None else b""
    return zstandard.ZstdCompressor(level=1).compress(np.array(k.shape, np.int64).tobytes() + k.tobytes() + body)


def _unpack(blob: bytes) -> tuple[np.ndarray, bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    r, c = np.frombuffer(raw, np.int64, 2)
    return np.frombuffer(raw, np.int64, r * c, 16).reshape(r, c), raw[16 + 8 * r * c:]


def _segments(docs: pa.Table, recurring: pa.Table, window: int, gram: int, shards: int, hot: np.ndarray) -> pa.Table:
    """A block's first copies of segments by shard, and the ranges of the later copies.

    A window of a hot anchor is a segment of its own, keyed by its hash."""
    rec = np.unique(recurring.column("anchor").to_numpy())
    block = docs.column("block")[0].as_py() if docs.num_rows else None
    sent: dict[bytes, None] = {}
    out: dict[tuple, tuple[list, list]] = {}
    later: list[tuple] = []
    for (doc, tie), words in _documents(docs) if len(rec) else ():
        if len(words) < window:
            continue
        h = _hashes(words)
        a, lo, hi = anchors(h, window, gram)
        warm = _among(a, hot)
        own, at = _hot_windows(h, window, lo[warm], hi[warm])
        found, again = _among(a, rec) & ~warm, _among(own, rec)
        own, at = own[again], at[again]
        single = np.repeat([False, True], [int(found.sum()), len(own)])
        for anchor, one, s, e in zip(np.concatenate([a[found], own]).tolist(), single.tolist(), np.concatenate([lo[found], at]).tolist(),
                                     np.concatenate([hi[found], at]).tolist()):
            text = b" ".join(words[s:e + window])
            if text in sent:
                if later and later[-1][:2] == (doc, tie) and later[-1][3] == s - 1:
                    later[-1] = (*later[-1][:3], e)
                else:
                    later.append((doc, tie, s, e))
            else:
                sent[text] = None
                keys, texts = out.setdefault((anchor % shards, one), ([], []))
                keys.append((doc, tie, s))
                texts.append(text)
    rows = [(s, block, one, False, _pack(*x)) for (s, one), x in out.items()]
    if later:
        rows.append((block % shards, block, False, True, _pack(later)))
    return _segment_rows(rows)


def _segment_rows(rows: list[tuple]) -> pa.Table:
    names, types = ("shard", "block", "hot", "done", "blob"), (pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary())
    return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names, types))})


def _merge(t: pa.Table) -> pa.Table:
    """One shard's hot windows of a group of blocks: the earliest copy of each stays, the others are repeats."""
    first: dict[bytes, tuple] = {}
    later: dict[int, list] = {}
    for block, blob in zip(t.column("block").to_pylist(), t.column("blob").to_pylist()):
        keys, body = _unpack(blob)
        for key, text in zip(keys.tolist(), body.split(b"\n")):
            here = (*key, block)
            was = first.setdefault(text, here)
            if was is not here:
                first[text], (doc, tie, start, at) = min(was, here), max(was, here)
                later.setdefault(at, []).append((doc, tie, start, start))
    shard = t.column("shard")[0].as_py()
    left: dict[int, tuple[list, list]] = {}
    for text, (doc, tie, start, block) in first.items():
        keys, texts = left.setdefault(block, ([], []))
        keys.append((doc, tie, start))
        texts.append(text)
    return _segment_rows([(shard, block, True, False, _pack(*x)) for block, x in left.items()]
                         + [(shard, block, False, True, _pack(_joined(x))) for block, x in later.items()])


def _joined(ranges: list[tuple]) -> list[tuple]:
    """Ranges of one document that follow each other, as one."""
    out: list[tuple] = []
    for doc, tie, s, e in sorted(ranges):
        if out and out[-1][:2] == (doc, tie) and s <= out[-1][3] + 1:
            out[-1] = (*out[-1][:3], max(e, out[-1][3]))
        else:
            out.append((doc, tie, s, e))
    return out


def _locate(t: pa.Table, window: int) -> pa.Table:
    """One shard: confirm, compile, stream; the ranges of windows that start earlier elsewhere."""
    out: list[tuple[int, bytes]] = []
    packs = []
    for block, done, blob in zip(t.column("block").to_pylist(), t.column("done").to_pylist(), t.column("blob").to_pylist()):
        if done:
            out.append((block, blob))
        else:
            packs.append((block, *_unpack(blob)))
    segments, width = _spelled(packs)
    size = window * width
    # equal segments have equal windows: each text is read once, under its earliest place
    texts: dict[str, list] = {}
    for _, doc, tie, start, s in segments:
        known = texts.setdefault(s, [(doc, tie, start), 0])
        known[0] = min(known[0], (doc, tie, start))
        known[1] += 1
    first: dict[str, tuple] = {}
    repeated = set()
    for s, ((doc, tie, start), n) in texts.items():
        for i in range(0, len(s) - size + 1, width):
            w, here = s[i:i + size], (doc, tie, start + i // width)
            was = first.setdefault(w, here)
            if was is not here or n > 1:
                repeated.add(w)
                if here < was:
                    first[w] = here
    # a passage is a run of repeated windows; its value tells where its windows start first
    passages: dict[str, list] = {}
    for s in texts:
        for a, b in _runs([s[i:i + size] in repeated for i in range(0, len(s) - size + 1, width)]):
            p = s[a * width:b * width + size]
            if p not in passages:
                passages[p] = _origins([first[p[i:i + size]] for i in range(0, len(p) - size + 1, width)])
    ranges: dict[int, list] = {}
    if passages:
        automaton = ahocorasick.Automaton()
        for p, origins in passages.items():
            automaton.add_word(p, (len(p) // width, origins))
        del first, repeated, passages
        automaton.make_automaton()
        located = {s: [((end + 1) // width - n + k, m, origin) for end, (n, origins) in automaton.iter(s) for k, m, origin in origins]
                   for s in texts}
        for block, doc, tie, start, s in segments:
            for at, m, origin in located[s]:
                if origin != (doc, tie, start + at):
                    ranges.setdefault(block, []).append((doc, tie, start + at, start + at + m - 1))
    out += [(block, _pack(found)) for block, found in ranges.items() if found]
    return pa.table({"block": pa.array([o[0] for o in out], pa.int32()), "ranges": pa.array([o[1] for o in out], pa.binary())})


def _runs(flags: list[bool]):
    """(first, last) of each run of true flags."""
    at = None
    for i, f in enumerate([*flags, False]):
        if f and at is None:
            at = i
        elif not f and at is not None:
            yield at, i - 1
            at = None


def _origins(places: list[tuple]) -> list[tuple]:
    """(window, windows, place) of each run of windows whose first places follow each other."""
    out: list[tuple] = []
    for k, (doc, tie, start) in enumerate(places):
        if out:
            at, m, origin = out[-1]
            if (doc, tie, start) == (*origin[:2], origin[2] + m):
                out[-1] = (at, m + 1, origin)
                continue
        out.append((k, 1, (doc, tie, start)))
    return out


def _spelled(packs: list[tuple], width: int = 1) -> tuple[list[tuple], int]:
    """Segments with each word as ``width`` letters of an alphabet of their own."""
    letters: dict[bytes, str] = {}
    segments = []
    for block, keys, body in packs:
        for (doc, tie, start), text in zip(keys.tolist(), body.split(b"\n")):
            s = "".join([letters.get(w) or letters.setdefault(w, _letter(len(letters), width)) for w in text.split(b" ")])
            segments.append((block, doc, tie, start, s))
        if width == 1 and len(letters) > ONE_LETTER:
            return _spelled(packs, 2)
    return segments, width


def _letter(i: int, width: int) -> str:
    if width == 1:
        return chr(i + 1 if i + 1 < 0xD800 else i + 0x801)
    # two letters from disjoint ranges: a match starts at a word
    return chr(1 + i // 0x100000) + chr(0xE000 + i % 0x100000)


def _cut(docs: pa.Table, ranges: pa.Table, window: int) -> pa.Table:
    """Kept text of a block's documents."""
    by_doc: dict[tuple, list] = {}
    for blob in ranges.column("ranges").to_pylist():
        for doc, tie, s, e in _unpack(blob)[0].tolist():
            by_doc.setdefault((doc, tie), []).append((s, e))
    result = {}
    for key, words in _documents(docs):
        change = np.zeros(len(words) + 1, np.int64)
        for s, e in by_doc.get(key, ()):
            change[s] += 1
            change[e + window] -= 1
        gone = np.cumsum(change[:-1]) > 0
        kept = [words[i] for i in np.flatnonzero(~gone)] if gone.any() else words
        result[key] = (len(words), int(gone.sum()), b" ".join(kept).decode())
    ids, ties = docs.column("doc_id").to_pylist(), docs.column("tie").to_pylist()
    rows = [result[NO_ID if i is None else i, t] for i, t in zip(ids, ties)]
    return pa.table({"doc_id": docs.column("doc_id"), "n_words": pa.array([r[0] for r in rows], pa.int64()),
                     "n_removed": pa.array([r[1] for r in rows], pa.int64()), "kept": pa.array([r[2] for r in rows], pa.string())})


def _digest(t: pa.Table) -> pa.Table:
    kept = t.column("kept").to_pylist()
    return t.drop_columns("kept").append_column("kept_sha256", pa.array([hashlib.sha256(k.encode()).hexdigest() for k in kept], pa.string()))


def _sharded(docs: DataFrame, packed: DataFrame, window: int, gram: int, shard_segments: int, blocks: int) -> DataFrame:
    """Segments by shard: (shard, block, hot, done, blob)."""
    spark = docs.sparkSession
    recurring = _recurring(_anchor_rows(docs, window, gram), "repeat-anchors")
    rows, most = recurring.agg(F.count("*"), F.sum("d")).first()
    limit = max(shard_segments, (most or 0) // HOT_ANCHORS)
    hot = np.sort(recurring.where(F.col("segments") > limit).select("anchor").distinct().toArrow()["anchor"].to_numpy())
    recurring, keys = recurring.where(F.col("segments") <= limit).select("block", "anchor"), rows
    if len(hot):
        windows = _recurring(_anchor_rows(docs, window, gram, hot), "repeat-windows")
        recurring, keys = recurring.union(windows.select("block", "anchor")), rows + windows.count()
    shards = max(2 * spark.sparkContext.defaultParallelism, math.ceil(keys / shard_segments))
    schema = "shard int, block int, hot boolean, done boolean, blob binary"
    out = (packed.groupBy("block").cogroup(recurring.groupBy("block"))
           .applyInArrow(lambda a, b: _segments(a, b, window, gram, shards, hot), schema))
    span = MERGE_BLOCKS
    while len(hot) and blocks > span:
        out = common.materialise(out, "segments")
        merged = (out.where("hot").groupBy("shard", F.floor(F.col("block") / span).alias("group"))
                  .applyInArrow(_merge, schema))
        out, span = out.where("not hot").union(merged), span * MERGE_BLOCKS
    return out


def remove_repeats(docs: DataFrame, window: int = 20, gram: int = GRAM, block_bytes: int = BLOCK_BYTES,
                   shard_segments: int = SHARD_SEGMENTS, digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept), or the SHA-256 of ``kept`` with ``digest``.

    ``kept`` holds the words that no repeated window covers, joined by
    one space."""
    if not 0 < gram <= window:
        raise ValueError("gram must be between 1 and window")
    spark = docs.sparkSession
    slots = spark.sparkContext.defaultParallelism
    size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(2 * slots, math.ceil(size / block_bytes))
    docs = _with_block(docs, blocks)
    packed = _packed(docs)
    segments = _sharded(docs, packed, window, gram, shard_segments, blocks)
    ranges = segments.groupBy("shard").applyInArrow(lambda t: _locate(t, window), "block int, ranges binary")
    last = "kept_sha256 string" if digest else "kept string"
    return packed.groupBy("block").cogroup(ranges.groupBy("block")).applyInArrow(
        (lambda a, b: _digest(_cut(a, b, window))) if digest else (lambda a, b: _cut(a, b, window)),
        f"doc_id long, n_words long, n_removed long, {last}")
