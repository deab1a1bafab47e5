"""Cross-tokenizer alignment: which ids of two tokenizers cover the same bytes.

Tokenizer A (a byte-level ``.json``) encodes a space and the text,
tokenizer B (a sentencepiece ``.model``) the text, whose pieces begin
with that space; special strings inside texts are plain text.  Byte
offsets where tokens of both end cut a text into groups.

The cuts are found by diagonal run skipping over the two arrays of token
ends.  At the current shift between the indexes, probes of doubling
length compare whole stretches and jump over those where every token of
A ends with one of B; a probe that fails is halved down to the first
difference.  There a merge of the two arrays finds the next common end,
which closes one irregular group and gives the new shift.

Every pair of an A and a B id of one group is a link.  ``align`` counts
in how many documents a pair is linked and sums these counts over each
document's links.  Pairs are counted per task first.  The most frequent
pairs (at most ``HEAD``, by a count that is a power of two) are looked up
in a broadcast table of that bound; all rarer pairs are joined.

Defined results: a null or empty text, or one whose tokens do not spell
a space and the text byte by byte, has no tokens and zeros everywhere.
Rows are told apart by a number of their own, so repeated rows and null
or repeated ids each give a row and each count as a document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

#: Most pairs in the broadcast table, characters aligned at a time, links of a group that are listed one by one.
HEAD, BLOCK_CHARS, LISTED = 1 << 17, 1 << 20, 4096
#: Pairs a task holds before it passes its counts on.
HELD = 1 << 22
_WORKER: dict[tuple[str, str], "Aligner"] = {}


def segments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows (i, j, n): from token i of A and j of B, n one-to-one groups, then one irregular group up to the next row.

    ``a`` and ``b`` are increasing ends with the same last value."""
    a, b = np.ascontiguousarray(a, "<i8"), np.ascontiguousarray(b, "<i8")
    ends_a, ends_b = a.tolist(), b.tolist()
    raw_a, raw_b = a.tobytes(), b.tobytes()
    out: list[tuple[int, int, int]] = []
    i = j = 0
    while i < len(ends_a):
        start, shift = i, j - i
        step, growing = 1, True
        while step:
            hi = i + step
            if raw_a[8 * i:8 * hi] == raw_b[8 * (i + shift):8 * (hi + shift)] and hi <= len(ends_a):
                i = hi
                step = step * 2 if growing else step // 2
            else:
                growing = False
                step //= 2
        out.append((start, start + shift, i - start))
        j = i + shift
        if i < len(ends_a):
            x, y = ends_a[i], ends_b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = ends_a[i]
                else:
                    j += 1
                    y = ends_b[j]
            i, j = i + 1, j + 1
    return np.array(out, np.int64).reshape(-1, 3)


def group_starts(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First A and first B token of every group, the numbers of tokens last."""
    s = segments(a, b)
    after = np.append(s[1:, 0], len(a))
    count = s[:, 2] + (after > s[:, 0] + s[:, 2])
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return (np.append(np.repeat(s[:, 0], count) + within, len(a)), np.append(np.repeat(s[:, 1], count) + within, len(b)))


def _piece_bytes(model) -> list[bytes]:
    return [bytes([int(p[1:-1], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, model.id_to_piece(i)) for i in range(model.vocab_size()))]


class Aligner:
    """Both tokenizers, and the strings of ids with each mark behind them."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        self.a = tokens.Encoder(a_path)
        self.a.special = []  # special strings are plain text
        letter = tokens.byte_letters()
        self.a_bytes = [b""] * len(self.a.size)
        for t, i in self.a.tokenizer.get_vocab(with_added_tokens=False).items():
            self.a_bytes[i] = bytes(letter[c] for c in t)
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = _piece_bytes(self.b)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.n_b = len(self.b_size)
        self.code = np.dtype("<u4") if len(self.a_size) * self.n_b <= 1 << 32 else np.dtype("<u8")
        self.marked = [f"{i}{m}" for i in range(max(len(self.a_size), self.n_b)) for m in ",|;"]

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(A ids, B ids) of each text; none where the bytes differ."""
        texts = [t or "" for t in texts]
        a = [np.frombuffer(x, "<u4").astype(np.int64) for x in self.a.encode([" " + t if t else "" for t in texts])]
        b = [np.array(x, np.int64) for x in self.b.encode(texts, num_threads=1)]
        none = np.zeros(0, np.int64)
        out = []
        for t, x, y in zip(texts, a, b):
            raw = b" " + t.encode()
            same = t and b"".join([self.a_bytes[i] for i in x.tolist()]) == raw == b"".join([self.b_bytes[i] for i in y.tolist()])
            out.append((x, y) if same else (none, none))
        return out

    def run(self, texts: list[str | None], digest: bool) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, groups or their hash, distinct pairs, links of each pair) of each text."""
        ids = self.encode(texts)
        n_a, n_b = (np.array([len(p[k]) for p in ids], np.int64) for k in (0, 1))
        a, b = (np.concatenate([p[k] for p in ids]) for k in (0, 1))
        # one sequence of all texts: their ends are common ends
        a0, b0 = group_starts(np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]))
        size_a, size_b = np.diff(a0), np.diff(b0)
        last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
        group_end = np.searchsorted(a0[:-1], last_a)
        group_of = np.diff(np.append(0, group_end))
        links = np.append(0, np.cumsum(size_a * size_b))
        n_links = np.diff(np.append(0, links[group_end]))
        doc, code, times = self._pairs(a, b, a0, b0, np.repeat(np.arange(len(ids)), group_of))
        bounds = np.searchsorted(doc, np.arange(len(ids) + 1))
        shown = self._shown(a, b, a0, b0, size_a, size_b)
        out, lo = [], 0
        for i, hi in enumerate((last_a + last_b).tolist()):
            text = "".join([self.marked[x] for x in shown[lo:hi].tolist()])[:-1]
            lo = hi
            s = slice(bounds[i], bounds[i + 1])
            if digest and text:
                text = hashlib.sha256(text.encode()).hexdigest()
            out.append((int(n_a[i]), int(n_b[i]), int(group_of[i]), int(n_links[i]), text, code[s].astype(self.code).tobytes(), _narrow(times[s])))
        return out

    def _pairs(self, a, b, a0, b0, doc) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, links) of the distinct pairs of each text, in order."""
        size_a, size_b = np.diff(a0), np.diff(b0)
        of = size_a * size_b
        few = np.flatnonzero(of <= LISTED)
        g = np.repeat(few, of[few])
        k = np.arange(len(g)) - np.repeat(np.cumsum(of[few]) - of[few], of[few])
        docs = [doc[g]]
        codes = [a[a0[g] + k // size_b[g]] * self.n_b + b[b0[g] + k % size_b[g]]]
        times = [np.ones(len(g), np.int64)]
        for m in np.flatnonzero(of > LISTED):  # long groups: distinct ids by their numbers
            x, nx = np.unique(a[a0[m]:a0[m + 1]], return_counts=True)
            y, ny = np.unique(b[b0[m]:b0[m + 1]], return_counts=True)
            codes.append((x[:, None] * self.n_b + y).reshape(-1))
            times.append((nx[:, None] * ny).reshape(-1))
            docs.append(np.full(len(codes[-1]), doc[m]))
        doc, code, n = np.concatenate(docs), np.concatenate(codes), np.concatenate(times)
        order = np.lexsort((code, doc)) if self.code.itemsize == 8 else np.argsort(doc << 32 | code, kind="stable")
        doc, code, n = doc[order], code[order], n[order]
        new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (code[1:] != code[:-1]))) if len(doc) else np.zeros(0, np.int64)
        return doc[new], code[new], np.add.reduceat(n, new) if len(new) else n

    def _shown(self, a, b, a0, b0, size_a, size_b) -> np.ndarray:
        """Numbers in ``marked`` of all ids as they are written: a group's A ids, then its B ids."""
        out = np.empty(len(a) + len(b), np.int64)
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[a0[1:] - 1] = 1
        mark_b[b0[1:] - 1] = 2
        out[np.arange(len(a)) + np.repeat(b0[:-1], size_a)] = 3 * a + mark_a
        out[np.arange(len(b)) + np.repeat(a0[1:], size_b)] = 3 * b + mark_b
        return out


def _narrow(n: np.ndarray) -> bytes:
    """Little-endian numbers of the least width that holds them all."""
    top = int(n.max(initial=0))
    return n.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8").tobytes()


def _wide(raw: bytes, count: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // count}").astype(np.int64) if count else np.zeros(0, np.int64)


def aligner(a_path: str, b_path: str) -> Aligner:
    """The worker's aligner of two tokenizer files."""
    key = (a_path, b_path)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Aligner(*key)
    return _WORKER[key]


_SCHEMA = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
           "pairs binary, times binary, width int")


def aligned(docs: DataFrame, a_path: str, b_path: str, digest: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A written table with one row per document: its numbers, groups (or their sha256) and packed pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text")
            for lo, hi in common.text_spans(texts, BLOCK_CHARS):
                own = aligner(a_path, b_path)
                cols = list(zip(*own.run(texts.slice(lo, hi - lo).to_pylist(), digest)))
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("row").slice(lo, hi - lo), b.column("doc_id").slice(lo, hi - lo), *(pa.array(c, k) for c, k in zip(cols, kinds)),
                     pa.array([own.code.itemsize] * (hi - lo), pa.int32())],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times", "width"])
    numbered = common.id_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    return common.materialise(numbered.mapInArrow(run, _SCHEMA), "alignment")


def _codes(raw: list[bytes], width: list[int]) -> list[np.ndarray]:
    return [np.frombuffer(x, f"<u{w}").astype(np.int64) for x, w in zip(raw, width)]


def pair_counts(table: DataFrame, n_b: int) -> DataFrame:
    """(pair, n, best): documents that hold each pair, and whether no pair of its A id is in more.

    A pair is its A id times ``n_b`` (the size of B's vocabulary) plus its B id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held: list[np.ndarray] = []

        def merge() -> None:
            nonlocal pair, n
            new, count = np.unique(np.concatenate([*held, pair[:0]]), return_counts=True)
            held.clear()
            both, at = np.unique(np.concatenate([pair, new]), return_inverse=True)
            total = np.zeros(len(both), np.int64)
            np.add.at(total, at, np.concatenate([n, count]))
            pair, n = both, total

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], ["pair", "n"])
        for b in batches:
            held += _codes(b.column("pairs").to_pylist(), b.column("width").to_pylist())
            if sum(map(len, held)) > HELD:
                merge()
                if len(pair) > HELD:
                    yield out()
                    pair, n = pair[:0], n[:0]
        merge()
        if len(pair):
            yield out()
    counts = (table.select("pairs", "width").mapInArrow(run, "pair long, n long")
              .groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a", F.floor(F.col("pair") / n_b)))
    counts = common.materialise(counts, "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return common.materialise(counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-best")


def _head_limit(counts: DataFrame, head: int) -> int:
    """The least power of two such that at most ``head`` pairs count as much."""
    sizes = {r.k: r.of for r in counts.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).agg(F.count("*").alias("of")).collect()}
    total, k = 0, max(sizes, default=-1) + 1
    while k > 0 and total + sizes.get(k - 1, 0) <= head:
        k -= 1
        total += sizes.get(k, 0)
    return 1 << k


def scored(table: DataFrame, counts: DataFrame, head: int = HEAD) -> DataFrame:
    """``table`` with ``n_best`` and ``count_sum`` of each document's links."""
    spark = table.sparkSession
    limit = _head_limit(counts, head)
    top = counts.where(F.col("n") >= limit).toArrow().sort_by("pair")
    shared = spark.sparkContext.broadcast(tuple(top.column(c).to_numpy() for c in ("pair", "n", "best")))

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        pairs, n, best = shared.value
        sums, bests, rest, times = [], [], [], []
        for codes, raw in zip(_codes(b.column("pairs").to_pylist(), b.column("width").to_pylist()), b.column("times").to_pylist()):
            k = _wide(raw, len(codes))
            at = np.searchsorted(pairs, codes)
            found = at < len(pairs)
            found[found] = pairs[at[found]] == codes[found]
            hit = at[found]
            sums.append(int((n[hit] * k[found]).sum()))
            bests.append(int(k[found][best[hit]].sum()))
            rest.append(codes[~found])
            times.append(k[~found])
        return pa.RecordBatch.from_arrays(
            [b.column("row"), pa.array(sums, pa.int64()), pa.array(bests, pa.int64()),
             *(pa.array(x, pa.list_(pa.int64())) for x in (rest, times))], ["row", "count_sum", "n_best", "rest", "k"])
    known = common.materialise(table.select("row", "pairs", "times", "width").mapInArrow(
        common.per_batch(batch), "row long, count_sum long, n_best long, rest array<long>, k array<long>"), "alignment-head")
    tail = (known.select("row", F.explode(F.arrays_zip("rest", "k")).alias("x")).select("row", F.col("x.rest").alias("pair"), F.col("x.k").alias("k"))
            .join(counts.where(F.col("n") < limit), "pair")
            .groupBy("row").agg(F.sum(F.col("k") * F.col("n")).alias("tail_sum"), F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("tail_best")))
    total = known.select("row", "count_sum", "n_best").join(tail, "row", "left").select(
        "row", (F.col("n_best") + F.coalesce("tail_best", F.lit(0))).alias("n_best"), (F.col("count_sum") + F.coalesce("tail_sum", F.lit(0))).alias("count_sum"))
    return table.join(total, "row")


def vocabulary_size(b_path: str) -> int:
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=b_path).vocab_size()


def align(docs: DataFrame, a_path: str, b_path: str, digest: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups): ``groups`` as ``a1,a2|b1;a3|b2``,
    or with ``digest`` its sha256 ('' without tokens)."""
    table = aligned(docs, a_path, b_path, digest, id_col, text_col)
    out = scored(table, pair_counts(table, vocabulary_size(b_path)))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
