"""Token-id files: canonical length-limited Huffman coding with checkpoints.

Ids are counted over all documents, giving one canonical code for the
corpus, at most ``MAX_BITS`` long (package-merge).  Documents are dealt
into ranges of ascending doc_id; a range is cut into blocks of whole
documents, and each block is a row of a Parquet file written by Spark:

    part, block     place in the order of documents
    before, n_ids   ids of the part before this block, and in it
    doc_ids, sizes  its documents (int64, and ids each, int64)
    checkpoints     bit offset of every ``STRIDE``-th id (uint64)
    bits            the code words, highest bit first

with the code (one length per id) in a side table.  A block decodes on
its own, and inside it every checkpoint starts an independent lane: all
lanes step together through a lookup table of ``MAX_BITS`` bits.

Defined results: null or empty text is the end id alone; rows of one
doc_id are ordered by the hash of their texts, a null doc_id comes first;
an empty table gives files without blocks.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

MAX_BITS = 20
STRIDE = 128
BLOCK_IDS = 1 << 17
BLOCK_SCHEMA = "part int, block int, before long, n_ids long, doc_ids binary, null_ids binary, sizes binary, checkpoints binary, bits binary"


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits, by package-merge."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    limit = max(limit, math.ceil(math.log2(len(used))))
    order = used[np.argsort(counts[used], kind="stable")]
    coins = counts[order].astype(np.float64)
    level, tops = coins, []
    for _ in range(limit - 1):
        pairs = level[:len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([coins, pairs])
        at = np.argsort(merged, kind="stable")
        tops.append(at < len(coins))
        level = merged[at]
    # walk back: of the first n entries of a level, the coins cost a bit, the packages open two each below
    take = 2 * (len(order) - 1)
    for own in reversed(tops):
        coins_in = int(own[:take].sum())
        lengths[order[:coins_in]] += 1
        take = 2 * (take - coins_in)
    lengths[order[:take]] += 1
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Code word of each id: shorter first, then by id."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    code, last = 0, 0
    n = lengths[order].astype(int).tolist()
    for i, k in zip(order.tolist(), n):
        code <<= k - last
        codes[i] = code
        code, last = code + 1, k
    return codes


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(checkpoints, bits) of a run of ids."""
    n = lengths[ids]
    ends = np.cumsum(n, dtype=np.int64)
    starts = ends - n
    total = int(ends[-1]) if len(ids) else 0
    words = np.zeros(total // 32 + 3, np.uint64)
    # a code of at most 32 bits lies in the 64 bits from its first 32-bit word on; bits of
    # different codes never overlap, so adding the codes that begin in a word is or-ing them
    left = codes << (np.uint64(64) - np.maximum(lengths, 1).astype(np.uint64))
    at = starts >> 5
    cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(ids) else np.empty(0, np.int64)
    if len(cut):
        both = np.add.reduceat(left[ids] >> (starts & 31).astype(np.uint64), cut)
        words[at[cut]] = both >> np.uint64(32)
        words[at[cut] + 1] += both & np.uint64(0xFFFFFFFF)
    return starts[::STRIDE].astype("<u8"), words.astype(">u4").tobytes()[:(total + 7) // 8]


class Decoder:
    """Table-driven decoding of packed ids."""

    def __init__(self, lengths: np.ndarray):
        self.width = max(1, int(lengths.max(initial=1)))
        self.id = np.zeros(1 << self.width, np.uint32)
        self.length = np.zeros(1 << self.width, np.uint8)
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        # canonical codes, left-aligned, ascend: each fills the table up to the next
        room = np.uint64(1) << (np.uint64(self.width) - lengths[order].astype(np.uint64))
        filled = np.repeat(order, room.astype(np.int64))
        self.id[:len(filled)] = filled
        self.length[:len(filled)] = lengths[filled]

    def unpack(self, bits: bytes, checkpoints: np.ndarray, total: int) -> np.ndarray:
        out = np.zeros((len(checkpoints), STRIDE), np.uint32)
        raw = np.frombuffer(bits + b"\0" * 12, np.uint8)
        raw = raw[:len(raw) // 4 * 4].view(">u4").astype(np.uint64)
        raw = (raw[:-1] << np.uint64(32)) | raw[1:]
        at = checkpoints.astype(np.int64)
        top = np.uint64(64 - self.width)
        last = total - STRIDE * (len(checkpoints) - 1) if len(checkpoints) else 0
        for k in range(STRIDE if len(checkpoints) > 1 else last):
            if k == last:
                at = at[:-1]  # the last lane is shorter
            peek = ((raw[at >> 5] << (at & 31).astype(np.uint64)) >> top).astype(np.int64)
            out[:len(at), k] = self.id[peek]
            at = at + self.length[peek]
        return out.reshape(-1)[:total]


def _blocks(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """Blocks of plain ids in ascending doc_id; ties by text, so that the order is one.

    The text travels, not its ids, and is encoded after the shuffle."""
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    docs = common.id_text(docs).repartitionByRange(*keys).sortWithinPartitions(*keys)
    tail = np.array([end], "<u4").tobytes()

    def blocks(batches):
        from pyspark import TaskContext
        part, block, before = TaskContext.get().partitionId(), 0, 0
        enc = tokens.encoder(tokenizer)
        z = zstandard.ZstdCompressor(level=1)
        held, size = [], 0

        def flush():
            every = np.frombuffer(b"".join(h[1] for h in held), "<u4")
            if every.max() < 1 << 16:
                every = every.astype("<u2")
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([before], pa.int64()), pa.array([size], pa.int64()),
                pa.array([np.array([h[0] or 0 for h in held], "<i8").tobytes()], pa.binary()),
                pa.array([np.packbits([h[0] is None for h in held]).tobytes()], pa.binary()),
                pa.array([np.array([len(h[1]) // 4 for h in held], "<i8").tobytes()], pa.binary()),
                pa.array([every.itemsize], pa.int32()), pa.array([z.compress(every.tobytes())], pa.binary())],
                ["part", "block", "before", "n_ids", "doc_ids", "null_ids", "sizes", "width", "ids"])
        for b in batches:
            texts = b.column("text")
            for lo, hi in common.text_spans(texts):
                ids = enc.encode(texts.slice(lo, hi - lo).to_pylist())
                for doc, x in zip(b.column("doc_id").slice(lo, hi - lo).to_pylist(), ids):
                    held.append((doc, x + tail))
                    size += len(held[-1][1]) // 4
                    if size >= BLOCK_IDS:
                        yield flush()
                        block, before, held, size = block + 1, before + size, [], 0
        if held:
            yield flush()
    return docs.mapInArrow(blocks, "part int, block int, before long, n_ids long, doc_ids binary, null_ids binary, sizes binary, width int, ids binary")


def _plain(width: int, ids: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(ids), f"<u{width}")


def _counts(blocks: DataFrame) -> DataFrame:
    """(id, n) over all documents; a task sends one row per id it met."""
    def run(batches):
        seen = np.zeros(1 << 16, np.int64)
        for b in batches:
            for width, x in zip(b.column("width"), b.column("ids")):
                n = np.bincount(_plain(width.as_py(), x.as_py()))
                if len(n) > len(seen):
                    seen = np.concatenate([seen, np.zeros(len(n) - len(seen), np.int64)])
                seen[:len(n)] += n
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["id", "n"])
    return blocks.select("width", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write(docs: DataFrame, path: str, tokenizer: str, end: int) -> None:
    """Write the files: ``path``/blocks and ``path``/code."""
    spark = docs.sparkSession
    blocks = common.materialise(_blocks(docs, tokenizer, end), "token-blocks")
    # at most one row per id of the vocabulary
    rows = _counts(blocks).collect()
    counts = np.zeros(max((r.id for r in rows), default=end) + 1, np.int64)
    for r in rows:
        counts[r.id] = r.n
    lengths = code_lengths(counts)
    code = spark.sparkContext.broadcast((lengths, canonical(lengths)))
    spark.createDataFrame([(MAX_BITS, STRIDE, int(counts.sum()), bytearray(lengths.tobytes()))],
                          "max_bits int, stride int, total long, lengths binary").coalesce(1).write.parquet(f"{path}/code")

    def encode(batches):
        for b in batches:
            packed = [pack(_plain(w, x), *code.value) for w, x in zip(b.column("width").to_pylist(), b.column("ids").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("part", "block", "before", "n_ids", "doc_ids", "null_ids", "sizes")]
                + [pa.array([p.tobytes() for p, _ in packed], pa.binary()), pa.array([x for _, x in packed], pa.binary())],
                ["part", "block", "before", "n_ids", "doc_ids", "null_ids", "sizes", "checkpoints", "bits"])
    blocks.mapInArrow(encode, BLOCK_SCHEMA).write.parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, ids): every document of the files, decoded; with
    ``digest`` (doc_id, start, n_tokens, ids_crc32) of those ids.

    ``start`` counts the ids of all documents before it.  Only one row
    per part (a write task) comes to the driver for the offsets."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    head = spark.read.parquet(f"{path}/code").first()
    lengths = spark.sparkContext.broadcast(np.frombuffer(bytes(head.lengths), np.uint8))
    sums = blocks.groupBy("part").agg(F.max(F.col("before") + F.col("n_ids")).alias("n")).collect()
    base, at = {}, 0
    for r in sorted(sums, key=lambda r: r.part):
        base[r.part] = at
        at += r.n

    def decode(batches):
        decoder = Decoder(lengths.value)
        for b in batches:
            for row in b.to_pylist():
                sizes = np.frombuffer(row["sizes"], "<i8")
                docs = np.frombuffer(row["doc_ids"], "<i8")
                null = np.unpackbits(np.frombuffer(row["null_ids"], np.uint8), count=len(docs)).astype(bool)
                total = int(sizes.sum())
                ids = decoder.unpack(row["bits"], np.frombuffer(row["checkpoints"], "<u8"), total)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                plain = [ids[s:e].astype("<u4").tobytes() for s, e in zip(starts, ends)]
                last = [pa.array(sizes), pa.array([zlib.crc32(p) for p in plain], pa.int64())] if digest else [pa.array(plain, pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, mask=null), pa.array(starts + base[row["part"]] + row["before"]), *last],
                    ["doc_id", "start", *(("n_tokens", "ids_crc32") if digest else ("ids",))])
    return blocks.mapInArrow(decode, "doc_id long, start long, " + ("n_tokens long, ids_crc32 long" if digest else "ids binary"))
