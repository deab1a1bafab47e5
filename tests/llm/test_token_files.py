import heapq
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from eventlens.llm import token_files, tokens, words

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, part string, ids string"


def test_code_lengths_are_optimal_and_complete():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 50, 700):
        counts = rng.integers(0, 10_000, n) ** 2
        counts[0] = 5
        lengths = token_files.code_lengths(counts, 40)
        heap = [int(c) for c in counts if c]
        heapq.heapify(heap)
        best = heap[0] if len(heap) == 1 else 0
        while len(heap) > 1:
            two = heapq.heappop(heap) + heapq.heappop(heap)
            best += two
            heapq.heappush(heap, two)
        assert (lengths.astype(np.int64) * counts).sum() == best
        if (counts > 0).sum() > 1:
            assert (2.0 ** -lengths[counts > 0].astype(float)).sum() == 1
        short = token_files.code_lengths(counts, 11)
        assert short.max() <= 11 and (2.0 ** -short[counts > 0].astype(float)).sum() <= 1


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_round_trip_of_a_block(n):
    rng = np.random.default_rng(n)
    ids = (rng.pareto(0.7, n) * 3).clip(0, 60_000).astype(np.uint32)
    lengths = token_files.code_lengths(np.bincount(ids, minlength=7))
    points, bits = token_files.pack(ids, lengths, token_files.canonical(lengths))
    assert token_files.Decoder(lengths).unpack(bits, points, n).tolist() == ids.tolist()
    if n > 128:  # a checkpoint decodes without what stands before it
        got = token_files.Decoder(lengths).unpack(bits, points[1:], n - 128)
        assert got.tolist() == ids[128:].tolist()


def test_word_cache_gives_the_library_ids():
    import random
    rng = random.Random(7)
    letters = words.SPACE_CHARS + "\x1c\x1dab1'sé٣²,!\U0001F600​"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 16))) for _ in range(3000)]
    texts += ["a <|endoftext|>b<|endoftext|>", "x" * 500, "don't we'll 'special", None]
    t = Tokenizer.from_file(PATH)
    got = tokens.Encoder(PATH).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_files_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 200)
    rows = [(i * 7 % 101, f"Text number {i} é\n" * (i % 9), "p", "i") for i in range(101)]
    rows += [(None, "no id", None, None), (5000, None, None, None), (5001, "long " * 60_000, None, None), (7, rows[1][1], None, None)]
    token_files.write(spark.createDataFrame(rows, SCHEMA).repartition(3), str(tmp_path), PATH, 2)
    got = sorted(token_files.read(spark, str(tmp_path), digest=True).collect(), key=lambda r: r.start)
    t = Tokenizer.from_file(PATH)
    ids = {(i, text): t.encode(text or "", add_special_tokens=False).ids + [2] for i, text, _, _ in rows}
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda i: -1 if i is None else i)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert {(r.doc_id, r.start, len(r.ids) // 4) for r in token_files.read(spark, str(tmp_path)).collect()} == {
        (r.doc_id, r.start, r.n_tokens) for r in got}
    want = sorted((repr(i), len(ids[i, x]), zlib.crc32(np.array(ids[i, x], "<u4").tobytes())) for i, x, _, _ in rows)
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want


def test_empty_table(spark, tmp_path):
    token_files.write(spark.createDataFrame([], SCHEMA), str(tmp_path), PATH, 2)
    assert token_files.read(spark, str(tmp_path)).count() == 0
