import random
import time

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from eventlens.llm import token_counts, words

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, n_bytes string, n_tokens string"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def _texts(seed, n):
    rng = random.Random(seed)
    tricky = words.SPACE_CHARS + "\x1c\x1d᠎​﻿ab1'sé٣²,!\U0001F600relvdtm--"
    wide = [*range(32, 127)] * 3 + [*range(160, 0x3000), *range(0xA000, 0xA800)]
    out = ["".join(rng.choice(tricky) for _ in range(rng.randint(0, 16))) for _ in range(n)]
    out += ["".join(chr(rng.choice(wide)) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    out += ["the " * 700, "a" * 3000, " " * 700 + "x", "-" * 500, "don't we'll I've'd 's'RE 'l 'r 'v", "'", "'l", "'r\n",
            "<|endoftext|>a<|endoftext|><|endoftext|> b <|endoftext", "\n\n\n\n", "", None, " ", "\U00010d40Ᲊ ᲊ1"]
    return out


def test_counts_equal_the_library(library):
    texts = _texts(1, 4000)
    assert token_counts.count_texts(PATH, texts) == library(texts)


def test_chunk_and_block_sizes_do_not_matter(library, monkeypatch):
    texts = _texts(2, 300)
    want = library(texts)
    for chunk, block, cells in ((1, 64, 1 << 20), (7, 1000, 70_000), (64, 1 << 20, 1 << 30)):
        monkeypatch.setattr(token_counts, "CHUNK", chunk)
        monkeypatch.setattr(words, "CHUNK", chunk)
        monkeypatch.setattr(token_counts, "BLOCK_CHARS", block)
        monkeypatch.setattr(token_counts, "MAX_CELLS", cells)  # the table is dropped and compiled anew
        assert token_counts.count_texts(PATH, texts) == want


def test_scan_composes_like_a_loop():
    rng = np.random.default_rng(0)
    maps = rng.integers(0, 11, (37, 11))
    got = words.compose(maps)
    state = np.arange(11)
    for i in range(37):
        state = maps[i][state]
        assert (got[i] == state).all()


def test_long_texts_are_cut_where_counts_add(library):
    text = "one two  three\n\n four'll " * 5000
    cuts = token_counts._cuts(text, 1000)
    assert len(cuts) > 50 and "".join(cuts) == text
    assert sum(library(cuts)) == library([text])[0]


def test_table(spark, library):
    texts = _texts(3, 50)
    rows = [(i, t, "a", "b") for i, t in enumerate(texts)] + [(None, "x y", None, None), (0, texts[0], "a", "b")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((repr(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(df, PATH, limit=50).collect())
    counts = library([r[1] for r in rows])
    assert got == sorted((repr(r[0]), len((r[1] or "").encode()), n, n > 50) for r, n in zip(rows, counts))
    assert token_counts.token_counts(df.limit(0), PATH).count() == 0


def test_unbroken_words(library, monkeypatch):
    rng = random.Random(11)
    long = ["a" * 70_000, "".join(rng.choice("abcdefghij") for _ in range(300_000)), "é" * 40_000, "東京" * 20_000, "x" + "-=" * 30_000,
            "ab" * 20_000 + " end of it", "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(30_000))]
    want = library(long)
    began = time.perf_counter()
    assert token_counts.count_texts(PATH, long) == want
    assert time.perf_counter() - began < 30  # a byte at a time through numpy took 20 µs each
    monkeypatch.setattr(token_counts, "MAX_CELLS", 200_000)  # the table is dropped on the way
    assert token_counts.count_texts(PATH, long) == want
    for few in (0, 1, 1000):
        monkeypatch.setattr(token_counts, "FEW", few)
        assert token_counts.count_texts(PATH, [long[2], long[4][:5000], "some words " * 500, long[1][:3000]]) == library(
            [long[2], long[4][:5000], "some words " * 500, long[1][:3000]])
