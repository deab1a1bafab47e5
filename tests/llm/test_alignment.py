import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from eventlens.llm import alignment, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, n_a string, row string, groups string, `a.b` string"


@pytest.fixture(scope="module")
def slow():
    """The rows of a table by the libraries, sets of ends and all pairs of each group."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letter = {}
    n = 0
    for i in range(256):
        if 33 <= i <= 126 or 161 <= i <= 172 or i >= 174:
            letter[chr(i)] = i
        else:
            letter[chr(256 + n)] = i
            n += 1

    def b_bytes(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()

    def groups(text):
        if not text:
            return []
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        xb = [bytes(letter[c] for c in a.id_to_token(i)) for i in x]
        yb = [b_bytes(i) for i in y]
        raw = (" " + text).encode()
        if b"".join(xb) != raw or b"".join(yb) != raw:
            return []

        def ends(parts):
            at, out = 0, []
            for p in parts:
                at += len(p)
                out.append(at)
            return out
        ex, ey = ends(xb), ends(yb)
        out, i, j = [], 0, 0
        for cut in sorted(set(ex) & set(ey)):
            gx = [x[k] for k in range(i, len(x)) if ex[k] <= cut]
            gy = [y[k] for k in range(j, len(y)) if ey[k] <= cut]
            i, j = i + len(gx), j + len(gy)
            out.append((gx, gy))
        return out

    def table(texts):
        found = [groups(t) for t in texts]
        links = [Counter((p, q) for x, y in g for p in x for q in y) for g in found]
        held = Counter(pair for c in links for pair in c)
        most = {}
        for (p, _), n in held.items():
            most[p] = max(most.get(p, 0), n)
        rows = []
        for g, c in zip(found, links):
            shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
            rows.append((sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()),
                         sum(k for pair, k in c.items() if held[pair] == most[pair[0]]), sum(k * held[pair] for pair, k in c.items()), shown))
        return rows
    return table


def _texts(seed, n):
    rng = random.Random(seed)
    words = "the ofthe tion ering Überraschung naïve 東京 😀 don't <s> </s> <|endoftext|> 12345 3.14 a▁b   \t \n\n -- ab1 ﬁ é".split(" ")
    out = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(n)]
    out += ["".join(chr(rng.choice([*range(32, 127), *range(160, 0x500), *range(0x4E00, 0x4E40)])) for _ in range(rng.randint(1, 60))) for _ in range(n)]
    return [*out, None, "", " ", "\n", "a", "a" * 3000, " " * 500, "=" * 999 + "x", "xy" * 700, "<|endoftext|>", "é" * 400, "▁"]


def test_segments_are_the_common_ends():
    rng = np.random.default_rng(5)
    for k in range(300):
        n = int(rng.integers(1, 60))
        share = rng.random() ** 2
        both = rng.random(n) < share
        a = np.flatnonzero(both | (rng.random(n) < 0.5))
        b = np.flatnonzero(both | (rng.random(n) < 0.5))
        a, b = (np.unique(np.append(x, n)) + 1 for x in (a, b))
        a0, b0 = alignment.group_starts(a, b)
        common = np.intersect1d(a, b)
        assert a[a0[1:] - 1].tolist() == common.tolist() == b[b0[1:] - 1].tolist()
        assert a0[0] == b0[0] == 0
    long = np.arange(1, 100_001)
    assert len(alignment.segments(long, long)) == 1  # one stretch is jumped over
    assert alignment.segments(long[:0], long[:0]).shape == (0, 3)


def test_table_equals_brute_force(spark, slow, monkeypatch):
    texts = _texts(1, 60)
    rows = [(i, t, "x", "y", "z", "w") for i, t in enumerate(texts)]
    rows += [(None, texts[0], None, None, None, None), (None, None, "", "", "", ""), (3, texts[3], "x", "y", "z", "w"), (3, texts[5], "x", "y", "z", "w")]
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted((repr(r[0]), *w) for r, w in zip(rows, slow([r[1] for r in rows])))

    def got(d, **options):
        return sorted((repr(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in alignment.align(d, A, B, **options).collect())
    assert got(df.repartition(3)) == want
    digested = [(*w[:7], hashlib.sha256(w[7].encode()).hexdigest() if w[7] else "") for w in want]
    assert got(df, digest=True) == digested
    table = alignment.aligned(df, A, B)
    counts = alignment.pair_counts(table, alignment.vocabulary_size(B))
    for head in (0, 7, 300):  # the joined pairs give what the broadcast ones give
        some = alignment.scored(table, counts, head).collect()
        assert sorted((repr(r.doc_id), r.n_best, r.count_sum) for r in some) == sorted((w[0], w[5], w[6]) for w in want)
    assert got(df.limit(0)) == []


def test_pieces_of_a_task_add_up(spark, monkeypatch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(_texts(2, 30))], "doc_id long, text string").coalesce(1)
    table = alignment.aligned(df, A, B)
    n_b = alignment.vocabulary_size(B)
    want = sorted(alignment.pair_counts(table, n_b).collect())
    with monkeypatch.context() as m:  # blocks and flushes do not change the counts
        m.setattr(alignment, "HELD", 50)
        m.setattr(alignment, "BLOCK_CHARS", 100)
        assert sorted(alignment.pair_counts(alignment.aligned(df, A, B), n_b).collect()) == want
    assert sum(r.n for r in want) == sum(len(r.pairs) // r.width for r in table.collect())


def test_a_long_group_is_counted_not_listed():
    own = alignment.aligner(A, B)
    a, b = np.array([1, 2, 1] * 4000), np.array([5, 6] * 3000)
    doc, code, n = own._pairs(a, b, np.array([0, len(a)]), np.array([0, len(b)]), np.array([0]))
    assert dict(zip(code.tolist(), n.tolist())) == {x * own.n_b + y: k for x, k in ((1, 8000 * 3000), (2, 4000 * 3000)) for y in (5, 6)}
    assert doc.tolist() == [0] * 4
    assert alignment._wide(alignment._narrow(n), 4).tolist() == n.tolist()


def test_query(spark, slow):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = {i: w for i, w in zip(docs, slow(list(docs.values())))}
    got = queries.op12_alignment(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        n_a, n_b, n_groups, n_links, n_best, count_sum, shown = want[r.doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) == (n_a, n_b, n_groups, n_links, n_best, count_sum)
        assert r.groups_sha256 == (hashlib.sha256(shown.encode()).hexdigest() if shown else "")
