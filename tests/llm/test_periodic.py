import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from eventlens.llm import periodic, queries

SCHEMA = "doc_id long, text string, runs string, collapsed string, `a.b` string, sym long"


def slow_runs(w):
    """All runs by trying every period at every word."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length = i + q - s
            if i > s and length >= max(6, 4 * q) and not any(
                    all(w[k] == w[k + r] for k in range(s, s + length - r)) for r in range(1, q)):
                out.append((s, length, q))
            i += i == s
    return sorted(out, key=lambda r: (r[0], r[2]))


def slow_text(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def _words(rng, alphabet="abc"):
    w = []
    while len(w) < rng.randint(0, 120):
        if rng.random() < 0.5:
            u = [rng.choice(alphabet) for _ in range(rng.randint(1, 8))]
            w += (u * rng.randint(1, 9))[:rng.randint(1, 60)]
        else:
            w += [rng.choice(alphabet) for _ in range(rng.randint(1, 9))]
    return w


def test_runs_equal_brute_force():
    rng = random.Random(13)
    for _ in range(40):
        some = [_words(rng, rng.choice(["ab", "abc", "a", "abcdefgh"])) for _ in range(30)]
        for w, (runs, collapsed) in zip(some, periodic.find([" ".join(w) for w in some])):
            want = slow_runs(w)
            assert runs == want
            assert collapsed == slow_text(w, want)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=70), max_size=4))
def test_any_words(some):
    for w, (runs, _) in zip(some, periodic.find([" ".join(w) for w in some])):
        assert runs == slow_runs(w)


def test_grammar_spells_the_words_and_answers_extensions():
    rng = np.random.default_rng(3)
    words = np.concatenate([[90], np.tile([1, 2, 2, 2, 3], 40), [91], rng.integers(0, 3, 300), [92], np.ones(200, np.int64), [93]])
    levels = periodic.grammar(words)
    assert len(levels[-1].sym) == 1
    spelled = {int(s): [int(s)] for s in words}
    for low, high in zip(levels, levels[1:]):
        for k, s in enumerate(high.sym.tolist()):
            body = [x for c in low.sym[low.starts[k]:low.starts[k + 1]].tolist() for x in spelled[c]]
            assert spelled.setdefault(s, body) == body  # a name stands for one stretch
    assert spelled[int(levels[-1].sym[0])] == words.tolist()
    i = rng.integers(0, len(words) - 1, 3000)
    j = i + 1 + rng.integers(0, len(words), 3000) % (len(words) - i - 1)
    ahead = periodic.extensions(levels, i, j)
    back = periodic.extensions([x.mirrored() for x in levels], len(words) - 1 - j, len(words) - 1 - i)
    w = words.tolist()
    for a, b, f, r in zip(i.tolist(), j.tolist(), ahead.tolist(), back.tolist()):
        n = 0
        while b + n < len(w) and w[a + n] == w[b + n]:
            n += 1
        m = 0
        while a - m >= 0 and w[a - m] == w[b - m]:
            m += 1
        assert (f, r) == (n, m)


def test_strongest_run():
    assert periodic._strongest([]) is None
    assert periodic._strongest([(0, 8, 2), (9, 6, 1), (20, 12, 2)]) == (9, 6, 1)
    assert periodic._strongest([(3, 9, 2), (30, 18, 4), (40, 9, 2)]) == (3, 9, 2)


def test_long_repetition_and_blocks(monkeypatch):
    text = "For " * 30_000 + "x y z " * 20_000 + "end"
    (runs, collapsed), = periodic.find([text])
    assert runs == [(0, 30_000, 1), (30_000, 60_000, 3)] and collapsed == "For x y z end"


def test_table(spark, monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(_words(rng)) for _ in range(40)] + [None, "", " \n\t ", "a a a a a", "a a a a a a", "a\x0ba\x0ca\ta\na\ra", "é\xa0é é é é é é é\xa0é", "ab\x1cab " * 9]
    rows = [(i, t, "x", "y", "z", 1) for i, t in enumerate(texts)] + [(None, "b b b b b b b", None, None, None, None), (4, texts[4], "", "", "", 2), (4, texts[5], "", "", "", 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((repr(r.doc_id), [tuple(x) for x in r.runs], r.strongest and tuple(r.strongest), r.collapsed) for r in periodic.runs(df).collect())
    want = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")
        own = slow_runs(w)
        want.append((repr(r[0]), own, min(own, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None), slow_text(w, own)))
    assert got == sorted(want)
    assert periodic.runs(df.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op13_periodic_runs(spark, sf).collect()
    assert len(got) == len(docs) and sum(r.n_runs for r in got) > 10
    for r in got:
        w = re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id] or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
        runs = slow_runs(w) if n < 3000 else periodic.find([" ".join(w)])[0][0]
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(slow_text(w, runs).encode()).hexdigest()
        top = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*top, 1000 * top[1] // top[2]) if top else (None,) * 4)
