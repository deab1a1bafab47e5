import random
import re

import numpy as np
import pytest

from eventlens.llm import pii

SCHEMA = "doc_id long, text string, base string, spans string"


def slow_base(t):
    t = t or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]

    def digits(s):
        return [int(c) for c in s if c in "0123456789"]

    def check(d):
        return sum(sum(divmod(2 * x, 10)) if i % 2 else x for i, x in enumerate(reversed(d))) % 10 == 0
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 12 <= len(digits(m[0])) <= 19 and check(digits(m[0]))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0]), s[2]))


def _card(rng):
    d = [rng.randint(0, 9) for _ in range(15)]
    return next("".join(map(str, [*d, x])) for x in range(10) if pii.luhn("".join(map(str, [*d, x]))))


def _docs(n, seed=0):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghilmnorstué") for _ in range(rng.randint(2, 9)))
    rows = []
    for i in range(n):
        t = [word() for _ in range(rng.randint(5, 80))]
        kind = rng.choice([*pii.KINDS, "none"])
        s = {"email": f"{word().replace('é', 'e')}.{rng.randint(10, 99)}@mail{rng.randint(0, 9)}.example.com", "card": _card(rng),
             "ip": ".".join(str(rng.randint(0, 255)) for _ in range(4)),
             "phone": f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}", "none": word()}[kind]
        t.insert(rng.randint(0, len(t)), s)
        rows.append((i, " ".join(t), kind, s))
    return rows


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    parts = ["a@b.c", "a.b@c", "@", "x@y.z@w.v", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "+1 (234) 555-1234", "+", "+12", "4111 1111 1111 1111",
             "4111-1111-1111-1111", "4111111111111112", "0", "00000000000000", "é", " ", "  ", "-", ".", "+1+2", "٣", "(", "0001.2.3.4", "\n"]
    for _ in range(6000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert pii.base_spans(t) == slow_base(t), t
    assert pii.base_spans("1" * 200_000) == [] and pii.base_spans("a" * 200_000 + "@") == []


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    t = pii.Tagger.fresh(1)
    t.p = {k: v.astype(np.float64) for k, v in t.p.items()}
    x, y = rng.integers(0, pii.VOCABULARY, (7, 3)), rng.integers(0, pii.TAGS, (7, 3))
    _, grad = t.loss(x, y)
    for k in t.p:
        i = tuple(rng.integers(0, s) for s in t.p[k].shape)
        i = (x[2, 1], i[1]) if k[0] == "w" else i
        old = t.p[k][i]
        t.p[k][i] = old + 1e-2
        up = t.loss(x, y)[0]
        t.p[k][i] = old - 1e-2
        down = t.loss(x, y)[0]
        t.p[k][i] = old
        assert abs((up - down) / 2e-2 - grad[k][i]) < 2e-3 * max(1, abs(grad[k][i]))


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(4)
    t = pii.Tagger.fresh(2)
    t.p["t"] = rng.normal(0, 2, t.p["t"].shape).astype(np.float32)
    x = rng.integers(0, pii.VOCABULARY, (4, 2))
    s, _ = t.scores(x)
    import itertools
    for lane in range(2):
        best = max(itertools.product(range(pii.TAGS), repeat=4), key=lambda y: sum(s[k, lane, y[k]] for k in range(4)) + sum(t.p["t"][a, b] for a, b in zip(y, y[1:])))
        assert tuple(t.decode(x)[:, lane]) == best


@pytest.fixture(scope="module")
def tagger(spark):
    return pii.train(spark.createDataFrame([(i, t, "b", "s") for i, t, _, _ in _docs(600)], SCHEMA))


def test_tagger_on_held_out_spans(tagger):
    rows = [r for r in _docs(300, seed=9)]
    found = pii.added_spans(tagger, [t for _, t, _, _ in rows])
    base = [pii.base_spans(t) for _, t, _, _ in rows]
    assert sum(s in f for b, f in zip(base, found) for s in b) >= 0.95 * sum(map(len, base))
    rng = np.random.default_rng(3)
    hits = n = extra = 0
    for _, t, kind, s in rows:
        at = t.index(s)
        if kind == "none":
            extra += len(pii.find(tagger, [t])[0][1])
            continue
        v = pii.variant(kind, s, rng)
        b, spans = pii.find(tagger, [t[:at] + v + t[at + len(s):]])[0]
        n += 1
        hits += (kind, at, at + len(v)) in spans
    assert hits >= 0.8 * n and extra == 0


def test_skipped_windows_could_add_nothing(tagger):
    texts = [t for _, t, _, _ in _docs(120, seed=5)] + ["", "no digits at all " * 30, "(x) [y] 12 " * 40, "call (212) 555-0000 or a [at] b.example " * 9]
    base = [pii.base_spans(t) for t in texts]
    for t, b, few, every in zip(texts, base, pii.added_spans(tagger, texts), pii.added_spans(tagger, texts, every=True)):
        assert pii.reconcile(t, b, few) == pii.reconcile(t, b, every)


def test_detect_and_mask(spark, tagger):
    rows = [(i, t, "b", "s") for i, t, _, _ in _docs(60, seed=2)]
    rows += [(100, None, None, None), (101, "", "", ""), (None, "me@a.example", None, None), (3, rows[3][1], "b", "s"),
             (102, "x " * 100_000 + "+1 (212) 555-1234", "b", "s")]
    df = spark.createDataFrame(rows, SCHEMA)
    for t in (tagger, None):
        got = sorted((repr(r.doc_id), r.base, r.spans) for r in pii.detect(df, t).collect())
        assert [(i, b) for i, b, _ in got] == sorted((repr(i), pii.named(slow_base(x))) for i, x, _, _ in rows)
        assert all(set(b.split(",")) <= set(s.split(",")) for _, b, s in got)
    out = pii.mask(df, tagger)
    assert out.schema == df.schema
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[None] == "[EMAIL]" and texts[100] is None and texts[102].endswith(" [PHONE]")
    assert pii.detect(df.limit(0), tagger).count() == 0


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "plain words", None, None)], SCHEMA)
    assert pii.train(df) is None and pii.train(df.limit(0)) is None


def test_long_digit_runs():
    zeros = "0" * 5000
    assert pii.base_spans(f"a {zeros}1.1.1.1 b") == [("ip", 2, 2 + len(zeros) + 7)]
    assert pii.base_spans(f"{zeros}256.1.1.1 {'9' * 6000}.1.1.1 +{'1' * 5000}") == []
    assert pii.base_spans("0.0.0.0") == [("ip", 0, 7)]


def test_spans_go_on_behind_the_edge_of_a_window():
    text = "x" * 70 + " someone [at] " + "long" * 60 + " [dot] example " + "y" * 100
    start, end = 71, 71 + len("someone [at] " + "long" * 60 + " [dot] example")
    gold = pii.tags(len(text), [("email", start, end)])

    class Fixed:
        """Gives each window the true tags of its place."""

        def decode(self, x):
            y = np.zeros(x.shape, np.int8)
            for j in range(x.shape[1]):
                row = x[:, j]
                full = pii.encode(text)
                for core in range(0, len(text), pii.CORE):
                    a = max(0, core - pii.LEFT)
                    own = full[a:core + pii.CORE + pii.RIGHT]
                    at = a - core + pii.LEFT
                    if (row[at:at + len(own)] == own).all() and not row[:at].any() and not row[at + len(own):].any():
                        y[at:at + len(own), j] = gold[a:a + len(own)]
                        break
            return y
    assert ("email", start, end) in pii.added_spans(Fixed(), [text], every=True)[0]
    assert pii.reconcile(text, [], [("email", start, end)]) == [("email", start, end)]
