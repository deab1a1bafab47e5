import random
import re
import zlib

import numpy as np
import pytest

from eventlens.llm import queries, toxicity

DOCS = "doc_id long, text string, score string, y string, fold string, h string, `a.b` string"


def test_features():
    lexicon = toxicity.Lexicon({"blargh": 3.0, "qui~": 1.0, "quibble": 4.0})
    of = dict(zip(toxicity.FEATURES, toxicity.features("You BLARGH, you quick quibble! idiot?! the the", lexicon)))
    n = 8
    assert (of["known"], of["strong"], of["mild"]) == (1 / n, 2 / n, 1 / n)
    assert (of["weight"], of["top"], of["distinct"]) == (8 / n, 4.0, np.log1p(2))
    assert (of["near"], of["second"]) == (4 / n, 2 / n)  # blargh, quick, quibble, idiot
    assert (of["exclaims"], of["asks"], of["mark_runs"], of["shouted"]) == (2 / n, 1 / n, 1 / n, 1 / n)
    assert of["capitals"] == 7 / 35
    for empty in (None, "", "12 !!", " \n"):
        assert toxicity.features(empty, lexicon) == [0.0] * len(toxicity.FEATURES)


@pytest.mark.parametrize("form", ["1d10t", "id!ot", "i-d-i-o-t", "i d i o t", "idiooooot", "id*ot", "$tupid", "s.t.u.p.i.d", "stup1d", "bl4rgh"])
def test_obfuscated_words_are_seen_through(form):
    lexicon = toxicity.Lexicon({"blargh": 3.0})
    of = dict(zip(toxicity.FEATURES, toxicity.features(f"what a {form} it is", lexicon)))
    assert of["revealed"] > 0 and of["mixed"] + of["drawn"] + of["spaced"] > 0


@pytest.mark.parametrize("form", ["well-known", "3.14", "x86 b2b", "a b c d e", "good***", "token = 0b96a8c8d79c", "e.g. so", "cool!!!", "hmmmm"])
def test_plain_writing_reveals_nothing(form):
    of = dict(zip(toxicity.FEATURES, toxicity.features(f"what a {form} it is", toxicity.Lexicon({"blargh": 3.0}))))
    assert of["revealed"] == 0


def test_isotonic_is_the_best_increasing_fit():
    rng = np.random.default_rng(1)
    for _ in range(30):
        n = int(rng.integers(1, 40))
        x, y = rng.integers(0, 12, n).astype(float), rng.integers(0, 2, n).astype(float)
        centre, value = toxicity.isotonic(x, y)
        assert (np.diff(value) > 0).all() and (np.diff(centre) > 0).all()
        # min-max formula: the fit at x is max over lo of min over hi of the mean of rows between
        u = np.unique(x)
        mean = {(a, b): y[(x >= a) & (x <= b)].mean() for a in u for b in u if a <= b}
        want = {v: max(min(mean[a, b] for b in u if b >= v) for a in u if a <= v) for v in u}
        assert np.allclose(sorted(set(np.round(list(want.values()), 12))), np.round(value, 12))


def test_a_tree_takes_the_best_split():
    rng = np.random.default_rng(2)
    x = rng.random((400, 5))
    y = ((x[:, 2] > 0.6) & (x[:, 4] < 0.5)).astype(float)
    base, trees = toxicity.boost(x, y, 60)
    p = toxicity._sigmoid(base + sum(t.predict(x) for t in trees))
    assert ((p >= 0.5) == (y == 1)).mean() > 0.99
    # the first split by trying every one
    at = toxicity.cuts(x)
    bins = np.stack([np.searchsorted(c, v) for c, v in zip(at, x.T)], 1)
    g, h = 0.5 - y, np.full(len(y), 0.25)
    tree, step = toxicity.grow(bins, at, g, h)

    def gain(f, t):
        left = x[:, f] <= t
        return sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (left, ~left))
    best = max(((gain(f, t), f, t) for f in range(5) for t in at[f]
                if min(h[x[:, f] <= t].sum(), h[x[:, f] > t].sum()) >= 1))
    assert (tree.feature[0], tree.threshold[0]) == best[1:]
    assert np.allclose(tree.predict(x), step)


def _docs(n, seed=0):
    """Invented texts; toxic ones hold words that begin with 'grob' or a known insult."""
    rng = random.Random(seed)
    syllables = "ma ti on re la sa vi do ne lu".split()
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.25
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(15, 90))]
        if toxic:
            for _ in range(rng.randint(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(["grob" + rng.choice(syllables), "idiot"]))
        rows.append((i, " ".join(words), "s", "y", "f", "h", "x"))
        labels.append((i, int(toxic), "t"))
    return rows, labels


def test_held_out_accuracy_and_edges(spark):
    rows, labels = _docs(500)
    extra = [(None, "idiot idiot", None, None, None, None, None), (900, None, "", "", "", "", ""), (901, "", "", "", "", "", ""), (3, rows[3][1], "s", "y", "f", "h", "x"),
             (902, "grobma " * 30_000, "", "", "", "", "")]
    df = spark.createDataFrame(rows + extra, DOCS)
    train = [x for x in labels if zlib.crc32(str(x[0]).encode()) % 5]
    lab = spark.createDataFrame([*train, (None, 1, ""), (7, None, ""), (train[0][0], 0, "")], "doc_id long, toxic int, text string")
    model = toxicity.train(df, lab)
    assert "grob~" in model.lexicon.weights
    got = toxicity.score(df, model).collect()
    assert len(got) == len(rows) + len(extra) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    truth = {i: y for i, y, _ in labels}
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 60 and sum(p == y for p, y in held) >= 0.97 * len(held)
    by_id = {r.doc_id: r for r in got}
    assert by_id[900].score == by_id[901].score and by_id[900].predicted == 0 and by_id[902].predicted == 1
    # neither order nor partitions change the model
    again = toxicity.score(df, toxicity.train(df.repartition(5), lab.repartition(3))).collect()
    assert sorted((repr(r.doc_id), round(r.score, 9)) for r in again) == sorted((repr(r.doc_id), round(r.score, 9)) for r in got)


def test_scores_equal_a_plain_loop(spark):
    rows, labels = _docs(300, seed=4)
    df = spark.createDataFrame(rows, DOCS)
    model = toxicity.train(df, spark.createDataFrame(labels, "doc_id long, toxic int, text string"))

    def slow(text):
        x = toxicity.features(text, model.lexicon)
        margin = model.base
        for t in model.trees:
            node = 0
            while node < len(t.feature):
                node = 2 * node + (2 if x[t.feature[node]] > t.threshold[node] else 1)
            margin += t.leaf[node - len(t.feature)]
        return float(np.interp(margin, model.centres, model.values))
    want = {r[0]: slow(r[1]) for r in rows}
    for r in toxicity.score(df, model).collect():
        assert abs(r.score - want[r.doc_id]) < 1e-9


def test_sample_bound_and_little_to_learn(spark):
    rows, labels = _docs(60)
    df = spark.createDataFrame(rows + [(1, f"text {i}", "", "", "", "", "") for i in range(50)], DOCS)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    sample = toxicity.labelled(df, lab, 20, "doc_id", "text", "doc_id", "toxic")
    assert sample.count() <= 20 and sample.select("h").distinct().count() == sample.count()
    for some, want in ((lab.limit(0), 0.0), (lab.where("toxic = 0"), 0.0), (lab.where("toxic = 1"), 1.0)):
        model = toxicity.train(df, some)
        assert {r.score for r in toxicity.score(df, model).collect()} == {want}
    model = toxicity.train(df.limit(0), lab)
    assert toxicity.score(df.limit(0), model).count() == 0


def test_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op11_toxicity(spark, sf).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert set(got) == set(docs) and all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [i for i in label if got[i].held_out]
    rank = np.argsort(np.argsort([got[i].score for i in held]))
    toxic = np.array([label[i] == 1 for i in held])
    auc = (rank[toxic].sum() - toxic.sum() * (toxic.sum() - 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert auc >= 0.85
    rude = re.compile(r"\b(idiot|moron|stupid|scum)\b")
    with_insults = [r.predicted for i, r in got.items() if docs[i] and len(rude.findall(docs[i])) > 1]
    assert len(with_insults) > 10 and np.mean(with_insults) > 0.95
