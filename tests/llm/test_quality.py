import random
import re
from collections import Counter

from pyspark.sql import functions as F

from eventlens.llm import quality
from eventlens.llm.quality import Condition

SCHEMA = "doc_id long, text string, q string, kept string, rule string"


def slow_stats(t):
    t = t or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    n = Counter(wins)
    hit = {i + k for i, w in enumerate(wins) if n[w] > 1 for k in range(8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit),
            sum(a == b for a, b in zip(words, words[1:])))


def _texts():
    rng = random.Random(8)
    vocab = ["é", "b#", "$c", "D", "e\U0001F600", "f<>", "g|"]
    out = [rng.choice([" ", "\n", "\t"]).join(rng.choice(vocab[:rng.randint(1, 7)]) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    line = "one two three four"
    out += ["\n".join([line, " ", "", line, line + " ", line]), None, "", " \n ", "a b c d e f g h", "a b c d e f g h i", "x " * 30_000,
            "a b c d e f g h a b c d e f g h", "no\x0bbreak\x0cs\rhere\xa0x"]
    return out


def test_statistics_equal_brute_force(spark):
    texts = _texts()
    df = spark.createDataFrame([(i, t, "q", "k", "r") for i, t in enumerate(texts)], SCHEMA).drop("q")
    got = {r.doc_id: tuple(r.q[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stutters"))
           for r in quality.with_stats(df).collect()}
    assert got == {i: slow_stats(t) for i, t in enumerate(texts)}


def test_no_python_on_the_main_path(spark):
    df = spark.createDataFrame([(1, "a", "q", "k", "r")], SCHEMA).drop("q", "kept", "rule")
    plan = quality.judge(df, [(Condition("symbols", True, 0.1),)])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_covering_finds_the_rules():
    rng = random.Random(1)
    rows = []
    for _ in range(3000):
        r = {f: rng.random() for f in quality.FEATURES} | {"low": False}
        r["low"] = r["symbols"] > 0.9 or r["capitals"] > 0.7 and r["stops"] <= 0.3
        if rng.random() < 0.02:
            r["digits"] = None
        rows.append(r)
    rules = quality.cover(rows[:2000], rows[2000:])
    assert len(rules) >= 2
    wrong = sum(any(all(c.holds(r) for c in rule) for rule in rules) != r["low"] for r in rows)
    assert wrong < 15
    assert quality.cover([r | {"low": False} for r in rows], []) == []
    noise = [r | {"low": rng.random() < 0.1} for r in rows]
    rules = quality.cover(noise[:2000], noise[2000:])
    assert sum(any(all(c.holds(r) for c in rule) for rule in rules) for r in noise) < 60


def test_decision_list_is_ordered_and_learned_end_to_end(spark):
    rng = random.Random(2)
    clean = lambda: " ".join(f"{rng.choice('abcdefgh')}{rng.randint(0, 999)}" for _ in range(60))
    docs = [(i, clean() if i % 4 else clean().replace("a", "*$#"), "q", "k", "r") for i in range(400)]
    docs += [(1000, None, None, None, None), (None, clean(), None, None, None), (1001, "too short", "", "", ""), (3, docs[3][1], "", "", "")]
    df = spark.createDataFrame(docs, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 300)] + [(None, 0, 0), (5000, 0, 0), (301, None, 0)],
                                   "doc_id long, quality int, toxic int")
    rules = quality.learn(df, labels, min_precision=0.9)
    assert rules and rules == quality.learn(df.repartition(3), labels)
    got = quality.judge(df.drop("q", "kept", "rule"), rules)
    for r in got.collect():
        if r.doc_id is not None and r.doc_id < 1000:
            assert r.kept == (r.doc_id % 4 > 0) and r.base_failed is False
        else:
            assert r.base_failed == (r.doc_id is not None) and r.kept == (r.doc_id is None)
    first = quality.judge(df.limit(5).drop("q", "kept", "rule"), [(Condition("word_length", True, 0.0),), (Condition("word_length", True, 0.0),)])
    assert {r.rule for r in first.collect()} == {0}


def test_without_labels_or_rows(spark):
    df = spark.createDataFrame([(1, "w " * 30 + "x y", "q", "k", "r")], SCHEMA).drop("q", "kept", "rule")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.learn(df, none) == []
    assert [(r.base_failed, r.kept) for r in quality.judge(df, []).collect()] == [(True, False)]
    assert quality.judge(df.limit(0), []).select(F.col("kept")).count() == 0
