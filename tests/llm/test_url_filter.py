import random
import re

from eventlens.llm import url_filter

SCHEMA = "page_id long, url string, host string, path string, verdict string"


def brute(url):
    m = re.search("://", url or "")
    host = path = ""
    if m:
        host, path = re.fullmatch(r"([^/?#]*)([^?#]*).*", url[m.end():], re.S).groups()
        host = re.sub("[A-Z]", lambda c: c[0].lower(), host)
    low = re.sub("[A-Z]", lambda c: c[0].lower(), url or "")
    fits = []
    for verdict, rule in url_filter.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, verdict))
    n = [sum(bool(re.search(f"(?<![a-z0-9]){t}(?![a-z0-9])", low)) for t in terms) for terms in (url_filter.STRICT, url_filter.SOFT)]
    _, rule, verdict = max(fits, default=(0, None, "block" if n[0] or n[1] > 1 else "allow"))
    return host, path, rule, *n, verdict


def test_matches_brute_force(spark):
    rng = random.Random(4)
    hosts = ["net", "a.net", "x.example.net", "EXAMPLE.net", "notexample.net", "example.com", "m.example.com", "b.org", "org", "c.orgs", "d.net:80", "", "fünf.de"]
    parts = ["/", "/en/", "/de/x", "/fr/", "/en", "", "?q=/en/", "#/de/", "/free-poker", "/casino/", "/CASINOS", "/freepoker", "/bet_free",
             "/sex.sex", "/win%20free", "/xxx"]
    urls = [rng.choice(["http://", "https://", "HTTP://", "ftp:", "a://b://"]) + rng.choice(hosts) + rng.choice(parts) + rng.choice(parts) for _ in range(1500)]
    urls += [None, "", "://", "no scheme casino", "http://", "x" * 200_000 + " porn"]
    df = spark.createDataFrame([(i, u, "h", "p", "v") for i, u in enumerate(urls)], SCHEMA)
    got = {r.page_id: (r.host, r.path, r.rule, r.n_strict, r.n_soft, r.verdict) for r in url_filter.judge(df).collect()}
    assert got == {i: brute(u) for i, u in enumerate(urls)}


def test_null_id_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(None, "http://a.net/", None, None, None)] * 2, SCHEMA)
    assert [r.verdict for r in url_filter.judge(df).collect()] == ["block", "block"]
    assert url_filter.judge(df.limit(0)).count() == 0
    assert url_filter.judge(df, rules=[], strict=[], soft=[]).first().verdict == "allow"


def test_weighted_terms_of_a_table(spark):
    rng = random.Random(8)
    letters = "abcdefghij"
    terms = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 6))): rng.choice([0.25, 0.5, 1.0, 1.5, 2.0, 5.0]) for _ in range(5000)}
    table = [(t.upper() if rng.random() < 0.2 else t, w) for t, w in terms.items()]
    some = list(terms.items())[:40]
    table += [(None, 2.0), ("", 2.0), ("zzz", None), ("yyy", -1.0), *((t, w / 2) for t, w in some)]
    words = list(terms) + ["zzz", "yyy", "none"]
    urls = ["http://a.de/" + rng.choice("-/._").join(rng.choice(words) for _ in range(rng.randint(0, 5))) + rng.choice(["", "q", "1"]) for _ in range(400)]
    df = spark.createDataFrame([(i, u, "h", "p", "v") for i, u in enumerate(urls)], SCHEMA)
    vocabulary = spark.createDataFrame(table, "term string, weight double")

    def slow(url):
        found = {w for w in re.split("[^a-z0-9]+", url.lower()) if w in terms}
        weights = [terms[t] for t in found]
        return sum(w >= 2 for w in weights), sum(w < 2 for w in weights), sum(weights), "block" if sum(weights) >= 2 else "allow"
    for size in (1 << 20, 3000):  # one automaton, and several
        got = {r.page_id: (r.n_strict, r.n_soft, r.weight, r.verdict) for r in url_filter.judge(df, terms=vocabulary, part_bytes=size).collect()}
        assert got == {i: slow(u) for i, u in enumerate(urls)}
    assert len(url_filter.parts(vocabulary, 3000)) > 3
    assert {r.verdict for r in url_filter.judge(df, terms=vocabulary.limit(0)).collect()} == {"allow"}
