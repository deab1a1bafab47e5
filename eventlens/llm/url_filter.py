"""URL filter: host rules, then a weighted vocabulary found by Aho-Corasick.

Every url is split into host and path.  The longest rule that fits its
host (or a parent domain) and path decides.  Without one, the url, A-Z
lower-cased, runs through an automaton of the vocabulary's terms; an
occurrence counts if no ASCII letter or digit touches it.  A term has a
weight, and each distinct term counts once: the url is rejected when the
weights reach the threshold.  A term that reaches it alone is strict, the
others are soft.  The built-in terms weigh the whole threshold or half of
it, so one strict or two soft ones reject; a table may name others, with
any positive weights.

A vocabulary of more than ``VOCABULARY_BYTES`` is cut into parts of about
that size, each with an automaton of its own, and the urls pass the parts
one after the other in one job: distinct terms lie in one part each, so
the sums add.

Defined results: a null url, or one without ``://``, has an empty host
and path, meets no rule and is judged by its text (null: no term, so
allowed).  Terms that are null or empty, or whose weight is null or not
positive, are left out; a term that occurs twice has its larger weight.
"""

from __future__ import annotations

import math

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: (verdict, host and path prefix); the contract's rules.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
STRICT = ["casino", "escort", "hentai", "keygen", "malware", "phishing", "porn", "torrent", "viagra", "warez", "xxx"]
SOFT = ["adult", "bet", "bonus", "cam", "cheap", "click", "coupon", "crack", "dating", "download", "free", "hot",
        "jackpot", "loan", "nude", "pills", "poker", "sex", "spam", "win"]
THRESHOLD = 2
#: Bytes of terms in one automaton.
VOCABULARY_BYTES = 16_000_000
_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_ALNUM = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path); both empty for null or without ``://``."""
    head, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    for stop in "?#":
        rest = rest.partition(stop)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_UPPER), slash + path


class Rules:
    """Longest fitting rule by walking the host's parent domains."""

    def __init__(self, rules: list[tuple[str, str]]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, rule, verdict))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        best = None
        at = 0
        while at >= 0 and host:
            for prefix, rule, verdict in self.by_host.get(host[at:], ()):
                if path.startswith(prefix) and (best is None or len(rule) > len(best[0])):
                    best = rule, verdict
            dot = host.find(".", at)
            at = dot + 1 if dot >= 0 else -1
        return best


def vocabulary(terms: dict[str, float]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for t, weight in terms.items():
        automaton.add_word(t, (t, weight))
    automaton.make_automaton()
    return automaton


def term_hits(automaton: ahocorasick.Automaton, url: str | None) -> dict[str, float]:
    """Distinct terms of the url that stand free, with their weights."""
    low = (url or "").translate(_UPPER)
    found = {}
    for end, (term, weight) in automaton.iter(low) if len(automaton) else ():
        start = end - len(term) + 1
        if (start == 0 or low[start - 1] not in _ALNUM) and (end + 1 == len(low) or low[end + 1] not in _ALNUM):
            found[term] = weight
    return found


def built_in(strict: list[str], soft: list[str]) -> dict[str, float]:
    return {t: THRESHOLD / 2 for t in soft} | {t: float(THRESHOLD) for t in strict}


def parts(terms: DataFrame, part_bytes: int, term_col: str = "term", weight_col: str = "weight") -> list[dict[str, float]]:
    """The vocabulary of a table, in parts of about ``part_bytes``."""
    low = F.translate(F.col(term_col).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    usable = terms.select(low.alias("term"), F.col(weight_col).cast("double").alias("weight")).where("term <> '' and weight > 0")
    usable = common.materialise(usable.groupBy("term").agg(F.max("weight").alias("weight")), "vocabulary")
    size = usable.select(F.sum(F.octet_length("term"))).first()[0] or 0
    n = max(1, math.ceil(size / part_bytes))
    part = F.pmod(F.xxhash64("term"), F.lit(n))
    return [{r.term: r.weight for r in usable.where(part == k).collect()} for k in range(n)]


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES, strict: list[str] = STRICT, soft: list[str] = SOFT,
          id_col: str = "page_id", url_col: str = "url", terms: DataFrame | None = None, part_bytes: int = VOCABULARY_BYTES) -> DataFrame:
    """(page_id, host, path, rule, n_strict, n_soft, weight, verdict), one row per input row.

    ``terms`` (columns ``term`` and ``weight``) takes the place of the built-in words."""
    sc = pages.sparkSession.sparkContext
    shared = [sc.broadcast(v) for v in (parts(terms, part_bytes) if terms is not None else [built_in(strict, soft)])]
    state = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         F.lit(0).cast("long").alias("n_strict"), F.lit(0).cast("long").alias("n_soft"), F.lit(0.0).alias("weight"))
    for part in shared:
        def add(batches, part=part):
            automaton = vocabulary(part.value)
            for b in batches:
                found = [list(term_hits(automaton, url).values()) for url in b.column("url").to_pylist()]
                sums = [(sum(x >= THRESHOLD for x in w), sum(x < THRESHOLD for x in w), float(sum(w))) for w in found]
                cols = list(zip(*sums)) or [()] * 3
                more = [pc.add(b.column(n), pa.array(c, b.column(n).type)) for n, c in zip(("n_strict", "n_soft", "weight"), cols)]
                yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), *more], ["page_id", "url", "n_strict", "n_soft", "weight"])
        state = state.mapInArrow(add, "page_id long, url string, n_strict long, n_soft long, weight double")

    def decide(batches):
        fits = Rules(rules)
        for b in batches:
            rows = []
            for url, weight in zip(b.column("url").to_pylist(), b.column("weight").to_pylist()):
                host, path = split_url(url)
                rule = fits.find(host, path)
                rows.append((host, path, rule and rule[0], rule[1] if rule else "block" if weight >= THRESHOLD - 1e-9 else "allow"))
            host, path, rule, verdict = (pa.array(c, pa.string()) for c in list(zip(*rows)) or [()] * 4)
            yield pa.RecordBatch.from_arrays([b.column("page_id"), host, path, rule, *(b.column(n) for n in ("n_strict", "n_soft", "weight")), verdict],
                                             ["page_id", "host", "path", "rule", "n_strict", "n_soft", "weight", "verdict"])
    return state.mapInArrow(decide, "page_id long, host string, path string, rule string, n_strict long, n_soft long, weight double, verdict string")
