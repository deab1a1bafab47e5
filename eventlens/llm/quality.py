"""Quality rules: base limits and a learned decision list, all as Spark expressions.

``with_stats`` adds the statistics of each text by built-in functions.
``learn`` fits a list of threshold conjunctions by sequential covering:
on two thirds of a bounded labelled sample a rule for low quality grows
condition by condition (largest information gain) until it covers no
good document; on the other third its last conditions are cut as long as
that does not cost precision; rules below the asked precision end the
list.  ``verdict`` turns the list into one ordered ``CASE WHEN``.

Defined results: null or empty text has no words and fails the base
limits; without usable labels the list is empty and the base limits
decide; a null statistic meets no condition.  Conflicting labels of one
doc_id count as low quality.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SAMPLE = 8_000
WINDOW = 8
#: Statistics that conditions may use.
FEATURES = ["word_length", "symbols", "dup_lines", "repeats", "capitals", "shouts", "digits", "stops", "stutters"]
_SPACES = "\\x20\\x09-\\x0D"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column, k: int) -> Column:
    """Words inside windows of ``k`` words that occur twice or more."""
    def of_words(hashes: Column) -> Column:
        windows = F.when(F.size(hashes) > k, F.transform(
            F.sequence(F.lit(1), F.size(hashes) - (k - 1)), lambda i: F.xxhash64(F.slice(hashes, i, k))))
        return _let(windows, of_windows)

    def of_windows(h: Column) -> Column:
        # most texts repeat nothing, which a hash set tells
        return F.when(h.isNull() | (F.size(F.array_distinct(h)) == F.size(h)), F.lit(0).cast("long")).otherwise(
            _let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), of_sorted))

    def of_sorted(s: Column) -> Column:
        twice = F.filter(F.transform(s, lambda x, j: F.when(
            (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]), x["i"])), lambda x: x.isNotNull())
        # each start covers k words, or as many as lie before the next start's
        return F.aggregate(F.sort_array(twice), F.struct(F.lit(-k).alias("last"), F.lit(0).cast("long").alias("n")),
                           lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(k), x - a["last"])).alias("n")),
                           lambda a: a["n"])
    return F.coalesce(_let(F.transform(words, lambda w: F.xxhash64(w)), of_words), F.lit(0).cast("long"))


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns, and ``q``: a struct of the text's statistics."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, f"[{_SPACES}]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{_SPACES}]"))

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("long")
    d = docs.withColumns({"__words": words, "__lines": lines})
    d = d.withColumn("q", F.struct(
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "__words")).cast("long").alias("word_chars"),
        count("[#*$%&|<>]").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("__words"), WINDOW).alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        _let(F.col("__words"), lambda w: F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1)))).cast("long").alias("n_stutters"),
        count("[A-Z]").alias("n_upper"), count("!").alias("n_shouts"), count("[0-9]").alias("n_digits"),
        count("[.,;:?]").alias("n_stops")))
    return d.drop("__words", "__lines")


def features(q: str = "q") -> dict[str, Column]:
    """Ratios of the statistics; null for a text without words."""
    def per(a: str, b: str) -> Column:
        return F.when(F.col(f"{q}.{b}") > 0, F.col(f"{q}.{a}") / F.col(f"{q}.{b}"))
    return {"word_length": per("word_chars", "n_words"), "symbols": per("n_symbols", "word_chars"),
            "dup_lines": per("n_dup_lines", "n_lines"), "repeats": per("n_repeat_words", "n_words"),
            "capitals": per("n_upper", "word_chars"), "shouts": per("n_shouts", "n_words"),
            "digits": per("n_digits", "word_chars"), "stops": per("n_stops", "n_words"), "stutters": per("n_stutters", "n_words")}


def base_failed(q: str = "q") -> Column:
    return (F.col(f"{q}.n_words") < 20) | (100 * F.col(f"{q}.n_repeat_words") > 30 * F.col(f"{q}.n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        v = row[self.feature]
        return v is not None and (v > self.threshold if self.above else v <= self.threshold)

    def column(self, of: dict[str, Column]) -> Column:
        c = of[self.feature]
        return F.coalesce(c > self.threshold if self.above else c <= self.threshold, F.lit(False))


Rule = tuple[Condition, ...]


def _gain(p: int, n: int, all_p: int, all_n: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(all_p / (all_p + all_n))) if p else 0.0


def _best(rows: list[dict]) -> Condition | None:
    """The condition of largest gain over low-quality rows, thresholds half way between values."""
    all_p = sum(r["low"] for r in rows)
    all_n = len(rows) - all_p
    best, found = 1e-9, None
    for f in FEATURES:
        have = sorted((r[f], r["low"]) for r in rows if r[f] is not None)
        total_p = sum(low for _, low in have)
        p = n = 0
        for (v, low), (nxt, _) in zip(have, have[1:]):
            p, n = p + low, n + (not low)
            if nxt <= v:
                continue
            for above, cp, cn in ((False, p, n), (True, total_p - p, len(have) - total_p - n)):
                g = _gain(cp, cn, all_p, all_n)
                if g > best:
                    best, found = g, Condition(f, above, (v + nxt) / 2)
    return found


def _precision(rule: Rule, rows: list[dict]) -> tuple[float, int]:
    hit = [r["low"] for r in rows if all(c.holds(r) for c in rule)]
    return (sum(hit) + 1) / (len(hit) + 2), len(hit)


def cover(grow: list[dict], prune: list[dict], max_rules: int = 16, max_conditions: int = 4,
          min_support: int = 4, min_precision: float = 0.9) -> list[Rule]:
    """Sequential covering: ordered rules for rows with ``low`` true."""
    rules: list[Rule] = []
    while len(rules) < max_rules and sum(r["low"] for r in grow) >= min_support:
        rule: Rule = ()
        rows = grow
        while len(rule) < max_conditions and (not rule or not all(r["low"] for r in rows)):
            c = _best(rows)
            if c is None:
                break
            rule = (*rule, c)
            rows = [r for r in rows if c.holds(r)]
        # cut last conditions while the precision on unseen rows does not suffer
        best = max(((_precision(rule[:k], prune)[0], -k) for k in range(1, len(rule) + 1)), default=(0, 0))
        rule = rule[:-best[1]]
        hit = [r for r in grow if all(c.holds(r) for c in rule)]
        good = sum(not r["low"] for r in hit)
        seen = _precision(rule, prune)
        if (not rule or len(hit) < min_support or good > (1 - min_precision) * len(hit)
                or seen[1] >= min_support and seen[0] < min_precision - 1 / (seen[1] + 2)):
            break
        rules.append(rule)
        grow = [r for r in grow if not all(c.holds(r) for c in rule)]
        prune = [r for r in prune if not all(c.holds(r) for c in rule)]
    return rules


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
          label_id_col: str = "doc_id", label_col: str = "quality", **options) -> list[Rule]:
    """A decision list from at most ``sample`` labelled documents (by hash of the id).

    Documents that the base limits reject teach nothing and are left out."""
    label = (labels.where(F.col(label_col).isNotNull() & F.col(label_id_col).isNotNull())
             .groupBy(F.col(label_id_col).cast("long").alias("lid")).agg((F.min(label_col) <= 0).alias("low"))
             .orderBy(F.xxhash64("lid"), "lid").limit(sample))
    # written first: otherwise the filter, and with it the statistics, moves below the join to all documents
    d = common.materialise(common.id_text(docs, id_col, text_col).join(label, F.col("doc_id") == F.col("lid")), "quality-sample")
    d = with_stats(d).where(~base_failed())
    rows = [r.asDict() for r in d.select("doc_id", "low", *(c.alias(k) for k, c in features().items()),
                                         (F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(3)) == 0).alias("prune"))
            .orderBy("doc_id", *FEATURES).limit(2 * sample).collect()]
    return cover([r for r in rows if not r["prune"]], [r for r in rows if r["prune"]], **options)


def fired(rules: list[Rule], q: str = "q") -> Column:
    """Number of the first rule that a row meets, or null: one ordered CASE WHEN."""
    of = features(q)
    out = None
    for i, rule in enumerate(rules):
        hit = rule[0].column(of)
        for c in rule[1:]:
            hit = hit & c.column(of)
        out = F.when(hit, i) if out is None else out.when(hit, i)
    return F.lit(None).cast("int") if out is None else out


def judge(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """All columns, ``q`` (statistics), ``base_failed``, ``rule`` (that rejects) and ``kept``."""
    d = with_stats(docs, text_col).withColumns({"base_failed": base_failed(), "rule": fired(rules)})
    return d.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are kept."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    d = docs.select(row, F.col(f"`{text_col}`").alias("text"))
    return judge(d, rules).where("kept").select("row.*")
