"""The registered queries of the training-data operators, with their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, common, decontaminate, langid, packing, periodic, pii, quality, simhash, substrings, token_counts, token_files, toxicity, url_filter


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicate groups of all documents: 4-word shingles, 4 bits."""
    return simhash.near_duplicates(common.table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids, each ending with id 0."""
    return packing.pack(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end=0, size=2048)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Huffman-coded token files of all documents, each ending with id 2, read back."""
    path = common.new_path(spark, "token-files")
    token_files.write(common.table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end=2)
    return token_files.read(spark, path, digest=True)


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left after removing every repeated 20-word window but the first."""
    return substrings.remove_repeats(common.table(spark, sf_dir, "documents"), window=20, digest=True)


OP4_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (
  SELECT doc_id, i AS start, list_aggregate(words[i:i + 19], 'string_agg', ' ') AS phrase
  FROM w, unnest(range(1, greatest(len(words) - 18, 1))) AS r(i)),
rep AS (
  SELECT doc_id, start FROM (
    SELECT doc_id, start, row_number() OVER (PARTITION BY phrase ORDER BY doc_id, start) AS k FROM win) WHERE k > 1),
gone AS (
  SELECT DISTINCT doc_id, start + j AS pos FROM rep, unnest(range(0, 20)) AS r(j)),
every_word AS (
  SELECT doc_id, i AS pos, words[i] AS word FROM w, unnest(range(1, len(words) + 1)) AS r(i)),
kept AS (
  SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.pos) AS body, count(*) AS n
  FROM every_word e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.pos = g.pos GROUP BY e.doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.body, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url by host rules and the weighted vocabulary."""
    return url_filter.judge(common.table(spark, sf_dir, "pages")).drop("weight")


def _terms(terms: list[str], weight: int) -> str:
    return ", ".join(f"('{t}', {weight})" for t in terms)


OP5_SQL = r"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS p FROM pages),
cut AS (
  SELECT page_id, url, CASE WHEN p > 0 THEN regexp_extract(substr(url, p + 3), '^[^?#]*') ELSE '' END AS rest FROM u),
parts AS (
  SELECT page_id, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_replace(rest, '^[^/]*', '') AS path FROM cut),
rules(verdict, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fit AS (
  SELECT p.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM parts p JOIN rules r ON (p.host = r.host OR suffix(p.host, '.' || r.host)) AND prefix(p.path, r.path) GROUP BY p.page_id),
terms(term, weight) AS (VALUES @TERMS@),
hits AS (
  SELECT page_id, count(*) FILTER (weight = 2) AS n_strict, count(*) FILTER (weight = 1) AS n_soft
  FROM parts JOIN terms ON regexp_matches(low, '(^|[^a-z0-9])' || term || '([^a-z0-9]|$)') GROUP BY page_id)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(n_strict, 0)::BIGINT AS n_strict, coalesce(n_soft, 0)::BIGINT AS n_soft,
  coalesce(f.verdict, CASE WHEN 2 * coalesce(n_strict, 0) + coalesce(n_soft, 0) >= 2 THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN fit f ON p.page_id = f.page_id LEFT JOIN hits h ON p.page_id = h.page_id
""".replace("@TERMS@", f"{_terms(url_filter.STRICT, 2)}, {_terms(url_filter.SOFT, 1)}")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from those whose crc32(doc_id) mod 5 is not 0."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = langid.train(docs.where(~held_out))
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base limits and a decision list learned from ``labels``, over all documents."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality.learn(docs, common.table(spark, sf_dir, "labels"))
    return quality.judge(docs, rules).select(
        "doc_id", "q.n_words", "q.word_chars", "q.n_symbols", "q.n_dup_lines", "q.n_repeat_words", "base_failed", "kept", "rule")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents inside 10-word windows of benchmark items."""
    found = decontaminate.contamination(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS n, array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS phrase
  FROM b, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS r(i) WHERE len(words) > 0),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, i AS start, array_to_string(words[i:i + n - 1], ' ') AS phrase
  FROM d, sizes, unnest(range(1, greatest(len(words) - n + 2, 1))) AS r(i)),
hits AS (
  SELECT DISTINCT doc_id, item_id, w.n, start FROM doc_windows w JOIN item_windows i ON w.phrase = i.phrase AND w.n = i.n),
places AS (
  SELECT doc_id, count(DISTINCT start + j) AS n_hit FROM hits, unnest(range(0, n)) AS r(j) GROUP BY doc_id),
names AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places p ON d.doc_id = p.doc_id LEFT JOIN names m ON d.doc_id = m.doc_id
"""


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of all documents; over the limit beyond 1024 tokens."""
    return token_counts.token_counts(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents; the four counts are those of the base patterns."""
    docs = common.table(spark, sf_dir, "documents")
    found = pii.detect(docs, pii.train(docs))

    def count(kind: str):
        return F.regexp_count("base", F.lit(f"{kind}:")).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(count(k) for k in pii.KINDS), F.sha2("base", 256).alias("base_sha256"), "spans")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learned from labels whose crc32(doc_id) mod 5 is not 0."""
    docs, labels = common.table(spark, sf_dir, "documents").select("doc_id", "text"), common.table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = toxicity.train(docs, labels.where(~held_out))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of the byte-level and the piece tokenizer over all documents."""
    found = alignment.align(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def _planted(docs: DataFrame) -> DataFrame:
    """``documents`` with the repetitions that op13's contract plants, by crc32 of the id."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split(F.col("text"), "[\\x20\\x09-\\x0D]+"), "")

    def repeated(w):
        n = F.greatest(F.size(w), F.lit(1))  # no word: nothing to repeat
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(w, lambda x, i: F.when(i >= a, F.get(w, (a + (i - a) % p).cast("int"))).otherwise(x)), " ")
    text = F.when(F.coalesce(h % 10 == 0, F.lit(False)) & F.col("text").isNotNull(), quality._let(words, repeated)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of four periods or more in all documents, repetitions planted by the contract included."""
    found = periodic.runs(_planted(common.table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    top = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"), top["length"].alias("length"), top["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_packing": op2_packing,
    "op3_token_files": op3_token_files,
    "op4_substrings": op4_substrings,
    "op5_url_filter": op5_url_filter,
    "op6_language": op6_language,
    "op7_quality": op7_quality,
    "op8_decontamination": op8_decontamination,
    "op9_token_counts": op9_token_counts,
    "op10_pii": op10_pii,
    "op11_toxicity": op11_toxicity,
    "op12_alignment": op12_alignment,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op4_substrings": OP4_SQL,
    "op5_url_filter": OP5_SQL,
    "op8_decontamination": OP8_SQL,
}
