"""SimHash near-duplicate groups by tiled exact comparison.

Fingerprints are taken per document inside Arrow batches.  Equal
fingerprints become one node, so a group of copies of any size is one
row before anything is compared.  Nodes are dealt into ``g`` even groups
by hash; each unordered pair of groups is one task, which walks the tile
pairs with numpy exclusive-or and bit counts, skips a tile pair whose
population counts (of the four 16-bit quarters) differ by more than the
radius in all, and returns a spanning forest of its links: at most one
edge per node, whatever the number of links.  Forests of all tasks keep
every link's connectivity; the components then come from alternating
star contraction on DataFrames.

Defined results: null or empty text has no shingle and fingerprint zero,
linked like any other; equal rows give equal results; a null id stays as
it is and never names a component that holds another id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SEED = 42
TILE_ROWS, TILE_COLS = 128, 512
GROUP_ROWS = 250_000


def fingerprint(text: str | None, n: int = 4) -> int:
    """Majority bits of the XXH64 (seed 42) of all ``n``-word shingles."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < n:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(n))))
    digest = xxhash.xxh64_digest
    raw = np.frombuffer(b"".join([digest(s, SEED) for s in shingles]), np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(raw), 1 << 16):
        ones += np.unpackbits(raw[lo:lo + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(raw)).tobytes(), "big")


def fingerprints(docs: DataFrame, n: int = 4, hashes: bool = False) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long, one row per input row;
    with ``hashes`` also the two of ``text_hashes``."""
    names = ["h1", "h2"] if hashes else []

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t.as_py(), n) for t in b.column("text")], np.uint64)
        return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps.view(np.int64)), *(b.column(x) for x in names)],
                                          ["doc_id", "fp", *names])
    d = common.id_text(docs)
    if hashes:
        d = d.withColumns(text_hashes())
    return d.mapInArrow(common.per_batch(batch), "doc_id long, fp long" + "".join(f", {x} long" for x in names))


def text_hashes() -> dict:
    """128 bits that tell one text from another, null apart from empty."""
    t = F.col("text").cast("string")
    return {"h1": F.xxhash64(t), "h2": F.xxhash64(F.lit(SEED), t)}


def _quarters(fp: np.ndarray) -> np.ndarray:
    return np.stack([np.bitwise_count((fp >> np.uint64(s)) & np.uint64(0xFFFF)) for s in (0, 16, 32, 48)], 1).astype(np.int16)


def _tiles(q: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest quarter counts of each tile."""
    at = np.arange(0, len(q), size)
    return np.minimum.reduceat(q, at, axis=0), np.maximum.reduceat(q, at, axis=0)


class _Forest:
    """Union of links given as index arrays; keeps the edges that joined two trees."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.edges: list[tuple[int, int]] = []

    def add(self, u: np.ndarray, v: np.ndarray) -> None:
        ru, rv = self.root[u], self.root[v]
        apart = ru != rv
        if not apart.any():
            return
        pairs = np.unique(np.stack([np.minimum(ru[apart], rv[apart]), np.maximum(ru[apart], rv[apart])], 1), axis=0)
        up: dict[int, int] = {}

        def find(x: int) -> int:
            while x in up:
                x = up[x]
            return x
        for a, b in pairs.tolist():
            a, b = find(a), find(b)
            if a != b:
                a, b = min(a, b), max(a, b)
                up[b] = a
                self.edges.append((b, a))
        moved = np.fromiter(up, np.int64, len(up))
        to = np.arange(len(self.root))
        to[moved] = [find(x) for x in up]
        self.root = to[self.root]


def link_forest(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links within ``a`` (``b`` None) or between ``a`` and ``b``.

    Exact: every pair is compared unless the quarter counts of its tiles
    already differ by more than ``radius``."""
    own = b is None
    a = a[np.lexsort(_quarters(a).T[::-1])] if len(a) else a
    b = a if own else (b[np.lexsort(_quarters(b).T[::-1])] if len(b) else b)
    if not len(a) or not len(b):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    lo_a, hi_a = _tiles(_quarters(a), TILE_ROWS)
    lo_b, hi_b = _tiles(_quarters(b), TILE_COLS)
    shift = 0 if own else len(a)
    forest = _Forest(len(a) if own else len(a) + len(b))
    x, c = np.empty(TILE_ROWS * TILE_COLS, np.uint64), np.empty(TILE_ROWS * TILE_COLS, np.uint8)
    for i in range(len(lo_a)):
        gap = np.maximum(0, np.maximum(lo_a[i] - hi_b, lo_b - hi_a[i])).sum(axis=1)
        left = a[i * TILE_ROWS:(i + 1) * TILE_ROWS]
        for j in np.flatnonzero(gap <= radius):
            if own and (j + 1) * TILE_COLS <= i * TILE_ROWS:
                continue  # the mirrored tile pair has been compared
            right = b[j * TILE_COLS:(j + 1) * TILE_COLS]
            n = len(left) * len(right)
            np.bitwise_xor(left[:, None], right[None, :], out=x[:n].reshape(len(left), -1))
            near = np.flatnonzero(np.bitwise_count(x[:n], out=c[:n]) <= radius)
            if not len(near):
                continue
            u, v = np.divmod(near, len(right))
            u, v = u + i * TILE_ROWS, v + j * TILE_COLS
            if own:
                u, v = u[u < v], v[u < v]
            if len(u):
                forest.add(u, v + shift)
    nodes = a if own else np.concatenate([a, b])
    e = np.array(forest.edges, np.int64).reshape(-1, 2)
    return nodes[e[:, 0]], nodes[e[:, 1]]


def links(nodes: DataFrame, radius: int, groups: int) -> DataFrame:
    """(u, v): forests of the links among distinct fingerprints ``fp``.

    Every node goes to the ``groups`` group pairs it takes part in; a
    task holds two groups of about nodes / groups rows."""
    g = F.pmod(F.xxhash64("fp"), F.lit(groups)).cast("int")
    dealt = (nodes.select("fp", g.alias("g"))
             .select("fp", "g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("h"))
             .select("fp", "g", F.least("g", "h").alias("i"), F.greatest("g", "h").alias("j")))

    def block(t: pa.Table) -> pa.Table:
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        fp = t.column("fp").to_numpy().view(np.uint64)
        g = t.column("g").to_numpy()
        u, v = link_forest(fp[g == i], None if i == j else fp[g == j], radius)
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})
    # the rows are few bytes for much work: a task per group pair, whatever their size
    tasks = groups * (groups + 1) // 2
    return dealt.repartition(tasks, "i", "j").groupBy("i", "j").applyInArrow(block, "u long, v long")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): root is the smallest node reachable, for nodes with an edge.

    Alternating large-star and small-star contraction; each round is a
    grouped minimum (combined on the map side) and one join, written to
    the shared folder.  Ends when a round changes nothing."""
    spark = edges.sparkSession

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else \
            e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        j = both.join(low, "u")
        if large:
            out = j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = j.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
                low.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 998_244_353)).first()

    path = common.new_path(spark, name)
    e = common._write(edges.where("u <> v").distinct(), path)
    seen = state(e)
    while seen[0]:
        old, path = path, common.new_path(spark, name)
        e = common._write(star(star(e, True), False), path)
        common.drop_path(spark, old)
        now = state(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _members(classes: DataFrame, radius: int, group_rows: int) -> DataFrame:
    """(node, root) of every fingerprint that has a link, the root itself included."""
    slots = classes.sparkSession.sparkContext.defaultParallelism
    groups = max(math.ceil(classes.count() / group_rows), math.ceil(math.sqrt(16 * slots)))
    star = components(links(classes, radius, groups), "simhash-links")
    return star.select("node", "root").union(star.select(F.col("root").alias("node"), "root").distinct())


def representatives(docs: DataFrame, shingle: int = 4, radius: int = 4, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, h1, h2): the row that stands for each component, as its id and ``text_hashes``.

    The smallest doc_id does, a null id last; of rows that share it, the
    first by text hash.  One row per component, whatever the ids are."""
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h1", "h2")
    classes = common.materialise(
        fingerprints(docs, shingle, hashes=True).groupBy("fp").agg(F.min(first).alias("first")), "simhash-classes")
    member = _members(classes, radius, group_rows)
    # a component is named by its root fingerprint, which null or shared ids leave apart
    return (classes.join(member, classes.fp == member.node, "left")
            .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
            .select("first.doc_id", "first.h1", "first.h2"))


def _ordered(docs: DataFrame, column: str) -> Column:
    """A column by name, or its JSON text where its type has a map, which has no hash."""
    c = F.col(f"`{column}`")
    return F.to_json(F.struct(c)) if "map<" in docs.schema[column].dataType.simpleString() else c


def keep_first(docs: DataFrame, shingle: int = 4, radius: int = 4, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row of each component, all columns: that of the smallest doc_id, a null id last.

    Of rows that share that id the first by text hash stays, and of those that
    share the text, too, the first by the hash of the whole row.  Rows of
    other components stay, whatever their ids.  Columns may have any name
    and type: a row travels as one struct."""
    key = {"id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "none": F.col("doc_id").isNull()}
    chosen = representatives(docs, shingle, radius, group_rows).select(*(c.alias(k) for k, c in key.items()), "h1", "h2")
    key |= text_hashes()
    rows = docs.select(*(c.alias(k) for k, c in key.items()), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       F.xxhash64(*(_ordered(docs, c) for c in docs.columns)).alias("rank"))
    # copies meet in their tasks first; the join then finds the rows where the grouping has put them
    rows = rows.groupBy(*key).agg(F.min_by("row", "rank").alias("row"))
    return rows.join(chosen, list(key), "left_semi").select("row.*")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row.

    ``component_id`` is the smallest doc_id of all documents reachable
    over links of ``radius`` or fewer differing bits."""
    fps = common.materialise(fingerprints(docs, shingle), "simhash")
    classes = common.materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-classes")
    # the component's smallest id: over its linked members and the root itself
    member = _members(classes, radius, group_rows)
    linked = classes.join(member, classes.fp == member.node).select("fp", "root", "low")
    low = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    named = linked.join(low, "root").select(F.col("fp").alias("lfp"), "component_id")
    all_classes = common.materialise(
        classes.join(named, classes.fp == named.lfp, "left")
        .select(F.col("fp").alias("cfp"), F.coalesce("component_id", "low").alias("component_id")), "simhash-components")
    # a hot fingerprint is a skewed join key, which AQE splits: both sides are plain shuffles here
    return (fps.join(all_classes, fps.fp == all_classes.cfp)
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
