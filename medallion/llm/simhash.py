"""SimHash near-duplicates: fingerprints, BK-tree search, components.

Fingerprints that differ in at most ``radius`` = 4 of 64 bits agree on at
least two of six blocks of bits, so the pairs meet in one of the 15 tables
keyed by two blocks.  A bucket of a table is one shard, a large bucket is
several; a shard's BK-tree is searched by the shard's own and by the later
shards' fingerprints of the bucket, in a task for each pair of shards.  A
task returns links that span what it found connected, not all pairs.
Components of the links come from alternating large and small stars.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import documents, map_batches, release, written

BITS = 64
SHARD = 1024  # fingerprints in a BK-tree
_AT_ONCE = 1 << 14  # shingles whose bits are unpacked together


def fingerprint(text: bytes, words: int = 4, seed: int = 42) -> int:
    """Unsigned; zero without words.  A-Z only is lower-cased and the words
    are what ASCII white space leaves: both are what bytes do by themselves."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    size = np.fromiter(map(len, tokens), np.int64, len(tokens))
    end = np.cumsum(size + 1) - 1
    begin, end = (end - size)[: 1 - words].tolist(), end[words - 1 :].tolist()
    digest, n, ones = xxhash.xxh64_intdigest, len(begin), np.zeros(BITS, np.int64)
    for lo in range(0, n, _AT_ONCE):
        h = np.array([digest(joined[a:b], seed) for a, b in zip(begin[lo : lo + _AT_ONCE], end[lo : lo + _AT_ONCE], strict=True)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42, row: str | None = None) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long), and the column ``row``, a
    long, if it is named."""
    more = [row] if row else []

    def fn(batch: pa.RecordBatch) -> dict:
        got = np.array([fingerprint(t, words, seed) for t in batch.column(1).to_pylist()], np.uint64)
        return {"doc_id": batch.column(0), "fp": got.view(np.int64)} | {c: batch.column(c) for c in more}

    return map_batches(documents(docs, more=more), fn, "doc_id long, fp long" + "".join(f", {c} long" for c in more))


class BKTree:
    """Children are keyed by their Hamming distance to the parent."""

    def __init__(self, root: int):
        self.root = (root, {})

    def add(self, fp: int) -> None:
        node = self.root
        while (d := (fp ^ node[0]).bit_count()) in node[1]:
            node = node[1][d]
        node[1][d] = (fp, {})

    def search(self, fp: int, radius: int) -> Iterator[int]:
        """Only edges within the radius of the distance to the parent can
        lead to what is within the radius (triangle inequality)."""
        stack = [self.root]
        while stack:
            other, children = stack.pop()
            d = (fp ^ other).bit_count()
            if d <= radius:
                yield other
            stack += [child for k, child in children.items() if d - radius <= k <= d + radius]


def spanning_links(tree_of: list[int], queries: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join whatever the search of ``queries`` in the BK-tree of
    ``tree_of`` links.  The two lists may be the same."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = parent[x]
        return x

    out, tree = [], BKTree(tree_of[0])
    for fp in tree_of[1:]:
        tree.add(fp)
    for q in queries:
        for other in tree.search(q, radius):
            a, b = find(q), find(other)
            if a != b:
                parent[a] = b
                out.append((q, other))
    return out


def _table_masks(radius: int) -> list[int]:
    """Masks of the tables: all but ``radius`` of ``radius + 2`` blocks."""
    blocks = radius + 2
    cuts = [BITS * k // blocks for k in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [masks[i] | masks[j] for i, j in combinations(range(blocks), 2)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def links(fps: DataFrame, radius: int) -> DataFrame:
    """(a, b): links between different fingerprints of the column ``fp``."""
    keys = F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for k, m in enumerate(_table_masks(radius))])
    keyed = fps.select("fp", F.explode(keys).alias("e")).select("fp", "e.t", "e.key")
    shared = keyed.groupBy("t", "key").count().where("count > 1").withColumn("shards", F.ceil(F.col("count") / SHARD))
    member = keyed.join(shared, ["t", "key"]).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("shards")))
    # shard ``own`` meets each shard: the lower one of the two is the tree
    tiles = member.select("t", "key", "fp", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("other"))
    tiles = tiles.groupBy("t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).agg(
        F.collect_list(F.when(F.col("own") <= F.col("other"), F.col("fp"))).alias("tree"),
        F.collect_list(F.when(F.col("own") >= F.col("other"), F.col("fp"))).alias("queries"),
    )

    def fn(batch: pa.RecordBatch) -> dict:
        found = set()
        for tree, queries in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if tree and queries:
                mask = (1 << BITS) - 1
                found.update(spanning_links([x & mask for x in tree], [x & mask for x in queries], radius))
        ab = np.array(sorted(found), np.uint64).reshape(-1, 2).view(np.int64)
        return {"a": ab.min(1), "b": ab.max(1)}

    return map_batches(tiles.select("tree", "queries"), fn, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b): the root is the least
    node of the component.  Each round is written to the shared folder."""
    spark = edges.sparkSession

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def nearest(df: DataFrame) -> DataFrame:
        return df.join(df.groupBy("a").agg(F.min("b").alias("m")), "a")

    stars = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "links")
    before = None
    while (now := mark(stars)) != before:
        before = now
        # large stars: a node's larger neighbours move to its least neighbour
        both = stars.union(stars.select("b", "a"))
        large = nearest(both).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        # small stars: a node and its smaller neighbours move to the least
        pairs = nearest(large)
        small = pairs.select(F.col("b").alias("a"), F.col("m").alias("b")).union(pairs.select("a", F.col("m").alias("b")))
        stars = written(small.where("a != b").distinct(), "stars")
        release(spark)
    roots = stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the least doc_id
    that links reach) of every row.

    Copies share a fingerprint and are searched once.  Null and empty texts
    have fingerprint zero and link like any other.  Rows that repeat a
    doc_id are rows of their own; a null doc_id never is a component_id,
    unless a component has no other.  Empty table: no rows.
    """
    fps = written(fingerprints(docs, words, seed), "fingerprints")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct.select("fp"), radius)).withColumnRenamed("node", "fp")
    linked = written(roots.join(distinct, "fp"), "linked")
    least = linked.groupBy("root").agg(F.min("least").alias("of_root"))
    linked = linked.join(least, "root").select("fp", "of_root")
    by_fp = distinct.join(linked, "fp", "left").select("fp", F.coalesce("of_root", "least").alias("component_id"))
    return fps.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def copies(docs: DataFrame, row: str, words: int = 4, radius: int = 4, seed: int = 42) -> DataFrame:
    """The column ``row``, a unique key, of all rows but one of each component:
    the least doc_id's stays, a null doc_id last, the least key's among equal
    ones."""
    fps = written(fingerprints(docs, words, seed, row), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", row)).alias("least")
    distinct = written(fps.groupBy("fp").agg(first), "distinct")
    roots = components(links(distinct.select("fp"), radius)).withColumnRenamed("node", "fp")
    of_root = written(distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least"), "roots")
    best = of_root.groupBy("root").agg(F.min("least").alias("least"))
    stays = of_root.select("fp", "root").join(best, "root").select("fp", F.col(f"least.{row}").alias("stays"))
    return fps.join(stays, "fp").where(F.col(row) != F.col("stays")).select(row)
