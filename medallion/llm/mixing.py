"""Mixing sources to target weights by min-cost flow.

Documents are reduced to their membership patterns (the sets of sources they
belong to) and the words each pattern holds.  A flow routes words from the
patterns to the sources' quotas; a pattern's words cost more each time they
are repeated (a convex cost), so nothing is repeated before everything that
can help was used.  Within a pattern, the documents that a partial use takes
are the first in a seeded order.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import map_batches, pick, written

REPEATS = 3  # uses of a document at most
WEIGHTS = (1, 2, 3)  # of the sources in order, repeating
KEY_DIGITS = 3  # hex digits of the order key that a search by sums adds
WIDTH = 66  # hex digits of the order key are 64; a multiple of KEY_DIGITS
FEW = 1 << 16  # documents that are put in order, or broadcast, of a pattern
PATTERNS = 1 << 16  # sets of sources that the driver's flow is made for


def targets(sizes: dict[str | None, int], weights: dict[str | None, float], repeats: int = REPEATS) -> dict[str | None, float]:
    """Shares of the total by weight, none above ``repeats`` times its
    source's size; what is cut off goes to the others by weight."""
    left, weight, share = sum(sizes.values()), sum(weights.values()), 0.0
    for s in sorted(sizes, key=lambda s: repeats * float(sizes[s]) / weights[s]):
        share = left / weight if weight else 0.0
        if share <= repeats * float(sizes[s]) / weights[s]:
            break
        left, weight = left - repeats * sizes[s], weight - weights[s]
    return {s: min(repeats * float(sizes[s]), weights[s] * share) for s in sizes}


def min_cost_flow(patterns: list[tuple[tuple, int]], quotas: dict, repeats: int = REPEATS) -> list[dict]:
    """Words of each pattern for each of its sources: as much of the quotas
    as can be met, at the least cost of repetition.  Successive shortest
    paths with potentials; the ``r``-th use of a pattern's words costs r."""
    sources = list(quotas)
    n_p, start = len(patterns), 0
    node = {s: 1 + n_p + i for i, s in enumerate(sources)}
    end = 1 + n_p + len(sources)
    edges: list[list[int]] = []  # to, capacity, cost; an edge's reverse is its neighbour
    out: list[list[int]] = [[] for _ in range(end + 1)]

    def edge(a: int, b: int, capacity: int, cost: int) -> int:
        out[a].append(len(edges))
        edges.append([b, capacity, cost])
        out[b].append(len(edges))
        edges.append([a, 0, -cost])
        return len(edges) - 2

    flows = []
    for i, (members, size) in enumerate(patterns):
        for r in range(repeats):
            edge(start, 1 + i, size, r + 1)
        flows.append({s: edge(1 + i, node[s], repeats * size, 0) for s in members})
    for s in sources:
        edge(node[s], end, math.floor(quotas[s]), 0)
    potential = [0] * (end + 1)
    while True:
        far, via = {start: 0}, {}
        queue = [(0, start)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for k in out[a]:
                b, capacity, cost = edges[k]
                if capacity and (new := d + cost + potential[a] - potential[b]) < far.get(b, math.inf):
                    far[b], via[b] = new, k
                    heapq.heappush(queue, (new, b))
        if end not in far:
            break
        potential = [p + min(far.get(v, math.inf), far[end]) for v, p in enumerate(potential)]
        path, v = [], end
        while v != start:
            path.append(via[v])
            v = edges[via[v] ^ 1][0]
        amount = min(edges[k][1] for k in path)
        for k in path:
            edges[k][1] -= amount
            edges[k ^ 1][1] += amount
    return [{s: edges[k ^ 1][1] for s, k in f.items()} for f in flows]


def sized(docs: DataFrame, source_col: str = "source", row: str | None = None) -> DataFrame:
    """doc_id, size (words), sources (an array of the one source), and the
    column ``row``, a long, if it is named."""
    more = {row: row} if row else {}

    def fn(batch: pa.RecordBatch) -> dict:
        size = [len(t.split()) for t in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "size": size, "source": batch.column(2)} | {c: batch.column(c) for c in more}

    d = pick(docs, doc_id="doc_id", text="text", source=source_col, **more)
    d = d.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"), F.col("source").cast("string").alias("source"), *more)
    schema = "doc_id long, size long, source string" + "".join(f", {c} long" for c in more)
    return map_batches(d, fn, schema).select("doc_id", "size", F.array("source").alias("sources"), *more)


def order_key(seed: int, row: str, doc_id: Column, size: Column, by_row: bool = True) -> Column:
    """The seeded order of documents as hex digits: 16 of an md5 of the id (of
    a null id: of the row's number, if it counts), then the id, the size and
    the row's number, which tell apart those that share an id."""
    of_null = F.concat(F.lit("row "), F.col(row).cast("string")) if by_row else F.lit("")
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), of_null), F.lit(f":{seed}")).cast("binary"))
    wide = lambda c: F.lpad(F.lower(F.hex(c)), 16, "0")
    ident = F.coalesce(doc_id.cast("long"), F.lit(-1)).bitwiseXOR(F.lit(-(1 << 63)))  # unsigned digits in the order of the ids
    return F.concat(F.substring(digest, 1, 16), wide(ident), wide(size), wide(F.col(row)))


@dataclass
class Mix:
    """What a mix takes of a pattern's documents: each ``whole`` times, and once
    more those whose order key is below ``end`` (all keys of the part ``end``
    itself are judged one by one: ``last`` has them with their decision)."""

    patterns: DataFrame  # sources, whole, source_size, target, p, end (null: no partial use)
    last: DataFrame  # row, more
    n_last: int

    def uses(self, docs: DataFrame, row: str) -> DataFrame:
        """``docs`` (sources, key, the column ``row`` and others) with the
        columns of the pattern and ``uses``."""
        plan = self.patterns.withColumnRenamed("sources", "_sources")
        got = docs.join(F.broadcast(plan), docs["sources"].eqNullSafe(plan["_sources"])).drop("_sources")
        last = self.last.select(F.col("row").alias("_last"), F.col("more").alias("_more"))
        got = got.join(F.broadcast(last) if self.n_last <= FEW else last, got[row] == F.col("_last"), "left")
        more = F.when(F.col("_more").isNotNull(), F.col("_more")).when(F.substring("key", 1, F.length("end")) < F.col("end"), 1).otherwise(0)
        return got.withColumn("uses", F.col("whole") + F.coalesce(more, F.lit(0))).drop("_last", "_more")


def plan_mix(docs: DataFrame, repeats: int = REPEATS) -> Mix:
    """The mix of ``docs`` (row, size, sources, key), a written table.

    Only words by pattern reach the driver: sources are what a mix is
    configured by, and over ``PATTERNS`` patterns it refuses to start.  Where a
    partial use ends is found by sums over parts of the order keys,
    ``KEY_DIGITS`` digits at a time, until no part to be put in order holds more
    than ``FEW`` documents; so rows that share an id are dealt by their size and
    key like others.
    """
    spark = docs.sparkSession
    rows = docs.groupBy("sources").agg(F.sum("size").alias("size")).limit(PATTERNS + 1).collect()
    if len(rows) > PATTERNS:
        raise ValueError(f"more than {PATTERNS} patterns of sources")
    schema = "sources array<string>, whole long, rest long, source_size long, target double, p long"
    sizes: dict = {}
    for r in rows:
        for s in r.sources:
            sizes[s] = sizes.get(s, 0) + r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = targets(sizes, {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(order)}, repeats)
    flows = min_cost_flow([(tuple(r.sources), r["size"]) for r in rows], want, repeats)
    table = []
    for p, (r, flow) in enumerate(zip(rows, flows, strict=True)):
        used = sum(flow.values())
        whole = min(repeats, used // r["size"]) if r["size"] else 0
        table.append((r.sources, whole, used - whole * r["size"], sum(sizes[s] for s in r.sources), float(sum(want[s] for s in r.sources)), p))
    patterns = spark.createDataFrame(table, schema)
    of_plan = patterns.where("rest > 0").select(F.col("sources").alias("_sources"), "rest", "p")
    open_ = docs.join(F.broadcast(of_plan), docs["sources"].eqNullSafe(of_plan["_sources"])).select("row", "size", "key", "rest", "p")

    # a row per pattern: (p, end, before); the part ``end`` holds n documents
    ends = [(r[5], "", 0, None) for r in table if r[2] > 0]
    digits = 0
    while ends and digits < WIDTH and (digits == 0 or max(e[3] for e in ends) > FEW):
        digits += KEY_DIGITS
        at = spark.createDataFrame(ends, "p long, end string, before long, n long")
        within = open_.join(F.broadcast(at), "p").where(F.substring("key", 1, digits - KEY_DIGITS) == F.col("end"))
        sums = within.groupBy("p", F.substring("key", 1, digits).alias("part"), "before", "rest").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        sums = sums.withColumn("upto", F.col("before") + F.sum("size").over(Window.partitionBy("p").orderBy("part")))
        at_end = sums.where("upto >= rest").groupBy("p").agg(F.min_by(F.struct("part", F.col("upto") - F.col("size"), "n"), "part").alias("e"))
        ends = [(r.p, *r.e) for r in at_end.select("p", "e").collect()]
    at = spark.createDataFrame(ends, "p long, end string, before long, n long")
    within = open_.join(F.broadcast(at), "p").where(F.substring("key", 1, digits) == F.col("end"))
    place = Window.partitionBy("p").orderBy("key", "row").rowsBetween(Window.unboundedPreceding, 0)
    near = within.withColumn("at", F.col("before") + F.sum("size").over(place) - F.col("size"))
    last = written(near.select("row", (2 * (F.col("rest") - F.col("at")) > F.col("size")).cast("long").alias("more")), "mix-last")
    return Mix(patterns.join(F.broadcast(at.select("p", "end")), "p", "left").drop("p", "rest"), last, last.count())


def keyed(sized_docs: DataFrame, seed: int = 0, row: str | None = None) -> DataFrame:
    """``sized_docs`` with the columns ``row`` and ``key``, written.  Without a
    key of its own, a row's number decides between rows of one id and size."""
    docs = sized_docs.withColumn("sources", F.array_sort("sources"))
    docs = docs.withColumn("row", F.col(row) if row else F.monotonically_increasing_id())
    return written(docs.withColumn("key", order_key(seed, "row", F.col("doc_id"), F.col("size"), bool(row))), "sized")


def mix(sized_docs: DataFrame, seed: int = 0, repeats: int = REPEATS, row: str | None = None) -> DataFrame:
    """doc_id, size, sources, source_size, target (sums over the document's
    sources) and taken: the words the mix takes, repeats counted; and the
    column ``row``, a unique key, if it is named.

    Sources in code point order, null last, weigh 1, 2, 3, repeating.  Empty
    documents take part with nothing.  Repeated rows, and rows that share a
    doc_id or have none, are documents each, whatever their number.  Empty
    table: no rows.
    """
    docs = keyed(sized_docs, seed, row)
    out = plan_mix(docs, repeats).uses(docs, "row")
    return out.select("doc_id", "size", "sources", "source_size", "target", (F.col("size") * F.col("uses")).alias("taken"), *([row] if row else []))
