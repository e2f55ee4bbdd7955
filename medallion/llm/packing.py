"""Best-fit packing of documents into sequences, by patterns of lengths.

The corpus is reduced to a histogram of piece lengths (at most ``size``
bins, whatever the number of documents).  Patterns of two or three lengths
that fill a sequence exactly are enumerated; non-negative least squares fits
how often each is repeated to the histogram; the rounded repeats are taken
off it, and what is left is packed best-fit, longest first, on the counts.
Each piece then finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import documents, map_batches, written
from medallion.llm.tokens import word_ids

STEPS = 120  # of the least-squares descent


def exact_patterns(lengths: np.ndarray, size: int) -> np.ndarray:
    """Rows of three lengths (0: none), ascending, that sum to ``size``."""
    have = np.zeros(size + 1, bool)
    have[lengths] = True
    have[0] = True
    out = []
    for a in np.flatnonzero(have[: size // 3 + 1]):
        b = np.arange(a, (size - a) // 2 + 1)
        c = size - a - b
        ok = have[b] & have[c] & (b > 0)
        out.append(np.column_stack([np.full(ok.sum(), a), b[ok], c[ok]]))
    return np.concatenate(out) if out else np.zeros((0, 3), int)


def fit_repeats(patterns: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """min |A x - counts|^2, x >= 0, where A counts the lengths of a pattern:
    accelerated projected gradient, from zero.  Bin 0 isn't a length."""
    x = y = np.zeros(len(patterns))
    target = counts.astype(float)
    t, bins = 1.0, len(counts)
    flat = patterns.ravel()
    used = np.bincount(flat, minlength=bins).astype(float)
    used[0] = 0
    step = 1 / max(1.0, 3 * used.max())  # 1 / (largest row sum x largest column sum)
    for _ in range(steps if len(patterns) else 0):
        r = np.bincount(flat, np.repeat(y, 3), bins) - target
        r[0] = 0
        nxt = np.maximum(0, y - step * r[patterns].sum(1))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = nxt + (t - 1) / t2 * (nxt - x)
        x, t = nxt, t2
    return x


def best_fit(counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: (lengths, repeats)."""
    space: dict[int, list[list]] = defaultdict(list)  # free: [lengths, repeats]
    done: list[tuple[tuple[int, ...], int]] = []

    def put(free: int, lengths: tuple[int, ...], n: int) -> None:
        if free:
            space[free].append([lengths, n])
        else:
            done.append((lengths, n))

    for length in range(size, 0, -1):
        n = int(counts[length])
        while n:
            free = min((s for s in space if s >= length), default=None)
            if free is None:
                lengths, have, free = (), n, size
            else:
                lengths, have = space[free].pop()
                if not space[free]:
                    del space[free]
            each = min(free // length, n)
            full = min(have, n // each)
            put(free - each * length, lengths + (length,) * each, full)
            n -= each * full
            if have > full and lengths:
                put(free, lengths, have - full)
    return done + [(lengths, n) for bins in space.values() for lengths, n in bins]


def _take(patterns: np.ndarray, want: np.ndarray, left: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Take ``want`` repeats of the patterns off ``left``, the most wanted
    first and never more than there is."""
    out = []
    for i in np.argsort(-want, kind="stable")[: np.count_nonzero(want >= 1)]:
        lengths = tuple(int(v) for v in patterns[i] if v)
        n = min(int(want[i]), *(int(left[v]) // lengths.count(v) for v in set(lengths)))
        if n > 0:
            out.append((lengths, n))
            for v in lengths:
                left[v] -= n
    return out


def plan(counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) that use every piece of the histogram once.  The
    fitted repeats are rounded up, to the nearest, or down; the rounding
    whose sequences, with the packed residual, are fewest is kept."""
    whole = [((size,), int(counts[size]))] if counts[size] else []
    short = counts.astype(np.int64).copy()
    short[size] = 0
    patterns = exact_patterns(np.flatnonzero(short), size)
    x = fit_repeats(patterns, short)
    best = None
    for want in (np.floor(x), np.rint(x), np.ceil(x - 0.1)):
        left = short.copy()
        got = _take(patterns, want, left)
        got += best_fit(left, size)
        n = sum(k for _, k in got)
        if best is None or n < best[0]:
            best = n, got
    return whole + best[1]


def places(plan_: list[tuple[tuple[int, ...], int]], counts: np.ndarray) -> dict[str, np.ndarray]:
    """Where the pieces go.  Pieces are numbered by length, then by rank; slot
    class ``j`` takes the numbers up to ``end[j]``."""
    slots, seq = [], 0
    for lengths, n in plan_:
        at = 0
        for v in lengths:
            slots.append((v, seq, at, n))
            at += v
        seq += n
    slots.sort()
    a = np.array(slots, np.int64).reshape(-1, 4)
    return {"before": np.concatenate([[0], np.cumsum(counts)])[: len(counts)].astype(np.int64), "end": np.cumsum(a[:, 3]), "seq": a[:, 1], "offset": a[:, 2], "n": a[:, 3]}


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, size: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's ids (with
    ``end_id`` after them) cut every ``size`` ids, and ``task``, ``rank``: the
    piece's number among the task's pieces of its length."""

    def start() -> tuple:
        return word_ids(tokenizer_path), defaultdict(int), TaskContext.get().partitionId()

    def fn(batch: pa.RecordBatch, state: tuple) -> dict:
        words, seen, task = state
        end = np.array([end_id], words.dtype)
        out: dict[str, list] = {c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32", "rank")}
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = np.concatenate([np.frombuffer(words.ids(text), words.dtype), end]).astype("<u4")
            for k, at in enumerate(range(0, len(ids), size)):
                part = ids[at : at + size]
                n = len(part)
                for c, v in zip(out, (doc_id, k, at, n, zlib.crc32(part), seen[n]), strict=True):
                    out[c].append(v)
                seen[n] += 1
        return out | {"task": np.full(len(out["doc_id"]), task, np.int32)}

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long"
    return map_batches(documents(docs), fn, schema, start)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 0, size: int = 2048) -> DataFrame:
    """A row per piece with its sequence and its offset there.

    The pieces are written once, so that the ranks stay as they are if an
    executor is lost.  A piece's rank in its length is its rank in its task
    plus the counts of the tasks before; neither a window nor a group meets
    the pieces of one length.  The driver gets the histogram (``size`` rows).

    Null text: one piece, the end id.  Repeated rows are packed each.  Empty
    table: no rows.
    """
    got = written(pieces(docs, tokenizer_path, end_id, size), "pieces")
    by_task = got.groupBy("length", "task").count()
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    by_task = by_task.withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    counts = np.zeros(size + 1, np.int64)
    for length, n in got.groupBy("length").count().collect():
        counts[length] = n
    to = places(plan(counts, size), counts)

    def place(frames):
        for f in frames:
            number = to["before"][f["length"]] + f["base"].to_numpy() + f["rank"].to_numpy()
            j = np.searchsorted(to["end"], number, "right")
            nth = number - (to["end"][j] - to["n"][j])
            yield pd.DataFrame({**{c: f[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")}, "sequence_id": to["seq"][j] + nth, "offset": to["offset"][j]})

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return got.join(by_task, ["length", "task"]).mapInPandas(place, schema)
