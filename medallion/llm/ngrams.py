"""Language-model scores from a log-frequency Bloom filter.

The filter holds the counts of words and of pairs of words, quantised on a log
scale: an n-gram of level q was inserted q times, as (n-gram, 1) ... (n-gram,
q).  Its level is read by probing for 1, 2, ... until a probe fails, and stands
for the mean of the counts of that level.  An event's bits are in two words of
64 bits, so a probe reads two places of the filter.  A word's probability after another is
smoothed with the word's own (a Dirichlet prior of weight ``PRIOR``); a pair
can't be more frequent than its words, which catches most false hits.

Words are 128-bit hashes.  Words are counted exactly, by hash, over all
documents; the pairs of the training documents likewise.  The filter is cut
into segments of a mebibyte by n-gram hash, as many as the n-grams need, so it
grows with the corpus at the same error rate.  Up to ``BROADCAST`` bytes it is
broadcast.  A larger filter stays distributed: a block of documents sends its
distinct n-grams to slices of the filter and gets their levels back (an
eighth of the bytes), with the same results.  A block is kept as the codes and
the hashes of its words, so its texts are split into words once.  Filter and
n-grams travel in pieces of ``PIECE`` bytes, sorted by slice, so that a task
holds one slice and a batch of pieces, whatever the size of the corpus.  The
documents ask in ``ROUNDS`` rounds, whose tables and shuffles go before the next.

The base score needs exact counts: those of words in the highest count classes,
``COMMON`` at most, are broadcast, so that no frequent word is shuffled; the
other words of a document are joined to the table of counts.

Cases: a null text is empty, which is one token, the end.  A null doc_id counts
as an empty one when training documents are told.  Rows that repeat a doc_id
are documents each, and count each.  No training documents: every word is
unknown, of probability 1 by the formula.  A text is held by one task as a
list of its words, whatever its length.  An empty table gives no rows; extra
columns, whatever their names, are left out.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import documents, map_batches, release, stored, written
from medallion.sources import fs

LEVEL_BASE = 1.5  # of the log scale of counts
PROBES = 8  # bits of an event, four in each of two words
SEGMENT_BITS = 1 << 23
SEGMENT_EVENTS = 650_000  # on average; at 726,817 half of the bits are set
BROADCAST = 16 << 20  # bytes of a filter that every worker may hold
SLICE = 4 << 20  # bytes of a slice of a larger one; of ``SLICES`` slices and more, up to 16 times that
SLICES = 256
ROUNDS = 4  # parts of the documents that ask a filter in slices one after another
PIECE = 1 << 15  # bytes of a row of the filter or of n-grams
TURN = 64  # pieces whose levels are read at once
BLOCK_BYTES = 4 << 20  # of the texts of a block, and one text more
COMMON = 1 << 18  # words whose exact counts every worker holds
PRIOR = 1000.0  # pseudo-counts of the prior of words after a word
ASKED = 1 << 22  # hashes, or fewer, that meet a slice of ``SLICE`` bytes in one task
END = b" end"  # no word has a space

_GOLDEN, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64's constants)."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@dataclass
class Tokens:
    """The tokens of some texts: each text's words and then the end."""

    sizes: np.ndarray  # tokens of each text
    codes: np.ndarray  # of all tokens in order: rows of ``keys``
    keys: np.ndarray  # the distinct words' hashes, two longs each

    def pairs(self) -> np.ndarray:
        """The hash of each token with the one before; before the first word
        of a text stands an end."""
        own = self.keys[:, 0]
        end = _hashes([END])[0, 0]
        before = np.concatenate([[end], own[self.codes[:-1]]]) if len(self.codes) else np.zeros(0, np.uint64)
        return mixed(mixed(before) + own[self.codes])

    def of(self, chosen: np.ndarray) -> "Tokens":
        """Those of the chosen texts."""
        return Tokens(self.sizes[chosen], self.codes[np.repeat(chosen, self.sizes)], self.keys)


def _hashes(words) -> np.ndarray:
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(w) for w in words), "<u8").reshape(-1, 2)


def tokens(texts) -> Tokens:
    flat, sizes = [], []
    for t in texts:
        words = t.as_py().lower().split()
        flat += words
        flat.append(END)
        sizes.append(len(words) + 1)
    code_of: dict[bytes, int] = defaultdict(itertools.count().__next__)
    codes = np.fromiter(map(code_of.__getitem__, flat), np.int64, len(flat))
    return Tokens(np.array(sizes, np.int64), codes, _hashes(code_of))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.flags.c_contiguous else np.ascontiguousarray(x).view(np.int64)


# ------------------------------------------------------------------ filter
def level(n: Column) -> Column:
    return (F.floor(F.log(n.cast("double")) / float(np.log(LEVEL_BASE)) + 1e-9) + 1).cast("int")


def estimates() -> np.ndarray:
    """The mean count of each level (level 0: none)."""
    starts = np.ceil(LEVEL_BASE ** np.arange(110) - 1e-6)
    return np.concatenate([[0.0], (starts[:-1] + starts[1:] - 1) / 2])


_SALTS = mixed(np.arange(256, dtype=np.uint64))  # of the levels


_WORD, _TWELVE = np.uint64(SEGMENT_BITS // 64 - 1), np.uint64(4095)
# masks of two bits of a word, by their twelve-bit numbers
_TWO = (np.uint64(1) << (np.arange(4096, dtype=np.uint64) & np.uint64(63))) | (np.uint64(1) << (np.arange(4096, dtype=np.uint64) >> np.uint64(6)))
SEGMENT_BYTES = SEGMENT_BITS // 8


def _mask(y: np.ndarray, shift: int) -> np.ndarray:
    """Four bits of a word, by the 24 bits of ``y`` from ``shift`` on."""
    return _TWO[((y >> np.uint64(shift)) & _TWELVE).view(np.int64)] | _TWO[((y >> np.uint64(shift + 12)) & _TWELVE).view(np.int64)]


def _event(x: np.ndarray, q: int) -> np.ndarray:
    return mixed(x ^ _SALTS[q])


def _probe(y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k-th of the two words of 64 bits that hold the events ``y``, and the
    ``PROBES / 2`` bits in it."""
    word = ((y >> np.uint64(17 * k)) & _WORD).view(np.int64)
    return word, _mask(y, 34) if k == 0 else _mask(y * _M1, 40)


def segment_of(x: np.ndarray, n: int) -> np.ndarray:
    """Segments are ranges of the hashes: sorted hashes read them in turn."""
    return ((x >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def segment_bits(x: np.ndarray, levels: np.ndarray) -> bytes:
    words = np.zeros(SEGMENT_BITS // 64, "<u8")
    for q in range(1, int(levels.max(initial=0)) + 1):
        x, levels = x[levels >= q], levels[levels >= q]
        y = _event(x, q)
        for k in (0, 1):
            np.bitwise_or.at(words, *_probe(y, k))
    return words.tobytes()


def read_levels(bits: np.ndarray, at: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Levels of the hashes ``x``, whose segments begin at the bytes ``at`` of
    ``bits``."""
    words, found, q = bits.view("<u8"), np.zeros(len(x), np.uint8), 0
    open_, begin = np.arange(len(x)), at >> 3
    while len(open_):
        q += 1
        y = _event(x, q)
        for k in (0, 1):
            word, mask = _probe(y, k)
            hit = words[begin + word] & mask == mask
            y, x, open_, begin = y[hit], x[hit], open_[hit], begin[hit]
        found[open_] = q
    return found


@dataclass
class Model:
    tokens: int  # in training documents
    vocabulary: int  # distinct ones
    words: DataFrame  # a, b (hash), n (in training documents), t (in all)
    common: tuple[np.ndarray, np.ndarray, np.ndarray]  # a, b, n, by a
    least_class: int  # of the common words
    segments: DataFrame  # segment, piece, bits
    n_segments: int
    prior: float = PRIOR

    def own(self, n):
        """The probability of a word that was counted n times."""
        return (n + 0.5) / (self.tokens + 0.5 * (self.vocabulary + 1))


def count_class(t: Column) -> Column:
    return F.floor(F.log2(t.cast("double")) * 16)


def train(docs: DataFrame, held_out: Column) -> Model:
    """Counts over ``docs`` (documents); those ``held_out`` aren't learned from."""
    spark = docs.sparkSession
    d = docs.withColumn("_own", ~held_out)

    def count(batch: pa.RecordBatch) -> dict:
        """Words (a, b) with their numbers in training and in all documents,
        and pairs (a, null) with theirs in training documents."""
        found = tokens(batch.column("text"))
        learned = batch.column("_own").to_numpy(zero_copy_only=False).astype(bool)
        own = np.repeat(learned, found.sizes)
        n, t = (np.bincount(codes, minlength=len(found.keys)) for codes in (found.codes[own], found.codes))
        x, m = np.unique(found.of(learned).pairs(), return_counts=True)
        no_word = np.arange(len(n) + len(m)) >= len(n)
        b = np.concatenate([_signed(found.keys[:, 1]), np.zeros(len(m), np.int64)])
        return {"a": np.concatenate([_signed(found.keys[:, 0]), _signed(x)]), "b": pa.array(b, mask=no_word), "n": np.concatenate([n, m]), "t": np.concatenate([t, np.zeros(len(m), np.int64)])}

    counted = map_batches(d.select("text", "_own"), count, "a long, b long, n long, t long").groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    counts, path = stored(counted, "n-grams")
    release(spark)
    table = written(counts.where("b is not null"), "words")
    total = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0))).first()
    classes = sorted(((r[0], r[1]) for r in table.groupBy(count_class(F.col("t"))).count().collect()), reverse=True)
    room, least = COMMON, 1 << 30
    for c, n in classes:
        if n > room:
            break
        room, least = room - n, c
    top = table.where(count_class(F.col("t")) >= least).select("a", "b", "n").toPandas()
    a = top["a"].to_numpy(np.int64)
    order = np.argsort(a)
    common = tuple(x[order] for x in (a, top["b"].to_numpy(np.int64), top["n"].to_numpy(np.int64)))

    entries = counts.where("n > 0").select(F.col("a").alias("x"), level(F.col("n")).alias("q"))
    n_segments = max(1, -(-(entries.agg(F.sum("q")).first()[0] or 0) // SEGMENT_EVENTS))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        x = group["x"].to_numpy(np.int64).view(np.uint64)
        bits = segment_bits(x, group["q"].to_numpy())
        pieces = [bits[i : i + PIECE] for i in range(0, SEGMENT_BYTES, PIECE)]
        return pd.DataFrame({"segment": group["segment"].iloc[0], "piece": range(len(pieces)), "bits": pieces})

    cut = entries.withColumn("segment", F.shiftright(F.shiftrightunsigned("x", 32) * F.lit(n_segments).cast("long"), 32))
    segments = written(cut.groupBy("segment").applyInPandas(build, "segment long, piece int, bits binary"), "filter")
    fs.delete(spark, path)
    release(spark)
    return Model(total[0], total[1], table, common, least, segments, n_segments)


# ------------------------------------------------------------------ scores
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, rest array<struct<a: long, b: long, n: int>>"


def _distinct(found: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes of words and pairs, and where each word and each
    token's pair is among them."""
    x, back = np.unique(np.concatenate([found.keys[:, 0], found.pairs()]), return_inverse=True)
    return x, back[: len(found.keys)], back[len(found.keys) :]


def _scores(found: Tokens, levels: np.ndarray, at_word: np.ndarray, at_pair: np.ndarray, shape: tuple) -> dict:
    """Columns of the texts' scores, given the levels of the distinct hashes.
    Words that aren't common are left to be looked up (``rest``)."""
    model, (ca, cb, cn), end = shape
    counts = estimates()[levels]
    word = counts[at_word][found.codes]
    starts = np.concatenate([[0], np.cumsum(found.sizes)[:-1]]).astype(np.int64)
    before = np.concatenate([[0.0], word[:-1]]) if len(word) else word
    before[starts] = end
    pair = np.minimum(np.minimum(counts[at_pair], before), word)
    p = np.log10((pair + model.prior * model.own(word)) / (before + model.prior))
    a, b = _signed(found.keys[:, 0]), _signed(found.keys[:, 1])
    at = np.minimum(np.searchsorted(ca, a), max(0, len(ca) - 1))
    known = (ca[at] == a) & (cb[at] == b) if len(ca) else np.zeros(len(a), bool)
    n = np.where(known, cn[at], 0) if len(ca) else np.zeros(len(a), np.int64)
    base = np.where(known, np.log10(model.own(n)), 0.0)
    text = np.repeat(np.arange(len(found.sizes)), found.sizes)
    open_ = ~known[found.codes]
    cell, m = np.unique(text[open_] * np.int64(len(a)) + found.codes[open_], return_counts=True)
    owner, code = cell // max(1, len(a)), cell % max(1, len(a))
    ends = np.searchsorted(owner, np.arange(len(found.sizes) + 1))
    items = pa.StructArray.from_arrays([pa.array(a[code]), pa.array(b[code]), pa.array(m.astype(np.int32))], ["a", "b", "n"])
    sums = lambda x: np.add.reduceat(x, starts) if len(starts) else x
    return {"n_tokens": found.sizes, "n_known": sums((n > 0)[found.codes].astype(np.int64)), "base_score": sums(base[found.codes]), "score": sums(p),
            "rest": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)}


@dataclass
class _Shape:
    """What a worker needs of a model besides the filter."""

    tokens: int
    vocabulary: int
    prior: float
    own = Model.own


def _shape(model: Model) -> tuple:
    a, b = _signed(_hashes([END])[0])
    end = model.words.where((F.col("a") == int(a)) & (F.col("b") == int(b))).select("n").first()
    return _Shape(model.tokens, model.vocabulary, model.prior), model.common, float(end[0]) if end else 0.0


def _by_broadcast(docs: DataFrame, model: Model) -> DataFrame:
    sc = docs.sparkSession.sparkContext
    bits = np.zeros(model.n_segments * SEGMENT_BYTES, np.uint8)
    for r in model.segments.toLocalIterator():
        at = r.segment * SEGMENT_BYTES + r.piece * PIECE
        bits[at : at + PIECE] = np.frombuffer(r.bits, np.uint8)
    held, shape = sc.broadcast(bits), sc.broadcast(_shape(model))

    def fn(batch: pa.RecordBatch) -> dict:
        found = tokens(batch.column("text"))
        x, at_word, at_pair = _distinct(found)
        own = held.value
        levels = read_levels(own, segment_of(x, len(own) // SEGMENT_BYTES) * SEGMENT_BYTES, x)
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out")} | _scores(found, levels, at_word, at_pair, shape.value)

    return map_batches(docs, fn, SCORED)


BLOCK = "doc_id array<long>, held_out array<boolean>, sizes array<long>, codes binary, keys binary, n long"
#: A block is a long row: by Parquet's own rule a hundred of them would be a page.
FEW_A_PAGE = {"parquet.block.size": 8 << 20, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 4, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 4}


def _pack(batch: pa.RecordBatch) -> dict:
    """Blocks of the texts in order."""
    found = tokens(batch.column("text"))
    ends = np.cumsum([len(t) for t in batch.column("text").to_pylist()])
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(ends // BLOCK_BYTES)) + 1, [len(ends)]]).astype(np.int32)
    out: dict = {c: pa.ListArray.from_arrays(pa.array(cuts), v) for c, v in (("doc_id", batch.column("doc_id")), ("held_out", batch.column("held_out")), ("sizes", pa.array(found.sizes)))}
    out |= {"codes": [], "keys": [], "n": []}
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        chosen = np.zeros(len(ends), bool)
        chosen[lo:hi] = True
        own, codes = np.unique(found.of(chosen).codes, return_inverse=True) if len(cuts) > 2 else (slice(None), found.codes)
        keys = found.keys[own]
        out["codes"].append(codes.astype(np.uint16 if len(keys) <= 1 << 16 else np.uint32).tobytes())
        out["keys"].append(keys.tobytes())
        out["n"].append(len(codes) + len(keys))  # the n-grams are no more
    return out


def _unpacked(block: pa.RecordBatch) -> Tokens:
    """The tokens of a block, a row."""
    sizes = block.column("sizes")[0].values.to_numpy()
    raw = block.column("codes")[0].as_buffer()
    codes = np.frombuffer(raw, f"<u{raw.size // int(sizes.sum())}").astype(np.int64)
    return Tokens(sizes, codes, np.frombuffer(block.column("keys")[0].as_buffer(), "<u8").reshape(-1, 2))


def _by_slices(docs: DataFrame, model: Model) -> DataFrame:
    """Blocks of documents ask slices of the filter for the levels of their
    distinct n-grams, in order of the hashes, which is that of the slices.  A
    slice that may be asked for more than ``ASKED`` hashes meets them in
    several tasks, each with a copy of it.  Rows get their ``row`` here."""
    spark = docs.sparkSession
    shape, parts = spark.sparkContext.broadcast(_shape(model)), []
    for k in range(ROUNDS):
        chosen = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)) == k)
        blocks, blocks_path = stored(map_batches(chosen, _pack, BLOCK).withColumn("block", F.monotonically_increasing_id()), "blocks", FEW_A_PAGE)
        answers, answers_path = stored(_answers(blocks, model), "answers")
        release(spark)
        got = _scored(blocks, answers, shape)
        parts.append(written(got.withColumn("row", F.monotonically_increasing_id() * ROUNDS + k), "scored"))
        for path in (blocks_path, answers_path):
            fs.delete(spark, path)
        release(spark)
    return functools.reduce(DataFrame.unionByName, parts)


def _answers(blocks: DataFrame, model: Model) -> DataFrame:
    """The levels of the blocks' distinct n-grams: block, slice, at (the
    number of the piece), levels."""
    n_segments = model.n_segments
    a_slice = max(1, min(SLICE, BROADCAST) // SEGMENT_BYTES, min(16 * SLICE // SEGMENT_BYTES, n_segments // SLICES))
    n_slices, a_piece = -(-n_segments // a_slice), PIECE // 8
    asked = ASKED * max(1, a_slice * SEGMENT_BYTES // SLICE)
    shares = max(1, math.ceil((blocks.agg(F.sum("n")).first()[0] or 0) / n_slices / asked))

    def ask(batch: pa.RecordBatch) -> dict:
        x = _distinct(_unpacked(batch))[0]
        ends = np.searchsorted(segment_of(x, n_segments) // a_slice, np.arange(n_slices + 1))
        rows = [(s, i, x[lo : min(lo + a_piece, ends[s + 1])]) for s in range(n_slices) for i, lo in enumerate(range(ends[s], ends[s + 1], a_piece))]
        return {"block": np.full(len(rows), batch.column("block")[0].as_py(), np.int64), "slice": [r[0] for r in rows], "at": [r[1] for r in rows], "data": [r[2].tobytes() for r in rows]}

    asks = map_batches(blocks.select("block", "sizes", "codes", "keys"), ask, "block long, slice long, at long, data binary", rows=1)
    asks = asks.withColumn("share", F.pmod(F.xxhash64("block"), F.lit(shares)))
    at = F.col("segment") % a_slice * SEGMENT_BYTES + F.col("piece") * PIECE
    copies = model.segments.select(F.lit(-1).cast("long").alias("block"), F.floor(F.col("segment") / a_slice).alias("slice"), at.alias("at"), F.col("bits").alias("data"))
    copies = copies.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))))

    def answer(batches):
        held, bits = None, np.zeros(a_slice * SEGMENT_BYTES, np.uint8)
        for batch in batches:
            keys = [batch.column(c).to_numpy() for c in ("slice", "share", "block", "at")]
            data = batch.column("data")
            turns = np.flatnonzero((np.diff(keys[0]) != 0) | (np.diff(keys[1]) != 0)) + 1
            for lo, hi in zip([0, *turns], [*turns, batch.num_rows]):
                if held != (held := (keys[0][lo], keys[1][lo])):
                    bits[:] = 0
                first = lo + int((keys[2][lo:hi] < 0).sum())  # the filter's rows come first
                for i in range(lo, first):
                    raw = np.frombuffer(data[i].as_buffer(), np.uint8)
                    bits[keys[3][i] : keys[3][i] + len(raw)] = raw
                for i in range(first, hi, TURN):
                    j = min(i + TURN, hi)
                    parts = [np.frombuffer(v.as_buffer(), "<u8") for v in data[i:j]]
                    x = np.concatenate(parts)
                    levels = read_levels(bits, segment_of(x, n_segments) % a_slice * SEGMENT_BYTES, x)
                    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
                    cut = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(ends), pa.py_buffer(levels)])
                    yield pa.RecordBatch.from_arrays([*(pa.array(k[i:j]) for k in (keys[2], keys[0], keys[3])), cut], ["block", "slice", "at", "levels"])

    met = copies.select("slice", "share", "block", "at", "data").unionByName(asks).repartition("slice", "share").sortWithinPartitions("slice", "share", "block", "at")
    return met.mapInArrow(answer, "block long, slice long, at long, levels binary")


def _scored(blocks: DataFrame, answers: DataFrame, shape) -> DataFrame:
    lists = answers.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("slice", "at", "levels"))).alias("answers"))

    def fn(batch: pa.RecordBatch) -> dict:
        found = _unpacked(batch)
        x, at_word, at_pair = _distinct(found)
        levels = np.frombuffer(b"".join(batch.column("answers")[0].values.field("levels").to_pylist()), np.uint8)
        return {c: batch.column(c)[0].values for c in ("doc_id", "held_out")} | _scores(found, levels, at_word, at_pair, shape.value)

    return map_batches(blocks.join(lists, "block"), fn, SCORED, rows=1)


def score(docs: DataFrame, held_out: Column, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known (their words are in training
    documents), train_tokens, base_score (exact counts) and score (the
    filter's), log10 probabilities of the whole text."""
    d = docs.select("doc_id", "text", held_out.alias("held_out"))
    if model.n_segments * SEGMENT_BYTES <= BROADCAST:
        got = written(_by_broadcast(d, model).withColumn("row", F.monotonically_increasing_id()), "scored")
    else:
        got = _by_slices(d, model)
    open_ = got.select("row", F.explode("rest").alias("w")).select("row", "w.*")
    counts = model.words.where(count_class(F.col("t")) < model.least_class).select("a", "b", F.col("n").alias("c"))
    p = (F.col("c") + 0.5) / F.lit(model.tokens + 0.5 * (model.vocabulary + 1))
    nothing = F.lit(None)
    found = open_.join(counts, ["a", "b"]).select(
        "row", nothing.cast("long").alias("doc_id"), nothing.cast("boolean").alias("held_out"), F.lit(0).cast("long").alias("n_tokens"),
        F.when(F.col("c") > 0, F.col("n")).otherwise(0).cast("long").alias("n_known"), (F.col("n") * F.log10(p)).alias("base_score"), F.lit(0.0).alias("score"))
    parts = got.drop("rest").unionByName(found)
    whole = parts.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def score_texts(docs: DataFrame, folds: int = 5, fold: int = 1) -> DataFrame:
    """Scores of all documents by a model of those whose crc32(doc_id as text)
    mod ``folds`` isn't ``fold``."""
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == fold
    d = documents(docs)
    return score(d, held_out, train(d, held_out))
