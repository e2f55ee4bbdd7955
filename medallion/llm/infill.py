"""Fill-in-the-middle documents.

A text is cut into prefix, middle and suffix at two seeded boundaries between
its units (runs of ASCII letters, or single code points) and the parts are put
in another order behind markers.

Cuts are found in bytes and told in code points.  Between the two stands a
sparse index of exceptions: only characters of more than one byte are recorded,
by position and excess bytes.  ``searchsorted`` finds how many of them lie
before a cut; the spans between them are ASCII, where positions are arithmetic.

Cases: a null text is empty, an empty text plain.  A null doc_id is hashed as
an empty one, so such rows are cut alike if their texts are; rows that repeat a
doc_id are transformed each.  A text is held by one task as a whole, with a few
masks of its length; no text is cut off.  An empty table gives no rows; extra
columns, whatever their names, are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import documents, map_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90  # of 100: the rest stays plain
SPM_BELOW = 20  # of 100: suffix first


class Exceptions:
    """The sparse index of a text: its characters of several bytes."""

    def __init__(self, raw: np.ndarray):
        self.at = np.flatnonzero(raw >= 0xC0)  # their first bytes
        lead = raw[self.at]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate([[0], np.cumsum(excess)])  # before the i-th of them
        self.char = self.at - self.excess[:-1]  # their places in code points

    def chars(self, at: np.ndarray) -> np.ndarray:
        """Code points before the byte positions ``at``."""
        return at - self.excess[np.searchsorted(self.at, at, "left")]

    def bytes(self, at: np.ndarray) -> np.ndarray:
        """Bytes before the code points ``at``."""
        return at + self.excess[np.searchsorted(self.char, at, "left")]


def unit_starts(raw: np.ndarray) -> np.ndarray:
    """Byte positions where the units of a UTF-8 text begin."""
    folded = raw | 0x20
    letter = (folded >= 0x61) & (folded <= 0x7A) & (raw < 0x80)
    first = (raw & 0xC0) != 0x80
    first[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(first)


def seeds(id_col: str, seed: int) -> list[Column]:
    """Four 32-bit numbers of a document, from the sha256 of its seeded id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    digest = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), the code points and bytes
    of prefix and middle (null if plain) and the output text."""

    def fn(batch: pa.RecordBatch) -> dict:
        out: dict = {c: [] for c in ("n", "form", "prefix_chars", "middle_chars", "prefix_bytes", "middle_bytes", "output")}
        draws = [batch.column(2 + k).to_pylist() for k in range(4)]
        for text, h1, h2, h3, h4 in zip(batch.column(1), *draws, strict=True):
            data = text.as_py()
            raw = np.frombuffer(data, np.uint8)
            starts = unit_starts(raw)
            n = len(starts)
            marked = any(m in data for m in _MARKS)
            form = "plain" if not data or marked or h3 % 100 >= PLAIN_FROM else "spm" if h4 % 100 < SPM_BELOW else "psm"
            sizes: list = [None] * 4
            if form != "plain":
                index = Exceptions(raw)
                cuts = np.append(starts, len(raw))[sorted((h1 % (n + 1), h2 % (n + 1)))]
                chars = index.chars(cuts)
                a, b = index.bytes(chars).tolist()
                sizes = [int(chars[0]), int(chars[1] - chars[0]), a, b - a]
                p, m, s = data[:a], data[a:b], data[b:]
                parts = (_MARKS[0], p, _MARKS[1], s, _MARKS[2], m) if form == "psm" else (_MARKS[1], s, _MARKS[0], p, _MARKS[2], m)
                data = b"".join(parts)
            for c, v in zip(out, (n, form, *sizes, data), strict=True):
                out[c].append(v)
        return {"doc_id": batch.column(0)} | out

    d = documents(docs).select("doc_id", "text", *seeds("doc_id", seed))
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, prefix_bytes long, middle_bytes long, output binary"
    got = map_batches(d, fn, schema)
    return got.withColumn("output", F.col("output").cast("string"))


_MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of.  Texts that hold a marker stay
    plain, so the markers of the others are where they were put."""
    a, b, middle = [F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", 4)[k] for k in (1, 2, 3)]
    return F.when(form == "psm", F.concat(a, middle, b)).when(form == "spm", F.concat(b, middle, a)).otherwise(output)
