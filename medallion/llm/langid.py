"""Language identification by a bidirectional gated recurrent network.

The network reads bytes, in windows of ``WINDOW`` that cover the whole text,
forwards and backwards, and labels every position; a document's probabilities
are the mean over its positions.  It is trained by backpropagation through
time, in numpy, on a bounded sample of windows of the labelled documents.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import map_batches, pick

WINDOW = 128  # bytes
HIDDEN = 8  # units in each direction
DOCS = 128  # labelled documents of each language that are learned from
WINDOWS = 4  # of each of these documents
EPOCHS = 8
BATCH = 64
_AT_ONCE = 2048  # windows that are labelled together
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class BiGru:
    """One layer of gated recurrent units in each direction, and a softmax."""

    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.labels, self.h = labels, hidden
        self.p: dict[str, np.ndarray] = {}
        for d in "fb":
            self.p[f"{d}.in"] = rng.normal(0, 0.3, (256, 3 * hidden))  # a byte's update, reset and candidate
            self.p[f"{d}.on"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
        self.p["out"] = rng.normal(0, 1 / np.sqrt(hidden), (2 * hidden, len(labels)))
        self.p["bias"] = np.zeros(len(labels))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _run(self, d: str, steps: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (time, windows, units) of the direction over bytes (time, windows)."""
        h, table, on = self.h, self.p[f"{d}.in"], self.p[f"{d}.on"]
        state = np.zeros((steps.shape[1], h), np.float32)
        out = np.empty((*steps.shape, h), np.float32)
        order = range(len(steps)) if d == "f" else range(len(steps) - 1, -1, -1)
        for t in order:
            x, u = table[steps[t]], state @ on
            gates = _sigmoid(x[:, : 2 * h] + u[:, : 2 * h])
            z, r = gates[:, :h], gates[:, h:]
            # tanh(a) = 2 sigmoid(2 a) - 1
            n = _sigmoid(2 * (x[:, 2 * h :] + r * u[:, 2 * h :]))
            n *= 2
            n -= 1
            if keep is not None:
                keep.append((t, state, z, r, n, u[:, 2 * h :]))
            state = n + z * (state - n)
            out[t] = state
        return out

    def probabilities(self, steps: np.ndarray) -> np.ndarray:
        """(time, windows, labels) at every position of bytes (time, windows)."""
        h = self.h
        a = self._run("f", steps) @ self.p["out"][:h]
        a += self._run("b", steps) @ self.p["out"][h:]
        a += self.p["bias"]
        a -= a.max(-1, keepdims=True)
        np.exp(a, out=a)
        a /= a.sum(-1, keepdims=True)
        return a

    def gradients(self, steps: np.ndarray, inside: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over the positions ``inside`` texts."""
        h, p = self.h, self.p
        kept: dict[str, list] = {"f": [], "b": []}
        states = {d: self._run(d, steps, kept[d]) for d in "fb"}
        a = states["f"] @ p["out"][:h] + states["b"] @ p["out"][h:] + p["bias"]
        a = np.exp(a - a.max(-1, keepdims=True))
        a /= a.sum(-1, keepdims=True)
        a[:, np.arange(len(target)), target] -= 1
        a *= (inside / inside.sum())[..., None]
        g = {"bias": a.sum((0, 1)), "out": np.concatenate([np.tensordot(states[d], a, ([0, 1], [0, 1])) for d in "fb"])}
        for k, d in enumerate("fb"):
            on = p[f"{d}.on"]
            from_out = a @ p["out"][k * h : (k + 1) * h].T
            back = np.zeros_like(from_out[0])
            g_on, g_in = np.zeros_like(on), np.empty((*steps.shape, 3 * h), np.float32)
            for t, state, z, r, n, u in reversed(kept[d]):
                dh = from_out[t] + back
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (state - n) * z * (1 - z)
                dr = dn * u * r * (1 - r)
                du = np.concatenate([dz, dr, dn * r], 1)
                g_on += state.T @ du
                g_in[t] = np.concatenate([dz, dr, dn], 1)
                back = dh * z + du @ on.T
            g[f"{d}.on"] = g_on
            g[f"{d}.in"] = np.zeros_like(p[f"{d}.in"])
            np.add.at(g[f"{d}.in"], steps.ravel(), g_in.reshape(-1, 3 * h))
        return g

    def fit(self, windows: list[bytes], target: np.ndarray, epochs: int = EPOCHS, rate: float = 0.02, seed: int = 0) -> BiGru:
        """Adam, over shuffled batches of windows."""
        rng, count = np.random.default_rng(seed), 0
        steps, inside = padded(windows)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for lo in range(0, len(order), BATCH):
                at = order[lo : lo + BATCH]
                count += 1
                for k, g in self.gradients(steps[:, at], inside[:, at], target[at]).items():
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.01 * (g * g - v[k])
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**count)) / (np.sqrt(v[k] / (1 - 0.99**count)) + 1e-8)).astype(np.float32)
        return self

    def document_probabilities(self, texts: list[bytes]) -> np.ndarray:
        """(texts, labels): means over all positions of each whole text; a
        text without bytes has zeros."""
        size = np.array([len(t) for t in texts], np.int64)
        n = -(-size // WINDOW)
        end, total = np.cumsum(n), np.zeros((len(texts), len(self.labels)))
        owner = np.repeat(np.arange(len(texts)), n)
        first = np.repeat(end - n, n)
        inside = np.minimum(WINDOW, size[owner] - (np.arange(len(owner)) - first) * WINDOW)
        flat = np.frombuffer(b"".join([t.ljust(int(k) * WINDOW, b"\0") for t, k in zip(texts, n, strict=True)]), np.uint8).reshape(-1, WINDOW)
        for lo in range(0, len(flat), _AT_ONCE):
            part = slice(lo, lo + _AT_ONCE)
            a = self.probabilities(np.ascontiguousarray(flat[part].T))
            a *= (np.arange(WINDOW)[:, None] < inside[part])[..., None]
            np.add.at(total, owner[part], a.sum(0, dtype=np.float64))
        return total / np.maximum(1, size)[:, None]


def padded(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and whether they are in the text, as (time, windows)."""
    flat = np.frombuffer(b"".join([w.ljust(WINDOW, b"\0") for w in windows]), np.uint8).reshape(-1, WINDOW)
    inside = np.arange(WINDOW)[:, None] < np.array([len(w) for w in windows])
    return np.ascontiguousarray(flat.T), inside.astype(np.float32)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 2 by 4 (a null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame) -> BiGru | None:
    """Learn from documents with a text, a doc_id and a lang that aren't held
    out: of each language those ``DOCS`` with the least hashes of their id,
    ``WINDOWS`` windows from all over each.  The driver gets that sample: at
    most ``DOCS * WINDOWS * WINDOW`` bytes a language.  None: no such documents."""
    d = pick(docs, doc_id="doc_id", text="text", lang="lang").where("doc_id is not null and text is not null and lang is not null")
    d = d.where(~held_out(F.col("doc_id")) & (F.octet_length("text") > 0)).withColumn("h", F.xxhash64("doc_id", "lang"))
    n = F.octet_length("text")
    # a place in the text for each window, from the id's hash
    at = [(F.pmod(F.xxhash64("doc_id", F.lit(k)), F.greatest(F.lit(1), n - WINDOW)) + 1).cast("int") for k in range(WINDOWS)]
    raw = F.col("text").cast("binary")
    cut = d.select(F.col("lang").cast("string").alias("lang"), "h", F.array(*[F.substring(raw, a, F.lit(WINDOW)) for a in at]).alias("windows"))
    from medallion.llm.topk import best

    rows = best(cut, ["lang"], [F.col("h"), F.col("windows")], DOCS).orderBy("lang", "h", "windows").collect()
    if not rows:
        return None
    labels = sorted({r.lang for r in rows})
    windows, target = zip(*[(bytes(w), labels.index(r.lang)) for r in rows for w in dict.fromkeys(r.windows)], strict=True)
    return BiGru(labels).fit(list(windows), np.array(target))


def labelled(docs: DataFrame, model: BiGru | None = None) -> DataFrame:
    """``docs`` with the columns lang_pred, score and has_letter added at the
    end.  Without a model that knows a label, every lang_pred is ``und``."""
    model = model or train(docs) or BiGru([])
    names = docs.columns
    at = names.index("text")
    own = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    own = own.withColumn("_text", F.coalesce(F.col(f"_c{at}").cast("string"), F.lit("")).cast("binary"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema[:-1])

    def fn(batch: pa.RecordBatch) -> dict:
        texts = batch.column("_text").to_pylist()
        lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        letter = [_LETTER.search(t.decode("utf-8", "replace")) is not None for t in texts]
        known = [i for i, has in enumerate(letter) if has]
        if known and model.labels:
            got = model.document_probabilities([texts[i] for i in known])
            for i, row in zip(known, got, strict=True):
                lang[i], score[i] = model.labels[row.argmax()], min(1.0, float(row.max()))
        return {f"_c{i}": batch.column(f"_c{i}") for i in range(len(names))} | {"lang_pred": lang, "score": score, "has_letter": letter}

    return map_batches(own, fn, f"{schema}, lang_pred string, score double, has_letter boolean").toDF(*names, "lang_pred", "score", "has_letter")


def identify(docs: DataFrame, model: BiGru | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score (the label's probability).

    Without a model one is trained on ``docs``.  A text that is null or has
    no letter, and every text if there was nothing to learn from, is ``und``
    with score 0.  Repeated rows give a row each; an empty table none.
    """
    got = labelled(pick(docs, doc_id="doc_id", text="text"), model or train(docs) or BiGru([]))
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
