"""Token counts and ids of whole texts, with each distinct unit encoded once.

A text's tokens never cross certain places (blanks and line ends for the
sentencepiece model, ASCII white space for the word model).  Texts are cut
there into units, a unit is encoded by the tokenizer's own library the first
time a task meets it, and a bounded table in the Python worker answers its repeats.
"""

from __future__ import annotations

import json
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import documents, map_batches, reused

TABLE_BYTES = 64 << 20  # of a generation of a worker's table of units
_ENTRY = 200  # bytes that an entry takes besides its text


class Table(dict):
    """A bounded table of ``make(key)``, in two generations: when the newer is
    full it becomes the older, from which entries in use are taken over."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old, self.size = make, {}, 0

    def put(self, key, value, size: int):
        if self.size > TABLE_BYTES:
            self.old = {**self}
            self.clear()
            self.size = 0
        self[key] = value
        self.size += size + _ENTRY
        return value

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        return self.put(key, value, len(key) + len(value))

_BLANK = "▁"  # the sentencepiece mark for a blank; in a text it means the same
_UNITS = re.compile(r" +[^ \n]*|\n[^ \n]*")


class PieceCounts:
    """Piece counts of texts under a sentencepiece BPE model.

    No piece of the vocabulary holds a blank after another character, or a
    line end inside a longer piece, so merges never cross the start of a run
    of blanks or a line end and the counts of the units add up.  Checked on
    the vocabulary; with another kind of model whole texts are encoded.
    """

    def __init__(self, model_path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        self.units = (
            not any(re.search(f"[^{_BLANK}]{_BLANK}|\n", p) for p in pieces)
            and self._n("a  b") > self._n("a b")  # blanks are kept
            and self.sp.encode("a", out_type=str)[0].startswith(_BLANK)  # a blank is put before the text
        )
        self.table = Table(None)

    def _n(self, text: str) -> int:
        return len(self.sp.encode(text))

    def _learn(self, units: list[str]) -> None:
        # a unit starts with a blank, which the model puts there itself, or
        # with a line end, before which the model puts a blank of one piece
        ids = self.sp.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        for u, i in zip(units, ids, strict=True):
            self.table.put(u, 1 if u == " " else len(i) - (u[0] == "\n"), len(u))

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.units:
            return self._n(text)
        if _BLANK in text:
            text = text.replace(_BLANK, " ")
        frequency = Counter(_UNITS.findall(f" {text}"))
        table = self.table
        if new := [u for u in frequency if u not in table and u not in table.old]:
            self._learn(new)
        old = table.old
        return sum([(table.get(u) or old.get(u) or self._unit(u)) * n for u, n in frequency.items()])

    def _unit(self, unit: str) -> int:
        """A unit of a text with more units than the table holds."""
        self._learn([unit])
        return self.table[unit]


@reused
def piece_counts(path: str) -> PieceCounts:
    """One per Python worker: its later tasks find the model and the table."""
    return PieceCounts(path)


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``) per row.

    Method: pre-token frequencies per document, pieces counted once per
    distinct pre-token, joined in the task and summed; no ids of a document
    are made.  The join's inner side is the worker's bounded table, so there
    is no shuffle.  Null text: 0 bytes, 0 tokens.  Repeated rows give a row
    each; a null doc_id stays null; an empty table gives no rows.
    """

    def fn(batch: pa.RecordBatch, counts: PieceCounts) -> dict:
        texts = batch.column(1).to_pylist()
        return {
            "doc_id": batch.column(0),
            "n_bytes": [len(t) for t in texts],
            "n_tokens": [counts.count(t.decode("utf-8", "replace")) for t in texts],
        }

    out = map_batches(documents(docs), fn, "doc_id long, n_bytes long, n_tokens long", lambda: piece_counts(model_path))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


# The pre-tokenizer pattern of the word model: a fixed value.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordIds:
    """Ids of texts under the word BPE model, as little-endian unsigned bytes.

    The model drops white space, so a text's ids are those of its words.
    Words of printable characters below U+0300 (which normalise to their
    lower case alone) are cut by the model's own pattern and their parts
    merged by the library's model; every other word, and one that holds a
    special token, goes through the whole library.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.dtype = id_type(self.tok)
        kinds = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        added = spec.get("added_tokens", [])
        self.words = (
            kinds == ["NFC", "Replace", "Lowercase"]
            and split.get("pattern", {}).get("Regex") == _WORD_PATTERN
            and not any(a["single_word"] or a["normalized"] or re.search(r"\s", a["content"]) for a in added)
        )
        self.special = re.compile("|".join(re.escape(a["content"]) for a in added) or r"(?!)").search
        self.find = regex.compile(_WORD_PATTERN).findall
        self.model = self.tok.model
        # byte-level models write a byte as a printable character: printable
        # bytes as themselves, the others in order from U+0100
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        other = [b for b in range(256) if b not in plain]
        self.chars = [chr(b) if b in plain else chr(256 + other.index(b)) for b in range(256)]
        self.table, self.parts = Table(self._word), Table(self._part)

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _part(self, p: str) -> bytes:
        chars = p if p.isascii() else "".join([self.chars[b] for b in p.encode()])
        return self._bytes([t.id for t in self.model.tokenize(chars)])

    def _word(self, word: bytes) -> bytes:
        s = word.decode("utf-8", "replace")
        if word.isalpha():  # ASCII letters: one part
            return self.parts[s.lower()]
        if s.isprintable() and (s.isascii() or (max(s) < "\u0300" and "\u0130" not in s)) and not self.special(s):
            return b"".join([self.parts[p] for p in self.find(s.lower())])
        return self._bytes(self.tok.encode(s, add_special_tokens=False).ids)

    def ids(self, text: bytes) -> bytes:
        if not self.words:
            return self._bytes(self.tok.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids)
        return b"".join(map(self.table.__getitem__, text.split()))  # bytes split at ASCII white space only


@reused
def word_ids(path: str) -> WordIds:
    """One per Python worker, as ``piece_counts``."""
    return WordIds(path)


def id_type(tok) -> np.dtype:
    """The smallest of uint16 and uint32 that holds every id."""
    return np.dtype("<u2" if tok.get_vocab_size() <= 1 << 16 else "<u4")
