"""The corpus pipeline: documents in, packed sequences out.

Each stage works on all that the one before kept and is written and read
again before the next, so that a lost executor never costs an earlier stage.
Stages that choose among documents number the rows they get, so that null and
repeated doc_ids are told apart.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import collecting, pick, read_table, release, stored, written
from medallion.llm.langid import BiGru, labelled, train
from medallion.llm.mixing import order_key, plan_mix
from medallion.llm.packing import pack
from medallion.llm.queries import tokenizer
from medallion.llm.simhash import copies
from medallion.llm.substring import remove_repeated
from medallion.sources import fs

ROW = "_row"  # the key of a row within a stage
LEAST_SCORE = 0.4  # of a document's language; mixed documents have about a half
WORD = r"[^\x20\x09-\x0D]+"
FEW = 1 << 21  # rows of one number each that are broadcast
_left: list[str] = []  # tables of the stage before

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(fn: Callable[[SparkSession, DataFrame], DataFrame]) -> Stage:
    """A stage over ``docs`` under names of its own, so that no column of the
    documents clashes with an operator's.  The tables that the stage before
    wrote for itself go, unless ``docs`` still reads them."""

    @functools.wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if fn.__name__ == STAGES[0][1].__name__:
            _left.clear()  # those of another run, whose result may be unread
        if _left:
            read = " ".join(docs.inputFiles())
            for path in [p for p in _left if p.rpartition("/")[2] not in read]:
                fs.delete(spark, path)
                _left.remove(path)
            release(spark)
        with collecting(_left):
            return fn(spark, docs)

    return run


def renamed(docs: DataFrame) -> tuple[DataFrame, str, str, str | None, list[str]]:
    """``docs`` with columns named by their places, the names of doc_id, text
    and n_chars (None: there is none) among them, and the documents' own names
    in order."""
    own = docs.columns
    lower = [c.lower() for c in own]
    at = lambda c: own.index(c) if c in own else lower.index(c) if c in lower else None
    names = [f"_c{i}" for i in range(len(own))]
    n_chars = at("n_chars")
    return docs.toDF(*names), f"_c{at('doc_id')}", f"_c{at('text')}", None if n_chars is None else f"_c{n_chars}", own


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of each row, written, so that it stays as it is."""
    return written(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


@stage
def language(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Documents without letters, or of no one language, go.  If there was
    nothing to learn languages from, only those without letters go."""
    model = train(docs)
    of_one = F.col("score") >= LEAST_SCORE if model else F.lit(True)
    own, _, text, _, names = renamed(docs)
    got = labelled(own.withColumnRenamed(text, "text"), model or BiGru([])).where(F.col("has_letter") & of_one)
    return got.withColumnRenamed("text", text).select(*own.columns).toDF(*names)


@stage
def near_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row of each group stays: the least doc_id's, null ids last.  The
    others are told by their row keys; no text is shuffled unless there are
    over ``FEW`` of them."""
    own, doc_id, text, _, names = renamed(docs)
    rows = numbered(own)
    gone = written(copies(pick(rows, doc_id=doc_id, text=text, **{ROW: ROW}), ROW), "copies")
    gone = F.broadcast(gone) if gone.count() <= FEW else gone
    return rows.join(gone, ROW, "left_anti").select(*own.columns).toDF(*names)


@stage
def repeated_passages(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Repeated passages are cut out; other documents stay as they are."""
    own, doc_id, text, n_chars, names = renamed(docs)
    kept = [c for c in own.columns if c not in (doc_id, text)]
    given = own.withColumnRenamed(doc_id, "doc_id").withColumnRenamed(text, "text").withColumn("_id", F.col("doc_id")).withColumn("_null", F.col("text").isNull())
    got = remove_repeated(given, carry=(*kept, "_id", "_null"), as_is=True)
    got = got.withColumn(text, F.when(~F.col("_null"), F.col("kept"))).withColumnRenamed("_id", doc_id)
    if n_chars:
        changed = F.length(text).cast(dict(own.dtypes)[n_chars])
        got = got.withColumn(n_chars, F.when(F.col("n_removed") > 0, changed).otherwise(F.col(n_chars)))
    return got.select(*own.columns).toDF(*names)


@stage
def mixing(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """A row for each use of a row by the mix; unused and empty rows go.  The
    mix is a rule on a row's source and order key, so no text is shuffled."""
    own, doc_id, text, _, names = renamed(docs)
    source = own.columns[[c.lower() for c in names].index("source")]
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    rows = numbered(own.withColumn("_size", size))
    rows = rows.withColumn("sources", F.array(F.col(source).cast("string"))).withColumn("key", order_key(0, ROW, F.col(doc_id), F.col("_size")))
    plan = plan_mix(rows.select(F.col(ROW).alias("row"), F.col("_size").alias("size"), "sources", "key"))
    got = plan.uses(rows, ROW).where("uses > 0 and _size > 0")
    return got.withColumn("_use", F.explode(F.sequence(F.lit(1).cast("long"), F.col("uses")))).select(*own.columns).toDF(*names)


@stage
def packing(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Null texts are one piece, the end; extra columns are left out."""
    return pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_copies),
    ("substring dedup", repeated_passages),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage but the last is written; a stage's input goes when its
    output has been written."""
    docs, held = read_table(spark, sf_dir, "documents"), None
    for k, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs, path = stored(docs, "stage-" + name.lower().replace(" ", "-"))
            if held:
                fs.delete(spark, held)
            held = path
    return docs
