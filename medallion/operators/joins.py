"""Semi and anti joins with explicit conditions.

No side is broadcast here: AQE turns a join into a broadcast join where the
measured size of a side is below its threshold.

Conditions are built column-by-column (not ``on=[names]``) so the left
side's column order is kept, names with dots work, and the caller chooses
between plain and null-safe equality.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.functions.exprs import col_of

def _pairs(left_keys: Sequence[str], right_keys: Sequence[str] | None) -> list[tuple[str, str]]:
    right_keys = list(right_keys) if right_keys is not None else list(left_keys)
    if len(right_keys) != len(left_keys):
        raise ValueError("left and right key lists differ in length")
    return list(zip(left_keys, right_keys))


def _keyed_right(right: DataFrame, pairs: list[tuple[str, str]], tag: str,
                 dedup: bool) -> tuple[DataFrame, list[str]]:
    """The right side's join keys, optionally de-duplicated.

    ``dedup``: a partial + final aggregate, so repeated keys (every
    measurement row of a parameter) collapse map-side before the shuffle;
    its hash partitioning already satisfies the join, so no exchange is
    added.  The trade-off: with an aggregate between the join and the
    shuffle, AQE cannot split a skewed join partition, so use it where the
    right side repeats keys heavily (its distinct keys are then small and
    AQE broadcasts them from the measured size) and not where the keys are
    already unique and the left side may hold a hot key.
    """
    names = [f"__{tag}_k{i}" for i in range(len(pairs))]
    keyed = right.select(*[col_of(r).alias(n) for (_, r), n in zip(pairs, names)])
    return (keyed.distinct() if dedup else keyed), names


def _condition(left: DataFrame, pairs, names, null_safe: bool) -> Column:
    cond = None
    for (lk, _), n in zip(pairs, names):
        lc = left[_q(lk)]
        term = lc.eqNullSafe(F.col(n)) if null_safe else lc == F.col(n)
        cond = term if cond is None else cond & term
    return cond


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`" if "." in name else name


def semi_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
              right_keys: Sequence[str] | None = None, *, null_safe: bool = False,
              dedup: bool = True) -> DataFrame:
    """Rows of ``left`` whose key appears in ``right`` (``IN`` / ``EXISTS``).

    Only the key columns of ``right`` are read, by default de-duplicated
    map-side (see ``_keyed_right`` for when to turn that off).
    """
    pairs = _pairs(left_keys, right_keys)
    keyed, names = _keyed_right(right, pairs, "semi", dedup)
    return left.join(keyed, _condition(left, pairs, names, null_safe), "left_semi")


def anti_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
              right_keys: Sequence[str] | None = None, *, null_safe: bool = False,
              dedup: bool = True) -> DataFrame:
    """Rows of ``left`` whose key does not appear in ``right``."""
    pairs = _pairs(left_keys, right_keys)
    keyed, names = _keyed_right(right, pairs, "anti", dedup)
    return left.join(keyed, _condition(left, pairs, names, null_safe), "left_anti")
