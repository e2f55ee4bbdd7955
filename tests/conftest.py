from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from medallion.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="medallion-tests",
                      extra={"spark.sql.shuffle.partitions": "8",
                             "spark.default.parallelism": "4"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


def rows(df, *cols):
    """Sorted list of tuples of ``cols`` (all columns by default)."""
    cols = cols or tuple(df.columns)
    from medallion.functions import col_of

    picked = df.select(*[col_of(c) for c in cols]).collect()
    return sorted((tuple(r) for r in picked), key=null_last)


def null_last(t):
    return tuple((0, v) if v is not None else (1, 0) for v in t)
