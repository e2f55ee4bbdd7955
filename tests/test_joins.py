from medallion.operators.joins import anti_join, semi_join
from tests.conftest import rows


def test_semi_and_anti_keep_left_columns(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    right = spark.createDataFrame([(1,), (1,), (None,)], "id long")
    s = semi_join(left, right, ["k"], ["id"])
    assert s.columns == ["k", "v"] and rows(s) == [(1, "a")]
    a = anti_join(left, right, ["k"], ["id"])
    assert rows(a, "v") == [("b",), ("c",)]
    assert rows(semi_join(left, right, ["k"], ["id"], null_safe=True), "v") == [("a",), ("c",)]
