import pytest

from cuefold.operators.skew import hot_join


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_hot_keys_join_as_others_do(spark, how):
    left = spark.createDataFrame([(1 if i % 3 == 0 else i % 50, i, None if i % 7 == 0 else "x") for i in range(900)] + [(None, 1000, "n")], "k int, id int, v string")
    right = spark.createDataFrame([(i, f"r{i}-{j}") for i in range(0, 40) for j in range(2)] + [(None, "n")], "k int, w string")
    want = sorted(map(str, left.join(right, ["k"], how).collect()))
    got = hot_join(left, right, ["k"], ["id"], how, least=20, buckets=16)
    assert got.columns == left.join(right, ["k"], how).columns
    assert sorted(map(str, got.collect())) == want
    assert sorted(map(str, hot_join(left, right, ["k"], ["id"], how, least=20, tasks=3, buckets=16).collect())) == want
    assert hot_join(left.limit(0), right, ["k"], ["id"], how).count() == 0
