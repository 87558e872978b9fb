"""Mixing: exponents, budgets, block permutations, edge cases."""

import math
from collections import Counter

import pytest

from tripflow.llm.mixing import bisect_exponent, mix

SCHEMA = "doc_id bigint, text string, lang string, source string, block int, epoch string"


def corpus(spark, sizes):
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((i, "w " * 10, None, source, 0, "clash"))
            i += 1
    return spark.createDataFrame(rows, SCHEMA)


def weights(sizes, a):
    z = sum((n / sum(sizes.values())) ** a for n in sizes.values())
    return {s: (n / sum(sizes.values())) ** a / z for s, n in sizes.items()}


def test_repetition_limit(spark):
    sizes = {"a": 4000, "b": 1000, "c": 500, "d": 500}
    used = mix(corpus(spark, sizes), max_repeat=2.0, block_tokens=500).toPandas()
    a = 1 - math.log(2) / math.log(8)
    want = weights(sizes, a)
    budget = 40_000 / want["a"]
    for s, n in sizes.items():
        got = used[used.source == s]
        assert abs(len(got) * 10 - budget * want[s]) <= 300, s  # half a block
        assert got.weight.iloc[0] == pytest.approx(want[s], abs=1e-4)
        times = Counter(got.doc_id)
        assert len(times) == n and max(times.values()) <= 2  # all are used, none more than twice
    # any stretch of the mix has the sources in their weights
    middle = used.sort_values("place").iloc[2000:4000]
    for s in sizes:
        assert abs((middle.source == s).mean() - want[s]) < 0.06


def test_each_epoch_permutes_the_blocks(spark):
    used = mix(corpus(spark, {"a": 3000, "b": 1000}), max_repeat=3.0, block_tokens=500).toPandas()
    b = used[used.source == "b"]
    orders = [b[b.epoch == e].groupby("block").place.min().sort_values().index.tolist() for e in sorted(b.epoch.unique())]
    assert len(orders) == 3 and orders[0] != orders[1] and sorted(orders[0]) == sorted(orders[1])


def test_entropy_target_and_budget(spark):
    sizes = {"a": 800, "b": 100, "c": 100}
    total = spark.createDataFrame([(s, n * 10, 10_000) for s, n in sizes.items()], "source string, n bigint, total bigint")
    a = bisect_exponent(total, entropy=1.0)
    h = lambda x: -sum(w * math.log(w) for w in weights(sizes, x).values())
    assert h(a) >= 1.0 > h(a + 2e-6)
    assert bisect_exponent(total, entropy=9.0) == 0.0  # beyond equal weights
    assert bisect_exponent(total, max_repeat=1.0) == pytest.approx(1.0, abs=1e-5)
    used = mix(corpus(spark, sizes), entropy=1.0, budget=5_000, block_tokens=100).toPandas()
    assert abs(used.tokens.sum() - 5_000) <= 300


@pytest.mark.parametrize("hot_id", [None, 7])
def test_null_and_repeated_ids_meet_their_weight(spark, hot_id):
    """A source whose rows have one id, or none, is dealt into blocks as any other."""
    rows = [(hot_id, f"h{i} " + "w " * 9, None, "b", 0, "clash") for i in range(300)]
    rows += [(1_000 + i, "w " * 10, None, "a", 0, "clash") for i in range(900)]
    used = mix(spark.createDataFrame(rows, SCHEMA), max_repeat=1.4, block_tokens=50).toPandas()
    want = weights({"a": 900, "b": 300}, 1 - math.log(1.4) / math.log(3))
    assert abs((used.source == "b").mean() - want["b"]) < 0.01
    b = used[(used.source == "b") & (used.epoch == 0)]
    assert len(b) == 300 and b.place.nunique() == 300


def test_equal_rows_stay_together(spark):
    rows = [(None, "the same text", None, "a", 0, "x")] * 50 + [(i, f"text {i} here", None, "a", 0, "x") for i in range(50)]
    used = mix(spark.createDataFrame(rows, SCHEMA), max_repeat=1.0).toPandas()
    assert len(used) == 100 and used[used.doc_id.isna()].place.nunique() == 1


def test_edges(spark):
    rows = [(1, None, "en", None), (2, "", "en", None), (3, "a b", None, "s"), (3, "a b", None, "s"), (4, "w " * 50_000, None, "t"), (None, "x", None, "s")]
    used = mix(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string"), max_repeat=1.0).toPandas()
    assert len(used) == 6 and set(used.epoch) == {0}  # blank source once, outside the weights
    assert used[used.source.isna()].weight.tolist() == [0, 0]
    assert mix(spark.createDataFrame([], "doc_id bigint, text string, lang string, source string")).count() == 0
    blank = spark.createDataFrame([(1, "", None, "s")], "doc_id bigint, text string, lang string, source string")
    assert mix(blank).count() == 1
