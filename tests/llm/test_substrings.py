"""Word-window duplicates against brute force."""

import random
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from tripflow.llm.anchors import blocked, window_anchors
from tripflow.llm.substrings import remove_repeats

SCHEMA = "doc_id bigint, text string, block int, key string, n_words int"


def test_anchor_is_the_rightmost_least_of_each_window():
    rng = np.random.default_rng(0)
    for width in (1, 2, 3, 9, 16, 201):
        h = rng.integers(0, 6, 700).astype(np.uint64)
        at = window_anchors(h, width)
        assert len(at) == 700 - width + 1
        for i, k in enumerate(at):
            part = h[i : i + width]
            assert k == i + width - 1 - part[::-1].argmin()
    assert len(window_anchors(np.zeros(3, np.uint64), 4)) == 0


def brute(rows, w):
    words = [(k, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in rows]
    first: dict = {}
    order = lambda k: float("inf") if k is None else k
    for k, x in words:
        for i in range(len(x) - w + 1):
            key = tuple(x[i : i + w])
            first[key] = min(first.get(key, float("inf")), order(k))
    out = []
    for k, x in words:
        gone = [False] * len(x)
        for i in range(len(x) - w + 1):
            if first[tuple(x[i : i + w])] < order(k):
                gone[i : i + w] = [True] * w
        out.append((order(k), len(x), sum(gone), " ".join(y for y, g in zip(x, gone) if not g)))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    passages = [" ".join(rng.choice("abcdefghij") for _ in range(rng.randint(10, 40))) for _ in range(8)]
    out = []
    for k in range(220):
        text = rng.choice([" ", "\n", "\t "]).join(rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choice("klmnopq") + str(rng.randint(0, 9)) for _ in range(rng.randint(0, 20))) for _ in range(rng.randint(0, 5)))
        out.append((k if rng.random() < 0.95 else k - 1, text))
    return out + [(500, None), (501, ""), (502, "one two"), (None, passages[0]), (None, "unseen words " * 10), (503, " ".join(f"u{i}" for i in range(50_000))), (504, " ".join(f"u{i}" for i in range(30_000, 40_000))), (-5, passages[1])]


def test_documents_brute_force(spark, rows):
    df = spark.createDataFrame([(*r, 0, "x", 1) for r in rows], SCHEMA)
    found = remove_repeats(df).collect()
    got = sorted((float("inf") if r.doc_id is None else r.doc_id, r.n_words, sum(s.stop - s.start for s in r.spans), r.kept) for r in found)
    assert got == brute(rows, 13)


def test_other_window(spark, rows):
    df = spark.createDataFrame([(*r, 0, "x", 1) for r in rows[:120]], SCHEMA)
    got = sorted((r.doc_id, r.n_words, sum(s.stop - s.start for s in r.spans), r.kept) for r in remove_repeats(df, 6, 6).collect())
    assert got == brute(rows[:120], 6)


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rows_with_null_or_equal_ids_spread_over_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr("tripflow.llm.anchors.BLOCK_BYTES", 1000)
    hot = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, t) for k, (_, t) in enumerate(rows[:220])]
    df = spark.createDataFrame([(*r, 0, "x", 1) for r in hot], SCHEMA)
    blocks = {r.doc_id: r.n for r in blocked(df)[0].groupBy("doc_id").agg(F.countDistinct("block").alias("n")).collect()}
    assert blocks[None] > 10 and blocks[7] > 10
    found = remove_repeats(df).collect()
    got = sorted((float("inf") if r.doc_id is None else r.doc_id, r.n_words, sum(s.stop - s.start for s in r.spans), r.kept) for r in found)
    assert got == brute(hot, 13)
