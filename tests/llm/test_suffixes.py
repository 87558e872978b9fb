"""Exact substring duplicates: suffix arrays and whole documents against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from tripflow.llm.suffixes import common_prefixes, least_grams, remove_repeated_bytes, repeated_windows, suffix_array

SCHEMA = "doc_id bigint, text string, block int, f string, kept int"


def test_suffix_array_and_prefixes():
    rng = random.Random(1)
    for _ in range(40):
        data = bytes(rng.choice(b"abc" if rng.random() < 0.2 else b"a") for _ in range(rng.randint(1, 150)))
        order, rank, depth = suffix_array(np.frombuffer(data, np.uint8), 1000)
        end = b"\xff"  # pads behind the end, as in the array
        assert [data[k:] + end * 200 for k in order] == sorted(data[k:] + end * 200 for k in range(len(data)))
        got = common_prefixes(np.frombuffer(data, np.uint8), order, rank, np.array([0]), np.array([len(data)]), 10_000)
        for x, y in zip(order, order[1:]):
            n = 0
            while max(x, y) + n < len(data) and data[x + n] == data[y + n]:
                n += 1
            assert got[y] >= n and got[y] - n <= 8  # the padding may count up to the last word


def test_anchor_is_the_rightmost_least_of_each_window(monkeypatch):
    monkeypatch.setattr("tripflow.llm.suffixes.STEP", 100)
    rng = np.random.default_rng(0)
    for width in (1, 2, 3, 9, 16, 201):
        h = rng.integers(0, 6, 700).astype(np.uint64) << np.uint64(40)
        at = least_grams(h, width)
        assert at.tolist() == [i + width - 1 - int(h[i : i + width][::-1].argmin()) for i in range(700 - width + 1)]
    assert len(least_grams(np.zeros(3, np.uint64), 4)) == 0


def test_repeated_windows_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        w = rng.choice([8, 9, 12, 20])
        segments = [bytes(rng.choice(b"ab") if rng.random() < 0.1 else 97 for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(1, 8))]
        times = Counter(s[i : i + w] for s in segments for i in range(len(s) - w + 1))
        repeated, first = repeated_windows(segments, w)
        for s, r in zip(segments, repeated):
            assert [times[s[i : i + w]] > 1 for i in range(len(s) - w + 1)] == r.tolist()
        assert sum(f.sum() for f in first) == len(times)


def brute(docs, w):
    times = Counter(t[i : i + w] for t in docs for i in range(len(t) - w + 1))
    out = []
    for t in docs:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - w + 1):
            if times[t[i : i + w]] > 1:
                gone[i : i + w] = True
        out.append((len(t), int(np.diff(np.append(False, gone).astype(int)).clip(0).sum()), np.frombuffer(t, np.uint8)[~gone].tobytes()))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    base = [rng.randbytes(60).hex()[:90] for _ in range(6)]
    out = ["".join(rng.choice(base)[rng.randint(0, 20) : rng.randint(40, 90)] + rng.choice(["", "é", rng.randbytes(8).hex()])
                   for _ in range(rng.randint(0, 4))) for _ in range(200)]
    # one passage that ends differently in every document, copies, periods
    out += [f"{base[0]}{k:05d}" for k in range(60)] + [out[5]] * 40 + ["ab" * 40, "ab" * 33, "z" * 30, "", base[1] + base[1]]
    return out


@pytest.mark.parametrize(("shard_bytes", "shard_segments"), [(500, 4096), (500, 3), (1 << 20, 4096)])
def test_documents_brute_force(spark, texts, shard_bytes, shard_segments):
    df = spark.createDataFrame([(k, t, 0, "x", 1) for k, t in enumerate(texts)], SCHEMA)
    found = remove_repeated_bytes(df, 24, 12, shard_bytes=shard_bytes, shard_segments=shard_segments).collect()
    got = {r.doc_id: (r.n_bytes, len(r.spans), bytes(r.kept)) for r in found}
    want = brute([t.encode() for t in texts], 24)
    assert got == dict(enumerate(want))


def test_edges(spark):
    long = "".join(random.Random(2).choices("abcdefgh ", k=300_000))
    rows = [(1, None), (2, ""), (3, "x" * 399), (4, "x" * 400), (5, long), (6, "q" + long[1000:1400] + "q"), (7, "y" * 401), (7, None), (None, "k" * 10), (8, "p" * 50 + long[5000:5600]), (8, "p" * 50 + long[5000:5600])]
    df = spark.createDataFrame([(*r, 0, "x", 1) for r in rows], SCHEMA)
    got = sorted(((r.doc_id or 0), r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans)) for r in remove_repeated_bytes(df).collect())
    assert got == [(0, 10, 0, 0), (1, 0, 0, 0), (2, 0, 0, 0), (3, 399, 0, 0), (4, 400, 0, 0), (5, 300_000, 1000, 2), (6, 402, 400, 1),
                   (7, 0, 0, 0), (7, 401, 401, 1), (8, 650, 650, 1), (8, 650, 650, 1)]
    assert remove_repeated_bytes(df.where("1 = 0")).count() == 0


def test_rows_with_null_or_equal_ids(spark, texts, monkeypatch):
    monkeypatch.setattr("tripflow.llm.anchors.BLOCK_BYTES", 1000)
    ids = [None if k % 3 == 0 else 7 if k % 3 == 1 else k for k in range(len(texts))]
    df = spark.createDataFrame([(k, t, 0, "x", 1) for k, t in zip(ids, texts)], SCHEMA)
    got = sorted(((r.doc_id or 0), r.n_bytes, len(r.spans), bytes(r.kept)) for r in remove_repeated_bytes(df, 24, 12, 500, 3).collect())
    assert got == sorted(((k or 0), *w) for k, w in zip(ids, brute([t.encode() for t in texts], 24)))
