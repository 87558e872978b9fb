"""Toxicity: features against plain Python, the update against a written-out one, and held-out accuracy."""

import math
import random
import re
import zlib

import numpy as np

from tripflow.llm import toxicity
from tripflow.llm.hashing import Substrings, mix
from tripflow.llm.toxicity import BITS, Weights, fit, ftrl, grams, op12_toxicity, sample, score

SF = "/root/testdata/sf0.1"


def plain_features(text):
    words = re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[ -⁯¡«»¿]", " ", (text or "").lower()))

    def h(w):
        raw = np.frombuffer(w.encode(), np.uint8)
        return Substrings(raw)(np.array([0]), np.array([len(raw)]))

    hashes = [h(w) for w in words]
    found = list(hashes)
    for k in (1, 2, 3):
        found += [mix(mix(a + np.uint64(k)) ^ b) for a, b in zip(hashes, hashes[k:])]
    return {int(mix(x)[0] >> np.uint64(64 - BITS)) for x in found}


def test_features():
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["a", "B", "é—x", "it's", "12", ",", "«q»"]) for _ in range(rng.randint(0, 30))) for _ in range(40)] + [None, "", "x" * 5000, " .\n"]
    for piece in (16, 200, 1 << 20):
        got = {}
        for own, feature in grams(texts, piece):
            for o, f in zip(own.tolist(), feature.tolist()):
                got.setdefault(o, set()).add(f)
        assert all(got.get(i, set()) == plain_features(t) for i, t in enumerate(texts))


def test_update_is_ftrl_proximal():
    rng = random.Random(2)
    rows = [(np.array(sorted(rng.sample(range(12), 4))), rng.randint(0, 1)) for _ in range(60)]
    z, n, alpha, beta, l1, l2 = {}, {}, 0.3, 1.0, 0.4, 0.2

    def weight(f):
        pen, ridge = (0, 0) if f == "bias" else (l1, l2)
        zi = z.get(f, 0.0)
        if abs(zi) <= pen:
            return 0.0
        return -(zi - math.copysign(pen, zi)) / ((beta + math.sqrt(n.get(f, 0.0))) / alpha + ridge)

    for _ in range(3):
        for features, label in rows:
            on = [*features.tolist(), "bias"]
            w = {f: weight(f) for f in on}
            g = 1 / (1 + math.exp(-sum(w.values()))) - label
            for f in on:
                sigma = (math.sqrt(n.get(f, 0) + g * g) - math.sqrt(n.get(f, 0))) / alpha
                z[f] = z.get(f, 0) + g - sigma * w[f]
                n[f] = n.get(f, 0) + g * g
    got = ftrl(rows, alpha, beta, l1, l2, epochs=3)
    assert math.isclose(got.bias, weight("bias"), abs_tol=1e-9)
    assert dict(zip(got.features.tolist(), got.values.tolist())).keys() == {f for f in range(12) if weight(f)}
    assert all(math.isclose(v, weight(f), abs_tol=1e-9) for f, v in zip(got.features.tolist(), got.values.tolist()))


def test_scores_sum_each_feature_once():
    f = next(iter(plain_features("bad")))
    weights = Weights(np.array([f]), np.array([2.0]), -1.0)
    got = weights.scores(["bad bad BAD", "good", None, ""])
    want = [1 / (1 + math.exp(-x)) for x in (1.0, -1.0, -1.0, -1.0)]
    assert np.allclose(got, want)


def test_held_out_documents(spark):
    """The labels of the given table, seen only where they may be."""
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op12_toxicity(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    kept = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [s for s, _, y in kept if y], [s for s, _, y in kept if not y]
    auc = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert auc > 0.97
    assert sum(p for _, p, y in kept if not y) <= 0.01 * len(clean)
    assert sum(p for _, p, y in kept if y) >= 0.75 * len(toxic)


DOCS, LABELS = "doc_id bigint, text string, toxic string, place int", "doc_id bigint, toxic int, text string"


def test_sample_bounds_and_hot_ids(spark, monkeypatch):
    docs = [(i, f"text number {i}", "x", 1) for i in range(200)] + [(1, "other text", "x", 1)] * 300 + [(None, "t", "x", 1), (5, None, "x", 1)]
    labels = [(i % 220, i % 2, "y") for i in range(440)] + [(None, 1, "y"), (3, None, "y")]
    d, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    allowed = {i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2}
    got = sample(d, lab).collect()
    assert {r.doc_id for r in got} == allowed and len(got) == len(allowed)
    assert all(r.toxic == r.doc_id % 2 for r in got)
    assert len(sample(d, lab, rows=10).collect()) == 10
    few = sample(d, lab, chars=100).collect()
    assert 100 <= sum(len(r.text) for r in few) < 130
    # the order of the rows does not matter
    again = sample(d.orderBy("text"), lab.orderBy("toxic"), rows=10).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, sample(d, lab, rows=10).collect()))


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    weights = fit(docs, labels)
    assert score(docs, weights).count() == 0
    one = spark.createDataFrame([(1, None, "", 1), (None, "word " * 400_000, "", 1)], DOCS)
    assert [r.score for r in score(one, weights).collect()] == [0.0, 0.0]
