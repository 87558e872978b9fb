"""Embedding near duplicates: links and components equal to brute force, for one tree and for many chunks."""

import numpy as np
import pytest

from tripflow.llm.embeddings import CoverTree, dual, near_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int, cell int, n string"


def vectors(seed, n, dim):
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=dim)]
    while len(out) < n:
        kind = rng.integers(0, 3)
        base = out[int(rng.integers(len(out)))]
        out.append(rng.normal(size=dim) if kind == 0 else base * 2 if kind == 1 and rng.random() < 0.3 else base + rng.normal(size=dim) * rng.choice([0.05, 0.2, 0.3]))
    return np.array(out, np.float32)


def brute(rows, cosine=0.93):
    ids = [r[0] for r in rows]
    links, root = {k: 0 for k in ids}, {k: k for k in ids}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, (a, x, la, *_) in enumerate(rows):
        for b, y, lb, *_ in rows[i + 1 :]:
            if la is None or la != lb or x is None or y is None or len(x) != len(y) or None in x or None in y:
                continue
            x_, y_ = np.array(x, np.float32).astype(float), np.array(y, np.float32).astype(float)
            if not (np.isfinite(x_).all() and np.isfinite(y_).all() and x_.any() and y_.any()):
                continue
            if x_ @ y_ / (np.linalg.norm(x_) * np.linalg.norm(y_)) >= cosine:
                links[a] += 1
                links[b] += 1
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {k: (links[k], find(k), find(k) == k) for k in ids}


def test_tree_covers_and_nests():
    x = vectors(1, 400, 6).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    tree = CoverTree(x)
    for centre, radius, members, children in tree.nodes:
        assert np.linalg.norm(x[members] - x[centre], axis=1).max() <= radius + 1e-6
        if len(children):
            assert sorted(np.concatenate([tree.nodes[c][2] for c in children])) == sorted(members)
            assert max(tree.nodes[c][1] for c in children) <= radius / 2 + 1e-6


def test_dual_traversal_covers_all_pairs_within_reach():
    x, y = (vectors(s, 300, 4).astype(float) for s in (2, 2))
    x, y = x / np.linalg.norm(x, axis=1)[:, None], y[::-1] / np.linalg.norm(y[::-1], axis=1)[:, None]
    seen = set()
    for whole, i, j in dual(CoverTree(x), CoverTree(y), 0.3):
        pairs = [(a, b) for a in i for b in j] if whole else list(zip(i, j))
        assert not seen & set(pairs)
        seen |= set(pairs)
        if whole:
            assert all(np.linalg.norm(x[a] - y[b]) <= 0.3 for a, b in pairs)
    assert {(a, b) for a, b in zip(*np.nonzero(np.linalg.norm(x[:, None] - y[None], axis=2) <= 0.3))} <= seen


@pytest.mark.parametrize("chunk", [4000, 25])
def test_links_brute_force(spark, chunk):
    v = vectors(7, 260, 5)
    rng = np.random.default_rng(8)
    rows = [(int(10 + 3 * i), [float(c) for c in x], int(rng.integers(0, 2)), 0, "x") for i, x in enumerate(v)]
    rows += [(9000 + k, rows[4][1], rows[4][2], 0, "x") for k in range(30)]  # equal vectors
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(spark.createDataFrame(rows, SCHEMA), chunk=chunk).collect()}
    assert got == brute(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [0.0, 0.0], 0), (3, [1.0, nan], 0), (4, [1.0, inf], 0), (5, [1.0, None], 0), (6, [1.0, 1.0], None), (7, [1.0, 1.0], 0),
            (8, [2.0, 2.0], 0), (9, [1.0, 1.0, 0.0], 0), (10, [], 0), (11, [1.0, 1.0], 1), (12, [-1.0, -1.0], 0), (0, [1.0, 0.99], 0)]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect()}
    assert got == brute(rows)
    assert got[7] == (2, 0, False) and got[0] == (2, 0, True)
    assert near_vectors(df.where("1 = 0")).count() == 0
    assert near_vectors(spark.createDataFrame([(None, [1.0], 1, 0, "x")], SCHEMA)).collect()[0].component_id is None
