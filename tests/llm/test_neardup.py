"""Near duplicates: unbiased signatures, components equal to brute force, edge cases."""

import re
from collections import Counter

import numpy as np

from tripflow.llm.components import connected_components
from tripflow.llm.hashing import mix, word_hashes
from tripflow.llm.neardup import bag_minhash, near_duplicates, shingles

SCHEMA = "doc_id bigint, text string, n int, band string, digest string"


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    a = {i: int(w) for i, w in enumerate(rng.integers(0, 20, 200))}
    b = {i: max(0, w + int(rng.integers(-6, 7))) for i, w in a.items()}
    true = sum(min(a[k], b[k]) for k in a) / sum(max(a[k], b[k]) for k in a)
    share = []
    for seed in range(60):
        bags = [np.repeat(mix(np.array(sorted(x), np.uint64) + np.uint64(seed << 32)), [x[k] for k in sorted(x)]) for x in (a, b)]
        s = bag_minhash(np.concatenate(bags), np.repeat([0, 1], [len(x) for x in bags]), 2, 128)
        share.append((s[0] == s[1]).mean())
    assert abs(np.mean(share) - true) < 4 * (true * (1 - true) / 128 / 60) ** 0.5 + 1e-3


def test_word_and_shingle_hashes():
    texts = [b"a b", b"", b" a  b\tc\n", "é x".encode(), b"a b c d e a b c d e"]
    h, n = word_hashes(texts)
    words = [re.findall(rb"[^\x20\x09-\x0D]+", t) for t in texts]
    flat = [w for x in words for w in x]
    assert n.tolist() == [len(x) for x in words]
    assert len(set(zip(flat, h.tolist()))) == len(set(flat)) == len(set(h.tolist()))
    s, own = shingles(texts)
    assert sorted(Counter(own.tolist()).items()) == [(0, 1), (2, 1), (3, 1), (4, 6)]
    assert len(set(s[own == 4].tolist())) == 5  # a b c d e comes twice


def bag(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def classes(docs, threshold=0.8):
    bags, root = {k: bag(t) for k, t in docs.items()}, {k: k for k in docs}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    ids = sorted(docs)
    for i, x in enumerate(ids):
        for y in ids[i + 1 :]:
            both = sum((bags[x] & bags[y]).values())
            if both and both >= threshold * (sum(bags[x].values()) + sum(bags[y].values()) - both):
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {k: find(k) for k in docs}


def corpus(seed, n):
    """Texts, copies, edited copies in chains, repeated passages."""
    rng = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(400)]
    texts: list[str] = []
    for _ in range(n):
        kind = rng.integers(0, 5)
        if kind >= 2 or not texts:
            texts.append(" ".join(rng.choice(words, int(rng.integers(1, 120)))))
        elif kind == 0:
            texts.append(texts[int(rng.integers(len(texts)))])
        else:
            own = texts[int(rng.integers(len(texts)))].split(" ")
            for _ in range(int(rng.integers(1, 1 + max(1, len(own) // 50)))):
                own[int(rng.integers(len(own)))] = str(rng.choice(words))
            texts.append(" ".join(own))
    return texts


def test_classes_brute_force(spark):
    docs = {3 * i + 7: t for i, t in enumerate(corpus(4, 260))}
    df = spark.createDataFrame([(k, t, 0, "x", "y") for k, t in docs.items()], SCHEMA)
    got = {r.doc_id: (r.class_id, r.kept) for r in near_duplicates(df).collect()}
    want = classes(docs)
    assert got == {k: (c, c == k) for k, c in want.items()}
    assert len(set(want.values())) < len(docs) - 60


def test_large_group_of_near_copies(spark):
    """All copies of one text with one word changed are one class, found without comparing all pairs."""
    words = [f"v{k}" for k in range(300)]
    rows = [(i, " ".join(words[: i % 300] + [f"edit{i}"] + words[i % 300 + 1 :]), 0, "x", "y") for i in range(600)]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).toPandas()
    assert set(got.class_id) == {0} and got.kept.sum() == 1


def test_edges(spark):
    long = " ".join(f"x{k % 977}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "a  b"), (6, "a b c"), (7, long), (8, long + " end"), (None, "a b"), (None, "a b"), (9, "a b"), (9, "a b")]
    df = spark.createDataFrame([(*r, 0, "x", "y") for r in rows], SCHEMA)
    got = near_duplicates(df).toPandas()
    by = got.dropna(subset=["doc_id"]).groupby("doc_id").class_id.first().to_dict()
    assert by == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, 8: 7, 9: 4}
    assert len(got) == len(rows) and got[got.doc_id.isna()].kept.all() and got[got.doc_id.isna()].class_id.isna().all()
    twice = near_duplicates(df.where("doc_id in (6, 9)").withColumn("text", df["doc_id"].cast("string"))).toPandas()
    assert twice[twice.doc_id == 9].kept.sum() == 1  # one of the repeated rows
    assert near_duplicates(df.where("1 = 0")).count() == 0


def test_a_repeated_id_has_the_links_of_all_its_texts(spark):
    words = [f"w{k}" for k in range(120)]
    one, two = " ".join(words), " ".join(f"z{k}" for k in range(120))
    rows = [(1, one), (1, two), (2, one.replace("w5 ", "q ")), (3, two.replace("z9 ", "q ")), (4, ""), (4, "lone words"), (5, None), (2, one.replace("w5 ", "q "))]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame([(*r, 0, "x", "y") for r in order], SCHEMA).repartition(3)
        got = near_duplicates(df).toPandas()
        assert len(got) == len(rows)
        assert got.groupby("doc_id").class_id.agg(set).to_dict() == {1: {1}, 2: {1}, 3: {1}, 4: {4}, 5: {5}}
        assert got[got.kept].doc_id.sort_values().tolist() == [1, 4, 5]


def test_a_third_of_all_rows_under_one_id(spark):
    texts = corpus(9, 150)
    rows = [(1_000 if i % 3 else i, t, 0, "x", "y") for i, t in enumerate(texts)] + [(1_000, "", 0, "x", "y")] * 70
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).toPandas()
    bags = {i: t for i, t in enumerate(texts)}
    root = classes(bags)
    # all texts of the hot id are one class
    hot = {root[i] for i in bags if i % 3 and bag(bags[i])}
    merged = {i: ("hot" if root[i] in hot else root[i]) for i in bags}
    want = {}
    for i in bags:
        want.setdefault(merged[i], set()).add(1_000 if i % 3 else i)
    want = {d: min(g) for g in want.values() for d in g}
    assert got.groupby("doc_id").class_id.agg(set).to_dict() == {d: {c} for d, c in want.items()}
    assert len(got) == len(rows) and got[got.kept].doc_id.tolist().count(1_000) == (want[1_000] == 1_000)


def test_long_texts_just_under_the_threshold(spark):
    """400,000 words each at a similarity of about 0.79: rows of rare shingles stay linear in the text."""
    words = [f"w{k}" for k in range(400_000)]
    other = [f"q{k}" if k % 42 == 0 else w for k, w in enumerate(words)]  # a changed word changes five shingles
    rows = [(1, " ".join(words), 0, "x", "y"), (2, " ".join(other), 0, "x", "y"), (3, " ".join(words[:-1]), 0, "x", "y")]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).toPandas()
    same = 1 - 5 / 42
    assert 0.77 < same / (2 - same) < 0.8
    assert got.set_index("doc_id").class_id.to_dict() == {1: 1, 2: 2, 3: 1}


def test_components_of_paths_and_stars(spark):
    rng = np.random.default_rng(3)
    path = [(k, k + 1) for k in range(100, 160)]
    star = [(int(x), 1000) for x in range(1001, 1100)] + [(500, 1050)]
    mixed = [(int(a), int(b)) for a, b in rng.integers(2000, 2200, (150, 2))]
    edges = path + star + mixed + [(7, 7)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {k: k for e in edges for k in e}
    for _ in range(len(want)):
        before = dict(want)
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
        if before == want:
            break
    assert got == want
