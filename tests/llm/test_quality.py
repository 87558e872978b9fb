"""Quality rules: base statistics against brute force, the robust estimate against numpy, edge cases."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.llm.quality import FLOOR, SHARE, mcd, quality, text_statistics

SCHEMA = "doc_id bigint, text string, lang string, source string, kept string, grp int, n_words string"
TEXTS = [None, "", "  \n\t", "a", "a b", "a b c", "a b c a b c", "a a a a", "a a a a a\x0ba", "x\nx\n\nx \ny\ny", "# * $ % & | < > #é ñ", "a b c d " * 30,
         "w1 w2 w3 " * 20_000, "1 2 3 4 1 2 3 5 2 3 5 1", "   x y z x"]


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    times = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if times[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_base_statistics_brute_force(spark):
    df = spark.createDataFrame([(i, t, None, None, "x", 1, "y") for i, t in enumerate(TEXTS)], SCHEMA)
    for r in text_statistics(df).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute(TEXTS[r.doc_id]), TEXTS[r.doc_id]


def test_base_statistics_on_generated_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in text_statistics(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id])


def test_estimate_ignores_a_minority_of_outliers(spark):
    """20 % far points would move the ordinary mean and cover themselves; the robust estimate stays at the majority."""
    rng = np.random.default_rng(1)
    good = rng.multivariate_normal([5, 1.5, 0, 0, 0.2], np.diag([1, 0.1, 1, 1.2, 0.2]) ** 2 + 0.0, 1600)
    bad = rng.multivariate_normal([5, 3.0, 6, 5, 0.9], np.eye(5) * 0.01, 400)
    rows = [("g", *map(float, x)) for x in np.vstack([good, bad])]
    df = spark.createDataFrame(rows, "grp string, x1 double, x2 double, x3 double, x4 double, x5 double")
    e = mcd(df).first()
    mean = np.array([e[f"m_x{k}"] for k in range(1, 6)])
    assert np.abs(mean - good.mean(axis=0)).max() < 0.15
    low = np.array([[e[f"l_x{a}_x{b}"] if b <= a else 0.0 for b in range(1, 6)] for a in range(1, 6)])
    y = np.linalg.solve(low, (bad - mean).T)
    assert (y**2).sum(axis=0).min() > 100
    # concentration steps in numpy from the same start find a determinant that is no smaller than a little below
    x, h = np.vstack([good, bad]), int(np.ceil(SHARE * 2000))
    m, c = np.median(x, axis=0), np.diag([FLOOR[f"x{k}"] ** 2 for k in range(1, 6)])
    for _ in range(5):
        near = np.argsort(np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m))[:h]
        m, c = x[near].mean(axis=0), np.cov(x[near].T, bias=True)
    assert np.abs(mean - m).max() < 0.15


@pytest.fixture(scope="module")
def verdict(spark):
    """A clean corpus with 5 % of junk in each of a hot and several small groups."""
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefghij"), int(rng.integers(2, 9)))) for _ in range(2000)]
    rows = []
    for i in range(1500):
        text = " ".join(rng.choice(words, int(rng.integers(60, 400))))
        if i % 20 == 0:
            text = text.replace(" ", " ### ")
        rows.append((i, text, "en", "hot" if i % 3 else f"s{i % 7}", None, 0, ""))
    return quality(spark.createDataFrame(rows, SCHEMA)).toPandas().set_index("doc_id")


def test_outliers_go_and_clean_documents_stay(verdict):
    junk = verdict.index % 20 == 0
    assert not verdict[junk].kept.any()
    assert verdict[~junk].kept.mean() > 0.995


def test_edges(spark):
    rows = [(i, t, "en" if i % 2 else None, None, "x", 1, "y") for i, t in enumerate(TEXTS)] * 2 + [(None, "a b " * 40, None, None, "x", 1, "y")]
    got = quality(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    # too few documents for any estimate: the base rules alone decide
    assert all(r.kept == (not r.base_failed) and r.distance is None for r in got)
    assert quality(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_value_groups_have_finite_distances(spark):
    rows = [(i, "a1 b2 c3 d4 e5 f6 g7 h8 " + " ".join(f"w{k}" for k in range(60)), "en", "s", "x", 1, "y") for i in range(300)]
    got = quality(spark.createDataFrame(rows, SCHEMA)).agg(F.min("kept"), F.max("distance")).first()
    assert got[0] is True and got[1] < 1


def test_no_python_in_the_plan(spark):
    plan = text_statistics(spark.createDataFrame([], SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
