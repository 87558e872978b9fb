"""Spelling variants: near words, forms and roots against plain comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

from tripflow.llm import spelling
from tripflow.llm.spelling import common_prefix, spelling_variants, trie_nodes

SCHEMA = "doc_id bigint, text string, word string, n int, id string"


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def plain(rows, damaged):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % damaged == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    out, form = {}, {}
    for w, n in counts.items():
        others = sorted((-counts[v], v) for v in counts if near(w, v))
        form[w] = others[0][1] if others and -others[0][0] >= 10 * n else None
        out[w] = [form[w], None, n, len(others), counts[form[w]] if form[w] else None]
    for w in out:
        at = w
        while form[at]:
            at = form[at]
        out[w][1] = at
    return sorted((w, *v) for w, v in out.items())


def got(spark, rows, damaged=31):
    df = spark.createDataFrame([(d, t, "w", 1, "x") for d, t in rows], SCHEMA)
    return sorted(tuple(r) for r in spelling_variants(df, damaged).select("word", "form", "root", "n", "n_near", "form_n").collect())


def text(rng):
    words = ["".join(rng.choice("aabÉé") for _ in range(rng.choice([6, 7, 7, 8, 9]))) for _ in range(250)]
    common = rng.choices(["Aabbaabb", "aabbaaba", "bbbbbbb", "aaaaaaa", "aaaaaaaa"], [200, 20, 2, 30, 3], k=400)
    return " ".join(words + common) + rng.choice([".", "\n", "-", "ß1x"])


def test_all_pairs(spark, monkeypatch):
    """Many near words, runs of equal letters, chains of forms; ranges so short that prefixes cross them."""
    monkeypatch.setattr(spelling, "RANGE_WORDS", 25)
    monkeypatch.setattr(spelling, "HELD_WORDS", 100)
    rng = random.Random(4)
    rows = [(d if d % 5 else None, text(rng)) for d in range(12)] + [(3, None), (4, ""), (5, "x" * 20_000 + " " + "x" * 20_000)]
    rows += [rows[0], (51, "chainword " * 500 + "Chainwort " * 40 + "chainwart " * 3)]
    for damaged in (31, 2):
        want = plain([r for r in rows if r[1] is None or len(r[1]) < 20_000], damaged)
        have = [r for r in got(spark, rows, damaged) if len(r[0]) < 1000]
        assert len(want) > 50 and have == want
        if damaged == 31:
            assert [r[1:3] for r in want if r[0] == "chainwart"] == [("chainwort", "chainword")]


def test_nodes_are_the_prefixes(spark, monkeypatch):
    monkeypatch.setattr(spelling, "RANGE_WORDS", 10)
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(7, 9))) for _ in range(300)})
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n bigint")
    for backwards in (False, True):
        rows = trie_nodes(df, backwards).collect()
        number = {}
        for r in rows:
            spelled = r.word[::-1] if backwards else r.word
            for depth, node in enumerate(r.nodes):
                assert number.setdefault(spelled[:depth], node) == node
            assert len(r.nodes) == len(spelled) + 1
        assert len(set(number.values())) == len(number)
        assert [r.word for r in sorted(rows, key=lambda r: r.id)] == sorted(words, key=lambda w: w[::-1] if backwards else w)


def test_common_prefix():
    for a, b, n in (("", "x", 0), ("abc", "abd", 2), ("abc", "abc", 3), ("abc", "ab", 2), ("x", "abc", 0)):
        assert common_prefix(a, b) == n


def test_empty_table(spark):
    assert got(spark, []) == [] and got(spark, [(1, "short words only")]) == []
