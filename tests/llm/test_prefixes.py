"""Prefix trie: every figure of every node against a trie built turn by turn in plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

from tripflow.llm import prefixes
from tripflow.llm.prefixes import ordered_turns, prefix_trie, share_heads

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, p1 int"


def plain_trie(rows, family=20, head=4):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % head
        whole[c] = tuple(own.get(c - c % family, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    out, totals = [], {}
    for k in sorted(members, key=len, reverse=True):
        kids = children[k]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        totals[k] = (sum(totals[x][0] for x in kids) or 1, (len(members[k]) - 1) * words + sum(totals[x][1] for x in kids))
        ends = ",".join(str(c) for c in sorted(members[k]) if whole[c] == k)
        out.append((min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), len(kids), *totals[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in prefix_trie(*share_heads(ordered_turns(df))).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


def test_random_conversations(spark):
    rng = random.Random(3)
    rows = []
    for c in rng.sample(range(300), 150):
        for t in range(rng.choice([1, 1, 2, 3, 5, 7])):
            rows.append((c, rng.choice([None, t, t, t]), rng.choice(["user", "assistant", None]), rng.choice(["a b", "", None, "c  d\te", "ü ", "a b"])))
    rows += [(None, 0, "user", "lost")] * 3 + [rows[0]] * 2
    rng.shuffle(rows)
    assert got(spark, rows) == plain_trie(rows)


def test_hot_conversation_and_common_first_turn(spark, monkeypatch):
    """One conversation with a third of all turns, two that agree for long, one common conversation; small blocks."""
    monkeypatch.setattr(prefixes, "TASK_ROWS", 40)
    monkeypatch.setattr(prefixes, "PIECE_IDS", 7)
    rows = [(7, t, "user", f"turn {t}") for t in range(700)]
    rows += [(c, t, "user", f"{t}" if t < 12 else f"{t} {c}") for c in (1001, 1002) for t in range(20)]
    rows += [(c, t, "user", f"same {t} here") for c in range(2000, 2150) for t in range(4)]
    rows += [(c, t, "user", "hello there" if not t else f"{c}") for c in range(4000, 4200) for t in range(2)]
    random.Random(1).shuffle(rows)
    assert got(spark, rows) == plain_trie(rows)


def test_turnless_and_long_text(spark):
    lone = next(c for c in range(21, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(lone, 0, "user", "gone"), (lone, 1, "user", "gone too")]
    assert got(spark, rows) == plain_trie(rows) and len(got(spark, rows)) == 1
    rows += [(5, 0, "user", "word " * 300_000), (5, 1, "user", ""), (6, 0, "user", "word " * 300_000), (-40, 0, None, None)]
    assert got(spark, rows) == plain_trie(rows)


def test_empty_table(spark):
    assert got(spark, []) == []
