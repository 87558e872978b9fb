"""Spelling variants by a trie-node pair dictionary.

Every prefix of a word is a node of a forward trie, every suffix one of a trie over the reversed words, and nodes are
integers. A word of length L gives, for each position i, the pair (prefix node of the i letters before, suffix node of
the letters after): with the letter at i skipped, and with a letter thought to be inserted at i. Two words that agree
on a skipped pair differ in one replaced letter; a skipped pair of one that is an inserted pair of another means one
letter more. So near words are met by equality of integer pairs, exactly, with no distance to compute.

A pair fixes all but one letter, so at most one word of the alphabet's size in letters meets in it, however common.

Nodes are numbered in sorted order: a word creates the nodes below its common prefix with the word before. Ranges of
the order are numbered in parallel; a prefix that began in an earlier range takes its number from there, which needs
the first and the last word of each range only (two words for up to RANGE_WORDS).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.anchors import run_ids, whole_runs
from tripflow.llm.common import materialise, parts_for, table
from tripflow.llm.hashing import sub_batches

#: Words of at least so many letters that occur at least so often are compared.
LEAST_LETTERS, LEAST_COUNT = 7, 2
#: A near word is the form of another if it occurs at least so many times as often.
TIMES = 10
#: One occurrence in so many loses a letter.
DAMAGED = 31
#: Words that one task numbers, on average, and pairs that one task compares.
RANGE_WORDS, PAIR_ROWS = 200_000, 4_000_000
#: Distinct words (and letters in them) that a task counts before it hands them on.
HELD_WORDS, HELD_LETTERS = 300_000, 8_000_000

RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LETTERS)


def count_words(docs: DataFrame, damaged: int = DAMAGED) -> DataFrame:
    """``word, n``: the words of whole texts of at least LEAST_LETTERS letters and LEAST_COUNT occurrences.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case. Where ``damaged`` divides the
    unsigned crc32 of ``<doc_id>:<run>`` (UTF-8; a null doc_id is empty), the run loses its letter at crc32 modulo
    length. Null texts have no words, repeated rows count again, further columns are ignored.
    """
    def run(batches):
        counts, letters = Counter(), 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for part in sub_batches(batch, "text"):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    if not text:
                        continue
                    seed = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
                    for word, n in Counter(RUN.findall(text.encode().lower().decode())).items():
                        h = zlib.crc32(word.encode(), seed)
                        if not h % damaged:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < LEAST_LETTERS:
                                continue
                        if word not in counts:
                            letters += len(word)
                        counts[word] += n
                    if len(counts) > HELD_WORDS or letters > HELD_LETTERS:
                        yield out()
                        counts, letters = Counter(), 0
        yield out()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] agrees, a[:hi] does not
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid)
    return lo


def trie_nodes(words: DataFrame, backwards: bool = False) -> DataFrame:
    """``words`` (word, n; distinct) with ``id``, ascending in the order of words (of reversed words if ``backwards``),
    and ``nodes``: the numbers of the trie nodes on the word's path, root first."""
    def number(batches):
        block = TaskContext.get().partitionId() << 40
        prev, first, path, made, seen, since = None, None, [], block, block, 0
        for batch in batches:
            own = batch.column("spelled").to_pylist()
            ids, paths, with_first = [], [], []
            for word in own:
                same = -1 if prev is None else common_prefix(prev, word)
                # what it shares with the first word of the range, too, may have begun in an earlier range
                since = len(word) if prev is None else min(since, same)
                first = word if first is None else first
                new = len(word) - same
                path = path[: same + 1] + list(range(made, made + new))
                made += new
                ids.append(seen)
                paths.append(path)
                with_first.append(since)
                seen += 1
                prev = word
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), batch.column("spelled"), pa.array(ids, pa.int64()),
                 pa.array(paths, pa.list_(pa.int64())), pa.array(with_first, pa.int32()), pa.array([block >> 40] * len(ids), pa.int32())],
                names=["word", "n", "spelled", "id", "nodes", "since", "block"])

    spelled = words.select("word", "n", (F.reverse("word") if backwards else F.col("word")).alias("spelled"))
    ranged = spelled.repartitionByRange(parts_for(words, F.lit(1), RANGE_WORDS), "spelled").sortWithinPartitions("spelled")
    numbered = materialise(
        ranged.mapInArrow(number, "word string, n bigint, spelled string, id bigint, nodes array<bigint>, since int, block int"), "numbered")
    last = F.struct("spelled", "nodes", "since")
    ends = numbered.groupBy("block").agg(F.min("spelled").alias("first"), F.max_by(last, "id").alias("last")).collect()  # two words a range
    carried, before, rows = [], None, []
    for end in sorted(ends, key=lambda r: r["block"]):
        if before is not None:
            word, nodes = before
            carried = nodes[: common_prefix(word, end["first"]) + 1]
            rows.append((end["block"], carried))
        to = min(len(carried), end["last"]["since"] + 1) if before is not None else 0
        before = end["last"]["spelled"], carried[:to] + end["last"]["nodes"][to:]
    earlier = numbered.sparkSession.createDataFrame(rows, "block int, earlier array<bigint>")
    fixed = F.transform("nodes", lambda x, i: F.when(i <= F.least(F.col("since"), F.size("earlier") - 1), F.get("earlier", i)).otherwise(x))
    # a row for each range
    return numbered.join(F.broadcast(earlier), "block", "left").select(
        "word", "n", "id", F.when(F.col("earlier").isNull(), F.col("nodes")).otherwise(fixed).alias("nodes"))


#: A pair with a letter skipped: the first of equal letters (any of them leaves the same word), or a later one; and with one inserted.
SKIPPED, SKIPPED_AGAIN, INSERTED = 0, 1, 2


def node_pairs(words: DataFrame) -> DataFrame:
    """``prefix, suffix, kind, id, n`` of words (word, n, id, forward, backward: their paths): 2 L + 1 rows a word."""
    length = F.size("forward") - 1
    letters = F.split("word", "")
    kind = lambda i: F.when((i > 0) & (F.get("letters", i) == F.get("letters", i - 1)), SKIPPED_AGAIN).otherwise(SKIPPED)
    pair = lambda i, rest, k: F.struct(
        F.get("forward", i).alias("prefix"), F.get("backward", rest).alias("suffix"), k.cast("byte").alias("kind"))
    skipped = F.transform(F.sequence(F.lit(0), F.col("length") - 1), lambda i: pair(i, F.col("length") - 1 - i, kind(i)))
    inserted = F.transform(F.sequence(F.lit(0), F.col("length")), lambda i: pair(i, F.col("length") - i, F.lit(INSERTED)))
    return words.withColumns({"length": length, "letters": letters}).select(F.inline(F.concat(skipped, inserted)), "id", "n")


def near_words(pairs: DataFrame) -> DataFrame:
    """``id, n_near, best_n, best_id``: how many words are near each word that has one, and the most frequent of them
    (the smallest on a tie)."""
    def run(batches):
        for prefix, suffix, kind, word, n in whole_runs(batches, 2):
            of = run_ids([prefix, suffix])
            some = np.bincount(of)[of] > 1
            of, kind, word, n = of[some], kind[some], word[some], n[some]
            order = np.lexsort((word, -n, of))
            of, kind, word, n = np.unique(of[order], return_inverse=True)[1], kind[order], word[order], n[order]
            if not len(of):
                continue
            runs = of[-1] + 1
            none = np.full(runs, -1)
            skip, once, insert = (np.flatnonzero(x) for x in (kind < INSERTED, kind == SKIPPED, kind == INSERTED))

            def leading(rows):
                top = none.copy()
                top[of[rows[::-1]]] = rows[::-1]  # the first of each run is written last
                return top

            top = leading(skip)
            second = leading(skip[top[of[skip]] != skip])
            rival = np.where(top[of[skip]] == skip, second[of[skip]], top[of[skip]])  # a replaced letter
            longer = leading(once)[of[insert]]  # a letter more than the word of the inserted pair: one word at most
            shorter = leading(insert)[of[once]]
            met = [(skip, rival, np.bincount(of[skip], minlength=runs)[of[skip]] - 1),
                   (insert, longer, np.bincount(of[once], minlength=runs)[of[insert]]), (once, shorter, np.ones(len(once), np.int64))]
            row, other, count = (np.concatenate(x) for x in zip(*[(r[o >= 0], o[o >= 0], c[o >= 0]) for r, o, c in met]))
            yield pa.RecordBatch.from_arrays([pa.array(word[row]), pa.array(count.astype(np.int64)), pa.array(n[other]), pa.array(word[other])],
                                             names=["id", "n_near", "best_n", "best_id"])

    parts = parts_for(pairs, F.lit(1), PAIR_ROWS)
    dealt = pairs.select("prefix", "suffix", "kind", "id", "n").repartition(parts, "prefix", "suffix").sortWithinPartitions("prefix", "suffix")
    met = dealt.mapInArrow(run, "id bigint, n_near bigint, best_n bigint, best_id bigint")
    best = F.max(F.struct("best_n", (-F.col("best_id")).alias("minus"))).alias("best")
    return met.groupBy("id").agg(F.sum("n_near").alias("n_near"), best).select(
        "id", "n_near", F.col("best.best_n").alias("best_n"), (-F.col("best.minus")).alias("best_id"))


def roots(links: DataFrame) -> DataFrame:
    """``id, root`` of links (id, to) that lead to ever more frequent words: paths are doubled until none goes on.

    A form is TIMES as frequent, so a path has at most 18 steps and five doublings end it.
    """
    links = materialise(links, "links")
    while True:
        further = links.select(F.col("id").alias("to"), F.col("to").alias("on"))
        if links.join(further, "to", "left_semi").isEmpty():
            return links.withColumnRenamed("to", "root")
        links = materialise(links.join(further, "to", "left").select("id", F.coalesce("on", "to").alias("to")), "links")


def spelling_variants(docs: DataFrame, damaged: int = DAMAGED, times: int = TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every counted word; see ``count_words`` for the words.

    Near words differ by exactly one inserted, deleted or replaced code point. ``form`` is the near word of largest n
    (ties: the smallest in code-point order) if that is at least ``times`` the word's, else null; ``root`` follows forms to
    the last. No documents, or no words, give no rows. A very long word costs rows in proportion to its length.
    """
    counted = materialise(count_words(docs, damaged), "words")
    forward = trie_nodes(counted).withColumnRenamed("nodes", "forward")
    backward = trie_nodes(counted, backwards=True).select("word", F.col("nodes").alias("backward"))
    words = materialise(forward.join(backward, "word"), "paths")
    near = materialise(near_words(node_pairs(words)), "near")
    plain = words.select("id", "word", "n")
    known = plain.join(near, "id", "left")
    formed = materialise(known.where(F.col("best_n") >= F.lit(times) * F.col("n")).select("id", "best_id", F.col("best_n").alias("form_n")), "formed")
    ends = roots(formed.select("id", F.col("best_id").alias("to")))
    named = formed.join(ends, "id").join(plain.select(F.col("id").alias("best_id"), F.col("word").alias("form")), "best_id").join(
        plain.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "form", "root_word", "form_n")
    return known.join(named, "id", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Variants among all words of all documents."""
    return spelling_variants(table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents
), per_doc AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS k, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY 1, 2
), bytes AS (
  SELECT k, run, n, flatten(list_transform(range(length(k)), lambda i: CASE WHEN unicode(substr(k, i + 1, 1)) < 128 THEN [CAST(unicode(substr(k, i + 1, 1)) AS BIGINT)]
    ELSE [CAST(192 | (unicode(substr(k, i + 1, 1)) >> 6) AS BIGINT), CAST(128 | (unicode(substr(k, i + 1, 1)) & 63) AS BIGINT)] END)) AS b FROM per_doc
), hashed AS (
  SELECT run, n, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS h FROM bytes, tab
), words AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word,
    CAST(sum(n) AS BIGINT) AS n FROM hashed GROUP BY 1
), w AS (
  SELECT word, n FROM words WHERE length(word) >= 7 AND n >= 2
), gaps AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS short FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)
), near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.short = b.short AND a.i = b.i AND a.word <> b.word
  UNION SELECT DISTINCT g.word, w.word, w.n FROM gaps g JOIN w ON g.short = w.word
  UNION SELECT DISTINCT w.word, g.word, g.n FROM gaps g JOIN w ON g.short = w.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word
), form AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= 10 * w.n THEN b.other END AS form,
    CASE WHEN b.other_n >= 10 * w.n THEN b.other_n END AS form_n FROM w LEFT JOIN best b ON w.word = b.word
), f1 AS (SELECT a.word, coalesce(b.form, a.form) AS root FROM form a LEFT JOIN form b ON a.form = b.word),
f2 AS (SELECT a.word, coalesce(b.root, a.root) AS root FROM f1 a LEFT JOIN f1 b ON a.root = b.word),
f3 AS (SELECT a.word, coalesce(b.root, a.root) AS root FROM f2 a LEFT JOIN f2 b ON a.root = b.word),
f4 AS (SELECT a.word, coalesce(b.root, a.root) AS root FROM f3 a LEFT JOIN f3 b ON a.root = b.word),
f5 AS (SELECT a.word, coalesce(b.root, a.root) AS root FROM f4 a LEFT JOIN f4 b ON a.root = b.word)
SELECT f.word, f.form, coalesce(r.root, f.word) AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM form f JOIN f5 r ON f.word = r.word
"""
