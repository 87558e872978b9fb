"""Prefix trie of conversations by truncation peeling.

A node is a distinct sequence of first turns. The peel starts at the greatest depth at which different conversations
still agree and goes up one depth at a time: the conversations that end at a depth join the nodes that survived from
below, each survivor having lost its last turn; equal prefixes are grouped into the nodes of that depth, with all
figures of their subtrees. A grouping looks at the distinct nodes of one depth, never at all conversations again.

Two things keep it linear. Equal conversations are one member with a count. What a conversation has to itself (the
turns after the last prefix that it shares with a different one) is a chain whose figures follow from the turns, so it
is written at once and counts as a conversation that ends where sharing ends; the number of rounds is the greatest
shared depth, whatever the length of the longest conversation.

A prefix is named by 128 bits: the exclusive or of a hash of (position, turn) over its turns, turns being named by their
SHA-256. So stripping the last turn is one more exclusive or, and prefixes of a conversation of any length come from
running totals in blocks of rows; a conversation that holds a third of all turns is spread over many tasks.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.common import WORD, materialise, parts_for, table
from tripflow.session import scratch_path

#: Turns that one task numbers, on average.
TASK_ROWS = 200_000
#: Ids in one piece of the list of a node's ended conversations.
PIECE_IDS = 50_000
#: A key with more than this share of the rows is joined by broadcast: there are fewer than 1,000 such keys.
HOT_SHARE = 1000
#: Conversations of this many neighbouring ids share the first turns of the first of them; at most HEAD - 1 turns.
FAMILY, HEAD = 20, 4

NO_ENDS = hashlib.sha256(b"").hexdigest()
P, Q = ["p1", "p2"], ["q1", "q2"]
_UP_TO = (Window.unboundedPreceding, Window.currentRow)
_BEFORE = (Window.unboundedPreceding, -1)


def per_block(rows: DataFrame, meta: DataFrame) -> DataFrame:
    """``rows`` (conv_id, block, ..) with the columns of ``meta`` (conv_id, ..), joined by conversation and block so
    that a long conversation does not meet in one task; rows of conversations that ``meta`` lacks go."""
    return rows.join(rows.select("conv_id", "block").distinct().join(meta, "conv_id"), ["conv_id", "block"])


def keyed_join(rows: DataFrame, keyed: DataFrame, on: list[str], weight: str, total: int) -> DataFrame:
    """Inner join with a table of distinct keys; ``weight`` is at least the number of rows of a key. Keys with over a
    thousandth of ``total`` rows (fewer than a thousand keys a depth) are broadcast, so none of them is one task."""
    hot = F.broadcast(keyed.where(F.col(weight) * HOT_SHARE > total))
    cold = keyed.where(F.col(weight) * HOT_SHARE <= total)
    return rows.join(hot, on).unionByName(rows.join(hot.select(*on), on, "left_anti").join(cold, on))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, block, at, key, words``: turns numbered from 0 in each conversation, named by role and text.

    Order is by turn (null first), then role, then text; null role or text is empty. Rows without a conv_id belong to
    no conversation and are left out; repeated rows are turns of their own. Further columns are ignored.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), empty("role").alias("role"),
        empty("text").alias("text"))
    by = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    ranged = rows.repartitionByRange(parts_for(rows, F.lit(1), TASK_ROWS), *by).sortWithinPartitions(*by)
    turns = materialise(ranged.select(
        "conv_id", F.spark_partition_id().cast("long").alias("block"), F.monotonically_increasing_id().alias("id"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("key"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")), "turns")
    blocks = turns.groupBy("conv_id", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("block").rowsBetween(*_BEFORE))  # a row for each block
    blocks = blocks.select("conv_id", "block", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    return turns.join(blocks, ["conv_id", "block"]).select("conv_id", "block", (F.col("id") + F.col("shift")).alias("at"), "key", "words")


def share_heads(turns: DataFrame, family: int = FAMILY, head: int = HEAD) -> tuple[DataFrame, DataFrame]:
    """The turns of the rebuilt conversations, and ``conv_id`` of all of them (some may have no turn).

    Conversation c becomes the first h turns of conversation c - c % family (all if it has fewer, none if there is no
    such conversation), then its own turns after its first h; h is crc32 of c as text, modulo ``head``.
    """
    first = turns.where(F.col("at") < head - 1).groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("at", "key", "words"))).alias("turns"))  # head - 1 turns at most
    c = F.col("conv_id")
    own = turns.select("conv_id").distinct().select(
        "conv_id", (c - c % family).alias("base"), (F.crc32(c.cast("string").cast("binary")) % head).cast("int").alias("h"))
    nothing = F.array().cast("array<struct<at:bigint,key:string,words:bigint>>")
    plan = own.join(first, "base", "left").select(
        "conv_id", "h", F.slice(F.coalesce("turns", nothing), F.lit(1), F.col("h")).alias("head"))
    plan = materialise(plan, "heads")
    shared = plan.select("conv_id", F.lit(-1).cast("long").alias("block"), F.inline("head"))
    rest = per_block(turns, plan.select("conv_id", "h", F.size("head").alias("n"))).where("at >= h")
    return shared.unionByName(rest.select("conv_id", "block", (F.col("at") - F.col("h") + F.col("n")).alias("at"), "key", "words")), plan.select("conv_id")


def prefix_keys(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every prefix ``conv_id, block, depth, p1, p2, q1, q2, words, total`` (its key, that of the prefix without its last
    turn, words of the last turn and of all), and the whole conversations ``conv_id, p1, p2, n, total``."""
    rows = turns.withColumns({f"e{k}": F.xxhash64(F.lit(k), "at", "key") for k in (1, 2)})
    own = Window.partitionBy("conv_id", "block").orderBy("at").rowsBetween(*_UP_TO)
    sums = rows.groupBy("conv_id", "block").agg(
        F.bit_xor("e1").alias("x1"), F.bit_xor("e2").alias("x2"), F.sum("words").alias("w"), F.count(F.lit(1)).alias("n"))
    past = Window.partitionBy("conv_id").orderBy("block").rowsBetween(*_BEFORE)  # a row for each block
    zero = F.lit(0).cast("long")
    offsets = sums.select("conv_id", "block", *[F.coalesce(F.bit_xor(x).over(past), zero).alias(f"o{k}") for k, x in ((1, "x1"), (2, "x2"))],
                          F.coalesce(F.sum("w").over(past), zero).alias("ow"))
    inside = rows.select("conv_id", "block", "at", "words", "e1", "e2", F.bit_xor("e1").over(own).alias("r1"),
                         F.bit_xor("e2").over(own).alias("r2"), F.sum("words").over(own).alias("rw"))
    p = {k: F.col(f"o{k}").bitwiseXOR(F.col(f"r{k}")) for k in (1, 2)}
    prefixes = inside.join(offsets, ["conv_id", "block"]).select(
        "conv_id", "block", (F.col("at") + 1).alias("depth"), *[p[k].alias(f"p{k}") for k in p],
        *[p[k].bitwiseXOR(F.col(f"e{k}")).alias(f"q{k}") for k in p], "words", (F.col("ow") + F.col("rw")).alias("total"))
    whole = sums.groupBy("conv_id").agg(F.bit_xor("x1").alias("p1"), F.bit_xor("x2").alias("p2"), F.sum("n").alias("n"), F.sum("w").alias("total"))
    return prefixes, whole


def id_digests(whole: DataFrame) -> DataFrame:
    """``p1, p2, ends_sha256`` of the conversations (conv_id, p1, p2) of each key, ids ascending and comma-joined.

    Ranges of (key, id) become pieces of text, so the ids of a common conversation are spread over tasks; a digest
    streams its pieces in order, one for up to PIECE_IDS ids.
    """
    def pieces(batches):
        key, ids, out = None, [], []

        def close():
            if ids:
                out.append((*key, ids[0], ",".join(map(str, ids))))
            rows = list(zip(*out)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["p1", "p2", "first", "ids"])

        for batch in batches:
            for p1, p2, c in zip(*(batch.column(n).to_pylist() for n in ("p1", "p2", "conv_id"))):
                if key != (p1, p2) or len(ids) >= PIECE_IDS:
                    if ids:
                        out.append((*key, ids[0], ",".join(map(str, ids))))
                    key, ids = (p1, p2), []
                    if len(out) >= 1000:
                        held, ids = ids, []
                        yield close()
                        out, ids = [], held
                ids.append(c)
        yield close()

    def digests(batches):
        key, state = None, None
        for batch in batches:
            out = []
            for p1, p2, text in zip(*(batch.column(n).to_pylist() for n in ("p1", "p2", "ids"))):
                if key != (p1, p2):
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (p1, p2), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            yield rows_of(out)
        yield rows_of([(*key, state.hexdigest())] if key is not None else [])

    def rows_of(out):
        cols = list(zip(*out)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string()))], names=["p1", "p2", "ends_sha256"])

    by = [*P, "conv_id"]
    ranged = whole.select(*by).repartitionByRange(parts_for(whole, F.lit(1), TASK_ROWS), *by).sortWithinPartitions(*by)
    joined = ranged.mapInArrow(pieces, "p1 bigint, p2 bigint, first bigint, ids string")
    return joined.repartition(*P).sortWithinPartitions(*P, "first").mapInArrow(digests, "p1 bigint, p2 bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """A row for each node of the trie of ``turns`` (conv_id, block, at, key, words: see ``ordered_turns``).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``. ``conversations`` (conv_id) names those that may have no turns: they
    are members of the root and end there. No conversations at all give no rows.
    """
    spark = turns.sparkSession
    prefixes, whole = prefix_keys(turns)
    prefixes, whole = materialise(prefixes, "prefixes"), materialise(whole, "whole")
    if conversations is not None:
        zero = F.lit(0).cast("long")
        whole = conversations.join(whole, "conv_id", "left").select(
            "conv_id", *[F.coalesce(c, zero).alias(c) for c in ("p1", "p2", "n", "total")])

    # equal conversations are one, named by the smallest id
    classes = whole.groupBy(*P).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("m"), F.max("n").alias("n"), F.max("total").alias("all"))
    classes = materialise(classes.join(id_digests(whole), P).drop(*P), "classes")
    own = materialise(per_block(prefixes, classes).repartitionByRange("depth", "conv_id").sortWithinPartitions("depth", "conv_id"), "own")

    # where each conversation is last with a different one
    shared = own.groupBy(*P).agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    deepest = keyed_join(own.select("conv_id", "depth", *P), shared, P, "held", own.count()).groupBy("conv_id").agg(F.max("depth").alias("last"))
    classes = materialise(classes.join(deepest, "conv_id", "left").withColumn("last", F.coalesce("last", F.lit(0).cast("long"))), "shared")
    own_to = per_block(own, classes.select("conv_id", "last"))

    spare = F.col("m") - 1
    alone = own_to.where("depth > last").select(
        "conv_id", "depth", *Q, F.when(F.col("depth") > F.col("last") + 1, F.col("conv_id")).alias("parent_conv_id"), "m",
        (F.col("depth") < F.col("n")).cast("long").alias("kids"), F.lit(1).cast("long").alias("leaves"),
        (spare * (F.col("all") - F.col("total") + F.col("words"))).alias("saved"),
        F.when(F.col("depth") == F.col("n"), F.col("ends_sha256")).alias("ends"))

    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    goes_on = F.col("n") > F.col("last")
    ended = [goes_on.cast("long").alias("kids"), goes_on.cast("long").alias("leaves"), (spare * (F.col("all") - F.col("total"))).alias("saved"),
             F.when(~goes_on, F.col("ends_sha256")).alias("ends")]
    here = own_to.where("depth = last").select("conv_id", "depth", *P, *Q, "words", "m", *ended)
    at_root = classes.where("last = 0").withColumn("total", zero).select(
        "conv_id", F.col("last").alias("depth"), *[zero.alias(c) for c in P], *[none.alias(c) for c in Q], zero.alias("words"), "m", *ended)
    arrivals = materialise(here.unionByName(at_root).repartitionByRange("depth", "conv_id").sortWithinPartitions("depth"), "arrivals")

    base = scratch_path(spark, f"llm-levels-{uuid.uuid4().hex}")
    level, deepest_shared = None, arrivals.agg(F.max("depth").alias("d")).first()["d"]
    schema = None
    for depth in range(-1 if deepest_shared is None else int(deepest_shared), -1, -1):
        meeting = arrivals.where(F.col("depth") == depth).drop("depth")
        if level is not None:
            # survivors lose their last turn: their key is the one without it, and the next one comes from a member
            stripped = level.select("conv_id", *[F.col(q).alias(p) for p, q in zip(P, Q)], "m", F.lit(1).cast("long").alias("kids"), "leaves", "saved",
                                    F.lit(None).cast("string").alias("ends"))
            if depth:
                stripped = stripped.join(own.where(F.col("depth") == depth).select("conv_id", *Q, "words"), "conv_id")
            else:
                stripped = stripped.select("*", *[none.alias(q) for q in Q], zero.alias("words"))
            meeting = meeting.unionByName(stripped)
        nodes = meeting.groupBy(*P).agg(
            F.min("conv_id").alias("conv_id"), F.sum("m").alias("m"), F.sum("kids").alias("kids"), F.sum("leaves").alias("leaves"),
            F.sum("saved").alias("saved"), F.max("ends").alias("ends"), *[F.min(q).alias(q) for q in Q], F.max("words").alias("words"))
        nodes = nodes.withColumns({"leaves": F.when(F.col("kids") == 0, 1).otherwise(F.col("leaves")).cast("long"),
                                   "saved": F.col("saved") + spare * F.col("words")})
        nodes.write.parquet(f"{base}/depth={depth}")
        schema = nodes.schema
        level = spark.read.schema(schema).parquet(f"{base}/depth={depth}")

    figures = ["conv_id", "depth", "parent_conv_id", F.col("m").alias("n_convs"), F.col("kids").alias("n_children"),
               F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256")]
    if level is None:
        return alone.select(*figures)
    met = spark.read.schema(schema.add("depth", "long")).parquet(base)
    parents = met.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent"), F.col("kids").alias("held"))
    below = met.where("depth > 0").select(*[c for c in alone.columns if c != "parent_conv_id"]).unionByName(
        alone.where("parent_conv_id is null").drop("parent_conv_id"))
    below = keyed_join(below, parents, Q, "held", met.count()).withColumn("parent_conv_id", F.col("parent"))
    root = met.where("depth = 0").withColumn("parent_conv_id", none)
    out = root.select(*figures)
    for part in (below, alone.where("parent_conv_id is not null")):
        out = out.unionByName(part.select(*figures))
    return out


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """The trie of all conversations, families of 20 ids sharing up to three first turns."""
    turns, conversations = share_heads(materialise(ordered_turns(table(spark, sf_dir, "conversations")), "ordered"))
    return prefix_trie(turns, conversations)


OP13_SQL = """
WITH tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
), raw AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role, text) AS turns FROM raw GROUP BY conv_id
), heads AS (
  SELECT conv_id, turns, xor(list_reduce(list_transform(range(length(CAST(conv_id AS VARCHAR))), lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), i + 1, 1)) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 4 AS h FROM own, tab
), rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS s
  FROM heads a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20
), prefixes AS (
  SELECT conv_id, unnest(range(0, len(s) + 1)) AS d, s FROM rebuilt
), nodes AS (
  SELECT s[1:d] AS k, d, min(conv_id) AS conv_id, count(*) AS n,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(s) = d), '')) AS ends
  FROM prefixes GROUP BY 1, 2
), worth AS (
  SELECT *, CASE WHEN d = 0 THEN 0 ELSE (n - 1) * len(regexp_extract_all(k[d].t, '[^\\x20\\x09-\\x0D]+')) END AS own_saved,
    CASE WHEN d > 0 THEN k[1:d - 1] END AS pk FROM nodes
), kids AS (
  SELECT pk AS k, count(*) AS n_children FROM worth WHERE d > 0 GROUP BY 1
), full_nodes AS (
  SELECT w.*, coalesce(c.n_children, 0) AS n_children FROM worth w LEFT JOIN kids c ON w.k = c.k
), up AS (
  SELECT k, unnest(range(0, d + 1)) AS a, n_children, own_saved FROM full_nodes
), subtree AS (
  SELECT k[1:a] AS k, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(own_saved) AS saved FROM up GROUP BY 1
)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, f.n AS n_convs, CAST(f.n_children AS BIGINT) AS n_children,
  CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, f.ends AS ends_sha256
FROM full_nodes f JOIN subtree s ON f.k = s.k LEFT JOIN nodes p ON f.pk = p.k
"""
