"""Personal data: patterns propose spans, checksums confirm them, nearby context words adjust the score.

Everything is a column expression over one document, so the operator is a single scan. A pattern proposes spans left to
right without overlap inside its kind; matched texts and the gaps between them (``regexp_extract_all`` and ``split`` on
the same pattern) give the positions in code points, by sums in blocks of the square root of their number; the text
around a span is taken from chunks of the text. So a document with very many matches costs little more than its
length. The scan patterns below find the same matches as the plain ones
in their comments, but cannot backtrack over long runs.

Kinds ``email ip card phone`` are the base: what their pattern and check let through is always reported. ``iban``
(mod-97) and ``ssn`` (number ranges) are added when the score, raised by context words, reaches ``accept``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kind:
    name: str
    plain: str  # the pattern as specified
    scan: str  # the same matches, without backtracking
    score: float
    context: str  # words that raise the score, as a pattern over lower-case text
    base: bool = True


IBAN = r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)"
KINDS = (
    # a run that ends before '@' starts where the run starts, or where the last match ended
    Kind("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9, "e-?mail|contact|write to"),
    Kind("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, "ip|host|server|address"),
    # runs with fewer than 16 digits fail the check anyway
    Kind("card", r"[0-9]([\x20-]?[0-9])+",
         r"(?=[0-9](?:[\x20-]?[0-9]){15})[0-9](?:[\x20-]?+[0-9])++", 0.8, "card|visa|payment|credit"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", 0.6, "phone|tel|call|mobile|fax"),
    # compact, or printed in groups of four
    Kind("iban", IBAN, IBAN, 0.7, "iban|bank|account|transfer", False),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.3, "ssn|social security", False),
)
#: Score from which an added kind is reported, what a context word adds, and how far around a span it is looked for.
ACCEPT, RAISE, REACH = 0.5, 0.3, 40

IP_PARTS = r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$"
SSN_RANGES = r"^(00[1-9]|0[1-9][0-9]|[1-578][0-9]{2}|6[0-57-9][0-9]|66[0-57-9])-(0[1-9]|[1-9][0-9])-(000[1-9]|00[1-9][0-9]|0[1-9][0-9]{2}|[1-9][0-9]{3})$"
_SPAN = "struct<start: int, stop: int, hit: string>"


def luhn(digits: Column) -> Column:
    """The digits, doubled at every second place from the right, sum to a multiple of ten."""
    right = F.reverse(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 1, F.substring(right, i, F.lit(1)).cast("int")).otherwise(
            F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), F.substring(right, i, F.lit(1)).cast("int") + 1)),
    )
    return total % 10 == 0


def mod97(hit: Column) -> Column:
    """Country and check digits moved to the end, letters read as 10 to 35: the number leaves 1 modulo 97."""
    moved = F.concat(F.substring(hit, F.lit(5), F.length(hit)), F.substring(hit, 1, 4))

    def step(acc, i):
        c = F.substring(moved, i, F.lit(1))
        letter = F.ascii(c) - 55  # A is 10
        return F.when(c >= "A", (acc * 100 + letter) % 97).otherwise((acc * 10 + F.ascii(c) - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(hit)), F.lit(0), step) == 1


#: Code points of a chunk of a text; a place in the text is found in its chunk.
CHUNK = 4096


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, also where it is used inside a lambda."""
    return F.get(F.transform(F.array(value), then), 0)


def _before(values: Column, combine=lambda a, b: a + b) -> Column:
    """For each of n numbers from 0 the sum (or what ``combine`` makes) of those before it, in n ** 1.5 steps: inside
    blocks, and over whole blocks."""
    zero = F.lit(0)
    fold = lambda part: F.aggregate(part, zero, combine)

    def cut(v):
        size = F.ceil(F.sqrt(F.size(v))).cast("int")
        return F.transform(F.sequence(zero, F.ceil(F.size(v) / size).cast("int") - 1), lambda k: F.slice(v, k * size + 1, size))

    def joined(blocks):
        past = _let(F.transform(blocks, fold), lambda whole: F.transform(whole, lambda x, k: fold(F.slice(whole, F.lit(1), k))))
        return F.flatten(F.zip_with(blocks, past, lambda block, so_far: F.transform(
            block, lambda x, j: combine(so_far, fold(F.slice(block, F.lit(1), j))))))

    return _let(_let(values, cut), joined)


def _spans(text: Column, hits: Column, pattern: str) -> Column:
    """Positions of the matches: each begins after all gaps and matches before it."""
    # str.split semantics with limit -1: one gap before each match and one behind the last
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    none = F.array().cast(f"array<{_SPAN}>")
    pairs = F.filter(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), lambda x: x["hit"].isNotNull())

    def placed(p):
        at = _before(F.transform(p, lambda x: x["gap"] + F.length(x["hit"])))
        return F.zip_with(p, at, lambda x, a: F.struct(
            (a + x["gap"]).alias("start"), (a + x["gap"] + F.length(x["hit"])).alias("stop"), x["hit"].alias("hit")))

    return F.when(F.size(hits) > 0, _let(pairs, placed)).otherwise(none)


def _chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def _part(chunks: Column, start: Column, n: Column) -> Column:
    """``n`` code points of a chunked text from ``start`` (0-based); what lies beyond its end is left out."""
    first, last = F.floor(start / CHUNK).cast("int"), F.floor((start + n - 1) / CHUNK).cast("int")
    inside = F.substring(F.coalesce(F.get(chunks, first), F.lit("")), start - first * CHUNK + 1, n)
    over = F.concat(inside, F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
                    F.substring(F.coalesce(F.get(chunks, last), F.lit("")), F.lit(1), start + n - last * CHUNK))
    return F.when(n <= 0, F.lit("")).when(first == last, inside).otherwise(over)


def _near(chunks: Column, start: Column, n: Column) -> Column:
    """As ``_part``, for at most CHUNK code points: they are in two chunks."""
    first = F.floor(start / CHUNK).cast("int")
    two = F.array_join(F.slice(chunks, first + 1, F.lit(2)), "")
    return F.substring(two, F.pmod(start, F.lit(CHUNK)) + 1, n)


def _holds(kind: Kind, x: Column, chunks: Column) -> Column:
    hit, digits, compact = x["hit"], F.regexp_replace(x["hit"], "[^0-9]", ""), F.replace(x["hit"], F.lit(" "), F.lit(""))
    # the characters beside the span, where there are any
    from_ = F.greatest(x["start"] - 1, F.lit(0))
    beside = F.concat(_near(chunks, from_, x["start"] - from_), _near(chunks, x["stop"], F.lit(1)))
    if kind.name == "ip":
        return hit.rlike(IP_PARTS)
    if kind.name == "card":
        return F.length(digits).between(16, 19) & luhn(digits)
    if kind.name == "phone":
        return F.length(digits).between(8, 15)
    if kind.name == "iban":
        return ~beside.rlike("[A-Za-z0-9]") & F.length(compact).between(15, 34) & mod97(compact)
    if kind.name == "ssn":
        return ~beside.rlike("[0-9-]") & hit.rlike(SSN_RANGES)
    return F.lit(True)


def _scored(kind: Kind, x: Column, chunks: Column) -> Column:
    left = F.greatest(x["start"] - REACH, F.lit(0))
    near = F.concat_ws(" ", _near(chunks, left, x["start"] - left), _near(chunks, x["stop"], F.lit(REACH)))
    raised = F.lower(near).rlike(rf"(^|[^a-z])({kind.context})([^a-z]|$)")
    score = F.lit(kind.score) + F.when(raised, F.lit(RAISE)).otherwise(F.lit(0.0))
    return F.struct(
        F.lit(kind.name).alias("kind"), x["start"].alias("start"), x["stop"].alias("stop"),
        F.least(F.round(score, 2), F.lit(1.0)).alias("score"),
    )


def _confirmed(kind: Kind, spans: Column, chunks: Column) -> Column:
    found = F.transform(F.filter(spans, lambda x: _holds(kind, x, chunks)), lambda x: _scored(kind, x, chunks))
    return found if kind.base else F.filter(found, lambda x: x["score"] >= ACCEPT)


def find_pii(docs: DataFrame) -> DataFrame:
    """Spans of every document: ``doc_id, text, lang, source`` and one array per kind, ``email .. ssn``, of
    ``struct(kind, start, stop, score)`` in order of start (code points, stop exclusive).

    Null text is searched as an empty one and stays null; other columns of the input are not carried. Repeated rows
    are searched each for itself; an empty table gives no rows.
    """
    from tripflow.llm.common import documents

    searched = F.coalesce(F.col("text"), F.lit(""))
    df = documents(docs).withColumn("_text", searched)
    for k in KINDS:
        hits = F.regexp_extract_all("_text", F.lit(k.scan), F.lit(0))
        none = F.array().cast("array<string>")
        needs = F.contains(F.col("_text"), F.lit("@" if k.name == "email" else "+")) if k.name in ("email", "phone") else F.lit(True)
        df = df.withColumn(f"_hits_{k.name}", F.when(needs, hits).otherwise(none))
    for k in KINDS:
        df = df.withColumn(f"_spans_{k.name}", _spans(F.col("_text"), F.col(f"_hits_{k.name}"), k.scan))
    some = sum((F.size(f"_hits_{k.name}") for k in KINDS), F.lit(0)) > 0
    df = df.withColumn("_chunks", F.when(some, _chunks(F.col("_text"))).otherwise(F.array().cast("array<string>")))
    for k in KINDS:
        df = df.withColumn(k.name, _confirmed(k, F.col(f"_spans_{k.name}"), F.col("_chunks")))
    return df.select("doc_id", "text", "lang", "source", *[k.name for k in KINDS])


def redact(found: DataFrame) -> DataFrame:
    """Replace the text of ``find_pii`` rows: every span gives way to its kind in brackets, e.g. ``[EMAIL]``.

    Overlapping spans of several kinds are replaced once, by the kind that starts first (the longer one on a tie).
    Null text stays null.
    """
    spans = F.transform(
        F.array_sort(F.transform(
            F.concat(*[F.col(k.name) for k in KINDS]),
            lambda x: F.struct(x["start"].alias("start"), (-x["stop"]).alias("back"), x["kind"].alias("kind")),
        )),
        lambda x: F.struct(x["start"].alias("start"), (-x["back"]).alias("stop"), x["kind"].alias("kind")),
    )
    chunks, kept = F.col("_chunks"), F.col("_kept")
    df = found.withColumn("_all", spans).withColumn("_chunks", F.when(F.size("_all") > 0, _chunks(F.col("text"))))
    # how far the spans before each one reach: one that begins earlier goes
    reach = _before(F.transform("_all", lambda x: x["stop"]), lambda a, b: F.greatest(a, b))
    from_reach = F.zip_with("_all", reach, lambda x, r: F.struct(r.alias("reach"), x["start"].alias("start"), x["kind"].alias("kind")))
    df = df.withColumn("_kept", F.when(F.size("_all") > 0, F.filter(from_reach, lambda x: x["start"] >= x["reach"])))
    pieces = F.transform(kept, lambda x: F.concat(_part(chunks, x["reach"], x["start"] - x["reach"]), F.lit("["), F.upper(x["kind"]), F.lit("]")))
    end = F.array_max(F.transform("_all", lambda x: x["stop"]))
    text = F.concat(F.array_join(pieces, ""), _part(chunks, end, F.length("text") - end))
    return df.withColumn("text", F.when(F.size("_all") > 0, text).otherwise(F.col("text"))).drop("_all", "_kept", "_chunks")


def _listed(kinds) -> Column:
    return F.array_join(F.concat(*[
        F.transform(k.name, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string")))
        for k in kinds
    ]), ",")


def op10_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data of all documents."""
    found = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = [k for k in KINDS if k.base]
    return found.select(
        "doc_id", *[F.size(k.name).cast("long").alias(f"n_{k.name}") for k in KINDS],
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(KINDS).alias("spans"),
        F.array_join(F.transform(F.concat(*[F.col(k.name) for k in KINDS]), lambda x: x["score"].cast("string")), ",").alias("scores"),
    )


def _sql() -> str:
    """The same, written for DuckDB with the plain patterns."""
    steps, parts, counts = [], [], []
    for k in KINDS:
        p = k.plain.replace(r"\x20", " ")
        digits = "regexp_replace(x.hit, '[^0-9]', '', 'g')"
        edge = "(CASE WHEN x.a > 0 THEN substr(t, x.a, 1) ELSE '' END || substr(t, x.b + 1, 1))"
        twice = "CASE WHEN i % 2 = 1 THEN CAST(substr(reverse(d), CAST(i AS BIGINT), 1) AS INT) ELSE [0,2,4,6,8,1,3,5,7,9][CAST(substr(reverse(d), CAST(i AS BIGINT), 1) AS INT) + 1] END"
        check = {
            "email": "true", "ip": f"regexp_matches(x.hit, '{IP_PARTS}')",
            "card": f"length({digits}) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length({digits}) + 1), lambda i: {twice.replace('(d)', '(' + digits + ')')})) % 10 = 0",
            "phone": f"length({digits}) BETWEEN 8 AND 15",
            "iban": f"NOT regexp_matches({edge}, '[A-Za-z0-9]') AND length(replace(x.hit, ' ', '')) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0::BIGINT, list_transform(string_split(substr(replace(x.hit, ' ', ''), 5) || left(x.hit, 4), ''), lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE ascii(c) - 48 END::BIGINT)), lambda acc, v: (acc * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1",
            "ssn": f"NOT regexp_matches({edge}, '[0-9-]') AND regexp_matches(x.hit, '{SSN_RANGES}')",
        }[k.name]
        near = f"lower(substr(t, greatest(x.a - {REACH}, 0) + 1, x.a - greatest(x.a - {REACH}, 0)) || ' ' || substr(t, x.b + 1, {REACH}))"
        score = f"least(round({k.score} + CASE WHEN regexp_matches({near}, '(^|[^a-z])({k.context})([^a-z]|$)') THEN {RAISE} ELSE 0 END, 2), 1.0)"
        steps.append(f"""
  list_transform(list_filter(list_transform(range(1, len(h_{k.name}) + 1), lambda i: struct_pack(
    a := CAST(list_sum(list_transform(g_{k.name}[1:i], lambda s: length(s))) + coalesce(list_sum(list_transform(h_{k.name}[1:i-1], lambda s: length(s))), 0) AS BIGINT),
    b := CAST(list_sum(list_transform(g_{k.name}[1:i], lambda s: length(s))) + list_sum(list_transform(h_{k.name}[1:i], lambda s: length(s))) AS BIGINT),
    hit := h_{k.name}[i])), lambda x: {check}), lambda x: struct_pack(k := '{k.name}', a := x.a, b := x.b, s := CAST({score} AS DOUBLE))) AS all_{k.name}""")
        parts.append(f"regexp_extract_all(t, '{p}') AS h_{k.name}, string_split_regex(t, '{p}') AS g_{k.name}")
        counts.append(f"len({k.name}) AS n_{k.name}")
    kept = ", ".join(f"all_{k.name} AS {k.name}" if k.base else f"list_filter(all_{k.name}, lambda x: x.s >= {ACCEPT}) AS {k.name}" for k in KINDS)
    join = lambda kinds: "array_to_string(list_transform(flatten([" + ", ".join(k.name for k in kinds) + "]), lambda x: x.k || ':' || x.a || ':' || x.b), ',')"
    return f"""
WITH proposed AS (SELECT doc_id, t, {', '.join(parts)} FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
confirmed AS (SELECT doc_id, {','.join(steps)} FROM proposed),
kept AS (SELECT doc_id, {kept} FROM confirmed)
SELECT doc_id, {', '.join(counts)}, sha256({join([k for k in KINDS if k.base])}) AS base_sha256, {join(KINDS)} AS spans,
  array_to_string(list_transform(flatten([{', '.join(k.name for k in KINDS)}]), lambda x: CAST(x.s AS VARCHAR)), ',') AS scores
FROM kept"""


OP10_SQL = _sql()
