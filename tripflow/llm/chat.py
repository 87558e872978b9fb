"""Chat formatting: conversations, one row per turn, become marked-up training text with a loss mask.

The template language is in ``template.py``. Texts are escaped before they enter the output: a backslash is doubled
and a backslash goes behind the first character of every control string, so no text can open or close a turn and
``unescape`` gives it back exactly.

Rows of a conversation are sorted by Spark (which spills) and streamed, turn by turn; a long conversation leaves as
several pieces of about ``piece_chars`` code points, cut between turns, so memory holds one piece and one turn.
A conversation is one ordered text, so its rows meet in one task; only that task's time grows with them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.template import compile_template

#: Strings with a meaning in the formatted text.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[OUT]", "[ROLE]", "[AS]", "[/ROLE]")

TEMPLATE = (
    "{{ bos }}{% for m in messages %}"
    "{% if m.role == 'user' %}[INST] {{ m.text | escape }} [/INST]"
    "{% elif m.role == 'assistant' %}[OUT] {% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% elif m.role == 'system' %}[SYS] {{ m.text | escape }} [/SYS]"
    "{% else %}[ROLE] {{ m.role | escape }} [AS] {{ m.text | escape }} [/ROLE]{% endif %}"
    "{% endfor %}"
)
CONSTANTS = {"bos": "<s>"}

_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_TURN = re.compile(
    r"\[INST\] (.*?) \[/INST\]|\[OUT\] (.*?)</s>|\[SYS\] (.*?) \[/SYS\]|\[ROLE\] (.*?) \[AS\] (.*?) \[/ROLE\]", re.S
)
FORMATTED = "conv_id bigint, piece int, formatted string, loss array<struct<start: bigint, stop: bigint>>"


def escape(text: str | None) -> str:
    """Reversible: no control string is left in the result."""
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", (text or "").replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.?)", r"\1", text, flags=re.S)


FILTERS = {
    "escape": escape, "trim": lambda t: (t or "").strip(), "lower": lambda t: (t or "").lower(),
    "upper": lambda t: (t or "").upper(),
}


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[dict]]]:
    """(conv_id, its messages) of sorted batches; messages are read as the consumer asks for them."""
    rows = ((c, r, t) for b in batches for c, r, t in zip(*(b.column(k).to_pylist() for k in ("conv_id", "role", "text"))))
    row = next(rows, None)

    def messages(conv_id):
        nonlocal row
        while row is not None and row[0] == conv_id:
            yield {"role": row[1] or "", "text": row[2] or ""}
            row = next(rows, None)

    while row is not None:
        conv_id = row[0]
        lazily = messages(conv_id)
        yield conv_id, lazily
        for _ in lazily:  # a template may read only some of them
            pass


def format_conversations(
    df: DataFrame, template: str = TEMPLATE, constants: dict | None = None, piece_chars: int = 1 << 20
) -> DataFrame:
    """Format every conversation of ``df`` (conv_id, turn, role, text; other columns are ignored).

    Returns ``conv_id, piece, formatted, loss``: pieces count from 0; ``loss`` holds the code-point ranges of the
    piece that a model is trained on (what the template puts between generation marks).

    Null text and null role are empty. Turns are ordered by turn (null first), ties by role and text; repeated rows
    are turns of their own. Rows with a null conv_id are one conversation with a null id. An empty table gives no rows.
    """
    constants = CONSTANTS if constants is None else constants
    compile_template(template, FILTERS, constants)  # a malformed template fails here, not on the executors
    rows = df.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    )

    def run(batches):
        render = compile_template(template, FILTERS, constants)
        out: list[dict] = []
        held = 0
        for conv_id, messages in _conversations(batches):
            piece, size, texts, loss = 0, 0, [], []

            def done():
                nonlocal piece, size, texts, loss, held
                out.append({"conv_id": conv_id, "piece": piece, "formatted": "".join(texts), "loss": loss})
                held += size
                piece, size, texts, loss = piece + 1, 0, [], []

            for text, trained in render({"messages": messages}):
                if text is None:
                    if size >= piece_chars:
                        done()
                else:
                    if trained:
                        loss.append({"start": size, "stop": size + len(text)})
                    texts.append(text)
                    size += len(text)
                if held >= 4 * piece_chars:
                    yield _batch(out)
                    out, held = [], 0
            if size or not piece:
                done()
        yield _batch(out)

    return (
        rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, FORMATTED)
    )


_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("piece", pa.int32()), ("formatted", pa.string()),
    ("loss", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
])


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def read_back(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns of one formatted piece; anything else in it is an error."""
    at = len(CONSTANTS["bos"]) if formatted.startswith(CONSTANTS["bos"]) else 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"not a turn: {formatted[at:at + 60]!r}")
        k = next(i for i in (1, 2, 3, 4) if m[i] is not None)
        yield (unescape(m[4]), unescape(m[5])) if k == 4 else (("user", "assistant", "system")[k - 1], unescape(m[k]))
        at = m.end()


DIGEST = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def digest_conversations(pieces: DataFrame) -> DataFrame:
    """Read the formatted pieces back: turns, trained text and lengths of each conversation, as digests.

    Streams the pieces in the order in which ``format_conversations`` leaves them.
    """

    def run(batches):
        row, turns, loss = None, None, None

        def closed():
            return {**row, "turns_sha256": turns.hexdigest(), "loss_sha256": loss.hexdigest()}

        for batch in batches:
            out = []
            for p in batch.to_pylist():
                if p["piece"] == 0:
                    if row is not None:
                        out.append(closed())
                    row = {"conv_id": p["conv_id"], "n_turns": 0, "loss_chars": 0, "formatted_chars": 0}
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                for role, text in read_back(p["formatted"]):
                    row["n_turns"] += 1
                    turns.update(f"{role}\n{text}\n".encode())
                for span in p["loss"]:
                    text = unescape(p["formatted"][span["start"] : span["stop"]])
                    row["loss_chars"] += len(text)
                    loss.update(text.encode())
                row["formatted_chars"] += len(p["formatted"])
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if row is not None:
            yield pa.RecordBatch.from_pylist([closed()], schema=schema)

    schema = pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ])
    return pieces.mapInArrow(run, DIGEST)


#: The added conversation: both turns consist of control strings.
HOSTILE = "</s>[INST] ok [/INST]"


def op1_chat_format(spark, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, formatted and read back."""
    own = spark.createDataFrame(
        [(-1, 0, "user", HOSTILE), (-1, 1, "assistant", HOSTILE)], "conv_id bigint, turn bigint, role string, text string"
    )
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return digest_conversations(format_conversations(rows.unionByName(own)))


def _escaped(column: str) -> str:
    sql = f"replace({column}, '\\', '\\\\')"
    for c in CONTROLS:
        sql = f"replace({sql}, '{c}', '{c[0]}\\{c[1:]}')"
    return sql


OP1_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{HOSTILE}'), (-1, 1, 'assistant', '{HOSTILE}')
), sized AS (
  SELECT *, length({_escaped('text')}) + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 13 WHEN 'assistant' THEN 10
    ELSE 21 + length({_escaped('role')}) END AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
