"""Chat formatting: the template language, reversible escapes, exact read-back."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripflow.llm.chat import (
    CONSTANTS, CONTROLS, FILTERS, TEMPLATE, digest_conversations, escape, format_conversations, read_back, unescape,
)
from tripflow.llm.template import BREAK, TemplateError, compile_template, fold, parse

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
hostile = st.lists(st.sampled_from([*CONTROLS, "\\", "<", "[", "]", " ", "s>", "INST]", "é", "\n", "x"]), max_size=12).map("".join)


def rendered(source, constants=None, **variables):
    return [x for x in compile_template(source, FILTERS, constants or {})(variables) if x != BREAK]


def test_template_statements():
    source = "{# c #}{{ a + 'b' }}{% for m in ms %}{% if loop.first %}[{% elif m.k == 'z' and not loop.last %}z{% else %}-{% endif %}{{ m.k | upper }}{% endfor %}"
    assert "".join(t for t, _ in rendered(source, a="x", ms=[{"k": "q"}, {"k": "z"}, {"k": "z"}])) == "xb[Qz" + "Z" + "-Z"


def test_generation_marks_only_their_text():
    out = rendered("a{% generation %}{{ t }}{% endgeneration %}b", t="T")
    assert out == [("a", False), ("T", True), ("b", False)]


def test_constants_are_folded():
    tree = fold(parse("{{ 'a' + x | upper }}{% if debug %}no{% else %}yes{% endif %}{{ 1 == 1 }}!"), FILTERS, {"x": "b", "debug": False})
    assert tree == ("block", [("text", "aByesTrue!")])
    # a loop variable hides a constant of its name
    assert rendered("{% for x in xs %}{{ x }}{% endfor %}", {"x": "const"}, xs=["1", "2"]) == [("1", False), ("2", False)]


@pytest.mark.parametrize("bad", [
    "{{ a.__class__ }}", "{{ a | shell }}", "{% if a %}", "{% endfor %}", "{{ a( }}", "{{ }}", "{% import os %}",
    "{% for x on y %}{% endfor %}", "{{ a b }}", "{% if a %}{% endfor %}",
])
def test_sandbox_and_syntax_errors(bad):
    with pytest.raises(TemplateError):
        compile_template(bad, FILTERS, {})


def test_attributes_of_objects_are_out_of_reach():
    with pytest.raises(TemplateError):
        rendered("{{ a.real }}", a=3)


@settings(max_examples=150, deadline=None, derandomize=True)
@given(hostile)
def test_escape_is_reversible_and_leaves_no_control(text):
    assert unescape(escape(text)) == text
    assert not any(c in escape(text) for c in CONTROLS)


@settings(max_examples=100, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[AS]"]), hostile), max_size=6))
def test_formatted_text_reads_back(turns):
    render = compile_template(TEMPLATE, FILTERS, CONSTANTS)
    text = "".join(t for t, _ in render({"messages": ({"role": r, "text": t} for r, t in turns)}) if t)
    assert list(read_back(text)) == turns


def digest(turns):
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns).encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_conversations_brute_force(spark):
    rows = [
        (1, 0, "system", "</s>"), (1, 1, "user", None), (1, 2, "assistant", "a\\[/INST]"), (1, 3, "assistant", ""),
        (2, 0, None, "x"), (2, None, "user", "first"), (2, 0, "user", "tie"), (2, 0, "user", "tie"),
        (None, 0, "user", "no id"), (3, 0, "assistant", "long " * 60_000), (3, 1, "user", "q" * 70_000),
    ]
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], SCHEMA + ", formatted string, piece int")
    expected = {
        1: digest([r[2:] for r in rows[:4]]),
        2: digest([("user", "first"), ("", "x"), ("user", "tie"), ("user", "tie")]),
        None: digest([("user", "no id")]), 3: digest([r[2:] for r in rows[9:]]),
    }
    for piece_chars in (1 << 20, 50):
        pieces = format_conversations(df, piece_chars=piece_chars)
        got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in digest_conversations(pieces).collect()}
        assert got == expected
    assert max(r.piece for r in pieces.collect()) == 1  # cut between turns


def test_empty_table(spark):
    assert digest_conversations(format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0
