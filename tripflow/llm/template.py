"""A small sandboxed template language, compiled to Python closures.

Grammar::

    text  {{ expr }}  {% for x in expr %}..{% endfor %}  {% if e %}..{% elif e %}..{% else %}..{% endif %}
    {% generation %}..{% endgeneration %}  {# comment #}
    expr: or, and, not, == != < > <= >= in, + (concatenation), 'text' "text" 12 true false none,
          name, name.key, expr | filter

A template sees only the variables it is given: a dot reads a key of a mapping, never an attribute, and there
are no calls beyond the filters handed to ``compile_template``. Parsing gives a syntax tree of tuples, ``fold``
evaluates its constant parts and drops dead branches, and ``compile_template`` turns what is left into closures
that yield ``(text, in_generation)``. Loops read their input lazily with a look-ahead of one item (for
``loop.last``) and yield ``BREAK`` after each item of an outer loop, so a long conversation streams.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping

BREAK = (None, False)
_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"\s*(?:(\d+)|'((?:[^'\\]|\\.)*)'|\"((?:[^\"\\]|\\.)*)\"|([A-Za-z_]\w*)|(==|!=|<=|>=|[<>+|().]))")
_CONST = {"true": True, "false": False, "none": None}
_ESC = {"n": "\n", "t": "\t", "r": "\r"}
_COMPARE: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b,
}


class TemplateError(ValueError):
    """The template is malformed or asks for something outside the sandbox."""


def _text(value) -> str:
    return "" if value is None else str(value)


# ---- parsing ---------------------------------------------------------------------------------------------------


def _tokens(source: str) -> list[tuple[str, object]]:
    out, at, source = [], 0, source.strip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:]!r}")
        number, single, double, name, mark = m.groups()
        if number is not None:
            out.append(("const", int(number)))
        elif single is not None or double is not None:
            body = single if single is not None else double
            out.append(("const", re.sub(r"\\(.)", lambda x: _ESC.get(x[1], x[1]), body, flags=re.S)))
        elif name is not None:
            out.append(("const", _CONST[name]) if name in _CONST else ("name", name))
        else:
            out.append(("mark", mark))
        at = m.end()
    return out


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, source: str):
        self.tokens, self.at, self.source = _tokens(source), 0, source

    def peek(self, *values) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "const" and self.tokens[self.at][1] in values

    def take(self):
        if self.at >= len(self.tokens):
            raise TemplateError(f"expression ends early: {self.source!r}")
        self.at += 1
        return self.tokens[self.at - 1]

    def whole(self):
        node = self.either()
        if self.at != len(self.tokens):
            raise TemplateError(f"left over in expression: {self.source!r}")
        return node

    def either(self):
        node = self.both()
        while self.peek("or"):
            self.take()
            node = ("or", node, self.both())
        return node

    def both(self):
        node = self.negated()
        while self.peek("and"):
            self.take()
            node = ("and", node, self.negated())
        return node

    def negated(self):
        if self.peek("not"):
            self.take()
            return ("not", self.negated())
        node = self.joined()
        if self.peek(*_COMPARE):
            return ("compare", self.take()[1], node, self.joined())
        return node

    def joined(self):
        node = self.filtered()
        while self.peek("+"):
            self.take()
            node = ("join", node, self.filtered())
        return node

    def filtered(self):
        node = self.atom()
        while self.peek("|"):
            self.take()
            kind, name = self.take()
            if kind != "name":
                raise TemplateError(f"no filter name in {self.source!r}")
            node = ("filter", name, node)
        return node

    def atom(self):
        kind, value = self.take()
        if kind == "const":
            return ("const", value)
        if (kind, value) == ("mark", "("):
            node = self.either()
            if not self.peek(")"):
                raise TemplateError(f"missing ) in {self.source!r}")
            self.take()
            return node
        if kind != "name" or value in ("or", "and", "not", "in"):
            raise TemplateError(f"unexpected {value!r} in {self.source!r}")
        node = ("name", value)
        while self.peek("."):
            self.take()
            kind, key = self.take()
            if kind != "name" or key.startswith("_"):
                raise TemplateError(f"{key!r} is not a readable key")
            node = ("key", node, key)
        return node


def parse(source: str):
    """Syntax tree of a template: ('block', nodes)."""
    stack: list[tuple[str, object, list]] = [("top", None, [])]
    at = 0

    def close(kind: str):
        if stack[-1][0] not in kind.split():
            raise TemplateError(f"unexpected end of {kind} inside {stack[-1][0]}")
        return stack.pop()

    for m in _TAG.finditer(source):
        if m.start() > at:
            stack[-1][2].append(("text", source[at : m.start()]))
        at = m.end()
        if m[1] is not None:
            stack[-1][2].append(("output", _Expression(m[1]).whole()))
            continue
        if m[2] is None:
            continue
        word, _, rest = m[2].strip().partition(" ")
        if word == "for":
            name, found, items = rest.partition(" in ")
            if not found or not name.strip().isidentifier():
                raise TemplateError(f"bad loop: {rest!r}")
            stack.append(("for", (name.strip(), _Expression(items).whole()), []))
        elif word == "if":
            stack.append(("if", ([], _Expression(rest).whole()), []))
        elif word in ("elif", "else"):
            _, (arms, test), body = close("if")
            arms = [*arms, (test, ("block", body))]
            stack.append(("if", (arms, _Expression(rest).whole()), []) if word == "elif" else ("else", arms, []))
        elif word == "endif":
            kind, head, body = close("if else")
            arms = [*head[0], (head[1], ("block", body))] if kind == "if" else [*head, (("const", True), ("block", body))]
            stack[-1][2].append(("if", arms))
        elif word == "endfor":
            _, (name, items), body = close("for")
            stack[-1][2].append(("for", name, items, ("block", body)))
        elif word == "generation":
            stack.append(("generation", None, []))
        elif word == "endgeneration":
            stack[-2][2].append(("generation", ("block", close("generation")[2])))
        else:
            raise TemplateError(f"unknown statement {word!r}")
    if at < len(source):
        stack[-1][2].append(("text", source[at:]))
    if len(stack) != 1:
        raise TemplateError(f"{stack[-1][0]} is not closed")
    return ("block", stack[0][2])


# ---- folding ---------------------------------------------------------------------------------------------------


def fold(node, filters: Mapping[str, Callable], constants: Mapping[str, object]):
    """Evaluate what does not depend on the conversation: constants, joins of constants, decided branches."""

    def go(n):
        return fold(n, filters, constants)

    kind = node[0]
    if kind == "name" and node[1] in constants:
        return ("const", constants[node[1]])
    if kind == "key":
        inner = go(node[1])
        return ("const", _key(inner[1], node[2])) if inner[0] == "const" else ("key", inner, node[2])
    if kind == "not":
        inner = go(node[1])
        return ("const", not inner[1]) if inner[0] == "const" else ("not", inner)
    if kind in ("and", "or"):
        left, right = go(node[1]), go(node[2])
        if left[0] == "const":
            return right if bool(left[1]) == (kind == "and") else left
        return (kind, left, right)
    if kind in ("compare", "join"):
        left, right = go(node[-2]), go(node[-1])
        if left[0] == right[0] == "const":
            return ("const", _COMPARE[node[1]](left[1], right[1]) if kind == "compare" else _text(left[1]) + _text(right[1]))
        return (*node[:-2], left, right)
    if kind == "filter":
        if node[1] not in filters:
            raise TemplateError(f"unknown filter {node[1]!r}")
        inner = go(node[2])
        return ("const", filters[node[1]](inner[1])) if inner[0] == "const" else ("filter", node[1], inner)
    if kind == "output":
        inner = go(node[1])
        return ("text", _text(inner[1])) if inner[0] == "const" else ("output", inner)
    if kind == "generation":
        return ("generation", go(node[1]))
    if kind == "for":
        # the loop variables hide constants of the same name
        inner = {k: v for k, v in constants.items() if k not in (node[1], "loop")}
        return ("for", node[1], go(node[2]), fold(node[3], filters, inner))
    if kind == "if":
        arms = []
        for test, body in node[1]:
            test = go(test)
            if test[0] == "const" and not test[1]:
                continue
            arms.append((test, go(body)))
            if test[0] == "const":
                break
        if not arms:
            return ("text", "")
        return arms[0][1] if arms[0][0][0] == "const" else ("if", arms)
    if kind == "block":
        out: list = []
        for child in map(go, node[1]):
            for part in child[1] if child[0] == "block" else [child]:
                if part[0] == "text" and out and out[-1][0] == "text":
                    out[-1] = ("text", out[-1][1] + part[1])
                elif part != ("text", ""):
                    out.append(part)
        return ("block", out)
    return node


def _key(value, key: str):
    if not isinstance(value, Mapping):
        raise TemplateError(f"no keys to read {key!r} from")
    return value.get(key)


# ---- closures --------------------------------------------------------------------------------------------------


def _value(node, filters) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "const":
        return lambda scope, v=node[1]: v
    if kind == "name":
        return lambda scope, k=node[1]: scope.get(k)
    if kind == "key":
        inner = _value(node[1], filters)
        return lambda scope, k=node[2]: _key(inner(scope), k)
    if kind == "filter":
        inner, f = _value(node[2], filters), filters[node[1]]
        return lambda scope: f(inner(scope))
    if kind == "not":
        inner = _value(node[1], filters)
        return lambda scope: not inner(scope)
    left, right = _value(node[-2], filters), _value(node[-1], filters)
    if kind == "and":
        return lambda scope: left(scope) and right(scope)
    if kind == "or":
        return lambda scope: left(scope) or right(scope)
    if kind == "join":
        return lambda scope: _text(left(scope)) + _text(right(scope))
    f = _COMPARE[node[1]]
    return lambda scope: f(left(scope), right(scope))


def _emit(node, filters, depth: int = 0) -> Callable[[dict], Iterator[tuple]]:
    kind = node[0]
    if kind == "text":
        return lambda scope, out=((node[1], False),): iter(out)
    if kind == "output":
        value = _value(node[1], filters)
        return lambda scope: iter(((_text(value(scope)), False),))
    if kind == "block":
        parts = [_emit(x, filters, depth) for x in node[1]]

        def block(scope):
            for part in parts:
                yield from part(scope)

        return block
    if kind == "generation":
        body = _emit(node[1], filters, depth + 1)
        return lambda scope: ((text, True) for text, _ in body(scope))
    if kind == "if":
        arms = [(_value(test, filters), _emit(body, filters, depth)) for test, body in node[1]]

        def branch(scope):
            for test, body in arms:
                if test(scope):
                    yield from body(scope)
                    return

        return branch
    name, items, body = node[1], _value(node[2], filters), _emit(node[3], filters, depth + 1)

    def loop(scope):
        rest, inner, index, nothing = iter(items(scope) or ()), dict(scope), 0, object()
        item = next(rest, nothing)
        while item is not nothing:
            following = next(rest, nothing)
            index += 1
            inner[name] = item
            inner["loop"] = {"index": index, "first": index == 1, "last": following is nothing}
            yield from body(inner)
            if depth == 0:
                yield BREAK
            item = following

    return loop


def compile_template(source: str, filters: Mapping[str, Callable], constants: Mapping[str, object]):
    """A function of the variables that yields ``(text, in_generation)`` and ``BREAK`` between items of an outer loop."""
    return _emit(fold(parse(source), filters, constants), filters)
