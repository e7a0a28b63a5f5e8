"""A small sandboxed template language, compiled to Python closures.

    text  {{ expression }}  {# remark #}
    {% for m in messages %} ... {% endfor %}      with loop.index, index0, first, last
    {% if a %} ... {% elif b %} ... {% else %} ... {% endif %}
    {% set name = expression %}
    {% generation %} ... {% endgeneration %}

A dash inside a tag (`{%-`, `-%}`) strips white space on that side. Expressions have
strings, whole numbers, true, false, none, names, fields (`m.role`, `m['role']`), filters
(`x | escape`), + and ~ (joins text), comparisons, `in`, not, and, or. Fields are looked up
in mappings only, filters in a fixed list, and there are no calls, so a template reaches
nothing but the values it is given.

The source is parsed into a tree of tuples, constant parts are folded (also branches that
can never be taken, and text next to text), and every node becomes a closure. A rendered
template is a stream of (text, generated) pieces; what lies inside a generation tag is
marked. Lists are consumed as streams, so a conversation need not fit into memory.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator


class TemplateError(ValueError):
    """The template is malformed or asks for something the language does not have."""


# --- control strings -------------------------------------------------------------------------

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No `<|` is left: a backslash is put between (one more, if there are some)."""
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    """The text that `escape` was given."""
    return _ESCAPED.sub(r"<\1|", text)


def one_line(text: str) -> str:
    return text.replace("\\", "\\\\").replace("\n", "\\n")


def many_lines(text: str) -> str:
    """The text that `one_line` was given."""
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


FILTERS: dict[str, Callable] = {
    "escape": lambda x: escape(_text(x)),
    "one_line": lambda x: one_line(_text(x)),
    "trim": lambda x: _text(x).strip(),
    "upper": lambda x: _text(x).upper(),
    "lower": lambda x: _text(x).lower(),
    "length": len,
}


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


# --- parsing -----------------------------------------------------------------------------------

_PIECES = re.compile(r"\{%(-?)\s*(.*?)\s*(-?)%\}|\{\{(-?)\s*(.*?)\s*(-?)\}\}|\{#.*?#\}", re.S)
_WORDS = re.compile(
    r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)"
    r"|(?P<op>==|!=|<=|>=|[<>+~|.()\[\]=]))",
    re.S,
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_COMPARE = {
    "==": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
}


class _Expression:
    """Recursive descent over the words of one expression, to a tree of tuples."""

    def __init__(self, source: str):
        self.words, at = [], 0
        source = source.rstrip()
        while at < len(source):
            match = _WORDS.match(source, at)
            if not match:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.words.append((match.lastgroup, match[match.lastgroup]))
            at = match.end()
        self.at = 0

    def peek(self):
        return self.words[self.at] if self.at < len(self.words) else (None, None)

    def take(self, *values: str) -> str | None:
        if self.peek()[1] in values and self.peek()[0] != "str":
            self.at += 1
            return self.words[self.at - 1][1]
        return None

    def need(self, value: str):
        if not self.take(value):
            raise TemplateError(f"expected {value!r}, found {self.peek()[1]!r}")

    def whole(self):
        tree = self.either()
        if self.at < len(self.words):
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return tree

    def either(self):
        tree = self.both()
        while self.take("or"):
            tree = ("or", tree, self.both())
        return tree

    def both(self):
        tree = self.negated()
        while self.take("and"):
            tree = ("and", tree, self.negated())
        return tree

    def negated(self):
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self):
        tree = self.joined()
        while sign := self.take(*_COMPARE, "in"):
            tree = ("in" if sign == "in" else "compare", tree, self.joined(), sign)
        return tree

    def joined(self):
        tree = self.filtered()
        while sign := self.take("+", "~"):
            tree = ("plus" if sign == "+" else "join", tree, self.filtered())
        return tree

    def filtered(self):
        tree = self.value()
        while self.take("|"):
            _, name = self.peek()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            tree = ("filter", tree, name)
        return tree

    def value(self):
        kind, word = self.peek()
        if kind is None:
            raise TemplateError("an expression ends too early")
        self.at += 1
        if kind == "str":
            tree = ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), word[1:-1], flags=re.S))
        elif kind == "int":
            tree = ("const", int(word))
        elif kind == "name" and word in ("true", "false", "none"):
            tree = ("const", {"true": True, "false": False, "none": None}[word])
        elif kind == "name":
            tree = ("name", word)
        elif word == "(":
            tree = self.either()
            self.need(")")
        else:
            raise TemplateError(f"unexpected {word!r}")
        while sign := self.take(".", "["):
            if sign == ".":
                field = ("const", self.peek()[1])
                if self.peek()[0] != "name":
                    raise TemplateError("a field needs a name")
                self.at += 1
            else:
                field = self.either()
                self.need("]")
            tree = ("field", tree, field)
        return tree


def _split(source: str) -> list[tuple[str, str]]:
    """(kind, content) pieces: text, tag or value."""
    pieces, at, strip = [], 0, False
    for match in _PIECES.finditer(source):
        text = source[at : match.start()]
        text = text.lstrip() if strip else text
        before, after = (match[1], match[3]) if match[2] is not None else (match[4], match[6])
        pieces.append(("text", text.rstrip() if before else text))
        strip, at = bool(after), match.end()
        if match[2] is not None:
            pieces.append(("tag", match[2]))
        elif match[5] is not None:
            pieces.append(("value", match[5]))
    text = source[at:]
    pieces.append(("text", text.lstrip() if strip else text))
    return [p for p in pieces if p != ("text", "")]


def parse(source: str) -> list[tuple]:
    """The syntax tree: a list of text, value, for, if, set and generation nodes."""
    pieces = _split(source)
    body, at = _block(pieces, 0, ())
    if at < len(pieces):
        raise TemplateError(f"unexpected {pieces[at][1]!r}")
    return body


def _block(pieces, at: int, ends: tuple[str, ...]):
    body = []
    while at < len(pieces):
        kind, content = pieces[at]
        if kind == "text":
            body.append(("text", content))
        elif kind == "value":
            body.append(("value", _Expression(content).whole()))
        else:
            word = content.split(None, 1)[0] if content else ""
            rest = content[len(word) :]
            if word in ends:
                return body, at
            if word == "for":
                match = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.S)
                if not match:
                    raise TemplateError(f"cannot read {content!r}")
                inner, at = _closed(pieces, at + 1, ("endfor",))
                body.append(("for", match[1], _Expression(match[2]).whole(), inner))
            elif word == "if":
                branches, test = [], _Expression(rest).whole()
                while True:
                    inner, at = _closed(pieces, at + 1, ("elif", "else", "endif"))
                    branches.append((test, inner))
                    word, _, rest = pieces[at][1].partition(" ")
                    if word == "endif":
                        break
                    test = ("const", True) if word == "else" else _Expression(rest).whole()
                body.append(("if", branches))
            elif word == "set":
                match = re.fullmatch(r"\s*([A-Za-z_]\w*)\s*=(?!=)(.*)", rest, re.S)
                if not match:
                    raise TemplateError(f"cannot read {content!r}")
                body.append(("set", match[1], _Expression(match[2]).whole()))
            elif word == "generation":
                inner, at = _closed(pieces, at + 1, ("endgeneration",))
                body.append(("generation", inner))
            else:
                raise TemplateError(f"unexpected {content!r}")
        at += 1
    return body, at


def _closed(pieces, at: int, ends: tuple[str, ...]):
    inner, at = _block(pieces, at, ends)
    if at >= len(pieces):
        raise TemplateError(f"missing {ends[-1]!r}")
    return inner, at


# --- folding -------------------------------------------------------------------------------------


def fold_expression(tree: tuple) -> tuple:
    """The expression with its constant parts computed."""
    kind = tree[0]
    if kind in ("const", "name"):
        return tree
    parts = [fold_expression(p) if isinstance(p, tuple) else p for p in tree[1:]]
    tree = (kind, *parts)
    trees = [p for p in parts if isinstance(p, tuple)]
    if kind in ("and", "or") and parts[0][0] == "const":
        return parts[1] if bool(parts[0][1]) == (kind == "and") else parts[0]
    if all(p[0] == "const" for p in trees) and kind != "field":
        return ("const", _expression(tree)({}))
    return tree


def fold(body: list[tuple]) -> list[tuple]:
    """The tree with constants computed, dead branches left out and texts joined."""
    out: list[tuple] = []

    def add(node):
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in body:
        kind = node[0]
        if kind == "value":
            tree = fold_expression(node[1])
            add(("text", _text(tree[1])) if tree[0] == "const" else ("value", tree))
        elif kind == "for":
            add(("for", node[1], fold_expression(node[2]), fold(node[3])))
        elif kind == "set":
            add(("set", node[1], fold_expression(node[2])))
        elif kind == "generation":
            inner = fold(node[1])
            if inner:
                add(("generation", inner))
        elif kind == "if":
            branches = []
            for test, inner in node[1]:
                test = fold_expression(test)
                if test[0] != "const" or test[1]:
                    branches.append((test, fold(inner)))
                if test[0] == "const" and test[1]:
                    break
            if branches and branches[0][0][0] == "const":
                for inner in branches[0][1]:
                    add(inner)
            elif branches:
                add(("if", branches))
        else:
            add(node)
    return out


# --- closures ------------------------------------------------------------------------------------


def _field(value, name):
    if not isinstance(value, dict):
        return None
    return value.get(name)


def _expression(tree: tuple) -> Callable[[dict], object]:
    kind = tree[0]
    if kind == "const":
        constant = tree[1]
        return lambda env: constant
    if kind == "name":
        name = tree[1]
        return lambda env: env.get(name)
    if kind == "field":
        value, name = _expression(tree[1]), _expression(tree[2])
        return lambda env: _field(value(env), name(env))
    if kind == "filter":
        value, run = _expression(tree[1]), FILTERS[tree[2]]
        return lambda env: run(value(env))
    if kind == "not":
        value = _expression(tree[1])
        return lambda env: not value(env)
    left, right = _expression(tree[1]), _expression(tree[2])
    if kind == "and":
        return lambda env: left(env) and right(env)
    if kind == "or":
        return lambda env: left(env) or right(env)
    if kind == "in":
        return lambda env: left(env) in (right(env) or ())
    if kind == "join":
        return lambda env: _text(left(env)) + _text(right(env))
    if kind == "plus":
        return lambda env: _sum(left(env), right(env))
    compare = _COMPARE[tree[3]]
    return lambda env: compare(left(env), right(env))


def _sum(a, b):
    return a + b if isinstance(a, int) and isinstance(b, int) else _text(a) + _text(b)


Piece = tuple[str, bool]


def _with_last(items: Iterable) -> Iterator[tuple[object, bool]]:
    """Each item, and whether it is the last; reads one item ahead."""
    items = iter(items)
    for item in items:
        for following in items:
            yield item, False
            item = following
        yield item, True


def _closure(node: tuple, marked: bool) -> Callable[[dict], Iterator[Piece]]:
    kind = node[0]
    if kind == "text":
        piece = (node[1], marked)

        def run(env):
            yield piece

    elif kind == "value":
        value = _expression(node[1])

        def run(env):
            yield _text(value(env)), marked

    elif kind == "set":
        name, value = node[1], _expression(node[2])

        def run(env):
            env[name] = value(env)
            yield from ()

    elif kind == "generation":
        run = _body(node[1], True)
    elif kind == "if":
        branches = [(_expression(test), _body(inner, marked)) for test, inner in node[1]]

        def run(env):
            for test, inner in branches:
                if test(env):
                    yield from inner(env)
                    return

    else:
        name, items, inner = node[1], _expression(node[2]), _body(node[3], marked)

        def run(env):
            inside = dict(env)
            for k, (item, last) in enumerate(_with_last(items(env) or ())):
                inside[name] = item
                inside["loop"] = {"index": k + 1, "index0": k, "first": k == 0, "last": last}
                yield from inner(inside)

    return run


def _body(nodes: list[tuple], marked: bool) -> Callable[[dict], Iterator[Piece]]:
    parts = [_closure(node, marked) for node in nodes]
    if len(parts) == 1:
        return parts[0]

    def run(env):
        for part in parts:
            yield from part(env)

    return run


def compile_template(source: str) -> Callable[[dict], Iterator[Piece]]:
    """A function from values to the stream of (text, generated) pieces."""
    return _body(fold(parse(source)), False)
