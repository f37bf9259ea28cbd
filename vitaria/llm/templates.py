"""A small sandboxed template language, compiled to Python closures.

``{{ expression }}`` writes a value, ``{% ... %}`` holds ``for``/``endfor``,
``if``/``elif``/``else``/``endif``, ``set`` and ``generation``/``endgeneration``; a ``-`` beside a
mark takes the white space there away. Expressions know literals, names, ``.field``, ``[index]``, ``+``,
``~``, comparisons, ``in``, ``and``, ``or``, ``not`` and filters after ``|``. There are no calls, a
field is a key of a mapping and never an attribute, and only the given filters can
be named, so a template reaches nothing but its input.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

_MARK = re.compile(r"(\{\{-?|\{%-?)(.*?)(-?\}\}|-?%\})", re.S)
_TOKEN = re.compile(r"\s*(?:(\d+)|('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+~<>|.\[\]()=]))", re.S)
_STRING_MARKS = {"n": "\n", "t": "\t", "r": "\r"}


class TemplateError(ValueError):
    """A template that cannot be compiled, or that asks for what is not there."""


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    base: Any
    key: Any


@dataclass(frozen=True)
class Apply:
    """An operator or a filter with its operands."""

    name: str
    args: tuple


@dataclass(frozen=True)
class Write:
    value: Any


@dataclass(frozen=True)
class Assign:
    name: str
    value: Any


@dataclass(frozen=True)
class Choose:
    arms: tuple  # of (condition, body)


@dataclass(frozen=True)
class Loop:
    name: str
    values: Any
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


@dataclass
class Output:
    """Rendered parts, and the spans that generation blocks wrote, in code points."""

    parts: list[str] = field(default_factory=list)
    length: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


_OPERATORS: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "+": lambda a, b: a + b, "-": lambda a, b: a - b,
    "~": lambda a, b: _text(a) + _text(b), "in": lambda a, b: a in b, "not": lambda a: not a, "item": lambda a, b: _item(a, b),
}
FILTERS: dict[str, Callable] = {
    "trim": lambda x: _text(x).strip(), "upper": lambda x: _text(x).upper(), "lower": lambda x: _text(x).lower(), "length": len,
}


def _text(value: Any) -> str:
    return "" if value is None else str(value)


def _item(base: Any, key: Any) -> Any:
    if isinstance(base, Mapping):
        return base.get(key)
    if isinstance(base, (list, tuple, str)) and isinstance(key, int):
        return base[key] if -len(base) <= key < len(base) else None
    raise TemplateError(f"no field {key!r} here")


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str, filters: Mapping[str, Callable]):
        self.tokens, self.filters, at = [], filters, 0
        while source[at:].strip():
            if not (found := _TOKEN.match(source, at)):
                raise TemplateError(f"unexpected {source[at:].strip()[:20]!r}")
            self.tokens.append((found.lastindex, found[found.lastindex]))
            at = found.end()

    def peek(self) -> str | None:
        return self.tokens[0][1] if self.tokens and self.tokens[0][0] != 2 else None

    def take(self, *wanted: str) -> str:
        if not self.tokens or wanted and self.peek() not in wanted:
            raise TemplateError(f"expected {' or '.join(wanted) or 'more'}")
        return self.tokens.pop(0)[1]

    def whole(self) -> Any:
        node = self.either()
        if self.tokens:
            raise TemplateError(f"unexpected {self.tokens[0][1]!r}")
        return node

    def either(self) -> Any:
        node = self.both()
        while self.peek() == "or":
            self.take()
            node = Apply("or", (node, self.both()))
        return node

    def both(self) -> Any:
        node = self.negated()
        while self.peek() == "and":
            self.take()
            node = Apply("and", (node, self.negated()))
        return node

    def negated(self) -> Any:
        if self.peek() == "not":
            self.take()
            return Apply("not", (self.negated(),))
        node = self.joined()
        while (sign := self.peek()) in ("==", "!=", "<", ">", "<=", ">=", "in"):
            self.take()
            node = Apply(sign, (node, self.joined()))
        return node

    def joined(self) -> Any:
        node = self.filtered()
        while (sign := self.peek()) in ("+", "-", "~"):
            self.take()
            node = Apply(sign, (node, self.filtered()))
        return node

    def filtered(self) -> Any:
        node = self.primary()
        while (sign := self.peek()) in (".", "[", "|"):
            self.take()
            if sign == "|":
                if (name := self.take()) not in self.filters:
                    raise TemplateError(f"no filter {name!r}")
                node = Apply("|" + name, (node,))
            elif sign == ".":
                node = Item(node, Const(self._name()))
            else:
                node = Item(node, self.either())
                self.take("]")
        return node

    def _name(self) -> str:
        if not self.tokens or self.tokens[0][0] != 3 or self.tokens[0][1].startswith("_"):
            raise TemplateError("expected a name that does not begin with _")
        return self.take()

    def primary(self) -> Any:
        kind, word = self.tokens[0] if self.tokens else (0, "")
        if kind == 1:
            return Const(int(self.take()))
        if kind == 2:
            self.tokens.pop(0)
            return Const(re.sub(r"\\(.)", lambda m: _STRING_MARKS.get(m[1], m[1]), word[1:-1], flags=re.S))
        if word == "(":
            self.take()
            node = self.either()
            self.take(")")
            return node
        if word in ("true", "false", "none"):
            return Const({"true": True, "false": False, "none": None}[self.take()])
        return Name(self._name())


def parse(source: str, filters: Mapping[str, Callable]) -> tuple:
    """Syntax tree of a template: a tuple of statements."""
    pieces: list[tuple[str, str]] = []
    at, strip = 0, False
    for mark in _MARK.finditer(source):
        text = source[at : mark.start()]
        text = text.lstrip() if strip else text
        pieces.append(("text", text.rstrip() if mark[1].endswith("-") else text))
        if mark[1][1] != ("{" if mark[3].endswith("}}") else "%"):
            raise TemplateError(f"unmatched {mark[1]}")
        pieces.append(("write" if mark[1][1] == "{" else "statement", mark[2].strip()))
        at, strip = mark.end(), mark[3].startswith("-")
    pieces.append(("text", source[at:].lstrip() if strip else source[at:]))
    expression = lambda text: _Expression(text, filters).whole()

    def body(*ends: str) -> tuple[tuple, str]:
        nodes = []
        while pieces:
            kind, text = pieces.pop(0)
            word, _, rest = text.partition(" ")
            if kind == "text":
                nodes.append(Write(Const(text)))
            elif kind == "write":
                nodes.append(Write(expression(text)))
            elif word in ends:
                return tuple(nodes), text
            elif word == "for" and (found := re.fullmatch(r"([A-Za-z]\w*)\s+in\s+(.+)", rest.strip(), re.S)):
                inner, _ = body("endfor")
                nodes.append(Loop(found[1], expression(found[2]), inner))
            elif word == "if":
                arms, condition = [], expression(rest)
                while True:
                    inner, end = body("elif", "else", "endif")
                    arms.append((condition, inner))
                    if end == "endif":
                        break
                    condition = Const(True) if end == "else" else expression(end.partition(" ")[2])
                nodes.append(Choose(tuple(arms)))
            elif word == "set" and (found := re.fullmatch(r"([A-Za-z]\w*)\s*=\s*(.+)", rest.strip(), re.S)):
                nodes.append(Assign(found[1], expression(found[2])))
            elif word == "generation":
                nodes.append(Generation(body("endgeneration")[0]))
            else:
                raise TemplateError(f"unexpected statement {text!r}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return tuple(nodes), ""

    return body()[0]


def _call(name: str, filters: Mapping[str, Callable]) -> Callable:
    return filters[name[1:]] if name.startswith("|") else _OPERATORS[name]


def fold(node: Any, filters: Mapping[str, Callable]) -> Any:
    """The same tree with what is constant worked out, dead arms gone and neighbouring texts joined."""
    if isinstance(node, tuple):
        out: list = []
        for part in (fold(n, filters) for n in node):
            parts = part if isinstance(part, tuple) else (part,)
            for p in parts:
                if isinstance(p, Write) and isinstance(p.value, Const):
                    text = _text(p.value.value)
                    if out and isinstance(out[-1], Write) and isinstance(out[-1].value, Const):
                        out[-1] = Write(Const(out[-1].value.value + text))
                    elif text:
                        out.append(Write(Const(text)))
                else:
                    out.append(p)
        return tuple(out)
    if isinstance(node, Apply):
        args = tuple(fold(a, filters) for a in node.args)
        if node.name in ("and", "or") and isinstance(args[0], Const):
            return args[1] if bool(args[0].value) == (node.name == "and") else args[0]
        if node.name not in ("and", "or") and all(isinstance(a, Const) for a in args):
            return Const(_call(node.name, filters)(*(a.value for a in args)))
        return Apply(node.name, args)
    if isinstance(node, Item):
        base, key = fold(node.base, filters), fold(node.key, filters)
        return Const(_item(base.value, key.value)) if isinstance(base, Const) and isinstance(key, Const) else Item(base, key)
    if isinstance(node, Write):
        return Write(fold(node.value, filters))
    if isinstance(node, Assign):
        return Assign(node.name, fold(node.value, filters))
    if isinstance(node, Loop):
        return Loop(node.name, fold(node.values, filters), fold(node.body, filters))
    if isinstance(node, Generation):
        return Generation(fold(node.body, filters))
    if isinstance(node, Choose):
        arms = []
        for condition, inner in node.arms:
            condition = fold(condition, filters)
            if isinstance(condition, Const) and not condition.value:
                continue
            arms.append((condition, fold(inner, filters)))
            if isinstance(condition, Const):
                break
        if arms and isinstance(arms[0][0], Const):
            return arms[0][1]
        return Choose(tuple(arms)) if arms else ()
    return node


def _value(node: Any, filters: Mapping[str, Callable]) -> Callable[[dict], Any]:
    """Closure that gives an expression's value in a scope."""
    if isinstance(node, Const):
        return lambda scope, v=node.value: v
    if isinstance(node, Name):
        return lambda scope, n=node.name: scope.get(n)
    if isinstance(node, Item):
        base, key = _value(node.base, filters), _value(node.key, filters)
        return lambda scope: _item(base(scope), key(scope))
    args = [_value(a, filters) for a in node.args]
    if node.name == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if node.name == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    call = _call(node.name, filters)
    if len(args) == 1:
        only = args[0]
        return lambda scope: call(only(scope))
    left, right = args
    return lambda scope: call(left(scope), right(scope))


def _closure(node: Any, filters: Mapping[str, Callable]) -> Callable[[dict, Output], None]:
    """Closure that runs a statement or a body."""
    if isinstance(node, tuple):
        steps = [_closure(n, filters) for n in node]

        def every(scope: dict, out: Output) -> None:
            for step in steps:
                step(scope, out)

        return every
    if isinstance(node, Write):
        value = _value(node.value, filters)
        return lambda scope, out: out.write(_text(value(scope)))
    if isinstance(node, Assign):
        value = _value(node.value, filters)
        return lambda scope, out: scope.__setitem__(node.name, value(scope))
    if isinstance(node, Generation):
        body = _closure(node.body, filters)

        def generation(scope: dict, out: Output) -> None:
            start = out.length
            body(scope, out)
            out.spans.append((start, out.length))

        return generation
    if isinstance(node, Choose):
        arms = [(_value(condition, filters), _closure(body, filters)) for condition, body in node.arms]

        def choose(scope: dict, out: Output) -> None:
            for condition, body in arms:
                if condition(scope):
                    return body(scope, out)

        return choose
    values, body = _value(node.values, filters), _closure(node.body, filters)

    def loop(scope: dict, out: Output) -> None:
        items = list(values(scope) or ())
        for i, item in enumerate(items):
            state = {"index": i + 1, "index0": i, "first": i == 0, "last": i == len(items) - 1}
            body(scope | {node.name: item, "loop": state}, out)

    return loop


def compile_template(source: str, filters: Mapping[str, Callable] | None = None) -> Callable[[Mapping], Output]:
    """Function from a scope to what the template writes for it."""
    known = FILTERS | dict(filters or {})
    run = _closure(fold(parse(source, known), known), known)

    def render(scope: Mapping) -> Output:
        out = Output()
        run(dict(scope), out)
        return out

    return render
