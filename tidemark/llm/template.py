"""A compiler for chat templates: a small sandboxed language, its syntax tree, constant folding, and closures that render.

    {{ expression }}                              output
    {% for NAME in messages %} ... {% endfor %}   once for each message, in order
    {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}
    {% set NAME = e %}
    {% generation %} ... {% endgeneration %}      what the model is trained on
    {# comment #}                                 `-` inside any bracket drops the white space beside it

Expressions have literals, names, fields of the message, `loop.index`, `loop.index0`,
`loop.first` and `loop.last`, `or and not == != < <= > >= in + - * % ~`, parentheses and
filters `| escape`, `trim`, `upper`, `lower`, `length`, `string`.  There are no calls, no
subscripts and no attributes besides the ones named, and the only loop is the one over the
messages, so a template can neither reach Python objects nor run for ever; what it may not
use is an error when it is compiled.

Messages are read as they come, one ahead: rendering holds no conversation, and hands on
pieces of text, each with whether it is under generation, and END after each message.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, replace
from typing import Any

END = ("", None)
FIELDS = ("role", "text", "turn")
LOOP = ("index", "index0", "first", "last")
Piece = tuple[str, "bool | None"]
Env = dict[str, Any]


class TemplateError(ValueError):
    """A template that does not parse, or that uses what the sandbox does not have."""


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: str
    name: str


@dataclass(frozen=True)
class Unary:
    op: str
    x: Any


@dataclass(frozen=True)
class Binary:
    op: str
    x: Any
    y: Any


@dataclass(frozen=True)
class Filtered:
    x: Any
    name: str


@dataclass(frozen=True)
class Output:
    x: Any


@dataclass(frozen=True)
class Set:
    name: str
    x: Any


@dataclass(frozen=True)
class If:
    test: Any
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


def _text(value: Any) -> str:
    if value is None:
        return ""
    return str(value).lower() if isinstance(value, bool) else str(value)


BINARY: dict[str, Callable[[Any, Any], Any]] = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge,
    "in": lambda x, y: x in y, "+": operator.add, "-": operator.sub, "*": operator.mul, "%": operator.mod, "~": lambda x, y: _text(x) + _text(y),
}
FILTERS: dict[str, Callable[[Any], Any]] = {"trim": lambda x: _text(x).strip(), "upper": lambda x: _text(x).upper(), "lower": lambda x: _text(x).lower(), "length": lambda x: len(_text(x)), "string": _text}
#: Levels of binary operators, loosest first.
LEVELS = (("==", "!=", "<", "<=", ">", ">=", "in"), ("+", "-", "~"), ("*", "%"))
_TOKEN = re.compile(r"""\s*(?:(?P<string>'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[<>+\-*%~|().=]))""", re.S)
_SPLIT = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\})", re.S)
_WORDS = {"true": True, "false": False, "none": None}
_KEYWORDS = {"and", "or", "not", "in", "if", "elif", "else", "endif", "for", "endfor", "set", "generation", "endgeneration", *_WORDS}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class _Parser:
    """Recursive descent over the tokens of one bracket."""

    def __init__(self, source: str) -> None:
        self.tokens: list[tuple[str, str]] = []
        at, source = 0, source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m.group(m.lastgroup)))
            at = m.end()

    def peek(self) -> str | None:
        kind, value = self.tokens[0] if self.tokens else (None, None)
        return None if kind == "string" else value

    def take(self, value: str | None = None) -> tuple[str, str]:
        if not self.tokens or (value is not None and self.peek() != value):
            raise TemplateError(f"{value or 'an expression'} expected before {self.tokens[:1]}")
        return self.tokens.pop(0)

    def name(self) -> str:
        kind, value = self.take()
        if kind != "name" or value in _KEYWORDS:
            raise TemplateError(f"a name expected, not {value!r}")
        return value

    def done(self) -> None:
        if self.tokens:
            raise TemplateError(f"not expected: {self.tokens[0][1]!r}")

    def expression(self) -> Any:
        return self._logic("or", lambda: self._logic("and", self._not))

    def _logic(self, op: str, of: Callable[[], Any]) -> Any:
        x = of()
        while self.peek() == op:
            self.take()
            x = Binary(op, x, of())
        return x

    def _not(self) -> Any:
        if self.peek() == "not":
            self.take()
            return Unary("not", self._not())
        return self._binary(0)

    def _binary(self, level: int) -> Any:
        if level == len(LEVELS):
            return self._filtered()
        x = self._binary(level + 1)
        while self.peek() in LEVELS[level]:
            op = self.take()[1]
            x = Binary(op, x, self._binary(level + 1))
        return x

    def _filtered(self) -> Any:
        x = self._primary()
        while self.peek() == "|":
            self.take()
            x = Filtered(x, self.name())
        return x

    def _primary(self) -> Any:
        kind, value = self.take()
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "number":
            return Const(int(value))
        if value == "-":
            return Unary("-", self._primary())
        if value == "(":
            x = self.expression()
            self.take(")")
            return x
        if value in _WORDS:
            return Const(_WORDS[value])
        if kind == "name" and value not in _KEYWORDS:
            if self.peek() == ".":
                self.take()
                return Field(value, self.name())
            return Name(value)
        raise TemplateError(f"not expected: {value!r}")


def parse(source: str) -> tuple:
    """The syntax tree of a template: a tuple of statements."""
    parts = _SPLIT.split(source)
    for i in range(1, len(parts), 2):
        if parts[i][2] == "-":
            parts[i - 1] = parts[i - 1].rstrip()
        if parts[i][-3] == "-" and len(parts[i]) > 4:
            parts[i + 1] = parts[i + 1].lstrip()
    stray = next((p for p in parts[::2] if re.search(r"\{\{|\{%|\{#", p)), None)
    if stray is not None:
        raise TemplateError(f"a bracket is not closed in {stray!r}")
    items = iter(parts)
    body, end = _block(items, ())
    return body


def _inside(part: str) -> str:
    return part[2:-2].removeprefix("-").removesuffix("-")


def _block(items: Iterator[str], ends: tuple[str, ...]) -> tuple[tuple, _Parser | None]:
    """Statements up to one of the words in ends, and what that bracket holds."""
    out: list[Any] = []
    for part in items:
        if part.startswith("{{"):
            p = _Parser(_inside(part))
            out.append(Output(p.expression()))
            p.done()
        elif part.startswith("{%"):
            p = _Parser(_inside(part))
            word = p.take()[1]
            if word in ends:
                return tuple(out), _Ended(word, p)
            out.append(_statement(word, p, items))
        elif part and not part.startswith("{#"):
            out.append(Output(Const(part)))
    if ends:
        raise TemplateError(f"{' or '.join(ends)} is missing")
    return tuple(out), None


@dataclass
class _Ended:
    word: str
    rest: _Parser


def _statement(word: str, p: _Parser, items: Iterator[str]) -> Any:
    if word == "set":
        name = p.name()
        p.take("=")
        statement: Any = Set(name, p.expression())
        p.done()
        return statement
    if word == "for":
        name = p.name()
        p.take("in")
        if p.name() != "messages":
            raise TemplateError("only the messages can be looped over")
        p.done()
        body, end = _block(items, ("endfor",))
        end.rest.done()
        return For(name, body)
    if word == "generation":
        p.done()
        body, end = _block(items, ("endgeneration",))
        end.rest.done()
        return Generation(body)
    if word == "if":
        return _if(p, items)
    raise TemplateError(f"unknown statement {word!r}")


def _if(p: _Parser, items: Iterator[str]) -> If:
    test = p.expression()
    p.done()
    then, end = _block(items, ("elif", "else", "endif"))
    if end.word == "elif":
        return If(test, then, (_if(end.rest, items),))
    end.rest.done()
    other: tuple = ()
    if end.word == "else":
        other, end = _block(items, ("endif",))
        end.rest.done()
    return If(test, then, other)


class Compiler:
    """Folds a syntax tree with given constants, and turns it into closures."""

    def __init__(self, constants: Mapping[str, Any], filters: Mapping[str, Callable[[Any], Any]]) -> None:
        self.constants, self.filters = dict(constants), {**FILTERS, **filters}
        if "loop" in self.constants or "messages" in self.constants:
            raise TemplateError("loop and messages are no constants")

    def fold(self, x: Any) -> Any:
        """An expression with all that does not depend on messages worked out."""
        match x:
            case Name(name) if name in self.constants:
                return Const(self.constants[name])
            case Unary(op, of):
                of = self.fold(of)
                return Const(not of.value if op == "not" else -of.value) if isinstance(of, Const) else Unary(op, of)
            case Binary(op, a, b):
                a, b = self.fold(a), self.fold(b)
                if op in ("and", "or"):
                    if isinstance(a, Const):
                        return b if bool(a.value) == (op == "and") else a
                elif isinstance(a, Const) and isinstance(b, Const):
                    return Const(BINARY[op](a.value, b.value))
                return Binary(op, a, b)
            case Filtered(of, name):
                if name not in self.filters:
                    raise TemplateError(f"no filter {name!r}")
                of = self.fold(of)
                return Const(self.filters[name](of.value)) if isinstance(of, Const) else Filtered(of, name)
        return x

    def fold_all(self, body: Iterable[Any]) -> tuple:
        """Statements with constant branches chosen and neighbouring constant outputs joined."""
        out: list[Any] = []
        for s in body:
            match s:
                case Output(x):
                    folded: tuple = (Output(self.fold(x)),)
                case Set(name, x):
                    if name in self.constants or name in ("loop", "messages"):
                        raise TemplateError(f"{name} cannot be set")
                    folded = (Set(name, self.fold(x)),)
                case If(test, then, other):
                    test, then, other = self.fold(test), self.fold_all(then), self.fold_all(other)
                    folded = (then if test.value else other) if isinstance(test, Const) else (If(test, then, other),)
                case For(name, inner):
                    if name in self.constants or name in ("loop", "messages"):
                        raise TemplateError(f"{name} cannot be a loop's name")
                    folded = (replace(s, body=self.fold_all(inner)),)
                case Generation(inner):
                    folded = (Generation(self.fold_all(inner)),)
            for f in folded:
                if isinstance(f, Output) and isinstance(f.x, Const):
                    text = _text(f.x.value)
                    if out and isinstance(out[-1], Output) and isinstance(out[-1].x, Const):
                        text = out.pop().x.value + text
                    if text:
                        out.append(Output(Const(text)))
                else:
                    out.append(f)
        return tuple(out)

    def value(self, x: Any, known: frozenset[str], message: str | None) -> Callable[[Env], Any]:
        """The closure of a folded expression, where `known` names are set and `message` names the loop's message."""
        match x:
            case Const(value):
                return lambda env: value
            case Name(name):
                if name not in known:
                    raise TemplateError(f"no name {name!r} here")
                return lambda env: env[name]
            case Field(of, name):
                allowed = LOOP if of == "loop" else FIELDS
                if message is None or of not in ("loop", message) or name not in allowed:
                    raise TemplateError(f"no field {of}.{name} here")
                return lambda env: env[of][name]
            case Unary(op, of):
                inner = self.value(of, known, message)
                return (lambda env: not inner(env)) if op == "not" else (lambda env: -inner(env))
            case Binary(op, a, b):
                first, second = self.value(a, known, message), self.value(b, known, message)
                if op == "and":
                    return lambda env: first(env) and second(env)
                if op == "or":
                    return lambda env: first(env) or second(env)
                apply = BINARY[op]
                return lambda env: apply(first(env), second(env))
            case Filtered(of, name):
                inner, function = self.value(of, known, message), self.filters[name]
                return lambda env: function(inner(env))
        raise TemplateError(f"not an expression: {x!r}")

    def run(self, body: tuple, known: frozenset[str], message: str | None = None, masked: bool = False, looped: bool = False) -> Callable[[Env], Iterator[Piece]]:
        """The closure of folded statements."""
        steps: list[Callable[[Env], Iterator[Piece]]] = []
        for s in body:
            match s:
                case Output(x):
                    steps.append(self._output(self.value(x, known, message), masked))
                case Set(name, x):
                    steps.append(self._set(name, self.value(x, known, message)))
                    known = known | {name}
                case If(test, then, other):
                    # What a branch sets is known within it alone, as the other may not set it.
                    steps.append(self._branch(self.value(test, known, message), self.run(then, known, message, masked, looped), self.run(other, known, message, masked, looped)))
                case For(name, inner):
                    if message is not None or looped:
                        raise TemplateError("the messages can be looped over once")
                    looped = True
                    steps.append(self._loop(name, self.run(inner, known, name, masked, True)))
                case Generation(inner):
                    if masked:
                        raise TemplateError("generation within generation")
                    steps.append(self.run(inner, known, message, True, looped))

        def each(env: Env) -> Iterator[Piece]:
            for step in steps:
                yield from step(env)

        return each

    @staticmethod
    def _output(value: Callable[[Env], Any], masked: bool) -> Callable[[Env], Iterator[Piece]]:
        def output(env: Env) -> Iterator[Piece]:
            yield _text(value(env)), masked

        return output

    @staticmethod
    def _set(name: str, value: Callable[[Env], Any]) -> Callable[[Env], Iterator[Piece]]:
        def assign(env: Env) -> Iterator[Piece]:
            env[name] = value(env)
            return iter(())

        return assign

    @staticmethod
    def _branch(test: Callable[[Env], Any], then: Callable, other: Callable) -> Callable[[Env], Iterator[Piece]]:
        return lambda env: then(env) if test(env) else other(env)

    @staticmethod
    def _loop(name: str, body: Callable[[Env], Iterator[Piece]]) -> Callable[[Env], Iterator[Piece]]:
        def loop(env: Env) -> Iterator[Piece]:
            coming = iter(env["messages"])
            message, index = next(coming, None), 0
            while message is not None:
                after = next(coming, None)
                env[name] = message
                env["loop"] = {"index": index + 1, "index0": index, "first": index == 0, "last": after is None}
                yield from body(env)
                yield END
                message, index = after, index + 1

        return loop


def compiled(source: str, constants: Mapping[str, Any] | None = None, filters: Mapping[str, Callable[[Any], Any]] | None = None) -> Callable[[Iterable[Mapping[str, Any]]], Iterator[Piece]]:
    """A function from messages (mappings with FIELDS) to pieces (text, under generation), with END after each message."""
    compiler = Compiler(constants or {}, filters or {})
    run = compiler.run(compiler.fold_all(parse(source)), frozenset())
    return lambda messages: run({"messages": messages})
