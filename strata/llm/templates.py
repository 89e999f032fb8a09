"""A small sandboxed template language, compiled to Python closures.

``{{ value }}`` prints, ``{% if %} / elif / else / endif``, ``{% for x in values %} ... endfor`` (with ``loop.first``, ``loop.last``, ``loop.index0``),
``{% set name = value %}`` and ``{% generation %} ... endgeneration``, which marks text that a model is to learn. A ``-`` beside a tag's
percent sign or brace takes the white space on that side away.
Values are strings, whole numbers, true, false, none, names, ``x.key`` and ``x[key]`` of dictionaries and lists, ``+ - * %``, ``~`` (joins texts),
comparisons, ``in``, ``not``, ``and``, ``or``, ``a if c else b`` and ``value | filter``.

**Sandbox.** A template reads nothing but the given data and the given filters: ``x.key`` looks keys up in dictionaries and never
reaches an attribute of an object, there are no calls, and loops run over lists only, so each template ends. Numbers and texts can't grow past ``MOST``.

**Compilation.** Source becomes a syntax tree; constant parts of it are computed once (folded), branches that are never taken are dropped and
neighbouring texts joined; each node that is left becomes a closure. Rendering runs the closures, generators of texts and marks, so a long
list of messages can be rendered without being held.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

#: Longest text and largest number that an operator of a template makes.
MOST = 1 << 24
BEGIN, END = object(), object()  # marks around what is to be learnt


class TemplateError(ValueError):
    """The template is not in the language, or asks for what there is not."""


# ---------------------------------------------------------------- syntax tree
@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: object
    key: object


@dataclass(frozen=True)
class Op:
    name: str
    parts: tuple


@dataclass(frozen=True)
class Filter:
    name: str
    of: object


@dataclass(frozen=True)
class Choice:
    test: object
    then: object
    other: object


@dataclass(frozen=True)
class Print:
    value: object


@dataclass(frozen=True)
class Block:
    nodes: tuple


@dataclass(frozen=True)
class If:
    test: object
    then: Block
    other: Block


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: Block


@dataclass(frozen=True)
class Set:
    name: str
    value: object


@dataclass(frozen=True)
class Generation:
    body: Block


# ---------------------------------------------------------------- parser
TEXT = r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\""
TAG = re.compile(r"\{\{(-?)((?:" + TEXT + r"|[^'\"])*?)(-?)\}\}|\{%(-?)((?:" + TEXT + r"|[^'\"])*?)(-?)%\}", re.S)
TOKEN = re.compile(r"\s*(?:(?P<text>" + TEXT + r")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|[-+*%~|.,<>()\[\]=]))", re.S)
ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}
WORDS = {"and", "or", "not", "in", "if", "else"}
CONSTANTS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
LEVELS = ({"==", "!=", "<", ">", "<=", ">=", "in"}, {"~"}, {"+", "-"}, {"*", "%"})


class Expression:
    """Recursive descent over one tag's tokens, loosest operators first."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"not understood: {source[at : at + 20]!r}")
            self.tokens.append((m.lastgroup, m.group(m.lastgroup)))
            at = m.end()
        self.at = 0

    def next_is(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "text" and self.tokens[self.at][1] in values

    def take(self, *values: str):
        if values and not self.next_is(*values):
            raise TemplateError(f"expected {' or '.join(values)}")
        if self.at == len(self.tokens):
            raise TemplateError("the tag ends too early")
        self.at += 1
        return self.tokens[self.at - 1]

    def name(self) -> str:
        kind, value = self.take()
        if kind != "name" or value in WORDS or value in CONSTANTS:
            raise TemplateError(f"a name is needed, not {value!r}")
        return value

    def end(self):
        if self.at < len(self.tokens):
            raise TemplateError(f"left over: {self.tokens[self.at][1]!r}")

    def value(self):
        found = self.either()
        if self.next_is("if"):
            self.take()
            test = self.either()
            self.take("else")
            found = Choice(test, found, self.value())
        return found

    def either(self):
        found = self.both()
        while self.next_is("or"):
            self.take()
            found = Op("or", (found, self.both()))
        return found

    def both(self):
        found = self.negated()
        while self.next_is("and"):
            self.take()
            found = Op("and", (found, self.negated()))
        return found

    def negated(self):
        if self.next_is("not"):
            self.take()
            return Op("not", (self.negated(),))
        return self.binary(0)

    def binary(self, level: int):
        if level == len(LEVELS):
            return self.filtered()
        found = self.binary(level + 1)
        while self.next_is(*LEVELS[level]) or (level == 0 and self.next_is("not")):
            if self.next_is("not"):
                self.take()
                self.take("in")
                found = Op("not", (Op("in", (found, self.binary(1))),))
            else:
                found = Op(self.take()[1], (found, self.binary(level + 1)))
        return found

    def filtered(self):
        found = self.item()
        while self.next_is("|"):
            self.take()
            found = Filter(self.name(), found)
        return found

    def item(self):
        found = self.atom()
        while self.next_is(".", "["):
            if self.take()[1] == ".":
                found = Item(found, Const(self.name()))
            else:
                found = Item(found, self.value())
                self.take("]")
        return found

    def atom(self):
        if self.next_is("-"):
            self.take()
            return Op("-", (Const(0), self.atom()))
        if self.next_is("("):
            self.take()
            found = self.value()
            self.take(")")
            return found
        kind, value = self.take()
        if kind == "text":
            return Const(re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[0]), value[1:-1], flags=re.S))
        if kind == "number":
            return Const(int(value))
        if kind == "name" and value in CONSTANTS:
            return Const(CONSTANTS[value])
        if kind == "name" and value not in WORDS:
            return Name(value)
        raise TemplateError(f"a value is needed, not {value!r}")


def parse(source: str) -> Block:
    """Syntax tree of a template."""
    stack: list[tuple] = [("", None, [])]  # open tag, what it knows, its nodes
    at, strip = 0, False

    def text(upto, strip_right):
        some = source[at:upto]
        some = some.lstrip() if strip else some
        some = some.rstrip() if strip_right else some
        if some:
            stack[-1][2].append(Print(Const(some)))

    for m in TAG.finditer(source):
        text(m.start(), bool(m[1] or m[4]))
        at, strip = m.end(), bool(m[3] or m[6])
        if m[2] is not None:
            e = Expression(m[2])
            stack[-1][2].append(Print(e.value()))
            e.end()
            continue
        e = Expression(m[5])
        word = e.take()[1]
        if word == "if":
            stack.append(("if", e.value(), []))
        elif word in ("elif", "else") and stack[-1][0] == "if":
            stack.append(("elif", e.value(), []) if word == "elif" else ("else", None, []))
            if word == "elif":
                stack[-1] = ("if", stack[-1][1], [])
                stack[-2] = ("chain", *stack[-2][1:])
        elif word == "endif" and stack[-1][0] in ("if", "else"):
            other = Block(())
            if stack[-1][0] == "else":
                other = Block(tuple(stack.pop()[2]))
            _, test, nodes = stack.pop()
            other = If(test, Block(tuple(nodes)), other)
            while stack[-1][0] == "chain":  # from the last elif back to the if
                _, test, nodes = stack.pop()
                other = If(test, Block(tuple(nodes)), Block((other,)))
            stack[-1][2].append(other)
        elif word == "for":
            name = e.name()
            e.take("in")
            stack.append(("for", (name, e.value()), []))
        elif word == "endfor" and stack[-1][0] == "for":
            _, (name, over), nodes = stack.pop()
            stack[-1][2].append(For(name, over, Block(tuple(nodes))))
        elif word == "set":
            name = e.name()
            e.take("=")
            stack[-1][2].append(Set(name, e.value()))
        elif word == "generation":
            if any(s[0] == "generation" for s in stack):
                raise TemplateError("generation inside generation")
            stack.append(("generation", None, []))
        elif word == "endgeneration" and stack[-1][0] == "generation":
            nodes = stack.pop()[2]
            stack[-1][2].append(Generation(Block(tuple(nodes))))
        else:
            raise TemplateError(f"misplaced or unknown tag: {word!r}")
        e.end()
    text(len(source), False)
    if len(stack) > 1:
        raise TemplateError(f"not closed: {stack[-1][0]!r}")
    return Block(tuple(stack[0][2]))


# ---------------------------------------------------------------- operations
def bounded(value):
    if isinstance(value, str) and len(value) > MOST or isinstance(value, int) and abs(value) > MOST:
        raise TemplateError("a value of the template is too large")
    return value


def plain(value) -> str:
    """A value as text: none prints nothing."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str | int):
        return str(value)
    raise TemplateError("only texts and numbers print")


def typed(act: Callable, *kinds: type) -> Callable:
    def checked(a, b):
        for kind in kinds:
            if isinstance(a, kind) and isinstance(b, kind):
                return bounded(act(a, b))
        raise TemplateError(f"no such operation on {type(a).__name__} and {type(b).__name__}")

    return checked


def remainder(a, b):
    if b == 0:
        raise TemplateError("division by zero")
    return a % b


def contains(a, b):
    if isinstance(b, list | dict) or isinstance(b, str) and isinstance(a, str):
        return a in b
    raise TemplateError("in needs a list, a dictionary or texts")


BINARY = {"==": operator.eq, "!=": operator.ne, "<": typed(operator.lt, int, str), ">": typed(operator.gt, int, str), "<=": typed(operator.le, int, str),
          ">=": typed(operator.ge, int, str), "+": typed(operator.add, int, str), "-": typed(operator.sub, int), "*": typed(operator.mul, int),
          "%": typed(remainder, int), "~": lambda a, b: bounded(plain(a) + plain(b)), "in": contains}
FILTERS: dict[str, Callable] = {"trim": lambda x: plain(x).strip(), "upper": lambda x: plain(x).upper(), "lower": lambda x: plain(x).lower(), "length": len}


def look_up(of, key):
    """A key of a dictionary or a place in a list; nothing else."""
    try:
        if isinstance(of, dict) or isinstance(of, list) and isinstance(key, int):
            return of[key]
    except (KeyError, IndexError):
        pass
    raise TemplateError(f"nothing at {key!r}")


# ---------------------------------------------------------------- folding
def folded(node, filters: dict):
    """The tree with constant parts computed, dead branches dropped and neighbouring texts joined."""
    match node:
        case Op(name, parts):
            parts = tuple(folded(p, filters) for p in parts)
            if name in ("and", "or") and isinstance(parts[0], Const):
                return parts[1] if bool(parts[0].value) == (name == "and") else parts[0]
            if all(isinstance(p, Const) for p in parts):
                values = [p.value for p in parts]
                return Const(not values[0] if name == "not" else BINARY[name](*values))
            return Op(name, parts)
        case Filter(name, of):
            of = folded(of, filters)
            if name not in filters:
                raise TemplateError(f"no filter {name!r}")
            return Const(filters[name](of.value)) if isinstance(of, Const) else Filter(name, of)
        case Item(of, key):
            return Item(folded(of, filters), folded(key, filters))
        case Choice(test, then, other):
            test = folded(test, filters)
            if isinstance(test, Const):
                return folded(then if test.value else other, filters)
            return Choice(test, folded(then, filters), folded(other, filters))
        case Print(value):
            value = folded(value, filters)
            return Print(Const(plain(value.value))) if isinstance(value, Const) else Print(value)
        case Block(nodes):
            out: list = []
            for n in nodes:
                n = folded(n, filters)
                for x in n.nodes if isinstance(n, Block) else (n,):
                    if isinstance(x, Print) and isinstance(x.value, Const):
                        if not x.value.value:
                            continue
                        if out and isinstance(out[-1], Print) and isinstance(out[-1].value, Const):
                            out[-1] = Print(Const(out[-1].value.value + x.value.value))
                            continue
                    out.append(x)
            return Block(tuple(out))
        case If(test, then, other):
            test, then, other = folded(test, filters), folded(then, filters), folded(other if isinstance(other, Block) else Block((other,)), filters)
            if isinstance(test, Const):
                return then if test.value else other
            return If(test, then, other)
        case For(name, over, body):
            return For(name, folded(over, filters), folded(body, filters))
        case Set(name, value):
            return Set(name, folded(value, filters))
        case Generation(body):
            return Generation(folded(body, filters))
    return node


# ---------------------------------------------------------------- closures
def value_of(node, filters: dict) -> Callable[[dict], object]:
    """A closure that computes an expression from the names known."""
    match node:
        case Const(value):
            return lambda env: value
        case Name(name):
            def named(env):
                if name not in env:
                    raise TemplateError(f"no name {name!r}")
                return env[name]
            return named
        case Item(of, key):
            of, key = value_of(of, filters), value_of(key, filters)
            return lambda env: look_up(of(env), key(env))
        case Filter(name, of):
            act, of = filters[name], value_of(of, filters)
            return lambda env: bounded(act(of(env)))
        case Choice(test, then, other):
            test, then, other = (value_of(x, filters) for x in (test, then, other))
            return lambda env: then(env) if test(env) else other(env)
        case Op("not", (a,)):
            a = value_of(a, filters)
            return lambda env: not a(env)
        case Op("and", (a, b)):
            a, b = value_of(a, filters), value_of(b, filters)
            return lambda env: a(env) and b(env)
        case Op("or", (a, b)):
            a, b = value_of(a, filters), value_of(b, filters)
            return lambda env: a(env) or b(env)
        case Op(name, (a, b)):
            act, a, b = BINARY[name], value_of(a, filters), value_of(b, filters)
            return lambda env: act(a(env), b(env))
    raise TemplateError("not a value")


def looked_ahead(values: Iterable) -> Iterator[tuple[int, object, bool]]:
    """(number, value, is it the last one)."""
    values = iter(values)
    for k, now in enumerate(values):
        break
    else:
        return
    for following in values:
        yield k, now, False
        k, now = k + 1, following
    yield k, now, True


def writer(node, filters: dict) -> Callable[[dict], Iterator]:
    """A closure that yields the texts and marks of a node."""
    match node:
        case Block(nodes):
            parts = [writer(n, filters) for n in nodes]

            def block(env):
                for p in parts:
                    yield from p(env)
            return block
        case Print(Const(value)):
            return lambda env: iter((value,))
        case Print(value):
            value = value_of(value, filters)
            return lambda env: iter((plain(value(env)),))
        case If(test, then, other):
            test, then, other = value_of(test, filters), writer(then, filters), writer(other, filters)
            return lambda env: then(env) if test(env) else other(env)
        case Set(name, value):
            value = value_of(value, filters)

            def assign(env):
                env[name] = value(env)
                return iter(())
            return assign
        case For(name, over, body):
            over, body = value_of(over, filters), writer(body, filters)

            def loop(env):
                values = over(env)
                if isinstance(values, str | dict) or not isinstance(values, list | Stream):
                    raise TemplateError("a loop needs a list")
                inner = dict(env)
                for k, value, last in looked_ahead(values):
                    inner[name] = value
                    inner["loop"] = {"index0": k, "index": k + 1, "first": k == 0, "last": last}
                    yield from body(inner)
            return loop
        case Generation(body):
            body = writer(body, filters)

            def marked(env):
                yield BEGIN
                yield from body(env)
                yield END
            return marked
    raise TemplateError("not a statement")


class Stream:
    """Values that can be gone over once."""

    def __init__(self, values: Iterable):
        self.values = values

    def __iter__(self):
        return iter(self.values)


def uses(node, name: str) -> tuple[int, int]:
    """How often a tree uses a name, and how often as what an outer loop goes over."""
    every = outer = 0

    def walk(n, depth):
        nonlocal every, outer
        if isinstance(n, Name):
            every += n.name == name
        if isinstance(n, For):
            outer += depth == 0 and n.over == Name(name)
        for field in getattr(n, "__dataclass_fields__", ()):
            x = getattr(n, field)
            for y in x if isinstance(x, tuple) else (x,):
                if hasattr(y, "__dataclass_fields__"):
                    walk(y, depth + (isinstance(n, For) and field == "body"))

    walk(node, 0)
    return every, outer


class Template:
    """A compiled template. ``streams``: its only use of ``messages`` is one loop, so they need not be held."""

    def __init__(self, source: str, filters: dict[str, Callable] | None = None):
        known = FILTERS | (filters or {})
        self.tree = folded(parse(source), known)
        self.run = writer(self.tree, known)
        self.streams = uses(self.tree, "messages") == (1, 1)

    def parts(self, messages: Iterable[dict], **names) -> Iterator:
        """Texts and the marks ``BEGIN`` and ``END``."""
        return self.run({**names, "messages": Stream(messages) if self.streams else list(messages)})

    def render(self, messages: Iterable[dict], **names) -> tuple[str, list[tuple[int, int]]]:
        """The text, and (begin, end) in code points of what is to be learnt."""
        out, spans, at, begin = [], [], 0, 0
        for p in self.parts(messages, **names):
            if p is BEGIN:
                begin = at
            elif p is END:
                spans.append((begin, at))
            else:
                out.append(p)
                at += len(p)
        return "".join(out), spans
