"""A sandboxed template language, compiled to Python closures.

    {{ expression }}   {% for x in e %} .. {% endfor %}   {% if e %} .. {% elif e %} .. {% else %} .. {% endif %}
    {% set x = e %}    {% generation %} .. {% endgeneration %}    {# a comment #}    {%- and -%} trim white space

Expressions: strings, numbers, true, false, none, [lists], names, a.b and a[b] (keys of mappings and positions of lists
only, never attributes of Python objects), or and not, == != < <= > >= in, ~ + - * // %, a if c else b, and filters:
escape, trim, upper, lower, length, string, default(x), replace(a, b), join(x). There is no call, import, or
assignment to anything but a name, and output is limited.

A template is parsed to a syntax tree, constants are folded (operators, filters and conditions over literals,
neighbouring texts), and each node becomes a closure over its children. Rendering gives the text and the spans that
{% generation %} marks."""

from __future__ import annotations

import operator
import re
from collections.abc import Callable
from dataclasses import dataclass

#: Characters that one rendering may produce, and characters of a template.
MOST, SOURCE = 1 << 30, 1 << 15
#: Rounds of loops: at least, and for each item given.
ROUNDS = 10_000, 20
#: Characters made: at least, for each character given and for each item given.
CHARACTERS = 1 << 20, 16, 4096
#: Places that a list made by a template may have, lists inside it included.
PLACES = 10_000


class TemplateError(ValueError):
    """A template that can't be parsed, or can't be rendered over its values."""


# -- syntax tree ----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Text:
    text: str


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
class Unary:
    op: str
    of: object


@dataclass(frozen=True)
class Binary:
    op: str
    left: object
    right: object


@dataclass(frozen=True)
class Choice:
    test: object
    yes: object
    no: object


@dataclass(frozen=True)
class Filter:
    name: str
    of: object
    args: tuple


@dataclass(frozen=True)
class ListOf:
    items: tuple


@dataclass(frozen=True)
class Output:
    of: object


@dataclass(frozen=True)
class If:
    test: object
    yes: tuple
    no: tuple


@dataclass(frozen=True)
class For:
    name: str
    of: object
    body: tuple


@dataclass(frozen=True)
class Set:
    name: str
    of: object


@dataclass(frozen=True)
class Generation:
    body: tuple


# -- parser ---------------------------------------------------------------------------------------------------------

_TAGS = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#(-?)(.*?)(-?)#\}", re.DOTALL)
_TOKEN = re.compile(r"\s*(?:(\d+(?:\.\d+)?)|('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([A-Za-z_]\w*)|(==|!=|<=|>=|//|[-+*%~<>()\[\].,|=]))", re.DOTALL)
_WORDS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
_KEYWORDS = {"or", "and", "not", "in", "if", "else"}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class _Expression:
    """Recursive descent over one tag's tokens."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, object]] = []
        at, source = 0, source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            number, string, word, sign = m.groups()
            if number and len(number) > 20:
                raise TemplateError("too large")
            elif number:
                self.tokens.append(("const", float(number) if "." in number else int(number)))
            elif string:
                self.tokens.append(("const", re.sub(r"\\(.)", lambda e: _ESCAPES.get(e[1], e[1]), string[1:-1], flags=re.DOTALL)))
            elif word in _WORDS:
                self.tokens.append(("const", _WORDS[word]))
            elif word:
                self.tokens.append(("key" if word in _KEYWORDS else "name", word))
            else:
                self.tokens.append(("sign", sign))
            at = m.end()
        self.at = 0

    def peek(self, *what: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] in ("sign", "key") and self.tokens[self.at][1] in what:
            return str(self.tokens[self.at][1])
        return None

    def take(self, *what: str) -> str | None:
        if found := self.peek(*what):
            self.at += 1
        return found

    def need(self, what: str) -> None:
        if not self.take(what):
            raise TemplateError(f"{what!r} is missing")

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return str(self.tokens[self.at - 1][1])
        raise TemplateError("a name is missing")

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.tokens[self.at][1]!r} is too much")

    def whole(self) -> object:
        found = self.choice()
        self.end()
        return found

    def choice(self) -> object:
        yes = self.chain(0)
        if self.take("if"):
            test = self.chain(0)
            return Choice(test, yes, self.choice() if self.take("else") else Const(""))
        return yes

    LEVELS = (("or",), ("and",), ("not",), ("==", "!=", "<", "<=", ">", ">=", "in"), ("~",), ("+", "-"), ("*", "//", "%"))

    def chain(self, level: int) -> object:
        if level == len(self.LEVELS):
            return self.unary()
        if self.LEVELS[level] == ("not",):
            return Unary("not", self.chain(level)) if self.take("not") else self.chain(level + 1)
        left = self.chain(level + 1)
        while op := self.take(*self.LEVELS[level]):
            left = Binary(op, left, self.chain(level + 1))
        return left

    def unary(self) -> object:
        return Unary("-", self.unary()) if self.take("-") else self.postfix()

    def postfix(self) -> object:
        found = self.atom()
        while op := self.take(".", "[", "|"):
            if op == ".":
                found = Item(found, Const(self.name()))
            elif op == "[":
                found = Item(found, self.choice())
                self.need("]")
            else:
                name = self.name()
                if name not in FILTERS:
                    raise TemplateError(f"there is no filter {name!r}")
                found = Filter(name, found, tuple(self.items(")")) if self.take("(") else ())
        return found

    def items(self, close: str) -> list:
        out = []
        while not self.take(close):
            out.append(self.choice())
            if not self.peek(close):
                self.need(",")
        return out

    def atom(self) -> object:
        if self.take("("):
            found = self.choice()
            self.need(")")
            return found
        if self.take("["):
            return ListOf(tuple(self.items("]")))
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "const":
            self.at += 1
            return Const(self.tokens[self.at - 1][1])
        return Name(self.name())


def parse(source: str) -> tuple:
    """The template's nodes."""
    pieces: list[tuple[str, str]] = []
    at, trim = 0, False
    for m in _TAGS.finditer(source):
        before, kind = source[at : m.start()], next(k for k in (0, 3, 6) if m.group(k + 2) is not None)
        before = before.lstrip() if trim else before
        pieces.append(("text", before.rstrip() if m.group(kind + 1) else before))
        pieces.append((("print", "tag", "comment")[kind // 3], m.group(kind + 2).strip()))
        at, trim = m.end(), bool(m.group(kind + 3))
    rest = source[at:].lstrip() if trim else source[at:]
    pieces.append(("text", rest))
    position = 0

    def block(*stops: str) -> tuple[tuple, str]:
        nonlocal position
        out: list = []
        while position < len(pieces):
            kind, text = pieces[position]
            position += 1
            if kind == "text" and text:
                out.append(Text(text))
            elif kind == "print":
                out.append(Output(_Expression(text).whole()))
            elif kind == "tag":
                word, _, more = text.partition(" ")
                if word in stops:
                    return tuple(out), text
                out.append(statement(word, more))
        if stops:
            raise TemplateError(f"{' or '.join(stops)} is missing")
        return tuple(out), ""

    def condition(more: str) -> If:
        test = _Expression(more).whole()
        yes, stop = block("elif", "else", "endif")
        word, _, rest = stop.partition(" ")
        return If(test, yes, (condition(rest),) if word == "elif" else block("endif")[0] if word == "else" else ())

    def statement(word: str, more: str) -> object:
        if word == "if":
            return condition(more)
        if word == "generation":
            return Generation(block("endgeneration")[0])
        e = _Expression(more)
        if word == "for":
            name = e.name()
            e.need("in")
            return For(name, e.whole(), block("endfor")[0])
        if word == "set":
            name = e.name()
            e.need("=")
            return Set(name, e.whole())
        raise TemplateError(f"there is no tag {word!r}")

    return block()[0]


# -- meaning of operators and filters -------------------------------------------------------------------------------

_PLAIN = (str, int, float, type(None))


def _string(x: object) -> str:
    if not isinstance(x, _PLAIN):
        raise TemplateError("only texts and numbers can be printed")
    return "" if x is None else str(x)


class _List(list):
    """A list that a template made, with the number of its places, those of lists inside it included."""

    def __init__(self, items: list):
        super().__init__(items)
        self.places = sum(map(_places, items))
        if self.places > PLACES:
            raise TemplateError("too large")


def _places(x: object) -> int:
    return x.places if isinstance(x, _List) else sum(map(_places, x)) + 1 if isinstance(x, tuple) else 1


class Budget:
    """What is left of a rendering's rounds and characters."""

    def __init__(self, values: object = ()):
        items, characters = self._measured(values)
        self.rounds = ROUNDS[0] + ROUNDS[1] * items
        self.characters = CHARACTERS[0] + CHARACTERS[1] * characters + CHARACTERS[2] * items

    def _measured(self, x: object) -> tuple[int, int]:
        if isinstance(x, str):
            return 1, len(x)
        if isinstance(x, dict):
            x = list(x.values())
        if not isinstance(x, (list, tuple)):
            return 1, 0
        each = [self._measured(y) for y in x]
        return 1 + sum(i for i, _ in each), sum(c for _, c in each)

    def make(self, characters: int) -> None:
        self.characters -= characters
        if self.characters < 0:
            raise TemplateError("too large")

    def turn(self) -> None:
        self.rounds -= 1
        if self.rounds < 0:
            raise TemplateError("too many rounds of loops")


def _number(x: object) -> bool:
    return isinstance(x, (int, float))


def _added(a: object, b: object) -> object:
    return _List([*a, *b]) if isinstance(a, (list, tuple)) and isinstance(b, (list, tuple)) else a + b


def _times(a: object, b: object) -> object:
    many, few = (b, a) if _number(a) else (a, b)
    if isinstance(many, (list, tuple)):
        return _List(list(many) * min(few, PLACES + 1)) if isinstance(few, int) else many * few
    return a * b


def _rest(a: object, b: object) -> object:
    if not (_number(a) and _number(b)):
        raise TemplateError("% is for numbers")
    return a % b


BINARY: dict[str, Callable] = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge,
    "in": lambda a, b: a in b, "~": lambda a, b: _string(a) + _string(b), "+": _added, "-": operator.sub, "*": _times, "//": operator.floordiv, "%": _rest,
}

_length = lambda x: len(x) if isinstance(x, (str, list, tuple)) else 0
_text = lambda x, *_: len(_string(x))


def _replaced(x: object, a: str, b: str) -> int:
    text = _string(x)
    return len(text) + text.count(a) * len(b)


#: How many characters or places an operator or filter makes, from what it is given.
SIZES: dict[str, Callable] = {
    "~": lambda a, b: _text(a) + _text(b), "+": lambda a, b: _length(a) + _length(b), "*": lambda a, b: max(_length(a) * b if isinstance(b, int) else 0, _length(b) * a if isinstance(a, int) else 0),
    "trim": _text, "upper": lambda x: 3 * _text(x), "lower": lambda x: 3 * _text(x), "string": _text, "escape": lambda x: 2 * _text(x),
    "replace": _replaced, "join": lambda x, by="": sum(map(_text, x)) + len(by) * len(x),
}


class Escaper:
    """Breaks control strings inside texts, reversibly: a backslash after their first character; backslashes are doubled."""

    def __init__(self, controls: list[str]):
        self.controls = re.compile("|".join([r"\\", *(re.escape(c) for c in sorted(controls, key=len, reverse=True))]))

    def escape(self, text: str) -> str:
        # a control string may begin inside the last one, so broken ones are looked at again from their second character
        out, at = [], 0
        while m := self.controls.search(text, at):
            out.append(text[at : m.start() + 1])
            out.append("\\")
            at = m.start() + 1
        return "".join([*out, text[at:]])

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\\\|\\", lambda m: "\\" if len(m[0]) == 2 else "", text)


FILTERS: dict[str, Callable] = {
    "trim": lambda x: _string(x).strip(),
    "upper": lambda x: _string(x).upper(),
    "lower": lambda x: _string(x).lower(),
    "length": len,
    "string": _string,
    "default": lambda x, other: other if x is None else x,
    "replace": lambda x, a, b: _string(x).replace(a, b),
    "join": lambda x, by="": by.join(list(map(_string, x))),
    "escape": None,  # the template's own
}


# -- folding and compiling ------------------------------------------------------------------------------------------


def _apply(name: str, what: Callable, budget: Budget, *args: object) -> object:
    """The result of an operator or filter; its size is charged before it is made."""
    try:
        if name in SIZES:
            budget.make(SIZES[name](*args))
        out = what(*args)
    except TemplateError:
        raise
    except (TypeError, ValueError, ArithmeticError, LookupError, AttributeError, MemoryError, RecursionError) as error:
        raise TemplateError(str(error)) from None
    if isinstance(out, str) and len(out) > MOST or isinstance(out, int) and abs(out) > 1 << 64:
        raise TemplateError("too large")
    return out


def _item(of: object, key: object) -> object:
    if isinstance(of, dict):
        return of.get(key)
    if isinstance(of, (list, tuple, str)) and isinstance(key, int):
        return of[key] if -len(of) <= key < len(of) else None
    raise TemplateError(f"no item {key!r} here")


def fold(node: object, escape: Callable[[str], str], budget: Budget) -> object:
    """The node with constant parts worked out."""
    again = lambda x: fold(x, escape, budget)
    every = lambda xs: fold_all(xs, escape, budget)
    constant = lambda *xs: all(isinstance(x, Const) for x in xs)
    match node:
        case Binary(op, left, right):
            left, right = again(left), again(right)
            if op in ("and", "or") and constant(left):
                return right if bool(left.value) == (op == "and") else left
            if op not in ("and", "or") and constant(left, right):
                return Const(_apply(op, BINARY[op], budget, left.value, right.value))
            return Binary(op, left, right)
        case Unary(op, of):
            of = again(of)
            return Const(not of.value if op == "not" else _apply(op, operator.neg, budget, of.value)) if constant(of) else Unary(op, of)
        case Choice(test, yes, no):
            test = again(test)
            return again(yes if test.value else no) if constant(test) else Choice(test, again(yes), again(no))
        case ListOf(items):
            items = tuple(map(again, items))
            return Const(tuple(x.value for x in items)) if constant(*items) else ListOf(items)
        case Item(of, key):
            of, key = again(of), again(key)
            return Const(_item(of.value, key.value)) if constant(of, key) else Item(of, key)
        case Filter(name, of, args):
            of, args = again(of), tuple(map(again, args))
            if constant(of, *args):
                return Const(_apply(name, _filter(name, escape), budget, of.value, *(a.value for a in args)))
            return Filter(name, of, args)
        case Output(of):
            of = again(of)
            return Text(_string(of.value)) if constant(of) else Output(of)
        case If(test, yes, no):
            test = again(test)
            if constant(test):
                return every(yes if test.value else no)
            return If(test, every(yes), every(no))
        case For(name, of, body):
            return For(name, again(of), every(body))
        case Set(name, of):
            return Set(name, again(of))
        case Generation(body):
            return Generation(every(body))
    return node


def fold_all(nodes: tuple, escape: Callable[[str], str], budget: Budget) -> tuple:
    out: list = []
    for node in nodes:
        found = fold(node, escape, budget)
        for x in found if isinstance(found, tuple) else (found,):
            if isinstance(x, Text) and out and isinstance(out[-1], Text):
                out[-1] = Text(out[-1].text + x.text)
            elif x != Text(""):
                out.append(x)
    return tuple(out)


def _filter(name: str, escape: Callable[[str], str]) -> Callable:
    return FILTERS[name] or (lambda x: escape(_string(x)))


#: Where a rendering's budget lies among its values: names are texts.
BUDGET = None


class _Sink:
    def __init__(self, budget: Budget):
        self.budget = budget
        self.parts: list[str] = []
        self.size = 0
        self.spans: list[tuple[int, int]] = []

    def add(self, text: str) -> None:
        self.budget.make(len(text))
        self.parts.append(text)
        self.size += len(text)
        if self.size > MOST:
            raise TemplateError("the output is too large")


def compile_expression(node: object, escape: Callable[[str], str]) -> Callable[[dict], object]:
    make = lambda x: compile_expression(x, escape)
    match node:
        case Const(value):
            return lambda env: value
        case Name(name):
            return lambda env: env.get(name)
        case Item(of, key):
            of, key = make(of), make(key)
            return lambda env: _item(of(env), key(env))
        case Unary("not", of):
            of = make(of)
            return lambda env: not of(env)
        case Unary(_, of):
            of = make(of)
            return lambda env: _apply("-", lambda x: -x, env[BUDGET], of(env))
        case Binary("and", left, right):
            left, right = make(left), make(right)
            return lambda env: left(env) and right(env)
        case Binary("or", left, right):
            left, right = make(left), make(right)
            return lambda env: left(env) or right(env)
        case Binary(op, left, right):
            left, right, what = make(left), make(right), BINARY[op]
            return lambda env: _apply(op, what, env[BUDGET], left(env), right(env))
        case Choice(test, yes, no):
            test, yes, no = make(test), make(yes), make(no)
            return lambda env: yes(env) if test(env) else no(env)
        case ListOf(items):
            items = tuple(map(make, items))
            return lambda env: _List([x(env) for x in items])
        case Filter(name, of, args):
            of, args, what = make(of), tuple(map(make, args)), _filter(name, escape)
            return lambda env: _apply(name, what, env[BUDGET], of(env), *(a(env) for a in args))
    raise TemplateError(f"no expression: {node}")


def compile_nodes(nodes: tuple, escape: Callable[[str], str]) -> Callable[[dict, _Sink], None]:
    steps = tuple(_compile(node, escape) for node in nodes)

    def run(env: dict, sink: _Sink) -> None:
        for step in steps:
            step(env, sink)

    return steps[0] if len(steps) == 1 else run


def _compile(node: object, escape: Callable[[str], str]) -> Callable[[dict, _Sink], None]:
    match node:
        case Text(text):
            return lambda env, sink: sink.add(text)
        case Output(of):
            value = compile_expression(of, escape)
            return lambda env, sink: sink.add(_string(value(env)))
        case If(test, yes, no):
            test, yes, no = compile_expression(test, escape), compile_nodes(yes, escape), compile_nodes(no, escape)
            return lambda env, sink: yes(env, sink) if test(env) else no(env, sink)
        case Set(name, of):
            value = compile_expression(of, escape)

            def assign(env: dict, sink: _Sink) -> None:
                env[name] = value(env)

            return assign
        case For(name, of, body):
            value, body = compile_expression(of, escape), compile_nodes(body, escape)

            def loop(env: dict, sink: _Sink) -> None:
                items = value(env)
                if not isinstance(items, (list, tuple)):
                    raise TemplateError("only lists can be looped over")
                for k, x in enumerate(items):
                    sink.budget.turn()
                    body(env | {name: x, "loop": {"index0": k, "index": k + 1, "first": not k, "last": k == len(items) - 1, "length": len(items)}}, sink)

            return loop
        case Generation(body):
            body = compile_nodes(body, escape)

            def mark(env: dict, sink: _Sink) -> None:
                start = sink.size
                body(env, sink)
                sink.spans.append((start, sink.size))

            return mark
    raise TemplateError(f"no node: {node}")


def _names(node: object) -> set[str]:
    """All names and keys that are read below a node."""
    if isinstance(node, Name):
        return {node.name}
    if isinstance(node, Const):
        return {node.value} if isinstance(node.value, str) else set()
    if isinstance(node, (tuple, list)):
        return set().union(*map(_names, node), set())
    return set().union(*(_names(v) for v in vars(node).values()), set()) if hasattr(node, "__dataclass_fields__") else set()


class Template:
    """A compiled template. render() takes the values by name and returns the text and its generation spans."""

    def __init__(self, source: str, controls: list[str] = ()):
        if len(source) > SOURCE:
            raise TemplateError("the template is too long")
        self.escaper = Escaper(list(controls))
        try:
            self.nodes = fold_all(parse(source), self.escaper.escape, Budget())
            self._run = compile_nodes(self.nodes, self.escaper.escape)
        except RecursionError:
            raise TemplateError("the template is nested too deeply") from None
        body = self.nodes[0] if len(self.nodes) == 1 and isinstance(self.nodes[0], For) else None
        #: A single loop over `messages` that doesn't ask for their number: each message renders alone.
        self.by_message = bool(body and body.of == Name("messages") and not _names(body.body) & {"messages", "last", "length", "index", "index0", "first"})

    def render(self, **values: object) -> tuple[str, list[tuple[int, int]]]:
        budget = Budget(values)
        sink = _Sink(budget)
        try:
            self._run(dict(values) | {BUDGET: budget}, sink)
        except RecursionError:
            raise TemplateError("the values are nested too deeply") from None
        return "".join(sink.parts), sink.spans
