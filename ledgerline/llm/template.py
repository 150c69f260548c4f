"""A sandboxed template language for conversations, compiled to Python closures (operator 11).

A template is text with

* ``{{ expression }}``: the value as text (none: nothing);
* ``{% for x in expression %} ... {% endfor %}``, with ``loop.index``, ``loop.first`` and ``loop.last`` inside;
* ``{% if e %} ... {% elif e %} ... {% else %} ... {% endif %}``;
* ``{% generation %} ... {% endgeneration %}``: text that a model is trained to write;
* ``{# a comment #}``; a ``-`` inside a mark drops the white space on that side.

Expressions have text, whole numbers, ``true``, ``false``, ``none``, names, ``a.b``
and ``a["b"]`` (keys of mappings), ``a | filter`` or ``a | filter(x)``, ``~`` (joins
text), ``+ - * %`` (whole numbers only), comparisons, ``in``, ``not``, ``and``, ``or``.

Templates are data: a compiled one can read the given names and nothing else.
There are no calls, no attributes of Python objects, no imports and no loops but
those over given lists; nesting has a bound.
"""

from __future__ import annotations

import inspect
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

#: Depth of nested blocks and expressions.
MOST_NESTED = 40


class TemplateError(ValueError):
    """The template breaks the language's rules or asks for something it may not have."""


# ------------------------------------------------------------------ the tree
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
class Filter:
    of: object
    name: str
    args: tuple = ()


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
class Output:
    of: object


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


# ------------------------------------------------------------------ values
def shown(value: object) -> str:
    """A value as text."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (str, int)):
        return str(value)
    raise TemplateError(f"a {type(value).__name__} has no text form")


def _number(value: object) -> int:
    if isinstance(value, bool) or not isinstance(value, int):
        raise TemplateError("arithmetic needs whole numbers")
    return value


def _item(of: object, key: object) -> object:
    if not isinstance(of, dict):
        raise TemplateError(f"{type(of).__name__} has no keys")
    return of.get(key)


def _rest(a: object, b: object) -> int:
    if not _number(b):
        raise TemplateError("nothing has a rest by 0")
    return _number(a) % b


def _ordered(compare: Callable) -> Callable:
    def run(a, b):
        if type(a) is not type(b) or not isinstance(a, (str, int)):
            raise TemplateError("only two texts or two numbers have an order")
        return compare(a, b)

    return run


def _within(a: object, b: object) -> bool:
    if isinstance(b, str):
        return shown(a) in b
    if isinstance(b, (list, tuple, dict)):
        return a in b
    raise TemplateError(f"nothing is in a {type(b).__name__}")


BINARY: dict[str, Callable] = {
    "~": lambda a, b: shown(a) + shown(b),
    "+": lambda a, b: _number(a) + _number(b),
    "-": lambda a, b: _number(a) - _number(b),
    "*": lambda a, b: _number(a) * _number(b),
    "%": _rest,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": _ordered(lambda a, b: a < b),
    "<=": _ordered(lambda a, b: a <= b),
    ">": _ordered(lambda a, b: a > b),
    ">=": _ordered(lambda a, b: a >= b),
    "in": _within,
}
LEVELS = [("or",), ("and",), ("==", "!=", "<", "<=", ">", ">=", "in"), ("~", "+", "-"), ("*", "%")]

FILTERS: dict[str, Callable] = {
    "upper": lambda v: shown(v).upper(),
    "lower": lambda v: shown(v).lower(),
    "capitalize": lambda v: shown(v).capitalize(),
    "trim": lambda v: shown(v).strip(),
    "length": lambda v: len(v if isinstance(v, (list, tuple, dict)) else shown(v)),
    "default": lambda v, other: other if v is None else v,
}

# ------------------------------------------------------------------ reading
_MARK = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\})", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<text>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<number>\d+)|(?P<word>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|[<>~+\-*%|().,\[\]]))""", re.S)
_RESERVED = {"and", "or", "not", "in", "true", "false", "none", "for", "if", "elif", "else", "endif", "endfor", "generation", "endgeneration"}


class _Expression:
    """Reads one expression."""

    def __init__(self, source: str, filters: dict[str, Callable], names: set[str]):
        self.source, self.filters, self.names, self.tokens, at = source, filters, names, [], 0
        while source[at:].strip():
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:].strip()!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()
        self.at = self.depth = 0

    def whole(self) -> object:
        tree = self.level(0)
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.tokens[self.at][1]!r} is out of place in {self.source.strip()!r}")
        return tree

    def sees(self, *signs: str) -> str | None:
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        if kind in ("sign", "word") and text in signs:
            self.at += 1
            return text
        return None

    def needs(self, sign: str) -> None:
        if not self.sees(sign):
            raise TemplateError(f"{sign!r} is missing in {self.source.strip()!r}")

    def level(self, k: int) -> object:
        if k == len(LEVELS):
            return self.unary()
        if k == 2 and self.sees("not"):  # binds less than a comparison
            return Unary("not", self.deeper(lambda: self.level(2)))
        tree = self.level(k + 1)
        while op := self.sees(*LEVELS[k]):
            tree = Binary(op, tree, self.level(k + 1))
        return tree

    def deeper(self, read: Callable[[], object]) -> object:
        self.depth += 1
        if self.depth > MOST_NESTED:
            raise TemplateError("the expression is nested too deeply")
        tree = read()
        self.depth -= 1
        return tree

    def unary(self) -> object:
        return self.deeper(lambda: Unary("-", self.unary()) if self.sees("-") else self.postfix(self.atom()))

    def atom(self) -> object:
        if self.sees("("):
            tree = self.level(0)
            self.needs(")")
            return tree
        if self.at == len(self.tokens):
            raise TemplateError(f"{self.source.strip()!r} ends too early")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            return Const(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "number":
            return Const(int(text))
        if kind == "word" and text in ("true", "false", "none"):
            return Const({"true": True, "false": False, "none": None}[text])
        if kind == "word" and text not in _RESERVED:
            if text not in self.names:
                raise TemplateError(f"{text!r} is not known here")
            return Name(text)
        raise TemplateError(f"{text!r} is out of place in {self.source.strip()!r}")

    def postfix(self, tree: object) -> object:
        while sign := self.sees(".", "[", "|"):
            if sign == "[":
                tree = Item(tree, self.level(0))
                self.needs("]")
                continue
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
            if kind != "word":
                raise TemplateError(f"a name is missing in {self.source.strip()!r}")
            self.at += 1
            if sign == ".":
                tree = Item(tree, Const(name))
                continue
            if name not in self.filters:
                raise TemplateError(f"there is no filter {name!r}")
            args = []
            if self.sees("(") and not self.sees(")"):
                args.append(self.level(0))
                while self.sees(","):
                    args.append(self.level(0))
                self.needs(")")
            try:
                inspect.signature(self.filters[name]).bind(None, *args)
            except TypeError as e:
                raise TemplateError(f"filter {name!r}: {e}") from None
            tree = Filter(tree, name, tuple(args))
        return tree


def parse(source: str, names: Iterable[str], filters: dict[str, Callable] = FILTERS) -> tuple:
    """The template's syntax tree: its statements in order."""
    parts = _MARK.split(source)
    for i in range(1, len(parts), 2):
        mark = parts[i]
        if mark.startswith("{#"):
            continue
        if mark[2] == "-":
            parts[i - 1] = parts[i - 1].rstrip()
        if mark[-3] == "-":
            parts[i + 1] = parts[i + 1].lstrip()
    at = 0

    def expression(text: str, known: set[str]) -> object:
        return _Expression(text, filters, known).whole()

    def block(known: set[str], ends: tuple[str, ...], depth: int) -> tuple[tuple, str, str]:
        nonlocal at
        if depth > MOST_NESTED:
            raise TemplateError("blocks are nested too deeply")
        out: list = []
        while at < len(parts):
            part, is_mark = parts[at], at % 2 == 1
            at += 1
            if not is_mark:
                if part:
                    out.append(Output(Const(part)))
                continue
            if part.startswith("{#"):
                continue
            inside = part[2:-2].strip("-").strip() if part.startswith("{%") else part[2:-2]
            if part.startswith("{{"):
                inside = inside[inside.startswith("-"):len(inside) - inside.endswith("-")]
                out.append(Output(expression(inside, known)))
                continue
            word, _, rest = inside.partition(" ")
            if word in ends:
                return tuple(out), word, rest
            if word == "for":
                found = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
                if not found or found[1] in _RESERVED | {"loop"}:
                    raise TemplateError(f"cannot read {inside!r}")
                over = expression(found[2], known)
                body, _, _ = block(known | {found[1], "loop"}, ("endfor",), depth + 1)
                out.append(For(found[1], over, body))
            elif word == "if":
                out.append(choice(rest, known, depth))
            elif word == "generation":
                out.append(Generation(block(known, ("endgeneration",), depth + 1)[0]))
            else:
                raise TemplateError(f"{inside!r} is out of place")
        if ends:
            raise TemplateError(f"{ends[-1]!r} is missing")
        return tuple(out), "", ""

    def choice(test: str, known: set[str], depth: int) -> If:
        condition = expression(test, known)
        then, end, rest = block(known, ("elif", "else", "endif"), depth + 1)
        if end == "elif":
            return If(condition, then, (choice(rest, known, depth + 1),))
        return If(condition, then, block(known, ("endif",), depth + 1)[0] if end == "else" else ())

    return block(set(names), (), 0)[0]


# ------------------------------------------------------------------ folding
def folded(tree: object, filters: dict[str, Callable] = FILTERS) -> object:
    """An expression with every part that depends on no name worked out."""
    if isinstance(tree, Item):
        return Item(folded(tree.of, filters), folded(tree.key, filters))
    if isinstance(tree, Filter):
        of, args = folded(tree.of, filters), tuple(folded(a, filters) for a in tree.args)
        if all(isinstance(x, Const) for x in (of, *args)):
            return Const(filters[tree.name](of.value, *(a.value for a in args)))
        return Filter(of, tree.name, args)
    if isinstance(tree, Unary):
        of = folded(tree.of, filters)
        if isinstance(of, Const):
            return Const(not of.value if tree.op == "not" else -_number(of.value))
        return Unary(tree.op, of)
    if isinstance(tree, Binary):
        left, right = folded(tree.left, filters), folded(tree.right, filters)
        if tree.op in ("and", "or"):
            if isinstance(left, Const):  # the left side alone decides, or the right side does
                return right if bool(left.value) == (tree.op == "and") else left
        elif isinstance(left, Const) and isinstance(right, Const):
            return Const(BINARY[tree.op](left.value, right.value))
        return Binary(tree.op, left, right)
    return tree


def folded_block(block: tuple, filters: dict[str, Callable] = FILTERS) -> tuple:
    """Statements with constants folded: decided branches chosen, neighbouring texts joined, empty parts dropped."""
    out: list = []

    def add(node: object) -> None:
        if isinstance(node, Output) and isinstance(node.of, Const):
            text = shown(node.of.value)
            if out and isinstance(out[-1], Output) and isinstance(out[-1].of, Const):
                text = out.pop().of.value + text
            if text:
                out.append(Output(Const(text)))
        else:
            out.append(node)

    for node in block:
        if isinstance(node, Output):
            add(Output(folded(node.of, filters)))
        elif isinstance(node, If):
            test, then, other = folded(node.test, filters), folded_block(node.then, filters), folded_block(node.other, filters)
            if isinstance(test, Const):
                for chosen in then if test.value else other:
                    add(chosen)
            elif then or other:
                add(If(test, then, other))
        elif isinstance(node, For):
            if body := folded_block(node.body, filters):
                add(For(node.name, folded(node.over, filters), body))
        elif isinstance(node, Generation):
            if body := folded_block(node.body, filters):
                add(Generation(body))
    return tuple(out)


# ------------------------------------------------------------------ closures
Scope = dict
Pieces = Iterator[tuple[str, bool]]


def _value(tree: object, filters: dict[str, Callable]) -> Callable[[Scope], object]:
    """A closure that works an expression out."""
    if isinstance(tree, Const):
        value = tree.value
        return lambda scope: value
    if isinstance(tree, Name):
        name = tree.name
        return lambda scope: scope.get(name)
    if isinstance(tree, Item):
        of, key = _value(tree.of, filters), _value(tree.key, filters)
        return lambda scope: _item(of(scope), key(scope))
    if isinstance(tree, Filter):
        of, args, call = _value(tree.of, filters), [_value(a, filters) for a in tree.args], filters[tree.name]
        return lambda scope: call(of(scope), *(a(scope) for a in args))
    if isinstance(tree, Unary):
        of = _value(tree.of, filters)
        return (lambda scope: not of(scope)) if tree.op == "not" else (lambda scope: -_number(of(scope)))
    left, right = _value(tree.left, filters), _value(tree.right, filters)
    if tree.op == "and":
        return lambda scope: left(scope) and right(scope)
    if tree.op == "or":
        return lambda scope: left(scope) or right(scope)
    call = BINARY[tree.op]
    return lambda scope: call(left(scope), right(scope))


def _statements(block: tuple, filters: dict[str, Callable]) -> Callable[[Scope], Pieces]:
    steps = [_statement(node, filters) for node in block]
    if len(steps) == 1:
        return steps[0]

    def run(scope: Scope) -> Pieces:
        for step in steps:
            yield from step(scope)

    return run


def _statement(node: object, filters: dict[str, Callable]) -> Callable[[Scope], Pieces]:
    """A closure that yields a statement's pieces of text, each with whether it is to be trained on."""
    if isinstance(node, Output):
        of = _value(node.of, filters)

        def output(scope: Scope) -> Pieces:
            if text := shown(of(scope)):
                yield text, False

        return output
    if isinstance(node, If):
        test, then, other = _value(node.test, filters), _statements(node.then, filters), _statements(node.other, filters)
        return lambda scope: then(scope) if test(scope) else other(scope)
    if isinstance(node, Generation):
        body = _statements(node.body, filters)
        return lambda scope: ((text, True) for text, _ in body(scope))
    over, body, name = _value(node.over, filters), _statements(node.body, filters), node.name

    def loop(scope: Scope) -> Pieces:
        items = over(scope)
        if isinstance(items, (str, dict)) or not isinstance(items, Iterable):
            raise TemplateError(f"cannot loop over a {type(items).__name__}")
        items, index, none = iter(items), 0, object()
        item = next(items, none)
        while item is not none:
            following = next(items, none)
            index += 1
            at = {"index": index, "first": index == 1, "last": following is none}
            yield from body({**scope, name: item, "loop": at})
            item = following

    return loop


class Template:
    """A compiled template: ``pieces`` yields its text part by part, ``render`` gives it whole.

    Lists may be iterators: a loop holds two items at a time, so a conversation
    of any length is rendered within the memory of two turns.
    """

    def __init__(self, source: str, names: Iterable[str], filters: dict[str, Callable] | None = None):
        self.names, all_filters = set(names), FILTERS | (filters or {})
        self.tree = folded_block(parse(source, self.names, all_filters), all_filters)
        self._run = _statements(self.tree, all_filters)

    def pieces(self, **values: object) -> Pieces:
        if unknown := set(values) - self.names:
            raise TemplateError(f"{sorted(unknown)} are not names of the template")
        return self._run(values)

    def render(self, **values: object) -> tuple[str, list[tuple[int, int]]]:
        """(text, spans of it that are to be trained on, neighbouring ones joined)."""
        out, spans, at = [], [], 0
        for text, trained in self.pieces(**values):
            if trained and spans and spans[-1][1] == at:
                spans[-1] = spans[-1][0], at + len(text)
            elif trained:
                spans.append((at, at + len(text)))
            out.append(text)
            at += len(text)
        return "".join(out), spans
