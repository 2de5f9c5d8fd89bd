"""Chat formatting by a small template compiler: syntax tree, constant folding, Python closures.

The language: text; {{ expression }}; {% if e %}..{% elif e %}..{% else %}..{% endif %};
{% for name in e %}..{% endfor %}; {% generation %}..{% endgeneration %}, whose output carries the
loss. Expressions: strings, integers, true, false, none, names, a.b, == != and or not + ( ), and
filters after |. A filter is one of a fixed table; there are no calls and no other access to Python.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Strings that mean something to this or to other templates, fixed; none appears in a text once it is escaped.
CONTROL = ("<|", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>")
START, TEXT, END = "<|start|>", "<|text|>", "<|end|>\n"
TEMPLATE = (
    "{% for m in messages %}<|start|>{{ m.role | escape }}<|text|>"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}<|end|>\n{% endfor %}"
)
#: Characters after which a part of a long conversation ends, with the turn that is being written.
PART_CHARS = 1 << 18


def escape(text: str) -> str:
    """Double every backslash, and put one inside every control string."""
    text = text.replace("\\", "\\\\")
    for c in CONTROL:
        text = text.replace(c, f"{c[0]}\\{c[1:]}")
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}


class TemplateError(ValueError):
    """A template that the language does not allow."""


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: object
    name: str


@dataclass(frozen=True)
class Op:
    op: str
    args: tuple


@dataclass(frozen=True)
class Filter:
    name: str
    of: object


@dataclass
class Put:
    value: object


@dataclass
class If:
    test: object
    then: list = field(default_factory=list)
    other: list = field(default_factory=list)


@dataclass
class For:
    name: str
    over: object
    body: list = field(default_factory=list)


@dataclass
class Generation:
    body: list = field(default_factory=list)


_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<int>[0-9]+)|(?P<name>[A-Za-z_][A-Za-z0-9_]*)|(?P<op>==|!=|[.|+()]))")
_ESCAPES = {"n": "\n", "t": "\t"}


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at = 0
        while source[at:].strip():
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"not understood: {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] in ("op", "name") and self.tokens[self.at][1] in values

    def take(self) -> tuple[str, str]:
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        self.at += 1
        return self.tokens[self.at - 1]

    def whole(self):
        e = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"not understood: {self.tokens[self.at][1]!r}")
        return e

    def _chain(self, below: Callable, *ops: str):
        e = below()
        while self.peek(*ops):
            op = self.take()[1]
            e = Op(op, (e, below()))
        return e

    def either(self):
        return self._chain(self.both, "or")

    def both(self):
        return self._chain(self.inverse, "and")

    def inverse(self):
        if self.peek("not"):
            self.take()
            return Op("not", (self.inverse(),))
        return self._chain(self.total, "==", "!=")

    def total(self):
        return self._chain(self.filtered, "+")

    def filtered(self):
        e = self.atom()
        while self.peek(".", "|"):
            op, (kind, name) = self.take()[1], self.take()
            if kind != "name" or name.startswith("_"):
                raise TemplateError(f"no field or filter: {name!r}")
            if op == "|" and name not in FILTERS:
                raise TemplateError(f"no such filter: {name}")
            e = Filter(name, e) if op == "|" else Field(e, name)
        return e

    def atom(self):
        kind, value = self.take()
        if kind == "str":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1]))
        if kind == "int":
            return Const(int(value))
        if kind == "name" and not value.startswith("_"):
            return Const({"true": True, "false": False, "none": None}[value]) if value in ("true", "false", "none") else Name(value)
        if value == "(":
            e = self.either()
            if self.take()[1] != ")":
                raise TemplateError("a bracket is not closed")
            return e
        raise TemplateError(f"not understood: {value!r}")


def parse(source: str) -> list:
    """The syntax tree of a template."""
    root: list = []
    stack: list[tuple[str, object, list]] = [("", None, root)]
    at = 0
    for m in _TAG.finditer(source):
        here = stack[-1][2]
        if m.start() > at:
            here.append(Put(Const(source[at : m.start()])))
        at = m.end()
        if m[1] is not None:
            here.append(Put(_Expression(m[1]).whole()))
            continue
        word, _, rest = m[2].strip().partition(" ")
        if word == "if":
            here.append(node := If(_Expression(rest).whole()))
            stack.append(("if", node, node.then))
        elif word in ("elif", "else") and stack[-1][0] == "if" and stack[-1][1] is not None:
            _, node, _ = stack.pop()
            if word == "elif":
                node.other.append(inner := If(_Expression(rest).whole()))
                stack.append(("if", inner, inner.then))
            else:
                stack.append(("if", None, node.other))
        elif word == "for" and (f := re.fullmatch(r"([A-Za-z][A-Za-z0-9_]*)\s+in\s+(.+)", rest.strip(), re.S)):
            here.append(node := For(f[1], _Expression(f[2]).whole()))
            stack.append(("for", node, node.body))
        elif word == "generation" and not any(s[0] == "generation" for s in stack):
            here.append(node := Generation())
            stack.append(("generation", node, node.body))
        elif word.startswith("end") and word[3:] and word[3:] == stack[-1][0]:
            stack.pop()
        else:
            raise TemplateError(f"not expected here: {m[2].strip()!r}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is not closed")
    if at < len(source):
        root.append(Put(Const(source[at:])))
    return root


_APPLY: dict[str, Callable] = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "+": lambda a, b: a + b, "and": lambda a, b: a and b, "or": lambda a, b: a or b, "not": lambda a: not a}


def _shown(value: object) -> str:
    return "" if value is None else str(value)


def fold(node):
    """Replace what does not depend on the conversation by its value; join and drop constant parts."""
    if isinstance(node, list):
        out: list = []
        for x in map(fold, node):
            for y in x if isinstance(x, list) else [x]:
                if isinstance(y, Put) and isinstance(y.value, Const):
                    y = Put(Const(_shown(y.value.value)))
                    if not y.value.value:
                        continue
                    if out and isinstance(out[-1], Put) and isinstance(out[-1].value, Const):
                        out[-1] = Put(Const(out[-1].value.value + y.value.value))
                        continue
                out.append(y)
        return out
    if isinstance(node, Op):
        args = tuple(map(fold, node.args))
        return Const(_APPLY[node.op](*[a.value for a in args])) if all(isinstance(a, Const) for a in args) else Op(node.op, args)
    if isinstance(node, Filter):
        of = fold(node.of)
        return Const(FILTERS[node.name](_shown(of.value))) if isinstance(of, Const) else Filter(node.name, of)
    if isinstance(node, Field):
        return Field(fold(node.of), node.name)
    if isinstance(node, Put):
        return Put(fold(node.value))
    if isinstance(node, If):
        test = fold(node.test)
        if isinstance(test, Const):
            return fold(node.then if test.value else node.other)
        return If(test, fold(node.then), fold(node.other))
    if isinstance(node, For):
        return For(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    return node


def _value(e) -> Callable[[dict], object]:
    if isinstance(e, Const):
        return lambda env, v=e.value: v
    if isinstance(e, Name):
        return lambda env, n=e.name: env.get(n)
    if isinstance(e, Field):
        of = _value(e.of)
        return lambda env, n=e.name: v.get(n) if isinstance(v := of(env), dict) else None
    if isinstance(e, Filter):
        of, f = _value(e.of), FILTERS[e.name]
        return lambda env: f(_shown(of(env)))
    args = [_value(a) for a in e.args]
    if e.op == "not":
        return lambda env: not args[0](env)
    left, right = args
    if e.op == "and":
        return lambda env: left(env) and right(env)
    if e.op == "or":
        return lambda env: left(env) or right(env)
    return lambda env, f=_APPLY[e.op]: f(left(env), right(env))


Piece = tuple[str, bool]


def _block(nodes: list, trained: bool) -> Callable[[dict], Iterator[Piece]]:
    parts: list[Callable[[dict], Iterator[Piece]]] = []
    for node in nodes:
        if isinstance(node, Put):
            value = _value(node.value)
            parts.append(lambda env, value=value: iter([(_shown(value(env)), trained)]))
        elif isinstance(node, If):
            test, then, other = _value(node.test), _block(node.then, trained), _block(node.other, trained)
            parts.append(lambda env, test=test, then=then, other=other: then(env) if test(env) else other(env))
        elif isinstance(node, For):
            over, body = _value(node.over), _block(node.body, trained)

            def loop(env: dict, name=node.name, over=over, body=body) -> Iterator[Piece]:
                for x in over(env) or ():
                    yield from body(env | {name: x})

            parts.append(loop)
        else:
            parts.append(_block(node.body, True))
    return lambda env: itertools.chain.from_iterable(p(env) for p in parts)


def compile_template(source: str) -> Callable[[dict], Iterator[Piece]]:
    """A closure that renders values as pieces (text, whether the loss covers it), one by one."""
    return _block(fold(parse(source)), False)


def _reads(nodes: list) -> int:
    """How often the messages are read at most: one loop counts once, one in a loop twice."""
    total = 0
    for node in nodes:
        if isinstance(node, For):
            total += (node.over == Name("messages")) + 2 * _reads(node.body)
        elif isinstance(node, If):
            total += max(_reads(node.then), _reads(node.other))
        elif isinstance(node, Generation):
            total += _reads(node.body)
    return total


def _turns(batches: Iterable[pd.DataFrame]) -> Iterator[tuple[object, dict]]:
    for b in batches:
        for conv, role, text in zip(b["conv_id"], b["role"], b["text"]):
            yield conv if isinstance(conv, str) else None, {"role": role if isinstance(role, str) else "", "text": text if isinstance(text, str) else ""}


def _parts(render: Callable[[dict], Iterator[Piece]], messages: Iterator[dict]) -> Iterator[tuple[str, list[dict]]]:
    """Rendered text in parts that end between turns, each with its spans of loss."""
    done = False

    def noted() -> Iterator[dict]:
        nonlocal done
        for i, m in enumerate(messages):
            done = i > 0
            yield m

    text, size, spans = [], 0, []
    for piece, trained in render({"messages": noted()}):
        if done and size >= PART_CHARS:
            yield "".join(text), spans
            text, size, spans = [], 0, []
        done = False
        if trained and piece:
            if spans and spans[-1]["end"] == size:
                spans[-1]["end"] += len(piece)
            else:
                spans.append({"start": size, "end": size + len(piece)})
        text.append(piece)
        size += len(piece)
    yield "".join(text), spans


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Rows (conv_id, part, formatted, loss) of each conversation, its turns ordered by turn, role and text.

    loss holds the spans of code points under {% generation %}. A conversation is one part unless
    it is very long; parts end between turns, so that memory is bounded whatever a conversation
    holds. Turns of one conversation come together by a sort, not a list; they are read once, so a
    template has one loop over messages, in no other loop. Null roles and texts are empty; a null
    conv_id is a conversation of its own; repeated rows are repeated turns.
    """
    compile_template(template)  # a wrong template fails here, not in a task
    if _reads(fold(parse(template))) > 1:
        raise TemplateError("messages are read more than once")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        render = compile_template(template)
        rows, size = [], 0
        for conv, group in itertools.groupby(_turns(batches), key=lambda x: x[0]):
            for i, (text, spans) in enumerate(_parts(render, (m for _, m in group))):
                rows.append((conv, i, text, spans))
                size += len(text)
                if size > 1 << 21:
                    yield pd.DataFrame(rows, columns=["conv_id", "part", "formatted", "loss"])
                    rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=["conv_id", "part", "formatted", "loss"])

    return (
        turns.select("conv_id", "turn", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select(F.col("conv_id").cast("string").alias("conv_id"), "role", "text")
        .mapInPandas(run, "conv_id string, part long, formatted string, loss array<struct<start:long,end:long>>")
        .withColumn("conv_id", F.col("conv_id").cast(turns.schema["conv_id"].dataType))
    )


_TURN = re.compile(re.escape(START) + r"(.*?)" + re.escape(TEXT) + r"(.*?)" + re.escape(END), re.S)


def read_back(formatted: str) -> Iterator[tuple[str, str]]:
    """The roles and texts of what TEMPLATE has rendered."""
    for m in _TURN.finditer(formatted):
        yield unescape(m[1]), unescape(m[2])


def digest(formatted: DataFrame) -> DataFrame:
    """Read formatted conversations back and sum them up: one row for each, from its parts in order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = ((c if isinstance(c, str) else None, t, s) for b in batches for c, t, s in zip(b["conv_id"], b["formatted"], b["loss"]))
        rows = []
        for conv, group in itertools.groupby(parts, key=lambda x: x[0]):
            turns, loss, n, lost, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for _, text, spans in group:
                size += len(text)
                for role, said in read_back(text):
                    n += 1
                    turns.update(f"{role}\n{said}\n".encode("utf-8", "replace"))
                for s in spans:
                    plain = unescape(text[s["start"] : s["end"]])
                    lost += len(plain)
                    loss.update(plain.encode("utf-8", "replace"))
            rows.append((conv, n, turns.hexdigest(), lost, loss.hexdigest(), size))
            if len(rows) >= 5000:
                yield pd.DataFrame(rows, columns=_DIGEST)
                rows = []
        if rows:
            yield pd.DataFrame(rows, columns=_DIGEST)

    found = formatted.withColumn("conv_id", F.col("conv_id").cast("string")).mapInPandas(run, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return found.withColumn("conv_id", F.col("conv_id").cast(formatted.schema["conv_id"].dataType))


_DIGEST = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
