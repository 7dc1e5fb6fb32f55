"""Chat formatting with a small, sandboxed template language.

A template is parsed into a syntax tree, constants are folded, and what is left is compiled to
Python closures. Rendering streams: a loop takes messages from an iterator and yields text
pieces with their generation flag, so a conversation of any length needs memory for one piece.

    text                      {{ expression }}               {# comment #}
    {% if e %} {% elif e %} {% else %} {% endif %}
    {% for name in e %} {% endfor %}          inside: loop.index, loop.first
    {% generation %} {% endgeneration %}      text that the loss is taken on

Expressions: strings, integers, true/false/none, names, fields, == != + and or not, ( ), and
filters (x | escape, upper, lower, trim). Nothing can be called, and fields are keys of the
messages only; there is no way to Python objects.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
TEMPLATE = (
    "{% for m in messages %}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% else %}<s>{{ m.role | escape }}[INST] {{ m.text | escape }} [/INST]{% endif %}"
    "{% endfor %}"
)
PIECE = 1 << 20  # characters after which a conversation goes on in a further row
FORMATTED = "conv_id long, piece int, text string, loss array<int>"

_MARK = re.compile("|".join(map(re.escape, CONTROL)) + r"|\\")


def escape(text: str) -> str:
    """Backslashes are doubled and control strings get one behind their first character."""
    return _MARK.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape, "upper": str.upper, "lower": str.lower, "trim": str.strip}
OPERATORS: dict[str, Callable[[Any, Any], Any]] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "+": lambda a, b: a + b}
WORDS = {"true": True, "false": False, "none": None}


class TemplateError(ValueError):
    pass


@dataclass(frozen=True)
class Node:
    """kind: const, name, field, filter, op, and, or, not; text, out, if, for, gen, all."""

    kind: str
    value: Any = None
    parts: tuple[Node, ...] = ()


# --- parsing -------------------------------------------------------------------------------

_TAGS = re.compile(r"(\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\})", re.S)
_LEXEMES = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[()+|.]))")


def _lexemes(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    source = source.strip()
    while at < len(source):
        m = _LEXEMES.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:]!r}")
        kind = ("string", "number", "word", "sign")[m.lastindex - 1]
        out.append((kind, m[m.lastindex]))
        at = m.end()
    return out


class _Expression:
    """Recursive descent, loosest first: or, and, not, == !=, +, filters, fields."""

    def __init__(self, source: str) -> None:
        self.rest = _lexemes(source)

    def parse(self) -> Node:
        e = self.either()
        if self.rest:
            raise TemplateError(f"unexpected {self.rest[0][1]!r}")
        return e

    def next_is(self, *values: str) -> str | None:
        if self.rest and self.rest[0][0] in ("word", "sign") and self.rest[0][1] in values:
            return self.rest.pop(0)[1]
        return None

    def either(self) -> Node:
        e = self.both()
        while self.next_is("or"):
            e = Node("or", None, (e, self.both()))
        return e

    def both(self) -> Node:
        e = self.negated()
        while self.next_is("and"):
            e = Node("and", None, (e, self.negated()))
        return e

    def negated(self) -> Node:
        if self.next_is("not"):
            return Node("not", None, (self.negated(),))
        e = self.added()
        while op := self.next_is("==", "!="):
            e = Node("op", op, (e, self.added()))
        return e

    def added(self) -> Node:
        e = self.filtered()
        while self.next_is("+"):
            e = Node("op", "+", (e, self.filtered()))
        return e

    def filtered(self) -> Node:
        e = self.field()
        while self.next_is("|"):
            name = self.word()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            e = Node("filter", name, (e,))
        return e

    def field(self) -> Node:
        e = self.atom()
        while self.next_is("."):
            e = Node("field", self.word(), (e,))
        return e

    def word(self) -> str:
        if not self.rest or self.rest[0][0] != "word":
            raise TemplateError("a name is missing")
        return self.rest.pop(0)[1]

    def atom(self) -> Node:
        if self.next_is("("):
            e = self.either()
            if not self.next_is(")"):
                raise TemplateError("a bracket is open")
            return e
        if not self.rest:
            raise TemplateError("an expression is missing")
        kind, value = self.rest.pop(0)
        if kind == "string":
            return Node("const", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), value[1:-1]))
        if kind == "number":
            return Node("const", int(value))
        if kind == "word":
            return Node("const", WORDS[value]) if value in WORDS else Node("name", value)
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str) -> Node:
    """The syntax tree of a template."""
    rest = [t for t in _TAGS.split(source) if t and not t.startswith("{#")]

    def block(*ends: str) -> tuple[Node, str, str]:
        body: list[Node] = []
        while rest:
            t = rest.pop(0)
            if t.startswith("{{"):
                body.append(Node("out", None, (_Expression(t[2:-2]).parse(),)))
            elif t.startswith("{%"):
                word, _, more = t[2:-2].strip().partition(" ")
                if word in ends:
                    return Node("all", None, tuple(body)), word, more
                body.append(statement(word, more))
            else:
                body.append(Node("text", t))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return Node("all", None, tuple(body)), "", ""

    def statement(word: str, more: str) -> Node:
        if word == "generation":
            return Node("gen", None, (block("endgeneration")[0],))
        if word == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", more.strip(), re.S)
            if not m:
                raise TemplateError("for needs a name, in, and an expression")
            return Node("for", m[1], (_Expression(m[2]).parse(), block("endfor")[0]))
        if word == "if":
            test = _Expression(more).parse()
            body, end, more = block("elif", "else", "endif")
            if end == "elif":
                return Node("if", None, (test, body, statement("if", more)))
            other = block("endif")[0] if end == "else" else Node("all")
            return Node("if", None, (test, body, other))
        raise TemplateError(f"no statement {word!r}")

    return block()[0]


# --- folding and compiling -----------------------------------------------------------------

def fold(n: Node) -> Node:
    """The tree with constant expressions computed, dead branches cut and neighbouring texts joined."""
    parts = tuple(map(fold, n.parts))
    known = [p.value for p in parts if p.kind == "const"]
    fixed = len(known) == len(parts) > 0
    if n.kind == "op" and fixed:
        return Node("const", OPERATORS[n.value](*known))
    if n.kind == "filter" and fixed:
        return Node("const", FILTERS[n.value](_text(known[0])))
    if n.kind == "not" and fixed:
        return Node("const", not known[0])
    if n.kind in ("and", "or") and parts[0].kind == "const":
        return parts[1] if bool(parts[0].value) == (n.kind == "and") else parts[0]
    if n.kind == "out" and fixed:
        return Node("text", _text(known[0]))
    if n.kind == "if" and parts[0].kind == "const":
        return parts[1] if parts[0].value else parts[2]
    if n.kind == "all":
        flat: list[Node] = []
        for p in (q for p in parts for q in (p.parts if p.kind == "all" else (p,))):
            if p.kind == "text" and flat and flat[-1].kind == "text":
                flat[-1] = Node("text", flat[-1].value + p.value)
            elif p.kind != "text" or p.value:
                flat.append(p)
        return flat[0] if len(flat) == 1 else Node("all", None, tuple(flat))
    return Node(n.kind, n.value, parts)


def _text(v: Any) -> str:
    return "" if v is None else v if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else str(v)


def _value(n: Node) -> Callable[[dict], Any]:
    if n.kind == "const":
        return lambda s, v=n.value: v
    if n.kind == "name":
        return lambda s, k=n.value: s.get(k)
    parts = [_value(p) for p in n.parts]
    if n.kind == "field":
        return lambda s, e=parts[0], k=n.value: v.get(k) if type(v := e(s)) is dict else None
    if n.kind == "filter":
        return lambda s, e=parts[0], f=FILTERS[n.value]: f(_text(e(s)))
    if n.kind == "op":
        return lambda s, a=parts[0], b=parts[1], f=OPERATORS[n.value]: f(a(s), b(s))
    if n.kind == "not":
        return lambda s, e=parts[0]: not e(s)
    if n.kind == "and":
        return lambda s, a=parts[0], b=parts[1]: a(s) and b(s)
    return lambda s, a=parts[0], b=parts[1]: a(s) or b(s)


#: A rendered piece and whether it is generated; None between the rounds of an outermost loop.
Event = tuple[str, bool] | None
Emit = Callable[[dict, bool, bool], Iterator[Event]]


def _emit(n: Node) -> Emit:
    """A closure of (scope, generated, inside a loop)."""
    if n.kind == "text":
        def run(s: dict, g: bool, inner: bool, v: str = n.value) -> Iterator[Event]:
            yield v, g
    elif n.kind == "out":
        def run(s: dict, g: bool, inner: bool, e: Callable = _value(n.parts[0])) -> Iterator[Event]:
            yield _text(e(s)), g
    elif n.kind == "all":
        def run(s: dict, g: bool, inner: bool, parts: tuple = tuple(map(_emit, n.parts))) -> Iterator[Event]:
            for p in parts:
                yield from p(s, g, inner)
    elif n.kind == "gen":
        def run(s: dict, g: bool, inner: bool, body: Emit = _emit(n.parts[0])) -> Iterator[Event]:
            yield from body(s, True, inner)
    elif n.kind == "if":
        def run(s: dict, g: bool, inner: bool, test: Callable = _value(n.parts[0]), yes: Emit = _emit(n.parts[1]), no: Emit = _emit(n.parts[2])) -> Iterator[Event]:
            yield from (yes if test(s) else no)(s, g, inner)
    else:
        def run(s: dict, g: bool, inner: bool, name: str = n.value, over: Callable = _value(n.parts[0]), body: Emit = _emit(n.parts[1])) -> Iterator[Event]:
            values = over(s)
            for i, v in enumerate(values if hasattr(values, "__next__") or isinstance(values, list) else ()):
                yield from body({**s, name: v, "loop": {"index": i + 1, "first": i == 0}}, g, True)
                if not inner:
                    yield None
    return run


def compiled(source: str) -> Callable[[Iterator[dict]], Iterator[Event]]:
    """A renderer of messages ({'role': ..., 'text': ...})."""
    run = _emit(fold(parse(source)))
    return lambda messages: run({"messages": messages}, False, False)


# --- Spark jobs ----------------------------------------------------------------------------

def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Any, Iterator[tuple]]]:
    """Consecutive rows with equal first value, streamed."""
    from itertools import groupby
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
    for key, group in groupby(rows, key=lambda r: r[0]):
        yield key, group


def _pieces(events: Iterator[Event]) -> Iterator[tuple[str, list[int]]]:
    """Text and flat [start, end, ...] of generated spans, cut between messages."""
    text: list[str] = []
    at, loss = 0, []
    for e in events:
        if e is None:
            if at >= PIECE:
                yield "".join(text), loss
                text, at, loss = [], 0, []
            continue
        if e[1]:
            loss += [at, at + len(e[0])]
        text.append(e[0])
        at += len(e[0])
    if text or not at:
        yield "".join(text), loss


def _table(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(schema)], [n for n, _ in schema])


def formatted(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, piece, text, loss of every conversation (conv_id, turn, role, text).

    Rows of a conversation are taken by turn, equal turns by role and text. Null role and text
    are empty. loss lists start and end of the generated spans in `text`. Conversations longer
    than about PIECE characters go on in further pieces, cut between turns. Repeated rows are
    repeated turns; null ids are one conversation. An empty table gives an empty result.
    """
    schema = [("conv_id", pa.int64()), ("piece", pa.int32()), ("text", pa.string()), ("loss", pa.list_(pa.int32()))]
    compiled(template)  # faults in the template show here

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render, out, size = compiled(template), [], 0
        for conv, rows in _runs(batches):
            messages = ({"role": r[1], "text": r[2]} for r in rows)
            for k, (text, loss) in enumerate(_pieces(render(messages))):
                out.append((conv, k, text, loss))
                size += len(text)
                if size >= PIECE:
                    yield _table(out, schema)
                    out, size = [], 0
        yield _table(out, schema)

    empty = [F.coalesce(conversations[c], F.lit("")).alias(c) for c in ("role", "text")]
    rows = conversations.select(F.col("conv_id").cast("long"), "turn", *empty)
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, FORMATTED)


def turns(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of what TEMPLATE has made."""
    at = 0
    while at < len(text):
        if text.startswith("<s>", at):
            mid = text.index("[INST] ", at)
            end = text.index(" [/INST]", mid)
            yield unescape(text[at + 3:mid]), unescape(text[mid + 7:end])
            at = end + 8
        else:
            end = text.index("</s>", at)
            yield "assistant", unescape(text[at:end])
            at = end + 4


def digests(output: DataFrame) -> DataFrame:
    """Per conversation, from the formatted text alone: n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars."""
    schema = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
              ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for conv, rows in _runs(batches):
            said, learned, n, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for _, text, loss in rows:
                chars += len(text)
                for role, t in turns(text):
                    n += 1
                    said.update(f"{role}\n{t}\n".encode())
                for a, b in zip(loss[::2], loss[1::2]):
                    t = unescape(text[a:b])
                    loss_chars += len(t)
                    learned.update(t.encode())
            out.append((conv, n, said.hexdigest(), loss_chars, learned.hexdigest(), chars))
            if len(out) >= 4096:
                yield _table(out, schema)
                out = []
        yield _table(out, schema)

    ordered = output.repartition("conv_id").sortWithinPartitions("conv_id", "piece").select("conv_id", "text", "loss")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
