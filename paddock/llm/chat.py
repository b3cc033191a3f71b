"""Chat formatting: a small template language compiled to Python closures.

A template is text with ``{{ expression }}`` and ``{% statement %}``:

    {% for m in messages %} ... {% endfor %}     {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}
    {% set name = e %}                           {% generation %} ... {% endgeneration %}

Expressions have strings, whole numbers, true, false, none, names, fields
(``m.role``), ``+`` and ``~`` on strings, ``==`` and ``!=``, ``not``, ``and``,
``or``, parentheses and filters (``m.text | escape``). There are no calls, no
attributes of Python objects and no imports: a field is looked up in a message or
in ``loop`` and nowhere else, so a template cannot reach anything but its input.

The template is parsed into a syntax tree, constant parts of the tree are folded,
and every node becomes a closure that yields pieces of text with a mark that says
whether they lie in a generation block. Messages are taken one at a time, so a
conversation of any length is rendered in the memory of one message.

Control strings inside texts are escaped with a backslash and can be read back:
``escape`` puts one before every backslash and control string, ``read`` undoes it.

Defined cases: a missing role or text is empty; turns with one number are ordered
by role and text, a missing turn comes first; a missing conversation id is a
conversation of its own; repeated rows are repeated turns; no rows, no result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import batched, groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from paddock.llm.batches import ROWS, small_batches

# What marks turns. ``###`` and the end mark must not stand bare in a
# text, nor a line end in a role.
START, END = "### ", "</turn>"
TEMPLATE = (
    "{% for m in messages %}### {{ m.role | escape_line }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}</turn>\n{% endfor %}"
)

_CONTROL = re.compile(r"\\|#(?=##)|<(?=/turn>)")
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def escape_line(text: str) -> str:
    return escape(text).replace("\n", "\\\n")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape, "escape_line": escape_line, "trim": str.strip, "lower": str.lower, "upper": str.upper, "title": str.title,
}


class TemplateError(ValueError):
    """A template that does not follow the language."""


# Syntax tree ---------------------------------------------------------------

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
class Unary:
    value: object


@dataclass(frozen=True)
class Binary:
    op: str
    left: object
    right: object


@dataclass(frozen=True)
class Filter:
    value: object
    name: str


@dataclass(frozen=True)
class Put:
    value: object


@dataclass(frozen=True)
class Set:
    name: str
    value: object


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


_PART = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"""\s*(?:('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(\d+)|([A-Za-z_]\w*)|(==|!=|[()|.+~=]))""", re.S)
_LITERAL = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"true": True, "false": False, "none": None}
_BINDING = (("or",), ("and",), ("==", "!="), ("+", "~"))


class _Expression:
    """Parses one expression, or the words of one statement."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if m is None:
                raise TemplateError(f"cannot read {source[at:at + 20]!r}")
            kind = next(i for i in range(1, 5) if m[i] is not None)
            self.tokens.append((kind, m[kind]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else (0, None)
        return text if kind in (3, 4) else None

    def accept(self, text: str) -> bool:
        if self.peek() != text:
            return False
        self.at += 1
        return True

    def expect(self, text: str) -> None:
        if not self.accept(text):
            raise TemplateError(f"{text!r} expected")

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != 3:
            raise TemplateError("a name expected")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def close(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")

    def whole(self):
        node = self.binary(0)
        self.close()
        return node

    def binary(self, level: int):
        if level == len(_BINDING):
            return self.filtered()
        if level == 2 and self.accept("not"):
            return Unary(self.binary(2))
        node = self.binary(level + 1)
        while (op := self.peek()) in _BINDING[level]:
            self.at += 1
            node = Binary(op, node, self.binary(level + 1))
        return node

    def filtered(self):
        node = self.primary()
        while True:
            if self.accept("|"):
                name = self.name()
                if name not in FILTERS:
                    raise TemplateError(f"unknown filter {name!r}")
                node = Filter(node, name)
            elif self.accept("."):
                node = Field(node, self.name())
            else:
                return node

    def primary(self):
        if self.accept("("):
            node = self.binary(0)
            self.expect(")")
            return node
        if self.at >= len(self.tokens):
            raise TemplateError("an expression expected")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == 1:
            return Const(re.sub(r"\\(.)", lambda m: _LITERAL.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == 2:
            return Const(int(text))
        if kind == 3:
            return Const(_WORDS[text]) if text in _WORDS else Name(text)
        raise TemplateError(f"unexpected {text!r}")


class _Parser:
    def __init__(self, source: str):
        self.parts, at = [], 0
        for m in _PART.finditer(source):
            if m.start() > at:
                self.parts.append(("text", source[at:m.start()]))
            self.parts.append(("put", m[1]) if m[1] is not None else ("do", m[2]))
            at = m.end()
        if at < len(source):
            self.parts.append(("text", source[at:]))
        self.at = 0

    def body(self, *ends: str) -> tuple[tuple, str | None, _Expression | None]:
        """Nodes up to one of the closing words, that word, and the rest of its statement."""
        nodes = []
        while self.at < len(self.parts):
            kind, source = self.parts[self.at]
            self.at += 1
            if kind == "text":
                nodes.append(Put(Const(source)))
            elif kind == "put":
                nodes.append(Put(_Expression(source).whole()))
            else:
                line = _Expression(source)
                word = line.name()
                if word in ends:
                    return tuple(nodes), word, line
                nodes.append(self.statement(word, line))
        if ends:
            raise TemplateError(f"{' or '.join(ends)} expected")
        return tuple(nodes), None, None

    def statement(self, word: str, line: _Expression):
        if word == "for":
            name = line.name()
            line.expect("in")
            over = line.whole()
            body, _, end = self.body("endfor")
            end.close()
            return For(name, over, body)
        if word == "if":
            return self.branch(line)
        if word == "set":
            name = line.name()
            line.expect("=")
            return Set(name, line.whole())
        if word == "generation":
            line.close()
            body, _, end = self.body("endgeneration")
            end.close()
            return Generation(body)
        raise TemplateError(f"unknown statement {word!r}")

    def branch(self, line: _Expression) -> If:
        test = line.whole()
        then, word, rest = self.body("elif", "else", "endif")
        if word == "elif":
            return If(test, then, (self.branch(rest),))
        rest.close()
        if word == "endif":
            return If(test, then, ())
        other, _, rest = self.body("endif")
        rest.close()
        return If(test, then, other)


def parse(source: str) -> tuple:
    return _Parser(source).body()[0]


def fold(body: tuple) -> tuple:
    """The same nodes with constant expressions worked out, dead branches gone and constant texts joined."""
    out: list = []
    for node in body:
        if isinstance(node, If):
            test = _folded(node.test)
            if isinstance(test, Const):
                out.extend(fold(node.then if test.value else node.other))
            else:
                out.append(If(test, fold(node.then), fold(node.other)))
        elif isinstance(node, For):
            out.append(For(node.name, _folded(node.over), fold(node.body)))
        elif isinstance(node, Generation):
            out.append(Generation(fold(node.body)))
        else:
            out.append(type(node)(**{**node.__dict__, "value": _folded(node.value)}))
    joined: list = []
    for node in out:
        if isinstance(node, Put) and isinstance(node.value, Const):
            text = _text(node.value.value)
            if joined and isinstance(joined[-1], Put) and isinstance(joined[-1].value, Const):
                joined[-1] = Put(Const(joined[-1].value.value + text))
            elif text:
                joined.append(Put(Const(text)))
        else:
            joined.append(node)
    return tuple(joined)


def _folded(node):
    if isinstance(node, Field):
        return Field(_folded(node.of), node.name)
    if isinstance(node, (Const, Name)):
        return node
    parts = {k: _folded(v) for k, v in node.__dict__.items() if k not in ("op", "name")}
    whole = type(node)(**{**node.__dict__, **parts})
    return Const(_value(whole)({})) if all(isinstance(v, Const) for v in parts.values()) else whole


def _text(value) -> str:
    return "" if value is None else str(value)


def _look_up(scope: dict, name: str):
    if name not in scope:
        raise TemplateError(f"unknown name {name!r}")
    return scope[name]


def _field(value, name: str):
    if not isinstance(value, dict) or name not in value:
        raise TemplateError(f"no field {name!r}")
    return value[name]


def _value(node) -> Callable[[dict], object]:
    """The closure of one expression."""
    if isinstance(node, Const):
        return lambda scope, value=node.value: value
    if isinstance(node, Name):
        return lambda scope, name=node.name: _look_up(scope, name)
    if isinstance(node, Field):
        of, name = _value(node.of), node.name
        return lambda scope: _field(of(scope), name)
    if isinstance(node, Unary):
        inner = _value(node.value)
        return lambda scope: not inner(scope)
    if isinstance(node, Filter):
        inner, change = _value(node.value), FILTERS[node.name]
        return lambda scope: change(_text(inner(scope)))
    left, right = _value(node.left), _value(node.right)
    return {
        "or": lambda scope: left(scope) or right(scope),
        "and": lambda scope: left(scope) and right(scope),
        "==": lambda scope: left(scope) == right(scope),
        "!=": lambda scope: left(scope) != right(scope),
        "+": lambda scope: _text(left(scope)) + _text(right(scope)),
        "~": lambda scope: _text(left(scope)) + _text(right(scope)),
    }[node.op]


Piece = tuple[str, bool]
Renderer = Callable[[dict], Iterator[Piece]]


def _renderer(body: tuple, generated: bool) -> Renderer:
    """The closure of a body: yields (text, in a generation block)."""
    steps = [_step(node, generated) for node in body]

    def render(scope: dict) -> Iterator[Piece]:
        for step in steps:
            yield from step(scope)

    return render


def _step(node, generated: bool) -> Renderer:
    if isinstance(node, Put):
        if isinstance(node.value, Const):
            fixed = ((_text(node.value.value), generated),)
            return lambda scope: fixed
        value = _value(node.value)
        return lambda scope: ((_text(value(scope)), generated),)
    if isinstance(node, Generation):
        if generated:
            raise TemplateError("a generation block inside another")
        return _renderer(node.body, True)
    if isinstance(node, Set):
        value, name = _value(node.value), node.name

        def assign(scope: dict) -> Iterator[Piece]:
            scope[name] = value(scope)
            return iter(())

        return assign
    if isinstance(node, If):
        test, then, other = _value(node.test), _renderer(node.then, generated), _renderer(node.other, generated)
        return lambda scope: then(scope) if test(scope) else other(scope)
    over, body, name = _value(node.over), _renderer(node.body, generated), node.name

    def loop(scope: dict) -> Iterator[Piece]:
        items = iter(over(scope))
        index, item = 0, next(items, _DONE)
        while item is not _DONE:
            following = next(items, _DONE)
            inner = dict(scope)
            inner[name] = item
            inner["loop"] = {"index": index + 1, "index0": index, "first": index == 0, "last": following is _DONE}
            yield from body(inner)
            index, item = index + 1, following

    return loop


_DONE = object()


def compile_template(source: str) -> Callable[[Iterator[dict]], Iterator[Piece]]:
    """A renderer of (role, text) messages; errors of the template show here."""
    render = _renderer(fold(parse(source)), False)
    return lambda messages: render({"messages": messages})


# Spark ---------------------------------------------------------------------

def _ordered(conversations: DataFrame) -> DataFrame:
    """Turns of a conversation next to each other and in order. One conversation is
    one output and so one task reads it, row by row."""
    turns = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for some in batched(rows, ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), schema.types)], schema=schema)


# Characters of one stored piece of output, about.
CHUNK = 1 << 16


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, chunk, text, generated) where the texts of a conversation, in order, are its formatted form.

    ``generated`` lists (start, stop) of the parts of a chunk that lie in generation
    blocks, in code points of the chunk. Chunks keep a long conversation out of
    one row; the rows of a conversation stay together and in order.
    """
    small_batches(conversations.sparkSession)
    compile_template(template)
    kind = conversations.schema["conv_id"].dataType.simpleString()

    schema = pa.schema([("conv_id", to_arrow_type(conversations.schema["conv_id"].dataType)), ("chunk", pa.int64()),
                        ("text", pa.string()), ("generated", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        render = compile_template(template)
        for conv, group in groupby(_rows(batches), key=itemgetter(0)):
            held, marks, size, chunk = [], [], 0, 0
            for text, generated in render({"role": role, "text": said} for _, _, role, said in group):
                if generated and text:
                    marks.append({"start": size, "stop": size + len(text)})
                held.append(text)
                size += len(text)
                if size >= CHUNK:
                    yield conv, chunk, "".join(held), marks
                    held, marks, size, chunk = [], [], 0, chunk + 1
            if size or not chunk:
                yield conv, chunk, "".join(held), marks

    return _ordered(conversations).mapInArrow(
        lambda batches: _batches(chunks(batches), schema),
        f"conv_id {kind}, chunk long, text string, generated array<struct<start:int,stop:int>>")


_NEXT = re.compile(r"\\.|" + re.escape(END) + r"\n|\n", re.S)


def read(texts: Iterator[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns in chunks of the default template's output, unescaped."""
    rest = ""
    for text in texts:
        rest += text
        at = 0
        while (turn := _turn(rest, at)) is not None:
            role, said, at = turn
            yield role, said
        rest = rest[at:]
    if rest:
        raise ValueError("the output ends inside a turn")


def _turn(text: str, at: int) -> tuple[str, str, int] | None:
    if not text.startswith(START, at):
        if at < len(text) and not START.startswith(text[at:]):
            raise ValueError("a turn must begin with its mark")
        return None
    role = None
    for m in _NEXT.finditer(text, at + len(START)):
        if m[0] == "\n" and role is None:
            role, begin = text[at + len(START):m.start()], m.end()
        elif m[0][0] == "<":
            return unescape(role), unescape(text[begin:m.start()]), m.end()
    return None


def digests(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from the output.

    Takes the rows of ``format_conversations`` as they come: a conversation's
    chunks next to each other and in order.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()

    schema = pa.schema([("conv_id", to_arrow_type(formatted.schema["conv_id"].dataType)), ("n_turns", pa.int64()),
                        ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                        ("formatted_chars", pa.int64())])

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv, group in groupby(_rows(batches), key=itemgetter(0)):
            yield conv, *_digest((text, marks) for _, _, text, marks in group)

    return formatted.mapInArrow(
        lambda batches: _batches(told(batches), schema),
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _digest(chunks: Iterator[tuple[str, list]]) -> tuple[int, str, int, str, int]:
    turns, loss, n, size, lost = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

    def texts() -> Iterator[str]:
        nonlocal size, lost
        for text, marks in chunks:
            size += len(text)
            for m in marks:
                plain = unescape(text[m["start"]:m["stop"]])
                loss.update(plain.encode())
                lost += len(plain)
            yield text

    for role, said in read(texts()):
        n += 1
        turns.update(f"{role}\n{said}\n".encode())
    return n, turns.hexdigest(), lost, loss.hexdigest(), size
