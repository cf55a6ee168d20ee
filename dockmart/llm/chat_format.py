"""Chat formatting: a small template language, compiled to Python closures.

**Language** (a sandbox: a template can only read the names given to it, no attributes, calls or imports)::

    {{ expression }}     {% set name = expression %}     {# comment #}
    {% for m in messages %} ... {% endfor %}             loop.index, loop.first, loop.last inside
    {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}             what it renders is under the loss mask

Expressions have strings, whole numbers, true/false/none, names, ``m['role']`` or ``m.role``, ``+`` and ``~`` (joining),
``== != < > <= >= in``, ``not and or``, parentheses and the filters ``escape``, ``escape_name``, ``trim``, ``lower``,
``upper`` and ``length``. A ``-`` inside a tag's brace trims the white space beside it.

**Compilation.** The text is parsed to a syntax tree; constant expressions are folded, constant conditions keep one branch
only and neighbouring texts are joined; each node becomes a closure that yields (text, under mask) segments. ``messages`` is
read as a stream with one message of look-ahead (for ``loop.last``), so rendering holds one turn at a time, however long the
conversation.

**Escaping** is reversible and leaves no control string in a text: ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``;
in names (roles) a line feed also becomes ``\\n``.

Scale: rows are shuffled by conv_id and sorted by turn; one task streams through its conversations. A conversation with a
third of all rows is rendered turn by turn and never held whole. The formatted output is a table of numbered pieces; equal
turns are ordered by role and text.

Edge cases: null role or text are empty; rows with a null conv_id form one conversation of that id; null turns come first.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"

#: Marks each turn; an assistant's text is under the loss mask.
CHAT_TEMPLATE = (
    "{% for m in messages %}{{ '<|im_start|>' + m['role'] | escape_name + '\n' }}"
    "{% if m['role'] == 'assistant' %}{% generation %}{{ m['text'] | escape }}{% endgeneration %}"
    "{% else %}{{ m['text'] | escape }}{% endif %}{{ '<|im_end|>' + '\n' }}{% endfor %}"
)


class TemplateError(ValueError):
    """The template cannot be compiled, or reads a name or key that is not there."""


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_name(text: str) -> str:
    return escape(text).replace("\n", "\\n")


_ESCAPED = re.compile(r"\\(.)", re.S)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def unescape_name(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


FILTERS: dict[str, Callable] = {
    "escape": lambda x: escape(_text(x)),
    "escape_name": lambda x: escape_name(_text(x)),
    "trim": lambda x: _text(x).strip(),
    "lower": lambda x: _text(x).lower(),
    "upper": lambda x: _text(x).upper(),
    "length": len,
}


def _text(value) -> str:
    return "" if value is None else "true" if value is True else "false" if value is False else str(value)


# Expressions: the syntax tree


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: object
    key: str


@dataclass(frozen=True)
class Apply:
    """A filter or operator on arguments."""

    op: str
    args: tuple


@dataclass(frozen=True)
class Output:
    expr: object


@dataclass(frozen=True)
class Assign:
    name: str
    expr: object


@dataclass(frozen=True)
class Loop:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class Branch:
    """(condition, body) pairs; the condition of an else is Const(True)."""

    arms: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


_OPERATORS: dict[str, Callable] = {
    "+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else _text(a) + _text(b),
    "~": lambda a, b: _text(a) + _text(b),
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "not": lambda a: not a,
}

_LEXEME = re.compile(r"\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-+~<>()\[\]|.,=]))", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class _Expression:
    """A recursive-descent parser of one expression."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.rstrip()
        while at < len(source):
            match = _LEXEME.match(source, at)
            if not match:
                raise TemplateError(f"unexpected {source[at : at + 10]!r}")
            kind = match.lastgroup
            self.tokens.append((kind, match[kind]))
            at = match.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "string" and self.tokens[self.at][1] in values

    def take(self, *values: str) -> str | None:
        if self.peek(*values):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"expected {value!r}")

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("expected a name")

    def whole(self):
        expr = self.disjunction()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return expr

    def disjunction(self):
        expr = self.conjunction()
        while self.take("or"):
            expr = Apply("or", (expr, self.conjunction()))
        return expr

    def conjunction(self):
        expr = self.negation()
        while self.take("and"):
            expr = Apply("and", (expr, self.negation()))
        return expr

    def negation(self):
        return Apply("not", (self.negation(),)) if self.take("not") else self.comparison()

    def comparison(self):
        expr = self.joined()
        while op := self.take("==", "!=", "<", ">", "<=", ">=", "in"):
            expr = Apply(op, (expr, self.joined()))
        return expr

    def joined(self):
        expr = self.filtered()
        while op := self.take("+", "~"):
            expr = Apply(op, (expr, self.filtered()))
        return expr

    def filtered(self):
        expr = self.primary()
        while True:
            if self.take("|"):
                name = self.name()
                if name not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                expr = Apply(f"|{name}", (expr,))
            elif self.take("."):
                expr = self.item(expr, self.name())
            elif self.take("["):
                key = self.disjunction()
                self.need("]")
                if not isinstance(key, Const) or not isinstance(key.value, str):
                    raise TemplateError("a key must be a string")
                expr = self.item(expr, key.value)
            else:
                return expr

    def item(self, of, key: str):
        if key.startswith("_"):
            raise TemplateError(f"key {key!r} is not allowed")
        return Item(of, key)

    def primary(self):
        if self.take("("):
            expr = self.disjunction()
            self.need(")")
            return expr
        if self.at >= len(self.tokens):
            raise TemplateError("expected an expression")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "number":
            return Const(int(value))
        if kind == "name" and value in ("true", "false", "none"):
            return Const({"true": True, "false": False, "none": None}[value])
        if kind == "name":
            if value.startswith("_"):
                raise TemplateError(f"name {value!r} is not allowed")
            return Name(value)
        raise TemplateError(f"unexpected {value!r}")


_TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#(-?).*?(-?)#\}", re.S)


def parse(template: str) -> tuple:
    """The syntax tree of a template."""
    tokens: list[tuple[str, str]] = []
    at, trim = 0, False
    for match in _TAG.finditer(template):
        before, after = match[1] or match[4] or match[7], match[3] or match[6] or match[8]
        text = template[at : match.start()]
        text = text.lstrip() if trim else text
        tokens.append(("text", text.rstrip() if before else text))
        if match[2] is not None:
            tokens.append(("output", match[2]))
        elif match[5] is not None:
            tokens.append(("tag", match[5].strip()))
        at, trim = match.end(), bool(after)
    tokens.append(("text", template[at:].lstrip() if trim else template[at:]))
    nodes, rest = _nodes(tokens, 0, ())
    if rest != len(tokens):
        raise TemplateError(f"unexpected {tokens[rest][1]!r}")
    return nodes


def _nodes(tokens: list[tuple[str, str]], at: int, stop: tuple[str, ...]) -> tuple[tuple, int]:
    out = []
    while at < len(tokens):
        kind, value = tokens[at]
        word = value.split(None, 1)[0] if kind == "tag" and value else ""
        if kind == "tag" and word in stop:
            return tuple(out), at
        at += 1
        if kind == "text":
            out.append(Output(Const(value)))
        elif kind == "output":
            out.append(Output(_Expression(value).whole()))
        elif word == "set":
            match = re.fullmatch(r"set\s+([A-Za-z]\w*)\s*=(?!=)(.*)", value, re.S)
            if not match:
                raise TemplateError(f"cannot read {value!r}")
            out.append(Assign(match[1], _Expression(match[2]).whole()))
        elif word == "for":
            match = re.fullmatch(r"for\s+([A-Za-z]\w*)\s+in\s+(.*)", value, re.S)
            if not match:
                raise TemplateError(f"cannot read {value!r}")
            body, at = _nodes(tokens, at, ("endfor",))
            at = _past(tokens, at, "endfor")
            out.append(Loop(match[1], _Expression(match[2]).whole(), body))
        elif word == "if":
            arms, condition = [], _Expression(value[2:]).whole()
            while True:
                body, at = _nodes(tokens, at, ("elif", "else", "endif"))
                arms.append((condition, body))
                if at >= len(tokens):
                    raise TemplateError("if without endif")
                tag = tokens[at][1]
                at += 1
                if tag == "endif":
                    break
                condition = Const(True) if tag == "else" else _Expression(tag[4:]).whole()
            out.append(Branch(tuple(arms)))
        elif word == "generation":
            body, at = _nodes(tokens, at, ("endgeneration",))
            at = _past(tokens, at, "endgeneration")
            out.append(Generation(body))
        else:
            raise TemplateError(f"no tag {value!r}")
    if stop:
        raise TemplateError(f"missing {stop[-1]!r}")
    return tuple(out), at


def _past(tokens: list, at: int, tag: str) -> int:
    if at >= len(tokens) or tokens[at][1] != tag:
        raise TemplateError(f"missing {tag!r}")
    return at + 1


# Constant folding


def fold_expr(expr):
    """The expression with its constant parts computed."""
    if isinstance(expr, Apply):
        args = tuple(fold_expr(a) for a in expr.args)
        if expr.op in ("and", "or") and isinstance(args[0], Const):
            takes_first = bool(args[0].value) == (expr.op == "or")
            return args[0] if takes_first else args[1]
        if expr.op in ("+", "~") and isinstance(args[0], Apply) and args[0].op == "~" and isinstance(args[1], Const) and isinstance(args[0].args[1], Const):
            return Apply("~", (args[0].args[0], Const(_text(args[0].args[1].value) + _text(args[1].value))))
        if all(isinstance(a, Const) for a in args) and expr.op not in ("and", "or"):
            return Const(_apply(expr.op)(*[a.value for a in args]))
        return Apply(expr.op, args)
    if isinstance(expr, Item):
        return Item(fold_expr(expr.of), expr.key)
    return expr


def fold(nodes: tuple) -> tuple:
    """The tree with constants computed, constant branches chosen and neighbouring texts joined."""
    out: list = []

    def add(node) -> None:
        if isinstance(node, Output) and isinstance(node.expr, Const):
            text = _text(node.expr.value)
            if out and isinstance(out[-1], Output) and isinstance(out[-1].expr, Const):
                text = out.pop().expr.value + text
            if not text:
                return
            node = Output(Const(text))
        out.append(node)

    for node in nodes:
        if isinstance(node, Output):
            add(Output(fold_expr(node.expr)))
        elif isinstance(node, Assign):
            add(Assign(node.name, fold_expr(node.expr)))
        elif isinstance(node, Loop):
            add(Loop(node.name, fold_expr(node.over), fold(node.body)))
        elif isinstance(node, Generation):
            add(Generation(fold(node.body)))
        else:
            arms = []
            for condition, body in node.arms:
                condition = fold_expr(condition)
                if isinstance(condition, Const) and not condition.value:
                    continue
                arms.append((condition, fold(body)))
                if isinstance(condition, Const):
                    break
            if arms and isinstance(arms[0][0], Const):
                for inner in arms[0][1]:
                    add(inner)
            elif arms:
                add(Branch(tuple(arms)))
    return tuple(out)


def _apply(op: str) -> Callable:
    return FILTERS[op[1:]] if op[0] == "|" else _OPERATORS[op]


# Closures


def _expr_closure(expr) -> Callable[[dict], object]:
    if isinstance(expr, Const):
        value = expr.value
        return lambda scope: value
    if isinstance(expr, Name):
        name = expr.name

        def read(scope):
            if name not in scope:
                raise TemplateError(f"no name {name!r}")
            return scope[name]

        return read
    if isinstance(expr, Item):
        of, key = _expr_closure(expr.of), expr.key

        def item(scope):
            found = of(scope)
            if not isinstance(found, dict) or key not in found:
                raise TemplateError(f"no key {key!r}")
            return found[key]

        return item
    args = [_expr_closure(a) for a in expr.args]
    if expr.op == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if expr.op == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    fn = _apply(expr.op)
    if len(args) == 1:
        one = args[0]
        return lambda scope: fn(one(scope))
    left, right = args
    return lambda scope: fn(left(scope), right(scope))


Segment = tuple[str, bool]


def _node_closure(node) -> Callable[[dict, bool], Iterator[Segment]]:
    if isinstance(node, Output):
        expr = _expr_closure(node.expr)

        def output(scope, masked):
            yield _text(expr(scope)), masked

        return output
    if isinstance(node, Assign):
        name, expr = node.name, _expr_closure(node.expr)

        def assign(scope, masked):
            scope[name] = expr(scope)
            yield from ()

        return assign
    if isinstance(node, Generation):
        body = _body_closure(node.body)
        return lambda scope, masked: body(scope, True)
    if isinstance(node, Branch):
        arms = [(_expr_closure(c), _body_closure(b)) for c, b in node.arms]

        def branch(scope, masked):
            for condition, body in arms:
                if condition(scope):
                    yield from body(scope, masked)
                    return

        return branch
    name, over, body = node.name, _expr_closure(node.over), _body_closure(node.body)

    def loop(scope, masked):
        values = iter(over(scope))
        missing = object()
        value, index = next(values, missing), 0
        while value is not missing:
            after = next(values, missing)
            index += 1
            inner = scope | {name: value, "loop": {"index": index, "first": index == 1, "last": after is missing}}
            yield from body(inner, masked)
            value = after

    return loop


def _body_closure(nodes: tuple) -> Callable[[dict, bool], Iterator[Segment]]:
    parts = [_node_closure(n) for n in nodes]

    def body(scope, masked):
        for part in parts:
            yield from part(scope, masked)

    return body


def compile_template(template: str) -> Callable[[Iterable[dict]], Iterator[Segment]]:
    """A function from messages (dicts, may be a stream) to (text, under mask) segments."""
    body = _body_closure(fold(parse(template)))
    return lambda messages, **names: body(names | {"messages": messages}, False)


# Spark


_PIECES = "conv_id long, piece long, text string, loss boolean"
_PIECE_SCHEMA = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("text", pa.string()), ("loss", pa.bool_())])
_FLUSH_CHARS = 4 << 20


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, role, text) of sorted batches, one row at a time."""
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)


def _conversations(rows: Iterator[tuple]) -> Iterator[tuple[int | None, Iterator[dict]]]:
    """Each conversation's id and a stream of its messages; a stream ends before the next one starts."""
    waiting = next(rows, None)
    while waiting is not None:
        conv_id = waiting[0]

        def messages():
            nonlocal waiting
            while waiting is not None and waiting[0] == conv_id:  # noqa: B023
                row, waiting = waiting, next(rows, None)
                yield {"role": row[1] or "", "text": row[2] or ""}

        stream = messages()
        yield conv_id, stream
        for _ in stream:  # a template need not read all messages
            pass


def format_conversations(turns: DataFrame, template: str = CHAT_TEMPLATE) -> DataFrame:
    """(conv_id, piece, text, loss): the formatted output of each conversation, cut into numbered pieces.

    The pieces of a conversation, in order and joined by nothing, are its formatted text; ``loss`` says which pieces are
    under the mask. All pieces of a conversation are in one partition, in order.
    """
    compile_template(template)  # a faulty template fails here, not in a task
    ordered = (
        turns.select(
            F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        rows: list[tuple] = []
        size = 0
        for conv_id, messages in _conversations(_turns(batches)):
            piece = 0
            for text, loss in render(messages):
                if not text:
                    continue
                rows.append((conv_id, piece, text, loss))
                piece += 1
                size += len(text)
                if size > _FLUSH_CHARS or len(rows) > 20_000:
                    yield _pieces(rows)
                    rows, size = [], 0
        if rows:
            yield _pieces(rows)

    return ordered.mapInArrow(run, _PIECES)


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECE_SCHEMA, strict=True)], schema=_PIECE_SCHEMA)


class _Reader:
    """Reads one conversation back from its pieces: splits at control strings, unescapes, hashes; holds one turn at most."""

    def __init__(self) -> None:
        self.turns, self.digest, self.loss = 0, hashlib.sha256(), hashlib.sha256()
        self.loss_chars = self.chars = 0
        self.rest = ""
        self.masked: list[str] = []

    def feed(self, text: str, loss: bool) -> None:
        self.chars += len(text)
        if loss:
            self.masked.append(text)
        elif self.masked:
            self._close_mask()
        self.rest += text
        while (end := self.rest.find(END)) >= 0:
            turn, self.rest = self.rest[:end], self.rest[end + len(END) :]
            start = turn.index(START) + len(START)
            role, text = turn[start:].split("\n", 1)
            self.turns += 1
            self.digest.update(f"{unescape_name(role)}\n{unescape(text)}\n".encode())

    def _close_mask(self) -> None:
        text = unescape("".join(self.masked))
        self.masked = []
        self.loss_chars += len(text)
        self.loss.update(text.encode())

    def result(self) -> tuple:
        self._close_mask()
        return self.turns, self.digest.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(pieces: DataFrame) -> DataFrame:
    """One row per conversation, read back from pieces as ``format_conversations`` lays them (in order, not split)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in _DIGESTS.split(", ")]
        out, reader, now = [], None, None
        for batch in batches:
            ids, texts, losses = (batch.column(i).to_pylist() for i in range(3))
            for conv_id, text, loss in zip(ids, texts, losses, strict=True):
                if reader is None or conv_id != now:
                    if reader is not None:
                        out.append((now, *reader.result()))
                    reader, now = _Reader(), conv_id
                reader.feed(text, loss)
            if len(out) > 5000:
                yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=names), schema=_DIGEST_SCHEMA, preserve_index=False)
                out = []
        if reader is not None:
            out.append((now, *reader.result()))
        if out:
            yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=names), schema=_DIGEST_SCHEMA, preserve_index=False)

    return pieces.select("conv_id", "text", "loss").mapInArrow(run, _DIGESTS)


_DIGEST_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)
