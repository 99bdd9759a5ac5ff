"""Chat formatting with a compiled, sandboxed template language.

A template is text with ``{{ expression | filter }}``, ``{% for message in messages %}``,
``{% if expression %}`` / ``{% else %}``, ``{% generation %}`` and their ``{% end... %}``.
Expressions are string literals, dotted names and the operators ``+ == != and or not``;
names are looked up in what the caller gives and nowhere else, so no Python attribute
can be reached. A template is parsed into a syntax tree, constants are folded, and the
tree becomes Python closures that yield pieces of text with a generation mark.

``messages`` is a stream with one message of look-ahead: a conversation is rendered
turn by turn and never held as a whole, however many turns it has.

Null roles and texts are empty. Turns are ordered by turn (null first), role and text,
so repeated turns have one order; a null conversation id is a conversation. An empty
table gives an empty result. Other columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TEMPLATE = (
    "{% for message in messages %}"
    "{{ '<|im_start|>' + message.role | line | escape }}\n"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}"
    "{{ '<|im_end|>' + '\n' }}"
    "{% endfor %}"
)
#: Characters of a stored part, after which the next one begins.
PART_CHARS = 1 << 20

# ---------------------------------------------------------------- reversible escapes


def escape(text: str) -> str:
    """Break every control string: one more backslash between ``<`` and ``|``."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def line(text: str) -> str:
    """Keep a text on one line."""
    return text.replace("\\", "\\\\").replace("\n", "\\n")


def unline(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "line": line, "trim": str.strip, "upper": str.upper, "lower": str.lower}

# ---------------------------------------------------------------- syntax tree


class TemplateError(ValueError):
    """The template isn't in the language."""


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    path: tuple[str, ...]


@dataclass(frozen=True)
class Call:
    """An operator or filter over its operands."""

    op: str
    args: tuple


@dataclass
class Out:
    expr: object


@dataclass
class For:
    var: str
    over: Name
    body: list = field(default_factory=list)


@dataclass
class If:
    test: object
    body: list = field(default_factory=list)
    other: list = field(default_factory=list)


@dataclass
class Generation:
    body: list = field(default_factory=list)


_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([A-Za-z_][\w.]*)|(==|!=|[+|()]))", re.S)
_STRING_ESCAPES = {"n": "\n", "t": "\t"}


class _Expression:
    """Precedence: or, and, not, == !=, +, filters."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        while source[at:].strip():
            if not (m := _TOKEN.match(source, at)):
                raise TemplateError(f"unreadable expression: {source!r}")
            self.tokens.append(m.groups())
            at = m.end()

    def parse(self):
        tree = self._binary(0)
        if self.tokens:
            raise TemplateError(f"left over: {self.tokens!r}")
        return tree

    def _next(self, *wanted: str) -> str | None:
        if self.tokens and (found := self.tokens[0][1] or self.tokens[0][2]) in wanted:
            self.tokens.pop(0)
            return found
        return None

    def _binary(self, level: int):
        if level == 2 and self._next("not"):
            return Call("not", (self._binary(2),))
        if level == 5:
            return self._operand()
        tree = self._binary(level + 1)
        while op := self._next(*(("or",), ("and",), (), ("==", "!="), ("+",))[level]):
            tree = Call(op, (tree, self._binary(level + 1)))
        return tree

    def _operand(self):
        if not self.tokens:
            raise TemplateError("an operand is missing")
        text, name, sign = self.tokens.pop(0)
        if text:
            tree = Const(re.sub(r"\\(.)", lambda m: _STRING_ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
        elif name:
            tree = Name(tuple(name.split(".")))
        elif sign == "(":
            tree = self._binary(0)
            if not self._next(")"):
                raise TemplateError("a parenthesis isn't closed")
        else:
            raise TemplateError(f"unexpected {sign!r}")
        while self._next("|"):
            op = self.tokens.pop(0)[1] if self.tokens else None
            if op not in FILTERS:
                raise TemplateError(f"unknown filter {op!r}")
            tree = Call(op, (tree,))
        return tree


def parse(template: str) -> list:
    """Syntax tree of a template."""
    root: list = []
    open_: list[tuple[str, list]] = [("", root)]
    for piece in re.split(r"(\{\{.*?\}\}|\{%.*?%\})", template, flags=re.S):
        body = open_[-1][1]
        if piece.startswith("{{"):
            body.append(Out(_Expression(piece[2:-2]).parse()))
        elif not piece.startswith("{%"):
            if piece:
                body.append(Out(Const(piece)))
        elif m := re.fullmatch(r"for (\w+) in ([\w.]+)", tag := piece[2:-2].strip()):
            body.append(node := For(m[1], Name(tuple(m[2].split(".")))))
            open_.append(("endfor", node.body))
        elif tag.startswith("if "):
            body.append(node := If(_Expression(tag[3:]).parse()))
            open_.append(("endif", node.body))
        elif tag == "else" and open_[-1][0] == "endif" and isinstance(node := open_[-2][1][-1], If):
            open_[-1] = ("endif", node.other)
        elif tag == "generation":
            body.append(node := Generation())
            open_.append(("endgeneration", node.body))
        elif tag == open_[-1][0]:
            open_.pop()
        else:
            raise TemplateError(f"unexpected tag {tag!r}")
    if len(open_) > 1:
        raise TemplateError(f"{open_[-1][0]} is missing")
    return root


# ---------------------------------------------------------------- constant folding

_OPERATORS: dict[str, Callable] = {
    "+": lambda a, b: _text(a) + _text(b),
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
    "not": lambda a: not a,
}


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def _apply(op: str) -> Callable:
    return _OPERATORS[op] if op in _OPERATORS else lambda a, f=FILTERS[op]: f(_text(a))


def fold_expression(tree):
    """Compute what depends on no name."""
    if not isinstance(tree, Call):
        return tree
    args = tuple(map(fold_expression, tree.args))
    if all(isinstance(a, Const) for a in args):
        return Const(_apply(tree.op)(*(a.value for a in args)))
    return Call(tree.op, args)


def fold(nodes: list) -> list:
    """Fold expressions, decide constant tests, and join neighbouring constant texts."""
    done: list = []
    for node in nodes:
        if isinstance(node, Out):
            node = Out(fold_expression(node.expr))
            if isinstance(node.expr, Const):
                text = _text(node.expr.value)
                if done and isinstance(done[-1], Out) and isinstance(done[-1].expr, Const):
                    text = done.pop().expr.value + text
                node = Out(Const(text))
            done.append(node)
        elif isinstance(node, If):
            test = fold_expression(node.test)
            if isinstance(test, Const):
                done.extend(fold(node.body if test.value else node.other))
            else:
                done.append(If(test, fold(node.body), fold(node.other)))
        elif isinstance(node, For):
            done.append(For(node.var, node.over, fold(node.body)))
        else:
            done.append(Generation(fold(node.body)))
    return done


# ---------------------------------------------------------------- closures

Piece = tuple[str, bool]
Render = Callable[[dict, bool], Iterator[Piece]]


def _expression(tree) -> Callable[[dict], object]:
    if isinstance(tree, Const):
        return lambda scope, value=tree.value: value
    if isinstance(tree, Name):

        def look_up(scope: dict, path=tree.path):
            value = scope
            for key in path:
                if not isinstance(value, dict):
                    raise TemplateError(f"{'.'.join(path)} has no field {key!r}")
                value = value.get(key)
            return value

        return look_up
    apply, args = _apply(tree.op), [_expression(a) for a in tree.args]
    if len(args) == 1:
        return lambda scope, a=args[0]: apply(a(scope))
    return lambda scope, a=args[0], b=args[1]: apply(a(scope), b(scope))


def _looked_ahead(items: Iterable) -> Iterator[tuple[object, dict]]:
    """Items with their ``loop`` fields; one item is held back to know the last."""
    items, index = iter(items), 0
    try:
        item = next(items)
    except StopIteration:
        return
    for following in items:
        yield item, {"index": index, "first": index == 0, "last": False}
        item, index = following, index + 1
    yield item, {"index": index, "first": index == 0, "last": True}


def _statement(node) -> Render:
    if isinstance(node, Out):
        value = _expression(node.expr)
        return lambda scope, marked: iter(((_text(value(scope)), marked),))
    if isinstance(node, Generation):
        inside = _block(node.body)
        return lambda scope, marked: inside(scope, True)
    if isinstance(node, If):
        test, yes, no = _expression(node.test), _block(node.body), _block(node.other)
        return lambda scope, marked: (yes if test(scope) else no)(scope, marked)
    over, body = _expression(node.over), _block(node.body)

    def loop(scope: dict, marked: bool) -> Iterator[Piece]:
        for item, fields in _looked_ahead(over(scope) or ()):
            yield from body(scope | {node.var: item, "loop": fields}, marked)

    return loop


def _block(nodes: list) -> Render:
    steps = [_statement(n) for n in nodes]

    def run(scope: dict, marked: bool) -> Iterator[Piece]:
        for step in steps:
            yield from step(scope, marked)

    return run


def compile_template(template: str) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """Function from messages to pieces ``(text, in a generation block)``."""
    run = _block(fold(parse(template)))
    return lambda messages: run({"messages": messages}, False)


# ---------------------------------------------------------------- on Spark

FORMATTED = "conv_id long, part int, text string, mask array<struct<start:int,stop:int>>"


def _batches(rows: Iterable[tuple], names: list[str], schema: pa.Schema, chars: int = 1 << 22):
    """Arrow batches of rows, cut by the characters of their texts."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(x) for x in row if isinstance(x, str))
        if size >= chars:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in held], schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in held], schema)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def parts(pieces: Iterable[Piece], limit: int = PART_CHARS) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Text parts of about ``limit`` characters, each with its marked spans.

    A part ends between pieces, so a span lies in one part. Empty spans are kept, since
    a generated text may be empty.
    """
    held, spans, size = [], [], 0
    for text, marked in pieces:
        if marked:
            spans.append((size, size + len(text)))
        held.append(text)
        size += len(text)
        if size >= limit:
            yield "".join(held), spans
            held, spans, size = [], [], 0
    if held:
        yield "".join(held), spans


def format_conversations(rows: DataFrame, template: str = TEMPLATE, limit: int = PART_CHARS) -> DataFrame:
    """Rendered conversations, ``FORMATTED``: the parts of one make its text.

    One shuffle by conversation, then a sort; a task streams through its rows.
    """
    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("part", pa.int32()),
            ("text", pa.string()),
            ("mask", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
        ]
    )

    def render(batches):
        write = compile_template(template)

        def rendered():
            for conv_id, turns in groupby(_rows(batches), key=lambda r: r[0]):
                messages = ({"turn": t, "role": role, "text": text} for _, t, role, text in turns)
                for k, (text, spans) in enumerate(parts(write(messages), limit)):
                    yield conv_id, k, text, [{"start": a, "stop": b} for a, b in spans]

        yield from _batches(rendered(), schema.names, schema)

    empty = F.lit("")
    turns = rows.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce("role", empty).alias("role"),
        F.coalesce("text", empty).alias("text"),
    )
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(render, FORMATTED)


def read_turns(texts: Iterable[str]) -> Iterator[tuple[str, str]]:
    """Roles and texts of a conversation from its parts in the production template."""
    held = ""
    for text in texts:
        held += text
        at = 0
        while (end := held.find(END, at)) >= 0:
            role, _, body = held[at + len(START) : end].partition("\n")
            yield unline(unescape(role)), unescape(body)
            at = end + len(END) + 1
        held = held[at:]
    if held:
        raise ValueError("the text ends inside a turn")


class _Digest:
    """Hash and length of a text that comes in pieces."""

    def __init__(self):
        self.hash, self.chars = hashlib.sha256(), 0

    def add(self, text: str) -> None:
        self.hash.update(text.encode())
        self.chars += len(text)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digest_conversations(formatted: DataFrame) -> DataFrame:
    """Read rendered conversations back and digest them, ``DIGESTS``.

    Turns are read from the text, the loss from the mask. Parts of one conversation are
    brought together and streamed in order.
    """
    schema = pa.schema(
        [(n, pa.string() if n.endswith("sha256") else pa.int64()) for n in [x.split()[0] for x in DIGESTS.split(", ")]]
    )

    def read(batches):
        def digests():
            for conv_id, own in groupby(_rows(batches), key=lambda r: r[0]):
                turns, loss, total, n = _Digest(), _Digest(), 0, 0

                def texts(own=own, loss=loss):
                    nonlocal total
                    for _, _, text, mask in own:
                        total += len(text)
                        for span in mask or ():
                            loss.add(unescape(text[span["start"] : span["stop"]]))
                        yield text

                for role, body in read_turns(texts()):
                    turns.add(f"{role}\n{body}\n")
                    n += 1
                yield conv_id, n, turns.hash.hexdigest(), loss.chars, loss.hash.hexdigest(), total

        yield from _batches(digests(), schema.names, schema)

    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return dealt.mapInArrow(read, DIGESTS)
