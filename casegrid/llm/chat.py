"""Chat formatting by compiled templates.

A small sandboxed template language is parsed into a syntax tree, constants are folded, and the tree becomes
nested Python generators that yield pieces of text, each with a flag that says whether the model is to
learn it (`{% generation %}`). Messages are an iterator, so a conversation of any length is rendered while its
rows stream by in order.

The language: text, ``{{ expression }}``, ``{% for name in expression %} {% endfor %}``,
``{% if e %} {% elif e %} {% else %} {% endif %}``, ``{% generation %} {% endgeneration %}``, ``{# comment #}``.
A ``-`` inside any of these brackets (``{%- -%}``, ``{{- -}}``, ``{#- -#}``) removes the white space of the text on that side.
Expressions: strings, whole numbers, true/false/none, names, ``a.key`` (mapping keys only), ``loop.first``,
``loop.last``, ``loop.index0``, ``+``, ``== !=``, ``in``, ``not and or``, parentheses and the filters
given to `compile_template`. There are no calls, no Python attributes, no imports.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.operators.rows import quoted
from casegrid.operators.storage import stored

Piece = tuple[str, bool]
Scope = dict[str, object]


class TemplateError(ValueError):
    pass


# --- syntax tree ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Key:
    of: object
    key: str


@dataclass(frozen=True)
class Apply:
    """A filter or an operator by its name in the table of functions."""

    function: str
    args: tuple


@dataclass(frozen=True)
class Show:
    value: object


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, body)


@dataclass(frozen=True)
class For:
    name: str
    source: object
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


# --- parsing --------------------------------------------------------------------------------------------

#: Of each kind a trim mark, what is inside, a trim mark. A mark takes away the white space on its side.
_PARTS = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#(-?).*?(-?)#\}", re.S)
_TOKENS = re.compile(r"""\s*(?:('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(\d+)|([A-Za-z_]\w*)|(==|!=|[+.|()]))""")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_NAMED = {"true": True, "false": False, "none": None}


class _Expression:
    def __init__(self, text: str, filters: Mapping[str, Callable]):
        self.filters, self.tokens, at = filters, [], 0
        text = text.strip()
        while at < len(text):
            found = _TOKENS.match(text, at)
            if not found:
                raise TemplateError(f"cannot read {text[at:]!r}")
            self.tokens.append(found)
            at = found.end()
        self.at = 0

    def peek(self) -> str | None:
        token = self.tokens[self.at] if self.at < len(self.tokens) else None
        return token and (token[3] or token[4])

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted:
            self.at += 1
            return self.tokens[self.at - 1][0].strip()
        return None

    def whole(self):
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][0]!r}")
        return tree

    def either(self):
        tree = self.both()
        while self.take("or"):
            tree = Apply("or", (tree, self.both()))
        return tree

    def both(self):
        tree = self.negated()
        while self.take("and"):
            tree = Apply("and", (tree, self.negated()))
        return tree

    def negated(self):
        return Apply("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self):
        tree = self.added()
        while operator := self.take("==", "!=", "in"):
            tree = Apply(operator, (tree, self.added()))
        return tree

    def added(self):
        tree = self.filtered()
        while self.take("+"):
            tree = Apply("+", (tree, self.filtered()))
        return tree

    def filtered(self):
        tree = self.single()
        while True:
            if self.take("."):
                tree = Key(tree, self.word())
            elif self.take("|"):
                name = self.word()
                if name not in self.filters:
                    raise TemplateError(f"no filter {name!r}")
                tree = Apply(name, (tree,))
            else:
                return tree

    def word(self) -> str:
        name = self.peek()
        if not name or not name.isidentifier():
            raise TemplateError("a name is missing")
        self.at += 1
        return name

    def single(self):
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends early")
        if self.take("("):
            tree = self.either()
            if not self.take(")"):
                raise TemplateError("a bracket is missing")
            return tree
        token = self.tokens[self.at]
        self.at += 1
        if token[1]:
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), token[1][1:-1], flags=re.S))
        if token[2]:
            return Const(int(token[2]))
        if token[3]:
            return Const(_NAMED[token[3]]) if token[3] in _NAMED else Name(token[3])
        raise TemplateError(f"unexpected {token[0]!r}")


def parse(template: str, filters: Mapping[str, Callable]) -> tuple:
    """The template's syntax tree."""
    pieces, at, trim = [], 0, False

    def text(end: int, cut: bool) -> tuple[str, str]:
        piece = template[at:end].lstrip() if trim else template[at:end]
        return "text", piece.rstrip() if cut else piece

    for found in _PARTS.finditer(template):
        pieces.append(text(found.start(), bool(found[1] or found[4] or found[7])))
        if found[2] is not None:
            pieces.append(("show", found[2]))
        elif found[5] is not None:
            pieces.append(("tag", found[5].strip()))
        at, trim = found.end(), bool(found[3] or found[6] or found[8])
    pieces = [p for p in [*pieces, text(len(template), False)] if p != ("text", "")]
    place = 0

    def expression(text: str):
        return _Expression(text, filters).whole()

    def body(*ends: str) -> tuple[tuple, str]:
        nonlocal place
        nodes = []
        while place < len(pieces):
            kind, text = pieces[place]
            place += 1
            if kind == "text":
                nodes.append(Show(Const(text)))
            elif kind == "show":
                nodes.append(Show(expression(text)))
            else:
                word, _, rest = text.partition(" ")
                if word in ends:
                    return tuple(nodes), text
                nodes.append(tag(word, rest))
        if ends:
            raise TemplateError(f"no {ends[-1]}")
        return tuple(nodes), ""

    def tag(word: str, rest: str):
        if word == "for":
            name, _, source = rest.strip().partition(" in ")
            if not name.strip().isidentifier():
                raise TemplateError(f"for what? {rest!r}")
            return For(name.strip(), expression(source), body("endfor")[0])
        if word == "generation":
            return Generation(body("endgeneration")[0])
        if word == "if":
            branches, condition = [], expression(rest)
            while True:
                inner, end = body("elif", "else", "endif")
                branches.append((condition, inner))
                word, _, rest = end.partition(" ")
                if word == "endif":
                    return If(tuple(branches))
                condition = Const(True) if word == "else" else expression(rest)
        raise TemplateError(f"unknown tag {word!r}")

    return body()[0]


# --- folding and compiling --------------------------------------------------------------------------------


def _shown(value: object) -> str:
    return "" if value is None else str(value)


_OPERATORS: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "in": lambda a, b: a in b,
    "not": lambda a: not a,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
    "+": lambda a, b: a + b if type(a) is type(b) else _shown(a) + _shown(b),
}


def fold(node, functions: Mapping[str, Callable]):
    """The tree with constant expressions computed, branches decided and neighbouring texts joined."""
    match node:
        case tuple():
            nodes: list = []
            for child in (fold(n, functions) for n in node):
                for item in child if isinstance(child, tuple) else (child,):
                    if isinstance(item, Show) and isinstance(item.value, Const) and nodes and _is_text(nodes[-1]):
                        item = Show(Const(_shown(nodes.pop().value.value) + _shown(item.value.value)))
                    nodes.append(item)
            return tuple(nodes)
        case Apply(function, args):
            args = tuple(fold(a, functions) for a in args)
            if all(isinstance(a, Const) for a in args):
                return Const(functions[function](*(a.value for a in args)))
            return Apply(function, args)
        case Key(of, key):
            return Key(fold(of, functions), key)
        case Show(value):
            return Show(fold(value, functions))
        case For(name, source, body):
            return For(name, fold(source, functions), fold(body, functions))
        case Generation(body):
            return Generation(fold(body, functions))
        case If(branches):
            left = []
            for condition, body in branches:
                condition = fold(condition, functions)
                if isinstance(condition, Const):
                    if condition.value:
                        left.append((condition, fold(body, functions)))
                        break
                    continue
                left.append((condition, fold(body, functions)))
            if not left:
                return ()
            return left[0][1] if isinstance(left[0][0], Const) else If(tuple(left))
        case _:
            return node


def _is_text(node) -> bool:
    return isinstance(node, Show) and isinstance(node.value, Const)


def _value(node, functions: Mapping[str, Callable]) -> Callable[[Scope], object]:
    match node:
        case Const(value):
            return lambda scope: value
        case Name(name):
            return lambda scope: scope.get(name)
        case Key(of, key):
            inner = _value(of, functions)

            def keyed(scope):
                held = inner(scope)
                return held.get(key) if isinstance(held, Mapping) else None

            return keyed
        case Apply(function, (one,)):
            call, only = functions[function], _value(one, functions)
            return lambda scope: call(only(scope))
        case Apply("and", (a, b)):
            left, right = _value(a, functions), _value(b, functions)
            return lambda scope: left(scope) and right(scope)
        case Apply("or", (a, b)):
            left, right = _value(a, functions), _value(b, functions)
            return lambda scope: left(scope) or right(scope)
        case Apply(function, (a, b)):
            call, left, right = functions[function], _value(a, functions), _value(b, functions)
            return lambda scope: call(left(scope), right(scope))
    raise TemplateError(f"no value: {node!r}")


def _body(nodes: tuple, functions: Mapping[str, Callable]) -> Callable[[Scope, bool], Iterator[Piece]]:
    parts = [_node(node, functions) for node in nodes]

    def run(scope: Scope, learn: bool) -> Iterator[Piece]:
        for part in parts:
            yield from part(scope, learn)

    return run


def _node(node, functions: Mapping[str, Callable]) -> Callable[[Scope, bool], Iterator[Piece]]:
    match node:
        case Show(value):
            shown = _value(value, functions)
            return lambda scope, learn: iter(((_shown(shown(scope)), learn),))
        case Generation(body):
            inner = _body(body, functions)
            return lambda scope, learn: inner(scope, True)
        case If(branches):
            choices = [(_value(condition, functions), _body(body, functions)) for condition, body in branches]

            def choose(scope, learn):
                for holds, inner in choices:
                    if holds(scope):
                        return inner(scope, learn)
                return iter(())

            return choose
        case For(name, source, body):
            items, inner = _value(source, functions), _body(body, functions)

            def loop(scope, learn):
                for index, item, last in _with_last(items(scope) or ()):
                    state = {"index0": index, "first": index == 0, "last": last}
                    yield from inner({**scope, name: item, "loop": state}, learn)

            return loop
    raise TemplateError(f"no statement: {node!r}")


def _with_last(items: Iterable) -> Iterator[tuple[int, object, bool]]:
    index, missing = 0, object()
    items = iter(items)
    held = next(items, missing)
    while held is not missing:
        following = next(items, missing)
        yield index, held, following is missing
        index, held = index + 1, following


def compile_template(template: str, filters: Mapping[str, Callable] | None = None) -> Callable[..., Iterator[Piece]]:
    """A function of keyword variables that yields (text, learn) pieces."""
    functions = {**_OPERATORS, **(filters or {})}
    run = _body(fold(parse(template, filters or {}), functions), functions)
    return lambda **variables: (piece for piece in run(dict(variables), False) if piece[0])


# --- conversations ------------------------------------------------------------------------------------------

#: Strings with a meaning for chat models; texts must not be able to forge them (fixed values).
CONTROLS = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]")
TEMPLATE = (
    "{% for m in messages %}<|{{ m.role | escape }}|>\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}</s>\n{% endfor %}"
)
OPEN, TURN, CLOSE = "<|", "|>\n", "</s>\n"
CHUNK_CHARS = 1 << 16


class Escaping:
    """Every first character of a control string, and the backslash, as a backslash and a letter."""

    def __init__(self, controls: tuple[str, ...] = CONTROLS):
        letters = {"<": "l", "|": "p", "[": "b"}
        first = sorted({control[0] for control in controls})
        self.codes = {c: letters.get(c, f"u{ord(c):04x}") for c in first} | {"\\": "\\"}
        self._table = str.maketrans({c: "\\" + code for c, code in self.codes.items()})
        self._back = {code: c for c, code in self.codes.items()}
        self._coded = re.compile(r"\\(" + "|".join(map(re.escape, self._back)) + ")")

    def escape(self, text: object) -> str:
        return _shown(text).translate(self._table)

    def unescape(self, text: str) -> str:
        return self._coded.sub(lambda m: self._back[m[1]], text)


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000, chars: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= size or weight >= chars:
            yield _as_batch(held, schema)
            held, weight = [], 0
    if held:
        yield _as_batch(held, schema)


def _as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), schema)], schema=schema)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_CHUNKS = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("text", pa.string()), ("learn", _SPANS)])
_CHUNK_SQL = "conv_id long, chunk long, text string, learn array<struct<start:long,end:long>>"


def format_conversations(
    turns: DataFrame,
    template: str = TEMPLATE,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """(conv_id, chunk, text, learn): every conversation's formatted text in chunks, in order.

    ``learn`` are spans [start, end) of characters within the chunk on which a model is to be trained. The
    turns of a conversation are taken by ``turn_col``, NULL first, ties by role and text; repeated rows are
    repeated turns. NULL roles and texts are empty; rows with a NULL conversation id form one conversation.
    Turns stream through the task of their conversation: nothing but the chunk at hand is held.
    """
    columns = ((conv_col, "long", "c"), (turn_col, "long", "n"), (role_col, "string", "r"), (text_col, "string", "x"))
    rows = turns.select(*[F.coalesce(F.col(quoted(c)).cast(kind), F.lit("")).alias(name) if kind == "string" else F.col(quoted(c)).cast(kind).alias(name) for c, kind, name in columns])
    rows = rows.repartition("c").sortWithinPartitions("c", "n", "r", "x").select("c", "r", "x")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        render = compile_template(template, {"escape": Escaping().escape})
        for conv, group in groupby(_streamed(batches), key=lambda row: row[0]):
            nth, held, size, spans = 0, [], 0, []
            for text, learn in render(messages=({"role": role, "text": text} for _, role, text in group)):
                if size and size + len(text) > chunk_chars:
                    yield conv, nth, "".join(held), spans
                    nth, held, size, spans = nth + 1, [], 0, []
                if learn:
                    spans.append({"start": size, "end": size + len(text)})
                held.append(text)
                size += len(text)
            for _ in group:  # a template need not look at all messages
                pass
            yield conv, nth, "".join(held), spans

    return rows.mapInArrow(lambda batches: _batched(chunks(batches), _CHUNKS), _CHUNK_SQL)


_READ = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)
_READ_SQL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def parsed_turns(chunks: Iterable[str], escaping: Escaping) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a text that TEMPLATE has made; one turn is held at a time."""
    held = ""
    for chunk in chunks:
        held += chunk
        *done, held = held.split(CLOSE)
        for turn in done:
            if not turn.startswith(OPEN):
                raise ValueError("no turn starts here")
            role, mark, text = turn[len(OPEN) :].partition(TURN)
            if not mark:
                raise ValueError("a turn without role")
            yield escaping.unescape(role), escaping.unescape(text)
    if held:
        raise ValueError("a turn does not end")


def read_conversations(formatted: DataFrame) -> DataFrame:
    """What stored `format_conversations` rows (by TEMPLATE) say: per conversation the number of turns, digests of
    all turns and of the text under the training spans, unescaped, and the formatted length in characters."""
    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").select("conv_id", "text", "learn")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        escaping = Escaping()
        for conv, group in groupby(_streamed(batches), key=lambda row: row[0]):
            turns, loss, sizes = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]

            def texts():
                for _, text, spans in group:
                    sizes[2] += len(text)
                    for span in spans:
                        learned = escaping.unescape(text[span["start"] : span["end"]])
                        sizes[1] += len(learned)
                        loss.update(learned.encode())
                    yield text

            for role, text in parsed_turns(texts(), escaping):
                sizes[0] += 1
                turns.update(f"{role}\n{text}\n".encode())
            yield conv, sizes[0], turns.hexdigest(), sizes[1], loss.hexdigest(), sizes[2]

    return rows.mapInArrow(lambda batches: _batched(read(batches), _READ), _READ_SQL)


def formatted_and_read(turns: DataFrame) -> DataFrame:
    """`format_conversations` written to the shared folder, and read back."""
    return read_conversations(stored(format_conversations(turns)))
