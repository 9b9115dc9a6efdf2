"""Chat formatting: a small sandboxed template language, compiled to Python closures.

A template is parsed into a syntax tree, constants are folded, and each node becomes a closure over the rest. There is
no attribute lookup on Python objects, no call and no import: names are the conversation's fields and loop variables,
fields are looked up in dicts only, and filters are those of FILTERS.

    text {{ expression }} {% for m in messages %}..{% endfor %} {% if e %}..{% elif e %}..{% else %}..{% endif %}
    {% generation %}..{% endgeneration %}     marks what the model is to learn
    expression: or, and, not, ==, !=, +, m.field, 'text', 12, true, false, loop.first, loop.last, loop.index, x|filter

A control string inside a text is broken by a backslash after its first sign; where backslashes stand there already,
one more is added. `unescape` takes one away again, so every text comes back exactly.

Edge cases: a null text or role is an empty one. Turns are ordered by turn (nulls first), then role, then text, so ties
and repeated rows have one order. A null conv_id is a conversation of its own. A conversation is one row, as long as it
is. Other columns are ignored; an empty table gives an empty result.
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

#: The control strings of TEMPLATE: fixed values of its format.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
TEMPLATE = (
    "{% for m in messages %}<s>{{ m.role|name }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text|escape }}{% endgeneration %}"
    "{% elif m.role == 'user' %}[INST] {{ m.text|escape }} [/INST]"
    "{% else %}{{ m.text|escape }}{% endif %}</s>\n{% endfor %}"
)
_BREAK = re.compile(r"([<\[]\\*)(?=/?s>|/?INST\])")
_JOIN = re.compile(r"([<\[]\\*)\\(?=/?s>|/?INST\])")


def escape(text: str) -> str:
    return _BREAK.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _JOIN.sub(r"\1", text)


def escape_name(text: str) -> str:
    """A text on one line, free of control strings."""
    return escape(text.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_name(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


FILTERS: dict[str, Callable[[Any], Any]] = {"escape": escape, "name": escape_name, "trim": lambda s: str(s).strip(), "upper": lambda s: str(s).upper(), "lower": lambda s: str(s).lower(), "length": len}


class TemplateError(ValueError):
    """The template isn't of the language."""


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Constant:
    value: Any


@dataclass(frozen=True)
class Name:
    path: tuple[str, ...]


@dataclass(frozen=True)
class Apply:
    """An operator or a filter of some expressions."""

    op: str
    parts: tuple


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class Branch:
    cases: tuple  # of (condition, body)


@dataclass(frozen=True)
class Loop:
    name: str
    items: Any
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


_TAG = re.compile(r"\{%\s*(.*?)\s*%\}|\{\{\s*(.*?)\s*\}\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*')|(\d+)|([A-Za-z_]\w*)|(==|!=|[+|.()]))")


def _tokens(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    while at < len(source.rstrip()):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"unexpected {source[at:]!r}")
        out.append((("text", "number", "name", "sign")[m.lastindex - 1], m[m.lastindex]))
        at = m.end()
    return out


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str) -> None:
        self.tokens = _tokens(source)

    def take(self, *values: str) -> str | None:
        if self.tokens and self.tokens[0][0] in ("name", "sign") and self.tokens[0][1] in values:
            return self.tokens.pop(0)[1]
        return None

    def whole(self) -> Any:
        out = self.either()
        if self.tokens:
            raise TemplateError(f"unexpected {self.tokens[0][1]!r}")
        return out

    def either(self) -> Any:
        out = self.both()
        while self.take("or"):
            out = Apply("or", (out, self.both()))
        return out

    def both(self) -> Any:
        out = self.negated()
        while self.take("and"):
            out = Apply("and", (out, self.negated()))
        return out

    def negated(self) -> Any:
        return Apply("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self) -> Any:
        out = self.summed()
        while op := self.take("==", "!="):
            out = Apply(op, (out, self.summed()))
        return out

    def summed(self) -> Any:
        out = self.filtered()
        while self.take("+"):
            out = Apply("+", (out, self.filtered()))
        return out

    def filtered(self) -> Any:
        out = self.single()
        while self.take("|"):
            kind, name = self.tokens.pop(0) if self.tokens else ("", "")
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            out = Apply("|" + name, (out,))
        return out

    def single(self) -> Any:
        if not self.tokens:
            raise TemplateError("an expression ends early")
        kind, value = self.tokens.pop(0)
        if kind == "text":
            return Constant(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), value[1:-1]))
        if kind == "number":
            return Constant(int(value))
        if value == "(":
            out = self.either()
            if not self.take(")"):
                raise TemplateError("no closing bracket")
            return out
        if kind != "name":
            raise TemplateError(f"unexpected {value!r}")
        if value in ("true", "false"):
            return Constant(value == "true")
        path = [value]
        while self.take("."):
            kind, value = self.tokens.pop(0) if self.tokens else ("", "")
            if kind != "name" or value.startswith("_"):
                raise TemplateError(f"no field {value!r}")
            path.append(value)
        return Name(tuple(path))


def parse(template: str) -> tuple:
    pieces: list[tuple[str, str]] = []
    at = 0
    for m in _TAG.finditer(template):
        pieces += [("text", template[at : m.start()]), ("tag", m[1]) if m[1] is not None else ("out", m[2])]
        at = m.end()
    pieces = [p for p in [*pieces, ("text", template[at:])] if p != ("text", "")]

    def body(ends: tuple[str, ...]) -> tuple[tuple, str]:
        out: list[Any] = []
        while pieces:
            kind, value = pieces.pop(0)
            if kind == "text":
                out.append(Text(value))
            elif kind == "out":
                out.append(Output(_Expression(value).whole()))
            elif value.split(None, 1)[0] in ends:
                return tuple(out), value
            elif value == "generation":
                out.append(Generation(body(("endgeneration",))[0]))
            elif m := re.fullmatch(r"for\s+(\w+)\s+in\s+(.+)", value):
                out.append(Loop(m[1], _Expression(m[2]).whole(), body(("endfor",))[0]))
            elif value.startswith("if "):
                cases, condition = [], _Expression(value[3:]).whole()
                while True:
                    inner, end = body(("elif", "else", "endif"))
                    cases.append((condition, inner))
                    if end == "endif":
                        break
                    condition = Constant(True) if end == "else" else _Expression(end[5:]).whole()
                out.append(Branch(tuple(cases)))
            else:
                raise TemplateError(f"unexpected tag {value!r}")
        if ends:
            raise TemplateError(f"no {ends[-1]}")
        return tuple(out), ""

    return body(())[0]


def _operate(op: str, values: list[Any]) -> Any:
    if op == "==":
        return values[0] == values[1]
    if op == "!=":
        return values[0] != values[1]
    if op == "+":
        return values[0] + values[1] if all(isinstance(v, int) for v in values) else str(values[0]) + str(values[1])
    if op == "not":
        return not values[0]
    if op in ("and", "or"):
        return (values[0] and values[1]) if op == "and" else (values[0] or values[1])
    return FILTERS[op[1:]](values[0])


def fold(node: Any) -> Any:
    """A node with its constant parts worked out: expressions, branches and neighbouring texts."""
    if isinstance(node, tuple):
        out: list[Any] = []
        for n in map(fold, node):
            for x in n if isinstance(n, tuple) else (n,):
                if isinstance(x, Text) and out and isinstance(out[-1], Text):
                    out[-1] = Text(out[-1].value + x.value)
                elif x != Text(""):
                    out.append(x)
        return tuple(out)
    if isinstance(node, Apply):
        parts = tuple(map(fold, node.parts))
        if all(isinstance(p, Constant) for p in parts):
            return Constant(_operate(node.op, [p.value for p in parts]))
        return Apply(node.op, parts)
    if isinstance(node, Output):
        value = fold(node.value)
        return Text(_shown(value.value)) if isinstance(value, Constant) else Output(value)
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, Loop):
        return Loop(node.name, fold(node.items), fold(node.body))
    if isinstance(node, Branch):
        cases = []
        for condition, inner in ((fold(c), fold(b)) for c, b in node.cases):
            if isinstance(condition, Constant) and not condition.value:
                continue
            cases.append((condition, inner))
            if isinstance(condition, Constant):
                break
        if not cases:
            return ()
        return cases[0][1] if isinstance(cases[0][0], Constant) else Branch(tuple(cases))
    return node


def _shown(value: Any) -> str:
    return "" if value is None else ("true" if value else "false") if isinstance(value, bool) else str(value)


class _Out:
    """The text so far, its length, and the spans under generation."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.at, self.spans = 0, []

    def add(self, text: str) -> None:
        self.parts.append(text)
        self.at += len(text)


def _value(node: Any) -> Callable[[dict], Any]:
    if isinstance(node, Constant):
        return lambda scope, v=node.value: v
    if isinstance(node, Name):

        def look(scope: dict, path: tuple[str, ...] = node.path) -> Any:
            for p in path:
                scope = scope.get(p) if isinstance(scope, dict) else None
            return scope

        return look
    parts = [_value(p) for p in node.parts]
    if node.op == "and":
        return lambda scope, a=parts[0], b=parts[1]: a(scope) and b(scope)
    if node.op == "or":
        return lambda scope, a=parts[0], b=parts[1]: a(scope) or b(scope)
    if node.op[0] == "|":
        return lambda scope, f=FILTERS[node.op[1:]], a=parts[0]: f(a(scope))
    if node.op == "==":
        return lambda scope, a=parts[0], b=parts[1]: a(scope) == b(scope)
    return lambda scope, op=node.op: _operate(op, [p(scope) for p in parts])


def _closure(node: Any) -> Callable[[dict, _Out], None]:
    if isinstance(node, tuple):
        steps = [_closure(n) for n in node]

        def run(scope: dict, out: _Out) -> None:
            for step in steps:
                step(scope, out)

        return run
    if isinstance(node, Text):
        return lambda scope, out, v=node.value: out.add(v)
    if isinstance(node, Output):
        return lambda scope, out, v=_value(node.value): out.add(_shown(v(scope)))
    if isinstance(node, Generation):

        def mark(scope: dict, out: _Out, body: Callable = _closure(node.body)) -> None:
            start = out.at
            body(scope, out)
            out.spans.append((start, out.at))

        return mark
    if isinstance(node, Loop):

        def loop(scope: dict, out: _Out, name: str = node.name, items: Callable = _value(node.items), body: Callable = _closure(node.body)) -> None:
            rows = list(items(scope) or ())
            for i, row in enumerate(rows):
                body(scope | {name: row, "loop": {"first": i == 0, "last": i == len(rows) - 1, "index": i + 1}}, out)

        return loop
    cases = [(_value(c), _closure(b)) for c, b in node.cases]

    def branch(scope: dict, out: _Out) -> None:
        for condition, body in cases:
            if condition(scope):
                return body(scope, out)
        return None

    return branch


def compiled(template: str) -> Callable[[list[dict]], tuple[str, list[tuple[int, int]]]]:
    """A function from messages to the formatted text and the spans (of code points) under generation."""
    run = _closure(fold(parse(template)))

    def render(messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        out = _Out()
        run({"messages": messages}, out)
        return "".join(out.parts), out.spans

    return render


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a text that TEMPLATE made."""
    turns = []
    for turn in formatted.split("</s>\n")[:-1]:
        name, _, text = turn.removeprefix("<s>").partition("\n")
        role = unescape_name(name)
        turns.append((role, unescape(text[len("[INST] ") : -len(" [/INST]")] if role == "user" else text)))
    return turns


def conversations_of(rows: DataFrame) -> DataFrame:
    """conv_id and messages (array of turn, role, text, in order) of each conversation."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("messages"))


def _render(template: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compiled(template)
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                texts, spans = zip(*map(render, piece.column("messages").to_pylist()), strict=True)
                spans = pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], spans_type)
                yield pa.RecordBatch.from_arrays([piece.column("conv_id"), pa.array(texts, pa.string()), spans], ["conv_id", "formatted", "generation"])

    return run


def format_conversations(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, formatted (the text) and generation (spans of code points) of each conversation in `rows`."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    return conversations_of(rows).mapInArrow(_render(template), f"conv_id {kind}, formatted string, generation array<struct<start:bigint,end:bigint>>")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("generation").to_pylist(), strict=True):
            turns = read_back(text)
            loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
            out.append((len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
        columns = zip(*out, strict=True) if out else ((),) * 5
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["conv_id", *DIGESTS])


DIGESTS = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """What is read back from `formatted`: the turns, and the text under the loss mask."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.mapInArrow(_digest, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
