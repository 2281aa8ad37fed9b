"""Chat formatting: a compiler for a sandboxed template language.

A template is parsed into a syntax tree, constant parts are folded, and the
tree becomes nested Python closures; rendering a conversation calls them.
Nothing of the template is ever evaluated as Python: names are looked up in
the message, the loop state and the caller's variables only, and filters come
from a fixed table.

    {% for message in messages %} ... {% endfor %}
    {% if EXPR %} ... {% elif EXPR %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}     text under the loss mask
    {{ EXPR }}   {# comment #}   {%- and -%} trim white space
    EXPR: names, message.role or message['role'], 'text', numbers, true,
    false, none; + (joins text), ==, !=, and, or, not, (), | filter

Filters: ``escape`` makes text safe to stand among control strings (see
``escaped``; ``unescaped`` takes it back), ``line`` also for one line,
``trim``, ``upper``, ``lower``.

In Spark, a conversation's rows are gathered by its id (a conversation is
one document: it is rendered whole, and its mask refers to the whole text),
and rendered in Arrow batches; nothing else is shuffled.

Cases: null text and null role are empty; rows of equal turn are ordered by
role, then text; null turns come first; rows with a null id form one
conversation with a null id; repeated rows are turns like others; an empty
table gives none.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# turns between control strings; assistant texts bear loss
CHATML = ("{% for message in messages %}<|im_start|>{{ message.role | line }}\n"
          "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
          "{% else %}{{ message.text | escape }}{% endif %}<|im_end|>\n{% endfor %}")


def escaped(text: str) -> str:
    """No ``<|`` left: every < followed by backslashes and | gets one
    backslash more."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def one_line(text: str) -> str:
    return escaped(text.replace("\\", "\\\\").replace("\n", "\\n"))


def from_line(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(text))


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escaped, "line": one_line, "trim": str.strip, "upper": str.upper, "lower": str.lower}


class TemplateError(ValueError):
    """The template is not well formed or names something unknown."""


# syntax tree -----------------------------------------------------------------

@dataclass
class Const:
    value: object


@dataclass
class Name:
    path: tuple[str, ...]


@dataclass
class Call:
    op: str
    args: list


@dataclass
class Emit:
    value: object


@dataclass
class Block:
    body: list = field(default_factory=list)


@dataclass
class Loop:
    name: str
    source: object
    body: Block


@dataclass
class Choice:
    cases: list  # (condition, Block); the else branch has Const(True)


@dataclass
class Generation:
    body: Block


# parser ----------------------------------------------------------------------

_PIECE = re.compile(r"(\{%-?.*?-?%\}|\{\{-?.*?-?\}\}|\{#.*?#\})", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[()\[\].|+,]))")


class _Expression:
    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:at + 20]!r}")
            kind = "text" if m[1] else "number" if m[2] else "name" if m[3] else "sign"
            self.tokens.append((kind, m[m.lastindex]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "text" else None

    def take(self, value: str | None = None) -> tuple[str, str]:
        if self.at >= len(self.tokens) or value is not None and self.peek() != value:
            raise TemplateError(f"expected {value or 'more'}")
        self.at += 1
        return self.tokens[self.at - 1]

    def whole(self):
        node = self.either()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def _chain(self, signs: tuple[str, ...], below: Callable):
        node = below()
        while self.peek() in signs:
            node = Call(self.take()[1], [node, below()])
        return node

    def either(self):
        return self._chain(("or",), self.both)

    def both(self):
        return self._chain(("and",), self.negated)

    def negated(self):
        if self.peek() == "not":
            self.take()
            return Call("not", [self.negated()])
        return self._chain(("==", "!="), self.joined)

    def joined(self):
        return self._chain(("+",), self.filtered)

    def filtered(self):
        node = self.atom()
        while self.peek() == "|":
            self.take()
            name = self.take()[1]
            if name not in FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            node = Call("|" + name, [node])
        return node

    def atom(self):
        kind, value = self.take()
        if kind == "text":
            return Const(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), value[1:-1]))
        if kind == "number":
            return Const(int(value))
        if value == "(":
            node = self.either()
            self.take(")")
            return node
        if kind != "name" or value in ("and", "or", "not"):
            raise TemplateError(f"unexpected {value!r}")
        if value in ("true", "false", "none"):
            return Const({"true": True, "false": False, "none": None}[value])
        path = [value]
        while self.peek() in (".", "["):
            if self.take()[1] == ".":
                path.append(self.take()[1])
            else:
                kind, key = self.take()
                if kind != "text":
                    raise TemplateError("only text may stand in []")
                path.append(key[1:-1])
                self.take("]")
        if any(p.startswith("_") for p in path):
            raise TemplateError("names do not start with _")
        return Name(tuple(path))


def parse(source: str) -> Block:
    """Syntax tree of a template."""
    root = Block()
    stack: list[tuple[str, object, Block]] = [("", None, root)]
    trim = False
    for piece in _PIECE.split(source):
        body = stack[-1][2].body
        if not piece.startswith(("{%", "{{", "{#")):
            text = piece.lstrip() if trim else piece
            trim = False if piece else trim
            if text:
                body.append(Emit(Const(text)))
            continue
        if piece.startswith("{#"):
            continue
        if piece[2] == "-" and body and isinstance(body[-1], Emit) and isinstance(body[-1].value, Const):
            body[-1] = Emit(Const(str(body[-1].value.value).rstrip()))
        trim = piece[-3] == "-"
        inner = piece[2:-2].strip("-").strip()
        if piece.startswith("{{"):
            body.append(Emit(_Expression(inner).whole()))
            continue
        word, _, rest = inner.partition(" ")
        if word == "for":
            m = re.fullmatch(r"([A-Za-z]\w*)\s+in\s+(.+)", rest.strip())
            if not m:
                raise TemplateError(f"cannot read {inner!r}")
            node = Loop(m[1], _Expression(m[2]).whole(), Block())
            body.append(node)
            stack.append(("for", node, node.body))
        elif word == "if":
            node = Choice([(_Expression(rest).whole(), Block())])
            body.append(node)
            stack.append(("if", node, node.cases[0][1]))
        elif word in ("elif", "else") and stack[-1][0] == "if":
            node = stack.pop()[1]
            node.cases.append((Const(True) if word == "else" else _Expression(rest).whole(), Block()))
            stack.append(("if", node, node.cases[-1][1]))
        elif word == "generation":
            node = Generation(Block())
            body.append(node)
            stack.append(("generation", node, node.body))
        elif word.startswith("end") and stack[-1][0] == word[3:] and len(stack) > 1:
            stack.pop()
        else:
            raise TemplateError(f"unexpected {inner!r}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is not closed")
    return root


# constant folding ------------------------------------------------------------

def _apply(op: str, a: list):
    if op == "+":
        return _text(a[0]) + _text(a[1])
    if op in ("==", "!="):
        return (a[0] == a[1]) is (op == "==")
    if op in ("and", "or"):
        return a[1] if bool(a[0]) is (op == "and") else a[0]
    if op == "not":
        return not a[0]
    return FILTERS[op[1:]](_text(a[0]))


def _text(value) -> str:
    return "" if value is None else "true" if value is True else "false" if value is False else str(value)


def fold(node):
    """The tree with constant expressions evaluated, decided branches taken
    and neighbouring constant text joined."""
    if isinstance(node, Call):
        args = [fold(a) for a in node.args]
        return Const(_apply(node.op, [a.value for a in args])) if all(isinstance(a, Const) for a in args) else Call(node.op, args)
    if isinstance(node, Emit):
        value = fold(node.value)
        return Emit(Const(_text(value.value))) if isinstance(value, Const) else Emit(value)
    if isinstance(node, Loop):
        return Loop(node.name, fold(node.source), fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, Choice):
        cases = []
        for condition, body in node.cases:
            condition = fold(condition)
            if isinstance(condition, Const) and not condition.value:
                continue
            cases.append((condition, fold(body)))
            if isinstance(condition, Const):
                break
        return cases[0][1] if cases and isinstance(cases[0][0], Const) else Choice(cases)
    if isinstance(node, Block):
        out: list = []
        for child in map(fold, node.body):
            for item in child.body if isinstance(child, Block) else [child]:
                if isinstance(item, Emit) and isinstance(item.value, Const):
                    if not item.value.value:
                        continue
                    if out and isinstance(out[-1], Emit) and isinstance(out[-1].value, Const):
                        out[-1] = Emit(Const(out[-1].value.value + item.value.value))
                        continue
                out.append(item)
        return Block(out)
    return node


# closures --------------------------------------------------------------------

def _value(node) -> Callable[[dict], object]:
    if isinstance(node, Const):
        return lambda scope, v=node.value: v
    if isinstance(node, Name):
        head, rest = node.path[0], node.path[1:]

        def look(scope: dict):
            if head not in scope:
                raise TemplateError(f"unknown name {head!r}")
            v = scope[head]
            for key in rest:
                v = v.get(key) if isinstance(v, dict) else None
            return v

        return look
    args, op = [_value(a) for a in node.args], node.op
    if op in ("and", "or"):
        first, second = args
        return lambda scope: second(scope) if bool(v := first(scope)) is (op == "and") else v
    if op.startswith("|"):
        one, run = args[0], FILTERS[op[1:]]
        return lambda scope: run(_text(one(scope)))
    return lambda scope: _apply(op, [a(scope) for a in args])


def _writer(node) -> Callable[[dict, list, list], None]:
    """Closure that appends to ``out`` and notes marked ranges in ``marks``
    (as numbers of pieces)."""
    if isinstance(node, Emit):
        if isinstance(node.value, Const):
            text = node.value.value
            return lambda scope, out, marks: out.append(text)
        value = _value(node.value)
        return lambda scope, out, marks: out.append(_text(value(scope)))
    if isinstance(node, Block):
        steps = [_writer(x) for x in node.body]

        def run(scope, out, marks):
            for step in steps:
                step(scope, out, marks)

        return run
    if isinstance(node, Generation):
        body = _writer(node.body)

        def mark(scope, out, marks):
            begin = len(out)
            body(scope, out, marks)
            marks.append((begin, len(out)))

        return mark
    if isinstance(node, Choice):
        cases = [(_value(c), _writer(b)) for c, b in node.cases]

        def choose(scope, out, marks):
            for condition, body in cases:
                if condition(scope):
                    return body(scope, out, marks)

        return choose
    name, source, body = node.name, _value(node.source), _writer(node.body)

    def loop(scope, out, marks):
        items = list(source(scope) or ())
        inner = dict(scope)
        for i, item in enumerate(items):
            inner[name] = item
            inner["loop"] = {"index": i + 1, "first": i == 0, "last": i == len(items) - 1}
            body(inner, out, marks)

    return loop


def compile_template(source: str) -> Callable[..., tuple[str, list[tuple[int, int]]]]:
    """render(messages, **variables) -> (text, marked ranges in characters)."""
    write = _writer(fold(parse(source)))

    def render(messages: list[dict], **variables) -> tuple[str, list[tuple[int, int]]]:
        out: list[str] = []
        marks: list[tuple[int, int]] = []
        write({**variables, "messages": messages}, out, marks)
        ends = [0]
        for piece in out:
            ends.append(ends[-1] + len(piece))
        return "".join(out), [(ends[a], ends[b]) for a, b in marks]

    return render


_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a text made with ``CHATML``."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError("not a formatted conversation")
        turns.append((from_line(m[1]), unescaped(m[2])))
        at = m.end()
    return turns


def conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """One row per conversation: its id and ``messages`` in order."""
    message = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.groupBy(id_col).agg(F.sort_array(F.collect_list(message)).alias("messages"))


def format_conversations(rows: DataFrame, template: str = CHATML, id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", **variables) -> DataFrame:
    """Per conversation: its id, ``formatted`` and ``loss_spans`` (array of
    from, to: characters of ``formatted`` under the loss mask)."""
    parse(template)  # errors rise here, not in tasks
    grouped = conversations(rows, id_col, turn_col, role_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        for batch in batches:
            made = [render(m or [], **variables) for m in batch.column("messages").to_pylist()]
            yield pa.record_batch({
                id_col: batch.column(id_col), "formatted": pa.array([t for t, _ in made], pa.string()),
                "loss_spans": pa.array([[{"from": a, "to": b} for a, b in marks] for _, marks in made],
                                       pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())])))})

    kind = rows.schema[id_col].dataType.simpleString()
    return grouped.mapInArrow(run, f"`{id_col}` {kind}, formatted string, loss_spans array<struct<from:long,to:long>>")


def digests(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """What the formatted text says, read back from it: n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist()):
                turns = read_back(text)
                loss = "".join(unescaped(text[s["from"]:s["to"]]) for s in spans)
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                out.append((len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                            hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            cols = list(zip(*out)) or [[]] * 5
            yield pa.record_batch({
                id_col: batch.column(id_col), "n_turns": pa.array(cols[0], pa.int64()),
                "turns_sha256": pa.array(cols[1], pa.string()), "loss_chars": pa.array(cols[2], pa.int64()),
                "loss_sha256": pa.array(cols[3], pa.string()), "formatted_chars": pa.array(cols[4], pa.int64())})

    kind = formatted.schema[id_col].dataType.simpleString()
    return formatted.mapInArrow(run, f"`{id_col}` {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                     "loss_sha256 string, formatted_chars long")
