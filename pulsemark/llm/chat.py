"""Chat formatting with a compiled template language.

A template is parsed into a syntax tree, constant parts are folded, and the tree becomes nested Python
closures that yield the output piece by piece, with a flag for pieces inside generation markers. Messages
are read one at a time, so that a conversation of any length takes bounded memory.

The language has text, ``{{ expression }}``, ``{% for x in messages %}``, ``{% if %} / {% elif %} / {% else %}``,
``{% set x = ... %}`` and ``{% generation %}``. Expressions have strings, integers, true, false, none, names,
attributes of messages, ``+ == != < <= > >= in and or not`` and the filters trim, upper, lower, length and escape.
Nothing else can be reached: there are no calls, no Python attributes and no imports.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Strings that steer the format. A backslash after the first character keeps one in a text from doing so.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</ROLE>>")
TEMPLATE = (
    "{% for m in messages %}"
    "{% if m.role == 'user' %}{{ '<s>' + '[INST] ' + (m.text | escape) + ' [/INST]' }}"
    "{% elif m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{{ '</s>' }}"
    "{% elif m.role == 'system' %}{{ '<<SYS>>' + (m.text | escape) + '<</SYS>>' }}"
    "{% else %}{{ '<<ROLE>>' + (m.role | escape) + '<</ROLE>>' + (m.text | escape) + '</s>' }}{% endif %}"
    "{% endfor %}"
)
_ESCAPE = regex.compile(r"\\|" + "|".join(rf"{regex.escape(c[0])}(?={regex.escape(c[1:])})" for c in CONTROLS))
_UNESCAPE = regex.compile(r"\\(\\?)")


def escape(text: str) -> str:
    """Double every backslash and put one after the first character of every control string."""
    return _ESCAPE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[1], text)


class TemplateError(ValueError):
    """A template that is not in the language."""


@dataclass(frozen=True)
class Node:
    """A node of the syntax tree: its kind, a value or name, and its children."""

    kind: str
    value: object = None
    children: tuple = ()


_PARTS = regex.compile(r"\{\{(.*?)\}\}|\{%-?(.*?)-?%\}", regex.S)
_TOKENS = regex.compile(r"""\s*(?:('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(\d+)|([A-Za-z_]\w*)|(==|!=|<=|>=|[<>+|().=]))""")
_FILTERS: dict[str, Callable] = {
    "trim": lambda x: str(x).strip(), "upper": lambda x: str(x).upper(), "lower": lambda x: str(x).lower(),
    "length": len, "escape": lambda x: escape(str(x)),
}
_COMPARE: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b,
}
_WORDS = {"true": True, "false": False, "none": None}


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.strip()
        while at < len(source):
            m = _TOKENS.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:at + 10]!r}")
            self.tokens.append(next((k, x) for k, x in zip(("text", "number", "name", "sign"), m.groups()) if x is not None))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "text" else None

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted:
            self.at += 1
            return wanted[wanted.index(self.tokens[self.at - 1][1])]
        return None

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("a name is missing")

    def end(self):
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")

    def parse(self) -> Node:
        left = self.both()
        while self.take("or"):
            left = Node("or", None, (left, self.both()))
        return left

    def both(self) -> Node:
        left = self.negated()
        while self.take("and"):
            left = Node("and", None, (left, self.negated()))
        return left

    def negated(self) -> Node:
        return Node("not", None, (self.negated(),)) if self.take("not") else self.compared()

    def compared(self) -> Node:
        left = self.added()
        while sign := self.take(*_COMPARE):
            left = Node("compare", sign, (left, self.added()))
        return left

    def added(self) -> Node:
        left = self.filtered()
        while self.take("+"):
            left = Node("add", None, (left, self.filtered()))
        return left

    def filtered(self) -> Node:
        left = self.single()
        while self.take("|"):
            name = self.name()
            if name not in _FILTERS:
                raise TemplateError(f"no filter {name!r}")
            left = Node("filter", name, (left,))
        return left

    def single(self) -> Node:
        if self.take("("):
            inner = self.parse()
            if not self.take(")"):
                raise TemplateError("a closing bracket is missing")
            return inner
        if self.at >= len(self.tokens):
            raise TemplateError("an expression is missing")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            return Node("constant", regex.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), value[1:-1]))
        if kind == "number":
            return Node("constant", int(value))
        if kind != "name" or value in ("and", "or", "not", "in"):
            raise TemplateError(f"unexpected {value!r}")
        if value in _WORDS:
            return Node("constant", _WORDS[value])
        node = Node("name", value)
        while self.take("."):
            node = Node("field", self.name(), (node,))
        return node


def parse(template: str) -> Node:
    """The syntax tree of a template."""
    parts, last = [], 0
    for m in _PARTS.finditer(template):
        if m.start() > last:
            parts.append(("text", template[last:m.start()]))
        parts.append(("print", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        last = m.end()
    if last < len(template):
        parts.append(("text", template[last:]))
    body, at, stop = _block(parts, 0, ())
    if stop:
        raise TemplateError(f"unexpected {stop}")
    return body


def _value(source: str) -> Node:
    expression = _Expression(source)
    node = expression.parse()
    expression.end()
    return node


def _block(parts, at: int, ends: tuple) -> tuple[Node, int, str]:
    """Nodes up to a tag that starts with one of ``ends``, and where that was."""
    found = []
    while at < len(parts):
        kind, source = parts[at]
        at += 1
        if kind == "text":
            found.append(Node("constant", source))
        elif kind == "print":
            found.append(_value(source))
        else:
            word, _, rest = source.partition(" ")
            if word in ends:
                return Node("block", None, tuple(found)), at, source
            if word == "for":
                expression = _Expression(rest)
                name = expression.name()
                if not expression.take("in") or expression.name() != "messages":
                    raise TemplateError("for runs over messages")
                expression.end()
                body, at, stop = _block(parts, at, ("endfor",))
                found.append(Node("for", name, (body,)))
            elif word == "if":
                node, at, stop = _branches(parts, at, rest)
                found.append(node)
            elif word == "generation":
                body, at, stop = _block(parts, at, ("endgeneration",))
                found.append(Node("generation", None, (body,)))
            elif word == "set":
                name, _, value = rest.partition("=")
                stop = "set"
                found.append(Node("set", name.strip(), (_value(value),)))
            else:
                raise TemplateError(f"no tag {word!r}")
            if not stop:
                raise TemplateError(f"{word} is not closed")
    return Node("block", None, tuple(found)), at, ""


def _branches(parts, at, condition) -> tuple[Node, int, str]:
    body, at, stop = _block(parts, at, ("elif", "else", "endif"))
    if stop.startswith("elif"):
        other, at, stop = _branches(parts, at, stop[4:])
    elif stop == "else":
        other, at, stop = _block(parts, at, ("endif",))
    else:
        other = Node("block")
    return Node("if", None, (_value(condition), body, other)), at, stop


_PURE = {"add", "compare", "not", "and", "or", "filter"}


def fold(node: Node) -> Node:
    """The tree with constant expressions computed, constant branches chosen and adjacent text joined."""
    children = tuple(fold(c) for c in node.children)
    node = Node(node.kind, node.value, children)
    if node.kind in _PURE and all(c.kind == "constant" for c in children):
        return Node("constant", _evaluator(node)({}))
    if node.kind == "if" and children[0].kind == "constant":
        return children[1] if children[0].value else children[2]
    if node.kind == "block":
        flat: list[Node] = []
        for child in children:
            for one in child.children if child.kind == "block" else (child,):
                if one.kind == "constant" and flat and flat[-1].kind == "constant":
                    flat[-1] = Node("constant", _shown(flat[-1].value) + _shown(one.value))
                else:
                    flat.append(one)
        return Node("block", None, tuple(flat))
    return node


def _shown(value) -> str:
    return "" if value is None else str(value)


def _evaluator(node: Node) -> Callable[[dict], object]:
    inner = [_evaluator(c) for c in node.children]
    kind, value = node.kind, node.value
    if kind == "constant":
        return lambda scope: value
    if kind == "name":
        return lambda scope: scope.get(value)
    if kind == "field":
        def field(scope):
            owner = inner[0](scope)
            return owner.get(value) if isinstance(owner, dict) else None
        return field
    if kind == "add":
        def add(scope):
            a, b = inner[0](scope), inner[1](scope)
            return a + b if isinstance(a, int) and isinstance(b, int) else _shown(a) + _shown(b)
        return add
    if kind == "compare":
        return lambda scope, f=_COMPARE[value]: f(inner[0](scope), inner[1](scope))
    if kind == "filter":
        return lambda scope, f=_FILTERS[value]: f(inner[0](scope))
    if kind == "not":
        return lambda scope: not inner[0](scope)
    if kind == "and":
        return lambda scope: inner[0](scope) and inner[1](scope)
    return lambda scope: inner[0](scope) or inner[1](scope)


Piece = tuple[str, bool]


def _writer(node: Node, marked: bool) -> Callable[[dict, Iterator[dict]], Iterator[Piece]]:
    kind = node.kind
    if kind == "block":
        inner = [_writer(c, marked) for c in node.children]

        def block(scope, messages):
            for write in inner:
                yield from write(scope, messages)
        return block
    if kind == "for":
        body = _writer(node.children[0], marked)

        def loop(scope, messages):
            for index, message in enumerate(messages):
                yield from body({**scope, node.value: message, "loop": {"index0": index, "index": index + 1,
                                                                        "first": index == 0}}, messages)
        return loop
    if kind == "if":
        test, then, other = _evaluator(node.children[0]), *(_writer(c, marked) for c in node.children[1:])
        return lambda scope, messages: (then if test(scope) else other)(scope, messages)
    if kind == "generation":
        return _writer(node.children[0], True)
    if kind == "set":
        value = _evaluator(node.children[0])

        def assign(scope, messages):
            scope[node.value] = value(scope)
            return iter(())
        return assign
    value = _evaluator(node)

    def show(scope, messages):
        yield _shown(value(scope)), marked
    return show


def compile_template(template: str) -> Callable[[Iterator[dict]], Iterator[Piece]]:
    """A renderer: from messages with role and text to pieces of output, each with its generation flag."""
    write = _writer(fold(parse(template)), False)
    return lambda messages: write({}, iter(messages))


_CONTROL = regex.compile("|".join(map(regex.escape, CONTROLS)))


class Reader:
    """Reads the turns back from pieces of output of the standard template as they come."""

    def __init__(self):
        self.rest, self.turns, self.digest = "", 0, hashlib.sha256()
        self.open: str | None = None  # role of the turn being read; None between turns
        self.chars = self.loss_chars = 0
        self.loss = hashlib.sha256()

    def feed(self, text: str, marked: bool):
        self.chars += len(text)
        if marked:
            plain = unescape(text)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode("utf-8", "surrogatepass"))
        self.rest += text

    def finish_turn(self):
        """Read the one turn that ``rest`` holds."""
        if not self.rest:
            return
        marks = [(m[0], m.start(), m.end()) for m in _CONTROL.finditer(self.rest)]
        signs, rest = [m[0] for m in marks], self.rest
        if signs == ["<s>", "[INST]", "[/INST]"]:
            role, text = "user", rest[marks[1][2] + 1: marks[2][1] - 1]
        elif signs == ["<<SYS>>", "<</SYS>>"]:
            role, text = "system", rest[marks[0][2]: marks[1][1]]
        elif signs == ["<<ROLE>>", "<</ROLE>>", "</s>"]:
            role, text = unescape(rest[marks[0][2]: marks[1][1]]), rest[marks[1][2]: marks[2][1]]
        elif signs == ["</s>"]:
            role, text = "assistant", rest[: marks[0][1]]
        else:
            raise ValueError(f"not a turn: {signs}")
        self.turns += 1
        self.digest.update(f"{role}\n{unescape(text)}\n".encode("utf-8", "surrogatepass"))
        self.rest = ""


def _formatted(template: str):
    def run(batches):
        render = compile_template(template)
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        out: list[tuple] = []
        row = next(rows, None)
        while row is not None:
            number, reader, state = row[0], Reader(), [row]

            def messages():
                while state[0] is not None and state[0][0] == number:
                    reader.finish_turn()  # the turn before
                    yield {"role": state[0][1] or "", "text": state[0][2] or ""}
                    state[0] = next(rows, None)
            for text, marked in render(messages()):
                reader.feed(text, marked)
            reader.finish_turn()
            row = state[0]
            out.append((number, reader.turns, reader.digest.hexdigest(), reader.loss_chars,
                        reader.loss.hexdigest(), reader.chars))
            if len(out) >= 5000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)
    return run


_RESULT = [("conv_id", "long", pa.int64()), ("n_turns", "long", pa.int64()), ("turns_sha256", "string", pa.string()),
           ("loss_chars", "long", pa.int64()), ("loss_sha256", "string", pa.string()),
           ("formatted_chars", "long", pa.int64())]


def _batch(rows):
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], t) for k, (_, _, t) in enumerate(_RESULT)], [n for n, _, _ in _RESULT])


def _ordered(conversations: DataFrame) -> DataFrame:
    return conversations.select("conv_id", "role", "text", "turn").repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "text").select("conv_id", "role", "text")


def check_format(conversations: DataFrame) -> DataFrame:
    """Per conversation what is read back from its output in the standard template.

    Turns come in order of turn, role and text, nulls first; repeated turns are repeated. A null text or role
    is empty, any other role is kept. Rows with a null conv_id are one conversation. An empty table gives an
    empty result; further columns are ignored. Rows of a conversation pass one task one at a time.
    """
    return _ordered(conversations).mapInArrow(_formatted(TEMPLATE), ", ".join(f"{n} {t}" for n, t, _ in _RESULT))


def _pieces(template: str):
    def run(batches):
        render = compile_template(template)
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        row, out = next(rows, None), []
        while row is not None:
            number, state = row[0], [row]

            def messages():
                while state[0] is not None and state[0][0] == number:
                    yield {"role": state[0][1] or "", "text": state[0][2] or ""}
                    state[0] = next(rows, None)
            for k, (text, marked) in enumerate(render(messages())):
                out.append((number, k, text, marked))
                if len(out) >= 5000:
                    yield _piece_batch(out)
                    out = []
            while state[0] is not None and state[0][0] == number:  # a template that reads no messages
                state[0] = next(rows, None)
            row = state[0]
        if out:
            yield _piece_batch(out)
    return run


def _piece_batch(rows):
    types = [("conv_id", pa.int64()), ("piece", pa.int64()), ("text", pa.string()), ("generated", pa.bool_())]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(types)], [n for n, _ in types])


def render(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """The output of any template: pieces (conv_id, piece, text, generated), in order of ``piece``.

    Joined, the pieces of a conversation are its formatted text; ``generated`` marks those under the loss.
    The cases of ``check_format`` hold.
    """
    compile_template(template)  # errors show before the job starts
    return _ordered(conversations).mapInArrow(
        _pieces(template), "conv_id long, piece long, text string, generated boolean")
