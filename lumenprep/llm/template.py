"""A sandboxed template language: parsed to a syntax tree, constants folded, compiled to Python closures.

Text; {{ expression }}; {% for x in messages %}..{% endfor %}; {% if e %}..{% elif e %}..{% else %}..{% endif %};
{% generation %}..{% endgeneration %}; {# comment #}. A dash inside a tag ("{%-", "-}}") strips white space beside it.
Expressions: strings, integers, true/false/none, names, x.field, x['field'], loop.first/last/index/index0, ~ and +,
== != < > <= >= in, and/or/not, a if c else b, and the filters of FILTERS. Nothing else exists: no calls, no attributes
but the fields of a message, no imports; a name that is not bound is an error when the template is compiled.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator

CONTROL = re.compile(r"<(\\*)\|")
ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(s: str) -> str:
    """No "<|" stays: one backslash more between < and |; unescape() takes it away."""
    return CONTROL.sub(r"<\\\1|", s) if "|" in s else s


def unescape(s: str) -> str:
    return ESCAPED.sub(r"<\1|", s) if "|" in s else s


def escape_line(s: str) -> str:
    """As escape(), and on one line."""
    return escape(s.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_line(s: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(s))


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "escape_line": escape_line, "trim": str.strip, "upper": str.upper, "lower": str.lower}
OPERATORS = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, ">": operator.gt, "<=": operator.le, ">=": operator.ge, "in": lambda a, b: a in b, "~": lambda a, b: _text(a) + _text(b), "+": operator.add}
TOKEN = re.compile(r"""\s*(?:(?P<str>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[<>~+|.()\[\]]))""", re.S)
LOOP = ("first", "last", "index", "index0")


class TemplateError(ValueError):
    pass


def _text(x: object) -> str:
    return "" if x is None else str(x)


class _Expression:
    """Precedence climbing over the tokens of one tag; nodes are tuples, the first item names the kind."""

    def __init__(self, source: str, names: set[str]):
        self.tokens, at = [], 0
        source = source.rstrip()
        while at < len(source):
            if not (m := TOKEN.match(source, at)):
                raise TemplateError(f"unexpected {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at, self.names = 0, names

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "str" else None

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted and self.peek() is not None:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def whole(self) -> tuple:
        node = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def choice(self) -> tuple:
        node = self.either()
        if self.take("if"):
            test = self.either()
            if not self.take("else"):
                raise TemplateError("'if' needs 'else'")
            return ("choose", test, node, self.choice())
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        node = self.joined()
        while op := self.take("==", "!=", "<", ">", "<=", ">=", "in"):
            node = ("op", op, node, self.joined())
        return node

    def joined(self) -> tuple:
        node = self.filtered()
        while op := self.take("~", "+"):
            node = ("op", op, node, self.filtered())
        return node

    def filtered(self) -> tuple:
        node = self.atom()
        while self.take("|"):
            name = self.tokens[self.at][1] if self.at < len(self.tokens) else None
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            node = ("filter", name, node)
        return node

    def atom(self) -> tuple:
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if value == "(" and kind == "op":
            node = self.choice()
            if not self.take(")"):
                raise TemplateError("')' is missing")
            return node
        if kind == "str":
            return ("const", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "int":
            return ("const", int(value))
        if kind != "name":
            raise TemplateError(f"unexpected {value!r}")
        if value in ("true", "false", "none"):
            return ("const", {"true": True, "false": False, "none": None}[value])
        if value not in self.names:
            raise TemplateError(f"no name {value!r}")
        if self.take("."):
            field = self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] == "name" else ""
            self.at += 1
        elif self.take("["):
            key = self.choice()
            if key[0] != "const" or not isinstance(key[1], str) or not self.take("]"):
                raise TemplateError("only a constant field may be looked up")
            field = key[1]
        else:
            return ("name", value)
        if not field or field.startswith("_") or value == "loop" and field not in LOOP:
            raise TemplateError(f"no field {field!r}")
        return ("field", value, field)


def fold(node: tuple) -> tuple:
    """Replaces what only depends on constants by its value."""
    kind = node[0]
    if kind in ("const", "name", "field"):
        return node
    if kind == "filter":
        x = fold(node[2])
        return ("const", FILTERS[node[1]](_text(x[1]))) if x[0] == "const" else ("filter", node[1], x)
    if kind == "op":
        a, b = fold(node[2]), fold(node[3])
        return ("const", OPERATORS[node[1]](a[1], b[1])) if a[0] == b[0] == "const" else ("op", node[1], a, b)
    parts = [fold(x) for x in node[1:]]
    if parts[0][0] == "const":
        truth = bool(parts[0][1])
        if kind == "not":
            return ("const", not truth)
        return parts[1 if truth else 2] if kind == "choose" else parts[1] if truth == (kind == "and") else parts[0]
    return (kind, *parts)


def _tags(source: str) -> Iterator[tuple[str, str]]:
    at, strip = 0, False
    for m in re.finditer(r"\{(?:\{(-?)(.*?)(-?)\}|%(-?)(.*?)(-?)%|#(-?).*?(-?)#)\}", source, re.S):
        text = source[at : m.start()]
        text = text.lstrip() if strip else text
        if m[1] or m[4] or m[7]:
            text = text.rstrip()
        yield "text", text
        if m[2] is not None:
            yield "print", m[2].strip()
        elif m[5] is not None:
            yield "tag", m[5].strip()
        at, strip = m.end(), bool(m[3] or m[6] or m[8])
    yield "text", source[at:].lstrip() if strip else source[at:]


def parse(source: str) -> tuple:
    """The syntax tree, constants folded: ("block", nodes)."""
    tags = list(_tags(source))
    at = 0

    def block(names: set[str], ends: tuple[str, ...]) -> tuple[tuple, str]:
        nonlocal at
        nodes: list[tuple] = []

        def add(node: tuple) -> None:
            if node[0] == "print" and node[1][0] == "const":
                node = ("text", _text(node[1][1]))
            if node[0] == "text":
                if nodes and nodes[-1][0] == "text":
                    node = ("text", nodes.pop()[1] + node[1])
                if not node[1]:
                    return
            nodes.append(node)

        while at < len(tags):
            kind, value = tags[at]
            at += 1
            if kind == "text":
                add(("text", value))
            elif kind == "print":
                add(("print", fold(_Expression(value, names).whole())))
            else:
                word, _, rest = value.partition(" ")
                if word in ends:
                    return ("block", tuple(nodes)), value
                if word == "for":
                    m = re.fullmatch(r"(\w+)\s+in\s+messages", rest.strip())
                    if not m or "loop" in names:
                        raise TemplateError("only an outer loop over messages exists")
                    body, _ = block(names | {m[1], "loop"}, ("endfor",))
                    add(("for", m[1], body))
                elif word == "if":
                    branches, test, orelse = [], fold(_Expression(rest, names).whole()), ("block", ())
                    while True:
                        body, end = block(names, ("elif", "else", "endif"))
                        branches.append((test, body))
                        if end.startswith("elif"):
                            test = fold(_Expression(end[4:], names).whole())
                            continue
                        if end == "else":
                            orelse, _ = block(names, ("endif",))
                        break
                    for test, body in reversed(branches):
                        orelse = (body if test[1] else orelse) if test[0] == "const" else ("if", test, body, orelse)
                    for node in orelse[1] if orelse[0] == "block" else [orelse]:
                        add(node)
                elif word == "generation":
                    body, _ = block(names, ("endgeneration",))
                    add(("generation", body))
                else:
                    raise TemplateError(f"unexpected tag {value!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return ("block", tuple(nodes)), ""

    return block(set(), ())[0]


Emit = Callable[[str, bool], None]


def _value(node: tuple) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "const":
        return lambda env, x=node[1]: x
    if kind == "name":
        return lambda env, n=node[1]: env[n]
    if kind == "field":
        return lambda env, n=node[1], f=node[2]: env[n].get(f)
    if kind == "filter":
        return lambda env, f=FILTERS[node[1]], x=_value(node[2]): f(_text(x(env)))
    if kind == "op":
        return lambda env, f=OPERATORS[node[1]], a=_value(node[2]), b=_value(node[3]): f(a(env), b(env))
    parts = [_value(x) for x in node[1:]]
    if kind == "not":
        return lambda env: not parts[0](env)
    if kind == "and":
        return lambda env: parts[0](env) and parts[1](env)
    if kind == "or":
        return lambda env: parts[0](env) or parts[1](env)
    return lambda env: parts[1](env) if parts[0](env) else parts[2](env)


def _writer(node: tuple, masked: bool = False) -> Callable[[dict, Emit], None]:
    kind = node[0]
    if kind == "text":
        return lambda env, emit, s=node[1]: emit(s, masked)
    if kind == "print":
        return lambda env, emit, x=_value(node[1]): emit(_text(x(env)), masked)
    if kind == "if":
        test, then, other = _value(node[1]), _writer(node[2], masked), _writer(node[3], masked)
        return lambda env, emit: then(env, emit) if test(env) else other(env, emit)
    if kind == "generation":
        return _writer(node[1], True)
    if kind == "for":
        raise TemplateError("a loop must stand outside other tags")
    parts = [_writer(x, masked) for x in node[1]]

    def run(env: dict, emit: Emit) -> None:
        for p in parts:
            p(env, emit)

    return run


class Template:
    """stream(messages) yields, after each message, what is new: (text, [(start, end) of generated text in it])."""

    def __init__(self, source: str):
        self.tree = parse(source)
        self.parts = [(n[1], _writer(n[2])) if n[0] == "for" else (None, _writer(n)) for n in self.tree[1]]
        if sum(name is not None for name, _ in self.parts) > 1:
            raise TemplateError("messages are read once: only one loop")

    def stream(self, messages: Iterable[dict]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        out: list[str] = []
        spans: list[tuple[int, int]] = []
        size = 0

        def emit(s: str, masked: bool) -> None:
            nonlocal size
            if s:
                if masked:
                    if spans and spans[-1][1] == size:
                        spans[-1] = (spans[-1][0], size + len(s))
                    else:
                        spans.append((size, size + len(s)))
                out.append(s)
                size += len(s)

        def new() -> tuple[str, list[tuple[int, int]]]:
            nonlocal size
            got = "".join(out), list(spans)
            out.clear()
            spans.clear()
            size = 0
            return got

        for name, write in self.parts:
            if name is None:
                write({}, emit)
                continue
            rows = iter(messages)
            row, i = next(rows, None), 0
            while row is not None:
                following = next(rows, None)
                write({name: row, "loop": {"first": i == 0, "last": following is None, "index": i + 1, "index0": i}}, emit)
                row, i = following, i + 1
                if row is not None:
                    yield new()
        yield new()
