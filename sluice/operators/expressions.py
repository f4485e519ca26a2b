"""The expressions of computed columns, as Spark columns.

The profile is that of CEL without regular expressions, iteration and time: comparison,
logic, ``in``, arithmetic, ``?:``, lists and maps, ``has``, ``size``, ``contains``,
``startsWith``, ``endsWith``, casts, ``type`` and ``dyn``.  What fails on a row (a field
that is not there, overflow, division by zero, a cast that does not hold) makes that
row's value null and touches no other row.  Whole numbers divide without a fraction,
``+`` joins texts and lists, and a logical operator holds if one side decides it.

A field that came along as text may hold any kind of value ("dyn"): beside a number it
is read as one, beside a text as a text, and after ``in`` as a JSON list or object.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(r"""\s*(?:(?P<number>0[xX][0-9a-fA-F]+|(?:\d+\.\d*|\.\d+|\d+)(?:[eE][+-]?\d+)?)u?|(?P<text>[rR]?(?:"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'))|(?P<name>[A-Za-z_]\w*|`[^`]+`)|(?P<mark>&&|\|\||==|!=|<=|>=|[-+*/%<>!?:.,()\[\]{}]))""", re.S)
#: How strongly operators of two sides bind.
_BINDS = {"||": 1, "&&": 2, "==": 3, "!=": 3, "<": 3, "<=": 3, ">": 3, ">=": 3, "in": 3, "+": 4, "-": 4, "*": 5, "/": 5, "%": 5}
_TYPES = ("int", "uint", "double", "string", "bool", "bytes", "list", "map", "null_type")
_METHODS = ("contains", "startsWith", "endsWith", "size")
_BARRED = ("matches", "map", "filter", "exists", "all", "exists_one", "timestamp", "duration")


@dataclass(frozen=True)
class Node:
    """``op`` with its parts; a leaf has a value."""

    op: str
    parts: tuple[Node, ...] = ()
    value: object = None


class _Reader:
    """Recursive descent over the tokens of an expression."""

    def __init__(self, text: str):
        self.tokens, at = [], 0
        text = text.rstrip()
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise ValueError(f"not an expression at {text[at : at + 20]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "text" else None

    def take(self, mark: str) -> bool:
        if self.peek() == mark:
            self.at += 1
            return True
        return False

    def want(self, mark: str) -> None:
        if not self.take(mark):
            raise ValueError(f"{mark} is missing")

    def whole(self) -> Node:
        out = self.choice()
        if self.at < len(self.tokens):
            raise ValueError(f"left over: {self.tokens[self.at][1]}")
        return out

    def choice(self) -> Node:
        condition = self.sides(1)
        if not self.take("?"):
            return condition
        yes = self.choice()
        self.want(":")
        return Node("?", (condition, yes, self.choice()))

    def sides(self, least: int) -> Node:
        left = self.prefix()
        while (op := self.peek()) in _BINDS and _BINDS[op] >= least:
            self.at += 1
            left = Node(op, (left, self.sides(_BINDS[op] + 1)))
        return left

    def prefix(self) -> Node:
        if self.take("!"):
            return Node("!", (self.prefix(),))
        if self.take("-"):
            inner = self.prefix()
            plain = inner.op == "value" and isinstance(inner.value, int | float)
            return Node("value", (), -inner.value) if plain else Node("-", (Node("value", (), 0), inner))
        return self.member()

    def listed(self, end: str) -> tuple[Node, ...]:
        out: list[Node] = []
        while not self.take(end):
            if out:
                self.want(",")
                if self.take(end):
                    break
            out.append(self.choice())
        return tuple(out)

    def member(self) -> Node:
        out = self.primary()
        while True:
            if self.take("."):
                kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
                if kind != "name":
                    raise ValueError("a name is missing after a dot")
                self.at += 1
                out = Node("call", (out, *self.listed(")")), name) if self.take("(") else Node(".", (out,), name.strip("`"))
            elif self.take("["):
                index = self.choice()
                self.want("]")
                out = Node("[]", (out, index))
            else:
                return out

    def primary(self) -> Node:
        if self.at >= len(self.tokens):
            raise ValueError("an expression ends too early")
        kind, token = self.tokens[self.at]
        self.at += 1
        if kind == "number":
            return Node("value", (), int(token, 16) if token[:2] in ("0x", "0X") else int(token) if token.isdigit() else float(token))
        if kind == "text":
            raw = token[0] in "rR"
            body = token[2:-1] if raw else token[1:-1]
            return Node("value", (), body if raw else re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t", "r": "\r"}.get(m[1], m[1]), body, flags=re.S))
        if token == "(":
            inner = self.choice()
            self.want(")")
            return inner
        if token == "[":
            return Node("list", self.listed("]"))
        if token == "{":
            pairs: list[Node] = []
            while not self.take("}"):
                if pairs:
                    self.want(",")
                pairs.append(self.choice())
                self.want(":")
                pairs.append(self.choice())
            return Node("map", tuple(pairs))
        if kind != "name":
            raise ValueError(f"unexpected {token}")
        if token in ("true", "false", "null"):
            return Node("value", (), {"true": True, "false": False, "null": None}[token])
        if self.take("("):
            return Node("call", (None, *self.listed(")")), token)
        return Node("name", (), token.strip("`"))


def parse(text: str) -> Node:
    try:
        return _Reader(text).whole()
    except RecursionError:
        raise ValueError("an expression is nested too deep") from None


def _path(node: Node) -> str | None:
    """The dotted name that a chain of names spells."""
    if node.op == "name":
        return str(node.value)
    head = _path(node.parts[0]) if node.op == "." else None
    return None if head is None else f"{head}.{node.value}"


def names(node: Node) -> list[str]:
    """The fields that an expression names, in order."""
    found: list[str] = []

    def walk(n: Node | None) -> None:
        if n is None:
            return
        if (path := _path(n)) is not None:
            if path not in _TYPES:
                found.append(path)
        else:
            for p in n.parts:
                walk(p)

    walk(node)
    return list(dict.fromkeys(found))


@dataclass(frozen=True)
class Term:
    """A compiled expression: ``kind`` is int, double, string, bool, bytes, list, map, null,
    dyn or other; ``null`` tells that null may be its value without a failure."""

    value: Column
    kind: str
    null: bool = False
    item: str = "dyn"  # of a list


def _kind(t: T.DataType) -> str:
    if isinstance(t, T.ByteType | T.ShortType | T.IntegerType | T.LongType):
        return "int"
    if isinstance(t, T.FloatType | T.DoubleType | T.DecimalType):
        return "double"
    for kind, types in (("string", T.StringType), ("bool", T.BooleanType), ("bytes", T.BinaryType), ("list", T.ArrayType), ("map", T.MapType | T.StructType), ("null", T.NullType)):
        if isinstance(t, types):
            return kind
    return "other"


def _number(t: Term) -> Column:
    return t.value.try_cast("double") if t.kind == "dyn" else t.value


def _truth(t: Term) -> Column:
    if t.kind in ("bool", "null"):
        return t.value.cast("boolean")
    if t.kind == "dyn":
        return t.value.try_cast("boolean")
    raise ValueError(f"a {t.kind} is no condition")


def _same_kind(a: Term, b: Term) -> tuple[Column, Column, str]:
    """Two values as columns of one type."""
    if a.kind == b.kind or "null" in (a.kind, b.kind):
        return a.value, b.value, b.kind if a.kind == "null" else a.kind
    if {a.kind, b.kind} <= {"int", "double"}:
        return a.value.cast("double"), b.value.cast("double"), "double"
    if {a.kind, b.kind} <= {"list", "map"}:
        return F.to_json(a.value), F.to_json(b.value), "dyn"
    text = lambda t: F.to_json(t.value) if t.kind in ("list", "map") else t.value.cast("string")
    return text(a), text(b), "string" if {a.kind, b.kind} == {"string", "dyn"} else "dyn"


_WHOLE = r"^[+-]?\d{1,18}$"


@dataclass
class Compiler:
    """Columns for expressions over the fields of ``schema``; those among ``texts`` are text
    of any kind."""

    schema: T.StructType
    texts: tuple[str, ...] = ()
    functions: dict[str, Callable[..., Term]] = field(init=False)

    def __post_init__(self):
        self.types = {f.name: f.dataType for f in self.schema.fields}
        self.functions = {"size": self.size, "type": self.type_of, "dyn": lambda t: t, "if": self.choose, "int": self.whole_number, "uint": self.unsigned}
        self.functions |= {n: self.cast(n, to) for n, to in (("double", "double"), ("string", "string"), ("bool", "boolean"), ("bytes", "binary"))}
        self.functions |= {f"try_{n}": lambda a, b, op=op: self.arithmetic(op, a, b) for n, op in (("add", "+"), ("subtract", "-"), ("multiply", "*"), ("divide", "/"))}

    def compile(self, text: str) -> Term:
        return self.term(parse(text))

    def term(self, n: Node) -> Term:
        if n.op == "value":
            kind = {bool: "bool", int: "int", float: "double", str: "string", type(None): "null"}[type(n.value)]
            if kind == "int" and not -(2**63) <= n.value < 2**63:
                raise ValueError("a number does not fit in 64 bits")
            return Term(F.lit(n.value).cast("bigint") if kind == "int" else F.lit(n.value), kind, kind == "null")
        if (path := _path(n)) is not None and (found := self.variable(path)) is not None:
            return found
        if n.op == "name":
            if n.value in _TYPES:
                return Term(F.lit(n.value), "string")
            raise ValueError(f"no field {n.value}")
        if n.op == ".":
            return self.index(self.term(n.parts[0]), Term(F.lit(n.value), "string"), n.value)
        if n.op == "[]":
            return self.index(*map(self.term, n.parts))
        if n.op == "list":
            return self.listed([self.term(p) for p in n.parts])
        if n.op == "map":
            values = self.listed([self.term(p) for p in n.parts[1::2]])
            keys = F.array(*[self.term(p).value.cast("string") for p in n.parts[::2]])
            return Term(F.map_from_arrays(keys, values.value), "map")
        if n.op == "call":
            return self.call(n)
        if n.op == "in":
            return self.held(n)
        parts = [self.term(p) for p in n.parts]
        if n.op == "!":
            return Term(~_truth(parts[0]), "bool")
        if n.op == "?":
            return self.choose(*parts)
        if n.op in ("&&", "||"):
            a, b = map(_truth, parts)
            return Term(a & b if n.op == "&&" else a | b, "bool")
        return self.arithmetic(n.op, *parts) if n.op in "+-*/%" else self.compared(n.op, *parts)

    def variable(self, path: str) -> Term | None:
        """The field that a dotted path leads to: a column of the whole name, or inside one."""
        if path in self.types:
            kind = _kind(self.types[path])
            element = getattr(self.types[path], "elementType", None)
            return Term(F.col(f"`{path}`"), "dyn" if path in self.texts and kind == "string" else kind, False, _kind(element) if element else "dyn")
        for k in range(path.count("."), 0, -1):
            parts = path.split(".")
            head, inner = ".".join(parts[:k]), parts[k:]
            if head not in self.types:
                continue
            at, value = self.types[head], F.col(f"`{head}`")
            for name in inner:
                if isinstance(at, T.StructType) and name in at.names:
                    at, value = at[name].dataType, value[name]
                elif isinstance(at, T.MapType):
                    at, value = at.valueType, F.try_element_at(value, F.lit(name))
                else:
                    return None
            return Term(value, _kind(at))
        return None

    def listed(self, items: list[Term]) -> Term:
        kinds = {t.kind for t in items} - {"null"}
        if kinds <= {"int", "double"} and len(kinds) == 2:
            items, kinds = [Term(t.value.cast("double"), "double") for t in items], {"double"}
        one = kinds.pop() if len(kinds) == 1 else "dyn"
        values = [t.value.cast("string") if one == "dyn" else t.value for t in items]
        return Term(F.array(*values) if values else F.array().cast("array<string>"), "list", item=one)

    def index(self, of: Term, key: Term, name: object = None) -> Term:
        if of.kind == "list" and key.kind in ("int", "dyn"):
            return Term(F.get(of.value, key.value.try_cast("int")), of.item)
        if of.kind == "map":
            return Term(F.try_element_at(of.value, key.value.cast("string")), "dyn")
        if of.kind == "dyn":  # a list or an object in JSON
            step = F.concat(F.lit("$["), key.value.cast("string"), F.lit("]")) if key.kind == "int" else F.concat(F.lit("$['"), key.value.cast("string"), F.lit("']"))
            return Term(F.call_function("get_json_object", of.value, step), "dyn")
        raise ValueError(f"a {of.kind} has no {name if name is not None else 'parts'}")

    def call(self, n: Node) -> Term:
        name, (on, *rest) = str(n.value), n.parts
        if name in _BARRED:
            raise ValueError("regular expressions, iteration and time are not for computed columns")
        if name == "has" and on is None and len(rest) == 1:
            path = _path(rest[0])
            if path is None:
                raise ValueError("has takes a field")
            found = self.variable(path)
            return Term(found.value.isNotNull() if found is not None else F.lit(False), "bool")
        if on is not None:
            if name not in _METHODS:
                raise ValueError(f"no function {name}")
            return self.size(self.term(on)) if name == "size" and not rest else self.text_test(name, self.term(on), *map(self.term, rest))
        if name not in self.functions:
            raise ValueError(f"no function {name}")
        try:
            return self.functions[name](*map(self.term, rest))
        except TypeError:
            raise ValueError(f"{name} has other parts") from None

    def text_test(self, name: str, on: Term, part: Term) -> Term:
        if name == "contains" and on.kind == "list":
            return self.in_list(part, on)
        if {on.kind, part.kind} - {"string", "dyn", "null"}:
            raise ValueError(f"{name} is for texts")
        return Term({"contains": F.contains, "startsWith": F.startswith, "endsWith": F.endswith}[name](on.value, part.value), "bool")

    def size(self, t: Term) -> Term:
        if t.kind in ("list", "map"):
            return Term(F.size(t.value).cast("bigint"), "int")
        if t.kind == "bytes":
            return Term(F.octet_length(t.value).cast("bigint"), "int")
        if t.kind not in ("string", "dyn", "null"):
            raise ValueError(f"a {t.kind} has no size")
        plain = F.length(t.value)
        if t.kind == "dyn":
            plain = F.coalesce(F.when(t.value.startswith("["), F.json_array_length(t.value)), F.when(t.value.startswith("{"), F.size(F.json_object_keys(t.value))), plain)
        return Term(plain.cast("bigint"), "int")

    def held(self, n: Node) -> Term:
        one = self.term(n.parts[0])
        if n.parts[1].op == "list":
            found = [self.compared("==", one, self.term(p)).value for p in n.parts[1].parts]
            return Term(reduce(lambda a, b: a | b, found, F.lit(False)), "bool")
        of = self.term(n.parts[1])
        if of.kind == "list":
            return self.in_list(one, of)
        text = one.value.cast("string")
        if of.kind == "map":
            return Term(F.map_contains_key(of.value, text), "bool")
        if of.kind == "dyn":
            items = F.when(of.value.startswith("{"), F.json_object_keys(of.value)).otherwise(F.from_json(of.value, "array<string>"))
            return Term(F.array_contains(items, text), "bool")
        raise ValueError(f"nothing is in a {of.kind}")

    def in_list(self, one: Term, of: Term) -> Term:
        equal = lambda x: F.coalesce(self.compared("==", one, Term(x, of.item)).value, F.lit(False))
        return Term(F.when(one.value.isNotNull() & of.value.isNotNull(), F.exists(of.value, equal)), "bool")

    def choose(self, condition: Term, yes: Term, no: Term) -> Term:
        c = _truth(condition)
        a, b, kind = _same_kind(yes, no)
        return Term(F.when(c, a).when(~c, b), kind, yes.null or no.null, yes.item)

    def compared(self, op: str, a: Term, b: Term) -> Term:
        kinds = {a.kind, b.kind}
        if "null" in kinds:
            other = b if a.kind == "null" else a
            if op not in ("==", "!="):
                raise ValueError("null is not less or more")
            return Term(other.value.isNull() if op == "==" else other.value.isNotNull(), "bool")
        if "dyn" in kinds and kinds & {"int", "double"}:
            x, y = _number(a), _number(b)
        elif "dyn" in kinds and "bool" in kinds:
            x, y = _truth(a), _truth(b)
        elif a.kind == b.kind or kinds <= {"int", "double"} or kinds <= {"string", "dyn"} or "other" in kinds:
            x, y = a.value, b.value
        elif op in ("==", "!="):  # values of two kinds are never equal
            return Term(F.when(a.value.isNotNull() & b.value.isNotNull(), F.lit(op == "!=")), "bool")
        else:
            raise ValueError(f"a {a.kind} is not less or more than a {b.kind}")
        return Term({"==": x == y, "!=": x != y, "<": x < y, "<=": x <= y, ">": x > y, ">=": x >= y}[op], "bool")

    def arithmetic(self, op: str, a: Term, b: Term) -> Term:
        kinds = {a.kind, b.kind}
        if op == "+" and kinds <= {"string", "dyn"} and "string" in kinds:
            return Term(F.concat(a.value, b.value), "string")
        if op == "+" and kinds == {"list"}:
            return Term(F.concat(a.value, b.value), "list", item=a.item)
        if op == "+" and kinds == {"dyn"}:  # numbers if both are, else texts
            x, y = _number(a), _number(b)
            sum_ = self.whole("+", a.value.try_cast("bigint"), b.value.try_cast("bigint")).cast("string")
            return Term(F.coalesce(F.when(a.value.rlike(_WHOLE) & b.value.rlike(_WHOLE), sum_), (x + y).cast("string"), F.concat(a.value, b.value)), "dyn")
        if kinds - {"int", "double", "dyn", "null"}:
            raise ValueError(f"{op} is not for a {a.kind} and a {b.kind}")
        if kinds == {"int"}:
            return Term(self.whole(op, a.value.cast("bigint"), b.value.cast("bigint")), "int")
        x, y = _number(a).cast("double"), _number(b).cast("double")
        out = {"+": F.try_add, "-": F.try_subtract, "*": F.try_multiply, "/": F.try_divide, "%": F.try_mod}[op](x, y)
        if op == "/" and "dyn" in kinds:
            out = F.when((x == F.rint(x)) & (y == F.rint(y)) & ~self.fraction(a) & ~self.fraction(b), F.when(out < 0, F.ceil(out)).otherwise(F.floor(out)).cast("double")).otherwise(out)
        return Term(out, "double")

    def fraction(self, t: Term) -> Column:
        """Whether a number is one with a fraction by its kind or its text."""
        return F.lit(t.kind == "double") if t.kind != "dyn" else ~t.value.rlike(_WHOLE)

    def whole(self, op: str, x: Column, y: Column) -> Column:
        """Of 64 bits, null for what does not fit; division goes towards zero."""
        if op == "/":
            # of two whole numbers Spark's own operator divides without a fraction
            return F.when(y == -1, F.try_subtract(F.lit(0).cast("bigint"), x)).when(y != 0, F.call_function("div", x, y))
        return {"+": F.try_add, "-": F.try_subtract, "*": F.try_multiply, "%": F.try_mod}[op](x, y)

    def whole_number(self, t: Term) -> Term:
        if t.kind in ("string", "dyn"):
            whole = F.when(t.value.rlike(r"^[+-]?\d+$"), t.value.try_cast("bigint"))
            return Term(F.coalesce(whole, t.value.try_cast("double").try_cast("bigint")) if t.kind == "dyn" else whole, "int")
        return Term(t.value.try_cast("bigint"), "int")

    def unsigned(self, t: Term) -> Term:
        n = self.whole_number(t).value
        return Term(F.when(n >= 0, n), "int")

    def cast(self, name: str, to: str) -> Callable[[Term], Term]:
        def made(t: Term) -> Term:
            if t.kind in ("list", "map"):
                if name != "string":
                    raise ValueError(f"a {t.kind} is no {name}")
                return Term(F.to_json(t.value), "string")
            return Term(t.value.cast("string").cast("binary") if name == "bytes" and t.kind != "bytes" else t.value.try_cast(to), name)

        return made

    def type_of(self, t: Term) -> Term:
        if t.kind != "dyn":
            return Term(F.lit({"null": "null_type"}.get(t.kind, t.kind)), "string")
        v = t.value
        found = F.when(v.rlike(_WHOLE), "int").when(v.try_cast("double").isNotNull(), "double").when(v.isin("true", "false"), "bool").when(v.startswith("["), "list").when(v.startswith("{"), "map")
        return Term(F.when(v.isNotNull(), found.otherwise("string")), "string")


def finished(t: Term, to: str | None) -> Column:
    """The value for a column of Spark type ``to`` (none: as it is): lists and maps as JSON
    where the column is text; numbers that are none, and what the type can't hold, as
    null."""
    value = t.value
    if t.kind == "double":
        value = F.when(~F.isnan(value.cast("double")) & (F.abs(value.cast("double")) != float("inf")), value)
    if t.kind in ("list", "map") and to == "string":
        return F.to_json(value)
    if t.kind in ("list", "map", "bytes") or to is None:
        return value if to is None or t.kind == "bytes" and to == "binary" else value.try_cast(to) if t.kind != "bytes" else value.cast("string").try_cast(to)
    return value.try_cast(to) if t.kind != "other" else value.cast("string").try_cast(to) if to != "string" else value.cast("string")


