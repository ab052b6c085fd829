"""The algebra as text: calls of functions over $variables, "strings", numbers, true, false and [lists].

    select([$Name], and(triple($P, "rdf:type", "@schema:Person"), triple($P, "@schema:name", $Name)))

A string that begins with @ or holds a colon is a name of a node, any other a literal; the first argument of a
pattern is a node whatever it looks like. vars($a, $b) before a query declares variables and does nothing else.
"""

from __future__ import annotations

import re
from typing import Any

from . import algebra as A

# Functions of the text form; what their arguments are (n a node, p a predicate or class, v a value,
# q a query, qs queries, vs variables, o an order, i a number, e an expression, r a path, ? may be left out).
FUNCTIONS: dict[str, tuple[type, str]] = {
    "triple": (A.Triple, "n p v g?"), "and": (A.And, "qs"), "or": (A.Or, "qs"), "not": (A.Not, "q"), "select": (A.Select, "vs q"), "distinct": (A.Distinct, "vs q"),
    "limit": (A.Limit, "i q"), "start": (A.Start, "i q"), "order_by": (A.OrderBy, "o q"), "group_by": (A.GroupBy, "v vs v q"), "greater": (A.Greater, "v v"), "less": (A.Less, "v v"),
    "eq": (A.Equals, "v v"), "eval": (A.Eval, "e v"), "path": (A.Path, "n r v v?"), "read_document": (A.ReadDocument, "n v"), "insert_document": (A.InsertDocument, "v n?"),
    "update_document": (A.UpdateDocument, "v n?"), "delete_document": (A.DeleteDocument, "n"), "count": (A.Count, "q v"), "sum": (A.Sum, "v v"), "concat": (A.Concatenate, "v v"),
    "substring": (A.Substring, "v v v v v"), "trim": (A.Trim, "v v"), "upper": (A.Upper, "v v"), "lower": (A.Lower, "v v"), "regexp": (A.Regexp, "v v v?"), "isa": (A.IsA, "n p"),
    "type_of": (A.TypeOf, "v v"), "subsumption": (A.Subsumption, "p p"), "opt": (A.Optional, "q"), "optional": (A.Optional, "q"),
    "once": (A.Once, "q"), "if": (A.If, "q q q"), "true": (A.TrueGoal, ""), "member": (A.Member, "v v"), "length": (A.Length, "v v"), "gte": (A.Gte, "v v"), "lte": (A.Lte, "v v"),
    "in_range": (A.InRange, "v v v"), "typecast": (A.Typecast, "v p v"), "using": (A.Using, "s q"), "from": (A.From, "s q"), "add_triple": (A.AddTriple, "n p v g?"), "delete_triple": (A.DeleteTriple, "n p v g?"),
    "split": (A.Split, "v v v"), "join": (A.Join, "v v v"), "collect": (A.Collect, "v v q"),
}
EXPRESSIONS = {"plus": A.Add, "minus": A.Minus, "times": A.Mul, "div": A.Div, "divide": A.Divide, "exp": A.Exp, "floor": A.Floor}
PATHS = {"pred": A.Pred, "inv": A.Inverse, "seq": A.Seq, "or": A.Alt, "star": A.Star, "plus": A.Plus, "times": A.Times}

_TOKEN = re.compile(r"""\s*(?:(\$[^\W\d]\w*)|"([^"]*)"|(-?\d+\.\d+(?:[eE][+-]?\d+)?|-?\d+(?:[eE][+-]?\d+)?)|([^\W\d]\w*)|([()\[\],]))""")


class TextError(ValueError):
    """Text that is no query."""


class _Parser:
    def __init__(self, text: str):
        self.text, self.at = text, 0

    def fail(self, wanted: str) -> TextError:
        return TextError(f"{wanted} expected at {self.at}: {self.text[self.at : self.at + 30]!r}")

    def peek(self):
        return _TOKEN.match(self.text, self.at)

    def take(self, mark: str) -> None:
        m = self.peek()
        if not m or m[5] != mark:
            raise self.fail(mark)
        self.at = m.end()

    def sees(self, mark: str) -> bool:
        m = self.peek()
        return bool(m and m[5] == mark)

    def name(self) -> str | None:
        """The function that is called here, if one is."""
        m = self.peek()
        return m[4] if m and m[4] and re.match(r"\s*\(", self.text[m.end() :]) else None

    def listed(self, end: str, one) -> list:
        out = []
        while not self.sees(end):
            if out:
                self.take(",")
            out.append(one())
        self.take(end)
        return out

    def query(self) -> A.Node:
        name = self.name()
        if name == "vars":
            self.at = self.peek().end()
            self.take("(")
            self.listed(")", self.value)
            return self.query()
        if name not in FUNCTIONS:
            raise self.fail("a query")
        begin = self.at
        self.at = self.peek().end()
        self.take("(")
        kind, spec = FUNCTIONS[name]
        if spec == "qs":
            return kind(*self.listed(")", self.query))
        args: list = []
        for k, what in enumerate(spec.split()):
            if self.sees(")"):
                if what.endswith("?"):
                    break
                raise self.fail(f"argument {k + 1} of {name}")
            if k:
                self.take(",")
            args.append(self.argument(what.rstrip("?")))
        if not self.sees(")"):
            raise self.fail(f"the end of {name} (from {begin})")
        self.take(")")
        if name == "group_by":
            args = [args[0], args[1], args[2], args[3]]
        if name == "regexp":
            args[0], args[1] = args[1], args[0]  # the string comes first in the text form
        return kind(*args)

    def argument(self, what: str) -> Any:
        if what == "q":
            return self.query()
        if what == "vs":
            self.take("[")
            out = self.listed("]", self.value)
            if not all(isinstance(x, A.Var) for x in out):
                raise self.fail("variables")
            return out
        if what == "o":
            self.take("[")
            return self.listed("]", self.order)
        if what == "e":
            return self.expression()
        if what == "r":
            return self.path()
        x = self.value()
        if what == "i" and not (isinstance(x, int) and not isinstance(x, bool)):
            raise self.fail("a whole number")
        if what == "n" and isinstance(x, str):
            return A.Iri(_plain(x))
        if what in ("p", "s", "g"):
            return _plain(x.text) if isinstance(x, A.Iri) else _plain(x) if isinstance(x, str) else x
        return A.Iri(_plain(x.text)) if isinstance(x, A.Iri) else x

    def order(self) -> tuple:
        way = self.name()
        if way not in ("asc", "desc"):
            raise self.fail("asc or desc")
        self.at = self.peek().end()
        self.take("(")
        x = self.value()
        self.take(")")
        return x, way

    def expression(self) -> Any:
        name = self.name()
        if name is None:
            return self.value()
        if name not in EXPRESSIONS:
            raise self.fail("an expression")
        self.at = self.peek().end()
        self.take("(")
        return EXPRESSIONS[name](*self.listed(")", self.expression))

    def path(self) -> A.Pattern:
        name = self.name()
        if name not in PATHS:
            raise self.fail("a path")
        self.at = self.peek().end()
        self.take("(")
        if name in ("pred", "inv"):
            got = self.listed(")", self.value)
            return PATHS[name](*[_plain(x.text if isinstance(x, A.Iri) else x) for x in got] or [None])
        if name in ("seq", "or"):
            return PATHS[name](self.listed(")", self.path))
        inner = [self.path()]
        while not self.sees(")"):
            self.take(",")
            inner.append(self.value())
        self.take(")")
        return PATHS[name](*inner)

    def value(self) -> Any:
        m = self.peek()
        if not m:
            raise self.fail("a value")
        self.at = m.end()
        if m[1]:
            return A.Var(m[1][1:])
        if m[2] is not None:
            return A.Iri(m[2]) if m[2].startswith("@") or ":" in m[2] else m[2]
        if m[3]:
            return int(m[3]) if re.fullmatch(r"-?\d+", m[3]) else float(m[3])
        if m[4] in ("true", "false"):
            return m[4] == "true"
        if m[5] == "[":
            return self.listed("]", self.value)
        self.at = m.start()
        raise self.fail("a value")


def _plain(name: str) -> str:
    """A name without the prefix of the schema."""
    return name.removeprefix("@schema:")


def parse(text: str) -> A.Node:
    p = _Parser(text.strip())
    out = p.query()
    if p.text[p.at :].strip():
        raise p.fail("the end")
    return out


_NAMES = {kind: name for name, (kind, _) in reversed(FUNCTIONS.items())}
_EXPRESSION_NAMES = {kind: name for name, kind in EXPRESSIONS.items()}
_PATH_NAMES = {kind: name for name, kind in PATHS.items()}


def render(x: Any) -> str:
    """The text form of a query that has one; parse() gives the query back."""
    from dataclasses import fields

    if isinstance(x, A.Var):
        return f"${x.name}"
    if isinstance(x, A.Iri):
        return f'"{x.text}"' if x.text.startswith("@") or ":" in x.text else f'"@schema:{x.text}"'
    if isinstance(x, bool):
        return "true" if x else "false"
    if isinstance(x, (int, float)):
        return repr(x)
    if isinstance(x, str):
        if '"' in x:
            raise TextError(f"the text form has no quotation mark in a string: {x}")
        return f'"{x}"'
    if isinstance(x, (list, tuple)):
        return "[" + ", ".join(render(y) for y in x) + "]"
    if isinstance(x, A.Pattern):
        given = [getattr(x, f.name) for f in fields(x)]
        parts = [render(y) for z in given if z is not None for y in (z if isinstance(z, (list, tuple)) else [z])]
        return f"{_PATH_NAMES[type(x)]}({', '.join(parts)})"
    if isinstance(x, A.Expression):
        return f"{_EXPRESSION_NAMES[type(x)]}({', '.join(render(getattr(x, f.name)) for f in fields(x))})"
    if type(x) not in _NAMES:
        raise TextError(f"{type(x).__name__} has no text form")
    name = _NAMES[type(x)]
    if isinstance(x, (A.And, A.Or)):
        return f"{name}({', '.join(map(render, x.goals))})"
    given = [getattr(x, f.name) for f in fields(x)]
    if isinstance(x, A.OrderBy):
        return f"{name}([{', '.join(f'{way}({render(v)})' for v, way in x.ordering)}], {render(x.query)})"
    if isinstance(x, A.Regexp):
        given[0], given[1] = given[1], given[0]
    if isinstance(x, A.Path) and isinstance(x.pattern, str):
        from ..operators.paths import parse as parse_path

        given[1] = parse_path(x.pattern)
    if isinstance(x, A.ReadDocument):
        given = given[:2]
    while given and given[-1] is None:
        given.pop()
    return f"{name}({', '.join(map(render, given))})"
