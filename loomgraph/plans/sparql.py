"""A subset of SPARQL SELECT, compiled to the algebra: patterns, OPTIONAL, UNION, FILTER, MINUS, BIND, VALUES, paths, modifiers."""

from __future__ import annotations

import datetime
import re
from decimal import Decimal

from ..operators import paths  # noqa: F401  the path forms share the algebra
from . import algebra as A

_TOKEN = re.compile(
    r"""\s*(?:\#[^\n]*\n\s*)*(?P<t><[^<>\s]*>|\?[A-Za-z_]\w*|\$[A-Za-z_]\w*|"(?:[^"\\]|\\.)*"(?:@[A-Za-z-]+|\^\^(?:<[^>]*>|[\w-]*:[\w-]+))?|'(?:[^'\\]|\\.)*'|[+-]?\d+\.\d+(?:[eE][+-]?\d+)?|[+-]?\d+|&&|\|\||!=|<=|>=|\^|[A-Za-z_][\w-]*:[\w/.-]*[\w/-]|:[\w-]+|[A-Za-z_]\w*|[{}().;,|/*+?!=<>\[\]])"""
)
_STOP = {"}", ".", ";", ","}


class SparqlError(ValueError):
    """Text outside the subset."""


class _Parser:
    def __init__(self, text: str):
        self.tokens, at = [], 0
        text = text.strip()
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise SparqlError(f"can't read: {text[at:at + 30]}")
            self.tokens.append(m["t"])
            at = m.end()
            while at < len(text) and text[at].isspace():
                at += 1
        self.at = 0
        self.prefixes: dict[str, str] = {}
        self.seen: list[str] = []
        self.fresh = 0

    def peek(self, k: int = 0):
        return self.tokens[self.at + k] if self.at + k < len(self.tokens) else ""

    def word(self) -> str:
        return self.peek().upper()

    def take(self, x: str | None = None) -> str:
        got = self.peek()
        if not got or (x and got.upper() != x):
            raise SparqlError(f"{x or 'something'} expected, not {got or 'the end'}")
        self.at += 1
        return got

    def var(self) -> A.Var:
        t = self.take()
        if t[0] not in "?$":
            raise SparqlError(f"a variable expected, not {t}")
        if t[1:] not in self.seen:
            self.seen.append(t[1:])
        return A.Var(t[1:])

    def query(self) -> A.Node:
        while self.word() in ("PREFIX", "BASE"):
            if self.take().upper() == "PREFIX":
                name = self.take()
                if not name.endswith(":") and self.peek() != ":" and ":" not in name:
                    raise SparqlError("PREFIX needs a name")
                self.prefixes[name.rstrip(":")] = self.take()[1:-1]
            else:
                self.take()
        if self.word() in ("ASK", "CONSTRUCT", "DESCRIBE"):
            raise SparqlError(f"{self.word()} is outside the subset")
        self.take("SELECT")
        distinct = False
        if self.word() in ("DISTINCT", "REDUCED"):
            distinct = self.take().upper() == "DISTINCT"
        shown: list | None = []
        counts = []
        if self.peek() == "*":
            self.take()
            shown = None
        else:
            while self.peek() and self.peek()[0] in "?$(":
                if self.peek() == "(":
                    self.take()
                    agg = self.take().upper()
                    self.take("(")
                    arg = None if self.peek() == "*" else self.var()
                    if arg is None:
                        self.take()
                    self.take(")")
                    self.take("AS")
                    out = self.var()
                    self.take(")")
                    counts.append((agg, arg, out))
                    shown.append(out)
                else:
                    shown.append(self.var())
            if not shown:
                raise SparqlError("SELECT needs variables")
        if self.word() == "WHERE":
            self.take()
        before = list(self.seen) if shown is not None else []
        body = self.group()
        if shown is None:
            shown = [A.Var(n) for n in self.seen if n not in before]
        keys: list = []
        if self.word() == "GROUP":
            self.take()
            self.take("BY")
            while self.peek()[:1] in ("?", "$"):
                keys.append(self.var())
        if counts:
            body = self.grouped(body, keys, counts)
        order = []
        if self.word() == "ORDER":
            self.take()
            self.take("BY")
            while self.word() in ("ASC", "DESC") or self.peek()[:1] in ("?", "$"):
                if self.word() in ("ASC", "DESC"):
                    way = self.take().lower()
                    self.take("(")
                    order.append((self.var(), way))
                    self.take(")")
                else:
                    order.append((self.var(), "asc"))
        limit = offset = None
        while self.word() in ("LIMIT", "OFFSET"):
            if self.take().upper() == "LIMIT":
                limit = int(self.take())
            else:
                offset = int(self.take())
        if self.at < len(self.tokens):
            raise SparqlError(f"{self.peek()} is outside the subset")
        out = body
        hidden = [v for v, _ in order if v not in shown]
        if order and not hidden:
            out = A.OrderBy(order, A.Select(shown, out))
            if distinct:
                out = A.OrderBy(order, A.Distinct(shown, A.Select(shown, body)))
        elif order:
            out = A.Select(shown, A.OrderBy(order, out))
            if distinct:  # an order by what isn't shown has no one place for a repeated row: the first one's
                out = A.FirstDistinct(shown, order, body)
        else:
            out = A.Select(shown, out)
            if distinct:
                out = A.Distinct(shown, out)
        if offset is not None:
            out = A.Start(offset, out)
        if limit is not None:
            out = A.Limit(limit, out)
        return out

    def grouped(self, body, keys, counts):
        goals = []
        for agg, arg, out in counts:
            self.fresh += 1
            bag = A.Var(f"_g{self.fresh}")
            if agg == "COUNT":  # of a variable, unbound values don't count
                goals.append(A.CountBound(arg, keys, out, body))
                continue
            kind = {"SUM": A.Sum, "MIN": A.RangeMin, "MAX": A.RangeMax}.get(agg)
            if kind is None:
                raise SparqlError(f"{agg} is outside the subset")
            goals += [A.GroupBy(arg, keys, bag, body), kind(bag, out)]
        return A.And(*goals)

    def group(self) -> A.Node:
        self.take("{")
        goals: list = []
        filters: list = []
        while self.peek() != "}":
            w = self.word()
            if w == "OPTIONAL":
                self.take()
                goals.append(A.Optional(self.group()))
            elif w == "FILTER":
                self.take()
                filters.append(self.filter())
            elif w == "MINUS":
                self.take()
                gone = self.group()
                # a group that shares no variable with what stands before it takes nothing away
                if A.variables(gone) & set().union(*map(A.variables, goals)):
                    goals.append(A.Not(gone))
            elif w == "BIND":
                self.take()
                self.take("(")
                value = self.term()
                self.take("AS")
                goals.append(A.Equals(value, self.var()))
                self.take(")")
            elif w == "VALUES":
                self.take()
                x = self.var()
                self.take("{")
                values = []
                while self.peek() != "}":
                    values.append(self.term())
                self.take("}")
                goals.append(A.Or(*[A.Equals(x, y) for y in values]) if any(isinstance(y, A.Iri) for y in values) else A.Member(x, values))
            elif w in ("GRAPH", "SERVICE", "SELECT"):
                raise SparqlError(f"{w} is outside the subset")
            elif self.peek() == "{":
                parts = [self.group()]
                while self.word() == "UNION":
                    self.take()
                    parts.append(self.group())
                goals.append(A.Or(*parts) if len(parts) > 1 else parts[0])
            else:
                goals += self.triples()
            if self.peek() == ".":
                self.take()
        self.take("}")
        return A.And(*goals, *filters)

    def triples(self) -> list:
        out = []
        s = self.term()
        while True:
            pattern = self.path()
            while True:
                o = self.term()
                if isinstance(pattern, A.Pattern):
                    out.append(A.Path(s, pattern, o))
                elif pattern == "rdf:type":
                    out.append(A.IsA(s, o.text if isinstance(o, A.Iri) else o))
                else:
                    out.append(A.Triple(s, pattern, o))
                if self.peek() != ",":
                    break
                self.take()
            if self.peek() != ";":
                return out
            self.take()
            if self.peek() in _STOP:
                return out

    def path(self):
        if self.peek()[:1] in ("?", "$"):
            return self.var()
        if self.peek() == "a":
            self.take()
            return "rdf:type"
        got = self.alternatives()
        return got.name if isinstance(got, A.Pred) else got

    def alternatives(self):
        parts = [self.steps()]
        while self.peek() == "|":
            self.take()
            parts.append(self.steps())
        return parts[0] if len(parts) == 1 else A.Alt(parts)

    def steps(self):
        parts = [self.step()]
        while self.peek() == "/":
            self.take()
            parts.append(self.step())
        return parts[0] if len(parts) == 1 else A.Seq(parts)

    def step(self):
        if self.peek() == "^":
            self.take()
            inner = self.step()
            return A.Inverse(inner.name)
        if self.peek() == "(":
            self.take()
            out = self.alternatives()
            self.take(")")
        else:
            t = self.term()
            if not isinstance(t, A.Iri):
                raise SparqlError("a property expected")
            out = A.Pred(t.text)
        while self.peek() in ("*", "+", "?"):
            out = {"*": A.Star, "+": A.Plus}.get(self.peek(), lambda x: A.Times(x, 0, 1))(out)
            self.take()
        return out

    def term(self):
        t = self.peek()
        if t[:1] in ("?", "$"):
            return self.var()
        self.take()
        if t[0] == "<":
            return A.Iri(re.sub(r"^.*[#]|^\w+:///(?:data/)?|^https?://[^/]+/(?=[A-Z]\w*/)|^https?://.*/", "", t[1:-1]))
        if t[0] in "\"'":
            m = re.match(r"([\"'])((?:[^\\]|\\.)*?)\1(?:\^\^(.*)|@.*)?$", t, re.S)
            text = m[2].encode().decode("unicode_escape").encode("latin-1", "ignore").decode("utf-8", "ignore") if "\\" in m[2] else m[2]
            kind = (m[3] or "").strip("<>").rpartition("#")[2].rpartition(":")[2]
            if kind == "dateTime":
                return datetime.datetime.fromisoformat(text.rstrip("Z"))
            if kind == "date":
                return datetime.date.fromisoformat(text)
            if kind in ("integer", "int", "long"):
                return int(text)
            if kind == "decimal":
                return Decimal(text)
            if kind in ("double", "float"):
                return float(text)
            return text
        if re.fullmatch(r"[+-]?\d+", t):
            return int(t)
        if re.fullmatch(r"[+-]?\d+\.\d+(?:[eE][+-]?\d+)?", t):
            return float(t)
        if t.lower() in ("true", "false"):
            return t.lower() == "true"
        if ":" in t:
            prefix, _, local = t.partition(":")
            if prefix in ("rdf", "xsd", "rdfs") and local == "type":
                return A.Iri("rdf:type")
            return A.Iri(local)
        raise SparqlError(f"{t} is outside the subset")

    def filter(self) -> A.Node:
        if self.word() == "NOT" or self.word() == "EXISTS":
            neg = self.word() == "NOT"
            if neg:
                self.take()
            self.take("EXISTS")
            g = self.group()
            return A.Not(g) if neg else A.Not(A.Not(g))
        if self.word() in ("REGEX", "CONTAINS", "STRSTARTS", "STRENDS", "SAMETERM"):
            return self.call()
        self.take("(")
        out = self.disjunction()
        self.take(")")
        return out

    def call(self):
        name = self.take().upper()
        self.take("(")
        a = self.term()
        self.take(",")
        b = self.term()
        self.take(")")
        return {"REGEX": lambda: A.Regexp(b, a), "CONTAINS": lambda: A.Contains(a, b), "STRSTARTS": lambda: A.StartsWith(a, b), "STRENDS": lambda: A.EndsWith(a, b), "SAMETERM": lambda: A.Equals(a, b)}[name]()

    def disjunction(self):
        parts = [self.conjunction()]
        while self.peek() == "||":
            self.take()
            parts.append(self.conjunction())
        # alternatives on one row hold once, however many are true
        return parts[0] if len(parts) == 1 else A.Not(A.And(*[A.Not(p) for p in parts]))

    def conjunction(self):
        parts = [self.unary()]
        while self.peek() == "&&":
            self.take()
            parts.append(self.unary())
        return parts[0] if len(parts) == 1 else A.And(*parts)

    def unary(self):
        if self.peek() == "!":
            self.take()
            return A.Not(self.unary())
        if self.peek() == "(":
            self.take()
            out = self.disjunction()
            self.take(")")
            return out
        if self.word() in ("REGEX", "CONTAINS", "STRSTARTS", "STRENDS", "SAMETERM"):
            return self.call()
        a = self.term()
        op = self.peek()
        if op not in ("=", "!=", "<", "<=", ">", ">="):
            raise SparqlError("a bare term is no filter")
        self.take()
        b = self.term()
        return {"=": A.Equals, "<": A.Less, "<=": A.Lte, ">": A.Greater, ">=": A.Gte}[op](a, b) if op != "!=" else A.NotEquals(a, b)


def compile_sparql(text: str) -> A.Node:
    return _Parser(text).query()
