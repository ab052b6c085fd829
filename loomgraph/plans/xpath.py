"""A subset of XPath location paths: doc("Class/id")/a/@b[c > 1]//d | ..., db("branch/x") heads, whole documents."""

from __future__ import annotations

import re

from . import algebra as A

_TOKEN = re.compile(r"""\s*(//|!=|<=|>=|"[^"]*"|'[^']*'|-?\d+\.\d+|-?\d+|[A-Za-z_][\w.-]*|[/@\[\]()|*=<>,.])""")


class XPathError(ValueError):
    """Text outside the subset."""


class _Parser:
    def __init__(self, text: str):
        self.tokens = _TOKEN.findall(text)
        if "".join(self.tokens) != re.sub(r"\s+(?=(?:[^\"']|\"[^\"]*\"|'[^']*')*$)", "", text.strip()):
            raise XPathError(f"can't read {text}")
        self.at, self.n = 0, 0

    def peek(self, k: int = 0) -> str:
        return self.tokens[self.at + k] if self.at + k < len(self.tokens) else ""

    def take(self, x: str | None = None) -> str:
        got = self.peek()
        if not got or (x and got != x):
            raise XPathError(f"{x or 'more'} expected, not {got or 'the end'}")
        self.at += 1
        return got

    def fresh(self) -> A.Var:
        self.n += 1
        return A.Var(f"_x{self.n}")

    def union(self, out: A.Var) -> A.Node:
        parts = [self.path(out)]
        while self.peek() == "|":
            self.take()
            parts.append(self.path(out))
        if self.peek():
            raise XPathError(f"{self.peek()} is outside the subset")
        return parts[0] if len(parts) == 1 else A.Or(*parts)

    def path(self, out: A.Var) -> A.Node:
        collection, start = None, None
        if self.peek() == "db" and self.peek(1) == "(":
            self.take(), self.take()
            collection = self.take()[1:-1]
            self.take(")")
            if self.peek() == "/" and self.peek(1) in ("doc", "document"):
                self.take()
        if self.peek() in ("doc", "document") and self.peek(1) == "(":
            self.take(), self.take()
            start = A.Iri(self.take()[1:-1])
            self.take(")")
        goals: list = []
        at = start if start is not None else self.fresh()
        if start is None and self.peek() not in ("/", "//"):
            # a bare name: documents of that class
            goals.append(A.IsA(at, self.take()))
            goals += self.predicates(at)
        steps = []
        while self.peek() in ("/", "//"):
            steps.append((self.take(), self.step()))
            to = self.fresh()
            goals += self.hop(at, steps[-1], to)
            goals += self.predicates(to)
            at = to
        if at is start:
            goals.append(A.Equals(start, out))
            body: A.Node = A.And(*goals)
        else:
            body = A.renamed(A.And(*goals), {at.name: out})
        body = A.Distinct([out], A.Select([out], body))
        return A.Using(collection, body) if collection else body

    def step(self) -> str:
        if self.peek() == "@":
            self.take()
        t = self.take()
        if self.peek() == "(" or (not re.match(r"[A-Za-z_*]", t)):
            raise XPathError(f"{t} is outside the subset")
        return t

    def hop(self, at, step, to) -> list:
        axis, name = step
        if axis == "/":
            return [A.Triple(at, self.fresh() if name == "*" else name, to)]
        if name == "*":
            return [A.Path(at, A.Plus(A.Pred(None)), to)]
        mid = self.fresh()
        return [A.Path(at, A.Star(A.Pred(None)), mid), A.Triple(mid, name, to)]

    def predicates(self, at) -> list:
        out = []
        while self.peek() == "[":
            self.take()
            if re.fullmatch(r"-?\d+", self.peek()):
                raise XPathError("positions are outside the subset")
            goals, here = [], at
            while True:
                to = self.fresh()
                goals += self.hop(here, ("/", self.step()), to)
                here = to
                if self.peek() != "/":
                    break
                self.take()
            if self.peek() in ("=", "!=", "<", "<=", ">", ">="):
                op, t = self.take(), self.take()
                value = t[1:-1] if t[0] in "\"'" else float(t) if "." in t else int(t)
                goals.append(A.NotEquals(here, value) if op == "!=" else {"=": A.Equals, "<": A.Less, "<=": A.Lte, ">": A.Greater, ">=": A.Gte}[op](here, value))
            out += goals
            self.take("]")
        return out


def compile_xpath(text: str, documents: bool = False) -> A.Node:
    """A query that binds `result` (and `document`, the whole document as JSON, if asked)."""
    out = A.Var("result")
    q = _Parser(text).union(out)
    return A.And(q, A.ReadDocument(out, A.Var("document"))) if documents else q
