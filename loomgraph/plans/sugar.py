"""Short names and compositions over the algebra: aliases, dates of today, edges in a graph, fluent subjects."""

from __future__ import annotations

import datetime
import itertools
from typing import Any

from . import algebra as A

gt, lt, gte, lte, eq = A.Greater, A.Less, A.Gte, A.Lte, A.Equals
after, before, in_between = A.Greater, A.Less, A.Between
substr, re, cast, opt, option, sub = A.Substring, A.Regexp, A.Typecast, A.Optional, A.Optional, A.Subsumption
t = triple = A.Triple
value, link, isa, count = A.Data, A.Link, A.IsA, A.Count
unique, idgen, idgen_random = A.HashKey, A.LexicalKey, A.RandomKey
time_interval = date_interval = A.Interval

_fresh = itertools.count()


def _now(now: datetime.datetime | None) -> datetime.datetime:
    return now or datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)


def today(x: Any, now: datetime.datetime | None = None) -> A.Node:
    """x is the time of planning (or `now`), as a dateTime in UTC."""
    return A.Equals(x, _now(now))


timestamp_now = today


def today_in_between(start: Any, end: Any, now: datetime.datetime | None = None) -> A.Node:
    """The time of planning (or `now`) is from start to end, both included."""
    return A.And(A.Lte(start, _now(now)), A.Gte(end, _now(now)))


def date_add(start: Any, duration: Any, end: Any) -> A.Node:
    return A.DateDuration(start, duration, end)


def date_subtract(end: Any, duration: Any, start: Any) -> A.Node:
    return A.DateDuration(start, duration, end)


datetime_add, datetime_subtract = date_add, date_subtract


def type_(x: Any, cls: Any) -> A.Node:
    return A.IsA(x, cls)


def prop(x: Any, name: str, y: Any) -> A.Node:
    return A.Triple(x, name, y)


def compare(a: Any, op: str, b: Any) -> A.Node:
    """compare(x, ">=", 3)"""
    return {"<": A.Less, ">": A.Greater, "<=": A.Lte, ">=": A.Gte, "=": A.Equals, "==": A.Equals, "!=": A.NotEquals}[op](a, b)


def star(s: Any = None, p: Any = None, o: Any = None, graph: str | None = None) -> A.Node:
    """A triple whose missing places are variables Subject, Predicate and Object."""
    return A.Triple(s or A.Var("Subject"), p or A.Var("Predicate"), o or A.Var("Object"), graph)


all_ = star


def quad(s: Any, p: Any, o: Any, graph: str) -> A.Node:
    return A.Triple(s, p, o, graph)


def add_quad(s: Any, p: Any, o: Any, graph: str) -> A.Node:
    return A.AddTriple(s, p, o, graph)


def delete_quad(s: Any, p: Any, o: Any, graph: str) -> A.Node:
    return A.DeleteTriple(s, p, o, graph)


def added_quad(s: Any, p: Any, o: Any, graph: str) -> A.Node:
    return A.AddedTriple(s, p, o, graph)


def removed_quad(s: Any, p: Any, o: Any, graph: str) -> A.Node:
    return A.DeletedTriple(s, p, o, graph)


def quad_slice(s: Any, p: Any, o: Any, low: Any, high: Any, graph: str) -> A.Node:
    return A.TripleSlice(s, p, o, low, high, graph)


def quad_slice_rev(s: Any, p: Any, o: Any, low: Any, high: Any, graph: str) -> A.Node:
    return A.TripleSliceRev(s, p, o, low, high, graph)


def quad_next(s: Any, p: Any, o: Any, next_: Any, graph: str) -> A.Node:
    return A.TripleNext(s, p, o, next_, graph)


def quad_previous(s: Any, p: Any, o: Any, previous: Any, graph: str) -> A.Node:
    return A.TriplePrevious(s, p, o, previous, graph)


def update_triple(s: Any, p: Any, o: Any, graph: str | None = None) -> A.Node:
    """The value of a single-valued property becomes o (a set takes it in)."""
    return A.AddTriple(s, p, o, graph)


update_quad = update_triple


def vars_unique(names: str) -> Any:
    """Variables that no other query has, named after `names`."""
    n = next(_fresh)
    out = [A.Var(f"{x}__{n}") for x in names.split()]
    return out[0] if len(out) == 1 else out


def localize(body: A.Node, **given: Any) -> A.Node:
    """`body` with its variables its own; `given` names those that are bound from outside or let out."""
    n = next(_fresh)
    names = {x: A.Var(f"{x}__{n}") for x in A.mentioned(body)}
    own = A.renamed(body, names)
    out = sorted(set().union(*(A.mentioned(x) for x in given.values()), set()))
    return A.Select([A.Var(x) for x in out], A.And(*[A.Equals(names[k], x) for k, x in given.items() if k in names and not isinstance(x, A.Var)], A.renamed(own, {names[k].name: x for k, x in given.items() if k in names and isinstance(x, A.Var)})))


def nuke(catalog: Any) -> A.Node:
    """Deletes every document of the instance graph."""
    out = []
    for k, d in catalog.classes.items():
        if d.frame and not d.abstract and not d.subdocument:
            x = vars_unique("doc")
            out.append(A.And(A.IsA(x, k), A.DeleteDocument(x)))
    return A.Or(*out)


class node:
    """A subject, its graph and what is said of it: node(x).graph("instance").has("name", y).isa("Person").goals()."""

    def __init__(self, subject: Any, kind: type = A.Triple):
        self.subject, self.kind, self.of, self.said = subject, kind, None, ()

    def _with(self, **changes: Any) -> node:
        out = node(self.subject, self.kind)
        out.of, out.said = self.of, self.said
        for k, x in changes.items():
            setattr(out, k, x)
        return out

    def graph(self, name: str) -> node:
        return self._with(of=None if name == "instance" else name)

    def has(self, name: Any, x: Any) -> node:
        return self._with(said=(*self.said, self.kind(self.subject, name, x, self.of)))

    def isa(self, cls: Any) -> node:
        return self._with(said=(*self.said, A.IsA(self.subject, cls)))

    def goals(self) -> A.Node:
        return A.And(*self.said)


def insert(cls: str, iri: Any = None, **fields: Any) -> A.Node:
    """A new document of a class."""
    return A.InsertDocument({"@type": cls, **({"@id": iri} if iri is not None else {}), **fields})


def query(*patterns: Any, select: str | None = None) -> A.Node:
    """A conjunction from (subject, class, {property: value}) and goals; strings that begin with ? are variables.

    query(("?p", "Person", {"name": "?n"}), gt(v("n"), "B"), select="n")
    """
    var = lambda x: A.Var(x[1:]) if isinstance(x, str) and x[:1] == "?" else x
    goals = []
    for x in patterns:
        if isinstance(x, tuple):
            s, cls, said = var(x[0]), x[1], x[2] if len(x) > 2 else {}
            goals += [A.IsA(s, cls), *(A.Triple(s, k, var(y)) for k, y in said.items())]
        else:
            goals.append(x)
    body = A.And(*goals)
    return A.Select([A.Var(n) for n in select.split()], body) if select else body
