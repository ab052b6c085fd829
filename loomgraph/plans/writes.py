"""Writes in the algebra: reads bind variables, every solution gives a change, all changes are one commit.

Reads see the version before the commit. Writes stand in And, Or, Select, Immediately, Pin, Into and
Using (which names the branch to write). Changes are DataFrame joins on the key of a class; a class that
no write names isn't read or written. The same change from several solutions counts once.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.versions import Delta
from . import algebra as A
from .catalog import CatalogError
from .lower import AnalysisError, Frame, Lowerer, Unbound

ADDS = (A.AddTriple, A.AddLink, A.AddData)
REMOVES = (A.DeleteTriple, A.DeleteLink, A.DeleteData)
DOCUMENTS = (A.InsertDocument, A.UpdateDocument, A.DeleteDocument)
WRAPPERS = (A.Select, A.Distinct, A.Immediately, A.Pin, A.Into, A.Using)


def writes(node: Any) -> bool:
    """Whether a query holds a write."""
    if isinstance(node, ADDS + REMOVES + DOCUMENTS):
        return True
    if isinstance(node, (A.And, A.Or)):
        return any(map(writes, node.goals))
    return isinstance(node, WRAPPERS) and writes(node.query)


def effects(node: Any, reads: tuple, branch: str):
    """(reads, write, branch) for every write of a query."""
    if isinstance(node, ADDS + REMOVES + DOCUMENTS):
        if getattr(node, "graph", None) == "schema":
            raise AnalysisError("the schema is the catalogue: change it there")
        yield reads, node, branch
    elif isinstance(node, A.And):
        reads += tuple(g for g in node.goals if not writes(g))
        for g in filter(writes, node.goals):
            yield from effects(g, reads, branch)
    elif isinstance(node, A.Or):
        for g in filter(writes, node.goals):
            yield from effects(g, reads, branch)
    elif isinstance(node, A.Using):
        kind, _, name = node.collection.rpartition("/")
        if kind.rpartition("/")[2] == "commit":
            raise AnalysisError("a commit can't be written: name a branch")
        yield from effects(node.query, reads, name)
    elif isinstance(node, A.Into) and node.graph == "schema":
        raise AnalysisError("the schema is the catalogue: change it there")
    else:
        yield from effects(node.query, reads, branch)


class Writer:
    def __init__(self, low: Lowerer, store: Any, branch: str):
        self.low, self.store, self.branch = low, store, branch
        self.base = store.base(branch)
        self.head = self.base[1]
        self.state: dict[str, Delta] = {}

    def rows(self, cls: str) -> DataFrame:
        old = self.store.read(cls, self.head)
        return self.store.applied(cls, self.state[cls], old) if cls in self.state else old

    def change(self, cls: str, delta: Delta) -> None:
        self.state[cls] = self.store.then(cls, self.state.get(cls), delta)

    def apply(self, reads: tuple, node: Any) -> None:
        f = self.low.one(self.low.lower(A.And(*reads)) if reads else Frame(None, {}))
        try:
            if isinstance(node, A.DeleteDocument):
                cls, key = self.subject(node.identifier, f)
                for k, delta in self.store.without(cls, f.df.select(key.alias("key")).distinct(), self.rows).items():
                    self.change(k, delta)
            elif isinstance(node, DOCUMENTS):
                self.document(node, f)
            else:
                cls, key = self.subject(node.subject, f)
                p = self.property(cls, node)
                pairs = f.df.select(key.alias("key"), self.node_value(node.object, f, p.link).alias("value")).distinct()
                self.change(cls, self.store.with_values(cls, p, pairs, self.rows(cls), isinstance(node, REMOVES)))
        except Unbound as e:
            raise AnalysisError(f"nothing binds ?{e} in {A.text_of(node)}") from None

    def subject(self, x: Any, f: Frame) -> tuple[str, Column]:
        if isinstance(x, A.Var):
            column = self.low.value(x, f)
            if not f.info[x.name].cls:
                raise AnalysisError(f"?{x.name} is no document of one class")
            return f.info[x.name].cls, column
        text = x.text if isinstance(x, A.Iri) else str(x)
        cls = text.split("/")[0]
        self.low.catalog.get(cls)
        return cls, self.low.key_literal(text, cls)

    def property(self, cls: str, node: Any):
        name = node.predicate.text if isinstance(node.predicate, A.Iri) else node.predicate
        p = self.low.catalog.properties(cls).get(name)
        if p is None:
            raise CatalogError(f"{cls} has no property {name}")
        if isinstance(node, (A.AddLink, A.DeleteLink)) and not p.link or isinstance(node, (A.AddData, A.DeleteData)) and p.link:
            raise CatalogError(f"{cls}.{name} is {'a link' if p.link else 'no link'}")
        if p.column in self.low.catalog.get(cls).key:
            raise CatalogError(f"{cls}.{name} is part of the key: insert and delete documents")
        return p

    def node_value(self, x: Any, f: Frame, link: str | None) -> Column:
        """A value; of a link the key of the linked document."""
        if link is None:
            return self.low.value(x, f)
        if isinstance(x, (list, tuple)):
            return F.array(*[self.node_value(y, f, link) for y in x])
        if isinstance(x, A.Var):
            return self.low.value(x, f)
        return self.low.key_literal(x.text if isinstance(x, A.Iri) else str(x), link)

    def document(self, node: Any, f: Frame) -> None:
        x = node.document
        if isinstance(x, A.Var):
            raise AnalysisError("a document to write is a template: its class must be known")
        given = dict(x.fields if isinstance(x, A.Dict) else x)
        cls, at = given.pop("@type", None), given.pop("@id", node.identifier)
        if cls is None:
            raise AnalysisError("a document needs an @type")
        d, properties, old = self.low.catalog.get(cls), self.low.catalog.properties(cls), self.rows(cls)
        cells = {}
        for name, value in given.items():
            if name not in properties:
                raise CatalogError(f"{cls} has no property {name}")
            cells[properties[name].column] = self.node_value(value, f, properties[name].link)
        if at is not None and not (isinstance(at, A.Var) and at.name not in f.info) and len(d.key) == 1:
            of, cells[d.key[0]] = self.subject(at, f)
            if of != cls:
                raise CatalogError(f"{A.text_of(at)} is no {cls}")
        short = [k for k in d.key if k not in cells]
        if short:
            raise CatalogError(f"a {cls} needs its key: {', '.join(short)}")
        new = f.df.select(*[cells.get(c.name, F.lit(None)).cast(c.dataType).alias(c.name) for c in old.schema]).distinct()
        wrong = self.low.catalog.with_frames({cls: lambda: new}).check(cls).filter(F.size("errors") > 0).select("errors").head()
        if wrong:
            raise CatalogError(f"{cls}: {', '.join(wrong.errors)}")
        if new.groupBy(*d.key).count().filter("count > 1").head():
            raise CatalogError(f"several documents for one key of {cls}")
        if isinstance(node, A.InsertDocument):
            if new.join(old.select(*d.key), list(d.key), "left_semi").head():
                raise CatalogError(f"a {cls} of that key is there: update it")
        self.change(cls, Delta(new))

    def commit(self, **note) -> str:
        return self.store.write(self.state, self.branch, base=self.base, **note)

