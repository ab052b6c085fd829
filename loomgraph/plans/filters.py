"""Typed filters, ordering and relation loading on the rows of a class."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import algebra as A
from .catalog import CatalogError
from .lower import Frame, Info

_OPS: dict[str, Callable[[Column, Any], Column]] = {
    "eq": lambda c, x: c == x, "ne": lambda c, x: c != x, "lt": lambda c, x: c < x, "le": lambda c, x: c <= x, "gt": lambda c, x: c > x, "ge": lambda c, x: c >= x,
    "regex": lambda c, x: c.rlike(x), "startsWith": lambda c, x: c.startswith(x),
    "allOfTerms": lambda c, xs: _all(c.contains(x) for x in xs), "anyOfTerms": lambda c, xs: _any(c.contains(x) for x in xs),
}
_TEXT = {"regex", "startsWith", "allOfTerms", "anyOfTerms"}


def _all(parts) -> Column:
    out = F.lit(True)
    for p in parts:
        out = out & p
    return out


def _any(parts) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | p
    return out


def _tests(test: dict) -> Callable[[Column], Column]:
    return lambda e: _all(_OPS[o](e, y) for o, y in test.items())


@dataclass(frozen=True)
class Relation:
    """name of the result; forward: a link of the class; reverse: (class, its link to us)."""

    name: str
    field: str
    of: str | None = None
    where: dict | None = None
    order: tuple = ()
    limit: int | None = None
    offset: int = 0
    nested: tuple = ()


@dataclass(frozen=True)
class Model:
    """query(...) and friends return new models; frame() gives the rows, lazily."""

    session: Any
    cls: str
    where: dict | None = None
    order: tuple = ()
    most: int | None = None
    skip: int = 0
    relations: tuple = ()

    def query(self, where: dict) -> Model:
        return replace(self, where={"_and": [self.where, where]} if self.where else where)

    def ordered(self, *keys: str) -> Model:
        """'name' ascending, '-name' descending."""
        return replace(self, order=keys)

    def limit(self, n: int) -> Model:
        return replace(self, most=n)

    def offset(self, n: int) -> Model:
        return replace(self, skip=n)

    def find(self, iri: str) -> Model:
        return self.query({"_id": iri})

    def find_all(self, iris: list[str]) -> Model:
        return self.query({"_ids": iris})

    def with_field(self, field: str, **more) -> Model:
        return replace(self, relations=(*self.relations, Relation(more.pop("name", field), field, **more)))

    def with_via(self, cls: str, field: str, **more) -> Model:
        return replace(self, relations=(*self.relations, Relation(more.pop("name", f"_{field}_of_{cls}"), field, cls, **more)))

    # -- rows -----------------------------------------------------------------------------------
    def _base(self, cls: str) -> DataFrame:
        c = self.session.catalog
        d = c.get(cls)
        return d.frame().select(d.raw_key().alias("_key"), *[F.col(p.column).alias(p.name) for p in c.properties(cls).values()])

    def _filter(self, df: DataFrame, cls: str, where: dict | None) -> DataFrame:
        """Links filter by a semi join; the rest is one predicate."""
        if not where:
            return df
        c, low = self.session.catalog, self.session.lowerer()
        props = c.properties(cls)
        for name, test in where.items():
            if name == "_and":
                for w in test:
                    df = self._filter(df, cls, w)
            elif name in ("_or", "_not"):
                parts = test if name == "_or" else [test]
                if any(self._joins(cls, w) for w in parts):
                    kept = None
                    for w in parts:
                        k = self._filter(df, cls, w).select("_key")
                        kept = k if kept is None else kept.unionByName(k)
                    df = df.join(kept.distinct(), "_key", "left_semi" if name == "_or" else "left_anti")
                else:
                    cond = _any(F.coalesce(self._column(cls, w), F.lit(False)) for w in parts)
                    df = df.filter(cond if name == "_or" else ~cond)
            elif name == "_id":
                df = df.filter(F.col("_key") == low.key_literal(test, cls))
            elif name == "_ids":
                df = df.filter(F.col("_key").isin(*[low.key_literal(x, cls) for x in test]))
            elif name not in props:
                raise CatalogError(f"{cls} has no {name}")
            elif props[name].link and not set(test) <= set(_OPS):
                target = self._filter(self._base(props[name].link), props[name].link, test).select(F.col("_key").alias("_t"))
                df = df.join(target, df[name] == F.col("_t"), "left_semi")
            else:
                df = df.filter(self._one(props[name], test))
        return df

    def _joins(self, cls: str, where: dict) -> bool:
        props = self.session.catalog.properties(cls)
        return any((k in props and props[k].link and not set(t) <= set(_OPS)) or (k in ("_and", "_or") and any(self._joins(cls, w) for w in t)) or (k == "_not" and self._joins(cls, t)) for k, t in where.items())

    def _column(self, cls: str, where: dict) -> Column:
        props, low, out = self.session.catalog.properties(cls), self.session.lowerer(), F.lit(True)
        for name, test in where.items():
            if name == "_and":
                out = out & _all(self._column(cls, w) for w in test)
            elif name == "_or":
                out = out & _any(F.coalesce(self._column(cls, w), F.lit(False)) for w in test)
            elif name == "_not":
                out = out & ~F.coalesce(self._column(cls, test), F.lit(False))
            elif name in ("_id", "_ids"):
                out = out & F.col("_key").isin(*[low.key_literal(x, cls) for x in ([test] if name == "_id" else test)])
            elif name not in props:
                raise CatalogError(f"{cls} has no {name}")
            else:
                out = out & self._one(props[name], test)
        return out

    def _one(self, prop, test: dict) -> Column:
        c, out = F.col(prop.name), F.lit(True)
        low = self.session.lowerer()
        for op, x in test.items():
            if op in ("someHave", "allHave"):
                some = F.exists if op == "someHave" else F.forall
                out = out & some(c, _tests(x))
                continue
            if op not in _OPS or (op in _TEXT and prop.xsd != "string") or (prop.xsd == "boolean" and op not in ("eq", "ne")):
                raise CatalogError(f"{op} doesn't fit {prop.name}")
            if prop.link:
                x = low.key_literal(x, prop.link)
            out = out & (F.exists(c, _tests({op: x})) if prop.many else _OPS[op](c, x))
        return out

    def _sorted(self, df: DataFrame, order, cls: str) -> list[Column]:
        return [F.col(k[1:]).desc_nulls_last() if k[0] == "-" else F.col(k).asc_nulls_first() for k in order]

    def keyed(self) -> DataFrame:
        df = self._filter(self._base(self.cls), self.cls, self.where)
        if self.order:
            df = df.orderBy(*self._sorted(df, self.order, self.cls), F.col("_key"))
        if self.skip:
            df = df.offset(self.skip)
        if self.most is not None:
            df = df.limit(self.most)
        for r in self.relations:
            df = self._load(df, self.cls, r)
        return df

    def _load(self, df: DataFrame, cls: str, r: Relation) -> DataFrame:
        """Adds the related documents as an array of structs, each parent's own top rows: one join."""
        c = self.session.catalog
        low = self.session.lowerer()
        target = r.of or c.properties(cls)[r.field].link
        if not target:
            raise CatalogError(f"{cls}.{r.field} is no link")
        rows = self._filter(self._base(target), target, r.where)
        for n in r.nested:
            rows = self._load(rows, target, n)
        if r.of:
            rows = rows.withColumn("_parent", F.col(r.field))
        else:
            p = c.properties(cls)[r.field]
            ref = df.select(F.col("_key").alias("_parent"), (F.explode(F.col(r.field)) if p.many else F.col(r.field)).alias("_ref"))
            rows = ref.join(rows, F.col("_ref") == F.col("_key")).drop("_ref")
        keys = [*self._sorted(rows, r.order, target), F.col("_key")]
        if r.limit is not None or r.offset:
            n = F.row_number().over(Window.partitionBy("_parent").orderBy(*keys))
            rows = rows.withColumn("_n", n).filter((F.col("_n") > r.offset) & (F.col("_n") <= r.offset + (r.limit if r.limit is not None else 2**31 - 1)))
        else:
            rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("_parent").orderBy(*keys)))
        links = {p.name: p.link for p in c.properties(target).values() if p.link and not p.many}
        doc = F.struct(F.col("_n"), low.iri(F.col("_key"), target).alias("id"), *[(low.iri(F.col(x), links[x]) if x in links else F.col(x)).alias(x) for x in rows.columns if x not in ("_key", "_parent", "_n")])
        related = rows.groupBy("_parent").agg(F.sort_array(F.collect_list(doc)).alias(r.name))
        joined = df.withColumnRenamed(r.name, f"{r.name}_iri") if r.name in df.columns and r.of is None else df
        out = joined.join(related, F.col("_key") == F.col("_parent"), "left").drop("_parent")
        return out

    def frame(self) -> DataFrame:
        c, low = self.session.catalog, self.session.lowerer()
        df = self.keyed()
        links = {p.name: p.link for p in c.properties(self.cls).values() if p.link and not p.many}
        return df.select(low.iri(F.col("_key"), self.cls).alias("id"), *[(low.iri(F.col(x), links[x]) if x in links and dict(df.dtypes)[x][:5] != "array" else F.col(x)).alias(x) for x in df.columns if x != "_key"])

    all = frame

    def count(self) -> int:
        return self._filter(self._base(self.cls), self.cls, self.where).count()

    def ids(self) -> DataFrame:
        return self.frame().select("id")

    def path_to(self, cls: str, path: str, where: dict | None = None) -> DataFrame:
        """id, target: documents of a class (that pass a filter) at the end of a regular path from each document."""
        a, b = A.Var("id"), A.Var("target")
        starts = self.keyed().select("_key")
        low = self.session.lowerer()
        ids = starts.select(low.iri(F.col("_key"), self.cls).alias("id"))
        f = low.lower(A.Path(a, path, b), Frame(ids, {"id": Info("node", among=frozenset([self.cls]))}))
        ends = self._filter(self._base(cls), cls, where).select(low.iri(F.col("_key"), cls).alias("target"))
        return f.df.select("id", "target").join(ends, "target", "left_semi").select("id", "target")

    def grouped_by(self, field: str) -> DataFrame:
        return self.frame().groupBy(field).agg(F.sort_array(F.collect_list("id")).alias("ids"), F.count("*").alias("n"))

    def values(self, field: str) -> DataFrame:
        return self.frame().select(field).distinct()


def together(*models: Model, **named: Model) -> dict[str, DataFrame]:
    """Several queries whose parts are got by name, or by class; a second one of a class is Class_2 and so on."""
    out: dict[str, DataFrame] = {}
    for m in models:
        n, name = 1, m.cls
        while name in out:
            n += 1
            name = f"{m.cls}_{n}"
        out[name] = m.frame()
    return out | {k: m.frame() for k, m in named.items()}


def count_by_class(session) -> DataFrame:
    out = None
    for k, d in session.catalog.classes.items():
        if d.frame and not d.abstract:
            df = d.frame().agg(F.lit(k).alias("cls"), F.count("*").alias("n"))
            out = df if out is None else out.unionByName(df)
    return out
