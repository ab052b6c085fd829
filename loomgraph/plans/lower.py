"""From the algebra to DataFrames.

A binding frame has a column for each variable; unbound is null. A node variable whose class is known
holds the raw key of that class, so joins run on keys and triples of one subject are one scan; it turns
into an IRI when classes differ or a result is shown. Goals run left to right, but a goal whose inputs
aren't bound waits, and scans that share a variable with the frame go before those that don't.
"""

from __future__ import annotations

import datetime
import decimal
import itertools
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lists, temporal, text
from ..operators import paths
from . import algebra as A
from .catalog import Catalog, ClassDef, spark_type, xsd_type


class Unbound(Exception):
    """A goal whose inputs aren't bound (yet)."""


class AnalysisError(ValueError):
    """A query that can't be planned."""


@dataclass(frozen=True)
class Info:
    kind: str = "lit"  # node, lit or list
    cls: str | None = None  # a node of this class, as its raw key
    maybe: bool = False  # may be unbound
    among: frozenset | None = None  # a node of one of these classes, as its IRI


@dataclass
class Frame:
    """df is None for the one empty solution."""

    df: DataFrame | None
    info: dict[str, Info]

    def only(self, names) -> Frame:
        names = [n for n in self.info if n in names]
        return Frame(self.df.select(*names) if self.df is not None else None, {n: self.info[n] for n in names})


_fresh = itertools.count()
_PATTERNS = (A.Triple, A.Link, A.Data)
_TESTS = {A.Less: lambda a, b: a < b, A.Greater: lambda a, b: a > b, A.Lte: lambda a, b: a <= b, A.Gte: lambda a, b: a >= b}


class Lowerer:
    def __init__(self, spark: SparkSession, catalog: Catalog, named: dict[str, A.Node] | None = None, store: Any = None, graph: str = "instance", commit: str | None = None):
        self.spark, self.catalog, self.named, self.store, self.graph, self.commit = spark, catalog, named or {}, store, graph, commit
        self.dry = False  # only asks which variables a query binds: closures and recursion run nothing

    # -- values ---------------------------------------------------------------------------------
    def one(self, f: Frame) -> Frame:
        return f if f.df is not None else Frame(self.spark.range(1).select(F.lit(1).alias("_one")), {})

    def bound(self, x: Any, f: Frame) -> bool:
        return not isinstance(x, A.Var) or x.name in f.info

    def value(self, x: Any, f: Frame, like: Info | None = None) -> Column:
        if isinstance(x, A.Var):
            if x.name not in f.info:
                raise Unbound(x.name)
            return F.col(x.name)
        if isinstance(x, A.Iri):
            return self.key_literal(x.text, like.cls) if like and like.cls else F.lit(x.text)
        if isinstance(x, A.Expression):
            return self.number(x, f)
        if isinstance(x, A.Dict):
            return F.struct(*[self.value(y, f).alias(n) for n, y in x.fields])
        if isinstance(x, (list, tuple)):
            return F.array(*[self.value(y, f) for y in x])
        if isinstance(x, datetime.datetime):
            return F.lit(x.isoformat(sep=" ")).cast("timestamp" if x.tzinfo else "timestamp_ntz")
        if isinstance(x, datetime.date):
            return F.lit(x)
        if isinstance(x, decimal.Decimal):
            return F.lit(str(x)).cast("decimal(38,20)")
        return F.lit(x)

    def dtype(self, c: Column, f: Frame) -> T.DataType:
        return self.one(f).df.select(c.alias("x")).schema[0].dataType

    def day(self, x: Any, f: Frame) -> Column:
        return self.value(x, f).cast("date")

    def when(self, x: Any, f: Frame) -> tuple[Column, bool]:
        """(date or date-time column, whether it has a time)."""
        c = self.value(x, f)
        t = self.dtype(c, f)
        if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            return c, True
        if isinstance(t, T.StringType) and isinstance(x, str) and "T" in x:
            return c.cast("timestamp_ntz"), True
        return (c, False) if isinstance(t, T.NumericType) else (c.cast("date"), False)

    def key_literal(self, iri: str, cls: str) -> Column:
        d = self.catalog.get(cls)
        prefix = f"{cls}/"
        raw = iri.removeprefix(prefix)
        if len(d.key) == 1 and d.key[0] == "iri":
            return F.lit(iri)
        if raw == iri:
            return F.lit(None).cast(self.key_type(d))
        return F.lit(raw).cast(self.key_type(d))

    def key_type(self, d: ClassDef) -> T.DataType:
        return d.frame().schema[d.key[0]].dataType if len(d.key) == 1 else T.StringType()

    def iri(self, c: Column, cls: str | None) -> Column:
        if cls is None or self.catalog.get(cls).key == ("iri",):
            return c.cast("string")
        return F.concat(F.lit(f"{cls}/"), c.cast("string"))

    def iri_of(self, cls: str | None):
        return lambda c: self.iri(c, cls)

    def plain(self, f: Frame, names) -> Frame:
        """The frame with these node variables as IRIs."""
        todo = [n for n in names if n in f.info and f.info[n].cls]
        if not todo:
            return f
        df = f.df.withColumns({n: self.iri(F.col(n), f.info[n].cls) for n in todo})
        return Frame(df, {n: replace(i, cls=None, among=frozenset([i.cls])) if n in todo else i for n, i in f.info.items()})

    # -- joining --------------------------------------------------------------------------------
    def join(self, left: Frame, right: Frame, how: str = "inner") -> Frame:
        if left.df is None and how == "inner":
            return right
        left = self.one(left)
        if right.df is None:
            return left
        shared = [n for n in left.info if n in right.info]
        differ = [n for n in shared if left.info[n].cls != right.info[n].cls]
        left, right = self.plain(left, differ), self.plain(right, differ)
        # a maybe-bound variable is an equi-join all the same: a null meets a copy of every row of the other side
        outer = [n for n in shared if right.info[n].maybe and how != "inner"]
        marked = [n for n in shared if (left.info[n].maybe or right.info[n].maybe) and n not in outer]
        l, r = left.df, right.df.select(*[F.col(n).alias(f"_r_{n}") for n in right.info])
        for n in marked:
            a, b = F.col(n), F.col(f"_r_{n}")
            at, bt = l.schema[n].dataType, r.schema[f"_r_{n}"].dataType
            key = lambda k, c, t: F.struct(F.lit(k).alias("k"), (F.lit(None).cast(t) if c is None else c).alias("v"))
            # keys: 1 and the value; 0 where the left is unbound (every right row has it); 2 where the right one is (every bound left row has it)
            mine = F.when(a.isNull(), F.array(key(0, None, at))).otherwise(F.array(key(1, a, at), key(2, None, at)) if right.info[n].maybe else F.array(key(1, a, at)))
            theirs = F.array(key(1, b, bt), key(0, None, bt)) if left.info[n].maybe else F.array(key(1, b, bt))
            if right.info[n].maybe:
                theirs = F.when(b.isNull(), F.array(key(0, None, bt), key(2, None, bt)) if left.info[n].maybe else F.array(key(2, None, bt))).otherwise(theirs)
            l = l.withColumn(f"_k_{n}", F.explode(mine) if right.info[n].maybe else mine[0])
            r = r.withColumn(f"_q_{n}", F.explode(theirs))
        l = l.alias("_l")
        on = None
        for n in shared:
            a, b = F.col(f"_l.{n}"), F.col(f"_r_{n}")
            if n in marked:
                k, q = F.col(f"_l._k_{n}"), F.col(f"_q_{n}")
                same = (k["k"] == q["k"]) & (k["v"].eqNullSafe(q["v"]))
            else:
                same = a == b
                if n in outer:
                    same = same | b.isNull() | (a.isNull() if left.info[n].maybe else F.lit(False))
            on = same if on is None else on & same
        if on is None:
            joined = l.crossJoin(r) if how == "inner" else l.join(r, F.lit(True), how)
        else:
            joined = l.join(r, on, how)
        if how in ("left_semi", "left_anti"):
            return Frame(joined.select(*[F.col(f"_l.{n}").alias(n) for n in left.info] or [F.col("_l._one").alias("_one")]), left.info)
        columns, info = [], {}
        for n, i in left.info.items():
            c = F.col(f"_l.{n}")
            both = n in right.info
            columns.append((F.coalesce(c, F.col(f"_r_{n}")) if both and i.maybe else c).alias(n))
            info[n] = replace(i, maybe=i.maybe and (not both or right.info[n].maybe or how == "left"))
        for n, i in right.info.items():
            if n not in left.info:
                columns.append(F.col(f"_r_{n}").alias(n))
                info[n] = replace(i, maybe=True) if how == "left" else i
        return Frame(joined.select(*columns) if columns else joined.select(F.lit(1).alias("_one")), info)

    def bind(self, f: Frame, target: Any, c: Column, info: Info = Info(), drop_null: bool = False) -> Frame:
        """target = c: binds a variable, or keeps the rows where it holds."""
        f = self.one(f)
        if isinstance(target, A.Var) and target.name not in f.info:
            df = f.df.withColumn(target.name, c)
            return Frame(df.filter(F.col(target.name).isNotNull()) if drop_null else df, f.info | {target.name: info})
        if isinstance(target, A.Var) and f.info[target.name].maybe:
            old = F.col(target.name)
            df = f.df.filter(old.isNull() | (old == c)).withColumn(target.name, F.coalesce(old, c))
            return Frame(df, f.info | {target.name: replace(f.info[target.name], maybe=False)})
        return Frame(f.df.filter(self.same(c, info, target, f)), f.info)

    def same(self, c: Column, info: Info, target: Any, f: Frame) -> Column:
        if isinstance(target, A.Var):
            other = f.info[target.name]
            if info.cls != other.cls:
                return self.iri(c, info.cls) == self.iri(F.col(target.name), other.cls)
            return c == F.col(target.name)
        return c == self.value(target, f, info)

    def generate(self, f: Frame, target: Any, items: Column, info: Info = Info()) -> Frame:
        """Each element of an array: binds a variable, or tests."""
        f = self.one(f)
        if isinstance(target, A.Var) and target.name not in f.info:
            return Frame(f.df.withColumn(target.name, F.explode(items)), f.info | {target.name: info})
        return Frame(f.df.filter(F.array_contains(items, self.value(target, f))), f.info)

    # -- conjunction ----------------------------------------------------------------------------
    def lower(self, node: A.Node, f: Frame | None = None) -> Frame:
        f = f or Frame(None, {})
        method = getattr(self, f"do_{type(node).__name__}", None)
        if method is None:
            raise AnalysisError(f"{type(node).__name__} is a write: use Session.write")
        return method(node, f)

    def do_And(self, node: A.And, f: Frame) -> Frame:
        goals = self.stars(self.flat(node))
        while goals:
            order = sorted(range(len(goals)), key=lambda k: self.rank(goals[k], f))
            waiting = None
            for k in order:
                try:
                    g = goals[k]
                    if isinstance(g, A.GroupBy):
                        new, used = self.group(g, f, [x for x in goals if x is not g])
                        goals = [x for x in goals if x is not g and x not in used]
                        f = new
                    else:
                        f = self.lower(g, f)
                        goals = goals[:k] + goals[k + 1 :]
                    break
                except Unbound as e:
                    waiting = waiting or e
            else:
                raise AnalysisError(f"nothing binds ?{waiting} in {A.text_of(A.And(*goals))}")
        return f

    def flat(self, node: A.And) -> list:
        out = []
        for g in node.goals:
            out += self.flat(g) if isinstance(g, A.And) else [g]
        return out

    def rank(self, g: A.Node, f: Frame) -> int:
        """Goals that read the frame first, then connected scans, then others; order within is as written."""
        scan = isinstance(g, (*_PATTERNS, Star, A.IsA, A.TripleSlice, A.TripleSliceRev, A.Path, A.TripleNext, A.TriplePrevious))
        if isinstance(g, (A.Optional, A.Not, A.If, A.Once, A.Count, A.Collect)):
            return 2  # after what may bind their variables
        if not scan:
            return 0
        return 0 if f.df is None or A.variables(g) & f.info.keys() else 1

    def stars(self, goals: list) -> list:
        """Triples of one subject variable with one class become one scan."""
        by: dict[str, list] = {}
        for g in goals:
            if isinstance(g, _PATTERNS) and isinstance(g.subject, A.Var) and isinstance(g.predicate, (str, A.Iri)) and g.graph in (None, self.graph) and self.graph == "instance":
                by.setdefault(g.subject.name, []).append(g)
            elif isinstance(g, A.IsA) and isinstance(g.element, A.Var) and isinstance(g.type, (str, A.Iri)) and self.graph == "instance":
                by.setdefault(g.element.name, []).append(g)
        out, done = [], set()
        for g in goals:
            name = next((n for n, gs in by.items() if any(g is x for x in gs)), None)
            if name is None:
                out.append(g)
            elif name not in done:
                done.add(name)
                classes = None
                for x in by[name]:
                    mine = set(self.catalog.concrete(_name(x.type))) if isinstance(x, A.IsA) else set(self.catalog.having(_name(x.predicate)))
                    if isinstance(x, _PATTERNS) and _name(x.predicate) == "rdf:type":
                        mine = set(self.catalog.concrete(_name(x.object))) if isinstance(x.object, (str, A.Iri)) else set(self.catalog.classes)
                    classes = mine if classes is None else classes & mine
                if len(classes or ()) == 1 and not any(isinstance(x, _PATTERNS) and _name(x.predicate) == "rdf:type" and isinstance(x.object, A.Var) for x in by[name]):
                    wanted = tuple((_name(x.predicate), x.object, type(x)) for x in by[name] if isinstance(x, _PATTERNS) and _name(x.predicate) != "rdf:type")
                    out.append(Star(A.Var(name), next(iter(classes)), wanted))
                else:
                    out += by[name]
        return out

    # -- triples --------------------------------------------------------------------------------
    def class_scan(self, cls: str, subject: Any, wanted) -> Frame:
        d, props = self.catalog.get(cls), self.catalog.properties(cls)
        df = d.frame()
        base = df.select(d.raw_key().alias("_key"), *[F.col(props[p].column).alias(f"_p{k}") for k, (p, _, _) in enumerate(wanted)])
        columns: dict[str, Column] = {}
        info: dict[str, Info] = {}
        if isinstance(subject, A.Var):
            columns[subject.name], info[subject.name] = F.col("_key"), Info("node", cls)
        else:
            base = base.filter(F.col("_key") == self.key_literal(_name(subject), cls))
        for k, (p, obj, kind) in enumerate(wanted):
            prop, c = props[p], F.col(f"_p{k}")
            if (kind is A.Link and not prop.link) or (kind is A.Data and prop.link):
                base = base.filter(F.lit(False))
            if prop.many:
                base = base.withColumn(f"_p{k}", F.explode(c))
            mine = Info("node", prop.link) if prop.link else Info("list" if prop.many and prop.family == "array" else "lit")
            if isinstance(obj, A.Var) and obj.name not in columns:
                base = base.filter(c.isNotNull())
                columns[obj.name], info[obj.name] = c, mine
            elif isinstance(obj, A.Var):
                other = info[obj.name]
                base = base.filter(self.iri(c, mine.cls) == self.iri(columns[obj.name], other.cls) if mine.cls != other.cls else c == columns[obj.name])
            else:
                base = base.filter(c == self.value(obj, Frame(None, {}), mine))
        return Frame(base.select(*[c.alias(n) for n, c in columns.items()] or [F.lit(1).alias("_one")]), info)

    def do_Star(self, node: Star, f: Frame) -> Frame:
        return self.join(f, self.class_scan(node.cls, node.subject, node.wanted))

    def union(self, frames: list[Frame]) -> Frame:
        names = list(dict.fromkeys(n for x in frames for n in x.info))
        info: dict[str, Info] = {}
        for n in names:
            mine = [x.info[n] for x in frames if n in x.info]
            one = {i.cls for i in mine}
            info[n] = Info(mine[0].kind, mine[0].cls if len(one) == 1 else None, any(i.maybe for i in mine) or len(mine) < len(frames))
        out = None
        for x in frames:
            x = self.plain(self.one(x), [n for n in x.info if info[n].cls is None])
            df = x.df.select(*x.info) if x.info else x.df.select(F.lit(1).alias("_one"))
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
        return Frame(out, info)

    def empty(self, names) -> Frame:
        return Frame(self.spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in names] or [T.StructField("_one", T.IntegerType())])), {n: Info() for n in names})

    def triples(self) -> DataFrame:
        """The virtual view of all edges: s, p, o (text), kind (node or lit), dt."""
        if self.graph == "schema":
            return self.schema_triples()
        out = None
        for name, d in self.catalog.classes.items():
            if not d.frame or d.abstract:
                continue
            items = [F.array(F.struct(F.lit("rdf:type").alias("p"), F.lit(name).alias("o"), F.lit("node").alias("kind"), F.lit("sys:Class").alias("dt")))]
            for p in self.catalog.properties(name).values():
                make = self.edge_of(p)
                items.append(F.transform(F.col(p.column), make) if p.many else F.array(make(F.col(p.column))))
            df = d.frame().select(self.iri(d.raw_key(), name).alias("s"), F.explode(F.concat(*items)).alias("e")).select("s", "e.p", "e.o", "e.kind", "e.dt").filter("o is not null")
            out = df if out is None else out.unionByName(df)
        return out

    def edge_of(self, p: Any):
        """One value of a property as an edge."""
        return lambda c: F.struct(F.lit(p.name).alias("p"), (self.iri(c, p.link) if p.link else c.cast("string")).alias("o"), F.lit("node" if p.link else "lit").alias("kind"), F.lit(p.link or f"xsd:{p.xsd}").alias("dt"))

    def schema_triples(self) -> DataFrame:
        rows = []
        for n, d in self.catalog.classes.items():
            rows.append((n, "rdf:type", "sys:Enum" if d.kind == "enum" else "sys:Class", "node", "sys:Class"))
            rows += [(n, "rdfs:subClassOf", p, "node", "sys:Class") for p in d.parents]
            rows += [(n, p.name, p.link or p.range or f"xsd:{p.xsd}", "node", "sys:Class") for p in d.properties]
        return self.spark.createDataFrame(rows, "s string, p string, o string, kind string, dt string")

    def edge_goal(self, edges: DataFrame, node: Any, f: Frame, kind: str | None) -> Frame:
        df = edges if kind is None else edges.filter(F.col("kind") == kind)
        columns: dict[str, Column] = {}
        for x, c in ((node.subject, "s"), (node.predicate, "p"), (node.object, "o")):
            if isinstance(x, A.Var) and x.name not in columns:
                columns[x.name] = F.col(c)
            elif isinstance(x, A.Var):
                df = df.filter(columns[x.name] == F.col(c))
            else:
                df = df.filter(F.col(c) == F.lit(_name(x) if isinstance(x, (str, A.Iri)) else str(x)))
        info = {n: Info("node") for n in columns}
        return self.join(f, Frame(df.select(*[c.alias(n) for n, c in columns.items()] or [F.lit(1).alias("_one")]), info))

    def do_Triple(self, node: Any, f: Frame) -> Frame:
        kind = {A.Link: "node", A.Data: "lit"}.get(type(node))
        if node.graph and node.graph != self.graph:
            return self.with_graph(node.graph).do_Triple(replace(node, graph=None), f)
        if isinstance(node.predicate, A.Var) or self.graph == "schema":
            if self.graph == "instance":
                f = self.plain(f, A.variables([node.subject, node.object]))
            return self.edge_goal(self.triples(), node, f, kind)
        p = _name(node.predicate)
        if p == "rdf:type":
            return self.do_IsA(A.IsA(node.subject, node.object), f)
        classes = self.catalog.having(p)
        if isinstance(node.subject, A.Var) and node.subject.name in f.info and f.info[node.subject.name].cls:
            classes = [c for c in classes if c == f.info[node.subject.name].cls]
        elif isinstance(node.subject, A.Var) and node.subject.name in f.info and f.info[node.subject.name].among is not None:
            classes = [c for c in classes if c in f.info[node.subject.name].among]
        elif isinstance(node.subject, A.Iri):
            classes = [c for c in classes if node.subject.text.startswith(f"{c}/") or self.catalog.get(c).key == ("iri",)]
        scans = [self.class_scan(c, node.subject, ((p, node.object, type(node)),)) for c in classes]
        return self.join(f, self.union(scans) if len(scans) > 1 else scans[0] if scans else self.empty(A.variables(node)))

    do_Link = do_Data = do_Triple

    def with_graph(self, graph: str) -> Lowerer:
        low = Lowerer(self.spark, self.catalog, self.named, self.store, graph, self.commit)
        low.dry = self.dry
        return low

    def do_IsA(self, node: A.IsA, f: Frame) -> Frame:
        if isinstance(node.type, A.Var):
            scans = []
            for c in (k for k, d in self.catalog.classes.items() if d.frame and not d.abstract):
                if isinstance(node.element, A.Iri) and self.catalog.get(c).key != ("iri",) and not node.element.text.startswith(f"{c}/"):
                    continue
                x = self.one(self.class_scan(c, node.element, ()))
                scans.append(Frame(x.df.withColumn(node.type.name, F.explode(F.array(*[F.lit(a) for a in self.catalog.ancestors(c)]))), x.info | {node.type.name: Info("node")}))
            return self.join(f, self.union(scans))
        classes = self.catalog.concrete(_name(node.type))
        if isinstance(node.element, A.Var) and node.element.name in f.info and f.info[node.element.name].cls:
            classes = [c for c in classes if c == f.info[node.element.name].cls]
        scans = [self.class_scan(c, node.element, ()) for c in classes]
        return self.join(f, self.union(scans) if len(scans) > 1 else scans[0] if scans else self.empty(A.variables(node)))

    def do_TripleSlice(self, node: Any, f: Frame) -> Frame:
        obj = node.object if isinstance(node.object, A.Var) else A.Var(f"_o{next(_fresh)}")
        f = self.lower(A.Triple(node.subject, node.predicate, obj, node.graph), f)
        if obj is not node.object:
            f = self.bind(f, obj, self.value(node.object, f))
        c = F.col(obj.name)
        t = self.dtype(c, f)
        for end, test in ((node.low, lambda x: c >= x), (node.high, lambda x: c < x)):
            if end is None:
                continue
            if isinstance(end, A.Var) and end.name not in f.info:  # an open end is the object itself
                f = Frame(f.df.withColumn(end.name, c), f.info | {end.name: f.info[obj.name]})
                continue
            limit = self.value(end, f)
            f = Frame(f.df.filter(test(limit.cast(t) if not isinstance(end, A.Var) else limit)), f.info)
        return f if obj is node.object else f.only([n for n in f.info if n != obj.name])

    def do_TripleSliceRev(self, node: Any, f: Frame) -> Frame:
        f = self.do_TripleSlice(node, f)
        return Frame(f.df.orderBy(F.col(node.object.name).desc()), f.info) if isinstance(node.object, A.Var) else f

    def neighbour(self, node: Any, f: Frame, other: Any, forward: bool) -> Frame:
        """Neighbours among the distinct objects of a subject and predicate."""
        s = node.subject if isinstance(node.subject, A.Var) else A.Var(f"_s{next(_fresh)}")
        o, n = f"_a{next(_fresh)}", f"_b{next(_fresh)}"
        edges = self.lower(A.Triple(node.subject, node.predicate, A.Var(o), node.graph))
        keys = [s.name] if isinstance(node.subject, A.Var) else []
        w = Window.partitionBy(*keys).orderBy(o) if keys else Window.partitionBy(F.lit(0)).orderBy(o)
        step = F.lead(o) if forward else F.lag(o)
        df = edges.df.select(*keys, o).distinct().withColumn(n, step.over(w)).filter(F.col(n).isNotNull())
        info = {k: edges.info[k] for k in keys} | {o: edges.info[o], n: edges.info[o]}
        g = Frame(df, info)
        for x, c in ((node.object, o), (other, n)):
            if isinstance(x, A.Var):
                g = Frame(g.df.withColumnRenamed(c, x.name), {(x.name if k == c else k): i for k, i in g.info.items()})
            else:
                g = Frame(g.df.filter(F.col(c) == self.value(x, Frame(None, {}), g.info[c])).drop(c), {k: i for k, i in g.info.items() if k != c})
        return self.join(f, g)

    def do_TripleNext(self, node: Any, f: Frame) -> Frame:
        return self.neighbour(node, f, node.next, True)

    def do_TriplePrevious(self, node: Any, f: Frame) -> Frame:
        return self.neighbour(node, f, node.previous, False)

    def delta(self, node: Any, f: Frame, op: str) -> Frame:
        if self.store is None:
            raise AnalysisError("added and deleted triples need a store")
        kind = "node" if type(node).__name__.endswith("Link") else "lit" if type(node).__name__.endswith("Data") else None
        edges = self.store.delta(self.commit, op)
        return self.edge_goal(edges, node, self.plain(f, A.variables([node.subject, node.object])), kind)

    def do_AddedTriple(self, node, f):
        return self.delta(node, f, "added")

    def do_DeletedTriple(self, node, f):
        return self.delta(node, f, "deleted")

    do_AddedLink = do_AddedData = do_AddedTriple
    do_DeletedLink = do_DeletedData = do_DeletedTriple

    def do_Get(self, node, f):
        df = self.spark.read.option("header", bool(node.header if node.header is not None else True)).csv(node.path)
        columns = [(F.col(f"`{c}`") if isinstance(c, str) else F.col(f"`{df.columns[c]}`"), name, t) for c, name, t in node.columns]
        return self.join(f, Frame(df.select(*[(c.try_cast(spark_type(t)) if t else c).alias(n.name) for c, n, t in columns]), {n.name: Info() for _, n, _ in columns}))

    def do_Size(self, node, f):
        sizes = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(node.resource).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n"))
        return self.join(f, Frame(sizes.select(F.col("n").alias(node.size.name)), {node.size.name: Info()}))

    def do_TripleCount(self, node, f):
        low = self if node.resource in (None, "", "instance") else self.with_graph("schema") if node.resource == "schema" else self.using(node.resource)
        if low.graph == "schema":
            n = low.triples().agg(F.count("*").alias("n"))
        else:  # a type edge a row and an edge a value: nothing is unpivoted
            n = None
            for name, d in low.catalog.classes.items():
                if not d.frame or d.abstract:
                    continue
                edges = F.count("*")
                for p in low.catalog.properties(name).values():
                    c = F.col(p.column)
                    edges = edges + (F.coalesce(F.sum(F.size(F.filter(c, lambda x: x.isNotNull()))), F.lit(0)) if p.many else F.count(c))
                one = d.frame().agg(edges.cast("long").alias("n"))
                n = one if n is None else n.unionByName(one)
            n = n.agg(F.sum("n").alias("n"))
        return self.join(f, Frame(n.select(F.col("n").alias(node.count.name)), {node.count.name: Info()}))

    # -- control --------------------------------------------------------------------------------
    def sub(self, q: A.Node, f: Frame) -> Frame:
        """Solutions of q for the values of the outer variables it mentions; alone where it can be."""
        shared = [n for n in f.info if n in A.mentioned(q)]
        alone = self.alone(q)
        if alone is not None and all(n in alone for n in shared):
            return self.lower(q)
        if alone is None and not shared:
            return self.lower(q)  # says what is missing
        seeds = f.only(shared)
        return self.lower(q, Frame(seeds.df.distinct(), {n: replace(i) for n, i in seeds.info.items()}))

    def condition(self, q: A.Node, f: Frame) -> Column | None:
        """q as a predicate on the frame, where it only compares bound values."""
        if isinstance(q, A.And):
            parts = [self.condition(g, f) for g in q.goals]
            return None if not parts or any(p is None for p in parts) else _fold(parts, lambda a, b: a & b)
        if isinstance(q, A.Or):
            parts = [self.condition(g, f) for g in q.goals]
            return None if not parts or any(p is None for p in parts) else _fold(parts, lambda a, b: a | b)
        if isinstance(q, A.Not):
            inner = self.condition(q.query, f)
            return None if inner is None else ~F.coalesce(inner, F.lit(False))
        if not A.mentioned(q) <= f.info.keys() or f.df is None or any(f.info[n].maybe for n in A.mentioned(q)):
            return None
        if type(q) in _TESTS:
            return _TESTS[type(q)](self.value(q.left, f), self.value(q.right, f))
        if isinstance(q, A.InRange):
            x = self.value(q.value, f)
            return (x >= self.value(q.start, f)) & (x < self.value(q.end, f))
        if isinstance(q, A.Equals):
            a, b = (q.left, q.right) if isinstance(q.left, A.Var) else (q.right, q.left)
            return self.same(self.value(a, f), f.info[a.name], b, f) if isinstance(a, A.Var) else self.value(a, f) == self.value(b, f)
        if isinstance(q, A.Regexp) and q.result is None:
            return self.value(q.string, f).rlike(q.pattern)
        return None

    def do_TrueGoal(self, node, f):
        return f

    def do_Pin(self, node, f):
        return self.lower(node.query, f)

    do_Immediately = do_Into = do_NamedQuery = do_Pin

    def do_From(self, node, f):
        return self.with_graph(node.graph).lower(node.query, f) if not f.info else self.join(f, self.with_graph(node.graph).lower(node.query))

    def using(self, collection: str) -> Lowerer:
        if self.store is None:
            raise AnalysisError("no store to read another collection from")
        commit = self.store.resolve(collection)
        low = Lowerer(self.spark, self.store.catalog_at(commit), self.named, self.store, self.graph, commit)
        low.dry = self.dry
        return low

    def alone(self, q: A.Node) -> dict[str, Info] | None:
        """What q binds without any outer binding, or None if it needs some; runs nothing."""
        low = self.copy()
        low.dry = True
        try:
            return low.lower(q).info
        except (Unbound, AnalysisError):
            return None

    def copy(self) -> Lowerer:
        return Lowerer(self.spark, self.catalog, self.named, self.store, self.graph, self.commit)

    def do_Using(self, node, f):
        return self.join(f, self.using(node.collection).lower(node.query))

    def do_Comment(self, node, f):
        return f

    def do_Call(self, node, f, depth: int = 0):
        """Inlined with fresh inner variables; a recursive query is expanded while its branches still bind rows."""
        q = self.named.get(node.name)
        if q is None:
            raise AnalysisError(f"no query named {node.name}")
        params = [p.name if isinstance(p, A.Var) else p for p in q.parameters]
        if len(params) != len(node.arguments):
            raise AnalysisError(f"{node.name} takes {len(params)} arguments")
        if self.calls(q.query, node.name):
            return self.join(f, self.recursive(q, params, node.arguments))
        tag = next(_fresh)
        names = {n: A.Var(f"{n}_{tag}") for n in A.mentioned(q.query)} | dict(zip(params, node.arguments, strict=True))
        out = self.lower(A.renamed(q.query, names), f)
        return out.only([n for n in out.info if n in f.info or n in A.variables(list(node.arguments))])

    def calls(self, q: Any, name: str) -> bool:
        from dataclasses import fields, is_dataclass

        if isinstance(q, A.Call) and q.name == name:
            return True
        if isinstance(q, (list, tuple)):
            return any(self.calls(x, name) for x in q)
        return is_dataclass(q) and any(self.calls(getattr(q, x.name), name) for x in fields(q))

    def recursive(self, q, params: list[str], arguments) -> Frame:
        """Least fixed point: calls inside read the solutions found so far, until there are no new ones."""
        from .shared import checkpoint

        if self.dry:
            names = [a.name for a in arguments if isinstance(a, A.Var)]
            return Frame(self.empty(names).df, {n: Info("node") for n in names})
        found: Frame | None = None
        while True:
            step = _Fixpoint(self, q.name, found, params)
            new = step.lower(q.query).only(params)
            new = self.plain(new, params)
            df = checkpoint(new.df.select(*params).distinct())
            n = df.count()
            if found is not None and n == found_n:
                break
            found, found_n = Frame(df, {p: replace(new.info[p], cls=None) for p in params}), n
        columns, rows = {}, found.df
        for p, a in zip(params, arguments, strict=True):
            if isinstance(a, A.Var):
                columns[a.name] = F.col(p)
            else:
                rows = rows.filter(F.col(p) == F.lit(_name(a) if isinstance(a, (str, A.Iri)) else a))
        return Frame(rows.select(*[c.alias(n) for n, c in columns.items()]), {n: found.info[p] for p, a in zip(params, arguments, strict=True) if isinstance(a, A.Var) for n in [a.name]})

    def do_Or(self, node, f):
        parts = [self.condition(g, f) for g in node.goals] if f.df is not None else []
        # branches that only test bound values are one filter, as long as at most one can hold
        if len(parts) == 1 and parts[0] is not None:
            return Frame(f.df.filter(parts[0]), f.info)
        return self.union([self.lower(g, f) for g in node.goals])

    def do_Not(self, node, f):
        test = self.condition(node.query, f)
        if test is not None:
            return Frame(f.df.filter(~F.coalesce(test, F.lit(False))), f.info)
        if f.df is None:
            f = self.one(f)
        sub = self.sub(node.query, f)
        shared = [n for n in f.info if n in sub.info]
        return self.join(f, sub.only(shared) if shared else sub, "left_anti")

    def do_Select(self, node, f):
        shown = {x.name for x in node.variables}
        tag = next(_fresh)
        hidden = {n: A.Var(f"{n}_{tag}") for n in A.mentioned(node.query) - shown}
        out = self.lower(A.renamed(node.query, hidden), Frame(None, {}) if f.df is None else f) if f.df is not None and self.needs(node.query, f) else self.join(f, self.lower(A.renamed(node.query, hidden)))
        missing = [n for n in (x.name for x in node.variables) if n not in out.info]
        for n in missing:
            out = Frame(self.one(out).df.withColumn(n, F.lit(None).cast("string")), out.info | {n: Info(maybe=True)})
        keep = [*f.info, *(x.name for x in node.variables if x.name not in f.info)]
        return Frame(out.df.select(*keep), {n: out.info[n] for n in keep})

    def needs(self, q: A.Node, f: Frame) -> bool:
        return self.alone(q) is None

    def do_Distinct(self, node, f):
        sub = self.one(self.sub(node.query, f) if f.df is not None else self.lower(node.query))
        names = [x.name for x in node.variables]
        names += [n for n in f.info if n in sub.info and n not in names]
        if set(names) >= set(sub.info):
            df = sub.df.select(*sub.info).distinct()
        else:  # the representative is the first in the order of the other variables
            w = Window.partitionBy(*names).orderBy(*[n for n in sub.info if n not in names])
            df = sub.df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
        return self.join(f, Frame(df, sub.info))

    def do_Optional(self, node, f):
        if f.df is None:
            f = self.one(f)
        return self.join(f, self.sub(node.query, f), "left")

    def do_If(self, node, f):
        f = self.one(f)
        test = self.condition(node.test, f)
        if test is not None:
            test = F.coalesce(test, F.lit(False))
            return self.union([self.lower(node.then, Frame(f.df.filter(test), f.info)), self.lower(node.otherwise, Frame(f.df.filter(~test), f.info))])
        sub = self.sub(node.test, f)
        shared = [n for n in f.info if n in sub.info]
        yes = self.lower(node.then, self.join(f, sub))
        no = self.lower(node.otherwise, self.join(f, sub.only(shared) if shared else sub, "left_anti"))
        return self.union([yes, no])

    def do_Once(self, node, f):
        ordered = node.query.ordering if isinstance(node.query, A.OrderBy) else None
        inner = node.query.query if ordered else node.query
        sub = self.sub(inner, f) if f.df is not None else self.lower(inner)
        shared = [n for n in f.info if n in sub.info]
        by = self.order(ordered) if ordered else [F.col(n) for n in sub.info if n not in shared]
        if not shared:
            return self.join(f, Frame((sub.df.orderBy(*by) if ordered else sub.df).limit(1), sub.info))
        w = Window.partitionBy(*shared).orderBy(*by or [F.lit(0)])
        return self.join(f, Frame(sub.df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n"), sub.info))

    # -- aggregation and order ------------------------------------------------------------------
    def do_Count(self, node, f):
        sub = self.sub(node.query, f) if f.df is not None else self.one(self.lower(node.query))
        shared = [n for n in f.info if n in sub.info]
        name = node.count.name if isinstance(node.count, A.Var) else f"_c{next(_fresh)}"
        if not shared:
            out = self.join(f, Frame(sub.df.agg(F.count("*").alias(name)), {name: Info()}))
        else:
            counts = Frame(sub.df.groupBy(*shared).agg(F.count("*").alias(name)), {n: sub.info[n] for n in shared} | {name: Info()})
            out = self.join(f, counts, "left")
            out = Frame(out.df.withColumn(name, F.coalesce(F.col(name), F.lit(0))), out.info | {name: Info()})
        return out if isinstance(node.count, A.Var) else Frame(out.df.filter(F.col(name) == node.count).drop(name), f.info)

    def do_CountBound(self, node, f):
        sub = self.one(self.lower(node.query))
        keys = [k.name for k in node.keys]
        c = F.count("*") if node.counted is None else F.count(node.counted.name) if node.counted.name in sub.info else F.lit(0).cast("long")
        df = sub.df.groupBy(*keys).agg(c.alias(node.count.name))
        return self.join(f, Frame(df, {k: sub.info[k] for k in keys} | {node.count.name: Info()}))

    def do_FirstDistinct(self, node, f):
        sub = self.one(self.lower(node.query))
        names, by = [x.name for x in node.variables], self.order(node.ordering)
        for n in names:
            if n not in sub.info:
                sub = Frame(sub.df.withColumn(n, F.lit(None).cast("string")), sub.info | {n: Info(maybe=True)})
        first = sub.df.withColumn("_n", F.row_number().over(Window.partitionBy(*names).orderBy(*by))).filter("_n = 1")
        return self.join(f, Frame(first.orderBy(*by).select(*names), {n: sub.info[n] for n in names}))

    def template(self, t: Any, f: Frame) -> tuple[Column, bool]:
        """(column, whether the list is flat)."""
        if isinstance(t, A.Var) or (isinstance(t, (list, tuple)) and len(t) == 1):
            return self.shown(t if isinstance(t, A.Var) else t[0], f), True
        if isinstance(t, (list, tuple)):
            return F.struct(*[self.shown(x, f).alias(x.name if isinstance(x, A.Var) else f"c{k}") for k, x in enumerate(t)]), False
        return self.value(t, f), False

    def shown(self, x: Any, f: Frame) -> Column:
        return self.iri(F.col(x.name), f.info[x.name].cls) if isinstance(x, A.Var) and x.name in f.info and f.info[x.name].kind == "node" else self.value(x, f)

    def group(self, node: A.GroupBy, f: Frame, others: list) -> tuple[Frame, list]:
        """Sums, lengths and ends of the grouped list become aggregates; Catalyst drops the list if nobody reads it."""
        sub = self.one(self.sub(node.query, f) if f.df is not None else self.lower(node.query))
        keys = [k.name for k in node.keys]
        keys += [n for n in f.info if n in sub.info and n not in keys and n not in A.mentioned(node.template)]
        c, flat = self.template(node.template, sub)
        collected = F.collect_list(F.struct(c.alias("x")))
        aggs = [F.transform(collected, lambda e: e["x"]).alias(node.grouped.name)]
        info = {k: sub.info[k] for k in keys} | {node.grouped.name: Info("list")}
        used = []
        for g in others:
            if isinstance(g, (A.Sum, A.Length, A.RangeMin, A.RangeMax)) and g.list == node.grouped:
                out = g.length if isinstance(g, A.Length) else g.result
                if isinstance(out, A.Var) and out.name not in f.info and out.name not in info and (flat or isinstance(g, A.Length)):
                    aggs.append({A.Sum: F.sum, A.Length: lambda _: F.count("*"), A.RangeMin: F.min, A.RangeMax: F.max}[type(g)](c).alias(out.name))
                    info[out.name] = Info()
                    used.append(g)
        return self.join(f, Frame(sub.df.groupBy(*keys).agg(*aggs), info)), used

    def do_GroupBy(self, node, f):
        return self.group(node, f, [])[0]

    def do_Collect(self, node, f):
        sub = self.sub(node.query, f) if f.df is not None else self.one(self.lower(node.query))
        c, _ = self.template(node.template, sub)
        shared = [n for n in f.info if n in sub.info]
        name = node.into.name
        if not shared:
            return self.join(f, Frame(sub.df.agg(F.transform(F.collect_list(F.struct(c.alias("x"))), lambda e: e["x"]).alias(name)), {name: Info("list")}))
        lists_ = Frame(sub.df.groupBy(*shared).agg(F.transform(F.collect_list(F.struct(c.alias("x"))), lambda e: e["x"]).alias(name)), {n: sub.info[n] for n in shared} | {name: Info("list")})
        out = self.join(f, lists_, "left")
        t = out.df.schema[name].dataType
        return Frame(out.df.withColumn(name, F.coalesce(F.col(name), F.array().cast(t))), out.info | {name: Info("list")})

    def order(self, ordering) -> list[Column]:
        """Nulls first ascending, last descending."""
        return [F.col(x.name).desc_nulls_last() if way == "desc" else F.col(x.name).asc_nulls_first() for x, way in ordering]

    def do_OrderBy(self, node, f):
        out = self.one(self.lower(node.query, f))
        return Frame(out.df.orderBy(*self.order(node.ordering)), out.info)

    def page(self, node: Any, f: Frame, first: int, last: int | None) -> Frame:
        """Solutions `first` to `last` of each value of the outer variables that the query shares, or of all."""
        ordered = node.query.ordering if isinstance(node.query, A.OrderBy) else None
        inner = node.query.query if ordered else node.query
        sub = self.one(self.sub(inner, f) if f.df is not None else self.lower(inner))
        shared = [n for n in f.info if n in sub.info]
        if not shared:
            df = sub.df.orderBy(*self.order(ordered)) if ordered else sub.df
            df = df.offset(first) if last is None else df.limit(last)
            return self.join(f, Frame(df, sub.info))
        own = [n for n in sub.info if n not in shared]
        by = [*(self.order(ordered) if ordered else []), *[F.col(n) for n in own]] or [F.lit(0)]
        n = F.row_number().over(Window.partitionBy(*shared).orderBy(*by))
        df = sub.df.withColumn("_n", n).filter(F.col("_n") > first)
        return self.join(f, Frame((df if last is None else df.filter(F.col("_n") <= last)).drop("_n"), sub.info))

    def do_Limit(self, node, f):
        if isinstance(node.query, A.Start) and f.df is not None:
            start = node.query
            return self.page(A.Limit(node.limit, start.query), f, start.start, start.start + node.limit) if self.shares(start.query, f) else self.uncorrelated(node, f)
        return self.page(node, f, 0, node.limit) if f.df is not None and self.shares(node.query, f) else self.uncorrelated(node, f)

    def do_Start(self, node, f):
        return self.page(node, f, node.start, None) if f.df is not None and self.shares(node.query, f) else self.uncorrelated(node, f)

    def shares(self, q: Any, f: Frame) -> bool:
        return bool(A.variables(q) & f.info.keys())

    def uncorrelated(self, node: Any, f: Frame) -> Frame:
        out = self.one(self.lower(node.query))
        return self.join(f, Frame(out.df.limit(node.limit) if isinstance(node, A.Limit) else out.df.offset(node.start), out.info))

    def do_Sum(self, node, f):
        c = self.value(node.list, f)
        t = self.dtype(c, f).elementType
        wide = T.LongType() if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)) else T.DecimalType(38, t.scale) if isinstance(t, T.DecimalType) else T.DecimalType(38, 0) if isinstance(t, T.LongType) else t
        total = F.aggregate(c, F.lit(0).cast(wide), lambda a, x: (a + x).cast(wide)) if not isinstance(t, T.StringType) else lists.total(c)
        return self.bind(f, node.result, total)

    def do_Length(self, node, f):
        return self.bind(f, node.length, F.size(self.value(node.list, f)).cast("long"))

    def do_RangeMin(self, node, f):
        return self.bind(f, node.result, F.array_min(self.value(node.list, f)), drop_null=True)

    def do_RangeMax(self, node, f):
        return self.bind(f, node.result, F.array_max(self.value(node.list, f)), drop_null=True)

    # -- comparison, types, arithmetic ----------------------------------------------------------
    def do_Equals(self, node, f):
        a, b = node.left, node.right
        if not self.bound(a, f) and not self.bound(b, f):
            raise Unbound(a.name)
        if not self.bound(a, f):
            a, b = b, a
        info = f.info[a.name] if isinstance(a, A.Var) else Info("node" if isinstance(a, A.Iri) else "list" if isinstance(a, (list, tuple)) else "lit")
        if isinstance(a, A.Var) and info.maybe and self.bound(b, f):
            a, b = b, a
            info = f.info[a.name] if isinstance(a, A.Var) else Info()
        return self.bind(f, b, self.value(a, f, f.info[b.name] if isinstance(b, A.Var) and b.name in f.info else None), info if isinstance(a, A.Var) or not self.bound(b, f) else (f.info[b.name] if isinstance(b, A.Var) else info))

    def compare(self, node, f):
        a, b = self.value(node.left, f), self.value(node.right, f)
        f = self.one(f)
        return Frame(f.df.filter(_TESTS[type(node)](a, b)), f.info)

    do_Less = do_Greater = do_Lte = do_Gte = compare

    def do_InRange(self, node, f):
        x, a, b = (self.value(y, f) for y in (node.value, node.start, node.end))
        f = self.one(f)
        return Frame(f.df.filter((x >= a) & (x < b)), f.info)

    def do_Subsumption(self, node, f):
        pairs = self.spark.createDataFrame(self.catalog.closure(), "child string, parent string")
        columns = {}
        for x, c in ((node.child, "child"), (node.parent, "parent")):
            if isinstance(x, A.Var):
                columns[x.name] = c
            else:
                pairs = pairs.filter(F.col(c) == _name(x))
        return self.join(f, Frame(F.broadcast(pairs.select(*[F.col(c).alias(n) for n, c in columns.items()] or [F.lit(1).alias("_one")])), {n: Info("node") for n in columns}))

    def do_TypeOf(self, node, f):
        c = self.value(node.value, f)
        if isinstance(node.value, A.Var) and f.info[node.value.name].kind == "node":
            name = f.info[node.value.name].cls
            return self.bind(f, node.type, F.lit(name) if name else F.lit("sys:Node"))
        return self.bind(f, node.type, F.lit(xsd_type(self.dtype(c, f).simpleString())))

    def do_Typecast(self, node, f):
        return self.bind(f, node.result, self.value(node.value, f).try_cast(spark_type(_name(node.type))), drop_null=True)

    def number(self, e: Any, f: Frame) -> Column:
        if not isinstance(e, A.Expression):
            return self.value(e, f)
        if isinstance(e, A.Floor):
            return F.floor(self.number(e.argument, f))
        a, b = self.number(e.left, f), self.number(e.right, f)
        if isinstance(e, A.Add):
            return a + b
        if isinstance(e, A.Minus):
            return a - b
        if isinstance(e, A.Mul):
            return a * b
        if isinstance(e, A.Exp):
            return F.pow(a, b)
        binary = any(isinstance(self.dtype(x, f), (T.DoubleType, T.FloatType)) for x in (a, b))
        if isinstance(e, A.Divide):
            return F.try_divide(a, b) if binary else F.try_divide(a.cast("decimal(38,20)"), b.cast("decimal(20,0)" if self.whole(b, f) else "decimal(38,18)"))
        if binary:
            q = F.try_divide(a, b)
            return F.when(q < 0, F.ceil(q)).otherwise(F.floor(q))
        zero = F.nullif(b, F.lit(0))
        return (a - a % zero).cast("decimal(38,0)").__truediv__(zero.cast("decimal(20,0)")).cast("long")

    def whole(self, c: Column, f: Frame) -> bool:
        return isinstance(self.dtype(c, f), T.IntegralType)

    def do_Eval(self, node, f):
        return self.bind(f, node.result, self.number(node.expression, f), drop_null=True)

    # -- lists ----------------------------------------------------------------------------------
    def do_Member(self, node, f):
        return self.generate(f, node.member, self.value(node.list, f))

    def do_SetMember(self, node, f):
        return self.generate(f, node.element, self.value(node.set, f))

    def do_Dot(self, node, f):
        c = self.value(node.document, f)
        t = self.dtype(c, f)
        if isinstance(t, T.StringType):
            got = F.get_json_object(c, f"$.{node.field}")
        elif isinstance(t, T.MapType):
            got = F.try_element_at(c, self.value(node.field, f))
        else:
            got = c.getField(node.field)
        return self.bind(f, node.value, got, drop_null=True)

    def do_Slice(self, node, f):
        end = None if node.end is None else self.value(node.end, f)
        return self.bind(f, node.result, lists.slice_list(self.value(node.list, f), self.value(node.start, f), end), Info("list"))

    def do_ListToSet(self, node, f):
        return self.bind(f, node.set, lists.to_set(self.value(node.list, f)), Info("list"))

    def sets(self, node, f, op):
        return self.bind(f, node.result, op(self.value(node.a, f), self.value(node.b, f)), Info("list"))

    def do_SetUnion(self, node, f):
        return self.sets(node, f, lists.union)

    def do_SetIntersection(self, node, f):
        return self.sets(node, f, lists.intersection)

    def do_SetDifference(self, node, f):
        return self.sets(node, f, lists.difference)

    def do_Sequence(self, node, f):
        if isinstance(node.start, str) and len(node.start) == 7 and isinstance(node.end, str):
            months = temporal.year_months(node.start, node.end)
            items = F.array(*[F.lit(m) for m in months]) if months else F.array().cast("array<string>")
        else:
            a, b = (self.value(x, f) for x in (node.start, node.end))
            if any(isinstance(x, str) for x in (node.start, node.end)):
                kind = "timestamp_ntz" if any(isinstance(x, str) and "T" in x for x in (node.start, node.end)) else "date"
                a, b = a.cast(kind), b.cast(kind)
            t = self.dtype(a, f)
            none = lambda kind: F.array().cast(f"array<{kind}>")
            if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
                step = F.expr(_interval(node.step or ("P1D" if isinstance(t, T.DateType) else "PT1H")))
                items = F.when(a < b, F.filter(F.sequence(a, b, step), lambda x: x < b)).otherwise(none(t.simpleString()))
            elif isinstance(t, T.IntegralType) and (node.step is None or isinstance(node.step, (int, A.Var))):
                step = F.lit(1).cast("long") if node.step is None else self.value(node.step, f).cast("long")
                a, b = a.cast("long"), b.cast("long")
                items = F.when(a < b, F.filter(F.sequence(a, F.greatest(a, b), step), lambda x: x < b)).otherwise(none("bigint"))
            else:
                step = F.lit(1) if node.step is None else self.value(node.step, f)
                a, b, step = (x.cast("decimal(28,10)") for x in (a, b, step))
                n = F.ceil((b - a) / step).cast("int")
                items = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda k: (a + k.cast("decimal(10,0)") * step).cast("decimal(28,10)"))).otherwise(none("decimal(28,10)"))
        if node.count is not None:
            f = self.bind(f, node.count, F.size(items).cast("long"))
        if isinstance(node.value, A.Var) and node.value.name not in f.info:
            return self.generate(f, node.value, items)
        x = self.value(node.value, f)
        inner = self.dtype(items, f).elementType
        f = self.one(f)
        return Frame(f.df.filter(F.array_contains(items, x.cast(inner))), f.info)

    # -- strings and keys -----------------------------------------------------------------------
    def do_Trim(self, node, f):
        return self.bind(f, node.trimmed, text.trim(self.value(node.untrimmed, f)))

    def do_Lower(self, node, f):
        return self.bind(f, node.lower, F.lower(self.value(node.mixed, f)))

    def do_Upper(self, node, f):
        return self.bind(f, node.upper, F.upper(self.value(node.mixed, f)))

    def do_Pad(self, node, f):
        return self.bind(f, node.result, text.pad(*(self.value(x, f) for x in (node.string, node.char, node.times))))

    def do_Split(self, node, f):
        return self.bind(f, node.list, text.split(self.value(node.string, f), node.pattern), Info("list"))

    def do_Join(self, node, f):
        return self.bind(f, node.result, F.array_join(self.value(node.list, f), node.separator))

    def do_Concatenate(self, node, f):
        c = F.concat(*[self.shown(x, f).cast("string") if self.bound(x, f) else self.value(x, f) for x in node.list]) if isinstance(node.list, (list, tuple)) else F.array_join(self.value(node.list, f), "")
        return self.bind(f, node.result, c)

    def do_Substring(self, node, f):
        s = self.value(node.string, f)
        n = F.length(s)
        known = lambda x: self.bound(x, f)
        if known(node.before) and known(node.length):
            a, b = self.value(node.before, f), self.value(node.length, f)
            f = self.one(f)
            f = Frame(f.df.filter((a >= 0) & (b >= 0) & (a + b <= n)), f.info)
            f = self.bind(f, node.substring, F.substring(s, (a + 1).cast("int"), b.cast("int")))
            return self.bind(f, node.after, (n - a - b).cast("int"))
        if known(node.before) and known(node.after):
            f = self.bind(f, node.length, n - self.value(node.before, f) - self.value(node.after, f))
            return self.do_Substring(node, f)
        if known(node.length) and known(node.after):
            f = self.bind(f, node.before, n - self.value(node.length, f) - self.value(node.after, f))
            return self.do_Substring(node, f)
        if known(node.substring):
            part = self.value(node.substring, f)
            m = F.length(part)
            places = F.when(n >= m, F.filter(F.sequence(F.lit(0), F.greatest(n - m, F.lit(0))), lambda k: F.substring(s, k + 1, m) == part)).otherwise(F.array().cast("array<int>"))
            f = self.generate(f, node.before, places) if not known(node.before) else f
            f = self.bind(f, node.length, m)
            return self.do_Substring(node, f)
        if not known(node.before):
            return self.do_Substring(node, self.generate(f, node.before, F.sequence(F.lit(0), n)))
        return self.do_Substring(node, self.generate(f, node.length, F.sequence(F.lit(0), n - self.value(node.before, f))))

    def do_Regexp(self, node, f):
        import re

        s = self.value(node.string, f)
        f = self.one(f)
        f = Frame(f.df.filter(s.rlike(node.pattern)), f.info)
        if node.result is None:
            return f
        groups = re.compile(re.sub(r"\(\?<(?![=!])", "(?P<", node.pattern)).groups
        return self.bind(f, node.result, F.array(*[F.regexp_extract(s, node.pattern, k) for k in range(groups + 1)]), Info("list"))

    def do_Like(self, node, f):
        return self.bind(f, node.similarity, text.like(self.value(node.left, f), self.value(node.right, f)))

    def keys(self, node, f):
        return F.lit(_name(node.base)), [self.value(k, f) for k in node.key_list]

    def do_LexicalKey(self, node, f):
        return self.bind(f, node.uri, text.lexical_key(*self.keys(node, f)), Info("node"))

    def do_HashKey(self, node, f):
        return self.bind(f, node.uri, text.hash_key(*self.keys(node, f)), Info("node"))

    def do_RandomKey(self, node, f):
        return self.bind(f, node.uri, text.random_key(F.lit(_name(node.base))), Info("node"))

    # -- dates ----------------------------------------------------------------------------------
    def ends(self, f: Frame, interval: Any) -> tuple[Column, Column]:
        if isinstance(interval, str):
            a, b = interval.split("/")
            return F.lit(a).cast("date"), F.lit(b).cast("date")
        c = self.value(interval, f)
        if isinstance(self.dtype(c, f), T.StringType):
            return F.split_part(c, F.lit("/"), F.lit(1)).cast("date"), F.split_part(c, F.lit("/"), F.lit(2)).cast("date")
        return c["start"], c["end"]

    def do_Interval(self, node, f):
        if self.bound(node.start, f) and self.bound(node.end, f):
            a, b = self.when(node.start, f)[0], self.when(node.end, f)[0]
            if isinstance(node.interval, str) or (isinstance(node.interval, A.Var) and node.interval.name in f.info):
                x, y = self.ends(f, node.interval)
                f = self.one(f)
                return Frame(f.df.filter((a == x) & (b == y)), f.info)
            return self.bind(f, node.interval, F.struct(a.alias("start"), b.alias("end")))
        x, y = self.ends(f, node.interval)
        return self.bind(self.bind(f, node.start, x), node.end, y)

    def do_IntervalStartDuration(self, node, f):
        if self.bound(node.start, f) and self.bound(node.duration, f):
            a, timed = self.when(node.start, f)
            d = node.duration if isinstance(node.duration, str) else self.value(node.duration, f)
            return self.bind(f, node.interval, F.struct(a.alias("start"), temporal.shift(a, d, 1, timed).alias("end")))
        x, y = self.ends(f, node.interval)
        return self.bind(self.bind(f, node.start, x), node.duration, temporal.between(x, y))

    def do_IntervalDurationEnd(self, node, f):
        if self.bound(node.end, f) and self.bound(node.duration, f):
            b, timed = self.when(node.end, f)
            d = node.duration if isinstance(node.duration, str) else self.value(node.duration, f)
            return self.bind(f, node.interval, F.struct(temporal.shift(b, d, -1, timed).alias("start"), b.alias("end")))
        x, y = self.ends(f, node.interval)
        return self.bind(self.bind(f, node.duration, temporal.between(x, y)), node.end, y)

    def relate(self, relation, f, a, b, c, d):
        if isinstance(relation, str):
            f = self.one(f)
            return Frame(f.df.filter(temporal.holds(relation, a, b, c, d)), f.info)
        return self.bind(f, relation, temporal.allen(a, b, c, d))

    def do_IntervalRelation(self, node, f):
        return self.relate(node.relation, f, *(self.when(x, f)[0] for x in (node.x_start, node.x_end, node.y_start, node.y_end)))

    def do_IntervalRelationTyped(self, node, f):
        return self.relate(node.relation, f, *self.ends(f, node.x), *self.ends(f, node.y))

    def do_DateDuration(self, node, f):
        known = [self.bound(x, f) for x in (node.start, node.duration, node.end)]
        d = node.duration if isinstance(node.duration, str) else self.value(node.duration, f) if known[1] else None
        if known[0] and known[1]:
            a, timed = self.when(node.start, f)
            moved = temporal.shift(a, d, 1, timed)
            return self.bind(f, node.end if isinstance(node.end, A.Var) else self.literal_day(node.end), moved)
        if known[1] and known[2]:
            b, timed = self.when(node.end, f)
            return self.bind(f, node.start, temporal.shift(b, d, -1, timed))
        if known[0] and known[2]:
            (a, t1), (b, t2) = self.when(node.start, f), self.when(node.end, f)
            return self.bind(f, node.duration, temporal.between(a, b, t1 or t2))
        raise Unbound(next(iter(A.variables(node) - f.info.keys())))

    def literal_day(self, x: Any) -> Any:
        return datetime.date.fromisoformat(x) if isinstance(x, str) else x

    def days(self, node_in, node_out, f, n):
        if self.bound(node_in, f):
            return self.bind(f, self.literal_day(node_out), F.date_add(self.day(node_in, f), n))
        return self.bind(f, node_in, F.date_add(self.day(node_out, f), -n))

    def do_DayAfter(self, node, f):
        return self.days(node.date, node.next, f, 1)

    def do_DayBefore(self, node, f):
        return self.days(node.date, node.previous, f, -1)

    def do_IsoWeek(self, node, f):
        d = self.day(node.date, f)
        return self.bind(self.bind(f, node.week, F.extract(F.lit("WEEK"), d).cast("int")), node.year, F.extract(F.lit("YEAROFWEEK"), d).cast("int"))

    def do_Weekday(self, node, f):
        return self.bind(f, node.weekday, F.weekday(self.day(node.date, f)) + 1)

    def do_WeekdaySundayStart(self, node, f):
        return self.bind(f, node.weekday, F.dayofweek(self.day(node.date, f)))

    def do_MonthStartDate(self, node, f):
        return self.bind(f, self.literal_day(node.date), temporal.month_start(self.value(node.year_month, f)))

    def do_MonthEndDate(self, node, f):
        return self.bind(f, self.literal_day(node.date), F.last_day(temporal.month_start(self.value(node.year_month, f))))

    def do_MonthStartDates(self, node, f):
        return self.generate(f, self.literal_day(node.date), temporal.month_starts(self.day(node.start, f), self.day(node.end, f)))

    def do_MonthEndDates(self, node, f):
        return self.generate(f, self.literal_day(node.date), temporal.month_ends(self.day(node.start, f), self.day(node.end, f)))

    # -- paths and documents --------------------------------------------------------------------
    def edges(self, name: str | None, subjects: frozenset | None = None, objects: frozenset | None = None) -> DataFrame:
        """s, p, o of links (or of a property), of subjects of some classes, to objects of some classes."""
        out = None
        for cls, d in self.catalog.classes.items():
            if not d.frame or d.abstract or (subjects is not None and cls not in subjects):
                continue
            mine = [p for p in self.catalog.properties(cls).values() if (p.link if name is None else p.name == name)]
            mine = [p for p in mine if objects is None or (p.link and self.family(p.link) & objects)]
            if not mine:
                continue
            df = d.frame().withColumn("_s", self.iri(d.raw_key(), cls))
            if len(mine) == 1:
                p = mine[0]
                df = df.select("_s", (F.explode(F.col(p.column)) if p.many else F.col(p.column)).alias("_o")).filter("_o is not null")
                df = df.select(F.col("_s").alias("s"), F.lit(p.name).alias("p"), self.iri(F.col("_o"), p.link).alias("o"))
            else:
                make = lambda p: lambda c: F.struct(F.lit(p.name).alias("p"), self.iri(c, p.link).alias("o"))
                items = [F.transform(F.col(p.column), make(p)) if p.many else F.array(make(p)(F.col(p.column))) for p in mine]
                df = df.select("_s", F.explode(F.concat(*[F.coalesce(x, F.array().cast("array<struct<p:string,o:string>>")) for x in items])).alias("_e"))
                df = df.select(F.col("_s").alias("s"), F.col("_e.p").alias("p"), F.col("_e.o").alias("o")).filter("o is not null")
            out = df if out is None else out.unionByName(df)
        return out if out is not None else self.spark.createDataFrame([], "s string, p string, o string")

    def family(self, cls: str) -> frozenset:
        """The classes that a link to cls may meet."""
        return frozenset({cls, *self.catalog.concrete(cls)})

    def leads(self, name: str | None, classes: frozenset, backwards: bool) -> frozenset:
        """The classes at the other end of links (or a property) from some classes; a value has none."""
        out: set[str] = set()
        for cls, d in self.catalog.classes.items():
            if not d.frame or d.abstract:
                continue
            for p in self.catalog.properties(cls).values():
                if not p.link or (name is not None and p.name != name):
                    continue
                if backwards and self.family(p.link) & classes:
                    out.add(cls)
                elif not backwards and cls in classes:
                    out |= self.family(p.link)
        return frozenset(out)

    def classes_of(self, x: Any, f: Frame) -> frozenset | None:
        """The classes that a node may be of, if known."""
        if isinstance(x, A.Var):
            i = f.info.get(x.name)
            return None if i is None else frozenset([i.cls]) if i.cls else i.among
        at = _name(x).split("/")[0]
        known = at in self.catalog.classes and not any(d.frame and d.key == ("iri",) for d in self.catalog.classes.values())
        return frozenset([at]) if known else None

    def do_Path(self, node, f):
        pattern = paths.parse(node.pattern) if isinstance(node.pattern, str) else node.pattern
        classes = self.classes_of(node.subject, f)
        f = self.plain(f, A.variables([node.subject, node.object]))
        starts = None
        if self.dry:
            found = self.spark.createDataFrame([], "s string, o string, path array<struct<s:string,p:string,o:string>>")
        else:
            if not isinstance(node.subject, A.Var):
                starts = self.spark.createDataFrame([(_name(node.subject),)], "s string")
            elif node.subject.name in f.info and not f.info[node.subject.name].maybe:
                starts = f.df.select(F.col(node.subject.name).alias("s")).distinct()
            if starts is None or not self.only_links(pattern):
                classes = None
            found = paths.pairs(pattern, self.edges, starts, classes, self.leads) if node.path is None else paths.paths(pattern, self.edges, starts)
        to = paths.reached(pattern, classes, self.leads) if self.only_links(pattern) else None
        columns = {}
        for x, c in ((node.subject, "s"), (node.object, "o")):
            if isinstance(x, A.Var) and x.name not in columns:
                columns[x.name] = F.col(c)
            elif isinstance(x, A.Var):
                found = found.filter("s = o")
            else:
                found = found.filter(F.col(c) == _name(x))
        if node.path is None:
            found = found.distinct()
        else:
            columns[node.path.name] = F.col("path")
        info = {n: Info("list" if node.path is not None and n == node.path.name else "node") for n in columns}
        if isinstance(node.object, A.Var) and to is not None:
            info[node.object.name] = replace(info[node.object.name], among=to)
        return self.join(f, Frame(found.select(*[c.alias(n) for n, c in columns.items()] or [F.lit(1).alias("_one")]), info))

    def only_links(self, pattern: Any) -> bool:
        """Whether a pattern never ends at a value: a property that holds values has no class to lead to."""
        if isinstance(pattern, (A.Pred, A.Inverse)):
            return pattern.name is None or all(self.catalog.properties(c)[pattern.name].link for c in self.catalog.having(pattern.name))
        return all(map(self.only_links, pattern.parts)) if isinstance(pattern, (A.Seq, A.Alt)) else self.only_links(pattern.part)

    def documents(self, cls: str, depth: int = 0) -> DataFrame:
        """key, doc (a struct): links are IRIs, or documents down to a depth."""
        d, columns = self.catalog.get(cls), [self.iri(F.col("_key"), cls).alias("@id"), F.lit(cls).alias("@type")]
        df = d.frame().withColumn("_key", d.raw_key())
        for k, p in enumerate(self.catalog.properties(cls).values()):
            c = F.col(p.column)
            if p.link and not p.many and depth > 0 and self.catalog.get(p.link).frame:
                inner = self.documents(p.link, depth - 1).select(F.col("key").alias(f"_k{k}"), F.col("doc").alias(f"_d{k}"))
                df = df.join(inner, df[p.column] == F.col(f"_k{k}"), "left")
                c = F.col(f"_d{k}")
            elif p.link:
                c = F.transform(c, self.iri_of(p.link)) if p.many else self.iri(c, p.link)
            columns.append(c.alias(p.name))
        return df.select(F.col("_key").alias("key"), F.struct(*columns).alias("doc"))

    def do_ReadDocument(self, node, f):
        x, depth = node.identifier, node.depth or 0
        if isinstance(x, A.Var) and x.name in f.info and f.info[x.name].cls:
            classes = [f.info[x.name].cls]
        elif isinstance(x, A.Iri) and x.text.split("/")[0] in self.catalog.classes:
            classes = [x.text.split("/")[0]]
        else:
            classes = [k for k, d in self.catalog.classes.items() if d.frame and not d.abstract and not d.subdocument]
        frames = []
        for c in classes:
            df = self.documents(c, depth)
            if isinstance(x, A.Var):
                frames.append(Frame(df.select(F.col("key").alias(x.name), F.to_json("doc").alias(node.document.name)), {x.name: Info("node", c), node.document.name: Info()}))
            else:
                frames.append(Frame(df.filter(F.col("key") == self.key_literal(_name(x), c)).select(F.to_json("doc").alias(node.document.name)), {node.document.name: Info()}))
        return self.join(f, self.union(frames) if len(frames) > 1 else frames[0])


class _Fixpoint(Lowerer):
    """Calls of the query being solved read what has been found."""

    def __init__(self, base: Lowerer, name: str, found: Frame | None, params: list[str]):
        super().__init__(base.spark, base.catalog, base.named, base.store, base.graph, base.commit)
        self.name, self.found, self.params = name, found, params

    def do_Call(self, node, f):
        if node.name != self.name:
            return super().do_Call(node, f)
        if self.found is None:
            empty = self.empty([a.name for a in node.arguments if isinstance(a, A.Var)])
            return self.join(self.plain(f, empty.info), Frame(empty.df, {n: Info("node") for n in empty.info}))
        columns, rows = {}, self.found.df
        for p, a in zip(self.params, node.arguments, strict=True):
            if isinstance(a, A.Var):
                columns[a.name] = (F.col(p), self.found.info[p])
            else:
                rows = rows.filter(F.col(p) == F.lit(_name(a) if isinstance(a, (str, A.Iri)) else a))
        return self.join(self.plain(f, columns), Frame(rows.select(*[c.alias(n) for n, (c, _) in columns.items()]), {n: i for n, (_, i) in columns.items()}))


@dataclass(frozen=True)
class Star(A.Node):
    """All triples of one subject and class: one scan."""

    subject: A.Var
    cls: str
    wanted: tuple


def _name(x: Any) -> str:
    return x.text if isinstance(x, A.Iri) else x


def _fold(parts: list, op) -> Any:
    out = parts[0]
    for p in parts[1:]:
        out = op(out, p)
    return out


def _interval(duration: str) -> str:
    m = temporal._DURATION.fullmatch(duration)
    if not m:
        raise AnalysisError(f"no duration: {duration}")
    units = ("year", "month", "day", "hour", "minute", "second")
    given = [f"{n} {u}" for n, u in zip(m.groups()[1:], units, strict=True) if n]
    return "interval " + ("-" if m[1] else "") + " ".join(given)
