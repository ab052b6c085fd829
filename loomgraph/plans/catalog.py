"""Classes of documents over DataFrames: properties become columns, links become keys of other classes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: xsd name -> Spark type; what isn't here is text.
XSD = {
    "string": "string", "normalizedString": "string", "token": "string", "language": "string", "Name": "string", "NCName": "string", "NMTOKEN": "string", "anyURI": "string",
    "boolean": "boolean", "decimal": "decimal(38,20)", "double": "double", "float": "float", "byte": "tinyint", "short": "smallint", "int": "int", "long": "bigint",
    "unsignedByte": "smallint", "unsignedShort": "int", "unsignedInt": "bigint", "unsignedLong": "decimal(20,0)", "integer": "bigint", "nonNegativeInteger": "bigint",
    "positiveInteger": "bigint", "negativeInteger": "bigint", "nonPositiveInteger": "bigint", "date": "date", "dateTime": "timestamp_ntz", "dateTimeStamp": "timestamp",
    "time": "string", "hexBinary": "string", "base64Binary": "string", "gYear": "int", "gYearMonth": "string", "gMonth": "int", "gDay": "int",
    "duration": "string", "yearMonthDuration": "string", "dayTimeDuration": "string",
}
#: Spark type -> xsd name, for TypeOf.
OF_SPARK = {
    "string": "xsd:string", "boolean": "xsd:boolean", "double": "xsd:double", "float": "xsd:float", "tinyint": "xsd:byte", "smallint": "xsd:short", "int": "xsd:int",
    "bigint": "xsd:long", "date": "xsd:date", "timestamp_ntz": "xsd:dateTime", "timestamp": "xsd:dateTimeStamp",
}


def spark_type(xsd: str) -> str:
    return XSD.get(xsd.removeprefix("xsd:"), "string")


def xsd_type(spark: str) -> str:
    return "xsd:decimal" if spark.startswith("decimal") else OF_SPARK.get(spark, "sys:JSON")


@dataclass(frozen=True)
class Property:
    """A column; `link` names the class whose key it holds. family: one of one, optional, list, set, array."""

    name: str
    column: str
    xsd: str = "string"
    link: str | None = None
    family: str = "one"
    low: int | None = None  # cardinality of a set
    high: int | None = None
    range: str | None = None  # of an enum

    @property
    def many(self) -> bool:
        return self.family in ("list", "set", "array")


@dataclass(frozen=True)
class ClassDef:
    """kind: class, enum, oneof or union. `frame` gives the rows; `key` the columns that name a document."""

    name: str
    key: tuple[str, ...] = ("iri",)
    properties: tuple[Property, ...] = ()
    frame: Callable[[], DataFrame] | None = None
    parents: tuple[str, ...] = ()
    abstract: bool = False
    subdocument: bool = False
    kind: str = "class"
    values: tuple[str, ...] = ()
    strategy: str = "plain"  # plain, lexical, hash, valuehash, random
    unfoldable: bool = False

    def raw_key(self) -> Column:
        return F.col(self.key[0]) if len(self.key) == 1 else F.concat_ws("_", *[F.col(k).cast("string") for k in self.key])


class CatalogError(ValueError):
    pass


@dataclass
class Catalog:
    classes: dict[str, ClassDef] = field(default_factory=dict)

    def add(self, *defs: ClassDef) -> Catalog:
        for d in defs:
            clash = next((k for k in self.classes if k.lower() == d.name.lower() and k != d.name), None)
            if clash:
                raise CatalogError(f"{d.name} and {clash} are one SQL name")
            self.classes[d.name] = d
        return self

    def get(self, name: str) -> ClassDef:
        if name not in self.classes:
            raise CatalogError(f"no class {name}; there are {', '.join(sorted(self.classes))}")
        return self.classes[name]

    def ancestors(self, name: str) -> list[str]:
        """The class and all it inherits from, nearest first."""
        out, todo = [], [name]
        while todo:
            n = todo.pop(0)
            if n not in out:
                out.append(n)
                todo += self.classes[n].parents if n in self.classes else ()
        return out

    def concrete(self, name: str) -> list[str]:
        """Classes with rows that are `name` or inherit from it."""
        return [k for k, d in self.classes.items() if d.frame and not d.abstract and name in self.ancestors(k)]

    def closure(self) -> list[tuple[str, str]]:
        return [(k, a) for k in self.classes for a in self.ancestors(k)]

    def properties(self, name: str) -> dict[str, Property]:
        """Own and inherited ones; a child's override its parents'."""
        out: dict[str, Property] = {}
        for a in reversed(self.ancestors(name)):
            out |= {p.name: p for p in self.classes[a].properties} if a in self.classes else {}
        return out

    def having(self, prop: str) -> list[str]:
        return [k for k, d in self.classes.items() if d.frame and not d.abstract and prop in self.properties(k)]

    def with_frames(self, frames: dict[str, Callable[[], DataFrame]]) -> Catalog:
        from dataclasses import replace

        return Catalog({k: replace(d, frame=frames.get(k, d.frame)) for k, d in self.classes.items()})

    def check(self, name: str) -> DataFrame:
        """Rows of a class with an `errors` array: missing required values, cardinalities, enum values, one-of."""
        d, tests = self.get(name), []
        for p in self.properties(name).values():
            c = F.col(p.column)
            if p.family == "one":
                tests.append(F.when(c.isNull(), F.lit(f"{p.name}: missing")))
            if p.low is not None:
                tests.append(F.when(F.size(F.coalesce(c, F.array())) < p.low, F.lit(f"{p.name}: fewer than {p.low}")))
            if p.high is not None:
                tests.append(F.when(F.size(F.coalesce(c, F.array())) > p.high, F.lit(f"{p.name}: more than {p.high}")))
            if p.family == "set":
                tests.append(F.when(F.size(c) != F.size(F.array_distinct(c)), F.lit(f"{p.name}: repeats")))
            if p.range:
                tests.append(F.when(~c.isin(*self.get(p.range).values), F.lit(f"{p.name}: not in {p.range}")))
        if d.kind in ("oneof", "union"):
            given = sum((F.col(p.column).isNotNull().cast("int") for p in d.properties), F.lit(0))
            tests.append(F.when(given != 1, F.lit("not exactly one of its fields")))
        return d.frame().withColumn("errors", F.array_compact(F.array(*tests)) if tests else F.array())

    def sql_omitted(self) -> dict[str, str]:
        """What the SQL surface leaves out, and why."""
        out = {}
        for k, d in self.classes.items():
            if d.abstract:
                out[k] = "abstract class"
            elif d.subdocument:
                out[k] = "subdocument"
            elif d.kind == "enum":
                out[k] = "enum"
            for p in self.properties(k).values():
                if p.many:
                    out[f"{k}.{p.name}"] = "multi-valued"
                elif p.link and self.classes[p.link].subdocument:
                    out[f"{k}.{p.name}"] = "ranges over a subdocument"
                elif p.xsd in ("duration", "gYear", "gYearMonth", "gMonth", "gDay", "sys:JSON", "sys:Unit"):
                    out[f"{k}.{p.name}"] = f"no SQL type for {p.xsd}"
        return out


def tpch(spark: SparkSession, sf_dir: str) -> Catalog:
    """The star schema as documents; Customer and Supplier inherit from the abstract Party."""

    def of(table: str) -> Callable[[], DataFrame]:
        held: list[DataFrame] = []  # the schema is read once

        def frame():
            if not held:
                held.append(spark.read.parquet(f"{sf_dir}/{table}.parquet"))
            return held[0]

        return frame

    def cls(name, table, key, plain, links=(), **more):
        props = [Property(c, c, x) for c, x in (p.split(":") for p in plain.split())]
        props += [Property(n, c, "anyURI", t) for n, c, t in links]
        return ClassDef(name, tuple(key.split()), tuple(props), of(table), **more)

    return Catalog().add(
        ClassDef("Party", abstract=True),
        cls("Region", "region", "r_regionkey", "r_regionkey:int r_name:string"),
        cls("Nation", "nation", "n_nationkey", "n_nationkey:int n_name:string", [("region", "n_regionkey", "Region")]),
        cls("Customer", "customer", "c_custkey", "c_custkey:long c_name:string c_acctbal:double c_mktsegment:string", [("nation", "c_nationkey", "Nation")], parents=("Party",)),
        cls("Supplier", "supplier", "s_suppkey", "s_suppkey:long s_name:string s_acctbal:double", [("nation", "s_nationkey", "Nation")], parents=("Party",)),
        cls("Part", "part", "p_partkey", "p_partkey:long p_name:string p_brand:string p_type:string p_size:int p_retailprice:double"),
        cls("Order", "orders", "o_orderkey", "o_orderkey:long o_orderstatus:string o_totalprice:double o_orderdate:dateTime o_orderpriority:string", [("customer", "o_custkey", "Customer")]),
        cls(
            "LineItem", "lineitem", "l_orderkey l_linenumber",
            "l_linenumber:int l_quantity:double l_extendedprice:double l_discount:double l_tax:double l_returnflag:string l_linestatus:string l_shipdate:dateTime",
            [("order", "l_orderkey", "Order"), ("part", "l_partkey", "Part"), ("supplier", "l_suppkey", "Supplier")], subdocument=True,
        ),
        cls("Event", "events", "event_id", "event_id:long ts:dateTime user_id:long event_type:string value:double props:string"),
        cls("Document", "documents", "doc_id", "doc_id:long text:string lang:string source:string n_chars:long"),
        cls("Label", "labels", "doc_id", "quality:int toxic:int", [("document", "doc_id", "Document")]),
        cls("Page", "pages", "page_id", "page_id:long url:string html:string"),
        cls("Turn", "conversations", "conv_id turn", "conv_id:long turn:long role:string text:string"),
        cls("BenchmarkItem", "benchmark", "item_id", "item_id:long text:string"),
    )
