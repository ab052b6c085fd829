"""Classes from an XML schema, their rows from XML files.

A complex type becomes a class: attributes and child elements are properties, what may repeat is a list,
what may be missing or stands in a choice is optional, an enumeration is an enum class. An element with
children of its own is a struct column (sys:JSON). Files are read with the schema's types, so there is
no pass to infer them. An extension has the members of its base before its own; of a simple one the text is
the property VALUE. Groups and attribute groups are read where they are referred to. Wildcards and references
to types of other files are refused by name.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.catalog import XSD, CatalogError, ClassDef, Property, spark_type

XS = "{http://www.w3.org/2001/XMLSchema}"
MARK = "_"  # of attributes in Spark's columns
REFUSED = ("any", "anyAttribute", "openContent")


class XmlSchema:
    def __init__(self, text: str):
        self.root = ET.fromstring(text)
        self.types = {t.get("name"): t for t in self.root if t.tag in (XS + "complexType", XS + "simpleType")}
        self.elements = {e.get("name"): e for e in self.root if e.tag == XS + "element"}
        self.groups = {(g.tag.removeprefix(XS), g.get("name")): g for g in self.root if g.tag in (XS + "group", XS + "attributeGroup")}

    def type_of(self, node: ET.Element) -> tuple[str, ET.Element | None]:
        """(name, definition) of an element's or attribute's type; built-in types have no definition."""
        for kind in ("complexType", "simpleType"):
            inline = node.find(XS + kind)
            if inline is not None:
                return node.get("name", ""), inline
        prefix, _, name = node.get("type", "string").rpartition(":")
        if name in self.types:
            return name, self.types[name]
        if not prefix and name not in XSD:
            raise CatalogError(f"no type {name} in the schema")
        return name, None

    def members(self, kind: ET.Element, optional: bool = False, many: bool = False) -> Iterator[tuple[str, ET.Element, bool, bool, bool]]:
        """(name, node, is attribute, optional, many) of a complex type."""
        for x in kind:
            tag = x.tag.removeprefix(XS)
            if tag in REFUSED:
                raise CatalogError(f"xs:{tag} isn't read")
            may = optional or x.get("minOccurs") == "0"
            more = many or x.get("maxOccurs", "1") not in ("0", "1")
            if tag in ("group", "attributeGroup"):
                at = (tag, x.get("ref", "").rpartition(":")[2])
                if at not in self.groups:
                    raise CatalogError(f"no {tag} {at[1]} in the schema")
                yield from self.members(self.groups[at], may, more)
            elif tag in ("complexContent", "simpleContent"):
                yield from self.content(x, may, more)
            elif tag in ("sequence", "all", "choice"):
                yield from self.members(x, may or tag == "choice", more)
            elif tag == "element":
                ref = x.get("ref")
                node = self.elements[ref.rpartition(":")[2]] if ref else x
                yield node.get("name"), node, False, may, more
            elif tag == "attribute" and x.get("use") != "prohibited":
                yield x.get("name"), x, True, x.get("use") != "required", False

    def content(self, node: ET.Element, optional: bool, many: bool):
        """Members of an extension or restriction."""
        for x in node:
            way, base = x.tag.removeprefix(XS), x.get("base", "").rpartition(":")[2]
            if way == "extension" and base in self.types and self.types[base].tag == XS + "complexType":
                yield from self.members(self.types[base], optional, many)
            elif node.tag == XS + "simpleContent":
                yield "VALUE", ET.Element(XS + "attribute", {"type": x.get("base", "string")}), True, True, False
            elif way == "extension" and base and base != "anyType":
                raise CatalogError(f"no type {base} in the schema")
            if way in ("extension", "restriction"):
                yield from self.members(x, optional, many)

    def simple(self, name: str, kind: ET.Element | None) -> tuple[str, tuple[str, ...]]:
        """(built-in type, values of an enumeration)."""
        if kind is None:
            return name, ()
        limits = kind.find(XS + "restriction")
        if limits is None:
            return "string", ()
        base, more = limits.get("base", "string").rpartition(":")[2], tuple(v.get("value") for v in limits.findall(XS + "enumeration"))
        if base in self.types:
            base, inherited = self.simple(base, self.types[base])
            more = more or inherited
        return base, more

    def spark(self, name: str, kind: ET.Element | None, inside: tuple = ()) -> str:
        if kind is None or kind.tag == XS + "simpleType":
            return spark_type(self.simple(name, kind)[0])
        if name in inside:
            raise CatalogError(f"{name} contains itself")
        cells = []
        for child, node, attribute, _, many in self.members(kind):
            inner = self.spark(*self.type_of(node), (*inside, name))
            cells.append(f"`{MARK if attribute else ''}{child}`: {f'array<{inner}>' if many else inner}")
        return f"struct<{', '.join(cells)}>"

    def classes(self, spark: SparkSession, element: str, path: str, key: str) -> list[ClassDef]:
        """The class of an element whose rows are in XML files, and the enums it uses. key: a property."""
        if element not in self.elements:
            raise CatalogError(f"no element {element}; there are {', '.join(sorted(self.elements))}")
        name, kind = self.type_of(self.elements[element])
        if kind is None or kind.tag == XS + "simpleType":
            raise CatalogError(f"{element} has no properties")
        props, enums = [], []
        for child, node, _, optional, many in self.members(kind):
            of, inner = self.type_of(node)
            nested = inner is not None and inner.tag == XS + "complexType"
            base, values = ("sys:JSON", ()) if nested else self.simple(of, inner)
            if values:
                enums.append(ClassDef(f"{element}_{child}", kind="enum", values=values))
            family = "list" if many else "optional" if optional else "one"
            props.append(Property(child, child, base, family=family, range=enums[-1].name if values and not many else None))
        if key not in {p.name for p in props}:
            raise CatalogError(f"{element} has no property {key}")
        wide = self.spark(name, kind)
        return [*enums, ClassDef(element, (key,), tuple(props), lambda: self.read(spark, element, path, wide))]

    def read(self, spark: SparkSession, element: str, path: str, wide: str) -> DataFrame:
        """Rows of an element; a row that doesn't fit the types fails the read."""
        from pyspark.sql.types import StructType

        df = spark.read.format("xml").schema(StructType.fromDDL(wide)).options(rowTag=element, attributePrefix=MARK, mode="FAILFAST").load(path)
        return df.select(*[F.col(f"`{c}`").alias(c.removeprefix(MARK)) for c in df.columns])
