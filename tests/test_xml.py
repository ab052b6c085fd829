"""XML schemas as classes, XML files as their rows."""

import pytest

from loomgraph.plans.algebra import And, Select, Triple, v
from loomgraph.plans.catalog import Catalog, CatalogError
from loomgraph.plans.session import Session
from loomgraph.sources.xml import XmlSchema

SCHEMA = """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">
 <xs:simpleType name="Colour"><xs:restriction base="xs:string"><xs:enumeration value="red"/><xs:enumeration value="blue"/></xs:restriction></xs:simpleType>
 <xs:complexType name="Place"><xs:sequence><xs:element name="city" type="xs:string"/></xs:sequence></xs:complexType>
 <xs:element name="item"><xs:complexType><xs:sequence>
  <xs:element name="price" type="xs:double"/><xs:element name="colour" type="Colour" minOccurs="0"/>
  <xs:element name="tag" type="xs:string" minOccurs="0" maxOccurs="unbounded"/><xs:element name="made" type="Place" minOccurs="0"/>
 </xs:sequence><xs:attribute name="code" type="xs:int" use="required"/></xs:complexType></xs:element>
</xs:schema>"""
ROWS = """<items><item code="1"><price>1.5</price><colour>red</colour><tag>a</tag><tag>b</tag><made><city>Rome</city></made></item>
<item code="2"><price>2</price><colour>green</colour></item></items>"""


def test_schema_and_rows(spark, tmp_path):
    (tmp_path / "items.xml").write_text(ROWS)
    catalog = Catalog().add(*XmlSchema(SCHEMA).classes(spark, "item", str(tmp_path / "items.xml"), "code"))
    got = catalog.properties("item")
    assert [(p.name, p.xsd, p.family) for p in got.values()] == [("price", "double", "one"), ("colour", "string", "optional"), ("tag", "string", "list"), ("made", "sys:JSON", "optional"), ("code", "int", "one")]
    held = {r.code: r for r in catalog.get("item").frame().collect()}
    assert held[1].made.city == "Rome" and held[1].tag == ["a", "b"] and held[2].price == 2.0 and held[2].tag is None
    assert {r.code: r.errors for r in catalog.check("item").collect()} == {1: [], 2: ["colour: not in item_colour"]}
    x, y, z = v("x y z")
    found = Session(spark, catalog).run(Select([x, z], And(Triple(x, "price", 1.5), Triple(x, "tag", z))))
    assert {tuple(r) for r in found.collect()} == {("item/1", "a"), ("item/1", "b")}


@pytest.mark.parametrize(("element", "key", "error"), [("none", "code", "no element"), ("item", "name", "no property")])
def test_refused(spark, element, key, error):
    with pytest.raises(CatalogError, match=error):
        XmlSchema(SCHEMA).classes(spark, element, "x", key)
