"""Binding modes, the JSON form, documents, patches, short names, schema extensions and concurrent writers."""

import datetime
import json

import pytest

from loomgraph.plans import algebra as A
from loomgraph.plans import json_form, queries, queries_modes, sugar
from loomgraph.plans.algebra import And, IsA, Iri, Link, Select, Triple, v
from loomgraph.plans.catalog import Catalog, CatalogError, ClassDef, Property, tpch
from loomgraph.plans.documents import Loader, WorkLimit
from loomgraph.plans.session import Session
from loomgraph.sources import patches
from loomgraph.sources.versions import Conflict, Store
from loomgraph.sources.xml import XmlSchema

x, y, z, n, r, c, k, g = v("x y z n r c k g")


@pytest.fixture(scope="module")
def star(spark, sf):
    return Session(spark, tpch(spark, sf))


def rows(session, node):
    return sorted(map(tuple, session.run(node).collect()), key=repr)


def test_chained_optionals_are_equi_joins(star):
    q = Select([c, n, x], And(IsA(c, "Customer"), A.Optional(And(Link(c, "nation", n), Triple(n, "n_nationkey", k), A.Less(k, 9))), A.Optional(And(Triple(n, "n_name", x)))))
    assert "NestedLoop" not in star.run(q)._jdf.queryExecution().executedPlan().toString()


def test_maybe_bound_variables_join_like_unification(spark):
    """Every mix of bound and unbound on both sides against nested loops."""
    import itertools

    from loomgraph.plans.lower import Frame, Info, Lowerer

    left = [(1, 10), (1, None), (None, 10), (None, None), (2, 20)]
    right = [(1, 10, "a"), (None, 10, "b"), (2, None, "c"), (None, None, "d"), (3, 30, "e")]
    low = Lowerer(spark, Catalog())
    for maybe in itertools.product((False, True), repeat=4):
        ls = [t for t in left if all(m or a is not None for m, a in zip(maybe[:2], t))]
        rs = [t for t in right if all(m or a is not None for m, a in zip(maybe[2:], t))]
        f = Frame(spark.createDataFrame(ls, "p int, q long"), {"p": Info(maybe=maybe[0]), "q": Info(maybe=maybe[1])})
        h = Frame(spark.createDataFrame(rs, "p int, q int, w string"), {"p": Info(maybe=maybe[2]), "q": Info(maybe=maybe[3]), "w": Info()})
        same = lambda a, b: a is None or b is None or a == b
        want = [(a if a is not None else d, b if b is not None else e, w) for a, b in ls for d, e, w in rs if same(a, d) and same(b, e)]
        assert sorted(map(tuple, low.join(f, h).df.select("p", "q", "w").collect()), key=repr) == sorted(want, key=repr), maybe
        if not (maybe[2] or maybe[3]):
            outer = want + [(a, b, None) for a, b in ls if not any(same(a, d) and same(b, e) for d, e, _ in rs)]
            assert sorted(map(tuple, low.join(f, h, "left").df.select("p", "q", "w").collect()), key=repr) == sorted(outer, key=repr), maybe


def every_node():
    q = Triple(x, "p", y)
    simple = {"query": q, "test": q, "then": q, "otherwise": q, "variables": [x, y], "keys": [x], "ordering": [(x, "asc"), (y, "desc")], "limit": 3, "start": 2, "list": [1, "a", y], "key_list": [x, "k"],
              "arguments": [x, 1], "parameters": ["a", "b"], "expression": A.Add(A.Mul(x, 2), A.Floor(A.Divide(y, 0.5))), "columns": [("a", x, None), (1, y, "xsd:long")], "path": "file.csv", "header": True,
              "graph": "schema", "collection": "branch/main", "name": "q", "resource": "instance", "subject": x, "predicate": "p", "object": Iri("A/1"), "depth": 2, "type": "xsd:date", "parent": "P", "child": x, "document": {"@type": "A", "b": x}}
    from dataclasses import fields

    for name, cls in vars(A).items():
        if not (isinstance(cls, type) and issubclass(cls, A.Node)) or cls in (A.Node, A.Dict, A.NamedParametricQuery):
            continue
        if name in ("And", "Or"):
            yield cls(q, A.Not(q))
        elif name == "Path":
            yield cls(x, "(p|<q){1,3},r+,.*", y, z)
        else:
            given = {f.name: simple.get(f.name, v("a")) for f in fields(cls)}
            if "start" in given:
                given["start"] = 4 if name == "Start" else datetime.date(2024, 1, 1)
            yield cls(**given)


def test_json_round_trip_of_every_node():
    seen = 0
    for node in every_node():
        text = json_form.dumps(node)
        back = json_form.from_json(text)
        assert json_form.dumps(back) == text, text
        assert "null" not in text
        seen += 1
    assert seen > 95
    q = And(Triple(x, "p", 1), A.Eval(A.Add(y, 2), z))
    assert json_form.from_json(json_form.dumps(q)) == q
    assert json_form.from_json({"@type": "Triple", "subject": {"@type": "NodeValue", "variable": "a"}, "predicate": {"@type": "NodeValue", "node": "p"}, "object": {"@type": "Value", "data": {"@type": "xsd:string", "@value": "b"}}, "graph": None}) == Triple(A.Var("a"), "p", "b")
    for bad in ({}, {"@type": "Nothing"}, {"@type": "Not"}, {"@type": "Not", "query": None}, {"@type": "Limit", "limit": 1, "query": {"@type": "True"}, "more": 1}):
        with pytest.raises(json_form.JsonError):
            json_form.from_json(bad)


@pytest.fixture(scope="module")
def shelf(spark, tmp_path_factory):
    """Books with authors (a set), a sequel (a cycle) and chapters (subdocuments)."""
    books = spark.createDataFrame([("b1", "One", ["ann", "bob"], "b2"), ("b2", "Two", ["ann"], "b1"), ("b3", "Three", [], "b3"), ("b4", "Four", None, None)], "id string, title string, authors array<string>, sequel string")
    authors = spark.createDataFrame([("ann", "Ann"), ("bob", "Bob")], "id string, name string")
    chapters = spark.createDataFrame([("c1", "b1", "Intro")], "id string, book string, head string")
    catalog = Catalog().add(
        ClassDef("Author", ("id",), (Property("name", "name"),), lambda: authors, unfoldable=True, strategy="lexical"),
        ClassDef("Book", ("id",), (Property("title", "title"), Property("authors", "authors", link="Author", family="set"), Property("sequel", "sequel", link="Book", family="optional")), lambda: books, unfoldable=True),
        ClassDef("Chapter", ("id",), (Property("head", "head"), Property("book", "book", link="Book")), lambda: chapters, subdocument=True),
    )
    return Session(spark, catalog)


def test_unfolding_cuts_cycles(shelf, spark):
    got = {r.id: json.loads(r.document) for r in shelf.unfold("Book").collect()}
    ann, bob = {"@id": "Author/ann", "@type": "Author", "name": "Ann"}, {"@id": "Author/bob", "@type": "Author", "name": "Bob"}
    assert got["Book/b1"] == {"@id": "Book/b1", "@type": "Book", "title": "One", "authors": [ann, bob], "sequel": {"@id": "Book/b2", "@type": "Book", "title": "Two", "authors": [ann], "sequel": "Book/b1"}}
    assert got["Book/b3"]["sequel"] == "Book/b3" and "sequel" not in got["Book/b4"] and len(got) == 4
    some = spark.createDataFrame([("b2",)], "key string")
    assert [json.loads(r.document)["sequel"]["sequel"] for r in shelf.unfold("Book", some).collect()] == ["Book/b2"]
    flat = [json.loads(r.document) for r in shelf.documents("Book", 1, 2).collect()]
    assert [d["@id"] for d in flat] == ["Book/b2", "Book/b3"] and flat[0]["authors"] == ["Author/ann"]
    with pytest.raises(WorkLimit):
        shelf.unfold("Book", limit=5)
    assert json.loads(shelf.unfold("Chapter").first().document)["book"]["sequel"]["title"] == "Two"


def test_json_documents_are_loaded(shelf, spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), shelf.catalog)
    store.create()
    docs = lambda *xs: spark.createDataFrame([(json.dumps(d),) for d in xs], "document string")
    load = Loader(store)
    load.load(docs({"@type": "Book", "@id": "Book/b9", "title": "Nine", "authors": ["Author/ann", {"@type": "Author", "@id": "Author/cy", "name": "Cy"}], "sequel": {"@id": "Book/b10", "title": "Ten", "authors": []}}))
    s = Session(spark, store=store)
    assert rows(s, Select([x, y], And(Link(x, "authors", y), Triple(x, "title", "Nine")))) == [("Book/b9", "Author/ann"), ("Book/b9", "Author/cy")]
    assert rows(s, Select([y], And(Link(Iri("Book/b9"), "sequel", x), Triple(x, "title", y)))) == [("Ten",)] and rows(s, Select([y], Triple(Iri("Author/cy"), "name", y))) == [("Cy",)]
    same = {"@type": "Author", "@id": "Author/ann", "name": "Anna"}
    with pytest.raises(CatalogError, match="is there"):
        load.load(docs(same))
    load.load(docs(same), replace=True)
    with pytest.raises(CatalogError, match="several"):
        load.load(docs({"@type": "Book", "@id": "Book/m", "title": "M"}, {"@type": "Book", "@id": "Book/m", "title": "M", "sequel": "Book/b1"}))
    load.load(docs({"@type": "Book", "@id": "Book/m", "title": "M"}, {"@type": "Book", "@id": "Book/m", "title": "M", "sequel": "Book/b1"}), merge_repeats=True)
    s = Session(spark, store=store)
    assert rows(s, Select([y], Link(Iri("Book/m"), "sequel", y))) == [("Book/b1",)] and rows(s, Select([y], Triple(Iri("Author/ann"), "name", y))) == [("Anna",)]
    assert {tuple(r) for r in s.entities().collect()} == {("Book", "Book/m")}
    for bad in ({"title": "no type"}, {"@type": "Nothing"}, {"@type": "Book", "title": "no key"}):
        with pytest.raises(CatalogError):
            load.load(docs(bad))


def test_patches(spark):
    before = {"@id": "T/1", "tasks": ["driving", "reading", "shopping", "cleaning", "fishing", "arguing"], "name": "x"}
    after = {"@id": "T/1", "tasks": ["driving", "reading", "climbing", "dining", "travelling", "arguing"], "age": 3}
    swap = lambda a, b: {"@op": "SwapValue", "@before": a, "@after": b}
    p = patches.diff(before, after)
    assert p["tasks"] == {"@op": "CopyList", "@to": 2, "@rest": {"@op": "PatchList", "@patch": [swap("shopping", "climbing"), swap("cleaning", "dining"), swap("fishing", "travelling")], "@rest": {"@op": "KeepList"}}}
    assert p["name"] == swap("x", None) and p["age"] == swap(None, 3) and patches.apply(p, before) == after
    assert patches.diff([0, 1, 2], [0, 1, 2, 3]) == {"@op": "CopyList", "@to": 3, "@rest": {"@op": "SwapList", "@before": [], "@after": [3], "@rest": {"@op": "KeepList"}}}
    assert patches.diff([1], [1]) is None and patches.apply({"name": {"@op": "ForceValue", "@after": "z"}}, before)["name"] == "z"
    with pytest.raises(Conflict):
        patches.apply(p, {**before, "name": "other"})
    import random

    rng = random.Random(3)
    value = lambda d: rng.choice([1, "a", None, True, 2.5]) if d == 0 else rng.choice([[value(d - 1) for _ in range(rng.randint(0, 4))], {k: value(d - 1) or 0 for k in "abc"[: rng.randint(0, 3)]}, 7])
    for _ in range(400):
        a, b = {"v": value(3) or 0}, {"v": value(3) or 0}
        assert patches.apply(patches.diff(a, b), a) == b
    old, new = (spark.createDataFrame(t, "id string, document string") for t in ([("1", '{"a": [1, 2]}'), ("2", '{"b": 1}'), ("3", '{"c": 1}')], [("1", '{"a": [1, 3, 2]}'), ("3", '{"c": 1}'), ("4", '{"d": 1}')]))
    found = patches.diff_documents(old, new)
    assert {r.id for r in found.collect()} == {"1", "2", "4"}
    assert {(r.id, r.document) for r in patches.patch_documents(old, found).collect()} == {(r.id, r.document) for r in new.collect()}


def test_short_names(star):
    now = datetime.datetime(2024, 5, 6, 7, 8)
    assert rows(star, Select([x], sugar.today(x, now))) == [(now,)]
    assert len(rows(star, Select([x], And(Triple(x, "r_name", y), sugar.today_in_between(datetime.datetime(2024, 1, 1), datetime.datetime(2025, 1, 1), now))))) == 5
    assert rows(star, Select([x], And(Triple(r, "r_name", x), sugar.localize(And(Triple(z, "r_name", x), A.Less(x, "B")), x=x)))) == [("AFRICA",), ("AMERICA",), ("ASIA",)][:len(rows(star, Select([x], And(Triple(r, "r_name", x), A.Less(x, "B")))))]
    assert sugar.vars_unique("a") != sugar.vars_unique("a")
    assert rows(star, sugar.query(("?n", "Nation", {"n_name": "?x", "region": Iri("Region/1")}), select="x")) == rows(star, Select([x], And(Triple(n, "n_name", x), Link(n, "region", Iri("Region/1")))))
    assert rows(star, Select([x], sugar.node(r).isa("Region").has("r_name", x).goals())) == rows(star, Select([x], Triple(r, "r_name", x)))
    assert rows(star, Select([x], sugar.date_subtract("2024-03-31", "P10D", x))) == [(datetime.date(2024, 3, 21),)]
    assert sugar.compare(x, ">=", 3) == A.Gte(x, 3) and sugar.star() == Triple(A.Var("Subject"), A.Var("Predicate"), A.Var("Object"))


def test_nuke(spark, sf):
    s = Session(spark, store=queries._store(Session(spark, tpch(spark, sf)), "Region", "Nation"))
    s.write(sugar.nuke(s.catalog))
    assert rows(s, A.Count(IsA(x, "Nation"), k)) == [(0,)] and rows(s, A.Count(IsA(x, "Region"), k)) == [(0,)]


EXTENDED = """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">
 <xs:complexType name="Named"><xs:sequence><xs:element name="title" type="xs:string"/></xs:sequence><xs:attribute name="code" type="xs:int" use="required"/></xs:complexType>
 <xs:group name="dates"><xs:sequence><xs:element name="begin" type="xs:date"/><xs:element name="end" type="xs:date" minOccurs="0"/></xs:sequence></xs:group>
 <xs:attributeGroup name="marks"><xs:attribute name="colour" type="xs:string"/></xs:attributeGroup>
 <xs:complexType name="Price"><xs:simpleContent><xs:extension base="xs:double"><xs:attribute name="unit" type="xs:string"/></xs:extension></xs:simpleContent></xs:complexType>
 <xs:element name="event"><xs:complexType><xs:complexContent><xs:extension base="Named"><xs:sequence><xs:group ref="dates"/><xs:element name="price" type="Price" minOccurs="0"/></xs:sequence><xs:attributeGroup ref="marks"/></xs:extension></xs:complexContent></xs:complexType></xs:element>
</xs:schema>"""


def test_extensions_and_groups_of_an_xml_schema(spark, tmp_path):
    (tmp_path / "e.xml").write_text('<all><event code="1" colour="red"><title>T</title><begin>2024-01-02</begin><price unit="EUR">2.5</price></event><event code="2"><title>U</title><begin>2024-02-03</begin><end>2024-02-04</end></event></all>')
    catalog = Catalog().add(*XmlSchema(EXTENDED).classes(spark, "event", str(tmp_path / "e.xml"), "code"))
    assert [(p.name, p.family) for p in catalog.properties("event").values()] == [("title", "one"), ("code", "one"), ("begin", "one"), ("end", "optional"), ("price", "optional"), ("colour", "optional")]
    got = {e.code: e for e in catalog.get("event").frame().collect()}
    assert got[1].title == "T" and got[1].price._VALUE == 2.5 and got[1].price._unit == "EUR" and got[1].colour == "red" and got[2].end == datetime.date(2024, 2, 4)
    with pytest.raises(CatalogError, match="no type"):
        XmlSchema(EXTENDED.replace('base="Named"', 'base="Missing"')).classes(spark, "event", "x", "code")


def test_two_writers_of_one_head(spark, sf):
    store = queries._store(Session(spark, tpch(spark, sf)), "Region")
    base = store.base("main")
    one = spark.createDataFrame([(50, "A")], "r_regionkey int, r_name string")
    store.insert("Region", one)
    with pytest.raises(Conflict):
        store.write({"Region": store.read("Region", base[1]).unionByName(one)}, base=base)
    assert store.read("Region", store.head("main")).count() == 6 and store.log().count() == 2


def test_changes_of_a_crash_are_logged_by_the_next_write(spark, sf, monkeypatch):
    store = queries._store(Session(spark, tpch(spark, sf)), "Region")
    row = lambda k_: spark.createDataFrame([(k_, "A")], "r_regionkey int, r_name string")
    real = store.log_changes
    monkeypatch.setattr(store, "log_changes", lambda commit, branch: None)
    store.insert("Region", row(50))
    monkeypatch.setattr(store, "log_changes", real)
    store.insert("Region", row(51))
    assert {(e.id, e.action) for e in spark.read.json(f"{store.path}/changes").collect()} == {("Region/50", "added"), ("Region/51", "added")}


def test_handlers(spark, sf, tmp_path):
    from loomgraph.streaming.changes import Handlers

    store = queries._store(Session(spark, tpch(spark, sf)), "Region", "Nation")
    store.insert("Region", spark.createDataFrame([(50, "A")], "r_regionkey int, r_name string"))
    store.update("Region", spark.createDataFrame([(50, "B")], "r_regionkey int, r_name string"))
    store.delete("Nation", spark.createDataFrame([(3,)], "n_nationkey int"))
    seen = {}
    keep = lambda name: lambda df: seen.setdefault(name, []).extend(tuple(e) for e in df.collect())
    h = Handlers(store).on_added_id("Region", keep("ids")).on_added("Region", keep("documents")).on_updated_id("Region", keep("updated")).on_deleted("Nation", keep("deleted")).on_deleted("Region", keep("none")).on_changeset(keep("all"))
    h.run(str(tmp_path / "c"))
    assert seen["ids"] == [("Region/50",)] and seen["updated"] == [("Region/50",)] and seen["deleted"] == [("Nation/3",)] and "none" not in seen and len(seen["all"]) == 3
    assert [t[1:] for t in seen["documents"]] == [(50, "A")] or ("Region/50", 50, "A") in seen["documents"]


def test_paths_between_classes_and_several_queries(star):
    from loomgraph.plans.filters import together

    found = star.model("Customer").query({"c_custkey": {"le": 3}}).path_to("Region", "nation,region")
    assert found.count() == star.run(Select([c, x], And(Triple(c, "c_custkey", k), A.Lte(k, 3), A.hops(c, (">", "nation", n), (">", "region", x))))).count()
    both = together(star.model("Region").query({"r_regionkey": {"eq": 1}}), star.model("Region").query({"r_regionkey": {"gt": 1}}), rest=star.model("Nation"))
    assert {name: df.count() for name, df in both.items()} == {"Region": 1, "Region_2": 3, "rest": 25}


def test_lowering_runs_closures_once(star, monkeypatch):
    from loomgraph.operators import paths

    calls = []
    real = paths.checkpoint
    monkeypatch.setattr(paths, "checkpoint", lambda df: calls.append(1) or real(df))
    star.run(Select([x, y], And(IsA(x, "Nation"), A.Optional(A.Path(x, "region+", y)))))
    once = len(calls)
    calls.clear()
    star.run(Select([x, y], A.Path(x, "region+", y)))
    assert once == len(calls)


def test_registered_modes_have_sql():
    names = [q for q in queries.QUERIES if q not in queries.SQL]
    assert not names and queries_modes is not None


def test_text_form():
    from loomgraph.plans import text_form as T

    q = T.parse('vars($Name) select([$Name, $Age], and(triple($P, "rdf:type", "@schema:Person"), triple($P, "@schema:name", $Name), triple("@schema:Person/1", "age", $Age), greater($Age, 18)))')
    assert q == Select([A.Var("Name"), A.Var("Age")], And(Triple(A.Var("P"), "rdf:type", Iri("Person")), Triple(A.Var("P"), "name", A.Var("Name")), Triple(Iri("Person/1"), "age", A.Var("Age")), A.Greater(A.Var("Age"), 18)))
    both = T.parse('or(eval(plus($x, times(2, 3.5)), $z), order_by([asc($x), desc($y)], opt(path($a, seq(plus(pred("p")), star(inv("q"))), $b))), limit(3, group_by($t, [$k], $g, not(regexp($s, "a.*", $g)))), count(true(), $n), concat([$a, "b", true], $c))')
    assert T.parse(T.render(both)) == both
    for bad in ("and(", "foo()", 'triple($a, "b")', 'triple($a, "b", $c) x', 'limit("a", true())', "select([1], true())"):
        with pytest.raises(T.TextError):
            T.parse(bad)


def test_sql_compares_raw_keys(star):
    q = "SELECT n_name, count(*) AS k FROM customer c JOIN nation ON c.nation = nation.iri WHERE c.c_acctbal > 0 GROUP BY n_name"
    plan = star.sql(q)._jdf.queryExecution().optimizedPlan().toString()
    assert "Nation/" not in plan
    assert sorted(map(tuple, star.sql(q).collect())) == sorted(map(tuple, star.sql(q.replace("c.nation = nation.iri", "concat(c.nation, '') = nation.iri")).collect()))
    kept = star.sql("SELECT * FROM customer c JOIN nation n ON c.nation = n.iri")
    assert kept.columns == ["iri", "c_custkey", "c_name", "c_acctbal", "c_mktsegment", "nation", "iri", "n_nationkey", "n_name", "region"]
    for refused in ("c.nation < n.iri", "n.iri >= c.nation"):
        with pytest.raises(CatalogError, match="no order"):
            star.sql(f"SELECT n_name FROM customer c, nation n WHERE {refused}")


def test_commits_write_deltas(spark, sf, monkeypatch):
    """Random changes of one class against a dict, over the number of deltas that makes it whole again."""
    import random

    from loomgraph.sources import versions

    monkeypatch.setattr(versions, "COMPACT", 3)
    store = queries._store(Session(spark, tpch(spark, sf)), "Region")
    rng = random.Random(5)
    want = {e.r_regionkey: e.r_name for e in store.read("Region", store.head("main")).collect()}
    heads = [(store.head("main"), dict(want))]
    for step in range(7):
        if rng.random() < 0.3 and want:
            key = rng.choice(sorted(want))
            del want[key]
            store.delete("Region", spark.createDataFrame([(key,)], "r_regionkey int"))
        else:
            new = [(rng.randint(0, 9), f"v{step}{n}") for n in range(2)]
            new = list({k_: (k_, t) for k_, t in new}.values())
            want |= dict(new)
            store.update("Region", spark.createDataFrame(new, "r_regionkey int, r_name string"))
        heads.append((store.head("main"), dict(want)))
    chains = [store.manifest(h).tables["Region"].count("+") for h, _ in heads]
    assert max(chains) == 3 and chains.count(0) == 2
    for h, rows_ in heads[::3] + heads[-1:]:
        assert {e.r_regionkey: e.r_name for e in store.read("Region", h).collect()} == rows_
    (a, old), (b, new) = heads[2], heads[4]
    changed = {(f"Region/{k_}", "added" if k_ not in old else "deleted" if k_ not in new else "updated") for k_ in {*old, *new} if old.get(k_) != new.get(k_)}
    assert {(e.id, e.action) for e in store.diff("Region", a, b).collect()} == changed
