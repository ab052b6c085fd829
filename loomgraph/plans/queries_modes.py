"""Registered queries for binding modes, writes and surfaces that the main list doesn't reach, each with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lists
from ..streaming import changes
from . import algebra as A
from .algebra import And, IsA, Iri, Link, Select, Triple, v
from .catalog import Catalog
from .json_form import dumps, from_json
from .queries import _store, ask, cast, frame
from .session import Session
from .shared import shared_folder

r, n, c, o, p, s = v("r n c o p s")
name, total, x, y, z, q, k, t, g = v("name total x y z q k t g")

# -- binding modes
_SECOND = "SELECT 'Region/' || r_regionkey AS r, 'Nation/' || coalesce(a.n_nationkey, b.n_nationkey) AS n, a.n_name AS x, b.n_nationkey AS k FROM region LEFT JOIN nation a ON a.n_regionkey = r_regionkey AND a.n_nationkey < 8 LEFT JOIN nation b ON b.n_regionkey = r_regionkey AND b.n_nationkey > 4 AND (a.n_nationkey IS NULL OR b.n_nationkey = a.n_nationkey)"
ask("optional_chain", Select([r, n, x, k], And(IsA(r, "Region"), A.Optional(And(Link(n, "region", r), Triple(n, "n_name", x), Triple(n, "n_nationkey", q), A.Less(q, 8))), A.Optional(And(Link(n, "region", r), Triple(n, "n_nationkey", k), A.Greater(k, 4))))), _SECOND)
ask("maybe_bound_join", Select([x, y], And(A.Or(And(Triple(n, "n_name", x), Triple(n, "n_nationkey", k), A.Less(k, 3)), A.Member(z, ["one", "two"])), And(Triple(n, "n_nationkey", t), A.Less(t, 5), Triple(n, "n_name", y)))), "SELECT n_name AS x, n_name AS y FROM nation WHERE n_nationkey < 3 UNION ALL SELECT NULL, n_name FROM nation, (VALUES (1), (2)) v(i) WHERE n_nationkey < 5")
ask("triple_slice_open", Select([p, x, y, z], And(A.TripleSlice(p, "p_size", x, 45, y), A.TripleSliceRev(p, "p_size", x, z, 48))), "SELECT 'Part/' || p_partkey AS p, p_size AS x, p_size AS y, p_size AS z FROM part WHERE p_size >= 45 AND p_size < 48")
_RANKED = "SELECT 'Nation/' || c_nationkey AS n, c_acctbal AS x, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS i FROM customer"
_BALANCES = A.OrderBy([(x, "desc"), (c, "asc")], And(Link(c, "nation", n), Triple(c, "c_acctbal", x)))
ask("limit_per_row", Select([n, x], And(IsA(n, "Nation"), A.Limit(2, _BALANCES))), f"SELECT n, x FROM ({_RANKED}) WHERE i <= 2")
ask("start_per_row", Select([n, x], And(IsA(n, "Nation"), A.Start(3, _BALANCES))), f"SELECT n, x FROM ({_RANKED}) WHERE i > 3")
ask("page_per_row", Select([n, x], And(IsA(n, "Nation"), A.Limit(2, A.Start(3, _BALANCES)))), f"SELECT n, x FROM ({_RANKED}) WHERE i BETWEEN 4 AND 5")
ask("group_correlated", Select([name, k, total], And(Triple(n, "n_name", name), A.GroupBy(x, [], g, And(Link(c, "nation", n), Triple(c, "c_acctbal", x))), A.Length(g, k), A.Sum(g, y), A.Eval(A.Floor(y), total))), "SELECT n_name AS name, count(*) AS k, CAST(floor(sum(c_acctbal)) AS BIGINT) AS total FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name", cast(total="long"))
ask("distinct_correlated", Select([n, x], And(IsA(n, "Nation"), A.Distinct([x], Select([x, n], And(Link(c, "nation", n), Triple(c, "c_mktsegment", x)))))), "SELECT DISTINCT 'Nation/' || c_nationkey AS n, c_mktsegment AS x FROM customer")
ask("sum_widens", Select([x, y], And(A.Sum([2000000000, 2000000000], x), A.Sum([9000000000000000000, 9000000000000000000], z), A.Typecast(z, "xsd:string", y))), "SELECT CAST(4000000000 AS BIGINT) AS x, '18000000000000000000' AS y")
ask("triple_ends", Select([x, y], And(A.TripleFirst(p, "p_retailprice", x), A.TripleLast(q, "p_retailprice", y))), "SELECT min(p_retailprice) AS x, max(p_retailprice) AS y FROM part")
ask("between", Select([p, x], And(Triple(p, "p_size", x), A.Between(x, 20, 22))), "SELECT 'Part/' || p_partkey AS p, p_size AS x FROM part WHERE p_size BETWEEN 20 AND 22")
ask("contains_text", Select([x], And(Triple(p, "p_type", x), A.Contains(x, "A"))), "SELECT p_type AS x FROM part WHERE contains(p_type, 'A')")

# -- wrappers, keys, sizes
ask("immediately", Select([x], A.Immediately(Triple(r, "r_name", x))), "SELECT r_name AS x FROM region")
ask("into_instance", Select([x], A.Into("instance", Triple(r, "r_name", x))), "SELECT r_name AS x FROM region")
frame("named_query", lambda s_: s_.run(A.NamedQuery("names", Select([x], Triple(r, "r_name", x)))), "SELECT r_name AS x FROM region")
frame("random_key", lambda s_: s_.run(Select([x], And(IsA(c, "Customer"), A.RandomKey("Customer/", x)))).agg(F.count("x").alias("n"), F.countDistinct("x").alias("different"), F.min(F.col("x").startswith("Customer/").cast("int")).alias("named")), "SELECT count(*) AS n, count(*) AS different, 1 AS named FROM customer")
ask("interval_relation_typed", Select([t, z], And(A.Member(t, ["2024-01-01/2024-01-10", "2024-01-10/2024-02-01", "2024-01-03/2024-01-05", "2024-03-01/2024-03-02"]), A.IntervalRelationTyped(z, t, "2024-01-01/2024-01-10"))), "SELECT * FROM (VALUES ('2024-01-01/2024-01-10', 'equals'), ('2024-01-10/2024-02-01', 'met_by'), ('2024-01-03/2024-01-05', 'during'), ('2024-03-01/2024-03-02', 'after')) v(t, z)")
ask("interval_inclusive", Select([x, y], And(A.IntervalInclusive("2024-02-01", "2024-02-29", g, k), A.Interval(x, y, g))), "SELECT DATE '2024-02-01' AS x, DATE '2024-03-01' AS y")


def size(session: Session) -> DataFrame:
    to = f"{shared_folder(session.spark)}/size-{uuid.uuid4().hex}"
    session.catalog.get("Nation").frame().select("n_name").write.text(to)
    return session.run(A.Size(to, x))


frame("size_of_files", size, "SELECT CAST(sum(length(n_name) + 1) AS BIGINT) AS x FROM nation")


def small(session: Session, *classes: str) -> Session:
    return Session(session.spark, Catalog({k_: session.catalog.get(k_) for k_ in (*classes, "Party")}))


frame("triple_count", lambda s_: small(s_, "Region", "Nation", "Customer", "Order").run(A.TripleCount("instance", k)), """SELECT CAST((SELECT count(*) + count(r_regionkey) + count(r_name) FROM region)
  + (SELECT count(*) + count(n_nationkey) + count(n_name) + count(n_regionkey) FROM nation)
  + (SELECT count(*) + count(c_custkey) + count(c_name) + count(c_nationkey) + count(c_acctbal) + count(c_mktsegment) FROM customer)
  + (SELECT count(*) + count(o_orderkey) + count(o_custkey) + count(o_orderstatus) + count(o_totalprice) + count(o_orderdate) + count(o_orderpriority) FROM orders) AS BIGINT) AS k""")
ask("triple_count_schema", And(A.TripleCount("schema", x), A.From("schema", A.Count(Triple(s, p, o), y)), A.Equals(x, y), A.Eval(A.Minus(x, y), k)), "SELECT 0 AS k", lambda df: df.select(F.col("k").cast("int")))


# -- set operations on lists of the sizes that are timed
def sets(size_: int):
    def run(session: Session) -> DataFrame:
        span = lambda a, b: F.sequence(F.lit(a), F.lit(b - 1))
        rows = session.spark.range(1).select(span(0, size_).alias("a"), span(size_ // 2, size_ + size_ // 2).alias("b"))
        ops = {"u": lists.union, "i": lists.intersection, "d": lists.difference}
        return rows.select(*[F.size(f(F.col("a"), F.col("b"))).alias(m) for m, f in ops.items()])

    return run


for _size in (1_000, 10_000, 100_000):
    frame(f"list_sets_{_size}", sets(_size), f"SELECT CAST({_size + _size // 2} AS INT) AS u, CAST({_size - _size // 2} AS INT) AS i, CAST({_size // 2} AS INT) AS d")


# -- writes
def changed(session: Session) -> DataFrame:
    """What one commit adds and removes, by kind."""
    store = _store(session, "Nation", "Region")
    s_ = Session(session.spark, store=store)
    s_.write(And(Triple(n, "n_name", "NATION_3"), A.AddLink(n, "region", Iri("Region/0")), A.AddData(n, "n_name", "THREE")))
    kinds = [(A.AddedLink, "+link"), (A.AddedData, "+data"), (A.DeletedLink, "-link"), (A.DeletedData, "-data"), (A.AddedTriple, "+"), (A.DeletedTriple, "-")]
    return s_.run(Select([x, p, y, z], A.Or(*[And(kind(x, p, y), A.Equals(z, sign)) for kind, sign in kinds])))


_CHANGED = "SELECT 'Nation/' || n_nationkey AS x, p, y, sign || kind AS z FROM (SELECT *, unnest(['n_name', 'region', 'n_name', 'region']) AS p, unnest(['THREE', 'Region/0', n_name, 'Region/' || n_regionkey]) AS y, unnest(['+', '+', '-', '-']) AS sign, unnest(['data', 'link', 'data', 'link']) AS k FROM nation WHERE n_name = 'NATION_3') t, LATERAL (SELECT unnest([t.k, '']) AS kind) WHERE NOT (p = 'region' AND n_regionkey = 0)"
frame("delta_kinds", changed, _CHANGED)


def edited(session: Session) -> DataFrame:
    """Edges and documents put in, replaced and taken out, a commit each."""
    s_ = Session(session.spark, store=_store(session, "Nation", "Region"))
    s_.write(And(Triple(n, "n_name", x), Link(n, "region", Iri("Region/2")), A.Upper(x, y), A.Concatenate([y, "!"], z), A.AddTriple(n, "n_name", z)))
    s_.write(And(Triple(n, "n_nationkey", k), A.Less(k, 3), Triple(n, "n_name", x), A.DeleteTriple(n, "n_name", x)))
    s_.write(And(Triple(n, "n_nationkey", k), A.Greater(k, 22), Link(n, "region", r), A.DeleteLink(n, "region", r)))
    s_.write(A.UpdateDocument({"@type": "Nation", "@id": Iri("Nation/10"), "n_name": "TEN", "region": Iri("Region/1")}))
    return s_.run(Select([n, x, r], And(IsA(n, "Nation"), A.Optional(Triple(n, "n_name", x)), A.Optional(Link(n, "region", r)))))


frame("edges_edited", edited, "SELECT 'Nation/' || n_nationkey AS n, CASE WHEN n_nationkey = 10 THEN 'TEN' WHEN n_nationkey < 3 THEN NULL WHEN n_regionkey = 2 THEN upper(n_name) || '!' ELSE n_name END AS x, CASE WHEN n_nationkey = 10 THEN 'Region/1' WHEN n_nationkey > 22 THEN NULL ELSE 'Region/' || n_regionkey END AS r FROM nation")


def squashed(session: Session) -> DataFrame:
    """A branch that is squashed, and one that is reset to its first commit."""
    store = _store(session, "Region")
    first = store.head("main")
    row = lambda k_, name_: session.spark.createDataFrame([(k_, name_)], "r_regionkey int, r_name string")
    store.update("Region", row(1, "A"))
    store.update("Region", row(2, "B"))
    store.branch("work")
    store.squash("work")
    store.reset("main", first)
    kept = store.read("Region", store.head("work")).select("r_regionkey", "r_name", F.lit(store.log("work").count()).alias("commits"), F.lit("work").alias("branch"))
    return kept.unionByName(store.read("Region", store.head("main")).select("r_regionkey", "r_name", F.lit(store.log("main").count()).alias("commits"), F.lit("main").alias("branch")))


frame("squash_reset", squashed, "SELECT r_regionkey, CASE r_regionkey WHEN 1 THEN 'A' WHEN 2 THEN 'B' ELSE r_name END AS r_name, 1 AS commits, 'work' AS branch FROM region UNION ALL SELECT r_regionkey, r_name, 1, 'main' FROM region")

# -- the JSON form
_THERE = Select([n, x, k], And(Triple(n, "n_name", name), A.Upper(name, x), A.Count(And(Link(c, "nation", n), A.Data(c, "c_acctbal", y), A.Gte(y, 0.0)), k), A.Not(A.Equals(k, 0))))
frame("json_round_trip", lambda s_: s_.run(from_json(dumps(_THERE))), "SELECT 'Nation/' || n_nationkey AS n, upper(n_name) AS x, count(*) AS k FROM nation JOIN customer ON c_nationkey = n_nationkey AND c_acctbal >= 0 GROUP BY n_nationkey, n_name")

# -- front ends
frame("sparql_distinct_hidden_order", lambda s_: s_.sparql("SELECT DISTINCT ?r WHERE { ?n :region ?r ; :n_name ?a } ORDER BY ?a"), "SELECT DISTINCT 'Region/' || n_regionkey AS r FROM nation")
frame("sparql_minus_apart", lambda s_: s_.sparql("SELECT ?x WHERE { ?r :r_name ?x MINUS { ?n :n_name ?y } }"), "SELECT r_name AS x FROM region")
frame("sparql_minus", lambda s_: s_.sparql("SELECT ?x WHERE { ?n :n_name ?x MINUS { ?n :region <Region/1> } }"), "SELECT n_name AS x FROM nation WHERE n_regionkey <> 1")
frame("sparql_count_unbound", lambda s_: s_.sparql("SELECT ?n (COUNT(?o) AS ?k) (COUNT(*) AS ?all) WHERE { ?n a :Customer . OPTIONAL { ?o :customer ?n . ?o :o_totalprice ?p FILTER(?p > 300000) } } GROUP BY ?n"), "SELECT 'Customer/' || c_custkey AS n, count(o_orderkey) AS k, count(*) AS all FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 300000 GROUP BY c_custkey")
frame("sparql_literals_page", lambda s_: s_.sparql('SELECT ?p ?x WHERE { ?p :p_brand "Brand#11" ; :p_retailprice ?x FILTER(?x >= 910.5 && ?x < 2000.0) } ORDER BY DESC(?x) ?p LIMIT 7 OFFSET 2'), "SELECT 'Part/' || p_partkey AS p, p_retailprice AS x FROM part WHERE p_brand = 'Brand#11' AND p_retailprice >= 910.5 AND p_retailprice < 2000 ORDER BY x DESC, p_partkey LIMIT 7 OFFSET 2")
frame("sql_logic_page", lambda s_: s_.sql("SELECT DISTINCT c_mktsegment, c_nationkey FROM (SELECT c_mktsegment, n.n_nationkey AS c_nationkey, c_acctbal FROM customer c JOIN nation n ON c.nation = n.iri) t WHERE (c_acctbal > 5000 AND NOT c_mktsegment = 'BUILDING') OR c_acctbal < -900 ORDER BY c_mktsegment DESC, c_nationkey LIMIT 12 OFFSET 3"), "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer WHERE (c_acctbal > 5000 AND c_mktsegment <> 'BUILDING') OR c_acctbal < -900 ORDER BY c_mktsegment DESC, c_nationkey LIMIT 12 OFFSET 3")
frame("sql_outer_joins", lambda s_: s_.sql("SELECT a.n_name AS x, b.s_name AS y FROM (SELECT * FROM nation WHERE n_nationkey < 10) a FULL JOIN (SELECT * FROM supplier WHERE s_acctbal > 5000) b ON b.nation = a.iri"), "SELECT n_name AS x, s_name AS y FROM (SELECT * FROM nation WHERE n_nationkey < 10) FULL JOIN (SELECT * FROM supplier WHERE s_acctbal > 5000) ON s_nationkey = n_nationkey")
frame("sql_semi", lambda s_: s_.sql("SELECT n_name AS x FROM nation n LEFT SEMI JOIN (SELECT * FROM customer WHERE c_acctbal > 9900) c ON c.nation = n.iri"), "SELECT n_name AS x FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900)")
frame("sql_columns_compared", lambda s_: s_.sql("SELECT p_name FROM part WHERE p_size = p_partkey OR p_name <> p_name"), "SELECT p_name FROM part WHERE p_size = p_partkey")
frame("xpath_wildcard", lambda s_: s_.xpath('doc("Nation/3")/*'), "SELECT n_name AS result FROM nation WHERE n_nationkey = 3 UNION SELECT CAST(n_nationkey AS VARCHAR) FROM nation WHERE n_nationkey = 3 UNION SELECT 'Region/' || n_regionkey FROM nation WHERE n_nationkey = 3 UNION SELECT 'Nation'")
frame("xpath_descendants", lambda s_: s_.xpath('doc("Order/1")//*'), "SELECT 'Customer/' || o_custkey AS result FROM orders WHERE o_orderkey = 1 UNION SELECT 'Nation/' || c_nationkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey = 1 UNION SELECT 'Region/' || n_regionkey FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE o_orderkey = 1")
frame("path_back_from", lambda s_: s_.run(Select([y], A.Path(Iri("Region/1"), "<region,<nation", y))), "SELECT 'Supplier/' || s_suppkey AS y FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 1 UNION SELECT 'Customer/' || c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1")
_ITEMS = "SELECT 'LineItem/' || l_orderkey || '_' || l_linenumber AS x, {} AS k FROM lineitem JOIN {} WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_quantity = 50 AND l_returnflag = 'R')"
_BY_ORDER, _BY_SUPPLIER = _ITEMS.format("c_nationkey", "orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey"), _ITEMS.format("s_nationkey", "supplier ON s_suppkey = l_suppkey")
frame("path_any_from", lambda s_: s_.run(A.Distinct([x, name], Select([x, name], And(Triple(x, "l_quantity", 50.0), Triple(x, "l_returnflag", "R"), A.Path(x, ".+", y), Triple(y, "n_name", name))))), f"SELECT x, n_name AS name FROM ({_BY_ORDER} UNION {_BY_SUPPLIER}) JOIN nation ON n_nationkey = k")
frame("filter_and_or", lambda s_: s_.model("Nation").query({"region": {"r_name": {"ne": "ASIA"}}, "n_nationkey": {"ge": 3}, "_or": [{"n_name": {"startsWith": "NATION_1"}}, {"n_nationkey": {"eq": 5}}]}).frame().select("id"), "SELECT 'Nation/' || n_nationkey AS id FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name <> 'ASIA' AND n_nationkey >= 3 AND (starts_with(n_name, 'NATION_1') OR n_nationkey = 5)")
frame("instances_by_class", lambda s_: _by_class(s_), "SELECT 'Region' AS cls, count(*) AS n FROM region UNION ALL SELECT 'Nation', count(*) FROM nation UNION ALL SELECT 'Supplier', count(*) FROM supplier")


def _by_class(session: Session) -> DataFrame:
    from .filters import count_by_class

    return count_by_class(small(session, "Region", "Nation", "Supplier"))


frame("window_session", lambda s_: changes.sessions(s_.catalog.get("Event").frame(), "2 hours").select("start", "end", "user_id", "n"), """WITH marked AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 2 HOURS THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
  numbered AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM marked)
  SELECT min(ts) AS start, max(ts) + INTERVAL 2 HOURS AS "end", user_id, count(*) AS n FROM numbered GROUP BY user_id, s""")
frame("text_form", lambda s_: s_.text('select([$x, $k], and(triple($r, "r_name", $x), count(triple($n, "region", $r), $k)))'), "SELECT r_name AS x, count(n_nationkey) AS k FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey, r_name")
frame("sql_raw_keys", lambda s_: s_.sql("SELECT r_name, sum(o.o_totalprice) > 0 AS some FROM region r JOIN nation n ON n.region = r.iri JOIN customer c ON c.nation = n.iri JOIN `order` o ON o.customer = c.iri GROUP BY r_name"), "SELECT r_name, sum(o_totalprice) > 0 AS some FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey GROUP BY r_name")
frame("unfolded", lambda s_: s_.unfold("Nation", classes=("Region",)).select("id", F.get_json_object("document", "$.region.r_name").alias("region"), F.get_json_object("document", "$.n_name").alias("name")), "SELECT 'Nation/' || n_nationkey AS id, r_name AS region, n_name AS name FROM nation JOIN region ON r_regionkey = n_regionkey")
frame("path_to_class", lambda s_: s_.model("Supplier").query({"s_acctbal": {"gt": 9000.0}}).path_to("Region", "nation,region"), "SELECT 'Supplier/' || s_suppkey AS id, 'Region/' || n_regionkey AS target FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_acctbal > 9000")


def loaded(session: Session) -> DataFrame:
    """Documents as JSON, a nested one among them, into a branch."""
    from .documents import Loader

    store = _store(session, "Nation", "Region")
    rows = [('{"@type": "Nation", "@id": "Nation/70", "n_name": "SEVENTY", "region": {"@type": "Region", "@id": "Region/70", "r_name": "NEW"}}',), ('{"@type": "Nation", "@id": "Nation/3", "n_name": "THREE", "region": "Region/0"}',)]
    Loader(store).load(session.spark.createDataFrame(rows, "document string"), replace=True)
    return Session(session.spark, store=store).run(Select([n, x, y], And(Triple(n, "n_name", x), Link(n, "region", r), Triple(r, "r_name", y))))


frame("json_documents", loaded, "SELECT 'Nation/' || n_nationkey AS n, CASE n_nationkey WHEN 3 THEN 'THREE' ELSE n_name END AS x, r_name AS y FROM nation JOIN region ON r_regionkey = CASE n_nationkey WHEN 3 THEN 0 ELSE n_regionkey END UNION ALL SELECT 'Nation/70', 'SEVENTY', 'NEW'")


def patched(session: Session) -> DataFrame:
    """The patches from one version's documents to the next, and the old documents after them."""
    from ..sources.patches import diff_documents, patch_documents

    old = session.catalog.get("Region").frame().select(F.concat(F.lit("Region/"), F.col("r_regionkey")).alias("id"), F.to_json(F.struct(F.split("r_name", "").alias("letters"))).alias("document"))
    new = session.catalog.get("Region").frame().filter("r_regionkey <> 4").select(F.concat(F.lit("Region/"), F.col("r_regionkey")).alias("id"), F.to_json(F.struct(F.split(F.regexp_replace("r_name", "A", "XY"), "").alias("letters"))).alias("document"))
    done = patch_documents(old, diff_documents(old, new))
    return done.select("id", F.array_join(F.from_json("document", "letters array<string>")["letters"], "").alias("name"))


frame("patch_lists", patched, "SELECT 'Region/' || r_regionkey AS id, replace(r_name, 'A', 'XY') AS name FROM region WHERE r_regionkey <> 4")
frame("instances_where", lambda s_: s_.instances("Customer", {"c_mktsegment": "BUILDING", "nation": "Nation/3"}, 5, 2).select("id", "c_name"), "SELECT 'Customer/' || c_custkey AS id, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3 ORDER BY 'Customer/' || c_custkey LIMIT 5 OFFSET 2")
