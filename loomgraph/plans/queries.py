"""The registered queries of the core algebra, each with the same question in SQL."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.versions import Store
from ..streaming import changes
from . import algebra as A
from .algebra import And, IsA, Iri, Link, Select, Triple, Var, v
from .catalog import tpch
from .session import Session
from .shared import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _as_is(df: DataFrame) -> DataFrame:
    return df


def ask(name: str, node, sql: str | None, shape: Callable[[DataFrame], DataFrame] = _as_is) -> None:
    """Registers an algebra query over the star schema; shape casts columns to the types that SQL gives."""
    QUERIES[name] = lambda spark, sf_dir: shape(Session(spark, tpch(spark, sf_dir)).run(node))
    if sql:
        SQL[name] = sql


def frame(name: str, make: Callable[[Session], DataFrame], sql: str | None) -> None:
    QUERIES[name] = lambda spark, sf_dir: make(Session(spark, tpch(spark, sf_dir)))
    if sql:
        SQL[name] = sql


def cast(**types: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def rounded(*names: str, digits: int = 2) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in names})


r, n, c, o, p, s, l, e = v("r n c o p s l e")
name, total, x, y, z, q, d, k, t, g = v("name total x y z q d k t g")

FLAGSHIP = A.Limit(10, A.OrderBy([(total, "desc"), (name, "asc"), (o, "asc")], Select([name, total, o], And(
    IsA(r, "Region"), Triple(r, "r_name", "EUROPE"), Triple(n, "region", r), Triple(c, "nation", n), Triple(c, "c_name", name), Triple(o, "customer", c), Triple(o, "o_totalprice", total)))))

# -- patterns and joins
ask("flagship_europe_orders", FLAGSHIP, "SELECT c_name AS name, o_totalprice AS total, 'Order/' || o_orderkey AS o FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey WHERE r_name = 'EUROPE' ORDER BY total DESC, name, o LIMIT 10")
ask("triple_scan", Select([c, name], Triple(c, "c_name", name)), "SELECT 'Customer/' || c_custkey AS c, c_name AS name FROM customer")
ask("triple_const_object", Select([c, x], And(Triple(c, "c_mktsegment", "BUILDING"), A.Data(c, "c_acctbal", x))), "SELECT 'Customer/' || c_custkey AS c, c_acctbal AS x FROM customer WHERE c_mktsegment = 'BUILDING'")
ask("triple_const_subject", Select([x], Triple(Iri("Nation/3"), "region", x)), "SELECT 'Region/' || n_regionkey AS x FROM nation WHERE n_nationkey = 3")
ask("link_data_kinds", Select([x, y], And(Link(x, "nation", y), A.Not(A.Data(x, "nation", z)))), "SELECT 'Customer/' || c_custkey AS x, 'Nation/' || c_nationkey AS y FROM customer UNION ALL SELECT 'Supplier/' || s_suppkey, 'Nation/' || s_nationkey FROM supplier")
ask("variable_predicate", Select([x, y], Triple(Iri("Nation/5"), x, y)), "SELECT 'rdf:type' AS x, 'Nation' AS y UNION ALL SELECT 'n_nationkey', CAST(n_nationkey AS VARCHAR) FROM nation WHERE n_nationkey = 5 UNION ALL SELECT 'n_name', n_name FROM nation WHERE n_nationkey = 5 UNION ALL SELECT 'region', 'Region/' || n_regionkey FROM nation WHERE n_nationkey = 5")
ask("isa_subsumption", Select([x, t], And(IsA(x, "Party"), Triple(x, "nation", Iri("Nation/7")), A.Subsumption("Customer", t))), "SELECT x, t FROM (SELECT 'Customer/' || c_custkey AS x FROM customer WHERE c_nationkey = 7 UNION ALL SELECT 'Supplier/' || s_suppkey FROM supplier WHERE s_nationkey = 7), (VALUES ('Customer'), ('Party')) v(t)")
ask("isa_generate", Select([t], IsA(Iri("Supplier/1"), t)), "SELECT t FROM (VALUES ('Supplier'), ('Party')) v(t)")
ask("and_star_join", Select([o, x, y, name], And(Triple(o, "o_orderstatus", "F"), Triple(o, "o_totalprice", x), Triple(o, "o_orderpriority", y), Link(o, "customer", c), Triple(c, "c_name", name))), "SELECT 'Order/' || o_orderkey AS o, o_totalprice AS x, o_orderpriority AS y, c_name AS name FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'")
ask("and_chain_join", Select([l, x, name], And(Link(l, "order", o), Link(o, "customer", c), Link(c, "nation", n), Link(n, "region", r), Triple(r, "r_name", "ASIA"), Triple(l, "l_quantity", x), A.Gte(x, 45.0), Triple(n, "n_name", name))), "SELECT 'LineItem/' || l_orderkey || '_' || l_linenumber AS l, l_quantity AS x, n_name AS name FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'ASIA' AND l_quantity >= 45")
ask("from_path_hops", Select([r, l], And(A.hops(r, ("<", "region", n), ("<", "nation", s), ("<", "supplier", l)), Triple(l, "l_returnflag", "R"), Triple(l, "l_quantity", 50.0))), "SELECT 'Region/' || n_regionkey AS r, 'LineItem/' || l_orderkey || '_' || l_linenumber AS l FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey WHERE l_returnflag = 'R' AND l_quantity = 50")
ask("theta_join", Select([x, y], And(Triple(n, "n_name", x), Link(n, "region", r), Triple(Var("m"), "n_name", y), Link(Var("m"), "region", r), A.Less(x, y))), "SELECT a.n_name AS x, b.n_name AS y FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_name < b.n_name")
ask("cross_goal", Select([x, y], And(Triple(r, "r_name", x), A.Member(y, [1, 2, 3]))), "SELECT r_name AS x, y FROM region, (VALUES (1), (2), (3)) v(y)")
# -- control
ask("or_union", Select([x, y], A.Or(And(Triple(c, "c_name", x), Triple(c, "c_acctbal", y), A.Greater(y, 9000.0)), And(Triple(s, "s_name", x), Triple(s, "s_acctbal", y), A.Greater(y, 9000.0)))), "SELECT c_name AS x, c_acctbal AS y FROM customer WHERE c_acctbal > 9000 UNION ALL SELECT s_name, s_acctbal FROM supplier WHERE s_acctbal > 9000")
ask("or_unbound_side", Select([x, y], A.Or(And(Triple(r, "r_name", x)), And(Triple(n, "n_name", y), A.Regexp("_1$", y)))), "SELECT r_name AS x, CAST(NULL AS VARCHAR) AS y FROM region UNION ALL SELECT NULL, n_name FROM nation WHERE n_name LIKE '%\\_1' ESCAPE '\\'")
ask("optional_left", Select([c, o], And(Triple(c, "c_mktsegment", "MACHINERY"), A.Optional(And(Link(o, "customer", c), Triple(o, "o_totalprice", x), A.Greater(x, 300000.0))))), "SELECT 'Customer/' || c_custkey AS c, 'Order/' || o_orderkey AS o FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 300000 WHERE c_mktsegment = 'MACHINERY'")
ask("not_anti", Select([c], And(IsA(c, "Customer"), A.Not(And(Link(o, "customer", c), Triple(o, "o_totalprice", x), A.Greater(x, 100000.0))))), "SELECT 'Customer/' || c_custkey AS c FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 100000)")
ask("if_then_else", Select([n, x], And(IsA(n, "Nation"), A.If(Link(n, "region", Iri("Region/2")), A.Equals(x, "asia"), A.Equals(x, "elsewhere")))), "SELECT 'Nation/' || n_nationkey AS n, CASE WHEN n_regionkey = 2 THEN 'asia' ELSE 'elsewhere' END AS x FROM nation")
ask("once_per_row", Select([n, x], And(IsA(n, "Nation"), A.Once(A.OrderBy([(x, "desc")], And(Link(c, "nation", n), Triple(c, "c_acctbal", x)))))), "SELECT 'Nation/' || c_nationkey AS n, max(c_acctbal) AS x FROM customer GROUP BY c_nationkey")
ask("select_hides", Select([x, c], And(Triple(c, "c_mktsegment", "AUTOMOBILE"), Select([x], And(Triple(Var("h"), "r_name", x), A.Less(x, "B"))))), "SELECT r_name AS x, 'Customer/' || c_custkey AS c FROM customer, region WHERE c_mktsegment = 'AUTOMOBILE' AND r_name < 'B'")
ask("select_distinct", A.Distinct([x, y], Select([x, y], And(Triple(o, "o_orderstatus", x), Triple(o, "o_orderpriority", y)))), "SELECT DISTINCT o_orderstatus AS x, o_orderpriority AS y FROM orders")
ask("distinct_subset", Select([x, y], A.Distinct([x], Select([x, y], And(Triple(o, "o_orderpriority", x), Triple(o, "o_orderkey", y))))), "SELECT o_orderpriority AS x, min(o_orderkey) AS y FROM orders GROUP BY 1")
ask("order_limit_start", A.Limit(20, A.Start(10, A.OrderBy([(x, "desc"), (o, "asc")], Select([o, x], Triple(o, "o_totalprice", x))))), "SELECT 'Order/' || o_orderkey AS o, o_totalprice AS x FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 10")
ask("true_comment_pin", Select([x], And(A.TrueGoal(), A.Comment("unused", Triple(c, "c_name", x)), A.Pin(Triple(r, "r_name", x)))), "SELECT r_name AS x FROM region")
ask("from_schema", Select([x, y], A.From("schema", Triple(x, "rdfs:subClassOf", y))), "SELECT * FROM (VALUES ('Customer', 'Party'), ('Supplier', 'Party')) v(x, y)")
# -- comparison, ranges, neighbours
ask("compare_ops", Select([p, x], And(Triple(p, "p_size", x), A.Gte(x, 10), A.Lte(x, 20), A.NotEquals(x, 15), A.Not(A.Greater(x, 18)))), "SELECT 'Part/' || p_partkey AS p, p_size AS x FROM part WHERE p_size BETWEEN 10 AND 18 AND p_size <> 15")
ask("in_range", Select([p, x], And(Triple(p, "p_retailprice", x), A.InRange(x, 910.0, 1000.0))), "SELECT 'Part/' || p_partkey AS p, p_retailprice AS x FROM part WHERE p_retailprice >= 910 AND p_retailprice < 1000")
ask("triple_slice", Select([o, x], A.TripleSlice(o, "o_orderdate", x, datetime.datetime(1995, 1, 1), datetime.datetime(1995, 4, 1))), "SELECT 'Order/' || o_orderkey AS o, o_orderdate AS x FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1995-04-01'")
ask("triple_slice_rev", A.Limit(15, A.OrderBy([(x, "desc"), (o, "asc")], Select([o, x], A.TripleSliceRev(o, "o_totalprice", x, 1000.0, None)))), "SELECT 'Order/' || o_orderkey AS o, o_totalprice AS x FROM orders WHERE o_totalprice >= 1000 ORDER BY x DESC, o LIMIT 15")


def neighbours(kind: type) -> Callable[[SparkSession, str], DataFrame]:
    """Order dates as a multi-valued property of customers: each date with the next or the one before."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from .catalog import Catalog, ClassDef, Property

        base = tpch(spark, sf_dir)
        dated = lambda: base.get("Order").frame().groupBy("o_custkey").agg(F.collect_set("o_orderdate").alias("dates"))
        catalog = Catalog().add(ClassDef("Buyer", ("o_custkey",), (Property("date", "dates", "dateTime", family="set"),), dated))
        return Session(spark, catalog).run(Select([c, x, y], kind(c, "date", x, y)))

    return run


QUERIES["triple_next"] = neighbours(A.TripleNext)
SQL["triple_next"] = "SELECT * FROM (SELECT 'Buyer/' || o_custkey AS c, x, lead(x) OVER (PARTITION BY o_custkey ORDER BY x) AS y FROM (SELECT DISTINCT o_custkey, o_orderdate AS x FROM orders)) WHERE y IS NOT NULL"
QUERIES["triple_previous"] = neighbours(A.TriplePrevious)
SQL["triple_previous"] = "SELECT * FROM (SELECT 'Buyer/' || o_custkey AS c, x, lag(x) OVER (PARTITION BY o_custkey ORDER BY x) AS y FROM (SELECT DISTINCT o_custkey, o_orderdate AS x FROM orders)) WHERE y IS NOT NULL"
# -- aggregation
ask("count_global", A.Count(And(Triple(o, "o_orderstatus", "O")), k), "SELECT count(*) AS k FROM orders WHERE o_orderstatus = 'O'")
ask("count_correlated", Select([n, k], And(IsA(n, "Nation"), A.Count(And(Link(c, "nation", n), Triple(c, "c_mktsegment", "BUILDING")), k))), "SELECT 'Nation/' || n_nationkey AS n, count(c_custkey) AS k FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_mktsegment = 'BUILDING' GROUP BY n_nationkey")
ask("group_by_sum", Select([x, y, total, k], And(A.GroupBy(q, [x, y], g, And(Triple(l, "l_returnflag", x), Triple(l, "l_linestatus", y), Triple(l, "l_quantity", q))), A.Sum(g, total), A.Length(g, k))), "SELECT l_returnflag AS x, l_linestatus AS y, sum(l_quantity) AS total, count(*) AS k FROM lineitem GROUP BY 1, 2")
ask("group_by_minmax", Select([x, y, z], And(A.GroupBy(q, [x], g, And(Triple(p, "p_brand", x), Triple(p, "p_retailprice", q))), A.RangeMin(g, y), A.RangeMax(g, z))), "SELECT p_brand AS x, min(p_retailprice) AS y, max(p_retailprice) AS z FROM part GROUP BY 1")
ask("revenue_by_flag", Select([x, total], And(A.GroupBy(y, [x], g, And(Triple(l, "l_returnflag", x), Triple(l, "l_extendedprice", p), Triple(l, "l_discount", d), A.Eval(A.Mul(p, A.Minus(1.0, d)), y))), A.Sum(g, total))), "SELECT l_returnflag AS x, round(sum(l_extendedprice * (1 - l_discount)), 0) AS total FROM lineitem GROUP BY 1", rounded("total", digits=0))
ask("collect_list_len", Select([x, k], And(A.GroupBy([n, name], [x], g, And(Link(n, "region", r), Triple(r, "r_name", x), Triple(n, "n_name", name))), A.Length(g, k))), "SELECT r_name AS x, count(*) AS k FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY 1")
ask("collect_all", Select([x], And(A.Collect(name, g, Triple(r, "r_name", name)), A.ListToSet(g, y), A.Join(y, "|", x))), "SELECT string_agg(r_name, '|' ORDER BY r_name) AS x FROM region")
ask("group_flat_list", Select([x, y], And(A.GroupBy(name, [x], g, And(Link(n, "region", x), Triple(n, "n_name", name))), A.ListToSet(g, z), A.Join(z, ",", y))), "SELECT 'Region/' || n_regionkey AS x, string_agg(n_name, ',' ORDER BY n_name) AS y FROM nation GROUP BY n_regionkey")
# -- arithmetic and types
ask("eval_arith", Select([l, x, y, z], And(Triple(l, "l_quantity", 10.0), Triple(l, "l_extendedprice", p), Triple(l, "l_discount", d), Triple(l, "l_tax", t), A.Eval(A.Mul(A.Mul(p, A.Minus(1.0, d)), A.Add(1.0, t)), x), A.Eval(A.Floor(A.Divide(p, 7.0)), y), A.Eval(A.Exp(A.Add(d, 1.0), 2), z))), "SELECT 'LineItem/' || l_orderkey || '_' || l_linenumber AS l, round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 2) AS x, CAST(floor(l_extendedprice / 7.0) AS BIGINT) AS y, round(pow(l_discount + 1, 2), 6) AS z FROM lineitem WHERE l_quantity = 10", lambda df: df.withColumns({"x": F.round("x", 2), "y": F.col("y").cast("long"), "z": F.round("z", 6)}))
ask("eval_integer", Select([p, x, y], And(Triple(p, "p_size", q), A.Eval(A.Minus(q, 25), z), A.Eval(A.Div(z, 7), x), A.Eval(A.Divide(z, 8), y))), "SELECT 'Part/' || p_partkey AS p, CAST(trunc((p_size - 25) / 7) AS BIGINT) AS x, (p_size - 25) / 8.0 AS y FROM part", cast(y="double"))
ask("typecast_fail_drops", Select([n, x], And(Triple(n, "n_name", name), A.Split(name, "_", g), A.Slice(g, 1, None, z), A.Member(y, z), A.Typecast(y, "xsd:integer", x), A.Greater(x, 4))), "SELECT 'Nation/' || n_nationkey AS n, CAST(split_part(n_name, '_', 2) AS BIGINT) AS x FROM nation WHERE TRY_CAST(split_part(n_name, '_', 2) AS BIGINT) > 4")
ask("type_of", Select([x, y], And(Triple(Iri("Order/1"), "o_totalprice", z), A.TypeOf(z, x), A.TypeOf(5, y))), "SELECT 'xsd:double' AS x, 'xsd:int' AS y FROM orders WHERE o_orderkey = 1")
ask("dot_json", Select([e, x], And(Triple(e, "props", z), A.Dot(z, "k", y), A.Typecast(y, "xsd:integer", x), A.Gte(x, 90))), "SELECT 'Event/' || event_id AS e, CAST(json_extract_string(props, '$.k') AS BIGINT) AS x FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) >= 90")
ask("dict_template", Select([x], And(A.GroupBy(A.Dict([("name", name), ("n", n)]), [r], g, And(Link(n, "region", r), Triple(n, "n_name", name))), A.Member(d, g), A.Dot(d, "name", x))), "SELECT n_name AS x FROM nation")
# -- strings
ask("string_ops", Select([name, x, y, z, t], And(Triple(p, "p_name", name), A.Upper(name, x), A.Lower(x, y), A.Pad(name, "*", 30, z), A.Trim("  \t a b \n", t))), "SELECT p_name AS name, upper(p_name) AS x, lower(p_name) AS y, CASE WHEN length(p_name) < 30 THEN rpad(p_name, 30, '*') ELSE p_name END AS z, 'a b' AS t FROM part")
ask("regexp_groups", Select([name, x], And(Triple(c, "c_name", name), A.Regexp("^([A-Z][a-z]+)#0*([0-9]*5)$", name, g), A.Join(g, "/", x))), "SELECT c_name AS name, c_name || '/' || regexp_extract(c_name, '^([A-Z][a-z]+)#0*([0-9]*5)$', 1) || '/' || regexp_extract(c_name, '^([A-Z][a-z]+)#0*([0-9]*5)$', 2) AS x FROM customer WHERE regexp_matches(c_name, '^([A-Z][a-z]+)#0*([0-9]*5)$')")
ask("starts_ends_contains", Select([x], And(Triple(p, "p_type", x), A.Or(A.StartsWith(x, "S"), A.EndsWith(x, "L")))), "SELECT p_type AS x FROM part WHERE starts_with(p_type, 'S') UNION ALL SELECT p_type FROM part WHERE ends_with(p_type, 'L')")
ask("like_similarity", Select([x, y, z], And(Triple(r, "r_name", x), Triple(Var("m"), "r_name", y), A.Less(x, y), A.Like(x, y, z))), "SELECT a.r_name AS x, b.r_name AS y, 1 - 2.0 * levenshtein(a.r_name, b.r_name) / greatest(length(a.r_name), length(b.r_name)) AS z FROM region a JOIN region b ON a.r_name < b.r_name", cast(z="double"))
ask("split_join", Select([x, y, z], And(Triple(p, "p_name", x), A.Split(x, " ", g), A.Join(g, "+", y), A.Concatenate([x, "!", y], z))), "SELECT p_name AS x, replace(p_name, ' ', '+') AS y, p_name || '!' || replace(p_name, ' ', '+') AS z FROM part")
ask("substring_modes", Select([name, x, y, z], And(Triple(r, "r_name", name), A.Substring(name, x, 1, y, "A"), A.Substring(name, 1, 2, k, z))), "SELECT r_name AS name, i AS x, length(r_name) - i - 1 AS y, substr(r_name, 2, 2) AS z FROM region, (SELECT unnest(range(0, 20)) AS i) WHERE substr(r_name, i + 1, 1) = 'A'", cast(x="long", y="long"))
ask("substring_generate", Select([x, y, z], And(A.Substring("abc", x, y, k, z))), "SELECT i AS x, j AS y, substr('abc', CAST(i AS INT) + 1, CAST(j AS INT)) AS z FROM (SELECT unnest(range(0, 4)) AS i), (SELECT unnest(range(0, 4)) AS j) WHERE i + j <= 3", cast(x="long", y="long"))
ask("keys_lexical_hash", Select([x, y], And(Triple(n, "n_name", name), Triple(n, "n_nationkey", k), A.LexicalKey("Nation/", [name, k, "a b"], x), A.HashKey("Nation/", [name], y))), "SELECT 'Nation/' || n_name || '_' || n_nationkey || '_a%20b' AS x, 'Nation/' || sha256(n_name) AS y FROM nation")
# -- lists
ask("list_sets", Select([x, y, z, t], And(A.SetUnion([3, 1, 2], [3, 4], x), A.SetIntersection([3, 2, 1], [2, 3, 4], y), A.SetDifference([1, 2, 3], [2], z), A.ListToSet([2, 1, 1, 3], t))), "SELECT [1, 2, 3, 4] AS x, [2, 3] AS y, [1, 3] AS z, [1, 2, 3] AS t")
ask("member_explode", Select([x, y], And(A.GroupBy(t, [x], g, And(Triple(e, "role", t), Triple(e, "conv_id", x))), A.ListToSet(g, z), A.Member(y, z))), "SELECT DISTINCT conv_id AS x, role AS y FROM conversations")
ask("member_test", Select([x], And(Triple(r, "r_name", x), A.Member(x, ["ASIA", "EUROPE"]), A.SetMember("b", ["a", "b"]))), "SELECT r_name AS x FROM region WHERE r_name IN ('ASIA', 'EUROPE')")
ask("slice_negative", Select([x, y, z], And(A.Slice([10, 20, 30, 40], 1, 3, x), A.Slice([10, 20, 30, 40], -2, None, y), A.Slice([10, 20, 30, 40], 0, -1, z))), "SELECT [20, 30] AS x, [30, 40] AS y, [10, 20, 30] AS z")
ask("list_aggregates", Select([x, y, z, t], And(A.Sum([1, 2, 3], x), A.Length([1, 2, 3], y), A.RangeMin([3, 1], z), A.RangeMax([3, 1], t))), "SELECT 6 AS x, 3 AS y, 1 AS z, 3 AS t", cast(x="int", y="int"))
ask("sequence_int", Select([x], A.Sequence(x, 3, 30, 4)), "SELECT unnest(range(3, 30, 4)) AS x")
ask("sequence_date", Select([x], A.Sequence(x, "2024-02-26", "2024-03-03")), "SELECT CAST(unnest(generate_series(TIMESTAMP '2024-02-26', TIMESTAMP '2024-03-02', INTERVAL 1 DAY)) AS DATE) AS x")
ask("sequence_month_decimal", Select([x, y], A.Or(A.Sequence(x, "2023-11", "2024-02"), And(A.Sequence(z, 0, 1, 0.3), A.Eval(A.Mul(z, 10), t), A.Typecast(t, "xsd:integer", y)))), "SELECT unnest(['2023-11', '2023-12', '2024-01']) AS x, CAST(NULL AS BIGINT) AS y UNION ALL SELECT NULL, unnest([0, 3, 6, 9])")
ask("sequence_match", Select([x], And(Triple(p, "p_size", x), A.Sequence(x, 0, 50, 10))), "SELECT p_size AS x FROM part WHERE p_size IN (0, 10, 20, 30, 40)")
# -- dates
ask("day_ops", Select([x, y, z], And(Triple(o, "o_orderdate", d), A.Typecast(d, "xsd:date", x), A.DayAfter(x, y), A.DayBefore(x, z))), "SELECT CAST(o_orderdate AS DATE) AS x, CAST(o_orderdate AS DATE) + 1 AS y, CAST(o_orderdate AS DATE) - 1 AS z FROM orders")
ask("month_bounds", Select([t, x, y], And(A.Member(t, ["2024-02", "2023-02", "1900-02", "2000-02", "2024-12"]), A.MonthStartDate(t, x), A.MonthEndDate(t, y))), "SELECT t, CAST(t || '-01' AS DATE) AS x, last_day(CAST(t || '-01' AS DATE)) AS y FROM (VALUES ('2024-02'), ('2023-02'), ('1900-02'), ('2000-02'), ('2024-12')) v(t)")
ask("month_starts_ends", Select([x, y], A.Or(A.MonthStartDates(x, "2024-01-15", "2024-05-01"), A.MonthEndDates(y, "2024-01-31", "2024-04-30"))), "SELECT unnest([DATE '2024-02-01', DATE '2024-03-01', DATE '2024-04-01']) AS x, CAST(NULL AS DATE) AS y UNION ALL SELECT NULL, unnest([DATE '2024-01-31', DATE '2024-02-29', DATE '2024-03-31'])")
ask("iso_week_day", Select([x, y, z, t, k], And(Triple(o, "o_orderdate", d), A.Typecast(d, "xsd:date", x), A.IsoWeek(x, y, z), A.Weekday(x, t), A.WeekdaySundayStart(x, k))), "SELECT CAST(o_orderdate AS DATE) AS x, CAST(week(o_orderdate) AS INT) AS y, CAST(isoyear(o_orderdate) AS INT) AS z, CAST(isodow(o_orderdate) AS INT) AS t, CAST(dayofweek(o_orderdate) + 1 AS INT) AS k FROM orders")
ask("date_duration_eom", Select([x, y], And(A.Member(t, ["2020-01-31", "2020-02-29", "2021-01-31", "2020-04-30", "2020-01-15"]), A.Typecast(t, "xsd:date", x), A.DateDuration(x, "P1M", y))), "SELECT * FROM (VALUES (DATE '2020-01-31', DATE '2020-02-29'), (DATE '2020-02-29', DATE '2020-03-31'), (DATE '2021-01-31', DATE '2021-02-28'), (DATE '2020-04-30', DATE '2020-05-31'), (DATE '2020-01-15', DATE '2020-02-15')) v(x, y)")
ask("date_duration_modes", Select([x, y, z], And(Triple(o, "o_orderdate", d), A.Typecast(d, "xsd:date", x), A.DateDuration("1990-01-01", y, x), A.DateDuration(z, "P10D", x))), "SELECT CAST(o_orderdate AS DATE) AS x, 'P' || (CAST(o_orderdate AS DATE) - DATE '1990-01-01') || 'D' AS y, CAST(o_orderdate AS DATE) - 10 AS z FROM orders")
ask("intervals", Select([x, y, z], And(A.Member(t, ["2024-01-01", "2024-01-31"]), A.IntervalStartDuration(t, "P1M", g), A.Interval(x, y, g), A.IntervalDurationEnd("P1D", "2024-03-01", q), A.Interval(z, k, q))), "SELECT * FROM (VALUES (DATE '2024-01-01', DATE '2024-02-01', DATE '2024-02-29'), (DATE '2024-01-31', DATE '2024-02-29', DATE '2024-02-29')) v(x, y, z)")
ask("allen_relations", Select([x, y, z], And(A.Sequence(x, 0, 6), A.Sequence(y, 1, 7), A.Less(x, y), A.IntervalRelation(z, x, y, 2, 4))), "SELECT x, y, CASE WHEN x = 2 AND y = 4 THEN 'equals' WHEN y < 2 THEN 'before' WHEN x > 4 THEN 'after' WHEN y = 2 THEN 'meets' WHEN x = 4 THEN 'met_by' WHEN x = 2 AND y < 4 THEN 'starts' WHEN x = 2 THEN 'started_by' WHEN y = 4 AND x > 2 THEN 'finishes' WHEN y = 4 THEN 'finished_by' WHEN x > 2 AND y < 4 THEN 'during' WHEN x < 2 AND y > 4 THEN 'contains' WHEN x < 2 THEN 'overlaps' ELSE 'overlapped_by' END AS z FROM (SELECT unnest(range(0, 6)) AS x), (SELECT unnest(range(1, 7)) AS y) WHERE x < y")
ask("allen_filter", Select([o], And(Triple(o, "o_orderdate", x), A.DayAfter(x, y), A.IntervalRelation("during", x, y, "1996-01-01", "1996-02-01"))), "SELECT 'Order/' || o_orderkey AS o FROM orders WHERE CAST(o_orderdate AS TIMESTAMP) > TIMESTAMP '1996-01-01' AND CAST(o_orderdate AS DATE) + 1 < DATE '1996-02-01'")
# -- paths
_TREE = "WITH RECURSIVE e AS (SELECT 'Nation/' || n_nationkey AS s, 'Region/' || n_regionkey AS o FROM nation UNION ALL SELECT 'Supplier/' || s_suppkey, 'Nation/' || s_nationkey FROM supplier UNION ALL SELECT 'Customer/' || c_custkey, 'Nation/' || c_nationkey FROM customer), p AS (SELECT s, o FROM e UNION SELECT p.s, e.o FROM p JOIN e ON p.o = e.s) "
ask("path_closure", Select([x, y], A.Path(x, "(nation|region)+", y)), _TREE + "SELECT s AS x, o AS y FROM p")
ask("path_star_from", Select([y], A.Path(Iri("Supplier/1"), "(nation|region)*", y)), _TREE + "SELECT 'Supplier/1' AS y UNION SELECT o FROM p WHERE s = 'Supplier/1'")
ask("path_or_seq", Select([x, y], A.Path(x, "nation,region", y)), "SELECT DISTINCT 'Supplier/' || s_suppkey AS x, 'Region/' || n_regionkey AS y FROM supplier JOIN nation ON s_nationkey = n_nationkey UNION SELECT 'Customer/' || c_custkey, 'Region/' || n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey")
ask("path_inverse", Select([x, y], A.Path(x, "<region,<nation", y)), "SELECT DISTINCT 'Region/' || n_regionkey AS x, 'Supplier/' || s_suppkey AS y FROM supplier JOIN nation ON s_nationkey = n_nationkey UNION SELECT 'Region/' || n_regionkey, 'Customer/' || c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey")
ask("path_times", Select([x, y], And(A.Path(x, "(nation|region){1,2}", y), IsA(x, "Supplier"))), "SELECT 'Supplier/' || s_suppkey AS x, 'Nation/' || s_nationkey AS y FROM supplier UNION SELECT 'Supplier/' || s_suppkey, 'Region/' || n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey")
ask("path_edges", Select([y, k], And(A.Path(Iri("Supplier/2"), "(nation|region)+", y, g), A.Length(g, k))), "SELECT 'Nation/' || s_nationkey AS y, 1 AS k FROM supplier WHERE s_suppkey = 2 UNION ALL SELECT 'Region/' || n_regionkey, 2 FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey = 2", cast(k="int"))


# -- named queries, documents, sources
def named(session: Session) -> DataFrame:
    session.define(A.NamedParametricQuery("in_region", ["where", "who"], And(Triple(r, "r_name", Var("where")), Link(n, "region", r), Triple(n, "n_name", Var("who")))))
    return session.run(Select([x], A.Call("in_region", ["AFRICA", x])))


frame("named_call", named, "SELECT n_name AS x FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'AFRICA'")


def recursive(session: Session) -> DataFrame:
    up = A.Or(Link(Var("a"), "nation", Var("b")), Link(Var("a"), "region", Var("b")))
    session.define(A.NamedParametricQuery("above", ["a", "b"], A.Or(up, And(A.Or(Link(Var("a"), "nation", Var("m")), Link(Var("a"), "region", Var("m"))), A.Call("above", [Var("m"), Var("b")])))))
    return session.run(Select([x, y], A.Call("above", [x, y])))


frame("named_recursive", recursive, _TREE + "SELECT s AS x, o AS y FROM p")
ask("read_document", Select([x, y], And(IsA(n, "Nation"), A.ReadDocument(n, d, 1), A.Dot(d, "n_name", x), A.Dot(d, "region.r_name", y))), "SELECT n_name AS x, r_name AS y FROM nation JOIN region ON r_regionkey = n_regionkey")


def csv_get(session: Session) -> DataFrame:
    to = f"{shared_folder(session.spark)}/csv-{uuid.uuid4().hex}"
    session.catalog.get("Nation").frame().select("n_name", "n_regionkey").write.option("header", True).csv(to)
    return session.run(Select([x, y], A.Get([("n_name", x, None), (1, y, "xsd:long")], to, True)))


frame("csv_get", csv_get, "SELECT n_name AS x, CAST(n_regionkey AS BIGINT) AS y FROM nation")

# -- front ends
frame("sql_join_left", lambda s_: s_.sql("SELECT customer.c_name, orders.o_totalprice FROM customer LEFT JOIN \"order\" AS orders ON orders.customer = customer.iri WHERE customer.c_acctbal > 9500".replace('"order"', "`order`")), "SELECT c_name, o_totalprice FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE c_acctbal > 9500")
frame("sql_aggregate", lambda s_: s_.sql("SELECT nation.n_name, count(*) AS n, max(c.c_acctbal) AS top FROM customer c JOIN nation ON c.nation = nation.iri GROUP BY nation.n_name"), "SELECT n_name, count(*) AS n, max(c_acctbal) AS top FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
frame("sparql_optional_union", lambda s_: s_.sparql('SELECT ?name ?total WHERE { ?c a :Customer ; :c_name ?name ; :c_acctbal ?b . FILTER(?b > 9000 && ?b < 9900) OPTIONAL { ?o :customer ?c . ?o :o_totalprice ?total . FILTER(?total > 400000) } }'), "SELECT c_name AS name, o_totalprice AS total FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 400000 WHERE c_acctbal > 9000 AND c_acctbal < 9900")
frame("sparql_union_path", lambda s_: s_.sparql('SELECT DISTINCT ?r WHERE { { <Supplier/1> :nation/:region ?r } UNION { <Customer/1> :nation/:region ?r } } ORDER BY ?r'), "SELECT 'Region/' || n_regionkey AS r FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_suppkey = 1 UNION SELECT 'Region/' || n_regionkey FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey = 1")
frame("sparql_group", lambda s_: s_.sparql('SELECT ?seg (COUNT(?c) AS ?n) WHERE { ?c :c_mktsegment ?seg } GROUP BY ?seg'), "SELECT c_mktsegment AS seg, count(*) AS n FROM customer GROUP BY 1")
frame("xpath_steps", lambda s_: s_.xpath('doc("Customer/7")/nation/region/r_name'), "SELECT r_name AS result FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_custkey = 7")
frame("xpath_predicate", lambda s_: s_.xpath('Customer[c_acctbal > 9900][nation/n_name != "NATION_1"]/c_name | Region/r_name'), "SELECT DISTINCT c_name AS result FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 9900 AND n_name <> 'NATION_1' UNION ALL SELECT r_name FROM region")
frame("xpath_descendant", lambda s_: s_.xpath('doc("Customer/7")//r_name'), "SELECT r_name AS result FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_custkey = 7")
frame("filter_terms", lambda s_: s_.model("Document").query({"_or": [{"text": {"allOfTerms": ["license", "Version"]}}, {"source": {"startsWith": "src1"}}], "_not": {"lang": {"eq": "en"}}, "n_chars": {"ge": 500}}).frame().select("id", "lang"), "SELECT 'Document/' || doc_id AS id, lang FROM documents WHERE ((contains(text, 'license') AND contains(text, 'Version')) OR starts_with(source, 'src1')) AND lang <> 'en' AND n_chars >= 500")
frame("filter_link", lambda s_: s_.model("Order").query({"customer": {"nation": {"region": {"r_name": {"eq": "AMERICA"}}}}, "o_totalprice": {"gt": 450000.0}}).frame().select("id", "customer"), "SELECT 'Order/' || o_orderkey AS id, 'Customer/' || o_custkey AS customer FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'AMERICA' AND o_totalprice > 450000")
frame("relation_topk", lambda s_: s_.model("Customer").query({"c_mktsegment": {"eq": "HOUSEHOLD"}}).with_via("Order", "customer", name="orders", order=("-o_totalprice",), limit=2).frame().select("id", F.explode("orders").alias("o")).select("id", F.col("o.id").alias("o"), F.col("o.o_totalprice").alias("x")), "SELECT * EXCLUDE (n) FROM (SELECT 'Customer/' || c_custkey AS id, 'Order/' || o_orderkey AS o, o_totalprice AS x, row_number() OVER (PARTITION BY c_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_mktsegment = 'HOUSEHOLD') WHERE n <= 2")
frame("relation_forward", lambda s_: s_.model("Nation").with_field("region", name="at", nested=()).frame().select("id", F.col("at")[0]["r_name"].alias("x")), "SELECT 'Nation/' || n_nationkey AS id, r_name AS x FROM nation JOIN region ON r_regionkey = n_regionkey")
frame("ordered_page", lambda s_: s_.model("Part").ordered("-p_retailprice", "p_name").offset(5).limit(10).frame().select("id", "p_retailprice"), "SELECT 'Part/' || p_partkey AS id, p_retailprice FROM part ORDER BY p_retailprice DESC, p_name, p_partkey LIMIT 10 OFFSET 5")


# -- versions and streams
def _store(session: Session, *classes: str) -> Store:
    from .catalog import Catalog

    some = Catalog({k: session.catalog.get(k) for k in (*classes, "Party")})
    store = Store(session.spark, f"{shared_folder(session.spark)}/store-{uuid.uuid4().hex}", some)
    store.create()
    return store


def delta(session: Session) -> DataFrame:
    store = _store(session, "Region")
    old = store.read("Region", store.head("main"))
    commit = store.write({"Region": old.withColumn("r_name", F.when(F.col("r_regionkey") == 2, F.lit("Asia")).otherwise(F.col("r_name")))})
    s_ = Session(session.spark, store=store)
    assert s_.commit == commit
    return s_.run(Select([x, y, z], A.Or(And(A.AddedTriple(x, "r_name", y), A.Equals(z, "+")), And(A.DeletedTriple(x, "r_name", y), A.Equals(z, "-")))))


frame("delta_added_deleted", delta, "SELECT 'Region/' || r_regionkey AS x, 'Asia' AS y, '+' AS z FROM region WHERE r_regionkey = 2 UNION ALL SELECT 'Region/' || r_regionkey, r_name, '-' FROM region WHERE r_regionkey = 2")


def time_travel(session: Session) -> DataFrame:
    store = _store(session, "Nation", "Region")
    first = store.head("main")
    store.delete("Nation", session.spark.createDataFrame([(k_,) for k_ in range(10)], "n_nationkey int"))
    s_ = Session(session.spark, store=store)
    now, then = A.Count(IsA(n, "Nation"), x), A.Using(f"commit/{first}", A.Count(IsA(n, "Nation"), y))
    return s_.run(Select([x, y], And(now, then)))


frame("time_travel", time_travel, "SELECT (SELECT count(*) FROM nation WHERE n_nationkey >= 10) AS x, (SELECT count(*) FROM nation) AS y")


def written(session: Session) -> DataFrame:
    s_ = Session(session.spark, store=_store(session, "Nation", "Region"))
    s_.write(
        And(
            Triple(n, "region", A.Iri("Region/1")), Triple(n, "n_name", x), A.Lower(x, y),
            A.InsertDocument({"@type": "Region", "@id": A.Iri("Region/50"), "r_name": "NEW"}),
            A.AddLink(n, "region", A.Iri("Region/50")), A.AddData(n, "n_name", y), A.DeleteDocument(A.Iri("Region/4")),
        )
    )
    return s_.run(Select([x, y], And(Triple(n, "n_name", x), Link(n, "region", r), Triple(r, "r_name", y))))


frame("write_transaction", written, "SELECT CASE WHEN n_regionkey = 1 THEN lower(n_name) ELSE n_name END AS x, CASE WHEN n_regionkey = 1 THEN 'NEW' ELSE r_name END AS y FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey <> 4")


def rebased(session: Session) -> DataFrame:
    store = _store(session, "Region")
    row = lambda k_, name: session.spark.createDataFrame([(k_, name)], "r_regionkey int, r_name string")
    store.branch("work")
    store.update("Region", row(1, "MINE"), "work")
    store.update("Region", row(2, "THEIRS"), "main")
    store.rebase("work")
    return store.read("Region", store.head("work")).select("r_regionkey", "r_name")


frame("branch_rebase", rebased, "SELECT r_regionkey, CASE r_regionkey WHEN 1 THEN 'MINE' WHEN 2 THEN 'THEIRS' ELSE r_name END AS r_name FROM region")


def diffed(session: Session) -> DataFrame:
    store = _store(session, "Nation")
    first = store.head("main")
    rows = session.spark.createDataFrame([(1, "RENAMED", 1), (99, "NEW", 2)], "n_nationkey int, n_name string, n_regionkey int")
    store.update("Nation", rows)
    store.delete("Nation", session.spark.createDataFrame([(5,)], "n_nationkey int"))
    return store.diff("Nation", first, store.head("main")).select("id", "action")


frame("diff_documents", diffed, "SELECT * FROM (VALUES ('Nation/1', 'updated'), ('Nation/99', 'added'), ('Nation/5', 'deleted')) v(id, action)")


def merged(session: Session) -> DataFrame:
    store = _store(session, "Nation")
    store.branch("work")
    store.insert("Nation", session.spark.createDataFrame([(100, "W", 1)], "n_nationkey int, n_name string, n_regionkey int"), "work")
    store.delete("Nation", session.spark.createDataFrame([(0,)], "n_nationkey int"), "main")
    store.merge("work", "main")
    return Session(session.spark, store=store).run(Select([n, name], Triple(n, "n_name", name)))


frame("merge_branches", merged, "SELECT 'Nation/' || n_nationkey AS n, n_name AS name FROM nation WHERE n_nationkey <> 0 UNION ALL SELECT 'Nation/100', 'W'")


frame("window_tumbling", lambda s_: changes.tumbling(s_.catalog.get("Event").frame(), "1 day").withColumn("total", F.round("total", 2)), "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
frame("window_sliding", lambda s_: changes.sliding(s_.catalog.get("Event").frame(), "2 days", "1 day"), "SELECT date_trunc('day', ts) - to_days(k) AS start, event_type, count(*) AS n FROM events, (VALUES (0), (1)) v(k) GROUP BY 1, 2")


def stream_counts(session: Session) -> DataFrame:
    """The change log as a stream: what a commit did, counted by class and action."""
    store = _store(session, "Nation", "Region")
    store.insert("Nation", session.spark.createDataFrame([(100 + k_, f"N{k_}", 1) for k_ in range(4)], "n_nationkey int, n_name string, n_regionkey int"))
    store.delete("Region", session.spark.createDataFrame([(0,)], "r_regionkey int"))
    here = f"{shared_folder(session.spark)}/stream-{uuid.uuid4().hex}"
    return changes.run_all(session.spark, changes.changes(store).select("cls", "id", "action"), f"{here}/out", f"{here}/check")


frame("change_stream", stream_counts, "SELECT 'Nation' AS cls, 'Nation/' || k AS id, 'added' AS action FROM (SELECT unnest(range(100, 104)) AS k) UNION ALL SELECT 'Region', 'Region/0', 'deleted'")
