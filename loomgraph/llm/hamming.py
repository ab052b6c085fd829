"""Exact top-k search over binary codes by incremental multi-index hashing.

Codes of 64 bits are cut into m segments. Rows within Hamming distance m * (r + 1) - 1 of a query agree
with it in some segment up to r bits. Round r probes the segment index with the values exactly r bits off
(a shell, whose masks are a constant of the plan), so no probe is made twice. What a probe meets is
verified on the whole code, and only where no segment is nearer and no earlier one as near, so a row is met
once in all rounds. The k nearest rows of a query found so far are kept between rounds, and it is done as
soon as k rows are known within m * (r + 1) - 1, when its kth distance is provably covered.

Equal codes count once while searching (with their k smallest ids), for rows and for queries, so a
vector that a third of all rows share costs as much as any other.

The tables between rounds are in as many files as the input's size asks for, not one a shuffle partition:
where Hadoop has no native library every new file forks a process that has the executor's memory at first.

Embeddings become codes by the signs of 64 numbers (null and NaN count as zero, zero as not positive); of a
longer embedding the numbers 64 places apart are added up first. A null embedding has no code: it is
neither found nor a query. Ties go to the smaller id; a query finds itself. With fewer than k rows all are
returned. Repeated rows are rows each; rows with a null id aren't found. Empty tables give no rows.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

FILES, FILE_BYTES = 8, 32 << 20  # files of a table kept between rounds: so many at least, and one for so many bytes of input

_CLEAN = "transform(embedding, x -> if(x is null or isnan(x), 0D, double(x)))"
_FOLDED = f"if(size(embedding) <= 64, {_CLEAN}, transform(sequence(0, 63), i -> aggregate(filter({_CLEAN}, (x, j) -> j % 64 = i), 0D, (a, x) -> a + x)))"
CODE = f"aggregate(transform({_FOLDED}, (x, i) -> if(x > 0, shiftleft(1L, i), 0L)), 0L, (a, b) -> a | b)"


def sign_codes(rows: DataFrame) -> DataFrame:
    """vec_id, code."""
    return rows.filter("embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.expr(CODE).alias("code"))


def segments(n: int) -> list[tuple[int, int]]:
    """(first bit, bits): about log2 n bits each less three, so that a probe meets some rows and balls stay small."""
    width = min(20, max(8, math.ceil(math.log2(max(n, 2))) - 3))
    m = math.ceil(64 / width)
    edges = [round(64 * k / m) for k in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def shell(bits: int, r: int) -> Column:
    """All masks of r set bits among the lowest `bits`, at most C(20, 10) of them: a constant when planned."""
    return F.split(F.lit(",".join(str(sum(1 << b for b in c)) for c in combinations(range(bits), r))), ",").cast("array<bigint>")


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), vec_id, distance. codes: vec_id, code; queries: query_id, code."""
    spark = codes.sparkSession
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(codes._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    files = max(FILES, math.ceil(size / FILE_BYTES))
    few = lambda df: df.repartition(files) if files < spread else df
    by_code = Window.partitionBy("code").orderBy("vec_id")
    firsts = codes.filter("vec_id is not null").select("code", "vec_id").withColumn("nth", F.row_number().over(by_code)).filter(F.col("nth") <= k)
    classes = materialise(few(firsts.groupBy("code").agg(F.collect_list("vec_id").alias("vec_ids"))), "classes")
    parts = segments(classes.count())
    m, widest = len(parts), max(b for _, b in parts)
    value = lambda col, a, b: F.shiftrightunsigned(col, a).bitwiseAND(F.lit((1 << b) - 1).cast("long"))
    seg = lambda col: F.posexplode(F.array(*[value(col, a, b) for a, b in parts])).alias("seg", "value")
    index = classes.select("code", F.size("vec_ids").alias("ids"), F.array_min("vec_ids").alias("least"), seg(F.col("code")))
    todo = queries.select(F.col("code").alias("q"))
    off = F.col("q").bitwiseXOR(F.col("code"))
    apart = [F.bit_count(value(off, a, b)) for a, b in parts]
    held = done = None  # held: what queries still to do have met
    for r in range(widest + 1):
        reach, last = m * (r + 1) - 1, r == widest
        masks = None
        for bits in sorted({b for _, b in parts}):
            mine = shell(bits, r) if r <= bits else F.array().cast("array<bigint>")
            masks = mine if masks is None else F.when(F.col("seg").isin([s for s, (_, b) in enumerate(parts) if b == bits]), mine).otherwise(masks)
        todo = todo.repartition(spread, "q").distinct()
        probes = todo.select("q", seg(F.col("q"))).select("q", "seg", "value", F.explode(masks).alias("mask")).select("q", "seg", F.col("value").bitwiseXOR(F.col("mask")).alias("value"))
        # a size estimate doesn't see how many probes a shell makes, so the join is a merge: never a broadcast of probes
        met = probes.join(index.hint("merge"), ["seg", "value"])
        # not met before: no segment is nearer, and none before this one is as near
        nearer = [apart[s] < r for s in range(m)]
        as_near = [(F.col("seg") > s) & (apart[s] == r) for s in range(m)]
        seen = F.lit(False)
        for x in (*nearer, *as_near):
            seen = seen | x
        new = met.filter(~seen).select("q", "code", F.bit_count(off).alias("distance"), "ids", "least")
        # a query that has met fewer than k classes keeps a row without one, so the rows held tell all that is to do
        known = (todo.select("q", *[F.lit(None).cast(t).alias(c) for c, t in new.dtypes[1:]]) if held is None else held).unionByName(new)
        order = Window.partitionBy("q").orderBy(F.asc_nulls_last("distance"), "least")
        best = known.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k).drop("nth")
        sure = F.sum(F.when(F.col("distance") <= reach, F.col("ids")).otherwise(0)).over(Window.partitionBy("q"))
        held = materialise(few(best.withColumn("sure", sure)), "held")
        found = (held if last else held.filter(F.col("sure") >= k)).filter("code is not null").select("q", "code", "distance")
        done = found if done is None else done.unionByName(found)
        held = held.filter(F.col("sure") < k).drop("sure")
        if last or not held.limit(1).count():
            break
        todo = held.select("q")
    # k classes at most a query, k ids at most a class
    by_query = Window.partitionBy("q").orderBy("distance", "vec_id")
    answers = done.join(classes, "code").select("q", "distance", F.explode("vec_ids").alias("vec_id")).withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k)
    asked = queries.select("query_id", F.col("code").alias("q"))
    return few(asked.join(answers, "q").select("query_id", F.col("rank").cast("long").alias("rank"), "vec_id", F.col("distance").cast("long").alias("distance")))
