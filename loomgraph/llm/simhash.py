"""SimHash near duplicates by anchor-point covering.

Fingerprint: 64 bits; a bit is 1 if set in over half of the XXH64 (seed 42) hashes of the text's 3-word
shingles, repeats included. Two fingerprints link at THRESHOLD or fewer differing bits.

Anchors: at three differing bits one 32-bit half has at most one of them. The perfect Hamming code of
length 31 (covering radius 1) is the set of anchors over a half's lower 31 bits. Every fingerprint is at
home at its nearest anchor, and visits every anchor within covering radius plus threshold (1 + 1), so of
any linked pair one visits the other's home. Fingerprints are compared at anchors only. What comes out of
an anchor is a spanning forest of its links, never its pairs, and components follow from the forests.

Copies share one fingerprint and count once. An anchor's members are dealt into blocks; every visiting
block meets every home block of the anchor as its own task unit, so no task needs a whole hot anchor.

Null and empty texts have fingerprint zero and link like any other. A text of one or two words is one
shingle. Repeated rows keep their own rows. An empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, id_text, materialise, record_batch, scratch, ship, texts_of

THRESHOLD, SEED, BLOCK = 3, 42, 4096
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_AZ = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str, n: int = 3) -> int:
    words = _WORD.findall(text.encode().translate(_AZ))
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= n:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        begins = [0, *(ends[: len(words) - n] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(begins, ends[n - 1 :].tolist(), strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long), key (XXH64 of the text, as Spark's xxhash64)."""
    ship(docs.sparkSession)

    def run(batches):
        for ids, texts in texts_of(batches):
            fps = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
            keys = np.array([xxhash.xxh64_intdigest(t.encode(), SEED) for t in texts], np.uint64).view(np.int64)
            yield record_batch({"doc_id": (ids, pa.int64()), "fp": (fps.tolist(), pa.int64()), "key": (keys.tolist(), pa.int64())})

    return id_text(docs).mapInArrow(run, "doc_id long, fp long, key long")


# position p (1 to 31) of the code is bit p - 1; a word is in the code if the XOR of its set positions is 0
_POSITIONS = np.arange(1, 32, dtype=np.uint32)


def syndrome(words: np.ndarray) -> np.ndarray:
    out = np.zeros(len(words), np.uint32)
    for p in _POSITIONS:
        out ^= np.where(words >> np.uint32(p - 1) & np.uint32(1), p, np.uint32(0))
    return out


def anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(home, row, visited) of 31-bit words: the nearest code word of each; and all others within distance 2."""
    s = syndrome(words)
    flip = np.where(s, np.uint32(1) << np.maximum(s, 1) - np.uint32(1), np.uint32(0)).astype(np.uint32)
    home = words ^ flip
    rows, visits = [], []
    every = np.arange(len(words))
    for p in _POSITIONS:  # flipping p and q = p ^ s lands on a code word
        q = p ^ s
        good = (q > p) & (q <= 31) & (s != 0)
        two = words ^ (np.uint32(1) << (p - np.uint32(1))) ^ np.where(good, np.uint32(1) << np.maximum(q, 1) - np.uint32(1), np.uint32(0)).astype(np.uint32)
        rows.append(every[good])
        visits.append(two[good])
    return home, np.concatenate(rows), np.concatenate(visits).astype(np.uint32)


def _members(distinct: DataFrame) -> DataFrame:
    """fp, anchor (half and code word), home (1 or 0)."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 16):
                fp = batch.column("fp").slice(at, 1 << 16).to_numpy(zero_copy_only=False).astype(np.int64)
                u = fp.view(np.uint64)
                for half in (0, 1):
                    words = ((u >> np.uint64(32 * half)) & np.uint64(0x7FFFFFFF)).astype(np.uint32)
                    home, row, seen = anchors(words)
                    who = np.concatenate([fp, fp[row]])
                    where = np.concatenate([home, seen]).astype(np.int64) | half << 31
                    yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(where), pa.array(np.r_[np.ones(len(home), np.int8), np.zeros(len(row), np.int8)])], names=["fp", "anchor", "home"])

    return distinct.mapInArrow(run, "fp long, anchor long, home byte")


def forest(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> list[tuple[int, int]]:
    """Edges that connect all that links between homes a and members b connect: at most len(a) + len(b)."""
    group, out = np.arange(len(b)), []
    for x in a.tolist():
        near = np.flatnonzero(np.bitwise_count(b ^ np.uint64(x)) <= threshold)
        if not len(near):
            continue
        groups, first = np.unique(group[near], return_index=True)
        out += [(x, y) for y in b[near[first]].tolist() if y != x]
        for g in groups[1:].tolist():
            group[group == g] = groups[0]
    return out


def links(distinct: DataFrame, block: int = BLOCK) -> DataFrame:
    """fp_a, fp_b: links whose components are those of all pairs within the threshold; `distinct` has each fp once."""
    spark = distinct.sparkSession
    ship(spark)
    members = materialise(_members(distinct), "anchors")
    sizes = members.groupBy("anchor").agg(F.sum("home").alias("homes"), F.count("*").alias("all"))
    busy = sizes.filter("homes > 0 and all > 1").select("anchor", F.ceil(F.col("homes") / block).alias("h"), F.ceil(F.col("all") / block).alias("v"))
    met = members.join(busy, "anchor")
    mixed = F.xxhash64("fp")
    # as a home: once for each block of visitors; as a visitor (homes too): once for each block of homes
    as_home = met.filter("home = 1").select("anchor", "fp", F.lit(1).alias("side"), F.pmod(mixed, "h").alias("x"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("v").cast("long") - 1)).alias("y"))
    as_visitor = met.select("anchor", "fp", F.lit(0).alias("side"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("h").cast("long") - 1)).alias("x"), F.pmod(mixed, "v").alias("y"))
    units = as_home.unionByName(as_visitor)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_units = units.repartition(n, "anchor", "x", "y").sortWithinPartitions("anchor", "x", "y")

    def run(batches):
        keep: list[np.ndarray] = []

        def solve(parts):
            anchor, x, y, side, fp = (np.concatenate(c) for c in zip(*parts, strict=True))
            if not len(anchor):
                return [], []
            cut = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(x) != 0) | (np.diff(y) != 0)) + 1
            out = []
            for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(anchor)], strict=True):
                s, f = side[lo:hi], fp[lo:hi].view(np.uint64)
                homes = f[s == 1]
                if len(homes):
                    out += forest(homes, f[s == 0])
            e = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
            return e[:, 0].tolist(), e[:, 1].tolist()

        names = ("anchor", "x", "y", "side", "fp")
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            same = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1])
            head = batch.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
            if head:  # the unit that ends the batch may go on in the next one
                a, b = solve([*keep, [c[:head] for c in cols]])
                keep = []
                if a:
                    yield record_batch({"fp_a": (a, pa.int64()), "fp_b": (b, pa.int64())})
                keep = [[c[head:] for c in cols]]
            else:
                differs = keep and any(k[-1][-1:].tolist() != c[:1].tolist() for k, c in zip([[p[i] for p in keep] for i in range(3)], cols[:3], strict=True))
                if differs:
                    a, b = solve(keep)
                    keep = []
                    if a:
                        yield record_batch({"fp_a": (a, pa.int64()), "fp_b": (b, pa.int64())})
                keep.append(cols)
        if keep:
            a, b = solve(keep)
            if a:
                yield record_batch({"fp_a": (a, pa.int64()), "fp_b": (b, pa.int64())})

    return sorted_units.select("anchor", "x", "y", "side", "fp").mapInArrow(run, "fp_a long, fp_b long")


def components(nodes_min: DataFrame, edges: DataFrame) -> DataFrame:
    """node, root (smallest label reachable) for all nodes that edges (u, v) touch, by label propagation with pointer jumping.

    Labels are the nodes' own `label` values. Each round takes the least label among neighbours and then the
    label of the node that carries that label; it is written to the shared folder, and rounds end when no
    label moves, so any component is finished, however long.
    """
    both = materialise(edges.select("u", "v").union(edges.select(F.col("v"), F.col("u"))).distinct(), "edges")
    touched = both.select(F.col("u").alias("node")).distinct()
    held = state = materialise(touched.join(nodes_min, "node").select("node", "label"), "labels")
    holders = materialise(state.groupBy("label").agg(F.min("node").alias("holder")), "holders")
    while True:
        near = both.join(state.withColumnRenamed("node", "v").withColumnRenamed("label", "l"), "v").groupBy("u").agg(F.min("l").alias("l"))
        least = state.join(near.withColumnRenamed("u", "node"), "node").select("node", F.col("label").alias("old"), F.least("label", "l").alias("label"))
        jumped = (
            least.join(holders, "label", "left")
            .join(state.select(F.col("node").alias("holder"), F.col("label").alias("far")), "holder", "left")
            .select("node", "old", F.least("label", F.coalesce("far", "label")).alias("label"))
        )
        new = materialise(jumped, "labels")
        moved = new.filter("label < old").limit(1).count()
        discard(held)
        held, state = new, new.select("node", "label")
        if not moved:
            discard(both)
            discard(holders)
            return state.withColumnRenamed("label", "root")


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, fp, key, root: the component's least (none, id, fp), by a fingerprint's smallest doc_id (none = 1 and id 0 if all are null).

    A label is of one fingerprint alone, so fingerprints without an id link others as well, and components
    that share a repeated doc_id stay apart.
    """
    scratch(docs.sparkSession)
    rows = materialise(fingerprinted(docs), "fingerprints")
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("id"))
    label = F.struct(F.col("id").isNull().cast("int").alias("none"), F.coalesce("id", F.lit(0).cast("long")).alias("id"), F.col("fp").alias("fp"))
    classes = materialise(least.select("fp", label.alias("label")), "classes")
    found = materialise(links(classes.select("fp")), "links")
    roots = components(classes.select(F.col("fp").alias("node"), "label"), found.select(F.col("fp_a").alias("u"), F.col("fp_b").alias("v")))
    named = classes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", F.coalesce("root", "label").alias("root"))
    return rows.join(named, "fp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of its component; null if it has none)."""
    return grouped(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.when(F.col("root.none") == 0, F.col("root.id")).alias("component_id"))


def survivors(docs: DataFrame) -> DataFrame:
    """doc_id, key (xxhash64 of the text): one for each component with a doc_id, of its smallest one."""
    first = grouped(docs).filter((F.col("root.none") == 0) & (F.col("doc_id") == F.col("root.id")) & (F.col("fp") == F.col("root.fp")))
    return first.groupBy("doc_id", "fp").agg(F.min("key").alias("key")).select("doc_id", "key")
