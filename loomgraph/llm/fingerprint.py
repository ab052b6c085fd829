"""Homomorphic multiset hash of a text, in DataFrame functions alone.

A paragraph (a line) is hashed into a wide vector: a 1, EXACT numbers of 32 bits hashed from the whole
paragraph, the number of its units, and LANES numbers, the sum of a 16-bit pseudo-random vector for each
unit (a word with its successor in the paragraph). The fingerprint of a text is the sum of its
paragraphs' vectors, each number modulo 2^32. So order of paragraphs doesn't matter, and a paragraph is
put in or taken out by adding or subtracting its vector (`plus`, `minus`). The numbers of whole paragraphs
tell texts apart whose paragraphs differ in the order of words only; the lanes of units give the likeness.

Centred lanes of a difference of two fingerprints have a variance in proportion to the number of units
that the texts don't share, which gives the likeness: 1 - |difference| / (units of both), from 0 to 1.

Null and empty texts have one empty paragraph. Repeated rows are rows each. Rows go by doc_id, then by
a hash of the text; null ids go first. After the last row comes that with the smallest id (if none has an
id, the last row is its own next). An empty table gives no rows. Rows alike in doc_id and text are one
range, which streams through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text

EXACT, LANES, RANGE_ROWS = 8, 64, 16_384
MOD = 1 << 32
_VAR = ((1 << 32) - 1) / 12  # of a number uniform on 0 .. 2^16 - 1
_MEAN = ((1 << 16) - 1) / 2
_NONE = -(1 << 63)  # stands for a null id where ids are compared


def units(text: Column) -> Column:
    """A 64-bit hash for each word with the word after it, within each paragraph."""
    pairs = lambda ws: F.transform(ws, lambda w, i: F.xxhash64(w, F.get(ws, i + 1)))
    by_line = F.transform(F.split(text, "\n"), lambda p: F.transform(F.array(F.split(p, " ")), pairs))
    return F.flatten(F.flatten(by_line))


def paragraph_sums(text: Column) -> Column:
    """An array of 1 + EXACT numbers: how many paragraphs, and the sums of the numbers hashed from each, modulo 2^32."""
    hashed = F.transform(F.split(text, "\n"), lambda p: F.array(*[F.xxhash64(F.lit(j), p) for j in range(EXACT // 2)]))
    half = lambda h, j: F.shiftrightunsigned(h[j // 2], 32 * (j % 2)).bitwiseAND(F.lit(MOD - 1))
    zero = F.array(*[F.lit(0).cast("long")] * (1 + EXACT))
    return F.aggregate(hashed, zero, lambda s, h: F.array(s[0] + 1, *[(s[j + 1] + half(h, j)).bitwiseAND(F.lit(MOD - 1)) for j in range(EXACT)]))


def lane_sums(unit: Column) -> list[Column]:
    """Aggregates: one sum a lane. A hash of the unit gives four lanes of 16 bits."""
    out = []
    for k in range(0, LANES, 4):
        h = F.xxhash64(unit, F.lit(k))
        out += [F.coalesce(F.sum(F.shiftrightunsigned(h, 16 * j).bitwiseAND(F.lit(0xFFFF).cast("long"))), F.lit(0).cast("long")).alias(f"lane{k + j}") for j in range(4)]
    return out


def hex_text(numbers: Column) -> Column:
    return F.array_join(F.transform(numbers, lambda x: F.lpad(F.lower(F.hex(F.pmod(x, F.lit(MOD)))), 8, "0")), "")


def plus(a: Column, b: Column) -> Column:
    """The vector of a text with the paragraphs of another put in."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + y, F.lit(MOD)))


def minus(a: Column, b: Column) -> Column:
    """The vector of a text with the paragraphs of another taken out."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x - y, F.lit(MOD)))


def likeness(n: Column, lanes: Column, other_n: Column, other_lanes: Column) -> Column:
    """From two fingerprints as (units, array of lanes)."""
    signed = lambda d: F.when(d >= MOD // 2, d - MOD).otherwise(d)
    centred = F.zip_with(lanes, other_lanes, lambda a, b: signed(F.pmod(a - b, F.lit(MOD))) - _MEAN * (n - other_n))
    power = F.aggregate(centred, F.lit(0.0), lambda s, d: s + d * d) / (LANES * _VAR)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - power / F.greatest(n + other_n, F.lit(1))))


def fingerprints(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, units, lanes (array), vector (array: all numbers modulo 2^32), fingerprint (its hex) for each row; keys must tell rows apart."""
    # before the explode, or it would be reckoned for every unit; as bytes, since every unit's row carries it
    packed = F.unhex(hex_text(paragraph_sums(F.col(text))))
    summed = rows.select(*keys, packed.alias("_exact"), units(F.col(text)).alias("_units"))
    exploded = summed.select(*keys, "_exact", F.explode_outer("_units").alias("_unit"))
    out = exploded.groupBy(*keys, "_exact").agg(F.count("_unit").alias("units"), *lane_sums(F.col("_unit")))
    lanes = F.array(*[F.col(f"lane{k}") for k in range(LANES)])
    exact = F.array(*[F.conv(F.hex(F.substring("_exact", 4 * k + 1, 4)), 16, 10).cast("long") for k in range(1 + EXACT)])
    whole = F.concat(exact, F.transform(F.concat(F.array("units"), lanes), lambda x: F.pmod(x, F.lit(MOD))))
    return out.select(*keys, "units", lanes.alias("lanes"), whole.alias("vector"), hex_text(whole).alias("fingerprint"))


def begins_of(keyed: DataFrame, size: int) -> list[tuple[int, int]]:
    """The first (_id, _hash) of each range of at most about `size` rows: 16 bytes a range on the driver, whatever the texts.

    There are eight ranges a shuffle partition at least, so that tasks even out. Ranges are cut between ids; only where an id has too many rows, between hashes of its texts as well.
    """
    n = max(-(-keyed.count() // size), 8 * int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def cut(*by):
        parts = keyed.select("_id", *by[1:]).repartitionByRange(n, *by).withColumn("_part", F.spark_partition_id())
        first = F.min(F.struct("_id", by[1] if len(by) > 1 else F.lit(_NONE).alias("_hash")))
        return parts.groupBy("_part").agg(first.alias("first"), F.count("*").alias("n")).collect()

    got = cut("_id")
    if any(r.n > 4 * size for r in got):
        got = cut("_id", "_hash")
    return sorted({tuple(r.first) for r in got})


def constants(begins: list[tuple[int, int]]) -> list[Column]:
    """The ids and the hashes of `begins` as arrays, folded into constants when planned."""
    return [F.split(F.lit(",".join(str(b[k]) for b in begins)), ",").cast("array<bigint>") for k in (0, 1)]


def range_of(begins: list[tuple[int, int]]) -> Column:
    """The last range that begins at or before (_id, _hash), by binary search in a constant."""
    ids, hashes = constants(begins)
    me, h = F.col("_id"), F.col("_hash")

    def step(s, _):
        mid = F.shiftright(s["low"] + s["high"], 1)
        after = (F.get(ids, mid) > me) | ((F.get(ids, mid) == me) & (F.get(hashes, mid) > h))
        return F.struct(F.when(after, s["low"]).otherwise(mid).alias("low"), F.when(after, mid).otherwise(s["high"]).alias("high"))

    start = F.struct(F.lit(0).alias("low"), F.lit(len(begins)).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, len(begins).bit_length()))), start, step, lambda s: s["low"])


def edit_likeness(docs: DataFrame, size: int = RANGE_ROWS) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likenesses; see the module.

    Rows are dealt into ranges of (doc_id, hash of the text) of about `size` rows, as many as there need be;
    the row that begins a range goes to the range before it as well, so that every row meets the next one
    there and texts move once.
    """
    base = id_text(docs).withColumn("_id", F.coalesce("doc_id", F.lit(_NONE))).withColumn("_hash", F.xxhash64("text"))
    begins = begins_of(base, size)
    own = range_of(begins) if len(begins) > 1 else F.lit(0)
    # the row after the last: the first one that has an id
    least = docs.agg(F.min(F.col("doc_id").cast("long")).alias("i")).first().i
    wrap = base.filter(F.col("doc_id") == least).agg(F.min("_hash").alias("h")).first().h if least is not None else None
    first_of_own = F.lit(False)
    if len(begins) > 1:
        ids, hashes = constants(begins)
        at, begin = F.col("own"), F.get(hashes, F.col("own"))
        first_of_own = (at > 0) & (F.get(ids, at) == F.col("_id")) & ((begin == F.col("_hash")) | (begin == _NONE))
    is_wrap = (F.col("doc_id") == least) & (F.col("_hash") == wrap) if least is not None else F.lit(False)
    seats = F.filter(
        F.array(
            F.struct(F.col("own").alias("bucket"), F.lit(0).alias("guest")),
            F.when(first_of_own, F.struct((F.col("own") - 1).alias("bucket"), F.lit(1).alias("guest"))),
            F.when(is_wrap, F.struct(F.lit(len(begins) - 1).alias("bucket"), F.lit(2).alias("guest"))),
        ),
        lambda x: x.isNotNull(),
    )
    dealt = base.withColumn("own", own).withColumn("seat_in", F.explode(seats)).select("doc_id", "text", "_hash", "seat_in.bucket", "seat_in.guest")
    w = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_first(), "_hash", "text")
    seated = dealt.select("bucket", "guest", "doc_id", "text", F.row_number().over(w).alias("seat"), F.lead("text").over(w).alias("next_text"))
    chars = F.length("text")
    half = F.floor(chars / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), chars - half), F.coalesce(F.col("next_text"), F.col("text")).substr(F.lit(1), half))
    rows = seated.select("bucket", "guest", "seat", "doc_id", "text", chars.cast("long").alias("n_chars"), F.when(F.col("guest") == 0, edited).alias("edited"))
    side = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.col(c).alias("t"))
    both = rows.select(
        "bucket", "guest", "seat", "doc_id", "n_chars", F.unhex(F.sha2("edited", 256)).alias("sha"),
        F.explode(F.when(F.col("guest") == 0, F.array(side(0, "text"), side(1, "edited"))).otherwise(F.array(side(0, "text")))).alias("side"),
    ).select("bucket", "guest", "seat", "doc_id", "n_chars", "sha", F.col("side.kind").alias("kind"), F.col("side.t").alias("t"))
    keys = ["bucket", "guest", "seat", "doc_id", "n_chars", "sha", "kind"]
    printed = fingerprints(both, keys, "t")
    # a row's edited text and the next row's text follow it in this order
    v = Window.partitionBy("bucket").orderBy("seat", "kind")
    step = lambda c, k: F.lead(c, k).over(v)
    met = printed.select(
        "guest", "kind", "doc_id", "n_chars", "sha", "units", "lanes", "fingerprint",
        step("units", 1).alias("units_e"), step("lanes", 1).alias("lanes_e"), step("fingerprint", 1).alias("fingerprint_e"),
        step("units", 2).alias("units_n"), step("lanes", 2).alias("lanes_n"),
    ).filter("guest = 0 and kind = 0")
    me = F.col("units"), F.col("lanes")
    return met.select(
        "doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), "fingerprint", F.col("fingerprint_e").alias("edited_fingerprint"),
        likeness(*me, F.col("units_e"), F.col("lanes_e")).alias("near_edited"),
        likeness(*me, F.coalesce("units_n", "units"), F.coalesce("lanes_n", "lanes")).alias("near_next"),
    )
