"""Token-ID files: documents in ascending doc_id, encoded and kept as Re-Pair grammars.

The rows in order of doc_id are cut into shards of about SHARD ids, whole documents each; a shard has a
grammar of its own. Rounds of Re-Pair replace frequent adjacent pairs by nonterminals (all frequent pairs
of a round at once, left to right, never overlapping) until no pair is frequent, that is until none comes
LEAST times, nor once in SHARE of the shard's ids. A shard keeps its rules, the expansion length of every
nonterminal, the shortened sequence and where each document begins, so that one document is decoded
without the others: the running sum of expansion lengths finds the symbols that cover it.

The file format is a binary shard a row in a Parquet table of the shared folder, so that any file
system that Spark writes to will do and task commits are atomic.

Nulls and empty texts: the end id alone. Repeated doc_ids are kept each, in the order of a hash of their
texts, so that an id with very many rows is cut into parts like any others; a null doc_id sorts first. An
empty table gives no rows. Ids of 2^32 and over aren't supported; a vocabulary whose ids reach 2^16 gives
nonterminals that begin behind its largest id in the shard.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text, record_batch, scratch, ship, texts_of
from .tokens import encoder

END, SHARD, LEAST, SHARE = 2, 1 << 18, 8, 1 << 13
FIRST = 1 << 16  # the first nonterminal where all ids are below it
MAGIC = b"RPG2"
_HASH_BITS = 18


def _hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA77))) >> np.uint32(32 - _HASH_BITS)


def _keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.uint64) << np.uint64(32) | b


def compress(ids: np.ndarray, first: int = FIRST, least: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, rules): symbols from `first` on stand for the pair in that row of rules.

    A round replaces every place of a frequent pair or takes one of its two symbols away, so behind it only
    pairs with a new symbol can be frequent: later rounds look at the neighbours of new symbols alone.
    """
    x = ids.astype(np.uint32)
    least = least or max(LEAST, len(x) // SHARE)
    rules: list[np.ndarray] = []
    made, at = first, np.arange(max(0, len(x) - 1))
    cell = np.full(1 << _HASH_BITS, -1, np.int32)
    while len(at) >= least:
        # a pair comes at most as often as its hash
        h = _hash(x[at], x[at + 1])
        often = (np.bincount(h, minlength=1 << _HASH_BITS) >= least)[h]
        at, h = at[often], h[often]
        keys = _keys(x[at], x[at + 1])
        pairs, n = np.unique(keys, return_counts=True)
        pairs = pairs[n >= least]
        if not len(pairs):
            break
        own = _hash((pairs >> np.uint64(32)).astype(np.uint32), pairs.astype(np.uint32))
        cell[own] = np.arange(len(pairs))
        which = cell[h]
        same = (which >= 0) & (pairs[which] == keys)
        odd = np.flatnonzero(~same & (which >= 0))  # another pair has the hash
        if len(odd):
            place = np.minimum(np.searchsorted(pairs, keys[odd]), len(pairs) - 1)
            hit = pairs[place] == keys[odd]
            which[odd[hit]], same[odd[hit]] = place[hit], True
        cell[own] = -1
        at, which = at[same], which[same]
        # of overlapping places every second one, counted from the start of a run
        start = np.concatenate(([True], np.diff(at) != 1))
        begin = np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))
        keep = (np.arange(len(at)) - begin) % 2 == 0
        at, which = at[keep], which[keep]
        used = np.bincount(which, minlength=len(pairs)) > 0
        number = np.cumsum(used) - 1
        x[at] = made + number[which]
        gone = np.ones(len(x), bool)
        gone[at + 1] = False
        x = x[gone]
        pairs = pairs[used]
        rules.append(np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        new = x >= made
        made += len(pairs)
        at = np.flatnonzero(new[:-1] | new[1:])
    return x, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def lengths(rules: np.ndarray, first: int = FIRST) -> np.ndarray:
    """Expansion length of each nonterminal; a rule names earlier ones only, so as many passes as they nest deep."""
    out = np.ones(len(rules), np.uint32)
    size = lambda s: np.where(s < first, 1, out[np.where(s < first, 0, s - first)] if len(out) else 1)
    while True:
        new = (size(rules[:, 0].astype(np.int64)) + size(rules[:, 1].astype(np.int64))).astype(np.uint32)
        if np.array_equal(new, out):
            return out
        out = new


def expand(x: np.ndarray, rules: np.ndarray, first: int = FIRST) -> np.ndarray:
    x = x.astype(np.uint32)
    while len(big := np.flatnonzero(x >= first)):
        out = np.repeat(x, np.where(x >= first, 2, 1))
        where = big + np.arange(len(big))
        rule = rules[x[big] - first]
        out[where], out[where + 1] = rule[:, 0], rule[:, 1]
        x = out
    return x


def to_shard(ids: np.ndarray, starts: np.ndarray) -> bytes:
    """starts: where each document begins in the shard's ids."""
    top = int(ids.max()) + 1 if len(ids) else 0
    first = max(FIRST, top)
    x, rules = compress(ids, first)
    narrow = first == FIRST and len(rules) <= FIRST
    head = struct.pack("<4sIIIII", MAGIC, len(ids), len(starts), len(rules), len(x), first if not narrow else 0)
    # narrow: 16 bits a symbol and a bit that tells nonterminals
    body = x.astype("<u2").tobytes() + np.packbits(x >= FIRST).tobytes() if narrow else x.astype("<u4").tobytes()
    return head + starts.astype("<u4").tobytes() + rules.astype("<u4").tobytes() + lengths(rules, first).astype("<u4").tobytes() + body


class Shard:
    def __init__(self, data: bytes):
        magic, self.n_ids, n_docs, n_rules, n, first = struct.unpack_from("<4sIIIII", data)
        if magic != MAGIC:
            raise ValueError("not a Re-Pair shard")
        at = 24
        self.starts = np.frombuffer(data, "<u4", n_docs, at)
        at += 4 * n_docs
        self.rules = np.frombuffer(data, "<u4", 2 * n_rules, at).reshape(-1, 2)
        at += 8 * n_rules
        self.lengths = np.frombuffer(data, "<u4", n_rules, at)
        at += 4 * n_rules
        self.first = first or FIRST
        if first:
            self.sequence = np.frombuffer(data, "<u4", n, at)
        else:
            low = np.frombuffer(data, "<u2", n, at).astype(np.uint32)
            high = np.unpackbits(np.frombuffer(data, np.uint8, offset=at + 2 * n), count=n).astype(np.uint32)
            self.sequence = low | high << np.uint32(16)

    def all_ids(self) -> np.ndarray:
        return expand(self.sequence, self.rules, self.first)

    def document(self, k: int) -> np.ndarray:
        """The ids of one document, expanding only the symbols that cover it."""
        begin = int(self.starts[k])
        end = int(self.starts[k + 1]) if k + 1 < len(self.starts) else self.n_ids
        s = self.sequence
        size = np.where(s < self.first, 1, self.lengths[np.where(s < self.first, 0, s - self.first)] if len(self.lengths) else 1)
        ends = np.cumsum(size)
        i, j = np.searchsorted(ends, begin, "right"), np.searchsorted(ends, end, "left")
        got = expand(s[i : j + 1], self.rules, self.first)
        skip = begin - int(ends[i] - size[i])
        return got[skip : skip + end - begin]


FILE = "part int, shard int, base long, n_ids long, doc_ids binary, doc_null binary, payload binary"


def write(docs: DataFrame, path: str, to: str, parts: int | None = None, size: int = SHARD, end: int = END) -> None:
    """Encodes docs into Re-Pair shards under the folder `to`; a part is a range of rows that one task writes."""
    spark = docs.sparkSession
    ship(spark)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tail = end.to_bytes(4, "little")

    def run(batches):
        enc = encoder("byte", path)
        part, number, base = TaskContext.get().partitionId(), 0, 0
        held: list[bytes] = []
        docs_in: list[int | None] = []
        n_held = 0

        def close():
            nonlocal number, base, n_held
            ids = np.frombuffer(b"".join(held), "<u4")
            starts = np.concatenate(([0], np.cumsum([len(x) // 4 for x in held])[:-1]))
            row = record_batch({
                "part": ([part], pa.int32()), "shard": ([number], pa.int32()), "base": ([base], pa.int64()), "n_ids": ([len(ids)], pa.int64()),
                "doc_ids": ([np.array([x or 0 for x in docs_in], "<i8").tobytes()], pa.binary()),
                "doc_null": ([np.packbits([x is None for x in docs_in]).tobytes()], pa.binary()),
                "payload": ([to_shard(ids, starts)], pa.binary()),
            })
            number, base, n_held = number + 1, base + len(ids), 0
            held.clear()
            docs_in.clear()
            return row

        rows = (row for ids, texts in texts_of(batches) for row in zip(ids, texts, strict=True))
        for doc, ids in enc.encode_rows(rows):
            held.append(ids + tail)
            docs_in.append(doc)
            n_held += len(held[-1]) // 4
            if n_held >= size:
                yield close()
        if held:
            yield close()

    keyed = id_text(docs).withColumn("_hash", F.xxhash64("text"))
    ranged = keyed.repartitionByRange(parts, "doc_id", "_hash").sortWithinPartitions("doc_id", "_hash", "text")
    ranged.select("doc_id", "text").mapInArrow(run, FILE).write.option("compression", "none").parquet(to)


def read(spark: SparkSession, at: str) -> DataFrame:
    """Decodes the shards under `at`: doc_id, start, n_tokens, ids_crc32, a row a document.

    The driver gets one number a part (their number is a parameter of write()), not one a shard.
    """
    ship(spark)
    shards = spark.read.schema(FILE).parquet(at)
    totals = {r.part: r.n for r in shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    before, run_total = {}, 0
    for part in sorted(totals):
        before[part] = run_total
        run_total += totals[part]

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k].as_py() for n in batch.schema.names}
                found = Shard(row["payload"])
                ids = found.all_ids().astype("<u4")
                bounds = [*found.starts.tolist(), found.n_ids]
                docs = np.frombuffer(row["doc_ids"], "<i8").tolist()
                null = np.unpackbits(np.frombuffer(row["doc_null"], np.uint8), count=len(docs))
                start = before[row["part"]] + row["base"]
                pairs = list(zip(bounds[:-1], bounds[1:], strict=True))
                yield record_batch({
                    "doc_id": ([None if z else d for d, z in zip(docs, null, strict=True)], pa.int64()),
                    "start": ([start + a for a, _ in pairs], pa.int64()),
                    "n_tokens": ([b - a for a, b in pairs], pa.int64()),
                    "ids_crc32": ([zlib.crc32(ids[a:b].tobytes()) for a, b in pairs], pa.int64()),
                })

    return shards.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, path: str) -> DataFrame:
    spark = docs.sparkSession
    to = f"{scratch(spark)}/token-ids-{uuid.uuid4().hex}"
    write(docs, path, to)
    return read(spark, to)
