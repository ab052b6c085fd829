"""Sum-of-squares online packing of token ids into fixed windows.

A document is its ids and an end id. Whole windows are cut off its front; what is left goes into the
fill level that makes the sum of squared counts of partially filled windows least, tracked in a level
array (one count for each fill from 1 to capacity - 1). Every partition packs on its own while it
streams, so nothing is shuffled and a lost task repeats only its own part. When the open windows hold more
than OPEN bytes, and at the end of a partition, the fullest are filled up from the emptiest ones (pieces
may be cut); at the end the last one is dealt into power-of-two sequences, which need no padding. So a
task holds OPEN bytes and one text, however many rests fit nowhere.

Nulls and empty texts: the end id alone. Repeated rows are packed each. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import id_text, record_batch, ship, texts_of
from .tokens import encoder

CAPACITY, END, OPEN = 4096, 2, 16 << 20
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long"
_TYPES = [pa.int64()] * 8


class Packer:
    """add() yields closed windows as (length, pieces); a piece is (doc, start, ids bytes, doc tokens)."""

    def __init__(self, capacity: int = CAPACITY, most: int = OPEN):
        self.capacity, self.most, self.held = capacity, most, 0
        self.level = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list[list]] = defaultdict(list)

    def place(self, size: int) -> int:
        """The level of the open window to put `size` ids into, 0 for a new one."""
        n = self.level
        there = np.flatnonzero(n[: self.capacity - size + 1])
        fresh = 2 * n[size] + 1
        if not len(there):
            return 0
        after = there + size
        cost = np.where(after < self.capacity, 2 * n[after] + 1, 0) + 1 - 2 * n[there]
        best = len(cost) - 1 - int(np.argmin(cost[::-1]))  # among equals the fullest
        return int(there[best]) if cost[best] <= fresh else 0

    def add(self, doc, ids: bytes):
        total, step = len(ids) // 4, self.capacity
        whole = total - total % step
        for at in range(0, whole, step):
            yield step, [(doc, at, ids[4 * at : 4 * (at + step)], total)]
        size = total - whole
        if not size:
            return
        at = self.place(size)
        window = self.open[at].pop() if at else []
        if at:
            self.level[at] -= 1
        window.append((doc, whole, ids[4 * whole :], total))
        self.held += 4 * size
        if at + size == step:
            self.held -= 4 * step
            yield step, window
        else:
            self.level[at + size] += 1
            self.open[at + size].append(window)
            if self.held > self.most:
                yield from self.fill()

    def fill(self):
        """Fills the fullest open windows from the emptiest; one at most stays open."""
        left = [(n, w) for n in sorted(self.open, reverse=True) for w in self.open[n]]
        self.open.clear()
        self.level[:] = 0
        self.held = 0
        first, last = 0, len(left) - 1
        while first < last:
            n, window = left[first]
            m, donor = left[last]
            while n < self.capacity and donor:
                doc, start, ids, total = donor.pop()
                take = min(len(ids) // 4, self.capacity - n)
                window.append((doc, start, ids[: 4 * take], total))
                n, m = n + take, m - take
                if 4 * take < len(ids):
                    donor.append((doc, start + take, ids[4 * take :], total))
            if not donor:
                last -= 1
            else:
                left[last] = m, donor
            if n == self.capacity:
                yield n, window
                first += 1
            else:
                left[first] = n, window
        if first == last:
            n, window = left[first]
            self.level[n] = 1
            self.open[n].append(window)
            self.held = 4 * n

    def finish(self):
        """Closes all windows: the last one is dealt into powers of two."""
        yield from self.fill()
        for n, windows in self.open.items():
            for pieces in windows:
                pieces = pieces[::-1]
                for size in (1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1):
                    window, room = [], size
                    while room:
                        doc, start, ids, total = pieces.pop()
                        take = min(room, len(ids) // 4)
                        window.append((doc, start, ids[: 4 * take], total))
                        room -= take
                        if 4 * take < len(ids):
                            pieces.append((doc, start + take, ids[4 * take :], total))
                    yield size, window
        self.open.clear()
        self.level[:] = 0
        self.held = 0


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, keep_ids: bool = False) -> DataFrame:
    """One row a piece; keep_ids adds the piece's ids as little-endian uint32 bytes."""
    ship(docs.sparkSession)
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches):
        enc, packer = encoder("word", path), Packer(capacity)
        tail = end.to_bytes(4, "little")
        sequence = (TaskContext.get().partitionId() << 33) - 1
        rows: list[tuple] = []

        def emit(windows):
            nonlocal sequence
            for length, pieces in windows:
                sequence += 1
                at = 0
                for doc, start, ids, total in pieces:
                    rows.append((doc, start, len(ids) // 4, zlib.crc32(ids), total, sequence, at, length, *([ids] if keep_ids else [])))
                    at += len(ids) // 4
                if len(rows) > 1024:
                    yield flush()

        def flush():
            columns = list(zip(*rows, strict=True))
            rows.clear()
            return record_batch({n: (list(c), t) for n, c, t in zip([*names, "ids"], columns, [*_TYPES, pa.binary()], strict=False)})

        for ids, texts in texts_of(batches):
            for doc, text in zip(ids, texts, strict=True):
                yield from emit(packer.add(doc, enc.encode(text) + tail))
        yield from emit(packer.finish())
        if rows:
            yield flush()

    return id_text(docs).mapInArrow(run, SCHEMA + (", ids binary" if keep_ids else ""))
