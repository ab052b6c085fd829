"""Byte-level BPE as a lazily determinised finite-state transducer, and a streaming decoder.

A prefix of a piece has exactly one BPE encoding, and it extends the encoding of an earlier prefix by
one vocabulary token that may follow that encoding's last token. The transducer reads a byte at a time;
its state is the last emitted token with every place from which a token may still be under way: the
trie node reached from there and the tokens since the last emitted one. Tokens on which all those
places agree are emitted, at most one longest token behind the input. States and transitions are made
when first met and kept (up to a bound, then made anew). Where a vocabulary breaks the property, a
piece is merged by ranks directly.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from array import array

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import id_text, record_batch, ship, texts_of
from .tokens import CHUNKS, PIECES, SEAM, _Memo, seams

TRANSITIONS, PAIRS = 800_000, 64 << 20  # entries; bytes


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """BPE by its definition: the lowest rank first, of equals the leftmost."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 60))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int | None] = [None]
        for word, rank in ranks.items():
            node = 0
            for b in word:
                step = self.children[node]
                if b not in step:
                    step[b] = len(self.children)
                    self.children.append({})
                    self.token.append(None)
                node = step[b]
            self.token[node] = rank
        self.parts = _Memo(self._parts, PAIRS)
        self.right = _Memo(lambda t: self._spine(t, 1), PAIRS)
        self.left = _Memo(lambda t: self._spine(t, 0), PAIRS)
        self.follows = _Memo(self._follows, PAIRS)
        self._reset()

    def _reset(self) -> None:
        self.states: list[tuple] = [(None, ((0, ()),))]
        self.number = {self.states[0]: 0}
        self.steps: dict[int, tuple[int, tuple[int, ...]] | None] = {}

    def _parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte."""
        word = self.bytes_of[token]
        if len(word) == 1:
            return None
        parts = merge(word, self._ranks_below(word, token))
        return (parts[0], parts[1]) if len(parts) == 2 else (-1, -1)

    def _ranks_below(self, word: bytes, token: int) -> dict[bytes, int]:
        ends = range(len(word) + 1)
        found = ((word[i:j], self.ranks.get(word[i:j])) for i in ends for j in ends[i + 1 :])
        return {w: r for w, r in found if r is not None and (r < token or len(w) == 1)}

    def _spine(self, token: int, side: int) -> list[int]:
        """The tokens at the right (1) or left (0) edge while this token is being merged, smallest first."""
        out = [token]
        while (parts := self.parts[out[-1]]) is not None:
            out.append(parts[side])
        return out[::-1]

    def _follows(self, pair: tuple[int, int]) -> bool:
        """Whether a then b stays as it is: at no time does a merge across the border come first."""
        xs, ys = self.right[pair[0]], self.left[pair[1]]
        i = j = 0
        while True:
            across = self.ranks.get(self.bytes_of[xs[i]] + self.bytes_of[ys[j]], 1 << 60)
            x = xs[i + 1] if i + 1 < len(xs) else 1 << 59
            y = ys[j + 1] if j + 1 < len(ys) else 1 << 59
            if across < min(x, y) or across == y < x:
                return False
            if x == y == 1 << 59:
                return True
            if x <= y:
                i += 1
            else:
                j += 1

    def _step(self, state: int, byte: int):
        last, places = self.states[state]
        children, tokens = self.children, self.token
        here, live = None, []
        for node, chain in places:
            after = children[node].get(byte)
            if after is None:
                continue
            token = tokens[after]
            if token is not None and here is None:
                before = chain[-1] if chain else last
                if before is None or self.follows[before, token]:
                    here = (*chain, token)
            if children[after]:
                live.append((after, chain))
        if here is None:
            return None
        sure = len(here)
        for _, chain in live:
            sure = min(sure, len(chain))
            while chain[:sure] != here[:sure]:
                sure -= 1
            if not sure:
                break
        if sure:
            last = here[sure - 1]
            live = [(n, c[sure:]) for n, c in live]
        live.append((0, here[sure:]))
        if all(c for _, c in live):
            last = -1  # no place builds on it any more: such states are one
        new = (last, tuple(live))
        number = self.number.get(new)
        if number is None:
            number = self.number[new] = len(self.states)
            self.states.append(new)
        return number, here[:sure]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.steps) > TRANSITIONS:
            self._reset()
        out: list[int] = []
        state, steps = 0, self.steps
        for b in piece:
            key = state << 8 | b
            if key not in steps:
                steps[key] = self._step(state, b)
            found = steps[key]
            if found is None:
                return merge(piece, self.ranks)
            state, emitted = found
            out += emitted
        out += self.states[state][1][-1][1]
        return out


class Utf8Stream:
    """Ids in, text out; a character cut by the end of a block waits for the next block."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.machine = codecs.getincrementaldecoder("utf-8")("surrogateescape")

    def feed(self, ids: list[int], last: bool = False) -> str:
        return self.machine.decode(b"".join(map(self.bytes_of.__getitem__, ids)), last)


class Codec:
    def __init__(self, path: str, pattern: str):
        self.fst = Transducer(load_ranks(path))
        self.split = regex.compile(pattern)
        self.pieces = _Memo(self.piece_ids, PIECES)
        self.chunks = _Memo(self.chunk_ids, CHUNKS // 4)
        self.spaced = _Memo(self.word_ids, CHUNKS)
        self.decimal = {v: str(v) for v in self.fst.bytes_of}

    def piece_ids(self, piece: str) -> bytes:
        return array("I", self.fst.encode(piece.encode())).tobytes()

    def chunk_ids(self, chunk: str) -> bytes:
        return b"".join([self.pieces[p] for p in self.split.findall(chunk)])

    def word_ids(self, word: str) -> bytes:
        """A chunk after a single space. Letters alone are one match, and so is one mark behind them."""
        if word.isalpha():
            return self.piece_ids(" " + word)
        if word[:-1].isalpha() and word[-1] in ",.":
            return self.spaced[word[:-1]] + self.pieces[word[-1]]
        return self.chunk_ids(" " + word)

    def encode(self, text: str) -> array:
        words = seams(text)
        if words is None:
            chunks = self.chunks
            data = b"".join([chunks[c] for c in SEAM.split(text)])
        else:
            spaced = self.spaced
            data = self.chunks[words[0]] + b"".join([spaced[w] for w in words[1:]])
        return array("I", data)

    def decode(self, ids: array, block: int = 1 << 16):
        stream = Utf8Stream(self.fst.bytes_of)
        for at in range(0, len(ids), block):
            yield stream.feed(ids[at : at + block].tolist(), at + block >= len(ids))


_held: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _held:
        _held.clear()
        _held[path, pattern] = Codec(path, pattern)
    return _held[path, pattern]


def encode_decode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, digest of the ids, digest of the bytes decoded from them. Null texts are empty."""
    ship(docs.sparkSession)

    def run(batches):
        use = codec(path, pattern)
        for docs_in, texts in texts_of(batches):
            n, a, b = [], [], []
            for text in texts:
                ids = use.encode(text)
                n.append(len(ids))
                a.append(hashlib.sha256(",".join(map(use.decimal.__getitem__, ids)).encode()).hexdigest())
                digest = hashlib.sha256()
                for part in use.decode(ids):
                    digest.update(part.encode("utf-8", "surrogateescape"))
                b.append(digest.hexdigest())
            yield record_batch({"doc_id": (docs_in, pa.int64()), "n_tokens": (n, pa.int64()), "ids_sha256": (a, pa.string()), "decoded_sha256": (b, pa.string())})

    return id_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
