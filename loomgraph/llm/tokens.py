"""Whole-text encoders over the public vocabularies, memoised on pieces that cannot influence each other.

Both pre-tokenisers cut a text at white space in a way that makes some pieces independent of their
neighbours, so a piece's ids are computed once a worker process by the tokenizers library's own BPE
model and kept as little-endian uint32 bytes. Caches are bounded by bytes and refilled, never a limit on
input: a key that is long by itself is computed anew each time.

ByteEncoder.encode_rows() takes many texts at once: Arrow cuts them into words and tells the different ones,
of which letters are looked up in a table, and those it lacks go to the library's model many in one call.
"""

from __future__ import annotations

import codecs
import json
import os
import re
from array import array
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

CHUNKS, PIECES = 208 << 20, 48 << 20  # bytes
CALL, KNOWN = 1 << 13, 48 << 20  # bytes of pieces sent to the model at once, of the table of letters
TOGETHER = 4 << 20  # characters of texts that are cut at once; a longer text is cut by itself


def byte_alphabet() -> list[str]:
    """The printable stand-in for each byte that byte-level vocabularies are written in."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(keep) else chr(next(spare)) for b in range(256)]


class _Memo(dict):
    """A dict bounded by bytes that computes what it lacks.

    When half the bytes are used, what is held becomes the old generation and the one before it goes; what is
    asked for again comes back from there.
    """

    LONG = 4096  # bytes of a key and its value that aren't kept

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.half, self.held, self.old = make, most // 2, 0, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        size = 200  # a place in the dict and two small objects
        if isinstance(key, str):
            size += 4 * len(key) + len(value)  # four bytes a character at most
        if size > self.LONG:
            return value
        if self.held + size > self.half:
            self.old = dict(self)
            self.clear()
            self.held = 0
        self.held += size
        self[key] = value
        return value


class _Words(_Memo):
    """A _Memo of str to bytes; ASCII counts a byte a character, and 150 are two small objects and a place."""

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        size = 150 + (len(key) if key.isascii() else 4 * len(key)) + len(value)
        if size > self.LONG:
            return value
        if (held := self.held + size) > self.half:
            self.old = dict(self)
            self.clear()
            held = size
        self.held = held
        self[key] = value
        return value


class PieceEncoder:
    """Common part: `piece_ids(piece)` gives the ids of one pre-token."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.model = self.library.model
        alphabet = byte_alphabet()
        self._table = {b: c for b, c in enumerate(alphabet)}
        self.pieces = _Memo(self.piece_ids, PIECES)

    def piece_ids(self, piece: str) -> bytes:
        mapped = piece.encode("utf-8").decode("latin-1").translate(self._table)
        return array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()


class WordEncoder(PieceEncoder):
    """word_bpe: lower case, white space dropped. Chunks between white space are independent.

    Texts with characters outside a set for which normalisation is plain lower-casing go through the
    library as a whole.
    """

    def __init__(self, path: str):
        super().__init__(path)
        spec = json.loads(self.library.to_str())
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.odd = re.compile("[^\t\n\r -~¡-¬®-ÿĀ-ž‐-‧‰-⁞]")
        self.chunks = _Memo(self.chunk_ids, CHUNKS)

    def chunk_ids(self, chunk: str) -> bytes:
        low = chunk.lower()
        if low.isalpha():  # letters alone are one piece, kept in lower case
            return self.piece_ids(low) if low == chunk else self.chunks[low]
        found = self.split.findall(low)
        return b"".join([self.chunks[p] if p.isalpha() else self.pieces[p] for p in found])

    def encode(self, text: str) -> bytes:
        if self.odd.search(text):
            return self.whole(text)
        chunks = self.chunks
        return b"".join([chunks[c] for c in text.split()])


#: Between a character that is no white space and a single space before another such character: no
#: alternative of the byte-level patterns crosses this place, and none looks beyond it.
SEAM = re.compile(r"(?<=\S)(?= \S)")
#: All white space but the space and the line end.
_ODD_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


def _plain(text: str) -> bool:
    """Whether all white space is single spaces between words, and line ends that no space is beside."""
    return not ("  " in text or " \n" in text or "\n " in text or any([c in text for c in _ODD_SPACE]))


def seams(text: str) -> list[str] | None:
    """Words after single spaces, or None where white space needs care (then SEAM.split is used)."""
    return text.split(" ") if _plain(text) else None


class ByteEncoder(PieceEncoder):
    """byte_bpe: byte-level BPE after the usual pattern; chunks between SEAMs are independent.

    So are lines where one line end is all the white space between two of them: it is a piece by itself. A
    text is cut there first, as words joined by a line end hardly ever come again.
    """

    def __init__(self, path: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        super().__init__(path)
        self.split = regex.compile(public_tokenizers.PATTERN)
        self.chunks = _Words(self.chunk_ids, CHUNKS // 4)
        self.spaced = _Words(self.word_ids, CHUNKS // 4)
        self.newline = self.piece_ids("\n")
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.bare = Tokenizer(self.model)
        # a byte that UTF-8 never has, a token that no other token has in it: merges don't cross it
        vocab, alphabet = self.library.get_vocab(), byte_alphabet()
        alone = [b for b in (0xC0, 0xC1, *range(0xF5, 0x100)) if alphabet[b] in vocab and sum(alphabet[b] in x for x in vocab) == 1]
        self.between = bytes(alone[:1])
        self.between_id = vocab[alphabet[alone[0]]] if alone else -1
        self.alphabet = "".join(alphabet)
        self.known, self.known_ids = pa.array([], pa.string()), pa.array([], pa.binary())

    def letters_ids(self, word: str, space: str = "") -> bytes:
        """Ids of letters alone, behind a space or not; only the space is another character in the byte alphabet."""
        if not word.isascii():
            return self.piece_ids(space + word)
        return array("I", [t.id for t in self.model.tokenize("Ġ" + word if space else word)]).tobytes()

    def chunk_ids(self, chunk: str) -> bytes:
        if chunk.isalpha():
            return self.letters_ids(chunk)
        if chunk[:-1].isalpha() and chunk[-1] in ",.":
            return self.chunks[chunk[:-1]] + self.pieces[chunk[-1]]
        return b"".join([self.pieces[p] for p in self.split.findall(chunk)])

    def word_ids(self, word: str) -> bytes:
        """A chunk after a single space. Letters alone are one piece, and so is one mark behind them."""
        if word.isalpha():
            return self.letters_ids(word, " ")
        if word[:-1].isalpha() and word[-1] in ",.":
            return self.spaced[word[:-1]] + self.pieces[word[-1]]
        return self.chunk_ids(" " + word)

    def encode(self, text: str) -> bytes:
        if not _plain(text):
            chunks = self.chunks
            return b"".join([chunks[c] for c in SEAM.split(text)])
        if "\n\n" in text:
            return self.words_ids(text.split(" "))
        return self.newline.join([self.words_ids(line.split(" ")) for line in text.split("\n")])

    def words_ids(self, words: list[str]) -> bytes:
        """The first word has no space before it."""
        return self.chunks[words[0]] + b"".join(map(self.spaced.__getitem__, words[1:]))

    def encode_rows(self, rows):
        """(key, ids) of rows of (key, text), in their order; the ids are those of encode()."""
        held, size = [], 0
        for row in rows:
            held.append(row)
            size += len(row[1])
            if size >= TOGETHER:
                yield from self._encode_held(held)
                held, size = [], 0
        yield from self._encode_held(held)

    def _encode_held(self, held: list):
        together = [len(text) < TOGETHER and _plain(text) for _, text in held]
        found = iter(self.plain_ids([text for _, text in compress(held, together)]))
        for (key, text), plain in zip(held, together, strict=True):
            yield key, next(found) if plain else self.encode(text)

    def plain_ids(self, texts: list[str]) -> list[bytes]:
        """The ids of plain texts, where each different word of them is looked up once."""
        if not texts:
            return []
        lined = pa.array([t if "\n\n" in t else t.replace("\n", " \n ") for t in texts], pa.string())
        cut = pc.split_pattern(lined, " ")
        starts = cut.offsets.to_numpy()
        coded = cut.values.dictionary_encode()
        code, named = coded.indices.to_numpy(), coded.dictionary
        line_end = pc.index(named, "\n").as_py()
        first = np.zeros(len(code), bool)  # no space before it
        first[starts[:-1]] = True
        first[np.flatnonzero(code == line_end) + 1] = True
        code = code + len(named) * first
        units = np.flatnonzero(np.bincount(code, minlength=2 * len(named)))
        ids, order = self.units_ids(named.take(pa.array(units % len(named))), units >= len(named))
        place = np.zeros(2 * len(named), np.int64)
        place[units[order]] = np.arange(len(order))
        _, ends, data = ids.take(pa.array(place[code])).buffers()
        ends = np.frombuffer(ends, np.int32)[starts].tolist()
        data = memoryview(data or b"")
        return [bytes(data[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def units_ids(self, words: pa.Array, first: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Ids of different words, behind a space where not first, and the places of the words they are of.

        Letters, and letters before one mark, are looked up and sent to the model together.
        """
        pieces = pc.if_else(pa.array(first), words, pc.binary_join_element_wise("", words, " "))
        letters = np.flatnonzero(pc.match_substring_regex(pieces, r"^ ?\p{L}+$"))
        marked = np.flatnonzero(pc.match_substring_regex(pieces, r"^ ?\p{L}+[,.]$"))
        rest = np.ones(len(words), bool)
        rest[letters] = rest[marked] = False
        rest = np.flatnonzero(rest)
        ending = pieces.take(pa.array(marked))
        stems = pc.utf8_slice_codeunits(ending, 0, -1)
        asked = pa.concat_arrays([pieces.take(pa.array(letters)), stems]).dictionary_encode()
        found = self.letters_all(asked.dictionary).take(asked.indices)
        marks = pc.if_else(pc.ends_with(ending, "."), pa.scalar(self.pieces["."], pa.binary()), pa.scalar(self.pieces[","], pa.binary()))
        others = words.take(pa.array(rest))
        others = pc.binary_join(pa.ListArray.from_arrays([0, len(others)], others), " ")[0].as_py().split(" ") if len(others) else []
        other_ids = [
            self.chunks[w] if alone else self.newline if w == "\n" else self.spaced[w] for w, alone in zip(others, first[rest].tolist(), strict=True)
        ]
        ids = [found[: len(letters)], pc.binary_join_element_wise(found[len(letters) :], marks, pa.scalar(b"", pa.binary())), pa.array(other_ids, pa.binary())]
        return pa.concat_arrays(ids), np.concatenate([letters, marked, rest])

    def letters_all(self, pieces: pa.Array) -> pa.Array:
        """Ids of different pieces of letters, behind a space or not; what is known is kept, bounded by bytes."""
        at = pc.index_in(pieces, self.known)
        lacks = np.asarray(at.is_null())
        new = pieces.filter(pa.array(lacks))
        table = pa.concat_arrays([self.known_ids, self.model_ids(new)])
        ids = table.take(pc.if_else(pa.array(lacks), pa.array(len(self.known) - 1 + np.cumsum(lacks)), at.cast(pa.int64())))
        self.known, self.known_ids = pa.concat_arrays([self.known, new]), table
        if self.known.nbytes + table.nbytes > KNOWN:
            few = pieces.nbytes + ids.nbytes <= KNOWN
            self.known, self.known_ids = (pieces, ids) if few else (pa.array([], pa.string()), pa.array([], pa.binary()))
        return ids

    def model_ids(self, pieces: pa.Array) -> pa.Array:
        """piece_ids() of each, many in one call with a byte between them that no merge crosses."""
        if not self.between or not len(pieces):
            return pa.array([*map(self.piece_ids, pieces.to_pylist())], pa.binary())
        raw = pieces.cast(pa.binary())
        calls = np.cumsum(pc.binary_length(raw).to_numpy().astype(np.int64)) // CALL
        bounds = [0, *(np.flatnonzero(np.diff(calls)) + 1).tolist(), len(raw)]
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), raw), self.between)
        parts = []
        for text in joined:
            mapped = codecs.charmap_decode(text.as_py() + self.between, "strict", self.alphabet)[0]
            parts.append(np.array(self.bare.encode_batch_fast([mapped], add_special_tokens=False)[0].ids, "<u4"))
        ids = np.concatenate(parts)
        ends = np.flatnonzero(ids == self.between_id)
        ends = np.concatenate(([0], 4 * (ends - np.arange(len(ends))))).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(ends), pa.py_buffer(ids[ids != self.between_id].tobytes())])


_held: dict[tuple[str, str], PieceEncoder] = {}


def encoder(kind: str, path: str) -> PieceEncoder:
    """One encoder a process, kept over tasks."""
    key = kind, path
    if key not in _held:
        _held.clear()
        _held[key] = {"word": WordEncoder, "byte": ByteEncoder}[kind](path)
    return _held[key]
