"""Toxicity: gradient-boosted trees over dense features of whole texts, with isotonic calibration.

Features: lexicon density, number and distinct lexicon words, sum of their weights, hits near a second
person, capitals, punctuation, obfuscated hits (letters swapped for signs, spaced out or stretched), and
length. The lexicon and its weights are learnt from one half of the training rows (words whose log odds
are surely over CERTAIN, of SHORTEST letters or more, LEXICON of them at most), trees and calibration (isotonic regression on out-of-fold scores) from the
other half, so that the trees don't trust words that stood out by chance. Labels, language, source and
ids are no inputs.

Training uses at most SAMPLE labelled rows, chosen by a hash of doc_id; every document is scored.
Nulls and empty texts are scored as empty texts. A document with several labels counts as toxic if one
says so; null labels don't count. Without training rows every score is 0. Repeated rows are scored each.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, record_batch, ship, texts_of

SAMPLE, LEXICON, CERTAIN, TREES, DEPTH, RATE, FOLDS = 12_000, 400, 1.2, 60, 3, 0.15, 4
SHORTEST = 3  # letters of a lexicon word

# Second-person words and the letters that signs stand for.
SECOND = "you your yours yourself u ur tu te toi vous votre vos du dich dir dein deine ihr euch usted ustedes ti tus vosotros"
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}

_WORD = re.compile(r"[^\W\d_]+")
_MASKED = re.compile(r"(?<![^\W_])[^\W\d_]+(?:[013457@$!|*]+[^\W\d_]+)+(?![^\W_])")
_SPACED = re.compile(r"(?<![^\W_])[^\W\d_](?:[ ._*-][^\W\d_]){3,}(?![^\W_])")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_LEET = str.maketrans(LEET)
NAMES = ["density", "hits", "distinct", "weight", "weight_density", "second_person", "capitals", "punctuation", "obfuscated", "obfuscated_density", "words"]


class Features:
    def __init__(self, lexicon: dict[str, float]):
        import ahocorasick

        self.lexicon = lexicon
        self.machine = ahocorasick.Automaton()
        for w in lexicon:
            self.machine.add_word(w, w)
        if lexicon:
            self.machine.make_automaton()
        self.second = re.compile(r"\b(?:" + "|".join(SECOND.split()) + r")\b")
        self.stretched = {re.sub(r"(.)\1+", r"\1", w): w for w in lexicon}

    def hidden(self, low: str) -> list[str]:
        """Lexicon words that are there in disguise alone."""
        out = []
        for m in _MASKED.findall(low):
            plain = m.translate(_LEET)
            if plain in self.lexicon:
                out.append(plain)
            elif "*" in plain:
                mask = re.compile(re.sub(r"\*+", r"\\w+", plain))
                out += [w for w in self.lexicon if mask.fullmatch(w)][:1]
        for m in _SPACED.findall(low):
            plain = re.sub(r"[ ._*-]", "", m)
            if plain in self.lexicon:
                out.append(plain)
        if _TRIPLE.search(low):
            for w in {x for x in _WORD.findall(low) if _TRIPLE.search(x)}:
                plain = self.stretched.get(re.sub(r"(.)\1+", r"\1", w))
                if plain and w not in self.lexicon:
                    out.append(plain)
        return out

    def of(self, text: str) -> list[float]:
        low = text.lower()
        n = low.count(" ") + low.count("\n") + 1
        hits, near = [], 0
        if self.lexicon:
            for end, w in self.machine.iter(low):
                begin = end - len(w) + 1
                if (begin and low[begin - 1].isalnum()) or (end + 1 < len(low) and low[end + 1].isalnum()):
                    continue
                hits.append(w)
                near += bool(self.second.search(low, max(0, begin - 40), min(len(low), end + 40)))
        hidden = self.hidden(low) if self.lexicon else []
        every = hits + hidden
        weight = sum(self.lexicon[w] for w in every)
        letters = len(text) or 1
        capitals = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        marks = sum(map(text.count, "!?*#%&$"))
        return [len(every) / n, len(every), len(set(every)), weight, weight / n, near / n, capitals / letters, marks / letters, len(hidden), len(hidden) / n, math.log1p(n)]

    def matrix(self, texts: list[str]) -> np.ndarray:
        return np.array([self.of(t) for t in texts], np.float64).reshape(len(texts), len(NAMES))


class Trees:
    """Depth-limited regression trees on binned features, boosted for logistic loss."""

    def __init__(self, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = 64):
        self.trees, self.depth, self.rate, self.bins = trees, depth, rate, bins

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, "right") for c, v in zip(self.cuts, x.T, strict=True)], 1)
        p = min(max(y.mean(), 1e-4), 1 - 1e-4)
        self.base, self.forest = math.log(p / (1 - p)), []
        score = np.full(len(y), self.base)
        for _ in range(self.trees):
            prob = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, y - prob, prob * (1 - prob))
            self.forest.append(tree)
            score += self._values(tree, binned)
        return self

    def _grow(self, b: np.ndarray, g: np.ndarray, h: np.ndarray) -> list:
        """Heap of (feature, bin, value): rows with a bin above go right."""
        tree: list = [None] * (2 ** (self.depth + 1))
        todo = [(1, np.arange(len(g)))]
        while todo:
            k, rows = todo.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            tree[k] = (-1, 0, self.rate * gs / (hs + 1.0))
            if k >= 2**self.depth or len(rows) < 40:
                continue
            best = (1e-6, -1, 0)
            for f in range(b.shape[1]):
                n = len(self.cuts[f]) + 1
                gl = np.cumsum(np.bincount(b[rows, f], g[rows], n))[:-1]
                hl = np.cumsum(np.bincount(b[rows, f], h[rows], n))[:-1]
                if not len(gl):
                    continue
                gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                gain[(hl < 0.5) | (hs - hl < 0.5)] = 0
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (gain[at], f, at)
            if best[1] >= 0:
                _, f, at = best
                tree[k] = (f, at, 0.0)
                right = b[rows, f] > at
                todo += [(2 * k, rows[~right]), (2 * k + 1, rows[right])]
        return tree

    def _values(self, tree: list, b: np.ndarray) -> np.ndarray:
        k = np.ones(len(b), np.int64)
        f = np.array([t[0] if t else -1 for t in tree])
        at = np.array([t[1] if t else 0 for t in tree])
        value = np.array([t[2] if t else 0.0 for t in tree])
        for _ in range(self.depth):
            inner = f[k] >= 0
            k = np.where(inner, 2 * k + (b[np.arange(len(b)), np.maximum(f[k], 0)] > at[k]), k)
        return value[k]

    def raw(self, x: np.ndarray) -> np.ndarray:
        b = np.stack([np.searchsorted(c, v, "right") for c, v in zip(self.cuts, x.T, strict=True)], 1)
        return self.base + sum(self._values(t, b) for t in self.forest)


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (scores, values) for linear interpolation."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # value, weight, first score, last score
    for s, v in zip(score[order].tolist(), y[order].tolist(), strict=True):
        if blocks and blocks[-1][3] == s:
            last = blocks[-1]
            last[0], last[1] = (last[0] * last[1] + v) / (last[1] + 1), last[1] + 1
        else:
            blocks.append([v, 1, s, s])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks[-1]
            a[0], a[1], a[3] = (a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], b[3]
    xs = [x for b in blocks for x in ((b[2], b[3]) if b[2] < b[3] else (b[2],))]
    ys = [b[0] for b in blocks for _ in range(2 if b[2] < b[3] else 1)]
    return np.array(xs), np.array(ys)


def training_fold(doc_id):
    """True where labels may be learnt from."""
    return F.crc32(doc_id.cast("string")) % 5 != 0


class Model:
    def __init__(self, lexicon: dict[str, float], x: np.ndarray, y: np.ndarray):
        self.lexicon = lexicon
        self.constant = None if len(y) and 0 < y.sum() < len(y) else float(y.mean()) if len(y) else 0.0
        if self.constant is None:
            fold = np.arange(len(y)) % FOLDS
            out = np.zeros(len(y))
            for k in range(FOLDS):
                part = y[fold != k]
                out[fold == k] = Trees().fit(x[fold != k], part).raw(x[fold == k]) if 0 < part.sum() < len(part) else 0.0
            self.curve = isotonic(out, y)
            self.trees = Trees().fit(x, y)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        # a trace of the raw score keeps the order within a flat part of the curve
        raw = self.trees.raw(x)
        flat = np.interp(raw, *self.curve)
        return np.where(flat >= 0.5, np.maximum(0.5, flat - 1e-3 / (1 + np.exp(np.clip(raw, -30, 30)))), np.minimum(0.4999, flat + 1e-3 / (1 + np.exp(-np.clip(raw, -30, 30)))))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    ship(docs.sparkSession)
    given = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic is not null")
    chosen = given.filter(training_fold(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # the sample is bounded by a parameter, so both lists below are
    picked = chosen.collect()
    toxic = {r.doc_id: r.toxic for r in picked}
    for_words = {r.doc_id for r in picked[::2]}
    wanted = docs.sparkSession.createDataFrame(sorted(toxic), "long").withColumnRenamed("value", "doc_id") if toxic else None
    if wanted is None:
        return Model({}, np.zeros((0, len(NAMES))), np.zeros(0))
    rows = id_text(docs).join(F.broadcast(wanted), "doc_id")

    def words(batches):
        n: Counter = Counter()
        for ids, texts in texts_of(batches):
            for i, t in zip(ids, texts, strict=True):
                if i not in for_words:
                    continue
                bad = toxic[i] > 0
                found = {w for w in _WORD.findall(t.lower()) if len(w) >= SHORTEST}
                n.update((w, bad) for w in found)
            if len(n) > 500_000:
                yield from out(n)
                n.clear()
        yield from out(n)

    def out(n):
        if n:
            yield record_batch({"word": ([w for w, _ in n], pa.string()), "bad": ([b for _, b in n], pa.bool_()), "n": (list(n.values()), pa.int64())})

    counted = rows.mapInArrow(words, "word string, bad boolean, n long").groupBy("word").agg(
        F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("bad"), 0).otherwise(F.col("n"))).alias("b")
    )
    na = sum(toxic[i] > 0 for i in for_words)
    nb = len(for_words) - na
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    weight = F.log(a / (na + 1)) - F.log(b / (nb + 1))
    sure = weight - 2 * F.sqrt(1 / a + 1 / b)
    best = counted.filter("a >= 3").select("word", weight.alias("w"), sure.alias("sure")).filter(F.col("sure") > CERTAIN).orderBy(F.desc("sure"), "word").limit(LEXICON)
    lexicon = {r.word: r.w for r in best.collect()}

    def features(batches):
        use = Features(lexicon)
        for ids, texts in texts_of(batches):
            rest = [(i, t) for i, t in zip(ids, texts, strict=True) if i not in for_words]
            yield record_batch({"doc_id": ([i for i, _ in rest], pa.int64()), "x": (use.matrix([t for _, t in rest]).tolist(), pa.list_(pa.float64()))})

    # one row an id: with repeated ids the first by text
    got = rows.mapInArrow(features, "doc_id long, x array<double>").groupBy("doc_id").agg(F.min("x").alias("x")).collect()
    got.sort(key=lambda r: r.doc_id)
    return Model(lexicon, np.array([r.x for r in got]).reshape(len(got), len(NAMES)), np.array([float(toxic[r.doc_id] > 0) for r in got]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    ship(docs.sparkSession)

    def run(batches):
        use = Features(model.lexicon)
        for ids, texts in texts_of(batches):
            s = np.clip(model.score(use.matrix(texts)), 0, 1)
            yield record_batch({"doc_id": (ids, pa.int64()), "score": (s.tolist(), pa.float64())})

    scored = id_text(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(~training_fold(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, all columns, that the model doesn't call toxic."""
    ship(docs.sparkSession)

    def run(batches):
        use = Features(model.lexicon)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                keep = model.score(use.matrix([t or "" for t in part.column("text").to_pylist()])) < 0.5
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
