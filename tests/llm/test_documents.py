"""Operators on documents against the libraries or brute force, on the smallest table and on odd rows."""

import base64
import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import xxhash

from loomgraph.llm import bpe_fst, fingerprint, licences, packing, pii, repair, simhash, tokens, toxicity
from loomgraph.llm.common import table

ODD = [
    (1, None), (2, ""), (3, " "), (4, "a"), (5, "A b"), (6, "a b c d"), (6, "a b c d"), (7, "line\nline\n\n two  spaces\ttab nbsp é ß Σ 中 😀"),
    (8, "word " * 9000), (9, "x" * 5000), (None, "no id here"), (10, "mail a.b@c.de or +1 (988) 555-2485, 4387513035237269 at 10.0.0.1"), (12, "The MIT License\n\nLicensed under the Apache License, Version 2.0."),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, "x", 1, "extra") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, units string, bucket int, fp string")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="session")
def docs(spark, sf):
    return table(spark, sf, "documents")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


def library(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_packing(rows, wanted):
    at = defaultdict(list)
    for r in rows:
        at[r.sequence_id].append(r)
    for pieces in at.values():
        pieces.sort(key=lambda r: r.offset)
        end = 0
        for r in pieces:
            assert r.offset == end and r.length > 0
            end += r.length
        assert end == pieces[0].sequence_tokens <= 4096
        assert end == 4096 or end & (end - 1) == 0
    seen = defaultdict(list)
    for r in rows:
        seen[r.doc_id].append(r)
    for doc, lists in wanted.items():
        pieces = sorted(seen.pop(doc), key=lambda r: (r.start, r.length))
        assert sum(r.length for r in pieces) == sum(map(len, lists))
        for r in pieces:
            assert any(crc(ids[r.start : r.start + r.length]) == r.ids_crc32 and r.doc_tokens == len(ids) for ids in lists)
    assert not seen


def test_packing(docs, texts, odd, none):
    lib = library("word_bpe_49k.json")
    check_packing(packing.pack(docs, P.path("word_bpe_49k.json")).collect(), {i: [lib(t)] for i, t in texts.items()})
    wanted = defaultdict(list)
    for i, t in ODD:
        wanted[i].append(lib(t))
    check_packing(packing.pack(odd, P.path("word_bpe_49k.json")).collect(), wanted)
    assert packing.pack(none, P.path("word_bpe_49k.json")).count() == 0


def test_rests_that_fit_nowhere_are_bounded():
    ids = np.arange(3000, dtype="<u4").tobytes()
    p = packing.Packer(4096, 1 << 20)
    out, most = [], 0
    for k in range(5000):
        out += [(n, k) for n, _ in p.add(k, ids)]
        most = max(most, p.held)
        assert p.held == sum(4 * n * len(w) for n, w in p.open.items())
    out += [(n, None) for n, _ in p.finish()]
    assert most <= (1 << 20) + 12_000 and sum(n for n, _ in out) == 5000 * 3000
    assert all(n == 4096 for n, k in out if k is not None) and sum(n < 4096 for n, _ in out) <= 12


def test_sum_of_squares_choice():
    p = packing.Packer(10)
    p.level[[3, 6]] = 1, 2
    assert p.place(4) == 6  # fills a window to the brim
    assert p.place(8) == 0
    p.level[:] = 0
    p.level[[2, 5]] = 3, 1
    assert p.place(3) == 2 or p.place(3) == 5


def test_token_files(docs, texts, odd, none, spark, tmp_path):
    lib = library("byte_bpe_50k.json")

    def check(got, rows):
        start = 0
        for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
            ids = lib(t)
            assert (i, start, len(ids), crc(ids)) in got
            start += len(ids)
        assert len(got) == len(rows)

    for df, rows in ((docs, list(texts.items())), (odd, ODD)):
        check([tuple(r) for r in repair.write_and_read(df, P.path("byte_bpe_50k.json")).collect()], rows)
    assert repair.write_and_read(none, P.path("byte_bpe_50k.json")).count() == 0


def test_byte_encoder_cuts_at_line_ends():
    lib, enc = library("byte_bpe_50k.json"), tokens.ByteEncoder(P.path("byte_bpe_50k.json"))
    ends = ["one two.\nThree, four\nfive", "\na b\n", "\n", "a\n\nb c\nd", "x'\n's 't\n'll", "1\n2 3.\n.4", "é,\nÉ ß.\nñ", "a \nb", "a\n b", "a\tb\nc", "a\r\nb", "a\n\n\nb\n", "a\x01,\nb", "日本\n語 本.\n語"]
    for t in ends * 2:
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == lib(t)[:-1], t
    enc = tokens.ByteEncoder(P.path("byte_bpe_50k.json"))
    enc.encode("alpha beta.\nGamma delta")
    assert set(enc.spaced) == {"beta.", "beta", "delta"}  # no word is kept with the next line's


def test_byte_encoder_takes_texts_together(monkeypatch):
    ends = ["one two.\nThree, four\nfive", "\na b\n", "\n", "a\n\nb c\nd", "x'\n's 't\n'll", "1\n2 3.\n.4", "é,\nÉ ß.\nñ", "a \nb", "a\n b", "a\tb\nc", "a b\n", " a", "a ", " "]
    ends += ["", "a\x01,\nb", "\x00 a\x00 \x7f", "日本\n語 本.\n語", "a., b,. c,, , .", "don't, we'll.", "x" * 9000 + " " + "é" * 5000 + ".", "<|endoftext|> a", "À Àa Ġb", "e\u0301t, \u0301.", "\u1c89a \U0001f600, ꟊ.", "ª ǅ ʰ, ⅷ."]
    path = P.path("byte_bpe_50k.json")
    lib = library("byte_bpe_50k.json")
    rows = [(k, t) for k, t in enumerate(ends * 3)]
    want = [(k, lib(t)[:-1]) for k, t in rows]
    for together, known, call in ((1 << 24, 1 << 20, 1 << 13), (300, 200, 7), (12, 0, 1)):
        monkeypatch.setattr(tokens, "TOGETHER", together)
        monkeypatch.setattr(tokens, "KNOWN", known)
        monkeypatch.setattr(tokens, "CALL", call)
        enc = tokens.ByteEncoder(path)
        assert [(k, np.frombuffer(x, "<u4").tolist()) for k, x in enc.encode_rows(iter(rows))] == want
        assert enc.known.nbytes + enc.known_ids.nbytes <= max(known, 16)
        enc.between = b""  # a vocabulary without such a byte
        enc.known, enc.known_ids = enc.known[:0], enc.known_ids[:0]
        assert [np.frombuffer(x, "<u4").tolist() for _, x in enc.encode_rows(rows)] == [x for _, x in want]
    assert list(enc.encode_rows([])) == []


def test_new_words_go_to_the_model_together():
    """One call a word, and a look in a dict each time it comes, took more CPU than the budget of op2."""
    enc, calls = tokens.ByteEncoder(P.path("byte_bpe_50k.json")), []
    alone, bare = enc.model, enc.bare

    class Alone:
        def tokenize(self, text):
            calls.append(text)
            return alone.tokenize(text)

    class Bare:
        def encode_batch_fast(self, texts, **kw):
            calls.append(texts)
            return bare.encode_batch_fast(texts, **kw)

    enc.model, enc.bare = Alone(), Bare()
    words = ["".join(chr(97 + k // 26**j % 26) for j in range(4)) for k in range(3000)]
    text = " ".join(words) + ", " + ". ".join(words) + "\n" + ", ".join(words)
    lib = library("byte_bpe_50k.json")
    for _ in range(2):
        assert np.frombuffer(next(enc.encode_rows([(0, text)]))[1], "<u4").tolist() == lib(text)[:-1]
        assert len(calls) < 10


def test_words_are_forgotten_by_bytes():
    m = tokens._Words(lambda k: bytes(8), 100_000)
    for k in range(5000):
        assert m[f"w{k}"] == bytes(8) and m.held <= m.half
    assert len(m) + len(m.old) < 700 and m["w1"] == bytes(8) and m["é" * 4000] == bytes(8) and "é" * 4000 not in m


def test_repair_random_access():
    rng = np.random.default_rng(3)
    ids = np.concatenate([rng.integers(0, 60, 3000), np.tile([7, 7, 7, 8], 500), rng.integers(0, 50256, 500)]).astype("<u4")
    starts = np.array([0, 10, 11, 2990, 4000, 5400])
    block = repair.Shard(repair.to_shard(ids, starts))
    assert len(block.rules) and len(block.sequence) < len(ids)
    assert np.array_equal(block.all_ids(), ids)
    for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
        assert np.array_equal(block.document(k), ids[a:b])
    assert len(repair.Shard(repair.to_shard(np.zeros(0, "<u4"), np.zeros(0, int))).all_ids()) == 0


def test_repair_goes_on_until_no_pair_is_frequent():
    rng = np.random.default_rng(4)
    words = [rng.integers(0, 50_000, rng.integers(2, 9)) for _ in range(300)]
    text = np.concatenate([words[k] for k in rng.zipf(1.3, 40_000) % 300]).astype("<u4")
    for ids in (np.tile([5, 9], 100_000), np.full(70_001, 3), text, rng.integers(0, 4, 50_000), np.array([7]), np.array([7, 7])):
        ids = ids.astype("<u4")
        x, rules = repair.compress(ids)
        assert np.array_equal(repair.expand(x, rules), ids) and len(rules) <= 1 << 16
        least = max(repair.LEAST, len(ids) // repair.SHARE)
        pairs, n = np.unique(repair._keys(x[:-1], x[1:]), return_counts=True)
        # a run of one symbol holds half as many places as it has pairs
        assert all(c < least or a >> np.uint64(32) == a & np.uint64(0xFFFFFFFF) for a, c in zip(pairs, n))
    assert len(repair.compress(np.tile([5, 9], 100_000).astype("<u4"))[0]) < 60
    big = np.concatenate([text, np.full(50, 1 << 20)]).astype("<u4")
    assert np.array_equal(repair.Shard(repair.to_shard(big, np.array([0]))).all_ids(), big)


def test_token_files_of_one_hot_id(spark):
    lib = library("byte_bpe_50k.json")
    rows = [(3, f"text {k}") for k in range(200)] + [(2, "a"), (4, "b")]
    to = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, repair.write_and_read(to, P.path("byte_bpe_50k.json")).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [2] + [3] * 200 + [4] and sorted((i, n, c) for i, _, n, c in got) == sorted((i, len(lib(t)), crc(lib(t))) for i, t in rows)
    assert [r[1] for r in got] == np.concatenate([[0], np.cumsum([r[2] for r in got])[:-1]]).tolist()


def test_transducer(docs, texts, odd, none):
    import tiktoken

    ranks = bpe_fst.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def row(i, t):
        ids = enc.encode_ordinary(t or "")
        return i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()

    for df, rows in ((docs, list(texts.items())), (odd, ODD)):
        got = bpe_fst.encode_decode(df, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(repr(row(*r)) for r in rows)
    assert bpe_fst.encode_decode(none, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).count() == 0


def test_streaming_decode():
    ranks = {bytes([b]): b for b in range(256)}
    text = "aé中😀"
    ids = list(text.encode())
    stream = bpe_fst.Utf8Stream({v: k for k, v in ranks.items()})
    assert "".join(stream.feed(ids[k : k + 1], k + 1 == len(ids)) for k in range(len(ids))) == text


def lanes(text):
    """The multiset of units of a text, for exact likeness."""
    out = defaultdict(int)
    for p in text.split("\n"):
        ws = p.split(" ")
        for a, b in zip(ws, [*ws[1:], None]):
            out[a, b] += 1
    return out


def test_fingerprint(docs, texts, odd, none):
    rows = sorted(texts.items())
    got = {r.doc_id: r for r in fingerprint.edit_likeness(docs).collect()}
    assert len(got) == len(rows)
    errors = []
    for (i, t), (_, nxt) in zip(rows, [*rows[1:], rows[0]]):
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for other, near in ((edited, r.near_edited), (nxt, r.near_next)):
            a, b = lanes(t), lanes(other)
            differ = sum((a[k] - b[k]) ** 2 for k in {*a, *b})
            errors.append(near - max(0, 1 - differ / (sum(a.values()) + sum(b.values()))))
    assert np.mean(np.abs(errors)) < 0.12
    by_text = defaultdict(set)
    for i, t in rows:
        by_text[t].add(got[i].fingerprint)
    assert all(len(v) == 1 for v in by_text.values()) and len({next(iter(v)) for v in by_text.values()}) == len(by_text)
    many = fingerprint.edit_likeness(odd).collect()
    assert len(many) == len(ODD)
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for (i, t), (_, nxt) in zip(order, [*order[1:], next(r for r in order if r[0] is not None)]):
        t, nxt = t or "", nxt or ""
        want = hashlib.sha256((t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]).encode()).hexdigest()
        assert any(r.doc_id == i and r.edited_sha256 == want for r in many), i
    assert fingerprint.edit_likeness(none).count() == 0


def test_fingerprint_is_homomorphic(spark):
    df = spark.createDataFrame([(1, "a b\nc d e"), (2, "c d e\na b"), (3, "a b"), (4, "c d e")], "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprint.fingerprints(df, ["doc_id"], "text").collect()}
    assert got[1].fingerprint == got[2].fingerprint
    assert [x + y for x, y in zip(got[3].lanes, got[4].lanes)] == got[1].lanes


def test_paragraphs_of_the_same_pairs_differ(spark):
    rows = [(1, "x b x c x"), (2, "x c x b x"), (3, "a b a c a\nq"), (4, "a c a b a\nq"), (5, "q\na b a c a"), (6, "q"), (7, "q\nq"), (8, "")]
    got = {r.doc_id: r.fingerprint for r in fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"], "text").collect()}
    assert got[3] == got[5] and len(set(got.values())) == len(rows) - 1


def test_paragraphs_put_in_and_taken_out(spark):
    from pyspark.sql import functions as F

    rows = [("whole", "a b\nc d e\nc d e\n"), ("part", "c d e"), ("rest", "a b\n\nc d e")]
    got = fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id string, text string"), ["doc_id"], "text").select("doc_id", "vector", "fingerprint")
    w, p, r = (got.filter(F.col("doc_id") == k).select(F.col("vector").alias(k), F.col("fingerprint").alias(f"{k}_text")) for k in ("whole", "part", "rest"))
    row = w.join(p).join(r).select(
        fingerprint.hex_text(fingerprint.minus(F.col("whole"), F.col("part"))).alias("less"), fingerprint.hex_text(fingerprint.plus(F.col("rest"), F.col("part"))).alias("more"), "whole_text", "rest_text",
    ).first()
    assert row.less == row.rest_text and row.more == row.whole_text


def test_fingerprints_of_many_ranges(spark):
    """Ranges of a few rows, one id with many texts, rows without id: every row meets its next one."""
    rows = [(k // 2, f"text {k} " * (k % 5)) for k in range(60)] + [(7, f"seven {k}") for k in range(40)] + [(None, f"none {k}") for k in range(9)] + [(7, "seven 3")] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string")
    signed = lambda t: int(np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1]), r[1]))
    first = next(r for r in order if r[0] is not None)
    want = sorted((i if i is not None else -1, hashlib.sha256((t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode()).hexdigest()) for (i, t), (_, n) in zip(order, [*order[1:], first]))
    for size in (1, 4, 1000):
        got = fingerprint.edit_likeness(df, size).collect()
        assert sorted((r.doc_id if r.doc_id is not None else -1, r.edited_sha256) for r in got) == want


def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    n = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            n[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * n[b] > len(shingles))


def components(rows):
    up = {k: k for k in {f for _, f in rows}}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    keys = sorted(up)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (a ^ b).bit_count() <= 3:
                up[root(a)] = root(b)
    least = {}
    for d, f in rows:
        if d is not None:
            least[root(f)] = min(d, least.get(root(f), d))
    return {(d, f"{f:016x}", least.get(root(f))) for d, f in rows}


def test_near_duplicates(docs, texts, odd, none):
    want = components([(i, plain_simhash(t)) for i, t in texts.items()])
    assert {tuple(r) for r in simhash.near_duplicates(docs).collect()} == want
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD) and {tuple(r) for r in got} == components([(i, plain_simhash(t)) for i, t in ODD])
    assert simhash.near_duplicates(none).count() == 0


def test_groups_go_through_rows_without_id(spark, monkeypatch):
    """9 - null - 3 - null in a chain of 3 bits each; 5 has two texts, one near 2 and one with a copy 6 bits off that is near it."""
    import corpus_pipeline

    prints = {"a": 0, "b": 7, "c": 63, "d": 511, "p": 0x7FFF << 40, "q": (0x7FFF << 40) ^ 7, "r": 0x5555 << 20, "s": (0x5555 << 20) ^ 3}
    rows = [(9, "a"), (None, "b"), (3, "c"), (None, "d"), (2, "p"), (5, "q"), (5, "r"), (5, "r"), (8, "s")]
    keys = {t: xxhash.xxh64_intdigest(t.encode(), 42) for t in prints}
    signed = lambda x: int(np.uint64(x).astype(np.int64))
    held = spark.createDataFrame([(i, signed(prints[t]), signed(keys[t])) for i, t in rows], "doc_id long, fp long, key long")
    monkeypatch.setattr(simhash, "fingerprinted", lambda docs: held)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert got == {(i, f"{prints[t]:016x}"): {"a": 3, "b": 3, "c": 3, "d": 3, "p": 2, "q": 2, "r": 5, "s": 5}[t] for i, t in rows}
    left = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == [(0, "b"), (0, "d"), (2, "p"), (3, "c"), (5, "r")]


def test_anchor_links_miss_nothing(spark):
    rng = np.random.default_rng(5)
    codes = set()
    for c in rng.integers(0, 2**63, 60).tolist():
        for _ in range(12):
            x = c
            for b in rng.integers(0, 64, rng.integers(0, 4)).tolist():
                x ^= 1 << b
            codes.add(x)
    chain, x = [], 1
    for k in range(40):  # a long chain of single links
        x ^= 7 << (k % 20) * 3
        chain.append(x)
    codes = sorted(codes | set(chain))
    signed = [int(np.uint64(c).astype(np.int64)) for c in codes]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    for block in (4096, 5):
        edges = simhash.links(df, block).collect()
        up = {s: s for s in signed}

        def root(x, up=up):
            while up[x] != x:
                x = up[x]
            return x

        for e in edges:
            assert (e.fp_a ^ e.fp_b).bit_count() <= 3 or (np.int64(e.fp_a).view(np.uint64) ^ np.int64(e.fp_b).view(np.uint64)).bit_count() <= 3
            up[root(e.fp_a)] = root(e.fp_b)
        want = {d: r for d, _, r in components(list(enumerate(codes)))}
        groups = defaultdict(set)
        for k, s in enumerate(signed):
            groups[root(s)].add(want[k])
        assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))


def test_links_of_units_with_one_home_and_one_visitor(spark):
    pairs = [(x, x ^ 1 << k) for k, x in enumerate(np.random.default_rng(9).integers(0, 2**62, 40).tolist())]
    df = spark.createDataFrame([(x,) for pair in pairs for x in pair], "fp long")
    assert {frozenset((e.fp_a, e.fp_b)) for e in simhash.links(df, 1).collect()} == set(map(frozenset, pairs))


def test_components_of_a_chain(spark):
    n = 300
    nodes = spark.createDataFrame([(k, (k * 7919) % n) for k in range(n)], "node long, label long")
    edges = spark.createDataFrame([(k, k + 1) for k in range(n - 1)], "u long, v long")
    assert {r.root for r in simhash.components(nodes, edges).collect()} == {0}


def test_toxicity_learns_and_keeps_clean(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    model = toxicity.learn(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [(got[r.doc_id], r.toxic) for r in labels.collect() if got[r.doc_id].held_out]
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    pairs = [(a.score > b.score) + (a.score == b.score) / 2 for a, x in held for b, y in held if x and not y]
    assert np.mean(pairs) > 0.7 and np.mean([r.predicted for r, y in held if not y]) < 0.05
    assert {r.predicted for r, y in held if y} >= {1}


def test_toxicity_odd(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (4, None), (None, 1), (8, 0)], "doc_id long, toxic int")
    assert toxicity.score(odd, toxicity.learn(odd, labels)).count() == len(ODD)
    empty = toxicity.learn(none, labels.limit(0))
    assert {r.score for r in toxicity.score(odd, empty).collect()} == {0.0}
    assert toxicity.clean(odd, empty).count() == len(ODD) and toxicity.clean(odd, empty).columns == odd.columns


def test_isotonic():
    x, y = toxicity.isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]))
    assert np.all(np.diff(np.interp([1, 2, 3, 4], x, y)) >= 0) and np.interp(2.5, x, y) == 0.5


def test_disguised_words():
    f = toxicity.Features({"idiot": 3.0, "trash": 2.0})
    assert f.hidden("an 1d10t") == [] and f.hidden("you i-d-i-o-t") == ["idiot"] and f.hidden("tr4sh") == ["trash"] and f.hidden("traaaash") == ["trash"] and f.hidden("tr*sh") == ["trash"]
    assert f.of("idiots are not idiot")[1] == 1


def plain_spans(text):
    out = {k: [] for k in pii.KINDS}
    for k, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": k == "ip" and all(int(p) <= 255 for p in m.group().split(".")), "card": 13 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[k]:
                out[k].append(m.span())
    return out


def test_personal_data(docs, texts, odd, none):
    got = {r.doc_id: r for r in pii.scan(docs).collect()}
    assert len(got) == len(texts)
    for i, t in texts.items():
        want = plain_spans(t)
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [len(want[k]) for k in pii.KINDS]
        assert got[i].base_sha256 == hashlib.sha256(pii.joined(want).encode()).hexdigest()
        assert set(filter(None, pii.joined(want).split(","))) <= set(got[i].spans.split(","))
    assert pii.scan(odd).count() == len(ODD) and pii.scan(none).count() == 0
    masked = {r.doc_id: r.text for r in pii.redact(odd).collect()}
    assert masked[10] == "mail <EMAIL> or <PHONE>, <CARD> at <IP>" and masked[1] is None


def test_patterns_brute_force():
    rng = np.random.default_rng(7)
    alphabet = list("a.b@c-1239+ ()_%")
    for _ in range(4000):
        t = "".join(rng.choice(alphabet, rng.integers(0, 40)))
        assert pii.base_spans(t) == plain_spans(t), t
    pii.base_spans("a" * 200_000 + "@" + "1" * 200_000)


def test_field_adds_and_leaves():
    field = pii.train()
    texts = ["please call me on 555-123-4567 or so", "mail anna@localhost now", "it was 1999 and 2001 with 12 apples at 3.50", "password=b7db7aa4a5fcc78305 was set"]
    found = [a for _, a in pii.find(texts, field)]
    assert [texts[0][a:b] for a, b in found[0]["phone"]] == ["555-123-4567"] and [texts[1][a:b] for a, b in found[1]["email"]] == ["anna@localhost"]
    assert pii.joined(found[2]) == "" and pii.joined(found[3]) == ""
    held_out = [r for k, r in enumerate(pii.table()) if k % 4 == 0]
    part = pii.train([r for k, r in enumerate(pii.table()) if k % 4])
    right = total = 0
    for words, tags in held_out:
        inside = [pii.can_be(w) for w in words]
        path = part.decode([part.scores(words, inside)])[0]
        right += sum(int(a == b) for a, b, ok in zip(path, tags, inside) if ok)
        total += sum(inside)
    assert right / total > 0.6


def test_long_numeric_texts_are_decoded_in_bounded_memory():
    import tracemalloc

    field = pii.train()
    texts = ["7 13 1999 " * 7000, *(f"in {k} call me at 555-123-4567 now" for k in range(600)), "12 " * 20_000 + "555-123-4567 x"]
    tracemalloc.start()
    found = [a for _, a in pii.find(texts, field)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20 and pii.joined(found[0]) == ""
    assert all(t[a:b] == "555-123-4567" for t, f in zip(texts[1:-1], found[1:-1]) for a, b in f["phone"]) and all(f["phone"] for f in found[1:-1])


def test_caches_are_bounded_by_bytes():
    from loomgraph.llm.tokens import _Memo

    memo = _Memo(lambda k: k.encode() * 2, 100_000)
    for k in range(5000):
        assert memo[f"key {k}"] == f"key {k}".encode() * 2
        assert memo.held <= 50_000 and len(memo) + len(memo.old) <= 500
    assert memo["x" * 10_000] == b"x" * 20_000 and "x" * 10_000 not in memo


def test_viterbi_brute_force():
    import itertools

    rng = np.random.default_rng(1)
    n = len(pii.TAGS)
    field = pii.Field({}, np.zeros((0, n)), rng.normal(size=(n, n)))
    batch = [rng.normal(size=(k, n)) for k in (1, 3, 2)]
    for s, path in zip(batch, field.decode(batch)):
        value = lambda p, s=s: sum(s[t, p[t]] for t in range(len(s))) + sum(field.move[a, b] for a, b in zip(p, p[1:]))
        best = max(itertools.product(range(n), repeat=len(s)), key=value)
        assert np.isclose(value(best), value(path.tolist()))


def test_licences(spark, odd, none):
    mit = licences.KNOWN["MIT"][2]
    rows = [(1, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace("\n", "\n\n") + "\n"), (2, mit[:-20]), (3, mit.replace("sublicense", "sub-licence").replace("COPYRIGHT HOLDERS", "COPYRIGHT OWNERS")), (4, "x\nReleased under the MIT Licence\ny")]
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[k].license for k in (1, 2, 3, 4)] == ["MIT", None, "MIT", None] and got[4].line_licenses == "MIT"
    many = {r.doc_id: r for r in licences.scan(odd).collect()}
    assert many[12].line_licenses == "Apache-2.0" and many[1].digest == many[2].digest and licences.scan(none).count() == 0


def test_published_licences_are_found(spark):
    """A file as published (title, copyright, wrapped lines), the same inside a document, a line a paragraph, and with a word changed."""
    import os
    import textwrap

    from loomgraph.llm import licence_texts

    wrapped = lambda ps: "\n\n".join(textwrap.fill(p, 72) for p in ps)
    mit, bsd, zlib_ = (licence_texts.TEXTS[k][0] for k in ("MIT", "BSD-3-Clause", "Zlib"))
    file = "MIT License\n\nCopyright (c) [year] [fullname]\n\n" + wrapped(mit) + "\n"
    rows = [(1, file), (2, "Read me first.\n\n" + file + "\nAnd then\nthis."), (3, "one line\n" + "\n".join(bsd) + "\nlast line"), (4, "\n\n".join(mit).replace("MERCHANTABILITY", "MERCHANDISE")), (5, "Copyright (c) 2001, X.\nAll rights reserved.\n\n" + wrapped(bsd)), (6, "Foo\n\n" + wrapped(zlib_) + "\n\n" + wrapped(mit) + "\n\nbar " * 500)]
    found = "/usr/share/common-licenses/"
    there = [x for x in ("Apache-2.0", "GPL-3", "MPL-2.0") if os.path.exists(found + x)]
    rows += [(10 + k, open(found + x).read()) for k, x in enumerate(there)] + [(20 + k, "Intro\n\n" + open(found + x).read() + "\n\nrest of the text") for k, x in enumerate(there)]
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[k].license for k in range(1, 7)] == ["MIT", None, None, None, "BSD-3-Clause", None]
    assert [got[k].text_licenses for k in range(1, 7)] == ["MIT", "MIT", "BSD-3-Clause", "", "BSD-3-Clause", "MIT,Zlib"]
    for k, x in enumerate(there):
        name = x + ".0" if x == "GPL-3" else x
        assert got[10 + k].license == name and name in got[10 + k].text_licenses.split(",") and got[20 + k].license is None and name in got[20 + k].text_licenses.split(",")
    assert len({*licence_texts.TEXTS, *licence_texts.NOTICES, *(d[0] for d in licences.DIGESTS)}) >= 30


def test_licences_say_the_same_in_sql(spark, docs, odd):
    import duckdb

    from loomgraph.llm.queries import OP8_SQL

    rows = [(i, t) for i, t in ODD if i is not None and i != 6] + [(100 + k, t) for k, t in enumerate(x for ts in (*licences.KNOWN.values(), *licences.TITLED.values()) for x in ts)]
    rows += [(500 + k, f"x\n\n{t}\n\ny") for k, (_, t) in enumerate(rows) if t]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    db = duckdb.connect()
    db.register("documents", df.toPandas())
    assert sorted(db.sql(OP8_SQL).fetchall()) == sorted(tuple(r) for r in licences.scan(df).select("doc_id", "digest", "license", "line_licenses", "n_license_lines", "text_licenses").collect())


def test_padded_licence_line(spark):
    rows = [(1, "x\n/*" + " " * 600 + "Released under the MIT License." + "-" * 300 + "*/\ny"), (2, "x\n" + "Released under the MIT License. " * 20)]
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].line_licenses, got[1].n_license_lines, got[2].line_licenses) == ("MIT", 1, "")
