"""Pages, vectors and the pipeline."""

import numpy as np
import pytest

from loomgraph.llm import hamming, html_text, pii, simhash, toxicity
from loomgraph.llm.common import table


def test_extracts_article():
    page = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><a href=x>Home</a></nav>
    <header>Site</header><div class="cookie-notice">We use cookies</div><article><h1>Head &amp; more</h1><p>One  <b>two</b>
    three<br><p>Four<p class="advert">Buy</p><div id="comments"><p>First!</p></div><form>Mail <input></form></article><aside>Side</aside><footer>&copy; x</footer>"""
    found = html_text.blocks(page)
    assert html_text.main_text(found, [0.0] * len(found)) == "Head & more\nOne two three\nFour"


@pytest.mark.parametrize("page", ["", "no tags at all", "<p>open", "<!-- never closed", "<a href='x", "<" * 2000, "<p " + "x='" * 500, "<script>while(1)", "a < b > c &lt;"])
def test_odd_html(page):
    found = html_text.blocks(page)
    assert isinstance(html_text.main_text(found, [0.0] * len(found)), str)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<article>Main</article><section class="comments"><article class="comment">Reader says hi</article></section>', "Main"),
        ('<article>Main<article class="comment">Reader</article> and more</article>', "Main\nand more"),
        ('<article>Main</article><article class="comment-body">Reader</article><article>Second</article>', "Main\nSecond"),
        ('<article>Main</article><section id="comments"><article>Reader</article></section>', "Main"),
        ('<article>Main<div class="post-comments"><article>Reader</article></div></article><div class="related"><article>Teaser</article></div>', "Main"),
        ('<div class="related"><article>Teaser</article></div><main class="with-sidebar"><p>Main</p></main>', "Main"),
        ('<body class="has-sidebar cookie"><div class="ad">Buy</div><article class="post category-ads"><header class="entry-header"><h1>Head</h1></header><p>Main</p></article></body>', "Head\nMain"),
        ('<div id="wrap"><div class="advert">Buy now<article>Main</article></div>', "Main"),  # a box that is never closed
        ('<div class="advert">Buy now <article>Offer</article></div><p>Rest</p>', "Rest"),
        ('<div class="comments"><article>Reader</article><p>x', ""),
        ('<div class="cookie-notice">We use <article>Main</article><section class="comments"><article>Reader</article></section>', "Main"),
    ],
)
def test_articles_in_marked_boxes(page, text):
    found = html_text.blocks(page)
    assert html_text.main_text(found, [0.0] * len(found)) == text


def test_repeats_against_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(60):
        run = int(rng.integers(2, 6))
        streams = [rng.integers(0, 3, rng.integers(0, 25)) for _ in range(rng.integers(1, 5))]
        pages = [int(rng.integers(0, 4)) for _ in streams]
        where = {}
        for s, p in zip(streams, pages):
            for k in range(len(s) - run + 1):
                where.setdefault(tuple(s[k : k + run]), set()).add(p)
        for s, got in zip(streams, html_text.repeated(streams, pages, run)):
            want = np.zeros(len(s), bool)
            for k in range(len(s) - run + 1):
                if len(where[tuple(s[k : k + run])]) > 1:
                    want[k : k + run] = True
            assert np.array_equal(got, want)


def test_host_boilerplate_goes(spark):
    foot = "<div>Terms of use and privacy policy apply to every visit of this site today</div>"
    rows = [(k, f"https://h.example/{k}", f"<body><div>Unique text number {k} about {'topic ' * k}</div>{foot}</body>", "h", 1) for k in range(6)]
    rows += [(90, None, None, None, None), (91, "nonsense", "", "x", 2), (0, "https://h.example/0", rows[0][2], "h", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, shard int")
    got = html_text.extract(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert by[1].text.startswith("Unique text number 1") and "Terms" not in by[1].text and by[90].text == "" and by[91].n_chars == 0
    assert html_text.extract(df.limit(0)).count() == 0


def test_large_host_loses_the_same_boilerplate(spark):
    """Runs on two pages only of a host, wherever its pages are dealt; an article repeats what a bare page says."""
    words = lambda seed, n: " ".join(f"w{x}" for x in np.random.default_rng(seed).integers(0, 10**6, n))
    rows = [(k, f"https://h.example/{k}", f"<body><div>{words(k, 20)}</div><div>{words(1000 + k // 2, 12)}</div></body>") for k in range(24)]
    rows += [(50, "https://h.example/50", f"<article>{words(0, 20)}</article>"), (None, "https://h.example/x", f"<div>{words(1, 20)}</div>"), rows[5], (7, "https://h.example/7b", "")]
    rows += [(60 + k, f"https://g.example/{k}", f"<div>{words(1000, 12)}</div>") for k in range(1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    key = lambda r: (r.page_id or -1, r.url, r.text, r.n_chars)
    whole = sorted(map(key, html_text.extract(df).collect()))
    assert len(whole) == len(rows)
    texts = {u: t for _, u, t, _ in whole}
    assert texts["https://h.example/0"] == "" and texts["https://h.example/1"] == "" and texts["https://h.example/9"] == words(9, 20) and texts["https://g.example/0"] == words(1000, 12)
    for shard in (1, 3):
        assert sorted(map(key, html_text.extract(df, shard).collect())) == whole


def test_unique_words_of_a_block_stay(spark):
    notice = "This article gives general information and is no advice of any kind"
    rows = [(k, f"https://h.example/{k}", f"<div>{notice} author{k} today{k}</div><p><a href=x>Everything unique{k} is linked here{k}</a> x{k}</p><div>one{k} {notice}</div>") for k in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for shard in (512, 1):
        got = {r.page_id: r.text for r in html_text.extract(df, shard).collect()}
        assert got == {k: f"author{k} today{k}\nEverything unique{k} is linked here{k} x{k}\none{k}" for k in range(3)}


def repeated_words(rows):
    """By brute force: for each row (page_id, url, html), how many words of its articles lie in RUN words that another page of the host has."""
    where, run = {}, html_text.RUN
    pages = [(i, (u or "").split("/")[2] if "//" in (u or "") else "", html_text.blocks(h or "")) for i, u, h in rows]
    words = [[w for _, _, t in f for w in t.split()] for _, _, f in pages]
    for (i, host, _), ws in zip(pages, words):
        for k in range(len(ws) - run + 1):
            where.setdefault((host, *ws[k : k + run]), set()).add(i)
    out = []
    for (_, host, f), ws in zip(pages, words):
        cover = [False] * len(ws)
        for k in range(len(ws) - run + 1):
            if len(where[(host, *ws[k : k + run])]) > 1:
                cover[k : k + run] = [True] * run
        inside = [x for x, _, t in f for _ in t.split()]
        out.append(sum(c and x for c, x in zip(cover, inside, strict=True)))
    return out


@pytest.mark.parametrize("shard", [3, 512])
def test_every_page_goes_through_its_hosts_suffix_array(spark, sf, shard):
    """Pages with an article too: their whole text stays, n_repeated is what the suffix array finds in it."""
    pages = table(spark, sf, "pages")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    words = lambda seed, n: " ".join(f"w{x}" for x in np.random.default_rng(seed).integers(0, 10**6, n))
    shared = words(0, 9)
    rows += [(10**6 + k, f"https://h.example/{k}", f"<article><p>{words(k + 1, 5)} {shared}<p>{words(k // 2 + 90, 8)}</article>") for k in range(12)]
    rows += [rows[-1], (None, "https://h.example/n", f"<main>{shared}</main>"), (None, "https://h.example/n", f"<main>{shared}</main>"), (10**6 + 50, "https://h.example/b", f"<p>own {shared}"), (10**6 + 51, "https://g.example/b", f"<article>{shared}</article>"), (10**6 + 52, "https://h.example/e", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {}
    for (i, u, h), n in zip(rows, repeated_words(rows)):
        want.setdefault((i, u), []).append(n)
    got = {}
    for r in html_text.extract(df, shard).collect():
        got.setdefault((r.page_id, r.url), []).append(r.n_repeated)
        if (r.page_id or 0) >= 10**6 and "h.example" in r.url and r.n_chars > 3:
            assert shared in r.text  # an article stays whole
    assert got == want and want[10**6, "https://h.example/0"] == [17] and want[10**6 + 51, "https://g.example/b"] == [0]
    assert sum(n for (i, _), ns in want.items() for n in ns if i is not None and i < 10**6) > 0  # the given pages have some


def test_windows_meet_by_their_least_hash():
    rng = np.random.default_rng(4)
    tokens = html_text.hashes([f"w{x}" for x in rng.integers(0, 2, 3000)])
    names, keys = html_text.windows(tokens, -5), html_text.least(tokens, -5)
    plain = [tuple(tokens[k : k + html_text.RUN].tolist()) for k in range(len(tokens) - html_text.RUN + 1)]
    assert len(set(zip(plain, names.tolist(), keys.tolist()))) == len(set(plain)) == len(set(names.tolist()))
    assert not set(names.tolist()) & set(html_text.windows(tokens, 6).tolist())
    assert not len(html_text.least(tokens[:7], 1)) and html_text._whole(np.array([0, 9, 3, 8, 7])).nonzero()[0].tolist() == [0, 1, 12]
    for big in (np.zeros(0, np.uint64), np.array([0], np.uint64), np.unique(rng.integers(0, 1 << 40, 5000).astype(np.uint64)), np.array([3, 2**64 - 1], np.uint64)):
        assert np.array_equal(html_text.unpack_sorted(html_text.pack_sorted(big)), big) and np.array_equal(html_text.unpack(html_text.pack(big[::-1])), big[::-1])


def test_article_of_test_pages(spark, sf):
    import html
    import re

    rows = {r.page_id: r.html for r in table(spark, sf, "pages").collect()}
    got = {r.page_id: r for r in html_text.extract(table(spark, sf, "pages")).collect()}
    assert got.keys() == rows.keys()
    for i, page in rows.items():
        body = re.search(r"<article>(.*?)(?:</article>|<footer|$)", page, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", body)
        want = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<br>", " ", re.sub(r"</?(?:b|a)(?: [^>]*)?>", "", x)))).strip() for x in parts]
        assert got[i].text == "\n".join(x for x in want if x) and got[i].n_chars == len(got[i].text)


def brute(codes, queries, k):
    out = set()
    for q, c in queries:
        best = sorted({((c ^ d).bit_count(), v) for v, d in codes if v is not None})[:k]
        out |= {(q, n + 1, v, d) for n, (d, v) in enumerate(best)}
    return out


@pytest.mark.parametrize("n", [0, 4, 300])
def test_top_k(spark, n):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 2**62, 20).tolist()
    codes = [(v, int(rng.choice(base)) ^ (int(rng.integers(0, 16)) << int(rng.integers(0, 58)))) for v in range(n)] + [(1000 + v, base[0]) for v in range(n // 2)]
    df = spark.createDataFrame(codes, "vec_id long, code long")
    queries = [c for c in codes if c[0] % 7 == 0]
    got = hamming.top_k(df, spark.createDataFrame(queries, "query_id long, code long"), 10).collect()
    assert {tuple(r) for r in got} == brute(codes, queries, 10) and len(got) == len({tuple(r) for r in got})


def test_top_k_writes_few_files(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(5)
    codes = [(v, int(c)) for v, c in enumerate(rng.integers(0, 2**62, 400))]
    spark.createDataFrame(codes, "vec_id long, code long").write.parquet(str(tmp_path / "codes"))
    df = spark.read.parquet(str(tmp_path / "codes"))
    kept, made = hamming.materialise, []
    monkeypatch.setattr(hamming, "materialise", lambda x, name: made.append(kept(x, name)) or made[-1])
    conf = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {c: spark.conf.get(c) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        out = hamming.top_k(df, df.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"), 10)
        assert {tuple(r) for r in out.collect()} == brute(codes, [c for c in codes if c[0] % 20 == 0], 10)
        assert len(made) > 1 and all(len(t.inputFiles()) <= hamming.FILES for t in made) and out.rdd.getNumPartitions() <= hamming.FILES
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_sign_codes(spark):
    df = spark.createDataFrame([(1, [0.5, -1.0, 2.0], 0), (2, None, 1), (3, [], 1), (4, [float("nan"), 1.0, None], 1), (5, [0.1] * 64, 2)], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r.code for r in hamming.sign_codes(df).collect()}
    assert got == {1: 5, 3: 0, 4: 2, 5: -1}


def test_long_embeddings_are_folded(spark):
    rng = np.random.default_rng(8)
    rows = [(k, rng.normal(size=n).round(3).tolist()) for k, n in enumerate((65, 128, 200, 64))]
    got = {r.vec_id: r.code for r in hamming.sign_codes(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    for k, e in rows:
        sums = [sum(float(np.float32(x)) for x in e[b::64]) for b in range(64)]
        assert np.int64(got[k]).view(np.uint64) == sum(1 << b for b, x in enumerate(sums) if x > 0)


def test_pipeline(spark, sf):
    import corpus_pipeline as cp

    docs = table(spark, sf, "documents")
    start = [r.asDict() for r in docs.collect()]
    model = toxicity.learn(docs, table(spark, sf, "labels"))
    bad = {r.doc_id for r in toxicity.score(docs, model).collect() if r.predicted}
    stages = dict(cp.STAGES)
    clean = stages["toxicity"](spark, docs, sf)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r["doc_id"] for r in start if r["doc_id"] not in bad) and clean.columns == docs.columns
    prints = {r["doc_id"]: simhash.fingerprint(r["text"] or "") for r in start if r["doc_id"] not in bad}
    kept = stages["simhash_near_dedup"](spark, clean, sf)
    left = {r.doc_id for r in kept.collect()}
    for d, f in prints.items():
        near = {e for e, g in prints.items() if (f ^ g).bit_count() <= 3}
        assert d in left or min(near) < d
    assert all((prints[a] ^ prints[b]).bit_count() > 3 for a in left for b in left if a < b) and kept.columns == docs.columns
    masked = stages["personal_data"](spark, kept, sf)
    assert {r.doc_id for r in masked.collect()} == left and masked.columns == docs.columns
    assert not any(v for r in masked.collect() for v in pii.base_spans(r.text).values())
    packed = cp.run(spark, sf)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == left


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    """Null, empty, repeated and very long rows, extra columns with clashing names, and empty tables, against plain Python."""
    import corpus_pipeline as cp

    words = lambda seed, n: " ".join(f"w{x}" for x in np.random.default_rng(seed).integers(0, 10**6, n))
    long = words(1, 30_000)
    rows = [(1, "a b c d"), (2, None), (3, ""), (4, "a b c d"), (5, long), (6, long + " x"), (7, words(2, 50)), (7, words(3, 50)), (7, words(3, 50)), (None, "no id, mail a@b.de"), (None, None), (8, "card 4387513035237269 and +1 (988) 555-2485")]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "k", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, key string, fp int")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    stages, sf_dir = dict(cp.STAGES), str(tmp_path)
    clean = stages["toxicity"](spark, docs, sf_dir)
    assert clean.count() == len(rows) and clean.columns == docs.columns  # nothing is learnt, nothing goes
    prints = [simhash.fingerprint(t or "") for _, t in rows]
    group = list(range(len(rows)))
    for _ in rows:  # components by repeated minima
        group = [min(g for g, q in zip(group, prints) if (p ^ q).bit_count() <= 3) for p in prints]
    want = [(None, t) for i, t in rows if i is None]
    for g in set(group):
        ids = [(i, t or "", t) for (i, t), h in zip(rows, group) if h == g and i is not None]
        if ids:
            least = min(i for i, _, _ in ids)
            want.append((least, {t for i, _, t in ids if i == least}))
    kept = stages["simhash_near_dedup"](spark, clean, sf_dir)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(want) and all(any(i == j and (t in u if isinstance(u, set) else t == u) for j, u in want) for i, t in got)
    masked = stages["personal_data"](spark, docs, sf_dir)
    assert masked.columns == docs.columns and masked.count() == len(rows)
    by = {r.doc_id: r for r in masked.filter("doc_id is not null").collect()}
    assert by[8].text == "card <CARD> and <PHONE>" and by[8].n_chars == len(by[8].text) and by[2].text is None and by[5].text == long
    packed = stages["packing"](spark, docs, sf_dir).collect()
    assert sum(r.length for r in packed) == sum({(r.doc_id, r.doc_tokens, k): r.doc_tokens for k, r in enumerate(packed) if r.start == 0}.values())
    none = docs.limit(0)
    assert all(stage(spark, none, sf_dir).count() == 0 for stage in stages.values())


def test_toxicity_against_plain_python(spark):
    """Lexicon hits word by word, trees walked node by node, calibration by a plain search: the same scores."""
    import re

    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    model = toxicity.learn(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    assert got.keys() == texts.keys()
    use = toxicity.Features(model.lexicon)

    def walk(tree, bins, k=1):
        f, at, value = tree[k]
        return value if f < 0 else walk(tree, bins, 2 * k + (bins[f] > at))

    def level(x):
        xs, ys = (c.tolist() for c in model.curve)
        if x <= xs[0] or x >= xs[-1]:
            return ys[0] if x <= xs[0] else ys[-1]
        k = max(j for j, a in enumerate(xs) if a <= x)
        return ys[k] if xs[k] == x else ys[k] + (ys[k + 1] - ys[k]) * (x - xs[k]) / (xs[k + 1] - xs[k])

    for i, t in texts.items():
        low = t.lower()
        x = use.of(t)
        plain = [w for w in re.findall(r"[^\W_]+", low) if w in model.lexicon]
        hidden = use.hidden(low)
        n = len(re.findall(r"[ \n]", low)) + 1
        assert x[1] == len(plain) + len(hidden) and x[2] == len({*plain, *hidden}) and np.isclose(x[0], x[1] / n) and np.isclose(x[3], sum(model.lexicon[w] for w in plain + hidden))
        bins = [sum(c <= v for c in cuts) for cuts, v in zip(model.trees.cuts, x)]
        raw = model.trees.base + sum(walk(tree, bins) for tree in model.trees.forest)
        flat, trace = level(raw), 1e-3 / (1 + np.exp(-np.clip(raw, -30, 30)))
        want = max(0.5, flat - (1e-3 - trace)) if flat >= 0.5 else min(0.4999, flat + trace)
        assert abs(got[i].score - min(1.0, max(0.0, want))) < 1e-9 and got[i].predicted == (got[i].score >= 0.5)
