"""Main text of web pages: markup roles and a host suffix array.

A page becomes a stream of blocks. Scripts, styles, navigation, footers, forms and the like, and what
class names mark as advert, notice, sidebar, teaser or reader comment, go by their markup; so do articles
inside such a box, or marked so themselves. The token streams of a host's pages are concatenated and
their suffixes sorted; substrings of RUN tokens or more that occur on two pages or more are boilerplate
and are cut out of the blocks outside article and main elements. Unique runs stay, whatever stands beside
them or is linked. Blocks inside an article or main element stay although they repeat: copied articles
and quoted passages are text, and a corpus holds many.

If all articles of a page lie in marked boxes and such a box is never closed, markup is broken there: the
page is read again with such boxes ending where an article begins (boxes of comments and teasers don't).

Suffixes are sorted by prefix doubling until RUN tokens are told apart: coverage by runs of RUN tokens
or more is the union of the RUN-token windows that repeat, so deeper order would change nothing.

Every page goes through its host's suffix array. For a page with an article or main element it tells how many
words of its text repeat on the host (n_repeated); for any other it also decides the text.

A host of at most SHARD pages and BYTES of html is one part, sorted in one task. The pages of a larger host
are dealt to parts; each has a suffix array of its own, and what repeats across parts is found by the names
(64-bit hashes) of RUN-token windows. Few windows need comparing: equal windows hold the same least hash of
GRAM tokens in a row, so first the parts' least hashes are compared, packed, and only windows whose least hash
comes in several parts send their names, with the pages that hold them. So what repeats is the same as with
one suffix array over the host.

A null or empty html, and a page without text, gives an empty string. Repeated rows are rows each (the
same page_id counts as one page). An empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, record_batch, ship

RUN, GRAM, SHARD, BYTES, MANY = 8, 4, 512, 1 << 24, 50_000
BUCKETS, KEY_BITS = 512, 40

# Element names and the words of class, id and role that mark what is no main text.
RAW = {"script", "style", "textarea", "title", "noscript", "xmp", "iframe"}
AWAY = {"head", "nav", "footer", "header", "aside", "form", "noscript", "iframe", "svg", "button", "select", "template", "dialog", "menu", "object", "canvas", "audio", "video", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
HINTS = set("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup sidebar widget widgets related recommended recommendations share sharing social breadcrumb breadcrumbs nav navbar navigation menu footer header masthead comment comments disqus replies respond login search pagination pager toolbar skip sitemap copyright".split())
OWN = {"article", "entry", "post", "content", "story"}
VOICES = set("comment comments reply replies respond disqus teaser teasers related recommended recommendations".split())
APART = VOICES | set("sponsored sponsor promoted promo advert advertisement".split())
_BOXES = {"div", "section", "span"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}

_TAG = re.compile(r"<!--(?:.*?-->|.*)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|<[!?/][^>]*+>", re.S)
_MARK = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|itemprop)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_SPACE = re.compile(r"\s+")


def _aside(attrs: str, inside: bool, name: str = "") -> tuple[bool, bool]:
    """(whether the element's attributes mark it as no main text, whether as comments or teasers)."""
    gone = apart = False
    for key, *values in _MARK.findall(attrs):
        value = next((v for v in values if v), "").lower()
        key = key.lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "role" and value in ROLES):
            gone = True
        if key in ("class", "id") and name not in ("html", "body", "main"):
            for word in value.split():
                parts = set(re.split(r"[-_]+", word))
                apart = apart or bool(parts & VOICES)
                # an article's own header is its heading; its class names often hold topics, so only words of APART count there
                own = parts & HINTS == {"header"} and bool(parts & OWN)
                gone = gone or bool(parts & (APART if name == "article" else HINTS) and not (inside and own))
    return gone, apart


def blocks(page: str) -> list[tuple[bool, float, str]]:
    """(inside an article or main element, share of link text, text) for each block that markup lets stay."""
    found, held, open_box = _read(page, False)
    if held and open_box and not any(inside for inside, _, _ in found):
        found, _, _ = _read(page, True)
    return found


def _read(page: str, loose: bool) -> tuple[list[tuple[bool, float, str]], bool, bool]:
    """Blocks, whether a marked box (not of comments or teasers) held an article, and whether one was never closed.

    If loose, such a box ends where an article begins.
    """
    out: list[tuple[bool, float, str]] = []
    text: list[str] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # name, away, article, a marked box that an article may end
    away = article = links = linked = 0
    held = open_box = False

    def close():
        nonlocal linked
        if text:
            joined = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            if joined:
                out.append((article > 0, min(1.0, linked / max(1, len(joined))), joined))
            text.clear()
        linked = 0

    def say(part: str):
        nonlocal linked
        if part and not away:
            text.append(part)
            if links:
                linked += len(part)

    def leave(k: int, closed: bool):
        """Takes elements off the stack from k; closed: the one at k by its own end tag."""
        nonlocal away, article, links, open_box
        for at, (name, a, b, box) in enumerate(stack[k:]):
            away -= a
            article -= b
            links -= name == "a"
            # an end tag goes to the innermost element of its name, so an open one further out tells as much
            open_box = open_box or (name in _BOXES and not (closed and at == 0))
        del stack[k:]

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        end, attrs = (m[1] or m[4]) == "/", m[3] or m[6] or ""
        if name in BLOCK:
            close()
        elif name == "br":
            say(" ")
        if end:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    leave(k, True)
                    break
            continue
        if name in RAW:
            stop = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = stop.end() if stop else n
            continue
        if name in VOID or attrs.endswith("/"):
            continue
        main = name in ("article", "main")
        marked, apart = _aside(attrs, article > 0 or main, name)
        gone = (name in AWAY and not (name == "header" and article)) or marked
        if main and not gone and any(s[3] for s in stack):
            held = True
            if loose:
                for k, (x, a, b, box) in enumerate(stack):
                    if box:
                        stack[k] = (x, False, b, False)
                        away -= a
        if name == "body" and any(s[0] == "head" for s in stack):
            leave(next(k for k, s in enumerate(stack) if s[0] == "head"), True)
        main = main and not gone
        stack.append((name, gone, main, marked and not apart and name in _BOXES))
        away += gone
        article += main
        links += name == "a"
    close()
    leave(0, False)
    return out, held, open_box


def suffix_ranks(rank: np.ndarray, run: int) -> np.ndarray:
    """Ranks of the suffixes by their first `run` tokens, by prefix doubling; equal ranks share them all."""
    depth, n = 1, len(rank)
    while depth < run:
        step = min(depth, run - depth)
        after = np.full(n, -1, np.int64)
        after[: n - step] = rank[step:]
        both = rank * (int(rank.max()) + 2) + after + 1
        order = np.argsort(both)  # the suffix array so far
        new = np.concatenate(([0], np.cumsum(np.diff(both[order]) != 0)))
        rank = np.empty(n, np.int64)
        rank[order] = new
        depth += step
    return rank


def repeated(streams: list[np.ndarray], pages: list[int], run: int = RUN) -> list[np.ndarray]:
    """For each token stream, which tokens lie in a run that also occurs on another page."""
    sizes = [len(s) for s in streams]
    if not sum(sizes):
        return [np.zeros(n, bool) for n in sizes]
    ends = np.cumsum([n + 1 for n in sizes])
    total = int(ends[-1])
    tokens = np.zeros(total, np.int64)
    page = np.zeros(total, np.int64)
    for s, p, e in zip(streams, pages, ends.tolist(), strict=True):
        tokens[e - 1 - len(s) : e - 1] = s
        page[e - 1 - len(s) : e] = p
    _, rank = np.unique(tokens, return_inverse=True)
    rank = rank.astype(np.int64) + len(ends)
    rank[ends - 1] = np.arange(len(ends))  # separators are all different, so no run crosses one
    rank = suffix_ranks(rank, run)
    # suffixes in order; neighbours of one rank share `run` tokens at least
    n = int(rank.max()) + 1
    low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
    np.minimum.at(low, rank, page)
    np.maximum.at(high, rank, page)
    begins = (low[rank] != high[rank]).astype(np.int64)
    cover = np.cumsum(begins)
    cover[run:] -= np.cumsum(begins)[:-run]
    return [cover[e - 1 - k : e - 1] > 0 for e, k in zip(ends.tolist(), sizes, strict=True)]


def main_text(page: list[tuple[bool, float, str]], covered: list) -> str:
    """covered: for each block, which of its words lie in repeated runs (or one value for all of them)."""
    if any(inside for inside, _, _ in page):
        return "\n".join(t for inside, _, t in page if inside)
    out = []
    for (_, _, t), c in zip(page, covered, strict=True):
        if np.any(c):
            words = t.split()
            t = " ".join(w for w, gone in zip(words, np.broadcast_to(c, len(words)).tolist(), strict=True) if not gone)
        if t:
            out.append(t)
    return "\n".join(out)


_UNIT, _FIELD = "\x1e", "\x1f"
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes of the words, the same in every process."""
    once = {w: xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in set(words)}
    return np.fromiter(map(once.__getitem__, words), np.uint64, len(words))


def windows(tokens: np.ndarray, site: int, run: int = RUN) -> np.ndarray:
    """A 64-bit hash of each `run` tokens in a row and the host's hash."""
    n = len(tokens) - run + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out = np.full(n, site & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for k in range(run):
        out = (out ^ tokens[k : k + n]) * _ODD[k]
        out ^= out >> np.uint64(32)
    return out


def least(tokens: np.ndarray, site: int) -> np.ndarray:
    """For each window of RUN tokens a key of KEY_BITS bits, equal for equal windows; neighbours mostly share it."""
    grams = windows(tokens, site, GRAM)
    n = len(tokens) - RUN + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    low = grams[:n].copy()
    for k in range(1, RUN - GRAM + 1):
        np.minimum(low, grams[k : k + n], out=low)
    return (low * _ODD[0]) >> np.uint64(64 - KEY_BITS)  # least hashes are small; the product spreads them


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of their bytes."""
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending keys by their differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=np.uint64)


def _words(page: list[tuple[bool, float, str]]) -> list[str]:
    return [w for _, _, t in page for w in t.split()]


def _opened(blobs):
    opened = zstandard.ZstdDecompressor()
    for blob in blobs:
        text = opened.decompress(blob).decode("utf-8", "surrogatepass")
        yield [(a == "1", float(b), t) for a, b, t in (x.split(_FIELD, 2) for x in text.split(_UNIT))] if text else []


def _rows(part: pa.Table, found: list, cover: list[np.ndarray]) -> pa.Table:
    """Rows of the result; cover: which tokens of a page lie in repeated runs."""
    texts, again = [], []
    for f, c in zip(found, cover, strict=True):
        each = np.split(c, np.cumsum([len(t.split()) for _, _, t in f])[:-1]) if c.any() else [c] * len(f)
        texts.append(main_text(f, each))
        again.append(sum(int(x.sum()) for (inside, _, _), x in zip(f, each, strict=True) if inside) if c.any() else 0)
    out = record_batch({"page_id": (part.column("page_id").to_pylist(), pa.int64()), "url": (part.column("url").to_pylist(), pa.string()), "text": (texts, pa.string()), "n_chars": ([len(t) for t in texts], pa.int64()), "n_repeated": (again, pa.int64())})
    return pa.Table.from_batches([out])


_RESULT = "page_id long, url string, text string, n_chars long, n_repeated long"


def extract(pages: DataFrame, shard: int = SHARD) -> DataFrame:
    """page_id, url, text, n_chars for every row; n_repeated: words of the text in runs that another page of the host has.

    Runs outside articles are cut out, so only text inside an article or main element counts there.
    """
    ship(pages.sparkSession)
    spark = pages.sparkSession
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)), F.lit(""))
    base = base.withColumn("host", host)

    def parse(batches):
        squeeze = zstandard.ZstdCompressor(3)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                blobs = [squeeze.compress(_UNIT.join(f"{int(i)}{_FIELD}{s:.3f}{_FIELD}{t}" for i, s, t in blocks(text)).encode("utf-8", "surrogatepass")) for text in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("page_id", "url", "host", "row")), pa.array(blobs, pa.binary())], names=["page_id", "url", "host", "row", "blob"])

    parts = F.ceil(F.greatest(F.count("*") / shard, F.sum(F.octet_length("html")) / BYTES))
    large = materialise(base.groupBy("host").agg(parts.alias("parts")).filter("parts > 1"), "large-hosts")
    n_large, n_parts = large.agg(F.count("*"), F.coalesce(F.sum("parts"), F.lit(0))).first()
    # sent to all tasks only if they are few, else joined by host
    sizes = F.broadcast(large) if n_large <= MANY else large
    parsed = base.withColumn("row", F.xxhash64("page_id", "url", "html")).select("page_id", "url", "host", "row", "html").mapInArrow(parse, "page_id long, url string, host string, row long, blob binary")
    dealt = parsed.join(sizes, "host", "left").select(
        F.xxhash64("host", F.expr("pmod(row, coalesce(parts, 1))")).alias("part"), F.xxhash64("host").alias("site"), (F.col("parts") > 1).alias("large"), F.xxhash64("page_id").alias("page"), "page_id", "url", "blob"
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = dealt.repartition(n, "part")  # one shuffle, read by each step
    if not n_large:
        return held.groupBy("part").applyInArrow(_solve, _RESULT)
    met = held.groupBy("part").cogroup(_across(held, n_parts).groupBy("part"))
    return met.applyInArrow(_solve_with, _RESULT)


def _across(held: DataFrame, n_parts: int) -> DataFrame:
    """(part, names): the windows of parts of large hosts that come on two pages or more, in several parts."""
    buckets = max(BUCKETS, n_parts // 32)

    def dealt(keys: np.ndarray, bits: int) -> list[tuple[int, slice]]:
        """Where each bucket's share of ascending keys lies; `bits`: how many a key has beyond KEY_BITS."""
        bucket = ((keys >> np.uint64(bits)) * np.uint64(buckets) >> np.uint64(KEY_BITS)).astype(np.int64)
        begins = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
        return [(int(bucket[a]), slice(a, b)) for a, b in zip(begins, begins[1:] + [len(keys)], strict=True)] if begins else []

    def send(part: pa.Table) -> pa.Table:
        out = []
        if part.column("large")[0].as_py():
            _, tokens, sizes, site = _held(part)
            keys = np.unique(least(tokens, site)[_whole(sizes)])
            out = [(b, part.column("part")[0].as_py(), pack_sorted(keys[at])) for b, at in dealt(keys, 0)]
        return _table(out, bucket=pa.int64(), part=pa.int64(), keys=pa.binary())

    def common(bucket: pa.Table) -> pa.Table:
        lists = [unpack_sorted(k) for k in bucket.column("keys").to_pylist()]
        every = np.sort(np.concatenate(lists))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        kept = [k[np.isin(k, twice, assume_unique=True)] for k in lists]
        return _table([(p, pack_sorted(k)) for p, k in zip(bucket.column("part").to_pylist(), kept, strict=True) if len(k)], part=pa.int64(), keys=pa.binary())

    def name(part: pa.Table, met: pa.Table) -> pa.Table:
        out = []
        if part.num_rows and met.num_rows:
            keys = np.concatenate([unpack_sorted(k) for k in met.column("keys").to_pylist()])
            _, tokens, sizes, site = _held(part)
            sent = np.flatnonzero(_whole(sizes) & np.isin(least(tokens, site), keys))
            names, pages = windows(tokens, site)[sent], np.repeat(part.column("page").to_numpy(), sizes)[sent]
            order = np.lexsort((pages, names))
            names, pages = names[order], pages[order]
            first = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1]))[: len(names)])
            last = np.concatenate((first[1:], [len(names)]))[: len(first)] - 1
            for b, at in dealt(names[first], 64 - KEY_BITS):
                # the least and the greatest page of each, by their places among the pages
                known, place = np.unique(np.concatenate((pages[first[at]], pages[last[at]])), return_inverse=True)
                low, high = np.split(place.astype(np.int64), 2)
                out.append((b, part.column("part")[0].as_py(), pack_sorted(names[first[at]]), pack(known), pack(low), pack(high - low)))
        return _table(out, bucket=pa.int64(), part=pa.int64(), names=pa.binary(), pages=pa.binary(), low=pa.binary(), span=pa.binary())

    def again(bucket: pa.Table) -> pa.Table:
        lists, lows, highs = [], [], []
        for names, pages, low, span in zip(*(bucket.column(c).to_pylist() for c in ("names", "pages", "low", "span")), strict=True):
            known, at = unpack(pages).view(np.int64), unpack(low).view(np.int64)
            lists.append(unpack_sorted(names))
            lows.append(known[at])
            highs.append(known[at + unpack(span).view(np.int64)])
        every, place = np.unique(np.concatenate(lists), return_inverse=True)
        least_page, most = np.full(len(every), np.iinfo(np.int64).max), np.full(len(every), np.iinfo(np.int64).min)
        np.minimum.at(least_page, place, np.concatenate(lows))
        np.maximum.at(most, place, np.concatenate(highs))
        repeats = np.split((least_page != most)[place], np.cumsum([len(x) for x in lists])[:-1])
        return _table([(p, pack_sorted(x[r])) for p, x, r in zip(bucket.column("part").to_pylist(), lists, repeats, strict=True) if r.any()], part=pa.int64(), names=pa.binary())

    keys = held.groupBy("part").applyInArrow(send, "bucket long, part long, keys binary")
    met = keys.groupBy("bucket").applyInArrow(common, "part long, keys binary")
    named = held.groupBy("part").cogroup(met.groupBy("part")).applyInArrow(name, "bucket long, part long, names binary, pages binary, low binary, span binary")
    return named.groupBy("bucket").applyInArrow(again, "part long, names binary")


def _table(rows: list[tuple], **types: pa.DataType) -> pa.Table:
    return pa.table({c: pa.array([r[k] for r in rows], t) for k, (c, t) in enumerate(types.items())})


def _held(part: pa.Table) -> tuple[list, np.ndarray, np.ndarray, int]:
    """Blocks of each page, the tokens of all pages, how many each has, and the hash of the host."""
    found = list(_opened(part.column("blob").to_pylist()))
    words = [_words(f) for f in found]
    sizes = np.array([len(w) for w in words], np.int64)
    return found, hashes(list(chain.from_iterable(words))), sizes, part.column("site")[0].as_py()


def _whole(sizes: np.ndarray, run: int = RUN) -> np.ndarray:
    """Which windows of `run` tokens lie in one page, for tokens of all pages in a row."""
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(int(sizes.sum()))
    return left[: max(0, len(left) - run + 1)] >= run


def _solve(part: pa.Table) -> pa.Table:
    """The rows of a part by its suffix array."""
    return _solve_with(part, None)


def _solve_with(part: pa.Table, across: pa.Table | None) -> pa.Table:
    """The same, with the names of windows that repeat in other parts of the host."""
    found, tokens, sizes, site = _held(part)
    ends = np.cumsum(sizes)
    _, pages = np.unique(part.column("page").to_numpy(), return_inverse=True)
    cover = repeated(np.split(tokens.view(np.int64), ends[:-1]), pages.tolist())
    if across is not None and across.num_rows:
        names = np.concatenate([unpack_sorted(x) for x in across.column("names").to_pylist()])
        begins = _whole(sizes) & np.isin(windows(tokens, site), names)
        far = np.zeros(len(tokens), bool)
        for k in range(RUN):
            far[k : k + len(begins)] |= begins
        cover = [c | d for c, d in zip(cover, np.split(far, ends[:-1]), strict=True)]
    return _rows(part, found, cover)
