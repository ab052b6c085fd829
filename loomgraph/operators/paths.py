"""Regular paths over an edge frame (s, p, o).

Pairs: patterns are joined, united and closed as sets of pairs. With start nodes, only what they reach is
read: every part of a sequence starts from what the part before it reached, closures expand a frontier over
the raw edges, and classes that no link leads to aren't scanned. Closures run semi-naive; each round writes
the pairs that are new to the shared folder, which cuts the lineage. Paths: every pattern extends rows
(s, at, nodes, edges); closures don't visit a node twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import algebra as A
from ..plans.shared import checkpoint

#: (name or None for any, classes of the subjects or None for any, classes of the objects or None) -> s, p, o
Edges = Callable[..., DataFrame]
#: (name, classes, backwards) -> classes that an edge leads to
Step = Callable[[str | None, frozenset, bool], frozenset]
Classes = frozenset | None


def reached(pattern: A.Pattern, classes: Classes, step: Step) -> Classes:
    """The classes that a pattern may lead to from nodes of some classes; None is any."""
    if classes is None:
        return None
    if isinstance(pattern, (A.Pred, A.Inverse)):
        return step(pattern.name, classes, isinstance(pattern, A.Inverse))
    if isinstance(pattern, A.Seq):
        for part in pattern.parts:
            classes = reached(part, classes, step)
        return classes
    if isinstance(pattern, A.Alt):
        return frozenset().union(*(reached(x, classes, step) for x in pattern.parts))
    seen, new = frozenset(), classes
    while not new <= seen:
        seen |= new
        new = reached(pattern.part, new, step)
    low = pattern.low if isinstance(pattern, A.Times) else 1 if isinstance(pattern, A.Plus) else 0
    return seen | new if low == 0 else new | frozenset().union(*(reached(pattern.part, frozenset([c]), step) for c in seen))


def pairs(pattern: A.Pattern, edges: Edges, starts: DataFrame | None = None, classes: Classes = None, step: Step | None = None) -> DataFrame:
    """(s, o) distinct pairs; with starts (a frame of distinct s) only from there, whose classes may be known."""
    go = lambda p, at, cs: pairs(p, edges, at, cs, step)
    after = lambda p, cs: reached(p, cs, step) if step else None
    if isinstance(pattern, (A.Pred, A.Inverse)):
        if isinstance(pattern, A.Pred):
            e = edges(pattern.name, classes, None).select("s", "o")
        else:
            e = edges(pattern.name, None, classes).select(F.col("o").alias("s"), F.col("s").alias("o"))
        return e if starts is None else e.join(starts, "s", "left_semi")
    if isinstance(pattern, A.Seq):
        out = go(pattern.parts[0], starts, classes)
        for k, part in enumerate(pattern.parts[1:]):
            classes = after(pattern.parts[k], classes)
            at = None if starts is None else out.select(F.col("o").alias("s")).distinct()
            out = compose(out, go(part, at, classes))
        return out.distinct()
    if isinstance(pattern, A.Alt):
        out = go(pattern.parts[0], starts, classes)
        for part in pattern.parts[1:]:
            out = out.unionByName(go(part, starts, classes))
        return out.distinct()
    if starts is not None:
        low, high = (1, None) if isinstance(pattern, A.Plus) else (0, None) if isinstance(pattern, A.Star) else (pattern.low, pattern.high)
        return _from(lambda at, cs: go(pattern.part, at, cs), starts, classes, lambda cs: after(pattern.part, cs), low, high)
    whole = go(pattern.part, None, classes)
    if isinstance(pattern, A.Plus):
        return closure(whole)
    zero = whole.select("s").union(whole.select("o")).distinct().select("s", F.col("s").alias("o"))
    if isinstance(pattern, A.Star):
        return zero.unionByName(closure(whole)).distinct()
    if isinstance(pattern, A.Times):
        out = at = zero if pattern.low == 0 else None
        for k in range(1, pattern.high + 1):
            at = whole if at is None or k == 1 else compose(at, whole)
            if k >= max(pattern.low, 1):
                out = at if out is None else out.unionByName(at)
        return out.distinct()
    raise TypeError(f"no path pattern: {pattern}")


def compose(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("s", F.col("o").alias("_m")).join(b.select(F.col("s").alias("_m"), "o"), "_m").select("s", "o")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for x in frames[1:]:
        out = out.unionByName(x)
    return out


def _from(hop: Callable, starts: DataFrame, classes: Classes, after: Callable, low: int, high: int | None) -> DataFrame:
    """What `low` to `high` hops reach from the starts: each round expands the nodes that the last one reached."""
    at = zero = starts.select("s", F.col("s").alias("o")).distinct()
    if high is not None:  # by numbers of hops a pair may be met again
        kept = [zero] if low == 0 else []
        for k in range(1, high + 1):
            at = checkpoint(compose(at, hop(at.select(F.col("o").alias("s")).distinct(), classes)).distinct())
            classes = after(classes)
            if k >= low:
                kept.append(at)
        return _union(kept).distinct()
    found: list[DataFrame] = []
    while classes is None or after(classes):  # else no link leads on
        new = compose(at, hop(at.select(F.col("o").alias("s")).distinct(), classes)).distinct()
        for old in found:
            new = new.join(old, ["s", "o"], "left_anti")
        at = checkpoint(new)
        if at.isEmpty():
            break
        found.append(at)
        classes = after(classes)
    if not found:
        return zero if low == 0 else zero.limit(0)
    out = _union(found)
    return out if low else zero.unionByName(out).distinct()


def closure(step: DataFrame) -> DataFrame:
    """All pairs that one step or more reach; each round joins only the pairs that are new, and writes only them."""
    new = step = checkpoint(step.distinct())
    found = [new]
    while not new.isEmpty():
        more = compose(new, step).distinct()
        for old in found:
            more = more.join(old, ["s", "o"], "left_anti")
        new = checkpoint(more)
        found.append(new)
    return _union(found)


def paths(pattern: A.Pattern, edges: Edges, starts: DataFrame | None = None) -> DataFrame:
    """(s, o, path): one row a path; path is the list of its edges."""
    if starts is None:
        e = edges(None, None, None)
        starts = e.select("s").union(e.select(F.col("o"))).distinct()
    begin = starts.select("s", F.col("s").alias("at"), F.array("s").alias("nodes"), F.array().cast("array<struct<s:string,p:string,o:string>>").alias("path"))
    return _extend(pattern, begin, edges, False).select("s", F.col("at").alias("o"), "path")


def _extend(pattern: A.Pattern, rows: DataFrame, edges: Edges, fresh: bool) -> DataFrame:
    if isinstance(pattern, (A.Pred, A.Inverse)):
        a, b = ("s", "o") if isinstance(pattern, A.Pred) else ("o", "s")
        e = edges(pattern.name, None, None).select(F.col(a).alias("at"), F.col(b).alias("_to"), F.struct(F.col("s").cast("string").alias("s"), F.col("p").cast("string").alias("p"), F.col("o").cast("string").alias("o")).alias("_e"))
        met = rows.join(e, "at")
        if fresh:
            met = met.filter(~F.array_contains("nodes", F.col("_to")))
        return met.select("s", F.col("_to").alias("at"), F.array_append("nodes", F.col("_to")).alias("nodes"), F.array_append("path", F.col("_e")).alias("path"))
    if isinstance(pattern, A.Seq):
        for part in pattern.parts:
            rows = _extend(part, rows, edges, fresh)
        return rows
    if isinstance(pattern, A.Alt):
        out = [_extend(part, rows, edges, fresh) for part in pattern.parts]
        first = out[0]
        for x in out[1:]:
            first = first.unionByName(x)
        return first
    if isinstance(pattern, A.Times):
        out, at = (rows if pattern.low == 0 else None), rows
        for k in range(1, pattern.high + 1):
            at = _extend(pattern.part, at, edges, True)
            if k >= max(1, pattern.low):
                out = at if out is None else out.unionByName(at)
        return out
    at = checkpoint(_extend(pattern.part, rows, edges, True))
    out = at if isinstance(pattern, A.Plus) else rows.unionByName(at)
    while not at.isEmpty():
        at = checkpoint(_extend(pattern.part, at, edges, True))
        out = out.unionByName(at)
    return out


def parse(text: str) -> A.Pattern:
    """The text form: names, '.', '<name' or 'name>' for direction, ',' for sequence, '|', '+', '*', '?', '{n,m}', brackets."""
    import re

    tokens = re.findall(r"\s*([A-Za-z_@:][\w:@/-]*|\{\d+(?:,\d+)?\}|[.,|+*?()<>])", text)
    if "".join(tokens) != re.sub(r"\s+", "", text):
        raise ValueError(f"no path: {text}")
    at = 0

    def peek():
        return tokens[at] if at < len(tokens) else None

    def take(x=None):
        nonlocal at
        got = peek()
        if got is None or (x and got != x):
            raise ValueError(f"{x or 'a pattern'} expected in {text}")
        at += 1
        return got

    def alt():
        parts = [seq()]
        while peek() == "|":
            take()
            parts.append(seq())
        return parts[0] if len(parts) == 1 else A.Alt(parts)

    def seq():
        parts = [post()]
        while peek() == ",":
            take()
            parts.append(post())
        return parts[0] if len(parts) == 1 else A.Seq(parts)

    def post():
        out = atom()
        while peek() and (peek() in "+*?" or peek()[0] == "{"):
            x = take()
            if x == "+":
                out = A.Plus(out)
            elif x == "*":
                out = A.Star(out)
            elif x == "?":
                out = A.Times(out, 0, 1)
            else:
                low, _, high = x[1:-1].partition(",")
                out = A.Times(out, int(low), int(high or low))
        return out

    def atom():
        x = take()
        if x == "(":
            out = alt()
            take(")")
            return out
        if x == "<":
            n = take()
            n = None if n == "." else n
            if peek() == ">":
                take()
                return A.Alt([A.Inverse(n), A.Pred(n)])
            return A.Inverse(n)
        if x in ".|,+*?)>" or x[0] == "{":
            if x != ".":
                raise ValueError(f"unexpected {x} in {text}")
        if peek() == ">":
            take()
        return A.Pred(None if x == "." else x)

    out = alt()
    if at < len(tokens):
        raise ValueError(f"unexpected {tokens[at]} in {text}")
    return out
