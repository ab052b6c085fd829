"""SQL over the classes: Spark's own SQL on views that hold what the catalogue lets SQL see.

Views show keys and links as IRIs. Where a link of one class is compared with the iri of the class it leads
to, the text is rewritten to compare the raw keys, so joins run on columns and filters reach the scan.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import CatalogError


def register(session) -> dict[str, str]:
    """A view for each class (iri, plain columns, links as IRIs); returns what is left out, with reasons."""
    catalog, low = session.catalog, session.lowerer()
    omitted = catalog.sql_omitted()
    for name, d in catalog.classes.items():
        if name in omitted or not d.frame:
            continue
        columns = [] if d.key == ("iri",) else [low.iri(d.raw_key(), name).alias("iri")]
        columns = columns or [F.col("iri")]
        for p in catalog.properties(name).values():
            if f"{name}.{p.name}" not in omitted:
                columns.append((low.iri(F.col(p.column), p.link) if p.link else F.col(p.column)).alias(p.name.lower()))
        keys = [] if d.key == ("iri",) else [d.raw_key().alias(f"iri{RAW}")]
        keys += [F.col(p.column).alias(f"{p.name.lower()}{RAW}") for p in catalog.properties(name).values() if p.link and f"{name}.{p.name}" not in omitted]
        d.frame().select(*columns).createOrReplaceTempView(name.lower())
        d.frame().select(*columns, *keys).createOrReplaceTempView(f"{name.lower()}{RAW}")
    return omitted


RAW = "__key"
_SKIP = r"'(?:[^']|'')*'|\"[^\"]*\"|--[^\n]*|/\*.*?\*/"
_WORD = r"`[^`]+`|[A-Za-z_]\w*"
_END = "where on join left right inner full cross outer semi anti natural using group order limit offset having union lateral window qualify as".split()


def aliases(session, text: str) -> dict[str, str]:
    """Names in FROM and JOIN that stand for one class in the whole text."""
    classes = {k.lower(): k for k, d in session.catalog.classes.items() if d.frame}
    bare = re.sub(_SKIP, lambda m: " " * len(m[0]), text, flags=re.S)
    found: dict[str, set] = {}
    for m in re.finditer(rf"(?:\bfrom\b|\bjoin\b|,)\s*({_WORD})(?!\s*[.(])(?:\s+(?:as\s+)?({_WORD}))?", bare, re.I):
        of, name = (x.strip("`").lower() if x else None for x in m.groups())
        if name in _END:
            name = None
        if of in classes:
            found.setdefault(name or of, set()).add(classes[of])
            if name and name != of:
                found.setdefault(of, set())
        elif name or of:
            found.setdefault(name or of, set()).add(None)
    # an alias of anything else (a subquery) hides a class of that name
    for m in re.finditer(rf"\)\s*(?:as\s+)?({_WORD})", bare, re.I):
        if m[1].strip("`").lower() not in _END:
            found.setdefault(m[1].strip("`").lower(), set()).add(None)
    return {k: next(iter(v)) for k, v in found.items() if len(v) == 1 and None not in v}


def rewritten(session, text: str) -> str:
    """link = iri comparisons over raw keys; an order comparison of a link or an iri is refused."""
    catalog, of = session.catalog, aliases(session, text)
    column = rf"({_WORD})\.({_WORD})"
    changed: set[str] = set()

    def target(a: str, b: str) -> str | None:
        """The class whose raw key a column holds."""
        cls = of.get(a.strip("`").lower())
        if cls is None:
            return None
        if b.strip("`").lower() == "iri":
            return cls if catalog.get(cls).key != ("iri",) else None
        return next((p.link for p in catalog.properties(cls).values() if p.link and p.name.lower() == b.strip("`").lower() and not p.many and catalog.get(p.link).key != ("iri",)), None)

    def one(m):
        if m[1] is None:
            return m[0]
        a, b, op, c, d = m.group(1, 2, 3, 4, 5)
        left, right = target(a, b), target(c, d)
        if op != "=" and (left or right):
            raise CatalogError(f"{a}.{b} {op} {c}.{d}: a link has no order")
        if op != "=" or left is None or left != right:
            return m[0]
        changed.update((a.strip("`").lower(), c.strip("`").lower()))
        return f"{a}.{b.strip('`')}{RAW} = {c}.{d.strip('`')}{RAW}"

    pattern = rf"{_SKIP}|{column}\s*(=|<=|>=|<(?!>)|>)\s*{column}(?!\s*[.(])"
    out = re.sub(pattern, one, text, flags=re.S)
    if not changed:
        return text
    # the views with raw keys stand in for those whose keys are compared; a star would show them, so then nothing changes
    if re.search(r"\*(?!\s*\))", re.sub(r"count\s*\(\s*\*\s*\)", "", re.sub(_SKIP, "", text, flags=re.S), flags=re.I)):
        return text

    def view(m):
        if m[1] is None or m[2].strip("`").lower() not in {k.lower() for k in catalog.classes}:
            return m[0]
        name = m[2].strip("`").lower()
        alias = (m[3] or "").strip("`")
        if alias.lower() in _END:
            alias = ""
        if (alias or name).lower() not in changed:
            return m[0]
        return f"{m[1]}`{name}{RAW}`" + (m[0][len(m[1]) + len(m[2]) :] if alias else f" AS `{name}`" + m[0][len(m[1]) + len(m[2]) :])

    return re.sub(rf"{_SKIP}|((?:\bfrom\b|\bjoin\b|,)\s*)({_WORD})(?!\s*[.(])(?:\s+(?:as\s+)?({_WORD}))?", view, out, flags=re.I | re.S)


def run(session, text: str) -> DataFrame:
    """One SELECT. Naming something left out says why it is."""
    if not re.match(r"\s*(select|with|explain)\b", text, re.I):
        raise CatalogError("only SELECT statements read")
    omitted = register(session)
    try:
        return session.spark.sql(rewritten(session, text))
    except AnalysisException as e:
        words = {w.lower() for w in re.findall(r"\w+", text)}
        for what, why in omitted.items():
            if what.split(".")[-1].lower() in words:
                raise CatalogError(f"{what} can't be used in SQL: {why}") from e
        raise
