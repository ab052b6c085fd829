"""Whole documents: unfolding links into JSON, and loading JSON into classes.

Unfolding goes down level by level, a join of the frontier with each class that it holds, and comes back up
by grouping children under their parents; nothing is expanded on the driver. A document that is met again on
its own path from the root stays an IRI, so cycles end. The number of expanded documents is limited.

Loading reads documents as JSON text, one a row: nested documents become rows of their own class, links
their keys, and a document without an @id gets one by the strategy of its class.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..sources.versions import Delta
from .catalog import CatalogError
from .shared import checkpoint

WORK = 500_000  # expanded documents, as many as the reference's default allows operations


class WorkLimit(RuntimeError):
    """Unfolding would expand more documents than allowed."""


def _field(name: str, json: Any):
    return F.concat(F.lit(f'"{name}":'), json)


def _quoted(c: Any):
    return F.substring(F.to_json(F.array(c)), 2, 1 << 30).substr(F.lit(1), F.length(F.to_json(F.array(c))) - 2)


def unfold(low: Any, cls: str, keys: DataFrame | None = None, classes: Iterable[str] | None = None, limit: int = WORK) -> DataFrame:
    """id, document (JSON text) of a class, or of those with a raw key in `keys` (key).

    Links to subdocuments and to unfoldable classes are unfolded, or to `classes` if given; others are IRIs.
    """
    catalog = low.catalog
    wanted = {k for k, d in catalog.classes.items() if d.subdocument or d.unfoldable} if classes is None else {c for k in classes for c in (k, *catalog.concrete(k))}
    d = catalog.get(cls)
    ids = d.frame().select(low.iri(d.raw_key(), cls).alias("id"))
    if keys is not None:
        ids = d.frame().withColumn("key", d.raw_key()).join(keys.select("key").distinct(), "key", "left_semi").select(low.iri(F.col("key"), cls).alias("id"))
    level = checkpoint(ids.distinct().select(F.col("id").alias("pos"), "id", F.array("id").alias("path"), F.lit(cls).alias("cls")))
    levels, work = [], level.count()
    while True:
        if work > limit:
            raise WorkLimit(f"more than {limit} documents to expand")
        own, links = _expanded(low, level, wanted)
        own, links = checkpoint(own), checkpoint(links)
        levels.append((own, links))
        level = links.filter("expand").select(F.col("child").alias("pos"), F.col("to").alias("id"), F.concat("path", F.array("to")).alias("path"), F.col("of").alias("cls"))
        n = level.count()
        if not n:
            break
        work += n
    below = None
    for own, links in reversed(levels):
        json = _quoted(F.col("to"))
        if below is not None:
            links = links.join(below.select(F.col("pos").alias("child"), F.col("doc").alias("_doc")), "child", "left")
            json = F.coalesce("_doc", json)
        one = links.groupBy("pos", "prop", "many").agg(F.sort_array(F.collect_list(F.struct("place", json.alias("j")))).alias("xs"))
        listed = F.array_join(F.transform("xs", lambda x: x["j"]), ",")
        fields = one.select("pos", "prop", _field_of(F.col("prop"), F.when(F.col("many"), F.concat(F.lit("["), listed, F.lit("]"))).otherwise(listed)).alias("f"))
        fields = fields.groupBy("pos").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("prop", "f"))), lambda x: x["f"]), ",").alias("fs"))
        joined = own.join(fields, "pos", "left")
        below = joined.select("pos", "id", F.concat(F.lit("{"), F.array_join(F.array_compact(F.array("plain", "fs")), ","), F.lit("}")).alias("doc"))
    return below.select("id", F.col("doc").alias("document"))


def _field_of(name: Any, json: Any):
    return F.concat(F.lit('"'), name, F.lit('":'), json)


def _expanded(low: Any, level: DataFrame, wanted: set[str]) -> tuple[DataFrame, DataFrame]:
    """(pos, id, plain: the JSON fields that are no links; pos, prop, many, place, to, of, path, child, expand) of a level."""
    catalog, own, links = low.catalog, None, None
    for k in [r.cls for r in level.select("cls").distinct().collect()]:  # classes, as many as the catalogue has
        d, props = catalog.get(k), catalog.properties(k)
        rows = d.frame().withColumn("_id", low.iri(d.raw_key(), k)).join(level.filter(F.col("cls") == k).select("pos", "path", F.col("id").alias("_id")), "_id")
        plain = [F.col("_id").alias("@id"), F.lit(k).alias("@type"), *[F.col(p.column).alias(p.name) for p in props.values() if not p.link]]
        js = F.to_json(F.struct(*plain))
        mine = rows.select("pos", F.col("_id").alias("id"), js.substr(F.lit(2), F.length(js) - 2).alias("plain"))
        own = mine if own is None else own.unionByName(mine)
        for p in (p for p in props.values() if p.link):
            to = F.posexplode(F.transform(F.col(p.column), low.iri_of(p.link)) if p.many else F.array(low.iri(F.col(p.column), p.link)))
            # a link may meet any class that inherits; an IRI's class is what stands before its first slash
            family = [c for c in {p.link, *catalog.concrete(p.link)} if catalog.get(c).frame and not catalog.get(c).abstract]
            of = F.when(F.substring_index("to", "/", 1).isin(family), F.substring_index("to", "/", 1)).otherwise(F.lit(p.link))
            found = rows.select("pos", "path", to.alias("place", "to")).filter("to is not null").select(
                "pos", "path", F.lit(p.name).alias("prop"), F.lit(p.many).alias("many"), "place", "to", of.alias("of")
            )
            links = found if links is None else links.unionByName(found)
    if own is None:  # no rows at all
        return level.select("pos", "id", F.lit(None).cast("string").alias("plain")), _no_links(level)
    if links is None:
        return own, _no_links(level)
    links = links.withColumn("child", F.concat_ws("/", "pos", "prop", F.col("place").cast("string")))
    met = None
    for k in sorted(wanted):  # only documents that are there are expanded
        d = catalog.get(k)
        if d.frame and not d.abstract:
            there = d.frame().select(low.iri(d.raw_key(), k).alias("to"), F.lit(k).alias("of")).distinct()
            met = there if met is None else met.unionByName(there)
    if met is None:
        return own, links.withColumn("expand", F.lit(False))
    marked = links.join(met.withColumn("_there", F.lit(True)), ["to", "of"], "left")
    return own, marked.withColumn("expand", F.coalesce("_there", F.lit(False)) & ~F.array_contains("path", F.col("to"))).drop("_there")


def _no_links(level: DataFrame) -> DataFrame:
    return level.select("pos", "path", F.lit("").alias("prop"), F.lit(False).alias("many"), F.lit(0).alias("place"), F.col("id").alias("to"), F.lit("").alias("of"), F.col("pos").alias("child"), F.lit(False).alias("expand")).limit(0)


class Loader:
    """JSON documents into the classes of a store's branch."""

    def __init__(self, store: Any, branch: str = "main"):
        self.store, self.catalog, self.branch = store, store.catalog, branch

    def rows(self, documents: DataFrame, column: str = "document") -> dict[str, DataFrame]:
        """Rows of every class that the documents (JSON text) hold, nested ones too."""
        out: dict[str, DataFrame] = {}
        todo = documents.select(F.col(column).alias("j")).withColumn("cls", F.get_json_object("j", "$['@type']"))
        unknown = todo.filter(F.col("cls").isNull() | ~F.col("cls").isin([k for k, d in self.catalog.classes.items() if not d.abstract])).head()
        if unknown:
            raise CatalogError(f"a document needs the @type of a class: {unknown.j[:200]}")
        while True:
            todo = checkpoint(todo)
            classes = [r.cls for r in todo.select("cls").distinct().collect()]
            if not classes:
                return out
            nested = None
            for k in classes:
                mine = todo.filter(F.col("cls") == k)
                out[k] = (out[k].unionByName(self._parsed(k, mine)) if k in out else self._parsed(k, mine)).distinct()
                for p in (p for p in self.catalog.properties(k).values() if p.link):
                    parts = F.from_json(F.get_json_object("j", f"$['{p.name}']"), "array<string>") if p.many else F.array(F.get_json_object("j", f"$['{p.name}']"))
                    inner = mine.select(F.explode(parts).alias("x")).filter("x like '{%'")
                    inner = inner.select(F.col("x").alias("j"), F.coalesce(F.get_json_object("x", "$['@type']"), F.lit(p.link)).alias("cls"))
                    nested = inner if nested is None else nested.unionByName(inner)
            if nested is None:
                return out
            todo = nested

    def iri_of(self, j: Any, cls: str):
        """The @id of a document, or one by its class's strategy.

        A document may be met twice, as itself and from the one that holds it, so what stands for a random id
        is a hash of its text; equal texts are one document.
        """
        d, props = self.catalog.get(cls), self.catalog.properties(cls)
        base, given = F.lit(f"{cls}/"), F.get_json_object(j, "$['@id']")
        by_column = {p.column: p for p in props.values()}
        named = [by_column[k] for k in d.key if k in by_column]
        values = [F.get_json_object(j, f"$['{p.name}']") for p in (named or props.values())]
        if d.strategy == "hash":
            made = text.hash_key(base, values)
        elif d.strategy in ("valuehash", "random"):
            made = F.concat(base, F.sha2(j, 256))
        elif d.strategy == "lexical":
            made = text.lexical_key(base, values)
        else:
            made = F.concat(base, F.concat_ws("_", *values)) if named else F.lit(None).cast("string")
        return F.coalesce(given, made)

    def _parsed(self, cls: str, docs: DataFrame) -> DataFrame:
        d, props, old = self.catalog.get(cls), self.catalog.properties(cls), self.store.read(cls, self.store.head(self.branch))
        cells = {}
        for p in props.values():
            kind = old.schema[p.column].dataType
            raw = F.get_json_object("j", f"$['{p.name}']")
            if p.link:
                cells[p.column] = F.transform(F.from_json(raw, "array<string>"), self._keys_of(p.link)).cast(kind) if p.many else self._keys_of(p.link)(raw).cast(kind)
            else:
                cells[p.column] = F.from_json(raw, kind.simpleString()) if p.many else raw.cast(kind)
        iri = self.iri_of(F.col("j"), cls)
        if len(d.key) == 1:
            at = self._key(iri, cls).cast(old.schema[d.key[0]].dataType)
            cells[d.key[0]] = F.coalesce(cells[d.key[0]], at) if d.key[0] in cells else at
        rows = docs.select(*[cells.get(c.name, F.lit(None)).cast(c.dataType).alias(c.name) for c in old.schema])
        short = rows.filter(F.greatest(*[F.col(k).isNull() for k in d.key], F.lit(False))).head()
        if short:
            raise CatalogError(f"a {cls} needs its key: {', '.join(d.key)}")
        return rows

    def _keys_of(self, cls: str):
        """From what a link holds, an IRI or a nested document, to the key of its column."""
        return lambda x: self._key(F.when(x.startswith("{"), self.iri_of(x, cls)).otherwise(x), cls)

    def _key(self, iri: Any, cls: str):
        """What stands in a column for an IRI."""
        return iri if self.catalog.get(cls).key == ("iri",) else F.regexp_replace(iri, f"^{cls}/", "")

    def load(self, documents: DataFrame, replace: bool = False, merge_repeats: bool = False, column: str = "document", **note: Any) -> str:
        """One commit of all documents. replace: documents of a key that is there are replaced, else they are an error.

        merge_repeats: of several documents of one key the fields that are given are put together (the first in
        order where they differ); otherwise that is an error, as is a value that breaks the class.
        """
        base = self.store.base(self.branch)
        state = {}
        for cls, rows in self.rows(documents, column).items():
            key = list(self.catalog.get(cls).key)
            if merge_repeats:
                rest = [c for c in rows.columns if c not in key]
                rows = rows.groupBy(*key).agg(*[F.min(c).alias(c) for c in rest]) if rest else rows.distinct()
            elif rows.groupBy(*key).count().filter("count > 1").head():
                raise CatalogError(f"several documents for one key of {cls}")
            rows = checkpoint(rows)
            wrong = self.catalog.with_frames({cls: lambda rows=rows: rows}).check(cls).filter(F.size("errors") > 0).select("errors").head()
            if wrong:
                raise CatalogError(f"{cls}: {', '.join(wrong.errors)}")
            old = self.store.read(cls, base[1])
            if not replace and rows.join(old.select(*key), key, "left_semi").head():
                raise CatalogError(f"a {cls} of that key is there: replace it")
            state[cls] = Delta(rows.select(*old.columns))
        return self.store.write(state, self.branch, base=base, **note)
