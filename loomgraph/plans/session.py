"""What users hold: a session over a catalogue, or over a version of a store."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import algebra as A
from .catalog import Catalog
from .lower import Frame, Info, Lowerer


class Session:
    """Reads one version; `run` gives a lazy DataFrame with a column for each variable."""

    def __init__(self, spark: SparkSession, catalog: Catalog | None = None, store: Any = None, branch: str = "main"):
        self.spark, self.store, self.branch = spark, store, branch
        self.commit = store.head(branch) if store else None
        self.catalog = catalog or store.catalog_at(self.commit)
        self.named: dict[str, Any] = {}

    def define(self, query: Any) -> Session:
        self.named[query.name] = query
        return self

    def lowerer(self) -> Lowerer:
        return Lowerer(self.spark, self.catalog, self.named, self.store, commit=self.commit)

    def run(self, node: Any) -> DataFrame:
        if isinstance(node, A.NamedQuery):
            node = node.query
        low = self.lowerer()
        out = low.one(low.lower(node))
        names = list(out.info) if not isinstance(node, A.Select) else [v.name for v in node.variables]
        shown = [low.iri(F.col(n), out.info[n].cls).alias(n) if out.info[n].kind == "node" and out.info[n].cls else F.col(n) for n in names]
        return out.df.select(*shown) if shown else out.df.select()

    def write(self, node: Any, author: str = "", message: str = "") -> str:
        """Runs the writes of a query as one commit of a branch, which this session then reads if it is its own."""
        from .writes import Writer, effects

        if self.store is None:
            raise ValueError("a session without a store reads only")
        found = list(effects(node.query if isinstance(node, A.NamedQuery) else node, (), self.branch))
        if len({b for _, _, b in found}) != 1:
            raise ValueError("a commit is on one branch")
        branch = found[0][2]
        catalog, head = (self.catalog, self.commit) if branch == self.branch else (self.store.catalog_at(self.store.head(branch)), self.store.head(branch))
        if head != self.store.head(branch):
            raise ValueError(f"{branch} has moved since this session was opened")
        writer = Writer(Lowerer(self.spark, catalog, self.named, self.store, commit=head), self.store, branch)
        for reads, change, _ in found:
            writer.apply(reads, change)
        commit = writer.commit(author=author, message=message)
        if branch == self.branch:
            self.commit, self.catalog = commit, self.store.catalog_at(commit)
        return commit

    def count(self, node: Any) -> int:
        """Solutions without the outer paging."""
        return self.run(A.unpaged(node)).count()

    def stream(self, node: Any):
        """Rows one by one, partition by partition."""
        return self.run(node).toLocalIterator()

    def explain(self, node: Any) -> str:
        df = self.run(node)
        return A.text_of(node) + "\n\n" + df._jdf.queryExecution().toString()

    def drifted(self) -> bool:
        """Whether the branch has moved since this session was opened."""
        return self.store is not None and self.store.head(self.branch) != self.commit

    def sql(self, text: str) -> DataFrame:
        from .sql import run

        return run(self, text)

    def text(self, text: str) -> DataFrame:
        """A query in the text form."""
        from .text_form import parse

        return self.run(parse(text))

    def json(self, query: Any) -> DataFrame:
        """A query in the JSON form, as an object or as text."""
        from .json_form import from_json

        return self.run(from_json(query))

    def sparql(self, text: str) -> DataFrame:
        from .sparql import compile_sparql

        return self.run(compile_sparql(text))

    def xpath(self, text: str, documents: bool = False) -> DataFrame:
        """Results of a path; with `documents` the whole documents as JSON beside them."""
        from .xpath import compile_xpath

        return self.run(compile_xpath(text, documents))

    def unfold(self, cls: str, keys: DataFrame | None = None, classes: Any = None, limit: int | None = None) -> DataFrame:
        """id, document (JSON) of a class, links unfolded; see documents.unfold."""
        from .documents import WORK, unfold

        return unfold(self.lowerer(), cls, keys, classes, WORK if limit is None else limit)

    def documents(self, cls: str, skip: int = 0, count: int | None = None) -> DataFrame:
        """A page of a class's documents as JSON, in order of id, links as IRIs."""
        rows = self.unfold(cls, classes=())
        page = rows.orderBy("id").offset(skip)
        return page if count is None else page.limit(count)

    def instances(self, cls: str, where: dict | None = None, limit: int | None = None, offset: int = 0) -> DataFrame:
        """Documents of a class whose properties equal the given values, in order of id, a page of them."""
        found = self.model(cls).query({k: {"eq": x} for k, x in (where or {}).items()}).frame().orderBy("id").offset(offset)
        return found if limit is None else found.limit(limit)

    def count_instances(self, cls: str, where: dict | None = None) -> int:
        return self.model(cls).query({k: {"eq": x} for k, x in (where or {}).items()}).count()

    def entities(self, commit: str | None = None, cls: str | None = None) -> DataFrame:
        """cls, id of the documents that a commit (by default the one read) created."""
        if self.store is None:
            raise ValueError("a session without a store has no commits")
        return self.store.created(commit or self.commit, cls)

    def model(self, name: str):
        from .filters import Model

        return Model(self, name)


__all__ = ["Frame", "Info", "Session"]
