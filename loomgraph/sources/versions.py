"""Versioned classes in a folder of any file system that Spark writes to.

A commit writes what it changes, as Parquet under its own id: whole classes, or a delta of rows that are put
in or replaced and keys that go. Then one small JSON row names, for every class, the commits whose files make
it up: a whole one and the deltas behind it, COMPACT of them at most, then the class is written anew. Reading
joins the class once with the few rows of its deltas. A branch is a folder of numbered files that name
commits, the last is its head. The next number is created only where it isn't there yet, from the number
that was read before the work began, so of two writers of one head one gets a Conflict and no commit is
lost. Every commit then appends its rows to the change log, which streams read, and marks that it has; a
commit left unmarked by a crash is logged by the next write of its branch (so an event may come twice, with
the same commit and id).
"""

from __future__ import annotations

import datetime
import urllib.parse
import uuid
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.catalog import Catalog, CatalogError, Property

COMMIT = "id string, parent string, author string, message string, at timestamp, tables map<string,string>"
CHANGE = "commit string, branch string, cls string, id string, action string, at timestamp"


COMPACT = 16


@dataclass(frozen=True)
class Delta:
    """Changes of a class: rows that are put in or replace those of their key, and the keys (columns) of rows that go."""

    rows: DataFrame | None = None
    gone: DataFrame | None = None


class Conflict(RuntimeError):
    """Both sides changed the same documents, or the branch moved while a commit was made."""


def _like(rows: DataFrame, old: DataFrame) -> DataFrame:
    """rows with the columns and types of old; what they lack is null."""
    there = set(rows.columns)
    return rows.select(*[(F.col(f"`{c.name}`") if c.name in there else F.lit(None)).cast(c.dataType).alias(c.name) for c in old.schema])


class Store:
    def __init__(self, spark: SparkSession, path: str, catalog: Catalog):
        self.spark, self.path, self.catalog = spark, path.rstrip("/"), catalog
        self._known: dict = {}

    # -- small files ----------------------------------------------------------------------------
    def _put(self, rows: list, schema: str, to: str) -> None:
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{self.path}/{to}")

    def _rows(self, schema: str, at: str) -> list:
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{at}")
        fs = fs_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return self.spark.read.schema(schema).json(f"{self.path}/{at}").collect() if fs.exists(fs_path) else []

    def _fs(self, at: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{at}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _claim(self, at: str, text: str) -> bool:
        """Creates a file with a text unless it is there."""
        fs, path = self._fs(at)
        try:
            out = fs.create(path, False)
        except Py4JJavaError:
            if fs.exists(path):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def _text(self, fs, path) -> str:
        stream = fs.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, branch: str = "main") -> str:
        """An empty first commit whose classes come from the catalogue's frames."""
        tables, new = {}, uuid.uuid4().hex
        for k, d in self.catalog.classes.items():
            if d.frame and not d.abstract:
                self._save(k, new, d.frame())
                tables[k] = new
        return self._commit(new, None, branch, tables, "system", "create")

    def _save(self, cls: str, commit: str, df: DataFrame) -> None:
        df.write.parquet(f"{self.path}/data/{commit}/{cls}")

    def _commit(self, new: str, parent: str | None, branch: str, tables: dict, author: str, message: str, n: int | None = None) -> str:
        now = datetime.datetime.now(datetime.timezone.utc)
        self._put([(new, parent, author, message, now, tables)], COMMIT, "commits")
        self._move(branch, new, n)
        return new

    def _move(self, branch: str, commit: str, n: int | None = None) -> None:
        """Makes a commit the head behind number n of the branch (by default the last one); "" closes the branch."""
        n = self._last(branch)[0] if n is None else n
        if not self._claim(f"heads/{urllib.parse.quote(branch, safe='')}/{n + 1:012d}", commit):
            raise Conflict(f"{branch} has moved")

    def _last(self, branch: str) -> tuple[int, str]:
        """(number, commit) of a branch's head; (0, "") if there is none."""
        fs, path = self._fs(f"heads/{urllib.parse.quote(branch, safe='')}")
        if not fs.exists(path):
            return 0, ""
        last = max((x.getPath() for x in fs.listStatus(path)), key=lambda p: p.getName(), default=None)
        return (int(last.getName()), self._text(fs, last)) if last is not None else (0, "")

    # -- reading --------------------------------------------------------------------------------
    def branches(self) -> dict[str, str]:
        fs, path = self._fs("heads")
        names = [urllib.parse.unquote(x.getPath().getName()) for x in fs.listStatus(path)] if fs.exists(path) else []
        return {b: c for b in sorted(names) if (c := self._last(b)[1])}

    def head(self, branch: str) -> str:
        commit = self._last(branch)[1]
        if not commit:
            raise CatalogError(f"no branch {branch}; there are {', '.join(self.branches())}")
        return commit

    def resolve(self, collection: str) -> str:
        """branch/x, commit/y, a branch or a commit."""
        kind, _, name = collection.rpartition("/")
        kind = kind.rpartition("/")[2]
        if kind == "branch":
            return self.head(name)
        if kind == "commit":
            return name
        return self.branches().get(name, name)

    def manifest(self, commit: str):
        if commit not in self._known:
            self._known |= {r.id: r for r in self._rows(COMMIT, "commits")}  # commits never change
        if commit not in self._known:
            raise CatalogError(f"no commit {commit}")
        return self._known[commit]

    def read(self, cls: str, commit: str) -> DataFrame:
        at = self.manifest(commit).tables.get(cls)
        if at is None:
            raise CatalogError(f"{cls} has no rows at {commit}")
        return self._table(cls, at)

    def _table(self, cls: str, at: str) -> DataFrame:
        """The rows of a class from the commits that make it up."""
        whole, *deltas = at.split("+")
        base = self.spark.read.parquet(f"{self.path}/data/{whole}/{cls}")
        if not deltas:
            return base
        key = list(self.catalog.get(cls).key)
        last = self._deltas(cls, deltas)
        return base.join(last.select(*key), key, "left_anti").select(*base.columns).unionByName(last.filter("not _gone").select(*base.columns))

    def _deltas(self, cls: str, commits: list[str]) -> DataFrame:
        """The last row of every key in some deltas; _gone tells those that go."""
        out = None
        for n, c in enumerate(commits):
            df = self.spark.read.parquet(f"{self.path}/data/{c}/{cls}").withColumn("_n", F.lit(n))
            out = df if out is None else out.unionByName(df)
        if len(commits) == 1:
            return out.drop("_n")
        w = Window.partitionBy(*self.catalog.get(cls).key).orderBy(F.desc("_n"))
        return out.withColumn("_last", F.row_number().over(w)).filter("_last = 1").drop("_n", "_last")

    def catalog_at(self, commit: str) -> Catalog:
        tables = self.manifest(commit).tables
        return self.catalog.with_frames({k: (lambda at=at, k=k: self._table(k, at)) for k, at in tables.items()})

    def log(self, branch: str = "main") -> DataFrame:
        """The branch's commits, newest first (`n` counts from 0)."""
        by, out, at = {r.id: r for r in self._rows(COMMIT, "commits")}, [], self.head(branch)
        while at:
            r = by[at]
            out.append((len(out), r.id, r.parent, r.author, r.message, r.at))
            at = r.parent
        return self.spark.createDataFrame(out, "n int, id string, parent string, author string, message string, at timestamp")

    def history(self, cls: str, commits: list[str]) -> DataFrame:
        """Rows of a class at several versions, with their commit."""
        out = None
        for c in commits:
            df = self.read(cls, c).withColumn("commit", F.lit(c))
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
        return out

    # -- writing --------------------------------------------------------------------------------
    def base(self, branch: str) -> tuple[int, str]:
        """(number, commit) of a branch's head, for reading before a write."""
        self.head(branch)
        return self._last(branch)

    def write(self, changes: dict[str, DataFrame | Delta], branch: str = "main", author: str = "", message: str = "", base: tuple[int, str] | None = None) -> str:
        """All rows of some classes, or what changes of them: one commit behind `base`, which they were made from. The log gets what differs.

        A branch that has moved since is a Conflict.
        """
        n, parent = base or self.base(branch)
        self.log_changes(parent, branch)
        new = uuid.uuid4().hex
        tables = dict(self.manifest(parent).tables)
        for cls, change in changes.items():
            at = tables.get(cls)
            if isinstance(change, Delta) and at and at.count("+") < COMPACT:
                self._save(cls, new, self._saved(cls, change, self._table(cls, at)))
                tables[cls] = f"{at}+{new}"
            else:
                self._save(cls, new, self.applied(cls, change, self._table(cls, at)) if isinstance(change, Delta) else change)
                tables[cls] = new
        out = self._commit(new, parent, branch, tables, author, message, n)
        self.log_changes(out, branch)
        return out

    def log_changes(self, commit: str, branch: str) -> None:
        """Appends a commit's changes to the log unless that is done."""
        fs, mark = self._fs(f"logged/{commit}")
        if fs.exists(mark):
            return
        m = self.manifest(commit)
        before = self.manifest(m.parent).tables if m.parent else dict(m.tables)  # a first commit has no changes
        for cls, at in m.tables.items():
            if before.get(cls) != at and cls in before:
                log = self.diff(cls, m.parent, commit).select(F.lit(commit).alias("commit"), F.lit(branch).alias("branch"), F.lit(cls).alias("cls"), "id", "action", F.current_timestamp().alias("at"))
                log.write.mode("append").json(f"{self.path}/changes")
        self._claim(f"logged/{commit}", branch)

    def _keyed(self, cls: str, df: DataFrame) -> DataFrame:
        d = self.catalog.get(cls)
        key = d.raw_key().cast("string")
        return df.withColumn("id", key if d.key == ("iri",) else F.concat(F.lit(f"{cls}/"), key))

    def _saved(self, cls: str, change: Delta, old: DataFrame) -> DataFrame:
        """A delta as it is written: the class's columns and _gone."""
        key, out = list(self.catalog.get(cls).key), None
        if change.rows is not None:
            out = _like(change.rows, old).withColumn("_gone", F.lit(False))
        if change.gone is not None:
            gone = _like(change.gone.select(*key).distinct(), old).withColumn("_gone", F.lit(True))
            out = gone if out is None else out.unionByName(gone)
        return out if out is not None else old.limit(0).withColumn("_gone", F.lit(False))

    def applied(self, cls: str, change: Delta, old: DataFrame) -> DataFrame:
        """A class's rows after a change."""
        key, out = list(self.catalog.get(cls).key), old
        for keys in (change.gone, change.rows):
            if keys is not None:
                out = out.join(_like(keys.select(*key), old).select(*key), key, "left_anti").select(*old.columns)
        return out if change.rows is None else out.unionByName(_like(change.rows, old))

    def then(self, cls: str, first: Delta | None, second: Delta) -> Delta:
        """Both changes as one."""
        if first is None:
            return second
        key = list(self.catalog.get(cls).key)
        keys = [x.select(*key) for x in (second.rows, second.gone) if x is not None]
        rows, gone = first.rows, [x.select(*key) for x in (first.gone, second.gone) if x is not None]
        for k in keys:
            rows = rows.join(k, key, "left_anti").select(*rows.columns) if rows is not None else None
        rows = second.rows if rows is None else rows if second.rows is None else rows.unionByName(second.rows, allowMissingColumns=True)
        every = gone[0].unionByName(gone[1]) if len(gone) == 2 else gone[0] if gone else None
        if every is not None and second.rows is not None:  # a key that comes back hasn't gone
            every = every.join(second.rows.select(*key), key, "left_anti")
        return Delta(rows, every)

    def insert(self, cls: str, rows: DataFrame, branch: str = "main", **note) -> str:
        return self.write({cls: Delta(rows)}, branch, **note)

    def update(self, cls: str, rows: DataFrame, branch: str = "main", **note) -> str:
        """Replaces documents of the same key, adds the others."""
        return self.write({cls: Delta(rows)}, branch, **note)

    def without(self, cls: str, keys: DataFrame, rows) -> dict[str, Delta]:
        """Takes the documents of `keys` (key: the raw key) and their subdocuments out; rows(class) gives a class."""
        d, old = self.catalog.get(cls), rows(cls)
        out = {cls: Delta(gone=old.withColumn("_key", d.raw_key()).join(keys.select(F.col("key").alias("_key")), "_key", "left_semi").select(*d.key))}
        for k, sub in self.catalog.classes.items():
            for p in self.catalog.properties(k).values() if sub.subdocument and sub.frame else ():
                if p.link == cls and not p.many:
                    below = rows(k).join(keys.select(F.col("key").alias(p.column)), p.column, "left_semi").select(*sub.key)
                    out[k] = self.then(k, out.get(k), Delta(gone=below))
        return out

    def delete(self, cls: str, keys: DataFrame, branch: str = "main", **note) -> str:
        """Removes documents, and subdocuments that link to them."""
        base = self.base(branch)
        raw = keys.select(self.catalog.get(cls).raw_key().alias("key"))
        return self.write(self.without(cls, raw, lambda k: self.read(k, base[1])), branch, base=base, **note)

    def with_values(self, cls: str, p: Property, pairs: DataFrame, old: DataFrame, remove: bool = False) -> Delta:
        """Sets or removes the values of `pairs` (key, value) in a class's rows; several for one document need a multi-valued property."""
        kind = old.schema[p.column].dataType
        by_key = pairs.select(F.col("key").alias("_key"), F.col("value").cast(kind.elementType if p.many else kind).alias("_v")).groupBy("_key").agg(F.collect_set("_v").alias("_vs"))
        new = old.withColumn("_key", self.catalog.get(cls).raw_key()).join(by_key, "_key")
        c, xs = F.col(p.column), F.col("_vs")
        if p.many:
            had = F.coalesce(c, F.array().cast(kind))
            changed = F.filter(had, lambda e: ~F.array_contains(xs, e)) if remove else F.array_union(had, xs) if p.family == "set" else F.concat(had, xs)
        elif remove:
            changed = F.when(F.array_contains(xs, c), F.lit(None)).otherwise(c)
        else:
            changed = F.when(F.size(xs) > 1, F.raise_error(F.lit(f"several values for {cls}.{p.name} of one document")).cast(kind)).otherwise(F.get(xs, F.lit(0)))
        return Delta(new.withColumn(p.column, changed).select(*old.columns))

    def set_triples(self, cls: str, prop: str, rows: DataFrame, branch: str = "main", remove: bool = False, **note) -> str:
        """rows (key, value): sets a property, or removes that value (adds to or takes from a multi-valued one)."""
        base = self.base(branch)
        return self.write({cls: self.with_values(cls, self.catalog.properties(cls)[prop], rows, self.read(cls, base[1]), remove)}, branch, base=base, **note)

    # -- differences ----------------------------------------------------------------------------
    def diff(self, cls: str, before: str, after: str) -> DataFrame:
        """id, action (added, deleted, updated), columns: old and new text of every column that differs."""
        a, b = (self.read(cls, c) for c in (before, after))
        was, now = (self.manifest(c).tables[cls] for c in (before, after))
        if now.startswith(f"{was}+"):  # only keys of the deltas between can differ
            key = list(self.catalog.get(cls).key)
            keys = self._deltas(cls, now[len(was) + 1 :].split("+")).select(*key)
            a, b = a.join(keys, key, "left_semi").select(*a.columns), b.join(keys, key, "left_semi").select(*b.columns)
        a, b = self._keyed(cls, a), self._keyed(cls, b)
        names = [c for c in b.columns if c != "id"]
        l, r = a.select("id", F.struct(*[c for c in a.columns if c != "id"]).alias("a")), b.select("id", F.struct(*names).alias("b"))
        both = l.join(r, "id", "full")
        text = lambda c: F.to_json(F.struct(c.alias("v")))
        cells = [F.when(~F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")), F.struct(F.lit(n).alias("column"), text(F.col(f"a.{n}")).alias("before"), text(F.col(f"b.{n}")).alias("after"))) for n in names if n in a.columns]
        action = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "deleted").otherwise("updated")
        return both.select("id", action.alias("action"), F.array_compact(F.array(*cells)).alias("columns")).filter((F.col("action") != "updated") | (F.size("columns") > 0))

    def delta(self, commit: str, op: str) -> DataFrame:
        """Edges (s, p, o, kind, dt) that a commit added or deleted."""
        from ..plans.lower import Lowerer

        m = self.manifest(commit)
        if not m.parent:
            raise CatalogError("the first commit has nothing before it")
        old = self.manifest(m.parent).tables
        changed = [k for k, at in m.tables.items() if old.get(k) != at]
        sides = []
        for c in (commit, m.parent):
            full = self.catalog_at(c)
            some = Catalog({k: d if k in changed else replace(d, frame=None) for k, d in full.classes.items()})
            sides.append(Lowerer(self.spark, some).triples())
        a, b = sides if op == "added" else sides[::-1]
        return a.exceptAll(b)

    def patch(self, cls: str, diff: DataFrame, source: str, branch: str = "main", **note) -> str:
        """Applies a difference: rows it adds or updates come from the version `source`."""
        base = self.base(branch)
        return self.write({cls: self._taken(cls, diff, source, base[1])}, branch, base=base, **note)

    def _taken(self, cls: str, diff: DataFrame, source: str, head: str) -> Delta:
        """What a difference to the version `source` changes at a head."""
        key = self.catalog.get(cls).key
        new = self._keyed(cls, self.read(cls, source)).join(diff.filter("action <> 'deleted'").select("id"), "id", "left_semi").drop("id")
        gone = self._keyed(cls, self.read(cls, head)).join(diff.filter("action = 'deleted'").select("id"), "id", "left_semi").select(*key)
        return Delta(new, gone)

    def created(self, commit: str, cls: str | None = None) -> DataFrame:
        """cls, id of the documents that a commit added; a first commit added none."""
        m = self.manifest(commit)
        before = self.manifest(m.parent).tables if m.parent else dict(m.tables)
        out = self.spark.createDataFrame([], "cls string, id string")
        for k, at in m.tables.items():
            if before.get(k) not in (None, at) and cls in (None, k):
                new = self._keyed(k, self.read(k, commit)).join(self._keyed(k, self.read(k, m.parent)).select("id"), "id", "left_anti")
                out = out.unionByName(new.select(F.lit(k).alias("cls"), "id"))
        return out

    # -- branches -------------------------------------------------------------------------------
    def branch(self, name: str, at: str = "main") -> str:
        if name in self.branches():
            raise CatalogError(f"there is a branch {name}")
        commit = self.resolve(at)
        self._move(name, commit)
        return commit

    def delete_branch(self, name: str) -> None:
        self.head(name)
        self._move(name, "")

    def reset(self, branch: str, commit: str) -> None:
        self.manifest(commit)
        self._move(branch, commit)

    def squash(self, branch: str = "main", message: str = "squash") -> str:
        """One commit without history, of the same rows."""
        m = self.manifest(self.head(branch))
        return self._commit(uuid.uuid4().hex, None, branch, dict(m.tables), "system", message)

    def ancestors(self, commit: str) -> list[str]:
        by, out = {r.id: r.parent for r in self._rows(COMMIT, "commits")}, []
        while commit:
            out.append(commit)
            commit = by.get(commit)
        return out

    def merge(self, source: str, branch: str = "main", **note) -> str:
        """Three-way: changes since the common ancestor; the same document changed on both sides is a conflict."""
        at, theirs = self.base(branch), self.head(source)
        ours = at[1]
        line = self.ancestors(ours)
        base = next(c for c in self.ancestors(theirs) if c in line)
        changes = {}
        a, b, z = (self.manifest(c).tables for c in (ours, theirs, base))
        for cls in b:
            if b[cls] == z.get(cls):
                continue
            diff = self.diff(cls, base, theirs)
            if a[cls] != z.get(cls) and not diff.join(self.diff(cls, base, ours), "id", "left_semi").isEmpty():
                raise Conflict(f"{cls} changed on both sides")
            changes[cls] = self._taken(cls, diff, theirs, ours)
        return self.write(changes, branch, base=at, **note) if changes else ours

    def rebase(self, branch: str, onto: str = "main") -> str:
        """The branch's commits since the common ancestor again, one by one, behind the head of `onto`.

        They are written on a branch of their own; the branch moves when all are there. A document that
        both sides changed is a conflict, and nothing moves.
        """
        (number, ours), theirs = self.base(branch), self.head(onto)
        line = self.ancestors(theirs)
        mine = self.ancestors(ours)
        base = next(c for c in mine if c in line)
        a, b, z = (self.manifest(c).tables for c in (ours, theirs, base))
        for cls in a:
            if a[cls] != z.get(cls) != b.get(cls) and not self.diff(cls, base, ours).join(self.diff(cls, base, theirs), "id", "left_semi").isEmpty():
                raise Conflict(f"{cls} changed on both sides")
        side = f"rebase-{uuid.uuid4().hex}"
        self._move(side, theirs)
        before = base
        for commit in reversed(mine[: mine.index(base)]):
            m, was, head = self.manifest(commit), self.manifest(before).tables, self.head(side)
            changes = {}
            for cls in (k for k, at in m.tables.items() if was.get(k) != at):
                changes[cls] = self._taken(cls, self.diff(cls, before, commit), commit, head)
            self.write(changes, side, author=m.author, message=m.message)
            before = commit
        out = self.head(side)
        self._move(branch, out, number)
        self._move(side, "")
        return out
