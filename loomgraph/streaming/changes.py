"""The change log as a stream, and event-time windows on any stream of events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.versions import CHANGE, Store


def changes(store: Store, cls: str | None = None, action: str | None = None) -> DataFrame:
    """A streaming frame of the store's change log: at least once by the checkpoint, in order of commits' files."""
    df = store.spark.readStream.schema(CHANGE).json(f"{store.path}/changes")
    if cls:
        df = df.filter(F.col("cls") == cls)
    return df.filter(F.col("action") == action) if action else df


def listen(store: Store, checkpoint: str, on: Callable[[DataFrame], None], cls: str | None = None, action: str | None = None):
    """Hands every batch of matching changes to `on`, for all there is now."""

    def each(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            on(batch)

    q = changes(store, cls, action).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


class Handlers:
    """Callbacks by kind of change, for all there is now: Handlers(store).on_deleted("Person", print).run(checkpoint).

    A callback gets a DataFrame: ids (id), documents (the class's columns with id, as they are at their commit), or
    the change rows. Batches come in order of the log; a change may come again after a crash.
    """

    def __init__(self, store: Store):
        self.store, self.held = store, []

    def _on(self, cls: str | None, actions: tuple, make: Callable, call: Callable) -> Handlers:
        self.held.append((cls, actions, make, call))
        return self

    def on_added_id(self, cls: str, call: Callable[[DataFrame], None]) -> Handlers:
        return self._on(cls, ("added",), lambda df, _: df.select("id"), call)

    def on_added(self, cls: str, call: Callable[[DataFrame], None]) -> Handlers:
        return self._on(cls, ("added",), self._documents, call)

    def on_updated_id(self, cls: str, call: Callable[[DataFrame], None]) -> Handlers:
        return self._on(cls, ("updated",), lambda df, _: df.select("id"), call)

    def on_updated(self, cls: str, call: Callable[[DataFrame], None]) -> Handlers:
        return self._on(cls, ("updated",), self._documents, call)

    def on_deleted(self, cls: str, call: Callable[[DataFrame], None]) -> Handlers:
        return self._on(cls, ("deleted",), lambda df, _: df.select("id"), call)

    def on_changed(self, cls: str, call: Callable[[DataFrame], None]) -> Handlers:
        return self._on(cls, (), lambda df, _: df, call)

    def on_changeset(self, call: Callable[[DataFrame], None]) -> Handlers:
        return self._on(None, (), lambda df, _: df, call)

    def _documents(self, df: DataFrame, cls: str) -> DataFrame:
        out = None
        for commit in [r.commit for r in df.select("commit").distinct().collect()]:  # commits of one batch
            rows = self.store._keyed(cls, self.store.read(cls, commit)).join(df.filter(F.col("commit") == commit).select("id"), "id", "left_semi")
            out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
        return out

    def run(self, checkpoint: str):
        def each(batch: DataFrame, _: int) -> None:
            for cls, actions, make, call in self.held:
                df = batch if cls is None else batch.filter(F.col("cls") == cls)
                df = df.filter(F.col("action").isin(*actions)) if actions else df
                if not df.isEmpty():
                    call(make(df, cls))

        q = changes(self.store).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
        return q


def tumbling(events: DataFrame, width: str, late: str | None = None) -> DataFrame:
    """Count and sum of value for each event type and window; works on streams and tables alike."""
    df = events.withWatermark("ts", late) if late else events
    out = df.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, width: str, step: str) -> DataFrame:
    out = events.groupBy(F.window("ts", width, step).alias("w"), "event_type").agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str) -> DataFrame:
    out = events.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("start"), F.col("w.end").cast("timestamp_ntz").alias("end"), "user_id", "n")


def run_all(spark: SparkSession, stream: DataFrame, to: str, checkpoint: str) -> DataFrame:
    """Drains a stream into a table in append mode and reads it."""
    q = stream.writeStream.format("parquet").option("path", to).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(to)
