"""Per-key state: first and last seen, content changes, exactly-once commits; as one batch plan
and as a stream, with the same results."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

DISCOVERY = "first_seen timestamp, last_seen timestamp, seen_count long, last_batch string"


def discovery(events: DataFrame, key: str, at: str, batch: str) -> DataFrame:
    """``key, first_seen, last_seen, seen_count, active``: a batch counts once per key; once seen a
    key stays active. Rows without key are ignored."""
    per = events.where(F.col(key).isNotNull()).groupBy(key, batch).agg(F.min(at).alias("__a"), F.max(at).alias("__b"))
    return per.groupBy(key).agg(F.min("__a").alias("first_seen"), F.max("__b").alias("last_seen"), F.count(F.lit(1)).alias("seen_count"), F.lit(True).alias("active"))


def content_changes(events: DataFrame, key: str, at: str, content: str, tie: str) -> DataFrame:
    """``events`` with ``change``: new, unchanged or changed against the key's previous content.

    The key's rows are ordered by time and ``tie``; null content is a content of its own.
    """
    w = Window.partitionBy(key).orderBy(at, tie)
    first, before = F.row_number().over(w) == 1, F.lag(content).over(w)
    return events.withColumn("change", F.when(first, "new").when(before.eqNullSafe(F.col(content)), "unchanged").otherwise("changed"))


def last_state(events: DataFrame, key: str, state: str, order: str) -> DataFrame:
    """``key, state`` of the last event; a key left in ``processing`` is pending again."""
    last = events.groupBy(key).agg(F.max_by(state, F.struct(order, state)).alias("last"))
    return last.select(key, F.when(F.col("last") == "processing", "pending").otherwise(F.col("last")).alias("state"))


def commit(known: DataFrame, arrived: DataFrame, key: str, fact: str) -> DataFrame:
    """``key, outcome``: new, overlap, or conflict if the key was known with another fact."""
    once = arrived.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(fact).alias("__new"), F.count_distinct(fact).alias("__facts"))
    old = known.groupBy(key).agg(F.min(fact).alias("__old"))
    out = F.when(F.col("__facts") > 1, "conflict").when(F.col("__old").isNull(), "new").when(F.col("__old") == F.col("__new"), "overlap").otherwise("conflict")
    return once.join(old, key, "left").select(key, out.alias("outcome"))


def outstanding(queue: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What of a queue is still to do when what was written is the authority: a key that the queue calls
    completed but that was never written is done again, one that was written is not."""
    keys = done.where(F.col(key).isNotNull()).select(key).distinct()
    return queue.join(keys, key, "left_anti")


def change_counters(changes: DataFrame, by: str, fields: tuple[str, ...]) -> DataFrame:
    """``by, n_rows, new, unchanged, changed`` and ``missing_<field>`` for each of ``fields``."""
    void = [F.count_if(F.coalesce(F.trim(F.col(f).cast("string")), F.lit("")) == "").alias(f"missing_{f}") for f in fields]
    return changes.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col("change") == k).alias(k) for k in ("new", "unchanged", "changed")], *void)


def stop_reason(runs: DataFrame, in_a_row: int = 3, ceiling: float = 0.1) -> DataFrame:
    """``failure_runs`` with ``stop``: consecutive_failures, error_rate or null."""
    return runs.withColumn("stop", F.when(F.col("longest_failure_run") >= in_a_row, "consecutive_failures").when(F.col("failure_rate") > ceiling, "error_rate"))


def failure_runs(events: DataFrame, run: str, order: str, failed: str) -> DataFrame:
    """``run, n_events, failures, longest_failure_run, failure_rate`` for the rules that end a run.

    Events are range-partitioned by run and order, so a run of any size is spread; each stretch is
    summed up as its length, its failures, and the runs of failures at its start, at its end and at
    most, and the stretches of a run (one per partition) are put together in order. Null is no
    failure; ties in order must agree or be broken by it.
    """
    kind = events.schema[run].dataType.simpleString()
    sorted_ = events.select(F.col(run).alias("run"), F.col(order).alias("order"), F.coalesce(failed, F.lit(False)).alias("failed")).repartitionByRange("run", "order").sortWithinPartitions("run", "order")

    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list = []  # [run, n, failures, head, tail, most]; runs follow one another
        for batch in batches:
            for name, part in batch.groupby("run", sort=False, dropna=False):
                x = part["failed"].to_numpy(bool)
                ok = np.flatnonzero(~x)
                edges = np.diff(np.concatenate(([-1], ok, [len(x)]))) - 1
                one = [name, len(x), int(x.sum()), int(edges[0]), int(edges[-1]), int(edges.max())]
                if kept and (kept[-1][0] == name or pd.isna(name) and pd.isna(kept[-1][0])):
                    kept[-1] = [name, *_joined(kept[-1][1:], one[1:])]
                else:
                    kept.append(one)
        yield pd.DataFrame(kept, columns=["run", "n", "failures", "head", "tail", "most"])

    met = sorted_.mapInPandas(stretches, f"run {kind}, n long, failures long, head long, tail long, most long").withColumn("place", F.spark_partition_id())
    parts = met.groupBy("run").agg(F.array_sort(F.collect_list(F.struct("place", "n", "failures", "head", "tail", "most"))).alias("parts"))  # at most one per partition
    field = lambda x, k: x.getField(k)

    def merged(a, b):
        whole = lambda x: field(x, "failures") == field(x, "n")
        return F.struct(
            field(b, "place").alias("place"), (field(a, "n") + field(b, "n")).alias("n"), (field(a, "failures") + field(b, "failures")).alias("failures"),
            F.when(whole(a), field(a, "n") + field(b, "head")).otherwise(field(a, "head")).alias("head"), F.when(whole(b), field(b, "n") + field(a, "tail")).otherwise(field(b, "tail")).alias("tail"),
            F.greatest(field(a, "most"), field(b, "most"), field(a, "tail") + field(b, "head")).alias("most"),
        )

    zero = F.struct(F.lit(-1).alias("place"), *[F.lit(0).cast("long").alias(k) for k in ("n", "failures", "head", "tail", "most")])
    done = parts.select(F.col("run").alias(run), F.aggregate("parts", zero, merged).alias("__r"))
    return done.select(run, F.col("__r.n").alias("n_events"), F.col("__r.failures").alias("failures"), F.col("__r.most").alias("longest_failure_run"), (F.col("__r.failures") / F.col("__r.n")).alias("failure_rate"))


def _joined(a: list, b: list) -> list:
    """Two neighbouring stretches as one: events, failures, failures at the start, at the end, at most in a row."""
    (n, f, head, tail, most), (m, g, start, end, other) = a, b
    return [n + m, f + g, n + start if f == n else head, m + tail if g == m else end, max(most, other, tail + start)]


class _Changes(StatefulProcessor):
    """Keeps the last content of each key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", StructType([StructField("content", StringType()), StructField("at", TimestampType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        for batch in rows:
            kinds = []
            for content in (batch := batch.sort_values(["at", "tie"]))["content"]:
                old = self.last.get() if self.last.exists() else None
                kinds.append("new" if old is None else "unchanged" if old[0] == content else "changed")
                self.last.update((content, None))
            yield pd.DataFrame({"key": key[0], "tie": batch["tie"], "change": kinds})

    def close(self) -> None:
        pass


def stream_content_changes(stream: DataFrame, key: str, at: str, content: str, tie: str) -> DataFrame:
    """``key, tie, change`` of a stream: what ``content_changes`` says of the rows in time order.

    Needs the RocksDB state store; a key's rows must arrive in time order across micro-batches.
    """
    named = stream.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(at).alias("at"), F.col(content).cast("string").alias("content"), F.col(tie).cast("long").alias("tie"))
    return named.groupBy("key").transformWithStateInPandas(
        statefulProcessor=_Changes(), outputStructType="key string, tie long, change string", outputMode="Append", timeMode="None"
    )


class _Commits(StatefulProcessor):
    """Keeps the fact of each key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", StructType([StructField("fact", StringType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        for batch in rows:
            out = []
            for fact in (batch := batch.sort_values("tie"))["fact"]:
                old = self.known.get()[0] if self.known.exists() else None
                out.append("new" if not self.known.exists() else "overlap" if old == fact else "conflict")
                if not self.known.exists():
                    self.known.update((fact,))
            yield pd.DataFrame({"key": key[0], "tie": batch["tie"], "outcome": out})

    def close(self) -> None:
        pass


def stream_commit(stream: DataFrame, key: str, fact: str, tie: str) -> DataFrame:
    """``key, tie, outcome`` of a stream: new for the first row of a key, overlap for one that repeats
    its fact, conflict for another fact. What was committed is never committed again, whatever the
    stream delivers twice."""
    named = stream.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(fact).cast("string").alias("fact"), F.col(tie).cast("long").alias("tie"))
    return named.groupBy("key").transformWithStateInPandas(statefulProcessor=_Commits(), outputStructType="key string, tie long, outcome string", outputMode="Append", timeMode="None")


def stream_discovery(stream: DataFrame, key: str, at: str, batch: str, late: str = "1 day") -> DataFrame:
    """First and last seen and the number of batches of each key, as an updating aggregate."""
    once = stream.where(F.col(key).isNotNull()).withWatermark(at, late).dropDuplicatesWithinWatermark([key, batch])
    return once.groupBy(key).agg(F.min(at).alias("first_seen"), F.max(at).alias("last_seen"), F.count(F.lit(1)).alias("seen_count"))


def stream_windows(stream: DataFrame, at: str, label: str, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Rows per window and label; windows are closed once the watermark has passed them."""
    counted = stream.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), label).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), label, "n")
